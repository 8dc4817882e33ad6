"""Row positions and previous values within an asset's series, for series of any length.

A series is ordered by business date, system date and id. It is cut into cells, one for each (asset, business date, system
hour), which is a prefix of that order and needs no look at the data first: rows are placed by a window over
their cell, and cells by a window over one row for each cell of an asset. So a hot asset is spread over its dates, and
what is in one task is what was known of one asset and date within an hour, or a calendar of counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

ORDER = ["business_date", "system_date", "ingest_id"]
CELL = ["_day", "_hour"]


def with_cells(df: DataFrame) -> DataFrame:
    """The rows with their cell columns; nulls sort first, as in the order itself."""
    hour = F.floor(F.unix_seconds("system_date") / 3600)
    return df.withColumns({
        "_day": F.coalesce(F.unix_date("business_date"), F.lit(-(2**31))), "_hour": F.coalesce(hour, F.lit(-(2**62)).cast("long")),
    })


def in_cell(key: str, *implied: str) -> WindowSpec:
    """The rows of a cell in order. Columns that follow from the cell, as its business date does, may be named: rows that lie by them
    already are not moved."""
    return Window.partitionBy(key, *implied, *CELL).orderBy(*ORDER)


def over_cells(key: str) -> WindowSpec:
    """The cells of a key in order."""
    return Window.partitionBy(key).orderBy(*CELL)


def before(window: WindowSpec) -> WindowSpec:
    return window.rowsBetween(Window.unboundedPreceding, -1)


def rows_before(n: Column, key: str) -> Column:
    """For a row for each cell with ``n`` counted rows, how many are in earlier cells."""
    return F.coalesce(F.sum(n).over(before(over_cells(key))), F.lit(0))


def _with_cell_values(placed: DataFrame, cells: DataFrame, key: str) -> DataFrame:
    """The rows with what is known of their cell, by the partitioning that the window over cells has made."""
    named = cells.select(*[F.col(c).alias(f"_cell{c}") for c in (key, *CELL)], *[c for c in cells.columns if c not in (key, *CELL)])
    same = F.col(key).eqNullSafe(F.col(f"_cell{key}"))
    for c in CELL:
        same = same & (F.col(c) == F.col(f"_cell{c}"))
    return placed.join(named, same).drop(*[f"_cell{c}" for c in (key, *CELL)])


def time_steps(df: DataFrame, counted: str, key: str = "asset_id") -> DataFrame:
    """Adds ``time_step``: how many earlier rows of the key have a non-null ``counted`` column. A null key is a key."""
    placed = with_cells(df).withColumn("_inside", F.count(counted).over(before(in_cell(key))))
    cells = placed.groupBy(key, *CELL).agg(F.count(counted).alias("_n"))
    cells = cells.withColumn("_earlier", rows_before(F.col("_n"), key)).drop("_n")
    joined = _with_cell_values(placed, cells, key)
    return joined.withColumn("time_step", F.col("_inside") + F.col("_earlier")).drop(*CELL, "_inside", "_earlier")


def with_previous(df: DataFrame, value: str, key: str = "asset_id") -> DataFrame:
    """Adds ``time_step`` and ``previous``, the value one row earlier. ``value`` must not be null.

    The first row of a cell looks back to the last row of the cell before.
    """
    window = in_cell(key)
    placed = with_cells(df).withColumns({"_inside": (F.row_number().over(window) - 1).cast("long"), "_lag": F.lag(value).over(window)})
    cells = placed.groupBy(key, *CELL).agg(F.count(value).alias("_n"), F.max_by(value, "_inside").alias("_last"))
    cells = cells.withColumns({"_earlier": rows_before(F.col("_n"), key), "_handed": F.lag("_last").over(over_cells(key))}).drop("_n", "_last")
    return _with_cell_values(placed, cells, key).withColumns({
        "time_step": F.col("_inside") + F.col("_earlier"), "previous": F.when(F.col("_inside") == 0, F.col("_handed")).otherwise(F.col("_lag")),
    }).drop(*CELL, "_inside", "_earlier", "_lag", "_handed")

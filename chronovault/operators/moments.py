"""Moments of an asset's series by part, which merge into those of longer parts: of a cell, a month, the whole series.

A part is a run of consecutive rows in the order of a series (see ``ordering``): count, mean and spread of its closes, their co-moment with
the position, first and last close, the moments of the returns inside it. Two parts side by side give the part they form together, since
positions shift by the count before and the return between them follows from a last and a first close. So months can be
stored, and a new fact renews the moments of its month alone.

Closes are ``close`` then ``close_price``; totals read ``close_price`` then ``close`` and have counts of their own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..fixed import MIN_TRAINING_POINTS
from ..functions.metrics import price
from ..functions.numeric import percent_change, simple_return
from .ordering import CELL, before, in_cell, with_cells
from .statistics import line_fits, ordinary_trends


def cell_moments(facts: DataFrame) -> DataFrame:
    """The moments of every (asset, business date, system hour). Rows without an asset do not count; rows without a price count for the
    last date alone."""
    rows = facts.where(F.col("asset_id").isNotNull()).select(
        "asset_id", "business_date", "system_date", "ingest_id",
        price(facts, "close", "close_price").alias("_close"), price(facts, "close_price", "close").alias("_total"),
    )
    earlier = before(in_cell("asset_id"))
    placed = with_cells(rows).withColumns({
        "_inside": F.count("_close").over(earlier), "_previous": F.last("_close", ignorenulls=True).over(earlier),
    }).withColumn("_return", simple_return(F.col("_close"), F.col("_previous")))
    y, j = F.col("_close"), F.col("_inside")
    place = F.when(y.isNotNull(), j)
    return placed.groupBy("asset_id", *CELL).agg(
        F.count(y).alias("n"), F.coalesce(F.avg(y), F.lit(0.0)).alias("mean"),
        F.coalesce(F.var_pop(y) * F.count(y), F.lit(0.0)).alias("squares"),
        F.coalesce(F.covar_pop(j.cast("double"), y) * F.count(y), F.lit(0.0)).alias("products"),
        F.min(y).alias("least"), F.max(y).alias("most"),
        F.min_by(y, place).alias("first_close"), F.max_by(y, place).alias("last_close"),
        F.count("_return").alias("returns"), F.coalesce(F.avg("_return"), F.lit(0.0)).alias("mean_return"),
        F.coalesce(F.var_pop("_return") * F.count("_return"), F.lit(0.0)).alias("return_squares"),
        F.count("_total").alias("total_count"), F.coalesce(F.avg("_total"), F.lit(0.0)).alias("total_mean"),
        F.min("_total").alias("total_least"), F.max("_total").alias("total_most"),
        F.max("business_date").alias("last_business_date"),
    )


def merge_parts(parts: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The moments of each key's parts together, the parts being in ``order``; one shuffle of the parts."""
    whole = Window.partitionBy(*keys)
    prior = before(whole.orderBy(*order))
    n, step = F.col("n"), F.col("_step")
    placed = parts.withColumns({
        "_earlier": F.coalesce(F.sum(n).over(prior), F.lit(0)),
        "_step": simple_return(F.col("first_close"), F.last("last_close", ignorenulls=True).over(prior)),
    })
    steps = step.isNotNull().cast("long")
    placed = placed.withColumns({
        "_points": F.sum(n).over(whole),
        "_mean": F.coalesce(F.try_divide(F.sum(n * F.col("mean")).over(whole), F.sum(n).over(whole)), F.lit(0.0)),
        "_returns": F.sum(F.col("returns") + steps).over(whole),
        "_mean_return": F.coalesce(F.try_divide(
            F.sum(F.col("returns") * F.col("mean_return") + F.coalesce(step, F.lit(0.0))).over(whole), F.sum(F.col("returns") + steps).over(whole),
        ), F.lit(0.0)),
    })
    from_mean_x = F.col("_earlier") + (n - 1) / 2 - (F.col("_points") - 1) / 2
    from_mean_y = F.col("mean") - F.col("_mean")
    from_return, step_from_return = F.col("mean_return") - F.col("_mean_return"), step - F.col("_mean_return")
    total, place = F.col("total_count"), F.when(n > 0, F.struct(*order))
    return placed.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.max("_mean").alias("mean"),
        F.sum(F.col("squares") + n * from_mean_y * from_mean_y).alias("squares"),
        F.sum(F.col("products") + n * from_mean_x * from_mean_y).alias("products"),
        F.min("least").alias("least"), F.max("most").alias("most"),
        F.min_by("first_close", place).alias("first_close"), F.max_by("last_close", place).alias("last_close"),
        F.max("_returns").alias("returns"), F.max("_mean_return").alias("mean_return"),
        F.sum(
            F.col("return_squares") + F.col("returns") * from_return * from_return + F.coalesce(step_from_return * step_from_return, F.lit(0.0))
        ).alias("return_squares"),
        F.sum(total).alias("total_count"),
        F.coalesce(F.try_divide(F.sum(total * F.col("total_mean")), F.sum(total)), F.lit(0.0)).alias("total_mean"),
        F.min("total_least").alias("total_least"), F.max("total_most").alias("total_most"),
        F.max("last_business_date").alias("last_business_date"),
    )


def monthly_moments(facts: DataFrame) -> DataFrame:
    """The moments of every (asset, business month); rows without a date are a month of their own, which comes first."""
    cells = cell_moments(facts).withColumn("business_month", F.trunc("last_business_date", "month"))
    return merge_parts(cells, ["asset_id", "business_month"], CELL)


def merged_series(months: DataFrame) -> DataFrame:
    """The moments of every asset's whole series from those of its months."""
    return merge_parts(months, ["asset_id"], ["business_month"])


def totals_of_months(months: DataFrame) -> DataFrame:
    """``statistics.yearly_totals`` of the facts that the months were made from."""
    dated = months.where((F.col("total_count") > 0) & F.col("business_month").isNotNull())
    n = F.col("total_count")
    return dated.groupBy("asset_id", F.year("business_month").alias("business_date_year")).agg(
        F.sum(n).alias("record_count"), F.min("total_least").alias("min_close_price"), F.max("total_most").alias("max_close_price"),
        (F.sum(n * F.col("total_mean")) / F.sum(n)).alias("average_close_price"),
    )


def trends_of_months(months: DataFrame) -> DataFrame:
    """``statistics.linear_trends`` of the facts that the months were made from."""
    series = merged_series(months).where(F.col("n") >= MIN_TRAINING_POINTS)
    return ordinary_trends(line_fits(series.select(
        "asset_id", F.col("n").alias("training_points"), F.col("mean").alias("_mean_y"), F.col("squares").alias("_squares"),
        F.col("products").alias("_products"), (F.col("least") == F.col("most")).alias("_constant"), F.col("least").alias("_least"),
        F.col("last_close").alias("last_known_close"), "last_business_date",
    )))


def statistics_of_months(months: DataFrame) -> DataFrame:
    """``statistics.series_statistics`` of the priced facts that the months were made from."""
    series = merged_series(months).where(F.col("n") > 0)
    first, last = F.col("first_close"), F.col("last_close")
    return series.select(
        "asset_id", F.col("n").alias("count"), first.alias("first"), last.alias("last"), F.col("mean").alias("average"),
        percent_change(first, last).alias("percent_change"),
        F.when(F.col("returns") == 1, 0.0).when(F.col("returns") > 1, F.sqrt(F.col("return_squares") / (F.col("returns") - 1))).alias("volatility"),
    )

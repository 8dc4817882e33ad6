"""Yearly totals, linear trends, series statistics and pairwise comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..fixed import MIN_TRAINING_POINTS, RIDGE_PENALTY
from ..functions.metrics import price
from ..functions.numeric import percent_change, ratio, simple_return
from ..functions.text import business_year
from .filters import business_range, where_equal, where_in
from .ordering import CELL, before, in_cell, over_cells, rows_before, with_cells, with_previous
from .versions import newest, top_versions


def yearly_totals(facts: DataFrame, asset_ids=None) -> DataFrame:
    """Per (asset, year): priced rows, and min, max and mean close.

    Rows without a price, a year or an asset do not count. One partial aggregate with
    primitive buffers, so a hot asset is folded before the shuffle.
    """
    day = F.col("business_date")
    rows = where_in(facts, "asset_id", asset_ids).where(F.col("asset_id").isNotNull() & day.isNotNull())
    is_date = dict(facts.dtypes)["business_date"] == "date"
    priced = rows.select(
        "asset_id",
        (F.year(day) if is_date else business_year(day)).alias("business_date_year"),
        price(rows, "close_price", "close").alias("_close"),
    ).where(F.col("_close").isNotNull() & F.col("business_date_year").isNotNull())
    return priced.groupBy("asset_id", "business_date_year").agg(
        F.count("_close").alias("record_count"),
        F.min("_close").alias("min_close_price"),
        F.max("_close").alias("max_close_price"),
        F.avg("_close").alias("average_close_price"),
    )


def _fits(facts: DataFrame, asset_ids) -> DataFrame:
    """Least squares of close on its position, per asset with enough points; one read and one shuffle of the rows.

    Positions are 0, 1, ... so their mean and spread follow from the count. A cell (see ``ordering``) is folded to count, mean, sums of
    squares and products about its means; cells are merged about the asset's means, which keeps the digits.
    Unpriced rows only count for the last date. Facts that lie in buckets of (asset, business date) are not shuffled.
    """
    rows = where_in(facts, "asset_id", asset_ids).where(F.col("asset_id").isNotNull())
    points = rows.select(
        "asset_id", "business_date", "system_date", "ingest_id", price(rows, "close", "close_price").alias("_close")
    )
    y, j = F.col("_close"), F.col("_inside")
    placed = with_cells(points).withColumn("_inside", F.count("_close").over(before(in_cell("asset_id", "business_date"))))
    cells = placed.groupBy("asset_id", "business_date", *CELL).agg(
        F.count(y).alias("_n"), F.coalesce(F.avg(y), F.lit(0.0)).alias("_mean"),
        F.coalesce(F.var_pop(y) * F.count(y), F.lit(0.0)).alias("_squares"),
        F.coalesce(F.covar_pop(j.cast("double"), y) * F.count(y), F.lit(0.0)).alias("_products"),
        F.min(y).alias("_least"), F.max(y).alias("_most"),
        F.max_by(y, F.when(y.isNotNull(), j)).alias("_last"), F.max("business_date").alias("last_business_date"),
    )
    asset, n = Window.partitionBy("asset_id"), F.col("_n")
    merged = cells.withColumns({
        "_earlier": rows_before(n, "asset_id"), "_points": F.sum("_n").over(asset), "_mean_y": F.try_divide(F.sum(n * F.col("_mean")).over(asset), F.sum("_n").over(asset)),
    }).where(F.col("_points") >= MIN_TRAINING_POINTS)
    from_mean_x = F.col("_earlier") + (n - 1) / 2 - (F.col("_points") - 1) / 2
    from_mean_y = F.col("_mean") - F.col("_mean_y")
    sums = merged.groupBy("asset_id").agg(
        F.first("_points").alias("training_points"), F.first("_mean_y").alias("_mean_y"),
        F.sum(F.col("_squares") + n * from_mean_y * from_mean_y).alias("_squares"),
        F.sum(F.col("_products") + n * from_mean_x * from_mean_y).alias("_products"),
        (F.min("_least") == F.max("_most")).alias("_constant"), F.min("_least").alias("_least"),
        F.max_by("_last", F.when(n > 0, F.struct(*CELL))).alias("last_known_close"), F.max("last_business_date").alias("last_business_date"),
    )
    return line_fits(sums)


def line_fits(sums: DataFrame) -> DataFrame:
    """Slope, spread and r² from an asset's count, mean, and sums of squares and products about the means."""
    points_, flat = F.col("training_points"), F.col("_constant")
    sums = sums.withColumns({
        "_mean_y": F.when(flat, F.col("_least")).otherwise(F.col("_mean_y")), "_squares": F.when(flat, 0.0).otherwise(F.col("_squares")),
        "_products": F.when(flat, 0.0).otherwise(F.col("_products")),
        "_mean_x": (points_ - 1) / 2, "_squares_x": points_ * (points_.cast("double") * points_ - 1) / 12,
    })
    return sums.withColumns({
        "_slope": F.col("_products") / F.col("_squares_x"), "_sd_y": F.sqrt(F.col("_squares") / points_),
        "_r2": F.when(flat, 1.0).otherwise(F.col("_products") * F.col("_products") / (F.col("_squares_x") * F.col("_squares"))),
    })


def _trends(fits: DataFrame, slope: Column, intercept: Column, r_squared: Column) -> DataFrame:
    return (
        fits.withColumns({"calculated_trend_slope": slope})
        .withColumns({"intercept": intercept})
        .withColumns({
            "predicted_next_close_price": F.col("intercept")
            + F.col("calculated_trend_slope") * F.col("training_points"),
            "r_squared": r_squared,
            "calculation_time": F.current_timestamp(),
        })
        .select(
            "asset_id", "calculation_time", "training_points", "last_known_close", "calculated_trend_slope",
            "intercept", "predicted_next_close_price", "r_squared", "last_business_date",
        )
    )


def ordinary_trends(fits: DataFrame) -> DataFrame:
    """The trend table of least-squares fits."""
    return _trends(fits, F.col("_slope"), F.col("_mean_y") - F.col("_slope") * F.col("_mean_x"), F.col("_r2"))


def linear_trends(facts: DataFrame, asset_ids=None) -> DataFrame:
    """Ordinary least squares of close on its position, per asset with enough points."""
    return ordinary_trends(_fits(facts, asset_ids))


def ridge_trends(facts: DataFrame, asset_ids=None, penalty: float = RIDGE_PENALTY) -> DataFrame:
    """The ridge form on standardised data, in closed form for its single feature."""
    spread = F.col("_sd_y")
    slope = F.when(spread == 0, F.lit(0.0)).otherwise(
        F.try_divide(F.col("_slope"), 1 + F.try_divide(F.lit(penalty), spread))
    )
    intercept = F.col("_mean_y") - F.col("calculated_trend_slope") * F.col("_mean_x")
    # 1 - RSS/TSS of the shrunk line: with b = k * OLS slope, r2 = OLS r2 * (2k - k^2)
    shrink = F.try_divide(F.col("calculated_trend_slope"), F.col("_slope"))
    r_squared = F.when(spread != 0, F.coalesce(F.col("_r2") * (2 * shrink - shrink * shrink), F.lit(0.0)))
    return _trends(_fits(facts, asset_ids), slope, intercept, r_squared)


def priced_series(facts: DataFrame, price_names=("close", "close_price"), source_id=None, start=None, end=None) -> DataFrame:
    """Priced rows in a date range with exclusive end; versions are used as they are."""
    rows = business_range(where_equal(facts, data_source_id=source_id), start, end, end_inclusive=False)
    return (
        rows.select("asset_id", "business_date", "system_date", "ingest_id", price(rows, *price_names).alias("_close"))
        .where(F.col("_close").isNotNull() & F.col("asset_id").isNotNull())
    )


def series_returns(series: DataFrame) -> DataFrame:
    """Adds ``time_step`` and the simple ``return`` on the previous row; null after a zero price."""
    with_lag = with_previous(series, "_close")
    return with_lag.withColumn("return", simple_return(F.col("_close"), F.col("previous")))


def series_statistics(series: DataFrame) -> DataFrame:
    """Per asset: count, first, last, average, percent change, volatility of returns; one read and one shuffle of the rows.

    A cell (see ``ordering``) keeps its first and last close and the moments of the returns inside it; the return from one
    cell to the next is added between them. Volatility is 0 for a single return and null for none.
    """
    window = in_cell("asset_id")
    placed = with_cells(series).withColumns({"_inside": F.row_number().over(window), "_lag": F.lag("_close").over(window)})
    inner = simple_return(F.col("_close"), F.col("_lag"))
    cells = placed.withColumn("_return", inner).groupBy("asset_id", *CELL).agg(
        F.count("_close").alias("_n"), F.avg("_close").alias("_mean"), F.min_by("_close", "_inside").alias("_first"), F.max_by("_close", "_inside").alias("_last"),
        F.count("_return").alias("_returns"), F.coalesce(F.avg("_return"), F.lit(0.0)).alias("_mean_return"),
        F.coalesce(F.var_pop("_return") * F.count("_return"), F.lit(0.0)).alias("_squares"),
    )
    asset = Window.partitionBy("asset_id")
    joined = cells.withColumn("_step", simple_return(F.col("_first"), F.lag("_last").over(over_cells("asset_id"))))
    steps = F.col("_step").isNotNull().cast("long")
    merged = joined.withColumns({
        "_all": F.sum(F.col("_returns") + steps).over(asset),
        "_sum": F.sum(F.col("_returns") * F.col("_mean_return") + F.coalesce("_step", F.lit(0.0))).over(asset),
    }).withColumn("_mean_all", F.try_divide(F.col("_sum"), F.col("_all")))
    from_mean, step_from_mean = F.col("_mean_return") - F.col("_mean_all"), F.col("_step") - F.col("_mean_all")
    grouped = merged.groupBy("asset_id").agg(
        F.sum("_n").alias("count"),
        F.min_by("_first", F.struct(*CELL)).alias("first"),
        F.max_by("_last", F.struct(*CELL)).alias("last"),
        (F.sum(F.col("_n") * F.col("_mean")) / F.sum("_n")).alias("average"),
        F.first("_all").alias("_returns"),
        F.sum(F.col("_squares") + F.col("_returns") * from_mean * from_mean + F.coalesce(step_from_mean * step_from_mean, F.lit(0.0))).alias("_squares"),
    )
    return grouped.select(
        "asset_id", "count", "first", "last", "average",
        percent_change(F.col("first"), F.col("last")).alias("percent_change"),
        F.when(F.col("_returns") == 1, 0.0).when(F.col("_returns") > 1, F.sqrt(F.col("_squares") / (F.col("_returns") - 1))).alias("volatility"),
    )


def daily_closes(series: DataFrame) -> DataFrame:
    """One close per (asset, date), the last row of the date: at most one row per calendar day."""
    return top_versions(series, ["asset_id", "business_date"], newest()).select("asset_id", "business_date", "_close")


def pair_correlations(series: DataFrame, pairs: DataFrame) -> DataFrame:
    """Pearson correlation on common dates and the number of those, per (asset_a, asset_b).

    Null with fewer than two common dates or without variance on a side. Each pair reads at
    most one row per calendar day of each side, so the work is pairs times days.
    """
    closes = daily_closes(series)
    a = closes.select(F.col("asset_id").alias("asset_a"), "business_date", F.col("_close").alias("_a"))
    b = closes.select(F.col("asset_id").alias("asset_b"), "business_date", F.col("_close").alias("_b"))
    both = pairs.join(a, "asset_a").join(b, ["asset_b", "business_date"])
    spread = F.stddev_pop("_a") * F.stddev_pop("_b")
    return both.groupBy("asset_a", "asset_b").agg(
        F.when(F.count("_a") >= 2, ratio(F.covar_pop("_a", "_b"), spread)).alias("correlation"),
        F.count("_a").alias("overlap_days"),
    )


def compare_pairs(
    facts: DataFrame, pairs: DataFrame | Sequence[tuple[str, str]], price_names=("close", "close_price"), source_id=None,
    start=None, end=None,
) -> DataFrame:
    """Statistics of both assets, correlation and overlap, one row per (asset_a, asset_b).

    An asset without priced rows has count 0 and no other statistics. Listed pairs filter
    the scan; a table of pairs cuts the series to its assets before anything is computed.
    """
    cut = isinstance(pairs, DataFrame)
    if not cut:
        facts = where_in(facts, "asset_id", sorted({asset for pair in pairs for asset in pair}))
        pairs = facts.sparkSession.createDataFrame(list(pairs), "asset_a string, asset_b string")
    wanted = pairs.select("asset_a", "asset_b").distinct()
    series = priced_series(facts, price_names, source_id, start, end)
    if cut:
        assets = wanted.select(F.col("asset_a").alias("asset_id")).union(wanted.select("asset_b")).distinct()
        series = where_in(series, "asset_id", assets)
    stats = series_statistics(series)
    names = ["count", "first", "last", "average", "percent_change", "volatility"]

    def side(letter: str) -> DataFrame:
        return stats.select(
            F.col("asset_id").alias(f"asset_{letter}"), F.struct(*names).alias(f"stats_{letter}")
        )

    joined = wanted.join(side("a"), "asset_a", "left").join(side("b"), "asset_b", "left")
    joined = joined.join(pair_correlations(series, wanted), ["asset_a", "asset_b"], "left")
    none = F.struct(F.lit(0).cast("long").alias("count"), *(F.lit(None).cast("double").alias(n) for n in names[1:]))
    return joined.select(
        "asset_a", "asset_b",
        F.coalesce("stats_a", none).alias("stats_a"), F.coalesce("stats_b", none).alias("stats_b"),
        "correlation", F.coalesce("overlap_days", F.lit(0).cast("long")).alias("overlap_days"),
    )

"""Distinct assets of any window of days from one mergeable sketch a day.

A sketch has a fixed size, whatever number of assets it has seen, and the union of the sketches of some days is the sketch of all their
rows. So a window reads a row for each day instead of all facts of the window.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: a sketch has 2 ** LG_K registers
LG_K = 12


def relative_error(lg_k: int = LG_K) -> float:
    """The standard deviation of an estimate, as a part of the true count."""
    return 1.04 / math.sqrt(2**lg_k)


def daily_sketches(facts: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """Per business date: its rows and the sketch of its assets. Rows without a date do not count; rows without an asset count as rows."""
    dated = facts.where(F.col("business_date").isNotNull())
    return dated.groupBy("business_date").agg(
        F.hll_sketch_agg("asset_id", lg_k).alias("asset_sketch"), F.count(F.lit(1)).alias("record_count"),
    ).withColumn("business_month", F.trunc("business_date", "month"))


def window_ends(days: int) -> Column:
    """The last dates of the windows of ``days`` days that a business date belongs to."""
    return F.explode(F.sequence("business_date", F.date_add("business_date", days - 1)))


def sketched_windows(daily: DataFrame, days: int = 30) -> DataFrame:
    """For every window of ``days`` days that ends on a date of the table: its rows and the estimate of its distinct assets.

    A day is copied to its windows, so the work is dates times days, and sketches are united below the shuffle.
    """
    ends = daily.select(F.col("business_date").alias("end_date")).distinct()
    copied = daily.select(window_ends(days).alias("end_date"), "asset_sketch", "record_count")
    united = copied.groupBy("end_date").agg(
        F.hll_sketch_estimate(F.hll_union_agg("asset_sketch")).alias("asset_estimate"), F.sum("record_count").alias("record_count"),
    )
    return united.join(ends, "end_date", "left_semi")


def counted_windows(facts: DataFrame, days: int = 30) -> DataFrame:
    """The same windows with their exact numbers of distinct assets; an asset is one row a day before it is copied to windows."""
    present = facts.where(F.col("business_date").isNotNull()).select("business_date", "asset_id").distinct()
    ends = present.select(F.col("business_date").alias("end_date")).distinct()
    counted = present.select("asset_id", window_ends(days).alias("end_date")).groupBy("end_date").agg(F.countDistinct("asset_id").alias("asset_count"))
    return counted.join(ends, "end_date", "left_semi")

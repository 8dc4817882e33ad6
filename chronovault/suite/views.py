"""The driver's tables seen as facts, assets and sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.metrics import metric_keys


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tagged(prefix: str, column: str | Column) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return F.concat(F.lit(prefix), c.cast("string"))


def facts_from_events(events: DataFrame) -> DataFrame:
    """Error events are markers, the others price rows; columns nobody asks for are pruned."""
    deleted = F.col("event_type") == "error"
    volume = F.get_json_object("props", "$.k").cast("double")
    metrics = F.when(deleted, F.create_map().cast("map<string,double>")).otherwise(
        F.create_map(F.lit("close_price"), F.col("value"), F.lit("volume"), volume)
    )
    return events.select(
        tagged("U", "user_id").alias("asset_id"),
        tagged("S", (F.col("event_id") % 3) * 60).alias("data_source_id"),
        F.col("ts").cast("date").alias("business_date"),
        F.date_trunc("second", F.col("ts").cast("timestamp")).alias("system_date"),
        metrics.alias("metrics"),
        metric_keys(metrics).alias("attributes"),
        F.when(~deleted, F.col("value")).alias("close_price"),
        F.lit(None).cast("double").alias("close"),
        F.when(~deleted, volume).alias("volume"),
        F.col("event_id").cast("string").alias("ingest_id"),
        F.when(deleted, F.lit(True)).alias("deleted"),
        "event_type", "event_id",
    )


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts_from_events(table(spark, sf_dir, "events"))


def facts_l(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as price rows. They have no unique key, so no version is ever picked from them."""
    price = F.try_divide("l_extendedprice", "l_quantity")
    return table(spark, sf_dir, "lineitem").select(
        tagged("P", "l_partkey").alias("asset_id"),
        tagged("S", "l_suppkey").alias("data_source_id"),
        F.col("l_shipdate").cast("date").alias("business_date"),
        F.when(F.col("l_returnflag") != "R", price).alias("close_price"),
        F.when(F.col("l_returnflag") != "A", price + 1).alias("close"),
        F.col("l_quantity").alias("volume"),
    )


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = table(spark, sf_dir, "supplier").join(
        table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    return joined.select(
        tagged("S", "s_suppkey").alias("data_source_id"),
        F.col("s_name").alias("display_name"),
        F.array(F.lit("business_date"), F.lit("close_price")).alias("attributes"),
        tagged("V", "s_nationkey").alias("vendor_id"),
        F.col("n_name").alias("vendor_name"),
        tagged("Region ", "n_regionkey").alias("vendor_description"),
    )


def assets_l(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        tagged("P", "p_partkey").alias("asset_id"), F.col("p_brand").alias("asset_type"),
        F.col("p_name").alias("description"), F.col("p_type").alias("instrument_class"),
    )


def assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        tagged("U", "c_custkey").alias("asset_id"), F.col("c_mktsegment").alias("asset_type"),
        F.col("c_name").alias("description"), tagged("N", "c_nationkey").alias("instrument_class"),
    )


def asset_ids(facts_df: DataFrame) -> DataFrame:
    return facts_df.select("asset_id").distinct()

"""Incremental ingest: append-only versions with an idempotent id are a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from .. import schemas
from ..functions.metrics import price
from ..operators.statistics import yearly_totals
from ..plans.runs import store_batch, table_paths
from ..session import materialise
from ..sources.tables import append_facts, current_version, read_facts, read_table, replace_table, upsert_partitions


def dedupe_stream(facts: DataFrame, delay: str | None = None) -> DataFrame:
    """Drops copies of an ingest_id that arrive within ``delay`` of each other, before the sink.

    The state holds the ids of that span only. Rows whose system date is older than the
    watermark are dropped by Spark, so give a delay only where the system date is the
    arrival time. Without one the stream passes unchanged and the sink alone keeps one row
    per id, whatever the order of arrival.
    """
    if delay is None:
        return facts
    return facts.withWatermark("system_date", delay).dropDuplicatesWithinWatermark(["ingest_id"])


def _each_batch(stream: DataFrame, write: Callable[[DataFrame], None], checkpoint: str, **trigger) -> StreamingQuery:
    def stored(batch: DataFrame, _: int) -> None:
        # the sinks read the batch several times; a lost block is recomputed from the source
        batch.persist()
        try:
            if not batch.isEmpty():  # a micro-batch may only move the watermark
                write(batch)
        finally:
            batch.unpersist()

    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(stored)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def stream_facts(
    spark: SparkSession, facts: DataFrame, path: str, checkpoint: str, delay: str | None = None, **trigger
) -> StreamingQuery:
    """Appends a stream of facts, exactly one row per ingest_id.

    A micro-batch that is retried after a failure finds its ids stored and adds nothing.
    """
    return _each_batch(dedupe_stream(facts, delay), lambda b: append_facts(spark, b, path), checkpoint, **trigger)


def stream_batches(
    spark: SparkSession, batches: DataFrame, root: str, checkpoint: str, delay: str | None = None, **trigger
) -> StreamingQuery:
    """Appends facts with metadata and logs the dimension changes of each micro-batch."""
    return _each_batch(dedupe_stream(batches, delay), lambda b: store_batch(spark, b, root), checkpoint, **trigger)


def stream_totals(spark: SparkSession, facts: DataFrame, root: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Stores a stream of facts below ``root`` and keeps the stored totals equal to the totals of the stored facts.

    A micro-batch renews the (asset, year) totals it touches from the store, so a fact that is delivered twice counts once
    and a micro-batch that is retried changes nothing.
    """
    paths = table_paths(root)

    def renew(batch: DataFrame) -> None:
        append_facts(spark, batch, paths["facts"])
        touched = batch.select("asset_id", F.year("business_date").alias("business_date_year")).where("business_date_year IS NOT NULL").distinct()
        # one value per calendar year
        years = sorted(r[0] for r in touched.select("business_date_year").distinct().collect())
        if not years:
            return
        # months of the touched years alone, also where they lie far apart
        in_years = F.year("business_month").isin(years)
        stored = read_facts(spark, paths["facts"], f"{years[0]}-01-01", f"{years[-1]}-12-31").where(in_years)
        stored = stored.withColumn("business_date_year", F.year("business_date")).join(touched, ["asset_id", "business_date_year"], "left_semi")
        fresh = yearly_totals(stored.drop("business_date_year"))
        version = current_version(spark, paths["totals"])
        kept = read_table(spark, paths["totals"], schemas.TOTALS).join(touched, ["asset_id", "business_date_year"], "left_anti")
        replace_table(kept.select(*schemas.TOTALS.names).unionByName(fresh), paths["totals"], version)

    return _each_batch(facts, renew, checkpoint, **trigger)


def running_totals(facts: DataFrame, delay: str | None = None) -> DataFrame:
    """The yearly totals of a stream as two chained stateful steps: ids seen, and count, least, most and sum by (asset, year).

    In update mode a micro-batch gives the groups it changed, whole. Without ``delay`` every id is remembered, which a state store on
    disk can hold for as long as the stream's ids fit it; with one, ids of that span, and rows older than the watermark do not count.
    """
    once = facts.dropDuplicates(["ingest_id"]) if delay is None else dedupe_stream(facts, delay)
    priced = once.select(
        "asset_id", F.year("business_date").alias("business_date_year"), price(once, "close_price", "close").alias("_close"),
    ).where("asset_id IS NOT NULL AND business_date_year IS NOT NULL AND _close IS NOT NULL")
    return priced.groupBy("asset_id", "business_date_year").agg(
        F.count("_close").alias("record_count"), F.min("_close").alias("min_close_price"), F.max("_close").alias("max_close_price"),
        (F.sum("_close") / F.count("_close")).alias("average_close_price"),
    )


def stream_running_totals(facts: DataFrame, path: str, checkpoint: str, delay: str | None = None, **trigger) -> StreamingQuery:
    """Keeps the totals table at ``path``, partitioned by year, up with a stream of facts.

    Totals come from the stream's state, so no fact is read again, and a micro-batch writes the years it touches alone. A
    micro-batch that is retried gives the same groups and puts them in the same place.
    """
    def place(batch: DataFrame, _: int) -> None:
        changed = materialise(batch.sparkSession, batch, "changed-totals")
        upsert_partitions(changed, path, schemas.TOTALS, ["asset_id", "business_date_year"], "business_date_year")

    writer = running_totals(facts, delay).writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(place)
    return writer.trigger(**(trigger or {"availableNow": True})).start()

"""Streaming ingest and totals, run to the end and read back as tables."""

from __future__ import annotations

from ..functions.metrics import provenance
from ..plans.runs import read_assets, table_paths
from ..schemas import FACTS, TOTALS
from ..session import scratch_path
from ..sources.tables import read_facts, read_table
from ..streaming import ingest
from . import views as v
from .aggregates import rounded_totals
from .registry import ntz, oracle, query, sql_r6
from .sinks import ASSET_DIM_SQL, describe, shown_assets


def event_stream(spark, sf):
    """The events table as a file stream; the pattern matches a single file as well as a folder."""
    schema = v.table(spark, sf, "events").schema
    return v.facts_from_events(spark.readStream.schema(schema).parquet(f"{sf}/events.parque[t]"))


@query("stm1_stream_dedupe", oracle("facts", body="""
    SELECT asset_id, business_date, system_date, ingest_id, close_price FROM facts"""))
def stm1(spark, sf):
    """Every event is streamed twice, and the whole stream is then replayed from the start."""
    target = scratch_path(spark, "facts")
    once = event_stream(spark, sf).withColumn("provenance", provenance()).select(*FACTS.names)
    for attempt in ("first", "replay"):
        checkpoint = scratch_path(spark, f"checkpoint-{attempt}")
        ingest.stream_facts(spark, once.unionByName(once), target, checkpoint).awaitTermination()
    return read_facts(spark, target).select("asset_id", "business_date", ntz("system_date"), "ingest_id", "close_price")


@query("stm1_stateful_dedupe", oracle("facts", body="""
    SELECT asset_id, business_date, system_date, ingest_id, close_price FROM facts"""))
def stm1_stateful(spark, sf):
    """Every event is streamed twice; the watermark step drops the copies before the sink sees them."""
    target = scratch_path(spark, "facts")
    once = event_stream(spark, sf).withColumn("provenance", provenance()).select(*FACTS.names)
    ingest.stream_facts(spark, once.unionByName(once), target, scratch_path(spark, "checkpoint"), "400 days").awaitTermination()
    return read_facts(spark, target).select("asset_id", "business_date", ntz("system_date"), "ingest_id", "close_price")


@query("stm2_stream_dims", oracle("facts", body=ASSET_DIM_SQL))
def stm2(spark, sf):
    root = scratch_path(spark, "warehouse")
    batches = describe(event_stream(spark, sf).withColumn("provenance", provenance()))
    rows = batches.select(*FACTS.names, "asset_metadata", "source_metadata")
    ingest.stream_batches(spark, rows, root, scratch_path(spark, "checkpoint")).awaitTermination()
    return shown_assets(read_assets(spark, root))


@query("stm3_stream_totals", oracle("totals", body=f"""
    SELECT asset_id, business_date_year, record_count, min_close_price, max_close_price,
           {sql_r6('average_close_price')} AS average_close_price FROM totals"""))
def stm3(spark, sf):
    """Every event is streamed twice and counts once."""
    root = scratch_path(spark, "warehouse")
    once = event_stream(spark, sf).withColumn("provenance", provenance()).select(*FACTS.names)
    ingest.stream_totals(spark, once.unionByName(once), root, scratch_path(spark, "checkpoint")).awaitTermination()
    return rounded_totals(read_table(spark, table_paths(root)["totals"], TOTALS))


@query("stm3_running_totals", oracle("totals", body=f"""
    SELECT asset_id, business_date_year, record_count, min_close_price, max_close_price,
           {sql_r6('average_close_price')} AS average_close_price FROM totals"""))
def stm3_running(spark, sf):
    """Every event is streamed twice and counts once; totals come from the stream's state."""
    path = scratch_path(spark, "running-totals")
    once = event_stream(spark, sf)
    ingest.stream_running_totals(once.unionByName(once), path, scratch_path(spark, "checkpoint")).awaitTermination()
    return rounded_totals(read_table(spark, path, TOTALS))

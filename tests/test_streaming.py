import pytest
from pyspark.sql import functions as F

from chronovault import schemas
from chronovault.operators.statistics import yearly_totals
from chronovault.plans import runs
from chronovault.sources import tables
from chronovault.streaming import ingest
from tests.helpers import facts, rows

FIRST = [
    ("A", "S", "2024-01-01", "2024-01-01 10:00:00", {"close_price": 1.0}, "1"),
    ("A", "S", "2024-01-01", "2024-01-01 10:00:00", {"close_price": 1.0}, "1"),
    ("A", "S", "2024-01-02", "2024-01-02 10:00:00", {"close_price": 2.0}, "2"),
]
LATE = [
    ("A", "S", "2024-01-01", "2024-01-01 10:00:00", {"close_price": 1.0}, "1"),  # older than the watermark
    ("B", "S", "2025-01-09", "2025-01-09 10:00:00", {"close_price": 3.0}, "3"),
]


NEW_BUT_OLD = [("C", "S", "2023-01-01", "2023-01-01 10:00:00", {"close_price": 4.0}, "4")]


@pytest.mark.parametrize("delay,ids", [(None, "1234"), ("1 hour", "123")])
def test_each_id_is_stored_once_across_files_and_restarts(spark, tmp_path, delay, ids):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "facts", "checkpoint"))
    for batch in (FIRST, LATE, FIRST + LATE, NEW_BUT_OLD):
        facts(spark, batch).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schemas.FACTS).parquet(source)
        ingest.stream_facts(spark, stream, target, checkpoint, delay).awaitTermination()
    assert rows(tables.read_facts(spark, target), "ingest_id") == [(i,) for i in ids]


def test_totals_follow_the_stream(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "totals", "checkpoint"))
    for batch in (FIRST, LATE):
        facts(spark, batch).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schemas.FACTS).parquet(source)
        ingest.stream_totals(spark, stream, target, checkpoint).awaitTermination()
        whole = yearly_totals(spark.read.schema(schemas.FACTS).parquet(source).dropDuplicates(["ingest_id"]))
        assert rows(tables.read_table(spark, runs.table_paths(target)["totals"], schemas.TOTALS)) == rows(whole)


def test_a_failing_sink_lets_the_batch_go(spark, tmp_path):
    facts(spark, FIRST).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schemas.FACTS).parquet(str(tmp_path / "in"))

    def fail(_):
        raise ValueError("sink")

    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    with pytest.raises(Exception, match="sink"):
        ingest._each_batch(stream, fail, str(tmp_path / "checkpoint")).awaitTermination()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_dimensions_follow_the_stream(spark, tmp_path):
    source, root, checkpoint = (str(tmp_path / n) for n in ("in", "warehouse", "checkpoint"))
    schema = spark.createDataFrame([], schemas.FACTS).withColumns({
        "asset_metadata": F.lit(None).cast(schemas.ASSET_METADATA), "source_metadata": F.lit(None).cast(schemas.SOURCE_METADATA),
    }).schema
    for n, batch in enumerate((FIRST, LATE)):
        described = facts(spark, batch).withColumns({
            "asset_metadata": F.struct(F.lit(f"type {n}").alias("asset_type"), *(F.lit(None).cast("string").alias(c) for c in schemas.ASSET_METADATA.names[1:])),
            "source_metadata": F.lit(None).cast(schemas.SOURCE_METADATA),
        })
        described.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        ingest.stream_batches(spark, stream, root, checkpoint).awaitTermination()
    assert rows(runs.read_assets(spark, root), "asset_id", "asset_type") == [("A", "type 0"), ("B", "type 1")]
    assert rows(runs.read_sources(spark, root), "data_source_id", "display_name") == [("S", "S")]


@pytest.mark.parametrize("delay", [None, "4000 days"])
def test_running_totals_rewrite_only_the_years_they_touch(spark, tmp_path, delay):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "totals", "checkpoint"))
    files = lambda year: sorted(p.name for p in (tmp_path / "totals" / f"business_date_year={year}").glob("*.parquet"))
    before = None
    for batch in (FIRST, LATE, FIRST + LATE, NEW_BUT_OLD + [("A", "S", "2025-03-01", "2024-02-02 10:00:00", {}, "5")]):
        facts(spark, batch).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schemas.FACTS).parquet(source)
        ingest.stream_running_totals(stream, target, checkpoint, delay).awaitTermination()
        whole = yearly_totals(spark.read.schema(schemas.FACTS).parquet(source).dropDuplicates(["ingest_id"]))
        assert rows(tables.read_table(spark, target, schemas.TOTALS)) == rows(whole)
        if before is not None:
            assert files(2024) == before  # batches after the first have nothing new of 2024
        before = files(2024)
    assert files(2023) and files(2025)

import json

import pytest
from pyspark.sql import functions as F

from chronovault.operators import deletes, dimensions
from chronovault.plans import runs
from chronovault.sources import tables
from tests.helpers import at, day, facts, rows

ROWS = [
    ("A", "S", "2024-01-30", "2024-02-01 10:00:00", {"close_price": 1.0}, "1"),
    ("A", "S", "2024-02-02", "2024-02-02 10:00:00", {"close": 2.0}, "2"),
    ("B", "S", "2024-03-02", "2024-03-02 10:00:00", {}, "3"),
    ("B", "S", None, "2024-03-02 10:00:00", {}, "4", True),
]


def test_append_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "facts")
    batch = facts(spark, ROWS)
    assert tables.read_facts(spark, path).count() == 0
    tables.append_facts(spark, batch.unionByName(batch), path)
    tables.append_facts(spark, batch, path)
    extra = facts(spark, [("A", "S", "2024-01-30", "2024-02-05", {"close_price": 5.0}, "5")])
    tables.append_facts(spark, batch.unionByName(extra), path)
    stored = tables.read_facts(spark, path)
    assert rows(stored, "ingest_id", "close_price", "close") == [
        ("1", 1.0, None), ("2", None, 2.0), ("3", None, None), ("4", None, None), ("5", 5.0, None),
    ]


def test_the_first_copy_wins(spark):
    copies = facts(spark, [("A", "S", "2024-01-01", f"2024-01-0{i}", {}, "same") for i in (3, 1, 2)])
    kept = tables.new_facts(copies, facts(spark, ROWS))
    assert rows(kept, "system_date") == [(at("2024-01-01"),)]


def test_reads_prune_months(spark, tmp_path):
    path = str(tmp_path / "facts")
    tables.append_facts(spark, facts(spark, ROWS), path)
    ranged = tables.read_facts(spark, path, "2024-01-31", "2024-02-28")
    assert rows(ranged, "ingest_id") == [("2",)]
    plan = ranged._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(business_month" in plan


def test_stored_files_are_balanced_and_sorted(spark, tmp_path):
    rows_in = facts(spark, [(a, "S", "2024-01-01", "2024-01-01", {}, f"{a}{i}") for i in range(9) for a in "CAB"])
    layout = tables.stored_layout(tables.to_stored(rows_in))
    assert "REBALANCE_PARTITIONS_BY_COL" in layout._jdf.queryExecution().executedPlan().toString()
    tables.append_facts(spark, rows_in, str(tmp_path / "facts"))
    order = [r.asset_id for r in spark.read.parquet(str(tmp_path / "facts")).coalesce(1).collect()]
    assert order == sorted(order) and len(order) == 27


def test_a_missing_ingest_id_fails(spark, tmp_path):
    bad = facts(spark, [("A", "S", "2024-01-01", "2024-01-01", {}, None)])
    with pytest.raises(Exception, match="ingest_id"):
        tables.append_facts(spark, bad, str(tmp_path / "facts"))


def test_markers(spark):
    keys = spark.createDataFrame([("A", "S", day("2024-01-01"))], "asset_id string, data_source_id string, business_date date")
    now = F.lit("2024-05-01 01:02:03.9").cast("timestamp")
    r = deletes.delete_markers(keys, now).collect()[0]
    assert (r.deleted, r.metrics, r.provenance.reason, r.system_date) == (True, {}, "soft delete marker", at("2024-05-01 01:02:03"))
    r = deletes.partition_markers(keys.drop("business_date"), now).collect()[0]
    assert (r.business_date, r.provenance.reason) == (None, "bulk soft delete marker")
    requests = spark.createDataFrame([(" a ", None), ("b", "T"), ("", None)], "asset_id string, source_id string")
    first, again = (deletes.asset_delete_markers(requests, n) for n in (now, F.lit("2024-05-01 09:00:00").cast("timestamp")))
    assert rows(first, "asset_id", "data_source_id", "business_date") == [
        ("A", "SYSTEM.DELETE", day("2024-05-01")), ("B", "T", day("2024-05-01")),
    ]
    assert tables.new_facts(again, first).count() == 0


def with_metadata(spark, entries):
    """Entries of (asset, source, system date, asset metadata, source metadata)."""
    schema = (
        "asset_id string, data_source_id string, system_date string, "
        "asset_metadata struct<asset_type:string,description:string,region:string,instrument_class:string>, "
        "source_metadata struct<display_name:string,description:string,attributes:array<string>,"
        "vendor_id:string,vendor_name:string,vendor_description:string>"
    )
    return spark.createDataFrame(entries, schema).withColumn("system_date", F.col("system_date").cast("timestamp"))


def test_asset_dimension_is_last_writer_wins(spark):
    first = with_metadata(spark, [
        ("A", "S", "2024-01-01", ("t1", "d1", "r1", None), ("n1", "x", ["b", "a"], "V1", "Vendor 1", "about")),
        ("A", "S", "2024-01-03", ("t2", "", None, None), ("n2", "x", ["c"], None, "ignored", None)),
    ])
    later = with_metadata(spark, [("A", "S", "2024-01-05", (None, "d3", None, "c3"), ("n3", None, ["a"], "V3", None, None)),
                                  ("B", "S", "2024-01-05", None, None)])
    assets = dimensions.merge_assets(dimensions.merge_assets(None, first), later)
    a, b = sorted(assets.collect(), key=lambda r: r.asset_id)
    assert (a.first_seen, a.last_seen, a.active) == (at("2024-01-01"), at("2024-01-05"), True)
    assert (a.asset_type, a.description, a.region, a.instrument_class) == ("t2", "d3", "r1", "c3")
    assert (a.primary_vendor_id, a.primary_vendor_name, a.primary_vendor_description) == ("V3", None, None)
    assert a.supported_indicators == ["a", "b", "c"] and b.supported_indicators == []
    off = dimensions.deactivate_assets(assets, spark.createDataFrame([("A",), ("X",)], "asset_id string"), F.lit("2024-02-01").cast("timestamp"))
    assert rows(off, "asset_id", "active") == [("A", False), ("B", True)]
    revived = dimensions.merge_assets(off, with_metadata(spark, [("A", "S", "2024-03-01", None, None)]))
    assert ("A", True, "d3") in rows(revived, "asset_id", "active", "description")


def test_source_dimension_is_first_writer_wins(spark):
    first = with_metadata(spark, [("A", "S", "2024-01-02", None, ("n1", None, ["a"], "V1", None, None))])
    earlier = with_metadata(spark, [("A", "S", "2024-01-01", None, ("n0", "d0", ["z"], "V0", "x", "y")),
                                    ("A", "T", "2024-01-01", None, None)])
    sources = dimensions.merge_sources(dimensions.merge_sources(None, first), earlier)
    s, t = sorted(sources.collect(), key=lambda r: r.data_source_id)
    assert (s.display_name, s.description, s.attributes, s.vendor_id) == ("n1", None, ["a"], "V1")
    assert (t.display_name, t.attributes, t.active) == ("T", [], True)


def test_migration(spark):
    legacy = spark.createDataFrame([("2024-01-01T10:00:00Z",), ("2024-01-01T10:00:00.5+01:00",), ("soon",), (None,)], "system_date string")
    migrated = tables.migrate_system_dates(legacy)
    assert rows(tables.migration_report(migrated)) == [("migrated", 2), ("unparseable", 2)]
    assert rows(migrated.where("status = 'migrated'"), "system_date") == [(at("2024-01-01 09:00:00"),), (at("2024-01-01 10:00:00"),)]


def test_json(spark):
    table = facts(spark, ROWS[:1]).withColumn("_id", F.lit("x"))
    r = json.loads(tables.as_json(table).collect()[0].json)
    assert r["system_date"] == "2024-02-01T10:00:00Z" and r["business_date"] == "2024-01-30"
    assert r["metrics"] == {"close_price": 1.0} and r["deleted"] is None and "_id" not in r


def test_export_window(spark):
    table = facts(spark, [
        ("T", "S", "2026-06-01", "2026-06-01", {"close": 100.0}, "1"), ("T", "S", "2026-06-02", "2026-06-02", {"close": 110.0}, "2"),
        ("T", "S", "2026-05-31", "2026-06-02", {"close": 110.0}, "3"),
    ])
    assert rows(tables.export_window(table, "2026-06-02", 2), "ingest_id") == [("1",), ("2",)]
    assert rows(tables.export_summary(table, "2026-06-02", 2)) == [(day("2026-06-01"), day("2026-06-02"), 1, 2)]


def test_replace(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.replace_table(spark.range(5), path)
    tables.replace_table(spark.range(2), path)
    read = lambda: rows(tables.read_table(spark, path, "id long"))
    assert read() == [(0,), (1,)]
    with pytest.raises(Exception, match="no more"):
        tables.replace_table(spark.range(9).select(F.when(F.col("id") < 8, F.col("id")).otherwise(F.raise_error(F.lit("no more"))).alias("id")), path)
    assert read() == [(0,), (1,)]
    tables.append_rows(spark.range(5, 6), path)
    assert read() == [(0,), (1,), (5,)]
    tables.replace_table(tables.read_table(spark, path, "id long").where("id > 0"), path)
    assert read() == [(1,), (5,)]


def test_no_replacement_is_lost(spark, tmp_path):
    path = str(tmp_path / "t")
    read = lambda: rows(tables.read_table(spark, path, "id long"))
    folders = lambda: sum(p.name.startswith("version-") for p in (tmp_path / "t").iterdir())
    tables.replace_table(spark.range(1), path, None)
    seen = tables.current_version(spark, path)
    tables.replace_table(spark.range(2), path, seen)
    for stale in (seen, None):
        with pytest.raises(tables.StaleTable):
            tables.replace_table(spark.range(3), path, stale)
    with pytest.raises(tables.StaleTable):  # another writer took the next number meanwhile
        tables._point_to(spark, path, "version-late", 2)
    assert read() == [(0,), (1,)] and folders() == 2
    assert not [p for p in (tmp_path / "t").iterdir() if p.name.startswith("_pointer")]


def test_versions_are_kept_for_their_readers(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.replace_table(spark.range(1), path)
    first = tables.read_table(spark, path, "id long")
    for n in (2, 3, 4):
        tables.replace_table(spark.range(n), path)
    assert first.count() == 1 and tables.read_table(spark, path, "id long").count() == 4
    tables.replace_table(spark.range(5), path, kept_seconds=0)
    assert tables.read_table(spark, path, "id long").count() == 5
    left = sorted(p.name[:8] for p in (tmp_path / "t").iterdir() if not p.name.startswith("."))
    assert left == ["_current", "version-"]


def test_rows_appended_while_a_table_is_replaced_stay(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    tables.replace_table(spark.range(1), path)
    old, current = tables.current_version(spark, path), tables.current_version
    tables.replace_table(spark.range(2), path)
    given = iter([old])
    monkeypatch.setattr(tables, "current_version", lambda *a: next(given, None) or current(*a))
    tables.append_rows(spark.range(7, 8), path)
    assert rows(tables.read_table(spark, path, "id long")) == [(0,), (1,), (7,)]


def landed(spark, price, hour, row=0):
    return facts(spark, [("A", "S", "2024-01-30", f"2024-02-01 {hour:02d}:00:00", {"close": price}, f"{price}-{hour}")])


def test_a_price_that_comes_back_is_a_version(spark, tmp_path):
    path = str(tmp_path / "facts")
    for price, hour in ((100.0, 1), (105.0, 2), (105.0, 2), (100.0, 3), (100.0, 4)):
        tables.append_facts(spark, landed(spark, price, hour), path, skip_unchanged=True)
    assert rows(tables.read_facts(spark, path), "ingest_id") == [("100.0-1",), ("100.0-3",), ("105.0-2",)]


def test_unchanged_rows_of_one_batch(spark, tmp_path):
    path = str(tmp_path / "facts")
    batch = landed(spark, 1.0, 1).unionByName(landed(spark, 1.0, 2)).unionByName(landed(spark, 2.0, 3)).unionByName(landed(spark, 1.0, 4))
    tables.append_facts(spark, batch, path, skip_unchanged=True)
    assert rows(tables.read_facts(spark, path), "ingest_id") == [("1.0-1",), ("1.0-4",), ("2.0-3",)]


def test_analytics_of_some_assets_leave_the_others_alone(spark, tmp_path):
    root = str(tmp_path)
    prices = [(a, "S", f"2024-01-0{d}", f"2024-01-0{d} 10:00:00", {"close_price": float(d * k)}, f"{a}{d}") for k, a in enumerate("ABC", 1) for d in range(1, 6)]
    tables.append_facts(spark, facts(spark, prices), runs.table_paths(root)["facts"])
    everything = [rows(df.drop("calculation_time")) for df in runs.run_analytics(spark, root)]
    assert [len(x) for x in everything] == [3, 3]
    more = [("A", "S", "2024-01-09", "2024-01-09 10:00:00", {"close_price": 100.0}, "A9"), ("B", "S", "2024-01-09", "2024-01-09 10:00:00", {"close_price": 100.0}, "B9")]
    tables.append_facts(spark, facts(spark, more), runs.table_paths(root)["facts"])
    for asked in (["A"], runs.asset_frame(spark, ["A"])):
        some = [rows(df.drop("calculation_time")) for df in runs.run_analytics(spark, root, asked)]
        assert [[r for r in x if r[0] != "A"] for x in some] == [[r for r in x if r[0] != "A"] for x in everything]
        assert [len(x) for x in some] == [3, 3] and some[0][0] != everything[0][0] and some[1][0] != everything[1][0]
    nothing = [rows(df.drop("calculation_time")) for df in runs.run_analytics(spark, root, ["NONE"])]
    assert nothing == some

import os
import random
import statistics as st
from datetime import date

import pytest
from pyspark.sql import functions as F

from chronovault import schemas
from chronovault.operators import moments, sketches
from chronovault.operators.statistics import linear_trends, priced_series, series_statistics, yearly_totals
from chronovault.plans import derived, migration, runs
from chronovault.sources import tables
from tests.helpers import facts, rows


def made(seed, n=300):
    """Facts of three assets with zero, missing and repeated prices, dates of four months, some without one."""
    pick, out = random.Random(seed), []
    for i in range(n):
        month, day = pick.randint(1, 4), pick.randint(1, 28)
        metrics = pick.choice([{}, {"close": 0.0}, {"close_price": 5.0}, {"close": pick.uniform(1, 9), "close_price": pick.uniform(1, 9)}])
        when = None if pick.random() < 0.05 else f"2024-{month:02d}-{day:02d}"
        out.append((pick.choice("AAAB") if i else "C", "S", when, f"2024-05-01 {pick.randint(0, 3):02d}:00:{pick.randint(0, 59):02d}", metrics, str(seed * 1000 + i)))
    return out


def near(left, right):
    assert len(left) == len(right)
    for a, b in zip(left, right):
        assert a == pytest.approx(b, rel=1e-9, abs=1e-9)


def same(stored, full, key):
    names = [c for c in full.columns if c != "calculation_time"]
    as_dicts = lambda df: [r.asDict() for r in df.select(*names).orderBy(*key).collect()]
    left, right = as_dicts(stored), as_dicts(full)
    assert len(left) == len(right) > 0
    for a, b in zip(left, right):
        for n in names:
            assert a[n] == (pytest.approx(b[n], rel=1e-9, abs=1e-9) if isinstance(b[n], float) else b[n]), n


def test_months_give_what_the_facts_give(spark, tmp_path):
    root = str(tmp_path)
    first, second, third = (made(s) for s in (1, 2, 3))
    for part in (first, second + first[:50], [r for r in third if r[2] and r[2] < "2024-02"]):
        derived.append_and_refresh(spark, facts(spark, part), root)
    stored = tables.read_facts(spark, runs.table_paths(root)["facts"])
    months = derived.read_derived(spark, root, "moments")
    same(moments.trends_of_months(months), linear_trends(stored), ["asset_id"])
    same(moments.totals_of_months(months), yearly_totals(stored), ["asset_id", "business_date_year"])
    same(moments.statistics_of_months(months), series_statistics(priced_series(stored)), ["asset_id"])


def test_merged_parts_are_the_whole(spark):
    closes = [3.0, 0.0, 7.5, 7.5, 2.25, 9.0]
    series = facts(spark, [("A", "S", f"2024-0{1 + i // 2}-1{i}", "2024-06-01", {"close": c}, str(i)) for i, c in enumerate(closes)])
    r = moments.merged_series(moments.monthly_moments(series)).collect()[0]
    returns = [(b - a) / a for a, b in zip(closes, closes[1:]) if a]
    mean = sum(closes) / 6
    near([r.mean, r.squares, r.products], [mean, sum((c - mean) ** 2 for c in closes), sum((i - 2.5) * (c - mean) for i, c in enumerate(closes))])
    near([r.returns, r.mean_return, r.return_squares], [4, st.mean(returns), st.pvariance(returns) * 4])
    assert (r.n, r.first_close, r.last_close, r.least, r.most) == (6, 3.0, 9.0, 0.0, 9.0)


def files(folder):
    return {os.path.join(d, f) for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")}


def test_a_refresh_touches_its_months_alone(spark, tmp_path):
    root = str(tmp_path)
    derived.append_and_refresh(spark, facts(spark, made(1)), root)
    before = files(f"{root}/moments")
    derived.append_and_refresh(spark, facts(spark, [("A", "S", "2024-02-03", "2024-06-01", {"close": 1.0}, "x"), ("A", "S", None, "2024-06-01", {}, "y")]), root)
    after = files(f"{root}/moments")
    renewed = {f.split("business_month=")[1].split("/")[0] for f in before ^ after}
    assert renewed == {"2024-02-01", "__HIVE_DEFAULT_PARTITION__"}
    plan = derived.facts_of_months(spark, root, [date(2024, 2, 1)])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(business_month" in plan
    empty = facts(spark, [])
    derived.append_and_refresh(spark, empty, root)
    assert files(f"{root}/moments") == after


def test_sketched_windows(spark, tmp_path):
    root, batch = str(tmp_path), facts(spark, made(4) + [(None, "S", "2024-01-05", "2024-06-01", {}, "z")])
    derived.append_and_refresh(spark, batch, root)
    found = {r.end_date: (r.asset_estimate, r.record_count) for r in sketches.sketched_windows(derived.read_sketches(spark, root), 10).collect()}
    dated = [(r.business_date, r.asset_id) for r in batch.collect() if r.business_date]
    inside = lambda end: [a for d, a in dated if 0 <= (end - d).days < 10]
    assert found == {end: (len({a for a in inside(end) if a}), len(inside(end))) for end, _ in dated}
    assert {r.end_date: r.asset_count for r in sketches.counted_windows(batch, 10).collect()} == {e: n for e, (n, _) in found.items()}
    bounded = derived.read_sketches(spark, root, "2024-02-03", "2024-03-02")
    assert {r.business_date for r in bounded.collect()} == {d for d, _ in dated if date(2024, 2, 3) <= d <= date(2024, 3, 2)}


def test_the_estimate_is_within_its_error(spark):
    many = spark.range(20000).select(F.lit("2024-01-01").cast("date").alias("business_date"), F.col("id").cast("string").alias("asset_id"))
    days = [many.where(F.col("id") % 3 != k).withColumn("business_date", F.date_add("business_date", k)) for k in range(3)]
    daily = sketches.daily_sketches(days[0].unionByName(days[1]).unionByName(days[2]))
    for r in sketches.sketched_windows(daily, 3).collect():
        exact = 13333 if r.end_date == date(2024, 1, 1) else 20000
        assert abs(r.asset_estimate - exact) < 4 * sketches.relative_error() * exact


def test_few_stored_ids_pass_the_filter(spark, monkeypatch):
    stored = spark.range(20000).select(F.col("id").cast("string").alias("ingest_id"))
    batch = spark.range(19900, 20100).select(F.col("id").cast("string").alias("ingest_id"))
    passed = tables.possible_matches(stored, batch, ["ingest_id"])
    assert passed.join(batch, "ingest_id", "left_semi").count() == 100
    assert passed.count() <= 2 * 200 and passed.columns == ["ingest_id"]
    plan = passed._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    monkeypatch.setattr(tables, "FILTER_WORDS", 1)  # saturated: all pass, none is lost
    full = tables.possible_matches(stored, spark.range(19900, 25000).select(F.col("id").cast("string").alias("ingest_id")), ["ingest_id"])
    assert full.count() == 20000


def test_the_filter_takes_null_keys(spark):
    schema = "asset_id string, business_date date"
    stored = spark.createDataFrame([("A", None), (None, None), ("B", date(2024, 1, 1))], schema)
    assert rows(tables.possible_matches(stored, spark.createDataFrame([("A", None), (None, None)], schema), ["asset_id", "business_date"])) == [(None, None), ("A", None)]
    assert tables.possible_matches(stored, spark.createDataFrame([], schema), ["asset_id", "business_date"]).count() == 0


def legacy(spark, path):
    entries = [("A", "2024-01-02", "2024-02-01T10:00:00Z", "1"), ("A", "2024-02-02", "about noon", "2"), ("B", "2024-03-02", "2024-03-02", "3"),
               ("B", None, "2024-03-02 10:00:00", "4"), ("B", None, None, "5"), ("C", "2024-03-09", "2024-03-10", "6")]
    table = facts(spark, [(a, "S", d, None, {"close": 1.0}, i) for a, d, _, i in entries])
    texts = spark.createDataFrame([(i, t) for _, _, t, i in entries], "ingest_id string, text string")
    dated = table.drop("system_date").join(texts, "ingest_id").withColumnRenamed("text", "system_date").withColumn("business_month", F.trunc("business_date", "month"))
    dated.select(*schemas.LEGACY_FACTS.names).write.partitionBy("business_month").parquet(path)


def test_a_migration_goes_on_where_it_stopped(spark, tmp_path, monkeypatch):
    root, path = str(tmp_path / "store"), str(tmp_path / "legacy")
    legacy(spark, path)
    counts = lambda df: {(r.business_month, r.status): r["rows"] for r in df.collect()}
    dry = counts(migration.migrate_store(spark, path, root))
    assert dry == {(date(2024, 1, 1), "migrated"): 1, (date(2024, 2, 1), "unparseable"): 1, (date(2024, 3, 1), "migrated"): 2,
                   (None, "migrated"): 1, (None, "unparseable"): 1}
    assert not os.path.exists(root)
    append, calls = migration.append_facts, []

    def failing(session, batch, to):
        calls.append(rows(batch, "ingest_id"))
        if len(calls) == 3:
            raise RuntimeError("lost")
        append(session, batch, to)

    monkeypatch.setattr(migration, "append_facts", failing)
    with pytest.raises(RuntimeError):
        migration.migrate_store(spark, path, root, dry_run=False, months_at_a_time=1)
    assert len(counts(migration.migration_log(spark, root))) == 3  # the rows without a date, and January
    for _ in range(2):
        assert counts(migration.migrate_store(spark, path, root, dry_run=False, months_at_a_time=1)) == dry
    assert calls == [[("4",)], [("1",)], [], [], [("3",), ("6",)]]
    stored = tables.read_facts(spark, runs.table_paths(root)["facts"])
    assert rows(stored, "ingest_id") == [("1",), ("3",), ("4",), ("6",)]
    assert rows(migration.read_unparseable(spark, root), "ingest_id", "system_date") == [("2", "about noon"), ("5", None)]

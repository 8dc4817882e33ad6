import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from chronovault import fixed
from chronovault.operators import series
from chronovault.plans.runs import asset_frame
from chronovault.sources import tables
from tests.helpers import day, facts, in_order, metric, rows


def template(spark):
    return facts(spark, [
        ("BTCUSD", "S", bd, "2026-06-10", {"open_price": o, "close_price": c}, bd)
        for bd, o, c, _, _, _ in fixed.TEMPLATE_ROWS
    ])


def test_backfill_fixture(spark):
    assets = asset_frame(spark, ["BTCUSD"])
    made = series.backfill(template(spark), assets, "2026-06-01", "2026-06-06")
    shown = made.select("business_date", metric("close_price"), metric("current_price"), "provenance.source_name", "data_source_id")
    assert rows(shown) == [
        (day("2026-06-01"), 97150.0, 97150.0, "BACKFILL", "S"),
        (day("2026-06-02"), 97150.0, 97150.0, "BACKFILL", "S"),
        (day("2026-06-06"), 99200.0, 99200.0, "BACKFILL", "S"),
    ]
    assert rows(series.backfill_status(assets, made)) == [("BTCUSD", "ok", 3)]
    listed = series.backfill(template(spark), ["BTCUSD", "BTCUSD"], "2026-06-01", "2026-06-06")
    assert rows(listed, "ingest_id") == rows(made, "ingest_id")
    full = template(spark).unionByName(made.select(*template(spark).columns))
    again = series.backfill(full, assets, "2026-06-01", "2026-06-06")
    assert again.count() == 0
    assert rows(series.backfill_status(assets, again)) == [("BTCUSD", "noop", 0)]


def test_backfill_omits_before_deriving(spark):
    made = series.backfill(template(spark), asset_frame(spark, ["BTCUSD"]), "2026-06-06", "2026-06-06", omit=["current_price", "open_price"])
    assert made.select("metrics").collect()[0][0] == {
        "close_price": 99200.0, "current_price": 99200.0, "adjusted_close_price": 99200.0, "quoted_price": 99200.0,
    }


def test_backfill_of_an_asset_without_rows(spark):
    made = series.backfill(template(spark), asset_frame(spark, ["EURUSD"]), "2026-06-06", "2026-06-06")
    r = made.collect()[0]
    assert (r.data_source_id, r.metrics, r.attributes) == ("NASDAQ-DATA-LINK.WIKI", {}, [])


def test_backfill_source_argument_checks_only_that_source(spark):
    made = series.backfill(template(spark), asset_frame(spark, ["BTCUSD"]), "2026-06-04", "2026-06-05", source_id="T")
    assert rows(made, "business_date", "data_source_id") == [(day("2026-06-04"), "T"), (day("2026-06-05"), "T")]


def test_nearest_date_ties_markers_and_versions(spark):
    table = facts(spark, [
        ("A", "S", "2024-01-01", "2024-01-01", {"close_price": 1.0}, "1"),
        ("A", "S", "2024-01-05", "2024-01-05 10:00:00", {"close_price": 2.0}, "2"),
        ("A", "T", "2024-01-05", "2024-01-05 11:00:00", {}, "3", True),  # the newer row, a marker, is copied
    ])
    wanted = spark.createDataFrame([("A", day("2024-01-03")), ("A", day("2024-01-04")), ("B", day("2024-01-04"))], "asset_id string, business_date date")
    got = series.nearest_records(wanted, table, ["data_source_id", "ingest_id"])
    assert rows(got, "business_date", "asset_id", "nearest_date", "ingest_id") == [
        (day("2024-01-03"), "A", day("2024-01-01"), "1"),
        (day("2024-01-04"), "A", day("2024-01-05"), "3"),
        (day("2024-01-04"), "B", None, None),
    ]


def test_nearest_date_against_brute_force(spark):
    pick = random.Random(11)
    start = date(2024, 1, 1)
    have = sorted({(pick.choice("AB"), start + timedelta(days=pick.randrange(120))) for _ in range(30)})
    want = [(a, start + timedelta(days=i)) for a in "AB" for i in range(-10, 130)]
    table = facts(spark, [(a, "S", d, "2024-01-01", {}, f"{a}{d}") for a, d in have])
    got = series.nearest_records(spark.createDataFrame(want, "asset_id string, business_date date"), table, ["ingest_id"])
    expected = [
        (a, d, min((e for b, e in have if b == a), key=lambda e: (abs((e - d).days), e))) for a, d in want
    ]
    assert rows(got, "asset_id", "business_date", "nearest_date") == in_order(expected)


def test_gap_fill(spark):
    table = facts(spark, [
        ("A", "S", "2024-01-02", "2024-01-02 10:00:00", {"close_price": 2.0, "quoted_price": 9.0, "current_price": None}, "1"),
        ("A", "S", "2024-01-03", "2024-01-03 10:00:00", {"open_price": 2.0}, "2"),
        ("A", "S", "2024-01-04", "2024-01-03 10:00:00", {}, "3", True),
    ])
    filled = series.gap_fill(table, asset_frame(spark, ["A", "B"]), "2024-01-01", "2024-01-04")
    assert filled.count() == 8
    assert rows(filled.where("asset_id = 'A'"), "business_date", "open_price", "close_price", "current_price", "quoted_price") == [
        (day("2024-01-01"), None, None, None, None),
        (day("2024-01-02"), None, 2.0, 2.0, 9.0),
        (day("2024-01-03"), 2.0, None, None, None),
        (day("2024-01-04"), None, None, None, None),
    ]
    assert filled.columns == ["asset_id", "business_date", *fixed.DAILY_METRICS]


def test_gap_fill_over_a_hundred_days_keeps_the_oldest_unless_limited(spark):
    start = date(2024, 1, 1)
    table = facts(spark, [("A", "S", start + timedelta(days=i), "2024-01-01", {"close_price": float(i)}, f"{i:03d}") for i in range(150)])
    whole = series.gap_fill(table, None, "2024-01-01", "2024-05-29")
    assert whole.count() == 150 and whole.where(F.col("close_price").isNotNull()).count() == 150
    limited = series.gap_fill(table, None, "2024-01-01", "2024-05-29", limit=100)
    assert limited.count() == 150 and limited.where(F.col("close_price").isNotNull()).count() == 100


def test_ranges_are_checked(spark):
    with pytest.raises(ValueError):
        series.check_range("2024-01-02", "2024-01-01")
    assert series.calendar(asset_frame(spark, ["A"]), "2024-01-01", "2024-01-01").count() == 1


def test_backfill_feeds_the_sink(spark, tmp_path):
    path = str(tmp_path / "facts")
    tables.append_facts(spark, template(spark), path)
    for _ in range(2):
        made = series.backfill(tables.read_facts(spark, path), asset_frame(spark, ["BTCUSD"]), "2026-06-01", "2026-06-06")
        tables.append_facts(spark, made, path)
    assert tables.read_facts(spark, path).count() == 6


def test_missing_ranges_by_brute_force(spark):
    rng = random.Random(4)
    dates = {a: sorted({rng.randint(0, 40) for _ in range(n)}) for a, n in (("A", 12), ("B", 1), ("C", 60), ("D", 0))}
    first = day("2024-02-20")
    table = facts(spark, [(a, rng.choice("ST"), first + timedelta(d), "2024-05-01 00:00:00", {"close_price": 1.0}, f"{a}{d}{i}") for a, ds in dates.items() for d in ds for i in range(2)]
                  + [(None, "S", first, "2024-05-01 00:00:00", {}, "n1"), ("A", "S", None, "2024-05-01 00:00:00", {}, "n2")])
    begin, end = first + timedelta(3), first + timedelta(35)
    expected = {(a, first + timedelta(d)) for a, ds in dates.items() for d in range(3, 36) if d not in ds}
    asked = ["A", "B", "C", "D", "D"]
    got = [tuple(r) for r in series.missing_dates(table, asked, begin, end).collect()]
    assert len(got) == len(set(got)) and set(got) == expected
    ranges = series.missing_ranges(table, asked, begin, end).collect()
    days = [(r["asset_id"], r["first_date"] + timedelta(i)) for r in ranges for i in range(r["days"])]
    assert sorted(days) == sorted(expected) and all(r["last_date"] == r["first_date"] + timedelta(r["days"] - 1) for r in ranges)
    # neighbours in the result are apart: each range is as long as it can be
    assert not {(r["asset_id"], r["last_date"] + timedelta(1)) for r in ranges} & {(r["asset_id"], r["first_date"]) for r in ranges}
    plan = series.missing_dates(table, None, begin, end)._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" not in plan and "NestedLoop" not in plan

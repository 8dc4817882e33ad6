import random

import pytest

from chronovault.operators import filters, versions
from tests.helpers import at, day, facts, rows

VERSIONS = [
    ("A", "S", "2024-01-01", "2024-01-01 10:00:00", {"close_price": 1.0}, "a1"),
    ("A", "S", "2024-01-01", "2024-01-01 12:00:00", {"close_price": 2.0}, "a2"),
    ("A", "S", "2024-01-01", "2024-01-01 12:00:00", {"close_price": 3.0}, "a3"),  # same second
    ("A", "S", "2024-01-02", "2024-01-02 10:00:00", {"close_price": 4.0}, "b1"),
    ("A", "S", "2024-01-02", "2024-01-02 11:00:00", {}, "b2", True),  # marker on top
    ("A", "S", "2024-01-03", "2024-01-03 10:00:00", {}, "c1", True),
    ("A", "S", "2024-01-03", "2024-01-03 11:00:00", {"close_price": 5.0}, "c2"),  # revived
    ("A", "T", "2024-01-03", "2024-01-03 12:00:00", {}, "c3", True),  # marker of another source
    ("B", "S", "2024-01-05", "2024-01-05 10:00:00", {"close_price": 6.0}, "d1"),
]


def ids(df):
    return [r[0] for r in rows(df, "ingest_id")]


def test_latest_per_key_with_tie_and_markers(spark):
    table = facts(spark, VERSIONS)
    assert ids(versions.latest_versions(table)) == ["a3", "b1", "c2", "d1"]
    assert ids(versions.latest_versions(table, tombstones="include")) == ["a3", "b2", "c2", "c3", "d1"]
    assert ids(versions.latest_versions(table, tombstones="apply")) == ["a3", "c2", "d1"]


def test_latest_across_sources(spark):
    table = facts(spark, VERSIONS)
    assert ids(versions.latest_by_asset(table, asset_id="A")) == ["a3", "b1", "c2"]
    assert ids(versions.latest_by_asset(table, tombstones="apply")) == ["a3", "d1"]
    assert ids(versions.latest_by_asset(table, asset_id="A", limit=2)) == ["b1", "c2"]


def test_as_of(spark):
    table = facts(spark, VERSIONS)
    picked = lambda t: ids(versions.latest_by_asset(table, asset_id="A", as_of_instant=t))
    assert picked("2024-01-01T09:59:59Z") == []
    assert picked("2024-01-01T11:00:00Z") == ["a1"]
    assert picked("2024-01-01T13:00:00+01:00") == ["a3"]
    assert picked("no time") == ["a3", "b1", "c2"]


def test_ranges(spark):
    table = facts(spark, VERSIONS)
    assert ids(filters.business_range(table, "2024-01-02", "2024-01-03")) == ["b1", "b2", "c1", "c2", "c3"]
    assert ids(filters.business_range(table, "2024-01-02", "2024-01-03", end_inclusive=False)) == ["b1", "b2"]
    assert ids(versions.tool_series(table, "A", "S", start="2024-01-01", end="2024-01-03")) == ["a3", "b2"]


def test_history_and_lineage(spark):
    table = facts(spark, VERSIONS)
    assert [r.ingest_id for r in versions.find_all(table, "A", "S").collect()][:3] == ["c2", "c1", "b2"]
    assert ids(versions.find_latest(table)) == ["c2", "c3", "d1"]
    assert ids(versions.asset_lineage(table, "A", limit=2)) == ["c2", "c3"]
    assert ids(versions.source_lineage(table, "T")) == ["c3"]


def test_history_fixture(spark):
    table = facts(spark, [
        ("TESTASSET", "TEST-SOURCE", "2026-06-01", "2026-06-01 00:00:00", {"close": 100.0}, "1"),
        ("TESTASSET", "TEST-SOURCE", "2026-06-02", "2026-06-02 00:00:00", {"close": 105.0}, "2"),
    ])
    found = versions.latest_by_asset(table, "TESTASSET", start="2026-06-01", end="2026-06-02")
    assert [str(r[0]) for r in rows(found, "business_date")] == ["2026-06-01", "2026-06-02"]


def test_series_between_swaps_and_wants_a_known_asset(spark):
    table = facts(spark, VERSIONS)
    known = spark.createDataFrame([("A",)], "asset_id string")
    assert ids(versions.series_between(table, known, "2024-01-09", "2024-01-03")) == ["c1", "c2", "c3"]
    assert ids(versions.series_between(table, known, "2024-01-01", "2024-01-09", asset_id="B")) == []


def test_common_indicators_keep_rows_of_unknown_sources(spark):
    sources = spark.createDataFrame(
        [("S", "V", "Vendor", None)], "data_source_id string, vendor_id string, vendor_name string, vendor_description string"
    )
    found = versions.common_indicators(facts(spark, VERSIONS), sources, include_deleted=True, limit=100)
    assert (3, "T", None) in [(r[0].day, r[1], r[2]) for r in rows(found, "business_date", "data_source_id", "vendor_id")]
    assert found.limit(1).collect()[0]["close_price"] == 5.0
    assert versions.common_indicators(facts(spark, VERSIONS), sources, limit=2).count() == 2


def test_page_and_membership(spark):
    table = facts(spark, VERSIONS)
    assert [r.ingest_id for r in filters.page(table, "ingest_id", limit=2, offset=1).collect()] == ["a2", "a3"]
    assert ids(filters.where_in(table, "asset_id", ["B"])) == ["d1"]
    assert ids(filters.where_in(table, "asset_id", spark.createDataFrame([("B",)], "asset_id string"))) == ["d1"]
    assert ids(filters.not_deleted(table)) == ["a1", "a2", "a3", "b1", "c2", "d1"]


def test_picks_against_brute_force(spark):
    pick = random.Random(5)
    table = []
    for i in range(700):
        deleted = pick.random() < 0.3
        table.append((
            pick.choice("ABCDE"), pick.choice("ST"), f"2024-01-{pick.randrange(1, 8):02d}",
            f"2024-02-01 00:00:{pick.randrange(30):02d}", {} if deleted else {"close_price": 1.0}, f"{i:04d}",
            True if deleted else None,
        ))
    frame, bound = facts(spark, table), "2024-02-01 00:00:20"

    def best(key, mode, known=table):
        if mode == "ignore":
            known = [r for r in known if not r[6]]
        top = {}
        for r in sorted(known, key=lambda r: (r[3], r[5])):
            top[tuple(r[k] for k in key)] = r
        return sorted(r[5] for r in top.values() if not (mode == "apply" and r[6]))

    early = [r for r in table if r[3] <= bound]
    for mode in ("ignore", "include", "apply"):
        assert ids(versions.latest_versions(frame, tombstones=mode)) == best((0, 1, 2), mode)
        assert ids(versions.latest_by_asset(frame, tombstones=mode)) == best((0, 2), mode)
        assert ids(versions.latest_by_asset(frame, as_of_instant=bound, tombstones=mode)) == best((0, 2), mode, early)


def brute_asof(requests, known, tombstones):
    """The id each request finds, by looking at every version."""
    out = []
    for rid, asset, bd, instant in requests:
        found = [v for v in known if v[0] == asset and v[2] == bd and v[3] is not None and (instant is None or v[3] <= instant)]
        if tombstones == "ignore":
            found = [v for v in found if len(v) == 6]
        best = max(found, key=lambda v: (v[3], v[5]), default=None)
        out.append((rid, best[5] if best and not (tombstones == "apply" and len(best) == 7) else None))
    return out


def asof_case(seed, n=400):
    """Versions and requests of a hot asset and others, with equal seconds, markers and requests without an instant."""
    rng = random.Random(seed)
    moment = lambda: f"2024-03-{rng.randint(1, 3):02d} {rng.randint(0, 23):02d}:{rng.choice([0, 0, 30]):02d}:00"
    asset = lambda: rng.choice(["HOT", "HOT", "B", "C"])
    known = [(asset(), "S", f"2024-02-0{rng.randint(1, 2)}", moment(), {"close_price": float(i)}, f"v{i:04d}", *([True] if rng.random() < 0.2 else [])) for i in range(n)]
    requests = [(i, rng.choice([asset(), "NONE"]), f"2024-02-0{rng.randint(1, 3)}", rng.choice([moment(), moment(), None])) for i in range(n)]
    return known, requests + requests[:5]


@pytest.mark.parametrize("tombstones", ["ignore", "include", "apply"])
def test_asof_join_by_brute_force(spark, tombstones):
    known, requests = asof_case(2)
    asked = spark.createDataFrame([(r, a, day(d), at(i) if i else None) for r, a, d, i in requests], "request_id long, asset_id string, business_date date, instant timestamp")
    found = versions.asof_join(asked, facts(spark, known), tombstones=tombstones)
    got = [(r["request_id"], r["ingest_id"]) for r in found.collect()]
    assert sorted(got, key=str) == sorted(brute_asof(requests, known, tombstones), key=str)


def test_asof_join_edges_and_plan(spark):
    table = facts(spark, [*VERSIONS, ("A", "S", None, "2024-01-01 10:00:00", {"close_price": 9.0}, "z1"), ("A", "S", "2024-01-09", None, {"close_price": 9.0}, "z2")])
    asked = spark.createDataFrame([
        ("A", day("2024-01-01"), at("2024-01-01 12:00:00"), "the very second", "x"), ("A", day("2024-01-01"), at("2024-01-01 11:59:59"), "a second earlier", "x"),
        ("A", day("2024-01-01"), at("2024-01-01 09:00:00"), "too early", "x"), (None, day("2024-01-01"), at("2024-05-01 00:00:00"), "no asset", "x"),
        ("A", None, at("2024-05-01 00:00:00"), "no date", "x"), ("A", day("2024-01-09"), None, "no system date", "x"), ("A", day("2024-01-03"), None, "newest", "x"),
    ], "asset_id string, business_date date, instant timestamp, `a.note` string, `_hour` string")
    found = versions.asof_join(asked, table)
    assert {(r["a.note"], r["ingest_id"], r["_hour"]) for r in found.collect()} == {
        ("the very second", "a3", "x"), ("a second earlier", "a1", "x"), ("too early", None, "x"), ("no asset", None, "x"), ("no date", None, "x"),
        ("no system date", None, "x"), ("newest", "c2", "x")}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert versions.asof_join(asked.limit(0), table).collect() == []
    assert {r["ingest_id"] for r in versions.asof_join(asked, table.limit(0)).collect()} == {None}
    with pytest.raises(ValueError):
        versions.asof_join(asked, table, tombstones="some")

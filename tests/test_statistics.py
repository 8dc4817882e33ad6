import pytest
from pyspark.sql import functions as F

from chronovault import fixed
from chronovault.functions.numeric import round_columns
from chronovault.operators import statistics as st
from tests.helpers import facts, rows

CLOSES = {"2026-06-03": 97150.0, "2026-06-04": 98450.0, "2026-06-05": 99200.0}


def template_versions(spark, copies=10, key="close_price"):
    return facts(spark, [
        ("BTCUSD", "S", bd, f"2026-06-10 00:00:{i:02d}", {key: price}, f"{bd}-{i}")
        for bd, price in CLOSES.items() for i in range(copies)
    ])


def test_golden_totals(spark):
    totals = round_columns(st.yearly_totals(template_versions(spark)), {"average_close_price": 2})
    assert rows(totals) == [("BTCUSD", 2026, 30, 97150.0, 99200.0, 98266.67)]


def test_golden_trend(spark):
    trend = st.linear_trends(template_versions(spark))
    shown = round_columns(trend, {
        "calculated_trend_slope": 6, "intercept": 2, "predicted_next_close_price": 2, "r_squared": 4,
    }).collect()[0]
    assert (shown.training_points, shown.last_known_close, str(shown.last_business_date)) == (30, 99200.0, "2026-06-05")
    assert (shown.calculated_trend_slope, shown.intercept) == (91.212458, 96944.09)
    assert (shown.predicted_next_close_price, shown.r_squared) == (99680.46, 0.869)


def test_golden_ridge(spark):
    trend = st.ridge_trends(template_versions(spark)).collect()[0]
    assert trend.calculated_trend_slope == pytest.approx(91.201689, abs=1e-6)
    assert trend.intercept == pytest.approx(96944.242172, abs=1e-6)
    assert trend.r_squared == pytest.approx(0.869027, abs=1e-6)


def test_ridge_equals_the_ml_library(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    points = spark.createDataFrame([(float(i), p) for i, p in enumerate([3.0, 9.0, 4.0, 7.5, 8.0])], "x double, y double")
    train = VectorAssembler(inputCols=["x"], outputCol="features").transform(points)
    model = LinearRegression(featuresCol="features", labelCol="y", maxIter=50, regParam=0.1).fit(train)
    table = facts(spark, [
        ("A", "S", f"2024-01-0{i + 1}", "2024-02-01", {"close": p}, str(i)) for i, p in enumerate([3.0, 9.0, 4.0, 7.5, 8.0])
    ])
    trend = st.ridge_trends(table).collect()[0]
    assert trend.calculated_trend_slope == pytest.approx(model.coefficients[0], rel=1e-9)
    assert trend.intercept == pytest.approx(model.intercept, rel=1e-9)
    assert trend.r_squared == pytest.approx(model.summary.r2, rel=1e-9)


def test_totals_skip_rows_without_price_year_or_asset(spark):
    table = facts(spark, [
        ("A", "S", "2024-01-01", "2024-01-01", {"close_price": 2.0, "close": 9.0}, "1"),
        ("A", "S", "2024-01-02", "2024-01-01", {"close": 4.0}, "2"),
        ("A", "S", "2024-01-03", "2024-01-01", {"close": None}, "3"),
        ("A", "S", "2024-01-04", "2024-01-01", {}, "4"),
        ("A", "S", "2025-01-04", "2024-01-01", {"close": 0.0}, "5"),
        ("A", "S", None, "2024-01-01", {"close": 4.0}, "6"),
        (None, "S", "2024-01-01", "2024-01-01", {"close": 4.0}, "7"),
    ])
    assert rows(st.yearly_totals(table)) == [("A", 2024, 2, 2.0, 4.0, 3.0), ("A", 2025, 1, 0.0, 0.0, 0.0)]


def test_trend_prefers_close_skips_unpriced_and_needs_three_points(spark):
    def series(asset, values):
        return [(asset, "S", f"2024-01-{i + 1:02d}", "2024-02-01", v, f"{asset}{i}") for i, v in enumerate(values)]

    table = facts(spark, [
        *series("A", [{"close": 1.0, "close_price": 99.0}, {}, {"close_price": 2.0}, {"close": 3.0}, {"close": None}]),
        *series("FLAT", [{"close": 5.0}] * 4),
        *series("TWO", [{"close": 1.0}, {"close": 2.0}]),
        *series("ZERO", [{"close": 0.0}, {"close": 0.0}, {"close": 3.0}]),
    ])
    trends = {r.asset_id: r for r in st.linear_trends(table).collect()}
    assert set(trends) == {"A", "FLAT", "ZERO"}
    a = trends["A"]
    assert (a.training_points, a.calculated_trend_slope, a.intercept, a.predicted_next_close_price) == (3, 1.0, 1.0, 4.0)
    assert str(a.last_business_date) == "2024-01-05"
    assert (trends["FLAT"].calculated_trend_slope, trends["FLAT"].r_squared) == (0.0, 1.0)
    assert trends["ZERO"].training_points == 3
    ridge = {r.asset_id: r for r in st.ridge_trends(table, ["FLAT"]).collect()}
    assert (ridge["FLAT"].calculated_trend_slope, ridge["FLAT"].intercept, ridge["FLAT"].r_squared) == (0.0, 5.0, None)
    assert fixed.MIN_TRAINING_POINTS == 3


PAIR = {
    "BTCUSD": {"2026-06-01": 100.0, "2026-06-02": 110.0, "2026-06-03": 105.0},
    "ETHUSD": {"2026-06-01": 10.0, "2026-06-02": 11.0, "2026-06-03": 12.0},
}


def compared(spark, table, a, b, **options):
    pairs = spark.createDataFrame([(a, b)], "asset_a string, asset_b string")
    return st.compare_pairs(table, pairs, **options).collect()[0]


def test_pair_fixture(spark):
    table = facts(spark, [
        (asset, "TEST", bd, "2026-06-10", {"close": c}, f"{asset}{bd}") for asset, s in PAIR.items() for bd, c in s.items()
    ] + [("BTCUSD", "TEST", "2026-06-04", "2026-06-10", {"close": 1.0}, "outside"),
         ("BTCUSD", "OTHER", "2026-06-02", "2026-06-10", {"close": 1.0}, "other")])
    r = compared(spark, table, "BTCUSD", "ETHUSD", source_id="TEST", start="2026-06-01", end="2026-06-04")
    a, b = r.stats_a, r.stats_b
    assert (a["count"], a.first, a.last, a.average) == (3, 100.0, 105.0, 105.0)
    assert (b["count"], b.first, b.last, b.average) == (3, 10.0, 12.0, 11.0)
    assert a.percent_change == pytest.approx(5.0) and b.percent_change == pytest.approx(20.0)
    assert a.volatility == pytest.approx(0.102852, abs=1e-6) and b.volatility == pytest.approx(0.006428, abs=1e-6)
    assert r.correlation == pytest.approx(0.5) and r.overlap_days == 3
    listed = st.compare_pairs(table, [("BTCUSD", "ETHUSD")], source_id="TEST", start="2026-06-01", end="2026-06-04")
    assert listed.collect() == [r]


def test_statistics_guards(spark):
    def series(asset, values):
        return [(asset, "S", f"2024-01-{i + 1:02d}", "2024-02-01", {"close": v}, f"{asset}{i}") for i, v in enumerate(values)]

    table = facts(spark, [
        *series("ONE", [5.0]), *series("TWO", [5.0, 6.0]), *series("ZEROFIRST", [0.0, 2.0, 3.0, 6.0]),
        *series("ZEROMID", [4.0, 0.0, 2.0]), *series("FLAT", [1.0, 1.0, 1.0]), *series("NULLS", [None, None]),
    ])
    stats = {r.asset_id: r for r in st.series_statistics(st.priced_series(table)).collect()}
    assert "NULLS" not in stats
    assert (stats["ONE"].percent_change, stats["ONE"].volatility) == (0.0, None)
    assert stats["TWO"].volatility == 0.0
    assert stats["ZEROFIRST"].percent_change is None
    assert stats["ZEROFIRST"].volatility == pytest.approx(0.5 / 2**0.5)
    assert stats["ZEROMID"].volatility == 0.0  # only 4 -> 0 has a return
    none = compared(spark, table, "FLAT", "TWO")
    assert none.correlation is None and none.overlap_days == 2
    empty = compared(spark, table, "NULLS", "UNKNOWN")
    assert (empty.stats_a["count"], empty.stats_b["count"], empty.overlap_days) == (0, 0, 0)
    assert empty.stats_a.first is None and empty.correlation is None
    assert compared(spark, table, "ONE", "TWO").correlation is None


def test_last_row_of_a_date_counts_for_correlation(spark):
    table = facts(spark, [
        ("A", "S", "2024-01-01", "2024-02-01 10:00:00", {"close": 50.0}, "1"),
        ("A", "S", "2024-01-01", "2024-02-01 11:00:00", {"close": 1.0}, "2"),
        ("A", "S", "2024-01-02", "2024-02-01 11:00:00", {"close": 2.0}, "3"),
        ("B", "S", "2024-01-01", "2024-02-01 11:00:00", {"close": 3.0}, "4"),
        ("B", "S", "2024-01-02", "2024-02-01 11:00:00", {"close": 4.0}, "5"),
    ])
    r = compared(spark, table, "A", "B")
    assert r.correlation == pytest.approx(1.0) and r.overlap_days == 2 and r.stats_a["count"] == 3


def test_input_order_does_not_matter(spark):
    table = template_versions(spark)
    shuffled = table.orderBy(F.rand(3))
    assert rows(st.linear_trends(table).drop("calculation_time")) == rows(st.linear_trends(shuffled).drop("calculation_time"))

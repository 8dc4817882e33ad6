import random
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronovault.operators import ordering, statistics
from tests.helpers import in_order, rows

SCHEMA = "asset_id string, business_date date, system_date timestamp, ingest_id string, price double"


@pytest.fixture(scope="module")
def table(spark):
    """One asset holds most rows, many of them on the same day and in the same second."""
    pick = random.Random(7)
    out = []
    for i in range(600):
        asset = "HOT" if i % 3 else pick.choice("AB")
        when = datetime(2024, 1, 1) + timedelta(seconds=pick.choice([0, 0, 0, 5, 3600, 90000, 200000]))
        out.append((
            asset, pick.choice([None, date(2024, 1, 1), date(2024, 1, 1), date(2024, 1, 9)]),
            pick.choice([None, when, when, when]), f"{pick.randrange(16**4):04x}{i:06d}",
            None if i % 11 == 0 else float(pick.randrange(50)),
        ))
    out.append((None, date(2024, 1, 1), None, "null-key", 1.0))
    return spark.createDataFrame(out, SCHEMA)


def brute(table, counted):
    """Positions by sorting each asset in plain Python."""
    low = (datetime.min, date.min)
    groups = {}
    for r in table.collect():
        groups.setdefault(r.asset_id, []).append(r)
    expected = []
    for asset, members in groups.items():
        members.sort(key=lambda r: (r.business_date or low[1], r.system_date or low[0], r.ingest_id))
        step, previous = 0, None
        for r in members:
            expected.append((asset, r.ingest_id, step, previous))
            if r[counted] is not None:
                step, previous = step + 1, r[counted]
    return expected


def test_steps_by_brute_force(spark, table):
    got = ordering.time_steps(table, "price")
    assert rows(got, "asset_id", "ingest_id", "time_step") == in_order(t[:3] for t in brute(table, "price"))


def test_previous_by_brute_force(spark, table):
    priced = table.where(F.col("price").isNotNull())
    got = ordering.with_previous(priced, "price")
    assert rows(got, "asset_id", "ingest_id", "time_step", "previous") == in_order(brute(priced, "price"))


def named(table):
    return table.withColumns({"close": F.col("price"), "close_price": F.lit(None).cast("double"), "data_source_id": F.lit("S")})


def ordered_prices(table):
    low = (datetime.min, date.min)
    groups = {}
    for r in table.collect():
        groups.setdefault(r.asset_id, []).append(r)
    for members in groups.values():
        members.sort(key=lambda r: (r.business_date or low[1], r.system_date or low[0], r.ingest_id))
    return [r.price for members in groups.values() for r in members]


def test_trends_and_statistics_by_brute_force(spark, table):
    closes = {}
    for (asset, *_), price in zip(brute(table, "price"), ordered_prices(table)):
        if asset is not None and price is not None:
            closes.setdefault(asset, []).append(price)
    for r in statistics.linear_trends(named(table)).collect():
        y = np.array(closes[r.asset_id])
        slope, intercept = np.polyfit(np.arange(len(y)), y, 1)
        assert (r.training_points, r.last_known_close) == (len(y), y[-1])
        assert (r.calculated_trend_slope, r.intercept) == (pytest.approx(slope, rel=1e-7, abs=1e-9), pytest.approx(intercept, rel=1e-7))
        assert r.r_squared == pytest.approx(np.corrcoef(np.arange(len(y)), y)[0, 1] ** 2, rel=1e-7, abs=1e-12)
    for r in statistics.series_statistics(statistics.priced_series(named(table))).collect():
        y = closes[r.asset_id]
        returns = [(b - a) / a for a, b in zip(y, y[1:]) if a]
        assert (r["count"], r.first, r.last) == (len(y), y[0], y[-1])
        assert (r.average, r.volatility) == (pytest.approx(np.mean(y)), pytest.approx(np.std(returns, ddof=1)))


def test_constant_prices(spark):
    facts = spark.createDataFrame([("A", date(2024, 1, d), datetime(2024, 1, d), str(d), 0.1) for d in range(1, 8)], SCHEMA)
    r = statistics.linear_trends(named(facts)).collect()[0]
    assert (r.calculated_trend_slope, r.intercept, r.r_squared) == (0.0, 0.1, 1.0)
    assert statistics.ridge_trends(named(facts)).collect()[0].r_squared is None


def scans(df):
    """File scans in the plan that ran."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("FileScan parquet")


def test_facts_are_read_once(spark, table, tmp_path):
    named(table).write.parquet(str(tmp_path / "facts"))
    facts = spark.read.parquet(str(tmp_path / "facts"))
    assert scans(statistics.linear_trends(facts)) == scans(statistics.ridge_trends(facts)) == 1
    assert scans(statistics.series_statistics(statistics.priced_series(facts))) == 1
    assert scans(ordering.time_steps(facts, "price")) <= 2
    assert scans(statistics.series_returns(statistics.priced_series(facts))) <= 2

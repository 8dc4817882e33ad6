import random
import re

import pytest
from pyspark.sql import functions as F

from chronovault import schemas
from chronovault.operators.series import gap_fill
from chronovault.operators.statistics import linear_trends
from chronovault.operators.versions import latest_versions
from chronovault.sources import bucketed, tables
from tests.helpers import facts, rows

BUCKETS = 4


def made(seed, n=200):
    """Facts of which most are of one asset, with repeated keys, and some without a date or an asset."""
    pick, out = random.Random(seed), []
    for i in range(n):
        when = None if pick.random() < 0.05 else f"2024-{pick.randint(1, 3):02d}-{pick.randint(1, 28):02d}"
        asset = pick.choice(["HOT"] * 6 + ["A", "B", None])
        out.append((asset, pick.choice("ST"), when, f"2024-05-01 0{pick.randint(0, 3)}:00:{pick.randint(10, 59)}", {"close_price": pick.uniform(1, 9)}, str(seed * 1000 + i), pick.random() < 0.1 or None))
    return out


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    """(facts as a plain frame, the same rows in a bucketed store that got them in three overlapping batches)."""
    path, all_rows = str(tmp_path_factory.mktemp("store")), made(1)
    for part in (all_rows[:120], all_rows[80:], all_rows[:10]):
        bucketed.append_bucketed(spark, facts(spark, part), "bucketed_facts", path, BUCKETS)
    return tables.to_stored(facts(spark, all_rows)), bucketed.open_bucketed(spark, "bucketed_facts", path, BUCKETS), path


def above_scan(frame):
    """The operators between the scan of the store and the top, from below, as they were planned."""
    plan = frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1].splitlines()
    depth = lambda line: re.search(r"[A-Za-z*]", line).start()
    out = []
    for i, line in enumerate(plan):
        if "FileScan" in line:
            at, path = depth(line), []
            for other in reversed(plan[:i]):
                if re.search("[A-Za-z]", other) and depth(other) < at:
                    at = depth(other)
                    path.append(re.search(r"[A-Za-z]+\b(?!\))", re.sub(r"\*\(\d+\)", "", other)).group())
            out.append(path)
    assert out
    return out


def test_rows_are_stored_once(spark, store):
    plain, held, path = store
    names = [n for n in schemas.STORED_FACTS.names if n not in ("provenance", "metrics")]
    assert rows(held.select(*names)) == rows(plain.select(*names))
    assert held.where("asset_id = 'HOT'").select(F.input_file_name()).distinct().count() > BUCKETS


def test_a_batch_writes_one_file_for_a_bucket_of_a_month(spark, tmp_path):
    spark.conf.set("spark.sql.shuffle.partitions", "23")  # whatever the session's number of partitions
    try:
        bucketed.append_bucketed(spark, facts(spark, made(3, 400)), "bucketed_files", str(tmp_path / "t"), BUCKETS)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    files = [(p.parent.name, re.search(r"_(\d{5})\.c", p.name).group(1)) for p in (tmp_path / "t").rglob("part-*.parquet")]
    assert len(files) == len(set(files)) and len({m for m, _ in files}) == 4 and len(files) > 3 * BUCKETS - 1


def test_reads_equal_those_of_a_plain_table(spark, store):
    plain, held, _ = store
    assert rows(latest_versions(held), "asset_id", "data_source_id", "business_date", "ingest_id") == rows(
        latest_versions(plain), "asset_id", "data_source_id", "business_date", "ingest_id")
    assert rows(gap_fill(held, ["HOT", "A", "NONE"], "2024-01-20", "2024-02-10")) == rows(gap_fill(plain, ["HOT", "A", "NONE"], "2024-01-20", "2024-02-10"))
    left, right = (rows(linear_trends(f).drop("calculation_time")) for f in (held, plain))
    assert [tuple(pytest.approx(x) if isinstance(x, float) else x for x in r) for r in left] == right and len(right) == 3


def test_facts_are_not_shuffled(spark, store):
    _, held, _ = store
    assert all("Exchange" not in path for path in above_scan(latest_versions(held)))
    assert all("Exchange" not in path for path in above_scan(gap_fill(held, ["HOT", "A"], "2024-01-20", "2024-02-10")))
    for path in above_scan(linear_trends(held)):  # cells move, facts do not
        below = path[:path.index("Exchange")] if "Exchange" in path else path
        assert any(step.endswith("Aggregate") for step in below), path


def test_a_range_prunes_months_and_other_sessions_find_the_files(spark, store):
    plain, held, path = store
    part = bucketed.read_bucketed(spark, "bucketed_facts", path, BUCKETS, "2024-02-05", "2024-02-20")
    assert rows(part, "ingest_id") == rows(plain.where("business_date BETWEEN '2024-02-05' AND '2024-02-20'"), "ingest_id")
    assert {f.split("business_month=")[1][:7] for f in (r[0] for r in part.select(F.input_file_name()).distinct().collect())} == {"2024-02"}
    again = bucketed.open_bucketed(spark, "bucketed_again", path, BUCKETS)  # no entry of this name yet
    assert rows(again, "ingest_id") == rows(plain, "ingest_id")
    assert all("Exchange" not in steps for steps in above_scan(latest_versions(again)))


def test_other_layouts_are_refused(spark, store, tmp_path):
    _, _, path = store
    for where, buckets in ((path, BUCKETS + 1), (str(tmp_path), BUCKETS), (path, 0), (path, True)):
        with pytest.raises(ValueError):
            bucketed.open_bucketed(spark, "bucketed_facts", where, buckets)
    nowhere = str(tmp_path / "none")
    assert rows(bucketed.open_bucketed(spark, "bucketed_empty", nowhere, 2)) == []
    bucketed.append_bucketed(spark, facts(spark, made(2, 5)), "bucketed_empty", nowhere, 2)
    assert bucketed.open_bucketed(spark, "bucketed_empty", nowhere, 2).count() == 5

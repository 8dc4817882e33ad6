"""Every registered operator query against its SQL on the small tables."""

import os

import duckdb
import pytest

from chronovault.llm import quality
from chronovault.llm.registry import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, name):
    frame = QUERIES[name](spark, SF_DIR)
    rows = frame.collect()
    assert rows
    sql = quality.oracle_sql() if name.startswith("op8_") else ORACLES.get(name)
    if sql:
        con = duckdb.connect()
        for t in ("documents", "pages", "benchmark", "labels"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_DIR}/{t}.parquet')")
        result = con.execute(sql)
        names = [d[0] for d in result.description]
        assert name.startswith("op8_") or sorted(names) == sorted(frame.columns)
        assert sorted(repr(tuple(r[n] for n in names)) for r in rows) == sorted(map(repr, result.fetchall()))

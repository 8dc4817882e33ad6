"""A store of facts bucketed by asset and business date, from which keys are read without moving facts.

Spark hashes a bucketed table's rows as a shuffle would, so windows, groups and joins whose keys include the asset and the business date take
its buckets as they are: version picks, gap filling, and the cells of trends. The date is part of the bucket, so an asset that
holds a third of all facts lies in all buckets. What still moves is what was made of the facts: a row for each day or cell.

The rows are Parquet files below a path; the session's catalog knows their layout, and ``open_bucketed`` says it anew in any session.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import schemas
from .tables import folder_exists, in_months, months_of, new_facts, possible_matches, require_ingest_id, to_stored

BUCKET = ["asset_id", "business_date"]
#: how rows lie within a file
_SORT = [*BUCKET, "system_date"]
_MONTH = "business_month"


def _quoted(name: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def _columns(schema: StructType) -> str:
    return ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)


def _without_scheme(path: str) -> str:
    return re.sub(r"^[a-z][a-z0-9+.-]*:/*", "/", path).rstrip("/")


def open_bucketed(spark: SparkSession, name: str, path: str, buckets: int) -> DataFrame:
    """The bucketed facts below ``path`` as table ``name`` of the session; empty if nothing was stored yet.

    ``buckets`` is a property of the files: it must be the number they were written with. A table of that name elsewhere, or with
    another number of buckets, is refused. Months and files that other sessions have added are found.
    """
    if not isinstance(buckets, int) or isinstance(buckets, bool) or buckets < 1:
        raise ValueError(f"buckets must be a positive whole number, not {buckets!r}")
    if not spark.catalog.tableExists(name):
        at = path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {_quoted(name)} ({_columns(schemas.STORED_FACTS)}) USING parquet PARTITIONED BY ({_MONTH}) "
            f"CLUSTERED BY ({', '.join(BUCKET)}) SORTED BY ({', '.join(_SORT)}) INTO {buckets} BUCKETS LOCATION '{at}'")
    described = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE FORMATTED {_quoted(name)}").collect()}
    held, location = described.get("Num Buckets"), described.get("Location", "")
    if held != str(buckets) or not _without_scheme(location).endswith(_without_scheme(path)):
        raise ValueError(f"table {name} has {held} buckets at {location}")
    if folder_exists(spark, path):
        spark.catalog.recoverPartitions(_quoted(name))
    spark.catalog.refreshTable(_quoted(name))
    return spark.table(_quoted(name))


def append_bucketed(spark: SparkSession, batch: DataFrame, name: str, path: str, buckets: int) -> None:
    """Insert-if-absent by ingest id, as ``append_facts`` does it. Each bucket of a month gets at most one new file.

    The batch is read for its months, for the filter and for the write. One writer at a time.
    """
    rows = require_ingest_id(batch.select(*schemas.FACTS.names))
    stored = open_bucketed(spark, name, path, buckets)
    fresh = to_stored(new_facts(rows, possible_matches(stored.where(in_months(months_of(rows))), rows, ["ingest_id"])))
    # dealt by month and the table's own hash, into as many tasks as the session takes: one task writes a bucket of a month
    dealt = fresh.select(*stored.columns).repartition(F.pmod(F.hash(*BUCKET), F.lit(buckets)), F.col(_MONTH))
    dealt.write.mode("append").insertInto(_quoted(name))


def read_bucketed(spark: SparkSession, name: str, path: str, buckets: int, start=None, end=None) -> DataFrame:
    """The facts of a business-date range, in their buckets; other months are not listed."""
    facts = open_bucketed(spark, name, path, buckets)
    for bound, inside in ((start, lambda c, d: c >= d), (end, lambda c, d: c <= d)):
        if bound is not None:
            day = F.lit(bound).cast("date")
            facts = facts.where(inside(F.col(_MONTH), F.trunc(day, "month")) & inside(F.col("business_date"), day))
    return facts

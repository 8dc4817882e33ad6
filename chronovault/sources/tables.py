"""Stored tables: partition-pruned reads, idempotent appends, replacement, migration."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import date

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import schemas
from ..functions.identity import sorted_map
from ..functions.text import iso_instant
from ..operators.filters import business_range
from ..operators.versions import top_versions
from ..session import materialise


_KEY = ["asset_id", "data_source_id", "business_date"]
#: how the files begin that name a table's versions, the highest number the current one, and the versions' folders
_POINTER, _VERSION = "_current", "version-"
#: how long a version is kept that was replaced, for readers that have begun on it, and a folder that no pointer names
KEPT_SECONDS, UNNAMED_SECONDS = 3600, 86400
#: 64-bit words of the filter of a batch's keys. At most that many rows of two longs are broadcast, whatever the batch's size
FILTER_WORDS = 1 << 19


def _month(day):
    return F.trunc(day, "month")


def read_table(spark: SparkSession, path: str, schema) -> DataFrame:
    """A Parquet table in a known schema, in its current version; empty if nothing has been written yet.

    Columns come in the schema's order, wherever a partition column stands."""
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    try:
        return spark.read.schema(schema).parquet(current_version(spark, path) or path).select(*schema.names)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def months_of(rows: DataFrame, column: str | None = None) -> list[date | None]:
    """The months that rows stand in, by their business date or a column that holds months: one value per calendar month."""
    month = F.col(column) if column else _month("business_date")
    return [r[0] for r in rows.select(month).distinct().collect()]


def in_months(months: Sequence[date | None]) -> Column:
    """Whether a stored row stands in one of the months; None is the month of rows without a date."""
    inside = F.col("business_month").isin([m for m in months if m is not None])
    return inside | F.col("business_month").isNull() if None in months else inside


def read_facts(spark: SparkSession, path: str, start=None, end=None) -> DataFrame:
    """Facts of a business-date range; the month bound prunes partitions, the date bound row groups."""
    facts = read_table(spark, path, schemas.STORED_FACTS)
    month = F.col("business_month")
    if start is not None:
        facts = facts.where(month >= _month(F.lit(start).cast("date")))
    if end is not None:
        facts = facts.where(month <= _month(F.lit(end).cast("date")))
    return business_range(facts, start, end)


def to_stored(facts: DataFrame) -> DataFrame:
    """Fact layout to disk layout: promoted metrics and the partition column."""
    return facts.select(
        *schemas.FACTS.names,
        *(F.try_element_at("metrics", F.lit(m)).alias(m) for m in schemas.PROMOTED_METRICS),
        _month("business_date").alias("business_month"),
    )


def require_ingest_id(rows: DataFrame) -> DataFrame:
    """The rows; a row without an ingest id fails the job when it is written."""
    checked = F.when(F.col("ingest_id").isNull(), F.raise_error(F.lit("a fact needs an ingest_id"))).otherwise(
        F.col("ingest_id")
    )
    return rows.withColumn("ingest_id", checked)


def _probe(columns: Sequence[str]) -> tuple[Column, Column]:
    """The word of the filter that a key falls into, and its four bits there."""
    key = F.xxhash64(*columns)
    fields = [F.shiftrightunsigned(key, n).bitwiseAND(F.lit(63)).cast("int") for n in (40, 46, 52, 58)]
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), f) for f in fields]
    return F.pmod(key, F.lit(FILTER_WORDS)), bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2]).bitwiseOR(bits[3])


def possible_matches(existing: DataFrame, batch: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The existing rows whose key, null being a value, may be one of the batch's, found without moving them.

    The batch's keys set bits of a Bloom filter of ``FILTER_WORDS`` words, which is broadcast by its fixed bound. No row with a key of
    the batch is left out. Others pass rarely while the batch has less than some ten million keys, and all of them when the filter is full.
    """
    word, bits = _probe(columns)
    words = batch.select(word.alias("_word"), bits.alias("_bits")).groupBy("_word").agg(F.bit_or("_bits").alias("_bits"))
    probed = existing.withColumns({"_own_word": word, "_own_bits": bits})
    held = F.col("_bits").bitwiseAND(F.col("_own_bits")) == F.col("_own_bits")
    return probed.join(F.broadcast(words), (F.col("_word") == F.col("_own_word")) & held, "left_semi").drop("_own_word", "_own_bits")


def new_facts(batch: DataFrame, existing: DataFrame) -> DataFrame:
    """The rows of a batch whose ingest id is not stored yet, once per id.

    Copies are cut to the first written below the shuffle on ingest_id, and the anti-join
    uses the same partitioning.
    """
    once = top_versions(batch, ["ingest_id"], [F.asc_nulls_last("system_date")])
    return once.join(existing.select("ingest_id"), "ingest_id", "left_anti").select(*batch.columns)


def stored_layout(rows: DataFrame) -> DataFrame:
    """Files of a sensible size per month, a large month over several tasks, sorted by asset.

    Sorted files let a query for one asset skip row groups by their bounds.
    """
    balanced = rows.hint("rebalance", "business_month")
    return balanced.sortWithinPartitions("business_month", "asset_id", "business_date")


def changed_facts(fresh: DataFrame, existing: DataFrame) -> DataFrame:
    """The fresh rows that say something else than the version before them in system time, stored or fresh.

    A value that was given, replaced and given again is kept: it differs from its predecessor.
    """
    content = F.xxhash64(F.to_json(F.struct(sorted_map(F.col("metrics")).alias("m"), F.coalesce("deleted", F.lit(False)).alias("d"))))
    narrow = fresh.select(*_KEY, "system_date", "ingest_id", content.alias("_content"), F.lit(True).alias("_fresh"))
    before = existing.select(*_KEY, "system_date", "ingest_id", content.alias("_content"), F.lit(False).alias("_fresh"))
    window = Window.partitionBy(*_KEY).orderBy("system_date", "ingest_id")
    judged = narrow.unionByName(before).withColumn("_before", F.lag("_content").over(window))
    same = judged.where(F.col("_fresh") & (F.col("_before") == F.col("_content"))).select("ingest_id")
    return fresh.join(same, "ingest_id", "left_anti").select(*fresh.columns)


def append_facts(spark: SparkSession, batch: DataFrame, path: str, skip_unchanged: bool = False) -> None:
    """Insert-if-absent. Only the months the batch touches are compared: the id covers the date.

    Of their rows, those that the filter of the batch's ids lets through are shuffled. With ``skip_unchanged`` a row that repeats the
    version before it is left out as well. The batch is read for its months, for the filter and for the write.
    """
    rows = require_ingest_id(batch.select(*schemas.FACTS.names))
    existing = read_table(spark, path, schemas.STORED_FACTS).where(in_months(months_of(rows)))
    fresh = new_facts(rows, possible_matches(existing, rows, ["ingest_id"]))
    if skip_unchanged:
        fresh = changed_facts(fresh, possible_matches(existing, rows, _KEY))
    stored_layout(to_stored(fresh)).write.mode("append").partitionBy("business_month").parquet(path)


def _file_context(spark: SparkSession, path: str):
    """Hadoop's file context and path for a table: the store that Spark itself writes to."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    at = hadoop.Path(path)
    return hadoop.FileContext.getFileContext(at.toUri(), spark._jsc.hadoopConfiguration()), at


def folder_exists(spark: SparkSession, path: str) -> bool:
    context, at = _file_context(spark, path)
    return context.util().exists(at)


class StaleTable(RuntimeError):
    """A table was replaced by someone else since it was read; read it again and repeat the step."""


def _versions(spark: SparkSession, path: str) -> tuple[list[tuple[int, object, int]], dict[str, tuple[object, int]]]:
    """The pointers (number, path, time in milliseconds) in order, and the version folders by name with their time."""
    context, at = _file_context(spark, path)
    pointers, folders = [], {}
    if context.util().exists(at):
        for status in at.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(at):
            name, file, time = status.getPath().getName(), status.getPath(), status.getModificationTime()
            if name.startswith(_VERSION):
                folders[name] = file, time
            elif name == _POINTER or name.startswith(f"{_POINTER}-"):
                pointers.append((int(name[len(_POINTER) + 1:] or 0), file, time))
    return sorted(pointers, key=lambda p: p[0]), folders


def _named_by(spark: SparkSession, pointer) -> str:
    stream = pointer.getFileSystem(spark._jsc.hadoopConfiguration()).open(pointer)
    try:
        return stream.readUTF()
    finally:
        stream.close()


def current_version(spark: SparkSession, path: str) -> str | None:
    """The folder that holds the table now, or None if it was never replaced."""
    pointers, _ = _versions(spark, path)
    return f"{path.rstrip('/')}/{_named_by(spark, pointers[-1][1])}" if pointers else None


def _point_to(spark: SparkSession, path: str, version: str, number: int) -> None:
    """Makes the version the current one by a rename, which is whole or not at all and fails if the number is taken."""
    jvm = spark._jvm
    context, at = _file_context(spark, path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    fresh = jvm.org.apache.hadoop.fs.Path(at, f"_pointer-{version}")
    stream = fs.create(fresh, True)
    try:
        stream.writeUTF(version)
    finally:
        stream.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    try:
        context.rename(fresh, jvm.org.apache.hadoop.fs.Path(at, f"{_POINTER}-{number:012d}"), options)
    except Py4JJavaError as error:
        if error.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
            raise
        fs.delete(fresh, False)
        raise StaleTable(f"{path} was replaced while a new version of it was written") from None


_UNSET = object()


def replace_table(df: DataFrame, path: str, based_on=_UNSET, kept_seconds: int = KEPT_SECONDS) -> None:
    """Replace a derived table: a new version folder, complete before a pointer is switched to it.

    A failed write leaves the old table as it is. ``df`` may read from ``path``; then ``based_on`` should be the ``current_version`` it
    reads, so that nobody's replacement is lost: if the table has another version by now, or gets one while this one is written,
    ``StaleTable`` is raised and nothing has changed. Versions replaced longer than ``kept_seconds`` ago are removed.
    """
    spark, version = df.sparkSession, f"{_VERSION}{uuid.uuid4().hex}"
    pointers, _ = _versions(spark, path)
    now = f"{path.rstrip('/')}/{_named_by(spark, pointers[-1][1])}" if pointers else None
    if based_on is not _UNSET and based_on != now:
        raise StaleTable(f"{path} was replaced since it was read")
    folder = f"{path.rstrip('/')}/{version}"
    df.write.parquet(folder)
    try:
        _point_to(spark, path, version, pointers[-1][0] + 1 if pointers else 1)
    except StaleTable:
        _, own = _file_context(spark, folder)
        own.getFileSystem(spark._jsc.hadoopConfiguration()).delete(own, True)
        raise
    _remove_old(spark, path, kept_seconds)


def _remove_old(spark: SparkSession, path: str, kept_seconds: int) -> None:
    """Removes versions that were replaced long ago, with their pointers, and folders that a failed write left a day ago."""
    pointers, folders = _versions(spark, path)
    _, at = _file_context(spark, path)
    fs, now = at.getFileSystem(spark._jsc.hadoopConfiguration()), pointers[-1][2]
    for (_, pointer, _), (_, _, replaced) in zip(pointers, pointers[1:]):
        folder = folders.pop(_named_by(spark, pointer), None)
        if now - replaced >= 1000 * kept_seconds:
            if folder:
                fs.delete(folder[0], True)
            fs.delete(pointer, False)
    folders.pop(_named_by(spark, pointers[-1][1]), None)
    for folder, written in folders.values():
        if now - written >= 1000 * UNNAMED_SECONDS:
            fs.delete(folder, True)


def upsert_partitions(changed: DataFrame, path: str, schema, keys: list[str], partition: str) -> None:
    """Puts the changed rows in place of the stored ones with the same keys, in a Parquet table partitioned by ``partition``.

    Only the partitions that changed rows stand in are read and written again, by dynamic partition overwrite; files of
    others are not touched. The partition must be one of the keys and have few values. Repeating the same rows changes nothing, so
    a failure half-way is mended by doing it again. One writer at a time.
    """
    spark = changed.sparkSession
    touched = [r[0] for r in changed.select(partition).distinct().collect()]
    if not touched:
        return
    stored = read_table(spark, path, schema)
    stored = stored.where(F.col(partition).isin([t for t in touched if t is not None]) | (F.col(partition).isNull() if None in touched else F.lit(False)))
    kept = _without_keys(stored, changed, keys)
    merged = materialise(spark, kept.select(*schema.names).unionByName(changed.select(*schema.names)), "upsert")
    writer = merged.hint("rebalance", partition).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(partition).parquet(path)


def _without_keys(rows: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose keys, null being a value, are not among those of ``gone``."""
    named = gone.select(*[F.col(k).alias(f"_gone_{k}") for k in keys]).distinct()
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_gone_{k}"))
    return rows.join(named, same, "left_anti")


def append_rows(df: DataFrame, path: str) -> None:
    """Adds rows to the table's current version. If it was replaced meanwhile, they are added to the new one as well: a table that is
    both appended to and replaced must bear rows twice, as a log of changes does that is folded."""
    version = current_version(df.sparkSession, path)
    while True:
        df.write.mode("append").parquet(version or path)
        before, version = version, current_version(df.sparkSession, path)
        if version == before:
            return


def migrate_system_dates(legacy: DataFrame) -> DataFrame:
    """Text system dates to timestamps, with a ``status``: ``migrated`` or ``unparseable``."""
    parsed = iso_instant(F.col("system_date"))
    return legacy.withColumns({
        "status": F.when(parsed.isNull(), "unparseable").otherwise("migrated"),
        "system_date": parsed,
        "system_date_text": F.col("system_date"),
    })


def migration_report(migrated: DataFrame) -> DataFrame:
    """Rows per status: the dry run."""
    return migrated.groupBy("status").agg(F.count(F.lit(1)).alias("rows"))


def as_json(rows: DataFrame) -> DataFrame:
    """One JSON text per row, dates as ISO days and timestamps as UTC seconds with Z."""
    options = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss'Z'", "timeZone": "UTC", "ignoreNullFields": "false"}
    kept = [F.col(c) for c in rows.columns if c != "_id"]
    return rows.select(F.to_json(F.struct(*kept), options).alias("json"))


def export_window(facts: DataFrame, end, days: int = 30) -> DataFrame:
    """All versions of the ``days`` days that end at ``end``."""
    last = F.lit(end).cast("date")
    return facts.where(F.col("business_date").between(F.date_sub(last, days - 1), last))


def export_summary(facts: DataFrame, end, days: int = 30) -> DataFrame:
    """Bounds of the export, its distinct assets and its rows."""
    last = F.lit(end).cast("date")
    return export_window(facts, end, days).agg(
        F.countDistinct("asset_id").alias("asset_count"), F.count(F.lit(1)).alias("record_count")
    ).select(F.date_sub(last, days - 1).alias("start_date"), last.alias("end_date"), "asset_count", "record_count")

"""A training-data pipeline: language, repeated lines, near-duplicates, benchmark passages, encoding.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; all but the last return the columns of
documents. A stage's frame is written and read again before the next one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronovault.llm import decontaminate, language, line_dedup, superminhash, wordbpe
from chronovault.llm.common import stored, table

#: how far beyond an even share of all languages the winner's must be, as a part of what is left: 0.3 where four were learned
LEAST_LANGUAGE_MARGIN = 1 / 15


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _keyed(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """docs with the key of a row, its doc_id, which may be null, and its text's hash, as columns without nulls under names of their own."""
    taken = {c.lower() for c in docs.columns}
    prefix = "key"
    while any(c.startswith(prefix) for c in taken):
        prefix += "_"
    key = [f"{prefix}{i}" for i in range(3)]
    return docs.withColumns(dict(zip(key, _key_of(F.col("doc_id"), F.xxhash64(F.col("text").cast("string")))))), key


def _key_of(doc_id: Column, text_hash: Column) -> list[Column]:
    doc_id = doc_id.cast("long")
    return [doc_id.isNull(), F.coalesce(doc_id, F.lit(0).cast("long")), text_hash]


def _without(docs: DataFrame, gone: DataFrame, once: DataFrame | None = None) -> DataFrame:
    """The rows of docs but those whose doc_id and text are of a row of gone (doc_id, text_hash); of the rows that are alike in both and
    named by ``once``, one. Both are written first, so their sizes are known and decide how they are joined."""
    keyed, key = _keyed(docs)
    keys_of = lambda frame: frame.select(*[c.alias(k) for k, c in zip(key, _key_of(F.col("doc_id"), F.col("text_hash")))])
    gone = stored(keys_of(gone).distinct(), "gone")
    columns = [_quoted(c) for c in docs.columns]
    if once is None:
        return keyed.join(gone, key, "left_anti").select(*columns)
    alike = stored(keys_of(once).join(gone, key, "left_anti"), "alike")
    single = keyed.join(gone, key, "left_anti").join(alike, key, "left_anti")
    return single.union(keyed.join(alike, key, "left_semi").dropDuplicates(key)).select(*columns)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without letters, null texts and texts without a clear language go; each row is judged by its own text and keeps its columns,
    whatever their names. Null and repeated ids do not matter. An empty table stays empty."""
    return language.clear_language(docs, LEAST_LANGUAGE_MARGIN)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go; n_chars follows the text; a document that loses all its lines goes. Rows without an id lose nothing. Columns
    named n_lines or n_dropped are replaced while lines are taken out, and are not returned unless docs had them."""
    kept = line_dedup.dedup_lines(docs)
    emptied = (F.col("n_dropped") > 0) & (F.coalesce(F.trim(F.col("text")), F.lit("")) == "")
    return kept.where(~emptied).select(*[F.length("text").cast("long").alias(c) if c == "n_chars" else _quoted(c) for c in docs.columns])


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates stays, the one with the smallest id, of several texts of that id the one with the
    smallest hash. Rows that are linked with nothing, those without an id or words included, stay, of those with the same id and text
    one. Other columns are passed on; an empty table stays empty."""
    rows = stored(superminhash.near_duplicates(docs, width=5, percent=80, hashed=True).select("doc_id", "text_hash", "component"), "verdicts")
    groups = rows.where("component IS NOT NULL").groupBy("component").agg(F.min(F.struct("doc_id", "text_hash")).alias("first"), F.count("*").alias("size"))
    several = rows.join(groups.where("size > 1"), "component")
    gone = several.where(F.struct("doc_id", "text_hash") != F.col("first")).select("doc_id", "text_hash")
    alike = rows.groupBy("doc_id", "text_hash").agg(F.count("*").alias("n")).where("n > 1").select("doc_id", "text_hash")
    return _without(docs, gone, alike)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text holds a benchmark passage go; rows of one id are judged each by its own text, null texts stay. Other columns are
    passed on; an empty benchmark or table changes nothing."""
    found = decontaminate.contaminated_words(docs, table(spark, sf_dir, "benchmark"), hashed=True)
    return _without(docs, found.where("n_hit > 0").select("doc_id", "text_hash"))


def encode_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, the hash of the ids (little-endian unsigned 32-bit) and of the decoded text, for every row, repeated ones each; a
    null text is empty. Other columns are not read; an empty table gives no rows."""
    decoded = wordbpe.round_trip(docs)
    return decoded.select(
        "doc_id", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language", identify_language),
    ("line_dedup", dedup_lines),
    ("near_dedup", dedup_near),
    ("decontaminate", drop_contaminated),
    ("encode", encode_documents),
]

#: encoding and language models have no SQL form; tests/llm compares the pipeline with a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

"""The queries op1 to op13, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronovault.session import scratch_path

from . import attention_lm, decontaminate, fill_middle, language, line_dedup, multi_order, quality, spelling, superminhash, token_attribution, token_store, url_filter, wordbpe
from .common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_verdicts(table(spark, sf_dir, "pages"))


def op3_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    token_store.write_tokens(table(spark, sf_dir, "documents"), path)
    return token_store.read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated_words(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predict_languages(table(spark, sf_dir, "documents"))


def op6_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = wordbpe.round_trip(table(spark, sf_dir, "documents"))
    return decoded.select(
        "doc_id", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attention_lm.score_texts(table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_attribution.section_tokens(table(spark, sf_dir, "documents"))
    whole = F.transform("section_tokens", lambda n: n.cast("long"))
    return counted.select("doc_id", "n_tokens", "n_crossing", F.size("section_tokens").cast("long").alias("n_sections"), whole.alias("section_tokens"))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return superminhash.near_duplicates(table(spark, sf_dir, "documents"), width=2)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"), noise=31)


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    restored = fill_middle.restore(fill_middle.fill_in_middle(table(spark, sf_dir, "documents")))
    return restored.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2("text", 256).alias("restored_sha256"))


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_order.jaccard_components(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_line_dedup, op2_url_filter, op3_token_store, op4_decontaminate, op5_language, op6_word_bpe, op7_attention_lm, op8_quality_rules, op9_token_counts, op10_near_duplicates, op11_spelling_variants,
                                                op12_fill_in_middle, op13_jaccard_join)}
ORACLES: dict[str, str] = {"op1_line_dedup": line_dedup.oracle_sql(), "op4_decontaminate": decontaminate.oracle_sql(), "op10_near_duplicates": superminhash.oracle_sql(), "op2_url_filter": url_filter.oracle_sql(),
                           "op12_fill_in_middle": fill_middle.oracle_sql(), "op13_jaccard_join": multi_order.oracle_sql()}

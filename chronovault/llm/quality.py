"""Quality rules: word, line and repetition statistics, and an ordered decision list learned from labels.

Everything on the data is DataFrame and SQL functions. Learning is sequential covering: a rule is grown on two thirds
of the labelled rows, one threshold at a time, each step one aggregation over all labelled statistics; it is pruned on
the other third; the rows it covers are taken out and the next rule is grown. The result is an ordered chain of
conditions, emitted as one Spark CASE expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, doc_texts, stored

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: thresholds tried for each feature and direction
N_THRESHOLDS = 24
MAX_RULES = 8
MAX_CONDITIONS = 3
#: least share of bad rows among those a rule covers, on the rows held out for pruning
MIN_PRECISION = 0.9
MIN_COVERED = 10

_SPACE = r"[\x20\x09-\x0D]+"
_SPACES = " \t\n\x0b\x0c\r"
STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def quality_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of every whole text, all long.

    n_words words [^\\x20\\x09-\\x0D]+, word_chars code points in them, n_symbols characters of #*$%&|<>, n_dup_lines lines
    with a word that equal an earlier line, n_repeat_words words in 3-word windows found twice or more, n_upper letters
    A-Z, n_lines lines with a word. A null or empty text has zeros. Repeated rows are counted one by one.
    """
    text = F.coalesce("text", F.lit(""))
    # a one-row generator keeps the optimizer from copying an array expression into each place that reads it
    words = doc_texts(docs).select("doc_id", text.alias("text")).select(
        "doc_id", "text", F.explode(F.array(F.filter(F.split("text", _SPACE), lambda w: w != ""))).alias("words"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count("text", F.lit("[A-Z]")).cast("long").alias("n_upper"),
    )
    hashed = words.select(
        "doc_id", "n_symbols", "n_upper", F.size("words").cast("long").alias("n_words"),
        F.length(F.regexp_replace("text", _SPACE, "")).cast("long").alias("word_chars"),
        F.explode(F.array(F.filter(F.split("text", "\n"), lambda x: F.length(F.btrim(x, F.lit(_SPACES))) > 0))).alias("lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    )
    lined = hashed.select(
        "doc_id", "n_symbols", "n_words", "word_chars", "n_upper", F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.explode(F.array(F.col("hashes"))).alias("hashes"),
    )
    kept = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_upper", "n_lines"]
    last = F.greatest(F.size("hashes") - 2, F.lit(0))
    windows = lined.select(*kept, F.explode(F.array(F.transform(
        F.arrays_zip(F.slice("hashes", F.lit(1), last).alias("a"), F.slice("hashes", F.lit(2), last).alias("b"), F.slice("hashes", F.lit(3), last).alias("c")),
        lambda w: F.xxhash64(w["a"], w["b"], w["c"]),
    ))).alias("windows"))
    return windows.select(*kept, repeat_words(F.col("windows")).alias("n_repeat_words"))


def repeat_words(windows: Column) -> Column:
    """Words covered by the 3-word windows whose hash stands twice or more in the array of all windows.

    Windows are sorted by hash and place, so equal ones are neighbours; the places of those are sorted again, and each
    adds the words that the one before it has not covered. Each step reads its array once.
    """
    placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    # state: the last hash and place, whether that place is in, and the places of repeated windows, newest first
    runs = F.transform(F.array(placed), lambda s: F.zip_with(
        s, F.slice(s, F.lit(2), F.greatest(F.size(s) - 1, F.lit(0))), lambda a, b: F.struct(a.alias("a"), b.alias("b")),
    ))
    pairs = F.filter(F.flatten(runs), lambda p: p["a"]["h"] == p["b"]["h"])
    places = F.sort_array(F.array_distinct(F.flatten(F.transform(pairs, lambda p: F.array(p["a"]["i"], p["b"]["i"])))))
    return F.aggregate(
        places, F.struct(F.lit(-3).alias("at"), F.lit(0).cast("long").alias("n")),
        lambda s, i: F.struct(i.alias("at"), (s["n"] + F.least(F.lit(3), i - s["at"])).alias("n")), lambda s: s["n"],
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def features() -> dict[str, Column]:
    words, c = F.col("n_words"), F.col
    return {
        "n_words": words.cast("double"),
        "chars_per_word": _share(c("word_chars"), words),
        "symbols_per_word": _share(c("n_symbols"), words),
        "upper_share": _share(c("n_upper"), words),
        "dup_line_share": _share(c("n_dup_lines"), c("n_lines")),
        "repeat_share": _share(c("n_repeat_words"), words),
        "words_per_line": _share(words, c("n_lines")),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = features()[self.feature]
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


def _covers(rule: tuple[Condition, ...]) -> Column:
    out = F.lit(True)
    for condition in rule:
        out = out & condition.column()
    return out


def _gain(bad: float, good: float, bad_before: float, good_before: float) -> float:
    """Bad rows covered, times the information gained about them."""
    if not bad:
        return -math.inf
    return bad * (math.log2(bad / (bad + good)) - math.log2(bad_before / (bad_before + good_before)))


def _counts(rows: DataFrame, options: list[tuple[Condition, ...]]) -> list[tuple[int, int]]:
    """(bad, good) rows that each option covers, in one pass over the labelled statistics."""
    totals = [F.sum((_covers(o) & (F.col("quality") == q)).cast("long")) for o in options for q in (0, 1)]
    found = [x or 0 for x in rows.agg(F.array(*totals).alias("n")).first()["n"]]
    return list(zip(found[::2], found[1::2]))


def _binned(rows: DataFrame) -> dict[tuple[str, int], tuple[int, int]]:
    """(bad, good) rows of each feature and bin, in one aggregation."""
    bins = rows.select("quality", F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"bin_{k}").alias("bin")) for k in features()])).alias("f"))
    counts = bins.groupBy("f.k", "f.bin").agg(F.sum((F.col("quality") == 0).cast("long")).alias("bad"), F.count("*").alias("n"))
    return {(r["k"], r["bin"]): (r["bad"], r["n"] - r["bad"]) for r in counts.collect()}


def _options(counts: dict[tuple[str, int], tuple[int, int]], cuts: dict[str, list[float]]) -> list[tuple[Condition, int, int]]:
    """Each threshold and direction with the bad and good rows it covers."""
    out = []
    for name, points in cuts.items():
        cells = [counts.get((name, i), (0, 0)) for i in range(len(points) + 1)]
        for i, point in enumerate(points):
            for above, part in ((False, cells[:i + 1]), (True, cells[i + 1:])):
                out.append((Condition(name, above, point), sum(b for b, _ in part), sum(g for _, g in part)))
    return out


def learn_decision_list(statistics: DataFrame, labels: DataFrame) -> list[tuple[Condition, ...]]:
    """Ordered rules, each a conjunction of thresholds that marks a row as bad (quality 0).

    All rows with a label count. The driver gets numbers only: quantiles of the features, and two counts for
    each of their bins. Null labels and ids are left out. Without bad or good rows the list is empty.
    """
    known = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    joined = stored(statistics.join(known, "doc_id").withColumn("prune", crc_mod(F.col("doc_id"), 3) == 0), "labelled")
    points = [i / N_THRESHOLDS for i in range(N_THRESHOLDS)] + [0.98, 0.99, 1.0]
    found = joined.where("quality = 0").agg(*[F.percentile_approx(c, points, 10_000).alias(k) for k, c in features().items()]).first()
    if found["n_words"] is None:
        return []
    cuts = {k: sorted(set(found[k])) for k in features()}
    bins = {f"bin_{k}": sum(((c > x).cast("int") for x in cuts[k]), F.lit(0)) for k, c in features().items()}
    rows = stored(joined.withColumns(bins), "binned")
    grow, prune = rows.where(~F.col("prune")), rows.where("prune")
    rules: list[tuple[Condition, ...]] = []
    while len(rules) < MAX_RULES:
        rule: tuple[Condition, ...] = ()
        bad, good = _counts(grow, [()])[0]
        if bad < MIN_COVERED:
            break
        while good and len(rule) < MAX_CONDITIONS:
            tried = _options(_binned(grow.where(_covers(rule))), cuts)
            best, b, g = max(tried, key=lambda o: _gain(o[1], o[2], bad, good))
            if _gain(b, g, bad, good) <= 0:
                break
            rule, bad, good = (*rule, best), b, g
        if not rule:
            break
        # prune: of all leading parts, the shortest of the most precise
        parts = [rule[:n] for n in range(1, len(rule) + 1)]
        held = _counts(prune, parts)
        worth = [(b + 1) / (b + g + 2) for b, g in held]
        best = max(range(len(parts)), key=lambda i: worth[i])
        b, g = held[best]
        if b + g < MIN_COVERED or b < MIN_PRECISION * (b + g):
            break
        rules.append(parts[best])
        grow, prune = grow.where(~_covers(parts[best])), prune.where(~_covers(parts[best]))
    return rules


def decision_column(rules: list[tuple[Condition, ...]]) -> Column:
    """The number of the first rule that covers a row, from 1 on, or 0."""
    out = F.lit(0)
    for i, rule in reversed(list(enumerate(rules, 1))):
        out = F.when(_covers(rule), F.lit(i)).otherwise(out)
    return out


def judge_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the statistics, base_failed, the number of the covering rule (0: none) and kept, for every row of docs.

    A text that fails the base thresholds is not kept; otherwise the decision list decides.
    """
    statistics = stored(quality_statistics(docs), "quality")
    rules = learn_decision_list(statistics, labels)
    return statistics.select("doc_id", *STATISTICS, base_failed().alias("base_failed"), decision_column(rules).alias("rule")).withColumn(
        "kept", ~F.col("base_failed") & (F.col("rule") == 0)
    )


def oracle_sql() -> str:
    """The columns that do not depend on learning."""
    return rf"""
        WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
        w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM t),
        g AS (SELECT doc_id, i, words[i] || chr(1) || words[i + 1] || chr(1) || words[i + 2] AS g
              FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
        r AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
        n AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM r, (VALUES (0), (1), (2)) AS v(k) GROUP BY doc_id),
        l AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM t)
        SELECT doc_id, len(words) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
               length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
               len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
               len(words) < {MIN_WORDS} OR 100 * coalesce(n_repeat_words, 0) > {MAX_REPEAT_PERCENT} * len(words) AS base_failed
        FROM w LEFT JOIN n USING (doc_id) JOIN l USING (doc_id)
    """

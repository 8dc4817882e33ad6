"""Language identification by prediction by partial matching.

For each language a tree of byte contexts up to ORDER bytes is counted on training texts. The probability of a byte is its share
in the longest context that has followed it before; each longer context that has not costs its escape probability (method C: seen
symbols / (count + seen symbols)); below the empty context all 256 bytes are equal. Statistics are frozen, so the code
length of a byte depends on the bytes before it alone, and is read from a table: byte strings seen in training are numbered
level by level, a string from the number of its front part and its last byte, and each number has one code
length for each language with all escapes worked in.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .common import bounded_batches, crc_mod, release, text_chunks

#: bytes of context
ORDER = 3
#: training texts of a language: the ones with the smallest hashes, so many, of each at most the first TRAIN_BYTES; the
#: documented bound on what the classifier is fitted on
TRAIN_DOCS, TRAIN_BYTES = 300, 20_000
UNDETERMINED = "und"
#: bytes of text judged at a time, unless one text has more; a byte takes some hundred bytes of memory meanwhile
CHUNK_BYTES = 125_000
#: training sample dealt to so many parts before the smallest of each language are taken
_PARTS = 32


class ContextTrees:
    """Code lengths in bits of bytes in context, for all languages at once.

    Bytes that no training text has behave alike in every context, so they share the symbol 0, whose code length
    is the one of a single unseen byte.
    """

    def __init__(self, texts: dict[str, list[bytes]], order: int = ORDER):
        self.languages, self.order = sorted(texts), order
        seen = np.zeros(256, bool)
        for parts in texts.values():
            for part in parts:
                seen[np.frombuffer(part, np.uint8)] = True
        self.symbol = np.zeros(256, np.int64)
        self.symbol[seen] = np.arange(1, int(seen.sum()) + 1)
        self.n_symbols = int(seen.sum()) + 1
        n = len(self.languages)
        self.steps: list[np.ndarray] = []
        numbers = [np.concatenate([self.symbol[np.frombuffer(p, np.uint8)] for p in texts[name]] or [np.zeros(0, np.int64)]) for name in self.languages]
        breaks = [np.cumsum([len(p) for p in texts[name]]) for name in self.languages]
        # number of the string that ends at each place, 0 for the empty one
        at = [np.zeros(len(x), np.int64) for x in numbers]
        bits = np.full((1, n), 8.0)  # of a byte in no context at all
        self.bits, self.escapes = [], []
        nodes = 1
        fallback_of = np.zeros(1, np.int64)
        for k in range(order + 1):
            # strings of k + 1 symbols: the string of k symbols one place before, and the symbol
            codes, valid = [], []
            for x, a, ends in zip(numbers, at, breaks):
                before = np.zeros(len(x), np.int64)
                before[1:] = a[:-1]
                starts = np.concatenate([[0], ends[:-1]]) if len(ends) else np.zeros(0, np.int64)
                depth = np.arange(len(x)) - np.repeat(starts, np.diff(np.concatenate([[0], ends]))) if len(x) else np.zeros(0, np.int64)
                codes.append(before * self.n_symbols + x)
                valid.append(depth >= k)
            distinct = np.unique(np.concatenate([c[v] for c, v in zip(codes, valid)])) if n else np.zeros(0, np.int64)
            step = np.zeros(nodes * self.n_symbols, np.int32)
            step[distinct] = np.arange(1, len(distinct) + 1)
            counts = np.stack([np.bincount(step[c[v]], minlength=len(distinct) + 1) for c, v in zip(codes, valid)], axis=1).astype(float) if n else np.zeros((1, 0))
            parent, symbol = distinct // self.n_symbols, distinct % self.n_symbols
            total, kinds = np.zeros((nodes, n)), np.zeros((nodes, n))
            np.add.at(total, parent, counts[1:])
            np.add.at(kinds, parent, counts[1:] > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(total > 0, -np.log2(kinds / (total + kinds)), 0.0)
                own = -np.log2(counts[1:] / (total + kinds)[parent])
            # the same symbol after the context without its first byte
            shorter = bits[0] if k == 0 else self._bits_at(fallback_of[parent], symbol, k - 1)
            table = np.concatenate([np.zeros((1, n)), np.where(counts[1:] > 0, own, escape[parent] + shorter)])
            # of each new string, the string without its first symbol, numbered one level lower
            fallback = np.zeros(len(distinct) + 1, np.int64)
            if k:
                fallback[1:] = self.steps[k - 1][fallback_of[parent] * self.n_symbols + symbol]
            self.steps.append(step)
            self.bits.append(table)
            self.escapes.append(escape)
            at = [np.where(v, step[c], 0) for c, v in zip(codes, valid)]
            fallback_of, nodes = fallback, len(distinct) + 1
        self.bits = [b.astype(np.float32) for b in self.bits]
        self.escapes = [e.astype(np.float32) for e in self.escapes]

    def _bits_at(self, context: np.ndarray, symbol: np.ndarray, level: int) -> np.ndarray:
        """Code lengths of symbols after contexts of ``level`` symbols that are numbered; every such string has been seen."""
        return self.bits[level][self.steps[level][context * self.n_symbols + symbol]]

    def code_lengths(self, chunk: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits of each row of the UTF-8 bytes in each language."""
        n, rows = len(self.languages), len(offsets) - 1
        out = np.zeros((rows, n))
        if not len(chunk) or not n:
            return out
        x = self.symbol[chunk]
        first = np.zeros(len(x), bool)
        begins = offsets[:-1][np.diff(offsets) > 0]
        first[begins] = True
        # numbers of the strings of k + 1 symbols ending at each place; 0 where not seen or not that long
        at = np.zeros(len(x), np.int32)
        bits = np.zeros((len(x), n), np.float32)
        levels = []
        for k in range(self.order + 1):
            before = np.zeros(len(x), np.int32)
            if k:
                before[1:] = at[:-1]
                before[first] = 0
            at = self.steps[k][before.astype(np.int64) * self.n_symbols + x]
            if k:
                at[before == 0] = 0
            levels.append((before, at))
        open_ = np.arange(len(x))
        for k in range(self.order, -1, -1):
            before, at = levels[k]
            own = at[open_]
            hit = own > 0
            bits[open_[hit]] += self.bits[k][own[hit]]
            open_ = open_[~hit]
            if not len(open_):
                break
            bits[open_] += self.escapes[k][before[open_]] if k == 0 else np.where((before[open_] > 0)[:, None], self.escapes[k][before[open_]], 0)
        bits[open_] += 8.0
        sums = np.add.reduceat(bits, begins, axis=0, dtype=np.float64)
        out[np.diff(offsets) > 0] = sums
        return out


def training_texts(docs: DataFrame, n_docs: int = TRAIN_DOCS, n_bytes: int = TRAIN_BYTES) -> dict[str, list[bytes]]:
    """Of each language, the texts of ``n_docs`` training rows: text and lang not null, crc32(doc_id) mod 4 not 2, with the smallest
    hashes of id and text, of equal ones any. Of a longer text the first ``n_bytes`` code points are brought and as many bytes learned. The bound holds
    for each language, whatever the table's size, and for repeated ids, null ones included."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    rows = rows.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & (crc_mod(F.col("doc_id"), 4) != 2) & (F.octet_length("text") > 0))
    rows = rows.withColumn("h", F.xxhash64("doc_id", "text"))
    # the hash of the last row of each language first, so that no text is moved that is not taken
    ranked = rows.select("lang", "h", F.pmod("h", F.lit(_PARTS)).alias("part"))
    for keys in (["lang", "part"], ["lang"]):
        ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy("h"))).where(F.col("rank") <= n_docs)
    last = [(r["lang"], r["h"]) for r in ranked.groupBy("lang").agg(F.max("h").alias("h")).collect()]
    if not last:
        return {}
    limits = docs.sparkSession.createDataFrame(last, "lang string, last long")
    rows = rows.join(F.broadcast(limits), "lang").where(F.col("h") <= F.col("last")).select("lang", "h", F.substring("text", 1, n_bytes).alias("text"))
    # rows that are alike share a hash, so the last hash may stand for more rows than the bound has room for
    taken = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).where(F.col("rank") <= n_docs)
    out: dict[str, list[bytes]] = {}
    for row in taken.orderBy("lang", "rank").toLocalIterator():
        out.setdefault(row["lang"], []).append(row["text"].encode()[:n_bytes])
    return out


def _scored(rows: DataFrame, trees: ContextTrees, given: list[str]) -> DataFrame:
    """The given columns of the rows, whose columns text and letters are judged, with lang_pred and score."""
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*trees.languages, UNDETERMINED]
        for batch in batches:
            for begin, end, chunk, offsets in text_chunks(batch["text"], CHUNK_BYTES):
                lengths = trees.code_lengths(chunk, offsets)
                letters = batch["letters"].slice(begin, end - begin).to_numpy(zero_copy_only=False).astype(bool)
                if not trees.languages:
                    letters = np.zeros(len(letters), bool)
                    lengths = np.zeros((len(letters), 1))
                best = lengths.argmin(axis=1)
                units = np.maximum(np.diff(offsets) / 8.0, 1.0)
                shares = np.exp2((lengths.min(axis=1, keepdims=True) - lengths) / units[:, None]).sum(axis=1)
                yield pa.RecordBatch.from_arrays([
                    *[batch[c].slice(begin, end - begin) for c in given],
                    pa.array([names[b] if ok else UNDETERMINED for b, ok in zip(best, letters)], pa.string()), pa.array(np.where(letters, 1 / shares, 0.0)),
                ], names=[*given, "lang_pred", "score"])
        release()

    schema = StructType([*[rows.schema[c] for c in given], StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return rows.mapInArrow(score, schema)


def _letters(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("letters")


def predict_languages(docs: DataFrame, order: int = ORDER, trees: ContextTrees | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred and score for every row of docs.

    Trees are learned from the training documents of docs unless given. The prediction reads the whole text alone: the language
    with the fewest bits, of equal ones the first by name. score is its share of the probability all
    languages give the text, spread over the text's length as geometric mean per 8 bytes, from 0 to 1. `und` with score 0 where the text
    is null or has no letter, or no language was learned. held_out is crc32 of the doc_id as text mod 4 = 2, false for a
    null id. Repeated rows are judged one by one. Columns but doc_id, text and lang are not read; an empty table gives no rows.
    """
    trees = trees or ContextTrees(training_texts(docs), order)
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (crc_mod(F.col("doc_id"), 4) == 2).alias("held_out"), text.alias("text"), _letters(text))
    return _scored(rows, trees, ["doc_id", "held_out"])


def clear_language(docs: DataFrame, margin: float, order: int = ORDER, trees: ContextTrees | None = None) -> DataFrame:
    """The rows of docs, with all their columns, whose language is clear: not `und`, and a score of at least 1/n + margin * (1 - 1/n) for n
    languages, 1/n being what each of n equal ones has. Rows are judged and passed on where they lie; text becomes a string. Columns
    may have any names. Without a learned language no row is clear."""
    bounded_batches(docs.sparkSession)
    trees = trees or ContextTrees(training_texts(docs), order)
    even = 1 / max(1, len(trees.languages))
    names = docs.columns
    numbered = docs.toDF(*[f"c{i}" for i in range(len(names))])
    given = ["text" if name == "text" else f"c{i}" for i, name in enumerate(names)]
    text = F.col(f"c{names.index('text')}").cast("string")
    rows = numbered.select(*[text.alias("text") if g == "text" else F.col(g) for g in given], _letters(text))
    found = _scored(rows, trees, given).where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= even + margin * (1 - even)))
    return found.select(*given).toDF(*names)

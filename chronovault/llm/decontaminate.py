"""Benchmark decontamination by winnowing.

A fingerprint is the hash of K words, kept where it is the smallest among W neighbours, so any WINDOW = K + W - 1 words that
two texts share hold one fingerprint in both. Documents keep the fingerprints that a fixed-size bitmap of the benchmark's
lets through, with the words around them; these join the benchmark's fingerprints, and each hit is extended word by word.
Words around the fingerprint reach one window to each side: a longer shared span has further fingerprints that cover it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ALNUM, list_array, mix, ragged, release, signed, stored, text_chunks, word_hashes

WINDOW = 10
K = 5
#: bits of the bitmap for each fingerprint of the benchmark, and its bounds
BITS_EACH, LEAST_BITS, MOST_BITS = 256, 1 << 20, 1 << 28

_FACTOR = np.uint64(0x9FB21C651E98DF25)
_BUCKET = 32768  # bits of one of Spark's bitmaps


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words that begin at each place."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = words[:n].copy()
    for j in range(1, k):
        out *= _FACTOR
        out += words[j:j + n]
    return mix(out)


def _same_row(rows: np.ndarray, n_words: int, span: int) -> np.ndarray:
    """For each place, whether ``span`` words from there on are of one row."""
    n = n_words - span + 1
    if n <= 0:
        return np.zeros(0, bool)
    row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    return row[:n] == row[span - 1:]


def winnow(words: np.ndarray, rows: np.ndarray, window: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the k-grams that are smallest in one of the windows that lie in one row; all of equal ones."""
    grams = gram_hashes(words, k)
    width = window - k + 1
    whole = _same_row(rows, len(words), window)
    if not len(whole):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    least = grams[:len(whole)].copy()
    for j in range(1, width):
        np.minimum(least, grams[j:j + len(whole)], out=least)
    picked = np.zeros(len(grams), bool)
    for j in range(width):
        picked[j:j + len(whole)] |= whole & (grams[j:j + len(whole)] == least)
    at = np.flatnonzero(picked)
    return at, grams[at]


def _contexts(chunk, starts, ends, rows, at, length: int, reach: int) -> list[pa.Array]:
    """For the gram of ``length`` words at each place: its place in its row, how many words around it come before it, and
    all these words, up to ``reach`` on each side."""
    row = np.searchsorted(rows, at, side="right") - 1
    first = np.maximum(at - reach, rows[row])
    counts = np.minimum(at + length + reach, rows[row + 1]) - first
    places = ragged(first, counts)
    lengths = ends[places] - starts[places]
    data = ALNUM[chunk][ragged(starts[places], lengths)]
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    words = pa.Array.from_buffers(pa.string(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    return [pa.array(at - rows[row]), pa.array((at - first).astype(np.int32)), list_array(words, np.concatenate([[0], np.cumsum(counts)]))]


PRINTS = "id long, text_hash long, n_words long, kind int, print long, at long, before int, words array<string>"
_KINDS = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.string()))
_NAMES = ["id", "text_hash", "n_words", "kind", "print", "at", "before", "words"]


def fingerprints(batches: Iterator[pa.RecordBatch], window: int, k: int, short: list[int] | None, passes=None) -> Iterator[pa.RecordBatch]:
    """One row for each text, whose kind is null, and one for each fingerprint.

    Kind 0 are the winnowed grams of k words. Kind n are grams of n words: of an item (``short`` is None) that has n words,
    fewer than a window, the one gram it is; of a document the grams at all places for each n of ``short``.
    ``passes`` tells which fingerprints to keep.
    """
    for batch in batches:
        for begin, end, chunk, offsets in text_chunks(batch["text"]):
            hashes, starts, ends, rows = word_hashes(chunk, offsets, ALNUM)
            ids, text_hashes, sizes = batch["id"].slice(begin, end - begin), batch["text_hash"].slice(begin, end - begin), np.diff(rows)
            yield pa.RecordBatch.from_arrays([ids, text_hashes, pa.array(sizes), *[pa.nulls(end - begin, t) for t in _KINDS[3:]]], names=_NAMES)
            found = [(0, k, *winnow(hashes, rows, window, k))]
            for n in sorted(set(sizes[(sizes > 0) & (sizes < window)].tolist())) if short is None else short:
                grams = gram_hashes(hashes, n)
                at = rows[:-1][sizes == n] if short is None else np.flatnonzero(_same_row(rows, len(hashes), n))
                found.append((n, n, at, mix(grams[at] + np.uint64(n))))
            for kind, length, at, prints in found:
                if passes is not None:
                    kept = passes(prints)
                    at, prints = at[kept], prints[kept]
                for a in range(0, len(at), 50_000):
                    part = at[a:a + 50_000]
                    row = pa.array(np.searchsorted(rows, part, side="right") - 1)
                    yield pa.RecordBatch.from_arrays([
                        ids.take(row), text_hashes.take(row), pa.array(sizes).take(row), pa.array(np.full(len(part), kind, np.int32)),
                        pa.array(signed(prints[a:a + 50_000])), *_contexts(chunk, starts, ends, rows, part, length, 0 if kind else window - k),
                    ], names=_NAMES)
    release()


def _bitmap(prints: DataFrame, most_bits: int) -> np.ndarray:
    """Bits of the fingerprints' leading parts; its size is bounded, so it may be sent to all tasks."""
    bits = LEAST_BITS
    while bits < min(most_bits, BITS_EACH * prints.count()):
        bits *= 2
    shift = 64 - (bits.bit_length() - 1)
    bit = F.shiftrightunsigned("print", shift)
    rows = prints.select(F.floor(bit / _BUCKET).cast("long").alias("bucket"), (bit % _BUCKET).cast("long").alias("bit"))
    out = np.zeros(bits // 8, np.uint8)
    for row in rows.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bitmap")).toLocalIterator():
        out[row["bucket"] * 4096:(row["bucket"] + 1) * 4096] = np.frombuffer(row["bitmap"], np.uint8)
    return out


def extend(batches: Iterator[pa.RecordBatch], window: int, k: int) -> Iterator[pa.RecordBatch]:
    """(id, text_hash, item_id, first word, word after the last) of the hits whose shared span is a window or longer."""
    for batch in batches:
        kinds, doc_before, item_before = (batch[c].to_numpy(zero_copy_only=False) for c in ("kind", "before", "item_before"))
        keep, first, after = [], [], []
        for i, (a, b) in enumerate(zip(batch["words"].to_pylist(), batch["item_words"].to_pylist())):
            if kinds[i]:
                left, right = 0, len(a) if a == b else 0
                long_enough = a == b
            else:
                p, q = doc_before[i], item_before[i]
                left = right = 0
                while left < p and left < q and a[p - left - 1] == b[q - left - 1]:
                    left += 1
                while p + right < len(a) and q + right < len(b) and a[p + right] == b[q + right]:
                    right += 1
                long_enough = right >= k and left + right >= window
            if long_enough:
                keep.append(i), first.append(left), after.append(right)
        taken = batch.take(pa.array(keep, pa.int64()))
        yield pa.RecordBatch.from_arrays([
            taken["id"], taken["text_hash"], taken["item_id"], pc.subtract(taken["at"], pa.array(first, pa.int64())), pc.add(taken["at"], pa.array(after, pa.int64())),
        ], names=["id", "text_hash", "item_id", "first", "after"])


def _covered(spans) -> Column:
    """Words in the union of the spans, an array of (first, after) sorted by first."""
    start = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(
        spans, start, lambda s, x: F.struct(
            F.greatest(s["end"], x["after"]).alias("end"),
            (s["n"] + F.greatest(F.lit(0).cast("long"), x["after"] - F.greatest(s["end"], x["first"]))).alias("n"),
        ), lambda s: s["n"],
    )


def contaminated_words(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, k: int = K, most_bits: int = MOST_BITS, hashed: bool = False) -> DataFrame:
    """doc_id, n_words, n_hit, item_ids (ascending as strings) for every row of docs.

    Words are [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ of the text with A-Z lowered. An item's windows are its runs of ``window`` words,
    or all its words if they are fewer; n_hit counts the document's words inside any occurrence of a window. A null or empty
    text has no words; items without words or id hit nothing. Rows of one doc_id are judged each by its own text; a
    repeated item_id counts once. Other columns are not read. An empty benchmark leaves every document clean.
    ``hashed`` adds text_hash, the xxhash64 of the text, which tells the rows of one doc_id apart.
    """
    def prints_of(frame, id_column, short, passes=None):
        text = F.col("text").cast("string")
        rows = frame.select(F.col(id_column).cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
        return rows.mapInArrow(lambda batches: fingerprints(batches, window, k, short, passes), PRINTS)

    items = stored(prints_of(benchmark.where("item_id IS NOT NULL"), "item_id", None).where("kind IS NOT NULL"), "item-prints")
    short = sorted(r["kind"] for r in items.where("kind > 0").select("kind").distinct().collect())
    bitmap = _bitmap(items.select("print").distinct(), most_bits)
    shift = np.uint64(64 - (len(bitmap) * 8).bit_length() + 1)

    def passes(prints: np.ndarray) -> np.ndarray:
        bit = (prints >> shift).astype(np.int64)
        return (bitmap[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1

    found = stored(prints_of(docs, "doc_id", short, passes), "document-prints")
    wanted = items.select("kind", "print", F.col("id").alias("item_id"), F.col("before").alias("item_before"), F.col("words").alias("item_words")).distinct()
    pairs = found.where("kind IS NOT NULL").join(wanted, ["kind", "print"])
    hits = pairs.mapInArrow(lambda batches: extend(batches, window, k), "id long, text_hash long, item_id long, first long, after long")
    by_text = hits.groupBy("id", "text_hash").agg(
        _covered(F.sort_array(F.collect_set(F.struct("first", "after")))).alias("n_hit"),
        F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids"),
    ).select(F.col("id").alias("hit_id"), F.col("text_hash").alias("hit_hash"), "n_hit", "item_ids")
    texts = found.where("kind IS NULL").select("id", "text_hash", "n_words")
    joined = texts.join(by_text, F.col("id").eqNullSafe(F.col("hit_id")) & (F.col("text_hash") == F.col("hit_hash")), "left")
    return joined.select(
        F.col("id").alias("doc_id"), "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"), *(["text_hash"] if hashed else []),
    )


def oracle_sql() -> str:
    words = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""
        WITH d AS (SELECT doc_id, {words} AS w FROM documents),
        b AS (SELECT item_id, w, least({WINDOW}, len(w)) AS n FROM (SELECT item_id, {words} AS w FROM benchmark) WHERE len(w) > 0),
        bw AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g
               FROM (SELECT item_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM b)),
        ns AS (SELECT DISTINCT n FROM b),
        dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
               FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, ns WHERE len(w) >= n)),
        h AS (SELECT doc_id, item_id, i, dw.n FROM dw JOIN bw ON dw.n = bw.n AND dw.g = bw.g),
        p AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM h) GROUP BY doc_id),
        t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
              FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY doc_id)
        SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN p USING (doc_id) LEFT JOIN t USING (doc_id)
    """

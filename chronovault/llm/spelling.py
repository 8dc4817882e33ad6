"""Spelling variants: words one edit apart, found with a bit-sliced position index, and the frequent word each belongs to.

The words of two lengths, m and m - 1, that share their first m div 2 letters, or their last m - m div 2, form a group: one edit
leaves one of these halves alone, so any two near words share a group. Within a block of groups there is a bitset over its
words for each (position, letter). For a word of m letters, three sets go along its letters: words without an error so far,
with one letter replaced, and with one letter of it left out, whose bitsets are those of the position before.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

#: distinct words a task counts before it passes them on
COUNTED_WORDS = 200_000
#: words of a tile of a large group; words and letters of a block of small ones
TILE_WORDS, BLOCK_WORDS, BLOCK_LETTERS = 2048, 1024, 1 << 22

_LOWER = {c: c + 32 for c in range(65, 91)}


def count_words(docs: DataFrame, least_chars: int = 7, noise: int | None = None) -> DataFrame:
    """(word, n): maximal runs of A-Z, a-z and U+00C0 to U+00FF, A-Z lowered, of at least ``least_chars`` code points, and how often they occur.

    ``noise``: let h be the crc32 of ``<doc_id>:<run>``; where ``noise`` divides h, the run loses its code point h % length first.
    Null texts have no words, a null doc_id is written as nothing. Repeated rows count as often as they stand. Other columns
    are not read.
    """
    pattern = re.compile(f"[A-Za-zÀ-ÿ]{{{least_chars},}}")

    def rows(counts: dict[str, int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                runs = Counter(pattern.findall(text.as_py() or ""))
                begun = zlib.crc32(f"{doc_id.as_py()}:".encode() if doc_id.is_valid else b":")
                for word, n in runs.items():
                    word = word.lower() if word.isascii() else word.translate(_LOWER)
                    if noise:
                        h = zlib.crc32(word.encode(), begun)
                        if h % noise == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1:]
                            if len(word) < least_chars:
                                continue
                    counts[word] = counts.get(word, 0) + n
                if len(counts) >= COUNTED_WORDS:
                    yield rows(counts)
                    counts = {}
        if counts:
            yield rows(counts)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def one_error(queries: np.ndarray, index: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Bits (queries x words of the index, packed little end first) of the words that come from a query by one replaced or deleted letter.

    queries are rows of m letters; index has rows of m too, of which the last is 0 for words of m - 1 letters.
    """
    m = queries.shape[1]
    width = -(-len(index) // 64) * 8

    def bitset(bits: np.ndarray) -> np.ndarray:
        out = np.zeros((*bits.shape[:-1], width), np.uint8)
        packed = np.packbits(bits, axis=-1, bitorder="little")
        out[..., :packed.shape[-1]] = packed
        return out.view(np.uint64)

    def slices(i: int) -> tuple[np.ndarray, np.ndarray]:
        """The letters at a position, and for each the bitset of the words that have it; the last one is empty."""
        letters = np.unique(index[:, i])
        bits = np.zeros((len(letters) + 1, len(index)), bool)
        bits[np.searchsorted(letters, index[:, i]), np.arange(len(index))] = True
        return letters, bitset(bits)

    def of(sliced: tuple[np.ndarray, np.ndarray], letter: np.ndarray) -> np.ndarray:
        letters, bits = sliced
        at = np.searchsorted(letters, letter)
        known = letters[np.minimum(at, len(letters) - 1)] == letter
        return bits[np.where(known, at, len(letters))]

    exact = np.repeat(bitset(np.ones((1, len(index)), bool)), len(queries), axis=0)
    replaced, left_out = np.zeros_like(exact), np.zeros_like(exact)
    before = None
    for i in range(m):
        here, letter = slices(i), queries[:, i]
        same = of(here, letter)
        left_out = exact if before is None else (left_out & of(before, letter)) | exact
        replaced = (replaced & same) | (exact & ~same)
        exact = exact & same
        before = here
    return (replaced & bitset(lengths[None] == m)) | (left_out & bitset(lengths[None] == m - 1))


def _near_in_block(m: int, cells: np.ndarray, roles: np.ndarray, suffix: np.ndarray, words: list[str], n: np.ndarray) -> pa.RecordBatch:
    """For the words of a block of cells: how many near words each has there, and the most frequent of them."""
    letters = np.array(words, f"U{m}").view(np.uint32).reshape(len(words), m)
    lengths = m - (letters[:, m - 1] == 0)
    index, queries = np.flatnonzero(roles & 1), np.flatnonzero(roles & 2)
    found = one_error(letters[queries], letters[index], lengths[index])
    bits = np.unpackbits(found.view(np.uint8), axis=1, bitorder="little")[:, :len(index)]
    q, w = np.nonzero(bits)
    q, w = queries[q], index[w]
    own = cells[q] == cells[w]
    q, w = q[own], w[own]
    # words that share both halves also meet in the group of their first half, and count there
    twice = suffix[q] & (letters[q, :m // 2] == letters[w, :m // 2]).all(axis=1)
    q, w = q[~twice], w[~twice]
    shorter = lengths[w] < m  # both of one length are queries, so they find each other
    a, b = np.concatenate([q, w[shorter]]), np.concatenate([w, q[shorter]])
    rank = np.unique(np.array(words), return_inverse=True)[1]
    order = np.lexsort((rank[b], -n[b], a))
    a, b = a[order], b[order]
    first = np.flatnonzero(np.append(True, a[1:] != a[:-1])) if len(a) else a
    return pa.RecordBatch.from_arrays([
        pa.array([words[i] for i in a[first]], pa.string()), pa.array(np.diff(np.append(first, len(a))), pa.int64()),
        pa.array(n[b[first]], pa.int64()), pa.array([words[i] for i in b[first]], pa.string()),
    ], names=["word", "n_near", "form_n", "form"])


def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near words of rows (m, cell, suffix, role, word, n) that are sorted by m and cell, in blocks of whole cells of one m."""
    held: pa.Table | None = None

    def blocks(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        m, cell = rows["m"].to_numpy(), rows["cell"].to_numpy()
        ends = np.append(np.flatnonzero((m[1:] != m[:-1]) | (cell[1:] != cell[:-1])) + 1, len(m))
        begin = end = 0
        for stop in ends:
            if end > begin and (m[stop - 1] != m[begin] or stop - begin > BLOCK_WORDS or (stop - begin) * m[begin] > BLOCK_LETTERS):
                yield block(rows.slice(begin, end - begin))
                begin = end
            end = stop
        if end > begin:
            yield block(rows.slice(begin, end - begin))

    def block(rows: pa.Table) -> pa.RecordBatch:
        column = lambda c: rows[c].to_numpy()
        return _near_in_block(int(rows["m"][0].as_py()), column("cell"), column("role"), column("suffix"), rows["word"].to_pylist(), column("n"))

    for batch in batches:
        rows = pa.Table.from_batches([batch])
        held = rows if held is None else pa.concat_tables([held, rows])
        m, cell = held["m"].to_numpy(), held["cell"].to_numpy()
        open_ = np.flatnonzero((m != m[-1]) | (cell != cell[-1])) if len(m) else m
        whole = int(open_[-1]) + 1 if len(open_) else 0
        if whole >= BLOCK_WORDS:
            yield from blocks(held.slice(0, whole))
            held = held.slice(whole)
    if held is not None and held.num_rows:
        yield from blocks(held)


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, form_n, form) of the distinct words (word, n) of at least two letters that have near ones: how many, and the most frequent, of equal
    ones the smallest in code-point order. Groups of more than TILE_WORDS words are cut into tiles, and pairs of tiles are cells."""
    length = F.length("word")
    at_m = words.select("word", "n", length.alias("chars"), F.explode(F.array(length, length + 1)).alias("m"))
    head, tail = F.expr("substring(word, 1, m div 2)"), F.expr("substring(word, chars - (m - m div 2) + 1, m - m div 2)")
    halves = F.explode(F.array(F.struct(F.lit(False).alias("suffix"), head.alias("half")), F.struct(F.lit(True).alias("suffix"), tail.alias("half"))))
    members = at_m.select("word", "n", "m", (F.col("chars") == F.col("m")).alias("asks"), halves.alias("h")).select("*", "h.*").drop("h")
    group = ["m", "suffix", "half"]
    tile_words = F.greatest(F.lit(32), F.least(F.lit(TILE_WORDS), F.floor(F.lit(BLOCK_LETTERS) / F.col("m"))))
    sizes = members.groupBy(group).agg(F.count("*").alias("size"), F.max("asks").alias("asked")).where("size > 1 AND asked")
    sizes = sizes.select(*group, F.ceil(F.col("size") / tile_words).cast("int").alias("tiles"))
    placed = members.join(sizes, group).withColumn("own", F.pmod(F.xxhash64("word"), F.col("tiles")).cast("int"))
    other = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    role = lambda q, i, bits: F.struct(F.col(q).alias("q"), F.col(i).alias("i"), F.lit(bits).cast("int").alias("role"))
    none = F.lit(None).cast("struct<q:int,i:int,role:int>")
    one = F.when(F.col("other") != F.col("own"), role("other", "own", 1)).when(F.col("asks"), role("own", "own", 3)).otherwise(role("own", "own", 1))
    two = F.when((F.col("other") != F.col("own")) & F.col("asks"), role("own", "other", 2)).otherwise(none)
    cells = other.withColumn("c", F.explode(F.array_compact(F.array(one, two))))
    rows = cells.select("m", F.xxhash64(*group, "c.q", "c.i").alias("cell"), "suffix", "c.role", "word", "n")
    found = rows.repartition("cell").sortWithinPartitions("m", "cell").mapInArrow(search, "word string, n_near long, form_n long, form string")
    best = F.min(F.struct((-F.col("form_n")).alias("n"), F.col("form")))
    out = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    return out.select("word", "n_near", (-F.col("best.n")).alias("form_n"), F.col("best.form").alias("form"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the rows (word, form): forms followed to the last. Each turn doubles the steps, so turns are few; a word's
    form is more frequent than the word, so no chain is a circle."""
    found = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = found.select(F.col("word").alias("root"), F.col("root").alias("further"))
        if found.join(onward, "root", "left_semi").isEmpty():
            return found
        found = stored(found.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "roots")


def spelling_variants(docs: DataFrame, least_chars: int = 7, least_count: int = 2, ratio: int = 10, noise: int | None = None) -> DataFrame:
    """word, form, root, n, n_near and form_n of the words of all texts (see ``count_words``) that occur ``least_count`` times.

    Two words are near if one inserted, deleted or replaced code point makes one of them the other. A word's form is its most
    frequent near word, if that is at least ``ratio`` times as frequent, else null, and form_n with it; of equal ones, the smallest
    in code-point order. root is the last of the forms that follow, the word itself without one. n_near is 0 without near
    words. No documents, no texts or no words give no rows.
    """
    words = stored(count_words(docs, least_chars, noise).where(F.col("n") >= least_count), "vocabulary")
    joined = words.join(near_words(words).withColumnsRenamed({"form": "near", "form_n": "near_n"}), "word", "left")
    belongs = F.col("near_n") >= ratio * F.col("n")
    of = stored(joined.select(
        "word", F.when(belongs, F.col("near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(belongs, F.col("near_n")).alias("form_n"),
    ), "variants")
    return of.join(roots(of.where("form IS NOT NULL")), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

"""Helpers shared by the operators: reading columns, scratch tables, vectorised words over UTF-8 buffers."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronovault.session import materialise, materialise_bucketed

#: bytes of text that one vectorised step takes at a time, unless one text is longer
CHUNK_BYTES = 500_000

#: bytes of a batch that goes to Python or comes from there, unless one row has more
BATCH_BYTES = 2 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def doc_texts(docs: DataFrame) -> DataFrame:
    """doc_id and text alone, whatever other columns there are."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; 0 for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % n, F.lit(0))


def release() -> None:
    """Gives memory that a task has freed back to the machine. Python workers are kept for later tasks, and would keep it too."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of at most BATCH_BYTES, unless the session says otherwise: a task's memory outside the heap is some multiple of them."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name) == "67108864b":  # Spark's default
        spark.conf.set(name, f"{BATCH_BYTES}b")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared scratch folder and read back, which cuts lineage."""
    bounded_batches(df.sparkSession)
    return materialise(df.sparkSession, df, name)


def stored_by(df: DataFrame, name: str, key: str) -> DataFrame:
    """``stored``, for a frame whose rows are later grouped by the key: they need no shuffle then."""
    bounded_batches(df.sparkSession)
    return materialise_bucketed(df.sparkSession, df, name, key)


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, UTF-8 bytes, offsets of the rows in them); nulls are empty. No text is cut."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    values = column.buffers()[2]
    data = np.frombuffer(values, dtype=np.uint8) if values is not None and values.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1)
        yield row, end, data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        row = end


def byte_map(keep) -> np.ndarray:
    """For each byte its value in a word, A-Z lowered, or 0 where it ends words."""
    lowered = np.arange(256, dtype=np.uint8)
    lowered[65:91] += 32
    return np.where([keep(int(b)) for b in lowered], lowered, 0).astype(np.uint8)


#: words [^\x20\x09-\x0D]+; the byte 0 belongs to words, so it is kept as a value no UTF-8 text has
NON_SPACE = byte_map(lambda b: b != 32 and not 9 <= b <= 13)
NON_SPACE[0] = 255
#: words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of lower-cased text
ALNUM = byte_map(lambda b: b >= 128 or 48 <= b <= 57 or 97 <= b <= 122)


def word_spans(mapped: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words in the mapped bytes, and where each row's words begin among them."""
    inside = mapped != 0
    before, after = np.empty_like(inside), np.empty_like(inside)
    if len(inside):
        before[1:], before[0] = inside[:-1], False
        after[:-1], after[-1] = inside[1:], False
        first, last = offsets[:-1], offsets[1:] - 1
        before[first[first < len(inside)]] = False
        after[last[last >= 0]] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose bits all depend on all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS: list[np.ndarray] = [np.ones(0, np.uint64), np.ones(0, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        for i, base in enumerate((_BASE, _BASE_INVERSE)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _POWERS[i] = np.multiply.accumulate(steps)
    return _POWERS[0][:n], _POWERS[1][:n]


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of the values, equal for equal content wherever it stands."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    powers, inverses = _powers(len(values))
    running = values.astype(np.uint64)
    running += np.uint64(1)
    running *= powers
    np.cumsum(running, out=running)
    sums = running[ends - 1] - np.where(starts > 0, running[starts - 1], np.uint64(0))
    return mix(sums * inverses[starts] ^ ((ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))


def word_hashes(chunk: np.ndarray, offsets: np.ndarray, mapping: np.ndarray):
    """Hash of each word of the rows, with starts, ends and the rows' first words (one more than rows)."""
    mapped = mapping[chunk]
    starts, ends, rows = word_spans(mapped, offsets)
    return span_hashes(mapped, starts, ends), starts, ends, rows


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, ... of all spans, one after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts - before, lengths)


def list_array(values: pa.Array, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)

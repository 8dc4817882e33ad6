"""Fill-in-the-middle by displacement: each byte of a batch gets the distance it moves, and one scatter builds all outputs.

A document is cut twice between units, a word with the white space before it (or white space that ends the text). Its three
parts are runs of bytes that move by one distance each. Those distances stand as differences at the parts' first bytes; their
cumulative sum gives every byte its place, markers go into the gaps. Restoring finds the markers and gathers the other way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .common import NON_SPACE, text_chunks, word_spans

FORMS = np.array(["plain", "psm", "spm"])
_MARKS = {c: np.frombuffer(f"<{c}>".encode(), np.uint8) for c in "PSM"}


def find_marks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the markers that lie within one row, and their rows."""
    inner = data[1:-1]
    at = np.flatnonzero((data[:-2] == 60) & (data[2:] == 62) & ((inner == 80) | (inner == 83) | (inner == 77))) if len(data) > 2 else np.zeros(0, np.int64)
    row = np.searchsorted(offsets, at, side="right") - 1
    whole = at + 3 <= offsets[row + 1]
    return at[whole], row[whole]


def shifts(n: int, begins: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """What to add to each of n places, so that the run that begins at begins[i] goes to targets[i]; begins ascend from 0.

    Runs may be empty: the differences of all runs that begin at one place add up, so the last one counts.
    """
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, begins, np.diff(targets - begins, prepend=0))
    return np.cumsum(steps[:n])


def cut_units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, callable]:
    """Number of units of each row, and a function from counts of units to the byte after them."""
    mapped = NON_SPACE[data]
    _, ends, rows = word_spans(mapped, offsets)
    n_words = np.diff(rows)
    low, high = offsets[:-1], offsets[1:]
    trailing = np.zeros(len(low), bool)
    filled = high > low
    trailing[filled] = mapped[high[filled] - 1] == 0

    def after(k: np.ndarray) -> np.ndarray:
        word = rows[:-1] + np.minimum(k, n_words) - 1
        out = np.where(k > n_words, high, low)
        inside = (k > 0) & (k <= n_words)
        out[inside] = ends[word[inside]]
        return out

    return n_words + trailing, after


def transform(data: np.ndarray, offsets: np.ndarray, hashes: list[np.ndarray], rate: int, spm: int):
    """(units, form codes, first cut, second cut, output bytes, output offsets) of the rows; cuts are places in data."""
    low, high = offsets[:-1], offsets[1:]
    n, after = cut_units(data, offsets)
    one, two = hashes[0] % (n + 1), hashes[1] % (n + 1)
    a, b = after(np.minimum(one, two)), after(np.maximum(one, two))
    marked = np.zeros(len(low), bool)
    marked[find_marks(data, offsets)[1]] = True
    form = np.where((high == low) | marked | (hashes[2] % 100 >= rate), 0, np.where(hashes[3] % 100 < spm, 2, 1))
    moved = form > 0
    ends = np.cumsum(high - low + 9 * moved)
    at = np.append(0, ends[:-1]) if len(ends) else ends
    p, m, s = a - low, b - a, high - b
    prefix_to = np.choose(form, [at, at + 3, at + s + 6])
    middle_to = at + p + np.where(moved, s + 9, 0)
    suffix_to = np.choose(form, [at + p + m, at + p + 6, at + 3])
    begins = np.stack([low, a, b], axis=1).ravel()
    targets = np.stack([prefix_to, middle_to, suffix_to], axis=1).ravel()
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    out[np.arange(len(data)) + shifts(len(data), begins, targets)] = data
    for mark, place in (("P", prefix_to), ("S", suffix_to), ("M", middle_to)):
        for i, byte in enumerate(_MARKS[mark]):
            out[place[moved] - 3 + i] = byte
    return n, form, a, b, out, np.append(0, ends)


def restore_bytes(data: np.ndarray, offsets: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts, as bytes and offsets, of outputs and their form codes."""
    low, high = offsets[:-1], offsets[1:]
    moved = form > 0
    at, row = find_marks(data, offsets)
    at = at[moved[row]]
    if len(at) != 3 * moved.sum():
        raise ValueError("an output of this form has each marker once")
    first, second, third = low.copy(), low.copy(), low.copy()
    first[moved], second[moved], third[moved] = at.reshape(-1, 3).T + 3
    one, two, m = second - 3 - first, third - 3 - second, high - third  # lengths of the parts as they stand
    psm = form == 1
    p, s = np.where(psm, one, two), np.where(psm, two, one)
    p[~moved], s[~moved], m[~moved] = (high - low)[~moved], 0, 0
    ends = np.cumsum(p + m + s)
    begin = np.append(0, ends[:-1]) if len(ends) else ends
    begins = np.stack([begin, begin + p, begin + p + m], axis=1).ravel()
    sources = np.stack([np.where(form == 2, second, first), third, np.where(form == 2, first, second)], axis=1).ravel()
    n = int(ends[-1]) if len(ends) else 0
    return data[np.arange(n) + shifts(n, begins, sources)], np.append(0, ends)


def _strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.string(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)])


def fill_in_middle(docs: DataFrame, rate: int = 50, spm: int = 80, seed: int = 42) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and output for every row of docs.

    n is the number of units. Of ``<seed>:<doc_id>``'s sha256, four groups of 8 hex digits draw the two cuts, whether the text is
    rearranged (``rate`` of 100) and, if so, how (``spm`` of 100: suffix, prefix, middle; else prefix, suffix, middle).
    Texts that are empty or hold a marker stay as they are: their form is plain. A null text is empty, a null doc_id is
    drawn as empty digits. Rows that repeat a doc_id have the same draws, each with its own units. Other columns are not
    read; an empty table gives no rows. Nothing is shuffled: a row depends on itself alone, so a lost task repeats.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit(""))).cast("binary"), 256)
    drawn = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i}") for i in range(4)]
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *drawn)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = [batch[f"h{i}"].to_numpy() for i in range(4)]
            for begin, end, data, offsets in text_chunks(batch["text"]):
                n, form, a, b, out, out_offsets = transform(data, offsets, [h[begin:end] for h in hashes], rate, spm)
                chars = np.append(0, np.cumsum((data & 0xC0) != 0x80))
                plain = form == 0
                yield pa.RecordBatch.from_arrays([
                    batch["doc_id"].slice(begin, end - begin), pa.array(n, pa.int64()), pa.array(FORMS[form]), pa.array(chars[a] - chars[offsets[:-1]], pa.int64(), mask=plain),
                    pa.array(chars[b] - chars[a], pa.int64(), mask=plain), _strings(out, out_offsets),
                ], names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return texts.mapInArrow(build, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restore(filled: DataFrame) -> DataFrame:
    """The rows of ``fill_in_middle``, or of any frame with output and form, with the column text rebuilt from these two.

    All columns but text are passed on. A null output gives an empty text. An output that does not have its form's markers is
    an error.
    """
    filled = filled.drop("text")
    names = filled.columns
    output, form_at = names.index("output"), names.index("form")

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            form = np.select([np.array(batch[form_at].to_pylist(), object) == f for f in FORMS], [0, 1, 2], 0)
            for begin, end, data, offsets in text_chunks(batch[output]):
                text = _strings(*restore_bytes(data, offsets, form[begin:end]))
                rest = batch.slice(begin, end - begin)
                yield pa.RecordBatch.from_arrays([*rest.columns, text], names=[*batch.schema.names, "text"])

    numbered = filled.toDF(*[f"c{i}" for i in range(len(names))])  # any name may stand in the frame, also one with dots
    schema = StructType([*numbered.schema.fields, StructField("text", StringType())])
    return numbered.mapInArrow(gather, schema).toDF(*names, "text")


def oracle_sql(rate: int = 50, spm: int = 80, seed: int = 42) -> str:
    part = lambda i: f"CAST('0x' || substr(h, {8 * i + 1}, 8) AS BIGINT)"
    return rf"""
        WITH t AS (SELECT doc_id, coalesce(text, '') AS text, sha256('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
        u AS (SELECT *, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units FROM t),
        d AS (SELECT *, len(units) AS n, {part(0)} % (len(units) + 1) AS one, {part(1)} % (len(units) + 1) AS two, {part(2)} % 100 AS kept, {part(3)} % 100 AS suffix_first FROM u),
        c AS (SELECT doc_id, text, n, array_to_string(units[:least(one, two)], '') AS p, array_to_string(units[least(one, two) + 1:greatest(one, two)], '') AS m,
                     array_to_string(units[greatest(one, two) + 1:], '') AS s,
                     CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR kept >= {rate} THEN 'plain'
                          WHEN suffix_first < {spm} THEN 'spm' ELSE 'psm' END AS form FROM d)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
               sha256(text) AS restored_sha256 FROM c
    """

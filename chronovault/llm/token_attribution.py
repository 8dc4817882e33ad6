"""Token counts of sections: whole documents are encoded once, and their tokens' spans are joined to section spans.

The byte lengths of the tokens give each token's span in the text; sections are ordered spans that do not overlap. An
interval join by binary search finds the sections a token touches. A token that crosses a boundary goes where the rule says:
`first` or `last` section it has a character in, `most` the one with most of its bytes (of equal ones the first), `share` to
each by its part of the bytes.
"""

from __future__ import annotations

import base64
import functools
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RULES = ("first", "last", "most", "share")
#: sections end after a line, or after the white space that follows the end of a sentence
SENTENCES = r"[.!?][\x20\x09-\x0D]+|\n"
_ROWS_OUT = 2000


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@functools.lru_cache(maxsize=2)
def byte_bpe(path: str):
    """The encoding of a rank file, and the byte length of each id."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    lengths = np.zeros(max(ranks.values()) + 1, np.int64)
    for piece, rank in ranks.items():
        lengths[rank] = len(piece)
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), lengths


def token_ends(text: str, path: str) -> np.ndarray:
    """Where each token of the text ends, in UTF-8 bytes."""
    encoding, lengths = byte_bpe(path)
    return np.cumsum(lengths[np.array(encoding.encode_ordinary(text), np.int64)])


def byte_places(text: str) -> np.ndarray | None:
    """The byte at which each character begins, and the end; None where they are the same numbers."""
    if text.isascii():
        return None
    raw = np.frombuffer(text.encode(), np.uint8)
    return np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))


def attribute(ends: np.ndarray, first: np.ndarray, after: np.ndarray, rule: str) -> tuple[np.ndarray, int]:
    """Tokens of each section [first, after), and how many tokens touch more than one.

    Tokens that touch no section count nowhere; an empty section has none.
    """
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    out = np.zeros(len(first))
    full = np.flatnonzero(after > first)
    a, b = first[full], after[full]
    low, high = np.searchsorted(b, starts, side="right"), np.searchsorted(a, ends, side="left") - 1
    touches, crosses = (low <= high) & (ends > starts), low < high
    own = np.flatnonzero(touches & ~crosses) if rule in ("most", "share") else np.flatnonzero(touches)
    np.add.at(out, full[(high if rule == "last" else low)[own]], 1)
    if rule in ("most", "share"):
        pair = np.flatnonzero(crosses & (high == low + 1))  # the usual case, all at once
        left, right = b[low[pair]] - np.maximum(starts[pair], a[low[pair]]), np.minimum(ends[pair], b[high[pair]]) - a[high[pair]]
        if rule == "most":
            np.add.at(out, full[np.where(left >= right, low[pair], high[pair])], 1)
        else:
            np.add.at(out, full[low[pair]], left / (left + right))
            np.add.at(out, full[high[pair]], right / (left + right))
        for t in np.flatnonzero(crosses & (high > low + 1)):
            sections = np.arange(low[t], high[t] + 1)
            parts = np.minimum(b[sections], ends[t]) - np.maximum(a[sections], starts[t])
            if rule == "most":
                out[full[sections[parts.argmax()]]] += 1
            else:
                out[full[sections]] += parts / parts.sum()
    return out, int(crosses.sum())


def split_sections(text: str, boundary: re.Pattern) -> tuple[np.ndarray, np.ndarray]:
    """First and after-last character of the sections; what the boundary matches belongs to the section it ends."""
    after = [m.end() for m in boundary.finditer(text) if m.end() < len(text)] + [len(text)]
    return np.array([0, *after[:-1]], np.int64), np.array(after, np.int64)


def _count(batches: Iterator[pa.RecordBatch], path: str, rule: str, boundary: str = SENTENCES) -> Iterator[pa.RecordBatch]:
    pattern = re.compile(boundary)
    for batch in batches:
        texts = pc.fill_null(batch["text"], "").to_pylist()
        for begin in range(0, len(texts), _ROWS_OUT):
            n_tokens, n_crossing, counts = [], [], []
            for i in range(begin, min(begin + _ROWS_OUT, len(texts))):
                text = texts[i]
                if "first" in batch.schema.names:
                    first, after = (np.array(batch[c][i].as_py() or [], np.int64) for c in ("first", "after"))
                else:
                    first, after = split_sections(text, pattern)
                places = byte_places(text)
                if places is not None:
                    first, after = places[np.clip(first, 0, len(places) - 1)], places[np.clip(after, 0, len(places) - 1)]
                ends = token_ends(text, path)
                found, crossing = attribute(ends, first, after, rule)
                n_tokens.append(len(ends)), n_crossing.append(crossing), counts.append(found)
            yield pa.RecordBatch.from_arrays([
                *[batch.column(k).slice(begin, len(counts)) for k, name in enumerate(batch.schema.names) if name == "key"],
                pa.array(n_tokens, pa.int64()), pa.array(n_crossing, pa.int64()), pa.array(counts, pa.list_(pa.float64())),
            ], names=["key", "n_tokens", "n_crossing", "section_tokens"])


_COUNTED = "n_tokens long, n_crossing long, section_tokens array<double>"


def _check(rule: str) -> None:
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")


def section_tokens(
    docs: DataFrame, sections: Column | None = None, rule: str = "most", boundary: str = SENTENCES, ranks: str | None = None
) -> DataFrame:
    """doc_id, n_tokens, n_crossing (tokens that touch several sections) and section_tokens (one number for each section) for every row.

    ``sections`` is an array of structs (first, after) of code points, in order and without overlap; without it the matches of
    ``boundary`` end the sections, by default sentences and lines. A null or empty text has no tokens; split, it is one empty section. Repeated rows are counted one by one;
    a null doc_id is passed on. Other columns are not read; an empty table gives no rows.
    """
    _check(rule)
    path = ranks or default_ranks()
    columns = [F.col("doc_id").cast("long").alias("key"), F.col("text").cast("string").alias("text")]
    if sections is not None:
        columns += [sections["first"].cast("array<long>").alias("first"), sections["after"].cast("array<long>").alias("after")]
    counted = docs.select(*columns).mapInArrow(lambda b: _count(b, path, rule, boundary), f"key long, {_COUNTED}")
    return counted.withColumnRenamed("key", "doc_id")


def field_tokens(rows: DataFrame, key: str, fields: Sequence[str], separator: str = "\n", rule: str = "most", ranks: str | None = None) -> DataFrame:
    """The key, n_tokens, n_crossing and a column tokens_<field> for each field, of rows whose fields are joined by the separator,
    encoded once as a whole. Null fields are empty. Separators belong to no field: a token that has characters of a separator
    alone counts for n_tokens only."""
    _check(rule)
    path = ranks or default_ranks()
    values = [F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields]
    first, after, at = [], [], F.lit(0).cast("long")
    for value in values:
        first.append(at)
        at = at + F.length(value)
        after.append(at)
        at = at + len(separator)
    joined = rows.select(F.col(key).cast("string").alias("key"), F.concat_ws(separator, *values).alias("text"), F.array(*first).alias("first"), F.array(*after).alias("after"))
    counted = joined.mapInArrow(lambda b: _count(b, path, rule), f"key string, {_COUNTED}")
    return counted.select(
        F.col("key").cast(rows.schema[key].dataType).alias(key), "n_tokens", "n_crossing", *[F.get("section_tokens", i).alias(f"tokens_{f}") for i, f in enumerate(fields)]
    )

"""Line dedup: lines of at least 20 characters that stand in 3 or more documents stay in one of them.

Distinct line hashes are dealt to shards. A shard builds a minimal perfect hash over its line hashes, which numbers
them without gaps; arrays in that order hold a fingerprint, the saturated document count and the document that
keeps the line. Documents are packed into blocks; a block sends each of its distinct line hashes once to the shard, which
probes the arrays, and gets back the few that lose lines. Line texts never move, and a line found everywhere costs
one entry for each block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .common import mix, release, stored

MIN_CHARS = 20
MIN_DOCS = 3
#: line hashes of a shard, on average
KEYS_PER_SHARD = 1 << 18
#: texts of a block, in bytes
BLOCK_BYTES = 8_000_000

_SPARE = 1.7  # bits for each key that a level has to place
_LEVELS = 24

LINES = "block long, doc_ids array<long>, hashes array<long>, n_keys array<int>, numbers array<int>, high array<long>, low array<long>"


def line_keys(text: bytes, min_chars: int = MIN_CHARS) -> list[tuple[int, bytes]]:
    """(line number, key) of the lines whose key is long enough: white space stripped, A-Z lowered."""
    out = []
    for number, line in enumerate(text.lower().split(b"\n")):
        key = line.strip(b" \t\n\x0b\x0c\r")
        if len(key) >= min_chars and (key.isascii() or len(key.decode()) >= min_chars):
            out.append((number, key))
    return out


class MinimalPerfectHash:
    """Numbers distinct 64-bit keys from 0 without gaps, by levels of bits: a key that has a bit of its level for itself
    is numbered by the bits set before it, the others go to the next level, the last few to a sorted list."""

    def __init__(self, sizes: list[int], bits: np.ndarray, rest: np.ndarray):
        self.sizes, self.bits, self.rest = sizes, bits, rest
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(bits).astype(np.int64))])

    @classmethod
    def build(cls, keys: np.ndarray) -> MinimalPerfectHash:
        sizes, levels = [], []
        while len(keys) and len(sizes) < _LEVELS:
            size = -(-int(len(keys) * _SPARE + 1) // 64) * 64
            at = cls._place(keys, len(sizes), size)
            alone = np.bincount(at, minlength=size)[at] == 1
            level = np.zeros(size, np.uint8)
            level[at[alone]] = 1
            levels.append(np.packbits(level, bitorder="little").view(np.uint64))
            sizes.append(size)
            keys = keys[~alone]
        return cls(sizes, np.concatenate(levels) if levels else np.zeros(0, np.uint64), np.sort(keys))

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(keys + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % 2**64)) % np.uint64(size)).astype(np.int64)

    def number(self, keys: np.ndarray) -> np.ndarray:
        """The keys' numbers; a key that was not built in gets any number, or -1."""
        out = np.full(len(keys), -1, np.int64)
        left, base = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            at = self._place(keys[left], level, size) + base
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            found = (self.bits[word] >> bit) & np.uint64(1) == 1
            word, bit = word[found], bit[found]
            out[left[found]] = self.before[word] + np.bitwise_count(self.bits[word] & ((np.uint64(1) << bit) - np.uint64(1)))
            left, base = left[~found], base + size
        if len(self.rest) and len(left):
            at = np.minimum(np.searchsorted(self.rest, keys[left]), len(self.rest) - 1)
            out[left] = np.where(self.rest[at] == keys[left], self.before[-1] + at, -1)
        return out


def _unsigned(column) -> np.ndarray:
    return np.asarray(column, np.int64).view(np.uint64)


def _flat(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False)


def pack_lines(batches: Iterator[pa.RecordBatch], min_chars: int) -> Iterator[pa.RecordBatch]:
    """Blocks of documents with the hashes of their long lines, in order."""
    names = ("block", "doc_ids", "hashes", "n_keys", "numbers", "high", "low")
    kinds = (pa.int64(), *[pa.list_(t) for t in (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64())])
    context, blocks, size = TaskContext.get(), 0, 0
    first = (context.partitionId() if context else 0) << 32
    lists: list[list[int]] = [[] for _ in names[1:]]

    def block() -> pa.RecordBatch:
        arrays = [pa.array([first + blocks], pa.int64())] + [pa.array([v], kind) for v, kind in zip(lists, kinds[1:])]
        return pa.RecordBatch.from_arrays(arrays, names=list(names))

    for batch in batches:
        for doc_id, text, text_hash in zip(*[c.to_pylist() for c in batch.columns]):
            if doc_id is None or not text:
                continue
            raw = text.encode()
            size += len(raw)
            keys = line_keys(raw, min_chars)
            if keys:
                digests = [xxhash.xxh3_128_intdigest(k) for _, k in keys]
                lists[0].append(doc_id)
                lists[1].append(text_hash)
                lists[2].append(len(keys))
                lists[3].extend(n for n, _ in keys)
                lists[4].extend((d >> 64) - (1 << 63) for d in digests)
                lists[5].extend((d & (2**64 - 1)) - (1 << 63) for d in digests)
            if size >= BLOCK_BYTES:
                yield block()
                blocks, size, lists = blocks + 1, 0, [[] for _ in names[1:]]
    if lists[0]:
        yield block()
    release()


def _shard_of(high: np.ndarray, shards: int) -> np.ndarray:
    return ((high >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def _by_shard(high: np.ndarray, shards: int, *columns: np.ndarray) -> Iterator[tuple]:
    """(shard, columns...) of rows that are sorted by their high hash."""
    of = _shard_of(high, shards)
    edges = np.flatnonzero(np.diff(of, prepend=-1, append=shards + 1))
    for a, b in zip(edges[:-1], edges[1:]):
        yield int(of[a]), *[c[a:b] for c in columns]


def _distinct(*columns: np.ndarray) -> np.ndarray:
    """Places of the distinct rows, sorted by the columns."""
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[order][1:] != c[order][:-1]
    return order[new]


def _largest_docs(high, low, doc, most: int):
    """Distinct (hash, document) rows, of each hash the ``most`` largest documents: enough for a count that stops at
    ``most`` and for the largest document, however often such parts are merged."""
    at = _distinct(high, low, doc)
    high, low, doc = high[at], low[at], doc[at]
    last = np.append((high[1:] != high[:-1]) | (low[1:] != low[:-1]), True) if len(high) else np.zeros(0, bool)
    ends = np.flatnonzero(last)
    behind = ends[np.searchsorted(ends, np.arange(len(high)))] - np.arange(len(high))
    keep = behind < most
    return high[keep], low[keep], doc[keep]


def dropped_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """doc_id, text_hash (Spark's xxhash64 of the text) and the numbers of the lines to drop, for texts that lose any."""
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.xxhash64(F.col("text").cast("string")).alias("text_hash"),
    )
    lines = stored(texts.mapInArrow(lambda batches: pack_lines(batches, min_chars), LINES), "lines")
    total = lines.agg(F.sum(F.size("numbers"))).first()[0] or 0
    shards = max(1, -(-total // KEYS_PER_SHARD))
    count_kind = np.min_scalar_type(min_docs)  # counts beyond min_docs need not be told apart

    def key_docs(batches):
        def rows(parts):
            high, low, doc = _largest_docs(*[np.concatenate(x) for x in zip(*parts)], min_docs)
            found = list(_by_shard(high, shards, high, low, doc))
            return pa.RecordBatch.from_arrays(
                [pa.array([f[0] for f in found], pa.int64()), *[pa.array([f[i].view(np.int64) for f in found], pa.list_(pa.int64())) for i in (1, 2, 3)]],
                names=["shard", "high", "low", "doc"],
            )

        parts, n = [], 0
        for batch in batches:
            doc = np.repeat(_flat(batch["doc_ids"]), _flat(batch["n_keys"]))
            parts.append((_unsigned(_flat(batch["high"])), _unsigned(_flat(batch["low"])), doc))
            n += len(doc)
            if n >= 2_000_000:
                yield rows(parts)
                parts, n = [], 0
        if parts:
            yield rows(parts)

    def build(shard: pa.Table) -> pa.Table:
        high, low, doc = _largest_docs(_unsigned(_flat(shard["high"])), _unsigned(_flat(shard["low"])), _flat(shard["doc"]), min_docs)
        last = np.append((high[1:] != high[:-1]) | (low[1:] != low[:-1]), True)
        ends = np.flatnonzero(last)
        high, low, keeper, count = high[ends], low[ends], doc[ends], np.diff(ends, prepend=-1)
        # two lines that share the high hash share a number: the arrays keep the more frequent one, the rest goes aside
        order = np.lexsort((-count, high))
        twin = np.zeros(len(order), bool)
        twin[1:] = high[order][1:] == high[order][:-1]
        main, aside = order[~twin], order[twin]
        index = MinimalPerfectHash.build(high[main])
        place = np.argsort(index.number(high[main]))
        main = main[place]
        blob = lambda x: pa.array([x.tobytes()], pa.binary())
        return pa.table({
            "shard": pa.array([shard["shard"][0].as_py()], pa.int64()), "sizes": pa.array([index.sizes], pa.list_(pa.int64())),
            "bits": blob(index.bits), "rest": blob(index.rest), "fingerprints": blob(low[main]),
            "counts": blob(np.minimum(count[main], min_docs).astype(count_kind)), "keepers": blob(keeper[main]),
            "aside": blob(np.stack([high[aside], low[aside], count[aside].astype(np.uint64), keeper[aside].view(np.uint64)])),
        })

    index = stored(
        lines.mapInArrow(key_docs, "shard long, high array<long>, low array<long>, doc array<long>").groupBy("shard").applyInArrow(
            build, "shard long, sizes array<long>, bits binary, rest binary, fingerprints binary, counts binary, keepers binary, aside binary",
        ), "line-index",
    )

    def ask(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1)
                high, low = _unsigned(_flat(one["high"])), _unsigned(_flat(one["low"]))
                at = _distinct(high, low)
                found = list(_by_shard(high[at], shards, high[at], low[at]))
                yield pa.RecordBatch.from_arrays([
                    pa.array([f[0] for f in found], pa.int64()), pa.array([one["block"][0].as_py()] * len(found), pa.int64()),
                    *[pa.array([f[i].view(np.int64) for f in found], pa.list_(pa.int64())) for i in (1, 2)],
                ], names=["shard", "block", "high", "low"])

    def probe(asked: pa.Table, shard: pa.Table) -> pa.Table:
        kinds = {"block": pa.int64(), "high": pa.list_(pa.int64()), "low": pa.list_(pa.int64()), "keeper": pa.list_(pa.int64())}
        out: dict[str, list] = {k: [] for k in kinds}
        if asked.num_rows and shard.num_rows:
            get = lambda name, kind: np.frombuffer(shard[name][0].as_py(), kind)
            index = MinimalPerfectHash(shard["sizes"][0].as_py(), get("bits", np.uint64), get("rest", np.uint64))
            fingerprints, counts, keepers = get("fingerprints", np.uint64), get("counts", count_kind), get("keepers", np.int64)
            aside = get("aside", np.uint64).reshape(4, -1)
            for block, high, low in zip(asked["block"].to_pylist(), asked["high"], asked["low"]):
                high, low = _unsigned(high.values.to_numpy(zero_copy_only=False)), _unsigned(low.values.to_numpy(zero_copy_only=False))
                number = index.number(high)
                at = np.maximum(number, 0)
                hit = (number >= 0) & (fingerprints[at] == low) & (counts[at] >= min_docs)
                keeper = keepers[at].copy()
                for h, f, count, doc in aside.T:
                    same = (high == h) & (low == f) & bool(count >= min_docs)
                    hit |= same
                    keeper[same] = doc.view(np.int64)
                if hit.any():
                    for name, v in (("block", block), ("high", high[hit].view(np.int64)), ("low", low[hit].view(np.int64)), ("keeper", keeper[hit])):
                        out[name].append(v)
        return pa.table({k: pa.array(v, kinds[k]) for k, v in out.items()})

    answers = lines.select("block", "high", "low").mapInArrow(ask, "shard long, block long, high array<long>, low array<long>").groupBy("shard").cogroup(
        index.groupBy("shard")
    ).applyInArrow(probe, "block long, high array<long>, low array<long>, keeper array<long>")

    def decide(block: pa.Table, answer: pa.Table) -> pa.Table:
        docs, hashes, drops = [], [], []
        if block.num_rows and answer.num_rows:
            high, low, keeper = _unsigned(_flat(answer["high"])), _unsigned(_flat(answer["low"])), _flat(answer["keeper"])
            known = dict(zip(zip(high.tolist(), low.tolist()), keeper.tolist()))
            n_keys, doc_ids = _flat(block["n_keys"]), _flat(block["doc_ids"])
            own = list(zip(_unsigned(_flat(block["high"])).tolist(), _unsigned(_flat(block["low"])).tolist()))
            numbers, at = _flat(block["numbers"]).tolist(), 0
            for doc, text_hash, n in zip(doc_ids.tolist(), _flat(block["hashes"]).tolist(), n_keys.tolist()):
                lost = [numbers[i] for i in range(at, at + n) if known.get(own[i], doc) != doc]
                at += n
                if lost:
                    docs.append(doc), hashes.append(text_hash), drops.append(lost)
        return pa.table({"doc_id": pa.array(docs, pa.int64()), "text_hash": pa.array(hashes, pa.int64()), "dropped": pa.array(drops, pa.list_(pa.int32()))})

    return lines.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(decide, "doc_id long, text_hash long, dropped array<int>")


@F.pandas_udf(StringType())
def _without_lines(texts: pd.Series, dropped: pd.Series) -> pd.Series:
    out = []
    for text, numbers in zip(texts, dropped):
        if text is not None and numbers is not None:
            gone = set(numbers)
            text = "\n".join(line for i, line in enumerate(text.split("\n")) if i not in gone)
        out.append(text)
    return pd.Series(out, dtype=object)


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """docs with the repeated lines taken out of `text`, and two more columns, n_lines (before) and n_dropped.

    A line's key is the line without white space at its ends and with A-Z lowered. Keys of at least ``min_chars`` code points
    found in at least ``min_docs`` documents lose all their lines except in the largest doc_id that holds them. The other
    lines stay, joined by newlines. A null text stays null and counts as one empty line. Rows with one doc_id are one
    document when documents are counted, and each loses its own lines. Rows without a doc_id are not counted and lose nothing.
    Other columns are passed on; of theirs, ones named n_lines or n_dropped are replaced. An empty table gives an empty one.
    """
    docs = docs.drop("n_lines", "n_dropped")
    names = docs.columns
    drops = dropped_lines(docs, min_chars, min_docs).dropDuplicates(["doc_id", "text_hash"])
    numbered = docs.toDF(*[f"c{i}" for i in range(len(names))])  # the frame may have columns of any names
    text, doc_id = F.col(f"c{names.index('text')}").cast("string"), F.col(f"c{names.index('doc_id')}").cast("long")
    joined = numbered.join(drops, (doc_id == drops["doc_id"]) & (F.xxhash64(text) == drops["text_hash"]), "left")
    lost = F.col("dropped").isNotNull()
    return joined.select(
        *[F.when(lost, _without_lines(F.when(lost, text), F.col("dropped"))).otherwise(text) if c == "text" else F.col(f"c{i}") for i, c in enumerate(names)],
        F.when(text.isNull(), F.lit(1)).otherwise(F.regexp_count(text, F.lit("\n")) + 1).cast("long"),
        F.when(lost, F.size("dropped")).otherwise(0).cast("long"),
    ).toDF(*names, "n_lines", "n_dropped")


def oracle_sql() -> str:
    return rf"""
        WITH t AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
        l AS (SELECT doc_id, i, lines[i] AS line,
                     translate(regexp_replace(lines[i], '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
              FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM t)),
        k AS (SELECT key, max(doc_id) AS keeper FROM l WHERE length(key) >= {MIN_CHARS} GROUP BY key HAVING count(DISTINCT doc_id) >= {MIN_DOCS}),
        d AS (SELECT doc_id, i, line, keeper IS NOT NULL AND keeper <> doc_id AS dropped FROM l LEFT JOIN k USING (key))
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT dropped), '')) AS kept_sha256
        FROM d GROUP BY doc_id
    """

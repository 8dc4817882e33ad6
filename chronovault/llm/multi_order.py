"""Exact n-gram Jaccard join by filters under several global orders of the shingles.

Two sets of similarity t share a token among the first |x| - ceil(t |x|) + 1 tokens of each, whatever the order, and share l of
them if the prefixes are longer by l - 1. The first order, by hash, keeps such a longer prefix of each set, about half of it. Of that, three
further orders take prefixes that linked sets must share as well: by how many documents have the token, rarest first, and by
two more hashes. The first of these gives buckets; a pair of a bucket is verified on the full sets only if it passes the others.

How many documents have a token is counted in shards: blocks of documents send each shard their distinct tokens once, as
32-bit codes in order, and get back one byte for each. A token that stands everywhere is one code for each block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, signed, stored
from .superminhash import _node, oracle_sql as components_sql, shingle_sets
from .tiles import pairs_of, settle, verified

#: bytes of text of a block
BLOCK_BYTES = 16_000_000
#: the share of a set, in percent, that the first prefix has beyond what the similarity itself asks for
SPARE = 35

_SALTS = [np.uint64(s) for s in (0xD1B54A32D192ED03, 0x8CB92BA72F3D8DD7, 0xAEF17502108EF2D9)]


def prefix_lengths(n: int, percent: int) -> tuple[int, int]:
    """Of a set of n tokens: the length of its prefix in the first order, and of that prefix's prefixes in the others.

    Linked sets overlap in at least ceil(t n) tokens of either, so they share spare(n) of the first prefixes' tokens, n being
    the smaller size. Of a partner's view that is at least spare(ceil(t n)), which sets the second length.
    """
    spare = lambda k: max(1, SPARE * k // 100)
    least = -(-percent * n // 100)
    first = n - least + spare(n)
    return first, first - spare(least) + 1


class _Block:
    """The distinct sets of a block of documents and the distinct tokens of their first prefixes, in the order of their codes."""

    def __init__(self, texts: pa.ChunkedArray, width: int, percent: int, shards: int):
        self.row_of: dict[int, int] = {}
        self.nodes: list[int | None] = []
        self.sizes: list[int] = []
        self.sets: list[np.ndarray] = []
        prefixes = []
        for chunk in texts.chunks:
            for _, _, sets in shingle_sets(chunk, width):
                for s in sets:
                    node = _node(s) if len(s) else None
                    self.nodes.append(node)
                    self.sizes.append(len(s))
                    if node is not None and node not in self.row_of:
                        self.row_of[node] = len(self.sets)
                        self.sets.append(s)
                        prefixes.append(s[:prefix_lengths(len(s), percent)[0]])
        tokens = mix(np.concatenate([np.zeros(0, np.uint64), *prefixes]) + _SALTS[0])
        self.tokens, self.place, self.counts = np.unique(tokens, return_inverse=True, return_counts=True)
        self.offsets = np.cumsum([0, *[len(p) for p in prefixes]])
        self.shard = ((self.tokens >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)


def _classes(found: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each entry, one byte that grows with the summed counts of its code; 0 for a sum of 1."""
    _, place = np.unique(found, return_inverse=True)
    return np.minimum(255, np.ceil(8 * np.log2(np.bincount(place, counts)))).astype(np.uint8)[place]


def keyed_sets(texts: DataFrame, width: int, percent: int) -> DataFrame:
    """doc_id, n, node, and for a set of a block that may have partners, its prefixes a, b, c in the three orders and its shingles.

    Prefixes leave out tokens that no other document has. Blocks are cut by hash of id and text, and all that passes between tasks
    is sorted and distinct, so a task that is repeated sends the same.
    """
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // BLOCK_BYTES))
    dealt = texts.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).alias("block"), "doc_id", "text")

    def send(rows: pa.Table) -> pa.Table:
        block = _Block(rows["text"], width, percent, blocks)
        ends = np.searchsorted(block.shard, np.arange(blocks + 1, dtype=np.uint64))
        used = np.flatnonzero(np.diff(ends))
        codes = (block.tokens & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        counts = np.minimum(block.counts, 255).astype(np.uint8)
        part = lambda values: pa.array([values[ends[s]:ends[s + 1]].tobytes() for s in used], pa.binary())
        return pa.table({"shard": pa.array(used, pa.int64()), "block": pa.array([rows["block"][0].as_py()] * len(used), pa.int64()), "codes": part(codes), "counts": part(counts)})

    def count(asked: pa.Table) -> pa.Table:
        joined = lambda name, kind: np.concatenate([np.frombuffer(v.as_buffer(), kind) for v in asked[name]])
        classes = _classes(joined("codes", np.uint32), joined("counts", np.uint8))
        ends = np.cumsum([len(v.as_buffer()) for v in asked["counts"]])
        return pa.table({
            "block": asked["block"], "shard": asked["shard"], "classes": pa.array([c.tobytes() for c in np.split(classes, ends[:-1])], pa.binary())})

    def choose(rows: pa.Table, answers: pa.Table) -> pa.Table:
        block = _Block(rows["text"], width, percent, blocks)
        order = np.argsort(answers["shard"].to_numpy())
        classes = np.concatenate([np.zeros(0, np.uint8), *[np.frombuffer(answers["classes"][int(i)].as_buffer(), np.uint8) for i in order]])
        prefixes: list[list[np.ndarray | None]] = [[None] * len(block.sets) for _ in range(3)]
        for i, s in enumerate(block.sets):
            own = block.place[block.offsets[i]:block.offsets[i + 1]]
            shared = classes[own] > 0
            if not shared.any():
                continue
            length = prefix_lengths(len(s), percent)[1]
            tokens = block.tokens[own]
            orders = [np.lexsort((tokens, classes[own])), np.argsort(mix(tokens ^ _SALTS[1])), np.argsort(mix(tokens ^ _SALTS[2]))]
            found = [o[:length][shared[o[:length]]] for o in orders]
            if all(len(f) for f in found):
                for column, f in zip(prefixes, found):
                    column[i] = signed(tokens[f])
        # each set stands with the first of its rows
        doc_ids = rows["doc_id"].to_pylist()
        out: dict[str, list] = {c: [] for c in ("node", "a", "b", "c", "shingles")}
        given = set()
        for node, doc_id in zip(block.nodes, doc_ids):
            node = node if doc_id is not None else None
            i = block.row_of[node] if node is not None else None
            first = i is not None and i not in given and prefixes[0][i] is not None
            if first:
                given.add(i)
            out["node"].append(node)
            for name, column in zip("abc", prefixes):
                out[name].append(column[i] if first else None)
            out["shingles"].append(block.sets[i].tobytes() if first else None)
        kinds = {"node": pa.int64(), "a": pa.list_(pa.int64()), "b": pa.list_(pa.int64()), "c": pa.list_(pa.int64()), "shingles": pa.binary()}
        return pa.table({"doc_id": rows["doc_id"], "n": pa.array(block.sizes, pa.int64()), **{k: pa.array(v, kinds[k]) for k, v in out.items()}})

    messages = dealt.groupBy("block").applyInArrow(send, "shard long, block long, codes binary, counts binary")
    answers = messages.groupBy("shard").applyInArrow(count, "block long, shard long, classes binary")
    return dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        choose, "doc_id long, n long, node long, a array<long>, b array<long>, c array<long>, shingles binary")


def candidates(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of one bucket whose sizes allow a link and which share a token in each further order."""
    side = lambda c: classes.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("b").alias(f"b_{c}"), F.col("c").alias(f"c_{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    sizes = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    return both.where(sizes & F.arrays_overlap("b_a", "b_b") & F.arrays_overlap("c_a", "c_b")).select("a", "b")


def jaccard_components(docs: DataFrame, width: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles and component_id for every row of docs.

    Texts are linked where 100 * (common shingles) >= percent * (shingles of either), shingles as in ``superminhash.shingle_sets``;
    component_id is the smallest doc_id that links reach. The join is exact: no link between different texts can be missed.
    Texts without words and rows without a doc_id are linked with nothing, their component is their own doc_id. Rows that
    repeat a doc_id are linked each by its own text; equal texts are linked. Other columns are not read; an empty table gives
    no rows.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    members = stored(keyed_sets(texts, width, percent), "keyed")
    classes = stored(members.where("a IS NOT NULL").select("node", "n", "a", "b", "c", "shingles").dropDuplicates(["node"]), "classes")
    keys = classes.select("node", F.explode("a").alias("key"))
    shared = keys.groupBy("key").agg(F.min("node").alias("centre"), F.max("node").alias("other")).where("centre <> other").drop("other")
    buckets = stored(keys.join(shared, "key"), "buckets")
    pairs = pairs_of(buckets.where("node <> centre").select(F.col("node").alias("x"), F.col("centre").alias("y")))
    links = stored(verified(candidates(pairs, classes, percent), classes, percent), "links")
    test = lambda met: verified(candidates(met, classes, percent), classes, percent)
    labels = settle(buckets, links, test, classes, percent, ("a", "b", "c"))
    linked = members.select("doc_id", "n", "node").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = linked.where("component IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return linked.join(least, "component", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def oracle_sql(width: int = 4, percent: int = 85) -> str:
    return f"SELECT doc_id, n_shingles, component_id FROM ({components_sql(width, percent)})"

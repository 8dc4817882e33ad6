"""Verification of candidate pairs on full sets, one by one or, in large groups, tile against tile.

A group of candidates that one round of comparisons has split into several components is cut into tiles of bounded size by
set size and hash. Two tiles that may hold links meet in one task, which counts all common elements at once and
emits only links that join components, at most one fewer than the components it sees. So rows follow links, and a group of
any size is spread over tasks.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ragged, release, stored
from .components import components

#: sets of a tile, and the bytes of their elements, unless one set has more
TILE_ROWS, TILE_BYTES = 512, 2_000_000
#: elements that more pairs than this have in common are counted by a matrix product, of so many columns at a time
DENSE_PAIRS, DENSE_COLUMNS = 256, 2048
#: pairs of rows written out at a time for the other elements
SPARSE_PAIRS = 2_000_000


def verify_pairs(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """The pairs (a, b) of sorted sets set_a, set_b of 64-bit hashes for which 100 * (common) >= percent * (elements of either)."""
    for batch in batches:
        keep = []
        for x, y in zip(batch["set_a"], batch["set_b"]):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                keep.append(False)
                continue
            both = np.sort(np.concatenate([x, y]))
            common = int((both[1:] == both[:-1]).sum())
            keep.append(100 * common >= percent * (len(both) - common))
        yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])
    release()


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets (node, shingles) are linked."""
    set_of = lambda c: sets.select(F.col("node").alias(c), F.col("shingles").alias(f"set_{c}"))
    both = pairs.select("a", "b").join(set_of("a"), "a").join(set_of("b"), "b")
    return both.mapInArrow(lambda batches: verify_pairs(batches, percent), "a long, b long")


def common_counts(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """How many elements each set of x has in common with each of y; sets are arrays without repeats."""
    out = np.zeros((len(x), len(y)), np.float32)
    sizes_x, sizes_y = [len(s) for s in x], [len(s) for s in y]
    if not sum(sizes_x) or not sum(sizes_y):
        return out
    kinds, column = np.unique(np.concatenate([*x, *y]), return_inverse=True)
    column_x, column_y = column[:sum(sizes_x)], column[sum(sizes_x):]
    row_x, row_y = np.repeat(np.arange(len(x)), sizes_x), np.repeat(np.arange(len(y)), sizes_y)
    holders_x, holders_y = np.bincount(column_x, minlength=len(kinds)), np.bincount(column_y, minlength=len(kinds))
    pairs = holders_x * holders_y
    dense = np.cumsum(pairs > DENSE_PAIRS) - 1
    for begin in range(0, int(dense[-1]) + 1, DENSE_COLUMNS):
        matrices = []
        for n, row, col in ((len(x), row_x, column_x), (len(y), row_y, column_y)):
            here = (pairs[col] > DENSE_PAIRS) & (dense[col] >= begin) & (dense[col] < begin + DENSE_COLUMNS)
            matrix = np.zeros((n, DENSE_COLUMNS), np.float32)
            matrix[row[here], dense[col[here]] - begin] = 1
            matrices.append(matrix)
        out += matrices[0] @ matrices[1].T
    by_column = np.argsort(column_y, kind="stable")
    first = np.cumsum(holders_y) - holders_y
    rare = np.flatnonzero((pairs[column_x] > 0) & (pairs[column_x] <= DENSE_PAIRS))
    step = max(1, SPARSE_PAIRS // max(1, DENSE_PAIRS))
    for begin in range(0, len(rare), step):
        part = rare[begin:begin + step]
        times = holders_y[column_x[part]]
        met = row_y[by_column[ragged(first[column_x[part]], times)]]
        out += np.bincount(np.repeat(row_x[part], times) * len(y) + met, minlength=out.size).reshape(out.shape)
    return out


def _joining(x: np.ndarray, y: np.ndarray, component_x: np.ndarray, component_y: np.ndarray) -> np.ndarray:
    """Of the links x[i], y[i], the places of those that join components which the links before them do not join."""
    parent: dict[int, int] = {}

    def root(c: int) -> int:
        while parent.setdefault(c, c) != c:
            parent[c] = c = parent[parent[c]]
        return c

    keep = []
    for i, (c, d) in enumerate(zip(component_x[x].tolist(), component_y[y].tolist())):
        c, d = root(c), root(d)
        if c != d:
            parent[c] = d
            keep.append(i)
    return np.array(keep, np.int64)


def compare_tiles(rows: pa.Table, percent: int, orders: list[str]) -> pa.Table:
    """Links (a, b) between the sets of side 0 and side 1, or within side 0 if there is no other, that join different components.

    ``orders`` name lists of each row; sets that have no element in common in one of them are no candidates.
    """
    side = rows["side"].to_numpy()
    parts = [rows.filter(pa.array(side == s)) for s in (0, 1)]
    if not parts[1].num_rows:
        parts[1] = parts[0]
    node, component = ([p[c].to_numpy() for p in parts] for c in ("node", "component"))
    sets = [[np.frombuffer(s.as_buffer(), np.uint64) for s in p["shingles"]] for p in parts]
    sizes = [np.array([len(s) for s in p], np.int64) for p in sets]
    smaller, larger = np.minimum.outer(*sizes), np.maximum.outer(*sizes)
    candidates = (component[0][:, None] != component[1][None]) & (100 * smaller >= percent * larger)
    for order in orders:
        if candidates.any():
            candidates &= common_counts(*[[np.asarray(v.values) for v in p[order]] for p in parts]) > 0
    x, y = np.flatnonzero(candidates.any(axis=1)), np.flatnonzero(candidates.any(axis=0))
    common = common_counts([sets[0][i] for i in x], [sets[1][i] for i in y]).astype(np.int64)
    total = sizes[0][x][:, None] + sizes[1][y][None]
    i, j = np.nonzero(candidates[np.ix_(x, y)] & (100 * common >= percent * (total - common)))
    keep = _joining(x[i], y[j], *component)
    a, b = node[0][x[i[keep]]], node[1][y[j[keep]]]
    return pa.table({"a": pa.array(np.minimum(a, b), pa.int64()), "b": pa.array(np.maximum(a, b), pa.int64())})


def mixed(members: DataFrame, labels: DataFrame) -> DataFrame:
    """The members (key, node) of buckets that hold more than one component, with it; labels are (node, component)."""
    placed = stored(members.join(labels, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component")), "placed")
    several = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    return placed.join(several.select("key"), "key", "left_semi")


def grouped(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(group, node, component), each once, of bucket members (key, node, component): a bucket belongs to the group of its largest component,
    so that buckets of one set of near copies become one group."""
    sizes = labels.groupBy("component").agg(F.count("*").alias("n_nodes"))
    sized = members.join(sizes, "component", "left")
    groups = sized.groupBy("key").agg(F.max_by("component", F.struct(F.coalesce("n_nodes", F.lit(1)), "component")).alias("group"))
    return members.join(groups, "key").select("group", "node", "component").distinct()


def tiled_links(members: DataFrame, sets: DataFrame, percent: int, orders: tuple[str, ...] = ()) -> DataFrame:
    """Links (a, b) that join the components of each group's members (group, node, component), but for those within the group's own component.

    sets are (node, shingles) and the lists named by ``orders``. Any two members of different components that are linked are
    of one component once these links are added. Sizes of linked sets differ by at most one band; tiles hold sets of one band.
    """
    percent_step = -math.log(percent / 100) + 1e-9 if percent < 100 else 1.0
    size = F.floor(F.octet_length("shingles") / 8)
    # the step is a little longer than what a link allows, so that rounding never puts linked sizes two bands apart
    sized = sets.select("node", F.octet_length("shingles").alias("bytes"), F.floor(F.log(size) / F.lit(percent_step * (1 + 1e-9))).cast("int").alias("band"))
    placed = stored(members.join(sized, "node"), "grouped")
    counts = placed.groupBy("group", "band").agg(
        F.ceil(F.greatest(F.count("*") / TILE_ROWS, F.sum("bytes") / TILE_BYTES)).cast("int").alias("tiles"))
    tile_of = placed.join(counts, ["group", "band"]).select(
        "group", "node", "component", F.struct("group", "band", F.pmod(F.xxhash64("node"), F.col("tiles")).alias("tile")).alias("id"))
    tile_of = stored(tile_of, "tiles")
    tiles = tile_of.groupBy("id").agg(F.max(F.col("component") != F.col("group")).alias("outside"))
    asking = tiles.where("outside").select(F.col("id").alias("x"), F.col("id.group").alias("group"), F.explode(F.array(*[F.col("id.band") + i for i in (-1, 0, 1)])).alias("band"))
    others = tiles.select(F.col("id").alias("y"), F.col("id.group").alias("group"), F.col("id.band").alias("band"), F.col("outside").alias("y_outside"))
    pairs = asking.join(others, ["group", "band"]).where("x <= y OR NOT y_outside").select("x", "y")
    sides = F.explode(F.when(F.col("x") == F.col("y"), F.array(F.struct(F.lit(0).alias("side"), F.col("x").alias("id")))).otherwise(
        F.array(F.struct(F.lit(0).alias("side"), F.col("x").alias("id")), F.struct(F.lit(1).alias("side"), F.col("y").alias("id")))))
    asked = pairs.select(F.struct("x", "y").alias("pair"), sides.alias("s")).select("pair", "s.side", "s.id")
    rows = asked.join(tile_of.join(sets.select("node", "shingles", *orders), "node"), "id").select("pair", "side", "node", "component", "shingles", *orders)
    compare = lambda table: compare_tiles(table, percent, list(orders))
    return rows.groupBy("pair").applyInArrow(compare, "a long, b long")


def settle(buckets: DataFrame, links: DataFrame, test: Callable[[DataFrame], DataFrame], sets: DataFrame, percent: int, orders: tuple[str, ...] = (), rounds: int = 1) -> DataFrame:
    """(node, component) once no bucket (key, node) holds two components that a link joins; links (a, b) are those known before.

    In each round, the members outside their bucket's largest component meet one member of it, and ``test`` gives the pairs (a, b) that are
    links; what is then left meets tile by tile, which decides it. ``sets`` are those of ``tiled_links``.
    """
    labels = components(links)
    rest = stored(mixed(buckets, labels), "mixed")
    for turn in range(rounds):
        if rest.isEmpty():
            return labels
        sizes = labels.groupBy("component").agg(F.count("*").alias("n_nodes"))
        # ranked by a hash of the node alone, so that the buckets of one group choose few centres
        rank = F.struct(-F.coalesce("n_nodes", F.lit(1)), "component", F.xxhash64("node", F.lit(turn)))
        centres = rest.join(sizes, "component", "left").groupBy("key").agg(F.min_by(F.struct("node", "component"), rank).alias("c"))
        met = rest.join(centres, "key").where("component <> c.component").select(F.col("node").alias("x"), F.col("c.node").alias("y"))
        links = links.union(stored(test(pairs_of(met)), "links"))
        labels = components(links)
        rest = stored(mixed(buckets, labels), "mixed")
    if rest.isEmpty():
        return labels
    return components(links.union(stored(tiled_links(grouped(rest, labels), sets, percent, orders), "links")))


def pairs_of(df: DataFrame) -> DataFrame:
    """The distinct pairs (a, b), a < b, of the rows (x, y)."""
    return df.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()

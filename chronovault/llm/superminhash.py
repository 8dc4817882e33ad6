"""Near-duplicates by SuperMinHash: signatures, banding, verification on the full shingle sets, union-find grouping.

Documents with the same shingle set are one class from the start. Classes that agree on a band share a bucket. A
bucket never gives all its pairs: each member is first compared with one centre, then, in buckets that still hold more
than one component, with a centre of another choice, and what then still belongs to different components meets tile by tile, as
nothing less would be exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NON_SPACE, list_array, mix, ragged, release, signed, stored, text_chunks, word_hashes
from .components import components
from .decontaminate import _bitmap as id_bitmap, gram_hashes
from .tiles import mixed, pairs_of, settle, verified

#: bands of four 16-bit signature values: 128 permutation ranks; at a similarity of 0.8 a link is missed once in 2e7
BANDS, BAND_ROWS = 32, 4
#: pairs whose signatures agree on a smaller share are no links: at 0.8 the share is this low once in 1e10
LEAST_AGREEMENT = 0.55
#: for what the first round leaves: so many regroupings of the signature into keys of so many values. Two documents of similarity 0.8 share
#: none of the keys once in 1.3e6; two of similarity 0.3 share one in a hundred cases
REGROUPINGS, KEY_ROWS = 12, 8
#: most bits of the map of documents whose sets are wanted
MAP_BITS = 1 << 28

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_TRACED = 6
#: rows and shingles whose signatures are made at once
_ROWS_AT_ONCE, _SHINGLES_AT_ONCE = 1024, 60_000


def superminhash(elements: np.ndarray, rows: np.ndarray, m: int) -> np.ndarray:
    """Signatures (rows x m, uint64) of sets of distinct hashes, set i being elements[rows[i]:rows[i + 1]].

    Element e's step j gives the value j + r(e, j), 0 <= r < 1, to the slot its own random permutation has at j; a slot holds
    the least of all. Steps go level by level for all sets at once: a slot that is filled at a level cannot get less later,
    so a set stops when its slots are full. The permutation is a Fisher-Yates shuffle, traced through its first swaps and
    written out only for the few elements that go on. Values are fixed point: j in the upper, r in the lower 32 bits.
    """
    n = len(rows) - 1
    empty = np.iinfo(np.uint64).max
    out = np.full(n * m, empty, np.uint64)
    sizes = np.diff(rows)
    row = np.repeat(np.arange(n), sizes)
    swaps: list[np.ndarray] = []
    perm = None
    for j in range(m):
        if not len(row):
            break
        x = mix(elements + np.uint64((j + 1) * int(_GOLDEN) % 2**64))
        k = (((x >> np.uint64(32)) * np.uint64(m - j)) >> np.uint64(32)).astype(np.int32) + j
        if perm is None and j < _TRACED:
            slot = k.copy()
            for i in range(j - 1, -1, -1):
                slot[slot == swaps[i]] = i
            swaps.append(k)
        else:
            at = np.arange(len(row))
            if perm is None:
                perm = np.tile(np.arange(m, dtype=np.int16), (len(row), 1))
                for i, s in enumerate(swaps):
                    perm[at, s], perm[:, i] = perm[:, i].copy(), perm[at, s]
            slot = perm[at, k]
            perm[at, k] = perm[:, j]
        place = row * m + slot
        free = out[place] == empty
        packed = np.sort((place[free].astype(np.uint64) << np.uint64(32)) | (x[free] & np.uint64(0xFFFFFFFF)))
        place = packed >> np.uint64(32)
        first = np.ones(len(place), bool)
        first[1:] = place[1:] != place[:-1]
        out[place[first].astype(np.int64)] = (packed[first] & np.uint64(0xFFFFFFFF)) | np.uint64(j << 32)
        open_rows = (out.reshape(n, m) == empty).any(axis=1)
        go_on = open_rows[row]
        if not go_on.all():
            row, elements = row[go_on], elements[go_on]
            if perm is None:
                swaps = [s[go_on] for s in swaps]
            else:
                perm = perm[go_on]
    return out.reshape(n, m)


def shingle_sets(column: pa.Array, width: int) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    """For parts of a text column, the sorted distinct shingle hashes of each row: ``width`` words [^\\x20\\x09-\\x0D]+ of the text
    with A-Z lowered; of fewer words, the whole sequence is the one shingle; without words the set is empty."""
    for begin, end, chunk, offsets in text_chunks(column):
        words, _, _, rows = word_hashes(chunk, offsets, NON_SPACE)
        grams = gram_hashes(words, width)
        sets = []
        for a, b in zip(rows[:-1], rows[1:]):
            if b - a >= width:
                sets.append(np.unique(grams[a:b - width + 1]))
            else:
                sets.append(mix(gram_hashes(words[a:b], b - a) + np.uint64(b - a)) if b > a else words[:0])
        yield begin, end, sets


def _node(shingles: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)


def _parts(sizes: list[int]) -> Iterator[tuple[int, int]]:
    begin, held = 0, 0
    for i, size in enumerate(sizes):
        if i > begin and (held + size > _SHINGLES_AT_ONCE or i - begin == _ROWS_AT_ONCE):
            yield begin, i
            begin, held = i, 0
        held += size
    if begin < len(sizes):
        yield begin, len(sizes)


def sign(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    m = BANDS * BAND_ROWS
    for batch in batches:
        for begin, end, sets in shingle_sets(batch["text"], width):
            for a, b in _parts([len(s) for s in sets]):
                part = sets[a:b]
                sizes = np.array([len(s) for s in part])
                values = mix(superminhash(np.concatenate(part), np.concatenate([[0], np.cumsum(sizes)]), m))
                bands = (values & np.uint64(0xFFFF)).astype(np.uint16).view(np.int64).ravel()
                offsets = np.arange(len(part) + 1) * BANDS
                ids = batch["doc_id"].slice(begin + a, len(part))
                lists = list_array(pa.array(bands), offsets)
                nodes = pa.array([_node(s) if len(s) and i.is_valid else None for s, i in zip(part, ids)], pa.int64())
                yield pa.RecordBatch.from_arrays([ids, batch["text_hash"].slice(begin + a, len(part)), pa.array(sizes), nodes, lists], names=["doc_id", "text_hash", "n_shingles", "node", "bands"])
    release()


def fine_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys of KEY_ROWS signature values each, from fixed random regroupings of the signature."""
    rng = np.random.default_rng(11)
    orders = np.stack([rng.permutation(BANDS * BAND_ROWS) for _ in range(REGROUPINGS)]).ravel()
    n_keys = len(orders) // KEY_ROWS
    for batch in batches:
        values = batch["bands"].flatten().to_numpy(zero_copy_only=False).view(np.uint16).reshape(batch.num_rows, -1)
        words = np.ascontiguousarray(values[:, orders]).view(np.uint64).reshape(batch.num_rows, n_keys, KEY_ROWS // 4)
        keys = np.broadcast_to(np.arange(n_keys, dtype=np.uint64), words.shape[:2])
        for k in range(words.shape[2]):
            keys = mix(keys ^ words[:, :, k]) + np.uint64(k)
        yield pa.RecordBatch.from_arrays(
            [batch["node"], list_array(pa.array(signed(np.ascontiguousarray(keys)).ravel()), np.arange(batch.num_rows + 1) * n_keys)], names=["node", "keys"])


def _agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose signatures agree often enough to be links."""
    for batch in batches:
        if batch.num_rows:
            x, y = [batch[c].flatten().to_numpy(zero_copy_only=False).view(np.uint16).reshape(batch.num_rows, -1) for c in ("bands_a", "bands_b")]
            batch = batch.filter(pa.array((x == y).mean(axis=1) >= LEAST_AGREEMENT))
        yield batch.select(["a", "b"])


def _sets(texts: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(node, shingles) of the classes wanted (node, doc): their texts are read again, so that the sets of others are never stored.

    A bitmap of hashed ids, its size by their number up to MAP_BITS, lets texts through where they lie; what it lets through by chance
    is dropped by the join that follows.
    """
    wanted = stored(wanted, "wanted")
    bitmap = id_bitmap(wanted.select(F.xxhash64("doc").alias("print")).distinct(), MAP_BITS)
    shift = np.uint64(64 - (len(bitmap) * 8).bit_length() + 1)

    def sets(batches):
        for batch in batches:
            bit = (batch["key"].to_numpy(zero_copy_only=False).view(np.uint64) >> shift).astype(np.int64)
            batch = batch.filter(pa.array((bitmap[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1))
            for _, _, found in shingle_sets(batch["text"], width):
                found = [s for s in found if len(s)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_node(s) for s in found], pa.int64()), pa.array([s.tobytes() for s in found], pa.binary())], names=["node", "shingles"])
        release()

    keyed = texts.where("doc_id IS NOT NULL").select(F.xxhash64("doc_id").alias("key"), "text")
    found = keyed.mapInArrow(sets, "node long, shingles binary").join(wanted.select("node"), "node", "left_semi")
    return stored(found.dropDuplicates(["node"]), "sets")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, hashed: bool = False) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of docs.

    Texts are linked where 100 * (common shingles) >= percent * (shingles of either); see ``shingle_sets``. component_id is the
    smallest doc_id that can be reached, kept is true where it is the own one. Texts without words and rows without a
    doc_id are linked with nothing: their component is their own doc_id, and they are kept. Rows that repeat a doc_id are
    judged each by its own text; equal texts are linked. Other columns are not read; an empty table gives no rows.
    ``hashed`` adds text_hash, the xxhash64 of the text, which tells the rows of one doc_id apart, and component, a number of
    the linked group, null for what is linked with nothing by rule.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    members = stored(texts.withColumn("text_hash", F.xxhash64("text")).mapInArrow(lambda b: sign(b, width), "doc_id long, text_hash long, n_shingles long, node long, bands array<long>"), "signatures")
    signed_ = members.where("node IS NOT NULL")
    smallest = signed_.groupBy("node").agg(F.min("doc_id").alias("doc"))
    classes = stored(signed_.dropDuplicates(["node"]).select("node", "n_shingles", "bands").join(smallest, "node"), "classes")
    keys = classes.select("node", F.posexplode("bands").alias("band", "value")).select("node", F.xxhash64("band", "value").alias("key"))
    shared = keys.groupBy("key").agg(F.min("node").alias("centre"), F.max("node").alias("other")).where("centre <> other").drop("other")
    buckets = stored(keys.join(shared, "key"), "buckets")
    sets = _sets(texts, buckets.select("node").distinct().join(classes.select("node", "doc"), "node"), width)
    side = lambda c: classes.select(F.col("node").alias(c), F.col("bands").alias(f"bands_{c}"))

    def test(pairs: DataFrame) -> DataFrame:
        near = pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(_agree, "a long, b long")
        return verified(near, sets, percent)

    links = stored(test(pairs_of(buckets.where("node <> centre").select(F.col("node").alias("x"), F.col("centre").alias("y")))), "links")
    labels = components(links)
    several = buckets.groupBy("key").agg(F.count("*").alias("n")).where("n > 2").select("key")  # a pair has been compared
    left = mixed(buckets.select("key", "node").join(several, "key", "left_semi"), labels).select("node").distinct()
    keyed = classes.join(left, "node", "left_semi").select("node", "bands").mapInArrow(fine_keys, "node long, keys array<long>")
    finer = stored(keyed.select("node", F.explode("keys").alias("key")), "finer")
    if not finer.isEmpty():
        labels = settle(finer, links, test, sets, percent)
    placed = classes.select("node", "doc").join(labels, "node", "left").select("node", "doc", F.coalesce("component", "node").alias("component"))
    least = placed.groupBy("component").agg(F.min("doc").alias("component_id"))
    of = placed.join(least, "component").select("node", "component", "component_id")
    out = members.select("doc_id", "text_hash", "n_shingles", "node").join(of, "node", "left")
    component = F.coalesce("component_id", "doc_id")
    more = ["text_hash", "component"] if hashed else []
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"), *more)


def oracle_sql(width: int = 2, percent: int = 80) -> str:
    grams = f"CASE WHEN len(w) < {width} THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - {width} + 2), lambda i: array_to_string(w[i:i + {width} - 1], ' ')) END"
    return rf"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_distinct({grams}) END AS s FROM w),
        e AS (SELECT doc_id, unnest(s) AS g FROM s),
        i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
        l AS (SELECT a, b FROM i JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b WHERE 100 * n >= {percent} * (len(x.s) + len(y.s) - n)),
        u AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
        r AS (SELECT doc_id, doc_id AS reach FROM s UNION SELECT r.doc_id, u.b FROM r JOIN u ON u.a = r.reach),
        c AS (SELECT doc_id, min(reach) AS component_id FROM r GROUP BY doc_id)
        SELECT doc_id, len(s) AS n_shingles, component_id, doc_id = component_id AS kept FROM s JOIN c USING (doc_id)
    """

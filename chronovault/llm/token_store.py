"""Token-id files: documents in ascending doc_id order, each compressed on its own against a shared zstandard dictionary.

A store is two Parquet tables. `dictionary` has the dictionary and its hash. `shards` has one row for each part of up
to SHARD_TOKENS ids: the hash of the dictionary, first and last doc_id, the frames one after another, and an index of doc_ids, frame ends
and token counts. Parquet is the container, as Spark reads and writes it wherever the store lies, and its statistics lead
from a doc_id to the shard, the index to the frame.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .wordbpe import WordIds, default_tokenizer, text_parts, word_bpe, word_ids

END_ID = 1
SHARD_TOKENS = 2_000_000
LEVEL = 3
#: the dictionary is trained on the documents with the smallest hashed ids, so many of them, with so many bytes of each
TRAIN_DOCS, TRAIN_BYTES, DICTIONARY_BYTES = 1000, 20_000, 64 * 1024

_HASH_PARTS = 1 << 40
#: starts of this many shards, one small row each, are sent to all tasks; more are joined by a shuffle
MOST_STARTS = 200_000

SHARDS = "part int, seq int, dict_hash string, width int, first_doc long, last_doc long, n_docs int, n_tokens long, doc_ids array<long>, frame_ends array<long>, token_counts array<int>, frames binary"


def train_dictionary(samples: list[bytes]) -> bytes:
    """A zstandard dictionary; too few samples to train on are the dictionary themselves."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES]


def _id_type(bpe) -> str:
    return "<u2" if bpe.tokenizer.get_vocab_size(with_added_tokens=True) <= 65536 else "<u4"


def pack_shards(batches: Iterator[pa.RecordBatch], path: str, dictionary: bytes, end_id: int) -> Iterator[pa.RecordBatch]:
    """Shards of the documents as they come, which is in ascending order of their ids."""
    memory, kind = word_ids(path), _id_type(word_bpe(path))
    compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
    part, seq, digest = TaskContext.get().partitionId(), 0, hashlib.sha256(dictionary).hexdigest()
    ids, frames, counts = [], [], []

    def shard() -> pa.RecordBatch:
        known = [i for i in ids if i is not None]
        row = [part, seq, digest, int(kind[2]), known[0] if known else None, known[-1] if known else None, len(ids), sum(counts), ids,
               np.cumsum([len(f) for f in frames]), counts, b"".join(frames)]
        kinds = (pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=[c.split()[0] for c in SHARDS.split(", ")])

    for batch in batches:
        texts, doc_ids = pc.fill_null(batch["text"], "").to_pylist(), batch["doc_id"].to_pylist()
        for begin, end in text_parts(texts):
            flat, at = memory.encode(texts[begin:end])
            flat = flat.astype(kind)
            tail = np.array([end_id], kind).tobytes()
            for doc_id, a, b in zip(doc_ids[begin:end], at[:-1].tolist(), at[1:].tolist()):
                ids.append(doc_id)
                frames.append(compressor.compress(flat[a:b].tobytes() + tail))
                counts.append(b - a + 1)
            if sum(counts) >= SHARD_TOKENS:
                yield shard()
                seq, ids, frames, counts = seq + 1, [], [], []
    if ids:
        yield shard()


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID) -> None:
    """Writes the ids of every whole text, with ``end_id`` after each document, as a new store at ``path``.

    Null and empty texts are the end id alone. Rows with a null doc_id come first; rows that share a doc_id stand one after another.
    Other columns are not stored. An empty table makes a store without shards.
    """
    spark, name = docs.sparkSession, tokenizer or default_tokenizer()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    hashed = texts.where("text <> ''").select(F.xxhash64("doc_id").alias("h"), F.substring("text", 1, TRAIN_BYTES).alias("text"))
    # of a large table some four times the documents needed are hashed low enough to be sorted
    part = -(-4 * TRAIN_DOCS * _HASH_PARTS // max(docs.count(), 1))
    sample = hashed.where(F.pmod("h", F.lit(_HASH_PARTS)) < part).orderBy("h", "text").limit(TRAIN_DOCS)
    samples = [r["text"] for r in sample.collect()]
    flat, at = WordIds(word_bpe(name)).encode(samples) if samples else (np.zeros(0), [])
    flat = flat.astype(_id_type(word_bpe(name)))
    dictionary = train_dictionary([flat[a:b].tobytes() for a, b in zip(at[:-1], at[1:])])
    spark.createDataFrame([(hashlib.sha256(dictionary).hexdigest(), bytearray(dictionary))], "dict_hash string, dictionary binary").coalesce(1).write.parquet(f"{path}/dictionary")
    ordered = texts.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first())
    ordered.mapInArrow(lambda b: pack_shards(b, name, dictionary, end_id), SHARDS).write.parquet(f"{path}/shards")


def unpack_shards(batches: Iterator[pa.RecordBatch], dictionary: bytes) -> Iterator[pa.RecordBatch]:
    digest = hashlib.sha256(dictionary).hexdigest()
    decompressor = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
    for batch in batches:
        for row in range(batch.num_rows):
            if batch["dict_hash"][row].as_py() != digest:
                raise ValueError("the shard was written with another dictionary")
            kind = f"<u{batch['width'][row].as_py()}"
            frames = memoryview(batch["frames"][row].as_buffer())
            ends = batch["frame_ends"][row].as_py()
            counts = np.array(batch["token_counts"][row].as_py(), np.int64)
            starts = batch["start"][row].as_py() + np.cumsum(counts) - counts
            for begin in range(0, len(ends), 500):
                part = range(begin, min(begin + 500, len(ends)))
                ids = [np.frombuffer(decompressor.decompress(frames[ends[i - 1] if i else 0:ends[i]]), kind).astype("<u4").tobytes() for i in part]
                own = slice(part.start, part.stop)
                yield pa.RecordBatch.from_arrays([
                    batch["doc_ids"][row].values.slice(part.start, len(part)), pa.array(starts[own]), pa.array(counts[own]), pa.array(ids, pa.binary()),
                ], names=["doc_id", "start", "n_tokens", "ids"])


def _dictionary(spark: SparkSession, path: str) -> bytes:
    return bytes(spark.read.parquet(f"{path}/dictionary").first()["dictionary"])


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids (little-endian unsigned 32-bit) of every document of a store."""
    dictionary = _dictionary(spark, path)
    shards = spark.read.schema(SHARDS).parquet(f"{path}/shards")
    totals = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    # one row for each partition that wrote; their number does not follow the documents
    parts = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("part_start"))
    seqs = shards.select("part", "seq", (F.sum("n_tokens").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_tokens")).alias("seq_start"))
    starts = seqs.join(parts, "part").select("part", "seq", (F.col("part_start") + F.col("seq_start")).alias("start"))
    starts = F.broadcast(starts) if shards.count() <= MOST_STARTS else starts.hint("merge")
    placed = shards.join(starts, ["part", "seq"]).select("dict_hash", "width", "start", "doc_ids", "frame_ends", "token_counts", "frames")
    return placed.mapInArrow(lambda b: unpack_shards(b, dictionary), "doc_id long, start long, n_tokens long, ids binary")


def read_document(spark: SparkSession, path: str, doc_id: int) -> list[list[int]]:
    """The ids of the rows with this doc_id: only shards whose range holds it are read, only its frames decompressed."""
    shards = spark.read.schema(SHARDS).parquet(f"{path}/shards").where((F.col("first_doc") <= doc_id) & (F.col("last_doc") >= doc_id))
    place = F.explode(F.filter(F.transform("doc_ids", lambda d, i: F.when(d == doc_id, i)), lambda i: i.isNotNull()))
    rows = shards.select("part", "seq", "width", "frame_ends", "frames", place.alias("i"))
    begin = F.when(F.col("i") > 0, F.get("frame_ends", F.col("i") - 1)).otherwise(0)
    frame = F.substring("frames", (begin + 1).cast("int"), (F.get("frame_ends", F.col("i")) - begin).cast("int"))
    dictionary = _dictionary(spark, path)
    decompressor = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
    found = rows.select("part", "seq", "i", "width", frame.alias("frame")).orderBy("part", "seq", "i").collect()
    return [np.frombuffer(decompressor.decompress(bytes(r["frame"])), f"<u{r['width']}").tolist() for r in found]

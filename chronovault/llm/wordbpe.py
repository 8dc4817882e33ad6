"""BPE of words: vectorised splitting, an exact encoder through the tokenizers library, and encoding by a distinct-word table.

Words are split in the tasks. A block of documents keeps its distinct words and, for each position, the number of its word.
The words go to shards of the distinct-word table by their hash, where each one is encoded once, however many blocks have it; the
ids go back to the blocks, which lie in buckets and are not moved for it, and are put at the positions. Decoding joins ids with the
pieces of the vocabulary.
"""

from __future__ import annotations

import functools
import os
import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import CHUNK_BYTES, mix, ragged, release, span_hashes, stored_by

#: characters of a block's texts, and distinct words of a shard on average
BLOCK_CHARS = 6_000_000
WORDS_PER_SHARD = 100_000
#: distinct words that a block or a task's memory holds at a time
MOST_WORDS = 250_000

_SPACE, _LETTER, _NUMBER, _OTHER, _ODD, _UNKNOWN = range(6)
_CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordBpe:
    """A tokenizer file whose pre-tokenizer splits words by letters, numbers and the rest, dropping white space.

    Character classes come from the library itself, asked page by page of 256 characters as they turn up. Texts that need more than
    a per-character rule (special tokens, characters beyond the basic plane or not in normal form, a letter whose
    lower case depends on its place) are split by the library.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self._bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.special = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self._special = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        self._classes = np.full(65536, _UNKNOWN, np.uint8)

    def _split(self, text: str) -> list[str]:
        return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def _class_of(self, c: str) -> int:
        if c == "Σ" or 0xD800 <= ord(c) < 0xE000 or not unicodedata.is_normalized("NFC", c) or unicodedata.combining(c):
            return _ODD
        lower = c.lower()
        if self.tokenizer.normalizer.normalize_str(c) != (lower if not c.isspace() else " ") and self._split(c):
            return _ODD
        if len(lower) != 1 or lower != c:
            return _ODD  # of lowered texts, so a letter that is not lower case by itself
        if not self._split(c):
            return _SPACE
        if len(self._split("a" + c)) == 1:
            return _LETTER
        if len(self._split("!" + c)) == 1:
            return _OTHER
        return _NUMBER

    def _page(self, page: int) -> None:
        for code in range(page << 8, (page + 1) << 8):
            self._classes[code] = self._class_of(chr(code))

    def classes(self, codes: np.ndarray) -> np.ndarray:
        out = self._classes[codes]
        if (out == _UNKNOWN).any():
            for page in np.unique(codes[out == _UNKNOWN] >> 8).tolist():
                self._page(page)
            out = self._classes[codes]
        return out

    def _slow(self, text: str) -> list[str]:
        """Words of any text, by the library; a special token is a word of its own."""
        out, at = [], 0
        for found in [*self._special.finditer(text), None]:
            part = text[at:found.start() if found else len(text)]
            if part:
                out += self._split(self.tokenizer.normalizer.normalize_str(part))
            if found:
                out.append(found.group())
                at = found.end()
        return out

    def split(self, texts: list[str]) -> tuple[str, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(joined string, hashes, starts, ends, rows): the words of the texts, in order, as spans of the joined string."""
        lowered = [t.lower() for t in texts]
        slow = [not (t.isascii() or unicodedata.is_normalized("NFC", t)) or "Σ" in t or bool(self._special.search(t)) for t in texts]
        if not any(slow):
            big = "".join(lowered)
            codes = np.frombuffer(big.encode("utf-16-le", "surrogatepass"), np.uint16)
            if len(codes) == len(big):
                kinds = self.classes(codes)
                if not (kinds == _ODD).any():
                    offsets = np.concatenate([[0], np.cumsum([len(t) for t in lowered])]).astype(np.int64)
                    starts, ends = self._spans(codes, kinds, offsets)
                    return big, span_hashes(codes, starts, ends), starts, ends, np.searchsorted(starts, offsets)
        if len(texts) > 1:  # cut the part with the odd texts down
            half = len(texts) // 2
            left, right = self.split(texts[:half]), self.split(texts[half:])
            shift = len(left[0])
            return (left[0] + right[0], np.concatenate([left[1], right[1]]), np.concatenate([left[2], right[2] + shift]),
                    np.concatenate([left[3], right[3] + shift]), np.concatenate([left[4], right[4][1:] + len(left[1])]))
        words = self._slow(texts[0])
        big = "".join(words)
        units = np.array([len(w.encode("utf-16-le", "surrogatepass")) // 2 for w in words], np.int64)
        codes = np.frombuffer(big.encode("utf-16-le", "surrogatepass"), np.uint16)
        hashes = span_hashes(codes, np.cumsum(units) - units, np.cumsum(units))
        ends = np.cumsum(np.array([len(w) for w in words], np.int64)) if words else np.zeros(0, np.int64)
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64) if words else ends
        return big, hashes, starts, ends, np.array([0, len(words)])

    def _spans(self, codes, kinds, offsets) -> tuple[np.ndarray, np.ndarray]:
        if not len(codes):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        start = np.empty(len(codes), bool)
        start[0] = True
        start[1:] = kinds[1:] != kinds[:-1]
        first = offsets[:-1]
        start[first[first < len(codes)]] = True
        start |= kinds == _NUMBER
        # contractions: an apostrophe that begins a run takes the letters after it, which then begin anew
        marks = np.flatnonzero((codes == 39) & start)
        if len(marks):
            limit = offsets[np.searchsorted(offsets, marks, side="right")]
            one = np.where(marks + 1 < limit, codes[np.minimum(marks + 1, len(codes) - 1)], 0)
            two = np.where(marks + 2 < limit, codes[np.minimum(marks + 2, len(codes) - 1)], 0)
            for letters in _CONTRACTIONS:
                at = marks[(one == ord(letters[0])) & ((two == ord(letters[1])) if len(letters) > 1 else True)]
                start[at + 1] = False
                after = at + 1 + len(letters)
                end = offsets[np.searchsorted(offsets, at, side="right")]
                start[after[after < end]] = True
        space = kinds == _SPACE
        start &= ~space
        edges = np.append(np.flatnonzero(start | space), len(codes))
        own = np.flatnonzero(start[edges[:-1]])
        return edges[own], edges[own + 1]

    def encode_word(self, word: str) -> list[int]:
        if word in self.special:
            return [self.special[word]]
        if word.isascii() and word.isprintable():  # these bytes stand for themselves
            return [t.id for t in self.model.tokenize(word)]
        return [t.id for piece, _ in self._bytes.pre_tokenize_str(word) for t in self.model.tokenize(piece)]

    @functools.cached_property
    def pieces(self) -> pa.Array:
        n = self.tokenizer.get_vocab_size(with_added_tokens=True)
        return pa.array([self.tokenizer.id_to_token(i) or "" for i in range(n)], pa.string())


@functools.lru_cache(maxsize=2)
def word_bpe(path: str) -> WordBpe:
    return WordBpe(path)


class WordNumbers:
    """Numbers of distinct words by their hashes, in the order of their first use."""

    def __init__(self):
        self.hashes, self.numbers, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), 0

    def add(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of each occurrence, and the first occurrences of words that are new, in the order of their numbers."""
        order = np.argsort(hashes)
        ordered = hashes[order]
        begins = np.ones(len(order), bool)
        begins[1:] = ordered[1:] != ordered[:-1]
        distinct, inverse = ordered[begins], np.empty(len(order), np.int64)
        inverse[order] = np.cumsum(begins) - 1
        first = np.minimum.reduceat(order, np.flatnonzero(begins)) if len(order) else order
        at = np.searchsorted(self.hashes, distinct)
        known = np.zeros(len(distinct), bool)
        inside = at < len(self.hashes)
        known[inside] = self.hashes[at[inside]] == distinct[inside]
        numbers = np.empty(len(distinct), np.int64)
        numbers[known] = self.numbers[at[known]]
        new = np.flatnonzero(~known)
        new = new[np.argsort(first[new])]
        numbers[new] = self.size + np.arange(len(new))
        self.size += len(new)
        fresh = np.sort(new)
        self.hashes = np.insert(self.hashes, at[fresh], distinct[fresh])
        self.numbers = np.insert(self.numbers, at[fresh], numbers[fresh])
        return numbers[inverse], first[new]


class WordIds:
    """Ids of words by hash: each word that is new is encoded once; started anew when it holds too many words."""

    def __init__(self, bpe: WordBpe):
        self.bpe = bpe
        self._clear()

    def _clear(self) -> None:
        self.known, self.flat, self.begins, self.used = WordNumbers(), np.zeros(1 << 16, np.int32), np.zeros(1 << 16, np.int64), 0

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the texts, one after another, and where each text's begin (one more than texts)."""
        if self.known.size >= MOST_WORDS:
            self._clear()
        big, hashes, starts, ends, rows = self.bpe.split(texts)
        before = self.known.size
        numbers, new = self.known.add(hashes)
        coded = [self.bpe.encode_word(big[a:b]) for a, b in zip(starts[new].tolist(), ends[new].tolist())]
        sizes = np.array([len(c) for c in coded], np.int64)
        fresh = np.array([i for c in coded for i in c], np.int32)
        self.flat = _room(self.flat, self.used, len(fresh))
        self.flat[self.used:self.used + len(fresh)] = fresh
        self.begins = _room(self.begins, before + 1, len(new))
        self.begins[before + 1:before + 1 + len(new)] = self.used + np.cumsum(sizes)
        self.used += len(fresh)
        begin = self.begins[numbers]
        count = self.begins[numbers + 1] - begin
        after = np.concatenate([[0], np.cumsum(count)])
        return self.flat[ragged(begin, count)], after[rows]


def _room(array: np.ndarray, used: int, more: int) -> np.ndarray:
    if used + more <= len(array):
        return array
    return np.concatenate([array[:used], np.zeros(max(len(array), more + 1024), array.dtype)])


@functools.lru_cache(maxsize=1)
def word_ids(path: str) -> WordIds:
    """One memory for all tasks that a Python worker runs."""
    return WordIds(word_bpe(path))


def text_parts(texts: list[str], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` characters; a text is never cut."""
    begin, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= limit:
            yield begin, i + 1
            begin, size = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


#: ranks below this take one byte; what is above takes its upper bits and two bytes more
_SHORT = 240
#: the leading byte of ranks that need four more
_WIDE = 255


def _pack(numbers: np.ndarray) -> bytes:
    planes = numbers.astype("<u4").view(np.uint8).reshape(-1, 4)
    return zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(planes.T).tobytes())


def _unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


def _pack_ranks(ranks: np.ndarray) -> bytes:
    """Ranks of words by frequency: most take one byte, those from ``_SHORT + (_WIDE - _SHORT) * 65536`` on five."""
    above = np.maximum(ranks - _SHORT, 0)
    lead = np.where(ranks < _SHORT, ranks, np.minimum(_SHORT + (above >> 16), _WIDE)).astype(np.uint8)
    rest = (above[(lead >= _SHORT) & (lead < _WIDE)] & 0xFFFF).astype("<u2").view(np.uint8).reshape(-1, 2)
    wide = above[lead == _WIDE].astype("<u4")
    return zstandard.ZstdCompressor(level=3).compress(len(lead).to_bytes(8, "little") + lead.tobytes() + np.ascontiguousarray(rest.T).tobytes() + wide.tobytes())


def _unpack_ranks(data: bytes) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(data)
    n = int.from_bytes(raw[:8], "little")
    lead = np.frombuffer(raw, np.uint8, n, 8)
    out = lead.astype(np.int32)
    long, wide = (lead >= _SHORT) & (lead < _WIDE), lead == _WIDE
    n_long = int(long.sum())
    rest = np.frombuffer(raw, np.uint8, 2 * n_long, 8 + n).reshape(2, -1)
    out[long] = _SHORT + ((out[long] - _SHORT) << 16) + np.ascontiguousarray(rest.T).view("<u2").ravel()
    out[wide] = _SHORT + np.frombuffer(raw[8 + n + 2 * n_long:], "<u4").astype(np.int32)
    return out


def _pack_words(words: list[str]) -> bytes:
    return zstandard.ZstdCompressor(level=9).compress("\n".join(words).encode("utf-8", "surrogatepass"))


def _unpack_words(data: bytes) -> list[str]:
    return zstandard.ZstdDecompressor().decompress(data).decode("utf-8", "surrogatepass").split("\n")


BLOCKS = "block long, doc_ids array<long>, n_words array<int>, positions binary, places binary, hashes binary, n_distinct int, words binary"


def word_blocks(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """Blocks of documents: the words of each, at each position the rank of its word, and the distinct words by hash."""
    bpe, context = word_bpe(path), TaskContext.get()
    base, done = (context.partitionId() if context else 0) << 32, 0
    ids, n_words, stream, words, known, size = [], [], [], [], WordNumbers(), 0

    def block() -> pa.RecordBatch:
        high = (known.hashes >> np.uint64(32)).astype(np.int64)
        positions = np.concatenate(stream)
        ranks = np.empty(known.size, np.int64)
        ranks[np.argsort(-np.bincount(positions, minlength=known.size), kind="stable")] = np.arange(known.size)
        row = [base + done, ids, np.concatenate(n_words).astype(np.int32), _pack_ranks(ranks[positions]), _pack(ranks[known.numbers]),
               _pack(np.diff(high, prepend=0)), known.size, _pack_words([words[i] for i in known.numbers.tolist()])]
        kinds = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary(), pa.binary(), pa.binary(), pa.int32(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=["block", "doc_ids", "n_words", "positions", "places", "hashes", "n_distinct", "words"])

    for batch in batches:
        texts, doc_ids = pc.fill_null(batch["text"], "").to_pylist(), batch["doc_id"].to_pylist()
        for begin, end in text_parts(texts):
            big, hashes, starts, ends, rows = bpe.split(texts[begin:end])
            numbers, new = known.add(hashes)
            ids += doc_ids[begin:end]
            n_words.append(np.diff(rows))
            stream.append(numbers.astype(np.int32))
            words += [big[a:b] for a, b in zip(starts[new].tolist(), ends[new].tolist())]
            size += len(big)
            if size >= BLOCK_CHARS or known.size >= MOST_WORDS:
                yield block()
                done, ids, n_words, stream, words, known, size = done + 1, [], [], [], [], WordNumbers(), 0
    if ids:
        yield block()
    ids, n_words, stream, words, known = [], [], [], [], None
    release()


def _shard_edges(hashes: bytes, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """The shards a block's words belong to, and where each begins among the words."""
    of = np.cumsum(_unpack(hashes)) * shards >> 32
    edges = np.flatnonzero(np.diff(of, prepend=-1))
    return of[edges], np.append(edges, len(of))


def encode(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id and ids (little-endian unsigned 32-bit integers in one binary) for every row of docs.

    The ids are those of the tokenizers library with add_special_tokens=False. Null and empty texts have no ids. Rows with a null or
    repeated doc_id are encoded like any other. Other columns are not read; an empty table gives no rows.
    """
    return _encode(docs, tokenizer or default_tokenizer(), False)


def round_trip(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id, ids and decoded: ``decode(encode(docs))`` with each block decoded by the task that placed its ids."""
    return _encode(docs, tokenizer or default_tokenizer(), True)


def _encode(docs: DataFrame, path: str, decoded: bool) -> DataFrame:
    pieces = word_bpe(path).pieces if decoded else None
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    blocks = stored_by(texts.mapInArrow(lambda b: word_blocks(b, path), BLOCKS), "word-blocks", "block")
    total = blocks.agg(F.sum("n_distinct")).first()[0] or 0
    shards = max(1, -(-total // WORDS_PER_SHARD))

    def deal(batches):
        for batch in batches:
            for block, n, hashes, words in zip(*[batch[c].to_pylist() for c in ("block", "n_distinct", "hashes", "words")]):
                if not n:
                    continue
                of, edges = _shard_edges(hashes, shards)
                words = _unpack_words(words)
                parts = [_pack_words(words[a:b]) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(of, pa.int64()), pa.array([block] * len(of), pa.int64()), pa.array(parts, pa.binary())], names=["shard", "block", "words"])

    def encode_shard(shard: pa.Table) -> pa.Table:
        bpe = word_bpe(path)
        lists = [_unpack_words(w.as_py()) for w in shard["words"]]
        coded = pa.array([w for words in lists for w in words], pa.string()).dictionary_encode()
        ids = [bpe.encode_word(w) for w in coded.dictionary.to_pylist()]  # the shard of the distinct-word table
        sizes = np.array([len(x) for x in ids], np.int64)
        flat, begin = np.array([i for x in ids for i in x], np.int64), np.cumsum(sizes) - sizes
        at = coded.indices.to_numpy()
        out, place = [], 0
        for n in map(len, lists):
            own = at[place:place + n]
            out.append((_pack(sizes[own]), _pack(flat[ragged(begin[own], sizes[own])])))
            place += n
        table = pa.table({"block": shard["block"], "shard": shard["shard"], "sizes": pa.array([s for s, _ in out], pa.binary()), "ids": pa.array([i for _, i in out], pa.binary())})
        del lists, coded, ids, flat, out
        release()
        return table

    answers = blocks.select("block", "n_distinct", "hashes", "words").mapInArrow(deal, "shard long, block long, words binary").groupBy("shard").applyInArrow(
        encode_shard, "block long, shard long, sizes binary, ids binary")

    def place(block: pa.Table, answer: pa.Table) -> pa.Table:
        schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])
        if not block.num_rows:
            schema = schema.append(pa.field("decoded", pa.string())) if decoded else schema
            return schema.empty_table()
        order = np.argsort(answer["shard"].to_numpy())
        parts = [(_unpack(answer["sizes"][i].as_py()), _unpack(answer["ids"][i].as_py())) for i in order.tolist()]
        sizes = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.int64)
        flat = np.concatenate([p[1] for p in parts]).astype("<u4") if parts else np.zeros(0, "<u4")
        begins = np.cumsum(sizes) - sizes
        numbers = _unpack(block["places"][0].as_py())
        by_number = np.empty(len(numbers), np.int64)
        by_number[numbers] = np.arange(len(numbers))
        positions = _unpack_ranks(block["positions"][0].as_py())
        n_words, doc_ids = block["n_words"][0].values.to_numpy(), block["doc_ids"][0].values
        ends = np.cumsum(n_words)
        chunks, a = [], 0
        while a < len(n_words):
            first = ends[a - 1] if a else 0
            b = max(a + 1, int(np.searchsorted(ends, first + 400_000, side="right")))
            words = by_number[positions[first:ends[b - 1]]]
            count = sizes[words]
            out = flat[ragged(begins[words], count)]
            after = np.concatenate([[0], np.cumsum(count)])[np.concatenate([[0], ends[a:b] - first])] * 4
            data = pa.Array.from_buffers(pa.large_binary(), b - a, [None, pa.py_buffer(after.astype(np.int64)), pa.py_buffer(out)]).cast(pa.binary())
            chunks.append(pa.RecordBatch.from_arrays([doc_ids.slice(a, b - a), data], schema=schema))
            a = b
        table = pa.Table.from_batches(decode_ids(chunks, pieces) if decoded else chunks)
        del parts, sizes, flat, begins, numbers, by_number, positions, chunks
        release()
        return table

    return blocks.select("block", "doc_ids", "n_words", "positions", "places").groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        place, "doc_id long, ids binary" + ", decoded string" * decoded)


def decode_ids(batches: Iterable[pa.RecordBatch], pieces: pa.Array) -> Iterator[pa.RecordBatch]:
    """Adds `decoded`: the pieces of the ids, joined as the library's decode(ids, skip_special_tokens=False) joins them."""
    for batch in batches:
        blobs = batch["ids"].to_pylist()
        for begin in range(0, len(blobs), 64):
            part = blobs[begin:begin + 64]
            ids = np.frombuffer(b"".join(part), "<u4")
            offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in part])]).astype(np.int32)
            words = pa.ListArray.from_arrays(pa.array(offsets), pieces.take(pa.array(ids)))
            yield pa.RecordBatch.from_arrays([*batch.slice(begin, len(part)).columns, pc.binary_join(words, " ")], names=[*batch.schema.names, "decoded"])


def decode(encoded: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id, ids and the decoded text of every row of (doc_id, ids).

    Each id meets its piece in the vocabulary, whose size the tokenizer file bounds, so every task holds it; the pieces
    are joined by spaces, as the file names no decoder. No ids give an empty text.
    """
    pieces = word_bpe(tokenizer or default_tokenizer()).pieces
    return encoded.select("doc_id", "ids").mapInArrow(lambda b: decode_ids(b, pieces), "doc_id long, ids binary, decoded string")

import hashlib
import random

import numpy as np
import pytest

from chronovault.llm.wordbpe import WordNumbers, _pack_ranks, _unpack_ranks, decode, default_tokenizer, encode, round_trip, word_bpe, word_ids

from .helpers import corpus, docs, empty, odd

ODD = [
    "", "it's 'san '' 'rest we'LL x'd 'RE don't 's't", "a1b2 33   x\x85y\x1cz", "<|endoftext|>a <|startoftext|><|endoftext", "İstanbul ΣΑΣ ß ſ K Å e\u0301", "emoji 😀 ok é",
    "日本語 тест’s “q”", "".join(map(chr, range(1, 0x800))), " ".join(map(chr, range(0x800, 0x2200))), "\x00 \x00",
]


def texts():
    rng = random.Random(1)
    return ODD + ["".join(rng.choices("abst'mdlrev 1\n.éÉ’<|>İσΣ", k=rng.randint(0, 40))) for _ in range(800)] + corpus()[0]


@pytest.fixture(scope="module")
def library():
    return word_bpe(default_tokenizer()).tokenizer


def test_memory_equals_library(library):
    flat, at = word_ids(default_tokenizer()).encode(texts())
    want = [e.ids for e in library.encode_batch(texts(), add_special_tokens=False)]
    assert [flat[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == want


def test_word_numbers_follow_first_use():
    numbers = WordNumbers()
    assert numbers.add(np.array([9, 3, 9, 5], np.uint64))[0].tolist() == [0, 1, 0, 2]
    got, new = numbers.add(np.array([4, 5, 4], np.uint64))
    assert got.tolist() == [3, 2, 3] and new.tolist() == [0]


@pytest.mark.parametrize("both", [round_trip, lambda frame: decode(encode(frame))])
def test_round_trip_equals_library(spark, library, both):
    frame, rows = odd(spark, texts())
    got = {}
    for r in both(frame).collect():
        got.setdefault(r["doc_id"], []).append((np.frombuffer(bytes(r["ids"]), "<u4").tolist(), r["decoded"]))
    for doc, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert (ids, library.decode(ids, skip_special_tokens=False)) in got[doc]
    assert sum(map(len, got.values())) == len(rows)


def test_empty_table(spark):
    assert decode(encode(empty(spark))).collect() == []


def test_decoded_hash_is_of_the_text(spark):
    row = decode(encode(docs(spark, ["Hello world"]))).first()
    assert row["decoded"] == "hello</w> world</w>" and hashlib.sha256(row["ids"]).digest()


def test_ranks_of_any_number_of_words():
    for ranks in (np.arange(1_200_000), np.array([0, 239, 240, 983_279, 983_280, 1_048_815, 1_048_816, 2**31 - 1, 5]), np.zeros(0, np.int64)):
        assert np.array_equal(_unpack_ranks(_pack_ranks(ranks)), ranks)


def test_positions_are_not_moved(spark):
    """Only words and their ids are shuffled; the blocks with the positions are read from their buckets by the tasks that place the ids."""
    frame = encode(docs(spark, texts()))
    moved = [line for line in frame._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning(" in line]
    assert sorted(line.split("hashpartitioning(")[1].split("#")[0] for line in moved) == ["block", "shard"]
    assert frame.count() == len(texts())
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("scratch_")]

import random
import re

import numpy as np

from chronovault.llm.decontaminate import contaminated_words, winnow

from .helpers import corpus, docs, empty, odd


def words_of(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(text, items):
    words, hit, found = words_of(text), set(), set()
    for item, body in items:
        own = words_of(body)
        n = min(10, len(own))
        grams = {tuple(own[i:i + n]) for i in range(len(own) - n + 1)} if n and item is not None else set()
        for i in range(len(words) - n + 1):
            if tuple(words[i:i + n]) in grams:
                hit.update(range(i, i + n))
                found.add(str(item))
    return len(words), len(hit), sorted(found)


def check(spark, frame, rows, items):
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((tuple(r) for r in contaminated_words(frame, bench).collect()), key=str)
    assert got == sorted(((d, *brute(t, items)) for d, t in rows), key=str)


def test_against_brute_force(spark):
    rng = random.Random(2)
    texts, passage, _ = corpus(1, 90)
    own = passage.split(" ")
    texts += [" ".join(own[a:a + n]) for a in (0, 3, 15) for n in (1, 4, 5, 9, 10, 11)] + [" ".join(own[5:14] + ["x"] + own[14:30])]
    texts += [", ".join(rng.choices(["la", "lo", "x9"], k=40)) for _ in range(20)]
    items = [(1, passage), (10, passage.upper() + "!"), (2, " ".join(own[2:6])), (3, "la lo"), (4, "la la la lo lo la la lo la la x9 la"), (5, None), (6, "..."), (7, own[0]), (None, passage), (2, "x9 x9 x9")]
    check(spark, docs(spark, texts), list(enumerate(texts)), items)


def test_odd_rows(spark):
    frame, rows = odd(spark, ["same words here twice and more"])
    rows_with_id = [(d, t) for d, t in rows if d is not None]
    items = [(1, "same words here twice"), (2, "word1 and word2 and word3 and word4 and word5 and word6 and"), (3, "日本")]
    check(spark, frame.where("doc_id is not null"), rows_with_id, items)
    assert contaminated_words(frame, spark.createDataFrame([], "item_id long, text string")).where("n_hit > 0").count() == 0
    assert contaminated_words(frame, spark.createDataFrame(items, "item_id long, text string")).count() == len(rows)
    assert contaminated_words(empty(spark), spark.createDataFrame(items, "item_id long, text string")).collect() == []


def test_every_window_keeps_a_fingerprint():
    rng = np.random.default_rng(0)
    for values in (2, 1000):
        hashes = rng.integers(0, values, 400).astype(np.uint64)
        at, _ = winnow(hashes, np.array([0, 150, 155, 400]), 10, 5)
        for a, b in ((0, 150), (155, 400)):
            assert all(((at >= i) & (at <= i + 5)).any() for i in range(a, b - 9))

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np

from chronovault.llm.language import ContextTrees, predict_languages, training_texts

from .helpers import DOCS, empty, odd


def brute_bits(parts, text, order):
    counts = defaultdict(Counter)
    for p in parts:
        for i in range(len(p)):
            for k in range(min(order, i) + 1):
                counts[p[i - k:i]][p[i]] += 1
    bits = 0.0
    for i in range(len(text)):
        for k in range(min(order, i), -1, -1):
            seen = counts.get(text[i - k:i])
            if not seen:
                continue
            below = sum(seen.values()) + len(seen)
            if text[i] in seen:
                bits -= math.log2(seen[text[i]] / below)
                break
            bits -= math.log2(len(seen) / below)
        else:
            bits += 8
    return bits


def test_code_lengths_by_brute_force():
    rng = random.Random(0)
    draw = lambda letters, n: bytes(rng.choice(letters) for _ in range(n))
    texts = {"a": [draw(b"abcd ", rng.randint(0, 60)) for _ in range(20)], "b": [draw(b"aaxcd ", rng.randint(1, 60)) for _ in range(20)], "c": [b"q"]}
    rows = [draw(b"abcdxz q\xc3", rng.randint(0, 40)) for _ in range(60)]
    for order in (0, 1, 3, 4):
        trees = ContextTrees(texts, order)
        got = trees.code_lengths(np.frombuffer(b"".join(rows), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in rows])]))
        want = [[brute_bits(texts[name], r, order) for name in trees.languages] for r in rows]
        assert np.allclose(got, want, atol=1e-3)


def language_docs(n, seed=0):
    rng = random.Random(seed)
    parts = {"en": ["the", "ing", "of", "and", "th", "er"], "fr": ["le", "eau", "que", "é", "ent", "des"], "de": ["der", "sch", "ung", "ü", "ein", "ch"]}
    rows = []
    for i in range(n):
        lang = rng.choice(list(parts))
        text = " ".join("".join(rng.choices(parts[lang], k=rng.randint(1, 4))) for _ in range(rng.randint(8, 40)))
        rows.append((i, text, lang, "s", 1))
    return rows


def test_held_out_accuracy(spark):
    rows = language_docs(300)
    got = {r["doc_id"]: r for r in predict_languages(spark.createDataFrame(rows, DOCS)).collect()}
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, *_ in rows)
    held = [r for r in rows if got[r[0]]["held_out"]]
    assert sum(got[r[0]]["lang_pred"] == r[2] for r in held) >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_label_and_id_are_no_inputs(spark):
    rows = language_docs(80)
    swapped = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 4 == 2 else lang, "other", 0) for i, t, lang, *_ in rows]
    a, b = (sorted(map(tuple, predict_languages(spark.createDataFrame(r, DOCS)).collect())) for r in (rows, swapped))
    assert a == b


def test_odd_rows(spark):
    frame, rows = odd(spark, ["123 !!", "日本"])
    got = predict_languages(frame).collect()
    assert len(got) == len(rows)
    unknown = {r["doc_id"] for r in got if r["lang_pred"] == "und"}
    assert {1, 2, 3, 100} <= unknown and 101 not in unknown and all(r["score"] == 0 for r in got if r["lang_pred"] == "und")
    assert predict_languages(empty(spark)).collect() == []
    assert {r["lang_pred"] for r in predict_languages(spark.createDataFrame([(1, "abc", None, "s", 1)], DOCS)).collect()} == {"und"}


def test_training_is_bounded_and_takes_long_texts(spark):
    same = [(1, f"text {i} of one id", "en", "s", 1) for i in range(50)] + [(None, "alike", "de", "s", 1)] * 50
    long = [(i, "ein langer Text " * 3000, "de", "s", 1) for i in range(100, 104)]
    found = training_texts(spark.createDataFrame(same + long, DOCS), n_docs=7, n_bytes=1000)
    assert {lang: len(texts) for lang, texts in found.items()} == {"en": 7, "de": 7}
    assert max(len(t) for texts in found.values() for t in texts) <= 1000

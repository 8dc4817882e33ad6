import random
import re
import zlib
from collections import Counter

import pytest

from chronovault.llm import spelling
from chronovault.llm.spelling import count_words, near_words, roots, spelling_variants

from .helpers import docs, empty, odd

LOWER = {c: c + 32 for c in range(65, 91)}


def counted(rows, noise):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if noise and h % noise == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7}


def near(a, b):
    """Whether exactly one inserted, deleted or replaced code point makes a into b."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(a == b[:i] + b[i + 1:] for i in range(len(b)))


def brute(rows, noise, ratio=10):
    n = {w: c for w, c in counted(rows, noise).items() if c >= 2}
    form, n_near = {}, {}
    for w in n:
        others = [v for v in n if near(w, v)]
        n_near[w] = len(others)
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= ratio * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], n_near[w], n.get(form[w])))
    return sorted(out, key=repr)


def variants_corpus(seed, n_docs=40):
    """Texts of words with all kinds of slips, so that chains of forms, ties and words of many near words arise."""
    rng = random.Random(seed)
    stems = ["".join(rng.choices("abéÀÿz", k=rng.randint(7, 11))) for _ in range(25)] + ["conference", "conferences", "Conférence", "aaaaaaa", "aaaaaaaa", "abababab", "babababa"]
    texts = []
    for _ in range(n_docs):
        words = []
        for _ in range(150):
            w = stems[int(rng.random() ** 3 * len(stems))]
            for _ in range(rng.choices([0, 1, 2], [20, 4, 1])[0]):
                i = rng.randrange(len(w))
                w = rng.choice([w[:i] + w[i + 1:], w[:i] + rng.choice("abz") + w[i:], w[:i] + rng.choice("abz") + w[i + 1:]])
            words.append(rng.choice([w, w.upper(), w + "1", w.title()]))
        texts.append(rng.choice([" ", ", ", "-"]).join(words))
    return texts


@pytest.mark.parametrize("tile, block, counted_words", [(2048, 1024, 200_000), (5, 8, 30)])
def test_against_brute_force(spark, monkeypatch, tile, block, counted_words):
    monkeypatch.setattr(spelling, "TILE_WORDS", tile)
    monkeypatch.setattr(spelling, "BLOCK_WORDS", block)
    monkeypatch.setattr(spelling, "COUNTED_WORDS", counted_words)
    texts = variants_corpus(3)
    for noise, ratio in ((31, 10), (None, 2)):
        got = sorted((tuple(r) for r in spelling_variants(docs(spark, texts), noise=noise, ratio=ratio).collect()), key=repr)
        assert got == brute(list(enumerate(texts)), noise, ratio)
    assert any(r[1] != r[2] for r in got if r[1]) and any(r[4] > 5 for r in got)


def test_dense_groups_in_tiles(spark, monkeypatch):
    """Words that all share their halves with many others, cut into tiles of 32."""
    monkeypatch.setattr(spelling, "TILE_WORDS", 16)
    rng = random.Random(1)
    words = {"".join(rng.choices("ab", k=rng.choice([7, 8, 9]))): rng.randint(1, 40) for _ in range(500)}
    got = {r["word"]: tuple(r)[1:] for r in near_words(spark.createDataFrame(list(words.items()), "word string, n long")).collect()}
    for w in words:
        others = sorted((v for v in words if near(w, v)), key=lambda v: (-words[v], v))
        assert got.get(w) == ((len(others), words[others[0]], others[0]) if others else None)


def test_odd_rows(spark):
    frame, rows = odd(spark, ["misspelled misspelled misspeled misspeled"] + ["misspelled " * 30] + ["x" * 50_000 + " " + "x" * 49_999 + " " + "x" * 50_000] * 2)
    got = sorted((tuple(r) for r in spelling_variants(frame, noise=31).collect()), key=repr)
    assert got == brute(rows, 31)
    assert {r[0]: r[4] for r in got}["x" * 50_000] >= 0
    assert spelling_variants(empty(spark)).collect() == []


def test_counts_pass_on_in_parts(spark, monkeypatch):
    monkeypatch.setattr(spelling, "COUNTED_WORDS", 3)
    texts = variants_corpus(5, 6)
    got = {r["word"]: r["n"] for r in count_words(docs(spark, texts).repartition(3), noise=31).collect()}
    assert got == counted(list(enumerate(texts)), 31)


def test_long_chains_of_forms(spark):
    chain = [(f"w{i}", f"w{i + 1}") for i in range(19)]
    got = {r["word"]: r["root"] for r in roots(spark.createDataFrame(chain + [("a", "w0"), ("b", "c")], "word string, form string")).collect()}
    assert got == {**{f"w{i}": "w19" for i in range(19)}, "a": "w19", "b": "c"}

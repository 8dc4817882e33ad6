import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from chronovault.llm.common import mix
from chronovault.llm.components import components
from chronovault.llm.superminhash import near_duplicates, superminhash

from .helpers import corpus, docs, empty, odd


def plain_superminhash(elements, m):
    """The algorithm element by element, with its permutation written out."""
    out = [2**64 - 1] * m
    for e in elements:
        p = list(range(m))
        for j in range(m):
            x = int(mix(np.array([(int(e) + (j + 1) * 0x9E3779B97F4A7C15) % 2**64], np.uint64))[0])
            k = ((x >> 32) * (m - j) >> 32) + j
            p[j], p[k] = p[k], p[j]
            out[p[j]] = min(out[p[j]], (j << 32) | (x & 0xFFFFFFFF))
    return out


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(0, 90), min_size=1, max_size=5), st.integers(0, 1000))
def test_levels_equal_the_plain_algorithm(sizes, seed):
    elements = np.random.default_rng(seed).integers(0, 2**63, sum(sizes)).astype(np.uint64)
    rows = np.concatenate([[0], np.cumsum(sizes)])
    got = superminhash(elements, rows, 24)
    assert [r.tolist() for r in got] == [plain_superminhash(elements[a:b], 24) for a, b in zip(rows[:-1], rows[1:])]


def test_agreement_estimates_similarity():
    rng = np.random.default_rng(1)
    errors = []
    for common in (100, 300, 700):
        all_ = rng.integers(0, 2**63, 1000).astype(np.uint64)
        a, b = all_[:common + (1000 - common) // 2], np.concatenate([all_[:common], all_[common + (1000 - common) // 2:]])
        s = superminhash(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), 512)
        errors.append(abs((s[0] == s[1]).mean() - common / 1000))
    assert max(errors) < 0.08


def brute(rows, width, percent):
    """Component of each row; rows are (doc_id, text)."""
    sets = []
    for doc, text in rows:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
        sets.append(set() if not w else {tuple(w)} if len(w) < width else {tuple(w[i:i + width]) for i in range(len(w) - width + 1)})
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and rows[i][0] is not None and rows[j][0] is not None and 100 * len(a & b) >= percent * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), doc), doc) if doc is not None else doc
    return sorted(((doc, len(sets[i]), least[root(i)], doc == least[root(i)]) for i, (doc, _) in enumerate(rows)), key=str)


def result(df, width, percent=80):
    return sorted((tuple(r) for r in near_duplicates(df, width, percent).collect()), key=str)


def test_against_brute_force(spark):
    rng = random.Random(9)
    texts = corpus(4, 150)[0]
    # chains of near copies, and a star whose arms are not similar to each other
    base = [f"w{i}" for i in range(60)]
    for i in range(12):
        base[rng.randrange(60)] = f"c{i}"
        texts.append(" ".join(base))
    middle = [f"m{i}" for i in range(21)]
    for i in range(0, 20, 2):
        arm = list(middle)
        arm[i] = f"arm{i}"
        texts.append(" ".join(arm))
    texts += [" ".join(middle), "one", "ONE", "two words", "Two  words", "two", "", " "]
    rng.shuffle(texts)
    for width in (2, 5):
        assert result(docs(spark, texts), width) == brute(list(enumerate(texts)), width, 80)


def test_a_large_group_of_near_copies_by_brute_force(spark):
    rng = random.Random(3)
    base = [f"w{i}" for i in range(40)]
    texts = []
    for i in range(220):
        own = list(base)
        for _ in range(rng.randint(0, 6)):
            own[rng.randrange(40)] = rng.choice(["x", "y", f"e{rng.randrange(60)}"])
        if i % 3 == 0:
            del own[rng.randrange(30):][:rng.randint(0, 4)]
        texts.append(" ".join(own))
    assert result(docs(spark, texts), 2) == brute(list(enumerate(texts)), 2, 80)


def test_odd_rows(spark):
    frame, rows = odd(spark, ["same words here twice", "SAME words  here twice"])
    assert result(frame, 2) == [tuple(True if r[0] is None and k == 3 else x for k, x in enumerate(r)) for r in brute(rows, 2, 80)]
    assert result(empty(spark), 2) == []


@pytest.mark.parametrize("task_links", [100_000, 40])
def test_components_by_brute_force(spark, monkeypatch, task_links):
    monkeypatch.setattr("chronovault.llm.components.TASK_LINKS", task_links)
    rng = random.Random(0)
    chain = [(i, i + 1) for i in range(100, 160)]
    links = [(rng.randrange(80), rng.randrange(80)) for _ in range(60)] + chain + [(500 + i, 700) for i in range(50)] + [(-5, 3)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long").repartition(5)).collect()}
    parent = {x: x for link in links for x in link}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    assert got == {x: root(x) for link in links if link[0] != link[1] for x in link}


def test_components_are_those_of_the_exact_join(spark):
    """Groups of near copies about the threshold: the exact n-gram join gives the same components."""
    from chronovault.llm.multi_order import jaccard_components
    rng = random.Random(12)
    texts = []
    for g in range(6):
        base = [f"g{g}w{i}" for i in range(rng.randint(25, 90))]
        for _ in range(50):
            own = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 9))):
                own[rng.randrange(len(own))] = f"e{rng.randrange(500)}"
            texts.append(" ".join(own))
    frame = docs(spark, texts)
    exact = {r["doc_id"]: r["component_id"] for r in jaccard_components(frame, 2, 80).collect()}
    assert {r["doc_id"]: r["component_id"] for r in near_duplicates(frame, 2).collect()} == exact
    assert 6 < len(set(exact.values())) < len(texts)

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from chronovault.llm import multi_order, tiles
from chronovault.llm.multi_order import jaccard_components, prefix_lengths
from chronovault.llm.tiles import common_counts

from .helpers import corpus, docs, empty, odd
from .test_superminhash import brute


def result(df, width=4, percent=85):
    return sorted((tuple(r) for r in jaccard_components(df, width, percent).collect()), key=str)


def expected(rows, width=4, percent=85):
    return sorted((r[:3] for r in brute(rows, width, percent)), key=str)


def near_copies(seed, n, length=60, most=6):
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(length)]
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(rng.randint(0, most)):
            own[rng.randrange(length)] = rng.choice(["x", "y", f"e{rng.randrange(60)}"])
        out.append(" ".join(own[rng.choice([0, 0, 3]):]))
    return out


@pytest.mark.parametrize("block_bytes, tile_rows", [(16_000_000, 512), (2_000, 7)])
def test_against_brute_force(spark, monkeypatch, block_bytes, tile_rows):
    """Random texts, chains, large groups of near copies around the threshold, a passage most texts hold; also in small blocks and tiles."""
    monkeypatch.setattr(multi_order, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(tiles, "TILE_ROWS", tile_rows)
    rng = random.Random(5)
    texts = corpus(6, 120)[0] + near_copies(1, 120) + near_copies(2, 60, 200, 12)
    passage = " ".join(f"p{i}" for i in range(40))
    texts = [f"{t} {passage}" if i % 3 == 0 else t for i, t in enumerate(texts)]
    texts += [passage] * 3 + [passage + " more", "one", "ONE", "one two three", "one two  three", "one two three four", "", " "]
    chain = [f"c{i}" for i in range(80)]
    for i in range(25):
        chain[rng.randrange(80)] = f"d{i}"
        texts.append(" ".join(chain))
    rng.shuffle(texts)
    assert result(docs(spark, texts)) == expected(list(enumerate(texts)))
    assert result(docs(spark, texts[:150]), 2, 80) == expected(list(enumerate(texts[:150])), 2, 80)


def test_odd_rows(spark):
    frame, rows = odd(spark, ["same words here twice", "SAME words  here twice", "same words here"])
    assert result(frame) == expected(rows)
    assert result(empty(spark)) == []


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 60), st.integers(0, 60), st.sampled_from([50, 80, 85, 100]), st.integers(0, 10_000))
def test_linked_sets_share_each_prefix(n, changed, percent, seed):
    rng = random.Random(seed)
    x = set(rng.sample(range(1000), n))
    y = set(rng.sample(sorted(x), max(1, n - changed))) | {rng.randrange(1000) for _ in range(rng.randint(0, changed))}
    if 100 * len(x & y) < percent * len(x | y):
        return
    firsts = [sorted(s)[:prefix_lengths(len(s), percent)[0]] for s in (x, y)]
    for _ in range(3):
        order = list(range(1000))
        rng.shuffle(order)
        a, b = (set(sorted(f, key=order.__getitem__)[:prefix_lengths(len(s), percent)[1]]) for f, s in zip(firsts, (x, y)))
        assert a & b


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 10_000), st.sampled_from([0, 3, 256]))
def test_common_counts(seed, dense):
    rng = np.random.default_rng(seed)
    sets = lambda n: [rng.choice(np.uint64(1) << rng.integers(0, 40, 30).astype(np.uint64), rng.integers(0, 20), replace=False) for _ in range(n)]
    x, y = [[np.unique(s) for s in sets(n)] for n in (6, 9)]
    before, tiles.DENSE_PAIRS = tiles.DENSE_PAIRS, dense
    columns, tiles.DENSE_COLUMNS = tiles.DENSE_COLUMNS, 4
    try:
        got = common_counts(x, y)
    finally:
        tiles.DENSE_PAIRS, tiles.DENSE_COLUMNS = before, columns
    assert got.tolist() == [[len(set(a.tolist()) & set(b.tolist())) for b in y] for a in x]

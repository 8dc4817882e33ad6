import hashlib
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from chronovault.llm.line_dedup import MinimalPerfectHash, dedup_lines

from .helpers import corpus, docs, empty, odd


def brute(rows):
    """Kept text, lines and dropped lines of each row."""
    key = lambda x: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x.strip(" \t\n\x0b\x0c\r"))
    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if doc is not None and len(key(line)) >= 20:
                holders[key(line)].add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if doc is None or len(holders.get(key(x), ())) < 3 or max(holders[key(x)]) == doc]
        out.append((doc, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def result(df):
    rows = dedup_lines(df).select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256)).collect()
    return sorted((tuple(r) for r in rows), key=str)


def test_perfect_hash_numbers_all_keys_without_gaps():
    for n in (0, 1, 2, 1000, 50_000):
        keys = np.random.default_rng(n).integers(0, 2**63, n).astype(np.uint64)
        keys = np.unique(keys)
        index = MinimalPerfectHash.build(keys)
        assert sorted(index.number(keys).tolist()) == list(range(len(keys)))
        assert (index.number(~keys) < len(keys)).all()


def test_equal_keys_end_in_the_sorted_rest():
    keys = np.array([5, 9, 5, 7], np.uint64)
    index = MinimalPerfectHash.build(np.unique(keys))
    assert len(set(index.number(keys).tolist())) == 3


def test_against_brute_force(spark):
    texts, _, _ = corpus()
    shared = ["A line of twenty chars.", "  a LINE of twenty chars.\t", "ééééééééééééééééééé", "éééééééééééééééééééé", "\n\nA line of twenty chars.\nA line of twenty chars.\n"]
    texts += [a + "\n" + b for a in shared for b in shared]
    frame = docs(spark, texts)
    assert result(frame) == brute(list(enumerate(texts)))


def test_odd_rows(spark):
    line = "one line that is long enough"
    frame, rows = odd(spark, [line, "x\n" + line, line + "\ny", line + "\n" + line])
    assert result(frame) == brute(rows)
    kept = dedup_lines(frame)
    assert set(frame.columns) == set(kept.columns)
    assert result(empty(spark)) == []


def test_rows_of_one_id_are_one_document(spark):
    line = "one line that is long enough"
    frame = spark.createDataFrame([(1, line), (1, line + "\nx"), (2, line), (2, line)], "doc_id long, text string")
    assert result(frame) == brute([(1, line), (1, line + "\nx"), (2, line), (2, line)])


def test_more_documents_than_a_byte_counts(spark):
    line = "one line that each of the documents holds"
    frame = docs(spark, [line + f"\nown {i}" for i in range(300)])
    assert sum(r["n_dropped"] for r in dedup_lines(frame, min_docs=260).collect()) == 299
    assert sum(r["n_dropped"] for r in dedup_lines(frame, min_docs=301).collect()) == 0

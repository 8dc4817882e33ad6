import random
import re

import pytest
from pyspark.sql import functions as F

from chronovault.llm.token_attribution import SENTENCES, byte_bpe, default_ranks, field_tokens, section_tokens

from .helpers import corpus, docs, empty, odd


def brute(text, spans, rule):
    """Token counts of the spans, given in code points."""
    encoding, _ = byte_bpe(default_ranks())
    own = {}
    for k, (a, b) in enumerate(spans):
        for byte in range(len(text[:a].encode()), len(text[:b].encode())):
            own[byte] = k
    counts, at, crossing, tokens = [0.0] * len(spans), 0, 0, encoding.encode_ordinary(text)
    for token in tokens:
        n = len(encoding.decode_single_token_bytes(token))
        touched = [own[i] for i in range(at, at + n) if i in own]
        at += n
        if not touched:
            continue
        crossing += len(set(touched)) > 1
        if rule == "share":
            for k in set(touched):
                counts[k] += touched.count(k) / len(touched)
        else:
            pick = {"first": touched[0], "last": touched[-1], "most": max(set(touched), key=lambda k: (touched.count(k), -k))}[rule]
            counts[pick] += 1
    return len(tokens), crossing, counts


def sentences(text):
    cuts = [0, *[m.end() for m in re.finditer(SENTENCES, text) if m.end() < len(text)], len(text)]
    return list(zip(cuts[:-1], cuts[1:]))


@pytest.mark.parametrize("rule", ["first", "last", "most", "share"])
def test_sentences_and_given_spans(spark, rule):
    rng = random.Random(4)
    texts = corpus(n=12)[0] + ["One two. Three!\n\n Four? é日本. 😀 x", "", "no end"]
    got = {r["doc_id"]: r for r in section_tokens(docs(spark, texts), rule=rule).collect()}
    for i, text in enumerate(texts):
        n, crossing, counts = brute(text, sentences(text), rule)
        assert (got[i]["n_tokens"], got[i]["n_crossing"]) == (n, crossing) and got[i]["section_tokens"] == pytest.approx(counts)
    spans = []
    for text in texts:
        cuts = sorted(rng.randint(0, len(text)) for _ in range(8))
        spans.append([(cuts[k], cuts[k + 1]) for k in (0, 2, 3, 6)])
    given = spark.createDataFrame([(i, t, [a for a, _ in s], [b for _, b in s]) for i, (t, s) in enumerate(zip(texts, spans))], "doc_id long, text string, a array<long>, b array<long>")
    got = {r["doc_id"]: r for r in section_tokens(given, F.struct(F.col("a").alias("first"), F.col("b").alias("after")), rule=rule).collect()}
    for i, text in enumerate(texts):
        n, crossing, counts = brute(text, spans[i], rule)
        assert (got[i]["n_tokens"], got[i]["n_crossing"]) == (n, crossing) and got[i]["section_tokens"] == pytest.approx(counts)


def test_fields(spark):
    rows = spark.createDataFrame([(1, "user", "hello there"), (2, None, "é"), (None, "", None)], "k long, role string, text string")
    for r in field_tokens(rows, "k", ["role", "text"], " ").collect():
        role, text = {1: ("user", "hello there"), 2: ("", "é"), None: ("", "")}[r["k"]]
        n, crossing, counts = brute(f"{role} {text}", [(0, len(role)), (len(role) + 1, len(role) + 1 + len(text))], "most")
        assert tuple(r) == (r["k"], n, crossing, *counts)


def test_odd_rows(spark):
    frame, rows = odd(spark)
    got = section_tokens(frame).collect()
    assert len(got) == len(rows) and all(r["n_tokens"] == sum(r["section_tokens"]) for r in got)
    assert section_tokens(empty(spark)).collect() == []
    with pytest.raises(ValueError):
        section_tokens(frame, rule="other")

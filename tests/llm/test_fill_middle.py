import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from chronovault.llm import common
from chronovault.llm.fill_middle import fill_in_middle, restore

from .helpers import corpus, docs, empty, odd


def plain(doc_id, text, rate, spm, seed):
    """The transformation of one text by slicing."""
    text = text or ""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[8 * i:8 * i + 8], 16) for i in range(4)]
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = ("".join(u) for u in (units[:a], units[a:b], units[b:]))
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= rate:
        return doc_id, len(units), "plain", None, None, text, text
    if h[3] % 100 < spm:
        return doc_id, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}", text
    return doc_id, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}", text


def check(frame, rows, rate=50, spm=80, seed=42):
    got = [tuple(r) for r in restore(fill_in_middle(frame, rate, spm, seed)).collect()]
    assert sorted(got, key=repr) == sorted((plain(d, t, rate, spm, seed) for d, t in rows), key=repr)


@pytest.mark.parametrize("rate, spm, limit", [(50, 80, 500_000), (100, 50, 700), (100, 0, 1), (0, 0, 50)])
def test_against_slicing(spark, monkeypatch, rate, spm, limit):
    monkeypatch.setattr(common.text_chunks, "__defaults__", (limit,))
    texts = corpus(2, 80)[0] + [
        "", " ", "\n\t ", "one", " one", "one ", " one  two ", "<P>", "a <M> b", "x<S", "<", "a < P>", "<P", "S>", "é", "日本 語 😀 ß", "tail   no-break \x1f \x85 kept", "nul \x00 byte", "<<S", "P>>"]
    check(docs(spark, texts), list(enumerate(texts)), rate, spm)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text(alphabet="<PSM> a\né😀 ", max_size=12), max_size=8), st.integers(0, 99))
def test_any_texts(spark, texts, seed):
    check(docs(spark, texts), list(enumerate(texts)), 100, 50, seed)


def test_odd_rows(spark):
    frame, rows = odd(spark)
    check(frame, rows)
    assert restore(fill_in_middle(empty(spark))).collect() == []


def test_columns_pass_through_restore_and_faults_are_errors(spark):
    frame = spark.createDataFrame([("<S>c<P>a<M>b", "spm", "old", 1), (None, "plain", "old", 2)], "output string, form string, text string, `a.b` long")
    out = restore(frame)
    assert sorted(out.columns) == ["a.b", "form", "output", "text"]
    assert {(r["text"], r["a.b"]) for r in out.collect()} == {("abc", 1), ("", 2)}
    with pytest.raises(Exception, match="each marker once"):
        restore(spark.createDataFrame([("<S>c<P>a", "spm")], "output string, form string")).collect()

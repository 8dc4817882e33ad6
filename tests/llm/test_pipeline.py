"""The pipeline's stages against brute force on a small corpus, and on odd tables."""

import re

import corpus_pipeline as pipeline
from chronovault.llm.common import stored

from .helpers import DOCS, odd
from .test_decontaminate import brute as hits
from .test_language import language_docs
from .test_line_dedup import brute as lines_of
from .test_superminhash import brute as groups_of


def write(spark, path, rows, items):
    spark.createDataFrame(rows, DOCS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")


def test_stages_by_brute_force(spark, tmp_path):
    rows = language_docs(60)
    shared = "the ing of and ther ofer anding"
    passage = rows[3][1]
    rows = [(i, t + ("\n" + shared if i % 9 == 1 else "") + ("\n" + passage if i % 13 == 2 else ""), lang, s, n) for i, t, lang, s, n in rows]
    rows += [(100 + i, rows[i][1], *rows[i][2:]) for i in range(5)] + [(200, "12 34 !", "en", "s", 1), (201, None, "en", "s", 1), (202, shared, "en", "s", 1)]
    items = [(1, passage)]
    write(spark, str(tmp_path), rows, items)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    expected = {r[0]: r[1] for r in rows}
    after = []
    for name, stage in pipeline.STAGES:
        docs = stored(stage(spark, docs, str(tmp_path)), name)
        if name == "language":
            expected = {d: t for d, t in expected.items() if t and re.search("[a-z]", t)}
        elif name == "line_dedup":
            lost = {d: n for d, _, n, _ in lines_of(list(expected.items()))}
            assert sum(lost.values()) > 0
            got = {r["doc_id"]: r["text"] for r in docs.collect()}
            assert all(len(expected[d].split("\n")) - lost[d] == len(t.split("\n")) for d, t in got.items())
            assert set(expected) - set(got) == {d for d in expected if lost[d] == len(expected[d].split("\n"))}
            expected = got
        elif name == "near_dedup":
            expected = {d: expected[d] for d, _, _, kept in groups_of(list(expected.items()), 5, 80) if kept}
        elif name == "decontaminate":
            expected = {d: t for d, t in expected.items() if hits(t, items)[1] == 0}
        assert {r["doc_id"] for r in docs.collect()} == set(expected), name
        after.append(docs.count())
    assert after == sorted(after, reverse=True) and after[-1] < after[0]
    final = pipeline.run(spark, str(tmp_path))
    assert sorted(map(tuple, final.collect())) == sorted(map(tuple, docs.collect()))


def test_odd_and_empty_tables(spark, tmp_path):
    frame, _ = odd(spark)
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for docs in (frame, frame.limit(0)):
        for name, stage in pipeline.STAGES[:-1]:
            columns = docs.columns
            docs = stored(stage(spark, docs, str(tmp_path)), name)
            assert docs.columns == columns
        pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()


def test_rows_of_one_id_are_judged_by_their_own_text(spark, tmp_path):
    """A null id and a repeated one, each with a good and a bad text: only the bad one goes."""
    passage = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda"
    clean = ["some clean text of words that no other row has at all here", "another clean text which is about rather different things now"]
    rows = [(i, t, "en", "s", len(t)) for i, c in ((None, clean[0]), (7, clean[1])) for t in (c, f"{passage} and {c.split()[0]}", "12 34 !")]
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame(rows, DOCS)
    texts = lambda df: sorted((str(r["doc_id"]), r["text"]) for r in df.collect())
    assert texts(pipeline.drop_contaminated(spark, docs, str(tmp_path))) == sorted((str(r[0]), r[1]) for r in rows if passage not in r[1])
    assert texts(pipeline.identify_language(spark, docs, str(tmp_path))) == sorted((str(r[0]), r[1]) for r in rows if r[1] != "12 34 !")

    long = " ".join(f"word{i}" for i in range(60))
    near = [(1, long), (7, long + " more"), (7, clean[0]), (7, clean[0]), (8, clean[1]), (8, clean[1] + " "), (None, clean[0]), (None, clean[0])]
    got = texts(pipeline.dedup_near(spark, spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in near], DOCS), str(tmp_path)))
    assert [(i, t.strip()) for i, t in got] == sorted([("1", long), ("7", clean[0]), ("8", clean[1]), ("None", clean[0])])


def test_columns_of_any_name_come_through(spark, tmp_path):
    """Columns named like the stages' own, and names with dots and quotes, keep their values."""
    passage = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda"
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    names = ["_id", "_null_id", "_text_hash", "key0", "key_0", "_drop_id", "_drop_hash", "_dropped", "dropped", "text_hash", "component", "c0", "c1", "lang_pred", "score", "a.b", "x`y", "letters"]
    line = "a line of words that many documents have among their own"
    texts = [f"some clean text number {i} of words that no other row has at all here\n{line}" for i in range(6)] + [f"{passage} and more", "12 34 !", None]
    frame = spark.createDataFrame([(i, t, "en", "s", 1, *["keep-me"] * len(names)) for i, t in enumerate(texts)], DOCS + "".join(f", `{n.replace('`', '``')}` string" for n in names))
    docs = frame
    for name, stage in pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, str(tmp_path)), name)
        assert docs.columns == frame.columns
        assert {v for r in docs.collect() for v in tuple(r)[5:]} == {"keep-me"}
    assert len([r for r in docs.collect() if r["text"].startswith("some clean")]) == docs.count() > 0


def test_a_foreign_text_goes_and_short_clean_ones_stay(spark):
    rows = language_docs(120)
    foreign = "жили были дед и баба ели кашу с молоком рассердился дед на бабу хлоп по пузу кулаком " * 3
    short = [(900 + i, " ".join(r[1].split()[:6]), *r[2:]) for i, r in enumerate(rows[:24])]
    docs = spark.createDataFrame(rows + short + [(990, foreign, None, "s", 1)], DOCS)
    kept = {r["doc_id"] for r in pipeline.identify_language(spark, docs, "").collect()}
    assert {r[0] for r in rows} <= kept and {r[0] for r in short} <= kept



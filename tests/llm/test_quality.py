import random
import re

from pyspark.sql import functions as F

from chronovault.llm.quality import judge_quality, learn_decision_list, quality_statistics

from .helpers import corpus, docs, empty, odd


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_statistics_by_brute_force(spark):
    rng = random.Random(5)
    texts = corpus()[0] + [" ".join(rng.choices("ab", k=n)) for n in range(12)] + ["x\x0by\x0cz\r\n\x1c\x85 \xa0w", "a # b|c <d>\na # b|c <d>\n\n a # b|c <d>", "é\x00 é"]
    got = {r["doc_id"]: r for r in quality_statistics(docs(spark, texts)).collect()}
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    for i, text in enumerate(texts):
        assert tuple(got[i][n] for n in names) == brute(text), text


def test_learned_list_finds_the_bad_rows(spark):
    rng = random.Random(1)
    texts, quality = [], []
    for i in range(300):
        words = [rng.choice(["tree", "house", "river", "stone", "cloud"]) + str(rng.randint(0, 99)) for _ in range(rng.randint(60, 200))]
        bad = i % 4 == 0
        texts.append(" ".join(w + ("##" if bad else "") for w in words))
        quality.append(int(not bad))
    labels = spark.createDataFrame([(i, q) for i, q in enumerate(quality) if i % 3] + [(None, 0), (7, None)], "doc_id long, quality int")
    judged = {r["doc_id"]: r["kept"] for r in judge_quality(docs(spark, texts), labels).collect()}
    assert sum(judged[i] == bool(q) for i, q in enumerate(quality)) >= 297
    rules = learn_decision_list(quality_statistics(docs(spark, texts)), labels)
    assert rules and rules[0][0].feature in ("symbols_per_word", "chars_per_word") and rules[0][0].above


def test_odd_rows(spark):
    frame, rows = odd(spark)
    labels = spark.createDataFrame([], "doc_id long, quality int")
    got = judge_quality(frame, labels)
    assert got.count() == len(rows)
    assert got.where("doc_id = 1 AND n_words = 0 AND base_failed AND NOT kept").count() == 1
    assert judge_quality(empty(spark), labels).count() == 0


def test_native(spark):
    plan = judge_quality(docs(spark, ["a b c"]), spark.createDataFrame([], "doc_id long, quality int"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    plan = quality_statistics(docs(spark, ["a b c"]).where(F.col("doc_id") >= 0))._jdf.queryExecution().toString()
    assert not re.search("PythonUDF|MapIn|ArrowEval", plan)

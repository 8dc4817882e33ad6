"""Small document tables with every odd case the operators define."""

import random
import string

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts, first=0, lang="en"):
    rows = [(first + i, t, lang, "s", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def odd(spark, extra=()):
    """Nulls in every column, empty and blank texts, a long text, a repeated row, and columns that clash with results."""
    long_text = " ".join(f"word{i % 977} and" for i in range(30_000))
    rows = [
        (1, None, None, None, None), (2, "", "en", "s", 0), (3, " \t\n\r\n ", "en", "s", 5), (4, long_text, "en", "s", 1), (5, "same words here twice", "en", "s", 1),
        (5, "same words here twice", "en", "s", 1), (None, "a text without an id, of some length", "en", "s", 1), (6, "é ß 日本 😀 <|endoftext|> it's", "fr", "s", 2),
        *[(100 + i, t, "en", "s", len(t)) for i, t in enumerate(extra)],
    ]
    names = ["node", "n_lines", "n_dropped", "kept", "block", "score", "start", "key", "rule"]
    frame = spark.createDataFrame([(*r, *["x"] * len(names)) for r in rows], DOCS + "".join(f", {n} string" for n in names))
    return frame, [r[:2] for r in rows]


def empty(spark):
    return spark.createDataFrame([], DOCS)


def words(rng, n, vocabulary=None):
    vocabulary = vocabulary or ["".join(rng.choices(string.ascii_lowercase, k=rng.randint(2, 7))) for _ in range(300)]
    return rng.choices(vocabulary, k=n)


def corpus(seed=0, n=60):
    """Texts of random words with copies, near copies, shared lines and passages."""
    rng = random.Random(seed)
    vocabulary = words(rng, 400)
    passage = " ".join(words(rng, 30, vocabulary))
    line = "This line stands in many of the documents."
    out = []
    for i in range(n):
        kind = i % 6
        body = words(rng, rng.randint(20, 120), vocabulary)
        if kind == 1 and out:
            out.append(out[rng.randrange(len(out))])
            continue
        if kind == 2 and out:
            body = out[rng.randrange(len(out))].split(" ")
            for _ in range(max(1, len(body) // 60)):
                body[rng.randrange(len(body))] = rng.choice(vocabulary)
        text = " ".join(body)
        if kind == 3:
            text += "\n " + line.upper() + "\t\n" + " ".join(words(rng, 5, vocabulary))
        if kind == 4:
            text = " ".join(body[:10]) + ". " + passage.title() + " " + " ".join(body[10:])
        out.append(text)
    return out, passage, line

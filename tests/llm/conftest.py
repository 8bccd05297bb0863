import random

import pytest

SF = "/root/testdata/sf0.001"

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, row string, key string,"
    " shard string, slot string, copies string, target string, doc string, toxicity string,"
    " fingerprint string, value string, bucket string, before string, words string, lexicon string"
)


def documents(spark, rows):
    """Documents from (doc_id, text, source), with further columns of clashing names."""
    extra = ("x",) * (SCHEMA.count(",") + 1 - 5)
    return spark.createDataFrame([(i, t, "en", s, 1, *extra) for i, t, s in rows], SCHEMA)


def edge_rows():
    """Nulls, empty and blank texts, repeated rows and ids, ties, a very long text."""
    rng = random.Random(1)
    words = ["alpha", "Beta", "gämma", "delta,", "the", "of", "and", "x"]
    long = "\n".join(" ".join(rng.choices(words, k=12)) for _ in range(3000))
    line = "This very line stands in a number of documents, more than five."
    rows = [
        (None, None, None),
        (None, "no id but text", "a"),
        (1, None, "a"),
        (2, "", "a"),
        (3, " \t\n\x0b\f\r ", None),
        (4, "same id", "b"),
        (4, "same id", "b"),
        (4, "same id, other text", None),
        (5, long, "b"),
        (6, long, "c"),
        (7, "one", "c"),
        (8, "\n\n", "c"),
    ]
    rows += [(20 + i, f"{line}\nmine {i}\n{line.upper()}", "a") for i in range(7)]
    return rows


@pytest.fixture(scope="session")
def edge_docs(spark):
    return documents(spark, edge_rows())


@pytest.fixture(scope="session")
def no_docs(spark):
    return documents(spark, [])


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def random_rows(seed, number, words=9, vocabulary=40):
    """Short random documents, a third of them with edits of earlier ones."""
    rng = random.Random(seed)
    known = ["".join(rng.choices("abcdeé", k=rng.randint(1, 6))) for _ in range(vocabulary)]
    rows = []
    for i in range(number):
        text = rng.choices(known, k=rng.randint(0, words))
        if rows and rng.random() < 0.35:
            text = (rng.choice(rows)[1] or "").split(" ")
            text[rng.randrange(len(text))] = rng.choice(known)
        rows.append((i * 3 + 1, " ".join(text), rng.choice(["a", "b", None])))
    return rows

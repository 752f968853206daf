from __future__ import annotations

import random

import pytest

#: Extra columns take names that operators use inside.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, n long, spans string, _row string, rep long, key string, size long, a long"


def doc_row(doc_id, text, lang="en", source="s1"):
    return (doc_id, text, lang, source, len(text or ""), 7, "x", "y", 1, "k", 2, 3)


def prose(rng: random.Random, n: int, words: int = 400) -> str:
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


@pytest.fixture(scope="session")
def messy_rows():
    """Nulls in every column, empty and very long texts, exact and near copies, repeated rows, shared passages."""
    rng = random.Random(5)
    rows = [
        doc_row(1, None),
        doc_row(2, ""),
        doc_row(3, " \t\n\r "),
        doc_row(4, "One two"),
        doc_row(5, "ONE Two"),
        doc_row(6, "one\x1ftwo three"),
        doc_row(None, prose(rng, 60)),
        doc_row(7, prose(rng, 80), None, None),
        doc_row(8, "a b c d e f g h " * 60),
        doc_row(9, prose(rng, 30_000, 20_000), "de", "s2"),
    ]
    base = prose(rng, 300, 5000).split()
    for k in range(40):  # near copies, some of which only meet through others
        copy = list(base)
        for j in rng.sample(range(300), k // 4):
            copy[j] = f"x{k}_{j}"
        rows.append(doc_row(100 + k, " ".join(copy), "en", f"s{k % 3}"))
    rows += [doc_row(200 + k, rows[12][1]) for k in range(30)]  # exact copies
    rows += [rows[20], rows[20]]  # repeated rows
    passage = prose(rng, 50, 5000)
    for k in range(60):  # a shared passage in different texts
        rows.append(doc_row(300 + k, f"{prose(rng, 60 + k)} {passage} {prose(rng, 40)}", "fr", "s1"))
    rows += [doc_row(400 + k, prose(rng, 100, 5000)) for k in range(40)]
    return rows


@pytest.fixture(scope="session")
def messy(spark, messy_rows):
    return spark.createDataFrame(messy_rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np

from barmart.llm import substring_dedup

from .conftest import SCHEMA, doc_row


def brute(rows, length=35):
    texts = [(r[1] or "").encode().split() for r in rows]
    seen = Counter(tuple(w[i : i + length]) for w in texts for i in range(len(w) - length + 1))
    out = []
    for row, words in zip(rows, texts):
        gone = np.zeros(len(words), bool)
        for i in range(len(words) - length + 1):
            if seen[tuple(words[i : i + length])] > 1:
                gone[i : i + length] = True
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out.append((str(row[0]), len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def result(df, length=35):
    return sorted((str(r[0]), *r[1:]) for r in substring_dedup.dedup_digests(df, length).collect())


def test_equals_brute_force(messy, messy_rows):
    assert result(messy) == brute(messy_rows)


def test_other_lengths_and_periodic_texts(spark):
    rng = random.Random(3)
    rows = [doc_row(k, " ".join(rng.choice("abc") for _ in range(rng.randrange(60)))) for k in range(60)]
    df = spark.createDataFrame(rows, SCHEMA)
    for length in (8, 12, 20):
        assert result(df, length) == brute(rows, length)


def test_factors():
    assert substring_dedup.factors(np.array([3, 4, 5, 20]), 10, 40) == [(3, 12), (20, 10)]
    assert substring_dedup.factors(np.array([], int), 10, 40) == []


def test_texts_are_cut_and_others_stay(messy, messy_rows):
    rows = substring_dedup.without_repeats(messy)
    assert rows.columns == messy.columns
    got = sorted((str(r.doc_id), r.text or "", r.n_chars, r.n) for r in rows.collect())
    want = {(i, n - gone) for i, n, gone, _ in brute(messy_rows)}
    assert {(i, len(t.encode().split())) for i, t, _, _ in got} == want
    assert ("6", "one\x1ftwo three") in {(i, t) for i, t, _, _ in got}


def test_empty_table(no_docs):
    assert substring_dedup.dedup_digests(no_docs).collect() == []
    assert substring_dedup.without_repeats(no_docs).collect() == []

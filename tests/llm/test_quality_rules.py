from __future__ import annotations

import random
from collections import Counter

import numpy as np

from barmart.llm import quality_rules

from .conftest import SCHEMA, doc_row, prose

SPACES = " \t\n\x0b\x0c\r"


def statistics(text):
    text = text or ""
    words = text.encode().split()
    seen = Counter(zip(words, words[1:], words[2:]))
    again = np.zeros(len(words), bool)
    for i in range(len(words) - 2):
        if seen[words[i], words[i + 1], words[i + 2]] > 1:
            again[i : i + 3] = True
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    n = len(words)
    return (
        n,
        sum(c not in SPACES for c in text),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        int(again.sum()),
        n < 50 or 100 * int(again.sum()) > 50 * n,
    )


def test_base_statistics(messy, messy_rows):
    got = sorted((str(r[0]), *r[1:7]) for r in quality_rules.quality(messy).collect())
    assert got == sorted((str(r[0]), *statistics(r[1])) for r in messy_rows)


def test_windows_and_lines_of_odd_texts(spark):
    rng = random.Random(2)
    texts = [" ".join(rng.choice("ab") for _ in range(rng.randrange(30))) for _ in range(80)]
    texts += ["a\n\na\n \na", "\u2003a\u2003 b", "x \r\nx \nx", "# * $|", "a\x1fb\x1fc"]
    rows = [doc_row(k, t) for k, t in enumerate(texts)]
    got = sorted((str(r[0]), *r[1:7]) for r in quality_rules.quality(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == sorted((str(r[0]), *statistics(r[1])) for r in rows)


def distances(z, mean, cov):
    return ((z - mean) @ np.linalg.inv(cov) * (z - mean)).sum(1)


def moments(core):
    floors = np.array(quality_rules.FLOORS) * quality_rules.UNIT
    mean = core.mean(0)
    return mean, core.T @ core / len(core) - np.outer(mean, mean) + np.diag(floors**2)


def settled(z, mean, cov):
    for _ in range(quality_rules.STEPS):
        b = np.floor(np.log1p(distances(z, mean, cov)) * 64)
        mean, cov = moments(z[b <= np.percentile(b, 75)])
    return mean, cov


def brute_estimate(z):
    """The same concentration steps from the same starts with numpy; the least determinant wins."""
    floors = np.array(quality_rules.FLOORS) * quality_rules.UNIT
    low, centre, high = np.percentile(z, [25, 50, 75], axis=0)
    spread = np.diag(np.maximum((high - low) / 1.349, floors) ** 2)
    return min((settled(z, m, spread) for m in (low, centre, high)), key=lambda e: np.linalg.det(e[1]))


def brute_far(z):
    mean, cov = brute_estimate(z)
    d = distances(z, mean, cov)
    half = np.percentile(np.floor(np.log1p(d) * 64), 50)
    return d > quality_rules.CUTOFF * max(1.0, np.expm1(half / 64) / quality_rules.MIDDLE)


def test_determinant_is_about_the_least_of_free_starts(spark):
    """Two clusters: 60 % lie close together, 40 % far off and wide, so the median start alone may mix them."""
    rng = np.random.default_rng(5)
    z = np.vstack([rng.normal(0, 60, (240, 4)), rng.normal(900, 500, (160, 4))]).round()
    df = spark.createDataFrame([("k", *map(int, r)) for r in z], "key string, z0 long, z1 long, z2 long, z3 long")
    got = quality_rules.fit(df).first()
    root = got.l00 * got.l11 * got.l22 * got.l33
    ends = [settled(z, *moments(z[rng.choice(len(z), 8, replace=False)])) for _ in range(50)]
    least = min(np.linalg.det(cov) for _, cov in ends) ** 0.5
    assert root <= least * 1.02
    own = brute_estimate(z)
    assert np.isclose(root, np.linalg.det(own[1]) ** 0.5) and np.allclose([got.m0, got.m3], own[0][[0, 3]])


def test_outliers_equal_numpy(spark):
    rng = random.Random(9)
    rows = []
    for k in range(260):
        words = prose(rng, 60 + rng.randrange(300), 3000).split()
        if k % 20 == 0:
            words = [w + "***" for w in words]
        if k % 33 == 0:
            words = [w * 6 for w in words]
        if rng.random() < 0.3:
            words[rng.randrange(len(words))] += " # line\nline"
        rows.append(doc_row(k, " ".join(words), "en", "big" if k < 200 else f"small{k % 4}"))
    rows += [doc_row(900 + k, prose(rng, 70), None, None) for k in range(5)]
    got = {r.doc_id: r.kept for r in quality_rules.quality(spark.createDataFrame(rows, SCHEMA)).collect()}
    for own in ([r for r in rows[:260] if r[3] == "big"], [r for r in rows[:260] if r[3] != "big"]):
        z = []
        for r in own:
            n, chars, symbols, dup, again, failed = statistics(r[1])
            assert not failed
            lines = len([x for x in r[1].split("\n") if x.strip(SPACES)])
            z.append([np.log(chars / n), np.log1p(100 * symbols / chars), dup / max(lines, 1), again / n])
        far = brute_far(np.floor(np.array(z) * quality_rules.UNIT + 0.5))
        assert [not got[r[0]] for r in own] == far.tolist()
        assert 0 < far.sum() < 0.2 * len(own)
    # Five texts of no language: too few for an estimate of their own or of a language, so they are a pool of their own.
    assert all(got[900 + k] for k in range(5))


def test_small_languages_are_judged(spark):
    rng = random.Random(12)
    rows = [doc_row(k, prose(rng, 80 + k % 50), f"l{k % 6}") for k in range(120)]
    rows.append(doc_row(500, "#$% " * 3 + " ".join("*|<>" + str(k) for k in range(70)), "l3"))
    got = {r.doc_id: r.kept for r in quality_rules.quality(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert not got[500] and all(got[k] for k in range(120))


def test_clashing_names_of_the_stage(spark):
    rows = [(1, "a b", "en", "s", 5, 6, 7), (2, prose(random.Random(1), 60), "en", "s", 8, 9, 10)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, _id int, _code int, key int")
    kept = quality_rules.without_rejected(df)
    assert kept.columns == df.columns and [tuple(r) for r in kept.collect()] == [rows[1]]


def test_rejected_rows_go_and_others_stay_as_they_are(messy, messy_rows):
    kept = quality_rules.without_rejected(messy)
    assert kept.columns == messy.columns
    judged = quality_rules.quality(messy).filter("kept")
    assert Counter(str(r.doc_id) for r in kept.collect()) == Counter(str(r.doc_id) for r in judged.collect())


def test_empty_table(no_docs):
    assert quality_rules.quality(no_docs).collect() == [] and quality_rules.without_rejected(no_docs).collect() == []

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from barmart.llm import spelling_variants as sv

WORDS = "word string, n long"


def brute_words(rows):
    counts = Counter()
    for doc_id, text in rows:
        low = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for run in re.findall("[A-Za-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_groups(words):
    out, forms = {}, {}
    for w, n in words.items():
        others = [o for o in words if near(w, o)]
        best = min(others, key=lambda o: (-words[o], o.encode()), default=None)
        forms[w] = best if best is not None and words[best] >= 2 * n else None
        out[w] = [n, len(others), forms[w], words.get(forms[w])]
    for w in words:
        root = w
        while forms[root] is not None:
            root = forms[root]
        out[w].append(root)
    return {w: tuple(v) for w, v in out.items()}


def got(df):
    return {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in df.collect()}


def test_words_of_messy_texts(spark, messy, messy_rows):
    found = {r["word"]: r["n"] for r in sv.corpus_words(messy).collect()}
    assert found == brute_words([r[:2] for r in messy_rows])


def test_whole_query_against_brute_force(spark):
    rng = random.Random(3)
    stems = ["".join(rng.choice("abcdeéÀz") for _ in range(rng.randrange(4, 9))) for _ in range(25)]
    rows = []
    for k in range(220):
        picked = []
        for _ in range(40):
            w = list(rng.choice(stems[: rng.randrange(1, 26)]))
            if rng.random() < 0.4:
                i = rng.randrange(len(w))
                w[i : i + 1] = rng.choice(["", rng.choice("abé"), w[i] + rng.choice("abcdx")])
            picked.append("".join(w).upper() if rng.random() < 0.2 else "".join(w))
        rows.append((k - 5, rng.choice([" ", "-", "1", "—"]).join(picked)))
    rows += [(None, "abcde abcde abcdf"), (7, None), (8, ""), rows[0], rows[0], (9, "×÷abcde " * 3)]
    words = brute_words(rows)
    found = got(sv.spelling_variants(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)))
    assert found == brute_groups(words) and len(found) > 200
    assert any(v[4] not in (w, v[2]) for w, v in found.items()), "no chain of forms"


@pytest.mark.parametrize("size", [5, 63, 64, 65, 66, 67, 150])
def test_every_edit_at_every_length(spark, size):
    """Runs of equal letters, edits at both ends, and lengths at which keys change from text to digests."""
    base = ("aab" * size)[:size]
    words = {base: 100, base + "a": 40, "b" + base: 50, base[:-1]: 30, base[1:]: 50, base[:2] + base[3:]: 7, base[:-1] + "é": 9, "é" + base[1:]: 200, base[:3] + "a" + base[3:]: 12, base[:-1] + "z": 200, base[:-2] + "zz": 3}
    found = got(sv.spelling_groups(spark.createDataFrame(list(words.items()), WORDS)))
    assert found == brute_groups(words)


def test_a_range_holds_no_more_than_the_alphabet(spark):
    words = [(f"long{chr(c)}word", 5 + c % 3) for c in [*range(97, 123), *range(0xC0, 0x100)]] + [("longword", 3)]
    entries = sv.rotations(spark.createDataFrame(words, WORDS).selectExpr("word", "word AS id", "n"))
    most = entries.groupBy("key").count().agg({"count": "max"}).first()[0]
    assert most == 91
    assert got(sv.spelling_groups(spark.createDataFrame(words, WORDS))) == brute_groups(dict(words))


def test_a_word_of_a_million_letters(spark):
    long = "".join(random.Random(1).choice("acgt") for _ in range(300_000))
    rows = [(k, f"{long} {long}t {long}") for k in (1, 2, 3)] + [(4, long[:100_000] + "e" + long[100_001:])] * 3
    found = got(sv.spelling_variants(spark.createDataFrame(rows, "doc_id long, text string")))
    assert found == brute_groups(brute_words(rows))


def test_text_is_read_in_pieces_that_cut_no_run():
    text = ("abcé " * 50 + "x" * 90 + "1" + "—yz" * 40).encode()
    pieces = list(sv.run_pieces(text, 16))
    assert b"".join(pieces) == text and len(pieces) > 5
    assert [m for p in pieces for m in sv.RUN.findall(p)] == sv.RUN.findall(text)


def test_empty_tables(spark, no_docs):
    assert sv.spelling_variants(no_docs).collect() == []
    assert sv.spelling_variants(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")).collect() == []

from __future__ import annotations

import random

import numpy as np

from barmart.llm import jaccard_join
from barmart.llm.components import components

from .conftest import SCHEMA, doc_row


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    """Rows sharing an id count as one document."""
    sets = [(r[0], shingles(r[1])) for r in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, s) in enumerate(sets):
        for j, t in sets[:k]:
            if i is not None and j is not None and s and t and 100 * len(s & t) >= 75 * len(s | t):
                low, high = sorted((find(i), find(j)))
                parent[high] = low
    return sorted((str(i), len(s), find(i) if i is not None and s else i) for i, s in sets)


def result(df):
    return sorted((str(r[0]), r[1], r[2]) for r in jaccard_join.jaccard_classes(df).collect())


def test_equals_brute_force(messy, messy_rows):
    assert [tuple(map(str, x)) for x in result(messy)] == [tuple(map(str, x)) for x in brute(messy_rows)]


def test_hot_regions_give_the_same(messy, messy_rows, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 6)
    assert [tuple(map(str, x)) for x in result(messy)] == [tuple(map(str, x)) for x in brute(messy_rows)]


def test_threshold_is_met_exactly(spark):
    words = [f"w{i}" for i in range(11)]
    texts = [" ".join(words[:10]), " ".join(words[:11]), " ".join(words[:8]), " ".join(words[:9])]
    rows = [doc_row(i, t) for i, t in enumerate(texts)]
    assert result(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_a_region_is_connected_like_all_pairs():
    rng = random.Random(1)
    base = [rng.sample(range(1000), 40) for _ in range(4)]
    sets = [np.array(sorted([*base[k % 4][rng.randrange(9) :], *range(5000 + 50 * k, 5000 + 50 * k + rng.randrange(6))]), np.uint64) for k in range(80)]
    ids = list(range(80))
    group = {i: i for i in ids}

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for a, b in jaccard_join.region_links(ids, sets, 0, 0.75):
        both = len(set(sets[a].tolist()) & set(sets[b].tolist()))
        assert 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both)
        group[find(a)] = find(b)
    for i in ids:
        for j in ids:
            both = len(set(sets[i].tolist()) & set(sets[j].tolist()))
            if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                assert find(i) == find(j)


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r.vertex: r.root for r in components(edges).collect()}
    assert got == {**{i: 1 for i in range(2, 41)}, 101: 100}


def test_one_of_each_keeps_columns_and_null_ids(messy, messy_rows):
    kept = jaccard_join.one_of_each(messy)
    assert kept.columns == messy.columns
    want = {i for i, _, c in brute(messy_rows) if i == str(c)}
    got = [str(r.doc_id) for r in kept.collect()]
    assert set(got) == want and len(got) == len(want)


def all_links(rows):
    """Links of distinct sets by smallest doc_id, and the other documents that each text links with."""
    documents = {(r[0], frozenset(shingles(r[1]))) for r in rows if r[0] is not None and shingles(r[1])}
    low = {}
    for i, s in documents:
        low[s] = min(i, low.get(s, i))
    linked = {(s, t) for s in low for t in low if 100 * len(s & t) >= 75 * len(s | t)}
    pairs = sorted(tuple(sorted((low[s], low[t]))) for s, t in linked if s != t)[::2]
    copies = {s: sum(t == s for _, t in documents) for s in low}
    total = {s: sum(copies[t] for u, t in linked if u == s) - 1 for s in low}
    counts = [(str(r[0]), len(shingles(r[1])), total.get(frozenset(shingles(r[1])), 0) if r[0] is not None else 0) for r in rows]
    return pairs, sorted(counts)


def same_links(df, rows):
    pairs, counts = all_links(rows)
    assert sorted((r.a, r.b) for r in jaccard_join.jaccard_pairs(df).collect()) == pairs
    assert sorted((str(r[0]), r[1], r[2]) for r in jaccard_join.jaccard_counts(df).collect()) == counts


def test_all_links_and_counts(messy, messy_rows):
    pairs, _ = all_links(messy_rows)
    assert len(pairs) > 200
    same_links(messy, messy_rows)


def test_all_links_of_hot_regions(messy, messy_rows, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 6)
    monkeypatch.setattr(jaccard_join, "WIDTH", 50)
    monkeypatch.setattr(jaccard_join, "PIECE", 1000)
    same_links(messy, messy_rows)


def test_texts_of_one_doc_id(spark):
    rng = random.Random(3)
    words = [f"w{rng.randrange(5000)}" for _ in range(200)]
    texts = [" ".join(words), " ".join(words[:-3]), " ".join(words[5:]), "alone " * 3 + "in all of this table", " ".join(words[40:80])]
    rows = [doc_row(i, texts[k]) for i, k in [(1, 0), (2, 1), (2, 3), (2, 3), (3, 3), (4, 2), (4, 4), (4, 0), (5, 4), (6, 4)]]
    df = spark.createDataFrame(rows, SCHEMA)
    same_links(df, rows)
    assert result(df) == brute(rows)


def test_one_of_each_judges_each_text_of_a_doc_id(spark):
    rng = random.Random(4)
    a, b, c = (" ".join(f"w{rng.randrange(5000)}" for _ in range(80)) for _ in range(3))
    rows = [doc_row(i, t) for i, t in [(1, a), (5, a + " x"), (5, b), (5, b), (5, " " + b), (5, ""), (5, None), (6, b), (7, c), (7, c + " y"), (None, a)]]
    kept = jaccard_join.one_of_each(spark.createDataFrame(rows, SCHEMA)).collect()
    got = sorted((str(r.doc_id), r.text or "") for r in kept)
    assert got[:5] == sorted([("1", a), ("5", " " + b), ("5", ""), ("5", ""), *[g for g in got if g[0] == "7"]]) and len(got) == 6
    assert got[5] == ("None", a) and got[4][1] in (c, c + " y")


def test_empty_table(no_docs):
    assert jaccard_join.jaccard_pairs(no_docs).collect() == []
    assert jaccard_join.jaccard_counts(no_docs).collect() == []
    assert jaccard_join.jaccard_classes(no_docs).collect() == []


def test_regions_of_long_texts_are_cut_by_their_shingles(spark, monkeypatch):
    """Texts of many shingles that share a region: few sets, but more shingles than one task should hold."""
    import random

    from barmart.llm import jaccard_join, shared

    monkeypatch.setattr(jaccard_join, "BLOCK_SHINGLES", 3000)
    rng = random.Random(8)
    passage = " ".join(f"p{rng.randrange(10**6)}" for _ in range(900))
    texts = [f"{passage} " + " ".join(f"o{k}_{j}" for j in range(100 + k)) for k in range(12)]
    texts += [" ".join(f"u{k}_{j}" for j in range(900)) for k in range(4)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in jaccard_join.jaccard_classes(docs).collect()}
    assert found == {k: 0 if k < 12 else k for k in range(16)}
    pieces = list(shared.slices(docs.selectExpr("doc_id", "CAST(text AS BINARY)").toArrow().to_batches(), 5, 1, 9000))
    assert sum(p.num_rows for p in pieces) == 16 and all(p.num_rows == 1 or sum(len(x.as_py()) for x in p.column(1)) <= 9000 for p in pieces)

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from barmart.llm import prefix_trie as pt

SCHEMA = "conv_id long, turn long, role string, text string, pos long, x long, n long, kind string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, "k") for r in rows], SCHEMA)


def brute(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            code = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            turns[conv].append((turn is not None, turn or 0, code, role, text))
    turns = {c: [x[3:] for x in sorted(v)] for c, v in turns.items()}
    members = defaultdict(list)
    full = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        full[c] = tuple(turns.get(base, [])[:h]) + tuple(own[h:])
        for d in range(len(full[c]) + 1):
            members[full[c][:d]].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        below = children[path]
        words = len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        leaves[path] = sum(leaves[k] for k in below) if below else 1
        saved[path] = (len(members[path]) - 1) * words + sum(saved[k] for k in below)
    out = []
    for path, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if full[c] == path)
        parent = min(members[path[:-1]]) if path else None
        out.append((min(convs), len(path), parent, len(convs), len(children[path]), leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def messy(seed=2, convs=260):
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        n = rng.randrange(1, 7)
        shared = rng.random() < 0.6
        for t in range(n):
            text = f"common start {t}" if shared and t < rng.randrange(1, 5) else f"own {c} {t} " + "w " * rng.randrange(9)
            rows.append((c - 30, t, rng.choice(["user", "assistant"]) if not shared else "user", text))
    rows += [(500 + k, t, "user", f"copy {t}") for k in range(60) for t in range(5)]
    rows += [(700, None, None, None), (700, None, "system", ""), (700, 1, "user", None), (701, 3, None, " \t\n"), (None, 1, "user", "lost"), rows[0], rows[0], (9000, 0, "user", "short")]
    return rows


@pytest.mark.parametrize("most_cells", [pt.MOST_CELLS, 1])
def test_against_brute_force(spark, monkeypatch, most_cells):
    """With a whole sketch, and with one so small that it proves little."""
    monkeypatch.setattr(pt, "LEAST_CELLS", 64 if most_cells == 1 else pt.LEAST_CELLS)
    rows = messy()
    assert got(pt.prefix_trie(frame(spark, rows).repartition(4), most_cells)) == brute(rows)


def test_long_conversations_are_cut(spark, monkeypatch):
    monkeypatch.setattr(pt, "CHUNK", 16)
    monkeypatch.setattr(pt, "PIECE", 20)
    rng = random.Random(4)
    rows = [(c, t, "user", f"line {t}") for c in (20, 21, 22, 23, 44) for t in range(150 + c)]
    rows += [(60 + c, t, "user", f"line {t}" if t < rng.randrange(200) else f"{c} {t}") for c in range(6) for t in range(120)]
    rows += [(99, 1, "user", "the same")] * 90
    rows += [(1000 + c, 1, "user", "same end") for c in range(80)]
    assert got(pt.prefix_trie(frame(spark, rows).repartition(7))) == brute(rows)


def test_the_sketch_never_counts_too_low_and_keeps_singletons_local(spark):
    rows = pt.prefixes(pt.rebuilt_turns(pt.placed_turns(frame(spark, messy())))).filter("pos > 0").cache()
    lines = pt.prefix_sketch(rows)
    found = rows.groupBy("x", "y").count().collect()
    x, y = (np.array([r[c] for r in found], np.int64) for c in ("x", "y"))
    n = np.array([r["count"] for r in found])
    assert (pt.estimates(lines, x, y) >= np.minimum(n, 255)).all()
    kinds = {r["kind"]: r["count"] for r in pt.screened(rows, lines).groupBy("kind").count().collect()}
    shared = sum(k for k in n if k > 1)
    assert shared <= kinds[pt.SHARED] <= shared * 1.1 and kinds[pt.FIRST_OF_TAIL] > 100 and kinds[pt.TAIL] > 100


def test_a_node_with_very_many_ends(spark):
    ends = spark.range(-70_000, 70_000).selectExpr("1L AS pos", "7L AS x", "-7L AS y", "id AS conv_id")
    (row,) = pt.end_digests(ends).collect()
    assert row["ends_sha256"] == hashlib.sha256(",".join(map(str, range(-70_000, 70_000))).encode()).hexdigest()


def test_empty_tables(spark):
    assert got(pt.prefix_trie(frame(spark, []))) == []
    assert got(pt.prefix_trie(frame(spark, [(None, 1, "user", "x")]))) == []
    rows = [(c, 0, "user", "only") for c in range(21, 40)]  # conversations that lose all they have
    assert got(pt.prefix_trie(frame(spark, rows))) == brute(rows)

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from barmart.llm import curriculum_mix

from .conftest import SCHEMA, doc_row, prose


def targets(sizes: dict):
    """Shares by weight, limited to three times the size, found by taking the limited ones out until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    got, left, free = {}, Fraction(sum(sizes.values())), set(names)
    while free:
        share = left / sum(weight[s] for s in free)
        over = [s for s in free if weight[s] * share > 3 * sizes[s]]
        if not over:
            return got | {s: weight[s] * share for s in free}
        for s in over:
            got[s] = Fraction(3 * sizes[s])
            left -= got[s]
            free.remove(s)
    return got


def brute(rows):
    sized = [(r[0], r[3], len((r[1] or "").encode().split())) for r in rows]
    total = Counter()
    for _, s, n in sized:
        total[s] += n
    goal, before, out = targets(total), defaultdict(int), []
    for i, s, n in sorted(sized, key=lambda x: (hashlib.md5(str("" if x[0] is None else x[0]).encode()).hexdigest(), x[0] is not None, x[0] or 0, x[2])):
        want = int(goal[s] + Fraction(1, 2))
        copies = want // total[s] if total[s] else 0
        rest = max(0, min(want - copies * total[s] - before[s], n))
        taken = copies * n + rest
        out.append((str(i), n, total[s], pytest.approx(float(goal[s])), taken, at(goal, s, before[s] + n / 2) if taken else None))
        before[s] += n
    return out


def at(goal, source, words):
    """When the integral of the source's schedule reaches its share of the target, by halving."""
    names = sorted((s for s in goal if s is not None), key=lambda s: s.encode()) + [None] * (None in goal)
    slope = (-0.5, 0.0, 0.5)[names.index(source) % 3]
    low, high = 0.0, 1.0
    for _ in range(60):
        t = (low + high) / 2
        low, high = (t, high) if (1 - slope) * t + slope * t * t < words / goal[source] else (low, t)
    return pytest.approx(low, abs=1e-9)


def result(df):
    return [(str(r[0]), *r[1:]) for r in curriculum_mix.mix_digests(df).collect()]


def by_row(rows):
    return sorted(rows, key=lambda r: (r[0], r[1], r[2], r[4]))


def test_equals_brute_force(messy, messy_rows):
    assert by_row(result(messy)) == by_row(brute(messy_rows))


def test_buckets_give_the_same(messy, messy_rows, monkeypatch):
    monkeypatch.setattr(curriculum_mix, "BUCKET", 1)
    assert by_row(result(messy)) == by_row(brute(messy_rows))


def test_rows_alike_are_written_out_in_pieces(messy, messy_rows, monkeypatch):
    monkeypatch.setattr(curriculum_mix, "PIECE", 3)
    assert by_row(result(messy)) == by_row(brute(messy_rows))


def test_digests_come_by_position(messy):
    got = [r.position for r in curriculum_mix.mix_digests(messy).collect()]
    timed = [p for p in got if p is not None]
    assert got == sorted(timed) + [None] * (len(got) - len(timed)) and 0 < len(timed) < len(got)


def test_one_id_for_many_rows(spark):
    """Rows that share a null or repeated id, some alike in every column, each have their own place."""
    rng = random.Random(8)
    rows = [doc_row(None if k % 2 else 5, prose(rng, 1 + k % 7), "en", f"s{k % 2}") for k in range(300)]
    rows += rows[:90] + [doc_row(k, prose(rng, 20), "en", "s2") for k in range(50)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert by_row(result(df)) == by_row(brute(rows))
    got = curriculum_mix.training_order(df).collect()
    total, taken = Counter(), Counter()
    for r in rows:
        total[r[3]] += len(r[1].split())
    for r in got:
        taken[r.source] += len(r.text.split())
    have = Counter(tuple(r) for r in rows)
    for row, n in Counter(tuple(r) for r in got).items():
        whole = int(targets(total)[row[3]] + Fraction(1, 2)) // total[row[3]]
        assert whole * have[row] <= n <= (whole + 1) * have[row]
    for source, goal in targets(total).items():
        assert abs(taken[source] - goal) <= 20


def test_shares_stop_at_three_times_the_size(spark):
    rng = random.Random(4)
    rows = [doc_row(k, prose(rng, 10 + 7 * k), "en", f"s{k % 9}") for k in range(40)]
    rows += [doc_row(100, prose(rng, 2), "en", "s00"), doc_row(101, prose(rng, 1), "en", None), doc_row(102, "", "en", "void")]
    got = by_row(result(spark.createDataFrame(rows, SCHEMA)))
    assert got == by_row(brute(rows)) and all(r[4] <= 3 * r[1] for r in got)
    assert sum({(r[2], r[3]): r[3] for r in got}.values()) == pytest.approx(sum(r[1] for r in got), rel=0.02)


def test_positions_invert_the_demand(spark):
    for slope in (-0.5, 0.0, 0.5, 1.0):
        t = curriculum_mix.position(F.col("y"), F.lit(slope))
        for y, x in spark.createDataFrame([(k / 10,) for k in range(11)], "y double").select("y", t).collect():
            assert (1 - slope) * x + slope * x * x == pytest.approx(y)


def test_training_order_repeats_whole_documents(messy, messy_rows):
    rows = curriculum_mix.training_order(messy, with_position=True)
    assert rows.columns == [*messy.columns, "position"]
    got = rows.collect()
    at = [r.position for r in got]
    assert at == sorted(at) and 0 <= at[0] and at[-1] <= 1
    assert {r.text for r in got} <= {r[1] for r in messy_rows}
    taken, largest = Counter(), Counter()
    for r in got:
        taken[r.source] += len(r.text.encode().split())
    for r in messy_rows:
        largest[r[3]] = max(largest[r[3]], len((r[1] or "").encode().split()))
    total = Counter()
    for r in messy_rows:
        total[r[3]] += len((r[1] or "").encode().split())
    for source, goal in targets(total).items():
        assert abs(taken[source] - goal) <= largest[source]
    assert curriculum_mix.training_order(messy).columns == messy.columns


def test_empty_table(no_docs):
    assert result(no_docs) == [] and curriculum_mix.training_order(no_docs).collect() == []

from __future__ import annotations

import random
import sys

import numpy as np
import pytest

from barmart.llm import words


def plain(text):
    found = (text or b"").lower().split()
    return frozenset(tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4))) if found else frozenset()


@pytest.mark.parametrize("piece", [words.PIECE_BYTES, 40])
def test_sets_of_shingles_equal_plain_ones(monkeypatch, piece):
    """Whatever pieces texts are coded in: null and empty texts, NUL, letters beyond A-Z, words longer than a piece."""
    monkeypatch.setattr(words, "PIECE_BYTES", piece)
    rng = random.Random(1)
    bits = [b"a", b"B", b"b", b"\0", b" ", b"\n", b"\xc3\x84", b"\xc3\xa4", b"Z", b"\x1c", b"\x85", b"\t"]
    texts = [None, b"", b" ", b"one", b"x" * 100 + b" Y " + b"X" * 100, b"X" * 100 + b"  y\n" + b"x" * 100, b"x" * 99 + b"z y " + b"x" * 100]
    texts += [b"".join(rng.choices(bits, k=rng.choice([0, 3, 10, 30, 200, 900]))) for _ in range(400)]
    sets = words.shingle_sets(texts)
    wanted = [plain(t) for t in texts]
    assert [len(s) for s in sets] == [len(w) for w in wanted] and all((s[1:] > s[:-1]).all() for s in sets)
    assert len(set().union(*wanted)) == len(np.unique(np.concatenate(sets)))
    by_set = {}
    for w, s in zip(wanted, sets):
        assert by_set.setdefault(w, s.tobytes()) == s.tobytes()


def test_words_are_not_coded_one_by_one():
    calls = 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event in ("call", "c_call")

    texts = [" ".join(f"w{i * k}" for i in range(500)).encode() for k in range(1, 41)]
    sys.setprofile(count)
    try:
        words.shingle_sets(texts)
    finally:
        sys.setprofile(None)
    assert calls < 2000

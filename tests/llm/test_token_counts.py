from __future__ import annotations

import random

import public_tokenizers
import pytest
import sentencepiece

from barmart.llm import token_counts

MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "  ", "a", " a", "a ", " a  b ", "a\n\nb \n c", "<s> </s> <unk>", "▁a ▁ b▁▁", "漢字かな 한국어 😀😀 é\u0301", "\x00 \x01", "\xa0a\u3000b\u2009 c", "x" * 500, "<0x41> <0xE4>"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def counter():
    return token_counts.Counter(MODEL)


def random_texts(n, size, marks=1):
    rng = random.Random(6)
    pool = list("abet  .,\n") + ["the ", "漢", "é", "😀", "   "] + ["▁"] * marks
    return ["".join(rng.choice(pool) for _ in range(rng.randrange(1, size))) for _ in range(n)]


def test_short_texts_equal_the_library(counter, library):
    for text in ODD + random_texts(300, 200):
        assert counter.count(text) == len(library.encode(text)), repr(text)
    assert counter.count(None) == 0


def test_chunks_equal_the_library(counter, library):
    for text in random_texts(60, 2000, 0) + [" " * 900 + "a", "b" * 900, "ab " * 300 + "c" * 700 + " d" * 100]:
        for chunk, overlap in ((50, 4), (128, 16), (300, 64)):
            assert counter.huge(text, chunk, overlap) == len(library.encode(text)), (chunk, repr(text[:80]))


def test_every_text_longer_than_a_chunk_is_cut(counter, library, monkeypatch):
    cut = []
    monkeypatch.setattr(counter, "huge", lambda text: cut.append(len(text)) or 0)
    for n in (token_counts.CHUNK - 1, token_counts.CHUNK, token_counts.CHUNK + 1, 100_000):
        counter.count("ab " * (n // 3) + "c" * (n % 3))
    assert cut == [token_counts.CHUNK + 1, 100_000]


def test_offsets_follow_the_tokens(counter):
    text = "one 漢字 two 😀 x\ty"
    offsets = counter.boundaries(text)
    assert offsets == sorted(offsets) and offsets[0] == 0 and offsets[-1] < len(text)
    assert {3, 6, 10, 12} <= set(offsets)


def test_table(messy, messy_rows, library):
    rows = token_counts.token_counts(messy, MODEL, limit=100).collect()
    want = []
    for row in messy_rows:
        n = len(library.encode(row[1] or ""))
        want.append((str(row[0]), len((row[1] or "").encode()), n, n > 100))
    assert sorted((str(r[0]), *r[1:]) for r in rows) == sorted(want)
    assert any(len(r[1] or "") > 2 * token_counts.CHUNK for r in messy_rows)


def test_empty_table(no_docs):
    assert token_counts.token_counts(no_docs, MODEL).collect() == []

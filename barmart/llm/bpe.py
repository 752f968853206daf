"""Byte-level BPE on contiguous rank arrays: encoding and decoding of whole texts.

A word is held as two plain lists: its parts (token ids; the boundaries lie between them) and the merge rank of each two
adjacent parts. The smallest rank is looked for by a scan, the boundary under it is deleted, and the two ranks beside it
are refreshed, until no rank is left. Words are short, so scanning a contiguous list beats a heap; runs without a
boundary that are longer than LONG bytes use a heap over the same ranks, which gives the same merges.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The pattern that cuts a text into words, and the white space it knows (Unicode's White_Space).
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
NONE = 1 << 60
LONG = 256
#: Entries of the memos of units and words, and the longest text that they keep; together some 300 MB in a worker.
MEMO = 600_000
MEMO_CHARS = 48
ENDS = frozenset(".,;:!?")


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in the vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Bpe(dict):
    """The ids of a unit: white space and what follows it up to the next white space. No word crosses the end of a unit,
    since a word holds white space at its beginning only; so units can be encoded by themselves and kept in a memo."""

    def __init__(self, path: str):
        super().__init__()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters, vocab = _byte_letters(), spec["model"]["vocab"]
        self.bytes_of = {i: bytes(letters[c] for c in token) for token, i in vocab.items()}
        self.byte_ids = [0] * 256
        for i, token in self.bytes_of.items():
            if len(token) == 1:
                self.byte_ids[token[0]] = i
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.rank = {(vocab[a], vocab[b]): r for r, (a, b) in enumerate(merges)}
        self.made = [vocab[a + b] for a, b in merges]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of |= {i: t.encode() for t, i in self.added.items()}
        self.words = regex.compile(WORDS)
        self.known: dict[str, tuple[int, ...]] = {}
        self.units = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
        longest = sorted(self.added, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if longest else None

    def merged(self, word: bytes) -> list[int]:
        parts = [self.byte_ids[b] for b in word]
        if len(parts) > LONG:
            return self.merged_long(parts)
        rank, made = self.rank, self.made
        ranks = [rank.get(pair, NONE) for pair in zip(parts, parts[1:])]
        while ranks:
            least = min(ranks)
            if least == NONE:
                break
            i = ranks.index(least)
            parts[i] = made[least]
            del parts[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rank.get((parts[i - 1], parts[i]), NONE)
            if i < len(ranks):
                ranks[i] = rank.get((parts[i], parts[i + 1]), NONE)
        return parts

    def merged_long(self, parts: list[int]) -> list[int]:
        n, rank = len(parts), self.rank
        after, before, live = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := rank.get((parts[i], parts[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i] if live[i] else n
            if j >= n or parts[i] != a or parts[j] != b:
                continue
            parts[i], live[j], after[i] = self.made[r], False, after[j]
            if after[i] < n:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and (again := rank.get((parts[x], parts[y]))) is not None:
                    heapq.heappush(heap, (again, x, parts[x], parts[y]))
        return [p for p, alive in zip(parts, live) if alive]

    def cut(self, unit: str) -> list[str] | tuple[str, ...]:
        """The words of a unit; plain letters with a space before and a mark behind them need no pattern."""
        body = unit[1:] if unit[0] == " " else unit
        if body.isalpha():
            return (unit,)
        if body[-1:] in ENDS and body[:-1].isalpha():
            return unit[:-1], unit[-1]
        return self.words.findall(unit)

    def word(self, word: str) -> tuple[int, ...]:
        ids = self.known.get(word)
        if ids is None:
            ids = tuple(self.merged(word.encode()))
            if len(word) <= MEMO_CHARS:
                if len(self.known) >= MEMO:
                    self.known.clear()
                self.known[word] = ids
        return ids

    def __missing__(self, unit: str) -> tuple[int, ...]:
        ids = tuple(chain.from_iterable(map(self.word, self.cut(unit))))
        if len(unit) <= MEMO_CHARS:
            if len(self) >= MEMO:
                self.clear()
            self[unit] = ids
        return ids

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a whole text; added tokens that stand in it become their own id."""
        if not text:
            return np.empty(0, "<u4")
        if self.special is None or not self.special.search(text):
            return np.fromiter(chain.from_iterable(map(self.__getitem__, self.units.findall(text))), "<u4")
        ids: list[int] = []
        for part in self.special.split(text):
            ids += [self.added[part]] if part in self.added else self.encode(part).tolist() if part else []
        return np.array(ids, "<u4")

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids, added tokens included; bytes that are no UTF-8 become the replacement character."""
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist())).decode("utf-8", "replace")


def _per_batch(docs: DataFrame, path: str, schema: str, rows) -> DataFrame:
    names = docs.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = None
        for batch in batches:
            bpe = bpe or Bpe(path)
            columns = rows(bpe, batch.column(names.index("text")).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i, n in enumerate(names) if n != "text"), *columns.values()],
                [*(n for n in names if n != "text"), *columns],
            )

    return docs.mapInArrow(work, schema)


def bpe_digests(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) for every row of `docs` (doc_id, text; others are ignored).

    Null and empty texts have no ids and decode to the empty text. Repeated rows are returned as often as they occur; an
    empty table gives an empty table. `path` is a vocabulary file that every executor has.
    """

    def digest(bpe: Bpe, texts: list[str | None]) -> dict[str, pa.Array]:
        n, ids_sha, text_sha = [], [], []
        for text in texts:
            ids = bpe.encode(text)
            n.append(len(ids))
            ids_sha.append(hashlib.sha256(ids.tobytes()).hexdigest())
            text_sha.append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
        return {"n_tokens": pa.array(n, pa.int64()), "ids_sha256": pa.array(ids_sha, pa.string()), "decoded_sha256": pa.array(text_sha, pa.string())}

    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _per_batch(docs.select("doc_id", "text"), path, schema, digest)


def encoded(docs: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep` and `token_ids` (array of int) for every row of `docs`; null and empty texts give an empty array."""

    def encode(bpe: Bpe, texts: list[str | None]) -> dict[str, pa.Array]:
        arrays = [bpe.encode(t) for t in texts]
        ends = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
        flat = np.concatenate([np.empty(0, "<u4"), *arrays]).astype(np.int32)
        return {"token_ids": pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))}

    kinds = dict(docs.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "token_ids array<int>"])
    return _per_batch(docs.select(*keep, "text"), path, schema, encode)


def decoded(ids: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep` and `text`: what `token_ids` decode to. A null array gives an empty text."""
    kinds = dict(ids.dtypes)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = None
        for batch in batches:
            bpe = bpe or Bpe(path)
            texts = [bpe.decode(np.array(x or [], np.int64)) for x in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(texts, pa.string())], [*keep, "text"])

    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "text string"])
    return ids.select(*keep, F.col("token_ids")).mapInArrow(work, schema)

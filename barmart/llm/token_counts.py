"""Token counts of whole texts, as a subword library gives them, with long texts cut into overlapping chunks.

A text longer than one chunk is encoded in overlapping chunks with offsets. Both encodings of an overlap are followed until they have a token
boundary in common that is proven stable: a space after a character that is no space. No piece of the vocabulary holds a
space mark behind another character (checked when the model is loaded), so no merge can ever reach across it, and the
tokens before and after it don't depend on each other. The chunks are spliced there. Where an overlap has no such
boundary, it is widened, up to the whole text.

Shorter texts are split at all their stable boundaries; the counts of short pieces are kept in a bounded memo.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of a chunk, and of the first overlap.
CHUNK = 1 << 12
OVERLAP = 64
MEMO = 400_000
MEMO_CHARS = 40
MARK = "▁"


class Counter(dict):
    """Number of tokens of one unit: a word with the space mark that stands before it."""

    def __init__(self, model: str):
        super().__init__()
        self.model = sentencepiece.SentencePieceProcessor(model_file=model)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces):
            raise ValueError("a piece of this vocabulary reaches across words; no boundary is stable")
        if self.model.encode("a  b", out_type=str)[-1] == MARK + "b" and len(self.model.encode("a  b")) == 2:
            raise ValueError("this model drops spaces; offsets of its tokens can't be followed")

    def __missing__(self, word: str) -> int:
        count = len(self.model.encode(word)) if word else 1
        if len(word) <= MEMO_CHARS:
            if len(self) >= MEMO:
                self.clear()
            self[word] = count
        return count

    def short(self, text: str) -> int:
        """A text without chunks: the sum over the units that stable boundaries cut off."""
        if not text:
            return 0
        words = text.split(" ")
        if "" in words:  # more than one space: marks belong to the word behind them
            units = re.findall(f"{MARK}*[^{MARK}]+|{MARK}+", MARK + text.replace(" ", MARK))
            words = [u[1:].replace(MARK, " ") for u in units]
        return sum(map(self.__getitem__, words))

    def boundaries(self, text: str) -> list[int]:
        """Offsets in `text` at which its tokens begin (the mark before the text counts as offset 0)."""
        pieces = self.model.encode(text, out_type=str)
        if "<0x" not in "".join(pieces):  # no piece stands for a byte: each begins where the one before it ends
            return [0, *(x - 1 for x in accumulate(map(len, pieces[:-1])))] if pieces else []
        offsets, at = [], -1
        for piece in pieces:
            byte = re.fullmatch("<0x([0-9A-F]{2})>", piece)
            inside = byte and int(byte[1], 16) & 0xC0 == 0x80  # a further byte of a character begins where that does
            offsets.append(max(at - bool(inside), 0))
            at += 0 if inside else 1 if byte else len(piece)
        return offsets

    def huge(self, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
        """A text in overlapping chunks, spliced at the last stable boundary that both encodings of an overlap have."""
        total, start = 0, 0
        while len(text) - start > chunk:
            width, end = overlap, start + chunk
            while True:
                left = self.boundaries(text[start:end])
                right_from = max(start + 1, end - width)
                right = {right_from + x for x in self.boundaries(text[right_from : min(len(text), end + width)])}
                shared = (x + start for x in reversed(left) if right_from < x + start < end)
                stable = (x for x in shared if x in right and text[x] == " " and text[x - 1] != " ")
                cut = next(stable, None)
                if cut is not None:
                    break
                if end == len(text):
                    return total + self.last(text, start)
                width *= 2
                end = min(len(text), end + width)
            total += bisect_left(left, cut - start)
            start = cut + 1  # the space itself is the mark that the next chunk begins with
        return total + self.last(text, start)

    def last(self, text: str, start: int) -> int:
        """What is left behind the last cut: the mark of the cut's space alone, if nothing follows it."""
        return self.short(text[start:]) if start < len(text) else self[""]

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        text = text.replace(MARK, " ")  # the model reads both alike
        return self.huge(text) if len(text) > CHUNK else self.short(text)


def token_counts(docs: DataFrame, model: str, limit: int = 4096) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row of `docs` (doc_id, text; other columns are ignored).

    `model` is a file of the public tokenizers that every executor has. Null and empty texts have no tokens. Repeated rows
    are returned as often as they occur; an empty table gives an empty table.
    """
    kind = dict(docs.dtypes)["doc_id"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = None
        for batch in batches:
            counter = counter or Counter(model)
            tokens = [counter.count(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(tokens, pa.int64())], ["doc_id", "n_bytes", "n_tokens"]
            )

    rows = docs.select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    counted = rows.mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)

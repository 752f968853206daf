"""Substring dedup: relative Lempel-Ziv factoring of every document against the whole corpus.

The reference is the corpus itself, cut by content into blocks: a block is a run of consecutive `length`-word windows whose
smallest `gram`-word code (the anchor) is at the same place, with all words of these windows. Equal windows have equal
anchors at equal offsets, so equal text is cut into equal blocks wherever it stands, save for the blocks at its two ends.

1. Every block of every document is indexed under its anchor. Anchors that occur once can't hold a repeated window.
2. A document is factored greedily. A block that the index holds elsewhere is consumed whole (one lookup for up to
   length - gram + 1 windows).
3. At factor boundaries, where blocks of one anchor differ, the windows of each distinct block are compared one by one by
   128-bit codes, so a repeated window is found also where it straddles the end of a factor.
4. Runs of repeated windows make factors of `length` words or more; the words that they cover are the duplicate spans.

Nothing is compared in pairs: each step counts by key, is combined before its exchange, and each block goes through once.
Blocks, anchors and spans of one document are bounded by its length. Documents are told apart by a 128-bit code of the
text, so equal texts share their spans and neither null nor repeated ids matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barmart.llm.shared import join_kept, slices, stored
from barmart.llm.words import STEP, STEP_2, WordCodes, mixed, window_codes

GRAM = 8
#: Bits for the windows of a block in a packed span; length - gram + 1 must not exceed it.
MASK_BITS = 28


def _least_places(grams: np.ndarray, span: int) -> np.ndarray:
    """For each run of `span` codes the place of the smallest, the leftmost if equal."""
    place, have = np.arange(len(grams)), 1
    while have < span:
        step = min(have, span - have)
        left, right = place[: len(place) - step], place[step:]
        place = np.where(grams[left] <= grams[right], left, right)
        have += step
    return place


def blocks_of(codes: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, block code, first window, number of windows) of each block of one text."""
    n = len(codes)
    if n < length:
        empty = np.empty(0, np.int64)
        return empty.view(np.uint64), empty.view(np.uint64), empty, empty
    grams = window_codes(codes, gram)
    place = _least_places(grams, length - gram + 1)
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    many = np.diff(np.append(first, len(place)))
    anchor = grams[place[first]]
    down = np.full(n + 1, np.uint64(pow(STEP_2, -1, 1 << 64)))
    down[0] = 1
    up = np.full(n + 1, np.uint64(STEP_2))
    up[0] = 1
    down, up = np.multiply.accumulate(down), np.multiply.accumulate(up)
    sums = np.zeros(n + 1, np.uint64)
    np.add.accumulate(codes * down[:n], out=sums[1:])
    block = mixed((sums[first + many + length - 1] - sums[first]) * up[first] + many.astype(np.uint64) * np.uint64(STEP))
    return anchor, block, first, many


def factors(starts: np.ndarray, length: int, n_words: int) -> list[tuple[int, int]]:
    """(first word, number of words) of the factors of a text whose repeated windows begin at `starts`.

    Greedy from the left: a factor goes on as long as the window that begins at the next word is repeated too. Factors may
    overlap or touch; what lies outside is literal.
    """
    if not len(starts):
        return []
    starts = np.unique(starts)
    cut = np.flatnonzero(np.diff(starts) > 1)
    begin = starts[np.concatenate([[0], cut + 1])]
    end = starts[np.concatenate([cut, [len(starts) - 1]])] + length
    return [(int(a), int(min(b, n_words) - a)) for a, b in zip(begin, end)]


def covered(packed: list[int] | None, length: int, n_words: int) -> np.ndarray:
    """Which words of a text lie in a factor, from its packed spans (first window of a block, bits of its windows)."""
    removed = np.zeros(n_words, bool)
    if packed:
        spans = np.asarray(packed, np.int64)
        bits = np.arange(MASK_BITS)
        hit = (spans[:, None] >> bits) & 1
        starts = ((spans >> MASK_BITS)[:, None] + bits)[hit.astype(bool)]
        for first, many in factors(starts, length, n_words):
            removed[first : first + many] = True
    return removed


def _with_key(docs: DataFrame) -> DataFrame:
    return docs.withColumns({"_t1": F.xxhash64("text"), "_t2": F.xxhash64(F.lit("text"), "text")})


def repeated_spans(docs: DataFrame, length: int = 35, gram: int = GRAM) -> DataFrame:
    """(_t1, _t2, spans): for each text with repeated windows, its blocks with the bits of those windows."""
    if not 0 < length - gram + 1 <= MASK_BITS:
        raise ValueError(f"length - gram + 1 must lie between 1 and {MASK_BITS}")
    texts = _with_key(docs.select("text")).select("_t1", "_t2", F.col("text").cast("binary").alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = WordCodes()
        for batch in slices(batches):
            found, sizes = [], []
            for text in batch.column(2).to_pylist():
                found.append(blocks_of(codes.of(text.split() if text else []), length, gram))
                sizes.append(len(found[-1][0]))
            keys = [np.repeat(batch.column(i).to_numpy(), sizes) for i in (0, 1)]
            cols = [np.concatenate([f[i] for f in found]) for i in range(4)]
            packed = (cols[2] << MASK_BITS) | cols[3]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (cols[0].view(np.int64), cols[1].view(np.int64), *keys, packed)],
                ["anchor", "block", "_t1", "_t2", "at"],
            )

    rows = stored(texts.mapInArrow(cut, "anchor long, block long, _t1 long, _t2 long, at long"), "blocks")
    often = (
        rows.groupBy("anchor")
        .agg(F.count("*").alias("times"), F.min("block").alias("low"), F.max("block").alias("high"))
        .filter("times > 1")
        .select("anchor", (F.col("low") == F.col("high")).alias("alike"))
    )
    often = stored(often, "often")  # both sides of the join are plain exchanges then, so a hot anchor can be split
    known = stored(rows.join(often, "anchor"), "repeated")
    size = F.col("at").bitwiseAND((1 << MASK_BITS) - 1)
    all_bits = F.expr(f"shiftleft(1L, CAST(at & {(1 << MASK_BITS) - 1} AS INT)) - 1")
    place = F.expr(f"at - (at & {(1 << MASK_BITS) - 1})")
    whole = known.filter("alike").select("_t1", "_t2", (place + all_bits).alias("span"))

    # Where blocks of one anchor differ: one stand-in for each distinct block, its windows one by one.
    distinct = (
        known.filter("NOT alike")
        .groupBy("anchor", "block")
        .agg(F.count("*").alias("times"), F.min(F.struct("_t1", "_t2", "at")).alias("one"))
    )
    asked = stored(
        distinct.groupBy("one._t1", "one._t2").agg(
            F.collect_list(F.struct("anchor", "block", "one.at", (F.col("times") > 1).alias("more"))).alias("asked")
        ),
        "asked",
    )
    texts_asked = join_kept(texts, asked, ["_t1", "_t2"])

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = WordCodes()
        for batch in slices(batches, 256):
            out = []
            for text, wanted in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                own = codes.of(text.split())
                one, two = window_codes(own, length, STEP), window_codes(own, length, STEP_2)
                first = np.array([x["at"] >> MASK_BITS for x in wanted])
                many = np.array([x["at"] & ((1 << MASK_BITS) - 1) for x in wanted])
                off = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                at = np.repeat(first, many) + off
                out.append(
                    [one[at].view(np.int64), two[at].view(np.int64)]
                    + [np.repeat(np.array([x[k] for x in wanted]), many) for k in ("anchor", "block", "more")]
                    + [off]
                )
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([o[i] for o in out])) for i in range(6)],
                    ["w1", "w2", "anchor", "block", "more", "off"],
                )

    kinds = "w1 long, w2 long, anchor long, block long, more boolean, off long"
    single = stored(texts_asked.select("_t1", "_t2", "text", "asked").mapInArrow(windows, kinds), "windows")
    origin = F.xxhash64("anchor", "block", "off")
    twice = (
        single.groupBy("w1", "w2")
        .agg(F.max("more").alias("more"), F.min(origin).alias("low"), F.max(origin).alias("high"))
        .filter("more OR low <> high")
        .select("w1", "w2")
    )
    masks = (
        single.join(twice, ["w1", "w2"])
        .groupBy("anchor", "block")
        .agg(F.bit_or(F.expr("shiftleft(1L, CAST(off AS INT))")).alias("mask"))
    )
    masks = stored(masks, "masks")
    parts = known.filter("NOT alike").join(masks, ["anchor", "block"]).select("_t1", "_t2", (place + F.col("mask")).alias("span"))
    return whole.unionByName(parts).groupBy("_t1", "_t2").agg(F.collect_set("span").alias("spans"))


def _with_spans(docs: DataFrame, length: int) -> DataFrame:
    """The rows as a struct, so that no column of theirs can clash with the working columns; and their spans."""
    rows = docs.select(F.struct("*").alias("_row"), "text")
    return join_kept(_with_key(rows).drop("text"), stored(repeated_spans(docs, length), "spans"), ["_t1", "_t2"], "left")


def dedup_digests(docs: DataFrame, length: int = 35) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) for every row of `docs` (doc_id, text; other columns are ignored).

    Every word is removed that a window of `length` words covers whose words also begin anywhere else in the table, in the
    same text too. Texts that are null, empty or shorter than a window lose nothing; null counts as empty. Of repeated rows
    each counts, so all their windows go. An empty table gives an empty table.
    """
    kind = dict(docs.dtypes)["doc_id"]
    rows = _with_spans(docs.select("doc_id", "text"), length).select(
        "_row.doc_id", F.col("_row.text").cast("binary").alias("text"), "spans"
    )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, gone, sha = [], [], []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                words = text.split() if text else []
                removed = covered(spans, length, len(words))
                n.append(len(words))
                gone.append(int(removed.sum()))
                kept = words if not gone[-1] else [words[i] for i in np.flatnonzero(~removed)]
                sha.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_sha256"],
            )

    return rows.mapInArrow(digest, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string")


def without_repeats(docs: DataFrame, length: int = 35) -> DataFrame:
    """`docs` with the same columns; a text that holds repeated windows becomes its kept words, joined by one space.

    Other texts stay as they are, byte for byte. n_chars, if there, follows the text. No row is dropped.
    """
    names = docs.columns
    rows = _with_spans(docs, length).select("_row", "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = dict(zip(names, batch.column(0).flatten()))
            out = []
            for text, spans in zip(columns["text"].to_pylist(), batch.column(1).to_pylist()):
                if spans:
                    words = text.encode("utf-8", "surrogatepass").split()
                    kept = np.flatnonzero(~covered(spans, length, len(words)))
                    text = b" ".join([words[i] for i in kept]).decode("utf-8", "surrogatepass")
                out.append(text)
            columns["text"] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(list(columns.values()), names)

    cut_rows = rows.mapInArrow(cut, docs.schema)
    if "n_chars" in names:
        cut_rows = cut_rows.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cut_rows.select(*names)

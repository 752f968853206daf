"""N-gram Jaccard join: documents whose sets of word shingles are alike, and the classes these links make.

Jaccard distance (one minus similarity) is a metric, and the join works on regions around pivots:

1. Equal sets become one representative (the smallest doc_id).
2. Around the empty set as pivot, where the distance is the set's size, shells of ratio 1/similarity are laid; a set also
   goes to the next shell, since its partner's size is within that ratio. Against pivots of other texts nearly every
   distance is 1, which tells nothing, so a set is only held against pivots that it can come near. Of its shingles in one
   order (frequent ones last) the first n - ceil(similarity * n) + floor(EXTRA * n) + 1 are looked at: two sets that link
   share more than similarity * EXTRA * n of these. In each (shingle, shell) the smallest representative is the pivot, and
   a set belongs to the region of a pivot that it met often enough: with m pivots met in a shell, every partner is met
   under one of them need / m times or more, by both. So each linked pair meets in a region.
3. Distances to a region's first member, its centre, are exact. Sets within the radius are linked to it and so with each
   other. By the triangle inequality a set beyond twice the radius can't link with those; what lies between is the window:
   boundary sets, compared with the members whose distance to the centre differs by no more than the radius.
4. What a region leaves open (the sets beyond the radius among each other, and the window against the core) is joined
   the same way again, pivot by pivot. A small region is joined in one task. Of a large one, the distances to the pivot are
   taken row by row, and only what stays open is cut into blocks, every two of which meet in a task of their own.

Steps 3 and 4 give enough links to connect every class. `jaccard_pairs` and `jaccard_counts` give or count all links: every
two sets of a region are compared, in blocks of large regions, and a pair that shares several regions counts in the first.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barmart.llm.components import components
from barmart.llm.shared import if_small, lists, slices, stored
from barmart.llm.words import shingle_sets

#: Shingles seen in OFTEN of SLICE documents in a row are candidates for the list of frequent ones.
SLICE, OFTEN = 4096, 3
#: Bytes of texts whose sets are held at once.
SLICE_BYTES = 1 << 22
#: Length of the list of frequent shingles that tasks hold (1 MB). It only decides the order of shingles, never the links.
FREQUENT = 1 << 16
#: Share of a set's shingles that is looked at beyond the least number, so that partners must meet several times.
EXTRA = 0.05
#: Sets that one task holds of a region; a larger region is dealt to many tasks.
BLOCK = 512
#: Shingles of these sets together; a region with more is dealt to many tasks as well, so that long texts don't fill one.
BLOCK_SHINGLES = 1 << 20
#: Shingles whose columns one matrix product takes.
WIDTH = 4096
#: Shingles that are sorted at once when all pairs of a region are compared.
PIECE = 1 << 20


def _sets(batch: pa.RecordBatch, length: int) -> list[np.ndarray]:
    return shingle_sets(batch.column(1).to_pylist(), length)


def _keys(sets: list[np.ndarray]) -> list[pa.Array]:
    """Both halves of the 128-bit key of each set."""
    whole = [xxhash.xxh3_128_intdigest(s.tobytes(), 1) for s in sets]
    return [pa.array([half - (1 << 63) for half in part], pa.int64()) for part in ([x & ((1 << 64) - 1) for x in whole], [x >> 64 for x in whole])]


def _frequent(texts: DataFrame, length: int) -> np.ndarray:
    """Shingles that are frequent in the whole table, at most FREQUENT, the most frequent first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, SLICE, 1, SLICE_BYTES):
            sets = _sets(batch, length)
            values, counts = np.unique(np.concatenate([np.empty(0, np.uint64), *sets]), return_counts=True)
            often = counts >= OFTEN
            yield pa.RecordBatch.from_arrays(
                [pa.array(values[often].view(np.int64)), pa.array(counts[often].astype(np.int64))], ["shingle", "n"]
            )

    totals = texts.mapInArrow(count, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    top = totals.filter("n >= 32").orderBy(F.desc("n"), "shingle").limit(FREQUENT).select("shingle").collect()
    return np.sort(np.array([r[0] for r in top], np.int64).view(np.uint64))


def shingle_digests(docs: DataFrame, length: int = 5, similarity: float = 0.75) -> DataFrame:
    """(doc_id, n, k1, k2, first): size, 128-bit key and the first shingles of each document's set."""
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    frequent = _frequent(texts, length)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, column=1):
            sets, n, first = _sets(batch, length), [], []
            k1, k2 = _keys(sets)
            for s in sets:
                n.append(len(s))
                keep = len(s) - math.ceil(similarity * len(s) - 1e-9) + int(EXTRA * len(s) + 1e-9) + 1 if len(s) else 0
                if len(frequent) and len(s):
                    late = frequent[np.minimum(np.searchsorted(frequent, s), len(frequent) - 1)] == s
                    s = np.concatenate([s[~late], s[late]])
                first.append(s[:keep])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), k1, k2, lists(first)],
                ["doc_id", "n", "k1", "k2", "first"],
            )

    kind = dict(docs.dtypes)["doc_id"]
    return texts.mapInArrow(digest, f"doc_id {kind}, n long, k1 long, k2 long, first array<long>")


def _overlap(a: np.ndarray, flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """How many of `a` each of the sets laid end to end in `flat` holds."""
    if not len(a):
        return np.zeros(len(starts), np.int64)
    hit = a[np.minimum(np.searchsorted(a, flat), len(a) - 1)] == flat
    return np.add.reduceat(np.append(hit, False).astype(np.int64), starts) if len(starts) else np.empty(0, np.int64)


def _linked(both, n, m, similarity: float):
    """Compares in whole hundredths, so that no rounding decides a link."""
    return 100 * both >= round(100 * similarity) * (n + m - both)


def join_open(ids: list, sets: list[np.ndarray], core: np.ndarray, far: np.ndarray, similarity: float) -> list[tuple]:
    """Links that join up the sets of one task, by pivots. Two core sets are known to be connected and aren't compared.

    `far` is the distance to the pivot of the region; sets whose distances differ by more than the radius can't link.
    Each step takes an open set as pivot, compares it with the sets that the triangle inequality leaves, records a link
    for each class that it joins, and drops it. Sets of one class needn't be compared again.
    """
    radius, count = 1 - similarity + 1e-9, len(ids)
    root = np.arange(count)
    if core.any():
        root[core] = np.flatnonzero(core)[0]
    sizes = np.array([len(s) for s in sets], np.int64)
    links = []
    for i in np.flatnonzero(~core):
        later = core | (np.arange(count) > i)
        other = np.flatnonzero(
            later
            & (root != root[i])
            & (np.abs(far - far[i]) <= radius)
            & (100 * np.minimum(sizes, sizes[i]) >= round(100 * similarity) * np.maximum(sizes, sizes[i]))
        )
        if not len(other):
            continue
        flat = np.concatenate([sets[j] for j in other])
        starts = np.concatenate([[0], np.cumsum(sizes[other])[:-1]])
        both = _overlap(sets[i], flat, starts)
        for j in other[_linked(both, sizes[i], sizes[other], similarity)]:
            if root[j] != root[i]:
                links.append((ids[i], ids[j]))
                root[root == root[j]] = root[i]
    return links


def region_links(ids: list, sets: list[np.ndarray], pivot: int, similarity: float) -> list[tuple]:
    """Links that join up one whole region: the core around the pivot, then what the pivot leaves open."""
    sizes = np.array([len(s) for s in sets], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    both = _overlap(sets[pivot], np.concatenate(sets), starts)
    core = _linked(both, sizes[pivot], sizes, similarity)
    core[pivot] = True
    far = 1 - both / (sizes + sizes[pivot] - both)
    links = [(ids[i], ids[pivot]) for i in np.flatnonzero(core) if ids[i] != ids[pivot]]
    return links if core.all() else links + join_open(ids, sets, core, far, similarity)


def _shared(sets: list[np.ndarray]) -> np.ndarray:
    """How many members every two of the sorted sets share; a set's own size isn't told."""
    total = np.zeros((len(sets), len(sets)), np.int64)
    pieces = sum(len(s) for s in sets) // PIECE + 1
    edges = np.array([(k << 64) // pieces for k in range(1, pieces)], np.uint64)
    cuts = [np.concatenate([[0], np.searchsorted(s, edges), [len(s)]]).astype(np.int64) for s in sets]
    for k in range(pieces):
        part = [s[c[k] : c[k + 1]] for s, c in zip(sets, cuts)]
        rows = np.repeat(np.arange(len(part)), [len(s) for s in part])
        _, codes, counts = np.unique(np.concatenate([np.empty(0, np.uint64), *part]), return_inverse=True, return_counts=True)
        several = counts > 1
        held = several[codes]
        rows, codes = rows[held], (np.cumsum(several) - 1)[codes[held]]
        order = np.argsort(codes, kind="stable")
        rows, codes = rows[order], codes[order]
        for low in range(0, int(several.sum()), WIDTH):
            a, b = np.searchsorted(codes, [low, low + WIDTH])
            block = np.zeros((len(sets), min(WIDTH, int(several.sum()) - low)), np.float32)
            block[rows[a:b], codes[a:b] - low] = 1
            total += (block @ block.T).astype(np.int64)
    return total


def region_pairs(sets: list[np.ndarray], before: list[np.ndarray], own: list[int] | None, similarity: float) -> np.ndarray:
    """A symmetric matrix of the pairs of a region that link and share no region before this one.

    `before` are the earlier regions of each set. Where two blocks of a region meet, `own` is the block of each set, and only
    pairs between the two are told.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    found = _linked(_shared(sets), sizes[:, None], sizes[None, :], similarity)
    np.fill_diagonal(found, False)
    if own is not None:
        found &= np.not_equal.outer(own, own)
    return found & (_shared(before) == 0) if found.any() else found


def _groups(batches: Iterator[pa.RecordBatch], key: int) -> Iterator[list[tuple]]:
    """Rows of sorted batches, by runs of equal keys (the first `key` columns)."""
    now, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() if not pa.types.is_list(c.type) else _arrays(c) for c in batch.columns)):
            if row[:key] != now:
                if rows:
                    yield rows
                now, rows = row[:key], []
            rows.append(row)
    if rows:
        yield rows


def _arrays(column: pa.ListArray) -> list[np.ndarray]:
    flat = column.values.to_numpy(zero_copy_only=False).view(np.uint64)
    ends = column.offsets.to_numpy()
    return [flat[a:b].copy() for a, b in zip(ends[:-1], ends[1:])]


def _pairs(found: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], kind) for i in (0, 1)], ["a", "b"])


class Regions(NamedTuple):
    """Distinct sets and the regions in which they meet."""

    #: (k1, k2, rep, doc, n): key, number, smallest doc_id and size of each set.
    reps: DataFrame
    #: doc_ids of several rows.
    again: DataFrame
    #: (pivot, rep, n): the sets of each region.
    region: DataFrame
    #: (pivot, size, shingles_held, heart, blocks): regions of two sets or more, with the smallest number in them.
    sizes: DataFrame
    #: with_sets(rows, weight) adds the shingles of `rep`, made again from the texts of just these documents; `weight` tells how
    #: many numbers the rows hold.
    with_sets: Callable[[DataFrame, int], DataFrame]


def _blocks(sets: str, shingles: str) -> Column:
    """Blocks that a region is cut into, by its sets and by their shingles."""
    return F.ceil(F.greatest(F.col(sets) / BLOCK, F.col(shingles) / BLOCK_SHINGLES)).cast("int")


def jaccard_regions(docs: DataFrame, digests: DataFrame, length: int = 5, similarity: float = 0.75) -> Regions:
    """The regions of all sets: every two sets that link meet in one of them or more."""
    kind = dict(docs.dtypes)["doc_id"]
    known = digests.filter("n > 0 AND doc_id IS NOT NULL")
    reps = known.groupBy("k1", "k2").agg(F.min("doc_id").alias("doc"), F.first("n").alias("n"))
    reps = stored(reps.withColumn("rep", F.monotonically_increasing_id()), "representatives")
    n_reps = reps.count()
    again = stored(known.groupBy("doc_id").agg(F.count("*").alias("times")).filter("times > 1").select("doc_id"), "again")
    n_again = again.count()
    key = ["k1", "k2", "doc_id"]
    chosen = if_small(reps.select("k1", "k2", F.col("doc").alias("doc_id"), "rep"), n_reps)
    firsts = known.join(chosen, key)
    if n_again:
        few = if_small(again, n_again)
        firsts = firsts.join(few, "doc_id", "left_anti").unionByName(firsts.join(few, "doc_id", "left_semi").dropDuplicates(["rep"]))
    postings = firsts.select(F.explode("first").alias("shingle"), "rep")
    shared = stored(postings.groupBy("shingle").agg(F.count("*").alias("sets")).filter("sets > 1").select("shingle"), "shared")
    common = stored(postings.join(shared, "shingle"), "common")
    need = F.floor(similarity * EXTRA * F.col("n") - 1e-9) + 1
    able = common.groupBy("rep").agg(F.count("*").alias("have")).join(reps.select("rep", "n"), "rep")
    able = stored(able.withColumn("need", need).filter("have >= need").select("rep", "n", "need"), "able")
    n_able = able.count()
    shell = F.floor(F.log("n") / F.lit(-math.log(similarity)) + 1e-9)
    met = common.join(if_small(able, n_able), "rep").select("shingle", "rep", F.explode(F.array(shell, shell + 1)).alias("shell"))
    pivots = met.groupBy("shingle", "shell").agg(F.min("rep").alias("pivot"), F.max("rep").alias("high")).filter("pivot <> high")
    times = met.join(pivots.drop("high"), ["shingle", "shell"]).groupBy("rep", "shell", "pivot").agg(F.count("*").alias("times"))
    own = Window.partitionBy("rep", "shell")
    times = times.withColumns({"pivots": F.count("*").over(own), "total": F.sum("times").over(own)})
    times = times.join(if_small(able, n_able), "rep").filter("total >= need AND times * pivots >= need")
    region = times.select("pivot", "rep", "n").distinct()
    region = stored(region, "region")
    sizes = region.groupBy("pivot").agg(F.count("*").alias("size"), F.sum("n").alias("shingles_held"), F.min("rep").alias("heart"))
    sizes = sizes.filter("size > 1").withColumn("blocks", _blocks("size", "shingles_held"))
    sizes = stored(sizes, "sizes")

    def with_sets(rows: DataFrame, count: int) -> DataFrame:
        wanted = reps.join(if_small(rows.select("rep").distinct(), count), "rep", "left_semi")
        wanted = if_small(wanted.select("k1", "k2", F.col("doc").alias("doc_id"), "rep"), count)
        texts = docs.select("doc_id", F.col("text").cast("binary").alias("text"))

        def to_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, column=1):
                sets = _sets(batch, length)
                k1, k2 = _keys(sets)
                yield pa.RecordBatch.from_arrays([batch.column(0), k1, k2, lists(sets)], [*key[2:], *key[:2], "shingles"])

        texts = texts.join(if_small(wanted.select("doc_id").distinct(), count), "doc_id", "left_semi")
        sets = texts.mapInArrow(to_sets, f"doc_id {kind}, k1 long, k2 long, shingles array<long>")
        sets = sets.filter(F.size("shingles") > 0).join(wanted, key).select("doc_id", "rep", "shingles")
        if n_again:
            few = if_small(again, n_again)
            once = sets.join(few, "doc_id", "left_semi").dropDuplicates(["rep"])
            sets = sets.join(few, "doc_id", "left_anti").unionByName(once)
        return sets.drop("doc_id").join(if_small(rows, count), "rep")

    return Regions(reps, again, region, sizes, with_sets)


def jaccard_links(docs: DataFrame, digests: DataFrame, length: int = 5, similarity: float = 0.75) -> tuple[Regions, DataFrame]:
    """The regions, and edges (a, b) between numbers of sets that connect every class, not all links."""
    regions = jaccard_regions(docs, digests, length, similarity)
    _, _, region, sizes, with_sets = regions
    n_regions = sizes.count()
    hot, mild = [if_small(sizes.filter(f"blocks {op} 1").select("pivot", "heart"), n_regions) for op in (">", "<=")]

    def join_regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, id_kind = [], pa.int64()
        for rows in _groups(batches, 1):
            found += region_links([r[1] for r in rows], [r[2] for r in rows], 0, similarity)
            if len(found) > 10_000:
                yield _pairs(found, id_kind)
                found = []
        yield _pairs(found, id_kind)

    region = region.drop("n")
    rows = region.join(mild, "pivot").drop("heart")
    whole = with_sets(rows, rows.count()).select("pivot", "rep", "shingles")
    links = whole.repartition("pivot").sortWithinPartitions("pivot", "rep").mapInArrow(join_regions, "a long, b long")

    # Hot regions: the same steps, with the distances to the pivot and the open rest dealt to many tasks.
    rows = region.join(hot, "pivot")
    large = stored(with_sets(rows, rows.count()), "large")
    heart = large.filter("rep = heart").select("pivot", F.col("shingles").alias("around"))
    both = F.size(F.array_intersect("shingles", "around")).cast("long")
    union = F.size("shingles") + F.size("around") - both
    star = large.filter("rep <> heart").join(heart, "pivot")
    star = stored(star.select("pivot", "heart", "rep", F.size("shingles").alias("n"), both.alias("both"), union.alias("union")), "star")
    close = 100 * F.col("both") >= round(100 * similarity) * F.col("union")
    placed = star.select("pivot", "heart", "rep", "n", close.alias("core"), (1 - F.col("both") / F.col("union")).alias("far"))
    edge = placed.filter("NOT core").groupBy("pivot").agg(F.min("far").alias("least"))
    left = placed.join(edge, "pivot").filter(f"NOT core OR far >= least - {1 - similarity} - 1e-9").drop("least", "heart")
    count = left.groupBy("pivot").agg(F.count("*").alias("size"), F.sum("n").alias("shingles_held"))
    count = count.select("pivot", _blocks("size", "shingles_held").alias("blocks"))
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    cut = (
        left.join(count, "pivot")
        .withColumn("own", own)
        .withColumn("mate", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("i", F.least("own", "mate"))
        .withColumn("j", F.greatest("own", "mate"))
        .join(large.drop("heart"), ["pivot", "rep"])
        .select("pivot", "i", "j", "rep", "core", "far", "shingles")
    )

    def join_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches, 3):
            core, far = np.array([r[4] for r in rows], bool), np.array([r[5] for r in rows], float)
            yield _pairs(join_open([r[3] for r in rows], [r[6] for r in rows], core, far, similarity), pa.int64())

    keys = ["pivot", "i", "j"]
    more = cut.repartition(*keys).sortWithinPartitions(*keys, "rep").mapInArrow(join_blocks, "a long, b long")
    direct = placed.filter("core").select(F.col("rep").alias("a"), F.col("heart").alias("b"))
    return regions, links.unionByName(direct).unionByName(more)


def _named(links: DataFrame, reps: DataFrame) -> DataFrame:
    """Links between numbers of sets as links between their smallest doc_ids."""
    names = stored(reps.select("rep", "doc"), "names")
    count = names.count()
    for end in ("a", "b"):
        own = names.select(F.col("rep").alias(end), F.col("doc").alias("_doc"))
        links = links.join(if_small(own, count), end).drop(end).withColumnRenamed("_doc", end)
    return links.select("a", "b")


def _all_links(regions: Regions, sums: bool, similarity: float) -> DataFrame:
    """(a, b) for every two sets that link, each pair once; or (a, b) rows of a set and a number of documents that link with it,
    which add up to all."""
    reps, _, region, sizes, with_sets = regions
    n_regions = sizes.count()
    members = stored(region.drop("n").join(if_small(sizes.select("pivot", "blocks"), n_regions), "pivot"), "members")
    pivots = members.groupBy("rep").agg(F.collect_list("pivot").alias("pivots"))
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    before = F.array_sort(F.filter("pivots", lambda p: p < F.col("pivot")))
    copies = F.col("copies") if sums else F.lit(1).cast("long").alias("copies")
    cut = (
        members.join(pivots, "rep")
        .withColumns({"own": own, "before": before})
        .withColumn("mate", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .join(reps.select("rep", copies), "rep")
        .select("pivot", F.least("own", "mate").alias("i"), F.greatest("own", "mate").alias("j"), "rep", "own", "before", "copies")
    )
    cut = stored(cut, "cut")
    weight = cut.agg(F.sum(F.size("before") + 6)).first()[0] or 0

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches, 3):
            ids, copies = np.array([r[3] for r in rows], np.int64), np.array([r[7] for r in rows], np.int64)
            _, i, j = rows[0][:3]
            own = [r[4] for r in rows] if i != j else None
            found = region_pairs([r[5] for r in rows], [r[6] for r in rows], own, similarity)
            if sums:
                some = found.any(axis=1)
                a, b = ids[some], found[some] @ copies
            else:
                a, b = (ids[x] for x in np.nonzero(np.triu(found)))
            for at in range(0, len(a), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(x[at : at + (1 << 16)]) for x in (a, b)], ["a", "b"])

    keys = ["pivot", "i", "j"]
    cut = with_sets(cut, weight).select(*keys, "rep", "own", "shingles", "before", "copies")
    return cut.repartition(*keys).sortWithinPartitions(*keys, "rep").mapInArrow(compare, "a long, b long")


def _prepared(docs: DataFrame, length: int, similarity: float) -> tuple[DataFrame, DataFrame]:
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs, stored(shingle_digests(docs, length, similarity), "digests")


def jaccard_pairs(docs: DataFrame, length: int = 5, similarity: float = 0.75) -> DataFrame:
    """(a, b): every link between distinct sets of shingles, once, by the smallest doc_id of each set, a the smaller.

    A doc_id with several texts stands for each of its sets; if two of these link, a equals b. Copies (equal sets) link with
    each other and with all that their representative links with; they aren't listed.
    """
    docs, digests = _prepared(docs, length, similarity)
    regions = jaccard_regions(docs, digests, length, similarity)
    links = _named(_all_links(regions, False, similarity), regions.reps)
    return links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def jaccard_counts(docs: DataFrame, length: int = 5, similarity: float = 0.75) -> DataFrame:
    """(doc_id, n_shingles, n_links) for every row of `docs`: with how many other documents its text links, copies included.

    Rows that repeat doc_id and set count as one document, other texts of a doc_id as documents of their own. Null and empty
    texts and rows without doc_id link with nothing.
    """
    docs, digests = _prepared(docs, length, similarity)
    regions = jaccard_regions(docs, digests, length, similarity)
    known = digests.filter("n > 0 AND doc_id IS NOT NULL").select("k1", "k2", "doc_id").distinct()
    copies = known.groupBy("k1", "k2").agg(F.count("*").alias("copies"))
    reps = stored(regions.reps.join(copies, ["k1", "k2"]), "copies")
    sums = _all_links(regions._replace(reps=reps), True, similarity)
    sums = sums.groupBy(F.col("a").alias("rep")).agg(F.sum("b").alias("others"))
    totals = reps.join(sums, "rep", "left").select(
        "k1", "k2", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("total")
    )
    linked = F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("total")).otherwise(F.lit(0).cast("long"))
    return digests.join(totals, ["k1", "k2"], "left").select("doc_id", F.col("n").alias("n_shingles"), linked.alias("n_links"))


def jaccard_classes(docs: DataFrame, length: int = 5, similarity: float = 0.75) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of `docs` (doc_id, text; other columns are ignored).

    Null and empty texts have no shingles and link with nothing; a document without a link is its own class. Rows without
    doc_id link with nothing and have a null class. Rows that repeat a doc_id are returned as often as they occur; if their
    texts differ, they count as texts of one document. An empty table gives an empty table.
    """
    docs, digests = _prepared(docs, length, similarity)
    regions, links = jaccard_links(docs, digests, length, similarity)
    reps, again = regions.reps, regions.again
    texts = digests.join(if_small(again, again.count()), "doc_id", "left_semi").filter("n > 0")
    texts = texts.join(reps, ["k1", "k2"]).select(F.col("doc_id").alias("a"), F.col("doc").alias("b"))
    roots = components(_named(links, reps).unionByName(texts))
    classes = reps.select("k1", "k2", F.col("doc").alias("rep")).join(roots.withColumnRenamed("vertex", "rep"), "rep", "left").select(
        "k1", "k2", F.coalesce("root", "rep").alias("root")
    )
    return digests.join(classes, ["k1", "k2"], "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("root")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def one_of_each(docs: DataFrame, length: int = 5, similarity: float = 0.75) -> DataFrame:
    """The rows of `docs` that stand for their class: the smallest doc_id, once. Rows without text or doc_id stay.

    Here each text of a repeated doc_id is judged by its own set. Of the rows that repeat doc_id and set, and of the sets of one
    doc_id in one class, one row stays; of rows with equal sets, the one with the longest text.
    """
    own, digests = _prepared(docs, length, similarity)
    regions, links = jaccard_links(own, digests, length, similarity)
    reps, again = regions.reps, regions.again
    classes = reps.join(components(links).withColumnRenamed("vertex", "rep"), "rep", "left")
    classes = stored(classes.withColumn("root", F.coalesce("root", "rep")), "classes")
    first = classes.groupBy("root").agg(F.min(F.struct("doc", "rep")).alias("first"))
    sets = classes.join(first, "root").select(
        "k1", "k2", F.when(F.col("rep") == F.col("first.rep"), F.col("doc")).alias("stays")
    )
    judged = digests.filter("n > 0 AND doc_id IS NOT NULL").join(sets, ["k1", "k2"])
    times = again.count()
    few = if_small(again, times)
    drop = judged.filter("stays IS NULL OR stays <> doc_id").select("doc_id").distinct()
    drop = stored(drop.join(few, "doc_id", "left_anti"), "drop")
    kept = docs.join(if_small(drop, drop.count()), "doc_id", "left_anti")
    if not times:
        return kept
    several = kept.join(few, "doc_id", "left_semi").select(F.struct("*").alias("_row"), "doc_id", "text")
    several = several.withColumn("_code", F.sha2(F.coalesce("text", F.lit("")), 256))
    codes = shingle_digests(several.select(F.col("_code").alias("doc_id"), "text").dropDuplicates(["doc_id"]), length, similarity)
    several = several.join(codes.select(F.col("doc_id").alias("_code"), "k1", "k2", "n"), "_code").join(sets, ["k1", "k2"], "left")
    place = F.row_number().over(Window.partitionBy("doc_id", "k1", "k2").orderBy(F.length("text").desc_nulls_last(), "text"))
    single = several.withColumn("_place", place).filter("n = 0 OR (_place = 1 AND stays = doc_id)").select("_row.*")
    return kept.join(few, "doc_id", "left_anti").unionByName(single)

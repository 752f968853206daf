"""Conversation prefix trie: every distinct sequence of first turns, with its members, children and the tokens it saves.

A prefix is named by 128 bits: the exclusive or of the codes of its turns, each taken with its place, so that prefixes come
from running windows and a very long conversation can be cut anywhere. A count-min sketch of all prefix digests screens them: a
sketch never counts too low, so an estimate of one proves that no other conversation has the prefix, nor any longer one.
These tails are emitted where they are; only prefixes that may be shared are exchanged and grouped exactly. What the sketch
can't tell apart is grouped too, so its size changes the work, never the result.

Sums over a subtree need no walk by level. The smallest member of a node stands for it, and then for every deeper node on its
own path; each conversation adds up, from its end, what the nodes it stands for save, and a node sums this over its members.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barmart.llm.shared import stored

#: Fixed values of the contract: a block of conversations shares the head of its first one; heads have up to three turns.
BLOCK, HEADS = 20, 4
WORD = r"[^\x20\x09-\x0D]+"
#: Consecutive turns of a conversation that one window takes.
CHUNK = 4096
#: The sketch has two lines of cells: eight for each prefix, at least and at most so many (a byte each); a block of cells is
#: merged at once, from at most SKETCH_TASKS tasks.
CELLS_PER_PREFIX, LEAST_CELLS, MOST_CELLS = 8, 1 << 12, 1 << 24
CELL_BLOCK, SKETCH_TASKS = 1 << 16, 256
#: Characters of the pieces in which the ids that end at a node are hashed.
PIECE = 8192
NODE = ["pos", "x", "y"]
SHARED, FIRST_OF_TAIL, TAIL = 0, 1, 2


def placed_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, code, words): turns numbered from 1 in each conversation, by turn (null first).

    Equal turns are ordered by the MD5 of role and text. Conversations without an id are left out. The rows are sorted by
    ranges, which cut a very long conversation, numbered in each range, and shifted by the counts of the ranges before.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.filter("conv_id IS NOT NULL").select(
        "conv_id",
        "turn",
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("code"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
        F.monotonically_increasing_id().alias("row"),  # cuts rows that are all equal; their order doesn't matter
    )
    order = ["turn", "code", "row"]
    turns = stored(turns.repartitionByRange("conv_id", *order).withColumn("part", F.spark_partition_id()), "turns")
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = turns.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    shifts = shifts.select("conv_id", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    local = turns.withColumn("nth", F.row_number().over(Window.partitionBy("conv_id", "part").orderBy(*order)))
    return local.join(shifts, ["conv_id", "part"]).select("conv_id", (F.col("shift") + F.col("nth")).alias("place"), "code", "words")


def rebuilt_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, total, pos, code, words): the turns of every rebuilt conversation, from 1, and a row 0 for the empty prefix.

    `turns` are placed turns. `total` is the length of the rebuilt conversation.
    """
    convs = turns.groupBy("conv_id").agg(F.count("*").alias("own"))
    convs = convs.withColumns(
        {"h": F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS, "base": F.col("conv_id") - F.col("conv_id") % BLOCK}
    )
    bases = convs.filter("conv_id = base").select("base", F.col("own").alias("base_own"))
    taken = F.least("h", F.coalesce("base_own", F.lit(0)))
    convs = convs.join(bases, "base", "left").withColumn("taken", taken)
    convs = convs.withColumn("total", F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0)))
    convs = stored(convs.select("conv_id", "base", "h", "taken", "total"), "convs")
    heads = turns.filter((F.col("place") < HEADS) & (F.col("conv_id") % BLOCK == 0)).select(
        F.col("conv_id").alias("base"), F.col("place").alias("pos"), "code", "words"
    )
    names = ["conv_id", "total", "pos", "code", "words"]
    headed = convs.join(heads, "base").filter("pos <= taken").select(*names)
    own = turns.join(convs, "conv_id").filter("place > h").withColumn("pos", F.col("place") - F.col("h") + F.col("taken"))
    root = convs.select("conv_id", "total", F.lit(0).cast("long").alias("pos"), F.lit("").alias("code"), F.lit(0).cast("long").alias("words"))
    return headed.unionByName(own.select(*names)).unionByName(root)


def running(
    rows: DataFrame, columns: list[str], gather: Callable[[str], Column], merge: Callable[[Column, Column], Column], from_end: bool
) -> DataFrame:
    """`rows` (conv_id, total, pos, ...) with `columns` gathered over all rows of the conversation up to (or from) each one.

    Conversations are cut into chunks; only the totals of chunks run over a whole conversation.
    """
    rows = rows.withColumn("chunk", F.floor(F.col("pos") / CHUNK))
    way = (lambda c: F.desc(c)) if from_end else F.asc
    inside = Window.partitionBy("conv_id", "chunk").orderBy(way("pos")).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("conv_id").orderBy(way("chunk")).rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.filter(F.col("total") >= CHUNK).groupBy("conv_id", "chunk").agg(*[gather(c).alias(c) for c in columns])
    totals = totals.select("conv_id", "chunk", *[gather(c).over(before).alias(f"{c}_before") for c in columns])
    local = rows.withColumns({c: gather(c).over(inside) for c in columns}).join(totals, ["conv_id", "chunk"], "left")
    whole = {c: merge(F.col(c), F.coalesce(f"{c}_before", F.lit(0))) for c in columns}
    return local.withColumns(whole).drop("chunk", *[f"{c}_before" for c in columns])


def prefixes(rebuilt: DataFrame) -> DataFrame:
    """(conv_id, total, pos, words, x, y, px, py): the digest of every prefix and of the prefix before it; 0 for the empty one."""
    code = [F.when(F.col("pos") > 0, F.xxhash64(F.lit(k), "pos", "code")).otherwise(0) for k in (1, 2)]
    rows = rebuilt.select("conv_id", "total", "pos", "words", code[0].alias("x"), code[1].alias("y"))
    rows = rows.withColumns({"own_x": F.col("x"), "own_y": F.col("y")})
    rows = running(rows, ["x", "y"], F.bit_xor, lambda a, b: a.bitwiseXOR(b), from_end=False)
    return rows.select(
        "conv_id", "total", *NODE, "words", F.col("x").bitwiseXOR(F.col("own_x")).alias("px"), F.col("y").bitwiseXOR(F.col("own_y")).alias("py")
    )


def _numbers(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


def prefix_sketch(rows: DataFrame, most_cells: int = MOST_CELLS) -> np.ndarray:
    """Two lines of cells over the (x, y) of all rows; cell counts stop at 255. Its size is bounded by `most_cells`.

    Tasks count into whole sketches and hand on their blocks, which are added up block by block.
    """
    cells = LEAST_CELLS
    wanted = CELLS_PER_PREFIX * rows.count()
    while cells < min(wanted, most_cells):
        cells *= 2
    block = min(cells, CELL_BLOCK)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines = np.zeros((2, cells), np.uint8)
        for batch in batches:
            for line, name in zip(lines, ("x", "y")):
                at, n = np.unique(_numbers(batch, name) & (cells - 1), return_counts=True)
                line[at] = np.minimum(255, line[at] + n)
        for k, line in enumerate(lines):
            for b in range(cells // block):
                part = line[b * block : (b + 1) * block]
                if part.any():
                    yield pa.RecordBatch.from_pydict(
                        {"line": pa.array([k], pa.int32()), "block": pa.array([b], pa.int32()), "cells": pa.array([part.tobytes()], pa.binary())}
                    )

    def add(batch: pa.Table) -> pa.Table:
        total = np.zeros(block, np.int64)
        for part in batch.column("cells"):
            total += np.frombuffer(part.as_py(), np.uint8)
        out = np.minimum(255, total).astype(np.uint8).tobytes()
        return pa.table(
            {"line": batch.column("line")[:1].cast(pa.int32()), "block": batch.column("block")[:1].cast(pa.int32()), "cells": pa.array([out], pa.binary())}
        )

    kind = "line int, block int, cells binary"
    lines = np.zeros((2, cells), np.uint8)
    parts = rows.select("x", "y").coalesce(SKETCH_TASKS).mapInArrow(count, kind).groupBy("line", "block").applyInArrow(add, kind)
    for r in parts.collect():
        lines[r["line"], r["block"] * block : (r["block"] + 1) * block] = np.frombuffer(r["cells"], np.uint8)
    return lines


def estimates(lines: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How often each digest occurs at most."""
    mask = lines.shape[1] - 1
    return np.minimum(lines[0][x & mask], lines[1][y & mask])


def screened(rows: DataFrame, lines: np.ndarray) -> DataFrame:
    """Prefixes with `kind`: SHARED if others may have it (and for the empty one), FIRST_OF_TAIL or TAIL if none has."""
    sketch = rows.sparkSession.sparkContext.broadcast(lines)

    def screen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pos, x, y, px, py = (_numbers(batch, c) for c in ("pos", "x", "y", "px", "py"))
            alone = (pos > 0) & (estimates(sketch.value, x, y) == 1)
            follows = (pos > 1) & (estimates(sketch.value, px, py) == 1)
            kind = np.where(follows, TAIL, np.where(alone, FIRST_OF_TAIL, SHARED)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(kind)], [*batch.schema.names, "kind"])

    schema = rows.schema.simpleString()[len("struct<") : -1]
    return rows.mapInArrow(screen, f"{schema},kind:int")


def end_digests(ends: DataFrame) -> DataFrame:
    """(pos, x, y, ends_sha256): SHA-256 of the ids of (pos, x, y, conv_id) rows of each node, ascending and joined by commas.

    The ids of one node may be any share of all. They are sorted by ranges and written as pieces of text there; the node's
    task only passes the pieces on to the hash, one batch at a time.
    """
    names = [*NODE, "first"]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, held, size = None, [], 0

        def piece() -> pa.RecordBatch:
            values = [[v] for v in (*node, held[0])]
            return pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in values] + [pa.array([",".join(map(str, held))])], [*names, "piece"])

        for batch in batches:
            for *own, conv in zip(*(_numbers(batch, c).tolist() for c in (*NODE, "conv_id"))):
                if held and (own != node or size > PIECE):
                    yield piece()
                    held, size = [], 0
                node = own
                held.append(conv)
                size += len(str(conv)) + 1
        if held:
            yield piece()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([v], pa.int64()) for v in node] + [pa.array([state.hexdigest()])], [*NODE, "ends_sha256"])

        for batch in batches:
            for *own, piece in zip(*(_numbers(batch, c).tolist() for c in NODE), batch.column("piece")):
                if own != node:
                    if node is not None:
                        yield done()
                    node, state = own, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(piece.as_buffer())
        if node is not None:
            yield done()

    sorted_ids = ends.repartitionByRange(*NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id")
    kinds = "pos long, x long, y long"
    parts = sorted_ids.mapInArrow(pieces, f"{kinds}, first long, piece string")
    parts = parts.repartition(*NODE).sortWithinPartitions(*names)
    return parts.mapInArrow(digest, f"{kinds}, ends_sha256 string")


def trie(rows: DataFrame, most_cells: int = MOST_CELLS) -> DataFrame:
    """The nodes of stored prefixes: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    lines = prefix_sketch(rows.filter("pos > 0"), most_cells)
    judged = screened(rows, lines)
    shared = stored(judged.filter(F.col("kind") == SHARED).drop("kind"), "shared")
    tails = judged.filter(F.col("kind") != SHARED)
    firsts = tails.filter(F.col("kind") == FIRST_OF_TAIL)

    # Exact grouping of the prefixes that may be shared.
    nodes = shared.groupBy(*NODE).agg(
        F.count("*").alias("n"), F.min(F.struct("conv_id", "total")).alias("rep"), *[F.min(c).alias(c) for c in ("words", "px", "py")]
    )
    below = [(F.col("pos") - 1).alias("pos"), F.col("px").alias("x"), F.col("py").alias("y")]
    nodes = stored(nodes, "nodes")
    kids = nodes.filter("pos > 0").select(*below).unionByName(firsts.select(*below))
    kids = kids.groupBy(*NODE).agg(F.count("*").alias("n_children"))
    nodes = stored(nodes.join(kids, NODE, "left").fillna(0, ["n_children"]), "nodes")

    # What each conversation stands for: tokens saved by its nodes, and the leaf it may be.
    saves = ((F.col("n") - 1) * F.col("words")).alias("saved")
    leaf = (F.col("n_children") == 0).cast("long").alias("leaves")
    marks = nodes.select("rep.conv_id", "rep.total", "pos", saves, leaf).filter("saved > 0 OR leaves > 0")
    tips = tails.filter("pos = total").select("conv_id", "total", "pos", F.lit(0).cast("long").alias("saved"), F.lit(1).cast("long").alias("leaves"))
    none = F.lit(None).cast("long")
    marks = marks.unionByName(tips).withColumns({"x": none, "y": none})
    zero = F.lit(0).cast("long")
    places = shared.select("conv_id", "total", *NODE).withColumns({"saved": zero, "leaves": zero}).unionByName(marks)
    places = places.groupBy("conv_id", "pos").agg(
        *[F.max(c).alias(c) for c in ("total", "x", "y")], *[F.sum(c).alias(c) for c in ("saved", "leaves")]
    )
    sums = running(places, ["saved", "leaves"], F.sum, lambda a, b: a + b, from_end=True).filter("x IS NOT NULL")
    sums = sums.groupBy(*NODE).agg(F.sum("saved").alias("saved_tokens"), F.sum("leaves").alias("n_leaves"))

    ends = end_digests(shared.filter("pos = total").select(*NODE, "conv_id"))
    nothing = hashlib.sha256(b"").hexdigest()
    facts = nodes.join(sums, NODE).join(ends, NODE, "left").fillna(nothing, ["ends_sha256"])
    facts = facts.select("rep.conv_id", *NODE, "px", "py", F.col("n").alias("n_convs"), "n_children", "n_leaves", "saved_tokens", "ends_sha256")

    # A tail belongs to one conversation, down to its end.
    last = F.col("pos") == F.col("total")
    one, own_hash = F.lit(1).cast("long"), F.sha2(F.col("conv_id").cast("string"), 256)
    alone = {
        "n_convs": one,
        "n_children": F.when(last, zero).otherwise(one),
        "n_leaves": one,
        "saved_tokens": zero,
        "ends_sha256": F.when(last, own_hash).otherwise(nothing),
    }
    own = tails.withColumns(alone).select(*facts.columns, "kind")

    # The parent of a tail's first node and of a shared node may be shared; a parent that no group has is the conversation's own.
    asked = facts.withColumn("kind", F.lit(SHARED)).unionByName(own.filter(F.col("kind") == FIRST_OF_TAIL))
    parents = nodes.select((F.col("pos") + 1).alias("pos"), F.col("x").alias("px"), F.col("y").alias("py"), F.col("rep.conv_id").alias("parent"))
    root = nodes.filter("pos = 0").select("rep.conv_id").first()
    upper = F.when(F.col("pos") == 1, F.lit(root["conv_id"] if root else None).cast("long"))
    deep = asked.filter("pos > 1").join(parents.filter("pos > 1"), ["pos", "px", "py"], "left").withColumn("upper", F.coalesce("parent", "conv_id"))
    out = [
        "conv_id", F.col("pos").alias("depth"), F.col("upper").alias("parent_conv_id"),
        "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
    ]
    inner = own.filter(F.col("kind") == TAIL).withColumn("upper", F.col("conv_id"))
    return deep.select(*out).unionByName(asked.filter("pos <= 1").withColumn("upper", upper).select(*out)).unionByName(inner.select(*out))


def prefix_trie(conversations: DataFrame, most_cells: int = MOST_CELLS) -> DataFrame:
    """The prefix trie of the rebuilt conversations of (conv_id, turn, role, text); other columns are ignored.

    Null role or text counts as empty; rows without a conv_id take no part; repeated rows are turns of their own; an empty
    table has no nodes. Remainders of negative ids are negative, as in SQL.
    """
    rebuilt = stored(rebuilt_turns(stored(placed_turns(conversations), "placed")), "rebuilt")
    return trie(stored(prefixes(rebuilt), "prefixes"), most_cells)

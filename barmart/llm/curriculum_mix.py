"""Mixing sources to target weights along a time-varying curriculum.

Each source has a share of all words (its weight, limited to a multiple of its size) and a schedule: how its weight runs over
training time 0..1. The schedule's integral, times the target, is the source's cumulative token demand. A source's documents
lie end to end in a fixed pseudo-random order, as often as its target asks for; inverting the demand at the middle of a
document's words gives its training position. Documents are range-sorted by position.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barmart.llm.shared import if_small, stored

WEIGHTS = (5, 2, 1)
#: Slope of each weight's schedule w(t) = 1 - slope + 2 * slope * t, from -1 (early) to 1 (late).
SLOPES = (-0.5, 0.0, 0.5)
MOST = 3
#: Documents that one bucket of a source holds on average; the order within a source is found bucket by bucket.
BUCKET = 256
#: What the plan knows of a document. Rows alike in these lie side by side in the order of their source.
KEYS = ("source", "doc_id", "size")
#: Rows alike that are written out at a time.
PIECE = 4096


def n_words(text: Column) -> Column:
    """Number of runs of characters other than space and U+0009 to U+000D; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, sid, source_size, docs, target, slope): one row for each source of (source, size, n), n documents of one size.

    Sources by code point, null last, take the weights in turn. Targets share the sum of all sizes by weight; a target stops
    at `most` times its source's size, and what it leaves is shared by the others, until none is above. In order of size by
    weight, the sources that stop come first, so running sums find them. One row for each source goes to one task here.
    """
    by_source = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("docs"))
    place = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1).cast("int")
    pick = F.col("sid") % len(weights) + 1
    rows = by_source.withColumn("sid", place).withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), pick))
    rows = rows.withColumn("slope", F.element_at(F.array(*map(F.lit, SLOPES)), F.col("sid") % len(SLOPES) + 1))
    everyone = Window.partitionBy()
    before = Window.orderBy(F.col("source_size") / F.col("weight"), "sid").rowsBetween(Window.unboundedPreceding, -1)
    rows = (
        rows.withColumn("total", F.sum("source_size").over(everyone))
        .withColumn("spent", F.coalesce(F.sum(F.col("source_size") * most).over(before), F.lit(0)))
        .withColumn("open", F.sum("weight").over(everyone) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    )
    stops = (F.col("total") - F.col("spent")) * F.col("weight") > F.col("source_size") * most * F.col("open")
    rows = rows.withColumn("stops", stops)
    free = F.when(~F.col("stops"), F.struct(F.col("spent"), F.col("open")))
    rows = rows.withColumn("first", F.min(free).over(everyone))
    share = (F.col("weight") * (F.col("total") - F.col("first.spent"))).cast("double") / F.col("first.open").cast("double")
    target = F.when(F.col("stops"), (F.col("source_size") * most).cast("double")).otherwise(share)
    return rows.select("source", "sid", "source_size", "docs", target.alias("target"), "slope")


def position(y: Column, slope: Column) -> Column:
    """The time at which the share `y` of a demand is reached: inverse of (1 - slope) t + slope t^2 on 0..1."""
    root = F.sqrt((1 - slope) * (1 - slope) + 4 * slope * y)
    return F.when(F.abs(slope) < 1e-9, y).otherwise((root - (1 - slope)) / (2 * slope))


def _earlier(value: str, parts: list[str], order: list[str]) -> Column:
    """Sum of `value` over the rows before this one."""
    window = Window.partitionBy(*parts).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(window), F.lit(0))


def mix_plan(docs: DataFrame, most: int = MOST) -> DataFrame:
    """(source, doc_id, size, n, source_size, target, slope, before, copies, left), stored: a row for each distinct (source,
    doc_id, size) of `docs`, of which it has n rows. No text is needed here, so only narrow rows are exchanged.

    `before` counts the words of the source's documents that come earlier in its order (by MD5 of doc_id, then doc_id and
    size). `copies` whole passes over the source fit its target, and `left` words of its last, partial pass remain at this
    row (negative, if it lies beyond them). Running sums are made within buckets of the order, over the bucket totals of a
    stretch of buckets, and over the stretches, so a source with most of the rows is dealt to many tasks, and so is a
    doc_id that many rows repeat.
    """
    groups = stored(docs.groupBy(*KEYS).agg(F.count("*").alias("n")), "sizes")
    targets = stored(source_targets(groups, most=most), "targets")
    found = targets.agg(F.count("*"), F.max("docs")).first()
    digits = min(8, max(1, math.ceil(math.log(max(1, (found[1] or 1) / BUCKET), 16))))
    order = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    rows = groups.withColumn("_order", order).withColumn("_bucket", F.substring("_order", 1, digits))
    rows = rows.withColumn("_stretch", F.substring("_order", 1, digits // 2)).withColumn("_words", F.col("size") * F.col("n"))
    rows = rows.alias("d").join(if_small(targets, found[0]).alias("t"), F.col("d.source").eqNullSafe(F.col("t.source")))
    rows = rows.select("d.*", "t.sid", "t.source_size", "t.target", "t.slope")
    buckets = rows.groupBy("sid", "_stretch", "_bucket").agg(F.sum("_words").alias("_words"))
    stretches = buckets.groupBy("sid", "_stretch").agg(F.sum("_words").alias("_words"))
    stretches = stretches.select("sid", "_stretch", _earlier("_words", ["sid"], ["_stretch"]).alias("_start"))
    buckets = buckets.withColumn("_some", _earlier("_words", ["sid", "_stretch"], ["_bucket"]))
    buckets = buckets.join(stretches, ["sid", "_stretch"]).select("sid", "_bucket", (F.col("_start") + F.col("_some")).alias("_start"))
    inner = _earlier("_words", ["sid", "_bucket"], ["_order", "doc_id", "size"])
    rows = rows.withColumn("_inner", inner).join(buckets, ["sid", "_bucket"])
    want = F.floor(F.col("target") + 0.5)
    passes = F.when(F.col("source_size") > 0, F.floor(want / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    rows = rows.withColumn("before", F.col("_start") + F.col("_inner")).withColumn("copies", passes)
    left = (want - F.col("copies") * F.col("source_size") - F.col("before")).cast("long")
    columns = [*KEYS, "n", "source_size", "target", "slope", "before", "copies", left.alias("left")]
    return stored(rows.select(*columns), "mix")


def _one_by_one(plan: DataFrame) -> DataFrame:
    """Each of the n rows alike, with its own `before` and `rest`: its words that are in the last, partial pass."""
    last = F.col("n") - 1
    rows = plan.withColumn("_piece", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(last / PIECE))))
    rows = rows.withColumn("_i", F.explode(F.sequence(F.col("_piece") * PIECE, F.least(last, F.col("_piece") * PIECE + PIECE - 1))))
    gone = F.col("_i") * F.col("size")
    rest = F.greatest(F.lit(0), F.least(F.col("left") - gone, F.col("size"))).cast("long")
    return rows.withColumn("rest", rest).withColumn("before", F.col("before") + gone).drop("_piece", "_i")


def mix_digests(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken, position) for every row of `docs` (doc_id, source, text; others are
    ignored), range-sorted by `position`, the training position (0..1) of the document's first copy; it is null, and last,
    for those that the mix leaves out.

    Null and empty texts have size 0 and are never taken. A null source is a source. Rows that repeat a doc_id count each.
    """
    rows = _one_by_one(mix_plan(docs.select("doc_id", "source", n_words(F.col("text")).alias("size"))))
    rows = rows.withColumn("taken", F.col("copies") * F.col("size") + F.col("rest"))
    middle = (F.col("before") + F.col("size") / 2) / F.col("target")
    at = F.when(F.col("taken") > 0, position(F.least(middle, F.lit(1.0)), F.col("slope")))
    rows = rows.select("doc_id", "size", "source_size", "target", "taken", at.alias("position"))
    return rows.orderBy(F.col("position").asc_nulls_last(), "doc_id")


def _met(wide: DataFrame, plan: DataFrame, keys: tuple[str, ...], rows: int) -> DataFrame:
    """Wide rows with the columns of their row of the plan, which has unique keys; it is broadcast if its counted rows are few."""
    on = [F.col(f"d.{k}").eqNullSafe(F.col(f"p.{k}")) for k in keys]
    return wide.alias("d").join(if_small(plan, rows).alias("p"), on).select("d._row", "p.*")


def _repeated(wide: DataFrame, plan: DataFrame, rows: int) -> DataFrame:
    """Rows of `wide` that are alike in all of KEYS, each with its own place: by a digest of all its columns.

    Rows alike in every column are one row here until they are written out, so copies aren't gathered in one task.
    """
    some = _met(wide, plan, KEYS, rows).withColumn("_json", F.to_json("_row"))
    some = some.withColumn("_1", F.xxhash64(F.lit(1), "_json")).withColumn("_2", F.xxhash64(F.lit(2), "_json")).drop("_json")
    same = [*KEYS, "_1", "_2"]
    alike = stored(some.groupBy(*same).agg(F.count("*").alias("_n")), "alike")
    places = alike.select(*same, "_n", _earlier("_n", list(KEYS), ["_1", "_2"]).alias("_first"))
    kept = some.dropDuplicates(same).alias("d")
    met = kept.join(places.alias("p"), [F.col(f"d.{k}").eqNullSafe(F.col(f"p.{k}")) for k in same])
    met = met.select("d.*", "p._n", "p._first").drop("_1", "_2").withColumn("n", F.col("_n"))
    gone = F.col("_first") * F.col("size")
    met = met.withColumn("before", F.col("before") + gone).withColumn("left", F.col("left") - gone)
    return met.drop("_n", "_first")


def training_order(docs: DataFrame, with_position: bool = False) -> DataFrame:
    """The rows of `docs`, each as often as the mix takes it, whole, range-sorted by training position; same columns.

    A document whose words would lie across the end of its source's target is taken once more if more than half of them
    lie before it, so a source comes within half a document of its target. Documents without words aren't taken.

    The plan is made of (source, doc_id, size) alone; whole rows meet it once and are sorted once.
    """
    size = n_words(F.col("_row.text")).alias("size")
    wide = docs.select(F.struct("*").alias("_row")).select("_row", F.col("_row.source").alias("source"), F.col("_row.doc_id").alias("doc_id"), size)
    plan = mix_plan(wide.select(*KEYS)).filter((F.col("size") > 0) & ((F.col("copies") > 0) | (F.col("left") > 0)))
    counts = plan.agg(F.count_if(F.col("n") == 1), F.count_if(F.col("n") > 1)).first()
    rows = _met(wide, plan.filter("n = 1"), KEYS, counts[0])
    if counts[1]:
        rows = rows.unionByName(_repeated(wide, plan.filter("n > 1"), counts[1]))
    rows = _one_by_one(rows)
    times = (F.col("copies") + (2 * F.col("rest") > F.col("size")).cast("long")).cast("int")
    copies = rows.withColumn("_times", times).filter("_times > 0")
    copies = copies.withColumn("_time", F.explode(F.sequence(F.lit(0), F.col("_times") - 1)))
    middle = (F.col("_time") * F.col("source_size") + F.col("before") + F.col("size") / 2) / F.col("target")
    placed = copies.withColumn("_at", position(F.least(middle, F.lit(1.0)), F.col("slope"))).orderBy("_at", "doc_id", "_time")
    return placed.select("_row.*", F.col("_at").alias("position")) if with_position else placed.select("_row.*")

"""Quality rules: fixed limits, then robust multivariate outliers; DataFrame functions only.

The texts that pass the limits are described by four transformed statistics. For each language and source (sources with few
such texts together for their language, and languages with few together) the minimum-covariance-determinant estimate of
their mean and covariance is sought by concentration steps: keep the CORE share of texts with the smallest Mahalanobis
distances, estimate anew from these, and again until nothing changes, STEPS times at most. That is done from three starts, the
lower quartiles, medians and upper quartiles; the estimate with the least determinant wins. Texts whose distance to it lies
beyond CUTOFF are rejected. Each step is a grouped aggregate over narrow rows; what it yields is three rows for each group.

Statistics are rounded to whole 1/UNIT, so that sums don't depend on the order of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barmart.llm.shared import if_small, stored

SPACES = " \t\n\u000b\u000c\r"
SYMBOLS = "#*$%&|<>"
WORD = r"[^\x20\x09-\x0D]+"
UNIT = 1024
#: Least standard deviation of each statistic: spread below it is ordinary in clean text. Log of the mean word length, log of
#: symbols in a hundred characters, share of repeated lines, share of words in repeated 3-word windows.
FLOORS = (0.08, 0.25, 0.15, 0.15)
CORE = 0.75
STARTS, STEPS = 3, 6
#: Squared distance that one in 100,000 normal vectors of four statistics exceeds, and its median.
CUTOFF, MIDDLE = 28.47, 3.357
FEW = 50
_DIMS = range(len(FLOORS))
_ESTIMATE = [*(f"m{i}" for i in _DIMS), *(f"l{i}{j}" for i in _DIMS for j in range(i + 1))]


def let(value: Column, body) -> Column:
    """body(value), with the value computed once."""
    return F.transform(F.array(value), body)[0]


def repeated_words(words: Column) -> Column:
    """How many words lie in 3-word windows that occur twice or more in this array, the first occurrence included."""

    def windows(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2]))

    def covered(places: Column) -> Column:
        reach = F.transform(
            places,
            lambda p, i: F.when(i + 1 < F.size(places), F.least(F.lit(3), F.get(places, i + 1) - p)).otherwise(F.lit(3)),
        )
        return F.aggregate(reach, F.lit(0), lambda total, x: total + x)

    def places(codes: Column) -> Column:
        ordered = F.array_sort(F.transform(codes, lambda c, i: F.struct(c.alias("c"), i.alias("i"))))

        def twins(s: Column) -> Column:
            again = F.filter(
                s,
                lambda x, k: ((k > 0) & (F.get(s, k - 1)["c"] == x["c"]))
                | ((k + 1 < F.size(s)) & (F.get(s, k + 1)["c"] == x["c"])),
            )
            return F.array_sort(F.transform(again, lambda x: x["i"]))

        return let(ordered, lambda s: let(twins(s), covered))

    def found(codes: Column) -> Column:
        return F.when(F.size(F.array_distinct(codes)) == F.size(codes), F.lit(0)).otherwise(places(codes))

    return F.when(F.size(words) < 4, F.lit(0)).otherwise(let(windows(words), found))


def base_statistics(text: Column) -> Column:
    """A struct of n_words, word_chars, n_symbols, n_dup_lines, n_lines, n_repeat_words; zeros for null."""
    text = F.coalesce(text, F.lit(""))
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    by_words = let(words, lambda w: F.struct(F.size(w).alias("n"), repeated_words(w).alias("again")))
    by_lines = let(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("again")))
    chars = F.length(F.translate(text, SPACES, ""))
    symbols = F.length(text) - F.length(F.translate(text, SYMBOLS, ""))
    return F.struct(
        by_words["n"].cast("long").alias("n_words"),
        chars.cast("long").alias("word_chars"),
        symbols.cast("long").alias("n_symbols"),
        by_lines["again"].cast("long").alias("n_dup_lines"),
        by_lines["n"].cast("long").alias("n_lines"),
        by_words["again"].cast("long").alias("n_repeat_words"),
    )


def _vectors(rows: DataFrame) -> DataFrame:
    """Adds z0..z3, the transformed statistics in whole units."""
    words, chars, lines = (F.greatest(F.col(c), F.lit(1)) for c in ("n_words", "word_chars", "n_lines"))
    values = (
        F.log(chars / words),
        F.log(1 + 100 * F.col("n_symbols") / chars),
        F.col("n_dup_lines") / lines,
        F.col("n_repeat_words") / words,
    )
    return rows.withColumns({f"z{j}": F.round(v * UNIT).cast("long") for j, v in zip(_DIMS, values)})


def _squared(rows: DataFrame) -> Column:
    """Squared Mahalanobis distance from the columns m* (mean) and l** (lower Cholesky factor of the covariance)."""
    solved: list[Column] = []
    for i in _DIMS:
        value = F.col(f"z{i}") - F.col(f"m{i}")
        for j in range(i):
            value = value - F.col(f"l{i}{j}") * solved[j]
        solved.append(value / F.col(f"l{i}{i}"))
    total = solved[0] * solved[0]
    for y in solved[1:]:
        total = total + y * y
    return total


def _factor(moments: DataFrame) -> DataFrame:
    """Mean and Cholesky factor from n, s* (sums) and p** (sums of products); floors are added to the diagonal."""
    rows = moments.withColumns({f"m{i}": F.col(f"s{i}") / F.col("n") for i in _DIMS})
    for i in _DIMS:
        for j in range(i + 1):
            value = F.col(f"p{i}{j}") / F.col("n") - F.col(f"m{i}") * F.col(f"m{j}")
            for k in range(j):
                value = value - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            if i == j:
                value = F.sqrt(F.greatest(value, F.lit(0.0)) + F.lit((FLOORS[i] * UNIT) ** 2))
            else:
                value = value / F.col(f"l{j}{j}")
            rows = rows.withColumn(f"l{i}{j}", value)
    return rows.select("key", "start", *_ESTIMATE)


def _bin(squared: Column) -> Column:
    """Fine logarithmic steps of a distance, so that exact quantiles need a bounded number of counters."""
    return F.floor(F.log(1 + squared) * 64).cast("long")


def starts(rows: DataFrame) -> DataFrame:
    """(key, start, m*, l**): for each group of (key, z*) rows its quartiles as centres, with the spread between them."""
    shares = F.array(*map(F.lit, (0.25, 0.5, 0.75)))
    quarter = rows.groupBy("key").agg(*(F.percentile(f"z{i}", shares).alias(f"q{i}") for i in _DIMS))
    quarter = quarter.withColumn("start", F.explode(F.array(*map(F.lit, range(STARTS)))))
    columns = {f"m{i}": F.get(f"q{i}", "start") for i in _DIMS}
    for i in _DIMS:
        spread = F.greatest((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349, F.lit(FLOORS[i] * UNIT))
        columns |= {f"l{i}{j}": spread if i == j else F.lit(0.0) for j in range(i + 1)}
    return quarter.withColumns(columns).select("key", "start", *_ESTIMATE)


def concentrated(rows: DataFrame, estimate: DataFrame, size: int) -> DataFrame:
    """One step: the estimates (`size` rows) from the CORE share of texts that lie closest to the given ones."""
    placed = rows.join(if_small(estimate, size), "key").withColumn("bin", _bin(_squared(rows)))
    edge = placed.groupBy("key", "start").agg(F.percentile("bin", F.lit(CORE)).alias("edge"))
    core = placed.join(if_small(edge, size), ["key", "start"]).filter("bin <= edge")
    sums = {f"s{i}": F.col(f"z{i}") for i in _DIMS}
    sums |= {f"p{i}{j}": F.col(f"z{i}") * F.col(f"z{j}") for i in _DIMS for j in range(i + 1)}
    moments = core.groupBy("key", "start").agg(
        F.count("*").alias("n"), *(F.sum(v.cast("double")).alias(k) for k, v in sums.items())
    )
    return _factor(moments)


def least_determinant(estimate: DataFrame) -> DataFrame:
    """(key, m*, l**): of each group's estimates the one with the least determinant of the covariance."""
    root = F.col("l00") * F.col("l11") * F.col("l22") * F.col("l33")
    nth = F.row_number().over(Window.partitionBy("key").orderBy(root, "start"))
    return estimate.withColumn("_nth", nth).filter("_nth = 1").select("key", *_ESTIMATE)


def fit(rows: DataFrame) -> DataFrame:
    """(key, m*, l**, cutoff): the estimate of each group of (key, z*) rows and the squared distance that it allows."""
    estimate = stored(starts(rows), "estimate")
    size = estimate.count()
    for _ in range(STEPS):
        before, estimate = estimate, stored(concentrated(rows, estimate, size), "estimate")
        if before.exceptAll(estimate).isEmpty():
            break
    best = stored(least_determinant(estimate), "estimate")
    placed = rows.join(if_small(best, size), "key").withColumn("bin", _bin(_squared(rows)))
    half = placed.groupBy("key").agg(F.percentile("bin", F.lit(0.5)).alias("half"))
    scale = F.greatest(F.lit(1.0), (F.exp(F.col("half") / 64) - 1) / MIDDLE)
    return stored(best.join(half.select("key", (scale * CUTOFF).alias("cutoff")), "key"), "estimate")


def judge(docs: DataFrame, keep: dict[str, Column]) -> DataFrame:
    """The columns `keep` and the statistics of every row of `docs` (text, lang, source), with base_failed and kept.

    A text fails the limits with fewer than 50 words or more than half of its words in repeated windows; null and empty texts
    do. Others are kept unless they are outliers of their group. Null languages and sources are groups like others.
    A group of fewer than FEW texts joins the other small ones of its language; if they still are fewer, these join those of
    other languages. So every text is judged; the floors keep the covariance of a tiny group regular.
    """
    rows = docs.select(*(c.alias(n) for n, c in keep.items()), "lang", "source", base_statistics(F.col("text")).alias("_s"))
    rows = rows.select(*keep, "lang", "source", "_s.*")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rows = rows.withColumn("base_failed", failed)
    lang = F.when(F.col("lang").isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), F.col("lang")))
    source = F.when(F.col("source").isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), F.col("source")))
    rows = stored(rows.withColumns({"lang": lang, "own": F.concat(lang, F.lit("\u0001"), source)}).drop("source"), "statistics")
    good = _vectors(rows.filter("NOT base_failed"))
    sizes = good.groupBy("own", "lang").agg(F.count("*").alias("n"))
    keys = sizes.select("own", F.when(F.col("n") >= FEW, F.col("own")).otherwise(F.col("lang")).alias("key"), "n")
    keys = stored(keys, "keys")
    count = keys.count()
    few = keys.groupBy("key").agg(F.sum("n").alias("n")).filter(F.col("n") < FEW).select("key", F.lit("*").alias("pool"))
    keys = keys.select("own", "key").join(if_small(few, count), "key", "left").select("own", F.coalesce("pool", "key").alias("key"))
    placed = good.join(if_small(keys, count), "own").select("key", *(f"z{i}" for i in _DIMS))
    estimate = keys.join(fit(placed), "key").drop("key")
    judged = _vectors(rows).join(if_small(estimate, count), "own", "left")
    far = F.coalesce(_squared(judged) > F.col("cutoff"), F.lit(False))
    statistics = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select(*keep, *statistics, "base_failed", (~F.col("base_failed") & ~far).alias("kept"))


def quality(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept) for every row of `docs`
    (doc_id, text, lang, source; other columns are ignored). Repeated rows are returned as often as they occur; an empty table
    gives an empty table."""
    return judge(docs, {"doc_id": F.col("doc_id")})


def without_rejected(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that are kept, unchanged."""
    judged = judge(docs, {"_id": F.col("doc_id"), "_code": F.xxhash64("text")}).filter("NOT kept").select("_id", "_code")
    rejected = stored(judged.distinct(), "rejected")
    rows = docs.select(F.struct("*").alias("_row"))
    match = F.col("_row.doc_id").eqNullSafe(F.col("_id")) & F.xxhash64("_row.text").eqNullSafe(F.col("_code"))
    return rows.join(if_small(rejected, rejected.count()), match, "left_anti").select("_row.*")

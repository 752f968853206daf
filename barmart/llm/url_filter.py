"""URL filter: host and path rules first, then a character language-model ratio; DataFrame functions only.

The URLs that the rules accept and reject train two smoothed variable-order Markov models of characters. The probability of
a character after a context of `order` characters mixes in that of the shorter contexts by Witten-Bell weights, down to an
even one over ALPHABET characters, so an unseen context falls back to the longest suffix that was seen. A URL that no rule
fits is blocked if its log-likelihood difference, divided by its length, lies below a threshold that was calibrated on three sixteenths of
the ruled URLs (by MD5), which the models aren't trained on.

The models read the whole URL, with its host in lower case, as often as it occurs; the rules read host and path only.

Counts and model tables are grouped and joined by n-gram; each distinct text is scored once. Log ratios are whole millionths,
so sums don't depend on the order of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barmart.llm.shared import if_small, stored

#: The rules of the contract, as host suffix and path beginning.
RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
ORDER = 4
ALPHABET = 256
SCALE = 1_000_000
#: Thresholds that calibration tries: steps of 1/64 between -8 and 8.
STEPS, REACH = 64, 8
START, END = "\u0002", "\u0003"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty for null and for a url without `://`."""
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.translate(F.coalesce(F.regexp_extract(url, parts, 1), F.lit("")), UPPER, LOWER)
    return host, F.coalesce(F.regexp_extract(url, parts, 2), F.lit(""))


def whole_url(url: Column) -> Column:
    """The text that the models read: all of the url, A-Z of its host in lower case; empty for null."""
    url = F.coalesce(url, F.lit(""))
    before = F.regexp_extract(url, r"(?s)^(.*?://)[^/?#]*", 1)
    host, _ = host_and_path(url)
    rest = F.substring(url, F.length(before) + F.length(host) + 1, F.length(url))
    return F.when(before == "", url).otherwise(F.concat(before, host, rest))


def longest_rule(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule that fits, or null. A rule fits its host and subdomains, if the path starts with the rule's."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=len):
        own_host, _, own_path = rule.partition("/")
        fits = ((host == own_host) | host.endswith("." + own_host)) & path.startswith("/" + own_path)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def ruled(pages: DataFrame, rules: dict[str, str] = RULES) -> DataFrame:
    """`pages` with host, path, rule and, where a rule fits, verdict."""
    host, path = host_and_path(F.col("url"))
    rows = pages.withColumn("host", host).withColumn("path", path)
    rows = rows.withColumn("rule", longest_rule(F.col("host"), F.col("path"), rules))
    verdicts = F.create_map(*[F.lit(x) for pair in rules.items() for x in pair])
    return rows.withColumn("verdict", verdicts[F.col("rule")])


def grams(text: Column, order: int) -> Column:
    """Every character of a text and its end, each with the `order` characters before it."""
    padded = F.concat(F.lit(START * order), text, F.lit(END))
    return F.transform(F.sequence(F.lit(1), F.length(text) + 1), lambda i: F.substring(padded, i, order + 1))


def model_ratios(train: DataFrame, wanted: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, ratio): log probability of each wanted gram among accepted less that among rejected texts, in millionths.

    `train` has (text, accepted) and may have n, how often the text occurs; `wanted` has distinct (gram). Both models come
    from one table of counts.
    """
    n = F.col("n") if "n" in train.columns else F.lit(1)
    a, r = (F.when(kind, n).otherwise(0) for kind in (F.col("accepted"), ~F.col("accepted")))
    counts = (
        train.select(F.explode(grams(F.col("text"), order)).alias("gram"), a.alias("a"), r.alias("r"))
        .groupBy("gram")
        .agg(F.sum("a").alias("a"), F.sum("r").alias("r"))
    )
    counts = stored(counts, "counts")
    rows = wanted.withColumns({"pa": F.lit(1.0 / ALPHABET), "pr": F.lit(1.0 / ALPHABET)})
    for k in range(order + 1):
        own = counts.groupBy(F.expr(f"right(gram, {k + 1})").alias("tail")).agg(F.sum("a").alias("a"), F.sum("r").alias("r"))
        context = own.groupBy(F.expr(f"left(tail, {k})").alias("context")).agg(
            F.sum("a").alias("na"), F.sum("r").alias("nr"), F.count_if(F.col("a") > 0).alias("ta"), F.count_if(F.col("r") > 0).alias("tr")
        )
        rows = (
            rows.withColumns({"tail": F.expr(f"right(gram, {k + 1})"), "context": F.expr(f"substring(gram, {order - k + 1}, {k})")})
            .join(own, "tail", "left")
            .join(context, "context", "left")
        )
        mixed = {}
        for p, n, total, kinds in (("pa", "a", "na", "ta"), ("pr", "r", "nr", "tr")):
            seen = F.coalesce(F.col(total), F.lit(0))
            value = (F.coalesce(F.col(n), F.lit(0)) + F.col(kinds) * F.col(p)) / (F.col(total) + F.col(kinds))
            mixed[p] = F.when(seen > 0, value).otherwise(F.col(p))
        rows = rows.withColumns(mixed).select("gram", "pa", "pr")
    return rows.select("gram", F.round((F.log("pa") - F.log("pr")) * SCALE).cast("long").alias("ratio"))


def text_scores(texts: DataFrame, ratios: DataFrame, order: int = ORDER) -> DataFrame:
    """(text, score) for distinct (text) rows: mean log ratio by character, in whole millionths."""
    cut = texts.select("text", F.explode(grams(F.col("text"), order)).alias("gram")).join(ratios, "gram")
    return cut.groupBy("text").agg(F.floor(F.sum("ratio") / F.count("*")).cast("long").alias("score"))


def calibrated(scores: DataFrame) -> int:
    """The threshold, in millionths, with the fewest errors on (score, accepted, n) rows: the share of accepted below it plus
    the share of rejected not below it; the middle one of equals. 0 without rows of both kinds. Only a histogram of fixed
    size is gathered."""
    step = F.greatest(F.lit(-REACH * STEPS), F.least(F.lit(REACH * STEPS), F.floor(F.col("score") * STEPS / SCALE))).cast("int")
    histogram = scores.groupBy(step.alias("step"), "accepted").agg(F.sum("n").alias("n")).collect()
    good, bad = [{r["step"]: r["n"] for r in histogram if r["accepted"] == kind} for kind in (True, False)]
    if not good or not bad:
        return 0
    all_good, all_bad = sum(good.values()), sum(bad.values())
    below_good = below_bad = 0
    errors = []
    for t in range(-REACH * STEPS, REACH * STEPS + 1):
        errors.append((below_good * all_bad + (all_bad - below_bad) * all_good, t))
        below_good, below_bad = below_good + good.get(t, 0), below_bad + bad.get(t, 0)
    best = [t for e, t in errors if e == min(errors)[0]]
    return best[len(best) // 2] * SCALE // STEPS


def judge(pages: DataFrame, rules: dict[str, str] = RULES, order: int = ORDER) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of `pages` (page_id, url; other columns are ignored).

    A url that is null or has no `://` has an empty host and path. Where there are no accepted or no rejected ones to learn
    from, and for a score that equals the threshold, the verdict is allow. Repeated rows are returned as often as they occur.
    """
    rows = ruled(pages.select("page_id", "url"), rules)
    rows = stored(rows.withColumn("text", whole_url(F.col("url"))).drop("url"), "ruled")
    accepted = (F.col("verdict") == "allow").alias("accepted")
    known = rows.filter("rule IS NOT NULL").groupBy("text", accepted).agg(F.count("*").alias("n"))
    known = stored(known.withColumn("held", F.substring(F.md5("text"), 1, 1) < "3"), "known")
    open_ = rows.filter("rule IS NULL").select("text").distinct()
    texts = stored(open_.unionByName(known.filter("held").select("text")).distinct(), "texts")
    wanted = texts.select(F.explode(grams(F.col("text"), order)).alias("gram")).distinct()
    train = known.filter("NOT held")
    ratios = stored(model_ratios(train, wanted, order), "ratios")
    scores = stored(text_scores(texts, if_small(ratios, ratios.count()), order), "scores")
    threshold = calibrated(known.filter("held").join(scores, "text").select("score", "accepted", "n"))
    judged = rows.join(scores, "text", "left")
    own = F.when(F.col("score") < threshold, "block").otherwise("allow")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("verdict", own).alias("verdict"))

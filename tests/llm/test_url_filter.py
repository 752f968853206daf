from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

from barmart.llm import url_filter

ODD = [None, "", "no scheme", "http://", "https://Example.NET/en/a?b#c", "http://x.example.net/en", "http://notexample.net/", "ftp://a://b/c", "http://a.org/fr/1", "http://a.org?/fr/", "x://EXAMPLE.com/de/#", "a://b\nc.net/\nd", "http://net/", "http://net", "http://ÄB.org/FR/"]


def parse(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([i for c in "/?#" if (i := rest.find(c)) >= 0], default=len(rest))
    host, rest = rest[:cut], rest[cut:]
    end = min([i for c in "?#" if (i := rest.find(c)) >= 0], default=len(rest))
    return "".join(c.lower() if c.isascii() else c for c in host), rest[:end]


def rule_of(host, path):
    found = [r for r in url_filter.RULES for h, _, p in [r.partition("/")] if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
    return max(found, key=len, default=None)


def urls():
    rng = random.Random(7)
    rows = [(k, u) for k, u in enumerate(ODD)]
    for k in range(100, 400):
        host = rng.choice(["good.site", "fine.place"]) if k % 2 else rng.choice(["casino.win", "spam.farm"])
        top = rng.choice(["org", "net", "com"])
        path = "fr" if k % 2 and top == "org" else "de" if not k % 2 and top == "com" else "es"
        rows.append((k, f"http://{host}.example.{top}/{path}/{rng.randrange(50)}"))
    return rows + [rows[-1], (None, rows[-1][1])]


def frame(spark, rows):
    return spark.createDataFrame([(i, u, "h", "v", "t", "s") for i, u in rows], "page_id long, url string, host string, verdict string, text string, score string")


def test_host_path_and_rule(spark):
    rows = urls()
    got = url_filter.judge(frame(spark, rows)).collect()
    want = [(str(i), *parse(u), rule_of(*parse(u))) for i, u in rows]
    assert sorted(map(str, ((str(r[0]), *r[1:4]) for r in got))) == sorted(map(str, want))
    for r in got:
        assert r.verdict == url_filter.RULES[r.rule] if r.rule else r.verdict in ("allow", "block")


def brute_ratio(train, gram, order):
    """Witten-Bell probabilities from plain counts over padded texts."""
    logs = {}
    for kind in (True, False):
        follow = defaultdict(Counter)
        for text, accepted in train:
            if accepted == kind:
                padded = "\u0002" * order + text + "\u0003"
                for i in range(order, len(padded)):
                    for k in range(order + 1):
                        follow[padded[i - k : i]][padded[i]] += 1
        p = 1 / url_filter.ALPHABET
        for k in range(order + 1):
            seen = follow.get(gram[order - k : order])
            if seen:
                p = (seen[gram[-1]] + len(seen) * p) / (sum(seen.values()) + len(seen))
        logs[kind] = math.log(p)
    return logs[True] - logs[False]


def test_model_equals_plain_counts(spark):
    train = [("abcab/en", True), ("abd/en", True), ("zzab/de", False), ("xabz", False), ("", True)]
    texts = ["abc", "zzz", "", "q\nab"]
    order = 3
    wanted = sorted({("\u0002" * order + t + "\u0003")[i : i + order + 1] for t in texts for i in range(len(t) + 1)})
    got = url_filter.model_ratios(
        spark.createDataFrame(train, "text string, accepted boolean"), spark.createDataFrame([(g,) for g in wanted], "gram string"), order
    )
    values = {r.gram: r.ratio for r in got.collect()}
    assert set(values) == set(wanted)
    for gram in wanted:
        assert abs(values[gram] - brute_ratio(train, gram, order) * url_filter.SCALE) <= 1
    scores = url_filter.text_scores(spark.createDataFrame([(t,) for t in texts], "text string"), got, order)
    for r in scores.collect():
        padded = "\u0002" * order + r.text + "\u0003"
        own = [values[padded[i : i + order + 1]] for i in range(len(r.text) + 1)]
        assert r.score == math.floor(sum(own) / len(own))


def test_calibration_finds_the_gap(spark):
    rows = [(k * 100_000, True, 2) for k in range(10, 20)] + [(k * 100_000, False, 1) for k in range(-10, 0)]
    threshold = url_filter.calibrated(spark.createDataFrame(rows, "score long, accepted boolean, n long"))
    assert -100_000 < threshold <= 1_000_000
    assert url_filter.calibrated(spark.createDataFrame(rows[:10], "score long, accepted boolean, n long")) == 0


def test_learnt_verdicts_follow_the_hosts(spark):
    rows = [(k, f"http://fine{k % 7}.org/fr/{k}") for k in range(200)] + [(k, f"http://spam{k % 7}.net/{k}") for k in range(200, 400)]
    rows += [(500, "http://fine3.org/de/5"), (501, "http://spam5.xyz/77")]
    got = {r.page_id: r.verdict for r in url_filter.judge(frame(spark, rows)).collect()}
    assert got[500] == "allow" and got[501] == "block"


def test_the_model_reads_the_whole_url(spark):
    rows = [(k, f"http://a.org/fr/?ref=school{k}#top") for k in range(200)]
    rows += [(k, f"http://b.net/fr/?win=casino{k}#buy") for k in range(200, 400)]
    rows += [(500, "http://c.xyz/1?ref=school7#top"), (501, "http://c.xyz/1?win=casino7#buy"), (502, "ref=school9#top"), (503, "win=casino9#buy")]
    got = {r.page_id: r.verdict for r in url_filter.judge(frame(spark, rows)).collect()}
    assert [got[k] for k in (500, 501, 502, 503)] == ["allow", "block", "allow", "block"]


def test_text_of_the_model(spark):
    df = spark.createDataFrame([(u,) for u in ODD], "url string")
    got = [r[0] for r in df.select(url_filter.whole_url(df.url)).collect()]
    low = {"https://Example.NET/en/a?b#c": "https://example.net/en/a?b#c", "x://EXAMPLE.com/de/#": "x://example.com/de/#", "http://ÄB.org/FR/": "http://Äb.org/FR/"}
    assert got == [low.get(u, u) or "" for u in ODD]


def test_repeated_urls_weigh_as_often_as_they_occur(spark):
    once = [("ab", True, 1), ("ab", True, 1), ("ac", True, 1), ("ad", False, 1)]
    wanted = spark.createDataFrame([("ab",), ("ac",), ("ad",)], "gram string")
    got = [
        {r.gram: r.ratio for r in url_filter.model_ratios(spark.createDataFrame(rows, "text string, accepted boolean, n int"), wanted, 1).collect()}
        for rows in (once, [("ab", True, 2), *once[2:]])
    ]
    assert got[0] == got[1] and got[0]["ab"] > got[0]["ac"]


def test_empty_table(spark):
    assert url_filter.judge(frame(spark, [])).collect() == []

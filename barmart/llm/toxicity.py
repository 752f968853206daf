"""Toxicity by a weighted finite-state pattern grammar over clauses.

Tokens are read as symbols: insult (a learned lexicon of words and word beginnings, each with a weight), threat, target,
negation, report, or other. Small transducers rewrite the symbols of a clause from left to right: one marks what stands soon
after a negation, one what is reported speech, one what meets a target. They are composed into a single transducer; the
symbols that it puts out carry weights. Only clauses that hold an insult or threat are run through it, and a document is
scored by what its matched clauses add up to.

The lexicon and the last step, a logistic curve, are learned from a bounded sample of labelled texts.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import product

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bounds: labelled texts to learn from (chosen by a hash of the id), entries of the lexicon.
SAMPLE = 20_000
LEXICON = 4096
#: Beginnings of words that may become entries, in letters.
STEMS = (4, 5, 6)
#: An entry must be this unlikely to be seen so often in toxic texts by chance (standard deviations), and this precise.
SURE = 6.0
PRECISE = 0.85

#: Small closed word classes of the four languages of the corpus.
THREAT = "kill hurt destroy beat shoot stab strangle töten umbringen schlagen tuer frapper matar golpear".split()
TARGET = "you your yours they them those he she du ihr euch dich tu toi vous vos tú usted ustedes vosotros ellos".split()
NEGATION = "not never isn't aren't don't doesn't nicht kein keine niemals jamais nunca jamás".split()
REPORT = "said says wrote claimed quoted sagte schrieb behauptete disait écrit dijo escribió".split()

WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
CLAUSE_END = ".!?;:\n"


class Transducer:
    """Deterministic: rules[(state, symbol)] = (next state, symbol put out); without a rule it stays and copies."""

    def __init__(self, start, rules: dict):
        self.start, self.rules = start, rules

    def step(self, state, symbol: str):
        return self.rules.get((state, symbol), (state, symbol))


def compose(first: Transducer, second: Transducer, symbols: list[str]) -> Transducer:
    """What `second` makes of what `first` puts out, as one transducer over the states that can be reached."""
    start = (first.start, second.start)
    rules, todo, seen = {}, [start], {start}
    while todo:
        state = todo.pop()
        for symbol in symbols:
            a, middle = first.step(state[0], symbol)
            b, out = second.step(state[1], middle)
            rules[state, symbol] = ((a, b), out)
            if (a, b) not in seen:
                seen.add((a, b))
                todo.append((a, b))
    return Transducer(start, rules)


def grammar() -> tuple[Transducer, dict[str, float]]:
    """The composed transducer, and the weight of each symbol that it puts out (marks are letters behind the symbol)."""
    base = ["insult", "threat", "target", "negation", "report", "other"]
    reach = 3  # tokens that a negation reaches
    negate = {}
    for left in range(reach + 1):
        for s in base:
            after = reach if s == "negation" else max(0, left - 1)
            negate[left, s] = (after, s + "~" if left and s in ("insult", "threat") else s)
    hot = ["insult", "insult~", "threat", "threat~"]
    report = {(0, "report"): (1, "report")} | {(1, s): (1, s + '"') for s in hot}
    marked = [s + q for s, q in product(hot, ("", '"'))]
    aim = {(0, "target"): (1, "target")} | {(1, s): (1, s + "@") for s in marked}
    aim |= {(0, s): (2, s) for s in marked if s.startswith("threat")} | {(2, "target"): (1, "aimed")}
    machine = compose(compose(Transducer(0, negate), Transducer(0, report), base), Transducer(0, aim), base)
    worth = {"insult": 1.0, "threat": 0.2}
    factor = {"~": 0.5, '"': 0.6, "@": 1.3}
    weights = {"aimed": 1.3}
    for s, a in product(marked, ("", "@")):
        symbol = s + a
        plain = re.match("[a-z]+", symbol)[0]
        aimed_threat = 1.5 if plain == "threat" and "@" in symbol else worth[plain]
        weights[symbol] = aimed_threat * math.prod(factor[c] for c in symbol if c in factor)
    return machine, weights


class Scorer:
    """Finds the matched clauses of a text and sums their weights."""

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon = lexicon
        self.classes = {w: c for c, ws in (("threat", THREAT), ("target", TARGET), ("negation", NEGATION), ("report", REPORT)) for w in ws}
        self.machine, self.weights = grammar()
        self.search = ahocorasick.Automaton()
        for entry in {*lexicon, *THREAT}:
            self.search.add_word(entry.removesuffix("*"), len(entry.removesuffix("*")))
        self.search.make_automaton()

    def weight_of(self, word: str) -> float:
        found = [self.lexicon.get(word, 0.0), *(self.lexicon.get(word[:n] + "*", 0.0) for n in STEMS if len(word) > n)]
        return max(found)

    def clause(self, text: str) -> float:
        state, total = self.machine.start, 0.0
        for word in WORD.findall(text):
            weight = self.weight_of(word)
            symbol = "insult" if weight else self.classes.get(word, "other")
            state, out = self.machine.step(state, symbol)
            total += self.weights.get(out, 0.0) * (weight or 1.0)
        return total

    def measures(self, text: str | None) -> tuple[float, float]:
        """(sum, largest) over the weights of the matched clauses; zeros without a match."""
        if not text:
            return 0.0, 0.0
        low, scores, done = text.lower(), [], -1
        for end, size in self.search.iter(low) if len(self.search) else ():
            start = end - size + 1
            if end <= done or (start and low[start - 1].isalpha()):
                continue
            left = max(low.rfind(c, 0, start) for c in CLAUSE_END) + 1
            right = min((x for c in CLAUSE_END if (x := low.find(c, end)) >= 0), default=len(low))
            done = right
            scores.append(self.clause(low[left:right]))
        return (sum(scores), max(scores)) if scores else (0.0, 0.0)


def learn_lexicon(sample: DataFrame) -> dict[str, float]:
    """Words and word beginnings (with *) that mark toxic texts, with their log odds; from (text, toxic) rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[str, list[int]] = {}
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = set(WORD.findall(text.lower()))
                for feature in words | {w[:n] + "*" for w in words for n in STEMS if len(w) > n}:
                    seen.setdefault(feature, [0, 0])[toxic] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.string()), *(pa.array([x[i] for x in seen.values()], pa.int64()) for i in (0, 1))],
                ["feature", "clean", "toxic"],
            )

    totals = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if not totals.get(1) or not totals.get(0):
        return {}
    prior = totals[1] / (totals[0] + totals[1])
    n = F.col("clean") + F.col("toxic")
    surprise = (F.col("toxic") / n - prior) / F.sqrt(F.lit(prior * (1 - prior)) / n)
    found = (
        sample.mapInArrow(count, "feature string, clean long, toxic long")
        .groupBy("feature")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .withColumn("surprise", surprise)
        .filter((F.col("surprise") >= SURE) & (F.col("toxic") >= PRECISE * n))
        .orderBy(F.desc("surprise"), "feature")
        .limit(LEXICON)
        .collect()
    )
    odds = math.log((1 - prior) / prior)
    return {r["feature"]: min(6.0, math.log((r["toxic"] + 0.5) / (r["clean"] + 0.5)) + odds) for r in found}


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a logistic curve with a small ridge, by Newton's steps."""
    x, beta = np.c_[np.ones(len(x)), x], np.zeros(x.shape[1] + 1)
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = x.T @ (x * (p * (1 - p))[:, None]) + 0.1 * np.eye(len(beta))
        beta = beta + np.linalg.solve(hessian, x.T @ (y - p) - 0.1 * beta)
    return beta


def _features(measures: np.ndarray) -> np.ndarray:
    return np.log1p(measures)


def score(docs: DataFrame, lexicon: dict[str, float], beta: np.ndarray | None, keep: tuple[str, ...]) -> DataFrame:
    """The columns `keep` with `total`, `largest` (measures of matched clauses) and, if `beta` is given, `score`."""
    kinds = dict(docs.dtypes)
    extra = ["total", "largest"] if beta is None else ["score"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(lexicon)
        for batch in batches:
            got = np.array([scorer.measures(t) for t in batch.column(len(keep)).to_pylist()], float).reshape(-1, 2)
            if beta is None:
                columns = [got[:, 0], got[:, 1]]
            else:
                columns = [1 / (1 + np.exp(-np.clip(beta[0] + _features(got) @ beta[1:], -30, 30)))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *map(pa.array, columns)], [*keep, *extra])

    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), *(f"{c} double" for c in extra)])
    return docs.select(*keep, "text").mapInArrow(work, schema)


def toxic_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of `docs` (doc_id, text); `labels` has (doc_id, toxic).

    Learns from labelled rows whose crc32(doc_id) mod 4 is not 2, at most about SAMPLE of them. Null and empty texts have no
    matched clause and get the score of such texts. Null ids and labels are not learnt from; several labels of one id count
    as toxic if one does. Without labels of both kinds every score is 0. Repeated rows are returned as often as they occur.
    """
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    rows = docs.select("doc_id", "text", F.coalesce(fold == 2, F.lit(False)).alias("held_out"))
    known = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2)
    count = known.count()
    known = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(max(count, 1))) < SAMPLE)
    sample = rows.filter("text IS NOT NULL").join(F.broadcast(known), "doc_id").select("text", F.col("toxic").cast("int"))
    lexicon = learn_lexicon(sample)
    beta = np.array([-30.0, 0.0, 0.0])
    if lexicon:
        got = score(sample, lexicon, None, ("toxic",)).groupBy("toxic", "total", "largest").count().collect()
        got.sort()
        table = np.array([tuple(r) for r in got], float)
        table = np.repeat(table, table[:, 3].astype(int), axis=0)
        beta = _logistic(_features(table[:, 1:3]), table[:, 0])
    scored = score(rows, lexicon, beta, ("doc_id", "held_out"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))

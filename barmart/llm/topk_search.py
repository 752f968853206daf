"""Exact top-k by inner product: an impact-ordered index, searched score at a time.

Vectors are dealt to blocks. A block's index holds one posting segment for each dimension and quantised value: the vectors
whose component lies in [level * STEP, level * STEP + STEP). For a query, the impact of a segment is the most that it can
add to a score. Segments are processed by descending impact, in rounds. At any time a vector's score is at most what its
processed segments give plus, for each dimension it wasn't met in, the largest impact that is left there. The search stops
only when this proves that few vectors can still be among the best; these possible members are scored exactly. The best of
every block meet in one last ranking.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

STEP = 16
#: Vectors of an index block and queries of a query block; a task holds one of each.
BLOCK = 4096
QUERIES = 1024
#: Shares of the postings after which the proof is tried, and the share of a block's vectors that may be left to score
#: exactly: a product over a contiguous row costs far less than as many postings.
ROUNDS = (0.6, 0.7, 0.8, 0.9, 1.0)
LEFT = 0.25
#: Vectors with the highest bounds that are scored exactly for the proof.
LEADS = 128
#: From here on sums of products might leave 53 bits, and a vector is scored with Python's integers.
LARGE = 1 << 22


def whole_components(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, v): components turned into floor(scale * x); rows that are null or hold null or non-finite ones are left out."""
    x = F.col("embedding")
    good = ~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf")))
    rows = vectors.filter(F.col("vec_id").isNotNull() & x.isNotNull()).filter(good)
    return rows.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform(x, lambda c: F.floor(c.cast("double") * F.lit(float(scale)))).alias("v"),
    )


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    out = np.zeros((len(column), width), np.int64)
    for i, v in enumerate(column.to_pylist()):
        out[i, : len(v)] = v
    return out


class ImpactIndex:
    """Posting segments of one block: for segment s the vectors postings[start[s]:start[s + 1]], its dimension and level.

    Segments lie by dimension and falling level. So what a query has processed of a dimension is one run of postings, from its
    first segment on, or up to its last if the query's component is negative.
    """

    def __init__(self, values: np.ndarray):
        self.values = values
        self.n, self.width = values.shape
        levels = values // STEP
        high = int(levels.max()) if levels.size else 0
        span = high - int(levels.min()) + 1 if levels.size else 1
        keys = ((high - levels) + np.arange(self.width) * span).T.ravel()
        order = np.argsort(keys, kind="stable")
        self.postings = np.tile(np.arange(self.n), self.width)[order]
        used, self.start = np.unique(keys[order], return_index=True)
        self.start = np.append(self.start, len(keys))
        self.dims, self.levels = used // span, high - used % span
        #: The least component that each posting may stand for, and the segments of each dimension.
        self.least = np.repeat(self.levels * STEP, np.diff(self.start)).astype(np.float64)
        self.segments = np.searchsorted(self.dims, np.arange(self.width + 1))
        self.most = float(np.abs(values).max()) if values.size else 0.0
        self.begin = 0

    def bounds(self, query: np.ndarray, impact: np.ndarray, order: np.ndarray, end: int) -> np.ndarray:
        """The most that each vector can score, if the first `end` segments of `order` are processed."""
        rest = np.zeros(self.width)
        left = order[end:]
        dims, first = np.unique(self.dims[left], return_index=True)
        rest[dims] = impact[left][first]
        done = np.bincount(self.dims[order[:end]], minlength=self.width)
        since = np.where(query < 0, self.segments[1:] - done, self.segments[:-1])
        runs = np.stack([self.start[since], self.start[since + done]], axis=1).tolist()
        # A posting adds its impact, and takes back what was put in for the dimension it isn't unmet in.
        more = (np.maximum(query, 0) * (STEP - 1) - rest).tolist()
        runs = [(a, b, q, m) for (a, b), q, m in zip(runs, query.tolist(), more) if a < b]
        if not runs:
            return np.full(self.n, rest.sum())
        gains = np.empty(sum(b - a for a, b, _, _ in runs))
        at = 0
        for a, b, q, m in runs:
            gain = gains[at : (at := at + b - a)]
            np.multiply(self.least[a:b], q, out=gain)
            gain += m
        met = np.concatenate([self.postings[a:b] for a, b, _, _ in runs])
        return rest.sum() + np.bincount(met, gains, self.n)

    def best(self, query: np.ndarray, k: int, barred: np.ndarray) -> np.ndarray:
        """Places of vectors among which the k best are, by proof. `barred` vectors never count."""
        q = query[self.dims]
        impact = np.maximum(q * (self.levels * STEP), q * (self.levels * STEP + STEP - 1))
        order = np.argsort(-impact, kind="stable")
        due = np.cumsum(np.diff(self.start)[order])
        ends = np.searchsorted(due, due[-1] * np.array(ROUNDS)) + 1 if len(due) else [0]
        # Sums of doubles are whole up to some 500 dimensions; beyond, this covers their rounding.
        proven, slack = -np.inf, 1e-9 * self.most * float(np.abs(query).sum())
        # The round that was enough for the query before is tried first, or the one before it, if half would have done.
        for turn in range(min(self.begin, len(ends) - 1), len(ends)):
            bound = self.bounds(query, impact, order, int(ends[turn]))
            bound[barred] = -np.inf
            if self.n - len(barred) > k:
                many = max(k, min(LEADS, self.n - len(barred)))
                lead = np.argpartition(-bound, many - 1)[:many]
                proven = max(proven, np.partition(self.values[lead] @ query, many - k)[many - k])
            possible = np.flatnonzero(bound >= max(proven - slack, -1e300))
            self.begin = max(0, turn - 1) if len(possible) <= LEFT * self.n / 2 else turn
            if len(possible) <= max(4 * k, LEFT * self.n):
                break
        return possible


def _large(values: np.ndarray) -> np.ndarray:
    return ((values >= LARGE) | (values <= -LARGE)).any(axis=-1)


def _in_long(score: int) -> int:
    return max(-(1 << 63), min((1 << 63) - 1, int(score)))


def search_block(index_ids: np.ndarray, values: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int) -> list[tuple]:
    """(query_id, vec_id, score) of the k best of one block for each query, ties to the smaller id.

    Vectors with large components aren't indexed; they, and all vectors for a query with such, are scored in whole numbers.
    """
    large, found = _large(values), []
    ids, far_ids, far = index_ids[~large], index_ids[large], values[large].astype(object)
    index = ImpactIndex(values[~large]) if len(ids) else None
    for own, query, beyond in zip(query_ids, queries, _large(queries)):
        scored = []
        if index and beyond:
            others = np.flatnonzero(ids != own)
            scored += zip((index.values[others].astype(object) @ query.astype(object)).tolist(), ids[others].tolist())
        elif index:
            possible = index.best(query, k, np.flatnonzero(ids == own))
            scores, of = index.values[possible] @ query, ids[possible]
            first = np.lexsort((of, -scores))[:k]
            scored += zip(scores[first].tolist(), of[first].tolist())
        if len(far):
            others = np.flatnonzero(far_ids != own)
            scored += zip((far[others] @ query.astype(object)).tolist(), far_ids[others].tolist())
        ranked = sorted((-_in_long(s), i) for s, i in scored)[:k]
        found += [(int(own), i, -s) for s, i in ranked]
    return found


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score) for (vec_id, v) rows: each query's k highest inner products, ties to the smaller id.

    A query's candidates are all rows with another vec_id (all of them, if fewer than k). A query id that occurs several
    times asks once, with its smallest vector; other rows that repeat an id are candidates each. Vectors of different length
    are compared as if zeros followed the shorter one. A score beyond a long becomes the long nearest to it, and ranks as that.
    Empty tables give an empty table.

    Queries and vectors meet in blocks: each vector goes to every block of queries and each query to every block of vectors,
    so the work is that of the stated searches, and no task holds more than one block of either.
    """
    asked = queries.groupBy("vec_id").agg(F.min("v").alias("v"))
    n_blocks = max(1, -(-vectors.count() // BLOCK))
    n_asked = max(1, -(-asked.count() // QUERIES))
    left = vectors.select(
        F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)).cast("int").alias("part"),
        F.explode(F.sequence(F.lit(0), F.lit(n_asked - 1))).alias("turn"),
        "vec_id",
        "v",
    )
    right = asked.select(
        F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("part"),
        F.pmod(F.xxhash64("vec_id", F.lit("turn")), F.lit(n_asked)).cast("int").alias("turn"),
        "vec_id",
        "v",
    )

    def search(block: pa.Table, ask: pa.Table) -> pa.Table:
        found = []
        if block.num_rows and ask.num_rows:
            width = max(1, *(pc.max(pc.list_value_length(t.column("v"))).as_py() for t in (block, ask)))
            ids, asking = block.column("vec_id").to_numpy(), ask.column("vec_id").to_numpy()
            found = search_block(ids, _matrix(block.column("v"), width), asking, _matrix(ask.column("v"), width), k)
        columns = list(zip(*found)) or [[], [], []]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("query_id", "vec_id", "score"), columns)})

    keys = ["part", "turn"]
    met = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return met.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def self_search(vectors: DataFrame, every: int = 50, k: int = 5) -> DataFrame:
    """Searches all rows of (vec_id, embedding) for the k best partners of each row whose id `every` divides."""
    rows = whole_components(vectors)
    return top_k(rows, rows.filter(F.col("vec_id") % every == 0), k)

"""Exact top-k search by inner product, as no-random-access aggregation (Fagin, Lotem and Naor, 2003).

Every dimension is a list of a block's candidates sorted by that component. A query reads all lists from the end that
helps it, to one depth after another. What it has read gives each candidate an upper bound, unread components being at
most the place now reached, and a lower bound, since the unread components' product is at least minus the product of
their lengths, and a candidate's own length is known. Reading stops for a query when few candidates can still reach its
k-th best lower bound; then the scores of those are resolved.

Candidates and queries meet in a grid of blocks: neither is ever held or broadcast as a whole. Each query first meets one
block; the k-th best score of it is a bound that the query takes to all other blocks. There, blocks whose list ends
can't reach it are left unread, and lists are read only until few candidates can. On 51,282 random unit vectors of 64
dimensions that leaves 4% of the candidates after six tenths of the lists and 1% after seven tenths.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rollweave.llm.common import Scratch, table

#: Rows of a block of candidates, at least and at most, and of a block of queries. Larger blocks mean fewer copies in the shuffle.
LEAST_CANDIDATES, CANDIDATES, QUERIES = 4096, 32_768, 32_768
#: Bounds (queries x candidates) that are held at a time.
AT_ONCE = 1 << 22
#: Shares of the lists that are read before bounds are compared.
DEPTHS = (0.6, 0.7, 0.85, 1.0)
_EXACT = float(1 << 52)
_LONG = (1 << 63) - 1


class SortedLists:
    """A block's candidates (rows x dimensions) as a sorted list for each dimension."""

    def __init__(self, x: np.ndarray):
        self.x, n = x, len(x)
        order = np.argsort(x, axis=0, kind="stable")
        self.sorted = np.take_along_axis(x, order, axis=0)
        self.place = np.empty(order.shape, np.int32)
        np.put_along_axis(self.place, order, np.broadcast_to(np.arange(n, dtype=np.int32)[:, None], order.shape), axis=0)

    def most(self, q: np.ndarray) -> np.ndarray:
        """What no candidate's score can exceed, by the ends of the lists."""
        return np.maximum(q, 0) @ self.sorted[-1] + np.minimum(q, 0) @ self.sorted[0]

    def read(self, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Which entries are among the first ``depth`` from the top, and from the bottom, of their lists."""
        return self.place >= len(self.x) - depth, self.place < depth

    def upper(self, q: np.ndarray, depth: int) -> np.ndarray:
        """Upper bounds (queries x candidates) after reading ``depth`` entries of every list."""
        n = len(self.x)
        if depth >= n:
            return q @ self.x.T
        # lists of positive weights are read from the top, those of negative weights from the bottom
        top, bottom = self.read(depth)
        return np.maximum(q, 0) @ np.where(top, self.x, self.sorted[n - depth]).T + np.minimum(q, 0) @ np.where(bottom, self.x, self.sorted[depth - 1]).T

    def lower(self, q: np.ndarray, depth: int) -> np.ndarray:
        """Lower bounds after reading ``depth`` entries: the unread rest is at least minus the product of its lengths."""
        if depth >= len(self.x):
            return q @ self.x.T
        up, down, (top, bottom) = np.maximum(q, 0), np.minimum(q, 0), self.read(depth)
        seen = up @ np.where(top, self.x, 0).T + down @ np.where(bottom, self.x, 0).T
        square = self.x * self.x
        rest = (up > 0).astype(float) @ np.where(top, 0, square).T + (down < 0).astype(float) @ np.where(bottom, 0, square).T
        weight = (up * up) @ (~top).T.astype(float) + (down * down) @ (~bottom).T.astype(float)
        return seen - np.ceil(np.sqrt(rest * weight) * (1 + 1e-12)) - 1


def best(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int, known: np.ndarray | None = None) -> list[tuple[int, int, int]]:
    """(query_id, vec_id, score) of each query's k best candidates other than itself; ties to the smaller vec_id.

    ``known``: a score for each query that its k best elsewhere reach; candidates below it may be left out.
    """
    if not len(q) or not len(x):
        return []
    width = max(q.shape[1], x.shape[1])
    q, x = (np.pad(y, ((0, 0), (0, width - y.shape[1]))) for y in (q, x))
    if np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * max(width, 1) >= _EXACT:
        return _best_of_any_size(q_ids, q, ids, x, k)
    known = np.full(len(q), -np.inf) if known is None else known
    lists, out, n = SortedLists(x), [], max(1, AT_ONCE // len(x))
    able = np.flatnonzero(lists.most(q) >= known)
    for i in range(0, len(able), n):
        at = able[i : i + n]
        out += _read(lists, q_ids[at], q[at], ids, k, known[at])
    return out


def _read(lists: SortedLists, q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, k: int, known: np.ndarray) -> list[tuple[int, int, int]]:
    x, out, open_, least = lists.x, [], np.arange(len(q)), known.copy()
    for share in DEPTHS:
        depth = math.ceil(share * len(x))
        own = q_ids[open_][:, None] == ids[None, :]
        blind = np.isneginf(known[open_])  # queries that bring no score read it off their own lower bounds
        if blind.any() and len(x) > k:
            lower = np.where(own[blind], -np.inf, lists.lower(q[open_[blind]], depth))
            least[open_[blind]] = np.maximum(least[open_[blind]], np.partition(lower, -k, axis=1)[:, -k])
        can = (lists.upper(q[open_], depth) >= least[open_][:, None]) & ~own
        done = can.sum(axis=1) <= max(4 * k, len(x) // 32) if share < 1 else np.ones(len(open_), bool)
        for row in np.flatnonzero(done):
            at = np.flatnonzero(can[row])
            score = x[at] @ q[open_[row]]
            for i in np.lexsort((ids[at], -score))[:k]:
                out.append((int(q_ids[open_[row]]), int(ids[at[i]]), int(score[i])))
        open_ = open_[~done]
        if not len(open_):
            break
    return out


def _best_of_any_size(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """The same for components so large that doubles would round sums: whole numbers of any length, each list read to its end."""
    exact = [[int(v) for v in row] for row in x.tolist()]
    out = []
    for query, row in zip(q_ids.tolist(), q.tolist(), strict=True):
        own = [int(v) for v in row]
        found = ((-sum(a * b for a, b in zip(own, y, strict=True)), i) for i, y in zip(ids.tolist(), exact, strict=True) if i != query)
        out += [(query, i, max(-_LONG, min(_LONG, -s))) for s, i in sorted(found)[:k]]
    return out


def _matrix(column: pd.Series) -> np.ndarray:
    rows = [np.asarray(x, np.float64) for x in column]
    width = max(map(len, rows), default=0)
    if all(len(x) == width for x in rows):
        return np.stack(rows) if rows else np.zeros((0, 0))
    return np.stack([np.pad(x, (0, width - len(x))) for x in rows])


def quantised(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): floor(256 * x) of each component, of vectors with an id and finite components only; repeats once."""
    ok = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    # doubles: SQL's floor would make longs, which large components don't fit
    scaled = F.transform("embedding", lambda x: x.cast("double") * 256)
    whole = F.transform(scaled, lambda x: F.when(F.abs(x) < float(1 << 53), F.floor(x).cast("double")).otherwise(x))
    return vectors.where(ok).where(finite).select("vec_id", whole.alias("v")).dropDuplicates(["vec_id", "v"])


def search(vectors: DataFrame, queries: DataFrame, k: int, scratch: Scratch) -> DataFrame:
    """(query_id, rank, vec_id, score) of each query's k best vectors other than those with its own id.

    vectors, queries: (vec_id, v). Vectors of unequal length are filled with zeros. Scores beyond 64 bits are ranked
    exactly and returned as the largest long. Without other vectors a query has no rows.
    """
    vectors, queries = scratch.keep(vectors, "vectors"), scratch.keep(queries, "queries")
    n, cores = vectors.count(), vectors.sparkSession.sparkContext.defaultParallelism
    c_parts = max(1, math.ceil(n / CANDIDATES), min(math.ceil(n / LEAST_CANDIDATES), 2 * cores))
    q_parts = max(1, math.ceil(queries.count() / QUERIES))
    part = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    left = vectors.select("vec_id", "v", part(c_parts).alias("c"))
    right = queries.select("vec_id", "v", part(q_parts).alias("q"))
    first = F.pmod(F.col("q"), F.lit(c_parts))  # the block that a block of queries meets first
    shape = "query_id long, vec_id long, score long"

    def meet(vectors_: pd.DataFrame, queries_: pd.DataFrame) -> pd.DataFrame:
        ids, own = vectors_["vec_id"].to_numpy(np.int64), queries_["vec_id"].to_numpy(np.int64)
        known = queries_["known"].to_numpy(np.float64) if "known" in queries_ else None
        found = best(own, _matrix(queries_["v"]), ids, _matrix(vectors_["v"]), k, known)
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype(np.int64)

    def every(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    spots = left.withColumn("q", F.explode(F.filter(F.sequence(F.lit(0), F.lit(q_parts - 1)), lambda x: F.pmod(x, F.lit(c_parts)) == F.col("c"))))
    one = spots.groupBy("c", "q").cogroup(right.withColumn("c", first).groupBy("c", "q")).applyInPandas(meet, shape)
    one = scratch.keep(one, "first")
    if c_parts > 1:
        last = one.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("known"))
        wide = F.abs(F.col("known")) < float(1 << 52)  # scores that a double may have rounded bound nothing
        last = last.select(F.col("query_id").alias("vec_id"), F.coalesce(F.when(wide, F.col("known").cast("double")), F.lit(float("-inf"))).alias("known"))
        right = right.join(last, "vec_id", "left").fillna(float("-inf"), ["known"])
        rest = left.withColumn("q", every(q_parts)).where(F.col("c") != first).groupBy("c", "q")
        rest = rest.cogroup(right.withColumn("c", every(c_parts)).where(F.col("c") != first).groupBy("c", "q")).applyInPandas(meet, shape)
        one = one.unionByName(rest)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return one.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op8_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "topk")
    vectors = scratch.keep(quantised(table(spark, sf_dir, "embeddings")), "quantised")
    return search(vectors, vectors.where("vec_id % 50 = 0"), 5, scratch)

"""Operator 1, exact top-k search with the threshold algorithm.

Vectors lie in blocks; in each block every dimension has its vectors sorted by
value. The queries of a group read the lists in step, each from the end that its
sign favours, and the vectors met in a step are scored for all of them in one matrix
product. What the lists' current values add up to bounds every vector not met
yet; a query stops when that bound is below its k-th best score. The best of all
blocks are merged per query.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

K = 5
QUERY_EVERY = 50
SCALE = 256
#: Vectors of a block at most, and at least where they would otherwise leave cores idle; queries of a group.
BLOCK = 16_384
LEAST_BLOCK = 1024
QUERIES = 4096
#: Queries that read in step (a step's scores are a matrix of so many rows).
TOGETHER = 256


class SortedLists:
    """Vectors (rows of integers) with one sorted list per dimension."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        self.rising = np.argsort(self.vectors, axis=0, kind="stable")
        self.values = np.take_along_axis(self.vectors, self.rising, 0)

    def search(self, queries: np.ndarray, own: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """``top`` of every query (rows), each without rows of its id in ``own``."""
        n = len(self.ids)
        reach = int(np.abs(self.vectors).max(initial=0)) * int(np.abs(queries).max(initial=0)) * queries.shape[1]
        if reach >= 1 << 53 or (2 * reach + 1) * n >= 1 << 62:  # no longer exact in a product of doubles
            return [self.top(q, i, k) for q, i in zip(queries, own, strict=True)]
        out = []
        for a in range(0, len(queries), TOGETHER):
            keys = self._in_step(queries[a:a + TOGETHER], own[a:a + TOGETHER], k, reach)
            for row in keys:
                score, back = np.divmod(row[row >= 0], n)
                out.append((self.ids[n - 1 - back], score - reach))
        return out

    def _in_step(self, queries: np.ndarray, own: np.ndarray, k: int, reach: int) -> np.ndarray:
        """Per query the k best as falling keys: larger scores first, then smaller rows; -1 is none."""
        n = len(self.ids)
        values = self.values
        first, last = np.searchsorted(self.ids, own, "left"), np.searchsorted(self.ids, own, "right")
        best = np.full((len(queries), k), -1, np.int64)
        active, met = np.arange(len(queries)), np.zeros(n, bool)
        depth, step = 0, 4 * k
        while depth < n and len(active):
            weight = queries[active]
            down, up = np.flatnonzero((weight > 0).any(0)), np.flatnonzero((weight < 0).any(0))
            # With all weights 0 every score is 0: the rows are read as they stand.
            end = min(n, depth + step) if len(down) or len(up) else n
            met_now = np.zeros(n, bool)
            if len(down) or len(up):
                met_now[self.rising[n - end:n - depth, down]] = True
                met_now[self.rising[depth:end, up]] = True
            else:
                met_now[:] = True
            new = np.flatnonzero(met_now & ~met)
            met |= met_now
            score = (weight.astype(np.float64) @ self.vectors[new].T.astype(np.float64)).astype(np.int64)
            keys = (score + reach) * n + (n - 1 - new)
            for row in np.flatnonzero(last[active] > first[active]):
                a, b = np.searchsorted(new, (first[active[row]], last[active[row]]))
                keys[row, a:b] = -1
            keys = np.concatenate([best[active], keys], axis=1)
            best[active] = -np.sort(-np.partition(keys, keys.shape[1] - k, axis=1)[:, -k:], axis=1)
            bound = (np.where(weight > 0, weight * values[n - end], 0) + np.where(weight < 0, weight * values[end - 1], 0)).sum(1)
            kth = best[active, -1]
            active = active[(kth < 0) | (bound >= kth // n - reach)]
            depth, step = end, step * 2
        return best

    def top(self, query: np.ndarray, own: int | None, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best, ties to the smaller id, without rows of the id ``own``."""
        n = len(self.ids)
        used = np.flatnonzero(query)
        weight = query[used]
        met = self.ids == own if own is not None else np.zeros(n, bool)
        best_at, best = np.zeros(0, np.int64), np.zeros(0, np.int64)
        depth, step = 0, 4 * k
        while depth < n:
            # With all weights 0 every score is 0: the first rows are read as they stand.
            end = min(n, depth + step) if len(used) else n
            if len(used):
                rows = np.where(weight > 0, np.arange(n - 1, n - 1 - n, -1)[depth:end, None],
                                np.arange(depth, end)[:, None])
                new = np.unique(self.rising[rows, used])
                bound = int((self.values[rows[-1], used] * weight).sum())
            else:
                new, bound = np.arange(n), 0
            new = new[~met[new]]
            met[new] = True
            at = np.r_[best_at, new]
            score = np.r_[best, self.vectors[new] @ query]
            keep = np.lexsort((at, -score))[:k]  # rows stand in order of their ids
            best_at, best = at[keep], score[keep]
            depth, step = end, step * 2
            if len(best) == k and bound < best[-1]:
                break
        return self.ids[best_at], best


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v): rows with an id whose components are all there and finite, as integers floor(SCALE * x)."""
    x = F.col(vector).cast("array<double>")
    good = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return (vectors.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & (F.size(x) > 0))
            .where(F.coalesce(good, F.lit(False)))
            .select(F.col(key).cast("long").alias("id"), F.transform(x, lambda c: F.floor(c * SCALE)).alias("v")))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, key: str = "vec_id",
          vector: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k best inner products over ``vectors``.

    Candidates are the vectors of the query's length other than those of its
    own id. Vectors that are null, empty or hold null or non-finite components
    and rows without an id take no part. Equal vectors tie; ties go to the
    smaller id. A query row that is repeated is answered once; a candidate row
    that is repeated is a candidate each time. Tables without usable rows give
    none; other columns play no part, whatever their names.
    """
    rows, asked = usable(vectors, key, vector), usable(queries, key, vector).distinct()
    counts = (rows.groupBy(F.size("v").alias("dims")).agg(F.count("*").alias("n"))
              .join(asked.groupBy(F.size("v").alias("dims")).agg(F.count("*").alias("m")), "dims"))
    # One row per length of vectors: how many blocks and groups it needs.
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.least(F.lit(2 * cores), F.ceil(F.col("n") / LEAST_BLOCK)))
    plan = F.broadcast(counts.select("dims", blocks.alias("blocks"),
                                     F.ceil(F.col("m") / QUERIES).alias("groups")))
    block = (rows.withColumn("dims", F.size("v")).join(plan, "dims")
             .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
             .withColumn("group", F.explode(F.expr("sequence(0, groups - 1)"))))
    group = (asked.withColumn("dims", F.size("v")).join(plan, "dims")
             .withColumn("group", F.pmod(F.xxhash64("id"), F.col("groups")))
             .withColumn("block", F.explode(F.expr("sequence(0, blocks - 1)"))))
    by = ["dims", "block", "group"]

    def search(some: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(some) and len(wanted):
            lists = SortedLists(some["id"].to_numpy(), np.stack(some["v"].to_numpy()).astype(np.int64))
            own = wanted["id"].to_numpy()
            found = lists.search(np.stack(wanted["v"].to_numpy()).astype(np.int64), own, k)
            out = [(np.full(len(ids), query), ids, score) for query, (ids, score) in zip(own, found, strict=True)]
        cols = [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 3
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), cols, strict=True)))

    found = (block.select("id", "v", *by).groupBy(by).cogroup(group.select("id", "v", *by).groupBy(by))
             .applyInPandas(search, "query_id long, vec_id long, score long"))
    first = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op1(vectors: DataFrame) -> DataFrame:
    return top_k(vectors, vectors.where(F.col("vec_id") % QUERY_EVERY == 0))


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
  WHERE q.vec_id % 50 = 0
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

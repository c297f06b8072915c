"""Exact top-k by inner product with a KD-tree per shard (operator 2).

The vectors are dealt into shards of bounded size by a hash of their id.  Each shard builds a KD-tree:
median splits on the widest dimension down to leaves of LEAF vectors, every node with its tight bounding box.
A query visits a shard's nodes best first: a node's bound is the largest score any point of its box could have,
and the visit ends when the best bound left is below the query's kth score so far.  That kth score is propagated: a first
round searches one shard per query, and what it finds is the bar in all the others.  Queries go to the shards
in blocks of bounded size, so a task holds one shard and one block of queries.

Components are turned into floor(256 x).  Scores are exact integers: float64 products while they stay
below 2^53, Python integers beyond.  Edge cases: vectors that are null, empty, or hold a null or non-finite component take
no part, as data or as queries, and vectors of another length than the query's are no candidates for it.  A query's own row is no
candidate; with repeated ids, no row of that id is.  Ties go to the smaller id, and equal (id, score) rows each count.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskhouse.llm import common

#: Vectors in a shard, queries in a block, vectors in a leaf.
SHARD, BLOCK, LEAF = 8192, 512, 128


def quantised(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v): ids as long and vectors as arrays of floor(256 x), without those that take no part."""
    x = F.transform(vector, lambda c: c.cast("double"))
    good = F.col(key).isNotNull() & (F.size(vector) > 0) & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    v = F.transform(x, lambda c: F.floor(c * 256).cast("double"))
    return df.where(F.coalesce(good, F.lit(False))).select(F.col(key).cast("long").alias("id"), v.alias("v"), F.size(vector).alias("dim"))


class Tree:
    """KD-tree over the rows of v; node k has children 2k+1 and 2k+2."""

    def __init__(self, ids: np.ndarray, v: np.ndarray):
        depth = max(0, math.ceil(math.log2(max(1, len(v) / LEAF))))
        self.inner = 2**depth - 1
        self.order = np.arange(len(v))
        self.ends = [(0, 0)] * (2 * self.inner + 1)
        self.ends[0] = (0, len(v))
        for k in range(self.inner):
            a, b = self.ends[k]
            mid = (a + b) // 2
            if b - a > 1:
                own = v[self.order[a:b]]
                widest = int(np.argmax(own.max(axis=0) - own.min(axis=0)))
                self.order[a:b] = self.order[a:b][np.argpartition(own[:, widest], mid - a)]
            self.ends[2 * k + 1], self.ends[2 * k + 2] = (a, mid), (mid, b)
        self.ids, self.v = ids[self.order], v[self.order]
        empty = np.zeros(v.shape[1])
        self.low = np.array([self.v[a:b].min(axis=0) if b > a else empty for a, b in self.ends])
        self.high = np.array([self.v[a:b].max(axis=0) if b > a else empty for a, b in self.ends])
        self.reach = float(np.abs(v).max(initial=0))

    def bounds(self, q: np.ndarray) -> np.ndarray:
        """Largest score of any point of each node's box, by query and node."""
        return np.maximum(q, 0) @ self.high.T + np.minimum(q, 0) @ self.low.T

    def search(self, query_id: int, q: np.ndarray, bounds: np.ndarray, k: int, bar: float) -> list[tuple[int, int]]:
        """Up to k (score, id), best first, that are at least ``bar``."""
        exact = self.reach * float(np.abs(q).sum()) < 2**52
        slack = 0.0 if exact else 1e-9
        best: list[tuple[int, int]] = []  # a heap of (score, -id), the worst first
        heap = [(-bounds[0], 0)]
        while heap:
            top, node = heapq.heappop(heap)
            kth = best[0][0] if len(best) == k else bar
            if -top + slack * abs(top) < kth:
                break
            if node < self.inner:
                for child in (2 * node + 1, 2 * node + 2):
                    if self.ends[child][0] < self.ends[child][1]:
                        heapq.heappush(heap, (-bounds[child], child))
                continue
            a, b = self.ends[node]
            scores = self.v[a:b] @ q
            near = np.flatnonzero(scores + slack * np.abs(scores) >= kth)
            for i in near.tolist():
                own = int(self.ids[a + i])
                if own == query_id:
                    continue
                s = int(scores[i]) if exact else sum(int(x) * int(y) for x, y in zip(self.v[a + i], q, strict=True))
                if len(best) < k:
                    heapq.heappush(best, (s, -own))
                elif (s, -own) > best[0]:
                    heapq.heapreplace(best, (s, -own))
        return sorted(((s, -i) for s, i in best), key=lambda x: (-x[0], x[1]))


def _search_group(left: pd.DataFrame, right: pd.DataFrame, k: int) -> pd.DataFrame:
    """Queries (left) against one shard (right)."""
    rows = []
    if len(left) and len(right):
        tree = Tree(right["id"].to_numpy(), np.stack(right["v"].to_numpy()))
        q = np.stack(left["qv"].to_numpy())
        bounds = tree.bounds(q)
        for i, (query, bar) in enumerate(zip(left["qid"].tolist(), left["bar"].tolist(), strict=True)):
            bar = -np.inf if bar is None or np.isnan(bar) else bar
            rows += [(query, own, str(s)) for s, own in tree.search(query, q[i], bounds[i], k, bar)]
    return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "object"})


def top_k(data: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of ``data`` for each row of ``queries``; both as quantised() gives."""
    spark = data.sparkSession
    common.ship(spark)
    data = data.select("id", "v", "dim")
    shards = max(1, -(-data.count() // SHARD))
    queries = common.shared_checkpoint(queries.select(F.col("id").alias("qid"), F.col("v").alias("qv"), F.col("dim").alias("qdim")).dropDuplicates(["qid", "qv"]))
    blocks = max(1, -(-queries.count() // BLOCK))
    data = data.withColumn("shard", F.pmod(F.xxhash64("id", "v"), F.lit(shards)))
    home = F.pmod(F.xxhash64("qid"), F.lit(shards))
    block = F.pmod(F.xxhash64("qid", F.lit(1)), F.lit(blocks))
    # every task gets one shard and one block of queries
    data = common.shared_checkpoint(data)
    spread = data.withColumn("block", F.explode(F.expr(f"sequence(0L, {blocks - 1}L)")))
    schema = "query_id long, vec_id long, score string"

    def search(own: DataFrame) -> DataFrame:
        found = own.groupBy("at_shard", "at_block", "qdim").cogroup(spread.groupBy("shard", "block", "dim"))
        return found.applyInPandas(lambda a, b: _search_group(a, b, k), schema).withColumn("score", F.col("score").cast("decimal(38,0)"))

    first = common.shared_checkpoint(search(queries.withColumns({"at_shard": home, "at_block": block, "bar": F.lit(None).cast("double")})))
    # the kth score of the first shard, a little lowered where float64 rounds
    bar = first.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score").cast("double")).alias("bar"))
    bar = bar.select(F.col("query_id").alias("qid"), (F.col("bar") - F.abs("bar") * 1e-9).alias("bar"))
    rest = queries.join(bar, "qid", "left").withColumns({"home": home, "at_block": block, "at_shard": F.explode(F.expr(f"sequence(0L, {shards - 1}L)"))})
    second = search(rest.where("at_shard != home").drop("home"))
    # each shard gave k rows of a query at most
    out = first.unionByName(second).groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("worse"), "vec_id"))), 1, k).alias("best"))
    out = out.select("query_id", F.posexplode("best").alias("at", "hit"))
    return out.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.worse")).cast("long").alias("score"))


def op2_exact_topk(spark, sf_dir: str) -> DataFrame:
    data = quantised(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id", "embedding")
    return top_k(data, data.where(F.col("id") % 50 == 0), 5)


ORACLE_OP2 = """
WITH good AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), scored AS (
  SELECT q.vec_id AS query_id, d.vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, d.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM good q JOIN good d ON q.vec_id <> d.vec_id AND len(q.v) = len(d.v)
  WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

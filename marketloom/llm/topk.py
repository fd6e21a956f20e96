"""Exact top-k search by inner product with one KD-tree per shard.

Vectors are dealt to shards of bounded size. A shard builds a tree by median splits of
its widest dimension and keeps a tight box per node. A box bounds the inner product of a
query from above, so the search goes best node first and stops once no box can reach the
kth score. Queries travel in blocks. Each is searched in its home shard first; its kth
score there goes along to all other shards, which only return what reaches it.

Defined results: components become floor(256 x); vectors that are null or hold null, NaN
or infinite components take no part, nor do rows without an id; missing components of a
shorter vector count as 0; rows with the query's own id are no candidates; scores beyond
the range of a long are its ends; ties go to the smaller id; with fewer than k candidates
all are returned; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketloom.llm.common import table
from marketloom.session import materialize

K = 5
SHARD_ROWS, QUERY_ROWS, LEAF_ROWS = 8192, 512, 128
RESULT = "query_id bigint, vec_id bigint, score bigint"
LEAST, MOST = -(2**63), 2**63 - 1


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products, exact: in doubles or longs where these hold them, else in whole numbers of any size."""
    most = a.shape[1] * max(1, _size(a)) * max(1, _size(b))
    if most < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if most < 2**63:
        return a @ b.T
    exact = a.astype(object) @ b.astype(object).T
    return np.array([[min(max(x, LEAST), MOST) for x in row] for row in exact], np.int64).reshape(len(a), len(b))


def _size(a: np.ndarray) -> int:
    return max(abs(int(a.min())), abs(int(a.max()))) if a.size else 0


class Tree:
    """Boxes and leaves over integer vectors."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, leaf_rows: int = LEAF_ROWS):
        self.vectors, self.ids = vectors, ids
        self.low, self.high, self.children, self.rows = [], [], [], []
        self._build(np.arange(len(ids)), leaf_rows)
        self.low, self.high = np.array(self.low), np.array(self.high)

    def _build(self, rows: np.ndarray, leaf_rows: int) -> int:
        own, node = self.vectors[rows], len(self.rows)
        low, high = own.min(0), own.max(0)
        self.low.append(low)
        self.high.append(high)
        self.children.append(None)
        self.rows.append(rows)
        if len(rows) > leaf_rows:
            wide = (high - low).argmax()
            order = np.argpartition(own[:, wide], len(rows) // 2)
            middle = len(rows) // 2
            self.children[node] = (self._build(rows[order[:middle]], leaf_rows), self._build(rows[order[middle:]], leaf_rows))
            self.rows[node] = None
        return node

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Per query and node a number that no inner product inside the box exceeds."""
        above, below = np.maximum(queries, 0).astype(np.float64), np.minimum(queries, 0).astype(np.float64)
        bound = above @ self.high.astype(np.float64).T + below @ self.low.astype(np.float64).T
        # rounding of sums beyond 2**53 must not shut a box
        return bound + np.abs(bound) * 1e-12

    def search(self, query: np.ndarray, own_id: int, bound: np.ndarray, k: int, reach: int) -> list[tuple[int, int]]:
        """(score, id) of the best k candidates, best first, of those that score at least ``reach``."""
        best: list[tuple[int, int]] = []
        todo = [(-bound[0], 0)]
        while todo and -todo[0][0] >= reach:
            node = heapq.heappop(todo)[1]
            if self.children[node]:
                for child in self.children[node]:
                    if bound[child] >= reach:
                        heapq.heappush(todo, (-bound[child], child))
                continue
            rows = self.rows[node]
            scores = products(query[None], self.vectors[rows])[0]
            for i in np.flatnonzero(scores >= reach).tolist():
                entry = (int(scores[i]), -int(self.ids[rows[i]]))
                if -entry[1] == own_id:
                    continue
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
            if len(best) == k:
                reach = max(reach, best[0][0])
        return [(score, -i) for score, i in sorted(best, reverse=True)]


def _matrix(values: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(values), width), np.int64)
    for i, v in enumerate(values):
        out[i, : len(v)] = v
    return out


def _searcher(k: int):
    def run(vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(vectors) and len(queries):
            width = max(max(map(len, vectors["v"])), max(map(len, queries["v"])))
            tree = Tree(_matrix(vectors["v"], width), vectors["vec_id"].to_numpy())
            asked = _matrix(queries["v"], width)
            bounds = tree.bounds(asked)
            for i, (own_id, reach) in enumerate(zip(queries["query_id"].tolist(), queries["reach"].tolist())):
                out += [(own_id, vec_id, score) for score, vec_id in tree.search(asked[i], own_id, bounds[i], k, reach)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"], dtype="int64")

    return run


def whole_numbers(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, v): the vectors that take part, as integers."""
    x = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    fine = F.forall(x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    rows = vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & fine)
    return rows.select(F.col(id_col).cast("bigint").alias("vec_id"), F.transform(x, lambda c: F.floor(c * 256)).alias("v"))


def search(vectors: DataFrame, queries: DataFrame, k: int = K, shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the best k of ``vectors`` (vec_id, v) for each of ``queries`` (query_id, v)."""
    queries = materialize(queries, "queries")
    shards = max(1, math.ceil(vectors.count() / shard_rows))
    blocks = max(1, math.ceil(queries.count() / query_rows))
    home = lambda c: F.pmod(F.xxhash64(c, F.lit("shard")), F.lit(shards))
    block = F.pmod(F.xxhash64("query_id", F.lit("block")), F.lit(blocks))
    own = vectors.withColumn("shard", home("vec_id"))
    # every block meets every shard once; both sides of a meeting are bounded
    dealt = own.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))))
    asked = queries.withColumns({"block": block, "home": home("query_id")})

    def meet(questions: DataFrame) -> DataFrame:
        left = dealt.repartition(shards * blocks, "shard", "block").groupBy("shard", "block")
        right = questions.repartition(shards * blocks, "shard", "block").groupBy("shard", "block")
        return left.cogroup(right).applyInPandas(_searcher(k), RESULT)

    first = materialize(meet(asked.withColumnRenamed("home", "shard").withColumn("reach", F.lit(LEAST))), "home-shards")
    kth = first.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score")).otherwise(LEAST).alias("reach"))
    rest = asked.join(kth, "query_id", "left").withColumn("reach", F.coalesce("reach", F.lit(LEAST)))
    rest = rest.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(shards - 1).cast("bigint")))).where("shard <> home")
    found = first.unionByName(meet(rest)) if shards > 1 else first
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op1_kd_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best of all other vectors for every vector whose id is divisible by 50."""
    vectors = materialize(whole_numbers(table(spark, sf_dir, "embeddings")), "vectors")
    queries = vectors.where("vec_id % 50 = 0").withColumnRenamed("vec_id", "query_id").dropDuplicates(["query_id"])
    return search(vectors, queries)


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), r AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

"""Exact top-k inner products by the threshold algorithm over sorted per-dimension lists.

Candidates are dealt into blocks of bounded size.  For each block a task sorts one list
per dimension.  A query walks all lists in step, from the end that its own component
favours; rows met for the first time are scored exactly, and the walk stops once the bound
on unmet rows (the sum of the query's products with the values the lists have reached)
cannot beat the k-th score so far.  A bound equal to it goes on, as a smaller id may tie.
The k best of each block are merged per query.

Vectors that are null, empty, or hold null or non-finite components take no part; a vector
is scored only against vectors of its own length.  Rows with a null id take no part.
Repeated ids are separate candidates; equal rows are folded and dealt apart, so that no block
holds many of them.  Query rows with one id share one list of ``k``, and no
row with that id is their candidate, as in the SQL.  Scores outside 64 bits are set to the nearest
64-bit value.  Input columns other than the id and the vector are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartlark.llm import common

K = 10
SCALE = 1024
#: Rows of a candidate block and of a query block.
BLOCK_ROWS = 8192
QUERY_ROWS = 2048
#: Rows that a walk first takes from each list; later steps double.
FIRST_STEP = 32
_LONG = np.iinfo(np.int64)


def whole_components(matrix: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """``floor(scale * x)`` as 64-bit whole numbers, or as unbounded ones where inner
    products could leave 64 bits."""
    scaled = np.floor(scale * matrix.astype(np.float64))
    most = float(np.abs(scaled).max(initial=0.0))
    if most * most * max(1, matrix.shape[1]) < 2.0**62:
        return scaled.astype(np.int64)
    return np.array([[int(x) for x in row] for row in scaled], dtype=object)


class SortedLists:
    """The candidates of one block with a sorted list per dimension."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.rows = ids[order], rows[order]
        self.order = np.argsort(self.rows, axis=0, kind="stable")
        self.sorted = np.take_along_axis(self.rows, self.order, axis=0)

    def top(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows other than the query's own."""
        n, dims = self.rows.shape
        falls = query >= 0  # from the largest values down
        met = self.ids == query_id
        best_ids, best = self.ids[:0], self.rows[:0, 0]
        depth, step, columns = 0, FIRST_STEP, np.arange(dims)
        while depth < n:
            upto = min(n, depth + step)
            fresh = np.zeros(n, bool)
            fresh[self.order[n - upto : n - depth, falls]] = True
            fresh[self.order[depth:upto, ~falls]] = True
            fresh &= ~met
            met |= fresh
            places = np.flatnonzero(fresh)
            best_ids = np.concatenate([best_ids, self.ids[places]])
            best = np.concatenate([best, self.rows[places] @ query])
            keep = np.lexsort((best_ids, -best))[:k]
            best_ids, best = best_ids[keep], best[keep]
            depth, step = upto, 2 * step
            reached = self.sorted[np.where(falls, n - depth, depth - 1), columns]
            if len(best) == k and (reached * query).sum() < best[-1]:
                break
        return best_ids, best


def usable(vector: str) -> Column:
    """A vector without null and non-finite components."""
    x = F.col(vector)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(math.inf)))
    return x.isNotNull() & (F.size(x) > 0) & ~bad


def _dealt(rows: DataFrame, per_block: int, k: int) -> tuple[DataFrame, int]:
    """Rows with a block number; the number of blocks follows from the row count.

    Equal rows are folded before they move and dealt apart.  ``k`` of them stand for any
    number: they tie in every list, and a list of ``k`` has no place for more.
    """
    blocks = max(1, math.ceil(rows.count() / per_block))
    folded = rows.groupBy("id", "vector").agg(F.count("*").alias("n"))
    copies = F.sequence(F.lit(1).cast("bigint"), F.least("n", F.lit(k).cast("bigint")))
    block = F.pmod(F.xxhash64("id", "vector", "copy"), F.lit(blocks))
    return (
        folded.withColumn("copy", F.explode(copies))
        .select("id", "vector", block.alias("block")), blocks,
    )


def _copied(rows: DataFrame, own: str, other: str, others: int) -> DataFrame:
    """Each block once for every block of the other side."""
    return rows.select(
        "id", "vector", F.size("vector").alias("dims"), F.col("block").alias(own),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(others - 1).cast("bigint")))
        .alias(other),
    )


def top_k(
    queries: DataFrame, candidates: DataFrame, k: int = K, scale: int = SCALE
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` for ``id``, ``vector`` rows.

    Every query block meets every candidate block once: the product of a stated query set
    with all rows, in tasks of bounded size.
    """
    candidates, n_blocks = _dealt(candidates, BLOCK_ROWS, k)
    queries, n_query_blocks = _dealt(queries, QUERY_ROWS, k)
    left = _copied(queries, "query_block", "block", n_blocks)
    right = _copied(candidates, "block", "query_block", n_query_blocks)
    key = ["dims", "block", "query_block"]

    def search(_, asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(asked) and len(held):
            lists = SortedLists(
                held["id"].to_numpy(), whole_components(np.stack(held["vector"]), scale)
            )
            wanted = whole_components(np.stack(asked["vector"]), scale)
            if object in (lists.rows.dtype, wanted.dtype) or _may_overflow(wanted, lists.rows):
                wanted = wanted.astype(object)
                lists.rows, lists.sorted = lists.rows.astype(object), lists.sorted.astype(object)
            for query_id, query in zip(asked["id"], wanted, strict=True):
                ids, scores = lists.top(query_id, query, k)
                out += [(query_id, i, s) for i, s in zip(ids, scores, strict=True)]
        return pd.DataFrame(
            {
                "query_id": np.array([x[0] for x in out], np.int64),
                "vec_id": np.array([x[1] for x in out], np.int64),
                "score": np.array(
                    [min(max(int(x[2]), _LONG.min), _LONG.max) for x in out], np.int64
                ),
            }
        )

    found = (
        left.groupBy(*key)
        .cogroup(right.groupBy(*key))
        .applyInPandas(search, "query_id bigint, vec_id bigint, score bigint")
    )
    # k rows per query and block: Spark keeps the k best of each task before the shuffle.
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _may_overflow(wanted: np.ndarray, rows: np.ndarray) -> bool:
    most = float(np.abs(wanted).max(initial=0)) * float(np.abs(rows).max(initial=0))
    return most * max(1, rows.shape[1]) >= 2.0**62


def op6_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every hundredth vector against all other vectors."""
    vectors = (
        common.table(spark, sf_dir, "embeddings")
        .filter(F.col("vec_id").isNotNull() & usable("embedding"))
        .select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    )
    return top_k(vectors.filter(F.col("id") % 100 == 0), vectors)


OP6_SQL = """
with usable as (
    select vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) v
    from embeddings
    where vec_id is not null and len(embedding) > 0
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
    select q.vec_id query_id, c.vec_id,
           cast(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) as bigint) score
    from usable q join usable c on q.vec_id <> c.vec_id and len(q.v) = len(c.v)
    where q.vec_id % 100 = 0
), ranked as (
    select query_id, row_number() over (partition by query_id order by score desc, vec_id) r,
           vec_id, score
    from scored
)
select query_id, cast(r as integer) "rank", vec_id, score from ranked where r <= 10
"""

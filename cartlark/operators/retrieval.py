"""Exact cosine top-k over dense vectors, with already seen items left out.

Users are dealt into shards, and items into the parts of cells of like vectors, each of
bounded size.  A group scores its matrix product in NumPy, some users at a time, and returns
at most ``k`` rows per user; a window then merges a user's partial lists.  No table of all
user-item scores ever exists, and a seen pair travels only to the one group that scores it.

A user visits the cell of the nearest centre, and then only cells that can hold a better item
(``cell_index``); a group holds whole cells, as many as fit a block.  Items that fit one block
are not indexed.  At 64 dimensions a side of a group is about 8 MB.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartlark.functions.vectors import cosine, norm
from cartlark.operators.cell_index import build_cells, shard_count, unit_rows, visited

USERS_PER_SHARD = 16_384
ITEMS_PER_BLOCK = 16_384
USERS_AT_ONCE = 256
SCORE_DIGITS = 6
_SCHEMA = "user_id bigint, item_id bigint, score double"


def similar_items(
    items: DataFrame, query: Sequence[float], k: int, exclude: Sequence[int] = ()
) -> DataFrame:
    """The ``k`` items closest to one query vector; nothing for ``k`` below one."""
    vector = F.array(*(F.lit(float(x)) for x in query))
    score = F.round(cosine(F.col("embedding"), vector), SCORE_DIGITS)
    kept = items.filter(~F.col("item_id").isin(*exclude)) if len(exclude) else items
    return (
        kept.select("item_id", score.alias("score"))
        .orderBy(F.desc("score"), "item_id")
        .limit(max(k, 0))
    )


def _slot(column: str, slots: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(slots)).cast("int")


def _best(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, columns and rounded values of the ``k`` best finite scores per row, best first,
    ties to the smaller column."""
    width = scores.shape[1]
    if k < width:
        limit = np.partition(scores, width - k, axis=1)[:, width - k, None]
        # Values that round to the same number can differ by one unit of the last digit.
        rows, columns = np.nonzero(scores >= limit - 10.0**-SCORE_DIGITS)
    else:
        rows, columns = np.indices(scores.shape).reshape(2, -1)
    values = np.round(scores[rows, columns], SCORE_DIGITS) + 0.0
    finite = np.isfinite(values)
    rows, columns, values = rows[finite], columns[finite], values[finite]
    order = np.lexsort((columns, -values, rows))
    rows, columns, values = rows[order], columns[order], values[order]
    place = np.arange(len(rows)) - np.searchsorted(rows, rows)
    kept = place < k
    return rows[kept], columns[kept], values[kept]


def _visits(users: pd.Series, cells: np.ndarray) -> np.ndarray:
    """Users by cells: does the user visit the cell?  ``cells`` are sorted and distinct."""
    lengths = [len(visited_cells) for visited_cells in users]
    asked = np.concatenate([*users, np.empty(0)]).astype("int64")
    at = np.minimum(np.searchsorted(cells, asked), len(cells) - 1)
    known = cells[at] == asked
    wanted = np.zeros((len(lengths), len(cells)), dtype=bool)
    wanted[np.repeat(np.arange(len(lengths)), lengths)[known], at[known]] = True
    return wanted


def _scores(users: np.ndarray, items: np.ndarray, wanted: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Cosines with the items of visited cells (``at``: an item's cell), minus infinity elsewhere."""
    if wanted.all():
        return users @ items.T
    scores = np.full((len(users), len(items)), -np.inf)
    for cell in np.flatnonzero(wanted.any(0)):
        rows, columns = np.flatnonzero(wanted[:, cell]), np.flatnonzero(at == cell)
        scores[np.ix_(rows, columns)] = users[rows] @ items[columns].T
    return scores


def _best_of_group(k: int):
    def best(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        users, seen = left[left["asks"]], left[~left["asks"]]
        found = [pd.DataFrame({"user_id": [], "item_id": [], "score": []})]
        if users.empty or right.empty:
            return found[0]
        items = right.sort_values("item_id", ignore_index=True)
        user_ids, item_ids = users["user_id"].to_numpy(), items["item_id"].to_numpy()
        user_matrix, item_matrix = unit_rows(users["embedding"]), unit_rows(items["embedding"])
        cells, at = np.unique(items["cell"].to_numpy(), return_inverse=True)
        row = pd.Index(user_ids).get_indexer(seen["user_id"].to_numpy())
        column = pd.Index(item_ids).get_indexer(seen["item_id"].to_numpy())
        known = (row >= 0) & (column >= 0)
        row, column = row[known], column[known]
        by_row = np.argsort(row, kind="stable")
        row, column = row[by_row], column[by_row]
        for start in range(0, len(user_ids), USERS_AT_ONCE):
            ids = user_ids[start : start + USERS_AT_ONCE]
            end = start + len(ids)
            wanted = _visits(users["cells"].iloc[start:end], cells)
            scores = _scores(user_matrix[start:end], item_matrix, wanted, at)
            low, high = np.searchsorted(row, [start, end])
            scores[row[low:high] - start, column[low:high]] = -np.inf
            rows, columns, values = _best(scores, k)
            found.append(
                pd.DataFrame(
                    {"user_id": ids[rows], "item_id": item_ids[columns], "score": values}
                )
            )
        return pd.concat(found[1:], ignore_index=True)

    return best


def with_usable_vector(rows: DataFrame) -> DataFrame:
    """Rows whose ``embedding`` is neither null nor empty and has no null or NaN in it."""
    broken = F.exists("embedding", lambda x: x.isNull() | F.isnan(x))
    return rows.filter(F.coalesce((F.size("embedding") > 0) & ~broken, F.lit(False)))


def top_k_items(
    users: DataFrame, items: DataFrame, seen: DataFrame, k: int,
    *, users_per_shard: int = USERS_PER_SHARD, items_per_block: int = ITEMS_PER_BLOCK,
) -> DataFrame:
    """``(user_id, rank, item_id, score)``: per user the ``k`` unseen items of highest cosine
    (to six places), ties to the smaller item id; fewer rows when fewer items are left.

    ``users(user_id, embedding)`` and ``items(item_id, embedding)`` have unique ids; ``seen``
    holds distinct ``(user_id, item_id)`` pairs.  Rows without a usable vector take no part.
    """
    users, items = with_usable_vector(users), with_usable_vector(items)
    user_count, item_count = users.count(), items.count()
    if item_count > items_per_block and _equally_long(users, items):
        index = build_cells(items, item_count, items_per_block)
        partial, _ = visited(users, index, seen, k, users_per_shard, _scored(k), _k_best(k))
    else:
        partial = _in_one_block(users, items, seen, k, user_count, users_per_shard)
    return _k_best(k)(partial).select(
        "user_id", (F.col("place") - 1).alias("rank"), "item_id", "score"
    )


def _equally_long(users: DataFrame, items: DataFrame) -> bool:
    """Cells need vectors of one length; other tables fail in the matrix product, as they must."""
    sizes = users.select(F.size("embedding").alias("n")).union(items.select(F.size("embedding")))
    low, high = sizes.agg(F.min("n"), F.max("n")).first()
    return low == high


def _k_best(k: int):
    best_first = Window.partitionBy("user_id").orderBy(F.desc("score"), "item_id")

    def best(rows: DataFrame) -> DataFrame:
        return rows.withColumn("place", F.row_number().over(best_first)).filter(F.col("place") <= k)

    return best


def _scored(k: int):
    """Scores asking users against offered items of their ``cells`` by ``shard`` and ``block``."""
    key = ["shard", "block"]

    def score(asking: DataFrame, hidden: DataFrame, offered: DataFrame) -> DataFrame:
        vector_type = asking.schema["embedding"].dataType
        asked = asking.select(
            *key, "user_id", F.lit(0).cast("bigint").alias("item_id"),  # ids stay whole numbers
            "embedding", F.lit(True).alias("asks"), "cells",
        )
        left = asked.unionByName(hidden.select(
            *key, "user_id", "item_id", F.lit(None).cast(vector_type).alias("embedding"),
            F.lit(False).alias("asks"), F.lit(None).cast("array<int>").alias("cells"),
        ))
        return (
            left.groupBy(*key).cogroup(offered.groupBy(*key))
            .applyInPandas(_best_of_group(k), schema=_SCHEMA)
        )

    return score


def _in_one_block(users, items, seen, k, user_count, users_per_shard) -> DataFrame:
    """All items in one block, copied to each shard of users."""
    shards = shard_count(users.sparkSession.sparkContext, user_count, users_per_shard)
    shard, block = _slot("user_id", shards).alias("shard"), F.lit(0).alias("block")
    asking = users.select(shard, block, "user_id", "embedding", F.array(F.lit(0)).alias("cells"))
    hidden = seen.join(users, "user_id", "left_semi").select(shard, block, "user_id", "item_id")
    every = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
    offered = items.select(every, block, "item_id", "embedding", F.lit(0).alias("cell"))
    return _scored(k)(asking, hidden, offered)


def vector_audit(item_vocabulary: DataFrame, vectors: DataFrame) -> DataFrame:
    """Readiness facts: are all catalogue items indexed, and with usable vectors?"""
    indexed = vectors.agg(
        F.count("*").alias("vectors"),
        F.count_distinct("item_id").alias("distinct_items"),
        F.min(F.size("embedding")).alias("min_dim"),
        F.max(F.size("embedding")).alias("max_dim"),
        F.count_if(norm(F.col("embedding")) <= 1e-12).alias("zero_vectors"),
    )
    expected = item_vocabulary.agg(F.count("*").alias("n")).scalar()
    return indexed.select(
        expected.alias("catalog_items"), "*", (F.col("vectors") == expected).alias("ready")
    )

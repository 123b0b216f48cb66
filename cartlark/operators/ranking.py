"""Popularity ranking and per-user recommendations from it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartlark.functions.numbers import floor_div
from cartlark.operators.positions import with_position
from cartlark.session import materialize


# Ranks per chunk: bounds a window group for users who have seen a large part of the catalogue.
CHUNK = 65_536
# The ranking rows that may be broadcast, at an assumed size each, and the copies of every
# ranking row beyond that.
BROADCAST_BYTES, RANK_BYTES = 64 << 20, 64
SALTS = 256


def popularity(interactions: DataFrame) -> DataFrame:
    """Summed weight per item (each row counts one when there are no weights), ranked from
    zero by score and then by item."""
    weight = F.col("weight") if "weight" in interactions.columns else F.lit(1.0)
    scores = interactions.groupBy("item_id").agg(F.sum(weight).alias("score"))
    return with_position(scores, [F.desc("score"), F.asc("item_id")], "popularity_rank")


def _skips(seen_ranks: DataFrame, k: int, chunk: int) -> DataFrame:
    """``(user_id, unseen_before, n)``: how many seen items have exactly that many unseen
    ones before them, as far as that is fewer than ``k``.

    A seen item's place among the user's seen items is its place inside a chunk of ranks
    plus the counts of earlier chunks, and chunks that start beyond ``k`` unseen items are
    dropped whole.
    """
    chunked = seen_ranks.withColumn("_chunk", floor_div(F.col("popularity_rank"), chunk))
    earlier = (
        Window.partitionBy("user_id").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    )
    needed = (
        chunked.groupBy("user_id", "_chunk").agg(F.count("*").alias("_n"))
        .select(
            "user_id", "_chunk", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
        )
        .filter(F.col("_chunk") * F.lit(chunk) - F.col("_before") < k)
    )
    place = F.row_number().over(
        Window.partitionBy("user_id", "_chunk").orderBy("popularity_rank")
    )
    return (
        chunked.join(needed, ["user_id", "_chunk"])
        .select(
            "user_id",
            (F.col("popularity_rank") - F.col("_before") - place + 1).alias("unseen_before"),
        )
        .filter(F.col("unseen_before") < k)
        .groupBy("user_id", "unseen_before")
        .agg(F.count("*").alias("n"))
    )


def popularity_top_k(
    users: DataFrame, ranking: DataFrame, seen: DataFrame, k: int, *, chunk: int = CHUNK
) -> DataFrame:
    """``(user_id, rank, item_id, score)``: for every user the first ``k`` ranked items that
    the user has not seen.

    The i-th unseen item of a user stands at rank ``i`` plus the number of seen items that
    have at most ``i`` unseen ones before them.  Counting those per user needs the user's
    seen items only: users and items are never paired up, and every user yields ``k`` rows.

    ``users``: distinct ``user_id``; ``seen``: distinct ``(user_id, item_id)``.
    """
    seen_ranks = (
        seen.join(users, "user_id", "left_semi")
        .join(ranking.select("item_id", "popularity_rank"), "item_id")
        .select("user_id", "popularity_rank")
    )
    skips = (
        _skips(seen_ranks, k, chunk)
        .groupBy("user_id")  # at most k rows each
        .agg(F.map_from_entries(F.collect_list(F.struct("unseen_before", "n"))).alias("skips"))
    )
    skipped_before = F.aggregate(
        F.sequence(F.lit(0), F.col("rank")),
        F.lit(0).cast("bigint"),
        lambda total, i: total
        + F.coalesce(F.try_element_at("skips", i.cast("bigint")), F.lit(0).cast("bigint")),
    )
    # Most users have seen none of the first items, and nothing is to be added up for them.
    skipped = F.when(F.col("skips").isNull(), F.lit(0).cast("bigint")).otherwise(skipped_before)
    wanted = (
        users.select("user_id")
        .join(skips, "user_id", "left")
        .withColumn("rank", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
        .select("user_id", "rank", (F.col("rank") + skipped).alias("popularity_rank"))
    )
    return _at_ranks(materialize(wanted), ranking)


def _at_ranks(wanted: DataFrame, ranking: DataFrame) -> DataFrame:
    """Puts items on wanted ranks.  Most users want the first ranks, so the rank alone is no
    key to shuffle by: the part of the ranking up to the last wanted rank is broadcast while
    its size allows, and otherwise dealt out with its rows repeated over salts."""
    last = wanted.agg(F.max("popularity_rank")).first()[0]
    top = ranking.filter(F.col("popularity_rank") <= F.lit(-1 if last is None else last))
    if last is None or (last + 1) * RANK_BYTES <= BROADCAST_BYTES:
        joined = wanted.join(F.broadcast(top), "popularity_rank")
    else:
        salt = F.pmod(F.xxhash64("user_id"), F.lit(SALTS)).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
        joined = wanted.withColumn("_salt", salt).join(
            top.withColumn("_salt", every), ["popularity_rank", "_salt"]
        )
    return joined.select("user_id", "rank", "item_id", "score")

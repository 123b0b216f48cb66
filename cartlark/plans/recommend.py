"""Recommendations for a table of users, and the embedding learner behind them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.recommendation import ALS
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlark.functions.vectors import unit
from cartlark.operators.negatives import (
    VALIDATION_SEED_OFFSET,
    negative_samples,
    pairwise_loss,
)
from cartlark.operators.ranking import popularity_top_k
from cartlark.operators.retrieval import top_k_items, with_usable_vector
from cartlark.plans.interactions import indexed_interactions, known_interactions, vocabulary
from cartlark.session import materialize

# The strategy labels and the largest k that may be asked for.
EMBEDDING_STRATEGY = "embedding_retrieval"
COLD_STRATEGY = "popularity_cold_start"
MAX_K = 100


def recommend(
    users: DataFrame, user_vectors: DataFrame, item_vectors: DataFrame, ranking: DataFrame,
    seen: DataFrame, k: int = 10, filter_seen: bool = True, popular: DataFrame | None = None,
) -> DataFrame:
    """``(user_id, strategy, rank, item_id, score)`` for every user in ``users(user_id)``:
    vector retrieval where the user has a usable vector, popularity otherwise.  ``popular``
    may hold what :func:`cartlark.operators.ranking.popularity_top_k` gives for all users and
    the same ``ranking``, ``k`` and hidden items, where that is at hand."""
    if not 1 <= k <= MAX_K:
        raise ValueError(f"k must be between 1 and {MAX_K}")
    hidden = seen if filter_seen else seen.filter(F.lit(False))
    user_vectors = with_usable_vector(user_vectors)
    warm = user_vectors.join(users, "user_id", "left_semi")
    cold = users.join(user_vectors, "user_id", "left_anti")
    retrieved = top_k_items(warm, item_vectors, hidden, k)
    if popular is None:
        popular = popularity_top_k(cold, ranking, hidden, k)
    else:
        popular = popular.join(cold, "user_id", "left_semi")
    columns = ("user_id", "strategy", "rank", "item_id", "score")
    return (
        retrieved.withColumn("strategy", F.lit(EMBEDDING_STRATEGY)).select(*columns)
        .unionByName(popular.withColumn("strategy", F.lit(COLD_STRATEGY)).select(*columns))
    )


def recommendation_documents(recommendations: DataFrame, filter_seen: bool = True) -> DataFrame:
    """One row per user with the ranked list nested (at most ``k`` entries)."""
    entry = F.struct("rank", "item_id", "score")
    ranked = F.array_sort(F.collect_list(entry))
    return recommendations.groupBy("user_id", "strategy").agg(
        F.lit(filter_seen).alias("filter_seen"),
        F.transform(ranked, lambda e: F.struct(e["item_id"], e["score"])).alias("recommendations"),
    )


@dataclass(frozen=True)
class Embeddings:
    users: DataFrame
    items: DataFrame
    history: DataFrame | None = None
    best_epoch: int | None = None


def _fit(ratings: DataFrame, rank: int, iterations: int, alpha: float, seed: int):
    return ALS(
        rank=rank, maxIter=iterations, alpha=alpha, seed=seed, implicitPrefs=True,
        userCol="user_index", itemCol="item_index", ratingCol="rating", checkpointInterval=5,
    ).fit(ratings)


def _named(factors: DataFrame, ids: DataFrame, index: str, source: str, target: str) -> DataFrame:
    return (
        factors.join(ids, factors["id"] == ids[index])
        .select(F.col(source).alias(target), unit(F.col("features")).alias("embedding"))
    )


def learn_embeddings(
    train: DataFrame, validation: DataFrame | None = None, *, rank: int = 64,
    epochs: Sequence[int] = (10,), alpha: float = 1.0, seed: int = 42,
) -> Embeddings:
    """Unit-length user and item vectors from summed interaction weights (implicit ALS).

    With several values in ``epochs`` and a validation part, one model is fitted per value
    and the one with the least validation loss is kept; ``history`` lists the losses.  Ids
    are replaced by their vocabulary index, since factor ids are 32-bit.
    """
    users = vocabulary(train, "visitor_id", "user_index")
    items = vocabulary(train, "item_id", "item_index")
    ratings = materialize(
        known_interactions(train, users, items).groupBy(F.col("user_index").cast("int"), F.col("item_index").cast("int"))
        .agg(F.sum("weight").cast("float").alias("rating"))
    )

    def vectors(model):
        return (
            _named(model.userFactors, users, "user_index", "visitor_id", "user_id"),
            _named(model.itemFactors, items, "item_index", "item_id", "item_id"),
        )

    if validation is None or len(epochs) == 1:
        return Embeddings(*vectors(_fit(ratings, rank, epochs[-1], alpha, seed)))

    indexed = indexed_interactions(train, users, items)
    seen = indexed.select("user_index", "item_index").distinct()
    item_count = items.count()
    held_out = indexed_interactions(validation, users, items)
    parts = {
        "train_loss": _triples(indexed, seen, items, item_count, seed, 0),
        "validation_loss": _triples(held_out, seen, items, item_count, seed,
                                    VALIDATION_SEED_OFFSET),
    }
    fitted, rows = {}, []
    for epoch in epochs:  # one fit per setting; each fit and each loss is a Spark job
        fitted[epoch] = vectors(_fit(ratings, rank, epoch, alpha, seed))
        losses = {n: pairwise_loss(t, *fitted[epoch]).first()["loss"] for n, t in parts.items()}
        rows.append((epoch, losses["train_loss"], losses["validation_loss"]))
    history = train.sparkSession.createDataFrame(
        rows, "epoch int, train_loss double, validation_loss double"
    )
    best = best_epoch(history).first()["best_epoch"]
    return Embeddings(*fitted[best], history, best)


def _triples(rows, seen, items, item_count, seed, offset) -> DataFrame:
    """Sampled triples under the original ids."""
    sampled = negative_samples(
        rows, seen, item_count, seed=seed, seed_offset=offset, rows_are_seen=offset == 0
    )
    names = items.select(F.col("item_id").alias("negative_id"), F.col("item_index").alias("_at"))
    return materialize(
        sampled.join(names, F.col("negative_index") == F.col("_at"))
        .select(F.col("visitor_id").alias("user_id"), "item_id", "negative_id", "weight")
    )


def best_epoch(history: DataFrame) -> DataFrame:
    """The earliest epoch of least validation loss; the last one when there was none."""
    order = F.struct("validation_loss", "epoch")
    measured = F.col("validation_loss").isNotNull()
    return history.agg(
        F.coalesce(F.min_by("epoch", F.when(measured, order)), F.max("epoch")).alias("best_epoch")
    )

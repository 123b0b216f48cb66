"""Stored tables of the recommender and full-refresh report snapshots."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlark.plans.analytics import funnel_stages, top_categories, top_items, user_activity
from cartlark.plans.interactions import (
    item_features,
    item_latest_category,
    seen_lists,
    user_features,
    vocabulary,
)
from cartlark.operators.split import split_metadata
from cartlark.sources.versioned_store import publish


def write_split(split: DataFrame, path: str) -> None:
    """Parts as directories, and one metadata row."""
    split.write.mode("overwrite").partitionBy("split").parquet(f"{path}/parts")
    written = split.sparkSession.read.parquet(f"{path}/parts")
    split_metadata(written).coalesce(1).write.mode("overwrite").json(f"{path}/metadata")


def write_model_tables(
    train: DataFrame, ranking: DataFrame, users: DataFrame, items: DataFrame, path: str
) -> None:
    """Vocabularies, features, vectors, seen items and popularity of one trained model.
    ``users`` and ``items`` are the learned vectors."""
    for name, table in _model_tables(train, ranking, users, items).items():
        table.write.mode("overwrite").parquet(f"{path}/{name}")


def publish_model(
    train: DataFrame, ranking: DataFrame, users: DataFrame, items: DataFrame, path: str
) -> int:
    """The same tables as one version: readers see all ten of it or those of the one before."""
    return publish(train.sparkSession, path, _model_tables(train, ranking, users, items))


def _model_tables(train, ranking, users, items) -> dict[str, DataFrame]:
    return {
        "users": vocabulary(train, "visitor_id", "user_index"),
        "items": vocabulary(train, "item_id", "item_index"),
        "categories": vocabulary(train, "category_id", "category_index"),
        "user_features": user_features(train),
        "item_features": item_features(train),
        "item_categories": item_latest_category(train),
        "user_vectors": _at_rest(users),
        "item_vectors": _at_rest(items),
        "seen_items": seen_lists(train),
        "popularity": ranking,
    }


def _at_rest(vectors: DataFrame) -> DataFrame:
    return vectors.withColumn("embedding", F.col("embedding").cast("array<float>"))


def write_vectors(items: DataFrame, path: str, skip_if_ready: bool = False) -> int:
    """Replaces the item vector table; with ``skip_if_ready`` a table of the same row count
    is left alone.  Returns the number of vectors."""
    spark, expected = items.sparkSession, items.count()
    if skip_if_ready:
        try:
            if spark.read.parquet(path).count() == expected:
                return expected
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    _at_rest(items).write.mode("overwrite").parquet(path)
    return expected


def refresh_snapshots(events: DataFrame, path: str) -> None:
    """Rebuilds the four report tables; between refreshes they do not follow the facts."""
    snapshots = {
        "top_items": top_items, "top_categories": top_categories,
        "user_activity": user_activity, "funnel_stages": funnel_stages,
    }
    for name, build in snapshots.items():
        build(events).coalesce(1).write.mode("overwrite").parquet(f"{path}/{name}")


def write_evaluation(rows: DataFrame, protocol: DataFrame, path: str) -> None:
    """Replaces the metric rows and the single protocol row."""
    rows.coalesce(1).write.mode("overwrite").parquet(f"{path}/metrics")
    stamped = protocol.withColumn("loaded_at", F.current_timestamp())
    stamped.coalesce(1).write.mode("overwrite").parquet(f"{path}/protocol")


def publish_evaluation(rows: DataFrame, protocol: DataFrame, path: str) -> int:
    """Metric rows and the protocol row as one version."""
    stamped = protocol.withColumn("loaded_at", F.current_timestamp())
    tables = {"metrics": rows.coalesce(1), "protocol": stamped.coalesce(1)}
    return publish(rows.sparkSession, path, tables)

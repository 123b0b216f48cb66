"""Clean events to recommender inputs: weighted interactions, features, vocabularies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlark.functions.contract import EVENT_TYPES, UNKNOWN_CATEGORY, interaction_weight, is_event
from cartlark.functions.numbers import floor_div
from cartlark.operators.positions import dense_index, index_entries, with_position
from cartlark.sources.files import INTERACTION_COLUMNS, require_columns

INTERACTION_ORDER = ("event_time", "visitor_id", "item_id")


def load_interactions(clean: DataFrame) -> DataFrame:
    """Supported events with a weight, a readable time and a known-or-minus-one category.
    A row whose time is null or unreadable has no place in time and is left out.
    Rows are not sorted here: order is a matter for the writer or the operator that needs it.
    """
    require_columns(clean, INTERACTION_COLUMNS, "clean events")
    category = (
        F.coalesce(F.col("category_id").cast("bigint"), F.lit(UNKNOWN_CATEGORY).cast("bigint"))
        if "category_id" in clean.columns
        else F.lit(UNKNOWN_CATEGORY).cast("bigint")
    )
    return (
        clean.withColumn("event_type", F.lower("event_type"))
        .filter(F.col("event_type").isin(*EVENT_TYPES))
        .withColumns(
            {
                "event_time": F.col("event_time").try_cast("timestamp"),
                "weight": interaction_weight(),
                "category_id": category,
            }
        )
        .filter(F.col("event_time").isNotNull())
    )


def seen_pairs(train: DataFrame) -> DataFrame:
    return train.select(F.col("visitor_id").alias("user_id"), "item_id").distinct()


def seen_lists(train: DataFrame, width: int = 65_536) -> DataFrame:
    """Sorted distinct items per user and ``chunk``, the stored form of :func:`seen_pairs`.

    A chunk covers ``width`` item ids, so no list grows with a user's history."""
    return (
        seen_pairs(train)
        .groupBy("user_id", floor_div(F.col("item_id"), width).alias("chunk"))
        .agg(F.array_sort(F.collect_list("item_id")).alias("items"))
    )


def item_latest_category(train: DataFrame) -> DataFrame:
    """The chronologically last known category per item (minus one when none is known)."""
    recency = [c for c in ("event_time", "visitor_id", "event_id") if c in train.columns]
    return train.groupBy("item_id").agg(
        F.max_by("category_id", F.struct(*recency)).alias("category_id")
    )


def _standardized(df: DataFrame, columns: dict[str, str]) -> dict[str, Column]:
    """log1p, then zero mean and unit population deviation (a constant column keeps scale
    one).  The statistics are single-row subqueries, so the table is not joined to them."""
    result = {}
    for name, source in columns.items():
        value = F.log1p(F.col(source).cast("double"))
        stats = df.agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"))
        mean, std = stats.select("mean").scalar(), stats.select("std").scalar()
        scale = F.when(std > 0, std).otherwise(F.lit(1.0))
        result[name] = F.round((value - mean) / scale, 6)
    return result


def user_features(train: DataFrame) -> DataFrame:
    """Event counts per type in fixed order, standardised, per user."""
    counts = train.groupBy(F.col("visitor_id").alias("user_id")).agg(
        *(F.count_if(is_event(event)).alias(f"n_{event}") for event in EVENT_TYPES)
    )
    scaled = _standardized(counts, {f"{event}_feature": f"n_{event}" for event in EVENT_TYPES})
    return counts.withColumns(scaled)


def item_features(train: DataFrame) -> DataFrame:
    """Event and distinct-user counts, standardised, per item.  Pairs are folded first, so a
    popular item is summed from partial results."""
    counts = (
        train.groupBy("item_id", "visitor_id").agg(F.count("*").alias("n"))
        .groupBy("item_id")
        .agg(F.sum("n").alias("n_events"), F.count("*").alias("n_users"))
    )
    return counts.withColumns(
        _standardized(counts, {"events_feature": "n_events", "users_feature": "n_users"})
    )


def vocabulary(train: DataFrame, column: str, index: str) -> DataFrame:
    """Sorted distinct values of ``column`` numbered from zero."""
    return dense_index(train, column, index)


def grown_vocabulary(held: DataFrame, rows: DataFrame, column: str, index: str) -> DataFrame:
    """A stored vocabulary with the new values of ``rows`` behind the old ones, so that what
    was indexed, learned or counted by it stays valid."""
    return held.select(column, index).unionByName(index_entries(held, rows, column, index))


def known_interactions(rows: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """Interactions in the dense ids of the training vocabularies; rows with an unknown user
    or item are left out.

    ``users(visitor_id, user_index)`` and ``items(item_id, item_index)``.
    """
    return rows.join(users, "visitor_id").join(items, "item_id")


def indexed_interactions(rows: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """:func:`known_interactions` numbered in time order."""
    order = [c for c in (*INTERACTION_ORDER, "event_id") if c in rows.columns]
    keep = dict.fromkeys([*order, "visitor_id", "item_id", "user_index", "item_index", "weight"])
    return with_position(known_interactions(rows, users, items).select(*keep), order, "position")

"""Exact distinct users and items of any date range and hours, without the facts.

Per date, hour, event type and 32,768 dense ids, one row holds a bitmap of who was there and
the number of events.  Bitmaps of any slice are combined by OR, so a report reads this table
and never the facts.  The table only grows: the bitmaps of newly stored facts are appended,
since OR takes two rows of one key as well as one, and their dictionaries keep old indices
(:func:`cartlark.plans.interactions.grown_vocabulary`).  A row is 4 KiB before compression
however few ids it holds, so the table pays off where a bucket's ids are active together:
give dense indices, not raw ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlark.functions.contract import is_event
from cartlark.plans.analytics import FUNNEL_STAGES, event_date, stage_rows

USERS, ITEMS = "user", "item"


def _known(key: str, index: str) -> Column:
    """The index; a null id has none, and an id outside the dictionary is an error, because
    leaving it out would make every count too small."""
    missing = F.raise_error(F.concat(F.lit(f"no {index} for {key} "), F.col(key).cast("string")))
    return F.when(F.col(key).isNotNull(), F.coalesce(F.col(index), missing.cast("bigint")))


def _members(events: DataFrame, subject: str, key: str, held: DataFrame, index: str) -> DataFrame:
    # Folded first: a busy id reaches the join with one row per hour and type.
    folded = events.groupBy(
        event_date().alias("event_date"), F.hour("event_time").alias("hour"), "event_type", key
    ).agg(F.count("*").alias("n"))
    placed = folded.join(held.select(key, index), key, "left").withColumn("_at", _known(key, index))
    return (
        placed.groupBy(
            "event_date", "hour", "event_type", F.bitmap_bucket_number("_at").alias("bucket")
        )
        .agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("_at")).alias("members"),
            F.sum("n").alias("events"),
        )
        .withColumn("subject", F.lit(subject))
    )


def member_bitmaps(events: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """``(event_date, hour, event_type, bucket, members, events, subject)`` of clean events,
    to be appended for each load of new facts.

    ``users(visitor_id, user_index)`` and ``items(item_id, item_index)`` must know every id.
    An event is counted once per subject; one without an id has an event but no member."""
    return _members(events, USERS, "visitor_id", users, "user_index").unionByName(
        _members(events, ITEMS, "item_id", items, "item_index")
    )


def _size(subject: str) -> Column:
    here = F.when(F.col("subject") == subject, F.bitmap_count("members"))
    return F.coalesce(F.sum(here), F.lit(0))


def kpis(bitmaps: DataFrame) -> DataFrame:
    """:func:`cartlark.plans.analytics.kpis` from (sliced) bitmaps."""
    counts = {"views": "view", "cart_adds": "addtocart", "transactions": "transaction"}
    merged = bitmaps.groupBy("subject", "bucket").agg(
        F.bitmap_or_agg("members").alias("members"),
        F.sum("events").alias("total_events"),
        *(F.sum(F.when(is_event(e), F.col("events"))).alias(name) for name, e in counts.items()),
    )
    def events(name: str) -> Column:
        once = F.when(F.col("subject") == USERS, F.col(name))
        return F.coalesce(F.sum(once), F.lit(0)).alias(name)

    return merged.agg(
        events("total_events"), _size(USERS).alias("total_users"),
        _size(ITEMS).alias("total_items"), *map(events, counts),
    )


def funnel_stages(bitmaps: DataFrame) -> DataFrame:
    """:func:`cartlark.plans.analytics.funnel_stages` from (sliced) bitmaps."""
    merged = (
        bitmaps.filter(F.col("subject") == USERS).groupBy("event_type", "bucket")
        .agg(F.bitmap_or_agg("members").alias("members"))
    )
    return stage_rows(
        merged.agg(
            *(
                F.sum(F.when(is_event(event), F.bitmap_count("members"))).alias(f"stage_{order}")
                for order, _, event in FUNNEL_STAGES
            )
        )
    )

"""Insert-if-absent by event id."""

from __future__ import annotations

from pyspark.sql import DataFrame


def new_events(staged: DataFrame, fact: DataFrame) -> DataFrame:
    """Staged rows, one per event id, whose id the fact table does not hold yet."""
    return staged.dropDuplicates(["event_id"]).join(
        fact.select("event_id"), "event_id", "left_anti"
    ).select(*staged.columns)


def merged_fact(staged: DataFrame, fact: DataFrame) -> DataFrame:
    """The fact table after the insert; existing rows win."""
    return fact.unionByName(new_events(staged, fact).select(*fact.columns))

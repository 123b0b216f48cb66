"""Replay order and pacing of stored events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlark.operators.positions import with_previous


def replay_delays(events: DataFrame, speed: float, max_delay_seconds: float) -> DataFrame:
    """Adds ``delay_seconds``: how long a replay at ``speed`` waits before each event, in the
    order of source time and event id.  The first event does not wait."""
    if speed <= 0:
        raise ValueError("speed must be positive")
    if max_delay_seconds < 0:
        raise ValueError("max delay must be non-negative")
    placed = with_previous(events, ["source_timestamp_ms", "event_id"], "source_timestamp_ms")
    gap = F.greatest(F.col("source_timestamp_ms") - F.col("previous"), F.lit(0)) / 1000
    wait = F.least(gap / F.lit(speed), F.lit(float(max_delay_seconds)))
    return placed.withColumn("delay_seconds", F.coalesce(wait, F.lit(0.0))).drop("previous")

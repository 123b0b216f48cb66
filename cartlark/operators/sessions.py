"""Sessionization by inactivity gap.

Two events of a visitor in the same bucket of one gap width are never more than a gap
apart, so they share a session.  It is therefore enough to number the buckets: one row
per visitor and bucket, built with map-side combining, bounded by the time span even for
a visitor that sends a third of all events.  Events then pick up their number by an
equi-join on ``(visitor, bucket)``.

A visitor of a bounded number of events needs no buckets: its events are shuffled once, by
the visitor, and numbered in order of time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartlark.functions.numbers import floor_div
from cartlark.operators.heavy import LIGHT_ROWS, heavy_keys, parted
from cartlark.session import materialize


def _bucket(time: str, gap_ms: int) -> Column:
    return floor_div(F.col(time), max(gap_ms, 1))


def session_numbers(events: DataFrame, *, visitor: str, time: str, gap_ms: int) -> DataFrame:
    """``(visitor, _bucket, session_number)``, numbered from one in time order."""
    if gap_ms < 0:
        raise ValueError("session gap must be non-negative")
    in_order = Window.partitionBy(visitor).orderBy("_bucket")
    silence = F.col("_first") - F.lag("_last").over(in_order)
    return (
        events.select(visitor, time, _bucket(time, gap_ms).alias("_bucket"))
        .groupBy(visitor, "_bucket")
        .agg(F.min(time).alias("_first"), F.max(time).alias("_last"))
        .withColumn("_starts", F.when(silence <= gap_ms, 0).otherwise(1))
        .select(
            visitor,
            "_bucket",
            F.sum("_starts")
            .over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
            .alias("session_number"),
        )
    )


def with_sessions(
    events: DataFrame, *, visitor: str = "visitorid", time: str = "timestamp",
    gap_minutes: float = 30, keys_from: DataFrame | None = None, light_rows: int = LIGHT_ROWS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Adds ``session_number`` and ``session_id`` (``visitor-number``).  ``keys_from`` may
    name a cheaper frame with the same visitors and times, copies of events included, and
    ``counted`` a still cheaper one to find heavy visitors in: those of all events, others
    among them."""
    gap_ms = int(gap_minutes * 60_000)
    if gap_ms < 0:
        raise ValueError("session gap must be non-negative")
    keys = (events if keys_from is None else keys_from).select(visitor, time)
    heavy = heavy_keys(keys if counted is None else counted, visitor, light_rows)
    if heavy is None:
        return _sorted_sessions(events, visitor, time, gap_ms)
    light, busy = parted(materialize(events), visitor, heavy)
    numbers = session_numbers(
        parted(keys, visitor, heavy)[1], visitor=visitor, time=time, gap_ms=gap_ms
    )
    return _sorted_sessions(light, visitor, time, gap_ms).unionByName(
        _numbered(busy, numbers, visitor, time, gap_ms)
    )


def _sorted_sessions(events: DataFrame, visitor: str, time: str, gap_ms: int) -> DataFrame:
    in_order = Window.partitionBy(visitor).orderBy(time)
    silence = F.col(time) - F.lag(time).over(in_order)
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        events.filter(F.col(visitor).isNotNull() & F.col(time).isNotNull())
        .withColumn("_starts", F.when(silence <= gap_ms, 0).otherwise(1))
        .withColumn("session_number", F.sum("_starts").over(so_far))
        .drop("_starts")
        .withColumn("session_id", F.concat_ws("-", F.col(visitor), F.col("session_number")))
    )


def _numbered(
    events: DataFrame, numbers: DataFrame, visitor: str, time: str, gap_ms: int
) -> DataFrame:
    return (
        events.withColumn("_bucket", _bucket(time, gap_ms))
        .join(numbers, [visitor, "_bucket"])
        .drop("_bucket")
        .withColumn("session_id", F.concat_ws("-", F.col(visitor), F.col("session_number")))
    )


def open_sessions(
    rows: DataFrame, earlier: DataFrame | None = None, *, visitor: str = "visitorid",
    time: str = "timestamp",
) -> DataFrame:
    """``(visitor, open_until, open_number)``: each visitor's last event and the number of its
    session, over sessionized rows and the open sessions before them."""
    last = rows.groupBy(visitor).agg(
        F.max(time).alias("open_until"), F.max("session_number").alias("open_number")
    )
    if earlier is None:
        return last
    return last.unionByName(earlier).groupBy(visitor).agg(
        F.max("open_until").alias("open_until"), F.max("open_number").alias("open_number")
    )


def continue_sessions(
    events: DataFrame, held: DataFrame, still_open: DataFrame, *, visitor: str = "visitorid",
    time: str = "timestamp", gap_minutes: float = 30,
) -> DataFrame:
    """A load's rows, sessionized as if they had come together with the rows ``held`` before.

    ``still_open`` is :func:`open_sessions` of ``held``; a visitor's first session of the load
    extends the open one when no more than the gap lies between.  A visitor with an event
    older than the last held one may have sessions joined or renumbered: all its rows, held
    ones included, are numbered anew and returned, to replace those of the same id.  ``held``
    is read for such visitors only, and not at all when there are none.
    """
    gap_ms = int(gap_minutes * 60_000)
    firsts = events.groupBy(visitor).agg(F.min(time).alias("_first"))
    met = materialize(firsts.join(still_open, visitor))
    late = met.filter(F.col("_first") < F.col("open_until")).select(visitor)
    shifts = met.select(
        visitor,
        (
            F.col("open_number")
            - F.when(F.col("_first") - F.col("open_until") <= gap_ms, 1).otherwise(0)
        ).alias("_shift"),
    )
    on_time = events.join(late, visitor, "left_anti")
    numbers = session_numbers(on_time, visitor=visitor, time=time, gap_ms=gap_ms)
    shifted = (
        numbers.join(shifts, visitor, "left")
        .withColumn(
            "session_number", F.col("session_number") + F.coalesce("_shift", F.lit(0))
        )
        .drop("_shift")
    )
    result = _numbered(on_time, shifted, visitor, time, gap_ms).select(
        *events.columns, "session_number", "session_id"
    )
    if late.isEmpty():
        return result
    again = events.unionByName(held.select(*events.columns)).join(late, visitor, "left_semi")
    return result.unionByName(
        with_sessions(again, visitor=visitor, time=time, gap_minutes=gap_minutes)
        .select(*result.columns)
    )

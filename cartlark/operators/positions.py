"""Positions in a total order, without a window over the whole table.

``with_position`` range-sorts the rows (the sampled ranges split any hot value, because a
per-row tie-break ends the order), keeps the sorted runs in a reliable checkpoint, and
adds each run's offset.  ``nth_key`` finds a single row of the order by counting ever
narrower key ranges, so that a split by position needs no sort of the table at all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartlark.session import materialize

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in its low 33 bits
_TIE = "_tie"


def _sorted_runs(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """Checkpointed rows with ``_run`` (index of the sorted run) and ``_row`` (place in it)."""
    placed = materialize(
        df.withColumn(_TIE, F.monotonically_increasing_id())
        .orderBy(*order, _TIE)
        .drop(_TIE)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    return placed.select(
        *df.columns,
        F.shiftright("_place", _ROW_BITS).alias("_run"),
        F.col("_place").bitwiseAND((1 << _ROW_BITS) - 1).alias("_row"),
    )


def _run_summary(runs: DataFrame, *aggregates: Column) -> DataFrame:
    """One row per sorted run, so at most one per shuffle partition: safe to broadcast and
    to look over in a single window."""
    return runs.groupBy("_run").agg(F.count("*").alias("_size"), *aggregates)


def with_position(
    df: DataFrame, order: Sequence[Column | str], column: str = "position"
) -> DataFrame:
    """Adds the 0-based position of every row in ``order``."""
    runs = _sorted_runs(df, order)
    earlier = Window.orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    offsets = _run_summary(runs).select(
        "_run", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset")
    )
    return (
        runs.join(F.broadcast(offsets), "_run")
        .withColumn(column, F.col("_offset") + F.col("_row"))
        .drop("_run", "_row", "_offset")
    )


def with_previous(
    df: DataFrame, order: Sequence[Column | str], value: str, column: str = "previous"
) -> DataFrame:
    """Adds the value of the preceding row of the whole order (null for the first row)."""
    runs = _sorted_runs(df, order)
    carried = _run_summary(runs, F.max_by(value, "_row").alias("_last")).select(
        "_run", F.lag("_last").over(Window.orderBy("_run")).alias("_carried")
    )
    in_run = Window.partitionBy("_run").orderBy("_row")
    return (
        runs.join(F.broadcast(carried), "_run")
        .withColumn(
            column,
            F.when(F.col("_row") == 0, F.col("_carried")).otherwise(F.lag(value).over(in_run)),
        )
        .drop("_run", "_row", "_carried")
    )


def dense_index(df: DataFrame, column: str, index: str = "index") -> DataFrame:
    """Sorted distinct values numbered from zero."""
    return with_position(df.select(column).distinct(), [column], index)


def index_entries(
    held: DataFrame, df: DataFrame, column: str, index: str = "index"
) -> DataFrame:
    """What to append to the dictionary ``held(column, index)`` so that it knows all of ``df``.

    Old indices stay as they are; values not yet held are numbered in order from the next
    free one.  Null gets no index, and rows that were seen before add nothing."""
    values = df.select(column).filter(F.col(column).isNotNull()).distinct()
    free = held.agg(F.coalesce(F.max(index) + 1, F.lit(0)).alias("free")).scalar()
    fresh = with_position(values.join(held, column, "left_anti"), [column], index)
    return fresh.withColumn(index, F.col(index) + free)


def nth_key(
    df: DataFrame, keys: Sequence[str], n: int, *, fanout: int = 1024, leaf: int = 65_536
) -> Row:
    """The ``n``-th (1-based) key tuple in ascending order of ``keys``.

    Every step counts the remaining rows in at most ``fanout`` ranges of one key (or per
    next character of a text key), reads those few counts, and keeps the range that holds
    the row.  Only when at most ``leaf`` rows remain are they sorted.  Keys must not be null.
    """
    rows = df.select(*keys)
    rank = n
    for key in keys:
        numeric = isinstance(df.schema[key].dataType, T.IntegralType)
        narrow = _narrow_number if numeric else _narrow_text
        rows, rank, finished = narrow(rows, key, rank, fanout, leaf)
        if finished:
            break
    # Either few rows remain, or all that remain are equal in every key.
    if not finished:
        return rows.first()
    return nth_of_few(rows, keys, rank)


def nth_of_few(rows: DataFrame, keys: Sequence[str], n: int) -> Row:
    """The ``n``-th (1-based) key tuple of a table small enough to be sorted at once."""
    first = rows.orderBy(*keys).limit(n)
    return first.agg(F.max(F.struct(*keys)).alias("k")).first()["k"]


def _pick(counts: list[Row], rank: int) -> tuple[Row, int]:
    for row in sorted(counts, key=lambda r: r["slot"]):
        if rank <= row["n"]:
            return row, rank
        rank -= row["n"]
    raise ValueError("position lies beyond the table")


def _narrow_number(rows: DataFrame, key: str, rank: int, fanout: int, leaf: int):
    while True:
        low, high, n = rows.agg(F.min(key), F.max(key), F.count("*")).first()
        if n <= leaf:
            return rows, rank, True
        if low == high:
            return rows, rank, False
        width = (high - low) // fanout + 1
        slot = F.expr(f"(cast(`{key}` as decimal(38,0)) - {low}) div {width}")
        counts = rows.groupBy(slot.alias("slot")).count().withColumnRenamed("count", "n")
        chosen, rank = _pick(counts.collect(), rank)
        start = low + int(chosen["slot"]) * width
        rows = rows.filter(F.col(key).between(start, min(start + width - 1, high)))


def _narrow_text(rows: DataFrame, key: str, rank: int, fanout: int, leaf: int):
    place = 1
    while True:
        low, high, n = rows.agg(F.min(key), F.max(key), F.count("*")).first()
        if n <= leaf:
            return rows, rank, True
        if low == high:
            return rows, rank, False
        slot = F.substring(key, place, 1)
        counts = rows.groupBy(slot.alias("slot")).count().withColumnRenamed("count", "n")
        chosen, rank = _pick(counts.collect(), rank)
        rows = rows.filter(slot == chosen["slot"])
        place += 1

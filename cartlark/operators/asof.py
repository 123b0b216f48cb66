"""As-of lookup: the value last observed at or before a time, per key.

Few observations (a checked number of rows, and of rows per key) are broadcast as validity
intervals, and the large side is not shuffled at all.

Beyond that bound a key of a bounded number of rows is one group: rows and observations are
shuffled once, by the key, and sorted by time.  For heavier keys neither side is expanded and
no group grows with the key.  Every distinct ``(key, time)`` is resolved once (copies collapse before the shuffle), inside
groups of one key and one time bucket, which hold at most one row per time unit of the
bucket.  What a bucket inherits comes from a second, much smaller pass with one row per key
and bucket.  Putting the answer back on the rows is an equi-join on ``(key, time)``, where
adaptive execution splits a hot pair because only the row side is large.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartlark.functions.numbers import floor_div
from cartlark.operators.heavy import LIGHT_ROWS, heavy_keys, parted
from cartlark.session import materialize

HOUR_MS = 3_600_000
# What may be broadcast: rows, and bytes at their values' own size beside some for the row.
# The third limit bounds the intervals that one row is compared with.
BROADCAST_ROWS, BROADCAST_BYTES, ROW_BYTES = 1_000_000, 128 << 20, 64
BROADCAST_ROWS_PER_KEY = 64


def asof_lookup(
    probes: DataFrame, observations: DataFrame, *, key: str, time: str, value: str,
    bucket_width: int = HOUR_MS,
) -> DataFrame:
    """``(key, time, value)`` for every distinct probe; value is null before the first
    observation.  Equal observation times keep the largest value."""
    value_type = observations.schema[value].dataType
    points = (
        probes.select(key, time, F.lit(None).cast(value_type).alias(value), F.lit(1).alias("_probe"))
        .unionByName(observations.select(key, time, value, F.lit(0).alias("_probe")))
        .groupBy(key, time)
        .agg(F.max(value).alias("_seen"), F.max("_probe").alias("_probe"))
        .withColumn("_bucket", floor_div(F.col(time), bucket_width))
    )
    within = (
        Window.partitionBy(key, "_bucket").orderBy(time)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    before = (
        Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    last_time = F.when(F.col("_seen").isNotNull(), F.col(time))
    inherited = (
        points.groupBy(key, "_bucket")
        .agg(F.max_by("_seen", last_time).alias("_last"), F.max("_probe").alias("_probe"))
        .withColumn("_inherited", F.last("_last", ignorenulls=True).over(before))
        .filter("_probe = 1")
        .select(key, "_bucket", "_inherited")
    )
    return (
        points.withColumn("_within", F.last("_seen", ignorenulls=True).over(within))
        .filter("_probe = 1")
        .join(inherited, [key, "_bucket"], "left")
        .select(key, time, F.coalesce("_within", "_inherited").alias(value))
    )


def _fits_broadcast(
    observations: DataFrame, key: str, value: str, rows: int, rows_per_key: int
) -> bool:
    if rows == 0 or observations.count() > rows:
        return False
    held = sum(
        (F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in (key, value)),
        F.lit(ROW_BYTES),
    )
    sizes = observations.groupBy(key).agg(F.count("*").alias("n"), F.sum(held).alias("bytes"))
    total, largest, size = sizes.agg(F.sum("n"), F.max("n"), F.sum("bytes")).first()
    return total is None or (
        total <= rows and largest <= rows_per_key and size <= BROADCAST_BYTES
    )


def asof_join(
    rows: DataFrame, observations: DataFrame, *, key: str, time: str, value: str,
    unique: bool = False, bucket_width: int = HOUR_MS, broadcast_rows: int = BROADCAST_ROWS,
    broadcast_rows_per_key: int = BROADCAST_ROWS_PER_KEY, light_rows: int = LIGHT_ROWS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """``rows`` plus the as-of value.  With ``unique``, rows that are equal in every column
    are returned once, which light keys get without a shuffle of its own.  ``counted`` may
    name a cheaper frame to find heavy keys in: the keys of all rows and observations, others
    among them (a key that counts as heavy without need has the same result)."""
    if _fits_broadcast(observations, key, value, broadcast_rows, broadcast_rows_per_key):
        found = rows.distinct() if unique else rows
        return _broadcast_asof_join(found, observations, key, time, value)
    if counted is None:
        counted = rows.select(key).unionByName(observations.select(key))
    heavy = heavy_keys(counted, key, light_rows)
    light, busy = (rows, None) if heavy is None else parted(rows, key, heavy)
    told = observations if heavy is None else parted(observations, key, heavy)[0]
    found = _sorted_asof_join(light, told, key, time, value)
    if unique:
        found = found.distinct()
    if busy is None:
        return found
    busy = busy.distinct() if unique else busy
    answers = asof_lookup(
        busy, parted(observations, key, heavy)[1], key=key, time=time, value=value,
        bucket_width=bucket_width,
    )
    return found.unionByName(busy.join(answers, [key, time], "left"))


def _sorted_asof_join(
    rows: DataFrame, observations: DataFrame, key: str, time: str, value: str
) -> DataFrame:
    """Rows and observations of a key in one order of time; at equal times observations come
    first, the largest value last."""
    told = observations.filter(F.col(key).isNotNull() & F.col(time).isNotNull()).select(
        F.col(key).cast(rows.schema[key].dataType), F.col(time).cast(rows.schema[time].dataType),
        F.col(value).alias("_seen"), F.lit(False).alias("_asks"),
    )
    until = (
        Window.partitionBy(key).orderBy(time, "_asks", "_seen")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        rows.withColumn("_asks", F.lit(True)).unionByName(told, allowMissingColumns=True)
        .withColumn(value, F.last("_seen", ignorenulls=True).over(until))
        .filter("_asks").select(*rows.columns, value)
    )


def _broadcast_asof_join(
    rows: DataFrame, observations: DataFrame, key: str, time: str, value: str
) -> DataFrame:
    intervals = (
        observations.groupBy(F.col(key).alias("_key"), F.col(time).alias("_from"))
        .agg(F.max(value).alias(value))
        .withColumn("_to", F.lead("_from").over(Window.partitionBy("_key").orderBy("_from")))
    )
    inside = (
        (F.col(key) == F.col("_key"))
        & (F.col(time) >= F.col("_from"))
        & (F.col("_to").isNull() | (F.col(time) < F.col("_to")))
    )
    return rows.join(F.broadcast(intervals), inside, "left").drop("_key", "_from", "_to")


def validity_intervals(
    observations: DataFrame, *, key: str, time: str, start: str = "valid_from_ms",
    end: str = "valid_to_ms", bucket_width: int = 24 * HOUR_MS,
) -> DataFrame:
    """``[start, end)`` per observation; the last one of a key stays open (null end).

    ``observations`` has one row per key and time.  The next start is looked up within a
    key's time bucket, and for a bucket's last row in the first row of the key's next
    bucket, so that a key with very many observations is still split.
    """
    bucketed = observations.withColumnRenamed(time, start).withColumn(
        "_bucket", floor_div(F.col(start), bucket_width)
    )
    following = (
        bucketed.groupBy(key, "_bucket").agg(F.min(start).alias("_first"))
        .withColumn("_next", F.lead("_first").over(Window.partitionBy(key).orderBy("_bucket")))
        .select(key, "_bucket", "_next")
    )
    return (
        bucketed.withColumn(
            end, F.lead(start).over(Window.partitionBy(key, "_bucket").orderBy(start))
        )
        .join(following, [key, "_bucket"])
        .withColumn(end, F.coalesce(end, "_next"))
        .drop("_bucket", "_next")
    )


def interval_changes(
    held: DataFrame, observations: DataFrame, *, key: str, time: str, value: str,
    start: str = "valid_from_ms", end: str = "valid_to_ms", bucket_width: int = 24 * HOUR_MS,
) -> tuple[DataFrame, DataFrame]:
    """``(outdated, current)``: the rows of ``held`` that new observations end, split or revalue,
    and the rows that take their place.

    ``held`` is a stored :func:`validity_intervals` table with ``value``.  Observations come
    in any order, late ones and repeated ones included; equal times keep the largest value, and
    values are not null.  Only keys with new observations are looked at, only intervals that
    hold one are replaced, and neither step puts a whole key into one group: the end of an
    outdated interval, or the first start after the earliest observation, stands in for the
    rows behind it.
    """
    fresh = materialize(
        observations.groupBy(key, F.col(time).alias(start)).agg(F.max(value).alias(value))
    )
    own = held.join(fresh.select(key).distinct(), key, "left_semi")
    reached = materialize(
        asof_lookup(
            fresh, own.withColumn("_holder", F.col(start)), key=key, time=start,
            value="_holder", bucket_width=bucket_width,
        )
    )
    holders = reached.select(key, F.col("_holder").alias(start)).dropna().distinct()
    outdated = materialize(own.join(holders, [key, start], "left_semi"))
    early = reached.filter(F.col("_holder").isNull()).select(key).distinct()
    borders = (
        outdated.filter(F.col(end).isNotNull()).select(key, F.col(end).alias(start))
        .unionByName(own.join(early, key, "left_semi").groupBy(key).agg(F.min(start).alias(start)))
        .select(key, start, F.lit(None).cast(fresh.schema[value].dataType).alias(value))
    )
    points = (
        outdated.select(key, start, value).unionByName(fresh)
        .withColumn("_own", F.lit(True))
        .unionByName(borders.withColumn("_own", F.lit(False)))
        .groupBy(key, start).agg(F.max(value).alias(value), F.max("_own").alias("_own"))
    )
    current = validity_intervals(
        points, key=key, time=start, start=start, end=end, bucket_width=bucket_width
    )
    return outdated, current.filter("_own").select(*held.columns)


def extend_intervals(
    held: DataFrame, observations: DataFrame, *, key: str, time: str, value: str,
    start: str = "valid_from_ms", end: str = "valid_to_ms", bucket_width: int = 24 * HOUR_MS,
) -> DataFrame:
    """``held`` with new and late observations merged in: what :func:`validity_intervals` gives
    for all observations at once."""
    outdated, current = interval_changes(
        held, observations, key=key, time=time, value=value, start=start, end=end,
        bucket_width=bucket_width,
    )
    return held.join(outdated.select(key, start), [key, start], "left_anti").select(
        *held.columns
    ).unionByName(current)

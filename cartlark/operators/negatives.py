"""Deterministic negative sampling and the weighted pairwise loss.

A row's negative is found by starting at ``(position * stride + seed) mod items`` and
walking up, around the end, past every item the user has interacted with.  Walking is a
lookup: the user's seen item indices are folded into blocks of consecutive ones, and a
start that falls into a block moves to the index after it.

A user of a bounded number of rows is one group: rows and blocks are shuffled once, by the
user, and sorted by index.  For heavier users both are cut into chunks of the index range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartlark.functions.numbers import floor_div
from cartlark.functions.vectors import dot, softplus, unit
from cartlark.operators.asof import asof_lookup
from cartlark.operators.heavy import LIGHT_ROWS, heavy_keys, parted

# The walk's stride and the extra seed of validation rows.
STRIDE = 9973
VALIDATION_SEED_OFFSET = 1_000_003
CHUNK = 65_536


def _seen_blocks(seen: DataFrame, chunk: int) -> DataFrame:
    """``(user_index, first, after)``: maximal runs of consecutive seen indices, as one row
    per run and index chunk, each with the index that follows the whole run.

    Runs are folded inside chunks of the index range, so no group outgrows a chunk; only
    runs that touch a chunk edge are then joined up, at most two per chunk.
    """
    in_chunk = Window.partitionBy("user_index", "_chunk").orderBy("item_index")
    runs = (
        seen.withColumn("_chunk", floor_div(F.col("item_index"), chunk))
        .withColumn("_fold", F.col("item_index") - F.row_number().over(in_chunk))
        .groupBy("user_index", "_chunk", "_fold")
        .agg(F.min("item_index").alias("first"), F.max("item_index").alias("last"))
        .withColumn(
            "_edge",
            (F.pmod("first", F.lit(chunk)) == 0) | (F.pmod("last", F.lit(chunk)) == chunk - 1),
        )
    )
    per_user = Window.partitionBy("user_index").orderBy("first")
    joined = (
        runs.filter("_edge")
        .withColumn(
            "_new", F.when(F.col("first") == F.lag("last").over(per_user) + 1, 0).otherwise(1)
        )
        .withColumn(
            "_chain",
            F.sum("_new").over(per_user.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        )
        .withColumn(
            "_end", F.max("last").over(Window.partitionBy("user_index", "_chain"))
        )
        .select("user_index", "first", (F.col("_end") + 1).alias("after"))
    )
    inner = runs.filter("not _edge").select("user_index", "first", (F.col("last") + 1).alias("after"))
    return joined.unionByName(inner)


def _walk(starts: DataFrame, seen: DataFrame, item_count: int, chunk: int) -> DataFrame:
    """``(user_index, start, landing)`` for distinct ``(user_index, start)``: the first index
    from ``start`` on, around the end, that the user has not seen (any index for a user who
    has seen all)."""
    blocks = _seen_blocks(seen, chunk)
    covering = asof_lookup(
        starts,
        blocks.select(
            "user_index", F.col("first").alias("start"), F.col("after").alias("_after")
        ),
        key="user_index", time="start", value="_after", bucket_width=chunk,
    )
    # A run that reaches the end continues with the run that starts at zero, if any.
    wrapped = blocks.filter("first = 0").select("user_index", F.col("after").alias("_wrap"))
    onward = F.when(F.col("_after") > F.col("start"), F.col("_after")).otherwise(F.col("start"))
    return (
        covering.join(wrapped, "user_index", "left")
        .select(
            "user_index",
            "start",
            F.when(onward < item_count, onward)
            .otherwise(F.coalesce("_wrap", F.lit(0)))
            .alias("landing"),
        )
    )


def _in_groups(asking: DataFrame, seen: DataFrame, item_count: int) -> DataFrame:
    """``asking(user_index, _start, ...)`` with ``_landing``, the end of the walk from
    ``_start``, and ``_second``, that of the walk from the index after it; each user is one
    group."""
    by_item = Window.partitionBy("user_index").orderBy("item_index")
    blocks = (
        seen.withColumn("_fold", F.col("item_index") - F.row_number().over(by_item))
        .groupBy("user_index", "_fold")
        .agg(F.min("item_index").alias("_start"), (F.max("item_index") + 1).alias("_after"))
        .drop("_fold").withColumn("_asks", F.lit(False))
    )
    start, after = F.col("_start"), F.col("_after")
    user = Window.partitionBy("user_index")
    # At equal indices a block is met before the row that asks, and one behind it is not.
    so_far = (Window.unboundedPreceding, Window.currentRow)
    upward = user.orderBy("_start", "_asks").rowsBetween(*so_far)
    downward = user.orderBy(F.desc("_start"), F.desc("_asks")).rowsBetween(*so_far)
    from_zero = F.coalesce(F.max(F.when(~F.col("_asks") & (start == 0), after)).over(user), F.lit(0))
    behind_zero = F.max(F.when(~F.col("_asks") & (start == F.col("_zero") + 1), after)).over(user)
    onward = F.greatest(start, F.last("_after", ignorenulls=True).over(upward))
    next_block = F.last(F.when(~F.col("_asks"), F.struct("_start", "_after")), ignorenulls=True)
    one_on = F.col("_onward") + 1
    past_next = F.when(F.col("_next._start") == one_on, F.col("_next._after")).otherwise(one_on)

    def around(index: Column) -> Column:
        return F.when(index < item_count, index).otherwise(F.col("_zero"))

    return (
        asking.withColumn("_asks", F.lit(True)).unionByName(blocks, allowMissingColumns=True)
        .withColumn("_zero", from_zero)
        .withColumn("_behind_zero", F.coalesce(behind_zero, F.col("_zero") + 1))
        .withColumn("_onward", onward)
        .withColumn("_next", next_block.over(downward))
        .filter("_asks")
        .withColumn("_landing", around(F.col("_onward")))
        .withColumn(
            "_second",
            F.when(F.col("_onward") < item_count, around(past_next))
            .otherwise(around(F.col("_behind_zero"))),
        )
        .select(*asking.columns, "_landing", "_second")
    )


def _in_chunks(
    asking: DataFrame, seen: DataFrame, item_count: int, chunk: int, twice: bool
) -> DataFrame:
    """The same, by lookups in chunks of the index range; ``_second`` is null unless ``twice``."""
    starts = asking.select("user_index", F.col("_start").alias("start"))
    first = _walk(starts, seen, item_count, chunk).withColumnsRenamed(
        {"start": "_start", "landing": "_landing"}
    )
    landed = asking.join(first, ["user_index", "_start"])
    if not twice:
        nothing = F.lit(None).cast("bigint").alias("_second")
        return landed.select(*asking.columns, "_landing", nothing)
    landed = landed.withColumn("_next", F.pmod(F.col("_landing") + 1, F.lit(item_count)))
    starts = landed.select("user_index", F.col("_next").alias("start"))
    second = _walk(starts, seen, item_count, chunk).withColumnsRenamed(
        {"start": "_next", "landing": "_second"}
    )
    return landed.join(second, ["user_index", "_next"]).select(
        *asking.columns, "_landing", "_second"
    )


def _landed(
    asking: DataFrame, seen: DataFrame, users: DataFrame, item_count: int, chunk: int,
    light_rows: int, twice: bool,
) -> DataFrame:
    """:func:`_in_groups` for light users, :func:`_in_chunks` for the others; ``users`` has the
    user of every row that asks."""
    seen = seen.select("user_index", "item_index")
    counted = users.select("user_index").unionByName(seen.select("user_index"))
    heavy = heavy_keys(counted, "user_index", light_rows)
    if heavy is None:
        return _in_groups(asking, seen, item_count)
    light, busy = parted(asking, "user_index", heavy)
    light_seen, busy_seen = parted(seen, "user_index", heavy)
    return _in_groups(light, light_seen, item_count).unionByName(
        _in_chunks(busy, busy_seen, item_count, chunk, twice)
    )


def _require_some(finished: DataFrame, candidates: DataFrame) -> None:
    """Fails where users have seen everything and no row is left.  Mostly there is no such
    user, and the rows are not looked at."""
    if not finished.isEmpty() and candidates.isEmpty():
        raise ValueError("no user has an item left that could be a negative")


def negative_samples(
    rows: DataFrame, seen: DataFrame, item_count: int, *, seed: int = 42, seed_offset: int = 0,
    rows_are_seen: bool = False, chunk: int = CHUNK, light_rows: int = LIGHT_ROWS,
) -> DataFrame:
    """Adds ``negative_index`` to ``rows(position, user_index, item_index, ...)``.

    ``seen`` holds distinct training ``(user_index, item_index)``.  The row's own item is
    never its negative either.  Rows of users who have no other item left are dropped.  It
    is an error if no item is left for any of the users.
    ``rows_are_seen`` says that ``seen`` was taken from these very rows, which makes the
    checks for own items outside it unnecessary.
    """
    start = F.pmod(
        F.col("position") * F.lit(STRIDE) + F.lit(seed + seed_offset), F.lit(item_count)
    )
    rows_with_start = rows.withColumn("_start", start)
    # Only users who have seen all items, or all but one, can run out of negatives.
    nearly_done = (
        seen.groupBy("user_index").agg(F.count("*").alias("_seen"))
        .filter(F.col("_seen") >= item_count - 1)
    )
    if rows_are_seen:
        done = nearly_done.filter(F.col("_seen") >= item_count)
        candidates = rows_with_start.join(done, "user_index", "left_anti")
        _require_some(done, candidates)
        landed = _landed(candidates, seen, rows, item_count, chunk, light_rows, twice=False)
        return landed.select(*rows.columns, F.col("_landing").alias("negative_index"))

    own = seen.withColumn("_own_seen", F.lit(True))
    own_unseen = F.col("_own_seen").isNull()
    blocked = F.col("_seen") + F.when(own_unseen, 1).otherwise(0)
    candidates = (
        rows_with_start.join(nearly_done, "user_index", "left")
        .join(own, ["user_index", "item_index"], "left")
        .filter(F.col("_seen").isNull() | (blocked < item_count))
        .drop("_seen")
    )
    _require_some(nearly_done, candidates)
    # An item that was not seen in training can be where the walk lands; walk on from it.
    return (
        _landed(candidates, seen, rows, item_count, chunk, light_rows, twice=True)
        .withColumn(
            "negative_index",
            F.when(
                own_unseen & (F.col("_landing") == F.col("item_index")), F.col("_second")
            ).otherwise(F.col("_landing")),
        )
        .select(*rows.columns, "negative_index")
    )


def pairwise_loss(triples: DataFrame, user_vectors: DataFrame, item_vectors: DataFrame) -> DataFrame:
    """Weighted mean of ``softplus(-(positive - negative))`` over ``triples(user_id, item_id,
    negative_id, weight)`` whose three vectors exist; scores are cosines.  Equal triples are
    folded before vectors are joined to them."""
    triples = triples.groupBy("user_id", "item_id", "negative_id").agg(
        F.sum("weight").alias("weight"), F.count("*").alias("_n")
    )
    users = user_vectors.select("user_id", unit(F.col("embedding")).alias("_user"))
    items = item_vectors.select("item_id", unit(F.col("embedding")).alias("_item"))
    positives = items.withColumnRenamed("_item", "_positive")
    negatives = items.withColumnsRenamed({"item_id": "negative_id", "_item": "_negative"})
    margin = dot(F.col("_user"), F.col("_positive")) - dot(F.col("_user"), F.col("_negative"))
    return (
        triples.join(users, "user_id").join(positives, "item_id").join(negatives, "negative_id")
        .select("weight", "_n", softplus(-margin).alias("_loss"))
        .agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("triples"),
            F.round(
                F.try_divide(F.sum(F.col("weight") * F.col("_loss")), F.sum("weight")), 6
            ).alias("loss"),
        )
    )

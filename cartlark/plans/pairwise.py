"""A pairwise learner with side features: one growing fit whose every epoch is a stored version.

A user's vector is a part of its own plus a linear map of the user's features; an item's is a
part of its own, plus a linear map of its features, plus its category's vector.  Scores are
cosines, and the loss of an interaction against a negative is the weighted softplus of the
scores' difference, as in evaluation.

Users and items are dealt into as many blocks each.  An epoch has one step per block: in a
step every user block meets one item block, no two the same, so blocks are updated side by
side and nothing is locked.  Item blocks are dealt anew in every epoch, and a negative is an
unseen item of the block at hand, which needs no lookup outside it.  Maps and categories are
copied to each block that uses them and averaged after the step, weighted by the pairs that
moved them.  Equal pairs are folded first, so a hot user or item holds at most one pair per
partner in a block.

State lies under ``path``: the prepared pairs, ``state/epoch=n`` after epoch ``n``, and one
history row per finished epoch, written last.  A fit that is started again goes on after its
last history row, and since all choices are drawn by digests of seed, epoch and ids, it ends
with the same vectors as a fit that was never stopped.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass
from math import ceil, sqrt
from typing import Any

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlark.functions.contract import EVENT_TYPES
from cartlark.functions.vectors import unit
from cartlark.operators.negatives import VALIDATION_SEED_OFFSET, pairwise_loss
from cartlark.plans.interactions import (
    indexed_interactions,
    item_features,
    item_latest_category,
    known_interactions,
    user_features,
    vocabulary,
)
from cartlark.plans.recommend import Embeddings, _triples, best_epoch

#: Rows of one side and folded pairs that a block may hold.
BLOCK_ROWS = 100_000
BLOCK_PAIRS = 1_000_000
START_SCALE = 0.1
USER_FEATURES = [f"{event}_feature" for event in EVENT_TYPES]
ITEM_FEATURES = ["events_feature", "users_feature"]
_TINY = 1e-12
_STATE = "kind string, id bigint, vector array<double>, moved double, features array<double>, category bigint"
_STEP = f"block int, {_STATE}, pairs bigint, loss double, weight double"
_HISTORY = (
    "epoch int, train_pairs bigint, train_loss double, validation_triples bigint, "
    "validation_loss double"
)


@dataclass(frozen=True)
class Settings:
    """What a fit depends on besides its rows; ``blocks`` of 0 are chosen from row counts."""

    rank: int = 32
    rate: float = 0.1
    decay: float = 1e-4
    batch: int = 256
    seed: int = 42
    blocks: int = 0


# --- one block --------------------------------------------------------------------------------


def _directions(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    length = np.maximum(np.linalg.norm(x, axis=1, keepdims=True), _TINY)
    return x / length, length


def pair_gradients(user, positive, negative, weight):
    """Weighted losses of a batch, and their gradients by the three vectors of each row."""
    u, u_length = _directions(user)
    p, p_length = _directions(positive)
    n, n_length = _directions(negative)
    up, un = (u * p).sum(1, keepdims=True), (u * n).sum(1, keepdims=True)
    margin = up - un
    loss = np.logaddexp(0.0, -margin[:, 0]) * weight
    slope = -weight[:, None] / (1.0 + np.exp(margin))
    return (
        loss,
        slope * (p - n - u * margin) / u_length,
        slope * (u - p * up) / p_length,
        -slope * (u - n * un) / n_length,
    )


class Part:
    """Rows of one kind with the sum of their squared gradients (row-wise AdaGrad)."""

    def __init__(self, rows: pd.DataFrame, rank: int):
        self.ids = rows["id"].to_numpy(np.int64)
        self.vector = np.array(rows["vector"].tolist(), np.float64).reshape(-1, rank)
        self.moved = rows["moved"].to_numpy(np.float64).copy()

    def move(self, rows: np.ndarray, gradients: np.ndarray, settings: Settings) -> None:
        touched, place = np.unique(rows, return_inverse=True)
        total = np.zeros((len(touched), self.vector.shape[1]))
        np.add.at(total, place, gradients)
        total += settings.decay * self.vector[touched]
        self.moved[touched] += (total * total).mean(1)
        step = settings.rate / np.sqrt(self.moved[touched] + 1e-8)
        self.vector[touched] -= step[:, None] * total

    def at(self, ids: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ids, ids)


def unseen_items(user, item, start, items: int) -> np.ndarray:
    """For each pair the first item from ``start`` on, around the end, that the user has no
    pair with in the block; minus one where the user has one with every item."""
    codes = np.unique(user * items + item)
    found = np.where(np.bincount(codes // items)[user] < items, start % items, -1)
    while True:
        code = user * items + found
        place = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
        taken = (found >= 0) & (codes[place] == code)
        if not taken.any():
            return found
        found = np.where(taken, (found + 1) % items, found)


def update_block(
    rows: pd.DataFrame, settings: Settings, pairs: pd.DataFrame | None = None
) -> pd.DataFrame:
    """One pass over the pairs of a block, batch by batch; all rows of the block come back.
    Pairs come by themselves, or among the rows as their kind ``pair``."""
    by_kind = {
        kind: part.sort_values("id", ignore_index=True) for kind, part in rows.groupby("kind")
    }
    pairs = by_kind.pop("pair", None) if pairs is None else pairs
    parts = {kind: Part(part, settings.rank) for kind, part in by_kind.items()}
    met, loss_sum, weight_sum = 0, 0.0, 0.0
    if pairs is not None and len(pairs) and {"user", "item"} <= set(parts):
        users, items = parts["user"], parts["item"]
        pairs = pairs.sort_values(["turn", "id", "item"], ignore_index=True)
        user, item = users.at(pairs["id"].to_numpy()), items.at(pairs["item"].to_numpy())
        negative = unseen_items(user, item, pairs["start"].to_numpy(np.int64), len(items.ids))
        kept = negative >= 0
        user, item, negative = user[kept], item[kept], negative[kept]
        weight, met = pairs["weight"].to_numpy(np.float64)[kept], int(kept.sum())
        loss_sum, weight_sum = _pass(by_kind, parts, user, item, negative, weight, settings)
    out = [
        part.assign(vector=list(parts[kind].vector), moved=parts[kind].moved, pairs=met)
        for kind, part in by_kind.items()
    ]
    done = pd.concat(out, ignore_index=True).assign(loss=0.0, weight=0.0)
    done.loc[0, ["loss", "weight"]] = loss_sum, weight_sum
    return done[[field.split()[0] for field in _STEP.split(", ")]]


def _pass(rows, parts, user, item, negative, weight, settings) -> tuple[float, float]:
    features = {
        kind: np.array(rows[kind]["features"].tolist(), np.float64) for kind in ("user", "item")
    }
    category = parts["category"].at(rows["item"]["category"].to_numpy())
    maps = {kind: parts[f"{kind}_map"] for kind in ("user", "item")}
    own, total = {kind: parts[kind] for kind in ("user", "item")}, 0.0

    def items_at(places):
        return (own["item"].vector[places] + features["item"][places] @ maps["item"].vector
                + parts["category"].vector[category[places]])

    for first in range(0, len(user), settings.batch):
        mine = slice(first, first + settings.batch)
        u, p, n = user[mine], item[mine], negative[mine]
        vector = own["user"].vector[u] + features["user"][u] @ maps["user"].vector
        loss, by_user, by_item, by_negative = pair_gradients(
            vector, items_at(p), items_at(n), weight[mine]
        )
        total += float(loss.sum())
        both, by_both = np.r_[p, n], np.r_[by_item, by_negative]
        own["user"].move(u, by_user, settings)
        own["item"].move(both, by_both, settings)
        parts["category"].move(category[both], by_both, settings)
        for kind, places, gradient in (("user", u, by_user), ("item", both, by_both)):
            width = features[kind].shape[1]
            maps[kind].move(np.arange(width), features[kind][places].T @ gradient, settings)
    return total, float(weight.sum())


# --- Spark: preparation -------------------------------------------------------------------------


def _drawn(rank: int, seed: int) -> Column:
    """A small vector drawn by digests of seed, kind, id and place."""
    def value(place: Column) -> Column:
        digest = F.pmod(F.xxhash64(F.lit(seed), "kind", "id", place), F.lit(1 << 20))
        return (digest / float(1 << 20) - 0.5) * F.lit(2 * START_SCALE)

    return F.transform(F.sequence(F.lit(0), F.lit(rank - 1)), value)


def _features(table: DataFrame, key: str, columns: list[str]) -> DataFrame:
    values = F.array(*[F.coalesce(F.col(c), F.lit(0.0)) for c in columns])
    return table.select(F.col(key).alias("id"), values.alias("features"))


def start_state(train: DataFrame, settings: Settings) -> DataFrame:
    """State before the first epoch."""
    spark = train.sparkSession
    nothing = F.lit(None).cast("bigint").alias("category")
    no_features = F.lit(None).cast("array<double>").alias("features")
    users = _features(user_features(train), "user_id", USER_FEATURES).select(
        F.lit("user").alias("kind"), "id", "features", nothing
    )
    categories = item_latest_category(train)
    items = (
        _features(item_features(train), "item_id", ITEM_FEATURES)
        .join(categories.withColumnRenamed("item_id", "id"), "id")
        .select(F.lit("item").alias("kind"), "id", "features", "category_id")
    )
    named = categories.select("category_id").distinct().select(
        F.lit("category"), "category_id", no_features, nothing
    )
    maps = [("user_map", n) for n in range(len(USER_FEATURES))]
    maps += [("item_map", n) for n in range(len(ITEM_FEATURES))]
    maps = spark.createDataFrame(maps, "kind string, id bigint").select("*", no_features, nothing)
    return users.union(items).union(named).union(maps).select(
        "kind", "id", _drawn(settings.rank, settings.seed).alias("vector"),
        F.lit(0.0).alias("moved"), "features", "category",
    )


def _blocks(state: DataFrame, pairs: DataFrame) -> int:
    sides = [r["n"] for r in state.filter("kind in ('user', 'item')").groupBy("kind").agg(
        F.count("*").alias("n")).collect()]
    return max(1, ceil(max(sides, default=0) / BLOCK_ROWS), ceil(sqrt(pairs.count() / BLOCK_PAIRS)))


def _existing(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    try:
        spark.read.parquet(path)  # fails for a missing folder; a given schema would not be checked
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    return spark.read.schema(schema).parquet(path)


def prepare(
    train: DataFrame, validation: DataFrame | None, path: str, settings: Settings
) -> Settings:
    """Writes folded pairs, validation triples and the first state; the settings come last, and
    a fit that has them is not prepared again."""
    spark = train.sparkSession
    fields = "rank int, rate double, decay double, batch int, seed int, blocks int"
    known = _existing(spark, f"{path}/settings", fields)
    if known is not None:
        stored = Settings(**known.first().asDict())
        wanted = {**asdict(settings), "blocks": settings.blocks or stored.blocks}
        if stored != Settings(**wanted):
            raise ValueError(f"{path} holds a fit with other settings: {stored}")
        return stored
    train.filter("visitor_id is not null and item_id is not null").groupBy(
        F.col("visitor_id").alias("user"), F.col("item_id").alias("item")
    ).agg(F.sum("weight").cast("double").alias("weight")).write.mode("overwrite").parquet(
        f"{path}/pairs"
    )
    if validation is not None:
        users = vocabulary(train, "visitor_id", "user_index")
        items = vocabulary(train, "item_id", "item_index")
        seen = known_interactions(train, users, items).select("user_index", "item_index").distinct()
        _triples(
            indexed_interactions(validation, users, items), seen, items, items.count(),
            settings.seed, VALIDATION_SEED_OFFSET,
        ).write.mode("overwrite").parquet(f"{path}/triples")
    start_state(train, settings).write.mode("overwrite").parquet(f"{path}/state/epoch=0")
    pairs = spark.read.parquet(f"{path}/pairs")
    blocks = settings.blocks or _blocks(_state(spark, path, 0), pairs)
    chosen = Settings(**{**asdict(settings), "blocks": blocks})
    spark.createDataFrame([tuple(asdict(chosen).values())], fields).coalesce(1).write.mode(
        "overwrite").parquet(f"{path}/settings")
    return chosen


# --- Spark: epochs ------------------------------------------------------------------------------


def _state(spark: SparkSession, path: str, epoch: int) -> DataFrame:
    return spark.read.schema(_STATE).parquet(f"{path}/state/epoch={epoch}")


def _slot(column: str, settings: Settings, *salt: int) -> Column:
    digest = F.xxhash64(*map(F.lit, (settings.seed, *salt)), F.col(column))
    return F.pmod(digest, F.lit(settings.blocks)).cast("int")


def _step(
    state: DataFrame, pairs: DataFrame, epoch: int, step: int, settings: Settings
) -> DataFrame:
    """Every user block with its item block of this step; blocks are named by their users'.
    Pairs go beside the state, which has arrays, and users without a pair here stay outside."""
    user_block = _slot("id", settings)
    item_block = F.pmod(_slot("id", settings, epoch) - step, F.lit(settings.blocks)).cast("int")
    users = state.filter("kind = 'user'").withColumn("block", user_block)
    items = state.filter("kind = 'item'").withColumn("block", item_block)
    maps = state.filter("kind like '%_map'").withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(settings.blocks - 1)))
    )
    used = items.select("block", F.col("category").alias("id")).distinct()
    categories = state.filter("kind = 'category'").join(used, "id")
    met = pairs.filter(F.col("step") == step).select(
        F.col("user").alias("id"), "block", "item", "weight", "turn", "start"
    )
    rows = users
    if settings.blocks > 1:  # in a single block every user has a pair
        rows = users.join(met.select("id").distinct(), "id", "left_semi").select(*users.columns)
    for more in (items, maps, categories):
        rows = rows.unionByName(more)
    done = (
        rows.groupBy("block").cogroup(met.groupBy("block"))
        .applyInPandas(_updating(settings), _STEP)
    )
    if settings.blocks == 1:
        return done
    idle = users.join(met.select("id").distinct(), "id", "left_anti").withColumns(
        {"pairs": F.lit(0).cast("bigint"), "loss": F.lit(0.0), "weight": F.lit(0.0)}
    )
    return done.unionByName(idle)


def _updating(settings: Settings):
    def update(
        key: tuple[Any, ...], rows: pd.DataFrame, pairs: pd.DataFrame
    ) -> pd.DataFrame:
        return update_block(rows, settings, pairs).assign(block=key[0])

    return update


def _averaged(done: DataFrame) -> DataFrame:
    """Copies of maps and categories, averaged by the pairs of their blocks in block order."""
    copies = F.array_sort(F.collect_list(F.struct("block", "pairs", "vector", "moved")))
    shared = done.filter("kind not in ('user', 'item')").groupBy("kind", "id").agg(
        copies.alias("copies"), F.greatest(F.sum("pairs"), F.lit(1)).alias("n")
    )

    def mean(field: str, place: Column | None = None) -> Column:
        def value(copy: Column) -> Column:
            x = copy[field] if place is None else copy[field][place]
            return x * F.when(F.col("n") > 1, copy["pairs"] / F.col("n")).otherwise(
                F.lit(1.0) / F.size("copies"))

        weighed = F.aggregate("copies", F.lit(0.0), lambda total, copy: total + value(copy))
        first = F.col("copies")[0][field]
        alone = first if place is None else first[place]
        return F.when(F.size("copies") == 1, alone).otherwise(weighed)

    places = F.sequence(F.lit(0), F.size(F.col("copies")[0]["vector"]) - 1)
    return shared.select(
        "kind", "id", F.transform(places, lambda place: mean("vector", place)).alias("vector"),
        mean("moved").alias("moved"), F.lit(None).cast("array<double>").alias("features"),
        F.lit(None).cast("bigint").alias("category"),
    )


def run_epoch(spark: SparkSession, path: str, epoch: int, settings: Settings) -> None:
    """Epoch ``epoch`` from the stored state before it; its history row is written last."""
    pairs = spark.read.parquet(f"{path}/pairs")
    blocks = {"block": _slot("user", settings), "_item": _slot("item", settings, epoch)}
    drawn = [F.lit(settings.seed), F.lit(epoch), F.col("user"), F.col("item")]
    pairs.withColumns(blocks).select(
        "user", "item", "weight", "block", F.xxhash64(*drawn).alias("turn"),
        F.pmod(F.xxhash64(*drawn, F.lit(1)), F.lit(1 << 40)).alias("start"),
        F.pmod(F.col("_item") - F.col("block"), F.lit(settings.blocks)).alias("step"),
    ).write.mode("overwrite").partitionBy("step").parquet(f"{path}/work/pairs")
    dealt = spark.read.parquet(f"{path}/work/pairs")
    state, losses = _state(spark, path, epoch - 1), []
    for step in range(settings.blocks):
        target = f"{path}/work/step={step}"
        _step(state, dealt, epoch, step, settings).write.mode("overwrite").parquet(target)
        done = spark.read.schema(_STEP).parquet(target)
        own = done.filter("kind in ('user', 'item')").select(*_state_columns())
        state = own.unionByName(_averaged(done))
        per_block = done.groupBy("block").agg(
            F.max("pairs").alias("pairs"), F.sum("loss").alias("loss"), F.sum("weight").alias("weight")
        )
        losses.append(per_block.agg(F.sum("pairs"), F.sum("loss"), F.sum("weight")).first())
    state.write.mode("overwrite").parquet(f"{path}/state/epoch={epoch}")
    n, loss, weight = (sum(row[j] or 0 for row in losses) for j in range(3))
    triples = _existing(
        spark, f"{path}/triples", "user_id bigint, item_id bigint, negative_id bigint, weight double"
    )
    held_out = (0, None)
    if triples is not None:
        measured = pairwise_loss(triples, *vectors(spark, path, epoch)).first()
        held_out = measured["triples"], measured["loss"]
    row = (epoch, int(n), loss / weight if weight else None, *held_out)
    spark.createDataFrame([row], _HISTORY).coalesce(1).write.mode("append").parquet(
        f"{path}/history"
    )


def _state_columns() -> list[str]:
    return [field.split()[0] for field in _STATE.split(", ")]


def history(spark: SparkSession, path: str) -> DataFrame:
    """One row per finished epoch."""
    found = _existing(spark, f"{path}/history", _HISTORY)
    return spark.createDataFrame([], _HISTORY) if found is None else found


def vectors(spark: SparkSession, path: str, epoch: int) -> tuple[DataFrame, DataFrame]:
    """Unit vectors ``(user_id, embedding)`` and ``(item_id, embedding)`` after an epoch."""
    state = _state(spark, path, epoch)
    maps = state.filter("kind like '%_map'").collect()  # one row per feature

    def mapped(kind: str, place: Column) -> Column:
        total = F.lit(0.0)
        rows = sorted((r["id"], r["vector"]) for r in maps if r["kind"] == f"{kind}_map")
        for n, vector in rows:
            total = total + F.col("features")[n] * F.array(*map(F.lit, vector))[place]
        return total

    rank = len(maps[0]["vector"])
    places = F.sequence(F.lit(0), F.lit(rank - 1))
    user = F.transform(places, lambda j: F.col("vector")[j] + mapped("user", j))
    item = F.transform(
        places, lambda j: F.col("vector")[j] + mapped("item", j) + F.col("_category")[j]
    )
    categories = state.filter("kind = 'category'").select(
        F.col("id").alias("category"), F.col("vector").alias("_category")
    )
    # Whole vectors first, so that each is added up once and not for each use in its length.
    users = state.filter("kind = 'user'").select(F.col("id").alias("user_id"), user.alias("_whole"))
    items = state.filter("kind = 'item'").join(categories, "category").select(
        F.col("id").alias("item_id"), item.alias("_whole")
    )
    whole = unit(F.col("_whole")).alias("embedding")
    return users.select("user_id", whole), items.select("item_id", whole)


def learn(
    train: DataFrame, validation: DataFrame | None, path: str, *, epochs: int = 10,
    patience: int = 3, settings: Settings | None = None,
) -> Embeddings:
    """Runs epochs until ``epochs`` are finished or the best validation loss is ``patience``
    epochs old, from wherever the fit under ``path`` stands, and returns the best version."""
    spark = train.sparkSession
    chosen = prepare(train, validation, path, settings or Settings())
    while True:
        finished = history(spark, path)
        last = finished.agg(F.max("epoch")).first()[0] or 0
        best = best_epoch(finished).first()["best_epoch"] if last else 0
        if last >= epochs or (validation is not None and last - best >= patience):
            break
        run_epoch(spark, path, last + 1, chosen)
    return Embeddings(*vectors(spark, path, best), finished, best)

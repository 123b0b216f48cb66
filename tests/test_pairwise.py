import math
import random

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cartlark.plans import pairwise
from cartlark.plans.pairwise import Settings

SMALL = Settings(rank=6, batch=16, seed=3)


def planted(spark, users=40, items=30, n=1500, seed=0):
    """Users like the items of their own half, which have a category and a popularity of their own."""
    rng = random.Random(seed)
    rows = []
    for t in range(n):
        user = rng.randrange(users)
        half = rng.randrange(items // 2) * 2 + user % 2
        item = half if rng.random() < 0.95 else rng.randrange(items)
        kind, weight = rng.choice([("view", 1.0), ("addtocart", 3.0), ("transaction", 5.0)])
        rows.append((f"{t:05d}", user, 100 + item, kind, t, weight, item % 2 + 7))
    return spark.createDataFrame(
        rows, "event_id string, visitor_id bigint, item_id bigint, event_type string, n bigint, "
        "weight double, category_id bigint",
    ).withColumn("event_time", F.timestamp_seconds("n"))


def parts(spark):
    rows = planted(spark)
    return rows.filter("n < 700"), rows.filter("n >= 1100")


def as_arrays(vectors, key):
    return {r[key]: np.array(r["embedding"]) for r in vectors.collect()}


def test_gradients_agree_with_differences():
    rng = np.random.default_rng(0)
    u, p, n = rng.normal(size=(3, 4, 5))
    weight = rng.uniform(1, 5, 4)
    _, *gradients = pairwise.pair_gradients(u, p, n, weight)
    step = 1e-6
    for x, gradient in zip((u, p, n), gradients, strict=True):
        for place in np.ndindex(x.shape):
            x[place] += step
            above = pairwise.pair_gradients(u, p, n, weight)[0].sum()
            x[place] -= 2 * step
            below = pairwise.pair_gradients(u, p, n, weight)[0].sum()
            x[place] += step
            assert gradient[place] == pytest.approx((above - below) / (2 * step), abs=1e-6)


def by_hand(state, pairs, settings):
    """One epoch on one block with dictionaries and loops."""
    value = {(r["kind"], r["id"]): np.array(r["vector"]) for r in state}
    moved = dict.fromkeys(value, 0.0)
    features = {(r["kind"], r["id"]): r["features"] for r in state}
    category = {r["id"]: r["category"] for r in state if r["kind"] == "item"}
    items = sorted(category)
    seen = {}
    for r in pairs:
        seen.setdefault(r["user"], set()).add(r["item"])
    order = sorted(pairs, key=lambda r: (r["turn"], r["user"], r["item"]))
    order = [r for r in order if len(seen[r["user"]]) < len(items)]

    def whole(kind, i):
        out = value[kind, i] + sum(
            x * value[f"{kind}_map", n] for n, x in enumerate(features[kind, i]))
        return out + value["category", category[i]] if kind == "item" else out

    def cosine(a, b):
        return a @ b / np.linalg.norm(a) / np.linalg.norm(b)

    loss = weight = 0.0
    for first in range(0, len(order), settings.batch):
        slopes = {}
        for r in order[first : first + settings.batch]:
            place = r["start"] % len(items)
            while items[place] in seen[r["user"]]:
                place = (place + 1) % len(items)
            names = ("user", r["user"]), ("item", r["item"]), ("item", items[place])
            u, p, n = (whole(*name) for name in names)
            margin = cosine(u, p) - cosine(u, n)
            loss += r["weight"] * math.log1p(math.exp(-margin))
            weight += r["weight"]
            c = -r["weight"] / (1 + math.exp(margin))
            lengths = [np.linalg.norm(x) for x in (u, p, n)]
            a, b, d = (x / length for x, length in zip((u, p, n), lengths))
            parts = (c * (b - d - a * margin) / lengths[0], c * (a - b * (a @ b)) / lengths[1],
                     -c * (a - d * (a @ d)) / lengths[2])
            for (kind, i), slope in zip(names, parts):
                targets = [((kind, i), 1.0)]
                targets += [((f"{kind}_map", k), x) for k, x in enumerate(features[kind, i])]
                if kind == "item":
                    targets.append((("category", category[i]), 1.0))
                for target, share in targets:
                    slopes[target] = slopes.get(target, 0.0) + share * slope
        for target, slope in slopes.items():
            slope = slope + settings.decay * value[target]
            moved[target] += (slope**2).mean()
            value[target] = value[target] - settings.rate * slope / math.sqrt(moved[target] + 1e-8)
    return value, loss / weight


def test_one_block_equals_doing_it_by_hand(spark, tmp_path):
    train, _ = parts(spark)
    path, settings = str(tmp_path), Settings(rank=6, batch=16, seed=3, blocks=1)
    learned = pairwise.learn(train, None, path, epochs=1, settings=settings)
    start = spark.read.parquet(f"{path}/state/epoch=0").collect()
    value, loss = by_hand(start, spark.read.parquet(f"{path}/work/pairs").collect(), settings)
    for r in spark.read.parquet(f"{path}/state/epoch=1").collect():
        assert np.allclose(r["vector"], value[r["kind"], r["id"]], atol=1e-9)
    row = learned.history.first()
    assert row["train_loss"] == pytest.approx(loss) and row["validation_loss"] is None
    assert row["train_pairs"] == train.select("visitor_id", "item_id").distinct().count()


@pytest.mark.parametrize("blocks", [1, 3])
def test_planted_preferences_are_learned(spark, tmp_path, blocks):
    train, validation = parts(spark)
    settings = Settings(rank=6, batch=16, seed=3, blocks=blocks)
    learned = pairwise.learn(train, validation, str(tmp_path), epochs=4, settings=settings)
    losses = {r["epoch"]: r["validation_loss"] for r in learned.history.collect()}
    assert losses[learned.best_epoch] == min(losses.values()) < math.log(2) - 0.15
    told = duckdb.sql(f"""select arg_min(epoch, (validation_loss, epoch)), count(*)
        from read_parquet('{tmp_path}/history/*.parquet')""").fetchone()
    assert told == (learned.best_epoch, 4)
    users, items = as_arrays(learned.users, "user_id"), as_arrays(learned.items, "item_id")
    assert all(np.linalg.norm(v) == pytest.approx(1) for v in [*users.values(), *items.values()])
    own = np.mean([u @ v for i, u in users.items() for j, v in items.items() if (i - j) % 2 == 0])
    other = np.mean([u @ v for i, u in users.items() for j, v in items.items() if (i - j) % 2])
    assert own > other + 0.5


def test_a_stopped_fit_goes_on_to_the_same_vectors(spark, tmp_path):
    train, validation = parts(spark)
    settings = Settings(rank=4, batch=32, seed=5, blocks=2)
    whole, halves = str(tmp_path / "whole"), str(tmp_path / "halves")
    once = pairwise.learn(train, validation, whole, epochs=2, patience=9, settings=settings)
    pairwise.learn(train, validation, halves, epochs=1, patience=9, settings=settings)
    # State without its history row, as after a crash, is written anew.
    spark.read.parquet(f"{halves}/state/epoch=0").write.parquet(f"{halves}/state/epoch=2")
    again = pairwise.learn(train, validation, halves, epochs=2, patience=9, settings=settings)
    assert sorted(map(tuple, once.history.collect())) == sorted(map(tuple, again.history.collect()))
    for epoch in (1, 2):
        for one, two in zip(pairwise.vectors(spark, whole, epoch),
                            pairwise.vectors(spark, halves, epoch), strict=True):
            assert one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty()
    with pytest.raises(ValueError, match="other settings"):
        pairwise.learn(train, validation, halves, settings=Settings(rank=5))


def test_patience_stops_and_the_best_version_is_kept(spark, tmp_path, monkeypatch):
    train, validation = parts(spark)
    losses = iter([0.6, 0.5, 0.55, 0.52, 0.1])
    measured = pairwise.pairwise_loss

    def told(*args):
        return measured(*args).withColumn("loss", F.lit(next(losses)))

    monkeypatch.setattr(pairwise, "pairwise_loss", told)
    learned = pairwise.learn(train, validation, str(tmp_path), epochs=9, patience=2, settings=SMALL)
    assert learned.best_epoch == 2 and learned.history.count() == 4
    best = as_arrays(pairwise.vectors(spark, str(tmp_path), 2)[0], "user_id")
    kept = as_arrays(learned.users, "user_id")
    assert all(np.array_equal(best[i], kept[i]) for i in kept)


def test_negatives_of_a_block_are_unseen():
    rng = np.random.default_rng(1)
    user, item = rng.integers(0, 12, 90), rng.integers(0, 9, 90)
    user, item = np.r_[user, np.full(9, 3)], np.r_[item, np.arange(9)]
    start = rng.integers(0, 1 << 40, len(user))
    found = pairwise.unseen_items(user, item, start, 9)
    seen = {u: set(item[user == u]) for u in user}
    for u, s, j in zip(user, start, found, strict=True):
        free = [x for k in range(9) if (x := (s + k) % 9) not in seen[u]]
        assert j == (free[0] if free else -1)


def test_a_block_without_items_or_pairs_stays_as_it_is():
    rows = pd.DataFrame({
        "kind": ["user", "user_map"], "id": [1, 0], "vector": [[1.0, 2.0], [0.5, 0.5]],
        "moved": [0.0, 0.0], "features": [[1.0], None], "category": [None, None],
    })
    rows = rows.assign(block=0, item=None, weight=None, turn=None, start=None)
    done = pairwise.update_block(rows, Settings(rank=2))
    assert [list(v) for v in done["vector"]] == [[1.0, 2.0], [0.5, 0.5]] and set(done["pairs"]) == {0}


def test_only_users_with_pairs_enter_a_step(spark, tmp_path):
    """The others come back as they were, and pairs carry no arrays into the workers."""
    train, _ = parts(spark)
    settings = Settings(rank=2, blocks=2, seed=3)
    chosen = pairwise.prepare(train, None, str(tmp_path), settings)
    state = spark.read.parquet(f"{tmp_path}/state/epoch=0")
    users = sorted(r["id"] for r in state.filter("kind = 'user'").collect())
    pairs = spark.read.parquet(f"{tmp_path}/pairs").filter(F.col("user") == users[0]).select(
        "user", "item", "weight", pairwise._slot("user", chosen).alias("block"),
        F.lit(1).cast("bigint").alias("turn"), F.lit(1).cast("bigint").alias("start"),
        F.pmod(pairwise._slot("item", chosen, 1) - pairwise._slot("user", chosen), F.lit(2))
        .alias("step"),
    )
    step = pairs.first()["step"]
    done = pairwise._step(state, pairs, 1, step, chosen)
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInPandas" in plan and "LeftSemi" in plan and "LeftAnti" in plan
    before = {r["id"]: r["vector"] for r in state.filter("kind = 'user'").collect()}
    after = {r["id"]: r["vector"] for r in done.filter("kind = 'user'").collect()}
    assert set(after) == set(before)
    assert [i for i in users if after[i] != before[i]] == users[:1]

import tracemalloc

import numpy as np
import pytest

from cartlark.operators import retrieval
from cartlark.operators.cell_index import build_cells, fit_centres, visited

USERS, ITEMS = "user_id bigint, embedding array<double>", "item_id bigint, embedding array<double>"
SEEN = "user_id bigint, item_id bigint"


def clustered(rng, clusters, n, dims, spread):
    centres = rng.normal(size=(clusters, dims))
    return centres[rng.integers(0, clusters, n)] + rng.normal(scale=spread, size=(n, dims))


def brute(users, items, seen, k):
    def unit(x):
        return x / max(np.linalg.norm(x), 1e-12)

    out = []
    for u, user in enumerate(users):
        scored = sorted(
            (-(round(float(unit(user) @ unit(item)), 6) + 0.0), i)
            for i, item in enumerate(items) if (u, i) not in seen
        )
        out += [(u, n, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return out


def tables(spark, users, items, seen):
    return (
        spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(users)], USERS),
        spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(items)], ITEMS),
        spark.createDataFrame(sorted(seen), SEEN),
    )


@pytest.mark.parametrize("spread", [0.05, 5.0])
def test_equals_scoring_everything(spark, spread):
    rng = np.random.default_rng(int(spread))
    items = clustered(rng, 6, 240, 5, spread)
    items[:40] = items[40]  # many equal vectors
    items[200] = 0.0
    users = np.r_[clustered(rng, 6, 30, 5, 1.0), [items[40], -items[40], np.zeros(5)]]
    seen = {(int(u), int(i)) for u, i in zip(rng.integers(0, 33, 400), rng.integers(0, 240, 400))}
    seen |= {(30, i) for i in range(45)} | {(31, i) for i in range(235)}
    frames = tables(spark, users, items, seen)
    found = retrieval.top_k_items(*frames, 4, users_per_shard=7, items_per_block=16)
    assert sorted(map(tuple, found.collect())) == brute(users, items, seen, 4)


def test_cells_out_of_reach_are_not_visited(spark):
    rng = np.random.default_rng(2)
    items, users = clustered(rng, 20, 800, 16, 0.02), None
    users = items[rng.integers(0, 800, 50)]
    user_rows, item_rows, seen = tables(spark, users, items, {(0, 0)})
    index = build_cells(item_rows, 800, 40)
    assert index.items.count() == 800
    assert max(r["count"] for r in index.items.groupBy("cell", "part").count().collect()) <= 80
    partial, visits = visited(
        user_rows, index, seen, 5, 10, retrieval._scored(5), retrieval._k_best(5)
    )
    assert 50 <= visits.count() < 50 * len(index.parts) / 3
    best = {}
    for r in partial.collect():
        best.setdefault(r["user_id"], []).append(r["score"])
    expected = brute(users, items, {(0, 0)}, 5)
    for u, scores in best.items():
        assert sorted(scores)[::-1][:5] == pytest.approx([s for v, _, _, s in expected if v == u], abs=2e-6)


def test_a_user_moves_once_per_shelf_and_an_item_once_per_shard(spark):
    """Vectors that no bound separates: cells and homes are many, shelves and shards are few."""
    rng = np.random.default_rng(4)
    items, users = rng.normal(size=(600, 12)), rng.normal(size=(90, 12))
    seen = {(int(u), int(i)) for u, i in zip(rng.integers(0, 90, 900), rng.integers(0, 600, 900))}
    user_rows, item_rows, seen_rows = tables(spark, users, items, seen)
    index = build_cells(item_rows, 600, 10, shelf_rows=250)
    moved = {"users": 0, "hidden": 0, "items": 0}

    def counted(asking, hidden, offered):
        for name, rows in (("users", asking), ("hidden", hidden), ("items", offered)):
            moved[name] += rows.count()
        return retrieval._scored(4)(asking, hidden, offered)

    partial, visits = visited(user_rows, index, seen_rows, 4, 45, counted, retrieval._k_best(4))
    best = retrieval._k_best(4)(partial).selectExpr("user_id", "place - 1", "item_id", "score")
    assert sorted(map(tuple, best.collect())) == brute(users, items, seen, 4)
    assert visits.count() == visits.distinct().count() > 90 * 30
    shelves = 1 + max(last for _, last in index.shelves.values())
    sizes = [r["count"] for r in index.items.groupBy("block").count().collect()]
    assert len(sizes) == shelves <= 4 and max(sizes) <= 300
    assert moved["users"] <= 90 * (2 + shelves)
    assert moved["hidden"] == len(seen)
    assert moved["items"] <= 2 * 600 * 6


def test_few_rows_are_compared_with_all_centres_at_a_time():
    rng = np.random.default_rng(7)
    sample = rng.normal(size=(20_000, 4))
    sample /= np.linalg.norm(sample, axis=1)[:, None]
    tracemalloc.start()
    assert fit_centres(sample, 400).shape == (400, 4)
    assert tracemalloc.get_traced_memory()[1] < 20e6  # all rows at once: 64 MB
    tracemalloc.stop()


def test_centres_are_unit_and_stay_where_no_row_is_near():
    rng = np.random.default_rng(0)
    sample = rng.normal(size=(50, 3))
    sample /= np.linalg.norm(sample, axis=1)[:, None]
    centres = fit_centres(np.r_[sample, np.zeros((2, 3))], 9)
    assert centres.shape == (9, 3) and np.linalg.norm(centres[:8], axis=1) == pytest.approx(np.ones(8))
    assert fit_centres(sample[:2], 9).shape == (2, 3)

"""Negatives of light users in one group each, of heavy ones by chunks: the same walk."""

import random

import pytest

from cartlark.operators import heavy, negatives

ITEMS = 12


def walked(seen, at):
    while at in seen:
        at = (at + 1) % ITEMS
    return at


@pytest.mark.parametrize("bound", [0, 25, heavy.LIGHT_ROWS])
@pytest.mark.parametrize("own", [True, False])
def test_walks_by_weight_of_user(spark, bound, own):
    rng = random.Random(4)
    seen = {u: set(rng.sample(range(ITEMS), n)) for u, n in enumerate([0, 1, 4, 8, 10, 10, 11, 12])}
    seen |= {8: set(range(ITEMS)) - {0, 5}, 9: set(range(ITEMS)) - {4, 11}, 10: {0, 1, 10, 11}}
    rows, position = [], 0
    for user, known in seen.items():
        for item in range(ITEMS):
            if item in known or not own:
                for _ in range(3):
                    rows.append((position, user, item))
                    position += 1
    expected = {}
    for position, user, item in rows:
        blocked = seen[user] | {item}
        if len(blocked) < ITEMS:
            start = (position * negatives.STRIDE + 42) % ITEMS
            expected[position] = (user, item, walked(blocked, start))
    pairs = [(user, item) for user, known in seen.items() for item in known]
    found = negatives.negative_samples(
        spark.createDataFrame(rows, "position bigint, user_index bigint, item_index bigint"),
        spark.createDataFrame(pairs, "user_index bigint, item_index bigint"),
        ITEMS, rows_are_seen=own, chunk=4, light_rows=bound,
    ).collect()
    assert len(found) == len(expected)
    assert {r["position"]: tuple(r)[1:] for r in found} == expected


def test_light_users_are_not_looked_up_by_chunk(spark, monkeypatch):
    def chunked(*_):
        raise AssertionError("by chunk")

    monkeypatch.setattr(negatives, "asof_lookup", chunked)
    rows = spark.range(50).selectExpr("id as position", "id % 5 as user_index", "id % 9 as item_index")
    pairs = rows.select("user_index", "item_index").distinct()
    assert negatives.negative_samples(rows, pairs, 30, rows_are_seen=True).count() == 50

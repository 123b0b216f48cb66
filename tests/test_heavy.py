"""Light keys in one group, heavy keys by the finer way: the same rows either way."""

import random

import pytest
from pyspark.sql import functions as F

from cartlark.operators.asof import asof_join
from cartlark.operators.heavy import heavy_keys
from cartlark.operators.sessions import with_sessions
from cartlark.plans.etl import build_clean_events

BOUNDS = [0, 30, 1_000_000]  # all keys heavy, the hot one, none


def hot_rows(seed, n, times):
    rng = random.Random(seed)
    return [(1 if rng.random() < 0.4 else rng.randrange(2, 12), rng.randrange(times))
            for _ in range(n)]


def test_heavy_keys(spark):
    rows = spark.range(100).selectExpr("if(id < 60, 7L, id) as k")
    assert [r["k"] for r in heavy_keys(rows, "k", 59).collect()] == [7]
    assert heavy_keys(rows, "k", 60) is None


@pytest.mark.parametrize("bound", BOUNDS)
def test_asof_join_by_weight_of_key(spark, bound):
    events, observed = hot_rows(1, 300, 200), {}
    for n, at in enumerate(hot_rows(2, 150, 200)):
        observed[at] = max(observed.get(at, -1), n % 37)
    rows = spark.createDataFrame(events + events[:50], "k bigint, t bigint")
    obs = spark.createDataFrame(
        [(k, t, v) for (k, t), v in observed.items()] + [(k, t, -1) for k, t in observed]
        + [(3, 0, None)], "k bigint, t bigint, v bigint",
    )
    found = asof_join(
        rows, obs, key="k", time="t", value="v", unique=True, broadcast_rows=0, light_rows=bound
    )
    expected = set()
    for k, t in events:
        past = [(ot, v) for (ok, ot), v in observed.items() if ok == k and ot <= t]
        expected.add((k, t, max(past)[1] if past else None))
    got = [(r["k"], r["t"], r["v"]) for r in found.collect()]
    assert len(got) == len(expected) and set(got) == expected


@pytest.mark.parametrize("bound", BOUNDS)
def test_sessions_by_weight_of_visitor(spark, bound):
    rows = hot_rows(3, 400, 60 * 60_000)
    events = spark.createDataFrame(rows, "visitorid bigint, timestamp bigint")
    expected, last, number = [], {}, {}
    for visitor, time in sorted(rows):
        if visitor not in last or time - last[visitor] > 60_000:
            number[visitor] = number.get(visitor, 0) + 1
        last[visitor] = time
        expected.append((visitor, time, number[visitor], f"{visitor}-{number[visitor]}"))
    found = with_sessions(events, gap_minutes=1, light_rows=bound).collect()
    assert sorted(map(tuple, found)) == sorted(expected)


def test_clean_events_move_twice(spark):
    """By item for copies and categories, by visitor for sessions."""
    raw = spark.range(200).selectExpr(
        "id * 1000 as timestamp", "id % 7 as visitorid", "'view' as event", "id % 2 as itemid",
        "cast(null as string) as transactionid",
    )
    log = spark.range(200).selectExpr(
        "id * 900 as timestamp", "id % 2 as itemid", "'categoryid' as property",
        "cast(id as string) as value",
    )
    clean = build_clean_events(raw.unionByName(raw), log)
    assert clean.count() == 200 and clean.filter(F.col("category_id").isNull()).count() == 0
    plan = clean._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2

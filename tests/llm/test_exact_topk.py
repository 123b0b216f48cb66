import math
import random

import numpy as np
import pytest

from cartlark.llm import exact_topk

SCHEMA = "id bigint, vector array<float>"


def brute(queries, rows, k):
    out = []
    for qid, q in queries:
        scored = []
        for i, v in rows:
            if i != qid and len(v) == len(q):
                whole = [(math.floor(1024 * a), math.floor(1024 * b)) for a, b in zip(q, v)]
                score = sum(a * b for a, b in whole)
                scored.append((-max(min(score, 2**63 - 1), -(2**63)), i))
        out += [(qid, n, i, -s) for n, (s, i) in enumerate(sorted(scored)[:k], start=1)]
    return sorted(out)


@pytest.mark.parametrize(("dims", "levels"), [(3, 4), (8, 100), (1, 2)])
def test_equals_scoring_everything_with_ties(spark, monkeypatch, dims, levels):
    rng = random.Random(dims)
    rows = [(i, [rng.randint(-levels, levels) / levels for _ in range(dims)]) for i in range(300)]
    rows += [(i, v) for i, v in rows[:20]] + [(900, [0.5] * (dims + 1)), (901, [1.0] * (dims + 1))]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    monkeypatch.setattr(exact_topk, "BLOCK_ROWS", 64)
    monkeypatch.setattr(exact_topk, "QUERY_ROWS", 8)
    monkeypatch.setattr(exact_topk, "FIRST_STEP", 2)
    queries = [r for r in rows if r[0] % 20 == 0]
    found = exact_topk.top_k(
        spark.createDataFrame(queries[:15], SCHEMA), spark.createDataFrame(rows, SCHEMA), 7
    )
    assert sorted(map(tuple, found.collect())) == brute(queries[:15], rows, 7)


def test_the_walk_stops_early_and_never_too_early():
    rng = np.random.default_rng(0)
    rows = rng.integers(-5, 6, (4000, 4))
    rows[7] = 1000
    lists = exact_topk.SortedLists(np.arange(4000), rows)
    seen = []
    original = np.lexsort
    try:
        exact_topk.np.lexsort = lambda keys: seen.append(len(keys[0])) or original(keys)
        ids, scores = lists.top(-1, np.array([3, 2, 1, 1]), 1)
    finally:
        exact_topk.np.lexsort = original
    assert ids.tolist() == [7] and sum(seen) < 1000
    for query in rng.integers(-5, 6, (50, 4)):
        ids, scores = lists.top(-1, query, 10)
        order = np.lexsort((np.arange(4000), -(rows @ query)))[:10]
        assert ids.tolist() == order.tolist() and scores.tolist() == (rows @ query)[order].tolist()


def test_unusable_and_huge_vectors(spark):
    rows = [(0, [1.0, 2.0]), (1, [3e38, -3e38]), (2, [3e38, 3e38]), (3, [1.0, 2.0]), (3, [1.0, 2.0])]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    bad = [(4, None), (5, []), (6, [1.0, None]), (7, [float("nan"), 1.0]), (8, [float("inf"), 1.0])]
    frame = spark.createDataFrame(rows + bad, SCHEMA)
    good = frame.filter(exact_topk.usable("vector"))
    assert good.count() == 5
    found = sorted(map(tuple, exact_topk.top_k(good.filter("id < 2"), good, 3).collect()))
    assert found == brute(rows[:2], rows, 3)


def test_no_vectors(spark):
    none = spark.createDataFrame([], SCHEMA)
    some = spark.createDataFrame([(1, [1.0])], SCHEMA)
    assert exact_topk.top_k(none, some).isEmpty() and exact_topk.top_k(some, none).isEmpty()
    assert exact_topk.top_k(some, some).isEmpty()


def test_equal_rows_share_no_block_and_lose_no_place(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(i, [rng.randint(-8, 8) / 8 for _ in range(3)]) for i in range(60)]
    rows += [(7, [1.0, 1.0, 1.0])] * 3000 + [(40, [0.5, 1.0, 1.0])] * 4
    queries = [rows[0], rows[20], (40, [0.5, 1.0, 1.0])] + [rows[20]] * 30
    monkeypatch.setattr(exact_topk, "BLOCK_ROWS", 128)
    monkeypatch.setattr(exact_topk, "QUERY_ROWS", 8)
    frame = spark.createDataFrame(rows, SCHEMA)
    dealt, blocks = exact_topk._dealt(frame, 128, 5)
    held = [row["count"] for row in dealt.groupBy("block").count().collect()]
    assert blocks == 24 and sum(held) == 60 + 5 + 4 and max(held) <= 12
    found = exact_topk.top_k(spark.createDataFrame(queries, SCHEMA), frame, 5)
    lists = {}
    for query_id, rank, vec_id, score in map(tuple, found.collect()):
        lists.setdefault(query_id, []).append((rank, vec_id, score))
    expected = {}
    for query_id, _, vec_id, score in brute(queries, rows, 5):
        expected.setdefault(query_id, []).append((-score, vec_id))
    for query_id, scored in expected.items():
        best = [(n, i, -s) for n, (s, i) in enumerate(sorted(scored)[:5], start=1)]
        assert sorted(lists[query_id]) == best
    assert lists.keys() == expected.keys()

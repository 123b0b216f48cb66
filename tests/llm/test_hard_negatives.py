import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cartlark.llm import hard_negatives as hn

SCHEMA = "id bigint, label int, vector array<double>"


def brute(rows, is_anchor, positives=5, negatives=5):
    rows = sorted({(i, lab, tuple(v)) for i, lab, v in rows})
    whole = [[math.floor(256 * x) for x in v] for *_, v in rows]
    order = sorted(range(len(rows)), key=lambda j: (
        len(whole[j]), rows[j][1], -math.sqrt(sum(x * x for x in whole[j])), rows[j][0]))
    place = {j: n for n, j in enumerate(order)}
    out = []
    for a, (anchor, label, _) in enumerate(rows):
        if not is_anchor(anchor):
            continue
        scored = sorted(
            (-sum(x * y for x, y in zip(whole[a], whole[c])), rows[c][0], place[c], c)
            for c in range(len(rows)) if c != a and len(whole[c]) == len(whole[a])
        )
        same = [x for x in scored if rows[x[3]][1] == label][:positives]
        for s, pid, _, _ in same:
            fits = [x for x in scored if rows[x[3]][1] != label and -80 * s <= -100 * x[0] <= -100 * s]
            out += [(anchor, pid, n, x[1], -s, -x[0]) for n, x in enumerate(fits[:negatives], 1)]
    return sorted(out)


@pytest.mark.parametrize(("dims", "levels", "labels"), [(3, 4, 2), (8, 100, 4), (1, 2, 3), (16, 50, 1)])
def test_equals_scoring_everything_with_ties(spark, monkeypatch, dims, levels, labels):
    rng = random.Random(dims)
    rows = [
        (i, rng.randrange(labels), [rng.randint(-levels, levels) / levels for _ in range(dims)])
        for i in range(260)
    ]
    rows += rows[:20] + [(300 + i, 1, rows[3][2]) for i in range(60)]
    rows += [(900, 0, [0.5] * (dims + 1)), (910, 0, [1.0] * (dims + 1)), (920, 1, [0.5] * (dims + 1)),
             (930, 0, [0.0] * dims), (940, 1, [0.0] * dims), (40, 1, [0.25] * dims)]
    monkeypatch.setattr(hn, "BUCKET_CELLS", 40 * dims)
    monkeypatch.setattr(hn, "ANCHOR_CELLS", 4 * dims)
    found = hn.hard_negatives(spark.createDataFrame(rows, SCHEMA), F.col("id") % 10 == 0)
    assert sorted(map(tuple, found.collect())) == brute(rows, lambda i: i % 10 == 0)


def test_unusable_rows_other_columns_and_the_empty_table(spark):
    nan, inf = float("nan"), float("inf")
    good = [(10, 0, [1.0, 0.0]), (1, 0, [0.5, 0.1]), (2, 1, [0.45, 0.0]), (3, 1, [0.5, 0.0])]
    bad = [(None, 0, [1.0, 1.0]), (4, None, [1.0, 1.0]), (5, 1, None), (6, 1, []),
           (7, 1, [1.0, None]), (8, 1, [nan, 1.0]), (20, 0, [inf, 1.0])]
    rows = spark.createDataFrame(good + bad, SCHEMA).withColumns(
        {"key": F.lit("x"), "bucket": F.lit(1), "a.b": F.lit(1), "score": F.lit(None)})
    anchors = F.col("id") % 10 == 0
    expected = brute(good, lambda i: i % 10 == 0)
    assert sorted(map(tuple, hn.hard_negatives(rows, anchors).collect())) == expected
    assert expected == [(10, 1, 1, 3, 32768, 32768), (10, 1, 2, 2, 32768, 29440)]
    assert hn.hard_negatives(rows.filter("false"), anchors).count() == 0


def test_scores_beyond_64_bits(spark):
    rows = [(0, 0, [1e12, 1.0]), (1, 0, [1e12, 2.0]), (2, 1, [9e11, 1.0]), (3, 1, [9e11, 5.0]), (4, 1, [1e3, 0.0])]
    found = hn.hard_negatives(spark.createDataFrame(rows, SCHEMA), F.col("id") == 0).collect()
    assert [(r.rank, r.negative_id, r.negative_score) for r in sorted(found, key=lambda r: r.rank)] == [
        (1, 3, 2**63 - 1), (2, 2, 2**63 - 1)]


def test_coordinate_ranges_prune_and_lose_nothing():
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(30, 16))
    centres /= np.linalg.norm(centres, axis=1)[:, None]  # a bucket holds like lengths
    vectors = np.repeat(centres, 100, 0) + rng.normal(scale=0.01, size=(3000, 16))
    members = pd.DataFrame({"key": np.arange(3000), "id": np.arange(3000), "label": 0,
                            "vector": list(vectors)})
    bucket = hn.Bucket(members, 65536)
    query = bucket.whole[7]
    places, scores = hn.positives_in(bucket, 7, 0, query, -math.inf, 5)
    assert bucket.scored < 600
    everything = bucket.whole @ query
    everything[7] = everything.min()
    assert scores.tolist() == sorted(everything.tolist())[::-1][:5]
    length = float(np.linalg.norm(query))
    for theta in (0.2, 0.6, 0.9, 0.99):
        theta *= length * bucket.longest
        inside = set(np.flatnonzero(bucket.whole @ query >= theta).tolist())
        assert inside <= set(bucket.candidates(query / length, length, theta).tolist())


def test_buckets_that_are_too_short_are_not_sent_the_anchor(spark, monkeypatch):
    monkeypatch.setattr(hn, "BUCKET_CELLS", 20)
    rows = [(i, 0, [100.0, float(i % 3)]) for i in range(10)]
    rows += [(100 + i, 0, [0.01, 0.0]) for i in range(50)]
    placed, asked = hn._dealt(spark.createDataFrame(rows, SCHEMA), F.col("id") == 0, 256)
    sent = []
    searched = hn._searched
    monkeypatch.setattr(hn, "_searched", lambda a, r, pairs, *rest: sent.append(pairs.count())
                        or searched(a, r, pairs, *rest))
    assert hn.positives(asked, placed).count() == 5
    assert sent == [1, 0]

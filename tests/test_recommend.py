import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartlark.functions.vectors import unit
from cartlark.operators.negatives import STRIDE, negative_samples, pairwise_loss
from cartlark.operators import ranking
from cartlark.operators.ranking import popularity, popularity_top_k
from cartlark.operators.retrieval import similar_items, top_k_items, vector_audit
from cartlark.plans import artifacts, evaluation
from cartlark.plans.interactions import (
    item_latest_category,
    load_interactions,
    seen_lists,
    seen_pairs,
    user_features,
)
from cartlark.plans.recommend import (
    COLD_STRATEGY,
    EMBEDDING_STRATEGY,
    best_epoch,
    learn_embeddings,
    recommend,
    recommendation_documents,
)

PAIRS = "user_id bigint, item_id bigint"
VECTORS = "{}_id bigint, embedding array<double>"


def frame(spark, rows, schema):
    return spark.createDataFrame(list(rows), schema)


def users_of(spark, *ids):
    return frame(spark, [(i,) for i in ids], "user_id bigint")


def test_interactions_get_weights_and_unknown_category(spark):
    rows = frame(
        spark,
        [(1, 1, "VIEW", "2024-01-01", 5), (1, 1, "addtocart", "2024-01-01", None),
         (1, 1, "transaction", "2024-01-01", None), (1, 1, "refund", "2024-01-01", 1)],
        "visitor_id bigint, item_id bigint, event_type string, event_time string, category_id bigint",
    )
    loaded = {(r["event_type"], r["weight"], r["category_id"]) for r in load_interactions(rows).collect()}
    assert loaded == {("view", 1.0, 5), ("addtocart", 3.0, -1), ("transaction", 5.0, -1)}
    bare = load_interactions(rows.drop("category_id"))
    assert {r["category_id"] for r in bare.collect()} == {-1}
    with pytest.raises(ValueError, match="event_type, item_id"):
        load_interactions(rows.drop("item_id", "event_type"))


def test_popularity_skips_seen_items(spark):
    ranking = popularity(frame(spark, [(10, 1.0), (10, 3.0), (20, 1.0)], "item_id bigint, weight double"))
    seen = frame(spark, [(1, 10)], PAIRS)
    found = popularity_top_k(users_of(spark, 1), ranking, seen, 2).collect()
    assert [(r["rank"], r["item_id"], r["score"]) for r in found] == [(0, 20, 1.0)]
    unweighted = popularity(frame(spark, [(2,), (2,), (1,), (3,)], "item_id bigint"))
    assert [(r["item_id"], r["score"]) for r in unweighted.orderBy("popularity_rank").collect()] == [
        (2, 2.0), (1, 1.0), (3, 1.0),
    ]


@pytest.mark.parametrize(("k", "chunk"), [(1, 3), (4, 5), (4, 1000), (30, 4)])
def test_popularity_for_many_users_equals_walking_the_list(spark, k, chunk):
    rng = random.Random(k)
    items = list(range(25))
    ranking = popularity(frame(spark, [(i, float(100 - i)) for i in items], "item_id bigint, weight double"))
    seen = {u: set(rng.sample(items, rng.randrange(26))) for u in range(30)}
    seen[0], seen[1] = set(items), set()
    pairs = frame(spark, [(u, i) for u, s in seen.items() for i in s] + [(999, 3)], PAIRS)
    found = {u: [] for u in seen}
    result = popularity_top_k(users_of(spark, *seen), ranking, pairs, k, chunk=chunk)
    for r in result.orderBy("user_id", "rank").collect():
        assert r["rank"] == len(found[r["user_id"]])
        found[r["user_id"]].append(r["item_id"])
    assert found == {u: [i for i in items if i not in s][:k] for u, s in seen.items()}


def test_similar_items_exclude_and_limit(spark):
    items = frame(spark, [(10, [1.0, 0.0]), (20, [0.9, 0.1]), (30, [0.0, 1.0])], VECTORS.format("item"))
    assert [r["item_id"] for r in similar_items(items, [1.0, 0.0], 2, [10]).collect()] == [20, 30]
    assert similar_items(items, [1.0, 0.0], 0).isEmpty()
    assert similar_items(items, [1.0, 0.0], -1).isEmpty()
    assert similar_items(items.filter("false"), [1.0, 0.0], 3).isEmpty()
    zero = similar_items(items, [0.0, 0.0], 3).collect()
    assert [r["item_id"] for r in zero] == [10, 20, 30] and {r["score"] for r in zero} == {0.0}


@pytest.mark.parametrize(("shard", "block"), [(1000, 1000), (3, 4)])
def test_top_k_equals_scoring_everything(spark, shard, block):
    rng = np.random.default_rng(5)
    # Whole-number directions give many equal scores, so ties are exercised.
    users = {int(u): rng.integers(-1, 2, 4).astype(float) for u in range(17)}
    items = {int(i) * 7 + (1 << 60): rng.integers(-1, 2, 4).astype(float) for i in range(23)}
    seen = {(u, i) for u in users for i in items if rng.random() < 0.3}
    seen |= {(3, i) for i in items}
    found = {u: [] for u in users}
    result = top_k_items(
        frame(spark, [(u, v.tolist()) for u, v in users.items()], VECTORS.format("user")),
        frame(spark, [(i, v.tolist()) for i, v in items.items()], VECTORS.format("item")),
        frame(spark, [*seen, (999, 1), (1, 998)], PAIRS), 5,
        users_per_shard=shard, items_per_block=block,
    )
    for r in result.orderBy("user_id", "rank").collect():
        assert r["rank"] == len(found[r["user_id"]])
        found[r["user_id"]].append((r["item_id"], r["score"]))

    def cosine(a, b):
        return round(float(a @ b / max(np.linalg.norm(a), 1e-12) / max(np.linalg.norm(b), 1e-12)), 6)

    for u, v in users.items():
        scored = [(i, cosine(v, w) + 0.0) for i, w in items.items() if (u, i) not in seen]
        assert found[u] == sorted(scored, key=lambda s: (-s[1], s[0]))[:5]


def test_recommend_warm_and_cold(spark):
    arguments = (
        frame(spark, [(1, [1.0, 0.0])], VECTORS.format("user")),
        frame(spark, [(10, [1.0, 0.0]), (20, [0.0, 1.0])], VECTORS.format("item")),
        popularity(frame(spark, [(20, 5.0), (10, 2.0)], "item_id bigint, weight double")),
        frame(spark, [(1, 10)], PAIRS),
    )
    found = recommend(users_of(spark, 1, 999), *arguments, k=1)
    assert {(r["user_id"], r["strategy"], r["item_id"]) for r in found.collect()} == {
        (1, EMBEDDING_STRATEGY, 20), (999, COLD_STRATEGY, 20),
    }
    unfiltered = recommend(users_of(spark, 1), *arguments, k=1, filter_seen=False)
    assert [r["item_id"] for r in unfiltered.collect()] == [10]
    documents = recommendation_documents(recommend(users_of(spark, 999), *arguments, k=2)).collect()
    assert [(e["item_id"], e["score"]) for e in documents[0]["recommendations"]] == [(20, 5.0), (10, 2.0)]
    for k in (0, 101):
        with pytest.raises(ValueError, match="between 1 and 100"):
            recommend(users_of(spark, 1), *arguments, k=k)


@pytest.mark.parametrize("broken", [None, [], [1.0, None], [float("nan"), 1.0]])
def test_users_and_items_without_a_usable_vector(spark, broken):
    found = recommend(
        users_of(spark, 1, 2),
        frame(spark, [(1, [1.0, 0.0]), (2, broken)], VECTORS.format("user")),
        frame(spark, [(10, [1.0, 0.0]), (20, broken)], VECTORS.format("item")),
        popularity(frame(spark, [(20, 5.0), (10, 2.0)], "item_id bigint, weight double")),
        frame(spark, [(2, 20)], PAIRS), k=1,
    )
    assert {(r["user_id"], r["strategy"], r["item_id"]) for r in found.collect()} == {
        (1, EMBEDDING_STRATEGY, 10), (2, COLD_STRATEGY, 10),
    }


def test_popularity_without_a_shuffle_by_rank(spark, monkeypatch):
    items = frame(spark, [(i, float(1000 - i)) for i in range(200)], "item_id bigint, weight double")
    order = popularity(items)
    seen = spark.range(3000).select(
        F.col("id").alias("user_id"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 150).cast("bigint").alias("item_id"),
    )
    users = seen.select("user_id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        sent = popularity_top_k(users, order, seen, 5)
        monkeypatch.setattr(ranking, "BROADCAST_BYTES", 0)
        salted = popularity_top_k(users, order, seen, 5)
        plan = salted._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(popularity_rank#" in plan and "_salt#" in plan
        assert not [x for x in plan.splitlines() if "SortMergeJoin [popularity_rank" in x and "_salt" not in x]
        assert sorted(map(tuple, sent.collect())) == sorted(map(tuple, salted.collect()))
        assert sent.count() == 15_000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_it_is_an_error_when_no_negative_is_left(spark):
    rows = frame(
        spark, [(0, 0, 0), (1, 0, 1)], "position bigint, user_index bigint, item_index bigint"
    )
    seen = rows.select("user_index", "item_index")
    for own in (True, False):
        with pytest.raises(ValueError, match="no user has an item left"):
            negative_samples(rows, seen, 2, rows_are_seen=own)


def ranked(spark, lists):
    return frame(
        spark, [(u, n, i) for u, items in lists.items() for n, i in enumerate(items)],
        "user_id bigint, rank int, item_id bigint",
    )


def test_ranking_metrics(spark):
    recommendations = {"m": ranked(spark, {1: [10, 20], 2: [30, 40], 9: [50, 60]})}
    truth = frame(spark, [(1, 20), (2, 99), (3, 10), (3, 20), (3, 30)], PAIRS)
    catalog = frame(spark, [(10,), (20,), (30,), (40,), (99,)], "item_id bigint")
    row = evaluation.ranking_metrics(recommendations, truth, catalog, 2).first()
    assert row["evaluated_users"] == 3
    assert row["recall"] == pytest.approx(1 / 3, abs=1e-6)
    assert row["hit_rate"] == pytest.approx(1 / 3, abs=1e-6)
    assert row["ndcg"] == pytest.approx((1 / math.log2(3)) / 3, abs=1e-6)
    assert row["catalog_coverage"] == 0.8  # user 9 is not evaluated
    two = evaluation.ranking_metrics(recommendations, truth.filter("user_id < 3"), catalog, 2).first()
    assert (two["recall"], two["hit_rate"], two["evaluated_users"]) == (0.5, 0.5, 2)


def test_ndcg_of_a_perfect_and_a_partial_list(spark):
    truth = frame(spark, [(1, i) for i in (1, 2, 3)] + [(2, 1), (2, 2)], PAIRS)
    lists = {"m": ranked(spark, {1: [3, 1, 2], 2: [9, 1, 8]})}
    catalog = truth.select("item_id").distinct()
    row = evaluation.ranking_metrics(lists, truth, catalog, 3).first()
    partial = (1 / math.log2(3)) / (1 + 1 / math.log2(3))
    assert row["ndcg"] == pytest.approx((1 + partial) / 2, abs=1e-6)


def test_no_truth_gives_zeros_and_k_is_checked(spark):
    lists = {"m": ranked(spark, {1: [1]})}
    none = frame(spark, [], PAIRS)
    catalog = frame(spark, [(1,)], "item_id bigint")
    rows = evaluation.ranking_metrics(lists, none, catalog, 2).collect()
    assert [tuple(r) for r in rows] == [("overall", "m", 0.0, 0.0, 0.0, 0.0, 0)]
    with pytest.raises(ValueError):
        evaluation.ranking_metrics(lists, none, catalog, 0)


def test_payload_round_trip(spark, tmp_path):
    truth = frame(spark, [(1, 20), (2, 99)], PAIRS)
    catalog = frame(spark, [(20,), (99,), (30,), (40,)], "item_id bigint")
    warm_cold = frame(spark, [(1, True), (2, False)], "user_id bigint, is_warm boolean")
    popular, embedded = ranked(spark, {1: [30], 2: [30]}), ranked(spark, {1: [20], 2: [40]})
    metrics = evaluation.cohort_metrics(popular, embedded, truth, catalog, warm_cold, 10)
    protocol = evaluation.evaluation_protocol(
        warm_cold, warm_cold, frame(spark, [(4,)], "n bigint"), 10, 42
    )
    path = str(tmp_path / "metrics.json")
    payload = evaluation.evaluation_payload(metrics, protocol, 10).select(F.to_json(F.struct("*")))
    document = payload.first()[0]
    (tmp_path / "metrics.json").write_text(json.dumps(json.loads(document), indent=2))
    read = evaluation.read_evaluation_payload(spark, path)
    rows = {(r["cohort"], r["model_name"], r["metric_name"]): (r["metric_value"], r["evaluated_users"])
            for r in evaluation.metric_rows(read).collect()}
    assert len(rows) == 16
    assert rows["Overall", "Embedding + fallback", "recall@10"] == (0.5, 2)
    assert rows["Warm users", "Embedding", "recall@10"] == (1.0, 1)
    assert rows["Overall", "Popularity", "catalog_coverage@10"] == (0.25, 2)
    assert evaluation.coverage_lift(evaluation.metric_rows(read)).first()[0] == 2.0
    row = evaluation.protocol_row(read).first()
    assert (row["id"], row["cold_user_fallbacks"], row["cold_start_item_interactions"]) == (1, 1, 4)
    measures = evaluation.protocol_measures(evaluation.protocol_row(read)).first()
    assert measures["cold_start_share"] == 0.5
    long = evaluation.metric_rows(read)
    one = evaluation.selected_metric(long, "Overall", "Popularity", "recall@10").first()
    many = evaluation.selected_metric(long, None, "Popularity", "recall@10").first()
    assert one["selected_metric_value"] == 0.0
    assert many["selected_metric_value"] is None and many["metric_evaluated_users"] == 2


def test_display_names(spark):
    names = frame(spark, [("two_tower_with_fallback",), ("my_new_model",)], "m string")
    shown = [r[0] for r in names.select(evaluation.display_name(F.col("m"))).collect()]
    assert shown == ["Two-Tower + fallback", "My New Model"]


def test_user_sample_is_stable_and_whole_when_small(spark):
    test = frame(spark, [(v,) for v in range(50)], "visitor_id bigint")
    first, again = (
        {r[0] for r in evaluation.sample_users(test.repartition(n), 20).collect()} for n in (1, 7)
    )
    assert first == again and len(first) == 20
    assert evaluation.sample_users(test, 20, seed=1).exceptAll(evaluation.sample_users(test, 20)).count()
    assert evaluation.sample_users(test, 500).count() == 50
    with pytest.raises(ValueError):
        evaluation.sample_users(test, 0)


def brute_negative(position, user, item, seen, items, seed):
    blocked = seen.get(user, set()) | {item}
    if len(blocked) >= items:
        return None
    at = (position * STRIDE + seed) % items
    while at in blocked:
        at = (at + 1) % items
    return at


@pytest.mark.parametrize("chunk", [4, 7, 1 << 16])
@pytest.mark.parametrize("items", [12, 29])
def test_negatives_equal_walking(spark, chunk, items):
    rng = random.Random(items)
    seen = {u: set(rng.sample(range(items), rng.randrange(items))) for u in range(12)}
    seen[0] = set(range(items))
    seen[1] = set(range(items)) - {items // 2}
    seen[2] = set(range(items)) - {0}
    rows = [(p, rng.randrange(13), rng.randrange(items), 1.0) for p in range(300)]
    found = negative_samples(
        frame(spark, rows, "position bigint, user_index bigint, item_index bigint, weight double"),
        frame(spark, [(u, i) for u, s in seen.items() for i in s], "user_index bigint, item_index bigint"),
        items, seed=42, chunk=chunk,
    )
    inside = [(p, u, i, w) for p, u, i, w in rows if i in seen.get(u, ())]
    also = negative_samples(
        frame(spark, inside, "position bigint, user_index bigint, item_index bigint, weight double"),
        frame(spark, [(u, i) for u, s in seen.items() for i in s], "user_index bigint, item_index bigint"),
        items, seed=42, chunk=chunk, rows_are_seen=True,
    )
    expected = {p: brute_negative(p, u, i, seen, items, 42) for p, u, i, _ in rows}
    assert {r["position"]: r["negative_index"] for r in also.collect()} == {
        p: expected[p] for p, *_ in inside if expected[p] is not None
    }
    assert {r["position"]: r["negative_index"] for r in found.collect()} == {
        p: n for p, n in expected.items() if n is not None
    }


def test_pairwise_loss(spark):
    triples = frame(spark, [(1, 10, 20, 1.0), (1, 20, 10, 3.0), (1, 10, 77, 9.0)],
                    "user_id bigint, item_id bigint, negative_id bigint, weight double")
    users = frame(spark, [(1, [2.0, 0.0])], VECTORS.format("user"))
    items = frame(spark, [(10, [1.0, 0.0]), (20, [0.0, 5.0])], VECTORS.format("item"))
    row = pairwise_loss(triples, users, items).first()
    expected = (math.log1p(math.exp(-1)) + 3 * math.log1p(math.exp(1))) / 4
    assert (row["triples"], row["loss"]) == (2, pytest.approx(expected, abs=1e-6))


@pytest.mark.parametrize(("losses", "best"), [([0.5, 0.3, 0.3], 2), ([None, None], 2), ([0.1, 0.2], 1)])
def test_best_epoch(spark, losses, best):
    history = frame(spark, [(n, 1.0, v) for n, v in enumerate(losses, start=1)],
                    "epoch int, train_loss double, validation_loss double")
    assert best_epoch(history).first()["best_epoch"] == best


def train_rows(spark):
    rng = random.Random(8)
    rows = [(f"{n:04d}", u * (1 << 40), i, "view", n, 1.0, i % 3)
            for n, (u, i) in enumerate((rng.randrange(20), rng.randrange(15)) for _ in range(200))]
    return frame(
        spark, rows,
        "event_id string, visitor_id bigint, item_id bigint, event_type string, n bigint, "
        "weight double, category_id bigint",
    ).withColumn("event_time", F.timestamp_seconds("n"))


def test_short_vectors_get_length_one_and_zero_stays(spark):
    vectors = {1: [3e-14, -4e-14], 2: [0.0, 0.0], 3: [6.0, 8.0], 4: [3e-30, 4e-30]}
    rows = spark.createDataFrame(list(vectors.items()), "id int, v array<float>")
    found = {r["id"]: r["u"] for r in rows.select("id", unit(F.col("v")).alias("u")).collect()}
    assert found[1] == pytest.approx([0.6, -0.8]) and found[2] == [0.0, 0.0]
    assert found[3] == pytest.approx([0.6, 0.8]) and found[4] == pytest.approx([0.6, 0.8])


def test_learned_vectors_serve_retrieval_and_are_stored(spark, tmp_path):
    train = train_rows(spark)
    validation = train.limit(40)
    learned = learn_embeddings(train, validation, rank=4, epochs=(1, 2), seed=1)
    assert learned.history.count() == 2 and learned.best_epoch in (1, 2)
    assert learned.users.count() == train.select("visitor_id").distinct().count()
    lengths = learned.items.select(F.aggregate("embedding", F.lit(0.0), lambda t, x: t + x * x)).collect()
    assert all(r[0] == pytest.approx(1.0) for r in lengths)
    seen, ranking = seen_pairs(train), popularity(train)
    found = recommend(learned.users.select("user_id"), learned.users, learned.items, ranking, seen, 3)
    assert found.join(seen, ["user_id", "item_id"]).isEmpty()

    path = str(tmp_path / "model")
    artifacts.write_model_tables(train, ranking, learned.users, learned.items, path)
    for name in ("users", "items", "categories", "user_features", "item_features",
                 "item_categories", "user_vectors", "item_vectors", "seen_items", "popularity"):
        assert not spark.read.parquet(f"{path}/{name}").isEmpty()
    vectors = str(tmp_path / "vectors")
    n = artifacts.write_vectors(learned.items, vectors)
    written = sorted(p.name for p in (tmp_path / "vectors").iterdir())
    assert artifacts.write_vectors(learned.items, vectors, skip_if_ready=True) == n
    assert sorted(p.name for p in (tmp_path / "vectors").iterdir()) == written
    audit = vector_audit(train.select("item_id").distinct(), spark.read.parquet(vectors)).first()
    assert audit["ready"] and audit["zero_vectors"] == 0


def test_split_and_snapshot_and_evaluation_tables(spark, tmp_path):
    from cartlark.operators.split import temporal_split

    train = train_rows(spark)
    artifacts.write_split(temporal_split(train), str(tmp_path / "split"))
    assert sorted(p.name for p in (tmp_path / "split" / "parts").glob("split=*")) == [
        "split=test", "split=train", "split=validation",
    ]
    assert spark.read.json(str(tmp_path / "split" / "metadata")).first()["train_rows"] == 160
    for _ in range(2):  # a refresh replaces
        artifacts.refresh_snapshots(train, str(tmp_path / "snapshots"))
    assert spark.read.parquet(str(tmp_path / "snapshots" / "funnel_stages")).count() == 3


def test_features_of_equal_users_are_centred_with_scale_one(spark):
    rows = frame(spark, [(1, "view"), (2, "view")], "visitor_id bigint, event_type string")
    assert {r["view_feature"] for r in user_features(rows).collect()} == {0.0}


def test_latest_category_and_seen_lists(spark):
    rows = frame(
        spark, [("a", 1, 10, 1, 5), ("b", 1, 10, 2, -1), ("c", 1, 9, 1, 7), ("d", 1, 10, 2, 8)],
        "event_id string, visitor_id bigint, item_id bigint, event_time bigint, category_id bigint",
    )
    assert {r["item_id"]: r["category_id"] for r in item_latest_category(rows).collect()} == {9: 7, 10: 8}
    assert [r["items"] for r in seen_lists(rows).collect()] == [[9, 10]]

"""Every registered query: ``name -> callable(spark, sf_dir)``."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartlark.operators import merge, negatives, normalize, ranking, retrieval, split
from cartlark.functions.vectors import norm as vector_norm
from cartlark.operators.asof import extend_intervals, validity_intervals
from cartlark.operators.sessions import continue_sessions, open_sessions, with_sessions
from cartlark.plans import analytics, audience, etl, evaluation, interactions, pairwise, recommend
from cartlark.plans.replay import replay_delays
from cartlark.session import materialize, shared_dir
from cartlark.sources import kafka
from cartlark.sources.fact_store import ParquetFactStore, load_historical
from cartlark.sources.versioned_store import VersionedFactStore
from cartlark.streaming import event_stream
from workload import tables

K = 10
SEED = 42
SAMPLE = 200

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Plain column types: dates and times as text, whole numbers as bigint, bytes as text."""
    def plain(field: T.StructField):
        column = F.col(field.name)
        if isinstance(field.dataType, (T.DateType, T.TimestampType, T.BinaryType)):
            return column.cast("string").alias(field.name)
        if isinstance(field.dataType, (T.IntegerType, T.ShortType)):
            return column.cast("bigint").alias(field.name)
        return column

    return df.select(*map(plain, df.schema.fields))


def query(build: Query) -> Query:
    QUERIES[build.__name__] = lambda spark, sf_dir: comparable(build(tables.use_utc(spark), sf_dir))
    return build


# --- raw events ------------------------------------------------------------------------


@query
def normalize_text_events(spark, sf):
    return normalize.normalize_events(tables.text_events(spark, sf))


@query
def rejected_text_events(spark, sf):
    return normalize.rejected_events(tables.text_events(spark, sf))


@query
def audit_spoiled_facts(spark, sf):
    return analytics.constraint_audit(tables.spoiled_facts(spark, sf))


@query
def table_audits(spark, sf):
    """Keys, required columns and references of the tables beside the facts."""
    events, properties = tables.stored_raw(spark, sf)
    records = event_stream.parse_events(tables.as_messages(events))
    audits = [
        analytics.key_audit(
            "item_property_history", properties,
            ["itemid", "property", "timestamp"],
        ),
        analytics.key_audit(
            "dead_letter", event_stream.quarantine_events(records),
            ["topic", "partition", "offset"], ("raw_value", "error_reason"),
        ),
        analytics.key_audit(
            "evaluation_metrics", _metric_rows(spark, sf),
            ["cohort", "model_name", "metric_name"], ("metric_value", "evaluated_users"),
        ),
        analytics.reference_audit(
            "events", tables.table(spark, sf, "events"), "user_id",
            tables.table(spark, sf, "customer"), "c_custkey",
        ),
    ]
    return reduce(DataFrame.unionByName, audits)


@query
def historical_loads(spark, sf):
    """Clean events loaded by halves, then as a whole, which adds nothing."""
    clean = tables.clean_events(spark, sf)
    store = ParquetFactStore(f"{shared_dir(spark)}/tables/{uuid.uuid4().hex}/history")
    odd = F.pmod("source_timestamp_ms", F.lit(2)) == 1
    rows = []
    for name, part in (("even", clean.filter(~odd)), ("odd", clean.filter(odd)), ("all", clean)):
        added = load_historical(part, store)
        rows.append((name, added, store.facts(spark).count()))
    return spark.createDataFrame(rows, "load string, added bigint, facts bigint")


@query
def facts_as_of_version(spark, sf):
    """Clean events committed by halves and then compacted, read at every version."""
    clean = tables.clean_events(spark, sf)
    store = VersionedFactStore(f"{shared_dir(spark)}/tables/{uuid.uuid4().hex}/versions")
    odd = F.pmod("source_timestamp_ms", F.lit(2)) == 1
    for part in (clean.filter(~odd), clean.filter(odd)):
        load_historical(part, store)
    store.compact(spark)
    return reduce(DataFrame.unionByName, [
        store.facts(spark, version).agg(
            F.lit(version).alias("version"), F.count("*").alias("facts"),
            F.count_distinct("event_id").alias("ids"), F.sum("item_id").alias("item_sum"),
        )
        for version in range(store.log.head(spark) + 1)
    ])


@query
def normalize_events(spark, sf):
    return normalize.normalize_events(tables.raw_events(spark, sf))


@query
def rejected_events(spark, sf):
    return normalize.rejected_events(tables.raw_events(spark, sf))


@query
def filter_event_types(spark, sf):
    return normalize.filter_event_types(tables.raw_events(spark, sf))


def _accepted(spark, sf):
    return normalize.normalize_events(tables.raw_events(spark, sf))


@query
def event_id(spark, sf):
    return normalize.with_event_id(_accepted(spark, sf)).select("event_id", "timestamp")


@query
def dedup_events(spark, sf):
    twice = _accepted(spark, sf).unionByName(_accepted(spark, sf))
    return normalize.dedup_events(twice)


@query
def event_json(spark, sf):
    return kafka.to_json_lines(normalize.to_contract(_accepted(spark, sf)))


@query
def kafka_records(spark, sf):
    records = kafka.to_kafka_records(normalize.to_contract(_accepted(spark, sf)))
    header = F.col("headers")[0]
    return records.select(
        "key", "value",
        header["key"].alias("header_key"),
        header["value"].alias("header_value"),
    )


@query
def replay_delays_(spark, sf):
    contract = normalize.to_contract(_accepted(spark, sf))
    return replay_delays(contract, speed=3600.0, max_delay_seconds=0.05).select(
        "event_id", "delay_seconds"
    )


QUERIES["replay_delays"] = QUERIES.pop("replay_delays_")


@query
def constraint_audit(spark, sf):
    return analytics.constraint_audit(tables.clean_events(spark, sf))


# --- categories, sessions, clean events -----------------------------------------------------


@query
def category_observations(spark, sf):
    return etl.category_observations(tables.raw_item_properties(spark, sf))


@query
def category_intervals(spark, sf):
    observed = etl.category_observations(tables.raw_item_properties(spark, sf))
    return validity_intervals(observed, key="itemid", time="timestamp")


@query
def category_intervals_by_loads(spark, sf):
    """The same intervals, grown by three loads that interleave in time."""
    observed = etl.category_observations(tables.raw_item_properties(spark, sf))
    load = F.pmod(F.hash("itemid", "timestamp"), F.lit(3))
    held = validity_intervals(observed.filter(load == 2), key="itemid", time="timestamp")
    for number in (0, 1):
        held = materialize(extend_intervals(
            held, observed.filter(load == number), key="itemid", time="timestamp",
            value="category_id",
        ))
    return held


@query
def asof_category(spark, sf):
    events = normalize.dedup_events(_accepted(spark, sf))
    return etl.with_category(events, tables.raw_item_properties(spark, sf)).select(
        "event_id", "itemid", "timestamp", "category_id"
    )


@query
def asof_category_bucketed(spark, sf):
    """The same answer by the way taken when the observations are too many to broadcast."""
    events = normalize.dedup_events(_accepted(spark, sf))
    properties = tables.raw_item_properties(spark, sf)
    return etl.with_category(events, properties, broadcast_rows=0).select(
        "event_id", "itemid", "timestamp", "category_id"
    )


@query
def sessions(spark, sf):
    events = normalize.dedup_events(_accepted(spark, sf))
    return with_sessions(events).select("event_id", "session_number", "session_id")


@query
def sessions_long_gap(spark, sf):
    events = normalize.dedup_events(_accepted(spark, sf))
    return with_sessions(events, gap_minutes=720).select(
        "event_id", "session_number", "session_id"
    )


@query
def sessions_by_loads(spark, sf):
    """Sessions continued over loads cut at two dates; every seventeenth visitor's events of odd
    items come one load late."""
    events = normalize.dedup_events(_accepted(spark, sf)).select(
        "event_id", "visitorid", "timestamp", "itemid"
    )
    day = F.to_date(F.timestamp_millis("timestamp"))
    late = (F.col("visitorid") % 17 == 0) & (F.col("itemid") % 2 == 1)
    load = sum(part.cast("int") for part in (day >= DATE_FROM, day > DATE_TO, late))
    events = materialize(events.withColumn("load", load))
    held = materialize(with_sessions(events.filter("load = 0")))
    still_open = open_sessions(held)
    for number in (1, 2, 3):
        arrived = continue_sessions(events.filter(F.col("load") == number), held, still_open)
        arrived = materialize(arrived)
        still_open = open_sessions(arrived, still_open)
        held = materialize(held.join(arrived, "event_id", "left_anti").unionByName(arrived))
    return held.select("event_id", "session_number", "session_id")


@query
def clean_events(spark, sf):
    return tables.build_clean(spark, sf).drop("event_time")


@query
def bulk_clean_events(spark, sf):
    return tables.build_bulk_clean(spark, sf).drop("event_time")


@query
def category_match_rate(spark, sf):
    return etl.category_match_rate(tables.clean_events(spark, sf))


@query
def staged_events(spark, sf):
    return etl.staged_events(tables.clean_events(spark, sf)).drop("event_time")


@query
def idempotent_merge(spark, sf):
    """The train part is loaded first; then everything is, and only the rest is new."""
    parts = split.temporal_split(_interactions(spark, sf))
    held = etl.staged_events(parts.filter("split = 'train'"), 1)
    arriving = etl.staged_events(parts, 2)
    return merge.merged_fact(arriving, held).select("event_id", "ingest_batch_id")


@query
def dashboard_fact_events(spark, sf):
    return analytics.dashboard_fact_events(tables.clean_events(spark, sf))


# --- analytics --------------------------------------------------------------------------------

for _name in (
    "user_daily_metrics", "item_daily_metrics", "funnel_daily", "top_items", "top_categories",
    "user_activity", "funnel_stages", "calendar", "daily_trend", "kpis", "event_ratios",
    "event_ratio_trend",
):
    def _on_clean(spark, sf, build=getattr(analytics, _name)):
        return build(tables.clean_events(spark, sf))

    _on_clean.__name__ = _name
    query(_on_clean)

for _name in ("user_daily_metrics", "funnel_daily", "top_items", "top_categories", "user_activity"):
    def _on_bulk(spark, sf, build=getattr(analytics, _name)):
        return build(tables.bulk_clean_events(spark, sf))

    _on_bulk.__name__ = f"bulk_{_name}"
    query(_on_bulk)

DATE_FROM, DATE_TO = dt.date(2024, 1, 8), dt.date(2024, 1, 21)


@query
def funnel_stages_filtered(spark, sf):
    clean = tables.clean_events(spark, sf)
    return analytics.funnel_stages(analytics.slice_events(clean, DATE_FROM, DATE_TO))


@query
def kpis_filtered(spark, sf):
    clean = tables.clean_events(spark, sf)
    return analytics.kpis(
        analytics.slice_events(clean, DATE_FROM, DATE_TO, hours=list(range(9, 18)))
    )


def _build_bitmaps(spark, sf):
    """Two loads: the second grows the dictionaries and appends to the bitmaps of the first."""
    clean = tables.clean_events(spark, sf)
    odd = F.pmod("source_timestamp_ms", F.lit(2)) == 1
    first, second = clean.filter(~odd), clean.filter(odd)
    known = {
        key: interactions.vocabulary(first, key, index)
        for key, index in (("visitor_id", "user_index"), ("item_id", "item_index"))
    }
    grown = {
        key: interactions.grown_vocabulary(held, second, key, held.columns[1])
        for key, held in known.items()
    }
    return reduce(DataFrame.unionByName, [
        audience.member_bitmaps(part, ids["visitor_id"], ids["item_id"])
        for part, ids in ((first, known), (second, grown))
    ])


def _bitmaps(spark, sf):
    return tables.stored(spark, sf, "bitmaps", _build_bitmaps)


@query
def funnel_stages_from_bitmaps(spark, sf):
    """``funnel_stages_filtered`` without the facts."""
    return audience.funnel_stages(analytics.slice_events(_bitmaps(spark, sf), DATE_FROM, DATE_TO))


@query
def kpis_from_bitmaps(spark, sf):
    """``kpis_filtered`` without the facts."""
    return audience.kpis(
        analytics.slice_events(_bitmaps(spark, sf), DATE_FROM, DATE_TO, hours=list(range(9, 18)))
    )


@query
def snapshot_totals(spark, sf):
    clean = tables.clean_events(spark, sf)
    return analytics.snapshot_totals(
        analytics.top_items(clean), analytics.top_categories(clean),
        analytics.user_activity(clean), analytics.funnel_stages(clean),
    )


# --- stream rules on a static frame ----------------------------------------------------------


@query
def parse_events(spark, sf):
    parsed = event_stream.parse_events(tables.kafka_envelope(spark, sf))
    return parsed.drop("kafka_timestamp")


@query
def valid_events(spark, sf):
    valid, _ = event_stream.split_events(tables.kafka_envelope(spark, sf))
    return valid.withColumn("event_time", F.unix_millis("event_time"))


@query
def quarantine_events(spark, sf):
    _, rejected = event_stream.split_events(tables.kafka_envelope(spark, sf))
    return rejected


# --- recommender data ------------------------------------------------------------------------


def _interactions(spark, sf):
    return interactions.load_interactions(tables.shopper_clean_events(spark, sf))


def split_table(spark, sf):
    """The columns that recommenders learn from; the others stay with the clean events."""
    return tables.stored(
        spark, sf, "split",
        lambda s, d: split.temporal_split(_interactions(s, d)).select(
            "event_id", "event_time", "visitor_id", "item_id", "event_type", "category_id",
            "weight", "split",
        ),
    )


def _part(spark, sf, part):
    return split.split_part(split_table(spark, sf), part)


def _train(spark, sf):
    return _part(spark, sf, "train")


def _test(spark, sf):
    return _part(spark, sf, "test")


def _seen(spark, sf):
    return tables.stored(spark, sf, "seen", lambda s, d: interactions.seen_pairs(_train(s, d)))


def _catalog(spark, sf):
    return _items(spark, sf).select("item_id")


def _ranking(spark, sf):
    return tables.stored(spark, sf, "ranking", lambda s, d: ranking.popularity(_train(s, d)))


def _item_vectors(spark, sf):
    vectors = tables.table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("item_id"), "embedding"
    )
    return vectors.join(_catalog(spark, sf), "item_id", "left_semi")


def _build_user_vectors(spark, sf):
    vectors = tables.table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("user_id"), F.reverse("embedding").alias("embedding")
    )
    users = _train(spark, sf).select(F.col("visitor_id").alias("user_id"))
    return vectors.join(users, "user_id", "left_semi")


def _user_vectors(spark, sf):
    return tables.stored(spark, sf, "user_vectors", _build_user_vectors)


def _test_users(spark, sf):
    return _test(spark, sf).select(F.col("visitor_id").alias("user_id")).distinct()


@query
def load_interactions(spark, sf):
    return _interactions(spark, sf).select(
        "event_id", "source_timestamp_ms", "visitor_id", "item_id", "event_type", "category_id",
        "weight",
    )


@query
def temporal_split(spark, sf):
    return split.temporal_split(_interactions(spark, sf)).select("event_id", "split")


@query
def bulk_temporal_split(spark, sf):
    return split.temporal_split(tables.bulk_clean_events(spark, sf)).select("event_id", "split")


@query
def split_metadata(spark, sf):
    return split.split_metadata(split_table(spark, sf)).withColumns(
        {c: F.unix_millis(c) for c in ("train_end", "validation_end")}
    )


@query
def popularity(spark, sf):
    return ranking.popularity(_train(spark, sf))


@query
def bulk_popularity(spark, sf):
    return ranking.popularity(interactions.load_interactions(tables.bulk_clean_events(spark, sf)))


@query
def popularity_recs(spark, sf):
    return ranking.popularity_top_k(
        _test_users(spark, sf), _ranking(spark, sf), _seen(spark, sf), K
    )


@query
def bulk_popularity_recs(spark, sf):
    rows = interactions.load_interactions(tables.bulk_clean_events(spark, sf))
    users = rows.select(F.col("visitor_id").alias("user_id")).distinct()
    return ranking.popularity_top_k(
        users, ranking.popularity(rows), interactions.seen_pairs(rows), K
    )


@query
def user_features(spark, sf):
    return interactions.user_features(_train(spark, sf))


@query
def item_features(spark, sf):
    return interactions.item_features(_train(spark, sf))


@query
def item_latest_category(spark, sf):
    return interactions.item_latest_category(_train(spark, sf))


def _build_users(spark, sf):
    return interactions.vocabulary(_train(spark, sf), "visitor_id", "user_index")


def _build_items(spark, sf):
    return interactions.vocabulary(_train(spark, sf), "item_id", "item_index")


def _users(spark, sf):
    return tables.stored(spark, sf, "users", _build_users)


def _items(spark, sf):
    return tables.stored(spark, sf, "items", _build_items)


@query
def vocab_users(spark, sf):
    return _build_users(spark, sf)


@query
def vocab_items(spark, sf):
    return _build_items(spark, sf)


@query
def vocab_users_grown(spark, sf):
    """The training vocabulary, grown by the users of the later parts."""
    return interactions.grown_vocabulary(
        _users(spark, sf), split_table(spark, sf), "visitor_id", "user_index"
    )


@query
def vocab_categories(spark, sf):
    return interactions.vocabulary(_train(spark, sf), "category_id", "category_index")


def _indexed(spark, sf, part):
    return interactions.indexed_interactions(
        _part(spark, sf, part), _users(spark, sf), _items(spark, sf)
    )


@query
def indexed_interactions(spark, sf):
    return _indexed(spark, sf, "train").select(
        "event_id", "position", "user_index", "item_index", "weight"
    )


@query
def seen_items(spark, sf):
    return interactions.seen_lists(_train(spark, sf)).select(
        "user_id", "chunk", F.array_join(F.col("items").cast("array<string>"), ",").alias("items")
    )


@query
def sampled_test(spark, sf):
    test = _test(spark, sf)
    chosen = evaluation.sample_users(test, SAMPLE, SEED)
    return evaluation.restrict_to_users(test, chosen).select("event_id", "visitor_id")


@query
def truth_pairs(spark, sf):
    return evaluation.truth_pairs(_test(spark, sf), _catalog(spark, sf), _seen(spark, sf))


@query
def cold_item_interactions(spark, sf):
    return evaluation.cold_item_interactions(_test(spark, sf), _catalog(spark, sf))


def _indexed_seen(indexed):
    return indexed.select("user_index", "item_index").distinct()


def _build_seen_indices(spark, sf):
    pairs = _seen(spark, sf).withColumnRenamed("user_id", "visitor_id")
    known = interactions.known_interactions(pairs, _users(spark, sf), _items(spark, sf))
    return known.select("user_index", "item_index")


def _seen_indices(spark, sf):
    return tables.stored(spark, sf, "seen_indices", _build_seen_indices)


@query
def negative_samples(spark, sf):
    train = _indexed(spark, sf, "train")
    items = _items(spark, sf).count()
    return negatives.negative_samples(
        train, _indexed_seen(train), items, seed=SEED, rows_are_seen=True
    ).select("position", "user_index", "item_index", "negative_index")


@query
def validation_negative_samples(spark, sf):
    return negatives.negative_samples(
        _indexed(spark, sf, "validation"), _seen_indices(spark, sf),
        _items(spark, sf).count(), seed=SEED,
        seed_offset=negatives.VALIDATION_SEED_OFFSET,
    ).select("position", "user_index", "item_index", "negative_index")


# --- retrieval and evaluation -----------------------------------------------------------------


@query
def warm_cold_users(spark, sf):
    return evaluation.warm_cold_users(_test_users(spark, sf), _user_vectors(spark, sf))


@query
def topk_items(spark, sf):
    return retrieval.top_k_items(
        _user_vectors(spark, sf), _item_vectors(spark, sf), _seen(spark, sf), K
    )


@query
def topk_items_cells(spark, sf):
    """The same by cells of some tens of items, each user visiting those that can matter."""
    return retrieval.top_k_items(
        _user_vectors(spark, sf), _item_vectors(spark, sf), _seen(spark, sf), K, items_per_block=64
    )


@query
def similar_items(spark, sf):
    """Neighbours of the most popular item that has a vector."""
    items = _item_vectors(spark, sf)
    first = (
        items.join(_ranking(spark, sf), "item_id")
        .orderBy("popularity_rank").select("item_id", "embedding").first()
    )
    return retrieval.similar_items(items, first["embedding"], K, exclude=[first["item_id"]])


def _recommended(spark, sf):
    return recommend.recommend(
        _test_users(spark, sf), _user_vectors(spark, sf), _item_vectors(spark, sf),
        _ranking(spark, sf), _seen(spark, sf), K,
    )


@query
def recommend_(spark, sf):
    return _recommended(spark, sf)


QUERIES["recommend"] = QUERIES.pop("recommend_")


@query
def recommendation_documents(spark, sf):
    documents = recommend.recommendation_documents(_recommended(spark, sf))
    listed = F.transform("recommendations", lambda r: r["item_id"].cast("string"))
    return documents.select(
        "user_id", "strategy", "filter_seen", F.array_join(listed, ",").alias("item_ids")
    )


def _truth(spark, sf):
    return tables.stored(
        spark, sf, "truth",
        lambda s, d: evaluation.truth_pairs(_test(s, d), _catalog(s, d), _seen(s, d)),
    )


def _evaluated(spark, sf):
    return tables.stored(
        spark, sf, "evaluated", lambda s, d: _truth(s, d).select("user_id").distinct()
    )


def _warm_cold(spark, sf):
    return evaluation.warm_cold_users(_evaluated(spark, sf), _user_vectors(spark, sf))


def _popular_lists(spark, sf):
    return tables.stored(
        spark, sf, "popular_lists",
        lambda s, d: ranking.popularity_top_k(_evaluated(s, d), _ranking(s, d), _seen(s, d), K),
    )


def _embedding_lists(spark, sf):
    return recommend.recommend(
        _evaluated(spark, sf), _user_vectors(spark, sf), _item_vectors(spark, sf),
        _ranking(spark, sf), _seen(spark, sf), K, popular=_popular_lists(spark, sf),
    )


@query
def ranking_metrics(spark, sf):
    lists = {"popularity": _popular_lists(spark, sf)}
    return evaluation.ranking_metrics(lists, _truth(spark, sf), _catalog(spark, sf), K)


def _cohort_metrics(spark, sf):
    return evaluation.cohort_metrics(
        _popular_lists(spark, sf), _embedding_lists(spark, sf), _truth(spark, sf),
        _catalog(spark, sf), _warm_cold(spark, sf), K,
    )


def _stored_cohort_metrics(spark, sf):
    return tables.stored(spark, sf, "cohort_metrics", _cohort_metrics)


@query
def cohort_metrics(spark, sf):
    return _cohort_metrics(spark, sf)


def _protocol(spark, sf):
    cold_items = evaluation.cold_item_interactions(_test(spark, sf), _catalog(spark, sf))
    return evaluation.evaluation_protocol(
        _test_users(spark, sf), _warm_cold(spark, sf), cold_items, K, SEED
    )


def _stored_protocol(spark, sf):
    return tables.stored(spark, sf, "protocol", _protocol)


@query
def evaluation_protocol(spark, sf):
    return _protocol(spark, sf)


def _metric_rows(spark, sf):
    payload = evaluation.evaluation_payload(
        _stored_cohort_metrics(spark, sf), _stored_protocol(spark, sf), K
    )
    return evaluation.metric_rows(payload, K)


@query
def metric_rows(spark, sf):
    return _metric_rows(spark, sf)


@query
def selected_metric(spark, sf):
    rows = _metric_rows(spark, sf)
    one = evaluation.selected_metric(rows, "Warm users", "Popularity", f"recall@{K}")
    many = evaluation.selected_metric(rows, None, "Popularity", f"recall@{K}")
    return one.withColumn("selection", F.lit("one row")).unionByName(
        many.withColumn("selection", F.lit("both cohorts"))
    )


@query
def cold_start_share(spark, sf):
    return evaluation.protocol_measures(_stored_protocol(spark, sf))


@query
def coverage_lift(spark, sf):
    return evaluation.coverage_lift(_metric_rows(spark, sf))


@query
def vector_audit(spark, sf):
    return retrieval.vector_audit(_catalog(spark, sf), _item_vectors(spark, sf))


@query
def bpr_loss(spark, sf):
    indexed, items = _indexed(spark, sf, "train"), _items(spark, sf)
    sampled = negatives.negative_samples(
        indexed, _indexed_seen(indexed), items.count(), seed=SEED, rows_are_seen=True
    )
    names = items.withColumnsRenamed({"item_id": "negative_id", "item_index": "negative_index"})
    triples = sampled.join(names, "negative_index").withColumnRenamed("visitor_id", "user_id")
    return negatives.pairwise_loss(triples, _user_vectors(spark, sf), _item_vectors(spark, sf))


def _learned(spark, sf):
    return recommend.learn_embeddings(_train(spark, sf), rank=16, epochs=(5,), seed=SEED)


def _described(vectors: DataFrame, key: str) -> DataFrame:
    norm = F.round(vector_norm(F.col("embedding")), 4)
    return vectors.select(key, F.size("embedding").alias("dim"), norm.alias("norm"))


@query
def als_user_factors(spark, sf):
    return _described(_learned(spark, sf).users, "user_id")


@query
def als_item_factors(spark, sf):
    return _described(_learned(spark, sf).items, "item_id")


@query
def best_epoch(spark, sf):
    """The least loss over a history taken from the order lines."""
    history = tables.table(spark, sf, "lineitem").groupBy(
        F.col("l_linenumber").cast("int").alias("epoch")
    ).agg(
        F.round(F.avg("l_tax"), 6).alias("train_loss"),
        F.max(F.when(F.col("l_linenumber") % 3 != 0, F.abs(F.col("l_linenumber") - 4) / 8.0))
        .alias("validation_loss"),
    )
    return recommend.best_epoch(history)


def _growing_fit(spark, sf):
    """One pairwise fit with features and categories, two epochs, shared by the queries below."""
    path = tables.shared_path(spark, sf, "pairwise")
    return pairwise.learn(
        _train(spark, sf), _part(spark, sf, "validation"), path, epochs=2, patience=2,
        settings=pairwise.Settings(rank=8, batch=4096, seed=SEED),
    )


@query
def als_sweep(spark, sf):
    """What each epoch of one growing fit learned from and was measured on."""
    return _growing_fit(spark, sf).history.select("epoch", "train_pairs", "validation_triples")


@query
def pairwise_user_vectors(spark, sf):
    return _described(_growing_fit(spark, sf).users, "user_id")


@query
def pairwise_item_vectors(spark, sf):
    return _described(_growing_fit(spark, sf).items, "item_id")

"""Offline ranking evaluation by cohort and model."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Metric names (before "@k"), cohort labels and model display names.
METRICS = ("recall", "hit_rate", "ndcg", "catalog_coverage")
COHORTS = {"overall": "Overall", "warm_users": "Warm users"}
DISPLAY_NAMES = {
    "popularity": "Popularity",
    "two_tower": "Two-Tower",
    "two_tower_with_fallback": "Two-Tower + fallback",
    "embedding": "Embedding",
    "embedding_with_fallback": "Embedding + fallback",
}
PAYLOAD_SCHEMA = (
    "protocol map<string,bigint>, overall map<string,map<string,double>>, "
    "warm_users map<string,map<string,double>>"
)


def sample_users(test: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """``n`` test users without replacement, the same ones for the same seed: the users with
    the smallest digest of seed and id."""
    if n < 1:
        raise ValueError("the number of users must be positive")
    users = test.select(F.col("visitor_id").alias("user_id")).distinct()
    digest = F.sha2(F.concat_ws("|", F.lit(seed), F.col("user_id")), 256)
    return users.orderBy(digest, "user_id").limit(n)


def restrict_to_users(rows: DataFrame, users: DataFrame, column: str = "visitor_id") -> DataFrame:
    return rows.join(users.withColumnRenamed("user_id", column), column, "left_semi")


def truth_pairs(test: DataFrame, catalog: DataFrame, seen: DataFrame) -> DataFrame:
    """What a recommender could have got right: distinct test pairs of catalogue items the
    user had not seen.  Users without any are not evaluated."""
    return (
        test.select(F.col("visitor_id").alias("user_id"), "item_id")
        .distinct()
        .join(catalog.select("item_id"), "item_id", "left_semi")
        .join(seen, ["user_id", "item_id"], "left_anti")
        .select("user_id", "item_id")
    )


def cold_item_interactions(test: DataFrame, catalog: DataFrame) -> DataFrame:
    """Test rows whose item the model has never met."""
    return test.join(catalog.select("item_id"), "item_id", "left_anti").agg(
        F.count("*").alias("cold_start_item_interactions")
    )


def warm_cold_users(users: DataFrame, user_vectors: DataFrame) -> DataFrame:
    """``(user_id, is_warm)``: does the user have a vector?"""
    known = user_vectors.select("user_id", F.lit(True).alias("_known"))
    return users.join(known, "user_id", "left").select(
        "user_id", F.coalesce("_known", F.lit(False)).alias("is_warm")
    )


def _gain(rank: Column) -> Column:
    return F.lit(1.0) / F.log2(rank + 2)


def _labelled(recommendations: Mapping[str, DataFrame], k: int) -> DataFrame:
    """All models' lists in one table, cut at ``k``."""
    parts = [
        df.filter(F.col("rank") < k).select(F.lit(model).alias("model"), "user_id", "rank", "item_id")
        for model, df in recommendations.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _per_user(top: DataFrame, models: list[str], truth: DataFrame, k: int) -> DataFrame:
    """``(model, user_id, recall, hit, ndcg)``; no recommendation scores zero."""
    relevant = truth.groupBy("user_id").agg(F.count("*").alias("n_truth"))
    hits = (
        top.join(truth, ["user_id", "item_id"], "left_semi")
        .groupBy("model", "user_id")
        .agg(F.count("*").alias("hits"), F.sum(_gain(F.col("rank"))).alias("dcg"))
    )
    ideal = F.aggregate(
        F.sequence(F.lit(0), F.least(F.col("n_truth"), F.lit(k)).cast("int") - 1),
        F.lit(0.0),
        lambda total, rank: total + _gain(rank),
    )
    none = F.lit(0.0)
    return (
        relevant.withColumn("model", F.explode(F.array(*map(F.lit, models))))
        .join(hits, ["model", "user_id"], "left")
        .select(
            "model",
            "user_id",
            F.coalesce(F.col("hits") / F.col("n_truth"), none).alias("recall"),
            F.when(F.col("hits") > 0, 1.0).otherwise(0.0).alias("hit"),
            F.coalesce(F.col("dcg") / ideal, none).alias("ndcg"),
        )
    )


def ranking_metrics(
    recommendations: Mapping[str, DataFrame], truth: DataFrame, catalog: DataFrame, k: int,
    cohorts: DataFrame | None = None,
) -> DataFrame:
    """``(cohort, model, recall, hit_rate, ndcg, catalog_coverage, evaluated_users)``.

    ``recommendations``: per model ``(user_id, rank, item_id)`` with ranks from zero;
    ``truth(user_id, item_id)`` distinct; ``catalog(item_id)`` distinct.  ``cohorts(user_id,
    cohort)`` may put a user into several cohorts; by default there is one for all.  Where
    nothing is to be found, the overall cohort has zeros.
    """
    if k < 1:
        raise ValueError("k must be positive")
    evaluated = truth.select("user_id").distinct()
    if cohorts is None:
        cohorts = evaluated.withColumn("cohort", F.lit("overall"))
    top = _labelled(recommendations, k)
    scored = (
        _per_user(top, list(recommendations), truth, k)
        .join(cohorts, "user_id")
        .groupBy("cohort", "model")
        .agg(
            F.round(F.avg("recall"), 6).alias("recall"),
            F.round(F.avg("hit"), 6).alias("hit_rate"),
            F.round(F.avg("ndcg"), 6).alias("ndcg"),
            F.count("*").alias("evaluated_users"),
        )
    )
    catalog_size = catalog.agg(F.count("*").alias("n")).scalar()
    covered = (
        top.join(evaluated, "user_id", "left_semi")
        .join(cohorts, "user_id")
        .select("cohort", "model", "item_id")
        .distinct()
        .groupBy("cohort", "model")
        .agg(F.count("*").alias("n"))
        .select(
            "cohort", "model", F.round(F.try_divide(F.col("n"), catalog_size), 6).alias("coverage")
        )
    )
    models = truth.sparkSession.createDataFrame(
        [("overall", model) for model in recommendations], "cohort string, model string"
    )
    # One row per cohort and model on any side: put together by grouping.
    zero = F.lit(0.0)
    return (
        scored.unionByName(covered, allowMissingColumns=True)
        .unionByName(models, allowMissingColumns=True)
        .groupBy("cohort", "model")
        .agg(
            F.coalesce(F.max("recall"), zero).alias("recall"),
            F.coalesce(F.max("hit_rate"), zero).alias("hit_rate"),
            F.coalesce(F.max("ndcg"), zero).alias("ndcg"),
            F.coalesce(F.max("coverage"), zero).alias("catalog_coverage"),
            F.coalesce(F.max("evaluated_users"), F.lit(0)).alias("evaluated_users"),
        )
    )


def user_cohorts(warm_cold: DataFrame) -> DataFrame:
    """Everybody is in ``overall``; users with a vector are in ``warm_users`` as well."""
    names = F.when(F.col("is_warm"), F.array(F.lit("overall"), F.lit("warm_users"))).otherwise(
        F.array(F.lit("overall"))
    )
    return warm_cold.select("user_id", F.explode(names).alias("cohort"))


def cohort_metrics(
    popularity: DataFrame, embedding: DataFrame, truth: DataFrame, catalog: DataFrame,
    warm_cold: DataFrame, k: int,
) -> DataFrame:
    """Popularity against embedding retrieval, overall and for warm users.  Overall the
    embedding model falls back to popularity for users without a vector."""
    lists = {"popularity": popularity, "embedding": embedding}
    metrics = ranking_metrics(lists, truth, catalog, k, user_cohorts(warm_cold))
    with_fallback = (F.col("cohort") == "overall") & (F.col("model") == "embedding")
    return metrics.withColumn(
        "model", F.when(with_fallback, "embedding_with_fallback").otherwise(F.col("model"))
    )


def evaluation_protocol(
    sampled: DataFrame, warm_cold: DataFrame, cold_items: DataFrame, k: int, seed: int
) -> DataFrame:
    """The one row that says what was evaluated.  ``warm_cold`` covers evaluated users."""
    return warm_cold.agg(
        F.count("*").alias("evaluated_users"),
        F.count_if("is_warm").alias("warm_evaluated_users"),
        F.count_if(~F.col("is_warm")).alias("cold_user_fallbacks"),
    ).select(
        sampled.agg(F.count("*").alias("n")).scalar().alias("sampled_test_users"),
        "*",
        cold_items.scalar().alias("cold_start_item_interactions"),
        F.lit(k).alias("recommendation_k"),
        F.lit(seed).alias("evaluation_seed"),
    )


def evaluation_payload(metrics: DataFrame, protocol: DataFrame, k: int) -> DataFrame:
    """One nested document with the protocol and each cohort's models and metrics."""
    values = F.map_from_arrays(
        F.array(*(F.lit(f"{m}@{k}") for m in METRICS), F.lit("evaluated_users")),
        F.array(*METRICS, F.col("evaluated_users").cast("double")),
    )
    nested = metrics.groupBy("cohort").pivot("model").agg(F.first(values))
    models = [c for c in nested.columns if c != "cohort"]
    present = F.map_filter(
        F.map_from_arrays(F.array(*(F.lit(m) for m in models)), F.array(*models)),
        lambda _, v: v.isNotNull(),
    )
    by_cohort = nested.select("cohort", present.alias("models"))

    def models_of(name):
        return by_cohort.filter(F.col("cohort") == name).select("models").scalar().alias(name)

    fields = protocol.columns
    return protocol.select(
        F.map_from_arrays(
            F.array(*(F.lit(c) for c in fields)),
            F.array(*(F.col(c).cast("bigint") for c in fields)),
        ).alias("protocol"),
        models_of("overall"),
        models_of("warm_users"),
    )


def read_evaluation_payload(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PAYLOAD_SCHEMA).json(path, multiLine=True)


def display_name(model: Column) -> Column:
    name = F.initcap(F.replace(model, F.lit("_"), F.lit(" ")))
    for key, label in DISPLAY_NAMES.items():
        name = F.when(model == key, label).otherwise(name)
    return name


def metric_rows(payload: DataFrame, k: int = 10) -> DataFrame:
    """The nested evaluation document as long rows."""
    cohorts = F.array(
        *(F.struct(F.lit(label).alias("cohort"), F.col(key).alias("models"))
          for key, label in COHORTS.items())
    )
    models = (
        payload.select(F.inline(cohorts))
        .select("cohort", F.explode("models").alias("model", "values"))
    )
    metrics = F.array(
        *(F.struct(F.lit(f"{m}@{k}").alias("metric_name"),
                   F.col("values")[f"{m}@{k}"].alias("metric_value")) for m in METRICS)
    )
    return models.select(
        "cohort",
        display_name(F.col("model")).alias("model_name"),
        F.inline(metrics),
        F.col("values")["evaluated_users"].cast("bigint").alias("evaluated_users"),
    )


def protocol_row(payload: DataFrame) -> DataFrame:
    names = (
        "sampled_test_users", "evaluated_users", "warm_evaluated_users", "cold_user_fallbacks",
        "cold_start_item_interactions", "recommendation_k", "evaluation_seed",
    )
    return payload.select(F.lit(1).alias("id"), *(F.col("protocol")[n].alias(n) for n in names))


def protocol_measures(protocol: DataFrame) -> DataFrame:
    return protocol.agg(
        F.max("evaluated_users").alias("evaluated_user_count"),
        F.max("warm_evaluated_users").alias("warm_user_count"),
        F.max("cold_user_fallbacks").alias("cold_user_count"),
        F.round(
            F.try_divide(F.max("cold_user_fallbacks"), F.max("evaluated_users")), 6
        ).alias("cold_start_share"),
    )


def coverage_lift(
    rows: DataFrame, model: str = "Embedding + fallback", baseline: str = "Popularity", k: int = 10
) -> DataFrame:
    """How many times more of the catalogue the model shows than the baseline, overall."""
    def coverage(name):
        wanted = (
            (F.col("cohort") == "Overall")
            & (F.col("model_name") == name)
            & (F.col("metric_name") == f"catalog_coverage@{k}")
        )
        return F.max(F.when(wanted, F.col("metric_value")))

    return rows.agg(F.round(F.try_divide(coverage(model), coverage(baseline)), 6)
                    .alias("coverage_lift"))


def selected_metric(
    rows: DataFrame, cohort: str | None = None, model: str | None = None, metric: str | None = None
) -> DataFrame:
    """The metric value when the selection leaves exactly one row, blank otherwise; and the
    number of users evaluated in the selection."""
    chosen = {"cohort": cohort, "model_name": model, "metric_name": metric}
    for column, value in chosen.items():
        if value is not None:
            rows = rows.filter(F.col(column) == value)
    return rows.agg(
        F.when(F.count("*") == 1, F.max("metric_value")).alias("selected_metric_value"),
        F.max("evaluated_users").alias("metric_evaluated_users"),
    )

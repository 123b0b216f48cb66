"""Columns with clashing or dotted names, rows repeated very often, and rows without ids."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cartlark.llm import common, decontaminate, language_id, near_dup, toxicity

SF = "/root/testdata/sf0.001"
CLASHES = ["_text_key", "_places", "_cut_id", "_cut_key", "_id", "_key", "_toxicity", "_language",
           "_language_score", "_known", "a.b", "c`d", "n_words", "component"]


def with_clashes(docs):
    return docs.withColumns({name: F.concat(F.lit(name), "doc_id") for name in CLASHES})


def kept_as_they_were(result, given):
    assert result.columns == given.columns
    quoted = [f"`{c.replace('`', '``')}` = concat('{c}', doc_id)" for c in CLASHES]
    assert result.count() > 0 and result.filter("not (" + " and ".join(quoted) + ")").isEmpty()


@pytest.mark.parametrize("place", range(4))
def test_stages_leave_other_columns_alone(spark, place):
    docs = with_clashes(common.table(spark, SF, "documents"))
    name, stage = corpus_pipeline.STAGES[place]
    result = stage(spark, docs, SF)
    kept_as_they_were(result, docs)
    plain = stage(spark, common.table(spark, SF, "documents"), SF)
    assert sorted(r[0] for r in result.select("doc_id").collect()) == sorted(
        r[0] for r in plain.select("doc_id").collect())


def test_spans_are_cut_beside_clashing_columns(spark, documents):
    text = "one two three four five six seven eight nine ten"
    docs = with_clashes(documents([(1, f"Before, {text}! After."), (2, "clean words")]))
    items = spark.createDataFrame([("a", text)], "item_id string, text string")
    result = decontaminate.remove_spans(docs, items)
    kept_as_they_were(result, docs)
    assert {r["doc_id"]: r["text"] for r in result.collect()} == {
        1: "Before, After.", 2: "clean words"}
    dropped = decontaminate.drop_contaminated(docs, items)
    kept_as_they_were(dropped, docs)
    kept_as_they_were(near_dup.drop_near_duplicates(docs), docs)


def copies(spark, n, distinct):
    """``distinct`` rows with ids, and one row ``n`` times."""
    rows = spark.range(distinct).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("text number "), "id").alias("text"),
        F.when(F.col("id") % 2 == 0, "en").otherwise("de").alias("lang"),
    )
    hot = spark.range(n).select(
        F.lit(-1).cast("bigint").alias("doc_id"), F.lit("the same text").alias("text"),
        F.lit("en").alias("lang"),
    )
    return rows.union(hot)


def test_equal_rows_count_once_in_the_toxicity_sample(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE_ROWS", 400)
    monkeypatch.setattr(toxicity, "SHARD_ROWS", 50)
    docs = copies(spark, 20_000, 300)
    marks = docs.select("doc_id").distinct().withColumn("_toxic", F.lit(0))
    sample = toxicity.bounded_sample(docs, marks)
    assert sample.count() <= 301
    # Many texts of one id are drawn and dealt one by one.
    many = spark.range(5000).select(
        F.lit(7).cast("bigint").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    sample = toxicity.bounded_sample(many, many.select("doc_id").distinct().withColumn(
        "_toxic", F.lit(1)))
    sizes = [r["count"] for r in sample.groupBy("shard").count().collect()]
    assert 300 < sum(sizes) < 500 and max(sizes) < 100


def test_equal_rows_and_null_ids_in_the_language_sample(spark, monkeypatch):
    monkeypatch.setattr(language_id, "SAMPLE_ROWS", 300)
    monkeypatch.setattr(language_id, "SHARD_ROWS", 60)
    stored, samples = common.stored, []

    def kept(df, name):
        result = stored(df, name)
        if name == "language_sample":
            samples.append(result)
        return result

    monkeypatch.setattr(language_id.common, "stored", kept)
    model = language_id.fit(copies(spark, 20_000, 2000), F.lit(True))
    assert samples[0].count() <= 400 and set(model.languages) == {"en", "de"}
    without_ids = copies(spark, 0, 2000).withColumn("doc_id", F.lit(None).cast("bigint"))
    language_id.fit(without_ids, F.lit(True))
    shards = [r["count"] for r in samples[1].groupBy("shard").count().collect()]
    assert len(shards) > 2 and max(shards) < 140
    assert 0 < samples[1].filter("kept").count() < 80


def test_a_step_of_the_multinomial_regression_by_hand():
    state = language_id.Ftrl(3)
    at, values = np.array([4, 9]), np.array([0.6, 0.8])
    state.learn(at, values, 2)
    # All weights are 0, so each class has a chance of a third.
    error = np.array([1 / 3, 1 / 3, -2 / 3])
    for place, value in zip(at, values):
        assert state.z[place] == pytest.approx(value * error)
        assert state.n[place] == pytest.approx((value * error) ** 2)
    expected = np.zeros((2, 3))
    for i, value in enumerate(values):
        for c in range(3):
            g = value * error[c]
            if abs(g) > language_id.L1:
                soft = math.copysign(abs(g) - language_id.L1, g)
                expected[i, c] = -soft / (
                    (language_id.BETA + abs(g)) / language_id.ALPHA + language_id.L2)
    assert state.weights(at) == pytest.approx(expected)
    before = state.z[at].copy()
    w = expected
    state.learn(at, values, 0)
    chances = np.exp(values @ w) / np.exp(values @ w).sum()
    chances[0] -= 1
    for i, value in enumerate(values):
        g = value * chances
        old = (value * error) ** 2
        sigma = (np.sqrt(old + g * g) - np.sqrt(old)) / language_id.ALPHA
        assert state.z[at[i]] == pytest.approx(before[i] + g - sigma * w[i])


def test_a_tf_idf_vector_by_hand():
    at, counts = language_id.ngram_counts("aab")
    # a, a, b; aa, ab; aab: five different n-grams, one of them twice.
    assert sorted(counts.tolist()) == [1, 1, 1, 1, 2]
    idf = np.ones(language_id._SIZE)
    idf[at[counts == 2]] = 3.0
    same, values = language_id.vector("AAB", idf)
    raw = np.where(counts == 2, (1 + math.log(2)) * 3.0, 1.0)
    assert same.tolist() == at.tolist()
    assert values == pytest.approx(raw / math.sqrt((raw**2).sum()))

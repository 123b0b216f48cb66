import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartlark.llm import language_id, toxicity

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def scored(spark):
    rows = toxicity.op2_toxicity(spark, SF).collect()
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    return rows, labels


def test_toxicity_on_held_out_documents(scored):
    rows, labels = scored
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    toxic = np.array([labels[r["doc_id"]] for r in held], bool)
    predicted = np.array([r["predicted"] for r in held], bool)
    assert predicted[toxic].mean() > 0.7 and predicted[~toxic].mean() < 0.03


def test_toxicity_learns_from_allowed_rows_only(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    allowed = F.pmod("doc_id", F.lit(2)) == 0
    flipped = labels.withColumn("toxic", F.when(allowed, F.col("toxic")).otherwise(1 - F.col("toxic")))
    one, two = (toxicity.fit(docs, x, allowed) for x in (labels, flipped))
    assert (one.at == two.at).all() and np.allclose(one.weight, two.weight) and one.bias == two.bias


def test_features_are_words_pairs_and_skips():
    assert len(toxicity.features("one two three four")) == 4 + 3 + 2
    assert len(toxicity.features("one")) == 1 and len(toxicity.features(None)) == 0
    a, b = toxicity.features("a x b"), toxicity.features("a y b")
    assert len(np.intersect1d(a, b)) == 3  # a, b, and the pair around the middle
    assert (toxicity.features("A, b!") == toxicity.features("a b")).all()


def test_ftrl_step_by_hand():
    state = toxicity.Ftrl(4, 0.5)
    at = np.array([1, 4])
    state.learn(at, 1.0)
    gradient = (0.5 - 1.0) * toxicity.POSITIVE
    assert state.z[1] == pytest.approx(gradient) and state.n[1] == pytest.approx(gradient**2)
    w = state.weights(at)
    rate = toxicity.ALPHA / (toxicity.BETA + abs(gradient))
    assert w[0] == pytest.approx((abs(gradient) - 0.5) * rate)
    assert w[1] == pytest.approx(abs(gradient) * rate)  # the bias is not penalised
    assert state.weights(np.array([0]))[0] == 0


def test_toxicity_of_odd_rows(spark, documents):
    docs = documents([(1, "you idiot"), (1, "you idiot"), (None, "fine day"), (2, None), (3, ""), (4, "x " * 100_000)])
    docs = docs.withColumn("SCORE", F.lit("clash"))
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (3, None), (None, 1)], "doc_id bigint, toxic int")
    model = toxicity.fit(docs, labels, F.lit(True))
    found = toxicity.score(docs, model, "score")
    assert found.count() == 6 and [c for c in found.columns if c.lower() == "score"] == ["score"]
    scores = {(r["doc_id"], r["text"]): r["score"] for r in found.collect()}
    assert scores[2, None] == scores[3, ""]
    nothing = toxicity.fit(docs, labels.filter("false"), F.lit(True))
    assert {r["score"] for r in toxicity.score(docs, nothing, "s").select(F.col("s").alias("score")).collect()} == {0.5}
    assert toxicity.score(documents([]), model).isEmpty()


def test_languages_on_held_out_documents(spark):
    rows = language_id.op10_language_id(spark, SF).collect()
    docs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert np.mean([docs[r["doc_id"]] == r["lang_pred"] for r in held]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_languages_of_odd_rows(spark, documents):
    rng = random.Random(0)
    rows = [(i, " ".join(rng.choices(["the", "and", "with"], k=9)), "en") for i in range(40)]
    rows += [(i, " ".join(rng.choices(["der", "und", "mit"], k=9)), "de") for i in range(40, 80)]
    odd = [(90, None, "en"), (91, "", "de"), (92, "12 !?", "en"), (None, "und der", None), (1, "the " * 50_000, "en")]
    docs = documents(rows + odd).withColumn("lang_pred", F.lit("clash"))
    model = language_id.fit(docs, F.lit(True))
    assert model.languages == ["de", "en"] and model.sharpness in language_id.SHARPNESS
    assert (model.weights == 0).mean() > 0.5
    found = language_id.identify(docs, model)
    assert found.count() == len(rows) + 5
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in found.collect()}
    assert got[90] == got[91] == got[92] == ("und", 0.0)
    assert got[None][0] == "de" and got[1][0] == "en"
    assert all(got[i][0] == lang for i, _, lang in rows)
    assert language_id.fit(docs.filter("false"), F.lit(True)) is None
    assert {r["lang_pred"] for r in language_id.identify(docs, None).collect()} == {"und"}
    assert language_id.identify(documents([]), model).isEmpty()


def test_rare_languages_are_learned_from_a_small_sample(spark, documents, monkeypatch):
    monkeypatch.setattr(language_id, "SAMPLE_ROWS", 200)
    monkeypatch.setattr(language_id, "SHARD_ROWS", 50)
    monkeypatch.setattr(language_id, "LEAST_ROWS", 20, raising=False)
    rng, words = random.Random(0), {"en": ["the", "and", "with"], "de": ["der", "und", "mit"],
                                    "ru": ["это", "или", "что"], "el": ["και", "της", "που"]}
    many = {"en": 2000, "de": 2000, "ru": 30, "el": 5}
    rows = [(lang, " ".join(rng.choices(words[lang], k=12))) for lang, n in many.items() for _ in range(n)]
    docs = documents([(i, text, lang) for i, (lang, text) in enumerate(rows)])
    drawn, store = [], language_id.common.stored
    monkeypatch.setattr(language_id.common, "stored", lambda df, name: drawn.append(store(df, name)) or drawn[-1])
    model = language_id.fit(docs, F.lit(True))
    assert model.languages == ["de", "el", "en", "ru"]
    found = {r["lang"]: r["count"] for r in drawn[0].groupBy("lang").count().collect()}
    assert found["el"] == 5 and found["ru"] >= 10 and sum(found.values()) < 260
    rare = language_id.identify(docs.filter("lang in ('ru', 'el')"), model)
    assert rare.filter("lang = lang_pred").count() == 35


def test_draw_shares_keep_both_bounds(monkeypatch):
    n, size = [10**9, 5 * 10**5, 300, 3], [10**12, 10**9, 10**7, 3000]
    shares = language_id.draw_shares(n, size)
    assert sum(s * x for s, x in zip(shares, n)) <= language_id.SAMPLE_ROWS
    assert sum(s * x for s, x in zip(shares, size)) <= language_id.SAMPLE_BYTES
    assert shares[3] == 1.0 and shares[1] * n[1] >= 199 and shares[0] * n[0] > 5000
    many = language_id.draw_shares([10**6] * 500, [10**9] * 500)
    assert sum(many) * 10**6 <= language_id.SAMPLE_ROWS and min(many) * 10**6 >= 6


def test_temperature_has_the_least_loss(spark, documents):
    rows = [(i, "aaa" if i % 2 else "bbb", "x" if i % 2 == (i % 10 > 0) else "y") for i in range(100)]
    docs = documents(rows)
    weights = np.zeros((1 << language_id.BITS, 2))
    at, _ = language_id.ngram_counts("aaa")
    weights[at, 0] = 50.0
    at, _ = language_id.ngram_counts("bbb")
    weights[at, 1] = 50.0
    model = language_id.Model(["x", "y"], np.ones(1 << language_id.BITS), weights)
    chosen = language_id.calibrate(docs.select("text", "lang"), model)
    assert chosen == min(language_id.SHARPNESS)  # a model too sure of itself is toned down

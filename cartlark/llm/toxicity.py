"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are the words of the lower-cased text, pairs of neighbours, and pairs with one
word between them, hashed into a fixed number of coordinates; a feature counts once per
text, so a single insult weighs the same in a short and in a very long text.  Learning
rates are per coordinate, and L1 sparsity leaves few weights, which every task receives.

The classifier is fitted on a bounded sample of the labelled rows: at most about
``SAMPLE_ROWS`` rows and ``SAMPLE_BYTES`` bytes, chosen by a hash of the row.  Shards of the
sample are fitted side by side and their weights averaged.

A null or empty text has no feature and gets the score of the bias.  Rows with a null label
are not learned from; without any labelled row every score is 0.5.  Null and repeated ids
are carried along.  Columns with the names of output columns are replaced.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartlark.llm import common

BITS = 22
SAMPLE_ROWS = 24_000
SAMPLE_BYTES = 64 << 20
SHARD_ROWS = 6_000
EPOCHS = 4
THRESHOLD = 0.7
#: Per-coordinate rate, the L1 penalty per row of a shard and at least, the weight of label 1.
ALPHA, BETA, L1_PER_ROW, L1_LEAST, POSITIVE = 8.0, 1.0, 0.001, 8.0, 3.0
_WORD = re.compile(r"\w+")
#: Odd multipliers, one for each kind of feature.
_KINDS = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_SHIFT = np.uint64(64 - BITS)
_ROTATE = np.uint64(0xFF51AFD7ED558CCD)


def features(text: str | None) -> np.ndarray:
    """Coordinates of a text's features, with repeats."""
    import xxhash

    words = _WORD.findall(text.lower()) if text else []
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    pair = h * _ROTATE
    hashed = [h * _KINDS[0]]
    for gap, kind in ((1, _KINDS[1]), (2, _KINDS[2])):
        if len(h) > gap:
            mixed = (pair[:-gap] ^ (pair[:-gap] >> np.uint64(29))) + h[gap:]
            hashed.append(mixed * kind)
    return (np.concatenate(hashed) >> _SHIFT).astype(np.int64)


class Ftrl:
    """FTRL-proximal state: coordinate 0 to ``size`` - 1, and one for the bias."""

    def __init__(self, size: int, l1: float):
        self.l1 = l1
        self.z = np.zeros(size + 1)
        self.n = np.zeros(size + 1)
        self.bias = size

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        soft = np.sign(z) * np.maximum(np.abs(z) - np.where(at == self.bias, 0.0, self.l1), 0.0)
        return -soft * ALPHA / (BETA + np.sqrt(n))

    def learn(self, at: np.ndarray, label: float) -> None:
        w = self.weights(at)
        gradient = (_sigmoid(w.sum()) - label) * (POSITIVE if label else 1.0)
        n = self.n[at]
        grown = n + gradient * gradient
        self.z[at] += gradient - (np.sqrt(grown) - np.sqrt(n)) / ALPHA * w
        self.n[at] = grown


def _sigmoid(x: float) -> float:
    return float(1.0 / (1.0 + np.exp(-np.clip(x, -60.0, 60.0))))


@dataclass
class Model:
    """Non-zero weights by ascending coordinate, and the bias."""

    at: np.ndarray
    weight: np.ndarray
    bias: float


def bounded_sample(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """``text``, ``label``, ``key`` and ``shard`` of at most about ``SAMPLE_ROWS`` labelled
    rows and ``SAMPLE_BYTES`` bytes.  Texts are read for the drawn ids alone: they are few
    enough to be sent to the rows, so no text is shuffled before it is drawn.  Equal rows
    count once, and the different texts of one id are drawn and dealt one by one."""
    n = marks.count()
    draw = F.pmod(F.xxhash64("doc_id", F.lit(0)), F.lit(1 << 20))
    share = min(1.0, SAMPLE_ROWS / max(1, n))
    drawn = marks.filter(draw < F.lit(int(share * (1 << 20))))
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    rows = texts.join(F.broadcast(drawn), "doc_id").select(
        "text", F.col("_toxic").cast("double").alias("label"),
        F.xxhash64("doc_id", "text").alias("key"),
    ).distinct()
    n, size = rows.agg(
        F.count("*"), F.coalesce(F.sum(F.octet_length("text").cast("bigint")), F.lit(0))
    ).first()
    share = min(1.0, SAMPLE_BYTES / max(1, size), SAMPLE_ROWS / max(1, n))
    shards = max(1, math.ceil(share * n / SHARD_ROWS))
    return rows.filter(
        F.pmod(F.xxhash64("key", F.lit(2)), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)))
    ).withColumn("shard", F.pmod(F.xxhash64("key", F.lit(1)), F.lit(shards)))


def fit(docs: DataFrame, labels: DataFrame, learnable: Column) -> Model:
    """Learns ``labels.toxic`` of the ``docs`` rows whose id is ``learnable``."""
    marks = labels.filter(learnable & F.expr("doc_id is not null and toxic is not null")).groupBy(
        "doc_id"
    ).agg(F.max("toxic").alias("_toxic"))

    def fit_shard(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["key", "label"], kind="stable")
        examples = [np.unique(features(text)) for text in rows["text"]]
        state = Ftrl(1 << BITS, max(L1_LEAST, L1_PER_ROW * len(examples)))
        order = np.random.default_rng(0)
        for _ in range(EPOCHS):
            for place in order.permutation(len(examples)):
                at = np.append(examples[place], state.bias)
                state.learn(at, float(rows["label"].iloc[place]))
        at = np.flatnonzero(state.z)
        w = state.weights(at)
        return pd.DataFrame({"at": at[w != 0], "w": w[w != 0]})

    sample = common.stored(bounded_sample(docs, marks), "toxicity_sample")
    shards = sample.select("shard").distinct().count()
    mixed = (
        sample.select("shard", "key", "text", "label")
        .groupBy("shard")
        .applyInPandas(fit_shard, "at bigint, w double")
        .groupBy("at")
        .agg(F.sum("w").alias("w"))
        .toPandas()  # at most one row per coordinate, few after L1
        .sort_values("at")
    )
    is_bias = mixed["at"] == 1 << BITS
    w = mixed["w"] / max(1, shards)
    return Model(
        mixed["at"][~is_bias].to_numpy(np.int64), w[~is_bias].to_numpy(float),
        float(w[is_bias].sum()),
    )


def score(docs: DataFrame, model: Model, column: str = "toxicity") -> DataFrame:
    """Adds the probability of label 1, in place."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def compute():
        held = sent.value
        known = np.zeros(1 << BITS, bool)
        known[held.at] = True

        def work(texts: pa.Array) -> list[pa.Array]:
            out = []
            for text in texts:
                at = features(text.as_py())
                met = np.unique(at[known[at]])
                out.append(_sigmoid(held.bias + held.weight[np.searchsorted(held.at, met)].sum()))
            return [pa.array(out, pa.float64())]

        return work

    return common.appending(docs, [(column, T.DoubleType())], "text", compute)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a model of the rows that are not held out."""
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = common.remainder() == 1
    model = fit(docs, common.table(spark, sf_dir, "labels"), ~held_out)
    return score(docs, model, "score").select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )

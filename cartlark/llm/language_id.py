"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Runs of one to three characters of the lower-cased text are hashed into a fixed number of
coordinates, weighted by (1 + log count) x inverse document frequency, and scaled to unit
length.  Document frequencies come from all rows that may be learned from.  The weights are
fitted by follow-the-regularised-leader with an elastic-net penalty on a bounded sample (at
most about ``SAMPLE_ROWS`` rows and ``SAMPLE_BYTES`` bytes, chosen by a hash of the row), in
shards whose weights are averaged.  Languages are those of all learnable rows: of each the
sample holds ``LEAST_ROWS`` rows if there are so many (fewer when the least numbers would
take more than half of the sample, one at least), and the rest is in proportion.  A
language's weights are averaged over the shards that saw it.  A tenth of the sample is kept
for the temperature that calibrates the probabilities.

A text that is null or has no letter is ``und`` with score 0, and so is every text where
nothing could be learned.  Rows with a null language are not learned from.  Null and
repeated ids are carried along.  Columns with the names of output columns are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartlark.llm import common

BITS = 16
ORDERS = 3
SAMPLE_ROWS = 12_000
SAMPLE_BYTES = 32 << 20
SHARD_ROWS = 2_000
#: Rows drawn of each language at least (all of a language with fewer), and the number of
#: rows below which all of a language are learned from and none kept.
LEAST_ROWS, FEW_ROWS = 200, 10
EPOCHS = 2
#: Per-coordinate rate, and the elastic net.
ALPHA, BETA, L1, L2 = 1.0, 1.0, 0.02, 0.02
UNKNOWN = "und"
#: An n-gram is common in a language if this share of the texts learned from hold it.  A text
#: is known to be of a language by its share of common n-grams: ``SLACK`` of what all but
#: ``OUTLIERS`` of the language's kept texts reach.  No number of languages enters.
COMMON, OUTLIERS, SLACK = 0.01, 0.01, 0.5
#: Inverse temperatures that calibration chooses from.
SHARPNESS = tuple(float(x) for x in np.geomspace(0.25, 16.0, 37))
_SIZE = 1 << BITS
_PLACES = 1 << 20
_MIX = np.uint32(0x9E3779B1)
_SHIFT = np.uint32(32 - BITS)


def ngram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates of a text's character n-grams and how often each occurs."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    total = np.zeros(_SIZE, np.int64)
    mixed = codes * _MIX
    for order in range(1, ORDERS + 1):
        if len(mixed) == 0:
            break
        total += np.bincount(((mixed ^ np.uint32(order)) * _MIX) >> _SHIFT, minlength=_SIZE)
        mixed = (mixed[:-1] ^ (mixed[:-1] >> np.uint32(15))) * _MIX + codes[order:]
    at = np.flatnonzero(total)
    return at, total[at]


def vector(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return weighted(*ngram_counts(text), idf)


def weighted(at: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    values = (1.0 + np.log(counts)) * idf[at]
    return at, values / max(1e-12, float(np.sqrt(values @ values)))


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


class Ftrl:
    """One state per coordinate and class."""

    def __init__(self, classes: int):
        self.z = np.zeros((_SIZE, classes))
        self.n = np.zeros((_SIZE, classes))

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        soft = np.sign(z) * np.maximum(np.abs(z) - L1, 0.0)
        return -soft / ((BETA + np.sqrt(n)) / ALPHA + L2)

    def learn(self, at: np.ndarray, values: np.ndarray, label: int) -> None:
        w = self.weights(at)
        error = softmax(values @ w)
        error[label] -= 1.0
        gradient = values[:, None] * error[None, :]
        n = self.n[at]
        grown = n + gradient * gradient
        self.z[at] += gradient - (np.sqrt(grown) - np.sqrt(n)) / ALPHA * w
        self.n[at] = grown


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max())
    return e / e.sum()


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # coordinates x languages
    sharpness: float = 1.0
    common: np.ndarray | None = None  # coordinates x languages: in enough texts learned from
    least_share: np.ndarray | None = None  # per language

    def logits(self, text: str) -> np.ndarray:
        return self.logits_of(*ngram_counts(text))

    def logits_of(self, at: np.ndarray, counts: np.ndarray) -> np.ndarray:
        at, values = weighted(at, counts, self.idf)
        return values @ self.weights[at]

    def share(self, at: np.ndarray, counts: np.ndarray, which: int) -> float:
        """The share of a text's n-grams that are common in a language."""
        return float(counts @ self.common[at, which]) / max(1, int(counts.sum()))


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """In how many texts each coordinate occurs, and the number of texts: all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, rows = np.zeros(_SIZE + 1, np.int64), 0
        for batch in batches:
            for text in batch.column(0):
                found[ngram_counts(text.as_py())[0]] += 1
                rows += 1
        found[_SIZE] = rows
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(found[at])], names=["at", "n"])

    sums = (
        texts.mapInArrow(run, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n"))
        .toPandas()  # one row per coordinate at most
    )
    found = np.zeros(_SIZE + 1, np.int64)
    found[sums["at"].to_numpy()] = sums["n"].to_numpy()
    return found[:_SIZE], int(found[_SIZE])


def draw_shares(rows: list[int], sizes: list[int]) -> list[float]:
    """The share of each language's rows to draw, given its rows and bytes: one share for all,
    but ``LEAST_ROWS`` rows of each at least, within ``SAMPLE_ROWS`` and ``SAMPLE_BYTES``.
    The least numbers take half of these bounds at most; many languages lower them."""
    n, size = np.array(rows, float), np.array(sizes, float)

    def fits(shares: np.ndarray, part: float = 1.0) -> bool:
        return shares @ n <= part * SAMPLE_ROWS and shares @ size <= part * SAMPLE_BYTES

    if fits(np.ones(len(n))):
        return [1.0] * len(n)
    least = LEAST_ROWS
    while least > 1 and not fits(np.minimum(1.0, least / n), 0.5):
        least //= 2
    floor, low, high = np.minimum(1.0, least / n), 0.0, 1.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if fits(np.maximum(floor, middle)) else (low, middle)
    return np.maximum(floor, low).tolist()


def fit(docs: DataFrame, learnable: Column) -> Model | None:
    """Learns ``lang`` from ``text`` of the rows that are ``learnable``."""
    rows = docs.filter(learnable & F.col("text").isNotNull() & F.col("lang").isNotNull()).select(
        F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"),
        F.xxhash64("doc_id", "text").alias("key"),  # rows of one id, or of none, differ too
    )
    frequency, n_docs = document_frequencies(rows.select("text"))
    if not n_docs:
        return None
    place_of = F.pmod(F.xxhash64("text", "key"), F.lit(_PLACES))
    # Equal rows count once; only digests and sizes move.
    once = rows.select(
        "lang", "key", F.octet_length("text").cast("bigint").alias("bytes"), place_of.alias("at")
    ).distinct()
    totals = (
        once.groupBy("lang").agg(
            F.count("*").alias("n"), F.sum("bytes").alias("bytes"), F.min("at").alias("least"),
        ).orderBy("lang").collect()  # one row per language
    )
    languages = [row["lang"] for row in totals]
    shares = draw_shares([row["n"] for row in totals], [row["bytes"] for row in totals])
    n_drawn = sum(x * row["n"] for x, row in zip(shares, totals, strict=True))
    shards = max(1, math.ceil(n_drawn / SHARD_ROWS))
    limits = docs.sparkSession.createDataFrame(
        [
            (row["lang"], max(int(x * _PLACES), row["least"] + 1), row["n"] >= FEW_ROWS)
            for x, row in zip(shares, totals, strict=True)
        ],
        "lang string, limit bigint, enough boolean",
    )
    sample = common.stored(
        rows.join(F.broadcast(limits), "lang").filter(place_of < F.col("limit"))
        .withColumn("shard", F.pmod(F.xxhash64("key", F.lit(1)), F.lit(shards)))
        .withColumn("kept", F.col("enough") & (F.pmod(F.xxhash64("key", F.lit(2)), F.lit(10)) == 0))
        .select("text", "lang", "key", "shard", "kept").distinct(),
        "language_sample",
    )
    idf = np.log((1.0 + n_docs) / (1.0 + frequency)) + 1.0
    place = {name: i for i, name in enumerate(languages)}

    def fit_shard(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["key", "lang"], kind="stable")
        examples = [vector(text, idf) for text in part["text"]]
        wanted = part["lang"].map(place).to_numpy()
        state = Ftrl(len(place))
        order = np.random.default_rng(0)
        for _ in range(EPOCHS):
            for at in order.permutation(len(examples)):
                state.learn(*examples[at], wanted[at])
        w, texts = state.weights(np.arange(_SIZE)), np.zeros((_SIZE, len(place)), np.int64)
        for (at, _), label in zip(examples, wanted, strict=True):
            texts[at, label] += 1
        w[:, np.setdiff1d(np.arange(len(place)), wanted)] = 0.0  # only pushed down here
        at, which = np.nonzero((w != 0) | (texts > 0))
        return pd.DataFrame(
            {"at": at, "lang": which, "w": w[at, which], "texts": texts[at, which]}
        )

    learned = sample.filter(~F.col("kept"))
    mixed = (
        learned.groupBy("shard")
        .applyInPandas(fit_shard, "at bigint, lang bigint, w double, texts bigint")
        .groupBy("at", "lang").agg(F.sum("w").alias("w"), F.sum("texts").alias("texts"))
        .toPandas()  # coordinates x languages at most
    )
    weights, texts = np.zeros((_SIZE, len(languages))), np.zeros((_SIZE, len(languages)))
    weights[mixed["at"], mixed["lang"]] = mixed["w"]
    texts[mixed["at"], mixed["lang"]] = mixed["texts"]
    n_texts, n_shards = np.zeros(len(languages)), np.ones(len(languages))
    counts = learned.groupBy("lang", "shard").count().groupBy("lang").agg(
        F.sum("count").alias("texts"), F.count("*").alias("shards")
    )
    for row in counts.collect():
        n_texts[place[row["lang"]]], n_shards[place[row["lang"]]] = row["texts"], row["shards"]
    weights /= n_shards  # a language's mean is over the shards that saw it
    model = Model(languages, idf, weights)
    model.common = (texts > 0) & (texts >= COMMON * n_texts)
    model.sharpness = calibrate(sample.filter("kept"), model)
    model.least_share = least_shares(sample.filter("kept"), model)
    return model


def least_shares(kept: DataFrame, model: Model) -> np.ndarray:
    """Per language, ``SLACK`` of the share of common n-grams that all but ``OUTLIERS`` of its
    ``text``, ``lang`` rows reach; 0 for a language without rows."""
    place = {name: i for i, name in enumerate(model.languages)}

    def shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = [place[lang] for lang in batch.column(1).to_pylist()]
            texts = batch.column(0).to_pylist()
            found = [
                (label, model.share(*ngram_counts(text), label))
                for text, label in zip(texts, labels, strict=True)
                if has_letter(text)
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in found], pa.int64()),
                 pa.array([x[1] for x in found], pa.float64())], names=["at", "share"],
            )

    found = (
        kept.select("text", "lang").mapInArrow(shares, "at bigint, share double")
        .toPandas()  # a tenth of the sample
    )
    least = np.zeros(len(model.languages))
    for at, part in found.groupby("at"):
        least[at] = SLACK * part["share"].quantile(OUTLIERS, interpolation="lower")
    return least


def calibrate(kept: DataFrame, model: Model) -> float:
    """The inverse temperature with the least log loss over ``text``, ``lang`` rows."""
    place = {name: i for i, name in enumerate(model.languages)}

    def losses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(SHARPNESS))
        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1), strict=True):
                logits = model.logits(text.as_py())
                for i, sharp in enumerate(SHARPNESS):
                    total[i] -= np.log(softmax(sharp * logits)[place[lang.as_py()]] + 1e-12)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(SHARPNESS))), pa.array(total)], names=["at", "loss"]
        )

    sums = (
        kept.select("text", "lang").mapInArrow(losses, "at bigint, loss double")
        .groupBy("at").agg(F.sum("loss").alias("loss")).collect()
    )
    best = min(sums, key=lambda row: (round(row["loss"], 9), row["at"]), default=None)
    return SHARPNESS[best["at"]] if best and best["loss"] > 0 else 1.0


def identify(
    docs: DataFrame, model: Model | None, language: str = "lang_pred", score: str = "score",
    known: str | None = None,
) -> DataFrame:
    """Adds the predicted language and its calibrated probability, in place, and under the
    name ``known`` whether enough of the text's n-grams are common in that language."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def compute():
        held = sent.value

        def work(texts: pa.Array) -> list[pa.Array]:
            names, scores, familiar = [], [], []
            for text in texts.to_pylist():
                name, value, enough = UNKNOWN, 0.0, False
                if held is not None and has_letter(text):
                    grams = ngram_counts(text)
                    chances = softmax(held.sharpness * held.logits_of(*grams))
                    best = int(chances.argmax())
                    name, value = held.languages[best], float(chances.max())
                    enough = bool(known) and held.share(*grams, best) >= held.least_share[best]
                names.append(name)
                scores.append(value)
                familiar.append(bool(enough))
            found = [pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            return [*found, pa.array(familiar, pa.bool_())] if known else found

        return work

    fields = [(language, T.StringType()), (score, T.DoubleType())]
    fields += [(known, T.BooleanType())] if known else []
    return common.appending(docs, fields, "text", compute)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents by a model of the rows that are not held out."""
    docs = common.table(spark, sf_dir, "documents")
    held_out = common.remainder() == 1
    model = fit(docs, ~held_out)
    return identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score"
    )

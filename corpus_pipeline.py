"""A corpus from raw documents to packed sequences.

Each stage works on all rows that the stage before it kept.  Stages but the last return the
columns they were given, whatever their names: helper columns take names that are free.

A null or empty text is not toxic, but has no language and goes in the second stage, as do texts
without letters.  Rows with a null or repeated id are judged by their own texts; equal rows are
near-duplicates of each other, and one stays.  Of tied near-duplicates the smallest id stays,
then the least text.  Very long texts are read whole and cut into windows by the last stage.
An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlark.llm import common, decontaminate, language_id, near_dup, packing, toxicity


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without toxic content, by a model of the labelled documents."""
    model = toxicity.fit(docs, common.table(spark, sf_dir, "labels"), F.lit(True))
    column = common.free_name(docs, "_toxicity")
    scored = toxicity.score(docs, model, column)
    return scored.filter(F.col(column) < toxicity.THRESHOLD).select(common.columns(docs))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters whose language is one of those learned: enough of their n-grams
    are common in it.  A language written like a learned one may share so many that it stays."""
    model = language_id.fit(docs, F.lit(True))
    names = [common.free_name(docs, n) for n in ("_language", "_language_score", "_known")]
    named = language_id.identify(docs, model, *names)
    return named.filter(F.col(names[2])).select(common.columns(docs))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return near_dup.drop_near_duplicates(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontaminate.drop_contaminated(docs, common.table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token windows with their place in a sequence."""
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", not_toxic),
    ("language ID", known_language),
    ("MinHash near-dedup", one_of_each),
    ("benchmark decontamination", without_benchmark),
    ("packing", packed),
]

#: Learned models decide in the first two stages, which SQL cannot state.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read by the next."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.stored(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs

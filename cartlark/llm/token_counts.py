"""Token counts through a digest cache.

Counts are stored under the digest of the normalised content (a null text is the empty
text; nothing else changes, as anything else could change the count) and the digest of the
tokenizer's file and library version.  A run joins the digests of its texts to the stored
counts, encodes each distinct text that is missing once, and appends the new counts.

Null and repeated ``doc_id`` values are carried along: every input row gets its counts.  An
empty table gives no rows.  Input columns other than the id and the text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlark.llm import common, tokens

LIMIT = 1024
_COUNTS = "digest binary, n_tokens bigint"


def _folder(cache: str, tokenizer: str) -> str:
    return f"{cache}/tokenizer={tokens.fingerprint(tokenizer)}"


def cached_counts(spark: SparkSession, cache: str, tokenizer: str) -> DataFrame:
    """The stored counts of a tokenizer version, one row per content digest."""
    path = _folder(cache, tokenizer)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(hadoop):
        return spark.createDataFrame([], _COUNTS)
    stored = spark.read.schema(_COUNTS).parquet(path)
    # Two runs may have appended the same text; their counts are equal.  Rows are dealt by
    # both columns here, so that a join by digest shuffles anew and can split a hot digest.
    return stored.distinct()


def encode_misses(texts: DataFrame, tokenizer: str) -> DataFrame:
    """``digest``, ``text`` rows to ``digest``, ``n_tokens``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(tokenizer)
        for batch in batches:
            counts = [len(encoder.ids(text.as_py())) // 4 for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), pa.array(counts, pa.int64())],
                names=["digest", "n_tokens"],
            )

    return texts.mapInArrow(run, _COUNTS)


def count_tokens(docs: DataFrame, tokenizer: str, cache: str) -> DataFrame:
    """``doc_id``, ``n_bytes`` and ``n_tokens`` of every row; new counts go to ``cache``."""
    spark = docs.sparkSession
    texts = docs.select(
        F.col("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    ).withColumn("digest", F.unhex(F.sha2("text", 256)))
    misses = (
        texts.select("digest", "text")
        .dropDuplicates(["digest"])  # combined before the shuffle: copies are not sent
        .join(cached_counts(spark, cache, tokenizer), "digest", "left_anti")
    )
    encode_misses(misses, tokenizer).write.mode("append").parquet(_folder(cache, tokenizer))
    rows = texts.select("doc_id", "digest", F.octet_length("text").cast("bigint").alias("n_bytes"))
    # A text that many rows share is a skewed key here; adaptive execution splits it.
    return rows.join(cached_counts(spark, cache, tokenizer), "digest").drop("digest")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of all documents with a cache of its own, so that every text is a miss."""
    import public_tokenizers

    counts = count_tokens(
        common.table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        common.new_path(spark, "token_counts"),
    )
    return counts.select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit")
    )

"""Benchmark decontamination by a broadcast hash set of normalised test n-grams.

Words are runs of ASCII letters, digits and all non-ASCII characters, A-Z lower-cased.  A
benchmark item is cut into windows of ``n`` words (one shorter window for a shorter item),
and the distinct windows' hashes are sent to every executor, in parts of a bounded size.
Training texts are scanned window by window inside one generated stage: a window's hash is
looked up, and a hit is confirmed word by word.  Hits become covered word positions, from
which the counts, the items, and the texts without the covered spans follow.

DataFrame functions only.  Null or wordless texts have no window.  Items without words or
without an id take no part; rows with equal id and text share their result, whether the id
is null or not.  An empty benchmark or table gives no hit.  Other input columns are kept
where rows are returned whole; columns with the names of output columns are replaced.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlark.llm import common

N = 10
#: Bytes of windows sent to every executor at a time.
BROADCAST_BYTES = 32 << 20
_GAP = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
_WORD = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
_AZ, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """Words with A-Z lower-cased and nothing else changed."""
    lowered = F.translate(F.coalesce(text.cast("string"), F.lit("")), _AZ, _SMALL)
    return F.array_remove(F.split(lowered, _GAP), "")


def benchmark_windows(benchmark: DataFrame, n: int = N) -> DataFrame:
    """Distinct ``length``, ``key`` (a window's words) and ``item_id`` with that window."""
    items = benchmark.filter("item_id is not null").select(
        "item_id", words_of(F.col("text")).alias("words")
    )
    return (
        items.filter("size(words) > 0")
        .withColumn("length", F.least(F.lit(n), F.size("words")))
        .select("item_id", "words", "length",
                F.explode(F.expr("sequence(0, size(words) - length)")).alias("start"))
        .select("length", F.expr("slice(words, start + 1, length)").alias("key"), "item_id")
        .distinct()
    )


def _hash(words: str, start: str, length: int) -> Column:
    return F.xxhash64(*[F.expr(f"{words}[{start} + {i}]") for i in range(length)])


def _bytes_of(key: str) -> Column:
    return F.octet_length(F.array_join(key, " ")) + 32 * F.size(key) + 64


def _text_key() -> Column:
    """With the id: what tells rows apart whose results may differ."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return F.xxhash64(text, F.crc32(text.cast("binary")), F.length(text)).alias("text_key")


def find_hits(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """``doc_id``, ``text_key``, ``start``, ``length``, ``key`` of each window that occurs."""
    distinct = windows.select("length", "key").distinct()
    sizes = distinct.groupBy("length").agg(F.sum(_bytes_of("key")).alias("bytes")).collect()
    rows = docs.select("doc_id", _text_key(), words_of(F.col("text")).alias("words"))
    found = []
    for length, size in sorted(sizes):  # at most as many rows as a window has words
        own = distinct.filter(F.col("length") == length).select(
            "key", _hash("key", "0", length).alias("sent_hash")
        )
        # An outer explode: a filter inferred from an inner one would split each text twice.
        starts = rows.select(
            "*",
            F.explode_outer(
                F.expr(f"if(size(words) >= {length}, sequence(0, size(words) - {length}), array())")
            ).alias("start"),
        ).withColumn("hash", F.when(F.col("start").isNotNull(), _hash("words", "start", length)))
        same = F.col("key") == F.slice("words", F.col("start") + 1, F.lit(length))
        parts = math.ceil(size / BROADCAST_BYTES)
        for part in range(parts):
            sent = own.filter(F.pmod("sent_hash", F.lit(parts)) == part)
            found.append(
                starts.join(F.broadcast(sent), (F.col("hash") == F.col("sent_hash")) & same)
                .select("doc_id", "text_key", "start", F.lit(length).alias("length"), "key")
            )
    if not found:
        return docs.filter("false").select(
            "doc_id", _text_key(), F.lit(0).alias("start"), F.lit(0).alias("length"),
            F.array(F.lit("")).alias("key"),
        )
    return reduce(DataFrame.unionByName, found)


def covered_words(hits: DataFrame) -> DataFrame:
    """Distinct ``doc_id``, ``text_key``, ``place`` of the words inside a hit window."""
    ends = F.expr("sequence(start, start + length - 1)")
    return hits.select("doc_id", "text_key", F.explode(ends).alias("place")).distinct()


def found_items(hits: DataFrame, windows: DataFrame) -> DataFrame:
    """Distinct ``doc_id``, ``text_key``, ``item_id`` of the items with a window that occurs."""
    size = windows.agg(F.coalesce(F.sum(_bytes_of("key")), F.lit(0))).first()[0]
    held = F.broadcast(windows) if size <= BROADCAST_BYTES else windows
    met = hits.select("doc_id", "text_key", "length", "key").distinct()
    return met.join(held, ["length", "key"]).select("doc_id", "text_key", "item_id").distinct()


def report(docs: DataFrame, benchmark: DataFrame, n: int = N) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_hit``, ``n_items``, ``items`` of every row."""
    windows = common.stored(benchmark_windows(benchmark, n), "benchmark_windows")
    hits = common.stored(find_hits(docs, windows), "benchmark_hits")
    key = ["doc_id", "text_key"]
    covered = covered_words(hits).groupBy(*key).agg(F.count("*").alias("n_hit"))
    items = found_items(hits, windows).groupBy(*key).agg(
        F.count("*").alias("n_items"),
        F.array_sort(F.collect_list(F.col("item_id").cast("string"))).alias("items"),
    )
    marks = covered.join(items, _same_row(covered, items)).select(
        covered["doc_id"], covered["text_key"], "n_hit", "n_items", "items"
    )
    rows = docs.select(
        "doc_id", _text_key(), F.size(words_of(F.col("text"))).cast("bigint").alias("n_words")
    )
    return rows.join(marks, _same_row(rows, marks), "left").select(
        rows["doc_id"],
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("bigint").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def _same_row(left: DataFrame, right: DataFrame) -> Column:
    return (left["text_key"] == right["text_key"]) & left["doc_id"].eqNullSafe(right["doc_id"])


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, n: int = N) -> DataFrame:
    """The rows without any hit, whole."""
    windows = common.stored(benchmark_windows(benchmark, n), "benchmark_windows")
    hits = common.stored(
        find_hits(docs, windows).select("doc_id", "text_key").distinct(), "hit_rows"
    )
    key = common.free_name(docs, "_text_key")
    rows = docs.withColumn(key, _text_key())
    same = (rows[key] == hits["text_key"]) & rows["doc_id"].eqNullSafe(hits["doc_id"])
    return rows.join(hits, same, "left_anti").select(common.columns(docs))


def remove_spans(docs: DataFrame, benchmark: DataFrame, n: int = N) -> DataFrame:
    """All rows, whole, their texts without the covered words and the gaps behind them."""
    windows = common.stored(benchmark_windows(benchmark, n), "benchmark_windows")
    hits = common.stored(find_hits(docs, windows), "benchmark_hits")
    places, cut_id, cut_key, key = (
        common.free_name(docs, name) for name in ("_places", "_cut_id", "_cut_key", "_text_key")
    )
    cuts = covered_words(hits).groupBy("doc_id", "text_key").agg(
        F.collect_list("place").alias(places)  # at most the words of one text
    ).select(F.col("doc_id").alias(cut_id), F.col("text_key").alias(cut_key), places)
    rows = docs.withColumn(key, _text_key())
    same = (rows[key] == cuts[cut_key]) & rows["doc_id"].eqNullSafe(cuts[cut_id])
    units = F.regexp_extract_all("text", F.lit(f"{_WORD}{_GAP[:-1]}*"), F.lit(0))
    kept = F.array_except(F.sequence(F.lit(0), F.size(units) - 1), F.col(places))
    cut = F.concat(
        F.regexp_extract("text", f"^{_GAP[:-1]}*", 0),
        F.array_join(F.transform(kept, lambda i: F.get(units, i)), ""),
    )
    text = F.when(F.col(places).isNotNull(), cut).otherwise(F.col("text")).alias("text")
    return rows.join(cuts, same, "left").select(
        *[
            text if name == "text" else column
            for name, column in zip(docs.columns, common.columns(docs), strict=True)
        ]
    )


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits of the benchmark in all documents."""
    found = report(
        common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


OP9_SQL = r"""
with doc_words as (
    select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') w
    from documents
), item_words as (
    select item_id, list_filter(string_split_regex(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') w
    from benchmark
), windows as (
    select distinct item_id, least(10, len(w)) n,
           array_to_string(w[i:i + least(10, len(w)) - 1], ' ') k
    from (select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) i
          from item_words where len(w) > 0)
), lengths as (
    select distinct n from windows
), starts as (
    select doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') k
    from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) i from doc_words, lengths
          where len(w) >= n)
), hits as (
    select s.doc_id, s.i, s.n, item_id from starts s join windows b on s.n = b.n and s.k = b.k
), covered as (
    select doc_id, count(distinct p) n_hit
    from (select doc_id, unnest(range(i, i + n)) p from (select distinct doc_id, i, n from hits))
    group by doc_id
), items as (
    select doc_id, count(*) n_items, string_agg(id, ',' order by id) ids
    from (select distinct doc_id, cast(item_id as varchar) id from hits) group by doc_id
)
select d.doc_id, cast(len(w) as bigint) n_words, coalesce(n_hit, 0) n_hit,
       coalesce(n_items, 0) n_items, sha256(coalesce(ids, '')) items_sha256,
       coalesce(n_hit, 0) > 0 contaminated
from doc_words d left join covered using (doc_id) left join items using (doc_id)
"""

"""MinHash near-duplicates with sequential Bayesian verification.

Each text's set of word shingles gets a signature.  Texts with equal sets are one class
from then on, so copies cost nothing further.  Signatures are banded; classes that share a
bucket are candidates.  A candidate pair's signatures are compared batch by batch, and the
pair is dropped as soon as the posterior chance of the wanted similarity falls below the
chosen miss probability.  Survivors are verified exactly on their full shingle sets.

A bucket is not expanded into all its pairs.  Each class is first paired with one leader of
each of its buckets, and links are joined to components.  Then only classes of *different*
components that still share a bucket are compared, in tiles of bounded size inside the
tasks, and only surviving pairs leave them, until no such pair is left untested.

A text with fewer words than a shingle is one shingle; null and wordless texts have an
empty set, are linked with nothing and kept.  A row with a null ``doc_id`` belongs to the
component of its text, but never names it unless all ids there are null; it is kept if it
has no component id.  Repeated ids are judged row by row.  Only the id and the text are
read; other columns pass through where whole rows are returned.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlark.llm import common
from cartlark.llm.components import components

#: Rows and number of bands, and rows of the batches in which signatures are compared.
BAND_ROWS, BANDS, BATCH = 4, 30, 24
HASHES = BAND_ROWS * BANDS
#: Chance at which a pair of the wanted similarity may be dropped.
MISS = 1e-6
#: Classes of a bucket that one task compares with as many others.
TILE = 640
_MIX = np.uint64(0x9E3779B97F4A7C15)
_END = np.uint64(0xC2B2AE3D27D4EB4F)
_HALF = np.uint64(32)
_random = np.random.default_rng(20240229)
_FACTOR = _random.integers(0, 1 << 63, HASHES, np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _random.integers(0, 1 << 63, HASHES, np.uint64)
_CHUNK = 512
#: A character of a word, as ``shingle_set`` splits bytes.
_WORD = "[^\\x20\\x09-\\x0D]"


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles."""
    import xxhash

    found = text.encode().lower().split() if text else []  # bytes: A-Z and ASCII spaces only
    if not found:
        return np.empty(0, np.uint64)
    words = min(words, len(found))
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    mixed = h[: len(h) - words + 1].copy()
    for place in range(1, words):
        mixed = mixed * _MIX + h[place : len(h) - words + 1 + place]
    mixed = (mixed ^ (mixed >> _HALF)) * _END + np.uint64(words)
    return np.unique(mixed ^ (mixed >> np.uint64(29)))


def signature(shingles: np.ndarray) -> np.ndarray:
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), _CHUNK):
        block = shingles[at : at + _CHUNK, None] * _FACTOR
        block += _ADD
        np.minimum(least, block.min(axis=0), out=least)
    return (least >> _HALF).astype(np.uint32)


def fewest_matches(threshold: float, miss: float = MISS) -> list[tuple[int, int]]:
    """``(rows compared, matches)``: with fewer matches the chance that the similarity is at
    least ``threshold``, under a uniform prior, is below ``miss``."""
    steps = []
    for n in range(BATCH, HASHES + 1, BATCH):
        chance, m = 0.0, -1
        while chance < miss and m < n:
            m += 1  # the posterior's upper tail is a binomial lower tail
            chance += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        steps.append((n, m))
    return steps


def plausible(left: np.ndarray, right: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs of signature rows survive every batch."""
    alive = np.arange(len(left))
    matches = np.zeros(len(left), np.int64)
    for n, least in fewest_matches(threshold):
        batch = slice(n - BATCH, n)
        matches[alive] += (left[alive, batch] == right[alive, batch]).sum(axis=1)
        alive = alive[matches[alive] >= least]
    return alive


def sketches(docs: DataFrame, words: int) -> DataFrame:
    """``doc_id``, ``text_key``, ``n_shingles``, ``set_id`` and ``signature`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, ids, signatures = [], [], []
            for text in batch.column(2).to_pylist():
                shingles = shingle_set(text, words)
                sizes.append(len(shingles))
                some = len(shingles) > 0
                digest = hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
                ids.append(digest if some else None)
                signatures.append(signature(shingles).tobytes() if some else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()),
                 pa.array(ids, pa.binary()), pa.array(signatures, pa.binary())],
                names=["doc_id", "text_key", "n_shingles", "set_id", "signature"],
            )

    return docs.select(
        F.col("doc_id").cast("bigint"), text_key(), F.col("text").cast("string").alias("text")
    ).mapInArrow(
        run, "doc_id bigint, text_key binary, n_shingles bigint, set_id binary, signature binary"
    )


def text_key() -> Column:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return F.unhex(F.md5(text.cast("binary"))).alias("text_key")


def buckets(classes: DataFrame) -> DataFrame:
    """``bucket``, ``band``, ``set_id``, ``leader``, ``n``: one row per band of a class, for
    buckets with two classes at least.  The leader is the least class of the bucket."""
    bands = F.array(*[
        F.xxhash64(F.substring("signature", 1 + 4 * BAND_ROWS * band, 4 * BAND_ROWS), F.lit(band))
        for band in range(BANDS)
    ])
    rows = classes.select("set_id", F.posexplode(bands).alias("band", "bucket"))
    shared = rows.groupBy("bucket").agg(
        F.min("set_id").alias("leader"), F.count("*").alias("n")
    ).filter("n > 1")
    return rows.join(shared, "bucket")


def tiles(members: DataFrame) -> DataFrame:
    """Deals the members of a bucket of ``n`` rows into chunks of about ``TILE`` rows, and
    gives each chunk to the tiles of all its pairs: columns ``chunk``, ``low``, ``high``."""
    chunks = F.ceil(F.col("n") / TILE).cast("int")
    dealt = members.withColumn("_chunks", chunks).withColumn(
        "chunk", F.pmod(F.xxhash64("set_id"), F.col("_chunks")).cast("int")
    )
    return (
        dealt.withColumn("_other", F.explode(F.expr("sequence(0, _chunks - 1)")))
        .withColumn("low", F.least("chunk", "_other"))
        .withColumn("high", F.greatest("chunk", "_other"))
        .drop("_chunks", "_other")
    )


def _open_pairs(tile: pd.DataFrame, threshold: float, label: np.ndarray):
    """For one member after the other, the later members that are to be compared with it:
    of another component so far, in no earlier band's bucket together, in the tile's two
    chunks, not compared through the bucket's leader, and plausible by their signatures."""
    signatures = _matrix(tile["signature"])
    n, chunk = len(tile), tile["chunk"].to_numpy()
    band, low, high = (int(tile[c].iloc[0]) for c in ("band", "low", "high"))
    keys = signatures.reshape(n, BANDS, BAND_ROWS)
    led = (tile["set_id"] == tile["leader"]).to_numpy()
    for i in np.flatnonzero(~led):
        others = np.arange(i + 1, n)
        others = others[(label[others] != label[i]) & ~led[others]]
        if low != high:
            others = others[chunk[others] != chunk[i]]
        if len(others) and band:
            met = (keys[others, :band] == keys[i, :band]).all(axis=2).any(axis=1)
            others = others[~met]
        if len(others):
            mine = np.broadcast_to(signatures[i], (len(others), HASHES))
            others = others[plausible(signatures[others], mine, threshold)]
        if len(others):
            yield i, others


def _components_of(tile: pd.DataFrame) -> np.ndarray:
    return pd.factorize(tile["component"])[0]


def still_open(members: DataFrame, threshold: float) -> DataFrame:
    """The tile rows with a plausible, untested partner of another component."""
    key = ["bucket", "low", "high"]

    def run(tile: pd.DataFrame) -> pd.DataFrame:
        wanted = np.zeros(len(tile), bool)
        for i, others in _open_pairs(tile, threshold, _components_of(tile)):
            wanted[i] = wanted[others] = True
        return tile[wanted]

    return members.groupBy(*key).applyInPandas(run, members.schema)


def closing_links(members: DataFrame, threshold: float, percent: int) -> DataFrame:
    """Verified links between components of the same tile: one per pair of components that
    the tile joins.  ``members`` carry their full ``shingles``."""

    def run(tile: pd.DataFrame) -> pd.DataFrame:
        label = _components_of(tile)
        sets = [np.asarray(x) for x in tile["shingles"]]
        sizes = np.array([len(x) for x in sets])
        known, place = np.unique(np.concatenate(sets), return_inverse=True)
        ends = np.cumsum(sizes)
        own = [place[end - size : end] for end, size in zip(ends, sizes, strict=True)]
        ids, found = tile["set_id"].to_numpy(), []
        held = np.zeros(len(known), bool)
        for i, others in _open_pairs(tile, threshold, label):
            held[own[i]] = True
            for other in others:
                if label[other] != label[i]:
                    both = int(np.count_nonzero(held[own[other]]))
                    if 100 * both >= percent * (sizes[i] + sizes[other] - both):
                        found.append((ids[i], ids[other]))
                        label[label == label[other]] = label[i]
            held[own[i]] = False
        return pd.DataFrame(found, columns=["a", "b"])

    return members.groupBy("bucket", "low", "high").applyInPandas(run, "a binary, b binary")


def survivors(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """The ``a``, ``b`` pairs that the Bayesian comparison of signatures leaves."""
    known = classes.select("set_id", "signature")
    both = (
        pairs.join(known.toDF("a", "left"), "a").join(known.toDF("b", "right"), "b")
        .select("a", "b", "left", "right")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                alive = plausible(
                    *(_matrix(batch.column(at).to_pylist()) for at in (2, 3)), threshold
                )
                yield batch.select(["a", "b"]).take(pa.array(alive))

    return both.mapInArrow(run, "a binary, b binary")


def _matrix(signatures) -> np.ndarray:
    return np.frombuffer(b"".join(signatures), np.uint32).reshape(-1, HASHES)


class Verifier:
    """Exact similarities of class pairs on full shingle sets.

    The sets of classes that share a bucket are stored once; each pair's are joined to it.
    """

    def __init__(self, docs: DataFrame, rows: DataFrame, shared: DataFrame, words: int):
        wanted = shared.select("set_id").distinct()
        first = rows.filter("set_id is not null").groupBy("set_id").agg(
            F.min("text_key").alias("text_key")
        )
        keys = first.join(wanted, "set_id", "left_semi")
        texts = docs.select(text_key(), F.col("text").cast("string").alias("text"))
        # Copies are folded before the shuffle: a class is sent once by each task at most.
        chosen = texts.dropDuplicates(["text_key"]).join(keys, "text_key").select("set_id", "text")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for start in range(0, batch.num_rows, 256):
                    part = batch.slice(start, 256)
                    sets = [shingle_set(t, words).view(np.int64) for t in
                            part.column(1).to_pylist()]
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0), pa.array(sets, pa.list_(pa.int64()))],
                        names=["set_id", "shingles"],
                    )

        self.sets = common.stored(
            chosen.mapInArrow(run, "set_id binary, shingles array<bigint>"), "shingle_sets"
        )

    def links(self, pairs: DataFrame, percent: int) -> DataFrame:
        both = pairs.join(self.sets.toDF("a", "left"), "a").join(self.sets.toDF("b", "right"), "b")
        common_n = F.size(F.array_intersect("left", "right"))
        union_n = F.size("left") + F.size("right") - common_n
        return both.filter(100 * common_n >= percent * union_n).select("a", "b")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id``, ``text_key``, ``n_shingles``, ``component`` (a set's digest, null without
    words), ``component_id`` (the least id there) and ``kept`` of every row.

    Rows are linked where ``100 * intersection >= percent * union`` of their sets of
    ``words``-word shingles.
    """
    threshold = percent / 100
    rows = common.stored(sketches(docs, words), "sketches")
    classes = common.stored(
        rows.filter("set_id is not null").select("set_id", "signature")
        .dropDuplicates(["set_id"]),  # combined before the shuffle
        "classes",
    )
    shared = common.stored(buckets(classes), "buckets")
    verifier = Verifier(docs, rows, shared, words)
    pairs = shared.filter("set_id != leader").select(
        F.col("leader").alias("a"), F.col("set_id").alias("b")
    ).distinct()
    links = common.stored(
        verifier.links(survivors(pairs, classes, threshold), percent), "leader_links"
    )
    found = components(links)
    links = links.union(_closing(shared, classes, found, verifier, threshold, percent))
    found = components(links)
    return _judged(rows, found)


def _closing(
    shared: DataFrame, classes: DataFrame, found: DataFrame, verifier: Verifier,
    threshold: float, percent: int,
) -> DataFrame:
    """Links between components that the leaders have not joined."""
    placed = shared.filter("n > 2").join(
        found.withColumnRenamed("node", "set_id"), "set_id", "left"
    ).withColumn("component", F.coalesce("component", "set_id"))
    apart = placed.groupBy("bucket").agg(
        F.min("component").alias("_first"), F.max("component").alias("_last")
    ).filter("_first != _last").select("bucket")
    members = tiles(placed.join(apart, "bucket", "left_semi")).join(classes, "set_id")
    wanted = common.stored(still_open(members, threshold), "open_members")
    return closing_links(wanted.join(verifier.sets, "set_id"), threshold, percent)


def _judged(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The component of each row's class, named by the least id among its rows."""
    classed = rows.groupBy("set_id").agg(F.min("doc_id").alias("least")).filter(
        "set_id is not null"
    )
    known = classed.join(found.withColumnRenamed("node", "set_id"), "set_id", "left").select(
        "set_id", "least", F.coalesce("component", "set_id").alias("component")
    )
    known = common.stored(known, "class_components")
    named = known.groupBy("component").agg(F.min("least").alias("component_id"))
    named = known.join(named, "component").select("set_id", "component", "component_id")
    named = common.stored(named, "class_names")
    judged = rows.join(named, "set_id", "left").withColumn(
        "component_id",
        F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id")),
    )
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())
    return judged.select(
        "doc_id", "text_key", "n_shingles", "component", "component_id", kept.alias("kept")
    )


def drop_near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One whole row of each component.  Of rows with the kept id the least text is kept,
    and one of rows that are equal in both.  Rows without words all stay."""
    worded = F.coalesce(F.col("text").cast("string").rlike(_WORD), F.lit(False))
    wordless, docs = docs.filter(~worded), docs.filter(worded)
    judged = near_duplicates(docs, words, percent)
    kept = judged.filter("kept").groupBy("doc_id", "component").agg(
        F.min("text_key").alias("_key")
    )
    kept = kept.select(F.col("doc_id").alias("_id"), "_key").distinct()
    key = common.free_name(docs, "_text_key")
    rows = docs.withColumn(key, text_key())
    same = (rows[key] == kept["_key"]) & rows["doc_id"].eqNullSafe(kept["_id"])
    chosen = rows.join(kept, same, "left_semi").dropDuplicates(["doc_id", key])
    return chosen.select(common.columns(docs)).union(wordless)


def op8_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents by three-word shingles at a similarity of 0.85."""
    found = near_duplicates(common.table(spark, sf_dir, "documents"), words=3, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


OP8_SQL = """
with recursive worded as (
    select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x20\x09-\x0D]+'), lambda w: w <> '') w
    from documents
), sets as (
    select doc_id, list_distinct(list_transform(range(1, greatest(len(w) - 2, 1) + 1),
        lambda i: array_to_string(w[i:i + 2], ' '))) s
    from worded where len(w) > 0
), shingles as (
    select doc_id, unnest(s) g from sets
), shared as (
    select a.doc_id a, b.doc_id b, count(*) n
    from shingles a join shingles b on a.g = b.g and a.doc_id < b.doc_id group by all
), links as (
    select a, b from shared join sets x on a = x.doc_id join sets y on b = y.doc_id
    where 100 * n >= 85 * (len(x.s) + len(y.s) - n)
), edges as (
    select a, b from links union all select b, a from links
), reach(doc_id, other) as (
    select doc_id, doc_id from documents
    union
    select r.doc_id, e.b from reach r join edges e on r.other = e.a
)
select d.doc_id, cast(coalesce(len(s), 0) as bigint) n_shingles, c.component_id,
       d.doc_id = c.component_id kept
from documents d left join sets using (doc_id)
join (select doc_id, min(other) component_id from reach group by doc_id) c using (doc_id)
"""

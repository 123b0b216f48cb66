"""Removal of passages that an earlier document already holds, by De Bruijn compaction.

Every window of ``WINDOW`` words is an edge of a De Bruijn graph.  Only what repeats is
built: packets of windows with one minimizer (``word_graph``) are counted per minimizer, and
a minimizer met in one document alone can hold no repeated edge.  If all packets of a
minimizer are equal they are one nonbranching path already.  Where they differ, their
distinct packets are opened into edges, each edge learns its first document, its count and
its successors, and edges are compacted again into paths that no text enters or leaves half
way.  Joins put the paths back on every document that walks them; the source coordinates are
then read: the words of all occurrences of a path must be the same.  Hashes take a seed, and
should two different passages ever share theirs, the job is repeated with the next seed.

The first document of an edge is the one of smallest id; covered words of all others go.
Null and empty texts have no words.  Rows with a null id are neither earlier nor later than
any other: they keep all words and take none away.  Rows with one id do not take words from
each other; equal rows each keep the same words.  An empty table gives no rows.  Columns other
than the id and the text are not read, so their names do not matter.

A packet's or an edge's rows are combined before they move, joins on hot keys are left to
adaptive skew handling, and no step collects more than one document's own spans.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartlark.llm import common, word_graph

WINDOW = 50
#: Words of a minimizer.
MINIMIZER = 16
#: Ids up to which the documents to open are told to the scan instead of joined to it.
LISTED_IDS = 1_000_000
#: Rows gathered before a batch is handed to Spark.
BATCH_ROWS = 1 << 16

_PACKETS = "doc_id bigint, row bigint, start int, n int, low bigint, run bigint"
_EDGES = (
    "low bigint, run bigint, n int, i int, edge bigint, next bigint, "
    "times bigint, first bigint, last bigint"
)
_KEPT = (
    "doc_id bigint, n_words bigint, n_removed bigint, kept string, "
    "proof array<struct<low: bigint, path: bigint, words: int, digest: binary>>"
)


def _rows(docs: DataFrame) -> DataFrame:
    """``row`` tells apart the texts of one id."""
    text = F.col("text").cast("string")
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("row"),
        text.alias("text"),
    )


def _batch(schema: list[tuple[str, pa.DataType]], columns: list) -> pa.RecordBatch:
    arrays = [
        pa.array(np.concatenate(part).astype(kind.to_pandas_dtype(), copy=False), kind)
        for part, (_, kind) in zip(columns, schema, strict=True)
    ]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in schema])


_ARROW = {"bigint": pa.int64(), "int": pa.int32()}


def _fields(ddl: str) -> list[tuple[str, pa.DataType]]:
    return [(name, _ARROW[kind]) for name, kind in (f.split() for f in ddl.split(", "))]


def _gathered(parts: Iterator[tuple], ddl: str) -> Iterator[pa.RecordBatch]:
    """Tuples of equally long arrays as batches of bounded size."""
    fields, columns, held = _fields(ddl), None, 0
    for part in parts:
        columns = columns or [[] for _ in fields]
        for column, values in zip(columns, part, strict=True):
            column.append(values)
        held += len(part[0])
        if held >= BATCH_ROWS:
            yield _batch(fields, columns)
            columns, held = None, 0
    if columns:
        yield _batch(fields, columns)


def packets(rows: DataFrame, window: int, minimizer: int, seed: int) -> DataFrame:
    """The packets of every text with at least ``window`` words."""

    def cut(batch: pa.RecordBatch) -> Iterator[tuple]:
        ids, keys = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        for doc_id, row, text in zip(ids, keys, batch.column(2), strict=True):
            words = word_graph.hashed(text.as_py(), seed)
            if len(words) < window:
                continue
            start, n, low, run = word_graph.packets(word_graph.Rolling(words), window, minimizer)
            one = np.ones(len(start), np.int64)
            yield one * doc_id, one * row, start, n, low.view(np.int64), run.view(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _gathered(chain.from_iterable(map(cut, batches)), _PACKETS)

    return rows.filter("doc_id is not null and text is not null").mapInArrow(run, _PACKETS)


def repeated_packets(found: DataFrame) -> DataFrame:
    """Packets whose minimizer lies in several documents, with its ``first`` document and
    whether its packets differ (``branches``)."""
    known = (
        found.groupBy("low")
        .agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"),
             F.min("run").alias("_run"), F.max("run").alias("_other"))
        .filter("first < last")
        .select("low", "first", (F.col("_run") != F.col("_other")).alias("branches"))
    )
    return found.join(known, "low")


def _texts_of(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """One row per wanted ``(doc_id, row)`` with its text; equal rows are folded first."""
    ids = wanted.select("doc_id").distinct()
    if ids.limit(LISTED_IDS + 1).count() <= LISTED_IDS:
        rows = rows.join(F.broadcast(ids), "doc_id", "left_semi")
    once = rows.filter("text is not null").groupBy("doc_id", "row").agg(
        F.first("text").alias("text")
    )
    return once.join(wanted, ["doc_id", "row"])


def _spans(batch: pa.RecordBatch, place: int) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Bounds of each row's list, and the fields of all list elements."""
    lists = batch.column(place)
    sizes = np.asarray(lists.value_lengths().fill_null(0), np.int64)
    inner = lists.flatten()
    names = [inner.type.field(j).name for j in range(inner.type.num_fields)]
    return np.r_[0, np.cumsum(sizes)], {
        name: inner.field(j).to_numpy(zero_copy_only=False) for j, name in enumerate(names)
    }


def opened_edges(rows: DataFrame, branching: DataFrame, window: int, seed: int) -> DataFrame:
    """The edges of every distinct packet of the minimizers that branch."""
    distinct = branching.groupBy("low", "run", "n").agg(
        F.count("*").alias("times"), F.max("doc_id").alias("last"),
        F.min(F.struct("doc_id", "row", "start")).alias("at"),
    )
    packet = F.struct("low", "run", "n", F.col("at.start").alias("start"), "times", "last")
    wanted = distinct.groupBy("at.doc_id", "at.row").agg(F.collect_list(packet).alias("packets"))

    def edges(batch: pa.RecordBatch) -> Iterator[tuple]:
        bounds, packet = _spans(batch, 2)
        for j, (doc_id, text) in enumerate(zip(batch.column(0).to_numpy(), batch.column(1),
                                               strict=True)):
            all_edges = word_graph.Rolling(word_graph.hashed(text.as_py(), seed)).all_of(window)
            mine = slice(bounds[j], bounds[j + 1])
            n = packet["n"][mine].astype(np.int64)
            which = np.repeat(np.arange(len(n)), n)
            i = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            at = packet["start"][mine][which] + i
            edge = all_edges[at].view(np.int64)
            follows = np.r_[edge[1:], 0]
            follows[np.cumsum(n) - 1] = 0  # what follows lies in another packet
            yield (
                packet["low"][mine][which], packet["run"][mine][which], n[which], i, edge,
                follows, packet["times"][mine][which],
                np.full(len(i), doc_id, np.int64), packet["last"][mine][which],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _gathered(chain.from_iterable(map(edges, batches)), _EDGES)

    texts = _texts_of(rows, common.stored(wanted, "branching"))
    return texts.select("doc_id", "text", "packets").mapInArrow(run, _EDGES)


def compacted(edges: DataFrame) -> DataFrame:
    """Nonbranching paths of every distinct packet: ``low``, ``run``, ``n``, ``skip`` (edges of
    the packet before the path), ``size``, ``path`` (its first edge) and ``first`` document.

    Two edges are one path when the first is always followed by the second and both are met
    equally often, so that nothing else comes before the second.
    """
    nodes = edges.groupBy("low", "edge").agg(
        F.sum("times").alias("met"), F.min("first").alias("first"), F.max("last").alias("last"),
        (F.min("next") == F.max("next")).alias("one_way"),
    )
    along = Window.partitionBy("low", "run", "n").orderBy("i")
    before = F.lag(F.struct("one_way", "met", "first", "last")).over(along)
    goes_on = before["one_way"] & (before["met"] == F.col("met")) & (
        before["first"] == F.col("first")) & (before["last"] == F.col("last"))
    return (
        edges.select("low", "run", "n", "i", "edge").join(nodes, ["low", "edge"])
        .withColumn("goes_on", F.coalesce(goes_on, F.lit(False)))
        .withColumn("part", F.count_if(~F.col("goes_on")).over(along))
        .groupBy("low", "run", "n", "part")
        .agg(F.min("i").alias("skip"), F.count("*").cast("int").alias("size"),
             F.min_by("edge", "i").alias("path"), F.min("first").alias("first"),
             F.max("last").alias("last"))
        .filter("first < last").drop("part", "last")
    )


def walks(rows: DataFrame, window: int, minimizer: int, seed: int) -> DataFrame:
    """Every occurrence of a repeated path: ``doc_id``, ``row``, ``start``, ``words``, the
    path's name (``low``, ``path``) and the ``first`` document that holds it."""
    found = common.stored(packets(rows, window, minimizer, seed), "packets")
    repeated = common.stored(repeated_packets(found), "repeated")
    branching = repeated.filter("branches").drop("first")
    edges = common.stored(opened_edges(rows, branching, window, seed), "edges")
    paths = common.stored(compacted(edges), "paths")
    place = ["doc_id", "row"]
    return repeated.filter("not branches").select(
        *place, "start", (F.col("n") + window - 1).alias("words"), "low",
        F.col("run").alias("path"), "first",
    ).union(
        branching.join(paths, ["low", "run", "n"]).select(
            *place, (F.col("start") + F.col("skip")).cast("int"),
            (F.col("size") + window - 1).alias("words"), "low", "path", "first",
        )
    )


def _read_at_source(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words that stay, and a digest of the words of every occurrence of a path."""
    proof = pa.struct([("low", pa.int64()), ("path", pa.int64()), ("words", pa.int32()),
                       ("digest", pa.binary())])
    for batch in batches:
        bounds, span = _spans(batch, 2)
        counts, removed, kept, digests = [], [], [], []
        for j, text in enumerate(batch.column(1)):
            words = list(chain.from_iterable(word_graph.word_lists(text.as_py() or "")))
            mine = range(bounds[j], bounds[j + 1])
            change = np.zeros(len(words) + 1, np.int64)
            for x in mine:
                start, end = span["start"][x], span["start"][x] + span["words"][x]
                passage = " ".join(words[start:end]).encode("utf-8", "surrogatepass")
                digests.append(xxhash.xxh3_128_digest(passage))
                if span["goes"][x]:
                    change[start] += 1
                    change[end] -= 1
            counts.append(len(words))
            if change.any():
                stays = np.cumsum(change[:-1]) == 0
                words = [word for word, stay in zip(words, stays.tolist(), strict=True) if stay]
            removed.append(counts[-1] - len(words))
            kept.append(" ".join(words))
        proofs = pa.ListArray.from_arrays(
            pa.array(bounds, pa.int32()),
            pa.StructArray.from_arrays(
                [pa.array(span["low"], pa.int64()), pa.array(span["path"], pa.int64()),
                 pa.array(span["words"], pa.int32()), pa.array(digests, pa.binary())],
                fields=list(proof),
            ),
        )
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()),
             pa.array(kept, pa.string()), proofs],
            names=["doc_id", "n_words", "n_removed", "kept", "proof"],
        )


def without_repeats(
    docs: DataFrame, window: int = WINDOW, minimizer: int = MINIMIZER,
    drop_text: bool = False, first_seed: int = 0, **derived: Column,
) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed`` and ``kept`` (the words that stay, joined by one
    space) of every row.  Columns may be derived from these, and the text left out, before
    the result is written."""
    if not 0 < minimizer <= window:
        raise ValueError("a minimizer has at least one word and no more than the window")
    rows, seed = _rows(docs), first_seed
    while True:
        met = walks(rows, window, minimizer, seed)
        spans = met.groupBy("doc_id", "row").agg(
            F.collect_set(F.struct(
                "start", "words", "low", "path", (F.col("first") < F.col("doc_id")).alias("goes"),
            )).alias("spans")
        )
        read = rows.join(spans, ["doc_id", "row"], "left").select("doc_id", "text", "spans")
        result = read.mapInArrow(_read_at_source, _KEPT).withColumns(derived)
        result = common.stored(result.drop(*(["kept"] if drop_text else [])), "kept")
        same = (F.min("proof.digest") == F.max("proof.digest"))
        wrong = (
            result.select(F.explode("proof").alias("proof"))
            .groupBy("proof.low", "proof.path", "proof.words").agg(same.alias("same"))
            .filter("not same")
        )
        if wrong.isEmpty():
            return result.drop("proof")
        seed += 1  # two different passages had equal hashes


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the 50-word passages that a document of smaller id holds."""
    return without_repeats(
        common.table(spark, sf_dir, "documents"), drop_text=True,
        kept_sha256=F.sha2(F.col("kept").cast("binary"), 256),
    ).select("doc_id", "n_words", "n_removed", "kept_sha256")


OP13_SQL = r"""
with texts as (
    select row_number() over () as row, doc_id,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words
    from documents
), starts as (
    select row, doc_id, words, unnest(range(1, len(words) - 48)) as i from texts
), windows as (
    select row, doc_id, i, array_to_string(words[i:i + 49], ' ') as passage from starts
), firsts as (
    select passage, min(doc_id) as first from windows group by passage
), covered as (
    select distinct row, unnest(range(i, i + 50)) as j
    from windows join firsts using (passage) where first < doc_id
), kept as (
    select row, string_agg(word, ' ' order by j) as kept, count(*) as n
    from (select row, unnest(words) as word, unnest(range(1, len(words) + 1)) as j from texts)
    anti join covered using (row, j)
    group by row
)
select doc_id, cast(len(words) as bigint) as n_words, len(words) - coalesce(n, 0) as n_removed,
       sha256(coalesce(kept, '')) as kept_sha256
from texts left join kept using (row)
"""

"""Best-fit-decreasing packing of token windows into sequences of a fixed length.

Overlong documents are cut into full windows and a rest.  Best fit decreasing looks at
lengths alone, and there are at most ``window`` of them, so the plan is made once for the
counts per length: a segment tree over remaining capacities finds the tightest open
windows, and all windows with the same room are filled in one step, exactly as they would
be one by one.  The plan's size depends on ``window``, not on the number of documents.
Pieces then look up their place by their number among the pieces of their length.

Null texts count as empty; an empty document is its end id alone.  A null or repeated
``doc_id`` is carried along: every input row is packed on its own.  An empty table gives no
rows.  Input columns other than the id and the text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartlark.llm import common, tokens

WINDOW = 4096
END_ID = 2
#: Token bytes gathered before a batch of pieces is handed to Spark.
BATCH_BYTES = 4 << 20

PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("ids", T.BinaryType()),
    ]
)


def token_windows(
    docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID
) -> DataFrame:
    """Full windows and rests of every document's ids: ``doc_id``, ``start``, ``length``,
    ``doc_tokens`` and ``ids`` (little-endian unsigned 32-bit)."""
    return _texts(docs).mapInArrow(_encoding(tokenizer, window, end_id), PIECES)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))


def _encoding(tokenizer: str, window: int, end_id: int):
    end = np.asarray([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(tokenizer)
        for batch in batches:
            rows: list[list] = [[] for _ in PIECES.names]
            held = 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encoder.ids(text.as_py() or "") + end
                total = len(ids) // 4
                for start in range(0, total, window):
                    piece = ids[4 * start : 4 * (start + window)]
                    values = (doc_id, start, len(piece) // 4, total, piece)
                    for column, value in zip(rows, values, strict=True):
                        column.append(value)
                held += len(ids)
                if held > BATCH_BYTES:
                    yield _batch(rows)
                    rows, held = [[] for _ in PIECES.names], 0
            if rows[0]:
                yield _batch(rows)

    return run


def _batch(rows: list[list]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 4 + [pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array(values, kind) for values, kind in zip(rows, kinds, strict=True)],
        names=PIECES.names,
    )


class OpenWindows:
    """Open windows by remaining capacity, under a segment tree of their counts."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.tree = [0] * (2 * self.size)
        self.groups: dict[int, list[list[int]]] = {}  # room -> [first window, windows]

    def _change(self, room: int, by: int) -> None:
        node = room + self.size
        while node:
            self.tree[node] += by
            node //= 2

    def put(self, room: int, first: int, n: int) -> None:
        if n and room:
            self.groups.setdefault(room, []).append([first, n])
            self._change(room, n)

    def take(self, room: int, most: int) -> tuple[int, int]:
        """Up to ``most`` windows of one stored group: the first one's number, and how many."""
        group = self.groups[room][-1]
        n = min(most, group[1])
        first = group[0]
        group[0] += n
        group[1] -= n
        if not group[1]:
            self.groups[room].pop()
        self._change(room, -n)
        return first, n

    def tightest(self, length: int) -> int | None:
        """The least remaining capacity of an open window that holds ``length``."""
        node = length + self.size
        while not self.tree[node]:
            while node & 1:  # a right child: everything at or above is to the right of it
                node //= 2
            if not node:
                return None
            node += 1
        while node < self.size:
            node *= 2
            if not self.tree[node]:
                node += 1
        return node - self.size


def best_fit_plan(counts: dict[int, int], window: int) -> np.ndarray:
    """Runs ``(length, first, last, sequence, per sequence, offset)``.

    Pieces ``first`` to ``last`` - 1 of their length fill ``per sequence`` places each, from
    ``offset`` on, of consecutive sequences.
    """
    opened = OpenWindows(window)
    runs: list[tuple[int, ...]] = []
    new = 0
    for length in sorted(counts, reverse=True):
        done, n = 0, counts[length]
        while done < n:
            room = opened.tightest(length)
            each = (room or window) // length
            whole = (n - done) // each
            each, windows = (each, whole) if whole else (n - done, 1)
            if room is None:
                room, first = window, new
                new += windows
            else:
                first, windows = opened.take(room, windows)
            runs.append((length, done, done + windows * each, first, each, window - room))
            opened.put(room - each * length, first, windows)
            done += windows * each
    return np.asarray(runs, np.int64).reshape(-1, 6)


def pack(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows with a ``length`` of 1 to ``window``.

    Sequences are numbered from 0 without gaps and filled from offset 0 without gaps.
    """
    pieces = common.without(pieces, "sequence_id", "offset", *_NUMBER.names)
    numbered = pieces.mapInArrow(_numbering, T.StructType([*pieces.schema.fields, *_NUMBER.fields]))
    return _placed(common.stored(numbered, "pieces"), window)


def pack_documents(
    docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID,
    drop_ids: bool = False, **derived: Column,
) -> DataFrame:
    """:func:`pack` of :func:`token_windows`, encoded and numbered by the same Python worker.
    Columns may be derived from the windows, and the ids left out, before anything moves."""
    encode = _encoding(tokenizer, window, end_id)
    schema = T.StructType([*PIECES.fields, *_NUMBER.fields])
    numbered = _texts(docs).mapInArrow(lambda batches: _numbering(encode(batches)), schema)
    numbered = numbered.withColumns(derived).drop(*(["ids"] if drop_ids else []))
    return _placed(common.stored(numbered, "pieces"), window)


def _placed(numbered: DataFrame, window: int) -> DataFrame:
    """Plans for the counts per length and looks up each numbered piece's place."""
    spark = numbered.sparkSession
    pieces = numbered.drop(*_NUMBER.names)
    # One row per partition and length, so the largest number is the count.
    counts = numbered.groupBy("_part", "length").agg((F.max("_nth") + 1).alias("_n"))
    counts = common.stored(counts, "piece_counts")
    totals = counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()  # <= window rows
    plan = spark.sparkContext.broadcast(
        best_fit_plan({row["length"]: row["n"] for row in totals}, window)
    )
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    bases = counts.select(
        "_part", "length", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base")
    )
    placed = numbered.join(bases, ["_part", "length"]).select(
        *pieces.columns, (F.col("_base") + F.col("_nth")).alias("_nth")
    )
    schema = T.StructType(
        [
            *pieces.schema.fields,
            T.StructField("sequence_id", T.LongType()),
            T.StructField("offset", T.LongType()),
        ]
    )

    carried, names = pieces.columns, schema.names

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = plan.value
        # One ordered key per run start: lengths descend in the plan.
        order = np.lexsort((runs[:, 1], runs[:, 0]))
        runs = runs[order]
        starts = np.searchsorted(runs[:, 0], np.arange(window + 2))
        for batch in batches:
            length = batch.column("length").to_numpy()
            nth = batch.column("_nth").to_numpy()
            at = np.empty(len(nth), np.int64)
            for value in np.unique(length):
                mine = length == value
                low, high = starts[value], starts[value + 1]
                at[mine] = low + np.searchsorted(runs[low:high, 1], nth[mine], "right") - 1
            _, first, _, sequence, each, offset = runs[at].T
            within = nth - first
            arrays = [batch.column(c) for c in carried]
            arrays += [
                pa.array(sequence + within // each),
                pa.array(offset + within % each * length),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return placed.mapInArrow(look_up, schema)


_NUMBER = T.StructType(
    [T.StructField("_part", T.LongType()), T.StructField("_nth", T.LongType())]
)


def _numbering(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the partition and the number of a piece among those of its length there."""
    part = TaskContext.get().partitionId()
    seen: dict[int, int] = {}
    for batch in batches:
        nth = []
        for length in batch.column("length").to_pylist():
            place = seen.get(length, 0)
            seen[length] = place + 1
            nth.append(place)
        arrays = [
            *batch.columns, pa.array([part] * len(nth), pa.int64()), pa.array(nth, pa.int64())
        ]
        names = [*batch.schema.names, *_NUMBER.names]
        yield pa.RecordBatch.from_arrays(arrays, names=names)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packs all documents; the digest of the ids stands for the ids."""
    import public_tokenizers

    return pack_documents(
        common.table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"),
        drop_ids=True, ids_crc32=F.crc32("ids"),
    ).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )

"""Alignment of two tokenizers' tokens by galloping intersection of their byte ends.

Both tokenizers cut the same bytes, a space and the text.  The ends of a tokenizer's tokens
rise strictly, so the offsets where both end are the intersection of two sorted lists: the
shorter list drives, and each of its ends is sought in the longer one by exponential steps
from a place already known, then by halving.  Common ends cut the tokens into groups.  The
ranks of a token's first byte and end among the ends of the other side give the range of
tokens that it overlaps, and differences of ranks the number of links.

Links are counted per pair of ids over the whole corpus: per document and per task before
anything moves.  Counts go back to the documents as sorted arrays where there are at most
``LISTED_PAIRS`` different pairs, and by a join on the pair beyond that.

Null and empty texts, and texts whose joined token bytes differ from the space and the text
on either side, have no tokens: all numbers are 0 and ``groups`` is empty.  Null and repeated
ids are carried along; every row is aligned on its own, and the links of each count.  An empty
table gives no rows.  Columns other than the id and the text are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections import ChainMap
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlark.llm import common, tokens

#: Different id pairs up to which their counts are sent to every task (17 bytes each).
LISTED_PAIRS = 4_000_000
#: Pairs that a task adds up before it hands them on.
HELD_PAIRS = 500_000
#: Every so many ends, one is sought from the front; those between start at its place.
STRIDE = 32
#: Characters and number of the texts that are aligned together.
BATCH_CHARS = 1 << 20
BATCH_TEXTS = 1 << 12
#: Bits of an id in a pair; pair and number of the text fill 64 bits.
ID_BITS = 24
_LOW_ID = (1 << ID_BITS) - 1

_ALIGNED = (
    "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups {groups}, "
    "pairs binary, times binary"
)
_COUNTED = "a int, b int, met bigint"
_SCORED = "n_best bigint, count_sum bigint"
_SPACES = re.compile(" *[^ ]+| +")


# --- tokenizers ---------------------------------------------------------------------------


class ByteLevelSide:
    """Ids of a byte-level vocabulary; special strings inside texts are plain text."""

    def __init__(self, path: str):
        self.encoder = tokens.PieceEncoder(path)
        self.encoder.tokenizer.encode_special_tokens = True
        with open(path, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        letters = {letter: byte for byte, letter in tokens.byte_letters().items()}
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for entry, token in vocabulary.items():
            if all(letter in letters for letter in entry):
                self.bytes[token] = bytes(letters[letter] for letter in entry)

    def ids(self, texts: list[str]) -> list[np.ndarray | None]:
        found = [np.frombuffer(self.encoder.ids(" " + text), "<u4") for text in texts]
        return [
            ids if _same(self.bytes, ids, text) else None
            for ids, text in zip(found, texts, strict=True)
        ]


class PieceSide:
    """Ids of a sentencepiece model, which puts a space before the text.

    Where no entry of the vocabulary holds a space behind another character, a text may be cut
    before every run of spaces.  A part is encoded, and its bytes compared, once while a worker
    remembers it; a text with a part whose bytes differ is looked at as a whole.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        entries = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = [
            bytes([int(entry[3:5], 16)]) if self.model.is_byte(i)
            else entry.replace("▁", " ").encode()
            for i, entry in enumerate(entries)
        ]
        self.parted = not any(re.search("[^▁]▁", entry) for entry in entries)
        self.memo: dict[str, bytes | None] = {}

    def _encoded(self, texts: list[str]) -> list[list[int]]:
        # The library adds the space, but not to an empty text.
        space = [self.model.piece_to_id("▁")]
        return [
            ids if text else space
            for ids, text in zip(self.model.encode(texts, num_threads=1), texts, strict=True)
        ]

    def _learn(self, parts: list[str]) -> dict[str, bytes | None]:
        """Ids of new parts, None where their bytes differ; kept while there is room."""
        known = {
            part: np.asarray(ids, "<u4").tobytes() if _same(self.bytes, ids, part[1:]) else None
            for part, ids in zip(parts, self._encoded([part[1:] for part in parts]), strict=True)
        }
        if len(self.memo) < tokens.MEMO_PIECES:
            self.memo.update(known)
        return known

    def _whole(self, text: str) -> np.ndarray | None:
        ids = self.model.encode(text)
        return np.asarray(ids, "<u4") if _same(self.bytes, ids, text) else None

    def ids(self, texts: list[str]) -> list[np.ndarray | None]:
        if not self.parted:
            return list(map(self._whole, texts))
        cut = [_SPACES.findall(" " + text) for text in texts]
        known = self._learn(list(set(chain.from_iterable(cut)).difference(self.memo)))
        known = ChainMap(known, self.memo) if known else self.memo
        out = []
        for parts, text in zip(cut, texts, strict=True):
            found = list(map(self.memo.get, parts))
            if None in found:
                found = [x or known[part] for x, part in zip(found, parts, strict=True)]
            out.append(
                self._whole(text) if None in found else np.frombuffer(b"".join(found), "<u4")
            )
        return out


def _same(entries: list[bytes], ids, text: str) -> bool:
    """Whether the ids' bytes are those of a space and the text."""
    ids = ids.tolist() if isinstance(ids, np.ndarray) else ids
    return b"".join(map(entries.__getitem__, ids)) == (" " + text).encode("utf-8", "surrogatepass")


def _side(path: str):
    return PieceSide(path) if path.endswith(".model") else ByteLevelSide(path)


class Aligner:
    """The two sides and their tables of token sizes and printed ids."""

    def __init__(self, path_a: str, path_b: str):
        self.sides = _side(path_a), _side(path_b)
        self.sizes = [np.array([len(x) for x in side.bytes], np.int64) for side in self.sides]
        if max(map(len, self.sizes)) > 1 << ID_BITS:
            raise ValueError(f"ids beyond {ID_BITS} bits")
        #: Printed ids with what follows them: a comma, or the end of the side in its group.
        self.printed = [
            np.array([f"{i}{mark}" for mark in (",", end) for i in range(len(side.bytes))], object)
            for side, end in zip(self.sides, "|;", strict=True)
        ]

    def tokens(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Both sides' ids of each text, None where there are none."""
        found = [side.ids(texts) for side in self.sides]
        return [
            None if text == "" or a is None or b is None else (a, b)
            for text, a, b in zip(texts, *found, strict=True)
        ]

    def printed_groups(self, ids: list[np.ndarray], group: list[np.ndarray]) -> list[str]:
        """The ids of each group's one side, then of the other, with what follows each."""
        words = []
        for side, at, printed in zip(ids, group, self.printed, strict=True):
            last = np.r_[at[1:] != at[:-1], True]
            words.append(printed[side + last * np.int64(len(printed) // 2)])
        order = np.argsort(np.r_[2 * group[0], 2 * group[1] + 1], kind="stable")
        return np.concatenate(words)[order].tolist()


@lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    """One per worker process and pair of files."""
    return Aligner(path_a, path_b)


# --- galloping intersection -----------------------------------------------------------------


def _gallop(values: np.ndarray, start: np.ndarray, longer: np.ndarray) -> np.ndarray:
    """For each value the first place from ``start`` on whose end is not below it.

    All values step together: by 1, 2, 4, ... places while the end there is below the value,
    then by halving between the last two places tried.
    """
    low, step = start.copy(), np.ones(len(values), np.int64)
    active = np.arange(len(values))
    while len(active):
        probe = low[active] + step[active] - 1
        below = (probe < len(longer)) & (longer[np.minimum(probe, len(longer) - 1)] < values[active])
        active = active[below]
        low[active] += step[active]
        step[active] *= 2
    high = np.minimum(low + step - 1, len(longer))
    while True:
        open_ = low < high
        if not open_.any():
            return low
        middle = (low + high) // 2
        below = open_ & (longer[np.minimum(middle, len(longer) - 1)] < values)
        low = np.where(below, middle + 1, low)
        high = np.where(open_ & ~below, middle, high)


def ranks(shorter: np.ndarray, longer: np.ndarray) -> np.ndarray:
    """The number of ends in ``longer`` below each end in ``shorter``."""
    leaders = _gallop(shorter[::STRIDE], np.zeros(-(-len(shorter) // STRIDE), np.int64), longer)
    return _gallop(shorter, np.repeat(leaders, STRIDE)[: len(shorter)], longer)


def common_ends(ends: list[np.ndarray]) -> list[np.ndarray]:
    """Places of the common ends in both lists; the shorter list drives."""
    swap = len(ends[0]) > len(ends[1])
    shorter, longer = ends[::-1] if swap else ends
    place = ranks(shorter, longer)
    hit = np.flatnonzero(longer[np.minimum(place, len(longer) - 1)] == shorter)
    both = [hit, place[hit]]
    return both[::-1] if swap else both


def links(ends: list[np.ndarray], group: list[np.ndarray], places: list[np.ndarray]):
    """The places of both tokens of every overlapping pair.

    A token of the first side overlaps the tokens of its group whose ends lie above its
    start, up to the first whose end reaches its own: a range given by two ranks.
    """
    a, b = ends
    # Groups of one token on either side, by far the most, need no search.
    first = np.r_[0, places[1] + 1]
    low, high = first[group[0]], first[group[0] + 1] - 1
    many = (np.bincount(group[0])[group[0]] > 1) & (high > low)
    if many.any():
        starts = np.r_[0, a[:-1]]
        mine = np.flatnonzero(many)
        # Ends at or below the start belong to tokens before it.
        low[mine] = _gallop(starts[mine] + 1, low[mine], b)
        high[mine] = _gallop(a[mine], low[mine], b)
    size = high - low + 1
    left = np.repeat(np.arange(len(a)), size)
    right = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + low[left]
    return left, right


def align(work: Aligner, found: list[tuple[np.ndarray, np.ndarray]]):
    """``ids``, ``group`` of every token on both sides, and the places of linked tokens, of
    several texts put one behind the other: both sides end together at each text's end."""
    ids = [np.concatenate(side) for side in zip(*found, strict=True)]
    ends = [np.cumsum(size[side]) for size, side in zip(work.sizes, ids, strict=True)]
    places = common_ends(ends)
    group = [
        np.repeat(np.arange(len(place)), np.diff(np.r_[-1, place])) for place in places
    ]
    return ids, group, *links(ends, group, places)


# --- rows ---------------------------------------------------------------------------------------


def _nothing(doc_id) -> tuple:
    return doc_id, 0, 0, 0, 0, "", b"", b""


def _several(work: Aligner, doc_ids: list, texts: list[str], digest: bool) -> list[tuple]:
    """The rows of some texts, aligned together."""
    found = work.tokens(texts)
    have = [j for j, ids in enumerate(found) if ids is not None]
    rows = [_nothing(doc_id) for doc_id in doc_ids]
    if not have:
        return rows
    ids, group, left, right = align(work, [found[j] for j in have])
    printed = work.printed_groups(ids, group)
    # Bounds of the texts among the tokens of both sides, the groups and the links.
    a, b = (np.cumsum([0, *(len(found[j][side]) for j in have)]) for side in (0, 1))
    groups = np.r_[group[0][a[:-1]], group[0][-1] + 1]
    linked = np.searchsorted(left, a)
    text = np.repeat(np.arange(len(have)), np.diff(linked))
    pairs = (text << 2 * ID_BITS) | (ids[0][left].astype(np.int64) << ID_BITS) | ids[1][right]
    pairs, times = np.unique(pairs, return_counts=True)
    bounds = np.searchsorted(pairs, np.arange(len(have) + 1) << 2 * ID_BITS)
    pairs = pairs & ((1 << 2 * ID_BITS) - 1)
    times = times.astype("<u4")
    for n, j in enumerate(have):
        both = "".join(printed[a[n] + b[n] : a[n + 1] + b[n + 1]])[:-1]
        mine = slice(bounds[n], bounds[n + 1])
        rows[j] = (
            doc_ids[j], int(a[n + 1] - a[n]), int(b[n + 1] - b[n]), int(groups[n + 1] - groups[n]),
            int(linked[n + 1] - linked[n]),
            hashlib.sha256(both.encode()).hexdigest() if digest else both,
            pairs[mine].tobytes(), times[mine].tobytes(),
        )
    return rows


# --- Spark ------------------------------------------------------------------------------------


def _grouped(pairs: np.ndarray, times: np.ndarray | None = None):
    """Different pairs in order, and how often each is met."""
    if times is None:
        return np.unique(pairs, return_counts=True)
    different, place = np.unique(pairs, return_inverse=True)
    return different, np.bincount(place, times, len(different)).astype(np.int64)


def _aligning(path_a: str, path_b: str, digest: bool, schema: list[str]):
    def batch(rows: list[tuple]) -> pa.RecordBatch:
        text = pa.string()
        kinds = [*[pa.int64()] * 5, text, pa.binary(), pa.binary()]
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names=schema
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = aligner(path_a, path_b)
        for given in batches:
            doc_ids, texts, held = [], [], 0
            for doc_id, text in zip(given.column(0).to_pylist(), given.column(1), strict=True):
                doc_ids.append(doc_id)
                texts.append(text.as_py() or "")
                held += len(texts[-1])
                if held > BATCH_CHARS or len(texts) == BATCH_TEXTS:
                    yield batch(_several(work, doc_ids, texts, digest))
                    doc_ids, texts, held = [], [], 0
            if texts:
                yield batch(_several(work, doc_ids, texts, digest))

    return run


def aligned(docs: DataFrame, path_a: str, path_b: str, digest: bool = False) -> DataFrame:
    """``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``groups`` (or their sha256) and the
    different linked ids of a row with their numbers (``pairs``: 64-bit, first id above ``ID_BITS``
    bits of the second; ``times``: 32-bit)."""
    schema = _ALIGNED.format(groups="string")
    names = [field.split()[0] for field in schema.split(", ")]
    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return rows.mapInArrow(_aligning(path_a, path_b, digest, names), schema)


def _linked(batch: pa.RecordBatch, at: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, pair and number of every different pair of a batch."""
    pairs = [np.frombuffer(x.as_py(), np.int64) for x in batch.column(at)]
    times = [np.frombuffer(x.as_py(), "<u4") for x in batch.column(at + 1)]
    row = np.repeat(np.arange(len(pairs)), [len(x) for x in pairs])
    return row, np.concatenate(pairs), np.concatenate(times).astype(np.int64)


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's numbers per pair, added up while few enough are held."""
    held, count = np.empty(0, np.int64), np.empty(0, np.int64)

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array((held >> ID_BITS).astype(np.int32)),
             pa.array((held & _LOW_ID).astype(np.int32)), pa.array(count)],
            names=["a", "b", "met"],
        )

    for batch in batches:
        if not batch.num_rows:
            continue
        _, pairs, times = _linked(batch, 0)
        held, count = _grouped(np.r_[held, pairs], np.r_[count, times])
        if len(held) > HELD_PAIRS:
            yield out()
            held, count = held[:0], count[:0]
    yield out()


def pair_counts(found: DataFrame) -> DataFrame:
    """``a``, ``b``, ``met`` (links of the corpus that hold the pair), and whether that is the
    highest number of its ``b`` (``best``, ties included)."""
    met = (
        found.select("pairs", "times").mapInArrow(_added, _COUNTED)
        .groupBy("a", "b").agg(F.sum("met").alias("met"))
    )
    met = common.stored(met, "pairs")
    most = met.groupBy("b").agg(F.max("met").alias("most"))
    return common.stored(
        met.join(most, "b").select("a", "b", "met", (F.col("met") == F.col("most")).alias("best")),
        "pair_counts",
    )


def _looked_up(found: DataFrame, counts: DataFrame) -> DataFrame:
    """Counts as sorted arrays in every task."""
    table = counts.toArrow()  # at most ``listed_pairs`` rows
    a, b, met, best = [column.to_numpy() for column in table.select(["a", "b", "met", "best"])]
    pairs = a.astype(np.int64) << ID_BITS | b
    order = np.argsort(pairs)
    told = found.sparkSession.sparkContext.broadcast((pairs[order], met[order], best[order]))
    kept = found.drop("pairs", "times").columns
    at = len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, met, best = told.value
        for batch in batches:
            if not batch.num_rows:
                continue
            row, mine, times = _linked(batch, at)
            place = np.searchsorted(pairs, mine)
            sums = np.zeros((2, batch.num_rows), np.int64)
            np.add.at(sums[0], row, times * best[place])
            np.add.at(sums[1], row, times * met[place])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:at], pa.array(sums[0]), pa.array(sums[1])],
                names=[*kept, "n_best", "count_sum"],
            )

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in found.schema.fields[:at])
    return found.select(*kept, "pairs", "times").mapInArrow(run, f"{schema}, {_SCORED}")


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            row, pairs, times = _linked(batch, 1)
            key = batch.column(0).to_numpy()[row]
            yield pa.RecordBatch.from_arrays(
                [pa.array(key), pa.array((pairs >> ID_BITS).astype(np.int32)),
                 pa.array((pairs & _LOW_ID).astype(np.int32)), pa.array(times)],
                names=["key", "a", "b", "times"],
            )


def _joined(found: DataFrame, counts: DataFrame) -> DataFrame:
    """Counts by a join on the pair: one row per document and different pair moves."""
    keyed = common.stored(found.withColumn("key", F.monotonically_increasing_id()), "keyed")
    linked = keyed.select("key", "pairs", "times").mapInArrow(
        _opened, "key bigint, a int, b int, times bigint"
    )
    sums = linked.join(counts, ["a", "b"]).groupBy("key").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("met")).alias("count_sum"),
    )
    zero = F.lit(0).cast("bigint")
    return keyed.drop("pairs", "times").join(sums, "key", "left").select(
        *found.drop("pairs", "times").columns,
        *[F.coalesce(F.col(c), zero).alias(c) for c in ("n_best", "count_sum")],
    )


def alignment(
    docs: DataFrame, path_a: str, path_b: str, digest: bool = False,
    listed_pairs: int = LISTED_PAIRS,
) -> DataFrame:
    """:func:`aligned` rows with ``n_best`` (links whose pair has the highest corpus count of
    its second id) and ``count_sum`` (the corpus counts of all links) instead of the pairs."""
    found = common.stored(aligned(docs, path_a, path_b, digest), "aligned")
    counts = pair_counts(found)
    few = counts.count() <= listed_pairs
    return _looked_up(found, counts) if few else _joined(found, counts)


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, byte_bpe_50k against piece_bpe_32k; a digest stands for the groups."""
    import public_tokenizers

    return alignment(
        common.table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"), digest=True,
    ).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
        F.col("groups").alias("groups_sha256"),
    )

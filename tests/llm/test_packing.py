import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cartlark.llm import packing, tokens

PATH = public_tokenizers.path("word_bpe_49k.json")


def one_by_one(lengths, window):
    """Best fit decreasing, a piece at a time: the sorted remaining rooms of its windows."""
    rooms = []
    for length in sorted(lengths, reverse=True):
        fitting = [room for room in rooms if room >= length]
        if fitting:
            rooms.remove(min(fitting))
            rooms.append(min(fitting) - length)
        else:
            rooms.append(window - length)
    return sorted(rooms)


@pytest.mark.parametrize("seed", range(6))
def test_the_plan_fills_windows_as_placing_one_by_one_does(seed):
    rng = random.Random(seed)
    window = rng.choice([7, 64, 100])
    lengths = [rng.randint(1, window) for _ in range(rng.randint(1, 300))]
    counts = {n: lengths.count(n) for n in set(lengths)}
    used = {}
    for length, first, last, sequence, each, offset in packing.best_fit_plan(counts, window):
        for nth in range(last - first):
            place = sequence + nth // each
            start = offset + nth % each * length
            assert start == used.get(place, 0)  # gapless, in the order of the plan
            used[place] = start + length
    assert sorted(used) == list(range(len(used)))
    assert sorted(window - n for n in used.values()) == one_by_one(lengths, window)


def test_the_tree_finds_the_tightest_window():
    rng = random.Random(1)
    opened, rooms = packing.OpenWindows(100), []
    for n in range(60):
        room = rng.randint(1, 100)
        opened.put(room, n, 1)
        rooms.append(room)
        for length in range(1, 101):
            fitting = [x for x in rooms if x >= length]
            assert opened.tightest(length) == (min(fitting) if fitting else None)


def test_pieces_hold_all_ids_once(spark, documents):
    rng = random.Random(2)
    words = ["Haus", "l'été", "don't", "x9", "ÅÉ", "naïve,", "12.5", "<|endoftext|>", "日本語"]
    texts = [" ".join(rng.choices(words, k=rng.choice([0, 1, 5, 60]))) for _ in range(40)]
    docs = documents([(i, t) for i, t in enumerate(texts)] + [(None, None), (7, texts[7])])
    docs = docs.withColumn("sequence_id", F.lit("clash")).withColumn("_nth", F.lit(1))
    found = packing.pack(packing.token_windows(docs, PATH, 64), 64).collect()
    library = Tokenizer.from_file(PATH)
    by_doc = {}
    for row in found:
        by_doc.setdefault((row["doc_id"], row["doc_tokens"]), []).append(row)
    for i, text in enumerate(texts):
        expected = np.array([*library.encode(text, add_special_tokens=False).ids, 2], "<u4")
        rows = sorted(by_doc[i, len(expected)], key=lambda r: r["start"])
        rows = rows[::2] if i == 7 else rows  # its row is there twice
        assert b"".join(bytes(r["ids"]) for r in rows) == expected.tobytes()
        assert [r["start"] for r in rows] == list(range(0, len(expected), 64))
    assert [(r["length"], r["doc_tokens"]) for r in by_doc[None, 1]] == [(1, 1)]
    ends = {}
    for row in sorted(found, key=lambda r: (r["sequence_id"], r["offset"])):
        assert row["offset"] == ends.get(row["sequence_id"], 0)
        ends[row["sequence_id"]] = row["offset"] + row["length"]
    assert max(ends.values()) <= 64 and sorted(ends) == list(range(len(ends)))


def test_no_documents_give_no_pieces(spark, documents):
    assert packing.pack(packing.token_windows(documents([]), PATH)).isEmpty()


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_memoised_pieces_give_the_librarys_ids(name):
    path = public_tokenizers.path(name)
    encoder, library = tokens.PieceEncoder(path), Tokenizer.from_file(path)
    rng = random.Random(3)
    parts = [
        "the", "Straße", "É", "ét", "İ", "ΑΣ", "don't", "'s", "’s", "x1y2", "<|endoftext|>", "!!",
        " ", "  ", "\n\n", "\t", "\x1c", "\x85", "🙂", "a.b", "ß.", "ª", "12", " ", "　", "ﬁ", "K",
    ]
    for _ in range(1500):
        text = "".join(rng.choices(parts, k=rng.randint(0, 9)))
        got = np.frombuffer(encoder.ids(text), "<u4").tolist()
        assert got == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_op1_digests(spark):
    found = packing.op1_packing(spark, "/root/testdata/sf0.001")
    docs = {r["doc_id"]: r["text"] for r in
            spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    library = Tokenizer.from_file(PATH)
    rows = found.collect()
    assert {r["doc_id"] for r in rows} == set(docs)
    for r in rows:
        ids = [*library.encode(docs[r["doc_id"]] or "", add_special_tokens=False).ids, 2]
        piece = np.array(ids[r["start"] : r["start"] + r["length"]], "<u4").tobytes()
        assert r["ids_crc32"] == zlib.crc32(piece) and r["doc_tokens"] == len(ids)
    assert sum(r["length"] for r in rows) > 0.9 * 4096 * (1 + max(r["sequence_id"] for r in rows))

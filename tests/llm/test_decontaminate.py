import random
import re

import pytest
from pyspark.sql import functions as F

from cartlark.llm import decontaminate

WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute(docs, items, n):
    windows = {}
    for item, text in items:
        words = WORD.findall(lowered(text))
        size = min(n, len(words))
        for i in range(len(words) - size + 1 if words and item is not None else 0):
            windows.setdefault(tuple(words[i : i + size]), set()).add(item)
    out = []
    for doc, text in docs:
        words, hit, found = WORD.findall(lowered(text)), set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(words) - size + 1):
                held = windows.get(tuple(words[i : i + size]), ())
                if held:
                    hit |= set(range(i, i + size))
                    found |= held
        out.append((doc, len(words), len(hit), len(found), sorted(map(str, found))))
    return sorted(out, key=str)


@pytest.mark.parametrize("limit", [32 << 20, 2000])
def test_hits_equal_trying_every_window(spark, documents, monkeypatch, limit):
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", limit)
    rng = random.Random(4)
    words = ["a", "B", "é", "É", "ΑΣ", "x1", "K", "to", "日本"]
    gaps = [" ", ", ", "\n", "--", "\t"]

    def text(k):
        return "".join(rng.choice(words) + rng.choice(gaps) for _ in range(k))

    items = [(i, text(rng.choice([0, 1, 2, 3, 5, 9]))) for i in range(12)] + [(3, "a B"), (None, "to"), (50, None)]
    items += [(100 + i, items[5][1]) for i in range(3)]
    docs = [(i, text(rng.choice([0, 1, 4, 30]))) for i in range(60)]
    docs += [(70, "zz " + items[7][1].upper()), (None, None), (None, items[4][1]), (1, docs[1][1]), (1, "!")]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    frame = documents(docs).withColumns({"start": F.lit("x"), "n_hit": F.lit(-1), "words": F.lit(1)})
    found = decontaminate.report(frame, benchmark, 3).collect()
    assert sorted(((r[0], r[1], r[2], r[3], r[4]) for r in found), key=str) == brute(docs, items, 3)
    kept = decontaminate.drop_contaminated(frame, benchmark, 3)
    clean = sorted((d for d, *_, n, _, _ in ((x[0], x[1], x[2], x[3], x[4]) for x in brute(docs, items, 3)) if n == 0), key=str)
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == clean
    assert kept.columns == frame.columns
    cut = decontaminate.remove_spans(frame, benchmark, 3)
    assert cut.columns == frame.columns and cut.count() == len(docs)
    sizes = {(r["doc_id"], r["text"] is None): 0 for r in cut.collect()}
    assert len(sizes) == len({(d, t is None) for d, t in docs})


def test_spans_are_cut_out(spark, documents):
    benchmark = spark.createDataFrame([(1, "one two three")], "item_id bigint, text string")
    docs = documents([(1, "  Zero, One two THREE; four."), (2, "one two"), (3, None)])
    cut = {r["doc_id"]: r["text"] for r in decontaminate.remove_spans(docs, benchmark).collect()}
    assert cut == {1: "  Zero, four.", 2: "one two", 3: None}


def test_empty_tables(spark, documents):
    benchmark = spark.createDataFrame([(1, "one two")], "item_id bigint, text string")
    assert decontaminate.report(documents([]), benchmark).isEmpty()
    rows = decontaminate.report(documents([(1, "one two")]), benchmark.filter("false")).collect()
    assert [tuple(r) for r in rows] == [(1, 2, 0, 0, [])]
    assert decontaminate.drop_contaminated(documents([(1, "x")]), benchmark.filter("false")).count() == 1


def test_no_python_in_the_plan(spark):
    sf = "/root/testdata/sf0.001"
    docs, items = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "benchmark"))
    hits = decontaminate.find_hits(docs, decontaminate.benchmark_windows(items))
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert not [x for x in ("Python", "Pandas", "Arrow", "NestedLoop", "Cartesian") if x in plan]

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartlark.llm import near_dup
from cartlark.llm.components import components


def shingles(text, words):
    found = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for mark in "\t\n\x0b\x0c\r":
        found = found.replace(mark, " ")
    found = [w for w in found.split(" ") if w]
    size = min(words, len(found))
    return {tuple(found[i : i + size]) for i in range(len(found) - size + 1)} if found else set()


def brute(rows, words, percent):
    sets = [shingles(text, words) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    groups = {}
    for i, (doc, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(doc)
    out = []
    for i, (doc, _) in enumerate(rows):
        least = min((d for d in groups[find(i)] if d is not None), default=None)
        out.append((doc, len(sets[i]), least, doc == least))
    return sorted(out, key=str)


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return words


def families(rng, sizes, length=120):
    """Groups of edited copies: many are near the base and not near each other."""
    rows, n = [], 0
    for size in sizes:
        base = [f"w{rng.randrange(10**6)}" for _ in range(length)]
        for _ in range(size):
            rows.append((n, " ".join(edited(rng, base, rng.randrange(7)))))
            n += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("words", "percent", "tile"), [(3, 85, 640), (5, 80, 640), (3, 85, 10)])
def test_components_equal_comparing_all_pairs(spark, documents, monkeypatch, words, percent, tile):
    monkeypatch.setattr(near_dup, "TILE", tile)
    rng = random.Random(words + tile)
    rows = families(rng, [40, 15, 6, 2, 2, 1, 1])
    rows += [(1000 + i, rows[i][1].upper()) for i in range(10)]
    rows += [(2000, ""), (2001, None), (2002, " \n"), (2003, "two words"), (2004, "Two\twords"), (2005, "one")]
    found = near_dup.near_duplicates(documents(rows).withColumn("component", F.lit("x")), words, percent)
    got = [(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in found.collect()]
    assert sorted(got, key=str) == brute(rows, words, percent)


def test_ids_that_are_null_or_repeated(spark, documents):
    text, other = " ".join(f"a{i}" for i in range(50)), " ".join(f"b{i}" for i in range(50))
    rows = [(5, text), (5, other), (5, text), (None, text), (None, other + " c"), (None, ""), (7, None), (8, "")]
    docs = documents(rows)
    found = {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in
             near_dup.near_duplicates(docs).collect()}
    assert found == {(5, 46, 5, True), (None, 46, 5, False), (None, 47, 5, False),
                     (None, 0, None, True), (7, 0, 7, True), (8, 0, 8, True)}
    kept = near_dup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted(
        [(5, text), (5, other), (None, ""), (7, None), (8, "")], key=str
    )


def test_rows_without_words_are_not_folded(spark, documents):
    empty = [(7, None), (7, None), (7, ""), (None, None), (None, ""), (None, " \n"), (None, " \n")]
    kept = near_dup.drop_near_duplicates(documents([*empty, (1, "one"), (1, "one"), (None, "."), (None, ".")]))
    found = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    assert found == sorted([*empty, (1, "one"), (None, ".")], key=str)


def test_no_documents(spark, documents):
    assert near_dup.near_duplicates(documents([])).isEmpty()
    assert near_dup.drop_near_duplicates(documents([])).isEmpty()


def test_a_wanted_pair_is_dropped_no_more_often_than_chosen():
    rng = np.random.default_rng(1)
    assert [n for n, _ in near_dup.fewest_matches(0.85)] == [24, 48, 72, 96, 120]
    left = np.zeros((20_000, near_dup.HASHES), np.uint32)
    right = (rng.random(left.shape) > 0.85).astype(np.uint32)  # similarity 0.85
    assert len(near_dup.plausible(left, right, 0.85)) == 20_000
    far = (rng.random(left.shape) > 0.4).astype(np.uint32)
    assert len(near_dup.plausible(left, far, 0.85)) < 100


def test_signatures_agree_as_often_as_sets_are_similar():
    rng = random.Random(3)
    shared = 0
    for _ in range(60):
        words = [f"w{rng.randrange(10**6)}" for _ in range(200)]
        a, b = (near_dup.shingle_set(" ".join(x), 3) for x in (words, edited(rng, words, 8)))
        wanted = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        shared += (near_dup.signature(a) == near_dup.signature(b)).mean() - wanted
    assert abs(shared / 60) < 0.02


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(200, 201), (5, 5)]
    found = {r["node"]: r["component"] for r in
             components(spark.createDataFrame(edges, "a int, b int")).collect()}
    assert found == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 160)}, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a int, b int")).isEmpty()

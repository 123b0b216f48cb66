import zlib

from pyspark.sql import functions as F

from cartlark.llm import sharding


def test_shards_have_near_equal_bytes_and_places_without_gaps(spark):
    rows = sharding.op5_sharding(spark, "/root/testdata/sf0.1").collect()
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").collect()
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in docs}
    assert len(rows) == len(docs)
    for r in rows:
        assert r["size"] == len(texts[r["doc_id"]]) + 1
        assert r["text_crc32"] == zlib.crc32(texts[r["doc_id"]])
        assert (r["law"], r["grown_shard"]) == ("bytes", None)
    total = [sum(r["size"] for r in rows if r["shard"] == s) for s in range(8)]
    assert max(total) - min(total) < 0.001 * sum(total)
    for shard in range(8):
        places = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert places == list(range(len(places)))


def test_rebalancing_edits_the_map(spark):
    weight = {slot: 1 + slot % 5 for slot in range(64)}
    first = sharding.rebalance(sharding.first_map(64, 4), weight, 4)
    weight[3] += 40
    second = sharding.rebalance(first, weight, 4)
    moved = [slot for slot in range(64) if first[slot] != second[slot]]
    loads = [sum(weight[s] for s in second if second[s] == shard) for shard in range(4)]
    assert 0 < len(moved) < 20 and max(loads) - min(loads) <= 2
    wider = sharding.rebalance(second, weight, 5)
    changed = [wider[s] for s in wider if wider[s] != second[s]]
    loads = [sum(weight[s] for s in wider if wider[s] == shard) for shard in range(5)]
    assert 4 in changed and len(changed) < 20 and max(loads) - min(loads) <= 5
    fewer = sharding.rebalance(second, weight, 3)
    assert set(fewer.values()) == {0, 1, 2} and set(fewer) == set(range(64))


def test_map_versions_are_kept(spark, documents, tmp_path):
    path = str(tmp_path / "map")
    sharding.write_map(spark, path, 1, sharding.first_map(16, 2))
    rows = [(i, "x" * (i % 7)) for i in range(50)] + [(None, None), (None, ""), (5, "x" * 5), (5, "x" * 5)]
    docs = documents(rows).withColumns({"shard": F.lit("old"), "virtual_slot": F.lit(-1)})
    for version in (2, 3):
        placed = sharding.assign(sharding.slotted(docs, 16), path, 2, 16)
        assert placed.count() == 54
        assert sharding.latest_map(spark, path)[0] == version
    assert spark.read.parquet(path).select("version").distinct().count() == 3
    assert {r["size"] for r in placed.filter("doc_id is null").collect()} == {1}
    empty = sharding.assign(sharding.slotted(documents([]), 16), path, 2, 16)
    assert empty.isEmpty()


def test_copies_of_one_row_spread(spark, documents, tmp_path, monkeypatch):
    monkeypatch.setattr(sharding, "COPIES", 64, raising=False)
    rows = [(i, f"text {i}") for i in range(200)]
    path = str(tmp_path / "map")
    sharding.write_map(spark, path, 1, sharding.first_map(512, 8))
    docs = documents(rows + [(7, "text 7")] * 700 + [(None, None)] * 300)
    placed = sharding.assign(sharding.slotted(docs, 512), path, 8, 512).collect()
    assert len(placed) == 1200
    assert sum(r["doc_id"] == 7 for r in placed) == 701 and sum(r["doc_id"] is None for r in placed) == 300
    total = [sum(r["size"] for r in placed if r["shard"] == s) for s in range(8)]
    assert max(total) - min(total) < 0.01 * sum(total)
    for shard in range(8):
        places = sorted(r["slot"] for r in placed if r["shard"] == shard)
        assert places == list(range(len(places)))
    # More copies leave the slots of the others as they are.
    slots = [
        sorted(r["virtual_slot"] for r in sharding.slotted(documents([(7, "x")] * n), 512).collect())
        for n in (100, 150)
    ]
    assert all(slots[1].count(s) >= slots[0].count(s) for s in slots[0])

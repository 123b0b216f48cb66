import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cartlark.llm import token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_counts_and_cache(spark, documents, tmp_path, monkeypatch):
    rows = [(1, "Hello  there"), (2, None), (3, ""), (4, "Hello  there"), (None, "été\n\n x"), (4, "b")]
    docs = documents(rows).withColumn("digest", F.lit(1)).withColumn("N_TOKENS", F.lit("x"))
    cache = str(tmp_path / "cache")
    library = Tokenizer.from_file(PATH)
    expected = sorted(
        (i or -1, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids))
        for i, t in rows
    )

    def counted():
        found = token_counts.count_tokens(docs, PATH, cache).collect()
        return sorted((r["doc_id"] or -1, r["n_bytes"], r["n_tokens"]) for r in found)

    assert counted() == expected
    assert token_counts.cached_counts(spark, cache, PATH).count() == 4
    encoded = []
    run = token_counts.encode_misses
    monkeypatch.setattr(
        token_counts, "encode_misses", lambda texts, t: encoded.append(texts.count()) or run(texts, t)
    )
    assert counted() == expected and encoded == [0]
    more = documents([(9, "Hello  there"), (10, "new")])
    assert token_counts.count_tokens(more, PATH, cache).count() == 2 and encoded == [0, 1]


def test_a_text_appended_twice_counts_once(spark, documents, tmp_path):
    cache, docs = str(tmp_path / "cache"), documents([(1, "a b c")])
    for _ in range(2):  # two runs that did not see each other
        token_counts.encode_misses(
            docs.select(F.unhex(F.sha2("text", 256)).alias("digest"), "text"), PATH
        ).write.mode("append").parquet(token_counts._folder(cache, PATH))
    assert token_counts.count_tokens(docs, PATH, cache).count() == 1


def test_no_documents(spark, documents, tmp_path):
    assert token_counts.count_tokens(documents([]), PATH, str(tmp_path / "c")).isEmpty()


def test_op3_counts_every_document(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    library = Tokenizer.from_file(PATH)
    found = {r["doc_id"]: r for r in
             token_counts.op3_token_counts(spark, "/root/testdata/sf0.001").collect()}
    for row in docs:
        n = len(library.encode(row["text"] or "", add_special_tokens=False).ids)
        assert found[row["doc_id"]]["n_tokens"] == n
        assert found[row["doc_id"]]["over_limit"] == (n > 1024)

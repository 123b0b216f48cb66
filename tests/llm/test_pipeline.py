import os
import random
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
import corpus_pipeline
from cartlark.llm import common

SF = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    docs, found = common.table(spark, SF, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, common.stored(stage(spark, docs, SF), "stage")
        found.append((name, before, docs))
    return found


def test_stages_keep_whole_rows_of_what_they_got(stages):
    assert [name for name, _, _ in stages] == [
        "toxicity", "language ID", "MinHash near-dedup", "benchmark decontamination", "packing"
    ]
    for _, before, after in stages[:-1]:
        assert after.columns == COLUMNS
        assert after.exceptAll(before).isEmpty() and 0 < after.count() <= before.count()


def test_decisions_take_effect(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    _, before, after = stages[0]
    assert after.join(labels.filter("toxic = 1"), "doc_id").isEmpty()
    clean = before.join(labels.filter("toxic = 0"), "doc_id").count()
    assert after.join(labels.filter("toxic = 0"), "doc_id").count() >= 0.98 * clean
    _, before, after = stages[1]
    assert before.count() == after.count()  # every text has letters and a known language
    _, _, after = stages[2]
    assert after.select("text").distinct().count() == after.count()
    _, _, after = stages[4]
    packed = after.groupBy("doc_id").agg(F.sum("length").alias("n"), F.first("doc_tokens").alias("t"))
    assert packed.filter("n != t").isEmpty()
    assert packed.count() == stages[3][2].count()


def test_run_returns_the_last_stages_rows(spark, stages):
    found = registry.queries()["pipeline"](spark, SF)
    assert found.columns == stages[-1][2].columns and found.count() == stages[-1][2].count()


def test_rejected_texts_go(spark, documents, tmp_path):
    docs = documents([(i, "the day and the night with you", "en") for i in range(30)] + [(99, "12 34", "en"), (98, None, None)])
    kept = corpus_pipeline.known_language(spark, docs, SF)
    assert {r["doc_id"] for r in kept.collect()} == set(range(30))


def test_texts_in_an_unlearned_script_go(spark, documents):
    rng = random.Random(5)
    words = {"en": ["the", "and", "with", "day", "night"], "de": ["der", "und", "mit", "tag", "nacht"]}
    rows = [(i, " ".join(rng.choices(words[lang], k=3 + i % 40)), lang)
            for i in range(300) for lang in [("en", "de")[i % 2]]]
    foreign = [(900, "это совсем другой язык и другие буквы", None), (901, "αυτή είναι μια άλλη γλώσσα", None), (902, "да", None)]
    for learned in (rows, [r for r in rows if r[2] == "en"]):  # two languages, and one
        kept = corpus_pipeline.known_language(spark, documents(learned + foreign), SF)
        assert {r["doc_id"] for r in kept.collect()} == {r[0] for r in learned}


def test_the_rest_works_without_this_folder(tmp_path):
    root = os.path.dirname(os.path.abspath(registry.__file__))
    os.symlink(f"{root}/workload", tmp_path / "workload")
    os.makedirs(tmp_path / "cartlark")
    for name in os.listdir(f"{root}/cartlark"):
        if name not in ("llm", "__pycache__"):
            os.symlink(f"{root}/cartlark/{name}", tmp_path / "cartlark" / name)
    (tmp_path / "__spark_entry__.py").write_text(open(f"{root}/__spark_entry__.py").read())
    code = "import __spark_entry__ as e; assert 'top_items' in e.queries() and 'pipeline' not in e.queries()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})

"""The corpus pipeline against a plain version, stage by stage and as a whole."""

import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402
from conftest import SF  # noqa: E402

import corpus_pipeline  # noqa: E402

RANDOM = random.Random(3)


def prose(n, seed):
    rng = random.Random(seed)
    return ". ".join(" ".join(f"{rng.choice('abcdefghijk')}{rng.randrange(400)}" for _ in range(12)) for _ in range(n)) + "."


PASSAGE = prose(3, 99)
SHARED = "This very sentence stands in many documents of the collection, word for word."
ROWS = [
    (1, prose(10, 1), "en", "a", 5), (2, prose(10, 1), None, None, None), (3, prose(10, 1).replace("a1", "zz", 1), "en", "a", 1),
    (4, f"{prose(8, 4)}\n{SHARED}\n{prose(3, 5)}", "en", "b", 0), (5, f"{prose(9, 6)}\n  {SHARED.upper()}\nmenu", "en", "b", 0),
    (6, f"{prose(6, 7)} {PASSAGE} {prose(6, 8)}", "de", "c", 0), (7, PASSAGE + " " + prose(1, 9), "de", "c", 0),
    (8, None, "en", "c", 0), (9, "", "en", None, 0), (10, "too short.", "en", "c", 0), (11, "Home | News | Login\n" * 50, "en", "c", 0),
    (12, "spam spam spam " * 60, "en", "c", 0), (13, prose(3000, 13), "fr", "d", 0), (14, SHARED, "en", "d", 0),
    (15, f"{SHARED}\n" * 9 + prose(9, 15), "en", "d", 0)]
NAMES = "doc_id long, text string, lang string, source string, n_chars long"


def key(rows):
    return sorted(map(repr, (tuple(r) for r in rows)))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(ROWS, NAMES).repartition(4).write.parquet(f"{path}/documents.parquet")
    items = [(1, PASSAGE), (2, None), (None, prose(2, 1)), (3, "nowhere to be found")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def plain_tables(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()
    return [tuple(r) for r in docs], [tuple(r) for r in items]


def test_whole_pipeline_on_awkward_rows(spark, folder):
    docs, items = plain_tables(spark, folder)
    want = brute.pipeline(docs, items)
    assert key(corpus_pipeline.run(spark, folder).collect()) == key(want)
    assert {r[0] for r in want} >= {1, 4, 5, 6, 13} and not {r[0] for r in want} & {7, 8, 9, 10, 11, 12}


def test_whole_pipeline_on_given_rows(spark):
    assert key(corpus_pipeline.run(spark, SF).collect()) == key(brute.pipeline(*plain_tables(spark, SF)))


def test_stages_keep_the_columns_of_documents(spark, folder):
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumn("kept", F.lit("mine")).withColumn("n_words", F.lit(1))
    docs = docs.withColumn("id", F.lit(2)).withColumn("hash", F.lit(3)).withColumn("root", F.lit("r"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.count() > 0, name
        if name == "decontaminate":
            assert PASSAGE not in (out.where("doc_id = 6").first()["text"])
        changed = out.where("n_chars <> length(text)").count()
        assert name == "near_dedup" or changed == 0
        assert {"doc_id", "text", "lang", "source", "n_chars"} <= set(out.columns), name
    empty = docs.where("doc_id < 0")
    assert all(stage(spark, empty, folder).count() == 0 for _, stage in corpus_pipeline.STAGES)


def test_stage_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_dedup", "decontaminate", "encode"]

"""One Python worker per task: each Python step in a row holds a worker per core and the texts once more."""

import os
import re
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import conftest  # noqa: E402, F401
import corpus_pipeline  # noqa: E402
from gridlloyd.llm import decontaminate, line_dedup
from gridlloyd.session import Scratch

PASSAGE = "one two three four five six seven eight nine ten eleven"
ROWS = [(1, f"Before it. {PASSAGE.upper()}, after é it", "a"), (2, PASSAGE, "b"), (3, None, "c"), (None, "", "d"), (3, "None of it", "e"),
        (4, "short item! and once more: Short  item.", "f"), (5, f"x {PASSAGE} y {PASSAGE[4:]} twelve short item", "g"), (1, "few words", "a")]
ITEMS = [(1, PASSAGE + " twelve"), (2, "short item"), (2, PASSAGE), (3, None), (None, "few words"), (4, "")]


def steps(df):
    """Python steps of each stage of the plan."""
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return [len(re.findall("MapInArrow", part)) for part in re.split("Exchange", plan)]


@pytest.fixture
def tables(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, source string")
    return docs, spark.createDataFrame(ITEMS, "item_id long, text string")


@pytest.mark.parametrize("block", [3, 250_000])
def test_scan_and_remove_is_both_operators(tables, monkeypatch, block):
    docs, items = tables
    monkeypatch.setattr(decontaminate, "BLOCK_WINDOWS", block)
    both, each = decontaminate.scan_and_remove(docs, items), decontaminate.remove_spans(decontaminate.scan(docs, items))
    assert both.columns == each.columns and both.dtypes == each.dtypes
    rows = sorted(map(repr, both.collect()))
    assert rows == sorted(map(repr, each.collect()))
    assert len(rows) == len(ROWS) and any("clean_text='Before it. \\n, after é it'" in r for r in rows)
    none = items.where("item_id is null")
    assert [r.clean_text for r in decontaminate.scan_and_remove(docs, none).where("doc_id = 2").collect()] == [PASSAGE]


def test_texts_as_clean_text(tables):
    docs, items = tables
    named = docs.withColumnRenamed("text", "clean_text")
    both = decontaminate.scan_and_remove(named, items, text="clean_text")
    each = decontaminate.remove_spans(decontaminate.scan(named, items, text="clean_text"), text="clean_text")
    assert both.columns == each.columns and sorted(map(repr, both.collect())) == sorted(map(repr, each.collect()))


def test_stages_have_one_python_step_per_task(spark, tables, tmp_path):
    docs, items = tables
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    docs.withColumn("lang", docs["source"]).withColumn("n_chars", docs["doc_id"]).write.parquet(f"{tmp_path}/documents.parquet")
    read = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        assert max(steps(stage(spark, read, str(tmp_path)))) <= 1, name


def test_filter_maps_have_one_python_step_per_task(spark, monkeypatch):
    seen, kind = [], type(spark.range(0))
    collect = kind.collect
    monkeypatch.setattr(kind, "collect", lambda self: seen.append(steps(self)) or collect(self))
    rows = [(1, "a line of many words\nanother one of them"), (2, "A line of many words \nsomething else entirely"), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = line_dedup.drop_repeated_lines(docs, Scratch(spark)).orderBy("doc_id").collect()
    assert [r.clean_text for r in out] == ["a line of many words\nanother one of them", "something else entirely", ""]
    assert seen and all(max(s) <= 1 for s in seen)


def test_filter_of_lines_seen_twice(spark):
    import numpy as np

    rows = [(i, f"line of some words {i // 3}\nshort\n" + f"once in one text {i}\n" * 2) for i in range(300)]
    bits = line_dedup.SEGMENT_BITS * 4
    found = line_dedup.twice_filter(spark.createDataFrame(rows, "doc_id long, text string").repartition(7), "text", bits, 10)
    places = np.flatnonzero(np.unpackbits(np.frombuffer(found, "uint8"), bitorder="little"))
    twice = line_dedup._numbers([line_dedup.line_key(f"line of some words {k}".encode(), 10) for k in range(100)])
    once = line_dedup._numbers([line_dedup.line_key(f"once in one text {k}".encode(), 10) for k in range(300)])
    want = np.unique(line_dedup._bits(twice, bits))
    assert set(want.tolist()) <= set(places.tolist())
    assert not np.isin(line_dedup._bits(once, bits), places).all(axis=1).any()

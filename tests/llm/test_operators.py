"""The corpus operators against plain versions, on awkward small tables and on the smallest given ones."""

import math
import os
import random
import re
import sys
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402
from conftest import SF  # noqa: E402

from gridlloyd.llm import (  # noqa: E402
    byte_bpe, decontaminate, importance, line_dedup, quality, queries, repeats, simhash, token_counts, token_files, warc,
)
from gridlloyd.session import Scratch  # noqa: E402

JSON, RANKS, WORDS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "word_bpe_49k.json"))
PATTERN = public_tokenizers.PATTERN
RANDOM = random.Random(5)
LINE = "A line that many documents share, word for word, again and again."
PASSAGE = " ".join(RANDOM.choice("alpha beta gamma delta epsilon zeta eta theta".split()) + str(k) for k in range(60))
COPY = "First of all. " + " ".join(f"word{k}" for k in range(120)) + ".\nSecond LINE here, long enough.\n \nShort."
DOCS = [
    (1, None), (2, ""), (3, " \n\t "), (4, COPY), (5, COPY), (6, COPY.replace("word60", "other")), (7, COPY + " tail"),
    (8, f"{LINE}\nown line number eight\n{LINE}\n"), (9, f"  {LINE.upper()} \r\nown line number nine"), (9, f"{LINE}\nrepeated id"),
    (None, f"{LINE}\nno id"), (None, f"{LINE}\nno id"), (None, None), (10, PASSAGE), (11, f"Before: {PASSAGE} after."),
    (12, "x" * 5000), (13, "x" * 450 + "y"), (14, "ab" * 3000 + " " + "é" * 300 + " 日本語" * 200),
    (15, "I'm sure we'll  see   <|endoftext|>special<|endoftext|> <|startoftext|>   odd\x1c\x00 ٣٤ ½ ²x \U0001f600‍\U0001f680 ŠŽ İ ς"),
    (16, "a a a a a a a a"), (17, "A  b\nC"), (18, COPY), (18, COPY), (19, "- | menu | home | login\n" * 30),
    (20, " ".join(RANDOM.choice("abcdefgh") * 3 for _ in range(40_000))), (-5, f"{LINE}\nnegative id comes first"),
    (21, "Zero width​ and combining é then ̈alone.   \n\n\n  end  "), (22, "﻿bom  line sep\x85nel"),
]


def key(rows):
    return sorted(map(repr, (tuple(r) for r in rows)))


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls, empty, very long and equal texts, repeated and null ids, and columns that clash with outputs."""
    df = spark.createDataFrame([(i, t, 7, "z", 3) for i, t in DOCS],
                               "doc_id long, text string, n_tokens int, clean_text string, fingerprint int")
    return df.repartition(5)


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("doc_id = 99999")


@pytest.fixture(scope="module")
def small_rows(small):
    return [tuple(r) for r in small.collect()]


def digest(column):
    return F.sha2(F.col(column).cast("binary"), 256)


def op1(df):
    return token_counts.count_tokens(df, JSON, PATTERN).select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op2(df):
    return simhash.near_duplicates(df, Scratch(df.sparkSession)).select("doc_id", "fingerprint", "component_id")


def op4(df):
    return quality.clean_lines(df).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def op8(df):
    done = repeats.remove_repeats(df, Scratch(df.sparkSession))
    assert done.where(~F.col("kept_sha256").eqNullSafe(F.sha2("kept", 256))).count() == 0
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op9(df):
    return byte_bpe.round_trip_digests(df, RANKS, PATTERN).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op10(df):
    return line_dedup.drop_repeated_lines(df, Scratch(df.sparkSession)).select("doc_id", "n_lines", "n_dropped", digest("clean_text"))


CASES = {
    "counts": (op1, brute.token_counts), "simhash": (op2, brute.simhash), "quality": (op4, brute.quality_base),
    "repeats": (op8, brute.repeats), "codec": (op9, brute.codec), "lines": (op10, brute.line_dedup),
}


@pytest.mark.parametrize("name", CASES)
def test_awkward_rows(docs, name):
    spark_version, plain = CASES[name]
    assert key(spark_version(docs).collect()) == key(plain(DOCS))


@pytest.mark.parametrize("name", CASES)
def test_given_rows(small, small_rows, name):
    spark_version, plain = CASES[name]
    assert key(spark_version(small).collect()) == key(plain(small_rows))


@pytest.mark.parametrize("name", CASES)
def test_empty_table(empty, name):
    assert CASES[name][0](empty).collect() == []


def test_extra_columns_pass_through(docs):
    counted = token_counts.count_tokens(docs, JSON, PATTERN)
    assert sorted(counted.columns) == sorted([*docs.columns, "n_bytes", "over_limit"])
    cleaned = quality.clean_lines(docs)
    assert cleaned.columns.count("clean_text") == 1 and "fingerprint" in cleaned.columns
    assert set(simhash.keep_one(docs, Scratch(docs.sparkSession)).columns) == set(docs.columns)


def _token_files(df):
    scratch = Scratch(df.sparkSession)
    path = f"{scratch.path}/files"
    token_files.write_token_files(df, path, WORDS, end_id=2, length=64, per_batch=8)
    return path, token_files.read_documents(df.sparkSession, path, scratch)


def test_token_files_of_given_rows(small, small_rows):
    assert key(_token_files(small)[1].collect()) == key(brute.token_files(small_rows))


def test_token_files_of_awkward_rows(docs):
    got, want = _token_files(docs)[1].collect(), brute.token_files(DOCS)
    # Rows with equal or null ids have an order of their own: their starts may change places.
    assert key((r[0], *r[2:]) for r in got) == key((r[0], *r[2:]) for r in want)
    spans = sorted((r["start"], r["n_tokens"]) for r in got)
    assert all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:])) and spans[0][0] == 0
    order = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
    assert order == sorted(order, key=lambda i: (i is not None, i or 0))


def test_token_files_of_an_empty_table(empty):
    assert _token_files(empty)[1].collect() == []


def test_sequences_are_views_of_the_file(spark, small, small_rows):
    import numpy as np
    import pyarrow as pa

    path, _ = _token_files(small)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).collect()
    content = next(bytes(f["content"]) for f in files if f["length"])
    reader = token_files.open_tokens(content)
    rows = sum(reader.get_batch(i).num_rows for i in range(reader.num_record_batches))
    whole = np.concatenate([token_files.sequence(reader, i)[0] for i in range(rows)])
    mask = np.concatenate([token_files.sequence(reader, i)[1].to_numpy(zero_copy_only=False) for i in range(rows)])
    documents = pa.ipc.open_stream(reader.schema.metadata[b"documents"]).read_all()
    assert len(whole) == rows * 64 and mask.sum() == sum(documents["n_tokens"].to_pylist())
    ids, _ = token_files.sequence(reader, 0)
    assert not ids.flags.owndata and not ids.flags.writeable


def test_line_rules():
    assert quality.line_fails("Home | About | Contact") and quality.line_fails("click here to log in")
    assert quality.line_fails("function() { return 1; }") and quality.line_fails("All Rights Reserved, 2020, by all of us.")
    assert quality.line_fails("a short title") and not quality.line_fails("A short sentence.")
    assert not quality.line_fails("") and not quality.line_fails("ten words " * 5)


def test_documents_that_lose_too_much_are_rejected(spark):
    clean = " ".join(f"word{k} is here" for k in range(40)) + "."
    rows = [(1, clean), (2, clean + "\n" + "Home | News | Login | Shop | Cart | Help | Maps\n" * 20), (3, clean + "\nmenu"), (4, None)]
    got = {r["doc_id"]: r for r in quality.clean_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i]["kept"] for i in (1, 2, 3, 4)] == [True, False, True, False]
    assert got[3]["clean_text"] == clean and got[2]["lost_chars"] > 0


def test_clean_documents_are_kept(spark):
    labels = spark.read.parquet(f"{os.path.dirname(SF)}/sf0.01/labels.parquet")
    documents = spark.read.parquet(f"{os.path.dirname(SF)}/sf0.01/documents.parquet")
    found = quality.clean_lines(documents).join(labels.where("quality = 1"), "doc_id").where("not base_failed")
    assert found.agg(F.avg(F.col("kept").cast("int"))).first()[0] > 0.99


ITEMS = [
    (1, PASSAGE), (2, "Before alpha"), (3, None), (4, "!!!"), (None, "own line number"), (5, "word3 Word4, WORD5"), (10, PASSAGE),
    (6, "own line number eight " + " ".join(f"word{k}" for k in range(30)))]


def _decontaminated(df, items):
    found = decontaminate.scan(df, items)
    return found.select("doc_id", "n_words", F.size("hit_words").cast("long"), F.size("items").cast("long"),
                        F.sha2(F.concat_ws(",", "items").cast("binary"), 256), F.size("hit_words") > 0)


@pytest.mark.parametrize("block", [250_000, 7])
def test_decontamination(spark, docs, small, small_rows, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_WINDOWS", block)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert key(_decontaminated(docs, items).collect()) == key(brute.decontaminate(DOCS, ITEMS))
    if block > 7:
        benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
        rows = [(r["item_id"], r["text"]) for r in benchmark.collect()]
        assert key(_decontaminated(small, benchmark).collect()) == key(brute.decontaminate(small_rows, rows))
    assert _decontaminated(docs, items.where("item_id = 77")).where("n_words is null").count() == 0


def test_spans_are_cut_out(spark):
    items = spark.createDataFrame([(1, "one two three"), (2, "seven")], "item_id long, text string")
    df = spark.createDataFrame([(1, "Zero, One two-three; four."), (2, "six Seven eight sevens"), (3, None)], "doc_id long, text string")
    got = decontaminate.remove_spans(decontaminate.scan(df, items)).orderBy("doc_id").collect()
    assert [r["clean_text"] for r in got] == ["Zero, \n; four.", "six \n eight sevens", ""]


PAGES = [
    (1, "http://a/", "p" * 1500), (2, "http://b/ x\r\ny", "p" * 1500), (3, None, "p" * 1500), (4, "u", "q" * 999), (5, "u", "q" * 999),
    (6, "u", None), (7, "u", ""), (8, "u", "é\r\n\r\nWARC/1.1\r\n" * 200), (9, "u", "é\r\n\r\nWARC/1.1\r\n" * 200), (9, "v", "é\r\n\r\nWARC/1.1\r\n" * 200),
    (None, "w", "p" * 1500), (None, "w", "r" * 2000), (None, "w", "r" * 2000), (10, "u", "\x00퟿" * 700)]


def _archived(df):
    scratch = Scratch(df.sparkSession)
    warc.write_archives(df, f"{scratch.path}/archives", date="2024-01-01T00:00:00Z")
    read = scratch.write(warc.read_archives(df.sparkSession, f"{scratch.path}/archives"), "records")
    return warc.resolve_revisits(read)


def test_archives(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string").repartition(3)
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    done = _archived(df)
    assert key(done.select(*columns).collect()) == key(brute.warc(PAGES))
    assert {r["url"] for r in done.where("page_id in (2, 3)").collect()} == {"http://b/%20x%0D%0Ay", None}
    assert _archived(df.where("page_id = 99")).collect() == []
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html")
    assert key(_archived(pages).select(*columns).collect()) == key(brute.warc([tuple(r) for r in pages.collect()]))


def test_sample_has_the_size_and_prefers_the_target(spark, docs, empty):
    base = f"{os.path.dirname(SF)}/sf0.01"
    documents = spark.read.parquet(f"{base}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{base}/labels.parquet").persist()
    half = labels.where("doc_id % 2 = 0")
    got = importance.resample(documents, half, Scratch(spark)).persist()
    share = half.agg(F.avg("quality")).first()[0]
    assert got.where("kept").count() == round(share * got.count())
    least = got.where("kept").agg(F.min("gumbel_key")).first()[0]
    assert got.where(f"not kept and gumbel_key >= {least!r}").count() == 0
    held_out = got.join(labels.where("doc_id % 2 = 1"), "doc_id")
    rate = {r["quality"]: r["r"] for r in held_out.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("r")).collect()}
    assert rate[1] > 0.95 and rate[0] < 0.2
    few = importance.resample(docs, half, Scratch(spark), size=4).collect()
    assert len(few) == len(DOCS) and sum(r["kept"] for r in few) >= 4
    assert all(not r["kept"] for r in few if r["log_weight"] is None)
    assert importance.resample(empty, labels, Scratch(spark)).collect() == []
    assert importance.resample(docs, labels.where("doc_id < 0"), Scratch(spark)).where("kept").count() == 0


def plain_resampling(docs, labels, noise, size):
    """(weight, key, kept) of each text, from n-grams counted one by one; ``noise`` is the hash of each row."""
    times, mask = importance.MULTIPLIER, 2**64 - 1

    def mixed(x):
        x = (x ^ (x >> 32)) * 0xD6E8FEB86659FD93 & mask
        return x ^ (x >> 29)

    def buckets(text):
        tokens = re.findall(rb"[0-9A-Za-z_\x80-\xff]+|[^0-9A-Za-z_\x80-\xff \t\n\x0b\x0c\r]+", (text or "").encode())
        hashes = [mixed(sum((b + 1) * pow(times, i, 2**64) for i, b in enumerate(t)) & mask) for t in tokens]
        pairs = [mixed((a * times + b) & mask) for a, b in zip(hashes, hashes[1:])]
        return [h % importance.BUCKETS for h in hashes + pairs]

    quality, toxic = {}, {}
    for i, q, t in labels:
        quality[i], toxic[i] = min(quality.get(i, q), q), max(toxic.get(i, t), t)
    grams, counts = [buckets(text) for _, text in docs], [Counter(), Counter()]
    for (i, _), own in zip(docs, grams):
        counts[1].update(own)
        if i is not None and quality.get(i) == 1 and toxic[i] == 0:
            counts[0].update(own)
    totals = [sum(c.values()) + importance.BUCKETS for c in counts]
    out = []
    for own, h in zip(grams, noise):
        weight = sum(math.log((counts[0][b] + 1) / totals[0]) - math.log((counts[1][b] + 1) / totals[1]) for b in own)
        uniform = ((h & mask) >> 11) + 0.5
        out.append((weight, weight - math.log(-math.log(uniform / 2**53))) if own else (None, None))
    ranked = sorted((k for _, k in out if k is not None), reverse=True)
    least = (ranked[size - 1] if size <= len(ranked) else -math.inf) if size else math.inf
    return [(w, k, k is not None and k >= least) for w, k in out]


@pytest.mark.parametrize("size", [0, 1, 5, 10**6])
def test_resampling_equals_plain_counts(spark, docs, size):
    """Weights, keys, the k-th place and its ties; columns with the names of outputs are replaced."""
    labels = [(4, 1, 0), (8, 1, 0), (14, 1, 0), (18, 1, 1), (20, 0, 0), (11, 1, 0), (11, 0, 0), (77, 1, 0)]
    frame = spark.createDataFrame([*labels, (None, 1, 0)], "doc_id long, quality int, toxic int")
    mine = docs.withColumn("kept", F.lit("mine")).withColumn("gumbel_key", F.lit(-1)).withColumn("extra", F.xxhash64("doc_id", F.lit(3)))
    rows = mine.select("doc_id", "text", "extra").collect()
    want = plain_resampling([tuple(r)[:2] for r in rows], labels, [r["extra"] for r in rows], size)
    got = importance.resample(mine, frame, Scratch(spark), seed=3, size=size).collect()
    assert len(got) == len(rows) and "text" not in got[0].asDict()

    def tidy(i, weight, key, kept):
        return repr((i, None if weight is None else round(weight, 6), None if key is None else round(key, 6), kept))

    assert sorted(tidy(r["doc_id"], r["log_weight"], r["gumbel_key"], r["kept"]) for r in got) == sorted(
        tidy(r["doc_id"], *w) for r, w in zip(rows, want))


def test_resampling_of_given_rows_equals_plain_counts(spark, small):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality", "toxic")
    rows = small.select("doc_id", "text", F.xxhash64("doc_id", F.lit(0)).alias("h")).collect()
    got = importance.resample(small, labels, Scratch(spark)).collect()
    judged = [tuple(r) for r in labels.collect()]
    size = round(sum(q == 1 for _, q, _ in judged) / len(judged) * len(rows))
    want = plain_resampling([tuple(r)[:2] for r in rows], judged, [r["h"] for r in rows], size)
    kept = {r["doc_id"] for r, w in zip(rows, want) if w[2]}
    assert {r["doc_id"] for r in got if r["kept"]} == kept and len(kept) == size
    weight = {r["doc_id"]: w[0] for r, w in zip(rows, want)}
    assert all(abs(r["log_weight"] - weight[r["doc_id"]]) < 1e-6 for r in got)


def test_gumbel_noise_repeats_and_differs_by_seed(spark, docs):
    labels = spark.createDataFrame([(4, 1, 0), (12, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    runs = [importance.resample(docs, labels, Scratch(spark), seed=s, size=3).where("doc_id = 4").first() for s in (1, 1, 2)]
    assert runs[0] == runs[1] and runs[0]["gumbel_key"] != runs[2]["gumbel_key"]


def test_one_of_each_near_duplicate_group_stays(spark, docs):
    stay = simhash.keep_one(docs, Scratch(spark)).collect()
    groups = brute.simhash(DOCS)
    assert len(stay) == simhash.near_duplicates(docs, Scratch(spark)).select("root").distinct().count()
    assert {r["doc_id"] for r in stay} == {c for _, _, c in groups}


def test_hot_subtrees_are_split(spark, monkeypatch):
    values = [(i << 40 | RANDOM.getrandbits(12)) for i in range(40) for _ in range(40)]
    distinct = spark.createDataFrame([(v,) for v in set(values)], "fingerprint long").persist()

    def groups():
        edges = simhash.links(distinct, 4, distinct.count())
        found = simhash.components(edges, Scratch(spark)).collect()
        by_root = {}
        for r in found:
            by_root.setdefault(r["root"], set()).add(r["node"])
        return sorted(sorted(g) for g in by_root.values())

    whole = groups()
    monkeypatch.setattr(simhash, "NODE_ROWS", 50)
    monkeypatch.setattr(simhash, "HOT_NODES", 10**9)
    assert groups() == whole and whole


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(200)] + [(1000, 1000 + k) for k in range(1, 100)] + [(5, 5)]
    found = simhash.components(spark.createDataFrame(edges, "u long, v long"), Scratch(spark)).collect()
    roots = {r["node"]: r["root"] for r in found}
    assert len({roots[k] for k in range(201)}) == 1 and len({roots[1000 + k] for k in range(100)}) == 1
    assert roots[0] != roots[1000]


def test_hot_bundles_are_never_shuffled_but_counted(spark, monkeypatch):
    text = " ".join(f"w{k}" for k in range(120))
    rows = [(i, text) for i in range(30)] + [(100 + i, f"{i} start {text[:260]} end {i * 7}") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(repeats, "HOT_SHARE", 20)
    monkeypatch.setattr(repeats, "_DEAL_ROWS", 4)
    monkeypatch.setattr(repeats, "_PART_BYTES", 3000)
    assert key(op8(df).collect()) == key(brute.repeats(rows))


def test_long_texts_are_cut_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(repeats, "_CHUNK", 700)
    body = "".join(RANDOM.choice("abcdefghij ") for _ in range(6000))
    rows = [(1, body), (2, "z" * 333 + body[100:5000]), (3, body[2500:2750])]
    assert key(op8(spark.createDataFrame(rows, "doc_id long, text string")).collect()) == key(brute.repeats(rows))


def test_filters_lose_no_repeated_line(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "MAX_FILTER_BITS", 1 << 20)
    rows = [(i, "\n".join(f"line number {RANDOM.randrange(3000)}" for _ in range(40))) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(16)
    assert key(op10(df).collect()) == key(brute.line_dedup(rows))


def test_registered_names():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.REGISTRY)
    assert numbers == list(range(1, 11))

"""Registered queries of the corpus operators: each over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import Scratch
from . import (
    byte_bpe, checks, conversations, decontaminate, hard_negatives, importance, line_dedup, quality, repeats, simhash, token_counts, token_files,
    top_k, warc,
)

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
#: DuckDB SQL by query name, where SQL can express the operator.
SQL = checks.SQL


def query(fn):
    REGISTRY[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


@query
def op1_token_counts(spark, sf_dir):
    documents = _table(spark, sf_dir, "documents", "doc_id", "text")
    return token_counts.count_tokens(
        documents, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN,
    ).select("doc_id", "n_bytes", "n_tokens", "over_limit")


@query
def op9_byte_bpe_codec(spark, sf_dir):
    documents = _table(spark, sf_dir, "documents", "doc_id", "text")
    return byte_bpe.round_trip_digests(
        documents, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
    ).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query
def op2_simhash_near_dedup(spark, sf_dir):
    documents = _table(spark, sf_dir, "documents", "doc_id", "text")
    return simhash.near_duplicates(documents, Scratch(spark)).select("doc_id", "fingerprint", "component_id")


@query
def op3_token_files(spark, sf_dir):
    documents, scratch = _table(spark, sf_dir, "documents", "doc_id", "text"), Scratch(spark)
    path = f"{scratch.path}/token-files"
    token_files.write_token_files(documents, path, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return token_files.read_documents(spark, path, scratch)


@query
def op4_line_first_quality(spark, sf_dir):
    documents = _table(spark, sf_dir, "documents", "doc_id", "text")
    return quality.clean_lines(documents).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query
def op6_warc_revisits(spark, sf_dir):
    pages, scratch = _table(spark, sf_dir, "pages", "page_id", "url", "html"), Scratch(spark)
    path = f"{scratch.path}/archives"
    warc.write_archives(pages, path, date="2024-01-01T00:00:00Z")
    read = scratch.write(warc.read_archives(spark, path), "records")
    return warc.resolve_revisits(read).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op7_decontaminate(spark, sf_dir):
    documents = _table(spark, sf_dir, "documents", "doc_id", "text")
    found = decontaminate.scan(documents, _table(spark, sf_dir, "benchmark", "item_id", "text"))
    n_hit = F.size("hit_words").cast("long")
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


@query
def op10_line_dedup(spark, sf_dir):
    documents = _table(spark, sf_dir, "documents", "doc_id", "text")
    return line_dedup.drop_repeated_lines(documents, Scratch(spark)).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("clean_text").cast("binary"), 256).alias("kept_sha256"))


@query
def op8_suffix_dedup(spark, sf_dir):
    documents = _table(spark, sf_dir, "documents", "doc_id", "text")
    return repeats.remove_repeats(documents, Scratch(spark), keep_bytes=False).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query
def op5_importance_resampling(spark, sf_dir):
    documents = _table(spark, sf_dir, "documents", "doc_id", "text")
    labels = _table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
    return importance.resample(documents, labels, Scratch(spark)).select("doc_id", "log_weight", "gumbel_key", "kept")


@query
def op11_conversation_repair(spark, sf_dir):
    rows = _table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    repair = conversations.Repair(conversations.damage(rows), Scratch(spark))
    audits, digests = repair.audits(), repair.digests().withColumnRenamed("conv_id", "c")
    found = audits.join(digests, audits["conv_id"].eqNullSafe(digests["c"])).drop("c").withColumnRenamed("conv_id", "c")
    all_ids = rows.select("conv_id").distinct()
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return all_ids.join(found, all_ids["conv_id"].eqNullSafe(found["c"]), "left").select(
        "conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


@query
def op12_exact_top_k(spark, sf_dir):
    rows = _table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return top_k.exact_top_k(rows, rows.where("vec_id % 50 = 0"), Scratch(spark), k=5)


@query
def op13_hard_negatives(spark, sf_dir):
    label = F.expr("if(vec_id % 7 = 0, (cast(label AS bigint) + 1) % 10, cast(label AS bigint))")
    rows = _table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label").withColumn("label", label)
    return hard_negatives.mine_hard_negatives(rows, rows.where("vec_id % 100 = 0"), Scratch(spark))

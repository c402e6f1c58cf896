"""From raw documents to token ids: clean, deduplicate lines and documents, decontaminate, encode.

Each stage takes (spark, docs, sf_dir) and works on all rows of ``docs``. All but the last return the
columns of their input, with ``text`` and ``n_chars`` as the stage leaves them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlloyd.llm import byte_bpe, decontaminate, line_dedup, quality, simhash
from gridlloyd.session import Scratch

#: A document is removed if more than this share of its words occurs in benchmark items.
MAX_HIT_PERCENT = 50


def _cleaned(found: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` with ``clean_text`` as the text and its length as ``n_chars``."""
    new = {"text": F.col("clean_text"), "n_chars": F.length("clean_text").cast("long")}
    return found.select(*[new[c].alias(c) if c in new else F.col(c) for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that keep enough of their lines, without the lines that fail a rule; null texts go."""
    return _cleaned(quality.clean_lines(docs).where("kept"), docs)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each without the lines that a document with a smaller id holds; some end up empty."""
    return _cleaned(line_dedup.drop_repeated_lines(docs, Scratch(spark)), docs)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate group, as it is.

    Documents link if their SimHash fingerprints, made of four-word shingles, differ in four bits or fewer.
    """
    return simhash.keep_one(docs, Scratch(spark), width=4, distance=4).select(*docs.columns)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their benchmark passages; those that are mostly such passages go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.scan_and_remove(docs, benchmark)
    return _cleaned(found.where(F.size("hit_words") * 100 <= F.col("n_words") * MAX_HIT_PERCENT), docs)


def encode_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, checked by decoding: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return byte_bpe.round_trip_digests(
        docs.select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
    ).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [
    ("quality", quality_rules),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", keep_one_of_near_copies),
    ("decontaminate", remove_benchmark),
    ("encode", encode_documents),
]
#: SimHash and byte-pair encoding cannot be written in SQL; the tests hold run() to a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``, each result written as Parquet and read by the next stage."""
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
    return docs

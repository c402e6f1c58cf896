"""WARC archives in which each payload is stored once and repeats are revisit records."""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import join_unique, same_or_null, without

#: The separator after every record.
RECORD_END = "\r\n\r\n"
#: The profile of revisits of equal payloads, as the standard names it.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_URN = "urn:x-page:"


def classify(pages: DataFrame, page_id: str = "page_id", html: str = "html", least: int = 1000) -> DataFrame:
    """Per page: ``payload_bytes``, ``payload_digest`` (SHA-1, lower-case hex) and ``original``.

    ``original`` is the largest id among the pages of ``least`` bytes or more with the same payload; it is
    null for the page itself and for smaller payloads. Only digests and sizes are shuffled.
    """
    payload = F.encode(F.coalesce(F.col(html), F.lit("")), "utf-8")
    headers = pages.select(F.col(page_id).alias("page_id"), F.octet_length(payload).cast("long").alias("payload_bytes"),
                           F.sha1(payload).alias("payload_digest"))
    groups = (
        headers.where(F.col("payload_bytes") >= least).groupBy("payload_digest")
        .agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("copies")).where("copies > 1"))
    found = join_unique(headers, groups, ["payload_digest"], "copies", max(headers.count(), 1), ["page_id"])
    return found.select("page_id", "payload_bytes", "payload_digest", F.when(
        F.col("last").isNotNull() & ~F.col("last").eqNullSafe(F.col("page_id")), F.col("last")).alias("original"))


def _header(name: str, value: Column) -> Column:
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))).otherwise("")


def _record_id(page: Column) -> Column:
    return F.concat(F.lit(f"<{_URN}"), F.coalesce(page.cast("string"), F.lit("null")), F.lit(">"))


def write_archives(pages: DataFrame, path: str, date: str, page_id: str = "page_id", url: str = "url",
                   html: str = "html", least: int = 1000) -> None:
    """Write one record per row: the whole response for an original, its headers only for a revisit.

    Headers are made anew: record id, date, target, lengths, digests and, for a revisit, what it refers to.
    Record types are joined to the pages by id, and Spark's text sink writes a gzip-compressed WARC file
    per task. A null payload counts as empty; a null url is left out; characters that cannot stand in a
    header line are percent-encoded. Rows that repeat an id are all written; those with the largest id of
    their payload are all responses.
    """
    kind = classify(pages, page_id, html, least).groupBy("page_id", "payload_digest").agg(
        F.max("original").alias("original"))
    body = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"),
                        F.coalesce(F.col(html), F.lit("")).alias("payload"))
    body = body.withColumn("payload_digest", F.sha1(F.encode("payload", "utf-8")))
    joined = body.join(kind.hint("shuffle_merge"), same_or_null(body, kind, ["page_id"])
                       & (body["payload_digest"] == kind["payload_digest"]), "left").select(
        body["*"], kind["original"])
    revisit = F.col("original").isNotNull()
    size = F.octet_length("payload").cast("string")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size,
                    F.lit("\r\n\r\n"))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    target = F.regexp_replace(F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A"), " ", "%20")
    record = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(revisit, "revisit").otherwise("response"), F.lit("\r\n"),
        _header("WARC-Record-ID", _record_id(F.col("page_id"))), F.lit(f"WARC-Date: {date}\r\n"),
        _header("WARC-Target-URI", target), F.lit("Content-Type: application/http; msgtype=response\r\n"),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        F.when(revisit, F.concat(F.lit(f"WARC-Profile: {PROFILE}\r\n"),
                                 _header("WARC-Refers-To", _record_id(F.col("original"))))).otherwise(""),
        _header("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"), block)
    joined.select(record.alias("record")).write.option("lineSep", RECORD_END).option("compression", "gzip").text(path)


def records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (lower-case names) and block of each record of an uncompressed WARC stream."""
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        headers = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.decode().partition(":")
            headers[name.strip().lower()] = value.strip()
        block = stream.read(int(headers["content-length"]))
        if stream.read(len(RECORD_END)) != RECORD_END.encode():
            raise ValueError("a record does not end where its length says")
        yield headers, block


_READ = "page_id bigint, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, url string"


def _page(urn: str | None) -> int | None:
    digits = urn.removeprefix(f"<{_URN}").removesuffix(">") if urn else "null"
    return None if digits == "null" else int(digits)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """A row per record of the archives under ``path``, revisits resolved to their original responses.

    A response is measured and hashed from its payload; a revisit takes both from the response that it
    refers to, joined by id, and must name the same digest.
    """
    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for headers, block in records(io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content.as_py())), 1 << 20)):
                    payload = block[block.index(b"\r\n\r\n") + 4:]
                    kind = headers["warc-type"]
                    response = kind == "response"
                    rows.append((
                        _page(headers["warc-record-id"]), kind, _page(headers.get("warc-refers-to")),
                        len(payload) if response else None,
                        hashlib.sha1(payload).hexdigest() if response
                        else headers["warc-payload-digest"].removeprefix("sha1:"), headers.get("warc-target-uri")))
                    if len(rows) == 10_000:
                        yield _batch(rows)
                        rows = []
                if rows:
                    yield _batch(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInArrow(run, _READ)


def _batch(rows) -> pa.RecordBatch:
    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    names = ["page_id", "record_type", "refers_to", "payload_bytes", "payload_digest", "url"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def resolve_revisits(read: DataFrame) -> DataFrame:
    """Give every revisit the size of the response it refers to, joined by id and digest."""
    revisits = read.where("record_type = 'revisit'")
    copies = revisits.groupBy("refers_to", "payload_digest").agg(F.count(F.lit(1)).alias("copies"))
    originals = (
        read.where("record_type = 'response'").groupBy(F.col("page_id").alias("refers_to"), "payload_digest")
        .agg(F.max("payload_bytes").alias("original_bytes")))
    sized = copies.join(originals, ["refers_to", "payload_digest"], "left")
    resolved = join_unique(revisits, sized, ["refers_to", "payload_digest"], "copies", max(read.count(), 1), ["page_id"])
    whole = resolved.withColumn("payload_bytes", F.coalesce("original_bytes", F.raise_error(
        F.concat(F.lit("no response for the revisit "), F.col("page_id").cast("string"))).cast("bigint")))
    return read.where("record_type = 'response'").unionByName(whole.select(*without(whole, ["copies", "original_bytes"])))

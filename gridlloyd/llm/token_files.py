"""Token ids in Arrow IPC files of fixed-size lists, for zero-copy random access to equal-length sequences.

A file holds a run of documents in id order: their ids end to end, cut into sequences of one length, the
last one padded, with a mask of the same shape. All batches but the last have the same number of
sequences, so sequence i is row i % size of batch i // size. The schema's metadata names the file's place
in the order and lists its documents with their token counts.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, LongType, StructField, StructType
from tokenizers import Tokenizer

from ..session import Scratch
from .common import slices, texts
from .merging import byte_characters
from .words import MEMO_ENTRIES, unknown

#: The closing magic of an IPC file. Spark's text sink writes it as the separator after its only row.
MAGIC = "ARROW1"
_SPACES = " \t\n\r\x0b\x0c"
_PARTS = re.compile(rf"[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ{_SPACES}]+")
#: Characters whose chunk the library would treat otherwise than part by part: contractions, special strings,
#: and letters and digits beyond ASCII and Latin-1 lower-case letters.
_WHOLE = re.compile(r"['<ªµº²³¹¼-¾\x1c-\x1f\x85\xa0\u0100-\U0010ffff]")
_EVEN = str.maketrans(dict.fromkeys(_SPACES[1:], " "))
#: Bytes of text that are cut into parts at a time.
CUT_BYTES = 1 << 20


def _cut(text: str) -> list[str]:
    """The parts of a text in a row: lower-case runs of letters, digits, runs of others; and, as they are, the chunks
    between white space that hold a character of ``_WHOLE``, which no other part does."""
    found = _WHOLE.search(text)
    if not found:
        return _PARTS.findall(text.lower())
    text, at, out = text.translate(_EVEN), 0, []
    while found:
        start = max(at, text.rfind(" ", at, found.start()) + 1)
        end = text.find(" ", found.end())
        end = len(text) if end < 0 else end
        out += _PARTS.findall(text[at:start].lower())
        out.append(text[start:end])
        found, at = _WHOLE.search(text, end), end
    return out + _PARTS.findall(text[at:].lower())


class Encoder:
    """Encodes texts as the library does, asking it once for each distinct part of a chunk between white space.

    White space separates pre-tokens in word-level vocabularies, whatever surrounds it; so the ids of a
    text are those of its chunks in a row, and those of a chunk are the ids of its parts. A memo of two
    generations keeps the parts that come again; when the younger is full it takes the place of the elder.
    """

    def __init__(self, content: bytes, dtype: str):
        self.dtype = dtype
        self.tokenizer = Tokenizer.from_str(content.decode())
        self.map = str.maketrans({chr(b): c for b, c in enumerate(byte_characters())})
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _learn(self, parts: Iterable[str]) -> None:
        model, code = self.tokenizer.model, "H" if self.dtype == "<u2" else "I"
        for part in parts:
            ids = self.old.get(part)
            if ids is None:
                if part.isascii() and part.isalpha():
                    found = [t.id for t in model.tokenize(part)]
                elif _WHOLE.search(part):
                    found = self.tokenizer.encode(part, add_special_tokens=False).ids
                else:
                    found = [t.id for t in model.tokenize(part.encode().decode("latin-1").translate(self.map))]
                ids = array(code, found).tobytes()
            self.young[part] = ids

    def encode(self, values: list[str]) -> list[bytes]:
        if len(self.young) > MEMO_ENTRIES:
            self.young, self.old = {}, self.young
        cut = [_cut(v) for v in values]
        self._learn(unknown(cut, self.young))
        part = self.young.__getitem__
        return [b"".join(map(part, ps)) for ps in cut]


@lru_cache(maxsize=1)
def _encoder(content: bytes, dtype: str) -> Encoder:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(content, dtype)


def _file(number: int, ids: np.ndarray, documents: pa.RecordBatch, length: int, per_batch: int) -> bytes:
    """One IPC file of the given ids."""
    rows = -(-len(ids) // length)
    values, mask = np.zeros(rows * length, ids.dtype), np.arange(rows * length) < len(ids)
    values[:len(ids)] = ids
    table = pa.BufferOutputStream()
    with pa.ipc.new_stream(table, documents.schema) as writer:
        writer.write_batch(documents)
    columns = [pa.FixedSizeListArray.from_arrays(pa.array(x), length) for x in (values, mask)]
    schema = pa.schema(
        [("input_ids", columns[0].type), ("attention_mask", columns[1].type)],
        {b"file": str(number).encode(), b"documents": table.getvalue().to_pybytes()})
    out = pa.BufferOutputStream()
    with pa.ipc.new_file(out, schema) as writer:
        for at in range(0, rows, per_batch):
            writer.write_batch(pa.RecordBatch.from_arrays([c.slice(at, per_batch) for c in columns], schema=schema))
    return out.getvalue().to_pybytes()


def write_token_files(df: DataFrame, path: str, tokenizer: str, end_id: int, doc_id: str = "doc_id",
                      text: str = "text", length: int = 2048, per_batch: int = 256) -> None:
    """Encode every text, append ``end_id`` to each, and write the ids in ascending order of ``doc_id``.

    ``tokenizer`` is the path of a word-level BPE file in JSON, read here and sent to the tasks. Rows are
    range-partitioned and sorted (null ids first, equal ids by the hash of the text; all rows stay); each
    task then encodes its range into one file, so a file is as large as a shuffle partition. A null or
    empty text is its end id alone. An empty table gives a folder without sequences.
    """
    with open(tokenizer, "rb") as f:
        raw = f.read()
    top = max(Tokenizer.from_str(raw.decode()).get_vocab_size(with_added_tokens=True) - 1, end_id)
    dtype = "<u2" if top < 1 << 16 else "<u4"
    content = df.sparkSession.sparkContext.broadcast(raw)
    order = [F.col(doc_id), F.xxhash64(F.col(text))]
    ranged = df.select(doc_id, text).repartitionByRange(*order).sortWithinPartitions(*order)
    end = np.array([end_id], dtype).tobytes()

    def run(batches):
        parts, counts, names = [], [], []
        for batch in batches:
            for part in slices(batch, batch.schema.names[1], CUT_BYTES):
                made = _encoder(content.value, dtype).encode(texts(part.column(1)))
                parts.append(b"".join([x for ids in made for x in (ids, end)]))
                counts += [len(ids) // end_width + 1 for ids in made]
                names.append(part.column(0))
        if not counts:
            return
        documents = pa.RecordBatch.from_arrays(
            [pa.concat_arrays(names), pa.array(counts, pa.int64())], names=["doc_id", "n_tokens"])
        ids = np.frombuffer(b"".join(parts), dtype)
        whole = _file(TaskContext.get().partitionId(), ids, documents, length, per_batch)
        yield pa.RecordBatch.from_arrays([pa.array([whole[:-len(MAGIC)]], pa.binary())], names=["content"])

    end_width = len(end)
    files = ranged.mapInArrow(run, "content binary").select(F.col("content").cast("string"))
    files.write.option("lineSep", MAGIC).text(path)


def open_tokens(content: bytes | pa.Buffer) -> pa.ipc.RecordBatchFileReader:
    """The file's reader; with a memory-mapped buffer nothing is copied."""
    return pa.ipc.open_file(pa.py_buffer(content) if isinstance(content, bytes) else content)


def sequence(reader: pa.ipc.RecordBatchFileReader, i: int) -> tuple[np.ndarray, pa.BooleanArray]:
    """Ids and mask of sequence ``i`` as views of the file's bytes; the mask has a bit for each id."""
    size = reader.get_batch(0).num_rows
    ids, mask = (c.slice(i % size, 1).flatten() for c in reader.get_batch(i // size).columns)
    return ids.to_numpy(zero_copy_only=True), mask


def _documents(content: bytes, id_name: str):
    """Rows of one file's documents: their place, id, first token, count and checksum."""
    reader = open_tokens(content)
    meta = reader.schema.metadata
    number = int(meta[b"file"])
    documents = pa.ipc.open_stream(meta[b"documents"]).read_all().to_batches()[0]
    ids = [np.zeros(0, "<u4")]
    for i in range(reader.num_record_batches):
        values, mask = (c.flatten().to_numpy(zero_copy_only=False) for c in reader.get_batch(i).columns)
        ids.append(values[mask].astype("<u4"))
    stream = np.concatenate(ids)
    counts = documents.column(1).to_numpy()
    ends = np.cumsum(counts)
    starts = ends - counts
    sums = [zlib.crc32(stream[a:b].tobytes()) for a, b in zip(starts, ends)]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(counts), number)), documents.column(0), pa.array(starts), documents.column(1),
         pa.array(sums, pa.int64())], names=["file", id_name, "first", "n_tokens", "ids_crc32"])


def read_documents(spark: SparkSession, path: str, scratch: Scratch, doc_id: str = "doc_id",
                   id_type: DataType | None = None) -> DataFrame:
    """Per document of the files under ``path``: its id, ``start`` (ids of all documents before it),
    ``n_tokens`` (with the end id) and ``ids_crc32`` of its ids as little-endian unsigned 32-bit integers."""
    schema = StructType([
        StructField("file", LongType()), StructField(doc_id, id_type or LongType()), StructField("first", LongType()),
        StructField("n_tokens", LongType()), StructField("ids_crc32", LongType())])

    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                if len(content.as_py()):
                    yield _documents(content.as_py(), doc_id)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    # A few files at a time cross to Python: a file is as large as a shuffle partition.
    read = scratch.write(files.select("content").mapInArrow(run, schema), "documents-read")
    before, starts = 0, []
    for row in sorted(read.groupBy("file").agg(F.sum("n_tokens").alias("n")).collect()):  # a row per file
        starts.append((row["file"], before))
        before += row["n"]
    table = spark.createDataFrame(starts, "file bigint, before bigint")
    return read.join(F.broadcast(table), "file").select(
        doc_id, (F.col("before") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")

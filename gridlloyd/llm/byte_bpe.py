"""Byte-level BPE encoding and decoding through a sentencepiece model made from the vocabulary."""

from __future__ import annotations

import base64
from array import array
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from sentencepiece import sentencepiece_model_pb2

from .common import map_columns, texts
from .merging import byte_characters
from .words import MEMO_ENTRIES, Matcher, pieces, unknown

_BYTE = {bytes([b]): b for b in range(256)}


def read_ranks(content: bytes) -> list[bytes]:
    """Token bytes in rank order, from lines of base64 bytes and rank."""
    rows = [line.split() for line in content.splitlines() if line]
    ranks = {int(rank): base64.b64decode(token) for token, rank in rows}
    if set(ranks) != set(range(len(ranks))):
        raise ValueError("ranks must be 0, 1, 2, ... without gaps")
    return [ranks[i] for i in range(len(ranks))]


def sentencepiece_model(tokens: list[bytes]) -> bytes:
    """A BPE model whose piece i is the byte-mapped token i with score -i; the unknown piece comes last.

    Merging picks the best score, so the lowest rank, leftmost first; nothing is normalised or added.
    """
    mapped = byte_characters()
    model = sentencepiece_model_pb2.ModelProto()
    for rank, token in enumerate(tokens):
        model.pieces.add(piece="".join(mapped[b] for b in token), score=-float(rank), type=1)
    model.pieces.add(piece="<unk>", score=0.0, type=2)
    trainer = model.trainer_spec
    trainer.model_type = sentencepiece_model_pb2.TrainerSpec.BPE
    trainer.vocab_size = len(model.pieces)
    trainer.unk_id, trainer.bos_id, trainer.eos_id, trainer.pad_id = len(tokens), -1, -1, -1
    normalizer = model.normalizer_spec
    normalizer.name = "identity"
    normalizer.add_dummy_prefix = normalizer.remove_extra_whitespaces = normalizer.escape_whitespaces = False
    return model.SerializeToString()


def _is_class(name: str, char: str) -> bool:
    return bool(_probe(name).encode_ordinary(char))


@lru_cache(maxsize=8)
def _probe(name: str) -> tiktoken.Encoding:
    return tiktoken.Encoding("class", pat_str=name, mergeable_ranks=_BYTE, special_tokens={})


class Codec:
    """Encodes and decodes; remembers the ids of pieces and pre-tokens seen."""

    def __init__(self, content: bytes, pattern: str):
        self.tokens = read_ranks(content)
        self.rank = {t: i for i, t in enumerate(self.tokens)}
        self.model = sentencepiece.SentencePieceProcessor(model_proto=sentencepiece_model(self.tokens))
        self.map = str.maketrans({chr(b): c for b, c in enumerate(byte_characters())})
        self.match = Matcher(pattern, _is_class)
        self.of_piece: dict[str, bytes] = {}
        self.of_token: dict[str, bytes] = {}

    def _learn(self, new: list[str]) -> None:
        if len(self.of_token) > MEMO_ENTRIES:
            self.of_token.clear()
        split = self.match.all(new)
        rest = []
        for token in unknown(split, self.of_token):
            raw = token.encode()
            if raw in self.rank:  # a whole pre-token of the vocabulary is that token
                self.of_token[token] = self.rank[raw].to_bytes(4, "little")
            else:
                rest.append((token, raw.decode("latin-1").translate(self.map)))
        for i in range(0, len(rest), 50_000):
            some = rest[i:i + 50_000]
            for (token, _), ids in zip(some, self.model.encode([m for _, m in some], num_threads=1)):
                self.of_token[token] = array("I", ids).tobytes()
        token = self.of_token.__getitem__
        self.of_piece.update((p, b"".join(map(token, ts))) for p, ts in zip(new, split))

    def encode(self, values: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if len(self.of_piece) > MEMO_ENTRIES:
            self.of_piece.clear()
        cut, known = [pieces(v) for v in values], self.of_piece
        self._learn(unknown(cut, known))
        piece = known.__getitem__
        return [b"".join(map(piece, ps)) for ps in cut]

    def decode(self, ids: bytes | None) -> bytes | None:
        if ids is None:
            return None
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=1)
def _codec(content: bytes, pattern: str) -> Codec:
    return Codec(content, pattern)


def _content(df: DataFrame, ranks: str):
    with open(ranks, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode(df: DataFrame, ranks: str, pattern: str, text: str = "text") -> DataFrame:
    """Append ``token_ids`` (little-endian unsigned 32-bit integers) and ``n_tokens``.

    ``ranks`` is the path of a rank file, read here and sent to the tasks. Every match of ``pattern`` is
    encoded alone, special strings being plain text. One row out per row in, without a shuffle; a null
    or empty text has no ids (an empty array of bytes).
    """
    content = _content(df, ranks)

    def fn(column: pa.Array):
        ids = _codec(content.value, pattern).encode(texts(column))
        return [pa.array(ids, pa.binary()), pa.array([len(i) // 4 for i in ids], pa.int64())]

    return map_columns(df, text, "token_ids binary, n_tokens bigint", fn)


def decode(df: DataFrame, ranks: str, pattern: str, ids: str = "token_ids") -> DataFrame:
    """Append ``decoded``, the bytes behind the ids; null where the ids are null."""
    content = _content(df, ranks)

    def fn(column: pa.Array):
        codec = _codec(content.value, pattern)
        return [pa.array(map(codec.decode, column.to_pylist()), pa.binary())]

    return map_columns(df, ids, "decoded binary", fn)


def round_trip_digests(df: DataFrame, ranks: str, pattern: str, text: str = "text") -> DataFrame:
    """Append ``n_tokens`` and the SHA-256 of the ids and of the bytes decoded from them, ids staying in the task."""
    content = _content(df, ranks)

    def fn(column: pa.Array):
        codec = _codec(content.value, pattern)
        ids = codec.encode(texts(column))
        return [pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array([sha256(i).hexdigest() for i in ids]),
                pa.array([sha256(codec.decode(i)).hexdigest() for i in ids])]

    return map_columns(df, text, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", fn)

"""Token counts of whole texts by rank-synchronous merging."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, pre_tokenizers

from .common import map_columns, texts
from .merging import MergeTable, count_symbols
from .words import MEMO_ENTRIES, Matcher, pieces, unknown


def _is_class(name: str, char: str) -> bool:
    return not pre_tokenizers.Split(Regex(name), "removed").pre_tokenize_str(char)


class Counter:
    """Counts tokens; remembers the count of each piece and pre-token seen."""

    def __init__(self, content: bytes, pattern: str):
        self.table = MergeTable(content)
        self.match = Matcher(pattern, _is_class)
        self.of_piece: dict[str, int] = {}
        self.of_token: dict[str, int] = {}

    def _learn(self, new: list[str]) -> None:
        if len(self.of_token) > MEMO_ENTRIES:
            self.of_token.clear()
        split = self.match.all(new)
        tokens = unknown(split, self.of_token)
        for i in range(0, len(tokens), 50_000):
            some = tokens[i:i + 50_000]
            self.of_token.update(zip(some, count_symbols(self.table, [t.encode() for t in some]).tolist()))
        token = self.of_token.__getitem__
        self.of_piece.update((p, sum(map(token, ts))) for p, ts in zip(new, split))

    def sections(self, text: str) -> tuple[list[str], int]:
        """The pieces between special strings, and the number of these strings, one token each."""
        found, parts = 0, [text]
        for special in self.table.special:
            if any(special in p for p in parts):
                cut = [s for p in parts for s in p.split(special)]
                found += len(cut) - len(parts)
                parts = cut
        return [p for part in parts for p in pieces(part)], found

    def counts(self, values: list[str]) -> list[int]:
        if len(self.of_piece) > MEMO_ENTRIES:
            self.of_piece.clear()
        cut = [self.sections(v) for v in values]
        known = self.of_piece
        self._learn(unknown([ps for ps, _ in cut], known))
        piece = known.__getitem__
        return [sum(map(piece, ps)) + n for ps, n in cut]


@lru_cache(maxsize=1)
def _counter(content: bytes, pattern: str) -> Counter:
    return Counter(content, pattern)


def count_tokens(df: DataFrame, tokenizer: str, pattern: str, text: str = "text", limit: int = 1024) -> DataFrame:
    """Append ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more tokens than ``limit``).

    ``tokenizer`` is the path of a byte-level BPE file in JSON, read here and sent to the tasks;
    ``pattern`` splits texts into pre-tokens. Counts are those of encoding the whole text without added
    tokens, special strings in it being one token each. One row out per row in, in one pass without a
    shuffle; a null or empty text has 0 bytes and 0 tokens, and equal rows get equal counts.
    """
    with open(tokenizer, "rb") as f:
        content = df.sparkSession.sparkContext.broadcast(f.read())

    def fn(column: pa.Array):
        return [pa.array(np.array(_counter(content.value, pattern).counts(texts(column)), "int64"))]

    counted = map_columns(df, text, "n_tokens bigint", fn)
    return counted.select(
        *[c for c in counted.columns if c.lower() not in ("n_bytes", "n_tokens", "over_limit")],
        F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("long").alias("n_bytes"), "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"))

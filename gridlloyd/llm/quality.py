"""Line-first cleaning of documents: rules drop lines, and a document that loses too much is rejected."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_columns, texts

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: What may end a sentence, closing marks included.
SENTENCE_ENDS = ".!?…:;。！？\"'”’»)]}"
#: Phrases of page furniture, matched in lower-cased lines.
NAVIGATION = (
    "back to top", "click here", "log in", "login", "main menu", "next page", "previous page", "read more", "sign in",
    "sign up", "site map", "sitemap", "skip to content", "skip to main content", "subscribe", "view more",
)
BOILERPLATE = (
    "all rights reserved", "cookie policy", "enable javascript", "javascript is disabled", "lorem ipsum",
    "privacy policy", "terms of service", "terms of use", "use of cookies", "we use cookies",
)
#: A line of navigation has few words, or is mostly cut up by separators.
SHORT_LINE = 10
SEPARATOR_PATTERN = r"[ \t\v\f\r][|»>•·/][ \t\v\f\r]"
NAVIGATION_PATTERN = rf"(^|[^a-z0-9])({'|'.join(NAVIGATION)})($|[^a-z0-9])"
BOILERPLATE_PATTERN = "[{}]|" + "|".join(BOILERPLATE)
_SEPARATORS, _NAVIGATION, _BOILERPLATE = map(re.compile, (SEPARATOR_PATTERN, NAVIGATION_PATTERN, BOILERPLATE_PATTERN))
_LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def line_fails(line: str) -> bool:
    """Whether the punctuation, navigation or boilerplate rule removes a line; a blank line stays.

    Punctuation: the line has fewer than ``SHORT_LINE`` words and does not end a sentence. Navigation: a
    line that short has a phrase of ``NAVIGATION``, or any line has two separators or more. Boilerplate:
    the line has a phrase of ``BOILERPLATE`` or a curly bracket.
    """
    words = len(line.encode().split())
    if not words:
        return False
    low = line.translate(_LOWER)
    if _BOILERPLATE.search(low) or len(_SEPARATORS.findall(low)) >= 2:
        return True
    return words < SHORT_LINE and (line.rstrip(SPACES)[-1] not in SENTENCE_ENDS or bool(_NAVIGATION.search(low)))


def _repeated_words(words: list[list[bytes]]) -> np.ndarray:
    """Words of each text in three-word windows that the text has twice or more."""
    lengths = np.fromiter(map(len, words), "int64", len(words))
    flat = pa.array([w for ws in words for w in ws], pa.binary())
    covered = np.zeros(len(flat), bool)
    owner = np.repeat(np.arange(len(words)), lengths)
    if len(flat) >= 3:
        code = flat.dictionary_encode().indices.to_numpy().astype("int64")
        n = int(code.max()) + 1
        pair = np.unique(code[:-1] * n + code[1:], return_inverse=True)[1]
        window = np.unique(pair[:-1] * n + code[2:], return_inverse=True)[1]
        inside = np.flatnonzero(owner[:-2] == owner[2:])
        _, which, count = np.unique(window[inside] * len(words) + owner[inside], return_inverse=True, return_counts=True)
        at = inside[count[which] >= 2]
        for shift in range(3):
            covered[at + shift] = True
    return np.bincount(owner[covered], minlength=len(words))


def _base(text: str, words: list[bytes]) -> tuple[int, int, int, int]:
    spaces = sum(map(text.count, SPACES))
    lines = Counter(line for line in text.split("\n") if line.strip(SPACES))
    return (len(words), len(text) - spaces, sum(map(text.count, SYMBOLS)), sum(lines.values()) - len(lines))


def clean_lines(df: DataFrame, text: str = "text", min_words: int = 50, max_repeated_percent: int = 50,
                max_lost_percent: int = 30) -> DataFrame:
    """Append the measures of each text, the verdict, and ``clean_text``, its lines that passed the rules.

    ``base_failed``: fewer than ``min_words`` words, or over ``max_repeated_percent`` of them in repeated
    three-word windows. ``kept``: not ``base_failed``, and the removed lines hold at most
    ``max_lost_percent`` of the characters in words. One row out per row in and one pass without a shuffle;
    a null or empty text has no words and so fails, and equal rows get equal results.
    """
    def fn(column: pa.Array):
        values = texts(column)
        words = [v.encode().split() for v in values]
        repeated = _repeated_words(words)
        rows = []
        for value, ws, again in zip(values, words, repeated.tolist()):
            n_words, word_chars, n_symbols, n_dup_lines = _base(value, ws)
            lines = value.split("\n")
            failed = [line_fails(line) for line in lines]
            lost = sum(len(line) - sum(map(line.count, SPACES)) for line, f in zip(lines, failed) if f)
            base_failed = n_words < min_words or 100 * again > max_repeated_percent * n_words
            kept = not base_failed and 100 * lost <= max_lost_percent * word_chars
            rows.append((n_words, word_chars, n_symbols, n_dup_lines, again, lost, base_failed, kept,
                         "\n".join(line for line, f in zip(lines, failed) if not f)))
        return [pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64()] * 6 + [pa.bool_()] * 2 + [pa.string()])]

    return map_columns(
        df, text, "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
        "lost_chars bigint, base_failed boolean, kept boolean, clean_text string", fn)

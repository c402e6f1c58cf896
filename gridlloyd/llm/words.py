"""Cutting texts at spaces so that each distinct piece is tokenised once.

The byte-level pattern ('s|'t|... | ?\\p{L}+ | ?\\p{N}+ | ?[^\\s\\p{L}\\p{N}]+ | \\s+(?!\\S) | \\s+) always starts a
new match at a space that a non-space follows, and looks no further back or ahead. So a text may be cut
before every such space, each piece matched alone, and pieces that start so be matched in a row.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import regex

#: Entries a memo may have; beyond it is emptied. It only saves time.
MEMO_ENTRIES = 150_000
_CUT = regex.compile(r"(?= \S)", regex.V1)
_UNEVEN = re.compile(r" (?=\s|\Z)")
#: Characters below this one are classified alike by every library.
_RARE = "\u0500"


def pieces(text: str) -> list[str]:
    """The text cut before each space that a non-space follows."""
    if not text:
        return []
    if _UNEVEN.search(text):
        return [p for p in _CUT.split(text) if p]
    parts = text.replace(" ", "\0 ").split("\0") if "\0" not in text else [p for p in _CUT.split(text) if p]
    return parts if parts[0] else parts[1:]


class Matcher:
    """Matches of a byte-level pattern, with the character classes of the library that is to be equalled.

    ``is_class(name, char)`` tells whether that library counts a character to ``\\p{L}``, ``\\p{N}`` or
    ``\\s``; rare characters are replaced by one of the same class before matching, so the version of
    Unicode behind the pattern does not matter.
    """

    def __init__(self, pattern: str, is_class: Callable[[str, str], bool]):
        self._pattern = regex.compile(pattern)
        self._is_class = is_class
        self._stand_in: dict[str, str] = {}

    def _plain(self, char: str) -> str:
        if char < _RARE:
            return char
        if char not in self._stand_in:
            self._stand_in[char] = next(
                (s for name, s in ((r"\p{L}", "x"), (r"\p{N}", "1"), (r"\s", " ")) if self._is_class(name, char)),
                "§")
        return self._stand_in[char]

    def __call__(self, piece: str) -> list[str]:
        if piece.isascii() or max(piece) < _RARE:
            return self._pattern.findall(piece)
        return [piece[m.start():m.end()] for m in self._pattern.finditer("".join(map(self._plain, piece)))]

    def all(self, cut: list[str]) -> list[list[str]]:
        """The matches of each piece: a space and letters are one match, and other pieces that start at a cut
        and have no rare character go in one call."""
        found: list = [None] * len(cut)
        together = []
        for i, p in enumerate(cut):
            if len(p) > 1 and p[0] == " " and (p.isascii() or max(p) < _RARE):
                if p[1:].isalpha():
                    found[i] = [p]
                elif not p[1].isspace():
                    together.append(i)
        if together:
            tokens = self._pattern.findall("".join([cut[i] for i in together]))
            token_ends = np.cumsum(np.fromiter(map(len, tokens), "int64", len(tokens)))
            piece_ends = np.cumsum(np.fromiter((len(cut[i]) for i in together), "int64", len(together)))
            start = 0
            for i, end in zip(together, (np.searchsorted(token_ends, piece_ends) + 1).tolist()):
                found[i] = tokens[start:end]
                start = end
        return [self(p) if f is None else f for p, f in zip(cut, found)]


def unknown(cut: list[list[str]], known: dict) -> list[str]:
    """The distinct pieces that the memo lacks."""
    seen: set[str] = set()
    for ps in cut:
        seen.update(ps)
    return list(seen - known.keys())

"""Byte-pair merging of many pre-tokens at once, in flat numpy arrays."""

from __future__ import annotations

import json

import numpy as np

_NONE = np.iinfo("int64").max


def byte_characters() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: itself if it is a printable
    Latin-1 character, else the next code point from 256 on."""
    shown = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


class MergeTable:
    """The merges of a byte-level BPE file as sorted arrays of pair, rank and resulting symbol."""

    def __init__(self, content: bytes):
        parsed = json.loads(content)
        model = parsed["model"]
        vocab = model["vocab"]
        self.special = [t["content"] for t in parsed.get("added_tokens", [])]
        self.of_byte = np.array([vocab[c] for c in byte_characters()], "int64")
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], "int64")
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype("int64")
        self.made = np.array([vocab[a + b] for a, b in pairs], "int64")  # by rank

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], _NONE)


def count_symbols(table: MergeTable, values: list[bytes]) -> np.ndarray:
    """How many symbols each non-empty byte string keeps after all merges.

    In every round each sequence finds its lowest-ranked pair and merges all places of it, left to
    right, at the same time as all other sequences; a sequence without a pair leaves.
    """
    counts = np.zeros(len(values), "int64")
    lengths = np.fromiter(map(len, values), "int64", len(values))
    who = np.flatnonzero(lengths)
    lengths = lengths[who]
    symbols = table.of_byte[np.frombuffer(b"".join(values), "uint8")]
    if not len(symbols):
        return counts
    ranks = np.full(len(symbols), _NONE)
    ranks[:-1] = table.rank(symbols[:-1], symbols[1:])
    ranks[np.cumsum(lengths) - 1] = _NONE
    while len(who):
        starts = np.cumsum(lengths) - lengths
        lowest = np.minimum.reduceat(ranks, starts)
        going = lowest < _NONE
        if not going.all():
            counts[who[~going]] = lengths[~going]
            stay = np.repeat(going, lengths)
            symbols, ranks = symbols[stay], ranks[stay]
            who, lengths, lowest = who[going], lengths[going], lowest[going]
            if not len(who):
                break
        at = np.flatnonzero(ranks == np.repeat(lowest, lengths))
        if len(at) > 1:  # equal neighbours overlap: take every second place of a run
            first = np.concatenate([[True], np.diff(at) != 1])
            run_start = np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - run_start) % 2 == 0]
        symbols[at] = table.made[ranks[at]]
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        ends = np.cumsum(lengths)
        lengths = lengths - np.diff(np.searchsorted(at, np.concatenate([[0], ends])))
        at = at - np.arange(len(at))
        symbols, ranks = symbols[keep], ranks[keep]
        last = np.zeros(len(symbols), bool)
        last[np.cumsum(lengths) - 1] = True
        for place in (at, at[at > 0] - 1):
            inner = place[~last[place]]
            ranks[inner] = table.rank(symbols[inner], symbols[inner + 1])
            ranks[place[last[place]]] = _NONE
    return counts

"""The encoder of token files: parts of texts, and a memo that keeps what comes again."""

import random
from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from gridlloyd.llm import token_files

WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def content():
    with open(WORDS, "rb") as f:
        return f.read()


def _ids(made):
    return [list(memoryview(m).cast("H")) for m in made]


def test_parts_give_the_ids_of_whole_texts(content, monkeypatch):
    monkeypatch.setattr(token_files, "MEMO_ENTRIES", 40)
    rng, library = random.Random(3), Tokenizer.from_str(content.decode())
    bits = ["word", "Été", "ß", "ÿ", "µ", "don't", "I'LL", "'", "<", "<|endoftext|>", "x1y22", "--", "&&", "½", "\xa0", "\x85", "\x1c",
            "\x00", "日本", "é", "Œuf", "ID:9", "²", "\x7f", "a.b,c"]
    texts = ["".join(rng.choice(bits) + rng.choice(["", "", " ", "  ", "\n", "\t", "\r\n", "\x0b", "\x0c"]) for _ in range(40))
             for _ in range(200)] + ["", " ", "plain words only", "\n'"]
    encoder, got = token_files.Encoder(content, "<u2"), []
    for i in range(0, len(texts), 10):
        got += _ids(encoder.encode(texts[i:i + 10]))
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]


class _Counting:
    """The library's tokenizer, which counts what its model is asked for."""

    def __init__(self, real):
        self.real, self.model, self.asked = real, self, Counter()

    def tokenize(self, part):
        self.asked[part] += 1
        return self.real.model.tokenize(part)

    def encode(self, *a, **k):
        return self.real.encode(*a, **k)


def test_parts_that_come_again_are_asked_for_once(content, monkeypatch):
    monkeypatch.setattr(token_files, "MEMO_ENTRIES", 50)
    encoder = token_files.Encoder(content, "<u2")
    encoder.tokenizer = counting = _Counting(encoder.tokenizer)
    letters = "abcdefghijklmnopqrst"
    for i in range(20):
        rare = " ".join(f"rare{letters[i]}{a}{b}" for a in letters[:6] for b in letters[:6])
        encoder.encode([f"common, words (common words) {rare}"])
    assert counting.asked["common"] == counting.asked["words"] == 1
    assert len(encoder.young) + len(encoder.old) < 300

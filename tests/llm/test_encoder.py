"""The encoder of the token shards: ids, and what a new word costs."""

import random
import re

import pytest

from ingot.llm import tokens

public_tokenizers = pytest.importorskip("public_tokenizers")
WHOLE = re.compile(r"(?:[^\w\s]|[_\x1c-\x1f])[.,](?:[ \n])|<\|")


def test_new_words_of_plain_letters_are_not_split(monkeypatch):
    class Splits:
        seen = []

        def findall(self, w):
            self.seen.append(w)
            return tokens_pieces.findall(w)

    tokens_pieces = tokens.PIECES
    monkeypatch.setattr(tokens, "PIECES", Splits())
    encode = tokens.Encoder(str(public_tokenizers.path("word_bpe_49k.json")), 2)
    text = "Plain words, plain words. Don't a1 été"
    assert encode(text) == encode.plain([text])[0]
    assert sorted(Splits.seen) == sorted([",", ".", "don't", "a1", "été"])


def test_ids_and_ways_of_random_texts():
    encode, rng = tokens.Encoder(str(public_tokenizers.path("word_bpe_49k.json")), 2), random.Random(3)
    for _ in range(300):
        text = "".join(rng.choice(["a", "B", "is", "7", " ", " ", "\n", ".", ",", ". ", ", ", "!", "_", "-", "'s", "<", "|", "ü", "ł", "\x1c"]) for _ in range(rng.randrange(25)))
        assert encode(text) == encode.plain([text])[0], repr(text)
        assert bool("<|" in text or tokens.UNCLEAR.search(text)) == bool(WHOLE.search(text)), repr(text)

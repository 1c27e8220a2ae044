"""Word hashes: words that cancel in polynomial hashes stay apart."""

import numpy as np
import pytest

from ingot.llm import common, neardup
from ingot.llm.common import Lanes, words


def morse(n):
    s = "a"
    while len(s) < n:
        s += s.translate(str.maketrans("ab", "ba"))
    return s, s.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("n", [1024, 2048])
def test_thue_morse_words(spark, n):
    a, b = morse(n)
    data = np.frombuffer(f"{a} {b} {a}".encode(), np.uint8)
    h = words(data, np.array([0, len(data)]), "alnum")[0]
    assert h[0] == h[2] != h[1]
    docs = spark.createDataFrame([(1, a), (2, b), (3, a), (4, f"{a} {b} x y z"), (5, f"{b} {a} x y z")], "doc_id long, text string")
    assert {(r.doc_id, r.component_id) for r in neardup.near_duplicates(docs).collect()} == {(1, 1), (2, 2), (3, 1), (4, 4), (5, 5)}


def test_pieces_do_not_change_hashes(monkeypatch):
    rnd = np.random.default_rng(1)
    text = b" ".join(bytes(rnd.integers(97, 123, int(k)).astype(np.uint8)) for k in rnd.choice([1, 7, 8, 9, 16, 17, 40, 900], 500))
    data = np.frombuffer(text, np.uint8)
    one = words(data, np.array([0, len(data)]), "alnum")
    monkeypatch.setattr(common, "PIECE", 64)
    other = words(data, np.array([0, len(data)]), "alnum")
    assert all((x == y).all() for x, y in zip(one, other)) and len(np.unique(one[0])) == len({text[a:b] for a, b in zip(one[1], one[2])})


def test_lanes():
    data = np.frombuffer(b"abcdefghijk", np.uint8)
    assert Lanes(data).read(np.array([0, 3, 9, 10]), np.array([3, 11, 11, 11])).tobytes() == b"abc\0\0\0\0\0defghijkjk\0\0\0\0\0\0k" + b"\0" * 7

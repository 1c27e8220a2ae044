"""Token counts by dynamic programming over a trie of pre-tokens.

A pre-token is a word (``[^\\x20\\x09-\\x0D]+``) with the word mark in front.  Its best
segmentation under a unigram model is the path of highest total log-probability over the
vocabulary's pieces; ties go to fewer tokens.  Distinct pre-tokens are inserted in a trie whose
nodes hold the forward score of their prefix, so that a shared prefix is scored once; the
count at a word's last node is kept as its terminal count.  Documents then sum the counts of
their words.  The pass is map-only: each worker keeps its own trie, emptied when it outgrows
``MAX_NODES``, and the terminal counts of up to twice ``MAX_WORDS`` words.

The vocabulary is a public tokenizer's and is not trained: pieces get Zipf-Mandelbrot
probabilities by their rank.  A character that no piece covers costs one token per UTF-8 byte.

Defined cases: null and empty texts have no tokens; pre-tokens longer than ``MAX_STORED``
characters are scored by the same recurrence without being stored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ingot.llm.common import worker_cache

MARK = "▁"
WORD = re.compile("[^\x20\x09-\x0d]+")
MAX_NODES, MAX_WORDS, MAX_STORED = 300_000, 400_000, 64


def piece_scores(model: str) -> dict[str, float]:
    """Log-probabilities of the ordinary pieces of a sentencepiece vocabulary, by rank."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    pieces = [sp.IdToPiece(i) for i in range(sp.GetPieceSize()) if not (sp.IsControl(i) or sp.IsUnknown(i) or sp.IsByte(i) or sp.IsUnused(i))]
    weight = 1 / (np.arange(len(pieces)) + 2.7)
    return dict(zip(pieces, np.log(weight / weight.sum()).tolist()))


class Trie:
    """Forward scores by prefix.  A node is a number; ``child`` has its next nodes by character,
    ``score`` and ``tokens`` the best segmentation of its prefix.  The terminal counts of the words
    met so far are kept in two generations, so that frequent words stay when a full one goes."""

    def __init__(self, scores: dict[str, float]):
        self.scores, self.longest = scores, max(map(len, scores), default=1)
        self.byte = min(scores.values(), default=0.0) - 10.0
        self.counts, self.old = {}, {}
        self.clear()

    def clear(self) -> None:
        self.child, self.score, self.tokens = [None], [0.0], [0]

    def step(self, text: str, j: int, score: list, tokens: list) -> tuple[float, int]:
        """The best (score, tokens) of text[:j], given those of its shorter prefixes."""
        n = len(text[j - 1].encode("utf-8", "surrogatepass"))
        best, least, get = score[j - 1] + n * self.byte, tokens[j - 1] + n, self.scores.get
        for i in range(max(0, j - self.longest), j):
            s = get(text[i:j])
            if s is not None:
                x, k = score[i] + s, tokens[i] + 1
                if x > best + 1e-9 or x > best - 1e-9 and k < least:
                    best, least = x, k
        return best, least

    def insert(self, word: str) -> int:
        """The tokens of a word; its new prefixes become nodes."""
        if len(self.score) > MAX_NODES:
            self.clear()
        text, node, last, score, tokens = MARK + word, 0, 0, [0.0], [0]
        child, scores, counts = self.child, self.score, self.tokens
        for j, c in enumerate(text, 1):
            kids = child[node]
            node = kids.get(c) if kids is not None else None
            if node is None:
                s, k = self.step(text, j, score, tokens)
                node = len(scores)
                scores.append(s)
                counts.append(k)
                child.append(None)
                if kids is None:
                    child[last] = {c: node}
                else:
                    kids[c] = node
            else:
                s, k = scores[node], counts[node]
            score.append(s)
            tokens.append(k)
            last = node
        return tokens[-1]

    def alone(self, word: str) -> int:
        """The same without nodes, for a word too long to keep."""
        text, score, tokens = MARK + word, [0.0], [0]
        for j in range(1, len(text) + 1):
            s, k = self.step(text, j, score, tokens)
            score.append(s)
            tokens.append(k)
        return tokens[-1]

    def count(self, word: str) -> int:
        k = self.counts.get(word)
        if k is None:
            if len(word) > MAX_STORED:
                return self.alone(word)
            k = self.old.get(word)
            if k is None:
                k = self.insert(word)
            if len(self.counts) >= MAX_WORDS:
                self.counts, self.old = {}, self.counts
            self.counts[word] = k
        return k

    def total(self, words: list[str]) -> int:
        try:
            return sum(map(self.counts.__getitem__, words))
        except KeyError:
            return sum(map(self.count, words))


def trie(model: str) -> Trie:
    cache = worker_cache()
    if ("trie", model) not in cache:
        cache["trie", model] = Trie(piece_scores(model))
    return cache["trie", model]


def token_counts(docs: DataFrame, model: str | None = None, text_col: str = "text", doc_col: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, n_words, n_tokens."""
    if model is None:
        import public_tokenizers

        model = str(public_tokenizers.path("piece_bpe_32k.model"))
    small = docs.select(F.col(doc_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches):
        t = trie(model)
        for batch in batches:
            n_words, n_tokens = [], []
            for text in batch.column(1):
                words = WORD.findall(text.as_py() or "")
                n_words.append(len(words))
                n_tokens.append(t.total(words))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_tokens, pa.int64())], names=["doc_id", "n_words", "n_tokens"])

    return small.mapInArrow(run, f"doc_id {small.schema['doc_id'].dataType.simpleString()}, n_words long, n_tokens long")

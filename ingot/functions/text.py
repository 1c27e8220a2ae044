"""Inverted text index <-> text (R18 and its inverse), built in-row.

Both directions are JVM expressions over one record: no shuffle, no Python.
Tokens are split on a single space, so ``reconstruct(index(t)) == t``.

The helpers are DataFrame-level on purpose: each intermediate array (the
sorted tokens, the run starts) is projected as its own column before a lambda
indexes into it.  Inside a higher-order function an array *expression* is
re-evaluated on every element access, which would make the work quadratic per
record; an attribute reference is evaluated once.  For the same reason, explode
the result with ``inline_outer``/``explode_outer`` and filter the generated
columns: ``inline``/``explode`` make the optimizer infer ``size(x) > 0`` and push
it below these projections, re-inlining the array expression.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


INDEX_TYPE = "map<string,array<int>>"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _tmp(tag: str) -> str:
    return f"__{tag}_{uuid.uuid4().hex[:8]}"


def with_index_entries(df: DataFrame, text, out: str = "entries") -> DataFrame:
    """Add ``out``: ``array<struct<word, positions>>``, one entry per distinct token,
    sorted by token.  The (token, position) pairs are sorted once and cut at
    every token change: O(n log n) per record."""
    pairs, starts = _tmp("pairs"), _tmp("starts")
    words = F.split(_c(text), " ", -1)
    d = df.withColumn(pairs, F.when(_c(text).isNull(), F.lit(None)).otherwise(
        F.sort_array(F.transform(words, lambda w, i: F.struct(w.alias("w"), i.alias("p"))))))
    P = F.col(pairs)
    n = F.size(P)
    d = d.withColumn(starts, F.filter(F.sequence(F.lit(0), n - 1),
                                      lambda i: (i == 0) | (F.get(P, i).getField("w") != F.get(P, i - 1).getField("w"))))
    S = F.col(starts)

    def entry(s, j):
        end = F.coalesce(F.get(S, j + 1), n)
        return F.struct(F.get(P, s).getField("w").alias("word"),
                        F.transform(F.slice(P, s + 1, end - s), lambda x: x.getField("p")).alias("positions"))

    return d.withColumn(out, F.when(P.isNull(), F.lit(None)).otherwise(F.transform(S, entry))).drop(pairs, starts)


def with_inverted_index(df: DataFrame, text, out: str = "inverted_index") -> DataFrame:
    """Add ``out``: ``map<word, array<position>>`` of a text (inverse helper of R18)."""
    e = _tmp("entries")
    d = with_index_entries(df, text, e)
    E = F.col(e)
    return d.withColumn(out, F.map_from_arrays(F.transform(E, lambda x: x.getField("word")),
                                               F.transform(E, lambda x: x.getField("positions")))).drop(e)


def with_reconstructed_text(df: DataFrame, index, out: str = "text", is_json: bool = True,
                            length: Column | None = None) -> DataFrame:
    """Add ``out``: text rebuilt from an inverted index.

    ``index`` is JSON text of the bare map or of the ``{"IndexLength": n,
    "InvertedIndex": {...}}`` wrapper (``is_json``), or a ``map<string,array<int>>``
    column.  Each word is placed at each of its positions; a missing position is
    an empty word, so a gap shows as two spaces; if two words claim a position
    the later key wins.  A NULL or empty index gives NULL.
    """
    m, ln, srt, kept = _tmp("map"), _tmp("len"), _tmp("sorted"), _tmp("kept")
    idx = _c(index)
    if is_json:
        # The wrapper has "InvertedIndex" with an object value; in a bare map that
        # word can only hold an array.  A regex scan picks the form, so each index
        # is parsed exactly once, with the right schema.
        w = _tmp("wrap")
        wrapped = idx.rlike(r'"InvertedIndex"\s*:\s*\{')
        d = df.withColumn(w, F.when(wrapped, F.from_json(idx, f"IndexLength int, InvertedIndex {INDEX_TYPE}")))
        W = F.col(w)
        d = (d.withColumn(m, F.when(W.isNotNull(), W.getField("InvertedIndex")).otherwise(F.from_json(idx, INDEX_TYPE)))
             .withColumn(ln, F.when(W.isNotNull(), W.getField("IndexLength"))
                         .otherwise(length if length is not None else F.lit(None).cast("int")))
             .drop(w))
    else:
        d = df.withColumn(m, idx).withColumn(ln, length if length is not None else F.lit(None).cast("int"))
    M = F.col(m)
    # Each (position, key index) is one long: position in the high bits, key index in
    # the low 31.  Sorting a primitive array orders by position, then by key order,
    # so "the later key wins" is "keep the last code of each position"; the word is
    # looked up by index in the projected key array.
    keys = _tmp("keys")
    d = d.withColumn(keys, F.map_keys(M))
    codes = F.flatten(F.transform(F.map_values(M), lambda v, k: F.transform(
        v, lambda p: F.shiftleft(p.cast("long"), 31) + k.cast("long"))))
    d = d.withColumn(srt, F.sort_array(codes))
    O = F.col(srt)
    last_i = F.size(O) - 1

    def pos(x):
        return F.shiftright(x, 31)

    d = d.withColumn(kept, F.filter(O, lambda x, i: (i == last_i) | (pos(F.get(O, i + 1)) != pos(x))))
    K, KEYS = F.col(kept), F.col(keys)
    pieces = F.transform(K, lambda x, i: F.concat(
        F.repeat(F.lit(" "), (pos(x) - F.when(i == 0, F.lit(-1)).otherwise(pos(F.get(K, i - 1))) - 1).cast("int")),
        F.get(KEYS, (x - F.shiftleft(pos(x), 31)).cast("int"))))
    last_pos = pos(F.get(K, F.size(K) - 1))
    tail = F.repeat(F.lit(" "), F.greatest(F.coalesce(F.col(ln).cast("long"), last_pos + 1) - last_pos - 1,
                                           F.lit(0).cast("long")).cast("int"))
    text = F.when(M.isNull() | (F.size(M) == 0), F.lit(None).cast("string")).otherwise(
        F.concat(F.array_join(pieces, " "), tail))
    return d.withColumn(out, text).drop(m, ln, srt, kept, keys)

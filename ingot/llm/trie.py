"""Prefix trie of conversations, by whole-sequence collapse.

``rebuilt`` gives every conversation's turns after its opening is replaced by that of its family's
first conversation.  ``collapsed`` groups identical rebuilt conversations into weighted sequences,
each represented by its smallest conversation; the list of those that end there is ``ends``.
Sequences that are proper prefixes of another go by an anti join, the rest are the leaves.
``prefix_trie`` aggregates the weighted prefixes of the sequences into nodes.

A node is known by its depth and two 64-bit sums (xor) of hashes of place and turn.  Sums are taken
per part of a conversation and offset by the parts before, so no task needs a whole conversation: rows are
dealt by ranges of (conversation, turn).  The saving below a node needs no walk down the trie.
A sequence *owns* the nodes whose smallest member is its own smallest; these are its last ones, from
some depth on, and each node has one owner.  With S the words up to a depth, weight w and T all
words of a sequence, the sum over a subtree of (n_convs - 1) * words is the sum over the
sequences through its top, at depth d, of w * (T - S(d - 1)) less the owned words from d on.

Defined cases: rows without a conv_id belong to no conversation; null roles and texts are empty; a null
turn comes first, rows of one turn in the order of their hashes, repeated rows each count; a
conversation whose rebuilt sequence is empty ends at the root; an empty table has no nodes, not
even the root.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ingot.llm.common import in_order, salted, salted_totals, written

NODE = ["depth", "x1", "x2"]


def long(c):
    return F.col(c).cast("long") if isinstance(c, str) else c.cast("long")


def turns(conversations: DataFrame) -> DataFrame:
    """The turns in order: conv_id, pos (from 1), part, c1 and c2 (hashes of role and text), words.  Written."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        long("conv_id").alias("conv_id"), "turn", F.xxhash64(role, text).alias("c1"), F.xxhash64(F.lit("turn"), text, role).alias("c2"),
        long(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+"))).alias("words"))
    rows = in_order(rows.withColumn("tie", F.monotonically_increasing_id()), ["conv_id", "turn", "c1", "c2", "tie"], "trie-turns").drop("turn", "tie")
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("part", "conv_id").agg(F.count("*").alias("n")).select("part", "conv_id", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    local = rows.withColumn("pos", long(F.row_number().over(Window.partitionBy("part", "conv_id").orderBy("nth"))))
    return written(local.join(sizes.hint("merge"), ["part", "conv_id"]).select("conv_id", (F.col("pos") + F.col("before")).alias("pos"), "part", "c1", "c2", "words"), "trie-turns")


def rebuilt(conversations: DataFrame, family: int = 20, openings: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first h = crc32(decimal conv_id) mod ``openings`` turns are those of the first
    conversation of their family (conv_id less its remainder by ``family``; fewer if it has fewer, none if
    it is absent): all conv_ids, and the turns (columns of ``turns``; replaced ones are of part -1)."""
    rows = turns(conversations)
    convs = rows.groupBy("conv_id").agg(F.max("pos").alias("n")).select(
        "conv_id", (F.col("conv_id") - F.col("conv_id") % family).alias("base"), long(F.crc32(F.col("conv_id").cast("string").cast("binary")) % openings).alias("h"), "n")
    bases = convs.where("base = conv_id").select("base", F.col("n").alias("base_n"))
    convs = written(convs.join(bases, "base", "left").withColumn("opening", F.least("h", F.coalesce("base_n", F.lit(0)))), "trie-convs")
    heads = rows.where((F.col("conv_id") % family == 0) & (F.col("pos") < openings)).select(F.col("conv_id").alias("base"), "pos", "c1", "c2", "words")
    first = convs.select("conv_id", "base", "opening").join(heads, "base").where("pos <= opening").select("conv_id", "pos", F.lit(-1).alias("part"), "c1", "c2", "words")
    parts = rows.groupBy("part", "conv_id").agg(F.lit(1)).select("part", "conv_id").join(convs, "conv_id").select("part", "conv_id", "h", "opening")
    rest = rows.join(parts.hint("merge"), ["part", "conv_id"]).where("pos > h").select("conv_id", (F.col("pos") - F.col("h") + F.col("opening")).alias("pos"), "part", "c1", "c2", "words")
    return convs.select("conv_id"), written(first.unionByName(rest), "trie-rebuilt")


def collapsed(convs: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Whole sequences: a row per conversation (conv_id and its sequence, ``NODE``), and the weighted prefixes of
    the distinct sequences, root included: seq (its smallest conversation), length, weight, total (words),
    depth, x1, x2, p1, p2 (the parent's sums), words, upto (words to here), part.  Both written."""
    e1, e2 = F.xxhash64("c1", "pos", "c2"), F.xxhash64(F.lit("node"), "pos", "c2", "c1")
    rows = rows.select("part", "conv_id", "pos", e1.alias("e1"), e2.alias("e2"), "words")
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy("part", "conv_id").agg(F.count("*").alias("n"), F.bit_xor("e1").alias("e1"), F.bit_xor("e2").alias("e2"), F.sum("words").alias("words"))
    zero = F.lit(0).cast("long")
    parts = written(parts.select("*", *[F.coalesce(f(c).over(before), zero).alias(f"{c}_before") for c, f in (("e1", F.bit_xor), ("e2", F.bit_xor), ("words", F.sum))]), "trie-parts")
    whole = parts.groupBy("conv_id").agg(F.sum("n").alias("depth"), F.bit_xor("e1").alias("x1"), F.bit_xor("e2").alias("x2"), F.sum("words").alias("total"))
    whole = written(convs.join(whole, "conv_id", "left").select("conv_id", *[F.coalesce(c, zero).alias(c) for c in (*NODE, "total")]), "trie-whole")
    seqs = written(whole.groupBy(*NODE).agg(F.min("conv_id").alias("seq"), F.count("*").alias("weight"), F.max("total").alias("total")), "trie-sequences")
    own = parts.join(seqs.select(F.col("seq").alias("conv_id"), F.col("depth").alias("length"), "weight", "total"), "conv_id").drop("n", "e1", "e2", "words")
    w = Window.partitionBy("part", "conv_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.join(own.hint("merge"), ["part", "conv_id"]).withColumns({f"{c}_here": f(c).over(w) for c, f in (("e1", F.bit_xor), ("e2", F.bit_xor), ("words", F.sum))})
    x1, x2 = (F.col(f"{c}_here").bitwiseXOR(F.col(f"{c}_before")) for c in ("e1", "e2"))
    prefixes = rows.select(F.col("conv_id").alias("seq"), "length", "weight", "total", F.col("pos").alias("depth"), x1.alias("x1"), x2.alias("x2"), x1.bitwiseXOR(F.col("e1")).alias("p1"), x2.bitwiseXOR(F.col("e2")).alias("p2"),
                           "words", (F.col("words_here") + F.col("words_before")).alias("upto"), "part")
    root = seqs.select("seq", F.col("depth").alias("length"), "weight", "total", *[zero.alias(c) for c in (*NODE, "p1", "p2", "words", "upto")], F.lit(-2).alias("part"))
    return whole.drop("total"), written(prefixes.unionByName(root), "trie-prefixes")


def prefix_trie(prefixes: DataFrame) -> DataFrame:
    """The nodes of ``collapsed`` prefixes: ``NODE``, conv_id, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens.  Written."""
    whole = prefixes.where("depth = length").select(*NODE, "seq")
    leaves = whole.join(prefixes.where("depth < length").select(*NODE).distinct(), NODE, "left_anti").select("seq", F.lit(1).cast("long").alias("leaf"))
    rows = prefixes.withColumn("salt", salted("seq"))
    owner = salted_totals(rows, NODE, [F.min("seq").alias("conv_id")], [F.min("conv_id").alias("conv_id")])
    rows = written(rows.join(owner.hint("merge"), [*NODE, "salt"]).withColumn("own", F.col("conv_id") == F.col("seq")), "trie-owned")
    # by sequence and part, so that a long sequence is spread
    seqs = rows.groupBy("part", "seq").agg(F.sum(F.when(F.col("own"), F.col("words")).otherwise(0)).alias("owned"))
    seqs = seqs.join(seqs.groupBy("seq").agg(F.sum("owned").alias("all_owned")).join(leaves, "seq", "left"), "seq").select("part", "seq", "all_owned", F.coalesce("leaf", F.lit(0).cast("long")).alias("leaf"))
    below = F.col("total") - F.col("upto") + F.col("words")
    saved = F.col("weight") * below - F.when(F.col("own"), below).otherwise(F.col("all_owned"))
    nodes = written(rows.join(seqs.hint("merge"), ["part", "seq"]).groupBy(*NODE).agg(
        F.min("seq").alias("conv_id"), F.max("p1").alias("p1"), F.max("p2").alias("p2"), F.sum("weight").alias("n_convs"), F.sum("leaf").alias("n_leaves"), F.sum(saved).alias("saved_tokens")), "trie-nodes")
    children = nodes.where("depth > 0").select((F.col("depth") - 1).alias("depth"), F.col("p1").alias("x1"), F.col("p2").alias("x2"), F.col("conv_id").alias("child"),
                                               F.struct(*NODE).alias("node"), salted("conv_id").alias("salt"))
    kids = salted_totals(children, NODE, [F.count("*").alias("n")], [F.sum("n").alias("n_children")])
    parents = kids.join(nodes.select(*NODE, "conv_id"), NODE).select(*NODE, "salt", F.col("conv_id").alias("parent_conv_id"))
    of = children.join(parents.hint("merge"), [*NODE, "salt"]).select(F.col("node.depth").alias("depth"), F.col("node.x1").alias("x1"), F.col("node.x2").alias("x2"), "parent_conv_id")
    counts = kids.select(*NODE, "n_children").distinct()
    return nodes.join(of, NODE, "left").join(counts, NODE, "left").select(
        *NODE, "conv_id", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"), "n_leaves", "saved_tokens")


def ends(whole: DataFrame) -> DataFrame:
    """The end lists, a row per conversation: ``NODE`` and conv_id, dealt by node and ascending within."""
    return whole.select(*NODE, "conv_id").repartition(*NODE).sortWithinPartitions(*NODE, "conv_id")


def end_digests(whole: DataFrame) -> DataFrame:
    """SHA-256 of each end list (decimal conv_ids, comma-joined).  The lists are streamed, never held."""
    def run(batches):
        last, digest = None, None
        out = []
        for batch in batches:
            for node, conv in zip(zip(*(batch.column(k).to_pylist() for k in range(3))), batch.column(3).to_pylist()):
                if node != last:
                    if last is not None:
                        out.append((*last, digest.hexdigest()))
                    last, digest = node, hashlib.sha256(str(conv).encode())
                else:
                    digest.update(f",{conv}".encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=[*NODE, "ends_sha256"])
                out = []
        if last is not None:
            yield pa.RecordBatch.from_arrays([pa.array([c]) for c in (*last, digest.hexdigest())], names=[*NODE, "ends_sha256"])

    return ends(whole).mapInArrow(run, "depth long, x1 long, x2 long, ends_sha256 string")


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    whole, prefixes = collapsed(*rebuilt(conversations))
    return prefix_trie(prefixes).join(end_digests(whole), NODE, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))

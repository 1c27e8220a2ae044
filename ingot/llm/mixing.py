"""Mixing sources to target weights by entropy balancing.

Every word is a unit of base rate 1 and a document's words share its rate.  The rates that
meet the token constraints at the least relative entropy are exponential tilts,
``exp(sum of the document's constraint multipliers)``; the multipliers maximise the convex dual
``sum(lambda * target) - sum(size * exp(sum lambda))``.  Each Newton iteration takes its
gradient and Hessian from one Spark aggregate over the cells (combinations of constraint
values) of the corpus; the driver holds only the constraint vector.  With the source as the
only constraint the Hessian is diagonal; several columns give the general case.

Rates become whole copies by error diffusion: within blocks of a source, from its largest
document to its smallest, each document takes the copies nearest to its rate's words plus what
the documents before it left over.  A block's error ends near the size of its smallest
documents, and blocks make a source of any size as many tasks as it needs.

Defined cases: a null text has size 0; a null source is one source, last in order; repeated
rows are mixed each for itself; ties in size go by doc_id; an empty table or one without words
has targets of 0.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ingot.llm.common import fresh, written

WORD = r"[^\x20\x09-\x0D]+"
MAX_CONSTRAINTS = 1_000_000  # values of one column; 4000 together for several columns


def size_of(text_col: str):
    return F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD)).cast("long")


def shares(sizes: list[tuple[str | None, int]], weights: tuple[int, ...] = (5, 2, 1), cap: int = 3) -> dict[str | None, float]:
    """Targets by source: all words, shared by the weights that the sources get in turn (by code
    point, null last); a target stops at ``cap`` times its source and its excess is reshared."""
    order = sorted(sizes, key=lambda s: (s[0] is None, s[0] or ""))
    w = [weights[i % len(weights)] for i in range(len(order))]
    total, full = sum(n for _, n in order), [False] * len(order)
    while True:
        free = sum(x for x, f in zip(w, full) if not f)
        level = (total - sum(cap * n for (_, n), f in zip(order, full) if f)) / free if free else 0.0
        over = [not f and x * level > cap * n for (_, n), x, f in zip(order, w, full)]
        if not any(over):
            return {s: float(cap * n) if f else x * level for (s, n), x, f in zip(order, w, full)}
        full = [f or o for f, o in zip(full, over)]


def newton(cells: DataFrame, margins: dict[str, dict], tolerance: float = 1e-10, steps: int = 60) -> dict[str, dict]:
    """Multipliers by column and value.  ``cells``: one row for each combination of the columns
    in ``margins``, with its ``size``; ``margins``: column -> value -> target (> 0)."""
    spark, cols = cells.sparkSession, list(margins)
    values = {c: [v for v, t in margins[c].items() if t > 0] for c in cols}
    if len(cols) > 1 and sum(map(len, values.values())) > 4000 or any(len(v) > MAX_CONSTRAINTS for v in values.values()):
        raise ValueError("too many constraints for the driver's dual vector")
    lam = {c: dict.fromkeys(values[c], 0.0) for c in cols}

    def tilted(at):
        x = cells
        for c in cols:
            rows = [(v, float(at[c][v])) for v in values[c]]
            t = spark.createDataFrame(rows, f"v {cells.schema[c].dataType.simpleString()}, l_{c} double")
            x = x.join(t, x[c].eqNullSafe(t["v"])).drop("v")
        return x.withColumn("mass", F.col("size") * F.exp(sum((F.col(f"l_{c}") for c in cols), F.lit(0.0))))

    def dual(mass, at):
        return sum(margins[c][v] * at[c][v] for c in cols for v in values[c]) - mass

    step, best = None, -math.inf
    for _ in range(steps):
        x = tilted(lam)
        sums = {c: {r[0]: r[1] for r in x.groupBy(c).agg(F.sum("mass")).collect()} for c in cols}
        mass = sum(sums[cols[0]].values())
        now = dual(mass, lam)
        if step is not None and now < best - 1e-9 * max(1.0, abs(best)):  # too far: half the step
            step = {c: {v: d / 2 for v, d in s.items()} for c, s in step.items()}
            lam = {c: {v: lam[c][v] - step[c][v] for v in values[c]} for c in cols}
            continue
        best = now
        gap = max((abs(margins[c][v] - sums[c].get(v, 0.0)) / margins[c][v] for c in cols for v in values[c]), default=0.0)
        if gap < tolerance:
            break
        if len(cols) == 1:
            c = cols[0]
            step = {c: {v: (margins[c][v] - sums[c][v]) / sums[c][v] for v in values[c]}}
        else:
            place = {(c, v): i for i, (c, v) in enumerate((c, v) for c in cols for v in values[c])}
            h, g = np.zeros((len(place), len(place))), np.zeros(len(place))
            for c in cols:
                for v in values[c]:
                    g[place[c, v]] = margins[c][v] - sums[c].get(v, 0.0)
                    h[place[c, v], place[c, v]] = sums[c].get(v, 0.0)
            for i, c in enumerate(cols):
                for d in cols[i + 1:]:
                    for r in x.groupBy(c, d).agg(F.sum("mass")).collect():
                        h[place[c, r[0]], place[d, r[1]]] = h[place[d, r[1]], place[c, r[0]]] = r[2]
            s = np.linalg.lstsq(h, g, rcond=1e-12)[0]  # the columns' sums agree, so the system is short of rank
            step = {c: {v: float(s[place[c, v]]) for v in values[c]} for c in cols}
        lam = {c: {v: lam[c][v] + step[c][v] for v in values[c]} for c in cols}
    return lam


def with_rates(df: DataFrame, lam: dict[str, dict], into: str) -> DataFrame:
    """``df`` with the tilted rate of each row; 0 for values without a multiplier."""
    out, added = df, []
    for c, by in lam.items():
        v, m = fresh(out, "_value"), fresh(out, "_multiplier")
        t = df.sparkSession.createDataFrame(list(by.items()), f"{v} {df.schema[c].dataType.simpleString()}, {m} double")
        out = out.join(t, out[c].eqNullSafe(t[v]), "left").drop(v)
        added.append(m)
    return out.withColumn(into, F.coalesce(F.exp(sum((F.col(m) for m in added), F.lit(0.0))), F.lit(0.0))).drop(*added)


def rounded(df: DataFrame, group: str, size: str, rate: str, doc_col: str, into: str, cap: int, block_rows: int) -> DataFrame:
    """``df`` with whole ``copies`` for its rates, by error diffusion within blocks of a group."""
    block, parts, own = (fresh(df, c) for c in ("_block", "_parts", "_group"))
    counts = df.groupBy(F.col(group).alias(own)).agg(F.ceil(F.count("*") / block_rows).alias(parts))
    x = df.join(counts, df[group].eqNullSafe(counts[own])).withColumn(
        block, F.pmod(F.xxhash64(F.col(doc_col), F.lit(7)), F.col(parts))).drop(parts, own)
    x = x.repartition(group, block).sortWithinPartitions(group, block, F.desc(size), doc_col)
    schema = df.withColumn(into, F.lit(0).cast("int")).schema
    at = {c: x.columns.index(c) for c in (group, block, size, rate)}

    def run(batches):
        key, carry = None, 0.0
        for b in batches:
            out = []
            for g, k, n, r in zip(*(b.column(at[c]).to_pylist() for c in (group, block, size, rate))):
                if (g, k) != key:
                    key, carry = (g, k), 0.0
                want = r * n + carry
                c = min(cap, max(0, math.floor(want / n + 0.5))) if n else min(cap, math.floor(r + 0.5))
                carry = want - c * n
                out.append(c)
            cols = [c for i, c in enumerate(b.columns) if i != at[block]]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(out, pa.int32())], names=schema.names)

    return x.mapInArrow(run, schema)


def mix(docs: DataFrame, size_col: str, source_col: str = "source", doc_col: str = "doc_id",
        weights: tuple[int, ...] = (5, 2, 1), cap: int = 3, block_rows: int = 1000) -> DataFrame:
    """``docs`` with one more column ``_mix``: a struct of source_size, target (its source's), rate
    and copies.  ``size_col``: the words of each row."""
    spark, kind = docs.sparkSession, docs.schema[source_col].dataType.simpleString()
    cells = written(docs.groupBy(F.col(source_col).alias("source")).agg(F.sum(size_col).alias("size")), "mixing-cells")
    sizes = [(r["source"], r["size"]) for r in cells.collect()]
    targets = shares(sizes, weights, cap)
    lam = newton(cells, {"source": targets})
    rate, copies, s, n, t, name = (fresh(docs, c) for c in ("_rate", "_copies", "_source", "_total", "_target", "_mix"))
    found = rounded(with_rates(docs, {source_col: lam["source"]}, rate), source_col, size_col, rate, doc_col, copies, cap, block_rows)
    mixed = spark.createDataFrame([(v, k, targets[v]) for v, k in sizes], f"{s} {kind}, {n} long, {t} double")
    return found.join(mixed, found[source_col].eqNullSafe(mixed[s]), "left").select(*docs.columns, F.struct(
        F.col(n).alias("source_size"), F.col(t).alias("target"), F.col(rate).alias("rate"), F.col(copies).alias("copies")).alias(name))


def mixture(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, copies."""
    sized = written(docs.select("doc_id", "source", size_of("text").alias("size")), "mixing-sizes")
    m = F.col("_mix")
    return mix(sized, "size", **options).select("doc_id", "size", m["source_size"].alias("source_size"), m["target"].alias("target"),
                                                (F.col("size") * m["copies"]).alias("taken"), m["copies"].alias("copies"))


def resampled(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """``docs`` with the same columns, each row as often as the mix takes it."""
    size = fresh(docs, "_size")
    found = mix(docs.withColumn(size, size_of(text_col)), size, **options)
    name = found.columns[-1]
    times = fresh(found, "_time")
    return found.withColumn(times, F.explode(F.array_repeat(F.lit(1), F.col(name)["copies"]))).drop(times, name, size)

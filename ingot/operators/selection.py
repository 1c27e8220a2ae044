"""Selection over listings and records: batch range (B1), first N (B2),
first N per file (B3), pending work against a ledger (J2, J3, J4 / B6)."""

from __future__ import annotations

import re
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_RANGE = re.compile(r"^[0-9]+-[0-9]+$")


def parse_batch_range(text: str) -> tuple[int, int]:
    """``"1-50"`` -> (1, 50); 1-based, inclusive."""
    if not _RANGE.match(text or ""):
        raise ValueError(f"batch range must look like START-END, got {text!r}")
    a, b = (int(x) for x in text.split("-"))
    return a, b


def rank_folders(files: DataFrame, by: tuple[str, ...] = (), folder: str = "folder") -> DataFrame:
    """Distinct folders with their 1-based rank in alphabetical order."""
    w = Window.partitionBy(*by).orderBy(folder) if by else Window.orderBy(folder)
    # The distinct folder list is small (one row per folder); ranking it in one
    # partition per group is cheap and never touches records.
    return files.select(*by, folder).distinct().withColumn("folder_rank", F.dense_rank().over(w))


def select_batch(files: DataFrame, start: int, end: int, by: tuple[str, ...] = (),
                 folder: str = "folder") -> DataFrame:
    """Rows whose folder ranks in ``[start, end]`` alphabetically (B1).

    The join is left to the planner, which knows the size of the folder list at run time.
    """
    ranked = rank_folders(files, by, folder).where(F.col("folder_rank").between(start, end))
    return files.join(ranked, [*by, folder], "inner")


def first_n(df: DataFrame, n: int, by: list[str] | tuple[str, ...], order: list | tuple,
            rank_col: str | None = None) -> DataFrame:
    """First ``n`` rows per group in ``order`` (B2); ``n <= 0`` means no limit.

    ``row_number() <= n`` gets a partial ``WindowGroupLimit`` before the shuffle for ``n`` up
    to ``spark.sql.optimizer.windowGroupLimitThreshold`` (set by ``get_spark``), so a hot
    group ships at most ``n`` rows per input partition.
    """
    if n is None or n <= 0:
        return df
    w = Window.partitionBy(*by).orderBy(*order)
    rn = rank_col or "_rn"
    out = df.withColumn(rn, F.row_number().over(w)).where(F.col(rn) <= n)
    return out if rank_col else out.drop(rn)


def sample_head(lines: DataFrame, n: int = 1000, file_col: str = "file",
                order: tuple[str, ...] = ("block_start", "line_id"), rank_col: str | None = None) -> DataFrame:
    """First ``n`` lines of each file, in file order.

    Line order inside a file is (split start, monotonically increasing id); a
    gzip file is a single split.  A global ``limit`` or ``sample`` is not the same.
    """
    return first_n(lines, n, [file_col], [F.col(c) for c in order], rank_col)


def head_of_files(lines: DataFrame, n: int, value_col: str = "value", path_col: str = "raw_path") -> DataFrame:
    """First ``n`` lines of each gzip file (B3 / H1), for files that are one split each: lines
    arrive in file order, so a counter per file in the scan task is enough.  No sort and no
    shuffle; lines beyond ``n`` are dropped as they are read."""
    def head(batches):
        seen: dict[str, int] = {}
        for b in batches:
            paths = b.column(1).dictionary_encode()
            keep = np.zeros(b.num_rows, bool)
            codes = paths.indices.to_numpy(zero_copy_only=False)
            for k, path in enumerate(paths.dictionary.to_pylist()):
                at = np.flatnonzero(codes == k)
                have = seen.get(path, 0)
                keep[at[:max(0, n - have)]] = True
                seen[path] = min(n, have + len(at))
            yield b.filter(pa.array(keep)).select([0])

    return lines.select(F.col(value_col).alias("value"), path_col).mapInArrow(head, "value string")


def pending(items: DataFrame, ledger: DataFrame, on: str | list[str] = "file",
            done_status: tuple[str, ...] | None = None, ledger_on: str | list[str] | None = None) -> DataFrame:
    """Items without a ledger row (J2), or without a row in ``done_status``.

    J2 (validation): any ledger row counts as done, whatever its status.
    J3 (upload): only ``OK`` rows count, so ``FAIL`` rows are retried.
    """
    done = ledger
    if done_status:
        done = done.where(F.col("status").isin(*done_status))
    keys = [on] if isinstance(on, str) else list(on)
    lkeys = keys if ledger_on is None else ([ledger_on] if isinstance(ledger_on, str) else list(ledger_on))
    done = done.select(*[F.col(a).alias(b) for a, b in zip(lkeys, keys)]).distinct()
    return items.join(done, keys, "left_anti")


# the scan helper above travels to workers that have no installed copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

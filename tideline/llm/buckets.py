"""Pairs within hash buckets, compared inside tasks and summed up there, so that no pair becomes a row.

Rows that share (table, key) form a bucket. A bucket of more than ``block`` rows is cut into blocks, and every two blocks
meet in a group of their own: each task holds two blocks at most, and each pair is compared once per table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import broadcast_within, staged

# Two blocks of this many rows are compared by one matrix of 16 million cells at most.
BLOCK = 2048
BROADCAST_BYTES = 16_000_000


def grouped_buckets(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """``rows`` (table, key, id, ...) dealt out and sorted by (table, key, left, right), without buckets of one row.

    ``left`` and ``right`` name the two blocks that meet in a group, ``part`` the block a row belongs to.
    """
    sizes = rows.groupBy(F.col("table").alias("_t"), F.col("key").alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    large = staged(sizes.where(F.col("_n") > block), "large-buckets")
    blocks = F.ceil(F.col("_n") / F.lit(block)).cast("int")
    part = F.when(F.col("_n").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64("id", F.lit(1)), blocks).cast("int"))
    other = F.when(F.col("_n").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), blocks - 1))
    met = rows.join(broadcast_within(large, BROADCAST_BYTES), (F.col("table") == F.col("_t")) & (F.col("key") == F.col("_k")), "left")
    met = met.withColumn("part", part).withColumn("_other", F.explode(other))
    met = met.withColumns({"left": F.least("part", "_other"), "right": F.greatest("part", "_other")})
    return met.select(*rows.columns, "part", "left", "right").repartition("table", "key", "left", "right").sortWithinPartitions(
        "table", "key", "left", "right", "part")


def over_groups(compare: Callable[[pa.RecordBatch, int], pa.RecordBatch | None], schema: pa.Schema):
    """A function for ``mapInArrow`` over sorted rows: ``compare(rows of a group, rows of its first block)`` per group.

    Batches are cut at group borders, so that only one group is held beside the batch; groups of one row are skipped.
    """
    keys = ("table", "key", "left", "right")

    def groups(table: pa.Table, last: bool) -> tuple[list[tuple[int, int]], int]:
        columns = [table.column(k).to_numpy() for k in keys]
        change = np.zeros(table.num_rows, dtype=bool)
        change[0] = True
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        starts = np.flatnonzero(change)
        ends = np.append(starts[1:], table.num_rows)
        if last:
            return list(zip(starts[ends - starts > 1], ends[ends - starts > 1])), table.num_rows
        done = ends[:-1] - starts[:-1] > 1
        return list(zip(starts[:-1][done], ends[:-1][done])), int(starts[-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, rows
            if not rows:
                return
            table = pa.Table.from_batches(held).combine_chunks()
            spans, rest = groups(table, last)
            out = []
            for start, end in spans:
                group = table.slice(start, end - start)
                part, left, right = (group.column(k).to_numpy() for k in ("part", "left", "right"))
                first = len(part) if left[0] == right[0] else int(np.count_nonzero(part == left[0]))
                if first and (left[0] == right[0] or first < len(part)):
                    found = compare(group, first)
                    if found is not None and found.num_rows:
                        out.append(found)
            kept = table.slice(rest)
            held, rows = (kept.to_batches() if kept.num_rows else []), kept.num_rows
            if out:
                yield from pa.Table.from_batches(out).combine_chunks().to_batches()

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                rows += batch.num_rows
            if rows >= 8192:
                yield from flush(False)
        yield from flush(True)
        yield pa.RecordBatch.from_pylist([], schema=schema)

    return run


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Positions of the pairs (a[i], b[i]) that join parts not joined by earlier ones: at most n - 1 of them."""
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept, left = [], n - 1
    for i, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
        x, y = root(x), root(y)
        if x != y:
            parent[x] = y
            kept.append(i)
            left -= 1
            if not left:
                break
    return np.asarray(kept, dtype=np.int64)

"""Time-aligned joins."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.series import SeriesSpec, equi_join, fill_backward, fill_forward, place_rows


def _row_hash(df: DataFrame, columns: Sequence[str]) -> Column:
    hashable = [f.name for f in df.schema.fields if f.name in columns and not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return F.xxhash64(*hashable)


def asof_join(left: DataFrame, right: DataFrame, left_ts: str, right_ts: str, keys: Sequence[str] = (),
              right_tiebreak: Sequence[str] = (), direction: str = "backward", allow_exact: bool = True,
              tolerance: str | None = None, prefix: str = "right_") -> DataFrame:
    """Every left row with the nearest right row before it (or after it) of the same key.

    Both sides are merged into one ordered series and the right row is carried along it. The merged series is cut by
    range partitioning over (key, time), so one hot key, or none at all, is spread over all tasks; only the last right
    row of each cut travels to the next ones. Right columns come back with ``prefix``; equal right times resolve to
    the last one by ``right_tiebreak``. A missing time or key matches nothing, on either side.
    """
    if direction not in ("backward", "forward"):
        raise ValueError("direction is 'backward' or 'forward'")
    first_side = 0 if (direction == "backward") == allow_exact else 1
    if not keys:
        left, right = left.withColumn("_k", F.lit(0)), right.withColumn("_k", F.lit(0))
    on = list(keys) or ["_k"]
    dated = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in (*keys, right_ts)])
    right = right.where(dated)
    ties = [f"_t{i}" for i in range(len(right_tiebreak))]
    right_types = {f.name: f.dataType for f in right.schema.fields}
    right_cols = [c for c in right.columns if c not in on]
    left_cols = [c for c in left.columns if c not in on]
    merged = left.select(
        *on, F.col(left_ts).alias("_ts"), F.lit(1 - first_side).alias("_side"), F.lit(True).alias("_is_left"),
        *[F.lit(None).cast(right_types[c]).alias(t) for c, t in zip(right_tiebreak, ties)],
        _row_hash(left, left_cols).alias("_hash"), F.struct(*left_cols).alias("_left"),
    ).unionByName(right.select(
        *on, F.col(right_ts).alias("_ts"), F.lit(first_side).alias("_side"), F.lit(False).alias("_is_left"),
        *[F.col(c).alias(t) for c, t in zip(right_tiebreak, ties)],
        _row_hash(right, right_cols).alias("_hash"), F.struct(*right_cols).alias("_right"),
    ), allowMissingColumns=True)
    placed, spec = place_rows(merged, SeriesSpec(tuple(on), "_ts", ("_side", *ties, "_hash")))
    filled = (fill_forward if direction == "backward" else fill_backward)(placed, spec, ["_right"])
    known = reduce(lambda a, b: a & b, [c.isNotNull() for c in (*[F.col(k) for k in keys], F.col("_left")[left_ts])])
    out = filled.where("_is_left").select(
        *keys, "_left.*", *[F.when(known, F.col("_right")[c]).alias(prefix + c) for c in right_cols])
    if tolerance is not None:
        at = prefix + right_ts
        gap = F.expr(f"INTERVAL {tolerance}")
        near = (F.col(left_ts) - gap <= F.col(at)) & (F.col(at) <= F.col(left_ts) + gap)
        out = out.withColumns({prefix + c: F.when(near, F.col(prefix + c)) for c in right_cols})
    return out


def one_row_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row by ``order`` for every key, so that a join cannot multiply rows."""
    rest = [c for c in df.columns if c not in keys]
    newest = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return newest.select(*keys, "_row.*")


def merge_on_time(base: DataFrame, others: Mapping[str, DataFrame], keys: Sequence[str] = ("ts",),
                  order: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Left-join tables on time (or other keys), columns prefixed with the table's name.

    Every right side is first reduced to one row per key (the last by ``order``, default: its own columns).
    """
    order = order or {}
    for name, other in others.items():
        rest = [c for c in other.columns if c not in keys]
        single = one_row_per_key(other, keys, order.get(name, rest))
        base = equi_join(base, single.withColumnsRenamed({c: f"{name}_{c}" for c in rest}), keys)
    return base


def attach_group(df: DataFrame, keys: Sequence[str], **aggregates: Column) -> DataFrame:
    """Add group aggregates to the detail rows.

    Aggregate and join instead of a window: partial sums shrink a hot group before it is shuffled.
    """
    groups = df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggregates.items()])
    return equi_join(df, groups, keys)


def pairwise_compare(df: DataFrame, key: str, metrics: Mapping[str, str]) -> DataFrame:
    """Absolute differences between every two rows of a per-group summary (one row per network).

    The result is one row per pair by definition; the input is an aggregated table.
    """
    a, b = df.alias("a"), df.alias("b")
    return a.join(b, F.col(f"a.{key}") < F.col(f"b.{key}")).select(
        F.concat_ws("_vs_", f"a.{key}", f"b.{key}").alias("pair"),
        *[F.abs(F.col(f"a.{m}") - F.col(f"b.{m}")).alias(name) for name, m in metrics.items()])


def one_new_row(new: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key: the last by ``order`` (default: by all other columns that can be compared)."""
    rest = [f.name for f in new.schema.fields if f.name not in keys]
    if not rest:
        return new.distinct()
    comparable = [f.name for f in new.schema.fields if f.name in rest and not isinstance(f.dataType, (T.MapType, T.VariantType))]
    order = list(order) or comparable
    return (one_row_per_key(new, keys, order) if order else new.dropDuplicates(list(keys))).select(*new.columns)


def anti_join_new(new: DataFrame, existing: DataFrame, keys: Iterable[str], order: Sequence[str] = ()) -> DataFrame:
    """Rows of ``new`` whose key is not stored yet, one per key: the last by ``order`` (default: by all other columns)."""
    keys = list(keys)
    stored = existing.select(*keys).withColumnsRenamed({k: f"_s_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [new[k].eqNullSafe(stored[f"_s_{k}"]) for k in keys])
    return one_new_row(new.join(stored, same, "left_anti"), keys, order)

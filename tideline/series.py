"""Ordered series: the layer every indicator, fill and as-of join is written on.

A series is the rows of one key in event-time order. Bars have a bounded number of rows per key (time span divided
by the interval), so a window per key is fine for them (``SeriesSpec`` without ``part``). Raw ticks have no such
bound: one key may hold a third of the table. For those, ``index_series`` gives every row its position in its series
by a range-partitioned sort on (key, time, tie-break), which splits hot keys and even hot timestamps evenly, and
``over_chunks`` runs the same operator on chunks of fixed length, each with copies of the rows before it (halo) so
that bounded look-back windows are exact at chunk borders. Unbounded running values get their carry from a small
per-chunk summary (``running``).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tideline.staging import stage, unstage

CHUNK_ROWS = 100_000
# Rows of a range-partitioned run, at most about this many.
RUN_ROWS = 1_000_000
HALO = "_halo"
# Rows of a group that are sorted in one task to find a quantile, and the size of the rank sketches that narrow larger groups.
BRACKET_ROWS = 1_000_000
SKETCH_K = 1000
_GRID = 256
# Weights below this share of the newest one cannot change a double.
NEGLIGIBLE = 1e-30


@dataclass(frozen=True)
class SeriesSpec:
    keys: tuple[str, ...]
    ts: str
    tiebreak: tuple[str, ...] = ()
    part: str | None = None
    null_keys: bool = True  # whether a key may be NULL; splitting a series finds out

    @property
    def by(self) -> list[str]:
        return [*self.keys, *([self.part] if self.part else [])]

    @property
    def order(self) -> list[str]:
        return [self.ts, *self.tiebreak]

    @property
    def window(self) -> WindowSpec:
        return W.partitionBy(*self.by).orderBy(*self.order)

    @property
    def whole(self) -> WindowSpec:
        return W.partitionBy(*self.by)

    @property
    def running(self) -> WindowSpec:
        return self.window.rowsBetween(W.unboundedPreceding, W.currentRow)

    @property
    def before(self) -> WindowSpec:
        return self.window.rowsBetween(W.unboundedPreceding, -1)

    @property
    def running_back(self) -> WindowSpec:
        """From the end of the series to the row. Spark recomputes frames that start at the row and end at the end,
        so looking forward is a running frame in descending order."""
        return (W.partitionBy(*self.by).orderBy(*[F.col(c).desc() for c in self.order])
                .rowsBetween(W.unboundedPreceding, W.currentRow))

    def rows(self, n: int) -> WindowSpec:
        return self.window.rowsBetween(-(n - 1), W.currentRow)

    def lag(self, column: Column | str, k: int = 1) -> Column:
        return F.lag(column, k).over(self.window)


def rolling(spec: SeriesSpec, column: Column | str, n: int, agg: Callable[[Column], Column]) -> Column:
    """``agg`` over the last ``n`` rows; NULL until the frame holds ``n`` values."""
    column = F.col(column) if isinstance(column, str) else column
    frame = spec.rows(n)
    return F.when(F.count(column).over(frame) == n, agg(column).over(frame))


def equi_join(left: DataFrame, right: DataFrame, on: Iterable[str], how: str = "left", null_keys: bool = True) -> DataFrame:
    """Join on equal names where NULL equals NULL, so that rows with a NULL key are not lost.

    Where keys are known to be non-NULL a plain join is used: its partitioning is the one the windows before and after
    it need, so the long side is not shuffled again.
    """
    on = list(on)
    if not null_keys:
        return left.join(right, on, how)
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in on})
    condition = reduce(lambda a, b: a & b, [left[c].eqNullSafe(renamed[f"_r_{c}"]) for c in on])
    return left.join(renamed, condition, how).drop(*[f"_r_{c}" for c in on])


# ---------------------------------------------------------------- long series

def place_rows(df: DataFrame, spec: SeriesSpec, partitions: int | None = None) -> tuple[DataFrame, SeriesSpec]:
    """Range-partition and sort by (keys, ts, tiebreak) and write the result once.

    Adds ``_pos`` (global sorted position, gaps between partitions) and ``_run`` (the partition). Range bounds are
    drawn from a sample of the full ordering, so a hot key is spread over many runs. Writing pins the bounds: a lost
    executor or a second scan cannot see different ones.
    """
    order = [*spec.keys, *spec.order]
    spark = df.sparkSession
    # What stands above is computed once; the count, the sample for the bounds, and the sort read the stored rows.
    df = stage(df, "unsorted")
    if partitions is None:
        # A run is scanned by one task, so the number of cuts follows the rows, not a setting of the session.
        wanted = -(-df.count() // RUN_ROWS)
        partitions = wanted if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")) else None
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    placed = ranged.sortWithinPartitions(*order).withColumn("_pos", F.monotonically_increasing_id())
    placed = stage(placed, "series").withColumn("_run", F.shiftright("_pos", 33))
    unstage(df)
    # reads the key columns' statistics; row groups without NULLs are skipped
    some_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in spec.keys])
    return placed, replace(spec, part="_run", null_keys=not placed.where(some_null).isEmpty())


def index_series(df: DataFrame, spec: SeriesSpec, partitions: int | None = None) -> DataFrame:
    """Add ``_idx``, the 0-based position of each row in its series, without a window over the whole series."""
    placed, placed_spec = place_rows(df, spec, partitions)
    runs = placed.groupBy(*spec.keys, "_run").agg(F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_n"))
    # one row per key and run: at most (keys + partitions) rows in total
    earlier = W.partitionBy(*spec.keys).orderBy("_run").rowsBetween(W.unboundedPreceding, -1)
    runs = runs.withColumn("_offset", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    joined = equi_join(placed, runs, [*spec.keys, "_run"], "inner", placed_spec.null_keys)
    index = (F.col("_offset") + F.col("_pos") - F.col("_first")).alias("_idx", metadata={"null_keys": placed_spec.null_keys})
    return joined.select(*df.columns, index)


def split_chunks(indexed: DataFrame, spec: SeriesSpec, chunk_rows: int = CHUNK_ROWS, halo: int = 0,
                 lead: int = 0) -> tuple[DataFrame, SeriesSpec]:
    """Cut an indexed series into chunks; copy ``halo`` rows forward and ``lead`` rows backward over each border."""
    if max(halo, lead) > chunk_rows:
        raise ValueError(f"look-back of {max(halo, lead)} rows needs chunks of at least that length, got {chunk_rows}")
    home = F.floor(F.col("_idx") / chunk_rows).cast("long")
    offset = F.col("_idx") % chunk_rows
    targets = F.array_compact(F.array(
        home,
        F.when(offset >= chunk_rows - halo, home + 1),
        F.when((offset < lead) & (home > 0), home - 1),
    ))
    chunked = (indexed.withColumn("_chunk", F.explode(targets))
               .withColumn(HALO, F.floor(F.col("_idx") / chunk_rows).cast("long") != F.col("_chunk")))
    null_keys = indexed.schema["_idx"].metadata.get("null_keys", True)
    return chunked, replace(spec, part="_chunk", null_keys=null_keys)


def drop_halo(df: DataFrame) -> DataFrame:
    return df.where(~F.col(HALO)).drop(HALO, "_chunk")


def over_chunks(df: DataFrame, spec: SeriesSpec, operator: Callable[[DataFrame, SeriesSpec], DataFrame], *,
                halo: int, lead: int = 0, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Run a series operator on a series of any length.

    ``halo`` is the operator's total look-back in rows (the sum over nested windows); ``ewm_memory`` gives it for
    exponential averages.
    """
    indexed = df if "_idx" in df.columns else index_series(df, spec)
    chunked, chunk_spec = split_chunks(indexed, spec, max(chunk_rows, halo, lead), halo, lead)
    return drop_halo(operator(chunked, chunk_spec)).drop("_idx")


def _join_sum(carry: Column, here: Column) -> Column:
    return F.when(carry.isNull(), here).when(here.isNull(), carry).otherwise(carry + here)


_SCANS: dict[str, tuple[Callable, Callable]] = {
    "sum": (F.sum, _join_sum),
    "max": (F.max, lambda carry, here: F.greatest(carry, here)),
    "min": (F.min, lambda carry, here: F.least(carry, here)),
    "last": (lambda c: F.last(c, ignorenulls=True), lambda carry, here: F.coalesce(here, carry)),
}


def running(df: DataFrame, spec: SeriesSpec, columns: Mapping[str, tuple[str, Column | str]]) -> DataFrame:
    """Add running values ``{name: (kind, column)}`` from the start of the series; kind is sum, max, min or last.

    On a split series each chunk is scanned alone; the total of the chunks before it comes from a summary of one row
    per chunk. Copies in the halo are counted once, in their home chunk (running sums stay right on halo rows too).
    """
    columns = {name: (kind, F.col(c) if isinstance(c, str) else c) for name, (kind, c) in columns.items()}
    if spec.part is None:
        return df.withColumns({name: _SCANS[kind][0](c).over(spec.running) for name, (kind, c) in columns.items()})
    df = df.withColumns({f"_x_{name}": c for name, (_, c) in columns.items()})
    own = ~F.col(HALO) if HALO in df.columns else F.lit(True)
    tail = W.partitionBy(*spec.by)
    totals = df.where(own).groupBy(*spec.by).agg(*[
        (F.max_by(F.struct(f"_x_{n}"), F.when(F.col(f"_x_{n}").isNotNull(), F.struct(*spec.order)))[f"_x_{n}"]
         if kind == "last" else _SCANS[kind][0](f"_x_{n}")).alias(f"_t_{n}")
        for n, (kind, _) in columns.items()])
    earlier = W.partitionBy(*spec.keys).orderBy(spec.part).rowsBetween(W.unboundedPreceding, -1)
    carries = totals.select(*spec.by, *[_SCANS[k][0](f"_t_{n}").over(earlier).alias(f"_c_{n}")
                                        for n, (k, _) in columns.items()])
    out = equi_join(df, carries, spec.by, null_keys=spec.null_keys)
    values = {}
    for name, (kind, _) in columns.items():
        x, carry = F.col(f"_x_{name}"), F.col(f"_c_{name}")
        if kind == "sum":
            here = F.sum(x).over(spec.running)
            if HALO in df.columns:
                halo_sum = F.coalesce(F.sum(F.when(F.col(HALO), x)).over(tail), F.lit(0.0))
                here = here - halo_sum
        else:
            here = _SCANS[kind][0](F.when(own, x)).over(spec.running)
        values[name] = _SCANS[kind][1](carry, here)
    return (out.withColumns(values)
            .drop(*[f"_x_{n}" for n in columns], *[f"_c_{n}" for n in columns]))


def fill_forward(df: DataFrame, spec: SeriesSpec, columns: Iterable[str]) -> DataFrame:
    """Replace NULLs by the last value before them."""
    columns = list(columns)
    filled = running(df, spec, {f"_f_{c}": ("last", c) for c in columns})
    return filled.withColumns({c: F.col(f"_f_{c}") for c in columns}).drop(*[f"_f_{c}" for c in columns])


def fill_backward(df: DataFrame, spec: SeriesSpec, columns: Iterable[str]) -> DataFrame:
    """Replace NULLs by the next value after them."""
    columns = list(columns)
    if spec.part is None:
        return df.withColumns({c: F.last(c, ignorenulls=True).over(spec.running_back) for c in columns})
    firsts = df.groupBy(*spec.by).agg(*[
        F.min_by(c, F.when(F.col(c).isNotNull(), F.struct(*spec.order))).alias(f"_t_{c}") for c in columns])
    later = W.partitionBy(*spec.keys).orderBy(F.col(spec.part).desc()).rowsBetween(W.unboundedPreceding, -1)
    carries = firsts.select(*spec.by, *[F.last(f"_t_{c}", ignorenulls=True).over(later).alias(f"_c_{c}")
                                        for c in columns])
    out = equi_join(df, carries, spec.by, null_keys=spec.null_keys)
    return out.withColumns({
        c: F.coalesce(F.last(c, ignorenulls=True).over(spec.running_back), F.col(f"_c_{c}")) for c in columns
    }).drop(*[f"_c_{c}" for c in columns])


# ---------------------------------------------------------------- exponential averages

def ewm_memory(*alphas: float) -> int:
    """Rows after which an exponential average has forgotten its past to less than ``NEGLIGIBLE``."""
    return max(math.ceil(math.log(NEGLIGIBLE) / math.log(1 - a)) if a < 1 else 1 for a in alphas)


def ewm(df: DataFrame, spec: SeriesSpec, outputs: Mapping[str, tuple[str, float]]) -> DataFrame:
    """Add exponential averages ``{name: (column, alpha)}`` with y0 = x0 and y = (1-alpha)*y' + alpha*x.

    Written as windows, not as a loop: rows are cut into blocks as long as the average's memory; inside a block
    y_i = d^i * sum(d^-j * u_j), and the only thing a block needs from its past is the value at the end of the block
    before it. NULLs are skipped. On a split series the halo must hold at least ``ewm_memory(alpha)`` rows.
    """
    for name, (source, alpha) in outputs.items():
        if alpha >= 1:
            df = df.withColumn(name, F.col(source))
    outputs = {n: (s, a) for n, (s, a) in outputs.items() if a < 1}
    if not outputs:
        return df
    sources = sorted({s for s, _ in outputs.values()})
    df = df.withColumns({f"_n_{s}": F.count(s).over(spec.running) - 1 for s in sources})
    blocks = {name: ewm_memory(alpha) for name, (_, alpha) in outputs.items()}
    partials, carries, values = {}, {}, {}
    for name, (source, alpha) in outputs.items():
        n, length, decay = F.col(f"_n_{source}"), blocks[name], 1 - alpha
        block = F.floor(n / length)
        inside = n % length
        feed = F.when(n == 0, F.col(source)).otherwise(alpha * F.col(source))
        frame = (W.partitionBy(*spec.by, block).orderBy(*spec.order)
                 .rowsBetween(W.unboundedPreceding, W.currentRow))
        partials[f"_p_{name}"] = F.when(
            F.col(source).isNotNull(),
            F.pow(F.lit(decay), inside) * F.sum(feed * F.pow(F.lit(decay), -inside)).over(frame))
        ends = F.when(F.col(source).isNotNull() & (inside == length - 1), F.col(f"_p_{name}"))
        carries[f"_e_{name}"] = F.last(ends, ignorenulls=True).over(spec.before)
        values[name] = F.col(f"_p_{name}") + F.coalesce(
            F.pow(F.lit(decay), inside + 1) * F.col(f"_e_{name}"), F.lit(0.0))
    df = df.withColumns(partials).withColumns(carries).withColumns(values)
    df = df.withColumns({name: F.last(name, ignorenulls=True).over(spec.running) for name in outputs})
    return df.drop(*partials, *carries, *[f"_n_{s}" for s in sources])


# ---------------------------------------------------------------- order statistics

def quantiles(df: DataFrame, keys: Iterable[str], column: str, shares: Mapping[str, float], limit: int = BRACKET_ROWS,
              sketch: int = SKETCH_K) -> DataFrame:
    """Exact quantiles per key (linear interpolation) for groups of any size. NULLs are ignored, NaN is the largest value.

    The input is read once, into a table of keys and values. Mergeable rank sketches bracket the position of each quantile; values outside the bracket
    are only counted, those inside are looked at again, until at most ``limit`` rows of a group (or rows of few values, which are
    counted by value) are inside. Only these are sorted, so no group is sorted or gathered as a whole. A bracket is used only where the
    counts prove that it holds the position, so the answer does not rest on the sketch.
    """
    keys = list(keys)
    values = stage(df.select(*keys, F.col(column).cast("double").alias("_v")).where(F.col("_v").isNotNull()), "values")
    return quantiles_of(values, keys, "_v", shares, limit, sketch)


def quantiles_of(values: DataFrame, keys: Iterable[str], column: str, shares: Mapping[str, float], limit: int = BRACKET_ROWS,
                 sketch: int = SKETCH_K) -> DataFrame:
    """``quantiles`` of a stored table, which is read as often as a bracket needs to be narrowed."""
    wanted = list(keys)
    keys = wanted or ["_all"]
    rows = values.select(*[F.col(k) for k in wanted], F.col(column).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    rows = rows if wanted else rows.withColumn("_all", F.lit(0))
    names = list(shares)
    # One set of candidates per share. ``_below`` counts the rows of a group that were left out for being too small.
    start = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    parts = []
    for name in names:
        at = F.lit(shares[name]) * (F.col("_n") - 1)
        groups = start.select(*keys, F.col("_n"), (at - F.floor(at)).alias("_w"), F.floor(at).alias("_low"),
                              F.least(F.floor(at) + 1, F.col("_n") - 1).alias("_high"), F.lit(0).cast("long").alias("_below"),
                              F.lit(float("-inf")).alias("_from"), F.lit(float("nan")).alias("_to"))
        inside, groups = _narrow(rows, stage(groups, "groups"), keys, limit, sketch)
        counted = inside.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c"))
        upto = F.sum("_c").over(W.partitionBy(*keys).orderBy("_v").rowsBetween(W.unboundedPreceding, W.currentRow))
        placed = equi_join(counted.withColumn("_upto", upto), groups, keys, "inner")
        first, last = F.col("_below") + F.col("_upto") - F.col("_c"), F.col("_below") + F.col("_upto") - 1
        found = placed.groupBy(*keys).agg(F.max(F.when(F.col("_low").between(first, last), F.col("_v"))).alias("_lo"),
                                          F.max(F.when(F.col("_high").between(first, last), F.col("_v"))).alias("_hi"), F.max("_w").alias("_w"))
        parts.append(found.select(*keys, (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_w")).alias(name)))
    out = parts[0]
    for part in parts[1:]:
        out = equi_join(out, part, keys, "inner")
    return out.select(*wanted, *names)


def _narrow(rows: DataFrame, groups: DataFrame, keys: list[str], limit: int, sketch: int) -> tuple[DataFrame, DataFrame]:
    """The rows that may hold the wanted positions, and the groups with their brackets ``_from`` to ``_to`` and the counts below them."""
    inside, n_inside, margin = rows, F.col("_n"), 8.0 / sketch
    sizes = groups.select(*keys, F.col("_n").alias("_in"))
    while True:
        large = equi_join(groups, sizes, keys, "inner").where(F.col("_in") > limit)
        if large.isEmpty():
            return inside, groups
        made = equi_join(inside, large.select(*keys), keys, "inner").groupBy(*keys).agg(F.kll_sketch_agg_double("_v", F.lit(sketch)).alias("_s"))
        # a sketch is asked for constant ranks only
        grid = F.array(*[F.lit(i / _GRID) for i in range(_GRID + 1)])
        sketches = made.select(*keys, F.kll_sketch_get_quantile_double("_s", grid).alias("_grid"))

        def edge(position: Column, step: float) -> Column:
            at = ((position - F.col("_below") + 0.5) / F.col("_in") + step) * _GRID
            at = F.floor(at) if step < 0 else F.ceil(at)
            return F.get("_grid", F.greatest(F.lit(0), F.least(F.lit(_GRID), at)).cast("int"))

        bracket = stage(equi_join(large, sketches, keys, "inner").select(
            *keys, F.greatest(F.col("_from"), edge(F.col("_low"), -margin)).alias("_a"), F.least(F.col("_to"), edge(F.col("_high"), margin)).alias("_b"), "_in"), "bracket")
        met = equi_join(inside, bracket, keys, "left")
        # What a bracket leaves out below, and keeps: it is taken where it holds both positions and leaves out enough to go on.
        kept = F.col("_v").between(F.col("_a"), F.col("_b"))
        counts = met.where(F.col("_a").isNotNull()).groupBy(*keys).agg(F.count_if(F.col("_v") < F.col("_a")).alias("_left"), F.count_if(kept).alias("_kept"))
        judged = equi_join(equi_join(groups, bracket, keys, "left"), counts, keys, "left")
        holds = (F.col("_below") + F.col("_left") <= F.col("_low")) & (F.col("_below") + F.col("_left") + F.col("_kept") > F.col("_high")) & (F.col("_kept") < F.col("_in"))
        taken = F.coalesce(holds, F.lit(False))
        groups = stage(judged.select(
            *keys, "_n", "_w", "_low", "_high", (F.col("_below") + F.when(taken, F.col("_left")).otherwise(0)).alias("_below"),
            F.when(taken, F.col("_a")).otherwise(F.col("_from")).alias("_from"), F.when(taken, F.col("_b")).otherwise(F.col("_to")).alias("_to"),
            # a group whose bracket did not narrow (few values, or an unlucky sketch) is done
            F.when(taken & (F.col("_kept") * 2 < F.col("_in")), F.col("_kept")).otherwise(F.lit(0)).alias("_in")), "groups")
        sizes, groups = groups.select(*keys, "_in"), groups.drop("_in")
        inside = equi_join(rows, groups.select(*keys, "_from", "_to"), keys, "inner").where(F.col("_v").between(F.col("_from"), F.col("_to"))).select(*keys, "_v")


def approximate_quantiles(df: DataFrame, keys: Iterable[str], column: str, shares: Mapping[str, float], sketch: int = SKETCH_K) -> DataFrame:
    """Quantiles per key from the sketch alone, in one pass: a value of the group whose rank is off by about 2.3 / ``sketch`` of its rows at most."""
    keys = list(keys)
    made = df.groupBy(*keys).agg(F.kll_sketch_agg_double(F.col(column).cast("double"), F.lit(sketch)).alias("_s"))
    return made.select(*keys, *[F.kll_sketch_get_quantile_double("_s", F.lit(float(share))).alias(name) for name, share in shares.items()])


def latest(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """The newest row of every series, by aggregation instead of a sort."""
    rest = [c for c in df.columns if c not in spec.keys]
    newest = df.groupBy(*spec.keys).agg(F.max_by(F.struct(*rest), F.struct(*spec.order)).alias("_row"))
    return newest.select(*spec.keys, "_row.*")

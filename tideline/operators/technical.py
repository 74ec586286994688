"""The published indicator set (K1-K21), in the textbook definitions with the customary parameters.

Look-back windows only, except two running sums (``obv``, ``vpt``) and one true state machine (``parabolic_sar``, ``parabolic_sar_scan``).
Where the source of the requirement calls an indicator with too few inputs, the published formula is used.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from tideline.functions.expr import ratio
from tideline.series import CHUNK_ROWS, HALO, SeriesSpec, ewm, ewm_memory, index_series, rolling, running, split_chunks
from tideline.staging import stage

# Total look-back of ``technical_indicators`` for ``series.over_chunks``.
LOOK_BACK = 2 * ewm_memory(2 / 51, 1 / 14) + 60

# Retracement levels in percent.
FIBONACCI = (23.6, 38.2, 50.0, 61.8, 78.6)


def _position(df: DataFrame, spec: SeriesSpec) -> Column:
    """0-based position in the series: known for indexed series, counted for keyed ones."""
    return F.col("_idx") if "_idx" in df.columns else F.row_number().over(spec.window) - 1


def averages(df: DataFrame, spec: SeriesSpec, windows: tuple[int, ...] = (10, 50)) -> DataFrame:
    """K1, K2: simple and exponential means, NULL until the window is full."""
    df = ewm(df, spec, {f"ema_{w}": ("close", 2 / (w + 1)) for w in windows})
    return df.withColumns({
        **{f"sma_{w}": rolling(spec, "close", w, F.avg) for w in windows},
        **{f"ema_{w}": F.when(F.count("close").over(spec.rows(w)) == w, F.col(f"ema_{w}")) for w in windows}})


def rate_of_change(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """K3: percentage change over 4 and 12 rows."""
    return df.withColumns({name: (ratio(F.col("close"), spec.lag("close", k)) - 1) * 100
                           for name, k in (("momentum", 4), ("proc", 12))})


def bands(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """K4: mean +- two population deviations over 20 rows.

    ``volatility`` is the upper band over 10 rows, a price level; ``volatility_std`` is the deviation of returns.
    """
    mean, deviation = {}, {}
    for w in (10, 20):
        mean[w] = rolling(spec, "close", w, F.avg)
        deviation[w] = rolling(spec, "close", w, F.stddev_pop)
    df = df.withColumns({"volatility": mean[10] + 2 * deviation[10],
                         "bollinger_hband": mean[20] + 2 * deviation[20],
                         "bollinger_lband": mean[20] - 2 * deviation[20],
                         "_r": ratio(F.col("close"), spec.lag("close")) - 1})
    return df.withColumn("volatility_std", rolling(spec, "_r", 10, F.stddev_samp)).drop("_r")


def wilder_rsi(df: DataFrame, spec: SeriesSpec, window: int = 14) -> DataFrame:
    """K5: relative strength on exponential means of gains and losses."""
    change = F.coalesce(F.col("close") - spec.lag("close"), F.lit(0.0))
    df = df.withColumns({"_up": F.greatest(change, F.lit(0.0)), "_down": F.greatest(-change, F.lit(0.0))})
    df = ewm(df, spec, {"_gain": ("_up", 1 / window), "_loss": ("_down", 1 / window)})
    ready = F.count("close").over(spec.rows(window)) == window
    value = F.when(F.col("_loss") == 0, F.lit(100.0)).otherwise(100 - 100 / (1 + ratio("_gain", "_loss")))
    return df.withColumn("rsi", F.when(ready, value)).drop("_up", "_down", "_gain", "_loss")


def macd_lines(df: DataFrame, spec: SeriesSpec, fast: int = 12, slow: int = 26, signal: int = 9) -> DataFrame:
    """K6: MACD with warm-up rows left NULL."""
    df = ewm(df, spec, {"_fast": ("close", 2 / (fast + 1)), "_slow": ("close", 2 / (slow + 1))})
    ready = F.count("close").over(spec.rows(slow)) == slow
    df = df.withColumn("macd", F.when(ready, F.col("_fast") - F.col("_slow"))).drop("_fast", "_slow")
    df = ewm(df, spec, {"_signal": ("macd", 2 / (signal + 1))})
    df = df.withColumn("macd_signal", F.when(F.count("macd").over(spec.rows(signal)) == signal, F.col("_signal")))
    return df.withColumn("macd_diff", F.col("macd") - F.col("macd_signal")).drop("_signal")


def ranges(df: DataFrame, spec: SeriesSpec, fib_window: int = 20) -> DataFrame:
    """Positions within and midpoints of rolling high-low ranges."""
    def high(w):
        return rolling(spec, "high", w, F.max)

    def low(w):
        return rolling(spec, "low", w, F.min)

    df = df.withColumns({f"_h{w}": high(w) for w in {9, 14, 26, 52, fib_window}}
                        | {f"_l{w}": low(w) for w in {9, 14, 26, 52, fib_window}})
    span = F.col("_h14") - F.col("_l14")
    mid = {w: (F.col(f"_h{w}") + F.col(f"_l{w}")) / 2 for w in (9, 26, 52)}
    top, reach = F.col(f"_h{fib_window}"), F.col(f"_h{fib_window}") - F.col(f"_l{fib_window}")
    df = df.withColumns({
        "stoch": 100 * ratio(F.col("close") - F.col("_l14"), span),
        "williams_r": -100 * ratio(F.col("_h14") - F.col("close"), span),
        "ichimoku_a": (mid[9] + mid[26]) / 2,
        "ichimoku_b": mid[52],
        **{f"fib_{str(p).replace('.', '_')}": top - reach * (p / 100) for p in FIBONACCI}})
    return df.drop(*[c for c in df.columns if c[:2] in ("_h", "_l") and c[2:].isdigit()])


def average_true_range(df: DataFrame, spec: SeriesSpec, window: int = 14) -> DataFrame:
    """True range, smoothed from a first value that is the plain mean of the first ``window`` rows."""
    before = spec.lag("close")
    df = df.withColumns({"_tr": F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - before),
                                           F.abs(F.col("low") - before)),
                         "_at": _position(df, spec)})
    start = F.avg("_tr").over(spec.rows(window))
    df = df.withColumn("_seeded", F.when(F.col("_at") == window - 1, start)
                       .when(F.col("_at") >= window, F.col("_tr")))
    return ewm(df, spec, {"atr": ("_seeded", 1 / window)}).drop("_tr", "_at", "_seeded")


def flows(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Ratios of rolling sums of price and volume moves."""
    previous = spec.lag("close")
    typical = (F.col("high") + F.col("low") + F.col("close")) / 3
    df = df.withColumns({"_c1": previous, "_tp": typical})
    change, tp_change = F.col("close") - F.col("_c1"), F.col("_tp") - spec.lag("_tp")
    floor, roof = F.least(F.col("low"), F.col("_c1")), F.greatest(F.col("high"), F.col("_c1"))
    money = F.col("_tp") * F.col("volume")
    close, high, low = F.col("close"), F.col("high"), F.col("low")
    df = df.withColumns({
        "_up": F.greatest(change, change * 0), "_down": F.greatest(-change, change * 0),
        "_pos": F.when(tp_change > 0, money).otherwise(0.0), "_neg": F.when(tp_change < 0, money).otherwise(0.0),
        "_bp": close - floor, "_range": roof - floor,
        "_k1": (4 * high - 2 * low + close) / 3, "_k2": (4 * low - 2 * high + close) / 3,
        "_mfv": F.coalesce(ratio((close - low) - (high - close), high - low), F.lit(0.0)) * F.col("volume")})

    def total(c, w):
        return rolling(spec, c, w, F.sum)

    up, down = total("_up", 14), total("_down", 14)
    pos, neg = total("_pos", 14), total("_neg", 14)
    pressure = {w: ratio(total("_bp", w), total("_range", w)) for w in (7, 14, 28)}
    df = df.withColumns({
        "cmo": 100 * ratio(up - down, up + down),
        "mfi": F.when((neg == 0) & (pos > 0), F.lit(100.0)).otherwise(100 - 100 / (1 + ratio(pos, neg))),
        "uo": 100 * (4 * pressure[7] + 2 * pressure[14] + pressure[28]) / 7,
        "keltner_hband": rolling(spec, "_k1", 20, F.avg), "keltner_lband": rolling(spec, "_k2", 20, F.avg),
        "cmf": ratio(total("_mfv", 20), total("volume", 20))})
    return df.drop("_c1", "_tp", "_up", "_down", "_pos", "_neg", "_bp", "_range", "_k1", "_k2", "_mfv")


def commodity_channel(df: DataFrame, spec: SeriesSpec, window: int = 20, scale: float = 0.015) -> DataFrame:
    """Distance of the typical price from its mean, in mean absolute deviations."""
    df = df.withColumn("_tp", (F.col("high") + F.col("low") + F.col("close")) / 3)
    df = df.withColumns({"_mean": rolling(spec, "_tp", window, F.avg),
                         "_frame": F.collect_list("_tp").over(spec.rows(window))})
    deviation = F.aggregate("_frame", F.lit(0.0), lambda acc, v: acc + F.abs(v - F.col("_mean"))) / window
    return df.withColumn("cci", ratio(F.col("_tp") - F.col("_mean"), scale * deviation)).drop("_tp", "_mean", "_frame")


def running_volume(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Running volume signed by falls only, and running volume weighted by returns."""
    previous = spec.lag("close")
    df = df.withColumns({"_flow": F.when(F.col("close") < previous, -F.col("volume")).otherwise(F.col("volume")),
                         "_trend": F.col("volume") * (ratio(F.col("close"), previous) - 1)})
    return running(df, spec, {"obv": ("sum", "_flow"), "vpt": ("sum", "_trend")}).drop("_flow", "_trend")


@dataclass
class Reversal:
    """Where a stop-and-reverse walk stands after a row: direction, level, extreme, speed, and the (high, low) of the last two rows."""

    rising: bool
    level: float
    extreme: float
    speed: float
    recent: tuple[tuple[float, float], ...]

    @classmethod
    def first(cls, high: float, low: float, step: float) -> Reversal:
        return cls(True, low, high, step, ((high, low),))

    def write(self) -> str:
        """The state as text, exact: equal states have equal texts."""
        return json.dumps([self.rising, self.level, self.extreme, self.speed, *[v for pair in self.recent for v in pair]])

    @classmethod
    def read(cls, text: str) -> Reversal:
        rising, level, extreme, speed, *recent = json.loads(text)
        return cls(rising, level, extreme, speed, tuple(zip(recent[::2], recent[1::2])))

    def advance(self, high: float, low: float, step: float, limit: float) -> None:
        level = self.level + self.speed * (self.extreme - self.level)
        level = min(level, *[b for _, b in self.recent]) if self.rising else max(level, *[a for a, _ in self.recent])
        best = high if self.rising else low
        crossed = low < level if self.rising else high > level
        if crossed:
            level, self.extreme, self.speed, self.rising = self.extreme, (low if self.rising else high), step, not self.rising
        elif (best > self.extreme) if self.rising else (best < self.extreme):
            self.extreme, self.speed = best, min(self.speed + step, limit)
        self.level, self.recent = level, (self.recent[-1], (high, low))


def parabolic_sar(df: DataFrame, spec: SeriesSpec, step: float = 0.02, limit: float = 0.2) -> DataFrame:
    """Stop-and-reverse level of series with a bounded number of rows (bars).

    Each level depends on the whole trend state before it, so a series is walked in order: Spark sorts and splits the
    series over tasks, and a task walks its rows batch by batch with four numbers of state. ``parabolic_sar_scan`` walks one
    series in many tasks.
    """
    schema = T.StructType([*df.schema.fields, T.StructField("parabolic_sar", T.DoubleType())])
    keys = list(spec.keys)

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, state = None, None
        for batch in batches:
            out = []
            series = batch.pop("_series")
            for here, high, low in zip(series, batch["high"], batch["low"]):
                if here != key:
                    key, state = here, Reversal.first(high, low, step)
                    out.append(None)
                else:
                    state.advance(high, low, step, limit)
                    out.append(state.level)
            batch["parabolic_sar"] = pd.Series(out, index=batch.index, dtype="float64")
            yield batch

    # One text per key: a missing part of a key is equal to itself there, as in grouping.
    ordered = df.withColumn("_series", F.to_json(F.struct(*keys))).repartition("_series").sortWithinPartitions("_series", *spec.order)
    return ordered.mapInPandas(walk, schema)


def _walk_chunks(rows: DataFrame, step: float, limit: float) -> DataFrame:
    """Walk every (_series, _chunk) of ``rows``: adds the level, and to the last row of a chunk the states it was started from and left in.

    A chunk starts from ``_given``; where that is NULL, from a guess: a walk over the copied rows before it (the halo) from a state of their own.
    """
    names = [f.name for f in rows.schema.fields if f.name != "_given"]
    added = [T.StructField("parabolic_sar", T.DoubleType()), T.StructField("_start", T.StringType()), T.StructField("_end", T.StringType())]
    schema = T.StructType([*[rows.schema[c] for c in names if c != "_last"], *added])

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, state, start = None, None, None
        for batch in batches:
            levels, starts, ends = [], [], []
            given = batch.pop("_given")
            for series, chunk, halo, last, known, high, low in zip(batch["_series"], batch["_chunk"], batch[HALO], batch["_last"], given, batch["high"], batch["low"]):
                fresh = (series, chunk) != at
                if fresh:
                    at, start, state = (series, chunk), None, Reversal.read(known) if isinstance(known, str) else None
                if not halo and start is None:
                    start = state.write() if state else ""
                if state is None:
                    state = Reversal.first(high, low, step)
                    levels.append(None)
                else:
                    state.advance(high, low, step, limit)
                    levels.append(state.level)
                starts.append(start if last else None)
                ends.append(state.write() if last else None)
            out = batch.drop(columns="_last").assign(parabolic_sar=pd.Series(levels, index=batch.index, dtype="float64"),
                                                     _start=pd.Series(starts, index=batch.index, dtype=object), _end=pd.Series(ends, index=batch.index, dtype=object))
            yield out[~batch[HALO]]

    together = rows.repartition("_series", "_chunk").sortWithinPartitions("_series", "_chunk", "_idx")
    # the window finds its rows placed and sorted already
    last = F.lead("_idx").over(W.partitionBy("_series", "_chunk").orderBy("_idx")).isNull()
    return together.withColumn("_last", last).select(*[c for c in names if c != "_last"], "_last", "_given").mapInPandas(walk, schema)


def parabolic_sar_scan(df: DataFrame, spec: SeriesSpec, step: float = 0.02, limit: float = 0.2, chunk_rows: int = CHUNK_ROWS,
                       warm_up: int = 256) -> DataFrame:
    """K10 on series of any length: a scan over chunks that are walked side by side.

    The state after a row depends on all rows before it, yet walks from different states soon fall together (after a reversal or two they are equal to the
    last bit). So every chunk guesses its start by walking the ``warm_up`` rows before it. A table of one (start, end) per chunk then shows which
    guesses were wrong: those that differ from the end of the chunk before. Only these chunks are walked again, from that end, until every start
    is the end before it. A round mends at least the first wrong chunk of each series, so this ends, and the result is that of one walk.
    """
    keys = list(spec.keys)
    plain = SeriesSpec(tuple(keys), spec.ts, spec.tiebreak)
    chunked, _ = split_chunks(index_series(df, plain), plain, max(chunk_rows, warm_up), warm_up)
    rows = chunked.withColumn("_series", F.to_json(F.struct(*keys))).withColumn("_given", F.lit(None).cast("string"))
    walked = [stage(_walk_chunks(rows, step, limit).withColumn("_round", F.lit(0)), "sar")]
    summary = walked[0].where("_end IS NOT NULL").select("_series", "_chunk", "_start", "_end", "_round")
    before = F.lag("_end").over(W.partitionBy("_series").orderBy("_chunk"))  # one row per chunk
    while True:
        summary = stage(summary, "sar-chunks")
        wrong = summary.withColumn("_given", before).where(F.col("_given").isNotNull() & (F.col("_given") != F.col("_start"))).select("_series", "_chunk", "_given")
        if wrong.isEmpty():
            break
        again = walked[0].drop("parabolic_sar", "_start", "_end", "_round").join(wrong, ["_series", "_chunk"])
        walked.append(stage(_walk_chunks(again, step, limit).withColumn("_round", F.lit(len(walked))), "sar"))
        mended = walked[-1].where("_end IS NOT NULL").select("_series", "_chunk", "_start", "_end", "_round")
        summary = summary.join(mended.select("_series", "_chunk"), ["_series", "_chunk"], "left_anti").unionByName(mended)
    out = walked[0]
    if len(walked) > 1:  # of every chunk, the rows of its last round
        last = summary.select(F.col("_series").alias("_s"), F.col("_chunk").alias("_c"), F.col("_round").alias("_r"))
        everything = reduce(DataFrame.unionByName, walked)
        out = everything.join(last, (F.col("_series") == F.col("_s")) & (F.col("_chunk") == F.col("_c")) & (F.col("_round") == F.col("_r")))
    return out.select(*df.columns, "parabolic_sar")


def technical_indicators(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """K1-K20 on one frame (without the state machine of K10)."""
    for step in (averages, rate_of_change, bands, wilder_rsi, macd_lines, ranges, average_true_range, flows,
                 commodity_channel, running_volume):
        df = step(df, spec)
    return df


def add_technical_indicators(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Append the indicators and drop the rows where any of them is still warming up."""
    out = technical_indicators(df, spec)
    return out.na.drop(subset=[c for c in out.columns if c not in df.columns])

"""Ticks to OHLCV bars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.series import SeriesSpec


def arrival_order(df: DataFrame, spec: SeriesSpec) -> Column:
    """One comparable value for (ts, tiebreak).

    A struct would do for all of them, but an aggregate over a struct sorts its input. The common case, a timestamp and
    one integer id, is packed into a decimal (microseconds and id side by side), which keeps the hash aggregation.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    if not spec.tiebreak:
        return F.col(spec.ts)
    if (len(spec.tiebreak) == 1 and isinstance(types[spec.tiebreak[0]], T.IntegralType)
            and isinstance(types[spec.ts], (T.TimestampType, T.TimestampNTZType))):
        micros = F.unix_micros(F.col(spec.ts).cast("timestamp")).cast("decimal(18,0)")
        room = F.lit("20000000000000000000").cast("decimal(20,0)")  # more than twice the largest long
        return micros * room + F.coalesce(F.col(spec.tiebreak[0]), F.lit(0)).cast("decimal(19,0)")
    return F.struct(*spec.order)


def ohlcv_bars(ticks: DataFrame, spec: SeriesSpec, interval: str = "1 hour", price: str = "price",
               volume: str | None = "volume", out_ts: str = "ts") -> DataFrame:
    """One row per key and interval: open, high, low, close, volume, trades.

    A plain aggregation: ticks are combined before the shuffle, so a hot key sends at most one row per interval and
    map task.
    """
    at = arrival_order(ticks, spec)
    bars = ticks.groupBy(*spec.keys, F.window(spec.ts, interval).alias("_w")).agg(
        F.min_by(price, at).alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.max_by(price, at).alias("close"),
        (F.sum(volume) if volume else F.count(price).cast("double")).alias("volume"),
        F.count(price).alias("trades"),
    )
    return bars.select(*spec.keys, F.col("_w.start").alias(out_ts), "open", "high", "low", "close", "volume", "trades")

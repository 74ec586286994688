"""Chart and candlestick patterns as boolean columns on every row.

Fixed values: the comparisons are the definitions of the patterns.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.series import SeriesSpec


def _rising(values: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, [newer > older for newer, older in zip(values, values[1:])])


def _falling(values: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, [newer < older for newer, older in zip(values, values[1:])])


def _history(df: DataFrame, spec: SeriesSpec, columns: tuple[str, ...], depth: int):
    added = {f"_{c}{k}": spec.lag(c, k) for c in columns for k in range(1, depth + 1)}
    back = {c: [F.col(c), *[F.col(f"_{c}{k}") for k in range(1, depth + 1)]] for c in columns}
    return df.withColumns(added), back, list(added)


def chart_patterns(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Shapes of the last four bars; NULL where the series is still too short."""
    df, back, added = _history(df, spec, ("open", "high", "low", "close"), 3)
    c, h, lo, o = back["close"], back["high"], back["low"], back["open"]
    peak, trough = (c[0] < c[1]) & (c[1] > c[2]), (c[0] > c[1]) & (c[1] < c[2])
    return df.withColumns({
        "head_and_shoulders": peak & (c[2] < c[3]),
        "double_top": peak & (c[2] > c[3]),
        "triple_bottom": trough & (c[2] < c[3]),
        "bullish_wedge": _rising(c) & _falling(h),
        "bearish_wedge": _falling(c) & _rising(lo),
        "pennant": _falling(h[:3]) & _rising(lo[:3]),
        "flag": (h[0] < h[1]) & (lo[0] > lo[1]) & _rising([c[0], o[0], c[1], o[1]]),
    }).drop(*added)


def candlestick_patterns(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Shapes of the last three candles; NULL where the series is still too short."""
    df, back, added = _history(df, spec, ("open", "high", "close"), 2)
    o, h, c, low = back["open"], back["high"], back["close"], F.col("low")
    first_mid, previous_mid = (o[2] + c[2]) / 2, (o[1] + c[1]) / 2
    return df.withColumns({
        "doji": F.abs(o[0] - c[0]) <= 0.1 * (h[0] - low),
        "engulfing": _rising([c[0], o[1], c[1], o[0]]),
        "hammer": (c[0] > o[0]) & (low < o[0]) & (c[0] - o[0] >= 2 * (o[0] - low)),
        "morning_star": (c[2] < o[2]) & (c[1] < o[1]) & _rising([c[0], o[0], first_mid]),
        "evening_star": (c[2] > o[2]) & (c[1] > o[1]) & _falling([c[0], o[0], first_mid]),
        "dark_cloud_cover": (c[1] > o[1]) & (o[0] > h[1]) & (c[0] < o[1]) & (c[0] > previous_mid),
    }).drop(*added)

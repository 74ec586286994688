"""Trend, momentum and volume indicators over ordered series.

Every function takes (frame, SeriesSpec) and adds columns. All look-back windows share one partitioning and order, so
Spark plans a single exchange and sort for any number of them. They run on bars directly and on long series through
``series.over_chunks`` with the halo given in ``LOOK_BACK``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.functions.expr import label, ratio
from tideline.series import SeriesSpec, equi_join, ewm, ewm_memory, fill_forward, rolling, running

# Rows before a row that its value can depend on, per operator with its default parameters.
LOOK_BACK = {
    "rsi": 15,
    "moving_averages": 50,
    "macd": ewm_memory(2 / 13, 2 / 27) + ewm_memory(2 / 10),
    "obv": 11,
    "bollinger": 40,
    "roc": 13,
}


def returns(df: DataFrame, spec: SeriesSpec, price: str = "close", out: str = "returns") -> DataFrame:
    """Simple return against the row before."""
    return df.withColumn(out, ratio(F.col(price), spec.lag(price)) - 1)


def vwap(df: DataFrame, spec: SeriesSpec, window: int = 20) -> DataFrame:
    """Volume-weighted average price from the start of the series, and its rolling mean."""
    df = fill_forward(df, spec, ["close", "volume"]).na.drop(subset=["close", "volume"])
    df = running(df, spec, {"_pv": ("sum", F.col("close") * F.col("volume")), "_v": ("sum", "volume")})
    df = df.withColumn("VWAP", ratio("_pv", "_v")).drop("_pv", "_v")
    return df.withColumn("rolling_vwap", rolling(spec, "VWAP", window, F.avg))


def rsi(df: DataFrame, spec: SeriesSpec, window: int = 14) -> DataFrame:
    """Relative strength on simple means; frames may be short at the start, no losses at all give 100."""
    change = F.coalesce(F.col("close") - spec.lag("close"), F.lit(0.0))
    df = df.withColumn("_up", F.greatest(change, F.lit(0.0))).withColumn("_down", F.greatest(-change, F.lit(0.0)))
    frame = spec.rows(window)
    gain, loss = F.avg("_up").over(frame), F.avg("_down").over(frame)
    df = df.withColumn("RSI", F.when(loss == 0, F.lit(100.0)).otherwise(100 - 100 / (1 + ratio(gain, loss))))
    return df.withColumn("rsi_signal", label(
        (F.col("RSI") > 70, "overbought"), (F.col("RSI") < 30, "oversold"), default="neutral")).drop("_up", "_down")


def moving_averages(df: DataFrame, spec: SeriesSpec, short: int = 20, long: int = 50,
                    exponential: bool = False) -> DataFrame:
    """Short and long mean, which of them is higher, and the rows where that changes."""
    if exponential:
        df = ewm(df, spec, {"SMA": ("close", 2 / (short + 1)), "LMA": ("close", 2 / (long + 1))})
    else:
        df = df.withColumns({"SMA": rolling(spec, "close", short, F.avg), "LMA": rolling(spec, "close", long, F.avg)})
    df = df.withColumn("cross_signal", label(
        (F.col("SMA") > F.col("LMA"), "golden_cross"), (F.col("SMA") < F.col("LMA"), "death_cross"),
        default="neutral"))
    return df.withColumn("cross_event", F.coalesce(F.col("cross_signal") != spec.lag("cross_signal"), F.lit(False)))


def macd(df: DataFrame, spec: SeriesSpec, fast: int = 12, slow: int = 26, signal: int = 9) -> DataFrame:
    """Difference of two exponential means, its own exponential mean, and the sign of their gap."""
    df = ewm(df, spec, {"_fast": ("close", 2 / (fast + 1)), "_slow": ("close", 2 / (slow + 1))})
    df = df.withColumn("MACD", F.col("_fast") - F.col("_slow")).drop("_fast", "_slow")
    df = ewm(df, spec, {"Signal_Line": ("MACD", 2 / (signal + 1))})
    df = df.withColumn("MACD_Histogram", F.col("MACD") - F.col("Signal_Line"))
    return df.withColumn("macd_signal", label((F.col("MACD") > F.col("Signal_Line"), "bullish"), default="bearish"))


def obv(df: DataFrame, spec: SeriesSpec, smooth: int = 10) -> DataFrame:
    """Running volume signed by the price change; flat rows add nothing, the first row is NULL."""
    df = df.withColumn("_flow", F.signum(F.col("close") - spec.lag("close")) * F.col("volume"))
    df = running(df, spec, {"OBV": ("sum", "_flow")})
    df = df.withColumn("OBV", F.when(F.col("_flow").isNotNull(), F.col("OBV"))).drop("_flow")
    return df.withColumn("OBV_smoothed", rolling(spec, "OBV", smooth, F.avg))


def bollinger(df: DataFrame, spec: SeriesSpec, window: int = 20) -> DataFrame:
    """Mean +- two sample deviations; width is relative to the middle band."""
    spread = rolling(spec, "close", window, F.stddev_samp)
    df = df.withColumns({"Middle_Band": rolling(spec, "close", window, F.avg), "_s": spread})
    df = df.withColumns({"Upper_Band": F.col("Middle_Band") + 2 * F.col("_s"),
                         "Lower_Band": F.col("Middle_Band") - 2 * F.col("_s")}).drop("_s")
    df = df.withColumn("Band_Width", ratio(F.col("Upper_Band") - F.col("Lower_Band"), "Middle_Band"))
    df = df.withColumn("_w", rolling(spec, "Band_Width", window, F.avg))
    return df.withColumn("band_signal", label(
        (F.col("Band_Width") < F.col("_w"), "squeeze"), (F.col("close") > F.col("Upper_Band"), "breakout"),
        default="normal")).drop("_w")


def momentum(df: DataFrame, spec: SeriesSpec, window: int = 10, causal: bool = False) -> DataFrame:
    """Price change over ``window`` rows, scaled by the largest absolute change.

    The scale is the maximum over the whole series (it looks ahead); ``causal=True`` uses the maximum so far.
    """
    df = df.withColumn("_m", F.col("close") - spec.lag("close", window))
    if causal:
        df = running(df, spec, {"_scale": ("max", F.abs("_m"))})
    else:
        scale = df.groupBy(*spec.keys).agg(F.max(F.abs("_m")).alias("_scale"))
        df = equi_join(df, scale, spec.keys)
    df = df.withColumn("Momentum", ratio("_m", "_scale")).drop("_m", "_scale")
    return df.withColumn("momentum_shift", label((F.col("Momentum") > 0, "up"), default="down"))


def roc(df: DataFrame, spec: SeriesSpec, window: int = 10, smooth: int = 3) -> DataFrame:
    """Percentage change over ``window`` rows, smoothed."""
    df = df.withColumn("_roc", (ratio(F.col("close"), spec.lag("close", window)) - 1) * 100)
    df = df.withColumn("ROC", rolling(spec, "_roc", smooth, F.avg)).drop("_roc")
    return df.withColumn("roc_signal", label(
        (F.col("ROC") > 5, "strong"), (F.col("ROC") < -5, "weak"), default="neutral"))


def rolling_sharpe(df: DataFrame, spec: SeriesSpec, rate: float = 0.01, window: int = 252,
                   smooth: int = 20) -> DataFrame:
    """Annualised Sharpe ratio over the last ``window`` returns, and its rolling mean."""
    df = returns(df, spec, out="_r").withColumn("_x", F.col("_r") - rate / window)
    df = df.withColumn("Sharpe", F.sqrt(F.lit(float(window))) * ratio(
        rolling(spec, "_x", window, F.avg), rolling(spec, "_x", window, F.stddev_samp)))
    return df.withColumn("rolling_sharpe", rolling(spec, "Sharpe", smooth, F.avg)).drop("_r", "_x")


def rolling_alpha_beta(df: DataFrame, spec: SeriesSpec, benchmark: DataFrame, window: int = 60,
                       smooth: int = 20) -> DataFrame:
    """Beta and alpha of returns against benchmark returns over the last ``window`` rows, and their rolling means.

    ``benchmark`` holds one return per time in columns (ts, benchmark_return).
    """
    df = returns(df, spec, out="_r")
    df = equi_join(df, benchmark.select(F.col(spec.ts), F.col("benchmark_return").alias("_b")), [spec.ts])
    df = df.withColumn("_both", F.col("_r").isNotNull() & F.col("_b").isNotNull())
    df = df.withColumns({"_r": F.when(F.col("_both"), F.col("_r")), "_b": F.when(F.col("_both"), F.col("_b"))})
    frame = spec.rows(window)
    full = F.count("_r").over(frame) == window
    df = df.withColumns({
        "beta": F.when(full, ratio(F.covar_samp("_r", "_b").over(frame), F.var_samp("_b").over(frame))),
        "_mr": F.when(full, F.avg("_r").over(frame)), "_mb": F.when(full, F.avg("_b").over(frame))})
    df = df.withColumn("alpha", F.col("_mr") - F.col("beta") * F.col("_mb"))
    return df.withColumns({"rolling_beta": rolling(spec, "beta", smooth, F.avg),
                           "rolling_alpha": rolling(spec, "alpha", smooth, F.avg)}).drop(
        "_r", "_b", "_both", "_mr", "_mb")


def indicator_bundle(df: DataFrame, spec: SeriesSpec, benchmark: DataFrame | None = None) -> DataFrame:
    """All of the above on one frame."""
    for step in (vwap, rsi, moving_averages, macd, obv, bollinger, momentum, roc, rolling_sharpe):
        df = step(df, spec)
    return rolling_alpha_beta(df, spec, benchmark) if benchmark is not None else df

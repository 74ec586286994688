"""Bars, indicators and patterns."""

from __future__ import annotations

from pyspark.sql import functions as F

from tideline.operators import indicators, patterns
from tideline.plans.inputs import (BARS, BARS_SQL, BENCHMARK_SQL, TICKS, TICKS_SQL, bars, benchmark_returns, ewm_sql,
                                   over, r, roll, ticks, tidy)
from tideline.plans.registry import query
from tideline.series import latest, over_chunks, rolling

OUT = ("symbol", "ts")


@query("a0_ohlcv_bars", f"WITH {BARS_SQL} SELECT symbol, ts, {r('open', 'high', 'low', 'close', 'volume')}, trades FROM bars")
def a0_ohlcv_bars(spark, sf):
    return tidy(bars(spark, sf))


@query("ohlcv_bars_sma20", f"WITH {BARS_SQL} SELECT symbol, ts, {r('close', roll('avg', 'close', 20) + ' AS sma_20')} FROM bars")
def ohlcv_bars_sma20(spark, sf):
    return tidy(bars(spark, sf).withColumn("sma_20", rolling(BARS, "close", 20, F.avg)), *OUT, "close", "sma_20")


VWAP_SQL = f"""v AS (SELECT *, sum(close * volume) {over('all')} / nullif(sum(volume) {over('all')}, 0) AS VWAP FROM bars),
vw AS (SELECT *, {roll('avg', 'VWAP', 20)} AS rolling_vwap FROM v)"""


@query("w1_vwap", f"WITH {BARS_SQL}, {VWAP_SQL} SELECT symbol, ts, {r('VWAP', 'rolling_vwap')} FROM vw")
def w1_vwap(spark, sf):
    return tidy(indicators.vwap(bars(spark, sf), BARS), *OUT, "VWAP", "rolling_vwap")


RSI_SQL = f"""d AS (SELECT *, coalesce(close - lag(close) {over()}, 0) AS diff FROM bars),
g AS (SELECT *, avg(greatest(diff, 0)) {over(14)} AS gain, avg(greatest(-diff, 0)) {over(14)} AS loss FROM d),
rs AS (SELECT *, CASE WHEN loss = 0 THEN 100 ELSE 100 - 100 / (1 + gain / loss) END AS RSI FROM g)"""


@query("w2_rsi", f"""WITH {BARS_SQL}, {RSI_SQL} SELECT symbol, ts, {r('RSI')},
  CASE WHEN RSI > 70 THEN 'overbought' WHEN RSI < 30 THEN 'oversold' ELSE 'neutral' END AS rsi_signal FROM rs""")
def w2_rsi(spark, sf):
    return tidy(indicators.rsi(bars(spark, sf), BARS), *OUT, "RSI", "rsi_signal")


@query("w3_moving_averages", f"""WITH {BARS_SQL},
  m AS (SELECT *, {roll('avg', 'close', 20)} AS SMA, {roll('avg', 'close', 50)} AS LMA FROM bars),
  s AS (SELECT *, CASE WHEN SMA > LMA THEN 'golden_cross' WHEN SMA < LMA THEN 'death_cross' ELSE 'neutral' END
        AS cross_signal FROM m)
  SELECT symbol, ts, {r('SMA', 'LMA')}, cross_signal,
         coalesce(cross_signal <> lag(cross_signal) {over()}, false) AS cross_event FROM s""")
def w3_moving_averages(spark, sf):
    return tidy(indicators.moving_averages(bars(spark, sf), BARS), *OUT, "SMA", "LMA", "cross_signal", "cross_event")


@query("w3_moving_averages_exponential", f"""WITH RECURSIVE {BARS_SQL},
  {ewm_sql('e', 'bars', {'SMA': ('close', 2 / 21), 'LMA': ('close', 2 / 51)})}
  SELECT symbol, ts, {r('SMA', 'LMA')},
   CASE WHEN SMA > LMA THEN 'golden_cross' WHEN SMA < LMA THEN 'death_cross' ELSE 'neutral' END AS cross_signal
  FROM e""")
def w3_moving_averages_exponential(spark, sf):
    out = indicators.moving_averages(bars(spark, sf), BARS, exponential=True)
    return tidy(out, *OUT, "SMA", "LMA", "cross_signal")


MACD_SQL = f"""{ewm_sql('e', 'bars', {'fast': ('close', 2 / 13), 'slow': ('close', 2 / 27)})},
lines0 AS (SELECT symbol, ts, fast - slow AS MACD FROM e),
{ewm_sql('sg', 'lines0', {'Signal_Line': ('MACD', 2 / 10)}, keep=('ts', 'MACD'))}"""


@query("w4_macd", f"""WITH RECURSIVE {BARS_SQL}, {MACD_SQL}
  SELECT symbol, ts, {r('MACD', 'Signal_Line', 'MACD - Signal_Line AS MACD_Histogram')},
    CASE WHEN MACD > Signal_Line THEN 'bullish' ELSE 'bearish' END AS macd_signal FROM sg""")
def w4_macd(spark, sf):
    return tidy(indicators.macd(bars(spark, sf), BARS), *OUT, "MACD", "Signal_Line", "MACD_Histogram", "macd_signal")


OBV_SQL = f"""f AS (SELECT *, sign(close - lag(close) {over()}) * volume AS flow FROM bars),
ob AS (SELECT *, CASE WHEN flow IS NOT NULL THEN sum(flow) {over('all')} END AS OBV FROM f),
obs AS (SELECT *, {roll('avg', 'OBV', 10)} AS OBV_smoothed FROM ob)"""


@query("w5_obv", f"WITH {BARS_SQL}, {OBV_SQL} SELECT symbol, ts, {r('OBV', 'OBV_smoothed')} FROM obs")
def w5_obv(spark, sf):
    return tidy(indicators.obv(bars(spark, sf), BARS), *OUT, "OBV", "OBV_smoothed")


BOLL_SQL = f"""m AS (SELECT *, {roll('avg', 'close', 20)} AS Middle_Band, {roll('stddev_samp', 'close', 20)} AS s FROM bars),
bd AS (SELECT *, Middle_Band + 2 * s AS Upper_Band, Middle_Band - 2 * s AS Lower_Band,
        4 * s / nullif(Middle_Band, 0) AS Band_Width FROM m),
bw AS (SELECT *, {roll('avg', 'Band_Width', 20)} AS w FROM bd)"""


@query("w6_bollinger", f"""WITH {BARS_SQL}, {BOLL_SQL}
  SELECT symbol, ts, {r('Middle_Band', 'Upper_Band', 'Lower_Band', 'Band_Width')},
   CASE WHEN Band_Width < w THEN 'squeeze' WHEN close > Upper_Band THEN 'breakout' ELSE 'normal' END AS band_signal
  FROM bw""")
def w6_bollinger(spark, sf):
    return tidy(indicators.bollinger(bars(spark, sf), BARS), *OUT, "Middle_Band", "Upper_Band", "Lower_Band",
                "Band_Width", "band_signal")


@query("w7_momentum", f"""WITH {BARS_SQL}, m AS (SELECT *, close - lag(close, 10) {over()} AS m FROM bars),
  n AS (SELECT *, m / nullif(max(abs(m)) OVER (PARTITION BY symbol), 0) AS Momentum FROM m)
  SELECT symbol, ts, {r('Momentum')}, CASE WHEN Momentum > 0 THEN 'up' ELSE 'down' END AS momentum_shift FROM n""")
def w7_momentum(spark, sf):
    return tidy(indicators.momentum(bars(spark, sf), BARS), *OUT, "Momentum", "momentum_shift")


@query("w7_momentum_causal", f"""WITH {BARS_SQL}, m AS (SELECT *, close - lag(close, 10) {over()} AS m FROM bars)
  SELECT symbol, ts, {r(f"m / nullif(max(abs(m)) {over('all')}, 0) AS Momentum")} FROM m""")
def w7_momentum_causal(spark, sf):
    return tidy(indicators.momentum(bars(spark, sf), BARS, causal=True), *OUT, "Momentum")


@query("w8_roc", f"""WITH {BARS_SQL}, m AS (SELECT *, (close / lag(close, 10) {over()} - 1) * 100 AS x FROM bars),
  n AS (SELECT *, {roll('avg', 'x', 3)} AS ROC FROM m)
  SELECT symbol, ts, {r('ROC')}, CASE WHEN ROC > 5 THEN 'strong' WHEN ROC < -5 THEN 'weak' ELSE 'neutral' END
   AS roc_signal FROM n""")
def w8_roc(spark, sf):
    return tidy(indicators.roc(bars(spark, sf), BARS), *OUT, "ROC", "roc_signal")


@query("w9_rolling_sharpe", f"""WITH {BARS_SQL},
  x AS (SELECT *, close / lag(close) {over()} - 1 - 0.01 / 252 AS x FROM bars),
  s AS (SELECT *, sqrt(252) * ({roll('avg', 'x', 252)}) / ({roll('stddev_samp', 'x', 252)}) AS Sharpe FROM x)
  SELECT symbol, ts, {r('Sharpe', roll('avg', 'Sharpe', 20) + ' AS rolling_sharpe')} FROM s""")
def w9_rolling_sharpe(spark, sf):
    return tidy(indicators.rolling_sharpe(bars(spark, sf), BARS), *OUT, "Sharpe", "rolling_sharpe")


AB_SQL = f"""x AS (SELECT b.*, close / lag(close) {over()} - 1 AS r FROM bars b),
y AS (SELECT x.symbol, x.ts, CASE WHEN benchmark_return IS NOT NULL THEN r END AS r,
       CASE WHEN r IS NOT NULL THEN benchmark_return END AS b FROM x LEFT JOIN bench USING (ts)),
z AS (SELECT *, CASE WHEN count(r) {over(60)} = 60 THEN covar_samp(r, b) {over(60)} / var_samp(b) {over(60)} END AS beta,
       {roll('avg', 'r', 60)} AS mr, {roll('avg', 'b', 60)} AS mb FROM y),
ab AS (SELECT *, mr - beta * mb AS alpha FROM z)"""


@query("w10_rolling_alpha_beta", f"""WITH {BARS_SQL}, {BENCHMARK_SQL}, {AB_SQL}
  SELECT symbol, ts, {r('alpha', 'beta', roll('avg', 'alpha', 20) + ' AS rolling_alpha',
                        roll('avg', 'beta', 20) + ' AS rolling_beta')} FROM ab""")
def w10_rolling_alpha_beta(spark, sf):
    b = bars(spark, sf)
    return tidy(indicators.rolling_alpha_beta(b, BARS, benchmark_returns(b)), *OUT, "alpha", "beta", "rolling_alpha",
                "rolling_beta")


LAGS_SQL = "lg AS (SELECT *, " + ", ".join(
    f"lag({c}, {k}) {over()} AS {c}{k}" for c in ("open", "high", "low", "close") for k in (1, 2, 3)) + " FROM bars)"
CHART_SQL = """
  close < close1 AND close1 > close2 AND close2 < close3 AS head_and_shoulders,
  close < close1 AND close1 > close2 AND close2 > close3 AS double_top,
  close > close1 AND close1 < close2 AND close2 < close3 AS triple_bottom,
  close > close1 AND close1 > close2 AND close2 > close3 AND high < high1 AND high1 < high2 AND high2 < high3
    AS bullish_wedge,
  close < close1 AND close1 < close2 AND close2 < close3 AND low > low1 AND low1 > low2 AND low2 > low3
    AS bearish_wedge,
  high < high1 AND high1 < high2 AND low > low1 AND low1 > low2 AS pennant,
  high < high1 AND low > low1 AND close > open AND open > close1 AND close1 > open1 AS flag"""
CHARTS = ("head_and_shoulders", "double_top", "triple_bottom", "bullish_wedge", "bearish_wedge", "pennant", "flag")
CANDLES = ("doji", "engulfing", "hammer", "morning_star", "evening_star", "dark_cloud_cover")


def as_numbers(df, flags):
    """Flags as 1, 0 or NULL, so that NULL compares alike everywhere."""
    return tidy(df.select(*OUT, *[F.col(c).cast("double") for c in flags]))


@query("w11_chart_patterns", f"""WITH {BARS_SQL}, {LAGS_SQL}, p AS (SELECT symbol, ts, {CHART_SQL} FROM lg)
  SELECT symbol, ts, {r(*CHARTS)} FROM p""")
def w11_chart_patterns(spark, sf):
    return as_numbers(patterns.chart_patterns(bars(spark, sf), BARS), CHARTS)


@query("w12_candlestick_patterns", f"""WITH {BARS_SQL}, {LAGS_SQL}, p AS (SELECT symbol, ts,
  abs(open - close) <= 0.1 * (high - low) AS doji,
  open < close1 AND close1 < open1 AND open1 < close AS engulfing,
  close > open AND low < open AND close - open >= 2 * (open - low) AS hammer,
  close2 < open2 AND close1 < open1 AND close > open AND open > (open2 + close2) / 2 AS morning_star,
  close2 > open2 AND close1 > open1 AND close < open AND open < (open2 + close2) / 2 AS evening_star,
  close1 > open1 AND open > high1 AND close < open1 AND close > (open1 + close1) / 2 AS dark_cloud_cover FROM lg)
  SELECT symbol, ts, {r(*CANDLES)} FROM p""")
def w12_candlestick_patterns(spark, sf):
    return as_numbers(patterns.candlestick_patterns(bars(spark, sf), BARS), CANDLES)


@query("o1_latest", f"""WITH {BARS_SQL}, {LAGS_SQL}, p AS (SELECT symbol, ts, {CHART_SQL} FROM lg)
  SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY ts DESC) = 1""")
def o1_latest(spark, sf):
    """The pattern flags of the newest bar of every symbol."""
    flagged = patterns.chart_patterns(bars(spark, sf), BARS).select(*OUT, *CHARTS)
    return tidy(latest(flagged, BARS))


@query("w13_indicator_bundle", f"""WITH RECURSIVE {BARS_SQL}, {BENCHMARK_SQL}, {VWAP_SQL}, {RSI_SQL}, {MACD_SQL},
  {OBV_SQL}, {BOLL_SQL}, {AB_SQL},
  mo AS (SELECT symbol, ts, close - lag(close, 10) {over()} AS mo FROM bars)
  SELECT symbol, ts, {r('VWAP', 'RSI', 'MACD', 'Signal_Line', 'OBV', 'Upper_Band', 'Lower_Band', 'beta',
                        'mo / max(abs(mo)) OVER (PARTITION BY symbol) AS Momentum')}
  FROM vw JOIN (SELECT symbol, ts, RSI FROM rs) USING (symbol, ts) JOIN (SELECT symbol, ts, MACD, Signal_Line FROM sg) USING (symbol, ts)
    JOIN (SELECT symbol, ts, OBV FROM ob) USING (symbol, ts) JOIN (SELECT symbol, ts, Upper_Band, Lower_Band FROM bd) USING (symbol, ts)
    JOIN (SELECT symbol, ts, beta FROM ab) USING (symbol, ts) JOIN mo USING (symbol, ts)""")
def w13_indicator_bundle(spark, sf):
    b = bars(spark, sf)
    out = indicators.indicator_bundle(b, BARS, benchmark_returns(b))
    return tidy(out, *OUT, "VWAP", "RSI", "MACD", "Signal_Line", "OBV", "Upper_Band", "Lower_Band", "beta", "Momentum")


# ---------------------------------------------------------------- the same operators on raw ticks, split into chunks

TICK = over(order="ts, event_id")


@query("w2_rsi_ticks", f"""WITH {TICKS_SQL},
  d AS (SELECT *, coalesce(price - lag(price) {over(order='ts, event_id')}, 0) AS diff FROM ticks),
  g AS (SELECT *, avg(greatest(diff, 0)) {over(14, order='ts, event_id')} AS gain,
         avg(greatest(-diff, 0)) {over(14, order='ts, event_id')} AS loss FROM d)
  SELECT event_id, symbol, {r('CASE WHEN loss = 0 THEN 100 ELSE 100 - 100 / (1 + gain / loss) END AS RSI')} FROM g""")
def w2_rsi_ticks(spark, sf):
    t = ticks(spark, sf).withColumnRenamed("price", "close")
    return tidy(over_chunks(t, TICKS, indicators.rsi, halo=indicators.LOOK_BACK["rsi"]),
                "event_id", "symbol", "RSI")


@query("w3_moving_averages_ticks", f"""WITH {TICKS_SQL}
  SELECT event_id, symbol, {r(roll('avg', 'price', 20, order='ts, event_id') + ' AS SMA',
                              roll('avg', 'price', 50, order='ts, event_id') + ' AS LMA')} FROM ticks""")
def w3_moving_averages_ticks(spark, sf):
    t = ticks(spark, sf).withColumnRenamed("price", "close")
    return tidy(over_chunks(t, TICKS, indicators.moving_averages, halo=indicators.LOOK_BACK["moving_averages"]), "event_id", "symbol", "SMA", "LMA")


@query("w5_obv_ticks", f"""WITH {TICKS_SQL},
  f AS (SELECT *, sign(price - lag(price) {TICK}) * volume AS flow FROM ticks),
  o AS (SELECT *, CASE WHEN flow IS NOT NULL THEN sum(flow) {over('all', order='ts, event_id')} END AS OBV FROM f)
  SELECT event_id, symbol, {r('OBV', roll('avg', 'OBV', 10, order='ts, event_id') + ' AS OBV_smoothed')} FROM o""")
def w5_obv_ticks(spark, sf):
    t = ticks(spark, sf).withColumnRenamed("price", "close")
    return tidy(over_chunks(t, TICKS, indicators.obv, halo=indicators.LOOK_BACK["obv"]),
                "event_id", "symbol", "OBV", "OBV_smoothed")

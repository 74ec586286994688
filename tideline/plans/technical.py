"""The published indicator set on hourly bars."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from tideline.operators import technical
from tideline.plans.inputs import BARS, BARS_SQL, TICKS, TICKS_SQL, bars, ewm_sql, over, r, roll, ticks, tidy
from tideline.plans.registry import query

OUT = ("symbol", "ts")
PC = f"lag(close) {over()}"


def _register(name: str, step, columns: tuple[str, ...], ctes: str, source: str, recursive: bool = False,
              exprs: tuple[str, ...] = (), digits: int = 6):
    sql = f"""WITH {'RECURSIVE ' if recursive else ''}{BARS_SQL}, {ctes}
      SELECT symbol, ts, {r(*(exprs or columns), digits=digits)} FROM {source}"""

    @query(name, sql)
    def run(spark, sf):
        return tidy(step(bars(spark, sf), BARS), *OUT, *columns, digits=digits)


_register("k1_sma", technical.averages, ("sma_10", "sma_50"),
          f"x AS (SELECT symbol, ts, {roll('avg', 'close', 10)} AS sma_10, {roll('avg', 'close', 50)} AS sma_50 FROM bars)", "x")

_register("k2_ema", technical.averages, ("ema_10", "ema_50"),
          ewm_sql("e", "bars", {"a": ("close", 2 / 11), "b": ("close", 2 / 51)}), "e", True,
          ("CASE WHEN rn >= 10 THEN a END AS ema_10", "CASE WHEN rn >= 50 THEN b END AS ema_50"))

_register("k3_rate_of_change", technical.rate_of_change, ("momentum", "proc"),
          f"x AS (SELECT symbol, ts, (close / lag(close, 4) {over()} - 1) * 100 AS momentum, (close / lag(close, 12) {over()} - 1) * 100 AS proc FROM bars)", "x")

_register("k4_bands", technical.bands, ("volatility", "bollinger_hband", "bollinger_lband", "volatility_std"),
          f"""r0 AS (SELECT *, close / {PC} - 1 AS ret FROM bars), x AS (SELECT symbol, ts,
          {roll('avg', 'close', 10)} + 2 * ({roll('stddev_pop', 'close', 10)}) AS volatility,
          {roll('avg', 'close', 20)} + 2 * ({roll('stddev_pop', 'close', 20)}) AS bollinger_hband,
          {roll('avg', 'close', 20)} - 2 * ({roll('stddev_pop', 'close', 20)}) AS bollinger_lband,
          {roll('stddev_samp', 'ret', 10)} AS volatility_std FROM r0)""", "x")

_register("k5_rsi", technical.wilder_rsi, ("rsi",),
          f"""d AS (SELECT symbol, ts, greatest(coalesce(close - {PC}, 0), 0) AS up, greatest(coalesce({PC} - close, 0), 0) AS down FROM bars),
          {ewm_sql('e', 'd', {'gain': ('up', 1 / 14), 'loss': ('down', 1 / 14)})}""", "e", True,
          ("CASE WHEN rn >= 14 THEN CASE WHEN loss = 0 THEN 100 ELSE 100 - 100 / (1 + gain / loss) END END AS rsi",))

_register("k6_macd", technical.macd_lines, ("macd", "macd_signal", "macd_diff"),
          f"""{ewm_sql('e', 'bars', {'f': ('close', 2 / 13), 's': ('close', 2 / 27)})},
          late AS (SELECT symbol, ts, f - s AS macd FROM e WHERE rn >= 26),
          {ewm_sql('g', 'late', {'sig': ('macd', 2 / 10)}, keep=('ts', 'macd'))},
          x AS (SELECT symbol, ts, macd, CASE WHEN rn >= 9 THEN sig END AS macd_signal
                FROM bars LEFT JOIN (SELECT symbol, ts, rn, macd, sig FROM g) USING (symbol, ts))""", "x", True,
          ("macd", "macd_signal", "macd - macd_signal AS macd_diff"))

_HL = ", ".join(f"{roll('max', 'high', w)} AS h{w}, {roll('min', 'low', w)} AS l{w}" for w in (9, 14, 20, 26, 52))
_RANGES = f"x AS (SELECT symbol, ts, close, {_HL} FROM bars)"
_register("k7_stoch", technical.ranges, ("stoch",), _RANGES, "x", False,
          ("100 * (close - l14) / nullif(h14 - l14, 0) AS stoch",))
_register("k8_williams_r", technical.ranges, ("williams_r",), _RANGES, "x", False,
          ("-100 * (h14 - close) / nullif(h14 - l14, 0) AS williams_r",))
_register("k9_ichimoku", technical.ranges, ("ichimoku_a", "ichimoku_b"), _RANGES, "x", False,
          ("((h9 + l9) / 2 + (h26 + l26) / 2) / 2 AS ichimoku_a", "(h52 + l52) / 2 AS ichimoku_b"))
_FIB = tuple(f"fib_{str(p).replace('.', '_')}" for p in technical.FIBONACCI)
_register("k11_fibonacci", technical.ranges, _FIB, _RANGES, "x", False,
          tuple(f"h20 - (h20 - l20) * {p / 100} AS {n}" for p, n in zip(technical.FIBONACCI, _FIB)))

_register("k12_atr", technical.average_true_range, ("atr",),
          f"""tr AS (SELECT symbol, ts, row_number() {over()} AS pos,
             greatest(high - low, abs(high - {PC}), abs(low - {PC})) AS tr FROM bars),
          sd AS (SELECT symbol, ts, CASE WHEN pos = 14 THEN avg(tr) {over(14)} ELSE tr END AS seed, pos FROM tr),
          sd2 AS (SELECT symbol, ts, seed FROM sd WHERE pos >= 14),
          {ewm_sql('e', 'sd2', {'atr': ('seed', 1 / 14)})},
          x AS (SELECT symbol, ts, atr FROM bars LEFT JOIN (SELECT symbol, ts, atr FROM e) USING (symbol, ts))""", "x", True)

_FLOWS = f"""f0 AS (SELECT *, {PC} AS c1, (high + low + close) / 3 AS tp FROM bars),
f1 AS (SELECT *, tp - lag(tp) {over()} AS dtp, close - c1 AS ch FROM f0),
f2 AS (SELECT *, CASE WHEN ch > 0 THEN ch WHEN ch <= 0 THEN 0 END AS up, CASE WHEN ch < 0 THEN -ch WHEN ch >= 0 THEN 0 END AS down,
  CASE WHEN dtp > 0 THEN tp * volume ELSE 0 END AS pos, CASE WHEN dtp < 0 THEN tp * volume ELSE 0 END AS neg,
  close - least(low, c1) AS bp, greatest(high, c1) - least(low, c1) AS rg,
  (4 * high - 2 * low + close) / 3 AS k1, (4 * low - 2 * high + close) / 3 AS k2,
  CASE WHEN high = low THEN 0 ELSE ((close - low) - (high - close)) / (high - low) END * volume AS mfv FROM f1),
x AS (SELECT symbol, ts, {roll('sum', 'up', 14)} AS u14, {roll('sum', 'down', 14)} AS d14,
  {roll('sum', 'pos', 14)} AS p14, {roll('sum', 'neg', 14)} AS n14,
  ({roll('sum', 'bp', 7)}) / nullif({roll('sum', 'rg', 7)}, 0) AS a7,
  ({roll('sum', 'bp', 14)}) / nullif({roll('sum', 'rg', 14)}, 0) AS a14,
  ({roll('sum', 'bp', 28)}) / nullif({roll('sum', 'rg', 28)}, 0) AS a28,
  {roll('avg', 'k1', 20)} AS keltner_hband, {roll('avg', 'k2', 20)} AS keltner_lband,
  {roll('sum', 'mfv', 20)} AS m20, {roll('sum', 'volume', 20)} AS v20 FROM f2)"""
_register("k13_cmo", technical.flows, ("cmo",), _FLOWS, "x", False, ("100 * (u14 - d14) / nullif(u14 + d14, 0) AS cmo",))
_register("k15_mfi", technical.flows, ("mfi",), _FLOWS, "x", False,
          ("CASE WHEN n14 = 0 AND p14 > 0 THEN 100 ELSE 100 - 100 / (1 + p14 / nullif(n14, 0)) END AS mfi",))
_register("k17_uo", technical.flows, ("uo",), _FLOWS, "x", False, ("100 * (4 * a7 + 2 * a14 + a28) / 7 AS uo",))
_register("k19_keltner", technical.flows, ("keltner_hband", "keltner_lband"), _FLOWS, "x")
_register("k20_cmf", technical.flows, ("cmf",), _FLOWS, "x", False, ("m20 / nullif(v20, 0) AS cmf",))

_register("k14_cci", technical.commodity_channel, ("cci",),
          f"""t AS (SELECT *, (high + low + close) / 3 AS tp FROM bars),
          l AS (SELECT *, list(tp) {over(20)} AS frame, {roll('avg', 'tp', 20)} AS mean FROM t),
          x AS (SELECT *, list_sum(list_transform(frame, lambda v: abs(v - mean))) / 20 AS mad FROM l)""",
          "x", False, ("(tp - mean) / nullif(0.015 * mad, 0) AS cci",))

_register("k16_obv", technical.running_volume, ("obv",),
          f"""f AS (SELECT *, CASE WHEN close < {PC} THEN -volume ELSE volume END AS flow FROM bars),
          x AS (SELECT symbol, ts, sum(flow) {over('all')} AS obv FROM f)""", "x")
_register("k18_vpt", technical.running_volume, ("vpt",),
          f"""f AS (SELECT *, volume * (close / {PC} - 1) AS flow FROM bars),
          x AS (SELECT symbol, ts, sum(flow) {over('all')} AS vpt FROM f)""", "x", digits=3)


def sar_sql(source: str, row: str, order: str = "ts") -> str:
    """The walk over ``source`` (symbol, high, low, and ``row``) as a recursion along its row numbers: tables n and w."""
    here = over(order=order)
    return f"""n AS (SELECT symbol, {row}, high, low, row_number() {here} AS rn, lag(high) {here} AS h1, lag(low) {here} AS l1,
        lag(high, 2) {here} AS h2, lag(low, 2) {here} AS l2 FROM {source}),
  w AS (
    SELECT symbol, rn, {row}, true AS rising, low AS level, high AS extreme, CAST(0.02 AS DOUBLE) AS speed FROM n WHERE rn = 1
    UNION ALL
    SELECT symbol, rn, {row},
      rising <> crossed AS rising, CASE WHEN crossed THEN extreme ELSE lv END AS level,
      CASE WHEN crossed THEN CASE WHEN rising THEN low ELSE high END
           WHEN rising THEN greatest(extreme, high) ELSE least(extreme, low) END AS extreme,
      CASE WHEN crossed THEN CAST(0.02 AS DOUBLE)
           WHEN (rising AND high > extreme) OR (NOT rising AND low < extreme) THEN least(speed + 0.02, 0.2) ELSE speed END AS speed
    FROM (SELECT *, CASE WHEN rising THEN low < lv ELSE high > lv END AS crossed
          FROM (SELECT n.*, w.rising, w.extreme, w.speed,
                  CASE WHEN w.rising THEN least(w.level + w.speed * (w.extreme - w.level), n.l1, n.l2)
                       ELSE greatest(w.level + w.speed * (w.extreme - w.level), n.h1, n.h2) END AS lv
                FROM w JOIN n ON n.symbol = w.symbol AND n.rn = w.rn + 1)))"""


@query("k10_parabolic_sar", f"""WITH RECURSIVE {BARS_SQL}, {sar_sql('bars', 'ts')}
  SELECT symbol, ts, {r('CASE WHEN rn > 1 THEN level END AS parabolic_sar')} FROM w""")
def k10_parabolic_sar(spark, sf):
    b = bars(spark, sf).select("symbol", "ts", "high", "low")
    return tidy(technical.parabolic_sar(b, BARS), *OUT, "parabolic_sar")


@query("k10_parabolic_sar_ticks", f"""WITH RECURSIVE {TICKS_SQL}, spread AS (SELECT symbol, ts, event_id, price + volume / 100 AS high, price - volume / 100 AS low FROM ticks),
  {sar_sql('spread', 'event_id', 'ts, event_id')}
  SELECT symbol, event_id, {r('CASE WHEN rn > 1 THEN level END AS parabolic_sar')} FROM w""")
def k10_parabolic_sar_ticks(spark, sf):
    """Raw ticks, each with a spread that follows its size: one series over many tasks. Short chunks, so that small tables have several too."""
    t = ticks(spark, sf).select("symbol", "ts", "event_id", (F.col("price") + F.col("volume") / 100).alias("high"), (F.col("price") - F.col("volume") / 100).alias("low"))
    return tidy(technical.parabolic_sar_scan(t, TICKS, chunk_rows=1000), "symbol", "event_id", "parabolic_sar")


@query("k21_add_technical_indicators", f"""WITH RECURSIVE {BARS_SQL},
  {_FLOWS.replace('x AS (', 'fl AS (')},
  v AS (SELECT symbol, ts, count(*) {over('all')} AS n, volume, high, low FROM bars)
  SELECT symbol, ts, {r('100 * (u14 - d14) / nullif(u14 + d14, 0) AS cmo', '100 * (4 * a7 + 2 * a14 + a28) / 7 AS uo')}
  FROM fl JOIN v USING (symbol, ts) WHERE n >= 52 AND v20 <> 0 AND u14 + d14 <> 0""")
def k21_add_technical_indicators(spark, sf):
    """Only rows with every indicator known remain: the longest warm-up is 52 bars."""
    return tidy(technical.add_technical_indicators(bars(spark, sf), BARS), *OUT, "cmo", "uo")

"""Risk metrics, correlations, alerts, scenarios, strategy."""

from __future__ import annotations

from pyspark.sql import functions as F

from tideline.operators import risk, strategy, technical
from tideline.plans.inputs import (BARS, BARS_SQL, BENCHMARK_SQL, TICKS, TICKS_SQL, bars, benchmark_returns, over, r,
                                   roll, ticks, tidy)
from tideline.plans.registry import query
from tideline.series import drop_halo, index_series, split_chunks

RETURNS_SQL = f"""x AS (SELECT b.*, close / lag(close) {over()} - 1 AS r, lag(close) {over()} AS pc FROM bars b),
rt AS (SELECT x.*, benchmark_return AS b,
        close / max(CASE WHEN pc IS NOT NULL THEN close END) {over('all')} - 1 AS dd
       FROM x LEFT JOIN bench USING (ts)),
q AS (SELECT symbol, quantile_cont(r, 1 - 0.95) AS var FROM rt GROUP BY symbol),
m AS (SELECT symbol, any_value(var) AS var, avg(r) FILTER (r <= var) AS cvar,
  (avg(r) - 0.01 / 252) / stddev_pop(r) AS sharpe,
  (avg(r) - 0.01 / 252) / stddev_pop(r) FILTER (r < 0) AS sortino,
  min(dd) AS max_drawdown, covar_samp(r, b) / var_samp(b) AS beta,
  avg(r - b) / stddev_pop(r - b) AS information_ratio,
  sum(r) FILTER (r > 0) / -sum(r) FILTER (r <= 0) AS omega,
  sqrt(avg(dd * dd)) AS ulcer_index, stddev_pop(r - b) AS tracking_error,
  avg(r) FILTER (b IS NOT NULL) AS pr, avg(b) AS pb, count(r) AS n_returns
  FROM rt JOIN q USING (symbol) WHERE r IS NOT NULL GROUP BY symbol),
metrics AS (SELECT *, pr - 0.01 / 252 - beta * (pb - 0.01 / 252) AS jensens_alpha FROM m)"""
RISK_SQL = f"WITH {BARS_SQL}, {BENCHMARK_SQL}, {RETURNS_SQL}"


def _metrics(spark, sf):
    b = bars(spark, sf)
    return risk.risk_metrics(b, BARS, benchmark_returns(b))


@query("r12_risk_metrics", f"{RISK_SQL} SELECT symbol, {r(*risk.METRICS)}, n_returns FROM metrics")
def r12_risk_metrics(spark, sf):
    return tidy(_metrics(spark, sf))


def _single(number: int, metric: str) -> None:
    """R1-R11 alone: Catalyst drops the aggregates and joins the one metric does not need."""

    @query(f"r{number}_{metric}", f"{RISK_SQL} SELECT symbol, {r(metric)} FROM metrics")
    def run(spark, sf):
        return tidy(_metrics(spark, sf), "symbol", metric)


for _number, _metric in enumerate(risk.METRICS, start=1):
    _single(_number, _metric)


@query("r12_risk_metrics_ticks", f"""WITH {TICKS_SQL},
  x AS (SELECT *, price / nullif(lag(price) {over(order='ts, event_id')}, 0) - 1 AS r FROM ticks),
  rt AS (SELECT *, price / max(CASE WHEN r IS NOT NULL THEN price END) {over('all', order='ts, event_id')} - 1 AS dd FROM x),
  q AS (SELECT symbol, quantile_cont(r, 1 - 0.95) AS var FROM rt GROUP BY symbol)
  SELECT symbol, {r('any_value(var) AS var', 'avg(r) FILTER (r <= var) AS cvar', 'min(dd) AS max_drawdown',
                    'sqrt(avg(dd * dd)) AS ulcer_index', '(avg(r) - 0.01 / 252) / stddev_pop(r) AS sharpe', digits=5)},
    count(r) AS n_returns FROM rt JOIN q USING (symbol) WHERE r IS NOT NULL GROUP BY symbol""")
def r12_risk_metrics_ticks(spark, sf):
    """Raw ticks: the series is split into chunks and the quantile comes from sorted positions."""
    indexed = index_series(ticks(spark, sf), TICKS)
    chunked, spec = split_chunks(indexed, TICKS, halo=1)
    frame = drop_halo(risk.return_frame(chunked, spec, "price"))
    frame = frame.select("symbol", "r", "dd", F.lit(None).cast("double").alias("b"))
    out = risk.summarise(frame, ["symbol"])
    return tidy(out, "symbol", "var", "cvar", "max_drawdown", "ulcer_index", "sharpe", "n_returns", digits=5)


@query("a10_beta_alpha", f"""{RISK_SQL} SELECT symbol, {r('covar_samp(r, b) / var_samp(b) AS beta',
  'avg(r) - covar_samp(r, b) / var_samp(b) * avg(b) AS alpha')} FROM rt
  WHERE r IS NOT NULL AND b IS NOT NULL GROUP BY symbol""")
def a10_beta_alpha(spark, sf):
    b = bars(spark, sf)
    frame = risk.align_benchmark(risk.return_frame(b, BARS), benchmark_returns(b), "ts")
    return tidy(risk.beta_alpha(frame, ["symbol"]))


@query("j7_benchmark_align", f"{RISK_SQL} SELECT symbol, ts, {r('r', 'b')} FROM rt WHERE r IS NOT NULL")
def j7_benchmark_align(spark, sf):
    b = bars(spark, sf)
    frame = risk.align_benchmark(risk.return_frame(b, BARS), benchmark_returns(b), "ts")
    return tidy(frame, "symbol", "ts", "r", "b")


@query("p15_returns", f"WITH {BARS_SQL} SELECT symbol, ts, {r(f'close / lag(close) {over()} - 1 AS returns')} FROM bars")
def p15_returns(spark, sf):
    from tideline.operators.indicators import returns
    return tidy(returns(bars(spark, sf), BARS), "symbol", "ts", "returns")


COLUMNS = ("open", "high", "low", "close", "volume")
_PAIRS_SQL = " UNION ALL ".join(
    f"SELECT symbol, '{x}' AS x, '{y}' AS y, {r(f'corr({x}, {y}) AS corr') if x != y else '1.0 AS corr'} FROM bars GROUP BY symbol"
    for x in COLUMNS for y in COLUMNS)


@query("a9_correlation_matrix", f"WITH {BARS_SQL} {_PAIRS_SQL}")
def a9_correlation_matrix(spark, sf):
    return tidy(risk.correlation_matrix(bars(spark, sf), COLUMNS, ["symbol"]))


@query("p10_stop_take_levels", f"""WITH {BARS_SQL}, x AS (SELECT *, close / lag(close) {over()} - 1 AS r FROM bars),
  v AS (SELECT *, {roll('stddev_samp', 'r', 10)} AS v FROM x)
  SELECT symbol, ts, {r('close - 1.5 * v AS stop_loss', 'close + 2 * v AS take_profit')} FROM v""")
def p10_stop_take_levels(spark, sf):
    b = technical.bands(bars(spark, sf), BARS)
    return tidy(risk.stop_take_levels(b), "symbol", "ts", "stop_loss", "take_profit")


_ALERTS_SQL = " UNION ALL ".join(
    f"""SELECT symbol, '{t.metric}' AS metric, '{t.op}' AS op, CAST({t.limit} AS DOUBLE) AS "limit", {r(f'{t.metric} AS value')}
    FROM metrics WHERE {t.metric} {t.op} {t.limit}""" for t in risk.RISK_THRESHOLDS)


@query("p16_threshold_alerts", f"{RISK_SQL} {_ALERTS_SQL}")
def p16_threshold_alerts(spark, sf):
    return tidy(risk.threshold_alerts(_metrics(spark, sf), ["symbol"]))


@query("p16_risk_verdict", f"""{RISK_SQL} SELECT symbol,
  NOT (max_drawdown < -0.15 OR sharpe < 1.5 OR sortino < 1.5) AS acceptable FROM metrics""")
def p16_risk_verdict(spark, sf):
    return risk.risk_verdict(_metrics(spark, sf)).select("symbol", "acceptable")


# ---------------------------------------------------------------- scenarios

def _uniform(tag: str) -> str:
    """SQL of ``hash_uniform`` on (symbol, time, scenario, seed, tag)."""
    text = f"concat_ws('|', symbol, epoch_us(ts), scenario, 0, '{tag}')"
    return f"(CAST(('0x' || substr(md5({text}), 1, 13)) AS BIGINT) / 4503599627370496.0)"


_NORMAL = f"(sqrt(-2 * ln(1 - {_uniform('a')})) * cos(6.283185307179586 * {_uniform('b')}))"
_SCENARIO_ROWS = ", ".join(f"('{s.name}', {s.factor}, {s.sigma}, {s.share})" for s in risk.SCENARIOS)
SHOCKED_SQL = f"""sc(scenario, factor, sigma, share) AS (VALUES {_SCENARIO_ROWS}),
sh AS (SELECT symbol, scenario, ts,
   CASE WHEN share < 1 AND {_uniform('u')} >= share THEN close ELSE close * factor END
   * CASE WHEN sigma <> 0 THEN 1 + sigma * {_NORMAL} ELSE 1 END AS close
   FROM bars, sc)"""


@query("b3_scenario_prices", f"WITH {BARS_SQL}, {SHOCKED_SQL} SELECT symbol, scenario, ts, {r('close')} FROM sh")
def b3_scenario_prices(spark, sf):
    return tidy(risk.apply_scenarios(bars(spark, sf), BARS), "symbol", "scenario", "ts", "close")


@query("b3_stress_scenarios", f"""WITH {BARS_SQL}, {SHOCKED_SQL},
  x AS (SELECT *, close / lag(close) {over(key='symbol, scenario')} - 1 AS r FROM sh),
  rt AS (SELECT *, close / max(CASE WHEN r IS NOT NULL THEN close END) {over('all', key='symbol, scenario')} - 1 AS dd FROM x),
  q AS (SELECT symbol, scenario, quantile_cont(r, 1 - 0.95) AS var FROM rt GROUP BY ALL)
  SELECT symbol, scenario, {r('any_value(var) AS var', 'avg(r) FILTER (r <= var) AS cvar',
     '(avg(r) - 0.01 / 252) / stddev_pop(r) AS sharpe',
     '(avg(r) - 0.01 / 252) / stddev_pop(r) FILTER (r < 0) AS sortino', 'min(dd) AS max_drawdown',
     'sum(r) FILTER (r > 0) / -sum(r) FILTER (r <= 0) AS omega', 'sqrt(avg(dd * dd)) AS ulcer_index')},
    count(r) AS n_returns FROM rt JOIN q USING (symbol, scenario) WHERE r IS NOT NULL GROUP BY symbol, scenario""")
def b3_stress_scenarios(spark, sf):
    return tidy(risk.stress_scenarios(bars(spark, sf), BARS), "symbol", "scenario", "var", "cvar", "sharpe", "sortino",
                "max_drawdown", "omega", "ulcer_index", "n_returns")


# ---------------------------------------------------------------- strategy

def _signals(spark, sf):
    b = bars(spark, sf).select("symbol", "ts", F.col("close").alias("price"))
    b = b.withColumn("signal", strategy.crossing_signal(BARS, "price", 5, 20))
    return strategy.signal_shift(b, BARS)


def ledger_sql(source: str, name: str, key: str = "symbol", cost: str = "0.001") -> str:
    return f"""{name}1 AS (SELECT *, lag(price) {over(key=key)} AS pb FROM {source} WHERE price > 0),
{name}2 AS (SELECT *, coalesce(last_value(CASE WHEN pb IS NOT NULL AND signal <> 0 THEN CAST(signal > 0 AS INTEGER) END
        IGNORE NULLS) {over('all', key=key)}, 0) AS held FROM {name}1),
{name}3 AS (SELECT *, coalesce(lag(held) {over(key=key)}, 0) AS was FROM {name}2),
{name}4 AS (SELECT *, 10000 * exp(sum(CASE WHEN was = 1 THEN ln(price / pb) ELSE 0 END
        + CASE WHEN held <> was THEN ln(1 - {cost}) ELSE 0 END) {over('all', key=key)}) AS total FROM {name}3),
{name} AS (SELECT *, CASE WHEN held > was THEN 'buy' WHEN held < was THEN 'sell' END AS trade,
        CASE WHEN held = 1 THEN 0 ELSE total END AS balance, CASE WHEN held = 1 THEN total ELSE 0 END AS holdings,
        CASE WHEN held = 1 THEN total / price ELSE 0 END AS units FROM {name}4)"""


SIGNALS_SQL = f"""s0 AS (SELECT symbol, ts, close AS price,
   coalesce(sign(round({roll('avg', 'close', 5)} - {roll('avg', 'close', 20)}, 9)), 0) AS signal FROM bars),
signals AS (SELECT symbol, ts, price, lag(signal) {over()} AS signal FROM s0)"""
LEDGER_SQL = f"{SIGNALS_SQL}, {ledger_sql('signals', 'ledger')}"


@query("f5_signal_shift", f"WITH {BARS_SQL}, {SIGNALS_SQL} SELECT symbol, ts, {r('price', 'signal')} FROM signals")
def f5_signal_shift(spark, sf):
    return tidy(_signals(spark, sf))


@query("b1_equity_ledger", f"""WITH {BARS_SQL}, {LEDGER_SQL}
  SELECT symbol, ts, trade, {r('ln(total) AS log_total', 'balance / total AS cash_share', 'holdings / total AS held_share',
                               'ln(1 + units) AS log_units')} FROM ledger""")
def b1_equity_ledger(spark, sf):
    """Money columns as logs and shares: the equity spans many orders of magnitude, and rounding must not."""
    out = strategy.equity_ledger(_signals(spark, sf), BARS)
    out = out.select("symbol", "ts", "trade", F.log("total").alias("log_total"),
                     (F.col("balance") / F.col("total")).alias("cash_share"),
                     (F.col("holdings") / F.col("total")).alias("held_share"), F.log1p("units").alias("log_units"))
    return tidy(out)


@query("b1_trades", f"""WITH {BARS_SQL}, {LEDGER_SQL}
  SELECT symbol, ts, trade, {r('price')} FROM ledger WHERE trade IS NOT NULL""")
def b1_trades(spark, sf):
    return tidy(strategy.trades(strategy.equity_ledger(_signals(spark, sf), BARS)), "symbol", "ts", "trade", "price")


def performance_sql(source: str, key: str = "symbol") -> str:
    return f"""p1 AS (SELECT *, CASE WHEN held = 0 AND was = 0 AND pb IS NOT NULL THEN total * 0 ELSE total / lag(total) {over(key=key)} - 1 END AS ret, max(total) {over('all', key=key)} AS top
       FROM {source}),
p2 AS (SELECT {key}, count(*) AS n_rows, last(total ORDER BY ts) / first(total ORDER BY ts) - 1 AS cumulative_return,
   last(total ORDER BY ts) / first(total ORDER BY ts) AS total_ratio,
   stddev_samp(ret) * sqrt(252) AS annualized_volatility, stddev_samp(ret) FILTER (ret < 0) * sqrt(252) AS downside,
   max(top - total) AS max_drawdown, max(1 - total / top) AS max_drawdown_relative, count(trade) AS n_trades,
   avg((price - signal) ** 2) AS mse, avg(abs(price - signal) / abs(price)) FILTER (price <> 0) AS mape,
   1 - avg((price - signal) ** 2) / var_pop(price) FILTER (signal IS NOT NULL) AS r2,
   1 - var_pop(price - signal) / var_pop(price) FILTER (signal IS NOT NULL) AS explained_variance
   FROM p1 GROUP BY {key}),
perf AS (SELECT *, annualized_return / nullif(annualized_volatility, 0) AS sharpe_ratio, annualized_return / nullif(downside, 0) AS sortino_ratio,
   annualized_return / nullif(max_drawdown, 0) AS calmar_ratio
   FROM (SELECT *, pow(1 + cumulative_return, 252.0 / n_rows) - 1 AS annualized_return FROM p2))"""


PERFORMANCE = ("annualized_volatility", "max_drawdown_relative")
# Returns of short, wild series reach 1e8 and more, where six digits after the point are below a double's precision:
# these four are compared as sign(x) * ln(1 + |x|).
GROWTH = ("annualized_return", "sharpe_ratio", "sortino_ratio", "calmar_ratio")
GROWTH_SQL = [f"sign({c}) * ln(1 + abs({c})) AS log_{c}" for c in GROWTH]


def with_logs(df):
    return df.withColumns({f"log_{c}": F.signum(c) * F.log1p(F.abs(c)) for c in GROWTH})


LOGS = tuple(f"log_{c}" for c in GROWTH)


@query("r13_strategy_metrics", f"""WITH {BARS_SQL}, {LEDGER_SQL}, {performance_sql('ledger')}
  SELECT symbol, n_rows, n_trades, {r(*PERFORMANCE, *GROWTH_SQL, 'ln(total_ratio) AS log_growth')} FROM perf""")
def r13_strategy_metrics(spark, sf):
    out = strategy.strategy_metrics(strategy.equity_ledger(_signals(spark, sf), BARS), BARS)
    out = with_logs(out).withColumn("log_growth", F.log("total_ratio"))
    return tidy(out, "symbol", "n_rows", "n_trades", *PERFORMANCE, *LOGS, "log_growth")


@query("a16_regression_metrics", f"""WITH {BARS_SQL}, {LEDGER_SQL}, {performance_sql('ledger')}
  SELECT symbol, {r('mse', 'mape', 'r2', 'explained_variance')} FROM perf""")
def a16_regression_metrics(spark, sf):
    return tidy(strategy.regression_metrics(_signals(spark, sf), "price", "signal", ["symbol"]))


@query("a14_imbalance_ratio", """WITH c AS (SELECT lang, source, count(*) AS n FROM documents GROUP BY ALL)
  SELECT lang, round(max(n) / min(n), 6) + 0.0 AS imbalance_ratio, max(n) / min(n) > 1.5 AS imbalanced FROM c GROUP BY lang""")
def a14_imbalance_ratio(spark, sf):
    from tideline.plans.inputs import table
    return tidy(strategy.imbalance_ratio(table(spark, sf, "documents"), "source", ["lang"]))


# 50 trials, a grid over the documented search ranges (look-back 10-100, cost 0.0001-0.01).
BACKS, COSTS = tuple(range(10, 101, 10)), (0.0001, 0.0005, 0.001, 0.005, 0.01)
TRIALS = tuple(strategy.Trial(f"back{n}_cost{c}", n, c) for n in BACKS for c in COSTS)
_TRIAL_SQL = " UNION ALL ".join(
    f"""SELECT symbol, '{t.name}' AS trial, CAST({t.cost} AS DOUBLE) AS cost, ts, price, lag(s{t.look_back}) {over()} AS signal FROM sg"""
    for t in TRIALS)
_SWEEP_SQL = f"""sg AS (SELECT symbol, ts, close AS price, """ + ", ".join(
    f"coalesce(sign(round({roll('avg', 'close', 5)} - {roll('avg', 'close', n)}, 9)), 0) AS s{n}" for n in BACKS
) + f""" FROM bars), tr AS ({_TRIAL_SQL}),
{ledger_sql('tr', 'ledger', 'symbol, trial', 'cost')}, {performance_sql('ledger', 'symbol, trial')}"""


@query("b2_parameter_sweep", f"""WITH {BARS_SQL}, {_SWEEP_SQL}
  SELECT symbol, trial, n_trades, {r(*PERFORMANCE, *GROWTH_SQL)} FROM perf""")
def b2_parameter_sweep(spark, sf):
    prices = bars(spark, sf).withColumnRenamed("close", "price")
    return tidy(with_logs(strategy.parameter_sweep(prices, BARS, TRIALS)), "symbol", "trial", "n_trades", *PERFORMANCE, *LOGS)


@query("o5_best_trial", f"""WITH {BARS_SQL}, {_SWEEP_SQL}
  SELECT symbol, trial, {r(GROWTH_SQL[1], 'max_drawdown_relative')} FROM perf WHERE sharpe_ratio IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY sharpe_ratio DESC, trial) = 1""")
def o5_best_trial(spark, sf):
    prices = bars(spark, sf).withColumnRenamed("close", "price")
    best = strategy.best_trial(strategy.parameter_sweep(prices, BARS, TRIALS), ["symbol"])
    return tidy(with_logs(best), "symbol", "trial", "log_sharpe_ratio", "max_drawdown_relative")


@query("m13_ensemble_signal", f"""WITH {BARS_SQL}, s AS (SELECT symbol, ts,
    CASE WHEN count(close) {over(5)} = 5 THEN CAST(close > avg(close) {over(5)} AS DOUBLE) END AS a,
    CASE WHEN count(close) {over(20)} = 20 THEN CAST(close > avg(close) {over(20)} AS DOUBLE) END AS b,
    CAST(close > open AS DOUBLE) AS c FROM bars)
  SELECT symbol, ts, {r('(coalesce(a, 0) + coalesce(b, 0) + c) / (1 + CAST(a IS NOT NULL AS INTEGER) + CAST(b IS NOT NULL AS INTEGER)) AS signal')} FROM s""")
def m13_ensemble_signal(spark, sf):
    from tideline.series import rolling
    b = bars(spark, sf)
    b = b.withColumns({f"s{n}": (F.col("close") > rolling(BARS, "close", n, F.avg)).cast("double") for n in (5, 20)})
    b = b.withColumn("s1", (F.col("close") > F.col("open")).cast("double"))
    return tidy(b.withColumn("signal", strategy.ensemble_signal(["s5", "s20", "s1"])), "symbol", "ts", "signal")

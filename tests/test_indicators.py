"""Hand-computed values on small series."""

import pytest
from conftest import bars_frame, column
from pyspark.sql import functions as F

from tideline.operators import indicators, onchain, patterns, risk, strategy, technical
from tideline.operators.bars import ohlcv_bars
from tideline.series import SeriesSpec

SPEC = SeriesSpec(("symbol",), "ts")


def test_rsi_and_obv(spark):
    b = bars_frame(spark, [1.0, 1.0, 2.0, 1.0])
    assert column(indicators.rsi(b, SPEC), "RSI") == [100, 100, 100, 50]
    assert column(indicators.obv(b, SPEC), "OBV") == [None, 0, 10, 0]


def test_flat_prices_divide_nothing_by_zero(spark):
    b = bars_frame(spark, [5.0] * 30)
    out = indicators.indicator_bundle(b, SPEC)
    assert column(out, "Band_Width")[-1] == 0 and column(out, "Momentum")[-1] is None
    row = risk.risk_metrics(b, SPEC).first()
    assert row["sharpe"] is None and row["var"] == 0 and row["max_drawdown"] == 0
    assert technical.technical_indicators(b, SPEC).count() == 30
    assert {r["corr"] for r in risk.correlation_matrix(b, ["open", "close"], ["symbol"]).collect()} == {None}


def test_single_row_and_empty(spark):
    for closes in ([3.0], []):
        b = bars_frame(spark, closes)
        assert indicators.indicator_bundle(b, SPEC).count() == len(closes)
        assert patterns.chart_patterns(b, SPEC).count() == len(closes)
        assert risk.risk_metrics(b, SPEC).count() == 0


def test_peak_in_the_first_row_is_no_peak(spark):
    row = risk.risk_metrics(bars_frame(spark, [100.0, 50.0, 60.0, 45.0]), SPEC).first()
    assert row["max_drawdown"] == pytest.approx(45 / 60 - 1)


def test_head_and_shoulders_and_short_history(spark):
    out = patterns.chart_patterns(bars_frame(spark, [5.0, 3.0, 6.0, 2.0]), SPEC)
    assert column(out, "head_and_shoulders") == [None, None, None, True] or column(out, "head_and_shoulders")[-1]
    assert column(out, "double_top")[-1] is False


def test_parabolic_sar_flips(spark):
    rows = [("a", i, p, p + 1.0, p - 1.0, p, 1.0) for i, p in enumerate([10.0, 11.0, 12.0, 13.0, 5.0, 4.0, 3.0])]
    b = spark.createDataFrame(rows, "symbol string, ts long, open double, high double, low double, close double, volume double")
    sar = column(technical.parabolic_sar(b, SPEC), "parabolic_sar")
    assert sar[0] is None and sar[1] == 9.0      # starts at the first low, held below the lows before
    assert sar[4] == 14.0                        # reversal: the highest high becomes the level
    assert all(s > p for s, p in zip(sar[4:], [5, 4, 3]))


def test_bars_break_ties_by_id(spark):
    ticks = spark.createDataFrame([("a", "2024-01-01 00:10:00", 2, 7.0), ("a", "2024-01-01 00:10:00", 1, 5.0),
                                   ("a", "2024-01-01 01:00:00", 3, 9.0)], "symbol string, t string, id int, price double")
    ticks = ticks.withColumn("ts", F.to_timestamp("t"))
    rows = ohlcv_bars(ticks, SeriesSpec(("symbol",), "ts", ("id",)), volume=None).orderBy("ts").collect()
    assert [(r["open"], r["close"], r["trades"]) for r in rows] == [(5.0, 7.0, 2), (9.0, 9.0, 1)]


def _loop_equity(prices, signals, cash=10_000.0, cost=0.001):
    held, out = 0.0, [cash]
    for i in range(1, len(prices)):
        if signals[i] > 0 and not held:
            held, cash = cash * (1 - cost) / prices[i], 0.0
        elif signals[i] < 0 and held:
            held, cash = 0.0, held * prices[i] * (1 - cost)
        out.append(cash + held * prices[i])
    return out


def test_equity_equals_a_trading_loop(spark):
    prices = [10.0, 11.0, 12.0, 9.0, 9.5, 14.0, 13.0]
    signals = [1.0, 1.0, 0.0, 1.0, -1.0, -1.0, 1.0]
    df = spark.createDataFrame([("a", i, p, s) for i, (p, s) in enumerate(zip(prices, signals))],
                               "symbol string, ts long, price double, signal double")
    ledger = strategy.equity_ledger(df, SPEC)
    assert column(ledger, "total") == pytest.approx(_loop_equity(prices, signals))
    assert column(ledger, "trade") == [None, "buy", None, None, "sell", None, "buy"]


def test_week_ends_on_sunday(spark):
    days = spark.createDataFrame([("2024-01-06",), ("2024-01-07",), ("2024-01-08",)], "d string").withColumn("ts", F.to_timestamp("d"))
    assert [str(r[0]) for r in days.orderBy("d").select(onchain.week_end()).collect()] == ["2024-01-07", "2024-01-07", "2024-01-14"]


def test_zero_day_is_reported(spark):
    rows = [("n", "2024-01-01", 10.0), ("n", "2024-01-03", 5.0), ("n", "2024-01-04", 10.0)]
    df = spark.createDataFrame(rows, "network string, d string, v double").withColumn("ts", F.to_timestamp("d"))
    row = onchain.daily_trend(df, ["network"], "v").first()
    assert (row["trend"], row["n_zero_days"], row["n_days"]) == (pytest.approx((-1 + 1) / 2), 1, 4)


def test_consensus_keeps_and_rejects(spark):
    rows = [("t1", s, p) for s, p in zip("abc", (10.0, 10.001, 10.002))] + [("t2", s, p) for s, p in zip("abc", (1.0, 50.0, 99.0))]
    quotes = spark.createDataFrame(rows, "ts string, source string, close double")
    got = {r["ts"]: r for r in onchain.consensus_price(quotes, ["ts"], ["close"]).collect()}
    assert got["t1"]["valid"] and got["t1"]["close"] == pytest.approx(10.001, abs=1e-5)
    assert not got["t2"]["valid"] and got["t2"]["close"] is None


@pytest.mark.parametrize("t, degrees, p", [(2.228, 10, 0.05), (3.169, 10, 0.01), (1.96, 100000, 0.05), (12.706, 1, 0.05), (0.0, 5, 1.0)])
def test_significance_against_t_tables(t, degrees, p):
    assert onchain._two_sided_p(t, degrees) == pytest.approx(p, abs=2e-4)


def test_scenarios_do_not_depend_on_partitioning(spark):
    b = bars_frame(spark, [100.0 + i for i in range(50)]).withColumn("ts", F.timestamp_seconds("ts"))
    first = sorted(map(tuple, risk.apply_scenarios(b.repartition(1), SPEC).collect()))
    assert first == sorted(map(tuple, risk.apply_scenarios(b.repartition(7), SPEC).collect()))
    crash = [r["close"] / c for r, c in zip(risk.apply_scenarios(b, SPEC).where("scenario = 'Bear Market'").orderBy("ts").collect(),
                                            [100.0 + i for i in range(50)])]
    assert crash == pytest.approx([0.8] * 50)


def test_alerts(spark):
    df = spark.createDataFrame([("a", -0.2, 2.0, 1.0), ("b", -0.1, 2.0, None)], "symbol string, max_drawdown double, sharpe double, sortino double")
    assert {(r["symbol"], r["metric"]) for r in risk.threshold_alerts(df, ["symbol"]).collect()} == {("a", "max_drawdown"), ("a", "sortino")}
    assert {r["symbol"]: r["acceptable"] for r in risk.risk_verdict(df).collect()} == {"a": False, "b": True}


def test_packed_order_equals_struct_order(spark):
    from tideline.operators.bars import arrival_order
    spec = SeriesSpec(("k",), "ts", ("id",))
    big = 9223372036854775807
    rows = [("a", m, i) for m in (-1, 0, 1, 253402300799999999) for i in (-big, -1, 0, 1, big)]
    df = spark.createDataFrame(rows, "k string, m long, id long").withColumn("ts", F.timestamp_micros("m"))
    got = [(r["m"], r["id"]) for r in df.withColumn("o", arrival_order(df, spec)).orderBy("o").collect()]
    assert got == sorted((m, i) for _, m, i in rows)


def test_scenarios_side_by_side_equal_copies_of_the_series(spark):
    b = bars_frame(spark, [100.0 + (i * 37) % 11 for i in range(60)]).withColumn("ts", F.timestamp_seconds(F.col("ts") * 3600))
    found = {r["scenario"]: r for r in risk.stress_scenarios(b, SPEC).collect()}
    copies = risk.apply_scenarios(b, SPEC)
    by_scenario = SeriesSpec(("symbol", "scenario"), "ts")
    for r in risk.risk_metrics(copies, by_scenario).collect():
        for name in (*risk.METRICS, "n_returns"):
            mine = found[r["scenario"]][name]
            assert mine is None if r[name] is None else mine == pytest.approx(r[name], rel=1e-9, abs=1e-12), (r["scenario"], name)
    assert len(found) == len(risk.SCENARIOS)

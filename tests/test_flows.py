"""Edges of the composed flows; their results on whole tables are compared with SQL."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tideline import flows
from tideline.series import SeriesSpec
from tideline.sources import payloads

T = dt.datetime(2024, 1, 1, 10)


def message(source, price, symbol="A"):
    if source == "CoinMarketCap":
        return json.dumps({"data": {symbol: {"quote": {"USD": {"open": price, "high": price, "low": price, "price": price, "volume_24h": 1}}}}})
    return json.dumps({"open": price, "high": price, "low": price, "price": price, "close": price, "volume": 1})


def test_messages_name_their_own_symbol(spark):
    from pyspark.sql import functions as F

    raw = spark.createDataFrame([(s, "CoinMarketCap", message("CoinMarketCap", p, s)) for s, p in (("A", 1.0), ("B", 2.0))] + [("C", "CoinMarketCap", message("CoinMarketCap", 3.0, "A"))],
                                "symbol string, source string, payload string")
    assert {r.symbol: r.close for r in payloads.normalize_quotes(raw, F.col("symbol")).collect()} == {"A": 1.0, "B": 2.0}
    assert [r.symbol for r in payloads.quote_rejects(raw, F.col("symbol")).collect()] == ["C"]


def test_hours_without_agreement_are_left_out_and_results_are_stored(spark, tmp_path):
    rows = []
    for hour in range(30):
        for i, source in enumerate(("rest", "TradingView", "CoinMarketCap")):
            price = 100.0 + hour + (50 * i if hour == 7 else 0)
            rows.append(("A", source, T + dt.timedelta(hours=hour, minutes=i), message(source, price)))
    rows.append(("A", "TradingView", T + dt.timedelta(hours=3), "not json"))
    raw = spark.createDataFrame(rows, "symbol string, source string, ts timestamp, payload string")
    path = str(tmp_path / "market")
    out = flows.quote_flow(raw, path=path).orderBy("ts").collect()
    assert len(out) == 29 and T + dt.timedelta(hours=7) not in {r.ts for r in out}
    assert out[0].close == 100.0 and out[-1].SMA == pytest.approx(sum(range(110, 130)) / 20) and out[-1].RSI == 100.0 and not out[-1].double_top
    assert spark.read.parquet(path).count() == 29
    flows.quote_flow(raw, path=path)
    assert spark.read.parquet(path).count() == 58  # appended, as the flow runs again and again
    assert flows.quote_flow(raw.limit(0)).count() == 0


def test_texts_are_scored_once_and_posts_keep_their_rows(spark):
    posts = spark.createDataFrame([(1, "a", T, "good Moon day"), (2, "a", T, "good Moon day"), (3, "b", T, None), (4, "a", T + dt.timedelta(hours=1), ""), (4, "a", T + dt.timedelta(hours=1), "not good")],
                                  "id long, source string, at timestamp, text string")
    market = spark.createDataFrame([("a", T - dt.timedelta(minutes=1), 5.0), ("a", T + dt.timedelta(minutes=30), 6.0)], "source string, bar timestamp, close double")
    lexicon = spark.createDataFrame([("good", 2.0)], "token string, valence double")
    places = spark.createDataFrame([("moon day", "x"), ("moon", "y")], "phrase string, label string")
    priced, hourly = flows.text_flow(posts, market, lexicon, places, "id", "text", "at", "bar", ["source"])
    found = sorted((r.id, r.n_hits, r.n_mentions, r.market_close) for r in priced.collect())
    assert sorted(found, key=str) == sorted([(1, 1, 2, 5.0), (2, 1, 2, 5.0), (3, 0, 0, None), (4, 0, 0, 6.0), (4, 1, 0, 6.0)], key=str)
    by = {(r.source, r.window_start.hour): (r.n_posts, r.avg_sentiment) for r in hourly.collect()}
    assert by["a", 10][0] == 2 and by["a", 11][1] < 0 < by["a", 10][1] and by["b", 10] == (1, 0.0)
    assert "text" not in priced.columns


def test_the_gate_stops_what_cannot_be_mended(spark):
    base = spark.createDataFrame([("a", i, float(i)) for i in range(1, 11)], "symbol string, ts long, close double")
    gaps = spark.createDataFrame([("a", i, 2.0 * i) for i in range(1, 11, 2)], "symbol string, ts long, v double")
    spec = SeriesSpec(("symbol",), "ts")
    frame, report = flows.prepare_flow(base, {"x": gaps}, spec, ["close", "x_v"], ["x_v"], lag_columns=("x_v",), steps=(1,))
    rows = frame.orderBy("ts").collect()
    assert [r.x_v for r in rows] == pytest.approx([2.0 * i for i in range(1, 11)], rel=1e-4) and rows[0].x_v_lag_1 is None and [r.is_train for r in rows] == [True] * 8 + [False] * 2
    assert {(r.is_train, r.n_rows, r["column"], r.n_missing) for r in report.collect()} == {(True, 8, "x_v_lag_1", 1), (False, 2, "x_v_lag_1", 0)}
    with pytest.raises(flows.QualityError, match="negative close: 1"):
        flows.prepare_flow(base.selectExpr("symbol", "ts", "close - 2 AS close"), {"x": gaps}, spec, ["close", "x_v"], ["close"], lag_columns=("x_v",))
    with pytest.raises(flows.QualityError, match="missing x_v: 10"):
        flows.prepare_flow(base, {"x": gaps.where("false")}, spec, ["close", "x_v"], lag_columns=("x_v",))


def test_one_post_stands_for_a_text(spark, monkeypatch):
    """Every text once, those of posts without a key or with a shared one too; posts are chosen before their texts are joined to them."""
    rows = [(1, "a"), (2, "a"), (3, "b"), (3, "c"), (None, "d"), (None, "a"), (5, None)]
    posts = spark.createDataFrame(rows, "k long, t string").withColumn("_text", F.xxhash64("t", F.col("t").isNull()))
    assert sorted(r["raw"] or "" for r in flows.distinct_texts(posts, "k", "t").collect()) == ["", "a", "b", "c", "d"]
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(4)], "d long, t string")
    many = spark.range(100).withColumnRenamed("id", "k").join(docs, F.pmod("k", F.lit(5)) == F.col("d"), "left").select("k", "t", F.xxhash64("t").alias("_text"))
    for block in (1_000_000, 2):
        monkeypatch.setattr(flows, "KEYS_OF_A_BLOCK", block)
        found = flows.distinct_texts(many, "k", "t")
        assert sorted(r["raw"] or "" for r in found.collect()) == ["", *[f"text {i}" for i in range(4)]]
        # no exchange or sort below the choice of posts
        plan = found._jdf.queryExecution().sparkPlan().toString()
        assert plan.count("BroadcastHashJoin") >= plan.count("LeftSemi") == (1 if block > 2 else 3)

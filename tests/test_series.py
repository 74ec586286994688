"""The series layer: split series give what unsplit ones give, and both give what pandas gives."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tideline.operators import indicators, technical
from tideline.series import (SeriesSpec, equi_join, ewm, ewm_memory, fill_backward, fill_forward, index_series, latest,
                             over_chunks, place_rows, quantiles, rolling, running, split_chunks)
from tideline.series import approximate_quantiles

SPEC = SeriesSpec(("symbol",), "ts", ("n",))


@pytest.fixture(scope="module")
def walk():
    """Three keys; one holds most rows, many of them at the same time; gaps in ``x``."""
    rng = np.random.default_rng(3)
    parts = []
    for key, size in (("hot", 3000), ("mild", 300), ("one", 1)):
        close = 100 + rng.normal(0, 1, size).cumsum()
        parts.append(pd.DataFrame({"symbol": key, "ts": np.sort(rng.integers(0, size // 3 + 1, size)), "n": np.arange(size),
                                   "close": close, "volume": rng.integers(1, 50, size).astype(float)}))
    out = pd.concat(parts, ignore_index=True)
    out["high"], out["low"], out["open"] = out.close + 1, out.close - 1, out.close + 0.25
    out["x"] = out.close.where(rng.random(len(out)) > 0.3)
    return out.sort_values(["symbol", "ts", "n"], ignore_index=True)


@pytest.fixture(scope="module")
def df(spark, walk):
    return spark.createDataFrame(walk.sample(frac=1, random_state=1)).withColumn("x", F.nanvl("x", F.lit(None)))


def collected(df):
    return df.toPandas().sort_values(["symbol", "ts", "n"], ignore_index=True)


def test_index_is_dense_and_ordered(df, walk):
    for partitions in (1, 4, 17):
        got = collected(index_series(df, SPEC, partitions))
        assert got["_idx"].tolist() == walk.groupby("symbol").cumcount().tolist()


def test_hot_key_is_spread(df):
    placed, _ = place_rows(df, SPEC, 8)
    sizes = [r["count"] for r in placed.groupBy("_run").count().collect()]
    assert len(sizes) >= 6 and max(sizes) < 0.35 * sum(sizes)


@pytest.mark.parametrize("chunk_rows", [25, 64, 256])
def test_rolling_over_chunks(df, walk, chunk_rows):
    def operator(frame, spec):
        return frame.withColumns({"m": rolling(spec, "x", 3, F.avg), "s": rolling(spec, "close", 20, F.stddev_samp)})

    got = collected(over_chunks(df, SPEC, operator, halo=20, chunk_rows=chunk_rows))
    assert len(got) == len(walk)
    by = walk.groupby("symbol")
    np.testing.assert_allclose(got["m"], by["x"].rolling(3).mean().reset_index(drop=True), rtol=1e-12)
    np.testing.assert_allclose(got["s"], by["close"].rolling(20).std().reset_index(drop=True), rtol=1e-9)


@pytest.mark.parametrize("chunk_rows", [None, 50, 400])
def test_running_values(df, walk, chunk_rows):
    wanted = {"total": ("sum", "volume"), "top": ("max", "close"), "low_": ("min", "close"), "seen": ("last", "x")}
    if chunk_rows:
        chunked, spec = split_chunks(index_series(df, SPEC), SPEC, chunk_rows, halo=7)
        got = collected(running(chunked, spec, wanted).where("NOT _halo"))
    else:
        got = collected(running(df, SPEC, wanted))
    by = walk.groupby("symbol")
    np.testing.assert_allclose(got["total"], by["volume"].cumsum())
    np.testing.assert_allclose(got["top"], by["close"].cummax())
    np.testing.assert_allclose(got["low_"], by["close"].cummin())
    np.testing.assert_allclose(got["seen"], by["x"].ffill())


def test_fills_on_split_series(df, walk):
    placed, spec = place_rows(df, SPEC, 6)
    both = fill_backward(fill_forward(placed.withColumn("y", F.col("x")), spec, ["x"]), spec, ["x", "y"])
    got = collected(both)
    by = walk.groupby("symbol")
    np.testing.assert_allclose(got["x"], by["x"].transform(lambda s: s.ffill().bfill()))
    np.testing.assert_allclose(got["y"], by["x"].bfill())


@pytest.mark.parametrize("alpha", [2 / 13, 2 / 51, 1 / 14, 0.5, 1.0])
def test_exponential_mean(df, walk, alpha):
    expected = walk.groupby("symbol")["close"].transform(lambda s: s.ewm(alpha=alpha, adjust=False).mean())
    got = collected(ewm(df, SPEC, {"y": ("close", alpha)}))
    np.testing.assert_allclose(got["y"], expected, rtol=1e-12)
    halo = ewm_memory(alpha)
    split = over_chunks(df, SPEC, lambda f, s: ewm(f, s, {"y": ("close", alpha)}), halo=halo, chunk_rows=halo)
    np.testing.assert_allclose(collected(split)["y"], expected, rtol=1e-12)


def test_exponential_mean_skips_nulls(df, walk):
    expected = walk.groupby("symbol")["x"].transform(lambda s: s.ewm(alpha=0.2, adjust=False, ignore_na=True).mean())
    np.testing.assert_allclose(collected(ewm(df, SPEC, {"y": ("x", 0.2)}))["y"], expected, rtol=1e-12)


def test_indicators_keyed_equal_chunked(df):
    for step, columns in ((indicators.macd, ["MACD", "Signal_Line"]), (indicators.rsi, ["RSI"]),
                          (indicators.obv, ["OBV", "OBV_smoothed"]), (indicators.bollinger, ["Band_Width"])):
        plain = collected(step(df, SPEC))
        split = collected(over_chunks(df, SPEC, step, halo=indicators.LOOK_BACK[step.__name__], chunk_rows=1500))
        for c in columns:
            np.testing.assert_allclose(split[c], plain[c], rtol=1e-9, atol=1e-7)


def test_average_true_range_keyed_equals_chunked(df):
    plain = collected(technical.average_true_range(df, SPEC))
    split = collected(over_chunks(df, SPEC, technical.average_true_range, halo=ewm_memory(1 / 14) + 15))
    np.testing.assert_allclose(split["atr"], plain["atr"], rtol=1e-12)


def test_chunks_must_hold_the_halo(df):
    with pytest.raises(ValueError):
        split_chunks(index_series(df, SPEC), SPEC, 10, halo=11)


def test_quantiles(df, walk):
    got = {r["symbol"]: r for r in quantiles(df, ["symbol"], "x", {"a": 0.05, "b": 0.5, "c": 0.99}).collect()}
    for key, group in walk.groupby("symbol"):
        values = group["x"].dropna()
        if len(values):
            for name, share in (("a", 0.05), ("b", 0.5), ("c", 0.99)):
                assert got[key][name] == pytest.approx(values.quantile(share))
    assert quantiles(df, [], "close", {"m": 0.5}).first()["m"] == pytest.approx(walk["close"].median())


def test_latest(df, walk):
    got = {r["symbol"]: r["close"] for r in latest(df, SPEC).collect()}
    assert got == walk.groupby("symbol")["close"].last().to_dict()


def test_null_keys_survive_joins(spark):
    left = spark.createDataFrame([(None, 1), ("a", 2)], "k string, v int")
    right = spark.createDataFrame([(None, 10), ("a", 20)], "k string, w int")
    assert {tuple(r) for r in equi_join(left, right, ["k"]).collect()} == {(None, 1, 10), ("a", 2, 20)}


def test_partition_count_does_not_matter(spark, df):
    results = []
    for n in ("1", "4", "17"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        results.append(collected(over_chunks(df, SPEC, indicators.rsi, halo=15, chunk_rows=100))["RSI"].round(9).tolist())
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert results[0] == results[1] == results[2]


def test_null_key_is_a_series_of_its_own(spark):
    df = spark.createDataFrame([(None, i, 0, float(i)) for i in range(40)] + [("a", i, 0, 1.0) for i in range(40)],
                               "symbol string, ts long, n int, x double")

    def operator(frame, spec):
        return running(frame, spec, {"s": ("sum", "x")})

    got = over_chunks(df, SPEC, operator, halo=3, chunk_rows=7)
    assert {(r["symbol"], r["s"]) for r in got.where("ts = 39").collect()} == {(None, 780.0), ("a", 40.0)}
    assert got.count() == 80


def test_quantiles_of_a_crowded_value(spark):
    values = [0.0] * 500 + [float(i) for i in range(1, 100)] + [7.5] * 40
    df = spark.createDataFrame([("a", v) for v in values] + [("b", None), ("c", 3.0)], "k string, x double")
    got = {r["k"]: r for r in quantiles(df, ["k"], "x", {"q50": 0.5, "q79": 0.79, "q99": 0.99, "q100": 1.0}).collect()}
    expected = pd.Series(values)
    for name, share in (("q50", 0.5), ("q79", 0.79), ("q99", 0.99), ("q100", 1.0)):
        assert got["a"][name] == pytest.approx(expected.quantile(share)) and got["c"][name] == 3.0
    assert "b" not in got


def test_crowded_instant_is_cut(spark):
    from tideline.operators.joins import asof_join
    left = spark.range(5000).select(F.col("id"), F.lit(10).alias("t"))
    right = spark.createDataFrame([(9, "x"), (10, "y"), (11, "z")], "rt int, v string")
    out = asof_join(left, right, "t", "rt")
    assert {(r["right_v"], r["count"]) for r in out.groupBy("right_v").count().collect()} == {("y", 5000)}


@pytest.mark.parametrize("limit, sketch", [(1_000_000, 1000), (200, 100), (20, 16), (1, 200)])
def test_quantiles_narrowed_by_sketches(spark, limit, sketch):
    """Small limits make every large group pass several brackets; sketches this coarse are often wrong, and then not used."""
    rng = np.random.default_rng(3)
    groups = {"hot": rng.standard_normal(6000), "ties": rng.integers(0, 3, 3000).astype(float), "one": np.ones(900), "few": np.array([4.0]),
              None: np.concatenate([rng.standard_normal(500) * 1e6, np.full(700, 2.5)]), "big": np.array([1e300, -1e300, 0.0])}
    rows = [(k, float(v)) for k, values in groups.items() for v in values] + [("hot", None), ("empty", None)]
    df = spark.createDataFrame(rows, "k string, x double").repartition(6)
    shares = {"q0": 0.0, "q05": 0.05, "q50": 0.5, "q99": 0.99, "q100": 1.0}
    got = {r["k"]: r for r in quantiles(df, ["k"], "x", shares, limit=limit, sketch=sketch).collect()}
    assert set(got) == set(groups)
    for k, values in groups.items():
        for name, share in shares.items():
            assert got[k][name] == pytest.approx(np.quantile(values, share), rel=1e-9), (k, name)
    nan = spark.createDataFrame([(float(i),) for i in range(300)] + [(float("nan"),)] * 100, "x double")
    found = quantiles(nan, [], "x", {"a": 0.5, "b": 0.9}, limit=limit, sketch=sketch).first()
    assert found["a"] == 199.5 and found["b"] != found["b"]
    assert quantiles(df.limit(0), ["k"], "x", shares).collect() == []


def test_approximate_quantiles(spark):
    df = spark.range(50_000).select((F.col("id") % 2).alias("k"), F.col("id").cast("int").alias("x"))
    for r in approximate_quantiles(df, ["k"], "x", {"a": 0.5, "b": 0.99}).collect():
        assert abs(r["a"] - 25_000) < 250 and abs(r["b"] - 49_500) < 250


def test_placing_reads_its_input_once(spark):
    """Count, bounds and sort read a stored copy: a row function above runs once per row."""
    seen = spark.sparkContext.accumulator(0)

    def note(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.range(1000).select(F.lit("a").alias("symbol"), F.col("id").alias("ts")).mapInArrow(note, "symbol string, ts long")
    placed, _ = place_rows(df, SeriesSpec(("symbol",), "ts"))
    assert placed.count() == 1000 and seen.value == 1000

"""No operator loses rows, words or digits, and missing times and keys match nothing."""

import random

import numpy as np
import pytest
from pyspark.ml.regression import LinearRegression

from tideline.operators import graph, joins, models, technical, text
from tideline.series import SeriesSpec
from tideline.sources import payloads
from tideline.staging import staging_root


def test_wide_hexadecimal_results_are_exact(spark):
    numbers = [0, 255, 100 * 10 ** 18, 2 ** 64, 16 ** 30 + 7, 16 ** 31 - 1]
    rows = [(i, '{"jsonrpc": "2.0", "id": 1, "result": "0x000%x"}' % n) for i, n in enumerate(numbers)]
    rows += [(90, '{"jsonrpc": "2.0", "id": 1, "result": "0x1%s"}' % ("0" * 31)), (91, '{"jsonrpc": "2.0", "id": 1, "result": "12"}'),
             (92, '{"jsonrpc": "2.0", "id": 1}'), (93, '{"jsonrpc": "2.0", "id": 1, "result": "%s"}' % ("9" * 40))]
    out = {r["k"]: r for r in payloads.normalize_onchain(spark.createDataFrame(rows, "k int, payload string")).collect()}
    assert [int(out[i]["result_value"]) for i in range(len(numbers))] == numbers
    assert out[90]["result_value"] is None and out[90]["overflow"] and out[93]["overflow"]
    assert out[91]["result_value"] == 12 and not out[91]["overflow"] and out[92]["rejected"] and not out[92]["overflow"]


def test_phrases_of_any_length(spark):
    docs = spark.createDataFrame([(1, "The Bank of New England and the bank"), (2, "new")], "id int, text string")
    listed = spark.createDataFrame([("bank of new england and the", "org"), ("new", "x")], "phrase string, label string")
    out = text.match_entities(docs, "id", "text", listed).collect()
    assert sorted((r["id"], r["position"], r["phrase"]) for r in out) == [(1, 2, "bank of new england and the"), (1, 4, "new"), (2, 1, "new")]


@pytest.mark.parametrize("direction", ["backward", "forward"])
def test_missing_times_and_keys_match_nothing(spark, direction):
    left = spark.createDataFrame([(1, "a", 5), (2, "a", None), (3, None, 5), (4, "a", 0)], "id int, k string, ts int")
    right = spark.createDataFrame([("a", None, 1.0), (None, 5, 2.0), ("a", 4, 3.0), ("a", 6, 4.0)], "k string, ts int, v double")
    out = {r["id"]: r["right_v"] for r in joins.asof_join(left, right, "ts", "ts", ["k"], direction=direction).collect()}
    assert out == ({1: 3.0, 2: None, 3: None, 4: None} if direction == "backward" else {1: 4.0, 2: None, 3: None, 4: 3.0})


def walk_rows(key):
    rng = random.Random(3)
    price = 100.0
    for i in range(60):
        price += rng.uniform(-3, 3)
        yield key, i, price + 1, price - 1


def test_stop_and_reverse_of_a_series_without_a_key(spark):
    spec = SeriesSpec(("k",), "ts")
    rows = [*walk_rows(None), *walk_rows(1)]
    out = technical.parabolic_sar(spark.createDataFrame(rows, "k int, ts int, high double, low double"), spec).collect()
    by = {k: [r["parabolic_sar"] for r in sorted(out, key=lambda r: r["ts"]) if r["k"] == k] for k in (None, 1)}
    assert by[None] == by[1] and by[1][0] is None and None not in by[1][1:]


def incomplete(spark):
    rng = random.Random(4)
    rows = [(i, rng.gauss(0, 1), None if i % 7 == 3 else rng.gauss(0, 1), rng.gauss(0, 1)) for i in range(200)]
    return spark.createDataFrame([*rows, (900, 50.0, 50.0, 0.0)], "id int, a double, b double, y double")


def test_rows_with_a_missing_feature_stay_without_a_score(spark):
    df = incomplete(spark)
    gap = {r["id"] for r in df.where("b IS NULL").collect()}
    for out, score in ((models.isolation_forest(df, ["id"], ["a", "b"], trees=20, sample=64), "anomaly_score"),
                       (models.pca_anomaly(df, ["a", "b"], k=1), "reconstruction_error"), (models.pca(df, ["a", "b"], k=1)[0], "pca")):
        rows = out.collect()
        assert len(rows) == 201 and {r["id"] for r in rows if r[score] is None} == gap
    flagged = models.isolation_forest(df, ["id"], ["a", "b"], trees=20, sample=64, keep="anomalies").collect()
    assert 900 in {r["id"] for r in flagged} and not gap & {r["id"] for r in flagged}
    nothing = df.where("b IS NULL")
    assert models.isolation_forest(nothing, ["id"], ["a", "b"]).where("anomaly_score IS NULL AND NOT anomaly").count() == len(gap)


@pytest.mark.parametrize("offset,copies", [(0.0, 1), (1e8, 1), (0.0, 30), (1e6, 30)])
def test_neighbours_are_exact_far_away_and_among_copies(spark, offset, copies):
    rng = np.random.default_rng(8)
    points = np.repeat(rng.standard_normal((300 // copies, 8)) + offset, copies, axis=0)
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "id long, v array<double>")
    found = models.nearest_neighbours(df, "id", "v", k=5, pivots=4).orderBy("id", "rank").collect()
    distance = np.sqrt(((points[:, None] - points[None]) ** 2).sum(2))
    np.fill_diagonal(distance, np.inf)
    assert len(found) == 1500
    for i in range(300):
        expected = sorted(range(300), key=lambda j: (distance[i, j], j))[:5]
        assert [r["neighbour"] for r in found[5 * i:5 * i + 5]] == expected
    flagged = models.local_outlier(df, "id", "v", k=5, contamination=0.05, keep="anomalies").collect()
    assert len(flagged) <= 15 and all(r["severity"] > 0 for r in flagged)


def test_a_signal_moves_by_one_row_past_a_gap(spark):
    df = spark.createDataFrame([("s", i, float(i) if i != 3 else None, 2.0 * i) for i in range(6)], "k string, ts int, x double, y double")
    model = LinearRegression(featuresCol="features", labelCol="y", predictionCol="prediction").fit(models.assemble(df.where("x IS NOT NULL"), ["x"]))
    out = models.model_signals(df, SeriesSpec(("k",), "ts"), model, ["x"]).orderBy("ts").collect()
    assert [None if r["signal"] is None else round(r["signal"], 6) for r in out] == [None, 0, 2, 4, None, 8]


def test_posts_with_a_missing_counter_stay(spark):
    posts = spark.createDataFrame([(i, i, float(i) if i != 4 else None) for i in range(10)], "id int, ts int, likes double")
    market = spark.createDataFrame([(i, 3.0 * i + 1) for i in range(10)], "at int, close double")
    out, _ = graph.influencer_impact(posts, market, "ts", "at", counters=("likes",))
    scores = {r["id"]: r["impact_score"] for r in out.collect()}
    assert len(scores) == 10 and scores[4] is None and abs(scores[5] - 16) < 1e-6


def test_one_new_row_per_key_is_the_last_one(spark):
    new = spark.createDataFrame([(1, 5, "b"), (1, 7, "a"), (2, 1, "z"), (None, 1, "n")], "k int, seq int, v string")
    stored = spark.createDataFrame([(2,)], "k int")
    assert sorted((str(r["k"]), r["v"]) for r in joins.anti_join_new(new, stored, ["k"]).collect()) == [("1", "a"), ("None", "n")]
    assert joins.anti_join_new(new, stored, ["k"], ["v"]).where("k = 1").first()["v"] == "b"


def test_topics_know_every_word(spark):
    docs = spark.createDataFrame([("apple banana cherry " * 5,), ("stone metal brick " * 5,), ("rareword apple",)], "text string")
    _, model = text.topic_model(docs, "text", topics=2, passes=5)
    assert {"rareword", "metal"} <= set(model.stages[0].vocabulary) and model.stages[1].getSubsamplingRate() == 1.0


def test_staging_is_below_the_shared_folder_or_the_warehouse(spark):
    assert staging_root(spark) == spark.conf.get("spark.checkpoint.dir")

"""Properties of the fitted operators."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tideline.functions.expr import hash_normal
from tideline.operators import graph, models, text, topics
from tideline.operators.strategy import ensemble_signal
from tideline.series import SeriesSpec


@pytest.fixture(scope="module")
def cloud(spark):
    rng = np.random.default_rng(5)
    a = rng.normal(0, 1, 600)
    pdf = pd.DataFrame({"id": range(600), "a": a, "b": 2 * a + rng.normal(0, 0.05, 600), "c": rng.normal(0, 1, 600)})
    pdf.loc[:5, ["a", "b", "c"]] = [[30, -30, 30], [-30, 30, 30], [30, 30, -30], [25, -25, 25], [-25, 25, 25], [40, -40, 0]]
    return pdf


def test_imputation_recovers_a_line_and_keeps_observed_cells(spark, cloud):
    pdf = cloud.iloc[6:].copy()
    truth = pdf["b"].copy()
    pdf.loc[pdf.index[::7], "b"] = None
    pdf.loc[pdf.index[3::11], "a"] = None
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "id long, a double, b double, c double")
    got = models.impute_iterative(df, ["a", "b", "c"]).toPandas().set_index("id").sort_index()
    seen = pdf["b"].notna()
    assert np.array_equal(got["b"][seen.to_numpy()], pdf["b"][seen])
    only_b = (~seen & pdf["a"].notna()).to_numpy()
    assert np.abs(got["b"].to_numpy()[only_b] - truth.to_numpy()[only_b]).mean() < 0.15
    assert got.notna().all().all()


def test_isolation_forest_finds_planted_outliers(spark, cloud):
    df = spark.createDataFrame(cloud)
    worst = models.isolation_forest(df, ["id"], ["a", "b", "c"], trees=50, contamination=0.01, keep="anomalies")
    assert {r["id"] for r in worst.collect()} == set(range(6))
    again = models.isolation_forest(df.repartition(5), ["id"], ["a", "b", "c"], trees=50, contamination=0.01, keep="clean")
    assert {r["id"] for r in again.collect()} == set(range(6, 600))


def test_reconstruction_error(spark, cloud):
    df = spark.createDataFrame(cloud)
    loose = models.pca_anomaly(df, ["a", "b", "c"], k=1).agg(F.sum("reconstruction_error")).first()[0]
    tight = models.pca_anomaly(df, ["a", "b", "c"], k=2).agg(F.sum("reconstruction_error")).first()[0]
    assert 0 <= tight < loose
    assert models.pca_anomaly(df, ["a", "b", "c"], k=2, keep="anomalies").count() == 6


def test_pca_keeps_enough_variance(spark, cloud):
    df = spark.createDataFrame(cloud.iloc[6:]).select("id", array_to_vector(F.array("a", "b", "c")).alias("v"))
    _, model = models.pca(df, "v", variance=0.8)
    assert model.getK() == 1 and sum(models.pca(df, "v", variance=0.99)[1].explainedVariance) >= 0.99


def brute_force(points, k):
    d = np.sqrt(((points[:, None] - points[None]) ** 2).sum(2))
    np.fill_diagonal(d, np.inf)
    return np.sort(d, axis=1)[:, :k]


@pytest.mark.parametrize("block", [16, 4096])
def test_neighbours_are_exact_with_copies(spark, block):
    """A third of the rows are copies of one point; blocks smaller than that crowd."""
    rng = np.random.default_rng(11)
    points = rng.normal(0, 1, (240, 4))
    points[:80] = points[0]
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "id long, v array<double>")
    near = models.nearest_neighbours(df, "id", "v", k=5, pivots=6, block=block).toPandas().sort_values(["id", "rank"])
    got = near["distance"].to_numpy().reshape(240, 5)
    np.testing.assert_allclose(got, brute_force(points, 5), atol=1e-9)
    assert (near["id"] != near["neighbour"]).all()


def test_outlier_factor_is_high_for_the_lonely(spark):
    points = [(i, [float(i % 10), float(i // 10)]) for i in range(100)] + [(100, [50.0, 50.0])]
    lof = models.local_outlier(spark.createDataFrame(points, "id long, v array<double>"), "id", "v", k=5)
    rows = {r["id"]: r["lof"] for r in lof.collect()}
    assert max(rows, key=rows.get) == 100 and rows[100] > 5 and rows[55] == pytest.approx(1, abs=0.2)


def test_topics(spark):
    docs = spark.createDataFrame([("apple banana cherry apple",), ("banana cherry apple",), ("stocks bonds market",),
                                  ("market stocks bonds bonds",)] * 5, "text string")
    topics, model = text.topic_model(docs, "text", topics=2, passes=20, words_per_topic=3)
    assert topics.count() == 6
    weights = model.stages[1].topicsMatrix().toArray()
    assert weights.shape == (6, 2) and (weights > 0).all()


def test_influence_equals_normal_equations(spark):
    rng = np.random.default_rng(2)
    x = rng.integers(0, 50, (60, 2))
    posts = spark.createDataFrame([(i, i, int(a), int(b)) for i, (a, b) in enumerate(x)], "id long, t long, likes long, views long")
    market = spark.createDataFrame([(i, float(3 + 2 * a - b)) for i, (a, b) in enumerate(x)], "mt long, close double")
    out, model = graph.influencer_impact(posts, market, "t", "mt", counters=["likes", "views"])
    assert model.coefficients.toArray() == pytest.approx([2, -1]) and model.intercept == pytest.approx(3)
    assert out.where(F.abs(F.col("impact_score") - F.col("market_close")) > 1e-6).count() == 0


def test_selection_prefers_the_signal(spark, cloud):
    df = spark.createDataFrame(cloud.iloc[6:])
    chosen = models.feature_selection(df, ["a", "c"], "b", wanted=1, trees=5, folds=2)
    assert {r["feature"] for r in chosen.where("selected AND method IN ('rfe', 'boosted')").collect()} == {"a"}
    assert "a" in {r["feature"] for r in models.selected_features(chosen).collect()}


def test_predictor_target_is_the_next_return(spark):
    df = spark.createDataFrame([("a", i, float(100 + i % 7), float(i % 3)) for i in range(80)], "symbol string, ts long, close double, x double")
    out, _ = models.risk_predictor(df, SeriesSpec(("symbol",), "ts"), ["x", "close"], folds=2, trees=(3,), depths=(2,), leaves=(1,))
    rows = out.orderBy("ts").collect()
    assert rows[0]["next_return"] == pytest.approx(101 / 100 - 1) and rows[-1]["next_return"] is None
    assert all(r["predicted_return"] is not None for r in rows)


def test_ensemble_skips_missing(spark):
    df = spark.createDataFrame([(1.0, 0.0, None), (None, None, None)], "a double, b double, c double")
    assert [r[0] for r in df.select(ensemble_signal(["a", "b", "c"])).collect()] == [0.5, None]


def test_walk_forward_never_learns_from_the_future(spark):
    """Every fold's model knows only rows whose label was known before the fold; the held-out rows are the newest ones."""
    rng = np.random.default_rng(3)
    rows = [(int(t), int(t) + 7, float(x), float(2 * x + rng.normal(0, 0.1))) for t, x in zip(np.repeat(np.arange(200), 2), rng.normal(0, 1, 400))]
    df = spark.createDataFrame(rows, "t long, known long, x double, y double").selectExpr("timestamp_seconds(t) AS ts", "timestamp_seconds(known) AS known", "x", "y")
    line = LinearRegression(featuresCol="features", labelCol="y", solver="normal")
    search = models.walk_forward(df, "ts", "known", ["x"], "y", line, [{"regParam": 0.0}, {"regParam": 10.0}], folds=4, holdout=0.25)
    report = search.report.toPandas()
    assert len(report) == 8 and search.parameters == {"regParam": 0.0} and search.holdout_rmse < 0.2
    pdf = pd.DataFrame(rows, columns=["t", "known", "x", "y"])
    end = pdf["t"].quantile(0.75)
    kept = pdf[(pdf["t"] < end) & (pdf["known"] < end)]
    cuts = [kept["t"].quantile(i / 5) for i in range(1, 5)] + [np.inf]
    for fold, r in report[report["trial"] == 0].set_index("fold").iterrows():
        learned = kept[(kept["t"] < cuts[fold]) & (kept["known"] < cuts[fold])]
        tested = kept[(kept["t"] >= cuts[fold]) & (kept["t"] < cuts[fold + 1])]
        assert (r["n_train"], r["n_test"]) == (len(learned), len(tested)) and learned["known"].max() < tested["t"].min()
        slope, start = np.polyfit(learned["x"], learned["y"], 1)
        assert r["rmse"] == pytest.approx(np.sqrt(((tested["y"] - start - slope * tested["x"]) ** 2).mean()))
    worse = report.groupby("trial")["rmse"].mean()
    assert worse[0] < worse[1]


def test_isolation_scores_follow_from_path_lengths(spark, monkeypatch):
    """Scores recomputed from the trees by walking every row down every tree."""
    grown = []
    rng = np.random.default_rng(1)
    sample = rng.normal(0, 1, (64, 2))
    nodes = {n[0]: n for n in models._grow_tree(sample, np.random.default_rng(5))}

    def path(row):
        at, depth = 0, 0
        while nodes[at][1] >= 0:
            _, left, right, feature, cut, _ = nodes[at]
            at, depth = (left if row[feature] < cut else right), depth + 1
        return depth, nodes[at][5]

    sizes = {}
    for row in sample:
        depth, size = path(row)
        grown.append(depth)
        sizes[depth, size] = sizes.get((depth, size), 0) + 1
    assert max(grown) <= 6 and sum(n[5] for n in nodes.values() if n[1] < 0) == 64
    # a leaf holds exactly the rows that walk into it
    leaves = {}
    for row in sample:
        at = 0
        while nodes[at][1] >= 0:
            at = nodes[at][1] if row[nodes[at][3]] < nodes[at][4] else nodes[at][2]
        leaves[at] = leaves.get(at, 0) + 1
    assert leaves == {i: n[5] for i, n in nodes.items() if n[1] < 0}
    harmonic = lambda n: 0.0 if n < 2 else 1.0 if n == 2 else 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n
    assert models._mean_path([1, 2, 3, 64]).tolist() == pytest.approx([harmonic(n) for n in (1, 2, 3, 64)])


def test_signals_do_not_move_over_missing_rows(spark):
    df = spark.createDataFrame([("a", i, None if i == 3 else float(i)) for i in range(6)], "symbol string, ts long, x double")
    line = LinearRegression(featuresCol="features", labelCol="x", solver="normal")
    model = line.fit(models.assemble(df.where("x IS NOT NULL"), ["x"]))
    out = models.model_signals(df, SeriesSpec(("symbol",), "ts"), model, ["x"]).orderBy("ts").collect()
    assert [r["signal"] is None for r in out] == [True, False, False, False, True, False]


def test_topics_of_texts_are_fixed_points():
    """What ``settle`` returns is what a plain step of the published method leaves as it is; long and short texts side by side."""
    rng = np.random.default_rng(5)
    sizes = np.concatenate([rng.integers(1, 60, 80), [700, 1]])
    index = np.concatenate([rng.choice(900, n, replace=False) for n in sizes])
    counts, ends, alpha = rng.integers(1, 9, len(index)), np.cumsum(sizes), np.array([0.3, 0.2, 0.1])
    weights = rng.gamma(0.5, 1, (3, 900)) / 900 + 1e-9
    gamma, added = topics.settle(weights, index, counts, ends, alpha, 1)
    total = np.zeros((3, 900))
    for i, (end, n) in enumerate(zip(ends, sizes)):
        own, c = weights[:, index[end - n:end]], counts[end - n:end]
        theta = np.exp(topics.digamma(gamma[i]) - topics.digamma(gamma[i].sum()))
        share = theta[:, None] * own * (c / (theta @ own))
        assert np.abs(share.sum(axis=1) + alpha - gamma[i]).mean() <= 1e-3
        np.add.at(total.T, index[end - n:end], share.T)
    assert added == pytest.approx(total) and added.sum() == pytest.approx(counts.sum())


def test_topic_vocabulary_stays_a_table(spark, monkeypatch):
    """Blocks of few words give every word a weight, no list of words reaches the driver, and separated themes are found."""
    monkeypatch.setattr(topics.Vocabulary, "vocabulary", property(lambda self: pytest.fail("collected")))
    themes = [["apple", "banana", "cherry", "plum"], ["stock", "bond", "market", "share"]]
    rng = np.random.default_rng(3)
    rows = [([str(w) for w in rng.choice(themes[i % 2], 30)],) for i in range(60)] + [([],), (None,), (["rare"],)]
    model = topics.fit_topics(spark.createDataFrame(rows, "keywords array<string>").repartition(3), "keywords", 2, 30, block_words=200)
    assert model.words.count() == 9 and {r["topic"] for r in model.describe(3).collect()} == {0, 1}
    found = [{r["word"] for r in model.describe(4).where(f"topic = {t}").collect()} for t in (0, 1)]
    assert sorted(map(sorted, found)) == sorted(map(sorted, themes))
    assert topics.fit_topics(spark.createDataFrame(rows, "keywords array<string>"), "keywords", 2, 2, min_documents=2).words.count() == 8
    assert topics.fit_topics(spark.createDataFrame(rows[:0], "keywords array<string>"), "keywords", 2, 2).words.count() == 0


def test_topic_passes_store_bare_numbers(spark, monkeypatch):
    """However many passes, words and their places are stored once; parts of the vocabulary and words without weights do not change the model."""
    stored = []
    monkeypatch.setattr(topics, "stage", lambda df, name, held=topics.stage, **options: (stored.append(df.schema), held(df, name, **options))[1])
    rng = np.random.default_rng(4)
    rows = [([f"w{w}" for w in rng.zipf(1.3, 25) % 300],) for _ in range(80)] + [([],), (["only"],)]
    corpus = spark.createDataFrame(rows, "keywords array<string>").coalesce(1)
    model = topics.fit_topics(corpus, "keywords", 3, 4, 2, block_words=150)
    assert sum("string" in s.simpleString() for s in stored) <= 3
    known = {w for w in {w for r in rows for w in r[0]} if sum(w in r[0] for r in rows) >= 2}
    found = {r["word"]: r["lam"] for r in model.words.collect()}
    assert set(found) == known and model.words.select("term").distinct().count() == len(known)
    monkeypatch.setattr(topics, "_LEAST_PARTS", 1, raising=False)
    whole = topics.fit_topics(corpus, "keywords", 3, 4, 2, block_words=150)
    assert model.alpha == pytest.approx(whole.alpha) and {r["word"]: r["lam"] for r in whole.words.collect()} == {w: pytest.approx(v, rel=1e-4) for w, v in found.items()}
    words = ["a", "né", "日本", "x|1"]
    df = spark.createDataFrame([(w,) for w in words], "w string").coalesce(1)
    normal = np.array([list(r) for r in df.select(*[hash_normal("w", F.lit(7), F.lit(t)) for t in range(3)]).collect()])
    assert topics.draws(words, 3, 7) == pytest.approx((normal / 30 + (1 - 1 / 900)) ** 3)


def test_blocks_of_the_neighbour_search_grow_with_the_rows(spark, monkeypatch):
    """Blocks follow the number of rows up to a largest size, whatever which the neighbours are the same; single precision stays."""
    rng = np.random.default_rng(9)
    rows = [(int(i), v.tolist()) for i, v in enumerate(rng.standard_normal((9000, 4)).astype(np.float32))]
    df = spark.createDataFrame(rows, "id long, v array<float>").repartition(4)
    found = models.nearest_neighbours(df, "id", "v", k=3, pivots=1)
    small = models.nearest_neighbours(df, "id", "v", k=3, pivots=1, block=1000)
    key = ["id", "rank"]
    assert [tuple(r) for r in found.orderBy(*key).collect()] == [tuple(r) for r in small.orderBy(*key).collect()]
    monkeypatch.setattr(models, "LARGEST_BLOCK", 2048)
    cut = models.nearest_neighbours(df, "id", "v", k=3, pivots=1)
    assert [tuple(r) for r in cut.orderBy(*key).collect()] == [tuple(r) for r in small.orderBy(*key).collect()]

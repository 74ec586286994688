"""Features, imputation, outliers and models."""

from __future__ import annotations

from itertools import combinations

from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tideline.functions.expr import hash_uniform
from tideline.operators import features, models, technical
from tideline.plans.inputs import (BARS, BARS_SQL, TICKS, TICKS_SQL, TRANSFERS_SQL, bars, over, r, roll, table, ticks,
                                   tidy, transfers)
from tideline.plans.registry import query
from tideline.plans.risk import COLUMNS
from tideline.series import over_chunks

OUT = ("symbol", "ts")
LAG_NAMES = tuple(f"{c}_lag_{k}" for c in ("close", "volume") for k in (1, 2, 3, 5, 10))


@query("f1_lags", f"WITH {BARS_SQL} SELECT symbol, ts, " + r(*[f"lag({c}, {k}) {over()} AS {c}_lag_{k}" for c in ("close", "volume") for k in (1, 2, 3, 5, 10)]) + " FROM bars")
def f1_lags(spark, sf):
    return tidy(features.lags(bars(spark, sf), BARS), *OUT, *LAG_NAMES)


ROLL_NAMES = tuple(f"{c}_rolling_{s}_{w}" for c in ("close", "volume") for w in (5, 10, 20) for s in ("mean", "std"))


@query("f2_rolling_stats", f"WITH {BARS_SQL} SELECT symbol, ts, " + r(*[
    f"{roll('avg' if s == 'mean' else 'stddev_samp', c, w)} AS {c}_rolling_{s}_{w}" for c in ("close", "volume") for w in (5, 10, 20) for s in ("mean", "std")]) + " FROM bars")
def f2_rolling_stats(spark, sf):
    return tidy(features.rolling_stats(bars(spark, sf), BARS), *OUT, *ROLL_NAMES)


@query("f2_rolling_stats_ticks", f"WITH {TICKS_SQL} SELECT event_id, " + r(*[
    f"{roll('avg' if s == 'mean' else 'stddev_samp', 'price', w, order='ts, event_id')} AS price_rolling_{s}_{w}" for w in (5, 10, 20) for s in ("mean", "std")]) + " FROM ticks")
def f2_rolling_stats_ticks(spark, sf):
    out = over_chunks(ticks(spark, sf), TICKS, lambda df, spec: features.rolling_stats(df, spec, ["price"]), halo=20)
    return tidy(out, "event_id", *[f"price_rolling_{s}_{w}" for w in (5, 10, 20) for s in ("mean", "std")])


@query("f3_sentiment_features", f"""WITH {BARS_SQL}, s AS (SELECT symbol, ts, volume / trades / 50 - 1 AS sentiment FROM bars)
  SELECT symbol, ts, {r(f'sentiment - lag(sentiment) {over()} AS sentiment_change', roll('stddev_samp', 'sentiment', 10) + ' AS sentiment_volatility')} FROM s""")
def f3_sentiment_features(spark, sf):
    b = bars(spark, sf).withColumn("sentiment", F.col("volume") / F.col("trades") / 50 - 1)
    return tidy(features.sentiment_features(b, BARS), *OUT, "sentiment_change", "sentiment_volatility")


@query("m2_interactions", f"WITH {BARS_SQL} SELECT symbol, ts, " + r(*[f"{a} * {b} AS {a}_x_{b}" for a, b in combinations(COLUMNS, 2)], digits=5) + " FROM bars")
def m2_interactions(spark, sf):
    return tidy(features.interactions(bars(spark, sf), COLUMNS), *OUT, *[f"{a}_x_{b}" for a, b in combinations(COLUMNS, 2)], digits=5)


@query("m3_log1p_features", f"""WITH {BARS_SQL} SELECT symbol, ts, {r('ln(1 + close) AS log_close', 'ln(1 + volume) AS log_volume',
  'CASE WHEN close - open > -1 THEN ln(1 + (close - open)) END AS log_change')} FROM bars""")
def m3_log1p_features(spark, sf):
    b = bars(spark, sf).withColumn("change", F.col("close") - F.col("open"))
    return tidy(features.log1p_features(b, ["close", "volume", "change"]), *OUT, "log_close", "log_volume", "log_change")


@query("m4_standardize", f"""WITH {BARS_SQL} SELECT symbol, ts, {r('(close - avg(close) OVER ()) / stddev_pop(close) OVER () AS close',
  '(volume - avg(volume) OVER ()) / stddev_pop(volume) OVER () AS volume')} FROM bars""")
def m4_standardize(spark, sf):
    return tidy(features.standardize(bars(spark, sf), ["close", "volume"]), *OUT, "close", "volume")


@query("m4_standardize_per_key", f"""WITH {BARS_SQL} SELECT symbol, ts,
  {r('(close - avg(close) OVER (PARTITION BY symbol)) / stddev_pop(close) OVER (PARTITION BY symbol) AS close')} FROM bars""")
def m4_standardize_per_key(spark, sf):
    return tidy(features.standardize(bars(spark, sf), ["close"], ["symbol"]), *OUT, "close")


@query("m14_split_random", """SELECT event_id, CAST(('0x' || substr(md5(concat_ws('|', event_id, 42)), 1, 13)) AS BIGINT) / 4503599627370496.0 < 0.8 AS is_train FROM events""")
def m14_split_random(spark, sf):
    return features.split_random(table(spark, sf, "events").select("event_id"), ["event_id"])


@query("m14_split_time", f"""WITH {TICKS_SQL}, i AS (SELECT event_id, symbol, row_number() {over(order='ts, event_id')} - 1 AS idx,
    count(*) OVER (PARTITION BY symbol) AS n FROM ticks)
  SELECT event_id, symbol, CAST(CASE WHEN idx >= n - 5 * (n // 6) THEN (idx - (n - 5 * (n // 6))) // (n // 6) END AS DOUBLE) AS test_fold,
    idx < n - ceil(n * 0.2 - 1e-9) AS is_train FROM i""")
def m14_split_time(spark, sf):
    out = features.split_time(ticks(spark, sf).select("event_id", "symbol", "ts"), TICKS)
    return out.select("event_id", "symbol", F.col("test_fold").cast("double").alias("test_fold"), "is_train")


@query("m15_auto_features", r"""SELECT event_id, CAST(year(ts) AS INTEGER) AS ts_year, CAST(month(ts) AS INTEGER) AS ts_month, CAST(day(ts) AS INTEGER) AS ts_day,
  CAST(isodow(ts) - 1 AS INTEGER) AS ts_weekday, CAST(length(event_type) AS INTEGER) AS event_type_num_characters, CAST(1 AS INTEGER) AS event_type_num_words,
  CAST(length(props) AS INTEGER) AS props_num_characters, CAST(len(list_filter(regexp_split_to_array(props, '\s+'), lambda w: w <> '')) AS INTEGER) AS props_num_words FROM events""")
def m15_auto_features(spark, sf):
    return features.auto_features(table(spark, sf, "events")).drop("ts", "user_id", "event_type", "value", "props")


GAPS = """gaps AS (SELECT event_id, CASE WHEN event_id % 11 <> 3 THEN value END AS value,
  CASE WHEN event_id % 13 <> 5 THEN CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS k, CAST(user_id AS DOUBLE) AS user_id FROM events)"""


def gappy(spark, sf):
    """events where some cells are lost."""
    e = table(spark, sf, "events")
    k = F.get_json_object("props", "$.k").cast("double")
    return e.select("event_id", F.when(F.col("event_id") % 11 != 3, F.col("value")).alias("value"),
                    F.when(F.col("event_id") % 13 != 5, k).alias("k"), F.col("user_id").cast("double").alias("user_id"))


@query("m1_impute_mean", f"WITH {GAPS} SELECT event_id, {r('coalesce(value, avg(value) OVER ()) AS value', 'coalesce(k, avg(k) OVER ()) AS k')} FROM gaps")
def m1_impute_mean(spark, sf):
    return tidy(models.impute_simple(gappy(spark, sf), ["value", "k"]), "event_id", "value", "k")


@query("m1_impute_iterative")
def m1_impute_iterative(spark, sf):
    return tidy(models.impute_iterative(gappy(spark, sf), ["value", "k", "user_id"]), "event_id", "value", "k", "user_id")


@query("m5_isolation_forest")
def m5_isolation_forest(spark, sf):
    out = models.isolation_forest(ticks(spark, sf).select("event_id", "price", "volume"), ["event_id"], ["price", "volume"], keep="anomalies")
    return tidy(out)


LOF_SQL = """p AS (SELECT a.vec_id, b.vec_id AS other, sqrt(list_sum(list_transform(list_zip(a.embedding, b.embedding),
    lambda z: (CAST(z[1] AS DOUBLE) - CAST(z[2] AS DOUBLE)) ** 2))) AS d FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id),
nn AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, other) AS rank FROM p QUALIFY rank <= 20),
kd AS (SELECT vec_id, max(d) AS kdist FROM nn GROUP BY vec_id),
dens AS (SELECT n.vec_id, 1 / (avg(greatest(d, kdist)) + 1e-10) AS lrd FROM nn n JOIN kd ON kd.vec_id = n.other GROUP BY n.vec_id),
lof AS (SELECT n.vec_id, any_value(a.lrd) AS lrd, avg(b.lrd) / any_value(a.lrd) AS lof FROM nn n JOIN dens a ON a.vec_id = n.vec_id
   JOIN dens b ON b.vec_id = n.other GROUP BY n.vec_id)"""


@query("m6_local_outlier", f"WITH {LOF_SQL} SELECT vec_id, {r('lrd', 'lof')} FROM lof")
def m6_local_outlier(spark, sf):
    return tidy(models.local_outlier(table(spark, sf, "embeddings"), "vec_id", "embedding"))


def vectors(spark, sf):
    e = table(spark, sf, "embeddings")
    return e.select("vec_id", array_to_vector(e["embedding"].cast("array<double>")).alias("v"))


@query("m7_pca")
def m7_pca(spark, sf):
    """Squared length of the centred projection that keeps 95% of the variance."""
    from pyspark.ml.functions import vector_to_array
    out, _ = models.pca(vectors(spark, sf), "v")
    p = vector_to_array("pca")
    return tidy(out.select("vec_id", F.size(p).alias("n_components"), F.aggregate(p, F.lit(0.0), lambda a, x: a + x * x).alias("squared_length")))


@query("m8_pca_anomaly")
def m8_pca_anomaly(spark, sf):
    t = transfers(spark, sf).select("tx_id", "transactionVolume", "fees", "walletActivity", "gasUsed", "close")
    out = models.pca_anomaly(t, ["transactionVolume", "fees", "walletActivity", "gasUsed", "close"], k=2, keep="anomalies")
    return tidy(out, "tx_id", "reconstruction_error", "severity")


def feature_rows(spark, sf):
    """All bars with features and target, some of them missing."""
    b = technical.rate_of_change(features.lags(bars(spark, sf), BARS, steps=(1, 2)), BARS)
    return b.withColumn("target", F.lead("close", 1).over(BARS.window))


def feature_frame(spark, sf):
    return feature_rows(spark, sf).na.drop()


FEATURES = ("open", "high", "low", "close", "volume", "close_lag_1", "momentum")


@query("m9_feature_selection")
def m9_feature_selection(spark, sf):
    return tidy(models.feature_selection(feature_frame(spark, sf), FEATURES, "target", wanted=4))


@query("m10_feature_importance")
def m10_feature_importance(spark, sf):
    return tidy(models.feature_importance(feature_frame(spark, sf), FEATURES, "target"))


@query("m11_risk_predictor")
def m11_risk_predictor(spark, sf):
    b = features.lags(bars(spark, sf), BARS, steps=(1,))
    out, _ = models.risk_predictor(b, BARS, ["open", "high", "low", "close", "volume", "close_lag_1"])
    return tidy(out, *OUT, "next_return", "predicted_return")


@query("m12_model_signals")
def m12_model_signals(spark, sf):
    """Fitted on complete rows; every row stays, so that a signal moves by one row and never over a gap."""
    frame = feature_rows(spark, sf)
    forest = RandomForestRegressor(featuresCol="features", labelCol="target", numTrees=10, seed=7)
    model = forest.fit(models.assemble(frame.where(models.complete([*FEATURES, "target"])), FEATURES))
    return tidy(models.model_signals(frame, BARS, model, FEATURES), *OUT, "signal")


@query("m16_feature_pipeline")
def m16_feature_pipeline(spark, sf):
    b = bars(spark, sf).withColumn("sentiment", F.col("volume") / F.col("trades") / 50 - 1)
    return tidy(features.feature_pipeline(b, BARS))


# ---------------------------------------------------------------- the same operators where SQL knows the answer

@query("m1_impute_one_gap", f"""WITH {GAPS}, f AS (SELECT regr_slope(k, user_id) AS b, regr_intercept(k, user_id) AS a FROM gaps WHERE k IS NOT NULL)
  SELECT event_id, {r('coalesce(k, a + b * user_id) AS k', digits=4)} FROM gaps, f""")
def m1_impute_one_gap(spark, sf):
    """One incomplete column and one complete one: the line fitted on the observed rows."""
    out = models.impute_iterative(gappy(spark, sf).select("event_id", "k", "user_id"), ["k", "user_id"])
    return tidy(out, "event_id", "k", digits=4)


def chained_sql(rounds: int) -> str:
    """Two incomplete columns, each the line on the other's values of the round before, mean at first: tables i0 to i{rounds}."""
    start = "i0 AS (SELECT event_id, value AS v0, k AS k0, coalesce(value, avg(value) OVER ()) AS v, coalesce(k, avg(k) OVER ()) AS k FROM gaps)"
    steps = [f"""f{n} AS (SELECT regr_slope(v0, k) AS bv, regr_intercept(v0, k) AS av, regr_slope(k0, v) AS bk, regr_intercept(k0, v) AS ak FROM i{n - 1}),
  i{n} AS (SELECT event_id, v0, k0, coalesce(v0, av + bv * k) AS v, coalesce(k0, ak + bk * v) AS k FROM i{n - 1}, f{n})""" for n in range(1, rounds + 1)]
    return ", ".join([start, *steps])


@query("m1_impute_two_gaps", f"""WITH {GAPS}, {chained_sql(10)} SELECT event_id, {r('v AS value', 'k', digits=5)} FROM i10""")
def m1_impute_two_gaps(spark, sf):
    """Ten rounds on two incomplete columns, some rows without either."""
    out = models.impute_iterative(gappy(spark, sf).select("event_id", "value", "k"), ["value", "k"], rounds=10, ridge=0.0, tolerance=0.0)
    return tidy(out, "event_id", "value", "k", digits=5)


@query("m5_planted_outliers", "SELECT -row_number() OVER (ORDER BY event_id) AS event_id FROM events QUALIFY row_number() OVER (ORDER BY event_id) <= 3")
def m5_planted_outliers(spark, sf):
    """Rows far outside all others are among the flagged ones."""
    t = ticks(spark, sf).select("event_id", "price", "volume")
    planted = t.orderBy("event_id").limit(3).select((-F.row_number().over(W.orderBy("event_id"))).cast("long").alias("event_id"),
                                                   (F.col("price") + 1e6).alias("price"), (F.col("volume") - 1e6).alias("volume"))
    out = models.isolation_forest(t.unionByName(planted), ["event_id"], ["price", "volume"], keep="anomalies")
    return out.where("event_id < 0").select("event_id")


@query("m7_pca_all_components", f"""WITH e AS (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
  m AS (SELECT i, avg(x) AS m FROM e GROUP BY i) SELECT vec_id, {r('sum((x - m) ** 2) AS squared_length')} FROM e JOIN m USING (i) GROUP BY vec_id""")
def m7_pca_all_components(spark, sf):
    """With all components the projection keeps the centred vector's length."""
    from pyspark.ml.functions import vector_to_array
    e = vectors(spark, sf)
    size = len(e.first()["v"])
    out, _ = models.pca(e, "v", k=size)
    return tidy(out.select("vec_id", F.aggregate(vector_to_array("pca"), F.lit(0.0), lambda a, x: a + x * x).alias("squared_length")))


@query("m8_pca_anomaly_pair", f"""WITH {TRANSFERS_SQL}, c AS (SELECT tx_id, transactionVolume AS x, fees AS y FROM transfers),
  s AS (SELECT avg(x) AS mx, stddev_samp(x) AS sx, avg(y) AS my, stddev_samp(y) AS sy, corr(x, y) AS r FROM c WHERE x IS NOT NULL AND y IS NOT NULL)
  SELECT tx_id, {r("(CASE WHEN r > 0 THEN (x - mx) / sx - (y - my) / sy ELSE (x - mx) / sx + (y - my) / sy END) ** 2 / 2 AS reconstruction_error")} FROM c, s""")
def m8_pca_anomaly_pair(spark, sf):
    """Two scaled features and one component: the distance from the diagonal. Orders without lines stay, without an error."""
    t = transfers(spark, sf).select("tx_id", "transactionVolume", "fees")
    return tidy(models.pca_anomaly(t, ["transactionVolume", "fees"], k=1), "tx_id", "reconstruction_error")


@query("m9_selection_properties", """SELECT * FROM (VALUES ('boosted', 7, 0), ('lasso', 7, 0), ('rfe', 7, 4)) AS t(method, n_features, n_wanted)""")
def m9_selection_properties(spark, sf):
    """Every method scores every feature; elimination keeps as many as wanted."""
    out = models.feature_selection(feature_frame(spark, sf), FEATURES, "target", wanted=4)
    return out.groupBy("method").agg(F.countDistinct("feature").cast("int").alias("n_features"), F.when(
        F.col("method") == "rfe", F.count_if("selected")).otherwise(F.lit(0)).cast("int").alias("n_wanted"))


@query("m10_importance_properties", "SELECT 7 AS n_features, CAST(1 AS DOUBLE) AS total")
def m10_importance_properties(spark, sf):
    """Importances are shares."""
    out = models.feature_importance(feature_frame(spark, sf), FEATURES, "target")
    return tidy(out.agg(F.count("feature").cast("int").alias("n_features"), F.sum("importance").alias("total")))


@query("m11_predicted_rows", f"""WITH {BARS_SQL} SELECT symbol, ts, {r(f'lead(close) {over()} / close - 1 AS next_return')}, lag(close) {over()} IS NOT NULL AS predicted FROM bars""")
def m11_predicted_rows(spark, sf):
    """Every bar comes back with its target; only those without a feature lack a prediction."""
    b = features.lags(bars(spark, sf), BARS, steps=(1,))
    out, _ = models.risk_predictor(b, BARS, ["close", "volume", "close_lag_1"], trees=(10,))
    return tidy(out.withColumn("predicted", F.col("predicted_return").isNotNull()), *OUT, "next_return", "predicted")


@query("m12_model_signals_linear", f"""WITH {BARS_SQL}, t AS (SELECT symbol, ts, close, lead(close) {over()} AS target FROM bars),
  f AS (SELECT regr_slope(target, close) AS b, regr_intercept(target, close) AS a FROM t WHERE target IS NOT NULL)
  SELECT symbol, ts, {r(f'lag(a + b * close) {over()} AS signal', digits=4)} FROM t, f""")
def m12_model_signals_linear(spark, sf):
    """A line on one feature, acted on one bar later."""
    frame = bars(spark, sf).withColumn("target", F.lead("close", 1).over(BARS.window))
    line = LinearRegression(featuresCol="features", labelCol="target", solver="normal")
    model = line.fit(models.assemble(frame.where("target IS NOT NULL"), ["close"]))
    return tidy(models.model_signals(frame, BARS, model, ["close"]), *OUT, "signal", digits=4)


@query("m11_walk_forward_linear", f"""WITH {BARS_SQL}, a AS (SELECT symbol, ts, close, lead(close) {over()} / close - 1 AS y, lead(ts) {over()} AS known FROM bars),
  b AS (SELECT CAST(epoch_us(ts) AS DOUBLE) AS t, CAST(epoch_us(known) AS DOUBLE) AS k, close AS x, y FROM a WHERE y IS NOT NULL),
  h AS (SELECT quantile_cont(t, 0.8) AS h FROM b), s AS (SELECT b.* FROM b, h WHERE t < h AND k < h),
  q AS (SELECT quantile_cont(t, [{', '.join(str(i / 6) for i in range(1, 6))}]) AS cuts FROM s), c AS (SELECT f, cuts[f + 1] AS cut FROM q, range(5) AS r(f)),
  d AS (SELECT f, cut, coalesce(lead(cut) OVER (ORDER BY f), 'infinity') AS upto FROM c),
  l AS (SELECT f, count(*) AS n_train, regr_slope(y, x) AS w, regr_intercept(y, x) AS v FROM s, d WHERE t < cut AND k < cut GROUP BY f)
  SELECT CAST(f AS INTEGER) AS fold, any_value(n_train) AS n_train, count(*) AS n_test, {r('sqrt(avg((y - v - w * x) ** 2)) AS rmse')}
  FROM s JOIN d ON t >= cut AND t < upto JOIN l USING (f) GROUP BY f""")
def m11_walk_forward_linear(spark, sf):
    """The folds of the search, with a line in place of the forest: SQL knows every fold's rows and error."""
    following = F.lead(F.struct("close", "ts"), 1).over(BARS.window)
    b = bars(spark, sf).withColumn("f", following).select("ts", "close", (F.col("f.close") / F.col("close") - 1).alias("y"), F.col("f.ts").alias("known"))
    line = LinearRegression(featuresCol="features", labelCol="y", solver="normal")
    search = models.walk_forward(b, "ts", "known", ["close"], "y", line, [{"regParam": 0.0}])
    return tidy(search.report, "fold", "n_train", "n_test", "rmse")


def planted(spark, sf):
    """Five features that are hashes of a bar, two of which make the target."""
    b = bars(spark, sf).select("symbol", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at"))
    x = {f"x{i}": hash_uniform("symbol", "at", F.lit(i)) for i in range(5)}
    return b.withColumns(x).withColumn("target", 3 * F.col("x1") + 2 * F.col("x3") + 0.1 * F.col("x0"))


PLANTED_SQL = BARS_SQL + ", pl AS (SELECT " + ", ".join(
    f"CAST(('0x' || substr(md5(concat_ws('|', symbol, strftime(ts, '%Y-%m-%d %H:%M:%S'), {i})), 1, 13)) AS BIGINT) / 4503599627370496.0 AS x{i}" for i in range(5)) + """ FROM bars),
pt AS (SELECT *, 3 * x1 + 2 * x3 + 0.1 * x0 AS target FROM pl),
pc AS (UNPIVOT (SELECT """ + ", ".join(f"abs(corr(x{i}, target)) AS x{i}" for i in range(5)) + """ FROM pt) ON COLUMNS(*) INTO NAME feature VALUE strength)"""


@query("m9_selection_planted", f"""WITH {PLANTED_SQL}, top AS (SELECT feature FROM pc ORDER BY strength DESC LIMIT 2)
  SELECT method, feature, feature IN (SELECT feature FROM top) AS chosen FROM pc, (VALUES ('rfe'), ('lasso'), ('boosted')) AS m(method)""")
def m9_selection_planted(spark, sf):
    """Every method puts the two features that make the target first: those with the strongest correlations in the table."""
    out = models.feature_selection(planted(spark, sf), [f"x{i}" for i in range(5)], "target", wanted=2)
    rank = F.row_number().over(W.partitionBy("method").orderBy(F.desc("selected"), F.desc("score")))
    return out.select("method", "feature", (rank <= 2).alias("chosen"))


@query("m10_importance_planted", f"WITH {PLANTED_SQL} SELECT feature, CAST(row_number() OVER (ORDER BY strength DESC) AS INTEGER) AS rank FROM pc QUALIFY rank <= 2")
def m10_importance_planted(spark, sf):
    out = models.feature_importance(planted(spark, sf), [f"x{i}" for i in range(5)], "target")
    ranked = out.withColumn("rank", F.row_number().over(W.orderBy(F.desc("importance"))))  # one row per feature
    return ranked.where("rank <= 2").select("feature", "rank")


def z_sql(*columns: str) -> list[str]:
    return [f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () AS {c}" for c in columns]


PIPELINE = ("hour", "close_lag_1", "close_rolling_mean_5", "volume_rolling_std_10", "sentiment_change", "sma_10")


@query("m16_feature_pipeline_scaled", f"""WITH {BARS_SQL}, s AS (SELECT *, volume / trades / 50 - 1 AS sentiment FROM bars),
  f AS (SELECT symbol, ts, CAST(hour(ts) AS DOUBLE) AS hour, lag(close) {over()} AS close_lag_1, {roll('avg', 'close', 5)} AS close_rolling_mean_5,
    {roll('stddev_samp', 'volume', 10)} AS volume_rolling_std_10, sentiment - lag(sentiment) {over()} AS sentiment_change, {roll('avg', 'close', 10)} AS sma_10,
    close / lag(close) {over()} - 1 AS returns FROM s)
  SELECT symbol, ts, {r(*z_sql(*PIPELINE), 'returns')} FROM f""")
def m16_feature_pipeline_scaled(spark, sf):
    """The whole pipeline without the removal of outliers, whose trees SQL does not know."""
    b = bars(spark, sf).withColumn("sentiment", F.col("volume") / F.col("trades") / 50 - 1)
    return tidy(features.feature_pipeline(b, BARS, contamination=None), *OUT, *PIPELINE, "returns")

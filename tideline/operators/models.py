"""Imputation, outliers, reduction, selection and predictors."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import PCA, Imputer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from tideline.functions.expr import hash_uniform, ratio
from tideline.series import SeriesSpec, quantiles
from tideline.staging import stage


def assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    """All rows, with a vector of the features; NaN stands for a missing one."""
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep").transform(df)


def complete(features: Sequence[str]) -> Column:
    """Whether no feature of a row is missing. Models are fitted on such rows and give NULL for others."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in features])


def predict(df: DataFrame, model, features: Sequence[str]) -> DataFrame:
    """Every row with the model's prediction, NULL where a feature is missing."""
    out = model.getPredictionCol()
    return model.transform(assemble(df, features)).withColumn(out, F.when(complete(features), F.col(out))).drop("features")


# ---------------------------------------------------------------- M1

def impute_simple(df: DataFrame, columns: Sequence[str], strategy: str = "mean") -> DataFrame:
    """Mean or median of the whole table in place of NULL."""
    df = df.withColumns({c: F.col(c).cast("double") for c in columns})
    return Imputer(inputCols=list(columns), outputCols=list(columns), strategy=strategy).fit(df).transform(df)


def pattern_moments(df: DataFrame, columns: Sequence[str]) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Per pattern of missing cells, the sums of products of (1, the observed columns less ``shift``), and ``shift``.

    One aggregation over the table: a row per pattern that occurs ('01...', 1 for missing) comes back. Missing columns have zeros. The shift, means of the
    first rows, only keeps the products small.
    """
    first = np.array([[np.nan if v is None else float(v) for v in row] for row in df.select(*columns).take(100)]).reshape(-1, len(columns))
    shift = np.array([c[np.isfinite(c)].mean() if np.isfinite(c).any() else 0.0 for c in first.T])
    pattern = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in columns])
    terms = [F.lit(1.0), *[F.coalesce(F.col(c).cast("double") - F.lit(float(m)), F.lit(0.0)) for c, m in zip(columns, shift)]]
    sums = [F.sum(a * b).alias(f"{i}|{j}") for i, a in enumerate(terms) for j, b in enumerate(terms) if j >= i]
    size = len(terms)
    found = {}
    for row in df.groupBy(pattern.alias("pattern")).agg(*sums).collect():
        found[row["pattern"]] = np.array([[row[f"{min(i, j)}|{max(i, j)}"] for j in range(size)] for i in range(size)], dtype=float)
    return found, shift


def fit_fills(moments: dict[str, np.ndarray], shift: np.ndarray, rounds: int, ridge: float, tolerance: float) -> dict[str, np.ndarray]:
    """Per pattern, a matrix that turns (1, observed columns less ``shift``) into all columns less ``shift``, missing ones filled in.

    A filled cell is a linear function of its row's observed cells in every round (the mean, at the start), and a regression needs only sums of
    products, which follow from those of the patterns. So all rounds run on these matrices.
    """
    size = len(shift) + 1
    seen = {p: np.array([c == "0" for c in p]) for p in moments}
    total = sum(m[0, 0] for m in moments.values())
    count = np.array([sum(m[0, 0] for p, m in moments.items() if seen[p][c]) for c in range(size - 1)])
    sums = np.array([sum(m[0, c + 1] for p, m in moments.items() if seen[p][c]) for c in range(size - 1)])
    means = sums / np.maximum(count, 1)
    gaps = [c for c in range(size - 1) if 0 < count[c] < total]
    fills = {}
    for p in moments:
        fill = np.zeros((size - 1, size))
        for c in range(size - 1):
            fill[c, c + 1 if seen[p][c] else 0] = 1.0 if seen[p][c] else means[c]
        fills[p] = fill
    centre = np.eye(size)
    centre[1:, 0] = -means
    previous = None
    for _ in range(rounds if gaps else 0):
        whole = {p: np.vstack([np.eye(1, size), fill]) for p, fill in fills.items()}
        products = {p: w @ moments[p] @ w.T for p, w in whole.items()}
        coefficients, solved = [], {}
        for target in gaps:
            joint = sum(m for p, m in products.items() if seen[p][target])
            inputs = [0, *[c + 1 for c in range(size - 1) if c != target]]
            gram = (centre @ joint @ centre.T)[np.ix_(inputs, inputs)]
            gram[1:, 1:] += np.diag(ridge * np.diag(gram)[1:] + 1e-12)
            solved[target] = np.linalg.lstsq(gram, (centre @ joint)[inputs, target + 1], rcond=None)[0]
            coefficients.append(solved[target] + np.eye(1, len(inputs)).ravel() * shift[target])
        updated = {p: fill.copy() for p, fill in fills.items()}
        for target in gaps:
            weights = np.zeros(size)
            weights[[0, *[c + 1 for c in range(size - 1) if c != target]]] = solved[target]
            for p in fills:
                if not seen[p][target]:
                    updated[p][target] = weights @ centre @ whole[p]
        fills = updated
        current = np.concatenate(coefficients)
        if previous is not None and np.max(np.abs(current - previous)) <= tolerance * (1 + np.max(np.abs(current))):
            break
        previous = current
    return fills


def impute_iterative(df: DataFrame, columns: Sequence[str], rounds: int = 10, ridge: float = 1e-6,
                     tolerance: float = 1e-4) -> DataFrame:
    """M1: every incomplete column is predicted from all the others, round after round.

    The table is read twice and never copied: once for sums of products per pattern of missing cells (at most 2 ** incomplete columns patterns, and
    only those that occur), once to fill the cells, each pattern with its own equations. Observed cells never change. A column without any value stays NULL.
    """
    columns = list(columns)
    moments, shift = pattern_moments(df, columns)
    size = len(columns)
    fills = fit_fills(moments, shift, rounds, ridge, tolerance)
    known = [any(p[c] == "0" for p in moments) for c in range(size)]
    gaps = [c for c in range(size) if known[c] and any(p[c] == "1" for p in moments)]
    if not gaps:
        return df
    rows = [(p, [[float(v) for v in fill[c]] for c in gaps]) for p, fill in fills.items()]
    equations = df.sparkSession.createDataFrame(rows, "_pattern string, _equations array<array<double>>")
    pattern = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in columns])
    observed = [F.coalesce(F.col(c).cast("double") - F.lit(float(m)), F.lit(0.0)) for c, m in zip(columns, shift)]
    filled = {}
    for place, c in enumerate(gaps):
        weights = F.get("_equations", F.lit(place))
        value = F.get(weights, F.lit(0)) + F.lit(float(shift[c]))
        for j, x in enumerate(observed):
            if j != c:
                value = value + F.get(weights, F.lit(j + 1)) * x
        filled[columns[c]] = F.coalesce(F.col(columns[c]).cast("double"), value)
    joined = df.withColumn("_pattern_of", pattern).join(equations, F.col("_pattern_of") == F.col("_pattern"), "left")
    return joined.withColumns(filled).select(*df.columns)


# ---------------------------------------------------------------- M5

def _grow_tree(rows: np.ndarray, rng: np.random.Generator) -> list[tuple]:
    """Nodes (id, left, right, feature, cut, size) of one isolation tree over a small sample."""
    nodes, limit = [], int(np.ceil(np.log2(max(len(rows), 2))))
    pending, following = [(0, rows, 0)], 1
    while pending:
        node, part, depth = pending.pop()
        spans = part.max(axis=0) - part.min(axis=0)
        usable = np.flatnonzero(spans > 0)
        if depth >= limit or len(part) <= 1 or not len(usable):
            nodes.append((node, -1, -1, -1, 0.0, len(part)))
            continue
        feature = int(rng.choice(usable))
        cut = float(rng.uniform(part[:, feature].min(), part[:, feature].max()))
        below = part[:, feature] < cut
        nodes.append((node, following, following + 1, feature, cut, len(part)))
        pending += [(following, part[below], depth + 1), (following + 1, part[~below], depth + 1)]
        following += 2
    return nodes


def _mean_path(n: np.ndarray) -> np.ndarray:
    """Expected depth of an unsuccessful search among n points (published normalisation)."""
    n = np.asarray(n, dtype=float)
    safe = np.maximum(n, 2)
    value = 2 * (np.log(safe - 1) + np.euler_gamma) - 2 * (safe - 1) / safe
    return np.where(n > 2, value, np.where(n == 2, 1.0, 0.0))


def isolation_forest(df: DataFrame, keys: Sequence[str], features: Sequence[str], trees: int = 100, sample: int = 256,
                     contamination: float = 0.01, keep: str = "all", seed: int = 7) -> DataFrame:
    """M5: add ``anomaly_score``, ``anomaly`` (the worst ``contamination`` share) and ``severity``.

    Trees need small random samples only (that is the method): a base sample of ``trees`` * ``sample`` rows is drawn by a
    hash of the row key, each tree draws its rows from it by another hash, and Spark grows the trees in parallel. The grown trees
    (at most trees * 2 * sample nodes) are shipped to the tasks that score the whole table in Arrow batches. ``keep``
    is 'all', 'anomalies' or 'clean'. Rows with a missing feature are neither learned from nor scored (NULL, no anomaly).
    """
    features, keys = list(features), list(keys)
    total = df.count()
    if not total:
        return df.withColumns({"anomaly_score": F.lit(None).cast("double"), "anomaly": F.lit(None).cast("boolean"),
                               "severity": F.lit(None).cast("double")})
    base_share = min(1.0, trees * sample / total)
    base = df.where(hash_uniform(*keys, F.lit(seed)) < base_share).where(complete(features))
    base = stage(base.select(*keys, *[F.col(c).cast("double").alias(c) for c in features]), "forest")
    share = min(1.0, sample / max(1.0, base_share * total))
    drawn = (base.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
             .where(hash_uniform(*keys, F.col("tree"), F.lit(seed)) < share).select("tree", *features))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        rows = pdf[features].to_numpy(dtype=float)
        rows = rows[np.lexsort(rows.T)]  # the same tree whatever order the rows arrive in
        nodes = _grow_tree(rows, np.random.default_rng([seed, tree]))
        return pd.DataFrame([(tree, *n) for n in nodes],
                            columns=["tree", "node", "left", "right", "feature", "cut", "size"])

    forest = drawn.groupBy("tree").applyInPandas(
        grow, "tree int, node int, left int, right int, feature int, cut double, size int").toPandas()
    if forest.empty:
        return flag_worst(df.withColumn("anomaly_score", F.lit(None).cast("double")), "anomaly_score", contamination, keep)
    packed = [g.sort_values("node").to_numpy(dtype=float)[:, 2:] for _, g in forest.groupby("tree")]
    expected = float(np.mean([_mean_path([t[0, 4]])[0] for t in packed])) or 1.0

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = batch[features].to_numpy(dtype=float)
            missing = np.isnan(rows).any(axis=1)
            rows = np.nan_to_num(rows, nan=0.0)
            depth = np.zeros(len(rows))
            for tree in packed:
                at = np.zeros(len(rows), dtype=int)
                while True:
                    inner = tree[at, 0] >= 0
                    if not inner.any():
                        break
                    here = tree[at[inner]]
                    goes_left = rows[inner, here[:, 2].astype(int)] < here[:, 3]
                    at[inner] = np.where(goes_left, here[:, 0], here[:, 1]).astype(int)
                    depth[inner] += 1
                depth += _mean_path(tree[at, 4])
            batch["anomaly_score"] = np.where(missing, np.nan, np.power(2.0, -depth / len(packed) / expected))
            yield batch

    schema = T.StructType([*df.schema.fields, T.StructField("anomaly_score", T.DoubleType())])
    scored = stage(df.mapInPandas(score, schema), "scores")
    return flag_worst(scored, "anomaly_score", contamination, keep)


def flag_worst(df: DataFrame, score: str, contamination: float, keep: str = "all") -> DataFrame:
    """Mark rows whose score is above the (1 - contamination) quantile; severity is the distance above it.

    Rows without a score count for nothing; rows that share the limit's score are not marked.
    """
    limit = F.broadcast(quantiles(df.where(F.col(score).isNotNull()), [], score, {"_limit": 1 - contamination}).withColumn("_k", F.lit(1)))  # one row
    out = df.withColumn("_k", F.lit(1)).join(limit, "_k", "left").drop("_k")
    out = out.withColumns({"anomaly": F.coalesce(F.col(score) > F.col("_limit"), F.lit(False)),
                           "severity": F.col(score) - F.col("_limit")}).drop("_limit")
    if keep == "all":
        return out
    return out.where("anomaly") if keep == "anomalies" else out.where("NOT anomaly")


# ---------------------------------------------------------------- M6

# Rows of a block of the neighbour search: a few thousand on small tables, so that all tasks have work; at most so many on large ones.
LARGEST_BLOCK = 65_536


def nearest_neighbours(df: DataFrame, key: str, vector: str, k: int = 20, pivots: int = 32, block: int | None = None,
                       seed: int = 7) -> DataFrame:
    """Exact k nearest rows (Euclidean) of every row: (key, neighbour, distance, rank).

    Rows are assigned to the nearest of a few pivots. The triangle inequality tells, per row, which cells can hold a
    nearer neighbour than the k it is sure to find; only those are searched. A cell is cut into blocks, and the rows
    searching a block into groups of the same size, so a crowded cell is many equal tasks. A task returns k
    candidates per row, never pairs. A row travels to every block it searches, so blocks (where ``block`` is not given) grow with the cells, up to
    ``LARGEST_BLOCK`` rows; vectors of single precision travel as such.
    """
    single = df.schema[vector].dataType.simpleString() == "array<float>"
    rows = df.select(F.col(key).alias("_id"), F.col(vector).cast("array<float>" if single else "array<double>").alias("_v"))
    # a fixed number of pivots, drawn by hash
    chosen = rows.select("_v", hash_uniform("_id", F.lit(seed)).alias("_u")).orderBy("_u").limit(pivots).collect()
    centres = np.array([r["_v"] for r in chosen], dtype=float)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            points = np.stack(batch["_v"].to_numpy()).astype(float)
            # plain differences: the expanded square loses all digits far from the origin
            distances = np.concatenate([np.sqrt(((points[i:i + 512, None, :] - centres[None]) ** 2).sum(2))
                                        for i in range(0, len(points), 512)])
            batch["_cell"] = distances.argmin(1).astype("int32")
            batch["_far"] = distances.min(1)
            batch["_all"] = list(distances)
            yield batch

    placed = stage(rows.mapInPandas(assign, T.StructType([
        *rows.schema.fields, T.StructField("_cell", T.IntegerType()), T.StructField("_far", T.DoubleType()),
        T.StructField("_all", T.ArrayType(T.DoubleType()))])), "cells")
    # per cell: size, inner and outer radius (a cell of more than k rows surely holds k neighbours within its radius)
    stats = {r["_cell"]: r for r in placed.groupBy("_cell").agg(
        F.count(F.lit(1)).alias("n"), F.min("_far").alias("near"), F.max("_far").alias("far")).collect()}
    holds = {c: float(r["far"]) for c, r in stats.items() if r["n"] > k}
    if block is None:
        block = min(max(4096, sum(r["n"] for r in stats.values()) // 16), LARGEST_BLOCK)
    blocks = {c: -(-r["n"] // block) for c, r in stats.items()}
    cells = sorted(stats)
    at = F.col("_all")
    slack = 1 + 1e-9
    if holds:
        reach = F.least(*[F.get(at, c) + r for c, r in holds.items()], F.lit(float("inf"))) * slack + 1e-300
    else:
        reach = F.lit(float("inf"))
    wanted = F.filter(F.array(*[F.when(F.greatest(F.get(at, c) - float(stats[c]["far"]) * slack, float(stats[c]["near"]) - F.get(at, c) * slack,
                                                  F.lit(0.0)) <= reach, F.lit(c)) for c in cells]), lambda c: c.isNotNull())
    count_of = F.create_map(*[x for c in cells for x in (F.lit(c), F.lit(int(blocks[c])))])
    base = placed.withColumn("_block", F.floor(hash_uniform("_id", F.lit("b")) * F.element_at(count_of, F.col("_cell"))).cast("int"))
    asks = placed.withColumn("_cell", F.explode(wanted)).withColumn(
        "_block", F.explode(F.sequence(F.lit(0), F.element_at(count_of, F.col("_cell")) - 1)))
    load = asks.groupBy("_cell", "_block").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("_groups"))
    asks = asks.join(load, ["_cell", "_block"])  # one row per block, whose number grows with the rows: how to join is the optimizer's choice
    asks = asks.withColumn("_group", F.floor(hash_uniform("_id", F.lit("g")) * F.col("_groups")).cast("int"))
    base = base.join(F.broadcast(load), ["_cell", "_block"]).withColumn(
        "_group", F.explode(F.sequence(F.lit(0), F.col("_groups") - 1)))

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"_id": [], "_other": [], "_d": []})
        right = right.sort_values("_bid")
        others = right["_bid"].to_numpy()
        points, targets = np.stack(left["_v"].to_numpy()).astype(float), np.stack(right["_bv"].to_numpy()).astype(float)
        middle = targets.mean(axis=0)
        sizes = ((targets - middle) ** 2).sum(1)
        out, step = [], max(1, 512 * 4096 // max(4096, len(targets)))  # the table of distances stays as small as that of small blocks
        for start in range(0, len(points), step):
            part, ids = points[start:start + step], left["_id"].to_numpy()[start:start + step]
            own = ((part - middle) ** 2).sum(1)
            rough = own[:, None] - 2 * (part - middle) @ (targets - middle).T + sizes[None]
            rough[ids[:, None] == others[None]] = np.inf
            # Every row within the rounding error of the k-th rough value may be among the nearest, ties included.
            error = 64 * np.finfo(float).eps * points.shape[1] * (own + sizes.max())
            limit = np.partition(rough, min(k, len(others)) - 1, axis=1)[:, min(k, len(others)) - 1] + 2 * error
            a, b = np.nonzero((rough <= limit[:, None]) & np.isfinite(rough))
            exact = np.concatenate([np.sqrt(((part[a[i:i + 65_536]] - targets[b[i:i + 65_536]]) ** 2).sum(1))
                                    for i in range(0, len(a), 65_536)]) if len(a) else np.zeros(0)
            order = np.lexsort((b, exact, a))  # others are sorted, so positions break ties like ids
            first = np.searchsorted(a[order], np.arange(len(part)))
            kept = order[np.arange(len(order)) - first[a[order]] < k]
            out.append(pd.DataFrame({"_id": ids[a[kept]], "_other": others[b[kept]], "_d": exact[kept]}))
        return pd.concat(out)

    kind = dict(rows.dtypes)["_id"]
    group = ["_cell", "_block", "_group"]
    renamed = base.select(*[F.col(c).alias(f"_b{c}") for c in (*group, "_id", "_v")]).withColumnsRenamed(
        {"_b_id": "_bid", "_b_v": "_bv"})
    found = asks.select(*group, "_id", "_v").groupBy(*group).cogroup(
        renamed.groupBy(*[f"_b{c}" for c in group])).applyInPandas(search, f"_id {kind}, _other {kind}, _d double")
    # only the k best candidates of a map task are shuffled
    best = W.partitionBy("_id").orderBy("_d", "_other")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select(F.col("_id").alias(key), F.col("_other").alias("neighbour"), F.col("_d").alias("distance"), "rank")


def local_outlier(df: DataFrame, key: str, vector: str, k: int = 20, contamination: float | None = None, keep: str = "all",
                  **options) -> DataFrame:
    """M6: local outlier factor of every row, from its exact k nearest neighbours.

    With ``contamination`` the worst share is flagged (``anomaly``, ``severity``) as by the other outlier methods.
    """
    near = stage(nearest_neighbours(df, key, vector, k, **options), "neighbours")
    reach = near.groupBy(key).agg(F.max("distance").alias("_kdist"))
    other = reach.withColumnsRenamed({key: "neighbour", "_kdist": "_other_kdist"})
    density = near.join(other, "neighbour").groupBy(key).agg(
        F.try_divide(F.lit(1.0), F.avg(F.greatest("distance", "_other_kdist")) + 1e-10).alias("lrd"))
    density = stage(density, "density")
    neighbour_density = density.withColumnsRenamed({key: "neighbour", "lrd": "_other_lrd"})
    factor = near.join(neighbour_density, "neighbour").groupBy(key).agg(F.avg("_other_lrd").alias("_mean"))
    out = factor.join(density, key).select(key, "lrd", (F.col("_mean") / F.col("lrd")).alias("lof"))
    return out if contamination is None else flag_worst(out, "lof", contamination, keep)


# ---------------------------------------------------------------- M7, M8

def pca(df: DataFrame, features: Sequence[str] | str, k: int | None = None, variance: float = 0.95,
        out: str = "pca") -> tuple[DataFrame, object]:
    """M7: centred projection on ``k`` components, or on as many as explain ``variance``.

    ``features`` are columns or one vector column. Rows with a missing feature are not learned from and get no projection.
    """
    if isinstance(features, str):
        source = features
    else:
        df, source = assemble(df, features, "_features"), "_features"
    whole = F.col(source).isNotNull() & ~F.exists(vector_to_array(source), F.isnan)
    every, df = df, df.where(whole)
    scaler = StandardScaler(inputCol=source, outputCol="_centred", withMean=True, withStd=False)
    size = int((df.select(F.size(vector_to_array(source))).first() or [0])[0])
    if not size:
        raise ValueError("no row has all features")
    centred = scaler.fit(df)
    model = PCA(k=size if k is None else k, inputCol="_centred", outputCol=out).fit(centred.transform(df))
    if k is None:
        explained = np.cumsum(model.explainedVariance.toArray())
        k = int(np.searchsorted(explained, variance - 1e-12) + 1)
        model = PCA(k=min(k, size), inputCol="_centred", outputCol=out).fit(centred.transform(df))
    projected = model.transform(centred.transform(every)).withColumn(out, F.when(whole, F.col(out)))
    return projected.drop("_centred", "_features"), model


def pca_anomaly(df: DataFrame, features: Sequence[str], k: int | None = None, variance: float = 0.95,
                contamination: float = 0.01, keep: str = "all") -> DataFrame:
    """M8: squared reconstruction error after scaling and projection; the worst share is flagged.

    The error is |x|^2 - |projection|^2 because the components are orthonormal, so it stays a column expression.
    """
    assembled = assemble(df, features, "_raw")
    scaler = StandardScaler(inputCol="_raw", outputCol="_scaled", withMean=True, withStd=True).fit(assembled.where(complete(features)))
    projected, _ = pca(scaler.transform(assembled), "_scaled", k, variance, "_projection")

    def square(c: str):
        return F.aggregate(vector_to_array(c), F.lit(0.0), lambda a, v: a + v * v)

    error = F.greatest(square("_scaled") - square("_projection"), F.lit(0.0))
    scored = projected.withColumn("reconstruction_error", F.when(complete(features), error))
    return flag_worst(scored.drop("_raw", "_scaled", "_projection"), "reconstruction_error", contamination, keep)


# ---------------------------------------------------------------- M9-M12

def feature_importance(df: DataFrame, features: Sequence[str], target: str, trees: int = 20, seed: int = 7,
                       boosted: bool = False) -> DataFrame:
    """(feature, importance) of a forest (or of boosted trees)."""
    learner = GBTRegressor if boosted else RandomForestRegressor
    size = {"maxIter": trees} if boosted else {"numTrees": trees}
    model = learner(featuresCol="features", labelCol=target, seed=seed, **size).fit(assemble(df.where(complete([*features, target])), features))
    rows = [(f, float(v)) for f, v in zip(features, model.featureImportances.toArray())]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double")


def feature_selection(df: DataFrame, features: Sequence[str], target: str, wanted: int = 5, trees: int = 20,
                      folds: int = 5, seed: int = 7) -> DataFrame:
    """M9: (feature, method, score, selected) by recursive elimination, LASSO and boosted trees.

    The frame is staged once; every fit then reads only its columns.
    """
    data = stage(df.select(*features, target).na.drop(), "selection")
    rows, left = [], list(features)
    while True:
        scores = {r["feature"]: r["importance"] for r in feature_importance(data, left, target, trees, seed).collect()}
        if len(left) <= wanted:
            rows += [(f, "rfe", scores[f], True) for f in left]
            break
        worst = min(left, key=lambda f: (scores[f], f))
        rows.append((worst, "rfe", scores[worst], False))
        left.remove(worst)
    lasso = LinearRegression(featuresCol="features", labelCol=target, elasticNetParam=1.0, standardization=True)
    search = CrossValidator(estimator=lasso, evaluator=RegressionEvaluator(labelCol=target, metricName="rmse"),
                            estimatorParamMaps=ParamGridBuilder().addGrid(lasso.regParam, [0.001, 0.01, 0.1, 1.0]).build(),
                            numFolds=folds, seed=seed)
    weights = search.fit(assemble(data, features)).bestModel.coefficients.toArray()
    rows += [(f, "lasso", float(abs(w)), bool(abs(w) > 0)) for f, w in zip(features, weights)]
    boosted = {r["feature"]: r["importance"] for r in feature_importance(data, features, target, trees, seed, True).collect()}
    mean = sum(boosted.values()) / len(boosted)
    rows += [(f, "boosted", s, bool(s >= mean)) for f, s in boosted.items()]
    return df.sparkSession.createDataFrame(rows, "feature string, method string, score double, selected boolean")


def selected_features(selection: DataFrame) -> DataFrame:
    """The union of what any method selected."""
    return selection.where("selected").select("feature").distinct()


@dataclass(frozen=True)
class Search:
    """What a walk-forward search found: the model fitted on all searched rows, its parameters, its error on the rows held out (NULL without any), and the
    whole table (trial, parameters, fold, n_train, n_test, rmse)."""

    model: object
    parameters: dict[str, object]
    holdout_rmse: float | None
    report: DataFrame


def time_cuts(df: DataFrame, ts: str, shares: Sequence[float]) -> list[float]:
    """The times, in microseconds, below which these shares of the rows lie."""
    at = df.select(F.unix_micros(F.col(ts).cast("timestamp")).alias("_t"))
    found = quantiles(at, [], "_t", {f"q{i}": s for i, s in enumerate(shares)}).first()
    return [found[f"q{i}"] for i in range(len(shares))] if found else [0.0] * len(shares)


def walk_forward(df: DataFrame, ts: str, known: str, features: Sequence[str], label: str, learner, grid: Sequence[dict], folds: int = 5,
                 holdout: float = 0.2, parallelism: int = 4) -> Search:
    """Search parameters on expanding time folds.

    The newest ``holdout`` of the rows is kept aside. The rest is cut at ``folds`` times into equal parts; each part after the first is tested by models that
    learned from all parts before it. ``known`` is the time at which a row's label is known: a row is learned from only if that is before the
    tested part begins, so no model sees anything of its future. The parameters with the least mean error are fitted on all searched rows.
    """
    spark = df.sparkSession
    at, seen = (F.unix_micros(F.col(c).cast("timestamp")) for c in (ts, known))
    rows = assemble(df.where(complete([*features, label]) & F.col(known).isNotNull()), features).select("features", label, at.alias("_at"), seen.alias("_seen"))
    rows = stage(rows, "walk-forward")
    end = time_cuts(rows.withColumn("_t", F.timestamp_micros("_at")), "_t", [1 - holdout])[0] if holdout else float("inf")
    searched = rows.where((F.col("_at") < end) & (F.col("_seen") < end)) if holdout else rows
    cuts = time_cuts(searched.withColumn("_t", F.timestamp_micros("_at")), "_t", [i / (folds + 1) for i in range(1, folds + 1)]) + [float("inf")]
    evaluator = RegressionEvaluator(labelCol=label, predictionCol=learner.getPredictionCol(), metricName="rmse")

    def rmse(model, tested: DataFrame) -> float | None:
        return float(evaluator.evaluate(model.transform(tested))) if not tested.isEmpty() else None

    def trial(task: tuple[int, int]) -> tuple:
        number, fold = task
        learned = searched.where((F.col("_at") < cuts[fold]) & (F.col("_seen") < cuts[fold]))
        tested = searched.where((F.col("_at") >= cuts[fold]) & (F.col("_at") < cuts[fold + 1]))
        n_train, n_test = learned.count(), tested.count()
        error = rmse(learner.copy({learner.getParam(k): v for k, v in grid[number].items()}).fit(learned), tested) if n_train and n_test else None
        return number, json.dumps(grid[number], sort_keys=True), fold, n_train, n_test, error

    with ThreadPoolExecutor(parallelism) as pool:
        report = list(pool.map(trial, [(g, f) for g in range(len(grid)) for f in range(folds)]))
    errors = {g: [r[5] for r in report if r[0] == g and r[5] is not None] for g in range(len(grid))}
    scored = [g for g in errors if errors[g]]
    best = min(scored, key=lambda g: (sum(errors[g]) / len(errors[g]), g)) if scored else 0
    model = learner.copy({learner.getParam(k): v for k, v in grid[best].items()}).fit(searched)
    left_out = rmse(model, rows.where(F.col("_at") >= end)) if holdout else None
    table = spark.createDataFrame(report, "trial int, parameters string, fold int, n_train long, n_test long, rmse double")
    return Search(model, dict(grid[best]), left_out, table)


def risk_predictor(df: DataFrame, spec: SeriesSpec, features: Sequence[str], price: str = "close", folds: int = 5,
                   trees: Sequence[int] = (10, 20), depths: Sequence[int] = (3, 5), leaves: Sequence[int] = (1, 4),
                   seed: int = 7, holdout: float = 0.2) -> tuple[DataFrame, Search]:
    """Forest on the next return, searched on expanding time folds; adds ``predicted_return`` to every row.

    The target is the return to the next row of the same series, so features never see it, and a row is learned from only once that next row is past.
    """
    following = F.lead(F.struct(F.col(price).alias("price"), F.col(spec.ts).alias("at")), 1).over(spec.window)
    data = df.withColumn("_following", following)
    data = stage(data.withColumns({"next_return": ratio(F.col("_following.price"), F.col(price)) - 1, "_known": F.col("_following.at")}).drop("_following"), "predictor")
    forest = RandomForestRegressor(featuresCol="features", labelCol="next_return", predictionCol="predicted_return", seed=seed)
    grid = [{"numTrees": t, "maxDepth": d, "minInstancesPerNode": n} for t in trees for d in depths for n in leaves]
    search = walk_forward(data, spec.ts, "_known", features, "next_return", forest, grid, folds, holdout)
    return predict(data.drop("_known"), search.model, features), search


def model_signals(df: DataFrame, spec: SeriesSpec, model, features: Sequence[str], out: str = "signal") -> DataFrame:
    """The model's prediction as a signal, acted on one row later."""
    return predict(df, model, features).withColumn(out, spec.lag(model.getPredictionCol()))

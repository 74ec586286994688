"""Lags, rolling statistics, scaling, splits and the feature pipeline."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.expr import hash_uniform, ratio
from tideline.operators import indicators, quality, technical
from tideline.series import SeriesSpec, equi_join, fill_backward, fill_forward, index_series, rolling


def lags(df: DataFrame, spec: SeriesSpec, columns: Sequence[str] = ("close", "volume"),
         steps: Sequence[int] = (1, 2, 3, 5, 10)) -> DataFrame:
    """earlier values as columns ``{col}_lag_{k}``."""
    return df.withColumns({f"{c}_lag_{k}": spec.lag(c, k) for c in columns for k in steps})


def rolling_stats(df: DataFrame, spec: SeriesSpec, columns: Sequence[str] = ("close", "volume"),
                  windows: Sequence[int] = (5, 10, 20)) -> DataFrame:
    """rolling mean and sample deviation as ``{col}_rolling_mean_{w}`` and ``{col}_rolling_std_{w}``."""
    added = {}
    for c in columns:
        for w in windows:
            added[f"{c}_rolling_mean_{w}"] = rolling(spec, c, w, F.avg)
            added[f"{c}_rolling_std_{w}"] = rolling(spec, c, w, F.stddev_samp)
    return df.withColumns(added)


def sentiment_features(df: DataFrame, spec: SeriesSpec, column: str = "sentiment", window: int = 10) -> DataFrame:
    """change of the sentiment and its rolling deviation."""
    return df.withColumns({"sentiment_change": F.col(column) - spec.lag(column),
                           "sentiment_volatility": rolling(spec, column, window, F.stddev_samp)})


def post_metrics(df: DataFrame, spec: SeriesSpec, window: int = 7) -> DataFrame:
    """engagement per follower, and trend and deviation of the sentiment over the last posts (look-back 7 rows)."""
    engagement = F.col("retweets") + F.col("likes") + F.col("replies") + F.col("shares")
    return df.withColumns({
        "engagement_rate": ratio(engagement.cast("double"), F.col("followers_count")),
        "sentiment_trend": rolling(spec, "sentiment", window, F.avg),
        "sentiment_volatility": rolling(spec, "sentiment", window, F.stddev_samp)})


def interactions(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """M2: products of every two columns as ``{a}_x_{b}``."""
    return df.withColumns({f"{a}_x_{b}": F.col(a) * F.col(b) for a, b in combinations(columns, 2)})


def log1p_features(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """M3: log(1 + x) as ``log_{col}``; NULL for x <= -1."""
    return df.withColumns({f"log_{c}": F.when(F.col(c) > -1, F.log1p(c)) for c in columns})


def standardize(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """M4: (x - mean) / population deviation, over the table or per key; 0 when constant."""
    wanted = list(keys)
    df = df if wanted else df.withColumn("_all", F.lit(0))
    on = wanted or ["_all"]
    stats = df.groupBy(*on).agg(*[F.avg(c).alias(f"_m_{c}") for c in columns],
                                *[F.stddev_pop(c).alias(f"_s_{c}") for c in columns])
    # without keys the statistics are one row
    joined = equi_join(df, stats if wanted else F.broadcast(stats), on)
    scaled = {c: F.when(F.col(f"_s_{c}") == 0, F.col(c) * 0).otherwise(
        (F.col(c) - F.col(f"_m_{c}")) / F.col(f"_s_{c}")) for c in columns}
    return joined.withColumns(scaled).drop("_all", *[f"_m_{c}" for c in columns], *[f"_s_{c}" for c in columns])


def split_random(df: DataFrame, keys: Sequence[str], share: float = 0.8, seed: int = 42) -> DataFrame:
    """Mark rows as train or test by a hash of their key, the same on every run and cluster."""
    return df.withColumn("is_train", hash_uniform(*keys, F.lit(seed)) < share)


def split_time(df: DataFrame, spec: SeriesSpec, folds: int = 5, share: float = 0.8) -> DataFrame:
    """Time-ordered splits.

    ``test_fold`` is the fold a row is tested in (NULL for the oldest part); it trains every later fold. ``is_train``
    marks the oldest ``share`` of each series. Positions come from the range-sorted series.
    """
    indexed = index_series(df, spec)
    sizes = indexed.groupBy(*spec.keys).agg((F.max("_idx") + 1).alias("_n"))
    joined = equi_join(indexed, sizes, spec.keys)
    length = F.floor(F.col("_n") / (folds + 1))
    from_end = F.col("_n") - 1 - F.col("_idx")
    fold = folds - 1 - F.floor(from_end / F.when(length > 0, length))
    n_test = F.ceil(F.col("_n") * (1 - share) - 1e-9)
    return joined.withColumns({"test_fold": F.when(fold >= 0, fold), "is_train": F.col("_idx") < F.col("_n") - n_test}
                              ).drop("_n", "_idx")


def auto_features(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """Derived columns by type: date parts of times, character and word counts of strings."""
    added = {}
    for f in df.schema.fields:
        if f.name in exclude:
            continue
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            added |= {f"{f.name}_year": F.year(f.name), f"{f.name}_month": F.month(f.name),
                      f"{f.name}_day": F.dayofmonth(f.name), f"{f.name}_weekday": F.weekday(f.name)}
        elif isinstance(f.dataType, T.StringType):
            added |= {f"{f.name}_num_characters": F.char_length(f.name),
                      f"{f.name}_num_words": F.size(F.filter(F.split(f.name, r"\s+"), lambda w: w != ""))}
    return df.withColumns(added)


def feature_pipeline(df: DataFrame, spec: SeriesSpec, contamination: float | None = 0.01, scale: bool = True,
                     sentiment: str | None = "sentiment", seed: int = 7) -> DataFrame:
    """Validate, fill, drop anomalies, dates, indicators, lags, rolling statistics, sentiment, scale."""
    from tideline.operators.models import isolation_forest

    original = list(df.columns)
    df = quality.validate_schema(df, [*spec.keys, spec.ts, "open", "high", "low", "close", "volume"])
    numbers = quality.numeric_columns(df, exclude=[*spec.keys, *spec.tiebreak])
    df = fill_backward(fill_forward(df, spec, numbers), spec, numbers)
    if contamination:
        df = isolation_forest(df, [*spec.keys, *spec.order], ["open", "high", "low", "close", "volume"],
                              contamination=contamination, keep="clean", seed=seed)
        df = df.drop("anomaly_score", "severity", "anomaly")
    df = quality.datetime_features(df, spec.ts)
    df = technical.technical_indicators(df, spec)
    df = rolling_stats(lags(df, spec), spec)
    if sentiment and sentiment in df.columns:
        df = sentiment_features(df, spec, sentiment)
    df = indicators.returns(df, spec)
    new = [c for c in quality.numeric_columns(df, exclude=original) if c != "returns"]
    return standardize(df, new) if scale else df

"""On-chain aggregates, large transfers and cross-source consensus."""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tideline.functions.expr import ratio, safe_corr
from tideline.operators.joins import attach_group
from tideline.series import SeriesSpec, approximate_quantiles, equi_join, index_series, over_chunks, quantiles, quantiles_of

# Which statistics are taken of which optional column.
ONCHAIN_STATISTICS = {
    "transactionVolume": ("sum", "mean", "std"),
    "walletActivity": ("sum", "mean", "std"),
    "tokenTransfers": ("sum", "mean"),
    "smartContractInteractions": ("sum", "mean"),
    "gasUsed": ("sum", "mean", "std"),
}
_AGGREGATES = {"sum": F.sum, "mean": F.avg, "std": F.stddev_samp}


def onchain_metrics(df: DataFrame, keys: Sequence[str] = ("network",)) -> DataFrame:
    """Totals, means and deviations of whichever columns exist, the median volume, and address counts."""
    keys = list(keys)
    measures = [_AGGREGATES[s](c).alias(f"{s}_{c}")
                for c, statistics in ONCHAIN_STATISTICS.items() if c in df.columns for s in statistics]
    if "uniqueAddresses" in df.columns:
        measures += [F.count_distinct("uniqueAddresses").alias("unique_addresses"),
                     ratio(F.count("uniqueAddresses").cast("double"),
                           F.count_distinct("uniqueAddresses")).alias("rows_per_address")]
    out = df.groupBy(*keys).agg(*measures)
    if "transactionVolume" in df.columns:
        out = equi_join(out, quantiles(df, keys, "transactionVolume", {"median_transactionVolume": 0.5}), keys)
    return out


def address_stats(df: DataFrame, keys: Sequence[str], column: str = "uniqueAddresses", approx: bool = False) -> DataFrame:
    """Distinct addresses and mean rows per address."""
    distinct = F.approx_count_distinct(column) if approx else F.count_distinct(column)
    return df.groupBy(*keys).agg(distinct.alias("unique_addresses"),
                                 ratio(F.count(column).cast("double"), distinct).alias("rows_per_address"))


def daily_trend(df: DataFrame, keys: Sequence[str], value: str, ts: str = "ts") -> DataFrame:
    """A2: mean relative change of the daily sums, empty days counted as zero.

    Steps from a zero day have no relative change and are left out; the number of zero days is reported. The daily
    table has one row per key and day, so ordering it per key is bounded by the calendar.
    """
    keys = list(keys)
    daily = df.groupBy(*keys, F.to_date(ts).alias("day")).agg(F.sum(value).alias("total"))
    spine = daily.groupBy(*keys).agg(F.min("day").alias("_a"), F.max("day").alias("_b")).select(
        *keys, F.explode(F.sequence("_a", "_b", F.expr("INTERVAL 1 DAY"))).alias("day"))
    full = equi_join(spine, daily, [*keys, "day"]).withColumn("total", F.coalesce("total", F.lit(0.0)))
    change = ratio(F.col("total"), F.lag("total").over(W.partitionBy(*keys).orderBy("day"))) - 1
    return full.withColumn("_c", change).groupBy(*keys).agg(
        F.avg("_c").alias("trend"), F.count_if(F.col("total") == 0).alias("n_zero_days"),
        F.count(F.lit(1)).alias("n_days"))


def week_end(ts: str = "ts"):
    """The Sunday that closes the week of ``ts``."""
    return F.date_add(F.date_trunc("week", ts).cast("date"), 6)


def weekly_sum(df: DataFrame, keys: Sequence[str], value: str, ts: str = "ts") -> DataFrame:
    """A3: sums per week ending on Sunday."""
    return df.groupBy(*keys, week_end(ts).alias("week_end")).agg(F.sum(value).alias("weekly_sum"))


def wallet_profitability(df: DataFrame, keys: Sequence[str] = ("network",), ts: str = "ts",
                         min_percentage: float = 10.0) -> DataFrame:
    """Transfers with a clear profit, each with the total profit of its week.

    The weekly total is an aggregate joined back, so a hot week is summed in parts. Add ``wallet_id`` to ``keys`` for
    totals per wallet.
    """
    df = df.withColumn("profitability", F.col("transactionVolume") - F.col("walletActivity") - F.col("fees"))
    df = df.withColumns({
        "profitability_percentage": ratio("profitability", "walletActivity") * 100,
        "adjusted_profitability": F.col("profitability") + F.col("price_change"),
        "_week": week_end(ts)})
    df = attach_group(df, [*keys, "_week"], weekly_profitability=F.sum("profitability")).drop("_week")
    return df.where((F.col("adjusted_profitability") > 0) & (F.col("profitability_percentage") > min_percentage))


def consensus_price(quotes: DataFrame, keys: Sequence[str], fields: Sequence[str] = ("open", "high", "low", "close"),
                    base: float = 0.01, min_fraction: float = 0.5, relative: bool = False) -> DataFrame:
    """A4: one validated price per key from many sources; keys without agreement come back with ``valid`` = false.

    A quote counts when it is within base * (1 + deviation) of the mean; every field needs ``min_fraction`` of its
    quotes; the survivors are averaged with weights falling with their distance. ``volume``, if present, takes the
    weights of the close. Mean and deviation are aggregated first (map-side), then joined to the quotes.
    """
    keys = list(keys)
    stats = quotes.groupBy(*keys).agg(*[F.avg(f).alias(f"_m_{f}") for f in fields],
                                      *[F.stddev_pop(f).alias(f"_s_{f}") for f in fields])
    joined = equi_join(quotes, stats, keys)
    near, weighted = {}, []
    for f in fields:
        limit = base * (1 + F.col(f"_s_{f}"))
        limit = limit * F.abs(F.col(f"_m_{f}")) if relative else limit
        distance = F.abs(F.col(f) - F.col(f"_m_{f}"))
        near[f"_w_{f}"] = F.when(distance <= limit, 1 / (distance + 1e-6))
    joined = joined.withColumns(near)
    values = [*fields, *(["volume"] if "volume" in quotes.columns else [])]
    for v in values:
        w = F.col("_w_close" if v == "volume" else f"_w_{v}")
        weighted.append(ratio(F.sum(w * F.col(v)), F.sum(F.when(F.col(v).isNotNull(), w))).alias(v))
    kept = [F.count(f"_w_{f}").alias(f"_n_{f}") for f in fields]
    total = [F.count(f).alias(f"_t_{f}") for f in fields]
    out = joined.groupBy(*keys).agg(*weighted, *kept, *total, F.count(F.lit(1)).alias("n_quotes"))
    valid = F.lit(True)
    for f in fields:
        valid = valid & (F.col(f"_n_{f}") > 0) & (F.col(f"_n_{f}") >= F.col(f"_t_{f}") * min_fraction)
    return out.select(*keys, "n_quotes", valid.alias("valid"), *[F.when(valid, F.col(v)).alias(v) for v in values])


def network_summary(df: DataFrame, key: str = "network") -> DataFrame:
    """A5: the measures networks are compared by, for whichever columns exist."""
    optional = {
        "avg_transaction_value": ("transaction_value", F.avg), "std_dev_transaction_value": ("transaction_value", F.stddev_samp),
        "avg_gas_price": ("gas_price", F.avg), "total_gas_used": ("gas_used", F.sum),
        "avg_block_time": ("block_time", F.avg), "std_dev_block_time": ("block_time", F.stddev_samp),
        "avg_hashrate": ("hashrate", F.avg), "avg_difficulty": ("difficulty", F.avg)}
    measures = [agg(c).alias(n) if c in df.columns else F.lit(None).cast("double").alias(n)
                for n, (c, agg) in optional.items()]
    both = {"transaction_value", "gas_price"} <= set(df.columns)
    correlation = safe_corr("transaction_value", "gas_price") if both else F.lit(None).cast("double")
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("total_transactions"), *measures,
                               correlation.alias("correlation_transaction_gas"))


# Differences reported for each pair of networks.
NETWORK_DIFFERENCES = {
    "avg_trans_diff": "avg_transaction_value",
    "avg_gas_diff": "avg_gas_price",
    "block_time_stability_diff": "std_dev_block_time",
}


def whale_threshold(df: DataFrame, keys: Sequence[str] = ("network",), column: str = "transactionVolume",
                    share: float = 0.99, approx: bool = False) -> DataFrame:
    """The volume above which a transfer is large, per key; with ``approx`` from a rank sketch, in one pass."""
    find = approximate_quantiles if approx else quantiles
    return find(df, keys, column, {"threshold": share})


def whale_transactions(df: DataFrame, spec: SeriesSpec, threshold: float | None = None, share: float = 0.99,
                       cluster_rows: int = 5, volume: str = "transactionVolume") -> DataFrame:
    """Large transfers, their price impact, and totals of the cluster (rows 0-4, 5-9, ... of the full series).

    Positions come from the range-sorted series; the impact needs the large transfer before, found on the (re-indexed)
    large ones in chunks; a cluster has at most ``cluster_rows`` rows.
    """
    indexed = index_series(df, spec)
    if threshold is None:
        limits = quantiles_of(indexed, spec.keys, volume, {"threshold": share})
        indexed = equi_join(indexed, limits, spec.keys, "inner")
    else:
        indexed = indexed.withColumn("threshold", F.lit(float(threshold)))
    whales = indexed.where(F.col(volume) > F.col("threshold"))
    whales = whales.withColumn("cluster", F.floor(F.col("_idx") / cluster_rows)).drop("_idx", "threshold")

    def impact(frame: DataFrame, chunk: SeriesSpec) -> DataFrame:
        change = ratio(F.col("close"), chunk.lag("close")) - 1
        return frame.withColumn("price_impact", change * F.col(volume))

    whales = over_chunks(whales, spec, impact, halo=1)
    return attach_group(whales, [*spec.keys, "cluster"], cluster_transaction_volume=F.sum(volume),
                        cluster_price_impact=F.avg("price_impact"))


def _two_sided_p(t: float, degrees: float) -> float:
    """Student t tail probability through the continued fraction of the incomplete beta function."""
    x = degrees / (degrees + t * t)
    a, b = degrees / 2, 0.5
    if x <= 0 or x >= 1:
        return float(x >= 1)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    swap = x > (a + 1) / (a + b + 2)
    if swap:
        a, b, x = b, a, 1 - x
    c, d = 1.0, 1 / max(1 - (a + b) * x / (a + 1), 1e-300)
    h = d
    for m in range(1, 300):
        for factor in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
                       -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 / (1 + factor * d)
            c = 1 + factor / c
            h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    value = front * h / a
    return 1 - value if swap else value


def mining_trend(df: DataFrame, key: str = "network", value: str = "hashrate", ts: str = "ts") -> DataFrame:
    """Straight line of a value over days, with fit and significance, per network."""
    day = F.datediff(F.col(ts), F.lit("1970-01-01").cast("date")).cast("double")
    known = df.where(F.col(value).isNotNull()).select(key, F.col(value).alias("_y"), day.alias("_x"))
    out = known.groupBy(key).agg(
        F.count("_y").alias("n_points"),
        ratio(F.covar_pop("_x", "_y"), F.var_pop("_x")).alias("slope"),
        F.pow(safe_corr("_x", "_y"), 2).alias("r_squared"))

    @F.pandas_udf("double")
    def p_value(r2: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([None if pd.isna(v) or k < 3 else
                          0.0 if v >= 1 else _two_sided_p(math.sqrt(v * (k - 2) / (1 - v)), k - 2)
                          for v, k in zip(r2, n)], dtype="float64")

    # one row per network reaches Python
    return out.withColumn("p_value", p_value("r_squared", "n_points"))


def source_telemetry(df: DataFrame, keys: Sequence[str] = ("source",), ts: str = "ts", window: str | None = "1 hour") -> DataFrame:
    """Response time, success rate, errors and fallbacks per source and hour. Works on streams too."""
    group = [*keys, *([F.window(ts, window).alias("_w")] if window else [])]
    out = df.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n_calls"), F.avg("response_time").alias("avg_response_time"),
        (F.avg(F.col("ok").cast("double")) * 100).alias("success_rate"), F.count_if(~F.col("ok")).alias("n_errors"),
        F.count_if(F.col("kind") == "fallback").alias("n_fallbacks"))
    return out.withColumn("window_start", F.col("_w.start")).drop("_w") if window else out

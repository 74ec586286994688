"""Risk metrics, correlations, stops, alerts and stress scenarios."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.expr import hash_normal, hash_uniform, ratio, safe_corr
from tideline.series import SeriesSpec, equi_join, quantiles_of, running
from tideline.staging import stage

TRADING_DAYS = 252
METRICS = ("var", "cvar", "sharpe", "sortino", "max_drawdown", "beta", "information_ratio", "omega", "ulcer_index",
           "tracking_error", "jensens_alpha")


def return_frame(df: DataFrame, spec: SeriesSpec, price: str = "close") -> DataFrame:
    """Returns ``r`` and drawdowns ``dd``; the first row of each series has neither and is dropped.

    The compounded return is close / first close, so a drawdown is close over the highest close so far; the first
    close itself does not count as a peak.
    """
    df = df.withColumn("_before", spec.lag(price)).withColumn("r", ratio(F.col(price), "_before") - 1)
    df = running(df, spec, {"_peak": ("max", F.when(F.col("_before").isNotNull(), F.col(price)))})
    return (df.withColumn("dd", F.when(F.col("_before").isNotNull(), ratio(F.col(price), "_peak") - 1))
            .where(F.col("r").isNotNull()).drop("_before", "_peak"))


def align_benchmark(df: DataFrame, benchmark: DataFrame, on: str) -> DataFrame:
    """Add the benchmark's return ``b`` at the same time; both sides computed their returns before."""
    return equi_join(df, benchmark.select(F.col(on), F.col("benchmark_return").alias("b")), [on])


def beta(r: str | Column = "r", b: str | Column = "b") -> Column:
    """A10 as an aggregate: sample covariance over sample variance, on rows where both are known."""
    r, b = (F.col(c) if isinstance(c, str) else c for c in (r, b))
    return ratio(F.covar_samp(r, b), F.var_samp(F.when(r.isNotNull(), b)))


def beta_alpha(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """A10: beta, and alpha = mean return - beta * mean benchmark return, per key."""
    keys = list(keys)
    both = df.where(F.col("r").isNotNull() & F.col("b").isNotNull())
    out = both.groupBy(*keys).agg(beta().alias("beta"), F.avg("r").alias("_r"), F.avg("b").alias("_b"))
    return out.withColumn("alpha", F.col("_r") - F.col("beta") * F.col("_b")).drop("_r", "_b")


def risk_metrics(df: DataFrame, spec: SeriesSpec, benchmark: DataFrame | None = None, price: str = "close",
                 confidence: float = 0.95, rate: float = 0.01, threshold: float = 0.0, keys: Sequence[str] = ()) -> DataFrame:
    """One row per key; ``df`` may be a split series.

    Returns and drawdowns are computed and stored once, then one aggregation gives everything but the two tail measures.
    """
    keys = list(keys or spec.keys)
    frame = return_frame(df, spec, price)
    frame = align_benchmark(frame, benchmark, spec.ts) if benchmark is not None else frame.withColumn(
        "b", F.lit(None).cast("double"))
    frame = frame.select(*keys, "r", "dd", "b")
    return summarise(frame, keys, confidence, rate, threshold)


def summarise(frame: DataFrame, keys: Sequence[str], confidence: float = 0.95, rate: float = 0.01, threshold: float = 0.0) -> DataFrame:
    """The aggregation half of ``risk_metrics`` on columns r, dd, b.

    The value at risk is an exact quantile of groups of any size (see ``quantiles``); the tail below it is averaged in a second pass.
    """
    frame = stage(frame.select(*keys, "r", "dd", "b"), "returns")
    daily = rate / TRADING_DAYS
    r, b = F.col("r"), F.col("b")
    paired = F.when(b.isNotNull(), r)
    active = r - b
    measures = [
        ratio(F.avg(r) - daily, F.stddev_pop(r)).alias("sharpe"),
        ratio(F.avg(r) - daily, F.stddev_pop(F.when(r < 0, r))).alias("sortino"),
        F.min("dd").alias("max_drawdown"),
        beta().alias("beta"),
        ratio(F.avg(active), F.stddev_pop(active)).alias("information_ratio"),
        ratio(F.coalesce(F.sum(F.when(r > threshold, r)), F.lit(0.0)),
              -F.sum(F.when(r <= threshold, r))).alias("omega"),
        F.sqrt(F.avg(F.col("dd") * F.col("dd"))).alias("ulcer_index"),
        F.stddev_pop(active).alias("tracking_error"),
        F.avg(paired).alias("_pr"), F.avg(b).alias("_pb"), F.count(r).alias("n_returns"),
    ]
    out = equi_join(frame.groupBy(*keys).agg(*measures), quantiles_of(frame, keys, "r", {"var": 1 - confidence}), keys)
    out = out.withColumn("jensens_alpha", F.col("_pr") - daily - F.col("beta") * (F.col("_pb") - daily))
    tail = equi_join(frame.select(*keys, "r"), out.select(*keys, "var"), keys, "inner")
    tail = tail.where(F.col("r") <= F.col("var")).groupBy(*keys).agg(F.avg("r").alias("cvar"))
    out = equi_join(out, tail, keys)
    return out.select(*keys, *METRICS, "n_returns")


def correlation_matrix(df: DataFrame, columns: Sequence[str], keys: Iterable[str] = ()) -> DataFrame:
    """All pairwise-complete correlations in one aggregation, one row per ordered pair."""
    keys = list(keys)
    pairs = list(combinations(columns, 2))
    measured = df.groupBy(*keys).agg(
        *[safe_corr(x, y).alias(f"_{i}") for i, (x, y) in enumerate(pairs)],
        *[F.when(F.stddev_pop(c) > 0, F.lit(1.0)).alias(f"_d_{c}") for c in columns])
    entries = [F.struct(F.lit(c).alias("x"), F.lit(c).alias("y"), F.col(f"_d_{c}").alias("corr")) for c in columns]
    for i, (x, y) in enumerate(pairs):
        entries += [F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"_{i}").alias("corr"))
                    for a, b in ((x, y), (y, x))]
    return measured.select(*keys, F.inline(F.array(*entries)))


def stop_take_levels(df: DataFrame, volatility: str = "volatility_std", stop: float = 1.5,
                     take: float = 2.0) -> DataFrame:
    """P10: exits below and above the close, in multiples of a volatility column."""
    return df.withColumns({"stop_loss": F.col("close") - stop * F.col(volatility),
                           "take_profit": F.col("close") + take * F.col(volatility)})


@dataclass(frozen=True)
class Threshold:
    metric: str
    op: str
    limit: float

    def breached(self) -> Column:
        value = F.col(self.metric)
        return value < self.limit if self.op == "<" else value > self.limit


# The alert limits.
RISK_THRESHOLDS = (
    Threshold("max_drawdown", "<", -0.15),
    Threshold("sharpe", "<", 1.5),
    Threshold("sortino", "<", 1.5),
)
VOLATILITY_THRESHOLD = Threshold("volatility", ">", 0.5)
SUCCESS_THRESHOLD = Threshold("success_rate", "<", 80.0)


def threshold_alerts(df: DataFrame, keys: Iterable[str], thresholds: Sequence[Threshold] = RISK_THRESHOLDS) -> DataFrame:
    """One row per breached limit. Works on tables and streams (no shuffle)."""
    rows = F.array(*[F.struct(F.lit(t.metric).alias("metric"), F.lit(t.op).alias("op"), F.lit(t.limit).alias("limit"),
                              F.col(t.metric).cast("double").alias("value"),
                              F.coalesce(t.breached(), F.lit(False)).alias("_hit")) for t in thresholds])
    return df.select(*keys, F.inline(rows)).where("_hit").drop("_hit")


def risk_verdict(df: DataFrame, thresholds: Sequence[Threshold] = RISK_THRESHOLDS) -> DataFrame:
    """Add ``acceptable``: no limit is breached."""
    ok = F.lit(True)
    for t in thresholds:
        ok = ok & ~F.coalesce(t.breached(), F.lit(False))
    return df.withColumn("acceptable", ok)


@dataclass(frozen=True)
class Scenario:
    """Multiply by ``factor`` always or, with ``share`` < 1, on that share of rows; then by 1 +- noise."""
    name: str
    factor: float = 1.0
    sigma: float = 0.0
    share: float = 1.0


# The eight stress scenarios.
SCENARIOS = (
    Scenario("Bear Market", factor=0.8),
    Scenario("Bull Market", factor=1.2),
    Scenario("High Volatility", sigma=0.1),
    Scenario("Low Volatility", sigma=0.02),
    Scenario("Flash Crash", factor=0.7, share=0.05),
    Scenario("Interest Rate Hike", sigma=-0.05),
    Scenario("Currency Devaluation", factor=0.85),
    Scenario("Sector Shock", sigma=-0.1),
)


def shocked_prices(spec: SeriesSpec, scenarios: Sequence[Scenario] = SCENARIOS, price: str = "close", seed: int = 0) -> dict[str, Column]:
    """The price of a row under each scenario; chance is a hash of (series, time, scenario, seed)."""
    at = F.unix_micros(F.col(spec.ts).cast("timestamp"))
    out = {}
    for s in scenarios:
        parts = [*[F.col(k) for k in spec.keys], at, *[F.col(t) for t in spec.tiebreak], F.lit(s.name), F.lit(seed)]
        value = F.col(price) * s.factor
        if s.share < 1:
            value = F.when(hash_uniform(*parts, F.lit("u")) < s.share, value).otherwise(F.col(price))
        if s.sigma:
            value = value * (1 + s.sigma * hash_normal(*parts))
        out[s.name] = value
    return out


def apply_scenarios(df: DataFrame, spec: SeriesSpec, scenarios: Sequence[Scenario] = SCENARIOS, price: str = "close",
                    seed: int = 0) -> DataFrame:
    """One shocked copy of every row per scenario."""
    shocked = [F.struct(F.lit(name).alias("scenario"), value.alias("shocked")) for name, value in shocked_prices(spec, scenarios, price, seed).items()]
    keep = [*spec.by, *spec.order]
    return df.select(*keep, F.inline(F.array(*shocked))).withColumnRenamed("shocked", price)


def stress_scenarios(df: DataFrame, spec: SeriesSpec, scenarios: Sequence[Scenario] = SCENARIOS,
                     benchmark: DataFrame | None = None, seed: int = 0) -> DataFrame:
    """Risk metrics of every series under every scenario.

    The series is sorted once. Its prices under all scenarios stand side by side as columns while returns and drawdowns are computed, and are unrolled
    behind that, so the sort and its shuffle do not grow with the scenarios.
    """
    prices = list(shocked_prices(spec, scenarios, seed=seed).items())
    df = df.select(*spec.by, *spec.order, *[value.alias(f"_p{i}") for i, (_, value) in enumerate(prices)])
    df = df.withColumns({f"_b{i}": spec.lag(f"_p{i}") for i in range(len(prices))})
    df = running(df, spec, {f"_top{i}": ("max", F.when(F.col(f"_b{i}").isNotNull(), F.col(f"_p{i}"))) for i in range(len(prices))})
    df = align_benchmark(df, benchmark, spec.ts) if benchmark is not None else df.withColumn("b", F.lit(None).cast("double"))
    lines = [F.struct(F.lit(name).alias("scenario"), (ratio(F.col(f"_p{i}"), f"_b{i}") - 1).alias("r"), (ratio(F.col(f"_p{i}"), f"_top{i}") - 1).alias("dd"))
             for i, (name, _) in enumerate(prices)]
    frame = df.select(*spec.keys, "b", F.inline(F.array(*lines))).where(F.col("r").isNotNull())
    return summarise(frame, [*spec.keys, "scenario"])

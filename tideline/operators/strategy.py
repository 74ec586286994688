"""Signals to trades, equity and strategy metrics."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.expr import ratio
from tideline.series import SeriesSpec, rolling, running

YEAR = 252


def signal_shift(df: DataFrame, spec: SeriesSpec, signal: str = "signal") -> DataFrame:
    """act one row after the signal was known."""
    return df.withColumn(signal, spec.lag(signal))


def crossing_signal(spec: SeriesSpec, price: str, short: int, long: int) -> Column:
    """+1 while the short mean is above the long one, -1 while below, else 0 (also when they differ by rounding only)."""
    gap = rolling(spec, price, short, F.avg) - rolling(spec, price, long, F.avg)
    return F.coalesce(F.signum(F.round(gap, 9)), F.lit(0.0))


def equity_ledger(df: DataFrame, spec: SeriesSpec, price: str = "price", signal: str = "signal",
                  initial: float = 10_000.0, cost: float | Column = 0.001) -> DataFrame:
    """B1: all-in, all-out trading of a signal, written as running windows.

    A positive signal buys with the whole balance, a negative one sells everything, zero keeps the position; the first
    row never trades and each trade costs a share of its value. Equity is a running sum of log growth, so prices must
    be positive: rows without a positive price are left out.
    """
    df = df.where(F.col(price) > 0).withColumn("_before", spec.lag(price))
    act = F.when(F.col("_before").isNotNull() & (F.col(signal) != 0), (F.col(signal) > 0).cast("int"))
    df = running(df, spec, {"_held": ("last", act)}).withColumn("_held", F.coalesce("_held", F.lit(0)))
    df = df.withColumn("_was", F.coalesce(spec.lag("_held"), F.lit(0)))
    cost = cost if isinstance(cost, Column) else F.lit(cost)
    growth = (F.when(F.col("_was") == 1, F.log(F.col(price) / F.col("_before"))).otherwise(0.0)
              + F.when(F.col("_held") != F.col("_was"), F.log(1 - cost)).otherwise(0.0))
    df = running(df, spec, {"_log": ("sum", growth)})
    total = F.lit(initial) * F.exp("_log")
    held = F.col("_held") == 1
    return df.withColumns({
        "trade": F.when(F.col("_held") > F.col("_was"), "buy").when(F.col("_held") < F.col("_was"), "sell"),
        "total": total,
        "balance": F.when(held, 0.0).otherwise(total),
        "holdings": F.when(held, total).otherwise(0.0),
        "units": F.when(held, total / F.col(price)).otherwise(0.0),
    }).drop("_before", "_held", "_was", "_log")


def trades(ledger: DataFrame) -> DataFrame:
    """The rows of a ledger where something was bought or sold."""
    return ledger.where(F.col("trade").isNotNull())


def strategy_metrics(ledger: DataFrame, spec: SeriesSpec, keys: Sequence[str] = (), benchmark: DataFrame | None = None,
                     price: str = "price", signal: str = "signal") -> DataFrame:
    """Growth, volatility, ratios and drawdowns of an equity curve, one row per key."""
    from tideline.operators.risk import align_benchmark

    keys = list(keys or spec.keys)
    df = ledger.withColumn("_ret", ratio(F.col("total"), spec.lag("total")) - 1)
    df = running(df, spec, {"_top": ("max", "total")})
    if benchmark is not None:
        df = align_benchmark(df, benchmark, spec.ts)
    else:
        df = df.withColumn("b", F.lit(None).cast("double"))
    return summarise_curve(df, spec, keys, price, signal)


def summarise_curve(df: DataFrame, spec: SeriesSpec, keys: Sequence[str], price: str = "price", signal: str = "signal") -> DataFrame:
    """The aggregation half of ``strategy_metrics`` on columns total, trade, _ret, _top and b."""
    from tideline.operators.risk import beta

    at = F.struct(*spec.order)
    paired = F.col("_ret").isNotNull() & F.col("b").isNotNull()
    out = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        ratio(F.max_by("total", at), F.min_by("total", at)).alias("total_ratio"),
        (F.stddev_samp("_ret") * F.sqrt(F.lit(float(YEAR)))).alias("annualized_volatility"),
        (F.stddev_samp(F.when(F.col("_ret") < 0, F.col("_ret"))) * F.sqrt(F.lit(float(YEAR)))).alias("_downside"),
        F.max(F.col("_top") - F.col("total")).alias("max_drawdown"),
        F.max(1 - ratio("total", "_top")).alias("max_drawdown_relative"),
        F.count("trade").alias("n_trades"),
        beta("_ret", "b").alias("beta"),
        F.avg(F.when(paired, F.col("_ret"))).alias("_r"), F.avg(F.when(paired, F.col("b"))).alias("_b"),
        *regression_aggregates(price, signal))
    out = out.withColumns({"cumulative_return": F.col("total_ratio") - 1,
                           "annualized_return": F.pow("total_ratio", YEAR / F.col("n_rows")) - 1})
    return out.withColumns({
        "sharpe_ratio": ratio("annualized_return", "annualized_volatility"),
        "sortino_ratio": ratio("annualized_return", "_downside"),
        "calmar_ratio": ratio("annualized_return", "max_drawdown"),
        "alpha": F.col("_r") - F.col("beta") * F.col("_b"),
    }).drop("_downside", "_r", "_b")


def regression_aggregates(actual: str, predicted: str) -> list[Column]:
    """Error measures as aggregates."""
    y, p = F.col(actual), F.col(predicted)
    both = y.isNotNull() & p.isNotNull()
    error, y = F.when(both, y - p), F.when(both, y)
    return [
        F.avg(error * error).alias("mse"),
        F.avg(ratio(F.abs(error), F.abs(y))).alias("mape"),
        (1 - ratio(F.avg(error * error), F.var_pop(y))).alias("r2"),
        (1 - ratio(F.var_pop(error), F.var_pop(y))).alias("explained_variance"),
    ]


def regression_metrics(df: DataFrame, actual: str, predicted: str, keys: Iterable[str] = ()) -> DataFrame:
    return df.groupBy(*keys).agg(*regression_aggregates(actual, predicted))


def imbalance_ratio(df: DataFrame, column: str, keys: Iterable[str] = (), limit: float = 1.5) -> DataFrame:
    """Most frequent over least frequent value, and whether that exceeds ``limit``."""
    keys = list(keys)
    counts = df.groupBy(*keys, column).agg(F.count(F.lit(1)).alias("_n"))
    out = counts.groupBy(*keys).agg(ratio(F.max("_n").cast("double"), F.min("_n")).alias("imbalance_ratio"))
    return out.withColumn("imbalanced", F.col("imbalance_ratio") > limit)


def ensemble_signal(columns: Sequence[str]) -> Column:
    """Mean of the signals that are present."""
    present = F.filter(F.array(*[F.col(c).cast("double") for c in columns]), lambda v: v.isNotNull())
    return ratio(F.aggregate(present, F.lit(0.0), lambda a, v: a + v), F.size(present).cast("double"))


@dataclass(frozen=True)
class Trial:
    name: str
    look_back: int
    cost: float


def parameter_sweep(df: DataFrame, spec: SeriesSpec, trials: Sequence[Trial], price: str = "price", short: int = 5,
                    initial: float = 10_000.0) -> DataFrame:
    """B2: every trial's ledger metrics, one row per key and trial.

    All trials run on the same rows, in the same sort. The mean of any look-back is a difference of running prices and counts. What is held, and so
    the log growth and the number of trades so far, depends on the look-back only, so these running logs are shared by its trials; a cost is
    a multiple of the number of trades: ``log equity = growth + trades * log(1 - cost)``. Only the running peak is a trial's own. Rows are
    unrolled by trial where they are summed up, so what is shuffled behind the sort are partial sums per key and trial.
    """
    backs = sorted({t.look_back for t in trials})
    df = df.select(*spec.by, *spec.order, price)
    df = df.withColumns({"_sum": F.coalesce(F.sum(price).over(spec.running), F.lit(0.0)), "_count": F.count(price).over(spec.running)})

    def mean(n: int) -> Column:
        return F.when(F.col("_count") - F.coalesce(spec.lag("_count", n), F.lit(0)) == n, (F.col("_sum") - F.coalesce(spec.lag("_sum", n), F.lit(0.0))) / n)

    df = df.withColumns({"_short": mean(short), **{f"_long{n}": mean(n) for n in backs}})
    df = df.withColumns({f"_s{n}": F.coalesce(F.signum(F.round(F.col("_short") - F.col(f"_long{n}"), 9)), F.lit(0.0)) for n in backs})
    df = df.withColumns({f"_s{n}": spec.lag(f"_s{n}") for n in backs}).drop("_sum", "_count", "_short", *[f"_long{n}" for n in backs])
    df = df.where(F.col(price) > 0).withColumn("_before", spec.lag(price))

    def act(n: int) -> Column:
        return F.when(F.col("_before").isNotNull() & (F.col(f"_s{n}") != 0), (F.col(f"_s{n}") > 0).cast("int"))

    df = running(df, spec, {f"_held{n}": ("last", act(n)) for n in backs})
    df = df.withColumns({f"_held{n}": F.coalesce(f"_held{n}", F.lit(0)) for n in backs})
    df = df.withColumns({f"_was{n}": F.coalesce(spec.lag(f"_held{n}"), F.lit(0)) for n in backs})
    df = df.withColumns({**{f"_g{n}": F.when(F.col(f"_was{n}") == 1, F.log(F.col(price) / F.col("_before"))).otherwise(0.0) for n in backs},
                         **{f"_k{n}": (F.col(f"_held{n}") != F.col(f"_was{n}")).cast("double") for n in backs}})
    df = running(df, spec, {**{f"_growth{n}": ("sum", f"_g{n}") for n in backs}, **{f"_trades{n}": ("sum", f"_k{n}") for n in backs}})
    fee = {t.name: F.log(F.lit(1 - t.cost)) for t in trials}
    df = df.withColumns({f"_log_{i}": F.col(f"_growth{t.look_back}") + F.col(f"_trades{t.look_back}") * fee[t.name] for i, t in enumerate(trials)})
    df = running(df, spec, {f"_peak_{i}": ("max", f"_log_{i}") for i in range(len(trials))})
    lines = F.array(*[F.struct(
        F.lit(t.name).alias("trial"), F.col(f"_s{t.look_back}").alias("signal"), (initial * F.exp(f"_log_{i}")).alias("total"),
        (initial * F.exp(f"_peak_{i}")).alias("_top"), F.when(F.col(f"_k{t.look_back}") == 1, F.lit("trade")).alias("trade"),
        F.when(F.col("_before").isNotNull(), F.expm1(F.col(f"_g{t.look_back}") + F.col(f"_k{t.look_back}") * fee[t.name])).alias("_ret"))
        for i, t in enumerate(trials)])
    curves = df.select(*spec.keys, *spec.order, price, F.inline(lines)).withColumn("b", F.lit(None).cast("double"))
    return summarise_curve(curves, spec, [*spec.keys, "trial"], price)


def best_trial(metrics: DataFrame, keys: Iterable[str], score: str = "sharpe_ratio") -> DataFrame:
    """The trial with the highest score per key; ties go to the first name."""
    keys = list(keys)
    rest = [c for c in metrics.columns if c not in keys]
    lowest = F.struct(-F.col(score), F.col("trial"))
    best = metrics.where(F.col(score).isNotNull()).groupBy(*keys).agg(
        F.min_by(F.struct(*rest), lowest).alias("_best"))
    return best.select(*keys, "_best.*")

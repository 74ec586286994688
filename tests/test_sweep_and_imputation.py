"""The sweep on shared running logs and the imputation by patterns, against plain versions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tideline.operators import models, strategy
from tideline.series import SeriesSpec

SPEC = SeriesSpec(("k",), "ts")


def prices(spark, lengths, seed=2):
    rng = np.random.default_rng(seed)
    rows = [(k, i, float(p)) for k, n in lengths.items() for i, p in enumerate(np.exp(np.cumsum(rng.normal(0, 0.05, n))) * 50)]
    rows += [("a", 1000, None), ("a", 1001, -3.0), ("a", 1002, 40.0)]
    return spark.createDataFrame(rows, "k string, ts long, price double")


def one_by_one(df, trial):
    """A trial by itself: signal, ledger, metrics."""
    signals = df.withColumn("signal", strategy.crossing_signal(SPEC, "price", 5, trial.look_back))
    ledger = strategy.equity_ledger(strategy.signal_shift(signals, SPEC), SPEC, cost=trial.cost)
    return {r["k"]: r for r in strategy.strategy_metrics(ledger, SPEC).collect()}


def test_every_trial_equals_its_own_ledger(spark):
    df = prices(spark, {"a": 180, "b": 60, "c": 3})
    trials = [strategy.Trial(f"t{n}-{c}", n, c) for n in (8, 20) for c in (0.0, 0.01)]
    found = {(r["k"], r["trial"]): r for r in strategy.parameter_sweep(df, SPEC, trials).collect()}
    assert len(found) == 3 * len(trials)
    for t in trials:
        for k, wanted in one_by_one(df, t).items():
            for name in ("n_rows", "n_trades", "total_ratio", "annualized_volatility", "max_drawdown", "max_drawdown_relative", "sharpe_ratio", "mse", "r2"):
                a, b = found[k, t.name][name], wanted[name]
                assert (a is None) == (b is None) and (a is None or a == pytest.approx(b, rel=1e-9, abs=1e-9)), (k, t.name, name)


def test_rows_are_shuffled_once_for_all_trials(spark):
    df = prices(spark, {"a": 50})
    few, many = ([strategy.Trial(f"t{i}", n, 0.001) for i, n in enumerate(range(10, 10 + size))] for size in (2, 20))
    plans = [strategy.parameter_sweep(df, SPEC, t)._jdf.queryExecution().executedPlan().toString() for t in (few, many)]
    for plan in plans:  # the rows by key; the sums by key and trial find them placed already
        assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Generate") == 1
        assert plan.index("Generate") < plan.index("Exchange hashpartitioning")  # unrolled above the exchange, not below it


def plain_imputation(x, rounds, ridge, tolerance):
    """The same rounds on a matrix, row by row."""
    gap = np.isnan(x)
    means = np.nanmean(x, axis=0)
    full = np.where(gap, means, x)
    previous = None
    for _ in range(rounds):
        following, coefficients = full.copy(), []
        for t in np.flatnonzero(gap.any(axis=0)):
            others = [c for c in range(x.shape[1]) if c != t]
            design = np.hstack([np.ones((len(x), 1)), full[:, others] - means[others]])
            seen = design[~gap[:, t]]
            gram = seen.T @ seen
            gram[1:, 1:] += np.diag(ridge * np.diag(gram)[1:] + 1e-12)
            w = np.linalg.solve(gram, seen.T @ x[~gap[:, t], t])
            following[gap[:, t], t] = design[gap[:, t]] @ w
            coefficients.append(w)
        full, current = following, np.concatenate(coefficients)
        if previous is not None and np.max(np.abs(current - previous)) <= tolerance * (1 + np.max(np.abs(current))):
            break
        previous = current
    return full


@pytest.mark.parametrize("rounds, tolerance", [(1, 0.0), (10, 1e-4), (25, 0.0)])
def test_imputation_equals_rounds_over_the_rows(spark, rounds, tolerance):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((400, 4)) @ rng.standard_normal((4, 4)) + [5.0, -3.0, 1e6, 0.0]
    for c in range(3):
        x[rng.random(400) < 0.2, c] = np.nan
    x[0, :] = np.nan
    x[0, 3] = 1.0
    rows = [(i, *[None if np.isnan(v) else float(v) for v in row], "z") for i, row in enumerate(x)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, d double, note string")
    found = models.impute_iterative(df, ["a", "b", "c", "d"], rounds=rounds, tolerance=tolerance)
    assert found.columns == df.columns
    got = np.array([[r.a, r.b, r.c, r.d] for r in found.orderBy("id").collect()])
    assert np.allclose(got, plain_imputation(x, rounds, 1e-6, tolerance), rtol=1e-7, atol=1e-6)


def test_imputation_reads_twice_and_copies_nothing(spark):
    seen = spark.sparkContext.accumulator(0)

    def note(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.range(3000).select("id", F.when(F.col("id") % 3 > 0, F.col("id").cast("double")).alias("a"), F.when(F.col("id") % 4 > 0, F.col("id") * 2.0).alias("b"))
    out = models.impute_iterative(df.mapInArrow(note, df.schema), ["a", "b"])
    assert not any(f for f in out.inputFiles())
    out.write.format("noop").mode("overwrite").save()
    assert seen.value <= 2 * 3000 + 1000  # and some first rows, for the shift


def test_imputation_of_columns_without_gaps_or_values(spark):
    df = spark.createDataFrame([(1, 1.0, None), (2, 2.0, None)], "id long, a double, b double")
    assert [tuple(r) for r in models.impute_iterative(df, ["a", "b"]).orderBy("id").collect()] == [(1, 1.0, None), (2, 2.0, None)]
    assert models.impute_iterative(df.limit(0), ["a", "b"]).collect() == []
    alone = spark.createDataFrame([(1, 1.0), (2, None), (3, 3.0)], "id long, a double")
    assert [r.a for r in models.impute_iterative(alone, ["a"]).orderBy("id").collect()] == pytest.approx([1.0, 2.0, 3.0])

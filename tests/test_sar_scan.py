"""The stop-and-reverse scan over chunks against one walk."""

import random

import pytest

from tideline.operators import technical
from tideline.series import SeriesSpec

SPEC = SeriesSpec(("k",), "ts", ("id",))


def make(spark, lengths, seed=1, wild=1.0):
    rng = random.Random(seed)
    rows = []
    for key, length in lengths.items():
        price = 100.0
        for i in range(length):
            price += rng.gauss(0, wild)
            rows.append((key, i // 2, i, price + rng.random(), price - rng.random(), "x"))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "k string, ts long, id long, high double, low double, note string")


def by_row(df):
    return {(r["k"], r["id"]): r["parabolic_sar"] for r in df.collect()}


@pytest.mark.parametrize("chunk_rows, warm_up", [(1000, 256), (64, 64), (50, 5), (20, 0), (7, 1)])
def test_chunks_equal_one_walk(spark, chunk_rows, warm_up):
    """With little or no warm-up nearly every guess is wrong and is mended by later rounds."""
    df = make(spark, {"a": 700, "b": 1, None: 130, "c": 2})
    found = technical.parabolic_sar_scan(df, SPEC, chunk_rows=chunk_rows, warm_up=warm_up)
    assert found.columns == [*df.columns, "parabolic_sar"]
    assert by_row(found) == by_row(technical.parabolic_sar(df, SPEC))


def test_a_trend_without_reversals_is_carried_over_all_chunks(spark):
    """Walks that start within a trend never see its first rows: every guess is wrong until the end before it arrives."""
    rows = [("a", i, i, 100.0 + i + (50.0 if i == 0 else 0.0), 99.0 + i, "x") for i in range(120)]
    df = spark.createDataFrame(rows, "k string, ts long, id long, high double, low double, note string")
    assert by_row(technical.parabolic_sar_scan(df, SPEC, chunk_rows=15, warm_up=3)) == by_row(technical.parabolic_sar(df, SPEC))


def test_no_rows(spark):
    df = make(spark, {"a": 3}).limit(0)
    assert technical.parabolic_sar_scan(df, SPEC).collect() == []


def test_one_series_is_walked_in_many_tasks(spark):
    df = make(spark, {"a": 900})
    name = "spark.sql.adaptive.coalescePartitions.enabled"  # so small a table would be put together again
    spark.conf.set(name, "false")
    try:
        found = technical.parabolic_sar_scan(df, SPEC, chunk_rows=100, warm_up=100)
    finally:
        spark.conf.unset(name)
    assert len(found.inputFiles()) > 3

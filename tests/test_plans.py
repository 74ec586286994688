"""What the physical plans must and must not hold."""

import re

import pytest

from tideline.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
PYTHON = ("MapInPandas", "FlatMapGroupsInPandas", "FlatMapCoGroupsInPandas", "ArrowEvalPython", "BatchEvalPython")


def plan(spark, name):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    return QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["w2_rsi", "w4_macd", "w6_bollinger", "k5_rsi", "k12_atr", "k14_cci", "f2_rolling_stats",
                                  "b1_equity_ledger", "b3_stress_scenarios", "a5_network_summary", "a4_consensus_price", "p9_wallet_profitability",
                                  "t1_clean_text", "t2_lexicon_sentiment", "w5_obv_ticks", "j1_asof_join"])
def test_built_in_expressions_only(spark, name):
    text = plan(spark, name)
    assert not any(p in text for p in PYTHON)
    assert "SinglePartition" not in text and "CartesianProduct" not in text


def test_texts_meet_the_gazetteer_in_one_arrow_step(spark):
    """The automaton of T5 runs in Arrow batches; the pairs behind it are built-in expressions."""
    text = plan(spark, "j5_cooccurrence_pairs")
    assert text.count("MapInArrow") == 1 and not any(p in text for p in PYTHON if p != "MapInPandas")
    assert "SinglePartition" not in text and "CartesianProduct" not in text


def test_bundle_orders_only_the_market_summary_in_one_partition(spark):
    """The benchmark has one row per bar time (span / interval), the only thing ordered without a key."""
    text = plan(spark, "w13_indicator_bundle")
    single = [line for line in text.splitlines() if "SinglePartition" in line]
    assert not any(p in text for p in PYTHON) and len(single) <= 1


@pytest.mark.parametrize("name", ["w2_rsi", "w6_bollinger", "k5_rsi", "k14_cci", "f2_rolling_stats"])
def test_indicators_shuffle_once_after_the_bars(spark, name):
    """One exchange for the bars' aggregation, one for all windows together."""
    assert plan(spark, name).count("Exchange hashpartitioning") <= 2


def test_filter_and_columns_reach_the_scan(spark):
    text = plan(spark, "s1_load_table")
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(l_shipdate", text) and "GreaterThan(l_quantity,45.0)" in text
    assert "l_comment" not in text and "l_tax" not in text.split("ReadSchema")[1]


def test_bars_read_three_columns_fewer(spark):
    schema = plan(spark, "a0_ohlcv_bars").split("ReadSchema")[1]
    assert "user_id" not in schema


def test_date_slice_is_pushed(spark):
    assert "o_orderdate" in plan(spark, "p13_date_range_slice").split("PushedFilters")[1]


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES) and len(ORACLES) > 140

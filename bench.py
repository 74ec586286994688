"""Headline queries, timed. Prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 3, after one warm-up).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tideline.catalog import QUERIES
from tideline.session import build_session

HEADLINE = (
    "a0_ohlcv_bars", "a0_daily_bars", "ohlcv_bars_sma20", "w2_rsi", "w4_macd", "w6_bollinger", "w13_indicator_bundle",
    "k5_rsi", "k12_atr", "k14_cci", "r12_risk_metrics", "r12_risk_metrics_daily", "b1_equity_ledger",
    "b3_stress_scenarios", "j1_asof_join", "a1_onchain_metrics", "a4_consensus_price", "a8_whale_transactions",
    "p9_wallet_profitability", "s6_normalize_quotes", "t1_clean_text", "t2_lexicon_sentiment", "j5_cooccurrence_pairs",
    "w5_obv_ticks", "f2_rolling_stats_ticks",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    timings = {}
    for name in names:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        timings[name] = round(statistics.median(taken[1:] or taken), 3)
    spark.stop()
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(timings.values()), 3), "unit": "sec",
                      "queries": timings, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()

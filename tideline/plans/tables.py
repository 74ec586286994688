"""Joins, validation, filters, on-chain summaries and consensus prices."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tideline.functions import text as tx
from tideline.operators import joins, onchain, quality, risk
from tideline.operators.bars import ohlcv_bars
from tideline.plans.inputs import (BARS, BARS_SQL, DAILY, LINES, LINES_SQL, TICKS, TICKS_SQL, TRANSFERS,
                                   TRANSFERS_SQL, bars, lines, over, r, table, ticks, tidy, transfers)
from tideline.plans.registry import query
from tideline.series import fill_backward, fill_forward, place_rows

# ---------------------------------------------------------------- bars with many keys

DAILY_SQL = LINES_SQL + """,
daily AS (SELECT supplier, ts, first(price ORDER BY ts, order_id, line) AS open, max(price) AS high, min(price) AS low,
   last(price ORDER BY ts, order_id, line) AS close, sum(volume) AS volume, count(*) AS trades
   FROM lines GROUP BY supplier, ts)"""


@query("a0_daily_bars", f"WITH {DAILY_SQL} SELECT supplier, ts, {r('open', 'high', 'low', 'close', 'volume', digits=8)}, trades FROM daily")
def a0_daily_bars(spark, sf):
    return tidy(ohlcv_bars(lines(spark, sf), LINES, "1 day"), digits=8)


@query("r12_risk_metrics_daily", f"""WITH {DAILY_SQL},
  x AS (SELECT *, close / lag(close) {over(key='supplier')} - 1 AS r FROM daily),
  rt AS (SELECT *, close / max(CASE WHEN r IS NOT NULL THEN close END) {over('all', key='supplier')} - 1 AS dd FROM x),
  q AS (SELECT supplier, quantile_cont(r, 1 - 0.95) AS var FROM rt GROUP BY supplier)
  SELECT supplier, {r('any_value(var) AS var', 'avg(r) FILTER (r <= var) AS cvar', 'min(dd) AS max_drawdown',
   '(avg(r) - 0.01 / 252) / nullif(stddev_pop(r), 0) AS sharpe', 'sqrt(avg(dd * dd)) AS ulcer_index')}, count(r) AS n_returns
  FROM rt JOIN q USING (supplier) WHERE r IS NOT NULL GROUP BY supplier""")
def r12_risk_metrics_daily(spark, sf):
    daily = ohlcv_bars(lines(spark, sf), LINES, "1 day")
    return tidy(risk.risk_metrics(daily, DAILY), "supplier", "var", "cvar", "max_drawdown", "sharpe", "ulcer_index",
                "n_returns")


# ---------------------------------------------------------------- joins

MARKET_SQL = BARS_SQL + ", mk AS (SELECT symbol, ts AS bar_ts, close FROM bars)"


@query("j1_asof_join", f"""WITH {MARKET_SQL}
  SELECT e.event_id, e.symbol, m.bar_ts AS m_bar_ts, {r('m.close AS m_close')}
  FROM ticks e ASOF LEFT JOIN mk m ON e.symbol = m.symbol AND e.ts >= m.bar_ts""")
def j1_asof_join(spark, sf):
    """Every event with the newest bar of its symbol that starts at or before it."""
    posts = ticks(spark, sf).select("symbol", "ts", "event_id")
    market = bars(spark, sf).select("symbol", F.col("ts").alias("bar_ts"), "close")
    out = joins.asof_join(posts, market, "ts", "bar_ts", ["symbol"], prefix="m_")
    return tidy(out, "event_id", "symbol", "m_bar_ts", "m_close")


@query("j1_asof_join_no_key", f"""WITH {TICKS_SQL}, p AS (SELECT ts AS p_ts, event_id, price FROM ticks WHERE symbol = 'purchase'),
  s AS (SELECT ts, event_id FROM ticks WHERE symbol <> 'purchase')
  SELECT s.event_id, CAST(p.event_id AS DOUBLE) AS p_event_id, {r('p.price AS p_price')} FROM s ASOF LEFT JOIN p ON s.ts > p.p_ts""")
def j1_asof_join_no_key(spark, sf):
    """One series without a key: the cuts alone spread the work."""
    t = ticks(spark, sf)
    right = t.where(F.col("symbol") == "purchase").select(F.col("ts").alias("p_ts"), "event_id", "price")
    left = t.where(F.col("symbol") != "purchase").select("ts", "event_id")
    out = joins.asof_join(left, right, "ts", "p_ts", right_tiebreak=["event_id"], allow_exact=False, prefix="p_")
    return tidy(out.withColumn("p_event_id", F.col("p_event_id").cast("double")), "event_id", "p_event_id", "p_price")


@query("j1_asof_join_forward", f"""WITH {MARKET_SQL},
  j AS (SELECT e.event_id, e.ts, m.bar_ts, m.close FROM ticks e ASOF LEFT JOIN mk m ON e.symbol = m.symbol AND e.ts <= m.bar_ts)
  SELECT event_id, CASE WHEN bar_ts - ts <= INTERVAL 30 MINUTE THEN bar_ts END AS m_bar_ts,
    {r('CASE WHEN bar_ts - ts <= INTERVAL 30 MINUTE THEN close END AS m_close')} FROM j""")
def j1_asof_join_forward(spark, sf):
    """The next bar, if it starts within 30 minutes."""
    posts = ticks(spark, sf).select("symbol", "ts", "event_id")
    market = bars(spark, sf).select("symbol", F.col("ts").alias("bar_ts"), "close")
    out = joins.asof_join(posts, market, "ts", "bar_ts", ["symbol"], direction="forward", tolerance="30 MINUTE", prefix="m_")
    return tidy(out, "event_id", "m_bar_ts", "m_close")


@query("j2_merge_on_time", f"""WITH {BARS_SQL}, days AS (SELECT DISTINCT date_trunc('day', ts) AS ts FROM bars),
  orders_day AS (SELECT o_orderdate + INTERVAL 8766 DAY AS ts, max_by(o_totalprice, o_orderkey) AS total FROM orders GROUP BY ALL),
  lines_day AS (SELECT l_shipdate + INTERVAL 8766 DAY AS ts, max_by(l_quantity, (l_orderkey, l_linenumber)) AS quantity FROM lineitem GROUP BY ALL)
  SELECT d.ts, {r('o.total AS orders_total', 'l.quantity AS lines_quantity')}
  FROM days d LEFT JOIN orders_day o USING (ts) LEFT JOIN lines_day l USING (ts)""")
def j2_merge_on_time(spark, sf):
    """Days of the market data with the last order and the last line of the same day, 24 years on."""
    shift = F.expr("INTERVAL 8766 DAY")
    days = bars(spark, sf).select(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("ts")).distinct()
    orders = table(spark, sf, "orders").select((F.col("o_orderdate") + shift).alias("ts"), F.col("o_totalprice").alias("total"), "o_orderkey")
    item = table(spark, sf, "lineitem").select((F.col("l_shipdate") + shift).alias("ts"), F.col("l_quantity").alias("quantity"),
                                               "l_orderkey", "l_linenumber")
    out = joins.merge_on_time(days, {"orders": orders, "lines": item}, ["ts"],
                              {"orders": ["o_orderkey"], "lines": ["l_orderkey", "l_linenumber"]})
    return tidy(out, "ts", "orders_total", "lines_quantity")


@query("j3_cluster_join_back", f"""WITH {TRANSFERS_SQL}
  SELECT tx_id, network, {r('transactionVolume', 'sum(transactionVolume) OVER (PARTITION BY network) AS network_total',
                            'avg(transactionVolume) OVER (PARTITION BY network) AS network_mean', digits=3)} FROM transfers""")
def j3_cluster_join_back(spark, sf):
    out = joins.attach_group(transfers(spark, sf), ["network"], network_total=F.sum("transactionVolume"),
                             network_mean=F.avg("transactionVolume"))
    return tidy(out, "tx_id", "network", "transactionVolume", "network_total", "network_mean", digits=3)


NETWORK_SQL = TRANSFERS_SQL + """,
net AS (SELECT network, count(*) AS total_transactions, avg(transactionVolume) AS avg_transaction_value,
  stddev_samp(transactionVolume) AS std_dev_transaction_value, avg(fees / gasUsed) AS avg_gas_price, sum(gasUsed) AS total_gas_used,
  avg(block_time) AS avg_block_time, stddev_samp(block_time) AS std_dev_block_time,
  corr(transactionVolume, fees / gasUsed) AS correlation_transaction_gas FROM transfers GROUP BY network)"""


def network_tx(spark, sf):
    return transfers(spark, sf).select("network", F.col("transactionVolume").alias("transaction_value"),
                                       (F.col("fees") / F.col("gasUsed")).alias("gas_price"),
                                       F.col("gasUsed").alias("gas_used"), "block_time")


@query("a5_network_summary", f"""WITH {NETWORK_SQL} SELECT network, total_transactions, {r('avg_transaction_value',
  'std_dev_transaction_value', 'avg_gas_price', 'total_gas_used', 'avg_block_time', 'std_dev_block_time', 'correlation_transaction_gas', digits=4)} FROM net""")
def a5_network_summary(spark, sf):
    return tidy(onchain.network_summary(network_tx(spark, sf)).drop("avg_hashrate", "avg_difficulty"), digits=4)


@query("j4_pairwise_compare", f"""WITH {NETWORK_SQL} SELECT a.network || '_vs_' || b.network AS pair,
  {r('abs(a.avg_transaction_value - b.avg_transaction_value) AS avg_trans_diff', 'abs(a.avg_gas_price - b.avg_gas_price) AS avg_gas_diff',
     'abs(a.std_dev_block_time - b.std_dev_block_time) AS block_time_stability_diff', digits=4)}
  FROM net a JOIN net b ON a.network < b.network""")
def j4_pairwise_compare(spark, sf):
    summary = onchain.network_summary(network_tx(spark, sf))
    return tidy(joins.pairwise_compare(summary, "network", onchain.NETWORK_DIFFERENCES), digits=4)


@query("j6_align_columns", f"""WITH {BARS_SQL}, v AS (SELECT symbol, date_trunc('hour', ts) AS ts, avg(volume) AS mean_size FROM ticks GROUP BY ALL)
  SELECT symbol, ts, {r('close', 'mean_size AS size_mean_size')} FROM bars LEFT JOIN v USING (symbol, ts)""")
def j6_align_columns(spark, sf):
    """Columns computed apart, aligned by key and time instead of by row position."""
    sizes = ticks(spark, sf).groupBy("symbol", F.window("ts", "1 hour").alias("w")).agg(F.avg("volume").alias("mean_size"))
    sizes = sizes.select("symbol", F.col("w.start").alias("ts"), "mean_size")
    return tidy(joins.merge_on_time(bars(spark, sf), {"size": sizes}, ["symbol", "ts"]), "symbol", "ts", "close", "size_mean_size")


@query("j8_anti_join_new", """SELECT event_id, event_type FROM events WHERE user_id NOT IN
  (SELECT c_custkey FROM customer WHERE c_acctbal > 0)
  QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY event_id) = 1""")
def j8_anti_join_new(spark, sf):
    new = table(spark, sf, "events").select("event_id", "event_type", "user_id")
    known = table(spark, sf, "customer").where(F.col("c_acctbal") > 0).select(F.col("c_custkey").alias("user_id"))
    events = joins.anti_join_new(new.select("user_id"), known, ["user_id"])
    return new.join(events, "user_id", "left_semi").select("event_id", "event_type")


# ---------------------------------------------------------------- validation and projections

@query("p1_validate_schema", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def p1_validate_schema(spark, sf):
    events = quality.validate_schema(table(spark, sf, "events"), ["event_id", "ts", "value"],
                                     {"value": "numeric", "event_type": "string", "ts": "timestamp_ntz"})
    return events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("p2_schema_matches", """SELECT lang, count(*) AS n, true AS documents_match, false AS posts_match
  FROM documents GROUP BY lang""")
def p2_schema_matches(spark, sf):
    docs = table(spark, sf, "documents")
    good = quality.schema_matches(docs, {"doc_id": "bigint", "text": "string", "n_chars": "numeric"})
    bad = quality.schema_matches(docs, {"text": "string", "likes": "bigint"})
    return docs.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).withColumns(
        {"documents_match": F.lit(good), "posts_match": F.lit(bad)})


KEYWORDS = ("license", "the", "qui", "http")


NUMBERS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query("p11_numeric_columns", " UNION ALL ".join(f"""SELECT '{c}' AS "column", count(*) - count({c}) AS n_missing, {r(f'avg({c}) AS mean')} FROM lineitem""" for c in NUMBERS if c != "l_orderkey"))
def p11_numeric_columns(spark, sf):
    """Missing cells and mean of every number of a table, whatever columns it has."""
    items = table(spark, sf, "lineitem")
    names = quality.numeric_columns(items, exclude=["l_orderkey"])
    measured = items.agg(*[F.struct(F.count_if(F.col(c).isNull()).alias("n_missing"), F.avg(c).alias("mean")).alias(c) for c in names])
    lines = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"{c}.n_missing").alias("n_missing"), F.col(f"{c}.mean").cast("double").alias("mean")) for c in names])
    return tidy(measured.select(F.inline(lines)))


@query("p3_keyword_filter", "SELECT doc_id, n_chars FROM documents WHERE " + " OR ".join(f"contains(lower(text), '{k}')" for k in KEYWORDS))
def p3_keyword_filter(spark, sf):
    return quality.keyword_filter(table(spark, sf, "documents"), ["text"], KEYWORDS).select("doc_id", "n_chars")


@query("p3_keyword_table", r"""WITH k AS (SELECT DISTINCT unnest(regexp_extract_all(text, '[\p{L}\p{N}_]+')) AS k FROM conversations), long AS (SELECT DISTINCT lower(k) AS k FROM k WHERE length(k) >= 10)
  SELECT doc_id, n_chars FROM documents d WHERE EXISTS (SELECT 1 FROM long WHERE contains(lower(d.text), k))""")
def p3_keyword_table(spark, sf):
    """The long words of the conversations as a keyword table, sought as substrings."""
    found = table(spark, sf, "conversations").select(F.explode(F.regexp_extract_all("text", F.lit(tx.WORD), 0)).alias("keyword"))
    keywords = found.where(F.length("keyword") >= 10).distinct()
    return quality.keyword_filter(table(spark, sf, "documents"), ["text"], keywords).select("doc_id", "n_chars")


@query("p4_datetime_features", """SELECT event_id, CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week, CAST(hour(ts) AS INTEGER) AS hour,
  CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day FROM events""")
def p4_datetime_features(spark, sf):
    return quality.datetime_features(table(spark, sf, "events")).select("event_id", "day_of_week", "hour", "month", "day")


@query("p5_quality_report", f"""WITH {TRANSFERS_SQL}, f AS (SELECT *, transactionVolume > 400000 AS big FROM transfers),
  c AS (SELECT count(*) FILTER (fees IS NULL) AS a, count(*) FILTER (walletActivity IS NULL) AS b, count(*) FILTER (close IS NULL) AS c,
        count(*) FILTER (transactionVolume < 0) AS d, count(*) FILTER (fees < 0) AS e, count(*) FILTER (big) AS f FROM f)
  SELECT 'missing' AS "check", 'fees' AS "column", a AS n_failed, a = 0 AS passed FROM c UNION ALL
  SELECT 'missing', 'walletActivity', b, b = 0 FROM c UNION ALL SELECT 'missing', 'close', c, c = 0 FROM c UNION ALL
  SELECT 'negative', 'transactionVolume', d, d = 0 FROM c UNION ALL SELECT 'negative', 'fees', e, e = 0 FROM c UNION ALL
  SELECT 'anomaly', 'big', f, f = 0 FROM c""")
def p5_quality_report(spark, sf):
    t = transfers(spark, sf).withColumn("big", F.col("transactionVolume") > 400000)
    return quality.quality_report(t, ["fees", "walletActivity", "close"], ["transactionVolume", "fees"], "big")


SENTIMENT_SQL = BARS_SQL + """, sp AS (SELECT *, close - open AS price_change, (close - open) / open AS price_change_pct,
  CASE WHEN abs(volume / trades / 50 - 1) > 0.1 THEN volume / trades / 50 - 1 ELSE 0 END AS filtered_sentiment FROM bars WHERE open > 0)"""


def _price_sentiment(spark, sf):
    b = bars(spark, sf).withColumn("sentiment", F.col("volume") / F.col("trades") / 50 - 1)
    return quality.price_sentiment(b)


@query("p6_price_sentiment", f"""WITH {SENTIMENT_SQL} SELECT symbol, ts, {r('price_change', 'price_change_pct', 'filtered_sentiment',
  '0.6 * filtered_sentiment + 0.4 * price_change_pct AS combined_sentiment')} FROM sp""")
def p6_price_sentiment(spark, sf):
    return tidy(_price_sentiment(spark, sf), "symbol", "ts", "price_change", "price_change_pct", "filtered_sentiment", "combined_sentiment")


@query("p6_sentiment_correlation", f"""WITH {SENTIMENT_SQL} SELECT symbol,
  {r('corr(0.6 * filtered_sentiment + 0.4 * price_change_pct, price_change_pct) AS correlation')} FROM sp GROUP BY symbol""")
def p6_sentiment_correlation(spark, sf):
    return tidy(quality.sentiment_price_correlation(_price_sentiment(spark, sf), ["symbol"]))


GAPS_SQL = TICKS_SQL + ", gaps AS (SELECT event_id, symbol, ts, CASE WHEN volume >= 50 THEN price END AS price FROM ticks)"


@query("p7_ffill_bfill", f"""WITH {GAPS_SQL} SELECT event_id, symbol, {r(f'''coalesce(
  last_value(price IGNORE NULLS) {over('all', order='ts, event_id')},
  first_value(price IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS price''')} FROM gaps""")
def p7_ffill_bfill(spark, sf):
    """Small trades lose their price; it is filled from the trade before, at the start of a series from the one after."""
    t = ticks(spark, sf).select("event_id", "symbol", "ts", F.when(F.col("volume") >= 50, F.col("price")).alias("price"))
    placed, spec = place_rows(t, TICKS)
    return tidy(fill_backward(fill_forward(placed, spec, ["price"]), spec, ["price"]), "event_id", "symbol", "price")


@query("p8_drop_incomplete", f"WITH {GAPS_SQL} SELECT event_id, {r('price')} FROM gaps WHERE price IS NOT NULL")
def p8_drop_incomplete(spark, sf):
    t = ticks(spark, sf).select("event_id", F.when(F.col("volume") >= 50, F.col("price")).alias("price"))
    return tidy(quality.drop_incomplete(t, ["price"]))


@query("p9_wallet_profitability", f"""WITH {TRANSFERS_SQL}, p AS (SELECT *, transactionVolume - walletActivity - fees AS profitability,
   close / 97 - 15 AS price_change, date_trunc('week', ts) AS wk FROM transfers),
  w AS (SELECT *, profitability / walletActivity * 100 AS pct, profitability + price_change AS adj,
    sum(profitability) OVER (PARTITION BY network, wk) AS weekly FROM p)
  SELECT tx_id, wallet_id, {r('profitability', 'pct AS profitability_percentage', 'weekly AS weekly_profitability',
     'adj AS adjusted_profitability')} FROM w WHERE adj > 0 AND pct > 10""")
def p9_wallet_profitability(spark, sf):
    t = transfers(spark, sf).withColumn("price_change", F.col("close") / 97 - 15)
    return tidy(onchain.wallet_profitability(t), "tx_id", "wallet_id", "profitability", "profitability_percentage",
                "weekly_profitability", "adjusted_profitability")


@query("p12_clean_casts", """SELECT event_id, coalesce(CAST(nullif(event_type, 'error') AS VARCHAR), '') AS content,
  round(coalesce(TRY_CAST(CASE WHEN event_type = 'view' THEN 'n/a' ELSE CAST(CAST(value * 100 AS BIGINT) AS VARCHAR) END AS DOUBLE), 0), 6) + 0.0 AS score,
  round(TRY_CAST(CASE WHEN event_type = 'view' THEN 'n/a' ELSE CAST(CAST(value * 100 AS BIGINT) AS VARCHAR) END AS DOUBLE), 6) + 0.0 AS price, ts FROM events""")
def p12_clean_casts(spark, sf):
    raw = F.when(F.col("event_type") == "view", "n/a").otherwise(F.rint(F.col("value") * 100).cast("bigint").cast("string"))
    e = table(spark, sf, "events").select("event_id", F.nullif("event_type", F.lit("error")).alias("content"), raw.alias("score"),
                                          raw.alias("price"), F.col("ts").cast("string").alias("ts"))
    return tidy(quality.clean_casts(e, ["content"], ["score"], ["price"], ["ts"]))


@query("p13_date_range_slice", """SELECT o_orderkey, 'previous_year' AS period FROM orders WHERE o_orderdate >= DATE '1997-01-01' AND o_orderdate < DATE '1998-01-01'
  UNION ALL SELECT o_orderkey, 'year_to_date' FROM orders WHERE o_orderdate >= DATE '1998-01-01' AND o_orderdate < DATE '1998-06-16'""")
def p13_date_range_slice(spark, sf):
    orders, today = table(spark, sf, "orders"), date(1998, 6, 15)
    parts = [quality.date_range_slice(orders, "o_orderdate", today, p).select("o_orderkey", F.lit(p).alias("period"))
             for p in ("previous_year", "year_to_date")]
    return parts[0].unionByName(parts[1])


@query("p14_source_tag", "SELECT page_id, CASE WHEN contains(html || url, 'twitter.com') THEN 'twitter' ELSE 'reddit' END AS source FROM pages")
def p14_source_tag(spark, sf):
    pages = table(spark, sf, "pages").withColumn("text", F.concat("html", "url"))
    return quality.source_tag(pages).select("page_id", "source")


# ---------------------------------------------------------------- on-chain

@query("a1_onchain_metrics", f"""WITH {TRANSFERS_SQL} SELECT network, {r('sum(transactionVolume) AS sum_transactionVolume',
  'avg(transactionVolume) AS mean_transactionVolume', 'stddev_samp(transactionVolume) AS std_transactionVolume',
  'median(transactionVolume) AS median_transactionVolume', 'sum(walletActivity) AS sum_walletActivity',
  'avg(walletActivity) AS mean_walletActivity', 'stddev_samp(walletActivity) AS std_walletActivity',
  'sum(smartContractInteractions) AS sum_smartContractInteractions', 'avg(smartContractInteractions) AS mean_smartContractInteractions',
  'sum(gasUsed) AS sum_gasUsed', 'avg(gasUsed) AS mean_gasUsed', 'stddev_samp(gasUsed) AS std_gasUsed', digits=3)},
  count(DISTINCT uniqueAddresses) AS unique_addresses, {r('count(uniqueAddresses) / count(DISTINCT uniqueAddresses) AS rows_per_address', digits=3)}
  FROM transfers GROUP BY network""")
def a1_onchain_metrics(spark, sf):
    return tidy(onchain.onchain_metrics(transfers(spark, sf)), digits=3)


@query("a2_daily_trend", f"""WITH {TRANSFERS_SQL}, d AS (SELECT network, CAST(ts AS DATE) AS day, sum(transactionVolume) AS total FROM transfers GROUP BY ALL),
  sp AS (SELECT network, unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS day FROM d GROUP BY network),
  f AS (SELECT network, sp.day, coalesce(total, 0) AS total FROM sp LEFT JOIN d USING (network, day)),
  c AS (SELECT *, total / nullif(lag(total) OVER (PARTITION BY network ORDER BY day), 0) - 1 AS c FROM f)
  SELECT network, {r('avg(c) AS trend')}, count(*) FILTER (total = 0) AS n_zero_days, count(*) AS n_days FROM c GROUP BY network""")
def a2_daily_trend(spark, sf):
    return tidy(onchain.daily_trend(transfers(spark, sf), ["network"], "transactionVolume"))


@query("a3_weekly_sum", f"""WITH {TRANSFERS_SQL} SELECT network, CAST(date_trunc('week', ts) + INTERVAL 6 DAY AS TIMESTAMP) AS week_end,
  {r('sum(transactionVolume) AS weekly_sum', digits=3)} FROM transfers GROUP BY ALL""")
def a3_weekly_sum(spark, sf):
    return tidy(onchain.weekly_sum(transfers(spark, sf), ["network"], "transactionVolume"), digits=3)


QUOTES_SQL = BARS_SQL + """, k AS (SELECT ts, count(*) AS n_quotes, """ + ", ".join(
    f"avg({f}) AS m_{f}, stddev_pop({f}) AS s_{f}" for f in ("open", "high", "low", "close")) + """ FROM bars GROUP BY ts),
w AS (SELECT b.*, n_quotes, """ + ", ".join(
    f"CASE WHEN abs({f} - m_{f}) <= 1.2 * (1 + s_{f}) THEN 1 / (abs({f} - m_{f}) + 1e-6) END AS w_{f}" for f in ("open", "high", "low", "close")) + """
  FROM bars b JOIN k USING (ts)),
g AS (SELECT ts, any_value(n_quotes) AS n_quotes, """ + " AND ".join(
    f"count(w_{f}) >= count({f}) * 0.5" for f in ("open", "high", "low", "close")) + " AS valid, " + ", ".join(
    f"sum(w_{f} * {f}) / sum(w_{f}) AS c_{f}" for f in ("open", "high", "low", "close")) + """,
  sum(w_close * volume) / sum(w_close) AS c_volume FROM w GROUP BY ts)"""


@query("a4_consensus_price", f"""WITH {QUOTES_SQL} SELECT ts, n_quotes, valid,
  {r(*[f'CASE WHEN valid THEN c_{f} END AS {f}' for f in ('open', 'high', 'low', 'close', 'volume')])} FROM g""")
def a4_consensus_price(spark, sf):
    """Hourly bars of the five event types as five quotes for one price."""
    quotes = bars(spark, sf).drop("trades")
    return tidy(onchain.consensus_price(quotes, ["ts"], base=1.2))


@query("a7_whale_threshold", f"WITH {TRANSFERS_SQL} SELECT network, {r('quantile_cont(transactionVolume, 0.99) AS threshold')} FROM transfers GROUP BY network")
def a7_whale_threshold(spark, sf):
    return tidy(onchain.whale_threshold(transfers(spark, sf)))


@query("a8_whale_transactions", f"""WITH {TRANSFERS_SQL},
  i AS (SELECT *, row_number() {over(key='network', order='ts, tx_id')} - 1 AS idx,
        quantile_cont(transactionVolume, 0.99) OVER (PARTITION BY network) AS threshold FROM transfers),
  w AS (SELECT *, idx // 5 AS cluster, (close / lag(close) {over(key='network', order='ts, tx_id')} - 1) * transactionVolume AS price_impact
        FROM i WHERE transactionVolume > threshold)
  SELECT tx_id, network, {r('transactionVolume', 'price_impact', 'sum(transactionVolume) OVER c AS cluster_transaction_volume',
    'avg(price_impact) OVER c AS cluster_price_impact', digits=4)} FROM w WINDOW c AS (PARTITION BY network, cluster)""")
def a8_whale_transactions(spark, sf):
    t = transfers(spark, sf).select("network", "ts", "tx_id", "transactionVolume", "close")
    return tidy(onchain.whale_transactions(t, TRANSFERS), "tx_id", "network", "transactionVolume", "price_impact",
                "cluster_transaction_volume", "cluster_price_impact", digits=4)


@query("a11_mining_trend", f"""WITH {TRANSFERS_SQL}, m AS (SELECT network, ts, sum(transactionVolume) AS hashrate FROM transfers GROUP BY ALL)
  SELECT network, count(*) AS n_points, {r("regr_slope(hashrate, datediff('day', TIMESTAMP '1970-01-01', ts)) AS slope",
    "regr_r2(hashrate, datediff('day', TIMESTAMP '1970-01-01', ts)) AS r_squared")} FROM m GROUP BY network""")
def a11_mining_trend(spark, sf):
    mining = transfers(spark, sf).groupBy("network", "ts").agg(F.sum("transactionVolume").alias("hashrate"))
    return tidy(onchain.mining_trend(mining), "network", "n_points", "slope", "r_squared")


# Twice the tail of Student's t, by Simpson's rule over 4,000 intervals of its density.
@query("a11_mining_trend_significance", f"""WITH {TRANSFERS_SQL}, m AS (SELECT network, ts, sum(transactionVolume) AS hashrate FROM transfers GROUP BY ALL),
  f AS (SELECT network, count(*) AS n_points, regr_slope(hashrate, datediff('day', TIMESTAMP '1970-01-01', ts)) AS slope,
    regr_r2(hashrate, datediff('day', TIMESTAMP '1970-01-01', ts)) AS r_squared FROM m GROUP BY network),
  t AS (SELECT *, n_points - 2 AS v, sqrt(r_squared * (n_points - 2) / (1 - r_squared)) AS t FROM f),
  p AS (SELECT network, 1 - 2 * any_value(t) / 12000 * sum((CASE WHEN i IN (0, 4000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END)
     * exp(lgamma((v + 1) / 2.0) - lgamma(v / 2.0)) / sqrt(v * pi()) * pow(1 + pow(t * i / 4000, 2) / v, -(v + 1) / 2.0)) AS p_value
    FROM t, range(4001) AS g(i) GROUP BY network)
  SELECT network, n_points, {r('slope', 'r_squared', 'p_value')} FROM f JOIN p USING (network)""")
def a11_mining_trend_significance(spark, sf):
    """With the p-value."""
    mining = transfers(spark, sf).groupBy("network", "ts").agg(F.sum("transactionVolume").alias("hashrate"))
    return tidy(onchain.mining_trend(mining))


@query("a12_address_stats", f"""WITH {TRANSFERS_SQL} SELECT network, count(DISTINCT wallet_id) AS unique_addresses,
  {r('count(wallet_id) / count(DISTINCT wallet_id) AS rows_per_address')} FROM transfers GROUP BY network""")
def a12_address_stats(spark, sf):
    return tidy(onchain.address_stats(transfers(spark, sf), ["network"], "wallet_id"))


def telemetry(spark, sf):
    """events as calls to a source: slow answers failed, errors went through the fallback."""
    return table(spark, sf, "events").select(F.col("event_type").alias("source"), "ts", (F.col("value") < 60).alias("ok"),
                                             F.col("value").alias("response_time"),
                                             F.when(F.col("value") > 100, "fallback").otherwise("socket").alias("kind"))


TELEMETRY_SQL = """tele AS (SELECT event_type AS source, ts, value < 60 AS ok, value AS response_time,
  CASE WHEN value > 100 THEN 'fallback' ELSE 'socket' END AS kind FROM events),
hourly AS (SELECT source, date_trunc('hour', ts) AS window_start, count(*) AS n_calls, avg(response_time) AS avg_response_time,
  avg(CAST(ok AS DOUBLE)) * 100 AS success_rate, count(*) FILTER (NOT ok) AS n_errors, count(*) FILTER (kind = 'fallback') AS n_fallbacks
  FROM tele GROUP BY source, date_trunc('hour', tele.ts))"""


@query("a15_source_telemetry", f"WITH {TELEMETRY_SQL} SELECT source, window_start, n_calls, n_errors, n_fallbacks, {r('avg_response_time', 'success_rate', digits=8)} FROM hourly")
def a15_source_telemetry(spark, sf):
    return tidy(onchain.source_telemetry(telemetry(spark, sf)), digits=8)


@query("p16_success_alerts", f"""WITH {TELEMETRY_SQL} SELECT source, window_start, 'success_rate' AS metric, '<' AS op, CAST(80 AS DOUBLE) AS "limit",
  {r('success_rate AS value')} FROM hourly WHERE success_rate < 80""")
def p16_success_alerts(spark, sf):
    hourly = onchain.source_telemetry(telemetry(spark, sf))
    return tidy(risk.threshold_alerts(hourly, ["source", "window_start"], [risk.SUCCESS_THRESHOLD]))

"""The whole flows on the given tables, each against one SQL text."""

from __future__ import annotations

from pyspark.sql import functions as F

from tideline import flows
from tideline.plans.inputs import BARS, BARS_SQL, TICKS_SQL, bars, documents, over, r, roll, table, ticks, tidy
from tideline.plans.ingest import TEMPLATES, raw_quotes
from tideline.plans.market import CHART_SQL, LAGS_SQL, RSI_SQL
from tideline.plans.registry import query
from tideline.plans.social import ENTITIES_SQL, LEXICON_SQL, NEGATORS, gazetteer, lexicon, sentiment_sql

PRICES = ("open", "high", "low", "close")


@query("flow_quotes", f"""WITH {TICKS_SQL}, q AS (SELECT symbol, {list(TEMPLATES)!r}[event_id % {len(TEMPLATES)} + 1] AS source, ts, event_id, price + 0.5 AS close, volume FROM ticks),
  own AS (SELECT symbol, source, date_trunc('hour', q.ts) AS ts, first(close ORDER BY ts, event_id) AS open, max(close) AS high, min(close) AS low,
    last(close ORDER BY ts, event_id) AS close, sum(volume) AS volume FROM q WHERE source <> 'Unknown' GROUP BY symbol, source, date_trunc('hour', q.ts)),
  k AS (SELECT symbol, ts, count(*) AS n_quotes, {', '.join(f'avg({f}) AS m_{f}, stddev_pop({f}) AS s_{f}' for f in PRICES)} FROM own GROUP BY symbol, ts),
  w AS (SELECT o.*, n_quotes, {', '.join(f'CASE WHEN abs({f} - m_{f}) <= 1.2 * (1 + s_{f}) THEN 1 / (abs({f} - m_{f}) + 1e-6) END AS w_{f}' for f in PRICES)} FROM own o JOIN k USING (symbol, ts)),
  bars AS (SELECT symbol, ts, any_value(n_quotes) AS n_quotes, {', '.join(f'sum(w_{f} * {f}) / sum(w_{f}) AS {f}' for f in PRICES)}, sum(w_close * volume) / sum(w_close) AS volume
    FROM w GROUP BY symbol, ts HAVING {' AND '.join(f'count(w_{f}) > 0 AND count(w_{f}) >= count({f}) * 0.5' for f in PRICES)}),
  {RSI_SQL}, {LAGS_SQL}, p AS (SELECT symbol, ts, {CHART_SQL} FROM lg), m AS (SELECT symbol, ts, n_quotes, close, volume, {roll('avg', 'close', 20)} AS SMA FROM bars)
  SELECT symbol, ts, n_quotes, {r('close', 'volume', 'SMA', 'RSI', 'double_top', 'pennant')} FROM m JOIN (SELECT symbol, ts, RSI FROM rs) USING (symbol, ts) JOIN p USING (symbol, ts)""")
def flow_quotes(spark, sf):
    """Messages of 18 sources about five symbols to one validated, annotated and stored series per symbol."""
    from tideline.plans.ingest import scratch

    out = flows.quote_flow(raw_quotes(spark, sf, own_symbols=True), order=["event_id"], base=1.2, path=scratch(spark, "market"))
    out = out.withColumns({c: F.col(c).cast("double") for c in ("double_top", "pennant")})
    return tidy(out, "symbol", "ts", "n_quotes", "close", "volume", "SMA", "RSI", "double_top", "pennant")


def posts_with_texts(spark, sf):
    """events as posts whose text is the document of their number."""
    docs = documents(spark, sf).select("doc_id", "text")
    posts = ticks(spark, sf).select("event_id", F.col("symbol").alias("source"), F.col("ts").alias("created_at"))
    posts = posts.withColumn("doc", F.pmod("event_id", F.lit(docs.count())))
    return posts.join(docs, F.col("doc") == F.col("doc_id"), "left").select("event_id", "source", "created_at", "text")


def measured_texts(spark, sf):
    market = bars(spark, sf).select(F.col("symbol").alias("source"), F.col("ts").alias("bar_ts"), "close")
    return flows.text_flow(posts_with_texts(spark, sf), market, lexicon(spark, sf), gazetteer(spark, sf), "event_id", "text", "created_at", "bar_ts", ["source"], NEGATORS)


TEXTS_SQL = f"""{BARS_SQL}, {LEXICON_SQL}, {sentiment_sql('documents', 'doc_id')}, {ENTITIES_SQL},
  en AS (SELECT doc_id, count(*) AS n_mentions, count(DISTINCT phrase) AS n_entities FROM ent GROUP BY doc_id),
  mk AS (SELECT symbol, ts AS bar_ts, close FROM bars),
  posts AS (SELECT event_id, symbol AS source, ts AS created_at, event_id % (SELECT count(*) FROM documents) AS doc_id FROM ticks),
  meas AS (SELECT event_id, source, created_at, coalesce(n_hits, 0) AS n_hits, coalesce(sentiment, 0) AS sentiment, coalesce(n_mentions, 0) AS n_mentions,
    coalesce(n_entities, 0) AS n_entities FROM posts LEFT JOIN sent USING (doc_id) LEFT JOIN en USING (doc_id)),
  pr AS (SELECT m.*, mk.close AS market_close FROM meas m ASOF LEFT JOIN mk ON m.source = mk.symbol AND m.created_at >= mk.bar_ts)"""


@query("flow_texts", f"WITH {TEXTS_SQL} SELECT event_id, source, n_hits, n_mentions, n_entities, {r('sentiment', 'market_close')} FROM pr")
def flow_texts(spark, sf):
    """Posts with their texts: sentiment, entities, and the price at their time."""
    priced, _ = measured_texts(spark, sf)
    return tidy(priced, "event_id", "source", "n_hits", "n_mentions", "n_entities", "sentiment", "market_close")


@query("flow_hourly_sentiment", f"""WITH {TEXTS_SQL} SELECT date_trunc('hour', created_at) AS window_start, date_trunc('hour', created_at) + INTERVAL 1 HOUR AS window_end, source,
  {r('avg(sentiment) AS avg_sentiment')}, count(sentiment) AS n_posts FROM pr GROUP BY ALL""")
def flow_hourly_sentiment(spark, sf):
    """The same posts by hour: mean sentiment of real texts."""
    return tidy(measured_texts(spark, sf)[1])


@query("flow_text_impact", f"""WITH {TEXTS_SQL}, f AS (SELECT regr_slope(market_close, sentiment) AS b, regr_intercept(market_close, sentiment) AS a FROM pr)
  SELECT event_id, {r('a + b * sentiment AS impact_score', digits=5)} FROM pr, f""")
def flow_text_impact(spark, sf):
    """What the sentiment of a post's text says about the price at its time."""
    priced, _ = measured_texts(spark, sf)
    return tidy(flows.impact_of_texts(priced, ["sentiment"]), "event_id", "impact_score", digits=5)


PREPARED_SQL = f"""{BARS_SQL}, c AS (SELECT symbol, date_trunc('hour', ticks.ts) AS ts, avg(price) AS v FROM ticks WHERE event_id % 4 = 1 GROUP BY symbol, date_trunc('hour', ticks.ts)),
  j AS (SELECT bars.*, c.v FROM bars LEFT JOIN c USING (symbol, ts)), f AS (SELECT regr_slope(v, close) AS b, regr_intercept(v, close) AS a FROM j),
  i AS (SELECT symbol, ts, close, coalesce(v, a + b * close) AS calls_value, row_number() {over()} - 1 AS idx, count(*) OVER (PARTITION BY symbol) AS n, lag(close) {over()} AS close_lag_1,
    lag(calls_value, 2) {over()} AS lag2 FROM (SELECT symbol, ts, close, v, a, b, coalesce(v, a + b * close) AS calls_value FROM j, f)),
  p AS (SELECT *, idx < n - ceil(n * 0.2 - 1e-9) AS is_train FROM i)"""


def prepared(spark, sf):
    """Bars with the mean price of a quarter of the events beside them, which most hours lack."""
    some = ticks(spark, sf).where("event_id % 4 = 1").groupBy("symbol", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts")).agg(F.avg("price").alias("value"))
    b = bars(spark, sf).select("symbol", "ts", "close")
    return flows.prepare_flow(b.withColumn("ts", F.col("ts").cast("timestamp_ntz")), {"calls": some}, BARS, ["close", "calls_value"], ["close"],
                              lag_columns=("close", "calls_value"), ridge=0.0)


@query("flow_prepare", f"""WITH {PREPARED_SQL} SELECT symbol, CAST(ts AS TIMESTAMP) AS ts, is_train, {r('calls_value', 'close_lag_1', 'lag2 AS calls_value_lag_2', digits=5)} FROM p""")
def flow_prepare(spark, sf):
    """Merged, filled, checked, lagged and split."""
    return tidy(prepared(spark, sf)[0], "symbol", "ts", "is_train", "calls_value", "close_lag_1", "calls_value_lag_2", digits=5)


@query("flow_prepare_report", f"""WITH {PREPARED_SQL} SELECT is_train, count(*) AS n_rows, 'close_lag_1' AS "column", count(*) FILTER (close_lag_1 IS NULL) AS n_missing FROM p GROUP BY is_train
  UNION ALL SELECT is_train, count(*), 'calls_value_lag_2', count(*) FILTER (lag2 IS NULL) FROM p GROUP BY is_train""")
def flow_prepare_report(spark, sf):
    return prepared(spark, sf)[1].where(F.col("column").isin("close_lag_1", "calls_value_lag_2"))

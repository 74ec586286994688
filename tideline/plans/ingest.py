"""Scans, sinks and landed messages. Messages are rendered from the given tables, then parsed back."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import functions as F

from tideline.operators import risk
from tideline.plans.inputs import BARS, BARS_SQL, BENCHMARK_SQL, bars, benchmark_returns, r, table, ticks, tidy, TICKS_SQL
from tideline.plans.registry import query
from tideline.plans.risk import COLUMNS, RISK_SQL
from tideline.sources import payloads, scans
from tideline.sources.store import KeyedStore
from tideline.staging import stage, staging_root


def scratch(spark, name: str) -> str:
    return f"{staging_root(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


@query("s1_load_table", "SELECT l_orderkey, l_linenumber, round(l_extendedprice, 6) + 0.0 AS l_extendedprice FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_quantity > 45")
def s1_load_table(spark, sf):
    return tidy(scans.load_table(spark, f"{sf}/lineitem.parquet", ["l_orderkey", "l_linenumber", "l_extendedprice"],
                                 "l_shipdate >= TIMESTAMP_NTZ'1998-01-01' AND l_quantity > 45"))


@query("s2_map_chunks", "SELECT event_id, round(value * 2, 6) + 0.0 AS doubled FROM events WHERE event_type <> 'error'")
def s2_map_chunks(spark, sf):
    def double(batch: pd.DataFrame) -> pd.DataFrame:
        kept = batch[batch["event_type"] != "error"]
        return pd.DataFrame({"event_id": kept["event_id"], "doubled": kept["value"] * 2})

    events = table(spark, sf, "events").select("event_id", "event_type", "value")
    return tidy(scans.map_chunks(events, double, "event_id long, doubled double"))


@query("s3_save_table", "SELECT o_orderkey, o_orderpriority, CAST(floor(o_totalprice) AS BIGINT) AS cents_free FROM orders")
def s3_save_table(spark, sf):
    path = scratch(spark, "save")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", F.floor("o_totalprice").alias("cents_free"))
    scans.save_table(orders, path, "fail", {"cents_free": "bigint"}, ["o_orderpriority"])
    return spark.read.parquet(path).select("o_orderkey", "o_orderpriority", "cents_free")


@query("s4_append_dedup", "SELECT DISTINCT CAST(ts AS TIMESTAMP) AS timestamp, round(value, 6) + 0.0 AS price FROM events")
def s4_append_dedup(spark, sf):
    """Half of the events are stored, then all of them are appended: nothing is stored twice."""
    path = scratch(spark, "dedup")
    rows = table(spark, sf, "events").select(F.col("ts").alias("timestamp"), F.col("value").alias("price"),
                                             F.to_date("ts").alias("day"), "event_type")
    first = rows.where(F.col("event_type").isin("click", "view", "error"))
    scans.append_dedup(first.drop("event_type"), path, partition="day")
    scans.append_dedup(rows.drop("event_type"), path, partition="day")
    return tidy(spark.read.parquet(path), "timestamp", "price")


@query("s4_keyed_store", "SELECT DISTINCT CAST(ts AS TIMESTAMP) AS timestamp, round(value, 6) + 0.0 AS price, event_type FROM events")
def s4_keyed_store(spark, sf):
    """The events in three appends that overlap: a store by (time, price, type) holds every key once."""
    rows = table(spark, sf, "events").select(F.col("ts").alias("timestamp"), F.col("value").alias("price"), "event_type", F.pmod("event_id", F.lit(3)).alias("part"))
    store = KeyedStore(spark, scratch(spark, "store"), ["timestamp", "price", "event_type"], buckets=8)
    for parts in ((0, 1), (1, 2), (0, 1, 2)):
        store.append(rows.where(F.col("part").isin(*parts)).drop("part"))
    return tidy(store.read(), "timestamp", "price", "event_type")


@query("s5_read_csv", "SELECT event_id, event_type, round(value, 6) + 0.0 AS value, props FROM events")
def s5_read_csv(spark, sf):
    path = scratch(spark, "csv")
    table(spark, sf, "events").select("event_id", "event_type", "value", "props").write.option("header", True).csv(path)
    return tidy(scans.read_csv(spark, path, "event_id long, event_type string, value double, props string"))


# ---------------------------------------------------------------- quotes

# Message shapes to render, with open, high, low, close, volume as %1$s .. %5$s.
TEMPLATES = {
    "rest": '{"open":%1$s,"high":%2$s,"low":%3$s,"close":%4$s,"volume":%5$s}',
    "CoinbasePro": '{"open":"%1$s","high":"%2$s","low":"%3$s","price":"%4$s","last_size":"%5$s"}',
    "FTX": '{"data":{"open":%1$s,"high":%2$s,"low":%3$s,"last":%4$s,"volumeUsd24h":%5$s}}',
    "Bitfinex": '[0,%1$s,0,%2$s,%3$s,0,0,%4$s,%5$s,0]',
    "Alpaca": '{"bars":[{"o":%1$s,"h":%2$s,"l":%3$s,"c":%4$s,"v":%5$s}]}',
    "SerumDEX": '{"result":{"open":%1$s,"high":%2$s,"low":%3$s,"last":%4$s,"volume":%5$s}}',
    "Solana": '{"result":{"value":{"data":{"open":%1$s,"high":%2$s,"low":%3$s,"price":%4$s,"volume":%5$s}}}}',
    "AlphaVantage": '{"Time Series (Daily)":[{"1. open":"%1$s","2. high":"%2$s","3. low":"%3$s","4. close":"%4$s","5. volume":"%5$s"}]}',
    "CoinGecko": '{"prices":[[0,1],[1,%4$s]],"high":[0,%2$s],"low":[0,%3$s],"total_volumes":[[0,1],[1,%5$s]]}',
    "Kraken": '{"result":{"XXBTZUSD":[[0,"1","1","1","1","1","1"],[1,"%1$s","%2$s","%3$s","%4$s","0","%5$s"]],"last":[]}}',
    "CoinMarketCap": '{"data":{"BTC":{"quote":{"USD":{"open":%1$s,"high":%2$s,"low":%3$s,"price":%4$s,"volume_24h":%5$s}}}}}',
    "Nomics": '[{"open":"%1$s","high":"%2$s","low":"%3$s","price":"%4$s","1d":{"volume":"%5$s"}}]',
    "DexScreener": '{"pairs":[{"open":%1$s,"high":%2$s,"low":%3$s,"priceUsd":"%4$s","volumeUsd24h":%5$s}]}',
    "DexTools": '{"pairs":[{"open":%1$s,"high":%2$s,"low":%3$s,"priceUsd":"%4$s","volumeUsd24h":%5$s}]}',
    "Messari": '{"data":{"market_data":{"open":%1$s,"high":%2$s,"low":%3$s,"price_usd":%4$s,"volume_last_24_hours":%5$s}}}',
    "TradingView": '{"open":%1$s,"high":%2$s,"low":%3$s,"price":%4$s,"volume":%5$s}',
    "CryptoCompare": '{"USD":{"open":%1$s,"high":%2$s,"low":%3$s,"price":%4$s,"volume_24h":%5$s}}',
    "Binance": '{"k":{"o":"%1$s","h":"%2$s","l":"%3$s","c":"%4$s","v":"%5$s"}}',
    "Unknown": '{"open":%1$s}',
}


def raw_quotes(spark, sf, own_symbols: bool = False):
    """events as landed quote messages of every source in turn; the last source is one nobody knows. With ``own_symbols``, messages about the event's type."""
    names = F.array(*[F.lit(n) for n in TEMPLATES])
    t = ticks(spark, sf).withColumn("source", F.get(names, (F.col("event_id") % len(TEMPLATES)).cast("int")))
    price = F.col("price")
    values = [v.cast("string") for v in (price, price + 1, price / 2, price + 0.5, F.col("volume"))]
    payload = F.lit(None).cast("string")
    for name, template in TEMPLATES.items():
        payload = F.when(F.col("source") == name, F.format_string(template, *values)).otherwise(payload)
    if own_symbols:
        payload = F.replace(payload, F.lit('"BTC"'), F.concat(F.lit('"'), "symbol", F.lit('"')))
    return stage(t.select("event_id", "ts", "source", *["symbol"] * own_symbols, payload.alias("payload")), "landed")


QUOTES_SQL = TICKS_SQL + f""", q AS (SELECT event_id, {list(TEMPLATES)!r}[event_id % {len(TEMPLATES)} + 1] AS source,
  price AS open, price + 1 AS high, price / 2 AS low, price + 0.5 AS close, volume FROM ticks)"""


@query("s6_normalize_quotes", f"""WITH {QUOTES_SQL} SELECT event_id, source,
  {r("CASE WHEN source = 'CoinGecko' THEN close ELSE open END AS open", 'high', 'low', 'close', 'volume')} FROM q WHERE source <> 'Unknown'""")
def s6_normalize_quotes(spark, sf):
    return tidy(payloads.normalize_quotes(raw_quotes(spark, sf)), "event_id", "source", *payloads.FIELDS)


@query("s6_quote_rejects", f"WITH {QUOTES_SQL} SELECT event_id, source FROM q WHERE source = 'Unknown'")
def s6_quote_rejects(spark, sf):
    return payloads.quote_rejects(raw_quotes(spark, sf)).select("event_id", "source")


def _per_day(spark, sf):
    return bars(spark, sf).withColumn("day", F.to_date("ts"))


@query("s7_explode_candles", f"WITH {BARS_SQL} SELECT symbol, ts AS timestamp, {r(*COLUMNS)} FROM bars")
def s7_explode_candles(spark, sf):
    """One message per symbol and day (at most 24 hourly candles), then back to rows."""
    candle = F.struct(*COLUMNS, F.col("ts").cast("timestamp").alias("timestamp"))
    raw = _per_day(spark, sf).groupBy("symbol", "day").agg(F.to_json(F.struct(F.collect_list(candle).alias("candles"))).alias("payload"))
    return tidy(payloads.explode_candles(raw), "symbol", "timestamp", *COLUMNS)


@query("s8_explode_series_map", f"WITH {BARS_SQL} SELECT symbol, ts AS timestamp, {r(*COLUMNS)} FROM bars")
def s8_explode_series_map(spark, sf):
    fields = F.create_map(*[x for i, c in enumerate(COLUMNS, 1) for x in (F.lit(f"{i}. {c}"), F.col(c).cast("string"))])
    entry = F.struct(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), fields)
    raw = _per_day(spark, sf).groupBy("symbol", "day").agg(
        F.to_json(F.struct(F.map_from_entries(F.collect_list(entry)).alias("Time Series (60min)"))).alias("payload"))
    return tidy(payloads.explode_series_map(raw, key="Time Series (60min)"), "symbol", "timestamp", *COLUMNS)


@query("s9_explode_order_book", f"""WITH {TICKS_SQL}, l AS (SELECT symbol AS source, date_trunc('minute', ts) AS timestamp,
    CASE WHEN event_id % 2 = 0 THEN 'bid' ELSE 'ask' END AS side, price, volume FROM ticks)
  SELECT source, timestamp, side, CAST(row_number() OVER (PARTITION BY source, timestamp, side ORDER BY
     CASE WHEN side = 'bid' THEN -price ELSE price END, CASE WHEN side = 'bid' THEN -volume ELSE volume END) - 1 AS INTEGER) AS level,
    {r('price', 'volume AS quantity')} FROM l""")
def s9_explode_order_book(spark, sf):
    """A minute of ticks of one symbol as a book: even ids bid, odd ids ask, best price first."""
    t = ticks(spark, sf).withColumns({"even": F.col("event_id") % 2 == 0, "level": F.array("price", "volume")})
    book = t.groupBy(F.col("symbol").alias("source"), F.window("ts", "1 minute").alias("w")).agg(
        F.to_json(F.struct(F.sort_array(F.collect_list(F.when(F.col("even"), F.col("level"))), asc=False).alias("bids"),
                           F.sort_array(F.collect_list(F.when(~F.col("even"), F.col("level")))).alias("asks"))).alias("payload"))
    raw = book.select("source", F.col("w.start").alias("timestamp"), "payload")
    return tidy(payloads.explode_order_book(raw), "source", "timestamp", "side", "level", "price", "quantity")


# ---------------------------------------------------------------- news, posts, chain

KINDS = ("rss", "newsapi", "gdelt", "socket", "trends", "fred")


def raw_articles(spark, sf):
    """documents as news messages of every kind in turn, whole texts."""
    docs = table(spark, sf, "documents")
    text, name = F.col("text"), F.concat_ws("/", "source", "doc_id")
    stamp = F.date_format(F.timestamp_seconds(F.col("doc_id") * 3600), "yyyy-MM-dd HH:mm:ss")
    kind = F.get(F.array(*[F.lit(k) for k in KINDS]), (F.col("doc_id") % len(KINDS)).cast("int"))
    item = F.struct(name.alias("title"), text.alias("content"), stamp.alias("seendate"))
    rss = F.to_xml(F.struct(name.alias("title"), F.col("lang").alias("description"),
                            F.concat(F.lit("http://feed/"), "doc_id").alias("link"), stamp.alias("pubDate")))
    payload = (
        F.when(F.col("kind") == "rss", rss)
        .when(F.col("kind") == "newsapi", F.to_json(F.struct(F.array(F.struct(
            name.alias("title"), F.col("lang").alias("description"), text.alias("content"), stamp.alias("publishedAt"))).alias("articles"))))
        .when(F.col("kind").isin("gdelt", "socket"), F.to_json(F.array(item)))
        .when(F.col("kind") == "trends", F.to_json(F.struct(F.struct(F.array(F.struct(
            stamp.alias("date"), name.alias("formattedDate"))).alias("trendingSearchesDays")).alias("default"))))
        .otherwise(F.to_json(F.struct(F.array(F.struct(stamp.alias("date"), F.col("n_chars").cast("string").alias("value"))).alias("observations")))))
    return docs.withColumn("kind", kind).select("doc_id", "kind", payload.alias("payload"))


@query("s10_normalize_articles", f"""WITH d AS (SELECT *, {list(KINDS)!r}[doc_id % {len(KINDS)} + 1] AS kind,
    strftime(TIMESTAMP '1970-01-01' + doc_id * INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS stamp FROM documents)
  SELECT doc_id, kind, CASE WHEN kind <> 'fred' THEN source || '/' || doc_id END AS title,
    CASE WHEN kind IN ('rss', 'newsapi') THEN lang END AS description,
    CASE WHEN kind IN ('newsapi', 'gdelt', 'socket') THEN md5(text) END AS content_md5,
    CASE WHEN kind = 'rss' THEN 'http://feed/' || doc_id END AS link, stamp AS published,
    CASE WHEN kind = 'fred' THEN CAST(n_chars AS VARCHAR) END AS value FROM d""")
def s10_normalize_articles(spark, sf):
    out = payloads.normalize_articles(raw_articles(spark, sf))
    return out.select("doc_id", "kind", "title", "description", F.md5("content").alias("content_md5"), "link",
                      "published", "value")


@query("s10_filtered_articles", f"""WITH d AS (SELECT *, {list(KINDS)!r}[doc_id % {len(KINDS)} + 1] AS kind FROM documents)
  SELECT doc_id, kind FROM d WHERE kind IN ('trends', 'fred') OR contains(lower(source || '/' || doc_id || ' ' ||
    CASE WHEN kind IN ('rss', 'newsapi') THEN lang || ' ' ELSE '' END || CASE WHEN kind <> 'rss' THEN text ELSE '' END), 'license')""")
def s10_filtered_articles(spark, sf):
    return payloads.normalize_articles(raw_articles(spark, sf), ["license"]).select("doc_id", "kind")


POST_KINDS = ("twitter", "reddit", "telegram", "discord")


def raw_posts(spark, sf):
    """conversation turns as posts of four networks in turn."""
    c = table(spark, sf, "conversations")
    kind = F.get(F.array(*[F.lit(k) for k in POST_KINDS]), (F.col("turn") % 4).cast("int"))
    seconds = 1_700_000_000 + F.col("conv_id") * 60 + F.col("turn")
    stamp = F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    shapes = {
        "twitter": F.struct("text", stamp.alias("created_at"), F.col("turn").alias("like_count"), F.length("text").alias("retweet_count")),
        "reddit": F.struct(F.col("role").alias("title"), F.col("text").alias("selftext"), seconds.cast("double").alias("created_utc"),
                           F.col("turn").alias("score"), F.col("conv_id").alias("num_comments"), F.lit("markets").alias("subreddit")),
        "telegram": F.struct(F.col("text").alias("message"), stamp.alias("date")),
        "discord": F.struct(F.col("text").alias("content"), stamp.alias("created_at"), F.col("conv_id").cast("string").alias("channel"),
                            F.col("role").alias("author")),
    }
    payload = F.lit(None).cast("string")
    for name, shape in shapes.items():
        payload = F.when(F.col("kind") == name, F.to_json(shape)).otherwise(payload)
    return c.withColumn("kind", kind).select("conv_id", "turn", "kind", payload.alias("payload"))


@query("s11_normalize_posts", f"""WITH c AS (SELECT *, {list(POST_KINDS)!r}[turn % 4 + 1] AS source FROM conversations)
  SELECT conv_id, turn, source, md5(CASE WHEN source = 'reddit' THEN role || ' ' || text ELSE text END) AS text_md5,
    TIMESTAMP '2023-11-14 22:13:20' + (conv_id * 60 + turn) * INTERVAL 1 SECOND AS created_at,
    CASE source WHEN 'reddit' THEN 'markets' WHEN 'discord' THEN CAST(conv_id AS VARCHAR) END AS channel,
    CASE WHEN source = 'discord' THEN role END AS author,
    CAST(CASE WHEN source = 'twitter' THEN turn END AS DOUBLE) AS likes, CAST(CASE WHEN source = 'reddit' THEN turn END AS DOUBLE) AS upvotes,
    CAST(CASE WHEN source = 'reddit' THEN conv_id END AS DOUBLE) AS comments FROM c""")
def s11_normalize_posts(spark, sf):
    out = payloads.normalize_posts(raw_posts(spark, sf))
    return tidy(out.select("conv_id", "turn", "source", F.md5("text").alias("text_md5"), "created_at", "channel", "author",
                           *[F.col(c).cast("double").alias(c) for c in ("likes", "upvotes", "comments")]))


@query("s12_normalize_onchain", """SELECT o_orderkey AS tx_id, o_orderpriority AS network, o_orderkey AS id,
    CASE WHEN o_orderstatus <> 'P' THEN CAST(round(o_totalprice * 100) AS DOUBLE) END AS result_value, o_orderstatus = 'P' AS rejected FROM orders""")
def s12_normalize_onchain(spark, sf):
    """orders as JSON-RPC answers with a hex amount; pending ones lack the result."""
    orders = table(spark, sf, "orders")
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    body = F.struct(F.lit("2.0").alias("jsonrpc"), F.col("o_orderkey").alias("id"),
                    F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("0x"), F.lower(F.hex(cents)))).alias("result"))
    raw = orders.select(F.col("o_orderkey").alias("tx_id"), F.col("o_orderpriority").alias("network"), F.to_json(body).alias("payload"))
    out = payloads.normalize_onchain(raw)
    return out.select("tx_id", "network", "id", F.col("result_value").cast("double").alias("result_value"), "rejected")


@query("s13_assemble_mining", f"""SELECT o_orderpriority AS network, o_orderdate AS ts,
    {r("max(o_totalprice) FILTER (o_orderstatus = 'F') AS hashrate", "max(o_totalprice) FILTER (o_orderstatus = 'O') AS difficulty",
       "max(o_totalprice) FILTER (o_orderstatus = 'P') AS block_reward", 'NULL AS orphaned_blocks')} FROM orders GROUP BY ALL""")
def s13_assemble_mining(spark, sf):
    """orders as endpoint answers; no order stands for orphaned blocks, so that column is NULL."""
    endpoint = (F.when(F.col("o_orderstatus") == "F", "hashrate").when(F.col("o_orderstatus") == "O", "difficulty").otherwise("block_reward"))
    raw = table(spark, sf, "orders").withColumn("endpoint", endpoint).select(
        F.col("o_orderpriority").alias("network"), F.col("o_orderdate").alias("ts"), "endpoint",
        F.to_json(F.create_map("endpoint", "o_totalprice")).alias("payload"))
    return tidy(payloads.assemble_mining(raw))


@query("s14_union_network_tables", """SELECT c_custkey AS id, c_nationkey AS nationkey, round(c_acctbal, 6) + 0.0 AS acctbal, c_mktsegment AS segment, 'customer' AS source FROM customer
  UNION ALL SELECT s_suppkey, s_nationkey, round(s_acctbal, 6) + 0.0, NULL, 'supplier' FROM supplier""")
def s14_union_network_tables(spark, sf):
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nationkey"),
                                                    F.col("c_acctbal").alias("acctbal"), F.col("c_mktsegment").alias("segment"))
    suppliers = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("nationkey"),
                                                    F.col("s_acctbal").alias("acctbal"))
    both = scans.union_sources({"customer": customers, "supplier": suppliers})
    return tidy(scans.only_networks(both, ["customer", "supplier"], "source"))


@query("o2_recent_n", """SELECT o_orderpriority, o_orderkey FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate DESC, o_orderkey DESC) <= 100""")
def o2_recent_n(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderpriority", "o_orderdate", "o_orderkey")
    return scans.recent_n(orders, ["o_orderpriority"], ["o_orderdate", "o_orderkey"]).select("o_orderpriority", "o_orderkey")


@query("o3_write_sorted", "SELECT event_id, event_type, ts FROM events")
def o3_write_sorted(spark, sf):
    path = scratch(spark, "sorted")
    scans.write_sorted(table(spark, sf, "events").select("event_id", "event_type", "ts"), path, ["event_type"], "ts")
    return tidy(spark.read.parquet(path))


@query("o4_union_sources", """SELECT 'rss' AS source, doc_id AS id, lang, NULL AS role FROM documents
  UNION ALL SELECT 'chat', conv_id, NULL, role FROM conversations""")
def o4_union_sources(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "lang")
    chat = table(spark, sf, "conversations").select(F.col("conv_id").alias("id"), "role")
    return scans.union_sources({"rss": docs, "chat": chat})


@query("s15_write_report", f"""{RISK_SQL}, cc AS (SELECT symbol, corr(open, close) AS oc FROM bars GROUP BY symbol)
  SELECT symbol, {r('var', 'sharpe', 'beta', 'oc AS corr_open_close')}, '2024-02-01T00:00:00' AS created_at FROM metrics JOIN cc USING (symbol)""")
def s15_write_report(spark, sf):
    b = bars(spark, sf)
    metrics = risk.risk_metrics(b, BARS, benchmark_returns(b))
    report = scans.risk_report(metrics, risk.correlation_matrix(b, COLUMNS, ["symbol"]), ["symbol"], "2024-02-01T00:00:00")
    path = scratch(spark, "report")
    scans.write_report(report, path)
    schema = ("symbol string, risk_metrics struct<var:double,sharpe:double,beta:double>, "
              "correlation_matrix map<string,map<string,double>>, created_at string")
    back = spark.read.schema(schema).json(path)
    return tidy(back.select("symbol", "risk_metrics.*", F.col("correlation_matrix")["open"]["close"].alias("corr_open_close"), "created_at"))

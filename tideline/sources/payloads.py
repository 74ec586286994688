"""Landed JSON and XML messages to typed rows (S6-S13). Stateless, so the same code runs on tables and streams."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.operators.quality import contains_any

FIELDS = ("open", "high", "low", "close", "volume")

# JSON paths of open, high, low, close, volume in each source's quote message.
# {symbol} is the traded symbol; $last stands for the last row of the message's series.
QUOTE_PATHS = {
    "rest": ("$.open", "$.high", "$.low", "$.close", "$.volume"),
    "CoinbasePro": ("$.open", "$.high", "$.low", "$.price", "$.last_size"),
    "FTX": ("$.data.open", "$.data.high", "$.data.low", "$.data.last", "$.data.volumeUsd24h"),
    "Bitfinex": ("$[1]", "$[3]", "$[4]", "$[7]", "$[8]"),
    "Alpaca": ("$.bars[0].o", "$.bars[0].h", "$.bars[0].l", "$.bars[0].c", "$.bars[0].v"),
    "SerumDEX": ("$.result.open", "$.result.high", "$.result.low", "$.result.last", "$.result.volume"),
    "Solana": ("$.result.value.data.open", "$.result.value.data.high", "$.result.value.data.low",
               "$.result.value.data.price", "$.result.value.data.volume"),
    "AlphaVantage": ("$['Time Series (Daily)'][0]['1. open']", "$['Time Series (Daily)'][0]['2. high']",
                     "$['Time Series (Daily)'][0]['3. low']", "$['Time Series (Daily)'][0]['4. close']",
                     "$['Time Series (Daily)'][0]['5. volume']"),
    "CoinGecko": ("$last.prices[1]", "$.high[1]", "$.low[1]", "$last.prices[1]", "$last.total_volumes[1]"),
    "Kraken": ("$last.result[1]", "$last.result[2]", "$last.result[3]", "$last.result[4]", "$last.result[6]"),
    "CoinMarketCap": ("$.data.{symbol}.quote.USD.open", "$.data.{symbol}.quote.USD.high", "$.data.{symbol}.quote.USD.low",
                      "$.data.{symbol}.quote.USD.price", "$.data.{symbol}.quote.USD.volume_24h"),
    "Nomics": ("$[0].open", "$[0].high", "$[0].low", "$[0].price", "$[0]['1d'].volume"),
    "DexScreener": ("$.pairs[0].open", "$.pairs[0].high", "$.pairs[0].low", "$.pairs[0].priceUsd", "$.pairs[0].volumeUsd24h"),
    "DexTools": ("$.pairs[0].open", "$.pairs[0].high", "$.pairs[0].low", "$.pairs[0].priceUsd", "$.pairs[0].volumeUsd24h"),
    "Messari": ("$.data.market_data.open", "$.data.market_data.high", "$.data.market_data.low",
                "$.data.market_data.price_usd", "$.data.market_data.volume_last_24_hours"),
    "TradingView": ("$.open", "$.high", "$.low", "$.price", "$.volume"),
    "CryptoCompare": ("$.USD.open", "$.USD.high", "$.USD.low", "$.USD.price", "$.USD.volume_24h"),
    "Binance": ("$.k.o", "$.k.h", "$.k.l", "$.k.c", "$.k.v"),
}


def _with_last_rows(df: DataFrame) -> DataFrame:
    """For sources whose quote is the last row of a series, cut the message down to that row."""
    payload = F.col("payload")

    def last(array: Column) -> Column:
        return F.element_at(F.filter(array, lambda row: F.lit(True)), -1)

    rows = "array<array<string>>"
    kraken = F.map_values(F.from_json(F.get_json_object(payload, "$.result"), f"map<string,{rows}>"))
    series = F.when(F.col("source") == "CoinGecko", F.create_map(
        F.lit("prices"), last(F.from_json(F.get_json_object(payload, "$.prices"), rows)),
        F.lit("total_volumes"), last(F.from_json(F.get_json_object(payload, "$.total_volumes"), rows)),
    )).when(F.col("source") == "Kraken", F.create_map(F.lit("result"), last(F.get(kraken, 0))))
    return df.withColumn("_last", F.to_json(series))


def parse_quotes(raw: DataFrame, symbol: str | Column = "BTC") -> DataFrame:
    """raw(source, payload, ...) plus open, high, low, close, volume and ``rejected``.

    ``symbol`` is what the messages are about: one name, or a column of ``raw`` if every message has its own.

    One CASE over the sources: a row is parsed with the constant paths of its own source only. A message of an unknown
    source, or one that lacks a field, is marked instead of dropped.
    """
    nothing = F.struct(*[F.lit(None).cast("double").alias(f) for f in FIELDS])
    quote = None
    for source, paths in QUOTE_PATHS.items():
        fields = []
        for field, path in zip(FIELDS, paths):
            place, path = ("_last", path.replace("$last", "$")) if path.startswith("$last") else ("payload", path)
            if "{symbol}" in path and isinstance(symbol, Column):
                before, after = path.split("{symbol}")
                text = F.call_function("get_json_object", F.col(place), F.concat(F.lit(before), symbol, F.lit(after)))
            else:
                text = F.get_json_object(place, path.replace("{symbol}", str(symbol)))
            fields.append(text.try_cast("double").alias(field))
        found = F.struct(*fields)
        quote = (F.when(F.col("source") == source, found) if quote is None
                 else quote.when(F.col("source") == source, found))
    # unrolled as a one-element array: a generator is evaluated once, however often its columns are used after it
    df = _with_last_rows(raw).select(*raw.columns, F.inline(F.array(quote.otherwise(nothing))))
    missing = F.lit(False)
    for field in FIELDS:
        missing = missing | F.col(field).isNull()
    return df.withColumn("rejected", missing)


def normalize_quotes(raw: DataFrame, symbol: str | Column = "BTC") -> DataFrame:
    return parse_quotes(raw, symbol).where(~F.col("rejected")).drop("payload", "rejected")


def quote_rejects(raw: DataFrame, symbol: str | Column = "BTC") -> DataFrame:
    return parse_quotes(raw, symbol).where("rejected").drop(*FIELDS, "rejected")


def explode_candles(raw: DataFrame, payload: str = "payload") -> DataFrame:
    """{"candles": [{open, high, low, close, volume, timestamp}]} to one row per candle."""
    schema = "candles array<struct<open:double,high:double,low:double,close:double,volume:double,timestamp:timestamp>>"
    keep = [c for c in raw.columns if c != payload]
    return raw.select(*keep, F.inline(F.from_json(payload, schema)["candles"]))


def explode_series_map(raw: DataFrame, payload: str = "payload", key: str = "Time Series (Daily)") -> DataFrame:
    """{"Time Series (..)": {time: {"1. open": "..", ...}}} to one typed row per time."""
    series = F.from_json(payload, f"struct<`{key}`:map<string,map<string,string>>>")[key]
    keep = [c for c in raw.columns if c != payload]
    exploded = raw.select(*keep, F.explode(series).alias("_time", "_values"))
    return exploded.select(*keep, F.to_timestamp("_time").alias("timestamp"), *[
        F.try_element_at("_values", F.lit(f"{i}. {f}")).try_cast("double").alias(f) for i, f in enumerate(FIELDS, 1)])


def explode_order_book(raw: DataFrame, payload: str = "payload") -> DataFrame:
    """{"bids": [[price, quantity]], "asks": [...]} to one row per level, best level first."""
    keep = [c for c in raw.columns if c != payload]
    book = F.from_json(payload, "bids array<array<double>>, asks array<array<double>>")
    sides = F.array(F.struct(F.lit("bid").alias("side"), book["bids"].alias("levels")),
                    F.struct(F.lit("ask").alias("side"), book["asks"].alias("levels")))
    return (raw.select(*keep, F.inline(sides))
            .select(*keep, "side", F.posexplode("levels").alias("level", "_row"))
            .select(*keep, "side", "level", F.get("_row", 0).alias("price"), F.get("_row", 1).alias("quantity")))


def normalize_articles(raw: DataFrame, keywords: Sequence[str] = ()) -> DataFrame:
    """Landed news messages raw(kind, payload, ...) to article rows, optionally filtered by keyword.

    kinds: rss (XML item), newsapi ({"articles": []}), gdelt and socket ([]), trends ({"default": ..}),
    fred ({"observations": []}).
    """
    article = "title:string,description:string,content:string,publishedAt:string"
    item = "title:string,content:string,seendate:string"
    keep = [c for c in raw.columns if c != "payload"]
    empty = {"title": None, "description": None, "content": None, "link": None, "published": None, "value": None}

    def rows(array: Column, **fields: str) -> Column:
        return F.transform(array, lambda e: F.struct(*[
            (e[fields[n]].cast("string") if n in fields else F.lit(None).cast("string")).alias(n) for n in empty]))

    payload = F.col("payload")
    rss = F.array(F.from_xml(payload, "title string, description string, link string, pubDate string"))
    news = F.from_json(payload, f"articles array<struct<{article}>>")["articles"]
    plain = F.from_json(payload, f"array<struct<{item}>>")
    days = F.from_json(F.get_json_object(payload, "$.default.trendingSearchesDays"),
                       "array<struct<date:string,formattedDate:string>>")
    fred = F.from_json(payload, "observations array<struct<date:string,value:string>>")["observations"]
    kind = F.col("kind")
    articles = (
        F.when(kind == "rss", rows(rss, title="title", description="description", link="link", published="pubDate"))
        .when(kind == "newsapi", rows(news, title="title", description="description", content="content",
                                      published="publishedAt"))
        .when(kind.isin("gdelt", "socket"), rows(plain, title="title", content="content", published="seendate"))
        .when(kind == "trends", rows(days, title="formattedDate", published="date"))
        .when(kind == "fred", rows(fred, published="date", value="value")))
    out = raw.select(*keep, F.inline(articles))
    if keywords:
        text = F.concat_ws(" ", "title", "description", "content")
        out = out.where(kind.isin("trends", "fred") | contains_any(text, keywords))
    return out


def normalize_posts(raw: DataFrame) -> DataFrame:
    """Social messages raw(kind, payload, ...) of four kinds to one schema."""
    payload, kind = F.col("payload"), F.col("kind")

    def at(path: str) -> Column:
        return F.get_json_object(payload, path)

    text = (F.when(kind == "twitter", at("$.text"))
            .when(kind == "reddit", F.concat_ws(" ", F.coalesce(at("$.title"), F.lit("")), F.coalesce(at("$.selftext"), F.lit(""))))
            .when(kind == "telegram", at("$.message")).when(kind == "discord", at("$.content")))
    created = (F.when(kind == "reddit", F.timestamp_seconds(at("$.created_utc").try_cast("double").cast("long")))
               .when(kind == "telegram", at("$.date").try_cast("timestamp"))
               .otherwise(at("$.created_at").try_cast("timestamp")))
    counters = {"likes": "$.like_count", "retweets": "$.retweet_count", "replies": "$.reply_count",
                "upvotes": "$.score", "comments": "$.num_comments"}
    return raw.select(
        *[c for c in raw.columns if c not in ("payload", "kind")], text.alias("text"), created.alias("created_at"),
        kind.alias("source"), F.coalesce(at("$.subreddit"), at("$.channel")).alias("channel"), at("$.author").alias("author"),
        *[at(path).try_cast("long").alias(name) for name, path in counters.items()])


def normalize_onchain(raw: DataFrame) -> DataFrame:
    """JSON-RPC envelopes; hex results as numbers; ``rejected`` where a required part is missing.

    Up to 31 hex digits (leading zeros apart) are exact; a longer number, or one of more than 38 decimal digits, leaves
    ``result_value`` NULL and sets ``overflow``.
    """
    keep = [c for c in raw.columns if c != "payload"]
    body = F.from_json("payload", "jsonrpc string, id long, result string")
    df = raw.select(*keep, body.alias("_b")).select(*keep, "_b.*")
    digits = F.when(F.rlike("result", F.lit("^0x[0-9A-Fa-f]+$")), F.regexp_replace(F.substring("result", 3, 1 << 30), "^0+(?=.)", ""))
    padded = F.lpad(digits, 45, "0")

    def limb(at: int) -> Column:
        return F.conv(F.substring(padded, at, 15), 16, 10).cast("decimal(38,0)")

    high, middle, low = limb(1), limb(16), limb(31)
    joined = (high * F.lit(Decimal(16 ** 15)) + middle) * F.lit(Decimal(16 ** 15)) + low
    hexadecimal = F.when(F.length(digits) <= 31, joined.cast("decimal(38,0)"))
    number = F.rlike("result", F.lit("^[+-]?[0-9]+$"))
    value = F.coalesce(hexadecimal, F.when(digits.isNull(), F.col("result").try_cast("decimal(38,0)")))
    return df.withColumns({
        "result_value": value,
        "overflow": F.coalesce(value.isNull() & (digits.isNotNull() | number), F.lit(False)),
        "rejected": F.col("jsonrpc").isNull() | F.col("id").isNull() | F.col("result").isNull()})


# The mining endpoints and the field each one answers with.
MINING_ENDPOINTS = ("hashrate", "difficulty", "block_reward", "orphaned_blocks")


def assemble_mining(raw: DataFrame, keys: Sequence[str] = ("network", "ts")) -> DataFrame:
    """One record per network and time from raw(network, ts, endpoint, payload); no answer gives NULL, none no row."""
    values = raw.withColumn("_value", F.call_function(
        "get_json_object", F.col("payload"), F.concat(F.lit("$."), F.col("endpoint"))).try_cast("double"))
    out = values.groupBy(*keys).agg(*[
        F.max(F.when(F.col("endpoint") == e, F.col("_value"))).alias(e) for e in MINING_ENDPOINTS])
    return out.where(F.coalesce(*MINING_ENDPOINTS).isNotNull())

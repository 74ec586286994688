"""Logical tables built from the given ones, in Spark and (for the checks) in SQL."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.operators.bars import ohlcv_bars
from tideline.series import SeriesSpec

TICKS = SeriesSpec(("symbol",), "ts", ("event_id",))
BARS = SeriesSpec(("symbol",), "ts")
DAILY = SeriesSpec(("supplier",), "ts")
LINES = SeriesSpec(("supplier",), "ts", ("order_id", "line"))
TRANSFERS = SeriesSpec(("network",), "ts", ("tx_id",))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as price ticks: the symbol is the event type, the size comes out of the JSON properties."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("symbol"), "ts", "event_id", F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("double").alias("volume"), "user_id")


def bars(spark: SparkSession, sf_dir: str, interval: str = "1 hour") -> DataFrame:
    return ohlcv_bars(ticks(spark, sf_dir), TICKS, interval)


def benchmark_returns(bars_df: DataFrame) -> DataFrame:
    """Return of the mean close over all symbols, per bar time.

    The summary has one row per bar time (time span / interval), so one ordered window over it is bounded; it is
    partitioned by a constant only because a window needs a key.
    """
    market = bars_df.groupBy("ts").agg(F.avg("close").alias("market"))
    spec = SeriesSpec(("_market",), "ts")
    market = market.withColumn("_market", F.lit("market"))
    return market.select("ts", (F.try_divide("market", spec.lag("market")) - 1).alias("benchmark_return"))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as unit-price ticks per supplier."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("supplier"), F.col("l_shipdate").alias("ts"), F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line"), (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.col("l_quantity").alias("volume"))


def transfers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders with their lines as on-chain transfers: network = priority, wallet = customer.

    fees = sum of price * tax, activity = sum of price * (1 - discount) * 0.9, gas used = sum of quantity,
    interactions = number of lines, close = the order's mean unit price, block time = mean discount.
    """
    item = table(spark, sf_dir, "lineitem")
    price = F.col("l_extendedprice")
    per_order = item.groupBy("l_orderkey").agg(
        F.sum(price * F.col("l_tax")).alias("fees"),
        F.sum(price * (1 - F.col("l_discount")) * 0.9).alias("walletActivity"),
        F.sum("l_quantity").alias("gasUsed"),
        F.count(F.lit(1)).cast("double").alias("smartContractInteractions"),
        F.avg(price / F.col("l_quantity")).alias("close"),
        F.avg("l_discount").alias("block_time"))
    orders = table(spark, sf_dir, "orders")
    return orders.join(per_order, orders.o_orderkey == per_order.l_orderkey, "left").select(
        F.col("o_orderpriority").alias("network"), F.col("o_custkey").alias("wallet_id"),
        F.col("o_orderdate").alias("ts"), F.col("o_orderkey").alias("tx_id"),
        F.col("o_totalprice").alias("transactionVolume"), "fees", "walletActivity", "gasUsed",
        "smartContractInteractions", "close", "block_time", F.col("o_orderstatus").alias("uniqueAddresses"))


# ---------------------------------------------------------------- SQL twins

TICKS_SQL = """ticks AS (
  SELECT event_type AS symbol, ts, event_id, value AS price,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS volume, user_id FROM events)"""

BARS_SQL = TICKS_SQL + """,
bars AS (
  SELECT symbol, date_trunc('hour', ts) AS ts, first(price ORDER BY ts, event_id) AS open, max(price) AS high,
         min(price) AS low, last(price ORDER BY ts, event_id) AS close, sum(volume) AS volume, count(price) AS trades
  FROM ticks GROUP BY symbol, date_trunc('hour', ticks.ts))"""

BENCHMARK_SQL = """market AS (SELECT ts, avg(close) AS market FROM bars GROUP BY ts),
bench AS (SELECT ts, market / lag(market) OVER (ORDER BY ts) - 1 AS benchmark_return FROM market)"""

LINES_SQL = """lines AS (
  SELECT l_suppkey AS supplier, l_shipdate AS ts, l_orderkey AS order_id, l_linenumber AS line,
         l_extendedprice / l_quantity AS price, l_quantity AS volume FROM lineitem)"""

TRANSFERS_SQL = """transfers AS (
  SELECT o_orderpriority AS network, o_custkey AS wallet_id, o_orderdate AS ts, o_orderkey AS tx_id,
         o_totalprice AS transactionVolume, fees, walletActivity, gasUsed, smartContractInteractions, close,
         block_time, o_orderstatus AS uniqueAddresses
  FROM orders LEFT JOIN (
    SELECT l_orderkey, sum(l_extendedprice * l_tax) AS fees,
           sum(l_extendedprice * (1 - l_discount) * 0.9) AS walletActivity, sum(l_quantity) AS gasUsed,
           CAST(count(*) AS DOUBLE) AS smartContractInteractions, avg(l_extendedprice / l_quantity) AS close,
           avg(l_discount) AS block_time
    FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey)"""


def tidy(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """The named columns, doubles rounded (no negative zero), timestamps without zone."""
    types = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for c in columns or df.columns:
        if isinstance(types[c], (T.DoubleType, T.FloatType)):
            out.append((F.round(F.col(c).cast("double"), digits) + F.lit(0.0)).alias(c))
        elif isinstance(types[c], (T.TimestampType, T.DateType)):
            out.append(F.col(c).cast("timestamp_ntz").alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def r(*columns: str, digits: int = 6) -> str:
    """SQL text rounding ``expr AS name`` or plain columns the way ``tidy`` does."""
    out = []
    for c in columns:
        expr, name = c.rsplit(" AS ", 1) if " AS " in c else (c, c)
        out.append(f"round(CAST({expr} AS DOUBLE), {digits}) + 0.0 AS {name}")
    return ", ".join(out)


def over(rows: int | str | None = None, key: str = "symbol", order: str = "ts") -> str:
    """SQL window text: last ``rows`` rows, 'all' so far, or no frame."""
    frame = {None: "", "all": " ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"}.get(rows)
    if frame is None:
        frame = f" ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW"
    return f"OVER (PARTITION BY {key} ORDER BY {order}{frame})"


def roll(agg: str, column: str, rows: int, key: str = "symbol", order: str = "ts") -> str:
    """SQL text of an aggregate over a full frame of ``rows`` values."""
    w = over(rows, key, order)
    return f"(CASE WHEN count({column}) {w} = {rows} THEN {agg}({column}) {w} END)"


def ewm_sql(name: str, source: str, outputs: dict[str, tuple[str, float]], keep: Iterable[str] = ("ts",)) -> str:
    """Recursive SQL for y = (1-a)*y' + a*x per symbol over ``source`` (which must not hold NULLs)."""
    keep = list(keep)
    first = ", ".join(f"{c} AS {o}" for o, (c, _) in outputs.items())
    step = ", ".join(f"(1 - CAST({a!r} AS DOUBLE)) * e.{o} + CAST({a!r} AS DOUBLE) * n.{c} AS {o}"
                     for o, (c, a) in outputs.items())
    return f"""{name}_n AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts) AS rn FROM {source}),
{name} AS (
  SELECT symbol, rn, {", ".join(keep)}, {first} FROM {name}_n WHERE rn = 1
  UNION ALL
  SELECT n.symbol, n.rn, {", ".join("n." + k for k in keep)}, {step}
  FROM {name} e JOIN {name}_n n ON n.symbol = e.symbol AND n.rn = e.rn + 1)"""

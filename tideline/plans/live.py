"""Streams replayed from the given tables in several batches, each checked against its batch twin's SQL."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.operators import models, risk
from tideline.plans.inputs import BARS_SQL, TICKS_SQL, bars, over, r, roll, table, ticks, tidy
from tideline.plans.ingest import QUOTES_SQL as RAW_SQL
from tideline.plans.ingest import raw_quotes, scratch
from tideline.plans.registry import query
from tideline.plans.social import POSTS_SQL, posts
from tideline.plans.tables import MARKET_SQL, QUOTES_SQL, TELEMETRY_SQL, telemetry
from tideline.sources import payloads
from tideline.staging import stage
from tideline.streaming import rolling, streams

# A replay lands its table in so many slices, one after the other.
SLICES = 4


def zoned(df: DataFrame, ts: str) -> DataFrame:
    """Watermarks need a zoned timestamp."""
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


def slices(df: DataFrame, ts: str | None, arrival=None) -> list[DataFrame]:
    """The table in parts of equal time spans of ``arrival`` (default: ``ts``), oldest first; without times, parts by hash."""
    kept = df.columns
    if ts is None:
        number = F.pmod(F.xxhash64(*kept), F.lit(SLICES))
    else:
        at = F.unix_micros(F.col(ts) if arrival is None else arrival)
        start, end = df.agg(F.min(at), F.max(at)).first()
        number = F.least(F.floor((at - F.lit(start)) / F.lit(float(max(1, end - start))) * SLICES), F.lit(SLICES - 1))
    numbered = stage(df.withColumn("_slice", number), "slices")
    return [numbered.where(F.col("_slice") == i).select(*kept) for i in range(SLICES)]


def land(spark: SparkSession, parts: list[DataFrame], start) -> None:
    """Append each part to a landing folder, as many files as it has partitions, and let the stream take it before the next."""
    path = scratch(spark, "landing")
    for part in parts:
        part.write.mode("append").parquet(path)
        start(spark.readStream.schema(part.schema).parquet(path)).awaitTermination()


@contextmanager
def few_partitions(spark: SparkSession):
    """State is kept per shuffle partition for good; a replay on few cores needs few of them."""
    width = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(min(int(width), spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", width)


def replay(spark: SparkSession, df: DataFrame, build, ts: str | None = None, closing: bool = True, arrival=None) -> DataFrame:
    """Run a stream over the slices of a table (by ``arrival``, default ``ts``) and read the sink.

    With ``closing`` a row far in the future follows, so that the watermark closes every open window.
    """
    out, checkpoint = scratch(spark, "sink"), scratch(spark, "checkpoint")
    with few_partitions(spark):
        parts = slices(df, ts, arrival)
        if ts and closing:
            parts.append(df.limit(1).withColumn(ts, F.lit("2100-01-01").cast("timestamp")))
        land(spark, parts, lambda stream: streams.write_stream(build(stream), out, checkpoint, availableNow=True))
    return spark.read.schema(build(df).schema).parquet(out)


LATE = "30 minutes"


@query("st1_quotes_stream", f"""WITH {RAW_SQL} SELECT event_id, source,
  {r("CASE WHEN source = 'CoinGecko' THEN close ELSE open END AS open", 'high', 'low', 'close', 'volume')} FROM q WHERE source <> 'Unknown'""")
def st1_quotes_stream(spark, sf):
    return tidy(replay(spark, raw_quotes(spark, sf), streams.quotes_stream), "event_id", "source", *payloads.FIELDS)


@query("st2_consensus_stream", f"""WITH {QUOTES_SQL} SELECT ts AS window_start, CAST(n_quotes AS INTEGER) AS n_quotes, valid,
  {r(*[f'CASE WHEN valid THEN c_{f} END AS {f}' for f in ('open', 'high', 'low', 'close')])} FROM g""")
def st2_consensus_stream(spark, sf):
    """Hourly bars of the event types as quotes of one instrument."""
    quotes = zoned(bars(spark, sf), "ts").withColumn("pair", F.lit("pair")).withColumnRenamed("symbol", "source")

    def build(stream):
        return streams.consensus_stream(stream, keys=["pair"], window="1 hour", watermark=LATE, base=1.2)

    return tidy(replay(spark, quotes, build, "ts").drop("pair"))


@query("st3_sentiment_stream", f"""WITH {POSTS_SQL} SELECT date_trunc('hour', created_at) AS window_start,
  date_trunc('hour', created_at) + INTERVAL 1 HOUR AS window_end, source, {r('avg(sentiment) AS avg_sentiment')}, count(sentiment) AS n_posts
  FROM posts GROUP BY ALL""")
def st3_sentiment_stream(spark, sf):
    p = zoned(posts(spark, sf).select("created_at", "source", "sentiment"), "created_at")
    return tidy(replay(spark, p, lambda s: streams.sentiment_stream(s, watermark=LATE), "created_at"))


@query("st4_score_stream")
def st4_score_stream(spark, sf):
    """Bars scored live by a forest fitted on the stored ones (tested equal to scoring them in batch)."""
    inputs = ["open", "high", "low", "volume"]
    b = zoned(bars(spark, sf), "ts")
    model = RandomForestRegressor(featuresCol="features", labelCol="close", numTrees=10, seed=7).fit(models.assemble(b, inputs))
    return tidy(replay(spark, b, lambda s: streams.score_stream(s, model, inputs)), "symbol", "ts", "day_of_week", "prediction")


@query("st4_score_stream_linear", f"""WITH {BARS_SQL}, f AS (SELECT regr_slope(close, open) AS b, regr_intercept(close, open) AS a FROM bars)
  SELECT symbol, ts, CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week, {r('a + b * open AS prediction')} FROM bars, f""")
def st4_score_stream_linear(spark, sf):
    """A line fitted on the stored bars, applied to the live ones."""
    b = zoned(bars(spark, sf), "ts")
    model = LinearRegression(featuresCol="features", labelCol="close", solver="normal").fit(models.assemble(b, ["open"]))
    return tidy(replay(spark, b, lambda s: streams.score_stream(s, model, ["open"])), "symbol", "ts", "day_of_week", "prediction")


@query("st5_dedup_stream", "SELECT DISTINCT ts AS ts, round(value, 6) + 0.0 AS price FROM events")
def st5_dedup_stream(spark, sf):
    """Every event arrives twice."""
    e = zoned(table(spark, sf, "events").select("ts", F.col("value").alias("price")), "ts")
    return tidy(replay(spark, e.unionByName(e), lambda s: streams.dedup_stream(s, ["ts", "price"], watermark=LATE), "ts", closing=False))


@query("st6_rolling_stream", f"""WITH {POSTS_SQL} SELECT event_id, source,
  {r(roll('avg', 'sentiment', 7, 'source', 'created_at, event_id') + ' AS sentiment_trend',
     roll('stddev_samp', 'sentiment', 7, 'source', 'created_at, event_id') + ' AS sentiment_volatility')} FROM posts""")
def st6_rolling_stream(spark, sf):
    """Slices overlap by some minutes, so rows arrive out of order within the delay."""
    p = zoned(posts(spark, sf).select("event_id", "source", "created_at", "sentiment", "retweets", "likes", "replies", "shares",
                                      "followers_count"), "created_at")
    jitter = F.make_interval(mins=(F.col("event_id") % 30).cast("int"))

    def build(stream):
        return rolling.rolling_stream(stream, ["source"], "created_at", rolling.post_metrics_frame, rolling.POST_FIELDS, look_back=7,
                                      order=["event_id"], delay="45 minutes")

    with rolling.keyed_state(spark):
        out = replay(spark, p, build, "created_at", arrival=F.col("created_at") + jitter)
    return tidy(out, "event_id", "source", "sentiment_trend", "sentiment_volatility")


@query("st7_alert_stream", f"""WITH {TELEMETRY_SQL} SELECT source, window_start, 'success_rate' AS metric, '<' AS op, CAST(80 AS DOUBLE) AS "limit",
  {r('success_rate AS value')} FROM hourly WHERE success_rate < 80""")
def st7_alert_stream(spark, sf):
    calls = zoned(telemetry(spark, sf), "ts")

    def build(stream):
        return streams.alert_stream(streams.telemetry_stream(stream, watermark=LATE), ["source", "window_start"], [risk.SUCCESS_THRESHOLD])

    return tidy(replay(spark, calls, build, "ts"))


@query("st8_telemetry_stream", f"WITH {TELEMETRY_SQL} SELECT source, window_start, n_calls, n_errors, n_fallbacks, {r('avg_response_time', 'success_rate', digits=8)} FROM hourly")
def st8_telemetry_stream(spark, sf):
    return tidy(replay(spark, zoned(telemetry(spark, sf), "ts"), lambda s: streams.telemetry_stream(s, watermark=LATE), "ts"), digits=8)


@query("st9_asof_stream", f"""WITH {MARKET_SQL}
  SELECT e.event_id, e.symbol, m.bar_ts AS m_bar_ts, {r('m.close AS m_close')}
  FROM ticks e ASOF LEFT JOIN mk m ON e.symbol = m.symbol AND e.ts >= m.bar_ts""")
def st9_asof_stream(spark, sf):
    """Ticks and hourly bars as two live streams, joined as they arrive."""
    left = zoned(ticks(spark, sf).select("symbol", "ts", "event_id"), "ts")
    right = zoned(bars(spark, sf), "ts").select("symbol", F.col("ts").alias("bar_ts"), "close")
    folders, schemas = [scratch(spark, "landing"), scratch(spark, "landing")], [left.schema, right.schema]
    out, checkpoint = scratch(spark, "sink"), scratch(spark, "checkpoint")
    last = F.lit("2100-01-01").cast("timestamp")
    rounds = [*zip(slices(left, "ts"), slices(right, "bar_ts")), (left.limit(1).withColumn("ts", last), right.limit(1).withColumn("bar_ts", last))]

    def build(a, b):
        return rolling.asof_stream(a, b, "ts", "bar_ts", ["symbol"], prefix="m_", delay=LATE)

    with rolling.keyed_state(spark), few_partitions(spark):
        for parts in rounds:
            for part, folder in zip(parts, folders):
                part.write.mode("append").parquet(folder)
            a, b = (spark.readStream.schema(schema).parquet(folder) for schema, folder in zip(schemas, folders))
            streams.write_stream(build(a, b), out, checkpoint, availableNow=True).awaitTermination()
    return tidy(spark.read.schema(build(left, right).schema).parquet(out), "event_id", "symbol", "m_bar_ts", "m_close")

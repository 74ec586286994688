"""Live versions of the batch operators on Structured Streaming (ST1-ST9).

Each takes a streaming frame and returns one (or starts a writer), and reuses the batch expressions, so a stream read
to its end equals the batch result. Late rows beyond the watermark are dropped by Spark; its progress reports count
them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.window import Window as W

from tideline.functions.expr import ratio
from tideline.operators import onchain, quality, risk, text
from tideline.series import SeriesSpec, over_chunks
from tideline.sources import payloads
from tideline.staging import remove_folder


def quotes_stream(raw: DataFrame, symbol: str = "BTC") -> DataFrame:
    """ST1: raw messages to quotes; stateless."""
    return payloads.normalize_quotes(raw, symbol)


def consensus_stream(quotes: DataFrame, ts: str = "ts", keys: Sequence[str] = ("symbol",), source: str = "source",
                     window: str = "1 minute", watermark: str = "1 minute", base: float = 0.01, min_fraction: float = 0.5,
                     fields: Sequence[str] = ("open", "high", "low", "close")) -> DataFrame:
    """ST2: one validated price per window.

    First the newest quote of every source in the window (combined map-side), then the few survivors, one per source,
    are compared as an array.
    """
    newest = quotes.withWatermark(ts, watermark).groupBy(F.window(ts, window).alias("window"), *keys, source).agg(
        F.max_by(F.struct(*fields), ts).alias("_q"))
    sides = newest.groupBy("window", *keys).agg(F.collect_list("_q").alias("_all"))
    sides = sides.withColumn("n_quotes", F.size("_all"))
    valid, values = F.lit(True), {}
    for f in fields:
        prices = F.col("_all").getField(f)
        n = F.size(prices).cast("double")
        mean = F.aggregate(prices, F.lit(0.0), lambda a, v: a + v) / n
        sides = sides.withColumn(f"_m_{f}", mean)
        m = F.col(f"_m_{f}")
        spread = F.sqrt(F.aggregate(prices, F.lit(0.0), lambda a, v: a + (v - m) * (v - m)) / n)
        sides = sides.withColumn(f"_l_{f}", base * (1 + spread))
        limit = F.col(f"_l_{f}")
        near = F.filter(prices, lambda v: F.abs(v - m) <= limit)
        weight = F.aggregate(near, F.lit(0.0), lambda a, v: a + 1 / (F.abs(v - m) + 1e-6))
        total = F.aggregate(near, F.lit(0.0), lambda a, v: a + v / (F.abs(v - m) + 1e-6))
        valid = valid & (F.size(near) > 0) & (F.size(near) >= n * min_fraction)
        values[f] = ratio(total, weight)
    return sides.select(F.col("window.start").alias("window_start"), *keys, "n_quotes", valid.alias("valid"),
                        *[F.when(valid, v).alias(f) for f, v in values.items()])


def sentiment_stream(posts: DataFrame, ts: str = "created_at", window: str = "1 hour", watermark: str = "10 minutes") -> DataFrame:
    """ST3: mean sentiment per window and source."""
    return text.tumbling_sentiment(posts.withWatermark(ts, watermark), ts, window)


def score_stream(rows: DataFrame, model, features: Sequence[str], ts: str = "ts") -> DataFrame:
    """ST4: check the schema, add date features, predict. Batch size is the source's ``maxOffsetsPerTrigger``."""
    from tideline.operators.models import predict

    checked = quality.validate_schema(rows, [*features, ts], allow_empty=True)
    return predict(quality.datetime_features(checked, ts), model, features)


def dedup_stream(rows: DataFrame, keys: Sequence[str], ts: str = "ts", watermark: str = "1 hour") -> DataFrame:
    """ST5: the first row per key within the watermark."""
    return rows.withWatermark(ts, watermark).dropDuplicatesWithinWatermark(list(keys))


def alert_stream(metrics: DataFrame, keys: Sequence[str], thresholds: Sequence[risk.Threshold] = risk.RISK_THRESHOLDS) -> DataFrame:
    """ST7: breached limits as rows; stateless."""
    return risk.threshold_alerts(metrics, keys, thresholds)


def telemetry_stream(calls: DataFrame, ts: str = "ts", window: str = "1 hour", watermark: str = "10 minutes") -> DataFrame:
    """ST8: response times and success rates per source and hour."""
    return onchain.source_telemetry(calls.withWatermark(ts, watermark), ts=ts, window=window)


class RollingStream:
    """ST6: rolling row windows over a stream, for use with ``foreachBatch``.

    Rows wait until the newest event time minus ``delay`` has passed them, so out-of-order rows are put in order before
    they are counted. Each batch joins the last rows of every key (the tail) with the rows that became ready and runs
    the batch operator in chunks, so a hot key is split inside the batch too. Tail, waiting rows and the watermark are
    written per batch id and read from the one before: repeating a batch after a failure gives the same files. State older
    than that is removed; late rows and results stay.
    """

    def __init__(self, path: str, spec: SeriesSpec, operator: Callable[[DataFrame, SeriesSpec], DataFrame], look_back: int,
                 delay: str = "1 hour", chunk_rows: int = 100_000):
        self.path, self.spec, self.operator = path, spec, operator
        self.look_back, self.delay, self.chunk_rows = look_back, delay, chunk_rows
        self.last = -1

    def _read(self, spark: SparkSession, name: str, batch: int, like: DataFrame) -> DataFrame:
        if batch < 0:
            return spark.createDataFrame([], like.schema)
        return spark.read.schema(like.schema).parquet(f"{self.path}/{name}/batch={batch}")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self._process(batch, batch_id, flush=False)

    def flush(self, spark: SparkSession, schema, batch_id: int) -> None:
        """Release the waiting rows at the end of a stream."""
        self._process(spark.createDataFrame([], schema), batch_id, flush=True)

    def _process(self, batch: DataFrame, batch_id: int, flush: bool) -> None:
        spark, spec = batch.sparkSession, self.spec
        clock = spark.createDataFrame([], "seen timestamp, released timestamp")
        before = self._read(spark, "clock", batch_id - 1, clock).first()
        waiting = self._read(spark, "waiting", batch_id - 1, batch).unionByName(batch)
        newest = waiting.agg(F.max(F.col(spec.ts).cast("timestamp"))).first()[0]
        seen = max([t for t in (newest, before and before["seen"]) if t], default=None)
        released = before["released"] if before else None
        at = F.col(spec.ts).cast("timestamp")
        limit = F.lit(seen) if flush else F.lit(seen) - F.expr(f"INTERVAL {self.delay}")
        not_late = F.lit(True) if released is None else at > F.lit(released)
        ready = waiting.where((at <= limit) & not_late)
        late = waiting.where((at <= limit) & ~not_late)
        tail = self._read(spark, "tail", batch_id - 1, batch)
        rows = tail.withColumn("_ready", F.lit(False)).unionByName(ready.withColumn("_ready", F.lit(True)))
        done = over_chunks(rows, spec, self.operator, halo=self.look_back, chunk_rows=self.chunk_rows)
        self._write(done.where("_ready").drop("_ready"), "out", batch_id)
        newest_first = W.partitionBy(*spec.keys).orderBy(*[F.col(c).desc() for c in spec.order])
        last = rows.drop("_ready").withColumn("_n", F.row_number().over(newest_first))
        self._write(last.where(F.col("_n") <= self.look_back).drop("_n"), "tail", batch_id)
        self._write(waiting.where(at > limit), "waiting", batch_id)
        self._write(late, "late", batch_id)
        passed = spark.range(1).select(F.lit(seen).cast("timestamp").alias("seen"), limit.cast("timestamp").alias("released"))
        self._write(passed, "clock", batch_id)
        for name in ("tail", "waiting", "clock"):  # a repeated batch reads the one before it, never an older one
            if batch_id >= 2:
                remove_folder(spark, f"{self.path}/{name}/batch={batch_id - 2}")
        self.last = batch_id

    def _write(self, df: DataFrame, name: str, batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.path}/{name}/batch={batch}")

    def results(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/out").drop("batch")


def write_stream(df: DataFrame, path: str, checkpoint: str, mode: str = "append", **trigger) -> StreamingQuery:
    """Append a stream to Parquet (exactly once through the file sink's log)."""
    return (df.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "60 seconds"})).start(path))

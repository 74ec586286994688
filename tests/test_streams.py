"""Late and out-of-order rows, and streams against their batch twins."""

import datetime as dt

from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tideline.operators import features, models
from tideline.series import SeriesSpec
from tideline.streaming import streams

START = dt.datetime(2024, 1, 1)
SCHEMA = "source string, ts timestamp, id long, sentiment double, retweets long, likes long, replies long, shares long, followers_count long"


def row(minute, source="a", id=None):
    i = minute if id is None else id
    return (source, START + dt.timedelta(minutes=minute), i, float(i % 5), 1, 2, 3, 4, 10)


def land(spark, path, *files):
    for rows in files:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)


def run(stream, tmp_path, name="out"):
    path = str(tmp_path / name)
    streams.write_stream(stream, path, str(tmp_path / f"{name}-state"), availableNow=True).awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def test_rolling_orders_late_rows_and_reports_too_late_ones(spark, tmp_path):
    minutes = [0, 1, 3, 2, 4, 30, 31, 29, 60, 33, 61, 5]  # 5 arrives 56 minutes late, the delay is 10
    files = [[row(m) for m in minutes[i:i + 3]] for i in range(0, 12, 3)]
    spec = SeriesSpec(("source",), "ts", ("id",))
    rolling = streams.RollingStream(str(tmp_path / "rolling"), spec, features.post_metrics, look_back=7, delay="10 minutes", chunk_rows=8)
    stream = land(spark, str(tmp_path / "in"), *files)
    writer = stream.writeStream.foreachBatch(rolling).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    writer.awaitTermination()
    rolling.flush(spark, stream.schema, 4)
    got = {r["id"]: r["sentiment_trend"] for r in rolling.results(spark).collect()}
    late = spark.read.parquet(str(tmp_path / "rolling" / "late"))
    assert {r["id"] for r in late.collect()} >= {5}
    kept = spark.createDataFrame([row(m) for m in minutes if m in got], SCHEMA)
    expected = {r["id"]: r["sentiment_trend"] for r in features.post_metrics(kept, spec).collect()}
    assert got == expected and len(got) + late.count() == len(minutes)


def test_rolling_batch_can_be_repeated(spark, tmp_path):
    spec = SeriesSpec(("source",), "ts", ("id",))
    rolling = streams.RollingStream(str(tmp_path / "r"), spec, features.post_metrics, look_back=7, delay="0 minutes")
    batch = spark.createDataFrame([row(m) for m in range(10)], SCHEMA)
    rolling(batch, 0)
    first = sorted(map(str, rolling.results(spark).collect()))
    rolling(batch, 0)
    assert sorted(map(str, rolling.results(spark).collect())) == first and len(first) == 10


def test_windows_drop_rows_behind_the_watermark(spark, tmp_path):
    stream = land(spark, str(tmp_path / "in"), [row(0), row(10)], [row(200)], [row(205)], [row(1, id=99)], [row(500)])
    got = run(streams.sentiment_stream(stream, ts="ts", watermark="10 minutes"), tmp_path).collect()
    assert {(r["window_start"].hour, r["n_posts"]) for r in got} == {(0, 2), (3, 2)}


def test_dedup(spark, tmp_path):
    rows = [row(m) for m in range(20)]
    stream = land(spark, str(tmp_path / "in"), rows, rows[:10], rows[5:])
    assert run(streams.dedup_stream(stream, ["ts", "id"], watermark="2 hours"), tmp_path).count() == 20


def test_scores_equal_batch(spark, tmp_path):
    rows = [row(m) for m in range(40)]
    batch = spark.createDataFrame(rows, SCHEMA)
    model = LinearRegression(featuresCol="features", labelCol="sentiment").fit(models.assemble(batch, ["id"]))
    live = run(streams.score_stream(land(spark, str(tmp_path / "in"), rows[:20], rows[20:]), model, ["id"]), tmp_path)
    expected = {r["id"]: r["prediction"] for r in model.transform(models.assemble(batch, ["id"])).collect()}
    assert {r["id"]: r["prediction"] for r in live.collect()} == expected


def test_consensus_uses_the_newest_quote_per_source(spark, tmp_path):
    base = [("p", s, START + dt.timedelta(seconds=t), c, c, c, c) for s, t, c in
            (("a", 1, 50.0), ("a", 30, 10.0), ("b", 20, 10.001), ("c", 25, 10.002))]
    end = [("p", "a", START + dt.timedelta(days=1), 1.0, 1.0, 1.0, 1.0)]
    schema = "symbol string, source string, ts timestamp, open double, high double, low double, close double"
    path = str(tmp_path / "in")
    for rows in (base, end):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    got = run(streams.consensus_stream(stream), tmp_path).where(F.col("n_quotes") == 3).first()
    assert got["valid"] and abs(got["close"] - 10.001) < 1e-4

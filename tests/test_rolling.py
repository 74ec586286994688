"""The rolling stream with keyed state: order, late rows, restarts, expiry, missing values."""

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tideline.operators import features
from tideline.series import SeriesSpec
from tideline.streaming import rolling, streams

START = dt.datetime(2024, 1, 1)
SCHEMA = "source string, ts timestamp, id long, sentiment double, retweets long, likes long, replies long, shares long, followers_count long"
SPEC = SeriesSpec(("source",), "ts", ("id",))


def row(minute, source="a", id=None, sentiment=None):
    i = minute if id is None else id
    return (source, START + dt.timedelta(minutes=minute), i, float(i % 5) if sentiment is None else sentiment, 1, 2, 3, 4, 10)


@pytest.fixture
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


class Live:
    """A landing folder, and a stream over it that can be started as often as wished."""

    def __init__(self, spark, folder, **settings):
        self.spark, self.folder, self.settings = spark, folder, {"look_back": 7, "order": ["id"], "delay": "10 minutes", **settings}

    def take(self, *files, schema=SCHEMA):
        """Land each file and run the stream over all that is new, as a query of its own on the same checkpoint."""
        for rows in files:
            self.spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{self.folder}/in")
            stream = self.spark.readStream.schema(schema).parquet(f"{self.folder}/in")
            done = rolling.rolling_stream(stream, ["source"], "ts", rolling.post_metrics_frame, rolling.POST_FIELDS, **self.settings)
            with rolling.keyed_state(self.spark):
                query = streams.write_stream(done, f"{self.folder}/out", f"{self.folder}/state", availableNow=True)
                query.awaitTermination()
            self.progress = query.recentProgress
        return self

    def results(self):
        return self.spark.read.parquet(f"{self.folder}/out")

    def trends(self):
        return {r["id"]: (r["sentiment_trend"], r["sentiment_volatility"]) for r in self.results().collect()}


def expected(spark, rows):
    out = features.post_metrics(spark.createDataFrame(rows, SCHEMA), SPEC).collect()
    return {r["id"]: (r["sentiment_trend"], r["sentiment_volatility"]) for r in out}


def close(found, wanted):
    assert set(found) == set(wanted)
    for i, values in wanted.items():
        for a, b in zip(found[i], values):
            assert (a is None) == (b is None) and (a is None or abs(a - b) < 1e-9), i


END = [row(100_000, source="end", id=-1)]


def test_rows_out_of_order_equal_the_batch(spark, tmp_path, few_partitions):
    files = [[row(0), row(3), row(1), row(2, "b", 102)], [row(9), row(4), row(7, "b", 107)], [row(6), row(8), row(14)], [row(11), row(12), row(5)]]
    live = Live(spark, str(tmp_path)).take(*files, END)
    close(live.trends(), expected(spark, [r for f in files for r in f]))
    got = live.results().where("id = 14").first()
    assert got["ts"] == START + dt.timedelta(minutes=14) and got["source"] == "a" and got["engagement_rate"] == 1.0 and got["likes"] == 2


def test_late_rows_are_dropped_and_counted(spark, tmp_path, few_partitions):
    rows = [row(m) for m in range(10)]
    live = Live(spark, str(tmp_path)).take(rows, [row(60)], [row(61)], [row(5, id=900), row(62)])
    assert sum(op["numRowsDroppedByWatermark"] for p in live.progress for op in p["stateOperators"]) == 1
    live.take(END)
    close(live.trends(), expected(spark, [*rows, row(60), row(61), row(62)]))


def test_a_stream_stopped_anywhere_goes_on(spark, tmp_path, few_partitions):
    """A batch that fails in the middle is repeated by the next query on the same checkpoint; nothing is lost or doubled."""
    rows = [row(m, source="ab"[m % 2]) for m in range(40)]
    live = Live(spark, str(tmp_path)).take(rows[:12])
    spark.createDataFrame(rows[12:24], SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in")

    def broken(frame: pd.DataFrame) -> pd.DataFrame:
        raise RuntimeError("lost in the middle")

    failing = rolling.rolling_stream(stream, ["source"], "ts", broken, rolling.POST_FIELDS, look_back=7, order=["id"], delay="10 minutes")
    with rolling.keyed_state(spark), pytest.raises(Exception, match="lost in the middle"):
        streams.write_stream(failing, f"{tmp_path}/out", f"{tmp_path}/state", availableNow=True).awaitTermination()
    live.take(rows[24:], END)
    close(live.trends(), expected(spark, rows))


def test_a_silent_key_is_forgotten(spark, tmp_path, few_partitions):
    first, second = [row(m) for m in range(10)], [row(m) for m in range(500, 510)]
    live = Live(spark, str(tmp_path), expire="60 minutes").take(first, [row(300, "b", 300)], [row(301, "b", 301)])
    assert live.progress[-1]["stateOperators"][0]["numRowsTotal"] < 20
    live.take(second, END)
    found = live.trends()
    close({i: v for i, v in found.items() if i < 20}, expected(spark, first))
    close({i: v for i, v in found.items() if i >= 500}, expected(spark, second))  # starts anew


def test_missing_values(spark, tmp_path, few_partitions):
    rows = [row(m) for m in range(20)]
    gaps = [(s, t, i, None if i == 9 else v, None if i == 12 else a, b, c, d, 0 if i == 3 else None if i == 5 else n) for s, t, i, v, a, b, c, d, n in rows]
    gaps.append((None, START + dt.timedelta(minutes=4), 77, 1.0, 1, 1, 1, 1, 4))
    live = Live(spark, str(tmp_path)).take(gaps[:11], gaps[11:], END)
    close(live.trends(), expected(spark, gaps))
    rates = {r["id"]: r["engagement_rate"] for r in live.results().collect()}
    assert rates[3] is None and rates[5] is None and rates[12] is None and rates[4] == 1.0 and rates[77] == 1.0
    assert live.results().where(F.col("source").isNull()).count() == 1


def test_the_setting_of_the_session_holds_again(spark):
    before = spark.conf.get(rolling.STORE[0])
    with rolling.keyed_state(spark):
        assert spark.conf.get(rolling.STORE[0]) == rolling.STORE[1]
    assert spark.conf.get(rolling.STORE[0]) == before


# ---------------------------------------------------------------- as-of join of two streams

LEFT, RIGHT = "k string, ts timestamp, id long", "k string, at timestamp, seq int, price double"


class Pair:
    """Two landing folders; each call lands rows on either side and runs the query over what is new."""

    def __init__(self, spark, folder, delay="10 minutes"):
        self.spark, self.folder, self.delay = spark, folder, delay

    def take(self, left=(), right=()):
        spark = self.spark
        for rows, schema, side in ((left, LEFT, "left"), (right, RIGHT, "right")):
            spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(f"{self.folder}/{side}")
        a, b = (spark.readStream.schema(schema).parquet(f"{self.folder}/{side}") for schema, side in ((LEFT, "left"), (RIGHT, "right")))
        done = rolling.asof_stream(a, b, "ts", "at", ["k"], prefix="m_", order=["seq"], delay=self.delay)
        with rolling.keyed_state(spark):
            query = streams.write_stream(done, f"{self.folder}/out", f"{self.folder}/state", availableNow=True)
            query.awaitTermination()
        self.progress = query.recentProgress
        return self

    def close(self):
        return self.take([("end", START + dt.timedelta(days=90), -1)], [("end", START + dt.timedelta(days=90), 0, 0.0)])

    def found(self):
        return {r["id"]: (r["m_price"], r["m_at"]) for r in self.spark.read.parquet(f"{self.folder}/out").collect()}


def minute(m):
    return START + dt.timedelta(minutes=m)


def test_asof_of_two_streams_equals_the_batch_join(spark, tmp_path, few_partitions):
    from tideline.operators.joins import asof_join

    left = [[("a", minute(5), 1), ("b", minute(3), 2), ("a", minute(0), 3)], [("a", minute(12), 4), ("a", minute(9), 5), (None, minute(11), 6)], [("a", minute(200), 7), ("b", minute(220), 8)]]
    right = [[("a", minute(5), 1, 1.0), ("a", minute(5), 2, 2.0), ("a", minute(2), 1, 3.0)], [("a", minute(11), 1, None), (None, minute(10), 1, 4.0)], [("c", minute(210), 1, 5.0)]]
    pair = Pair(spark, str(tmp_path))
    for a, b in zip(left, right):
        pair.take(a, b)
    pair.close()
    batch = asof_join(spark.createDataFrame(sum(left, []), LEFT), spark.createDataFrame(sum(right, []), RIGHT), "ts", "at", ["k"], ["seq"], prefix="m_")
    wanted = {r["id"]: (r["m_price"], r["m_at"]) for r in batch.collect()}
    wanted[6] = (4.0, minute(10))  # on streams a missing key is a key like others
    assert pair.found() == wanted and wanted[1] == (2.0, minute(5)) and wanted[3] == (None, None) and wanted[4] == (None, minute(11)) and wanted[7][1] == minute(11)


def test_a_late_market_row_is_dropped_and_never_joined(spark, tmp_path, few_partitions):
    pair = Pair(spark, str(tmp_path)).take([("a", minute(10), 1)], [("a", minute(5), 1, 1.0)])
    pair.take([("a", minute(100), 2)], [("a", minute(100), 1, 2.0)])  # both watermarks pass minute 10
    pair.take([("a", minute(102), 3)], [("a", minute(101), 1, 3.0)])
    pair.take([("a", minute(103), 4)], [("a", minute(7), 1, 9.0)])
    assert sum(op["numRowsDroppedByWatermark"] for p in pair.progress for op in p["stateOperators"]) == 1
    assert {i: p for i, (p, _) in pair.close().found().items()} == {1: 1.0, 2: 2.0, 3: 3.0, 4: 3.0}


def test_rows_wait_for_the_slower_stream(spark, tmp_path, few_partitions):
    """The left side runs ahead; its rows leave when the right side has caught up, and meet what came meanwhile."""
    pair = Pair(spark, str(tmp_path)).take([("a", minute(m), m) for m in (1, 50, 300)], [("a", minute(0), 1, 1.0)])
    pair.take([("a", minute(301), 301)], [("a", minute(40), 1, 2.0)])
    assert not set(pair.found()) & {50, 300, 301}
    pair.take([], [("a", minute(299), 1, 3.0)])
    assert {i: p for i, (p, _) in pair.close().found().items()} == {1: 1.0, 50: 2.0, 300: 3.0, 301: 3.0}


def test_waiting_rows_are_kept_in_frames():
    """A batch of many rows is a few entries of state, and leaves it in order with missing values kept."""
    from pyspark.sql import types as T

    class Kept(list):
        def get(self):
            return iter(list(self))

        def appendList(self, rows):
            self.extend(rows)

        def put(self, rows):
            self[:] = rows

        def exists(self):
            return bool(self)

    class Single(Kept):
        def get(self):
            return self[0]

        def update(self, value):
            self[:] = [value]

    class Handle:
        timers = []

        def getListState(self, name, schema):
            return Kept()

        def getValueState(self, name, schema):
            return Single()

        def registerTimer(self, at):
            self.timers.append(at)

        def deleteTimer(self, at):
            self.timers.remove(at)

    class Values:
        def getCurrentWatermarkInMs(self):
            return 30

    processor = rolling.AsofRows([rolling._AT, rolling._SIDE, "n", "m_v"], [T.LongType(), T.IntegerType(), T.LongType(), T.StringType()], [rolling._AT, rolling._SIDE], ["m_v"], ["k"])
    processor.init(Handle())
    frame = pd.DataFrame({rolling._AT: [i * 1000 % 50_000 + 1 for i in range(50_000)], rolling._SIDE: [i % 2 for i in range(50_000)], "n": range(50_000),
                          "m_v": [None if i % 4 else str(i % 50) for i in range(50_000)]})
    list(processor.handleInputRows(("a",), iter([frame[:30_000], frame[30_000:]]), None))
    assert len(processor.waiting) <= 4 and processor.handle.timers == [1]
    out = pd.concat(list(processor.handleExpiredTimer(("a",), Values(), None)))
    assert len(out) == 15_000 and set(out["k"]) == {"a"} and out[rolling._AT].is_monotonic_increasing
    # odd milliseconds hold left rows, the even ones before them right rows, the last of them with a value in every other one
    expected = [None if (at // 1000 + 1) % 4 else str(at // 1000 - 1) for at in out[rolling._AT]]
    assert [None if pd.isna(v) else v for v in out["m_v"]] == expected
    assert len(processor.waiting) <= 2 and processor.handle.timers[-1] == 31


def test_rows_of_a_key_cross_as_columns(spark, tmp_path, monkeypatch):
    """Many rows of a key are two calls, not a step each: one takes them in as they came, one lets them go in pieces of bounded size; gaps and the last rows are kept."""
    from pyspark.sql import types as T

    live = spark.readStream.schema(SCHEMA).parquet(str(tmp_path))
    plan = rolling.rolling_stream(live, ["source"], "ts", rolling.post_metrics_frame, rolling.POST_FIELDS, look_back=7, order=["id"])._jdf.queryExecution().analyzed().toString()
    assert "TransformWithState" not in plan and "FlatMapGroupsInPandasWithState" in plan

    class State:
        exists, get, passed, timeout = False, None, 0, None

        def getCurrentWatermarkMs(self):
            return self.passed

        def update(self, value):
            self.exists, self.get = True, value

        def remove(self):
            self.exists = False

        def setTimeoutTimestamp(self, at):
            assert at >= self.passed
            self.timeout = at

    monkeypatch.setattr(rolling, "_OUT_ROWS", 700)
    schema = T.StructType([T.StructField(c, T.DoubleType() if c == "sentiment" else T.LongType()) for c in
                           ("id", "sentiment", "retweets", "likes", "replies", "shares", "followers_count", rolling._AT)])
    out = T.StructType([*schema.fields, *rolling.POST_FIELDS, T.StructField("source", T.StringType())])
    rows = pd.DataFrame({"id": range(5000), "sentiment": [None if i % 900 == 3 else i % 13 for i in range(5000)], "retweets": 1, "likes": [None if i == 4000 else 2 for i in range(5000)], "replies": 3, "shares": 4,
                         "followers_count": 10, rolling._AT: [i // 2 * 1000 for i in range(5000)]})
    shuffled, state = rows.sample(frac=1, random_state=1), State()
    function = rolling.RollingRows(rolling.post_metrics_frame, schema, out, [rolling._AT, "id"], 7, 60_000, ["source"])
    assert list(function(("a",), iter([shuffled[:3000], shuffled[3000:]]), state)) == [] and state.timeout == 1
    state.passed = 2000
    first = list(function(("a",), iter([]), state))
    assert [len(f) for f in first] == [700] * 5 + [500] and state.timeout == 2000 and len(state.get[0]) < 100 * 1000
    state.passed = 2500
    found = pd.concat([*first, *function(("a",), iter([]), state)], ignore_index=True)
    wanted = rolling.post_metrics_frame(rows)
    assert found["id"].tolist() == rows["id"].tolist() and set(found["source"]) == {"a"} and found.columns.tolist() == out.names
    for c in ("engagement_rate", "sentiment_trend", "sentiment_volatility"):
        assert (found[c].isna() == wanted[c].isna()).all() and (found[c] - wanted[c]).abs().max() < 1e-9
    assert state.exists and state.timeout == 2499 + 60_000
    state.passed = 70_000
    assert list(function(("a",), iter([]), state)) == [] and not state.exists

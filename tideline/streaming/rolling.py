"""Rolling row windows and as-of joins on streams with keyed state and timers (ST6, ST9)."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

_AT = "micros_of_event"  # no leading underscore: Spark renames such columns on the way into the processor
_SIDE, _RIGHT = "side_of_join", 0
# Waiting rows are kept in frames of so many.
FRAMES = T.StructType([T.StructField("frame", T.BinaryType())])
_FRAME_ROWS = 20_000
# Rows that leave together are handed over so many at a time.
_OUT_ROWS = 50_000
# State in lists and timers needs this store.
STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in the store that ``asof_stream`` needs; the session's own setting holds again behind."""
    name, store = STORE
    before = spark.conf.get(name)
    spark.conf.set(name, store)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def milliseconds(spark: SparkSession, interval: str) -> int:
    """The length of an interval like '45 minutes'."""
    return spark.range(1).select(F.unix_millis(F.lit(0).cast("timestamp") + F.expr(f"INTERVAL {interval}"))).first()[0]


class InEventOrder(StatefulProcessor):
    """Rows of a key wait until the watermark has passed them, and are then released together in event order.

    State is the waiting rows, in frames as they came, and the time of the pending timer, which stands at the oldest waiting row. The work per row is that of
    columns: a row is written once, read once when it leaves, and looked at by its time otherwise.
    """

    def __init__(self, columns: Sequence[str], types: Sequence[T.DataType], order: Sequence[str]):
        self.columns, self.types, self.order = list(columns), list(types), list(order)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", FRAMES)
        self.timer = handle.getValueState("timer", T.StructType([T.StructField("at", T.LongType())]))

    def schema(self, *names: str) -> T.StructType:
        """The fields called ``names``, or all."""
        return T.StructType([T.StructField(c, t) for c, t in zip(self.columns, self.types) if not names or c in names])

    def rows_of(self, frame: pd.DataFrame, names: Sequence[str] = ()) -> list[tuple]:
        """Rows (the fields called ``names``, or all) as the state takes them: whole numbers as such, missing values as NULL."""
        columns = []
        for c, t in [(c, t) for c, t in zip(self.columns, self.types) if not names or c in names]:
            values = frame[c].astype(object).where(frame[c].notna(), None).tolist()
            whole = isinstance(t, (T.LongType, T.IntegerType, T.ShortType, T.ByteType))
            columns.append([int(v) if whole and v is not None else v for v in values])
        return list(zip(*columns))

    def frame_of(self, rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=self.columns)

    def framed(self, frame: pd.DataFrame) -> list[tuple]:
        """Rows as frames of bounded size, each the bytes of an Arrow stream."""
        out = []
        for start in range(0, len(frame), _FRAME_ROWS):
            part, sink = pa.Table.from_pandas(frame[self.columns].iloc[start:start + _FRAME_ROWS], preserve_index=False), pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, part.schema) as writer:
                writer.write_table(part)
            out.append((sink.getvalue().to_pybytes(),))
        return out

    def all_waiting(self) -> pd.DataFrame:
        frames = [pa.ipc.open_stream(r[0]).read_all().to_pandas() for r in self.waiting.get()]
        return pd.concat(frames, ignore_index=True) if frames else self.frame_of([])

    def release(self, key, ready: pd.DataFrame) -> Iterator[pd.DataFrame]:
        """What comes out for rows that nothing can precede any more."""
        raise NotImplementedError

    def rest(self, passed: int) -> int | None:
        """When to look at a key again that has no waiting row, in milliseconds of event time; state that is no longer needed may go."""
        return None

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        oldest = None
        for frame in rows:
            if len(frame):
                self.waiting.appendList(self.framed(frame))
                first = int(frame[_AT].min())
                oldest = first if oldest is None else min(oldest, first)
        # What the watermark has passed by now leaves with the next timer, after all rows of this batch are in the state. Rows that wait already have theirs.
        if oldest is not None:
            self._set_timer(oldest // 1000 + 1)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs()
        rows = self.all_waiting()
        at = rows[_AT].astype("int64")
        gone = at // 1000 < passed
        ready, left = rows[gone], rows[~gone]
        out = iter(())
        if len(ready):
            self.waiting.clear()
            if len(left):
                self.waiting.put(self.framed(left))
            # at once, not when Spark asks for the rows: what follows needs the state behind them
            out = iter(list(self.release(key, ready.sort_values(self.order, kind="stable", na_position="first", ignore_index=True))))
        self.timer.clear()
        following = int(at[~gone].min()) // 1000 + 1 if len(left) else self.rest(passed)
        if following is not None:
            self._set_timer(following)
        return out

    def _set_timer(self, at: int) -> None:
        """One timer per key: the earlier of the pending one and ``at``.

        A timer fires once the watermark has reached it, and only a later one may be set meanwhile (Spark removes the firing one afterwards).
        """
        pending = self.timer.get()[0] if self.timer.exists() else None
        if pending is not None and pending <= at:
            return
        if pending is not None:
            self.handle.deleteTimer(pending)
        self.handle.registerTimer(at)
        self.timer.update((at,))

    def close(self) -> None:
        pass


class RollingRows:
    """The function of a key for ``applyInPandasWithState``: rows wait until the watermark has passed them, and are then released together in event order, joined to the last ``look_back`` rows before them.

    State is the waiting rows and the last rows, each as the bytes of an Arrow table. Rows come and go as columns: what Spark does row by row around a ``StatefulProcessor`` took most of the time.
    A key without new rows for ``expire_ms`` loses its state.
    """

    STATE = T.StructType([T.StructField("waiting", T.BinaryType()), T.StructField("tail", T.BinaryType())])

    def __init__(self, operator: Callable[[pd.DataFrame], pd.DataFrame], schema: T.StructType, out: T.StructType, order: Sequence[str], look_back: int, expire_ms: int, keys: Sequence[str]):
        self.operator, self.names, self.order = operator, out.names, list(order)
        # frames hold times of the session's zone without naming it
        self.schema = pa.schema([f.with_type(pa.timestamp("us")) if pa.types.is_timestamp(f.type) else f for f in to_arrow_schema(schema)])
        self.look_back, self.expire_ms, self.keys = look_back, expire_ms, list(keys)

    def packed(self, table: pa.Table) -> bytes | None:
        if not table.num_rows:
            return None
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, self.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as writer:
            writer.write_table(table, max_chunksize=_FRAME_ROWS)
        return sink.getvalue().to_pybytes()

    def table(self, packed: bytes | None) -> pa.Table:
        return pa.ipc.open_stream(packed).read_all() if packed else self.schema.empty_table()

    def __call__(self, key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        names, passed = self.schema.names, state.getCurrentWatermarkMs()
        held, last = state.get if state.exists else (None, None)
        new = [pa.Table.from_pandas(f[names], schema=self.schema, preserve_index=False) for f in frames if len(f)]
        rows, tail = pa.concat_tables([self.table(held), *new]), self.table(last)
        del held, new
        # rows of this batch are later than the watermark and wait; those that wait may have been passed since
        gone = pa.array(rows[_AT].to_numpy() // 1000 < passed)
        left = rows.filter(pc.invert(gone))
        ready = rows.filter(gone) if left.num_rows else rows
        del rows
        ranks = pc.sort_indices(ready.select(self.order), sort_keys=[(c, "ascending") for c in self.order], null_placement="at_start")
        for start in range(0, len(ranks), _OUT_ROWS):
            joined = pa.concat_tables([tail, ready.take(ranks.slice(start, _OUT_ROWS))])
            yield self.operator(joined.to_pandas()).iloc[tail.num_rows:].assign(**dict(zip(self.keys, key)))[self.names]
            tail = joined.slice(max(0, joined.num_rows - self.look_back))
        if left.num_rows:
            following = pc.min(left[_AT]).as_py() // 1000
        elif tail.num_rows:
            following = tail[_AT][-1].as_py() // 1000 + self.expire_ms
        else:
            following = None
        # Spark asks for the state once all frames are taken
        if following is not None and following >= passed:
            # the key is looked at again once the watermark is past that time
            state.update((self.packed(left), self.packed(tail)))
            state.setTimeoutTimestamp(max(1, following))
        elif state.exists:
            state.remove()


class AsofRows(InEventOrder):
    """Two kinds of rows of a key: those of the right side are remembered, the last one only; those of the left side leave with it."""

    def __init__(self, columns: Sequence[str], types: Sequence[T.DataType], order: Sequence[str], right: Sequence[str], keys: Sequence[str]):
        super().__init__(columns, types, order)
        self.right, self.keys = list(right), list(keys)

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.last = handle.getValueState("last", self.schema(*self.right))

    def release(self, key, ready: pd.DataFrame) -> Iterator[pd.DataFrame]:
        is_right = (ready[_SIDE] == _RIGHT).to_numpy()
        newest = np.maximum.accumulate(np.where(is_right, np.arange(len(ready)), -1))
        last = tuple(self.last.get()) if self.last.exists() else (None,) * len(self.right)
        out = ready[~is_right].reset_index(drop=True)
        if len(out):
            before = newest[~is_right] < 0
            for c, old in zip(self.right, last):
                # the newest right row's value, missing ones too; before the first one that of the state
                taken = ready[c].to_numpy(dtype=object)[np.maximum(newest[~is_right], 0)]
                taken[before] = old
                out[c] = pd.Series(taken, dtype=object).where(pd.notna(taken), None).infer_objects()
        if is_right.any():
            self.last.update(self.rows_of(ready.iloc[[newest[-1]]], self.right)[0])
        if len(out):
            yield out.assign(**dict(zip(self.keys, key)))


def rolling_stream(rows: DataFrame, keys: Sequence[str], ts: str, operator: Callable[[pd.DataFrame], pd.DataFrame], added: Sequence[T.StructField],
                   look_back: int, order: Sequence[str] = (), delay: str = "1 hour", expire: str = "365 days") -> DataFrame:
    """ST6: all columns of ``rows`` plus those that ``operator`` adds to a frame of one key in event order.

    ``operator`` sees at most ``look_back`` rows before the new ones. Rows up to ``delay`` behind the newest event are put in order; later ones are dropped,
    and counted by Spark's progress reports. Rows of equal time follow ``order``. A key that is silent for ``expire`` is forgotten, and starts anew
    when it comes back. The query may be started inside ``keyed_state``; its state lives below its checkpoint, so a stream that is stopped anywhere goes on where it was. Missing
    numbers are NULL, NaN included. A row is released once the watermark is a millisecond past it.
    """
    spark = rows.sparkSession
    watched = rows.withWatermark(ts, delay).withColumn(_AT, F.unix_micros(ts))
    kept = T.StructType([T.StructField(f.name, f.dataType) for f in watched.schema.fields if f.name not in (ts, *keys)])
    out = T.StructType([*kept.fields, *added, *[T.StructField(k, rows.schema[k].dataType) for k in keys]])
    function = RollingRows(operator, kept, out, [_AT, *order], look_back, milliseconds(spark, expire), keys)

    def roll(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        return function(key, frames, state)

    done = watched.groupBy(*keys).applyInPandasWithState(roll, out, RollingRows.STATE, "append", GroupStateTimeout.EventTimeTimeout)
    return done.withColumn(ts, F.timestamp_micros(_AT)).select(*rows.columns, *[f.name for f in added])


def asof_stream(left: DataFrame, right: DataFrame, left_ts: str, right_ts: str, keys: Sequence[str], prefix: str = "right_", order: Sequence[str] = (),
                delay: str = "1 hour") -> DataFrame:
    """ST9: every row of the stream ``left`` with the newest row of the stream ``right`` of its key at or before its own time, NULLs if there is none.

    Both streams have watermarks; a row of the left one leaves once the slower of the two has passed it, so rows of either side may come ``delay`` late and
    in any order. Rows of the right side that come later than that are dropped and counted by Spark's progress reports, never joined to rows that come
    after. However old the last row of a key is, it is remembered: state is one row of the right side per key and the waiting rows. Of right rows at one time,
    the last by ``order`` counts. The query is started inside ``keyed_state``.
    """
    kept = [c for c in right.columns if c not in keys]
    renamed = {c: f"{prefix}{c}" for c in kept}
    values = [c for c in left.columns if c not in (*keys, left_ts)]
    at, side = "time_of_event", F.lit(_RIGHT)
    a = left.withColumn(at, F.col(left_ts)).withWatermark(at, delay).select(
        *keys, at, F.unix_micros(at).alias(_AT), F.lit(1 - _RIGHT).alias(_SIDE), *values,
        *[F.lit(None).cast("long" if c == right_ts else right.schema[c].dataType).alias(renamed[c]) for c in kept])
    b = right.withColumn(at, F.col(right_ts)).withWatermark(at, delay).select(
        *keys, at, F.unix_micros(at).alias(_AT), side.alias(_SIDE), *[F.lit(None).cast(left.schema[c].dataType).alias(c) for c in values],
        *[(F.unix_micros(c) if c == right_ts else F.col(c)).alias(renamed[c]) for c in kept])
    both = a.unionByName(b)
    inside = [f for f in both.schema.fields if f.name not in (at, *keys)]
    out = T.StructType([*[T.StructField(f.name, f.dataType) for f in inside], *[T.StructField(k, both.schema[k].dataType) for k in keys]])
    # at one time, right rows come first
    processor = AsofRows([f.name for f in inside], [f.dataType for f in inside], [_AT, _SIDE, *[renamed[c] for c in order]], [renamed[c] for c in kept], keys)
    done = both.groupBy(*keys).transformWithStateInPandas(processor, out, outputMode="Append", timeMode="EventTime")
    done = done.withColumn(left_ts, F.timestamp_micros(_AT)).withColumn(renamed[right_ts], F.timestamp_micros(renamed[right_ts]))
    return done.select(*left.columns, *renamed.values())


POST_FIELDS = tuple(T.StructField(c, T.DoubleType()) for c in ("engagement_rate", "sentiment_trend", "sentiment_volatility"))


def post_metrics_frame(frame: pd.DataFrame, window: int = 7) -> pd.DataFrame:
    """F4 on a frame in event order: engagement per follower, and mean and sample deviation of the last ``window`` sentiments."""
    counts = frame[["retweets", "likes", "replies", "shares", "followers_count"]].apply(pd.to_numeric).astype("float64")
    sentiment = pd.to_numeric(frame["sentiment"]).astype("float64")
    followers = counts.pop("followers_count")
    total = counts.sum(axis=1, skipna=False)
    return frame.assign(engagement_rate=(total / followers).where(followers != 0), sentiment_trend=sentiment.rolling(window).mean(),
                        sentiment_volatility=sentiment.rolling(window).std())

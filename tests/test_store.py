"""The bucketed store: every key once, and no exchange above its files."""

import datetime as dt

import pytest

from tideline.sources.store import KeyedStore

SCHEMA = "k string, at timestamp, v double"
T = dt.datetime(2024, 1, 1, 0, 0, 0, 123456)


def test_keys_are_stored_once(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path / "s"), ["k", "at"], buckets=4)
    store.append(spark.createDataFrame([("a", T, 1.0), ("a", T, 2.0), (None, T, 3.0), ("b", None, 4.0)], SCHEMA))
    near = T + dt.timedelta(microseconds=1)
    store.append(spark.createDataFrame([("a", T, 9.0), ("a", near, 5.0), (None, T, 9.0), (None, None, 6.0), ("b", None, 9.0), ("-", None, 7.0)], SCHEMA))
    store.append(spark.createDataFrame([], SCHEMA))
    found = sorted((str(r.k), str(r.at), r.v) for r in store.read().collect())
    assert len(found) == 6 and {v for _, _, v in found} == {2.0, 3.0, 4.0, 5.0, 6.0, 7.0}


def test_another_session_goes_on_with_the_files(spark, tmp_path):
    path = str(tmp_path / "s")
    KeyedStore(spark, path, ["k"], buckets=4).append(spark.createDataFrame([(c, T, 1.0) for c in "abcdef"], SCHEMA))
    spark.sql(f"DROP TABLE {KeyedStore(spark, path, ['k']).table}")  # what a new session does not know; the files stay
    later = KeyedStore(spark, path, ["k"], buckets=4)
    later.append(spark.createDataFrame([(c, T, 2.0) for c in "defgh"], SCHEMA))
    assert sorted(r.k for r in later.read().collect()) == list("abcdefgh")


@pytest.mark.parametrize("width", ["3", "8", "50"])
def test_the_stored_side_is_not_shuffled(spark, tmp_path, width):
    names = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": width}
    before = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    try:
        store = KeyedStore(spark, str(tmp_path / "s"), ["k"], buckets=8)
        rows = spark.range(500).selectExpr("string(id % 300) AS k", "timestamp_seconds(id) AS at", "double(id) AS v")
        store.append(rows)
        out = store.fresh(rows.where("v > 100"))
        assert out.count() == 0
        plan = out._jdf.queryExecution().executedPlan().toString().splitlines()
        join = next(i for i, line in enumerate(plan) if "SortMergeJoin" in line)
        depth = lambda line: len(line) - len(line.lstrip(" :+-"))
        scan = next(i for i, line in enumerate(plan) if i > join and "FileScan" in line and "Bucketed: true" in line)
        above, level = [], depth(plan[scan])
        for line in reversed(plan[join:scan]):
            if depth(line) < level:
                above.append(line)
                level = depth(line)
        assert not any("Exchange" in line for line in above) and "SortMergeJoin" in above[-1]
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tideline.session import build_session

    session = build_session("local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g", "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def bars_frame(spark, closes, symbol="a", volume=10.0):
    """One bar per hour with open = high = low = close."""
    rows = [(symbol, i, c, c, c, c, volume) for i, c in enumerate(closes)]
    return spark.createDataFrame(rows, "symbol string, ts long, open double, high double, low double, close double, volume double")


def column(df, name, order="ts"):
    return [r[name] for r in df.orderBy(order).collect()]

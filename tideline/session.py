"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC time, ANSI mode and adaptive execution.

    On a cluster leave ``master`` out and let spark-submit decide.
    """
    builder = SparkSession.builder.appName("tideline")
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Event times carry no zone in the source files; every operator reads them as UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark

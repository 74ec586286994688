"""Queries of this subpackage and the SQL each one is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLES: dict[str, str] = {}


def llm_query(name: str, sql: str | None = None):
    """Register ``function(spark, sf_dir)`` under ``name``."""

    def wrap(function):
        LLM_QUERIES[name] = function
        if sql is not None:
            LLM_ORACLES[name] = sql
        return function

    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

"""Reading and writing tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from tideline.operators.joins import anti_join_new, one_new_row


def load_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None, condition: str | None = None,
               source: str = "parquet", **options: str) -> DataFrame:
    """Scan with a column list and a WHERE text; both reach the scan. ``source`` may be any Spark format or jdbc."""
    df = spark.table(path) if source == "table" else spark.read.format(source).options(**options).load(path or None)
    df = df.where(condition) if condition else df
    return df.select(*columns) if columns else df


def map_chunks(df: DataFrame, function: Callable[[pd.DataFrame], pd.DataFrame | None], schema: str | T.StructType) -> DataFrame:
    """An opaque frame-to-frame function over chunks of rows.

    Chunk size is ``spark.sql.execution.arrow.maxRecordsPerBatch`` (10,000 by default). Empty and non-frame results are
    dropped. The function must not depend on where chunks end.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = function(batch)
            if isinstance(out, pd.DataFrame) and len(out):
                yield out

    return df.mapInPandas(run, schema)


_MODES = {"append": "append", "replace": "overwrite", "fail": "errorifexists"}


def save_table(df: DataFrame, path: str, if_exists: str = "append", types: Mapping[str, str] | None = None,
               partition_by: Sequence[str] = (), file_format: str = "parquet") -> None:
    """S3: write with mode append, replace or fail, after casting the columns in ``types``."""
    for name, kind in (types or {}).items():
        df = df.withColumn(name, F.col(name).cast(kind))
    df.write.mode(_MODES[if_exists]).partitionBy(*partition_by).format(file_format).save(path)


def append_dedup(new: DataFrame, path: str, keys: Sequence[str] = ("timestamp", "price"),
                 partition: str | None = None) -> None:
    """Append the rows whose key is not stored yet.

    With ``partition`` (a column of both sides) only the stored partitions that occur in ``new`` are read.
    """
    try:
        existing = new.sparkSession.read.parquet(path)
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error) and "UNABLE_TO_INFER_SCHEMA" not in str(error):
            raise
        existing = None
    if existing is None:
        fresh = one_new_row(new, list(keys))
    else:
        if partition:
            touched = new.select(partition).distinct()
            existing = existing.join(touched, partition, "left_semi")
        fresh = anti_join_new(new, existing, keys)
    fresh.write.mode("append").partitionBy(*([partition] if partition else [])).parquet(path)


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType, header: bool = True) -> DataFrame:
    """CSV with a declared schema (no inference pass)."""
    return spark.read.schema(schema).option("header", header).csv(path)


def union_sources(frames: Mapping[str, DataFrame], tag: str = "source") -> DataFrame:
    """Unlike tables under one schema, missing columns NULL, each row tagged with its table."""
    out = None
    for name, frame in frames.items():
        tagged = frame.withColumn(tag, F.lit(name))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    return out


def only_networks(df: DataFrame, networks: Iterable[str], column: str = "network") -> DataFrame:
    """The rows of some networks; prunes directories when the table is partitioned by network."""
    return df.where(F.col(column).isin(*networks))


def recent_n(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int = 100) -> DataFrame:
    """O2: the newest ``n`` rows per channel. Spark limits each map task to n rows per channel before the shuffle."""
    newest = W.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("_n", F.row_number().over(newest)).where(F.col("_n") <= n).drop("_n")


def write_sorted(df: DataFrame, path: str, keys: Sequence[str], ts: str) -> None:
    """O3: files clustered by key and time range and sorted inside, so that min/max statistics prune."""
    df.repartitionByRange(*keys, ts).sortWithinPartitions(*keys, ts).write.mode("append").parquet(path)


def risk_report(metrics: DataFrame, correlations: DataFrame, keys: Sequence[str], created) -> DataFrame:
    """One row per series: metrics, correlation matrix as nested maps, creation time.

    The maps hold one entry per pair of columns, a number fixed by the schema.
    """
    keys = list(keys)
    names = [c for c in metrics.columns if c not in keys]
    rows = correlations.groupBy(*keys, "x").agg(F.map_from_entries(F.collect_list(F.struct("y", "corr"))).alias("_m"))
    matrix = rows.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("x", "_m"))).alias("correlation_matrix"))
    report = metrics.select(*keys, F.struct(*names).alias("risk_metrics")).join(matrix, keys, "left")
    return report.withColumn("created_at", F.lit(created))


def write_report(report: DataFrame, path: str) -> None:
    report.write.mode("overwrite").json(path)

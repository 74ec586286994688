"""Tables written between stages."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def staging_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; where that is unset and all runs on one machine, a folder below the warehouse.

    It is resolved by Spark's own file systems, so that executors and driver see the same files. On a cluster the setting is required, because the
    warehouse may be a folder of each machine's own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_staging"
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def stage(df: DataFrame, name: str = "stage", **options: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and read it back.

    Cuts the lineage, pins values that would otherwise be recomputed (partition ids, fitted values)
    and keeps column pruning and filter pushdown for the readers that follow. ``options`` are the writer's.
    """
    spark = df.sparkSession
    path = f"{staging_root(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_folder(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def unstage(df: DataFrame) -> None:
    """Remove a table that ``stage`` wrote, once nothing reads it any more."""
    spark = df.sparkSession
    folder = f"/{spark.sparkContext.applicationId}/"
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if folder in path:
            remove_folder(spark, path)

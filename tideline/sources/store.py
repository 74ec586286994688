"""A growing table without repeated keys (S4): appending never shuffles what is stored."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions.expr import key_text
from tideline.operators.joins import one_new_row

_KEY = "_key"


class KeyedStore:
    """Rows at ``path``, one per key, in a fixed number of buckets by key.

    The key of a row is also stored as one text, NULLs included, and the files are bucketed and sorted by it. An append deals only the new rows into
    the buckets; each task then joins them to the files of its own bucket. The catalog entry is made from the path in every
    session, so the store needs no metastore: the bucket of a file stands in its name. Choose ``buckets`` so that a bucket of the store at its
    largest fits into a task; it stays as it was first written.

    An append that fails halfway leaves no rows (Spark commits the files of a job together); two appends at one time may store a key twice.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], buckets: int = 64):
        self.spark, self.path, self.keys, self.buckets = spark, path, list(keys), buckets
        self.table = "store_" + hashlib.md5(path.encode()).hexdigest()

    def _declare(self, like: DataFrame) -> None:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in like.schema.fields)
        location = self.path.replace("'", "\\'")
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.table} ({columns}) USING parquet CLUSTERED BY ({_KEY}) SORTED BY ({_KEY}) INTO {self.buckets} BUCKETS LOCATION '{location}'")

    def fresh(self, new: DataFrame) -> DataFrame:
        """The rows of ``new`` whose key is not stored yet, one per key, with the key's text."""
        keyed = one_new_row(new, self.keys).withColumn(_KEY, key_text(*self.keys))
        self._declare(keyed)
        return keyed.join(self.spark.table(self.table).select(_KEY), _KEY, "left_anti").select(*new.columns, _KEY)

    def append(self, new: DataFrame) -> None:
        out = self.fresh(new)
        out.write.format("parquet").mode("append").bucketBy(self.buckets, _KEY).sortBy(_KEY).option("path", self.path).saveAsTable(self.table)

    def read(self) -> DataFrame:
        """All stored rows; the store must have been appended to in this session."""
        return self.spark.table(self.table).drop(_KEY)

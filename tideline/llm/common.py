"""Column and table helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.staging import stage, staging_root

# A word is a run of characters other than space and the ASCII controls 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"
# Private-use characters that mark span borders while a text is taken apart.
MARK, STAND_IN = "\ue000", "\ue001"


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def packed(docs: DataFrame) -> DataFrame:
    """All columns as one struct ``_doc``, so that no name of theirs can meet one of an operator's own."""
    return docs.select(F.struct(*[F.col(f"`{c}`").alias(c) for c in docs.columns]).alias("_doc"))


def unpacked(names: list[str], **changed: Column) -> list[Column]:
    """The columns of ``_doc`` called ``names``, some of them ``changed``."""
    return [changed.get(c, F.col("_doc").getField(c)).alias(c) for c in names]


def new_length(docs: DataFrame, text: Column, changed: Column) -> dict[str, Column]:
    """``n_chars`` of a packed row after its text has changed, if ``docs`` has that column."""
    if "n_chars" not in docs.columns:
        return {}
    length = F.length(text).cast(docs.schema["n_chars"].dataType)
    return {"n_chars": F.when(changed, length).otherwise(F.col("_doc").getField("n_chars"))}


def text_key(text: Column | str) -> Column:
    """A 64-bit key of a whole text; NULL and the empty text share one."""
    return F.xxhash64(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))


def find_spans(text: Column, pattern: str | Column) -> Column:
    """All leftmost non-overlapping matches of ``pattern``: array<struct<start, end, value>> in code points, end exclusive.

    Spark has no function for match positions. The matches are bracketed by a private-use character (one that stands in
    the text is first replaced by another of the same length), the text is split there, and the lengths are added up.
    """
    safe = F.when(F.contains(text, F.lit(MARK)), F.replace(text, F.lit(MARK), F.lit(STAND_IN))).otherwise(text)
    parts = F.split(F.regexp_replace(safe, pattern, f"{MARK}$0{MARK}"), MARK, -1)
    start = F.struct(F.lit(0).alias("at"), F.lit(False).alias("inside"),
                     F.expr("CAST(array() AS array<struct<start:int,end:int,value:string>>)").alias("found"))

    def step(acc: Column, part: Column) -> Column:
        end = acc["at"] + F.length(part)
        span = F.struct(acc["at"].alias("start"), end.alias("end"), part.alias("value"))
        return F.struct(end.alias("at"), (~acc["inside"]).alias("inside"),
                        F.when(acc["inside"], F.concat(acc["found"], F.array(span))).otherwise(acc["found"]).alias("found"))

    return F.aggregate(parts, start, step, lambda acc: acc["found"])


def broadcast_within(df: DataFrame, limit: int) -> DataFrame:
    """A stored ``df`` with a broadcast hint if its rows take at most ``limit`` bytes; else as it is, to be shuffled."""
    return F.broadcast(df) if stored_bytes(df) <= limit else df


def stored_bytes(df: DataFrame) -> int:
    """Bytes of the rows of a staged table, by the length of their JSON form."""
    return df.select(F.length(F.to_json(F.struct(*df.columns))).alias("n")).agg(F.sum("n")).first()[0] or 0


def staged(df: DataFrame, name: str) -> DataFrame:
    return stage(df, name)


def small_batches(spark: SparkSession, rows: int = 500) -> None:
    """Arrow batches of few rows: texts may be long, and a batch is held in memory as a whole."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of at most ``rows`` rows for the jobs run inside, and the session's own setting again behind them."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def slabs(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """The rows of ``batches`` in tables of ``rows`` rows (the last one shorter), whatever the size of the batches."""
    held: list[pa.RecordBatch] = []
    number = 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, rows - number)
            held.append(part)
            number += part.num_rows
            batch = batch.slice(part.num_rows)
            if number == rows:
                yield pa.Table.from_batches(held).combine_chunks()
                held, number = [], 0
    if number:
        yield pa.Table.from_batches(held).combine_chunks()


def finite_vector(embedding: Column | str) -> Column:
    """Whether a vector is there, has components, and all of them are finite numbers. Never NULL."""
    vector = F.col(embedding) if isinstance(embedding, str) else embedding
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(sound, F.lit(False))


def main_length(vectors: DataFrame, name: str) -> int:
    """The number of components that most vectors have (the larger of two equally frequent ones); 0 without vectors."""
    sizes = vectors.groupBy(F.size(name).alias("n")).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), F.desc("n")).first()
    return sizes["n"] if sizes else 0


def matrix(table: pa.Table | pa.RecordBatch, name: str, width: int) -> np.ndarray:
    """An array column without NULLs, all of whose arrays have ``width`` entries, as rows of a numpy matrix."""
    column = table.column(name)
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def shared_folder(spark: SparkSession, name: str) -> str:
    """The full address of a new folder below the shared one, made; any process of the cluster can reach it by this address."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{staging_root(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}")
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.mkdirs(target)
    address = system.makeQualified(target).toString()
    return address.replace("file:/", "file:///", 1) if address.startswith("file:/") and not address.startswith("file:///") else address

"""SimHash near-duplicates by covering locality-sensitive hashing.

Bit i of a fingerprint is given a vector m(i) of r + 1 bits, r being the radius. Every non-zero vector a of r + 1 bits makes
a mask with the bits i for which <m(i), a> is odd, hence a table of masked fingerprints. Up to r differing bits span a space
of dimension r at most, so some a is orthogonal to all of them: its mask leaves those bits out and the pair collides there.
No pair within the radius can be missed, whatever the data. The vectors m(i) are dealt evenly, which gives every mask about
half of the bits.

NULL text and texts without words have fingerprint zero, which is linked like any other. Copies have equal fingerprints and
are one node. NULL ids never become a component's id (a component of such rows only has a NULL id); repeated rows get a row
each; an empty table gives an empty result; further columns have no influence.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.buckets import forest, grouped_buckets, over_groups
from tideline.llm.common import packed, small_batches, staged, unpacked
from tideline.llm.components import connected_components
from tideline.llm.registry import llm_query, table

RADIUS = 4
SHINGLE = 4
SEED = 42
BITS = 64
_ROWS = 1 << 16


def simhash(text: bytes | None, size: int = SHINGLE) -> int:
    """Fingerprint of a whole UTF-8 text, as a signed 64-bit number."""
    # On bytes, lower() changes A-Z only and split() cuts at the space and the controls 9 to 13 only.
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= size:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts[:len(words) - size + 1].tolist(), ends[size - 1:].tolist())]
    values = np.array(hashes, dtype=np.uint64)
    ones = np.zeros(BITS, dtype=np.int64)
    for i in range(0, len(values), _ROWS):  # a long text in blocks
        ones += np.unpackbits(values[i:i + _ROWS].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    set_bits = ones * 2 > len(values)
    return int(np.packbits(set_bits, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and ``fp`` (long) of every row. Stored."""
    small_batches(docs.sparkSession)
    source = docs.select(*keep, F.col(text).cast("binary").alias("_text"))
    schema = source.drop("_text").withColumn("fp", F.lit(0).cast("long")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = pa.array([simhash(t.as_py()) for t in batch.column(len(keep))], type=pa.int64())
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(keep))], fps], names=[*keep, "fp"])

    return staged(source.mapInArrow(run, schema), "fingerprints")


def covering_masks(radius: int = RADIUS, bits: int = BITS) -> list[int]:
    """The 2^(radius + 1) - 1 masks, as signed longs."""
    vectors = [i % (2 ** (radius + 1) - 1) + 1 for i in range(bits)]
    masks = []
    for a in range(1, 2 ** (radius + 1)):
        mask = sum(1 << i for i, m in enumerate(vectors) if (m & a).bit_count() % 2)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    return masks


def near_links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(u, v): links between distinct fingerprints ``fp`` within ``radius`` bits, a spanning forest of each bucket."""
    keys = F.array(*[F.col("id").bitwiseAND(F.lit(m)) for m in covering_masks(radius)])
    rows = fps.select(F.col("fp").alias("id")).select("id", F.posexplode(keys).alias("table", "key"))
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def compare(group: pa.Table, first: int) -> pa.RecordBatch | None:
        ids = group.column("id").to_numpy()
        whole = first == len(ids)
        right = ids if whole else ids[first:]
        near = np.bitwise_count((ids[:first, None] ^ right[None, :]).view(np.uint64)) <= radius
        a, b = np.nonzero(np.triu(near, 1) if whole else near)
        if not len(a):
            return None
        b = b if whole else b + first
        kept = forest(a, b, len(ids))
        return pa.RecordBatch.from_arrays([pa.array(ids[a[kept]]), pa.array(ids[b[kept]])], schema=schema)

    return grouped_buckets(rows).mapInArrow(over_groups(compare, schema), "u long, v long")


def near_duplicate_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", radius: int = RADIUS,
                          keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, ``keep``, fp, root, component_id) of every row: root names the group, component_id is the smallest id in it."""
    prints = fingerprints(docs, text, (doc_id, *keep))
    distinct = staged(prints.groupBy("fp").agg(F.min(doc_id).alias("_least")), "distinct-fingerprints")
    roots = connected_components(near_links(distinct, radius))
    of = staged(distinct.join(roots, F.col("fp") == F.col("node"), "left").select(
        F.col("fp").alias("_fp"), F.coalesce("root", "fp").alias("root"), "_least"), "roots")
    least = of.groupBy(F.col("root").alias("_root")).agg(F.min("_least").alias("component_id"))
    named = of.join(least, F.col("root") == F.col("_root")).select("_fp", "root", "component_id")
    return prints.join(named, F.col("fp") == F.col("_fp")).select(doc_id, *keep, "fp", "root", "component_id")


def one_per_group(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", radius: int = RADIUS) -> DataFrame:
    """``docs``, all columns, with one row of each group: the one with the smallest id (a group without ids: any one).

    Of several rows with that id the one with the least hash of id and text stays; of rows equal in both, any one.
    """
    whole = F.col("_doc").getField(text)
    keyed = packed(docs).select("_doc", F.col("_doc").getField(doc_id).alias("_own"), F.xxhash64(F.col("_doc").getField(doc_id), F.coalesce(whole, F.lit(""))).alias("_row"))
    prints = keyed.select(whole.alias("text"), "_own", "_row")
    groups = near_duplicate_groups(prints, "text", "_own", radius, ("_row",)).where(F.col("_own").eqNullSafe(F.col("component_id")))
    keepers = groups.groupBy("root", F.col("_own").alias("_id")).agg(F.min("_row").alias("_stays")).select("_id", "_stays")
    same = (F.col("_row") == F.col("_stays")) & F.col("_own").eqNullSafe(F.col("_id"))
    return keyed.join(keepers, same, "left_semi").dropDuplicates(["_row", "_own"]).select(*unpacked(docs.columns))


@llm_query("op7_covering_simhash")
def op7_covering_simhash(spark, sf_dir):
    groups = near_duplicate_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")

"""Embedding near-duplicates by iterative quantisation and multi-index Hamming tables.

A rotation of the centred, principal-component projected vectors is learned on a bounded sample so that the signs of the
rotated components are balanced and close to the components (iterative quantisation). The signs are a binary code. The code
is cut into substrings, and vectors that agree in one substring meet in a table; there they are compared by code and then,
in double precision, by their original components. A pair is counted in the first table in which it meets.
The length of a substring follows the number of vectors (at least log2 of it less 8 bits), so buckets stay of one size. Longer
substrings agree more rarely, so further rotations are learned, each of which adds its tables, until ``RECALL`` of pairs made
to lie just at the threshold meet: the recall does not follow the number of vectors. Vectors with a common direction lie far apart once they are
centred, and their codes agree rarely; if ``MOST_TABLES`` tables do not reach the recall, shorter substrings are taken, whose larger
buckets cost comparisons instead of copies, and at last none, which compares all vectors, in blocks. So the recall is kept and the number of tables bounded;
what grows with such data is the work.

Exact copies are one class and are never compared. Vectors that are NULL, zero, of another length than most, or hold NULL
or non-finite components link with nothing (not with their copies either) and get 0 links and their own id; their id may be NULL.
Repeated ids are rows of their own that share an id; every input row gets one output row; an empty table gives an empty
result; further columns have no influence.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.buckets import forest, grouped_buckets, over_groups
from tideline.llm.common import batches_of, staged
from tideline.llm.components import connected_components
from tideline.llm.registry import llm_query, table

BITS = 64
PARTS = 8
# Lengths of substrings; 0 puts all vectors into one bucket.
WIDTHS = (32, 24, 16, 8, 4, 0)
# Every table is a copy of all vectors in the shuffle.
MOST_TABLES = 64
# The rotation is learned on at most this many vectors, those with the smallest hashes.
SAMPLE = 20_000
ROUNDS = 50
# Further rotations need not be as good as the first one.
MORE_SAMPLE, MORE_ROUNDS = 4096, 10
THRESHOLD = 0.95
# Rotations are added until this part of the probe pairs at the threshold meets in some table, of so many made from the sample.
RECALL = 0.985
PROBES = 4000
BLOCK = 1024


@dataclass(frozen=True)
class Quantiser:
    mean: np.ndarray
    projection: np.ndarray  # dimensions x bits

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        signs = (vectors - self.mean) @ self.projection >= 0
        return np.packbits(signs, axis=1, bitorder="little").view("<i8").ravel()


def fit_itq(sample: np.ndarray, bits: int = BITS, rounds: int = ROUNDS, seed: int = 7) -> Quantiser:
    """Principal components, then alternately the nearest codes and the rotation (by SVD) nearest to them.

    With fewer dimensions than bits, the remaining bits are signs along random directions.
    """
    unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    mean = unit.mean(axis=0)
    centred = unit - mean
    dims = centred.shape[1]
    kept = min(bits, dims)
    values, vectors = np.linalg.eigh(centred.T @ centred / max(1, len(centred)))
    components = vectors[:, np.argsort(values)[::-1][:kept]]
    projected = centred @ components
    rng = np.random.default_rng(seed)
    rotation = np.linalg.qr(rng.standard_normal((kept, kept)))[0]
    for _ in range(rounds):
        signs = np.where(projected @ rotation >= 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(signs.T @ projected)
        rotation = (left @ right).T
    learned = components @ rotation
    extra = rng.standard_normal((dims, bits - kept)) if bits > kept else np.zeros((dims, 0))
    return Quantiser(mean, np.hstack([learned, extra]))


def table_masks(vectors: int, bits: int = BITS, parts: int = PARTS) -> list[int]:
    """Masks of the disjoint substrings of k parts, so long that a bucket holds about 2 ** (bits / parts) vectors at most; half of the parts at most."""
    width = bits // parts
    k = min(parts // 2, max(1, math.ceil(math.log2(max(2, vectors)) / width - 1)))
    masks = [((1 << width * k) - 1) << (width * k * i) for i in range(parts // k)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def probe_pairs(sample: np.ndarray, threshold: float, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors of the sample, and for each one at a random place where the product with it is ``threshold``.

    The place is found by turning what is left of a vector without the mean of all, so a direction that all vectors share stays: codes of
    centred vectors find such pairs hardest. Without a common direction these are random places at that cosine.
    """
    rng = np.random.default_rng(seed)
    unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    mean = unit.mean(axis=0)
    a = unit[rng.integers(len(unit), size=PROBES)]
    own = a - mean
    length = np.linalg.norm(own, axis=1, keepdims=True)
    along = own / np.maximum(length, 1e-300)
    w = rng.standard_normal(a.shape)
    shared = mean - (along @ mean)[:, None] * along  # the mean, as far as it is not along what is turned
    shared /= np.maximum(np.linalg.norm(shared, axis=1, keepdims=True), 1e-300)
    for direction in (along, shared) if a.shape[1] > 2 else (along,):
        w -= np.einsum("ij,ij->i", w, direction)[:, None] * direction
    w /= np.maximum(np.linalg.norm(w, axis=1, keepdims=True), 1e-300)
    turned = own @ mean
    cosine = np.clip((threshold - mean @ mean - turned) / np.maximum(turned + length.ravel() ** 2, 1e-300), -1.0, 1.0)[:, None]
    return a, mean + cosine * own + np.sqrt(1 - cosine ** 2) * length * w


def probe_sets(sample: np.ndarray, threshold: float, seed: int = 11) -> list[tuple[np.ndarray, np.ndarray]]:
    """Made pairs at the threshold, and pairs of the sample just above it, where there are at least 100; the recall must be reached on both."""
    some = sample[(np.arange(2000) + 1000 * seed) % len(sample)] if len(sample) > 2000 else sample
    unit = some / np.linalg.norm(some, axis=1, keepdims=True)
    a, b = np.nonzero(np.triu(np.abs(unit @ unit.T - threshold - 0.01) <= 0.01, 1))
    chosen = np.random.default_rng(seed).permutation(len(a))[:PROBES]
    real = [(unit[a[chosen]], unit[b[chosen]])] if len(a) >= 100 else []
    return [probe_pairs(sample, threshold, seed), *real]


def meeting(a: np.ndarray, b: np.ndarray, quantiser: Quantiser, masks: list[int]) -> np.ndarray:
    """Whether a[i] and b[i] agree under some mask."""
    apart = quantiser.codes(a) ^ quantiser.codes(b)
    return ((apart[:, None] & np.array(masks, dtype=np.int64)) == 0).any(axis=1)


def fit_quantisers(sample: np.ndarray, masks: list[int], threshold: float, most: int = MOST_TABLES, fitted: list[Quantiser] | None = None) -> list[Quantiser]:
    """Rotations from different starts, until ``RECALL`` of the probe pairs meet under the masks of one of them, or there would be more than ``most`` tables.

    ``fitted`` holds those known already, and gets the new ones.
    """
    fitted = [] if fitted is None else fitted
    if not fitted:
        fitted.append(fit_itq(sample))
    if sample.shape[1] < 2:  # along a line, vectors above the threshold have one direction, hence one code
        return fitted[:1]
    probes = probe_sets(sample, threshold)
    met = [meeting(a, b, fitted[0], masks) for a, b in probes]
    used = 1
    while min(m.mean() for m in met) < RECALL and (used + 1) * len(masks) <= most:
        if used == len(fitted):
            fitted.append(fit_itq(sample[:MORE_SAMPLE], rounds=MORE_ROUNDS, seed=7 + used))
        met = [m | meeting(a, b, fitted[used], masks) for m, (a, b) in zip(met, probes)]
        used += 1
    return fitted[:used]


def shorter_masks(width: int, bits: int = BITS) -> list[int]:
    """Masks of the disjoint substrings of ``width`` bits; one of no bits for 0."""
    masks = [((1 << width) - 1) << (width * i) for i in range(bits // width)] if width else [0]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def recall_of(quantisers: list[Quantiser], masks: list[int], sample: np.ndarray, threshold: float) -> float:
    """The part of probe pairs, others than those that the rotations were counted by, that meet in some table; the lesser of both sets."""
    found = []
    for a, b in probe_sets(sample, threshold, seed=13):
        met = np.zeros(len(a), dtype=bool)
        for q in quantisers:
            met |= meeting(a, b, q, masks)
        found.append(float(met.mean()))
    return min(found)


def fit_tables(sample: np.ndarray, number: int, threshold: float) -> tuple[list[Quantiser], list[int]]:
    """Rotations and masks for ``number`` vectors: the longest substrings with which the recall is reached."""
    masks, fitted = table_masks(number), []
    first = int(masks[0] & (2 ** 64 - 1)).bit_count()
    for width in [w for w in WIDTHS if w <= first]:
        masks = masks if width == first else shorter_masks(width)
        quantisers = fit_quantisers(sample, masks, threshold, fitted=fitted)
        if not width or sample.shape[1] < 2 or recall_of(quantisers, masks, sample, threshold) >= RECALL - 0.01:
            break
    return quantisers, masks


def vector_classes(vectors: DataFrame, vec_id: str, embedding: str) -> tuple[DataFrame, int]:
    """(id, vector, copies, least) per distinct usable vector, stored, and the number of dimensions.

    ``id`` is a 64-bit hash of the components.
    """
    usable = vectors.where(F.col(embedding).isNotNull() & (F.size(embedding) > 0)
                           & F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
                           & F.exists(embedding, lambda x: x != 0))
    plain = usable.select(F.transform(embedding, lambda x: x.cast("double") + F.lit(0.0)).alias("vector"), F.col(vec_id).alias("_id"))
    classes = staged(plain.groupBy("vector").agg(F.count(F.lit(1)).alias("copies"), F.min("_id").alias("least"))
                     .withColumn("id", F.xxhash64("vector")), "vector-classes")
    sizes = classes.groupBy(F.size("vector").alias("n")).agg(F.sum("copies").alias("rows")).orderBy(F.desc("rows"), F.desc("n")).first()
    dims = sizes["n"] if sizes else 0
    return classes.where(F.size("vector") == dims), dims


def class_links(classes: DataFrame, dims: int, threshold: float = THRESHOLD) -> DataFrame:
    """(id, other, links): partial link counts of classes (other NULL) and edges between classes (links NULL). Stored."""
    spark = classes.sparkSession
    sample = classes.orderBy("id").limit(SAMPLE).select("vector").toPandas()["vector"]
    number = classes.count()
    schema = pa.schema([("id", pa.int64()), ("other", pa.int64()), ("links", pa.int64())])
    if number < 2:
        return spark.createDataFrame([], "id long, other long, links long")
    vectors = np.stack(sample.to_numpy())
    quantisers, masks = fit_tables(np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1))[1][:, None]), number, threshold)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("vector").flatten().to_numpy().reshape(batch.num_rows, dims)
            # Powers of two scale without rounding: no square of a component can overflow or vanish.
            values = np.ldexp(values, -np.frexp(np.abs(values).max(axis=1))[1][:, None])
            unit = values / np.linalg.norm(values, axis=1, keepdims=True)
            codes = np.stack([q.codes(unit) for q in quantisers], axis=1)
            listed = pa.ListArray.from_arrays(pa.array(np.arange(len(codes) + 1, dtype=np.int32) * len(quantisers)), pa.array(codes.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("copies"), batch.column("vector"), listed],
                                             names=["id", "copies", "vector", "codes"])

    with batches_of(spark, 2048):
        coded = staged(classes.select("id", "copies", "vector").mapInArrow(encode, "id long, copies long, vector array<double>, codes array<long>"), "codes")
    tables = [(q, m) for q in range(len(quantisers)) for m in masks]
    keys = F.array(*[F.get("codes", F.lit(q)).bitwiseAND(F.lit(m)) for q, m in tables])
    rows = coded.select("id", "copies", "vector", "codes", F.posexplode(keys).alias("table", "key"))

    def compare(group: pa.Table, first: int) -> pa.RecordBatch | None:
        ids, copies = (group.column(k).to_numpy() for k in ("id", "copies"))
        codes = group.column("codes").combine_chunks().flatten().to_numpy().reshape(len(ids), len(quantisers))
        number = int(group.column("table")[0].as_py())
        whole = first == len(ids)
        skip = 0 if whole else first
        vectors = group.column("vector").combine_chunks().flatten().to_numpy().reshape(len(ids), dims)
        vectors = np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1))[1][:, None])
        unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        near = unit[:first] @ unit[skip:].T >= threshold - 1e-9  # then once more, pair by pair, in a fixed order of additions
        if whole:
            near = np.triu(near, 1)
        a, b = np.nonzero(near)
        b = b + skip
        for q, mask in tables[:number]:  # only pairs that met in no earlier table
            fresh = ((codes[a, q] ^ codes[b, q]) & np.int64(mask)) != 0
            a, b = a[fresh], b[fresh]
        linked = np.zeros(len(a), dtype=bool)
        for i in range(0, len(a), 65_536):
            linked[i:i + 65_536] = np.einsum("ij,ij->i", unit[a[i:i + 65_536]], unit[b[i:i + 65_536]]) >= threshold
        a, b = a[linked], b[linked]
        if not len(a):
            return None
        counts = np.zeros(len(ids), dtype=np.int64)
        np.add.at(counts, a, copies[b])
        np.add.at(counts, b, copies[a])
        seen = np.flatnonzero(counts)
        kept = forest(a, b, len(ids))
        return pa.RecordBatch.from_arrays([
            pa.array(np.concatenate([ids[seen], ids[a[kept]]])),
            pa.array(np.concatenate([np.zeros(len(seen), dtype=np.int64), ids[b[kept]]]), mask=np.arange(len(seen) + len(kept)) < len(seen)),
            pa.array(np.concatenate([counts[seen], np.zeros(len(kept), dtype=np.int64)]), mask=np.arange(len(seen) + len(kept)) >= len(seen)),
        ], schema=schema)

    with batches_of(spark, 2048):
        return staged(grouped_buckets(rows, BLOCK).mapInArrow(over_groups(compare, schema), "id long, other long, links long"), "vector-links")


def near_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", threshold: float = THRESHOLD) -> DataFrame:
    """(id, n_links, component_id, kept) of every row."""
    classes, dims = vector_classes(vectors, vec_id, embedding)
    found = class_links(classes, dims, threshold)
    roots = connected_components(found.where("other IS NOT NULL").select(F.col("id").alias("u"), F.col("other").alias("v")))
    counts = found.where("links IS NOT NULL").groupBy(F.col("id").alias("_of")).agg(F.sum("links").alias("_links"))
    of = staged(classes.select("id", "copies", "least").join(roots, F.col("id") == F.col("node"), "left")
                .join(counts, F.col("id") == F.col("_of"), "left")
                .select("id", "copies", "least", F.coalesce("root", "id").alias("root"), F.coalesce("_links", F.lit(0)).alias("_links")), "vector-roots")
    least = of.groupBy(F.col("root").alias("_root")).agg(F.min("least").alias("component_id"))
    named = of.join(least, F.col("root") == F.col("_root")).select(
        F.col("id").alias("_class"), (F.col("_links") + F.col("copies") - 1).alias("n_links"), "component_id")
    key = F.when(F.size(embedding) == dims, F.xxhash64(F.transform(embedding, lambda x: x.cast("double") + F.lit(0.0))))
    out = vectors.select(F.col(vec_id), key.alias("_key")).join(named, F.col("_key") == F.col("_class"), "left")
    component = F.when(F.col("_class").isNull(), F.col(vec_id)).otherwise(F.col("component_id"))
    return out.select(vec_id, F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"),
                      F.col(vec_id).eqNullSafe(component).alias("kept"))


@llm_query("op9_itq_embeddings")
def op9_itq_embeddings(spark, sf_dir):
    return near_vectors(table(spark, sf_dir, "embeddings"))

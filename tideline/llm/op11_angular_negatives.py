"""Hard negatives by angular triangle filtering.

Components become integers floor(256 * c), and a score is an integer inner product. Every row is stored with its norm and its angles
to a few reference directions (centres of a bounded sample). Angles obey the triangle inequality, so for two vectors and a reference r

    | angle(a, r) - angle(v, r) |  <=  angle(a, v)  <=  min(angle(a, r) + angle(v, r), 2 pi - angle(a, r) - angle(v, r)).

The cosines of the two ends, multiplied by the norms and widened by more than any rounding, bound the score. Rows are stored in the order of
(label, nearest reference, angle to it), and stretches of ``STRETCH`` of them are bounded together by the least and the largest angles and norms they
hold. An anchor asks for a window of scores; only stretches whose bounds overlap its window are scored, exactly, in integers.

Anchors are taken in blocks of bounded size (``BLOCK_BYTES``), each block against all rows in every pass:

1. positives: the best ``positives`` rows of the anchor's label; the window opens at the worst of those found so far;
2. negatives: per positive, the best rows of other labels from ``floor_share`` to 1 times the positive's score.

Before each of the two passes over all rows, one over the rows of one hash in ``SEED`` gives windows to start with, so that a task returns
few rows that cannot win; what it gives are true candidates, and nothing is left out. Tasks return their best few rows per anchor and window;
a ranking per window, bounded map-side too, keeps the best of all. No pair of rows becomes a row of a table, and no result depends on the order of rows.

Rows with a NULL label, a NULL or empty vector, or a NULL or non-finite component take no part. Rows that share an anchor's id are the anchor itself,
not its positives; each such row is an anchor of its own. A row with a NULL id is no anchor; as a positive or negative it stands behind equal scores
with ids. Only vectors of one length have a score; a vector of another length than most takes no part. A vector of zeros scores 0 with every other. Repeated rows
count as often as they stand in the table, equal ones side by side in the ranks. An anchor without positives, a positive without negatives in its window, and an empty table give no rows. Further
columns have no influence. Vectors so long that two of them could pass 64 bits (norms of 2 ** 31.5 in integers) raise an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tideline.llm.common import finite_vector, main_length, matrix, shared_folder, slabs, staged
from tideline.llm.registry import llm_query, table
from tideline.staging import unstage

SCALE = 256
REFERENCES = 16
# Centres are found on at most this many rows, those with the smallest hashes.
SAMPLE = 4096
ROUNDS = 8
STRETCH = 512
SLAB = 8192
SEED = 32
# What the anchors of a block may take in a task, vectors and best rows together.
BLOCK_BYTES = 48_000_000
# Stretches meet this many anchors at once: matrices of 4 million cells at most.
_ANCHORS = 4096
# Sums of integers below this bound are exact in doubles.
_EXACT = 2 ** 53
# Wider than any rounding: the arc cosine of a cosine that is off by 1e-15 is off by less than 1e-7.
_ANGLE_SLACK = 1e-6
_NOBODY = np.iinfo(np.int64).max
_LOWEST = np.iinfo(np.int64).min


@dataclass(frozen=True)
class Rules:
    positives: int = 5
    negatives: int = 5
    floor_share: tuple[int, int] = (80, 100)  # a negative has at least this part of the positive's score


# ---------------------------------------------------------------- bounds

def score_bounds(angles: np.ndarray, norms: np.ndarray, least: np.ndarray, largest: np.ndarray, short: float, long: float) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the scores of anchors (angles to the references, norms) with rows whose angles lie between ``least`` and ``largest``
    and whose norms lie between ``short`` and ``long``."""
    nearest = np.maximum(angles - largest, least - angles).max(axis=1) - _ANGLE_SLACK
    farthest = np.minimum(angles + largest, 2 * np.pi - angles - least).min(axis=1) + _ANGLE_SLACK
    high, low = np.cos(np.clip(nearest, 0, np.pi)), np.cos(np.clip(farthest, 0, np.pi))
    slack = 1e-9 * norms * long + 1
    return np.where(low < 0, low * long, low * short) * norms - slack, np.where(high > 0, high * long, high * short) * norms + slack


def exact_scores(rows: np.ndarray, anchors: np.ndarray, room: float) -> np.ndarray:
    """Integer inner products, rows x anchors; ``room`` bounds them. Doubles, where all sums are exact in them, else longs."""
    if room < _EXACT:
        return rows.astype(np.float64) @ anchors.astype(np.float64).T
    return rows @ anchors.T


class Best:
    """The best ``k`` (score, id) per query: high scores first, of equal ones small ids."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.scores = np.full((queries, k), _LOWEST, dtype=np.int64)
        self.ids = np.full((queries, k), _NOBODY, dtype=np.int64)

    @property
    def worst(self) -> np.ndarray:
        """The score that a row must reach to come in, by query."""
        return self.scores[:, -1]

    def offer(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        fits = score >= self.worst[query]
        query, score, ids = query[fits], score[fits], ids[fits]
        if not len(query):
            return
        touched = np.unique(query)
        all_query = np.concatenate([np.repeat(touched, self.k), query])
        all_score = np.concatenate([self.scores[touched].ravel(), score])
        all_ids = np.concatenate([self.ids[touched].ravel(), ids])
        order = np.lexsort((all_ids, -np.maximum(all_score, _LOWEST + 1), all_query))
        sorted_query = all_query[order]
        starts = np.searchsorted(sorted_query, touched)
        taken = order[starts[:, None] + np.arange(self.k)]
        self.scores[touched], self.ids[touched] = all_score[taken], all_ids[taken]

    def batch(self) -> pa.RecordBatch:
        query, at = np.nonzero(self.scores > _LOWEST)
        ids = self.ids[query, at]
        return pa.RecordBatch.from_arrays([pa.array(query.astype(np.int32)), pa.array(self.scores[query, at]), pa.array(ids, mask=ids == _NOBODY)],
                                          names=["query", "score", "id"])


# ---------------------------------------------------------------- stored rows

def reference_directions(sample: np.ndarray, number: int = REFERENCES, rounds: int = ROUNDS, seed: int = 5) -> np.ndarray:
    """Unit centres of the sample's directions (spherical k-means). Any directions give right results; near ones give narrow bounds."""
    norms = np.linalg.norm(sample, axis=1, keepdims=True)
    unit = (sample / np.where(norms > 0, norms, 1.0))[norms.ravel() > 0]
    rng = np.random.default_rng(seed)
    if not len(unit):
        return np.eye(number, sample.shape[1]) + np.eye(1, sample.shape[1])
    centres = unit[rng.choice(len(unit), size=number, replace=len(unit) < number)]
    for _ in range(rounds):
        home = (unit @ centres.T).argmax(axis=1)
        moved = np.zeros_like(centres)
        np.add.at(moved, home, unit)
        length = np.linalg.norm(moved, axis=1, keepdims=True)
        centres = np.where(length > 0, moved / np.where(length > 0, length, 1.0), centres)
    return centres


def with_angles(rows: DataFrame, dims: int, references: np.ndarray) -> DataFrame:
    """``rows`` (id, label, x) plus norm, angles to the references, and the number of the nearest one."""
    unit = references / np.linalg.norm(references, axis=1, keepdims=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch, "x", dims).astype(np.float64)
            norm = np.sqrt(np.einsum("ij,ij->i", x, x))
            cosine = (x @ unit.T) / np.where(norm > 0, norm, 1.0)[:, None]
            angles = np.arccos(np.clip(cosine, -1.0, 1.0))
            offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(unit))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), batch.column("x"), pa.array(norm),
                                              pa.ListArray.from_arrays(offsets, pa.array(angles.ravel())), pa.array(angles.argmin(axis=1).astype(np.int32))],
                                             names=["id", "label", "x", "norm", "angles", "home"])

    return rows.mapInArrow(run, "id long, label long, x array<long>, norm double, angles array<double>, home int")


def stored_rows(vectors: DataFrame, vec_id: str, embedding: str, label: Column) -> tuple[DataFrame, int]:
    """All rows that take part, in the order of (label, nearest reference, angle to it), and their number of dimensions.

    The order is by range, so a label or a direction that many rows have is spread over tasks. Written in two parts by ``seed``.
    """
    limit = F.lit(2.0 ** 31.5)

    def whole(c: Column) -> Column:
        c = c.cast("double")
        return F.when(F.abs(c) * SCALE < limit, F.floor(F.lit(float(SCALE)) * c)).otherwise(F.raise_error(F.lit("a vector is too long for 64-bit scores")).cast("long"))

    usable = vectors.where(finite_vector(embedding) & label.isNotNull()).select(
        F.col(vec_id).cast("long").alias("id"), label.cast("long").alias("label"), F.transform(F.col(embedding), whole).alias("x"))
    usable = staged(usable, "usable")
    dims = main_length(usable, "x")
    if not dims:
        return usable, 0
    usable = usable.where(F.size("x") == dims)
    too_long = F.aggregate("x", F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double")) >= F.lit(2.0 ** 63)
    if not usable.where(too_long).isEmpty():
        raise ValueError("a vector is too long for 64-bit scores")
    sample = usable.select("x", F.xxhash64("id", "x").alias("h")).orderBy("h").limit(SAMPLE).select("x").toPandas()["x"]
    angled = with_angles(usable, dims, reference_directions(np.stack(sample.to_numpy()).astype(np.float64)))
    angled = angled.withColumns({"_angle": F.get("angles", F.col("home")), "_h": F.xxhash64("id", "x"), "_row": F.monotonically_increasing_id(),
                                 "seed": F.pmod(F.xxhash64("id", "x", F.lit(3)), F.lit(SEED)) == 0})
    order = ["label", "home", "_angle", "_h", "_row"]
    placed = angled.repartitionByRange(*order).sortWithinPartitions("seed", *order).drop("_angle", "_h", "_row")
    folder = shared_folder(vectors.sparkSession, "angles")
    placed.write.mode("overwrite").partitionBy("seed").parquet(folder)
    unstage(usable)
    fields = "id long, label long, x array<long>, norm double, angles array<double>, home int, seed boolean"
    return vectors.sparkSession.read.schema(fields).parquet(folder), dims


# ---------------------------------------------------------------- one pass of a block over rows

@dataclass(frozen=True)
class Anchors:
    """A block of anchors."""

    ids: np.ndarray
    labels: np.ndarray
    x: np.ndarray
    norms: np.ndarray
    angles: np.ndarray

    def __len__(self) -> int:
        return len(self.ids)


def _stretches(slab: pa.Table) -> list[tuple[int, int]]:
    """Runs of one label and home, cut at ``STRETCH`` rows."""
    label, home = slab.column("label").to_numpy(), slab.column("home").to_numpy()
    change = np.flatnonzero((label[1:] != label[:-1]) | (home[1:] != home[:-1])) + 1
    out = []
    for a, b in zip(np.append(0, change), np.append(change, len(label))):
        out += [(i, min(i + STRETCH, b)) for i in range(a, b, STRETCH)]
    return out


def scan(rows: DataFrame, anchors: Anchors, low: np.ndarray, high: np.ndarray, same: bool, k: int) -> DataFrame:
    """(query, score, id): of every task, the best ``k`` rows in each window, rows of the anchor's label if ``same``, else of others.

    ``low`` and ``high`` are anchors x windows; query = anchor * windows + window. A window with low > high asks for nothing.
    """
    spark, dims, windows = rows.sparkSession, anchors.x.shape[1], low.shape[1]
    shared = spark.sparkContext.broadcast((anchors, low, high))  # at most BLOCK_BYTES, see blocks_of

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, opens, closes = shared.value
        best = Best(len(block) * windows, k)
        asked = opens <= closes
        longest = float(block.norms.max(initial=0.0))
        for slab in slabs(batches, SLAB):
            x, labels, norms = matrix(slab, "x", dims), slab.column("label").to_numpy(), slab.column("norm").to_numpy()
            angles = matrix(slab, "angles", block.angles.shape[1])
            ids = slab.column("id").combine_chunks().fill_null(_NOBODY).to_numpy()
            for a, b in _stretches(slab):
                label = labels[a]
                # the window as it stands now: nothing below the worst row that is still in
                floor = np.where(asked, np.maximum(opens, best.worst.reshape(opens.shape)), _NOBODY)
                lower, upper = score_bounds(block.angles, block.norms, angles[a:b].min(axis=0), angles[a:b].max(axis=0), norms[a:b].min(), norms[a:b].max())
                overlaps = (upper[:, None] >= floor) & (lower[:, None] <= closes) & asked
                wanted = np.flatnonzero(overlaps.any(axis=1) & ((block.labels == label) == same))
                for i in range(0, len(wanted), _ANCHORS):
                    some = wanted[i:i + _ANCHORS]
                    scores = exact_scores(x[a:b], block.x[some], 1.01 * float(norms[a:b].max()) * longest)
                    row, at = np.nonzero(scores >= floor[some].min(axis=1)[None, :])
                    if not len(row):
                        continue
                    found, anchor, row_ids = scores[row, at].astype(np.int64), some[at], ids[a:b][row]
                    if same:
                        other = row_ids != block.ids[anchor]
                        found, anchor, row_ids = found[other], anchor[other], row_ids[other]
                    for w in range(windows):
                        inside = (found >= floor[anchor, w]) & (found <= closes[anchor, w])
                        best.offer(anchor[inside] * windows + w, found[inside], row_ids[inside])
        yield best.batch()

    return rows.select("id", "label", "x", "norm", "angles", "home").mapInArrow(run, "query int, score long, id long")


def merged(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of every query over all tasks, with their rank from 1. Spark keeps ``k`` rows per query and task before it shuffles."""
    order = W.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _worst(found: DataFrame, queries: int, k: int) -> np.ndarray:
    """The k-th best score of each query of a block, or the lowest number where there are fewer."""
    out = np.full(queries, _LOWEST, dtype=np.int64)
    for r in merged(found, k).where(F.col("rank") == k).select("query", "score").toArrow().to_pylist():
        out[r["query"]] = r["score"]
    return out


def scan_all(rows: DataFrame, anchors: Anchors, low: np.ndarray, high: np.ndarray, same: bool, k: int) -> DataFrame:
    """``scan`` of the rows of the seed, which narrows the windows, then of all rows."""
    seeds = _worst(scan(rows.where("seed"), anchors, low, high, same, k), low.size, k).reshape(low.shape)
    return merged(scan(rows, anchors, np.maximum(low, seeds), high, same, k), k)


def blocks_of(anchors: DataFrame, size: int) -> Iterator[tuple[int, int]]:
    """Ranges of ``_pos`` with ``size`` anchors each; one number per task that wrote anchors is on the driver."""
    counts = anchors.groupBy(F.shiftright("_pos", 33).alias("part")).agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()
    start, left = 0, size
    for part, n in counts:
        at = 0
        while n - at >= left:
            at += left
            end = (part << 33) + at
            yield start, end
            start, left = end, size
        left -= n - at
    if left < size:
        yield start, 1 << 62


def load_block(anchors: DataFrame, start: int, end: int, dims: int, references: int) -> Anchors:
    block = anchors.where((F.col("_pos") >= start) & (F.col("_pos") < end)).select("id", "label", "x", "norm", "angles").toArrow().combine_chunks()
    return Anchors(block.column("id").to_numpy(), block.column("label").to_numpy(), matrix(block, "x", dims), block.column("norm").to_numpy(),
                   matrix(block, "angles", references))


def mine_negatives(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: Column | str = "label", every: int = 100,
                   rules: Rules = Rules(), block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score); anchors are the rows whose id is a multiple of ``every``."""
    spark: SparkSession = vectors.sparkSession
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    rows, dims = stored_rows(vectors, vec_id, embedding, F.col(label) if isinstance(label, str) else label)
    folder = f"{shared_folder(spark, 'hard-negatives')}/rows"
    spark.createDataFrame([], schema).write.parquet(folder)
    if dims:
        anchors = staged(rows.where(F.pmod("id", F.lit(every)) == 0).withColumn("_pos", F.monotonically_increasing_id()), "anchors")
        size = max(1, block_bytes // (8 * (dims + REFERENCES) + 16 * (rules.positives * rules.negatives + rules.positives + 4)))
        for start, end in blocks_of(anchors, size):
            block = load_block(anchors, start, end, dims, REFERENCES)
            open_end = np.full((len(block), 1), _LOWEST + 1, dtype=np.int64), np.full((len(block), 1), _NOBODY - 1, dtype=np.int64)
            positives = staged(scan_all(rows, block, *open_end, True, rules.positives), "positives")
            # a window per positive, in the order of their ranks
            high = np.full((len(block), rules.positives), _LOWEST, dtype=np.int64)
            low = np.full_like(high, _NOBODY - 1)
            part, whole = rules.floor_share
            for query, score, rank in zip(*(c.to_pylist() for c in positives.select("query", "score", "rank").toArrow().columns)):
                high[query, rank - 1], low[query, rank - 1] = score, -(-part * score // whole)
            negatives = scan_all(rows, block, low, high, False, rules.negatives)
            names = spark.createDataFrame(pa.table({"_anchor": np.arange(len(block), dtype=np.int32), "anchor_id": block.ids}))
            pairs = positives.select(F.col("query").alias("_anchor"), (F.col("query") * rules.positives + F.col("rank") - 1).alias("_window"),
                                     F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
            out = negatives.join(pairs, F.col("query") == F.col("_window")).join(names, "_anchor")
            out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score",
                       F.col("score").alias("negative_score")).write.mode("append").parquet(folder)
            unstage(positives)
    return spark.read.schema(schema).parquet(folder)


SQL = """WITH v AS (SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS DOUBLE)) AS x FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
a AS (SELECT * FROM v WHERE id % 100 = 0),
s AS (SELECT a.id AS anchor, v.id AS other, a.label = v.label AS same, CAST(list_dot_product(a.x, v.x) AS BIGINT) AS score FROM a JOIN v ON v.id IS DISTINCT FROM a.id),
p AS (SELECT anchor, other AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other NULLS LAST) <= 5),
n AS (SELECT p.anchor AS anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor, positive_id ORDER BY score DESC, other NULLS LAST) AS INTEGER) AS rank,
    other AS negative_id, positive_score, score AS negative_score
  FROM p JOIN s ON s.anchor = p.anchor AND NOT s.same AND 80 * positive_score <= 100 * score AND score <= positive_score)
SELECT * FROM n WHERE rank <= 5"""


@llm_query("op11_angular_negatives", SQL)
def op11_angular_negatives(spark, sf_dir):
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_negatives(table(spark, sf_dir, "embeddings"), label=moved)

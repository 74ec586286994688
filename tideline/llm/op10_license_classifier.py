"""Licence scan by a trained paragraph classifier.

A multinomial logistic regression over sparse word n-grams (one to three words) tells licence families and "none" apart. It
learns from windows cut out of the licence notices and from at most ``NEGATIVES`` corpus paragraphs without any trigram
of a notice. Its probabilities are calibrated by a temperature fitted on held-out rows, and a paragraph whose best family stays
below the threshold is unknown. A prediction must be confirmed by comparison with the notices: at least ``CONFIRM`` of the
paragraph's trigrams stand in notices of that family; otherwise the paragraph is reported as unknown.

A paragraph is a line. A line of more than ``LONG`` words is scored in overlapping windows of ``PIECE`` words, of which the best one stands for it: a family
before unknown, then the larger similarity. A line, or window, without any trigram of any notice can never be confirmed nor count as a licence, so only the others
are scored; the classifier sees each different one once. The notices bound the vocabulary, hence the coefficient table.

NULL and empty texts have no findings. NULL or repeated ids do not matter: every row yields its own findings, in as many
rows as paragraphs are found. An empty table gives an empty result (the model then learns from the notices alone). Further columns have no influence.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm.common import bind, staged
from tideline.llm.license_templates import NAMES, NO_LICENSE, NOTICES, STATEMENTS
from tideline.llm.registry import llm_query, table

TOKEN = r"[\p{L}\p{N}]+(?:[.+-][\p{L}\p{N}]+)*"
FAMILIES = tuple(NOTICES)
NONE = "none"
NEGATIVES = 4000
NEGATIVE_DOCS = 1000
WINDOWS = (6, 9, 14, 22)
STRIDE = 2
# Longer lines are cut into pieces; a piece begins every half of its length.
LONG, PIECE = 60, 40
CONFIRM = 0.5
LEAST_PROBABILITY = 0.5


@dataclass(frozen=True)
class LicenseModel:
    """``weights``: per n-gram its coefficients (class order: families, none) and the families whose notices hold it, as bits."""

    weights: DataFrame
    intercepts: tuple[float, ...]
    temperature: float
    threshold: float
    trigrams: tuple[int, ...]


def tokens(text: Column) -> Column:
    """Lower-case words between a start and an end sign."""
    return F.concat(F.array(F.lit("^")), F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0)), F.array(F.lit("$")))


def grams(words: Column, size: int) -> Column:
    return bind(words, lambda w: F.when(F.size(w) < size, F.expr("CAST(array() AS array<string>)")).otherwise(
        F.transform(F.sequence(F.lit(0), F.greatest(F.size(w) - size, F.lit(0))), lambda i: F.array_join(F.slice(w, i + 1, size), " "))))


def all_grams(words: Column) -> Column:
    return bind(words, lambda w: F.array_distinct(F.concat(*[grams(w, n) for n in (1, 2, 3)])))


def gram_hashes(words: Column) -> Column:
    """The hashes of all trigrams, as of the joined strings' words."""
    return bind(words, lambda w: F.when(F.size(w) < 3, F.expr("CAST(array() AS array<bigint>)")).otherwise(
        F.transform(F.sequence(F.lit(0), F.greatest(F.size(w) - 3, F.lit(0))), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))))


def notice_rows(spark: SparkSession) -> DataFrame:
    """(family, words): every statement and notice as a whole, and windows of the notices."""
    whole = [(family, statement.format(name)) for family, names in NAMES.items() for name in names for statement in STATEMENTS]
    whole += [(family, notice) for family, notices in NOTICES.items() for notice in notices]
    rows = spark.createDataFrame(whole, "family string, text string").select("family", tokens(F.col("text")).alias("words"))
    notices = spark.createDataFrame([(f, n) for f, ns in NOTICES.items() for n in ns], "family string, text string").select(
        "family", tokens(F.col("text")).alias("words"))
    cut = [notices.where(F.size("words") > size + 2).select(
        "family", F.explode(F.sequence(F.lit(2), F.size("words") - size, F.lit(STRIDE))).alias("i"), "words")
        .select("family", F.slice("words", F.col("i"), size).alias("words")) for size in WINDOWS]
    for c in cut:
        rows = rows.union(c)
    return rows


def lines_of(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep``, paragraph_no (from 0), start (code points), line: one row per line that is not empty."""
    parts = F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)
    return docs.select(*keep, F.posexplode(parts).alias("paragraph_no", "line")).where("line <> ''")


def train(docs: DataFrame, text: str = "text") -> LicenseModel:
    spark = docs.sparkSession
    notices = staged(notice_rows(spark), "notices")
    held = notices.select(F.explode(gram_hashes(F.col("words"))).alias("h")).distinct()
    trigrams = tuple(sorted(r[0] for r in held.collect()))  # bounded by the notices
    known = set(trigrams)
    vocabulary = [r[0] for r in notices.select(F.explode(all_grams(F.col("words"))).alias("g")).distinct().orderBy("g").collect()]

    sample = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text")).orderBy(F.xxhash64("text"), "text").limit(NEGATIVE_DOCS)
    others = lines_of(sample).select(tokens(F.col("line")).alias("words"), "line").where(
        ~F.exists(gram_hashes(F.col("words")), lambda h: h.isin(*known))).orderBy(F.xxhash64("line"), "line").limit(NEGATIVES).select(F.lit(NONE).alias("family"), "words")
    spoken = spark.createDataFrame([(NONE, s) for s in NO_LICENSE for _ in range(8)], "family string, text string").select(
        "family", tokens(F.col("text")).alias("words"))
    classes = (*FAMILIES, NONE)
    number = F.element_at(F.create_map(*[x for i, c in enumerate(classes) for x in (F.lit(c), F.lit(float(i)))]), F.col("family"))
    rows = notices.union(others).union(spoken).select(number.alias("label"), all_grams(F.col("words")).alias("grams"), F.xxhash64("words").alias("h"))
    # All rows without a licence weigh as much as those of all families.
    counts = {r[0]: r[1] for r in rows.groupBy((F.col("label") == len(FAMILIES)).alias("none")).count().collect()}
    rows = rows.withColumn("weight", F.when(F.col("label") == len(FAMILIES), F.lit(counts.get(False, 1) / max(1, counts.get(True, 0)))).otherwise(F.lit(1.0)))
    vectors = staged(CountVectorizerModel.from_vocabulary(vocabulary, inputCol="grams", outputCol="features", minTF=1.0).setBinary(True).transform(rows)
                     .select("label", "features", "h", "weight"), "license-training")
    check = F.pmod(F.col("h"), F.lit(5)) == 0
    fit = LogisticRegression(family="multinomial", regParam=0.00002, maxIter=80, standardization=False, weightCol="weight")
    model = fit.fit(vectors.where(~check))
    matrix, intercepts = model.coefficientMatrix.toArray(), model.interceptVector.toArray()

    raw = model.transform(vectors.where(check)).select("label", "rawPrediction").collect()  # bounded like the training rows
    margins = np.array([r[1].toArray() for r in raw]).reshape(-1, len(classes))
    truth = np.array([int(r[0]) for r in raw], dtype=int)

    def log_probabilities(t: float) -> np.ndarray:
        z = margins / t
        z = z - z.max(axis=1, keepdims=True)
        return z - np.log(np.exp(z).sum(axis=1, keepdims=True))

    temperature = min((0.25 * 1.15 ** i for i in range(30)), key=lambda t: -log_probabilities(t)[np.arange(len(truth)), truth].sum()) if len(truth) else 1.0
    no_license = np.exp(log_probabilities(temperature)[truth == len(FAMILIES)][:, :-1]) if len(truth) else np.zeros((0, 1))
    threshold = min(0.9, max(LEAST_PROBABILITY, float(no_license.max()) if no_license.size else 0.0))

    bits = notices.select(F.explode(F.array_distinct(grams(F.col("words"), 3))).alias("gram"), "family").distinct()
    shift = F.element_at(F.create_map(*[x for i, c in enumerate(FAMILIES) for x in (F.lit(c), F.lit(1 << i))]), F.col("family"))
    bits = bits.groupBy("gram").agg(F.bit_or(shift).alias("families"))
    schema = "gram string, " + ", ".join(f"w{i} double" for i in range(len(classes)))
    coefficients = spark.createDataFrame([(g, *map(float, matrix[:, i])) for i, g in enumerate(vocabulary)], schema)
    weights = staged(coefficients.join(bits, "gram", "left"), "license-weights")
    return LicenseModel(weights, tuple(map(float, intercepts)), float(temperature), threshold, trigrams)


def classify_lines(lines: DataFrame, model: LicenseModel) -> DataFrame:
    """(line_key, family, probability, similarity, verdict) of each different line of ``lines`` (line_key, words)."""
    distinct = lines.groupBy("line_key").agg(F.first("words").alias("words"))
    rows = distinct.select("line_key", F.size(F.array_distinct(grams(F.col("words"), 3))).alias("_all"), F.explode(all_grams(F.col("words"))).alias("_g"))
    # The vocabulary is made of the notices alone, a few thousand n-grams whatever the corpus.
    joined = rows.join(F.broadcast(model.weights), F.col("_g") == F.col("gram"))
    sums = [F.sum(f"w{i}").alias(f"w{i}") for i in range(len(FAMILIES) + 1)]
    shared = [F.sum(F.coalesce(F.shiftright("families", i).bitwiseAND(F.lit(1)), F.lit(0))).alias(f"s{i}") for i in range(len(FAMILIES))]
    summed = joined.groupBy("line_key", "_all").agg(*sums, *shared)
    margins = F.array(*[(F.col(f"w{i}") + F.lit(b)) / F.lit(model.temperature) for i, b in enumerate(model.intercepts)])
    scored = summed.withColumn("_m", margins).withColumn("_top", F.array_max("_m"))
    scored = scored.withColumn("_p", bind(F.transform("_m", lambda m: F.exp(m - F.col("_top"))), lambda e: F.transform(
        e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, y: a + y))))
    families = F.slice("_p", 1, len(FAMILIES))
    best = F.array_max(families)
    place = F.array_position(families, best).cast("int")
    out = scored.select("line_key", F.element_at("_p", -1).alias("_none"), best.alias("probability"), place.alias("_i"), "_all",
                        F.array(*[F.col(f"s{i}") for i in range(len(FAMILIES))]).alias("_s"))
    out = out.withColumn("similarity", F.element_at("_s", F.col("_i")) / F.col("_all")).withColumn(
        "family", F.element_at(F.array(*[F.lit(f) for f in FAMILIES]), F.col("_i")))
    sure = (F.col("probability") >= model.threshold) & (F.col("similarity") >= CONFIRM)
    return out.select("line_key", "family", "probability", "similarity", F.when(sure, F.col("family")).when(
        F.col("_none") < 1 - model.threshold, F.lit("unknown")).alias("verdict"))


def license_paragraphs(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), model: LicenseModel | None = None) -> DataFrame:
    """``keep``, paragraph_no, n_chars, family, probability, similarity, verdict (a family or unknown) of each licence paragraph."""
    model = model or train(docs, text)
    lines = lines_of(docs, text, keep).withColumn("words", tokens(F.col("line")))
    lines = lines.where(F.exists(gram_hashes(F.col("words")), lambda h: h.isin(*model.trigrams)))
    lines = staged(lines.select(*keep, "paragraph_no", F.length("line").cast("long").alias("n_chars"), F.xxhash64("line").alias("line_key"), "words"), "license-lines")
    # dealt out by key, so that a task's share follows the number of lines, not the bytes of the few that are found
    distinct = lines.groupBy("line_key").agg(F.first("words").alias("words")).repartition("line_key")
    pieces = distinct.select("line_key", F.explode(pieces_of(F.col("words"))).alias("words")).where(F.exists(gram_hashes(F.col("words")), lambda h: h.isin(*model.trigrams)))
    pieces = staged(pieces.select(F.col("line_key").alias("_line"), F.xxhash64("words").alias("line_key"), "words"), "license-pieces")
    scored = classify_lines(pieces, model).where("verdict IS NOT NULL").withColumnRenamed("line_key", "_piece")
    rank = F.struct((F.col("verdict") != "unknown").alias("sure"), "similarity", "probability", "verdict")
    found = pieces.join(scored, F.col("line_key") == F.col("_piece")).groupBy(F.col("_line").alias("_key")).agg(
        F.max_by(F.struct("family", "probability", "similarity", "verdict"), rank).alias("_best")).select("_key", "_best.*")
    return lines.join(found, F.col("line_key") == F.col("_key")).select(
        *keep, "paragraph_no", "n_chars", "family", "probability", "similarity", "verdict")


def pieces_of(words: Column) -> Column:
    """The words of a line as one piece, or those of a long line as overlapping ones; the last piece ends with the line."""
    half = PIECE // 2
    return bind(words, lambda w: F.when(F.size(w) <= LONG, F.array(w)).otherwise(
        F.transform(F.sequence(F.lit(0), F.greatest(F.size(w) - PIECE + half - 1, F.lit(0)), F.lit(half)), lambda i: F.slice(w, i + 1, PIECE))))


@llm_query("op10_license_classifier")
def op10_license_classifier(spark, sf_dir):
    found = license_paragraphs(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "paragraph_no", "n_chars", "verdict", F.round("probability", 6).alias("probability"),
                        F.round("similarity", 6).alias("similarity"))

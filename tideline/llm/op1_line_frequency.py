"""Quality rules: lines that many documents of a host share are boilerplate, and documents made of them are rejected.

Lines are normalised and hashed; per host the distinct documents holding each line are counted. A document counts once
per distinct text, so copies neither make a line frequent nor each other boilerplate. Lines above the limits are removed,
and a document that keeps too small a part of its words is rejected, as is one that fails the base rules.

NULL text is an empty text (no words: base rules fail). NULL host is a host of its own. NULL or repeated ids and repeated
rows do not matter, because the verdict depends on host and text only; every input row gets one output row.
An empty table gives an empty result. Further columns of the input are ignored (``line_verdicts``) or kept (``apply_line_rules``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import WORD, bind, new_length, packed, staged, text_key, unpacked
from tideline.llm.registry import llm_query, table

# Characters counted as symbols.
SYMBOLS = "#*$%&|<>"
# A window hash keeps this many low bits for the window's position while candidates are sorted.
_INDEX = (1 << 28) - 1


@dataclass(frozen=True)
class LineLimits:
    """A line is boilerplate in a host if more than ``min_docs`` documents hold it, and either more than ``max_share`` of the host's
    documents or more than ``most_docs`` do: the share counts in small hosts only. A document is depleted if less than ``min_kept`` of its words remain."""

    min_docs: int = 5
    max_share: float = 0.1
    most_docs: int = 50
    min_kept: float = 0.3
    min_words: int = 50
    max_repeat_percent: int = 50


def _has_word(line: Column) -> Column:
    return F.rlike(line, F.lit(WORD))


def line_hash(line: Column) -> Column:
    """Hash of a line without case, punctuation and the values of numbers; a line of symbols only is hashed as it is."""
    plain = F.trim(F.regexp_replace(F.regexp_replace(F.lower(line), r"[^\p{L}\p{N}]+", " "), r"\p{N}+", "0"))
    return F.xxhash64(F.when(plain == "", line).otherwise(plain))


def repeated_window_words(words: Column, size: int = 3) -> Column:
    """Words covered by windows of ``size`` words that occur twice or more in ``words``.

    Window hashes are sorted as plain longs whose low bits hold the position; neighbours with equal high bits are
    candidates, and only those are compared by their whole hash. A position p before the next repeated position q covers
    min(size, q - p) words, so no word is counted twice.
    """

    def hashed(w: Column, i: Column) -> Column:
        return F.xxhash64(*[F.get(w, i + k) for k in range(size)])

    def candidates(w: Column) -> Column:
        packed = F.transform(F.sequence(F.lit(0), F.size(w) - size),
                             lambda i: F.coalesce(hashed(w, i).bitwiseAND(F.lit(~_INDEX)).bitwiseOR(i.cast("long")), F.lit(0)))
        return bind(F.sort_array(packed), lambda s: F.transform(
            F.filter(F.arrays_zip(s.alias("a"), F.slice(s, 2, F.size(s)).alias("b"), F.concat(F.array(F.lit(None).cast("long")), s).alias("c")),
                     lambda z: z["a"].isNotNull() & (F.coalesce(z["a"].bitwiseXOR(z["b"]).bitwiseAND(F.lit(~_INDEX)) == 0, F.lit(False))
                                | F.coalesce(z["a"].bitwiseXOR(z["c"]).bitwiseAND(F.lit(~_INDEX)) == 0, F.lit(False)))),
            lambda z: z["a"].bitwiseAND(F.lit(_INDEX)).cast("int")))

    def exact(w: Column, positions: Column) -> Column:
        pairs = F.sort_array(F.transform(positions, lambda i: F.struct(hashed(w, i).alias("h"), i.alias("i"))))
        return bind(pairs, lambda s: F.sort_array(F.transform(
            F.filter(F.arrays_zip(s.alias("a"), F.slice(s, 2, F.size(s)).alias("b"), F.concat(F.array(F.lit(None).cast("struct<h:bigint,i:int>")), s).alias("c")),
                     lambda z: z["a"].isNotNull() & (F.coalesce(z["a"]["h"] == z["b"]["h"], F.lit(False)) | F.coalesce(z["a"]["h"] == z["c"]["h"], F.lit(False)))),
            lambda z: z["a"]["i"])))

    def covered(positions: Column) -> Column:
        ahead = F.concat(F.slice(positions, 2, F.size(positions)), F.array(F.lit(2147483647)))
        steps = F.zip_with(positions, ahead, lambda p, q: F.least(q - p, F.lit(size)))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda acc, n: acc + n)

    return bind(words, lambda w: F.when(F.size(w) <= size, F.lit(0).cast("long")).otherwise(
        bind(candidates(w), lambda c: F.when(F.size(c) == 0, F.lit(0).cast("long")).otherwise(
            bind(exact(w, c), lambda e: F.when(F.size(e) == 0, F.lit(0).cast("long")).otherwise(covered(e)))))))


def text_measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base inputs of the rules."""
    whole = F.coalesce(F.col(text), F.lit(""))
    words = F.regexp_extract_all(whole, F.lit(WORD), F.lit(0))
    lines = F.filter(F.split(whole, "\n", -1), _has_word)
    counted = bind(words, lambda w: F.struct(F.size(w).cast("long").alias("n_words"), repeated_window_words(w).alias("n_repeat_words")))
    return docs.withColumn("_m", counted).withColumn("_dup", bind(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))).select(
        *docs.columns, F.col("_m.n_words").alias("n_words"),
        F.length(F.translate(whole, " \t\n\u000b\f\r", "")).cast("long").alias("word_chars"),
        (F.length(whole) - F.length(F.translate(whole, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.col("_dup").alias("n_dup_lines"), F.col("_m.n_repeat_words").alias("n_repeat_words"))


def line_table(docs: DataFrame, text: str = "text", host: str = "source", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: ``keep``, host, text key, base measures, and (hash, words) of each line with a word. Stored."""
    base = docs.select(*keep, F.col(host).alias("_host"), F.col(text).alias("_text"))
    measured = text_measures(base, "_text")
    whole = F.coalesce(F.col("_text"), F.lit(""))
    lines = F.transform(F.filter(F.split(whole, "\n", -1), _has_word),
                        lambda x: F.struct(line_hash(x).alias("h"), F.regexp_count(x, F.lit(WORD)).alias("w")))
    return staged(measured.withColumns({"_key": text_key("_text"), "_lines": lines}).drop("_text"), "lines")


def boilerplate(lines: DataFrame, limits: LineLimits = LineLimits()) -> DataFrame:
    """(_host, _key, _heavy): per host and text, the hashes of its lines above the limits; texts without any are left out."""
    held = lines.select("_host", "_key", F.explode(F.array_distinct("_lines.h")).alias("_h")).distinct()
    counts = held.groupBy("_host", "_h").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > limits.min_docs)
    hosts = lines.select("_host", "_key").distinct().groupBy(F.col("_host").alias("_of")).agg(F.count(F.lit(1)).alias("_docs"))
    heavy = staged(counts.join(hosts, F.col("_host").eqNullSafe(F.col("_of"))).where(
        (F.col("_n") > F.col("_docs") * limits.max_share) | (F.col("_n") > limits.most_docs)).select(
        F.col("_host").alias("_of"), F.col("_h").alias("_g")), "heavy-lines")
    rows = lines.select("_host", "_key", F.explode(F.array_distinct("_lines.h")).alias("_h"))
    found = rows.join(heavy, F.col("_host").eqNullSafe(F.col("_of")) & (F.col("_h") == F.col("_g")))
    return found.groupBy("_host", "_key").agg(F.collect_set("_h").alias("_heavy"))


def line_verdicts(docs: DataFrame, text: str = "text", host: str = "source", limits: LineLimits = LineLimits(),
                  keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Per row: ``keep``, the base measures, words in removed lines, base_failed, depleted, kept, the key and heavy lines."""
    lines = line_table(docs, text, host, keep)
    heavy = boilerplate(lines, limits).withColumnsRenamed({"_host": "_of", "_key": "_for"})
    joined = lines.join(heavy, F.col("_host").eqNullSafe(F.col("_of")) & (F.col("_key") == F.col("_for")), "left")
    removed = F.aggregate(F.filter("_lines", lambda x: F.array_contains(F.col("_heavy"), x["h"])), F.lit(0).cast("long"), lambda acc, x: acc + x["w"])
    failed = (F.col("n_words") < limits.min_words) | (100 * F.col("n_repeat_words") > limits.max_repeat_percent * F.col("n_words"))
    depleted = (F.col("n_words") - F.col("n_removed_words")) < limits.min_kept * F.col("n_words")
    return (joined.withColumn("n_removed_words", F.when(F.col("_heavy").isNull(), F.lit(0).cast("long")).otherwise(removed))
            .withColumn("base_failed", failed).withColumn("kept", ~failed & ~depleted))


def apply_line_rules(docs: DataFrame, text: str = "text", host: str = "source", limits: LineLimits = LineLimits()) -> DataFrame:
    """The kept documents, all columns, without their boilerplate lines; ``n_chars``, if there, follows the new text."""
    verdicts = line_verdicts(docs, text, host, limits, keep=()).where("kept").select(
        F.col("_host").alias("_of"), F.col("_key").alias("_for"), F.coalesce("_heavy", F.expr("CAST(array() AS array<bigint>)")).alias("_heavy"))
    verdicts = staged(verdicts.groupBy("_of", "_for", "_heavy").agg(F.count(F.lit(1)).alias("_copies")).drop("_copies"), "verdicts")
    whole = F.col("_doc").getField(text)
    joined = packed(docs).withColumn("_key", text_key(whole)).join(
        verdicts, F.col("_doc").getField(host).eqNullSafe(F.col("_of")) & (F.col("_key") == F.col("_for")))
    cleaned = F.array_join(F.filter(F.split(whole, "\n", -1), lambda x: ~(_has_word(x) & F.array_contains(F.col("_heavy"), line_hash(x)))), "\n")
    joined = joined.withColumn("_new", F.when(F.size("_heavy") == 0, whole).otherwise(cleaned))
    return joined.select(*unpacked(docs.columns, **{text: F.col("_new"), **new_length(docs, F.col("_new"), F.size("_heavy") > 0)}))


_LIMITS = LineLimits()

SQL = rf"""WITH t AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS x FROM documents),
w AS (SELECT rid, regexp_extract_all(x, '[^\x20\x09-\x0D]+') AS ws, string_split(x, chr(10)) AS ls FROM t),
p AS (SELECT rid, i, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c FROM w, unnest(range(1, len(ws) - 1)) AS u(i)),
q AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, a, b, c) AS n FROM p),
r AS (SELECT rid, count(DISTINCT j) AS n_repeat_words FROM q, unnest([i, i + 1, i + 2]) AS u(j) WHERE n > 1 GROUP BY rid),
l AS (SELECT rid, u.x AS line FROM w, unnest(ls) AS u(x) WHERE regexp_matches(u.x, '[^\x20\x09-\x0D]')),
d AS (SELECT rid, count(*) - count(DISTINCT line) AS n_dup_lines FROM l GROUP BY rid),
k AS (SELECT l.rid, source, t.x AS doc, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS w, line,
   trim(regexp_replace(regexp_replace(lower(line), '[^\p{{L}}\p{{N}}]+', ' ', 'g'), '\p{{N}}+', '0', 'g'), ' ') AS plain FROM l JOIN t ON t.rid = l.rid),
k2 AS (SELECT *, CASE WHEN plain = '' THEN line ELSE plain END AS h FROM k),
f AS (SELECT source, h, count(DISTINCT doc) AS n FROM k2 GROUP BY source, h),
s AS (SELECT source, count(DISTINCT x) AS docs FROM t GROUP BY source),
hv AS (SELECT f.source, h FROM f JOIN s ON s.source IS NOT DISTINCT FROM f.source WHERE n > {_LIMITS.min_docs} AND (n > docs * CAST({_LIMITS.max_share} AS DOUBLE) OR n > {_LIMITS.most_docs})),
rm AS (SELECT rid, sum(w) AS n_removed FROM k2 JOIN hv ON hv.source IS NOT DISTINCT FROM k2.source AND hv.h = k2.h GROUP BY rid),
m AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(regexp_replace(t.x, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
   CAST(length(t.x) - length(regexp_replace(t.x, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
   CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed_words
   FROM t JOIN w ON w.rid = t.rid LEFT JOIN r ON r.rid = t.rid LEFT JOIN d ON d.rid = t.rid LEFT JOIN rm ON rm.rid = t.rid),
b AS (SELECT *, n_words < {_LIMITS.min_words} OR 100 * n_repeat_words > {_LIMITS.max_repeat_percent} * n_words AS base_failed FROM m)
SELECT *, NOT base_failed AND n_words - n_removed_words >= CAST({_LIMITS.min_kept} AS DOUBLE) * n_words AS kept FROM b"""


@llm_query("op1_line_frequency", SQL)
def op1_line_frequency(spark, sf_dir):
    return line_verdicts(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_removed_words", "base_failed", "kept")

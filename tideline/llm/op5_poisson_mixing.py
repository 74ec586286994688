"""Mixing sources to target weights by Poisson replication.

Each source gets a mean repetition rate that brings its characters to its share of the target. A document's number of copies
is the inverse of the Poisson distribution with that mean at a uniform number hashed from the document and a seed, so it is
fixed by the document alone. The documents are exploded by their counts and put in an order given by another hash.

A NULL source is a source of its own. NULL text has no characters; sources without characters have rate 0 and vanish, as
nothing of them can be weighed. NULL ids are hashed as empty; repeated rows have equal counts each and stand side by side.
An empty table gives an empty result. Columns of the input that are named like the added ones (copies, copy, order_key) are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import broadcast_within, packed, staged, unpacked
from tideline.llm.registry import llm_query, table

# Shares of sources are raised to this power before they are normalised: below 1, small sources gain.
POWER = 0.7
# Characters of the result over characters of the input.
SIZE = 1.0
SEED = "mix-1"
# A larger mean is the sum of independent parts with at most this mean each, so that no probability underflows.
LARGEST_MEAN = 16
BROADCAST_BYTES = 8_000_000


def hashed_uniform(*parts: Column) -> Column:
    """A number in [0, 1) from 52 bits of the md5 of the parts."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 13), 16, 10).cast("double") / F.lit(float(16 ** 13))


def poisson_table(mean: Column) -> Column:
    """P(X <= k) for k = 0, 1, ... up to where the rest is below what a hashed uniform can resolve."""
    last = F.ceil(mean + 12 * F.sqrt(mean) + 20).cast("int")
    none = F.expr("CAST(array() AS array<double>)")
    start = F.struct(F.exp(-mean).alias("p"), F.exp(-mean).alias("sum"), none.alias("all"))

    def step(acc: Column, k: Column) -> Column:
        p = acc["p"] * mean / k
        return F.struct(p.alias("p"), (acc["sum"] + p).alias("sum"), F.concat(acc["all"], F.array(acc["sum"])).alias("all"))

    return F.aggregate(F.sequence(F.lit(1), last), start, step, lambda acc: acc["all"])


def source_rates(docs: DataFrame, source: str = "source", text: str = "text", weights: dict[str | None, float] | None = None,
                 power: float = POWER, size: float = SIZE) -> DataFrame:
    """(_of, _rate, _parts, _table) per source. ``weights`` are target shares (need not sum to 1); without them, shares ** power."""
    chars = staged(docs.groupBy(F.col(source).alias("_of")).agg(F.sum(F.length(F.coalesce(text, F.lit("")))).alias("_chars")), "source-sizes")
    total = chars.agg(F.sum("_chars")).first()[0] or 0
    if weights is None:
        wanted = F.pow(F.col("_chars").cast("double") / F.lit(float(max(1, total))), F.lit(power))
    else:
        given = [F.when(F.col("_of").eqNullSafe(F.lit(name)), F.lit(float(w))) for name, w in weights.items()]
        wanted = F.coalesce(*given, F.lit(0.0))
    wanted = chars.withColumn("_wanted", F.when(F.col("_chars") > 0, wanted).otherwise(F.lit(0.0)))
    all_wanted = wanted.agg(F.sum("_wanted")).first()[0] or 1.0
    rate = F.when(F.col("_chars") > 0, F.col("_wanted") / F.lit(all_wanted) * F.lit(total * size) / F.col("_chars")).otherwise(F.lit(0.0))
    rates = wanted.select("_of", rate.alias("_rate")).withColumn("_parts", F.greatest(F.ceil(F.col("_rate") / LARGEST_MEAN), F.lit(1)).cast("int"))
    return staged(rates.withColumn("_table", poisson_table(F.col("_rate") / F.col("_parts"))), "source-rates")


def mix(docs: DataFrame, rates: DataFrame, source: str = "source", text: str = "text", doc_id: str = "doc_id", seed: str = SEED) -> DataFrame:
    """``docs`` repeated, plus copies, copy (1, 2, ...) and order_key; in the order of the key within each partition.

    Rows are dealt to partitions by the key, a hash, so that every partition is a random part of the whole.
    """
    inner = F.col("_doc").getField
    digest = F.md5(F.coalesce(inner(text), F.lit("")).cast("binary"))
    own = F.coalesce(inner(doc_id).cast("string"), F.lit(""))
    joined = packed(docs).withColumn("_digest", digest).join(
        broadcast_within(rates, BROADCAST_BYTES), inner(source).eqNullSafe(F.col("_of")))

    def part(j: Column) -> Column:
        u = hashed_uniform(F.lit(seed), own, F.col("_digest"), j.cast("string"))
        return F.aggregate("_table", F.struct(u.alias("u"), F.lit(0).alias("n")),
                           lambda acc, p: F.struct(acc["u"].alias("u"), (acc["n"] + (p <= acc["u"]).cast("int")).alias("n")), lambda acc: acc["n"])

    copies = F.aggregate(F.transform(F.sequence(F.lit(1), F.col("_parts")), part), F.lit(0), lambda acc, n: acc + n)
    counted = joined.withColumn("copies", copies).where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    order = F.substring(F.md5(F.concat_ws("|", F.lit(seed), F.lit("order"), own, F.col("_digest"), F.col("copy").cast("string"))), 1, 16)
    kept = [c for c in docs.columns if c not in ("copies", "copy", "order_key")]
    return counted.withColumn("order_key", order).select(*unpacked(kept), "copies", "copy", "order_key").repartition("order_key").sortWithinPartitions(
        "order_key", doc_id, "copy")


SQL = f"""WITH RECURSIVE t AS (SELECT *, coalesce(text, '') AS x FROM documents),
c AS (SELECT source, sum(length(x)) AS chars FROM t GROUP BY source),
w AS (SELECT *, CASE WHEN chars > 0 THEN pow(CAST(chars AS DOUBLE) / CAST((SELECT greatest(1, sum(chars)) FROM c) AS DOUBLE), {POWER}) ELSE 0 END AS wanted FROM c),
r AS (SELECT source, CASE WHEN chars > 0 THEN wanted / (SELECT sum(wanted) FROM w) * CAST((SELECT sum(chars) FROM c) * {SIZE} AS DOUBLE) / chars ELSE 0 END AS rate FROM w),
p AS (SELECT source, rate, 0 AS k, exp(-rate) AS p, exp(-rate) AS s FROM r
  UNION ALL SELECT source, rate, k + 1, p * rate / (k + 1), s + p * rate / (k + 1) FROM p WHERE k + 1 < ceil(rate + 12 * sqrt(rate) + 20)),
u AS (SELECT *, CAST(('0x' || substr(md5(concat_ws('|', '{SEED}', coalesce(CAST(doc_id AS VARCHAR), ''), md5(x), '1')), 1, 13)) AS BIGINT) / CAST({16 ** 13} AS DOUBLE) AS u FROM t),
n AS (SELECT u.*, (SELECT count(*) FROM p WHERE p.source IS NOT DISTINCT FROM u.source AND p.s <= u.u) AS copies FROM u)
SELECT doc_id, text, lang, source, n_chars, CAST(copies AS INTEGER) AS copies, CAST(i AS INTEGER) AS copy,
  substr(md5(concat_ws('|', '{SEED}', 'order', coalesce(CAST(doc_id AS VARCHAR), ''), md5(x), CAST(i AS VARCHAR))), 1, 16) AS order_key
FROM n, unnest(range(1, copies + 1)) AS v(i)"""


@llm_query("op5_poisson_mixing", SQL)
def op5_poisson_mixing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return mix(docs, source_rates(docs))

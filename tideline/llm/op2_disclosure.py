"""Personal data: spans of fixed forms, and terms that give protected entities away.

The spans of the fixed forms (mail and network addresses, card and phone numbers) are the protected entities. How much a term
says about an entity is estimated from co-occurrence over all documents: what is left of the entity's information once the
term is known is -log2 p(entity | term), p being the share of documents with the term that hold the entity, at whatever
distance. Terms that leave at most ``remove_bits`` of some entity are removed, terms that leave at most ``generalise_bits``
are generalised, at every place of every text outside the fixed forms.
Entities and pairs need ``support`` different texts, so neither a single mention nor copies of one text teach anything.

NULL text is an empty text without spans. NULL or repeated ids do not matter: spans depend on the text only, and every row
gets one output row; a repeated row counts as a document of its own, not as a different text. An empty table gives an empty
result. Further columns have no influence (``private_spans``) or are kept (``sanitise``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import bind, broadcast_within, find_spans, new_length, packed, staged, text_key, unpacked
from tideline.llm.registry import llm_query, table

KINDS = ("email", "ip", "card", "phone")
ADDED = ("removed", "generalised")

# The forms. Possessive quantifiers and the look behind a run's start match the same strings and cannot run away.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TERM = r"[\p{L}\p{N}]++"
BROADCAST_BYTES = 16_000_000


@dataclass(frozen=True)
class Disclosure:
    support: int = 3
    generalise_bits: float = 1.0
    remove_bits: float = 0.15


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _passes_luhn(digits: Column) -> Column:
    """Every second digit from the right doubled, nines cast out; the sum ends in 0."""
    def step(acc: Column, c: Column) -> Column:
        x = c.cast("int")
        doubled = F.when(x > 4, x * 2 - 9).otherwise(x * 2)
        return F.struct((acc["sum"] + F.when(acc["twice"], doubled).otherwise(x)).alias("sum"), (~acc["twice"]).alias("twice"))

    signs = F.split(F.reverse(digits), "", -1)
    total = F.aggregate(F.filter(signs, lambda c: c != ""), F.struct(F.lit(0).alias("sum"), F.lit(False).alias("twice")), step, lambda acc: acc["sum"])
    return total % 10 == 0


def _small_number(part: Column) -> Column:
    """At most 255, however many zeros stand in front."""
    plain = F.regexp_replace(part, "^0+", "")
    return (F.length(plain) <= 3) & (F.coalesce(plain.try_cast("int"), F.lit(0)) <= 255)


def _holds(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(value, r"\.", -1), _small_number)
    count = F.length(_digits(value))
    if kind == "card":
        return F.when(count.between(13, 19), _passes_luhn(_digits(value))).otherwise(F.lit(False))
    return count.between(9, 15)


def base_spans(text: Column) -> Column:
    """array<struct<kind_no, start, end, kind, value>> of the fixed forms, by kind, then by start."""
    def of(number: int, kind: str) -> Column:
        kept = F.filter(find_spans(text, PATTERNS[kind]), lambda m: _holds(kind, m["value"]))
        return F.transform(kept, lambda m: F.struct(F.lit(number).alias("kind_no"), m["start"].alias("start"), m["end"].alias("end"),
                                                    F.lit(kind).alias("kind"), m["value"].alias("value")))

    return F.concat(*[of(i, kind) for i, kind in enumerate(KINDS)])


def _entity(span: Column) -> Column:
    """One name for all spellings: lower case, digits only for numbers."""
    plain = F.when(span["kind"].isin("card", "phone"), _digits(span["value"])).otherwise(F.lower(span["value"]))
    return F.concat(span["kind"], F.lit(":"), plain)


def _outside(text: Column, spans: Column) -> Column:
    """array<string>: the different terms (lower case) of the text outside ``spans``."""
    # The spans are ordered by kind; those that start within an earlier one add only what lies behind it.
    step = lambda acc, s: F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(s["start"] > acc["at"], F.concat(
        acc["out"], F.array(F.substring(text, acc["at"] + 1, s["start"] - acc["at"])))).otherwise(acc["out"]).alias("out"))
    borders = F.sort_array(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))
    between = F.aggregate(borders, F.struct(F.lit(0).alias("at"), F.expr("CAST(array() AS array<string>)").alias("out")), step,
                          lambda acc: F.concat(acc["out"], F.array(F.substring(text, acc["at"] + 1, F.length(text)))))
    return _terms(F.array_join(between, " "))


def _terms(text: Column) -> Column:
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), F.lower))


def find_entities(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep``, _key, _base (spans of the fixed forms) and _terms (of texts with such spans: their other terms) of every row. Stored."""
    whole = F.coalesce(F.col(text), F.lit(""))
    found = docs.select(*keep, text_key(text).alias("_key"), whole.alias("_text"), base_spans(whole).alias("_base"))
    terms = F.when(F.size("_base") > 0, _outside(F.col("_text"), F.col("_base"))).otherwise(F.expr("CAST(array() AS array<string>)"))
    return staged(found.withColumn("_terms", terms).drop("_text"), "entities")


def disclosing_terms(docs: DataFrame, found: DataFrame, text: str = "text", limits: Disclosure = Disclosure()) -> DataFrame:
    """(_term, bits): terms that leave at most ``generalise_bits`` of some entity's information, by pairs with support. Stored."""
    # Copies of a text are one row with their number from here on.
    mentions = found.where(F.size("_base") > 0).groupBy("_key").agg(
        F.count(F.lit(1)).alias("n"), F.first(F.array_distinct(F.transform("_base", _entity))).alias("_entities"), F.first("_terms").alias("_terms"))
    mentions = staged(mentions, "mentions")
    entities = mentions.select("_key", "n", F.explode("_entities").alias("entity"))
    supported = staged(entities.groupBy(F.col("entity").alias("_entity")).agg(F.count(F.lit(1)).alias("_texts"), F.sum("n").alias("_held"))
                       .where(F.col("_texts") >= limits.support), "supported")
    entities = entities.join(supported, F.col("entity") == F.col("_entity")).select("_key", "n", "entity", "_held")

    # Before any pair is made: with ``documents`` d of a term and h of an entity, at most h of the d hold both.
    most = supported.agg(F.max("_held")).first()[0] or 0
    ratio = 2.0 ** limits.generalise_bits * (1 + 1e-9)
    texts = mentions.select(F.explode("_terms").alias("term"), "n").groupBy("term").agg(F.count(F.lit(1)).alias("_texts"), F.sum("n").alias("_least"))
    texts = staged(texts.where((F.col("_texts") >= limits.support) & (F.col("_least") <= F.lit(most * ratio))).select(F.col("term").alias("_word"), "_least"), "term-texts")
    held = docs.select(F.explode(_terms(F.coalesce(F.col(text), F.lit("")))).alias("word")).join(
        broadcast_within(texts, BROADCAST_BYTES), F.col("word") == F.col("_word")).groupBy("word", "_least").agg(F.count(F.lit(1)).alias("_all"))
    # Where a span cuts a word, the piece may be no word of the whole text; then its count outside spans is the least that is known.
    counted = texts.join(held.select(F.col("word").alias("_w"), "_all"), F.col("_word") == F.col("_w"), "left").select(
        "_word", F.greatest("_least", F.coalesce("_all", F.lit(0))).alias("documents"))
    counted = staged(counted.where(F.col("documents") <= F.lit(most * ratio)), "terms")
    terms = mentions.select(F.col("_key").alias("_of"), F.explode("_terms").alias("term")).join(
        broadcast_within(counted, BROADCAST_BYTES), F.col("term") == F.col("_word")).select("_of", "term", "documents")
    pairs = entities.join(terms, (F.col("_key") == F.col("_of")) & (F.col("documents") <= F.col("_held") * F.lit(ratio)))
    pairs = pairs.groupBy("entity", "term", "documents").agg(F.count(F.lit(1)).alias("texts"), F.sum("n").alias("together")).where(F.col("texts") >= limits.support)
    bits = pairs.withColumn("bits", -F.log2(F.col("together") / F.col("documents"))).where(F.col("bits") <= limits.generalise_bits)
    # A term that gives several entities away is treated by the strongest disclosure.
    return staged(bits.groupBy(F.col("term").alias("_term")).agg(F.min("bits").alias("bits")), "disclosing")


def added_spans(docs: DataFrame, disclosing: DataFrame, text: str = "text", limits: Disclosure = Disclosure()) -> DataFrame:
    """(_for, _added): per text the spans of disclosing terms outside the fixed forms, by kind, then by start; texts without any are left out."""
    whole = F.coalesce(F.col(text), F.lit(""))
    words = docs.select(text_key(text).alias("_key"), F.explode(_terms(whole)).alias("term")).join(
        broadcast_within(disclosing, BROADCAST_BYTES), F.col("term") == F.col("_term")).select("_key", "term", "bits")
    held = words.groupBy("_key").agg(F.collect_set(F.struct("term", "bits")).alias("_held"))  # at most the words of one text
    marked = docs.select(text_key(text).alias("_for"), whole.alias("_text")).join(held, F.col("_for") == F.col("_key"))
    marked = marked.groupBy("_for").agg(F.first("_text").alias("_text"), F.first("_held").alias("_held"))
    # One expression per text, of its own terms: only those are taken apart.
    pattern = F.concat(F.lit(r"(?iu)(?<![\p{L}\p{N}])(?:"), F.array_join(F.transform("_held", lambda h: h["term"]), "|"), F.lit(r")(?![\p{L}\p{N}])"))
    levels = F.map_from_entries(F.col("_held"))
    spans = F.transform(find_spans(F.col("_text"), pattern), lambda m: F.struct(
        F.element_at(levels, F.lower(m["value"])).alias("bits"), m["start"].alias("start"), m["end"].alias("end")))
    base = base_spans(F.col("_text"))
    spans = bind(base, lambda b: F.filter(spans, lambda w: w["bits"].isNotNull() & ~F.exists(b, lambda s: (s["start"] < w["end"]) & (w["start"] < s["end"]))))
    removed = lambda w: w["bits"] <= limits.remove_bits
    added = F.sort_array(F.transform(spans, lambda w: F.struct(
        F.when(removed(w), F.lit(len(KINDS))).otherwise(F.lit(len(KINDS) + 1)).alias("kind_no"), w["start"].alias("start"), w["end"].alias("end"),
        F.when(removed(w), F.lit(ADDED[0])).otherwise(F.lit(ADDED[1])).alias("kind"))))
    return marked.select("_for", added.alias("_added"))


def private_spans(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), limits: Disclosure = Disclosure()) -> DataFrame:
    """``keep``, _key, _base and _added (empty where no term discloses anything) of every row."""
    found = find_entities(docs, text, keep)
    added = added_spans(docs, disclosing_terms(docs, found, text, limits), text, limits)
    none = F.expr("CAST(array() AS array<struct<kind_no:int,start:int,end:int,kind:string>>)")
    return found.join(added, F.col("_key") == F.col("_for"), "left").select(*keep, "_key", "_base", F.coalesce("_added", none).alias("_added"))


def sanitise(docs: DataFrame, text: str = "text", limits: Disclosure = Disclosure()) -> DataFrame:
    """``docs`` with entities replaced by their kind, generalised terms by "[TERM]", and removed terms left out."""
    spans = private_spans(docs, text, (), limits).where((F.size("_base") > 0) | (F.size("_added") > 0))
    plain = F.transform("_base", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("by")))
    more = F.transform("_added", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.when(s["kind"] == ADDED[0], F.lit("")).otherwise(F.lit("[TERM]")).alias("by")))
    spans = staged(spans.groupBy(F.col("_key").alias("_for")).agg(F.first(F.sort_array(F.concat(plain, more))).alias("_spans")), "private-spans")
    whole = F.col("_doc").getField(text)
    joined = packed(docs).withColumn("_key", text_key(whole)).join(spans, F.col("_key") == F.col("_for"), "left")

    def step(acc: Column, s: Column) -> Column:
        ahead = F.array(F.substring(whole, acc["at"] + 1, s["start"] - acc["at"]), s["by"])
        return F.when(s["end"] <= acc["at"], acc).otherwise(F.struct(
            s["end"].alias("at"), F.when(s["start"] < acc["at"], acc["out"]).otherwise(F.concat(acc["out"], ahead)).alias("out")))

    start = F.struct(F.lit(0).alias("at"), F.expr("CAST(array() AS array<string>)").alias("out"))
    masked = F.aggregate("_spans", start, step, lambda acc: F.array_join(
        F.concat(acc["out"], F.array(F.substring(whole, acc["at"] + 1, F.length(whole)))), ""))
    joined = joined.withColumn("_new", F.when(F.col("_spans").isNull(), whole).otherwise(masked))
    return joined.select(*unpacked(docs.columns, **{text: F.col("_new"), **new_length(docs, F.col("_new"), F.col("_spans").isNotNull())}))


def _written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _count_of(kind: str) -> Column:
    return F.size(F.filter("_base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


@llm_query("op2_disclosure")
def op2_disclosure(spark, sf_dir):
    spans = private_spans(table(spark, sf_dir, "documents"))
    base, added = _written(F.col("_base")), _written(F.col("_added"))
    return spans.select("doc_id", *[_count_of(k) for k in KINDS], F.sha2(base, 256).alias("base_sha256"),
                        F.concat_ws(",", F.when(base != "", base), F.when(added != "", added)).alias("spans"))

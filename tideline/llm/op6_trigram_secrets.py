"""Secret scan by a trigram inverted index.

Each rule's regular expression is turned into a Boolean query over trigrams that any match must contain. The index holds
postings (trigram, text key) of the lower-cased texts; intersecting them gives the candidate texts of each rule, and only
those are searched with the expression itself. A rule without a mandatory trigram is searched for in every text.

Texts are keyed by their content, so copies share postings; a key that is shared by chance only adds a candidate. NULL
text is an empty text without findings. NULL or repeated ids, repeated rows and further columns have no influence: every
input row gets one output row. An empty table gives an empty result.
"""

from __future__ import annotations

import re._parser as regex_parser
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import find_spans, new_length, packed, staged, text_key, unpacked
from tideline.llm.registry import llm_query, table


@dataclass(frozen=True)
class Rule:
    """``keep`` decides on the matched string; ``base`` rules are counted and digested on their own."""

    name: str
    pattern: str
    keep: Callable[[Column], Column]
    base: bool = False


def _at_least(n: int) -> Callable[[Column], Column]:
    return lambda value: F.length(value) >= n


_ASSIGN = r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*+[:=]\x20*+["']?"""

# A private key as a whole: to its END line, over a body on one line or on up to 400; of a key that is cut off, the lines that can only be its body.
_PEM = (r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:[A-Za-z0-9+/=\\\s]*+-----END [A-Z ]*PRIVATE KEY-----|"
        r"(?:(?!-----)[^\n]{0,200}+\n){1,400}+-----END [A-Z ]*PRIVATE KEY-----|(?:\s{0,2}+[A-Za-z0-9+/=]{40,}+){0,400}+)")

# The forms of secrets. Possessive quantifiers match the same strings here and cannot run away.
RULES = (
    Rule("assign", _ASSIGN + r"[A-Za-z0-9+/_.=-]++", lambda v: F.length(F.regexp_replace(v, "^" + _ASSIGN, "")) >= 8, True),
    Rule("access", r"AKIA[A-Z0-9]++", _at_least(16), True),
    Rule("hex", r"[0-9a-f]++", _at_least(32), True),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}+", _at_least(1)),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}+", _at_least(1)),
    Rule("payment", r"[rs]k_live_[A-Za-z0-9]{16,}+", _at_least(1)),
    Rule("web", r"AIza[A-Za-z0-9_-]{35,}+", _at_least(1)),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]++\.eyJ[A-Za-z0-9_-]++\.[A-Za-z0-9_-]++", _at_least(1)),
    Rule("pem", _PEM, _at_least(1)),
)

# Runs of hexadecimal digits are everywhere; only those long enough to be kept need to be looked at, and a run is found
# whole because it must not follow another such digit.
SEARCHED = {"hex": r"(?<![0-9a-f])[0-9a-f]{32,}+"}

# A query is a list of clauses (AND); a clause is a list of alternatives (OR); an alternative is a set of trigrams (AND).
Query = list[list[frozenset[str]]]
_MOST_STRINGS = 64


def trigrams(s: str) -> frozenset[str]:
    return frozenset(s[i:i + 3] for i in range(len(s) - 2))


def trigram_query(pattern: str) -> Query:
    """The trigrams (lower case) that every match of ``pattern`` must contain; no clauses if there are none.

    Literal stretches are multiplied out over alternatives and optional literals; anything else ends a stretch.
    """
    clauses: Query = []

    def close(stretch: list[str]) -> list[str]:
        if stretch and all(len(s) >= 3 for s in stretch):
            clauses.append([trigrams(s) for s in sorted(set(stretch))])
        return [""]

    def literals(items) -> list[str] | None:
        """All strings that ``items`` can be, or None if they are not a short list."""
        out = [""]
        for op, arg in items:
            name = str(op)
            if name == "LITERAL":
                more = [chr(arg).lower()]
            elif name == "SUBPATTERN":
                more = literals(arg[3])
            elif name == "BRANCH":
                options = [literals(option) for option in arg[1]]
                more = None if any(o is None for o in options) else [s for o in options for s in o]
            elif name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT") and arg[0] == arg[1]:
                inner = literals(arg[2])
                more = [inner[0] * arg[0]] if inner and len(inner) == 1 and arg[0] <= 8 else None
            elif name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT") and (arg[0], arg[1]) == (0, 1):
                inner = literals(arg[2])
                more = None if inner is None or all(len(x) != 1 or not x.isalnum() and x != "_" for x in inner) else ["", *inner]
            else:
                more = None
            if more is None or len(out) * len(more) > _MOST_STRINGS:
                return None
            out = [a + b for a in out for b in more]
        return out

    def walk(items) -> None:
        stretch = [""]
        for item in items:
            more = literals([item])
            if more is not None and len(stretch) * len(more) <= _MOST_STRINGS:
                stretch = [a + b for a in stretch for b in more]
                continue
            stretch = close(stretch)
            op, arg = str(item[0]), item[1]
            if op == "SUBPATTERN":
                walk(arg[3])
            elif op.endswith("REPEAT") and arg[0] >= 1:
                walk(arg[2])
        close(stretch)

    walk(regex_parser.parse(pattern))
    return clauses


def query_trigrams(rules: Sequence[Rule]) -> list[str]:
    return sorted({g for rule in rules for clause in trigram_query(rule.pattern) for alternative in clause for g in alternative})


def trigram_index(docs: DataFrame, grams: Sequence[str], text: str = "text") -> DataFrame:
    """Postings (gram, text_key) for the given trigrams, one per distinct text. Stored, by gram."""
    lower = docs.select(text_key(text).alias("text_key"), F.lower(text).alias("_lower")).where(F.length("_lower") >= 3)
    held = F.array_compact(F.array(*[F.when(F.contains("_lower", F.lit(g)), F.lit(i)) for i, g in enumerate(grams)]))
    postings = lower.select("text_key", F.explode(held).alias("gram"))
    return staged(postings.groupBy("gram", "text_key").agg(F.count(F.lit(1)).alias("_copies")).select("gram", "text_key"), "postings")


def candidates(index: DataFrame, grams: Sequence[str], rules: Sequence[Rule]) -> DataFrame:
    """(text_key, rules): the postings of each text brought together, and the rules whose Boolean query they fulfil."""
    number = {g: i for i, g in enumerate(grams)}
    held = index.groupBy("text_key").agg(F.collect_set("gram").alias("_held"))  # at most the trigrams of the rules

    def fulfilled(query: Query) -> Column:
        every = F.lit(True)
        for clause in query:
            some = F.lit(False)
            for alternative in clause:
                some = some | F.forall(F.array(*[F.lit(number[g]) for g in sorted(alternative)]), lambda g: F.array_contains("_held", g))
            every = every & some
        return every

    names = [F.when(fulfilled(query), F.lit(rule.name)) for rule in rules if (query := trigram_query(rule.pattern))]
    return held.select("text_key", F.array_compact(F.array(*names)).alias("_rules")).where(F.size("_rules") > 0)


def secret_spans(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """``_doc`` (the whole row as a struct) and ``found``: array<struct<start, kind_no, end, kind>>, ordered by start, then by the order of the rules."""
    grams = query_trigrams(rules)
    wanted = candidates(trigram_index(docs, grams, text), grams, rules).withColumnRenamed("text_key", "_for")
    whole = F.coalesce(F.col("_doc").getField(text), F.lit(""))
    joined = packed(docs).withColumn("_key", text_key(whole)).join(wanted, F.col("_key") == F.col("_for"), "left")
    none = F.expr("CAST(array() AS array<struct<start:int,kind_no:int,end:int,kind:string>>)")

    def spans(number: int, rule: Rule) -> Column:
        kept = F.filter(find_spans(whole, SEARCHED.get(rule.name, rule.pattern)), lambda m: rule.keep(m["value"]))
        out = F.transform(kept, lambda m: F.struct(m["start"].alias("start"), F.lit(number).alias("kind_no"), m["end"].alias("end"),
                                                   F.lit(rule.name).alias("kind")))
        if not trigram_query(rule.pattern):
            return out
        return F.when(F.array_contains("_rules", F.lit(rule.name)), out).otherwise(none)

    found = F.sort_array(F.concat(none, *[spans(i, rule) for i, rule in enumerate(rules)]))
    return joined.select("_doc", found.alias("found"))


def redact(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES, mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every found span replaced by ``mask`` (overlapping spans by one); ``n_chars``, if there, follows."""
    found = secret_spans(docs, text, rules)
    whole = F.col("_doc").getField(text)
    start = F.struct(F.lit(0).alias("at"), F.expr("CAST(array() AS array<string>)").alias("out"))

    def step(acc: Column, m: Column) -> Column:
        ahead = F.array(F.substring(whole, acc["at"] + 1, m["start"] - acc["at"]), F.lit(mask))
        return F.when(m["end"] <= acc["at"], acc).otherwise(F.struct(
            m["end"].alias("at"), F.when(m["start"] < acc["at"], acc["out"]).otherwise(F.concat(acc["out"], ahead)).alias("out")))

    masked = F.aggregate("found", start, step, lambda acc: F.array_join(
        F.concat(acc["out"], F.array(F.substring(whole, acc["at"] + 1, F.length(whole)))), ""))
    out = found.withColumn("_new", F.when(F.size("found") == 0, whole).otherwise(masked))
    return out.select(*unpacked(docs.columns, **{text: F.col("_new"), **new_length(docs, F.col("_new"), F.size("found") > 0)}))


def _written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda m: F.concat_ws(":", m["kind"], m["start"].cast("string"), m["end"].cast("string"))), ",")


def _count_of(name: str) -> Column:
    return F.size(F.filter("found", lambda m: m["kind"] == name)).cast("long")


@llm_query("op6_trigram_secrets")
def op6_trigram_secrets(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    base = [rule.name for rule in RULES if rule.base]
    counts = [_count_of(name).alias(f"n_{name}") for name in base]
    return secret_spans(docs).select(
        "_doc.doc_id", *counts, F.sha2(_written(F.filter("found", lambda m: m["kind"].isin(base))), 256).alias("base_sha256"),
        _written(F.col("found")).alias("spans"))

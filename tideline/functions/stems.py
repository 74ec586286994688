"""Word stems by published suffix rules, as column expressions: no Python, no dictionary.

The rules are those of the well-known English suffix stripper (Porter, 1980). A word is taken through its steps one after the other; in each
step the longest suffix that fits decides, and is replaced if what stands before it is long enough.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# What a stem must look like, as expressions over its letters (y is a vowel behind a consonant).
_C, _V = "[^aeiou][^aeiouy]*", "[aeiouy][aeiou]*"
_HEAD = f"^(?:{_C}{_V}|[aeiou]+)"                # up to the end of the first vowels
SOME = f"{_HEAD}{_C}"                            # at least one vowel-consonant pair
ONE = f"{_HEAD}{_C}(?:{_V})?$"                   # exactly one
TWO = f"{_HEAD}{_C}{_V}{_C}"                     # at least two
TWO_ST = f"{_HEAD}{_C}{_V}.*[st]$"               # at least two, and an s or t at the end
VOWEL = f"^(?:{_C}[aeiouy]|[aeiou])"             # any vowel
SHORT = f"^{_C}[aeiouy][^aeiouwxy]$"             # consonant, vowel, consonant
ANY = ""

# The steps, each a list of (suffix, replacement, condition on the stem).
PLURALS = (("sses", "ss", ANY), ("ies", "i", ANY), ("ss", "ss", ANY), ("s", "", ANY))
PAST = (("eed", "ee", SOME), ("ing", "", VOWEL), ("ed", "", VOWEL))
Y = (("y", "i", VOWEL),)
DOUBLE_SUFFIXES = tuple((a, b, SOME) for a, b in (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"), ("abli", "able"), ("alli", "al"), ("entli", "ent"),
    ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"),
    ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble")))
SUFFIXES = tuple((a, b, SOME) for a, b in (
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", "")))
ENDINGS = tuple((a, "", TWO) for a in (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ou", "ism", "ate", "iti", "ous", "ive", "ize")) + (("ion", "", TWO_ST),)
# After -ed or -ing has gone, these ends get their e back, and other doubled consonants lose one.
RESTORED = ("at", "bl", "iz")
DOUBLED = "([^aeiouylsz])\\1$"


def longest_first(rules):
    return sorted(rules, key=lambda rule: (-len(rule[0]), rule[0]))


def _fits(stem: Column, condition: str) -> Column:
    return F.rlike(stem, F.lit(condition)) if condition else F.lit(True)


def _first(cases: list[tuple[Column, Column]], otherwise: Column) -> Column:
    return reduce(lambda rest, case: F.when(case[0], case[1]).otherwise(rest), reversed(cases), otherwise)


def _cut(word: Column, n: int) -> Column:
    return F.substring(word, F.lit(1), F.length(word) - n)


def _apply(word: Column, rules) -> Column:
    """The longest suffix that fits decides, also by leaving the word alone."""
    return _first([(F.endswith(word, F.lit(suffix)), F.when(_fits(_cut(word, len(suffix)), condition), F.concat(_cut(word, len(suffix)), F.lit(new))).otherwise(word))
                   for suffix, new, condition in longest_first(rules)], word)


def _past(word: Column) -> Column:
    """Like ``_apply``, with a mark behind a word that has lost -ed or -ing, for the repair that follows."""
    cases = []
    for suffix, new, condition in longest_first(PAST):
        stem = _cut(word, len(suffix))
        changed = F.concat(stem, F.lit(new if new else "+"))
        cases.append((F.endswith(word, F.lit(suffix)), F.when(_fits(stem, condition), changed).otherwise(word)))
    return _first(cases, word)


def _repair(word: Column) -> Column:
    stem = F.rtrim(word, F.lit("+"))
    mended = _first([(reduce(lambda a, b: a | b, [F.endswith(stem, F.lit(end)) for end in RESTORED]), F.concat(stem, F.lit("e"))),
                     (F.rlike(stem, F.lit(DOUBLED)), _cut(stem, 1)),
                     (_fits(stem, ONE) & _fits(stem, SHORT), F.concat(stem, F.lit("e")))], stem)
    return F.when(F.endswith(word, F.lit("+")), mended).otherwise(word)


def _last_e(word: Column) -> Column:
    stem = _cut(word, 1)
    return F.when(F.endswith(word, F.lit("e")) & (_fits(stem, TWO) | (_fits(stem, ONE) & ~_fits(stem, SHORT))), stem).otherwise(word)


def _last_l(word: Column) -> Column:
    return F.when(F.endswith(word, F.lit("ll")) & _fits(word, TWO), _cut(word, 1)).otherwise(word)


STEPS = (lambda w: _apply(w, PLURALS), _past, _repair, lambda w: _apply(w, Y), lambda w: _apply(w, DOUBLE_SUFFIXES), lambda w: _apply(w, SUFFIXES),
         lambda w: _apply(w, ENDINGS), _last_e, _last_l)


def stems(words: Column | str) -> Column:
    """The stems of an array of lower-case words; words under three letters or with other letters than a-z stay as they are.

    Every step is a pass over the array, so no step's expression is repeated in the next.
    """
    words = F.col(words) if isinstance(words, str) else words
    marked = F.transform(words, lambda w: F.struct(w.alias("w"), F.rlike(w, F.lit("^[a-z]{3,}$")).alias("ok")))
    for step in STEPS:
        marked = F.transform(marked, _where_ok(step))
    return F.transform(marked, lambda s: s["w"])


def _where_ok(step):
    return lambda s: F.struct(F.when(s["ok"], step(s["w"])).otherwise(s["w"]).alias("w"), s["ok"].alias("ok"))

"""Column expressions on text. Row-local: no shuffle, no Python."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The cleaning patterns. Java needs spelled-out classes to treat letters of all scripts alike.
URL = r"(?U)http\S+"
NON_WORD = r"[^\p{L}\p{N}_]"
SHORT_WORD = r"(?<![\p{L}\p{N}_])[\p{L}\p{N}_]{1,2}(?![\p{L}\p{N}_])"
WORD = r"[\p{L}\p{N}_]+"
ALPHABETIC = r"^\p{L}+$"


def clean_text(text: Column | str) -> Column:
    """Without URLs, special characters and one- or two-letter words; lower case; trimmed."""
    text = F.col(text) if isinstance(text, str) else text
    out = F.regexp_replace(text, URL, "")
    out = F.regexp_replace(out, NON_WORD, " ")
    out = F.regexp_replace(out, SHORT_WORD, "")
    return F.trim(F.lower(out))


def words(text: Column | str) -> Column:
    """All words, lower case, in order."""
    return F.regexp_extract_all(F.lower(F.col(text) if isinstance(text, str) else text), F.lit(WORD), 0)


def keywords(text: Column | str, stop_words: Sequence[str]) -> Column:
    """T4: alphabetic words that are no stop words (a list of a few hundred, looked up in a hash set)."""
    alphabetic = F.filter(words(text), lambda w: F.rlike(w, F.lit(ALPHABETIC)))
    return F.filter(alphabetic, lambda w: ~w.isin(*stop_words)) if stop_words else alphabetic


def ensemble_score(scores: dict[str, float]) -> Column:
    """Weighted mean of score columns, weights normalised."""
    total = sum(scores.values())
    out = F.lit(0.0)
    for name, weight in scores.items():
        out = out + F.col(name) * (weight / total)
    return out


def confidence(scores: Sequence[str], method: str = "std") -> Column:
    """Agreement of the scores: 1 - range, or (for any other method) 1 - population deviation."""
    columns = [F.col(c).cast("double") for c in scores]
    if method == "range":
        return 1 - (F.greatest(*columns) - F.least(*columns))
    mean = sum(columns[1:], columns[0]) / len(columns)
    squares = [(c - mean) * (c - mean) for c in columns]
    return 1 - F.sqrt(sum(squares[1:], squares[0]) / len(columns))

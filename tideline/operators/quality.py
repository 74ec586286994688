"""Validation, filters, casts and small projections."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.expr import ratio, safe_corr
from tideline.operators.matching import contains_pattern


def schema_differences(df: DataFrame, expected: Mapping[str, str | T.DataType]) -> list[str]:
    """What is missing or of another type. Types are names like 'double' or 'numeric', or Spark types."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for name, wanted in expected.items():
        if name not in actual:
            out.append(f"{name}: missing")
        elif isinstance(wanted, T.DataType):
            if actual[name] != wanted:
                out.append(f"{name}: {actual[name].simpleString()}, expected {wanted.simpleString()}")
        elif wanted == "numeric":
            if not isinstance(actual[name], T.NumericType):
                out.append(f"{name}: {actual[name].simpleString()}, expected a number")
        elif actual[name].simpleString() != wanted:
            out.append(f"{name}: {actual[name].simpleString()}, expected {wanted}")
    return out


def schema_matches(df: DataFrame, expected: Mapping[str, str | T.DataType]) -> bool:
    """Whether all expected columns exist with the expected types."""
    return not schema_differences(df, expected)


def validate_schema(df: DataFrame, required: Iterable[str] = (), types: Mapping[str, str | T.DataType] | None = None,
                    allow_empty: bool = False) -> DataFrame:
    """Return ``df`` or raise; reads at most one row (to see that there is one)."""
    problems = [f"{c}: missing" for c in required if c not in df.columns]
    problems += schema_differences(df, types or {})
    if problems:
        raise ValueError("invalid table: " + "; ".join(problems))
    if not allow_empty and df.isEmpty():
        raise ValueError("invalid table: no rows")
    return df


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Numeric columns in schema order."""
    left_out = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in left_out]


def contains_any(text: Column | str, keywords: Sequence[str]) -> Column:
    """Some keyword occurs in the text, whatever the case."""
    lowered = F.lower(F.col(text) if isinstance(text, str) else text)
    return F.exists(F.array(*[F.lit(k.lower()) for k in keywords]), lambda k: F.contains(lowered, k))


def keyword_filter(df: DataFrame, columns: Sequence[str], keywords: Sequence[str] | DataFrame) -> DataFrame:
    """Keep rows where some keyword occurs in the joined columns.

    A short list is compared word by word; a table (column ``keyword``) of any length becomes an automaton, one walk per text.
    """
    joined = F.concat_ws(" ", *columns)
    return df.where(contains_pattern(joined, keywords) if isinstance(keywords, DataFrame) else contains_any(joined, keywords))


def datetime_features(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Day of week (Monday = 0), hour, month, day of month."""
    return df.withColumns({"day_of_week": F.weekday(ts), "hour": F.hour(ts), "month": F.month(ts),
                           "day": F.dayofmonth(ts)})


def quality_report(df: DataFrame, columns: Sequence[str] | None = None, non_negative: Sequence[str] = (),
                   anomaly: str | None = None) -> DataFrame:
    """P5: missing values, negatives (on columns declared non-negative) and flagged anomalies, in one aggregation."""
    columns = list(columns or df.columns)
    counts = {("missing", c): F.count_if(F.col(c).isNull()) for c in columns}
    counts |= {("negative", c): F.count_if(F.col(c) < 0) for c in non_negative}
    if anomaly:
        counts["anomaly", anomaly] = F.count_if(F.col(anomaly))
    measured = df.agg(*[c.alias(f"_{i}") for i, c in enumerate(counts.values())])
    lines = [F.struct(F.lit(check).alias("check"), F.lit(c).alias("column"), F.col(f"_{i}").alias("n_failed"),
                      (F.col(f"_{i}") == 0).alias("passed")) for i, (check, c) in enumerate(counts)]
    return measured.select(F.inline(F.array(*lines)))


def price_sentiment(df: DataFrame, neutral: float = 0.1, weights: tuple[float, float] = (0.6, 0.4)) -> DataFrame:
    """Price change and sentiment in one score; weak sentiment counts as none."""
    df = df.where(F.col("open") > 0)
    df = df.withColumn("price_change", F.col("close") - F.col("open"))
    df = df.withColumns({
        "price_change_pct": ratio("price_change", "open"),
        "filtered_sentiment": F.when(F.abs("sentiment") > neutral, F.col("sentiment")).otherwise(0.0)})
    return df.withColumn("combined_sentiment", weights[0] * F.col("filtered_sentiment")
                         + weights[1] * F.col("price_change_pct"))


def sentiment_price_correlation(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*keys).agg(safe_corr("combined_sentiment", "price_change_pct").alias("correlation"))


def drop_incomplete(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Rows without NULL in the given columns."""
    return df.na.drop(subset=list(subset) if subset else None)


def clean_casts(df: DataFrame, text: Sequence[str] = (), score: Sequence[str] = (), number: Sequence[str] = (),
                time: Sequence[str] = ()) -> DataFrame:
    """Text NULL -> '', scores to double with NULL -> 0, numbers and times to their types or NULL."""
    return df.withColumns({
        **{c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in text},
        **{c: F.coalesce(F.col(c).try_cast("double"), F.lit(0.0)) for c in score},
        **{c: F.col(c).try_cast("double") for c in number},
        **{c: F.col(c).try_cast("timestamp") for c in time}})


def date_range_slice(df: DataFrame, ts: str, as_of: date, period: str = "previous_year") -> DataFrame:
    """The calendar year before ``as_of``, or its own year up to that day. Constant bounds, pushed to the scan."""
    if period == "previous_year":
        start, end = date(as_of.year - 1, 1, 1), date(as_of.year, 1, 1)
        return df.where((F.col(ts) >= F.lit(start)) & (F.col(ts) < F.lit(end)))
    if period == "year_to_date":
        return df.where((F.col(ts) >= F.lit(date(as_of.year, 1, 1))) & (F.col(ts) < F.date_add(F.lit(as_of), 1)))
    raise ValueError("period is 'previous_year' or 'year_to_date'")


def source_tag(df: DataFrame, text: str = "text", known: str | None = None) -> DataFrame:
    """Where a post came from, judged by its text unless a column says so."""
    guess = F.when(F.contains(F.col(text), F.lit("twitter.com")), "twitter").otherwise("reddit")
    return df.withColumn("source", F.coalesce(F.col(known), guess) if known else guess)

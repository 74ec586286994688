"""Whole flows: the operators in the order in which a user runs them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions import text as tx
from tideline.operators import bars, features, graph, indicators, joins, models, onchain, patterns, quality, text
from tideline.series import SeriesSpec, equi_join
from tideline.sources import payloads, scans
from tideline.staging import stage

# Keys of posts that are broadcast together.
KEYS_OF_A_BLOCK = 1_000_000


def quote_flow(raw: DataFrame, symbol: Column | str = "symbol", ts: str = "ts", order: Sequence[str] = (), interval: str = "1 hour", base: float = 0.01,
               min_fraction: float = 0.5, path: str | None = None) -> DataFrame:
    """Landed quote messages to validated bars with indicators and patterns.

    Messages are parsed (S6); every source's messages of an interval become a bar (A0); the sources' bars of an interval are compared, and
    where enough of them agree they become one (A4); on the series of these come moving means, RSI, Bollinger bands and MACD (W2-W4, W6), chart and
    candlestick patterns (W11, W12). Intervals without agreement are left out, as no price is known there. With ``path`` the result is stored (S3).
    """
    name = F.col(symbol) if isinstance(symbol, str) else symbol
    quotes = payloads.normalize_quotes(raw, name).withColumn("symbol", name)
    per_source = SeriesSpec(("symbol", "source"), ts, tuple(order))
    own = bars.ohlcv_bars(quotes, per_source, interval, price="close", volume="volume")
    agreed = onchain.consensus_price(own.select("symbol", "source", "ts", *payloads.FIELDS), ["symbol", "ts"], base=base, min_fraction=min_fraction)
    series = SeriesSpec(("symbol",), "ts")
    out = agreed.where("valid").drop("valid")
    for step in (indicators.moving_averages, indicators.rsi, indicators.bollinger, indicators.macd):
        out = step(out, series)
    out = patterns.candlestick_patterns(patterns.chart_patterns(out, series), series)
    if path is not None:
        scans.save_table(out, path, if_exists="append")
        return out.sparkSession.read.schema(out.schema).parquet(path)
    return out


def distinct_texts(keyed: DataFrame, key: str, text_column: str) -> DataFrame:
    """(_text, raw): every text of ``keyed`` once.

    One post stands for each text, found by its key; only the texts of these posts are sorted and shuffled, not one per post. The keys are
    broadcast in blocks of bounded size, with one pass over the posts per block.
    """
    first = stage(keyed.groupBy("_text").agg(F.min(key).alias("_first")).select("_first"), "first")
    number = max(1, -(-first.count() // KEYS_OF_A_BLOCK))
    blocks = [first.where(F.pmod(F.xxhash64("_first"), F.lit(number)) == i) for i in range(number)]
    chosen = [keyed.join(F.broadcast(block), F.col(key).eqNullSafe(F.col("_first")), "left_semi") for block in blocks]
    return reduce(DataFrame.unionByName, chosen).groupBy("_text").agg(F.any_value(text_column).alias("raw"))


def text_flow(posts: DataFrame, market: DataFrame, lexicon: DataFrame, gazetteer: DataFrame, key: str, text_column: str, posts_ts: str, market_ts: str,
              by: Sequence[str], negators: Sequence[str] = text.NEGATORS, window: str = "1 hour") -> tuple[DataFrame, DataFrame]:
    """Posts with their texts to two tables: per post, and per window.

    Texts are cleaned (T1), scored (T2) and searched for entities (T5), each distinct text once, however many posts share it. Every post gets the
    market's price at its time (J1); per window and ``by`` come mean sentiment and number of posts (A6).
    """
    text_key = F.xxhash64(F.coalesce(F.col(text_column), F.lit("")), F.col(text_column).isNull(), F.length(text_column))
    keyed = posts.withColumn("_text", text_key)
    texts = stage(distinct_texts(keyed, key, text_column).withColumn("cleaned", tx.clean_text("raw")), "texts")
    scored = text.lexicon_sentiment(texts, "_text", "raw", lexicon, negators)
    named = text.match_entities(texts, "_text", "raw", gazetteer).groupBy("_text").agg(F.count(F.lit(1)).alias("n_mentions"), F.count_distinct("phrase").alias("n_entities"))
    measured = texts.select("_text", F.length("cleaned").alias("cleaned_length")).join(scored, "_text").join(named, "_text", "left")
    measured = measured.withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in ("n_mentions", "n_entities")})
    joined = keyed.drop(text_column).join(stage(measured, "measured"), "_text").drop("_text")
    priced = stage(joins.asof_join(joined, market, posts_ts, market_ts, list(by), prefix="market_"), "priced")
    return priced, text.tumbling_sentiment(priced, posts_ts, window, by)


def impact_of_texts(priced: DataFrame, counters: Sequence[str] = ("sentiment", "n_entities"), price: str = "market_close") -> DataFrame:
    """G3 on the posts of ``text_flow``: what a linear model makes of their measures for the price."""
    return graph.fit_impact(priced, counters, price)[0]


class QualityError(ValueError):
    """A table that does not pass the gate; the failed checks are its message."""


def prepare_flow(base: DataFrame, others: Mapping[str, DataFrame], spec: SeriesSpec, impute: Sequence[str], non_negative: Sequence[str] = (),
                 lag_columns: Sequence[str] = ("close", "volume"), steps: Sequence[int] = (1, 2), share: float = 0.8, **imputation) -> tuple[DataFrame, DataFrame]:
    """Tables to a training frame and its report.

    Tables are joined on key and time (J2), gaps are filled (M1), and the result must pass the gate (P5: no gap in a filled column, no negative where
    none may be), else ``QualityError``. Then come lags (F1) and the time split (M14); the report counts missing cells per column and part.
    """
    merged = joins.merge_on_time(base, others, [*spec.keys, spec.ts])
    filled = stage(models.impute_iterative(merged, impute, **imputation), "filled")
    failed = quality.quality_report(filled, impute, non_negative).where("NOT passed").collect()
    if failed:
        raise QualityError("; ".join(f"{r['check']} {r['column']}: {r['n_failed']}" for r in failed))
    lagged = features.lags(filled, spec, lag_columns, steps)
    split = stage(features.split_time(lagged, spec, share=share), "split")
    added = [f"{c}_lag_{k}" for c in lag_columns for k in steps]
    counts = split.groupBy("is_train").agg(F.count(F.lit(1)).alias("n_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in added])
    report = counts.select("is_train", "n_rows", F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n_missing")) for c in added])))
    return split, report

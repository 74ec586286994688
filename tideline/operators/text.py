"""Sentiment, keywords, entities and topics of text tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.functions import text as tx
from tideline.functions.stems import stems
from tideline.operators.matching import match_phrases
from tideline.operators.topics import fit_topics

# Normalisation constant and negation factor of the published rule-based scorer.
SCORE_ALPHA = 15.0
NEGATION = -0.74
NEGATORS = ("not", "no", "never", "none", "nor", "cannot", "without")


def lexicon_sentiment(df: DataFrame, key: str, text: str, lexicon: DataFrame,
                      negators: Sequence[str] = NEGATORS) -> DataFrame:
    """(key, n_hits, sentiment) for every row of ``df``.

    Words meet their valence in a lexicon table (token, valence); a negator just before a word turns it around; the
    sum s becomes s / sqrt(s^2 + 15). Each word carries its predecessor out of the row, so no window is needed, and
    with a broadcast lexicon the sums are combined inside the task that read the text.
    """
    tokens = tx.words(text)
    before = F.array_insert(tokens, 1, F.lit(""))
    pairs = F.filter(F.arrays_zip(tokens.alias("token"), before.alias("before")), lambda p: p["token"].isNotNull())
    exploded = df.select(key, F.explode(pairs).alias("_p")).select(
        key, F.col("_p.token").alias("token"), F.col("_p.before").isin(*negators).alias("_negated"))
    joined = exploded.join(lexicon.select("token", "valence"), "token")
    hits = joined.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_hits"),
        F.sum(F.when(F.col("_negated"), F.col("valence") * NEGATION).otherwise(F.col("valence"))).alias("_s"))
    scored = df.select(key).join(hits, key, "left")
    s = F.coalesce(F.col("_s"), F.lit(0.0))
    return scored.select(key, F.coalesce("n_hits", F.lit(0)).alias("n_hits"),
                         (s / F.sqrt(s * s + SCORE_ALPHA)).alias("sentiment"))


def default_stop_words() -> list[str]:
    return StopWordsRemover.loadDefaultStopWords("english")


def extract_keywords(df: DataFrame, text: str, custom: Sequence[str] = (), replace: bool = False,
                     lemmas: DataFrame | None = None, key: str | None = None, stem: bool = False) -> DataFrame:
    """Add ``keywords``; custom stop words extend or replace the default list.

    With ``stem`` the keywords are replaced by their stems. With a dictionary table (word, lemma) they are replaced by their lemmas, which needs a
    ``key``; with both, words that the dictionary does not know become stems.
    """
    stops = list(custom) if replace else [*default_stop_words(), *custom]
    df = df.withColumn("keywords", tx.keywords(text, sorted(set(stops))))
    if stem and lemmas is None:
        return df.withColumn("keywords", stems("keywords"))
    if lemmas is None:
        return df
    if key is None:
        raise ValueError("lemmas need the name of a key column")
    found = df.select(key, F.posexplode("keywords").alias("_pos", "word"))
    found = found.join(lemmas, "word", "left")
    unknown = stems(F.array("word"))[0] if stem else F.col("word")
    lemma = F.struct("_pos", F.coalesce(F.col("lemma"), unknown).alias("w"))
    rebuilt = found.groupBy(key).agg(F.transform(F.sort_array(F.collect_list(lemma)), lambda s: s["w"]).alias("keywords"))
    return (df.drop("keywords").join(rebuilt, key, "left")
            .withColumn("keywords", F.coalesce("keywords", F.array().cast("array<string>"))))


def match_entities(df: DataFrame, key: str, text: str, gazetteer: DataFrame) -> DataFrame:
    """T5: (key, position, phrase, label) for every phrase listed in a gazetteer table, however many words or phrases there are."""
    return match_phrases(df, key, text, gazetteer)


def entity_sets(mentions: DataFrame, key: str, entity: str = "phrase") -> DataFrame:
    """The distinct entities of each document (at most one per gazetteer line)."""
    return mentions.groupBy(key).agg(F.sort_array(F.collect_set(entity)).alias("entities"))


def tumbling_sentiment(posts: DataFrame, ts: str = "created_at", window: str = "1 hour", by: Sequence[str] = ("source",),
                       value: str = "sentiment") -> DataFrame:
    """Mean sentiment per window and source. The same plan on tables and watermarked streams."""
    out = posts.groupBy(F.window(ts, window).alias("_w"), *by).agg(
        F.avg(value).alias("avg_sentiment"), F.count(value).alias("n_posts"))
    return out.select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), *by,
                      "avg_sentiment", "n_posts")


def sentiment_volatility(df: DataFrame, by: Sequence[str] = (), value: str = "sentiment") -> DataFrame:
    """Sample deviation of the sentiments."""
    return df.groupBy(*by).agg(F.stddev_samp(value).alias("volatility"), F.count(value).alias("n"))


def topic_model(df: DataFrame, text: str, topics: int = 5, passes: int = 10, words_per_topic: int = 5,
                min_documents: float = 1.0, custom: Sequence[str] = (), seed: int = 7):
    """One model for the whole corpus: (topic, rank, word, weight), and the model.

    Every pass of the online learner reads every document, and every word in ``min_documents`` documents is in the
    vocabulary, which stays a table. The learner reads the tokenised corpus once, into blocks that it stores and passes over repeatedly.
    """
    model = fit_topics(extract_keywords(df, text, custom).select("keywords"), "keywords", topics, passes, min_documents, seed)
    return model.describe(words_per_topic), model

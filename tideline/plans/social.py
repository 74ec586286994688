"""Text, sentiment, entities, graphs and posts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tideline.functions import stems as st
from tideline.functions import text as tx
from tideline.operators import features, graph, risk, text
from tideline.plans.inputs import BARS_SQL, TICKS_SQL, bars, documents, over, r, roll, table, ticks, tidy
from tideline.plans.registry import query
from tideline.series import over_chunks

WORD = r"[\p{L}\p{N}_]+"


@query("t1_clean_text", r"""WITH a AS (SELECT doc_id, regexp_replace(regexp_replace(text, 'http[^\s\p{Z}\x{0B}\x{1C}-\x{1F}\x{85}]+', '', 'g'), '[^\p{L}\p{N}_]', ' ', 'g') AS t FROM documents),
  b AS (SELECT doc_id, trim(lower(array_to_string(list_transform(string_split(t, ' '), lambda w: CASE WHEN length(w) IN (1, 2) THEN '' ELSE w END), ' ')), ' ') AS c FROM a)
  SELECT doc_id, md5(c) AS cleaned_md5, CAST(length(c) AS INTEGER) AS n_chars FROM b""")
def t1_clean_text(spark, sf):
    docs = documents(spark, sf).select("doc_id", tx.clean_text("text").alias("cleaned"))
    return docs.select("doc_id", F.md5("cleaned").alias("cleaned_md5"), F.length("cleaned").alias("n_chars"))


def lexicon(spark, sf):
    """A valence for every word of the benchmark passages, by its length: a stand-in for a lexicon table."""
    words = table(spark, sf, "benchmark").select(F.explode(tx.words("text")).alias("token")).distinct()
    return words.withColumn("valence", (F.length("token") % 7 - 3).cast("double")).where("valence <> 0")


LEXICON_SQL = rf"""lex AS (SELECT token, CAST(length(token) % 7 - 3 AS DOUBLE) AS valence FROM
   (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '{WORD}')) AS token FROM benchmark) WHERE length(token) % 7 <> 3)"""


def sentiment_sql(source: str, key: str, name: str = "sent", negators: str = "'not', 'in', 'no'") -> str:
    return rf"""{name}_t AS (SELECT {key}, regexp_extract_all(lower(text), '{WORD}') AS toks FROM {source}),
{name}_u AS (SELECT {key}, unnest(toks) AS token, unnest(list_concat([''], toks[:-2])) AS before FROM {name}_t),
{name}_h AS (SELECT {key}, count(*) AS n_hits, sum(CASE WHEN before IN ({negators}) THEN valence * -0.74 ELSE valence END) AS s
   FROM {name}_u JOIN lex USING (token) GROUP BY {key}),
{name} AS (SELECT d.{key}, coalesce(n_hits, 0) AS n_hits, coalesce(s, 0) / sqrt(coalesce(s, 0) * coalesce(s, 0) + 15) AS sentiment
   FROM {source} d LEFT JOIN {name}_h h ON h.{key} = d.{key})"""


NEGATORS = ("not", "in", "no")


def document_sentiment(spark, sf):
    return text.lexicon_sentiment(documents(spark, sf), "doc_id", "text", lexicon(spark, sf), NEGATORS)


@query("t2_lexicon_sentiment", f"WITH {LEXICON_SQL}, {sentiment_sql('documents', 'doc_id')} SELECT doc_id, n_hits, {r('sentiment')} FROM sent")
def t2_lexicon_sentiment(spark, sf):
    return tidy(document_sentiment(spark, sf))


_SCORES = "quality * 2 - 1 AS a, 1 - toxic * 2 AS b, (n_chars % 200) / 100.0 - 1 AS c"


@query("t3_ensemble_score", f"""WITH s AS (SELECT doc_id, {_SCORES} FROM labels JOIN documents USING (doc_id)),
  m AS (SELECT *, (a + b + c) / 3.0 AS m FROM s)
  SELECT doc_id, {r('(a * 1.0 + b * 1.0 + c * 2.0) / 4 AS score', '1 - sqrt(((a - m) ** 2 + (b - m) ** 2 + (c - m) ** 2) / 3) AS confidence_std',
     '1 - (greatest(a, b, c) - least(a, b, c)) AS confidence_range')} FROM m""")
def t3_ensemble_score(spark, sf):
    """Three model scores per labelled document: quality, absence of toxicity, and one from its length."""
    s = table(spark, sf, "labels").join(documents(spark, sf).select("doc_id", "n_chars"), "doc_id")
    s = s.select("doc_id", (F.col("quality") * 2 - 1).cast("double").alias("a"), (1 - F.col("toxic") * 2).cast("double").alias("b"),
                 ((F.col("n_chars") % 200) / 100 - 1).alias("c"))
    return tidy(s.select("doc_id", tx.ensemble_score({"a": 1.0, "b": 1.0, "c": 2.0}).alias("score"),
                         tx.confidence(["a", "b", "c"]).alias("confidence_std"),
                         tx.confidence(["a", "b", "c"], "range").alias("confidence_range")))


STOPS = ("the", "of", "and", "to", "in", "is", "for", "on", "with", "that")
_STOPS_SQL = ", ".join(f"'{w}'" for w in STOPS)


def keywords_sql(source: str, keys: str) -> str:
    return rf"""SELECT {keys}, list_filter(regexp_extract_all(lower(text), '{WORD}'),
      lambda w: regexp_full_match(w, '\p{{L}}+') AND NOT list_contains([{_STOPS_SQL}], w)) AS kw FROM {source}"""


@query("t4_keywords", f"""WITH k AS ({keywords_sql('documents', 'doc_id')})
  SELECT doc_id, CAST(len(kw) AS INTEGER) AS n_keywords, md5(array_to_string(kw, ' ')) AS keywords_md5 FROM k""")
def t4_keywords(spark, sf):
    k = text.extract_keywords(documents(spark, sf), "text", STOPS, replace=True)
    return k.select("doc_id", F.size("keywords").alias("n_keywords"), F.md5(F.array_join("keywords", " ")).alias("keywords_md5"))


@query("t7_batch_preprocess", f"""WITH k AS ({keywords_sql('conversations', 'conv_id, turn')})
  SELECT conv_id, turn, CAST(len(kw) AS INTEGER) AS n_keywords, md5(array_to_string(kw, ' ')) AS keywords_md5 FROM k""")
def t7_batch_preprocess(spark, sf):
    k = text.extract_keywords(table(spark, sf, "conversations"), "text", STOPS, replace=True)
    return k.select("conv_id", "turn", F.size("keywords").alias("n_keywords"), F.md5(F.array_join("keywords", " ")).alias("keywords_md5"))


def stem_sql(words: str) -> str:
    """The stems of a list of words, step by step, from the rule tables."""
    def fits(stem: str, condition: str) -> str:
        return f"regexp_matches({stem}, '{condition}')" if condition else "TRUE"

    def rules(table, mark: str = "") -> str:
        cases = " ".join(f"""WHEN suffix(w, '{old}') THEN CASE WHEN {fits(f"w[:-{len(old) + 1}]", condition)} THEN w[:-{len(old) + 1}] || '{new or mark}' ELSE w END"""
                         for old, new, condition in st.longest_first(table))
        return f"CASE {cases} ELSE w END"

    doubled = " OR ".join(f"suffix(b, '{c}{c}')" for c in "bcdfghjkmnpqrtvwx")
    repair = f"""CASE WHEN NOT suffix(w, '+') THEN w ELSE list_transform([rtrim(w, '+')], lambda b: CASE WHEN {' OR '.join(f"suffix(b, '{e}')" for e in st.RESTORED)} THEN b || 'e'
      WHEN {doubled} THEN b[:-2] WHEN {fits('b', st.ONE)} AND {fits('b', st.SHORT)} THEN b || 'e' ELSE b END)[1] END"""
    last_e = f"CASE WHEN suffix(w, 'e') AND ({fits('w[:-2]', st.TWO)} OR ({fits('w[:-2]', st.ONE)} AND NOT {fits('w[:-2]', st.SHORT)})) THEN w[:-2] ELSE w END"
    last_l = f"CASE WHEN suffix(w, 'll') AND {fits('w', st.TWO)} THEN w[:-2] ELSE w END"
    out = f"list_transform({words}, lambda w: {{'w': w, 'ok': regexp_full_match(w, '[a-z]{{3,}}')}})"
    for step in (rules(st.PLURALS), rules(st.PAST, "+"), repair, rules(st.Y), rules(st.DOUBLE_SUFFIXES), rules(st.SUFFIXES), rules(st.ENDINGS), last_e, last_l):
        out = f"list_transform({out}, lambda s: {{'w': CASE WHEN s.ok THEN list_transform([s.w], lambda w: {step})[1] ELSE s.w END, 'ok': s.ok}})"
    return f"list_transform({out}, lambda s: s.w)"


@query("t4_keyword_stems", f"""WITH k AS ({keywords_sql('documents', 'doc_id')})
  SELECT doc_id, CAST(len(kw) AS INTEGER) AS n_keywords, md5(array_to_string({stem_sql('kw')}, ' ')) AS stems_md5 FROM k""")
def t4_keyword_stems(spark, sf):
    k = text.extract_keywords(documents(spark, sf), "text", STOPS, replace=True, stem=True)
    return k.select("doc_id", F.size("keywords").alias("n_keywords"), F.md5(F.array_join("keywords", " ")).alias("stems_md5"))


def lemma_table(spark, sf):
    """A dictionary of the benchmark's longer words, each with its first half: a stand-in for a lemma table."""
    found = table(spark, sf, "benchmark").select(F.explode(tx.words("text")).alias("word")).where(F.length("word") > 5).distinct()
    return found.withColumn("lemma", F.substring("word", F.lit(1), F.floor(F.length("word") / 2).cast("int")))


@query("t7_batch_lemmas", rf"""WITH k AS ({keywords_sql('conversations', 'conv_id, turn')}),
  lem AS (SELECT DISTINCT w AS word, w[:length(w) // 2] AS lemma FROM (SELECT unnest(regexp_extract_all(lower(text), '{WORD}')) AS w FROM benchmark) WHERE length(w) > 5),
  u AS (SELECT conv_id, turn, unnest(kw) AS word, unnest(range(len(kw))) AS i FROM k), j AS (SELECT u.*, coalesce(lemma, word) AS w FROM u LEFT JOIN lem USING (word)),
  g AS (SELECT conv_id, turn, list(w ORDER BY i) AS kw FROM j GROUP BY ALL)
  SELECT k.conv_id, k.turn, CAST(coalesce(len(g.kw), 0) AS INTEGER) AS n_keywords, md5(coalesce(array_to_string(g.kw, ' '), '')) AS lemmas_md5 FROM k LEFT JOIN g USING (conv_id, turn)""")
def t7_batch_lemmas(spark, sf):
    turns = table(spark, sf, "conversations").withColumn("key", F.struct("conv_id", "turn"))
    k = text.extract_keywords(turns, "text", STOPS, replace=True, lemmas=lemma_table(spark, sf), key="key")
    return k.select("conv_id", "turn", F.size("keywords").alias("n_keywords"), F.md5(F.array_join("keywords", " ")).alias("lemmas_md5"))


def gazetteer(spark, sf):
    """Phrases of one to five words that follow "from" anywhere in a benchmark passage."""
    passages = table(spark, sf, "benchmark").select(tx.words("text").alias("w"))
    places = passages.select("w", F.posexplode("w").alias("at", "word")).where("word = 'from'")
    phrases = places.select(F.explode(F.array(*[
        F.when(F.size("w") >= F.col("at") + 1 + n, F.struct(F.array_join(F.slice("w", F.col("at") + 2, n), " ").alias("phrase"), F.lit(f"span{n}").alias("label")))
        for n in (1, 2, 3, 4, 5)])).alias("g"))
    return phrases.where("g IS NOT NULL").select("g.*").distinct()


ENTITIES_SQL = rf"""bw AS (SELECT regexp_extract_all(lower(text), '{WORD}') AS w FROM benchmark),
bp AS (SELECT w, i FROM bw, unnest(range(1, len(w) + 1)) AS u(i) WHERE w[i] = 'from'),
gaz AS (SELECT DISTINCT array_to_string(w[i + 1:i + n], ' ') AS phrase, 'span' || n AS label FROM bp, unnest([1, 2, 3, 4, 5]) AS v(n) WHERE len(w) >= i + n),
dw AS (SELECT doc_id, regexp_extract_all(lower(text), '{WORD}') AS w FROM documents),
pos AS (SELECT doc_id, unnest(w) AS t, unnest(range(1, len(w) + 1)) AS position FROM dw),
nx AS (SELECT *, lead(t, 1) OVER p AS t2, lead(t, 2) OVER p AS t3, lead(t, 3) OVER p AS t4, lead(t, 4) OVER p AS t5 FROM pos WINDOW p AS (PARTITION BY doc_id ORDER BY position)),
spans AS (SELECT doc_id, position, unnest([t, t || ' ' || t2, t || ' ' || t2 || ' ' || t3, t || ' ' || t2 || ' ' || t3 || ' ' || t4, t || ' ' || t2 || ' ' || t3 || ' ' || t4 || ' ' || t5]) AS phrase FROM nx),
ent AS (SELECT doc_id, CAST(position AS INTEGER) AS position, phrase, label FROM spans JOIN gaz USING (phrase)),
de AS (SELECT DISTINCT doc_id, phrase FROM ent)"""


def mentions(spark, sf):
    return text.match_entities(documents(spark, sf), "doc_id", "text", gazetteer(spark, sf))


@query("t5_entities", f"WITH {ENTITIES_SQL} SELECT doc_id, position, phrase, label FROM ent")
def t5_entities(spark, sf):
    return mentions(spark, sf)


def phrase_table(spark, sf):
    """Every stretch of two to eight words of a benchmark passage or a conversation: phrases within phrases, over phrases, by the hundred thousand. Repeats are the matcher's to take out."""
    sources = table(spark, sf, "benchmark").select("text").unionByName(table(spark, sf, "conversations").select("text"))
    passages = sources.select(tx.words("text").alias("w"))
    places = passages.select("w", F.explode(F.sequence(F.lit(1), F.size("w"))).alias("at")).where(F.size("w") > 0)
    stretches = places.select("w", "at", F.explode(F.array(*map(F.lit, range(2, 9)))).alias("n")).where(F.col("at") + F.col("n") - 1 <= F.size("w"))
    phrases = stretches.select(F.array_join(F.slice("w", F.col("at"), F.col("n")), " ").alias("phrase"), "n")
    return phrases.select("phrase", F.concat(F.lit("n"), "n").alias("label"))


PHRASES_SQL = rf"""gw AS (SELECT regexp_extract_all(lower(text), '{WORD}') AS w FROM (SELECT text FROM benchmark UNION ALL SELECT text FROM conversations)),
gaz AS (SELECT DISTINCT array_to_string(w[i:i + n - 1], ' ') AS phrase, 'n' || n AS label FROM gw, unnest(range(1, len(w) + 1)) AS u(i), unnest(range(2, 9)) AS v(n) WHERE i + n - 1 <= len(w)),
dw AS (SELECT doc_id, regexp_extract_all(lower(text), '{WORD}') AS w FROM documents),
spans AS (SELECT doc_id, CAST(i AS INTEGER) AS position, array_to_string(w[i:i + n - 1], ' ') AS phrase FROM dw, unnest(range(1, len(w) + 1)) AS u(i), unnest(range(2, 9)) AS v(n) WHERE i + n - 1 <= len(w))"""


@query("t5_phrase_table", f"WITH {PHRASES_SQL} SELECT doc_id, position, phrase, label FROM spans JOIN gaz USING (phrase)")
def t5_phrase_table(spark, sf):
    """All places of all phrases of a large table in the documents."""
    return text.match_entities(documents(spark, sf), "doc_id", "text", phrase_table(spark, sf))


EDGES_SQL = ENTITIES_SQL + """, edges AS (SELECT a.phrase AS src, b.phrase AS dst, count(*) AS weight FROM de a JOIN de b
   ON a.doc_id = b.doc_id AND a.phrase < b.phrase GROUP BY ALL)"""
DEGREE_SQL = EDGES_SQL + """, deg AS (SELECT entity, count(*) AS degree, CAST(sum(weight) AS BIGINT) AS weight FROM
   (SELECT src AS entity, weight FROM edges UNION ALL SELECT dst, weight FROM edges) GROUP BY entity)"""


def entity_edges(spark, sf):
    return graph.cooccurrence_pairs(text.entity_sets(mentions(spark, sf), "doc_id"))


@query("j5_cooccurrence_pairs", f"WITH {EDGES_SQL} SELECT src, dst, weight FROM edges")
def j5_cooccurrence_pairs(spark, sf):
    return entity_edges(spark, sf)


@query("g1_entity_degree", f"WITH {DEGREE_SQL} SELECT entity, degree, weight FROM deg")
def g1_entity_degree(spark, sf):
    return graph.entity_degree(entity_edges(spark, sf))


@query("g2_degree_centrality", f"""WITH {DEGREE_SQL}, n AS (SELECT DISTINCT phrase AS entity FROM ent)
  SELECT entity, coalesce(degree, 0) AS degree, {r('coalesce(degree, 0) / ((SELECT count(*) FROM n) - 1) AS centrality')} FROM n LEFT JOIN deg USING (entity)""")
def g2_degree_centrality(spark, sf):
    found = text.entity_sets(mentions(spark, sf), "doc_id")
    return tidy(graph.degree_centrality(graph.entity_nodes(found), graph.cooccurrence_pairs(found)))


POSTS_SQL = TICKS_SQL + ", posts AS (SELECT event_id, symbol AS source, ts AS created_at, user_id, price, volume / 50 - 1 AS sentiment FROM ticks)"


def posts(spark, sf):
    """events as posts: the counters are simple functions of value, size and user."""
    t = ticks(spark, sf)
    price, size, user = F.col("price"), F.col("volume").cast("long"), F.col("user_id")
    return t.select(
        "event_id", F.col("symbol").alias("source"), F.col("ts").alias("created_at"), "user_id", (F.col("volume") / 50 - 1).alias("sentiment"),
        (user * 10).alias("followers_count"), size.alias("retweets"), (size * 2 + user % 7).alias("likes"), (user % 5).alias("replies"),
        (size % 3).alias("shares"), F.floor(price * 10).alias("views"), (user % 11).alias("comments"), F.floor(price).alias("mentions"))


@query("a6_tumbling_sentiment", f"""WITH {POSTS_SQL} SELECT date_trunc('hour', created_at) AS window_start,
  date_trunc('hour', created_at) + INTERVAL 1 HOUR AS window_end, source, {r('avg(sentiment) AS avg_sentiment')}, count(sentiment) AS n_posts
  FROM posts GROUP BY ALL""")
def a6_tumbling_sentiment(spark, sf):
    return tidy(text.tumbling_sentiment(posts(spark, sf)))


@query("a13_sentiment_volatility", f"""WITH {LEXICON_SQL}, {sentiment_sql('documents', 'doc_id')}
  SELECT source, {r('stddev_samp(sentiment) AS volatility')}, count(sentiment) AS n FROM sent JOIN documents USING (doc_id) GROUP BY source""")
def a13_sentiment_volatility(spark, sf):
    scored = document_sentiment(spark, sf).join(documents(spark, sf).select("doc_id", "source"), "doc_id")
    return tidy(text.sentiment_volatility(scored, ["source"]))


@query("p16_news_volatility", f"""WITH {LEXICON_SQL}, {sentiment_sql('documents', 'doc_id')},
  v AS (SELECT source, lang, stddev_samp(sentiment) AS volatility FROM sent JOIN documents USING (doc_id) GROUP BY source, lang)
  SELECT source, lang, 'volatility' AS metric, '>' AS op, CAST(0.5 AS DOUBLE) AS "limit", {r('volatility AS value')} FROM v WHERE volatility > 0.5""")
def p16_news_volatility(spark, sf):
    """Sources whose sentiment varies beyond the alert limit."""
    scored = document_sentiment(spark, sf).join(documents(spark, sf).select("doc_id", "source", "lang"), "doc_id")
    return tidy(risk.threshold_alerts(text.sentiment_volatility(scored, ["source", "lang"]), ["source", "lang"], [risk.VOLATILITY_THRESHOLD]))


POST_ORDER = "created_at, event_id"


@query("f4_post_metrics", f"""WITH {POSTS_SQL}, p AS (SELECT *, CAST(floor(volume) AS BIGINT) AS v, CAST(trunc(volume) AS BIGINT) AS size FROM (SELECT p.*, t.volume FROM posts p JOIN ticks t USING (event_id)))
  SELECT event_id, {r('(size + size * 2 + user_id % 7 + user_id % 5 + size % 3) / nullif(user_id * 10, 0) AS engagement_rate',
    roll('avg', 'sentiment', 7, 'source', POST_ORDER) + ' AS sentiment_trend', roll('stddev_samp', 'sentiment', 7, 'source', POST_ORDER) + ' AS sentiment_volatility', digits=8)} FROM p""")
def f4_post_metrics(spark, sf):
    """Raw posts, one source may hold most of them: the series is split into chunks."""
    from tideline.series import SeriesSpec
    spec = SeriesSpec(("source",), "created_at", ("event_id",))
    return tidy(over_chunks(posts(spark, sf), spec, features.post_metrics, halo=7),
                "event_id", "engagement_rate", "sentiment_trend", "sentiment_volatility", digits=8)


@query("g3_influencer_impact")
def g3_influencer_impact(spark, sf):
    market = bars(spark, sf).select(F.col("symbol").alias("source"), F.col("ts").alias("bar_ts"), "close")
    out, _ = graph.influencer_impact(posts(spark, sf), market, "created_at", "bar_ts", ["source"])
    return tidy(out, "event_id", "source", "market_close", "impact_score")


@query("t6_topic_model")
def t6_topic_model(spark, sf):
    topics, _ = text.topic_model(documents(spark, sf).select("text"), "text", topics=5, passes=10)
    return tidy(topics)


@query("g3_influencer_impact_one", f"""WITH {BARS_SQL}, mk AS (SELECT symbol, ts AS bar_ts, close FROM bars){POSTS_SQL[len(TICKS_SQL):]},
  j AS (SELECT p.event_id, p.source, trunc(p.volume) AS x, mk.close AS y FROM (SELECT * FROM posts JOIN (SELECT event_id, volume FROM ticks) USING (event_id)) p ASOF LEFT JOIN mk ON p.source = mk.symbol AND p.created_at >= mk.bar_ts),
  f AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM j)
  SELECT event_id, source, {r('y AS market_close', 'a + b * x AS impact_score', digits=4)} FROM j, f""")
def g3_influencer_impact_one(spark, sf):
    """One counter: the line through the posts' prices."""
    market = bars(spark, sf).select(F.col("symbol").alias("source"), F.col("ts").alias("bar_ts"), "close")
    out, _ = graph.influencer_impact(posts(spark, sf), market, "created_at", "bar_ts", ["source"], counters=("retweets",))
    return tidy(out, "event_id", "source", "market_close", "impact_score", digits=4)


@query("t6_topic_properties", rf"""WITH w AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '{WORD}')) AS w FROM documents)
  SELECT 5 AS topics, 25 AS rows, 5 AS largest_rank, TRUE AS shares, count(*) AS n_words FROM w WHERE regexp_full_match(w, '\p{{L}}+')""")
def t6_topic_properties(spark, sf):
    """Five topics of five words each, with weights that are shares of the topic; the model's vocabulary and the stop words together are all words of the corpus."""
    docs = documents(spark, sf).select("text")
    topics, model = text.topic_model(docs, "text", topics=5)
    words = text.extract_keywords(docs, "text", replace=True).select(F.explode("keywords").alias("w")).distinct()
    known = model.words.select(F.col("word").alias("w"))
    stops = spark.createDataFrame([(w,) for w in text.default_stop_words()], "w string")
    n_words = words.join(known.union(stops).distinct(), "w", "left_semi").count()
    return topics.agg(F.countDistinct("topic").cast("int").alias("topics"), F.count(F.lit(1)).cast("int").alias("rows"),
                      F.max("rank").cast("int").alias("largest_rank"), F.every((F.col("weight") > 0) & (F.col("weight") <= 1)).alias("shares"),
                      F.lit(n_words).cast("long").alias("n_words"))

"""Joins, sources, text, graphs and quality on small tables."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tideline.functions import text as tx
from tideline.operators import features, graph, joins, quality, text
from tideline.series import SeriesSpec
from tideline.sources import payloads, scans


def test_asof_matches_pandas(spark):
    left = pd.DataFrame({"k": ["a", "a", "a", "b", "a"], "t": [1, 5, 10, 7, 99], "id": range(5)})
    right = pd.DataFrame({"k": ["a", "a", "a", "b"], "t": [5, 5, 9, 8], "seq": [1, 2, 3, 4], "v": [1.0, 2.0, 3.0, 4.0]})
    expected = pd.merge_asof(left.sort_values("t"), right.sort_values(["t", "seq"]), on="t", by="k").set_index("id")["v"]
    for exact, answers in ((True, expected), (False, None)):
        out = joins.asof_join(spark.createDataFrame(left), spark.createDataFrame(right).withColumnRenamed("t", "rt"), "t", "rt", ["k"],
                              right_tiebreak=["seq"], allow_exact=exact)
        got = {r["id"]: r["right_v"] for r in out.collect()}
        assert len(got) == 5 and got[0] is None and got[3] is None and got[4] == 3.0
        assert got[1] == (2.0 if exact else None)
        if answers is not None:
            assert got == {i: (None if v != v else v) for i, v in answers.items()}


def test_asof_forward(spark):
    left = spark.createDataFrame([(1, 1), (2, 6)], "id int, t int")
    right = spark.createDataFrame([(5, "x"), (6, "y")], "rt int, v string")
    out = joins.asof_join(left, right, "t", "rt", direction="forward")
    assert {r["id"]: r["right_v"] for r in out.collect()} == {1: "x", 2: "y"}


def test_merge_does_not_multiply_rows(spark):
    base = spark.createDataFrame([(1,), (2,)], "ts int")
    other = spark.createDataFrame([(1, 1, "old"), (1, 2, "new")], "ts int, seq int, v string")
    out = joins.merge_on_time(base, {"o": other}, ["ts"], {"o": ["seq"]})
    assert [(r["ts"], r["o_v"]) for r in out.orderBy("ts").collect()] == [(1, "new"), (2, None)]


def test_pairwise_needs_few_groups(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 3.0), ("c", None)], "n string, m double")
    got = {r["pair"]: r["d"] for r in joins.pairwise_compare(df, "n", {"d": "m"}).collect()}
    assert got == {"a_vs_b": 2.0, "a_vs_c": None, "b_vs_c": None}


def test_append_dedup_stores_once(spark, tmp_path):
    path = str(tmp_path / "store")
    rows = [("2024-01-01", 1.0, "d1"), ("2024-01-01", 1.0, "d1"), ("2024-01-02", 2.0, "d2"), (None, None, "d2")]
    df = spark.createDataFrame(rows, "timestamp string, price double, day string")
    for _ in range(2):
        scans.append_dedup(df, path, partition="day")
    assert spark.read.parquet(path).count() == 3


def test_save_modes(spark, tmp_path):
    path, df = str(tmp_path / "t"), spark.range(3)
    scans.save_table(df, path, "fail")
    scans.save_table(df, path, "append", {"id": "bigint"})
    assert scans.load_table(spark, path, ["id"], "id > 0").count() == 4
    scans.save_table(df, path, "replace")
    assert spark.read.parquet(path).count() == 3
    with pytest.raises(Exception):
        scans.save_table(df, path, "fail")


def test_map_chunks_drops_empty_results(spark):
    out = scans.map_chunks(spark.range(10), lambda b: b[b["id"] > 7] if (b["id"] > 7).any() else None, "id long")
    assert sorted(r["id"] for r in out.collect()) == [8, 9]


def test_quote_rejects(spark):
    raw = spark.createDataFrame([("Binance", '{"k":{"o":"1","h":"2","l":"0.5","c":"1.5","v":"9"}}'), ("Binance", "{broken"),
                                 ("Bitfinex", "[0,1,2]"), ("nobody", "{}"), (None, None)], "source string, payload string")
    good = payloads.normalize_quotes(raw).collect()
    assert [(r["open"], r["close"], r["volume"]) for r in good] == [(1.0, 1.5, 9.0)]
    assert payloads.quote_rejects(raw).count() == 4


def test_rss_and_unknown_articles(spark):
    raw = spark.createDataFrame([("rss", "<item><title>A &amp; B</title><link>http://x</link></item>"), ("other", "{}")], "kind string, payload string")
    rows = payloads.normalize_articles(raw).collect()
    assert [(r["title"], r["link"]) for r in rows] == [("A & B", "http://x")]


def test_schema_checks(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    assert quality.schema_matches(df, {"a": "numeric", "b": "string"})
    assert quality.schema_differences(df, {"b": "numeric", "c": "string"}) == ["b: string, expected a number", "c: missing"]
    with pytest.raises(ValueError, match="missing"):
        quality.validate_schema(df, ["z"])
    with pytest.raises(ValueError, match="no rows"):
        quality.validate_schema(df.where("a > 1"), ["a"])
    assert quality.validate_schema(df.where("a > 1"), ["a"], allow_empty=True).count() == 0


def test_clean_text_keeps_accents(spark):
    df = spark.createDataFrame([("Les ÉTÉS à Paris: http://x.y/z?q=1 ok été!",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(tx.clean_text("t")).collect()] == ["les étés  paris    été", "", None]


def test_lexicon_sentiment_and_negation(spark):
    docs = spark.createDataFrame([(1, "good day"), (2, "not good"), (3, "nothing"), (4, None)], "id int, text string")
    lexicon = spark.createDataFrame([("good", 2.0)], "token string, valence double")
    got = {r["id"]: r["sentiment"] for r in text.lexicon_sentiment(docs, "id", "text", lexicon).collect()}
    assert got[1] == pytest.approx(2 / 19 ** 0.5) and got[3] == 0 and got[4] == 0
    assert got[2] == pytest.approx(-1.48 / (1.48 ** 2 + 15) ** 0.5)


def test_keywords_and_lemmas(spark):
    docs = spark.createDataFrame([(1, "The cats ran 3 x2 miles"), (2, "")], "id int, text string")
    lemmas = spark.createDataFrame([("cats", "cat"), ("ran", "run")], "word string, lemma string")
    got = {r["id"]: r["keywords"] for r in text.extract_keywords(docs, "text", lemmas=lemmas, key="id").collect()}
    assert got == {1: ["cat", "run", "miles"], 2: []}


def test_entities_span_words(spark):
    docs = spark.createDataFrame([(1, "New York and new york city"), (2, "york")], "id int, text string")
    gazetteer = spark.createDataFrame([("new york", "place"), ("new york city", "place"), ("york", "place")], "phrase string, label string")
    got = sorted((r["id"], r["position"], r["phrase"]) for r in text.match_entities(docs, "id", "text", gazetteer).collect())
    assert got == [(1, 1, "new york"), (1, 2, "york"), (1, 4, "new york"), (1, 4, "new york city"), (1, 5, "york"), (2, 1, "york")]


def test_graph_counts_copies_and_isolated_nodes(spark):
    docs = spark.createDataFrame([(["b", "a", "a"],), (["a", "b"],), (["c"],), ([],), (["b", "d", "a"],)], "entities array<string>")
    edges = graph.cooccurrence_pairs(docs)
    assert {(r["src"], r["dst"]): r["weight"] for r in edges.collect()} == {("a", "b"): 3, ("a", "d"): 1, ("b", "d"): 1}
    got = {r["entity"]: (r["degree"], r["centrality"]) for r in graph.degree_centrality(graph.entity_nodes(docs), edges).collect()}
    assert got == {"a": (2, pytest.approx(2 / 3)), "b": (2, pytest.approx(2 / 3)), "c": (0, 0), "d": (2, pytest.approx(2 / 3))}
    lone = spark.createDataFrame([(["z"],)], "entities array<string>")
    assert graph.degree_centrality(graph.entity_nodes(lone), graph.cooccurrence_pairs(lone)).first()["centrality"] == 1.0


def test_time_split_matches_expanding_folds(spark):
    df = spark.range(23).select(F.lit("a").alias("k"), F.col("id").alias("ts"))
    rows = features.split_time(df, SeriesSpec(("k",), "ts")).orderBy("ts").collect()
    # 23 rows, 5 folds: test blocks of 3 rows at the end, the first 8 rows only train
    assert [r["test_fold"] for r in rows] == [None] * 8 + [f for f in range(5) for _ in range(3)]
    assert sum(r["is_train"] for r in rows) == 18


def test_recent_n(spark):
    df = spark.range(50).select((F.col("id") % 2).alias("c"), F.col("id").alias("t"))
    assert sorted(r["t"] for r in scans.recent_n(df, ["c"], ["t"], 2).collect()) == [46, 47, 48, 49]

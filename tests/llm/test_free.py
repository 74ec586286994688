"""Operators of free style: toxicity, extraction, mixing, near-duplicates, encoding, embeddings."""

import random

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from brute import components, fingerprint, near

from test_native import DOCS, body, docs_of, odd_docs
from tideline.llm import op3_cnn_toxicity as toxicity
from tideline.llm import op4_consensus_html as pages
from tideline.llm import op5_poisson_mixing as mixing
from tideline.llm import op7_covering_simhash as simhash
from tideline.llm import op8_wfst_pieces as pieces
from tideline.llm import op9_itq_embeddings as vectors
from tideline.llm.buckets import grouped_buckets
from tideline.llm.components import connected_components


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(1000 + i, 1001 + i) for i in range(60)] + [(7, 7)]
    out = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    expected = components(1100, [e for e in edges if e[0] != e[1]], list(range(1100)))
    assert out == {n: expected[n] for e in edges if e[0] != e[1] for n in e}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_every_pair_within_the_radius_shares_a_mask():
    masks = [m & (2 ** 64 - 1) for m in simhash.covering_masks()]
    assert len(masks) == 31 and all(30 <= m.bit_count() <= 34 for m in masks)
    rng = random.Random(3)
    for _ in range(5000):
        difference = sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4)))
        assert any(difference & m == 0 for m in masks)


def variants(seed, n, words=60):
    rng = random.Random(seed)
    base = [f"word{rng.randrange(5000)}" for _ in range(words)]
    out = []
    for _ in range(n):
        t = list(base)
        for _ in range(rng.randint(0, 3)):
            t[rng.randrange(words)] = f"new{rng.randrange(10 ** 6)}"
        out.append(" ".join(t))
    return out


def test_near_duplicates_equal_brute_force(spark):
    texts = [t for s in range(12) for t in variants(s, 25)] + ["", None, " \n", "one", "One two", "one two"] + [body(i) for i in range(40)] + [body(1)] * 30
    prints = [fingerprint(t) for t in texts]
    names = [None if i % 17 == 5 else 1000 - i for i in range(len(texts))]
    docs = spark.createDataFrame(list(zip(names, texts)), "doc_id long, text string")
    out = simhash.near_duplicate_groups(docs).collect()
    expected = components(len(texts), near(prints), names)
    assert sorted((str(r["doc_id"]), r["fp"] & (2 ** 64 - 1), str(r["component_id"])) for r in out) == sorted((str(n), p, str(c)) for n, p, c in zip(names, prints, expected))
    kept = simhash.one_per_group(docs).collect()
    groups = {c for c in expected if c is not None}
    assert sorted(r["doc_id"] for r in kept if r["doc_id"] is not None) == sorted(groups)


def test_large_buckets_are_cut(spark):
    ids = list(range(300))
    rows = spark.createDataFrame([(0, 7, i) for i in ids] + [(1, i, i) for i in ids], "table int, key long, id long")
    out = grouped_buckets(rows, 50).where("table = 0").groupBy("left", "right").count().collect()
    assert max(r["count"] for r in out) < 160 and len(out) == 21
    prints = [fingerprint(t) for t in variants(99, 300)]
    fps = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in sorted(set(prints))], "fp long")
    found = {frozenset((r["u"], r["v"])) for r in simhash.near_links(fps).collect()}
    assert found and all(((a ^ b) & (2 ** 64 - 1)).bit_count() <= 4 for a, b in map(tuple, found))


def test_odd_rows_free(spark):
    docs = odd_docs(spark)
    machine = pieces.compile_machine()
    for df in (docs, docs.limit(0)):
        n = df.count()
        kept = simhash.one_per_group(df)
        assert kept.columns == df.columns and kept.count() == (4 if n else 0)
        assert simhash.near_duplicate_groups(df).count() == n
        encoded = pieces.encode(df, machine, check="same")
        assert encoded.count() == n and encoded.where("text IS NULL AND ids IS NOT NULL OR NOT same").count() == 0
        assert pieces.decode(encoded.drop("same"), machine).where("NOT decoded <=> text").count() == 0
        mixed = mixing.mix(df, mixing.source_rates(df))
        assert mixed.columns == [c for c in df.columns if c != "copies"] + ["copies", "copy", "order_key"] and mixed.where("text IS NULL").count() <= n * 20
        net = toxicity.fit_toxicity(df, spark.createDataFrame([(1, 1, 1), (2, 0, None), (None, 1, 1)], "doc_id long, quality int, toxic int"))
        assert toxicity.score_texts(df, net).count() == n


def test_encoding_equals_the_library(spark):
    machine = pieces.compile_machine()
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    rng = random.Random(1)
    parts = ["a", "the", " ", "  ", "\n", "é", "ß", "日", "本", "🙂", "́", "0", "...", "!!", "\t", "ing", "X", "   a", "of", "\r", "\x00", "tion", "▁"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(2000)] + [" " * 50, "x" * 3000, "", None]
    out = {r["doc_id"]: r for r in pieces.encode(docs_of(spark, texts), machine, check="same").collect()}
    for i, t in enumerate(texts):
        assert out[i]["ids"] == (None if t is None else library.encode(t)), t
        assert out[i]["same"] == (None if t is None else "▁" not in t), t


def test_mixing_follows_the_weights(spark):
    rows = [(i, body(i, 20), "en", "big" if i < 3000 else "small", 0) for i in range(3300)]
    docs = spark.createDataFrame(rows, DOCS)
    mixed = mixing.mix(docs, mixing.source_rates(docs, weights={"big": 1, "small": 1}))
    chars = {r["source"]: r["n"] for r in mixed.groupBy("source").agg({"text": "count"}).withColumnRenamed("count(text)", "n").collect()}
    assert abs(chars["big"] / 1650 - 1) < 0.1 and abs(chars["small"] / 1650 - 1) < 0.1
    again = mixing.mix(docs.repartition(7), mixing.source_rates(docs, weights={"big": 1, "small": 1}))
    assert sorted(map(tuple, again.select("doc_id", "copy", "order_key").collect())) == sorted(map(tuple, mixed.select("doc_id", "copy", "order_key").collect()))
    assert mixing.mix(docs, mixing.source_rates(docs, weights={"big": 0, "small": 1})).where("source = 'big'").count() == 0
    counts = [r["copies"] for r in mixing.mix(docs.where("source = 'small'"), mixing.source_rates(docs.where("source = 'small'"), size=40.0)).where("copy = 1").collect()]
    assert abs(np.mean(counts) - 40) < 1.5 and abs(np.var(counts) - 40) < 10


ARTICLE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1><nav><a href=x>Home</a></nav></header>
<div class="cookie-notice">We use cookies.</div><div id=w><article class="post-%d"><header><h1>Title &amp; more %d</h1><div class=byline>by X</div></header>
<div class="entry"><p>First &nbsp; paragraph with <b>bold</b> text and
words %d.<p>Second paragraph<br>after a break &lt;tag&gt;.</p><ul><li>one item</li><li>two</li></ul><div class="ad">Buy now</div><form><p>Mail</p></form></div>
<section id="comments"><p>A long comment by a reader who disagrees.</p></section></article></div><aside>Side</aside><footer>foot</footer><scr"""
TEXT = "Title & more %d\nFirst paragraph with bold text and words %d.\nSecond paragraph after a break <tag>.\none item\ntwo"


def test_extraction(spark):
    other = '<body><div class="nav"><a>a</a></div><div class="content"><p>Only text here, quite long indeed.</p><p>And another.</p></div></body>'
    html = [ARTICLE % (i, i, i) for i in range(20)] + [other, "", None, "plain text", "<p>a<p>b", "<div>unclosed <b>bold"]
    rows = [(i, "https://a.org/x" if i < 21 else None, h) for i, h in enumerate(html)] + [(None, "odd url", ARTICLE % (5, 5, 5)), (3, "https://a.org/x", html[3])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS _html", "2 AS host", "3 AS text")
    out = pages.main_text(df, out="main").collect()
    found = sorted((str(r["page_id"]), r["main"]) for r in out)
    expected = [(str(i), TEXT % (i, i)) for i in range(20)] + [("20", "Only text here, quite long indeed.\nAnd another."), ("21", ""), ("22", ""), ("23", "plain text"),
                ("24", "a\nb"), ("25", "unclosed bold"), ("None", TEXT % (5, 5)), ("3", TEXT % (3, 3))]
    assert found == sorted(expected)
    assert pages.main_text(df.limit(0)).count() == 0


def test_toxicity_learns_and_is_whole(spark):
    rng = random.Random(2)
    texts, labels = [], []
    for i in range(900):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.randint(5, 120))]
        toxic = int(i % 6 == 0)
        if toxic:
            words.insert(rng.randrange(len(words)), rng.choice(["idiot", "moron", "scum"]))
        texts.append(" ".join(words))
        labels.append(toxic)
    net = toxicity.train(texts[:600], np.array(labels[:600]))
    late = " ".join(f"w{j % 3000}" for j in range(60_000)) + " idiot"
    docs = docs_of(spark, texts[600:] + ["", None, late])
    out = {r["doc_id"]: r["score"] for r in toxicity.score_texts(docs, net).collect()}
    right = sum((out[i] >= 0.5) == bool(y) for i, y in enumerate(labels[600:]))
    assert right >= 0.95 * 300 and len(out) == 303 and all(0 <= s <= 1 for s in out.values())
    assert out[300] == out[301] < 0.5
    plain = {r["doc_id"]: r["score"] for r in toxicity.score_texts(docs_of(spark, [late.removesuffix(" idiot")]), net).collect()}
    assert out[302] > plain[0]


def test_embeddings_against_brute_force(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((60, 64))
    x = np.vstack([np.repeat(base, 8, axis=0) + 0.15 * rng.standard_normal((480, 64)), rng.standard_normal((500, 64)), np.repeat(base[:2], 20, axis=0)]).astype(np.float32)
    rows = [(int(i), v.tolist()) for i, v in enumerate(x)]
    bad = [(5000, None), (5001, [0.0] * 64), (5002, [float("nan")] + [1.0] * 63), (5003, [None] + [1.0] * 63), (5004, [float("inf")] * 64), (5005, [1.0] * 3), (None, [0.0] * 64), (5006, [])]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>").selectExpr("*", "1 AS id", "2 AS code", "3 AS _key")
    out = {r["vec_id"]: r for r in vectors.near_vectors(df).collect()}
    assert len(out) == len(rows) + len(bad)
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    close = unit @ unit.T >= 0.95
    np.fill_diagonal(close, False)
    degree = close.sum(axis=1)
    got = np.array([out[i]["n_links"] for i in range(len(x))])
    assert (got <= degree).all() and got.sum() >= 0.9 * degree.sum() and degree.sum() > 2000
    expected = components(len(x), [tuple(map(int, p)) for p in np.argwhere(close) if p[0] < p[1]], list(range(len(x))))
    assert np.mean([out[i]["component_id"] == expected[i] for i in range(len(x))]) >= 0.95
    assert all(out[k]["n_links"] == 0 and out[k]["component_id"] == k and out[k]["kept"] for k, _ in bad)
    assert vectors.near_vectors(df.limit(0)).count() == 0


@pytest.mark.parametrize("number,bits", [(10, 8), (100_000, 16), (10_000_000, 16), (100_000_000, 24), (10 ** 12, 32)])
def test_keys_grow_with_the_number_of_vectors(number, bits):
    assert {(m & (2 ** 64 - 1)).bit_count() for m in vectors.table_masks(number)} == {bits}


@pytest.mark.parametrize("number", [10, 10_000_000, 100_000_000])
def test_recall_does_not_follow_the_number_of_vectors(number):
    rng = np.random.default_rng(8)
    x = rng.standard_normal((3000, 64))
    masks = vectors.table_masks(number)
    a, b = vectors.probe_pairs(x, 0.95, seed=12)
    met = np.zeros(len(a), dtype=bool)
    for q in vectors.fit_quantisers(x, masks, 0.95):
        met |= vectors.meeting(a, b, q, masks)
    assert np.allclose((a * b).sum(axis=1), 0.95) and met.mean() >= 0.975


@pytest.mark.parametrize("mean", [0.0, 0.8, 0.9, 0.95])
def test_recall_with_a_common_direction(spark, mean):
    """Vectors whose cosines are ``mean`` on average, as many models make them, each with a partner just above the threshold."""
    rng = np.random.default_rng(6)
    common = np.zeros(64)
    common[0] = np.sqrt(mean)
    free = rng.standard_normal((700, 64))
    free[:, 0] = 0
    x = common + np.sqrt(1 - mean) * free / np.linalg.norm(free, axis=1, keepdims=True)
    w = rng.standard_normal(x.shape)
    w -= (w * x).sum(axis=1, keepdims=True) * x
    partner = 0.955 * x + np.sqrt(1 - 0.955 ** 2) * w / np.linalg.norm(w, axis=1, keepdims=True)
    x = np.vstack([x, partner])
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    out = {r["vec_id"]: r["n_links"] for r in vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    close = unit @ unit.T >= 0.95
    np.fill_diagonal(close, False)
    degree, got = close.sum(axis=1), np.array([out[i] for i in range(len(x))])
    assert (got <= degree).all() and got.sum() >= 0.95 * degree.sum() and degree.sum() >= 1400


@pytest.mark.parametrize("mean, number", [(0.8, 100_000), (0.8, 100_000_000), (0.94, 100_000_000)])
def test_tables_are_bounded(mean, number):
    rng = np.random.default_rng(9)
    x = np.sqrt(1 - mean) * rng.standard_normal((3000, 64)) / 8
    x[:, 0] += np.sqrt(mean)
    quantisers, masks = vectors.fit_tables(x, number, 0.95)
    assert len(quantisers) * len(masks) <= vectors.MOST_TABLES and vectors.recall_of(quantisers, masks, x, 0.95) >= 0.97


def test_embeddings_leave_the_session_as_it_was(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    vectors.op9_itq_embeddings(spark, "/root/testdata/sf0.001").count()
    assert spark.conf.get(name) == before


def test_toxicity_learns_from_every_label(spark):
    """More labels than one shard holds, a word that only toxic texts beyond any few thousand labels hold, and any partitioning."""
    bounds = toxicity.Bounds(shard=500, seen=100)
    rng = random.Random(6)
    texts = [" ".join(f"w{rng.randrange(800)}" for _ in range(8)) + (f" rude{i}" if i % 2 else "") for i in range(9000)]
    docs = docs_of(spark, texts)
    labels = spark.createDataFrame([(i, 0, i % 2) for i in range(9000)], "doc_id long, quality int, toxic int")
    rows = toxicity.labelled_texts(docs.union(docs.where("doc_id < 50")), labels.union(labels.where("doc_id < 50")), bounds)
    fold = {r["doc_id"] for r in docs.select("doc_id", toxicity.held_out(docs["doc_id"]).alias("h")).collect() if not r["h"]}
    assert sorted(r["doc_id"] for r in rows.select("doc_id").collect()) == sorted(fold) and len(fold) > 6500
    shuffled = toxicity.labelled_texts(docs.union(docs.where("doc_id < 50")), labels.repartition(3), bounds, sent_bytes=0)
    assert sorted(map(tuple, shuffled.collect())) == sorted(map(tuple, rows.collect()))
    few = toxicity.labelled_texts(docs, labels.where("doc_id % 3 = 0"), bounds, sent_bytes=0)
    assert sorted(r["doc_id"] for r in few.collect()) == sorted(i for i in fold if i % 3 == 0)
    counts = toxicity.text_counts(rows)
    first, _, starts = toxicity.token_rows([texts[i] for i in sorted(fold)], toxicity._Rows())
    holds = np.zeros(toxicity.ROWS + 1)
    for a, b in zip(starts, np.append(starts[1:], len(first))):
        holds[np.unique(first[a:b])] += 1
    assert (counts[0, 0] == holds).all()
    nets = [toxicity.fit_toxicity(docs.repartition(n), labels.repartition(n), bounds) for n in (1, 5)]
    assert all((a == b).all() for a, b in zip((nets[0].one, nets[0].weights, nets[0].shifts), (nets[1].one, nets[1].weights, nets[1].shifts)))


def test_encoder_outlives_a_task():
    """Another copy of the machine in the same process finds what was learned; words next to runs of spaces and word marks included."""
    first, second = pieces.compile_machine(), pieces.compile_machine()
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    texts = ["the cat\nsat  on the mat", " a", "a ", "", "the cat", "x▁ y z", "▁", "  ", "\n the\n", "ein Haus, das"]
    assert [np.frombuffer(x, dtype="<i4").tolist() for x in first.encoder().encode(pa.array(texts + [None]))] == [*map(library.encode, texts), []]
    assert second.encoder() is first.encoder() and "cat" in second.encoder().words

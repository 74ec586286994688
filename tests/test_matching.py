"""Phrase and keyword tables against plain loops."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tideline.operators import matching, quality, text

WORDS = ["a", "ab", "b", "né", "日本", "c_d", "x1", "😀"]


def plain_places(texts, phrases):
    out = []
    for key, t in texts:
        words = re.findall(r"\w+", (t or "").lower())
        for p, label in phrases:
            parts = (p or "").split(" ")
            out += [(key, i + 1, p, label) for i in range(len(words) - len(parts) + 1) if words[i:i + len(parts)] == parts]
    return sorted(out, key=str)


def make(seed, number=60):
    rng = random.Random(seed)
    texts = [(i, rng.choice([" ", ", ", "\n"]).join(rng.choice(WORDS[:7]).upper() for _ in range(rng.randint(0, 40)))) for i in range(number)]
    phrases = {(" ".join(rng.choice(WORDS[:7]) for _ in range(rng.randint(1, 4))), rng.choice("xyz")) for _ in range(200)}
    return texts, sorted(phrases)


@pytest.mark.parametrize("block_bytes", [16_000_000, 3000])
def test_every_place_of_every_phrase(spark, block_bytes):
    texts, phrases = make(1)
    texts += [(100, None), (101, ""), (102, "..."), (103, "a " * 500), (7, "a b")]
    phrases += [("a b", None), ("", "x"), (None, "x"), ("a  b", "x"), ("a " * 300 + "a", "long"), ("never seen", "x")]
    found = matching.match_phrases(spark.createDataFrame(texts, "k long, t string"), "k", "t", spark.createDataFrame(phrases, "phrase string, label string"), block_bytes)
    assert [f.name for f in found.schema.fields] == ["k", "position", "phrase", "label"]
    expected = plain_places(texts, [p for p in phrases if p[0] and "  " not in p[0]])
    assert sorted(map(tuple, found.collect()), key=str) == expected


def test_no_phrases_and_no_texts(spark):
    texts = spark.createDataFrame([(1, "a b")], "k long, t string")
    none = spark.createDataFrame([], "phrase string, label string")
    assert matching.match_phrases(texts, "k", "t", none).collect() == []
    assert text.match_entities(texts.limit(0), "k", "t", spark.createDataFrame([("a", "x")], "phrase string, label string")).collect() == []


@pytest.mark.parametrize("block_bytes", [16_000_000, 200])
def test_keyword_table(spark, block_bytes):
    rng = random.Random(3)
    texts = [(i, "".join(rng.choice("abcDÉ ") for _ in range(rng.randint(0, 12)))) for i in range(200)] + [(900, None), (901, "xx日本語")]
    keys = ["abca", "dd", "É", "本", "cab ", None, "never"]
    df = spark.createDataFrame(texts, "k long, t string")
    table = spark.createDataFrame([(k,) for k in keys], "keyword string")
    flags = dict(df.select("k", matching.contains_pattern(F.col("t"), table, block_bytes=block_bytes)).collect())
    assert flags == {i: None if t is None else any(k.lower() in t.lower() for k in keys if k) for i, t in texts}
    kept = quality.keyword_filter(df, ["t"], table)
    assert {r.k for r in kept.collect()} == {i for i, f in flags.items() if f} and kept.columns == ["k", "t"]
    with_empty = spark.createDataFrame([("",)], "keyword string")
    assert quality.keyword_filter(df, ["t"], with_empty).count() == len(texts)
    assert quality.keyword_filter(df, ["t"], table.limit(0)).count() == 0


def test_texts_are_walked_once_per_block(spark):
    """One Arrow step between scan and result, and no exchange of texts."""
    texts, phrases = make(2)
    found = matching.match_phrases(spark.createDataFrame(texts, "k long, t string"), "k", "t", spark.createDataFrame(phrases, "phrase string, label string"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Exchange" not in plan


def test_a_large_phrase_table_is_joined_in_one_pass(spark):
    """However many blocks the table would fill, the texts pass through one Arrow step; words shorter and longer than any phrase, repeated texts and labels included."""
    texts, phrases = make(5)
    texts += [(0, texts[0][1]), (70, "x1"), (71, "q " * 3000)]
    phrases += [(phrases[0][0], None), ("q q q q q q q", "seven")]
    for width in (1, 200):  # bytes of a block
        found = matching.match_phrases(spark.createDataFrame(texts, "k long, t string"), "k", "t", spark.createDataFrame(phrases, "phrase string, label string"), width)
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("MapInArrow") == 1 and "Union" not in plan
        assert sorted(map(tuple, found.collect()), key=str) == plain_places(texts, phrases)


@pytest.mark.parametrize("bits", [29, 11])
def test_only_phrases_of_some_text_are_joined_by_text(spark, monkeypatch, bits):
    """Of a large table the join holds what some text has a hash of, also where the bitmap is far too small; keys that are texts, few places at a time, repeated lines."""
    monkeypatch.setattr(matching, "_MOST_BITS", bits)
    monkeypatch.setattr(matching, "_FOUND_PLACES", 40, raising=False)
    texts, phrases = make(6)
    texts = [(f"k{i}", t) for i, t in texts] + [(None, "a b c_d")]
    never = [(f"w{i} w{i % 7} {'x ' * (i % 3)}end", "n") for i in range(20_000)]
    table = spark.createDataFrame(phrases + never + phrases[:50], "phrase string, label string")
    found = matching.match_phrases(spark.createDataFrame(texts, "k string, t string").repartition(3), "k", "t", table, 1000)
    stored = [f for f in found.inputFiles() if "/phrases-" in f or "/patterns-" in f]
    assert 0 < spark.read.parquet(*stored).count() < 2_000
    assert sorted(map(tuple, found.collect()), key=str) == plain_places(texts, phrases)
    assert matching.match_phrases(spark.createDataFrame(texts, "k string, t string"), "k", "t", spark.createDataFrame(never, "phrase string, label string"), 1000).count() == 0


def test_stretches_over_borders(monkeypatch):
    """Words looked at together end anywhere; no stretch leaves its text, and what is marked is found."""
    monkeypatch.setattr(matching, "_RUN", 16)
    rng = np.random.default_rng(2)
    words = pa.array([rng.integers(-9, 9, n).tolist() for n in (0, 3, 40, 1, 0, 17)] + [None, [4, 4]], type=pa.list_(pa.int64())).slice(1)
    every = matching.Marks(np.full(1 << 9, 255, dtype=np.uint8), 12, 1, 40)
    flat, rows = [], [x or [] for x in words.to_pylist()]
    for row in rows:
        flat += [(len(flat) + i, row[i:]) for i in range(len(row))]
    found = {(n, i): v for n, at, values in matching.stretches(words, [1, 2, 5, 60], every) for i, v in zip(at.tolist(), values.tolist())}
    assert set(found) == {(n, i) for i, rest in flat for n in (1, 2, 5) if len(rest) >= n}
    numbers, sizes = matching._numbers(pa.array([flat[i][1][:n] for n, i in found], type=pa.list_(pa.int64())), 40)
    assert numbers.tolist() == list(found.values()) and sizes.tolist() == [n for n, _ in found]
    dealt = list(matching._dealt(iter([numbers, numbers[:5]]), 3, 40))
    assert np.concatenate([x for batch in dealt for x in matching._lists(batch)]).tolist() == sorted(set(numbers.tolist()))


def test_a_large_keyword_table_is_one_function(spark):
    """However many blocks, a worker runs one function over one compact table; keywords of every length, at both ends, over piece borders, and long ones."""
    rng = random.Random(8)
    keys = sorted({"".join(rng.choice("abcdé本🙂") for _ in range(rng.randint(4, 40))) for _ in range(3000)}) + ["x" * 300, "yx"]
    texts = [None, "", "x" * 299, "x" * 300, "zyxz", "q" * 300_000 + keys[5], "q" * (matching._PIECE - 3) + keys[7] + "q" * 10, keys[9] + "q", "q" + keys[9][:-1]]
    texts += ["".join(rng.choice("abcdé本🙂") for _ in range(rng.randint(0, 60))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "k long, t string")
    flag = matching.contains_pattern(F.col("t"), spark.createDataFrame([(k,) for k in keys], "keyword string"), block_bytes=30_000)
    out = df.select("k", flag.alias("f"))
    assert out._jdf.queryExecution().optimizedPlan().toString().count("hit(") == 1
    assert {r.k: r.f for r in out.collect()} == {i: None if t is None else any(k in t for k in keys) for i, t in enumerate(texts)}
    table = matching.KeywordTable([matching.KeywordBlock.of(pa.array(keys))], 20)
    assert table.found(["q", "yx", "xy" * 3]) == [False, True, True]

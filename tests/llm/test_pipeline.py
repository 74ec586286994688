"""The whole pipeline on odd rows and on an empty table, and its stages one after the other against plain versions."""

import re

import pytest
from brute import fingerprint, measures, near, components
from pyspark.sql import functions as F

import corpus_pipeline

DOCS = "doc_id long, text string, lang string, source string, n_chars int"


def body(i, words=90):
    return " ".join(f"{'abcdefghij'[(i * 7 + j * j) % 10]}{'klmnopqrst'[(i + 3 * j) % 10]}word{'uvwxyz'[(i * j) % 6]}{i}x{j}" for j in range(words))


def rows():
    out = [(i, body(i), "en", "ab"[i % 2], len(body(i))) for i in range(12)]
    out += [(100, body(3), "en", "a", 5), (101, body(3) + " tail", None, None, None), (102, None, "en", "a", 0), (103, "", "en", "a", 0), (104, "short", "en", "b", 5),
            (None, body(30), "en", "a", 1), (105, body(31) + "\npassword = abcdefgh12345", "en", None, 9), (105, body(32), "en", "c", 9), (106, "the same words " * 60, "en", "c", 9)]
    return out


@pytest.fixture
def folder(tmp_path):
    def write(spark, data, **more):
        df = spark.createDataFrame(data, DOCS).withColumns(more)
        df.write.parquet(str(tmp_path / "documents.parquet"))
        return str(tmp_path)
    return write


def test_odd_rows_pass_through_all_stages(spark, folder):
    names = {c: F.lit("x") for c in ("_doc", "_key", "ids_of", "root", "table")}
    out = corpus_pipeline.run(spark, folder(spark, rows(), **names))
    found = out.collect()
    assert out.columns == ["doc_id", "lang", "source", "n_chars", "n_tokens", "ids", "round_trip"] and found
    assert all(r.round_trip for r in found) and {r.doc_id for r in found} <= {i for i, *_ in rows()} - {102, 103, 104, 106}


def test_an_empty_table_passes_through_all_stages(spark, folder):
    assert corpus_pipeline.run(spark, folder(spark, [])).count() == 0


def test_stages_do_what_they_say(spark, folder):
    path = folder(spark, rows())
    docs = spark.read.parquet(f"{path}/documents.parquet")
    kept = corpus_pipeline.quality_stage(spark, docs, path).collect()
    good = [r for r in rows() if r[1] and (m := measures(r[1]))[0] >= 50 and 100 * m[4] <= 50 * m[0]]
    assert sorted((str(r.doc_id), r.text) for r in kept) == sorted((str(r[0]), r[1]) for r in good)
    frame = spark.createDataFrame(kept, docs.schema)
    single = corpus_pipeline.duplicate_stage(spark, frame, path)
    prints = [fingerprint(r.text) for r in kept]
    assert single.count() == len(set(components(len(kept), near(prints), list(range(len(kept))))))  # rows, as ids are repeated
    masked = corpus_pipeline.secret_stage(spark, single, path)
    assert masked.columns == docs.columns and masked.count() == single.count()
    assert not any(re.search("abcdefgh12345", r.text) for r in masked.collect())
    mixed = corpus_pipeline.mixing_stage(spark, masked, path)
    assert mixed.columns == docs.columns and {r.text for r in mixed.collect()} <= {r.text for r in masked.collect()}

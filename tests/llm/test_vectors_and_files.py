"""Hard negatives, whitening and token files against plain versions."""

import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.llm import op11_angular_negatives as negatives
from tideline.llm import op12_plane_files as planes
from tideline.llm import op13_polarised_whitening as whitening
from tideline.llm.common import shared_folder

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, label int"


# ---------------------------------------------------------------- hard negatives

def usable(rows):
    length = max({len(v) for _, v, y in rows if v}, key=lambda n: (sum(1 for _, v, y in rows if v and len(v) == n and y is not None), n), default=0)
    return [(i, [math.floor(256 * float(c)) for c in v], y) for i, v, y in rows
            if y is not None and v and len(v) == length and all(c is not None and math.isfinite(c) for c in v)]


def mined(rows, every=100):
    rows, out = usable(rows), []
    behind = lambda i: (i is None, i or 0)
    for i, x, y in rows:
        if i is None or i % every:
            continue
        scored = sorted(((-sum(a * b for a, b in zip(x, v)), behind(j), j, z) for j, v, z in rows if j != i), key=lambda s: s[:2])
        for p, _, j, _ in [s for s in scored if s[3] == y][:5]:
            window = [s for s in scored if s[3] != y and 80 * -p <= 100 * -s[0] <= 100 * -p][:5]
            out += [(i, j, r + 1, s[2], -p, -s[0]) for r, s in enumerate(window)]
    return sorted(out, key=str)


def vectors(number, dims=6, seed=1, spread=0.4):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((4, dims))
    return [(int(i), [float(np.float32(c)) for c in centres[i % 4] + spread * rng.standard_normal(dims)], int(i % 3)) for i in range(number)]


ODD = [(100, None, 1), (200, [], 1), (300, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (400, [math.nan] * 6, 2), (500, [math.inf] + [0.0] * 5, 2),
       (600, [1.0] * 6, None), (700, [0.0] * 6, 1), (None, [0.9] * 6, 1), (None, [0.9] * 6, 2), (800, [0.5] * 5, 1), (900, [0.7] * 6, 0)]


@pytest.mark.parametrize("rows", [
    vectors(400), vectors(300, spread=0.0), vectors(250) + ODD, ODD, [r for r in vectors(120) for _ in range(3)],
    [(i, [-1.0] * 6 if i % 2 else [1.0] * 6, i % 2) for i in range(150)], [(0, [1.0, 2.0], 1)]], ids=["groups", "ties", "odd", "only odd", "repeated", "negative", "one"])
def test_negatives_equal_brute_force(spark, rows):
    found = negatives.mine_negatives(spark.createDataFrame(rows, VECTORS))
    assert sorted(map(tuple, found.collect()), key=str) == mined(rows)


def test_negatives_in_small_blocks_with_other_columns(spark):
    rows = vectors(500, seed=3)
    df = spark.createDataFrame(rows, VECTORS).withColumns({c: F.lit("x") for c in ("id", "x", "score", "query", "norm", "seed", "_pos")})
    found = negatives.mine_negatives(df, every=10, block_bytes=12 * 900)
    assert sorted(map(tuple, found.collect()), key=str) == mined(rows, every=10)


def test_negatives_of_long_vectors_are_exact(spark):
    rows = [(i, [c * 3e5 for c in v], y) for i, v, y in vectors(220, dims=8, seed=5)]
    schema = "vec_id long, embedding array<double>, label int"
    assert sorted(map(tuple, negatives.mine_negatives(spark.createDataFrame(rows, schema)).collect()), key=str) == mined(rows)
    with pytest.raises(Exception, match="too long"):
        negatives.mine_negatives(spark.createDataFrame([(0, [1e9, 0.0], 1), (1, [1.0, 0.0], 1)], schema))


def test_negatives_of_nothing(spark):
    assert negatives.mine_negatives(spark.createDataFrame([], VECTORS)).count() == 0


def test_score_bounds_hold_for_every_row():
    rng = np.random.default_rng(2)
    x, a = np.floor(256 * rng.standard_normal((300, 16))), np.floor(256 * rng.standard_normal((40, 16)))
    x[:3], a[0] = 0, 0
    x[5], x[6] = 3 * a[7], -a[8]
    references = negatives.reference_directions(x, 8)
    measure = lambda m: (np.linalg.norm(m, axis=1), np.arccos(np.clip(m @ references.T / np.maximum(np.linalg.norm(m, axis=1), 1)[:, None], -1, 1)))
    (norms, angles), (anchor_norms, anchor_angles) = measure(x), measure(a)
    pruned = 0
    for i in range(0, 300, 7):
        part = slice(i, i + 7)
        low, high = negatives.score_bounds(anchor_angles, anchor_norms, angles[part].min(axis=0), angles[part].max(axis=0), norms[part].min(), norms[part].max())
        scores = x[part] @ a.T
        assert (scores >= low).all() and (scores <= high).all()
    for i in range(300):  # single rows: the interval is narrower than all scores of that length
        low, high = negatives.score_bounds(anchor_angles, anchor_norms, angles[i], angles[i], norms[i], norms[i])
        pruned += (high < 0.9 * norms[i] * anchor_norms).sum()
    assert pruned > 300


def test_registered_negatives_equal_brute_force(spark):
    rows = [(i, v, (y + 1) % 10 if i % 7 == 0 else y) for i, v, y in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert sorted(map(tuple, negatives.op11_angular_negatives(spark, SF).collect()), key=str) == mined(rows)


# ---------------------------------------------------------------- token files

def encoded(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(planes.byte_model())
    return [np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [0], dtype="<u4") for t in texts]


def digests(pairs):
    """Expected rows of (id, text): in the order of ids, NULL first."""
    ids = encoded([t for _, t in pairs])
    order = sorted(range(len(pairs)), key=lambda i: (pairs[i][0] is not None, pairs[i][0] or 0))
    out, at = [], 0
    for i in order:
        out.append((pairs[i][0], at, len(ids[i]), zlib.crc32(ids[i].tobytes())))
        at += len(ids[i])
    return out


TEXTS = [None, "", " ", "a", "  two  spaces  ", "line\nbreak \n end", "don't I'LL 12½ Ⅷ 一 二 x", "a<|endoftext|> b <|endoftext|>", "x \x85y \x1c z　 w",
         "😀 ok \U000e0001 ", "é ​ ᠎  ", "word " * 40_000, "x" * 100_000]


def test_files_hold_what_the_library_encodes(spark):
    pairs = [(7 * i - 20, t) for i, t in enumerate(TEXTS)] + [(None, "no id")]
    df = spark.createDataFrame(pairs, "doc_id int, text string").withColumns({c: F.lit(1) for c in ("id", "_hash", "part", "content")}).repartition(5)
    for kind, file_ids, block_ids in (("byte", 2_000_000, 65_536), ("bit", 5000, 1000), ("bit", 1, 7)):
        folder = shared_folder(spark, "planes")
        planes.write_token_files(df, folder, planes.byte_model(), kind=kind, file_ids=file_ids, block_ids=block_ids, partitions=3)
        back = sorted(planes.read_token_files(spark, folder).collect(), key=lambda r: r.start)
        assert [tuple(r)[:4] for r in back] == digests(pairs)
        whole = np.concatenate([np.array(r.ids) for r in back])
        for start, stop in ((0, 1), (990, 20_010), (len(whole) - 3, len(whole) + 9), (5, 5)):
            parts = planes.read_stretch(spark, folder, start, stop).orderBy("first_id").collect()
            assert [i for p in parts for i in p.ids] == whole[start:stop].tolist()


def test_rows_with_equal_ids_and_no_rows(spark):
    texts = ["one", "two words", "one", "three", None] * 9
    folder = shared_folder(spark, "planes")
    planes.write_token_files(spark.createDataFrame([(5, t) for t in texts], "doc_id long, text string"), folder, planes.byte_model())
    back = sorted(planes.read_token_files(spark, folder).collect(), key=lambda r: r.start)
    assert sorted(r.ids_crc32 for r in back) == sorted(zlib.crc32(x.tobytes()) for x in encoded(texts))
    assert [r.start for r in back] == list(np.cumsum([0] + [r.n_tokens for r in back])[:-1])
    empty = shared_folder(spark, "planes")
    planes.write_token_files(spark.createDataFrame([], "doc_id long, text string"), empty, planes.byte_model())
    assert planes.read_token_files(spark, empty).count() == 0 and planes.read_stretch(spark, empty, 0, 9).count() == 0


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_one_file(kind):
    rng = np.random.default_rng(4)
    for ids in (np.zeros(0, "<u4"), np.array([2 ** 32 - 1], "<u4"), rng.integers(0, 50_257, 1001).astype("<u4"), np.zeros(513, "<u4")):
        content = planes.pack_file(ids, [3, None], [len(ids), 0], kind, block_ids=100)
        stored = planes.PlaneFile.open(content)
        assert (stored.ids() == ids).all() and stored.doc_ids == [3, None] and stored.lengths.tolist() == [len(ids), 0]
        assert (stored.ids(150, 333) == ids[150:333]).all()
    damaged = bytearray(planes.pack_file(rng.integers(0, 50_257, 5000).astype("<u4"), [1], [5000], kind))
    damaged[len(planes.MAGIC) + 30] ^= 1
    with pytest.raises(Exception):
        planes.PlaneFile.open(bytes(damaged)).ids()
    with pytest.raises(ValueError):
        planes.PlaneFile.open(bytes(damaged[:-9]) + b"x" * 9)


def test_registered_files_equal_the_library(spark):
    pairs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    setting = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(map(tuple, planes.op12_plane_files(spark, SF).collect())) == digests(pairs)
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == setting


# ---------------------------------------------------------------- whitening

def check_whitening(found, rows, components=8):
    """``found`` against a plain computation; rows are (id, vector), all usable and of one length."""
    x = np.array([[math.floor(1024 * float(c)) + 100_000 for c in v] for _, v in rows], dtype=object)
    n, sums = len(x), x.sum(axis=0)
    deviation = ((n * x - sums) ** 2).sum(axis=1)
    centred = np.array([[float((n * v - s) / n) for v, s in zip(row, sums)] for row in x])
    covariance = centred.T @ centred / n
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1], axes[:, ::-1]
    number = min(components, x.shape[1])
    assert len(found) == n * number and {r.n for r in found} <= {n}
    assert sorted((str(r.vec_id), int(r.deviation_exact)) for r in found if r.component == 1) == sorted((str(i), int(d)) for (i, _), d in zip(rows, deviation))
    for k in range(number):
        mine = [r for r in found if r.component == k + 1]
        if values[k] > 1e-9 * values[0]:
            expected = centred @ axes[:, k] / math.sqrt(values[k])
            by_id = {}
            for (i, _), w in zip(rows, expected):
                by_id[i] = w
            sign = 1 if sum(r.whitened * by_id[r.vec_id] for r in mine) > 0 else -1
            assert max(abs(sign * r.whitened - by_id[r.vec_id]) for r in mine) < 1e-6
            assert all(abs(r.explained - values[k] / values.sum()) < 1e-9 and r.identity_error < 1e-6 for r in mine)
        else:
            assert all(r.whitened is None for r in mine)


def plain(number, dims, seed=1, scale=0.1):
    rng = np.random.default_rng(seed)
    stretch = np.linspace(1, 3, dims)
    return [(i, [float(np.float32(c)) for c in scale * stretch * rng.standard_normal(dims) + 0.3]) for i in range(number)]


def test_whitening_equals_a_plain_computation(spark):
    schema = "vec_id long, embedding array<float>"
    for rows in (plain(300, 10), plain(200, 3), plain(50, 12) + plain(50, 12)):
        check_whitening(whitening.whiten(spark.createDataFrame(rows, schema)).collect(), rows)


def test_whitening_of_large_components(spark):
    rows = plain(80, 9, scale=1e12)
    found = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    check_whitening(found, rows)
    assert all(r.deviation is None or r.deviation == int(r.deviation_exact) for r in found) and any(r.deviation is None for r in found)
    with pytest.raises(Exception, match="no 64-bit integer form"):
        whitening.whiten(spark.createDataFrame([(1, [1e300])], "vec_id long, embedding array<double>"))


def test_whitening_leaves_out_what_has_no_place(spark):
    rows = plain(60, 6)
    odd = [(900, None), (901, []), (902, [None] * 6), (903, [math.nan] + [1.0] * 5), (904, [-math.inf] * 6), (905, [1.0] * 5), (906, [1.0] * 7)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").withColumns({c: F.lit(1) for c in ("_x", "_w", "n", "component", "whitened")})
    check_whitening(whitening.whiten(df).collect(), rows)
    assert whitening.whiten(spark.createDataFrame(odd[:5], "vec_id long, embedding array<double>")).count() == 0
    assert whitening.whiten(spark.createDataFrame([], "vec_id long, embedding array<double>")).count() == 0


def test_whitening_without_variance(spark):
    flat = [(i, [0.5, 0.25 * (i % 4), 0.125]) for i in range(40)] + [(None, [0.5, 0.25, 0.125])]
    found = whitening.whiten(spark.createDataFrame(flat, "vec_id long, embedding array<double>")).collect()
    assert len(found) == 41 * 3 and all((r.whitened is None) == (r.component > 1) for r in found) and max(r.identity_error for r in found) < 1e-9
    alone = whitening.whiten(spark.createDataFrame([(4, [0.5, 0.1])], "vec_id long, embedding array<double>")).collect()
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in alone] == [(1, 1, 0, None, None, None), (2, 1, 0, None, None, None)]


def test_polarised_sums_are_exact():
    rng = np.random.default_rng(8)
    for most in (5, 2 ** 20, 2 ** 40):
        values = rng.integers(-most, most, (4, 3000))
        assert whitening.square_sums(values) == [sum(int(v) ** 2 for v in row) for row in values]


def test_registered_whitening_equals_a_plain_computation(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    df = whitening.op13_polarised_whitening(spark, SF)
    assert [(f.name, f.dataType) for f in df.schema.fields][:5] == [("vec_id", T.LongType()), ("component", T.IntegerType()), ("n", T.LongType()),
                                                                  ("deviation", T.LongType()), ("whitened", T.DoubleType())]
    check_whitening(df.collect(), rows)


def test_stretches_are_learned_many_at_a_time():
    """Stretches with line ends too; Arrow in, the library's ids out, odd spaces included."""
    encoder = planes.Encoder(planes.byte_model())
    rng = random.Random(12)
    texts = [" ".join(f"w{i}é\nx{rng.randrange(10 ** 6)}" for _ in range(30)) for i in range(200)]
    odd = ["", " ", "  a", "a  b", "a \n b c", "x ", "\n", "a　b c", "it 's a"]
    asked = []
    plain = encoder._plain
    encoder._plain = lambda some: asked.append(len(some)) or plain(some)
    out = encoder.encode(pa.array(texts))
    assert sum(asked) <= len(texts) + 6000 // planes._TOGETHER + 1
    for given, found in ((texts, out), (odd, encoder.encode(odd)), (texts, encoder.encode(texts))):
        assert found == [np.asarray(encoder.tokenizer.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes() for t in given]
    assert encoder.encode([]) == []

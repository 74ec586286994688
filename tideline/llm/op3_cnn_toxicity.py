"""Toxicity by a convolutional text classifier.

Words are hashed into two embedding tables (their sum is a word's vector, so one collision does not make two words alike).
Filters of several widths slide over the whole text, the largest response of each filter is kept, and a logistic layer turns
the responses into a score. Every labelled row outside the held-out fold counts. The embeddings start from the words' log odds,
which Spark counts over the rows; then come passes over all of them: texts are dealt to shards by hash, a task per shard learns in numpy from
the same start, and the shards' parameters are averaged between passes (an embedding row over the shards that changed it). Only the
network, whose size is fixed, comes to the driver. Few labels fill one shard, more labels get fewer passes, never less than two; the result does not
depend on how the tables are partitioned. A fifth of the labels, by hash, is not learned from and gives each language its threshold; the
language is read off the text's function words. Scores are shifted so that a language's threshold is 0.5.

NULL text is an empty text; an empty text is scored like any other (all responses zero). NULL ids are never held out, and
labels without a document or with a NULL label are not learned from; of repeated labels of a document the largest counts.
Repeated rows and further columns have no influence: every input row gets one output row, an empty table an empty result.
Without labels of both kinds every score is the share of toxic labels (0 without labels).
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import broadcast_within, small_batches, staged
from tideline.llm.registry import llm_query, table

WORD = re.compile(r"\w+")
ROWS = 1 << 17
DIMS = 8
FILTERS = 16
WIDTHS = (1, 2, 3)
# Tokens per block of the convolution.
BLOCK = 1 << 15
_PAD = ROWS  # the row of zeros between texts
# Rows of the embedding tables that are averaged together.
PART = 1 << 12
# Labels are sent to the documents if their rows take no more bytes.
_SENT_BYTES = 16 << 20
# Bits that tell most documents without a label where there are more, and those of one segment.
_MARKS, _SEGMENT = 27, 20

# Frequent function words of the languages.
FUNCTION_WORDS = {
    "en": "the of and to in is that for it with was on are this be by from at an or which not",
    "fr": "le la les de des du et un une que qui dans est pour par sur avec pas au aux plus ne",
    "de": "der die das und von zu den dem ein eine mit ist nicht auf für als des im auch sich bei",
    "es": "el la los las de del y que en un una por con para es se no al su lo como más",
}
LANGUAGES = tuple(FUNCTION_WORDS)


@dataclass(frozen=True)
class Bounds:
    epochs: int = 6
    least_epochs: int = 2
    seen: int = 40_000  # no further passes once so many texts were seen, beyond ``least_epochs``
    shard: int = 4096  # texts that a shard has at least, if there are several
    shards: int = 32
    batch: int = 64
    calibration: int = 5  # one row in so many sets thresholds
    least_toxic: int = 20  # toxic rows that a language needs for a threshold of its own


class _Rows(dict):
    """Word to its rows in both tables, remembered up to a limit."""

    def __missing__(self, word: str) -> int:
        if len(self) > 300_000:
            self.clear()
        data = word.encode("utf-8", "surrogatepass")
        value = (zlib.crc32(data) % ROWS) | (zlib.adler32(data[::-1]) * 2654435761 + len(data)) % ROWS << 32
        self[word] = value
        return value


def token_rows(texts: Sequence[str | None], cache: _Rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows in table one and two of all words, the texts parted by pads, and where each text starts."""
    gap = [_PAD | _PAD << 32] * max(WIDTHS)
    flat: list[int] = []
    starts = []
    for text in texts:
        starts.append(len(flat))
        flat.extend([cache[w] for w in WORD.findall(text.lower())] if text else ())
        flat.extend(gap)
    packed = np.array(flat, dtype=np.int64)
    return packed & 0xFFFFFFFF, packed >> 32, np.array(starts, dtype=np.int64)


def _language_tables() -> tuple[np.ndarray, np.ndarray]:
    """Per row of the tables a bit mask of the languages with a function word there."""
    one, two, cache = np.zeros(ROWS + 1, dtype=np.uint8), np.zeros(ROWS + 1, dtype=np.uint8), _Rows()
    for i, words in enumerate(FUNCTION_WORDS.values()):
        for w in words.split():
            one[cache[w] & 0xFFFFFFFF] |= 1 << i
            two[cache[w] >> 32] |= 1 << i
    return one, two


def languages(first: np.ndarray, second: np.ndarray, starts: np.ndarray, tables: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The language with most function words in each text; ``len(LANGUAGES)`` without any."""
    bits = tables[0][first] & tables[1][second]
    hits = np.stack([np.add.reduceat((bits >> i) & 1, starts, dtype=np.int64) for i in range(len(LANGUAGES))], axis=1)
    return np.where(hits.max(axis=1) > 0, hits.argmax(axis=1), len(LANGUAGES))


@dataclass
class Network:
    one: np.ndarray  # embedding tables, (ROWS + 1) x DIMS
    two: np.ndarray
    filters: list[np.ndarray]  # per width: width x DIMS x FILTERS
    biases: list[np.ndarray]
    weights: np.ndarray
    bias: float
    shifts: np.ndarray  # per language, subtracted from the logit

    def responses(self, first: np.ndarray, second: np.ndarray, starts: np.ndarray, where: bool = False):
        """Largest response of each filter in each text (0 at least), and its position if asked for."""
        best = np.zeros((len(starts), len(WIDTHS) * FILTERS), dtype=np.float32)
        at = np.zeros(best.shape, dtype=np.int64)
        ends = np.append(starts[1:], len(first))
        i = 0
        while i < len(first):
            stop = min(i + BLOCK, len(first))
            reach = min(stop + max(WIDTHS) - 1, len(first))
            vectors = self.one[first[i:reach]] + self.two[second[i:reach]]
            low, high = np.searchsorted(ends, i, "right"), np.searchsorted(starts, stop, "left")
            cuts = np.maximum(starts[low:high], i) - i
            for k, width in enumerate(WIDTHS):
                n = min(stop, len(first) - width + 1) - i
                if n <= 0:
                    continue
                out = np.broadcast_to(self.biases[k], (n, FILTERS)).copy()
                for j in range(width):
                    out += vectors[j:j + n] @ self.filters[k][j]
                # The pads behind a text stand for its end; a window that starts there sees no word.
                inside = cuts < n
                columns = slice(k * FILTERS, (k + 1) * FILTERS)
                rows = np.arange(low, high)[inside]
                out[first[i:i + n] == _PAD] = 0
                top = np.maximum.reduceat(out, cuts[inside], axis=0)
                better = top > best[rows, columns]
                if where:
                    for r, a, b in zip(rows, cuts[inside], np.append(cuts[inside][1:], n)):
                        place = out[a:b].argmax(axis=0) + a + i
                        mark = better[r - rows[0]]
                        at[r, columns] = np.where(mark, place, at[r, columns])
                best[rows, columns] = np.maximum(best[rows, columns], top)
            i = stop
        return best, at

    def logits(self, responses: np.ndarray) -> np.ndarray:
        return responses @ self.weights + self.bias


def _odds(seen: np.ndarray, toxic: np.ndarray, prior: float) -> np.ndarray:
    """Smoothed log odds of a toxic text by table row, from the numbers of texts; rows seen rarely stay near zero."""
    share = (toxic + 8 * prior) / (seen + 8)
    odds = np.log(share / (1 - share)) - np.log(prior / (1 - prior))
    odds[_PAD] = 0
    return np.clip(odds, -3, 3)


def _texts_by_row(first: np.ndarray, second: np.ndarray, starts: np.ndarray, labels: np.ndarray, counts: np.ndarray) -> None:
    """Add the texts, and the toxic ones, that hold each row of table one and two to ``counts`` (2 tables x 2 numbers x rows)."""
    for k, rows in enumerate((first, second)):
        for a, b, y in zip(starts, np.append(starts[1:], len(first)), labels):
            own = np.unique(rows[a:b])
            counts[k, 0, own] += 1
            counts[k, 1, own] += int(y)


@dataclass
class Learner:
    """A network and the state of its descent: Adam for filters and output, Adagrad for the embedding rows that a batch touches."""

    net: Network
    moments: list[tuple[np.ndarray, np.ndarray]]
    bias_moments: list[float]
    squares: list[np.ndarray]
    step: int = 0
    changed: list[np.ndarray] = field(default_factory=lambda: [np.zeros(ROWS + 1, dtype=bool) for _ in range(2)])

    @staticmethod
    def start(odds: Sequence[np.ndarray], prior: float, rng: np.random.Generator) -> Learner:
        tables = [rng.normal(0, 0.05, (ROWS + 1, DIMS)).astype(np.float32) for _ in range(2)]
        for values, own in zip(tables, odds):
            values[:, 0] = own / 2
            values[_PAD] = 0
        filters = [rng.normal(0, 0.3, (w, DIMS, FILTERS)).astype(np.float32) for w in WIDTHS]
        for f in filters:
            f[0, 0, :] = np.abs(f[0, 0, :]) + 0.5
        biases = [np.zeros(FILTERS, dtype=np.float32) for _ in WIDTHS]
        weights = rng.normal(0, 0.1, len(WIDTHS) * FILTERS).astype(np.float32)
        prior = float(np.clip(prior, 1e-4, 1 - 1e-4))
        net = Network(*tables, filters, biases, weights, float(np.log(prior / (1 - prior))), np.zeros(len(LANGUAGES) + 1, dtype=np.float32))
        dense = [*filters, *biases, weights]
        return Learner(net, [(np.zeros_like(p), np.zeros_like(p)) for p in dense], [0.0, 0.0], [np.full(ROWS + 1, 1e-4, dtype=np.float32) for _ in range(2)])

    def dense(self) -> list[np.ndarray]:
        return [*self.net.filters, *self.net.biases, self.net.weights]

    def learn(self, first: np.ndarray, second: np.ndarray, starts: np.ndarray, labels: np.ndarray, rate: float, rng: np.random.Generator) -> None:
        """One step down the gradient of these texts."""
        net, dense, batch = self.net, self.dense(), len(starts)
        dropped = rng.random(len(first)) < 0.1
        first, second = np.where(dropped, _PAD, first), np.where(dropped, _PAD, second)
        best, at = net.responses(first, second, starts, where=True)
        error = (1 / (1 + np.exp(-net.logits(best))) - labels).astype(np.float32) / batch
        back = error[:, None] * net.weights[None, :] * (best > 0)
        grads = [np.zeros_like(p) for p in dense]
        grads[-1][:] = best.T @ error + 1e-4 * net.weights
        touched, changes = [], []
        for k, width in enumerate(WIDTHS):
            columns = slice(k * FILTERS, (k + 1) * FILTERS)
            g, places = back[:, columns], at[:, columns]
            grads[len(WIDTHS) + k][:] = g.sum(axis=0)
            for j in range(width):
                position = np.minimum(places + j, len(first) - 1)
                vectors = net.one[first[position]] + net.two[second[position]]
                grads[k][j] = np.einsum("nf,nfd->df", g, vectors)
                touched.append(position.ravel())
                changes.append((g[:, :, None] * net.filters[k][j].T[None]).reshape(-1, DIMS))
        self.step += 1
        for p, g, (m, v) in zip(dense, grads, self.moments):
            m *= 0.9
            m += 0.1 * g
            v *= 0.999
            v += 0.001 * g * g
            p -= rate * (m / (1 - 0.9 ** self.step)) / (np.sqrt(v / (1 - 0.999 ** self.step)) + 1e-8)
        total = float(error.sum())
        self.bias_moments = [0.9 * self.bias_moments[0] + 0.1 * total, 0.999 * self.bias_moments[1] + 0.001 * total * total]
        net.bias -= rate * (self.bias_moments[0] / (1 - 0.9 ** self.step)) / (np.sqrt(self.bias_moments[1] / (1 - 0.999 ** self.step)) + 1e-8)
        positions, changes = np.concatenate(touched), np.concatenate(changes)
        used = np.abs(changes).sum(axis=1) > 0
        positions, changes = positions[used], changes[used]
        for values, rows, square, changed in ((net.one, first, self.squares[0], self.changed[0]), (net.two, second, self.squares[1], self.changed[1])):
            own_rows, inverse = np.unique(rows[positions], return_inverse=True)
            summed = np.zeros((len(own_rows), DIMS), dtype=np.float32)
            np.add.at(summed, inverse, changes)
            square[own_rows] += (summed * summed).mean(axis=1)
            values[own_rows] -= 0.5 * rate * summed / np.sqrt(square[own_rows])[:, None]
            values[_PAD] = 0
            changed[own_rows] = True

    def parts(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """The state in parts (number, rows, values): the changed rows of the embedding tables with their squares, and as part -1 all the rest."""
        rest = [*self.dense(), *[x for pair in self.moments for x in pair]]
        flat = np.concatenate([x.ravel() for x in rest] + [[self.net.bias, *self.bias_moments, self.step]]).astype(np.float64)
        yield -1, np.zeros(1, dtype=np.int64), flat[None]
        for k, (values, square, changed) in enumerate(zip((self.net.one, self.net.two), self.squares, self.changed)):
            rows = np.flatnonzero(changed)
            for number in np.unique(rows // PART).tolist():
                own = rows[rows // PART == number]
                yield number * 2 + k, own, np.column_stack([values[own], square[own]]).astype(np.float64)

    def put(self, part: int, rows: np.ndarray, values: np.ndarray) -> None:
        """Take a part's values over, the reverse of ``parts``."""
        if part >= 0:
            (self.net.one, self.net.two)[part % 2][rows] = values[:, :DIMS]
            self.squares[part % 2][rows] = values[:, DIMS]
            return
        flat, at = values[0], 0
        for x in [*self.dense(), *[x for pair in self.moments for x in pair]]:
            x[...] = flat[at:at + x.size].reshape(x.shape)
            at += x.size
        self.net.bias, self.bias_moments, self.step = float(flat[at]), [float(x) for x in flat[at + 1:at + 3]], int(round(flat[at + 3]))


def _rate(epoch: int, epochs: int) -> float:
    return 0.01 * (1 - epoch / epochs)


def train(texts: Sequence[str], labels: np.ndarray, bounds: Bounds = Bounds(), seed: int = 11) -> Network:
    """Fit on texts in memory, in one shard."""
    rng = np.random.default_rng(seed)
    cache, tables = _Rows(), _language_tables()
    labels = np.asarray(labels, dtype=np.float32)
    checked = np.zeros(len(texts), dtype=bool)
    for y in (0, 1):  # so that both kinds are in both parts
        own = np.flatnonzero(labels == y)
        checked[own[bounds.calibration - 1::bounds.calibration]] = True
    learned = np.flatnonzero(~checked)
    counts = np.zeros((2, 2, ROWS + 1))
    _texts_by_row(*token_rows([texts[i] for i in learned], cache), labels[learned], counts)
    learner = Learner.start([_odds(*own, labels[learned].mean()) for own in counts], labels.mean(), rng)
    for epoch in range(bounds.epochs):
        order = rng.permutation(len(learned))
        for low in range(0, len(order), bounds.batch):
            chosen = learned[order[low:low + bounds.batch]]
            learner.learn(*token_rows([texts[i] for i in chosen], cache), labels[chosen], _rate(epoch, bounds.epochs), rng)
    if checked.any():
        first, second, starts = token_rows([texts[i] for i in np.flatnonzero(checked)], cache)
        z = learner.net.logits(learner.net.responses(first, second, starts)[0])
        calibrate(learner.net, languages(first, second, starts, tables), z, z, np.ones(len(z)), labels[checked], bounds)
    return learner.net


def calibrate(net: Network, spoken: np.ndarray, low: np.ndarray, high: np.ndarray, rows: np.ndarray, toxic: np.ndarray, bounds: Bounds) -> None:
    """Per language the logit that separates the calibration rows with the best F1; all rows' where a language has too few.

    The rows come in bins: language, lowest and highest logit, number of rows and of toxic ones.
    """

    def threshold(own: np.ndarray) -> float:
        order = np.flatnonzero(own)[np.argsort(-high[own], kind="stable")]
        f1 = 2 * np.cumsum(toxic[order]) / (np.cumsum(rows[order]) + toxic[own].sum())
        i = int(f1.argmax())
        return float((low[order[i]] + (high[order[i + 1]] if i + 1 < len(order) else low[order[i]] - 1)) / 2)

    net.shifts[:] = threshold(np.ones(len(rows), dtype=bool)) if toxic.any() else 0.0
    for i in range(len(LANGUAGES)):
        if toxic[spoken == i].sum() >= bounds.least_toxic:
            net.shifts[i] = threshold(spoken == i)


def labelled_texts(docs: DataFrame, labels: DataFrame, bounds: Bounds = Bounds(), sent_bytes: int = _SENT_BYTES) -> DataFrame:
    """All labels outside the held-out fold with the words of their texts, stored: doc_id, toxic, checked, spoken, n, words.

    A text of an id counts once, however often it is repeated. ``checked`` marks the rows that set thresholds. Labels of at most ``sent_bytes`` are sent
    to the documents; of more, a bitmap of fixed size is, and the packed words of the documents that it lets through meet the labels in a shuffle.
    """
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    known = staged(known.where(~held_out(F.col("doc_id"))).withColumnRenamed("doc_id", "_id"), "labels")
    rows = docs.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull()).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    sent, same = broadcast_within(known, sent_bytes), F.col("doc_id") == F.col("_id")
    if sent is known:
        rows = packed_words(rows, "doc_id", docs.sparkSession.sparkContext.broadcast(id_marks(known))).join(known.hint("merge"), same)
    else:
        rows = packed_words(rows.join(sent, same))
    checked = F.pmod(F.xxhash64("doc_id", F.lit("calibration")), F.lit(bounds.calibration)) == 0
    return staged(rows.dropDuplicates(["doc_id", "words"]).select("doc_id", "toxic", checked.alias("checked"), "spoken", "n", "words"), "labelled")


def _mark(doc_id: str):
    return F.pmod(F.xxhash64(doc_id), F.lit(1 << _MARKS))


def id_marks(known: DataFrame) -> np.ndarray:
    """One bit per ``_mark`` of the ids, put together in segments; ``2 ** _MARKS`` bits on the driver."""

    def put(segment: pd.DataFrame) -> pd.DataFrame:
        marks = np.zeros(1 << _SEGMENT, dtype=bool)
        marks[segment["bit"].to_numpy() & ((1 << _SEGMENT) - 1)] = True
        return pd.DataFrame({"segment": segment["segment"].iloc[:1], "marks": [np.packbits(marks).tobytes()]})

    bits = known.select(_mark("_id").alias("bit")).withColumn("segment", F.shiftright("bit", _SEGMENT))
    out = np.zeros((1 << (_MARKS - _SEGMENT), (1 << _SEGMENT) // 8), dtype=np.uint8)
    for row in bits.groupBy("segment").applyInPandas(put, "segment long, marks binary").toLocalIterator():
        out[row["segment"]] = np.frombuffer(row["marks"], dtype=np.uint8)
    return out.ravel()


def packed_words(rows: DataFrame, doc_id: str | None = None, marks=None) -> DataFrame:
    """``rows`` with the language, the number of table rows and the packed table rows of ``text`` (both tables, the pads behind them) in its place.

    With broadcast ``id_marks``, only of the rows whose ``doc_id`` they hold (and of few others).
    """
    small_batches(rows.sparkSession, 200)
    others = [c for c in rows.columns if c != "text"]
    rows = rows.select(*others, "text", *([_mark(doc_id).alias("_mark")] if marks else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, tables = _Rows(), _language_tables()
        for batch in batches:
            if marks:
                bit = batch.column(len(others) + 1).to_numpy()
                batch = batch.filter(pa.array((marks.value[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8) & 1).astype(bool)))
            if not batch.num_rows:
                continue
            first, second, starts = token_rows(batch.column(len(others)).to_pylist(), cache)
            flat, ends = first | second << 32, np.append(starts[1:], len(first))
            words = [pa.compress(flat[a:b].tobytes(), codec="zstd", asbytes=True) for a, b in zip(starts, ends)]
            added = [pa.array(languages(first, second, starts, tables), type=pa.int32()), pa.array(ends - starts, type=pa.int32()), pa.array(words, type=pa.binary())]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(others))], *added], names=[*others, "spoken", "n", "words"])

    zero = F.lit(0).cast("int")
    return rows.mapInArrow(run, rows.select(*others).withColumns({"spoken": zero, "n": zero, "words": F.lit(b"")}).schema)


def _unpacked(n: pa.Array, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = n.to_numpy().astype(np.int64)
    flat = np.concatenate([np.frombuffer(pa.decompress(w, 8 * int(k), "zstd"), dtype=np.int64) for k, w in zip(sizes, words.to_pylist())])
    return flat & 0xFFFFFFFF, flat >> 32, np.cumsum(sizes) - sizes


def text_counts(rows: DataFrame) -> np.ndarray:
    """Over all ``rows``, the texts and the toxic texts that hold each row of the embedding tables."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, 2, ROWS + 1), dtype=np.int64)
        for batch in batches:
            if batch.num_rows:
                _texts_by_row(*_unpacked(batch.column(1), batch.column(2)), batch.column(0).to_numpy(), counts)
        for k in range(2):
            own = np.flatnonzero(counts[k, 0])
            yield pa.RecordBatch.from_arrays([pa.array(own * 2 + k), pa.array(counts[k, 0, own]), pa.array(counts[k, 1, own])], names=["row", "seen", "toxic"])

    found = rows.select("toxic", "n", "words").mapInArrow(run, "row long, seen long, toxic long").groupBy("row").agg(F.sum("seen").alias("seen"), F.sum("toxic").alias("toxic")).toArrow()
    counts = np.zeros((2, 2, ROWS + 1))
    row = found.column("row").to_numpy()
    counts[row % 2, 0, row // 2], counts[row % 2, 1, row // 2] = found.column("seen").to_numpy(), found.column("toxic").to_numpy()
    return counts


def one_pass(rows: DataFrame, learner: Learner, epoch: int, epochs: int, shards: int, bounds: Bounds = Bounds(), seed: int = 11) -> Learner:
    """The state after every row was learned from once: a task per shard, each from ``learner``, their states averaged."""
    rate = _rate(epoch, epochs)
    dealt = rows.select("doc_id", "toxic", "n", "words", F.xxhash64("doc_id", F.lit(epoch)).alias("order")).withColumn("shard", F.pmod("order", F.lit(shards)).cast("int"))
    dealt = dealt.repartitionById(shards, F.col("shard")).sortWithinPartitions("order", "doc_id", F.xxhash64("words")).select("shard", "toxic", "n", "words")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, number, rng = [], -1, None

        def take(table: pa.Table) -> None:
            table = table.combine_chunks()
            learner.learn(*_unpacked(table.column("n"), table.column("words")), table.column("toxic").to_numpy().astype(np.float32), rate, rng)

        for batch in batches:
            if not batch.num_rows:
                continue
            if rng is None:
                number = batch.column("shard")[0].as_py()
                rng = np.random.default_rng((seed, epoch, number))
            held.append(batch)
            if sum(b.num_rows for b in held) >= bounds.batch:
                table = pa.Table.from_batches(held)
                whole = table.num_rows // bounds.batch * bounds.batch
                for low in range(0, whole, bounds.batch):
                    take(table.slice(low, bounds.batch))
                held = table.slice(whole).to_batches()
        if held:
            take(pa.Table.from_batches(held))
        if rng is None:
            return
        for part, own, values in learner.parts():
            yield pa.RecordBatch.from_arrays([pa.array([part], type=pa.int32()), pa.array([number], type=pa.int32()), pa.array([own.astype(np.int64).tobytes()], type=pa.binary()),
                                              pa.array([values.tobytes()], type=pa.binary())], names=["part", "shard", "rows", "values"])

    def average(found: pd.DataFrame) -> pd.DataFrame:
        found = found.sort_values("shard")
        own = [np.frombuffer(r, dtype=np.int64) for r in found["rows"]]
        rows, inverse = np.unique(np.concatenate(own), return_inverse=True)
        values = np.concatenate([np.frombuffer(v, dtype=np.float64).reshape(len(r), -1) for r, v in zip(own, found["values"])])
        sums = np.zeros((len(rows), values.shape[1]))
        np.add.at(sums, inverse, values)
        sums /= np.bincount(inverse)[:, None]
        return pd.DataFrame({"part": [int(found["part"].iloc[0])], "rows": [rows.tobytes()], "values": [sums.tobytes()]})

    found = dealt.mapInArrow(run, "part int, shard int, rows binary, values binary").groupBy("part").applyInPandas(average, "part int, rows binary, values binary")
    for r in found.collect():
        own = np.frombuffer(r["rows"], dtype=np.int64)
        learner.put(r["part"], own, np.frombuffer(r["values"], dtype=np.float64).reshape(len(own), -1))
    return learner


def calibration_bins(rows: DataFrame, net: Network) -> pa.Table:
    """All ``rows`` by language and logit, to 1/256: spoken, lowest and highest logit, number of rows and of toxic ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                z = net.logits(net.responses(*_unpacked(batch.column(2), batch.column(3)))[0]).astype(np.float64)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(z)], names=["spoken", "toxic", "z"])

    scored = rows.select("spoken", "toxic", "n", "words").mapInArrow(run, "spoken int, toxic int, z double")
    bins = scored.groupBy("spoken", F.floor(F.greatest(F.lit(-30), F.least(F.lit(30), F.col("z"))) * 256).alias("bin"))
    return bins.agg(F.min("z").alias("low"), F.max("z").alias("high"), F.count(F.lit(1)).alias("rows"), F.sum("toxic").alias("toxic")).orderBy("spoken", "bin").toArrow()


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def score_texts(docs: DataFrame, net: Network | float, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and ``score`` of every row."""
    if isinstance(net, float):
        return docs.select(*keep, F.lit(net).alias("score"))
    small_batches(docs.sparkSession, 200)
    source = docs.select(*keep, F.col(text).alias("_text"))
    schema = source.drop("_text").withColumn("score", F.lit(0.0)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, tables = _Rows(), _language_tables()
        for batch in batches:
            if not batch.num_rows:
                continue
            first, second, starts = token_rows(batch.column(len(keep)).to_pylist(), cache)
            z = net.logits(net.responses(first, second, starts)[0]) - net.shifts[languages(first, second, starts, tables)]
            score = 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -30, 30)))
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(keep))], pa.array(score)], names=[*keep, "score"])

    return source.mapInArrow(run, schema)


def fit_toxicity(docs: DataFrame, labels: DataFrame, bounds: Bounds = Bounds(), seed: int = 11) -> Network | float:
    rows = labelled_texts(docs, labels, bounds)
    counts = {(r["checked"], r["toxic"]): r["count"] for r in rows.groupBy("checked", "toxic").count().collect()}
    total, toxic = sum(counts.values()), sum(n for (_, y), n in counts.items() if y)
    if not 0 < toxic < total:
        return toxic / total if total else 0.0
    # too few rows to lack some: all are learned from and set the thresholds
    parted = all(counts.get((c, y)) for c in (False, True) for y in (0, 1))
    learned, checked = (rows.where("NOT checked"), rows.where("checked")) if parted else (rows, rows)
    n, own_toxic = (counts[False, 0] + counts[False, 1], counts[False, 1]) if parted else (total, toxic)
    shards = max(1, min(bounds.shards, n // bounds.shard))
    epochs = max(min(bounds.least_epochs, bounds.epochs), min(bounds.epochs, -(-bounds.seen // n)))
    learner = Learner.start([_odds(*own, own_toxic / n) for own in text_counts(learned)], toxic / total, np.random.default_rng(seed))
    for epoch in range(epochs):
        learner = one_pass(learned, learner, epoch, epochs, shards, bounds, seed)
    bins = calibration_bins(checked, learner.net)
    calibrate(learner.net, *[bins.column(c).to_numpy() for c in ("spoken", "low", "high", "rows", "toxic")], bounds)
    return learner.net


@llm_query("op3_cnn_toxicity")
def op3_cnn_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    net = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return score_texts(docs, net).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))

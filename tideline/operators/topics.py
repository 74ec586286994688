"""Topics of a corpus whose vocabulary is a table (T6): online variational Bayes with every word's weights in rows, never on the driver.

Texts are packed into blocks of bounded size, each with the list of its own words in the order of their hashes. The vocabulary is cut by hash into parts of bounded size,
so a part's words stand side by side in every block. In a pass a part sends each block the weights of its words as bare numbers in the block's order; the block finds
its texts' topics and sends back as many; the part adds them up. What moves in a pass follows the blocks' words, and the driver holds one number per topic.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.linalg import DenseMatrix
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.staging import stage, unstage

# Words of a block, repeats included; a longer text is a block of its own.
BLOCK_WORDS = 1_000_000
# Words of a part of the vocabulary, each counted for every block that holds it, as far as there are more than so few parts; the hashes that parts are cut from.
PART_WORDS, _LEAST_PARTS, _SLOT_BITS = 200_000, 8, 16
# Words (times texts) that are looked at together, so that they stay in the processor's cache.
_CELLS = 32_768
# Fixed values of the published method: slow start and decay of the steps, shape of the starting weights, when a text's topics stand still.
OFFSET, DECAY, SHAPE, STILL = 1024.0, 0.51, 100.0, 1e-3


def digamma(x: np.ndarray) -> np.ndarray:
    """The derivative of the logarithm of the gamma function, for positive numbers."""
    x = np.array(x, dtype=np.float64)
    # the six shifts as one fraction: psi(x) = psi(x + 6) - p'(x) / p(x), p the product of x to x + 5
    z = x * (x + 5)
    a, b, c = z, z + 4, z + 6
    out = -(2 * x + 5) * (a * b + a * c + b * c) / (a * b * c)
    x += 6
    y = 1 / (x * x)
    return out + np.log(x) - 0.5 / x - y * (1 / 12 - y * (1 / 120 - y * (1 / 252 - y * (1 / 240 - y * (1 / 132)))))


def trigamma(x: np.ndarray) -> np.ndarray:
    x = np.array(x, dtype=np.float64)
    out = np.zeros_like(x)
    for _ in range(6):
        out += 1 / (x * x)
        x += 1
    y = 1 / (x * x)
    return out + 1 / x + y / 2 + y / x * (1 / 6 - y * (1 / 30 - y * (1 / 42 - y / 30)))


def text_blocks(corpus: DataFrame, words: str, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(block, words, slots, documents, index, counts, ends): neighbouring texts of a partition with their distinct words by hash, the first bits of the hashes, and how many texts hold each word."""

    def pack(block: int, texts: list[pa.Array]) -> pa.RecordBatch:
        sizes = np.concatenate([t.value_lengths().fill_null(0).to_numpy(zero_copy_only=False) for t in texts])
        coded = pa.concat_arrays([t.flatten() for t in texts]).dictionary_encode()
        row = np.repeat(np.arange(len(sizes), dtype=np.int64), sizes)
        cell, counts = np.unique(row * max(1, len(coded.dictionary)) + coded.indices.to_numpy(), return_counts=True)
        row, index = np.divmod(cell, max(1, len(coded.dictionary)))
        ends = np.cumsum(np.unique(row, return_counts=True)[1])
        hashes = pd.util.hash_array(coded.dictionary.to_numpy(zero_copy_only=False), categorize=False)
        order = np.argsort(hashes, kind="stable")
        place = np.empty(len(order), dtype=np.int32)
        place[order] = np.arange(len(order))
        documents = np.bincount(index, minlength=len(order))[order].astype(np.int32)

        def one(x, kind):
            return pa.array([x], type=kind)

        def listed(x):
            return pa.ListArray.from_arrays(pa.array([0, len(x)], type=pa.int32()), x)

        return pa.RecordBatch.from_arrays(
            [one(block, pa.int64()), listed(coded.dictionary.take(pa.array(order)).cast(pa.string())), one((hashes[order] >> np.uint64(64 - _SLOT_BITS)).astype(np.uint16).tobytes(), pa.binary()),
             listed(pa.array(documents)), one(place[index].tobytes(), pa.binary()), one(counts.astype(np.int32).tobytes(), pa.binary()), one(ends.astype(np.int64).tobytes(), pa.binary())],
            names=["block", "words", "slots", "documents", "index", "counts", "ends"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            texts = batch.column(0)
            lengths = np.cumsum(texts.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            start = 0
            while start < len(texts):
                done = lengths[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(lengths, done + block_words - size, "right")))
                held.append(texts.slice(start, stop - start))
                size += int(lengths[stop - 1] - done)
                start = stop
                if size >= block_words or start < len(texts):
                    yield pack(block, held)
                    block, held, size = block + 1, [], 0
        if size:
            yield pack(block, held)

    return corpus.select(words).mapInArrow(run, "block long, words array<string>, slots binary, documents array<int>, index binary, counts binary, ends binary")


def topics_of(gamma: np.ndarray, own: np.ndarray, count: np.ndarray, alpha: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One plain step: the topics of texts (texts x topics) after those in ``gamma``, with the factors of a word's share in a topic."""
    theta = np.exp(digamma(gamma))  # the common factor of a text's topics cancels out
    share = count / (np.matmul(theta[:, None, :], own)[:, 0, :] + 1e-100)
    return theta * np.matmul(own, share[:, :, None])[:, :, 0] + alpha, theta, share


def settle(weights: np.ndarray, index: np.ndarray, counts: np.ndarray, ends: np.ndarray, alpha: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The topics of the texts of a block (texts x topics), and what its words add to each topic (topics x words)."""
    k, sizes = len(alpha), np.diff(ends, prepend=0)
    gamma = np.random.default_rng(seed).gamma(SHAPE, 1 / SHAPE, (len(ends), k))
    share_of = np.zeros((k, len(index)))
    order, low = np.argsort(sizes, kind="stable"), 0
    while low < len(order):
        # texts of like lengths side by side, the shorter ones filled up with words that do not occur
        high = low + 1
        while high < len(order) and (high + 1 - low) * sizes[order[high]] <= _CELLS:
            high += 1
        live, low = order[low:high], high
        at = np.arange(sizes[live].max())
        real = at < sizes[live][:, None]
        cell = np.where(real, (ends[live] - sizes[live])[:, None] + at, 0)
        count = np.where(real, counts[cell], 0).astype(np.float64)
        own = np.ascontiguousarray(weights[:, index[cell]].transpose(1, 0, 2))
        now, turn = gamma[live], 0
        while len(live):
            one = topics_of(now, own, count, alpha)[0]
            two = topics_of(one, own, count, alpha)[0]
            first, second = one - now, two - one
            moved = np.abs(second).mean(axis=1) > STILL
            if moved.mean() <= 0.8:
                rested = ~moved
                gamma[live[rested]] = two[rested]
                _, theta, share = topics_of(two[rested], own[rested], count[rested], alpha)
                kept = real[rested]
                share_of[:, cell[rested][kept]] = (theta[:, :, None] * own[rested] * share[:, None, :]).transpose(1, 0, 2)[:, kept]
                live, cell, real, count, own, now, two, first, second = (x[moved] for x in (live, cell, real, count, own, now, two, first, second))
            # the two steps say how far it goes on that way (Varadhan and Roland, 2008); what rests is found by plain steps only
            turn += 1
            change = second - first
            far = np.sqrt((first * first).sum(axis=1) / np.maximum((change * change).sum(axis=1), 1e-300))[:, None].clip(1, 100)
            ahead = now + 2 * far * first + far * far * change
            now = np.where((far > 1) & (ahead > alpha).all(axis=1)[:, None], ahead, two) if turn % 8 else two
    return gamma, np.stack([np.bincount(index, weights=share_of[t], minlength=weights.shape[1]) for t in range(k)])


@dataclass
class Vocabulary:
    table: DataFrame

    @property
    def vocabulary(self) -> list[str]:
        """All words on the driver; for small corpora."""
        return [r["word"] for r in self.table.orderBy("term").collect()]


@dataclass
class Topics:
    table: DataFrame
    alpha: np.ndarray

    def getSubsamplingRate(self) -> float:
        """Every pass reads every text."""
        return 1.0

    def topicsMatrix(self) -> DenseMatrix:
        """All weights on the driver, one line per word; for small corpora."""
        rows = [r["lam"] for r in self.table.orderBy("term").collect()]
        return DenseMatrix(len(rows), len(self.alpha), np.array(rows).ravel(order="F").tolist())


@dataclass
class TopicModel:
    """``words``: (term, word, lam), a stored table of every word and its weight in each topic; ``alpha``: the topics' prior."""
    words: DataFrame
    alpha: np.ndarray

    @property
    def stages(self) -> tuple[Vocabulary, Topics]:
        return Vocabulary(self.words), Topics(self.words, self.alpha)

    def describe(self, number: int) -> DataFrame:
        """(topic, rank, word, weight): the heaviest words of each topic."""
        k = len(self.alpha)
        totals = self.words.agg(*[F.sum(F.col("lam")[t]) for t in range(k)]).first()
        rows = []
        for t in range(k):
            best = self.words.select("word", F.col("lam")[t].alias("lam")).orderBy(F.col("lam").desc(), "word").limit(number).collect()
            rows += [(t, i + 1, r["word"], r["lam"] / totals[t]) for i, r in enumerate(best)]
        return self.words.sparkSession.createDataFrame(rows, "topic int, rank int, word string, weight double")


def draws(words: Sequence[str], k: int, seed: int) -> np.ndarray:
    """Starting weights (words x topics): draws of a gamma distribution with mean 1, by the word's hash (Wilson and Hilferty's cube of a normal draw, by Box and Muller)."""
    tails, out = [f"{t}|{x}".encode() for t in range(k) for x in "ab"], bytearray()
    for word in words:
        base = hashlib.md5(f"{word}|{seed}|".encode())
        for tail in tails:
            own = base.copy()
            own.update(tail)
            out += own.digest()[:8]
    uniform = ((np.frombuffer(bytes(out), dtype=">u8") >> 12) / 16.0 ** 13).reshape(len(words), k, 2)
    normal = np.sqrt(-2 * np.log(1 - uniform[:, :, 0])) * np.cos(6.283185307179586 * uniform[:, :, 1])
    return (normal / (3 * math.sqrt(SHAPE)) + (1 - 1 / (9 * SHAPE))) ** 3


def fit_topics(corpus: DataFrame, words: str, topics: int, passes: int, min_documents: float = 1.0, seed: int = 7, block_words: int = BLOCK_WORDS) -> TopicModel:
    """Latent Dirichlet allocation by online variational Bayes (Hoffman, 2010), the prior of the topics learned too; each pass takes all texts as its batch.

    ``min_documents`` below 1 is a share of the texts. Texts without a word teach nothing.
    """
    k, eta = topics, 1.0 / topics
    blocks = stage(text_blocks(corpus, words, block_words), "blocks")
    if min_documents < 1:
        min_documents = min_documents * corpus.count()
    parts = min(1 << _SLOT_BITS, max(_LEAST_PARTS, math.ceil((blocks.agg(F.sum(F.size("words"))).first()[0] or 0) / PART_WORDS)))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (block, slots) in enumerate(zip(batch.column("block").to_pylist(), batch.column("slots").to_pylist())):
                part, starts = np.unique(np.frombuffer(slots, dtype=np.uint16).astype(np.int64) * parts >> _SLOT_BITS, return_index=True)
                offsets = pa.array(np.append(starts, len(slots) // 2).astype(np.int32))
                lists = [pa.ListArray.from_arrays(offsets, batch.column(c).slice(i, 1).flatten()) for c in ("words", "documents")]
                yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(np.full(len(part), block)), *lists], names=["part", "block", "words", "documents"])

    def begin(dealt: pa.Table) -> pa.Table:
        dealt = dealt.sort_by("block")
        coded = dealt["words"].combine_chunks().flatten().dictionary_encode()
        index, documents = coded.indices.to_numpy(), dealt["documents"].combine_chunks().flatten().to_numpy()
        kept = np.flatnonzero(np.bincount(index, weights=documents, minlength=len(coded.dictionary)) >= min_documents)
        place = np.full(len(coded.dictionary), -1, dtype=np.int32)
        place[kept] = np.arange(len(kept))
        known = coded.dictionary.take(pa.array(kept))
        lam = draws(known.to_pylist(), k, seed)
        return pa.table({"part": dealt["part"][:1].cast(pa.int32()), "words": pa.array([known.to_pylist()], type=pa.list_(pa.string())), "number": pa.array([len(kept)], type=pa.int64()),
                         **state_row(lam, dealt["block"].to_pylist(), dealt["words"].combine_chunks().value_lengths().to_pylist(), place[index])})

    def state_row(lam: np.ndarray, of: list[int], sizes: list[int], index: np.ndarray) -> dict[str, pa.Array]:
        """Weights (words x topics) and their sums; for each block that holds words of the part how many, and which they are, -1 for words without weights."""
        return {"lam": pa.array([lam.tobytes()], type=pa.binary()), "sums": pa.array([lam.sum(axis=0).tolist()], type=pa.list_(pa.float64())), "blocks": pa.array([of], type=pa.list_(pa.int64())),
                "sizes": pa.array([sizes], type=pa.list_(pa.int32())), "index": pa.array([index.astype(np.int32).tobytes()], type=pa.binary())}

    row = "lam binary, sums array<double>, blocks array<long>, sizes array<int>, index binary"
    dealt = blocks.select("block", "words", "slots", "documents").mapInArrow(deal, "part int, block long, words array<string>, documents array<int>")
    first = stage(dealt.groupBy("part").applyInArrow(begin, f"part int, words array<string>, number long, {row}"), "words")
    texts = blocks.select("block", "index", "counts", "ends")
    state, alpha = first.drop("words", "number"), np.full(k, 1.0 / k)
    learned = bool(first.agg(F.sum("number")).first()[0])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The exponentials of the words' expected logarithms, but for the common term of a topic, for each block."""
        for batch in batches:
            for part, lam, of, sizes, index in zip(*(batch.column(c).to_pylist() for c in ("part", "lam", "blocks", "sizes", "index"))):
                if part < 0:
                    continue
                beta = np.exp(digamma(np.frombuffer(lam).reshape(-1, k))).astype(np.float32)
                beta = np.append(beta, np.full((1, k), np.nan, dtype=np.float32), axis=0)[np.frombuffer(index, dtype=np.int32)]
                ends = np.cumsum(sizes)
                yield pa.RecordBatch.from_arrays([pa.array(of, type=pa.int64()), pa.array([part] * len(of), type=pa.int32()),
                                                  pa.array([beta[end - n:end].tobytes() for n, end in zip(sizes, ends)], type=pa.binary())], names=["block", "part", "beta"])

    lines = pa.schema([("part", pa.int32()), ("block", pa.int64()), ("stat", pa.binary())])
    for step in range(1, passes + 1 if learned else 1):
        total = state.where("part >= 0").agg(*[F.sum(F.col("sums")[t]) for t in range(k)]).first()
        old, common, prior, rate = state, np.exp(-digamma(np.array(total, dtype=float))), alpha, (OFFSET + step) ** -DECAY

        def update(block: pa.Table, sent: pa.Table) -> pa.Table:
            if not block.num_rows or not sent.num_rows:
                return lines.empty_table()
            sent = sent.sort_by("part")
            given = [np.frombuffer(x, dtype=np.float32) for x in sent["beta"].to_pylist()]
            beta = np.concatenate(given).reshape(-1, k)
            index, counts, ends = (np.frombuffer(block[c][0].as_py(), dtype=d) for c, d in (("index", np.int32), ("counts", np.int32), ("ends", np.int64)))
            known = ~np.isnan(beta[index, 0])  # words below the least number of texts have no weights
            sizes = np.add.reduceat(known.astype(np.int64), np.concatenate([[0], ends[:-1]]))
            number, of = int(block["block"][0].as_py()), np.nan_to_num(beta).astype(np.float64) * common
            gamma, added = settle(np.ascontiguousarray(of.T), index[known], counts[known], np.cumsum(sizes[sizes > 0]), prior, number + step + seed)
            spread = (digamma(gamma) - digamma(gamma.sum(axis=1))[:, None]).sum(axis=0)
            stat, cuts = added.T.astype(np.float32), np.cumsum([0] + [len(x) // k for x in given])
            # beside the words' numbers the texts' mean logarithms, and their number
            return pa.table({"part": sent["part"].to_pylist() + [-1], "block": [number] * (len(given) + 1),
                             "stat": [stat[a:b].tobytes() for a, b in zip(cuts, cuts[1:])] + [np.append(spread, len(gamma)).tobytes()]}, schema=lines)

        def learn(own: pa.Table, sent: pa.Table) -> pa.Table:
            if not own.num_rows:
                spread = np.sum([np.frombuffer(x) for x in sent["stat"].to_pylist()], axis=0)
                return pa.table({"part": pa.array([-1], type=pa.int32()), **state_row(np.zeros((0, k)), [], [], np.zeros(0)), "sums": pa.array([spread.tolist()], type=pa.list_(pa.float64()))})
            lam, index = np.frombuffer(own["lam"][0].as_py()).reshape(-1, k), np.frombuffer(own["index"][0].as_py(), dtype=np.int32)
            of, sizes = own["blocks"][0].as_py(), own["sizes"][0].as_py()
            found = dict(zip(sent["block"].to_pylist(), sent["stat"].to_pylist()))
            stat = np.concatenate([np.frombuffer(found[b], dtype=np.float32).reshape(-1, k) if b in found else np.zeros((n, k), dtype=np.float32) for b, n in zip(of, sizes)])
            known = index >= 0
            added = np.stack([np.bincount(index[known], weights=stat[known, t], minlength=len(lam)) for t in range(k)], axis=1)
            return pa.table({"part": own["part"].cast(pa.int32()), **state_row(lam * (1 - rate) + (added + eta) * rate, of, sizes, index)})

        sent = old.select("part", "lam", "blocks", "sizes", "index").mapInArrow(send, "block long, part int, beta binary")
        back = texts.groupBy("block").cogroup(sent.groupBy("block")).applyInArrow(update, "part int, block long, stat binary")
        state = stage(old.where("part >= 0").groupBy("part").cogroup(back.groupBy("part")).applyInArrow(learn, f"part int, {row}"), "state")
        spread = state.where("part < 0").select("sums").first()
        if step > 1:
            unstage(old)
        if spread is not None:
            spread = np.array(spread[0])
            alpha = next_prior(alpha, spread[:k] / spread[k], spread[k], rate)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (part, lam) in enumerate(zip(batch.column("part").to_pylist(), batch.column("lam").to_pylist())):
                known, values = batch.column("words").slice(i, 1).flatten(), pa.array(np.frombuffer(lam))
                yield pa.RecordBatch.from_arrays([pa.array((part << 32) + np.arange(len(known))), known, pa.ListArray.from_arrays(pa.array(np.arange(0, len(values) + 1, k, dtype=np.int32)), values)],
                                                 names=["term", "word", "lam"])

    table = first.select("part", "words").join(state.select("part", "lam"), "part").mapInArrow(listed, "term long, word string, lam array<double>")
    table = stage(table, "words")
    for done in (blocks, first, *([state] if learned and passes else [])):
        unstage(done)
    return TopicModel(table, alpha)


def next_prior(alpha: np.ndarray, spread: np.ndarray, number: float, rate: float) -> np.ndarray:
    """One Newton step for the prior of the topics, as long as it stays positive."""
    gradient = number * (digamma(alpha.sum()) - digamma(alpha) + spread)
    c, q = number * trigamma(alpha.sum()), -number * trigamma(alpha)
    b = (gradient / q).sum() / (1 / c + (1 / q).sum())
    new = alpha - rate * (gradient - b) / q
    return new if (new > 0).all() else alpha

"""Large tables of phrases or keywords against texts: one walk per text, however many patterns there are.

The patterns become an automaton (a trie whose nodes know where to go on when the next character does not fit), so the
cost of a text follows its length and its hits, not the number or the length of the patterns; overlapping and nested
ones are all found. A table of keywords larger than one block is sent as sorted hashes and packed text, some thirty bytes per keyword instead of an automaton's
hundreds: places of the texts pass two bitmaps of bounded size, and those that pass are looked up and compared. A table of phrases larger than one block
is joined instead: stretches of words as long as some phrase pass a bitmap of bounded size made from the table, and those that pass meet the table's hashes, packed to
a few bytes each; a second pass over the texts and the table then joins, by their text, only what has a hash of both.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions import text as tx
from tideline.staging import stage, unstage
from tideline.worker import kept

# Patterns of a block, and what the walk needs besides per pattern.
BLOCK_BYTES = 16_000_000
_PER_PATTERN = 64
_FOUND_ROWS = 65_536
# Words looked at together, places of phrases sent together, and hashes sorted together.
_RUN, _FOUND_PLACES, _HELD = 1 << 17, 1_000_000, 1 << 22
# A worker process serves many tasks and keeps so many automata.
_KEPT = 2
# The base of the hashes of stretches and its inverse modulo 2 ** 64; the largest bitmap of phrases has 64 MB, that of keywords 32 MB.
_BASE, _INVERSE = 0x5851F42D4C957F2D, pow(0x5851F42D4C957F2D, -1, 1 << 64)
_MOST_BITS, _KEYWORD_BITS = 29, 28
# Characters that are looked through at a time, and the mark between texts, which no text holds.
_PIECE = 1 << 18
_GAP = 0x110000
# Added to the length in hashes of leads.
_OF_LEAD = 1 << 40


def grouped_patterns(patterns: DataFrame, block_bytes: int) -> tuple[DataFrame, int]:
    """A table (pattern, label) as a stored table (pattern, labels), and the number of blocks it fills; NULL and empty patterns match nothing and are left out."""
    grouped = stage(patterns.where("pattern IS NOT NULL AND pattern <> ''").groupBy("pattern").agg(F.sort_array(F.collect_set(F.struct("label"))).alias("labels")), "patterns")
    size = F.octet_length("pattern") + F.aggregate("labels", F.lit(_PER_PATTERN), lambda a, x: a + F.coalesce(F.octet_length(x["label"]), F.lit(0)))
    total = grouped.agg(F.sum(size.cast("long"))).first()[0] or 0
    return grouped, max(1, math.ceil(total / block_bytes)) if total else 0


def pattern_blocks(grouped: DataFrame, number: int) -> list:
    """Broadcast blocks of a table of ``grouped_patterns``: lists of (pattern, its labels). The patterns of a block are on the driver together."""
    spark = grouped.sparkSession
    blocks = []
    for i in range(number):
        rows = grouped.where(F.pmod(F.xxhash64("pattern"), F.lit(number)) == i).toArrow().to_pydict()
        labels = [tuple(x["label"] for x in found) for found in rows["labels"]]
        blocks.append(spark.sparkContext.broadcast((uuid.uuid4().hex, list(zip(rows["pattern"], labels)))))
    unstage(grouped)
    return blocks


def automaton_of(block):
    """The automaton of a broadcast block, built once per worker process; its values are (pattern, labels)."""
    name, patterns = block.value
    built = kept().setdefault("automata", {})
    if name not in built:
        import ahocorasick

        made = ahocorasick.Automaton()
        for pattern, labels in patterns:
            made.add_word(pattern, (pattern, labels))
        made.make_automaton()
        built[name] = made
        while len(built) > _KEPT:
            built.pop(next(iter(built)))
    return built[name]


def word_line(text: Column | str) -> Column:
    """The words of a text with one space before, between and behind them, so that a phrase in spaces meets whole words only."""
    return F.concat(F.lit(" "), F.array_join(tx.words(text), " "), F.lit(" "))


def match_phrases(df: DataFrame, key: str, text: str, phrases: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(key, position, phrase, label) for every place of every phrase of a table (phrase: lower-case words with single spaces, label).

    Positions count words from 1. NULL texts hold no phrase. Overlapping phrases, phrases within others and several labels of a phrase all count.
    """
    spaced = phrases.select(F.concat(F.lit(" "), "phrase", F.lit(" ")).alias("pattern"), "label")
    schema = T.StructType([T.StructField("_key", df.schema[key].dataType), T.StructField("position", T.IntegerType()),
                           T.StructField("phrase", T.StringType()), T.StructField("label", T.StringType())])
    lines = df.select(F.col(key).alias("_key"), word_line(text).alias("_line")).where(F.length("_line") > 2)

    def walker(block):
        def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            automaton = automaton_of(block)
            keys, rows, positions, found, labels = None, [], [], [], []

            def close() -> pa.RecordBatch:
                out = pa.RecordBatch.from_arrays([keys.take(pa.array(rows, type=pa.int64())), pa.array(positions, type=pa.int32()), pa.array(found, type=pa.string()),
                                                  pa.array(labels, type=pa.string())], names=["_key", "position", "phrase", "label"])
                for x in (rows, positions, found, labels):
                    x.clear()
                return out

            for batch in batches:
                keys = batch.column("_key")
                for row, line in enumerate(batch.column("_line").to_pylist()):
                    hits = list(automaton.iter(line))
                    if not hits:
                        continue
                    spaces = np.flatnonzero(np.frombuffer(line.encode("utf-32-le"), dtype=np.uint32) == 32)
                    starts = [end - len(pattern) + 1 for end, (pattern, _) in hits]
                    for at, (_, (pattern, named)) in zip((np.searchsorted(spaces, starts) + 1).tolist(), hits):
                        for label in named:
                            rows.append(row)
                            positions.append(at)
                            found.append(pattern[1:-1])
                            labels.append(label)
                    if len(rows) >= _FOUND_ROWS:
                        yield close()
                if rows:
                    yield close()

        return walk

    # repeats are taken out where the table is small, or has been made small
    stored = stage(spaced.where("pattern IS NOT NULL AND pattern <> '  '"), "patterns", compression="zstd")
    size = F.octet_length("pattern") + F.coalesce(F.octet_length("label"), F.lit(0)) + F.lit(_PER_PATTERN)
    if (stored.agg(F.sum(size.cast("long"))).first()[0] or 0) > block_bytes:
        return joined_phrases(lines, stored, schema).withColumnRenamed("_key", key)
    grouped, number = grouped_patterns(stored, block_bytes)
    unstage(stored)
    blocks = pattern_blocks(grouped, number)
    if not blocks:
        return df.sparkSession.createDataFrame([], schema).withColumnRenamed("_key", key)
    return lines.mapInArrow(walker(blocks[0]), schema).select(F.col("_key").alias(key), "position", "phrase", "label")


def _dealt(chunks: Iterator[np.ndarray], parts: int, wide: int) -> Iterator[pa.RecordBatch]:
    """Numbers of ``wide`` bits as rows (part, number, hashes): those that begin with the same ``parts`` bits together, each once, in ascending order and packed."""

    def deal(values: np.ndarray) -> pa.RecordBatch:
        part, starts = np.unique(values >> np.uint64(wide - parts), return_index=True)
        ends = np.append(starts[1:], len(values))
        return pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(ends - starts), pa.array([_packed(values[a:b]) for a, b in zip(starts, ends)], type=pa.binary())],
                                          names=["part", "number", "hashes"])

    held, size = [], 0
    for values in chunks:
        held.append(values)
        size += len(values)
        if size >= _HELD:
            held = [np.unique(np.concatenate(held))]
            size = len(held[0])
            if size >= _HELD // 2:
                yield deal(held[0])
                held, size = [], 0
    if size:
        yield deal(np.unique(np.concatenate(held)))


def _packed(values: np.ndarray) -> bytes:
    """Ascending numbers as the differences of neighbours, byte by byte, under zstandard."""
    planes = np.diff(values, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T
    return pa.compress(np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True)


def _unpacked(number: int, packed: bytes) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(packed, number * 8, codec="zstd", asbytes=True), dtype=np.uint8).reshape(8, -1).T
    return np.cumsum(np.ascontiguousarray(planes).view(np.uint64).ravel(), dtype=np.uint64)


def _lists(table: pa.Table | pa.RecordBatch) -> Iterator[np.ndarray]:
    """The numbers of each row of ``_dealt``."""
    for number, packed in zip(table.column("number").to_pylist(), table.column("hashes").to_pylist()):
        yield _unpacked(number, packed)


@dataclass
class Marks:
    """A bitmap of ``2 ** bits`` bits, two per number of ``wide`` bits; both lie where the number's first ``parts`` bits say, so that parts are made side by side."""

    data: np.ndarray
    bits: int
    parts: int
    wide: int

    def places(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low = np.uint64(self.bits - self.parts)
        second = (values >> np.uint64(self.wide - self.parts) << low) | (values * np.uint64(0x9E3779B97F4A7C15) >> (np.uint64(64) - low))
        return (values >> np.uint64(self.wide - self.bits)).astype(np.int64), second.astype(np.int64)

    def _set(self, at: np.ndarray) -> np.ndarray:
        return ((self.data[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).astype(bool)

    def found(self, values: np.ndarray, allowed: np.ndarray | None = None) -> np.ndarray:
        """Indexes of the ``allowed`` numbers that may be among those marked; all marked ones are."""
        hits = np.flatnonzero(self._set((values >> np.uint64(self.wide - self.bits)).astype(np.int64)))
        hits = hits if allowed is None else hits[allowed[hits]]
        return hits[self._set(self.places(values[hits])[1])]

    @staticmethod
    def of(listed: DataFrame, bits: int, parts: int, wide: int) -> Marks:
        """The bitmap of stored lists, one per part, put together on the driver."""
        low = bits - parts

        def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part, values in zip(batch.column("part").to_pylist(), _lists(batch)):
                    marks = np.zeros(1 << low, dtype=bool)
                    for at in Marks(marks, bits, parts, wide).places(values):
                        marks[at & ((1 << low) - 1)] = True
                    yield pa.RecordBatch.from_arrays([pa.array([part], type=pa.int32()), pa.array([np.packbits(marks).tobytes()], type=pa.binary())], names=["part", "marks"])

        out = np.zeros((1 << parts, (1 << low) // 8), dtype=np.uint8)
        for row in listed.mapInArrow(put, "part int, marks binary").toLocalIterator():
            out[row["part"]] = np.frombuffer(row["marks"], dtype=np.uint8)
        return Marks(out.ravel(), bits, parts, wide)


def stretches(words: pa.Array, lengths: list[int], marks: Marks) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(n, places, numbers) of those ``n`` neighbouring words of a text, for each of the ``lengths``, that ``marks`` may hold. ``words``: hashes of the words of each text; places count the words of all."""
    flat, offsets = words.flatten().to_numpy(zero_copy_only=False).view(np.uint64), words.offsets.to_numpy() - words.offsets[0].as_py()
    room = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(len(flat))
    most = min(len(flat), _RUN + lengths[-1])
    powers, back = (np.cumprod(np.full(most, x, dtype=np.uint64), dtype=np.uint64) for x in (_BASE, _INVERSE))
    for low in range(0, len(flat), _RUN):
        own = flat[low:low + most]
        sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(own * powers[:len(own)], dtype=np.uint64)])
        for n in lengths:
            number = min(_RUN, len(own) - n + 1)
            if number <= 0:
                break
            values = _finished((sums[n:n + number] - sums[:number]) * back[:number], n) >> np.uint64(64 - marks.wide)
            at = marks.found(values, room[low:low + number] >= n)
            if len(at):
                yield n, low + at, values[at]


def _numbers(words: pa.Array, wide: int) -> tuple[np.ndarray, np.ndarray]:
    """The number of ``wide`` bits of each phrase, given by its words' hashes, and how many words it has."""
    flat, starts = words.flatten().to_numpy(zero_copy_only=False).view(np.uint64), words.offsets.to_numpy()[:-1] - words.offsets[0].as_py()
    sizes = words.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros(len(sizes), dtype=np.uint64)
    for n in np.unique(sizes).tolist():
        own, power, total = starts[sizes == n], 1, np.uint64(0)
        for j in range(n):
            power = power * _BASE % (1 << 64)
            total = total + flat[own + j] * np.uint64(power)
        # sums of a text begin with the first power of the base, and are brought back by one more than the place
        out[sizes == n] = _finished(total * np.uint64(_INVERSE), n) >> np.uint64(64 - wide)
    return out, sizes


def joined_phrases(lines: DataFrame, patterns: DataFrame, schema: T.StructType) -> DataFrame:
    """``match_phrases`` for a table of any size (stored, repeats included): two passes over the texts and one join, whatever the number of phrases; the work per word follows the number of different lengths.

    Phrases and stretches of words first meet as short hashes, sorted and packed, a few bytes each; a bitmap of the phrases keeps most stretches at home. Only phrases
    whose hash some text has, and the stretches that have it, then meet by their text.
    """
    spark = lines.sparkSession
    phrases = patterns.select(F.expr("substring(pattern, 2, length(pattern) - 2)").alias("phrase"), "label")
    phrases = phrases.withColumn("_words", F.transform(F.split("phrase", " "), lambda w: F.xxhash64(w)))
    size = max(1, patterns.count()).bit_length()
    parts, wide = min(12, max(0, size - 17)), max(size + 12, _MOST_BITS + 1)
    kinds = "part int, number long, hashes binary"

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()

        def chunks() -> Iterator[np.ndarray]:
            for batch in batches:
                numbers, sizes = _numbers(batch.column(0), wide)
                seen.update(np.unique(sizes).tolist())
                yield numbers

        for batch in _dealt(chunks(), parts, wide):
            yield batch.append_column("sizes", pa.array([sorted(seen)] * batch.num_rows, type=pa.list_(pa.int32())))

    def merge(lists: pa.Table) -> pa.Table:
        values = np.unique(np.concatenate(list(_lists(lists))))
        sizes = sorted(set(lists.column("sizes").combine_chunks().flatten().to_pylist()))
        return pa.table({"part": lists["part"][:1].cast(pa.int32()), "number": [len(values)], "hashes": [_packed(values)], "sizes": pa.array([sizes], type=pa.list_(pa.int32()))})

    listed = stage(phrases.select("_words").mapInArrow(place, f"{kinds}, sizes array<int>").groupBy("part").applyInArrow(merge, f"{kinds}, sizes array<int>"), "hashes")
    lengths = sorted(r[0] for r in listed.select(F.explode("sizes")).distinct().collect())

    def marks_of(lists: DataFrame, each: int) -> Marks | None:
        """So many bits for each number; a larger table than the largest bitmap is made for lets more stretches through."""
        number = lists.agg(F.sum("number")).first()[0]
        return number and Marks.of(lists, max(parts + 10, min(_MOST_BITS, math.ceil(math.log2(each * number)))), parts, wide)

    every = spark.sparkContext.broadcast(astuple(marks_of(listed, 16)))

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = Marks(*every.value)
        return _dealt((numbers for batch in batches for _, _, numbers in stretches(batch.column(0), lengths, marks)), parts, wide)

    def meet(lists: pa.Table, known: pa.Table) -> pa.Table:
        out = pa.schema([("part", pa.int32()), ("number", pa.int64()), ("hashes", pa.binary())])
        if not lists.num_rows or not known.num_rows:
            return out.empty_table()
        values = next(_lists(known))
        seen = np.zeros(len(values), dtype=bool)
        for numbers in _lists(lists):
            at = np.minimum(np.searchsorted(values, numbers), len(values) - 1)
            seen[at[values[at] == numbers]] = True
        values = values[seen]
        if not len(values):
            return out.empty_table()
        return pa.table({"part": known["part"].cast(pa.int32()), "number": [len(values)], "hashes": [_packed(values)]}, schema=out)

    hashed = lines.withColumn("_words", F.transform(F.split(F.expr("substring(_line, 2, length(_line) - 2)"), " "), lambda w: F.xxhash64(w)))
    sought = hashed.select("_words").mapInArrow(candidates, kinds)
    matched = stage(sought.groupBy("part").cogroup(listed.select("part", "number", "hashes").groupBy("part")).applyInArrow(meet, kinds), "matched")
    unstage(listed)
    every.unpersist()
    near = marks_of(matched, 32)
    unstage(matched)
    if not near:
        unstage(patterns)
        return spark.createDataFrame([], schema)
    shared = spark.sparkContext.broadcast(astuple(near))

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = Marks(*shared.value)
        for batch in batches:
            at = marks.found(_numbers(batch.column(2), wide)[0])
            if len(at):
                yield batch.select([0, 1]).take(pa.array(at))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = Marks(*shared.value)
        for batch in batches:
            keys, words, line = batch.column("_key"), batch.column("_words"), batch.column("_line").cast(pa.string())
            offsets = words.offsets.to_numpy() - words.offsets[0].as_py()
            at_byte = np.frombuffer(line.buffers()[1], dtype=np.int32)[line.offset:line.offset + len(line) + 1]
            text = np.frombuffer(line.buffers()[2], dtype=np.uint8)
            spaces = np.flatnonzero(text[at_byte[0]:at_byte[-1]] == 32) + at_byte[0]
            held, size = [], 0

            def close() -> pa.RecordBatch:
                """Each phrase found once, with its places."""
                n, at = np.concatenate([np.full(len(x), n) for n, x in held]), np.concatenate([x for _, x in held])
                row = np.searchsorted(offsets, at, "right") - 1
                # a text has one space more than words
                first, last = spaces[at + row] + 1, spaces[at + row + n]
                ends = np.cumsum(last - first)
                taken = text[np.arange(ends[-1]) + np.repeat(last - ends, last - first)]
                found = pa.Array.from_buffers(pa.string(), len(at), [None, pa.py_buffer(np.append(0, ends).astype(np.int32)), pa.py_buffer(taken)]).dictionary_encode()
                code = found.indices.to_numpy()
                order = np.argsort(code, kind="stable")
                sizes = pa.array(np.append(0, np.cumsum(np.bincount(code, minlength=len(found.dictionary)))).astype(np.int32))
                return pa.RecordBatch.from_arrays(
                    [found.dictionary, pa.ListArray.from_arrays(sizes, keys.take(pa.array(row[order]))), pa.ListArray.from_arrays(sizes, pa.array((at - offsets[row] + 1)[order].astype(np.int32)))],
                    names=["phrase", "keys", "positions"])

            for n, at, _ in stretches(words, lengths, marks):
                held.append((n, at))
                size += len(at)
                if size >= _FOUND_PLACES:
                    yield close()
                    held, size = [], 0
            if held:
                yield close()

    known = phrases.mapInArrow(likely, "phrase string, label string").groupBy("phrase").agg(F.sort_array(F.collect_set(F.struct("label"))).alias("labels"))
    known = stage(known, "phrases")
    unstage(patterns)
    places = hashed.mapInArrow(pick, T.StructType([T.StructField("phrase", T.StringType()), T.StructField("keys", T.ArrayType(schema["_key"].dataType)),
                                                   T.StructField("positions", T.ArrayType(T.IntegerType()))]))
    found = places.join(known, "phrase").select("phrase", "labels", F.explode(F.arrays_zip("keys", "positions")).alias("_at"))
    return found.select(F.col("_at.keys").alias("_key"), F.col("_at.positions").alias("position"), "phrase", F.explode("labels.label").alias("label"))


def contains_pattern(text: Column, keywords: DataFrame, keyword: str = "keyword", block_bytes: int = BLOCK_BYTES) -> Column:
    """Whether some keyword of a table occurs in the text as a substring, whatever the case. NULL text: NULL. An empty keyword is in every text."""
    if not keywords.where(F.col(keyword) == "").isEmpty():
        return F.when(text.isNotNull(), F.lit(True))
    grouped, number = grouped_patterns(keywords.select(F.lower(keyword).alias("pattern"), F.lit("").alias("label")), block_bytes)
    lowered = F.lower(text)
    found = F.when(text.isNotNull(), F.lit(False))
    if number > 1:
        return found | _looked_up(*keyword_blocks(grouped, number))(lowered)
    for block in pattern_blocks(grouped, number):
        found = found | _hits(block)(lowered)
    return found


def keyword_blocks(grouped: DataFrame, number: int) -> tuple[list, int]:
    """Broadcast blocks of a table of ``grouped_patterns`` without its labels, as the fields of a ``KeywordBlock``, and the bits of a bitmap for all. One block is on the driver at a time."""
    spark, total = grouped.sparkSession, grouped.count()
    blocks = []
    for i in range(number):
        patterns = grouped.where(F.pmod(F.xxhash64("pattern"), F.lit(number)) == i).select("pattern").toArrow().column(0).combine_chunks()
        blocks.append(spark.sparkContext.broadcast(astuple(KeywordBlock.of(patterns))))
    unstage(grouped)
    # two marks per keyword, sixteen bits each
    return blocks, min(_KEYWORD_BITS, max(10, math.ceil(math.log2(32 * max(1, total)))))


def _lead(n: np.ndarray) -> np.ndarray:
    """The largest power of two that is at most ``n``: so many first characters of a keyword are sought before the whole."""
    return np.left_shift(1, np.log2(n).astype(np.int64))


def _sums(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running sums of the polynomial hash modulo 2 ** 64 over code points, and the factors that bring a difference back to its place."""
    powers = np.cumprod(np.full(len(points), _BASE, dtype=np.uint64), dtype=np.uint64)
    back = np.cumprod(np.full(len(points), _INVERSE, dtype=np.uint64), dtype=np.uint64)
    return np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(points.astype(np.uint64) * powers, dtype=np.uint64)]), back


def _finished(sums: np.ndarray, n: np.ndarray | int) -> np.ndarray:
    own = sums + np.asarray(n, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    own = (own ^ (own >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return own ^ (own >> np.uint64(29))


@dataclass
class KeywordBlock:
    """Keywords by hash, in ascending order: hashes of the whole and of the lead, lengths in characters, and the text as UTF-8."""

    hashes: np.ndarray
    leads: np.ndarray
    lengths: np.ndarray
    offsets: np.ndarray
    data: bytes

    @staticmethod
    def of(patterns: pa.Array) -> KeywordBlock:
        strings = patterns.to_pylist()
        points = np.frombuffer("".join(strings).encode("utf-32-le"), dtype=np.uint32)
        lengths = np.array([len(x) for x in strings], dtype=np.int64)
        starts = np.cumsum(lengths) - lengths
        sums, back = _sums(points)
        hashes = _finished((sums[starts + lengths] - sums[starts]) * back[starts], lengths) if strings else np.zeros(0, dtype=np.uint64)
        leads = _finished((sums[starts + _lead(lengths)] - sums[starts]) * back[starts], _lead(lengths) + _OF_LEAD) if strings else hashes
        order = np.argsort(hashes, kind="stable")
        encoded = [strings[i].encode("utf-8") for i in order]
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in encoded])]).astype(np.int64)
        return KeywordBlock(hashes[order], np.unique(leads), np.unique(lengths), offsets, b"".join(encoded))

    def holds(self, hashed: np.uint64, text: bytes) -> bool:
        low, high = np.searchsorted(self.hashes, hashed, "left"), np.searchsorted(self.hashes, hashed, "right")
        return any(self.data[self.offsets[i]:self.offsets[i + 1]] == text for i in range(low, high))


class KeywordTable:
    """All blocks of a table, with one bitmap of the hashes of leads and wholes."""

    def __init__(self, blocks: list[KeywordBlock], bits: int):
        self.blocks, self.shift = blocks, np.uint64(64 - bits)
        self.marks = np.zeros(1 << (bits - 3), dtype=np.uint8)
        for block in blocks:
            for hashes in (block.hashes, block.leads):
                at = (hashes >> self.shift).astype(np.int64)
                np.bitwise_or.at(self.marks, at >> 3, np.left_shift(1, 7 - (at & 7)).astype(np.uint8))
        lengths = np.unique(np.concatenate([b.lengths for b in blocks]))
        self.classes = [(int(q), lengths[_lead(lengths) == q].tolist()) for q in np.unique(_lead(lengths))]
        self.longest = int(lengths.max())

    def marked(self, hashes: np.ndarray) -> np.ndarray:
        at = (hashes >> self.shift).astype(np.int64)
        return (self.marks[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)

    def places(self, points: np.ndarray) -> Iterator[tuple[int, int, np.uint64]]:
        """Start, length and hash of the stretches of ``points`` whose hash is that of some keyword."""
        sums, back = _sums(points)
        for q, lengths in self.classes:
            if q > len(points):
                break
            at = np.flatnonzero(self.marked(_finished((sums[q:] - sums[:-q]) * back[:len(points) - q + 1], q + _OF_LEAD)))
            for n in lengths:
                at = at[:np.searchsorted(at, len(points) - n, "right")]
                hashes = _finished((sums[at + n] - sums[at]) * back[at], n)
                likely = np.flatnonzero(self.marked(hashes))
                known = np.zeros(len(likely), dtype=bool)
                for block in self.blocks:
                    if len(block.hashes):
                        near = np.minimum(np.searchsorted(block.hashes, hashes[likely]), len(block.hashes) - 1)
                        known |= block.hashes[near] == hashes[likely]
                for i in likely[known].tolist():
                    yield int(at[i]), n, hashes[i]

    def found(self, texts: list[str | None]) -> list[bool | None]:
        """Whether some keyword is in each text."""
        out = [None if t is None else False for t in texts]
        row = 0
        while row < len(texts):
            own, size = [], 0
            while row < len(texts) and (not own or size < _PIECE):
                if texts[row]:
                    own.append(row)
                    size += len(texts[row]) + 1
                row += 1
            if not own:
                continue
            starts = np.cumsum([0] + [len(texts[i]) + 1 for i in own])
            points = np.full(starts[-1], _GAP, dtype=np.uint32)
            for i, at in zip(own, starts.tolist()):
                points[at:at + len(texts[i])] = np.frombuffer(texts[i].encode("utf-32-le"), dtype=np.uint32)
            for low in range(0, len(points), _PIECE):
                for at, n, hashed in self.places(points[low:low + _PIECE + self.longest - 1]):
                    k = int(np.searchsorted(starts, low + at, "right")) - 1
                    if not out[own[k]]:
                        begin = low + at - int(starts[k])
                        stretch = texts[own[k]][begin:begin + n].encode("utf-8")
                        out[own[k]] = any(block.holds(hashed, stretch) for block in self.blocks)
        return out


def _looked_up(blocks: list, bits: int):
    name = uuid.uuid4().hex

    def hit(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        built = kept().setdefault("keywords", {})
        if name not in built:
            built.clear()
            built[name] = KeywordTable([KeywordBlock(*block.value) for block in blocks], bits)
        for some in texts:
            yield pd.Series(built[name].found([None if t is None else t for t in some]), dtype=object)

    hit.__annotations__ = {"texts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(hit, "boolean")


def _hits(block):
    def hit(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton = automaton_of(block)
        for some in texts:
            yield pd.Series([None if t is None else next(automaton.iter(t), None) is not None for t in some], dtype=object)

    # annotations of this module are strings, and the kind of function is read from its types
    hit.__annotations__ = {"texts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(hit, "boolean")

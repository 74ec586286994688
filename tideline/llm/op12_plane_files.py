"""Token ids in binary files of bit or byte planes.

Ids of all documents, in ascending order of their ids, are one long sequence that is cut into files (at document borders) and, within a
file, into blocks of ``BLOCK_IDS`` ids. A block is transposed: plane k holds byte (or bit) k of every id. High planes are
nearly constant and compress to almost nothing; each plane is compressed by itself with zstandard, and one of zeros only is
left out. A chunk index in the file holds the place, the plane lengths and the checksum of every block, so that any stretch of ids is read by
decoding the blocks that overlap it; an index of documents holds their ids and lengths. The folder has a table ``index``
with the first document, the number of ids and the place in the whole sequence of every file.

File, all numbers little-endian: ``MAGIC``; the compressed planes of all blocks; the footer's body, compressed: block records
(offset u64, crc32 of the raw ids u32, a length u32 per plane), document records (id i64, present u8, number of ids u64);
the tail: offset of the body u64, its length u64, its crc32 u32, ids per block u32, planes u32, blocks u64, documents u64,
ids u64, ``MAGIC``.

Documents are range-partitioned and sorted by (id, text hash, input row), so one hot id is split too; each task
encodes its part and writes its files under names that depend only on the partition, by renaming a finished
temporary file. A task that runs again after a loss writes the same bytes under the same names. Files go through ``pyarrow.fs``
to the shared folder and come back by Spark's ``binaryFile`` reader.

Encoding is the library's. Where a tokenizer splits bytes at spaces before it merges (byte-level, without a normaliser),
a text is cut at single spaces between visible characters, and each distinct stretch is encoded once per worker process.

A NULL text counts as the empty one, which has the end id only. Rows with equal ids are documents of their own, in the order of their text
hashes; NULL ids come first. An empty table gives no files and an empty result. Further columns have no influence.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tideline.llm.common import batches_of, shared_folder
from tideline.llm.registry import llm_query, table
from tideline.worker import kept

END_ID = 0
BLOCK_IDS = 65_536
# A file ends with the document that brings it to this many ids.
FILE_IDS = 2_000_000
PLANES = {"byte": 4, "bit": 32}
MAGIC = b"IDPLANE1"
_TAIL = "<QQIIIQQQ8s"
_REMEMBERED = 800_000
_TOGETHER = 50
_SPACE = "Ġ"  # how byte-level pieces spell a space
# Visible characters that every version of Unicode counts as such: none of them is, or ever was, white space.
_VISIBLE = "[!-~¡-ᙿ、-퟿]"


class Encoder:
    """Texts to the bytes of their ids (little-endian, 32 bits each)."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has one task per core already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        made = json.loads(self.tokenizer.to_str())
        splitter = made.get("pre_tokenizer") or {}
        self.splits = (splitter.get("type") == "ByteLevel" and splitter.get("use_regex", True) and not splitter.get("add_prefix_space")
                       and made.get("normalizer") is None and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or " " in t["content"] for t in made["added_tokens"]))
        vocabulary = self.tokenizer.get_vocab()
        self.opens = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=bool)  # ids of pieces that begin with a space
        self.opens[[i for piece, i in vocabulary.items() if piece.startswith(_SPACE)]] = True
        self.clean = re.compile(f"{_VISIBLE}(?:[^ ]*{_VISIBLE})?", re.DOTALL).fullmatch
        self.cut = re.compile(f"(?<={_VISIBLE}) (?={_VISIBLE})").split
        self.known: dict[str, bytes] = {}  # a stretch to its ids behind a space

    @classmethod
    def of(cls, path: str) -> Encoder:
        """The encoder of this worker process, with what it has learned in earlier tasks."""
        found = kept().setdefault("encoders", {})
        if path not in found:
            found[path] = cls(path)
        return found[path]

    def _plain(self, texts: list[str]) -> list[bytes]:
        return [np.asarray(e.ids, dtype="<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, stretches: list[str]) -> None:
        """Encode stretches that stand between single spaces, many at a time, told apart by their spaces."""
        groups = [stretches[i:i + _TOGETHER] for i in range(0, len(stretches), _TOGETHER)]
        for i in range(0, len(groups), 32):
            some = groups[i:i + 32]
            for group, raw in zip(some, self._plain([" " + " ".join(g) for g in some])):
                starts = np.flatnonzero(self.opens[np.frombuffer(raw, dtype="<u4")]) * 4
                if len(starts) != len(group):  # a piece begins with a space that no stretch begins with: one by one
                    self.known.update(zip(group, self._plain([" " + s for s in group])))
                    continue
                at = [*starts.tolist(), len(raw)]
                self.known.update(zip(group, [raw[a:b] for a, b in zip(at, at[1:])]))

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        texts = pa.array(texts, type=pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string())
        if not self.splits or not len(texts):
            return self._plain(texts.to_pylist())
        if len(self.known) > _REMEMBERED:  # the first to come are the most frequent ones
            self.known = dict(islice(self.known.items(), _REMEMBERED * 5 // 8))
        parts = pc.split_pattern(texts, " ")
        bounds = parts.offsets.to_numpy().astype(np.int64)
        flat, first = parts.values, bounds[:-1]
        heads = flat.take(pa.array(first)).to_pylist()
        behind = np.ones(bounds[-1], dtype=bool)
        behind[first] = False
        coded = flat.filter(pa.array(behind)).dictionary_encode()
        codes, bounds = coded.indices.to_numpy(), bounds - np.arange(len(bounds))
        stretches = coded.dictionary.to_pylist()
        found = list(map(self.known.get, stretches))
        missing = [i for i, v in enumerate(found) if v is None]
        odd = [i for i in missing if not self.clean(stretches[i])]
        apart = {i for i, head in enumerate(heads) if bounds[i] < bounds[i + 1] and not self.clean(head)}
        if odd:  # some space is not a place to cut
            places = np.flatnonzero(np.isin(codes, odd))
            apart.update((np.searchsorted(bounds, places, "right") - 1).tolist())
        cut = {i: self.cut(texts[i].as_py()) for i in apart}
        for i, own in cut.items():
            heads[i] = own[0]
        odd = set(odd)
        new = {stretches[i] for i in missing if i not in odd}
        new.update(s for own in cut.values() for s in own[1:] if s not in self.known)
        self._learn(list(new))
        for i in missing:
            found[i] = b"" if i in odd else self.known[stretches[i]]
        ids = pa.array(found, type=pa.large_binary()).take(pa.array(codes))
        ends = np.frombuffer(ids.buffers()[1], dtype=np.int64)[ids.offset + bounds] if len(ids) else bounds
        data = memoryview(ids.buffers()[2]) if len(ids) and ids.buffers()[2] is not None else memoryview(b"")
        return [head + (b"".join(map(self.known.__getitem__, cut[i][1:])) if i in cut else data[ends[i]:ends[i + 1]].tobytes()) for i, head in enumerate(self._plain(heads))]


# ---------------------------------------------------------------- one file

def to_planes(ids: np.ndarray, kind: str) -> list[bytes]:
    """The planes of a block, lowest first; those of zeros only are empty."""
    if kind == "byte":
        planes = ids.astype("<u4").view(np.uint8).reshape(-1, 4).T
    else:
        planes = np.packbits(np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little").T, axis=1, bitorder="little")
    return [p.tobytes() if p.any() else b"" for p in planes]


def from_planes(planes: list[bytes], number: int) -> np.ndarray:
    """The ids of a block of ``number``."""
    if len(planes) == PLANES["byte"]:
        rows = np.zeros((4, number), dtype=np.uint8)
        for row, plane in zip(rows, planes):
            if plane:
                row[:] = np.frombuffer(plane, dtype=np.uint8)
        return np.ascontiguousarray(rows.T).view("<u4").ravel()
    rows = np.zeros((32, -(-number // 8)), dtype=np.uint8)
    for row, plane in zip(rows, planes):
        if plane:
            row[:] = np.frombuffer(plane, dtype=np.uint8)
    bits = np.unpackbits(rows, axis=1, count=number, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u4").ravel()


def pack_file(ids: np.ndarray, doc_ids: list[int | None], lengths: list[int], kind: str = "byte", block_ids: int = BLOCK_IDS, level: int = 3) -> bytes:
    """The bytes of a file of documents with ``lengths`` ids each, whose ids stand one after the other in ``ids``."""
    squeeze = zstandard.ZstdCompressor(level=level).compress
    planes = PLANES[kind]
    parts, records, at = [MAGIC], [], len(MAGIC)
    for i in range(0, len(ids), block_ids):
        block = ids[i:i + block_ids]
        packed = [squeeze(p) if p else b"" for p in to_planes(block, kind)]
        records.append(struct.pack(f"<QI{planes}I", at, zlib.crc32(block.tobytes()), *map(len, packed)))
        parts += packed
        at += sum(map(len, packed))
    documents = [np.array([d or 0 for d in doc_ids], dtype="<i8").tobytes(), np.array([d is not None for d in doc_ids], dtype=np.uint8).tobytes(),
                 np.array(lengths, dtype="<u8").tobytes()]
    body = squeeze(b"".join(records + documents))
    tail = struct.pack(_TAIL, at, len(body), zlib.crc32(body), block_ids, planes, len(records), len(doc_ids), len(ids), MAGIC)
    return b"".join([*parts, body, tail])


@dataclass(frozen=True)
class PlaneFile:
    """A file's content and what its footer says."""

    content: memoryview
    block_ids: int
    n_ids: int
    blocks: np.ndarray  # of (offset, crc, plane lengths)
    doc_ids: list[int | None]
    lengths: np.ndarray

    @classmethod
    def open(cls, content: bytes) -> PlaneFile:
        at, size, crc, block_ids, planes, n_blocks, n_docs, n_ids, end = struct.unpack(_TAIL, content[-struct.calcsize(_TAIL):])
        body = content[at:at + size]
        if content[:len(MAGIC)] != MAGIC or end != MAGIC or zlib.crc32(body) != crc:
            raise ValueError("not a whole file of id planes")
        body = zstandard.ZstdDecompressor().decompress(body)
        record = np.dtype([("offset", "<u8"), ("crc", "<u4"), ("sizes", "<u4", (planes,))])
        blocks = np.frombuffer(body, dtype=record, count=n_blocks)
        at = record.itemsize * n_blocks
        ids = np.frombuffer(body, dtype="<i8", count=n_docs, offset=at).tolist()
        present = np.frombuffer(body, dtype=np.uint8, count=n_docs, offset=at + 8 * n_docs)
        lengths = np.frombuffer(body, dtype="<u8", count=n_docs, offset=at + 9 * n_docs).astype(np.int64)
        return cls(memoryview(content), block_ids, n_ids, blocks, [d if p else None for d, p in zip(ids, present)], lengths)

    def block(self, number: int) -> np.ndarray:
        offset, crc, sizes = self.blocks[number]
        planes, at = [], int(offset)
        for size in sizes.tolist():
            planes.append(zstandard.ZstdDecompressor().decompress(self.content[at:at + size]) if size else b"")
            at += size
        ids = from_planes(planes, min(self.block_ids, self.n_ids - number * self.block_ids))
        if zlib.crc32(ids.tobytes()) != crc:
            raise ValueError(f"block {number} is damaged")
        return ids

    def ids(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids ``start`` to ``stop``; only the blocks that overlap them are decoded."""
        start, stop = max(0, start), self.n_ids if stop is None else min(stop, self.n_ids)
        if start >= stop:
            return np.zeros(0, dtype="<u4")
        first = start // self.block_ids
        joined = np.concatenate([self.block(b) for b in range(first, (stop - 1) // self.block_ids + 1)])
        return joined[start - first * self.block_ids:stop - first * self.block_ids]


# ---------------------------------------------------------------- a folder of files

def put_file(folder: str, name: str, content: bytes) -> None:
    """Write under a name of its own, then rename: no reader ever sees half a file, and a repeated task replaces equal bytes."""
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(folder)
    waiting = f"{path}/{name}.{uuid.uuid4().hex}.part"
    with system.open_output_stream(waiting) as out:
        out.write(content)
    system.move(waiting, f"{path}/{name}")


def write_token_files(docs: DataFrame, folder: str, model: str, doc_id: str = "doc_id", text: str = "text", kind: str = "byte",
                      end_id: int = END_ID, block_ids: int = BLOCK_IDS, file_ids: int = FILE_IDS, partitions: int | None = None) -> None:
    """Encode all documents and write them into ``folder`` (see ``shared_folder``), with a table ``index`` of the files."""
    spark = docs.sparkSession
    end = np.array([end_id], dtype="<u4").tobytes()
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    order = ["id", "_hash", "_row"]
    rows = rows.withColumns({"_hash": F.xxhash64("text"), "_row": F.monotonically_increasing_id()})
    dealt = rows.repartitionByRange(partitions, *order) if partitions else rows.repartitionByRange(*order)
    schema = "part int, file int, name string, first_doc long, n_docs long, n_ids long, n_bytes long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = Encoder.of(model), TaskContext.get().partitionId()
        held: list[bytes] = []
        ids: list[int | None] = []
        lengths: list[int] = []
        written: list[tuple] = []
        size = 0

        def close() -> None:
            nonlocal held, ids, lengths, size
            content = pack_file(np.frombuffer(b"".join(held), dtype="<u4"), ids, lengths, kind, block_ids)
            name = f"part-{part:06d}-{len(written):06d}.planes"
            put_file(f"{folder}/files", name, content)
            written.append((part, len(written), name, ids[0], len(ids), size, len(content)))
            held, ids, lengths, size = [], [], [], 0

        for batch in batches:
            for key, tokens in zip(batch.column("id").to_pylist(), encoder.encode(batch.column("text"))):
                held.append(tokens + end)
                ids.append(key)
                lengths.append(len(tokens) // 4 + 1)
                size += lengths[-1]
                if size >= file_ids:
                    close()
        if ids:
            close()
        names = ("part", "file", "name", "first_doc", "n_docs", "n_ids", "n_bytes")
        types = (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([w[i] for w in written], type=t) for i, t in enumerate(types)], names=list(names))

    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/files")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(path)
    with batches_of(spark, 1000):
        dealt.sortWithinPartitions(*order).select("id", "text").mapInArrow(run, schema).write.parquet(f"{folder}/written")
    files = spark.read.parquet(f"{folder}/written")
    # one row per task is ordered in one place; the files of a task within the task's own group
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("_ids"))
    before = parts.select(F.col("part").alias("_part"), F.coalesce(F.sum("_ids").over(
        W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    inside = F.sum("n_ids").over(W.partitionBy("part").orderBy("file").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("n_ids")
    placed = files.withColumn("_inside", inside).join(before, F.col("part") == F.col("_part"))
    placed.select("name", "first_doc", "n_docs", "n_ids", "n_bytes", (F.col("_before") + F.col("_inside")).alias("first_id")).write.parquet(f"{folder}/index")


def _files(spark: SparkSession, folder: str) -> DataFrame:
    content = spark.read.format("binaryFile").option("pathGlobFilter", "*.planes").load(f"{folder}/files")
    return content.select(F.substring_index("path", "/", -1).alias("name"), "content")


def read_token_files(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, and with ``with_ids`` the ids) of every document, decoded from the files' planes."""
    schema = "_name string, doc_id long, _at long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("name"), batch.column("content")):
                stored = PlaneFile.open(content.as_buffer().to_pybytes())
                ids, ends = stored.ids(), np.cumsum(stored.lengths)
                starts = ends - stored.lengths
                raw = memoryview(ids.tobytes())
                for i in range(0, len(ends), 4096):
                    here = slice(i, i + 4096)
                    crcs = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(starts[here].tolist(), ends[here].tolist())]
                    columns = [pa.array([name.as_py()] * len(crcs)), pa.array(stored.doc_ids[here], type=pa.int64()), pa.array(starts[here]),
                               pa.array(stored.lengths[here]), pa.array(crcs, type=pa.int64())]
                    if with_ids:
                        offsets = np.append(starts[here], ends[here][-1]) - starts[i]
                        columns.append(pa.ListArray.from_arrays(pa.array(offsets, type=pa.int32()), pa.array(ids[starts[i]:ends[here][-1]].astype(np.int32))))
                    yield pa.RecordBatch.from_arrays(columns, names=["_name", "doc_id", "_at", "n_tokens", "ids_crc32"] + ["ids"] * with_ids)

    found = _files(spark, folder).mapInArrow(run, schema)
    index = spark.read.parquet(f"{folder}/index").select(F.col("name").alias("_file"), "first_id")
    joined = found.join(index, F.col("_name") == F.col("_file"))
    return joined.select("doc_id", (F.col("first_id") + F.col("_at")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)


def read_stretch(spark: SparkSession, folder: str, start: int, stop: int) -> DataFrame:
    """(first_id, ids) for the parts of ids ``start`` to ``stop`` of the whole sequence: only overlapping files are opened, and in them
    only overlapping blocks are decoded."""
    index = spark.read.parquet(f"{folder}/index").where((F.col("first_id") < stop) & (F.col("first_id") + F.col("n_ids") > start))
    wanted = index.select(F.col("name").alias("_file"), "first_id")
    files = _files(spark, folder).join(wanted, F.col("name") == F.col("_file")).select("first_id", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, content in zip(batch.column("first_id").to_pylist(), batch.column("content")):
                ids = PlaneFile.open(content.as_buffer().to_pybytes()).ids(start - first, stop - first)
                yield pa.RecordBatch.from_arrays([pa.array([max(first, start)]), pa.array([ids.astype(np.int32)], type=pa.list_(pa.int32()))], names=["first_id", "ids"])

    return files.mapInArrow(run, "first_id long, ids array<int>")


def byte_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@llm_query("op12_plane_files")
def op12_plane_files(spark, sf_dir):
    folder = shared_folder(spark, "token-ids")
    write_token_files(table(spark, sf_dir, "documents"), folder, byte_model())
    return read_token_files(spark, folder, with_ids=False)

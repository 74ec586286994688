"""SentencePiece encoding and decoding as a weighted finite-state transducer.

The machine is compiled from a model file on the driver: the normaliser (a dummy prefix, spaces as word marks), the pieces
(a string dictionary read from left to right) and the byte fallback (a character without a piece becomes its UTF-8 bytes).
It is composed with a text on the fly; a state is (position, last piece). For models of merged pairs, an arc from one piece
to the next has weight 0 if merging the two strings together gives just these two pieces, and no finite weight otherwise.
A sequence of pieces is the result of merging exactly if all its neighbours are so, hence the composed machine has one path
of finite weight, the tropical shortest one, and it is found by a search that enters no dead state twice.

Where no piece goes over a place between two characters (before a word mark, say), the shortest path of a text is the
shortest paths of the stretches on both sides, one after the other. A worker process remembers words between single spaces, their stretches and the
arcs, up to a limit; a batch of texts is split into words by Arrow, and each of its distinct words is looked up once. Decoding is the inverse machine: pieces and bytes to text, without the dummy prefix.

NULL text encodes to NULL, the empty text to no pieces. A text that holds the word mark itself (U+2581) decodes to a space
there; every other text comes back exactly. Ids may be NULL or repeated; every input row gets one output row; an empty table gives an
empty result. Columns that are named like the added one are replaced.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.llm.common import small_batches
from tideline.llm.registry import llm_query, table
from tideline.worker import kept as process

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
_REMEMBERED = 400_000
_WHOLE = r"(?s).+"
_LATIN = "A-Za-zÀ-ÖØ-öø-ɏ"
# Arcs are numbered by two piece numbers; characters without a piece are numbered behind the pieces.
_ARC = 21
_START = (1 << _ARC) - 1


@dataclass
class Machine:
    """Pieces as a trie, their priorities in merging (lower merges first), and the ids of the bytes."""

    strings: list[str]  # '' for control pieces and bytes
    trie: dict[str, tuple]  # character to (id of the piece that ends there or -1, what follows)
    priority: dict[str, float]
    byte_ids: list[int]
    outputs: list[bytes]
    prefix: bool
    name: str  # differs between models
    longest: int  # characters of the longest piece
    _arcs: dict[int, bool] = field(default_factory=dict)

    def merged(self, text: str) -> list[str]:
        """The pieces that merging gives: always the pair with the best priority, of equal ones the leftmost."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                p = self.priority.get(parts[i] + parts[i + 1])
                if p is not None and (best is None or p < best):
                    best, at = p, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def symbol(self, number: int) -> str:
        """The string of a piece, or of a character without one."""
        return self.strings[number] if number < len(self.strings) else chr(number - len(self.strings))

    def allowed(self, arc: int) -> bool:
        """Whether an arc, numbered by the piece before it (``_START`` at the start) and its own piece, has finite weight."""
        before, piece = arc >> _ARC, self.symbol(arc & ((1 << _ARC) - 1))
        if len(self._arcs) > 2_000_000:
            self._arcs.clear()
        parts = [piece] if before == _START else [self.symbol(before), piece]
        known = self._arcs[arc] = self.merged("".join(parts)) == parts
        return known

    def path(self, text: str) -> list[int]:
        """The shortest path through ``text``: the only one of finite weight, long arcs being tried first."""
        n, trie, arcs, foreign, longest = len(text), self.trie, self._arcs, len(self.strings), self.longest
        at, before = 0, _START
        stack: list[tuple[int, int, list[tuple[int, int]]]] = []  # position, piece before it, arcs not tried yet
        dead: set[int] = set()
        options: list[tuple[int, int]] | None = None
        while at < n:
            if options is None:  # pieces from here on, by length; a character without a piece stands for its bytes
                options, node, j = [], trie, at
                for c in text[at:at + longest]:
                    entry = node.get(c)
                    if entry is None:
                        break
                    j += 1
                    piece, node = entry
                    if piece >= 0:
                        options.append((j, piece))
                if not options or options[0][0] > at + 1:
                    options.insert(0, (at + 1, foreign + ord(text[at])))
            while options:
                end, piece = options.pop()
                arc = before << _ARC | piece
                finite = arcs.get(arc)
                if (finite or finite is None and self.allowed(arc)) and (not dead or end << _ARC | piece not in dead):
                    stack.append((at, before, options))
                    at, before, options = end, piece, None
                    break
            else:
                if not stack:
                    raise ValueError("no path of finite weight")
                dead.add(at << _ARC | before)
                at, before, options = stack.pop()
        ids: list[int] = []
        for piece in [x[1] for x in stack[1:]] + ([before] if stack else []):
            if piece < foreign:
                ids.append(piece)
            else:
                ids.extend(self.byte_ids[b] for b in self.symbol(piece).encode("utf-8"))
        return ids

    def stretches(self) -> re.Pattern:
        """The stretches that are encoded apart: cut before word marks, around line ends and behind runs of Latin letters, as far as
        no piece goes over such a place."""
        joined = {c for s in self.strings for c in s if len(s) > 1}
        if any(s[i] == MARK and s[i - 1] != MARK for s in self.strings for i in range(1, len(s))) or "\n" in joined:
            return re.compile(_WHOLE)
        if any(re.search(f"[{_LATIN}][^{_LATIN}]", s) for s in self.strings):
            return re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n")
        return re.compile(f"{MARK}*[^{MARK}\n{_LATIN}]*[{_LATIN}]+|{MARK}*[^{MARK}\n{_LATIN}]+|{MARK}+|\n")

    def encoder(self) -> Encoder:
        """The encoder of this worker process, with what it has learned in earlier tasks."""
        found = process().setdefault("pieces", {})
        if self.name not in found:
            found[self.name] = Encoder(self)
        return found[self.name]

    def decode(self, ids: list[int]) -> str:
        data = b"".join([self.outputs[i] for i in ids])
        if self.prefix and data.startswith(b" "):
            data = data[1:]
        return data.decode("utf-8", "replace")


class Encoder(dict):
    """Stretch to the bytes of its ids (little-endian, 32 bits each), remembered; so are words, as they stand behind a single space."""

    def __init__(self, machine: Machine):
        super().__init__()
        pattern = machine.stretches()
        self.machine, self.cut, self.words = machine, pattern.findall, {}
        # every other pattern cuts before each run of word marks
        self.splits = machine.prefix and pattern.pattern != _WHOLE

    def __missing__(self, stretch: str) -> bytes:
        if len(self) > _REMEMBERED:  # the first to come are the most frequent ones
            first = list(islice(self.items(), _REMEMBERED * 5 // 8))
            self.clear()
            self.update(first)
        ids = self[stretch] = struct.pack(f"<{len(found := self.machine.path(stretch))}i", *found)
        return ids

    def _encode(self, text: str) -> bytes:
        if not text:
            return b""
        normal = (MARK if self.machine.prefix else "") + text.replace(" ", MARK)
        return b"".join(map(self.__getitem__, self.cut(normal)))

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The bytes of the ids of every text; NULL counts as the empty one."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if not self.splits or not len(texts):
            return [self._encode(t) for t in texts.to_pylist()]
        if len(self.words) > _REMEMBERED:
            self.words = dict(islice(self.words.items(), _REMEMBERED * 5 // 8))
        parts = pc.split_pattern(texts, " ")
        coded = parts.values.dictionary_encode()
        bounds, codes, words = parts.offsets.to_numpy(), coded.indices.to_numpy(), coded.dictionary.to_pylist()
        found = list(map(self.words.get, words))
        odd = []
        for i, word in enumerate(words):
            if found[i] is None:
                if word and MARK not in word:
                    found[i] = self.words[word] = self._encode(word)
                else:  # next to a run of word marks
                    found[i] = b""
                    odd.append(i)
        whole = set((np.searchsorted(bounds, np.flatnonzero(np.isin(codes, odd)), "right") - 1).tolist()) if odd else ()
        ids = pa.array(found, type=pa.large_binary()).take(pa.array(codes))
        ends = np.frombuffer(ids.buffers()[1], dtype=np.int64)[ids.offset + bounds]
        data = memoryview(ids.buffers()[2] or b"")
        return [self._encode(texts[i].as_py()) if i in whole else data[ends[i]:ends[i + 1]].tobytes() for i in range(len(texts))]


def compile_machine(path: str = MODEL) -> Machine:
    """Read a model file. Its pieces must come from merging, with bytes as fallback and an identity normaliser."""
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    with open(path, "rb") as f:
        content = f.read()
    model.ParseFromString(content)
    normal, trainer = model.normalizer_spec, model.trainer_spec
    if normal.precompiled_charsmap or normal.remove_extra_whitespaces or not normal.escape_whitespaces:
        raise ValueError("only identity normalisers that keep white space are compiled")
    if trainer.model_type != trainer.BPE or not trainer.byte_fallback:
        raise ValueError("only models of merged pairs with byte fallback are compiled")
    kinds = proto.ModelProto.SentencePiece
    strings, priority, byte_ids, outputs = [], {}, [0] * 256, []
    for i, p in enumerate(model.pieces):
        strings.append(p.piece if p.type == kinds.NORMAL else "")
        if p.type == kinds.BYTE:
            value = int(p.piece[3:5], 16)
            byte_ids[value] = i
            outputs.append(bytes([value]))
        elif p.type == kinds.NORMAL:
            priority[p.piece] = -p.score
            outputs.append(p.piece.replace(MARK, " ").encode("utf-8"))
        elif p.type == kinds.USER_DEFINED:
            raise ValueError("user-defined pieces are not compiled")
        else:
            outputs.append(b"")
    trie: dict[str, tuple] = {}
    for i, s in enumerate(strings):
        node = trie
        for j, c in enumerate(s):
            known = node.get(c, (-1, {}))
            node[c] = (i if j == len(s) - 1 else known[0], known[1])
            node = known[1]
    return Machine(strings, trie, priority, byte_ids, outputs, normal.add_dummy_prefix, hashlib.sha256(content).hexdigest(), max(map(len, strings)))


def _ids(lists: list[bytes], missing: pa.Array) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in lists])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(lists), dtype="<i4")), mask=missing if missing.true_count else None)


def encode(docs: DataFrame, machine: Machine, text: str = "text", out: str = "ids", check: str | None = None) -> DataFrame:
    """``docs`` plus the ids of ``text``; with ``check``, also whether decoding gives the text back."""
    small_batches(docs.sparkSession)
    kept = [c for c in docs.columns if c not in (out, check)]
    place = kept.index(text)
    schema = T.StructType([*docs.select(*kept).schema.fields, T.StructField(out, T.ArrayType(T.IntegerType()))])
    if check:
        schema = schema.add(check, T.BooleanType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = machine.encoder()
        for batch in batches:
            texts = batch.column(place)
            lists = encoder.encode(texts)
            columns, names = [*batch.columns, _ids(lists, texts.is_null())], [*kept, out]
            if check:
                columns.append(pa.array([None if t is None else machine.decode(np.frombuffer(x, dtype="<i4").tolist()) == t for t, x in zip(texts.to_pylist(), lists)], type=pa.bool_()))
                names.append(check)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select(*kept).mapInArrow(run, schema)


def decode(encoded: DataFrame, machine: Machine, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``encoded`` plus the text of ``ids``; NULL ids give NULL."""
    small_batches(encoded.sparkSession, 200)
    kept = [c for c in encoded.columns if c != out]
    place = kept.index(ids)
    schema = T.StructType([*encoded.select(*kept).schema.fields, T.StructField(out, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if x is None else machine.decode(x) for x in batch.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, type=pa.string())], names=[*kept, out])

    return encoded.select(*kept).mapInArrow(run, schema)


@llm_query("op8_wfst_pieces")
def op8_wfst_pieces(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = encode(docs, compile_machine(), check="round_trip")
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "round_trip")

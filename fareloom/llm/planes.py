"""Token-id files: fixed-size blocks of ids, transposed into bit or byte planes, each plane compressed by zstandard.

A file is made of chunks and a footer:

    magic  | chunk 0 | chunk 1 | ... | footer | footer length (8 bytes) | magic

A chunk holds `block` consecutive ids (the last one fewer) of a fixed width in bytes. Byte plane p is byte p of every id;
bit plane p is bit p of every id, eight to a byte. A plane is compressed alone; one without any set bit takes no bytes.
The footer is a zstandard-compressed Arrow stream in two parts: the chunk index (first id, ids, offset, and the length of
each plane) and the document index (doc_id, first id, ids). Any id range is read from the chunks it touches alone.

Writing: texts are tokenized into a stored table, which is dealt by ranges of doc_id and sorted; each task writes files
under names of its own and hands on one row per file. Only the rows of tasks that Spark commits are in the manifest, so
that a task that is run again leaves a file that nobody reads. The manifest has one row per file; a file ends after
`file_ids` ids, so its number grows with the corpus by a known factor, and it is ordered on the driver.
Tasks reach the folder by pyarrow's file systems (local and shared paths, hdfs, s3, gs, abfs).

Defined results: a null or empty text has the end id alone; a null doc_id comes first; rows with equal doc_id follow each
other in the order of the input; an empty table gives no file and no rows. Columns other than doc_id and text are not
read. Texts of any length are tokenized whole.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from fareloom.llm.frames import gathered, python_tasks, stored
from fareloom.llm.packing import ChunkEncoder, byte_of_symbol, added_bounds, added_tokens
from fareloom.llm.words import text_slices
from fareloom.sources.tables import scratch_path

MAGIC = b"IDPLANE1"
BLOCK = 1 << 16
FILE_IDS = 1 << 26
LEVEL = 3
MANIFEST = "part long, number long, path string, n_ids long, n_docs long, n_bytes long"


# Blocks ------------------------------------------------------------------------------------------------------------

def id_width(largest: int) -> int:
    """Bytes of an id: 2 if all ids fit, else 4."""
    return 2 if largest < 1 << 16 else 4


def split_planes(ids: np.ndarray, width: int, bits: bool) -> list[bytes]:
    """The planes of a block, lowest first; a plane of zeros is empty."""
    columns = np.ascontiguousarray(ids.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T)
    if bits:
        columns = np.concatenate([np.packbits((column[None, :] >> np.arange(8, dtype=np.uint8)[:, None]) & 1, axis=1) for column in columns])
    return [column.tobytes() if column.any() else b"" for column in columns]


def join_planes(planes: list[bytes], count: int, width: int, bits: bool) -> np.ndarray:
    columns = np.zeros((width, count), np.uint8)
    for i, plane in enumerate(planes):
        if plane and bits:
            columns[i // 8] |= np.unpackbits(np.frombuffer(plane, np.uint8), count=count) << np.uint8(i % 8)
        elif plane:
            columns[i] = np.frombuffer(plane, np.uint8)
    return np.ascontiguousarray(columns.T).view(f"<u{width}").ravel().astype(np.uint32)


# Files -------------------------------------------------------------------------------------------------------------

@dataclass
class PlaneWriter:
    """Writes one file from ids that come document by document; holds one block and the two indexes."""

    sink: pa.NativeFile
    width: int
    bits: bool = False
    block: int = BLOCK
    n_ids: int = 0
    held: list[np.ndarray] = field(default_factory=list)
    n_held: int = 0
    chunks: list[tuple] = field(default_factory=list)
    docs: list[tuple] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.press = zstandard.ZstdCompressor(level=LEVEL)
        self.sink.write(MAGIC)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc_id, self.n_ids, len(ids)))
        self.n_ids += len(ids)
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= self.block:
            waiting = np.concatenate(self.held)
            full = len(waiting) - len(waiting) % self.block
            for at in range(0, full, self.block):
                self._chunk(waiting[at:at + self.block])
            self.held, self.n_held = [waiting[full:]], len(waiting) - full

    def _chunk(self, ids: np.ndarray) -> None:
        packed = [self.press.compress(p) if p else b"" for p in split_planes(ids, self.width, self.bits)]
        first = self.chunks[-1][0] + self.chunks[-1][1] if self.chunks else 0
        self.chunks.append((first, len(ids), self.sink.tell(), [len(p) for p in packed]))
        self.sink.write(b"".join(packed))

    def close(self) -> int:
        """Writes what is held, the indexes and the end; the bytes of the file."""
        if self.n_held:
            self._chunk(np.concatenate(self.held))
        places = pa.table({"first": pa.array([c[0] for c in self.chunks], pa.int64()), "n": pa.array([c[1] for c in self.chunks], pa.int64()),
                           "offset": pa.array([c[2] for c in self.chunks], pa.int64()),
                           "planes": pa.array([c[3] for c in self.chunks], pa.list_(pa.int64()))})
        owners = pa.table({"doc_id": pa.array([d[0] for d in self.docs], pa.int64()), "first": pa.array([d[1] for d in self.docs], pa.int64()),
                           "n": pa.array([d[2] for d in self.docs], pa.int64())})
        head = json.dumps({"width": self.width, "bits": self.bits, "block": self.block, "n_ids": self.n_ids}).encode()
        parts = [head]
        for part in (places, owners):
            out = pa.BufferOutputStream()
            with pa.ipc.new_stream(out, part.schema) as stream:
                stream.write_table(part)
            parts.append(self.press.compress(out.getvalue()))
        footer = struct.pack("<3q", *map(len, parts)) + b"".join(parts)
        self.sink.write(footer + struct.pack("<q", len(footer)) + MAGIC)
        size = self.sink.tell()
        self.sink.close()
        return size


class PlaneReader:
    """Reads one file; only the footer is read at first."""

    def __init__(self, path: str):
        system, place = fs.FileSystem.from_uri(path)
        self.source = system.open_input_file(place)
        size, tail = self.source.size(), 8 + len(MAGIC)
        length, magic = struct.unpack(f"<q{len(MAGIC)}s", self.source.read_at(tail, size - tail))
        if magic != MAGIC or self.source.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError(f"not a token-id file, or cut short: {path}")
        footer = self.source.read_at(length, size - tail - length)
        lengths = struct.unpack("<3q", footer[:24])
        ends = 24 + np.cumsum(lengths)
        head, places, owners = (bytes(footer[e - n:e]) for e, n in zip(ends, lengths))
        self.head = json.loads(head)
        unpress = self.unpress = zstandard.ZstdDecompressor()
        self.chunks = pa.ipc.open_stream(unpress.decompress(places)).read_all()
        self.docs = pa.ipc.open_stream(unpress.decompress(owners)).read_all()
        self.firsts, self.counts, self.offsets = (self.chunks[c].to_numpy() for c in ("first", "n", "offset"))

    def chunk(self, i: int) -> np.ndarray:
        lengths, count = self.chunks["planes"][i].as_py(), int(self.counts[i])
        raw, planes, at = self.source.read_at(sum(lengths), int(self.offsets[i])), [], 0
        for n in lengths:
            planes.append(self.unpress.decompress(raw[at:at + n]) if n else b"")
            at += n
        return join_planes(planes, count, self.head["width"], self.head["bits"])

    def ids(self, first: int, count: int) -> np.ndarray:
        """Ids first .. first + count - 1 of the file, from the chunks that hold them."""
        if not 0 <= first <= first + count <= self.head["n_ids"]:
            raise IndexError((first, count))
        low, high = (int(np.searchsorted(self.firsts, x, side="right")) - 1 for x in (first, max(first + count - 1, first)))
        if not count:
            return np.zeros(0, np.uint32)
        found = np.concatenate([self.chunk(i) for i in range(low, high + 1)])
        return found[first - self.firsts[low]:][:count]

    def documents(self) -> Iterator[tuple[int | None, int, int, int]]:
        """doc_id, first id, number of ids and their crc32 of every document, in one pass over the chunks."""
        at, held = -1, np.zeros(0, np.uint32)
        for doc_id, first, count in zip(*(self.docs[c].to_pylist() for c in ("doc_id", "first", "n"))):
            crc, place, end = 0, first, first + count
            while place < end:
                while at < 0 or place >= self.firsts[at] + self.counts[at]:
                    at, held = at + 1, self.chunk(at + 1)
                piece = held[place - self.firsts[at]:end - self.firsts[at]]
                crc, place = zlib.crc32(piece.astype("<u4").tobytes(), crc), place + len(piece)
            yield doc_id, first, count, crc

    def close(self) -> None:
        self.source.close()


# Tokens ------------------------------------------------------------------------------------------------------------

# Fixed value: the pattern that the vocabulary files with word ends split texts by.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
LETTERS = re.compile(rb"(?:[a-z]|\xc3[\xa0-\xb6\xb8-\xbf])+")
_OTHER, _SPACE, _WORD, _DIGIT, _SIGN = range(5)
_KIND = np.zeros(256, np.uint8)
_KIND[33:127] = _SIGN
_KIND[39] = _OTHER  # an apostrophe may join the letters behind it
_KIND[[*range(65, 91), *range(97, 123)]] = _WORD
_KIND[48:58] = _DIGIT
_KIND[[32, *range(9, 14)]] = _SPACE
_LOWERED = np.arange(256, dtype=np.uint8)
_LOWERED[65:91] += 32


class WordEncoder(ChunkEncoder):
    """Ids of texts under a BPE vocabulary file with word ends, lower case and no white space.

    No token reaches over white space, from a letter to a sign or digit, or from those to a letter; texts are cut there
    and each distinct piece is encoded once. Pieces that are a word of letters of ASCII and U+00DF to U+00FF go to tiktoken
    (same merges, several times faster), all others through the tokenizers library and the file as it is.
    """

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        document = json.loads(vocabulary)
        steps = [s["type"] for s in document["normalizer"]["normalizers"]]
        pattern = document["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        if steps != ["NFC", "Replace", "Lowercase"] or pattern != WORD_PATTERN:
            raise ValueError("not a vocabulary of lower-cased words with word ends")
        self.added = added_tokens(document)
        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.fast = self._word_coder(document["model"])
        self.forget()

    def _word_coder(self, model: dict):
        """tiktoken over stand-ins: each byte of a letter has one ASCII character within a word and one at its end."""
        inner = [*range(97, 123), 0xC3, *range(0xA0, 0xC0)]
        last = [b for b in inner if b != 0xC3]  # the lead byte of a letter never ends a word
        free = iter([b for b in range(128) if not 97 <= b < 123])
        self.within = bytearray(256)
        for b in inner:
            self.within[b] = b if b < 128 else next(free)
        self.at_end = {b: next(free) for b in last}
        end, bytes_of = model["end_of_word_suffix"], byte_of_symbol()
        if any(model["vocab"].get("".join(m if isinstance(m, list) else m.split(" "))) != 512 + i for i, m in enumerate(model["merges"])):
            return None
        ranks = {}
        for token, i in model["vocab"].items():
            closed = token.endswith(end)
            raw = bytes(bytes_of[c] for c in (token[:-len(end)] if closed else token))
            if all(b in inner for b in raw) and not (closed and raw[-1] not in self.at_end):
                ranks[self._standing(raw) if closed else raw.translate(self.within)] = i
        import tiktoken

        return tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def _standing(self, word: bytes) -> bytes:
        return word[:-1].translate(self.within) + bytes([self.at_end[word[-1]]])

    def pieces(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bytes without white space and with Latin letters lower-cased, the start of each piece, and each text's end."""
        kind = _KIND[data]
        low = _LOWERED[data]
        lead = np.flatnonzero(data[:-1] == 0xC3)
        tail = data[lead + 1]
        letter = (tail != 0x97) & (tail != 0xB7)  # multiplication and division signs
        lead, tail = lead[letter], tail[letter]
        kind[lead] = kind[lead + 1] = _WORD
        low[lead + 1] = np.where(tail < 0x9F, tail + 0x20, tail)
        before, after = kind[:-1], kind[1:]
        cut = np.zeros(len(data), bool)
        cut[1:] = (before == _SPACE) | ((before != after) & (before > _SPACE) & (after > _SPACE)) | ((before == _DIGIT) & (after == _DIGIT))
        edges = added_bounds(data, offsets, self.added)
        if edges is not offsets:  # added tokens stay as they are
            for begin, end in zip(edges[:-1].tolist(), edges[1:].tolist()):
                if data[begin:end].tobytes() in self.added:
                    cut[begin:end], low[begin:end] = False, data[begin:end]
        cut[edges[:-1][edges[:-1] < len(data)]] = True
        solid = kind != _SPACE
        kept = np.concatenate([[0], np.cumsum(solid)])
        starts = np.append(kept[np.flatnonzero(cut)], kept[-1])  # ascending; pieces of white space alone are empty
        return low[solid], starts[:-1][starts[:-1] != starts[1:]], kept[offsets]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets) - 1, np.int64)
        letters, starts, bounds = self.pieces(data, offsets)
        return self.encode_pieces(letters, starts, bounds)

    def encode_chunks(self, chunks: list[bytes]) -> list[list[int]]:
        plain = [bool(self.fast and LETTERS.fullmatch(c)) for c in chunks]
        others = [c.decode() for c, known in zip(chunks, plain) if not known]
        slow = iter(self.tokenizer.encode_batch_fast(others, add_special_tokens=False) if others else [])
        return [self.fast(self._standing(c).decode("ascii")) if known else next(slow).ids for c, known in zip(chunks, plain)]


_ENCODERS: dict[int, WordEncoder] = {}


def tokenized(docs: DataFrame, vocabulary: str, end_id: int, width: int) -> DataFrame:
    """doc_id, uid (tells rows apart, in input order) and ids (little-endian, `width` bytes each) of every row."""
    python_tasks(docs.sparkSession)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = hash(vocabulary)
        if key not in _ENCODERS:
            _ENCODERS.clear()
            _ENCODERS[key] = WordEncoder(vocabulary)
        encoder, uid = _ENCODERS[key], TaskContext.get().partitionId() << 40
        for batch in gathered(batches):
            rows: list[bytes] = []
            for _, _, data, offsets in text_slices(batch.column(1)):
                ids, ends = encoder.encode(data, offsets)
                begin = 0
                for stop in ends.tolist():
                    rows.append(np.append(ids[begin:stop], np.uint32(end_id)).astype(f"<u{width}").tobytes())
                    begin = stop
            uids = pa.array(np.arange(uid, uid + len(rows)))
            uid += len(rows)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), uids, pa.array(rows, pa.binary())], ["doc_id", "uid", "ids"])

    return docs.select("doc_id", "text").mapInArrow(encode, "doc_id long, uid long, ids binary")


# The corpus --------------------------------------------------------------------------------------------------------

def write_corpus(docs: DataFrame, vocabulary_path: str, end_id: int, folder: str | None = None, bits: bool = False,
                 block: int = BLOCK, file_ids: int = FILE_IDS) -> DataFrame:
    """Writes all documents in ascending doc_id order; returns the manifest, one row per file (see MANIFEST).

    The files in order of (part, number) hold the ids of all documents in order. `folder` must be reachable from all
    tasks; unset, it is a scratch folder of the application.
    """
    spark = docs.sparkSession
    with open(vocabulary_path, encoding="utf-8") as file:
        vocabulary = file.read()  # a vocabulary of fixed size, carried with the task's code
    document = json.loads(vocabulary)
    largest = max([end_id, *document["model"]["vocab"].values(), *(t["id"] for t in document["added_tokens"])])
    width, place = id_width(largest), folder or scratch_path(spark, "token-files")
    tokens = stored(tokenized(docs, vocabulary, end_id, width), "token-ids")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(place)
        system.create_dir(root, recursive=True)
        part, attempt, number = TaskContext.get().partitionId(), uuid.uuid4().hex, 0
        writer, name, done = None, "", []

        def finish() -> None:
            done.append((part, number, f"{place}/{name}", writer.n_ids, len(writer.docs), writer.close()))

        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), batch.column(1)):
                if writer is None:
                    name = f"{part:06d}-{number:06d}-{attempt}.ids"
                    writer = PlaneWriter(system.open_output_stream(f"{root}/{name}"), width, bits, block)
                writer.add(doc_id, np.frombuffer(ids.as_buffer(), f"<u{width}"))
                if writer.n_ids >= file_ids:
                    finish()
                    writer, number = None, number + 1
        if writer is not None:
            finish()
        columns = list(zip(*done)) or [()] * 6
        names = ["part", "number", "path", "n_ids", "n_docs", "n_bytes"]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if n == "path" else pa.int64()) for n, c in zip(names, columns)], names)

    ordered = tokens.repartitionByRange("doc_id", "uid").sortWithinPartitions("doc_id", "uid").select("doc_id", "ids")
    return stored(ordered.mapInArrow(write, MANIFEST), "token-manifest")


def placed_files(manifest: DataFrame) -> DataFrame:
    """The manifest with `base`, the ids in all files before; a task for each file. One short row per file goes through the driver."""
    spark, files = manifest.sparkSession, manifest.orderBy("part", "number").collect()
    bases = np.cumsum([0, *(f.n_ids for f in files)])
    schema = T.StructType([*manifest.schema.fields, T.StructField("base", T.LongType())])
    return spark.createDataFrame([(*f, int(b)) for f, b in zip(files, bases)], schema).repartition(max(len(files), 1))


def read_corpus(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32 of every document, read from the files."""
    files = placed_files(manifest)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                reader = PlaneReader(path)
                rows = list(reader.documents())
                reader.close()
                doc_id, first, count, crc = zip(*rows)
                yield pa.RecordBatch.from_arrays([pa.array(doc_id, pa.int64()), pa.array(np.array(first) + base),
                                                  pa.array(count, pa.int64()), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return files.select("path", "base").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")

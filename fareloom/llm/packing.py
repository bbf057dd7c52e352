"""Packing of documents into sequences of at most `window` tokens by non-negative least squares over length patterns.

1. Every text is tokenized and closed by an end token; whole windows are cut off and stand alone without padding, the
   rest (shorter than a window) is one piece.
2. The histogram of rest lengths (at most window - 1 counts, whatever the input) goes to the driver. Shallow patterns,
   up to `depth` lengths that fill a window exactly, are the columns of a non-negative least squares problem: how often
   must each be used so that the lengths used equal the histogram? The counts are rounded down.
3. What rounding leaves is packed greedily, pattern by pattern: the longest length first, then always the longest that fits.
4. Each rest gets a rank within its length; the plan says which sequence and offset holds that rank.

Defined results: a null or empty text is its end token alone; repeated rows and null ids are documents of their own; an
empty table gives no rows. Columns other than doc_id and text are not read. Texts of any length are tokenized whole.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fareloom.llm.frames import python_tasks, stored
from fareloom.llm.words import text_slices

PIECES = "doc_id long, uid long, start long, length long, ids_crc32 long, doc_tokens long"
BUCKETS = 1024
CACHED_CHUNKS = 400_000
_ENCODERS: dict[int, "ChunkEncoder"] = {}


def byte_of_symbol() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies write for the 256 bytes."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {chr(b): b for b in shown}
    for i, b in enumerate(b for b in range(256) if b not in shown):
        table[chr(256 + i)] = b
    return table


class ChunkEncoder:
    """Token ids of texts under a byte-level BPE vocabulary file of the tokenizers library.

    Texts are cut where no token can cross, distinct chunks are encoded once and looked up afterwards. If the file's
    merge order is its id order, new chunks go to tiktoken (same merges, several times faster), else to tokenizers.
    The strings of the file's added tokens have ids of their own wherever they stand; they are cut out first, and what
    lies between them is encoded as a text of its own, as the library does.
    """

    def __init__(self, vocabulary: str, pattern: str):
        document = json.loads(vocabulary)
        model, table = document["model"], byte_of_symbol()
        self.added = added_tokens(document)
        vocab, merges = model["vocab"], model["merges"]
        pairs = (m if isinstance(m, list) else m.split(" ") for m in merges)
        if all(vocab.get(a + b) == 256 + i for i, (a, b) in enumerate(pairs)):
            import tiktoken

            ranks = {bytes(table[c] for c in token): i for token, i in vocab.items() if i < 256 + len(merges)}
            fast = tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
            self.encode_chunk = fast.encode_ordinary
        else:
            from tokenizers import Tokenizer

            slow = Tokenizer.from_str(vocabulary)
            self.encode_chunk = lambda chunk: slow.encode(chunk, add_special_tokens=False).ids
        self.forget()

    def forget(self) -> None:
        self.place: dict[bytes, int] = {}
        self.flat, self.start, self.length = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def encode_chunks(self, chunks: list[bytes]) -> list[list[int]]:
        return [[self.added[c]] if c in self.added else self.encode_chunk(c.decode()) for c in chunks]

    def _encode_new(self, chunks: list[bytes]) -> None:
        each = self.encode_chunks(chunks)
        lengths = np.fromiter(map(len, each), np.int64, len(each))
        ids = np.fromiter((i for e in each for i in e), np.uint32)
        begin = len(self.flat) + np.cumsum(lengths) - lengths
        self.place.update(zip(chunks, range(len(self.start), len(self.start) + len(chunks))))
        self.flat = np.concatenate([self.flat, ids])
        self.start, self.length = np.concatenate([self.start, begin]), np.concatenate([self.length, lengths])

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a run of texts and the end of each text in them."""
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets) - 1, np.int64)
        return self.encode_pieces(data, chunk_starts(data, added_bounds(data, offsets, self.added)), offsets)

    def encode_pieces(self, data: np.ndarray, cuts: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As `encode`, for bytes cut at `cuts`; no piece lies in two texts."""
        if not len(cuts):
            return np.zeros(0, np.uint32), np.zeros(len(offsets) - 1, np.int64)
        bounds = np.append(cuts, len(data)).astype(np.int32)
        chunks = pa.Array.from_buffers(pa.binary(), len(cuts), [None, pa.py_buffer(bounds.tobytes()), pa.py_buffer(data)])
        coded = chunks.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.place) > CACHED_CHUNKS:
            self.forget()
        new = [c for c in distinct if c not in self.place]
        if new:
            self._encode_new(new)
        known = np.fromiter((self.place[c] for c in distinct), np.int64, len(distinct))[coded.indices.to_numpy()]
        lengths = self.length[known]
        ends = np.cumsum(lengths)
        ids = self.flat[np.repeat(self.start[known] - (ends - lengths), lengths) + np.arange(int(ends[-1]))]
        last = np.searchsorted(cuts, offsets[1:]) - 1  # last chunk before each text's end
        return ids, np.where(last >= 0, ends[np.maximum(last, 0)], 0)


def added_tokens(document: dict) -> dict[bytes, int]:
    """Strings of a vocabulary file's added tokens and their ids; those that reach into their surroundings are refused."""
    wide = [t["content"] for t in document.get("added_tokens", []) if t["single_word"] or t["lstrip"] or t["rstrip"]]
    if wide:
        raise ValueError(f"added tokens that depend on the text around them: {wide}")
    return {t["content"].encode(): t["id"] for t in document.get("added_tokens", [])}


def added_bounds(data: np.ndarray, offsets: np.ndarray, added: dict[bytes, int]) -> np.ndarray:
    """`offsets` with the bounds of all added tokens in the texts between them, sorted."""
    if not added:
        return offsets
    form = re.compile(b"|".join(map(re.escape, sorted(added, key=len, reverse=True))))
    if not form.search(data):
        return offsets
    found = [edge + begin for begin, end in zip(offsets[:-1].tolist(), offsets[1:].tolist())
             for match in form.finditer(data[begin:end]) for edge in match.span()]
    return np.unique(np.concatenate([offsets, np.array(found, offsets.dtype)]))


def chunk_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Places where a text can be cut without changing its tokens.

    A blank or line break that follows a character other than white space always opens a token, and so does a
    character other than white space after a single line break. Only characters known not to be white space count: ASCII from
    0x21 to 0x7E and two-byte characters from U+00C0 on.
    """
    ascii_solid = (data > 0x20) & (data < 0x7F)
    lead = (data >= 0xC3) & (data <= 0xDF)
    known_end = ascii_solid.copy()
    known_end[1:] |= lead[:-1] & (data[1:] >= 0x80) & (data[1:] < 0xC0)
    cut = np.zeros(len(data), bool)
    cut[1:] = ((data[1:] == 0x20) | (data[1:] == 0x0A)) & known_end[:-1]
    cut[offsets[:-1][offsets[:-1] < len(data)]] = True
    # only after a line break that is a run of white space of its own: longer runs are split by what follows them
    alone = cut & (data == 0x0A)
    cut[1:] |= alone[:-1] & (ascii_solid[1:] | lead[1:])
    return np.flatnonzero(cut)


def token_pieces(docs: DataFrame, vocabulary: str, pattern: str, window: int, end_id: int) -> DataFrame:
    """One row per piece: whole windows, then the rest. uid tells all pieces apart."""
    python_tasks(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = hash((vocabulary, pattern))
        if key not in _ENCODERS:
            _ENCODERS.clear()
            _ENCODERS[key] = ChunkEncoder(vocabulary, pattern)
        encoder, uid = _ENCODERS[key], TaskContext.get().partitionId() << 40
        for batch in batches:
            ids_in = batch.column(0).to_pylist()
            rows: list[tuple] = []
            for first, _, data, offsets in text_slices(batch.column(1)):
                ids, ends = encoder.encode(data, offsets)
                begin = 0
                for i, stop in enumerate(ends.tolist()):
                    own = np.append(ids[begin:stop], np.uint32(end_id)).astype("<u4")
                    total, begin = len(own), stop
                    for at in range(0, total, window):
                        piece = own[at:at + window]
                        rows.append((ids_in[first + i], uid, at, len(piece), zlib.crc32(piece.tobytes()), total))
                        uid += 1
            columns = list(zip(*rows)) or [()] * 6
            names = ["doc_id", "uid", "start", "length", "ids_crc32", "doc_tokens"]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    return docs.select("doc_id", "text").mapInArrow(cut, PIECES)


# Plan --------------------------------------------------------------------------------------------------------------

def shallow_patterns(lengths: np.ndarray, window: int, depth: int) -> list[tuple[int, ...]]:
    """Every way to fill a window exactly with at most `depth` of the lengths."""
    present = {int(x) for x in lengths}
    found: list[tuple[int, ...]] = []

    def extend(prefix: tuple[int, ...], left: int, most: int) -> None:
        if left <= most and left in present:
            found.append((*prefix, left))
        if len(prefix) + 2 <= depth:
            for x in sorted((x for x in present if x <= most and x < left and x * (depth - len(prefix)) >= left), reverse=True):
                extend((*prefix, x), left - x, x)

    extend((), window, window)
    return found


def solve_counts(patterns: list[tuple[int, ...]], lengths: np.ndarray, counts: np.ndarray, window: int, rounds: int = 300) -> np.ndarray:
    """Non-negative least squares, min |A x - h|: accelerated projected gradient on the sparse pattern matrix."""
    if not patterns:
        return np.zeros(0)
    width = max(map(len, patterns))
    row = np.full(window + 1, len(lengths))
    row[lengths] = np.arange(len(lengths))
    used = np.full((len(patterns), width), len(lengths))
    for k in range(width):
        has = np.array([len(p) > k for p in patterns])
        used[has, k] = row[[p[k] for p in patterns if len(p) > k]]

    def forward(x: np.ndarray) -> np.ndarray:
        return np.bincount(used.ravel(), np.repeat(x, width), len(lengths) + 1)[:-1]

    def backward(y: np.ndarray) -> np.ndarray:
        return np.append(y, 0.0)[used].sum(axis=1)

    probe = np.ones(len(patterns))
    for _ in range(20):
        probe = backward(forward(probe))
        norm = np.linalg.norm(probe)
        probe /= norm
    x = z = np.zeros(len(patterns))
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(z - backward(forward(z) - counts) / (1.05 * norm), 0.0)
        after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z, x, t = new + (t - 1) / after * (new - x), new, after
    return x


def packing_plan(lengths: np.ndarray, counts: np.ndarray, window: int, depth: int = 3) -> list[tuple[tuple[int, ...], int]]:
    """Patterns and how often each is used; together they use every length exactly as often as it occurs."""
    left = np.zeros(window + 1, np.int64)
    left[lengths] = counts
    plan: list[tuple[tuple[int, ...], int]] = []

    def use(pattern: tuple[int, ...], times: int) -> None:
        if times > 0:
            plan.append((pattern, times))
            np.subtract.at(left, list(pattern), times)

    def possible(pattern: tuple[int, ...]) -> int:
        return min(int(left[x]) // pattern.count(x) for x in set(pattern))

    patterns = shallow_patterns(lengths, window, depth)
    solved = solve_counts(patterns, lengths, counts.astype(float), window)
    for i in np.argsort(-solved, kind="stable"):
        if solved[i] < 1:
            break
        use(patterns[i], min(int(solved[i] + 1e-9), possible(patterns[i])))
    while left.any():
        pattern, room, free = [], window, left.copy()
        while room > 0:
            fitting = np.flatnonzero(free[:room + 1])
            if not len(fitting):
                break
            pattern.append(int(fitting[-1]))
            free[fitting[-1]] -= 1
            room -= int(fitting[-1])
        use(tuple(pattern), possible(tuple(pattern)))
    return plan


def slots(plan: list[tuple[tuple[int, ...], int]]) -> tuple[dict[int, tuple[np.ndarray, ...]], int]:
    """For each length: ends of its rank ranges, with first rank, first sequence and offset of each; and the sequences used."""
    seen: dict[int, int] = {}
    found: dict[int, list[tuple[int, int, int, int]]] = {}
    sequence = 0
    for pattern, times in plan:
        offset = 0
        for x in pattern:
            begin = seen.get(x, 0)
            seen[x] = begin + times
            found.setdefault(x, []).append((begin + times, begin, sequence, offset))
            offset += x
        sequence += times
    return {x: tuple(np.array(c, np.int64) for c in zip(*rows)) for x, rows in found.items()}, sequence


def pack(docs: DataFrame, vocabulary_path: str, pattern: str, window: int = 1024, end_id: int = 0, depth: int = 3) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset of every piece of `docs`."""
    spark = docs.sparkSession
    with open(vocabulary_path, encoding="utf-8") as file:
        vocabulary = file.read()  # a vocabulary of fixed size, carried with the task's code
    pieces = stored(token_pieces(docs, vocabulary, pattern, window, end_id), "packing-pieces")
    rests = pieces.where(F.col("length") < window).withColumn("bucket", F.pmod(F.xxhash64("uid"), F.lit(BUCKETS)).cast("int"))
    cells = stored(rests.groupBy("length", "bucket").count(), "packing-cells")
    histogram = cells.groupBy("length").agg(F.sum("count").alias("n")).orderBy("length").collect()  # at most window - 1 rows
    plan = packing_plan(np.array([r.length for r in histogram], np.int64), np.array([r.n for r in histogram], np.int64), window, depth)
    places, sequences = slots(plan)

    before = F.coalesce(F.sum("count").over(
        Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cells = cells.select(F.col("length").alias("c_length"), F.col("bucket").alias("c_bucket"), before.alias("before"))
    ranked = (
        rests.withColumn("rank", F.row_number().over(Window.partitionBy("length", "bucket").orderBy("uid")) - 1)
        .join(cells, (F.col("length") == F.col("c_length")) & (F.col("bucket") == F.col("c_bucket")))
        .select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("rank") + F.col("before")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column(2).to_numpy(), batch.column(5).to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for x in np.unique(length):
                own = np.flatnonzero(length == x)
                ends, begins, firsts, offsets = places[int(x)]
                at = np.searchsorted(ends, rank[own], side="right")
                sequence[own], offset[own] = firsts[at] + rank[own] - begins[at], offsets[at]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)], names=batch.schema.names)

    # a whole window is a sequence of its own, numbered above those of the plan
    whole = pieces.where(F.col("length") == window).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("uid") + F.lit(sequences)).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"))
    return ranked.mapInArrow(place, ranked.schema).unionByName(whole)

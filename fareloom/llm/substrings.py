"""Substring deduplication: words covered by a repeated window are removed, found by a count-min prefilter and exact groups.

A window is `width` consecutive words of one document. Counting every window exactly would move all of them; a sketch
of counters says for most that they occur once.

1. Each window is sketched by its anchor: the least of its `anchor` words long word runs (by hash, the leftmost of
   equal ones). Equal windows have equal anchors at different places, so an anchor occurs at least as often as each of
   its windows, and there are about ten times fewer anchors than windows.
2. Every task counts its anchors into `depth` rows of `counters` counters. The partition sketches are merged by counter
   range; counters that reached 2 become bits. Sums over hashed counters only overestimate, so no repeat is lost.
3. A second pass over the texts hashes the windows whose anchor is estimated repeated (every counter at 2) and groups
   exactly these by their hash (96 bits of the words' 64-bit hashes). A group of one is a window that was estimated
   wrongly, and its place is known; all others are repeated.
4. A last pass finds the estimated windows again, leaves out the wrong ones, which were sent to their documents, and cuts
   what the others cover. So only hashes and counts move, not all places of repeated windows, and a window that
   occurs very often is combined ahead of the shuffle.

The sketch that the tasks read has depth x counters bits, a size set by parameters and not by the data; more counters
make the prefilter sharper, never the result different.

Defined results: a null text has no words; a document shorter than a window keeps all; repeated rows are different
places, so all their windows go; null ids are kept as they are; an empty table gives no rows. Columns other than doc_id
and text are not read; other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.llm.frames import python_tasks, text_column
from fareloom.llm.sketches import SKETCH, estimated, merged_bits, partition_sketch
from fareloom.llm.words import hash_windows, hash_words, split_words, text_slices


class Windows:
    """Windows of a run of texts: the first word of each, and the place (word) and hash of its anchor."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, width: int, anchor: int):
        self.words = split_words(data, offsets)
        self.hashes = hash_words(data, self.words)
        self.width = width
        count = self.words.count
        # a window belongs to the text of its first word and must end in it
        self.text = np.repeat(np.arange(len(count)), np.maximum(count - width + 1, 0))
        before = np.cumsum(np.maximum(count - width + 1, 0)) - np.maximum(count - width + 1, 0)
        self.start = np.arange(len(self.text)) - before[self.text] + self.words.first[:-1][self.text]
        if not len(self.start):
            self.place, self.anchors = np.zeros(0, np.int64), np.zeros(0, np.uint64)
            return
        grams = hash_windows(self.hashes, anchor)
        # high half of the hash, then the place: the least is the leftmost of the smallest
        low = np.uint64(0xFFFFFFFF)
        least, have = (grams & ~low) | np.arange(len(grams), dtype=np.uint64), 1
        need = width - anchor + 1
        while have < need:
            step = min(have, need - have)
            least = np.minimum(least[:-step], least[step:])
            have += step
        self.place = (least[self.start] & low).astype(np.int64)
        self.anchors = grams[self.place]

    def occurrences(self) -> np.ndarray:
        """Hash of each anchor, once for each place."""
        if not len(self.place):
            return self.anchors
        new = np.ones(len(self.place), bool)
        new[1:] = self.place[1:] != self.place[:-1]
        return self.anchors[new]


def repeated_counters(docs: DataFrame, width: int, anchor: int, counters: int, depth: int) -> np.ndarray:
    """Bits of the merged sketch: which of the depth x counters counters reached 2."""
    python_tasks(docs.sparkSession)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = (
            Windows(data, offsets, width, anchor).occurrences()
            for batch in batches for _, _, data, offsets in text_slices(batch.column(0)))
        yield from partition_sketch(anchors, counters, depth)

    return merged_bits(docs.select("text").mapInArrow(sketch, SKETCH), counters, depth, 2)


def wrong_starts(docs: DataFrame, bits: Broadcast, width: int, anchor: int, counters: int, depth: int) -> DataFrame:
    """doc_id, text_key and start (word) of every window that is estimated repeated and starts at one place only."""

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(1).to_numpy()
            for first, _, data, offsets in text_slices(batch.column(2)):
                windows = Windows(data, offsets, width, anchor)
                keep = np.flatnonzero(estimated(windows.anchors, bits.value, counters, depth))
                if not len(keep):
                    continue
                at, text = windows.start[keep], windows.text[keep]
                place = ((at - windows.words.first[text]) << 32) + keys[text + first]
                yield pa.RecordBatch.from_arrays([
                    pa.array(hash_windows(windows.hashes, width, 1, at).view(np.int64)),
                    pa.array((hash_windows(windows.hashes, width, 2, at) >> np.uint64(33)).astype(np.int32)),
                    batch.column(0).take(pa.array(text + first)), pa.array(place),
                ], ["h1", "h2", "doc_id", "place"])

    found = keyed(docs).mapInArrow(candidates, "h1 long, h2 int, doc_id long, place long")
    single = found.groupBy("h1", "h2").agg(
        F.count(F.lit(1)).alias("places"), F.min("doc_id").alias("doc_id"), F.min("place").alias("place")).where("places = 1")
    return single.select("doc_id", F.col("place").bitwiseAND(F.lit(0xFFFFFFFF)).alias("text_key"), F.shiftright("place", 32).cast("int").alias("start"))


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text_key and text: id and key together tell texts apart, equal rows share them."""
    return docs.select("doc_id", F.hash(text_column()).cast("long").bitwiseAND(F.lit(0xFFFFFFFF)).alias("text_key"), text_column().alias("text"))


def joined_words(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> bytes:
    """The words' bytes with one blank between two."""
    if not len(start):
        return b""
    lengths = end - start + 1
    before = np.cumsum(lengths) - lengths
    out = np.full(int(lengths.sum()), 0x20, np.uint8)
    place = np.arange(len(out)) - np.repeat(before, lengths)
    inside = place < np.repeat(lengths - 1, lengths)
    out[inside] = data[(place + np.repeat(start, lengths))[inside]]
    return out[:-1].tobytes()


def deduplicated(docs: DataFrame, width: int = 35, anchor: int = 16, counters: int = 1 << 27, depth: int = 2) -> DataFrame:
    """doc_id, n_words, n_removed and kept (the words left, joined by blanks) of each row of `docs`."""
    bits = docs.sparkSession.sparkContext.broadcast(repeated_counters(docs, width, anchor, counters, depth))
    wrong = (
        wrong_starts(docs, bits, width, anchor, counters, depth)
        .groupBy(F.col("doc_id").alias("w_id"), F.col("text_key").alias("w_key")).agg(F.collect_set("start").alias("wrong"))
    )
    joined = keyed(docs).join(wrong, F.col("doc_id").eqNullSafe(F.col("w_id")) & (F.col("text_key") == F.col("w_key")), "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wrong_of = batch.column(2)
            rows = []
            for start, end, data, offsets in text_slices(batch.column(1)):
                windows = Windows(data, offsets, width, anchor)
                words, first = windows.words, windows.words.first
                repeated = np.zeros(len(words.start) + 1, bool)
                repeated[windows.start[estimated(windows.anchors, bits.value, counters, depth)]] = True
                for i in range(end - start):
                    if wrong_of[start + i].is_valid:
                        repeated[first[i] + wrong_of[start + i].values.to_numpy()] = False
                at = np.flatnonzero(repeated)
                edge = np.zeros(len(words.start) + 1, np.int64)
                np.add.at(edge, at, 1)
                np.add.at(edge, at + width, -1)
                keep = np.cumsum(edge)[:-1] <= 0
                for i in range(end - start):
                    own = keep[first[i]:first[i + 1]]
                    kept = joined_words(data, words.start[first[i]:first[i + 1]][own], words.end[first[i]:first[i + 1]][own])
                    rows.append((len(own), int(len(own) - own.sum()), kept))
            columns = list(zip(*rows)) or [()] * 3
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                pa.array(columns[2], pa.binary()).cast(pa.string()),
            ], ["doc_id", "n_words", "n_removed", "kept"])

    return joined.select("doc_id", "text", "wrong").mapInArrow(
        cut, "doc_id long, n_words long, n_removed long, kept string")

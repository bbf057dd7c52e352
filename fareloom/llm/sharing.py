"""Documents that share enough of their features with others, counted exactly however many features there are.

A sketch of a fixed size fills up as the data grows: then it takes every feature for shared. Here the features themselves
are dealt out by hash. Only those of one half of the hash space go (`counted`): a document that may have at most u features
which no other set has is ruled out by more than u such features in that half. This loses no document that can link,
whatever part of its features is counted.

Entries (feature, document) travel by ranges of the hash, as blocks of 32-bit keys and ids in byte planes, so that
they take about six bytes each. A feature that a task meets twice is shared for sure: its documents are summed up at once
and spread evenly, and only one key stands for it, so that a feature of very many documents fills no range.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.llm.frames import python_tasks, runs
from fareloom.llm.sketches import among
from fareloom.llm.words import mixed

ENTRIES = 1_500_000  # entries that a task sorts at once
RANGE = 1 << 20  # entries of a range of the hash, about
LEAST_RANGES = 256
BLOCKS = "part int, keys binary, docs binary, repeated binary, sure binary, times binary"


def _places(features: np.ndarray) -> np.ndarray:
    return mixed(features, 31)


def counted(features: np.ndarray) -> np.ndarray:
    """Which features are in the half that is counted."""
    return _places(features) & np.uint64(1) == 0


def ranges_of(entries: int) -> int:
    """Ranges of the hash (a power of 2) for so many entries."""
    return max(LEAST_RANGES, 1 << max(0, -(-entries // RANGE) - 1).bit_length())


def _planes(values: np.ndarray) -> bytes:
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def _values(blocks: list[bytes], kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.concatenate([np.zeros(0, kind), *[
        np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(width, -1).T).view(kind).ravel() for b in blocks if b]])


def _blocks(features: np.ndarray, docs: np.ndarray, ranges: int) -> pa.RecordBatch:
    """A row for each range: keys and documents of features met once, keys of the others, and a share of their documents."""
    bits = ranges.bit_length() - 1
    place = _places(features)
    order = np.argsort(place)
    place, docs = place[order], docs[order]
    new = np.ones(len(place), bool)
    new[1:] = place[1:] != place[:-1]
    single = new.copy()
    single[:-1] &= new[1:]
    keys = ((place << np.uint64(bits)) >> np.uint64(32)).astype("<u4")
    starts = np.arange(1, ranges, dtype=np.uint64) << np.uint64(64 - bits)
    edges = [0, *np.searchsorted(place, starts).tolist(), len(place)]
    sure, times = np.unique(docs[~single], return_counts=True)
    shares = [len(sure) * i // ranges for i in range(ranges + 1)]
    columns: list[list] = [[], [], [], [], []]
    for i in range(ranges):
        here = slice(edges[i], edges[i + 1])
        once, first = single[here], new[here] & ~single[here]
        share = slice(shares[i], shares[i + 1])
        for column, values in zip(columns, (keys[here][once], docs[here][once], keys[here][first], sure[share], times[share].astype("<u4"))):
            column.append(_planes(values))
    return pa.RecordBatch.from_arrays(
        [pa.array(np.arange(ranges, dtype=np.int32)), *[pa.array(c, pa.binary()) for c in columns]],
        ["part", "keys", "docs", "repeated", "sure", "times"])


def shared_counts(docs: DataFrame, heads: Broadcast, sets_of, ranges: int) -> DataFrame:
    """doc and how many of its counted features are in another row as well, for rows (doc_id, text) in `heads` that have any.

    `sets_of` gives (features, bounds, first text) of runs of a batch's texts. An id that comes twice counts twice.
    """
    python_tasks(docs.sparkSession)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for batch in batches:
            chosen = among(batch, 0, heads)
            ids = chosen.column(0).to_numpy()
            for features, bounds, start in sets_of(chosen):
                own = counted(features)
                owner = np.repeat(ids[start:start + len(bounds) - 1], np.diff(bounds))[own]
                held.append((features[own], owner.astype("<i8")))
                size += len(owner)
                if size >= ENTRIES:
                    yield _blocks(*(np.concatenate(c) for c in zip(*held)), ranges)
                    held, size = [], 0
        if size:
            yield _blocks(*(np.concatenate(c) for c in zip(*held)), ranges)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, ["part"]):
            blocks = {c: group.column(c).to_pylist() for c in ("keys", "docs", "repeated", "sure", "times")}
            keys, docs_of = _values(blocks["keys"], "<u4"), _values(blocks["docs"], "<i8")
            every = np.concatenate([keys, _values(blocks["repeated"], "<u4")])
            order = np.argsort(every)
            same = every[order][1:] == every[order][:-1]
            met = np.zeros(len(every), bool)
            met[order[1:]] = same
            met[order[:-1]] |= same
            found = docs_of[met[:len(keys)]]
            ids = np.concatenate([found, _values(blocks["sure"], "<i8")])
            times = np.concatenate([np.ones(len(found), np.int64), _values(blocks["times"], "<u4").astype(np.int64)])
            doc, at = np.unique(ids, return_inverse=True)
            yield pa.RecordBatch.from_arrays([pa.array(doc), pa.array(np.bincount(at, times, len(doc)).astype(np.int64))], ["doc", "shared"])

    dealt = docs.mapInArrow(deal, BLOCKS).repartition(F.col("part")).sortWithinPartitions("part")
    return dealt.mapInArrow(count, "doc long, shared long").groupBy("doc").agg(F.sum("shared").alias("shared"))

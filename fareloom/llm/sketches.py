"""Count-min sketches of 64-bit hashes: made per partition, merged by counter range, read as bits.

A sketch has `depth` rows of `counters` counters. Sums over hashed counters never underestimate, so that a bit that says
"fewer than `least`" is certain. Bits take depth x counters / 8 bytes, a size set by parameters and not by the data.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.llm.words import mixed

SEGMENT = 1 << 20  # counters of one merged range
SKETCH = "segment int, once binary, more binary"
_HELD = 8_000_000  # hashed places that a task sorts at once


def counter_places(hashes: np.ndarray, counters: int, depth: int) -> Iterator[np.ndarray]:
    for row in range(depth):
        yield (mixed(hashes, 100 + row) & np.uint64(counters - 1)).astype(np.int64) + row * counters


def partition_sketch(stream: Iterator[np.ndarray], counters: int, depth: int) -> Iterator[pa.RecordBatch]:
    """Rows of SKETCH over a partition's hashes: by range, the counters at 1 and those at 2 or more."""
    held: list[np.ndarray] = []
    size = 0

    def flush() -> pa.RecordBatch:
        places, counts = np.unique(np.concatenate(held), return_counts=True)
        held.clear()
        edges = np.searchsorted(places, np.arange(0, depth * counters + SEGMENT, SEGMENT))
        ranges = [(k, places[a:b] - k * SEGMENT, counts[a:b]) for k, (a, b) in enumerate(zip(edges, edges[1:])) if b > a]
        return pa.RecordBatch.from_arrays([
            pa.array([k for k, _, _ in ranges], pa.int32()),
            pa.array([p[c == 1].astype("<u4").tobytes() for _, p, c in ranges], pa.binary()),
            pa.array([p[c > 1].astype("<u4").tobytes() for _, p, c in ranges], pa.binary()),
        ], ["segment", "once", "more"])

    for hashes in stream:
        if len(hashes):
            held.extend(counter_places(hashes, counters, depth))
            size += depth * len(hashes)
        if size > _HELD:
            yield flush()
            size = 0
    if size:
        yield flush()


def merged_bits(parts: DataFrame, counters: int, depth: int, least: int) -> np.ndarray:
    """Packed bits of the counters whose sum over all partition sketches is at least `least` (1 or 2)."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, sums = -1, np.zeros(SEGMENT, np.uint8)

        def closed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([current], pa.int32()), pa.array([np.packbits(sums >= least).tobytes()], pa.binary())], ["segment", "bits"])

        for batch in batches:  # the rows stand in order of ranges
            for segment, once, more in zip(*(c.to_pylist() for c in batch.columns)):
                if segment != current:
                    if current >= 0:
                        yield closed()
                    current = segment
                    sums[:] = 0
                at = np.frombuffer(once, "<u4")
                sums[at] = np.minimum(sums[at] + 1, 2)
                sums[np.frombuffer(more, "<u4")] = 2
        if current >= 0:
            yield closed()

    merged = parts.repartition(F.col("segment")).sortWithinPartitions("segment").mapInArrow(merge, "segment int, bits binary")
    bits = np.zeros(depth * counters // 8, np.uint8)
    for row in merged.collect():  # depth x counters bits altogether
        bits[row.segment * SEGMENT // 8:(row.segment + 1) * SEGMENT // 8] = np.frombuffer(row.bits, np.uint8)
    return bits


def estimated(hashes: np.ndarray, bits: np.ndarray, counters: int, depth: int) -> np.ndarray:
    """Whether all counters of a hash have their bit set."""
    seen = np.ones(len(hashes), bool)
    for places in counter_places(hashes, counters, depth):
        seen &= (bits[places >> 3] >> (7 - (places & 7)).astype(np.uint8)) & 1 > 0
    return seen


def rows_of_ids(rows: DataFrame, ids: DataFrame, id_name: str, row_id: str | None = None, counters: int = 1 << 26) -> DataFrame:
    """The rows whose id is among `ids` (not null), and few others: a filter ahead of a join, so that it moves little.

    `id_name` is the column of `ids`, and of `rows` unless `row_id` names another.
    """
    return filtered(rows, id_filter(ids, id_name, counters), row_id or id_name, counters)


def _hashes_of_ids(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def id_filter(ids: DataFrame, id_name: str, counters: int = 1 << 26) -> Broadcast:
    """Bits of the ids of a column, for `among` inside a task."""
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from partition_sketch((_hashes_of_ids(batch.column(0)) for batch in batches), counters, 1)

    bits = merged_bits(ids.select(F.col(id_name).cast("long")).mapInArrow(sketch, SKETCH), counters, 1, 1)
    return ids.sparkSession.sparkContext.broadcast(bits)


def among(batch: pa.RecordBatch, place: int, shared: Broadcast, counters: int = 1 << 26) -> pa.RecordBatch:
    """The rows of a batch whose id (column `place`, not null) may be among those of the filter."""
    return batch.filter(pa.array(estimated(_hashes_of_ids(batch.column(place)), shared.value, counters, 1)))


def filtered(rows: DataFrame, shared: Broadcast, row_id: str, counters: int = 1 << 26) -> DataFrame:
    place = rows.columns.index(row_id)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield among(batch, place, shared, counters)

    return rows.where(F.col(row_id).isNotNull()).mapInArrow(keep, rows.schema)

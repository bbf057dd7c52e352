"""Near-duplicate vectors by a subspace pigeonhole join.

Unit vectors x and y have cosine c or more exactly if |x - y|^2 <= t = 2 - 2c. An orthogonal rotation (principal axes of a
bounded sample) keeps distances; the axes are dealt to `blocks` low-dimensional blocks, the widest first, so that every
block has wide leading axes. Each block gets a share of t in proportion to its variance. If all block distances exceeded
their shares, the sum would exceed t, so that a linked pair is within the share of some block.

Each block is range-joined: cells of two budget radii along its two leading axes hold their own vectors and those that
lie within one radius below them, so that two vectors within the radius meet in exactly one cell, the one with the
larger cell number along each axis. Within a cell, block distances pick candidates (in single precision with a margin)
and the full cosine in double precision verifies them. A pair is counted in the first block that has it within budget,
so it is counted once; tasks give out a number of links per vector and a forest of the links, never pairs.

A cell is cut by hash into parts of `part` rows and compared part by part, so that no task grows with a hot cell.

The work is exact whatever the data, and its saving depends on the data: if variance sinks along the axes, cells are many; if
all directions are alike, a block of few dimensions rules out little, and most pairs of a cell are looked at.

Defined results: vectors that cannot be compared (see vectors.usable) have no links and are their own component; equal
rows of one id are one vector; rows with a null id come out with null component and kept false; vectors of another
dimension than the most frequent one link with nothing; an empty table gives no rows. Columns other than the id and the
vector are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.llm.components import components
from fareloom.llm.frames import runs, python_tasks, stored
from fareloom.llm.partenum import Forest
from fareloom.llm.vectors import matrix, sample, usable

SAMPLE_ROWS = 5_000
TILE = 1_024
CANDIDATES = 65_536  # pairs verified at once


class Subspaces:
    """The rotation, its blocks of axes and their budgets."""

    def __init__(self, rows: np.ndarray, cosine: float, blocks: int):
        unit = rows / np.linalg.norm(rows, axis=1, keepdims=True)
        variance, axes = np.linalg.eigh(np.cov(unit.T) if len(unit) > 1 else np.eye(rows.shape[1]))
        order = np.argsort(-variance, kind="stable")
        variance, axes = np.maximum(variance[order], 1e-12), axes[:, order]
        blocks = min(blocks, rows.shape[1])
        self.members = [np.arange(b, rows.shape[1], blocks) for b in range(blocks)]
        self.rotation = axes
        share = np.array([variance[m].sum() for m in self.members])
        self.budget = (2 - 2 * cosine) * share / share.sum() * (1 + 1e-9) + 1e-12
        self.radius = np.sqrt(self.budget)

    def cells(self, unit: np.ndarray) -> tuple[np.ndarray, ...]:
        """Row, block, home cell and cell (two numbers each) of every placing of the rows."""
        rotated = unit @ self.rotation
        parts = []
        for b, own in enumerate(self.members):
            width = 2 * self.radius[b]
            axes = [rotated[:, own[a]] if a < len(own) else np.zeros(len(unit)) for a in (0, 1)]
            home = np.stack([np.floor(x / width) for x in axes], axis=1).astype(np.int64)
            # a little more than the radius: products of other shapes may differ in the last bits
            edge = np.stack([(np.floor(x / width) + 1) * width - x <= 1.001 * self.radius[b] for x in axes], axis=1)
            for step in ((0, 0), (1, 0), (0, 1), (1, 1)):
                rows = np.flatnonzero((edge | (np.array(step) == 0)).all(axis=1))
                parts.append((rows, np.full(len(rows), b), home[rows], home[rows] + step))
        return tuple(np.concatenate(c) for c in zip(*parts))


CELL = "struct<block:int,home_1:long,home_2:long,cell_1:long,cell_2:long>"


def routed(numbers: DataFrame, spaces: Subspaces) -> DataFrame:
    """node, vector (of length 1) and its cells."""
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = matrix(batch.column(1))
            unit = values / np.sqrt((values * values).sum(axis=1))[:, None]
            rows, block, home, cell = spaces.cells(unit)
            order = np.argsort(rows, kind="stable")
            bounds = pa.array(np.searchsorted(rows[order], np.arange(len(unit) + 1)).astype(np.int32))
            entries = pa.StructArray.from_arrays(
                [pa.array(block[order].astype(np.int32)), *(pa.array(c[order]) for c in (home[:, 0], home[:, 1], cell[:, 0], cell[:, 1]))],
                names=["block", "home_1", "home_2", "cell_1", "cell_2"])
            vectors = pa.ListArray.from_arrays(pa.array(np.arange(len(unit) + 1, dtype=np.int32) * unit.shape[1]), pa.array(unit.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), vectors, pa.ListArray.from_arrays(bounds, entries)], ["node", "vector", "cells"])

    return numbers.select("node", "vector").mapInArrow(place, f"node long, vector array<double>, cells array<{CELL}>")


def compared(group: pa.Table, spaces: Subspaces, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nodes with links in a group, their number of links counted here, and the least node each is connected with here."""
    node, part = group.column("node").to_numpy(), group.column("part").to_numpy()
    block, low, high = (group.column(c)[0].as_py() for c in ("block", "low", "high"))
    cell = np.array([group.column("cell_1")[0].as_py(), group.column("cell_2")[0].as_py()])
    home = np.stack([group.column("home_1").to_numpy(), group.column("home_2").to_numpy()], axis=1)
    unit = matrix(group.column("vector"))
    rotated = unit @ spaces.rotation
    own = rotated[:, spaces.members[block]]
    square, one = (own * own).sum(axis=1, keepdims=True), np.ones((len(own), 1))
    # squared distances as one product: (a, |a|^2, 1) (-2 b, 1, |b|^2)
    rows_of, columns_of = (np.hstack(c).astype(np.float32) for c in ((own, square, one), (-2 * own, one, square)))
    limit = np.float32(spaces.budget[block] + 1e-5)
    left, right = np.flatnonzero(part == low), np.flatnonzero(part == high)
    count = np.zeros(len(node), np.int64)
    forest = Forest(len(node))
    order = np.argsort(node, kind="stable")
    place = np.empty(len(node), np.int64)
    place[order] = np.arange(len(node))
    known = np.arange(len(node))  # a row that each row is known to be connected with
    for at in range(0, len(left), TILE):
        rows = left[at:at + TILE]
        for across in range(at if low == high else 0, len(right), 8 * TILE):
            columns = right[across:across + 8 * TILE]
            near = np.flatnonzero((rows_of[rows] @ columns_of[columns].T).ravel() <= limit)
            for begin in range(0, len(near), CANDIDATES):  # in a dense cell all pairs are candidates
                i, j = np.divmod(near[begin:begin + CANDIDATES], len(columns))
                i, j = rows[i], columns[j]
                keep = node[i] != node[j]
                if low == high:
                    keep &= i < j
                keep &= (np.maximum(home[i], home[j]) == cell).all(axis=1)
                i, j = i[keep], j[keep]
                if not len(i):
                    continue
                keep = np.einsum("ij,ij->i", unit[i], unit[j]) >= cosine
                i, j = i[keep], j[keep]
                apart = (rotated[i] - rotated[j]) ** 2
                first = np.ones(len(i), bool)
                for b in range(block):
                    first &= apart[:, spaces.members[b]].sum(axis=1) > spaces.budget[b]
                first &= apart[:, spaces.members[block]].sum(axis=1) <= spaces.budget[block]
                i, j = i[first], j[first]
                if not len(i):
                    continue
                count += np.bincount(i, minlength=len(node)) + np.bincount(j, minlength=len(node))
                edges = np.flatnonzero(np.append(True, i[1:] != i[:-1]))
                for a, others in zip(i[edges], np.split(j, edges[1:])):
                    for label in np.unique(known[others]):  # one link to each part known so far connects them all
                        forest.join(int(place[a]), int(place[label]))
                    known[others] = known[a] = order[forest.root(int(place[a]))]
    linked = np.flatnonzero(count)
    return node[linked], count[linked], node[order[[forest.root(int(place[x])) for x in linked]]] if len(linked) else node[linked]


def near_duplicates(vectors: DataFrame, cosine: float = 0.95, blocks: int = 4, part: int = 16_384) -> DataFrame:
    """vec_id, n_links, component_id and kept of each row of `vectors`."""
    python_tasks(vectors.sparkSession, 4096)
    numbers = stored(usable(vectors), "vector-dedup-rows")
    rows = sample(numbers, SAMPLE_ROWS)
    if not len(rows):
        return _result(vectors, None, None)
    spaces = Subspaces(rows, cosine, blocks)
    placings = stored(routed(numbers, spaces), "vector-dedup-cells")
    cells = placings.withColumn("cell", F.explode("cells")).select("node", "vector", "cell.*")
    keys = ["block", "cell_1", "cell_2"]
    sized = stored(cells.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / part).cast("int").alias("parts")), "vector-dedup-sizes")
    placed = (
        cells.join(sized, keys).withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select(*keys, F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "part", "home_1", "home_2", "node", "vector")
    )
    task = [*keys, "low", "high"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, task):
            found = compared(group, spaces, cosine)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], ["node", "n", "root"])

    found = stored(
        placed.repartition(*[F.col(c) for c in task]).sortWithinPartitions(*task).mapInArrow(compare, "node long, n long, root long"), "vector-dedup-links")
    counts = found.groupBy("node").agg(F.sum("n").alias("n_links"))
    return _result(vectors, counts, components(found, "node", "root", "vector-dedup-components"))


def _result(vectors: DataFrame, counts: DataFrame | None, joined: DataFrame | None) -> DataFrame:
    out = vectors.select("vec_id")
    if counts is None or joined is None:
        out = out.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    else:
        found = counts.join(joined, "node", "full").withColumnRenamed("node", "vec_id")
        out = out.join(found, "vec_id", "left").select(
            "vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))

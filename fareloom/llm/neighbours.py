"""Approximate nearest neighbours by multi-index hashing.

1. A rotation is learned on a bounded sample (principal axes, then iterative quantization): the signs of the rotated,
   centred vector are its binary code.
2. Codes are split into substrings, and each substring of all codes is indexed. If two codes differ in at most
   R = m a + b bits (b < m), then one of the first b + 1 substrings differs in at most a bits or one of the others in at most
   a - 1, so that probing these buckets finds every code within the Hamming radius.
3. Codes within the radius are ranked by their exact distance in double precision.
4. Queries that got fewer than k rows from all blocks lie where codes are sparse: one radius for all is too small there. They
   probe the same buckets again with a radius that doubles until the k found are certain, or until it covers the code. They are
   certain when no code outside the radius can be nearer: a code that differs in more than r bits crosses more than r of
   the planes, so its vector is at least as far as the r + 1 smallest distances of the query from the planes add up to.

The radius is learned too: 64 vectors, equally spaced in the sample by id, are searched exactly, and the radius is the `reach`
quantile of the Hamming distances to their true neighbours. Where vectors have structure this is small and few buckets are probed; where all
directions are alike, true neighbours are hardly nearer than the rest, and a large part of the codes must be looked at.

Queries and candidates are dealt into blocks; each task indexes one block of candidates and searches one block of
queries in it, and gives out the best of each query. Every row is indexed. Blocks have a bounded number of rows.

Defined results: vectors that cannot be compared (see vectors.usable) take no part; equal rows of one id are one
candidate; ties go to the smaller id; every query gets k rows, or all its candidates if there are fewer; an empty table gives
no rows. Columns other than the id and the vector are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fareloom.llm.frames import runs, python_tasks, stored
from fareloom.llm.vectors import matrix, sample, usable

SAMPLE_ROWS = 5_000
CALIBRATION_ROWS = 64
SUBSTRING_BITS = 16
_ONES = np.array([bin(i).count("1") for i in range(1 << SUBSTRING_BITS)], dtype=np.uint8)


@dataclass
class Codes:
    """Centre and rotation of the codes."""

    centre: np.ndarray
    rotation: np.ndarray

    def turned(self, rows: np.ndarray) -> np.ndarray:
        """Signed distances from the planes, one per bit."""
        return (rows - self.centre) @ self.rotation

    def of(self, rows: np.ndarray) -> np.ndarray:
        """Substrings of the codes, one row per vector."""
        bits = self.turned(rows) > 0
        width = -(-bits.shape[1] // SUBSTRING_BITS) * SUBSTRING_BITS
        bits = np.pad(bits, ((0, 0), (0, width - bits.shape[1])))
        return np.packbits(bits, axis=1).view(">u2").astype(np.uint16)


def learned_codes(rows: np.ndarray, bits: int, rounds: int = 30) -> Codes:
    """Iterative quantization: turn the principal axes so that the signs lose least."""
    centre = rows.mean(axis=0)
    _, _, axes = np.linalg.svd(rows - centre, full_matrices=False)
    axes = axes[:bits].T
    flat = (rows - centre) @ axes
    turn = np.linalg.qr(np.random.default_rng(7).standard_normal((axes.shape[1], axes.shape[1])))[0]
    for _ in range(rounds):
        u, _, v = np.linalg.svd(flat.T @ np.where(flat @ turn > 0, 1.0, -1.0))
        turn = u @ v
    return Codes(centre, axes @ turn)


def hamming(code: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return _ONES[code[None, :] ^ codes].sum(axis=1, dtype=np.int64)


class SubstringIndex:
    """Buckets of each substring over a block of codes."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.buckets = []
        for j in range(codes.shape[1]):
            order = np.argsort(codes[:, j], kind="stable")
            values, begin = np.unique(codes[order, j], return_index=True)
            self.buckets.append((values, begin, np.append(begin[1:], len(order)), order))

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """All rows whose code is within the radius: pigeonhole probes, then the whole code."""
        pieces = self.codes.shape[1]
        seen = np.zeros(len(self.codes), bool)
        for j, (values, begin, end, order) in enumerate(self.buckets):
            reach = radius // pieces if j <= radius % pieces else radius // pieces - 1
            hit = np.flatnonzero(_ONES[values ^ code[j]] <= reach) if reach >= 0 else []
            for a, b in zip(begin[hit], end[hit]) if len(hit) < 64 else ():
                seen[order[a:b]] = True
            if len(hit) >= 64:
                member = np.zeros(len(values), bool)
                member[hit] = True
                seen[order[np.repeat(member, end - begin)]] = True
        rows = np.flatnonzero(seen)
        return rows[hamming(code, self.codes[rows]) <= radius]


def nearest(query: np.ndarray, rows: np.ndarray, nodes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and distances of the k nearest rows, ties to the smaller id."""
    distance = np.sqrt(((rows - query) ** 2).sum(axis=1))
    if len(distance) > 4 * k:
        some = np.flatnonzero(distance <= np.partition(distance, k - 1)[k - 1])
        distance, nodes = distance[some], nodes[some]
    best = np.lexsort((nodes, distance))[:k]
    return nodes[best], distance[best]


def beyond(turned: np.ndarray) -> np.ndarray:
    """Entry r: the least squared distance to a vector whose code differs in more than r bits; infinite if none can."""
    return np.append(np.cumsum(np.sort(turned ** 2)), np.inf)


def certain(query: np.ndarray, own: int, code: np.ndarray, least: np.ndarray, index: SubstringIndex, rows: np.ndarray,
            nodes: np.ndarray, k: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """The k nearest rows of an indexed block but the query's own, by a growing radius; all rows if there are fewer."""
    while True:
        near = index.within(code, radius)
        near = near[nodes[near] != own]
        ids, distance = nearest(query, rows[near], nodes[near], k)
        # The margin covers rounding in the rotation: a row that only ties must not be missed.
        if radius >= len(least) - 1 or (len(ids) == k and distance[-1] ** 2 * (1 + 1e-9) + 1e-12 < least[radius]):
            return ids, distance
        radius = min(max(2 * radius, radius + code.shape[0]), len(least) - 1)


def learned_radius(numbers: DataFrame, codes: Codes, rows: np.ndarray, k: int, reach: float) -> int:
    """The Hamming radius that holds the share `reach` of the true neighbours of a few vectors, searched exactly."""
    probes = rows[np.linspace(0, len(rows) - 1, min(CALIBRATION_ROWS, len(rows))).astype(int)]
    probe_codes = codes.of(probes)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple[float, int]]] = {i: [] for i in range(len(probes))}
        for batch in batches:
            block = matrix(batch.column(0))
            own = codes.of(block)
            for i, probe in enumerate(probes):
                square = ((block - probe) ** 2).sum(axis=1)
                some = np.argsort(square, kind="stable")[:k + 1]
                best[i] = sorted(best[i] + list(zip(square[some].tolist(), hamming(probe_codes[i], own[some]).tolist())))[:k + 1]
        found = [(i, d, h) for i, rows in best.items() for d, h in rows]
        yield pa.RecordBatch.from_arrays(
            [pa.array([f[0] for f in found], pa.int32()), pa.array([f[1] for f in found], pa.float64()), pa.array([f[2] for f in found], pa.int32())],
            ["probe", "square", "differ"])

    order = Window.partitionBy("probe").orderBy("square", "differ")
    best = numbers.select("vector").mapInArrow(search, "probe int, square double, differ int") \
        .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k + 1).select("differ", "rank").collect()
    differ = np.array([r.differ for r in best if r["rank"] > 1])  # the first is the vector itself
    return int(np.ceil(np.quantile(differ, reach))) if len(differ) else 64


def search(vectors: DataFrame, every: int = 100, k: int = 10, bits: int = 64, reach: float = 0.985,
           query_block: int = 2_048, candidate_block: int = 32_768) -> DataFrame:
    """query_id, rank, vec_id and score: the k nearest found of every row whose id is divisible by `every`."""
    spark = vectors.sparkSession
    python_tasks(spark, 4096)
    numbers = stored(usable(vectors), "neighbour-rows")
    rows = sample(numbers, SAMPLE_ROWS)
    shape = "query_id long, vec_id long, score double"
    if not len(rows):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    codes = learned_codes(rows, bits)
    radius = learned_radius(numbers, codes, rows, k, reach)
    is_query = F.pmod("node", F.lit(every)) == 0
    queries = numbers.where(is_query)
    total = numbers.agg(F.count(F.lit(1)).alias("n"), F.count_if(is_query).alias("q")).first()
    blocks = max(1, -(-total.n // candidate_block))
    deal = lambda n, salt: F.pmod(F.xxhash64("node", F.lit(salt)), F.lit(n)).cast("int")
    keys = ["asked", "block"]

    def found(some: DataFrame, count: int, growing: bool) -> DataFrame:
        """The k best of each of `count` queries, among codes within the learned radius or a growing one."""
        query_blocks = max(1, -(-count // query_block))
        asked = some.select(
            deal(query_blocks, 1).alias("asked"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(True).alias("query"), "node", "vector")
        held = numbers.select(
            F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("asked"), deal(blocks, 2).alias("block"), F.lit(False).alias("query"), "node", "vector")

        def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for group in runs(batches, keys):
                query = group.column("query").to_numpy().astype(bool)
                node, values = group.column("node").to_numpy(), matrix(group.column("vector"))
                candidates, candidate_nodes = values[~query], node[~query]
                if not len(candidates) or not query.any():
                    continue
                index = SubstringIndex(codes.of(candidates))
                turned, asked_codes = codes.turned(values[query]), codes.of(values[query])
                out: list[tuple[np.ndarray, ...]] = []
                for own, vector, code, line in zip(node[query], values[query], asked_codes, turned):
                    if growing:
                        ids, distance = certain(vector, own, code, beyond(line), index, candidates, candidate_nodes, k, radius)
                    else:
                        near = index.within(code, radius)
                        near = near[candidate_nodes[near] != own]
                        ids, distance = nearest(vector, candidates[near], candidate_nodes[near], k)
                    out.append((np.full(len(ids), own), ids, distance))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], ["query_id", "vec_id", "score"])

        rows = asked.unionByName(held).repartition(*[F.col(c) for c in keys]).sortWithinPartitions(*keys).mapInArrow(answer, shape)
        order = Window.partitionBy("query_id").orderBy("score", "vec_id")
        return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

    first = stored(found(queries, total.q, False), "neighbour-first")
    full = first.where(F.col("rank") == k).select("query_id")
    short = stored(queries.join(full, queries["node"] == full["query_id"], "left_anti"), "neighbour-short")
    left = short.count()
    if not left:
        return first
    return first.join(full, "query_id", "left_semi").select(first.columns).unionByName(found(short, left, True))

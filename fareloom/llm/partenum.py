"""N-gram Jaccard join by PartEnum signatures, down to components of linked documents.

A document's set holds the hashes of its word shingles. Two sets of similarity 0.9 or more have similar sizes and differ
in few features; PartEnum turns the second into equality:

* Sizes fall into bands. A set signs for its own band and, if a set that it can link with may be in the next larger
  one, for that too, so two sets that can link always sign for one band together.
* Two linked sets of a band with largest size r differ in at most k = 2 r (1 - s) / (1 + s) features. The feature domain
  is hashed into n1 = (k + 1) / (slack + 1) first-level parts of n2 = slack + 2 second-level parts each. Some first-level part
  has at most `slack` differences, so that at least n2 - slack of its second-level parts have none: for every subset
  of n2 - slack parts, one signature is the hash of the features in them. Linked sets share at least one signature.
* A subset without features makes a signature that sets without likeness share. With m spare first-level parts linked
  sets agree in m + 1 of them, so that a set with at most m parts that have an empty subset leaves its empty signatures
  out: in one of the m + 1 no subset is empty, and the other set signs it too. A set with more of them signs again under
  another partition of the domain, and under the last one with all signatures. Two linked sets that both go on meet in
  the next partition, so no link is lost.
* Ahead of all this, a count-min sketch of all features tells which are in one set only. Of a set that links with another
  one, at least the wanted percentage of features are in that other one; sets with fewer shared features do not sign. The
  sketch overestimates, so that this loses nothing either. Where there are more features than the sketch can tell apart, they
  are counted exactly first (`sharing`), and only sets that this leaves go into the sketch.

One document of each group of equal sets signs, and only documents that share a signature go on. Each signature with two or more documents hangs its documents under the
least one (no pairs within a group), and the components of these edges are clusters. A line that very many documents have
makes a signature of its own in some of them and so joins sets without likeness into a cluster that grows with the data. Linked
sets share a signature under every partition of the domain: clusters of several blocks are therefore signed again under
further partitions, each cluster for itself, which takes such sets apart. Within a cluster exact set sizes
decide: every member is first compared with the members of its block, which also holds the cluster's least member.
Members of a cluster of several blocks that this does not connect to the least member are compared with all blocks, so
that no link between separate parts is missed. A group of copies is one member.

Defined results: a text without words (or null) has the empty set, links with nothing and is its own component, also
when repeated; a text with fewer words than a shingle has its word sequence as one feature; rows of the same id are one
document, linked with whatever one of them links with; rows with a null id come out with component null; an empty table
gives no rows. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fareloom.llm import sharing
from fareloom.llm.components import components
from fareloom.llm.frames import gathered, python_tasks, runs, stored, text_column
from fareloom.llm.sketches import SKETCH, among, estimated, id_filter, merged_bits, partition_sketch, rows_of_ids
from fareloom.llm.words import hash_windows, hash_words, mixed, split_words, text_slices

ATTEMPTS = 3  # partitions of the domain that a set with too many empty signatures tries
TURNS = 4  # times that large clusters are signed again, each time under partitions of their own
FLUSH = 1_000_000  # signatures that a task combines at once
SLICE = 1 << 20  # bytes of text hashed at once: hashing takes some forty times as much
GATHERED = 2 << 20  # bytes of text that stand ready for it
BLOCK = 256  # members of a cluster that one task compares with another such block


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one after another, and the bounds of each text's part."""
    words = split_words(data, offsets)
    hashes = hash_words(data, words, lower=True)
    count = words.count
    own = np.maximum(count - size + 1, 0)
    text = np.repeat(np.arange(len(count)), own)
    start = np.arange(len(text)) - (np.cumsum(own) - own)[text] + words.first[:-1][text]
    features = hash_windows(hashes, size, 7)[start] if len(start) else np.zeros(0, np.uint64)
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):
        whole = np.array([hash_windows(hashes[words.first[i]:words.first[i + 1]], int(count[i]), 7)[0] for i in short], np.uint64)
        text, features = np.concatenate([text, short]), np.concatenate([features, mixed(whole, 8)])
    order = np.lexsort((features, text))
    text, features = text[order], features[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (features[1:] != features[:-1])
    text, features = text[new], features[new]
    return features, np.searchsorted(text, np.arange(len(count) + 1))


def set_hashes(features: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each set, independent of order."""
    out = []
    for salt in (21, 22):
        sums = np.append(np.zeros(1, np.uint64), np.cumsum(mixed(features, salt), dtype=np.uint64))
        with np.errstate(over="ignore"):
            out.append(mixed(sums[bounds[1:]] - sums[bounds[:-1]] + np.diff(bounds).astype(np.uint64), salt).view(np.int64))
    return out[0], out[1]


class Bands:
    """Size bands and the parts of their feature domain; all of it follows from the parameters."""

    def __init__(self, percent: int, slack: int, ratio: int):
        if ratio * percent < 10_000:
            raise ValueError("a set can link beyond the next band")
        self.percent, self.slack, self.ratio = percent, slack, ratio
        self.last = np.zeros(1, np.int64)  # largest size of each band; band 0 is the empty set

    def of(self, sizes: np.ndarray) -> np.ndarray:
        while self.last[-1] < (sizes.max() if len(sizes) else 0):
            self._widen()
        return np.searchsorted(self.last, sizes)

    def _widen(self) -> None:
        low = int(self.last[-1]) + 1
        self.last = np.append(self.last, low * self.ratio // 100)

    def parts(self, bands: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First-level parts of each band and how many of them are spare, to make up for those with an empty subset.

        No parts where linked sets cannot differ, so that only copies link.
        """
        while len(self.last) <= (bands.max() if len(bands) else 0):
            self._widen()
        differ = 2 * self.last[bands] * (100 - self.percent) // (100 + self.percent)
        needed = np.where(differ > 0, differ // (self.slack + 1) + 1, 0)
        load = self.last[bands] / 1.5 * 2.0 / (self.slack + 2) / np.maximum(needed, 1)  # features of a smaller set's subset
        empty = np.minimum(math.comb(self.slack + 2, 2) * np.exp(-load), 0.3)
        spare = np.floor(2 * empty * needed + 0.9).astype(np.int64)
        return needed + spare, spare

    def signed(self, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(set, band) pairs to sign."""
        own = self.of(sizes)
        upper = self.of(sizes * 100 // self.percent)
        some, over = np.flatnonzero(sizes > 0), np.flatnonzero(upper > own)
        return np.concatenate([some, over]), np.concatenate([own[some], own[over] + 1])


def signatures(features: np.ndarray, bounds: np.ndarray, bands: Bands, turn: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """All signatures of many sets, and the set of each; every turn (up to TURNS) has other partitions of the domain."""
    which, band = bands.signed(np.diff(bounds))
    first, spare = bands.parts(band)
    out, owner = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    going = np.flatnonzero(first > 0)
    for attempt in range(ATTEMPTS * turn, ATTEMPTS * (turn + 1)):
        if not len(going):
            break
        values, pair, empty, begin = _signed_once(features, bounds, which[going], band[going], first[going], bands.slack + 2, attempt)
        short = np.add.reduceat(empty.any(axis=1).astype(np.int64), begin) > spare[going]
        kept = ~empty | (short[pair][:, None] if attempt == ATTEMPTS * (turn + 1) - 1 else False)
        out.append(values[kept])
        owner.append(np.repeat(which[going][pair], kept.sum(axis=1)))
        going = going[short]
    return np.concatenate(out), np.concatenate(owner)


def _signed_once(features: np.ndarray, bounds: np.ndarray, which: np.ndarray, band: np.ndarray, first: np.ndarray,
                 second: int, attempt: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """By first-level part (rows): signatures of its subsets, its signing pair, which subsets are empty; each pair's first row."""
    size = np.diff(bounds)[which]
    row = np.repeat(np.arange(len(which)), size)  # signing pair of each feature
    feature = features[np.arange(len(row)) - (np.cumsum(size) - size)[row] + bounds[:-1][which][row]]
    base = np.cumsum(first * second) - first * second
    part = (mixed(feature, 11 + 100 * attempt) % (first * second).astype(np.uint64)[row]).astype(np.int64) + base[row]
    total = int((first * second).sum())
    sums = np.zeros(total, np.uint64)
    np.add.at(sums, part, mixed(feature, 14))
    sums, filled = sums.reshape(-1, second), np.bincount(part, minlength=total).reshape(-1, second)
    pair = np.repeat(np.arange(len(which)), first)
    begin = np.cumsum(first) - first
    level = np.arange(len(pair)) - begin[pair]
    values, empty = [], []
    with np.errstate(over="ignore"):
        for i, (a, b) in enumerate(combinations(range(second), 2)):
            key = (level.astype(np.uint64) << np.uint64(24)) + (band[pair].astype(np.uint64) << np.uint64(8)) + np.uint64(i + 16 * attempt)
            values.append(mixed(mixed(sums[:, a] + sums[:, b], 15) + mixed(key, 16), 17))
            empty.append(filled[:, a] + filled[:, b] == 0)
    return np.stack(values, axis=1), pair, np.stack(empty, axis=1), begin


def hashed_sets(docs: DataFrame, shingle: int) -> DataFrame:
    """doc_id, n_shingles, how many of them are `sharing.counted`, and the set hashes h1 and h2 of each row."""
    python_tasks(docs.sparkSession)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end, data, offsets in text_slices(batch.column(1), SLICE):
                features, bounds = shingle_sets(data, offsets, shingle)
                h1, h2 = set_hashes(features, bounds)
                n_counted = np.diff(np.append(0, np.cumsum(sharing.counted(features)))[bounds])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, end - start), pa.array(np.diff(bounds)), pa.array(n_counted), pa.array(h1), pa.array(h2)],
                    ["doc_id", "n_shingles", "n_counted", "h1", "h2"])

    return docs.select("doc_id", text_column().alias("text")).mapInArrow(
        measure, "doc_id long, n_shingles long, n_counted long, h1 long, h2 long")


def sharing_heads(docs: DataFrame, heads: Broadcast, classes: DataFrame, shingle: int, percent: int) -> DataFrame:
    """node of each class that, by an exact count, may have enough features in other sets to link with one."""
    def sets_of(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        for start, _, data, offsets in text_slices(batch.column(1), SLICE):
            yield *shingle_sets(data, offsets, shingle), start

    entries = classes.agg(F.sum("n_counted")).first()[0] or 0
    found = sharing.shared_counts(docs, heads, sets_of, sharing.ranges_of(entries))
    seen = F.col("n_shingles") - F.col("n_counted") + F.coalesce("shared", F.lit(0))
    return classes.join(found, classes["node"] == found["doc"], "left").where(100 * seen >= percent * F.col("n_shingles")).select("node")


def shared_counters(docs: DataFrame, heads: Broadcast, shingle: int, counters: int) -> np.ndarray:
    """Bits of a count-min sketch of all features of the documents (doc_id, text) in `heads`: which counters reached 2."""
    python_tasks(docs.sparkSession)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen = (among(batch, 0, heads) for batch in batches)
        features = (shingle_sets(data, offsets, shingle)[0] for batch in gathered(chosen, GATHERED)
                    for _, _, data, offsets in text_slices(batch.column(1), SLICE))
        yield from partition_sketch(features, counters, 1)

    return merged_bits(docs.mapInArrow(sketch, SKETCH), counters, 1, 2)


def sharing_sets(features: np.ndarray, bounds: np.ndarray, bits: np.ndarray, counters: int, percent: int) -> np.ndarray:
    """The sets of which so many features are estimated to be in another set that they can link with one."""
    size = np.diff(bounds)
    seen = np.append(0, np.cumsum(estimated(features, bits, counters, 1)))
    return np.flatnonzero((size > 0) & (100 * (seen[bounds[1:]] - seen[bounds[:-1]]) >= percent * size))


def signature_rows(docs: DataFrame, heads: Broadcast, bits: Broadcast, counters: int, shingle: int, percent: int, slack: int,
                   ratio: int, turn: int = 0) -> DataFrame:
    """signature and doc of each row in `heads` that may link with another; a signature that a task has met before comes with `low`, the least doc it saw.

    So a signature has, beside rows that already name a partner, at most one row for every FLUSH signatures of a task,
    however many documents share it. Documents with a third column, their cluster, share none across clusters.
    """
    python_tasks(docs.sparkSession)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(percent, slack, ratio)
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def combined() -> pa.RecordBatch:
            values, docs_of = (np.concatenate(c) for c in zip(*held))
            held.clear()
            order = np.lexsort((docs_of, values))
            values, docs_of = values[order], docs_of[order]
            new = np.ones(len(values), bool)
            new[1:] = values[1:] != values[:-1]
            low = docs_of[np.flatnonzero(new)][np.cumsum(new) - 1]
            keep = new | (docs_of != low)
            return pa.RecordBatch.from_arrays([
                pa.array(values[keep].view(np.int64)), pa.array(docs_of[keep]), pa.array(low[keep], mask=new[keep])], ["signature", "doc", "low"])

        size = 0
        for batch in gathered((among(batch, 0, heads) for batch in batches), GATHERED):
            ids = batch.column(0).to_numpy()
            for start, _, data, offsets in text_slices(batch.column(1), SLICE):
                features, bounds = shingle_sets(data, offsets, shingle)
                able = sharing_sets(features, bounds, bits.value, counters, percent)
                size_of = np.diff(bounds)
                chosen = np.zeros(len(size_of), bool)
                chosen[able] = True
                values, owner = signatures(features[np.repeat(chosen, size_of)], np.append(0, np.cumsum(size_of[able])), bands, turn)
                if batch.num_columns > 2:
                    cluster = batch.column(2).to_numpy()[start + able[owner]].view(np.uint64)
                    with np.errstate(over="ignore"):
                        values = mixed(values + mixed(cluster, 18), 19)
                if len(values):
                    held.append((values, ids[start + able[owner]]))
                    size += len(values)
                if size >= FLUSH:
                    yield combined()
                    size = 0
        if held:
            yield combined()

    return docs.mapInArrow(sign, "signature long, doc long, low long")


def star_edges(signed: DataFrame) -> DataFrame:
    """low and doc_id: each document of a signature under the least one, and under those that its task has met."""
    least = F.min("doc").over(Window.partitionBy("signature"))
    return (
        signed.withColumn("least", least).where("low IS NOT NULL OR doc > least")
        .select(F.coalesce("low", "least").alias("low"), F.col("doc").alias("doc_id")).distinct()
    )


def split_clusters(clusters: DataFrame, texts: DataFrame, bits: Broadcast, counters: int, shingle: int, percent: int, slack: int,
                   ratio: int, block: int) -> DataFrame:
    """The clusters, those of more than `block` members taken apart by further partitions of the domain.

    Members that meet no other one any more link with nothing and go. It ends when no such cluster is left, or when a turn
    leaves more than nine tenths of their members in such clusters.
    """
    def large(now: DataFrame) -> DataFrame:
        over = now.groupBy("component").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block).select("component")
        return stored(now.join(over, "component").select("node", "component"), "partenum-large")

    inside = large(clusters)
    count = inside.count()
    rows = None
    for turn in range(1, TURNS + 1):
        if not count:
            break
        if rows is None:  # the members of later turns are among these
            rows = stored(rows_of_ids(texts, inside, "node", "doc_id").join(inside.select(F.col("node").alias("doc_id")), "doc_id", "left_semi"),
                          "partenum-texts")
        given = rows.join(inside.select(F.col("node").alias("doc_id"), "component"), "doc_id").select("doc_id", "text", "component")
        signed = signature_rows(given, id_filter(inside, "node"), bits, counters, shingle, percent, slack, ratio, turn)
        parts = components(star_edges(signed), "low", "doc_id", "partenum-parts")
        clusters = stored(clusters.join(inside.select("component").distinct(), "component", "left_anti").select("node", "component")
                          .unionByName(parts.select("node", "component")), "partenum-split")
        inside, before = large(clusters), count
        count = inside.count()
        if 10 * count > 9 * before:
            break
    return clusters


class Forest:
    """Union of nodes under their least one."""

    def __init__(self, count: int):
        self.parent = list(range(count))

    def root(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)


def linked_sets(features: np.ndarray, bounds: np.ndarray, percent: int, left: np.ndarray, forest: Forest) -> None:
    """Joins every two sets with 100 |A and B| >= percent |A or B| of which one is in `left`."""
    size = np.diff(bounds)
    owner = np.repeat(np.arange(len(size)), size)
    order = np.argsort(features, kind="stable")
    ordered, holders = features[order], owner[order]
    begin = np.searchsorted(ordered, features, side="left")
    length = np.searchsorted(ordered, features, side="right") - begin
    for i in left:
        a, b = bounds[i], bounds[i + 1]
        if a == b:
            continue
        run = length[a:b]
        at = np.arange(int(run.sum())) + np.repeat(begin[a:b] - (np.cumsum(run) - run), run)
        common = np.bincount(holders[at], minlength=len(size))
        for j in np.flatnonzero(100 * common >= percent * (size[i] + size - common)):
            forest.join(int(i), int(j))


def verified(placed: DataFrame, docs: DataFrame, keys: list[str], shingle: int, percent: int) -> DataFrame:
    """node and root of each member, where root is the least member of its group that it is connected with there.

    `placed` has the keys of the group, node, h1 (its set) and `first` (compared with all of its group).
    """
    python_tasks(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("node"), text_column().alias("text"))
    rows = placed.join(rows_of_ids(texts, placed.select("node").distinct(), "node"), "node").repartition(*[F.col(k) for k in keys]).sortWithinPartitions(*keys)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, keys):
            group = group.combine_chunks()
            found: dict[int, tuple[np.ndarray, bool]] = {}
            nodes, hashes, firsts = (group.column(c).to_pylist() for c in ("node", "h1", "first"))
            for start, _, data, offsets in text_slices(group.column("text").chunk(0), SLICE):
                features, bounds = shingle_sets(data, offsets, shingle)
                h1, _ = set_hashes(features, bounds)
                for i in range(len(bounds) - 1):
                    if h1[i] == hashes[start + i]:
                        own = features[bounds[i]:bounds[i + 1]]
                        known = found.get((nodes[start + i], hashes[start + i]))
                        found[nodes[start + i], hashes[start + i]] = (own, firsts[start + i] or bool(known and known[1]))
            members = sorted(found)
            features = np.concatenate([found[m][0] for m in members])
            bounds = np.append(0, np.cumsum([len(found[m][0]) for m in members]))
            forest = Forest(len(members))
            linked_sets(features, bounds, percent, np.flatnonzero([found[m][1] for m in members]), forest)
            roots = [members[forest.root(i)][0] for i in range(len(members))]
            yield pa.RecordBatch.from_arrays([pa.array([m[0] for m in members], pa.int64()), pa.array(roots, pa.int64())], ["node", "root"])

    return rows.select(*keys, "node", "h1", "first", "text").mapInArrow(compare, "node long, root long")


def linked_documents(docs: DataFrame, shingle: int = 3, percent: int = 90, slack: int = 1, ratio: int | None = None, block: int = BLOCK,
                     counters: int = 1 << 28) -> DataFrame:
    """doc_id, n_shingles and component_id of each row of `docs`.

    `ratio` is the largest over the smallest size of a band, in percent: wide bands mean fewer sets that sign for two,
    narrow ones fewer signatures per set; sets must not link beyond the next band. Unset, it is 140, or more if needed.
    `counters` (a power of 2) is the size of the sketch that tells shared features: full ones let more sets sign.
    """
    ratio = ratio or max(140, -(-10_000 // percent))
    sets = stored(hashed_sets(docs, shingle), "partenum-sets")
    able = sets.where("doc_id IS NOT NULL AND n_shingles > 0")
    classes = stored(able.groupBy("h1", "h2").agg(F.min("doc_id").alias("node"), F.max("n_shingles").alias("n_shingles"),
                                                  F.max("n_counted").alias("n_counted")), "partenum-classes")
    folded = able.select("doc_id", "h1", "h2").join(classes, ["h1", "h2"]).select("doc_id", "node")

    # one document of each group of copies signs; the filter lets through a few others, which adds rows and no links.
    # It runs in the tasks that read the texts: a Python stage of its own would take another worker on every core.
    heads = id_filter(classes, "node")
    texts = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), text_column().alias("text"))
    if (classes.agg(F.sum("n_shingles")).first()[0] or 0) > counters // 2:  # the sketch would take most features for shared
        heads = id_filter(sharing_heads(texts, heads, classes, shingle, percent), "node")
    bits = docs.sparkSession.sparkContext.broadcast(shared_counters(texts, heads, shingle, counters))
    stars = star_edges(signature_rows(texts, heads, bits, counters, shingle, percent, slack, ratio))
    near = (
        stars.join(folded, "doc_id").select("low", F.col("node").alias("b"))
        .join(folded.select(F.col("doc_id").alias("low"), F.col("node").alias("a")), "low").select("a", "b").where("a <> b")
    )
    clusters = components(near, "a", "b", "partenum-clusters")
    clusters = split_clusters(clusters, texts, bits, counters, shingle, percent, slack, ratio, block)

    sized = clusters.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    member = stored(
        clusters.join(sized, "component").join(classes.select("node", "h1"), "node")
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")), "partenum-members")
    head = member.where("node = component").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    placed = member.unionByName(head).select("component", "block", "node", "h1", F.lit(True).alias("first")).distinct()
    links = stored(verified(placed, docs, ["component", "block"], shingle, percent), "partenum-links")

    apart = links.join(member, "node").where("blocks > 1").groupBy("node", "component", "blocks", "h1") \
        .agg(F.min("root").alias("root")).where("root <> component")
    apart = stored(apart, "partenum-apart")
    if not apart.isEmpty():
        pieces = apart.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("pieces"))
        lone = (
            apart.join(pieces, "component").withColumn("piece", F.pmod(F.xxhash64("node"), F.col("pieces")).cast("int"))
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("component", "piece", "block", "node", "h1", F.lit(True).alias("first"))
        )
        others = (
            member.join(pieces, "component").withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
            .select("component", "piece", "block", "node", "h1", F.lit(False).alias("first"))
        )
        links = links.unionByName(verified(lone.unionByName(others), docs, ["component", "piece", "block"], shingle, percent))
    joined = components(links, "node", "root", "partenum-components")

    of_class = classes.join(joined, "node", "left").select("h1", "h2", F.coalesce("component", "node").alias("class_component"))
    result = sets.join(of_class, ["h1", "h2"], "left")
    linked = F.when(F.col("doc_id").isNotNull(), F.when(F.col("n_shingles") > 0, F.col("class_component")).otherwise(F.col("doc_id")))
    return result.select("doc_id", "n_shingles", linked.alias("component_id"))

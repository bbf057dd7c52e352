"""Spelling variants: words at one edit from a much more frequent word, found by a trie-node pair dictionary.

Every prefix of a word is a node of the forward trie, every suffix a node of the reversed trie, and each node has a
number. A word of L code points is entered under pairs (prefix node, suffix node):

* skipping position i (0 .. L - 1): the node of what stands before i and the node of what stands after it;
* inserting at position i (0 .. L): the node of what stands before i and the node of the rest.

Two words differ by one replaced code point exactly if they meet under one skipping pair, at the only position where they
differ. A word becomes another by one deletion exactly if its skipping pair is an inserting pair of the other; of a run
of equal code points only the first is skipped for this, so that two words meet once. Nothing is found that is not near.

Under a pair stand at most one word that inserts there (it is prefix + suffix) and, for skipping, one word per character
of the alphabet, so that a pair's list is bounded by the alphabet, whatever the corpus. Each pair is summed up once (how
many, the two best) and its members get that summary; pairs of words are never listed.

A node is identified by its string, or by the 128-bit digest of a string of more than SHORT bytes, so that a word of any
length takes rows of fixed size, twice as many as it has code points. A root is reached by following forms; as n at least
doubles each time, 6 rounds of pointer doubling always suffice.

Words: maximal runs of letters A-Z, a-z and U+00C0 to U+00FF, A-Z lower-cased. With `every` set, each `every`-th spelling
(by crc32 of `<doc_id>:<run>`) loses one code point, see `counted_words`.

Defined results: a null or empty text has no words; a null doc_id is written as nothing (`:<run>`); repeated rows count
each time; an empty table gives no rows. Columns other than doc_id and text are not read. Texts are read whole.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.llm.frames import gathered, python_tasks, stored, stored_at
from fareloom.llm.words import text_slices
from fareloom.sources.tables import drop_path

SHORT = 24
ROUNDS = 6  # forms are followed over at most 62 steps, as n of a long at least doubles
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_LOWERED = np.arange(256, dtype=np.uint8)
_LOWERED[65:91] += 32


# Words -------------------------------------------------------------------------------------------------------------

def letter_runs(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Lower-cased runs (UTF-8) of a sequence of texts, and the text of each run."""
    lead = data == 0xC3  # U+00C0 to U+00FF are the two-byte characters that begin with it
    solid = _LETTER[data] | lead
    solid[1:] |= lead[:-1]
    opens = solid.copy()
    opens[1:] &= ~solid[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    opens[edges] = solid[edges]
    kept = np.flatnonzero(solid)
    begins = np.flatnonzero(opens)
    bounds = np.append(np.searchsorted(kept, begins), len(kept)).astype(np.int64)
    letters = _LOWERED[data[kept]]
    runs = pa.Array.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(bounds.tobytes()), pa.py_buffer(letters.tobytes())])
    return runs, np.searchsorted(offsets, begins, side="right") - 1


def without_one(word: bytes, place: int) -> bytes:
    """The word without the code point that `place` falls on."""
    text = word.decode()
    at = place % len(text)
    return (text[:at] + text[at + 1:]).encode()


def counted_words(docs: DataFrame, least_length: int = 5, least_count: int = 3, every: int | None = 97) -> DataFrame:
    """word and n of the distinct words of at least `least_length` code points that occur at least `least_count` times.

    With `every`, a run whose h = crc32(`<doc_id>:<run>`) is a multiple of it loses its code point h % length first.
    """
    python_tasks(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches):
            names = [b"%d:" % i if i is not None else b":" for i in batch.column(0).to_pylist()]
            for first, end, data, offsets in text_slices(batch.column(1)):
                if not len(data):
                    continue
                runs, owner = letter_runs(data, offsets)
                coded = runs.dictionary_encode()
                words, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64)
                found: dict[bytes, int] = dict.fromkeys(words, 0)
                if every is None:
                    found.update(zip(words, np.bincount(codes, minlength=len(words)).tolist()))
                else:
                    entries, times = np.unique(owner * max(len(words), 1) + codes, return_counts=True)
                    seeds = [zlib.crc32(name) for name in names[first:end]]
                    for entry, n in zip(entries.tolist(), times.tolist()):
                        who, code = divmod(entry, len(words))
                        word = words[code]
                        h = zlib.crc32(word, seeds[who])
                        if h % every == 0:
                            word = without_one(word, h)
                        found[word] = found.get(word, 0) + n
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.keys(), pa.binary()).cast(pa.string()), pa.array(found.values(), pa.int64())], ["word", "n"])

    counts = docs.select("doc_id", "text").mapInArrow(count, "word string, n long")
    long_enough = counts.where((F.length("word") >= least_length) & (F.col("n") > 0))
    return long_enough.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


# Trie nodes --------------------------------------------------------------------------------------------------------

def node_keys(text: str) -> list[bytes]:
    """The identity of every prefix of a text, from the empty one on."""
    keys, taken, digest = [b""], b"", hashlib.blake2b(digest_size=16)
    for letter in text:
        piece = letter.encode()
        digest.update(piece)
        if taken is not None:
            taken = taken + piece if len(taken) + len(piece) <= SHORT else None
        keys.append(taken if taken is not None else b"\xff" + digest.digest())  # no UTF-8 text begins with 0xff
    return keys


def positions(words: DataFrame) -> DataFrame:
    """One row per place of each word: forward node before it, reversed node behind it, and what the place stands for.

    kind 0 inserts, kind 1 skips the first of a run of equal code points, kind 2 skips another of the run.
    """
    python_tasks(words.sparkSession, rows=2048)

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["word_id", "before", "behind", "kind"]
        for batch in batches:
            owners: list[int] = []
            before: list[bytes] = []
            behind: list[bytes] = []
            kinds: list[int] = []
            for word_id, word in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ahead, back, size = node_keys(word), node_keys(word[::-1]), len(word)
                owners += [word_id] * (2 * size + 1)
                before += ahead + ahead[:-1]
                behind += back[::-1] + back[-2::-1]
                kinds += [0] * (size + 1) + [2 if i and word[i] == word[i - 1] else 1 for i in range(size)]
            yield pa.RecordBatch.from_arrays([pa.array(owners, pa.int64()), pa.array(before, pa.binary()),
                                              pa.array(behind, pa.binary()), pa.array(kinds, pa.int32())], names)

    return words.select("word_id", "word").mapInArrow(enter, "word_id long, before binary, behind binary, kind int")


def node_numbers(places: DataFrame, side: str) -> DataFrame:
    """A number for every node of one trie."""
    return stored(places.select(side).distinct().withColumn(f"{side}_node", F.monotonically_increasing_id()), f"trie-{side}")


def pair_dictionary(words: DataFrame) -> tuple[DataFrame, list[str]]:
    """word_id and kind under integer pairs (before_node, behind_node), and the scratch tables it reads."""
    places, at = stored_at(positions(words), "trie-places")
    used = [at]
    for side in ("before", "behind"):
        places = places.join(node_numbers(places, side), side).drop(side)
    return places, used


# Neighbours --------------------------------------------------------------------------------------------------------

def near_summaries(words: DataFrame) -> DataFrame:
    """word_id, n_near and the best near word (`best`: minus n, then word) of all words that have near words."""
    pairs, used = pair_dictionary(words)
    entry = F.struct((-F.col("n")).alias("rank"), F.col("word"), F.col("word_id"))
    # no pair lists more than one word that inserts and one that skips per letter of the alphabet
    skipping, inserting = F.col("kind") > 0, F.col("kind") == 0
    groups = (
        pairs.join(words, "word_id").groupBy("before_node", "behind_node")
        .agg(F.array_sort(F.collect_list(F.when(skipping, entry))).alias("skips"),
             F.array_sort(F.collect_list(F.when(F.col("kind") == 1, entry))).alias("first_skips"),
             F.max(F.when(inserting, entry)).alias("inserts"))
        .where((F.size("skips") > 1) | ((F.size("first_skips") > 0) & F.col("inserts").isNotNull()))
    )
    summary = lambda word_id, count, best: F.struct(
        word_id.alias("word_id"), count.cast("long").alias("count"), best.alias("best"))
    other = lambda e: F.when(e["word_id"] == F.col("skips")[0]["word_id"], F.get("skips", F.lit(1))).otherwise(F.col("skips")[0])
    shorter = F.col("inserts").isNotNull() & (F.size("first_skips") > 0)
    replaced = F.when(F.size("skips") > 1, F.transform("skips", lambda e: summary(e["word_id"], F.size("skips") - 1, other(e))))
    deleted = F.when(shorter, F.transform("first_skips", lambda e: summary(e["word_id"], F.lit(1), F.col("inserts"))))
    inserted = F.when(shorter, F.array(summary(F.col("inserts.word_id"), F.size("first_skips"), F.get("first_skips", F.lit(0)))))
    none = F.array().cast("array<struct<word_id:bigint,count:bigint,best:struct<rank:bigint,word:string,word_id:bigint>>>")
    found = groups.select(F.explode(F.concat(*[F.coalesce(part, none) for part in (replaced, deleted, inserted)])).alias("s")).select("s.*")
    near, _ = stored_at(found.groupBy("word_id").agg(F.sum("count").alias("n_near"), F.min("best").alias("best")), "spelling-near")
    for path in used:
        drop_path(words.sparkSession, path)
    return near


def spelling_variants(docs: DataFrame, least_length: int = 5, least_count: int = 3, ratio: int = 2, every: int | None = 97) -> DataFrame:
    """word, form, root, n, n_near and form_n of every counted word.

    form is the near word of largest n (ties: the first by code points) if that n is at least `ratio` times the word's,
    root the end of the chain of forms.
    """
    if ratio < 2:
        raise ValueError("forms must at least double n, or their chains have no known length")
    counted = counted_words(docs, least_length, least_count, every)
    words = stored(counted.withColumn("word_id", F.monotonically_increasing_id()), "spelling-words")
    near = near_summaries(words)
    frequent = -F.col("best.rank") >= ratio * F.col("n")
    chosen = stored(words.join(near, "word_id", "left").select(
        "word_id", "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        *[F.when(frequent, value).alias(name) for name, value in
          (("form", F.col("best.word")), ("form_n", -F.col("best.rank")), ("form_id", F.col("best.word_id")))]), "spelling-forms")
    # Only words with a form take part: a few rows per root, and the end of a chain is found when no step is left.
    steps = chosen.where(F.col("form_id").isNotNull()).select("word_id", F.col("form_id").alias("root_id"), F.col("form").alias("root"))
    ends = steps
    for _ in range(ROUNDS):
        further = ends.select(F.col("word_id").alias("via"), F.col("root_id").alias("via_id"), F.col("root").alias("via_root"))
        joined = ends.join(further, ends["root_id"] == further["via"], "left")
        ends = stored(joined.select("word_id", F.coalesce("via_id", "root_id").alias("root_id"), F.coalesce("via_root", "root").alias("root"),
                                    F.col("via").isNotNull().alias("moved")), "spelling-roots")
        if ends.where("moved").isEmpty():
            break
    roots = ends.select("word_id", "root")
    return chosen.join(roots, "word_id", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

"""Fill-in-middle transformation: every text is cut into prefix, middle and suffix at two token ranks and put together anew.

A token is white space (blank, tab to return) with the word that follows, or white space at the end. The tokens of a text
are the nodes of an indexable skip list: lane 0 links every token to the next, each lane above only nodes of a greater
height, and each link carries its width in tokens and in code points. A walk from the top lane that takes a link while
its token width fits, and goes down a lane otherwise, ends exactly at the wanted rank; the code-point widths taken on the
way are the place of the cut. Heights depend on a node's number only, so that reruns build the same list.

The cuts and the form follow from the sha256 of `<seed>:<doc_id>`, see `transformed`. Texts that hold one of the marks
are left plain, so that `restored` rebuilds every text from its output and form alone.

Defined results: a null text is empty, an empty text is plain with no tokens; a null doc_id is written as nothing
(`<seed>:`); repeated rows are rows of their own; an empty table gives no rows. Columns other than the key and the text
are not read. Texts of any length are taken whole; one task holds a batch of rows and the list of one text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareloom.llm.frames import python_tasks
from fareloom.llm.words import mixed, split_words, text_slices

MARKS = ("<P>", "<S>", "<M>")
STEP = 3  # bits of a node's number that each lane asks for: every eighth node of a lane is in the next
_heights = np.zeros(0, np.int8)


def node_heights(count: int) -> np.ndarray:
    """Height of nodes 0 .. count - 1: how many groups of STEP low bits of the mixed number are zero."""
    global _heights
    if len(_heights) < count:
        bits = mixed(np.arange(max(count, 2 * len(_heights), 4096), dtype=np.uint64))
        heights = np.zeros(len(bits), np.int8)
        for lane in range(1, 64 // STEP):
            reached = (bits & np.uint64((1 << STEP * lane) - 1)) == 0
            if not reached.any():
                break
            heights += reached
        _heights = heights
    return _heights[:count]


@dataclass
class Lane:
    """Links of one lane, in order: widths in tokens and code points, and the link below that starts at the same node."""

    units: np.ndarray
    chars: np.ndarray
    below: np.ndarray


class SkipList:
    """Indexable skip list over token widths (code points). Node 0 is the head and stands in every lane."""

    def __init__(self, widths: np.ndarray):
        heights = node_heights(len(widths))
        units, nodes = np.ones(len(widths), np.int64), np.arange(len(widths))
        self.lanes = [Lane(units, widths.astype(np.int64), nodes)]
        while len(nodes) > 1 << STEP:
            high = heights[nodes] >= len(self.lanes)
            high[0] = True
            starts = np.flatnonzero(high)
            if len(starts) == len(nodes):
                break
            under = self.lanes[-1]
            self.lanes.append(Lane(np.add.reduceat(under.units, starts), np.add.reduceat(under.chars, starts), starts))
            nodes = nodes[starts]

    def chars_at(self, rank: int) -> int:
        """Code points before the token of this rank; the rank may be the number of tokens."""
        link = unit = char = 0
        for lane in reversed(self.lanes):
            units, chars = lane.units, lane.chars
            while unit < rank and link < len(units) and unit + units[link] <= rank:
                unit += int(units[link])
                char += int(chars[link])
                link += 1
            if unit == rank:
                return char
            link = int(lane.below[link])
        raise IndexError(rank)


def token_widths(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Code points of each token of one text, from its bytes and the byte bounds of its words."""
    bounds = ends if len(data) == (ends[-1] if len(ends) else 0) else np.append(ends, len(data))
    begins = np.concatenate([[0], bounds[:-1]]).astype(np.int64)
    return np.add.reduceat((data & 0xC0) != 0x80, begins, dtype=np.int64) if len(bounds) else np.zeros(0, np.int64)


def draws(key: Column, seed: int) -> list[Column]:
    """The first four 8-digit groups of the sha256 of `<seed>:<key>` as numbers."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"draw_{i + 1}") for i in range(4)]


def transformed(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 42, moved_percent: int = 50,
                spm_percent: int = 80, marks: tuple[str, str, str] = MARKS) -> DataFrame:
    """The key, n (tokens), form, prefix_chars, middle_chars (null if plain) and output of every row.

    With the draws h1 to h4 of the key: the prefix ends after the smaller and the middle after the larger of
    h1 % (n + 1) and h2 % (n + 1) tokens; the form is plain if the text is empty or holds a mark or
    h3 % 100 >= moved_percent, else spm if h4 % 100 < spm_percent, else psm.
    psm is mark P, prefix, mark S, suffix, mark M, middle; spm is mark S, suffix, mark P, prefix, mark M, middle.
    """
    python_tasks(docs.sparkSession)
    before, behind, between = marks

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h1, h2, h3, h4 = (batch.column(i).to_numpy() for i in range(2, 6))
            tokens: list[int] = []
            forms: list[str] = []
            cuts: list[tuple[int | None, int | None]] = []
            outputs: list[str] = []
            for first, end, data, offsets in text_slices(batch.column(1)):
                words = split_words(data, offsets)
                for i in range(end - first):
                    at, own = first + i, data[offsets[i]:offsets[i + 1]]
                    part = slice(words.first[i], words.first[i + 1])
                    widths = token_widths(own, words.start[part] - offsets[i], words.end[part] - offsets[i])
                    whole, n = own.tobytes().decode(), len(widths)
                    tokens.append(n)
                    if not whole or h3[at] % 100 >= moved_percent or any(m in whole for m in marks):
                        forms.append("plain")
                        cuts.append((None, None))
                        outputs.append(whole)
                        continue
                    ranks = sorted((int(h1[at] % (n + 1)), int(h2[at] % (n + 1))))
                    listed = SkipList(widths)
                    a, b = map(listed.chars_at, ranks)
                    prefix, middle, suffix = whole[:a], whole[a:b], whole[b:]
                    psm = h4[at] % 100 >= spm_percent
                    forms.append("psm" if psm else "spm")
                    cuts.append((a, b - a))
                    outputs.append("".join([before, prefix, behind, suffix, between, middle] if psm
                                           else [behind, suffix, before, prefix, between, middle]))
            columns = [pa.array(tokens, pa.int64()), pa.array(forms, pa.string()), pa.array([c[0] for c in cuts], pa.int64()),
                       pa.array([c[1] for c in cuts], pa.int64()), pa.array(outputs, pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names)

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("content"), *draws(F.col(key), seed))
    names = [key, "n", "form", "prefix_chars", "middle_chars", "output"]
    kinds = [docs.schema[key].dataType, T.LongType(), T.StringType(), T.LongType(), T.LongType(), T.StringType()]
    return rows.mapInArrow(build, T.StructType([T.StructField(n, k) for n, k in zip(names, kinds)]))


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text, rebuilt from an output and its form. No mark can arise where parts meet: none begins inside another."""
    parts = F.split(output, "|".join(f"\\Q{m}\\E" for m in marks), -1)
    prefix = F.when(form == "psm", F.get(parts, F.lit(1))).otherwise(F.get(parts, F.lit(2)))
    suffix = F.when(form == "psm", F.get(parts, F.lit(2))).otherwise(F.get(parts, F.lit(1)))
    return F.when(form == "plain", output).otherwise(F.concat(prefix, F.get(parts, F.lit(3)), suffix))

"""Words of texts as numpy arrays: byte offsets and 64-bit hashes, computed over many documents at once."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = np.random.default_rng(20_240_601).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mixed(h: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective scrambling of 64-bit values, another one for each salt."""
    with np.errstate(over="ignore"):
        h = h + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & 0xFFFFFFFFFFFFFFFF)
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def powers(base: int, count: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        out = np.full(max(count, 1), np.uint64(base), dtype=np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)


def text_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and each text's offset in them; a null text is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    kind = np.int64 if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    if offsets is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    off = np.frombuffer(offsets, dtype=kind)[texts.offset: texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def text_slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, end, bytes, offsets) of runs of whole texts of about `limit` bytes, or of one longer text."""
    data, off = text_buffers(texts)
    first, count = 0, len(off) - 1
    while first < count:
        end = max(first + 1, int(np.searchsorted(off, off[first] + limit, side="right")) - 1)
        yield first, end, data[off[first]:off[end]], off[first:end + 1] - off[first]
        first = end


@dataclass
class Words:
    """Words of a run of texts: byte start and end of each word, and the first word of each text (with an end mark)."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def count(self) -> np.ndarray:
        return np.diff(self.first)


def split_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Maximal runs of bytes other than blank, tab, line feed, vertical tab, form feed and return; texts never join."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return Words(none, none, np.zeros(len(offsets), np.int64))
    solid = ~_SPACE[data]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    begins[edges] = solid[edges]
    closes = solid.copy()
    closes[:-1] &= ~solid[1:]
    ends = offsets[1:][offsets[1:] > 0] - 1
    closes[ends] = solid[ends]
    start, end = np.flatnonzero(begins), np.flatnonzero(closes) + 1
    return Words(start, end, np.searchsorted(start, offsets))


def hash_words(data: np.ndarray, words: Words, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of each word's bytes (A-Z lower-cased if wanted), the same in every text, batch and run."""
    if not len(words.start):
        return np.zeros(0, np.uint64)
    lengths = words.end - words.start
    before = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum()), dtype=np.int64) - np.repeat(before, lengths)
    taken = data[place + np.repeat(words.start, lengths)]
    if lower:
        taken = _LOWER[taken]
    with np.errstate(over="ignore"):
        terms = _BYTE[taken] * powers(int(_BASE), int(lengths.max()))[place]
        return mixed(np.add.reduceat(terms, before) + lengths.astype(np.uint64))


def hash_windows(hashes: np.ndarray, width: int, salt: int = 0, starts: np.ndarray | None = None) -> np.ndarray:
    """A 64-bit hash of every run of `width` consecutive word hashes (texts are not told apart), or of those at `starts`."""
    count = max(len(hashes) - width + 1, 0) if starts is None else len(starts)
    out = np.zeros(count, np.uint64)
    if not count:
        return out
    factor = powers((0xD6E8FEB86659FD93 + 2 * salt * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF, width)
    h = mixed(hashes, salt)
    with np.errstate(over="ignore"):
        for i in range(width):
            out += (h[i:count + i] if starts is None else h[starts + i]) * factor[i]
    return mixed(out, salt + 1)

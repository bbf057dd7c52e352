from __future__ import annotations

import collections
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from fareloom.llm import packing

PATH = P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def checked(df, rows, tokenizer, window=1024):
    """Pieces cover every row's tokens exactly once, sequences are gapless and full at most; returns the padding share."""
    got = df.collect()
    by_doc = collections.defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
    expected = collections.defaultdict(collections.Counter)
    for doc_id, text in rows:
        ids = np.append(np.array(tokenizer.encode(text or "", add_special_tokens=False).ids), 0).astype("<u4")
        for at in range(0, len(ids), window):
            expected[doc_id][at, len(ids[at:at + window]), zlib.crc32(ids[at:at + window].tobytes()), len(ids)] += 1
    assert {d: collections.Counter((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rs) for d, rs in by_doc.items()} == expected
    sequences = collections.defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for pieces in sequences.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= window
    total = sum(r.length for r in got)
    return 1 - total / (window * len(sequences)) if sequences else 0.0


def test_odd_rows(documents, odd_rows, tokenizer):
    rows = [*odd_rows, (30, "<|endoftext|> is a token"), (34, "a <|endoftext|> b"), (35, "a  <|endoftext|>\n\n<|endoftext|><|endoftext|>  b <|endof"), (36, "text|> c"), (31, "a\n\nb \n c  d e  f\t"), (32, "don't they'll 'S 123 45 %%%"), (33, "　文 字 \x1c x")]
    checked(packing.pack(documents(rows), PATH, P.PATTERN), rows, tokenizer)
    assert packing.pack(documents([]), PATH, P.PATTERN).collect() == []


def test_many_documents_leave_little_padding(documents, tokenizer):
    rng = np.random.default_rng(1)
    rows = [(i, "word " * int(rng.integers(1, 900))) for i in range(1500)] + [(5000 + i, "same text again") for i in range(700)]
    assert checked(packing.pack(documents(rows), PATH, P.PATTERN), rows, tokenizer) < 0.01


@pytest.mark.parametrize("text", ["", "a b", "  a", "é\né É  é", "x\n\n y", " \n", "a  b", "tab\tb c", "\x85 a", "naïve 日本 語 x", " <|endoftext|> ", "x\n<|endoftext|>\ny", "<|endoftext"])
def test_chunks_have_the_tokens_of_the_whole(text, tokenizer):
    with open(PATH, encoding="utf-8") as file:
        encoder = packing.ChunkEncoder(file.read(), P.PATTERN)
    texts = [text, f"{text} end", f"start {text}{text}"]
    raw = [t.encode() for t in texts]
    ids, ends = encoder.encode(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    begin = 0
    for t, end in zip(texts, ends):
        assert ids[begin:end].tolist() == tokenizer.encode(t, add_special_tokens=False).ids
        begin = end


def test_plan_uses_every_length_as_often_as_it_occurs():
    rng = np.random.default_rng(2)
    for lengths in (rng.integers(1, 64, 5000), np.array([33] * 7), np.array([63, 1] * 50), np.array([], int)):
        values, counts = np.unique(lengths, return_counts=True)
        plan = packing.packing_plan(values.astype(int), counts, 64)
        used = collections.Counter()
        for pattern, times in plan:
            assert sum(pattern) <= 64 and times > 0
            for x in pattern:
                used[x] += times
        assert used == dict(zip(values.tolist(), counts.tolist()))


def test_least_squares_finds_an_exact_mix():
    patterns = packing.shallow_patterns(np.array([10, 20, 30, 40, 50, 54]), 64, 3)
    assert (54, 10) in patterns and all(sum(p) == 64 for p in patterns)
    solved = packing.solve_counts([(54, 10), (40, 24), (44, 20)], np.array([10, 20, 24, 40, 44, 54]), np.array([5.0, 7, 3, 3, 7, 5]), 64)
    assert np.allclose(solved, [5, 3, 7], atol=0.05)

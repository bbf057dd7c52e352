from __future__ import annotations

import glob
import tempfile
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fareloom.llm import planes

PATH = P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def expected(rows, tokenizer):
    """Rows of documents in ascending order of ids, with the place of each."""
    at, out = 0, []
    for doc_id, text in rows:
        ids = np.append(np.array(tokenizer.encode(text or "", add_special_tokens=False).ids), 2).astype("<u4")
        out.append((doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def test_odd_rows(documents, odd_rows, tokenizer, spark):
    rows = [*odd_rows, (30, "a <|endoftext|> b<|startoftext|>"), (31, "DON'T they'll É é 　x\x85y"), (-5, "negative id"), (1 << 40, "x" * 3000)]
    for bits in (False, True):
        manifest = planes.write_corpus(documents(rows), PATH, 2, folder(), bits, block=1000, file_ids=20_000)
        got = sorted(planes.read_corpus(spark, manifest).collect(), key=lambda r: r.start)
        assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1].tolist()]
        assert [r.doc_id for r in got] == sorted((r[0] for r in rows), key=lambda i: (i is not None, i or 0))
        want = expected([(r[0], r[1]) for r in rows], tokenizer)
        assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == sorted((str(d), n, c) for d, _, n, c in want)
        files = manifest.collect()
        assert len(files) > 1 and sum(f.n_docs for f in files) == len(rows)


def test_empty_table(documents, spark):
    manifest = planes.write_corpus(documents([]), PATH, 2)
    assert planes.read_corpus(spark, manifest).collect() == [] and manifest.collect() == []


def test_whole_given_table(spark, sf_dir, tokenizer):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    manifest = planes.write_corpus(docs, PATH, 2)
    got = sorted(tuple(r) for r in planes.read_corpus(spark, manifest).collect())
    assert got == expected([(r.doc_id, r.text) for r in docs.orderBy("doc_id").select("doc_id", "text").collect()], tokenizer)
    assert manifest.agg(F.sum("n_bytes") < 2 * F.sum("n_ids")).first()[0]  # smaller than the ids at two bytes each


def test_files_of_failed_attempts_are_not_read(documents, spark, tokenizer):
    rows, place = [(i, f"text number {i}") for i in range(50)], folder()
    first = planes.write_corpus(documents(rows), PATH, 2, place)
    second = planes.write_corpus(documents(rows), PATH, 2, place)
    assert len(glob.glob(f"{place}/*.ids")) == first.count() + second.count()
    assert sorted(tuple(r) for r in planes.read_corpus(spark, second).collect()) == expected(rows, tokenizer)


@pytest.mark.parametrize("bits", [False, True])
@pytest.mark.parametrize("width", [2, 4])
def test_planes_round_trip(bits, width):
    rng = np.random.default_rng(3)
    for count in (1, 7, 8, 9, 1000):
        for ids in (rng.integers(0, 1 << 8 * width, count), np.zeros(count, int), np.arange(count), np.full(count, (1 << 8 * width) - 1)):
            split = planes.split_planes(ids, width, bits)
            assert len(split) == width * (8 if bits else 1)
            assert planes.join_planes(split, count, width, bits).tolist() == ids.tolist()
    assert planes.split_planes(np.arange(9), width, bits)[-1] == b""


@pytest.mark.parametrize("bits", [False, True])
def test_any_range_is_read_from_its_chunks(bits):
    rng, path = np.random.default_rng(4), f"{folder()}/one.ids"
    docs = [(i, rng.integers(0, 50_000, int(rng.integers(0, 300)))) for i in range(60)] + [(None, rng.integers(0, 9, 5000))]
    writer = planes.PlaneWriter(pa.OSFile(path, "wb"), 2, bits, block=64)
    for doc_id, ids in docs:
        writer.add(doc_id, ids.astype("<u2"))
    writer.close()
    reader, everything = planes.PlaneReader(path), np.concatenate([ids for _, ids in docs])
    for first, count in [(0, 0), (0, 1), (63, 2), (64, 64), (100, 1000), (0, len(everything)), (len(everything) - 1, 1), (len(everything), 0)]:
        assert reader.ids(first, count).tolist() == everything[first:first + count].tolist()
    with pytest.raises(IndexError):
        reader.ids(len(everything), 1)
    assert [(d, n, c) for d, _, n, c in reader.documents()] == [(d, len(i), zlib.crc32(i.astype("<u4").tobytes())) for d, i in docs]
    reader.close()
    with open(path, "rb") as file:
        content = file.read()
    with open(path, "wb") as file:
        file.write(content[:-5])
    with pytest.raises(ValueError, match="cut short"):
        planes.PlaneReader(path)


WORDS = ["", " ", "a", "A  b", "don't 'tis it's'll X'S", "'", "''s", "naïve ÀÉÎ ß÷ø×x é", "x,y.z 'Re", "a1b22c", "日本語 x日", "e\u0301 E\u0301,", "=\u0338", "\x85x\xa0y",
         "<|endoftext|>", "<|EndOfText|>", "a<|endoftext|>B", "<|startoftext|> A", "<|endoftext|", "\x00a\x1cb", "ﬁ İ Σς", "Ÿÿ", "a\u200db", "12,345.67€", "—,a—", "x\u0327 ç,"]


def test_pieces_have_the_ids_of_the_whole(tokenizer):
    with open(PATH, encoding="utf-8") as file:
        encoder = planes.WordEncoder(file.read())
    rng = np.random.default_rng(6)
    mixed = ["".join(rng.choice(list("abzABé÷×ÉÀß 'stm.,!<|>19\n—日\u0301\u0338"), int(rng.integers(1, 30)))) for _ in range(3000)]
    texts = [*WORDS, *mixed, " ".join(WORDS)]
    raw = [t.encode() for t in texts]
    ids, ends = encoder.encode(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    begin = 0
    for text, end in zip(texts, ends):
        assert ids[begin:end].tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text
        begin = end

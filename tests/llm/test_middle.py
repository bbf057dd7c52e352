from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fareloom.llm import middle
from fareloom.llm.entries import fim_report

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def expected(doc_id, text):
    text = text or ""
    ends = [0, *[m.end() for m in TOKEN.finditer(text)]]
    n = len(ends) - 1
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i:8 * i + 8], 16) for i in range(4))
    sha = hashlib.sha256(text.encode()).hexdigest()
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return doc_id, n, "plain", None, None, sha, sha
    a, b = (ends[r] for r in sorted((h1 % (n + 1), h2 % (n + 1))))
    prefix, mid, suffix = text[:a], text[a:b], text[b:]
    form = "spm" if h4 % 100 < 80 else "psm"
    output = f"<S>{suffix}<P>{prefix}<M>{mid}" if form == "spm" else f"<P>{prefix}<S>{suffix}<M>{mid}"
    return doc_id, n, form, a, b - a, hashlib.sha256(output.encode()).hexdigest(), sha


def compared(df, rows):
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    got = sorted((tuple(r[c] for c in names) for r in df.collect()), key=str)
    assert got == sorted((expected(r[0], r[1]) for r in rows), key=str)


def test_rows_equal_the_definition(documents, odd_rows):
    marked = [(20, "text with <P> inside"), (21, "<M>"), (22, "a <s> b"), (23, "< P>"), (24, "<<P <S"), (25, "S> x < y M>")]
    odd = [(40 + i, f"\x85 {chr(160)}é\n𝄞 x{'　' * i} \x1f\t ü") for i in range(40)]
    rows = [*odd_rows, *marked, *odd, *[(100 + i, "  " + "ab é\n" * i) for i in range(150)]]
    compared(fim_report(documents(rows)), rows)
    assert fim_report(documents([])).collect() == []


def test_whole_given_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    compared(fim_report(docs), [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


@pytest.mark.parametrize("count", [1, 2, 8, 9, 10, 100, 5000, 200_000])
def test_skip_list_reaches_every_rank(count):
    widths = np.random.default_rng(count).integers(1, 9, count)
    listed, places = middle.SkipList(widths), np.concatenate([[0], np.cumsum(widths)])
    for rank in sorted({*range(min(count, 300) + 1), count // 2, count - 1, count}):
        assert listed.chars_at(rank) == places[rank]
    assert count < 100 or len(listed.lanes) > 1
    for low, high in zip(listed.lanes, listed.lanes[1:]):  # lanes thin out and each spans the whole text
        assert len(high.units) < len(low.units) and high.units.sum() == count and high.chars.sum() == places[-1]


def test_a_walk_takes_few_links():
    class Counted(np.ndarray):
        reads = 0

        def __getitem__(self, item):
            Counted.reads += 1
            return super().__getitem__(item)

    listed = middle.SkipList(np.ones(500_000, int))
    for lane in listed.lanes:
        lane.units = lane.units.view(Counted)
    for rank in (1, 77_777, 250_001, 499_999):
        Counted.reads = 0
        assert listed.chars_at(rank) == rank
        assert Counted.reads < 600


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab é\n\t　𝄞<P", max_size=40))
def test_token_widths(text):
    from fareloom.llm.words import split_words

    data = np.frombuffer(text.encode(), np.uint8)
    words = split_words(data, np.array([0, len(data)]))
    assert middle.token_widths(data, words.start, words.end).tolist() == [len(m.group()) for m in TOKEN.finditer(text)]


def test_own_key_seed_marks_and_shares(spark):
    rows = spark.range(400).selectExpr("concat('k', id) AS name", "concat('one two three ', id) AS body", "id AS n", "'x' AS output")
    out = middle.transformed(rows, key="name", text="body", seed=7, moved_percent=100, spm_percent=0, marks=("[a]", "[b]", "[c]"))
    back = out.join(rows.select("name", "body"), "name").select("form", "output", "body", middle.restored(out["output"], out["form"], ("[a]", "[b]", "[c]")).alias("back"))
    got = back.collect()
    assert len(got) == 400 and {r.form for r in got} == {"psm"}
    assert all(r.back == r.body and r.output.startswith("[a]") for r in got)

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fareloom.llm import entries, langid, quality
from fareloom.llm.frames import crc_remainder, table

FIVE = "/root/testdata/sf0.01"


def test_language_held_out_accuracy(spark):
    truth = {r.doc_id: r.lang for r in table(spark, FIVE, "documents").select("doc_id", "lang").collect()}
    rows = entries.op3_language(spark, FIVE).collect()
    assert len(rows) == len(truth) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.97 and all(0 <= r.score <= 1 for r in rows)
    assert np.mean([r.rejected for r in rows]) < 0.01


def test_very_long_clean_texts_stay(spark):
    """A text repeated many times deviates as the text does; gibberish of any length goes."""
    docs = table(spark, FIVE, "documents")
    clean = docs.join(table(spark, FIVE, "labels").where("quality = 1"), "doc_id").where("length(text) between 1500 and 6000").orderBy("doc_id")
    texts = [r.text for r in clean.limit(120).collect()]
    model, calibration = langid._model(docs, crc_remainder(3) != 1, langid.ORDER, langid.SAMPLE_DOCUMENTS)
    once, often = (langid.predictions(pa.array([(t + "\n") * n for t in texts]), model, calibration, 3.0)[2] for n in (1, 200))
    assert not once.any() and not often.any()
    noise = ["".join(np.random.default_rng(i).choice(list("qxzjkvwy "), 1_000 * i)) for i in (1, 3, 30)]
    assert langid.predictions(pa.array(noise), model, calibration, 3.0)[2].all()


def test_calibration_takes_all_rows_and_stops_narrowing():
    counts = {(0, 7): {300: 80, 340: 20}, (0, 10): {300: 9_000, 310: 995, 900: 5}, (1, 9): {300: langid.ENOUGH - 1}}
    found = langid.fitted_calibration(counts, 2)
    assert found.width[0, 10] == pytest.approx(11 * langid.BIN) and found.width[0, 9] == found.width[0, 7] == pytest.approx(41 * langid.BIN)
    assert found.width[0, 5] == pytest.approx(2 * found.width[0, 7]) and np.isinf(found.width[1]).all()
    assert langid.length_class(np.array([1, 2, 1023, 1024, 10**8])).tolist() == [0, 1, 9, 10, 10]


def test_language_of_odd_rows(documents, odd_rows):
    training = [(100 + i, t, lang) for i in range(30) for t, lang in (("the cat and the dog went out", "en"), ("der hund und die katze", "de"))]
    docs = documents(odd_rows + training + [(200, "DER HUND!!"), (201, "123 456"), (202, "the cat"), (203, "x", None)])
    got = {}
    for r in langid.identified(docs, trains=F.col("doc_id").between(100, 199)).collect():
        got.setdefault(r.doc_id, []).append((r.lang_pred, r.score, r.rejected))
    assert got[2] == got[3] == got[4] == got[201] == [("und", 0.0, True)]
    assert got[200][0][0] == "de" and got[202][0][0] == "en" and len(got[1]) == 2 and len(got[None]) == 2
    assert langid.identified(documents([])).collect() == []
    assert [tuple(r) for r in langid.identified(documents([(1, "text", None)])).collect()] == [(1, "und", 0.0, True)]
    kept = langid.kept_by_language(docs, trains=F.col("doc_id").between(100, 199))
    assert kept.columns == docs.columns and not {2, 3, 4, 201} & {r.doc_id for r in kept.collect()}


def test_kneser_ney_sums_to_one():
    counts = {"\na": 3, "\nab": 2, "\nac": 1, "ab\n": 2, "ac\n": 1}
    probability, weight = langid.kneser_ney(counts, 3, 4)
    for context in ("a", "\na", "\n"):
        seen = {g[-1]: p for g, p in probability[len(context) + 1].items() if g[:-1] == context}
        rest = sum(langid_probability(probability, weight, context, c, 4) for c in "abc\n" if c not in seen)
        assert abs(sum(seen.values()) + rest - 1) < 1e-9


def langid_probability(probability, weight, context, char, alphabet):
    if not context and char not in probability[1]:
        return weight[0][""] / alphabet
    if context + char in probability[len(context) + 1]:
        return probability[len(context) + 1][context + char]
    return weight[len(context)].get(context, 1.0) * langid_probability(probability, weight, context[1:], char, alphabet)


def test_scores_of_runs_equal_the_definition(spark, documents):
    docs = documents([(i, t, "en") for i, t in enumerate(["abc abd bcd", "abab cdcd", "dcba", "aab"])])
    counts = {r.gram: r.n for r in langid.gram_counts(docs.select("lang", "text"), 3).collect()}
    model = langid.trained_model(langid.gram_counts(docs.select("lang", "text"), 3), 3)
    alphabet = len({c for g in counts for c in g}) + 1
    probability, weight = langid.kneser_ney(counts, 3, alphabet)
    for run in ("abc", "zab", "d", "abzd", "cdcdcd"):
        marked, total = f"\n{run}\n", 0.0
        for i in range(1, len(marked)):
            total += np.log(langid_probability(probability, weight, marked[max(0, i - 2):i], marked[i], alphabet))
        assert model.score_runs([run])[0, 0] == pytest.approx(total, rel=1e-4)


def test_quality_held_out_accuracy(spark):
    labels = {r.doc_id: r.quality for r in table(spark, FIVE, "labels").collect()}
    rows = entries.op6_quality(spark, FIVE).collect()
    assert len(rows) == table(spark, FIVE, "documents").count()
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert all(r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in rows)
    assert np.mean([r.predicted == labels[r.doc_id] for r in held]) > 0.95


def test_quality_of_odd_rows(spark, documents, odd_rows):
    docs = documents(odd_rows + [(100 + i, ("good plain words here" if i % 2 else "BUY!! NOW!! BUY!!")) for i in range(60)])
    labels = spark.createDataFrame([(100 + i, i % 2) for i in range(60)] + [(None, 1), (1, None), (7, 5), (999, 0), (100, 0)], "doc_id long, quality int")
    got = quality.quality_scores(docs, labels, trains=crc_remainder(5) != 0, shards=2, epochs=20).collect()
    assert len(got) == len(odd_rows) + 60 and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r.score for r in got}
    assert min(by[100 + i] for i in range(60) if i % 2) > max(by[100 + i] for i in range(60) if not i % 2)
    assert by[2] == by[3] == by[4]
    nothing = labels.where("false")
    assert {r.score for r in quality.quality_scores(docs, nothing).collect()} == {0.5}
    assert quality.quality_scores(documents([]), labels).collect() == []

"""Language identification by interpolated Kneser-Ney character models.

Texts are lower-cased and cut into runs of letters. A run's characters and its end are predicted from up to order - 1
characters before them, beginning with a mark for the start of the run, so that a run has one score per language whatever stands
around it. Counts of the runs' n-grams of a bounded training sample are summed by Spark; the model keeps, for each order,
the hashes of all n-grams in a sorted array beside the log-probabilities of every language, and likewise the
contexts with their back-off weights. The predicted language has the lowest cross-entropy per character.

Rejection is calibrated on all training rows that were not counted, by language and length class (powers of two): a text is
rejected if its cross-entropy exceeds the class's median by more than `slack` times what the TAIL quantile does. Long texts
form one class, because their scatter stops shrinking: what they differ in lasts. Quantiles come from counts of narrow
bins, so that they are the same whatever the partitioning. A class of fewer than ENOUGH rows takes its bound from the nearest
shorter class, else from the nearest longer one, widened as the root of the length; a language without any such class
rejects only texts without letters.

Defined results: a text that is null or has no letter is `und` with score 0 and rejected; ties go to the language first
by code point; rows without a language or an id do not train; without training rows every text is `und`; repeated rows
and null ids are predicted row by row; an empty table gives no rows. Columns other than doc_id, text and, for training,
lang are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.llm.frames import python_tasks, stored, text_column
from fareloom.llm.words import mixed

ORDER = 5
SAMPLE_DOCUMENTS = 900  # training texts per language, about, of which two thirds are counted; all other rows calibrate
TAIL = 0.999
ENOUGH = 50
LONG = 10  # log2 of the characters from which on texts form one class
BIN = 0.005  # nats a character
UNKNOWN = "und"
_MARK = "\n"
_STEP = np.uint64(0xA24BAED4963EE407)


def _keys(codes: np.ndarray, order: int) -> list[np.ndarray]:
    """Hash of the n characters that end at each place, for n = 1 .. order."""
    own = mixed(codes.astype(np.uint64), 31)
    out, running = [], np.zeros(len(codes), np.uint64)
    with np.errstate(over="ignore"):
        for n in range(1, order + 1):
            running = own + _STEP * np.append(np.zeros(1, np.uint64), running[:-1])
            out.append(mixed(running, 40 + n))
    return out


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


@dataclass
class HashTable:
    """Sorted hashes with a row of values each."""

    keys: np.ndarray
    values: np.ndarray

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each key is there, and its row."""
        if not len(self.keys):
            return np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return self.keys[at] == keys, at


@dataclass
class LanguageModel:
    languages: list[str]
    order: int
    grams: list[HashTable]  # by order: log-probabilities
    backoff: list[HashTable]  # by length of context: log weights
    floor: np.ndarray  # log-probability of a character never seen

    def score_runs(self, runs: list[str]) -> np.ndarray:
        """Log-probability of each run of letters and its end, by language."""
        if not runs:
            return np.zeros((0, len(self.languages)), np.float32)
        codes = _code_points(_MARK + _MARK.join(runs) + _MARK)
        keys = _keys(codes, self.order)
        mark = np.flatnonzero(codes == ord(_MARK))
        place = np.arange(1, len(codes))
        start = mark[np.searchsorted(mark, place) - 1]  # the mark before each character
        order = np.minimum(place - start + 1, self.order)
        total = np.zeros((len(place), len(self.languages)), np.float32)
        for n in range(self.order, 0, -1):
            open_ = np.flatnonzero(order == n)
            hit, row = self.grams[n].find(keys[n - 1][place[open_]])
            total[open_[hit]] += self.grams[n].values[row[hit]]
            missed = open_[~hit]
            if n == 1:
                total[missed] += self.floor
                break
            known, row = self.backoff[n - 1].find(keys[n - 2][place[missed] - 1])
            total[missed[known]] += self.backoff[n - 1].values[row[known]]
            order[missed] = n - 1
        return np.add.reduceat(total, mark[:-1], axis=0)


def gram_counts(sample: DataFrame, order: int) -> DataFrame:
    """lang, gram (the longest that ends at each place of a run) and how often it occurs."""
    run = F.explode(F.regexp_extract_all(F.lower(text_column()), F.lit(r"\p{L}+"), F.lit(0)))
    runs = sample.select("lang", run.alias("run")).groupBy("lang", "run").count()
    marked = F.concat(F.lit(_MARK), "run", F.lit(_MARK))
    grams = F.transform(F.sequence(F.lit(2), F.length("run") + 2),
                        lambda end: F.substring(marked, F.greatest(end - order + 1, F.lit(1)), F.least(end, F.lit(order))))
    return runs.select("lang", F.explode(grams).alias("gram"), "count").groupBy("lang", "gram").agg(F.sum("count").alias("n"))


def kneser_ney(counts: dict[str, int], order: int, alphabet: int) -> tuple[list[dict[str, float]], list[dict[str, float]]]:
    """Probabilities by order of n-gram and back-off weights by length of context of one language."""
    adjusted: list[dict[str, int]] = [defaultdict(int) for _ in range(order + 1)]
    for gram, n in counts.items():
        adjusted[len(gram)][gram] += n  # of full length, or at the start of a run: there is no longer one
    for n in range(order - 1, 0, -1):
        for gram in adjusted[n + 1]:
            adjusted[n][gram[1:]] += 1  # in how many contexts it continues
    probability: list[dict[str, float]] = [{} for _ in range(order + 1)]
    weight: list[dict[str, float]] = [{} for _ in range(order + 1)]
    for n in range(1, order + 1):
        once, twice = (sum(v == k for v in adjusted[n].values()) for k in (1, 2))
        discount = once / (once + 2 * twice) if once else 0.5
        total: dict[str, float] = defaultdict(float)
        kinds: dict[str, int] = defaultdict(int)
        for gram, v in adjusted[n].items():
            total[gram[:-1]] += v
            kinds[gram[:-1]] += 1
        weight[n - 1] = {c: discount * kinds[c] / total[c] for c in total}
        for gram, v in adjusted[n].items():
            below = probability[n - 1].get(gram[1:], 0.0) if n > 1 else 1.0 / alphabet
            probability[n][gram] = (v - discount) / total[gram[:-1]] + weight[n - 1][gram[:-1]] * below
    return probability, weight


def trained_model(counts: DataFrame, order: int) -> LanguageModel | None:
    """All languages' models in common tables. The counts are those of a bounded sample."""
    by_language: dict[str, dict[str, int]] = defaultdict(dict)
    for row in counts.collect():
        by_language[row.lang][row.gram] = row.n
    if not by_language:
        return None
    languages = sorted(by_language)
    alphabet = len({c for grams in by_language.values() for g in grams for c in g}) + 1
    fitted = [kneser_ney(by_language[x], order, alphabet) for x in languages]
    # what a language without the character gives: its weight for the unseen, or nothing known at all
    base = [max(w[0].get("", 1.0), 1e-6) / alphabet for _, w in fitted]

    def probability(which: int, gram: str) -> float:
        probabilities, weights = fitted[which]
        factor = 1.0
        while gram:
            if gram in probabilities[len(gram)]:
                return factor * probabilities[len(gram)][gram]
            factor *= weights[len(gram) - 1].get(gram[:-1], 1.0) if len(gram) > 1 else 1.0
            gram = gram[1:]
        return factor * base[which]

    def as_table(strings: list[str], n: int, value) -> HashTable:
        if not strings:
            return HashTable(np.zeros(0, np.uint64), np.zeros((0, len(languages)), np.float32))
        keys = _keys(_code_points("".join(strings)), n)[n - 1][n - 1::n]
        values = np.log(np.array([[value(k, s) for k in range(len(languages))] for s in strings])).astype(np.float32)
        rank = np.argsort(keys, kind="stable")
        return HashTable(keys[rank], values[rank])

    grams, backoff = [HashTable(np.zeros(0, np.uint64), np.zeros(0, np.float32))], [HashTable(np.zeros(0, np.uint64), np.zeros(0, np.float32))]
    for n in range(1, order + 1):
        grams.append(as_table(sorted({g for p, _ in fitted for g in p[n]}), n, probability))
        backoff.append(as_table(sorted({c for _, w in fitted for c in w[n]}), n, lambda k, c, n=n: fitted[k][1][n].get(c, 1.0)) if n < order
                       else HashTable(np.zeros(0, np.uint64), np.zeros(0, np.float32)))
    return LanguageModel(languages, order, grams, backoff, np.log(np.array(base)).astype(np.float32))


def scored_texts(texts: pa.Array, model: LanguageModel) -> tuple[np.ndarray, np.ndarray]:
    """Cross-entropy per character by language, and the number of characters, of each text; 0 characters without letters."""
    lowered = pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(texts, "")), r"[^\p{L}]+", " ")
    runs = pc.ascii_split_whitespace(lowered)
    coded = runs.flatten().dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    distinct = coded.dictionary.to_pylist()
    real = np.array([bool(r) for r in distinct], bool)
    score = np.zeros((len(distinct) + 1, len(model.languages)), np.float32)
    score[:-1][real] = model.score_runs([r for r in distinct if r])
    length = np.zeros(len(distinct) + 1, np.int64)
    length[:-1] = [len(r) + 1 if r else 0 for r in distinct]
    offsets = np.asarray(runs.offsets).astype(np.int64)
    offsets -= offsets[0]
    # one run of nothing after each text, so that no text's part is empty
    members = np.insert(coded.indices.to_numpy().astype(np.int64), offsets[1:], len(distinct))
    begin = offsets[:-1] + np.arange(len(texts))
    if not len(texts):
        return np.zeros((0, len(model.languages))), np.zeros(0, np.int64)
    total = np.add.reduceat(score[members].astype(np.float64), begin, axis=0)
    characters = np.add.reduceat(length[members], begin)
    return -total / np.maximum(characters, 1)[:, None], characters


def length_class(characters: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(characters, 1)).astype(np.int64), LONG)


@dataclass
class Calibration:
    """Median and tail of the cross-entropy, by language and length class."""

    middle: np.ndarray
    width: np.ndarray  # from the median to the TAIL quantile; infinite where nothing is known

    def rejects(self, entropy: np.ndarray, language: np.ndarray, characters: np.ndarray, slack: float) -> np.ndarray:
        at = length_class(characters)
        return entropy - self.middle[language, at] > slack * self.width[language, at]


def fitted_calibration(counts: dict[tuple[int, int], dict[int, int]], languages: int) -> Calibration:
    """From the rows of each bin, by language and length class."""
    middle, width = np.zeros((languages, LONG + 1)), np.full((languages, LONG + 1), np.inf)
    for k in range(languages):
        known = []
        for at in range(LONG + 1):
            bins = sorted(counts.get((k, at), {}).items())
            running = np.cumsum([n for _, n in bins])
            if len(bins) and running[-1] >= ENOUGH:
                half, tail = (bins[int(np.searchsorted(running, q * running[-1]))][0] for q in (0.5, TAIL))
                middle[k, at], width[k, at] = half * BIN, (tail - half + 1) * BIN
                known.append(at)
        for at in range(LONG + 1) if known else ():
            shorter = [j for j in known if j <= at]
            near = shorter[-1] if shorter else known[0]
            middle[k, at], width[k, at] = middle[k, near], width[k, near] * 2 ** (max(near - at, 0) / 2)
    return Calibration(middle, width)


def calibrated(held: DataFrame, model: LanguageModel) -> Calibration:
    """From all rows of `held`; only counts by language, length class and bin come to the driver."""
    shared = held.sparkSession.sparkContext.broadcast(model)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        index = {x: k for k, x in enumerate(own.languages)}
        for batch in batches:
            entropy, characters = scored_texts(batch.column(1), own)
            truth = np.array([index.get(x, -1) for x in batch.column(0).to_pylist()], np.int64)
            some = np.flatnonzero((truth >= 0) & (characters > 0))
            bins = np.floor(entropy[some, truth[some]] / BIN)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x.astype(np.int32)) for x in (truth[some], length_class(characters[some]), bins)], ["language", "length", "bin"])

    counts: dict[tuple[int, int], dict[int, int]] = defaultdict(dict)
    rows = held.select("lang", "text").mapInArrow(measured, "language int, length int, bin int")
    for r in rows.groupBy("language", "length", "bin").agg(F.count(F.lit(1)).alias("n")).collect():
        counts[r.language, r.length][r.bin] = r.n
    return fitted_calibration(counts, len(model.languages))


def training_rows(docs: DataFrame, trains: Column, documents: int) -> tuple[DataFrame, DataFrame]:
    """lang and text of the rows to count, two thirds of about `documents` per language chosen by the hash of the id, and of all others."""
    rows = docs.where(trains & F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    narrow = rows.select("doc_id", "lang")
    counts = narrow.groupBy("lang").agg(F.count(F.lit(1)).alias("rows"))  # one row per language
    draw = F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(1 << 20))
    part = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(3))
    chosen = stored(
        narrow.where(part < 2).join(counts, "lang").where(draw < F.lit(documents * (1 << 20)) / F.col("rows")).select("doc_id", "lang").distinct(),
        "language-ids")
    # about `documents` ids per language: small whatever the input
    texts = rows.select("doc_id", "lang", "text")
    counted = stored(texts.join(F.broadcast(chosen), ["doc_id", "lang"]).select("lang", "text"), "language-sample")
    return counted, texts.join(F.broadcast(chosen), ["doc_id", "lang"], "left_anti").select("lang", "text")


def identified(docs: DataFrame, trains: Column | None = None, order: int = ORDER, documents: int = SAMPLE_DOCUMENTS, slack: float = 3.0) -> DataFrame:
    """doc_id, lang_pred, score and rejected of each row of `docs`; `trains` marks rows that may be learned from."""
    return _predicted(docs, ["doc_id"], trains, order, documents, slack).withColumnRenamed("in_0", "doc_id")


def _model(docs: DataFrame, trains: Column | None, order: int, documents: int) -> tuple[LanguageModel | None, Calibration | None]:
    counted, held = training_rows(docs, F.lit(True) if trains is None else trains, documents)
    model = trained_model(gram_counts(counted, order), order)
    return model, calibrated(held, model) if model else None


def _predicted(docs: DataFrame, kept: list[str], trains: Column | None, order: int, documents: int, slack: float) -> DataFrame:
    """Columns in_0, in_1, ... (those of `kept`), lang_pred, score and rejected."""
    spark = docs.sparkSession
    python_tasks(spark)
    shared = spark.sparkContext.broadcast(_model(docs, trains, order, documents))  # bounded by the sample

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, calibration = shared.value
        for batch in batches:
            language, score, rejected = predictions(batch.column(batch.num_columns - 1), model, calibration, slack)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(language, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())],
                [*batch.schema.names[:-1], "lang_pred", "score", "rejected"])

    rows = docs.select(*[F.col(f"`{c}`").alias(f"in_{i}") for i, c in enumerate(kept)], text_column().alias("in_text"))
    fields = [f"in_{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(kept)]
    return rows.mapInArrow(predict, ", ".join([*fields, "lang_pred string, score double, rejected boolean"]))


def predictions(texts: pa.Array, model: LanguageModel | None, calibration: Calibration | None, slack: float) -> tuple[list[str], np.ndarray, np.ndarray]:
    if model is None:
        return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
    entropy, characters = scored_texts(texts, model)
    best = entropy.argmin(axis=1)
    lowest = entropy.min(axis=1, keepdims=True) if len(texts) else entropy[:, :1]
    # how likely the language is among all, by at most 40 characters' worth of evidence
    share = 1 / np.exp(-(entropy - lowest) * np.minimum(characters, 40)[:, None]).sum(axis=1)
    none = characters == 0
    rejected = none | calibration.rejects(lowest[:, 0], best, characters, slack)
    return [UNKNOWN if n else model.languages[b] for b, n in zip(best, none)], np.where(none, 0.0, share), rejected


def kept_by_language(docs: DataFrame, trains: Column | None = None, order: int = ORDER, documents: int = SAMPLE_DOCUMENTS, slack: float = 3.0) -> DataFrame:
    """The rows of `docs` that are not rejected, in their own columns, with the predicted language as lang."""
    found = _predicted(docs, docs.columns, trains, order, documents, slack).where("NOT rejected")
    return found.select(*[F.col("lang_pred" if c == "lang" else f"in_{i}").alias(c) for i, c in enumerate(docs.columns)])

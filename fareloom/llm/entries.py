"""The registered queries of this package, each over its whole table, and their check statements."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.llm import (
    langid, middle, mixing, neighbours, packing, partenum, pii, planes, quality, secret_scan, spellings, substrings, vector_dedup,
)
from fareloom.llm.frames import crc_remainder, table

Query = Callable[[SparkSession, str], DataFrame]

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def op1_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data_report(table(spark, sf_dir, "documents"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_copies(table(spark, sf_dir, "documents"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = langid.identified(table(spark, sf_dir, "documents"), trains=crc_remainder(3) != 1)
    return found.select("doc_id", (crc_remainder(3) == 1).alias("held_out"), "lang_pred", "score", "rejected")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substrings.deduplicated(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partenum.linked_documents(table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), trains=crc_remainder(5) != 0)
    return scores.select("doc_id", (crc_remainder(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op7_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), VOCABULARY, public_tokenizers.PATTERN)


def op8_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_report(table(spark, sf_dir, "documents"))


def op10_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def fim_report(docs: DataFrame) -> DataFrame:
    made = middle.transformed(docs)
    back = middle.restored(F.col("output"), F.col("form"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(back, 256).alias("restored_sha256"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim_report(table(spark, sf_dir, "documents"))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = planes.write_corpus(table(spark, sf_dir, "documents"), WORD_VOCABULARY, end_id=2)
    return planes.read_corpus(spark, manifest)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spellings.spelling_variants(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_personal_data": op1_personal_data,
    "op2_mix_sources": op2_mix_sources,
    "op3_language": op3_language,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_ngram_jaccard": op5_ngram_jaccard,
    "op6_quality": op6_quality,
    "op7_pack_sequences": op7_pack_sequences,
    "op8_nearest_vectors": op8_nearest_vectors,
    "op9_secrets": op9_secrets,
    "op10_vector_dedup": op10_vector_dedup,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_token_files": op12_token_files,
    "op13_spelling_variants": op13_spelling_variants,
}

MIX_SQL = r"""
WITH measured AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         coalesce(((doc_id % 1024) + 1024) % 1024, 0) AS bucket
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [3.0, 1.0, 2.0][(row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight
  FROM measured GROUP BY source
), filling AS (
  SELECT *, source_size * 2.0::DOUBLE AS volume, CAST(sum(source_size) OVER () AS DOUBLE) * 1.5::DOUBLE AS wanted,
         coalesce(sum(source_size * 2.0::DOUBLE) OVER w, 0) AS filled, sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS open
  FROM sources
  WINDOW w AS (ORDER BY source_size * 2.0::DOUBLE / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), aims AS (
  SELECT source, source_size, least(volume, max((wanted - filled) / open) OVER () * weight) AS target FROM filling
), ranked AS (
  SELECT m.doc_id, m.source, m.size, a.source_size, a.target,
         CASE WHEN a.source_size > 0 THEN a.target / a.source_size ELSE 0 END AS rate,
         CAST(row_number() OVER (PARTITION BY m.source ORDER BY m.size, m.bucket, m.doc_id NULLS FIRST) AS DOUBLE) AS place,
         CAST(('0x' || substr(md5('mix' || coalesce(m.source, '')), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE AS shift
  FROM measured m JOIN aims a ON m.source IS NOT DISTINCT FROM a.source
)
SELECT doc_id, source, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(floor(rate * place + shift) - floor(rate * (place - 1) + shift) AS BIGINT) AS copies,
       CAST((floor(rate * place + shift) - floor(rate * (place - 1) + shift)) * size AS BIGINT) AS taken
FROM ranked
"""

ORACLES: dict[str, str] = {"op2_mix_sources": MIX_SQL}

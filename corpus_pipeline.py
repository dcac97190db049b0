"""From raw documents to token ids: quality rules, near-duplicates, benchmark decontamination, byte-pair encoding.

Each stage is (name, function); the function takes (spark, docs, sf_dir) and
works on all that its predecessor kept. ``run`` writes each stage's rows as
Parquet under the shared scratch folder and reads them again, so a lost
executor costs the running stage at most. All stages but the last return the
columns of documents.

A document is dropped if the quality rules reject it, if it is not the first
of its group of near copies (five-word shingles, similarity 0.8), or if it
holds a benchmark item. The last stage gives doc_id, n_tokens, ids_sha256 and
decoded_sha256 of the documents that are left.

Rows: null and empty texts have no words and go with the first stage, as do
texts of fewer than 50 words. Very long texts are treated whole. Rows that are
equal in text are near copies: the one of the least doc_id stays, of rows that
repeat a doc_id and a text any one. Columns other than doc_id and
text pass through unread, whatever their names. Empty tables of documents,
labels or benchmark items give an empty result, or leave their stage without
effect.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from period_etl.llm.bpe import bpe_digest
from period_etl.llm.common import stored, table
from period_etl.llm.decontam import without_leaks
from period_etl.llm.near_dup import keep_one
from period_etl.llm.quality import fit_line_field, keep_quality
from period_etl.llm.queries import tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_quality(docs, fit_line_field(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs, k=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe_digest(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("bpe", encode),
]

#: The line field's training and the tokenizer can't be expressed in SQL; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

"""Corpus pipeline: language ID, line dedup, near-duplicate removal, decontamination, BPE tokens.

Each stage takes the documents that its predecessor kept and returns documents
with the same columns; the last one returns token ids and the text decoded from
them. A null text counts as empty and has no language, so it goes in the first
stage; rows that repeat id and text become one in the second; of rows with equal
texts and ids one stays; an empty table gives no rows. Stages are written as Parquet in the shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewater.llm import bpe, decontam, language_id, line_dedup, ngram_join
from tidewater.llm.common import documents, materialize
from tidewater.llm.queries import vocabulary


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; ``lang`` is the declaration, ``source`` the host."""
    model = language_id.fit(docs)
    found = language_id.identify(docs, model, declared=F.col("lang"), host=F.col("source"))
    return found.where("lang_kept").select(*docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without lines that are similar to an earlier line, short ones too; ``n_chars`` follows the text.

    A document that keeps less than a fifth of its words goes as a whole: a near
    copy (0.8 on five-word shingles) has at most a ninth of its words in rewritten
    lines, or about a fifth in short lines with one changed word.
    """
    return line_dedup.dedup_lines(docs, min_words=1, least_left=(1, 5)).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, the one with the smallest id."""
    return ngram_join.one_of_each(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    found = decontam.contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), out_col="__tw_hits")
    return found.where(F.size("__tw_hits") == 0).select(*docs.columns)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens and the decoded text."""
    return bpe.encode_decode(docs, vocabulary(), bpe.build_lexicon(docs))


STAGES = [("language_id", language_stage), ("line_dedup", line_stage), ("ngram_join", near_duplicate_stage),
          ("decontam", benchmark_stage), ("bpe_codec", token_stage)]

#: language posteriors, the lines' similarity join and the merges have no SQL form; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs

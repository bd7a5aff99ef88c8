"""Registered queries of the training-data operators and their DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import bpe, conversation_repair, decontam, hard_negatives, language_id, line_dedup, ngram_join, pieces, quality, suffix_dedup, token_files, warc
from .common import documents
from .exact_dedup import exact_dedup

#: folder of the public vocabularies (a parameter of every operator that takes one)
WORD_BPE = "word_bpe_49k.json"
PIECE_BPE = "piece_bpe_32k.model"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLE[name] = oracle
        return fn
    return register


@_query("op1_language_id")
def op1_language_id(spark, sf_dir):
    """All documents: text, declared language and the priors of their source."""
    docs = documents(spark, sf_dir)
    got = language_id.identify(docs, language_id.fit(docs), declared=F.col("lang"), host=F.col("source"))
    return got.select("doc_id", "lang_id", F.round("lang_confidence", 6).alias("confidence"), "lang_kept")


@_query("language_id_pages")
def language_id_pages(spark, sf_dir):
    """All pages: markup text, declared markup language, address suffix and host; texts learnt from documents."""
    model = language_id.fit(documents(spark, sf_dir))
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    host = language_id.address_host(F.col("url"))
    pages = pages.select("page_id", language_id.markup_text(F.col("html")).alias("text"), host.alias("host"),
                         language_id.markup_language(F.col("html")).alias("declared"))
    got = language_id.identify(pages, model, declared=F.col("declared"), host=F.col("host"),
                               suffix=language_id.address_suffix(F.col("host")))
    return got.select("page_id", "host", "declared", "lang_id", F.round("lang_confidence", 6).alias("confidence"), "lang_kept")


@_query("op2_suffix_dedup")
def op2_suffix_dedup(spark, sf_dir):
    """All documents without the 400-byte strings that occur twice."""
    return suffix_dedup.remove_repeats(documents(spark, sf_dir), keep_text=False).drop("kept")


@_query("op3_exact_dedup", r"""
WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM t JOIN g USING (text_sha256)""")
def op3_exact_dedup(spark, sf_dir):
    """Copies among all documents."""
    return exact_dedup(documents(spark, sf_dir))


def vocabulary(name: str = WORD_BPE) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@_query("op4_ngram_join")
def op4_ngram_join(spark, sf_dir):
    """All documents: classes of texts with Jaccard similarity 0.8 or more on five-word shingles."""
    return ngram_join.ngram_join(documents(spark, sf_dir)).select("doc_id", "class_id", "class_size", "n_links", "kept")


@_query("op5_decontam")
def op5_decontam(spark, sf_dir):
    """All documents against the whole benchmark."""
    return decontam.contamination_report(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@_query("op6_quality")
def op6_quality(spark, sf_dir):
    """All documents; a document's site is its source, its path the language section of the source."""
    docs = documents(spark, sf_dir)
    got = quality.classify(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), F.col("source"), F.col("lang"))
    return got.select("doc_id", *[F.round(c, 6).alias(c) for c in ("quality", "host_prior", "path_prior")], "keep")


@_query("op7_token_files")
def op7_token_files(spark, sf_dir):
    """All documents as token-id files, described from the files."""
    return token_files.token_digest(documents(spark, sf_dir), vocabulary(), end_id=1)


@_query("op8_bpe_codec")
def op8_bpe_codec(spark, sf_dir):
    """All documents encoded and decoded."""
    return bpe.codec_digest(documents(spark, sf_dir), vocabulary())


@_query("op9_warc")
def op9_warc(spark, sf_dir):
    """All pages written as WARC records and read back."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return warc.archive(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@_query("op10_line_dedup")
def op10_line_dedup(spark, sf_dir):
    """All lines of all documents, whatever their length."""
    return line_dedup.line_report(documents(spark, sf_dir), min_words=1)


@_query("op11_hard_negatives", """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, list_inner_product(a.e, b.e)::BIGINT AS score
      FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, other AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other)
QUALIFY row_number() OVER w <= 10""")
def op11_hard_negatives(spark, sf_dir):
    """All rows against the anchors, with the label of every seventh id off by one."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    return hard_negatives.hard_negatives(rows, label=label)


@_query("op12_conversation_repair")
def op12_conversation_repair(spark, sf_dir):
    """All conversations after damage that depends on a checksum of conversation and turn."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    place = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    hit = F.crc32(place.cast("binary")) % 20
    text = F.coalesce("text", F.lit(" "))
    rows = rows.select("conv_id", "turn", F.when(hit == 4, "user").otherwise(F.col("role")).alias("role"),
                       F.when(hit == 1, "").when(hit == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
                       F.when(hit == 0, 0).when(hit == 3, 2).otherwise(1).alias("copies"))
    return conversation_repair.repair(rows, copies=F.col("copies"))


@_query("op13_sentencepiece")
def op13_sentencepiece(spark, sf_dir):
    """All documents encoded with an end id and decoded."""
    got = pieces.encode_decode(documents(spark, sf_dir), vocabulary(PIECE_BPE))
    ids = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return got.select("doc_id", "n_tokens", F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))

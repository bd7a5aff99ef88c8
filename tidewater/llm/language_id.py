"""Language identification by fusing evidence with Bayes' rule.

Per document and language, log P(text | language) from a byte-trigram model,
log P(declared language | language) from the markup or metadata, and the log of
a host prior are added and normalised. The host prior is hierarchical: the
host's language counts are shrunk toward those of its address suffix, which are
shrunk toward the corpus, each by ``strength`` pseudo-documents. Counts are soft
(text posteriors), come from one grouped aggregation over all documents, and a
document's own share is taken out of its host's before it is judged.

Scale: the text is read twice (once for the counts, once for the answer) and
never shuffled unless the table of hosts is too large for Spark to broadcast;
that table is written first, so the choice is made on its measured size. A hot
host is one row of the aggregate after map-side combine.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import prepare, chunks, column_bytes, materialize, text_or_empty

#: hashed byte trigrams of the text model
FEATURES = 1 << 15

_CANON = np.full(256, 32, np.uint8)
_CANON[97:123] = np.arange(97, 123)
_CANON[65:91] = np.arange(97, 123)
_CANON[128:] = np.arange(128, 256)


def _trigrams(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Feature of the trigram at each byte; FEATURES where there is none (end of text, no letter)."""
    low = _CANON[data].astype(np.uint32)
    out = np.full(len(low), FEATURES, np.int64)
    if len(low) > 2:
        code = low[:-2] << np.uint32(16) | low[1:-1] << np.uint32(8) | low[2:]
        feature = ((code * np.uint32(2654435761)) >> np.uint32(17)).astype(np.int64)
        out[:-2] = np.where(code == 0x202020, FEATURES, feature)
        for back in (1, 2):
            at = off[1:] - back
            out[at[at >= 0]] = FEATURES
    return out


class LanguageModel:
    """log P(trigram | language) for each language; FEATURES x languages floats, so it may be broadcast."""

    def __init__(self, labels: list[str], counts: np.ndarray, alpha: float = 0.05):
        self.labels = labels
        share = counts + alpha
        table = np.log(share / share.sum(axis=0))
        self.table = np.vstack([table - table.mean(axis=1, keepdims=True), np.zeros((1, len(labels)))]).astype(np.float32)

    def scores(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Summed log likelihood per document and language, up to a constant; last column: trigrams counted."""
        out = np.zeros((len(off) - 1, len(self.labels) + 1))
        full = off[1:] > off[:-1]
        if not full.any():
            return out
        feature = _trigrams(data, off)
        heads = off[:-1][full]
        for k in range(len(self.labels)):
            out[full, k] = np.add.reduceat(self.table[:, k][feature].astype(np.float64), heads)
        out[full, -1] = np.add.reduceat((feature < FEATURES).astype(np.int64), heads)
        return out


def fit(df: DataFrame, label_col: str = "lang", id_col: str = "doc_id", text_col: str = "text",
        sample_per_label: int = 1000, min_rows: int = 1) -> LanguageModel:
    """Trigram counts of about ``sample_per_label`` whole texts of each label, chosen by a hash of the id.

    The sample is the documented bound of the fit. A label is a primary tag in
    lower case with at least ``min_rows`` rows; null labels are not used. With
    no label at all the model has the one language ``und``.
    """
    prepare(df.sparkSession)
    rows = df.select(primary_tag(F.col(label_col)).alias("label"), F.col(id_col).cast("long").alias("id"),
                     text_or_empty(text_col).alias("text")).where("label IS NOT NULL")
    sizes = {r.label: r.n for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_rows).collect()}
    labels = sorted(sizes)
    if not labels:
        return LanguageModel(["und"], np.zeros((FEATURES, 1)))
    scale = 1 << 20
    cut = F.create_map(*[x for l in labels for x in
                         (F.lit(l), F.lit(math.ceil(scale * min(1.0, sample_per_label / sizes[l]))))])
    sample = rows.where(F.pmod(F.xxhash64("id"), F.lit(scale)) < F.element_at(cut, F.col("label")))

    def count(batches):
        table = np.zeros((len(labels), FEATURES + 1), np.int64)
        index = {l: k for k, l in enumerate(labels)}
        for batch in batches:
            which = np.array([index[x] for x in batch.column(0).to_pylist()], np.int64)
            data, off = column_bytes(batch.column(1))
            for i, j, part, po in chunks(data, off):
                key = _trigrams(part, po) + np.repeat(which[i:j], np.diff(po)) * (FEATURES + 1)
                table += np.bincount(key, minlength=table.size).reshape(table.shape)
        label, feature = np.nonzero(table[:, :FEATURES])
        yield pa.RecordBatch.from_arrays([pa.array(label, pa.int32()), pa.array(feature, pa.int32()),
                                          pa.array(table[label, feature])], names=["label", "feature", "n"])

    counted = (sample.select("label", "text").mapInArrow(count, "label int, feature int, n long")
               .groupBy("label", "feature").agg(F.sum("n").alias("n")).toPandas())
    counts = np.zeros((FEATURES, len(labels)))
    counts[counted.feature, counted.label] = counted.n
    return LanguageModel(labels, counts)


def primary_tag(col: Column) -> Column:
    """``en`` of ``en-GB`` or ``EN_us``; null where there is none."""
    return F.nullif(F.lower(F.regexp_extract(col.cast("string"), r"^\s*([A-Za-z]{2,8})(?:[-_\s]|$)", 1)), F.lit(""))


def _scorer(model: LanguageModel):
    @F.arrow_udf("array<double>")
    def score(text: pa.Array) -> pa.Array:
        data, off = column_bytes(text)
        parts = [model.scores(part, po) for _, _, part, po in chunks(data, off)]
        flat = np.concatenate(parts) if parts else np.zeros((0, len(model.labels) + 1))
        width = flat.shape[1]
        return pa.ListArray.from_arrays(pa.array(np.arange(len(flat) + 1) * width, pa.int32()), pa.array(flat.ravel()))

    # so that a filter on the answer is not pushed below the scores, which would compute them twice in one task
    return score.asNondeterministic()


def _softmax(logs: Column) -> Column:
    top = F.array_max(logs)
    weights = F.transform(logs, lambda x: F.exp(x - top))
    total = F.aggregate(weights, F.lit(0.0), lambda a, x: a + x)
    return F.transform(weights, lambda x: x / total)


def identify(df: DataFrame, model: LanguageModel, text_col: str = "text", declared: Column | None = None,
             host: Column | None = None, suffix: Column | None = None, temper: float = 1 / 3,
             strength: float = 20.0, min_confidence: float = 0.5, min_trigrams: int = 1) -> DataFrame:
    """``df`` with ``lang_id``, ``lang_confidence`` and ``lang_kept`` added.

    ``temper`` discounts the text's log likelihood, as its trigrams overlap.
    Evidence that is null or names no known language is left out; a null host
    or suffix is a level of its own. A text with fewer than ``min_trigrams``
    trigrams with a letter (a null or empty one too) is ``und`` with confidence
    0 and not kept; others are kept from ``min_confidence`` on. Every row,
    repeated or not, is answered; ties go to the first label in order; an empty
    table stays empty. Columns of ``df`` called like the added ones are replaced.
    """
    prepare(df.sparkSession)
    labels, width = model.labels, len(model.labels)
    names = F.array(*[F.lit(l) for l in labels])
    score = _scorer(model)
    null = F.lit(None).cast("string")
    scored = df.select("*", F.struct(
        score(text_or_empty(text_col)).alias("s"),
        primary_tag(declared if declared is not None else null).alias("declared"),
        F.coalesce((host if host is not None else null).cast("string"), F.lit("")).alias("host"),
        F.coalesce((suffix if suffix is not None else null).cast("string"), F.lit("")).alias("suffix")).alias("__tw"))
    text_logs = F.transform(F.slice("__tw.s", 1, width), lambda x: x * temper)
    enough = F.element_at("__tw.s", width + 1) >= min_trigrams
    share = F.when(enough, _softmax(text_logs)).otherwise(F.array_repeat(F.lit(0.0), width))

    # soft counts by host, declared tag and suffix: one pass, combined on the map side
    known = F.when(F.array_contains(names, F.col("__tw.declared")), F.col("__tw.declared"))
    part = scored.select("__tw.host", "__tw.suffix", known.alias("declared"), share.alias("p"))
    sums = [F.sum(F.col("p")[k]).alias(f"c{k}") for k in range(width)]
    cells = materialize(part.groupBy("host", "suffix", "declared").agg(*sums), "language-cells")
    again = [F.sum(f"c{k}").alias(f"c{k}") for k in range(width)]
    total = cells.agg(*again).first()
    corpus = [(total[k] or 0.0) for k in range(width)]
    base = [(c + 1.0) / (sum(corpus) + width) for c in corpus]
    says = {r.declared: [r[f"c{k}"] for k in range(width)]
            for r in cells.where("declared IS NOT NULL").groupBy("declared").agg(*again).collect()}
    column = [sum(says[d][k] for d in says) for k in range(width)]
    logs = {d: [math.log((says[d][k] + (5.0 if d == l else 0.5)) / (column[k] + 5.0 + 0.5 * (width - 1)))
                for k, l in enumerate(labels)] for d in says}

    def shrunk(counts: list[Column], prior: list[Column]) -> list[Column]:
        n = sum(counts[1:], counts[0])
        return [(c + strength * p) / (n + strength) for c, p in zip(counts, prior)]

    by_suffix = cells.groupBy("suffix").agg(*again)
    by_suffix = by_suffix.select("suffix", F.array(*shrunk([F.col(f"c{k}") for k in range(width)],
                                                           [F.lit(b) for b in base])).alias("sp"))
    by_host = cells.groupBy("host", "suffix").agg(*again)
    hosts = materialize(by_host.join(by_suffix, "suffix").select(
        F.struct("host", "suffix").alias("__tw_site"), F.array(*[f"c{k}" for k in range(width)]).alias("__tw_counts"),
        F.col("sp").alias("__tw_prior")), "language-hosts")

    joined = (scored.withColumn("__tw_share", share).withColumn("__tw_logs", text_logs).withColumn("__tw_enough", enough)
              .join(hosts, F.struct(F.col("__tw.host"), F.col("__tw.suffix")) == F.col("__tw_site"), "left"))
    others = F.zip_with("__tw_counts", "__tw_share", lambda c, p: F.greatest(c - p, F.lit(0.0)))
    n = F.aggregate("__tw_others", F.lit(0.0), lambda a, x: a + x)
    prior = F.zip_with("__tw_others", "__tw_prior", lambda c, p: (c + F.lit(strength) * p) / (F.col("__tw_n") + F.lit(strength)))
    tag = F.create_map(*[x for d in sorted(logs) for x in (F.lit(d), F.array(*[F.lit(v) for v in logs[d]]))]) if logs else None
    fused = F.zip_with("__tw_logs", "__tw_p", lambda a, p: a + F.log(p))
    if tag is not None:
        said = F.coalesce(F.try_element_at(tag, F.col("__tw.declared")), F.array_repeat(F.lit(0.0), width))
        fused = F.zip_with(fused, said, lambda a, b: a + b)
    out = (joined.withColumn("__tw_others", others).withColumn("__tw_n", n).withColumn("__tw_p", prior)
           .withColumn("__tw_post", _softmax(fused)).withColumn("__tw_top", F.array_max("__tw_post")))
    best = F.element_at(names, F.array_position("__tw_post", F.col("__tw_top")).cast("int"))
    keep = [c for c in df.columns if c not in ("lang_id", "lang_confidence", "lang_kept")]
    return out.select(*[F.col(f"`{c}`") for c in keep],
                      F.when(F.col("__tw_enough"), best).otherwise("und").alias("lang_id"),
                      F.when(F.col("__tw_enough"), F.col("__tw_top")).otherwise(0.0).alias("lang_confidence"),
                      (F.col("__tw_enough") & (F.col("__tw_top") >= min_confidence)).alias("lang_kept"))


def address_host(url: Column) -> Column:
    """The host of an address, in lower case; null where there is none."""
    return F.nullif(F.lower(F.regexp_extract(url.cast("string"), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


def address_suffix(host: Column) -> Column:
    """The last label of a host name; null for a bare name or a number."""
    return F.nullif(F.regexp_extract(host, r"\.([a-z][a-z0-9-]*)\.?$", 1), F.lit(""))


def markup_language(html: Column) -> Column:
    """The language that a page's root element declares."""
    return F.nullif(F.regexp_extract(html.cast("string"), r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z][A-Za-z0-9_-]*)", 1), F.lit(""))


def markup_text(html: Column) -> Column:
    """A page's text for the model: scripts, styles, tags and entities become spaces."""
    return F.regexp_replace(F.coalesce(html.cast("string"), F.lit("")),
                            r"(?is)<(script|style)\b.*?</\1\s*>|<[^>]*>|&#?\w+;", " ")

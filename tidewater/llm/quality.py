"""Quality classifier with hierarchical empirical Bayes over sites.

A logistic regression on the text (fitted on a bounded sample of labelled rows)
gives each document's log Bayes factor for good against bad. It sees surface
statistics and two content scores: the mean log odds of the text's words and of its
byte trigrams, from hashed counts by label. A document of the sample is scored with the
counts of the other half of the sample, so its own label is not in its score. Sites give the prior: the expected share of good documents of a
path is shrunk toward its host's, the host's toward the corpus, with pseudo
counts estimated from how much sites differ beyond chance (method of moments).
A labelled document counts with its label, others with the classifier's
probability; a document's own share is taken out before it is judged.

Scale: the text is read once and reduced to some twenty numbers a row (the
sample's texts are read once more for the counts, which are tables of fixed
size); joins and grouped aggregates work on those rows only, and a hot host is one row per map
task before the shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import SPACE, prepare, chunks, column_bytes, materialize, mix, span_hash, text_or_empty, word_spans
from . import language_id

FEATURES = ("letters", "capitals", "digits", "signs", "marks", "bars", "spaces", "log_words", "word_length", "repeats",
            "variety", "shouted", "lines")
#: slots of the hashed words, and of the hashed byte trigrams
WORDS, GRAMS = 1 << 16, language_id.FEATURES


def surface(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """The FEATURES of each document (all zero for an empty one)."""
    n = len(off) - 1
    out = np.zeros((n, len(FEATURES)))
    size = np.diff(off)
    full = size > 0
    if not full.any():
        return out
    heads = off[:-1][full]

    def share(mask, of=size[full]):
        return np.add.reduceat(mask.astype(np.int64), heads) / np.maximum(of, 1)

    capital = (data >= 65) & (data <= 90)
    letter = capital | ((data >= 97) & (data <= 122)) | (data >= 128)
    letters = np.add.reduceat(letter.astype(np.int64), heads)
    out[full, 0] = letters / size[full]
    out[full, 1] = share(capital, letters)
    out[full, 2] = share((data >= 48) & (data <= 57))
    out[full, 3] = share((data == 35) | (data == 36) | (data == 37) | (data == 38) | (data == 42) | (data == 64))
    out[full, 4] = share((data == 33) | (data == 63))
    out[full, 5] = share((data == 124) | (data == 95) | (data == 61))
    out[full, 6] = share(SPACE[data])
    starts, lens, first = word_spans(data, off)
    words = np.diff(first)
    some = words > 0
    if some.any():
        wh = span_hash(data, starts, lens)
        doc = np.repeat(np.arange(n), words)
        at = first[:-1][some]
        same = np.zeros(len(wh), bool)
        same[1:] = (wh[1:] == wh[:-1]) & (doc[1:] == doc[:-1])
        caps = np.concatenate([[0], np.cumsum(capital)])
        loud = (caps[starts + lens] - caps[starts] >= 2) & (lens >= 2)
        out[some, 7] = np.log1p(words[some])
        out[some, 8] = np.add.reduceat(lens, at) / words[some]
        out[some, 9] = np.add.reduceat(same.astype(np.int64), at) / words[some]
        key = np.unique(mix(wh ^ mix(doc.astype(np.uint64))), return_index=True)[1]
        out[some, 10] = (np.bincount(doc[key], minlength=n)[some] + 1) / (words[some] + 1) ** 0.85
        out[some, 11] = np.add.reduceat(loud.astype(np.int64), at) / words[some]
    out[full, 12] = np.log1p(np.add.reduceat((data == 10).astype(np.int64), heads))
    return out


def tokens(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed words and byte trigrams of documents: (slot below WORDS + GRAMS, document)."""
    starts, lens, first = word_spans(data, off)
    word = (span_hash(data, starts, lens) >> np.uint64(48)).astype(np.int64)
    gram = language_id._trigrams(data, off)
    real = gram < GRAMS
    docs = np.arange(len(off) - 1)
    return (np.concatenate([word, WORDS + gram[real]]),
            np.concatenate([np.repeat(docs, np.diff(first)), np.repeat(docs, np.diff(off))[real]]))


class Content:
    """Log odds of words and trigrams for good against bad: one column from all the sample, one without each half of it."""

    def __init__(self, counts: np.ndarray, alpha: float = 0.5):
        """``counts``: half, label, slot."""
        self.table = np.zeros((WORDS + GRAMS, 3), np.float32)
        for k, part in enumerate((counts.sum(axis=0), counts[1], counts[0])):
            for a, b in ((0, WORDS), (WORDS, WORDS + GRAMS)):
                share = (part[:, a:b] + alpha) / (part[:, a:b].sum(axis=1, keepdims=True) + alpha * (b - a))
                self.table[a:b, k] = np.log(share[1] / share[0])

    def scores(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Six numbers a document: mean log odds of words and of trigrams by the three columns (0 where there are none)."""
        n = len(off) - 1
        out = np.zeros((n, 6))
        slot, doc = tokens(data, off)
        for kind, mask in enumerate((slot < WORDS, slot >= WORDS)):
            size = np.maximum(np.bincount(doc[mask], minlength=n), 1)
            for k in range(3):
                out[:, 2 * k + kind] = np.bincount(doc[mask], self.table[slot[mask], k], n) / size
        return out


def fit_content(sample: DataFrame) -> Content:
    """Counts by half, label and slot of a bounded sample of rows (text, half, good); the driver gets the tables of fixed size."""

    def count(batches):
        table = np.zeros((2, 2, WORDS + GRAMS), np.int64)
        for batch in batches:
            half, good = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in (1, 2))
            data, off = column_bytes(batch.column(0))
            for i, j, part, po in chunks(data, off):
                slot, doc = tokens(part, po)
                key = ((half[i:j] * 2 + good[i:j]) * (WORDS + GRAMS))[doc] + slot
                table += np.bincount(key, minlength=table.size).reshape(table.shape)
        at = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(table.ravel()[at])], names=["at", "n"])

    got = (sample.select("text", "half", "good").mapInArrow(count, "at long, n long")
           .groupBy("at").agg(F.sum("n").alias("n")).toPandas())
    counts = np.zeros(4 * (WORDS + GRAMS))
    counts[got["at"].to_numpy(np.int64)] = got["n"].to_numpy(float)
    return Content(counts.reshape(2, 2, -1))


def _features(content: Content):
    """A UDF: the FEATURES and the six content scores of a text."""
    width = len(FEATURES) + 6

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def features(text: pa.Array) -> pa.Array:
        data, off = column_bytes(text)
        parts = [np.column_stack([surface(part, po), content.scores(part, po)]) for _, _, part, po in chunks(data, off)]
        flat = np.concatenate(parts) if parts else np.zeros((0, width))
        return pa.ListArray.from_arrays(pa.array(np.arange(len(flat) + 1) * width, pa.int32()), pa.array(flat.ravel()))

    return features


class Logistic:
    """Ridge logistic regression by Newton steps, on standardised features."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 25):
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-9
        z = np.column_stack([np.ones(len(x)), (x - self.mean) / self.scale, ((x - self.mean) / self.scale) ** 2])
        w = np.zeros(z.shape[1])
        pull = np.full(len(w), ridge)
        pull[0] = 1e-6
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            slope = z.T @ (p - y) + pull * w
            bend = (z * (p * (1 - p))[:, None]).T @ z + np.diag(pull)
            w = w - np.linalg.solve(bend, slope)
        self.weights = w

    def column(self, features: Column) -> Column:
        """The log odds as a Spark expression over the array of features."""
        total = F.lit(float(self.weights[0]))
        k = len(self.mean)
        for i in range(k):
            z = (features[i] - F.lit(float(self.mean[i]))) / F.lit(float(self.scale[i]))
            total = total + z * F.lit(float(self.weights[1 + i])) + z * z * F.lit(float(self.weights[1 + k + i]))
        return F.least(F.greatest(total, F.lit(-30.0)), F.lit(30.0))


def _strength(n: float, cells: float, mean: float, second: float) -> float:
    """Pseudo counts of a level: how far shares of sites vary beyond chance (binomial), by the method of moments.

    ``second`` is the size-weighted sum of squared deviations from ``mean``.
    """
    chance = mean * (1 - mean)
    if cells < 2 or chance <= 0:
        return 100.0
    excess = (second - (cells - 1) * chance) / max(n - n / cells, 1.0)
    return float(min(1000.0, max(2.0, chance / excess - 1.0))) if excess > 0 else 1000.0


def classify(df: DataFrame, labels: DataFrame, host: Column, path: Column, id_col: str = "doc_id",
             text_col: str = "text", label_col: str = "quality", sample: int = 20_000, threshold: float = 0.5) -> DataFrame:
    """One row per row of ``df``: id, quality, evidence, host_prior, path_prior and keep.

    The counts of words and the regression are fitted on at most about ``sample`` labelled
    documents, chosen by a hash of the id (the documented bound); site counts cover all
    rows. A null host or path is a site of its own; a null or empty text has all
    features zero and is judged like others; a repeated id gives repeated rows,
    and several labels of an id count with their mean. Without labels of both
    kinds the regression is flat and only the prior speaks. An empty table gives
    no rows. Other columns are not read.
    """
    prepare(df.sparkSession)
    known = materialize(labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("double").alias("y"))
                        .dropna().groupBy("id").agg(F.avg("y").alias("y")), "quality-labels")
    texts = df.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    n = texts.select("id").join(known, "id").count()
    scale = 1 << 20
    cut = int(scale * min(1.0, sample / max(n, 1)))
    chosen = F.pmod(F.xxhash64("id"), F.lit(scale)) < cut
    half = F.pmod(F.xxhash64("id", F.lit("half")), F.lit(2))
    content = fit_content(texts.where(chosen).join(known, "id").select("text", half.alias("half"), (F.col("y") >= 0.5).cast("long").alias("good")))

    slim = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(host.cast("string"), F.lit("")).alias("host"),
                     F.coalesce(path.cast("string"), F.lit("")).alias("path"),
                     _features(content)(text_or_empty(text_col)).alias("f"))
    k = len(FEATURES)
    column = F.when(F.col("y").isNotNull() & chosen, 1 + half).otherwise(0)  # the scores of others' labels
    x = F.concat(F.slice("f", 1, k), F.slice("f", (k + 1 + 2 * column).cast("int"), F.lit(2)))
    rows = materialize(slim.join(known, "id", "left").select("id", "host", "path", "y", x.alias("x")), "quality-rows")
    got = rows.where("y IS NOT NULL").where(chosen).select("x", "y").toPandas()
    y = got.y.to_numpy(float)
    if len(y) and 0 < (y >= 0.5).sum() < len(y):
        x = np.array(got.x.tolist(), float)
        model = Logistic(x, (y >= 0.5).astype(float))
        odds = model.column(F.col("x"))
        base = float(np.log((y >= 0.5).mean() / (y < 0.5).mean()))
    else:
        odds, base = F.lit(0.0), 0.0
    rows = rows.withColumn("odds", odds)
    share = F.coalesce(F.col("y"), 1 / (1 + F.exp(-F.col("odds"))))
    rows = rows.select("id", "host", "path", (F.col("odds") - F.lit(base)).alias("evidence"), share.alias("share"))

    cells = materialize(rows.groupBy("host", "path").agg(F.sum("share").alias("good"), F.count(F.lit(1)).alias("n")), "quality-sites")
    hosts = cells.groupBy("host").agg(F.sum("good").alias("h_good"), F.sum("n").alias("h_n"))
    whole = cells.agg(F.sum("good"), F.sum("n")).first()
    mean = ((whole[0] or 0.0) + 1.0) / ((whole[1] or 0) + 2.0)
    spread = hosts.agg(F.sum("h_n"), F.count(F.lit(1)), F.sum(F.col("h_n") * (F.col("h_good") / F.col("h_n") - mean) ** 2)).first()
    k_host = _strength(spread[0] or 0, spread[1], mean, spread[2] or 0.0)
    within = cells.join(hosts, "host").agg(F.sum("n"), F.count(F.lit(1)), F.sum(
        F.col("n") * (F.col("good") / F.col("n") - F.col("h_good") / F.col("h_n")) ** 2)).first()
    k_path = _strength(within[0] or 0, within[1], mean, within[2] or 0.0)
    sites = materialize(cells.join(hosts, "host").select(F.struct("host", "path").alias("site"), "good", "n", "h_good", "h_n"),
                        "quality-priors")

    judged = rows.join(sites, F.struct(rows["host"], rows["path"]) == F.col("site"))
    h = (F.greatest(F.col("h_good") - F.col("share"), F.lit(0.0)) + k_host * mean) / (F.col("h_n") - 1 + k_host)
    judged = judged.withColumn("host_prior", h)
    p = (F.greatest(F.col("good") - F.col("share"), F.lit(0.0)) + k_path * F.col("host_prior")) / (F.col("n") - 1 + k_path)
    judged = judged.withColumn("path_prior", F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6)))
    logit = F.col("evidence") + F.log(F.col("path_prior") / (1 - F.col("path_prior")))
    quality = 1 / (1 + F.exp(-logit))
    return judged.select(F.col("id").alias(id_col), quality.alias("quality"), "evidence", "host_prior", "path_prior",
                         (quality >= threshold).alias("keep"))

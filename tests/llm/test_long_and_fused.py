"""Very long words in BPE, and the posteriors of language ID and quality recomputed in plain Python."""
import collections
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.llm import bpe, language_id, quality
from tidewater.llm.queries import vocabulary

SF = "/root/testdata/sf0.001"


def _raw(text):
    raw = np.frombuffer((text or "").encode(), np.uint8)
    return raw, np.array([0, len(raw)])


@pytest.mark.parametrize("ordered", [True, False])
def test_long_words_equal_short_merging(ordered):
    """Buckets of ranks give the ids of one merge a round, overlapping runs of one letter included."""
    merger, rnd = bpe.Merger(vocabulary()), random.Random(3)
    merger.ordered = merger.ordered and ordered
    for k in range(150 if ordered else 40):
        letters = rnd.choice(["a", "ab", "aab", "the and", "abcdefghijklmnopqrstuvwxyz", "aé日本"]).replace(" ", "")
        word = "".join(rnd.choice(letters) for _ in range(rnd.choice([1, 2, 3, 7, 30, 500])))
        raw, _ = _raw(word)
        want, n = merger._merge_short(raw, np.array([0]), np.array([len(raw)]))
        assert merger._merge_long(raw).tolist() == want.tolist() and n.tolist() == [len(want)]


def test_words_of_a_megabyte_equal_the_library():
    """Words long and short in one batch; a megabyte without a break takes seconds, not hours."""
    from tokenizers import Tokenizer
    ref, rnd = Tokenizer.from_file(vocabulary()), random.Random(5)
    texts = ["short words", "".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=1_000_000)), "", "tail " + "ab" * 400 + " end", "x" * 3000,
             "日本語" * 2000, "z" * bpe.LONG_WORD + " " + "z" * (bpe.LONG_WORD + 1)]
    raw = [t.encode() for t in texts]
    ids, bounds = bpe.Codec(vocabulary(), None).batch(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]))
    for k, text in enumerate(texts):
        assert ids[bounds[k]:bounds[k + 1]].tolist() == ref.encode(text, add_special_tokens=False).ids


def _softmax(logs):
    top = max(logs)
    weights = [math.exp(x - top) for x in logs]
    return [w / sum(weights) for w in weights]


def test_language_fusion_in_plain_python(spark):
    """Text, declared language, host and suffix priors (a document's own share taken out) fused one row at a time."""
    rows = [(r.doc_id, r.text, r.lang, r.source, r.source[-1]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows += [(None, None, None, None, None), (-1, "", "en", "src1", "1"), (-2, "123 456", "xx", None, "2"), (-3, "the and of the in", "DE-at", "new", None),
             rows[5], (-4, "of the and", None, rows[0][3], "other")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, tail string").repartition(3)
    model = language_id.fit(docs.where("doc_id >= 0"))
    labels, k = model.labels, len(model.labels)
    got = language_id.identify(docs, model, declared=F.col("lang"), host=F.col("source"), suffix=F.col("tail")).collect()
    texts = []
    for _, text, lang, host, tail in rows:
        *s, n = model.scores(*_raw(text))[0]
        logs = [x / 3 for x in s]
        tag = (lang or "").lower().split("-")[0]
        texts.append((logs, n >= 1, _softmax(logs) if n >= 1 else [0.0] * k, tag if tag in labels else None, host or "", tail or ""))
    zero = lambda: [0.0] * k
    by_host, by_suffix, by_tag, corpus = (collections.defaultdict(zero) for _ in range(4))
    for _, _, share, tag, host, tail in texts:
        for i, p in enumerate(share):
            by_host[host, tail][i] += p
            by_suffix[tail][i] += p
            corpus[""][i] += p
            if tag:
                by_tag[tag][i] += p
    total = sum(corpus[""])
    base = [(c + 1) / (total + k) for c in corpus[""]]
    said = {t: [math.log((c[i] + (5.0 if labels[i] == t else 0.5)) / (sum(by_tag[u][i] for u in by_tag) + 5.0 + 0.5 * (k - 1))) for i in range(k)]
            for t, c in by_tag.items()}
    want = collections.Counter()
    for (doc, *_), (logs, enough, share, tag, host, tail) in zip(rows, texts):
        suffix = [(c + 20 * b) / (sum(by_suffix[tail]) + 20) for c, b in zip(by_suffix[tail], base)]
        others = [max(c - p, 0.0) for c, p in zip(by_host[host, tail], share)]
        prior = [(c + 20 * q) / (sum(others) + 20) for c, q in zip(others, suffix)]
        post = _softmax([a + math.log(q) + (said[tag][i] if tag else 0.0) for i, (a, q) in enumerate(zip(logs, prior))])
        top = max(post)
        want[(doc, labels[post.index(top)] if enough else "und", round(top, 6) if enough else 0.0, enough and top >= 0.5)] += 1
    assert collections.Counter((r.doc_id, r.lang_id, round(r.lang_confidence, 6), r.lang_kept) for r in got) == want


def test_quality_priors_in_plain_python(spark):
    """Strengths of hosts and paths, shrunken priors without a row's own share, and the posterior, from each row's evidence."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source")
    docs = docs.unionByName(docs.where("doc_id < 3")).unionByName(docs.where("doc_id < 2").select(
        F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text"), F.lit(None).cast("string").alias("lang"), F.lit(None).cast("string").alias("source")))
    labels = spark.read.parquet(f"{SF}/labels.parquet").where("doc_id % 3 < 2").cache()
    labels = labels.unionByName(labels.where("doc_id % 11 = 0"))
    y = {r.doc_id: float(r.quality) for r in labels.collect()}
    out = quality.classify(docs, labels, F.col("source"), F.col("lang")).collect()
    site = collections.defaultdict(list)
    for r in docs.collect():
        site[r.doc_id].append((r.source or "", r.lang or ""))
    assert collections.Counter(r.doc_id for r in out) == collections.Counter(i for i, v in site.items() for _ in v)
    known = [y[i] for i, v in site.items() if i in y for _ in v]
    odds = math.log(sum(known) / (len(known) - sum(known)))
    rows = [(r, *site[r.doc_id][0], y[r.doc_id] if r.doc_id in y else 1 / (1 + math.exp(-(r.evidence + odds)))) for r in out]
    hosts, paths = collections.defaultdict(list), collections.defaultdict(list)
    for _, host, path, share in rows:
        hosts[host].append(share)
        paths[host, path].append(share)
    mean = (sum(s for *_, s in rows) + 1) / (len(rows) + 2)

    def strength(cells, second):
        n, chance = len(rows), mean * (1 - mean)
        excess = (second - (cells - 1) * chance) / max(n - n / cells, 1.0)
        return min(1000.0, max(2.0, chance / excess - 1)) if excess > 0 else 1000.0

    avg = lambda v: sum(v) / len(v)
    k_host = strength(len(hosts), sum(len(v) * (avg(v) - mean) ** 2 for v in hosts.values()))
    k_path = strength(len(paths), sum(len(v) * (avg(v) - avg(hosts[h])) ** 2 for (h, _), v in paths.items()))
    for r, host, path, share in rows:
        h = (sum(hosts[host]) - share + k_host * mean) / (len(hosts[host]) - 1 + k_host)
        p = (sum(paths[host, path]) - share + k_path * h) / (len(paths[host, path]) - 1 + k_path)
        p = min(max(p, 1e-6), 1 - 1e-6)
        q = 1 / (1 + math.exp(-(r.evidence + math.log(p / (1 - p)))))
        assert (r.host_prior, r.path_prior, r.quality) == pytest.approx((h, p, q), abs=1e-6) and r.keep == (r.quality >= 0.5)


def test_content_scores_count_words_and_trigrams(spark):
    """Counts of halves and labels against one text at a time; a text is scored with the other half's counts where asked."""
    rows = [(f"good words here {k}", k % 2, 1) for k in range(9)] + [(f"BAD%% words | spam {k}", k % 2, 0) for k in range(7)] + [("", 0, 1), (None, 1, 0)]
    content = quality.fit_content(spark.createDataFrame(rows, "text string, half long, good long").repartition(3))
    counts = collections.defaultdict(collections.Counter)
    for text, half, good in rows:
        slot, _ = quality.tokens(*_raw(text))
        counts[half, good].update(slot.tolist())
    size = quality.WORDS + quality.GRAMS
    for column, halves in enumerate(((0, 1), (1,), (0,))):
        for a, b in ((0, quality.WORDS), (quality.WORDS, size)):
            all_ = [sum(v for h in halves for s, v in counts[h, g].items() if a <= s < b) + 0.5 * (b - a) for g in (0, 1)]
            for s in {s for c in counts.values() for s in c if a <= s < b}:
                bad, good = (sum(counts[h, g][s] for h in halves) + 0.5 for g in (0, 1))
                assert content.table[s, column] == pytest.approx(math.log(good / all_[1] * all_[0] / bad), abs=1e-5)
    good, bad = content.scores(*_raw("good here"))[0], content.scores(*_raw("BAD%% spam"))[0]
    assert (good > 0).all() and (bad < 0).all() and (content.scores(*_raw(""))[0] == 0).all()

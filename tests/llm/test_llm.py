"""Training-data operators against brute force on small tables with every awkward case."""
import base64
import collections
import hashlib
import random
import re
import tempfile
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.llm import (bpe, decontam, exact_dedup, language_id, line_dedup, ngram_join, quality, suffix_dedup,
                           token_files, warc)
from tidewater.llm.queries import ORACLE, QUERIES, vocabulary

SF = "/root/testdata/sf0.001"
_SPACE = re.compile(r"[ \t\n\r\x0b\x0c]+")


def _passage(seed, n):
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choice("aeioubcdfgst") for _ in range(rnd.randint(2, 9))) for _ in range(n))


def _near(text, seed):
    words = text.split(" ")
    words[random.Random(seed).randrange(len(words))] = f"changed{seed}"
    return " ".join(words)


BASE = _passage(1, 150)
ROWS = [
    (1, BASE, "en", "a"), (2, BASE, "en", "a"), (3, _near(BASE, 3), "en", "a"), (4, None, None, None), (5, "", "en", "b"),
    (6, "  \t\n ", "en", "b"), (7, "one two", "en", "b"), (8, "one two", "fr", "b"), (9, "x " * 3000, "en", "b"),
    (10, "head\n" + _passage(2, 40) + "\n" + _passage(3, 40), "de", "c"), (11, "other\n" + _near(_passage(2, 40), 5) + "\n\n", "de", "c"),
    (12, _passage(4, 30) + " " + BASE[100:700] + " " + _passage(5, 30), "en", "c"), (13, "ÀÉ it's ½ d'Été 'SD <|endoftext|> 한국 ́", "fr", None),
    (14, " ".join(_passage(s, 60) for s in range(20, 60)), "en", "a"), (None, "null id text with five words", "en", "a"),
    (15, _passage(9, 20), "en", "a"), (15, _passage(9, 20), "en", "a"), (15, _passage(10, 20), "en", "a"),
    *[(100 + k, _near(_passage(11, 80), k), "en", "a") for k in range(40)],
]


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls in every column, empty, blank, short and long texts, copies, repeated ids, and names that could clash."""
    rows = [(*r, 1, 2, 3, "x") for r in ROWS]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, row long, id long, k long, th string").repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def _texts():
    return [(i, t or "") for i, t, _, _ in ROWS]


def test_exact_dedup(docs, empty):
    rows = exact_dedup.exact_dedup(docs, block_bytes=64).collect()
    groups = collections.defaultdict(list)
    for i, t in _texts():
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t)].append(i)
    sha = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    assert len(rows) == len(ROWS)
    for r in rows:
        ids = sha[r.text_sha256]
        assert r.group_size == len(ids) and r.keep_id == min((i for i in ids if i is not None), default=None)
    assert sum(r.kept for r in rows) == len(groups)
    assert exact_dedup.exact_dedup(empty).count() == 0


def test_suffix_dedup(docs, empty):
    rows = suffix_dedup.remove_repeats(docs).collect()
    seen = collections.Counter(t[k:k + 400] for _, t in ((i, t.encode()) for i, t in _texts()) for k in range(len(t) - 399))
    want = []
    for i, t in ((i, t.encode()) for i, t in _texts()):
        gone = bytearray(len(t))
        for k in range(len(t) - 399):
            if seen[t[k:k + 400]] > 1:
                gone[k:k + 400] = b"\1" * 400
        kept = bytes(c for c, g in zip(t, gone) if not g)
        want.append((i or -1, len(t), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest(), kept))
    assert sorted((r.doc_id or -1, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept)) for r in rows) == sorted(want)
    assert suffix_dedup.remove_repeats(empty).count() == 0


def test_columnwise_construction_equals_sorting():
    rnd = random.Random(3)
    for _ in range(10):
        words = [[rnd.randint(1, 3) for _ in range(rnd.randint(0, 9))] for _ in range(rnd.randint(1, 12))]
        length = np.array([len(d) for d in words])
        with tempfile.TemporaryDirectory() as folder:
            bwt, doc, left, lcp = suffix_dedup.build(np.array([x for d in words for x in d], np.int64),
                                                     np.cumsum(length) - length, length, folder, step=5)
        got = [words[d][len(words[d]) - n:] for d, n in zip(doc, left)]
        assert got == sorted(words[d][len(words[d]) - n:] for d in range(len(words)) for n in range(len(words[d]) + 1))
        assert [b for b in bwt] == [words[d][-n - 1] if n < len(words[d]) else 0 for d, n in zip(doc, left)]
        for a, b, common in zip(got, got[1:], lcp[1:]):
            assert a[:common] == b[:common] and (a[common:common + 1] != b[common:common + 1] or len(a) == common)


def _shingles(text):
    w = [x for x in _SPACE.split(text) if x]
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def test_ngram_join(docs, empty, monkeypatch):
    monkeypatch.setattr(ngram_join, "TILE_DOCS", 16)        # a group of 40 near copies needs several tiles
    rows = ngram_join.ngram_join(docs).collect()
    sets = [(i, t, _shingles(t)) for i, t in _texts()]
    near = [[x != y and bool(a[2]) and 5 * len(a[2] & b[2]) >= 4 * len(a[2] | b[2]) for y, b in enumerate(sets)] for x, a in enumerate(sets)]
    root = list(range(len(sets)))
    for _ in sets:
        root = [min([root[x]] + [root[y] for y in range(len(sets)) if near[x][y]]) for x in range(len(sets))]
    want = []
    for x, (i, _, _) in enumerate(sets):
        ids = [sets[y][0] for y in range(len(sets)) if root[y] == root[x]]
        want.append((i or -1, min((v for v in ids if v is not None), default=-1), len(ids), sum(near[x])))
    got = [(r.doc_id or -1, r.class_id or -1, r.class_size, r.n_links) for r in rows]
    assert sorted(got) == sorted(want)
    assert sum(r.kept for r in rows) == len(set(root))
    assert ngram_join.ngram_join(empty).count() == 0
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(root))


def test_pruning_keeps_what_may_reach_the_threshold():
    least = ngram_join.least_matches(0.8, 1e-9)
    assert all(m < 0.8 * n for m, n in zip(least, range(16, 129, 16))) and least == sorted(least) and least[-1] > 50


def test_line_dedup(docs, empty, monkeypatch):
    monkeypatch.setattr(line_dedup, "TILE", 8)
    distinct = sorted({((i is None, i or 0), t) for i, t in _texts()}, key=lambda x: x[0])
    lines = [(d, n, frozenset(w for w in _SPACE.split(line) if w)) for d, t in enumerate(distinct) for n, line in enumerate(t[1].split("\n"))]
    lines = [x for x in lines if len(x[2]) >= 5]
    gone = collections.Counter()
    for a, (d, n, words) in enumerate(lines):
        gone[distinct[d]] += any(5 * len(words & v) >= 4 * len(words | v) for _, _, v in lines[:a])
    rows = line_dedup.line_report(docs, most=2, min_words=5).collect()
    want = sorted((k[0][1] if not k[0][0] else -1, k[1].count("\n") + 1, gone[k]) for k in distinct)
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_lines, r.n_removed) for r in rows)
    assert [x for x in got if x[0] != 15] == [x for x in want if x[0] != 15]     # an id with two texts: order is by a hash
    assert len(got) == len(want) and all(r.n_removed == len(r.removed) for r in rows)
    out = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs, min_words=5).collect()}
    assert 2 not in out and 3 not in out and out[11] == "other\n\n" and out[4] is None and out[5] == ""
    assert line_dedup.line_report(empty).count() == 0 and line_dedup.dedup_lines(empty).columns == docs.columns


def test_decontamination(spark, docs, empty):
    item, other = _passage(2, 40), _passage(77, 30)
    words = other.split(" ")
    words[7] = words[15] = "swapped"
    bench = spark.createDataFrame([(1, item), (2, other), (3, "tiny one"), (4, None), (None, BASE), (5, "one two three four five six")],
                                  "item_id long, text string")
    more = docs.unionByName(spark.createDataFrame(
        [(53, "a Tiny  ONE here", "en", "a", 1, 2, 3, "x"), (54, "one two three four", "en", "a", 1, 2, 3, "x"), (50, "Before, " + " ".join(words).upper() + "! after", "en", "a", 1, 2, 3, "x"), (51, "so One two THREE four, five six.", "en", "a", 1, 2, 3, "x"),
         (52, "one two three four five 6", "en", "a", 1, 2, 3, "x")], docs.schema))
    got = {r.doc_id: (r.contaminated, r.item_ids) for r in decontam.contamination_report(more, bench).collect()}
    assert {i for i, (c, _) in got.items() if c} == {10, 11, 50, 51, 52, 53}
    assert got[10][1] == [1] and got[50][1] == [2] and got[51][1] == [5] and got[53][1] == [3] and got[52][1] == [5]
    assert decontam.contamination_report(empty, bench).count() == 0
    assert decontam.contamination_report(docs, bench.where("false")).where("contaminated").count() == 0


def test_language_id_held_out(spark, docs, empty):
    all_docs = spark.read.parquet(f"{SF}/documents.parquet")
    train, test = all_docs.where("doc_id % 2 = 0"), all_docs.where("doc_id % 2 = 1 AND n_chars >= 100")
    got = language_id.identify(test, language_id.fit(train), host=F.col("source")).select("lang", "lang_id").collect()
    assert sum(r.lang == r.lang_id for r in got) >= 0.97 * len(got)
    model = language_id.fit(docs)
    out = language_id.identify(docs, model, declared=F.col("lang"), host=F.col("source")).collect()
    assert len(out) == len(ROWS) and {r.doc_id for r in out if not r.lang_kept} >= {4, 5, 6}
    assert language_id.identify(empty, language_id.fit(empty)).count() == 0
    page = spark.createDataFrame([("http://u@www.Example.de:80/x", "<HTML class=a lang='de-AT'><script>a<b</script>Gut &amp; <b>x</b>"), (None, None)], "u string, h string")
    host = language_id.address_host(F.col("u"))
    assert [tuple(r) for r in page.select(host, language_id.address_suffix(host), language_id.primary_tag(language_id.markup_language(F.col("h"))),
                                          F.trim(language_id.markup_text(F.col("h")))).collect()][0][:3] == ("www.example.de", "de", "de")


def test_quality_held_out(spark, docs, empty):
    all_docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    seen = labels.where("doc_id % 2 = 0")
    got = quality.classify(all_docs, seen, F.col("source"), F.col("lang")).join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    assert sum(r.keep == (r.quality == 1) for r in [type("R", (), {"keep": x.keep, "quality": x[-2]}) for x in got]) >= 0.9 * len(got)
    assert quality.classify(docs, labels, F.col("source"), F.col("lang")).count() == len(ROWS)
    assert quality.classify(empty, labels.where("false"), F.col("source"), F.col("lang")).count() == 0


def _reference():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(vocabulary())


def test_token_files(docs, empty):
    ref = _reference()
    rows = sorted(token_files.token_digest(docs, vocabulary()).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted((i for i, _ in _texts()), key=lambda i: -1 if i is None else i)
    at, want = 0, collections.Counter()
    for i, t in _texts():
        ids = np.array(ref.encode(t, add_special_tokens=False).ids + [1], "<u4")
        want[(i, len(ids), zlib.crc32(ids.tobytes()))] += 1
    assert collections.Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == want
    for r in rows:
        assert r.start == at
        at += r.n_tokens
    assert token_files.token_digest(empty, vocabulary()).count() == 0


def test_bpe_round_trip(docs, empty):
    ref = _reference()
    lexicon = bpe.build_lexicon(docs, words=200)
    got = bpe.decode(bpe.encode(docs, vocabulary(), lexicon), vocabulary(), lexicon).collect()
    want = collections.Counter()
    for i, t in _texts():
        ids = ref.encode(t, add_special_tokens=False).ids
        want[(i, tuple(ids), ref.decode(ids, skip_special_tokens=False))] += 1
    assert collections.Counter((r.doc_id, tuple(r.ids), r.decoded) for r in got) == want
    assert collections.Counter((r.doc_id, tuple(r.ids), r.decoded) for r in bpe.encode_decode(docs, vocabulary(), lexicon).collect()) == want
    assert bpe.codec_digest(empty, vocabulary()).count() == 0


def test_bpe_of_random_texts_with_and_without_lexicon(tmp_path):
    ref, rnd = _reference(), random.Random(1)
    letters = "aAbB' 'sStTreveLLmd12½²ªµºß×÷Ééİıſ \u0085\t\n|<>!?.,ΑΣς한中́\x1c\x00"
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 40))) for _ in range(800)]
    raw = [t.encode() for t in texts]
    data, off = np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    path = tmp_path / "lexicon"
    path.write_bytes(bpe.compile_lexicon([b"ab", b"b", b"seve", b"ll", b"abs", b"cabs"]))
    for lexicon in (None, str(path)):
        ids, bounds = bpe.Codec(vocabulary(), lexicon).batch(data, off)
        for k, t in enumerate(texts):
            assert ids[bounds[k]:bounds[k + 1]].tolist() == ref.encode(t, add_special_tokens=False).ids


def test_automaton_shares_suffixes(tmp_path):
    words = sorted(f"{a}{b}tion".encode() for a in "abcdef" for b in "xyz")
    path = tmp_path / "lexicon"
    path.write_bytes(bpe.compile_lexicon(words))
    lexicon = bpe.Lexicon(str(path))
    data, size = np.frombuffer(b"".join(words), np.uint8), np.array([len(w) for w in words])
    assert lexicon.ranks(data, np.cumsum(size) - size, size).tolist() == list(range(len(words)))
    assert lexicon.states == 1 + 1 + 5                     # start, after one letter, and one chain for the common end


def test_warc(spark, docs, empty):
    pages = docs.select(F.col("doc_id").alias("page_id"), F.col("source").alias("url"), F.col("text").alias("html"), F.col("k").alias("first"))
    folder = "file://" + tempfile.mkdtemp(prefix="tidewater-warc-")
    manifest = warc.write_warc(pages, folder, roll_bytes=2000)
    rows = warc.read_warc(manifest, folder).collect()
    assert manifest.count() > 3 and len(rows) == len(ROWS)
    first = {}
    for i, t in sorted(_texts(), key=lambda x: (x[0] is None, x[0] or 0)):
        first.setdefault(t, i)
    assert sum(r.record_type == "response" for r in rows if r.page_id is not None) == len({t for i, t in _texts() if i is not None})
    by_digest = {base64.b32encode(hashlib.sha1(t.encode()).digest()).decode(): t for _, t in _texts()}
    for r in rows:
        t = by_digest[r.payload_digest]
        assert r.payload_bytes == len(t.encode())
        if r.record_type == "response":
            assert bytes(r.payload) == t.encode() and r.refers_to is None
        else:
            assert r.refers_to == first[t]
    again = "file://" + tempfile.mkdtemp(prefix="tidewater-warc-")
    assert sorted(map(tuple, warc.write_warc(pages, again, roll_bytes=2000).collect())) == sorted(map(tuple, manifest.collect()))
    assert warc.archive(empty.select(F.col("doc_id").alias("page_id"), F.col("source").alias("url"), F.col("text").alias("html"))).count() == 0


def test_pipeline_stages(spark, docs):
    import corpus_pipeline as P

    state, sizes = docs.select("doc_id", "text", "lang", "source", F.lit(1).cast("long").alias("n_chars")), []
    for name, stage in P.STAGES:
        before, state = state, stage(spark, state, SF)
        sizes.append(state.count())
        assert state.columns == before.columns or name == "bpe_codec"
    assert sizes[-1] == sizes[-2] > 0 and sizes == sorted(sizes, reverse=True)
    kept = {r.doc_id for r in state.collect()}
    assert {1, 7, 10, 12, 14, 100} <= kept and not kept & {2, 3, 4, 5, 6}
    assert [n for n, _ in P.STAGES] == ["language_id", "line_dedup", "ngram_join", "decontam", "bpe_codec"]


def test_every_operator_has_a_query():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES if n.startswith("op")) == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)


def test_pipeline_leaves_no_fragments_of_copies(spark):
    import corpus_pipeline as P

    long, other = [_passage(s, 30) for s in range(200, 204)], [_passage(s, 30) for s in range(210, 212)]
    text = "\n".join(["Les.", long[0], "Read more", long[1], "", "one two three four", long[2], long[3]])
    near = "\n".join(_near(x, 7) if len(x) > 40 else x for x in text.split("\n"))
    rows = [(1, text), (2, text), (3, near), (4, text.replace("\n", " \n") + "\n\n"), (5, "\n".join(["Read more", other[0], "My own"])),
            (6, "\n".join(["Les.", other[1], "one two three four five", "My own"])), (7, "Read more"), (8, None), (9, "")]
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    lines = P.line_stage(spark, docs, SF)
    got = {r.doc_id: (r.text, r.n_chars) for r in lines.collect()}
    want = {1: text, 5: f"{other[0]}\nMy own", 6: other[1], 8: None, 9: ""}
    assert got == {i: (t, None if t is None else len(t)) for i, t in want.items()}
    kept = {r.doc_id for r in P.near_duplicate_stage(spark, lines, SF).collect()}
    assert {1, 5, 6} <= kept and not kept & {2, 3, 4, 7}


def test_short_lines_are_judged(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(line_dedup, "TILE", 8)
    rnd = random.Random(4)
    texts = [(i, "\n".join(" ".join(rnd.choice("abcdefg") for _ in range(rnd.randint(0, 9))) for _ in range(6))) for i in range(60)]
    texts += [(100, "four words only here\none"), (101, "here four words only five\none one"), (102, "only here four\none two"), (103, "\n \n")]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    seen, want = [], {}
    for i, t in texts:
        sets = [frozenset(w for w in _SPACE.split(line) if w) for line in t.split("\n")]
        want[i] = []
        for n, words in enumerate(sets):
            if words and any(5 * len(words & v) >= 4 * len(words | v) for v in seen):
                want[i].append(n)
            seen.append(words)
    assert want[101] == [0, 1] and want[102] == []       # four words and one more: 0.8; three and one more: less
    assert {r.doc_id: r.removed for r in QUERIES["op10_line_dedup"](spark, str(tmp_path)).collect()} == want


def test_masks_hold_a_seed_for_every_placement():
    import itertools

    for n in range(13, 26):
        s = n // 5
        placed = (np.int64(1) << np.array(list(itertools.combinations(range(n), s)))).sum(axis=1)
        found = np.zeros(len(placed), bool)
        for mask in decontam.MASKS:
            keep = sum(1 << j for j, bit in enumerate(mask) if bit == "1")
            for shift in range(n - len(mask) + 1):
                found |= (placed & (keep << shift)) == 0
        rest = [{j for j in range(n) if p >> j & 1} for p in placed[~found].tolist()]
        assert not rest, (n, rest[:3])


@pytest.mark.parametrize("size,least,identity", [(40, 13, 0.8), (13, 13, 0.8), (12, 13, 0.8), (40, 8, 0.7), (14, 16, 0.7)])
def test_edited_passages_are_found_wherever_the_edits_are(size, least, identity):
    import itertools

    item = [f"w{k}" for k in range(size)]
    block = decontam.Block([7], [" ".join(item)], 5, least, identity)
    n = min(size, least)
    at = (size - n) // 2
    for changed in itertools.combinations(range(n), int((1 - identity) * n + 1e-9)):
        text = [f"x{k}" if k in changed else w for k, w in enumerate(item[at:at + n])]
        raw = " ".join(["so", *text, "end"]).encode()
        wh, first = decontam.tokens(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        assert block.hits(wh, first, least, identity).get(0, {}).get(0, (0, 0))[0] >= n, changed


def test_suffix_dedup_bounds_the_group_of_an_anchor(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT_BYTES", 8000)
    monkeypatch.setattr(suffix_dedup, "HOT_WINDOWS", 10)
    passage, rare = _passage(300, 110)[:600], _passage(301, 110)[:450]
    texts = [_passage(400 + k, 30) + passage + _passage(500 + k, 30) for k in range(30)]
    texts += [_passage(600, 30) + rare + _passage(601, 30), _passage(602, 30) + rare + passage[:430] + "x" + passage[100:], "ab" * 700, passage[100:550]]
    texts.append(texts[3])
    splits, split = [], suffix_dedup.split_hot
    monkeypatch.setattr(suffix_dedup, "split_hot", lambda bodies, limit: splits.append((bodies, split(bodies, limit))) or splits[-1][1])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_removed, bytes(r.kept)) for r in suffix_dedup.remove_repeats(docs).collect()}
    seen = collections.Counter(t[k:k + 400] for t in texts for k in range(len(t) - 399))
    for i, t in enumerate(texts):
        gone = bytearray(len(t))
        for k in range(len(t) - 399):
            if seen[t[k:k + 400]] > 1:
                gone[k:k + 400] = b"\1" * 400
        assert got[i] == (sum(gone), bytes(c for c, g in zip(t.encode(), gone) if not g)), i
    (bodies, (cold, hot)), = splits
    assert hot is not None and cold.count() + hot.count() == bodies.count() and cold.count() > 0
    assert all(r.n <= 8000 for r in cold.groupBy("anchor").agg(F.sum(F.length("body")).alias("n")).collect())


def _brute_lines(docs, least=(1, 5)):
    """What the pipeline's line stage keeps: (id -> text), in corpus order."""
    seen, out = [], {}
    for i, text in sorted(docs.items()):
        left = []
        lines = text.split("\n")
        for line in lines:
            words = frozenset(w for w in _SPACE.split(line) if w)
            if not words or not any(5 * len(words & v) >= 4 * len(words | v) for v in seen):
                left.append(line)
            seen.append(words)
        count = [len([w for w in _SPACE.split(t) if w]) for t in ("\n".join(left), text)]
        if len(left) == len(lines) or (count[0] and count[0] * least[1] >= least[0] * count[1]):
            out[i] = "\n".join(left)
    return out


def test_pipeline_against_brute_force(spark, tmp_path):
    import corpus_pipeline as P

    rnd = random.Random(12)
    item = _passage(900, 30)
    docs = {k: "\n".join(_passage(1000 + 40 * k + n, rnd.randint(6, 14)) for n in range(20)) for k in range(12)}
    for k in range(6):                                       # near copies: two lines of twenty rewritten in each
        lines = docs[0].split("\n")
        for n in rnd.sample(range(20), 2):
            lines[n] = _passage(5000 + 10 * k + n, 9)
        docs[20 + k] = "\n".join(lines)
    docs[30] = docs[3]                                       # exact copies, one with a line more
    docs[31] = docs[4] + "\nan own last line of some words"
    docs[32] = _passage(950, 40)                             # near copies on one long line: 0.8 on words, so the line stage has them
    docs[33] = _near(docs[32], 3)
    long = _passage(960, 300).split(" ")                     # near copies by shingles whose lines differ everywhere: for the join
    docs[34] = "\n".join(" ".join(long[n:n + 7]) for n in range(0, 300, 7))
    docs[35] = "\n".join(" ".join(long[n:n + 11]) for n in range(0, 300, 11))
    words = item.split(" ")
    words[9] = "edited"
    docs[40] = docs[5].split("\n")[0][:3] + _passage(970, 30) + "\n" + " ".join(words) + "\n" + _passage(971, 30)
    docs[41] = _passage(972, 30) + " " + " ".join(item.split(" ")[:8]) + " " + _passage(973, 30)      # too little of the item
    rows = [(i, t, "en", "a", len(t)) for i, t in docs.items()]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    lines = _brute_lines(docs)
    assert set(docs) - set(lines) == {*range(20, 26), 30, 31, 33}
    left, sets = {}, {}
    for i, t in sorted(lines.items()):                       # classes of near copies are single links here
        sets[i] = _shingles(t)
        if not any(5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]) for j in left):
            left[i] = t
    assert set(lines) - set(left) == {35}
    want = set(left) - {40}
    got = {r.doc_id: r for r in P.run(spark, str(tmp_path)).collect()}
    assert set(got) == want
    ref = _reference()
    assert all(list(got[i].ids) == ref.encode(left[i], add_special_tokens=False).ids for i in want)
    (tmp_path / "none").mkdir()
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/none/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/none/benchmark.parquet")
    assert P.run(spark, f"{tmp_path}/none").count() == 0


def test_components_end_only_when_nothing_changes(spark):
    from tidewater.llm.common import components

    chain = spark.createDataFrame([(k, k + 1) for k in range(1, 300)] + [(1000, 2000)], "u long, v long")
    got = {r.node: r.root for r in components(chain, "chain").collect()}
    assert got == {**{k: 1 for k in range(1, 301)}, 1000: 1000, 2000: 1000}
    with pytest.raises(RuntimeError, match="did not settle"):
        components(chain, "chain", most_rounds=2)


@pytest.mark.parametrize("size", range(1, 13))
def test_short_items_are_found_with_their_substitutions(size):
    import itertools

    item = [f"w{k}" for k in range(size)]
    block = decontam.Block([7], [" ".join(item)], 1)
    for changed in itertools.combinations(range(size), decontam.substitutions(size, 0.8)):
        raw = " ".join(["so", *[f"x{k}" if k in changed else w for k, w in enumerate(item)], "end"]).encode()
        wh, first = decontam.tokens(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        assert block.hits(wh, first, 13, 0.8).get(0, {}).get(0) == (size, size - len(changed)), changed


def test_line_records_are_small_and_whole():
    import types

    import numpy as np
    import pyarrow as pa

    rnd = random.Random(9)
    texts = ["\n".join(" ".join(f"w{rnd.randrange(400)}" for _ in range(rnd.choice([6, 20, 40, 70, 90]))) for _ in range(5)) for _ in range(80)]
    ranks, none = np.full(1 << line_dedup.RARITY_BITS, 9, np.uint8), (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    run = line_dedup._prefixes(types.SimpleNamespace(value=ranks), types.SimpleNamespace(value=none), 4, 4, 5, 3)
    batch = pa.RecordBatch.from_arrays([pa.array(range(1 << 41, (1 << 41) + 80)), pa.array(range(80)), pa.array(texts)], names=["id", "th", "text"])
    sent = list(run([batch]))
    size = sum(len(b) for x in sent for b in x.column(1).to_pylist())
    sets = [frozenset(line.split(" ")) for t in texts for line in t.split("\n")]
    want = sum(len(s) - -(-4 * len(s) // 5) + 1 for s in set(sets))
    assert size < 36 * want                                  # 53 bytes each before
    rows = line_dedup.unpack_blocks(np.concatenate([x.column(0).to_numpy() for x in sent]), [b for x in sent for b in x.column(1).to_pylist()])
    assert len(rows["k"]) == want and sorted(set(rows["id"] - (1 << 41))) == list(range(80)) and set(rows["line"]) == set(range(5))
    place = {(d + (1 << 41), n): sets[5 * d + n] for d in range(80) for n in range(5)}
    assert all(len(place[i, n]) == m for i, n, m in zip(rows["id"].tolist(), rows["line"].tolist(), rows["n"].tolist()))
    by_set = {k: (place[i, n], p, q) for k, i, n, p, q in zip(*(rows[c].tolist() for c in ("k", "id", "line", "parity", "parity2")))}
    for (a, p, q), (b, r, s) in zip(by_set.values(), list(by_set.values())[1:]):       # bits differ in no more places than sets do
        low, high = line_dedup.fold_parity(np.array([min(len(a), len(b))]), np.array([p ^ r], np.uint64), np.array([q ^ s], np.uint64))
        assert int(np.bitwise_count(low)[0]) + int(np.bitwise_count(high)[0]) <= len(a ^ b)
    ids = np.array([-5, 1 << 62, (1 << 63) - 1, 0])
    wide = {"word": ids.view(np.uint64), "k": ids.view(np.uint64), "id": ids, "parity": ids.view(np.uint64), "parity2": ids.view(np.uint64),
            "line": np.array([0, 1 << 20, 3, 70_000]), "n": np.array([80, 500, 100_000, 73]), "pos": np.array([1, 70, 20_000, 0]),
            "flags": np.array([6, 2, 0, 4], np.uint8)}
    back = line_dedup.unpack_blocks(*line_dedup.pack_blocks(wide, 1))
    order, own = np.argsort(back["k"]), np.argsort(wide["k"])
    assert all((back[c][order] == wide[c][own]).all() for c in ("id", "parity", "parity2", "line", "n", "pos"))
    assert ((back["flags"] & 6)[order] == wide["flags"][own]).all()


def test_lines_about_the_lengths_of_bitmaps(spark):
    rnd = random.Random(11)
    seen, rows, want = [], [], {}
    for i in range(60):
        size = rnd.choice([16, 18, 20, 21, 24, 60, 70, 72, 73, 80, 88])
        words = [f"v{rnd.randrange(3000)}" for _ in range(size)]
        near = rnd.sample(words, len(words))[:rnd.randint(-(-4 * size // 5) - 1, size)]
        lines = [words, near + [f"n{i}"] * (i % 3 == 0)]
        rows.append((i, "\n".join(" ".join(x) for x in lines)))
        want[i] = []
        for n, x in enumerate(map(frozenset, lines)):
            if any(5 * len(x & v) >= 4 * len(x | v) for v in seen):
                want[i].append(n)
            seen.append(x)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.removed for r in line_dedup.line_report(docs).collect()} == want

"""Hard negatives, conversation repair and the SentencePiece codec against brute force and the library."""
import collections
import hashlib
import random
import re
import zlib

import pytest

from tidewater.llm import conversation_repair, hard_negatives, pieces
from tidewater.llm.queries import PIECE_BPE, QUERIES, vocabulary


# -- SentencePiece ---------------------------------------------------------------


def _library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=vocabulary(PIECE_BPE))


def test_pieces_of_random_texts_equal_the_library():
    ref, rnd, model = _library(), random.Random(1), pieces.PieceModel(vocabulary(PIECE_BPE))
    letters = ["abcdetinshr ", "   \t\n", "aaaaab", "éàçñüß", "中文字한국日本語", "0123456789", ".,!?;:()[]{}<>/|", "\U0001F600\U0001F601▁\x00", "theinger on"]
    known = sorted(model.id)
    for k in range(6000):
        some = rnd.choice(letters) + rnd.choice(letters)
        text = "".join(rnd.choice(some) for _ in range(rnd.randint(0, 40))) if k % 2 else "".join(rnd.choice(known) for _ in range(rnd.randint(1, 6)))
        want = ref.encode(text, add_eos=True)
        ids, decoded = model.encode_decode(text)
        assert ids.tolist() == want and decoded == ref.decode(want) == model.decode(want), text
    for _ in range(2000):                                   # any ids, also wrong byte sequences and special ids
        ids = [rnd.randrange(model.size) if rnd.random() < 0.6 else rnd.randrange(0, 259) for _ in range(rnd.randint(0, 12))]
        assert model.decode(ids) == ref.decode(ids), ids


def test_pieces_of_long_texts_without_a_break(monkeypatch):
    ref, rnd, model = _library(), random.Random(2), pieces.PieceModel(vocabulary(PIECE_BPE))
    monkeypatch.setattr(pieces, "WINDOW", 1000)
    monkeypatch.setattr(pieces, "MOST_PARTS", 10)
    monkeypatch.setattr(pieces, "MOST_PAIRS", 50)
    for text in ["ab" * 100_000, "".join(rnd.choice("abcdefghijklmnop") for _ in range(200_000)), " " * 50_000, "中文" * 30_000,
                 "".join(rnd.choice("abc é\n中") for _ in range(50_000))]:
        ids, decoded = model.encode_decode(text)
        assert ids.tolist() == ref.encode(text, add_eos=True) and decoded == text


def test_piece_tables(spark):
    ref = _library()
    texts = [(1, "two words"), (1, "two words"), (None, None), (2, ""), (3, " \n  x"), (4, "word " * 20_000)]
    docs = spark.createDataFrame([(i, t, 7, "x") for i, t in texts], "doc_id long, text string, ids int, id string").repartition(2)
    want = collections.Counter((i, tuple(ref.encode(t or "", add_eos=True)), t or "") for i, t in texts)
    got = pieces.encode_decode(docs, vocabulary(PIECE_BPE))
    assert got.columns == ["doc_id", "ids", "n_tokens", "decoded"]
    rows = got.collect()
    assert collections.Counter((r.doc_id, tuple(r.ids), r.decoded) for r in rows) == want and all(r.n_tokens == len(r.ids) for r in rows)
    again = pieces.decode(pieces.encode(docs, vocabulary(PIECE_BPE)), vocabulary(PIECE_BPE))
    assert collections.Counter((r.doc_id, tuple(r.ids), r.decoded) for r in again.collect()) == want
    assert pieces.encode_decode(docs.where("false"), vocabulary(PIECE_BPE)).count() == 0
    with pytest.raises(Exception, match="vocabular|parse|Error"):
        pieces.PieceModel(vocabulary())


# -- hard negatives ----------------------------------------------------------------


def _hard(rows, positives, negatives):
    import math

    rows = [(i, lab, [math.floor(256 * x) for x in v]) for i, lab, v in rows
            if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    held = lambda s: min(max(s, -2**63), 2**63 - 1)
    out = collections.Counter()
    for i, lab, v in rows:
        if i % 100:
            continue
        scored = sorted((-held(sum(a * b for a, b in zip(v, w))), j, m) for j, m, w in rows if j != i)
        for p, j, _ in [x for x in scored if x[2] == lab][:positives]:
            inside = [(-s, n) for s, n, m in scored if m != lab and 30 * -p <= 100 * -s <= 90 * -p]
            for rank, (s, n) in enumerate(inside[:negatives], 1):
                out[(i, j, rank, n, -p, s)] += 1
    return out


def _vectors(rnd, n, size):
    centre = [[rnd.gauss(0, 1) for _ in range(size)] for _ in range(4)]
    return [(k, rnd.randrange(4), [c + rnd.gauss(0, 0.8) for c in centre[rnd.randrange(4)]]) for k in range(n)]


def test_hard_negatives_equal_brute_force(spark, monkeypatch):
    rnd = random.Random(5)
    rows = _vectors(rnd, 700, 6)
    rows += [(k, 9, [1.0] * 6) for k in range(1000, 1130)]                              # ties: one vector many times, an anchor among them
    rows += [(1200, 3, None), (1300, None, [1.0] * 6), (1400, 1, [1.0, None, 0.0]), (1500, 1, [float("nan")] * 6), (1600, 1, [float("inf")] * 6),
             (None, 1, [1.0] * 6), (1700, 2, []), (1800, 2, [5.0, 1.0]), (1801, 3, [2.0] * 9), (1900, 50, [3.0] * 6)]
    rows += [rows[100], rows[101]]                                                      # repeated rows, an anchor among them
    df = spark.createDataFrame([(i, lab, v, 1, 2, "x") for i, lab, v in rows], "vec_id long, label long, embedding array<double>, id int, v int, anchor string").repartition(5)
    want = _hard(rows, 5, 10)
    assert len(want) > 300
    monkeypatch.setattr(hard_negatives, "_STEP", 64)
    got = hard_negatives.hard_negatives(df, block_rows=3)                                # several blocks
    assert collections.Counter(tuple(r) for r in got.collect()) == want
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint", "bigint", "int", "bigint", "bigint", "bigint"]
    assert collections.Counter(tuple(r) for r in hard_negatives.hard_negatives(df, positives=2, negatives=3).collect()) == _hard(rows, 2, 3)
    assert hard_negatives.hard_negatives(df.where("false")).count() == 0
    assert hard_negatives.hard_negatives(df.where("vec_id % 100 <> 0")).count() == 0


def test_hard_negative_scores_beyond_53_and_64_bits(spark):
    rows = [(0, 1, [3e7, 1.5]), (1, 1, [2.9e7, 7.0]), (2, 2, [1.0e7, 3.0]), (3, 2, [2e7, 1.0]), (100, 3, [1e300, 0.0]), (101, 3, [1e300, 1.0]), (102, 4, [1e17, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, label long, embedding array<double>")
    assert collections.Counter(tuple(r) for r in hard_negatives.hard_negatives(df).collect()) == _hard(rows, 5, 10)


# -- conversation repair ------------------------------------------------------------


_BLANK = re.compile(r"[^\x20\x09-\x0D]")


def _damage(rows):
    out = []
    for conv, turn, role, text in rows:
        hit = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if hit == 0:
            continue
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        out += [(conv, turn, "user" if hit == 4 else role, text)] * (2 if hit == 3 else 1)
    return out


def _cheapest(rows):
    """(cost, audit, repaired rows) by comparing whole edit strings, last row first."""
    turn_of = {"": "u", "s": "u", "u": "a", "a": "u"}                  # what may be inserted behind an initial
    follows = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}

    def with_insertions(best):
        for _ in range(3):
            best = {q: min([best[q], *([(best[t][0] + 2, "I" + best[t][1], ((t,), best[t][2]))] if best[t] else [])], key=lambda x: x[:2]) if best[q]
                    else (best[t][0] + 2, "I" + best[t][1], ((t,), best[t][2])) if best[t] else None for q, t in turn_of.items()}
        return best

    best = with_insertions({"": (0, "", None), "a": (0, "", None), "s": None, "u": None})
    for role, text, fault in reversed(rows):
        now = {}
        for q, t in turn_of.items():
            options = [(best[q][0] + 3, "D" + best[q][1], best[q][2])]
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                to = follows.get((q, role[:1]))
                if to:
                    options.append((best[to][0] + extra, "K" + best[to][1], ((role, text), best[to][2])))
                options.append((best[t][0] + 2 + extra, "R" + best[t][1], ((t, text), best[t][2])))
            now[q] = min(options, key=lambda x: x[:2])
        best = with_insertions(now)
    cost, audit, chain = best[""]
    left = []
    while chain:
        row, chain = chain
        role = {"u": "user", "a": "assistant"}.get(row[0], row[0])
        left.append(f"{role}:{row[1] if len(row) > 1 else ''}")
    return cost, audit, "\n".join(left)


def _repair(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in _damage(rows) if r[0] == conv),
                      key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).hexdigest()))
        seen, marked, count = set(), [], collections.Counter()
        for _, _, role, text in mine:
            fault = ("blank" if not _BLANK.search(text) else "duplicate" if (role, text) in seen
                     else "truncated" if _BLANK.findall(text)[-1] not in ".!?" else None)
            seen.add((role, text))
            marked.append((role, text, fault))
            count[fault] += 1
        turns = [r[1] for r in mine if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:]))
        cost, audit, text = _cheapest(marked)
        out[conv] = (gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


def _conversations(rnd, n):
    roles = ["user", "user", "assistant", "assistant", "system", "tool", "", None, "uncle"]
    texts = ["Yes.", "No!", "Why", "", " \t\n", None, "So it is?  ", "cut off ", "a.\u0085", "Well...", "end.\n", " "]
    return [(rnd.randrange(n), rnd.choice([None, *range(8)]), rnd.choice(roles), rnd.choice(texts)) for _ in range(5 * n)]


def _repair_table(spark, tmp_path, rows):
    spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, seq int, conv string").repartition(3).write.parquet(
        f"{tmp_path}/conversations.parquet")
    got = QUERIES["op12_conversation_repair"](spark, str(tmp_path))
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    rows = got.collect()
    assert len(rows) == len({r.conv_id for r in rows})
    return {r.conv_id: tuple(r)[1:] for r in rows}


def test_conversation_repair_equals_brute_force(spark, tmp_path):
    rnd = random.Random(6)
    rows = _conversations(rnd, 300) + [(None, t, "user", "Hm.") for t in range(9)] + [(None, None, None, None)]
    rows += [(900, -5, "user", "a."), (900, 2**40, "assistant", "b."), (901, 3, "user", "same."), (901, 3, "user", "same.")]
    assert _repair_table(spark, tmp_path, rows) == _repair(rows)
    assert conversation_repair.repair(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_a_conversation_over_many_tasks_and_pieces(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(conversation_repair, "PIECE_ROWS", 7)
    rnd = random.Random(7)
    roles = ["user", "assistant", "assistant", "system", "tool"]
    rows = [(1, k // 3 if k % 11 else None, rnd.choice(roles) if k % 400 < 250 else "tool", rnd.choice(["Yes.", "no", "", f"text {k}.", f"cut {k}"])) for k in range(1500)]
    rows += [(1, 9000, "user", "many times.")] * 300 + _conversations(rnd, 20)
    assert _repair_table(spark, tmp_path, rows) == _repair(rows)


def test_repair_of_very_long_runs():
    """Powers give the costs of runs that no one would walk through."""
    runs = (("u", 10**15), ("a", 1), ("x", 10**12))
    cost = conversation_repair.before(runs, conversation_repair.last_costs())[conversation_repair.START]
    assert cost == 10**15 + 3 * 10**12                       # every second row gets another role or an answer before it
    audit, _ = conversation_repair.plan((("o", 1000), ("x", 3), ("S", 2)))
    assert audit == _cheapest([("o", "", None)] * 1000 + [("x", "", "blank")] * 3 + [("s", "", "truncated")] * 2)[1]

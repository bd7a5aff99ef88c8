"""SentencePiece BPE encoding by backtracking, and decoding.

A vocabulary of scored pieces merges the adjacent pair whose concatenation is
the best-scored piece, leftmost among equals, until no pair is a piece. The
result is the only sequence of pieces in which every two neighbours are
compatible: encoded together they give themselves again. So a text is encoded
from left to right without a merge queue. The longest piece at a place, found by
an Aho-Corasick automaton over reversed pieces, is tried first, then its shorter
prefixes; a piece must be compatible with the one before it. Where none is, the
last piece is taken back and its place marked in a bitfield, so no place is tried
twice and time is linear in the text.

Two neighbours are compatible if no merge crosses their border. Both sides merge
by themselves in a fixed order, so each piece keeps its own merge history (score
of the next merge, outer symbols), and the check replays two histories side by
side.

No piece spans a border of two characters that stand side by side in no piece, so
a text is cut at all such borders; the parts (mostly words) are encoded once and
kept in a bounded cache, and texts of any length are worked on in windows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import column_bytes, chunks, prepare, text_or_empty

#: the character that stands for a space in pieces
SPACE_MARK = "▁"
#: characters of a text that are cut into parts at a time
WINDOW = 1 << 18
#: parts and pairs that a worker remembers, and the longest part among them
MOST_PARTS, MOST_PAIRS, LONGEST_PART = 400_000, 1_000_000, 64
_JOIN_BITS = 22
_NEVER = float("-inf")


class PieceModel:
    """Scores, ids and byte pieces of a vocabulary file, its automaton and the worker's caches."""

    def __init__(self, model_file: str):
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(model_file, "rb") as f:
            model.ParseFromString(f.read())
        kinds, rules = model.SentencePiece.Type, model.normalizer_spec
        if (model.trainer_spec.model_type != model.trainer_spec.BPE or rules.precompiled_charsmap or rules.remove_extra_whitespaces
                or model.trainer_spec.treat_whitespace_as_suffix or not rules.escape_whitespaces
                or any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in model.pieces)):
            raise ValueError("only BPE vocabularies without text rules, user-defined and unused pieces are supported")
        self.prefix = SPACE_MARK if rules.add_dummy_prefix else ""
        self.score = {p.piece: p.score for p in model.pieces if p.type == kinds.NORMAL}
        self.id = {p.piece: i for i, p in enumerate(model.pieces) if p.type == kinds.NORMAL}
        self.byte_id = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == kinds.BYTE}
        self.byte_of = {i: b for b, i in self.byte_id.items()}
        self.unknown = next(i for i, p in enumerate(model.pieces) if p.type == kinds.UNKNOWN)
        self.unknown_text = model.trainer_spec.unk_surface
        self.end = model.trainer_spec.eos_id
        self.text_of = {i: p.piece for i, p in enumerate(model.pieces) if p.type == kinds.NORMAL}
        self.size = len(model.pieces)
        self.plain_of = {i: piece.replace(SPACE_MARK, " ") for i, piece in self.text_of.items()}
        self._history: dict[str, tuple] = {}
        self._shorter: dict[str, str] = {}
        self._pairs: dict[str, dict[str, bool]] = {}
        self._known_pairs = 0
        self.automaton = ahocorasick.Automaton()
        for piece in self.id:
            if self.history(piece)[0]:                      # others are merged in another way and never stand in a result
                self.automaton.add_word(piece[::-1], len(piece))
        self.automaton.make_automaton()
        # pairs of characters that stand side by side in a piece, hashed: a shared slot only leaves a cut out
        self.joined = np.zeros(1 << _JOIN_BITS, bool)
        pairs = {x for piece in self.id for x in zip(piece, piece[1:])}
        if pairs:
            at = np.array([(ord(a), ord(b)) for a, b in pairs], np.uint32)
            self.joined[_pair_slot(at[:, 0], at[:, 1])] = True
        self.parts = _Parts(self)

    # -- compatibility -------------------------------------------------------------

    def history(self, piece: str) -> tuple[bool, list, list, list]:
        """Whether ``piece`` encodes to itself, and per state the next merge's score, the first and the last symbol."""
        got = self._history.get(piece)
        if got is None:
            symbols, scores, firsts, lasts = list(piece), [], [], []
            while True:
                best, at = _NEVER, -1
                for k in range(len(symbols) - 1):
                    s = self.score.get(symbols[k] + symbols[k + 1], _NEVER)
                    if s > best:
                        best, at = s, k
                scores.append(best)
                firsts.append(symbols[0])
                lasts.append(symbols[-1])
                if at < 0:
                    break
                symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]
            got = self._history[piece] = (len(symbols) == 1, scores, firsts, lasts)
        return got

    def compatible(self, left: str, right: str) -> bool:
        """Whether no merge crosses the border when ``left`` and ``right`` are merged side by side."""
        (_, a, _, last), (_, b, first, _) = self.history(left), self.history(right)
        i = j = 0
        while True:
            over = self.score.get(last[i] + first[j], _NEVER)
            if over > a[i] and over >= b[j] and over > _NEVER:
                known = False
                break
            if a[i] == b[j] == _NEVER:
                known = True
                break
            if a[i] >= b[j]:
                i += 1
            else:
                j += 1
        if self._known_pairs >= MOST_PAIRS:
            self._pairs.clear()
            self._known_pairs = 0
        self._pairs.setdefault(left, {})[right] = known
        self._known_pairs += 1
        return known

    def shorter(self, piece: str) -> str:
        """The longest proper prefix that is a piece of its own or one character; empty for one character."""
        got = piece[:-1]
        while len(got) > 1 and not (got in self.id and self.history(got)[0]):
            got = got[:-1]
        self._shorter[piece] = got
        return got

    # -- encoding --------------------------------------------------------------------

    def segment(self, text: str) -> list[str]:
        """The pieces (or single characters outside the vocabulary) of a non-empty text."""
        n = len(text)
        longest = [1] * n
        for end, size in self.automaton.iter(text[::-1]):
            if size > longest[n - 1 - end]:
                longest[n - 1 - end] = size
        shorter, none = self._shorter, {}
        failed, any_failed = bytearray(n // 8 + 1), False
        found: list[str] = []
        at, here, known = 0, text[:longest[0]], None
        while at < n:
            while here:
                to = at + len(here)
                if not (any_failed and failed[to >> 3] >> (to & 7) & 1):
                    if known is None:
                        break
                    fits = known.get(here)
                    if self.compatible(found[-1], here) if fits is None else fits:
                        break
                here = shorter[here] if here in shorter else self.shorter(here)
            if here:
                found.append(here)
                at = to
                if at < n:
                    known = self._pairs.get(here, none)
                    here = text[at:at + longest[at]]
            else:                                  # nothing fits behind the last piece: take it back
                failed[at >> 3] |= 1 << (at & 7)
                any_failed = True
                here = found.pop()
                at -= len(here)
                known = self._pairs.get(found[-1], none) if found else None
                here = shorter[here] if here in shorter else self.shorter(here)
        return found

    def ids(self, part: str) -> list[int]:
        """ids of a part of a text; characters outside the vocabulary become bytes."""
        if part in self.id and self.history(part)[0]:
            return [self.id[part]]
        out = []
        for piece in self.segment(part):
            i = self.id.get(piece)
            if i is not None:
                out.append(i)
            elif self.byte_id:
                out += [self.byte_id[b] for b in piece.encode()]
            else:
                out.append(self.unknown)
        return out

    def windows(self, text: str):
        """Lists of parts of a text, with spaces marked, in text order; no piece spans two parts."""
        if not text:
            return
        text = self.prefix + text.replace(" ", SPACE_MARK)
        start = 0
        for a in range(0, len(text), WINDOW):
            points = np.frombuffer(text[a:a + WINDOW + 1].encode("utf-32-le"), np.uint32)
            cuts = (np.flatnonzero(~self.joined[_pair_slot(points[:-1], points[1:])]) + (a + 1)).tolist()
            if cuts:
                yield [text[i:j] for i, j in zip([start, *cuts], cuts)]
                start = cuts[-1]
        yield [text[start:]]

    def encode_decode(self, text: str) -> tuple[np.ndarray, str]:
        """ids of a text with the end id, and the text decoded from them."""
        ids, texts = [], []
        for parts in self.windows(text):
            self.parts.trim()
            got = list(map(self.parts.__getitem__, parts))
            ids += [x for x, _ in got]
            texts += [x for _, x in got]
        ids.append(np.int32(self.end).tobytes())
        return np.frombuffer(b"".join(ids), np.int32), "".join(texts)[len(self.prefix):]      # the first piece begins with the prefix

    # -- decoding ----------------------------------------------------------------------

    def plain(self, ids, lead: bool = False) -> str:
        """The text of ids: bytes of a run form characters, each wrong byte one U+FFFD. With ``lead`` the first piece loses its prefix."""
        out, raw = [], bytearray()
        lead = lead and bool(self.prefix)
        for i in ids:
            if i in self.byte_of:
                raw.append(self.byte_of[i])
                lead = False
                continue
            if raw:
                out.append(_characters(bytes(raw)))
                raw.clear()
            if i == self.unknown:
                out.append(self.unknown_text)
                lead = False
            elif i in self.text_of:
                piece = self.text_of[i]
                out.append(piece[lead and piece.startswith(self.prefix):].replace(SPACE_MARK, " "))
                lead = False
        if raw:
            out.append(_characters(bytes(raw)))
        return "".join(out)

    def decode(self, ids) -> str:
        return self.plain(ids, lead=True)


class _Parts(dict):
    """part -> (ids, their text): what was encoded before, up to a bounded number of short parts.

    When half of them are new, those that were not used since the last time go.
    """

    def __init__(self, model: PieceModel):
        self.model, self.older = model, {}

    def __missing__(self, part: str):
        got = self.older.get(part)
        if got is None:
            ids = self.model.ids(part)
            try:
                text = "".join([self.model.plain_of[i] for i in ids])
            except KeyError:                       # a run of byte ids ends with its part: bytes come from whole characters
                text = self.model.plain(ids)
            got = np.array(ids, np.int32).tobytes(), text
        if len(part) <= LONGEST_PART:
            self[part] = got
        return got

    def trim(self) -> None:
        if len(self) > MOST_PARTS // 2:
            self.older = dict(self)
            self.clear()


def _pair_slot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * np.uint32(0x9E3779B1) ^ b * np.uint32(0x85EBCA6B)) >> np.uint32(32 - _JOIN_BITS)


def _characters(raw: bytes) -> str:
    try:
        return raw.decode()
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(raw):
            for size in (1, 2, 3, 4):
                try:
                    out.append(raw[at:at + size].decode())
                    at += size
                    break
                except UnicodeDecodeError:
                    pass
            else:
                out.append("�")
                at += 1
        return "".join(out)


_MODELS: dict[str, PieceModel] = {}


def piece_model(model_file: str) -> PieceModel:
    """The worker's model, loaded once."""
    if model_file not in _MODELS:
        _MODELS.clear()
        _MODELS[model_file] = PieceModel(model_file)
    return _MODELS[model_file]


def encode_decode(df: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ids (with the end id), n_tokens and the text decoded from the ids, of every row.

    A null text is empty: the end id alone, decoded to an empty text. Rows with
    equal or null ids are rows like others; only the two named columns are read;
    an empty table gives no rows. No shuffle: each row is encoded where it is read.
    """
    prepare(df.sparkSession)

    def run(batches):
        model = piece_model(model_file)
        for batch in batches:
            data, off = column_bytes(batch.column(1))
            for i, j, part, po in chunks(data, off):
                raw = part.tobytes()
                got = [model.encode_decode(raw[a:b].decode("utf-8", "replace")) for a, b in zip(po[:-1].tolist(), po[1:].tolist())]
                n = [len(x) for x, _ in got]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(i, j - i),
                    pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), pa.array(np.concatenate([x for x, _ in got]))),
                    pa.array(n, pa.int64()), pa.array([x for _, x in got], pa.string())], names=["id", "ids", "n_tokens", "decoded"])

    source = df.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    return source.mapInArrow(run, "id long, ids array<int>, n_tokens long, decoded string").withColumnRenamed("id", id_col)


def encode(df: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and ids of every row (see ``encode_decode``)."""
    return encode_decode(df, model_file, id_col, text_col).select(id_col, "ids")


def decode(df: DataFrame, model_file: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``df`` with the decoded text of its ids added; null ids give an empty text, ids outside the vocabulary nothing."""
    prepare(df.sparkSession)

    @F.pandas_udf("string")
    def text(ids):
        model = piece_model(model_file)
        return ids.map(lambda x: model.decode([] if x is None else x.tolist()))

    return df.withColumn(out_col, text(F.col(ids_col)))

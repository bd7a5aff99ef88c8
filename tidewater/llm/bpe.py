"""BPE encoding and decoding with a minimal acyclic transducer as lexicon.

The frequent words of the corpus, as UTF-8 bytes, are compiled into a minimal
acyclic automaton: words that share an ending share its states. Each transition
carries an output number; summed along a word's path they give the word's rank
among the sorted words, hence its ids. The automaton is written to one file that
workers map into memory. A batch's distinct words walk it together, one byte a
step. Words it does not hold are merged exactly, lowest-ranked pair first and
leftmost among equals: short words of the batch side by side, a long one by
buckets of ranks, in time near its length.

The lexicon only changes speed: its size is a parameter, and a word in it gets
the ids that merging gives.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import chunks, column_bytes, materialize, prepare, ragged, text_or_empty
from .lexer import distinct, fast_rows, pretokens, spread

# -- the automaton -----------------------------------------------------------


def compile_lexicon(words: list[bytes]) -> bytes:
    """A minimal acyclic automaton of ``words`` with rank outputs, as one flat file.

    Words come in sorted; a suffix is frozen (shared with an equal one) as soon
    as the next word leaves it. Layout: six int64 counts, then the hashed
    transition table: key (state << 8 | byte), target, output; then per state
    whether a word ends there.
    """
    words = sorted(set(w for w in words if w))
    children: list[dict[int, int]] = [{}]
    final = [False]
    frozen: dict[tuple, int] = {}
    path: list[tuple[int, int, int]] = []          # (parent, byte, child) not frozen yet
    before = b""

    def freeze(keep: int) -> None:
        while len(path) > keep:
            parent, byte, child = path.pop()
            same = (final[child], tuple(children[child].items()))
            if same in frozen:
                children[parent][byte] = frozen[same]
                free.append(child)
            else:
                frozen[same] = child

    free: list[int] = []
    for word in words:
        common = 0
        while common < min(len(word), len(before)) and word[common] == before[common]:
            common += 1
        freeze(common)
        state = path[-1][2] if path else 0
        for byte in word[common:]:
            if free:
                new = free.pop()
                children[new], final[new] = {}, False
            else:
                new = len(children)
                children.append({})
                final.append(False)
            children[state][byte] = new
            path.append((state, byte, new))
            state = new
        final[state] = True
        before = word
    freeze(0)

    below: dict[int, int] = {}                     # words that end at or below a state

    stack = [0]
    while stack:
        state = stack[-1]
        open_ = [c for c in children[state].values() if c not in below]
        if open_:
            stack += open_
        else:
            below[state] = final[state] + sum(below[c] for c in children[state].values())
            stack.pop()
    number = {s: i for i, s in enumerate(sorted(below))}
    keys, targets, outputs = [], [], []
    for state, i in number.items():
        rank = int(final[state])
        for byte, child in sorted(children[state].items()):
            keys.append(i << 8 | byte)
            targets.append(number[child])
            outputs.append(rank)
            rank += below[child]
    bits = max(4, int(2 * len(keys) + 1).bit_length())
    table = np.full(1 << bits, -1, np.int64)
    to, out = np.zeros(1 << bits, np.int32), np.zeros(1 << bits, np.int32)
    todo = np.arange(len(keys))
    k, t, o = np.array(keys, np.int64), np.array(targets, np.int32), np.array(outputs, np.int32)
    probe, longest = 0, 0
    while len(todo):                               # open addressing, all keys of a round at once
        slot = (_slot(k[todo], bits) + probe) & ((1 << bits) - 1)
        empty = table[slot] < 0
        one, where = np.unique(slot[empty], return_index=True)
        put = np.flatnonzero(empty)[where]
        table[one], to[one], out[one] = k[todo[put]], t[todo[put]], o[todo[put]]
        todo = np.delete(todo, put)
        probe += 1
        longest = probe
    ends = np.zeros(len(number), np.uint8)
    for state, i in number.items():
        ends[i] = final[state]
    head = np.array([bits, longest, len(number), len(keys), len(words), 0], np.int64)
    return head.tobytes() + table.tobytes() + to.tobytes() + out.tobytes() + ends.tobytes()


def _slot(keys: np.ndarray, bits: int) -> np.ndarray:
    return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)


class Lexicon:
    """A compiled automaton, mapped into memory."""

    def __init__(self, path: str):
        head = np.memmap(path, np.int64, "r", shape=(6,))
        self.bits, self.probes, states, self.transitions, self.words = (int(x) for x in head[:5])
        n, at = 1 << self.bits, 48
        self.states = states
        self.keys = np.memmap(path, np.int64, "r", at, (n,))
        self.to = np.memmap(path, np.int32, "r", at + 8 * n, (n,))
        self.out = np.memmap(path, np.int32, "r", at + 12 * n, (n,))
        self.ends = np.memmap(path, np.uint8, "r", at + 16 * n, (states,))

    def ranks(self, data: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
        """Each word's rank among the lexicon's sorted words, or -1."""
        rank = np.full(len(starts), -1, np.int64)
        live, state, total = np.arange(len(starts)), np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        mask, step = (1 << self.bits) - 1, 0
        while len(live):
            over = lens[live] == step
            if over.any():
                stop = over & (self.ends[state] > 0)
                rank[live[stop]] = total[stop]
                live, state, total = live[~over], state[~over], total[~over]
            key = state << 8 | data[starts[live] + step].astype(np.int64)
            slot = _slot(key, self.bits)
            found = np.full(len(live), -1, np.int64)
            open_ = np.arange(len(live))
            for _ in range(self.probes):
                here = self.keys[slot[open_]]
                hit = here == key[open_]
                found[open_[hit]] = slot[open_[hit]]
                more = ~hit & (here >= 0)
                open_ = open_[more]
                if not len(open_):
                    break
                slot[open_] = (slot[open_] + 1) & mask
            ok = found >= 0
            live, total = live[ok], total[ok] + self.out[found[ok]]
            state = self.to[found[ok]].astype(np.int64)
            step += 1
        return rank


# -- merging -------------------------------------------------------------------


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1 stands for itself."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, extra = [""] * 256, 256
    for b in range(256):
        if b in own:
            letters[b] = chr(b)
        else:
            letters[b], extra = chr(extra), extra + 1
    return letters


class Merger:
    """Exact merging by the vocabulary's ranks, for many words at once."""

    def __init__(self, vocabulary: str):
        with open(vocabulary, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, end = model["vocab"], model.get("end_of_word_suffix") or ""
        letters = byte_letters()
        self.inner = np.array([vocab[x] for x in letters], np.int64)
        self.last = np.array([vocab[x + end] for x in letters], np.int64)
        left, right, made = [], [], []
        for pair in model["merges"]:
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            left.append(vocab[a])
            right.append(vocab[b])
            made.append(vocab[a + b])
        key = np.array(left, np.int64) << 20 | np.array(right, np.int64)
        self.bits = int(4 * len(key)).bit_length()
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.rank = np.full(1 << self.bits, _NONE, np.int64)
        self.probes, todo = 0, np.arange(len(key))
        while len(todo):
            slot = (_slot(key[todo], self.bits) + self.probes) & ((1 << self.bits) - 1)
            empty = self.keys[slot] < 0
            one, where = np.unique(slot[empty], return_index=True)
            put = np.flatnonzero(empty)[where]
            self.keys[one], self.rank[one] = key[todo[put]], todo[put]
            todo = np.delete(todo, put)
            self.probes += 1
        self.made = np.array(made, np.int64)
        self.left, self.right = np.array(left, np.int64), np.array(right, np.int64)
        # every merge of a symbol ranks after the merges that make it: then all pairs of one rank may go at once
        born = np.full(int(max(self.made.max(initial=0), self.left.max(initial=0), self.right.max(initial=0))) + 1, -1, np.int64)
        np.maximum.at(born, self.made, np.arange(len(key)))
        self.ordered = bool((np.maximum(born[self.left], born[self.right]) < np.arange(len(key))).all())

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 20 | right
        slot = _slot(key, self.bits)
        here = self.keys[slot]
        out = np.where(here == key, self.rank[slot], _NONE)
        open_ = np.flatnonzero((here != key) & (here >= 0))
        for p in range(1, self.probes):
            if not len(open_):
                break
            at = (slot[open_] + p) & ((1 << self.bits) - 1)
            here = self.keys[at]
            hit = here == key[open_]
            out[open_[hit]] = self.rank[at[hit]]
            open_ = open_[~hit & (here >= 0)]
        return out

    def merge(self, data: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """ids of all words, one after the other, and the number of ids of each word."""
        long = lens > LONG_WORD
        if not long.any():
            return self._merge_short(data, starts, lens)
        ids, n = self._merge_short(data, starts[~long], lens[~long])
        own = [self._merge_long(data[s:s + k]) for s, k in zip(starts[long].tolist(), lens[long].tolist())]
        size = np.empty(len(lens), np.int64)
        size[~long], size[long] = n, [len(x) for x in own]
        first, out = np.cumsum(size) - size, np.empty(int(size.sum()), np.int64)
        out[ragged(first[~long], n)] = ids
        out[ragged(first[long], size[long])] = np.concatenate(own)
        return out, size

    def _merge_long(self, word: np.ndarray) -> np.ndarray:
        """ids of one long word, in time near its length.

        The symbols are a linked list and the places of each rank wait in a
        bucket; the lowest rank's places go together, leftmost first where they
        overlap, and the pairs that this makes join their buckets. (One place at
        a time for a vocabulary whose merges may rank before their parts.)
        """
        n = len(word)
        sym = self.inner[word]
        sym[-1] = self.last[word[-1]]
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        buckets: dict[int, list] = {}
        heap: list[int] = []

        def offer(place: np.ndarray, rank: np.ndarray) -> None:
            some = rank < _NONE
            place, rank = place[some], rank[some]
            if not len(rank):
                return
            order = np.argsort(rank, kind="stable")
            place, rank = place[order], rank[order]
            cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
            for r, part in zip(rank[np.concatenate([[0], cuts])].tolist(), np.split(place, cuts)):
                if r not in buckets:
                    buckets[r] = []
                    heapq.heappush(heap, r)
                buckets[r].append(part)

        offer(np.arange(n - 1), self.ranks(sym[:-1], sym[1:]))
        while heap:
            r = heapq.heappop(heap)
            p = np.unique(np.concatenate(buckets.pop(r)))
            p = p[(sym[p] == self.left[r]) & (after[p] < n)]
            p = p[sym[after[p]] == self.right[r]]  # places whose pair has changed since are left out
            if not len(p):
                continue
            if not self.ordered and len(p) > 1:
                buckets[r] = [p[1:]]
                heapq.heappush(heap, r)
                p = p[:1]
            chained = np.concatenate([[False], after[p[:-1]] == p[1:]])
            if chained.any():  # of a run of overlapping pairs every other one goes
                at = np.arange(len(p))
                p = p[(at - np.maximum.accumulate(np.where(chained, 0, at))) % 2 == 0]
            gone = after[p]
            then = after[gone]
            sym[p], sym[gone], after[p] = self.made[r], -1, then
            inside = then < n
            before[then[inside]] = p[inside]
            behind = before[p]
            place = np.concatenate([behind[behind >= 0], p[inside]])
            offer(place, self.ranks(sym[place], sym[after[place]]))
        return sym[sym >= 0]

    def _merge_short(self, data: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """ids of words, all side by side, one merge of each word a round.

        A word's best pair may only change around a merge, so each round looks
        at the words that still have one and renews the ranks that touch it.
        """
        bounds = np.cumsum(lens)
        sym = self.inner[data[ragged(starts, lens)]]
        sym[bounds - 1] = self.last[data[starts + lens - 1]]
        rank = np.full(len(sym), _NONE, np.int64)      # of the pair (this, next) in the same word
        if len(sym) > 1:
            rank[:-1] = self.ranks(sym[:-1], sym[1:])
            rank[bounds[:-1] - 1] = _NONE
        word = np.arange(len(starts))
        size = lens.astype(np.int64)
        done_ids, done_word = [], []
        while len(word):
            first = np.cumsum(size) - size
            # rank and place in one number: the smallest is the lowest rank, leftmost among equals
            at = np.arange(len(sym), dtype=np.int64) - np.repeat(first, size)
            best = np.minimum.reduceat(rank << 24 | at, first)
            go = best >> 24 < _NONE
            if not go.all():
                stay = np.repeat(~go, size)
                done_ids.append(sym[stay])
                done_word.append((word[~go], size[~go]))
                move = ~stay
                sym, rank = sym[move], rank[move]
                word, size, best = word[go], size[go], best[go]
                if not len(word):
                    break
                first = np.cumsum(size) - size
            p = first + (best & 0xFFFFFF)
            sym[p] = self.made[best >> 24]
            keep = np.ones(len(sym), bool)
            keep[p + 1] = False
            sym, rank = sym[keep], rank[keep]
            p = p - np.arange(len(p))
            size = size - 1
            last = np.cumsum(size) - 1
            rank[p] = _NONE
            inner = p < last
            rank[p[inner]] = self.ranks(sym[p[inner]], sym[p[inner] + 1])
            head = p > last - size + 1
            rank[p[head] - 1] = self.ranks(sym[p[head] - 1], sym[p[head]])
        if not done_word:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        order = np.concatenate([w for w, _ in done_word])
        n = np.concatenate([s for _, s in done_word])
        ids, start = np.concatenate(done_ids), np.cumsum(n) - n
        back = np.argsort(order)
        return ids[ragged(start[back], n[back])], n[back]


_NONE = np.int64(1 << 30)
#: words of more bytes are merged by buckets of ranks, one word at a time
LONG_WORD = 256

# -- the codec -------------------------------------------------------------------


class Codec:
    """Encodes batches of texts with the lexicon and the merger, and decodes ids."""

    def __init__(self, vocabulary: str, lexicon: str | None):
        self.vocabulary, self._rules = vocabulary, None
        with open(vocabulary, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        names = {i: t for t, i in spec["model"]["vocab"].items()} | {i: t for t, i in self.special.items()}
        self.names = [names.get(i, "").encode() for i in range(max(names) + 1)]
        self.decimal = [b"%d" % i for i in range(max(names) + 1)]
        self.letter = {x: b for b, x in enumerate(byte_letters())}
        self.merger = Merger(vocabulary)
        self.lexicon = Lexicon(lexicon) if lexicon else None
        if self.lexicon:
            self._fill()

    @property
    def rules(self):
        """The vocabulary's normalizer and splitter, loaded when a text beyond Latin-1 needs them."""
        if self._rules is None:
            from tokenizers import Tokenizer

            self._rules = Tokenizer.from_file(self.vocabulary)
        return self._rules

    def _fill(self) -> None:
        """ids of the lexicon's words by rank, from a walk in sorted order."""
        arcs: dict[int, list] = {}
        used = np.flatnonzero(np.asarray(self.lexicon.keys) >= 0)
        for s in used[np.argsort(np.asarray(self.lexicon.keys)[used])].tolist():
            key = int(self.lexicon.keys[s])
            arcs.setdefault(key >> 8, []).append((key & 255, int(self.lexicon.to[s])))
        words, stack = [], [(0, b"")]
        while stack:
            state, word = stack.pop()
            if self.lexicon.ends[state]:
                words.append(word)
            stack += [(to, word + bytes([byte])) for byte, to in reversed(arcs.get(state, []))]
        size = np.array([len(w) for w in words], np.int64)
        data = np.frombuffer(b"".join(words), np.uint8)
        self.pool, self.pool_len = self.merger.merge(data, np.cumsum(size) - size, size)
        self.pool_start = np.cumsum(self.pool_len) - self.pool_len

    def words(self, data: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, start and number of ids of each word)."""
        if self.lexicon is None:
            ids, n = self.merger.merge(data, starts, lens)
            return ids, np.cumsum(n) - n, n
        rank = self.lexicon.ranks(data, starts, lens)
        new = rank < 0
        ids, n = self.merger.merge(data, starts[new], lens[new])
        start, size = self.pool_start[rank], self.pool_len[rank]
        start[new], size[new] = len(self.pool) + np.cumsum(n) - n, n
        return np.concatenate([self.pool, ids]), start, size

    def batch(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All documents' ids in one array, and each document's bounds in it."""
        fast = fast_rows(data, off)
        if fast.all():
            return self._latin(data, off)
        parts, raw = [], data.tobytes()
        for i in range(len(off) - 1):
            if fast[i]:
                parts.append(self._latin(data[off[i]:off[i + 1]], np.array([0, off[i + 1] - off[i]]))[0])
            else:
                parts.append(self._any(raw[off[i]:off[i + 1]].decode("utf-8", "replace")))
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int64)

    def _latin(self, data, off):
        low, starts, lens, first = pretokens(data, off)
        _, example, number = distinct(low, starts, lens)
        ids, start, size = self.words(low, starts[example], lens[example])
        where, bounds = spread(start, size, number, first)
        return ids[where], bounds

    def _any(self, text: str) -> np.ndarray:
        """Any text: special tokens are cut out first, the rest is normalised and split by the vocabulary's rules."""
        for token, i in self.special.items():
            if token in text:
                parts = []
                for k, piece in enumerate(text.split(token)):
                    parts += [np.array([i], np.int64)] * (k > 0) + [self._any(piece)]
                return np.concatenate(parts)
        pieces = [p for p, _ in self.rules.pre_tokenizer.pre_tokenize_str(self.rules.normalizer.normalize_str(text))]
        words = [bytes(self.letter[c] for c in p) for p in pieces if p]
        if not words:
            return np.zeros(0, np.int64)
        size = np.array([len(w) for w in words], np.int64)
        ids, start, n = self.words(np.frombuffer(b"".join(words), np.uint8), np.cumsum(size) - size, size)
        return ids[ragged(start, n)]

    def decode(self, ids: list[int]) -> bytes:
        """Token strings joined by a space: the vocabulary names no decoder."""
        names = self.names
        return b" ".join([names[i] for i in ids])


_CODECS: dict[tuple, Codec] = {}


def codec(vocabulary: str, lexicon: bytes) -> Codec:
    """The worker's codec; the lexicon becomes a file of the worker's own that is mapped and then unlinked."""
    key = (vocabulary, hashlib.sha256(lexicon).digest())
    if key not in _CODECS:
        _CODECS.clear()
        with tempfile.NamedTemporaryFile() as f:
            f.write(lexicon)
            f.flush()
            _CODECS[key] = Codec(vocabulary, f.name)
    return _CODECS[key]


# -- Spark -------------------------------------------------------------------------


def frequent_words(df: DataFrame, text_col: str = "text", words: int = 50_000) -> list[bytes]:
    """The most frequent pre-tokens over all of ``df``, ``words`` at most.

    Map tasks pre-count their own; classes of about equal frequency are taken
    whole, from the most frequent on, so at most ``words`` reach the driver.
    """
    prepare(df.sparkSession)

    def count(batches):
        seen: dict[bytes, int] = {}

        def flush():
            if seen:
                yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()),
                                                  pa.array(list(seen.values()), pa.int64())], names=["word", "n"])
            seen.clear()

        for batch in batches:
            data, off = column_bytes(batch.column(0))
            for _, _, part, po in chunks(data, off):
                low, starts, lens, _ = pretokens(part, po)
                _, example, number = distinct(low, starts, lens)
                raw, many = low.tobytes(), np.bincount(number, minlength=len(example))
                for a, n, m in zip(starts[example].tolist(), lens[example].tolist(), many.tolist()):
                    w = raw[a:a + n]
                    seen[w] = seen.get(w, 0) + m
                if len(seen) > 200_000:
                    yield from flush()
        yield from flush()

    counts = df.select(text_or_empty(text_col).alias("text")).mapInArrow(count, "word binary, n long")
    counts = materialize(counts.groupBy("word").agg(F.sum("n").alias("n")), "word-counts")
    step = F.floor(F.log2("n") * 64).cast("int")      # 64 classes of frequency to each doubling
    sizes = counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("many")).orderBy(F.desc("step")).collect()
    taken, least = 0, None
    for r in sizes:
        if taken + r.many > words:
            break
        taken, least = taken + r.many, r.step
    if least is None:
        return []
    return [bytes(r.word) for r in counts.where(step >= least).select("word").collect()]


def build_lexicon(df: DataFrame, text_col: str = "text", words: int = 50_000) -> bytes:
    """The lexicon of ``df``'s frequent words; its size is bounded by ``words`` (a few MB), so it may be broadcast."""
    return compile_lexicon(frequent_words(df, text_col, words))


def encode(df: DataFrame, vocabulary: str, lexicon: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and ``ids`` (array<int>) of every row: whole texts, no special tokens added, null as empty."""
    prepare(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches):
        coder = codec(vocabulary, shared.value)
        for batch in batches:
            data, off = column_bytes(batch.column(1))
            for i, j, part, po in chunks(data, off):
                ids, bounds = coder.batch(part, po)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(i, j - i),
                    pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))],
                    names=["id", "ids"])

    source = df.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    return source.mapInArrow(run, "id long, ids array<int>").withColumnRenamed("id", id_col)


def decode(df: DataFrame, vocabulary: str, lexicon: bytes, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``df`` with the decoded text of its ids added (null ids: empty text)."""
    shared = df.sparkSession.sparkContext.broadcast(lexicon)

    @F.pandas_udf("string")
    def text(ids):
        coder = codec(vocabulary, shared.value)
        return ids.map(lambda x: coder.decode([] if x is None else list(x)).decode())

    return df.withColumn(out_col, text(F.col(ids_col)))


def encode_decode(df: DataFrame, vocabulary: str, lexicon: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ids, n_tokens and the text decoded from the ids, of every row (null text: empty)."""
    prepare(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches):
        coder = codec(vocabulary, shared.value)
        for batch in batches:
            data, off = column_bytes(batch.column(1))
            for i, j, part, po in chunks(data, off):
                ids, bounds = coder.batch(part, po)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(i, j - i), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32())),
                    pa.array(np.diff(bounds)),
                    pa.array([coder.decode(ids[a:b].tolist()).decode() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())])],
                    names=["id", "ids", "n_tokens", "decoded"])

    source = df.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    return source.mapInArrow(run, "id long, ids array<int>, n_tokens long, decoded string").withColumnRenamed("id", id_col)


def codec_digest(df: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
                 words: int = 50_000) -> DataFrame:
    """Encode and decode every text; per row id, n_tokens and digests of the ids and of the decoded text.

    A null text is empty (0 tokens, digests of nothing); rows with equal or null
    ids are rows like others; only the two named columns are read; an empty
    table gives no rows.
    """
    spark: SparkSession = df.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(build_lexicon(df, text_col, words))

    def run(batches):
        coder = codec(vocabulary, shared.value)
        sha, decimal = hashlib.sha256, coder.decimal
        for batch in batches:
            data, off = column_bytes(batch.column(1))
            for i, j, part, po in chunks(data, off):
                ids, bounds = coder.batch(part, po)
                lists = [ids[a:b].tolist() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(i, j - i), pa.array(np.diff(bounds)),
                    pa.array([sha(b" ".join([decimal[x] for x in d])).hexdigest() for d in lists]),
                    pa.array([sha(coder.decode(d)).hexdigest() for d in lists])],
                    names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    source = df.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    return (source.mapInArrow(run, "id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
            .withColumnRenamed("id", id_col))

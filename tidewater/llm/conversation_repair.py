"""Repair of the role structure of conversations by a run-length dynamic program.

A conversation's rows become symbols: the initial of the role (s, u, a or
another) and the fault (none, truncated, or one that must be deleted). The
cheapest edits that give role initials ``(s?(ua)+)?`` are a shortest path over
four states (start, after s, after u, after a). A row's step is a 4 x 4 min-plus
matrix that depends on its symbol alone, so equal consecutive symbols form a run
whose matrix is a power of the symbol's: costs are advanced over a run by cached
binary powers, from the last run to the first. The edits are then unrolled from
the first row on; of equally cheap edits the letter that is first in ASCII is
taken, which gives the least of all cheapest audits. Inside a run the costs at
each row come from halving: the costs at the middle of a block of 2**k rows are
the costs at its end advanced by 2**(k-1) rows.

Scale: equal rows are counted before the shuffle, duplicates come from one grouped
aggregate, rows are range-sorted by (conversation, turn), so no task holds more
than its range. A task packs them into pieces of bounded size. A conversation that
lies in one piece is finished at once. One that does not, whatever its size, goes
on as pieces: a backward scan over their runs gives the costs behind each piece
and, for each of the four entry states, its exit state; a forward scan gives the
entry states; then every piece is unrolled where it is, and a last scan joins
audits and hashes in order. The scans hold one piece at a time.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import materialize, prepare, shuffle_partitions

WHITE = r"\x20\x09-\x0D"
#: rows and text bytes of a piece
PIECE_ROWS, PIECE_BYTES = 1024, 1 << 16
START, AFTER_S, AFTER_U, AFTER_A = range(4)
_STATES = range(4)
_FAR = 1 << 60
RETYPE, DELETE, INSERT, CUT_SHORT = 2, 3, 2, 1
#: the role that an insertion or a new role must have in a state, and the state behind each initial
_NEXT_ROLE = ("user", "user", "assistant", "user")
_FORCED = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)
_BY_INITIAL = {"s": {START: AFTER_S}, "u": {START: AFTER_U, AFTER_S: AFTER_U, AFTER_A: AFTER_U}, "a": {AFTER_U: AFTER_A}}
#: costs behind the last row: empty, or after an assistant
_END = (0, _FAR, _FAR, 0)

# -- symbols and their matrices -----------------------------------------------------------
#
# A symbol is a byte: 's', 'u', 'a' or 'o' (another role), capital if truncated, 'x' if it must be deleted.


def _with_insertions(cost: list[int]) -> tuple[int, ...]:
    """Least cost by state when any number of rows may be inserted first."""
    best = list(cost)
    for _ in _STATES:
        best = [min(best[q], INSERT + best[_FORCED[q]]) for q in _STATES]
    return tuple(best)


def _row_choices(symbol: str, state: int):
    """(letter, cost, next state) of what may be done with a row, letters in ASCII order; insertions are not among them."""
    yield "D", DELETE, state
    if symbol != "x":
        extra = CUT_SHORT if symbol.isupper() else 0
        to = _BY_INITIAL.get(symbol.lower(), {}).get(state)
        if to is not None:
            yield "K", extra, to
        yield "R", RETYPE + extra, _FORCED[state]


def times(a: tuple, b: tuple) -> tuple:
    """The min-plus product of two 4 x 4 matrices."""
    return tuple(tuple(min(_FAR, min(a[p][m] + b[m][q] for m in _STATES)) for q in _STATES) for p in _STATES)


def advance(matrix: tuple, cost: tuple) -> tuple:
    """Costs before the rows of ``matrix`` from the costs behind them."""
    return tuple(min(_FAR, min(matrix[p][q] + cost[q] for q in _STATES)) for p in _STATES)


@lru_cache(maxsize=None)
def power(symbol: str, k: int) -> tuple:
    """The matrix of 2**k rows of one symbol (a handful of symbols, at most 63 powers each)."""
    if k:
        half = power(symbol, k - 1)
        return times(half, half)
    columns = []
    for q in _STATES:                                   # cost from each state to q over one row, insertions before it included
        direct = [min([c for _, c, to in _row_choices(symbol, p) if to == q], default=_FAR) for p in _STATES]
        columns.append(_with_insertions(direct))
    return tuple(tuple(columns[q][p] for q in _STATES) for p in _STATES)


def before_run(symbol: str, n: int, cost: tuple) -> tuple:
    k = 0
    while n >> k:
        if n >> k & 1:
            cost = advance(power(symbol, k), cost)
        k += 1
    return cost


def before(runs: tuple, cost: tuple) -> tuple:
    """Costs before ``runs`` ((symbol, rows) in order) from the costs behind them."""
    for symbol, n in reversed(runs):
        cost = before_run(symbol, n, cost)
    return cost


def run_costs(symbol: str, n: int, cost: tuple):
    """Costs behind each row of a run, first row first, by halving blocks of binary sizes."""
    blocks, rest, k = [], n, 0
    while rest >> k:                                    # the last block of a run is its smallest
        if rest >> k & 1:
            blocks.append((k, cost))
            cost = advance(power(symbol, k), cost)
        k += 1
    stack = blocks                                      # the block on top is the first in the run
    while stack:
        k, behind = stack.pop()
        if k == 0:
            yield behind
        else:
            stack.append((k - 1, behind))
            stack.append((k - 1, advance(power(symbol, k - 1), behind)))


def unroll(runs: tuple, behind: tuple, state: int, last: bool) -> tuple[str, int]:
    """The least of the cheapest audits of ``runs`` from ``state``, and the state behind them.

    ``behind``: costs behind the last row. Insertions before a row belong to it;
    those behind the last row of a conversation (``last``) follow at the end.
    """
    costs = [behind]                                    # behind each run
    for symbol, n in reversed(runs[1:]):
        costs.append(before_run(symbol, n, costs[-1]))
    out = []
    for symbol, n in runs:
        for cost in run_costs(symbol, n, costs.pop()):
            state = _edit(symbol, cost, state, out)
    while last and state not in (START, AFTER_A):
        out.append("I")
        state = _FORCED[state]
    return "".join(out), state


def _edit(symbol: str, cost: tuple, state: int, out: list) -> int:
    """Letters up to and including a row's own; the state behind the row."""
    while True:
        here = _one_row(symbol, cost)
        choices = [(letter, to) for letter, c, to in _row_choices(symbol, state) if c + cost[to] == here[state]]
        insert = INSERT + here[_FORCED[state]] == here[state]
        if insert and (not choices or choices[0][0] != "D"):
            out.append("I")
            state = _FORCED[state]
            continue
        out.append(choices[0][0])
        return choices[0][1]


@lru_cache(maxsize=1 << 16)
def _one_row(symbol: str, cost: tuple) -> tuple:
    return advance(power(symbol, 0), cost)


def last_costs() -> tuple:
    return _with_insertions(list(_END))


def plan(runs: tuple) -> tuple[str, int]:
    """Audit and cost of a whole conversation."""
    return _short_plan(runs) if len(runs) <= 16 and sum(n for _, n in runs) <= 64 else _plan(runs)


def _plan(runs: tuple) -> tuple[str, int]:
    cost = last_costs()
    return unroll(runs, cost, START, True)[0], before(runs, cost)[START]


#: short conversations repeat their patterns of symbols
_short_plan = lru_cache(maxsize=1 << 15)(_plan)


def repaired(audit: str, state: int, rows) -> list[str]:
    """``role:text`` of what the edits leave; rows: (role, text) in order, as often as they stand there."""
    out = []
    rows = iter(rows)
    for letter in audit:
        if letter == "I":
            out.append(_NEXT_ROLE[state] + ":")
            state = _FORCED[state]
            continue
        role, text = next(rows)
        if letter == "K":
            out.append(f"{role}:{text}")
            state = _BY_INITIAL[role[0]][state]
        elif letter == "R":
            out.append(f"{_NEXT_ROLE[state]}:{text}")
            state = _FORCED[state]
    return out


# -- Spark -----------------------------------------------------------------------------------


def marked_rows(df: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str, copies: Column) -> DataFrame:
    """Distinct rows (conv, turn, role, text) with their number and faults, range-sorted by conversation and turn."""
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" ")) for c in (role_col, text_col))
    there = copies > 0                                     # a row that is not there only names its conversation
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("conv"), F.when(there, F.col(f"`{turn_col}`").cast("long")).alias("turn"),
                     F.when(there, role).alias("role"), F.when(there, text).alias("text"), copies.cast("long").alias("copies"))
    rows = rows.groupBy("conv", "turn", "role", "text").agg(F.sum("copies").alias("copies")).withColumn("k", F.md5("text"))
    rows = materialize(rows, "turns")
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    often = (rows.where("copies > 0").groupBy("conv", "role", "k").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("many")).where("many > 1")
             .select(F.col("conv").alias("conv2"), F.col("role").alias("role2"), F.col("k").alias("k2"), "first"))
    same = F.col("conv").eqNullSafe(F.col("conv2")) & (F.col("role") == F.col("role2")) & (F.col("k") == F.col("k2"))
    again = F.col("first").isNotNull() & ~place.eqNullSafe(F.col("first"))
    rows = rows.join(often, same, "left").select(
        "conv", "turn", "role", "text", "copies", "k", again.alias("again"), (~F.col("text").rlike(f"[^{WHITE}]")).alias("blank"),
        (~F.col("text").rlike(rf"[.!?][{WHITE}]*\z")).alias("cut"))
    parts = shuffle_partitions(df.sparkSession)
    return rows.repartitionByRange(parts, "conv", "turn", "role", "k").sortWithinPartitions("conv", "turn", "role", "k").drop("k")


class _Piece:
    """Rows of one conversation that follow each other, up to the bounds of a piece."""

    def __init__(self, conv):
        self.conv, self.rows, self.size = conv, [], 0
        self.symbols, self.lengths = [], []
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.head = self.tail = self.first_turn = self.last_turn = None

    def _symbol(self, symbol: str, n: int) -> None:
        if self.symbols and self.symbols[-1] == symbol:
            self.lengths[-1] += n
        elif n:
            self.symbols.append(symbol)
            self.lengths.append(n)

    def add(self, turn, role: str, text: str, copies: int, again: bool, blank: bool, cut: bool) -> None:
        self.rows.append((role, text, copies))
        self.size += len(text)
        initial = role[:1]
        self.illegal += copies - 1 + (self.tail is not None and self.tail + initial not in _LEGAL)
        if self.head is None:
            self.head = initial
        self.tail = initial
        if turn is not None:
            self.turns += turn != self.last_turn
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        if blank or again:
            self.blank += copies if blank else 0
            self.duplicate += 0 if blank else copies
            self._symbol("x", copies)
            return
        self.truncated += cut
        self.duplicate += copies - 1
        kind = initial if initial in _BY_INITIAL else "o"
        self._symbol(kind.upper() if cut else kind, 1)
        self._symbol("x", copies - 1)

    def runs(self) -> tuple:
        return tuple(zip(self.symbols, self.lengths))


_LEGAL = ("su", "ua", "au")
_COUNTS = ("blank", "duplicate", "truncated", "illegal")
_RESULT = "conv long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_PIECES = ("conv long, done boolean, seq long, blank long, duplicate long, truncated long, illegal long, turns long, first_turn long, last_turn long, "
           "head string, tail string, symbols string, lengths array<long>, roles array<string>, texts array<string>, copies array<long>, "
           "gaps long, cost long, audit string, repaired_sha256 string")
_KEPT = ("conv", "seq", "total", *_COUNTS, "turns", "first_turn", "last_turn", "head", "tail")
_EDITED = ", ".join(f"{c} {'string' if c in ('head', 'tail') else 'long'}" for c in _KEPT) + ", audit string, text string"
_ARROW = pa.schema([(name, {"long": pa.int64(), "boolean": pa.bool_(), "string": pa.string(), "array<long>": pa.list_(pa.int64()),
                            "array<string>": pa.list_(pa.string())}[kind]) for name, kind in (c.split() for c in _PIECES.split(", "))])
_WIDEST = (1 << 63) - 1


def _gaps(first, last, turns: int) -> int:
    return 0 if first is None else min(_WIDEST, last - first + 1 - turns)


def _often(rows):
    for role, text, copies in rows:
        for _ in range(copies):
            yield role, text


def _pack():
    """Pieces of a sorted partition; conversations that surely lie in one piece are finished."""
    def run(batches):
        from pyspark import TaskContext

        seq, out, held = TaskContext.get().partitionId() << 40, [], 0
        piece, first_of_task, cut_off = None, True, False

        def record(p: _Piece, done: bool) -> dict:
            nonlocal seq, held
            seq += 1
            got = {"conv": p.conv, "done": done, "seq": seq, **{c: getattr(p, c) for c in _COUNTS}, "turns": p.turns, "first_turn": p.first_turn,
                   "last_turn": p.last_turn, "head": p.head, "tail": p.tail}
            if not done:
                got |= {"symbols": "".join(p.symbols), "lengths": p.lengths, "roles": [r for r, _, _ in p.rows],
                        "texts": [t for _, t, _ in p.rows], "copies": [n for _, _, n in p.rows]}
                held += p.size
            else:
                audit, cost = plan(p.runs())
                text = "\n".join(repaired(audit, START, _often(p.rows)))
                got |= {"gaps": _gaps(p.first_turn, p.last_turn, p.turns), "cost": cost, "audit": audit,
                        "repaired_sha256": hashlib.sha256(text.encode()).hexdigest()}
            return got

        def flush(least: int):
            nonlocal out, held
            if len(out) >= least or held >= PIECE_BYTES:
                batch = pa.RecordBatch.from_pylist(out, schema=_ARROW)
                out, held = [], 0
                yield batch

        for batch in batches:
            for conv, turn, role, text, copies, again, blank, cut in zip(*(c.to_pylist() for c in batch.columns)):
                if piece is None or piece.conv != conv:
                    if piece is not None:
                        out.append(record(piece, not first_of_task and not cut_off))
                        first_of_task = False
                        yield from flush(1000)
                    piece, cut_off = _Piece(conv), False
                elif len(piece.rows) >= PIECE_ROWS or piece.size >= PIECE_BYTES:
                    out.append(record(piece, False))
                    yield from flush(1)
                    piece, cut_off = _Piece(conv), True
                if copies:
                    piece.add(turn, role, text, copies, again, blank, cut)
        if piece is not None:
            out.append(record(piece, False))
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=_ARROW)
    return run


def _scan(df: DataFrame, order: list, step, schema: str) -> DataFrame:
    """Each conversation's rows in order through ``step(state, row) -> (state, rows out)``; a last call has no row."""
    names = df.columns

    def run(batches):
        state, at, out = None, (), []
        for batch in batches:
            for values in zip(*(c.to_pylist() for c in batch.columns)):
                row = dict(zip(names, values))
                if at != (row["conv"],):
                    if at:
                        out += step(state, None)[1]
                    state, at = None, (row["conv"],)
                state, got = step(state, row)
                out += got
            if out:
                yield _table(out, schema)
                out = []
        if at:
            out += step(state, None)[1]
        if out:
            yield _table(out, schema)

    return df.repartition(shuffle_partitions(df.sparkSession), "conv").sortWithinPartitions("conv", *order).mapInArrow(run, schema)


def _table(rows: list[dict], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "string": pa.string(), "array<long>": pa.list_(pa.int64()),
             "array<int>": pa.list_(pa.int32())}
    return pa.RecordBatch.from_pylist(rows, schema=pa.schema([(n, kinds[k]) for n, k in (c.split() for c in schema.split(", "))]))


def _backward(state, row):
    """Costs behind each piece, and its exit state for each entry state; the last piece comes first."""
    if row is None:
        return None, []
    last = state is None
    behind = last_costs() if last else state
    runs = tuple(zip(row["symbols"], row["lengths"]))
    costs = before(runs, behind)
    exits = [unroll(runs, behind, q, last)[1] for q in _STATES]
    return costs, [{"conv": row["conv"], "seq": row["seq"], "behind": list(behind), "exits": exits, "last": last, "cost": costs[START]}]


def _forward(state, row):
    """The state in which each piece is entered."""
    if row is None:
        return None, []
    entry = START if state is None else state
    return row["exits"][entry], [{"conv": row["conv"], "seq": row["seq"], "entry": entry, "behind": row["behind"], "last": row["last"],
                                  "total": row["cost"] if state is None else None}]


def _edits(batches):
    """Each piece's part of the audit and of the repaired text, beside its counts."""
    for batch in batches:
        for k in range(batch.num_rows):
            row, = batch.slice(k, 1).to_pylist()
            audit = unroll(tuple(zip(row["symbols"], row["lengths"])), tuple(row["behind"]), row["entry"], row["last"])[0]
            text = "\n".join(repaired(audit, row["entry"], _often(zip(row["roles"], row["texts"], row["copies"]))))
            yield _table([{c: row[c] for c in _KEPT} | {"audit": audit, "text": text}], _EDITED)


def _fold(state, row):
    """One result row of a conversation from its pieces in order."""
    if row is None:
        total, digest, audit, tail, filled = state
        first, last, turns = total.pop("first_turn"), total.pop("last_turn"), total.pop("turns")
        return None, [total | {"gaps": _gaps(first, last, turns), "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}]
    if state is None:
        state = ({"conv": row["conv"], "cost": row["total"], "turns": 0, "first_turn": None, "last_turn": None, **dict.fromkeys(_COUNTS, 0)},
                 hashlib.sha256(), [], None, False)
    total, digest, audit, tail, filled = state
    for c in _COUNTS:
        total[c] += row[c]
    if row["first_turn"] is not None:
        total["turns"] += row["turns"] - (row["first_turn"] == total["last_turn"])
        total["first_turn"] = row["first_turn"] if total["first_turn"] is None else total["first_turn"]
        total["last_turn"] = row["last_turn"]
    if row["head"] is not None:
        total["illegal"] += tail is not None and tail + row["head"] not in _LEGAL
        tail = row["tail"]
    audit.append(row["audit"])
    if row["text"]:
        digest.update((b"\n" if filled else b"") + row["text"].encode())
        filled = True
    return (total, digest, audit, tail, filled), []


def _entered(open_pieces: DataFrame) -> DataFrame:
    """seq, entry state, costs behind, whether it is the last, and (first piece) the conversation's cost, of each open piece."""
    runs = open_pieces.select("conv", "seq", "symbols", "lengths")
    back = materialize(_scan(runs, [F.desc("seq")], _backward, "conv long, seq long, behind array<long>, exits array<int>, last boolean, cost long"),
                       "conversation-costs")
    ahead = _scan(back, [F.asc("seq")], _forward, "conv long, seq long, entry int, behind array<long>, last boolean, total long")
    return materialize(ahead, "conversation-entries").drop("conv")


def repair(df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
           copies: Column | None = None) -> DataFrame:
    """One row per conversation: id, gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256.

    Rows of a conversation stand in the order of their turns, null turns first;
    rows of one turn by role, then by a digest of their text. ``copies`` says how
    often a row stands there (adjacent, same turn; 1 unless given); rows with 0
    copies only name their conversation. A null role or text is one space; a null
    id is a conversation of its own. The first fault of a row counts: blank,
    duplicate (role and text seen earlier), truncated. A conversation without rows
    has zeros, an empty audit and the hash of nothing. Other columns are not read;
    an empty table gives no rows.
    """
    prepare(df.sparkSession)
    rows = marked_rows(df, id_col, turn_col, role_col, text_col, F.lit(1) if copies is None else copies)
    pieces = materialize(rows.mapInArrow(_pack(), _PIECES), "conversation-pieces")
    result = [c.split()[0] for c in _RESULT.split(", ")]
    open_pieces = pieces.where("NOT done")
    edited = open_pieces.join(_entered(open_pieces), "seq").select(*_KEPT, "symbols", "lengths", "roles", "texts", "copies", "entry", "behind", "last")
    folded = _scan(edited.mapInArrow(_edits, _EDITED), [F.asc("seq")], _fold, _RESULT)
    return pieces.where("done").select(*result).unionByName(folded.select(*result)).withColumnRenamed("conv", id_col)

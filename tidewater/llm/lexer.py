"""Pre-tokens of the word BPE vocabulary, found in numpy over UTF-8 bytes.

The vocabulary's rules are: NFC, each white-space run to one space, lower case,
then the pattern ``'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+``.
Texts of ASCII and Latin-1 characters need no NFC and are cut here; for others
``fast_rows`` is False and the caller takes the tokenizer's own rules.
"""

from __future__ import annotations

import numpy as np

from .common import ragged, span_hash

_SEP, _OTHER, _LETTER, _NUMBER = 0, 1, 2, 3


def _tables():
    one = np.full(256, _OTHER, np.uint8)
    one[[9, 10, 11, 12, 13, 32]] = _SEP
    one[48:58] = _NUMBER
    one[65:91] = one[97:123] = _LETTER
    c2 = np.full(256, _OTHER, np.uint8)          # U+0080 - U+00BF by the second byte
    c2[[0x85, 0xA0]] = _SEP
    c2[[0xAA, 0xB5, 0xBA]] = _LETTER
    c2[[0xB2, 0xB3, 0xB9, 0xBC, 0xBD, 0xBE]] = _NUMBER
    c3 = np.full(256, _LETTER, np.uint8)         # U+00C0 - U+00FF
    c3[[0x97, 0xB7]] = _OTHER
    return one, c2, c3


_ONE, _C2, _C3 = _tables()
#: bytes that make a text leave the fast path: lead bytes beyond Latin-1, separators of some engines only, NUL
_RARE = np.zeros(256, bool)
_RARE[0xC4:] = True
_RARE[[0, 0x1C, 0x1D, 0x1E, 0x1F]] = True
_SUFFIXES = [b"s", b"t", b"m", b"d", b"re", b"ve", b"ll"]


def fast_rows(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Which documents are cut by ``pretokens`` (Latin-1, no special-token text)."""
    bad = np.concatenate([[0], np.cumsum(_RARE[data])])
    ok = bad[off[1:]] == bad[off[:-1]]
    raw = data.tobytes()
    if b"<|" in raw:
        for i in np.flatnonzero(ok):
            ok[i] = b"<|" not in raw[off[i]:off[i + 1]]
    return ok


def pretokens(data: np.ndarray, off: np.ndarray):
    """Lower-cased bytes, and starts, lengths and first-token positions of all documents' pre-tokens."""
    n = len(data)
    if not n:
        return data, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    cls = _ONE[data]
    low = data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)
    for lead, table in ((0xC2, _C2), (0xC3, _C3)):
        at = np.flatnonzero(data == lead)
        if len(at):
            second = data[at + 1]
            cls[at] = cls[at + 1] = table[second]
            if lead == 0xC3:
                big = (second >= 0x80) & (second <= 0x9E) & (second != 0x97)
                low[at[big] + 1] = second[big] + 32
    tail = (data >= 0x80) & (data < 0xC0)
    edge = np.ones(n, bool)
    edge[1:] = (cls[1:] != cls[:-1]) | (cls[1:] == _NUMBER)
    edge[off[:-1][off[:-1] < n]] = True
    edge &= ~tail
    at = np.flatnonzero(low == 39)
    if len(at):                                   # contractions: a quote that starts a token, then a suffix
        at = at[edge[at] & (at + 1 < n)]
        pad = np.concatenate([low, np.zeros(3, np.uint8)])
        ends = np.searchsorted(off, at, "right")
        limit = off[np.minimum(ends, len(off) - 1)]
        for suffix in _SUFFIXES:
            hit = at + len(suffix) < limit
            for k, c in enumerate(suffix):
                hit &= pad[at + 1 + k] == c
            q = at[hit]
            edge[q + 1] = False
            after = q + 1 + len(suffix)
            after = after[after < n]
            edge[after] = True                    # what follows is a token of its own
    starts = np.flatnonzero(edge)
    ends = np.append(starts[1:], n)
    word = cls[starts] != _SEP
    starts, ends = starts[word], ends[word]
    return low, starts, ends - starts, np.searchsorted(starts, off)


def distinct(low: np.ndarray, starts: np.ndarray, lens: np.ndarray):
    """Distinct tokens by a 64-bit hash: (hashes, one example of each, each token's number)."""
    hashes, example, number = np.unique(span_hash(low, starts, lens), return_index=True, return_inverse=True)
    return hashes, example, number


def spread(pool_start: np.ndarray, pool_len: np.ndarray, number: np.ndarray, first: np.ndarray):
    """Pool positions of all tokens' ids in text order, and each document's first id."""
    lens = pool_len[number]
    bounds = np.concatenate([[0], np.cumsum(lens)])
    return ragged(pool_start[number], lens), bounds[first]

"""Words, word hashes and k-word windows of many texts at once.

Works on the UTF-8 bytes of an Arrow string column: word classes here only
tell ASCII bytes apart, and every byte of a longer character is a word byte,
so byte-wise and character-wise words agree.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_RNG = np.random.Generator(np.random.PCG64(20240229))
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MULTS = _RNG.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: Bytes that words are made of: ``space`` is [^\x20\x09-\x0D], ``alnum`` is
#: [^\x00-\x2F\x3A-\x60\x7B-\x7F] of a text whose A-Z are lower-cased.
CLASSES = {"space": np.ones(256, dtype=bool), "alnum": np.zeros(256, dtype=bool)}
CLASSES["space"][[32, *range(9, 14)]] = False
CLASSES["alnum"][[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True

#: Texts are taken together up to so many bytes; a longer one goes alone.
CHUNK_BYTES = 1 << 20


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(out, dtype=np.uint64)


_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_POW: list[np.ndarray] = [_powers(_BASE, 1), _powers(_INVERSE, 1)]


def mixed(h: np.ndarray) -> np.ndarray:
    """Finaliser: spreads every bit of a 64-bit hash over all bits."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; nulls are empty texts."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(texts.type)
    off = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)
    off = off[texts.offset: texts.offset + len(texts) + 1].astype(np.int64)
    buf = texts.buffers()[2]
    data = np.frombuffer(buf, np.uint8)[off[0]: off[-1]] if buf is not None else np.zeros(0, np.uint8)
    return data, off - off[0]


def row_chunks(texts: pa.Array, most: int = CHUNK_BYTES):
    """(first row, end row, bytes, offsets) of runs of rows of about ``most`` bytes."""
    data, off = text_bytes(texts)
    row, n = 0, len(off) - 1
    while row < n:
        end = max(row + 1, int(np.searchsorted(off, off[row] + most, side="right")) - 1)
        yield row, end, data[off[row]: off[end]], off[row: end + 1] - off[row]
        row = end


@dataclass
class Words:
    """Words of some rows, in order: byte spans, row of each, hash of each."""

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    hash: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1

    def counts(self) -> np.ndarray:
        return np.bincount(self.row, minlength=self.rows)

    def firsts(self) -> np.ndarray:
        """Index of each row's first word (and the end)."""
        return np.concatenate([[0], np.cumsum(self.counts())])

    def text(self, first: int, n: int, lower: bool = True) -> str:
        """Words first .. first+n-1, joined by one space."""
        parts = [self.data[a:b].tobytes() for a, b in zip(self.start[first: first + n], self.end[first: first + n])]
        joined = b" ".join(parts)
        return (joined.lower() if lower else joined).decode("utf-8", "replace")

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word index, hash) of each run of k words of one row."""
        m = len(self.hash) - k + 1
        if m <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.flatnonzero(self.row[:m] == self.row[k - 1:])
        return at, run_hash(self.hash, at, k)


def run_hash(h: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k hashes from each index in ``at`` on."""
    with np.errstate(over="ignore"):
        total = np.full(len(at), np.uint64(k) * _BASE, dtype=np.uint64)
        for j in range(k):
            total += h[at + j] * _MULTS[j % 64] if j < 64 else mixed(h[at + j] + np.uint64(j)) * _MULTS[j % 64]
    return mixed(total)


def position_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """(inverse powers, powers) of the base for positions 0 .. n at least."""
    if len(_POW[0]) <= n:
        _POW[:] = [_powers(_BASE, max(n + 1, CHUNK_BYTES + 1)), _powers(_INVERSE, max(n + 1, CHUNK_BYTES + 1))]
    return _POW[1], _POW[0]


def string_hashes(strings: pa.Array) -> np.ndarray:
    """64-bit hash of each whole string."""
    out = np.zeros(len(strings), np.uint64)
    for a, b, data, off in row_chunks(strings):
        out[a:b] = span_hash(data, off[:-1], off[1:], lower=False)
    return out


def span_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool) -> np.ndarray:
    """Hash of the bytes of each span (A-Z as a-z, if ``lower``)."""
    n = len(data)
    inverse, forward = position_powers(n)
    with np.errstate(over="ignore"):
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((_BYTE[_LOWER] if lower else _BYTE)[data] * forward[:n], out=total[1:])
        return mixed((total[end] - total[start]) * inverse[start])


def words(data: np.ndarray, offsets: np.ndarray, kind: str, lower: bool) -> Words:
    n = len(data)
    inside = CLASSES[kind][data]
    before = np.empty(n, dtype=bool)
    before[1:], before[:1] = inside[:-1], False
    before[offsets[:-1][offsets[:-1] < n]] = False
    start = np.flatnonzero(inside & ~before)
    after = np.empty(n, dtype=bool)
    after[:-1], after[-1:] = inside[1:], False
    ends = offsets[1:]
    after[ends[ends > 0] - 1] = False
    end = np.flatnonzero(inside & ~after) + 1
    row = np.searchsorted(offsets, start, side="right") - 1
    return Words(data, offsets, start, end, row, span_hash(data, start, end, lower))

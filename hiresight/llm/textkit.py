"""Bytes-level text helpers used inside tasks: tokens, spans and 64-bit hashes.

All of them work on UTF-8 bytes, so a batch of texts costs a handful of numpy
calls per document and no per-word Python objects.
"""
from __future__ import annotations

import binascii
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

MASK = (1 << 64) - 1

#: A-Z to a-z, every other byte unchanged.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: A-Z to a-z; digits, a-z and all bytes of non-ASCII characters unchanged; the rest to a blank.
ALNUM_LOWER = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Longest run of bytes hashed at once; longer texts go in pieces cut between words.
_PIECE = 1 << 20
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) <= n:
        size = max(1 << 14, 1 << int(n).bit_length())
        out = []
        for base in (_BASE, _BASE_INV):
            with np.errstate(over="ignore"):
                steps = np.full(size, np.uint64(base))
                steps[0] = 1
                out.append(np.multiply.accumulate(steps))
        _powers[:] = out
    return _powers[0], _powers[1]


def mix64(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    with np.errstate(over="ignore"):
        h = h ^ (h >> np.uint64(33))
        h = h * np.uint64(0xFF51AFD7ED558CCD)
        h = h ^ (h >> np.uint64(33))
        h = h * np.uint64(0xC4CEB9FE1A85EC53)
        return h ^ (h >> np.uint64(33))


def each_text(column: pa.Array) -> Iterator[bytes | None]:
    """The UTF-8 bytes of a string array's values, a few at a time as Python objects."""
    for at in range(0, len(column), 128):
        yield from column.slice(at, 128).cast(pa.large_binary()).to_pylist()


def words(text: bytes | None, table: bytes = LOWER) -> list[bytes]:
    """Lower-cased words between blanks (0x20, 0x09-0x0D)."""
    return text.translate(table).split() if text else []


class Spans:
    """Hashes of any byte runs of ``a``, from one running sum."""

    def __init__(self, a: np.ndarray):
        self.bytes = a
        up, self.down = _power_tables(len(a))
        with np.errstate(over="ignore"):
            self.run = np.zeros(len(a) + 1, np.uint64)
            np.cumsum(_BYTE[a] * up[: len(a)], out=self.run[1:])

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix64((self.run[ends] - self.run[starts]) * self.down[starts])


def shingle_hashes(ws: list[bytes], k: int) -> np.ndarray:
    """64-bit hashes of all runs of ``k`` words, in text order.  Fewer than
    ``k`` words (but not none) make one run of all of them."""
    if not ws:
        return np.empty(0, np.uint64)
    if len(ws) < k:
        k = len(ws)
    lengths = np.fromiter(map(len, ws), np.int64, len(ws))
    total = int(lengths.sum()) + len(ws)
    if total <= _PIECE:
        return _piece(ws, lengths, k)
    out, at = [], 0
    ends = np.cumsum(lengths + 1)
    while at + k <= len(ws):
        base = ends[at - 1] if at else 0
        stop = max(at + k, int(np.searchsorted(ends, base + _PIECE)))
        out.append(_piece(ws[at:stop], lengths[at:stop], k))
        at = stop - k + 1
    return np.concatenate(out)


def _piece(ws: list[bytes], lengths: np.ndarray, k: int) -> np.ndarray:
    a = np.frombuffer(b" ".join(ws), np.uint8)
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    return Spans(a).hashes(starts[: len(ws) - k + 1], ends[k - 1:])


def pieces(ws: list[bytes]) -> Iterator[tuple[Spans, np.ndarray, np.ndarray]]:
    """Bounded runs of the words: their bytes' hasher, starts and ends."""
    lengths = np.fromiter(map(len, ws), np.int64, len(ws))
    until, at = np.cumsum(lengths + 1), 0
    while at < len(ws):
        stop = max(at + 1, int(np.searchsorted(until, (until[at - 1] if at else 0) + _PIECE)))
        ends = until[at:stop] - (until[at - 1] if at else 0) - 1
        yield Spans(np.frombuffer(b" ".join(ws[at:stop]), np.uint8)), ends - lengths[at:stop], ends
        at = stop


def word_hashes(ws: list[bytes]) -> np.ndarray:
    return shingle_hashes(ws, 1)


def as_long(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64) if h.dtype == np.uint64 else h


def set_fingerprint(sorted_hashes: np.ndarray) -> int:
    """One signed 64-bit value per set of hashes."""
    if not len(sorted_hashes):
        return 0
    with np.errstate(over="ignore"):
        s = np.add.reduce(mix64(sorted_hashes + np.uint64(_BASE)))
        x = np.bitwise_xor.reduce(mix64(sorted_hashes * np.uint64(3) + np.uint64(1)))
        h = mix64(np.array([s ^ mix64(np.array([x + np.uint64(len(sorted_hashes))]))[0]], np.uint64))
    return int(h.view(np.int64)[0])


def crc_bucket(value: object, mod: int) -> int:
    return binascii.crc32(str(value).encode()) % mod

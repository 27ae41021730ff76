"""Vectorised helpers over the UTF-8 buffers of Arrow text columns.

All functions work on a *packed* batch: one ``uint8`` array with the bytes of
every text back to back, and ``int64`` offsets of length ``n + 1``.  They let
the ``mapInArrow`` stages walk whole texts without making a Python string for
every word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes handled at once inside a task; a longer text is handled alone.
CHUNK_BYTES = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
WORD_BYTE = ~_SPACE

_rng = np.random.default_rng(20240917)
#: A random 64-bit value for every byte, and for every ASCII-folded byte.
BYTE_CODES = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
FOLDED_CODES = BYTE_CODES.copy()
FOLDED_CODES[65:91] = BYTE_CODES[97:123]
_BASE = 0x9E3779B97F4A7C15 | 1
_powers: dict[str, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes so that every output bit depends on every input bit."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 of the hash base modulo 2**64, and of its inverse."""
    if len(_powers.get("up", ())) < n:
        size = max(n, CHUNK_BYTES + 1024)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=np.uint64)
        if size > CHUNK_BYTES + 1024:  # a rare huge text: do not keep its tables
            return _powers.pop("up")[:n], _powers.pop("down")[:n]
    return _powers["up"][:n], _powers["down"][:n]


class Hasher:
    """Hashes any byte spans of ``data`` from one pass of prefix sums."""

    def __init__(self, data: np.ndarray, codes: np.ndarray = BYTE_CODES):
        up, self._down = powers(len(data) + 1)
        self._sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(codes[data] * up[:-1], out=self._sums[1:])

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self._sums[ends] - self._sums[starts]) * self._down[starts] + (ends - starts).astype(np.uint64))


    def grams(self, size: int) -> np.ndarray:
        """Hashes of all spans of ``size`` bytes, one for each start."""
        sums, n = self._sums, len(self._sums) - size
        return mix((sums[size:] - sums[:n]) * self._down[:n] + np.uint64(size))


def packed(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = np.frombuffer(buffers[2], dtype=np.uint8)[offsets[0] : offsets[-1]] if buffers[2] is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def chunks(data: np.ndarray, offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of at most ``limit`` bytes: (first, last + 1, bytes, offsets)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def owner(offsets: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """The text that holds each byte position."""
    return np.searchsorted(offsets, positions, side="right") - 1


def runs(member: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of True bytes that do not cross texts: starts and ends."""
    n = len(member)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.zeros(n + 1, dtype=bool)
    cut[offsets] = True
    edge = np.empty(n + 1, dtype=bool)
    edge[0], edge[n] = member[0], member[n - 1]
    inner = (member[1:] != member[:-1]) | (cut[1:n] & member[1:])
    edge[1:n] = inner
    at = np.flatnonzero(edge)
    opens = np.zeros(len(at), dtype=bool)
    inside = at < n
    opens[inside] = member[at[inside]]
    closes = np.zeros(len(at), dtype=bool)
    closes[at > 0] = member[at[at > 0] - 1]
    return at[opens], at[closes]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+``: starts, ends and owning texts, in order."""
    starts, ends = runs(WORD_BYTE[data], offsets)
    return starts, ends, owner(offsets, starts)


def lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lines split at ``\\n`` (the newline left out): starts, ends, owners, in order."""
    breaks = np.flatnonzero(data == 10)
    starts = np.concatenate([offsets[:-1], breaks + 1])
    ends = np.concatenate([breaks, offsets[1:]])
    docs = np.concatenate([np.arange(len(offsets) - 1), owner(offsets, breaks)])
    docs_end = np.concatenate([owner(offsets, breaks), np.arange(len(offsets) - 1)])
    by_start = np.lexsort((starts, docs))
    by_end = np.lexsort((ends, docs_end))
    return starts[by_start], ends[by_end], docs[by_start]


def per_text(docs: np.ndarray, n: int, weights: np.ndarray | None = None) -> np.ndarray:
    """Count, or sum of weights, for each of ``n`` texts."""
    out = np.bincount(docs, weights=weights, minlength=n)
    return out if weights is not None and weights.dtype.kind == "f" else np.rint(out).astype(np.int64)


def code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points as ``uint32`` and the texts' offsets among them."""
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
    lead = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=lead[1:])
    return points, lead[offsets]

"""Vectorised word splitting over Arrow string batches (shared by the operators).

A batch of texts is split at byte level: every separator of the word classes used here is
one ASCII byte, so UTF-8 texts need no decoding.  Words of all texts are laid out in one
compact buffer (no separators) and dictionary-encoded by Arrow, which gives exact integer
word ids within a shard without a Python loop over words.

Shards bound memory: ``shards`` cuts a batch into runs of texts of at most ``max_bytes``
(a longer text is a shard of its own; nothing is cut off).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SHARD_BYTES = 1 << 20

_BYTES = np.arange(256)
LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
#: ``[^\x20\x09-\x0D]+``
NOT_SPACE = ~((_BYTES == 0x20) | ((_BYTES >= 0x09) & (_BYTES <= 0x0D)))
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``: digits, lower-case ASCII letters, everything non-ASCII
ALNUM_LOWER = ((_BYTES >= 0x30) & (_BYTES <= 0x39)) | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80)


def texts(column: pa.Array) -> pa.Array:
    """The column as a string array with 64-bit offsets, nulls as empty texts."""
    if pa.types.is_null(column.type):
        column = pa.array([""] * len(column), pa.large_string())
    return pc.fill_null(column.cast(pa.large_string()), "")


def shards(column: pa.Array, max_bytes: int = SHARD_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first, end, bytes, offsets)`` of consecutive runs of texts of at most ``max_bytes``."""
    column = texts(column)
    if len(column) == 0:
        return
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        end = int(np.searchsorted(offsets, offsets[first] + max_bytes, side="right")) - 1
        end = min(max(end, first + 1), len(column))
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


@dataclass
class Words:
    """Words of a shard: ``data[off[i]:off[i+1]]`` is word i, texts own ``doc[d]:doc[d+1]``."""

    data: np.ndarray
    off: np.ndarray
    doc: np.ndarray

    @property
    def n(self) -> int:
        return len(self.off) - 1

    def counts(self) -> np.ndarray:
        return np.diff(self.doc)

    def doc_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.doc) - 1), np.diff(self.doc))

    def array(self) -> pa.Array:
        return pa.Array.from_buffers(pa.large_binary(), self.n, [None, pa.py_buffer(self.off), pa.py_buffer(self.data)])

    def encode(self) -> tuple[np.ndarray, pa.Array]:
        """Exact word ids within the shard and the distinct words."""
        if self.n == 0:
            return np.zeros(0, np.int64), pa.array([], pa.large_binary())
        coded = self.array().dictionary_encode()
        return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def split(data: np.ndarray, offsets: np.ndarray, word_bytes: np.ndarray, lower: bool = False) -> Words:
    """Split a shard into words; a word never crosses a text boundary."""
    if lower:
        data = LOWER[data]
    inside = word_bytes[data]
    if len(data) == 0:
        return Words(data, np.zeros(1, np.int64), np.zeros(len(offsets), np.int64))
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    cuts = offsets[:-1][offsets[:-1] < len(data)]
    starts[cuts] = inside[cuts]
    lasts = offsets[1:][offsets[1:] > 0] - 1
    ends[lasts] = inside[lasts]
    first = np.flatnonzero(starts)
    size = np.flatnonzero(ends) - first + 1
    off = np.zeros(len(first) + 1, np.int64)
    np.cumsum(size, out=off[1:])
    return Words(data[inside], off, np.searchsorted(first, offsets).astype(np.int64))


def _byte_table(seed: int) -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95) + np.uint64(2 * seed + 1))


_STEP = 0x9E3779B97F4A7C15 | 1
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    """Powers 0..n of the step and of its inverse modulo 2**64 (grown when needed)."""
    if len(_POWERS[0]) <= n:
        for k, base in enumerate((_STEP, pow(_STEP, -1, 1 << 64))):
            full = np.full(n + 1, base, np.uint64)
            full[0] = 1
            _POWERS[k] = np.cumprod(full, dtype=np.uint64)
    return _POWERS


def token_hashes(split: Words, seed: int = 0, segment: int = 1 << 20) -> np.ndarray:
    """64-bit content hash of every word (polynomial over a random byte table), the same in
    every shard; worked out in byte segments of about ``segment`` cut at word bounds."""
    out = np.zeros(split.n, np.uint64)
    table = _byte_table(seed)
    first = 0
    while first < split.n:
        end = int(np.searchsorted(split.off, split.off[first] + segment, side="right")) - 1
        end = min(max(end, first + 1), split.n)
        off = split.off[first : end + 1] - split.off[first]
        data = split.data[split.off[first] : split.off[end]]
        up, down = _powers(max(len(data), segment))
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(table[data] * up[: len(data)], out=total[1:])
        out[first:end] = (total[off[1:]] - total[off[:-1]]) * down[off[:-1]]
        first = end
    return mix(out + np.diff(split.off).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def multipliers(k: int, seed: int) -> np.ndarray:
    """k odd 64-bit constants of a multilinear hash."""
    return mix(np.arange(1, k + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


def window_hashes(token_hash: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Hash of every run of k consecutive tokens (text boundaries are the caller's care)."""
    n = len(token_hash) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j, m in enumerate(multipliers(k, seed)):
        out += token_hash[j : j + n] * m
    return mix(out)


def window_starts(doc: np.ndarray, k: int) -> np.ndarray:
    """Mask over window starts 0..n-k: does the window stay inside its text?"""
    n = int(doc[-1]) - k + 1
    if n <= 0:
        return np.zeros(0, bool)
    inside = np.ones(n, bool)
    for last in range(1, k):  # the last k-1 starts of each text cross its end
        cut = doc[1:] - last
        cut = cut[(cut >= doc[:-1]) & (cut < n)]
        inside[cut] = False
    return inside


def per_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``values`` over consecutive ranges ``bounds[d]:bounds[d+1]``."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def covered(n: int, starts: np.ndarray, length: int | np.ndarray) -> np.ndarray:
    """Mask of the n positions inside any range ``start : start + length``."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.subtract.at(edge, np.minimum(starts + length, n), 1)
    return np.cumsum(edge[:-1]) > 0


def runs(mask: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True, cut at text bounds."""
    if len(mask) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts, ends = mask.copy(), mask.copy()
    starts[1:] &= ~mask[:-1]
    ends[:-1] &= ~mask[1:]
    cuts = bounds[:-1][bounds[:-1] < len(mask)]
    starts[cuts] = mask[cuts]
    lasts = bounds[1:][bounds[1:] > 0] - 1
    ends[lasts] = mask[lasts]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def int_lists(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    """List array: list d holds ``values[bounds[d]:bounds[d+1]]``."""
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, kind))

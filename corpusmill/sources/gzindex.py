"""Seek points inside gzip files, so that ranges of one file can be read by many tasks.

A gzip member is one deflate stream: its blocks start at any bit and refer to the 32 KB of
output before them.  ``seek_points`` reads a file once and notes points at which reading can
begin: the starts of members and, within a long member, starts of dynamic blocks together with
that window.  zlib tells no block starts, so they are found: every bit offset of a stretch is
tested for a block header (type, counts, a complete code of code lengths) with arrays, and a
hit counts only if inflating from there, after the window, gives the output that the file's
own stream gives.  A reader shifts the bytes by the point's bit offset and inflates on.

Lines are cut here too: each point knows how many bytes to skip to its first line, how many
bytes its lines hold and how many lines come before it in the file.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np

WINDOW = 1 << 15
SEARCH = 1 << 18  # bytes in which a block start is looked for
PROOF = 1 << 14  # output bytes that have to agree
CHUNK = 1 << 18
MAGIC = b"\x1f\x8b\x08"


class Point(NamedTuple):
    """Reading from ``bit`` on: ``window`` is null at a member's start.  ``skip`` bytes of the
    output belong to the range before, ``take`` bytes are whole lines; ``lines`` counts the
    non-blank lines before it; ``error`` is what ends the file after these lines."""

    bit: int
    window: bytes | None
    skip: int
    take: int
    lines: int
    error: str | None


def block_starts(data: bytes) -> np.ndarray:
    """Bit offsets in ``data`` that look like the header of a dynamic block (not the last)."""
    bits = np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little").astype(np.int16)
    room = 17 + 19 * 3
    n = len(bits) - room
    if n <= 0:
        return np.zeros(0, np.int64)
    at = np.flatnonzero((bits[:n] == 0) & (bits[1 : n + 1] == 0) & (bits[2 : n + 2] == 1))
    number = lambda first, width: sum(bits[at + first + k] << k for k in range(width))
    at = at[(number(3, 5) <= 29)]
    at = at[(number(8, 5) <= 29)]
    count = number(13, 4) + 4
    kraft = np.zeros(len(at), np.int64)  # a complete code of code lengths sums up to one
    for k in range(19):
        length = number(17 + 3 * k, 3)
        kraft += np.where((k < count) & (length > 0), 128 >> length, 0)
    return at[kraft == 128]


def shifted(data: bytes, bit: int) -> bytes:
    """``data`` from bit offset ``bit`` (0 to 7) on."""
    if not bit:
        return data
    a = np.frombuffer(data, np.uint8).astype(np.uint16)
    out = a >> bit
    out[:-1] |= a[1:] << (8 - bit)
    return out.astype(np.uint8).tobytes()


class _Lines:
    """Counts the non-blank lines of a stream of bytes."""

    def __init__(self):
        self.lines, self.rest = 0, []

    def feed(self, data: bytes) -> None:
        whole, cut, rest = data.rpartition(b"\n")
        if cut:
            self.lines += count_lines(b"".join([*self.rest, whole]))
            self.rest = []
        self.rest.append(rest)

    def end(self) -> None:
        self.lines += count_lines(b"".join(self.rest))


def count_lines(data: bytes) -> int:
    return sum(1 for x in data.splitlines() if x.strip(b" "))


def seek_points(read: Callable[[int, int], bytes], size: int, every: int) -> list[Point]:
    """Points of a gzip file about ``every`` compressed bytes apart; ``read(start, length)``
    gives its bytes."""
    found: list[list] = []  # bit, window, output offset, lines before the first line after it
    total, lines, history = 0, _Lines(), b""
    starts_at: list[int] = []  # output offset of the first line after each point
    waiting = 0  # points whose first line has not begun yet
    error, at, last = None, 0, -1

    def emit(data: bytes) -> None:
        nonlocal total, history, waiting
        while waiting and data:
            cut = data.find(b"\n")
            if cut < 0:
                break
            lines.feed(data[: cut + 1])
            total += cut + 1
            history = (history + data[: cut + 1])[-WINDOW:]
            data = data[cut + 1 :]
            for k in range(len(found) - waiting, len(found)):
                found[k][3] = lines.lines
                starts_at.append(total)
            waiting = 0
        lines.feed(data)
        total += len(data)
        history = (history + data)[-WINDOW:]

    def add(bit: int, window: bytes | None) -> None:
        nonlocal waiting, last
        last = bit // 8
        found.append([bit, window, total, 0])
        if total == 0:
            starts_at.append(0)
        else:
            waiting += 1

    member, inflate = 0, None
    while at < size and error is None:
        if inflate is None:  # a member begins, or padding
            head = read(at, 3)
            if found and head[:1] == b"\0":
                at += 1
                continue
            if not MAGIC.startswith(head):
                error = "BadGzipFile"
                break
            if last < 0 or at - last >= every:
                add(at * 8, None)
            member, inflate = at, zlib.decompressobj(31)
        chunk = read(at, CHUNK)
        if not chunk:
            break
        if at - max(last, 0) >= every and at > member:
            point = _block_point(chunk + read(at + len(chunk), SEARCH), inflate, history)
            if point is not None:
                bit, before = point
                emit(before)
                add(at * 8 + bit, history)
                found[-1][2] = total
                # go on from the byte that the point lies in; its output has been told
                fed = -(-bit // 8)
                inflate.decompress(chunk[:fed])
                at += fed
                continue
        try:
            emit(inflate.decompress(chunk))
        except zlib.error:
            error = "error"
            break
        at += len(chunk)
        if inflate.eof:
            at -= len(inflate.unused_data)
            inflate = None
    if inflate is not None and error is None:
        error = "EOFError"
    for k in range(len(found) - waiting, len(found)):
        found[k][3] = lines.lines
        starts_at.append(total)
    lines.end()
    ends = [*starts_at[1:], total]
    return [
        Point(bit, window, first - offset, end - first, before, error if k == len(found) - 1 else None)
        for k, ((bit, window, offset, before), first, end) in enumerate(zip(found, starts_at, ends))
    ] or [Point(0, None, 0, 0, 0, error)]


def _block_point(data: bytes, state, history: bytes) -> tuple[int, bytes] | None:
    """The first block start in ``data`` (bit offset) and the output before it, proved against
    the running stream ``state``, which is not moved."""
    for bit in block_starts(data[:SEARCH]).tolist():
        byte = -(-bit // 8)
        if byte > min(CHUNK, len(data)):
            return None
        probe = state.copy()
        try:
            before = probe.decompress(data[:byte])
            if probe.eof:
                return None
            true = probe.decompress(data[byte : byte + SEARCH // 2], PROOF)
        except zlib.error:
            return None
        window = (history + before)[-WINDOW:]
        trial = zlib.decompressobj(-15, zdict=window)
        try:
            got = trial.decompress(shifted(data[bit // 8 : bit // 8 + SEARCH // 2], bit % 8), PROOF)
        except zlib.error:
            continue
        if len(true) >= PROOF and got[: len(true)] == true:
            return bit, before
    return None


def read_point(read: Callable[[int, int], bytes], size: int, point: Point) -> Iterator[bytes]:
    """The bytes of the point's lines, piece by piece."""
    skip, take = point.skip, point.take
    at, bit = point.bit // 8, point.bit % 8
    inflate = zlib.decompressobj(31) if point.window is None else zlib.decompressobj(-15, zdict=point.window)
    raw = point.window is not None
    while take > 0 and at < size:
        chunk = read(at, CHUNK + 1 if raw and bit else CHUNK)
        if not chunk:
            return
        if raw and bit:
            data = shifted(chunk, bit)
            data = data if at + len(chunk) >= size else data[:-1]
        else:
            data = chunk
        out = inflate.decompress(data, skip + take)  # no further: the rest may be broken
        cut = min(skip, len(out))
        skip, take = skip - cut, take - (len(out) - cut)
        yield out[cut:]
        at += len(data)
        if inflate.eof and take > 0:
            at -= len(inflate.unused_data)
            if raw:  # the trailer's eight bytes begin at the next byte of the file
                at = next((p + 8 for p in (at, at + 1) if read(p + 8, 3) == MAGIC), size)
            else:
                while at < size and not read(at, 1).strip(b"\0"):
                    at += 1
            raw, bit, inflate = False, 0, zlib.decompressobj(31)

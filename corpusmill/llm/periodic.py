"""Periodic runs of words: every maximal stretch of a text that repeats a block of its own.

A run is a stretch of consecutive words with smallest period q (words q apart are equal), at
least ``max(min_words, copies * q)`` long, that no neighbouring word extends.

*Harmonic grid.*  A run of period q holds a stretch of ``max(min_words - q, (copies - 1) * q)``
places whose word equals the one q further on, so it holds a multiple of that step.  Only grid
places with equal words are followed, n log n of them at most; how far the match goes on to
both sides are two longest common extensions.

*Extensions by a difference cover.*  Of every 21 positions five are samples, such that any two
positions have a common distance below 21 at which both are samples.  Only the suffixes at
samples are sorted (blocks of 21 words named, then prefix doubling over the names).  An
extension compares words until that distance; where all were equal, the rest is the least
longest-common-prefix between the two ranks, from a sparse table.  Backward extensions use the
same structure of the reversed words.  Extensions that end within 21 words on both sides are
settled by comparing, so texts with none beyond that are never sorted.

Texts are worked on in shards of bounded bytes (a longer text is a shard of its own, in space
n log n of its words); no text meets another and nothing is shuffled.  Defined results: a null
text is empty; a text of fewer than ``min_words`` words has no run; repeated rows are rows of
their own; columns of the input stay, but for one named like ``out``.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm import words as W
from corpusmill.llm.repeats import kept_text

MIN_WORDS, COPIES = 24, 3
#: A perfect difference set modulo 21: every non-zero residue is one difference of it.
CYCLE, COVER = 21, (0, 1, 4, 14, 16)
PAIRS = 1 << 21  # grid places looked at in one go

RESULT_TYPE = (
    "struct<n_words: bigint, runs: array<struct<start: bigint, length: bigint, period: bigint>>, strongest: int, collapsed: string>"
)
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_RESULT = pa.struct(
    [("n_words", pa.int64()), ("runs", pa.list_(_RUN)), ("strongest", pa.int32()), ("collapsed", pa.string())]
)


def _sync_table() -> np.ndarray:
    """By residues of two positions: the least distance at which both are samples."""
    member = np.zeros(CYCLE, bool)
    member[list(COVER)] = True
    out = np.zeros((CYCLE, CYCLE), np.int64)
    for a in range(CYCLE):
        for b in range(CYCLE):
            out[a, b] = next(h for h in range(CYCLE) if member[(a + h) % CYCLE] and member[(b + h) % CYCLE])
    return out


_SYNC = _sync_table()


def _ranks(values: np.ndarray) -> np.ndarray:
    return np.unique(values, return_inverse=True)[1].astype(np.int64)


class Extensions:
    """Longest common extensions to the right over ``ids`` (non-negative integers; the last
    one must occur nowhere else, so that an extension ends inside)."""

    def __init__(self, ids: np.ndarray):
        n = len(ids)
        room = 2 * CYCLE + (-n) % CYCLE  # padding: values that occur once
        top = int(ids.max(initial=0)) + 1
        self.ids = np.concatenate([ids, np.arange(top, top + room)])
        chains = [np.arange(c, len(self.ids) - CYCLE + 1, CYCLE) for c in COVER]
        self.at = np.concatenate(chains)
        self.base = np.full(CYCLE, -1, np.int64)
        self.base[list(COVER)] = np.cumsum([0] + [len(c) for c in chains[:-1]])
        self._sort()

    def _sort(self) -> None:
        # names of the blocks of CYCLE words in their order: neighbouring columns are paired
        ids = _ranks(self.ids)
        columns = [ids[self.at + k] for k in range(CYCLE)]
        while len(columns) > 1:
            paired = [
                _ranks(a * (int(b.max(initial=0)) + 1) + b) for a, b in zip(columns[0::2], columns[1::2])
            ]
            columns = paired + columns[2 * len(paired) :]
        levels = [columns[0]]
        m, size = len(self.at), 1
        while m and int(levels[-1].max()) + 1 < m:  # prefix doubling until all suffixes differ
            ahead = np.zeros(m, np.int64)
            ahead[: max(m - size, 0)] = levels[-1][size:] + 1
            levels.append(_ranks(levels[-1] * (m + 1) + ahead))
            size *= 2
        self.rank = levels[-1]
        order = np.empty(m, np.int64)
        order[self.rank] = np.arange(m)
        self.table = [self._neighbours(order, levels)]
        width = 1
        while 2 * width < m:  # sparse table of minima
            low = self.table[-1]
            self.table.append(np.minimum(low[:-width], low[width:]))
            width *= 2

    def _neighbours(self, order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
        """Common prefix, in words, of every sampled suffix and the next one in order."""
        a, b = order[:-1], order[1:]
        blocks = np.zeros(len(a), np.int64)
        m = len(self.at)
        for k in range(len(levels) - 1, -1, -1):
            x, y = a + blocks, b + blocks
            inside = (x < m) & (y < m)
            same = np.zeros(len(a), bool)
            same[inside] = levels[k][x[inside]] == levels[k][y[inside]]
            blocks[same] += 1 << k
        x, y = self.at[a] + blocks * CYCLE, self.at[b] + blocks * CYCLE
        return (blocks * CYCLE + _compare(self.ids, x, y, CYCLE)).astype(np.int64)

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Number of equal words from positions ``i`` and ``j`` (different ones) on."""
        sync = _SYNC[i % CYCLE, j % CYCLE]
        out = _compare(self.ids, i, j, CYCLE - 1, sync)
        far = np.flatnonzero(out == sync)
        if len(far):
            ends = []
            for p in (i[far] + sync[far], j[far] + sync[far]):
                ends.append(self.rank[self.base[p % CYCLE] + p // CYCLE])
            lo, hi = np.minimum(*ends), np.maximum(*ends)
            level = np.frexp((hi - lo).astype(np.float64))[1] - 1
            for k in np.unique(level):
                at = np.flatnonzero(level == k)
                row = self.table[k]
                out[far[at]] += np.minimum(row[lo[at]], row[hi[at] - (1 << int(k))])
        return out


def _compare(ids: np.ndarray, i: np.ndarray, j: np.ndarray, most: int, limit: np.ndarray | None = None) -> np.ndarray:
    """Equal words from i and j on, up to ``limit`` (``most`` at most); positions past the end
    end a match."""
    out = np.zeros(len(i), np.int64)
    live = np.arange(len(i)) if limit is None else np.flatnonzero(limit > 0)
    for step in range(most):
        if not len(live):
            break
        x, y = i[live] + step, j[live] + step
        inside = (x < len(ids)) & (y < len(ids)) & (x >= 0) & (y >= 0)
        same = np.zeros(len(live), bool)
        same[inside] = ids[x[inside]] == ids[y[inside]]
        live = live[same]
        out[live] += 1
        if limit is not None:
            live = live[limit[live] > step + 1]
    return out


def _grid(first: np.ndarray, size: np.ndarray, min_words: int, copies: int) -> Iterator[tuple[np.ndarray, ...]]:
    """``(text, place, period)`` of all grid places of texts at ``first`` of ``size`` words, in
    pieces of about PAIRS."""
    periods = np.where(size >= min_words, size // copies, 0)
    doc = np.repeat(np.arange(len(size)), periods)
    period = np.arange(len(doc)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    step = _least_match(period, min_words, copies)
    places = (size[doc] - period - 1) // step + 1
    upto = np.concatenate([[0], np.cumsum(places)])
    lo = 0
    while lo < len(doc):
        hi = max(int(np.searchsorted(upto, upto[lo] + PAIRS, side="right")) - 1, lo + 1)
        n = places[lo:hi]
        k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        text = np.repeat(doc[lo:hi], n)
        yield text, first[text] + k * np.repeat(step[lo:hi], n), np.repeat(period[lo:hi], n)
        lo = hi


def _least_match(period: np.ndarray, min_words: int, copies: int) -> np.ndarray:
    """Places of a run of that period whose word is equal to the one a period on, at least."""
    return np.maximum(min_words - period, (copies - 1) * period)


def _distinct(start: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of equal stretches the one of the smallest period, by start and end."""
    o = np.lexsort((period, end, start))
    start, end, period = start[o], end[o], period[o]
    new = np.ones(len(o), bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    return start[new], end[new], period[new]


def find_runs(
    ids: np.ndarray, bounds: np.ndarray, min_words: int = MIN_WORDS, copies: int = COPIES
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends (positions in ``ids``) and smallest periods of all runs of the texts
    ``ids[bounds[d]:bounds[d+1]]``, by start, then period."""
    if copies < 2 or min_words < 2:
        raise ValueError("a run has at least two copies and two words")
    # a separator that occurs once before and after every text
    docs = len(bounds) - 1
    size = np.diff(bounds)
    line = np.full(len(ids) + docs + 1, -1, np.int64)
    place = np.arange(len(ids)) + np.repeat(np.arange(docs), size) + 1
    line[place] = ids
    line[line < 0] = int(ids.max(initial=0)) + 1 + np.arange(docs + 1)
    first = bounds[:-1] + np.arange(docs) + 1
    found = [(np.zeros(0, np.int64),) * 3]

    def keep(i: np.ndarray, q: np.ndarray, ahead: np.ndarray, behind: np.ndarray) -> None:
        enough = ahead + behind >= _least_match(q, min_words, copies)
        i, q, ahead, behind = i[enough], q[enough], ahead[enough], behind[enough]
        found.append(_distinct(i - behind, i + ahead + q, q))

    deep = np.zeros(docs, bool)  # texts with a match of a cycle or more to one side
    for text, i, q in _grid(first, size, min_words, copies):
        same = np.flatnonzero(line[i] == line[i + q])
        text, i, q = text[same], i[same], q[same]
        ahead = _compare(line, i, i + q, CYCLE)
        behind = _compare(line[::-1], len(line) - i, len(line) - i - q, CYCLE)
        short = (ahead < CYCLE) & (behind < CYCLE)
        deep[text[~short]] = True
        keep(i[short], q[short], ahead[short], behind[short])
    if deep.any():
        # these texts alone, with the separators around them
        wanted = np.zeros(len(line), bool)
        wanted[place[np.repeat(deep, size)]] = True
        wanted[first[deep] - 1] = wanted[first[deep] + size[deep]] = True
        old = np.flatnonzero(wanted)
        ids = _ranks(line[old])
        right, left = Extensions(ids), Extensions(ids[::-1].copy())
        for _, i, q in _grid(np.searchsorted(old, first[deep]), size[deep], min_words, copies):
            same = np.flatnonzero(ids[i] == ids[i + q])
            i, q = i[same], q[same]
            ahead, behind = right.common(i, i + q), left.common(len(ids) - i, len(ids) - i - q)
            keep(old[i], q, ahead, behind)
    start, end, period = _distinct(*(np.concatenate([f[k] for f in found]) for k in range(3)))
    o = np.lexsort((period, start))
    start, length, period = np.searchsorted(place, start[o]), (end - start)[o], period[o]
    return start, start + length, period


def _shard(data: np.ndarray, offsets: np.ndarray, min_words: int, copies: int) -> pa.StructArray:
    split = W.split(data, offsets, W.NOT_SPACE)
    ids, _ = split.encode()
    start, end, period = find_runs(ids, split.doc, min_words, copies)
    doc = np.searchsorted(split.doc, start, side="right") - 1
    gone = W.covered(split.n, start + period, end - start - period) if len(start) else np.zeros(split.n, bool)
    bounds = np.searchsorted(doc, np.arange(len(split.doc)))
    local = start - split.doc[doc]
    strongest: list[int | None] = [None] * (len(split.doc) - 1)
    for d in np.unique(doc):
        mine = range(int(bounds[d]), int(bounds[d + 1]))
        best = max(mine, key=lambda k: (Fraction(int(end[k] - start[k]), int(period[k])), -int(local[k]), -int(period[k])))
        strongest[d] = best - int(bounds[d])
    runs = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (local, end - start, period)], fields=list(_RUN))
    return pa.StructArray.from_arrays(
        [
            pa.array(split.counts(), pa.int64()),
            pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), runs),
            pa.array(strongest, pa.int32()),
            kept_text(split, gone),
        ],
        fields=list(_RESULT),
    )


def periodic_runs(
    docs: DataFrame, text: str = "text", out: str = "periodic", min_words: int = MIN_WORDS, copies: int = COPIES
) -> DataFrame:
    """``docs`` plus the struct column ``out``: n_words; runs (start, length, period in words,
    by start, then period); strongest (index of the run with the greatest length / period,
    the first and then shortest among equals; null without runs); collapsed (the words left
    when every run keeps its first period only, joined by one space)."""

    @F.arrow_udf(RESULT_TYPE)
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            parts = [_shard(data, offsets, min_words, copies) for _, _, data, offsets in W.shards(column)]
            yield pa.concat_arrays(parts) if parts else pa.array([], _RESULT)

    return docs.withColumn(out, find(F.col(text).cast("string")))


def collapse_runs(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` with the collapsed texts in place of the texts (a null text stays null)."""
    out = "__cm_periodic"
    found = periodic_runs(docs, text, out=out, **options)
    return found.withColumn(text, F.when(F.col(text).isNotNull(), F.col(f"{out}.collapsed"))).drop(out)

"""Repeated word spans across a corpus, from seeds to spans (shared by the two operators).

Every window of ``length`` words selects one seed: the leftmost smallest hash among the
``k``-word runs in it, so equal windows select equal seeds at equal places, and seeds are
sparse.  Round 1 asks which seeds occur more than once in the corpus; round 2 extends the
occurrences of those seeds left and right to the windows around them and asks which
extended spans occur more than once (128-bit keys, merged per block before they are sent).
The union of a text's repeated windows is its maximal repeated spans."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from corpusmill.llm import exchange as X
from corpusmill.llm import words as W
from corpusmill.llm.tables import written

UNIQUE, FIRST, LATER = 0, 1, 2
_REQUEST = "part int, block bigint, c0 binary, c1 binary"
_SPAN_REQUEST = "part int, block bigint, c0 binary, c1 binary, c2 binary, c3 binary"


def leftmost_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the leftmost smallest value in every run of ``width`` values."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    low, at, span = values, np.arange(len(values)), 1
    while span * 2 <= width:
        right = low[span:] < low[: len(low) - span]
        at = np.where(right, at[span:], at[: len(at) - span])
        low = np.where(right, low[span:], low[: len(low) - span])
        span *= 2
    rest = width - span
    if rest:
        right = low[rest:] < low[: len(low) - rest]
        at = np.where(right, at[rest:], at[: len(at) - rest])
    return at[:n]


def order_numbers(keys: pa.Array) -> np.ndarray:
    """An integer order of document keys: themselves if integers (null first), else a hash."""
    if pa.types.is_integer(keys.type):
        return keys.cast(pa.int64()).fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)
    if pa.types.is_null(keys.type):
        return np.full(len(keys), np.iinfo(np.int64).min)
    return np.array([xxhash.xxh64_intdigest(repr(x)) >> 1 for x in keys.to_pylist()], np.int64)


class Spans:
    """The windows of a block's texts, their seeds and keys."""

    def __init__(self, block: dict, length: int, k: int, parts: int):
        self.block, self.length, self.parts = block, length, parts
        self.split = W.split(block["data"], block["offsets"], W.NOT_SPACE)
        self.one = W.token_hashes(self.split, 1)
        inside = W.window_starts(self.split.doc, length)
        self.start = np.flatnonzero(inside)
        grams = W.window_hashes(self.one, k, 5)
        self.seed_at = leftmost_minima(grams, length - k + 1)[self.start]
        place = np.unique(self.seed_at)
        key = grams[place]
        self.seeds, which, times = np.unique(key, return_inverse=True, return_counts=True)
        self.seed_of = np.zeros(len(grams), np.int64)
        self.seed_of[place] = which
        self.seed_times = times
        self.seed_order = np.argsort((self.seeds >> np.uint64(32)) % np.uint64(parts), kind="stable")

    def seed_request(self) -> Iterator[pa.RecordBatch]:
        o = self.seed_order
        part = ((self.seeds[o] >> np.uint64(32)) % np.uint64(self.parts)).astype(np.int32)
        yield from X.requests(part, [self.seeds[o], (self.seed_times[o] > 1).astype(np.uint8)], self.block["block"])

    def extend(self, answer: np.ndarray) -> None:
        """Windows around repeated seeds: distinct spans, in request order."""
        repeated = np.zeros(len(self.seeds), bool)
        repeated[self.seed_order] = answer > 0 if len(self.seeds) else False
        live = self.start[repeated[self.seed_of[self.seed_at]]] if len(self.start) else self.start
        two = W.token_hashes(self.split, 2)
        h1 = W.window_hashes(self.one, self.length, 8)[live]
        h2 = W.window_hashes(two, self.length, 9)[live]
        order = order_numbers(self.block["keys"])[self.split.doc_of()[live]]
        part = ((h1 >> np.uint64(32)) % np.uint64(self.parts)).astype(np.int32)
        o = np.lexsort((live, order, h2, h1, part))
        self.live, self.order = live[o], order[o]
        self.h1, self.h2, self.part = h1[o], h2[o], part[o]
        new = np.ones(len(o), bool)
        new[1:] = (self.h1[1:] != self.h1[:-1]) | (self.h2[1:] != self.h2[:-1])
        self.new, self.span_of = new, np.cumsum(new) - 1

    def span_request(self) -> Iterator[pa.RecordBatch]:
        at = np.flatnonzero(self.new)
        times = np.diff(np.append(at, len(self.new)))
        columns = [self.h1[at], self.h2[at], (times > 1).astype(np.uint8), self.order[at]]
        yield from X.requests(self.part[at], columns, self.block["block"])

    def covered(self, answer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Masks over the words: in any repeated window, in a later copy of one."""
        n = self.split.n
        code = answer[self.span_of] if len(self.live) else np.zeros(0, np.uint8)
        later = (code == LATER) | ((code == FIRST) & ~self.new)  # the block's first is kept
        return W.covered(n, self.live[code > 0], self.length), W.covered(n, self.live[later], self.length)


def judge_spans(h1: np.ndarray, h2: np.ndarray, multi: np.ndarray, order: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Sort the spans of all blocks and compare neighbours: unique, the corpus' first
    occurrence, or a later one."""
    o = np.lexsort((row, order, h2, h1))
    new = np.ones(len(o), bool)
    new[1:] = (h1[o][1:] != h1[o][:-1]) | (h2[o][1:] != h2[o][:-1])
    group = np.cumsum(new) - 1
    total = np.bincount(group, 1 + multi[o].astype(np.int64))
    out = np.zeros(len(o), np.uint8)
    out[o] = np.where(total[group] < 2, UNIQUE, np.where(new, FIRST, LATER))
    return out


def repeated_words(
    docs: DataFrame,
    key: str,
    text: str,
    length: int,
    k: int,
    judge_seeds: Callable[..., np.ndarray],
    finish: Callable[[Spans, np.ndarray, np.ndarray], Iterator[pa.RecordBatch]],
    schema: str,
    name: str,
) -> DataFrame:
    """Rows that ``finish(spans, repeated mask, later mask)`` makes of every block."""
    blocks = X.text_blocks(docs, key, text, f"{name}-blocks")
    parts = X.part_count(blocks)
    spans = partial(Spans, length=length, k=k, parts=parts)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in X.each_block(batches):
            yield from spans(block).seed_request()

    seeds = X.answered(blocks.mapInArrow(ask, _REQUEST), ["<u8", "u1"], judge_seeds, 1)
    seeds = written(seeds, f"{name}-seeds")

    def extend(block: dict, answers: dict) -> Iterator[pa.RecordBatch]:
        own = spans(block)
        own.extend(answers.get(1, np.zeros(0, np.uint8)))
        yield from own.span_request()

    asked = X.with_answers(blocks, seeds, extend, _SPAN_REQUEST)
    found = written(X.answered(asked, ["<u8", "<u8", "u1", "<i8"], judge_spans, 2), f"{name}-spans")

    def decide(block: dict, answers: dict) -> Iterator[pa.RecordBatch]:
        own = spans(block)
        own.extend(answers.get(1, np.zeros(0, np.uint8)))
        yield from finish(own, *own.covered(answers.get(2, np.zeros(0, np.uint8))))

    return X.with_answers(blocks, seeds.unionByName(found), decide, schema)


def span_lists(mask: np.ndarray, doc: np.ndarray, removed: np.ndarray | None = None) -> pa.Array:
    """Per text the maximal runs of the mask as (start, length), in words, and how many of
    their words are removed if that mask is given."""
    start, end = W.runs(mask, doc)
    owner = np.searchsorted(doc, start, side="right") - 1
    bounds = np.searchsorted(owner, np.arange(len(doc)))
    columns = {"start": start - doc[owner], "length": end - start}
    if removed is not None:
        upto = np.concatenate([[0], np.cumsum(removed)])
        columns["removed"] = upto[end] - upto[start]
    found = pa.StructArray.from_arrays([pa.array(x, pa.int32()) for x in columns.values()], names=list(columns))
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), found)


def kept_text(split: W.Words, removed: np.ndarray) -> pa.Array:
    """Per text the words that are not removed, joined by one space."""
    keep = ~removed
    size = np.diff(split.off)
    owner = split.doc_of()
    last = np.zeros(split.n, bool)  # the last kept word of a text has no space after it
    kept_at = np.flatnonzero(keep)
    if len(kept_at):
        ends = np.append(owner[kept_at][1:] != owner[kept_at][:-1], True)
        last[kept_at[ends]] = True
    room = np.where(keep, size + 1 - last, 0)
    bytes_kept = split.data[np.repeat(keep, size)]
    total = int(room.sum())
    out = np.full(total, 32, np.uint8)
    begin = np.cumsum(room) - room
    kept_size = size[kept_at]
    at = np.repeat(begin[kept_at] - (np.cumsum(kept_size) - kept_size), kept_size) + np.arange(len(bytes_kept))
    out[at] = bytes_kept
    bounds = np.zeros(len(split.doc), np.int64)
    bounds[1:] = np.cumsum(W.per_text(room, split.doc))
    return pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds), pa.py_buffer(out)).cast(pa.string())

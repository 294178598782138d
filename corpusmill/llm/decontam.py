"""Benchmark decontamination with suffix arrays over the training texts.

The documents are the training side.  Every shard of texts (a bounded run of a task's
rows) gets a word-level suffix array; all suffixes of the benchmark are binary-searched in
it, giving for each the interval of training suffixes that share its first ``window``
words, i.e. all locations.  Adjacent hits on one diagonal are joined into the longest
verbatim matches ``(item, item_start, start, length)``.

Suffixes that cannot reach a match are left out of the array without loss: a training
suffix needs at least as many consecutive words of the benchmark's vocabulary as the
shortest window has.  One pass over the documents, no shuffle; the benchmark is broadcast
in blocks of at most ``block_bytes`` of text (a longer single item is a block of its own), at
most ``PASS_BLOCKS`` of them at a time.  A larger benchmark takes several passes over the
documents; a pass writes the matches of the texts that have some, by the texts' SHA-256, and
these few rows are merged and joined back.

Defined cases: null or word-free texts have no words and no matches; a benchmark without
words matches nothing; an item shorter than the window (but not empty) is one window;
rows with a null item id use the empty string as id; several benchmark rows with one id
count as one item; repeated document rows are judged alike; empty tables give empty
results; all input columns are kept and an input column named like the result column is
replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm import words as W
from corpusmill.llm.tables import written

BLOCK_BYTES = 8 << 20
PASS_BLOCKS = 8  # blocks that are broadcast at the same time
WINDOW = 13

_MATCH = pa.struct([("item", pa.string()), ("item_start", pa.int32()), ("start", pa.int32()), ("length", pa.int32())])
_RESULT = pa.struct(
    [("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())), ("matches", pa.list_(_MATCH))]
)
RESULT_TYPE = (
    "n_words bigint, n_hit bigint, items array<string>, "
    "matches array<struct<item:string,item_start:int,start:int,length:int>>"
)


class TestSuffixes:
    """All windows (truncated suffixes) of a block of benchmark items, sorted and distinct."""

    __test__ = False

    def __init__(self, ids: list[str], item_texts: list[str | None], window: int):
        data = pa.array(item_texts, pa.large_string())
        parts = [W.split(d, o, W.ALNUM_LOWER, lower=True) for _, _, d, o in W.shards(data, 1 << 62)]
        split = parts[0] if parts else W.Words(np.zeros(0, np.uint8), np.zeros(1, np.int64), np.zeros(1, np.int64))
        tokens, self.vocabulary = split.encode()
        size = split.counts()
        self.ids = np.array(ids, dtype=object)
        self.window = window
        item = split.doc_of()
        place = np.arange(split.n) - split.doc[:-1][item] if split.n else np.zeros(0, np.int64)
        left = size[item] - place if split.n else np.zeros(0, np.int64)
        start = (left >= window) | ((place == 0) & (left > 0))  # short items: their whole sequence
        at = np.flatnonzero(start)
        self.length = np.minimum(left[at], window)
        self.item, self.item_start = item[at], place[at]
        padded = np.concatenate([tokens, np.full(window, -1, np.int64)])
        matrix = padded[at[:, None] + np.arange(window)[None, :]].astype(np.int32)
        matrix[np.arange(window)[None, :] >= self.length[:, None]] = -1
        # classes of equal windows: a class is searched once
        self.windows, self.kind = (
            np.unique(matrix, axis=0, return_inverse=True) if len(at) else (matrix, np.zeros(0, np.int64))
        )
        self.kind = self.kind.reshape(-1)
        self.kind_length = (self.windows >= 0).sum(axis=1)
        self.members = np.argsort(self.kind, kind="stable")
        self.first = np.searchsorted(self.kind[self.members], np.arange(len(self.windows) + 1))
        self.shortest = int(self.kind_length.min()) if len(self.windows) else 0

    def search(self, tokens: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions and window classes of all occurrences in a shard's token sequence."""
        none = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not len(self.windows) or not len(tokens):
            return none
        # words left before an unknown word or the end of the text
        n = len(tokens)
        stop = np.full(n + 1, False)
        stop[:-1] = tokens < 0
        run_end = np.where(stop, np.arange(n + 1), n)
        run_end = np.minimum.accumulate(run_end[::-1])[::-1][:-1]
        text_end = np.repeat(doc[1:], np.diff(doc))
        left = np.minimum(run_end, text_end) - np.arange(n)
        at = np.flatnonzero(left >= self.shortest)
        if not len(at):
            return none
        depth = self.window
        padded = np.concatenate([tokens, np.full(depth, -1, tokens.dtype)])
        columns = [np.where(left[at] > d, padded[at + d], -1).astype(np.int32) for d in range(depth)]
        order = np.lexsort(columns[::-1])  # the shard's suffix array, to the search depth
        # binary search, one more word at a time, for all test suffixes at once
        low, high = np.zeros(len(self.windows), np.int64), np.full(len(self.windows), len(at), np.int64)
        for d in range(depth):
            live = np.flatnonzero((high > low) & (self.kind_length > d))
            if not len(live):
                break
            column = columns[d][order]
            wanted = self.windows[live, d]
            lo, hi = low[live], high[live]
            low[live] = _bound(column, wanted, lo, hi, np.less)
            high[live] = _bound(column, wanted, lo, hi, np.less_equal)
        count = np.maximum(high - low, 0)
        kind = np.repeat(np.arange(len(self.windows)), count)
        inner = np.arange(len(kind)) - np.repeat(np.cumsum(count) - count, count)
        return at[order[low[kind] + inner]], kind

    def matches(self, place: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, ...]:
        """Longest verbatim matches: (item, item_start, start, length), by start."""
        times = (self.first[1:] - self.first[:-1])[kind]
        which = np.repeat(np.arange(len(kind)), times)
        inner = np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times)
        member = self.members[self.first[kind[which]] + inner]
        start, item, item_start = place[which], self.item[member], self.item_start[member]
        order = np.lexsort([start, start - item_start, item])
        start, item, item_start, size = start[order], item[order], item_start[order], self.length[member][order]
        if not len(start):
            return item, item_start, start, size
        new = np.ones(len(start), bool)
        new[1:] = (item[1:] != item[:-1]) | (start[1:] != start[:-1] + 1) | (item_start[1:] != item_start[:-1] + 1)
        head = np.flatnonzero(new)
        tail = np.append(head[1:], len(start)) - 1
        out = item[head], item_start[head], start[head], start[tail] + size[tail] - start[head]
        by_start = np.lexsort([out[0], out[2]])
        return tuple(x[by_start] for x in out)


def _bound(column: np.ndarray, wanted: np.ndarray, low: np.ndarray, high: np.ndarray, before) -> np.ndarray:
    """Lockstep bisection: first index in [low, high) whose value is not ``before`` wanted."""
    low, high = low.copy(), high.copy()
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            return low
        mid = (low[open_] + high[open_]) // 2
        right = before(column[mid], wanted[open_])
        low[open_[right]] = mid[right] + 1
        high[open_[~right]] = mid[~right]


def _judge(column: pa.Array, tests: TestSuffixes) -> pa.Array:
    parts = []
    for first, end, data, offsets in W.shards(column):
        split = W.split(data, offsets, W.ALNUM_LOWER, lower=True)
        ids, dictionary = split.encode()
        known = pc.index_in(dictionary, value_set=tests.vocabulary).fill_null(-1).to_numpy(zero_copy_only=False)
        tokens = known[ids] if len(ids) else np.zeros(0, np.int64)
        place, kind = tests.search(tokens, split.doc)
        item, item_start, start, size = tests.matches(place, kind)
        hit = W.per_text(W.covered(split.n, place, tests.kind_length[kind]), split.doc)
        owner = np.searchsorted(split.doc, start, side="right") - 1
        bounds = np.searchsorted(owner, np.arange(end - first + 1))
        names = tests.ids[item]
        items = [sorted(set(names[a:b])) for a, b in zip(bounds[:-1], bounds[1:])]
        found = pa.StructArray.from_arrays(
            [
                pa.array(names.tolist(), pa.string()),
                pa.array(item_start, pa.int32()),
                pa.array(start - split.doc[owner], pa.int32()),
                pa.array(size, pa.int32()),
            ],
            fields=list(_MATCH),
        )
        parts.append(
            pa.StructArray.from_arrays(
                [
                    pa.array(split.counts(), pa.int64()),
                    pa.array(hit, pa.int64()),
                    pa.array(items, pa.list_(pa.string())),
                    pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), found),
                ],
                fields=list(_RESULT),
            )
        )
    return pa.concat_arrays(parts) if parts else pa.array([], _RESULT)


def _block_result(docs: DataFrame, text: str, rows: list, window: int) -> Column:
    ids = ["" if r[0] is None else str(r[0]) for r in rows]
    shared = docs.sparkSession.sparkContext.broadcast((ids, [r[1] for r in rows]))

    @F.arrow_udf(RESULT_TYPE)
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tests = TestSuffixes(*shared.value, window)
        for column in batches:
            yield _judge(column, tests)

    return judge.asNondeterministic()(F.col(text).cast("string"))


def _merge(one: pa.Array, other: pa.Array) -> pa.Array:
    out = []
    for a, b in zip(one.to_pylist(), other.to_pylist()):
        found = sorted(a["matches"] + b["matches"], key=lambda m: (m["start"], m["item"], m["item_start"]))
        hit, reach = 0, 0
        for m in found:  # sorted by start
            hit += max(0, m["start"] + m["length"] - max(reach, m["start"]))
            reach = max(reach, m["start"] + m["length"])
        out.append({"n_words": a["n_words"], "n_hit": hit, "items": sorted({*a["items"], *b["items"]}), "matches": found})
    return pa.array(out, _RESULT)


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    out: str = "contamination",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` plus the struct column ``out``: n_words, n_hit, items, matches."""
    items = benchmark.select(F.col(item_id).cast("string").alias("id"), F.col(item_text).cast("string").alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-int(size) // block_bytes))
    slot = F.pmod(F.xxhash64("id", "text"), F.lit(blocks))
    block = lambda k: items.filter(slot == k).collect()
    if blocks <= PASS_BLOCKS:
        return _judged(docs, text, map(block, range(blocks)), window, out)
    digest = F.sha2(F.col(text).cast("string"), 256)
    hits = None
    for first in range(0, blocks, PASS_BLOCKS):
        texts = docs.select(digest.alias("__cm_text"), F.col(text).cast("string").alias("text"))
        found = _judged(texts, "text", map(block, range(first, min(first + PASS_BLOCKS, blocks))), window, "__cm_found")
        found = found.filter(F.size("__cm_found.items") > 0).dropDuplicates(["__cm_text"]).drop("text")
        found = written(found, f"decontam-{first}")
        hits = found if hits is None else hits.unionByName(found)
    listed = hits.groupBy("__cm_text").agg(F.collect_list("__cm_found").alias("__cm_found"))  # a value per pass at most
    merged = listed.select("__cm_text", F.arrow_udf(_merge_all, RESULT_TYPE)("__cm_found").alias("__cm_found"))
    none = _judged(docs, text, [[]], window, out).withColumn("__cm_text", digest)
    joined = none.join(merged, "__cm_text", "left")
    return joined.withColumn(out, F.coalesce("__cm_found", out)).drop("__cm_text", "__cm_found")


def _judged(docs: DataFrame, text: str, blocks, window: int, out: str) -> DataFrame:
    """``docs`` with the results of some blocks of the benchmark as column ``out``."""
    # the text is kept aside, as ``out`` may be named like a column that is read
    result = docs.withColumn("__cm_read", F.col(text).cast("string"))
    for k, rows in enumerate(blocks):
        found = _block_result(result, "__cm_read", rows, window)
        if k == 0:
            result = result.withColumn("__cm_first", found)
        else:
            more = result.withColumn("__cm_more", found)
            both = F.arrow_udf(_merge, RESULT_TYPE)(F.col("__cm_first"), F.col("__cm_more"))
            result = more.withColumn("__cm_first", both).drop("__cm_more")
    return result.drop("__cm_read", out).withColumnRenamed("__cm_first", out)


def _merge_all(lists: pa.Array) -> pa.Array:
    out = []
    for found in lists.to_pylist():
        parts = [pa.array([f], _RESULT) for f in found]
        whole = parts[0]
        for part in parts[1:]:
            whole = _merge(whole, part)
        out += whole.to_pylist()
    return pa.array(out, _RESULT)


def is_contaminated(found: Column, percent: int = 5) -> Column:
    """The removal rule: some hit, and at least ``percent`` % of the words are hit."""
    hit, total = found["n_hit"], found["n_words"]
    return (hit > 0) & (hit * 100 >= total * percent)


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Documents that are not contaminated, with the columns of ``docs``."""
    out = "__cm_contamination"
    found = find_contamination(docs, benchmark, out=out, **options)
    return found.filter(~is_contaminated(F.col(out))).drop(out)

"""Quality rules: base statistics and a hashed n-gram log-likelihood ratio.

Method: word uni- and bigrams (ASCII lower-cased) are hashed into ``2 * BUCKETS`` cells.
Two multinomials are counted: the trusted target (documents named by the caller) and the
raw corpus (all documents).  A document's score is the mean over its n-grams of
``log p_target(cell) - log p_raw(cell)`` (length-normalised importance weight); it passes
when the score is at least ``threshold``.  The raw counts cover every text; the target is
the documents of ``trusted`` (at most ``TRUSTED_ROWS`` ids, chosen by smallest hash).

A few toxic words in a long text hardly move that mean, so they are looked for by
themselves: over all texts labelled toxic or clean, words (ASCII letters, digits and
non-ASCII, lower-cased) are hashed into ``TOXIC_CELLS`` and a cell counts the toxic and the
clean texts that have it.  A cell is toxic when more toxic than clean texts have it and its
log-likelihood ratio (G squared) is over ``SIGNIFICANT``: by Chernoff's bound no cell is
found by chance in 99 of 100 corpora.  A text's toxicity is the largest log odds of its
toxic cells (0 without one), whatever its length; it passes up to ``TOXIC_THRESHOLD``.

Plan: one pass counts (a task sends at most one row per cell, summed by a hash aggregate;
the model that reaches the driver has ``2 * BUCKETS`` rows whatever the corpus), one pass
scores.  No text is shuffled; for the toxic cells a text's distinct cells (three bytes each)
meet its label in a shuffle join, the same at every size.  Toxic cells are chosen in Spark,
so the driver gets only those.

Defined cases: null and word-free texts have zero statistics, score 0 and fail the base
rules; without trusted documents the score is 0 and decides nothing; without toxic labels, or
with too few to tell, toxicity is 0; an id labelled both ways is toxic; repeated rows and
repeated ids are judged alike; all input columns are kept, one named like the result
column is replaced; empty tables give empty results.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm import words as W
from corpusmill.llm.tables import written

BUCKET_BITS = 15
BUCKETS = 1 << BUCKET_BITS
TRUSTED_ROWS = 50_000
SMOOTHING = 1.0
REPEAT_WINDOW = 8
#: Mean log ratio under which a text is closer to the raw corpus' rest than to the target.
THRESHOLD = -0.2
TOXIC_BITS = 22
TOXIC_CELLS = 1 << TOXIC_BITS
SIGNIFICANT = 2 * math.log(TOXIC_CELLS / 0.01)
TOXIC_THRESHOLD = 0.0
_CELL_BYTES = 3

_SYMBOL = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
_NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SCORES = ("llr", "toxicity")
RESULT_TYPE = ", ".join([f"{c} bigint" for c in _NAMES] + [f"{c} double" for c in _SCORES])


def ngram_cells(split: W.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Unigram cells and their owners, bigram cells and their owners."""
    token = W.token_hashes(split, 7)
    shift = np.uint64(64 - BUCKET_BITS)
    owner = split.doc_of()
    inside = W.window_starts(split.doc, 2)
    pair = (W.window_hashes(token, 2, 11)[inside] >> shift).astype(np.int64) + BUCKETS
    return (token >> shift).astype(np.int64), owner, pair, owner[: len(inside)][inside]


def base_statistics(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    texts = len(offsets) - 1
    split = W.split(data, offsets, W.NOT_SPACE)
    chars = W.per_text((split.data & 0xC0) != 0x80, split.off[split.doc])
    symbols = W.per_text(_SYMBOL[split.data], split.off[split.doc])
    # lines with a word that equal an earlier line of the text
    newline = data == 10
    kept = ~newline
    edge = np.unique(np.concatenate([offsets, np.flatnonzero(newline) + 1])).astype(np.int64)
    lines = np.zeros(len(edge), np.int64)
    np.cumsum(W.per_text(kept, edge), out=lines[1:])
    has_word = W.per_text(W.NOT_SPACE[data], edge) > 0
    coded = pa.Array.from_buffers(
        pa.large_binary(), len(edge) - 1, [None, pa.py_buffer(lines), pa.py_buffer(data[kept])]
    ).dictionary_encode()
    owner = np.searchsorted(offsets, edge[:-1], side="right") - 1
    line = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    key = (owner * max(1, len(coded.dictionary)) + line)[has_word]
    _, first = np.unique(key, return_index=True)
    dup = np.bincount(owner[has_word], minlength=texts) - np.bincount(owner[has_word][first], minlength=texts)
    # words inside windows that occur twice or more in the text
    text_of = split.doc_of()
    inside = np.flatnonzero(W.window_starts(split.doc, REPEAT_WINDOW))
    key = W.window_hashes(W.token_hashes(split, 3), REPEAT_WINDOW, 3)[inside]
    key = key + W.mix(text_of[inside].astype(np.uint64) + np.uint64(1))
    _, which, times = np.unique(key, return_inverse=True, return_counts=True)
    repeated = W.covered(split.n, inside[times[which] > 1], REPEAT_WINDOW) if len(inside) else np.zeros(split.n, bool)
    return {
        "n_words": split.counts(),
        "word_chars": chars,
        "n_symbols": symbols,
        "n_dup_lines": dup,
        "n_repeat_words": W.per_text(repeated, split.doc),
    }


def cell_counts(docs: DataFrame, text: str, flag: Column) -> DataFrame:
    """(cell, raw, target): n-gram counts of all texts and of the flagged ones."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(2 * BUCKETS, np.int64), np.zeros(2 * BUCKETS, np.int64)
        for batch in batches:
            trusted = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for first, end, data, offsets in W.shards(batch.column(0)):
                split = W.split(data, offsets, W.NOT_SPACE, lower=True)
                one, owner, two, owner2 = ngram_cells(split)
                raw += np.bincount(one, minlength=2 * BUCKETS) + np.bincount(two, minlength=2 * BUCKETS)
                good = trusted[first:end]
                target += np.bincount(one[good[owner]], minlength=2 * BUCKETS)
                target += np.bincount(two[good[owner2]], minlength=2 * BUCKETS)
        cells = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays(
            [pa.array(cells, pa.int32()), pa.array(raw[cells]), pa.array(target[cells])], names=["cell", "raw", "target"]
        )

    rows = docs.select(F.col(text).cast("string").alias("t"), F.coalesce(flag, F.lit(False)).alias("f"))
    found = rows.mapInArrow(count, "cell int, raw bigint, target bigint")
    return found.groupBy("cell").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def log_ratio(docs: DataFrame, trusted: DataFrame, key: str, text: str, trusted_rows: int = TRUSTED_ROWS) -> np.ndarray:
    """Per cell log p_target - log p_raw; ``trusted`` has the ids of trusted documents."""
    ids = trusted.select(F.col(trusted.columns[0]).alias("__cm_id")).filter("__cm_id is not null").distinct()
    ids = ids.orderBy(F.xxhash64(F.lit(1), "__cm_id"), "__cm_id").limit(trusted_rows)
    flagged = docs.select(F.col(key).alias("__cm_key"), F.col(text).alias("__cm_text")).join(
        F.broadcast(ids.withColumn("__cm_good", F.lit(True))), F.col("__cm_key") == F.col("__cm_id"), "left"
    )  # at most trusted_rows ids
    cells = cell_counts(flagged, "__cm_text", F.col("__cm_good")).collect()  # at most 2 * BUCKETS rows
    raw, target = np.zeros(2 * BUCKETS), np.zeros(2 * BUCKETS)
    for cell, r, t in cells:
        raw[cell], target[cell] = r, t
    ratio = np.zeros(2 * BUCKETS)
    for part in (slice(0, BUCKETS), slice(BUCKETS, 2 * BUCKETS)):
        if target[part].sum() == 0:
            continue
        prior = SMOOTHING * BUCKETS * (raw[part] + SMOOTHING) / (raw[part].sum() + SMOOTHING * BUCKETS)
        p_raw = (raw[part] + SMOOTHING) / (raw[part].sum() + SMOOTHING * BUCKETS)
        # the target is smoothed towards the raw multinomial: unseen cells don't decide
        p_target = (target[part] + prior) / (target[part].sum() + prior.sum())
        ratio[part] = np.log(p_target) - np.log(p_raw)
    return ratio


def word_cells(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct word cells of every text, and their owners."""
    split = W.split(data, offsets, W.ALNUM_LOWER[W.LOWER], lower=True)
    cell = (W.token_hashes(split, 13) >> np.uint64(64 - TOXIC_BITS)).astype(np.int64)
    both = np.unique((split.doc_of() << TOXIC_BITS) | cell)
    return both & (TOXIC_CELLS - 1), both >> TOXIC_BITS


def toxic_cells(docs: DataFrame, labels: DataFrame, key: str, text: str) -> tuple[np.ndarray, np.ndarray]:
    """Toxic cells, sorted, and their log odds; ``labels`` is (id, toxic: boolean)."""
    marked = labels.select(F.col(labels.columns[0]).alias("__cm_id"), F.col(labels.columns[1]).alias("__cm_bad"))
    marked = marked.dropna().groupBy("__cm_id").agg(F.max("__cm_bad").alias("__cm_bad"))

    @F.arrow_udf("binary")
    def packed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            parts = [pa.array([], pa.large_binary())]
            for first, end, data, offsets in W.shards(column):
                cells, owner = word_cells(data, offsets)
                off = np.searchsorted(owner, np.arange(end - first + 1)) * _CELL_BYTES
                raw = np.ascontiguousarray(cells.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :_CELL_BYTES])
                parts.append(pa.Array.from_buffers(pa.large_binary(), end - first, [None, pa.py_buffer(off), pa.py_buffer(raw)]))
            yield pa.concat_arrays(parts).cast(pa.binary())

    rows = docs.filter(F.col(key).isNotNull()).select(F.col(key).alias("__cm_id"), packed(F.col(text).cast("string")).alias("c"))
    rows = rows.join(marked.hint("merge"), "__cm_id").select("c", "__cm_bad")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the cell after the last one counts texts
        seen = np.zeros((2, TOXIC_CELLS + 1), np.int64)
        for batch in batches:
            bad = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            seen[:, -1] += np.bincount(bad, minlength=2)
            column = batch.column(0).cast(pa.large_binary())
            off = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
            raw = np.frombuffer(column.buffers()[2] or b"", np.uint8)[off[0] : off[-1]].reshape(-1, _CELL_BYTES)
            cells = np.zeros((len(raw), 4), np.uint8)
            cells[:, :_CELL_BYTES] = raw
            np.add.at(seen, (np.repeat(bad, np.diff(off) // _CELL_BYTES), cells.view("<u4")[:, 0]), 1)
        cells = np.flatnonzero(seen.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(cells, pa.int32()), pa.array(seen[1, cells]), pa.array(seen[0, cells])], names=["cell", "bad", "good"]
        )

    found = rows.mapInArrow(count, "cell int, bad bigint, good bigint")
    found = written(found.groupBy("cell").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")), "quality-toxic")
    texts = found.filter(F.col("cell") == TOXIC_CELLS).first()
    if texts is None or not texts.bad or not texts.good:
        return np.zeros(0, np.int64), np.zeros(0)
    share = texts.bad / (texts.bad + texts.good)
    have = F.col("bad") + F.col("good")
    part = lambda n, p: F.when(n > 0, n * F.log(n / (have * p))).otherwise(0.0)
    odds = F.log((F.col("bad") + 0.5) / (F.col("good") + 0.5))
    chosen = found.filter(F.col("cell") < TOXIC_CELLS).select(
        "cell", odds.alias("odds"), (2 * (part(F.col("bad"), share) + part(F.col("good"), 1 - share))).alias("g2")
    )
    over = math.log(share / (1 - share))  # more frequent in toxic texts, too, when these are the most
    chosen = chosen.filter((F.col("odds") > max(0.0, over)) & (F.col("g2") > SIGNIFICANT)).orderBy("cell").collect()
    return np.array([r.cell for r in chosen], np.int64), np.array([r.odds for r in chosen])


def toxicity(data: np.ndarray, offsets: np.ndarray, toxic: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    out = np.zeros(len(offsets) - 1)
    known, odds = toxic
    if len(known):
        cells, owner = word_cells(data, offsets)
        at = np.minimum(np.searchsorted(known, cells), len(known) - 1)
        hit = known[at] == cells
        np.maximum.at(out, owner[hit], odds[at[hit]])
    return out


_NOT_TOXIC = (np.zeros(0, np.int64), np.zeros(0))


def judge(
    column: pa.Array, ratio: np.ndarray, toxic: tuple[np.ndarray, np.ndarray] = _NOT_TOXIC
) -> dict[str, np.ndarray]:
    parts: list[dict[str, np.ndarray]] = []
    for first, end, data, offsets in W.shards(column):
        stats = base_statistics(data, offsets)
        one, owner, two, owner2 = ngram_cells(W.split(data, offsets, W.NOT_SPACE, lower=True))
        total = np.bincount(owner, ratio[one], end - first) + np.bincount(owner2, ratio[two], end - first)
        grams = np.bincount(owner, minlength=end - first) + np.bincount(owner2, minlength=end - first)
        stats["llr"] = total / np.maximum(grams, 1)
        stats["toxicity"] = toxicity(data, offsets, toxic)
        parts.append(stats)
    return {c: np.concatenate([p[c] for p in parts]) if parts else np.zeros(0) for c in (*_NAMES, *_SCORES)}


def score_quality(
    docs: DataFrame,
    trusted: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    out: str = "quality",
    labels: DataFrame | None = None,
    **options,
) -> DataFrame:
    """``docs`` plus the struct column ``out`` (base statistics, ``llr`` and ``toxicity``).

    ``labels`` is (id, toxic: boolean) of all documents that were judged."""
    ratio = log_ratio(docs, trusted, key, text, **options)
    toxic = _NOT_TOXIC if labels is None else toxic_cells(docs, labels, key, text)
    shared = docs.sparkSession.sparkContext.broadcast((ratio, toxic))

    @F.arrow_udf(RESULT_TYPE)
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            got = judge(column, *shared.value)
            yield pa.StructArray.from_arrays(
                [pa.array(got[c], pa.int64()) for c in _NAMES] + [pa.array(got[c], pa.float64()) for c in _SCORES],
                names=[*_NAMES, *_SCORES],
            )

    return docs.withColumn(out, scored.asNondeterministic()(F.col(text).cast("string")))


def base_failed(q: Column, min_words: int = 20, max_repeat_percent: int = 30) -> Column:
    return (q["n_words"] < min_words) | (q["n_repeat_words"] * 100 > q["n_words"] * max_repeat_percent)


def is_kept(q: Column, threshold: float = THRESHOLD) -> Column:
    return ~base_failed(q) & (q["llr"] >= F.lit(threshold)) & (q["toxicity"] <= F.lit(TOXIC_THRESHOLD))


def keep_quality(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """The documents that pass the base rules, the likelihood-ratio and the toxicity threshold."""
    out = "__cm_quality"
    scored = score_quality(docs, trusted, out=out, **options)
    return scored.filter(is_kept(F.col(out), threshold)).drop(out)

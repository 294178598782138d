"""SimHash near-duplicate detection by tiled exact comparison.

Fingerprints (64 bits over XXH64 of word shingles) are worked out in one pass.  Distinct
fingerprints are sorted by population count and cut into tiles of about ``TILE``; all tile
pairs are compared exactly with numpy (exclusive-or, bit count), except pairs whose
population counts differ by more than the radius: two words within r bits differ by at
most r in population count.  Inside a pair the same bound narrows every row block to the
columns it can reach.  A pair of tiles emits a spanning forest of its links (at most one
link per fingerprint), never all pairs of a group; connected components join the forests.

Exact copies collapse to one fingerprint before the comparison, so a group of copies of
any size costs one row per task.  Fingerprints, links and labels stay in Spark tables; the
driver sees only the tiles' population-count ranges (one row per tile).

Defined cases: null, empty and blank texts have fingerprint zero and are linked like any
other; fewer words than a shingle: the whole sequence is the one shingle; repeated
shingles count each time; repeated rows get the same class; a class of rows whose ids are
all null has a null component id; empty tables give empty results; input columns named
like the two result columns are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm import words as W
from corpusmill.llm.tables import components, written
from corpusmill.operators.ordinals import bucket_column, key_bounds

SHINGLE = 4
RADIUS = 4
SEED = 42
TILE = 1 << 15
BLOCK = 8  # tiles that a task holds
MOST_TASKS = 1 << 15
_ROWS = 64


def shingle_hashes(split: W.Words, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of every shingle (space-joined) and the text that owns it, by text."""
    size = np.diff(split.off)
    joined = np.full(len(split.data) + split.n, 32, np.uint8)
    joined[np.arange(len(split.data)) + np.repeat(np.arange(split.n), size)] = split.data
    off = split.off + np.arange(split.n + 1)
    inside = np.flatnonzero(W.window_starts(split.doc, k))
    counts = split.counts()
    short = np.flatnonzero((counts > 0) & (counts < k))
    start = np.concatenate([off[inside], off[split.doc[short]]])
    end = np.concatenate([off[inside + k], off[split.doc[short + 1]]]) - 1
    owner = np.concatenate([split.doc_of()[inside], short])
    order = np.argsort(owner, kind="stable")
    raw, digest = joined.tobytes(), xxhash.xxh64_intdigest
    spans = zip(start[order].tolist(), end[order].tolist())
    return np.fromiter((digest(raw[s:e], SEED) for s, e in spans), np.uint64, len(order)), owner[order]


def fingerprints(column: pa.Array, k: int = SHINGLE) -> np.ndarray:
    parts = [np.zeros(0, np.uint64)]
    for first, end, data, offsets in W.shards(column):
        hashed, owner = shingle_hashes(W.split(data, offsets, W.NOT_SPACE, lower=True), k)
        out = np.zeros(end - first, np.uint64)
        if len(hashed):
            have, begin = np.unique(owner, return_index=True)
            total = np.bincount(owner, minlength=end - first)[have]
            bits = np.unpackbits(hashed.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones = np.add.reduceat(bits, begin, axis=0, dtype=np.int64)
            packed = np.packbits(2 * ones > total[:, None], axis=1, bitorder="little")
            out[have] = np.ascontiguousarray(packed).view(np.uint64).reshape(-1)
        parts.append(out)
    return np.concatenate(parts)


def forest(left: np.ndarray, right: np.ndarray | None, radius: int) -> list[tuple[int, int]]:
    """Spanning forest of the links within a tile (``right`` is None) or between two."""
    a = left[np.argsort(np.bitwise_count(left), kind="stable")]
    b = a if right is None else right[np.argsort(np.bitwise_count(right), kind="stable")]
    pop_a, pop_b = np.bitwise_count(a).astype(np.int64), np.bitwise_count(b).astype(np.int64)
    shift = 0 if right is None else len(a)
    root = np.arange(len(a) + (0 if right is None else len(b)))
    out: list[tuple[int, int]] = []
    xor, near = np.empty(_ROWS * len(b), np.uint64), np.empty(_ROWS * len(b), np.uint8)
    for first in range(0, len(a), _ROWS):
        rows = a[first : first + _ROWS]
        low = np.searchsorted(pop_b, pop_a[first] - radius)
        high = np.searchsorted(pop_b, pop_a[first + len(rows) - 1] + radius, side="right")
        if right is None:
            low = max(low, first)
        if high <= low:
            continue
        cells = len(rows) * (high - low)
        x = np.bitwise_xor(rows[:, None], b[None, low:high], out=xor[:cells].reshape(len(rows), -1))
        n = np.bitwise_count(x, out=near[:cells].reshape(len(rows), -1))
        hit = np.flatnonzero(n.reshape(-1) <= radius)
        i, j = first + hit // (high - low), low + hit % (high - low)
        ri, rj = root[i], root[j + shift]
        apart = np.flatnonzero(ri != rj)
        if not len(apart):
            continue
        ri, rj, i, j = ri[apart], rj[apart], i[apart], j[apart]
        _, one = np.unique(np.minimum(ri, rj) * np.int64(len(root)) + np.maximum(ri, rj), return_index=True)
        parent: dict[int, int] = {}

        def find(x: int) -> int:
            while parent.get(x, x) != x:
                parent[x] = parent.get(parent[x], parent[x])
                x = parent[x]
            return x

        for k in one.tolist():
            p, q = find(int(ri[k])), find(int(rj[k]))
            if p != q:
                parent[max(p, q)] = min(p, q)
                out.append((int(a[i[k]]), int(b[j[k]])))
        if parent:
            old = np.array(sorted(parent), np.int64)
            new = np.array([find(int(x)) for x in old], np.int64)
            at = np.searchsorted(old, root)
            at[at == len(old)] = 0
            root = np.where(old[at] == root, new[at], root)
    return out


def _signed(values: list[tuple[int, int]]) -> pa.Array:
    both = np.array(values, np.uint64).reshape(-1, 2).view(np.int64)
    return pa.StructArray.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])


def links(distinct: DataFrame, radius: int = RADIUS, tile: int = TILE, block: int = BLOCK) -> DataFrame:
    """Forest links ``(a, b)`` between the distinct fingerprints of column ``fp``.

    Tiles are numbered in population-count order, so the tiles within the radius of one are the
    next few; where they end follows from its highest count and a table of at most 65 counts,
    all that the driver sees.  Tiles are compared block by block: a task holds ``block`` tiles
    and streams the tiles that reach into them past them, so a tile is shuffled once per block
    it reaches and not once per pair.  The tiles that reach a block are dealt to several tasks."""
    spark = distinct.sparkSession
    keyed = distinct.select(F.bit_count("fp").alias("pop"), "fp")
    count = max(1, -(-keyed.count() // tile))
    bounds = key_bounds(keyed, ["pop", "fp"], count)
    tiles = keyed.withColumn("tile", bucket_column(["pop", "fp"], bounds, spark)).groupBy("tile")
    tiles = written(tiles.agg(F.min("pop").alias("low"), F.max("pop").alias("high"), F.collect_list("fp").alias("fps")), "simhash-tiles")
    begins = dict(tiles.groupBy("low").agg(F.max("tile")).collect())  # a row per population count
    ends = [max((t for low, t in begins.items() if low <= pop), default=0) for pop in range(65 + radius)]
    reach = F.element_at(F.array(*map(F.lit, ends)), F.col("high") + radius + 1)
    blocks = (max(begins.values(), default=0) // block) + 1
    shares = max(1, min(block, 32 * spark.sparkContext.defaultParallelism // blocks))
    own = tiles.select(
        F.floor(F.col("tile") / block).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("share"),
        F.lit(0).alias("kind"),
        "tile",
        "fps",
    )
    first, last = (F.floor(t / block).cast("int") for t in (F.col("tile"), reach))
    coming = tiles.select(F.explode(F.sequence(first, last)).alias("block"), (F.col("tile") % shares).alias("share"), F.lit(1).alias("kind"), "tile", "fps")
    both = own.unionByName(coming).withColumn("id", F.col("block") * shares + F.col("share"))
    # a block is much work for few bytes: dealt to tasks by number, not by size
    both = both.repartitionById(min(blocks * shares, MOST_TASKS), F.col("id") % min(blocks * shares, MOST_TASKS))
    both = both.sortWithinPartitions("id", "kind", "tile").select("id", "kind", "tile", "fps")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, {}
        for batch in batches:
            ids, kinds, numbers = (batch.column(c).to_pylist() for c in range(3))
            for k, (at, kind, number) in enumerate(zip(ids, kinds, numbers)):
                if at != now:
                    now, held = at, {}
                fps = batch.column(3)[k].values.to_numpy().astype(np.int64).view(np.uint64)
                if kind == 0:
                    held[number] = fps
                    continue
                for other, right in held.items():
                    if other >= number:
                        got = _signed(forest(fps, None if other == number else right, radius))
                        yield pa.RecordBatch.from_arrays(got.flatten(), names=["a", "b"])

    return both.mapInArrow(compare, "a bigint, b bigint")


def simhash_classes(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
    tile: int = TILE,
) -> DataFrame:
    """``(key, text_hash, fingerprint, component_id, class_root)``, one row per row of
    ``docs``; ``class_root`` is a fingerprint of the component that names it."""

    @F.arrow_udf("bigint")
    def fingerprint(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            yield pa.array(fingerprints(column, shingle).view(np.int64))

    rows = docs.select(F.col(key).alias("id"), F.col(text).cast("string").alias("t"))
    rows = rows.select("id", F.xxhash64("t").alias("th"), fingerprint(F.col("t")).alias("fp"))
    rows = written(rows, "simhash-fingerprints")
    distinct = written(rows.groupBy("fp").agg(F.min("id").alias("low")), "simhash-distinct")
    member = components(links(distinct, radius, tile), "simhash-components")
    joined = member.join(distinct, member["node"] == distinct["fp"]).select("fp", "root", "low")
    lows = joined.groupBy("root").agg(F.min("low").alias("component"))
    named = joined.join(lows, "root").select("fp", "root", "component")
    labels = distinct.join(named, "fp", "left").select(
        "fp", F.coalesce("component", "low").alias("component_id"), F.coalesce("root", "fp").alias("root")
    )
    out = rows.join(labels, "fp")
    return out.select(
        F.col("id").alias(key),
        F.col("th").alias("text_hash"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
        F.lpad(F.lower(F.hex("root")), 16, "0").alias("class_root"),
    )


def keep_one_per_class(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The document with the smallest id of each class, with the columns of ``docs``.

    Rows that repeat one id and text count as one; of several texts under the class's
    smallest id the one with the smallest text hash stays; a class without ids keeps the
    row with the smallest text hash."""
    classes = simhash_classes(docs, key, text, **options)
    chosen = classes.filter(F.col(key).eqNullSafe(F.col("component_id")))
    # texts of several classes can share an id, so a component id does not name a class
    chosen = chosen.groupBy("class_root").agg(F.min(F.struct("text_hash", F.col(key))).alias("__cm_pick"))
    chosen = chosen.select(F.col("__cm_pick.text_hash").alias("__cm_hash"), F.col("__cm_pick")[key].alias("__cm_id")).distinct()
    tagged = docs.withColumn("__cm_th", F.xxhash64(F.col(text).cast("string")))
    match = tagged["__cm_th"].eqNullSafe(F.col("__cm_hash")) & tagged[key].eqNullSafe(F.col("__cm_id"))
    kept = tagged.join(chosen, match)
    first = Window.partitionBy("__cm_th", "__cm_id").orderBy(F.lit(1))
    kept = kept.withColumn("__cm_rank", F.row_number().over(first)).filter("__cm_rank = 1")
    return kept.select(*docs.columns)

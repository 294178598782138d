"""Mixing sources into training order: round-robin interleave, worker striping,
batching, collation and weighted mixture sampling.

The interleaved order is ``(round, source order)``.  Round and size of every source give the
total position in closed form: before row (r, s) stand ``sum of min(n_j, r)`` rows of earlier
rounds and one row of every earlier source with ``n_j > r``.  So an interleave needs one
ordinal (the round) and no sort of the mixed order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.functions.ids import unit_hash
from corpusmill.operators.ordinals import null_safe_join, with_ordinal

# Largest table of sources (rows) that goes to the driver and is broadcast; beyond it the
# position comes from a second distributed ordinal.
SOURCE_LIMIT = 200_000


class RoundRobin:
    """Positions of a round-robin over many sources, from their sizes alone.

    ``scope[k]`` and ``size[k]`` describe source k; sources of a scope are consecutive and in
    their order.  ``levels`` is a merge-sort tree over the sizes: level l has them sorted in
    aligned blocks of 2**l, as ``block * base + size``, so that the sources before k with more
    than r rows are counted with one binary search per bit of k."""

    def __init__(self, scope: np.ndarray, size: np.ndarray):
        n = len(size)
        self.first = np.searchsorted(scope, scope)  # the first source of its scope
        self.base = int(size.max(initial=0)) + 2
        self.levels = []
        while (1 << len(self.levels)) <= n:
            block = np.arange(n) >> len(self.levels)
            self.levels.append(np.sort(block * self.base + size))
        # per scope: sizes in ascending order with their running sums
        order = np.lexsort((size, scope))
        self.scope = scope
        self.sorted = scope * self.base + size[order]
        self.sums = np.concatenate([[0], np.cumsum(size[order])])
        self.end = np.searchsorted(scope, scope, side="right")

    def _longer(self, upto: np.ndarray, r: np.ndarray) -> np.ndarray:
        """Sources before ``upto`` with more than r rows."""
        out = np.zeros(len(upto), np.int64)
        for k, level in enumerate(self.levels):
            at = np.flatnonzero(upto >> k & 1)
            block = (upto[at] >> (k + 1)) << 1
            short = np.searchsorted(level, block * self.base + r[at], side="right") - (block << k)
            out[at] += (1 << k) - short
        return out

    def position(self, source: np.ndarray, r: np.ndarray) -> np.ndarray:
        first, end = self.first[source], self.end[source]
        # rows of earlier rounds: the whole of sources with at most r rows, r of each other one
        short = np.searchsorted(self.sorted, self.scope[source] * self.base + r, side="right")
        before = self.sums[short] - self.sums[first] + (end - short) * r
        return before + self._longer(source, r) - self._longer(first, r)


def interleave(
    df: DataFrame,
    source_col: str,
    source_ord_col: str,
    order_cols,
    scope_cols=(),
    round_col: str = "rr_round",
    position_col: str | None = "position",
) -> DataFrame:
    """Fair round-robin: round r takes the r-th row of every source that still has one,
    in source order.  Exhausted sources simply have no row in later rounds.

    ``scope_cols`` interleaves independently per scope (e.g. per worker).  The order column is
    one value per source (nulls first); sources of one order follow each other by name.  Up to
    SOURCE_LIMIT (scope, source) pairs, counted first, their sizes are broadcast and give the
    positions in closed form; beyond it a second ordinal does."""
    scope = list(scope_cols)
    out = with_ordinal(df, order_cols, [*scope, source_col], name=round_col)
    if not position_col:
        return out
    keys = [*scope, source_col]
    sizes = df.groupBy(*keys).agg(F.min(source_ord_col).alias("__rr_ord"), F.count(F.lit(1)).alias("__rr_n"))
    order = [*scope, "__rr_ord", source_col]
    found = sizes.limit(SOURCE_LIMIT + 1).collect()
    if len(found) > SOURCE_LIMIT:
        return with_ordinal(out, list(dict.fromkeys([round_col, source_ord_col, source_col])), scope, name=position_col)
    found.sort(key=lambda row: [(row[c] is not None, row[c]) for c in order])
    places = [tuple(row[c] for c in scope) for row in found]
    number = {place: k for k, place in enumerate(dict.fromkeys(places))}
    model = RoundRobin(
        np.array([number[p] for p in places], np.int64), np.array([row["__rr_n"] for row in found], np.int64)
    )
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(model)
    schema = sizes.select(*keys, F.lit(0).alias("__rr_source")).schema
    table = spark.createDataFrame([(*(row[c] for c in keys), k) for k, row in enumerate(found)], schema)
    out = null_safe_join(out, F.broadcast(table), keys)

    @F.arrow_udf("bigint")
    def position(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for source, r in batches:
            yield pa.array(shared.value.position(source.to_numpy().astype(np.int64), r.to_numpy()), pa.int64())

    return out.withColumn(position_col, position("__rr_source", round_col)).drop("__rr_source")


def stripe_workers(entries: DataFrame, num_workers: int, entry_ord_col: str = "entry_ord", name: str = "worker") -> DataFrame:
    """Worker k takes entries k, k+n, k+2n, ..."""
    if num_workers <= 0:
        raise ValueError("num_workers must be > 0")
    return entries.withColumn(name, F.pmod(F.col(entry_ord_col), F.lit(num_workers)).cast("int"))


def assign_batches(df: DataFrame, position_col: str, batch_size: int, name: str = "batch_id") -> DataFrame:
    if batch_size <= 0:
        raise ValueError("batch_size must be > 0")
    return df.withColumn(name, F.floor(F.col(position_col) / F.lit(batch_size)).cast("bigint"))


def limit_batches(df: DataFrame, max_batches: int | None, batch_col: str = "batch_id") -> DataFrame:
    """Per-epoch / validation batch cap (None or 0 = no cap)."""
    if not max_batches:
        return df
    return df.filter(F.col(batch_col) < F.lit(max_batches))


def collate(
    df: DataFrame, batch_cols, position_col: str, fields, flag_col: str | None = None, name: str = "rows"
) -> DataFrame:
    """Rows -> one row per batch: ``rows`` = fields in position order, ``size``, and
    ``any_flag`` = OR of the per-row flag.  Batch size bounds every group."""
    items = F.sort_array(F.collect_list(F.struct(F.col(position_col).alias("__pos"), *[F.col(f) for f in fields])))
    aggs = [items.alias(name), F.count(F.lit(1)).cast("bigint").alias("size")]
    if flag_col:
        aggs.append(F.coalesce(F.bool_or(F.col(flag_col)), F.lit(False)).alias("any_flag"))
    out = df.groupBy(*batch_cols).agg(*aggs)
    return out.withColumn(name, F.transform(name, lambda s: s.dropFields("__pos")))


def mixture_sample(df: DataFrame, id_col: str, weight_col: str, max_weight: float) -> DataFrame:
    """Deterministic weighted sampling: keep a row iff hash(id) < weight / max_weight."""
    share = F.col(weight_col) / F.lit(float(max_weight))
    return df.filter(unit_hash(id_col) < share)


def mixture_report(sampled: DataFrame, weights: DataFrame, source_col: str, weight_col: str) -> DataFrame:
    """Expected share (weight / total weight) vs actual share of rows per source."""
    counts = sampled.groupBy(source_col).agg(F.count(F.lit(1)).alias("n"))
    j = weights.join(counts, source_col, "left").fillna({"n": 0})
    everything = Window.partitionBy()  # per-source table: one row per source, small
    return j.select(
        source_col,
        F.col("n").cast("bigint").alias("rows"),
        (F.col(weight_col) / F.sum(weight_col).over(everything)).alias("expected_share"),
        (F.col("n") / F.sum("n").over(everything)).alias("actual_share"),
    )

"""Contiguous ordinals without a single-partition window.

``row_number() over (partition by g order by k)`` sends every row of a group to one
task; a source holding a third of the corpus would then be sorted by one core.  Here
rows are cut into B contiguous buckets of the ``(g, k)`` order instead:

1. a small deterministic sample of the keys (fixed seed, at most ~``SAMPLE_PER_BUCKET``
   keys per bucket) is collected and B-1 bucket bounds are chosen on the driver; they
   enter the plan as literals, so every branch and every recomputation after an
   executor loss assigns a row to the same bucket (Spark's own range exchange seeds its
   sampling with the RDD id, so two branches of one plan may disagree);
2. ``row_number() over (partition by bucket, g order by k)``: windows of bounded size,
   a hot group is spread over many buckets;
3. per (bucket, g) counts -> exclusive prefix sum over buckets, on a table of at most
   ``B + groups`` rows, joined back null-safely (broadcast when the number of groups,
   estimated in the same job that counts the keys, is checked to be small).

There is one path for every input size; an input with a single distinct key (or none)
needs no join.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Largest summary table we broadcast (rows); beyond it the join is a regular shuffle join.
BROADCAST_ROW_LIMIT = 2_000_000
SAMPLE_PER_BUCKET = 20
MAX_SAMPLE = 1_000_000
MAX_BUCKETS = 1 << 17
CASE_TREE_LIMIT = 1024  # up to this many bounds the lookup is a nested CASE (JVM, codegen)
SAMPLE_SEED = 17


def _cols(cols: Sequence[str | Column] | str | Column | None) -> list:
    if cols is None:
        return []
    if isinstance(cols, (str, Column)):
        return [cols]
    return list(cols)


def _names(cols) -> list[str]:
    return [c for c in cols if isinstance(c, str)]


def num_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def key_stats(df: DataFrame, group_cols: Sequence[str]) -> tuple[int, int]:
    """Rows and (approximate) distinct groups, from the group columns alone."""
    groups = [F.col(c) for c in group_cols]
    distinct = F.approx_count_distinct(F.struct(*groups)) if groups else F.lit(1)
    total, kinds = df.agg(F.count(F.lit(1)), distinct).first()
    return int(total), int(kinds)


def small_group_count(df: DataFrame, group_cols: Sequence[str], limit: int = BROADCAST_ROW_LIMIT) -> bool:
    """Size check before a broadcast: are there at most ``limit`` distinct groups?  Reads
    only the group columns and stops counting at the limit."""
    return df.select(*group_cols).distinct().limit(limit + 1).count() <= limit


def null_safe_join(left: DataFrame, right: DataFrame, cols: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``cols`` where null equals null; the columns of ``left`` stay."""
    names = {c: f"__cm_r{k}" for k, c in enumerate(cols)}
    right = right.withColumnsRenamed(names)
    on = F.lit(True)
    for k, (c, r) in enumerate(names.items()):
        same = left[c].eqNullSafe(right[r])
        on = same if k == 0 else on & same
    return left.join(right, on, how).drop(*names.values())


def _sort_key(values):
    # Spark ascending order puts nulls first; strings compare like UTF-8 bytes (= code points)
    return tuple((0, 0) if v is None else (1, v) for v in values)


def _greater(cols: list[str], bound: tuple) -> Column:
    """Null-safe lexicographic ``(cols) > bound`` (nulls sort first)."""
    out = None
    for c, v in reversed(list(zip(cols, bound))):
        col = F.col(c)
        if v is None:
            gt, eq = col.isNotNull(), col.isNull()
        else:
            gt, eq = F.coalesce(col > F.lit(v), F.lit(False)), F.coalesce(col == F.lit(v), F.lit(False))
        out = gt if out is None else (gt | (eq & out))
    return out


def key_bounds(df: DataFrame, key_cols: list[str], buckets: int, total: int | None = None) -> list[tuple]:
    """Up to ``buckets - 1`` sorted, distinct split points from a fixed-seed Bernoulli
    sample of about ``buckets * SAMPLE_PER_BUCKET`` keys (capped at ``MAX_SAMPLE``).  A
    count of the key columns sets the fraction; the sample is drawn in every task and
    only the sampled keys (bounded) reach the driver."""
    if buckets <= 1:
        return []
    want = min(MAX_SAMPLE, buckets * SAMPLE_PER_BUCKET)
    keys_df = df.select(*key_cols)
    total = keys_df.count() if total is None else total
    if total == 0:
        return []
    fraction = min(1.0, 1.5 * want / total)
    rows = keys_df.sample(False, fraction, SAMPLE_SEED).limit(2 * want).collect()
    keys = sorted((tuple(r) for r in rows), key=_sort_key)
    if not keys:
        return []
    step = len(keys) / buckets
    bounds, seen = [], set()
    for i in range(1, buckets):
        b = keys[min(len(keys) - 1, int(i * step))]
        if b not in seen:
            seen.add(b)
            bounds.append(b)
    return sorted(bounds, key=_sort_key)


def _py_key(values):
    import math

    def norm(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return None
        return v.item() if hasattr(v, "item") else v

    return _sort_key([norm(v) for v in values])


def bucket_column(key_cols: list[str], bounds: list[tuple], spark=None) -> Column:
    """Bucket index = number of bounds below the row key.

    Few bounds: binary search written as a nested CASE (JVM, inside codegen).  Many
    bounds (large clusters): the sorted bounds are broadcast once and an Arrow UDF runs
    ``bisect`` over the key columns only, so the plan stays small."""
    if len(bounds) <= CASE_TREE_LIMIT or spark is None:

        def node(lo: int, hi: int) -> Column:
            if lo == hi:
                return F.lit(lo)
            mid = (lo + hi) // 2
            return F.when(_greater(key_cols, bounds[mid]), node(mid + 1, hi)).otherwise(node(lo, mid))

        return node(0, len(bounds)).cast("int")
    import bisect

    from pyspark.sql.types import IntegerType

    shared = spark.sparkContext.broadcast([_sort_key(b) for b in bounds])

    @F.pandas_udf(IntegerType())
    def lookup(rows: pd.DataFrame) -> pd.Series:
        keys = shared.value
        return pd.Series([bisect.bisect_left(keys, _py_key(t)) for t in rows.itertuples(index=False)], dtype="int32")

    return lookup(F.struct(*[F.col(c) for c in key_cols]))


def default_buckets(df: DataFrame) -> int:
    sc = df.sparkSession.sparkContext
    return max(2, min(MAX_BUCKETS, 2 * max(num_partitions(df), sc.defaultParallelism)))


def with_ordinal(
    df: DataFrame,
    order_cols,
    group_cols=None,
    name: str = "ord",
    start: int = 0,
    partitions: int | None = None,
    sample_from: DataFrame | None = None,
) -> DataFrame:
    """Add ``name`` = contiguous row number (from ``start``) within each group in
    ``order_cols`` order (ascending).  The order should be total within a group; ties
    are numbered in an arbitrary order.  Nulls are a group of their own and sort first.

    ``sample_from``: a cheaper frame with the same key columns (e.g. the raw input of a
    filtered frame) to draw bucket bounds from; any bounds are correct, good ones only
    balance the buckets."""
    groups = _names(_cols(group_cols))
    orders = _names(_cols(order_cols))
    keys = groups + orders
    source = sample_from if sample_from is not None else df
    total, kinds = key_stats(source, groups)
    bounds = key_bounds(source, keys, partitions or default_buckets(df), total)
    tagged = df.withColumn("__cm_b", bucket_column(keys, bounds, df.sparkSession))
    w = Window.partitionBy("__cm_b", *groups).orderBy(*orders)
    local = tagged.withColumn("__cm_rn", F.row_number().over(w) - F.lit(1))
    if not bounds:  # at most one distinct key: nothing lies before the only bucket
        out = local.withColumn(name, (F.col("__cm_rn") + F.lit(start)).cast("bigint"))
        return out.drop("__cm_b", "__cm_rn")
    # counts from the windowed branch: both branches share one exchange of the input
    summary = local.groupBy("__cm_b", *groups).agg((F.max("__cm_rn") + F.lit(1)).alias("__cm_n"))
    pw = Window.partitionBy(*groups).orderBy("__cm_b").rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.withColumn("__cm_off", F.coalesce(F.sum("__cm_n").over(pw), F.lit(0))).drop("__cm_n")
    if kinds <= BROADCAST_ROW_LIMIT // 2:  # the estimate is off by a few per cent
        summary = F.broadcast(summary)
    out = null_safe_join(local, summary, ["__cm_b", *groups])
    out = out.withColumn(name, (F.col("__cm_off") + F.col("__cm_rn") + F.lit(start)).cast("bigint"))
    return out.drop("__cm_b", "__cm_rn", "__cm_off")


def with_group_sizes(df: DataFrame, group_cols, name: str = "group_size") -> DataFrame:
    """Attach the row count of each group (partial aggregation, then a null-safe join on the
    key; AQE picks the strategy from measured sizes)."""
    groups = _names(_cols(group_cols))
    if not groups:
        raise ValueError("with_group_sizes needs at least one group column")
    return null_safe_join(df, df.groupBy(*groups).agg(F.count(F.lit(1)).alias(name)), groups)

"""Sequence windows that stay balanced when one group holds a large share of rows.

Both operators need a contiguous position per group (``with_ordinal``).  Rows are then
cut into fixed-size blocks of ``block`` positions, so every window partition holds at
most ``block`` (+ a small halo) rows, however large the group:

* ``last_n``: frame "n-1 preceding .. current".  The last n-1 rows of each block are
  copied into the next block as halo rows, the window runs per (group, block), the halo
  rows are dropped again.
* ``before``: what stands before a row in an order, without positions: rows are cut into
  contiguous buckets of the (group, order) key as ``with_ordinal`` does, the window runs per
  (bucket, group), and a table of one row per (bucket, group) carries values over.
* ``running``: prefix aggregate (min / max / sum / count).  Per-block totals are
  combined over preceding blocks on a table of ``rows / block`` entries, then added to
  the in-block running value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.operators.ordinals import (
    BROADCAST_ROW_LIMIT,
    bucket_column,
    default_buckets,
    key_bounds,
    key_stats,
    null_safe_join,
)

DEFAULT_BLOCK = 1 << 16


def before(df: DataFrame, group_cols, order_cols, value: Column | str, fn: str, out_col: str) -> DataFrame:
    """``out_col`` = over the rows before the current one of its group, in ``order_cols`` order
    (total within a group): ``last`` (the value of the row just before), ``min``, ``max`` or
    ``sum``; null for the first row.  One exchange of the rows, whatever the group sizes."""
    groups, orders = list(group_cols), [order_cols] if isinstance(order_cols, str) else list(order_cols)
    keys = groups + orders
    total, kinds = key_stats(df, groups)
    bounds = key_bounds(df, keys, default_buckets(df), total)
    val = F.col(value) if isinstance(value, str) else value
    tagged = df.withColumn("__b_val", val).withColumn("__b_no", bucket_column(keys, bounds, df.sparkSession))
    w = Window.partitionBy("__b_no", *groups).orderBy(*orders)
    agg = {"last": lambda c: F.max_by(c, F.struct(*orders)), "min": F.min, "max": F.max, "sum": F.sum}[fn]
    inside = F.lag("__b_val").over(w) if fn == "last" else agg("__b_val").over(w.rowsBetween(Window.unboundedPreceding, -1))
    local = tagged.withColumn("__b_local", inside).withColumn("__b_first", F.row_number().over(w) == 1)
    if not bounds:  # one bucket
        return local.withColumn(out_col, F.col("__b_local")).drop("__b_val", "__b_no", "__b_local", "__b_first")
    totals = local.groupBy("__b_no", *groups).agg(agg("__b_val").alias("__b_tot"))
    earlier = Window.partitionBy(*groups).orderBy("__b_no")
    if fn == "last":  # a (bucket, group) in the table has rows, so the one before has the last row
        carry = F.lag("__b_tot").over(earlier)
    else:
        carry = agg("__b_tot").over(earlier.rowsBetween(Window.unboundedPreceding, -1))
    totals = totals.withColumn("__b_carry", carry).drop("__b_tot")
    if kinds <= BROADCAST_ROW_LIMIT // 2:
        totals = F.broadcast(totals)
    out = null_safe_join(local, totals, ["__b_no", *groups])
    c, own = F.col("__b_carry"), F.col("__b_local")
    if fn == "last":
        res = F.when(F.col("__b_first"), c).otherwise(own)
    else:
        res = F.when(c.isNull(), own).when(own.isNull(), c).otherwise(_COMBINE[fn](c, own))
    return out.withColumn(out_col, res).drop("__b_val", "__b_no", "__b_local", "__b_first", "__b_carry")


def last_n(
    df: DataFrame,
    group_cols,
    pos_col: str,
    value: Column | str,
    n: int,
    out_col: str,
    block: int = DEFAULT_BLOCK,
    by_number: bool = False,
) -> DataFrame:
    """``out_col`` = array of ``value`` over the last ``n`` rows (oldest first), current
    row included.  ``pos_col`` must be a contiguous 0-based position per group.  With
    ``by_number`` it numbers the rows that have a value; a row without one has the number of
    the last value before it (-1 if there is none), and the frame is the last ``n`` values."""
    if n < 1 or block < n:
        raise ValueError("need 1 <= n <= block")
    groups = list(group_cols)
    val = F.col(value) if isinstance(value, str) else value
    base = df.withColumn("__w_val", val).withColumn("__w_blk", F.floor(F.col(pos_col) / block))
    halo = (
        base.filter((F.col(pos_col) % block >= block - (n - 1)) & (F.col("__w_val").isNotNull() | F.lit(not by_number)))
        .select(*groups, pos_col, "__w_val", (F.col("__w_blk") + 1).alias("__w_blk"))
        .withColumn("__w_halo", F.lit(True))
    )
    own = base.withColumn("__w_halo", F.lit(False))
    both = own.unionByName(halo, allowMissingColumns=True)
    w = Window.partitionBy(*groups, "__w_blk").orderBy(pos_col)
    w = w.rangeBetween(-(n - 1), 0) if by_number else w.rowsBetween(-(n - 1), 0)
    out = both.withColumn(out_col, F.collect_list("__w_val").over(w))
    return out.filter(~F.col("__w_halo")).drop("__w_val", "__w_blk", "__w_halo")


_AGG = {"min": F.min, "max": F.max, "sum": F.sum, "count": F.count}
_CARRY = {"min": F.min, "max": F.max, "sum": F.sum, "count": F.sum}
_COMBINE = {"min": F.least, "max": F.greatest, "sum": lambda a, b: a + b, "count": lambda a, b: a + b}


def running(
    df: DataFrame,
    group_cols,
    pos_col: str,
    value: Column | str,
    fn: str,
    out_col: str,
    exclusive: bool = False,
    block: int = DEFAULT_BLOCK,
) -> DataFrame:
    """Prefix aggregate of ``value`` in position order per group.  ``exclusive`` leaves
    the current row out (null for the first row of a group)."""
    groups = list(group_cols)
    agg = _AGG[fn]
    comb = _COMBINE[fn]
    val = F.col(value) if isinstance(value, str) else value
    base = df.withColumn("__r_val", val).withColumn("__r_blk", F.floor(F.col(pos_col) / block))
    totals = base.groupBy(*groups, "__r_blk").agg(agg("__r_val").alias("__r_tot"))
    prev_w = Window.partitionBy(*groups).orderBy("__r_blk").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.withColumn("__r_carry", _CARRY[fn]("__r_tot").over(prev_w)).drop("__r_tot")
    upper = -1 if exclusive else 0
    in_w = Window.partitionBy(*groups, "__r_blk").orderBy(pos_col).rowsBetween(Window.unboundedPreceding, upper)
    local = base.withColumn("__r_local", agg("__r_val").over(in_w))
    j = null_safe_join(local, carry, [*groups, "__r_blk"], "left")
    c, l = F.col("__r_carry"), F.col("__r_local")
    res = F.when(c.isNull(), l).when(l.isNull(), c).otherwise(comb(c, l))
    return j.withColumn(out_col, res).drop("__r_val", "__r_blk", "__r_carry", "__r_local")

"""Training-log analytics: best-so-far / early stop, non-finite guard, down-sampling,
throughput, log tails.

Sequence rules per run look at what stands before a row (``windows.before``): one exchange of
the rows, also when a run holds most of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.operators.ordinals import null_safe_join
from corpusmill.operators.topk import top_k_per_group
from corpusmill.operators.windows import before


def best_so_far(df: DataFrame, run_cols, step_col: str, metric_col: str, stop_threshold: float | None = None) -> DataFrame:
    """``best`` = running minimum, from infinity; ``is_new_best`` when the value is below every
    earlier one, which a null, NaN or infinite value never is; ``after_stop`` for rows after
    the first value <= threshold (threshold > 0)."""
    runs = list(run_cols)
    infinity = F.lit(float("inf"))
    value = F.col(metric_col).cast("double")
    value = F.when(value.isNull() | F.isnan(value), infinity).otherwise(value)
    out = before(df, runs, step_col, value, "min", "__prev")
    prev = F.coalesce("__prev", infinity)
    out = out.withColumn("is_new_best", value < prev).withColumn("best", F.least(value, prev)).drop("__prev")
    if stop_threshold and stop_threshold > 0:
        stops = df.filter(F.col(metric_col) <= stop_threshold).groupBy(*runs).agg(F.min(step_col).alias("__stop"))
        out = null_safe_join(out, stops, runs, "left").withColumn(
            "after_stop", F.coalesce(F.col(step_col) > F.col("__stop"), F.lit(False))
        ).drop("__stop")
    return out


def nonfinite_guard(df: DataFrame, run_cols, step_col: str, bad_col: str) -> DataFrame:
    """One bad step is skipped, a second consecutive bad step aborts the run; rows after
    the abort are ``halted``.  A null flag is no bad step."""
    runs = list(run_cols)
    bad = F.coalesce(F.col(bad_col), F.lit(False))
    paired = before(df, runs, step_col, bad, "last", "__prev_bad")
    act = F.when(~bad, "ok").when(F.col("__prev_bad"), "abort").otherwise("skip")
    acted = paired.withColumn("__act", act)
    aborts = acted.filter(F.col("__act") == "abort").groupBy(*runs).agg(F.min(step_col).alias("__abort"))
    out = null_safe_join(acted, aborts, runs, "left")
    action = F.when(F.col(step_col) > F.col("__abort"), F.lit("halted")).otherwise(F.col("__act"))
    return out.withColumn("action", action).drop("__prev_bad", "__act", "__abort")


def sample_steps(df: DataFrame, step_col: str, every: int) -> DataFrame:
    """Keep step 1 and every ``every``-th step."""
    s = F.col(step_col)
    return df.filter((s == 1) | (s % F.lit(every) == 0))


def throughput(df: DataFrame, run_cols, tokens_col: str, examples_col: str, seconds_col: str) -> DataFrame:
    secs = F.sum(seconds_col)
    return df.groupBy(*run_cols).agg(
        (F.sum(tokens_col) / secs).alias("tokens_per_sec"), (F.sum(examples_col) / secs).alias("examples_per_sec")
    )


def tail(df: DataFrame, file_cols, line_col: str, n: int) -> DataFrame:
    """Last ``n`` lines of each log (rank 1 = last line)."""
    return top_k_per_group(df, file_cols, [line_col], n, rank_col="rank_from_end", descending=True)

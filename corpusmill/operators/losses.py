"""Distillation metrics over stored score matrices, as array expressions.

A matrix is ``array<array<double>>`` (rows = positions, columns = vocabulary).  All
per-sample math (softmax, log-softmax, KL, squared error, cross entropy) runs in
higher-order functions inside the JVM; batch reductions are ordinary aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(col):
    return F.col(col) if isinstance(col, str) else col


def as_matrix(flat: Column | str, rows: int, cols: int) -> Column:
    """Row-major ``rows x cols`` matrix of doubles from a flat array."""
    f = _c(flat)
    return F.transform(
        F.sequence(F.lit(0), F.lit(rows - 1)),
        lambda r: F.transform(F.slice(f, r * cols + 1, cols), lambda x: x.cast("double")),
    )


def _sum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda a, x: a + x)


def logsumexp(row: Column) -> Column:
    m = F.array_max(row)
    return m + F.log(_sum(F.transform(row, lambda x: F.exp(x - m))))


def log_softmax(row: Column) -> Column:
    lse = logsumexp(row)
    return F.transform(row, lambda x: x - lse)


def kl_rows(student: Column, teacher: Column, temperature: float) -> Column:
    """Sum over positions and vocabulary of p_t * (log p_t - log q_s), scores / T."""
    t = float(temperature)

    def per_row(s_row, t_row):
        ls = log_softmax(F.transform(s_row, lambda x: x / t))
        lt = log_softmax(F.transform(t_row, lambda x: x / t))
        return _sum(F.zip_with(lt, ls, lambda a, b: F.exp(a) * (a - b)))

    return _sum(F.zip_with(_c(student), _c(teacher), per_row))


def kd_loss(df: DataFrame, batch_cols, student: str, teacher: str, temperature: float) -> DataFrame:
    """KL(teacher || student) at temperature T, summed, divided by the number of
    samples in the batch (not tokens), times T^2."""
    per = df.withColumn("__kl", kl_rows(F.col(student), F.col(teacher), temperature))
    return per.groupBy(*batch_cols).agg(
        (F.sum("__kl") / F.count(F.lit(1)) * F.lit(float(temperature) ** 2)).alias("kd_loss")
    )


def squared_error(student: Column, reference: Column) -> tuple[Column, Column]:
    """(sum of squared differences, number of elements) of two matrices."""
    se = _sum(F.zip_with(student, reference, lambda a, b: _sum(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)))))
    n = F.aggregate(student, F.lit(0), lambda acc, r: acc + F.size(r))
    return se, n


def logit_mse(df: DataFrame, batch_cols, student: str, reference: str | None) -> DataFrame:
    """Mean squared error to a reference matrix; 0 when there is no reference."""
    if reference is None:
        return df.groupBy(*batch_cols).agg(F.lit(0.0).alias("logit_mse"))
    se, n = squared_error(F.col(student), F.col(reference))
    per = df.withColumn("__se", se).withColumn("__n", n)
    return per.groupBy(*batch_cols).agg((F.sum("__se") / F.sum("__n")).alias("logit_mse"))


def cross_entropy_rows(logits: Column, targets: Column) -> tuple[Column, Column]:
    """(sum over positions of logsumexp(row) - row[target], number of positions)."""
    ce = _sum(
        F.zip_with(_c(logits), _c(targets), lambda row, tgt: logsumexp(row) - F.element_at(row, (tgt + 1).cast("int")))
    )
    return ce, F.size(_c(logits))


def perplexity(df: DataFrame, batch_col: str, logits: str, targets: str, max_batches: int | None = None) -> DataFrame:
    """exp(mean over batches of the batch-mean token cross entropy); padding is not
    masked; +inf when there is no batch.  ``max_batches`` keeps the first batches."""
    if max_batches:
        df = df.filter(F.col(batch_col) < max_batches)
    ce, n = cross_entropy_rows(F.col(logits), F.col(targets))
    per = df.withColumn("__ce", ce).withColumn("__n", n)
    batch = per.groupBy(batch_col).agg((F.sum("__ce") / F.sum("__n")).alias("batch_ce"))
    return batch.agg(
        F.count(F.lit(1)).cast("bigint").alias("n_batches"),
        F.avg("batch_ce").alias("mean_ce"),
        F.coalesce(F.exp(F.avg("batch_ce")), F.lit(float("inf"))).alias("perplexity"),
    )


def weighted_total(kd: Column, ce: Column, l2: Column, alpha: float, beta: float, gamma: float) -> Column:
    return F.lit(alpha) * kd + F.lit(beta) * ce + F.lit(gamma) * l2


def fit_matrix(m: Column, rows: int, cols: int) -> Column:
    """Right-pad with zero rows/columns or truncate to ``rows x cols``."""
    zero_row = F.array_repeat(F.lit(0.0), cols)
    fitted_cols = F.transform(m, lambda r: F.slice(F.concat(r, F.array_repeat(F.lit(0.0), cols)), 1, cols))
    return F.slice(F.concat(fitted_cols, F.array_repeat(zero_row, rows)), 1, rows)


def center_fit(m: Column, rows: int, vocab: int) -> Column:
    """Centre crop (start = delta // 2) or centre pad (before = diff // 2, rest after)
    along positions; null when the vocabulary size differs."""
    n = F.size(m)
    width = F.size(F.element_at(m, 1))
    delta = n - F.lit(rows)
    cropped = F.slice(m, F.floor(delta / 2).cast("int") + 1, rows)
    diff = F.lit(rows) - n
    before = F.floor(diff / 2).cast("int")
    zero_row = F.array_repeat(F.lit(0.0), width)
    padded = F.concat(F.array_repeat(zero_row, before), m, F.array_repeat(zero_row, diff - before))
    fitted = F.when(n > rows, cropped).when(n < rows, padded).otherwise(m)
    return F.when(width == F.lit(vocab), fitted)


def squeeze_3d(t: Column) -> Column:
    """[1, T, V] -> [T, V]; other [B, T, V] -> [B*T, V]."""
    return F.when(F.size(t) == 1, F.element_at(t, 1)).otherwise(F.flatten(t))


def fit_teacher_3d(t: Column, rows: int, vocab: int) -> Column:
    """Stored 3-D scores to ``rows x vocab``: squeezed or flattened, then centre-fitted."""
    return center_fit(squeeze_3d(t), rows, vocab)


def is_matrix(m: Column) -> Column:
    """2-D check: non-empty and every row as long as the first."""
    first = F.size(F.element_at(m, 1))
    return (F.size(m) > 0) & F.forall(m, lambda r: F.size(r) == first)


def matrix_stats(m: Column) -> tuple[Column, Column]:
    """(number of cells, sum of cells)."""
    cells = F.aggregate(m, F.lit(0), lambda a, r: a + F.size(r))
    total = _sum(F.transform(m, lambda r: _sum(r)))
    return cells, total

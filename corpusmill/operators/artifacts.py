"""Teacher-score artifacts: lookup, coverage, pending work, routing, skip policy.

Artifacts live in one table ``(sample_id, family, format, valid, ...)`` instead of one
file per sample; every existence probe of the original becomes a join:
lookup = left join, pending = left anti join, all-or-none = a per-request ``bool_and``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# --- fixed values --------------------------------------------------------------------
FORMAT_PRECEDENCE = (".pt", ".npy")  # first existing format wins
STATUS_OK, STATUS_CACHED, STATUS_MISSING, STATUS_INVALID, STATUS_DISABLED = (
    "ok",
    "cached",
    "missing",
    "invalid",
    "disabled",
)
COVERAGE_WARN_RATIO = 0.10
# -------------------------------------------------------------------------------------


def preferred_artifacts(artifacts: DataFrame, key_cols, format_col: str = "format") -> DataFrame:
    """One artifact per key: the first format in precedence order (map-side combined)."""
    rank = F.array_position(F.array(*[F.lit(f) for f in FORMAT_PRECEDENCE]), F.col(format_col))
    others = [c for c in artifacts.columns if c not in key_cols]
    best = artifacts.withColumn("__rank", rank).filter(F.col("__rank") > 0).groupBy(*key_cols).agg(
        F.min_by(F.struct(*others), F.col("__rank")).alias("__a")
    )
    return best.select(*key_cols, "__a.*")


def lookup(
    samples: DataFrame,
    artifacts: DataFrame,
    key_cols=("sample_id", "family"),
    family_col: str = "family",
    valid_col: str = "valid",
    payload_cols=(),
) -> DataFrame:
    """Left join each sample to its artifact; ``status`` is disabled (no artifact family
    for this row), missing, invalid (bad shape) or ok.  Payload of invalid artifacts is
    nulled."""
    keys = list(key_cols)
    best = preferred_artifacts(artifacts, keys).withColumn("__found", F.lit(True))
    j = samples.join(best.select(*keys, "__found", valid_col, *payload_cols), keys, "left")
    status = (
        F.when(F.col(family_col).isNull(), F.lit(STATUS_DISABLED))
        .when(F.col("__found").isNull(), F.lit(STATUS_MISSING))
        .when(~F.col(valid_col), F.lit(STATUS_INVALID))
        .otherwise(F.lit(STATUS_OK))
    )
    out = j.withColumn("status", status)
    for p in payload_cols:
        out = out.withColumn(p, F.when(F.col("status") == STATUS_OK, F.col(p)))
    return out.drop("__found", valid_col)


def coverage(looked_up: DataFrame, group_cols=()) -> DataFrame:
    """Looked-up rows, missing-or-invalid rows, their ratio and the >10 % warning."""
    looked = F.col("status") != STATUS_DISABLED
    bad = F.col("status").isin(STATUS_MISSING, STATUS_INVALID)
    agg = looked_up.groupBy(*group_cols).agg(
        F.count_if(looked).cast("bigint").alias("total"), F.count_if(bad).cast("bigint").alias("missing")
    )
    ratio = F.when(F.col("total") > 0, F.col("missing") / F.col("total")).otherwise(F.lit(0.0))
    return agg.withColumn("missing_ratio", ratio).withColumn("warn", F.col("missing_ratio") > COVERAGE_WARN_RATIO)


def all_or_none(looked_up: DataFrame, request_cols, payload_col: str) -> DataFrame:
    """A request returns its payloads only if every id in it was found."""
    w = Window.partitionBy(*request_cols)
    complete = F.bool_and(F.col("status") == STATUS_OK).over(w)
    return looked_up.withColumn("request_complete", complete).withColumn(
        payload_col, F.when(F.col("request_complete"), F.col(payload_col))
    )


def pending(samples: DataFrame, artifacts: DataFrame, key_cols=("sample_id", "family"), overwrite: bool = False) -> DataFrame:
    """Rows still to be scored: no artifact of any format exists (unless overwrite)."""
    if overwrite:
        return samples
    keys = list(key_cols)
    return samples.join(artifacts.select(*keys).distinct(), keys, "left_anti")


def pending_counters(samples: DataFrame, artifacts: DataFrame, key_cols=("sample_id", "family"), overwrite: bool = False) -> DataFrame:
    """processed (= pending) and skipped (= already present) counts."""
    keys = list(key_cols)
    if overwrite:
        flagged = samples.withColumn("__exists", F.lit(False))
    else:
        ex = artifacts.select(*keys).distinct().withColumn("__exists", F.lit(True))
        flagged = samples.join(ex, keys, "left").withColumn("__exists", F.coalesce("__exists", F.lit(False)))
    return flagged.agg(
        F.count_if(~F.col("__exists")).cast("bigint").alias("processed"),
        F.count_if(F.col("__exists")).cast("bigint").alias("skipped"),
    )


def skip_policy(looked_up: DataFrame, batch_cols, type_col: str, strict: bool, payload_col: str) -> DataFrame:
    """Strict: a missing math/code artifact removes teacher scores from the whole batch.
    Lenient: only the row itself lacks scores (already the case after lookup)."""
    if not strict:
        return looked_up.withColumn("skip_kd", F.lit(False))
    flag = (F.col("status") == STATUS_MISSING) & F.col(type_col).isin("math_tool", "code")
    flag = F.coalesce(flag, F.lit(False))
    out = looked_up.withColumn("skip_kd", F.bool_or(flag).over(Window.partitionBy(*batch_cols)))
    return out.withColumn(payload_col, F.when(~F.col("skip_kd"), F.col(payload_col)))


def skip_policies(looked_up: DataFrame, batch_cols, type_col: str, payload_col: str) -> DataFrame:
    """Both policies of every row (``mode``: strict, lenient) from one look-up and one window
    over the batches."""
    whole = looked_up.withColumn("__payload", F.col(payload_col))
    strict = skip_policy(whole, batch_cols, type_col, True, payload_col)
    modes = F.array(
        F.struct(F.lit("strict").alias("mode"), F.col("skip_kd").alias("skip"), F.col(payload_col).alias("payload")),
        F.struct(F.lit("lenient").alias("mode"), F.lit(False).alias("skip"), F.col("__payload").alias("payload")),
    )
    out = strict.withColumn("__m", F.explode(modes))
    out = out.withColumns({"mode": F.col("__m.mode"), "skip_kd": F.col("__m.skip"), payload_col: F.col("__m.payload")})
    return out.drop("__m", "__payload")


def route_scores(looked_up: DataFrame, type_col: str, precomputed_col: str, scorer, skip_col: str | None = None) -> DataFrame:
    """Precomputed scores first; rows of type lm without one go to ``scorer``
    (DataFrame -> DataFrame adding ``online_score``); everything else gets none.
    Only the rows that need it are sent to the scorer."""
    need = F.col(precomputed_col).isNull() & (F.col(type_col) == "lm")
    if skip_col:
        need = need & ~F.col(skip_col)
    flagged = looked_up.withColumn("__need", need)
    to_score = scorer(flagged.filter("__need"))
    rest = flagged.filter(~F.col("__need")).withColumn("online_score", F.lit(None).cast("double"))
    both = to_score.unionByName(rest)
    src = (
        F.when(F.col(precomputed_col).isNotNull(), F.lit("precomputed"))
        .when(F.col("online_score").isNotNull(), F.lit("online"))
        .otherwise(F.lit("none"))
    )
    return both.withColumn("score_source", src).withColumn(
        "teacher_score", F.coalesce(F.col(precomputed_col), F.col("online_score"))
    ).drop("__need")


def first_issue_per_key(issues: DataFrame, key_cols, order_col: str, payload_cols) -> DataFrame:
    """Warn-once: the first issue row per key (partial aggregation, skew-safe)."""
    return issues.groupBy(*key_cols).agg(
        F.min_by(F.struct(order_col, *payload_cols), F.col(order_col)).alias("__f"),
        F.count(F.lit(1)).cast("bigint").alias("occurrences"),
    ).select(*key_cols, "__f.*", "occurrences")

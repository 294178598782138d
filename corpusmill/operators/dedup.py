"""Exact text deduplication and shard layout.

Keep-first dedup is one aggregate: ``min_by(row, ord)`` per text hash.  Partial
aggregation runs map-side, so a text copied a million times costs at most one row per
map task in the shuffle, and the input (with its expensive normalisation) is read
once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.ids import text_hash
from corpusmill.operators.ordinals import with_ordinal

# --- fixed values --------------------------------------------------------------------
DEFAULT_MAX_RECORDS = 20000  # rows per output shard
SHARD_NAME_FORMAT = "part-%05d.jsonl"
# -------------------------------------------------------------------------------------


def with_text_hash(df: DataFrame, text_col: str = "text", name: str = "text_sha1") -> DataFrame:
    return df.withColumn(name, text_hash(text_col))


def dedup_keep_first(df: DataFrame, key_col: str, order_col: str, scope_cols=()) -> DataFrame:
    """Keep the first row (smallest ``order_col``) of each ``key_col`` within ``scope_cols``.

    ``order_col`` must be unique within a scope (an ordinal)."""
    scope = list(scope_cols)
    keys = [*scope, key_col]
    payload = [c for c in df.columns if c not in keys]
    firsts = df.groupBy(*keys).agg(F.min_by(F.struct(*payload), F.col(order_col)).alias("__first"))
    return firsts.select(*keys, "__first.*").select(*df.columns)


def assign_shards(
    df: DataFrame,
    order_col: str,
    scope_cols=(),
    max_records: int = DEFAULT_MAX_RECORDS,
    pos_col: str = "shard_pos",
    sample_from: DataFrame | None = None,
) -> DataFrame:
    """Number kept rows contiguously per scope and cut them into shards of ``max_records``."""
    out = with_ordinal(
        df, order_col, list(scope_cols), name=pos_col, sample_from=sample_from
    )
    return out.withColumn("shard", F.floor(F.col(pos_col) / F.lit(int(max_records))).cast("bigint")).withColumn(
        "shard_file", F.format_string(SHARD_NAME_FORMAT, F.col("shard"))
    )


def shard_summary(df: DataFrame, scope_cols=()) -> DataFrame:
    """Job summary per scope: records, shard count, first and last shard file."""
    return df.groupBy(*scope_cols).agg(
        F.count(F.lit(1)).cast("bigint").alias("records"),
        (F.max("shard") + F.lit(1)).cast("bigint").alias("shards"),
        F.format_string(SHARD_NAME_FORMAT, F.min("shard")).alias("first_shard"),
        F.format_string(SHARD_NAME_FORMAT, F.max("shard")).alias("last_shard"),
    )


def summary_from_counts(unique_keys: DataFrame, scope_cols=(), max_records: int = DEFAULT_MAX_RECORDS) -> DataFrame:
    """Job summary without numbering rows: shards are consecutive blocks of
    ``max_records`` kept rows, so records = count, shards = ceil(count / size).
    ``unique_keys`` holds one row per kept record (e.g. distinct (scope, text hash))."""
    n = F.count(F.lit(1))
    last = F.floor((n - F.lit(1)) / F.lit(int(max_records))).cast("bigint")
    return unique_keys.groupBy(*scope_cols).agg(
        n.cast("bigint").alias("records"),
        (last + F.lit(1)).alias("shards"),
        F.format_string(SHARD_NAME_FORMAT, F.lit(0)).alias("first_shard"),
        F.format_string(SHARD_NAME_FORMAT, last).alias("last_shard"),
    )

"""Sinks: shard layout, no-clobber writes, routed artifacts, append-only logs, run
snapshots, manifest lines.

Paths are wherever the caller points them (a shared filesystem or object store on a
cluster); nothing here assumes a machine-local folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from corpusmill.sinks.committed import write_files


def write_shards(df: DataFrame, out_dir: str, scope_cols=(), shard_col: str = "shard", order_col: str | None = None,
                 cols=("sample_id", "type", "text")) -> DataFrame:
    """Shard files ``<out_dir>/<scope>=<value>/.../part-%05d.jsonl``, each with that shard's
    records as JSON lines in order (non-ASCII text as is); returns ``(path, records)``.

    A shard has at most ``max_records`` rows, so the task that writes it is bounded.  Files are
    committed together (``sinks.committed``): tasks that fail, are retried or run twice leave
    nothing behind and readers never see half a shard."""
    keys = [*scope_cols, shard_col]
    base = out_dir.rstrip("/")
    folder = F.concat_ws("/", *[
        F.concat(F.lit(f"{c}="), F.coalesce(F.url_encode(F.col(c).cast("string")), F.lit("__HIVE_DEFAULT_PARTITION__"))) for c in scope_cols
    ])
    name = F.format_string("part-%05d.jsonl", F.col(shard_col))
    rows = df.repartition(*[F.col(k) for k in keys])
    rows = rows.sortWithinPartitions(*keys, *([order_col] if order_col else []))
    line = F.concat(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}), F.lit("\n")).cast("binary")
    file = F.concat_ws("/", folder, name) if scope_cols else name
    done = write_files(rows.select(file.alias("file"), line.alias("data")), base)
    return done.select(F.concat(F.lit(f"{base}/"), F.col("file")).alias("path"), F.col("rows").alias("records"))


def table_exists(spark: SparkSession, path: str, fmt: str = "parquet") -> bool:
    try:
        spark.read.format(fmt).load(path).limit(0).collect()
        return True
    except AnalysisException:
        return False


def write_no_clobber(df: DataFrame, path: str, key_cols, fmt: str = "parquet", partition_cols=()) -> None:
    """Append only rows whose key is not in the table yet (existing rows are left alone
    and count as done): a left-anti join against the table's keys, then append."""
    spark = df.sparkSession
    keys = list(key_cols)
    new = df
    if table_exists(spark, path, fmt):
        existing = spark.read.format(fmt).load(path).select(*keys).distinct()
        new = df.join(existing, keys, "left_anti")
    w = new.dropDuplicates(keys).write.mode("append").format(fmt)
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.save(path)


def write_routed_artifacts(df: DataFrame, path: str, family_col: str = "family") -> None:
    """Artifacts routed by family (math -> family=math/, code -> family=code/)."""
    df.write.mode("append").partitionBy(family_col).parquet(path)


def append_log(df: DataFrame, path: str) -> None:
    """Append-only metrics log (JSON lines); earlier runs' rows are never rewritten."""
    df.write.mode("append").json(path)


def write_snapshot(frames: dict[str, DataFrame], base: str, run_id: str) -> None:
    """Provenance snapshot of a run: each small frame under ``<base>/<name>/run_id=<id>``."""
    for name, frame in frames.items():
        frame.withColumn("run_id", F.lit(run_id)).write.mode("append").partitionBy("run_id").json(f"{base}/{name}")


def write_manifest_lines(lines: DataFrame, path: str) -> None:
    """Manifest lines (one compact JSON object per line) as text files."""
    lines.select("value").write.mode("overwrite").text(path)


def list_shard_files(spark: SparkSession, base: str) -> DataFrame:
    """Shard files under ``base`` in name order (names are zero-padded, so name order is
    shard order): ``(path, name_rank)``, ranks from 0."""
    from corpusmill.operators.ordinals import with_ordinal
    from corpusmill.sources.files import list_folder_files

    files = list_folder_files(spark, f"{base.rstrip('/')}/*=*", "part-*.jsonl").select("path")
    return with_ordinal(files, "path", name="name_rank")

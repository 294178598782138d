"""Record sources: JSONL (plain / gzip), parquet, format dispatch, provenance, listings.

Every read has an explicit schema (no inference at scale).  Bad JSON lines land in a
corrupt-record column (PERMISSIVE) instead of failing the job; unreadable files fail it
unless asked otherwise, and ``file_faults`` reports them.  gzip is not splittable: one task per file, so a
``repartition`` after the scan restores parallelism for the work downstream.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.sources.splits import SPLIT_BYTES, expand_paths, number_lines, paths_table, plan_splits, read_splits

CORRUPT_COL = "_corrupt_record"
TEXT_COLUMNS = ("text", "content")  # first present one is the text column (fixed order)

RECORD_SCHEMA = T.StructType(
    [
        T.StructField("text", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("sample_id", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("sha", T.StringType()),
    ]
)


def _with_corrupt(schema: T.StructType) -> T.StructType:
    if CORRUPT_COL in schema.fieldNames():
        return schema
    return T.StructType(list(schema.fields) + [T.StructField(CORRUPT_COL, T.StringType())])


def _is_string(value: Column) -> Column:
    return F.schema_of_variant(value) == "STRING"


def read_jsonl(
    spark: SparkSession,
    paths: Sequence[str] | str,
    schema: T.StructType = RECORD_SCHEMA,
    keep_corrupt: bool = False,
    skip_corrupt_files: bool = False,
) -> DataFrame:
    """JSON Lines (``.gz`` decompressed transparently), one object per non-blank line.

    Malformed lines are dropped unless ``keep_corrupt`` (then ``_corrupt_record`` holds
    the raw line).  A ``text`` or ``content`` that is not a JSON string is null.  A file
    that cannot be read to its end fails the job; ``skip_corrupt_files`` keeps what could
    be read instead - run ``file_faults`` on the same files to know which those are.
    Adds ``file_path`` (``_metadata.file_path``)."""
    lines = spark.read.option("ignoreCorruptFiles", str(skip_corrupt_files).lower()).text(paths)
    lines = lines.select("value", F.col("_metadata.file_path").alias("file_path")).filter(F.trim("value") != "")
    fields = [T.StructField(f.name, T.VariantType() if f.name in TEXT_COLUMNS else f.dataType) for f in schema.fields]
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COL}
    parsed = lines.withColumn("rec", F.from_json("value", _with_corrupt(T.StructType(fields)), options))

    def column(name: str) -> Column:
        value = F.col(f"rec.`{name}`")
        if name not in TEXT_COLUMNS:
            return value.alias(name)
        return F.when(_is_string(value), F.try_variant_get(value, "$", "string")).alias(name)

    corrupt = F.when(F.col("rec").isNull(), F.col("value")).otherwise(F.col(f"rec.{CORRUPT_COL}"))
    out = parsed.select(*[column(f.name) for f in schema.fields if f.name != CORRUPT_COL], corrupt.alias(CORRUPT_COL), "file_path")
    return out if keep_corrupt else out.filter(F.col(CORRUPT_COL).isNull()).drop(CORRUPT_COL)


def file_faults(spark: SparkSession, paths: Sequence[str] | str, schema: T.StructType = RECORD_SCHEMA) -> DataFrame:
    """Fault report, one row per file: ``rows`` and ``bad_lines`` of a JSON Lines file that
    reads to its end, else ``error`` (rows and bad lines are then null).  Files are read in
    ranges, so a large compressed file is many tasks here too."""
    plan = plan_splits(expand_paths(paths_table(spark, paths)))
    read = read_splits(plan.drop("pattern"), keep_faults=True)
    rec = parse_lines(read, schema)
    line, bad = F.col("line").isNotNull(), F.col(f"rec.{CORRUPT_COL}").isNotNull() | F.col("rec").isNull()
    # a file without a line has its row from the plan
    counts = rec.groupBy("file").agg(
        F.count_if(line & ~bad).alias("rows"), F.count_if(line & bad).alias("bad_lines"), F.max("error").alias("error")
    )
    j = plan.select("file").distinct().join(counts, "file", "left")
    number = lambda c: F.when(F.col("error").isNull(), F.coalesce(F.col(c), F.lit(0)))
    return j.select(F.col("file").alias("file_path"), number("rows").alias("rows"), number("bad_lines").alias("bad_lines"), "error")


def parse_lines(lines: DataFrame, schema: T.StructType, line_col: str = "line") -> DataFrame:
    """``rec``: the line parsed with ``schema``, a raw bad line in its corrupt-record field."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COL}
    return lines.withColumn("rec", F.from_json(line_col, _with_corrupt(schema), options))


def read_manifest(
    entries: DataFrame, schema: T.StructType = RECORD_SCHEMA, pattern_col: str = "pattern", split_bytes: int = SPLIT_BYTES
) -> DataFrame:
    """Manifest entries -> their files -> their records, in one branch of tasks: the columns of
    ``entries`` beside those of ``schema`` and ``file_path``.  JSON Lines (gzip too) and parquet
    files by suffix; malformed lines are left out; a text is the first of ``TEXT_COLUMNS`` that
    the record has and null if that is not a string; ``path`` falls back to the file."""
    plan = plan_splits(expand_paths(entries, pattern_col), split_bytes)
    names = list(dict.fromkeys([*schema.fieldNames(), *TEXT_COLUMNS]))
    kinds = {f.name: f.dataType for f in schema.fields}
    read = read_splits(plan, ", ".join(f"`{n}` {kinds.get(n, T.StringType()).simpleString()}" for n in names if n not in entries.columns))
    fields = [T.StructField(n, T.VariantType() if n in TEXT_COLUMNS else kinds[n]) for n in names]
    rec = parse_lines(read, T.StructType(fields))
    rec = rec.filter(F.col("line").isNull() | (F.col("rec").isNotNull() & F.col(f"rec.{CORRUPT_COL}").isNull()))

    def value(name: str) -> Column:
        found = F.col(f"rec.`{name}`")
        if name in TEXT_COLUMNS:
            found = F.when(_is_string(found), F.try_variant_get(found, "$", "string"))
        return F.when(F.col("line").isNotNull(), found).otherwise(F.col(name))

    columns = {n: value(n) for n in schema.fieldNames()}
    if "text" in columns:
        columns["text"] = F.coalesce(*[value(n) for n in TEXT_COLUMNS])
    if "path" in columns:
        columns["path"] = F.coalesce(value("path"), F.col("file"))
    return rec.select(*entries.columns, *[c.alias(n) for n, c in columns.items()], F.col("file").alias("file_path"))


def detect_text_column(df: DataFrame) -> str:
    """First of ``text``, ``content`` present in the schema; error otherwise."""
    for c in TEXT_COLUMNS:
        if c in df.columns:
            return c
    raise ValueError("No text/content column found")


def read_parquet_text(spark: SparkSession, paths: Sequence[str] | str, extra_cols: Sequence[str] = ()) -> DataFrame:
    """Parquet corpus: the text column as ``text`` (only the needed columns are decoded),
    plus ``file_path``.  Files may name it differently: each row takes the first of
    ``TEXT_COLUMNS`` that its file has."""
    df = spark.read.option("mergeSchema", "true").parquet(*([paths] if isinstance(paths, str) else paths))
    detect_text_column(df)
    text = F.coalesce(*[F.col(c).cast("string") for c in TEXT_COLUMNS if c in df.columns])
    return df.select(text.alias("text"), *extra_cols, F.col("_metadata.file_path").alias("file_path"))


def suffix_of(path: str) -> str:
    """Lower-cased last suffix (``.gz``, ``.parquet``, ``.jsonl``, ...)."""
    name = path.rstrip("/").rsplit("/", 1)[-1]
    return ("." + name.rsplit(".", 1)[-1]).lower() if "." in name else ""


def read_records(spark: SparkSession, paths: Sequence[str], schema: T.StructType = RECORD_SCHEMA) -> DataFrame:
    """Format dispatch by suffix: ``.parquet`` -> parquet, everything else (incl. ``.gz``)
    -> JSON Lines; the columns of ``schema`` that the files have, union by name.  Adds
    ``path`` = record path or file path."""
    parquet = [p for p in paths if suffix_of(p) == ".parquet"]
    jsonl = [p for p in paths if suffix_of(p) != ".parquet"]
    parts = []
    if jsonl:
        parts.append(read_jsonl(spark, jsonl, schema))
    if parquet:
        there = spark.read.option("mergeSchema", "true").parquet(*parquet).columns
        extra = [f.name for f in schema.fields if f.name in there and f.name not in TEXT_COLUMNS]
        parts.append(read_parquet_text(spark, parquet, extra))
    if not parts:
        raise ValueError("no input paths")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return with_provenance(out)


def with_provenance(df: DataFrame, path_col: str = "path", file_col: str = "file_path") -> DataFrame:
    """The record's own ``path`` wins; otherwise the file it was read from."""
    if path_col in df.columns:
        return df.withColumn(path_col, F.coalesce(F.col(path_col), F.col(file_col)))
    return df.withColumn(path_col, F.col(file_col))


def list_files(spark: SparkSession, pattern: str, recursive: bool = False) -> DataFrame:
    """File listing as a table ``(path, length, modificationTime)``; contents are not read
    because the ``content`` column is pruned.  A pattern matching nothing yields no rows
    (use ``expand_or_keep`` for the keep-the-pattern rule)."""
    return _listed(spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()), pattern)


def list_folder_files(spark: SparkSession, folders: str, names: str) -> DataFrame:
    """``list_files`` of the files ``names`` right in or below the folders that match
    ``folders``: each folder is listed once, so that the driver globs folders, not files."""
    return _listed(spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", names), folders)


def _listed(reader, pattern: str) -> DataFrame:
    spark = reader._spark
    try:
        df = reader.load(pattern)
    except AnalysisException as failure:
        if failure.getCondition() != "PATH_NOT_FOUND":
            raise  # no permission, a broken path: not the same as no files
        schema = "path string, length bigint, modificationTime timestamp"
        return spark.createDataFrame([], schema)
    return df.select("path", "length", "modificationTime")


def expand_or_keep(patterns: DataFrame, pattern_col: str = "pattern") -> DataFrame:
    """Each pattern -> its matching files, or the pattern itself when nothing matches; listed
    in tasks, so the table may be of any size."""
    return expand_paths(patterns, pattern_col).drop("size")


def union_inputs(frames: Sequence[DataFrame]) -> DataFrame:
    """Union several inputs in listed order, tagging ``input_ord``."""
    out = None
    for i, f in enumerate(frames):
        f = f.withColumn("input_ord", F.lit(i))
        out = f if out is None else out.unionByName(f, allowMissingColumns=True)
    return out


def truncate_after_first_bad(lines: DataFrame, file_col: str, line_col: str | Sequence[str], bad_col: str) -> DataFrame:
    """Drop every line at or after the first bad line of its file (strict shard rule).  The
    order is that of one column or of several (a shard of many files: file, then line)."""
    order = F.col(line_col) if isinstance(line_col, str) else F.struct(*line_col)
    first_bad = lines.filter(F.col(bad_col)).groupBy(file_col).agg(F.min(order).alias("__first_bad"))
    j = lines.join(first_bad, file_col, "left")  # a row per file with a fault
    return j.filter(F.col("__first_bad").isNull() | (order < F.col("__first_bad"))).drop("__first_bad")


def read_json_lines_numbered(
    spark: SparkSession, paths, schema: T.StructType, split_bytes: int = SPLIT_BYTES
) -> DataFrame:
    """Non-blank lines with file and 0-based line number, parsed with ``schema``; ``bad`` marks
    lines that are not valid records.  Lines are counted per range in one pass, a range's first
    number is the sum over the ranges before it."""
    plan = number_lines(plan_splits(expand_paths(paths_table(spark, paths)), split_bytes))
    lines = read_splits(plan.drop("pattern")).select("line", F.col("file").alias("file_path"), "line_no")
    parsed = parse_lines(lines, schema)
    return parsed.withColumn("bad", F.col(f"rec.{CORRUPT_COL}").isNotNull() | F.col("rec").isNull())


def ensure_parallelism(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin repartition when a scan yields fewer partitions than the cluster can
    run (a non-splittable file: gzip, or one parquet row group).  Large inputs already
    have many splits and pass through unchanged, so no shuffle is added at scale."""
    spark = df.sparkSession
    target = min_partitions or 2 * spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target)

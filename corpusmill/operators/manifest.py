"""Mixture manifests, dataset configs, path matching and readiness.

Manifests and configs are small tables (one row per corpus); file listings and record
tables are large.  Joins between them are equi-joins: path -> dataset matching explodes
each path's ``/``-prefixes (bounded by path depth) and joins them to the roots, instead
of a theta join between all paths and all roots.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.functions.text import py_strip
from corpusmill.operators.ordinals import small_group_count
from corpusmill.operators.topk import top_k_per_group

# --- fixed values --------------------------------------------------------------------
DEFAULT_TYPE = "lm"
DEFAULT_WEIGHT = 1.0
COUNT_FIELDS = ("count", "num_records", "records")
SAMPLE_TYPES = ("lm", "math_tool", "code")
MATH_ALIASES = ("math_tool", "math", "mathreasoning", "math_reasoning")
CODE_ALIASES = ("code", "code_tool", "coding", "programming")
CODE_HINTS = ("code", "codesearchnet", "humaneval", "mbpp", "leetcode", "github", "programming", "coding")
MATH_HINTS = ("gsm8k", "asdiv", "svamp", "mawps", "aqua", "mathqa", "math", "arithmetic")
# Raw types accepted by the scoring job, and their normal form.
SCORABLE_TYPES = {"math": "math_tool", "math_tool": "math_tool", "code": "code"}
# Normal type -> artifact family (output folder).
TYPE_FAMILY = {"math_tool": "math", "code": "code"}
CONFIG_ROOT_FIELDS = ("manifest", "inp", "in", "out", "root", "roots")
MODES = ("auto", "force", "skip")
# -------------------------------------------------------------------------------------

MANIFEST_JSON_SCHEMA = "path string, type string, weight double"


def _c(col):
    return F.col(col) if isinstance(col, str) else col


# ---------------------------------------------------------------- manifest records


def parse_manifest_lines(
    lines: DataFrame, line_col: str = "value", ord_col: str | None = None, strict: bool = False
) -> DataFrame:
    """JSONL manifest lines -> entries with defaults.

    ``path`` is required: a line that is not JSON or has none is flagged ``bad_entry``, or
    fails the job if ``strict``; ``manifest_faults`` lists such lines.  ``type`` defaults to ``lm``, ``weight`` to 1.0; ``approx_records`` is the first truthy of
    ``count``/``num_records``/``records`` coerced to an integer when it safely can be."""
    v = F.try_parse_json(_c(line_col))
    keep = [ord_col] if ord_col else []
    df = lines.filter(F.trim(_c(line_col)) != "").select(*keep, v.alias("__v"), _c(line_col).alias("__line"))
    path = F.try_variant_get("__v", "$.path", "string")
    if strict:
        path = F.coalesce(path, F.raise_error(F.concat(F.lit("manifest line without a path: "), F.col("__line"))).cast("string"))
    approx = None
    for f in reversed(COUNT_FIELDS):
        val = F.try_variant_get("__v", f"$.{f}", "variant")
        approx = F.when(_truthy_variant(val), val).otherwise(approx if approx is not None else F.lit(None))
    return df.select(
        *keep,
        path.alias("path"),
        F.coalesce(F.try_variant_get("__v", "$.type", "string"), F.lit(DEFAULT_TYPE)).alias("type"),
        F.coalesce(F.try_variant_get("__v", "$.weight", "double"), F.lit(DEFAULT_WEIGHT)).alias("weight"),
        safe_int(approx).alias("approx_records"),
    ).withColumn("bad_entry", F.col("path").isNull())


def manifest_faults(lines: DataFrame, line_col: str = "value", ord_col: str | None = None) -> DataFrame:
    """Non-blank manifest lines that give no entry, with the reason."""
    v = F.try_parse_json(_c(line_col))
    keep = [ord_col] if ord_col else []
    found = lines.filter(F.trim(_c(line_col)) != "").select(*keep, _c(line_col).alias("line"), v.alias("__v"))
    reason = F.when(F.col("__v").isNull(), "not JSON").when(
        F.try_variant_get("__v", "$.path", "string").isNull(), "no path"
    )
    # an empty or one-element array instead of a filter, which would parse every line twice
    listed = found.withColumn("reason", F.explode(F.array_compact(F.array(reason))))
    return listed.drop("__v")


def _truthy_variant(v: Column) -> Column:
    kind = F.schema_of_variant(v)
    s = F.try_variant_get(v, "$", "string")
    d = F.try_variant_get(v, "$", "double")
    return (
        v.isNotNull()
        & (kind != "VOID")
        & F.when(kind == "STRING", s != "")
        .when(kind == "BOOLEAN", F.try_variant_get(v, "$", "boolean"))
        .when(kind.startswith("ARRAY") | kind.startswith("OBJECT"), F.lit(True))
        .otherwise(F.coalesce(d != 0, F.lit(True)))
    )


def safe_int(v: Column) -> Column:
    """Integer, integral float, or decimal-integer string -> bigint; anything else null."""
    kind = F.schema_of_variant(v)
    d = F.try_variant_get(v, "$", "double")
    s = F.try_variant_get(v, "$", "string")
    numeric = kind.isin("BIGINT", "INT", "SMALLINT", "TINYINT") | kind.startswith("DECIMAL") | (kind == "DOUBLE")
    return (
        F.when(numeric & (d == F.floor(d)), F.try_variant_get(v, "$", "decimal(38,0)").try_cast("bigint"))
        .when(kind == "BOOLEAN", F.try_variant_get(v, "$", "boolean").cast("bigint"))
        .when((kind == "STRING") & s.rlike(r"^\s*[+-]?[0-9]+\s*$"), F.trim(s).try_cast("bigint"))
    )


def expected_length(entries: DataFrame) -> DataFrame:
    """Sum of approximate record counts (missing counts as 0)."""
    return entries.agg(F.sum(F.coalesce("approx_records", F.lit(0))).cast("bigint").alias("expected_length"))


def filter_scorable(entries: DataFrame, type_col: str = "type") -> DataFrame:
    """Entries the scoring job handles: raw math / math_tool / code, math renamed."""
    mapping = F.create_map(*[F.lit(x) for kv in SCORABLE_TYPES.items() for x in kv])
    return entries.filter(_c(type_col).isin(*SCORABLE_TYPES)).withColumn(type_col, mapping[_c(type_col)])


def union_manifests(*manifests: DataFrame) -> DataFrame:
    """Union in the given order, numbering entries ``manifest_ord`` then ``entry_ord``."""
    if not manifests:
        raise ValueError("no manifest given")
    out = None
    for i, m in enumerate(manifests):
        m = m.withColumn("manifest_ord", F.lit(i))
        out = m if out is None else out.unionByName(m, allowMissingColumns=True)
    return out


def override_type_weight(entries: DataFrame, type_override: str | None, weight_override: float | None) -> DataFrame:
    out = entries
    if type_override is not None:
        out = out.withColumn("type", F.lit(type_override))
    if weight_override is not None:
        out = out.withColumn("weight", F.lit(float(weight_override)))
    return out


def manifest_json(entries: DataFrame, cols=("path", "type", "weight")) -> DataFrame:
    """Compact JSON manifest lines (``value`` column), ready for ``write.text``."""
    return entries.select(F.to_json(F.struct(*cols)).alias("value"))


# ---------------------------------------------------------------- paths and types


def normalize_path(col) -> Column:
    """Backslashes to slashes, trailing slashes removed, duplicate slashes collapsed
    except right after ``:`` (keeps ``gs://``)."""
    s = F.regexp_replace(F.replace(_c(col), F.lit("\\"), F.lit("/")), r"/+\z", "")
    return F.regexp_replace(s, r"(?<!:)//+", "/")


def complete_uri(col, scheme: str = "gs://", default: str | None = None) -> Column:
    """Add the scheme when absent (leading slashes dropped); empty or null -> default."""
    c = _c(col)
    filled = F.when(c.startswith(scheme), c).otherwise(F.concat(F.lit(scheme), F.regexp_replace(c, r"^/+", "")))
    return F.when(c.isNull() | (c == ""), F.lit(default)).otherwise(filled)


def _hint_regex(words) -> str:
    return r"(?i)(?:\b|/)(" + "|".join(words) + r")(?:\b|/)"


def canonical_type(raw, path, dataset_id=None) -> Column:
    """lm / math_tool / code from a declared type, else from hints in ``path::dataset``."""
    s = F.replace(F.lower(py_strip(F.coalesce(_c(raw), F.lit("")))), F.lit("-"), F.lit("_"))
    ds = F.coalesce(_c(dataset_id), F.lit("")) if dataset_id is not None else F.lit("")
    hint = F.lower(F.concat(F.coalesce(_c(path), F.lit("")), F.lit("::"), ds))
    return (
        F.when(s.isin(*MATH_ALIASES), F.lit("math_tool"))
        .when(s.isin(*CODE_ALIASES), F.lit("code"))
        .when(hint.rlike(_hint_regex(CODE_HINTS)), F.lit("code"))
        .when(hint.rlike(_hint_regex(MATH_HINTS)), F.lit("math_tool"))
        .otherwise(F.lit(DEFAULT_TYPE))
    )


def strict_type(raw) -> Column:
    """Scoring-time type check: math/math_tool/code (any case) normalised, else null."""
    mapping = F.create_map(*[F.lit(x) for kv in SCORABLE_TYPES.items() for x in kv])
    return mapping[F.lower(_c(raw).cast("string"))]


def artifact_family(type_col) -> Column:
    mapping = F.create_map(*[F.lit(x) for kv in TYPE_FAMILY.items() for x in kv])
    return mapping[_c(type_col)]


def record_type(record_type_col, entry_type_col) -> Column:
    """A type on the record overrides the manifest entry's type."""
    return F.coalesce(_c(record_type_col), _c(entry_type_col))


# ---------------------------------------------------------------- dataset matching


def config_roots(configs: DataFrame, job_col: str = "job", ord_col: str = "cfg_ord") -> DataFrame:
    """Flatten config candidate roots (fields manifest, inp, in, out, root, roots; each a
    string or an array) into ``(job, cfg_ord, root)`` with normalised roots."""
    present = [f for f in CONFIG_ROOT_FIELDS if f in configs.columns]
    arrays = []
    for f in present:
        dt = configs.schema[f].dataType
        arrays.append(F.col(f) if isinstance(dt, T.ArrayType) else F.array(F.col(f)))
    cands = F.filter(F.flatten(F.array(*arrays)), lambda x: x.isNotNull() & (x != ""))
    return configs.select(job_col, ord_col, F.explode(cands).alias("__root")).select(
        job_col, ord_col, normalize_path("__root").alias("root")
    )


def path_prefixes(col) -> Column:
    """All strings p such that ``path == p`` or ``path`` starts with ``p + '/'``."""
    parts = F.split(_c(col), "/", -1)
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, 1, k), "/"))


def match_dataset(
    paths: DataFrame, configs: DataFrame, path_col: str = "path", job_col: str = "job", ord_col: str = "cfg_ord"
) -> DataFrame:
    """Longest-prefix match of each path to a dataset root; ties go to the earlier config.

    Adds ``dataset_id`` (null when nothing matches) to ``paths``."""
    roots = config_roots(configs, job_col, ord_col)
    if small_group_count(roots, [job_col, ord_col, "root"]):
        roots = F.broadcast(roots)
    keys = paths.select(path_col).distinct()
    cand = keys.select(path_col, F.explode(path_prefixes(normalize_path(path_col))).alias("root"))
    hits = cand.join(roots, "root")
    best = hits.groupBy(path_col).agg(
        F.max_by(F.col(job_col), F.struct(F.length("root"), -F.col(ord_col))).alias("dataset_id")
    )
    return paths.join(best, path_col, "left")


# ---------------------------------------------------------------- readiness


def shard_file_counts(listing: DataFrame, file_col: str = "path") -> DataFrame:
    """Count ``*.jsonl`` files directly inside each folder of a file listing."""
    f = _c(file_col)
    folder = F.regexp_extract(f, r"^(.*)/[^/]*$", 1)
    name = F.regexp_extract(f, r"([^/]*)$", 1)
    return (
        listing.filter(name.endswith(".jsonl"))
        .groupBy(folder.alias("folder"))
        .agg(F.count(F.lit(1)).cast("bigint").alias("n_files"))
    )


def with_readiness(configs: DataFrame, listing: DataFrame, out_col: str = "out", prefix: str = "") -> DataFrame:
    """Attach ``{prefix}files`` / ``{prefix}ready`` for each config's output folder."""
    counts = shard_file_counts(listing)
    folder = F.regexp_replace(_c(out_col), r"/+\z", "")
    joined = configs.withColumn("__folder", folder).join(
        counts.withColumnRenamed("folder", "__folder"), "__folder", "left"
    )
    files = F.when(F.coalesce(_c(out_col), F.lit("")) == "", F.lit(0)).otherwise(F.coalesce("n_files", F.lit(0)))
    return (
        joined.withColumn(f"{prefix}files", files.cast("bigint"))
        .withColumn(f"{prefix}ready", F.col(f"{prefix}files") > 0)
        .drop("__folder", "n_files")
    )


def shard_glob(out_col) -> Column:
    return F.concat(F.regexp_replace(_c(out_col), r"/+\z", ""), F.lit("/*.jsonl"))


def resolve_paths(entries: DataFrame, configs: DataFrame, listing: DataFrame) -> DataFrame:
    """Manifest entries -> dataset id (longest prefix) -> shard glob when that dataset's
    shards are ready, else the raw path."""
    matched = match_dataset(entries, configs)
    ready = with_readiness(configs.select("job", "out"), listing).select(
        F.col("job").alias("dataset_id"), "out", "files", "ready"
    )
    out = matched.join(ready, "dataset_id", "left")
    return out.withColumn(
        "resolved_path", F.when(F.col("ready"), shard_glob("out")).otherwise(F.col("path"))
    )


def readiness_report(configs: DataFrame, before: DataFrame, after: DataFrame, mode: str) -> DataFrame:
    """Per dataset: files and readiness before and after preparation, and the status
    (READY / MISSING / SKIPPED / BUILDING / FAILED).  ``configs`` may carry a boolean
    ``job_failed`` column holding the outcome of the preparation job."""
    mode = mode.lower()
    if mode not in MODES:
        raise ValueError(f"Unknown prepare mode: {mode}")
    b = with_readiness(configs, before, prefix="before_")
    a = with_readiness(configs.select("job", "out"), after, prefix="after_").select("job", "after_files", "after_ready")
    df = b.join(a, "job", "left")
    should_run = F.lit(mode == "force") | (F.lit(mode == "auto") & ~F.col("before_ready"))
    failed = should_run & F.coalesce(F.col("job_failed"), F.lit(False)) if "job_failed" in configs.columns else F.lit(False)
    initial = (
        F.when(F.lit(mode == "skip"), F.lit("SKIPPED"))
        .when(should_run, F.lit("BUILDING"))
        .when(F.col("before_ready"), F.lit("READY"))
        .otherwise(F.lit("MISSING"))
    )
    status = (
        F.when(failed, F.lit("FAILED"))
        .when(initial == "SKIPPED", initial)
        .when(F.col("after_ready"), F.lit("READY"))
        .otherwise(initial)
    )
    return df.select(
        F.lit(mode).alias("mode"),
        "job",
        "before_ready",
        "before_files",
        F.when(failed, F.col("before_ready")).otherwise(F.col("after_ready")).alias("after_ready"),
        F.when(failed, F.col("before_files")).otherwise(F.col("after_files")).alias("after_files"),
        (should_run & ~failed & F.lit(mode != "skip")).alias("ran_pipeline"),
        status.alias("status"),
    )


def slice_manifest(entries: DataFrame, listing: DataFrame, files_per_entry: int, file_col: str = "path") -> DataFrame:
    """File-sliced manifest: each entry's pattern -> its first ``files_per_entry`` files
    (name order), weight split evenly over the files taken.

    ``entries`` needs ``entry_ord``, ``path`` (a folder glob ``dir/*suffix``) and ``weight``."""
    pat = F.col("path")
    e = entries.select(
        "entry_ord",
        "weight",
        F.regexp_extract(pat, r"^(.*)/[^/]*$", 1).alias("__dir"),
        F.regexp_extract(pat, r"/\*([^/*]*)$", 1).alias("__suffix"),
        pat.alias("pattern"),
    )
    f = listing.select(
        F.col(file_col).alias("file"), F.regexp_extract(F.col(file_col), r"^(.*)/[^/]*$", 1).alias("__dir")
    )
    if small_group_count(e, ["entry_ord"]):
        e = F.broadcast(e)
    j = f.join(e, "__dir").filter(F.col("file").endswith(F.col("__suffix")))
    top = top_k_per_group(j, ["entry_ord"], ["file"], files_per_entry)
    n = F.count(F.lit(1)).over(Window.partitionBy("entry_ord"))  # at most files_per_entry rows
    return top.select("entry_ord", "pattern", "file", (F.col("weight") / n).alias("weight"))


# ---------------------------------------------------------------- configs, counts, limits


_CONFIG_SCHEMA = T.StructType(
    [
        T.StructField("file_path", T.StringType()),
        T.StructField("position", T.IntegerType()),
        T.StructField("job", T.StringType()),
        T.StructField("inputs", T.ArrayType(T.StringType())),
        T.StructField("out", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("manifest", T.StringType()),
    ]
)


def config_rows(text: str | None) -> list[tuple]:
    """The jobs of one YAML mapping job -> {in, out, type, manifest}, in order; ``in`` may be a
    string or a list."""
    import yaml

    data = yaml.safe_load(text or "") or {}
    if not isinstance(data, dict):
        raise ValueError("a dataset config is a mapping of jobs")
    rows = []
    for k, (job, spec) in enumerate(data.items()):
        spec = spec or {}
        given = spec.get("in")
        inputs = [str(x) for x in given] if isinstance(given, (list, tuple)) else [str(given)] if given else []
        rows.append((k, str(job), inputs, spec.get("out"), spec.get("type", DEFAULT_TYPE), spec.get("manifest")))
    return rows


def read_dataset_configs(spark, paths) -> DataFrame:
    """Dataset configs from YAML files, parsed in tasks, a file a row: ``(cfg_ord, file_path,
    job, inputs array, out, type, manifest)``.  ``cfg_ord`` follows the files' names and the
    order within a file.  A file that is no mapping fails the job."""
    from corpusmill.operators.ordinals import with_ordinal

    files = spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("file_path"), "value")

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        names = _CONFIG_SCHEMA.fieldNames()
        for batch in batches:
            rows = [(path, *r) for path, text in zip(*(c.to_pylist() for c in batch.columns)) for r in config_rows(text)]
            yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], to_arrow_schema(_CONFIG_SCHEMA))

    parsed = files.mapInArrow(parse, _CONFIG_SCHEMA)
    out = with_ordinal(parsed, ["file_path", "position"], name="cfg_ord")
    return out.select("cfg_ord", "file_path", "job", "inputs", "out", "type", "manifest")


def attach_counts(entries: DataFrame, counts: DataFrame, entry_ord_col: str = "entry_ord") -> DataFrame:
    """Per dataset key (dataset id, else the resolved path): the first entry's output path
    and the record count.  ``counts`` has ``(dataset_key, records)``."""
    key = F.coalesce(F.col("dataset_id"), F.col("resolved_path"))
    first = entries.withColumn("dataset_key", key).groupBy("dataset_key").agg(
        F.min_by(F.col("resolved_path"), F.col(entry_ord_col)).alias("first_path")
    )
    return first.join(counts, "dataset_key", "left").withColumn("records", F.coalesce("records", F.lit(0)).cast("bigint"))


def limit_samples(df: DataFrame, order_cols, n: int) -> DataFrame:
    """Scoring sample limit: the first ``n`` rows in order (0 = all).  A distributed
    top-n (per-task top-n, then a merge), not a global sort."""
    if not n:
        return df
    return df.orderBy(*order_cols).limit(int(n))

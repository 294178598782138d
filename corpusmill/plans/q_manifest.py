"""Queries: manifests, dataset matching, type canonicalisation, readiness.

The manifest, dataset configs and file listings are derived from ``documents`` (one
corpus per ``source``, one shard file per block of documents) and from ``pages.url``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.operators import manifest as M
from corpusmill.operators.ordinals import with_ordinal
from corpusmill.plans.catalog import register, table
from corpusmill.session import scratch_dir

# ------------------------------------------------------------------ derived inputs

_N = "CAST(substring(source, 4) AS INT)"

_PATH = f"""CASE {_N} % 6
  WHEN 0 THEN 'gs://corpora/' || source || '/*.jsonl'
  WHEN 1 THEN 'gs://corpora//gsm8k/' || source || '/'
  WHEN 2 THEN 'gs://corpora/humaneval-' || source || '/*.jsonl'
  WHEN 3 THEN 'corpora/' || source || '/data.parquet'
  WHEN 4 THEN 'gs://corpora/math/' || source || '/part.jsonl.gz'
  ELSE 'gs://corpora/web/' || source || '//' END"""


def manifest_lines(spark, sf):
    """One JSON manifest line per source, with varied optional fields and count types."""
    docs = table(spark, sf, "documents")
    per = docs.groupBy("source").agg(F.count(F.lit(1)).alias("cnt")).withColumn("n", F.expr(_N))
    n, cnt = F.col("n"), F.col("cnt").cast("string")
    type_part = (
        F.when(n % 4 == 1, F.lit(', "type": "math"'))
        .when(n % 4 == 2, F.lit(', "type": "code"'))
        .when(n % 4 == 3, F.lit(', "type": "Math-Reasoning"'))
        .otherwise(F.lit(""))
    )
    weight_part = F.when(n % 3 == 0, F.lit("")).otherwise(
        F.concat(F.lit(', "weight": '), ((n % 5 + 1) * 0.25).cast("string"))
    )
    count_part = (
        F.when(n % 5 == 0, F.concat(F.lit(', "count": '), cnt))
        .when(n % 5 == 1, F.concat(F.lit(', "num_records": "'), cnt, F.lit('"')))
        .when(n % 5 == 2, F.concat(F.lit(', "records": '), cnt, F.lit(".0")))
        .when(n % 5 == 3, F.concat(F.lit(', "count": 0, "records": "'), cnt, F.lit('x"')))
        .otherwise(F.concat(F.lit(', "count": '), cnt, F.lit(".5")))
    )
    line = F.concat(F.lit('{"path": "'), F.expr(_PATH), F.lit('"'), type_part, weight_part, count_part, F.lit("}"))
    return per.select("n", "source", line.alias("value"))


def manifest_entries(spark, sf):
    lines = manifest_lines(spark, sf)
    return M.parse_manifest_lines(lines, "value", ord_col="n")


_ENTRIES_SQL = f"""
WITH per AS (SELECT source, {_N} AS n, count(*) AS cnt FROM documents GROUP BY source),
entries AS (SELECT n, source, {_PATH} AS path,
    CASE n % 4 WHEN 1 THEN 'math' WHEN 2 THEN 'code' WHEN 3 THEN 'Math-Reasoning' ELSE 'lm' END AS type,
    CAST(CASE WHEN n % 3 = 0 THEN 1.0 ELSE (n % 5 + 1) * 0.25 END AS DOUBLE) AS weight,
    CASE WHEN n % 5 IN (0, 1, 2) THEN cnt END AS approx_records
  FROM per)
"""


@register(
    "manifest_defaults",
    _ENTRIES_SQL + "SELECT path, type, round(weight, 6) AS weight, CAST(approx_records AS BIGINT) AS approx_records FROM entries",
)
def q_manifest_defaults(spark, sf):
    e = manifest_entries(spark, sf)
    return e.select("path", "type", F.round("weight", 6).alias("weight"), "approx_records")


@register(
    "manifest_faults",
    f"""WITH p AS (SELECT DISTINCT url FROM pages)
        SELECT url, CASE length(url) % 4 WHEN 1 THEN 'no path' WHEN 2 THEN 'no path' ELSE 'not JSON' END AS reason
        FROM p WHERE length(url) % 4 > 0""",
)
def q_manifest_faults(spark, sf):
    """Lines of a manifest, one per url, that give no entry: without a path, with a null one,
    cut short."""
    urls = table(spark, sf, "pages").select("url").distinct()
    kind, quoted = F.length("url") % 4, F.to_json(F.struct(F.col("url").alias("path")))
    line = (
        F.when(kind == 0, quoted)
        .when(kind == 1, '{"type": "code"}')
        .when(kind == 2, '{"path": null}')
        .otherwise(F.substring(quoted, 1, 12))
    )
    faults = M.manifest_faults(urls.select("url", line.alias("value")), "value", ord_col="url")
    return faults.select("url", "reason")


@register(
    "expected_length",
    _ENTRIES_SQL + "SELECT CAST(sum(coalesce(approx_records, 0)) AS BIGINT) AS expected_length FROM entries",
)
def q_expected_length(spark, sf):
    return M.expected_length(manifest_entries(spark, sf))


@register(
    "manifest_filter",
    _ENTRIES_SQL
    + """SELECT path, CASE WHEN type = 'math' THEN 'math_tool' ELSE type END AS type
FROM entries WHERE type IN ('math', 'math_tool', 'code')""",
)
def q_manifest_filter(spark, sf):
    return M.filter_scorable(manifest_entries(spark, sf)).select("path", "type")


# Canonical type of a manifest entry (declared type, then hints in the path).
_CANON_SQL = """CASE
  WHEN replace(lower(trim(coalesce({t}, ''))), '-', '_') IN ('math_tool','math','mathreasoning','math_reasoning') THEN 'math_tool'
  WHEN replace(lower(trim(coalesce({t}, ''))), '-', '_') IN ('code','code_tool','coding','programming') THEN 'code'
  WHEN regexp_matches(lower(coalesce({p}, '') || '::' || coalesce({d}, '')),
       '(?:\\b|/)(code|codesearchnet|humaneval|mbpp|leetcode|github|programming|coding)(?:\\b|/)') THEN 'code'
  WHEN regexp_matches(lower(coalesce({p}, '') || '::' || coalesce({d}, '')),
       '(?:\\b|/)(gsm8k|asdiv|svamp|mawps|aqua|mathqa|math|arithmetic)(?:\\b|/)') THEN 'math_tool'
  ELSE 'lm' END"""


def canon_sql(t: str, p: str, d: str = "NULL") -> str:
    return _CANON_SQL.format(t=t, p=p, d=d)


@register(
    "manifest_union",
    _ENTRIES_SQL
    + f""", c AS (SELECT n, path, {canon_sql('type', 'path')} AS ctype FROM entries)
SELECT CAST(CASE WHEN ctype = 'lm' THEN 0 ELSE 1 END AS INT) AS manifest_ord, path, ctype AS type,
       CAST(row_number() OVER (PARTITION BY ctype = 'lm' ORDER BY n) - 1 AS BIGINT) AS entry_ord
FROM c""",
)
def q_manifest_union(spark, sf):
    e = manifest_entries(spark, sf).withColumn("type", M.canonical_type("type", "path"))
    lm = e.filter(F.col("type") == "lm")
    mc = e.filter(F.col("type") != "lm")
    u = M.union_manifests(lm, mc)
    # entry order inside each manifest (manifests are small tables: one row per corpus)
    from pyspark.sql import Window

    w = Window.partitionBy("manifest_ord").orderBy("n")
    return u.select(
        F.col("manifest_ord").cast("int").alias("manifest_ord"),
        "path",
        "type",
        (F.row_number().over(w) - 1).cast("bigint").alias("entry_ord"),
    )


# ------------------------------------------------------------------ listings / configs

_LISTING_SQL = f"""
WITH src AS (SELECT DISTINCT source, {_N} AS n FROM documents),
files AS (SELECT DISTINCT source, {_N} AS n,
    'gs://out/' || source || '/part-' || lpad(CAST(doc_id // 7 AS VARCHAR), 5, '0') ||
    CASE WHEN {_N} % 3 = 0 THEN '.json' ELSE '.jsonl' END AS path FROM documents),
after_files AS (SELECT path FROM files
    UNION ALL SELECT replace(path, '.json', '.jsonl') FROM files WHERE n % 3 = 0 AND n % 7 <> 0),
configs AS (SELECT source AS job, n AS cfg_ord, 'gs://raw/' || source AS inp, 'gs://out/' || source || '/' AS out,
    (n % 7 = 0) AS job_failed FROM src)
"""


def listing_frames(spark, sf):
    docs = table(spark, sf, "documents").withColumn("n", F.expr(_N))
    files = docs.select(
        "source",
        "n",
        F.concat(
            F.lit("gs://out/"),
            F.col("source"),
            F.lit("/part-"),
            F.lpad(F.floor(F.col("doc_id") / 7).cast("string"), 5, "0"),
            F.when(F.col("n") % 3 == 0, F.lit(".json")).otherwise(F.lit(".jsonl")),
        ).alias("path"),
    ).distinct()
    after = files.select("path").unionByName(
        files.filter((F.col("n") % 3 == 0) & (F.col("n") % 7 != 0)).select(
            F.replace(F.col("path"), F.lit(".json"), F.lit(".jsonl")).alias("path")
        )
    )
    configs = (
        docs.select("source", "n")
        .distinct()
        .select(
            F.col("source").alias("job"),
            F.col("n").alias("cfg_ord"),
            F.concat(F.lit("gs://raw/"), F.col("source")).alias("inp"),
            F.concat(F.lit("gs://out/"), F.col("source"), F.lit("/")).alias("out"),
            (F.col("n") % 7 == 0).alias("job_failed"),
        )
    )
    return files, after, configs


@register(
    "resolve_paths",
    _LISTING_SQL
    + """,
entries AS (SELECT 'gs://raw/' || job || '/train.jsonl' AS path FROM configs
            UNION ALL SELECT 'gs://raw/' || job || 'x/train.jsonl' FROM configs),
roots AS (SELECT job, cfg_ord, regexp_replace(r, '/+$', '') AS root
          FROM (SELECT job, cfg_ord, inp AS r FROM configs UNION ALL SELECT job, cfg_ord, out FROM configs)),
m AS (SELECT e.path, r.job, row_number() OVER (PARTITION BY e.path ORDER BY length(r.root) DESC, r.cfg_ord) AS rk
      FROM entries e JOIN roots r ON e.path = r.root OR starts_with(e.path, r.root || '/')),
cnt AS (SELECT regexp_extract(path, '^(.*)/[^/]*$', 1) AS folder, count(*) AS n_files
        FROM files WHERE ends_with(regexp_extract(path, '([^/]*)$', 1), '.jsonl') GROUP BY 1)
SELECT e.path, m.job AS dataset_id,
       CASE WHEN coalesce(cnt.n_files, 0) > 0 THEN regexp_replace(c.out, '/+$', '') || '/*.jsonl' ELSE e.path END AS resolved_path
FROM entries e LEFT JOIN m ON m.path = e.path AND m.rk = 1
LEFT JOIN configs c ON c.job = m.job
LEFT JOIN cnt ON cnt.folder = regexp_replace(c.out, '/+$', '')
""",
)
def q_resolve_paths(spark, sf):
    files, _after, configs = listing_frames(spark, sf)
    raw = F.concat(F.lit("gs://raw/"), F.col("job"))
    entries = configs.select(F.concat(raw, F.lit("/train.jsonl")).alias("path")).unionByName(
        configs.select(F.concat(raw, F.lit("x/train.jsonl")).alias("path"))
    )
    out = M.resolve_paths(entries, configs.drop("job_failed"), files.select("path"))
    return out.select("path", "dataset_id", "resolved_path")


def _readiness_sql(mode: str) -> str:
    run = {"force": "TRUE", "auto": "NOT before_ready", "skip": "FALSE"}[mode]
    return f"""
SELECT '{mode}' AS mode, job, before_ready, before_files,
  CASE WHEN failed THEN before_ready ELSE after_ready END AS after_ready,
  CASE WHEN failed THEN before_files ELSE after_files END AS after_files,
  ({run}) AND NOT failed AND '{mode}' <> 'skip' AS ran_pipeline,
  CASE WHEN failed THEN 'FAILED'
       WHEN '{mode}' = 'skip' THEN 'SKIPPED'
       WHEN after_ready THEN 'READY'
       WHEN {run} THEN 'BUILDING'
       WHEN before_ready THEN 'READY' ELSE 'MISSING' END AS status
FROM (SELECT *, ({run}) AND job_failed AS failed FROM st_{'skip' if mode == 'skip' else 'run'})"""


@register(
    "readiness_report",
    _LISTING_SQL
    + """,
bc AS (SELECT regexp_extract(path, '^(.*)/[^/]*$', 1) AS folder, count(*) AS n
       FROM files WHERE ends_with(path, '.jsonl') GROUP BY 1),
ac AS (SELECT regexp_extract(path, '^(.*)/[^/]*$', 1) AS folder, count(*) AS n
       FROM after_files WHERE ends_with(path, '.jsonl') GROUP BY 1),
st_run AS (SELECT c.job, c.job_failed,
    CAST(coalesce(bc.n, 0) AS BIGINT) AS before_files, coalesce(bc.n, 0) > 0 AS before_ready,
    CAST(coalesce(ac.n, 0) AS BIGINT) AS after_files, coalesce(ac.n, 0) > 0 AS after_ready
  FROM configs c LEFT JOIN bc ON bc.folder = regexp_replace(c.out, '/+$', '')
  LEFT JOIN ac ON ac.folder = regexp_replace(c.out, '/+$', '')),
st_skip AS (SELECT job, job_failed, before_files, before_ready, before_files AS after_files,
  before_ready AS after_ready FROM st_run)
"""
    + " UNION ALL ".join(_readiness_sql(m) for m in M.MODES),
)
def q_readiness_report(spark, sf):
    files, after, configs = listing_frames(spark, sf)
    cfg = configs.select("job", "out", "job_failed")
    before = files.select("path")
    parts = [
        M.readiness_report(cfg, before, before if mode == "skip" else after, mode) for mode in M.MODES
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register(
    "manifest_slice",
    _LISTING_SQL
    + """,
entries AS (SELECT cfg_ord AS entry_ord, 'gs://out/' || job || '/*.jsonl' AS pattern,
                   CAST(CASE WHEN cfg_ord % 3 = 0 THEN 1.0 ELSE (cfg_ord % 5 + 1) * 0.25 END AS DOUBLE) AS weight FROM configs),
j AS (SELECT e.entry_ord, e.pattern, f.path AS file, e.weight,
             row_number() OVER (PARTITION BY e.entry_ord ORDER BY f.path) AS rk
      FROM entries e JOIN files f ON regexp_extract(f.path, '^(.*)/[^/]*$', 1) = regexp_extract(e.pattern, '^(.*)/[^/]*$', 1)
      WHERE ends_with(f.path, '.jsonl'))
SELECT CAST(entry_ord AS INT) AS entry_ord, pattern, file,
       round(weight / count(*) OVER (PARTITION BY entry_ord), 6) AS weight
FROM j WHERE rk <= 4
""",
)
def q_manifest_slice(spark, sf):
    files, _after, configs = listing_frames(spark, sf)
    entries = configs.select(
        F.col("cfg_ord").alias("entry_ord"),
        F.concat(F.lit("gs://out/"), F.col("job"), F.lit("/*.jsonl")).alias("path"),
        F.when(F.col("cfg_ord") % 3 == 0, F.lit(1.0)).otherwise((F.col("cfg_ord") % 5 + 1) * 0.25).alias("weight"),
    )
    out = M.slice_manifest(entries, files.select("path"), 4)
    return out.select(
        F.col("entry_ord").cast("int").alias("entry_ord"), "pattern", "file", F.round("weight", 6).alias("weight")
    )


# ------------------------------------------------------------------ pages: paths and types

_DIRTY_URL = """CASE page_id % 4
  WHEN 0 THEN replace(url, '/', '\\') || '\\'
  WHEN 1 THEN replace(url, '.example', '//.example') || '//'
  WHEN 2 THEN replace(url, '://', ':////')
  ELSE url END"""
_BARE = "regexp_replace(url, '^https?://', '')"
_URI_IN = f"CASE page_id % 5 WHEN 0 THEN '' WHEN 1 THEN 'gs://' || {_BARE} WHEN 2 THEN '//' || {_BARE} ELSE {_BARE} END"


@register(
    "path_normalize",
    f"""
WITH d AS (SELECT page_id, {_DIRTY_URL} AS p, {_URI_IN} AS u FROM pages),
s AS (SELECT page_id, u, regexp_replace(replace(p, '\\', '/'), '/+$', '') AS s FROM d)
SELECT page_id, regexp_replace(s, '(^|[^:])//+', '\\1/', 'g') AS norm_path,
  CASE WHEN u IS NULL OR u = '' THEN 'gs://default/toolkit.zip'
       WHEN starts_with(u, 'gs://') THEN u ELSE 'gs://' || regexp_replace(u, '^/+', '') END AS gcs_uri
FROM s
""",
)
def q_path_normalize(spark, sf):
    pages = table(spark, sf, "pages")
    d = pages.select("page_id", F.expr(_DIRTY_URL.replace("'\\'", "'\\\\'")).alias("p"), F.expr(_URI_IN).alias("u"))
    return d.select(
        "page_id",
        M.normalize_path("p").alias("norm_path"),
        M.complete_uri("u", default="gs://default/toolkit.zip").alias("gcs_uri"),
    )


_HOST = "regexp_extract(url, '^([a-z]+://[^/?#]+)', 1)"
_LANG_ROOT = "regexp_extract(url, '^([a-z]+://[^/?#]+/[a-z]+)', 1)"


@register(
    "longest_prefix",
    f"""
WITH cfg_raw AS (
  SELECT DISTINCT 'host:' || {_HOST} AS job, {_HOST} AS root FROM pages
  UNION ALL SELECT DISTINCT 'dup:' || {_HOST}, {_HOST} || '/' FROM pages
  UNION ALL SELECT DISTINCT 'lang:' || {_LANG_ROOT}, {_LANG_ROOT} FROM pages),
cfg AS (SELECT job, row_number() OVER (ORDER BY job) AS cfg_ord, regexp_replace(root, '/+$', '') AS root FROM cfg_raw),
p AS (SELECT page_id, url AS path FROM pages),
m AS (SELECT p.page_id, c.job, row_number() OVER (PARTITION BY p.page_id ORDER BY length(c.root) DESC, c.cfg_ord) AS rk
      FROM p JOIN cfg c ON p.path = c.root OR starts_with(p.path, c.root || '/'))
SELECT p.page_id, m.job AS dataset_id FROM p LEFT JOIN m ON m.page_id = p.page_id AND m.rk = 1
""",
)
def q_longest_prefix(spark, sf):
    pages = table(spark, sf, "pages")
    host = F.expr(_HOST)
    lang = F.expr(_LANG_ROOT)
    cfg_raw = (
        pages.select(F.concat(F.lit("host:"), host).alias("job"), host.alias("root"))
        .distinct()
        .unionByName(pages.select(F.concat(F.lit("dup:"), host).alias("job"), F.concat(host, F.lit("/")).alias("root")).distinct())
        .unionByName(pages.select(F.concat(F.lit("lang:"), lang).alias("job"), lang.alias("root")).distinct())
    )
    cfg = with_ordinal(cfg_raw, "job", name="cfg_ord")  # grows with the hosts of pages
    paths = pages.select("page_id", F.col("url").alias("path"))
    return M.match_dataset(paths, cfg).select("page_id", "dataset_id")


_RAW_TYPE = """CASE page_id % 7 WHEN 0 THEN NULL WHEN 1 THEN ' Math-Reasoning ' WHEN 2 THEN 'CODING'
  WHEN 3 THEN 'lm' WHEN 4 THEN 'code-tool' WHEN 5 THEN 'text' ELSE 'math' END"""
_REC_TYPE = "CASE WHEN page_id % 4 = 0 THEN 'code' END"
_HINT_PATH = """url || '/' || CASE page_id % 9 WHEN 0 THEN 'data' WHEN 1 THEN 'GSM8K' WHEN 2 THEN 'codesearchnet_v2'
  WHEN 3 THEN 'my-code' WHEN 4 THEN 'mathqa.jsonl' WHEN 5 THEN 'arith' WHEN 6 THEN 'github'
  WHEN 7 THEN 'x/math/y' ELSE 'leetcode2' END"""
_DS = "CASE WHEN page_id % 5 = 0 THEN 'humaneval' END"


@register(
    "canonical_type",
    f"""
WITH d AS (SELECT page_id, coalesce({_REC_TYPE}, {_RAW_TYPE}) AS declared, {_HINT_PATH} AS path, {_DS} AS ds FROM pages)
SELECT page_id, {canon_sql('declared', 'path', 'ds')} AS sample_type,
  CASE lower(declared) WHEN 'math' THEN 'math_tool' WHEN 'math_tool' THEN 'math_tool' WHEN 'code' THEN 'code' END AS strict_type
FROM d
""",
)
def q_canonical_type(spark, sf):
    pages = table(spark, sf, "pages")
    d = pages.select(
        "page_id",
        M.record_type(F.expr(_REC_TYPE), F.expr(_RAW_TYPE)).alias("declared"),
        F.expr(_HINT_PATH).alias("path"),
        F.expr(_DS).alias("ds"),
    )
    return d.select(
        "page_id",
        M.canonical_type("declared", "path", "ds").alias("sample_type"),
        M.strict_type("declared").alias("strict_type"),
    )


@register(
    "manifest_lines",
    _ENTRIES_SQL
    + """SELECT to_json(struct_pack(path := path, type := 'math_tool', weight := weight * 2)) AS value FROM entries""",
)
def q_manifest_lines(spark, sf):
    e = manifest_entries(spark, sf)
    e = e.withColumn("weight", F.col("weight") * 2)
    return M.manifest_json(M.override_type_weight(e, "math_tool", None))


# ------------------------------------------------------------------ configs, counts, split, limit


def write_config_files(spark, sf, base: str) -> None:
    """Dataset-config YAML, a job per source, a dozen files written by tasks."""
    sources = table(spark, sf, "documents").select("source").distinct().withColumn("n", F.expr(_N))
    source, n = F.col("source"), F.col("n")
    one = F.concat(F.lit("  in: gs://raw/"), source, F.lit("/a.jsonl"))
    two = F.concat(F.lit("  in: [gs://raw/"), source, F.lit("/a.jsonl, gs://raw/"), source, F.lit("/b.jsonl]"))
    text = F.concat_ws(
        "\n",
        F.concat(source, F.lit(":")),
        F.when(n % 2 == 0, one).otherwise(two),
        F.concat(F.lit("  out: gs://out/"), source, F.lit("/")),
        F.when(n % 3 != 0, F.lit("  type: math_tool")),
    )
    sources.select(text.alias("value"), F.pmod(F.xxhash64("source"), F.lit(12)).alias("part")).repartition("part").write.partitionBy(
        "part"
    ).text(base)


@register(
    "dataset_configs",
    f"""
WITH s AS (SELECT DISTINCT source, {_N} AS n FROM documents)
SELECT source AS job, 'gs://raw/' || source || '/a.jsonl' AS input, 'gs://out/' || source || '/' AS out,
       CASE WHEN n % 3 <> 0 THEN 'math_tool' ELSE 'lm' END AS type FROM s
UNION ALL
SELECT source, 'gs://raw/' || source || '/b.jsonl', 'gs://out/' || source || '/',
       CASE WHEN n % 3 <> 0 THEN 'math_tool' ELSE 'lm' END FROM s WHERE n % 2 = 1
""",
)
def q_dataset_configs(spark, sf):
    base = scratch_dir(spark, "configs")
    write_config_files(spark, sf, base)
    cfg = M.read_dataset_configs(spark, f"{base}/*/*")
    return cfg.select("job", F.explode("inputs").alias("input"), "out", "type")


@register(
    "count_attach",
    _LISTING_SQL
    + """,
entries AS (SELECT cfg_ord AS entry_ord, job, 'gs://raw/' || job || '/train.jsonl' AS path FROM configs
            UNION ALL SELECT cfg_ord + 1000, job, 'gs://raw/' || job || '/more.jsonl' FROM configs
            UNION ALL SELECT cfg_ord + 2000, job, 'gs://raw/' || job || 'x/other.jsonl' FROM configs),
cnt AS (SELECT regexp_extract(path, '^(.*)/[^/]*$', 1) AS folder, count(*) AS n_files
        FROM files WHERE ends_with(path, '.jsonl') GROUP BY 1),
r AS (SELECT e.entry_ord, e.path, CASE WHEN e.path LIKE 'gs://raw/' || e.job || '/%' THEN e.job END AS dataset_id, e.job FROM entries e),
rp AS (SELECT r.*, CASE WHEN r.dataset_id IS NOT NULL AND coalesce(cnt.n_files, 0) > 0 THEN 'gs://out/' || r.job || '/*.jsonl'
                        ELSE r.path END AS resolved_path
       FROM r LEFT JOIN cnt ON cnt.folder = 'gs://out/' || r.job),
recs AS (SELECT source AS dataset_key, count(*) AS records FROM documents GROUP BY source)
SELECT k.dataset_key, k.first_path, CAST(coalesce(recs.records, 0) AS BIGINT) AS records FROM (
  SELECT coalesce(dataset_id, resolved_path) AS dataset_key, arg_min(resolved_path, entry_ord) AS first_path FROM rp GROUP BY 1) k
LEFT JOIN recs ON recs.dataset_key = k.dataset_key
""",
)
def q_count_attach(spark, sf):
    files, _after, configs = listing_frames(spark, sf)
    raw = F.concat(F.lit("gs://raw/"), F.col("job"))
    entries = (
        configs.select(F.col("cfg_ord").alias("entry_ord"), F.concat(raw, F.lit("/train.jsonl")).alias("path"))
        .unionByName(configs.select((F.col("cfg_ord") + 1000).alias("entry_ord"), F.concat(raw, F.lit("/more.jsonl")).alias("path")))
        .unionByName(configs.select((F.col("cfg_ord") + 2000).alias("entry_ord"), F.concat(raw, F.lit("x/other.jsonl")).alias("path")))
    )
    resolved = M.resolve_paths(entries, configs.drop("job_failed"), files.select("path"))
    counts = table(spark, sf, "documents").groupBy(F.col("source").alias("dataset_key")).agg(F.count(F.lit(1)).alias("records"))
    return M.attach_counts(resolved, counts).select("dataset_key", "first_path", "records")


@register(
    "manifest_split",
    _ENTRIES_SQL
    + f""", c AS (SELECT path, {canon_sql('type', 'path')} AS ctype FROM entries)
SELECT path, ctype = 'lm' AS in_lm, ctype <> 'lm' AS in_math_code FROM c""",
)
def q_manifest_split(spark, sf):
    e = manifest_entries(spark, sf).withColumn("type", M.canonical_type("type", "path"))
    lm = e.filter(F.col("type") == "lm").select("path", F.lit(True).alias("in_lm"))
    mc = e.filter(F.col("type") != "lm").select("path", F.lit(True).alias("in_math_code"))
    full = e.select("path")
    # invariant: every entry of the full manifest is in exactly one of the two splits
    j = full.join(lm, "path", "left").join(mc, "path", "left")
    return j.select("path", F.coalesce("in_lm", F.lit(False)).alias("in_lm"), F.coalesce("in_math_code", F.lit(False)).alias("in_math_code"))


SAMPLE_LIMIT = 100


@register(
    "sample_limit",
    f"""SELECT doc_id FROM documents WHERE lang IN ('fr', 'de') ORDER BY doc_id LIMIT {SAMPLE_LIMIT}""",
)
def q_sample_limit(spark, sf):
    docs = table(spark, sf, "documents").filter(F.col("lang").isin("fr", "de")).select("doc_id")
    return M.limit_samples(docs, ["doc_id"], SAMPLE_LIMIT)

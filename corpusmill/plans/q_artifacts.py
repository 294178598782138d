"""Queries: artifact lookup, coverage, all-or-none, pending work, routing, skip policy,
quality issues, type / dataset counts.

Stand-ins: a document's sample type comes from its language (en/es -> lm, fr ->
math_tool, de -> code); ``labels`` is the artifact table (family math when quality=1
else code; ``.npy`` valid unless toxic; toxic high-quality rows also have a valid
``.pt`` which takes precedence).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.functions import ids as I
from corpusmill.operators import artifacts as A
from corpusmill.operators import scoring as S
from corpusmill.operators.mixing import assign_batches
from corpusmill.operators.ordinals import with_ordinal
from corpusmill.plans.catalog import register, table

BATCH = 8

_TYPE = "CASE lang WHEN 'fr' THEN 'math_tool' WHEN 'de' THEN 'code' ELSE 'lm' END"
_FAMILY = "CASE lang WHEN 'fr' THEN 'math' WHEN 'de' THEN 'code' END"


def samples(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.select(
        F.col("doc_id").alias("sample_id"), "source", "text", F.expr(_TYPE).alias("sample_type"), F.expr(_FAMILY).alias("family")
    )


def artifact_table(spark, sf):
    lab = table(spark, sf, "labels")
    npy = lab.select(
        F.col("doc_id").alias("sample_id"),
        F.when(F.col("quality") == 1, F.lit("math")).otherwise(F.lit("code")).alias("family"),
        F.lit(".npy").alias("format"),
        (F.col("toxic") == 0).alias("valid"),
        F.round((F.col("doc_id") % 13) / 13.0, 6).alias("score"),
    )
    pt = lab.filter((F.col("toxic") == 1) & (F.col("quality") == 1)).select(
        F.col("doc_id").alias("sample_id"),
        F.lit("math").alias("family"),
        F.lit(".pt").alias("format"),
        F.lit(True).alias("valid"),
        F.lit(0.5).alias("score"),
    )
    return npy.unionByName(pt)


_ART_SQL = f"""
WITH s AS (SELECT doc_id AS sample_id, source, text, {_TYPE} AS sample_type, {_FAMILY} AS family FROM documents),
a AS (SELECT doc_id AS sample_id, CASE WHEN quality = 1 THEN 'math' ELSE 'code' END AS family, '.npy' AS format,
             toxic = 0 AS valid, round((doc_id % 13) / 13.0, 6) AS score, 2 AS rk FROM labels
      UNION ALL SELECT doc_id, 'math', '.pt', TRUE, 0.5, 1 FROM labels WHERE toxic = 1 AND quality = 1),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sample_id, family ORDER BY rk) AS r FROM a) WHERE r = 1),
l AS (SELECT s.*, CASE WHEN s.family IS NULL THEN 'disabled' WHEN best.sample_id IS NULL THEN 'missing'
                       WHEN NOT best.valid THEN 'invalid' ELSE 'ok' END AS status,
             best.score AS raw_score
      FROM s LEFT JOIN best ON best.sample_id = s.sample_id AND best.family = s.family),
lk AS (SELECT *, CASE WHEN status = 'ok' THEN raw_score END AS score FROM l)
"""


def looked_up(spark, sf):
    return A.lookup(samples(spark, sf), artifact_table(spark, sf), payload_cols=("score",))


@register(
    "artifact_lookup",
    _ART_SQL + "SELECT sample_id, sample_type, status, score FROM lk",
)
def q_artifact_lookup(spark, sf):
    return looked_up(spark, sf).select("sample_id", "sample_type", "status", "score")


_ARTIFACT_PATH = """CASE WHEN doc_id % 4 = 3 THEN 'logits/' ELSE 'gs://logits/' END || coalesce(source, '') || '/é-' || doc_id || '.npy'"""


@register(
    "artifact_cache_names",
    f"""SELECT doc_id, CASE WHEN doc_id % 4 = 3 THEN p ELSE md5(p) || '.npy' END AS name
        FROM (SELECT doc_id, {_ARTIFACT_PATH} AS p FROM documents)""",
)
def q_artifact_cache_names(spark, sf):
    """Names under which artifacts are cached: md5 of remote paths."""
    docs = table(spark, sf, "documents").select("doc_id", F.expr(_ARTIFACT_PATH).alias("path"))
    return docs.select("doc_id", I.cache_name("path", ".npy").alias("name"))


@register(
    "artifact_coverage",
    _ART_SQL
    + """, c AS (SELECT CAST(count(*) FILTER (WHERE status <> 'disabled') AS BIGINT) AS total,
                 CAST(count(*) FILTER (WHERE status IN ('missing', 'invalid')) AS BIGINT) AS missing FROM lk)
SELECT total, missing, round(CASE WHEN total > 0 THEN missing / total ELSE 0.0 END, 6) AS missing_ratio,
       (CASE WHEN total > 0 THEN missing / total ELSE 0.0 END) > 0.1 AS warn FROM c""",
)
def q_artifact_coverage(spark, sf):
    c = A.coverage(looked_up(spark, sf))
    return c.select("total", "missing", F.round("missing_ratio", 6).alias("missing_ratio"), "warn")


@register(
    "artifact_all_or_none",
    _ART_SQL
    + f"""SELECT CAST(sample_id // {BATCH} AS BIGINT) AS batch_id, CAST(count(*) AS BIGINT) AS requested,
       CAST(CASE WHEN bool_and(status = 'ok') THEN count(*) ELSE 0 END AS BIGINT) AS returned
FROM lk WHERE family IS NOT NULL GROUP BY sample_id // {BATCH}""",
)
def q_artifact_all_or_none(spark, sf):
    lk = looked_up(spark, sf).filter(F.col("family").isNotNull())
    lk = lk.withColumn("batch_id", F.floor(F.col("sample_id") / BATCH).cast("bigint"))
    r = A.all_or_none(lk, ["batch_id"], "score")
    return r.groupBy("batch_id").agg(
        F.count(F.lit(1)).cast("bigint").alias("requested"),
        F.count_if(F.col("request_complete")).cast("bigint").alias("returned"),
    )


_PENDING_SQL = f"""
WITH s AS (SELECT doc_id AS sample_id, {_FAMILY} AS family FROM documents WHERE {_FAMILY} IS NOT NULL),
a AS (SELECT doc_id AS sample_id, CASE WHEN quality = 1 THEN 'math' ELSE 'code' END AS family FROM labels
      UNION ALL SELECT doc_id, 'math' FROM labels WHERE toxic = 1 AND quality = 1),
p AS (SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.sample_id = s.sample_id AND a.family = s.family))
"""


def _scorable(spark, sf):
    return samples(spark, sf).filter(F.col("family").isNotNull()).select("sample_id", "family")


@register("pending_scores", _PENDING_SQL + "SELECT sample_id, family FROM p")
def q_pending_scores(spark, sf):
    return A.pending(_scorable(spark, sf), artifact_table(spark, sf))


@register(
    "pending_counters",
    _PENDING_SQL
    + "SELECT CAST((SELECT count(*) FROM p) AS BIGINT) AS processed, CAST((SELECT count(*) FROM s) - (SELECT count(*) FROM p) AS BIGINT) AS skipped",
)
def q_pending_counters(spark, sf):
    return A.pending_counters(_scorable(spark, sf), artifact_table(spark, sf))


@register(
    "score_route",
    _ART_SQL
    + """SELECT sample_id,
  CASE WHEN score IS NOT NULL THEN 'precomputed' WHEN sample_type = 'lm' THEN 'online' ELSE 'none' END AS score_source,
  round(CASE WHEN score IS NOT NULL THEN score WHEN sample_type = 'lm' THEN (length(text) % 97) / 97.0 END, 6) AS teacher_score
FROM lk""",
)
def q_score_route(spark, sf):
    routed = A.route_scores(looked_up(spark, sf), "sample_type", "score", S.scorer(S.stub_length_scorer, "text"))
    return routed.select("sample_id", "score_source", F.round("teacher_score", 6).alias("teacher_score"))


def _skip_sql(mode: str) -> str:
    strict = "TRUE" if mode == "strict" else "FALSE"
    return f"""SELECT '{mode}' AS mode, sample_id, batch_id, status, skip_kd, score IS NOT NULL AND NOT skip_kd AS has_score
FROM (SELECT *, bool_or({strict} AND status = 'missing' AND sample_type IN ('math_tool', 'code'))
                  OVER (PARTITION BY batch_id) AS skip_kd FROM b)"""


@register(
    "skip_policy",
    _ART_SQL
    + f", b AS (SELECT *, CAST((row_number() OVER (ORDER BY sample_id) - 1) // {BATCH} AS BIGINT) AS batch_id FROM lk)\n"
    + " UNION ALL ".join(_skip_sql(m) for m in ("strict", "lenient")),
)
def q_skip_policy(spark, sf):
    # the ids are those of the samples, so the ranges are drawn from these without a look-up
    ids = samples(spark, sf).select("sample_id")
    lk = with_ordinal(looked_up(spark, sf), "sample_id", name="pos", sample_from=ids)
    both = A.skip_policies(assign_batches(lk, "pos", BATCH), ["batch_id"], "sample_type", "score")
    return both.select("mode", "sample_id", "batch_id", "status", "skip_kd", F.col("score").isNotNull().alias("has_score"))


@register(
    "quality_issues",
    _ART_SQL
    + """, iss AS (SELECT 'missing' AS kind, family AS issue_key, sample_id FROM lk WHERE status = 'missing'
               UNION ALL SELECT 'invalid', 'shape:' || family, sample_id FROM lk WHERE status = 'invalid')
SELECT kind, issue_key, min(sample_id) AS sample_id, CAST(count(*) AS BIGINT) AS occurrences FROM iss GROUP BY kind, issue_key""",
)
def q_quality_issues(spark, sf):
    lk = looked_up(spark, sf)
    miss = lk.filter(F.col("status") == "missing").select(F.lit("missing").alias("kind"), F.col("family").alias("issue_key"), "sample_id")
    bad = lk.filter(F.col("status") == "invalid").select(
        F.lit("invalid").alias("kind"), F.concat(F.lit("shape:"), F.col("family")).alias("issue_key"), "sample_id"
    )
    iss = miss.unionByName(bad)
    return A.first_issue_per_key(iss, ["kind", "issue_key"], "sample_id", [])


@register(
    "type_counts",
    f"SELECT {_TYPE} AS sample_type, CAST(count(*) AS BIGINT) AS n FROM documents WHERE text IS NOT NULL AND text <> '' GROUP BY 1",
)
def q_type_counts(spark, sf):
    s = samples(spark, sf).filter((F.col("text").isNotNull()) & (F.col("text") != ""))
    return s.groupBy("sample_type").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


@register(
    "dataset_counts",
    "SELECT source AS dataset_key, CAST(count(*) AS BIGINT) AS n FROM documents WHERE text IS NOT NULL AND text <> '' GROUP BY 1",
)
def q_dataset_counts(spark, sf):
    s = samples(spark, sf).filter((F.col("text").isNotNull()) & (F.col("text") != ""))
    return s.groupBy(F.col("source").alias("dataset_key")).agg(F.count(F.lit(1)).cast("bigint").alias("n"))

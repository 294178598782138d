"""Queries: normalisation, ids, dedup, shards, field extraction, templates."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.functions import ids as I
from corpusmill.functions import text as T
from corpusmill.operators.dedup import dedup_keep_first, shard_summary
from corpusmill.plans import duck as D
from corpusmill.plans.catalog import dirty, register, table
from corpusmill.operators.ordinals import with_ordinal
from corpusmill.plans.recipes import corpus_summary, number_records, prepare_corpus

SUMMARY_SHARD_SIZE = 16  # small shards so that every source spans several


@register(
    "normalize_text",
    f"""
SELECT doc_id, t AS text, CAST(length(t) AS BIGINT) AS n_chars
FROM (SELECT doc_id, {D.normalize(D.dirty('text'))} AS t FROM documents)
WHERE t IS NOT NULL
""",
)
def q_normalize_text(spark, sf):
    docs = table(spark, sf, "documents")
    out = T.with_normalized(docs.select("doc_id", dirty("text").alias("raw")), "raw", "text").drop("raw")
    return out.withColumn("n_chars", F.length("text").cast("bigint"))


@register(
    "normalize_code",
    f"""
SELECT doc_id, t AS text, CAST(length(t) AS BIGINT) AS n_chars
FROM (SELECT doc_id, {D.normalize(D.dirty('text'), 5, False)} AS t FROM documents)
WHERE t IS NOT NULL
""",
)
def q_normalize_code(spark, sf):
    docs = table(spark, sf, "documents")
    raw = docs.select("doc_id", dirty("text").alias("raw"))
    out = T.with_normalized(raw, "raw", "text", T.CODE_MIN_LENGTH, collapse_whitespace=False).drop("raw")
    return out.withColumn("n_chars", F.length("text").cast("bigint"))


_VALID_SRC = "CASE WHEN turn % 5 = 3 THEN NULL WHEN turn % 5 = 4 THEN '' ELSE text END"


@register(
    "valid_text",
    f"""
SELECT conv_id, turn, role, CAST(length(t) AS BIGINT) AS n_chars
FROM (SELECT conv_id, turn, role, {_VALID_SRC} AS t FROM conversations)
WHERE t IS NOT NULL AND t <> ''
""",
)
def q_valid_text(spark, sf):
    conv = table(spark, sf, "conversations").withColumn("t", F.expr(_VALID_SRC))
    return conv.filter(T.is_valid_text("t")).select(
        "conv_id", "turn", "role", F.length("t").cast("bigint").alias("n_chars")
    )


@register(
    "sample_ids",
    f"""
WITH d AS (SELECT doc_id, source, text,
                  row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS ri FROM documents),
n AS (SELECT doc_id, source, ri, {D.normalize(D.dirty('text'))} AS t FROM d)
SELECT doc_id, source, CAST(ri AS BIGINT) AS record_index, {D.sample_id('source', 'ri', 't')} AS sample_id
FROM n WHERE t IS NOT NULL
""",
)
def q_sample_ids(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source", "text")
    numbered = number_records(docs, "source", "doc_id")
    cleaned = T.with_normalized(numbered, dirty("text"), "t")
    return cleaned.select(
        "doc_id", "source", "record_index", I.sample_id("source", "record_index", "t").alias("sample_id")
    )


_FB_ID = "CASE WHEN doc_id % 3 = 0 THEN NULL WHEN doc_id % 7 = 0 THEN '' ELSE 'doc-' || CAST(doc_id AS VARCHAR) END"
_FB_SHA = "CASE WHEN doc_id % 2 = 0 THEN NULL ELSE lang END"


def _fallback_frame(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.select(
        "doc_id",
        "source",
        F.expr(_FB_ID.replace("VARCHAR", "STRING")).alias("sid"),
        F.concat(F.lit("s3://corpus/"), F.col("source"), F.lit("/part.jsonl")).alias("path"),
        F.expr(_FB_SHA).alias("sha"),
        "text",
    ).withColumn("sample_id", I.fallback_sample_id("sid", "path", "sha", "text"))


_FB_SQL = f"""
WITH p AS (SELECT doc_id, source, {_FB_ID} AS sid, 's3://corpus/' || source || '/part.jsonl' AS path,
                  {_FB_SHA} AS sha, text FROM documents),
s AS (SELECT doc_id, source, CASE WHEN coalesce(sid, '') = '' THEN
          'auto_' || sha1(path || ':' || coalesce(sha, '') || ':' || substring(text, 1, 200)) ELSE sid END AS sample_id
      FROM p)
"""


@register(
    "fallback_ids",
    _FB_SQL + "SELECT doc_id, sample_id, starts_with(sample_id, 'auto_') AS is_auto FROM s",
)
def q_fallback_ids(spark, sf):
    return _fallback_frame(spark, sf).select("doc_id", "sample_id", I.is_auto_id("sample_id").alias("is_auto"))


@register(
    "auto_id_counts",
    _FB_SQL
    + """SELECT source AS dataset_key, CAST(count(*) FILTER (WHERE starts_with(sample_id, 'auto_')) AS BIGINT) AS n_auto,
       CAST(count(*) AS BIGINT) AS n_total FROM s GROUP BY source""",
)
def q_auto_id_counts(spark, sf):
    return (
        _fallback_frame(spark, sf)
        .groupBy(F.col("source").alias("dataset_key"))
        .agg(
            F.count_if(I.is_auto_id("sample_id")).cast("bigint").alias("n_auto"),
            F.count(F.lit(1)).cast("bigint").alias("n_total"),
        )
    )


@register(
    "dedup_global",
    f"""
WITH n AS (SELECT doc_id, {D.normalize('text')} AS t FROM documents),
h AS (SELECT doc_id, sha1(t) AS text_sha1 FROM n WHERE t IS NOT NULL)
SELECT doc_id, text_sha1 FROM (
  SELECT *, row_number() OVER (PARTITION BY text_sha1 ORDER BY doc_id) AS rn FROM h) WHERE rn = 1
""",
)
def q_dedup_global(spark, sf):
    docs = table(spark, sf, "documents")
    h = T.with_normalized(docs.select("doc_id", "text"), "text", "t").select("doc_id", I.text_hash("t").alias("text_sha1"))
    return dedup_keep_first(h, "text_sha1", "doc_id")


_PREP_SQL = f"""
WITH d AS (SELECT doc_id, source, text,
                  row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS ri FROM documents),
n AS (SELECT doc_id, source, ri, {D.normalize(D.dirty('text'))} AS t FROM d),
f AS (SELECT *, sha1(t) AS h FROM n WHERE t IS NOT NULL),
u AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source, h ORDER BY ri) AS k FROM f) WHERE k = 1),
s AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY ri) - 1 AS pos FROM u)
"""


def prepared_documents(spark, sf, keep_text=True):
    docs = table(spark, sf, "documents").select("doc_id", "source", F.col("text"))
    docs = docs.withColumn("text", dirty("text"))
    return prepare_corpus(docs, "source", "doc_id", max_records=SUMMARY_SHARD_SIZE, keep_text=keep_text)


@register(
    "shard_assign",
    _PREP_SQL
    + f"""SELECT doc_id, source, {D.sample_id('source', 'ri', 't')} AS sample_id, CAST(pos AS BIGINT) AS shard_pos,
       CAST(pos // {SUMMARY_SHARD_SIZE} AS BIGINT) AS shard FROM s""",
)
def q_shard_assign(spark, sf):
    prepared = prepared_documents(spark, sf, keep_text=False)
    return prepared.select("doc_id", "source", "sample_id", "shard_pos", "shard")


@register(
    "shard_assign_summary",
    _PREP_SQL
    + f"""SELECT source, CAST(count(*) AS BIGINT) AS records,
       CAST(max(pos // {SUMMARY_SHARD_SIZE}) + 1 AS BIGINT) AS shards,
       {D.shard_name(f'min(pos // {SUMMARY_SHARD_SIZE})')} AS first_shard,
       {D.shard_name(f'max(pos // {SUMMARY_SHARD_SIZE})')} AS last_shard
FROM s GROUP BY source""",
)
def q_shard_assign_summary(spark, sf):
    docs = table(spark, sf, "documents").select("source", dirty("text").alias("text"))
    return corpus_summary(docs, "source", max_records=SUMMARY_SHARD_SIZE)


@register(
    "shard_layout_summary",
    _PREP_SQL
    + f"""SELECT source, CAST(count(*) AS BIGINT) AS records,
       CAST(max(pos // {SUMMARY_SHARD_SIZE}) + 1 AS BIGINT) AS shards,
       {D.shard_name(f'min(pos // {SUMMARY_SHARD_SIZE})')} AS first_shard,
       {D.shard_name(f'max(pos // {SUMMARY_SHARD_SIZE})')} AS last_shard
FROM s GROUP BY source""",
)
def q_shard_layout_summary(spark, sf):
    """The same summary read off the full row-level layout (ordinals, ids, dedup, shards)."""
    return shard_summary(prepared_documents(spark, sf, keep_text=False), ["source"])


_FT_FIELDS = {
    "code": "CASE WHEN turn % 3 = 0 THEN text WHEN turn % 3 = 1 THEN '' END",
    "func_code": "CASE WHEN turn % 2 = 0 THEN '' ELSE substring(text, 1, 20) END",
    "original_string": "CASE WHEN role = 'user' THEN text END",
    "content": "text || '!'",
}


@register(
    "first_truthy_field",
    "SELECT conv_id, turn, sha1(v) AS value_sha1, CAST(length(v) AS BIGINT) AS n_chars FROM ("
    "SELECT conv_id, turn, coalesce("
    + ", ".join(f"nullif({e}, '')" for e in _FT_FIELDS.values())
    + ") AS v FROM conversations)",
)
def q_first_truthy_field(spark, sf):
    conv = table(spark, sf, "conversations")
    fields = [F.expr(e).alias(k) for k, e in _FT_FIELDS.items()]
    v = conv.select("conv_id", "turn", *fields).withColumn("v", T.first_truthy(*T.CODE_FIELDS))
    return v.select("conv_id", "turn", I.sha1_hex("v").alias("value_sha1"), F.length("v").cast("bigint").alias("n_chars"))


@register(
    "qa_template",
    f"""
WITH q AS (SELECT conv_id, turn, text FROM conversations WHERE role = 'user'),
a AS (SELECT conv_id, turn, text FROM conversations WHERE role = 'assistant'),
j AS (SELECT q.conv_id, q.turn,
             CASE WHEN a.text IS NOT NULL AND a.text <> '' THEN q.text || chr(10) || chr(10) || 'Answer: ' || a.text
                  ELSE q.text END AS raw
      FROM q LEFT JOIN a ON a.conv_id = q.conv_id AND a.turn = q.turn + 1),
n AS (SELECT conv_id, turn, {D.normalize('raw', 5)} AS t FROM j)
SELECT conv_id, turn, t AS text FROM n WHERE t IS NOT NULL
""",
)
def q_qa_template(spark, sf):
    conv = table(spark, sf, "conversations")
    q = conv.filter(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("question"))
    a = conv.filter(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer")
    )
    j = q.join(a, ["conv_id", "turn"], "left")
    raw = j.select("conv_id", "turn", T.qa_text("question", "answer").alias("raw"))
    return T.with_normalized(raw, "raw", "text", 5).drop("raw")


@register(
    "problem_template",
    f"""
WITH q AS (SELECT conv_id, turn, text FROM conversations WHERE role = 'user'),
b AS (SELECT conv_id, turn, text FROM conversations),
j AS (SELECT q.conv_id, q.turn, coalesce(b.text, '') || chr(10) || chr(10) || 'Q: ' || q.text || chr(10) || 'A:' AS raw
      FROM q LEFT JOIN b ON b.conv_id = q.conv_id AND b.turn = q.turn - 1),
n AS (SELECT conv_id, turn, {D.normalize('raw', 5)} AS t FROM j)
SELECT conv_id, turn, t AS text FROM n WHERE t IS NOT NULL
""",
)
def q_problem_template(spark, sf):
    conv = table(spark, sf, "conversations")
    q = conv.filter(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("question"))
    b = conv.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("body"))
    j = q.join(b, ["conv_id", "turn"], "left")
    raw = j.select("conv_id", "turn", T.problem_text("body", "question").alias("raw"))
    return T.with_normalized(raw, "raw", "text", 5).drop("raw")


SHARD_DEDUP_SIZE = 50

# Oracle: the sequential shard rule as a recursive CTE over shard starts.
_SHARDED_SQL = f"""
WITH RECURSIVE n AS (SELECT doc_id, sha1(t) AS h FROM (SELECT doc_id, {D.normalize('text')} AS t FROM documents) WHERE t IS NOT NULL),
p AS (SELECT doc_id, h, row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM n),
q AS (SELECT doc_id, pos, h, lag(pos) OVER (PARTITION BY h ORDER BY pos) AS prev FROM p),
b(k, start) AS (
  SELECT 0, 0
  UNION ALL
  SELECT b.k + 1, (SELECT min(x.pos) FROM (SELECT q.pos, row_number() OVER (ORDER BY q.pos) AS rn FROM q
                    WHERE q.pos >= b.start AND (q.prev IS NULL OR q.prev < b.start)) x WHERE x.rn = {SHARD_DEDUP_SIZE + 1})
  FROM b WHERE b.start IS NOT NULL
),
bounds AS (SELECT k, start, coalesce(lead(start) OVER (ORDER BY k), (SELECT max(pos) + 1 FROM q)) AS stop FROM b WHERE start IS NOT NULL)
SELECT q.doc_id, CAST(bounds.k AS BIGINT) AS shard FROM q JOIN bounds ON q.pos >= bounds.start AND q.pos < bounds.stop
WHERE q.prev IS NULL OR q.prev < bounds.start
"""


@register("dedup_sharded", _SHARDED_SQL)
def q_dedup_sharded(spark, sf):
    """Shard-scoped exact dedup (writer order = doc_id, shards of 50 accepted rows)."""
    from corpusmill.operators.sharded_dedup import sharded_dedup
    from corpusmill.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    docs = table(spark, sf, "documents").select("doc_id", "text")
    # texts are normalised once; what follows reads ids and hashes in several phases
    clean = T.with_normalized(docs, "text", "t").select("doc_id", I.text_hash("t").alias("h")).checkpoint()
    pos = with_ordinal(clean, "doc_id", name="pos")
    out = sharded_dedup(pos.withColumn("ds", F.lit("documents")), "ds", "pos", "h", SHARD_DEDUP_SIZE)
    return out.select("doc_id", "shard")

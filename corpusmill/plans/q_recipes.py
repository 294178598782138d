"""Queries: the composed recipes over record files in several formats.

Each source is a manifest entry (order = its number, declared type from the language of
the entry's number); its documents are written as JSON lines, gzip or Parquet with a record
path, some with their own id or type, and read back by format dispatch, in entry order."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.functions import ids as I
from corpusmill.plans import recipes as R
from corpusmill.plans.catalog import register, table
from corpusmill.session import scratch_dir
from corpusmill.sources import files as S

WORKERS, BATCH, SEQ_LEN = 3, 8, 64
_N = "CAST(substring(source, 4) AS INT)"
_ENTRY_TYPE = f"(CASE {_N} % 3 WHEN 0 THEN 'lm' WHEN 1 THEN 'math' ELSE 'code' END)"
_RECORD = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        *(T.StructField(c, T.StringType()) for c in ("text", "type", "sample_id", "path", "sha", "source")),
    ]
)


def word_lengths():
    """Tokenizer for the queries: a word's id is its length."""
    return lambda texts: [[len(w) for w in t.split()] for t in texts]


def records(spark, sf):
    base = scratch_dir(spark, "recipe-records")
    docs = table(spark, sf, "documents").select("doc_id", "text", "source").withColumn("n", F.expr(_N))
    call = F.format_string('CALL calculator: "%d + 1"\n', "doc_id")
    docs = docs.select(
        "doc_id",
        F.concat(call, "text").alias("text"),
        F.when(F.col("doc_id") % 7 == 0, F.lit("lm")).alias("type"),
        F.when(F.col("doc_id") % 5 == 0, F.format_string("doc-%d", "doc_id")).alias("sample_id"),
        F.format_string("corpus/%s/%d", "source", "doc_id").alias("path"),
        F.when(F.col("doc_id") % 2 == 0, F.sha1(F.col("source").cast("binary"))).alias("sha"),
        "source",
        "n",
    )
    parts = []
    for k, (fmt, options, suffix) in enumerate((("json", {}, "*.json"), ("json", {"compression": "gzip"}, "*.gz"), ("parquet", {}, "*.parquet"))):
        docs.filter(F.col("n") % 3 == k).drop("n").write.options(**options).format(fmt).save(f"{base}/{k}")
        parts.append(S.read_records(spark, [f"{base}/{k}/{suffix}"], _RECORD))
    out = S.union_inputs(parts).withColumn("entry_ord", F.expr(_N)).withColumn("entry_type", F.expr(_ENTRY_TYPE))
    return out.withColumn("dataset_id", F.col("source"))


def teacher(spark, sf):
    """Stored scores by id: a square matrix, or ragged rows for toxic documents."""
    lab = table(spark, sf, "labels").filter("doc_id % 5 = 0")
    row = F.array(F.lit(0.5), F.lit(1.5))
    scores = F.when(F.col("toxic") == 0, F.array(row, row)).otherwise(F.array(row, F.array(F.lit(1.0))))
    family = F.when(F.col("quality") == 1, "math").otherwise("code")
    return lab.select(F.format_string("doc-%d", "doc_id").alias("sample_id"), family.alias("family"), F.lit(".npy").alias("format"), scores.alias("scores"))


_SAMPLES_SQL = f"""
WITH r AS (
  SELECT doc_id, source, {_N} AS n, 'CALL calculator: "' || doc_id || ' + 1"' || chr(10) || text AS raw,
         CASE coalesce(CASE WHEN doc_id % 7 = 0 THEN 'lm' END, {_ENTRY_TYPE}) WHEN 'math' THEN 'math_tool' WHEN 'code' THEN 'code' ELSE 'lm' END AS sample_type,
         'corpus/' || source || '/' || doc_id AS path, CASE WHEN doc_id % 2 = 0 THEN sha1(source) ELSE '' END AS sha
  FROM documents WHERE text IS NOT NULL),
i AS (SELECT *, CASE WHEN sample_type = 'math_tool' THEN
        'CALL calculator: "' || doc_id || ' + 1"' || chr(10) || 'RESULT: ' || (doc_id + 1) || substring(regexp_replace(raw, '\\n$', ''), strpos(raw, chr(10)))
        ELSE raw END AS t FROM r),
x AS (SELECT *, CASE WHEN doc_id % 5 = 0 THEN 'doc-' || doc_id ELSE 'auto_' || sha1(path || ':' || sha || ':' || substring(t, 1, 200)) END AS sample_id,
        CASE sample_type WHEN 'math_tool' THEN 'math' WHEN 'code' THEN 'code' END AS family FROM i),
a AS (SELECT 'doc-' || doc_id AS aid, CASE WHEN quality = 1 THEN 'math' ELSE 'code' END AS af, toxic = 0 AS ok FROM labels WHERE doc_id % 5 = 0),
s AS (SELECT x.*, CASE WHEN family IS NULL THEN 'disabled' WHEN aid IS NULL THEN 'missing' WHEN ok THEN 'ok' ELSE 'invalid' END AS status
      FROM x LEFT JOIN a ON sample_id = aid AND family = af)
"""


@register(
    "mixture_to_batches",
    _SAMPLES_SQL
    + f""", o AS (SELECT *, n % {WORKERS} AS worker, row_number() OVER (PARTITION BY n ORDER BY doc_id) AS rr FROM s),
p AS (SELECT *, row_number() OVER (PARTITION BY worker ORDER BY rr, n) - 1 AS pos FROM o),
w AS (SELECT *, list_transform(regexp_extract_all(t, '[^ \\t\\n\\x0b\\f\\r]+')[1:{SEQ_LEN}], lambda y: CAST(length(y) AS VARCHAR)) AS ids FROM p)
SELECT CAST(worker AS INT) AS worker, CAST(pos // {BATCH} AS BIGINT) AS batch_id, CAST(count(*) AS BIGINT) AS size,
       string_agg(sample_id || '/' || sample_type || '/' || status || '/' || array_to_string(ids, '.'), ',' ORDER BY pos) AS samples
FROM w GROUP BY 1, 2""",
)
def q_mixture_to_batches(spark, sf):
    samples = R.training_samples(records(spark, sf), teacher(spark, sf), word_lengths, SEQ_LEN)
    fields = ["sample_id", "sample_type", "status", "input_ids", "attention_mask"]
    batches = R.mixture_to_batches(samples, "entry_ord", "doc_id", WORKERS, BATCH, fields)
    real = lambda r: F.slice(r["input_ids"], 1, F.array_size(F.filter(r["attention_mask"], lambda m: m == 1)))
    ids = lambda r: F.array_join(F.transform(real(r), lambda i: i.cast("string")), ".")
    shown = F.transform("rows", lambda r: F.concat_ws("/", r["sample_id"], r["sample_type"], r["status"], ids(r)))
    return batches.select(F.col("worker").cast("int").alias("worker"), "batch_id", "size", F.array_join(shown, ",").alias("samples"))


def _length_score():
    return lambda texts: texts.str.len().astype("float64")


@register(
    "incremental_scoring",
    """
WITH r AS (
  SELECT doc_id, source, 'CALL calculator: "' || doc_id || ' + 1"' || chr(10) || text AS t,
         CASE coalesce(CASE WHEN doc_id % 7 = 0 THEN 'lm' END, """
    + _ENTRY_TYPE
    + """) WHEN 'math' THEN 'math' WHEN 'code' THEN 'code' END AS family,
         'corpus/' || source || '/' || doc_id AS path, CASE WHEN doc_id % 2 = 0 THEN sha1(source) ELSE '' END AS sha
  FROM documents WHERE text IS NOT NULL)
SELECT CASE WHEN doc_id % 5 = 0 THEN 'doc-' || doc_id ELSE 'auto_' || sha1(path || ':' || sha || ':' || substring(t, 1, 200)) END AS sample_id,
       family, CAST(length(t) AS DOUBLE) AS score, 0 AS processed_again
FROM r WHERE family IS NOT NULL""",
)
def q_incremental_scoring(spark, sf):
    """Half of the records scored, then all, then all again: every one has one score and the
    last run processes nothing."""
    store = f"{scratch_dir(spark, 'recipe-scores')}/artifacts"
    all_records = records(spark, sf)
    R.incremental_scoring(all_records.filter("doc_id % 2 = 0"), store, _length_score)
    R.incremental_scoring(all_records, store, _length_score)
    again = R.incremental_scoring(all_records, store, _length_score).first().processed
    return spark.read.parquet(store).select("sample_id", "family", "score", F.lit(again).cast("bigint").alias("processed_again"))

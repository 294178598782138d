"""Queries: interleave, worker striping, batches, collation, mixture sampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.functions.ids import unit_hash
from corpusmill.operators import mixing as X
from corpusmill.plans import duck as D
from corpusmill.plans.catalog import register, table

_N = "CAST(substring(source, 4) AS INT)"
NUM_WORKERS = 3
BATCH = 8
EPOCH_BATCH_LIMIT = 3


def _docs(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "source", "lang").withColumn("n", F.expr(_N))


@register(
    "interleave",
    f"""
WITH d AS (SELECT doc_id, source, {_N} AS n,
                  row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS rr FROM documents)
SELECT doc_id, source, CAST(rr AS BIGINT) AS rr_round,
       CAST(row_number() OVER (ORDER BY rr, n) - 1 AS BIGINT) AS position FROM d
""",
)
def q_interleave(spark, sf):
    out = X.interleave(_docs(spark, sf), "source", "n", "doc_id")
    return out.select("doc_id", "source", "rr_round", "position")


_WORKER_SQL = f"""
WITH d AS (SELECT doc_id, source, lang, {_N} AS n, {_N} % {NUM_WORKERS} AS worker,
                  row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS rr FROM documents),
p AS (SELECT *, row_number() OVER (PARTITION BY worker ORDER BY rr, n) - 1 AS pos FROM d),
b AS (SELECT *, pos // {BATCH} AS batch_id FROM p)
"""


def _worker_batches(spark, sf):
    docs = X.stripe_workers(_docs(spark, sf), NUM_WORKERS, entry_ord_col="n")
    il = X.interleave(docs, "source", "n", "doc_id", scope_cols=["worker"], position_col="pos")
    return X.assign_batches(il, "pos", BATCH)


@register(
    "worker_stripe_batches",
    _WORKER_SQL
    + """SELECT CAST(worker AS INT) AS worker, CAST(batch_id AS BIGINT) AS batch_id, CAST(count(*) AS BIGINT) AS size,
       string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY pos) AS doc_ids, bool_or(lang = 'de') AS any_flag
FROM b GROUP BY worker, batch_id""",
)
def q_worker_stripe_batches(spark, sf):
    b = _worker_batches(spark, sf).withColumn("flag", F.col("lang") == "de")
    c = X.collate(b, ["worker", "batch_id"], "pos", ["doc_id"], flag_col="flag")
    return c.select(
        F.col("worker").cast("int").alias("worker"),
        "batch_id",
        "size",
        F.array_join(F.transform("rows", lambda r: r["doc_id"].cast("string")), ",").alias("doc_ids"),
        "any_flag",
    )


@register(
    "batch_limit",
    _WORKER_SQL
    + f"""SELECT CAST(worker AS INT) AS worker, CAST(batch_id AS BIGINT) AS batch_id, CAST(count(*) AS BIGINT) AS size
FROM b WHERE batch_id < {EPOCH_BATCH_LIMIT} GROUP BY worker, batch_id""",
)
def q_batch_limit(spark, sf):
    b = X.limit_batches(_worker_batches(spark, sf), EPOCH_BATCH_LIMIT)
    c = X.collate(b, ["worker", "batch_id"], "pos", ["doc_id"])
    return c.select(F.col("worker").cast("int").alias("worker"), "batch_id", "size")


_W = f"(0.25 * (1 + {_N} % 4))"


@register(
    "mixture_sample",
    f"""
SELECT doc_id, source FROM documents
WHERE {D.unit_hash("'doc-' || CAST(doc_id AS VARCHAR)")} < {_W}
""",
)
def q_mixture_sample(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source")
    d = docs.withColumn("sid", F.concat(F.lit("doc-"), F.col("doc_id").cast("string"))).withColumn("w", F.expr(_W))
    return X.mixture_sample(d, "sid", "w", 1.0).select("doc_id", "source")


@register(
    "mixture_report",
    f"""
WITH w AS (SELECT DISTINCT source, CAST({_W} AS DOUBLE) AS weight FROM documents),
s AS (SELECT source, count(*) AS n FROM documents
      WHERE {D.unit_hash("'doc-' || CAST(doc_id AS VARCHAR)")} < {_W} GROUP BY source),
j AS (SELECT w.source, w.weight, coalesce(s.n, 0) AS n FROM w LEFT JOIN s ON s.source = w.source)
SELECT source, CAST(n AS BIGINT) AS rows, round(weight / sum(weight) OVER (), 6) AS expected_share,
       round(n / sum(n) OVER (), 6) AS actual_share FROM j
""",
)
def q_mixture_report(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source")
    d = docs.withColumn("sid", F.concat(F.lit("doc-"), F.col("doc_id").cast("string"))).withColumn("w", F.expr(_W))
    sampled = d.filter(unit_hash("sid") < F.col("w"))
    weights = d.select("source", F.col("w").cast("double").alias("weight")).distinct()
    rep = X.mixture_report(sampled, weights, "source", "weight")
    return rep.select(
        "source", "rows", F.round("expected_share", 6).alias("expected_share"), F.round("actual_share", 6).alias("actual_share")
    )


@register(
    "type_snapshot",
    _WORKER_SQL
    + """SELECT CAST(worker AS INT) AS worker,
       CASE lang WHEN 'fr' THEN 'math_tool' WHEN 'de' THEN 'code' ELSE 'lm' END AS sample_type,
       CAST(count(*) AS BIGINT) AS n FROM b WHERE batch_id = 0 GROUP BY ALL""",
)
def q_type_snapshot(spark, sf):
    """Sample-type counts of each worker's first batch (the start-of-run snapshot)."""
    b = _worker_batches(spark, sf).filter(F.col("batch_id") == 0)
    t = F.when(F.col("lang") == "fr", "math_tool").when(F.col("lang") == "de", "code").otherwise("lm")
    return b.groupBy(F.col("worker").cast("int").alias("worker"), t.alias("sample_type")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n")
    )

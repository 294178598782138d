"""Streaming queries: each writes table-derived JSON files into a scratch inbox, runs the
incremental job to completion (availableNow) and returns the
sink's content, which must equal the batch result (same oracle SQL)."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.functions import ids as I
from corpusmill.functions import text as T
from corpusmill.operators import scoring as Sc
from corpusmill.operators.tools import scratchpad_note
from corpusmill.plans import duck as D
from corpusmill.plans.catalog import register, table
from corpusmill.plans.q_artifacts import _FAMILY, _PENDING_SQL, _TYPE, artifact_table
from corpusmill.plans.q_tools import _PAD_ARG, _note_sql
from corpusmill.session import scratch_dir
from corpusmill.streaming import incremental as ST

TURN_RANGES = 4
ALL_FILES = 1 << 30  # what has arrived is one micro-batch, however many files


def _inbox(df, folder: str, key):
    """JSON files of a size that Spark chooses, dealt by a key: more rows are more files, not
    larger tasks."""
    df.repartition(F.col(key)).write.mode("append").json(folder)


@register(
    "stream_ingest",
    f"""
WITH d AS (SELECT doc_id, source, text, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS ri FROM documents),
n AS (SELECT doc_id, source, ri, {D.normalize('text')} AS t FROM d)
SELECT doc_id, source, CAST(ri AS BIGINT) AS record_index, {D.sample_id('source', 'ri', 't')} AS sample_id, sha1(t) AS text_sha1
FROM n WHERE t IS NOT NULL
""",
)
def q_stream_ingest(spark, sf):
    """Files that arrive in two runs of the stream: the ids are those of the batch rule."""
    base = scratch_dir(spark, "stream_ingest")
    docs = table(spark, sf, "documents").select("doc_id", "source", "text")
    cut = docs.agg(F.percentile_approx("doc_id", 0.5)).first()[0] or 0
    numbers = ST.number_batches(f"{base}/counters", "source", "doc_id")

    def ingest(batch, batch_id):
        rows = T.with_normalized(numbers(batch, batch_id), "text", "text")
        return rows.select(
            "doc_id", "source", "record_index", I.sample_id("source", "record_index", "text").alias("sample_id"), I.text_hash("text").alias("text_sha1")
        )

    for arrived in (docs.filter(F.col("doc_id") <= cut), docs.filter(F.col("doc_id") > cut)):
        _inbox(arrived, f"{base}/in", "doc_id")
        s = ST.read_stream_jsonl(spark, f"{base}/in", "doc_id bigint, source string, text string", ALL_FILES)
        ST.run_foreach_batch(s, ST.write_batches(f"{base}/out", ingest), f"{base}/ckpt")
    return spark.read.parquet(f"{base}/out").drop("batch_id")


@register(
    "stream_dedup",
    f"""SELECT min(doc_id) AS doc_id, sha1(t) AS text_sha1
        FROM (SELECT doc_id, {D.normalize('text')} AS t FROM documents) WHERE t IS NOT NULL GROUP BY t""",
)
def q_stream_dedup(spark, sf):
    base = scratch_dir(spark, "stream_dedup")
    docs = table(spark, sf, "documents").select("doc_id", "text")
    _inbox(docs, f"{base}/in", "doc_id")
    s = ST.read_stream_jsonl(spark, f"{base}/in", "doc_id bigint, text string", ALL_FILES)
    cleaned = T.with_normalized(s, "text", "text").withColumn("text_sha1", I.text_hash("text")).select("doc_id", "text_sha1")
    ST.run_dedup(cleaned, "text_sha1", "doc_id", f"{base}/seen", f"{base}/ckpt")
    return spark.read.parquet(f"{base}/seen").select("doc_id", "text_sha1")


@register(
    "stream_scratchpad",
    f"""
WITH a AS (SELECT conv_id, turn, {_PAD_ARG} AS arg FROM conversations),
n AS (SELECT conv_id, turn, {_note_sql('arg')} AS note FROM a),
w AS (SELECT conv_id, turn, list(note) FILTER (note IS NOT NULL) OVER (PARTITION BY conv_id ORDER BY turn) AS notes FROM n)
SELECT conv_id, turn, sha1(coalesce(array_to_string(notes[-8:], chr(10)), '')) AS pad_sha1,
       CAST(least(coalesce(len(notes), 0), 8) AS BIGINT) AS n_notes FROM w
""",
)
def q_stream_scratchpad(spark, sf):
    base = scratch_dir(spark, "stream_pad")
    conv = table(spark, sf, "conversations").select("conv_id", "turn", F.expr(_PAD_ARG).alias("arg"))
    # the turn ranges arrive one after the other, the later turns first: they wait for the earlier ones
    rng = F.least(F.floor(F.col("turn") / 3), F.lit(TURN_RANGES - 1))
    for k in reversed(range(TURN_RANGES)):
        conv.filter(rng == k).write.mode("append").json(f"{base}/in")
        s = ST.read_stream_jsonl(spark, f"{base}/in", "conv_id bigint, turn bigint, arg string", ALL_FILES)
        notes = s.select("conv_id", "turn", scratchpad_note(F.col("arg")).alias("note"))
        ST.run_to_parquet(ST.scratchpad_stream(notes), f"{base}/out", f"{base}/ckpt")
    out = spark.read.parquet(f"{base}/out")
    return out.select("conv_id", "turn", I.sha1_hex("pad").alias("pad_sha1"), "n_notes")


@register("stream_score", _PENDING_SQL + "SELECT sample_id, family FROM p")
def q_stream_score(spark, sf):
    base = scratch_dir(spark, "stream_score")
    store = f"{base}/artifacts"
    artifact_table(spark, sf).select("sample_id", "family").write.partitionBy("family").parquet(store)
    docs = table(spark, sf, "documents").select(
        F.col("doc_id").alias("sample_id"), "text", F.expr(_TYPE).alias("sample_type"), F.expr(_FAMILY).alias("family")
    ).filter(F.col("family").isNotNull())
    _inbox(docs, f"{base}/in", "sample_id")
    s = ST.read_stream_jsonl(spark, f"{base}/in", "sample_id bigint, text string, sample_type string, family string", ALL_FILES)
    scorer = lambda df: Sc.score(df, Sc.stub_length_scorer, "text").select("sample_id", "family", "online_score")
    known = spark.readStream.schema("sample_id bigint, family string").parquet(store)
    ST.run_scoring(s, known, ["sample_id", "family"], scorer, f"{base}/scores", f"{base}/ckpt")
    return spark.read.parquet(f"{base}/scores").filter(F.col("online_score").isNotNull()).select("sample_id", "family")

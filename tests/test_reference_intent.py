"""The reference's own tests, restated on DataFrames (fixtures built in the test, as there)."""

from pyspark.sql import functions as F

from corpusmill.operators import artifacts as A
from corpusmill.operators import manifest as M
from corpusmill.operators.scoring import position_tokens


def _records(spark):
    # three one-record corpora of types lm, math_tool, code; text "<type> sample"
    return spark.createDataFrame(
        [("lm-1", "lm", "lm sample"), ("math-1", "math_tool", "math_tool sample"), ("code-1", "code", "code sample")],
        "sample_id string, type string, text string",
    )


def test_precompute_generates_only_math_and_code(spark):
    recs = M.filter_scorable(_records(spark)).withColumn("family", M.artifact_family(F.col("type")))
    empty = spark.createDataFrame([], "sample_id string, family string")
    pending = A.pending(recs, empty)
    got = sorted((r.sample_id, r.family) for r in pending.collect())
    assert got == [("code-1", "code"), ("math-1", "math")]


def test_position_tokenizer_double(spark):
    df = spark.createDataFrame([("a b c",)], "text string")
    ids, mask = position_tokens("text", 16)
    r = df.select(ids.alias("ids"), mask.alias("mask")).first()
    assert r.ids[:4] == [1, 2, 3, 0] and len(r.ids) == 16
    assert r.mask[:4] == [1, 1, 1, 0]


def _batch(spark, missing_for_math: bool):
    rows = [("lm-1", "lm", None), ("math-1", "math_tool", "math"), ("code-1", "code", "code")]
    samples = spark.createDataFrame(rows, "sample_id string, sample_type string, family string").withColumn("batch_id", F.lit(0))
    arts = [("code-1", "code", ".pt", True, 0.3)]
    if not missing_for_math:
        arts.append(("math-1", "math", ".pt", True, 0.2))
    artifacts = spark.createDataFrame(arts, "sample_id string, family string, format string, valid boolean, score double")
    return A.lookup(samples, artifacts, payload_cols=("score",))


def _recording_scorer(calls):
    def scorer(df):
        calls.extend(r.sample_id for r in df.select("sample_id").collect())
        return df.withColumn("online_score", F.lit(1.0))

    return scorer


def test_router_scores_only_lm_rows_online(spark):
    calls = []
    out = A.route_scores(_batch(spark, False), "sample_type", "score", _recording_scorer(calls))
    src = {r.sample_id: r.score_source for r in out.collect()}
    assert calls == ["lm-1"]
    assert src == {"lm-1": "online", "math-1": "precomputed", "code-1": "precomputed"}


def test_missing_logits_lenient_keeps_lm_scoring(spark):
    calls = []
    lk = A.skip_policy(_batch(spark, True), ["batch_id"], "sample_type", strict=False, payload_col="score")
    out = A.route_scores(lk, "sample_type", "score", _recording_scorer(calls), skip_col="skip_kd")
    assert calls == ["lm-1"]
    assert {r.sample_id: r.teacher_score is not None for r in out.collect()} == {"lm-1": True, "math-1": False, "code-1": True}


def test_missing_logits_strict_skips_whole_batch(spark):
    calls = []
    lk = A.skip_policy(_batch(spark, True), ["batch_id"], "sample_type", strict=True, payload_col="score")
    out = A.route_scores(lk, "sample_type", "score", _recording_scorer(calls), skip_col="skip_kd")
    assert calls == []
    assert all(r.teacher_score is None for r in out.collect())

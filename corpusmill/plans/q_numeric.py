"""Queries: tokenisation/padding, matrix fitting, distillation metrics, loss logs.

``embeddings.embedding`` (64 floats) stands in for an 8 x 8 score matrix; pairs
(vec_id, vec_id + 1) are (student, teacher).  ``events`` stands in for a training log
(run = user_id, step order = event_id, metric = value).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.operators import losses as L
from corpusmill.operators import metrics as Mx
from corpusmill.operators.scoring import active_tokens, next_token_shift, position_tokens
from corpusmill.plans import duck as D
from corpusmill.plans.catalog import register, table

SEQ = 16
TEMP = 2.0
PAIR_BATCH = 8


@register(
    "tokenize_pad",
    f"""
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '{D.PY_SPACE}+'), lambda x: x <> '') AS words FROM documents),
t AS (SELECT doc_id, least(len(words), {SEQ}) AS n FROM w),
i AS (SELECT doc_id, n, list_transform(range(1, {SEQ + 1}), lambda k: CASE WHEN k <= n THEN k ELSE 0 END) AS ids FROM t)
SELECT doc_id, array_to_string(ids, ',') AS input_ids,
       array_to_string(list_transform(ids, lambda x: CASE WHEN x > 0 THEN 1 ELSE 0 END), ',') AS attention_mask,
       CAST(least(n, {SEQ - 1}) AS BIGINT) AS active_tokens,
       array_to_string(ids[1:{SEQ - 1}], ',') AS inputs, array_to_string(ids[2:{SEQ}], ',') AS labels
FROM i
""",
)
def q_tokenize_pad(spark, sf):
    docs = table(spark, sf, "documents")
    ids, mask = position_tokens("text", SEQ)
    d = docs.select("doc_id", ids.alias("ids"), mask.alias("mask"))
    inputs, labels = next_token_shift(F.col("ids"))
    return d.select(
        "doc_id",
        F.array_join("ids", ",").alias("input_ids"),
        F.array_join("mask", ",").alias("attention_mask"),
        active_tokens(F.col("mask")).cast("bigint").alias("active_tokens"),
        F.array_join(inputs, ",").alias("inputs"),
        F.array_join(labels, ",").alias("labels"),
    )


_CELLS = """cells AS (SELECT vec_id, r, c, embedding[r * 8 + c + 1]::DOUBLE AS v
           FROM embeddings, range(8) rr(r), range(8) cc(c))"""


def _matrix_out(df, variant: str, m):
    cells, total = L.matrix_stats(m)
    flat = F.flatten(m)
    weighted = F.aggregate(
        F.zip_with(flat, F.sequence(F.lit(1), F.size(flat)), lambda x, i: x * i), F.lit(0.0), lambda a, x: a + x
    )
    return df.select(
        "vec_id",
        F.lit(variant).alias("variant"),
        cells.cast("bigint").alias("n_cells"),
        F.round(total, 6).alias("total"),
        F.round(weighted, 6).alias("weighted"),
    )


@register(
    "matrix_fit",
    f"""
WITH {_CELLS}
SELECT vec_id, 'A' AS variant, CAST(50 AS BIGINT) AS n_cells, round(sum(CASE WHEN c < 5 THEN v ELSE 0 END), 6) AS total,
       round(sum(CASE WHEN c < 5 THEN v * (r * 5 + c + 1) ELSE 0 END), 6) AS weighted FROM cells GROUP BY vec_id
UNION ALL
SELECT vec_id, 'B', CAST(72 AS BIGINT), round(sum(CASE WHEN r < 6 THEN v ELSE 0 END), 6),
       round(sum(CASE WHEN r < 6 THEN v * (r * 12 + c + 1) ELSE 0 END), 6) FROM cells GROUP BY vec_id
""",
)
def q_matrix_fit(spark, sf):
    e = table(spark, sf, "embeddings").withColumn("m", L.as_matrix("embedding", 8, 8))
    a = _matrix_out(e, "A", L.fit_matrix(F.col("m"), 10, 5))
    b = _matrix_out(e, "B", L.fit_matrix(F.col("m"), 6, 12))
    return a.unionByName(b)


@register(
    "center_fit",
    f"""
WITH {_CELLS}
SELECT vec_id, 'crop5' AS variant, CAST(40 AS BIGINT) AS n_cells,
       round(sum(CASE WHEN r BETWEEN 1 AND 5 THEN v ELSE 0 END), 6) AS total,
       round(sum(CASE WHEN r BETWEEN 1 AND 5 THEN v * ((r - 1) * 8 + c + 1) ELSE 0 END), 6) AS weighted
FROM cells GROUP BY vec_id
UNION ALL
SELECT vec_id, 'pad11', CAST(88 AS BIGINT), round(sum(v), 6), round(sum(v * ((r + 1) * 8 + c + 1)), 6)
FROM cells GROUP BY vec_id
UNION ALL
SELECT vec_id, 'vocab7', NULL, NULL, NULL FROM embeddings
UNION ALL
SELECT vec_id, 'lead1', CAST(40 AS BIGINT), round(sum(CASE WHEN r BETWEEN 1 AND 5 THEN v ELSE 0 END), 6),
       round(sum(CASE WHEN r BETWEEN 1 AND 5 THEN v * ((r - 1) * 8 + c + 1) ELSE 0 END), 6)
FROM cells GROUP BY vec_id
UNION ALL
SELECT vec_id, 'flat16', CAST(80 AS BIGINT), round(sum(CASE WHEN r >= 3 THEN v ELSE 0 END + CASE WHEN r <= 4 THEN v ELSE 0 END), 6),
       round(sum(CASE WHEN r >= 3 THEN v * ((r - 3) * 8 + c + 1) ELSE 0 END + CASE WHEN r <= 4 THEN v * ((r + 5) * 8 + c + 1) ELSE 0 END), 6)
FROM cells GROUP BY vec_id
UNION ALL
SELECT vec_id, 'flat7', NULL, NULL, NULL FROM embeddings
""",
)
def q_center_fit(spark, sf):
    e = table(spark, sf, "embeddings").withColumn("m", L.as_matrix("embedding", 8, 8))
    out = None
    for variant, rows, vocab in (("crop5", 5, 8), ("pad11", 11, 8), ("vocab7", 8, 7)):
        fitted = L.center_fit(F.col("m"), rows, vocab)
        part = _matrix_out(e.withColumn("f", fitted), variant, F.col("f"))  # null matrix -> null stats
        out = part if out is None else out.unionByName(part)
    # three dimensions: a leading one is dropped, others are laid out as rows
    for variant, copies, rows, vocab in (("lead1", 1, 5, 8), ("flat16", 2, 10, 8), ("flat7", 2, 10, 7)):
        fitted = L.fit_teacher_3d(F.array_repeat("m", copies), rows, vocab)
        out = out.unionByName(_matrix_out(e.withColumn("f", fitted), variant, F.col("f")))
    return out


def _pairs(spark, sf):
    e = table(spark, sf, "embeddings")
    s = e.select("vec_id", L.as_matrix("embedding", 8, 8).alias("student"))
    t = e.select((F.col("vec_id") - 1).alias("vec_id"), L.as_matrix("embedding", 8, 8).alias("teacher"))
    return s.join(t, "vec_id").withColumn("batch_id", F.floor(F.col("vec_id") / PAIR_BATCH).cast("bigint"))


_PAIR_CELLS = """p AS (SELECT a.vec_id, a.embedding AS s, b.embedding AS t FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1),
cells AS (SELECT vec_id, r, c, s[r * 8 + c + 1]::DOUBLE AS sv0, t[r * 8 + c + 1]::DOUBLE AS tv0
          FROM p, range(8) rr(r), range(8) cc(c))"""


@register(
    "kd_divergence",
    f"""
WITH {_PAIR_CELLS},
x AS (SELECT vec_id, r, c, sv0 / {TEMP} AS sv, tv0 / {TEMP} AS tv FROM cells),
rs AS (SELECT vec_id, r, max(sv) AS ms, max(tv) AS mt FROM x GROUP BY vec_id, r),
lse AS (SELECT x.vec_id, x.r, rs.ms + ln(sum(exp(x.sv - rs.ms))) AS ls, rs.mt + ln(sum(exp(x.tv - rs.mt))) AS lt
        FROM x JOIN rs USING (vec_id, r) GROUP BY x.vec_id, x.r, rs.ms, rs.mt),
kl AS (SELECT x.vec_id, sum(exp(x.tv - l.lt) * ((x.tv - l.lt) - (x.sv - l.ls))) AS kl
       FROM x JOIN lse l USING (vec_id, r) GROUP BY x.vec_id)
SELECT CAST(vec_id // {PAIR_BATCH} AS BIGINT) AS batch_id, round(sum(kl) / count(*) * {TEMP * TEMP}, 6) AS kd_loss
FROM kl GROUP BY 1
""",
)
def q_kd_divergence(spark, sf):
    kd = L.kd_loss(_pairs(spark, sf), ["batch_id"], "student", "teacher", TEMP)
    return kd.select("batch_id", F.round("kd_loss", 6).alias("kd_loss"))


@register(
    "logit_mse",
    f"""
WITH {_PAIR_CELLS}
SELECT CAST(vec_id // {PAIR_BATCH} AS BIGINT) AS batch_id, round(sum((sv0 - tv0) * (sv0 - tv0)) / count(*), 6) AS logit_mse
FROM cells GROUP BY 1
""",
)
def q_logit_mse(spark, sf):
    m = L.logit_mse(_pairs(spark, sf), ["batch_id"], "student", "teacher")
    return m.select("batch_id", F.round("logit_mse", 6).alias("logit_mse"))


@register(
    "cross_entropy_ppl",
    f"""
WITH {_CELLS},
rs AS (SELECT vec_id, r, max(v) AS m FROM cells GROUP BY vec_id, r),
row_ce AS (SELECT c.vec_id, c.r, rs.m + ln(sum(exp(c.v - rs.m))) - max(CASE WHEN c.c = (c.vec_id + c.r) % 8 THEN c.v END) AS ce
           FROM cells c JOIN rs USING (vec_id, r) GROUP BY c.vec_id, c.r, rs.m),
b AS (SELECT vec_id // {PAIR_BATCH} AS batch_id, avg(ce) AS batch_ce FROM row_ce GROUP BY 1)
SELECT CAST(count(*) AS BIGINT) AS n_batches, round(avg(batch_ce), 6) AS mean_ce, round(exp(avg(batch_ce)), 6) AS perplexity FROM b
""",
)
def q_cross_entropy_ppl(spark, sf):
    e = table(spark, sf, "embeddings")
    d = e.select(
        F.floor(F.col("vec_id") / PAIR_BATCH).cast("bigint").alias("batch_id"),
        L.as_matrix("embedding", 8, 8).alias("logits"),
        F.transform(F.sequence(F.lit(0), F.lit(7)), lambda r: F.pmod(F.col("vec_id") + r, F.lit(8))).alias("targets"),
    )
    p = L.perplexity(d, "batch_id", "logits", "targets")
    return p.select("n_batches", F.round("mean_ce", 6).alias("mean_ce"), F.round("perplexity", 6).alias("perplexity"))


_LOSS_SQL = """WITH l AS (SELECT event_id // 4 AS step, value / 10 AS kd, value / 20 + 1 AS ce,
                       json_extract(props, '$.k')::DOUBLE / 100 AS l2 FROM events)
SELECT CAST(step AS BIGINT) AS step, round(avg(ce), 6) AS ce_loss, round(avg(kd), 6) AS kd_loss,
       round(avg(l2), 6) AS logit_l2, round(avg(0.5 * kd + 1.0 * ce + 0.1 * l2), 6) AS train_loss
FROM l GROUP BY step"""


@register("weighted_loss", _LOSS_SQL)
def q_weighted_loss(spark, sf):
    ev = table(spark, sf, "events")
    l = ev.select(
        F.floor(F.col("event_id") / 4).cast("bigint").alias("step"),
        (F.col("value") / 10).alias("kd"),
        (F.col("value") / 20 + 1).alias("ce"),
        (F.get_json_object("props", "$.k").cast("double") / 100).alias("l2"),
    )
    l = l.withColumn("total", L.weighted_total(F.col("kd"), F.col("ce"), F.col("l2"), 0.5, 1.0, 0.1))
    return l.groupBy("step").agg(
        F.round(F.avg("ce"), 6).alias("ce_loss"),
        F.round(F.avg("kd"), 6).alias("kd_loss"),
        F.round(F.avg("l2"), 6).alias("logit_l2"),
        F.round(F.avg("total"), 6).alias("train_loss"),
    )


STOP_AT = 1.0


_METRIC = """CASE event_id % 11 WHEN 3 THEN CAST('NaN' AS DOUBLE) WHEN 5 THEN CAST('Infinity' AS DOUBLE)
  WHEN 7 THEN NULL ELSE value END"""


@register(
    "best_so_far",
    f"""
WITH m AS (SELECT user_id, event_id, {_METRIC} AS value FROM events),
v AS (SELECT *, CASE WHEN value IS NULL OR isnan(value) THEN CAST('Infinity' AS DOUBLE) ELSE value END AS v FROM m),
w AS (SELECT user_id, event_id, v,
  coalesce(min(v) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
           CAST('Infinity' AS DOUBLE)) AS prev,
  min(event_id) FILTER (WHERE value <= {STOP_AT}) OVER (PARTITION BY user_id) AS stop FROM v)
SELECT user_id, event_id, least(prev, v) AS best, v < prev AS is_new_best, coalesce(event_id > stop, FALSE) AS after_stop FROM w
""",
)
def q_best_so_far(spark, sf):
    """Values with NaN, infinity and null among them, also as the first of a run."""
    ev = table(spark, sf, "events").select("user_id", "event_id", F.expr(_METRIC).alias("value"))
    b = Mx.best_so_far(ev, ["user_id"], "event_id", "value", STOP_AT)
    return b.select("user_id", "event_id", "best", "is_new_best", "after_stop")


BAD_ABOVE = 40.0


@register(
    "nonfinite_guard",
    f"""
WITH b AS (SELECT user_id, event_id, isnan(CASE WHEN value > {BAD_ABOVE} THEN 'NaN'::DOUBLE ELSE value END) AS bad FROM events),
a AS (SELECT *, CASE WHEN NOT bad THEN 'ok'
                     WHEN lag(bad, 1, FALSE) OVER (PARTITION BY user_id ORDER BY event_id) THEN 'abort' ELSE 'skip' END AS act FROM b),
s AS (SELECT *, min(event_id) FILTER (WHERE act = 'abort') OVER (PARTITION BY user_id) AS abort_at FROM a)
SELECT user_id, event_id, CASE WHEN event_id > abort_at THEN 'halted' ELSE act END AS action FROM s
""",
)
def q_nonfinite_guard(spark, sf):
    ev = table(spark, sf, "events")
    metric = F.when(F.col("value") > BAD_ABOVE, F.lit(float("nan"))).otherwise(F.col("value"))
    d = ev.select("user_id", "event_id", F.isnan(metric).alias("bad"))
    return Mx.nonfinite_guard(d, ["user_id"], "event_id", "bad").select("user_id", "event_id", "action")


LOG_EVERY = 10


@register(
    "metric_sample",
    f"SELECT event_id, CAST(event_id + 1 AS BIGINT) AS step FROM events WHERE event_id + 1 = 1 OR (event_id + 1) % {LOG_EVERY} = 0",
)
def q_metric_sample(spark, sf):
    ev = table(spark, sf, "events").select("event_id", (F.col("event_id") + 1).cast("bigint").alias("step"))
    return Mx.sample_steps(ev, "step", LOG_EVERY)


@register(
    "throughput",
    """
SELECT user_id, round(sum(CAST(floor(value * 100) AS BIGINT)) / sum(0.5 + (event_id % 7) / 10.0), 6) AS tokens_per_sec,
       round(sum(4) / sum(0.5 + (event_id % 7) / 10.0), 6) AS examples_per_sec
FROM events GROUP BY user_id
""",
)
def q_throughput(spark, sf):
    ev = table(spark, sf, "events").select(
        "user_id",
        F.floor(F.col("value") * 100).cast("bigint").alias("tokens"),
        F.lit(4).alias("examples"),
        (F.lit(0.5) + (F.col("event_id") % 7) / 10.0).alias("seconds"),
    )
    t = Mx.throughput(ev, ["user_id"], "tokens", "examples", "seconds")
    return t.select("user_id", F.round("tokens_per_sec", 6).alias("tokens_per_sec"), F.round("examples_per_sec", 6).alias("examples_per_sec"))


TAIL = 5


@register(
    "tail_lines",
    f"""
SELECT user_id, event_id, CAST(rk AS INT) AS rank_from_end FROM (
  SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rk FROM events) WHERE rk <= {TAIL}
""",
)
def q_tail_lines(spark, sf):
    ev = table(spark, sf, "events").select("user_id", "event_id")
    return Mx.tail(ev, ["user_id"], "event_id", TAIL).select(
        "user_id", "event_id", F.col("rank_from_end").cast("int").alias("rank_from_end")
    )

"""Queries: calculator, tool-result injection, tool audit / exact match, scratchpad.

Tool traces are built from ``lineitem`` numbers (formatted ``%.2f`` on both sides, so
the expressions parse to the same doubles); the oracle states the expected outputs
directly with ``printf('%.12g', ...)``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.operators import tools as U
from corpusmill.operators.mixing import assign_batches
from corpusmill.operators.ordinals import with_ordinal
from corpusmill.plans import duck as D
from corpusmill.plans.catalog import register, table

VALIDATION_BATCH = 32


def two_decimals(column: str):
    """``%.2f``; positive numbers take a decimal's way, which is faster and rounds alike."""
    x = F.col(column).cast("double")
    plain = x.cast("decimal(17,2)").cast("string")
    return F.when((x > 0) & (x < 1e14), plain).otherwise(F.format_string("%.2f", x))


def _nums(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select(
        "l_orderkey",
        "l_linenumber",
        "l_returnflag",
        two_decimals("l_quantity").alias("q"),
        two_decimals("l_extendedprice").alias("p"),
        two_decimals("l_discount").alias("d"),
    )


_NUMS_SQL = """nums AS (SELECT l_orderkey, l_linenumber, l_returnflag AS rf,
    printf('%.2f', l_quantity) AS q, printf('%.2f', l_extendedprice) AS p, printf('%.2f', l_discount) AS d,
    CAST(printf('%.2f', l_quantity) AS DOUBLE) AS qv, CAST(printf('%.2f', l_extendedprice) AS DOUBLE) AS pv,
    CAST(printf('%.2f', l_discount) AS DOUBLE) AS dv FROM lineitem)"""

# Python float modulo (sign of the divisor, +0.0 for exact multiples) in SQL
_PYMOD7 = "(CASE WHEN fmod(-pow(qv, 2), 7) = 0 THEN 0.0 WHEN fmod(-pow(qv, 2), 7) < 0 THEN fmod(-pow(qv, 2), 7) + 7 ELSE fmod(-pow(qv, 2), 7) END)"


@register(
    "calculator",
    f"""
WITH {_NUMS_SQL}
SELECT l_orderkey, l_linenumber, CAST(k AS INT) AS k, r AS result FROM (
  SELECT l_orderkey, l_linenumber, 1 AS k, printf('%.12g', qv * pv) AS r FROM nums
  UNION ALL SELECT l_orderkey, l_linenumber, 2, printf('%.12g', pv / qv - dv) FROM nums
  UNION ALL SELECT l_orderkey, l_linenumber, 3, printf('%.12g', {_PYMOD7}) FROM nums
  UNION ALL SELECT l_orderkey, l_linenumber, 4, printf('%.12g', CAST(CAST(floor(pv) AS BIGINT) % 13 AS DOUBLE)) FROM nums
  UNION ALL SELECT l_orderkey, l_linenumber, 5, printf('%.12g', sin(qv) + cos(dv)) FROM nums)
""",
)
def q_calculator(spark, sf):
    n = _nums(spark, sf)
    q, p, d = F.col("q"), F.col("p"), F.col("d")
    exprs = F.array(
        F.concat(q, F.lit("*"), p),
        F.concat(p, F.lit("/"), q, F.lit(" - "), d),
        F.concat(F.lit("-"), q, F.lit(" ** 2 % 7")),
        F.concat(F.lit("floor("), p, F.lit(") % 13")),
        F.concat(F.lit("sin("), q, F.lit(") + cos("), d, F.lit(")")),
    )
    e = n.select("l_orderkey", "l_linenumber", F.posexplode(exprs).alias("k", "expr"))
    return e.select("l_orderkey", "l_linenumber", (F.col("k") + 1).cast("int").alias("k"), U.calculator("expr").alias("result"))


SCRATCH_CALLS = 10


def lines_text(lines: list[list]):
    """Lines of columns and plain strings, joined; a line with a null column is left out.  Without
    nulls, the rule, all of it is joined at once and plain strings side by side are one."""
    parts = []
    for part in [x for line in lines for x in ("\n", *line)][1:]:
        if parts and isinstance(part, str) and isinstance(parts[-1], str):
            parts[-1] += part
        else:
            parts.append(part)
    joined = lambda line: F.concat(*[F.lit(x) if isinstance(x, str) else x for x in line])
    return F.coalesce(joined(parts), F.concat_ws("\n", *map(joined, lines)))


def trace_text(spark, sf):
    """A tool-call trace per line item (CALL lines, a decoy, unknown tool, errors)."""
    n = _nums(spark, sf)
    q, p, d = F.col("q"), F.col("p"), F.col("d")
    lines = [
        ["Order ", F.col("l_orderkey").cast("string"), " line ", F.col("l_linenumber").cast("string")],
        ['CALL calculator: "', q, "*", p, '"'],
        ['  CALL calculator: "1+1"'],
        ['CALL Calculator:"', p, "/(", d, "-", d, ')"'],
        *[[f'CALL scratchpad: "k{k}: ', q, '"'] for k in range(1, SCRATCH_CALLS + 1)],
        ['CALL scratchpad: "', F.col("l_returnflag"), '"'],
        ['CALL web-search: "x"'],
        ['CALL calculator: "sqrt(', q, ') ** 2"'],
        ['CALL calculator: "__import__(1)"'],
        ['CALL calculator: "', q, ' // 2"'],
        ["Done.\n"],
    ]
    return n.select("l_orderkey", "l_linenumber", lines_text(lines).alias("text"))


def _nl(*parts: str) -> str:
    return " || chr(10) || ".join(parts)


def _pad(k: int) -> str:
    return _nl(*[f"'k{j}: ' || q" for j in range(max(1, k - 7), k + 1)])


def _expected_trace_sql() -> str:
    parts = [
        "'Order ' || CAST(l_orderkey AS VARCHAR) || ' line ' || CAST(l_linenumber AS VARCHAR)",
        "'CALL calculator: \"' || q || '*' || p || '\"'",
        "'RESULT: ' || printf('%.12g', qv * pv)",
        "'  CALL calculator: \"1+1\"'",
        "'CALL Calculator:\"' || p || '/(' || d || '-' || d || ')\"'",
        "'RESULT: ERROR:ZeroDivisionError'",
    ]
    for k in range(1, SCRATCH_CALLS + 1):
        parts.append(f"'CALL scratchpad: \"k{k}: ' || q || '\"'")
        parts.append(f"'RESULT: ' || {_pad(k)}")
    last7 = _nl(*[f"'k{j}: ' || q" for j in range(SCRATCH_CALLS - 6, SCRATCH_CALLS + 1)])
    parts += [
        "'CALL scratchpad: \"' || rf || '\"'",
        f"'RESULT: ' || {last7} || chr(10) || 'note: ' || rf",
        "'CALL web-search: \"x\"'",
        "'RESULT: ERROR:UNKNOWN_TOOL'",
        "'CALL calculator: \"sqrt(' || q || ') ** 2\"'",
        "'RESULT: ' || printf('%.12g', pow(sqrt(qv), 2))",
        "'CALL calculator: \"__import__(1)\"'",
        "'RESULT: ERROR:FORBIDDEN'",
        "'CALL calculator: \"' || q || ' // 2\"'",
        "'RESULT: ERROR:Node FloorDiv is not allowed'",
        "'Done.'",
    ]
    return _nl(*parts)


@register(
    "tool_inject",
    f"WITH {_NUMS_SQL} SELECT l_orderkey, l_linenumber, {_expected_trace_sql()} AS text FROM nums",
)
def q_tool_inject(spark, sf):
    t = trace_text(spark, sf)
    return U.inject_tool_results(t, "text", "injected").select("l_orderkey", "l_linenumber", F.col("injected").alias("text"))


def stored_trace(spark, sf):
    """Traces with stored RESULT lines; every 5th line item has a wrong first result."""
    n = _nums(spark, sf)
    q, p = F.col("q"), F.col("p")
    e1 = F.concat(q, F.lit("*"), p)
    e1_stored = F.when(F.col("l_linenumber") % 5 == 0, F.concat(e1, F.lit(" + 1"))).otherwise(e1)
    e2 = F.concat(p, F.lit("-"), q)
    # both stored results in one Arrow pass
    stored = n.withColumn("__r", U.calculator_many(F.array(e1_stored, e2)))
    text = F.concat_ws(
        "\n",
        F.concat(F.lit('CALL calculator: "'), e1, F.lit('"')),
        F.concat(F.lit("RESULT: "), F.element_at("__r", 1)),
        F.concat(F.lit('CALL calculator: "'), e2, F.lit('"')),
        F.concat(F.lit("  RESULT:  "), F.element_at("__r", 2), F.lit(" ")),
    )
    n = stored
    return n.select("l_orderkey", "l_linenumber", text.alias("text"))


@register(
    "tool_exact_match",
    f"""
WITH {_NUMS_SQL},
r AS (SELECT l_linenumber, (row_number() OVER (ORDER BY l_orderkey, l_linenumber) - 1) AS pos FROM nums),
b AS (SELECT *, pos // {VALIDATION_BATCH} AS batch_id FROM r),
t AS (SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY pos) AS rk FROM b)
SELECT CAST(batch_id AS BIGINT) AS batch_id, CAST(2 * count(*) AS BIGINT) AS pairs,
       CAST(sum(CASE WHEN l_linenumber % 5 = 0 THEN 1 ELSE 2 END) AS BIGINT) AS correct,
       round(sum(CASE WHEN l_linenumber % 5 = 0 THEN 1 ELSE 2 END) / (2.0 * count(*)), 6) AS tool_em
FROM t WHERE rk <= 16 GROUP BY batch_id
""",
)
def q_tool_exact_match(spark, sf):
    # texts are audited where they are read; only keys and counts are numbered and shuffled
    audited = U.audit_tool_results(stored_trace(spark, sf), "text")
    audited = audited.select("l_orderkey", "l_linenumber", "comparable", "pairs", "correct")
    t = with_ordinal(audited, ["l_orderkey", "l_linenumber"], name="pos")
    t = assign_batches(t, "pos", VALIDATION_BATCH)
    em = U.exact_match_by_batch(t, "batch_id", "pos")
    return em.select("batch_id", "pairs", "correct", F.round("tool_em", 6).alias("tool_em"))


_PAD_ARG = "CASE WHEN (conv_id + turn) % 5 = 3 THEN NULL WHEN turn % 3 = 2 THEN text ELSE role || ': ' || text END"


def _note_sql(a: str) -> str:
    pos = f"strpos({a}, ':')"
    label = f"(CASE WHEN {pos} > 0 THEN substring({a}, 1, {pos} - 1) ELSE {a} END)"
    content = f"(CASE WHEN {pos} > 0 THEN substring({a}, {pos} + 1) ELSE '' END)"
    return f"(CASE WHEN {content} <> '' THEN {D.strip(label)} || ': ' || {D.strip(content)} ELSE 'note: ' || {D.strip(label)} END)"


@register(
    "scratchpad",
    f"""
WITH a AS (SELECT conv_id, turn, {_PAD_ARG} AS arg FROM conversations),
n AS (SELECT conv_id, turn, {_note_sql('arg')} AS note FROM a),
w AS (SELECT conv_id, turn, list(note) FILTER (note IS NOT NULL) OVER (PARTITION BY conv_id ORDER BY turn) AS notes FROM n)
SELECT conv_id, turn, sha1(coalesce(array_to_string(notes[-8:], chr(10)), '')) AS pad_sha1,
       CAST(least(coalesce(len(notes), 0), 8) AS BIGINT) AS n_notes FROM w
""",
)
def q_scratchpad(spark, sf):
    conv = table(spark, sf, "conversations").withColumn("arg", F.expr(_PAD_ARG))
    r = U.scratchpad_renders(conv, ["conv_id"], ["turn"], "arg", position_col="turn")
    return r.select("conv_id", "turn", F.sha1(F.col("pad").cast("binary")).alias("pad_sha1"), "n_notes")

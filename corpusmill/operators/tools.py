"""Tool-call traces: calculator, tool dispatch, RESULT injection, audit and exact match.

Injection and audit are one Arrow step each (``functions.traces``): a map-only stage in which
the lines of a batch are cut once and all its expressions are evaluated together, by shape.
The scratchpad is a per-record state: the k-th scratchpad call renders notes max(1, k-7)..k.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from corpusmill.functions.calculator import evaluate_many
from corpusmill.functions.text import PY_SPACE_CLASS, py_strip
from corpusmill.functions.traces import (
    CALCULATOR,
    DEFAULT_NOTE_LABEL,
    RESULT_MARK,
    SCRATCHPAD,
    SCRATCHPAD_LINES,
    UNKNOWN_TOOL,
    audit,
    inject,
)

# --- fixed values (must equal the reference's rules) --------------------------------
VALIDATION_TOOL_SAMPLES_PER_BATCH = 16
# Line breaks recognised by Python's str.splitlines().
PY_LINE_BREAKS = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"
# -------------------------------------------------------------------------------------


@F.pandas_udf(StringType())
def calculator(exprs: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Vectorised calculator over a string column."""
    for s in exprs:
        yield pd.Series(evaluate_many(s.where(s.notna(), None).tolist()), dtype="object")


@F.arrow_udf(ArrayType(StringType()))
def calculator_many(arrays: pa.Array) -> pa.Array:
    """Calculator over an array of expressions per row (null elements stay null)."""
    values = arrays.flatten()
    done = pa.array(evaluate_many(values.to_pylist()), pa.string())
    size = pc.list_value_length(arrays).fill_null(0).to_numpy(zero_copy_only=False)
    bounds = np.concatenate([[0], np.cumsum(size)])
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), done, mask=arrays.is_null())


def _c(col):
    return F.col(col) if isinstance(col, str) else col


def scratchpad_note(arg: Column) -> Column:
    """``label: content`` from an argument; without content the whole argument is the
    content and the label is ``note``."""
    pos = F.instr(arg, ":")
    label = F.when(pos > 0, F.substring_index(arg, ":", 1)).otherwise(arg)
    content = F.when(pos > 0, F.substr(arg, pos + 1)).otherwise(F.lit(""))
    return F.when(content != "", F.concat(py_strip(label), F.lit(": "), py_strip(content))).otherwise(
        F.concat(F.lit(DEFAULT_NOTE_LABEL + ": "), py_strip(label))
    )


#: Texts handled together inside an Arrow batch; bounds the lists of lines.
TEXTS_AT_ONCE = 4096


@F.arrow_udf(StringType())
def _injected(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        for k in range(0, max(len(texts), 1), TEXTS_AT_ONCE):
            yield inject(texts[k : k + TEXTS_AT_ONCE]).cast(pa.string())


_AUDIT = pa.struct([("actual", pa.list_(pa.string())), ("expected", pa.list_(pa.string()))])


@F.arrow_udf(StructType([StructField(c, ArrayType(StringType())) for c in ("actual", "expected")]))
def _audited(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        parts = [audit(texts[k : k + TEXTS_AT_ONCE]) for k in range(0, len(texts), TEXTS_AT_ONCE)] or [audit(texts)]
        yield pa.StructArray.from_arrays([pa.concat_arrays(x) for x in zip(*parts)], fields=list(_AUDIT))


def inject_tool_results(df: DataFrame, text: Column | str, out_col: str) -> DataFrame:
    """After every CALL line add ``RESULT: <tool output>``; lines are split on ``\\n``
    only and a final newline is not kept (as the line-by-line original does)."""
    return df.withColumn(out_col, _injected(_c(text).cast("string")))


def py_splitlines(text: Column | str) -> Column:
    """Python ``str.splitlines()``: every line-break kind; no empty last line."""
    t = _c(text)
    body = F.regexp_replace(t, "(?:" + PY_LINE_BREAKS + r")\z", "")
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(body, PY_LINE_BREAKS, -1))


def _is_result_line(l: Column) -> Column:
    """Stripped line starts with ``RESULT:`` (one anchored regex)."""
    return l.rlike(f"^{PY_SPACE_CLASS}*{RESULT_MARK}")


def result_values(text: Column | str) -> Column:
    """Values of the RESULT lines (text after the first ``RESULT:``, stripped)."""
    lines = py_splitlines(text)
    hits = F.filter(lines, _is_result_line)
    return F.transform(hits, lambda l: py_strip(F.substr(l, F.instr(l, RESULT_MARK) + len(RESULT_MARK))))


def audit_tool_results(df: DataFrame, text_col: str) -> DataFrame:
    """Stored RESULT values (``actual``) vs values recomputed by re-injection into the text
    without them (``expected``); ``comparable`` when both are non-empty and of equal length;
    ``pairs`` and ``correct`` count them and the equal ones (both come stripped)."""
    out = df.withColumn("__audit", _audited(F.col(text_col).cast("string")))
    out = out.withColumn("actual", F.col("__audit.actual")).withColumn("expected", F.col("__audit.expected")).drop("__audit")
    comparable = (F.size("actual") > 0) & (F.size("expected") > 0) & (F.size("actual") == F.size("expected"))
    same = F.zip_with("actual", "expected", lambda a, e: a == e)
    return (
        out.withColumn("comparable", comparable)
        .withColumn("pairs", F.size("actual"))
        .withColumn("correct", F.size(F.filter(same, lambda x: x)))
    )


def exact_match_by_batch(
    audited: DataFrame, batch_col: str, pos_col: str, per_batch: int = VALIDATION_TOOL_SAMPLES_PER_BATCH
) -> DataFrame:
    """Per batch: the first ``per_batch`` comparable rows of an audit contribute their pairs;
    counts pairs and exact matches.  ``tool_em`` = correct / pairs (null with no pairs).
    Batches are bounded, so the window per batch is small.  Of the audit only ``comparable``,
    ``pairs`` and ``correct`` are read."""
    per_row = audited.select(
        batch_col, pos_col, "comparable", F.col("pairs").alias("__pairs"), F.col("correct").alias("__correct")
    )
    # rank comparable rows first; filtering after the window keeps the optimiser from
    # pushing the predicate (and the whole audit expression) below the projection
    w = Window.partitionBy(batch_col).orderBy(F.col("comparable").desc(), pos_col)
    ranked = per_row.withColumn("__rank", F.row_number().over(w))
    per_row = ranked.filter(F.col("comparable") & (F.col("__rank") <= per_batch))
    agg = per_row.groupBy(batch_col).agg(
        F.sum("__pairs").cast("bigint").alias("pairs"), F.sum("__correct").cast("bigint").alias("correct")
    )
    return agg.withColumn("tool_em", F.when(F.col("pairs") > 0, F.col("correct") / F.col("pairs")))


def dispatch(name: Column, arg: Column) -> Column:
    """Named tool call for single (stateless) calls: calculator, scratchpad with an empty
    pad (renders just this note), else the unknown-tool error."""
    n = F.lower(name)
    return (
        F.when(n == CALCULATOR, calculator(arg))
        .when(n == SCRATCHPAD, scratchpad_note(arg))
        .otherwise(F.lit(UNKNOWN_TOOL))
    )


def scratchpad_renders(
    df: DataFrame,
    key_cols,
    order_cols,
    arg_col: str,
    out_col: str = "pad",
    keep: int = SCRATCHPAD_LINES,
    position_col: str | None = None,
) -> DataFrame:
    """Scratchpad state per key across rows (e.g. per conversation over turns): each row
    adds its note and renders the last ``keep`` notes.  A null argument adds none, its row shows
    the notes so far.  Skew-safe: positions from the
    distributed ordinal (or ``position_col`` when the rows already carry a contiguous
    0-based position), frame from the blocked ``last_n`` window."""
    from corpusmill.operators.ordinals import with_ordinal
    from corpusmill.operators.windows import last_n, running

    keys = list(key_cols)
    if position_col:
        pos = df.withColumn("__pad_pos", F.col(position_col))
    else:
        pos = with_ordinal(df, order_cols, keys, name="__pad_pos")
    pos = pos.withColumn("__pad_note", scratchpad_note(F.col(arg_col)))
    has_note = F.col("__pad_note").isNotNull().cast("bigint")
    numbered = running(pos, keys, "__pad_pos", has_note, "sum", "__pad_no").withColumn("__pad_no", F.col("__pad_no") - 1)
    with_notes = last_n(numbered, keys, "__pad_no", "__pad_note", keep, "__notes", by_number=True)
    return with_notes.withColumn(out_col, F.array_join("__notes", "\n")).withColumn(
        "n_notes", F.size("__notes").cast("bigint")
    ).drop("__notes", "__pad_pos", "__pad_note", "__pad_no")

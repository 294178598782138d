"""Pluggable batch scorer and tokeniser (Arrow-batched pandas UDFs).

A model is built once per task by ``model_factory`` and applied to whole Arrow batches;
only the rows that need scoring reach Python (the caller filters first, e.g. with the
pending anti-join).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TEXTS_AT_ONCE = 256  # texts that a tokeniser gets together

_WS = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def batch_udf(model_factory: Callable[[], Callable[[pd.Series], pd.Series]], return_type: str):
    """Iterator pandas UDF: ``model_factory()`` runs once per task, the returned
    function maps a batch (pd.Series) to a batch of results."""

    @F.pandas_udf(return_type)
    def _apply(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        fn = model_factory()
        for b in batches:
            yield fn(b)

    return _apply


def score(df: DataFrame, model_factory, input_col: str, output_col: str = "online_score", return_type: str = "double") -> DataFrame:
    return df.withColumn(output_col, batch_udf(model_factory, return_type)(F.col(input_col)))


def scorer(model_factory, input_col: str, output_col: str = "online_score", return_type: str = "double"):
    """DataFrame -> DataFrame closure, for ``artifacts.route_scores``."""
    return lambda df: score(df, model_factory, input_col, output_col, return_type)


def stub_length_scorer():
    """Deterministic stand-in teacher for tests: (code points mod 97) / 97."""

    def fn(texts: pd.Series) -> pd.Series:
        return texts.fillna("").str.len().mod(97).div(97.0).round(6)

    return fn


# ---------------------------------------------------------------- tokenisation


def position_tokens(text: Column | str, seq_len: int) -> tuple[Column, Column]:
    """Built-in whitespace tokeniser of the test double: the i-th word gets id i+1,
    truncated/zero-padded to ``seq_len``; mask 1 on words, 0 on padding.  Pure SQL, no
    lambda over the word list (the count is computed once)."""
    t = F.col(text) if isinstance(text, str) else text
    words = F.split(F.regexp_replace(t, rf"^{_WS}+|{_WS}+\z", ""), rf"{_WS}+", -1)
    n_words = F.when(F.size(words) == 1, F.when(F.element_at(words, 1) == "", 0).otherwise(1)).otherwise(F.size(words))
    n = F.least(n_words, F.lit(seq_len))
    counted = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    ids = F.slice(F.concat(counted, F.array_repeat(F.lit(0), F.lit(seq_len))), 1, seq_len)
    mask = F.slice(F.concat(F.array_repeat(F.lit(1), n), F.array_repeat(F.lit(0), F.lit(seq_len))), 1, seq_len)
    return ids.cast("array<bigint>"), mask.cast("array<bigint>")


def pad_or_truncate(arr: Column, length: int, pad_value=0) -> Column:
    """Right-pad with ``pad_value`` or truncate an array to ``length``."""
    pad = pad_value if isinstance(pad_value, Column) else F.lit(pad_value)
    return F.slice(F.concat(arr, F.array_repeat(pad, F.lit(length))), 1, length)


def active_tokens(mask: Column) -> Column:
    """Tokens that enter the loss: sum of the mask without its last position."""
    return F.aggregate(F.slice(mask, 1, F.size(mask) - 1), F.lit(0).cast("bigint"), lambda a, x: a + x)


def next_token_shift(ids: Column) -> tuple[Column, Column]:
    """(inputs, labels) = (ids[:-1], ids[1:])."""
    n = F.size(ids) - 1
    return F.slice(ids, 1, n), F.slice(ids, 2, n)


def tokenize(df: DataFrame, model_factory, text_col: str, seq_len: int, output_col: str = "input_ids") -> DataFrame:
    """Pluggable tokeniser: ``model_factory()`` returns ``fn(texts) -> list of id lists``;
    ids are cut to ``seq_len`` in the task and padded natively with a mask."""

    @F.arrow_udf("array<bigint>")
    def raw_ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        fn, kind = model_factory(), pa.list_(pa.int64())
        for texts in batches:
            parts = []
            for k in range(0, len(texts), TEXTS_AT_ONCE):  # only so many whole lists of ids at a time
                some = fn([t or "" for t in texts[k : k + TEXTS_AT_ONCE].to_pylist()])
                parts.append(pa.array([list(ids[:seq_len]) for ids in some], kind))
            yield pa.concat_arrays(parts) if parts else pa.array([], kind)

    raw = F.col("__raw_ids")
    zeros, ones = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    n = F.least(F.size(raw), F.lit(seq_len))
    out = df.withColumn("__raw_ids", raw_ids.asNondeterministic()(F.col(text_col)))
    out = out.withColumn("attention_mask", F.concat(F.array_repeat(ones, n), F.array_repeat(zeros, F.lit(seq_len) - n)))
    return out.withColumn(output_col, pad_or_truncate(raw, seq_len, zeros)).drop("__raw_ids")

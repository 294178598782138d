"""Substring dedup by seed and extend.

Documents are joined on winnowed anchors (the smallest hash of ``SEED_WORDS`` words in
every window), repeated anchors are extended both ways to the windows that contain them,
and the maximal repeated spans of at least ``length`` words are removed, every copy, same
document included; all windows are judged on the input.

A hot anchor would give all pairs of its occurrences, so an extended span is not compared
pair by pair but looked up by its 128-bit key among the corpus' extended spans, each sent
at most once per block of texts.  Counts are exact up to collisions of 128-bit hashes.

Defined cases: a null text has no words; a text shorter than ``length`` words keeps all;
repeated rows are copies of each other (both lose what they share); ties cannot arise, as
all copies are removed; very long texts are blocks of their own; an empty table gives an
empty result; only the key and text columns are read, so other names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from corpusmill.llm import repeats as R
from corpusmill.llm import words as W

LENGTH = 35
SEED_WORDS = 8


def join_anchors(key: np.ndarray, multi: np.ndarray, row: np.ndarray) -> np.ndarray:
    """The join of all blocks on their anchors: which have a partner?"""
    _, which, blocks = np.unique(key, return_inverse=True, return_counts=True)
    return ((blocks[which] > 1) | (np.bincount(which, multi)[which] > 0)).astype(np.uint8)


def dedup_substrings(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, seed_words: int = SEED_WORDS
) -> DataFrame:
    """``(key, n_words, n_removed, spans, kept)`` per document; ``spans`` are the maximal
    repeats (start, length in words), ``kept`` the remaining words joined by one space."""
    kind = docs.schema[key].dataType.simpleString()

    def finish(spans: R.Spans, repeated: np.ndarray, later: np.ndarray) -> Iterator[pa.RecordBatch]:
        split = spans.split
        yield pa.RecordBatch.from_arrays(
            [
                spans.block["keys"],
                pa.array(split.counts(), pa.int64()),
                pa.array(W.per_text(repeated, split.doc), pa.int64()),
                R.span_lists(repeated, split.doc),
                R.kept_text(split, repeated),
            ],
            names=["key", "n_words", "n_removed", "spans", "kept"],
        )

    schema = f"key {kind}, n_words bigint, n_removed bigint, spans array<struct<start:int,length:int>>, kept string"
    found = R.repeated_words(docs, key, text, length, min(seed_words, length), join_anchors, finish, schema, "seed-extend")
    return found.withColumnRenamed("key", key)

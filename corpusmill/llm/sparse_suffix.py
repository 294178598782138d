"""Suffix-array dedup with sparse suffix arrays, in a reduced form.

Of all suffixes only those at minimiser positions are retained: the leftmost smallest hash
of ``PREFIX_WORDS`` words in every window of ``length`` words, so any repeat of at least
``length`` words has a retained suffix in each copy, at the same place.  Of a retained suffix
only the 64-bit hash of its first ``PREFIX_WORDS`` words is sorted (in parts of the corpus-wide
order; copies inside a block of texts count as one entry) and neighbours are compared by it;
no further words of a suffix are ordered.  Where a neighbour is equal, the windows of
``length`` words around the place are looked up by their 128-bit keys among those of all such
places; a match is the union of such windows and is not extended word by word.  Later copies
are deleted; the first occurrence (smallest key, then place) stays.

Defined cases: a null text has no words; a shorter text keeps all; of repeated rows (same
key) the one read first keeps its words; keys that are not integers are ordered by a hash;
null keys come first; very long texts are blocks of their own; an empty table gives an
empty result; only the key and text columns are read, so other names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from corpusmill.llm import repeats as R
from corpusmill.llm import words as W

LENGTH = 50
PREFIX_WORDS = 8


def compare_neighbours(prefix: np.ndarray, multi: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Sort the retained suffixes by prefix; which share it with a neighbour?"""
    order = np.argsort(prefix, kind="stable")
    same = prefix[order][1:] == prefix[order][:-1]
    out = np.zeros(len(prefix), np.uint8)
    out[order[1:][same]] = 1
    out[order[:-1][same]] = 1
    return out | multi


def dedup_suffixes(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, prefix_words: int = PREFIX_WORDS
) -> DataFrame:
    """``(key, n_words, n_repeated, n_removed, repeats, kept)`` per document: words in
    repeats, words in later copies, the maximal repeats (start, length, and how many of their
    words are in later copies), and the remaining words."""
    kind = docs.schema[key].dataType.simpleString()

    def finish(spans: R.Spans, repeated: np.ndarray, later: np.ndarray) -> Iterator[pa.RecordBatch]:
        split = spans.split
        yield pa.RecordBatch.from_arrays(
            [
                spans.block["keys"],
                pa.array(split.counts(), pa.int64()),
                pa.array(W.per_text(repeated, split.doc), pa.int64()),
                pa.array(W.per_text(later, split.doc), pa.int64()),
                R.span_lists(repeated, split.doc, removed=later),
                R.kept_text(split, later),
            ],
            names=["key", "n_words", "n_repeated", "n_removed", "repeats", "kept"],
        )

    span = "array<struct<start:int,length:int,removed:int>>"
    schema = f"key {kind}, n_words bigint, n_repeated bigint, n_removed bigint, repeats {span}, kept string"
    found = R.repeated_words(docs, key, text, length, min(prefix_words, length), compare_neighbours, finish, schema, "sparse-suffix")
    return found.withColumnRenamed("key", key)

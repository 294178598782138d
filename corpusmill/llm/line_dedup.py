"""Line dedup: repeated runs of lines by distributed prefix doubling (no sorted suffix array).

A text is the sequence of its lines that have a word.  Round 0 names every line by the
first place in the corpus (document order, then line) that has it; round j names the run of
``2**j`` lines at a place by the first place with that run, from the pair of names of its
halves.  So a name is the run's rank by first occurrence, exact, without hashes of runs.
Places whose run is unique drop out, so every round works on fewer rows, and the rounds end
when no run is repeated: the places that share a name at level j start the same ``2**j`` lines; names are not in sorted order and
no LCP is made.  Runs of at least ``min_lines`` lines, and single lines of at least
``min_words`` words, that occur earlier are deleted, merged to maximal runs; the first
occurrence stays.

Plan: line hashes and names are shuffled, texts once, for the result; the two large joins
are shuffle joins at every size (a small corpus takes the plan that a large one takes).  Names are partial
aggregates (a hot line costs one row per task) joined back by name; the join's skewed
partitions can be split (AQE).  Every round is a written table.

Defined cases: a null text has no lines; lines without a word are kept and do not interrupt
a run; a run inside one text that repeats an earlier one of it is a later copy; rows that
repeat one id and text are one document and each gets its result; documents are ordered by
key (nulls first; keys that are not integers by a hash), then by text hash; an empty table
gives an empty result; only the key and text columns are read, so other names cannot clash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import Tuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType

from corpusmill.llm.tables import written

MIN_LINES = 2
MIN_WORDS = 10  # a line of so many words is a run by itself
MAX_ROUNDS = 40  # runs of 2**40 lines
_WORD = r"[^\x20\x09-\x0D]"


def _order(docs: DataFrame, key: str) -> Column:
    if isinstance(docs.schema[key].dataType, (ByteType, ShortType, IntegerType, LongType)):
        return F.coalesce(F.col(key).cast("bigint"), F.lit(-(1 << 63)).cast("bigint"))
    return F.coalesce(F.xxhash64(F.col(key).cast("string")), F.lit(-(1 << 63)).cast("bigint"))


def _place(shift: int = 0) -> Column:
    return F.struct("o", "h", (F.col("p") + shift).alias("p"))


def lines_of(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(o, h, p, a, b, w): document order and hash, place among the lines with a word, the
    line's two 64-bit hashes and its number of words."""
    t = F.col(text).cast("string")
    rows = docs.select(_order(docs, key).alias("o"), F.xxhash64(t).alias("h"), t.alias("t")).filter("t is not null")
    listed = F.filter(F.split("t", "\n", -1), lambda x: x.rlike(_WORD))
    listed = F.transform(listed, lambda x: F.struct(F.xxhash64(x).alias("a"), F.xxhash64(F.lit(1), x).alias("b"), F.regexp_count(x, F.lit(_WORD + "+")).alias("w")))
    return rows.select("o", "h", F.posexplode(listed).alias("p", "l")).select("o", "h", "p", "l.a", "l.b", "l.w")


def named(rows: DataFrame, keys: list[str], name: str, join: str = "", also: tuple[str, ...] = ()) -> DataFrame:
    """Rows whose keys occur at two places at least, with the first such place."""
    first = rows.groupBy(*keys).agg(F.min(_place()).alias("first"), F.max(_place()).alias("last"))
    first = first.filter("first <> last").select(*keys, "first")
    first = first.hint(join) if join else first
    return written(rows.join(first, keys).select("o", "h", "p", F.col("first").alias("name"), *also).distinct(), name)


def run_levels(lines: DataFrame) -> list[DataFrame]:
    """Level j: repeated runs of 2**j lines, named by their first place."""
    levels = [named(lines, ["a", "b"], "lines-0", "merge", ("w",))]
    while len(levels) <= MAX_ROUNDS:
        now, step = levels[-1], 1 << (len(levels) - 1)
        ahead = now.select("o", "h", (F.col("p") - step).alias("p"), F.col("name").alias("next"))
        pairs = now.join(ahead, ["o", "h", "p"])
        level = named(pairs.select("o", "h", "p", "name", "next"), ["name", "next"], f"lines-{len(levels)}")
        if level.isEmpty():
            return levels
        levels.append(level)
    raise RuntimeError("runs of repeated lines do not end")


def windows(levels: list[DataFrame], size: int) -> DataFrame:
    """Repeated runs of exactly ``size`` lines: two overlapping runs of the largest power of
    two, named like a level."""
    j = size.bit_length() - 1
    if j >= len(levels):
        return levels[0].limit(0)
    if size == 1 << j:
        return levels[j]
    ahead = levels[j].select("o", "h", (F.col("p") - (size - (1 << j))).alias("p"), F.col("name").alias("next"))
    pairs = levels[j].join(ahead, ["o", "h", "p"])
    return named(pairs.select("o", "h", "p", "name", "next"), ["name", "next"], f"lines-of-{size}")


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> DataFrame:
    """``(key, n_lines, n_removed, runs, kept)``: lines with a word, removed ones, the
    removed maximal runs (start and length among the lines with a word; prefix: the longest
    run of a power-of-two length in it that occurs earlier as a whole) and the kept text."""
    levels = run_levels(lines_of(docs, key, text))
    # runs of min_lines lines and long lines that occur earlier; overlapping and adjacent ones are merged to
    # the maximal runs, with the longest common prefix (a power of two) found in them
    later = F.col("name") < _place()
    found = windows(levels, min_lines).filter(later).select("o", "h", "p", F.lit(min_lines).alias("n"))
    single = levels[0].filter(later & (F.col("w") >= min_words))
    found = found.unionByName(single.select("o", "h", "p", F.lit(1).alias("n")))
    for j in range(min_lines.bit_length(), len(levels)):
        found = found.unionByName(levels[j].filter(later).select("o", "h", "p", F.lit(1 << j).alias("n")))
    found = found.groupBy("o", "h", "p").agg(F.max("n").alias("n"))
    inside = Window.partitionBy("o", "h").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    found = found.withColumn("end", F.col("p") + F.col("n"))
    found = found.withColumn("new", F.coalesce(F.col("p") > F.max("end").over(inside), F.lit(True)).cast("int"))
    found = found.withColumn("run", F.sum("new").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    runs = found.groupBy("o", "h", "run").agg(
        F.min("p").alias("start"), F.max("end").alias("end"), F.max("n").alias("prefix")
    )
    runs = runs.groupBy("o", "h").agg(
        F.sort_array(F.collect_list(F.struct("start", (F.col("end") - F.col("start")).alias("length"), "prefix"))).alias("runs")
    )
    runs = written(runs, "lines-runs")
    t = F.col("t")
    rows = docs.select(F.col(key).alias("key"), _order(docs, key).alias("o"), F.xxhash64(F.col(text).cast("string")).alias("h"), F.col(text).cast("string").alias("t"))
    joined = rows.join(runs.hint("merge"), ["o", "h"], "left")
    listed = F.coalesce(F.split(t, "\n", -1), F.array().cast("array<string>"))
    count = F.size(F.filter(listed, lambda x: x.rlike(_WORD))).cast("bigint")
    removed = F.coalesce(F.aggregate("runs", F.lit(0).cast("bigint"), lambda s, r: s + r["length"]), F.lit(0).cast("bigint"))
    gone = F.flatten(F.transform("runs", lambda r: F.sequence(r["start"], r["start"] + r["length"] - 1)))
    out = joined.select(F.col("key").alias(key), "t", count.alias("n_lines"), removed.alias("n_removed"),
                        F.coalesce("runs", F.array().cast(runs.schema["runs"].dataType)).alias("runs"), gone.alias("gone"))
    return out.select(key, "n_lines", "n_removed", "runs", _without("t", "gone").alias("kept"))


def _without(text: str, gone: str) -> Column:
    """The text without the lines (counted among those with a word) listed in ``gone``."""
    word = re.compile(_WORD)

    @F.arrow_udf("string")
    def kept(batches: Iterator[Tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, lists in batches:
            out = []
            for t, g in zip(texts.to_pylist(), lists.to_pylist()):
                if g:
                    drop, at, lines = set(g), -1, []
                    for line in t.split("\n"):
                        at += (has := word.search(line) is not None)
                        if not (has and at in drop):
                            lines.append(line)
                    t = "\n".join(lines)
                out.append(t)
            yield pa.array(out, pa.string())

    return kept(F.col(text), F.col(gone))

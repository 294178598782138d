"""Exact shard-scoped dedup (a text is dropped only if an equal text was accepted
earlier *in the same output shard*; a shard holds ``n`` accepted rows).

A shard that opens at position p is the greedy maximal run [p, f(p)) holding n
distinct texts; its accepted rows are the first occurrence of each text inside the
run, and f(p) is the first occurrence of the (n+1)-th distinct text.  Boundaries form a
chain 0 -> f(0) -> f(f(0)) ...; it is computed without a sequential pass and without a
bound on the positions that a shard spans:

1. positions are cut into chunks of ``chunk`` rows.  A chunk's head is its first n+1
   distinct texts with their first positions, its tail the n texts with the last
   occurrences.  Heads of everything from a chunk on come from pointer doubling (the
   head of 2m chunks merges two heads of m chunks);
2. a window that reaches its chunk's end with k distinct texts holds the first k of the
   tail, so its f is the (n+1-k)-th text of the following head that is not among them:
   at most n exits per chunk, however far they lie.  They are the only entries of chunks;
3. one task per chunk follows the chain from every entry to the last shard that opens in
   the chunk; the (entry) -> (next entry, shards) maps are composed by pointer doubling,
   which yields the actual entries and the number of shards before each;
4. one task per chunk replays its shards; the rows that a shard accepts beyond the chunk
   are those first texts of the following head.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_CHUNK = 1 << 20


def _codes(pdf: pd.DataFrame) -> tuple[np.ndarray, int]:
    pdf = pdf.sort_values("pos")
    return pd.factorize(pdf["key"])[0], int(pdf["pos"].iloc[0])


def _neighbours(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the previous (-1: none) and the next (len: none) row with the same text."""
    m = len(codes)
    order = np.argsort(codes, kind="stable")
    same = codes[order][1:] == codes[order][:-1]
    before, after = np.full(m, -1, np.int64), np.full(m, m, np.int64)
    before[order[1:][same]] = order[:-1][same]
    after[order[:-1][same]] = order[1:][same]
    return before, after


def _window_end(before: np.ndarray, p: int, n: int) -> int:
    """Index of the (n+1)-th distinct text from p on; the length if there is none.  Looks at
    stretches of doubling size, so the cost is in proportion to the window."""
    size = 2 * n + 2
    while True:
        new = np.flatnonzero(before[p : p + size] < p)
        if len(new) > n:
            return p + int(new[n])
        if p + size >= len(before):
            return len(before)
        size *= 2


def _next_boundaries(before: np.ndarray, after: np.ndarray, n: int) -> np.ndarray:
    """Index f(i) for every index; -1 where the window reaches the end of the chunk.

    When row i leaves a window whose text does not come again inside it, the window takes row
    f(i) and ends at the next row whose text has not occurred since i."""
    m = len(before)
    out = np.full(m, -1, np.int64)
    x = _window_end(before, 0, n) if m else 0
    prev, nxt = before.tolist(), after.tolist()
    ends = []
    for i in range(m):
        if x == m:
            break
        ends.append(x)
        if nxt[i] >= x:
            x += 1
            while x < m and prev[x] > i:
                x += 1
    out[: len(ends)] = ends
    return out


def _follow(n: int):
    """Per entry: the distinct texts of the last shard that opens here, and the shards."""

    def fn(rows: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(entries):
            return pd.DataFrame([], columns=["dataset", "chunk", "q", "k", "w"])
        codes, base = _codes(rows)
        before, after = _neighbours(codes)
        f = _next_boundaries(before, after, n)
        q = entries["q"].to_numpy(np.int64)
        at, shards = q - base, np.ones(len(q), np.int64)
        while True:  # a shard holds n rows at least, so a chunk takes few steps
            on = np.flatnonzero(f[at] >= 0)
            if not len(on):
                break
            at[on] = f[at[on]]
            shards[on] += 1
        # distinct texts from a place on: the last occurrences there
        kinds = np.cumsum((after == len(codes))[::-1])[::-1][at]
        return pd.DataFrame({"dataset": entries["dataset"].iloc[0], "chunk": entries["chunk"].iloc[0], "q": q, "k": kinds, "w": shards})

    return fn


def _exit_places(place: np.ndarray, n: int, held: int) -> np.ndarray:
    """For a window of k = 1..held texts, the index in the following head of the text that it
    cannot take (-1: the head ends before).  ``place[j]`` is the place of following text j among
    the held texts, latest first (n: not one of them).  Text j is new to a window of k texts if
    its place is k or more, so texts leave one by one as k grows: a Fenwick tree over the head
    gives the (n+1-k)-th of those left, n log n steps for all k."""
    size = len(place)
    top = 1 << max(size, 1).bit_length()
    tree = [0] * (top + 1)
    for j in range(1, top + 1):
        tree[j] += j <= size
        up = j + (j & -j)
        if up <= top:
            tree[up] += tree[j]
    owner = np.full(held + 1, -1, np.int64)
    known = np.flatnonzero(place < held)
    owner[place[known]] = known
    left, out = size, []
    for k, gone in enumerate(owner[:held].tolist(), 1):
        if gone >= 0:
            left -= 1
            j = gone + 1
            while j <= top:
                tree[j] -= 1
                j += j & -j
        want = n + 1 - k
        if want > left:
            out.append(-1)
            continue
        j, step = 0, top
        while step:
            if j + step <= top and tree[j + step] < want:
                j += step
                want -= tree[j]
            step >>= 1
        out.append(j)
    return np.array(out, np.int64)


def _exits(n: int):
    """Per number k of texts in an open window: where it ends after the chunk."""

    def fn(tail: pd.DataFrame, head: pd.DataFrame) -> pd.DataFrame:
        if not len(tail) or not len(head):
            return pd.DataFrame([], columns=["dataset", "chunk", "k", "nq"])
        texts = pd.Index(tail.sort_values("last", ascending=False)["key"])
        following = head.sort_values("pos")
        place = texts.get_indexer(following["key"])
        ends = _exit_places(np.where(place < 0, n, place), n, len(texts))
        k = np.flatnonzero(ends >= 0)
        return pd.DataFrame(
            {
                "dataset": tail["dataset"].iloc[0],
                "chunk": tail["chunk"].iloc[0],
                "k": k + 1,
                "nq": following["pos"].to_numpy(np.int64)[ends[k]],
            }
        )

    return fn


def _replay(n: int):
    def fn(rows: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        positions, numbers = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        if len(rows) and len(right):
            sorted_rows = rows.sort_values("pos")
            codes, base = _codes(sorted_rows)
            before, _ = _neighbours(codes)
            p, shard = int(right["entry"].iloc[0]) - base, int(right["before"].iloc[0])
            while p < len(codes):
                x = _window_end(before, p, n)
                first = p + np.flatnonzero(before[p:x] < p)
                positions.append(base + first)
                if x == len(codes) and len(first) <= n:
                    following = right.dropna(subset=["pos"]).sort_values("pos")
                    new = ~following["key"].isin(sorted_rows["key"].iloc[first])
                    positions.append(following["pos"].to_numpy(np.int64)[new.to_numpy(bool)][: n - len(first)])
                numbers.append(np.full(sum(map(len, positions)) - sum(map(len, numbers)), shard))
                p, shard = x, shard + 1
        name = rows["dataset"].iloc[0] if len(rows) else None
        out = pd.DataFrame({"pos": np.concatenate(positions), "shard": np.concatenate(numbers)})
        out.insert(0, "dataset", pd.Series([name] * len(out), dtype="object"))
        return out

    return fn


def _first(rows: DataFrame, order, most: int) -> DataFrame:
    ranked = rows.withColumn("__rank", F.row_number().over(Window.partitionBy("dataset", "chunk").orderBy(order)))
    return ranked.filter(F.col("__rank") <= most).drop("__rank")


def _text(df: DataFrame, key_col: str):
    """The key as a string (null stays a text of its own: a prefix tells it apart)."""
    kind = df.schema[key_col].dataType.simpleString()
    value = F.hex(key_col) if kind == "binary" else F.col(key_col).cast("string")
    return F.coalesce(F.concat(F.lit("="), value), F.lit("?"))


def sharded_dedup(
    df: DataFrame, dataset_col: str, pos_col: str, key_col: str, max_records: int, chunk: int = DEFAULT_CHUNK
) -> DataFrame:
    """Rows accepted by the shard-scoped rule, with their ``shard`` number.

    ``pos_col`` must be a contiguous 0-based position per dataset (writer order)."""
    if chunk < 2 * max_records:
        chunk = 2 * max_records
    from corpusmill.session import ensure_checkpoint_dir, scratch_dir

    ensure_checkpoint_dir(df.sparkSession)
    schema = "dataset string, chunk long, pos long, key string"
    n, group = max_records, ["dataset", "chunk"]
    keyed = df.select(
        F.col(dataset_col).cast("string").alias("dataset"),
        F.floor(F.col(pos_col) / chunk).cast("long").alias("chunk"),
        F.col(pos_col).cast("long").alias("pos"),
        _text(df, key_col).alias("key"),
    )
    spark, path = df.sparkSession, scratch_dir(df.sparkSession, "sharded-keys")
    keyed.write.parquet(path)  # read in every phase
    keys = lambda: spark.read.schema(schema).parquet(path)
    n_chunks = (keys().agg(F.max("chunk")).first()[0] or 0) + 1

    # heads and tails of chunks; heads of all that follows by doubling
    ends = keys().groupBy(*group, "key").agg(F.min("pos").alias("pos"), F.max("pos").alias("last")).checkpoint()
    tails = _first(ends.select(*group, "key", "last"), F.desc("last"), n)
    heads = _first(ends.select(*group, "key", "pos"), F.asc("pos"), n + 1).checkpoint()
    span = 1
    while span < n_chunks:
        ahead = heads.withColumn("chunk", F.col("chunk") - span).filter("chunk >= 0")
        both = heads.unionByName(ahead).groupBy(*group, "key").agg(F.min("pos").alias("pos"))
        heads = _first(both, F.asc("pos"), n + 1).checkpoint()
        span *= 2
    after = heads.withColumn("chunk", F.col("chunk") - 1).filter("chunk >= 0")

    # exits are the entries of later chunks
    exits = tails.groupBy(*group).cogroup(after.groupBy(*group)).applyInPandas(
        _exits(n), "dataset string, chunk long, k long, nq long"
    ).checkpoint()
    starts = keys().select("dataset").distinct().select("dataset", F.lit(0).cast("long").alias("q"))
    nodes = exits.select("dataset", F.col("nq").alias("q")).unionByName(starts).distinct()
    nodes = nodes.withColumn("chunk", F.floor(F.col("q") / chunk).cast("long"))
    follow = keys().groupBy(*group).cogroup(nodes.groupBy(*group)).applyInPandas(
        _follow(n), "dataset string, chunk long, q long, k long, w long"
    )
    node = follow.join(exits, ["dataset", "chunk", "k"]).select("dataset", "q", "nq", "w").checkpoint()

    # compose the maps by pointer doubling
    jumps, span = [node], 1
    while span * 2 < n_chunks:
        a, b = jumps[-1], jumps[-1].select("dataset", F.col("q").alias("nq"), F.col("nq").alias("mq"), F.col("w").alias("v"))
        jumps.append(a.join(b, ["dataset", "nq"]).select("dataset", "q", F.col("mq").alias("nq"), (F.col("w") + F.col("v")).alias("w")).checkpoint())
        span *= 2
    reached = starts.withColumn("s", F.lit(0).cast("long"))
    for j in reversed(jumps):
        step = reached.join(j, ["dataset", "q"]).select("dataset", F.col("nq").alias("q"), (F.col("s") + F.col("w")).alias("s"))
        reached = reached.unionByName(step).distinct().checkpoint()
    entries = reached.select("dataset", F.floor(F.col("q") / chunk).cast("long").alias("chunk"), F.col("q").alias("entry"), F.col("s").alias("before"))

    # replay the shards of every chunk from its entry
    right = entries.join(after, group, "left")
    accepted = keys().groupBy(*group).cogroup(right.groupBy(*group)).applyInPandas(
        _replay(n), "dataset string, pos long, shard long"
    )
    out = df.withColumn("__ds", F.col(dataset_col).cast("string"))
    res = out.join(accepted.withColumnRenamed("dataset", "__ds").withColumnRenamed("pos", pos_col), ["__ds", pos_col])
    return res.drop("__ds")

"""Streaming jobs resume from their checkpoint: a rerun adds nothing, new files are
picked up exactly once."""

from pyspark.sql import functions as F

from corpusmill.functions import ids as I
from corpusmill.session import scratch_dir
from corpusmill.streaming import incremental as ST


def test_dedup_stream_resumes_without_duplicates(spark):
    base = scratch_dir(spark, "test_stream")
    rows = [(i, f"text {i % 7}" if i % 7 else None) for i in range(40)]
    spark.createDataFrame(rows[:20], "doc_id long, text string").coalesce(1).write.json(f"{base}/in")

    def run():
        s = ST.read_stream_jsonl(spark, f"{base}/in", "doc_id bigint, text string")
        s = s.withColumn("text_sha1", I.text_hash("text")).select("doc_id", "text_sha1")
        ST.run_dedup(s, "text_sha1", "doc_id", f"{base}/seen", f"{base}/ckpt")
        return spark.read.parquet(f"{base}/seen")

    first = run()  # the null text is a key like any other
    assert sorted(r.doc_id for r in first.collect()) == list(range(7))
    again = run()  # nothing new: the checkpoint says every file is done
    assert again.count() == 7
    more = [*rows[20:], (-1, "text 3"), (50, "new"), (49, "new")]
    spark.createDataFrame(more, "doc_id long, text string").repartition(3).write.mode("append").json(f"{base}/in")
    third = run()  # only the new files are read; an earlier id does not replace a first arrival
    assert sorted(r.doc_id for r in third.collect()) == [*range(7), 49]


def test_a_replayed_batch_adds_nothing(spark):
    """The last batch of a checkpoint without its commit is run again, from the same state."""
    import os

    base = scratch_dir(spark, "test_replay")
    for k in range(3):
        rows = [(10 * k + i, None if i == 4 else f"t{(k + i) % 6}") for i in range(5)]
        spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.mode("append").json(f"{base}/in")

    numbers = ST.number_batches(f"{base}/counters", "text", "doc_id")

    def run():
        s = ST.read_stream_jsonl(spark, f"{base}/in", "doc_id bigint, text string", max_files=1)
        ST.run_dedup(s, "text", "doc_id", f"{base}/seen", f"{base}/ckpt")
        ST.run_foreach_batch(s, ST.write_batches(f"{base}/numbered", numbers), f"{base}/ckpt2")
        seen = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{base}/seen").collect())
        return seen, sorted((r.text or "", r.record_index) for r in spark.read.parquet(f"{base}/numbered").collect())

    first = run()
    assert len(first[0]) == 7 and len({t for _, t in first[0]}) == 7
    assert len(set(first[1])) == 15
    for ckpt in ("ckpt", "ckpt2"):
        commits = f"{base}/{ckpt}/commits"
        last = max(f for f in os.listdir(commits) if f.isdigit())
        for name in (last, f".{last}.crc"):
            os.remove(f"{commits}/{name}")
    assert run() == first


def test_stream_ids_go_on_over_batches(spark):
    base = scratch_dir(spark, "test_ids")
    numbers = ST.number_batches(f"{base}/counters", "source", "n")
    rows = [(n, [None, "a", "b"][n % 3 if n < 20 else 1]) for n in range(40)]
    for part in (rows[:7], rows[7:25], rows[25:]):
        spark.createDataFrame(part, "n long, source string").repartition(2).write.mode("append").json(f"{base}/in")
        s = ST.read_stream_jsonl(spark, f"{base}/in", "n bigint, source string")
        ST.run_foreach_batch(s, ST.write_batches(f"{base}/out", numbers), f"{base}/ckpt")
    got = {r.n: r.record_index for r in spark.read.parquet(f"{base}/out").collect()}
    want = {n: sum(1 for m, s in rows if s == source and m < n) for n, source in rows}
    assert got == want


def test_scores_are_made_once_per_key(spark):
    base = scratch_dir(spark, "test_score")
    known = lambda rows: spark.createDataFrame(rows, "k long, family string").write.mode("append").partitionBy("family").parquet(f"{base}/art")
    come = lambda rows: spark.createDataFrame(rows, "k long, family string, text string").coalesce(1).write.mode("append").json(f"{base}/in")

    def run():
        s = ST.read_stream_jsonl(spark, f"{base}/in", "k bigint, family string, text string", max_files=1)
        art = spark.readStream.schema("k bigint, family string").parquet(f"{base}/art")
        scorer = lambda df: df.select("k", "family", F.length("text").alias("score"))
        ST.run_scoring(s, art, ["k", "family"], scorer, f"{base}/scores", f"{base}/ckpt")
        return sorted(((r.k or 0), r.family, r.score) for r in spark.read.parquet(f"{base}/scores").collect())

    known([(1, "m"), (2, "c")])
    come([(1, "m", "a"), (1, "c", "bb"), (3, "m", "ccc"), (3, "m", "ccc"), (None, "m", "d")])
    come([(3, "m", "again"), (4, "c", "e")])
    first = [(0, "m", 1), (1, "c", 2), (3, "m", 3), (4, "c", 1)]
    assert run() == first
    known([(5, "m")])
    come([(5, "m", "x"), (4, "c", "y"), (6, "c", "zz")])
    assert run() == [*first, (6, "c", 2)]


def pads(notes, keep=8):
    out, pad = [], []
    for note in notes:
        pad = [*pad, note][-keep:] if note is not None else pad
        out.append(("\n".join(pad), len(pad)))
    return out


def test_scratchpad_turns_in_any_order_equal_the_batch(spark):
    import random

    from corpusmill.operators.tools import scratchpad_renders

    rng = random.Random(1)
    base = scratch_dir(spark, "test_pad")
    rows = [(c, t, None if rng.random() < 0.4 else f"c{c} t{t}") for c in range(4) for t in range(30)]
    rows += [(9, t, f"late {t}") for t in range(3, 6)]  # turns 0 to 2 never come: these wait
    parts = [[] for _ in range(4)]
    for r in rows:
        rng.choice(parts).append(r)
    for part in parts:
        spark.createDataFrame(part, "conv_id long, turn long, note string").coalesce(1).write.mode("append").json(f"{base}/in")
    s = ST.read_stream_jsonl(spark, f"{base}/in", "conv_id bigint, turn bigint, note string", max_files=1)
    ST.run_to_parquet(ST.scratchpad_stream(s), f"{base}/out", f"{base}/ckpt")
    got = {(r.conv_id, r.turn): (r.pad, r.n_notes) for r in spark.read.parquet(f"{base}/out").collect()}
    want = {}
    for c in range(4):
        want.update({(c, t): p for t, p in enumerate(pads([r[2] for r in rows if r[0] == c]))})
    assert got == want
    df = spark.createDataFrame([r for r in rows if r[0] < 4], "conv_id long, turn long, note string")
    df = df.withColumn("arg", F.regexp_replace("note", "^", "n: "))
    batch = scratchpad_renders(df, ["conv_id"], ["turn"], "arg").collect()
    assert {(r.conv_id, r.turn): (r.pad.replace("n: ", ""), r.n_notes) for r in batch} == want


def test_scratchpad_timer_ends_the_wait():
    """The processor with plain dictionaries for its states."""
    import pandas as pd

    class Value:
        def __init__(self):
            self.v = None

        exists = lambda self: self.v is not None
        get = lambda self: self.v

        def update(self, v):
            self.v = v

        put = update

    class Items(dict):
        containsKey, getValue, updateValue, removeKey = dict.__contains__, dict.__getitem__, dict.__setitem__, dict.__delitem__
        iterator = dict.items

    class Now:
        getCurrentProcessingTimeInMs = lambda self: 100

    class Handle:
        timers = []
        listTimers = lambda self: self.timers
        getValueState = lambda self, *a: Value()
        getMapState = lambda self, *a: Items()

        def getListState(self, *a):
            state = Value()
            state.v = []
            return state

        def registerTimer(self, at):
            self.timers.append(at)

    p = ST.ScratchpadProcessor(patience_ms=50)
    p.init(Handle())
    feed = lambda *rows: [
        (t, pad, n)
        for f in p.handleInputRows((7,), iter([pd.DataFrame(rows, columns=["turn", "note"])]), Now())
        for _, t, pad, n in f.itertuples(index=False)
    ]
    assert feed((4, "e"), (2, "c"), (2, "c2")) == [] and Handle.timers == [150]
    assert feed((0, "a")) == [(0, "a", 1)]
    (flushed,) = p.handleExpiredTimer((7,), Now(), None)
    assert flushed["turn"].tolist() == [2, 2, 4] and flushed["pad"].tolist()[-1] == "a\nc\nc2\ne"
    assert feed((1, "b"), (5, None)) == [(1, "a\nc\nc2\ne\nb", 5), (5, "a\nc\nc2\ne\nb", 5)]

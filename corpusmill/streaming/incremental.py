"""Incremental (Structured Streaming) versions of ingest, dedup, scratchpad and scoring.

All run with ``trigger(availableNow=True)``: every file present when the query starts
is processed (in micro-batches of ``max_files`` files), progress is kept in the
checkpoint folder, and a restart after a failure resumes from it.  The column logic
is the same pure functions as the batch operators.  What a micro-batch writes goes to a
partition of its own (``batch_id``), which a replay of the batch overwrites.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from corpusmill.operators.ordinals import null_safe_join, with_ordinal
from corpusmill.sinks.writers import table_exists

MAX_FILES = 1000  # per micro-batch
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def read_stream_jsonl(spark: SparkSession, folder: str, schema: T.StructType | str, max_files: int = MAX_FILES) -> DataFrame:
    """New JSON-lines files in ``folder`` as a stream (explicit schema, bad lines dropped)."""
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", max_files)
        .option("mode", "DROPMALFORMED")
        .json(folder)
    )


def run_to_parquet(stream: DataFrame, sink: str, checkpoint: str, partition_cols=()) -> None:
    """Append a stream to a parquet folder, processing everything available now."""
    w = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    q = w.trigger(availableNow=True).start(sink)
    q.awaitTermination()


def run_foreach_batch(stream: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    q = stream.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def _keyed_state(spark: SparkSession) -> None:
    """Keep the state of keyed operators on disk, by key: a batch reads and writes the keys it
    brings.  A provider chosen by the session stays."""
    if not spark.conf.get(STATE_STORE, ""):
        spark.conf.set(STATE_STORE, ROCKSDB)


def write_batches(table_path: str, body: Callable[[DataFrame, int], DataFrame] | None = None) -> Callable[[DataFrame, int], None]:
    """foreachBatch body: ``body`` of every batch in a partition ``batch_id`` of the table."""

    def fn(batch: DataFrame, batch_id: int) -> None:
        out = batch if body is None else body(batch, batch_id)
        out.write.mode("overwrite").parquet(f"{table_path}/batch_id={batch_id}")

    return fn


def number_batches(counters_path: str, source_col: str, order_cols, name: str = "record_index") -> Callable[[DataFrame, int], DataFrame]:
    """Record ordinals that go on from batch to batch: per source (a null source is one) the
    rows of a batch are numbered in ``order_cols`` order after those of all earlier batches, so
    that the ids of a stream are those of one batch run over the same rows in arrival order.

    The counters are a table with a partition per batch: the rows of each source up to its end.
    A batch reads the partition of the batch before and overwrites its own, so a replayed batch
    numbers its rows as before."""

    def body(batch: DataFrame, batch_id: int) -> DataFrame:
        spark = batch.sparkSession
        batch = batch.persist()  # read for the counts, the bounds and the rows
        counts = batch.groupBy(source_col).agg(F.count(F.lit(1)).alias("n"))
        before = f"{counters_path}/batch_id={batch_id - 1}"
        if batch_id > 0 and table_exists(spark, before):
            earlier = spark.read.parquet(before)
        else:
            earlier = spark.createDataFrame([], counts.schema)
        totals = earlier.unionByName(counts).groupBy(source_col).agg(F.sum("n").alias("n"))
        totals.write.mode("overwrite").parquet(f"{counters_path}/batch_id={batch_id}")
        numbered = with_ordinal(batch, order_cols, source_col, name="__own")
        numbered = null_safe_join(numbered, earlier.withColumnRenamed("n", "__before"), [source_col], "left")
        index = F.col("__own") + F.coalesce("__before", F.lit(0))
        return numbered.withColumn(name, index.cast("bigint")).drop("__own", "__before")

    return body


def first_of_key(stream: DataFrame, key_col: str, order_col: str) -> DataFrame:
    """Incremental dedup with keyed state: the rows whose key (null is one) has not come in an
    earlier batch, of those in one batch the first in ``order_col`` order.  Use update mode.

    The state store has one entry per key: a batch touches the entries of its own keys, however
    many there are, and a replayed batch finds the state as it was before it."""
    _keyed_state(stream.sparkSession)
    columns = stream.columns
    timed = stream.withColumn("__now", F.current_timestamp())  # one per micro-batch, the same when it is replayed
    rows = timed.groupBy(F.col(key_col).alias("__key")).agg(
        F.min_by(F.struct(*columns), F.col(order_col)).alias("__row"), F.min("__now").alias("__first")
    )
    return rows.filter(F.col("__first") == F.current_timestamp()).select("__row.*")


def run_dedup(stream: DataFrame, key_col: str, order_col: str, table_path: str, checkpoint: str) -> None:
    """``first_of_key`` of everything available now, appended to a table by batch."""
    firsts = first_of_key(stream, key_col, order_col)
    writer = firsts.writeStream.outputMode("update").foreachBatch(write_batches(table_path))
    writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def pending_of_stream(stream: DataFrame, known: DataFrame, key_cols) -> DataFrame:
    """Rows of ``stream`` whose keys have neither come before nor are among ``known``, a stream
    of the keys that have an artifact.  Use update mode.  The state store has one entry per key;
    artifacts are read once, as their files appear, not once per batch."""
    _keyed_state(stream.sparkSession)
    keys, columns = list(key_cols), stream.columns
    own = stream.withColumn("__known", F.lit(False))
    rows = own.unionByName(known.select(*keys).withColumn("__known", F.lit(True)), allowMissingColumns=True)
    rows = rows.withColumn("__now", F.current_timestamp())  # one per micro-batch, the same when it is replayed
    sample = ~F.col("__known")
    state = rows.groupBy(*[F.col(k).alias(f"__key_{k}") for k in keys]).agg(
        F.min(F.when(sample, F.struct(*columns))).alias("__row"),
        F.min(F.when(sample, F.col("__now"))).alias("__first"),
        F.bool_or("__known").alias("__known"),
    )
    return state.filter(~F.col("__known") & (F.col("__first") == F.current_timestamp())).select("__row.*")


def run_scoring(
    stream: DataFrame, known: DataFrame, key_cols, scorer: Callable[[DataFrame], DataFrame], scores_path: str, checkpoint: str
) -> None:
    """Score what is pending of everything available now; a batch's scores are a partition of
    the table at ``scores_path``.  Let ``known`` read all its files in one micro-batch, so that an
    artifact is known before a sample that came later."""
    todo = pending_of_stream(stream, known, key_cols)
    body = write_batches(scores_path, lambda batch, _: scorer(batch))
    writer = todo.writeStream.outputMode("update").foreachBatch(body).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()


PAD_OUTPUT = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("turn", T.LongType()),
        T.StructField("pad", T.StringType()),
        T.StructField("n_notes", T.LongType()),
    ]
)


class ScratchpadProcessor(StatefulProcessor):
    """Per key: add notes in turn order and emit the rendered pad after each turn.

    Value state holds the next turn, the last ``keep`` notes and how many turns wait; map state
    the turns that arrived early (read only if some wait).  They wait for the missing ones; with ``patience_ms`` a timer ends the wait
    after so much processing time, and what waits is then taken in turn order.  A null note adds nothing
    but its turn shows the pad; a null turn or one that was passed is taken when it arrives."""

    def __init__(self, keep: int = 8, first_turn: int = 0, patience_ms: int | None = None, key_col: str = "conv_id"):
        self.keep, self.first_turn, self.patience_ms, self.key_col = keep, first_turn, patience_ms, key_col

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", "turn bigint, notes array<string>, waiting bigint")
        self.early = handle.getMapState("early", "turn bigint", "notes array<string>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        found = pd.concat(list(rows), ignore_index=True)
        arrived = sorted(
            ((None if pd.isna(t) else int(t), None if pd.isna(n) else n) for t, n in zip(found["turn"], found["note"])),
            key=lambda r: (r[0] is not None, r[0] or 0),
        )
        following, pad, held_back = self._state()
        out: list = []
        waiting: dict[int, list] = {}
        for turn, note in arrived:
            if turn is not None and turn > following:
                waiting.setdefault(turn, []).append(note)
                continue
            self._take(turn, [note], pad, out)
            following = following if turn is None else max(following, turn + 1)
            while True:  # turns that waited for this one
                held = waiting.pop(following, [])
                if held_back and self.early.containsKey((following,)):
                    held = [*self.early.getValue((following,))[0], *held]
                    self.early.removeKey((following,))
                    held_back -= 1
                if not held:
                    break
                self._take(following, held, pad, out)
                following += 1
        added = 0
        for turn, notes in waiting.items():
            known = list(self.early.getValue((turn,))[0]) if held_back and self.early.containsKey((turn,)) else []
            self.early.updateValue((turn,), ([*known, *notes],))
            added += not known
        if waiting and self.patience_ms is not None and not list(self.handle.listTimers()):
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.patience_ms)
        self.state.update((following, pad, held_back + added))
        yield from self._rows(key, out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        (following, pad, _), out = self._state(), []
        for (turn,), (notes,) in sorted(((tuple(k), tuple(v)) for k, v in self.early.iterator()), key=lambda r: r[0]):
            self._take(turn, notes, pad, out)
            following = max(following, turn + 1)
        self.early.clear()
        self.state.update((following, pad, 0))
        yield from self._rows(key, out)

    def _take(self, turn, notes, pad: list, out: list) -> None:
        for note in notes:
            if note is not None:
                pad.append(note)
                del pad[: -self.keep]
            out.append((turn, "\n".join(pad), len(pad)))

    def _state(self) -> tuple[int, list, int]:
        known = self.state.get()
        return (self.first_turn, [], 0) if known is None else (known[0], list(known[1]), known[2])

    def _rows(self, key, out: list) -> Iterator[pd.DataFrame]:
        if out:
            frame = pd.DataFrame(out, columns=["turn", "pad", "n_notes"])
            frame["turn"] = frame["turn"].astype("Int64")
            frame.insert(0, self.key_col, pd.array([key[0]] * len(out), dtype="Int64"))
            yield frame

    def close(self) -> None:
        pass


def scratchpad_stream(stream: DataFrame, key_col: str = "conv_id", keep: int = 8, patience_ms: int | None = None) -> DataFrame:
    """``(key, turn, pad, n_notes)`` of a stream of ``(key, turn, note)``; turns may arrive in any
    order (see ``ScratchpadProcessor``).  A stream with timers always has a next micro-batch, so
    ``patience_ms`` is for streams that run on, not for ``availableNow``."""
    _keyed_state(stream.sparkSession)
    schema = T.StructType([T.StructField(key_col, T.LongType()), *PAD_OUTPUT.fields[1:]])
    return stream.groupBy(key_col).transformWithStateInPandas(
        ScratchpadProcessor(keep, 0, patience_ms, key_col), schema, "append", "none" if patience_ms is None else "processingTime"
    )

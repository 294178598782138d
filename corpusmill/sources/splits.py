"""Records from a table of paths: files and byte ranges are rows, planned and read in tasks.

1. ``expand_paths``: patterns -> files with their sizes, listed in tasks.  A pattern that
   matches nothing stays as it is.
2. ``plan_splits``: files -> ranges of about ``split_bytes``.  A JSON Lines file is cut by
   bytes (a line belongs to the range in which it begins), a large gzip file by the seek
   points of ``gzindex`` (one pass over the file, which also numbers its lines), a parquet file
   by row groups (its footer is read).  The plan is a written table: it is made once and can
   be used again.
3. ``read_splits``: a task per large range or per many small ones; JSON lines come out as text, parquet rows
   as columns, both in one frame.

The driver sees no path and no listing; 100,000 files are as many rows of the plan.  A file
that cannot be read to its end fails the job or, with ``keep_faults``, gives a row with
``error`` after the lines that could be read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from contextlib import closing

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corpusmill.session import scratch_dir
from corpusmill.sources import gzindex
from corpusmill.sources.stores import list_matching, open_store

SPLIT_BYTES = 64 << 20
CHUNK = 1 << 20
BATCH_LINES = 4096
MAX_TASKS = 1 << 16
OPEN_BYTES = 1 << 18  # what opening a range costs, in bytes read

_PLAN = (
    "file string, no int, kind string, start bigint, end bigint, window binary, skip bigint, take bigint, "
    "lines bigint, error string"
)


def paths_table(spark: SparkSession, patterns) -> DataFrame:
    """A table of patterns from one pattern or a list of them."""
    listed = [patterns] if isinstance(patterns, str) else list(patterns)
    return spark.createDataFrame([(p,) for p in listed], "pattern string")


def _spread(df: DataFrame, *by: str) -> DataFrame:
    return df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism, *by)


def _per_row(df: DataFrame, fn, schema: StructType) -> DataFrame:
    """``fn(row dict) -> iterable of tuples`` appended to the columns of each row."""
    kept = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in batches:
            at, out = [], []
            for k, row in enumerate(batch.to_pylist()):
                rows = list(fn(row))
                at += [k] * len(rows)
                out += rows
            same = batch.take(pa.array(at, pa.int64()))
            columns = [same.column(c).cast(arrow.field(c).type) for c in kept]
            new = [f for f in arrow if f.name not in kept]
            columns += [pa.array([r[k] for r in out], f.type) for k, f in enumerate(new)]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return df.mapInArrow(run, schema)


def expand_paths(patterns: DataFrame, pattern_col: str = "pattern") -> DataFrame:
    """The rows of ``patterns`` for every file that matches: ``file`` and ``size`` (null for a
    pattern that matches nothing, which is then the file)."""

    def listed(row: dict) -> list[tuple]:
        found = [] if row[pattern_col] is None else list_matching(row[pattern_col])
        found = [f for f in found if not f.path.rsplit("/", 1)[-1].startswith((".", "_"))]  # as Spark's own listing
        return [(f.path, f.size) for f in found] or [(row[pattern_col], None)]

    schema = StructType([*patterns.schema.fields, *StructType.fromDDL("file string, size bigint").fields])
    return _per_row(_spread(patterns, pattern_col), listed, schema)


def _is(path: str, suffix: str) -> bool:
    return path.lower().endswith(suffix)


def _ranges(path: str, size: int | None, split_bytes: int) -> Iterator[tuple]:
    """The plan's rows of one file, in order."""
    if size is None:
        yield path, 0, "lines", 0, 0, None, 0, 0, 0, "FileNotFoundError"
        return
    try:
        if _is(path, ".parquet"):
            store, inner = open_store(path)
            groups = pq.ParquetFile(inner, filesystem=store).metadata
            first = held = no = lines = ahead = 0
            for k in range(groups.num_row_groups):
                held += groups.row_group(k).total_byte_size
                ahead += groups.row_group(k).num_rows
                if held >= split_bytes or k == groups.num_row_groups - 1:
                    yield path, no, "parquet", first, k + 1, None, 0, 0, lines, None
                    first, held, no, lines = k + 1, 0, no + 1, ahead
        elif _is(path, ".gz") and size > split_bytes:
            store, inner = open_store(path)
            with closing(store.open_input_file(inner)) as file:
                for no, p in enumerate(gzindex.seek_points(lambda at, n: file.read_at(n, at), size, split_bytes)):
                    yield path, no, "point", p.bit, size, p.window, p.skip, p.take, p.lines, p.error
        elif _is(path, ".gz"):
            yield path, 0, "gzip", 0, size, None, 0, 0, 0, None
        else:
            for no, start in enumerate(range(0, max(size, 1), split_bytes)):
                yield path, no, "lines", start, min(start + split_bytes, size), None, 0, 0, 0 if not start else None, None
    except (OSError, zlib.error, pa.ArrowInvalid) as failure:
        yield path, 0, "lines", 0, 0, None, 0, 0, 0, type(failure).__name__


def plan_splits(files: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The ranges of ``files`` (file, size): a written table with the other columns of
    ``files`` beside it."""
    renamed = files.withColumnsRenamed({"file": "__file", "size": "__size"})
    schema = StructType([*renamed.schema.fields, *StructType.fromDDL(_PLAN).fields])
    plan = _per_row(_spread(renamed, "__file"), lambda r: _ranges(r["__file"], r["__size"], split_bytes), schema)
    path = scratch_dir(files.sparkSession, "split-plan")
    plan.drop("__file", "__size").write.parquet(path)
    return files.sparkSession.read.parquet(path)


# -- reading


def _pieces(row: dict) -> Iterator[bytes]:
    """The bytes of a range's lines."""
    store, inner = open_store(row["file"])
    with closing(store.open_input_file(inner)) as file:
        read = lambda at, n: file.read_at(n, at)
        if row["kind"] == "point":
            window = None if row["window"] is None else bytes(row["window"])
            point = gzindex.Point(row["start"], window, row["skip"], row["take"], 0, None)
            yield from gzindex.read_point(read, row["end"], point)
        elif row["kind"] == "gzip":
            inflate, at = zlib.decompressobj(31), 0
            while at < row["end"]:
                chunk = read(at, CHUNK)
                if not chunk:
                    break
                yield inflate.decompress(chunk)
                at += len(chunk)
                if inflate.eof:
                    at -= len(inflate.unused_data)
                    while at < row["end"] and read(at, 1) == b"\0":  # padding
                        at += 1
                    if at < row["end"]:
                        inflate = zlib.decompressobj(31)
            if not inflate.eof:
                raise EOFError
        else:
            yield from _range(read, row["start"], row["end"])


def _range(read, start: int, end: int) -> Iterator[bytes]:
    """Lines that begin in ``start .. end``: from the byte after the first line break at or
    after ``start - 1`` to the first line break at or after ``end - 1``."""
    at = start
    if start:
        at = _after_break(read, start - 1)
        if at is None or at >= end:
            return
    while at < end:
        chunk = read(at, min(CHUNK, end - at))
        if not chunk:
            return
        yield chunk
        at += len(chunk)
    if at == end and end:
        stop = _after_break(read, end - 1)
        while stop is None or at < stop:
            chunk = read(at, CHUNK if stop is None else min(CHUNK, stop - at))
            if not chunk:
                return
            yield chunk
            at += len(chunk)


def _after_break(read, at: int) -> int | None:
    while chunk := read(at, CHUNK):
        cut = chunk.find(b"\n")
        if cut >= 0:
            return at + cut + 1
        at += len(chunk)
    return None


def _lines(row: dict) -> Iterator[list[bytes]]:
    """Non-blank lines of a range, in lists; what could be read before a failure comes first."""
    rest: list[bytes] = []
    failed = None
    try:
        for piece in _pieces(row):
            whole, cut, tail = piece.rpartition(b"\n")
            if cut:
                found = [x for x in b"".join([*rest, whole]).splitlines() if x.strip(b" ")]
                rest = []
                for k in range(0, len(found), BATCH_LINES):
                    yield found[k : k + BATCH_LINES]
            rest.append(tail)
    except _FAILURES as failure:
        failed = failure
    yield [x for x in b"".join(rest).splitlines() if x.strip(b" ")]
    if failed is not None:
        raise failed


_FAILURES = (OSError, EOFError, zlib.error, pa.ArrowInvalid)


def number_lines(plan: DataFrame) -> DataFrame:
    """``plan`` with ``lines`` = non-blank lines before each range in its file: ranges of plain
    files are counted in one pass, then summed up over a file's ranges.  A file's last range is
    not counted, so a file of one range is read once only."""
    plan = plan.withColumn("__last", F.col("no") == F.max("no").over(Window.partitionBy("file")))

    def counted(row: dict) -> list[tuple]:
        try:
            wanted = row["kind"] == "lines" and row["error"] is None and not row["__last"]
            return [(sum(len(x) for x in _lines(row)),)] if wanted else [(0,)]
        except _FAILURES:
            return [(0,)]

    schema = StructType([*plan.schema.fields, *StructType.fromDDL("__n bigint").fields])
    path = scratch_dir(plan.sparkSession, "split-lines")
    _per_row(_tasks(plan), counted, schema).write.parquet(path)
    counts = plan.sparkSession.read.parquet(path)
    before = Window.partitionBy("file").orderBy("no").rowsBetween(Window.unboundedPreceding, -1)
    total = F.coalesce(F.sum("__n").over(before), F.lit(0))  # a row per range of the file
    return counts.withColumn("lines", F.when(F.col("kind") == "lines", total).otherwise(F.col("lines"))).drop("__n", "__last")


def _tasks(plan: DataFrame) -> DataFrame:
    """Ranges dealt to tasks: a task per large range, small ranges share one."""
    size = F.when(F.col("kind").isin("lines", "gzip"), F.col("end") - F.col("start")).otherwise(SPLIT_BYTES)
    count, held = plan.agg(F.count(F.lit(1)), F.sum(size + OPEN_BYTES)).first()  # the written plan
    least = 4 * plan.sparkSession.sparkContext.defaultParallelism
    tasks = max(least, -(-2 * (held or 0) // SPLIT_BYTES))
    return plan.repartition(max(1, min(count, tasks, MAX_TASKS)), "file", "no")


def read_splits(plan: DataFrame, columns: str = "", keep_faults: bool = False) -> DataFrame:
    """The records of a plan: its own columns beside ``file``, ``no``, ``line_no`` (within the
    file if ``lines`` is known, else null), ``line`` (JSON Lines) and ``columns`` (DDL; read
    from parquet files, null where a file has no such column), ``error`` (see the module)."""
    wanted = StructType.fromDDL(columns) if columns else StructType([])
    planned = set(StructType.fromDDL(_PLAN).fieldNames())
    others = [f.name for f in plan.schema.fields if f.name not in planned]
    head = StructType([plan.schema[c] for c in others])
    tail = StructType.fromDDL("file string, no int, line_no bigint, line string")
    schema = StructType([*head.fields, *tail.fields, *wanted.fields, *StructType.fromDDL("error string").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        names = [f.name for f in wanted.fields]

        def rows(row: dict, n: int, first: int, given: dict) -> pa.RecordBatch:
            columns = []
            for field in arrow:
                name = field.name
                if name in given:
                    columns.append(given[name].cast(field.type))
                elif name == "line_no" and row["lines"] is not None:
                    columns.append(pa.array(range(row["lines"] + first, row["lines"] + first + n), pa.int64()))
                else:
                    value = row[name] if name in row and name not in (*names, "line", "error", "line_no") else None
                    columns.append(pa.repeat(pa.scalar(value, field.type), n))
            return pa.RecordBatch.from_arrays(columns, schema=arrow)

        for batch in batches:
            for row in batch.to_pylist():
                first, error = 0, row["error"]
                try:
                    if row["kind"] == "parquet":
                        for part in _parquet(row, names):
                            yield rows(row, part.num_rows, first, {c: part.column(c) for c in part.schema.names})
                            first += part.num_rows
                    elif error is None or row["kind"] == "point":
                        for found in _lines(row):
                            text = [x.decode("utf-8", "ignore") for x in found]
                            yield rows(row, len(text), first, {"line": pa.array(text, pa.string())})
                            first += len(text)
                except _FAILURES as failure:
                    error = type(failure).__name__
                if error is not None and not keep_faults:
                    raise OSError(f"{row['file']}: {error}")
                if error is not None:
                    yield rows(row, 1, first, {"error": pa.array([error]), "line_no": pa.array([None], pa.int64())})

    return _tasks(plan).mapInArrow(run, schema)


def _parquet(row: dict, names: list[str]) -> Iterator[pa.RecordBatch]:
    store, inner = open_store(row["file"])
    file = pq.ParquetFile(inner, filesystem=store)
    there = [c for c in names if c in file.schema_arrow.names]
    groups = range(row["start"], row["end"])
    for batch in file.iter_batches(4096, row_groups=list(groups), columns=there):
        yield batch

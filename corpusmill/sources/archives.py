"""Zip archives as a Spark data source (Python Data Source API).

Archives are listed and opened through pyarrow's file systems, so they may lie in any
shared store.  Archives up to ``SPLIT_BYTES`` share input partitions of about that size, a
larger one is cut into ranges of members (by compressed size, read from its central directory
when the read is planned).  A task streams its members and gives Arrow batches.  Shapes:

* ``lines``   -> every non-directory member decoded as UTF-8 (bad bytes dropped), split on
  universal newlines (1-based line numbers);
* ``members`` -> one row per member with its whole content;
* ``code``    -> an archive with any ``*.jsonl`` member: the stripped, non-blank lines of
  those members; any other: each file with an extension of ``CODE_EXTENSIONS``, whole.
  Members that do not count are never decompressed.

``member_no`` is the member's place in the archive.  Register once per session.
"""

from __future__ import annotations

import io
import os
import zipfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from corpusmill.functions.text import CODE_EXTENSIONS
from corpusmill.sources.stores import list_matching, open_store

FORMAT = "corpusmill_zip"
SPLIT_BYTES = 64 << 20
OPEN_BYTES = 1 << 18  # what opening an archive costs, in bytes read
LEAST_TASKS = 64
BATCH_BYTES = 4 << 20
SCHEMAS = {
    "lines": "archive string, member string, member_no int, line_no bigint, line string",
    "members": "archive string, member string, member_no int, is_dir boolean, content string",
    "code": "archive string, member string, member_no int, line_no bigint, from_jsonl boolean, content string",
}


class MemberRanges(InputPartition):
    """Ranges ``(path, first, end)`` of members."""

    def __init__(self, ranges: list[tuple[str, int, int | None]]):
        super().__init__(tuple(ranges))
        self.ranges = ranges


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _open(path: str) -> zipfile.ZipFile:
    store, inner = open_store(path)
    return zipfile.ZipFile(store.open_input_file(inner))


class ZipReader(DataSourceReader):
    def __init__(self, options: dict, mode: str, schema: StructType):
        self.pattern, self.schema = options.get("path", ""), schema
        self.mode = mode

    def partitions(self):
        out, small, held = [], [], 0
        found = list_matching(self.pattern)
        # no more small archives together than keep some tasks busy
        bound = min(SPLIT_BYTES, max(1, sum(size + OPEN_BYTES for _, size in found) // LEAST_TASKS))
        for path, size in found:
            if size <= SPLIT_BYTES:
                small.append((path, 0, None))
                held += size + OPEN_BYTES
                if held >= bound:
                    out.append(MemberRanges(small))
                    small, held = [], 0
                continue
            with _open(path) as archive:
                first = ranged = 0
                members = archive.infolist()
                for k, info in enumerate(members):
                    ranged += info.compress_size
                    if ranged >= SPLIT_BYTES or k == len(members) - 1:
                        out.append(MemberRanges([(path, first, k + 1)]))
                        first, ranged = k + 1, 0
        return out + ([MemberRanges(small)] if small else [])

    def read(self, partition):
        """The rows in Arrow batches of bounded size."""
        rows, held = [], 0
        schema = to_arrow_schema(self.schema)
        for row in self._rows(partition):
            rows.append(row)
            held += len(row[-1] or "") + 64
            if held >= BATCH_BYTES:
                yield _batch(rows, schema)
                rows, held = [], 0
        if rows:
            yield _batch(rows, schema)

    def _rows(self, partition):
        for path, first, end in partition.ranges:
            with _open(path) as archive:
                yield from self._members(archive, path, first, end)

    def _members(self, archive: zipfile.ZipFile, path: str, first: int, end: int | None):
        members = archive.infolist()
        json_lines = any(m.filename.lower().endswith(".jsonl") for m in members)
        for no, info in enumerate(members[first:end], first):
            at = (path, info.filename, no)
            if self.mode == "members":
                yield (*at, info.is_dir(), None if info.is_dir() else archive.read(info).decode("utf-8", "ignore"))
            elif self.mode == "lines" and not info.is_dir():
                yield from ((*at, k, line) for k, line in self._lines(archive, info))
            elif self.mode == "code" and json_lines and info.filename.lower().endswith(".jsonl"):
                for k, line in self._lines(archive, info):
                    if stripped := line.strip():
                        yield (*at, k, True, stripped)
            elif self.mode == "code" and not json_lines and not info.is_dir():
                if os.path.splitext(info.filename)[1].lower() in CODE_EXTENSIONS:
                    yield (*at, 1, False, archive.read(info).decode("utf-8", "ignore"))

    @staticmethod
    def _lines(archive: zipfile.ZipFile, info: zipfile.ZipInfo):
        with archive.open(info) as raw:
            text = io.TextIOWrapper(raw, encoding="utf-8", errors="ignore")
            for k, line in enumerate(text, start=1):
                yield k, line.removesuffix("\n")


class ZipSource(DataSource):
    """``spark.read.format("corpusmill_zip").option("mode", ...).load(glob)``"""

    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        return SCHEMAS[self.options.get("mode", "lines")]

    def reader(self, schema):
        return ZipReader(self.options, self.options.get("mode", "lines"), schema)


def read_zip(spark: SparkSession, pattern: str, mode: str) -> DataFrame:
    spark.dataSource.register(ZipSource)
    return spark.read.format(FORMAT).option("mode", mode).load(pattern)


def read_zip_lines(spark: SparkSession, pattern: str) -> DataFrame:
    return read_zip(spark, pattern, "lines")


def read_zip_members(spark: SparkSession, pattern: str) -> DataFrame:
    return read_zip(spark, pattern, "members")

"""Files of any content with a commit protocol, as a Spark data source (Python Data Source API).

``write_files`` takes rows ``(file, data)``: consecutive rows of a partition with the same
relative name are that file's bytes.  Every task attempt writes into a folder of its own below
``_staging/<job>``; an attempt that fails, is killed or runs twice (speculation) has touched
nothing else.  When all tasks are done the driver gets one short message per successful
attempt, writes them down as the commit record and moves these attempts' files to their names;
what other attempts left goes with the staging folder.  A failed job is aborted the same way.
A driver that dies after the record was written leaves a commit that ``recover`` finishes
(moving is idempotent), one that dies before leaves nothing that readers see.

Names must be unique over partitions.  A file that exists is replaced by the commit.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from corpusmill.sources.stores import open_store

FORMAT = "corpusmill_files"
STAGING, COMMITS, RECORD, LISTING = "_staging", "_commits", "_record.json", "_files.jsonl"
MOVERS = 16


@dataclass
class Attempt(WriterCommitMessage):
    """A successful task attempt: its folder below the job's staging folder."""

    name: str


def _missing(store: pafs.FileSystem, path: str) -> bool:
    return store.get_file_info(path).type == pafs.FileType.NotFound


def _drop(store: pafs.FileSystem, folder: str) -> None:
    if not _missing(store, folder):
        store.delete_dir(folder)


def _files(store: pafs.FileSystem, folder: str, recursive: bool = False) -> set[str]:
    found = store.get_file_info(pafs.FileSelector(folder, recursive=recursive))
    return {f"{folder}/{info.path[len(folder) :].strip('/')}" for info in found if info.type == pafs.FileType.File}


def _text(store: pafs.FileSystem, path: str) -> str:
    with store.open_input_stream(path, compression=None) as f:
        return f.read().decode()


class FilesWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path, self.job = options["path"].rstrip("/"), options.get("job") or uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Attempt:
        store, root = open_store(self.path)
        name = uuid.uuid4().hex
        base = f"{root}/{STAGING}/{self.job}/{name}"
        store.create_dir(base, recursive=True)
        listing, now, out, folders = [], None, None, {base}
        try:
            for batch in iterator:
                for file, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    if file != now:
                        if out is not None:
                            out.close()
                        now = file
                        folder = f"{base}/{file}".rsplit("/", 1)[0]
                        if folder not in folders:
                            store.create_dir(folder, recursive=True)
                            folders.add(folder)
                        out = store.open_output_stream(f"{base}/{file}", compression=None)
                        listing.append({"file": file, "rows": 0, "bytes": 0})
                    out.write(data or b"")
                    listing[-1]["rows"] += 1
                    listing[-1]["bytes"] += len(data or b"")
            if out is not None:
                out.close()
            with store.open_output_stream(f"{base}/{LISTING}", compression=None) as f:
                f.write("".join(json.dumps(x) + "\n" for x in listing).encode())
        except BaseException:
            _drop(store, base)
            raise
        return Attempt(name)

    def commit(self, messages: list[Attempt | None]) -> None:
        store, root = open_store(self.path)
        job = f"{root}/{STAGING}/{self.job}"
        store.create_dir(job, recursive=True)  # a write without partitions made none
        with store.open_output_stream(f"{job}/.{RECORD}", compression=None) as f:
            f.write(json.dumps([m.name for m in messages if m is not None]).encode())
        store.move(f"{job}/.{RECORD}", f"{job}/{RECORD}")  # from here on the job is committed
        finish(self.path, self.job)

    def abort(self, messages: list[Attempt | None]) -> None:
        store, root = open_store(self.path)
        _drop(store, f"{root}/{STAGING}/{self.job}")


def finish(path: str, job: str) -> None:
    """Carry out a recorded commit, from wherever it was left."""
    store, root = open_store(path.rstrip("/"))
    base = f"{root}/{STAGING}/{job}"
    store.create_dir(f"{root}/{COMMITS}/{job}", recursive=True)
    taken: dict[str, set[str]] = {}  # folders are listed once, not every file looked up

    def move(staged: str, final: str) -> None:
        if final in taken[final.rsplit("/", 1)[0]]:
            store.delete_file(final)
        store.move(staged, final)

    with ThreadPoolExecutor(MOVERS) as pool:
        for name in json.loads(_text(store, f"{base}/{RECORD}")):
            listing = f"{base}/{name}/{LISTING}"
            if _missing(store, listing):
                continue  # all of this attempt is in place
            left = _files(store, f"{base}/{name}", recursive=True)  # the others were moved before
            files = [json.loads(x)["file"] for x in _text(store, listing).splitlines()]
            files = [f for f in files if f"{base}/{name}/{f}" in left]
            for folder in {f"{root}/{f}".rsplit("/", 1)[0] for f in files} - taken.keys():
                store.create_dir(folder, recursive=True)
                taken[folder] = _files(store, folder)
            list(pool.map(lambda f: move(f"{base}/{name}/{f}", f"{root}/{f}"), files))  # noqa: B023
            store.move(listing, f"{root}/{COMMITS}/{job}/{name}.jsonl")
    _drop(store, base)


def recover(path: str, drop_unfinished: bool = False) -> list[str]:
    """Finish the recorded commits under ``path``; returns their jobs.  ``drop_unfinished``
    also removes staging folders without a record (no job may be writing then)."""
    store, root = open_store(path.rstrip("/"))
    done = []
    for info in store.get_file_info(pafs.FileSelector(f"{root}/{STAGING}", allow_not_found=True)):
        job = info.path.rsplit("/", 1)[-1]
        if not _missing(store, f"{info.path}/{RECORD}"):
            finish(path, job)
            done.append(job)
        elif drop_unfinished:
            _drop(store, info.path)
    return done


class FilesSource(DataSource):
    """``df.write.format("corpusmill_files").mode("append").option("path", folder).save()``"""

    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        return "file string, data binary"

    def writer(self, schema, overwrite):
        return FilesWriter(self.options)


def write_files(rows: DataFrame, path: str) -> DataFrame:
    """Write ``(file, data)`` rows under ``path``, all files or none; returns ``(file, rows,
    bytes)`` of the files written."""
    spark, job = rows.sparkSession, uuid.uuid4().hex
    spark.dataSource.register(FilesSource)
    rows.select("file", "data").write.format(FORMAT).mode("append").option("path", path).option("job", job).save()
    return committed_files(spark, path, job)


def committed_files(spark: SparkSession, path: str, job: str = "*") -> DataFrame:
    """``(file, rows, bytes)`` of the files that a job (default: any) has committed."""
    folder = f"{path.rstrip('/')}/{COMMITS}/{job}"
    return spark.read.schema("file string, rows bigint, bytes bigint").json(folder)

"""The commit protocol: whole or nothing, retries leave nothing, broken-off commits finish."""

import json
import os
import subprocess
import sys
import textwrap
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from corpusmill.sinks import committed as C

ROOT = Path(__file__).resolve().parent.parent


def files_under(base):
    return sorted(str(p.relative_to(base)) for p in Path(base).rglob("*") if p.is_file() and "_commits" not in p.parts)


def rows(spark, n=40, files=7):
    df = spark.range(n).select(F.format_string("k=%d/f.txt", F.col("id") % files).alias("file"), F.col("id").cast("string").alias("d"))
    return df.select("file", F.concat("d", F.lit("\n")).cast("binary").alias("data"), "d").repartition("file").sortWithinPartitions("file", F.col("d").cast("int"))


def test_files_and_report(spark, tmp_path):
    report = C.write_files(rows(spark), str(tmp_path))
    assert {r.file: (r.rows, r.bytes) for r in report.collect()} == {
        f"k={k}/f.txt": (len(range(k, 40, 7)), sum(len(str(x)) + 1 for x in range(k, 40, 7))) for k in range(7)
    }
    assert files_under(tmp_path) == [f"k={k}/f.txt" for k in range(7)]
    assert (tmp_path / "k=3/f.txt").read_text() == "".join(f"{x}\n" for x in range(3, 40, 7))
    C.write_files(rows(spark, 14), str(tmp_path))  # files that exist are replaced
    assert (tmp_path / "k=3/f.txt").read_text() == "3\n10\n"
    assert C.committed_files(spark, str(tmp_path)).count() == 14
    assert C.write_files(rows(spark).filter("false"), str(tmp_path / "none")).count() == 0
    assert files_under(tmp_path / "none") == []


def test_a_failing_job_leaves_the_folder_as_it_was(spark, tmp_path):
    C.write_files(rows(spark, 7), str(tmp_path))
    before = files_under(tmp_path)

    def fail(batches):
        for batch in batches:
            yield batch
        raise ValueError("after all rows were given on")

    bad = rows(spark).select("file", "data").mapInArrow(fail, "file string, data binary")
    with pytest.raises(Exception, match="after all rows"):
        C.write_files(bad, str(tmp_path))
    assert files_under(tmp_path) == before and (tmp_path / "k=3/f.txt").read_text() == "3\n"


def test_a_task_that_fails_after_writing_is_run_again(tmp_path):
    """With retries: the first attempt of every task writes all its rows, then fails."""
    script = f"""
        import os, sys
        sys.path.insert(0, {str(ROOT)!r})
        from pyspark import TaskContext
        from pyspark.sql import SparkSession, functions as F
        from corpusmill.sinks import committed as C
        spark = SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").getOrCreate()
        df = spark.range(40).select(F.format_string("f%d", F.col("id") % 5).alias("file"), F.lit(b"x").alias("data"))
        df = df.repartition(3, "file").sortWithinPartitions("file")
        def flaky(batches):
            yield from batches
            if TaskContext.get().attemptNumber() == 0:
                raise ValueError("first attempt")
        C.write_files(df.mapInArrow(flaky, "file string, data binary"), {str(tmp_path)!r})
        spark.stop()
    """
    done = subprocess.run([sys.executable, "-c", textwrap.dedent(script)], capture_output=True, text=True, timeout=300, env={**os.environ})
    assert done.returncode == 0, done.stderr[-2000:]
    assert "first attempt" in done.stderr
    assert files_under(tmp_path) == [f"f{k}" for k in range(5)]
    assert all((tmp_path / f"f{k}").read_bytes() == b"x" * 8 for k in range(5))


def test_a_commit_that_broke_off_is_finished(tmp_path):
    """One of two attempts is in the record, one of its files is in place already."""
    job = tmp_path / "_staging" / "j"
    for attempt in ("won", "lost"):
        (job / attempt / "d").mkdir(parents=True)
        (job / attempt / "_files.jsonl").write_text("".join(json.dumps({"file": f, "rows": 1, "bytes": 1}) + "\n" for f in ("d/a", "b", "c")))
        for f in ("d/a", "b"):
            (job / attempt / f).write_text(attempt)
    (tmp_path / "c").write_text("won")
    (tmp_path / "b").write_text("old")
    unfinished = tmp_path / "_staging" / "other"
    unfinished.mkdir()
    assert C.recover(str(tmp_path)) == []  # no record: not committed
    (job / "_record.json").write_text('["won"]')
    assert C.recover(str(tmp_path)) == ["j"]
    assert files_under(tmp_path) == ["b", "c", "d/a"]
    assert {(tmp_path / f).read_text() for f in ("b", "c", "d/a")} == {"won"}
    assert unfinished.exists() and C.recover(str(tmp_path), drop_unfinished=True) == [] and not unfinished.exists()

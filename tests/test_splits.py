"""Ranges of files against whole reads: gzip seek points, byte ranges, row groups, faults."""

import gzip
import json
import random
import zlib

import pytest
from pyspark.sql import types as T

from corpusmill.sources import files as S
from corpusmill.sources import gzindex as G
from corpusmill.sources import splits as P

WORDS = "lorem ipsum dolor sit amet öß consectetur elit sed".split()
RECORD = T.StructType([T.StructField("n", T.LongType()), T.StructField("text", T.StringType())])


def lines(count, seed=1):
    rng = random.Random(seed)
    out = []
    for n in range(count):
        text = " ".join(rng.choice(WORDS) + str(rng.randrange(999)) for _ in range(rng.randrange(40)))
        out.append("" if n % 50 == 7 else "{broken" if n % 60 == 9 else json.dumps({"n": n, "text": text}, ensure_ascii=False))
    return out


def points_of(data, every=1 << 15):
    read = lambda at, n: data[at : at + n]
    points = G.seek_points(read, len(data), every)
    return points, [b"".join(G.read_point(read, len(data), p)) for p in points]


RAW = "\n".join(lines(20_000)).encode()


@pytest.mark.parametrize("level", [1, 6, 9])
def test_points_inside_one_member(level):
    points, parts = points_of(gzip.compress(RAW, level))
    assert len(points) > 3 and sum(p.window is not None for p in points) > 2
    assert b"".join(parts) == RAW
    upto = 0
    for p, part in zip(points, parts):
        assert p.lines == upto and (part.endswith(b"\n") or p is points[-1])
        upto += G.count_lines(part)


@pytest.mark.parametrize("size", [997, 60_000, 1_500_000])
def test_points_of_many_members(size):
    data = b"".join(gzip.compress(RAW[k : k + size]) for k in range(0, len(RAW), size)) + b"\0" * 30
    points, parts = points_of(data)
    assert len(points) > 3 and b"".join(parts) == RAW and points[-1].error is None


@pytest.mark.parametrize(
    "raw",
    [b"", b"x", b"\n\n", b"a" * 3_000_000 + b"\nb\n" + RAW[:900_000], b"no break " * 400_000, random.Random(2).randbytes(900_000)],
)
def test_points_of_odd_contents(raw):
    points, parts = points_of(gzip.compress(raw))
    assert b"".join(parts) == raw and points[-1].error is None


def test_points_of_broken_files():
    data = gzip.compress(RAW)
    points, parts = points_of(data[: len(data) // 2])
    assert points[-1].error == "EOFError" and all(p.error is None for p in points[:-1])
    assert b"".join(parts) == zlib.decompressobj(31).decompress(data[: len(data) // 2])
    assert points_of(b"plain text")[0][-1].error == "BadGzipFile"
    assert points_of(gzip.compress(b"a\n") + b"rubbish")[0][-1].error == "BadGzipFile"


def test_a_false_block_start_is_no_point():
    assert len(G.block_starts(b"\0" * 100)) == 0 and len(G.block_starts(b"")) == 0
    assert G.shifted(bytes([0b10110100, 0b1]), 3) == bytes([0b00110110, 0])


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    base = tmp_path_factory.mktemp("splits")
    data = gzip.compress(RAW)
    (base / "big.jsonl.gz").write_bytes(data)
    (base / "members.gz").write_bytes(b"".join(gzip.compress(RAW[k : k + 70_000]) for k in range(0, len(RAW), 70_000)))
    (base / "plain.jsonl").write_bytes(RAW)
    (base / "small.gz").write_bytes(gzip.compress(b"\n".join(RAW.split(b"\n")[:300])))
    (base / "empty.jsonl").write_bytes(b"")
    (base / "_hidden.jsonl").write_bytes(b"{}")
    cut = tmp_path_factory.mktemp("cut")
    (cut / "half.gz").write_bytes(data[: len(data) // 2])
    (cut / "good.jsonl").write_bytes(RAW)
    return base, cut


def test_one_file_many_tasks_same_lines(spark, folder):
    base, _ = folder
    want = [x for x in RAW.decode().split("\n") if x]
    for split_bytes in (40_000, 1 << 30):
        got = S.read_json_lines_numbered(spark, f"{base}/*", RECORD, split_bytes).collect()
        by_file = {}
        for r in got:
            by_file.setdefault(r.file_path.rsplit("/", 1)[-1], []).append((r.line_no, r.line, r.bad))
        assert set(by_file) == {"big.jsonl.gz", "members.gz", "plain.jsonl", "small.gz"}
        for name, rows in by_file.items():
            mine = want if name != "small.gz" else want[: len(rows)]
            assert sorted(rows) == [(k, x, x == "{broken") for k, x in enumerate(mine)], name
    plan = P.plan_splits(P.expand_paths(P.paths_table(spark, f"{base}/*")), 40_000)
    ranges = {r.file.rsplit("/", 1)[-1]: r["count"] for r in plan.groupBy("file").count().collect()}
    assert ranges["big.jsonl.gz"] > 2 and ranges["plain.jsonl"] > 50 and ranges["small.gz"] == 1


@pytest.mark.parametrize("split_bytes", [40_000, 1 << 30])
def test_faults_of_ranges_equal_the_whole_read(spark, folder, monkeypatch, split_bytes):
    base, cut = folder
    monkeypatch.setattr(S, "plan_splits", lambda files: P.plan_splits(files, split_bytes))
    faults = {r.file_path.rsplit("/", 1)[-1]: tuple(r)[1:] for r in S.file_faults(spark, [f"{base}/*", f"{cut}/*"], RECORD).collect()}
    bad = sum(x == "{broken" for x in lines(20_000))
    good = sum(x.startswith('{"') for x in lines(20_000))
    whole = (good, bad, None)
    assert faults["big.jsonl.gz"] == faults["members.gz"] == faults["plain.jsonl"] == faults["good.jsonl"] == whole
    assert faults["empty.jsonl"] == (0, 0, None) and faults["half.gz"] == (None, None, "EOFError")
    plan = P.plan_splits(P.expand_paths(P.paths_table(spark, f"{cut}/half.gz")), split_bytes)
    with pytest.raises(Exception, match="EOFError"):
        P.read_splits(plan).collect()
    kept = P.read_splits(plan, keep_faults=True).filter("line is not null").count()
    part = zlib.decompressobj(31).decompress(gzip.compress(RAW)[: (cut / "half.gz").stat().st_size])
    assert kept == G.count_lines(part)


def test_manifest_to_records_in_one_branch(spark, folder, tmp_path):
    base, _ = folder
    df = spark.createDataFrame([(k, f"row {k}") for k in range(500)], "n long, content string")
    df.coalesce(1).write.option("parquet.block.size", 4096).parquet(str(tmp_path / "p"))
    entries = [("a", f"{base}/big.jsonl.gz"), ("b", f"{tmp_path}/p/*.parquet"), ("b", f"{base}/members.*"), ("c", f"{base}/empty.jsonl")]
    table = spark.createDataFrame(entries, "source string, pattern string")
    got = S.read_manifest(table, RECORD, split_bytes=40_000)
    assert got.columns == ["source", "pattern", "n", "text", "file_path"]
    rows = {}
    for r in got.collect():
        rows.setdefault((r.source, r.pattern), set()).add((r.n, r.text))
    good = {(r["n"], r["text"]) for r in (json.loads(x) for x in lines(20_000) if x.startswith('{"'))}
    assert rows == {entries[0]: good, entries[2]: good, entries[1]: {(k, f"row {k}") for k in range(500)}}
    missing = spark.createDataFrame([("d", f"{base}/nothing*")], "source string, pattern string")
    with pytest.raises(Exception, match="FileNotFoundError"):
        S.read_manifest(missing, RECORD).collect()
    assert [r.file for r in S.expand_or_keep(missing).collect()] == [f"{base}/nothing*"]


def test_many_paths_are_rows_of_one_plan(spark, tmp_path):
    for k in range(40):
        (tmp_path / f"f{k}.jsonl").write_text('{"n": 1}\n' * k)
    patterns = spark.range(20_000).selectExpr(f"concat('{tmp_path}/f', id, '.jsonl') as pattern", "id")
    plan = P.plan_splits(P.expand_paths(patterns))
    assert plan.count() == 20_000 and plan.filter("error is null").count() == 40
    assert P.read_splits(plan.filter("error is null")).groupBy("id").count().agg({"count": "sum"}).first()[0] == sum(range(40))

"""What may not grow faster than the input: tasks per small file, texts in shuffles that need
keys only, rows of one task, passes over a source."""

import zipfile

from pyspark.sql import functions as F

from corpusmill.plans.recipes import prepare_corpus


def test_layout_without_texts_is_the_same(spark):
    rows = [(k, None if k % 11 == 0 else f"s{k % 2}", None if k % 7 == 0 else f"text of {k % 40} \r\n\n\n x") for k in range(120)]
    rows += [(200, "s0", "short")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    keys = ["doc_id", "source", "sample_id", "shard_pos", "shard", "text_sha1", "record_index"]
    whole = prepare_corpus(docs, "source", "doc_id", max_records=5)
    light = prepare_corpus(docs, "source", "doc_id", max_records=5, keep_text=False)
    assert "text" not in light.columns
    assert sorted(map(str, light.select(*keys).collect())) == sorted(map(str, whole.select(*keys).collect()))
    # the text is gone before the first exchange: no other operator reads it
    plan = light.select(*keys)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window" in line or "Aggregate" in line]
    assert windows and not any("text#" in line for line in windows)


def _small_files(base, n=400):
    for k in range(n):
        (base / f"s={k % 3}").mkdir(exist_ok=True)
        (base / f"s={k % 3}" / f"part-{k:05d}.jsonl").write_text(f'{{"a": "{k}"}}\n\nbroken\n{{"a": "x"}}\n')


def test_small_files_share_tasks_and_are_read_once(spark, tmp_path, monkeypatch):
    from pyspark.sql.types import StringType, StructField, StructType

    from corpusmill.sources import files as S
    from corpusmill.sources import splits as P

    _small_files(tmp_path)
    schema = StructType([StructField("a", StringType())])
    lines = S.read_json_lines_numbered(spark, f"{tmp_path}/*/*", schema)
    assert lines.rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism
    got = sorted((r.file_path[-10:-6], r.line_no, r.bad, r.rec.a) for r in lines.collect())
    assert got[:3] == [("0000", 0, False, "0"), ("0000", 1, True, None), ("0000", 2, False, "x")] and len(got) == 1200
    # a file of several ranges is counted up to its last one
    (tmp_path / "long.jsonl").write_text("".join(f'{{"a": "{k}"}}\n' for k in range(500)))
    plan = P.plan_splits(P.expand_paths(P.paths_table(spark, str(tmp_path / "long.jsonl"))), 1000)
    assert plan.count() > 4
    numbered = P.read_splits(P.number_lines(plan).drop("pattern"))
    assert all(r.line == f'{{"a": "{r.line_no}"}}' for r in numbered.collect())


def test_folders_are_listed_not_globbed(spark, tmp_path):
    from corpusmill.sinks import writers as K

    _small_files(tmp_path, 40)
    (tmp_path / "s=0" / "other.txt").write_text("")
    paths = []
    listed = K.list_shard_files(spark, str(tmp_path))
    paths = [(r.name_rank, r.path.rsplit("/", 2)[-2:]) for r in listed.orderBy("name_rank").collect()]
    assert paths == list(enumerate(sorted([f"s={k % 3}", f"part-{k:05d}.jsonl"] for k in range(40))))
    roots = spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(
        listed._jdf.queryExecution().optimizedPlan().collectLeaves()
    )
    found = [n.relation().location().rootPaths().size() for n in roots if "LogicalRelation" in n.getClass().getName()]
    assert found and max(found) == 3  # the scopes' folders, not 40 files


def test_archives_are_strung_together_from_members_compressed_elsewhere(spark, tmp_path):
    from corpusmill.plans.q_files import write_zip_archives
    from corpusmill.sources import archives as Z

    rows = [(f"a{k % 90:02d}", f"d/{k:04d}.txt", None if k % 50 == 0 else f"line {k}\n\nüñ {k}") for k in range(900)] + [("a00", "d/", "")]
    df = spark.createDataFrame(rows, "a string, m string, c string").repartition(6)
    assert write_zip_archives(df, str(tmp_path), "a", "m", "c") == 90
    want = {}
    for a, m, c in rows:
        want.setdefault(a, {})[m] = c or ""
    for a, members in want.items():
        with zipfile.ZipFile(tmp_path / f"{a}.zip") as z:
            assert z.testzip() is None and z.namelist() == sorted(members)
            assert {m: z.read(m).decode() for m in z.namelist()} == members
    (tmp_path / "bad").write_text("")
    read = Z.read_zip_members(spark, f"{tmp_path}/*.zip")
    assert read.rdd.getNumPartitions() <= Z.LEAST_TASKS + 1  # 90 archives share them
    got = sorted((r.archive[-7:-4], r.member, r.content) for r in read.collect())
    assert got == sorted((a, m, None if m.endswith("/") else c or "") for a, m, c in rows)
    lines = {(r.archive[-7:-4], r.member, r.line_no): r.line for r in Z.read_zip_lines(spark, f"{tmp_path}/*.zip").collect()}
    assert lines[("a01", "d/0001.txt", 3)] == "üñ 1" and len(lines) == 3 * 882


def test_paragraphs_over_blocks(spark, monkeypatch):
    """Blocks of three lines: paragraphs that begin, end and go through them; null lines."""
    import random

    from corpusmill.sources import documents as SD

    monkeypatch.setattr(SD, "LINES_AT_ONCE", 3)
    rng = random.Random(4)
    rows, want = [], []
    for key in [None, "a", "b", *(f"k{j}" for j in range(20))]:
        run, n = [], 0
        for no in range(1, 40):
            line = rng.choice(["x", "yy ", " z", "w", "", " 　", None])
            rows.append((key, no, line))
            if line is not None and line.strip():
                run.append((no, line))
            elif line is not None and run:
                want.append((str(key), n, run[0][0], "\n".join(x for _, x in run)))
                run, n = [], n + 1
        if run:
            want.append((str(key), n, run[0][0], "\n".join(x for _, x in run)))
    df = spark.createDataFrame(rows, "k string, no long, line string").repartition(5)
    got = SD.paragraphs_from_lines(df, ["k"], "no", "line").collect()
    assert sorted((str(r.k), r.para_no, r.first_line, r.text) for r in got) == sorted(want)


def test_a_shard_of_many_files_ends_at_its_first_bad_line(spark):
    from corpusmill.sources import files as S

    rows = [(s, f"{s}/f{f}", n, (s, f, n) in {("a", 1, 2), ("a", 2, 0), ("b", 0, 0)}) for s in "abc" for f in range(3) for n in range(4)]
    df = spark.createDataFrame(rows, "shard string, file string, n long, bad boolean")
    kept = S.truncate_after_first_bad(df, "shard", ["file", "n"], "bad")
    want = [r[:3] for r in rows if r[0] == "c" or (r[0] == "a" and (r[1], r[2]) < ("a/f1", 2))]
    assert sorted(tuple(r)[:3] for r in kept.select("shard", "file", "n").collect()) == sorted(want)


def test_inbox_grows_by_files(spark, tmp_path):
    """Nothing decides the number of files but the size of the rows."""
    from corpusmill.plans.q_stream import _inbox

    keep = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        _inbox(spark.range(2000), str(tmp_path / "in"), "id")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", keep)
    files = list((tmp_path / "in").glob("part-*"))
    assert len(files) > 4 and sum(len(f.read_text().splitlines()) for f in files) == 2000


def test_tokeniser_gets_few_texts_at_a_time(spark):
    from corpusmill.operators import scoring as Sc

    def model():
        def fn(texts):
            assert len(texts) <= Sc.TEXTS_AT_ONCE
            return [list(range(1, len(t) + 1)) for t in texts]

        return fn

    df = spark.range(2000).select(F.when(F.col("id") % 3 > 0, F.repeat(F.lit("x"), (F.col("id") % 9).cast("int"))).alias("t")).coalesce(1)
    for r in Sc.tokenize(df, model, "t", 5).collect():
        n = min(5, len(r.t or ""))
        assert r.input_ids == [*range(1, n + 1), *[0] * (5 - n)] and r.attention_mask == [1] * n + [0] * (5 - n)


def test_pad_asks_for_its_state_once(spark):
    """A key's turns cost one read and one write of its state, whatever their number."""
    import pandas as pd

    from corpusmill.streaming.incremental import ScratchpadProcessor

    calls = []

    class State:
        value, rows = None, None

        def get(self):
            calls.append("get")
            return self.value

        def update(self, value):
            calls.append("update")
            self.value = value

        def containsKey(self, key):
            calls.append("early")
            return key in self.rows

        def getValue(self, key):
            return self.rows[key]

        def updateValue(self, key, value):
            self.rows[key] = value

        def removeKey(self, key):
            del self.rows[key]

    p = ScratchpadProcessor(keep=2)
    p.state, p.early = State(), State()
    p.early.rows = {}
    turn = lambda *t: [x for f in p.handleInputRows((1,), iter([pd.DataFrame({"turn": t, "note": [f"n{k}" for k in t]})]), None) for x in f["pad"]]
    assert turn(0, 1, 2) == ["n0", "n0\nn1", "n1\nn2"] and calls == ["get", "update"]
    assert turn(5, 4) == [] and turn(3) == ["n2\nn3", "n3\nn4", "n4\nn5"]
    assert p.state.value == (6, ["n4", "n5"], 0) and not p.early.rows

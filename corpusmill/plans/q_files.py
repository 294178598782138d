"""Queries that write data derived from the tables to the shared scratch folder and read
it back through the sources and sinks (scans, archives, XML, JSON arrays, wiki dumps,
shard layout, no-clobber, routed artifacts, logs, snapshots, manifest lines).

Fixture files are written by Spark jobs (writers run in tasks); the folder comes from
``spark.checkpoint.dir``.  Where the read-back must equal a table-derived result, the
oracle SQL states that result.
"""

from __future__ import annotations

import gzip
import math
import zipfile
import zlib
from collections.abc import Iterator
from contextlib import ExitStack

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from corpusmill.functions import ids as I
from corpusmill.functions import text as T
from corpusmill.operators import artifacts as A
from corpusmill.operators import manifest as M
from corpusmill.plans import duck as D
from corpusmill.plans.catalog import register, table
from corpusmill.plans.q_artifacts import _PENDING_SQL, _scorable, artifact_table
from corpusmill.plans.q_manifest import _ENTRIES_SQL, manifest_entries
from corpusmill.plans.q_records import PARAGRAPHS_SQL, paragraph_raw
from corpusmill.plans.q_text import _PREP_SQL, SUMMARY_SHARD_SIZE, prepared_documents
from corpusmill.session import scratch_dir
from corpusmill.sinks import writers as K
from corpusmill.sources import documents as SD
from corpusmill.sources import files as S
from corpusmill.sources.archives import read_zip_lines
from corpusmill.sources.stores import open_store

_N = "CAST(substring(source, 4) AS INT)"
ROWS_PER_FILE = 500


def _norm_uri(col):
    return F.regexp_replace(col, r"^file:/+", "/")


def write_zip_archives(df: DataFrame, base: str, archive_col: str, member_col: str, content_col: str) -> int:
    """One zip per archive key in the shared store; returns how many.

    Members are compressed where their rows are; the task that holds an archive only strings
    its compressed members together, one archive after the other."""

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            crc, size, data = [], [], []
            for content in batch.column(2).to_pylist():
                raw = (content or "").encode()
                deflate = zlib.compressobj(zlib.Z_DEFAULT_COMPRESSION, zlib.DEFLATED, -15)
                crc.append(zlib.crc32(raw))
                size.append(len(raw))
                data.append(deflate.compress(raw) + deflate.flush())
            columns = [pa.array(crc, pa.int64()), pa.array(size, pa.int64()), pa.array(data, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=["archive", "member", "crc", "size", "data"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_store(base)
        store.create_dir(root, recursive=True)
        now, done = None, []
        with ExitStack() as files:
            for batch in batches:
                for a, m, crc, size, data in zip(*(c.to_pylist() for c in batch.columns)):
                    if a != now:
                        files.close()
                        out = files.enter_context(store.open_output_stream(f"{root}/{a}.zip", compression=None))
                        archive, now = files.enter_context(zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED)), a
                        done.append(a)
                    add_compressed(archive, m, crc, size, data)
        yield pa.RecordBatch.from_arrays([pa.array(done, pa.string())], names=["archive"])

    rows = df.select(F.col(archive_col).alias("archive"), F.col(member_col).alias("member"), F.col(content_col).alias("content"))
    packed = rows.mapInArrow(compress, "archive string, member string, crc bigint, size bigint, data binary")
    return packed.repartition("archive").sortWithinPartitions("archive", "member").mapInArrow(write, "archive string").count()


def add_compressed(archive: zipfile.ZipFile, name: str, crc: int, size: int, data: bytes) -> None:
    """Add a member whose raw deflate stream is ready to an archive opened for writing."""
    info = zipfile.ZipInfo(name)
    info.compress_type, info.CRC, info.file_size, info.compress_size = zipfile.ZIP_DEFLATED, crc, size, len(data)
    info.header_offset = archive.fp.tell()
    archive.fp.write(info.FileHeader())
    archive.fp.write(data)
    archive.start_dir = archive.fp.tell()
    archive.filelist.append(info)
    archive.NameToInfo[name] = info
    archive._didModify = True


_DOC_RECORD = Ty.StructType([Ty.StructField("doc_id", Ty.LongType()), Ty.StructField("text", Ty.StringType())])

# ------------------------------------------------------------------ scans


@register(
    "manifest_scan",
    "SELECT doc_id, sha1(text) AS text_sha1, source FROM documents",
)
def q_manifest_scan(spark, sf):
    base = scratch_dir(spark, "manifest_scan")
    docs = table(spark, sf, "documents").select("doc_id", "text", "source").withColumn("n", F.expr(_N))
    docs.filter("n % 3 = 0").drop("n").write.partitionBy("source").json(f"{base}/jsonl")
    docs.filter("n % 3 = 1").drop("n").write.option("compression", "gzip").partitionBy("source").json(f"{base}/gz")
    docs.filter("n % 3 = 2").drop("n").write.partitionBy("source").parquet(f"{base}/parquet")
    # manifest: one entry per source
    fmt = F.when(F.col("n") % 3 == 0, "jsonl").when(F.col("n") % 3 == 1, "gz").otherwise("parquet")
    entries = docs.select("source", "n").distinct().select(
        "source", F.concat(F.lit(f"{base}/"), fmt, F.lit("/source="), F.col("source"), F.lit("/part-*")).alias("pattern")
    )
    out = S.read_manifest(entries, _DOC_RECORD)
    return out.select("doc_id", I.sha1_hex("text").alias("text_sha1"), "source")


def _bad_shards(spark, sf):
    """JSON Lines in six folders: four intact ones with some broken lines (two of them
    compressed), one with texts that are not strings, one compressed file cut in half."""
    base = scratch_dir(spark, "bad_shards")
    docs = table(spark, sf, "documents").select("doc_id", "text")
    good = docs.select(F.to_json(F.struct("doc_id", "text")).alias("value"), "doc_id")
    bad = docs.filter(F.col("doc_id") % 50 == 0).select(
        F.concat(F.lit('{"doc_id": '), F.col("doc_id").cast("string"), F.lit(", broken")).alias("value"), "doc_id"
    )
    lines = good.unionByName(bad).withColumn("part", F.pmod(F.col("doc_id"), F.lit(4)).cast("string"))
    odd = docs.filter(F.col("doc_id") % 10 == 0).select(
        F.format_string('{"doc_id": %d, "text": %s}', F.col("doc_id"), F.element_at(F.array(F.lit("5"), F.lit('["a"]'), F.lit("null")), (F.col("doc_id") % 3 + 1).cast("int"))).alias("value"),
        "doc_id",
        F.lit("odd").alias("part"),
    )
    plain = lines.filter("part in ('0', '1')").unionByName(odd)
    plain.select("value", "part").write.partitionBy("part").text(f"{base}/plain")
    lines.filter("part in ('2', '3')").select("value", "part").write.option("compression", "gzip").partitionBy("part").text(f"{base}/gz")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = open_store(base)
        for pdf in batches:
            whole = gzip.compress("\n".join(pdf["value"]).encode())
            store.create_dir(f"{root}/cut/part=cut", recursive=True)
            with store.open_output_stream(f"{root}/cut/part=cut/half.json.gz", compression=None) as f:
                f.write(whole[: len(whole) // 2])
            yield pd.DataFrame({"n": [len(pdf)]})

    one = good.filter(F.col("doc_id") % 100 == 0).orderBy("doc_id").limit(200).coalesce(1)  # the broken file's content
    one.select("value").mapInPandas(cut, "n long").count()
    return base


@register("bad_shard_scan", "SELECT doc_id, sha1(text) AS text_sha1 FROM documents WHERE text IS NOT NULL AND text <> ''")
def q_bad_shard_scan(spark, sf):
    base = _bad_shards(spark, sf)
    recs = S.read_jsonl(spark, [f"{base}/plain/*/*", f"{base}/gz/*/*"], _DOC_RECORD)
    return recs.filter(T.is_valid_text("text")).select("doc_id", I.sha1_hex("text").alias("text_sha1"))


@register(
    "file_faults",
    """SELECT CAST(doc_id % 4 AS VARCHAR) AS part, count(*) AS rows, count(*) FILTER (doc_id % 50 = 0) AS bad_lines,
              false AS cut FROM documents GROUP BY ALL
       UNION ALL SELECT 'odd', count(*), 0, false FROM documents WHERE doc_id % 10 = 0
       UNION ALL SELECT 'cut', NULL, NULL, true""",
)
def q_file_faults(spark, sf):
    """The fault report of the shards above: rows, bad lines, and which file is cut short."""
    base = _bad_shards(spark, sf)
    faults = S.file_faults(spark, [f"{base}/plain/*/*", f"{base}/gz/*/*", f"{base}/cut/*/*"], _DOC_RECORD)
    part = F.regexp_extract("file_path", r"part=([^/]+)/", 1)
    return faults.groupBy(part.alias("part")).agg(
        F.sum("rows").alias("rows"), F.sum("bad_lines").alias("bad_lines"), F.bool_or(F.col("error").isNotNull()).alias("cut")
    )


@register(
    "truncated_shards",
    """WITH b AS (SELECT doc_id % 4 AS part, min(doc_id) FILTER (doc_id % 50 = 0) AS first_bad FROM documents GROUP BY 1)
       SELECT doc_id FROM documents d JOIN b ON d.doc_id % 4 = b.part WHERE first_bad IS NULL OR doc_id < first_bad""",
)
def q_truncated_shards(spark, sf):
    """The strict rule: a shard ends at its first bad line (line order = doc_id).  A shard is a
    folder of files in name order, so that no task writes or reads a whole one."""
    base = scratch_dir(spark, "truncated")
    docs = table(spark, sf, "documents").select("doc_id", "text")
    good = F.to_json(F.struct("doc_id", "text"))
    broken = F.concat(F.lit('{"doc_id": '), F.col("doc_id").cast("string"), F.lit(", broken"))
    line = F.when(F.col("doc_id") % 50 == 0, broken).otherwise(good)
    lines = docs.select(line.alias("value"), "doc_id", F.pmod("doc_id", F.lit(4)).alias("part"))
    ordered = lines.repartitionByRange("part", "doc_id").sortWithinPartitions("part", "doc_id")
    ordered.select("value", "part").write.partitionBy("part").text(base)
    numbered = S.read_json_lines_numbered(spark, f"{base}/*/*", _DOC_RECORD)
    numbered = numbered.withColumn("shard", F.regexp_extract("file_path", r"^(.*)/[^/]*$", 1))
    kept = S.truncate_after_first_bad(numbered, "shard", ["file_path", "line_no"], "bad")
    return kept.select(F.col("rec.doc_id").alias("doc_id"))


@register("zip_text", PARAGRAPHS_SQL)
def q_zip_text(spark, sf):
    base = scratch_dir(spark, "zip_text")
    docs = table(spark, sf, "documents").select("doc_id", paragraph_raw(F.col("text")).alias("content"))
    members = docs.select(
        F.concat(F.lit("wiki_"), F.pmod("doc_id", F.lit(4)).cast("string")).alias("archive"),
        F.concat(F.lit("wiki/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("member"),
        "content",
    )
    dirs = members.select("archive").distinct().select("archive", F.lit("wiki/").alias("member"), F.lit("").alias("content"))
    write_zip_archives(members.unionByName(dirs), base, "archive", "member", "content")
    lines = read_zip_lines(spark, f"{base}/*.zip")
    paras = SD.paragraphs_from_lines(lines, ["archive", "member"], "line_no", "line")
    return paras.select(
        F.regexp_extract("member", r"(\d+)\.txt$", 1).cast("bigint").alias("doc_id"),
        F.col("para_no").cast("bigint").alias("para_no"),
        I.sha1_hex("text").alias("para_sha1"),
        F.length("text").cast("bigint").alias("n_chars"),
    )


_ZIP_CODE_SQL = f"""
WITH s AS (
  SELECT doc_id, text, 'jsonl_' || CAST(doc_id // 200 AS VARCHAR) AS archive, 'data/part.jsonl' AS member, true AS from_jsonl
  FROM documents WHERE doc_id % 4 = 0
  UNION ALL
  SELECT doc_id, text, 'src_' || CAST(doc_id % 3 AS VARCHAR),
         'src/' || CAST(doc_id AS VARCHAR) || (['.py', '.txt', '.JAVA', '.go'])[doc_id % 4 + 1], false
  FROM documents WHERE doc_id % 4 IN (2, 3)),
r AS (SELECT *, row_number() OVER (ORDER BY archive || '.zip', CASE WHEN from_jsonl THEN '' ELSE member END, doc_id) AS record_index FROM s),
n AS (SELECT archive, member, from_jsonl, record_index, {D.normalize('text', 5, collapse=False)} AS t FROM r)
SELECT archive, member, from_jsonl, record_index, sha1(t) AS text_sha1 FROM n WHERE t IS NOT NULL
"""


@register("zip_code", _ZIP_CODE_SQL)
def q_zip_code(spark, sf):
    base = scratch_dir(spark, "zip_code")
    docs = table(spark, sf, "documents").select("doc_id", "text")
    exts = F.array(F.lit(".py"), F.lit(".txt"), F.lit(".JAVA"), F.lit(".go"))
    jsonl_docs = docs.filter(F.col("doc_id") % 4 == 0)
    # one JSONL member per archive block (bounded group of rows)
    field = F.when(F.col("doc_id") % 3 == 0, F.to_json(F.struct(F.col("text").alias("func_code")))).otherwise(
        F.to_json(F.struct(F.lit("").alias("code"), F.col("text").alias("original_string")))
    )
    blocks = jsonl_docs.select(F.floor(F.col("doc_id") / 200).alias("blk"), "doc_id", field.alias("line"))
    jsonl_members = blocks.groupBy("blk").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("doc_id", "line"))), lambda s: s["line"]), "\n").alias("content")
    ).select(F.concat(F.lit("jsonl_"), F.col("blk").cast("string")).alias("archive"), F.lit("data/part.jsonl").alias("member"), "content")
    src = docs.filter(F.col("doc_id") % 4 != 0).select(
        F.concat(F.lit("src_"), F.pmod("doc_id", F.lit(3)).cast("string")).alias("archive"),
        F.concat(F.lit("src/"), F.col("doc_id").cast("string"), F.element_at(exts, (F.pmod("doc_id", F.lit(4)) + 1).cast("int"))).alias("member"),
        F.col("text").alias("content"),
    )
    write_zip_archives(jsonl_members.unionByName(src), base, "archive", "member", "content")
    recs = SD.code_records(spark, f"{base}/*.zip")
    cleaned = T.with_normalized(recs, "text", "text", T.CODE_MIN_LENGTH, collapse_whitespace=False)
    name = F.regexp_extract("archive", r"([^/]+)\.zip$", 1)
    return cleaned.select(
        name.alias("archive"), "member", "from_jsonl", "record_index", I.text_hash("text").alias("text_sha1")
    )


_PROBLEMS_SQL = f"""
WITH q AS (SELECT conv_id, turn, text FROM conversations WHERE role = 'user'),
b AS (SELECT conv_id, turn, text FROM conversations),
j AS (SELECT q.conv_id, q.turn, coalesce(b.text, '') || chr(10) || chr(10) || 'Q: ' || q.text || chr(10) || 'A:' AS raw
      FROM q LEFT JOIN b ON b.conv_id = q.conv_id AND b.turn = q.turn - 1),
n AS (SELECT conv_id, turn, {D.normalize('raw', 5)} AS t FROM j)
SELECT conv_id, turn, t AS text FROM n WHERE t IS NOT NULL
"""


def _problem_rows(spark, sf):
    conv = table(spark, sf, "conversations")
    q = conv.filter(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("Question"))
    b = conv.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("Body"))
    a = conv.filter(F.col("role") == "assistant").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("Answer"))
    return q.join(b, ["conv_id", "turn"], "left").join(a, ["conv_id", "turn"], "left").select(
        F.col("conv_id").alias("ConvId"), F.col("turn").alias("Turn"), "Body", "Question", "Answer"
    )


def _problems_out(df):
    raw = df.select(
        F.col("ConvId").cast("bigint").alias("conv_id"),
        F.col("Turn").cast("bigint").alias("turn"),
        T.problem_text("body", "question").alias("raw"),
    )
    return T.with_normalized(raw, "raw", "text", T.CODE_MIN_LENGTH).drop("raw")


@register("xml_problems", _PROBLEMS_SQL)
def q_xml_problems(spark, sf):
    base = scratch_dir(spark, "xml_problems")
    # element names in several cases
    rows = _problem_rows(spark, sf)
    for k, tag in enumerate(("Problem", "pRoblem", "ITEM")):
        part = rows.filter(F.pmod("ConvId", F.lit(3)) == k)
        part.write.format("xml").option("rootTag", "Set").option("rowTag", tag).save(f"{base}/{tag}")
    df = SD.read_problem_xml(spark, f"{base}/*/*", keep=("ConvId", "Turn"))
    return _problems_out(df)


@register("json_array", _PROBLEMS_SQL)
def q_json_array(spark, sf):
    base = scratch_dir(spark, "json_array")
    rows = _problem_rows(spark, sf)
    n = rows.count()
    files = max(1, math.ceil(n / ROWS_PER_FILE))
    grouped = rows.withColumn("file_id", F.pmod(F.xxhash64("ConvId", "Turn"), F.lit(files))).groupBy("file_id").agg(
        F.to_json(F.collect_list(F.struct("ConvId", "Turn", "Body", "Question", "Answer"))).alias("value")
    )
    grouped.write.partitionBy("file_id").text(base)
    return _problems_out(SD.read_problem_json_array(spark, f"{base}/*/*", keep=("ConvId", "Turn")))


@register(
    "wiki_pages",
    """WITH p AS (SELECT doc_id, 'Heading' || chr(10) || source || ' ' || text || ' shown text'
                 || CASE WHEN doc_id % 2 = 1 THEN '  ' || chr(10) || 'before  between deep link after {{open' ELSE '' END AS t
                 FROM documents WHERE doc_id % 10 <> 0 AND doc_id % 13 <> 0)
       SELECT doc_id AS page_id, 'Doc ' || CAST(doc_id AS VARCHAR) AS title, sha1(t) AS text_sha1, CAST(length(t) AS BIGINT) AS n_chars FROM p""",
)
def q_wiki_pages(spark, sf):
    base = scratch_dir(spark, "wiki")
    docs = table(spark, sf, "documents")
    markup = F.concat(
        F.lit("== Heading =="),
        F.lit("\n'''"),
        F.col("source"),
        F.lit("''' "),
        F.col("text"),
        F.lit(" [[Target page|shown text]] {{cite web}} <ref>a note</ref>"),
        # nested three deep, a picture with a caption, and a mark that is never closed
        F.when(
            F.col("doc_id") % 2 == 1,
            F.lit(
                "\nbefore {{box|{{cell|{{unit|m}}|x}}|y}} between {| a {| b {| c |} |} d |}"
                "[[File:p.jpg|thumb|a [[b|c]] {{d}}]][[One|[[Two|[[Three|deep link]]]]]] after {{open"
            ),
        ).otherwise(""),
    )
    pages = docs.select(
        F.col("doc_id").alias("id"),
        F.when(F.col("doc_id") % 10 == 0, F.lit(1)).otherwise(F.lit(0)).alias("ns"),
        F.concat(F.lit("Doc "), F.col("doc_id").cast("string")).alias("title"),
        F.when(F.col("doc_id") % 13 == 0, F.struct(F.lit("Elsewhere").alias("_title"))).alias("redirect"),
        F.struct(markup.alias("text")).alias("revision"),
    )
    pages.write.format("xml").option("rootTag", "mediawiki").option("rowTag", "page").option("compression", "bzip2").save(base)
    arts = SD.read_wiki_dump(spark, base)
    return arts.select("page_id", "title", I.sha1_hex("text").alias("text_sha1"), F.length("text").cast("bigint").alias("n_chars"))


# ------------------------------------------------------------------ sinks


@register(
    "shard_write_roundtrip",
    _PREP_SQL
    + f"""SELECT source, printf('part-%05d.jsonl', pos // {SUMMARY_SHARD_SIZE}) AS shard_file,
       CAST(pos % {SUMMARY_SHARD_SIZE} AS BIGINT) AS line_no, {D.sample_id('source', 'ri', 't')} AS sample_id,
       'lm' AS type, sha1(t) AS text_sha1 FROM s""",
)
def q_shard_write_roundtrip(spark, sf):
    """Ids, order and texts of every shard file, and that readiness finds the files."""
    base = scratch_dir(spark, "shards")
    prepared = prepared_documents(spark, sf).withColumn("type", F.lit("lm"))
    written = K.write_shards(prepared, base, ["source"], "shard", "shard_pos")
    schema = Ty.StructType([Ty.StructField(c, Ty.StringType()) for c in ("sample_id", "type", "text")])
    back = S.read_json_lines_numbered(spark, f"{base}/source=*/part-*.jsonl", schema)
    out = back.select(
        F.regexp_extract("file_path", r"source=([^/]+)/", 1).alias("source"),
        F.regexp_extract("file_path", r"([^/]+)$", 1).alias("shard_file"),
        "line_no",
        "rec.sample_id",
        "rec.type",
        I.sha1_hex("rec.text").alias("text_sha1"),
    )
    # a job per source that wrote shards, from the writer's report (not from a second preparation)
    folder = F.regexp_extract("path", r"source=([^/]+)/[^/]*$", 1)
    job = F.when(folder != "__HIVE_DEFAULT_PARTITION__", F.url_decode(folder))
    configs = written.select(job.alias("job")).distinct().withColumn("out", F.concat(F.lit(f"{base}/source="), "job"))
    listing = S.list_folder_files(spark, f"{base}/source=*", "*").withColumn("path", _norm_uri("path"))
    ready = M.with_readiness(configs.withColumn("out", _norm_uri("out")), listing).filter("ready")
    return out.join(ready.select(F.col("job").alias("source")), "source")


@register("no_clobber", "SELECT doc_id, source FROM documents")
def q_no_clobber(spark, sf):
    base = scratch_dir(spark, "no_clobber")
    docs = table(spark, sf, "documents").select("doc_id", "source")
    K.write_no_clobber(docs.filter(F.col("doc_id") % 2 == 0), base, ["doc_id"])
    K.write_no_clobber(docs, base, ["doc_id"])  # second run: only the missing half is added
    K.write_no_clobber(docs, base, ["doc_id"])  # third run: nothing to add
    return spark.read.parquet(base).select("doc_id", "source")


@register("routed_artifacts", _PENDING_SQL + "SELECT sample_id, family FROM p")
def q_routed_artifacts(spark, sf):
    base = scratch_dir(spark, "artifacts")
    pending = A.pending(_scorable(spark, sf), artifact_table(spark, sf))
    scored = pending.withColumn("score", (F.col("sample_id") % 97) / 97.0)
    K.write_routed_artifacts(scored, base)
    return spark.read.parquet(base).select("sample_id", "family")


@register(
    "metrics_log",
    "SELECT DISTINCT CAST(event_id // 4 AS BIGINT) AS step, CAST(2 AS BIGINT) AS n FROM events",
)
def q_metrics_log(spark, sf):
    base = scratch_dir(spark, "metrics")
    ev = table(spark, sf, "events")
    log = ev.groupBy(F.floor(F.col("event_id") / 4).cast("bigint").alias("step")).agg(F.avg("value").alias("train_loss"))
    K.append_log(log, base)
    K.append_log(log, base)  # a second run appends, nothing is rewritten
    back = spark.read.schema("step bigint, train_loss double").json(base)
    return back.groupBy("step").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


@register("snapshots", _ENTRIES_SQL + "SELECT 'run-1' AS run_id, CAST(count(*) AS BIGINT) AS entries FROM entries")
def q_snapshots(spark, sf):
    base = scratch_dir(spark, "snapshots")
    entries = manifest_entries(spark, sf)
    K.write_snapshot({"manifest": entries.select("path", "type", "weight"), "counts": entries.select("n", "approx_records")}, base, "run-1")
    back = spark.read.json(f"{base}/manifest")
    return back.groupBy("run_id").agg(F.count(F.lit(1)).cast("bigint").alias("entries"))


@register(
    "manifest_lines_write",
    _ENTRIES_SQL + "SELECT to_json(struct_pack(path := path, type := 'math_tool', weight := weight * 2)) AS value FROM entries",
)
def q_manifest_lines_write(spark, sf):
    base = scratch_dir(spark, "manifest_lines")
    e = manifest_entries(spark, sf).withColumn("weight", F.col("weight") * 2)
    K.write_manifest_lines(M.manifest_json(M.override_type_weight(e, "math_tool", None)), base)
    return spark.read.text(base).select("value")


@register(
    "shard_listing",
    _PREP_SQL
    + f""", f2 AS (SELECT DISTINCT source, printf('part-%05d.jsonl', pos // {SUMMARY_SHARD_SIZE}) AS shard_file FROM s)
SELECT source, shard_file, row_number() OVER (ORDER BY source || '/' || shard_file) - 1 AS name_rank FROM f2""",
)
def q_shard_listing(spark, sf):
    """Shard files listed in name order."""
    base = scratch_dir(spark, "shard_listing")
    prepared = prepared_documents(spark, sf).withColumn("type", F.lit("lm"))
    K.write_shards(prepared, base, ["source"], "shard", "shard_pos")
    return K.list_shard_files(spark, base).select(
        F.regexp_extract("path", r"source=([^/]+)/", 1).alias("source"),
        F.regexp_extract("path", r"([^/]+)$", 1).alias("shard_file"),
        "name_rank",
    )

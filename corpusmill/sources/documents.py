"""Corpus-specific scans: word-problem XML / JSON arrays, wiki dumps, code archives,
and paragraph assembly.  All produce DataFrames of records ready for ``prepare_corpus``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from corpusmill.functions.text import first_truthy, py_strip
from corpusmill.functions.wiki import strip_wiki
from corpusmill.operators.ordinals import null_safe_join
from corpusmill.session import scratch_dir
from corpusmill.sources.archives import read_zip

# --- fixed values --------------------------------------------------------------------
BODY_FIELDS = ("Body", "body", "Description")
QUESTION_FIELDS = ("Question", "question", "Problem")
ANSWER_FIELDS = ("Answer", "answer")
JSON_QUESTION_FIELDS = ("Question", "question")
JSON_ANSWER_FIELDS = ("Answer", "answer")
# -------------------------------------------------------------------------------------


#: An element named problem or item in any case, up to its end tag.
_PROBLEM = r"(?is)<((?:problem|item)(?=[\s>]))[^>]*>.*?</\1\s*>"
_FIRST_TAG = r"(?is)^<[^\s>]+"
_LAST_TAG = r"(?is)</[^\s>]+\s*>\z"


def read_problem_xml(spark: SparkSession, path: str, keep=()) -> DataFrame:
    """Word problems from XML: elements named ``problem`` or ``item`` in any case, fields by
    first non-empty alternative; ``keep`` carries extra fields through (null when absent).

    One pass: a file is one row (word-problem files are a few MB), its elements are cut out
    in document order (``position``, 0-based per file) and parsed with ``from_xml``."""
    names = list(dict.fromkeys([*BODY_FIELDS, *QUESTION_FIELDS, *ANSWER_FIELDS, *keep]))
    files = spark.read.text(path, wholetext=True)
    found = files.select(
        F.col("_metadata.file_path").alias("file_path"),
        F.posexplode(F.regexp_extract_all("value", F.lit(_PROBLEM), F.lit(0))).alias("position", "xml"),
    )
    xml = F.regexp_replace(F.regexp_replace("xml", _FIRST_TAG, "<row"), _LAST_TAG, "</row>")
    schema = ", ".join(f"`{n}` string" for n in names)
    parsed = F.from_xml(xml, schema, {"rowTag": "row", "ignoreSurroundingSpaces": "false"})
    # names that differ by case only are told apart as keys of a map
    rec = found.withColumn("m", F.from_json(F.to_json(parsed), "map<string,string>"))
    first = lambda fields: first_truthy(*[F.col("m")[n] for n in fields])
    return rec.select(
        *[F.col("m")[k].alias(k) for k in keep],
        first(BODY_FIELDS).alias("body"),
        first(QUESTION_FIELDS).alias("question"),
        first(ANSWER_FIELDS).alias("answer"),
        "file_path",
        F.col("position").cast("bigint").alias("position"),
    )


def read_problem_json_array(spark: SparkSession, path: str, keep=()) -> DataFrame:
    """Word problems from files that hold one JSON array each, in document order
    (``position``); ``keep`` carries extra fields through.  Elements are read as maps, as
    the alternatives' names differ by case only."""
    raw = spark.read.text(path, wholetext=True)
    rows = raw.select(
        F.col("_metadata.file_path").alias("file_path"),
        F.posexplode(F.from_json("value", "array<map<string,string>>")).alias("position", "m"),
    )
    first = lambda names: first_truthy(*[F.col("m")[n] for n in names])
    return rows.select(
        *[F.col("m")[k].alias(k) for k in keep],
        first(("Body",)).alias("body"),
        first(JSON_QUESTION_FIELDS).alias("question"),
        first(JSON_ANSWER_FIELDS).alias("answer"),
        "file_path",
        F.col("position").cast("bigint").alias("position"),
    )


@F.arrow_udf(StringType())
def strip_wiki_markup(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Wiki markup to text, by one scan per text (``functions.wiki``)."""
    for texts in batches:
        yield pa.array([strip_wiki(t.as_py()) for t in texts], pa.string())


def read_wiki_dump(spark: SparkSession, path: str) -> DataFrame:
    """Articles from a MediaWiki XML dump (bz2 or plain): namespace 0, not redirects,
    one record per article ``(page_id, title, text)`` with markup stripped."""
    # a fixed schema: no inference pass, titles and texts stay as written.  The body is the
    # value of <text>, with or without attributes; <redirect title=".."/> marks a redirect
    schema = (
        "id string, ns string, title string, redirect struct<_title:string>, "
        "revision struct<text:struct<_VALUE:string>>"
    )
    df = spark.read.format("xml").schema(schema).option("rowTag", "page").load(path)
    article = (F.coalesce(F.col("ns").cast("int"), F.lit(0)) == 0) & F.col("redirect").isNull()
    out = df.filter(article).select(
        F.col("id").cast("bigint").alias("page_id"), "title", F.col("revision.text._VALUE").alias("raw")
    )
    return out.withColumn("text", strip_wiki_markup("raw")).drop("raw")


# ---------------------------------------------------------------- code archives


#: JSON renderings of the values that count as no value.
_FALSY_JSON = ("null", '""', "false", "0", "-0", "0.0", "-0.0", "[]", "{}")


def _first_truthy_text(record: Column, fields) -> Column:
    """The first field with a truthy JSON value; null unless that value is a string."""
    values = [F.try_variant_get(record, f"$.{f}", "variant") for f in fields]
    picked = F.coalesce(*[F.when(~F.to_json(v).isin(*_FALSY_JSON), v) for v in values])
    return F.when(F.schema_of_variant(picked) == "STRING", F.try_variant_get(picked, "$", "string"))


def code_records(spark: SparkSession, pattern: str) -> DataFrame:
    """Code archive members -> records ``(archive, member, line_no, from_jsonl,
    record_index, text)``; one scan of the archives.

    An archive that holds any ``*.jsonl`` member is read as JSON lines (field precedence
    ``code``, ``func_code``, ``original_string``, ``content``); otherwise each source file
    with a known extension is one record.  ``record_index`` is 1-based and runs over all
    archives in name order: every non-blank JSON line counts, parsed or not, and every
    source file.  Lines without a text are dropped after counting."""
    from corpusmill.functions.text import CODE_FIELDS
    from corpusmill.operators.ordinals import with_ordinal

    # the archives are read once: counting, sampling and numbering go over the written records
    path = scratch_dir(spark, "code-records")
    read_zip(spark, pattern, "code").write.parquet(path)
    raw = spark.read.parquet(path)
    numbered = with_ordinal(raw, ["archive", "member_no", "line_no"], name="record_index", start=1,
                            sample_from=raw.select("archive", "member_no", "line_no"))
    from_json = _first_truthy_text(F.try_parse_json("content"), CODE_FIELDS)
    text = F.when(F.col("from_jsonl"), from_json).otherwise(F.col("content"))
    out = numbered.withColumn("text", text).filter("text is not null")
    return out.select("archive", "member", "line_no", "from_jsonl", "record_index", "text")


# ---------------------------------------------------------------- paragraphs


def paragraphs_of(text: Column | str) -> Column:
    """Whole-text paragraph assembly: runs of consecutive non-blank lines (blank =
    whitespace only) joined by ``\\n``; lines split on ``\\n`` as a line iterator does.

    Linear in the text: blank lines are emptied, the lines joined again, outer newlines
    trimmed, and the rest split at runs of newlines (no group repeats in a regex)."""
    t = F.col(text) if isinstance(text, str) else text
    lines = F.transform(F.split(t, "\n", -1), lambda x: F.when(py_strip(x) == "", F.lit("")).otherwise(x))
    body = F.btrim(F.array_join(lines, "\n"), F.lit("\n"))
    return F.filter(F.split(body, "\n{2,}", -1), lambda p: p != "")


def with_paragraphs(df: DataFrame, text: Column | str, out_col: str = "paragraphs") -> DataFrame:
    return df.withColumn(out_col, paragraphs_of(text))


LINES_AT_ONCE = 1 << 12  # line numbers of a block of lines


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of ``(line number, line)`` in order -> their runs of non-blank lines, and whether
    the first and last line are part of one.  A null line is left out."""
    for batch in batches:
        runs, opens, ends = [], [], []
        for lines in batch.column(batch.num_columns - 1).to_pylist():
            found, run, number = [], [], None
            known = [(x["no"], x["line"]) for x in lines if x["line"] is not None]
            for no, line in known:
                if line.strip():
                    number = no if number is None else number
                    run.append(line)
                elif run:
                    found.append({"first_line": number, "text": "\n".join(run)})
                    run, number = [], None
            ends.append(bool(run))
            opens.append(bool(known) and bool(known[0][1].strip()))
            if run:
                found.append({"first_line": number, "text": "\n".join(run)})
            runs.append(found)
        kind = pa.list_(pa.struct([("first_line", pa.int64()), ("text", pa.string())]))
        columns = [pa.array(runs, kind), pa.array([len(r) for r in runs], pa.int64()), pa.array(opens), pa.array(ends)]
        names = [*batch.schema.names[:-1], "__runs", "__n", "__opens", "__ends"]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], names=names)


def paragraphs_from_lines(lines: DataFrame, key_cols, line_no_col: str, line_col: str) -> DataFrame:
    """Line rows -> paragraph rows (``first_line``, ``text``, ``para_no``).

    Lines are cut by number into blocks of ``LINES_AT_ONCE``, so a long key is many groups; a
    block gives its runs of non-blank lines.  The blocks are written once.  Over their counts
    (no texts) a window tells the number of each block's first run and whether it goes on from
    the block before; only runs at such edges are grouped again."""
    spark, keys = lines.sparkSession, list(key_cols)
    held = lines.select(*keys, F.floor(F.col(line_no_col) / F.lit(LINES_AT_ONCE)).cast("bigint").alias("__block"),
                        F.struct(F.col(line_no_col).cast("bigint").alias("no"), F.col(line_col).alias("line")).alias("__line"))
    blocks = held.groupBy(*keys, "__block").agg(F.sort_array(F.collect_list("__line")).alias("__lines"))
    blocks = blocks.filter(F.exists("__lines", lambda x: x["line"].isNotNull()))
    head = ", ".join(f"`{c}` {lines.schema[c].dataType.simpleString()}" for c in keys)
    runs = "__runs array<struct<first_line: bigint, text: string>>, __n bigint, __opens boolean, __ends boolean"
    path = scratch_dir(spark, "line-blocks")
    blocks.mapInArrow(_runs, f"{head}, __block bigint, {runs}").write.parquet(path)
    blocks = spark.read.parquet(path)

    order = Window.partitionBy(*keys).orderBy("__block")
    joins = F.col("__opens") & F.coalesce(F.lag("__ends").over(order), F.lit(False))
    counts = blocks.select(*keys, "__block", "__n", "__opens", "__ends").withColumn("__joins", joins)
    before = F.coalesce(F.sum(F.col("__n") - F.col("__joins").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.withColumn("__first", before - F.col("__joins").cast("int"))
    counts = counts.withColumn("__joined", F.coalesce(F.lead("__joins").over(order), F.lit(False)))
    placed = null_safe_join(blocks.select(*keys, "__block", "__n", "__runs"), counts.drop("__n", "__opens", "__ends"), [*keys, "__block"])
    run = placed.select(*keys, "__block", "__n", "__first", "__joins", "__joined", F.posexplode("__runs").alias("__k", "__run"))
    edge = ((F.col("__k") == 0) & F.col("__joins")) | ((F.col("__k") == F.col("__n") - 1) & F.col("__joined"))
    run = run.select(*keys, "__block", "__run.*", (F.col("__first") + F.col("__k")).alias("para_no"), edge.alias("__edge"))
    whole = run.filter(~F.col("__edge")).select(*keys, "first_line", "text", "para_no")
    pieces = F.sort_array(F.collect_list(F.struct("__block", "text")))
    cut = run.filter("__edge").groupBy(*keys, "para_no").agg(
        F.min("first_line").alias("first_line"), F.array_join(F.transform(pieces, lambda p: p["text"]), "\n").alias("text")
    )
    return whole.unionByName(cut)

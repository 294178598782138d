"""Queries: paragraphs, malformed JSON rows, text-column detection, code-file filter."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.functions import ids as I
from corpusmill.functions import text as T
from corpusmill.plans import duck as D
from corpusmill.plans.catalog import register, table
from corpusmill.sources.documents import with_paragraphs
from corpusmill.sources.files import CORRUPT_COL, detect_text_column

# Sentence ends become paragraph breaks with a whitespace-only line in between.
_PARA_RAW_SQL = "replace(text, '. ', '.' || chr(10) || ' ' || chr(9) || chr(10))"


def paragraph_raw(col):
    return F.replace(col, F.lit(". "), F.lit(".\n \t\n"))


PARAGRAPHS_SQL = f"""
WITH d AS (SELECT doc_id, string_split(regexp_replace({_PARA_RAW_SQL}, '\\n$', ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS ln FROM d),
b AS (SELECT *, regexp_matches(line, '^{D.PY_SPACE}*$') AS blank FROM l),
g AS (SELECT *, sum(CASE WHEN blank THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY ln) AS grp FROM b),
p AS (SELECT doc_id, grp, string_agg(line, chr(10) ORDER BY ln) AS para FROM g WHERE NOT blank GROUP BY doc_id, grp)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY grp) - 1 AS BIGINT) AS para_no,
       sha1(para) AS para_sha1, CAST(length(para) AS BIGINT) AS n_chars FROM p
"""


@register("paragraphs", PARAGRAPHS_SQL)
def q_paragraphs(spark, sf):
    docs = table(spark, sf, "documents")
    staged = with_paragraphs(docs.select("doc_id", paragraph_raw(F.col("text")).alias("raw")), "raw", "paras")
    p = staged.select("doc_id", F.posexplode("paras").alias("para_no", "para"))
    return p.select(
        "doc_id",
        F.col("para_no").cast("bigint").alias("para_no"),
        I.sha1_hex("para").alias("para_sha1"),
        F.length("para").cast("bigint").alias("n_chars"),
    )


_BROKEN = "CASE WHEN event_id % 7 = 0 THEN substring(props, 2) ELSE props END"


@register(
    "malformed_rows",
    f"SELECT event_id, json_extract(r, '$.k')::BIGINT AS k FROM (SELECT event_id, {_BROKEN} AS r FROM events) WHERE json_valid(r) AND starts_with(r, '{{')",
)
def q_malformed_rows(spark, sf):
    ev = table(spark, sf, "events").select("event_id", F.expr(_BROKEN).alias("r"))
    schema = f"k bigint, {CORRUPT_COL} string"
    parsed = ev.withColumn("rec", F.from_json("r", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COL}))
    ok = parsed.filter(F.col("rec").isNotNull() & F.col(f"rec.{CORRUPT_COL}").isNull())
    return ok.select("event_id", F.col("rec.k").alias("k"))


@register(
    "text_column_detect",
    """SELECT 'documents' AS tbl, 'text' AS text_column, CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(length(text)) AS BIGINT) AS n_chars FROM documents
UNION ALL SELECT 'pages', 'content', CAST(count(*) AS BIGINT), CAST(sum(length(html)) AS BIGINT) FROM pages""",
)
def q_text_column_detect(spark, sf):
    frames = {
        "documents": table(spark, sf, "documents"),
        "pages": table(spark, sf, "pages").withColumnRenamed("html", "content"),
    }
    out = None
    for name, df in frames.items():
        col = detect_text_column(df)
        part = df.agg(
            F.count(F.lit(1)).cast("bigint").alias("n_rows"), F.sum(F.length(col)).cast("bigint").alias("n_chars")
        ).select(F.lit(name).alias("tbl"), F.lit(col).alias("text_column"), "n_rows", "n_chars")
        out = part if out is None else out.unionByName(part)
    return out


_EXTS = ["'.py'", "'.Java'", "'.txt'", "'.JS'", "'.go'", "'.PHP'", "'.rb'", "'.md'", "'/'"]
_MEMBER_SQL = f"regexp_replace(url, '[?#].*$', '') || [{', '.join(_EXTS)}][page_id % 9 + 1]"


@register(
    "code_ext_filter",
    f"""
WITH m AS (SELECT page_id, {_MEMBER_SQL} AS member FROM pages),
e AS (SELECT page_id, member, regexp_extract(regexp_extract(member, '([^/]*)$', 1), '^\\.*[^.].*(\\.[^.]*)$', 1) AS ext FROM m)
SELECT page_id, member FROM e WHERE NOT ends_with(member, '/') AND lower(ext) IN ('.py', '.java', '.js', '.go', '.php', '.rb')
""",
)
def q_code_ext_filter(spark, sf):
    pages = table(spark, sf, "pages")
    exts = F.array(*[F.lit(e.strip("'")) for e in _EXTS])
    m = pages.select(
        "page_id",
        F.concat(F.regexp_replace("url", r"[?#].*$", ""), F.element_at(exts, (F.pmod("page_id", F.lit(9)) + 1).cast("int"))).alias(
            "member"
        ),
    )
    return m.filter(T.is_code_file("member"))

"""The pipeline against a brute-force version, and its stages on odd and empty tables."""

import brute as B
import duckdb
import pytest
from conftest import rows as odd_rows
from pyspark.sql import functions as F

import corpus_pipeline
from corpusmill.llm import oracles, quality, queries

SMALL = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """sf0.001 with odd documents beside its own."""
    path = str(tmp_path_factory.mktemp("sf"))
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select(*COLUMNS)
    odd = spark.createDataFrame(
        [(None if r[0] is None else r[0] + 10_000, *r[1:4], None) for r in odd_rows()],
        "doc_id bigint, text string, lang string, source string, n_chars bigint",
    )
    docs.unionByName(odd).repartition(4).write.parquet(f"{path}/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{SMALL}/{t}.parquet").write.parquet(f"{path}/{t}.parquet")
    return path


def brute(folder):
    from tokenizers import Tokenizer

    import public_tokenizers

    con = duckdb.connect()
    rows = lambda t, c: con.execute(f"SELECT {c} FROM read_parquet('{folder}/{t}.parquet/*.parquet')").fetchall()
    docs = rows("documents", "doc_id, text, source")
    good = {i for i, q, t in rows("labels", "doc_id, quality, toxic") if q == 1 and t == 0}
    verdict = B.quality([t for _, t, _ in docs], [i in good for i, _, _ in docs], quality.THRESHOLD)
    docs = [d for d, q in zip(docs, verdict) if q["kept"]]
    counts = [len(docs)]
    # one document per class: its smallest id (without ids: any one), repeats once
    kept, seen = [], set()
    for d, (_, low) in sorted(zip(docs, B.classes([d[0] for d in docs], [d[1] for d in docs])), key=lambda x: str(x[0])):
        assert low is not None
        if d[0] == low and low not in seen:
            seen.add(low)
            kept.append(d)
    counts.append(len(kept))
    items = rows("benchmark", "item_id, text")
    kept = [d for d in kept if (lambda n, hit, _: not (hit and 20 * len(hit) >= n))(*B.contamination(d[1], items))]
    counts.append(len(kept))
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", kept)
    taken = con.execute(f"SELECT doc_id, CAST(taken / size AS INT) FROM ({oracles.mixed()}) WHERE size > 0").fetchall()
    text = {i: t for i, t, _ in kept}
    tok = Tokenizer.from_file(public_tokenizers.path(queries.TOKENIZER))
    out, start = [], 0
    for i, copies in sorted(taken):
        ids = [*tok.encode(text[i], add_special_tokens=False).ids, 2]
        for _ in range(copies):
            out.append((i, start, len(ids), B.tokens_crc(ids)))
            start += len(ids)
    return out, counts


def test_pipeline_matches_brute_force(spark, folder):
    want, counts = brute(folder)
    got = sorted(tuple(r) for r in corpus_pipeline.run(spark, folder).select("doc_id", "start", "n_tokens", "ids_crc32").collect())
    assert got == sorted(want)
    assert counts[0] > counts[1] > counts[2]  # every stage had something to do


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES[:-1])
def test_stages_keep_the_columns(spark, folder, name, stage):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for column in ("n_words", "size", "copies", "component_id"):  # names that operators use
        docs = docs.withColumn(column, F.lit("clash"))
    out = stage(spark, docs, folder)
    assert out.columns == docs.columns
    assert out.filter("size <> 'clash' or n_words <> 'clash'").count() == 0
    assert stage(spark, docs.limit(0), folder).collect() == []


def test_last_stage_on_an_empty_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect() == []

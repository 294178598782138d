"""One row of every SimHash class, whatever its ids."""

from pyspark.sql import functions as F

from corpusmill.llm import simhash


def test_one_row_of_every_class(spark):
    """Unrelated texts under one id are two classes; near copies without ids are one."""
    words = [f"w{k}" for k in range(400)]
    prose = lambda seed: " ".join(words[(seed * 7919 + k * k * (seed + 3)) % 400] for k in range(300))
    texts = [prose(s) for s in range(4)]
    near = texts[2] + " end"
    rows = [(1, texts[0]), (1, texts[1]), (2, texts[1] + " end"), (None, texts[2]), (None, near), (None, texts[3]), (5, texts[3])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    of = {r.text: r.class_root for r in simhash.simhash_classes(docs).join(docs.withColumn("text_hash", F.xxhash64("text")).drop("doc_id"), "text_hash").collect()}
    assert of[texts[2]] == of[near] and of[texts[1]] == of[texts[1] + " end"]
    assert len(set(of.values())) == 4
    got = {(r.doc_id, of[r.text]) for r in simhash.keep_one_per_class(docs).collect()}
    assert got == {(1, of[texts[0]]), (1, of[texts[1]]), (None, of[near]), (5, of[texts[3]])}
    assert simhash.keep_one_per_class(docs).count() == 4

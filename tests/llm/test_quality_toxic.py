"""Toxic documents are found whatever their length."""

from pyspark.sql import functions as F

from corpusmill.llm import langid, quality, queries

SMALL = "/root/testdata/sf0.01"


def rates(rows):
    """Flagged shares of toxic and of clean documents, kept shares of toxic and of good ones."""
    toxic, flag, kept = F.col("toxic") == 1, F.col("flag").cast("int"), F.col("kept").cast("int")
    mean = lambda x, where: F.avg(F.when(where & (F.col("quality") == 1), x))
    return tuple(rows.agg(mean(flag, toxic), mean(flag, ~toxic), mean(kept, toxic), mean(kept, ~toxic)).first())


def test_toxic_documents_are_left_out(spark):
    docs, labels = (queries.table(spark, SMALL, t) for t in ("documents", "labels"))
    held = langid.fold(F.col("doc_id"), 4) == 2  # a quarter of the labels is held out
    learnt = labels.filter(~held)
    trusted = learnt.filter("quality = 1 and toxic = 0").select("doc_id")
    q = F.col("q")
    got = quality.score_quality(docs, trusted, out="q", labels=learnt.select("doc_id", (F.col("toxic") == 1).alias("toxic")))
    got = got.filter(~quality.base_failed(q)).withColumn("flag", q["toxicity"] > 0).withColumn("kept", quality.is_kept(q))
    toxic, clean, _, _ = rates(got.join(labels, "doc_id").filter(held))
    assert toxic >= 0.75 and clean <= 0.01
    # the query learns from all labels
    got = queries.op2_quality_rules(spark, SMALL).filter("not base_failed").withColumn("flag", F.lit(False))
    _, _, toxic, good = rates(got.join(labels, "doc_id"))
    assert toxic <= 0.25 and good >= 0.99
    none = quality.score_quality(docs, trusted, labels=labels.select("doc_id", F.lit(False).alias("toxic")))
    assert none.filter("quality.toxicity <> 0").count() == 0


def test_toxic_words_count_in_long_texts(spark):
    rows = [(i, " ".join(["fine words here"] * 20) + (" Moron!" if i % 5 == 0 else "")) for i in range(200)]
    docs = spark.createDataFrame([*rows, (200, "fine words " * 10_000 + "moron"), (None, "moron"), (201, None)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 5 == 0) for i in range(200)], "doc_id bigint, toxic boolean")
    got = quality.score_quality(docs, labels.limit(0).select("doc_id"), labels=labels.repartition(3)).filter("quality.toxicity > 0")
    assert {r.doc_id for r in got.collect()} == {*range(0, 201, 5), None}

"""The ``opN_*`` queries: each applies its operator to whole tables and derives the digest
columns of its contract.  ``ORACLES`` has DuckDB SQL where SQL can express the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm import (
    conversations,
    decontam,
    hpylm,
    langid,
    line_dedup,
    mixing,
    periodic,
    quality,
    seed_extend,
    simhash,
    sparse_suffix,
    token_output,
    wrappers,
)
from corpusmill.llm.oracles import ORACLES  # noqa: F401
from corpusmill.operators.ordinals import null_safe_join
from corpusmill.session import scratch_dir

TOKENIZER = "word_bpe_49k.json"
END_ID = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def trusted_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of documents that are labelled good and not toxic."""
    return table(spark, sf_dir, "labels").filter("quality = 1 and toxic = 0").select("doc_id")


def toxic_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, toxic) of all labelled documents."""
    return table(spark, sf_dir, "labels").select("doc_id", (F.col("toxic") == 1).alias("toxic"))


def mix_emphasis() -> F.Column:
    """Longer texts are a little more likely: the logarithm of the size in words."""
    return F.log2(mixing.size_of(F.col("text")) + 2)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = decontam.find_contamination(docs.select("doc_id", "text"), benchmark, out="c")
    return found.select(
        "doc_id",
        "c.n_words",
        "c.n_hit",
        F.size("c.items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "c.items"), 256).alias("items_sha256"),
        decontam.is_contaminated(F.col("c")).alias("contaminated"),
    )


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    q = F.col("q")
    scored = quality.score_quality(docs, trusted_documents(spark, sf_dir), out="q", labels=toxic_labels(spark, sf_dir))
    return scored.select(
        "doc_id",
        *[q[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        quality.base_failed(q).alias("base_failed"),
        quality.is_kept(q).alias("kept"),
        q["llr"].alias("llr"),
    )


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = langid.fold(F.col("doc_id"), 4) == 2
    model = langid.learn_centroids(docs.filter(~held_out), "doc_id", "text", "lang")
    found = langid.identify(docs.drop("lang"), model, out="l")
    return found.select(
        "doc_id",
        held_out.alias("held_out"),
        F.col("l.nearest").alias("lang_pred"),
        F.col("l.score").alias("score"),
        F.col("l.rejected").alias("rejected"),
    )


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    mixed = mixing.mix(docs, emphasis=mix_emphasis())
    taken = (F.col("copies") * F.col("size")).cast("bigint")
    return mixed.select("doc_id", "size", "source_size", "target", taken.alias("taken"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    # a row per maximal repeat, all copies; documents without one have none
    found = sparse_suffix.dedup_suffixes(docs).select("doc_id", "n_words", F.explode("repeats").alias("r"))
    return found.select(
        "doc_id", "n_words", *[F.col(f"r.{c}").cast("bigint").alias(n) for c, n in
                               (("start", "start"), ("length", "length"), ("removed", "n_removed"))]
    )


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = seed_extend.dedup_substrings(docs)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def token_table(docs: DataFrame) -> DataFrame:
    """Write the token files of ``docs`` and read them back, a row per document."""
    import public_tokenizers  # only this query needs it

    spark = docs.sparkSession
    folder = scratch_dir(spark, "tokens")
    token_output.write_tokens(docs, folder, public_tokenizers.path(TOKENIZER), end_id=END_ID)
    return token_output.read_tokens(spark, folder, docs.schema["doc_id"].dataType.simpleString()).withColumnRenamed(
        "key", "doc_id"
    )


def op7_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_table(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = line_dedup.dedup_lines(docs)
    return found.select("doc_id", "n_lines", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op9_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.simhash_classes(docs).select("doc_id", "fingerprint", "component_id")


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = hpylm.score_texts(docs, langid.fold(F.col("doc_id"), 10) != 0)
    return scored.select(
        "doc_id", (~F.col("learned")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def damaged_turns(rows: DataFrame) -> DataFrame:
    """The contract's damage: by the checksum of ``conv_id:turn`` a row is dropped, emptied,
    stripped of its sentence marks, repeated, or given the role user; nulls are one space."""
    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat_ws(":", filled("conv_id"), filled("turn")).cast("binary")) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.regexp_replace(filled("text"), "[.!?]", "")).otherwise(filled("text"))
    return rows.filter(fault != 0).select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(filled("role")).alias("role"),
        text.alias("text"),
        F.explode(F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    repair = conversations.repair_conversations(damaged_turns(rows))
    digests = repair.digests().withColumnRenamed("key", "conv_id")
    found = null_safe_join(repair.report, digests, ["conv_id"], "left")
    found = null_safe_join(rows.select("conv_id").distinct(), found, ["conv_id"], "left")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return found.select(
        "conv_id",
        *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def looped_documents(docs: DataFrame) -> DataFrame:
    """The contract's damage: in texts whose checksum of the id ends in 0, the words from some
    place on become repeats of the words there; the others keep their text."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    marked = docs.withColumn("h", h).withColumn("w", F.when(F.col("h") % 10 == 0, words))
    n = F.when(F.size("w") > 0, F.size("w"))  # null: the text stays
    marked = marked.withColumn("a", F.pmod(F.floor(F.col("h") / 10), n).cast("int")).withColumn(
        "p", (F.floor((n - F.col("a")) / (F.floor(F.col("h") / 10) % 8 + 3)) + 1).cast("int")
    )
    rest = n - F.col("a")
    block = F.slice("w", F.col("a") + 1, F.col("p"))
    loop = F.slice(F.flatten(F.array_repeat(block, F.ceil(rest / F.col("p")).cast("int"))), 1, rest)
    text = F.array_join(F.concat(F.slice("w", 1, F.col("a")), loop), " ")
    return marked.select("doc_id", F.when(n.isNotNull(), text).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = looped_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periodic.periodic_runs(docs, out="r").select("doc_id", "r.*")
    # a listing of the runs, one per line; a document without runs has no strongest one
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = F.get("runs", F.col("strongest"))
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        *[best[c].alias(c) for c in ("start", "length", "period")],
        F.floor(best["length"] * 1000 / best["period"]).cast("bigint").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = wrappers.extract_main_text(pages)
    return found.withColumn("n_chars", F.char_length("text").cast("bigint"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_decontamination,
        op2_quality_rules,
        op3_language_id,
        op4_mixing,
        op5_suffix_dedup,
        op6_substring_dedup,
        op7_token_output,
        op8_line_dedup,
        op9_simhash_dedup,
        op10_lm_scoring,
        op11_conversation_repair,
        op12_periodic_runs,
        op13_html_extraction,
    )
}

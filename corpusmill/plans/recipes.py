"""The composed recipes: corpus preparation, mixture to training batches, incremental
scoring.

Corpus preparation as one lazy plan:

scan -> normalise and hash, where the text is read -> ordinal (rejected rows count)
     -> drop rejects -> sample id -> keep-first dedup per dataset -> shard layout
     -> (sink / summary)

Stage boundaries are shuffles chosen by Catalyst: the ordinal (range shuffle), the
dedup (aggregate + semi-join on (hash, ord)) and the shard numbering (range shuffle).
Where nothing after the layout reads the texts, only ids and hashes are shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.ids import ID_SNIPPET_CHARS, fallback_sample_id, sample_id, text_hash
from corpusmill.functions.text import is_valid_text, normalize_text, with_normalized
from corpusmill.operators import manifest as M
from corpusmill.operators.artifacts import lookup, pending, pending_counters
from corpusmill.operators.dedup import DEFAULT_MAX_RECORDS, assign_shards, dedup_keep_first
from corpusmill.operators.losses import is_matrix
from corpusmill.operators.mixing import assign_batches, collate, interleave, limit_batches, stripe_workers
from corpusmill.operators.ordinals import with_ordinal
from corpusmill.operators.scoring import score, tokenize
from corpusmill.operators.tools import inject_tool_results
from corpusmill.sinks.writers import table_exists, write_routed_artifacts


def number_records(
    df: DataFrame, dataset_col: str, order_cols, name: str = "record_index"
) -> DataFrame:
    """Running record index per dataset, counted before any filter (0-based)."""
    return with_ordinal(df, order_cols, [dataset_col], name=name)


def prepare_corpus(
    df: DataFrame,
    dataset_col: str,
    order_cols,
    text_col: str = "text",
    uri_col: str | None = None,
    min_length: int = 10,
    collapse_whitespace: bool = True,
    max_records: int = DEFAULT_MAX_RECORDS,
    keep_text: bool = True,
) -> DataFrame:
    """Full preparation of one or many datasets (``dataset_col`` scopes numbering,
    dedup and shards, like one writer per dataset).  Without ``keep_text`` the texts end
    where they are normalised; the layout is the same."""
    # a plain column: nothing above the ordinal filters on it, and the ordinal's own counts
    # are pruned down to the keys
    cleaned = df.withColumn(text_col, normalize_text(text_col, min_length, collapse_whitespace))
    cleaned = cleaned.withColumn("text_sha1", text_hash(text_col))
    cleaned = cleaned.withColumn("__head", F.substring(text_col, 1, ID_SNIPPET_CHARS))  # what the id needs
    if not keep_text:
        cleaned = cleaned.drop(text_col)
    # keys of the raw input: bounds are drawn without normalising
    numbered = with_ordinal(cleaned, order_cols, [dataset_col], name="record_index", sample_from=df)
    valid = numbered.filter(F.col("text_sha1").isNotNull())
    valid = valid.withColumn("sample_id", sample_id(uri_col or dataset_col, "record_index", "__head")).drop("__head")
    unique = dedup_keep_first(valid, "text_sha1", "record_index", [dataset_col])
    # record_index follows order_cols within a dataset, so bucket bounds can be drawn
    # from the cheap raw input instead of the cleaned, deduplicated frame
    return assign_shards(
        unique, order_cols, [dataset_col], max_records=max_records, sample_from=df
    )


def corpus_summary(
    df: DataFrame,
    dataset_col: str,
    text_col: str = "text",
    min_length: int = 10,
    collapse_whitespace: bool = True,
    max_records: int = DEFAULT_MAX_RECORDS,
) -> DataFrame:
    """Records / shards / first and last shard per dataset, computed from counts: which
    copy of a duplicate is kept and the record ordinals do not change the counts, so
    this plan is normalise -> hash -> distinct (dataset, hash) -> count (two partial
    aggregations, no ordinal)."""
    from corpusmill.operators.dedup import summary_from_counts

    cleaned = with_normalized(df.select(dataset_col, text_col), text_col, text_col, min_length, collapse_whitespace)
    keys = cleaned.select(dataset_col, text_hash(text_col).alias("text_sha1")).distinct()
    return summary_from_counts(keys, [dataset_col], max_records)


def training_samples(
    records: DataFrame,
    artifacts: DataFrame,
    tokenizer,
    seq_len: int,
    entry_type_col: str = "entry_type",
    dataset_col: str = "dataset_id",
) -> DataFrame:
    """Records -> samples ready to be batched: valid text -> canonical type (the record's own
    type, else its entry's; path hints) -> tool results injected into math texts -> sample id
    (the fallback id is made of the injected text) -> ids and mask from ``tokenizer`` (a
    factory, see ``scoring.tokenize``) -> teacher scores by (id, family).

    ``artifacts``: sample_id, family, format, scores (a matrix); scores that are not a
    matrix count as invalid.  Adds sample_type, sample_id, input_ids, attention_mask,
    family, scores, status."""
    own = records.filter(is_valid_text("text"))
    kind = M.canonical_type(M.record_type("type", entry_type_col), F.col("path"), F.col(dataset_col))
    own = own.withColumn("sample_type", kind)
    injected = inject_tool_results(own, F.when(F.col("sample_type") == "math_tool", F.col("text")), "__injected")
    own = injected.withColumn("text", F.coalesce("__injected", "text")).drop("__injected")
    own = own.withColumn("sample_id", fallback_sample_id("sample_id", "path", "sha", "text"))
    own = tokenize(own, tokenizer, "text", seq_len).withColumn("family", M.artifact_family("sample_type"))
    checked = artifacts.withColumn("valid", F.coalesce(is_matrix(F.col("scores")), F.lit(False)))
    return lookup(own, checked, payload_cols=("scores",))


def mixture_to_batches(
    samples: DataFrame, entry_ord_col: str, order_cols, num_workers: int, batch_size: int, fields, max_batches: int | None = None
) -> DataFrame:
    """Samples -> batches: entries dealt to workers, each worker's entries interleaved, cut
    into batches and collated."""
    dealt = stripe_workers(samples, num_workers, entry_ord_col)
    ordered = interleave(dealt, entry_ord_col, entry_ord_col, order_cols, scope_cols=["worker"], position_col="pos")
    batched = limit_batches(assign_batches(ordered, "pos", batch_size), max_batches)
    return collate(batched, ["worker", "batch_id"], "pos", fields)


def incremental_scoring(records: DataFrame, artifacts_path: str, model_factory, entry_type_col: str = "entry_type") -> DataFrame:
    """One scoring run: records -> types and ids -> those without an artifact -> scores,
    appended by family.  Returns the counters (processed, skipped); a second run over the
    same records processes nothing."""
    spark = records.sparkSession
    own = records.filter(is_valid_text("text"))
    kind = M.canonical_type(M.record_type("type", entry_type_col), F.col("path"), F.lit(None).cast("string"))
    own = own.withColumn("family", M.artifact_family(kind)).filter("family is not null")
    own = own.withColumn("sample_id", fallback_sample_id("sample_id", "path", "sha", "text")).dropDuplicates(["sample_id", "family"])
    if table_exists(spark, artifacts_path):
        done = spark.read.parquet(artifacts_path).select("sample_id", "family")
    else:
        done = own.select("sample_id", "family").limit(0)
    counters = spark.createDataFrame([tuple(pending_counters(own, done).first())], "processed bigint, skipped bigint")
    todo = pending(own, done)
    scored = score(todo, model_factory, "text").select("sample_id", "family", F.col("online_score").alias("score"))
    write_routed_artifacts(scored, artifacts_path)
    return counters

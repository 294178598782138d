"""Mixing sources to target weights by Pareto order sampling.

Targets: the mix has ``share`` times the words of the corpus; sources share it by weight,
no target exceeds ``cap`` times its source's size and what it would exceed is shared again
by weight (water filling).  Within a source every document gets an expected number of
copies ``e`` proportional to its emphasis and at most ``cap``, so that the expected words
equal the target.  ``floor(e)`` whole copies are certain; the fraction ``p = e - floor(e)``
is sampled by Pareto order sampling: documents are ranked by
``(u / (1 - u)) / (p / (1 - p))`` with a uniform ``u`` hashed from the document, and the
smallest ranks are taken until the taken words are nearest to the source's target (the
fixed size is a size in words).

Scale: per source only small tables are gathered: (source, emphasis level) sums (levels
are powers of ``2**(1/8)``) and (source, rank bucket) sums, where a bucket is 1/4096 of
log odds, whose density is the same for any ``p`` (at most 1/16384 of a source, whatever
its size).  Exact ranks are read for the one bucket per source in which the cut falls.
The verdict of a document is then a comparison with its source's cut: no join on ids, no
sort of a source.

Defined cases: null texts have size 0; a null source is a source of its own, ordered last;
sources of size 0 have target 0 and their documents no copies; emphasis that is null, not
positive or not finite counts as 1; identical rows (key, source, text) have one rank and
are taken together; empty tables give empty results; input columns named like the result
columns are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm.tables import written

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
CAP = 2.0
SEED = 20
RANKS = 4096  # rank buckets per unit of log odds
_WORD = r"[^\x20\x09-\x0D]+"


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("bigint")


def unit(key: Column, source: Column, text: Column, seed: int = SEED) -> Column:
    """Uniform in (0, 1), from 52 bits of an MD5 over seed, key, source and text."""
    part = F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(key.cast("string"), F.lit("?")),
                             F.coalesce(source.cast("string"), F.lit("?")), F.md5(F.coalesce(text, F.lit("")))))
    return (F.conv(F.substring(part, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """``(source, source_size)`` -> also ``target``.  One row per source; water filling:
    sources in the order of cap / weight, the first ones that a common level exceeds are
    capped, the rest share what is left by weight."""
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    kinds = F.array(*[F.lit(float(w)) for w in weights])
    t = sizes.withColumn("w", F.element_at(kinds, (F.pmod(rank - 1, F.lit(len(weights))) + 1).cast("int")))
    t = t.withColumn("most", F.col("source_size") * F.lit(float(cap)))
    everyone = Window.partitionBy(F.lit(1))
    before = Window.partitionBy(F.lit(1)).orderBy(F.col("most") / F.col("w"), F.col("source").asc_nulls_last())
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everyone) * F.lit(float(share)) - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    wide = F.sum("w").over(everyone) - F.coalesce(F.sum("w").over(before), F.lit(0.0))
    t = t.withColumn("level", left / wide).withColumn("full", F.col("most") <= F.col("w") * F.col("level"))
    level = F.max(F.when(~F.col("full"), F.col("level"))).over(everyone)
    target = F.when(F.col("full") | level.isNull(), F.col("most")).otherwise(F.col("w") * level)
    return t.select("source", "source_size", target.alias("target"))


def _copies(docs: DataFrame, plan: DataFrame, cap: float) -> DataFrame:
    """Expected copies, whole copies and log rank of each row; ``plan`` has a row per source."""
    p = plan.select(F.col("source").alias("__cm_s"), "source_size", "target", "rate")
    joined = docs.join(p, F.col("source").eqNullSafe(F.col("__cm_s")), "left").drop("__cm_s")
    expected = F.least(F.lit(float(cap)), F.col("rate") * F.pow(F.lit(2.0), F.col("level") / 8.0))
    joined = joined.withColumn("expected", F.coalesce(expected, F.lit(0.0)))
    joined = joined.withColumn("whole", F.floor("expected").cast("int"))
    part = F.col("expected") - F.col("whole")
    rank = F.log(F.col("u") / (1 - F.col("u"))) - F.log(part / (1 - part))
    return joined.withColumn("rank", F.when(part > 0, rank))


def _rates(levels: DataFrame, plan: DataFrame, cap: float) -> DataFrame:
    """Per source the rate c with sum(size * min(cap, c * emphasis)) = target: the highest
    levels are capped first, the rest are in proportion."""
    x = F.pow(F.lit(2.0), F.col("level") / 8.0)
    t = levels.withColumn("x", x).withColumn("sx", F.col("words") * x)
    p = plan.select(F.col("source").alias("__cm_s"), "target")
    t = t.join(p, F.col("source").eqNullSafe(F.col("__cm_s"))).drop("__cm_s")
    down = Window.partitionBy("source").orderBy(F.col("level").desc())
    above = F.coalesce(F.sum("words").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    below = F.sum("sx").over(down.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    t = t.withColumn("c", (F.col("target") - F.lit(float(cap)) * above) / F.nullif(below, F.lit(0.0)))
    # right: no document of this level or below is over the cap
    fits = F.col("c") * F.col("x") <= F.lit(float(cap)) * (1 + 1e-12)
    rate = F.coalesce(F.max(F.when(fits, F.col("c"))), F.lit(0.0))
    return t.groupBy("source").agg(F.greatest(F.lit(0.0), rate).alias("rate"))


def mix(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    emphasis: Column | None = None,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    cap: float = CAP,
    seed: int = SEED,
) -> DataFrame:
    """``docs`` plus size, source_size, target, expected (copies) and copies."""
    own = ["size", "source_size", "target", "expected", "copies"]
    level = F.lit(0)
    if emphasis is not None:
        usable = F.when(emphasis.isNotNull() & (emphasis > 0) & (emphasis < float("inf")), emphasis).otherwise(F.lit(1.0))
        level = F.round(F.log2(usable) * 8).cast("int")
    basis = docs.select(
        F.col(source).alias("source"),
        size_of(F.col(text)).alias("size"),
        unit(F.col(key), F.col(source), F.col(text), seed).alias("u"),
        level.alias("level"),
    )
    sized = written(basis, "mix-sizes")  # a few numbers per document, no texts
    levels = sized.groupBy("source", "level").agg(F.sum("size").alias("words"))
    levels = written(levels, "mix-levels")
    plan = targets(levels.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, cap)
    rates = _rates(levels, plan, cap).select(F.col("source").alias("__cm_s"), "rate")
    plan = plan.join(rates, F.col("source").eqNullSafe(F.col("__cm_s"))).drop("__cm_s")
    plan = written(plan, "mix-plan")  # a row per source
    ranked = _copies(sized, plan, cap)
    # words still wanted after the whole copies
    bucket = F.floor(F.col("rank") * RANKS)
    sums = ranked.groupBy("source", bucket.alias("bucket")).agg(
        F.sum(F.col("whole") * F.col("size")).alias("certain"),
        F.sum(F.when(F.col("rank").isNotNull(), F.col("size"))).alias("words"),
        F.first("target").alias("target"),
    )
    sums = written(sums, "mix-ranks")
    per = Window.partitionBy("source")
    upto = per.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = sums.withColumn("wanted", F.first("target").over(per) - F.sum("certain").over(per)).filter("bucket is not null")
    cut = cut.withColumn("sum", F.sum("words").over(upto)).withColumn("before", F.col("sum") - F.col("words"))
    cut = cut.filter("sum >= wanted").groupBy("source").agg(F.min_by(F.struct("bucket", "before", "wanted"), "bucket").alias("b"))
    cut = cut.select(F.col("source").alias("__cm_s"), "b.*")
    inside = ranked.withColumn("at", bucket).join(cut, F.col("source").eqNullSafe(F.col("__cm_s")) & (F.col("at") == F.col("bucket")))
    ties = inside.groupBy("source", "rank").agg(
        F.sum("size").alias("words"),
        F.first("before").alias("before"),
        F.first("wanted").alias("wanted"),
        (F.first("bucket") / F.lit(float(RANKS))).alias("from"),
    )
    order = Window.partitionBy("source").orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ties = ties.withColumn("sum", F.col("before") + F.sum("words").over(order))
    # taken while it brings the sum nearer to what is wanted
    nearer = F.abs(F.col("sum") - F.col("wanted")) <= F.abs(F.col("sum") - F.col("words") - F.col("wanted"))
    last = ties.groupBy("source").agg(
        F.max(F.when(nearer & (F.col("sum") - F.col("words") < F.col("wanted")), F.col("rank"))).alias("last"),
        F.first("from").alias("from"),
    )
    # nothing of the cut's own bucket: everything under its lower bound
    last = last.select(F.col("source").alias("__cm_c"), F.coalesce("last", "from").alias("last"))
    some = cut.select("__cm_s", F.lit(True).alias("__cm_any"))
    cuts = plan.join(some, F.col("source").eqNullSafe(F.col("__cm_s")), "left")
    cuts = cuts.join(last, F.col("source").eqNullSafe(F.col("__cm_c")), "left")
    # sources whose ranks never reach what is wanted take everything
    everything = F.col("__cm_any").isNull()
    last = F.when(everything, F.lit(float("inf"))).otherwise(F.col("last"))
    cuts = written(cuts.select("source", "source_size", "target", "rate", last.alias("last")), "mix-cuts")

    rows = docs.select(
        *[F.col(c).alias(f"__cm_{k}") for k, c in enumerate(docs.columns)],
        F.col(source).alias("source"),
        size_of(F.col(text)).alias("size"),
        unit(F.col(key), F.col(source), F.col(text), seed).alias("u"),
        level.alias("level"),
    )
    limit = cuts.select(F.col("source").alias("__cm_t"), "last")
    out = _copies(rows, cuts, cap).join(limit, F.col("source").eqNullSafe(F.col("__cm_t")), "left")
    copies = F.col("whole") + F.when(F.col("rank") <= F.col("last"), 1).otherwise(0)
    out = out.withColumn("copies", copies)
    names = [F.col(f"__cm_{k}").alias(c) for k, c in enumerate(docs.columns) if c not in own]
    return out.select(*names, *own)


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every document as often as it is taken, with the columns of ``docs``."""
    used = {options.get(k, d) for k, d in (("key", "doc_id"), ("text", "text"), ("source", "source"))}
    tagged = docs.select(F.struct(*docs.columns).alias("__cm_row"), *[c for c in docs.columns if c in used])
    taken = mix(tagged, **options)
    each = taken.select("__cm_row", F.explode(F.array_repeat(F.lit(0), F.col("copies"))).alias("__cm_k"))
    return each.select("__cm_row.*")

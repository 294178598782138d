"""Written intermediate tables in the shared scratch folder (lineage cuts that survive a
lost executor) and connected components over link tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.session import scratch_dir


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under ``spark.checkpoint.dir`` and read it back."""
    path = scratch_dir(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(links: DataFrame, name: str = "components", rounds: int = 60) -> DataFrame:
    """``(node, root)``: the smallest node of each connected component of ``links(a, b)``.

    Alternating large-star / small-star rounds: every round joins the links with the
    minimum of each node's neighbourhood (a partial aggregate, so a hub costs one row per
    task) and is written to the shared folder.  Ends when a round changes nothing."""
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    edges = written(edges, f"{name}-0")
    state = None
    for k in range(1, rounds + 1):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        star = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = star.groupBy("u").agg(F.min("v").alias("m"))
        small = star.join(low, "u").select(
            F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")
        )
        edges = written(small.select("e.u", "e.v").filter("u <> v").distinct(), f"{name}-{k}")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == state:
            break
        state = tuple(now)
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)

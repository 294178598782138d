"""Registered queries: one per operator family, each paired with DuckDB oracle SQL.

Every query reads the driver's tables (whole tables, whole texts) or data Spark derives
from them.  Dirty inputs (CR/LF, tabs, control characters, blanks, CALL lines...) are
made inside the query, identically on both sides.  Integer outputs are cast to bigint
and doubles rounded on both sides so that value hashes are comparable.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.plans import duck

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; single-split files are spread over the cluster's task slots."""
    from corpusmill.sources.files import ensure_parallelism

    return ensure_parallelism(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))


def dirty(col: Column | str) -> Column:
    """Make clean text dirty (same as ``duck.dirty``)."""
    c = F.col(col) if isinstance(col, str) else col
    t = F.replace(c, F.lit(" "), F.lit(" \t "))
    t = F.replace(t, F.lit("."), F.lit(".\x01\x0b"))
    t = F.replace(t, F.lit("\n"), F.lit("\n \n \n"))
    return F.concat(F.lit("\r\n "), t, F.lit("\r\n\n\n\u00a0\u3000"))


def load_all() -> None:
    """Import every query module (each registers its queries on import)."""
    import corpusmill.plans.all  # noqa: F401

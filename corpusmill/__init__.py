"""corpusmill: Spark-native operators for building, mixing, scoring and auditing text corpora.

Every operator is DataFrame -> DataFrame (or returns a Column).  Heavy work stays in
Catalyst expressions, joins, windows and aggregates; Python runs only inside
Arrow-batched pandas UDFs where no native expression exists (calculator, pluggable
tokeniser/scorer, archive readers).
"""

from corpusmill.session import get_spark, scratch_dir

__all__ = ["get_spark", "scratch_dir"]

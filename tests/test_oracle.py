"""Every registered query against its DuckDB oracle SQL (sf0.001: whole tables, small)."""

import pytest

SMALL = "/root/testdata/sf0.001"

import __spark_entry__ as E  # noqa: E402
from tools.check_oracle import compare  # noqa: E402

NAMES = sorted(E.queries())


def test_every_query_is_named_consistently():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, name):
    res = compare(spark, SMALL, [name], verbose=False)[name]
    assert res[0] in ("MATCH", "ROWS_ONLY"), res


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["source", "records", "shards", "first_shard", "last_shard"]

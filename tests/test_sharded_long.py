"""Shards that span many chunks of positions."""

import random

import pytest

from corpusmill.operators.sharded_dedup import sharded_dedup


@pytest.mark.parametrize("n", [1, 3])
def test_long_stretch_of_copies(spark, n):
    rng = random.Random(n)
    keys = [rng.choice("abcdefg") for _ in range(40)] + [rng.choice(["x", None][: max(1, n - 1)]) for _ in range(90)]
    keys += [rng.choice("xyzuv") for _ in range(30)] + ["w"] * 25
    want, seen, shard = {}, set(), 0
    for p, k in enumerate(keys):
        if k not in seen and len(seen) == n:
            seen, shard = set(), shard + 1
        if k not in seen:
            seen.add(k)
            want[p] = shard
    df = spark.createDataFrame([("d", p, k) for p, k in enumerate(keys)], "ds string, pos long, key string")
    got = {r.pos: r.shard for r in sharded_dedup(df, "ds", "pos", "key", n, chunk=7).collect()}
    assert got == want

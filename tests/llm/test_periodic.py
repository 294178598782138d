"""Periodic runs against a search over every stretch and period."""

import hashlib
import random
import zlib

import brute as B
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Row

from corpusmill.llm import periodic, queries


def runs_of(words, min_words=24, copies=3):
    """(start, length, smallest period) of all runs, by start, then period."""
    n, out = len(words), {}
    for q in range(1, n // copies + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(min_words, copies * q):
                out.setdefault((i, j + q - i), q)  # q ascends: the first is the smallest
            i = j + 1
    return sorted(((s, length, q) for (s, length), q in out.items()), key=lambda r: (r[0], r[2]))


def test_cover_meets_every_pair():
    assert sorted((a - b) % periodic.CYCLE for a in periodic.COVER for b in periodic.COVER if a != b) == list(
        range(1, periodic.CYCLE)
    )


@given(st.lists(st.integers(0, 1), min_size=1, max_size=200), st.integers(1, 40), st.integers(1, 9))
@settings(max_examples=150, deadline=None)
def test_extensions(tail, period, times):
    ids = np.array([*range(period)] * times + tail + [10**6], np.int64)
    i = np.repeat(np.arange(len(ids)), 3)
    j = (i * 7 + np.tile([1, period, 13], len(ids))) % len(ids)
    ok = i != j
    i, j = i[ok], j[ok]
    want = []
    for a, b in zip(i, j):
        k = 0
        while max(a, b) + k < len(ids) and ids[a + k] == ids[b + k]:
            k += 1
        want.append(k)
    assert periodic.Extensions(ids).common(i, j).tolist() == want


@given(
    st.lists(
        st.tuples(st.integers(1, 30), st.integers(1, 5), st.integers(0, 3), st.integers(1, 3)), min_size=1, max_size=6
    ),
    st.integers(2, 30),
    st.integers(2, 4),
)
@settings(max_examples=150, deadline=None)
def test_runs(parts, min_words, copies):
    rng = random.Random(str(parts))
    texts = []
    for block, times, cut, letters in parts:
        base = [rng.randrange(letters) for _ in range(block)]
        texts.append(base * times + base[:cut] + [rng.randrange(letters + 1) for _ in range(cut * 5)] + base * times)
    texts.append([])
    bounds = np.cumsum([0] + [len(t) for t in texts])
    ids = np.array(sum(texts, []), np.int64)
    start, end, period = periodic.find_runs(ids, bounds, min_words, copies)
    got = {}
    for s, e, q in zip(start.tolist(), end.tolist(), period.tolist()):
        d = int(np.searchsorted(bounds, s, side="right")) - 1
        got.setdefault(d, []).append((s - int(bounds[d]), e - s, q))
    for d, t in enumerate(texts):
        assert got.get(d, []) == runs_of(t, min_words, copies)


def test_small_pieces_find_the_same(monkeypatch):
    ids = np.array([1, 2, 3] * 400 + list(range(50)) + [7] * 300, np.int64)
    bounds = np.array([0, len(ids)])
    whole = [x.tolist() for x in periodic.find_runs(ids, bounds)]
    monkeypatch.setattr(periodic, "PAIRS", 5)
    assert [x.tolist() for x in periodic.find_runs(ids, bounds)] == whole


def expected(doc_id, text):
    words = B.words(text)
    h = zlib.crc32(str(doc_id).encode() if doc_id is not None else b"")
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = runs_of(words)
    dropped = {k for s, length, q in runs for k in range(s + q, s + length)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    best = (None,) * 4
    if runs:
        top = [r for r in runs if all(r[1] * o[2] >= o[1] * r[2] for o in runs)]
        s, length, q = min(top, key=lambda r: (r[0], r[2]))
        best = (s, length, q, 1000 * length // q)
    kept = " ".join(w for k, w in enumerate(words) if k not in dropped)
    return (doc_id, len(runs), *best, sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)), sha(kept))


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_query_on_odd_rows(spark, odd, tmp_path):
    rows = [r for r in odd.collect() if r.text is None or len(r.text) < 10_000]
    rows += [Row(*odd.columns)(i, "ab cd ef " * (i % 7 * 5) + "x " * i, *rows[0][2:]) for i in range(100, 160)]
    spark.createDataFrame(rows, odd.schema).write.parquet(str(tmp_path / "documents.parquet"))
    got = [tuple(r) for r in queries.op12_periodic_runs(spark, str(tmp_path)).select(COLUMNS).collect()]
    order = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(got, key=order) == sorted((expected(r.doc_id, r.text) for r in rows), key=order)


def test_query_on_a_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    small = {k for k, t in docs.items() if len(t or "") < 12_000}
    got = {r.doc_id: tuple(r) for r in queries.op12_periodic_runs(spark, folder).select(COLUMNS).collect()}
    assert set(got) == set(docs) and len(small) > 100
    for k in small:
        assert got[k] == expected(k, docs[k])


def test_clashing_names_and_empty_table(spark, odd, empty):
    found = periodic.periodic_runs(odd, out="n_words")
    assert set(found.columns) == set(odd.columns) and found.count() == odd.count()
    assert periodic.periodic_runs(empty).count() == 0
    collapsed = periodic.collapse_runs(odd)
    assert collapsed.columns == odd.columns
    assert {r.text is None for r in collapsed.filter("doc_id = 4").collect()} == {True}
    assert [r.text for r in collapsed.filter("doc_id = 9").collect()] == ["same text of a few words"]


@pytest.mark.parametrize("sizes", [(10,), (1, 1, 1)])
def test_long_text_is_one_shard(sizes):
    text = " ".join(str(k % 700) for k in range(60_000))
    got = [periodic._shard(d, o, 24, 3) for _, _, d, o in periodic.W.shards(pa.array([text] * len(sizes)), 1000)]
    assert [x for part in got for x in part.field(1).to_pylist()] == [[{"start": 0, "length": 60_000, "period": 700}]] * len(sizes)

"""The Gibbs sampler of op10: every customer moves, seatings go on, contexts are whole words."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.llm import hpylm


def expected_tables(customers: int, weight: float, discount: float) -> float:
    """Mean number of tables: generalised Stirling numbers times powers of the weight."""
    row = np.zeros(customers + 2)
    row[1] = 1.0
    k = np.arange(customers + 2)
    for n in range(1, customers):
        row = np.append(0, row[:-1]) + np.maximum(n - discount * k, 0) * row
        row /= row.max()
    p = row * weight**k
    return float((k * p).sum() / p.sum())


@pytest.mark.parametrize("customers", [2, 3, 4, 9, 16, 60])
@pytest.mark.parametrize("weight", [0.02, 3.0])
def test_sweeps_reach_the_seatings_distribution(customers, weight):
    """Whatever the start (all alone or all together), as every customer moves."""
    for start in (np.ones(customers, np.int64), np.array([customers])):
        dishes = 400
        tables = hpylm.Tables.seated(np.full(dishes, len(start)), np.tile(start, dishes), np.random.default_rng(3))
        seen = []
        for k in range(300):
            assert tables.sweep(np.full(dishes, weight), 0.6) == customers * dishes
            assert (tables.c == customers).all()
            if k >= 200:
                seen.append(tables.t.mean())
        assert np.mean(seen) == pytest.approx(expected_tables(customers, weight, 0.6), rel=0.04)


def test_seating_goes_on():
    rng = np.random.default_rng(1)
    tables = hpylm.Tables(np.array([1, 7, 30, 900]), np.full(4, 2.0), rng)
    tables.sweep(np.full(4, 2.0), 0.5)
    t, sizes = tables.seats()
    again = hpylm.Tables.seated(t, sizes, rng)
    assert (again.c == tables.c).all() and (again.t == tables.t).all()
    assert [x.tolist() for x in again.seats()] == [t.tolist(), sizes.tolist()]


def test_contexts_are_whole_words(spark):
    """Words that end alike and the end of a text are told apart."""
    rows = [(k, "grandly red sadly blue" if k % 2 else "sadly blue grandly red") for k in range(40)]
    rows += [(100, "grandly red"), (101, "grandly blue"), (102, "sadly blue"), (103, "sadly red")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r.score for r in hpylm.score_texts(docs, F.col("doc_id") < 100).collect()}
    assert got[100] > got[101] + 1 and got[102] > got[103] + 1


def sequential_scores(learned: list[list[str]], asked: list[list[str]], discounts, sweeps: int, burn: int) -> list[float]:
    """A plain sampler: one customer after the other, totals always up to date."""
    rng = np.random.default_rng(0)
    d1, d2 = discounts
    s1, s2 = hpylm.STRENGTH
    pairs = [(u, w) for text in learned for u, w in zip([None, *text], [*text, ""])]
    base = 1.0 / (len({w for _, w in pairs}) + 1)
    leaf: dict = {}
    root: dict = {}
    count = lambda r: (sum(map(sum, r.values())), sum(map(len, r.values())))

    def p_root(w):
        c, t = count(root)
        mine = root.get(w, [])
        return (sum(mine) - d1 * len(mine) + (s1 + d1 * t) * base) / (s1 + c)

    def p_leaf(u, w):
        c, t = count(leaf.get(u, {}))
        mine = leaf.get(u, {}).get(w, [])
        return (sum(mine) - d2 * len(mine) + (s2 + d2 * t) * p_root(w)) / (s2 + c)

    def sit(tables, new, d):
        weights = np.array([x - d for x in tables] + [new])
        k = rng.choice(len(weights), p=weights / weights.sum())
        if k == len(tables):
            tables.append(1)
            return True
        tables[k] += 1
        return False

    def go(tables):
        k = rng.choice(len(tables), p=np.array(tables) / sum(tables))
        tables[k] -= 1
        if not tables[k]:
            del tables[k]
            return True
        return False

    def add(u, w):
        dishes = leaf.setdefault(u, {})
        if sit(dishes.setdefault(w, []), (s2 + d2 * count(dishes)[1]) * p_root(w), d2):
            sit(root.setdefault(w, []), (s1 + d1 * count(root)[1]) * base, d1)

    for u, w in pairs:
        add(u, w)
    total = np.zeros(len(asked))
    logs = {}
    for k in range(sweeps):
        for u, w in pairs:
            if go(leaf[u][w]):
                go(root[w])
            add(u, w)
        if k >= burn:
            for text in asked:
                for u, w in zip([None, *text], [*text, ""]):
                    logs.setdefault((u, w), []).append(p_leaf(u, w))
    for j, text in enumerate(asked):
        total[j] = sum(np.log10(np.mean(logs[x])) for x in zip([None, *text], [*text, ""]))
    return total.tolist()


def test_scores_are_those_of_a_sequential_sampler(spark):
    rng = np.random.default_rng(5)
    words = np.array([f"w{k}" for k in range(12)])
    chain = rng.dirichlet(np.full(12, 0.3), 12)
    texts = []
    for _ in range(40):
        at = [int(rng.integers(12))]
        for _ in range(int(rng.integers(2, 9))):
            at.append(int(rng.choice(12, p=chain[at[-1]])))
        texts.append(words[at].tolist())
    texts[3] = ["never", "w1"]
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id bigint, text string")
    got = {r.doc_id: r.score for r in hpylm.score_texts(docs, F.col("doc_id") >= 8).collect()}
    pairs: dict = {}
    for t in texts[8:]:
        for p in zip([None, *t], [*t, ""]):
            pairs[p] = pairs.get(p, 0) + 1
    served: dict = {}
    for _, w in pairs:
        served[w] = served.get(w, 0) + 1
    of = lambda x: hpylm._discount(sum(v == 1 for v in x.values()), sum(v == 2 for v in x.values()))
    want = sequential_scores(texts[8:], texts, (of(served), of(pairs)), 60, 20)
    words_of = sum(len(t) + 1 for t in texts)
    assert sum(got.values()) / words_of == pytest.approx(sum(want) / words_of, abs=0.02)
    for k, t in enumerate(texts):
        assert got[k] / (len(t) + 1) == pytest.approx(want[k] / (len(t) + 1), abs=0.12)

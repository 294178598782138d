"""Conversation repair against an exhaustive search over all edit words."""

import hashlib
import random
import re
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from corpusmill.llm import conversations, queries

SCHEMA = "conv_id bigint, turn bigint, role string, text string, pos string, key string"


def brute(rows):
    """(cost, audit, repaired rows) of rows ``(role, text, must_delete, truncated)``."""

    @lru_cache(None)
    def best(i, state):
        out = []
        if i == len(rows) and state in (0, 3):
            out.append((0, "", ()))
        said = "assistant" if state == 2 else "user"
        after = 3 if state == 2 else 2
        if depth[0] < 3:  # no cheapest way has more inserts in a row
            depth[0] += 1
            c, a, r = best.__wrapped__(i, after)
            depth[0] -= 1
            out.append((c + 3, "I" + a, ((said, ""), *r)))
        if i < len(rows):
            role, text, gone, cut = rows[i]
            keep = depth[0]
            depth[0] = 0
            c, a, r = best(i + 1, state)
            out.append((c + 4, "D" + a, r))
            if not gone:
                extra = 3 if cut else 0
                c, a, r = best(i + 1, after)
                out.append((c + 3 + extra, "R" + a, ((said, text), *r)))
                if role[:1] == said[0]:
                    out.append((c + extra, "K" + a, ((role, text), *r)))
                if role[:1] == "s" and state == 0:
                    c, a, r = best(i + 1, 1)
                    out.append((c + extra, "K" + a, ((role, text), *r)))
            depth[0] = keep
        return min(out) if out else (10**9, "", ())

    depth = [0]
    return best(0, 0)


def expected(rows):
    """Contract's columns of one conversation's rows (turn, role, text)."""
    none = lambda v: " " if v is None else v
    rows = [(t, none(r), none(x)) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256(f"{len(r[1])}:{r[1]}:{r[2]}".encode()).hexdigest()))
    seen, coded, faults = set(), [], [0, 0, 0]
    for _, role, text in rows:
        chars = re.findall(r"[^\x20\x09-\x0D]", text)
        kind = 0 if not chars else 1 if (role, text) in seen else 2 if chars[-1] not in ".!?" else 3
        seen.add((role, text))
        if kind < 3:
            faults[kind] += 1
        coded.append((role, text, kind < 2, kind == 2))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(coded, coded[1:]))
    cost, audit, fixed = brute(tuple(coded))
    sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest()
    return (gaps, *faults, illegal, cost, audit, sha), fixed


def conversations_of(seed, sizes):
    rng = random.Random(seed)
    out = []
    for conv, size in enumerate(sizes):
        for k in range(size):
            role = rng.choice(["user", "assistant", "system", "user", "assistant", "tool", "", None])
            text = rng.choice(["a.", "b", "é!", "", " \n\t", None, f"long {'x ' * 50}{k}?", f"t{k}", "a."])
            out.append((conv, rng.choice([None, k, k, k // 2, k + 2]), role, text, "clash", None))
    return out


@pytest.mark.parametrize("block", [2, 3, 1024])
def test_repair_equals_search(spark, block):
    rows = conversations_of(block, [1, 2, 3, 4, 5, 6, 7, 1, 2, 3, 5, 8, 9, 14, 23])
    rows = [(None if r[0] == 4 else r[0], *r[1:]) for r in rows]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    repair = conversations.repair_conversations(df, block=block)
    report = {r.conv_id: r for r in repair.report.collect()}
    digests = {r.key: r.repaired_sha256 for r in repair.digests().collect()}
    fixed = {}
    for r in repair.rows().collect():
        fixed.setdefault(r.key, []).append((r.pos, r.sub, r.role, r.text))
    assert set(report) == {r[0] for r in rows}
    for conv, got in report.items():
        want, told = expected([r[1:4] for r in rows if r[0] == conv])
        assert (got.gaps, got.blank, got.duplicate, got.truncated, got.illegal, got.cost, got.audit, digests[conv]) == want
        assert [r[2:] for r in sorted(fixed.get(conv, []))] == [tuple(r) for r in told]


def test_linear_space_solution_equals_whole_table():
    rng = random.Random(5)
    for _ in range(300):
        codes = [rng.randrange(12) for _ in range(rng.randrange(1, 40))]
        items = conversations._row_items(codes)
        last = conversations._end(items)
        cost, _ = conversations.forward(items, 0)
        _, words, total, audit, tail = conversations._solved_rows(codes, 0, last, True)
        assert total == min(c + 3 * len(t) for c, t in zip(cost, conversations.TAIL))
        names = ["s", "u", "a", "x"]
        rows = tuple((names[c // 3], f"{k}", c % 3 == 2, c % 3 == 1) for k, c in enumerate(codes))
        assert (total, audit) == brute(rows)[:2]


def test_empty_table(spark):
    repair = conversations.repair_conversations(spark.createDataFrame([], SCHEMA))
    assert repair.report.count() == repair.rows().count() == repair.digests().count() == 0


def test_damage_keeps_all_conversations(spark, tmp_path):
    rows = [(k, t, "user", f"text {t}.", None, None) for k in range(300) for t in range(k % 3)]
    rows += [(None, None, None, None, None, None)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "conversations.parquet"))
    got = queries.op11_conversation_repair(spark, str(tmp_path))
    assert got.count() == 201
    lost = [r for r in got.collect() if r.audit == "" and r.cost == 0]
    blank = hashlib.sha256(b"").hexdigest()
    assert lost and all(r.repaired_sha256 == blank and r.gaps == 0 for r in lost)
    assert got.filter(F.col("repaired_sha256").isNull()).count() == 0

"""Conversation structure repair: the cheapest edits that give every conversation the roles
``(system? (user assistant)+)?``, found by Hirschberg's divide and conquer.

A conversation is read row by row by four states (nothing yet, after system, after user,
after assistant).  Reading a row from one state to another has a least cost and, among the
cheapest ways, an ASCII-least word of edit initials: D(elete), I(nsert) before the row,
K(eep), R(erole).  Inserts go before the row they precede; those after the last row end the
conversation.  So every word of a row ends in the letter of that row, no audit of some rows
is a proper prefix of another audit of the same rows, and audits compare piece by piece.

``solve`` meets in the middle: forward costs (with the order of the four least audits) from
the known first state, backward costs from the known last state, the cheapest crossing
state, the audit-least one among equals, then both halves.  It keeps two vectors of four
values per half, so its space is linear in the rows.

Rows of a conversation are numbered without a window over the conversation and cut into
blocks of ``BLOCK`` rows.  A block is summed up by its 4 x 4 costs and audit orders, BLOCK
blocks make a block of the next level, and so on: the levels are solved from the top down,
every block between known states, so that a conversation of any length is many tasks.

Defined results: a null role or text is one space; rows of one turn follow each other by the
SHA-256 of ``length of role:role:text``; repeated rows are duplicates; a null key is a key of its
own; an empty table gives no rows; columns other than the four are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corpusmill.llm.tables import written
from corpusmill.operators.ordinals import null_safe_join, with_ordinal

BLOCK = 1024
ORDINAL_ROWS = 1 << 16  # rows per range in which rows are numbered
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
START, SYSTEM, USER, ASSISTANT = range(4)
FAR = 1 << 50
#: What is inserted in each state, and the state after it.
_INSERTED = {START: (USER, "user"), SYSTEM: (USER, "user"), USER: (ASSISTANT, "assistant"), ASSISTANT: (USER, "user")}
#: Inserts that end a conversation from each state.
TAIL = ("", "II", "I", "")
#: Codes of rows: initial (s, u, a, other) * 3 + (sound, truncated, to be deleted); + HALO for
#: the first row of the next block, which only counts for adjacent roles.
INITIALS = ("s", "u", "a")
HALO = 100
_LEGAL = {(0, 1), (1, 2), (2, 1)}
_NOT_BLANK = r"[^\x20\x09-\x0D]"


def _row_item(code: int) -> tuple[tuple, dict]:
    """Transitions of a row: per state a tuple of (next state, cost, audit order), and the
    words by (state, next state)."""
    initial, kind = divmod(code, 3)
    item, words = [], {}
    for first in range(4):
        best: dict[int, tuple[int, str]] = {}
        for inserts in ("", "I", "II"):
            state = first
            for _ in inserts:
                state = _INSERTED[state][0]
            ways = [(state, DELETE, "D")]
            if kind != 2:
                extra = TRUNCATED if kind == 1 else 0
                if initial == 0 and state == START:
                    ways.append((SYSTEM, KEEP + extra, "K"))
                after = _INSERTED[state][0]
                if initial == after - 1:
                    ways.append((after, KEEP + extra, "K"))
                ways.append((after, REROLE + extra, "R"))
            for after, cost, letter in ways:
                way = (cost + INSERT * len(inserts), inserts + letter)
                best[after] = min(best.get(after, way), way)
        order = sorted((word, after) for after, (_, word) in best.items())
        item.append(tuple((after, best[after][0], k) for k, (_, after) in enumerate(order)))
        words.update({(first, after): word for after, (_, word) in best.items()})
    return tuple(item), words


_ROWS = [_row_item(code) for code in range(12)]


def forward(items: list, first: int) -> tuple[list[int], list[int]]:
    """Costs of the four states after ``items``, and the order of their least audits."""
    cost, rank = [FAR] * 4, [0] * 4
    cost[first] = 0
    for item in items:
        best: list = [None] * 4
        for s in range(4):
            if cost[s] < FAR:
                for t, c, k in item[s]:
                    way = (cost[s] + c, rank[s], k)
                    if best[t] is None or way < best[t]:
                        best[t] = way
        cost = [FAR if b is None else b[0] for b in best]
        for r, (_, t) in enumerate(sorted((b[1:], t) for t, b in enumerate(best) if b is not None)):
            rank[t] = r
    return cost, rank


def backward(items: list, last: list[int]) -> list[int]:
    """Costs of ``items`` from each of the four states, ``last`` after them."""
    for item in reversed(items):
        last = [min((c + last[t] for t, c, _ in way), default=FAR) for way in item]
    return last


def solve(items: list, first: int, last: int) -> list[int]:
    """The states after every item on the cheapest, audit-least way from ``first`` to ``last``."""
    out = [last] * len(items)
    open_parts = [(0, len(items), first, last)]
    while open_parts:
        lo, hi, s, t = open_parts.pop()
        if hi - lo < 2:
            continue
        mid = (lo + hi) // 2
        cost, rank = forward(items[lo:mid], s)
        rest = backward(items[mid:hi], [0 if x == t else FAR for x in range(4)])
        cross = min(range(4), key=lambda x: (cost[x] + rest[x], rank[x]))
        out[mid - 1] = cross
        open_parts += [(lo, mid, s, cross), (mid, hi, cross, t)]
    return out


def _end(items: list) -> int:
    """The state in which the cheapest, audit-least way through a whole conversation ends.
    The inserts at the end follow different audits, so the order of these decides."""
    cost, rank = forward(items, START)
    return min(range(4), key=lambda t: (cost[t] + INSERT * len(TAIL[t]), rank[t]))


def summary(items: list) -> list[int]:
    """A block as an item: 16 costs and 16 audit orders, from every state to every state."""
    costs, ranks = [], []
    for s in range(4):
        cost, rank = forward(items, s)
        costs, ranks = costs + cost, ranks + rank
    return costs + ranks


def _summary_item(flat: list[int]) -> tuple:
    return tuple(
        tuple((t, flat[4 * s + t], flat[16 + 4 * s + t]) for t in range(4) if flat[4 * s + t] < FAR) for s in range(4)
    )


def _mapped(df: DataFrame, fn, extra: str) -> DataFrame:
    """``fn(row dict) -> tuple`` per row in Arrow batches; ``extra`` are its columns."""
    kept = [c for c in ("key", "block") if c in df.columns]
    schema = StructType([df.schema[c] for c in kept] + list(StructType.fromDDL(extra).fields))
    names = schema.fieldNames()[len(kept) :]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in batches:
            out = [fn(row) for row in batch.drop_columns(kept).to_pylist()]
            columns = [batch.column(c).cast(arrow.field(c).type) for c in kept]
            columns += [pa.array([r[k] for r in out], arrow.field(c).type) for k, c in enumerate(names)]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return df.mapInArrow(run, schema)


def numbered_rows(rows: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    """``(key, turn, role, text, digest, pos)``: rows in order, a written table."""
    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    base = rows.select(
        F.col(key).alias("key"),
        F.col(turn).alias("turn"),
        filled(role).alias("role"),
        filled(text).alias("text"),
        F.sha2(F.concat(F.length(filled(role)), F.lit(":"), filled(role), F.lit(":"), filled(text)), 256).alias("digest"),
    )
    buckets = max(2, rows.count() // ORDINAL_ROWS)
    return written(with_ordinal(base, ["turn", "digest"], "key", "pos", partitions=buckets), "turns")


def coded_rows(numbered: DataFrame) -> DataFrame:
    """``(key, pos, blank, duplicate, truncated, code)``: the first fault of every row."""
    first = numbered.groupBy("key", "digest").agg(F.min("pos").alias("pos"))
    first = first.select("key", "pos", F.lit(True).alias("first"))
    initial = F.substring("role", 1, 1)
    mark = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    rows = numbered.select(
        "key",
        "pos",
        F.coalesce(*[F.when(initial == c, F.lit(k)) for k, c in enumerate(INITIALS)], F.lit(3)).alias("initial"),
        (~F.col("text").rlike(_NOT_BLANK)).alias("blank"),
        (~mark.isin(".", "!", "?")).alias("open"),
    )
    rows = null_safe_join(rows, first, ["key", "pos"], "left")
    duplicate = ~F.col("blank") & F.col("first").isNull()
    truncated = ~F.col("blank") & ~duplicate & F.col("open")
    kind = F.when(F.col("blank") | duplicate, 2).when(truncated, 1).otherwise(0)
    return rows.select(
        "key",
        "pos",
        F.col("blank").cast("bigint").alias("blank"),
        duplicate.cast("bigint").alias("duplicate"),
        truncated.cast("bigint").alias("truncated"),
        (F.col("initial") * 3 + kind).alias("code"),
    )


def blocks_of(coded: DataFrame, block: int) -> DataFrame:
    """``(key, block, codes, blank, duplicate, truncated, illegal)``, a written table."""
    place = F.col("pos")
    own = F.struct(F.floor(place / block).cast("bigint").alias("block"), F.col("code").alias("code"))
    halo = F.struct((own["block"] - 1).alias("block"), (F.col("code") + HALO).alias("code"))
    both = F.when((place > 0) & (place % block == 0), F.array(own, halo)).otherwise(F.array(own))
    rows = coded.withColumn("at", F.explode(both))
    own_row = F.when(F.col("at.code") < HALO, F.lit(1)).otherwise(0)
    grouped = rows.groupBy("key", F.col("at.block").alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "at.code")))["code"].alias("codes"),
        *[F.sum(F.col(c) * own_row).alias(c) for c in ("blank", "duplicate", "truncated")],
    )
    pairs = F.arrays_zip(
        F.slice("codes", 1, F.size("codes") - 1).alias("a"), F.slice("codes", 2, F.size("codes") - 1).alias("b")
    )
    role = lambda c: F.floor(F.pmod(c, F.lit(HALO)) / 3)
    legal = lambda p: (role(p["a"]) * 4 + role(p["b"])).isin(*[4 * a + b for a, b in sorted(_LEGAL)])
    return written(
        grouped.withColumn("illegal", F.size(F.filter(pairs, lambda p: ~legal(p))).cast("bigint")).withColumn(
            "codes", F.filter("codes", lambda c: c < HALO)
        ),
        "turn-blocks",
    )


def _row_items(codes: list[int]) -> list:
    return [_ROWS[c][0] for c in codes]


def _solved_rows(codes: list[int], first: int, last: int, ends: bool) -> tuple:
    """Per row the state before it and its word; then cost, audit and inserts at the end."""
    after = solve(_row_items(codes), first, last)
    before = [first, *after[:-1]]
    words = [_ROWS[c][1][s, t] for c, s, t in zip(codes, before, after)]
    cost = sum(next(w[1] for w in _ROWS[c][0][s] if w[0] == t) for c, s, t in zip(codes, before, after))
    tail = TAIL[last] if ends else ""
    return before, words, cost + INSERT * len(tail), "".join(words) + tail, tail


_SOLVED = "before array<int>, words array<string>, cost bigint, audit string, tail string"


def solved_blocks(blocks: DataFrame, count: int, block: int) -> DataFrame:
    """``(key, block, before, words, cost, audit, tail)``; ``count`` is the largest number of
    blocks of a conversation."""
    if count <= 1:
        return _mapped(
            blocks.select("key", "block", "codes"),
            lambda r: _solved_rows(r["codes"], START, _end(_row_items(r["codes"])), True),
            _SOLVED,
        )
    packs: list[DataFrame] = []
    level = _mapped(blocks.select("key", "block", "codes"), lambda r: (summary(_row_items(r["codes"])),), "flat array<bigint>")
    level = written(level, "turn-level-0")
    while True:
        packed = level.groupBy("key", F.floor(F.col("block") / block).cast("bigint").alias("parent")).agg(
            F.array_sort(F.collect_list(F.struct("block", "flat")))["flat"].alias("flats")
        )
        packs.append(written(packed.withColumnRenamed("parent", "block"), f"turn-pack-{len(packs)}"))
        count = -(-count // block)
        if count <= 1:
            break
        level = _mapped(packs[-1], lambda r: (summary([_summary_item(f) for f in r["flats"]]),), "flat array<bigint>")
        level = written(level, f"turn-level-{len(packs)}")

    down = None
    for packed in reversed(packs):
        if down is not None:
            packed = null_safe_join(packed, down, ["key", "block"])
        steps = _mapped(packed, _steps_down, "steps array<struct<first: int, last: int, ends: boolean>>")
        steps = steps.select("key", (F.col("block") * block).alias("from"), F.posexplode("steps").alias("k", "step"))
        down = written(steps.select("key", (F.col("from") + F.col("k")).alias("block"), "step.*"), "turn-down")
    return _mapped(
        null_safe_join(blocks.select("key", "block", "codes"), down, ["key", "block"]),
        lambda r: _solved_rows(r["codes"], r["first"], r["last"], r["ends"]),
        _SOLVED,
    )


def _steps_down(row: dict) -> tuple:
    """The states before and after every block of ``row``; the top row has none of its own."""
    items = [_summary_item(f) for f in row["flats"]]
    top = "first" not in row
    first, last = (START, _end(items)) if top else (row["first"], row["last"])
    after = solve(items, first, last)
    ends = top or row["ends"]
    before = [first, *after[:-1]]
    return ([{"first": s, "last": t, "ends": ends and k == len(items) - 1} for k, (s, t) in enumerate(zip(before, after))],)


class Repair:
    """A repair: ``report`` (a row per conversation with rows: gaps, blank, duplicate,
    truncated, illegal, cost, audit), ``rows()`` and ``digests()``."""

    def __init__(self, numbered: DataFrame, solved: DataFrame, report: DataFrame, block: int):
        self.numbered, self.solved, self.report, self.block = numbered, solved, report, block

    def _edits(self) -> DataFrame:
        base = F.col("block") * self.block
        word = F.arrays_zip("before", "words")
        rows = self.solved.select("key", "block", base.alias("base"), F.posexplode(word).alias("k", "w")).select(
            "key", "block", (F.col("base") + F.col("k")).alias("pos"), F.col("w.words").alias("word"), F.col("w.before").alias("state")
        )
        last = self.solved.filter("tail <> ''").select(
            "key",
            "block",
            (base + F.size("words")).alias("pos"),
            F.col("tail").alias("word"),
            F.when(F.length("tail") == 2, SYSTEM).otherwise(USER).alias("state"),
        )
        return rows.unionByName(last)

    def _merged(self, by: list[str]) -> DataFrame:
        """Edits and rows of the same place side by side, in order within partitions."""
        edits = self._edits().select("key", "block", "pos", F.lit(0).alias("kind"), "word", "state")
        texts = self.numbered.select(
            "key", F.floor(F.col("pos") / self.block).cast("bigint").alias("block"), "pos", F.lit(1).alias("kind"), "role", "text"
        )
        both = edits.unionByName(texts, allowMissingColumns=True)
        return both.repartition(*by).sortWithinPartitions("key", "pos", "kind")

    def rows(self) -> DataFrame:
        """``(key, pos, sub, role, text, edit)``: the repaired conversations; ``pos`` is the
        place of the row (an insert: of the row after it) and ``sub`` orders what shares it."""
        merged = self._merged(["key", "block"])
        schema = StructType([merged.schema["key"], *StructType.fromDDL("pos bigint, sub int, role string, text string, edit string").fields])

        def run(batches):
            from pyspark.sql.pandas.types import to_arrow_schema

            arrow = to_arrow_schema(schema)
            for out in _repaired(batches):
                if out:
                    yield pa.RecordBatch.from_pylist([dict(zip(arrow.names, r)) for r in out], arrow)

        return merged.mapInArrow(run, schema)

    def digests(self) -> DataFrame:
        """``(key, repaired_sha256)``: lowercase hex of the repaired ``role:text`` rows joined
        by newlines.  Rows stream past in order, a digest needs no conversation in memory."""
        merged = self._merged(["key"])
        schema = StructType([merged.schema["key"], *StructType.fromDDL("repaired_sha256 string").fields])

        def run(batches):
            from pyspark.sql.pandas.types import to_arrow_schema

            arrow = to_arrow_schema(schema)
            now, digest, any_row, done = None, None, False, []
            for out in _repaired(batches, marks=True):
                for key, _, _, role, text, edit in out:
                    if digest is None or key != now:
                        if digest is not None:
                            done.append({"key": now, "repaired_sha256": digest.hexdigest()})
                        now, digest, any_row = key, hashlib.sha256(), False
                    if edit != "D":
                        digest.update(f"{chr(10) if any_row else ''}{role}:{text}".encode())
                        any_row = True
                if done:
                    yield pa.RecordBatch.from_pylist(done, arrow)
                    done = []
            if digest is not None:
                yield pa.RecordBatch.from_pylist([{"key": now, "repaired_sha256": digest.hexdigest()}], arrow)

        return merged.mapInArrow(run, schema)


def _repaired(batches: Iterator[pa.RecordBatch], marks: bool = False) -> Iterator[list[tuple]]:
    """Rows after their edits, from the sorted union of both; ``marks``: deleted rows too."""
    word, state = "", START
    for batch in batches:
        out = []
        columns = [batch.column(c).to_pylist() for c in ("key", "pos", "kind", "word", "state", "role", "text")]
        for key, pos, kind, edit, before, role, text in zip(*columns):
            if kind == 0:
                word, state = edit, before
                inserts = len(word) - len(word.lstrip("I"))
                for sub in range(inserts):
                    state, name = _INSERTED[state]
                    out.append((key, pos, sub, name, "", "I"))
                continue
            letter = word[-1]
            if letter == "R":
                role = _INSERTED[state][1]
            if letter != "D" or marks:
                out.append((key, pos, len(word) - 1, role, text, letter))
        yield out


def repair_conversations(
    rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", block: int = BLOCK
) -> Repair:
    """Repair every conversation of ``rows`` (see the module's docstring)."""
    numbered = numbered_rows(rows, key, turn, role, text)
    top = numbered.agg(F.max("pos")).first()[0]
    blocks = blocks_of(coded_rows(numbered), block)
    solved = written(solved_blocks(blocks, 0 if top is None else top // block + 1, block), "turn-edits")
    turns = numbered.groupBy("key", "turn").agg(F.lit(1).alias("one")).groupBy("key").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("bigint").alias("gaps")
    )
    faults = blocks.groupBy("key").agg(*[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")])
    audits = solved.groupBy("key").agg(
        F.sum("cost").alias("cost"),
        F.concat_ws("", F.array_sort(F.collect_list(F.struct("block", "audit")))["audit"]).alias("audit"),
    )
    report = null_safe_join(null_safe_join(turns, faults, ["key"]), audits, ["key"]).withColumnRenamed("key", key)
    return Repair(numbered, solved, report, block)

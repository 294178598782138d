"""Language-model scoring with a hierarchical Pitman-Yor model.

A text is its words, then one end token.  Every context (the preceding word; one more for the
start of a text) is a Chinese restaurant of words; all context restaurants share one parent, the
restaurant of single words, whose base is uniform over the known words and one unknown.  A
customer of a context that opens a table is a customer of the parent:

    p(w)     = (c_w  - d1 t_w  + (s1 + d1 T)   / (V + 1)) / (s1 + C)
    p(w | u) = (c_uw - d2 t_uw + (s2 + d2 T_u) * p(w))    / (s2 + C_u)

Seatings are sampled by Gibbs: a sweep makes as many moves as a dish has customers, in ``LANES``
turns.  In a move a random customer leaves the table and is seated again (tables in proportion
to size less discount, a new one in proportion to its parent's probability).  All of a dish's two or three customers move together,
by the distribution of their seating.  A dish of more than ``LANES`` customers moves a
``LANES``-th of them in a turn: they are drawn without replacement and see the tables of those
who stay.  The seating is kept between rounds; only
the first starts from the expected one.  Probabilities are averaged over the sampled seatings.
The discounts are estimated from the counts of counts of the whole corpus.

Distribution: given the restaurants' totals the seatings of different words are independent, so
words are dealt into cells by hash; each cell samples its words alone, and between ``ROUNDS`` the
cells add up the customers and tables of every context, by a shuffle on the context (a 48-bit
hash of the word; nothing of a context or word reaches the driver, only sums over the corpus).  Texts are
packed into blocks; a block asks each cell once for its distinct (context, word) pairs, with
their training counts, and gets the probabilities back in the same order.  So what is shuffled
are distinct pairs per block, whatever the number of copies, and every token counts: no
vocabulary cut-off, no cap.  Cells and blocks are bounded; their number grows with the input.

Defined cases: a null text is an empty one (just the end token); without training rows
every probability is that of the base; an unknown word has the parent's probability of the
unknown; repeated rows are scored alike; empty tables give empty results; only the key and
text columns are read, so other names cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from corpusmill.llm import exchange
from corpusmill.llm import words as W
from corpusmill.llm.exchange import part_count
from corpusmill.llm.tables import written

BLOCK_BYTES = 8 << 20
CONTEXTS = 255  # a part of the contexts' exchange has at least so many
STRENGTH = (1.0, 1.0)
ROUNDS = 2
BURN_IN = 3
SAMPLES = 4
LANES = 16  # turns of a sweep; a dish of more customers moves several in a turn
SEED = 10
_END = b"\n"  # no word contains it


def pack(values: np.ndarray) -> bytes:
    """The first bytes of all numbers, then the second ones and so on, compressed."""
    return exchange.pack(np.ascontiguousarray(values).reshape(-1).view(np.uint8).reshape(-1, values.itemsize).T)


def unpack(raw, kind) -> np.ndarray:
    planes = exchange.unpack(raw, np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def pack_steps(values: np.ndarray) -> bytes:
    """Numbers that mostly rise a little, as differences."""
    return pack(np.diff(values.astype(np.int64), prepend=0).astype(np.int32))


def unpack_steps(raw) -> np.ndarray:
    return np.cumsum(unpack(raw, np.int32), dtype=np.int64)


# -- seating -----------------------------------------------------------------------------


class Tables:
    """Customers of many dishes at tables: for each dish the sizes of its tables."""

    def __init__(self, customers: np.ndarray, new_table: np.ndarray, rng: np.random.Generator, discount: float = 1.0):
        """Start near the expected number of tables for the weight of a new one: however many
        the customers, all but ``new_table / discount`` tables end up as one."""
        self.rng = rng
        self.c = customers.astype(np.int64).copy()
        c = np.maximum(self.c, 1)
        tables = np.minimum(new_table * np.log1p(c / np.maximum(new_table, 1e-12)), 1 + new_table / discount)
        self.t = np.clip(np.rint(tables), 1, c).astype(np.int64)
        self.t[self.c == 0] = 0
        self._lay_out(self.t + 4)
        # a large first table, the rest in decreasing sizes
        place = np.arange(len(self.size)) - np.repeat(self.base[:-1], np.diff(self.base))
        tables, total = np.repeat(self.t, np.diff(self.base)), np.repeat(self.c, np.diff(self.base))
        share = np.where(place < tables, 1 + np.floor((total - tables) / (2.0 * (place + 1) * np.log1p(tables + 1))), 0)
        self.size = share.astype(np.int64)
        rest = self.c - np.add.reduceat(self.size, self.base[:-1]) if len(self.c) else self.c
        self.size[self.base[:-1]] += rest
        if (self.size < 0).any():
            raise AssertionError("table sizes")

    @classmethod
    def seated(cls, tables: np.ndarray, sizes: np.ndarray, rng: np.random.Generator) -> Tables:
        """The seating that ``seats`` gave."""
        self = cls.__new__(cls)
        self.rng, self.t = rng, tables.astype(np.int64)
        self._lay_out(self.t + 4)
        owner = np.repeat(np.arange(len(self.t)), self.t)
        inner = np.arange(len(owner)) - np.repeat(np.cumsum(self.t) - self.t, self.t)
        self.size[self.base[:-1][owner] + inner] = sizes
        self.c = np.bincount(owner, sizes, minlength=len(self.t)).astype(np.int64)
        return self

    def seats(self) -> tuple[np.ndarray, np.ndarray]:
        """Tables per dish, and the sizes of all tables, dish by dish."""
        return self.t.copy(), self.size[self.size > 0]

    def _lay_out(self, room: np.ndarray) -> None:
        self.base = np.zeros(len(room) + 1, np.int64)
        np.cumsum(room, out=self.base[1:])
        self.used = self.t.copy()
        self.size = np.zeros(self.base[-1], np.int64)

    def _make_room(self, dish: np.ndarray, tables: np.ndarray) -> None:
        """Close gaps and give every dish free places again."""
        old_size, owner = self.size, np.repeat(np.arange(len(self.c)), np.diff(self.base))
        live = old_size > 0
        free = np.where(self.c < 4, 4, np.maximum(12, self.t))
        free[dish] = np.maximum(free[dish], tables)
        self._lay_out(self.t + free)
        owner = owner[live]
        inner = np.arange(len(owner)) - np.repeat(np.cumsum(self.t) - self.t, self.t)
        self.size[self.base[:-1][owner] + inner] = old_size[live]

    def _places(self, dish: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of the dishes, their sizes added up, and the sum before each dish."""
        n = self.used[dish]
        first = np.cumsum(n) - n
        at = np.repeat(self.base[:-1][dish] - first, n) + np.arange(int(n.sum()))
        size = self.size[at]
        upto = np.cumsum(size)
        return at, upto, upto[first] - size[first]

    def _table(self, dish: np.ndarray) -> np.ndarray:
        """A random table of each dish in proportion to its size."""
        at, upto, before = self._places(dish)
        ticket = before + np.floor(self.rng.random(len(dish)) * self.c[dish]).astype(np.int64)
        return at[np.searchsorted(upto, ticket, side="right")]

    def leave(self, dish: np.ndarray) -> None:
        """One random customer of each of the dishes goes."""
        at = self._table(dish)
        self.size[at] -= 1
        self.c[dish] -= 1
        self.t[dish] -= self.size[at] == 0

    def _open(self, dish: np.ndarray, tables: np.ndarray) -> None:
        """New tables of one customer for each of the dishes."""
        if (self.used[dish] + tables > np.diff(self.base)[dish]).any():
            self._make_room(dish, tables)
        inner = np.arange(int(tables.sum())) - np.repeat(np.cumsum(tables) - tables, tables)
        self.size[np.repeat(self.base[:-1][dish] + self.used[dish], tables) + inner] = 1
        self.used[dish] += tables
        self.t[dish] += tables

    def enter(self, dish: np.ndarray, new_table: np.ndarray, discount: float) -> None:
        """One customer for each of the dishes sits down."""
        old = self.c[dish] - discount * self.t[dish]
        opens = self.rng.random(len(dish)) * (new_table + old) < new_table
        opens |= self.c[dish] == 0
        first = dish[opens]
        if len(first):
            self._open(first, np.ones(len(first), np.int64))
        joins = dish[~opens]
        while len(joins):  # in proportion to size - discount, by rejection
            at = self._table(joins)
            ok = self.rng.random(len(joins)) * self.size[at] < self.size[at] - discount
            self.size[at[ok]] += 1
            joins = joins[~ok]
        self.c[dish] += 1

    def move(self, dish: np.ndarray, customers: np.ndarray, new_table: np.ndarray, discount: float) -> None:
        """So many customers of each of the dishes, one of each equal stretch of them, leave
        and sit down again; each sees the tables of those who stayed."""
        at, upto, before = self._places(dish)
        who = np.repeat(np.arange(len(dish)), customers)
        turn = np.arange(len(who)) - np.repeat(np.cumsum(customers) - customers, customers)
        total, moved = self.c[dish][who], customers[who]
        low, high = turn * total // moved, (turn + 1) * total // moved
        ticket = before[who] + low + np.floor(self.rng.random(len(who)) * (high - low)).astype(np.int64)
        self.size[at] -= np.bincount(np.searchsorted(upto, ticket, side="right"), minlength=len(at))
        stay = self.c[dish] - customers
        n = self.used[dish]
        first = np.cumsum(n) - n
        self.t[dish] = np.add.reduceat((self.size[at] > 0).astype(np.int64), first)
        # on the average half of the others sit when one comes
        seated = stay + (customers - 1) / 2 - discount * self.t[dish]
        opens = self.rng.binomial(customers, new_table / (new_table + seated))
        size = self.size[at]
        upto = np.cumsum(size)
        before, joined = upto[first] - size[first], np.zeros(len(at), np.int64)
        who = np.repeat(np.arange(len(dish)), customers - opens)
        while len(who):
            ticket = before[who] + np.floor(self.rng.random(len(who)) * stay[who]).astype(np.int64)
            to = np.searchsorted(upto, ticket, side="right")
            ok = self.rng.random(len(who)) * size[to] < size[to] - discount
            joined += np.bincount(to[ok], minlength=len(at))
            who = who[~ok]
        self.size[at] += joined
        more = np.flatnonzero(opens)
        if len(more):
            self._open(dish[more], opens[more])

    def seat_few(self, dish: np.ndarray, new_table: np.ndarray, discount: float) -> None:
        """All customers of dishes of two or three stand up and sit down together: their number
        of tables tells the seating, so it is drawn from its distribution."""
        three = self.c[dish] == 3
        one = np.where(three, (1 - discount) * (2 - discount), 1 - discount)
        two = np.where(three, 3 * new_table * (1 - discount), new_table)
        all_ = np.where(three, new_table**2, 0.0)
        ticket = self.rng.random(len(dish)) * (one + two + all_)
        t = 1 + (ticket >= one).astype(np.int64) + (three & (ticket >= one + two))
        wide = dish[self.used[dish] > 3]
        if len(wide):
            self.size[self._places(wide)[0]] = 0
        start = self.base[:-1][dish]
        self.size[start] = self.c[dish] - t + 1
        self.size[start + 1] = t > 1
        self.size[start + 2] = t > 2
        self.t[dish] = self.used[dish] = t

    def sweep(self, new_table: np.ndarray, discount: float) -> int:
        """As many moves for every dish as it has customers; their number.  A customer without
        company has one table only and stays."""
        few = np.flatnonzero((self.c > 1) & (self.c < 4))
        self.seat_few(few, new_table[few], discount)
        done = int(self.c[few].sum())
        rest = np.flatnonzero(self.c > 3)
        c, new_table = self.c[rest], new_table[rest]
        for turn in range(LANES if len(rest) else 0):
            moves = c // LANES + (turn < c % LANES)
            one, several = np.flatnonzero(moves == 1), np.flatnonzero(moves > 1)
            if len(one):
                self.leave(rest[one])
                self.enter(rest[one], new_table[one], discount)
            if len(several):
                self.move(rest[several], moves[several], new_table[several], discount)
            done += int(moves.sum())
        return done

    def become(self, customers: np.ndarray, new_table: float, discount: float) -> None:
        """Customers come and go until each dish has so many."""
        more = np.flatnonzero(self.c < customers)
        while len(more):
            self.enter(more, np.full(len(more), new_table), discount)
            more = more[self.c[more] < customers[more]]
        less = np.flatnonzero(self.c > customers)
        while len(less):
            self.leave(less)
            less = less[self.c[less] > customers[less]]


@dataclass
class Totals:
    """What cells must know of each other: customers and tables of every restaurant."""

    customers: np.ndarray  # per context
    tables: np.ndarray  # per context
    root_customers: int
    root_tables: int
    known: int  # V
    discounts: tuple[float, float]  # parent, contexts
    tokens: int = 0  # N; the customers' sum if these are all contexts

    def base(self) -> float:
        return 1.0 / (self.known + 1)


class Cell:
    """The dishes of some words: pairs (word, context) with training counts; ``seats`` of an
    earlier round go on."""

    def __init__(
        self, words: int, word: np.ndarray, context: np.ndarray, count: np.ndarray, totals: Totals, seed: int, seats=None
    ):
        self.totals, self.words = totals, words
        self.rng = np.random.default_rng([SEED, seed])
        self.word, self.context, self.count = word, context, count
        self.seen = np.flatnonzero(count > 0)
        self.many = np.flatnonzero(count > 1)  # a single customer always has a table alone
        per_word = np.bincount(word, count, minlength=words)
        start = per_word / max(1.0, float(totals.tokens or totals.customers.sum()))
        d1, d2 = totals.discounts
        self.weight = (STRENGTH[1] + d2 * totals.tables)[context]
        if seats:
            self.leaf = Tables.seated(*seats[:2], self.rng)
        else:
            self.leaf = Tables(count[self.many], self.weight[self.many] * start[word[self.many]], self.rng, d2)
        self.alone = np.bincount(word[self.seen], minlength=words) - np.bincount(word[self.many], minlength=words)
        served = self.alone + np.bincount(word[self.many], self.leaf.t, minlength=words).astype(np.int64)
        self.known = np.flatnonzero(served > 0)
        if seats:
            self.root = Tables.seated(*seats[2:], self.rng)
        else:
            self.root = Tables(served[self.known], np.full(len(self.known), self._root_weight()), self.rng, d1)

    def _root_weight(self) -> float:
        return (STRENGTH[0] + self.totals.discounts[0] * self.totals.root_tables) * self.totals.base()

    def parent(self) -> np.ndarray:
        """p(w) of every word of the cell under the present seating."""
        c, t = np.zeros(self.words), np.zeros(self.words)
        c[self.known], t[self.known] = self.root.c, self.root.t
        down = STRENGTH[0] + self.totals.root_customers
        return (c - self.totals.discounts[0] * t + self._root_weight()) / down

    def sweep(self) -> None:
        d1, d2 = self.totals.discounts
        if len(self.many):
            self.leaf.sweep(self.weight[self.many] * self.parent()[self.word[self.many]], d2)
        # the tables of the contexts are the customers of the parent
        served = self.alone + np.bincount(self.word[self.many], self.leaf.t, minlength=self.words).astype(np.int64)
        self.root.become(served[self.known], self._root_weight(), d1)
        self.root.sweep(np.full(len(self.known), self._root_weight()), d1)

    def tables_per_context(self) -> np.ndarray:
        t = np.ones(len(self.word), np.int64) * (self.count > 0)
        t[self.many] = self.leaf.t
        return np.bincount(self.context, t, minlength=len(self.totals.customers)).astype(np.int64)

    def probabilities(self) -> np.ndarray:
        """p(w | u) of every pair under the present seating."""
        t = (self.count > 0).astype(float)
        t[self.many] = self.leaf.t
        top = self.count - self.totals.discounts[1] * t + self.weight * self.parent()[self.word]
        return top / (STRENGTH[1] + self.totals.customers)[self.context]


# -- blocks of tokens ----------------------------------------------------------------------


def token_blocks(docs: DataFrame, key: str, text: str, learns: Column) -> DataFrame:
    """Table (block, keys, size, learns, doc, words, lengths, ids): texts as local word ids."""
    field = StructType([StructField("key", docs.schema[key].dataType)])
    kind = to_arrow_schema(field).field(0).type

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in W.shards(batch.column(2), BLOCK_BYTES):
                split = W.split(data, offsets, W.NOT_SPACE, lower=True)
                ids, dictionary = split.encode()
                lengths = np.diff(np.frombuffer(dictionary.buffers()[1], np.int64)[: len(dictionary) + 1]) if len(dictionary) else np.zeros(0, np.int64)
                raw = b"".join(dictionary.to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.ListArray.from_arrays(pa.array([0, end - first], pa.int32()), batch.column(0).slice(first, end - first).cast(kind)),
                        pa.array([len(data)], pa.int64()),
                        pa.array([pack(batch.column(1).slice(first, end - first).to_numpy(zero_copy_only=False).astype(np.uint8))], pa.binary()),
                        pa.array([pack(split.doc)], pa.binary()),
                        pa.array([pack(np.frombuffer(raw, np.uint8))], pa.binary()),
                        pa.array([pack(lengths.astype(np.uint32))], pa.binary()),
                        pa.array([pack(ids.astype(np.uint32))], pa.binary()),
                    ],
                    names=["keys", "size", "learns", "doc", "words", "lengths", "ids"],
                )

    rows = docs.select(F.col(key).alias("k"), learns.alias("l"), F.col(text).cast("string").alias("t"))
    listed = f"array<{field['key'].dataType.simpleString()}>"
    blobs = ", ".join(f"{c} binary" for c in ("learns", "doc", "words", "lengths", "ids"))
    packed = rows.mapInArrow(build, f"keys {listed}, size bigint, {blobs}")
    return written(packed.select(F.monotonically_increasing_id().alias("block"), "*"), "lm-blocks")


class Block:
    """The tokens of a block (words and ends) and its distinct (word, context) pairs, sorted
    by cell, word and context (hashes, so that all blocks ask in the same order)."""

    def __init__(self, row: dict, cells: int):
        self.block, self.keys = row["block"].as_py(), row["keys"].values
        self.learns = unpack(row["learns"], np.uint8).astype(bool)
        doc, lengths = unpack(row["doc"], np.int64), unpack(row["lengths"], np.uint32).astype(np.int64)
        raw, ids = unpack(row["words"], np.uint8), unpack(row["ids"], np.uint32).astype(np.int64)
        # the end token is one more word of the dictionary
        off = np.zeros(len(lengths) + 2, np.int64)
        np.cumsum(np.append(lengths, len(_END)), out=off[1:])
        vocabulary = W.Words(np.concatenate([raw, np.frombuffer(_END, np.uint8)]), off, np.array([0, len(lengths) + 1]))
        hashes = W.token_hashes(vocabulary, 12)
        cell = (hashes >> np.uint64(20)) % np.uint64(cells)
        order = np.lexsort((hashes, cell))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.vocabulary, self.order, self.cell = vocabulary, order, cell[order].astype(np.int64)
        # tokens in text order; a text's context starts anew
        texts = len(doc) - 1
        self.doc = doc + np.arange(texts + 1)
        token = np.full(self.doc[-1], len(lengths), np.int64)
        body = np.ones(len(token), bool)
        body[self.doc[1:] - 1] = False
        token[body] = ids
        context = np.zeros(len(token), np.int64)
        context[1:] = token[:-1] + 1
        context[self.doc[:-1]] = 0
        contexts = vocabulary.n + 1
        # 48 bits of a word's hash are its name as a context, 0 the start of a text
        names = np.append(np.uint64(0), np.maximum(W.token_hashes(vocabulary, 13) >> np.uint64(16), np.uint64(1)))
        by_name = np.argsort(names, kind="stable")
        place = np.empty(contexts, np.int64)
        place[by_name] = np.arange(contexts)
        pairs, self.pair_of = np.unique(rank[token] * contexts + place[context], return_inverse=True)
        self.pair_word = pairs // contexts
        self.pair_context = names[by_name][pairs % contexts]
        learned = np.repeat(self.learns, np.diff(self.doc))
        self.pair_count = np.bincount(self.pair_of[learned], minlength=len(pairs))

    def requests(self) -> Iterator[pa.RecordBatch]:
        """Per cell: its words of this block, their pairs and training counts."""
        cells, begin = np.unique(self.cell, return_index=True)
        edge = np.append(begin, len(self.cell))
        cut = np.searchsorted(self.pair_word, edge)
        length = np.diff(self.vocabulary.off)[self.order]
        start = self.vocabulary.off[:-1][self.order]
        for p, a, b, i, j in zip(cells.tolist(), edge[:-1], edge[1:], cut[:-1], cut[1:]):
            size = length[a:b]
            at = np.repeat(start[a:b] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
            blobs = (pack(self.vocabulary.data[at]), pack(size.astype(np.uint32)), pack_steps(self.pair_word[i:j] - a),
                     pack(_six_bytes(self.pair_context[i:j])), pack(self.pair_count[i:j].astype(np.uint32)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([p], pa.int32()), pa.array([self.block], pa.int64()), *(pa.array([x], pa.binary()) for x in blobs)],
                names=["cell", "block", "words", "lengths", "word", "context", "count"],
            )


def _six_bytes(names: np.ndarray) -> np.ndarray:
    return names.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]


def _names(raw) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = raw.reshape(-1, 6)
    return out.reshape(-1).view("<u8")


_REQUEST = "cell int, block bigint, words binary, lengths binary, word binary, context binary, count binary"


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield {n: batch.column(n)[k] for n in batch.schema.names}


def gather_cells(blocks: DataFrame, cells: int) -> DataFrame:
    """One row per cell: its pairs with corpus-wide counts, and which block asked for what."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            yield from Block(row, cells).requests()

    def merge(table: pa.Table) -> pa.Table:
        rows = [{n: table[n][k] for n in table.schema.names} for k in range(table.num_rows)]
        rows.sort(key=lambda r: r["block"].as_py())
        lengths = [unpack(r["lengths"], np.uint32).astype(np.int64) for r in rows]
        off = np.concatenate([[0], np.cumsum(np.concatenate(lengths))])
        data = np.concatenate([unpack(r["words"], np.uint8) for r in rows])
        word_of, dictionary = W.Words(data, off, np.array([0, len(off) - 1])).encode()
        spelt = dictionary.cast(pa.large_binary()).buffers()
        spelt = W.Words(np.frombuffer(spelt[2], np.uint8), np.frombuffer(spelt[1], np.int64)[: len(dictionary) + 1], None)
        by_hash = np.argsort(W.token_hashes(spelt, 12), kind="stable")
        place = np.empty(len(by_hash), np.int64)
        place[by_hash] = np.arange(len(by_hash))
        word_of = place[word_of]
        first = np.concatenate([[0], np.cumsum([len(x) for x in lengths])])
        local = [unpack_steps(r["word"]) + first[k] for k, r in enumerate(rows)]
        contexts, context = np.unique(np.concatenate([_names(unpack(r["context"], np.uint8)) for r in rows]), return_inverse=True)
        count = np.concatenate([unpack(r["count"], np.uint32) for r in rows])
        pairs, asked = np.unique(word_of[np.concatenate(local)] * max(1, len(contexts)) + context, return_inverse=True)
        total = np.bincount(asked, count, minlength=len(pairs)).astype(np.int64)
        word, ctx = pairs // max(1, len(contexts)), pairs % max(1, len(contexts))
        per_word = np.bincount(word, total, minlength=len(dictionary))
        served = np.bincount(word[total > 0], minlength=len(dictionary))
        stats = [per_word > 0, total == 1, total == 2, served == 1, served == 2, total > 0, total]
        stats = [int(x.sum()) for x in stats]
        return pa.table(
            {
                "cell": pa.array([rows[0]["cell"].as_py()], pa.int32()),
                "words": pa.array([len(dictionary)], pa.int64()),
                "stats": pa.array([stats], pa.list_(pa.int64())),
                "word": pa.array([pack_steps(word)], pa.binary()),
                "context": pa.array([pack(ctx.astype(np.uint32))], pa.binary()),
                "contexts": pa.array([pack(_six_bytes(contexts))], pa.binary()),
                "count": pa.array([pack(total)], pa.binary()),
                "blocks": pa.array([pack(np.array([r["block"].as_py() for r in rows], np.int64))], pa.binary()),
                "pair_rows": pa.array([pack(np.array([len(x) for x in local], np.int64))], pa.binary()),
                "word_rows": pa.array([pack(np.array([len(x) for x in lengths], np.int64))], pa.binary()),
                "asked": pa.array([pack_steps(asked)], pa.binary()),
                "word_of": pa.array([pack_steps(word_of)], pa.binary()),
            }
        )

    blobs = ", ".join(f"{c} binary" for c in ("word", "context", "contexts", "count", "blocks", "pair_rows", "word_rows", "asked", "word_of"))
    asked = blocks.mapInArrow(ask, _REQUEST)
    merged = asked.groupBy("cell").applyInArrow(merge, f"cell int, words bigint, stats array<bigint>, {blobs}")
    return written(merged, "lm-cells")


def _sums(rows: DataFrame, column: str, size: int) -> np.ndarray:
    """Sum of an array column over all rows; ``size`` numbers reach the driver."""
    got = rows.select(F.posexplode(column).alias("k", "v")).groupBy("k").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(size, np.int64)
    for k, v in got:
        out[k] = v
    return out


def _discount(once: int, twice: int) -> float:
    return float(np.clip(once / max(1, once + 2 * twice), 0.05, 0.95))


def context_sums(rows: DataFrame, parts: int, values: Callable[[dict], tuple]) -> DataFrame:
    """(cell, sums): ``values(row)`` names contexts of a cell and gives a number or two for each;
    the sums over all cells come back in the order of ``_by_part``."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            names, numbers = values(row)
            order, edge = _by_part(names, parts)
            names, numbers = names[order], np.asarray(numbers, np.int64)[:, order]
            for p in np.flatnonzero(np.diff(edge)).tolist():
                a, b = edge[p], edge[p + 1]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([p], pa.int32()),
                        pa.array([row["cell"].as_py()], pa.int32()),
                        pa.array([pack(_six_bytes(names[a:b]))], pa.binary()),
                        pa.array([pack(numbers[:, a:b])], pa.binary()),
                    ],
                    names=["part", "cell", "names", "numbers"],
                )

    def add(table: pa.Table) -> pa.Table:
        names = [_names(unpack(x, np.uint8)) for x in table["names"]]
        edge = np.concatenate([[0], np.cumsum([len(x) for x in names])])
        distinct, at = np.unique(np.concatenate(names), return_inverse=True)
        numbers = [unpack(x, np.int64).reshape(-1, len(n)) for x, n in zip(table["numbers"], names)]
        total = np.array([np.bincount(at, x, minlength=len(distinct)) for x in np.concatenate(numbers, axis=1)]).astype(np.int64)
        sums = [pack(total[:, at[a:b]]) for a, b in zip(edge[:-1], edge[1:])]
        return pa.table({"cell": table["cell"], "part": table["part"], "sums": pa.array(sums, pa.binary())})

    asked = rows.mapInArrow(ask, "part int, cell int, names binary, numbers binary")
    got = asked.groupBy("part").applyInArrow(add, "cell int, part int, sums binary")
    return got.groupBy("cell").agg(F.sort_array(F.collect_list(F.struct("part", "sums"))).alias("sums"))


def _by_part(names: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of contexts in the exchange, and where each part begins."""
    part = (names % np.uint64(parts)).astype(np.int64)
    return np.argsort(part, kind="stable"), np.concatenate([[0], np.cumsum(np.bincount(part, minlength=parts))])


def _sums_of(row: dict, names: np.ndarray, parts: int, kinds: int) -> np.ndarray:
    """What ``context_sums`` gave for the contexts, in their order."""
    out = np.zeros((kinds, len(names)), np.int64)
    if len(names):
        order, _ = _by_part(names, parts)
        got = [unpack(x["sums"], np.int64).reshape(kinds, -1) for x in row["sums"].values]
        out[:, order] = np.concatenate(got, axis=1)
    return out


def first_totals(row: dict) -> tuple:
    """A cell's customers and distinct words per context."""
    names = _names(unpack(row["contexts"], np.uint8))
    context, count = unpack(row["context"], np.uint32), unpack(row["count"], np.int64)
    return names, [np.bincount(context, x, minlength=len(names)) for x in (count, count > 0)]


def more_tables(row: dict) -> tuple:
    """A sampled cell's tables beyond one per pair, of contexts that may have any."""
    return _names(unpack(row["several"], np.uint8)), [unpack(row["more"], np.int64)]


@dataclass
class Corpus:
    """The sums that reach the driver."""

    root_customers: int
    root_tables: int
    known: int
    discounts: tuple[float, float]
    tokens: int
    cells: int
    parts: int


_SEATS = ("leaf_tables", "leaf_sizes", "root_tables", "root_sizes")


def _joined(cells: DataFrame, seats: DataFrame | None, sums: DataFrame, corpus: Corpus) -> DataFrame:
    near = lambda df: df.repartition(corpus.cells, "cell")
    if seats is None:
        return near(cells).join(near(sums), "cell", "left")
    rows = near(cells.drop("contexts")).join(near(sums), "cell", "left")
    return rows.join(near(seats.select("cell", "own", "several", *_SEATS)), "cell", "left")


def _open_cell(row: dict, corpus: Corpus, round_: int) -> Cell:
    word, context = unpack_steps(row["word"]), unpack(row["context"], np.uint32).astype(np.int64)
    seats = None
    if "own" in row:
        customers, distinct = unpack(row["own"], np.int64).reshape(2, -1)
        several = customers > distinct
        tables = distinct.copy()
        names = _names(unpack(row["several"], np.uint8))
        tables[several] += _sums_of(row, names, corpus.parts, 1)[0]
        seats = [unpack(row[c], np.int64) for c in _SEATS]
    else:
        names = _names(unpack(row["contexts"], np.uint8))
        customers, distinct = _sums_of(row, names, corpus.parts, 2)
        tables, names = distinct, names[customers > distinct]
    totals = Totals(customers, tables, corpus.root_customers, corpus.root_tables, corpus.known, corpus.discounts, corpus.tokens)
    seed = row["cell"].as_py() * 64 + round_
    cell = Cell(row["words"].as_py(), word, context, unpack(row["count"], np.int64), totals, seed, seats)
    cell.several, cell.own = names, np.array([customers, distinct])
    return cell


def sample_cells(cells: DataFrame, seats: DataFrame | None, sums: DataFrame, corpus: Corpus, round_: int) -> DataFrame:
    """A round of sweeps in every cell: a row per cell with its seating, its contexts' totals
    of customers and distinct words, and its share of the tables."""
    light = cells.select("cell", "words", "word", "context", "contexts", "count")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            cell = _open_cell(row, corpus, round_)
            for _ in range(BURN_IN):
                cell.sweep()
            several = cell.own[0] > cell.own[1]
            single = np.bincount(cell.context, cell.count > 0, minlength=len(several)).astype(np.int64)
            more = (cell.tables_per_context() - single)[several]
            blobs = (*cell.leaf.seats(), *cell.root.seats(), cell.own, _six_bytes(cell.several), more)
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["cell"].as_py()], pa.int32()), pa.array([[cell.root.c.sum(), cell.root.t.sum()]], pa.list_(pa.int64()))]
                + [pa.array([pack(x)], pa.binary()) for x in blobs],
                names=["cell", "root", *_SEATS, "own", "several", "more"],
            )

    blobs = ", ".join(f"{c} binary" for c in (*_SEATS, "own", "several", "more"))
    sampled = _joined(light, seats, sums, corpus).mapInArrow(work, f"cell int, root array<bigint>, {blobs}")
    return written(sampled, f"lm-seats-{round_}")


def answer_blocks(cells: DataFrame, seats: DataFrame | None, sums: DataFrame, corpus: Corpus) -> DataFrame:
    """(block, cell, logs, counts): averaged log10 probabilities of the pairs and training
    counts of the words that each block asked for, in the order of its request."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            cell = _open_cell(row, corpus, ROUNDS)
            for _ in range(BURN_IN):
                cell.sweep()
            total = np.zeros(len(cell.word))
            for _ in range(SAMPLES):
                cell.sweep()
                total += cell.probabilities()
            logs = np.log10(total / SAMPLES).astype(np.float32)
            count = np.bincount(cell.word, cell.count, minlength=cell.words).astype(np.int64)
            asked, word_of = unpack_steps(row["asked"]), unpack_steps(row["word_of"])
            pair_edge = np.concatenate([[0], np.cumsum(unpack(row["pair_rows"], np.int64))])
            word_edge = np.concatenate([[0], np.cumsum(unpack(row["word_rows"], np.int64))])
            for k, block in enumerate(unpack(row["blocks"], np.int64).tolist()):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([block], pa.int64()),
                        pa.array([row["cell"].as_py()], pa.int32()),
                        pa.array([pack(logs[asked[pair_edge[k] : pair_edge[k + 1]]])], pa.binary()),
                        pa.array([pack(count[word_of[word_edge[k] : word_edge[k + 1]]])], pa.binary()),
                    ],
                    names=["block", "cell", "logs", "counts"],
                )

    rows = _joined(cells.drop("stats"), seats, sums, corpus)
    return rows.mapInArrow(work, "block bigint, cell int, logs binary, counts binary")


def score_texts(docs: DataFrame, learns: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, learned, n_tokens, n_known, train_tokens, base_score, score, perplexity)`` of
    every row; the model learns from the rows where ``learns`` is true."""
    blocks = token_blocks(docs, key, text, F.coalesce(learns, F.lit(False)))
    count = part_count(blocks)
    cells = gather_cells(blocks, count)
    known, one2, two2, one1, two1, pairs, n = _sums(cells, "stats", 7).tolist()
    discounts = _discount(one1, two1), _discount(one2, two2)
    parts = max(1, min(count, known // CONTEXTS))
    corpus = Corpus(pairs, known, known, discounts, n, count, parts)
    seats, sums = None, context_sums(cells.select("cell", "context", "contexts", "count"), parts, first_totals)
    for k in range(ROUNDS - 1):
        seats = sample_cells(cells, seats, sums, corpus, k)
        root = _sums(seats, "root", 2).tolist()
        corpus = replace(corpus, root_customers=root[0], root_tables=root[1])
        sums = context_sums(seats.select("cell", "several", "more"), parts, more_tables)
    answers = answer_blocks(cells, seats, sums, corpus)
    v = known
    kind = docs.schema[key].dataType.simpleString()
    schema = f"key {kind}, learned boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.sort_by("cell")
        logs = np.concatenate([unpack(x, np.float32) for x in right["logs"]]).astype(float) if right.num_rows else np.zeros(0)
        counts = np.concatenate([unpack(x, np.int64) for x in right["counts"]]) if right.num_rows else np.zeros(0, np.int64)
        out = []
        for row in ({c: left[c][k] for c in left.schema.names} for k in range(left.num_rows)):
            block = Block(row, count)
            seen = counts[block.pair_word][block.pair_of]
            base = np.log10((seen + 0.1) / (n + 0.1 * (v + 1)))
            texts = len(block.doc) - 1
            owner = np.repeat(np.arange(texts), np.diff(block.doc))
            out.append(
                pa.table(
                    [
                        block.keys,
                        pa.array(block.learns),
                        pa.array(np.diff(block.doc)),
                        pa.array(np.bincount(owner, seen > 0, minlength=texts).astype(np.int64)),
                        pa.array(np.full(texts, n)),
                        pa.array(np.bincount(owner, base, minlength=texts)),
                        pa.array(np.bincount(owner, logs[block.pair_of], minlength=texts)),
                    ],
                    names=arrow.names,
                ).cast(arrow)
            )
        return pa.concat_tables(out) if out else arrow.empty_table()

    scored = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(finish, schema)
    perplexity = F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens"))
    return scored.withColumn("perplexity", perplexity).withColumnRenamed("key", key)

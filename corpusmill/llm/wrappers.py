"""Main text of web pages by wrapper induction over the pages of a host.

1. A page becomes a tree of block elements (``markup``), brothers of one kind folded into one
   node, and a list of text blocks, each at a node of it.
2. The trees of a host are aligned by simple tree matching and merged into one: the host's
   wrapper.  Distinct trees are counted first (copies of a tree cost one row per map task)
   and merged by up to ``FAN`` in a task, in rounds, so a host of any size is many tasks.
3. Every page is aligned with its host's wrapper, so that a text block sits in a slot.  A text
   that ``SHARE`` of the pages with that slot have there, in at least ``SUPPORT`` pages that
   differ, is constant and part of the template.  Texts are counted by (host, slot, hash).
4. Slots that vary are content, but for those whose element says that it is a menu, header,
   footer, sidebar, notice, advert, form or reader comments (``markup.asides``), and those
   outside the main region: the article or main element with most varying text or, without
   one, the smallest element with ``REGION`` of it.  Where constants are at least half of the
   region's text the host's pages are copies of each other, not of a template, and the
   constants stay.

Only trees and 64-bit hashes are shuffled for steps 2 and 3; the texts of a page move once,
compressed, to the wrapper of its host.  A host with more than 1/``HOT`` of the pages (at most
``HOT`` hosts, so their list is bounded) is spread over ``SALTS`` keys.

Defined results: a null or empty page, or one without text, gives an empty text; a host of one
page has no constants, its text is what step 4 leaves; a url without a host belongs to the
host ""; repeated rows are rows of their own; an empty table gives no rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corpusmill.llm import markup
from corpusmill.llm.tables import written

SHARE, SUPPORT, REGION = 0.9, 3, 0.6
FAN = 256
HOT, SALTS = 256, 64


def host_of(url: Column) -> Column:
    """The host of a url in lower case, without user and port; "" if there is none."""
    host = F.regexp_extract(F.lower(F.trim(url)), r"^(?:[a-z][a-z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.coalesce(host, F.lit(""))


def _read(page: str | None) -> tuple[str, list[int], list[str]]:
    """The folded tree of a page, and per text block its node and text."""
    root, blocks = markup.parse(page or "")
    markup.fold(root)
    markup.number(root)
    return markup.packed(root), [n.final().number for n, _ in blocks], [t for _, t in blocks]


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text) - (1 << 63)


def _mapped(df: DataFrame, fn, kept: list[str], extra: str) -> DataFrame:
    """``fn(row dict) -> tuple`` per row in Arrow batches, ``kept`` columns unchanged."""
    schema = StructType([df.schema[c] for c in kept] + list(StructType.fromDDL(extra).fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in batches:
            out = [fn(row) for row in batch.to_pylist()]
            columns = [batch.column(c).cast(arrow.field(c).type) for c in kept]
            columns += [pa.array([r[k] for r in out], f.type) for k, f in enumerate(list(arrow)[len(kept) :])]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return df.mapInArrow(run, schema)


# -- wrappers


def _merged(trees: list[str]) -> str:
    root = markup.unpacked(trees[0])
    for tree in trees[1:]:
        markup.merge(root, markup.unpacked(tree))
    return markup.packed(root)


def host_wrappers(trees: DataFrame) -> DataFrame:
    """``(host, wrapper)`` from ``(host, tree)``: distinct trees merged in rounds of about FAN
    per task, each in the order of their text."""
    state = written(trees.select("host", "tree").distinct(), "page-trees")
    most = state.groupBy("host").count().agg(F.max("count")).first()[0] or 1
    rounds = 1
    while FAN**rounds < most:
        rounds += 1
    for k in reversed(range(rounds)):
        slot = F.pmod(F.xxhash64("tree"), F.lit(FAN**k))
        groups = state.groupBy("host", slot.alias("slot")).agg(F.array_sort(F.collect_set("tree")).alias("trees"))
        state = _mapped(groups, lambda r: (_merged(r["trees"]),), ["host"], "tree string")
        state = written(state, f"page-wrappers-{k}")
    return state.withColumnRenamed("tree", "wrapper")


@lru_cache(maxsize=4096)
def _slots(tree: str, wrapper: str) -> np.ndarray:
    """For every node of a tree its node in the wrapper (-1: none), by aligning both."""
    page, frame = markup.unpacked(tree), markup.unpacked(wrapper)
    out = np.full(len(markup.number(page)), -1, np.int64)
    markup.number(frame)
    pairs = [(page, frame)]
    while pairs:
        p, f = pairs.pop()
        out[p.number] = f.number
        pairs += [(p.children[i], f.children[j]) for i, j in markup.align(p.children, f.children)]
    return out


# -- pages beside the model of their host


def _hot_hosts(counts: DataFrame) -> list[str]:
    """Hosts with more than 1/HOT of the pages: at most HOT of them, whatever the input."""
    total = counts.agg(F.sum("pages")).first()[0] or 0
    return [r.host for r in counts.filter(F.col("pages") * HOT > total).select("host").collect()]


def _beside(pages: DataFrame, models: DataFrame, hot: list[str]) -> DataFrame:
    """The rows of both, sorted so that the model of a host comes before its pages; a hot host
    is dealt to SALTS keys, with its model at each."""
    is_hot = F.col("host").isin(hot) if hot else F.lit(False)
    place = F.when(is_hot, F.pmod(F.col("spread"), F.lit(SALTS))).otherwise(0).cast("int")
    pages = pages.withColumn("salt", place).drop("spread").withColumn("kind", F.lit(1))
    salts = F.when(is_hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    models = models.withColumn("salt", F.explode(salts)).withColumn("kind", F.lit(0))
    both = models.unionByName(pages, allowMissingColumns=True)
    return both.repartition("host", "salt").sortWithinPartitions("host", "salt", "kind")


def constant_texts(read: DataFrame, wrappers: DataFrame, hot: list[str]) -> DataFrame:
    """``(host, constants)``: the texts of the template as (slot, hash).  A host has at most as
    many as 1/SHARE times the text blocks of its average page."""
    # pages with the same tree and texts count once
    pages = read.select("host", "tree", "nodes", "hashes", F.xxhash64("tree", "hashes").alias("spread"))
    pages = pages.dropDuplicates(["host", "spread"])
    schema = StructType.fromDDL("host string, slot bigint, hash bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wrapper = None
        for batch in batches:
            hosts, slots, hashes = [], [], []
            for row in batch.select(["host", "kind", "wrapper", "tree", "nodes", "hashes"]).to_pylist():
                if row["kind"] == 0:
                    wrapper = row["wrapper"]
                    continue
                place = _slots(row["tree"], wrapper)[row["nodes"]].tolist()
                found = {*zip(place, row["hashes"]), *((s, None) for s in place)}  # once a page
                for s, h in found:
                    if s >= 0:
                        hosts.append(row["host"])
                        slots.append(s)
                        hashes.append(h)
            yield pa.RecordBatch.from_pydict(
                {"host": pa.array(hosts, pa.string()), "slot": pa.array(slots, pa.int64()), "hash": pa.array(hashes, pa.int64())}
            )

    times = _beside(pages, wrappers, hot).mapInArrow(run, schema).groupBy("host", "slot", "hash").count()
    times = written(times.filter(F.col("count") >= SUPPORT), "page-texts")
    pages_with = times.filter("hash is null").select("host", "slot", F.col("count").alias("pages"))
    found = times.filter("hash is not null").join(pages_with, ["host", "slot"])
    found = found.filter(F.col("count") >= F.col("pages") * SHARE)
    return found.groupBy("host").agg(F.array_sort(F.collect_list(F.struct("slot", "hash"))).alias("constants"))


# -- content


@lru_cache(maxsize=4096)
def _layout(tree: str) -> tuple[list[markup.Node], list[bool]]:
    nodes = markup.number(markup.unpacked(tree))
    return nodes, markup.asides(nodes)


def main_blocks(tree: str, node_of: list[int], sizes: list[int], constant: list[bool]) -> list[int]:
    """The text blocks of the main text: ``node_of``, ``sizes`` and ``constant`` per block."""
    nodes, aside = _layout(tree)
    open_ = [k for k, n in enumerate(node_of) if not aside[n]]
    varying = [k for k in open_ if not constant[k]]
    region = _region(nodes, [(node_of[k], sizes[k]) for k in varying] or [(node_of[k], sizes[k]) for k in open_])
    inside = [k for k in open_ if region[node_of[k]]]
    fixed = sum(sizes[k] for k in inside if constant[k])
    if 2 * fixed >= sum(sizes[k] for k in inside):
        return inside
    return [k for k in inside if not constant[k]]


def _region(nodes: list[markup.Node], weights: list[tuple[int, int]]) -> list[bool]:
    """Nodes of the main region, given the text at nodes."""
    mass = [0] * len(nodes)
    for n, size in weights:
        mass[n] += size
    for node in reversed(nodes):
        if node.parent is not None:
            mass[node.parent.number] += mass[node.number]
    total = mass[0]
    articles = [n for n in nodes if markup.is_article(n) and n.tag == "article"] or [n for n in nodes if markup.is_article(n)]
    best = max(articles, key=lambda n: (mass[n.number], -n.number), default=None)
    if best is not None and 4 * mass[best.number] >= total > 0:
        label = best.label
        top = {n.number for n in nodes if n.label == label and n.parent is best.parent}
    else:
        node = nodes[0]
        while True:
            heavy = [c for c in node.children if mass[c.number] >= REGION * total and total]
            if not heavy or heavy[0].tag in ("p", "pre", "ul", "ol", "dl", "table", "tbody", "tr", "blockquote", "li") or (
                not heavy[0].children
            ):
                break
            node = heavy[0]
        top = {node.number}
    out = [False] * len(nodes)
    for n in nodes:
        out[n.number] = n.number in top or n.parent is not None and out[n.parent.number]
    return out


def extract_main_text(
    pages: DataFrame, html: str = "html", url: str = "url", out: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """``keep`` (default: all columns but ``html`` and one named like ``out``) plus ``out``, the
    main text of every page: blocks in page order, joined by an empty line."""
    keep = [c for c in pages.columns if c not in (html, out)] if keep is None else keep
    base = pages.select(host_of(F.col(url).cast("string")).alias("host"), F.col(html).cast("string").alias("html"))

    def reduced(row: dict) -> tuple:
        tree, nodes, texts = _read(row["html"])
        return tree, nodes, [_hash(t) for t in texts]

    read = _mapped(base, reduced, ["host"], "tree string, nodes array<int>, hashes array<bigint>")
    read = written(read, "page-blocks")
    hot = _hot_hosts(read.groupBy("host").agg(F.count(F.lit(1)).alias("pages")))
    wrappers = host_wrappers(read)
    models = wrappers.join(constant_texts(read, wrappers, hot), "host", "left")
    models = written(models, "page-models")

    # the texts of a page travel as one compressed value
    names = {c: f"k{k}" for k, c in enumerate(keep)}
    wide = pages.select(
        host_of(F.col(url).cast("string")).alias("host"),
        F.col(html).cast("string").alias("html"),
        *[F.col(c).alias(n) for c, n in names.items()],
    )

    def packed(row: dict) -> tuple:
        tree, nodes, texts = _read(row["html"])
        blob = zstandard.ZstdCompressor(level=3).compress(json.dumps([tree, nodes, texts]).encode())
        return blob, _hash(row["html"] or "")

    carried = _mapped(wide, packed, ["host", *names.values()], "blob binary, spread bigint")
    both = _beside(carried, models, hot)
    schema = StructType([carried.schema[n] for n in names.values()] + list(StructType.fromDDL("main_text string").fields))

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        wrapper, constants = "", set()
        for batch in batches:
            texts = []
            for row in batch.select(["kind", "wrapper", "constants", "blob"]).to_pylist():
                if row["kind"] == 0:
                    wrapper = row["wrapper"]
                    constants = {(c["slot"], c["hash"]) for c in row["constants"] or ()}
                    continue
                tree, nodes, blocks = json.loads(zstandard.ZstdDecompressor().decompress(row["blob"]))
                place = _slots(tree, wrapper)
                constant = [(int(place[n]), _hash(t)) in constants for n, t in zip(nodes, blocks)]
                chosen = main_blocks(tree, nodes, [len(t) for t in blocks], constant)
                texts.append("\n\n".join(blocks[k] for k in chosen))
            pages_only = batch.filter(pc.equal(batch.column("kind"), 1))
            columns = [pages_only.column(n).cast(arrow.field(n).type) for n in names.values()]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], schema=arrow)

    found = both.mapInArrow(decide, schema)
    return found.select(*[F.col(n).alias(c) for c, n in names.items()], F.col("main_text").alias(out))

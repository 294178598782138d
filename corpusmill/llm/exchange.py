"""Which keys of a corpus occur more than once, asked block-wise.

Texts are packed into blocks (a bounded run of a task's rows: keys, compressed texts); the
blocks are a written table, so a block keeps its number.  For a question a block sends its
distinct keys, split by hash into parts, as packed arrays (one row per block and part, so
copies inside a block are already merged); a part merges the rows of all blocks and
answers each row with one byte per key.  No key's occurrences are gathered: a key has at
most one entry per block, whatever number of copies it has, and the parts are balanced by
hash.  The number of parts grows with the corpus."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from corpusmill.llm import words as W
from corpusmill.llm.tables import written

BLOCK_BYTES = 4 << 20
PART_BYTES = 16 << 20  # text bytes per part


def pack(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).tobytes())


def unpack(raw, kind) -> np.ndarray:
    raw = raw.as_buffer() if isinstance(raw, pa.Scalar) else raw
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), kind)


def text_blocks(docs: DataFrame, key: str, text: str, name: str, max_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Table (block, keys, size, offsets, data): texts in read order; a null text is empty."""
    field = StructType([StructField("key", docs.schema[key].dataType)])
    kind = to_arrow_schema(field).field(0).type

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in W.shards(batch.column(1), max_bytes):
                keys = batch.column(0).slice(first, end - first).cast(kind)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.ListArray.from_arrays(pa.array([0, end - first], pa.int32()), keys),
                        pa.array([len(data)], pa.int64()),
                        pa.array([pack(offsets)], pa.binary()),
                        pa.array([pack(data)], pa.binary()),
                    ],
                    names=["keys", "size", "offsets", "data"],
                )

    rows = docs.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t"))
    listed = f"array<{field['key'].dataType.simpleString()}>"
    packed = rows.mapInArrow(build, f"keys {listed}, size bigint, offsets binary, data binary")
    return written(packed.select(F.monotonically_increasing_id().alias("block"), "*"), name)


def part_count(blocks: DataFrame) -> int:
    total = blocks.agg(F.sum("size")).first()[0] or 0
    return max(1, -(-int(total) // PART_BYTES))


def requests(part: np.ndarray, arrays: list[np.ndarray], block: int) -> Iterator[pa.RecordBatch]:
    """Rows (part, block, columns) from keys sorted by part."""
    parts, begin = np.unique(part, return_index=True)
    edge = np.append(begin, len(part))
    for p, a, b in zip(parts.tolist(), edge[:-1].tolist(), edge[1:].tolist()):
        yield pa.RecordBatch.from_arrays(
            [pa.array([p], pa.int32()), pa.array([block], pa.int64())]
            + [pa.array([pack(x[a:b])], pa.binary()) for x in arrays],
            names=["part", "block", *(f"c{k}" for k in range(len(arrays)))],
        )


def answered(asked: DataFrame, kinds: list[str], judge: Callable[..., np.ndarray], round_: int = 1) -> DataFrame:
    """Per (block, part) row a packed answer: ``judge(*columns, row)`` works on the joined
    columns of all rows of a part (``row`` numbers the row that each key came from) and
    returns one uint8 per key."""

    def merge(table: pa.Table) -> pa.Table:
        part, blocks = table["part"][0].as_py(), table["block"].to_pylist()
        columns = [[unpack(x, kind) for x in table[f"c{c}"]] for c, kind in enumerate(kinds)]
        sizes = [len(x) for x in columns[0]]
        got = judge(*(np.concatenate(c) for c in columns), np.repeat(np.arange(len(sizes)), sizes))
        edge = np.concatenate([[0], np.cumsum(sizes)])
        return pa.table(
            {
                "block": pa.array(blocks, pa.int64()),
                "part": pa.array([part] * len(blocks), pa.int32()),
                "answer": pa.array([pack(got[a:b]) for a, b in zip(edge[:-1], edge[1:])], pa.binary()),
            }
        )

    got = asked.groupBy("part").applyInArrow(merge, "block bigint, part int, answer binary")
    return got.withColumn("round", F.lit(round_))


def with_answers(blocks: DataFrame, answers: DataFrame, work: Callable, schema: str) -> DataFrame:
    """``work(block row as a dict, answers)`` for every block; answers are per round the
    packed answers joined in part order, i.e. in the order of the block's request."""

    kind = to_arrow_schema(StructType.fromDDL(schema))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for k in range(left.num_rows):
            out += list(work(block_of(left, k), joined_answers(right)))
        return pa.Table.from_batches(out).cast(kind) if out else kind.empty_table()

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, schema)


def joined_answers(rows: pa.Table) -> dict[int, np.ndarray]:
    rounds: dict[int, list[tuple[int, np.ndarray]]] = {}
    for r, p, a in zip(rows["round"].to_pylist(), rows["part"].to_pylist(), rows["answer"]):
        rounds.setdefault(r, []).append((p, unpack(a, np.uint8)))
    return {r: np.concatenate([a for _, a in sorted(v, key=lambda x: x[0])]) for r, v in rounds.items()}


def block_of(batch, k: int) -> dict:
    return {
        "block": batch["block"][k].as_py(),
        "keys": batch["keys"][k].values,
        "offsets": unpack(batch["offsets"][k], np.int64),
        "data": unpack(batch["data"][k], np.uint8),
    }


def each_block(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        table = {n: batch.column(n) for n in batch.schema.names}
        for k in range(batch.num_rows):
            yield block_of(table, k)

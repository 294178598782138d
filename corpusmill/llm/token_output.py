"""Token ids as binary files: one zstandard frame per document under a shared dictionary.

Format of an output folder:

* ``dictionary.zstd`` - the shared dictionary, trained on serialized id arrays;
* ``tokens-<shard>-<attempt>.bin`` - the documents' frames one after another.  A frame
  holds the document's ids as little-endian integers of ``width`` bytes (2 when the
  vocabulary allows it, else 4);
* ``tokens-<shard>-<attempt>.idx`` - Arrow IPC: key, offset, bytes, n_ids, crc32 (of the
  ids as unsigned 32-bit integers) in key order; its metadata has the width and the
  SHA-256 of the dictionary.  A document is read by one seek and one frame, never its
  neighbours; a reader refuses a dictionary whose hash differs;
* ``manifest`` (Parquet) - a row per shard: the files that count.  A task that is run again
  writes new file names, and only the names returned by the successful attempt reach the
  manifest, so lost executors and speculative copies leave no trace in it.

Plan: documents are encoded and compressed where they are read (a distinct word is tokenised
about once per Python worker: the tokenizer splits at white space, so works word by word), then
only frames are shuffled, by contiguous key ranges, and written in ascending key order.

Defined cases: a null text is an empty one (just the end id); null keys come first;
repeated keys are all kept, ordered by checksum and length; very long texts are one frame;
a corpus without usable samples gets an empty dictionary; an empty table gives an empty
manifest; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.fs
import pyarrow.ipc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from corpusmill.llm import words as W
from corpusmill.operators.ordinals import bucket_column, key_bounds

SHARD_DOCS = 1 << 14
SAMPLE_DOCS = 2048
SAMPLE_BYTES = 4096
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
KNOWN_WORDS = 1_000_000
_SHARD = 4 << 20  # text bytes looked up at a time
_LINE, _LINES = 64, 64  # words per line, lines per call of the tokenizer
_TOKENIZERS: dict = {}


def keeps_words_apart(tok, definition: str) -> bool:
    """Does the tokenizer encode the words of a text one by one?  Its pre-tokenizer must drop
    white space: a piece that holds some (as byte-level pieces do) depends on what is before
    the word.  No added token may reach over white space either."""
    if tok.pre_tokenizer is None:
        return False
    for token in json.loads(definition).get("added_tokens") or []:
        if token.get("lstrip") or token.get("rstrip") or any(c.isspace() for c in token["content"]):
            return False
    for space in (" ", "\t", "\n", "\x0b", "\x0c", "\r", "  "):
        text = space.join(["ab", "Cd", "9", "!?", "é", "x.y"])
        text = tok.normalizer.normalize_str(text) if tok.normalizer is not None else text
        pieces = tok.pre_tokenizer.pre_tokenize_str(text)
        if any(c.isspace() for _, (a, b) in pieces for c in text[a:b]):
            return False
    return True


class WordTokenizer:
    """Encodes words with a public tokenizer file; a word met again is looked up.

    The lookup table (128-bit word hashes, ids) is bounded by ``KNOWN_WORDS``; when it is
    full it starts anew, which costs time only."""

    def __init__(self, definition: str, end_id: int):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_str(definition)
        if not keeps_words_apart(self.tok, definition):
            raise ValueError("the tokenizer does not keep words apart: its pieces hold white space")
        self.end_id = end_id
        self._forget()

    @classmethod
    def shared(cls, definition: str, end_id: int) -> WordTokenizer:
        """One per Python worker, kept from task to task."""
        key = (hashlib.sha256(definition.encode()).digest(), end_id)
        if key not in _TOKENIZERS:
            _TOKENIZERS.clear()
            _TOKENIZERS[key] = cls(definition, end_id)
        return _TOKENIZERS[key]

    def _forget(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.check, self.start = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.size, self.flat = np.zeros(0, np.int32), np.zeros(0, np.uint32)

    def _encode_new(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words and how many each has: a line of words per call, the offsets
        tell which word an id belongs to."""
        size, flat = np.zeros(len(words), np.int64), []
        for a in range(0, len(words), _LINE * _LINES):
            lines = [words[k : k + _LINE] for k in range(a, min(a + _LINE * _LINES, len(words)), _LINE)]
            for k, e in enumerate(self.tok.encode_batch([" ".join(x) for x in lines], add_special_tokens=False)):
                ends = np.cumsum([len(w) + 1 for w in lines[k]])
                begin = np.array(e.offsets, np.int64).reshape(-1, 2)[:, 0]
                owner = np.searchsorted(ends, begin, side="right")
                if (np.diff(owner) < 0).any():
                    raise ValueError("the tokenizer does not keep words apart")
                first = a + k * _LINE
                size[first : first + len(lines[k])] = np.bincount(owner, minlength=len(lines[k]))
                flat.append(np.array(e.ids, np.uint32))
        return np.concatenate(flat) if flat else np.zeros(0, np.uint32), size

    def words(self, dictionary: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``self.flat`` of all distinct words' ids: starts and sizes."""
        n = len(dictionary)
        off = np.frombuffer(dictionary.buffers()[1], np.int64)[: n + 1] if n else np.zeros(1, np.int64)
        data = np.frombuffer(dictionary.buffers()[2], np.uint8) if n else np.zeros(0, np.uint8)
        split = W.Words(data, off, np.array([0, n]))
        one, two = W.token_hashes(split, 21), W.token_hashes(split, 22)
        for again in (False, True):
            at = np.searchsorted(self.known, one)
            at[at == len(self.known)] = 0
            have = (self.known[at] == one) & (self.check[at] == two) if len(self.known) else np.zeros(n, bool)
            new = np.flatnonzero(~have)
            if not len(new) or again:
                break
            if len(self.known) + len(new) > KNOWN_WORDS:
                self._forget()
                new = np.arange(n)
            raw = dictionary.take(pa.array(new)).to_pylist()
            flat, size = self._encode_new([w.decode("utf-8", "replace") for w in raw])
            known = np.concatenate([self.known, one[new]])
            order = np.argsort(known, kind="stable")
            self.known, self.check = known[order], np.concatenate([self.check, two[new]])[order]
            start = len(self.flat) + np.cumsum(size) - size
            self.start = np.concatenate([self.start, start.astype(np.int32)])[order]
            self.size = np.concatenate([self.size, size.astype(np.int32)])[order]
            self.flat = np.concatenate([self.flat, flat])
        if n and not have.all():
            raise ValueError("two words with one hash")
        return self.start[at].astype(np.int64), self.size[at].astype(np.int64)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a shard (each closed by the end id) and the texts' bounds."""
        split = W.split(data, offsets, W.NOT_SPACE)
        which, dictionary = split.encode()
        start, sizes = self.words(dictionary)
        size = sizes[which]
        total = W.per_text(size, split.doc) + 1
        bounds = np.zeros(len(offsets), np.int64)
        np.cumsum(total, out=bounds[1:])
        ids = np.full(bounds[-1], self.end_id, np.uint32)
        body = np.ones(len(ids), bool)
        body[bounds[1:] - 1] = False
        ids[body] = self.flat[_ragged(start[which], size)]
        return ids, bounds


def _ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Concatenated ranges ``start : start + size``."""
    if not len(start):
        return np.zeros(0, np.int64)
    before = np.cumsum(size) - size
    return np.repeat(start - before, size) + np.arange(int(size.sum()))


def _dictionary(samples: list[bytes]) -> bytes:
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:  # too few samples to train on
        return b""


def _dict_data(raw: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(raw) if raw else None


def _open(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """Any store that pyarrow's file systems reach; plain paths are local or mounted."""
    return pyarrow.fs.FileSystem.from_uri(path if ":/" in path else f"file://{path}")


def train_dictionary(docs: DataFrame, key: str, text: str, tokenizer, end_id: int, kind: str) -> bytes:
    """Dictionary over one piece (at most ``SAMPLE_BYTES``) of each of ``SAMPLE_DOCS``
    documents, chosen by hash: a bounded sample, as only compression depends on it."""
    hashed = F.xxhash64(F.lit(5), F.col(key).cast("string"), F.octet_length(F.col(text)))
    rows = docs.select(F.col(text).cast("string").alias("t"), hashed.alias("h")).orderBy("h").limit(SAMPLE_DOCS)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = WordTokenizer.shared(tokenizer.value, end_id)
        for batch in batches:
            hashed = batch.column(1).to_numpy().astype(np.int64)
            for first, end, data, offsets in W.shards(batch.column(0)):
                ids, bounds = own.encode(data, offsets)
                out = []
                for d, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
                    raw = ids[a:b].astype(kind).tobytes()
                    n = -(-len(raw) // SAMPLE_BYTES)
                    at = int(hashed[first + d]) % n
                    out.append(raw[at * SAMPLE_BYTES : (at + 1) * SAMPLE_BYTES])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashed[first:end]), pa.array(out, pa.binary())], names=["h", "piece"]
                )

    got = rows.mapInArrow(pieces, "h bigint, piece binary").orderBy("h", "piece").collect()
    return _dictionary([bytes(r[1]) for r in got])


def write_tokens(
    docs: DataFrame,
    folder: str,
    tokenizer_file: str,
    key: str = "doc_id",
    text: str = "text",
    end_id: int = 2,
    shard_docs: int = SHARD_DOCS,
) -> DataFrame:
    """Write the files under ``folder``; returns the manifest
    ``(shard, bin, idx, n_docs, n_ids)``."""
    spark = docs.sparkSession
    definition = Path(tokenizer_file).read_text()  # a vocabulary file
    WordTokenizer(definition, end_id)  # refuses before any work
    tokenizer = spark.sparkContext.broadcast(definition)
    model = json.loads(definition)
    top = max([*model["model"]["vocab"].values(), *(t["id"] for t in model.get("added_tokens") or []), end_id])
    kind = "<u2" if top < 1 << 16 else "<u4"
    trained = train_dictionary(docs, key, text, tokenizer, end_id, kind)
    digest = hashlib.sha256(trained).hexdigest()
    store, root = _open(folder)
    store.create_dir(root)
    with store.open_output_stream(f"{root}/dictionary.zstd") as f:
        f.write(trained)
    shared = spark.sparkContext.broadcast(trained)

    @F.arrow_udf("n_ids bigint, crc32 bigint, frame binary")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = WordTokenizer.shared(tokenizer.value, end_id)
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dict_data(shared.value))
        for column in batches:
            sizes, sums, frames = [], [], []
            for _, _, data, offsets in W.shards(column, _SHARD):
                ids, bounds = own.encode(data, offsets)
                wide, narrow = ids.astype("<u4"), ids.astype(kind)
                for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                    sizes.append(b - a)
                    sums.append(zlib.crc32(wide[a:b]))
                    frames.append(packer.compress(narrow[a:b]))
            yield pa.StructArray.from_arrays(
                [pa.array(sizes, pa.int64()), pa.array(sums, pa.int64()), pa.array(frames, pa.binary())],
                names=["n_ids", "crc32", "frame"],
            )

    keys = docs.select(F.col(key).alias("key"))
    count = keys.count()
    width = spark.sparkContext.defaultParallelism
    shards = max(1, min(max(-(-count // shard_docs), 2 * width), count))
    bounds = key_bounds(keys, ["key"], shards)
    rows = docs.select(F.col(key).alias("key"), encode.asNondeterministic()(F.col(text).cast("string")).alias("e"))
    rows = rows.select(bucket_column(["key"], bounds, spark).alias("shard"), "key", "e.*")
    # one shard a partition
    rows = rows.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "key", "crc32", "n_ids")
    key_type = to_arrow_schema(StructType([StructField("key", keys.schema["key"].dataType)])).field(0).type

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, out, parts, name, at = None, None, [], "", 0
        store, root = _open(folder)

        def close() -> pa.RecordBatch:
            out.close()
            index = pa.concat_tables(parts)
            meta = {"width": str(np.dtype(kind).itemsize), "dictionary_sha256": digest, "end_id": str(end_id)}
            index = index.replace_schema_metadata(meta)
            with store.open_output_stream(f"{root}/{name}.idx") as f, pa.ipc.new_file(f, index.schema) as w:
                w.write_table(index)
            return pa.RecordBatch.from_pydict(
                {"shard": [now], "bin": [f"{name}.bin"], "idx": [f"{name}.idx"], "n_docs": [len(index)],
                 "n_ids": [int(np.sum(index["n_ids"].to_numpy()))]}, schema=_MANIFEST)

        for batch in batches:
            shard = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), len(shard)] if len(shard) else [0]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if int(shard[a]) != now:
                    if out is not None:
                        yield close()
                    now, parts, at = int(shard[a]), [], 0
                    name = f"tokens-{now:06d}-{uuid.uuid4().hex[:12]}"
                    out = store.open_output_stream(f"{root}/{name}.bin")
                frames = batch.column(4)[a:b].to_pylist()
                for f in frames:
                    out.write(f)
                size = np.array([len(f) for f in frames], np.int64)
                parts.append(
                    pa.table(
                        {
                            "key": batch.column(1)[a:b].cast(key_type),
                            "offset": pa.array(at + np.cumsum(size) - size),
                            "bytes": pa.array(size),
                            "n_ids": batch.column(2)[a:b],
                            "crc32": batch.column(3)[a:b],
                        }
                    )
                )
                at += int(size.sum())
        if out is not None:
            yield close()

    manifest = rows.mapInArrow(write, "shard int, bin string, idx string, n_docs bigint, n_ids bigint")
    path = f"{folder.rstrip('/')}/manifest"
    manifest.write.parquet(path)
    return spark.read.schema(manifest.schema).parquet(path)


_MANIFEST = pa.schema([("shard", pa.int32()), ("bin", pa.string()), ("idx", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])


class TokenFile:
    """A shard: documents by place in the index, each by one seek and one frame."""

    def __init__(self, folder: str, bin_name: str, idx_name: str):
        store, root = _open(folder)
        with store.open_input_file(f"{root}/{idx_name}") as f:
            self.index = pa.ipc.open_file(f).read_all()
        meta = {k.decode(): v.decode() for k, v in self.index.schema.metadata.items()}
        with store.open_input_stream(f"{root}/dictionary.zstd") as f:
            raw = f.read()
        if hashlib.sha256(raw).hexdigest() != meta["dictionary_sha256"]:
            raise ValueError(f"{folder}: the dictionary is not the one that {idx_name} was written with")
        self.kind = f"<u{meta['width']}"
        self.unpacker = zstandard.ZstdDecompressor(dict_data=_dict_data(raw))
        self.data = store.open_input_file(f"{root}/{bin_name}")
        self.offset, self.bytes = self.index["offset"].to_numpy(), self.index["bytes"].to_numpy()

    def __len__(self) -> int:
        return len(self.index)

    def ids(self, at: int) -> np.ndarray:
        frame = self.data.read_at(int(self.bytes[at]), int(self.offset[at]))
        return np.frombuffer(self.unpacker.decompress(frame), self.kind)

    def __iter__(self) -> Iterator[np.ndarray]:
        for at in range(len(self)):
            yield self.ids(at)


def read_tokens(spark, folder: str, key_type: str, with_ids: bool = False) -> DataFrame:
    """Every document of a written folder, decoded from its frame: key, start (ids of all
    documents before it), n_tokens, ids_crc32 and, if asked for, ids."""
    manifest = spark.read.parquet(f"{folder.rstrip('/')}/manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row per shard
    files = manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    files = files.repartition(spark.sparkContext.defaultParallelism * 2, "shard").select("bin", "idx", "base")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, idx, base in zip(*(batch.column(k).to_pylist() for k in range(3))):
                file = TokenFile(folder, name, idx)
                for a in range(0, len(file), 1024):
                    b = min(a + 1024, len(file))
                    got = [file.ids(k) for k in range(a, b)]
                    size = np.array([len(x) for x in got], np.int64)
                    out = {
                        "key": file.index["key"].slice(a, b - a).combine_chunks(),
                        "start": pa.array(base + np.cumsum(size) - size),
                        "n_tokens": pa.array(size),
                        "ids_crc32": pa.array([zlib.crc32(x.astype("<u4")) for x in got], pa.int64()),
                    }
                    if with_ids:
                        out["ids"] = pa.array([x.astype(np.int32) for x in got], pa.list_(pa.int32()))
                    base += int(size.sum())
                    yield pa.RecordBatch.from_pydict(out)

    extra = ", ids array<int>" if with_ids else ""
    return files.mapInArrow(read, f"key {key_type}, start bigint, n_tokens bigint, ids_crc32 bigint{extra}")

"""Language identification by nearest centroids of TF-IDF n-gram vectors.

A text becomes a vector over hashed byte n-grams (2 to 4 bytes of the lower-cased UTF-8
text; digits, punctuation and blanks count as one separator): ``(1 + log tf) * idf``,
normalised to length 1.  Document frequencies are counted over all learning texts.  Per
language ``CENTROIDS`` centroids are clustered (spherical k-means, deterministic start) on
at most ``SAMPLE_PER_LANGUAGE`` documents of it (``SAMPLE_TOTAL`` in all; the ones with the
smallest hash of the key), each language in a task of its own.  A text is compared with all
centroids by cosine and gets the language of the nearest; it is rejected when its distance
exceeds what the nearest centroid's cluster has (times ``SLACK``, plus ``MARGIN``).

Plan: one pass for document frequencies (at most ``BUCKETS`` rows per task), one for the
sample, one that predicts; no text is shuffled but the bounded sample.  The model has
``CENTROIDS * BUCKETS`` numbers per language; more than ``MAX_LANGUAGES`` languages are
refused with an error, so the broadcast stays under 70 MB.

Defined cases: texts that are null or have no letter are ``und`` with score 0; rows
without a language are not learned from; without learning rows every text is ``und``;
equally near centroids: the first language in code-point order; repeated rows are judged
alike; all input columns are kept, one named like the result column is replaced; empty
tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm import words as W
from corpusmill.operators.topk import top_k_per_group

BUCKETS = 4096
SIZES = (2, 3, 4)
CENTROIDS = 4
SAMPLE_PER_LANGUAGE = 500
SAMPLE_TOTAL = 8192
MAX_LANGUAGES = 1024
ITERATIONS = 12
SLACK = 1.15
MARGIN = 0.05
UNKNOWN = "und"
_TEXTS = 256  # texts per dense matrix
_SHARD = 1 << 20

_BYTES = np.arange(256)
_LETTER = np.where(
    ((_BYTES >= 65) & (_BYTES <= 90)) | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128), W.LOWER, 32
).astype(np.uint32)


def term_counts(column: pa.Array) -> Iterator[np.ndarray]:
    """Dense counts (texts x buckets) of consecutive small runs of the column's texts."""
    lowered = pc.utf8_lower(W.texts(column))
    for begin in range(0, len(lowered), _TEXTS):
        for first, end, data, offsets in W.shards(lowered.slice(begin, _TEXTS), _SHARD):
            yield _shard_counts(data, offsets, end - first)


def _shard_counts(data: np.ndarray, offsets: np.ndarray, texts: int, piece: int = 4 * _SHARD) -> np.ndarray:
    counts = np.zeros(texts * BUCKETS, np.int64)
    for a in range(0, len(data), piece):  # a very long text is counted in pieces
        b = min(a + piece, len(data))
        part = _LETTER[data[a : min(b + max(SIZES) - 1, len(data))]]
        if len(part) < 2:
            continue
        owner = np.searchsorted(offsets, np.arange(a, a + len(part)), side="right") - 1 if texts > 1 else np.zeros(len(part), np.int64)
        # two separators in a row: no n-gram spans them
        broken = np.zeros(len(part), bool)
        broken[:-1] = (part[:-1] == 32) & (part[1:] == 32)
        key, bad = part.copy(), np.zeros(len(part), bool)
        for n in range(2, max(SIZES) + 1):
            m = min(b - a, len(part) - n + 1)
            if m <= 0:
                break
            key[:m] |= part[n - 1 : n - 1 + m] << np.uint32(8 * (n - 1))
            bad[:m] |= broken[n - 2 : n - 2 + m]
            if n not in SIZES:
                continue
            use = ~bad[:m] & (owner[:m] == owner[n - 1 : n - 1 + m])
            cell = (key[:m][use] * np.uint32(2654435761) + np.uint32(n * 40503)) * np.uint32(2246822519)
            cell = (cell >> np.uint32(32 - 12)).astype(np.int64)
            counts += np.bincount(owner[:m][use] * BUCKETS + cell, minlength=len(counts))
    return counts.reshape(texts, BUCKETS)


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(counts, dtype=np.float32) * idf
    length = np.sqrt((v * v).sum(axis=1, keepdims=True))
    return v / np.where(length > 0, length, 1)


def cluster(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means: centroids and the greatest distance in each cluster."""
    mean = v.mean(axis=0)
    chosen = [int(np.argmax(v @ mean))]
    while len(chosen) < min(k, len(v)):  # then the text farthest from all chosen ones
        chosen.append(int(np.argmin((v @ v[chosen].T).max(axis=1))))
    c = v[sorted(set(chosen))]
    for _ in range(ITERATIONS):
        near = np.argmax(v @ c.T, axis=1)
        new = np.stack([v[near == j].sum(axis=0) if (near == j).any() else c[j] for j in range(len(c))])
        new /= np.maximum(np.sqrt((new * new).sum(axis=1, keepdims=True)), 1e-12)
        if np.allclose(new, c, atol=1e-6):
            break
        c = new
    sims = v @ c.T
    near = np.argmax(sims, axis=1)
    radius = np.array([1 - sims[near == j, j].min() if (near == j).any() else 0.0 for j in range(len(c))])
    return c.astype(np.float32), radius


def document_frequencies(learn: DataFrame, text: str) -> tuple[np.ndarray, int]:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, texts = np.zeros(BUCKETS + 1, np.int64), 0
        for batch in batches:
            for c in term_counts(batch.column(0)):
                total[:BUCKETS] += (c > 0).sum(axis=0)
                texts += len(c)
        total[BUCKETS] = texts
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BUCKETS + 1), pa.int32()), pa.array(total)], names=["cell", "n"])

    rows = learn.select(F.col(text).cast("string")).mapInArrow(count, "cell int, n bigint")
    out = np.zeros(BUCKETS + 1, np.int64)
    for cell, n in rows.groupBy("cell").agg(F.sum("n").alias("n")).collect():  # BUCKETS + 1 rows
        out[cell] = n
    return out[:BUCKETS], int(out[BUCKETS])


def learn_centroids(learn: DataFrame, key: str, text: str, lang: str) -> dict:
    """The model from the rows of ``learn`` (null languages are left out)."""
    learn = learn.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t"), F.col(lang).alias("l")).filter("l is not null")
    languages = sorted(r[0] for r in learn.select("l").distinct().limit(MAX_LANGUAGES + 1).collect())
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages to learn")
    df, total = document_frequencies(learn, "t")
    idf = (np.log((1 + total) / (1 + df)) + 1e-3).astype(np.float32)
    model = {"languages": languages, "idf": idf, "centroids": np.zeros((0, BUCKETS), np.float32), "owner": [], "radius": np.zeros(0)}
    if not languages:
        return model
    each = max(1, min(SAMPLE_PER_LANGUAGE, SAMPLE_TOTAL // len(languages)))
    keyed = learn.select("l", F.xxhash64(F.lit(3), "k").alias("h"), F.coalesce(F.octet_length("t"), F.lit(0)).alias("n"))
    # null keys hash alike: the length tells such rows apart, equal ones are taken together
    picked = top_k_per_group(keyed.distinct(), ["l"], ["h", "n"], each).select("l", "h", "n")
    sample = learn.withColumn("h", F.xxhash64(F.lit(3), "k")).withColumn("n", F.coalesce(F.octet_length("t"), F.lit(0)))
    sample = sample.join(F.broadcast(picked), ["l", "h", "n"]).dropDuplicates(["l", "h", "n"])  # SAMPLE_TOTAL rows

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [(b.column("l"), b.column("h"), vectors(np.concatenate(list(term_counts(b.column("t")))), idf)) for b in batches if b.num_rows]
        order = np.argsort(np.concatenate([h.to_numpy() for _, h, _ in got]), kind="stable")
        c, radius = cluster(np.concatenate([v for _, _, v in got])[order], CENTROIDS)
        yield pa.RecordBatch.from_arrays(
            [pa.array([got[0][0][0].as_py()] * len(c), pa.string()), pa.array(range(len(c)), pa.int32()), pa.array([x.tobytes() for x in c], pa.binary()), pa.array(radius, pa.float64())],
            names=["l", "c", "v", "radius"],
        )

    fitted = sample.select("l", "h", "t").groupBy("l").applyInArrow(fit, "l string, c int, v binary, radius double")
    rows = sorted(fitted.collect(), key=lambda r: (r[0], r[1]))  # CENTROIDS rows per language
    model["centroids"] = np.stack([np.frombuffer(r[2], np.float32) for r in rows])
    model["owner"] = [languages.index(r[0]) for r in rows]
    model["radius"] = np.array([r[3] for r in rows])
    return model


def classify(column: pa.Array, model: dict) -> tuple[list[str], np.ndarray, np.ndarray]:
    names, scores, rejected = [], [np.zeros(0)], [np.zeros(0, bool)]
    for counts in term_counts(column):
        if not len(model["owner"]):
            names += [UNKNOWN] * len(counts)
            scores.append(np.zeros(len(counts)))
            rejected.append(np.ones(len(counts), bool))
            continue
        sims = vectors(counts, model["idf"]) @ model["centroids"].T
        best = np.argmax(sims, axis=1)
        names += [model["languages"][model["owner"][b]] for b in best]
        top = np.clip(sims[np.arange(len(best)), best].astype(float), 0, 1)
        scores.append(top)
        rejected.append(1 - top > SLACK * model["radius"][best] + MARGIN)
    return names, np.concatenate(scores), np.concatenate(rejected)


def identify(docs: DataFrame, model: dict, text: str = "text", out: str = "language") -> DataFrame:
    """``docs`` plus the struct column ``out``: nearest, score, rejected, lang (``und`` when
    rejected or without letters)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("nearest string, score double, rejected boolean")
    def nearest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            names, scores, rejected = classify(column, shared.value)
            yield pa.StructArray.from_arrays(
                [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())],
                names=["nearest", "score", "rejected"],
            )

    lettered = F.coalesce(F.col(text).cast("string").rlike(r"\p{L}"), F.lit(False))
    found = docs.withColumn(out, nearest.asNondeterministic()(F.col(text).cast("string")))
    r = F.col(out)
    return found.withColumn(
        out,
        F.struct(
            F.when(lettered, r["nearest"]).otherwise(UNKNOWN).alias("nearest"),
            F.when(lettered, r["score"]).otherwise(0.0).alias("score"),
            (~lettered | r["rejected"]).alias("rejected"),
            F.when(lettered & ~r["rejected"], r["nearest"]).otherwise(UNKNOWN).alias("lang"),
        ),
    )


def fold(key: Column, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds`` (a null key counts as empty text)."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % folds

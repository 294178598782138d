"""Plain-Python restatements of the operators' results, for small fixtures."""

from __future__ import annotations

import math
import re
import zlib

import xxhash

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
M64 = (1 << 64) - 1


def words(text, pattern=SPACED, lower=False):
    text = text or ""
    return pattern.findall(text.translate(LOWER) if lower else text)


# -- hashed n-grams


def mix(x):
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 & M64
    x ^= x >> 27
    x = x * 0x94D049BB133111EB & M64
    return x ^ x >> 31


def word_hash(word, seed):
    step, total = 0x9E3779B97F4A7C15 | 1, 0
    for k, b in enumerate(word.encode()):
        total += mix(((b + 1) * 0xD1342543DE82EF95 + 2 * seed + 1) & M64) * pow(step, k, 1 << 64)
    return mix((total + len(word.encode()) * 0xA24BAED4963EE407) & M64)


def window_hash(hashes, seed):
    total = 0
    for j, h in enumerate(hashes):
        total += h * (mix(((j + 1) * 0x9E3779B97F4A7C15 + seed) & M64) | 1)
    return mix(total & M64)


def cells(text, bits=15):
    h = [word_hash(w, 7) for w in words(text, lower=True)]
    one = [x >> 64 - bits for x in h]
    return one, [(window_hash(p, 11) >> 64 - bits) + (1 << bits) for p in zip(h, h[1:])]


def log_ratio(texts, trusted, bits=15, smoothing=1.0):
    size = 1 << bits
    raw, target = [0] * 2 * size, [0] * 2 * size
    for text, good in zip(texts, trusted):
        for c in sum(cells(text, bits), []):
            raw[c] += 1
            target[c] += good
    out = [0.0] * 2 * size
    for part in (range(size), range(size, 2 * size)):
        r, t = sum(raw[c] for c in part), sum(target[c] for c in part)
        if t:
            for c in part:
                p = (raw[c] + smoothing) / (r + smoothing * size)
                out[c] = math.log((target[c] + smoothing * size * p) / (t + smoothing * size)) - math.log(p)
    return out


def base(text):
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if SPACED.search(x)]
    seen, hit = {}, set()
    for i in range(len(w) - 7):
        seen.setdefault(tuple(w[i : i + 8]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            hit.update(i + k for i in at for k in range(8))
    return {
        "n_words": len(w),
        "word_chars": sum(map(len, w)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(hit),
    }


def quality(texts, trusted, threshold):
    ratio = log_ratio(texts, trusted)
    out = []
    for text in texts:
        q = base(text)
        grams = sum(cells(text), [])
        q["llr"] = sum(ratio[c] for c in grams) / max(1, len(grams))
        q["base_failed"] = q["n_words"] < 20 or 100 * q["n_repeat_words"] > 30 * q["n_words"]
        q["kept"] = not q["base_failed"] and q["llr"] >= threshold
        out.append(q)
    return out


# -- SimHash


def fingerprint(text, k=4):
    w = words(text, lower=True)
    grams = [" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(ids, texts, radius=4):
    prints = [fingerprint(t) for t in texts]
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    low = {}
    for i, key in enumerate(ids):
        if key is not None:
            low[find(i)] = min(low.get(find(i), key), key)
    return [(f"{p:016x}", low.get(find(i))) for i, p in enumerate(prints)]


# -- decontamination


def contamination(text, items, window=13):
    """(n_words, hit positions, item ids)"""
    w = words(text, ALNUM, lower=True)
    hit, found = set(), set()
    for item, item_text in items:
        v = words(item_text, ALNUM, lower=True)
        k = min(len(v), window)
        keys = {tuple(v[i : i + k]) for i in range(len(v) - k + 1)} if v else set()
        for i in range(len(w) - k + 1):
            if keys and tuple(w[i : i + k]) in keys:
                hit.update(range(i, i + k))
                found.add("" if item is None else str(item))
    return len(w), hit, sorted(found)


# -- repeats


def repeated(texts, length, first_stays=False):
    """Per text the positions of words in windows that occur elsewhere (or earlier)."""
    lists = [words(t) for t in texts]
    seen = {}
    for d, w in enumerate(lists):
        for i in range(len(w) - length + 1):
            seen.setdefault(tuple(w[i : i + length]), []).append((d, i))
    out = [set() for _ in texts]
    for places in seen.values():
        if len(places) > 1:
            for d, i in places[1 if first_stays else 0 :]:
                out[d].update(range(i, i + length))
    return lists, out


def tokens_crc(ids):
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))

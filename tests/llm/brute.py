"""Plain versions of operators for the tests: one document after another, no Spark."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import xxhash

from tripcraft.llm import resampling
from tripcraft.llm.common import ngram_hash, prefix_hash, span_hash

TOKEN = re.compile(rb"[0-9A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff\x20\x09-\x0d]+")


def _bucket_of_token(token):
    data = np.frombuffer(token, np.uint8)
    return span_hash(prefix_hash(data), np.array([0]), np.array([len(data)]))[0]


def _buckets(text):
    tokens = [_bucket_of_token(t) for t in TOKEN.findall((text or "").encode())]
    pairs = [np.uint64(0) if a == b else ngram_hash(np.array([a, b], np.uint64), 2)[0] for a, b in zip(tokens, tokens[1:])]
    return Counter(int(h) % resampling.BUCKETS for h in tokens + pairs)


def _fold(i):
    return zlib.crc32((str(i) if i is not None else "").encode()) % 2


def brute_resampling(data, marks):
    """[(doc_id, log weight, key)] of all (doc_id, text) rows, and the size of the default sample."""
    lowest = {}
    for i, q in marks:
        if i is not None and q is not None:
            lowest[i] = min(q, lowest.get(i, q))
    grams = [(i, _buckets(t)) for i, t in data]
    raw, target = Counter(), Counter()
    for i, g in grams:
        raw.update(g)
        if lowest.get(i) == 1 and _fold(i) == 0:
            target.update(g)
    n_raw, n_target = sum(raw.values()), max(sum(target.values()), 1)

    def ratio(b):
        p = (raw[b] + 1) / (n_raw + resampling.BUCKETS)
        return math.log((target[b] / n_target + p) / 2) - math.log(p)

    out = []
    for (i, text), (_, g) in zip(data, grams, strict=True):
        weight = sum(n * ratio(b) for b, n in g.items())
        drawn = xxhash.xxh64_intdigest(f"{i}\0".encode() + (text or "").encode(), resampling.SEED)
        uniform = (float(drawn) + 0.5) / 2.0 ** 64 * (1 - 2e-16) + 1e-16
        out.append((i, weight, weight - math.log(-math.log(uniform))))
    good = sorted(key for i, _, key in out if lowest.get(i) == 1 and _fold(i) == 1)
    if not good:
        return out, len(out)
    place = (1 - resampling.KEEP) * (len(good) - 1)
    low = math.floor(place)
    border = good[low] + (place - low) * (good[min(low + 1, len(good) - 1)] - good[low])
    return out, sum(key >= border - 1e-9 for _, _, key in out)

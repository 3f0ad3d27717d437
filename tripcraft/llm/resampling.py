"""Operator 2, quality by importance resampling on hashed n-gram models.

Two bag models over hashed words and word pairs are counted: one for target
text (documents labelled of good quality), one for all raw text. A document's
log weight is the sum of log(target / raw) over its n-grams; Gumbel noise on
top turns taking the k largest into sampling k documents without replacement in
proportion to their weights.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripcraft.llm.common import (
    BYTE_CLASS, fold, ngram_hash, prefix_hash, span_hash, text_pieces, word_spans, write_table,
)

BUCKETS = 1 << 12
#: Labelled documents that are learned from (at most, by hash order): one half gives
#: the target model, the other the border between good and bad documents.
LABELLED = 20_000
#: Share of good documents that the sample's size is chosen to keep.
KEEP = 0.999
SEED = 17


def hashed_ngrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, document) of every token and every pair of neighbours.

    Tokens are runs of letters and digits, or of other visible bytes; case counts.
    All pairs of equal tokens are one n-gram.
    """
    kind = BYTE_CLASS[data]
    hashes = prefix_hash(data)
    spans = [word_spans(data, offsets, kind == k)[:2] for k in (1, 2)]
    starts, ends = (np.concatenate(x) for x in zip(*spans, strict=True))
    order = np.argsort(starts)
    token = span_hash(hashes, starts[order], ends[order])
    doc = np.searchsorted(offsets, starts[order], "right") - 1
    pair = np.where(token[1:] == token[:-1], np.uint64(0), ngram_hash(token, 2))
    inside = doc[1:] == doc[:-1]
    return (np.r_[token, pair[inside]] % np.uint64(BUCKETS)).astype(np.int64), np.r_[doc, doc[1:][inside]]


def counted(rows: DataFrame, column: str = "text") -> np.ndarray:
    """Occurrences of every bucket over all rows."""

    def count(batches):
        total = np.zeros(BUCKETS, np.int64)
        for _, data, offsets in text_pieces(batches, column):
            total += np.bincount(hashed_ngrams(data, offsets)[0], minlength=BUCKETS)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["bucket", "count"])

    out = np.zeros(BUCKETS)
    summed = rows.select(column).mapInArrow(count, "bucket long, count long").groupBy("bucket").agg(F.sum("count"))
    for bucket, count_ in summed.collect():  # at most BUCKETS rows
        out[bucket] = count_
    return out


def log_ratio(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """log(p_target / p_raw) of each bucket.

    The target model is mixed half and half with the raw one, which bounds what
    the n-grams can cost that its documents happen to lack.
    """
    raw = (raw + 1) / (raw.sum() + BUCKETS)
    return np.log((target / max(target.sum(), 1) + raw) / 2) - np.log(raw)


def gumbel(ids: list, texts: list) -> np.ndarray:
    """Standard Gumbel noise, fixed by id and text."""
    draw = [xxhash.xxh64_intdigest(f"{i}\0".encode() + t, SEED) for i, t in zip(ids, texts, strict=True)]
    return -np.log(-np.log((np.array(draw, np.float64) + 0.5) / 2.0 ** 64 * (1 - 2e-16) + 1e-16))


def _weigh(rows, data, offsets, ratio: np.ndarray, key: str) -> tuple[np.ndarray, np.ndarray]:
    """(log weight, log weight plus Gumbel noise) of a piece's documents."""
    bucket, doc = hashed_ngrams(data, offsets)
    weight = np.bincount(doc, weights=ratio[bucket], minlength=rows.num_rows)
    texts = [data[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    return weight, weight + gumbel(rows.column(key).to_pylist(), texts)


def weighted(docs: DataFrame, ratio: np.ndarray, keep: str = "doc_id") -> DataFrame:
    """``keep`` (long) with log_weight and _key (log weight plus Gumbel noise) of (doc_id, text) rows."""

    def weigh(batches):
        for rows, data, offsets in text_pieces(batches):
            weight, noisy = _weigh(rows, data, offsets, ratio, "doc_id")
            yield pa.RecordBatch.from_arrays([rows.column("kept"), pa.array(weight), pa.array(noisy)],
                                             ["kept", "log_weight", "_key"])

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col(keep).cast("long").alias("kept"))
    return rows.mapInArrow(weigh, "kept long, log_weight double, _key double").withColumnRenamed("kept", keep)


def kth_largest(keys: DataFrame, k: int) -> float:
    """The k-th largest ``_key``, exactly: counts in ever narrower bins, never the keys themselves."""
    low, high = keys.agg(F.min("_key"), F.max("_key")).first()
    if low is None or k < 1:
        return float("inf")
    while low < high:
        width = (high - low) / 4096
        if width <= 0 or low + width == low:
            break
        bins = (keys.where(F.col("_key").between(low, high))
                .groupBy(F.least(F.floor((F.col("_key") - low) / width), F.lit(4095)).alias("bin"))
                .agg(F.count("*").alias("n"), F.min("_key").alias("lo"), F.max("_key").alias("hi"))
                .orderBy(F.desc("bin")).collect())  # at most 4096 rows
        for row in bins:
            if row["n"] >= k:
                low, high = row["lo"], row["hi"]
                break
            k -= row["n"]
        else:
            return low
    return low if low == high else _largest(keys, low, high, k)


def _largest(keys: DataFrame, low: float, high: float, k: int) -> float:
    """k-th largest among the few neighbouring doubles that a bin can't part."""
    rows = keys.where(F.col("_key").between(low, high)).groupBy("_key").count().orderBy(F.desc("_key")).collect()
    for row in rows:
        k -= row["count"]
        if k <= 0:
            return row["_key"]
    return low


class Sampler:
    """Models and threshold: documents whose key reaches ``threshold`` are the sample."""

    def __init__(self, docs: DataFrame, labels: DataFrame, k: int | None = None, labelled: int = LABELLED):
        """k: sample size; None: the number of documents whose key reaches what KEEP of the good ones reach."""
        some = (labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
                .groupBy("doc_id").agg(F.min("quality").cast("int").alias("_quality"))
                .orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled))
        own = write_table(docs.select("doc_id", "text").join(F.broadcast(some), "doc_id"), "labelled")
        raw = counted(docs)
        half = fold("doc_id", 2)
        self.ratio = log_ratio(counted(own.where((F.col("_quality") == 1) & (half == 0))), raw)
        good = (weighted(own.where((F.col("_quality") == 1) & (half == 1)), self.ratio)
                .select("_key").collect())  # at most ``labelled`` rows
        border = np.quantile([r[0] for r in good], 1 - KEEP) if good else float("-inf")
        keys = write_table(weighted(docs, self.ratio), "keys")
        self.k = keys.where(F.col("_key") >= float(border)).count() if k is None else k
        self.keys, self.threshold = keys, kth_largest(keys, self.k)

    def rows(self, docs: DataFrame) -> DataFrame:
        """The sampled rows of ``docs`` with all their columns (rows tied with the k-th stay)."""
        ratio, threshold = self.ratio, self.threshold

        def keep(batches):
            for rows, data, offsets in text_pieces(batches):
                yield rows.filter(pa.array(_weigh(rows, data, offsets, ratio, "doc_id")[1] >= threshold))

        return docs.mapInArrow(keep, docs.schema)

    def report(self) -> DataFrame:
        """doc_id, log_weight and gumbel_key of the sampled documents."""
        return self.keys.where(F.col("_key") >= self.threshold).select(
            "doc_id", "log_weight", F.col("_key").alias("gumbel_key"))


def op2(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The sample of all documents: doc_id, log_weight, gumbel_key.

    Without good labelled documents all stay. Null and empty texts have log weight 0. Repeated rows share their noise, so
    they stay or go together; a null id counts as the text ``None`` there.
    Other columns, also with clashing names, are ignored.
    """
    return Sampler(docs.select("doc_id", "text"), labels).report()

"""Operator 9, language identification by rank-order n-gram profiles.

A language's profile holds its most frequent n-grams of one to three letters
in order. A document's own profile is compared to each by the out-of-place
distance: how far every n-gram stands from its place there, with the profile's
size for n-grams that it lacks. The nearest language wins.
"""

from __future__ import annotations

import functools
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripcraft.llm.common import fold, write_table

#: N-grams of a profile, and document ids of each language that it is learned from (at most, by hash order).
PROFILE = 300
TRAINING_DOCS = 1500
#: Characters whose n-grams are counted at once while learning.
COUNT_CHARS = 1 << 18
#: Languages whose sampling borders are sent to every task; with more they are joined by shuffle.
BROADCAST_LANGS = 10_000
UNKNOWN = "und"
FOLDS, HELD_OUT = 4, 2


@functools.cache
def _letters() -> np.ndarray:
    """Lower-case code point of every letter; a space for everything else."""
    out = np.full(0x110000, 32, np.int64)
    for c in range(0x110000):
        s = chr(c)
        if s.isalpha():
            low = s.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def ngrams(text: str | None) -> np.ndarray:
    """Codes of all n-grams of one to three characters; words are bounded by one space."""
    code = np.frombuffer((text or "").encode("utf-32-le", "replace"), np.uint32)
    chars = np.r_[32, _letters()[code], 32]
    chars = chars[np.r_[True, (chars[1:] != 32) | (chars[:-1] != 32)]]
    if len(chars) < 2:
        return np.zeros(0, np.int64)
    pairs = chars[:-1] << 21 | chars[1:]
    return np.concatenate([chars[chars != 32], pairs, pairs[:-1] << 21 | chars[2:]])


def ranked(codes: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The most frequent codes in order; equal counts by code."""
    return codes[np.lexsort((codes, -counts))[:size]]


def _count(batches):
    """Occurrences of n-grams by language, a bounded number of characters (or one text) at a time."""
    for batch in batches:
        rows, texts = defaultdict(list), batch.column("text")
        for at, lang in enumerate(batch.column("lang").to_pylist()):
            rows[lang].append(at)
        for lang, places in rows.items():
            held, size = [], 0
            for at in places:
                text = texts[at].as_py()
                held.append(ngrams(text))
                size += len(text)
                if size >= COUNT_CHARS or at == places[-1]:
                    codes, counts = np.unique(np.concatenate(held), return_counts=True)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([lang] * len(codes), pa.string()), pa.array(codes, pa.int64()),
                        pa.array(counts, pa.int64())], ["lang", "code", "count"])
                    held, size = [], 0


def training_rows(docs: DataFrame, limit: int = TRAINING_DOCS) -> DataFrame:
    """lang and text of the rows of the learning folds whose id is among the first ``limit`` of its language.

    Ids are taken once each, in the order of their hash, so a rare language is
    learned from all it has at any size of the table and a repeated id takes one
    place. Rows without id, language or text teach nothing.
    """
    known = docs.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull()
                       & (fold("doc_id", FOLDS) != HELD_OUT)).select(
        "lang", "text", F.xxhash64(F.col("doc_id").cast("long")).alias("_order"))
    first = Window.partitionBy("lang").orderBy("_order")
    border = (known.groupBy("lang", "_order").agg(F.lit(1)).withColumn("_place", F.row_number().over(first))
              .where(F.col("_place") <= limit).groupBy("lang").agg(F.max("_order").alias("_last")))
    rows = border.limit(BROADCAST_LANGS + 1).collect()
    few = len(rows) <= BROADCAST_LANGS
    if few:
        border = docs.sparkSession.createDataFrame(pa.table({  # from Arrow: executors start no Python for it
            "lang": pa.array([r["lang"] for r in rows], pa.string()),
            "_last": pa.array([r["_last"] for r in rows], pa.int64())}))
    else:
        border = write_table(border, "borders")
    return (known.join(F.broadcast(border) if few else border, "lang")
            .where(F.col("_order") <= F.col("_last")).select("lang", "text"))


def learn(docs: DataFrame, size: int = PROFILE, limit: int = TRAINING_DOCS) -> dict[str, np.ndarray]:
    """Profiles by language from ``training_rows``; equally frequent n-grams stand by code."""
    grams = (training_rows(docs, limit).mapInArrow(_count, "lang string, code long, count long")
             .groupBy("lang", "code").agg(F.sum("count").alias("count")))
    first = Window.partitionBy("lang").orderBy(F.desc("count"), "code")
    top = grams.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= size)
    out: dict[str, list] = {}
    for row in sorted(top.select("lang", "rank", "code").collect()):  # languages x size rows
        out.setdefault(row["lang"], []).append(row["code"])
    return {lang: np.array(codes, np.int64) for lang, codes in out.items()}


class Ranker:
    """Out-of-place distances to all profiles at once."""

    def __init__(self, profiles: dict[str, np.ndarray], size: int):
        self.size, self.langs = size, sorted(profiles)
        self.codes = np.unique(np.concatenate([*profiles.values(), np.zeros(0, np.int64)]))
        self.place = np.full((len(self.langs), len(self.codes) + 1), -1, np.int64)
        for i, lang in enumerate(self.langs):
            self.place[i, np.searchsorted(self.codes, profiles[lang])] = np.arange(len(profiles[lang]))

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, score): score is the second distance's share of the best two, 0 where none is known."""
        grams = ngrams(text)
        if not len(grams) or not self.langs:
            return UNKNOWN, 0.0
        grams.sort()
        first = np.flatnonzero(np.r_[True, grams[1:] != grams[:-1]])
        own = ranked(grams[first], np.diff(np.r_[first, len(grams)]), self.size)
        at = np.minimum(np.searchsorted(self.codes, own), len(self.codes) - 1)
        place = np.where(self.codes[at] == own, self.place[:, at], -1)
        away = np.where(place < 0, self.size, np.abs(place - np.arange(len(own)))).sum(1)
        best = int(np.argmin(away))
        if len(away) == 1:
            return self.langs[best], 1.0
        second = int(np.partition(away, 1)[1])
        return self.langs[best], second / (second + int(away[best])) if second else 0.5


def identify(docs: DataFrame, profiles: dict[str, np.ndarray], size: int = PROFILE) -> DataFrame:
    """doc_id, lang_pred, score for every row.

    Texts that are null or without a letter get ``und`` and score 0; ties go to
    the language that sorts first. Repeated rows and null ids give rows of
    their own; other columns are ignored. Without any profile all get ``und``.
    """

    def rank(batches):
        ranker = Ranker(profiles, size)
        for batch in batches:
            found = [ranker.predict(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array([f[0] for f in found], pa.string()),
                pa.array([f[1] for f in found], pa.float64())], ["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(rank, "doc_id long, lang_pred string, score double")


def op9(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row; empty tables have none, texts are read whole."""
    return identify(docs, learn(docs)).select(
        "doc_id", (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "lang_pred", "score")

"""Operator 5, toxicity from the nearest labelled examples by exact TF-IDF cosine.

Every word of a text is a term. Document frequencies are counted over all
documents; a term weighs more the more its presence depends on the label (square
root of one plus its chi-square over the learning documents), none weighs
nothing. Examples lie in blocks of alike ones, and each term's postings keep the
largest weight of every block that holds it. What those maxima add up to bounds the
cosines of a block; blocks whose bound is below the k-th best cosine aren't read, so
the search is exact. Some texts are searched at a time: a block's common terms lie in
a matrix, whose product with the texts that need the block adds them up, the others in
posting lists. Neighbours vote by inverse distance; votes are calibrated on the examples themselves, each
left out of its own search.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripcraft.llm.common import (
    BYTE_CLASS, fold, lower_ascii, span_digest, text_pieces, word_spans, write_table,
)

#: Labelled documents that are learned from (at most, by hash order).
EXAMPLES = 8000
NEIGHBOURS = 25
#: Examples of a block of postings, blocks that are read first, and terms that examples are clustered by.
BLOCK = 128
FIRST_BLOCKS = 2
CLUSTER_TERMS = 1024
#: Terms that one in so many examples holds, so many of them at most, have a weight for every example instead of postings.
COMMON_SHARE, COMMON_TERMS = 16, 1024
#: Vectors that are searched at a time, and postings of theirs (a vector with more is searched alone).
QUERIES, QUERY_POSTINGS = 48, 1 << 22
FOLDS, HELD_OUT = 5, 0


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of every word: runs of letters and digits, A-Z as a-z."""
    data = lower_ascii(data)
    starts, ends, at = word_spans(data, offsets, BYTE_CLASS[data] == 1)
    return span_digest(data, starts, ends).view(np.int64), np.repeat(np.arange(len(at) - 1), np.diff(at))


@dataclass
class Vocabulary:
    """Sorted hashes of the examples' terms and their weights; ``other`` is the weight of a term in no example.

    Such a term has no part in a product, only in the length of the vector;
    there it counts as a term of one document.
    """

    terms: np.ndarray
    weight: np.ndarray
    other: float

    def find(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of each word, whether it is a known term)."""
        if not len(self.terms):
            return np.zeros(len(words), np.int64), np.zeros(len(words), bool)
        at = np.minimum(np.searchsorted(self.terms, words), len(self.terms) - 1)
        return at, self.terms[at] == words

    def vectors(self, data: np.ndarray, offsets: np.ndarray):
        """(begin of each document, term numbers, weights, words of each document); with other terms of unit length."""
        words, doc = terms(data, offsets)
        n = len(offsets) - 1
        at, known = self.find(words)
        size = np.bincount(doc, minlength=n)
        key, count = np.unique(doc[known] * max(len(self.terms), 1) + at[known], return_counts=True)
        own, term = np.divmod(key, max(len(self.terms), 1))
        weight = (1 + np.log(count)) * self.weight[term]
        words, doc = words[~known], doc[~known]
        order = np.lexsort((words, doc))
        words, doc = words[order], doc[order]
        first = np.flatnonzero(np.r_[True, (words[1:] != words[:-1]) | (doc[1:] != doc[:-1])][:len(words)])
        rest = (1 + np.log(np.diff(np.r_[first, len(words)]))) * self.other
        square = (np.bincount(own, weights=weight ** 2, minlength=n)
                  + np.bincount(doc[first], weights=rest ** 2, minlength=n))
        return np.searchsorted(own, np.arange(n + 1)), term, weight / np.sqrt(square)[own], size


def _ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... for every range of ``count`` numbers."""
    end = np.cumsum(count)
    out = np.repeat(first - end + count, count)
    out += np.arange(len(out))
    return out


class Index:
    """The examples' vectors, and postings (example, weight) of each term with the largest weight of each block."""

    def __init__(self, ids, toxic, vectors, n_terms: int):
        order = sorted(range(len(ids)), key=lambda i: ids[i])
        self.ids, self.toxic = np.array(ids, np.int64)[order], np.array(toxic, float)[order]
        size = [len(vectors[i][0]) for i in order]
        self.begin = np.r_[0, np.cumsum(size)].astype(np.int64)
        self.term = np.concatenate([np.zeros(0, np.int32), *(vectors[i][0] for i in order)]).astype(np.int32, copy=False)
        self.weight = np.concatenate([np.zeros(0), *(vectors[i][1] for i in order)])
        #: Place of every example in the order of the blocks.
        self.place = np.empty(len(order), np.int64)
        self.origin = self._alike(n_terms)
        self.place[self.origin] = np.arange(len(order))
        place = np.repeat(self.place, size)
        by_term = np.lexsort((place, self.term))
        term, self.example, self.posted = self.term[by_term], place[by_term].astype(np.int32), self.weight[by_term]
        del place, by_term
        block = self.example // BLOCK
        start = np.flatnonzero(np.r_[True, (term[1:] != term[:-1]) | (block[1:] != block[:-1])][:len(term)])
        # An entry per term and block that holds it: the block, its largest weight and where its postings begin.
        self.block = block[start]
        self.most = np.maximum.reduceat(self.posted, start) if len(start) else np.zeros(0)
        self.start = np.r_[start, len(term)]
        self.count = np.diff(self.start).astype(np.int32)
        self.first = np.searchsorted(term[start], np.arange(n_terms + 1))
        held = np.bincount(self.term, minlength=n_terms)
        common = np.argsort(-held, kind="stable")[:COMMON_TERMS]
        common = common[held[common] * COMMON_SHARE >= max(len(order), 1)]
        #: Column of each common term in ``dense``, -1 for others.
        self.column = np.full(n_terms, -1)
        self.column[common] = np.arange(len(common))
        self.dense = self.peak = None
        self.blocks_read = 0
        self.known: dict[bytes, tuple] = {}

    def _alike(self, n_terms: int) -> np.ndarray:
        """The examples in an order that puts alike ones into one block: clusters by their commonest terms."""
        n = len(self.ids)
        groups = n // BLOCK
        if groups < 2:
            return np.arange(n)
        common = np.argsort(-np.bincount(self.term, minlength=n_terms), kind="stable")[:CLUSTER_TERMS]
        column = np.full(n_terms, -1)
        column[common] = np.arange(len(common))
        rows, held = np.repeat(np.arange(n), np.diff(self.begin)), column[self.term] >= 0
        dense = np.zeros((n, len(common)), np.float32)
        dense[rows[held], column[self.term[held]]] = self.weight[held]

        def unit(x):
            return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)

        dense = unit(dense)
        centre = dense[np.linspace(0, n - 1, groups).astype(int)]
        for _ in range(5):
            group = (dense @ centre.T).argmax(1)
            total = np.zeros_like(centre)
            np.add.at(total, group, dense)
            centre = unit(total)
        rank = np.argsort(np.argsort(centre @ centre.mean(0), kind="stable"), kind="stable")
        return np.lexsort((rank[group], self.toxic))

    def __getstate__(self):
        """Workers get the postings only."""
        return self.__dict__ | {"begin": None, "term": None, "weight": None, "known": {}, "dense": None}

    def _densify(self, n_blocks: int) -> None:
        """Weights of the common terms in every example, and their largest of every block."""
        terms = np.flatnonzero(self.column >= 0)
        self.dense = np.zeros((len(terms), n_blocks * BLOCK))
        for t in terms:
            mine = slice(self.start[self.first[t]], self.start[self.first[t + 1]])
            self.dense[self.column[t], self.example[mine]] = self.posted[mine]
        self.peak = self.dense.reshape(len(terms), n_blocks, BLOCK).max(2)

    def nearest(self, term: np.ndarray, weight: np.ndarray, k: int = NEIGHBOURS, without: int = -1):
        """As ``nearest_of``, for one vector."""
        return self.nearest_of(np.array([0, len(term)]), term, weight, k, [without] if without >= 0 else None)[0]

    def nearest_of(self, begin: np.ndarray, term: np.ndarray, weight: np.ndarray, k: int = NEIGHBOURS,
                   without: list[int] | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        """(positions, cosines) of each vector's k nearest examples with a common term; ties to the smaller position.

        Vectors are searched some at a time, so that a block is read once for all of them.
        """
        if not len(self.ids):
            return [(np.zeros(0, np.int64), np.zeros(0))] * (len(begin) - 1)
        held = np.r_[0, np.cumsum(self.start[self.first[term + 1]] - self.start[self.first[term]])][begin]
        out, x = [], 0
        while x < len(begin) - 1:
            fit = int(np.searchsorted(held, held[x] + QUERY_POSTINGS, "right")) - 1
            y = min(x + QUERIES, len(begin) - 1, max(x + 1, fit))
            some = slice(begin[x], begin[y])
            out += self._search(begin[x:y + 1] - begin[x], term[some], weight[some], k,
                                without[x:y] if without is not None else None)
            x = y
        return out

    def _search(self, begin, term, weight, k, without):
        n_blocks, n = -(-len(self.ids) // BLOCK), len(begin) - 1
        if self.dense is None:
            self._densify(n_blocks)
        query = np.repeat(np.arange(n), np.diff(begin))
        column = self.column[term]
        common = column >= 0
        x = np.zeros((n, len(self.dense)))
        x[query[common], column[common]] = weight[common]
        query, term, weight = query[~common], term[~common], weight[~common]
        size = self.first[term + 1] - self.first[term]
        entry, weight = _ranges(self.first[term], size), np.repeat(weight, size)
        cell = np.repeat(query * n_blocks, size) + self.block[entry]
        bound = x @ self.peak + np.bincount(
            cell, weights=self.most[entry] * weight, minlength=n * n_blocks).reshape(n, n_blocks)
        cosine = np.zeros((n, n_blocks * BLOCK))

        def read(wanted):
            for b in np.flatnonzero(wanted.any(0)):
                mine, block = np.flatnonzero(wanted[:, b]), slice(b * BLOCK, (b + 1) * BLOCK)
                cosine[mine, block] = x[mine] @ self.dense[:, block]
            mine = np.flatnonzero(wanted.ravel()[cell])
            count = self.count[entry[mine]]
            posting = _ranges(self.start[entry[mine]], count)
            part = np.repeat(weight[mine], count)
            part *= self.posted[posting]
            at = np.repeat(cell[mine] // n_blocks * cosine.shape[1], count)
            at += self.example[posting]
            cosine.ravel()[:] += np.bincount(at, weights=part, minlength=cosine.size)
            if without is not None:
                cosine[np.arange(n), self.place[without]] = 0
            self.blocks_read += int(wanted.sum())

        # First the most promising blocks, then all whose bound reaches the k-th best of those.
        few = min(FIRST_BLOCKS, n_blocks)
        best = np.argpartition(-bound, few - 1, axis=1)[:, :few]
        first = np.zeros(bound.shape, bool)
        np.put_along_axis(first, best, True, 1)
        first &= bound > 0
        read(first)
        least = np.zeros(n)
        if few * BLOCK >= k:
            scores = cosine.reshape(n, n_blocks, BLOCK)[np.arange(n)[:, None], best].reshape(n, -1)
            least = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
        read((bound > 0) & (bound >= least[:, None] - 1e-9) & ~first)
        out = []
        for row, floor in zip(cosine, least, strict=True):
            at = np.flatnonzero(row > max(floor - 1e-9, 0))
            if len(at) > k:
                # Those that may round to the k-th best.
                at = at[row[at] > np.partition(row[at], len(at) - k)[len(at) - k] - 2e-12]
            score, at = np.round(row[at], 12), self.origin[at]
            order = np.lexsort((at, -score))[:k]
            order = order[score[order] > 0]
            out.append((at[order], score[order]))
        return out

    def vote(self, term: np.ndarray, weight: np.ndarray):
        """As ``votes``, for one vector."""
        return self.votes(np.array([0, len(term)]), term, weight)[0]

    def votes(self, begin: np.ndarray, term: np.ndarray, weight: np.ndarray,
              without: list[int] | None = None) -> list[tuple]:
        """(share of toxic votes or None, ids of the nearest examples) of every vector; votes weigh inverse distances."""
        if without is not None:
            return [self._vote(*found) for found in self.nearest_of(begin, term, weight, without=without)]
        if len(self.known) >= 100_000:
            self.known.clear()
        keys = [hashlib.blake2b(term[x:y].tobytes() + weight[x:y].tobytes(), digest_size=16).digest()
                for x, y in zip(begin[:-1], begin[1:], strict=True)]
        new = np.array(sorted({key: i for i, key in enumerate(keys) if key not in self.known}.values()), np.int64)
        size = np.diff(begin)[new]
        at = _ranges(begin[new], size)
        for i, found in zip(new, self.nearest_of(np.r_[0, np.cumsum(size)], term[at], weight[at]), strict=True):
            self.known[keys[i]] = self._vote(*found)
        return [self.known[key] for key in keys]

    def _vote(self, at: np.ndarray, cosine: np.ndarray):
        if not len(at):
            return None, []
        votes = 1 / (0.05 + 1 - np.minimum(cosine, 1))
        return float(votes @ self.toxic[at] / votes.sum()), self.ids[at[:3]].tolist()


@dataclass
class Model:
    #: A broadcast of (vocabulary, index), which are sent once and not with each function.
    shared: Broadcast
    #: Rising calibration of votes, and the scores without a neighbour or without a term.
    votes: np.ndarray
    scores: np.ndarray
    without_neighbour: float
    without_term: float

    @property
    def vocabulary(self) -> Vocabulary:
        return self.shared.value[0]

    @property
    def index(self) -> Index:
        return self.shared.value[1]

    def score(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[float, list[int]]]:
        """(score, evidence) of every text."""
        begin, term, weight, size = self.vocabulary.vectors(data, offsets)
        out = []
        for (vote, evidence), words in zip(self.index.votes(begin, term, weight), size, strict=True):
            if not words:
                out.append((self.without_term, []))
            elif vote is None:
                out.append((self.without_neighbour, evidence))
            else:
                out.append((float(np.interp(vote, self.votes, self.scores)), evidence))
        return out


def _rate(toxic: np.ndarray, prior: float) -> float:
    return (float(toxic.sum()) + prior) / (len(toxic) + 1)


def rising(votes: np.ndarray, toxic: np.ndarray, prior: float, bins: int = 20):
    """Calibration points (vote, rate): means of equal bins, pooled until they rise."""
    order = np.argsort(votes, kind="stable")
    pools: list[list[float]] = []
    for part in np.array_split(order, max(1, min(bins, len(order) // 20))):
        if not len(part):
            continue
        pools.append([len(part) + 1, toxic[part].sum() + prior, votes[part].sum() + votes[part].mean()])
        while len(pools) > 1 and pools[-2][1] / pools[-2][0] >= pools[-1][1] / pools[-1][0]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    if not pools:
        return np.array([0.0]), np.array([prior])
    n, y, x = np.array(pools).T
    return x / n, y / n


def learn(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES) -> Model:
    """Vocabulary, index and calibration from ``examples`` labelled documents of the learning folds."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    some = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()
                         & (fold("doc_id", FOLDS) != HELD_OUT))
            .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(examples))
    rows = write_table(texts.join(F.broadcast(some), "doc_id"), "labelled")

    def count(batches):
        for piece, data, offsets in text_pieces(batches):
            word, doc = terms(data, offsets)
            toxic = piece.column("toxic").to_numpy()
            order = np.lexsort((doc, word))
            word, doc = word[order], doc[order]
            keep = np.r_[True, (word[1:] != word[:-1]) | (doc[1:] != doc[:-1])][:len(word)]
            word, hit = word[keep], toxic[doc[keep]].astype(float)
            own, at = np.unique(word, return_inverse=True)
            yield pa.RecordBatch.from_arrays([
                pa.array(own), pa.array(np.bincount(at, minlength=len(own))),
                pa.array(np.bincount(at, weights=hit, minlength=len(own)).astype(np.int64))], ["term", "n", "toxic"])

    counts = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")).first()
    n, n_toxic = counts["n"], counts["toxic"]
    seen = (rows.select("text", "toxic").mapInArrow(count, "term long, n long, toxic long")
            .groupBy("term").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))
            .orderBy("term").toArrow())  # the terms of at most ``examples`` documents
    known, df, a = (seen.column(c).to_numpy() for c in ("term", "n", "toxic"))
    a, df = a.astype(float), df.astype(float)
    chi = (n * (a * (n - df - n_toxic + a) - (df - a) * (n_toxic - a)) ** 2
           / np.maximum(df * (n - df) * max(n_toxic, 1) * max(n - n_toxic, 1), 1))
    places = Vocabulary(known, np.ones(len(known)), 1.0)

    def frequency(batches):
        total, found = 0, np.zeros(len(places.terms), np.int64)
        for piece, data, offsets in text_pieces(batches):
            words, doc = terms(data, offsets)
            at, hit = places.find(words)
            own = np.unique(doc[hit] * max(len(found), 1) + at[hit]) % max(len(found), 1)
            found += np.bincount(own, minlength=len(found))[:len(found)]
            total += piece.num_rows
        some = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array([None, *some.tolist()], pa.int64()),
                                          pa.array(np.r_[total, found[some]])], ["place", "n"])

    often = (texts.select("text").mapInArrow(frequency, "place long, n long")
             .groupBy("place").agg(F.sum("n").alias("n")).toArrow().to_pandas())
    total = int(often["n"][often["place"].isna()].sum())
    often = often[often["place"].notna()]
    df = np.zeros(len(known))
    df[often["place"].to_numpy(np.int64)] = often["n"]
    vocabulary = Vocabulary(known, (np.log((1 + total) / (1 + df)) + 1) * np.sqrt(1 + chi),
                            float(np.log((1 + total) / 2)) + 1 if total else 1.0)

    def vectorize(batches):
        for piece, data, offsets in text_pieces(batches):
            begin, term, weight, size = vocabulary.vectors(data, offsets)
            term = term.astype(np.int32)
            spans = list(zip(begin[:-1], begin[1:], strict=True))
            yield pa.RecordBatch.from_arrays([
                piece.column("doc_id"), piece.column("toxic").cast(pa.int64()), pa.array(size),
                pa.array([term[x:y].tobytes() for x, y in spans], pa.binary()),
                pa.array([weight[x:y].tobytes() for x, y in spans], pa.binary())],
                ["doc_id", "toxic", "size", "term", "weight"])

    found = (rows.mapInArrow(vectorize, "doc_id long, toxic long, size long, term binary, weight binary")
             .toArrow())  # at most ``examples`` vectors
    labels_of, sizes = found["toxic"].to_numpy(), found["size"].to_numpy()
    full = found.filter(pc.greater(found["size"], 0))
    # Views of the Arrow buffers; the index makes the only copy.
    vectors = [(np.frombuffer(t.as_buffer(), np.int32), np.frombuffer(w.as_buffer()))
               for t, w in zip(full["term"], full["weight"], strict=True)]
    index = Index(full["doc_id"].to_pylist(), full["toxic"].to_pylist(), vectors, len(known))
    del found, full, vectors
    prior = n_toxic / n if n else 0.0
    place = {int(d): i for i, d in enumerate(index.ids)}

    shared = docs.sparkSession.sparkContext.broadcast((vocabulary, index))
    del index  # the driver keeps the broadcast only

    def leave_out(batches):
        vocabulary, index = shared.value
        for piece, data, offsets in text_pieces(batches):
            begin, term, weight, size = vocabulary.vectors(data, offsets)
            some = np.flatnonzero(size)  # the others hold no term
            own = [place[d] for d in piece.column("doc_id").take(pa.array(some)).to_pylist()]
            found = index.votes(np.r_[begin[some], begin[-1]], term, weight, own)
            votes = list(zip(piece.column("toxic").take(pa.array(some)).to_pylist(), [f[0] for f in found], strict=True))
            yield pa.RecordBatch.from_arrays([pa.array([v[0] for v in votes], pa.int64()),
                                              pa.array([v[1] for v in votes], pa.float64())], ["toxic", "vote"])

    votes = rows.mapInArrow(leave_out, "toxic long, vote double").toPandas().sort_values(["vote", "toxic"])
    voted = votes["vote"].notna()
    points, rates = rising(votes["vote"][voted].to_numpy(float), votes["toxic"][voted].to_numpy(float), prior)
    return Model(shared, points, rates, _rate(votes["toxic"][~voted].to_numpy(float), prior),
                 _rate(labels_of[sizes == 0].astype(float), prior))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score (0 to 1, calibrated), predicted (score >= 0.5) and evidence for every row.

    evidence holds the ids of up to three nearest examples. Texts that are
    null, empty or without a word get the rate of such examples. Repeated
    rows and null ids give rows of their own; other columns are ignored.
    """

    def rate(batches):
        for piece, data, offsets in text_pieces(batches):
            found = model.score(data, offsets)
            yield pa.RecordBatch.from_arrays([
                piece.column("doc_id"), pa.array([f[0] for f in found], pa.float64()),
                pa.array([int(f[0] >= 0.5) for f in found], pa.int32()),
                pa.array([f[1] for f in found], pa.list_(pa.int64()))], ["doc_id", "score", "predicted", "evidence"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(rate, "doc_id long, score double, predicted int, evidence array<long>")


def op5(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, learn(docs, labels)).select(
        "doc_id", (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "score", "predicted", "evidence")

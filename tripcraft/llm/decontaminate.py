"""Operator 10, benchmark decontamination by the q-gram lemma and banded alignment.

Every run of SEGMENT or SHORT bytes of a benchmark item is a segment, wherever
it starts. A text that holds a segment with at most e edits shares at least
len - q + 1 - q * e of its q-grams with it, at as many places of the segment, all
within a diagonal band of width e. Q-grams of whole items are indexed and the places
of shared ones counted in overlapping bands, then in windows that slide over the item.
Windows that reach the bound are aligned (edit distance of the segment to any part of
the band; unbroken runs need none), and alignments within the budget are reported.
"""

from __future__ import annotations

import hashlib
import pickle

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripcraft.llm.common import lower_ascii, prefix_hash, solid_bytes, span_hash, text_pieces, write_table

Q = 8
#: Bytes of the segments (or a whole shorter item), and edits in hundredths of their length.
SEGMENT = 96
SHORT = 64
EDIT_PERCENT = 8
#: Benchmark bytes that one pass holds (some 40 times as many in a worker); a larger benchmark takes several passes.
PASS_BYTES = 4 << 20
#: Shared q-grams that are worked on at once; pieces with more are cut into overlapping slices.
HITS = 1 << 20
_FILTER_BITS = 22
_NEAREST: dict[bytes, "Segments"] = {}


def folded(data: np.ndarray) -> np.ndarray:
    """ASCII and Latin-1 capitals as small letters and every white space as a space, byte for byte."""
    out = np.where(solid_bytes(data), lower_ascii(data), np.uint8(32))
    second = np.r_[False, data[:-1] == 0xC3][:len(data)]  # of a Latin-1 letter in UTF-8
    out[second & (data >= 0x80) & (data <= 0x9E) & (data != 0x97)] += 32
    return out


def _inner(count: np.ndarray) -> np.ndarray:
    """0 to n - 1 for every n of ``count``."""
    return np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)


class Segments:
    """All segments of benchmark items, with an index of the items' q-grams.

    Only the items travel to the tasks; a worker builds the index of a pass once.
    """

    def __init__(self, items: list[tuple[int, str]]):
        self.items = items
        self._build(items)

    def __reduce__(self):
        packed = pickle.dumps(self.items)
        return _segments, (packed, hashlib.sha256(packed).digest())

    def _build(self, items: list[tuple[int, str]]) -> None:
        texts = [(item, folded(np.frombuffer((text or "").encode(), np.uint8))) for item, text in items]
        texts = [(item, text) for item, text in texts if len(text) >= 2 * Q]
        self.ids = np.array([item for item, _ in texts], np.int64)
        self.length = np.array([len(text) for _, text in texts], np.int64)
        self.flat = np.concatenate([np.zeros(0, np.uint8), *(text for _, text in texts)])
        self.begin = np.cumsum(self.length) - self.length
        self.longest = int(self.length.max()) if len(texts) else 0
        count = np.maximum(self.length - Q + 1, 0)
        inner = _inner(count)
        at = np.repeat(self.begin, count) + inner
        grams = span_hash(prefix_hash(self.flat), at, at + Q)
        order = np.argsort(grams, kind="stable")
        self.grams, first = np.unique(grams[order], return_index=True)
        self.first = np.r_[first, len(order)]
        self.owner = np.repeat(np.arange(len(texts)), count)[order]
        self.place = inner[order]
        self.present = np.zeros(1 << _FILTER_BITS, bool)
        self.present[(self.grams >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
        self.band = SEGMENT * EDIT_PERCENT // 100 + 1

    def grams_of(self, data: np.ndarray, offsets: np.ndarray):
        """(place in the piece, document, indexed q-gram) of the texts' q-grams that are in the index."""
        if len(data) < Q or not len(self.grams):
            return (np.zeros(0, np.int64),) * 3
        at = np.arange(len(data) - Q + 1)
        grams = span_hash(prefix_hash(data), at, at + Q)
        at = np.flatnonzero(self.present[(grams >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
        found = np.minimum(np.searchsorted(self.grams, grams[at]), len(self.grams) - 1)
        keep = self.grams[found] == grams[at]
        at, found = at[keep], found[keep]
        doc = np.searchsorted(offsets, at, "right") - 1
        keep = at + Q <= offsets[doc + 1]
        return at[keep], doc[keep], found[keep]

    def hits(self, at: np.ndarray, doc: np.ndarray, found: np.ndarray, docs: int):
        """(document, item, place in the item, diagonal from 0) of the shared q-grams.

        Those of a document and item that share too few altogether are left out.
        """
        count = self.first[found + 1] - self.first[found]
        hit = np.repeat(self.first[found], count) + _inner(count)
        doc, item = np.repeat(doc, count), self.owner[hit]
        pair = doc * len(self.length) + item
        if docs * len(self.length) <= 1 << 22:
            n = np.bincount(pair, minlength=1)[pair]
        else:
            _, group, n = np.unique(pair, return_inverse=True, return_counts=True)
            n = n[group]
        keep = n >= self.smallest()[item]
        place = self.place[hit[keep]]
        return doc[keep], item[keep], place, np.repeat(at, count)[keep] - place + self.longest

    def smallest(self) -> np.ndarray:
        """Fewest shared q-grams that any segment of an item needs."""
        return np.minimum(self.least(np.minimum(self.length, SHORT)), self.least(np.minimum(self.length, SEGMENT)))

    def windows(self, at: np.ndarray, doc: np.ndarray, found: np.ndarray, offsets: np.ndarray):
        """Two frames: doc, item, place, size, diagonal to align, and doc, item, start, end of unbroken runs."""
        doc, item, place, diagonal = self.hits(at, doc, found, len(offsets))
        width, many = self.band, int(offsets[-1] + 2 * self.longest) // self.band + 3
        # A run of diagonals of up to ``band`` lies in one of two overlapping bands of twice that width.
        band = np.r_[diagonal // width, diagonal // width - 1]
        key = (np.r_[item, item] * len(offsets) + np.r_[doc, doc]) * many + band + 1
        own, group, n = np.unique(key, return_inverse=True, return_counts=True)
        bound, wide = self.smallest(), self.longest + 1
        good = n >= bound[own // many // len(offsets)] if len(own) else np.zeros(0, bool)
        # Of those, the bands with enough places of the item: a repeat in the text adds hits, not places.
        hit = np.flatnonzero(good[group])
        places = np.unique(group[hit] * wide + place[hit % max(len(doc), 1)])
        good &= np.bincount(places // wide, minlength=len(own)) >= bound[own // many // len(offsets)]
        new = np.cumsum(good) - 1
        hit = np.flatnonzero(good[group])
        group, own = new[group[hit]], own[good]
        hit %= max(len(doc), 1)
        rest, band = np.divmod(own, many)
        g_item, g_doc = np.divmod(rest, len(offsets))
        order = np.lexsort((place[hit], diagonal[hit], group))
        hit, group = hit[order], group[order]
        p, d = place[hit], diagonal[hit]
        # Runs of consecutive places on one diagonal, each in every group that holds it.
        first = np.flatnonzero(np.r_[True, (group[1:] != group[:-1]) | (d[1:] != d[:-1]) | (p[1:] != p[:-1] + 1)][:len(hit)])
        run = np.diff(np.r_[first, len(hit)])
        ordered = np.unique(group * wide + p)
        align, exact = [], []
        for longest in (SHORT, SEGMENT):
            size = np.minimum(self.length, longest)[g_item]
            if longest == SEGMENT:  # of items up to SHORT, the whole item is done already
                size = np.where(self.length[g_item] > SHORT, size, 0)
            count = np.where(size > 0, self.length[g_item] - size + 1, 0)
            base = np.cumsum(count) - count
            g, at = np.repeat(np.arange(len(own)), count), _inner(count)
            shared = (np.searchsorted(ordered, g * wide + at + size[g] - Q, "right")
                      - np.searchsorted(ordered, g * wide + at))
            m = size[group[first]]
            full = np.flatnonzero((m > 0) & (run >= m - Q + 1))
            g_run, p_run = group[first[full]], p[first[full]]
            mark = np.zeros(len(g) + 1, np.int64)
            np.add.at(mark, base[g_run] + p_run, 1)
            np.add.at(mark, base[g_run] + p_run + run[full] - (m[full] - Q), -1)
            start = p_run + d[first[full]] - self.longest
            exact.append(pd.DataFrame({"doc": g_doc[g_run], "item": g_item[g_run], "start": start,
                                       "end": start + run[full] + Q - 1}))
            left = np.flatnonzero((shared >= self.least(size[g])) & (np.cumsum(mark)[:-1] == 0))
            g = g[left]
            align.append(pd.DataFrame({"doc": g_doc[g], "item": g_item[g], "place": at[left], "size": size[g],
                                       "diagonal": (band[g] - 1) * width - self.longest + at[left]}))
        return pd.concat(align, ignore_index=True), pd.concat(exact, ignore_index=True).drop_duplicates()

    @staticmethod
    def least(size: np.ndarray) -> np.ndarray:
        return np.maximum(size - Q + 1 - Q * (size * EDIT_PERCENT // 100), 1)

    def align(self, data: np.ndarray, offsets: np.ndarray, doc, item, place, size, diagonal):
        """(fewest edits, start, end in the piece) of each segment within its band, by banded alignment."""
        edge = self.band - 1
        n, longest, wide = len(doc), int(size.max()), 2 * self.band + 2 * edge + 1
        pattern = self.flat[np.minimum((self.begin[item] + place)[:, None] + np.arange(longest), len(self.flat) - 1)]
        low, high = offsets[doc], offsets[doc + 1]
        first = diagonal - edge  # text position of column 0 in row 0
        columns = np.arange(wide)
        far = 1 << 20
        cost = np.where((first[:, None] + columns >= low[:, None]) & (first[:, None] + columns <= high[:, None]), 0, far)
        start = first[:, None] + columns
        done_cost, done_start, done_end = np.full(n, far), np.zeros(n, np.int64), np.zeros(n, np.int64)
        for row in range(longest):
            # Column j of row r stands for r symbols of the segment used up to text position first + r + j.
            at = first[:, None] + row + columns
            inside = (at >= low[:, None]) & (at < high[:, None])
            same = np.where(inside, data[np.clip(at, 0, len(data) - 1)], 255) == pattern[:, row, None]
            diagonal_cost = np.where(inside, cost + ~same, far)
            up = np.concatenate([cost[:, 1:] + 1, np.full((n, 1), far)], 1)  # a symbol of the segment is left out
            up_start = np.concatenate([start[:, 1:], start[:, -1:]], 1)
            new = np.minimum(diagonal_cost, up)
            new_start = np.where(diagonal_cost <= up, start, up_start)
            # Text symbols left out: the least of cost - column from the left, then plus the column.
            packed = (new - columns) * 4096 + columns
            best = np.minimum.accumulate(packed, 1)
            origin = best % 4096
            new = (best - origin) // 4096 + columns
            start = np.take_along_axis(new_start, origin, 1)
            reach = first[:, None] + row + 1 + columns
            cost = np.where((reach >= low[:, None]) & (reach <= high[:, None]), new, far)
            ends = np.flatnonzero(size == row + 1)
            if len(ends):
                best = np.argmin(cost[ends], 1)
                done_cost[ends] = cost[ends, best]
                done_start[ends] = start[ends, best]
                done_end[ends] = first[ends] + row + 1 + best
        return done_cost, done_start, done_end

    def _slices(self, at: np.ndarray, found: np.ndarray, size: int):
        """(start, end) of runs of the piece with at most HITS shared q-grams, or as few as a step allows."""
        step = 64 * self.band
        count = self.first[found + 1] - self.first[found]
        upto = np.r_[0, np.cumsum(np.bincount(at // step, weights=count, minlength=size // step + 1)).astype(np.int64)]
        start = 0
        while start * step < size:
            end = max(int(np.searchsorted(upto, upto[start] + HITS, "right")) - 1, start + 1)
            yield start * step, min(end * step, size)
            start = end

    def regions(self, data: np.ndarray, offsets: np.ndarray) -> pd.DataFrame:
        """doc, item, start, end, edits: verified regions, overlapping ones of an item merged."""
        places, docs, found = self.grams_of(data, offsets)
        margin = 64 * self.band  # more than twice what a segment covers, and whole bands
        parts = []
        for low, high in self._slices(places, found, len(data)):
            mine = slice(*np.searchsorted(places, (low - margin, high + margin)))
            windows, exact = self.windows(places[mine], docs[mine], found[mine], offsets)
            # Runs that a slice cuts overlap and are merged; alignments belong to the slice where they start.
            parts.append(exact.assign(edits=0))
            parts += self._aligned(data, offsets, windows, low if low else -1, high if high < len(data) else high + 1)
        return self._merged(parts)

    def _aligned(self, data: np.ndarray, offsets: np.ndarray, windows: pd.DataFrame, low: int, high: int):
        for at in range(0, len(windows), 2048):
            some = windows.iloc[at:at + 2048]
            doc, item, place, size, diagonal = (some[c].to_numpy() for c in ("doc", "item", "place", "size", "diagonal"))
            edits, start, end = self.align(data, offsets, doc, item, place, size, diagonal)
            good = (edits <= size * EDIT_PERCENT // 100) & (start >= low) & (start < high)
            yield pd.DataFrame({"doc": doc, "item": item, "start": start, "end": end, "edits": edits})[good]

    def _merged(self, parts: list[pd.DataFrame]) -> pd.DataFrame:
        columns = ["doc", "item", "start", "end", "edits"]
        frame = pd.concat([pd.DataFrame({c: np.zeros(0, np.int64) for c in columns}), *parts], ignore_index=True)
        frame = frame.drop_duplicates()
        frame["item"] = self.ids[frame["item"].to_numpy(np.int64)]
        frame = frame.sort_values(["doc", "item", "start", "end"])
        out: list[list] = []
        for row in frame.itertuples(index=False):
            if out and out[-1][0] == row.doc and out[-1][1] == row.item and row.start <= out[-1][3]:
                out[-1][3] = max(out[-1][3], row.end)
                out[-1][4] = max(out[-1][4], row.edits)
            else:
                out.append(list(row))
        return pd.DataFrame(out, columns=columns)


def _segments(packed: bytes, key: bytes) -> Segments:
    """Segments of a pass, kept by the worker until it meets another pass."""
    if key not in _NEAREST:
        _NEAREST.clear()
        _NEAREST[key] = Segments(pickle.loads(packed))
    return _NEAREST[key]


def _passes(benchmark: DataFrame):
    """Segments of the benchmark, PASS_BYTES of text at a time."""
    items = benchmark.where(F.col("text").isNotNull() & F.col("item_id").isNotNull()).select(
        F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // PASS_BYTES)
    for i in range(n):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i)
        rows = part.distinct().orderBy("item_id", "text").collect()  # about PASS_BYTES
        yield Segments([(r[0], r[1]) for r in rows]), n


SCHEMA = "doc_id long, item_id long, start long, end long, edits long"


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, start, end (UTF-8 bytes), edits: one row per region that holds benchmark text.

    A region holds SEGMENT or SHORT consecutive bytes of an item, from any
    offset, or a whole shorter item, within EDIT_PERCENT of edits; ASCII and Latin-1 capitals count as small letters and
    white spaces are alike. edits is
    the largest of the segments that make up the region. Items below 2 * Q
    bytes and null or empty texts match nothing; clean documents have no row;
    repeated rows give rows of their own. Other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def finder(segments):
        def find(batches):
            for piece, data, offsets in text_pieces(batches):
                found = segments.regions(folded(data), offsets)
                doc = found["doc"].to_numpy(np.int64)
                yield pa.RecordBatch.from_arrays([
                    piece.column("doc_id").take(pa.array(doc)), pa.array(found["item"].to_numpy(np.int64)),
                    *(pa.array(found[c].to_numpy(np.int64) - (offsets[doc] if c != "edits" else 0))
                      for c in ("start", "end", "edits"))], ["doc_id", "item_id", "start", "end", "edits"])

        return find

    out = None
    for segments, n in _passes(benchmark):
        found = rows.mapInArrow(finder(segments), SCHEMA)
        # Of several passes each is a job of its own, whose index goes when it ends.
        found = write_table(found, "benchmark_pass") if n > 1 else found
        out = found if out is None else out.union(found)
    return rows.sparkSession.createDataFrame([], SCHEMA) if out is None else out


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark region, with all their columns."""

    def keeper(segments):
        def keep(batches):
            for piece, data, offsets in text_pieces(batches):
                bad = np.zeros(piece.num_rows, bool)
                bad[segments.regions(folded(data), offsets)["doc"].to_numpy(np.int64)] = True
                yield piece.filter(pa.array(~bad))

        return keep

    for segments, n in _passes(benchmark):
        docs = docs.mapInArrow(keeper(segments), docs.schema)
        docs = write_table(docs, "benchmark_pass") if n > 1 else docs
    return docs


def op10(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return contaminated(docs, benchmark)

"""Exact repeated windows over all documents, shard by shard.

A *window* is L consecutive units (bytes or words) of one document. The work:

1. ``store``: documents are packed into compressed chunk rows of a table
   bucketed by chunk, so that later passes join answers to texts without
   shuffling the texts again.
2. ``repeated_anchors``: every window is owned by its minimizer, the smallest
   hash of its k-grams. It also holds either what follows the minimizer or what
   precedes it, half of the other units each. Chunks send fingerprints of their
   minimizers with either half to the minimizer's shard and hear which occur at
   least twice. This is a filter only.
3. ``shard_rows``: runs of windows that one minimizer owns and whose half was
   repeated are cut out (once per distinct text and chunk) and sent to the
   minimizer's shard. Equal windows have equal minimizers at the same place, so
   all their occurrences meet there. The windows of very frequent minimizers go
   out one by one to shards by their own text instead, which splits hot groups
   and merges their copies.
4. a shard function (``fm_index.py``, ``suffix_array.py``) decides exactly which
   windows repeat; ``answered`` hands the decisions back to the chunks.

Shards stay small, so their number grows with the input. Messages don't go from
every chunk to every shard but to groups of shards: one row holds what a chunk
has for all shards of a group, in the order of the shards.

Every step is a function of written tables, so lost executors only repeat tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripcraft.llm.common import (
    NO_ID, ngram_hash, pieces, prefix_hash, run_hash, shuffle_partitions, solid_bytes, span_hash,
    table_name, text_pieces, word_spans, write_table,
)
from tripcraft.session import scratch_path

CHUNK_BYTES = 4 << 20
#: Chunks whose messages go to groups of shards hold more, so that the messages do, too.
WIDE_CHUNK_BYTES = 8 << 20
#: Text bytes for each shard, before anchors select the part that is sent.
SHARD_BYTES = 1 << 19
#: Groups are as many as the shards up to LEAST_GROUPS (small inputs keep all cores
#: busy); above that they fill up to GROUP_SHARDS, which bounds the memory of a task.
LEAST_GROUPS, GROUP_SHARDS = 256, 32
#: Repeated fingerprints from which the windows of their minimizers are dealt out one by one.
HOT = 20_000
#: Lower bits of a fingerprint, which tell a minimizer's halves apart; those above are the minimizer's.
HALF_BITS = 20
#: Decision for a window that goes wherever it stands (below every id rank).
EVERYWHERE = np.iinfo(np.int64).min
CHUNKS = "chunk long, n_docs long, n_bytes long, ids binary, no_id binary, sizes binary, text binary"
#: bucket is a group of shards; cells has the number of entries for each of its shards.
ANCHORS = "bucket long, chunk long, cells binary, prints binary, counts binary"
REPEATED = "chunk long, bucket long, cells binary, prints binary, hot binary"
REGIONS = "bucket long, chunk long, cells binary, sizes binary, lowest binary, counts binary, text binary"
ANSWERS = "chunk long, bucket long, windows binary"


@dataclass(frozen=True)
class Window:
    """Windows of ``length`` units; minimizers are hashes of ``gram`` units."""

    words: bool
    length: int
    gram: int


_PACKER, _UNPACKER = zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()


def _pack(data: bytes) -> bytes:
    return _PACKER.compress(data)


def _unpack(data: bytes) -> bytes:
    return _UNPACKER.decompress(data)


# --- 1. chunks ---------------------------------------------------------------------


def store(docs: DataFrame, key: str = "doc_id", text: str = "text", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Chunk table of (key, text), bucketed by chunk; null texts count as empty."""
    spark = docs.sparkSession

    def chunk_rows(batches):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        for rows, data, offsets in text_pieces(batches, "text", chunk_bytes):
            ids = rows.column("id")
            yield pa.RecordBatch.from_pylist([{
                "chunk": number, "n_docs": rows.num_rows, "n_bytes": len(data),
                "ids": ids.fill_null(0).to_numpy().astype(np.int64).tobytes(),
                "no_id": ids.is_null().to_numpy(zero_copy_only=False).tobytes(),
                "sizes": np.diff(offsets).astype(np.int64).tobytes(),
                "text": _pack(data.tobytes()),
            }], schema=pa.schema([(f.split()[0], pa.binary() if f.endswith("binary") else pa.int64())
                                  for f in CHUNKS.split(", ")]))
            number += 1

    n, name = shuffle_partitions(spark), table_name("chunks")
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    (rows.mapInArrow(chunk_rows, CHUNKS).repartition(n, "chunk")
     .write.bucketBy(n, "chunk").sortBy("chunk").option("path", scratch_path(spark, name))
     .option("compression", "none").saveAsTable(name))
    return spark.table(name)


def shard_count(chunks: DataFrame) -> int:
    total = chunks.agg(F.sum("n_bytes")).first()[0] or 0
    return max(8, -(-total // SHARD_BYTES))


@dataclass(frozen=True)
class Deal:
    """Groups of consecutive shards."""

    shards: int

    @property
    def groups(self) -> int:
        return max(min(self.shards, LEAST_GROUPS), -(-self.shards // GROUP_SHARDS))

    def group(self, shard: np.ndarray) -> np.ndarray:
        return shard * self.groups // self.shards

    def first(self, group: np.ndarray) -> np.ndarray:
        """The first shard of each group; of the number of groups, the number of shards."""
        return -(-group * self.shards // self.groups)

    def messages(self, shard: np.ndarray):
        """(group, from, to, cells) for ascending shards: the entries of each group that has any."""
        group = self.group(shard)
        cut = np.flatnonzero(np.r_[True, np.diff(group) != 0, True]) if len(shard) else np.zeros(1, np.int64)
        first, end = self.first(group[cut[:-1]]), self.first(group[cut[:-1]] + 1)
        for g, a, b, low, high in zip(group[cut[:-1]].tolist(), cut[:-1].tolist(), cut[1:].tolist(), first.tolist(),
                                      end.tolist(), strict=True):
            yield g, a, b, np.bincount(shard[a:b] - low, minlength=high - low).astype(np.int32).tobytes()


def _joined(column, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype)


def _cells(frame: pd.DataFrame) -> np.ndarray:
    """For each entry of the messages to one group: its row, times the shards of the group, plus its shard."""
    cells = _joined(frame["cells"], np.int32)
    return np.repeat(np.arange(len(cells)), cells)


class Chunk:
    """Texts of a chunk row, as pieces with their units, owners and regions."""

    def __init__(self, row, window: Window):
        self.window = window
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.no_id = np.frombuffer(row["no_id"], bool)
        self.rank = np.where(self.no_id, NO_ID, np.maximum(self.ids, EVERYWHERE + 1))
        self.offsets = np.r_[0, np.cumsum(np.frombuffer(row["sizes"], np.int64))]
        self.data = np.frombuffer(_unpack(row["text"]), np.uint8)

    def pieces(self):
        for a, b in pieces(self.offsets, 1 << 19):
            data = self.data[self.offsets[a]:self.offsets[b]]
            yield Piece(self.window, data, self.offsets[a:b + 1] - self.offsets[a], a)


class Piece:
    """Units of some documents. ``text`` holds them in canonical form: words are
    followed by one space each; bytes stay as they are."""

    def __init__(self, window: Window, data: np.ndarray, offsets: np.ndarray, first_doc: int):
        self.window, self.first_doc = window, first_doc
        if window.words:
            starts, ends, self.doc_at = word_spans(data, offsets)
            size = ends - starts
            self.ends = np.cumsum(size + 1) - 1
            self.starts = self.ends - size
            self.text = np.full(len(starts) + int(size.sum()), 32, np.uint8)
            self.text[np.arange(int(size.sum())) + np.repeat(np.arange(len(starts)), size)] = data[solid_bytes(data)]
            self.prefix = prefix_hash(self.text)
            units = span_hash(self.prefix, self.starts, self.ends)
            self.n = len(starts)
        else:
            self.text, self.doc_at, self.n = data, offsets, len(data)
            self.prefix, units = prefix_hash(self.text), None
        self.grams = self._grams(units)

    def _grams(self, units):
        k = self.window.gram
        if self.n < k:
            return np.zeros(0, np.uint64)
        if units is not None:
            return ngram_hash(units, k)
        return run_hash(self.prefix, k)

    def _bytes(self, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return (self.starts[first], self.ends[last - 1]) if self.window.words else (first, last)

    def spans(self, first: np.ndarray, last: np.ndarray) -> list[bytes]:
        """Texts of the units [first, last) of each pair."""
        first, last = self._bytes(first, last)
        text = self.text.tobytes()
        return [text[a:b] for a, b in zip(first.tolist(), last.tolist(), strict=True)]

    def runs(self):
        """(first, last, owner): runs of valid window starts with one minimizer."""
        length, wide = self.window.length, self.window.length - self.window.gram + 1
        if len(self.grams) < wide:
            return (np.zeros(0, np.int64),) * 3
        low = (self.grams >> np.uint64(31) << np.uint64(31)) | np.arange(len(self.grams), dtype=np.uint64)
        step = 1
        while step * 2 <= wide:
            low = np.minimum(low[:len(low) - step], low[step:])
            step *= 2
        if step < wide:
            low = np.minimum(low[:len(low) - (wide - step)], low[wide - step:])
        owner = (low & np.uint64((1 << 31) - 1)).astype(np.int64)
        valid = np.ones(len(owner), bool)
        for end in self.doc_at[1:]:
            valid[max(0, end - length + 1):end] = False
        at = np.flatnonzero(valid)
        if not len(at):
            return (np.zeros(0, np.int64),) * 3
        owner = owner[at]
        cut = np.flatnonzero((np.diff(at) != 1) | (np.diff(owner) != 0))
        return at[np.r_[0, cut + 1]], at[np.r_[cut, len(at) - 1]], owner[np.r_[0, cut + 1]]

    def prints(self, first: np.ndarray, last: np.ndarray, owner: np.ndarray, shards: int):
        """(split, left, right): windows of each run from ``split`` on hold what follows the minimizer, those
        before hold what precedes it; left and right are (runs that have such windows, shard << 32 | fingerprint).
        """
        k, spare = self.window.gram, self.window.length - self.window.gram
        after = (spare + 1) // 2
        split = owner - (spare - after)
        sides = []
        for own, low, high in ((np.flatnonzero(first < split), spare - after + 1, 0),
                               (np.flatnonzero(last >= split), 0, after)):
            gram, at = self.grams[owner[own]], owner[own]
            half = span_hash(self.prefix, *self._bytes(at - low, at + k + high))
            code = gram >> np.uint64(32 + HALF_BITS) << np.uint64(HALF_BITS) | half >> np.uint64(64 - HALF_BITS)
            sides.append((own, (gram % np.uint64(shards)).astype(np.int64) << 32 | code.astype(np.int64)))
        return split, *sides


# --- 2. repeated minimizers ----------------------------------------------------------


def _code(grams: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    return (grams % np.uint64(shards)).astype(np.int64), (grams >> np.uint64(32)).astype(np.uint32)


def repeated_anchors(chunks: DataFrame, window: Window, shards: int) -> DataFrame:
    """Per chunk and group: fingerprints of its minimizers with either half that occur twice or more."""
    deal = Deal(shards)

    def prints(frames):
        for frame in frames:
            for row in frame.to_dict("records"):
                own = [key for p in Chunk(row, window).pieces() for _, key in p.prints(*p.runs(), shards)[1:]]
                key, counts = np.unique(np.concatenate([*own, np.zeros(0, np.int64)]), return_counts=True)
                shard, code = key >> 32, key.astype(np.uint32)
                counts = np.minimum(counts, HOT).astype(np.uint16)
                yield pd.DataFrame(
                    [(g, row["chunk"], cells, code[a:b].tobytes(), counts[a:b].tobytes())
                     for g, a, b, cells in deal.messages(shard)],
                    columns=["bucket", "chunk", "cells", "prints", "counts"])

    def repeated(frame: pd.DataFrame) -> pd.DataFrame:
        cell, width = _cells(frame), len(frame["cells"].iat[0]) // 4
        code, count = _joined(frame["prints"], np.uint32), _joined(frame["counts"], np.uint16)
        key = cell % width << 32 | code
        order = np.argsort(key, kind="stable")
        first = np.flatnonzero(np.r_[True, np.diff(key[order]) != 0])
        size = np.diff(np.r_[first, len(key)])
        total = np.add.reduceat(count[order], first, dtype=np.int64)
        minimizer = key[order[first]] >> HALF_BITS
        cut = np.flatnonzero(np.r_[True, np.diff(minimizer) != 0])
        sent = np.repeat(np.add.reduceat(np.where(total >= 2, total, 0), cut), np.diff(np.r_[cut, len(total)]))
        twice, often = np.empty(len(key), bool), np.empty(len(key), bool)
        twice[order], often[order] = np.repeat(total >= 2, size), np.repeat(sent >= HOT, size)
        keep = np.flatnonzero(twice)
        code, hot = code[keep], often[keep]
        cells = np.bincount(cell[keep], minlength=width * len(frame)).reshape(-1, width).astype(np.int32)
        ends = np.cumsum(cells.sum(1)).tolist()
        out = [(chunk, bucket, own.tobytes(), code[a:b].tobytes(), hot[a:b].tobytes())
               for chunk, bucket, own, a, b in zip(frame["chunk"].tolist(), frame["bucket"].tolist(), cells, [0, *ends], ends,
                                                   strict=False) if a < b]
        return pd.DataFrame(out, columns=["chunk", "bucket", "cells", "prints", "hot"])

    sent = chunks.select("chunk", "ids", "no_id", "sizes", "text").mapInPandas(prints, ANCHORS)
    return write_table(sent.groupBy("bucket").applyInPandas(repeated, REPEATED), "anchors")


# --- 3. candidate regions ------------------------------------------------------------


def regions(piece: Piece, anchors: tuple[np.ndarray, np.ndarray], shards: int):
    """Arrays (first, last, shard) for the runs of windows that can repeat, in order.

    shard is -1 for windows of hot minimizers, which stand alone; of other runs, the halves that can repeat stay.
    """
    first, last, owner = piece.runs()
    if not len(first) or not len(anchors[0]):
        return (np.zeros(0, np.int64),) * 3
    split, *sides = piece.prints(first, last, owner, shards)
    kept, hot = [], np.zeros(len(first), bool)
    for own, key in sides:
        at = np.minimum(np.searchsorted(anchors[0], key), len(anchors[0]) - 1)
        found = anchors[0][at] == key
        kept.append(np.zeros(len(first), bool))
        kept[-1][own[found]] = True
        hot[own[found]] = anchors[1][at[found]]  # alike for both halves
    left, right = kept
    first, last = np.where(left, first, np.maximum(first, split)), np.where(right, last, np.minimum(last, split - 1))
    some = left | right
    first, last, hot = first[some], last[some], hot[some]
    bucket = (piece.grams[owner[some]] % np.uint64(shards)).astype(np.int64)
    count = np.where(hot, last - first + 1, 1)
    first, hot = np.repeat(first, count) + _inner(count), np.repeat(hot, count)
    return first, np.where(hot, first, np.repeat(last, count)), np.where(hot, -1, np.repeat(bucket, count))


def _inner(count: np.ndarray) -> np.ndarray:
    """0, 1, ..., count - 1 for each count."""
    return np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)


class Candidates:
    """Distinct region texts of one chunk, and where they stand in its pieces."""

    def __init__(self, row, replies: pd.DataFrame, window: Window, shards: int):
        self.chunk = Chunk(row, window)
        self.deal = Deal(shards)
        replies = replies.sort_values("bucket")
        bucket = replies["bucket"].to_numpy(np.int64)
        first, width = self.deal.first(bucket), self.deal.first(bucket + 1) - self.deal.first(bucket)
        shard = np.repeat(np.repeat(first, width) + _inner(width), _joined(replies["cells"], np.int32))
        key = shard << 32 | _joined(replies["prints"], np.uint32)
        order = np.argsort(key, kind="stable")  # ascending already, but for changes in how prints are sent
        anchors = key[order], _joined(replies["hot"], bool)[order]
        index: dict[bytes, int] = {}
        self.places = []
        every = [(np.zeros(0, np.int64),) * 4]
        for piece in self.chunk.pieces():
            first, last, shard = regions(piece, anchors, shards)
            own = np.array([index.setdefault(text, len(index)) for text in piece.spans(first, last + window.length)],
                           np.int64)
            docs = np.searchsorted(piece.doc_at, first, "right") - 1 + piece.first_doc
            self.places.append((piece, first, own, docs))
            every.append((own, self.chunk.rank[docs], shard, last - first + 1))
        self.texts = list(index)
        own, rank, shard, windows = (np.concatenate(x) for x in zip(*every, strict=True))
        n = len(self.texts)
        self.counts = np.bincount(own, minlength=n)
        self.lowest = np.full(n, NO_ID, np.int64)
        np.minimum.at(self.lowest, own, rank)
        self.shard, self.windows = np.zeros(n, np.int64), np.zeros(n, np.int64)
        self.shard[own], self.windows[own] = shard, windows  # alike for equal texts
        for i in np.flatnonzero(self.shard < 0).tolist():
            self.shard[i] = xxhash.xxh64_intdigest(self.texts[i]) % shards
        self.order = np.argsort(self.shard, kind="stable")

    def messages(self):
        """(group, indices of its texts, cells) in ascending order."""
        for g, a, b, cells in self.deal.messages(self.shard[self.order]):
            yield g, self.order[a:b], cells


def shard_rows(chunks: DataFrame, repeated: DataFrame, window: Window, shards: int) -> DataFrame:
    """Region texts of every chunk for the shards of every group, once per distinct text."""

    def cut(row_frame: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in row_frame.to_dict("records"):
            found = Candidates(row, replies, window, shards)
            sizes = np.array([len(text) for text in found.texts], np.int32)
            for group, own, cells in found.messages():
                out.append((group, row["chunk"], cells, sizes[own].tobytes(), found.lowest[own].tobytes(),
                            found.counts[own].astype(np.int32).tobytes(),
                            _pack(b"".join([found.texts[i] for i in own.tolist()]))))
        return pd.DataFrame(out, columns=["bucket", "chunk", "cells", "sizes", "lowest", "counts", "text"])

    texts = chunks.select("chunk", "ids", "no_id", "sizes", "text")
    return texts.groupBy("chunk").cogroup(repeated.groupBy("chunk")).applyInPandas(cut, REGIONS)


@dataclass
class Shard:
    """Distinct region texts of a shard, with the lowest id rank and number of occurrences of each."""

    texts: list[bytes]
    lowest: np.ndarray
    counts: np.ndarray


def decided(sent: DataFrame, decide) -> DataFrame:
    """Per chunk and group: decide()'s value for every window of the texts sent.

    decide(Shard) returns the int64 values of all windows, text after text, and
    the number of windows of each text. The shards of a group go one by one.
    """

    def answer(frame: pd.DataFrame) -> pd.DataFrame:
        width = len(frame["cells"].iat[0]) // 4
        shard = _cells(frame) % width
        data = b"".join(map(_unpack, frame["text"]))
        ends = np.cumsum(_joined(frame["sizes"], np.int32), dtype=np.int64)
        starts = np.r_[0, ends[:-1]]
        low, count = _joined(frame["lowest"], np.int64), _joined(frame["counts"], np.int32).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        cut = np.searchsorted(shard[order], np.arange(width + 1))
        windows, found = np.zeros(len(shard), np.int64), []
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            if a == b:
                continue
            at = order[a:b]
            index: dict[bytes, int] = {}
            own = np.array([index.setdefault(data[i:j], len(index))
                            for i, j in zip(starts[at].tolist(), ends[at].tolist(), strict=True)], np.int64)
            lowest = np.full(len(index), NO_ID, np.int64)
            np.minimum.at(lowest, own, low[at])
            counts = np.zeros(len(index), np.int64)
            np.add.at(counts, own, count[at])
            values, size = decide(Shard(list(index), lowest, counts))
            windows[at] = size[own]
            found.append((at, values, (np.cumsum(size) - size)[own]))
        begin = np.cumsum(windows) - windows
        out = np.empty(int(windows.sum()), np.int64)
        for at, values, source in found:
            n = windows[at]
            inner = _inner(n)
            out[np.repeat(begin[at], n) + inner] = values[np.repeat(source, n) + inner]
        # The entries of a row, and so its windows, stand together.
        last = np.cumsum(_joined(frame["cells"], np.int32).reshape(-1, width).sum(1))
        until = np.r_[0, np.cumsum(windows)][last].tolist()
        return pd.DataFrame(
            [(c, g, _pack(out[a:b].tobytes())) for c, g, a, b in zip(
                frame["chunk"].tolist(), frame["bucket"].tolist(), [0, *until], until, strict=False)],
            columns=["chunk", "bucket", "windows"])

    return write_table(sent.groupBy("bucket").applyInPandas(answer, ANSWERS), "answers")


# --- 4. results ----------------------------------------------------------------------


def answered(chunks: DataFrame, repeated: DataFrame, answers: DataFrame, window: Window, shards: int,
             finish, schema: str) -> DataFrame:
    """finish(piece, covered, chunk) -> rows, per piece; covered marks its removed units.

    The decision for a window is an id rank: the window is removed in documents
    of a larger one (EVERYWHERE: in all, NO_ID: in none).
    """
    none = F.lit(None).cast("binary")
    both = (repeated.select("chunk", "bucket", "cells", "prints", "hot", none.alias("windows"))
            .unionByName(answers.select("chunk", "bucket", none.alias("cells"), none.alias("prints"), none.alias("hot"),
                                        "windows")))

    def apply(row_frame: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        out = []
        is_answer = replies["windows"].notna()
        windows = dict(zip(replies["bucket"][is_answer], replies["windows"][is_answer], strict=True))
        for row in row_frame.to_dict("records"):
            found = Candidates(row, replies[~is_answer], window, shards)
            values = _joined([_unpack(windows[group]) for group, _, _ in found.messages()], np.int64)
            begin, count = np.zeros(len(found.windows), np.int64), found.windows[found.order]
            begin[found.order] = np.cumsum(count) - count
            for piece, starts, own, docs in found.places:
                count = found.windows[own]
                inner = _inner(count)
                gone = values[np.repeat(begin[own], count) + inner] < np.repeat(found.chunk.rank[docs], count)
                mark = np.zeros(piece.n + 1, np.int32)
                mark[(np.repeat(starts, count) + inner)[gone]] = 1
                total = np.cumsum(mark)
                shifted = np.zeros_like(total)
                shifted[window.length:] = total[:-window.length] if piece.n + 1 > window.length else 0
                out.extend(finish(piece, (total - shifted > 0)[:-1], found.chunk))
        return pd.DataFrame(out, columns=[c.split()[0] for c in schema.split(", ")])

    texts = chunks.select("chunk", "ids", "no_id", "sizes", "text")
    return texts.groupBy("chunk").cogroup(both.groupBy("chunk")).applyInPandas(apply, schema)


def spans(covered: np.ndarray) -> list[int]:
    """Maximal covered runs as a flat list: start, end, start, end, ..."""
    edge = np.diff(np.r_[False, covered, False].astype(np.int8))
    return np.stack([np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)], 1).ravel().tolist()

"""Operator 3, substring dedup by matching statistics on compressed FM-indexes.

The repeated-window engine (``repeats.py``) sends candidate regions to shards.
Every shard builds one FM-index (wavelet matrix over the Burrows-Wheeler
transform of its distinct regions) and streams the regions through it: backward
search from each window's last word gives its matching statistic, the longest
match that ends there and occurs at least twice. Windows whose statistic
reaches the threshold repeat.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripcraft.llm import repeats as R
from tripcraft.llm.common import NO_ID
from tripcraft.llm.wavelet import WaveletMatrix, bounded_suffix_order

WORDS = 35
GRAM = 7


class FMIndex:
    """Counts patterns of up to ``depth`` symbols; symbol 0 separates texts."""

    def __init__(self, symbols: np.ndarray, n_symbols: int, depth: int):
        order = bounded_suffix_order(symbols, n_symbols, depth)
        self.n = len(symbols)
        self.matrix = WaveletMatrix(symbols[order - 1], n_symbols)
        self.smaller = np.r_[0, np.cumsum(np.bincount(symbols, minlength=n_symbols))[:-1]]

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray):
        """Rows of symbol + pattern from the rows [low, high) of each pattern."""
        rank = self.matrix.rank(np.r_[symbol, symbol], np.r_[low, high])
        at = self.smaller[symbol]
        return at + rank[:len(low)], at + rank[len(low):]


def matching_statistics(index: FMIndex, symbols: np.ndarray, ends: np.ndarray, limit: int,
                        least: int = 2) -> np.ndarray:
    """Longest match (at most ``limit``) that ends at each position and occurs ``least`` times."""
    length = np.zeros(len(ends), np.int64)
    live = np.arange(len(ends))
    low, high = np.zeros(len(ends), np.int64), np.full(len(ends), index.n, np.int64)
    for j in range(limit):
        low, high = index.extend(symbols[ends[live] - j], low, high)
        keep = high - low >= least
        live, low, high = live[keep], low[keep], high[keep]
        length[live] += 1
    return length


def repeated_windows(shard: R.Shard, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Decision for each window of each text: EVERYWHERE if it occurs twice, else NO_ID; windows of each text."""
    code: dict[bytes, int] = {}
    symbols, sizes = [], []
    for text in shard.texts:
        words = text.split(b" ")
        symbols.extend([code.setdefault(w, len(code) + 1) for w in words])
        symbols.append(0)
        sizes.append(len(words))
    symbols, sizes = np.array(symbols, np.int64), np.array(sizes, np.int64)
    windows = sizes - length + 1
    begin = np.cumsum(sizes + 1) - sizes - 1
    inner = np.arange(int(windows.sum())) - np.repeat(np.cumsum(windows) - windows, windows)
    ends = np.repeat(begin, windows) + inner + length - 1
    twice = np.repeat(shard.counts > 1, windows)  # the same text was sent for several places
    once = np.flatnonzero(~twice)
    index = FMIndex(symbols, len(code) + 1, length)
    for at in range(0, len(once), 1 << 18):
        some = once[at:at + (1 << 18)]
        twice[some] = matching_statistics(index, symbols, ends[some], length) >= length
    return np.where(twice, R.EVERYWHERE, NO_ID), windows


SCHEMA = "doc_id long, n_words long, n_removed long, spans array<long>, kept binary"


def substring_dedup(docs: DataFrame, words: int = WORDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Remove every word that a window of ``words`` words covers whose words also start elsewhere.

    Words are runs of bytes other than ASCII white space. Returns one row per
    input row: doc_id, n_words, n_removed, spans (removed word ranges, flat:
    start, end, ...) and kept (kept words joined by one space, UTF-8).

    Null and empty texts have no words; repeated rows are documents of their
    own (their windows occur elsewhere); a null id is returned as null; other
    columns are ignored; an empty table gives no rows.
    """
    window = R.Window(True, words, min(GRAM, words))
    chunks = R.store(docs, key, text, R.WIDE_CHUNK_BYTES)
    shards = R.shard_count(chunks)
    repeated = R.repeated_anchors(chunks, window, shards)
    sent = R.shard_rows(chunks, repeated, window, shards)
    answers = R.decided(sent, lambda shard: repeated_windows(shard, words))

    def finish(piece, covered, chunk):
        kept = np.r_[0, np.cumsum(np.repeat(~covered, piece.ends - piece.starts + 1))]
        edges = np.r_[piece.starts, len(piece.text)]
        text = piece.text[np.repeat(~covered, piece.ends - piece.starts + 1)].tobytes()
        for d, (a, b) in enumerate(zip(piece.doc_at[:-1].tolist(), piece.doc_at[1:].tolist(), strict=True)):
            i = piece.first_doc + d
            yield (None if chunk.no_id[i] else int(chunk.ids[i]), b - a, int(covered[a:b].sum()),
                   R.spans(covered[a:b]), text[kept[edges[a]]:max(kept[edges[a]], kept[edges[b]] - 1)])

    return R.answered(chunks, repeated, answers, window, shards, finish, SCHEMA)


def op3(docs: DataFrame) -> DataFrame:
    return substring_dedup(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"),
        (F.size("spans") / 2).cast("long").alias("n_spans"))

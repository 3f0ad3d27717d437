"""Operator 7, suffix-array dedup by threshold-bounded interval expansion.

Every shard of the repeated-window engine builds the Burrows-Wheeler transform
of its distinct regions and derives longest common prefixes breadth first: the
intervals of all strings of length 1, 2, ... are found by extending shorter
ones backward, and the right border of an interval of strings of length v that
is still unset gets the common prefix v - 1. The expansion stops at the minimum
length, so the rows between set borders share at least that many bytes.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripcraft.llm import repeats as R
from tripcraft.llm.common import NO_ID
from tripcraft.llm.wavelet import WaveletMatrix, bounded_suffix_order

BYTES = 50
GRAM = 16


def prefix_borders(symbols: np.ndarray, n_symbols: int, order: np.ndarray, least: int) -> np.ndarray:
    """Marks the rows of the suffix order that share fewer than ``least`` symbols with the row before.

    Symbol 0 separates texts; strings may end with it but don't continue past it.
    """
    n = len(symbols)
    before = symbols[order - 1]
    matrix = WaveletMatrix(before, n_symbols)
    step = np.empty(n, np.int64)  # row of the suffix that is longer by one symbol
    step[np.argsort(before, kind="stable")] = np.arange(n)
    smaller = np.r_[0, np.cumsum(np.bincount(symbols, minlength=n_symbols))[:-1]]
    border = np.zeros(n + 1, bool)
    border[[0, n]] = True
    low, high = np.zeros(1, np.int64), np.full(1, n, np.int64)
    for length in range(1, least + 1):
        size = high - low
        one = low[size == 1]  # one row has one extension
        two = low[size == 2]  # two rows have a common one, or one each
        same = before[two] == before[two + 1]
        one, two = np.concatenate([one, two[~same], two[~same] + 1]), two[same]
        found = [(before[one], step[one], step[one] + 1), (before[two], step[two], step[two] + 2)]
        low, high = low[size > 2], high[size > 2]
        for at in range(0, len(low), 1 << 17):
            symbol, a, b = matrix.children(low[at:at + (1 << 17)], high[at:at + (1 << 17)])
            found.append((symbol, smaller[symbol] + a, smaller[symbol] + b))
        symbol, low, high = (np.concatenate(x) for x in zip(*found, strict=True))
        # The whole text's last border is set from the start, yet its strings go on.
        keep = (~border[high] | (high == n)) & ((symbol > 0) | (length == 1))
        low, high = low[keep], high[keep]
        border[high] = True
        if not len(low):
            break
    return border[:-1]


def lowest_starts(shard: R.Shard, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window of each text the lowest id rank of the documents in which it starts; windows of each text."""
    sizes = np.array([len(t) for t in shard.texts], np.int64)
    data = np.frombuffer(b"\0".join([*shard.texts, b""]), np.uint8)
    code = np.cumsum(np.bincount(data, minlength=256) > 0).astype(np.int16)  # bytes in use, from 1
    symbols, n_symbols = code[data], int(code[-1]) + 1
    begin = np.cumsum(sizes + 1) - sizes - 1
    symbols[begin + sizes] = 0
    order = bounded_suffix_order(symbols, n_symbols, length)
    border = prefix_borders(symbols, n_symbols, order, length)
    group = np.cumsum(border) - 1
    windows = sizes - length + 1
    inner = np.arange(int(windows.sum())) - np.repeat(np.cumsum(windows) - windows, windows)
    at = np.repeat(begin, windows) + inner
    lowest = np.full(len(symbols), NO_ID, np.int64)
    lowest[at] = np.repeat(shard.lowest, windows)
    least = np.minimum.reduceat(lowest[order], np.flatnonzero(border))
    row = np.empty(len(symbols), np.int64)
    row[order] = group
    return least[row[at]], windows


SCHEMA = "doc_id long, n_bytes long, n_removed long, spans array<long>, kept binary"


def suffix_array_dedup(docs: DataFrame, length: int = BYTES, key: str = "doc_id",
                       text: str = "text") -> DataFrame:
    """Remove every byte that a string of ``length`` bytes covers which also starts in a document of smaller id.

    Returns one row per input row: doc_id, n_bytes, n_removed, spans (removed
    byte ranges, flat: start, end, ...) and kept (the remaining bytes; they may
    not be valid UTF-8).

    Null and empty texts have no bytes. Rows of equal id don't remove from each
    other; a null id counts as larger than every other and is returned as null;
    other columns are ignored; an empty table gives no rows.
    """
    window = R.Window(False, length, min(GRAM, length))
    chunks = R.store(docs, key, text, R.WIDE_CHUNK_BYTES)
    shards = R.shard_count(chunks)
    repeated = R.repeated_anchors(chunks, window, shards)
    sent = R.shard_rows(chunks, repeated, window, shards)
    answers = R.decided(sent, lambda shard: lowest_starts(shard, length))

    def finish(piece, covered, chunk):
        for d, (a, b) in enumerate(zip(piece.doc_at[:-1].tolist(), piece.doc_at[1:].tolist(), strict=True)):
            i, gone = piece.first_doc + d, covered[a:b]
            yield (None if chunk.no_id[i] else int(chunk.ids[i]), b - a, int(gone.sum()), R.spans(gone),
                   piece.text[a:b][~gone].tobytes())

    return R.answered(chunks, repeated, answers, window, shards, finish, SCHEMA)


def op7(docs: DataFrame) -> DataFrame:
    return suffix_array_dedup(docs).select(
        "doc_id", "n_bytes", "n_removed", (F.size("spans") / 2).cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))

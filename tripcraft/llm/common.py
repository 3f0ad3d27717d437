"""Helpers shared by the text operators: Arrow pieces, word spans and hashes.

Texts are handled as UTF-8 bytes of many documents at once: a *piece* is a run
of whole documents of one Arrow batch, so that NumPy works on long arrays and
memory stays bounded by the piece (or by the longest single document).
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripcraft.session import scratch_path

#: ASCII white space that separates words: space, tab, LF, VT, FF, CR.
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
PIECE_BYTES = 1 << 20
NO_ID = np.iinfo(np.int64).max

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_POW: dict[str, np.ndarray] = {}
#: Spans of more bytes are hashed one by one.
LONG_SPAN = 256
#: The first n of eight bytes.
_LANE = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` under the shared folder and read it back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_buckets(df: DataFrame, key: str, name: str) -> DataFrame:
    """Like ``write_table``, bucketed by ``key``: joins on it leave the table where it lies.

    ``df`` should be read from a written table, so that repeated tasks see the same rows.
    """
    spark = df.sparkSession
    n, table = shuffle_partitions(spark), table_name(name)
    df.repartition(n, key).write.bucketBy(n, key).option("path", scratch_path(spark, table)).saveAsTable(table)
    return spark.table(table)


def table_name(name: str) -> str:
    return f"{name}_{uuid.uuid4().hex[:12]}"


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fold(column: str, modulus: int):
    """crc32 of the id as text, modulo ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def solid_bytes(data: np.ndarray) -> np.ndarray:
    """Marks the bytes that aren't white space."""
    return ~_IS_SPACE[data]


def as_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(data, offsets) of a string or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[off[0]:off[-1]], off - off[0]


def pieces(offsets: np.ndarray, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges (first, end) of documents holding at most ``limit`` bytes, or one document."""
    first, n = 0, len(offsets) - 1
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        end = max(first + 1, min(end, n))
        yield first, end
        first = end


def text_pieces(batches, text: str = "text", limit: int = PIECE_BYTES):
    """(rows, data, offsets) for each piece of each Arrow batch; offsets start at 0."""
    for batch in batches:
        data, offsets = as_bytes(batch.column(text))
        for a, b in pieces(offsets, limit):
            yield batch.slice(a, b - a), data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective finaliser on 64-bit values."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """B^i and B^-i modulo 2^64 for i up to n, kept between pieces."""
    if "p" not in _POW or len(_POW["p"]) < n + 1:
        for name, base in (("p", _BASE), ("q", _BASE_INV)):
            out = np.full(max(n + 1, PIECE_BYTES + 1), base, np.uint64)
            out[0] = 1
            _POW[name] = np.multiply.accumulate(out)
    return _POW["p"][:n + 1], _POW["q"][:n + 1]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """S with S[j] - S[i] = sum of (data + 1) * B^position over [i, j)."""
    p, _ = powers(len(data))
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * p[:len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans [start, end)."""
    _, q = powers(len(prefix) - 1)
    return mix((prefix[ends] - prefix[starts]) * q[starts])


def span_digest(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans [start, end) that decide equality: eight bytes at a time, each mixed in.

    ``span_hash`` is a polynomial, for which unequal long words of one hash can be
    written down (Thue-Morse words); it serves as a filter only.
    """
    length = ends - starts
    h = mix(length.astype(np.uint64) + np.uint64(_BASE))
    long = np.flatnonzero(length > LONG_SPAN)
    left = np.flatnonzero((length > 0) & (length <= LONG_SPAN))
    padded = np.r_[data, np.zeros(8, np.uint8)]
    lanes = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))  # eight bytes from every place
    at, rest = starts[left], length[left]
    while len(left):
        lane = lanes[at] & _LANE[np.minimum(rest, 8)]
        h[left] = mix((h[left] ^ lane) * np.uint64(0x9FB21C651E98DF25) + np.uint64(1))
        more = rest > 8
        left, at, rest = left[more], at[more] + 8, rest[more] - 8
    for i in long:
        h[i] = xxhash.xxh3_64_intdigest(data[starts[i]:ends[i]].tobytes())
    return h


def run_hash(prefix: np.ndarray, n: int) -> np.ndarray:
    """``span_hash`` of all runs of n consecutive bytes."""
    _, q = powers(len(prefix) - 1)
    return mix((prefix[n:] - prefix[:-n]) * q[:len(prefix) - n])


def word_spans(data: np.ndarray, offsets: np.ndarray,
               solid: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each document, or runs of the bytes that ``solid`` marks.

    Returns starts, ends (bytes) and per document the index of its first word
    (one more entry than documents).
    """
    solid = solid_bytes(data) if solid is None else solid
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    before = np.empty(len(data), bool)
    before[:1] = False
    before[1:] = solid[:-1]
    after = np.empty(len(data), bool)
    after[-1:] = False
    after[:-1] = solid[1:]
    starts = np.flatnonzero(solid & (~before | first[:-1]))
    ends = np.flatnonzero(solid & (~after | first[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


#: 1 for digits, letters and bytes beyond ASCII, 0 for white space, 2 for other bytes.
BYTE_CLASS = np.full(256, 2, np.uint8)
BYTE_CLASS[list(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")] = 1
BYTE_CLASS[128:] = 1
BYTE_CLASS[list(SPACES)] = 0


def ngram_digest(units: np.ndarray, n: int) -> np.ndarray:
    """Like ``ngram_hash``, each unit mixed in before the next: hashes that decide equality."""
    out = np.zeros(max(len(units) - n + 1, 0), np.uint64)
    for j in range(n):
        out = mix((out ^ units[j:len(out) + j]) * np.uint64(0x9FB21C651E98DF25) + np.uint64(j + 1))
    return out


def ngram_hash(units: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n consecutive units (across document borders too)."""
    if len(units) < n:
        return np.zeros(0, np.uint64)
    out = units[:len(units) - n + 1].copy()
    for j in range(1, n):
        out *= np.uint64(_BASE)
        out += units[j:len(units) - n + 1 + j]
    return mix(out)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z; every other byte stays."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def importable(spark: SparkSession) -> None:
    """Let Python workers of this session find the package where the driver did.

    Sessions of one machine and shared installations need no more; elsewhere
    ship the package with ``spark-submit --py-files``.
    """
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [known, root]))


def has_rows(df: DataFrame) -> bool:
    return bool(df.take(1))

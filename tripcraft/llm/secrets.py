"""Operator 8, secret scans: fixed patterns, and random strings by token efficiency.

A tokenizer's vocabulary compresses written words well and random strings
badly. Long strings that get few characters per token are reported beside the
base patterns, as a whole or in a part between separators, after known digests,
UUIDs and numbers have been set aside.
"""

from __future__ import annotations

import base64
import re
from bisect import bisect_right
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed patterns of the base kinds; letters of the assign keywords count in either case (ASCII only).
ASSIGN = re.compile(
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ASSIGN_LEAST = 8
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")  # AKIA[A-Z0-9]+ of 16 or more
HEX = re.compile(r"[0-9a-f]{32,}")
KEYWORDS = ("password", "passwd", "secret", "token", "api")
KINDS = ("assign", "access", "hex", "random")

LEAST = 16
#: Shorter runs of letters written as words are (one case, or a capital first) are taken for words.
LEAST_LETTERS = 20
WRITTEN = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{LEAST},}}")
#: Parts between these are looked at in turn, when the string around them isn't reported.
PARTS = [re.compile(p) for p in (r"[^=]+", r"[^=/]+", r"[A-Za-z0-9]+")]
LEAST_RATIO = 2.2
#: Digest lengths in hex digits: MD5, SHA-1, SHA-224, SHA-256, SHA-384, SHA-512.
DIGESTS = (32, 40, 56, 64, 96, 128)
IDENTIFIER = re.compile(
    r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}"  # UUID
    r"|[0-9+/=_-]+"  # numbers, dates, rules
)


def is_known(text: str) -> bool:
    """Digests of usual lengths, UUIDs, numbers and words of less than LEAST_LETTERS letters."""
    if IDENTIFIER.fullmatch(text) or len(text) < LEAST_LETTERS and WRITTEN.fullmatch(text):
        return True
    return len(text) in DIGESTS and re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", text) is not None


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base kinds, leftmost without overlap per kind."""
    low = text.lower()
    out = []
    if any(word in low for word in KEYWORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    return out + [(m.start(), 2, m.end()) for m in HEX.finditer(text)]


def random_spans(text: str, n_tokens, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Candidates, or parts of them, of few characters per token that no base span holds already."""
    out = []
    base = sorted(base)
    starts = [a for a, _, _ in base]
    reach = list(accumulate((b for _, _, b in base), max))  # furthest end of the spans that start so far

    def held(start: int, end: int) -> bool:
        i = bisect_right(starts, start)
        return i > 0 and reach[i - 1] >= end

    def look(start: int, word: str, level: int) -> None:
        if len(word) < LEAST or is_known(word):
            return
        if len(word) < LEAST_RATIO * n_tokens(word):
            if not held(start, start + len(word)):
                out.append((start, 3, start + len(word)))
            return
        for i in range(level, len(PARTS)):
            parts = list(PARTS[i].finditer(word))
            if len(parts) > 1 or parts and len(parts[0][0]) < len(word):
                for part in parts:
                    look(start + part.start(), part[0], i + 1)
                return

    for m in CANDIDATE.finditer(text):
        look(m.start(), m[0], 0)
    return out


def scanner(path: str, pattern: str):
    """find(text) -> [(start, kind number, end)], sorted; ``path`` is a tiktoken rank file."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    encoding = tiktoken.Encoding("secrets", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def find(text: str | None) -> list[tuple[int, int, int]]:
        if not text:
            return []
        base = base_spans(text)
        return sorted(base + random_spans(text, lambda w: len(encoding.encode_ordinary(w)), base))

    return find


SPANS = "array<struct<kind:string,start:long,end:long>>"
_ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def find_secrets(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and spans (kind, start, end in code points, end exclusive) of every row.

    Sorted by start, then kind in the order assign, access, hex, random. Null
    and empty texts have none; repeated rows and null ids give rows of their
    own; other columns are ignored.
    """

    def scan(batches):
        find = scanner(path, pattern)
        for batch in batches:
            found = [[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in find(t)]
                     for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, _ARROW_SPANS)],
                                             ["doc_id", "spans"])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(scan, f"doc_id long, spans {SPANS}")


def redact_secrets(docs: DataFrame, path: str, pattern: str, text: str = "text",
                   mark: str = "[SECRET]") -> DataFrame:
    """The same rows and columns, with ``mark`` in place of each maximal secret span of the text."""

    def redact(batches):
        find = scanner(path, pattern)
        for batch in batches:
            out = []
            for t in batch.column(text).to_pylist():
                parts, at = [], 0
                for a, _, b in find(t):
                    if a >= at:
                        parts += [t[at:a], mark]
                    at = max(at, b)
                out.append("".join([*parts, t[at:]]) if parts else t)
            i = batch.schema.get_field_index(text)
            yield batch.set_column(i, batch.schema.field(i), pa.array(out, batch.schema.field(i).type))

    return docs.mapInArrow(redact, docs.schema)


def op8(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    def said(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long")

    base = F.filter("spans", lambda s: s.kind != "random")
    return find_secrets(docs, path, pattern).select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
        count("hex").alias("n_hex"), F.sha2(said(base).cast("binary"), 256).alias("base_sha256"),
        said(F.col("spans")).alias("spans"))

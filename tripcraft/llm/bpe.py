"""Operator 4, BPE encoding and decoding with a file of the ``tokenizers`` library.

White space never reaches the vocabulary's merges (the pattern that splits text
drops it), so a text's ids are the ids of its words in order; each distinct
word is encoded once per task. Long unsplit words go through tree
concatenation: halves are encoded on their own, and at each join growing
windows are encoded again until they agree with both sides, which makes the
result the encoding of the whole (a token sequence is the encoding of its text
exactly if every two neighbours are the encoding of theirs).
"""

from __future__ import annotations

import json
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripcraft.llm.common import solid_bytes, text_pieces, word_spans

#: Bytes from which a word is encoded by tree concatenation, and characters of a leaf.
LONG_WORD = 4096
LEAF = 1024
CACHED_WORDS = 500_000


class TreeEncoder:
    """Encodes one unsplit piece of byte-level characters by halves."""

    def __init__(self, model: dict):
        from tokenizers import Tokenizer
        from tokenizers.models import BPE

        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        own = {k: model[k] for k in ("unk_token", "continuing_subword_prefix", "fuse_unk", "byte_fallback")
               if model.get(k) is not None}
        suffix = model.get("end_of_word_suffix")
        # One model ends the word, the other continues it.
        self.ending = Tokenizer(BPE(model["vocab"], merges, **own,
                                    **({"end_of_word_suffix": suffix} if suffix else {})))
        self.going_on = Tokenizer(BPE(model["vocab"], merges, **own))

    def _encode(self, texts: list[str], ends: list[bool]) -> list[list[tuple[int, str]]]:
        """(id, text) pairs; ``ends`` says which texts end the word."""
        out: list = [None] * len(texts)
        for tokenizer, which in ((self.ending, True), (self.going_on, False)):
            at = [i for i, e in enumerate(ends) if e is which]
            for i, e in zip(at, tokenizer.encode_batch([texts[i] for i in at], add_special_tokens=False),
                            strict=True):
                out[i] = [(t, texts[i][a:b]) for t, (a, b) in zip(e.ids, e.offsets, strict=True)]
        return out

    def _join(self, left: list, right: list, ends: bool) -> list:
        i = j = 1
        while True:
            i, j = min(i, len(left)), min(j, len(right))
            text = "".join(t for _, t in left[-i:]) + "".join(t for _, t in right[:j])
            new = self._encode([text], [ends and j == len(right)])[0]
            left_agrees = i == len(left) or new[0] == left[-i]
            right_agrees = j == len(right) or new[-1] == right[j - 1]
            if left_agrees and right_agrees:
                return left[:-i] + new + right[j:]
            i, j = i * (1 if left_agrees else 2), j * (1 if right_agrees else 2)

    def encode(self, text: str) -> list[int]:
        leaves = [text[i:i + LEAF] for i in range(0, len(text), LEAF)]
        parts = self._encode(leaves, [False] * (len(leaves) - 1) + [True])
        while len(parts) > 1:
            parts = [self._join(parts[i], parts[i + 1], i + 2 >= len(parts)) if i + 1 < len(parts) else parts[i]
                     for i in range(0, len(parts), 2)]
        return [t for t, _ in parts[0]]


class WordEncoder:
    """Token ids of words, kept for words seen before; bounded by CACHED_WORDS."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.spec = json.load(open(path, encoding="utf-8"))
        self.tree = None
        added = [t["content"] for t in self.spec["added_tokens"]]
        self.added = {t["content"]: t["id"] for t in self.spec["added_tokens"]}
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")")
        size = max(self.tokenizer.get_vocab(with_added_tokens=True).values()) + 1
        self.tokens = pa.array([self.tokenizer.id_to_token(i) or "" for i in range(size)], pa.large_string())
        self.forget()

    def forget(self) -> None:
        self.slot: dict[bytes, int] = {}
        self.ids, self.begin = np.zeros(1 << 16, np.uint32), [0]

    def long_word(self, word: str) -> list[int]:
        if self.tree is None:
            self.tree = TreeEncoder(self.spec["model"])
        out: list[int] = []
        for part in self.special.split(word) if self.added else [word]:
            if part in self.added:
                out.append(self.added[part])
            elif part:
                part = self.tokenizer.normalizer.normalize_str(part)
                for piece, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(part):
                    out.extend(self.tree.encode(piece))
        return out

    def slots(self, words: list[bytes]) -> np.ndarray:
        if len(self.slot) + len(words) > CACHED_WORDS:
            self.forget()
        new = [w for w in words if w not in self.slot]
        short = [w for w in new if len(w) < LONG_WORD]
        encoded = dict(zip(short, (e.ids for e in self.tokenizer.encode_batch_fast(
            [w.decode() for w in short], add_special_tokens=False)), strict=True))
        for word in new:
            ids = encoded[word] if word in encoded else self.long_word(word.decode())
            at = self.begin[-1]
            while at + len(ids) > len(self.ids):
                self.ids = np.r_[self.ids, np.zeros_like(self.ids)]
            self.ids[at:at + len(ids)] = ids
            self.slot[word] = len(self.begin) - 1
            self.begin.append(at + len(ids))
        return np.array([self.slot[w] for w in words], np.int64)

    def encode(self, data: np.ndarray, offsets: np.ndarray):
        """(ids of all documents, document borders in them)."""
        starts, ends, doc_at = word_spans(data, offsets)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        word_at = np.r_[0, np.cumsum(ends - starts)].astype(np.int64)
        words = pa.Array.from_buffers(pa.large_binary(), len(starts), [
            None, pa.py_buffer(word_at.tobytes()), pa.py_buffer(data[solid_bytes(data)].tobytes())])
        coded = words.dictionary_encode()
        slot = self.slots(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        begin = np.array(self.begin, np.int64)
        count = np.diff(begin)[slot]
        at = np.r_[0, np.cumsum(count)]
        inner = np.arange(at[-1]) - np.repeat(at[:-1], count)
        return self.ids[np.repeat(begin[slot], count) + inner], at[doc_at]

    def decode(self, ids: np.ndarray, borders: np.ndarray) -> pa.Array:
        """As the library does for a file without a decoder: tokens joined by a space."""
        lists = pa.LargeListArray.from_arrays(pa.array(borders, pa.int64()), self.tokens.take(pa.array(ids)))
        return pc.binary_join(lists, pa.scalar(" ", pa.large_string()))


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit) and decoded text of every row.

    ``path`` names a tokenizer file that every executor can read, without a
    decoder part. Equal to the library's encode(text, add_special_tokens=False)
    and decode(ids, skip_special_tokens=False). Null texts count as empty: no
    ids, empty decoded text. Repeated rows and null ids give rows of their own;
    other columns are ignored.
    """

    def encode_rows(batches):
        encoder = WordEncoder(path)
        if encoder.spec.get("decoder") is not None:
            raise ValueError("a tokenizer file with a decoder part isn't supported")
        for rows, data, offsets in text_pieces(batches):
            ids, borders = encoder.encode(data, offsets)
            yield pa.RecordBatch.from_arrays([
                rows.column("doc_id"), pa.array(np.diff(borders)),
                pa.Array.from_buffers(pa.large_binary(), rows.num_rows, [
                    None, pa.py_buffer((borders * 4).tobytes()), pa.py_buffer(ids.astype("<u4").tobytes())],
                ).cast(pa.binary()),
                encoder.decode(ids, borders).cast(pa.string())], ["doc_id", "n_tokens", "ids", "decoded"])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(encode_rows, "doc_id long, n_tokens long, ids binary, decoded string")


def op4(docs: DataFrame, path: str) -> DataFrame:
    return encode(docs, path).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))

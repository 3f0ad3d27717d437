"""Operator 6, Jaccard join of documents on word n-grams, and the components it links.

Documents become sets of hashed shingles, ordered rare first by the
number of documents that hold each shingle. Equal sets are one class. A class's
prefix is its first n - ceil(t * n) + 1 shingles: sets of Jaccard similarity t
or more share one of them. Candidates from prefix matches pass the length,
positional and suffix filters and are verified once per pair.

Links are first sought between the members of each prefix shingle's list and
one of them (the centre, another one for each shingle), which joins tight groups of near copies without
listing their pairs; then all candidates that still stand in different
components are verified. Within the finished components, block products count
the links of every class.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripcraft.llm import repeats as R
from tripcraft.llm.common import (
    NO_ID, has_rows, lower_ascii, ngram_digest, pieces, shuffle_partitions, span_digest, word_spans, write_buckets,
    write_table,
)

SHINGLE = 5
#: Similarity from which documents link, in hundredths.
PERCENT = 75
#: Sets in one side of a block product.
BLOCK = 256
#: Rounds in which members are compared to one centre for each prefix shingle; they end early where no list spans components.
CENTRE_ROUNDS = 3
#: Columns of 64 bits that sketch a set: bit i is the parity of the elements that hash to i.
SKETCH = [f"s{i}" for i in range(16)]
COUNTS = "bucket long, chunk long, prints binary, counts binary"
FREQUENT = "chunk long, bucket long, prints binary, totals binary"
SETS = "id long, text_hash long, n long, n_lone long, digest binary, shingles binary"


def least_overlap(n_x, n_y, percent: int = PERCENT):
    """Smallest intersection of sets of these sizes with 100 * |x & y| >= percent * |x | y|."""
    return -(-percent * (n_x + n_y) // (100 + percent))


def prefix_size(n, percent: int = PERCENT):
    return n - -(-percent * n // 100) + 1


# --- shingle sets --------------------------------------------------------------------


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE):
    """(hashes, document of each) of the distinct shingles, sorted within documents."""
    data = lower_ascii(data)
    starts, ends, doc_at = word_spans(data, offsets)
    words = span_digest(data, starts, ends)
    n_words = np.diff(doc_at)
    grams = ngram_digest(words, size)
    count = np.maximum(n_words - size + 1, 0)
    doc = np.repeat(np.arange(len(count)), count)
    at = np.repeat(doc_at[:-1], count) + np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    grams = grams[at]
    short = np.flatnonzero((n_words > 0) & (n_words < size))
    whole = [ngram_digest(words[doc_at[d]:doc_at[d + 1]], n_words[d])[0] ^ np.uint64(n_words[d]) for d in short]
    grams = np.r_[grams, np.array(whole, np.uint64)]
    doc = np.r_[doc, short]
    order = np.lexsort((grams, doc))
    grams, doc = grams[order], doc[order]
    if len(grams):
        keep = np.r_[True, (grams[1:] != grams[:-1]) | (doc[1:] != doc[:-1])]
        grams, doc = grams[keep], doc[keep]
    return grams, doc


def text_hash(text: np.ndarray) -> int:
    """Spark's xxhash64 of the text."""
    return xxhash.xxh64_intdigest(text.tobytes(), 42) - (1 << 63) ^ -(1 << 63)


def _chunk_sets(row, size):
    """(first document, documents, hashes, document of each) for pieces of a chunk."""
    chunk = R.Chunk(row, R.Window(True, size, size))
    for a, b in pieces(chunk.offsets, 1 << 20):
        data = chunk.data[chunk.offsets[a]:chunk.offsets[b]]
        yield chunk, a, b, *shingle_sets(data, chunk.offsets[a:b + 1] - chunk.offsets[a], size)


def frequent_shingles(chunks: DataFrame, shards: int, size: int) -> DataFrame:
    """Per chunk and bucket: fingerprints of shingles that two or more documents hold, and how many do."""

    def count(frames):
        for frame in frames:
            for row in frame.to_dict("records"):
                own = [grams for _, _, _, grams, _ in _chunk_sets(row, size)]
                grams, counts = np.unique(np.concatenate([*own, np.zeros(0, np.uint64)]), return_counts=True)
                bucket, code = R._code(grams, shards)
                order = np.argsort(bucket, kind="stable")
                bucket, code, counts = bucket[order], code[order], counts[order].astype(np.uint32)
                cut = np.flatnonzero(np.r_[True, np.diff(bucket) != 0, True]) if len(bucket) else [0]
                yield pd.DataFrame(
                    [(int(bucket[a]), row["chunk"], code[a:b].tobytes(), counts[a:b].tobytes())
                     for a, b in zip(cut[:-1], cut[1:], strict=True)],
                    columns=["bucket", "chunk", "prints", "counts"])

    def total(frame: pd.DataFrame) -> pd.DataFrame:
        sizes = frame["prints"].map(len).to_numpy() // 4
        code = np.frombuffer(b"".join(frame["prints"]), np.uint32)
        counts = np.frombuffer(b"".join(frame["counts"]), np.uint32).astype(np.int64)
        _, group = np.unique(code, return_inverse=True)
        totals = np.bincount(group, weights=counts)[group].astype(np.int64) if len(group) else counts
        out = []
        for i, (a, b) in enumerate(zip(np.r_[0, np.cumsum(sizes)[:-1]], np.cumsum(sizes), strict=True)):
            keep = np.flatnonzero(totals[a:b] >= 2) + a
            if len(keep):
                out.append((int(frame["chunk"].iat[i]), int(frame["bucket"].iat[i]), code[keep].tobytes(),
                            np.minimum(totals[keep], (1 << 32) - 1).astype(np.uint32).tobytes()))
        return pd.DataFrame(out, columns=["chunk", "bucket", "prints", "totals"])

    sent = chunks.select("chunk", "ids", "no_id", "sizes", "text").mapInPandas(count, COUNTS)
    return sent.groupBy("bucket").applyInPandas(total, FREQUENT)


def document_sets(chunks: DataFrame, frequent: DataFrame, shards: int, size: int, percent: int) -> DataFrame:
    """One row per document; digest and shingles (rare first) only where it can have a partner.

    A partner shares at least percent % of a document's shingles, and each of
    those is held by two documents or more.
    """

    def sets(row_frame: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        sizes = replies["prints"].map(len).to_numpy() // 4 if len(replies) else np.zeros(0, int)
        code = np.frombuffer(b"".join(replies["prints"]), np.uint32).astype(np.int64)
        known = np.repeat(replies["bucket"].to_numpy(np.int64), sizes) << 32 | code
        order = np.argsort(known)
        known = known[order]
        totals = np.frombuffer(b"".join(replies["totals"]), np.uint32)[order].astype(np.int64)
        out = []
        for row in row_frame.to_dict("records"):
            for chunk, a, b, grams, doc in _chunk_sets(row, size):
                held = np.ones(len(grams), np.int64)
                if len(known):
                    bucket, code = R._code(grams, shards)
                    key = bucket << 32 | code
                    at = np.minimum(np.searchsorted(known, key), len(known) - 1)
                    held = np.where(known[at] == key, totals[at], 1)
                n = np.bincount(doc, minlength=b - a)
                lone = np.bincount(doc[held < 2], minlength=b - a)
                begin = np.cumsum(n) - n
                for d in range(b - a):
                    ident = None if chunk.no_id[a + d] else int(chunk.ids[a + d])
                    hashed = text_hash(chunk.data[chunk.offsets[a + d]:chunk.offsets[a + d + 1]])
                    if n[d] and 100 * (n[d] - lone[d]) >= percent * n[d]:
                        own = grams[begin[d]:begin[d] + n[d]]
                        out.append((ident, hashed, n[d], lone[d], xxhash.xxh128_digest(own.tobytes()),
                                    own[np.lexsort((own, held[begin[d]:begin[d] + n[d]]))].tobytes()))
                    else:
                        out.append((ident, hashed, n[d], lone[d], None, None))
        return pd.DataFrame(out, columns=["id", "text_hash", "n", "n_lone", "digest", "shingles"])

    texts = chunks.select("chunk", "ids", "no_id", "sizes", "text")
    return texts.groupBy("chunk").cogroup(frequent.groupBy("chunk")).applyInPandas(sets, SETS)


# --- links ---------------------------------------------------------------------------


def prefix_entries(classes: DataFrame, percent: int) -> DataFrame:
    """(shingle, class, n, place) for the prefix shingles that another document holds."""

    def explode(batches):
        for batch in batches:
            parts = []
            for cid, n, lone, data in zip(*(batch.column(c).to_pylist() for c in ("cid", "n", "n_lone", "shingles")),
                                          strict=True):
                own = np.frombuffer(data, np.int64)[lone:prefix_size(n, percent)]
                parts.append((own, np.full(len(own), cid), np.full(len(own), n), np.arange(lone, lone + len(own))))
            cols = [np.concatenate(x).astype(np.int64) for x in zip(*parts, strict=True)] if parts else [
                np.zeros(0, np.int64)] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["shingle", "cid", "n", "place"])

    return classes.select("cid", "n", "n_lone", "shingles").mapInArrow(
        explode, "shingle long, cid long, n long, place long")


def sketches(classes: DataFrame) -> DataFrame:
    """(cid, SKETCH columns) of all classes."""
    bits = 64 * len(SKETCH)

    def sketch(batches):
        for batch in batches:
            odd = [np.bincount(np.frombuffer(s, np.int64) & (bits - 1), minlength=bits) & 1
                   for s in batch.column("shingles").to_pylist()]
            words = np.packbits(np.array(odd, bool).reshape(-1, bits), axis=1, bitorder="little").view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("cid"), *(pa.array(np.ascontiguousarray(words[:, i])) for i in range(len(SKETCH)))],
                ["cid", *SKETCH])

    return classes.select("cid", "shingles").mapInArrow(
        sketch, ", ".join(f"{name} long" for name in ["cid", *SKETCH]))


def passes_filters(percent: int):
    """Length, prefix and positional filters on two prefix entries a, b of one shingle.

    For two given sizes already the first n - least_overlap + 1 shingles share one.
    """
    a_n, b_n = F.col("a.n"), F.col("b.n")
    return ((100 * F.least(a_n, b_n) >= percent * F.greatest(a_n, b_n))
            & (F.col("a.place") <= a_n - _least(percent)) & (F.col("b.place") <= b_n - _least(percent))
            & (F.least(a_n - F.col("a.place"), b_n - F.col("b.place"))
               >= _least(percent) - F.least(F.col("a.place"), F.col("b.place"))))


def passes_sketch(percent: int):
    """Two sets differ in at least as many elements as their sketches in bits."""
    differ = sum((F.bit_count(F.col(f"a.{c}").bitwiseXOR(F.col(f"b.{c}"))) for c in SKETCH), F.lit(0))
    return differ <= F.col("a.n") + F.col("b.n") - 2 * _least(percent)


def _least(percent: int):
    return F.ceil(percent * (F.col("a.n") + F.col("b.n")) / F.lit(100 + percent))


def suffix_filter(x: np.ndarray, y: np.ndarray, most: int, depth: int = 2) -> bool:
    """False if the sorted sets must differ in more than ``most`` elements, from halves of halves."""

    def least(a, b, depth):
        gap = abs(len(a) - len(b))
        if depth == 0 or not len(a) or not len(b) or gap > most:
            return gap
        middle = b[len(b) // 2]
        i, j = np.searchsorted(a, middle), len(b) // 2
        return least(a[:i], b[:j], depth - 1) + least(a[i:], b[j:], depth - 1)

    return least(x, y, depth) <= most


def verified(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose sets have the similarity; each is verified once."""

    def check(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
                x, y = np.sort(np.frombuffer(x, np.int64)), np.sort(np.frombuffer(y, np.int64))
                least = least_overlap(len(x), len(y), percent)
                keep.append(suffix_filter(x, y, len(x) + len(y) - 2 * least)
                            and len(np.intersect1d(x, y, assume_unique=True)) >= least)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    sets = classes.select("cid", "shingles")
    both = (pairs.join(sets.select(F.col("cid").alias("a"), F.col("shingles").alias("x")), "a")
            .join(sets.select(F.col("cid").alias("b"), F.col("shingles").alias("y")), "b"))
    return both.select("a", "b", "x", "y").mapInArrow(check, "a long, b long")


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(cid, comp) with the smallest cid that each node reaches; links are (a, b).

    Every round gives each node the smallest label among itself and its
    neighbours, lowers the node that its label names to the same, and takes the label of that
    label, so that whole trees are hooked and labels jump along paths: a path
    takes rounds by the logarithm of its length. Rounds go on until no label changes.
    """
    both = write_table(links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct(), "links")
    labels = nodes.select("cid", F.col("cid").alias("comp"))
    touched = write_table(both.select(F.col("a").alias("cid")).distinct().withColumn("comp", F.col("cid")), "labels")
    while True:
        near = (both.join(touched.select(F.col("cid").alias("b"), "comp"), "b")
                .groupBy(F.col("a").alias("cid")).agg(F.min("comp").alias("near")))
        low = touched.join(near, "cid").select("cid", "comp", F.least("comp", "near").alias("low"))
        hooks = low.where("low < comp").groupBy(F.col("comp").alias("cid")).agg(F.min("low").alias("hook"))
        low = write_table(low.join(hooks, "cid", "left").select("cid", "comp", F.least("low", "hook").alias("low")), "hooked")
        jump = low.select(F.col("cid").alias("low"), F.col("low").alias("further"))
        new = write_table(low.join(jump, "low").select(
            "cid", F.least("low", "further").alias("comp"), (F.least("low", "further") < F.col("comp")).alias("moved")),
            "labels")
        touched = new.select("cid", "comp")
        if not new.where("moved").take(1):
            break
    return labels.join(touched.withColumnRenamed("comp", "reached"), "cid", "left").select(
        "cid", F.coalesce("reached", "comp").alias("comp"))


def contracted(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after joining the components that the links (a, b) connect; many links between two count once."""
    ends = (links.join(labels.select(F.col("cid").alias("a"), F.col("comp").alias("ca")), "a")
            .join(labels.select(F.col("cid").alias("b"), F.col("comp").alias("cb")), "b"))
    edges = write_table(ends.select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b"))
                        .where("a < b").distinct(), "edges")
    nodes = labels.select(F.col("comp").alias("cid")).distinct()
    merged = components(nodes, edges).select(F.col("cid").alias("comp"), F.col("comp").alias("into"))
    return labels.join(merged, "comp").select("cid", F.col("into").alias("comp"))


def link_components(classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(cid, comp) for all classes; ``sets`` holds them in buckets."""
    spark = classes.sparkSession
    entries = prefix_entries(classes, percent)
    several = entries.groupBy("shingle").agg(F.count("*").alias("c")).where("c > 1").select("shingle")
    entries = write_table(entries.join(several, "shingle"), "entries")
    labels = classes.select("cid", F.col("cid").alias("comp"))
    seen = spark.createDataFrame([], "a long, b long")
    for turn in range(CENTRE_ROUNDS + 1):
        held = entries.join(labels, "cid") if turn else entries.withColumn("comp", F.col("cid"))
        if turn:  # only shingles whose list still spans components; the others never will again
            mixed = write_table(held.groupBy("shingle").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
                                .where("lo < hi").select("shingle"), "mixed")
            if not has_rows(mixed):
                break
            held = write_table(held.join(mixed, "shingle"), "held")
            entries = held.drop("comp")
        if turn < CENTRE_ROUNDS:
            rank = F.xxhash64("cid", "shingle", F.lit(turn))
            other = write_table(held.groupBy("shingle").agg(
                F.min(F.struct(rank.alias("r"), "cid", "n", "place", "comp")).alias("m"))
                .select("shingle", "m.*"), "centres")
            fits = (F.col("a.comp") != F.col("b.comp")) & passes_filters(percent)
        else:
            held = other = write_table(held.join(sketches(classes), "cid"), "held")
            fits = (F.col("a.comp") < F.col("b.comp")) & passes_filters(percent) & passes_sketch(percent)
        pairs = write_table(
            held.alias("a").join(other.alias("b"), "shingle").where(fits)
            .select(F.least("a.cid", "b.cid").alias("a"), F.greatest("a.cid", "b.cid").alias("b")).distinct()
            .join(seen, ["a", "b"], "left_anti"), "pairs")
        if has_rows(pairs):
            found = write_table(verified(pairs, sets, percent), "found")
            seen = seen.union(pairs)
            labels = write_table(contracted(labels, found), "components")
    return labels


def count_links(classes: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """(cid, n_near): documents of other classes that each class links with.

    Linked classes are in one component, so the pairs of each component's
    classes are counted, in products of blocks; none is listed.
    """
    spark = classes.sparkSession
    sizes = labels.groupBy("comp").agg(F.count("*").alias("g")).where("g > 1")
    member = labels.join(sizes, "comp").withColumn("blocks", F.ceil(F.col("g") / BLOCK))
    member = member.withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")))
    sets = classes.select("cid", "n", "copies", "shingles").join(member, "cid")
    # Every block meets each block of its component in one group, named by the pair.
    paired = (sets.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
              .withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other"))
              .withColumn("task", F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("comp"), F.lit(
                  16 * shuffle_partitions(spark)))).otherwise(F.xxhash64("comp", "lo", "hi"))))

    def count(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (_, lo, hi), part in frame.groupby(["comp", "lo", "hi"]):
            left, right = part[part["block"] == lo], part[part["block"] == hi]
            near = _linked(left, right, percent)
            out.append((left["cid"].to_numpy(), near @ right["copies"].to_numpy()))
            if lo != hi:
                out.append((right["cid"].to_numpy(), left["copies"].to_numpy() @ near))
        cid, number = (np.concatenate(x) for x in zip(*out, strict=True))
        return pd.DataFrame({"cid": cid, "n_near": number})

    return (paired.groupBy("task").applyInPandas(count, "cid long, n_near long")
            .groupBy("cid").agg(F.sum("n_near").alias("n_near")))


def _linked(left: pd.DataFrame, right: pd.DataFrame, percent: int) -> np.ndarray:
    """Which classes of two blocks link, as integers; a class doesn't link with itself."""
    x = [np.frombuffer(s, np.int64) for s in left["shingles"]]
    y = [np.frombuffer(s, np.int64) for s in right["shingles"]]
    flat = np.concatenate(x + y)
    _, code = np.unique(flat, return_inverse=True)
    row = np.repeat(np.arange(len(x) + len(y)), [len(s) for s in x + y])
    shared = np.zeros((len(x), len(y)), np.int64)
    for at in range(0, int(code.max()) + 1, 1 << 13):  # in strips of shingles: memory stays bounded
        some = (code >= at) & (code < at + (1 << 13))
        held = np.zeros((len(x) + len(y), 1 << 13), np.float32)
        held[row[some], code[some] - at] = 1
        shared += (held[:len(x)] @ held[len(x):].T).astype(np.int64)
    n_x, n_y = left["n"].to_numpy()[:, None], right["n"].to_numpy()[None, :]
    near = 100 * shared >= percent * (n_x + n_y - shared)
    return (near & (left["cid"].to_numpy()[:, None] != right["cid"].to_numpy()[None, :])).astype(np.int64)


def jaccard_components(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, key: str = "doc_id",
                       text: str = "text", links: bool = True) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable by links) and n_links, one row per input row.

    Without ``links`` the links aren't counted, whose work is quadratic in a
    component's different sets, and n_links is null.

    Also text_hash (Spark's xxhash64 of the text, empty for null) and stays:
    whether the row has its component's smallest (id, text_hash).

    A-Z count as a-z; words are runs of bytes other than ASCII white space; a
    document with fewer than ``size`` words has its whole sequence as one
    shingle. Null texts and texts without words have no shingles and link with
    nothing. Repeated rows are documents of their own that link with each
    other. A null id counts as larger than all others: a component of null ids
    only has a null component_id. Other columns are ignored.
    """
    chunks = R.store(docs, key, text)
    shards = R.shard_count(chunks)
    sets = write_table(document_sets(chunks, frequent_shingles(chunks, shards, size), shards, size, percent), "sets")
    able = sets.where(F.col("digest").isNotNull()).withColumn("rank", F.coalesce("id", F.lit(int(NO_ID))))
    classes = write_table(
        able.groupBy("digest", "n").agg(F.min(F.struct("rank", "text_hash")).alias("lowest"),
                                        F.count("*").alias("copies"), F.first("n_lone").alias("n_lone"),
                                        F.first("shingles").alias("shingles"))
        .withColumn("cid", F.monotonically_increasing_id()), "classes")
    # Joined on cid in every round.
    buckets = write_buckets(classes.select("cid", "n", "copies", "shingles"), "cid", "held_sets")
    labels = link_components(classes, buckets, percent)
    own = classes.select("cid", "digest", "n", "lowest", "copies").join(labels, "cid")
    lowest = own.groupBy("comp").agg(F.min("lowest").alias("first"))
    own = own.join(lowest, "comp")
    if links:
        own = own.join(count_links(buckets, labels, percent), "cid", "left").withColumn(
            "n_links", F.col("copies") - 1 + F.coalesce("n_near", F.lit(0)))
    else:
        own = own.withColumn("n_links", F.lit(None).cast("long"))
    result = write_table(own.select("digest", "n", "first", "n_links"), "result")
    linked = able.select("id", "rank", "text_hash", "n", "digest").join(result, ["digest", "n"]).select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
        F.when(F.col("first.rank") < int(NO_ID), F.col("first.rank")).alias("component_id"), "n_links", "text_hash",
        (F.struct("rank", "text_hash") == F.col("first")).alias("stays"))
    alone = sets.where(F.col("digest").isNull()).select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("id").alias("component_id"),
        F.lit(0).cast("long").alias("n_links"), "text_hash", F.lit(True).alias("stays"))
    return linked.unionByName(alone)


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (doc_id, text and any others), one for each component; all columns stay.

    The smallest id stays, then the smallest text hash. Of repeated rows one
    stays if they have words; rows without words link with nothing and all stay.
    """
    found = write_table(jaccard_components(docs, links=False).where("stays").select("doc_id", "text_hash", "n_shingles"), "stays")
    rank = F.coalesce(F.col("doc_id").cast("long"), F.lit(int(NO_ID))).alias("_rank")
    kept = found.select(rank, F.col("text_hash").alias("_hash"), (F.col("n_shingles") > 0).alias("_words"))
    again = kept.where("_words").groupBy("_rank", "_hash").count().where("count > 1")
    rows = docs.select(F.struct(*docs.columns).alias("_row"), rank,
                       F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("_hash"))
    rows = rows.join(kept.distinct(), ["_rank", "_hash"])
    if has_rows(again):
        once = rows.where("_words").groupBy("_rank", "_hash").agg(F.first("_row").alias("_row")).select("_row")
        rows = rows.where("NOT _words").select("_row").union(once)
    return rows.select("_row.*")


def op6(docs: DataFrame) -> DataFrame:
    return jaccard_components(docs).select("doc_id", "n_shingles", "component_id", "n_links")

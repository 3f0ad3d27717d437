"""Operator 13, filter interaction audit by higher-order SQL folds.

Every document gets a mask of the filters that it fails. Documents of one part
and mask are alike, so each such cell is folded once across the array of all
filter orders (a constant of the plan): ``transform`` over the orders,
``aggregate`` over the steps of an order. The 600 weighted structs of the cells
of a part, at most 32 cells, are added element by element.

Built from DataFrame functions only. What is shuffled is a row per document
without its text, reduced before each exchange, so that a text, an id or a part
that holds a third of all rows sends a row per task and cell.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripcraft.llm.common import write_table

SPLIT = r"[\x20\x09-\x0D]+"
#: Filters by letter; ``E``, an earlier copy in the whole table, comes from ``earlier_copies``.
LETTERS = "ABCDE"
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_UPPER_PERCENT = 3
MARKS = "[#$%&*|]"

COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
_STEP = "struct<letter:string," + ",".join(f"{c}:bigint" for c in COUNTS) + ">"


def text_failures(text: Column) -> dict[str, Column]:
    """Failure conditions of the filters that look at one (non-null) text."""
    words = F.filter(F.split(text, SPLIT), lambda w: w != "")
    # One-element arrays bind a value once for all its uses.
    sizes = F.transform(F.array(words), lambda w: F.struct(
        F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("distinct")))[0]
    return {
        "A": sizes["n"] < MIN_WORDS,
        "B": 100 * sizes["distinct"] < MIN_DISTINCT_PERCENT * sizes["n"],
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")).cast("long") > MAX_UPPER_PERCENT * F.length(text).cast("long"),
        "D": text.rlike(MARKS),
    }


def masked(docs: DataFrame) -> DataFrame:
    """doc_id, part, digest of the text and mask of the filters of ``text_failures``, and how many rows are so."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("part"),
        F.unhex(F.sha2(F.encode(text, "UTF-8"), 256)).alias("digest"), F.explode(F.array(text)).alias("t"))
    mask = F.lit(0)
    for letter, fails in text_failures(F.col("t")).items():
        mask = mask + F.when(fails, 1 << LETTERS.index(letter)).otherwise(0)
    return (rows.select("doc_id", "part", "digest", mask.alias("mask"))
            .groupBy("doc_id", "part", "digest", "mask").agg(F.count("*").alias("n")))


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``good`` and ``toxic`` (0 or 1): whether any label row of the id says so; a null id has none."""
    marks = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    known = rows.where(F.col("doc_id").isNotNull()).join(marks, "doc_id", "left")
    return (known.unionByName(rows.where(F.col("doc_id").isNull()), allowMissingColumns=True)
            .fillna(0, ["good", "toxic"]))


def earlier_copies(rows: DataFrame) -> DataFrame:
    """(part, mask, good, toxic, n): cells with filter ``E`` in the mask.

    A row fails it if a row of a smaller id has its text, anywhere in the
    table; rows without an id neither fail it nor make others fail.
    """
    kind = ["digest", "part", "mask", "good", "toxic"]
    same = rows.groupBy(*kind).agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("unnamed"),
        F.min("doc_id").alias("first"),
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).getField("n").alias("at_first"))
    # A text has a row per part and label here, however many documents hold it.
    earliest = same.groupBy("digest").agg(F.min("first").alias("earliest"))
    passes = F.col("unnamed") + F.when(F.col("first") == F.col("earliest"), F.col("at_first")).otherwise(0)
    split = same.join(earliest, "digest").select(
        "part", "mask", "good", "toxic", F.inline(F.array(
            F.struct(F.lit(0).alias("copy"), passes.alias("rows")),
            F.struct(F.lit(1 << LETTERS.index("E")).alias("copy"), (F.col("n") - passes).alias("rows")))))
    return (split.where(F.col("rows") > 0)
            .groupBy("part", (F.col("mask") + F.col("copy")).alias("mask"))
            .agg(F.sum("rows").alias("n"), F.sum(F.col("rows") * F.col("good")).alias("good"),
                 F.sum(F.col("rows") * F.col("toxic")).alias("toxic")))


def _orders() -> Column:
    return F.array(*[F.lit("".join(p)) for p in permutations(LETTERS)])


def _steps(order: Column, mask: Column, n: Column, good: Column, toxic: Column) -> Column:
    """Array of the order's steps as the documents of one cell meet them."""
    def weight(condition: Column, by: Column) -> Column:
        return F.when(condition, by).otherwise(F.lit(0).cast("long"))

    def meet(state: Column, at: Column) -> Column:
        letter = F.substring(order, at, F.lit(1))
        bit = F.pow(F.lit(2.0), F.ascii(letter) - ord("A")).cast("int")
        fails, alive = mask.bitwiseAND(bit) != 0, state["alive"]
        row = F.struct(
            letter.alias("letter"),
            weight(alive & ~fails, n).alias("kept"),
            weight(alive & fails, n).alias("removed"),
            weight(~alive & fails, n).alias("redundant"),
            weight(mask == bit, n).alias("unique_fails"),
            weight(alive & fails, good).alias("good_lost"),
            weight(alive & fails, toxic).alias("toxic_lost"))
        return F.struct((alive & ~fails).alias("alive"), F.concat(state["steps"], F.array(row)).alias("steps"))

    start = F.struct(F.lit(True).alias("alive"), F.array().cast(f"array<{_STEP}>").alias("steps"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(len(LETTERS))), start, meet, lambda state: state["steps"])


def _add(a: Column, b: Column) -> Column:
    return F.struct(b["letter"].alias("letter"), *[(a[c] + b[c]).alias(c) for c in COUNTS])


def fold(cells: DataFrame) -> DataFrame:
    """A row per part, order and step from (part, mask, n, good, toxic), one row per part and mask."""
    cell = cells.select("part", F.flatten(F.transform(_orders(), lambda order: _steps(
        order, F.col("mask"), F.col("n"), F.col("good"), F.col("toxic")))).alias("steps"))
    # At most 2 ** 5 arrays of 600 structs per part.
    total = cell.groupBy("part").agg(F.collect_list("steps").alias("all")).select(
        "part", F.aggregate(F.slice("all", 2, 1 << len(LETTERS)), F.col("all")[0],
                            lambda a, b: F.zip_with(a, b, _add)).alias("steps"))
    removed = F.transform(F.array(*[F.lit(x) for x in LETTERS]), lambda x: F.aggregate(
        F.filter(F.col("steps"), lambda s: s["letter"] == x), F.lit(0).cast("long"), lambda a, s: a + s["removed"]))
    rows = total.withColumn("shapley", removed).select("part", "shapley", F.posexplode("steps").alias("at", "s"))
    size = len(LETTERS)
    return rows.select(
        "part", F.get(_orders(), F.floor(F.col("at") / size).cast("int")).alias("filter_order"),
        (F.col("at") % size + 1).cast("int").alias("step"), *[F.col(f"s.{c}").alias(c) for c in COUNTS],
        F.get("shapley", F.ascii("s.letter") - ord("A")).alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step and the counts of ``COUNTS`` and ``shapley``: all orders of the five filters.

    Takes doc_id, text and lang of ``docs`` and doc_id, quality and toxic of
    ``labels``; other columns, whatever their names, play no part. A null text
    is empty, a null lang the part named by the empty string. An empty text has
    no words and fails A only (and E as a copy). Repeated rows count each;
    they share an id, so none is the other's earlier copy. A row without an id
    never fails E. Several label rows of an id count once, with the larger mark.
    A table without rows gives no rows, one without labels zeros as losses.
    Memory of a task grows with its longest text.
    """
    # Written once, without texts: the later steps read it several times.
    return fold(earlier_copies(labelled(write_table(masked(docs), "filter_masks"), labels)))


op13 = audit


ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS part FROM documents
), w AS (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
         min(doc_id) OVER (PARTITION BY t) AS earliest FROM d
), l AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
         max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id
), m AS (
  SELECT w.part,
         CASE WHEN len(words) < 200 THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END
         + CASE WHEN 100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * len(t) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN coalesce(w.doc_id > earliest, false) THEN 16 ELSE 0 END AS mask,
         coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic
  FROM w LEFT JOIN l ON w.doc_id = l.doc_id
), c AS (
  SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY part, mask
), f AS (
  SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS v(letter, bit)
), o AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order,
         [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM f a, f b, f c, f d, f e
  WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
    AND (a.bit | b.bit | c.bit | d.bit | e.bit) = 31
), s AS (
  SELECT filter_order, step, bits[step] AS bit,
         CAST(list_sum(list_concat([0], bits[1:step - 1])) AS INTEGER) AS before
  FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
), r AS (
  SELECT c.part, s.filter_order, s.step, any_value(s.bit) AS bit,
    sum(CASE WHEN (mask & (before + bit)) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN (mask & before) = 0 AND (mask & bit) <> 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN (mask & before) <> 0 AND (mask & bit) <> 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN (mask & before) = 0 AND (mask & bit) <> 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN (mask & before) = 0 AND (mask & bit) <> 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM c, s GROUP BY c.part, s.filter_order, s.step
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept,
  CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM r
"""

"""Operator 12, quality rules by robust multivariate outliers, in DataFrame functions only.

Each text gives four statistics: mean length of a word, share of symbols, of
repeated lines and of words in repeated windows. Transformed and divided by
``TOLERANCE`` they form a vector. For every language and source the regularised
minimum-covariance-determinant estimate is sought among the documents that
pass the base rules: from two starts, concentration steps take the ``SHARE`` of
the documents that lie nearest and estimate centre and scatter from them anew,
until no determinant falls any more. A reweighting step follows; documents too
far by Mahalanobis distance are rejected.

A step is one aggregate by group and bin of the distance (``BINS`` an octave)
and cumulative sums over a group's bins, so a group with a third of all rows
is never sorted nor held by one task. The nearest documents end within a bin;
the bin counts by the share of it that is needed. Vectors are whole numbers and
their sums exact decimals, so results don't depend on the order of rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripcraft.llm.common import has_rows, write_table

SPLIT = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

#: Statistics, and by how much texts of a group may differ in each in any case (transformed units).
TOLERANCE = {"word_length": 0.08, "symbols": 0.03, "dup_lines": 0.15, "repeats": 0.15}
DIMS = len(TOLERANCE)
#: Whole-number units of one tolerance.
UNIT = 1024
#: Share of a group's documents that the estimate is taken from, and fewest documents of a group.
SHARE = 0.75
LEAST_DOCS = 40
BINS = 16
#: A start ends when a step lowers the log determinant by less than this, or after so many steps.
LEAST_FALL = 1e-4
MAX_STEPS = 30
#: Probabilities of the reweighting step and of the rejection under a normal core.
REWEIGHT = 0.975
REJECT = 0.9999
#: Models of so many groups at most (some 200 bytes each) are broadcast; more are joined by shuffle, which AQE splits.
BROADCAST_GROUPS = 50_000

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_Y = [f"y{k}" for k in range(DIMS)]
_C = [f"c{k}" for k in range(DIMS)]
_PAIRS = [(i, j) for i in range(DIMS) for j in range(i + 1)]


def chi2_cdf(x: float, dof: int) -> float:
    """Chi-square distribution function for an even number of degrees of freedom."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(dof // 2))


def chi2_quantile(p: float, dof: int = DIMS) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, dof) < p else (low, mid)
    return high


def consistency(share: float) -> float:
    """What a covariance of the nearest ``share`` of normal rows is multiplied by."""
    return share / chi2_cdf(chi2_quantile(share), DIMS + 2)


def _bound(value: Column, use) -> Column:
    """``use`` of a value that is evaluated once."""
    return F.transform(F.array(value), use)[0]


def _repeat_words(words: Column) -> Column:
    """Words covered by three-word windows that are there twice or more."""
    n = F.greatest(F.size(words) - 2, F.lit(0))
    at = F.slice(F.sequence(F.lit(0), F.size(words)), F.lit(1), n)
    # Equal windows stand side by side when sorted, in order of their places.
    windows = F.sort_array(F.arrays_zip(*[
        F.slice(words, F.lit(k + 1), n).alias(f"w{k}") for k in range(3)], at.alias("i")))

    def equal(s: Column) -> Column:
        m = F.greatest(F.size(s) - 1, F.lit(0))
        return F.flatten(F.zip_with(
            F.slice(s, F.lit(1), m), F.slice(s, F.lit(2), m),
            lambda a, b: F.when((a["w2"] == b["w2"]) & (a["w1"] == b["w1"]) & (a["w0"] == b["w0"]),
                                F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>"))))

    def covered(at: Column) -> Column:
        nexts = F.slice(at, F.lit(2), F.greatest(F.size(at) - 1, F.lit(0)))
        gaps = F.zip_with(at, nexts, lambda a, b: F.least(F.lit(3), F.coalesce(b - a, F.lit(3))))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda n, g: n + g)

    return _bound(F.sort_array(F.array_distinct(_bound(windows, equal))), covered)


def text_statistics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keys=("lang", "source")) -> DataFrame:
    """doc_id, the keys as ``k0`` ..., the columns of ``BASE`` and ``base_failed``."""
    t = F.coalesce(F.col(text), F.lit(""))
    # explode of one element: the words are taken once and not by every use of them.
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), *[F.col(k).cast("string").alias(f"k{i}") for i, k in enumerate(keys)],
        t.alias("t"), F.explode(F.array(F.filter(F.split(t, SPLIT), lambda w: w != ""))).alias("w"))
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    counted = rows.select(
        "doc_id", *[f"k{i}" for i in range(len(keys))],
        F.size("w").cast("long").alias("n_words"),
        F.aggregate("w", F.lit(0).cast("long"), lambda n, w: n + F.length(w)).alias("word_chars"),
        F.regexp_count("t", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        _bound(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("w")).alias("n_repeat_words"))
    return counted.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def vectors() -> list[Column]:
    """The transformed statistics in whole units: a log length and variance-stabilised shares."""
    def share(part: str, whole: str) -> Column:
        p = F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(0.0)
        return F.asin(F.sqrt(F.least(p, F.lit(1.0))))

    length = F.when(F.col("n_words") > 0, F.log(F.col("word_chars") / F.col("n_words"))).otherwise(0.0)
    values = [length, share("n_symbols", "word_chars"), share("n_dup_lines", "n_words"),
              share("n_repeat_words", "n_words")]
    return [F.round(v / t * UNIT).cast("long").alias(y)
            for v, t, y in zip(values, TOLERANCE.values(), _Y, strict=True)]


def with_groups(rows: DataFrame) -> DataFrame:
    """``gid``: language and source, where ``LEAST_DOCS`` passing documents share them; what is left
    together by language and then all together; null if even that is too small."""
    good = F.when(~F.col("base_failed"), 1)
    pairs = rows.groupBy("k0", "k1").agg(F.count(good).alias("n"))

    small = pairs.where(F.col("n") < LEAST_DOCS)
    by_lang = small.groupBy(F.col("k0").alias("lang")).agg(F.sum("n").alias("n_lang"))
    rest = by_lang.where(F.col("n_lang") < LEAST_DOCS).agg(F.coalesce(F.sum("n_lang"), F.lit(0)).alias("n_rest"))
    n_rest = rest.first()["n_rest"]
    named = pairs.join(by_lang, F.col("k0").eqNullSafe(F.col("lang")), "left").select(
        F.col("k0").alias("g0"), F.col("k1").alias("g1"),
        F.when(F.col("n") >= LEAST_DOCS, F.to_json(F.array("k0", "k1")))
        .when(F.col("n_lang") >= LEAST_DOCS, F.to_json(F.array("k0")))
        .when(F.lit(n_rest >= LEAST_DOCS), F.lit("[]")).alias("gid"))
    named = write_table(named, "quality_groups")
    return _attach(rows, named, F.col("k0").eqNullSafe(F.col("g0")) & F.col("k1").eqNullSafe(F.col("g1"))).drop(
        "g0", "g1")


def _attach(rows: DataFrame, model: DataFrame, on, how: str = "left") -> DataFrame:
    """Join a row per group, broadcast where their number is proven to be small."""
    few = len(model.select(F.lit(1)).take(BROADCAST_GROUPS + 1)) <= BROADCAST_GROUPS
    return rows.join(F.broadcast(model) if few else model, on, how)


def _moments(weighted: DataFrame, factor: float, *by: str) -> DataFrame:
    """Centre, Cholesky factor of the regularised scatter and its log determinant from summed moments."""
    n = F.col("w")
    mean = {k: F.col(f"s{k}") / n for k in range(DIMS)}
    cov = {(i, j): (F.col(f"s{i}{j}") / n - mean[i] * mean[j]) * factor + (UNIT ** 2 if i == j else 0)
           for i, j in _PAIRS}
    low: dict[tuple[int, int], Column] = {}
    for i, j in _PAIRS:
        left = cov[i, j]
        for k in range(j):
            left = left - low[i, k] * low[j, k]
        low[i, j] = F.sqrt(left) if i == j else left / low[j, j]
    log_det = sum((F.log(low[k, k]) for k in range(1, DIMS)), F.log(low[0, 0]))
    return weighted.select(*by, *[mean[k].alias(_C[k]) for k in range(DIMS)],
                           *[low[i, j].alias(f"l{i}{j}") for i, j in _PAIRS], log_det.alias("log_det"))


def distance() -> Column:
    """Squared Mahalanobis distance of y to the centre c by forward substitution with the factor l."""
    z: list[Column] = []
    for i in range(DIMS):
        left = F.col(_Y[i]) - F.col(_C[i])
        for k in range(i):
            left = left - F.col(f"l{i}{k}") * z[k]
        z.append(left / F.col(f"l{i}{i}"))
    return sum((v * v for v in z[1:]), z[0] * z[0])


def _sums(rows: DataFrame, *by: str | Column) -> DataFrame:
    """Count and exact first and second moments."""
    def exact(c: Column) -> Column:
        return F.sum(c.cast("decimal(19,0)"))

    return rows.groupBy(*by).agg(
        F.count("*").alias("n"), *[exact(F.col(_Y[k])).alias(f"s{k}") for k in range(DIMS)],
        *[exact(F.col(_Y[i]) * F.col(_Y[j])).alias(f"s{i}{j}") for i, j in _PAIRS])


_SUMS = [f"s{k}" for k in range(DIMS)] + [f"s{i}{j}" for i, j in _PAIRS]


def _bin() -> Column:
    return F.floor(F.log2(distance() + 1e-9) * BINS).cast("int")


def starts(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Two models a group: coordinatewise medians (to an eighth of a tolerance) with unit scatter, and all rows."""
    step = UNIT // 8
    flat = rows.select("gid", F.posexplode(F.array(*_Y)).alias("k", "y"))
    cells = flat.groupBy("gid", "k", F.floor(F.col("y") / step).alias("cell")).agg(F.count("*").alias("m"))
    upto = Window.partitionBy("gid", "k").orderBy("cell")
    half = cells.withColumn("upto", F.sum("m").over(upto)).join(groups, "gid").where(F.col("upto") * 2 >= F.col("n"))
    middle = half.groupBy("gid").agg(*[
        ((F.min(F.when(F.col("k") == k, F.col("cell"))) + 0.5) * step).alias(_C[k]) for k in range(DIMS)])
    flatfactor = [F.lit(float(UNIT if i == j else 0)).alias(f"l{i}{j}") for i, j in _PAIRS]
    median = middle.select("gid", F.lit(0).alias("start"), *_C, *flatfactor,
                           F.lit(float("inf")).alias("log_det"))
    sums = _sums(rows, "gid").withColumnRenamed("n", "w").withColumns({s: F.col(s).cast("double") for s in _SUMS})
    return median.unionByName(_moments(sums, 1.0, "gid").select(
        "gid", F.lit(1).alias("start"), *_C, *[f"l{i}{j}" for i, j in _PAIRS], F.lit(float("inf")).alias("log_det")))


def concentrate(rows: DataFrame, model: DataFrame, groups: DataFrame) -> DataFrame:
    """One concentration step of every group and start; ``was`` is the log determinant before."""
    bins = _sums(_attach(rows, model, "gid", "inner"), "gid", "start", _bin().alias("bin"))
    by = Window.partitionBy("gid", "start").orderBy("bin")
    need = F.ceil(F.col("total") * SHARE)
    cut = (bins.withColumn("upto", F.sum("n").over(by))
           .join(groups.select("gid", F.col("n").alias("total")), "gid")
           .where(F.col("upto") - F.col("n") < need)
           .withColumn("part", F.when(F.col("upto") > need, (need - F.col("upto") + F.col("n")) / F.col("n"))))
    # Whole bins add up exactly; the one border bin of a group is weighed.
    sums = cut.groupBy("gid", "start").agg(F.max(need).cast("double").alias("w"), *[
        (F.coalesce(F.sum(F.when(F.col("part").isNull(), F.col(s))).cast("double"), F.lit(0.0))
         + F.coalesce(F.max(F.when(F.col("part").isNotNull(), F.col(s).cast("double") * F.col("part"))), F.lit(0.0)))
        .alias(s) for s in _SUMS])
    new = _moments(sums, consistency(SHARE), "gid", "start")
    return new.join(model.select("gid", "start", F.col("log_det").alias("was")), ["gid", "start"])


def estimate(rows: DataFrame) -> DataFrame:
    """Centre and factor per ``gid`` of rows (gid, y0 ...): regularised MCD and its reweighting."""
    groups = write_table(rows.groupBy("gid").agg(F.count("*").alias("n")), "quality_sizes")
    model, ended = write_table(starts(rows, groups), "quality_starts"), None
    for _ in range(MAX_STEPS):
        model = write_table(concentrate(rows, model, groups), "quality_step")
        falls = F.col("log_det") < F.col("was") - LEAST_FALL
        ended = model.where(~falls) if ended is None else ended.unionByName(model.where(~falls))
        model = model.where(falls)
        if not has_rows(model):
            break
    best = ended.unionByName(model).groupBy("gid").agg(F.min(F.struct(
        "log_det", "start", *_C, *[f"l{i}{j}" for i, j in _PAIRS])).alias("m")).select("gid", "m.*")
    near = _attach(rows, write_table(best, "quality_raw"), "gid", "inner").where(distance() <= chi2_quantile(REWEIGHT))
    sums = _sums(near, "gid").withColumnRenamed("n", "w").withColumns({s: F.col(s).cast("double") for s in _SUMS})
    return _moments(sums, consistency(REWEIGHT), "gid")


def judge(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keys=("lang", "source")) -> DataFrame:
    """The columns of ``text_statistics`` without the keys, ``kept`` and ``distance``, a row per row of ``docs``.

    ``base_failed`` documents are rejected and take no part in the estimates;
    the others are kept unless their squared distance to their group's estimate
    is above the chi-square quantile of ``REJECT``. A null key is a value like
    others; groups under ``LEAST_DOCS`` passing documents share an estimate (see
    ``with_groups``), and where even all of them are fewer they are kept with a
    null distance. A null text is empty and fails the base rules. Other
    columns play no part, repeated rows count each, a null id stays null; an
    empty table gives no rows. Vectors that are all equal have the tolerances
    as scatter. A task holds one text, its words and their windows at a time.
    """
    stats = write_table(text_statistics(docs, doc_id, text, keys), "quality_statistics")
    rows = write_table(with_groups(stats).select("*", *vectors()), "quality_vectors")
    fit = rows.where(~F.col("base_failed") & F.col("gid").isNotNull()).select("gid", *_Y)
    model = write_table(estimate(fit), "quality_model").drop("log_det")
    far = F.when(~F.col("base_failed"), distance())
    return _attach(rows, model, "gid").select(
        "doc_id", *BASE, "base_failed", far.alias("distance")).withColumn(
        "kept", ~F.col("base_failed") & F.coalesce(F.col("distance") <= chi2_quantile(REJECT), F.lit(True)))


op12 = judge

"""Operator 11, embedding whitening by spectrum slicing.

The covariance is added up from whole numbers centred on the rounded mean, one
partial matrix per task. Its leading eigenvalues are isolated by inertia: the
negative pivots of the LDL^T factors of V - sI are as many as V has eigenvalues
below s. Rayleigh quotient iteration then converges cubically from the middle
of an interval, and two more counts beside the result certify its number.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripcraft.llm.common import write_table

SCALE = 1024
OFFSET = 100_000
COMPONENTS = 8
#: |SCALE * c| of entries that have a 64-bit x; larger ones count as non-finite.
LARGEST = 2.0 ** 62
#: Lengths of vectors are taken in passes whose models (means and components, one per length) have so many bytes.
PASS_BYTES = 32 << 20
#: Partial matrices of tasks are added in so many groups a length before they meet.
MERGE = 64


# --- eigenvalues of one symmetric matrix ------------------------------------------


def _inverse(block: np.ndarray, least: float) -> np.ndarray:
    """Inverse of a pivot of order 1 or 2; eigenvalues that vanish count as ``least``."""
    values, vectors = np.linalg.eigh(block)
    return vectors / np.where(np.abs(values) > least, values, least) @ vectors.T


class Ldl:
    """LDL^T factors of a symmetric matrix with symmetric pivots of order 1 and 2 (Bunch-Kaufman)."""

    _RATIO = (1 + 17 ** 0.5) / 8

    def __init__(self, matrix: np.ndarray):
        a = np.array(matrix, np.float64)
        n = len(a)
        self.order = np.arange(n)
        self.low = np.eye(n)
        self.blocks: list[tuple[int, np.ndarray]] = []
        k = 0
        while k < n:
            size = self._pivot(a, k)
            block = a[k:k + size, k:k + size].copy()
            self.blocks.append((k, block))
            below = a[k + size:, k:k + size].copy()
            if len(below) and block.any():
                low = below @ _inverse(block, np.finfo(float).tiny)
                self.low[k + size:, k:k + size] = low
                a[k + size:, k + size:] -= low @ below.T
            k += size

    def _swap(self, a: np.ndarray, i: int, j: int, k: int) -> None:
        if i != j:
            a[[i, j], :] = a[[j, i], :]
            a[:, [i, j]] = a[:, [j, i]]
            self.low[[i, j], :k] = self.low[[j, i], :k]
            self.order[[i, j]] = self.order[[j, i]]

    def _pivot(self, a: np.ndarray, k: int) -> int:
        """Bring a pivot to row k; its order."""
        column = np.abs(a[k + 1:, k])
        if not len(column) or not column.any():
            return 1
        r = k + 1 + int(column.argmax())
        top = column[r - k - 1]
        if abs(a[k, k]) >= self._RATIO * top:
            return 1
        row = np.abs(a[r, k:])
        row[r - k] = 0
        widest = row.max()
        if abs(a[k, k]) * widest >= self._RATIO * top * top:
            return 1
        if abs(a[r, r]) >= self._RATIO * widest:
            self._swap(a, k, r, k)
            return 1
        self._swap(a, k + 1, r, k)
        return 2

    def negative(self) -> int:
        """How many eigenvalues of the matrix are below zero."""
        return sum(int((np.linalg.eigvalsh(b) < 0).sum()) for _, b in self.blocks)

    def solve(self, b: np.ndarray, least: float) -> np.ndarray:
        """x with matrix @ x = b; pivots that vanish count as ``least``."""
        y = b[self.order].astype(np.float64)
        n = len(y)
        for i in range(n):
            y[i + 1:] -= self.low[i + 1:, i] * y[i]
        for k, block in self.blocks:
            y[k:k + len(block)] = _inverse(block, least) @ y[k:k + len(block)]
        for i in range(n - 1, -1, -1):
            y[i] -= self.low[i + 1:, i] @ y[i + 1:]
        x = np.empty(n)
        x[self.order] = y
        return x


def below(v: np.ndarray, shift: float) -> int:
    """Inertia count: eigenvalues of v below the shift."""
    return Ldl(v - shift * np.eye(len(v))).negative()


def isolate(v: np.ndarray, wanted: int, width: float) -> list[tuple[float, float, int, int]]:
    """(low, high, first, end): intervals that hold exactly the eigenvalues numbered first to end - 1.

    Numbers fall from 0 for the largest. Intervals are halved until they hold
    one eigenvalue, or are as narrow as ``width`` (eigenvalues that
    double precision cannot tell apart). They cover the ``wanted`` largest.
    """
    n = len(v)
    reach = np.abs(v).sum(axis=1)
    low, high = float((2 * np.diag(v) - reach).min()) - width, float(reach.max()) + width
    counts = {low: 0, high: n}
    todo, out = [(low, high)], []
    while todo:
        a, b = todo.pop()
        first, end = n - counts[b], n - counts[a]
        if first >= wanted or first == end:
            continue
        mid = (a + b) / 2
        if end - first == 1 or b - a <= width or not a < mid < b:
            out.append((a, b, first, end))
            continue
        counts[mid] = below(v, mid)
        todo += [(a, mid), (mid, b)]
    return sorted(out, key=lambda x: x[2])


def refine(v: np.ndarray, low: float, high: float, basis: np.ndarray, start: np.ndarray,
           width: float) -> tuple[float, np.ndarray]:
    """The eigenpair in [low, high) by Rayleigh quotient iteration from the middle.

    When a quotient leaves the interval, inertia counts halve it and the iteration
    starts again, so it cannot end at a neighbour. Vectors stay orthogonal to
    ``basis``, the eigenvectors found before.
    """
    def step(x: np.ndarray, shift: float) -> tuple[float, float, np.ndarray]:
        y = Ldl(v - shift * eye).solve(x, np.finfo(float).eps * width)
        y -= basis.T @ (basis @ y)
        y /= np.linalg.norm(y)
        y -= basis.T @ (basis @ y)
        y /= np.linalg.norm(y)
        quotient = float(y @ v @ y)
        return float(np.linalg.norm(v @ y - quotient * y)), quotient, y

    eye = np.eye(len(v))
    x, shift, slack = start, (low + high) / 2, 4 * width
    best = (np.inf, shift, x)
    for _ in range(200):
        rest, quotient, x = step(x, shift)
        near = slack if rest <= width else 0.0
        if low - near <= quotient <= high + near:
            if rest < best[0]:
                best = (rest, quotient, x)
            elif best[0] <= width:
                break
            shift = quotient
        else:
            mid = (low + high) / 2
            if high - low > width:
                low, high = (low, mid) if below(v, mid) > below(v, low) else (mid, high)
                x = start
            shift = (low + high) / 2
    return best[1], best[2]


def leading(v: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors as rows) of the largest eigenvalues, falling; certified by inertia counts.

    The largest entry of a vector is positive. Eigenvalues that are equal in
    double precision share an interval; their vectors are some orthonormal basis.
    """
    n = len(v)
    wanted = min(wanted, n)
    norm = float(np.abs(v).sum(axis=1).max()) if n else 0.0
    width = 8 * n * np.finfo(float).eps * norm
    if norm == 0:
        return np.zeros(wanted), np.eye(n)[:wanted]
    values, basis = [], np.zeros((0, n))
    starts = np.random.default_rng(0).standard_normal((n, n))
    for low, high, first, end in isolate(v, wanted, width):
        for number in range(first, min(end, wanted)):
            value, x = refine(v, low, high, basis, starts[number], width)
            x = x * np.sign(x[np.abs(x).argmax()])
            values.append(value)
            basis = np.vstack([basis, x])
            if end - first == 1:
                above, upto = n - below(v, value + 4 * width), n - below(v, value - 4 * width)
                if not above <= number < upto:
                    raise ArithmeticError(f"eigenvalue {value} is not number {number} from the top")
    order = np.argsort(-np.array(values), kind="stable")
    return np.array(values)[order], basis[order]


# --- sums over the vectors ---------------------------------------------------------


def prepared(vectors: DataFrame, column: str, *keep: str) -> DataFrame:
    """``keep``, dims and x of the rows whose vector isn't null nor empty and holds finite entries only."""
    c = F.col(column).cast("array<double>")
    good = F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v * SCALE) < LARGEST))
    rows = vectors.where(F.col(column).isNotNull() & (F.size(c) > 0)).where(F.coalesce(good, F.lit(False)))
    return rows.select(*keep, F.size(c).alias("_dims"), F.transform(c, lambda v: F.floor(v * SCALE) + OFFSET).alias("_x"))


def matrices(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, row numbers, x) of a batch of prepared rows, one length at a time."""
    dims = batch.column("_dims").to_numpy()
    flat = batch.column("_x").flatten().to_numpy()
    start = np.cumsum(dims) - dims
    for d in np.unique(dims):
        rows = np.flatnonzero(dims == d)
        yield int(d), rows, flat[start[rows][:, None] + np.arange(d)]


def _frame(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(columns)


def exact_sums(rows: DataFrame) -> DataFrame:
    """(dims, i, n, s): count and exact sum of every dimension, by length of the vectors."""
    def partial(batches):
        total: dict[int, tuple[int, np.ndarray]] = {}
        for batch in batches:
            for d, _, x in matrices(batch):
                # Halves of 32 bits add up without overflow; whole sums are Python integers.
                s = (x >> 32).sum(axis=0).astype(object) * (1 << 32) + (x & 0xFFFF_FFFF).sum(axis=0).astype(object)
                n, before = total.get(d, (0, 0))
                total[d] = n + len(x), before + s
        for d, (n, s) in total.items():
            yield _frame(dims=pa.array([d] * d, pa.int32()), i=pa.array(np.arange(d), pa.int32()),
                         n=pa.array([n] * d, pa.int64()),
                         s=pa.array([Decimal(int(v)) for v in s], pa.decimal128(38, 0)))

    parts = rows.select("_dims", "_x").mapInArrow(partial, "dims int, i int, n long, s decimal(38,0)")
    return parts.groupBy("dims", "i").agg(F.sum("n").alias("n"), F.sum("s").cast("decimal(38,0)").alias("s"))


def _scatter(rows: DataFrame, centre: dict[int, np.ndarray], column: str) -> DataFrame:
    """(dims, z): sums of products of the rows less their length's centre, one array of dims squared.

    ``column``: 'x' centres whole numbers, whose float sums are exact below
    2 ** 53; 'w' centres doubles. Tasks send a matrix a length.
    """
    def partial(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for d, _, x in matrices(batch):
                z = (x - centre[d]).astype(np.float64)
                total[d] = total.get(d, 0) + z.T @ z
        for d, z in total.items():
            yield _frame(dims=pa.array([d], pa.int32()), z=pa.array([z.ravel()], pa.list_(pa.float64())))

    def add(some: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(len(some["z"].iloc[0]))
        for z in some["z"]:
            total += z
        return pd.DataFrame({"dims": some["dims"].iloc[:1], "z": [total]})

    schema = "dims int, z array<double>"
    parts = rows.select("_dims", F.col(column).alias("_x")).mapInArrow(partial, schema)
    some = parts.groupBy("dims", F.pmod(F.spark_partition_id(), F.lit(MERGE)).alias("g"))
    return some.applyInPandas(add, schema).groupBy("dims").applyInPandas(add, schema)


class Model:
    """Count, sums and leading components of the vectors of one length."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums
        self.centre = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)
        #: S / n less the centre, at most a half: exact remainders divided once.
        self.rest = np.array([(s - n * int(m)) / n for s, m in zip(sums, self.centre, strict=True)])
        self.values, self.vectors, self.trace = np.zeros(0), np.zeros((0, len(sums))), 0.0

    def whiten(self, x: np.ndarray) -> np.ndarray:
        """A column per component; NaN for components without variance."""
        scale = np.where(self.live(), np.sqrt(np.maximum(self.values, 0)), np.nan)
        return ((x - self.centre) - self.rest) @ self.vectors.T / scale

    def live(self) -> np.ndarray:
        """Components whose eigenvalue is more than rounding of the largest one."""
        n = len(self.sums)
        return self.values > 64 * n * np.finfo(float).eps * self.values.max(initial=0.0)

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S) ** 2, exactly; None where it takes more than 64 bits."""
        # With y = x - centre it is the sum of (n y - r) ** 2, where |r| <= n / 2.
        y, n = x - self.centre, self.n
        r = np.array([s - n * int(m) for s, m in zip(self.sums, self.centre, strict=True)], np.int64)
        if (int(np.abs(y).max(initial=0)) * n + n) ** 2 * len(r) < 1 << 63:
            return ((y * n - r) ** 2).sum(axis=1).tolist()
        exact = [sum((v * n - k) ** 2 for v, k in zip(row, r.tolist(), strict=True)) for row in y.tolist()]
        return [v if v < 1 << 63 else None for v in exact]


def fit(rows: DataFrame, models: dict[int, Model], components: int) -> None:
    """Components of every length: covariances are put together and factored in tasks, a length each."""
    def spectrum(some: pd.DataFrame) -> pd.DataFrame:
        d = int(some["dims"].iloc[0])
        model = models[d]
        v = some["z"].iloc[0].reshape(d, d) / model.n - np.outer(model.rest, model.rest)
        values, vectors = leading((v + v.T) / 2, components)
        return pd.DataFrame({"dims": d, "e": values, "trace": float(np.trace(v)), "vector": list(vectors)})

    found = (_scatter(rows, {d: m.centre for d, m in models.items()}, "_x").groupBy("dims")
             .applyInPandas(spectrum, "dims int, e double, trace double, vector array<double>").toPandas())
    for d, some in found.groupby("dims"):
        models[d].values = some["e"].to_numpy()
        models[d].vectors = np.stack(some["vector"].to_numpy())
        models[d].trace = float(some["trace"].iloc[0])


def _project(rows: DataFrame, models: dict[int, Model], keep: list[str]) -> DataFrame:
    """``keep``, n, deviation, whitened and explained (arrays over the components; NaN without variance)."""
    def project(batches):
        for batch in batches:
            size = batch.num_rows
            n, deviation, whitened, explained = ([None] * size for _ in range(4))
            for d, at, x in matrices(batch):
                model = models[d]
                share = np.maximum(model.values, 0) / model.trace if model.trace > 0 else np.full(len(model.values), np.nan)
                for row, dev, w in zip(at, model.deviation(x), model.whiten(x), strict=True):
                    n[row], deviation[row], whitened[row], explained[row] = model.n, dev, w, share
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k) for k in keep], batch.column("_dims"), pa.array(n, pa.int64()),
                 pa.array(deviation, pa.int64()), pa.array(whitened, pa.list_(pa.float64())),
                 pa.array(explained, pa.list_(pa.float64()))],
                names=[*keep, "_dims", "n", "deviation", "whitened", "explained"])

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keep).schema)
    return rows.mapInArrow(
        project, types + ", _dims int, n long, deviation long, whitened array<double>, explained array<double>")


def identity_errors(table: DataFrame, models: dict[int, Model]) -> list[float]:
    """Per length the largest absolute entry of the whitened vectors' covariance less the identity.

    Components without variance are left out.
    """
    live = table.select("_dims", F.filter("whitened", lambda v: ~F.isnan(v)).alias("w")).where(F.size("w") > 0)
    means = live.select("_dims", F.posexplode("w")).groupBy("_dims", "pos").agg(F.avg("col").alias("m")).toPandas()
    centre = {int(d): some.sort_values("pos")["m"].to_numpy() for d, some in means.groupby("_dims")}
    out = []
    for d, mean in centre.items():
        # The model of a pass has few lengths; each is read by itself, as whitened vectors are equally long.
        mine = live.where(F.col("_dims") == d).select(F.size("w").alias("_dims"), "w")
        z = np.array(_scatter(mine, {len(mean): mean}, "w").first()["z"]).reshape(len(mean), len(mean))
        out.append(float(np.abs(z / models[d].n - np.eye(len(mean))).max()))
    return out


def whiten(vectors: DataFrame, key: str = "vec_id", column: str = "embedding",
           components: int = COMPONENTS) -> tuple[DataFrame, float | None]:
    """(key, n, deviation, whitened, explained) of every usable vector, and the identity error of all.

    Rows whose vector is null, empty or holds null or non-finite entries (or
    such that SCALE times them has no 64-bit integer) are dropped. Vectors of different
    lengths have nothing in common: each length has its own fit. Components
    without variance (equal vectors, fewer vectors than dimensions) have NaN as
    whitened value; components number at most the length. Repeated rows and ids
    count each, a null key stays null, other columns play no part. A deviation of more than 64 bits is
    null. Without usable rows there are none and the error is None.
    """
    rows = prepared(vectors, column, key)
    sums = write_table(exact_sums(rows), "whitening_sums")
    lengths = sorted(r["dims"] for r in sums.select("dims").distinct().collect())
    tables, errors = [], []
    for some in passes(lengths, components):
        models = {int(d): Model(int(of["n"].iloc[0]), [int(v) for v in of.sort_values("i")["s"]])
                  for d, of in sums.where(F.col("dims").isin(some)).toPandas().groupby("dims")}
        mine = rows if len(some) == len(lengths) else rows.where(F.col("_dims").isin(some))
        if models:
            fit(mine, models, components)
        table = write_table(_project(mine, models, [key]), "whitened")
        errors += identity_errors(table, models)
        tables.append(table.drop("_dims"))
    return reduce(DataFrame.unionAll, tables), max(errors, default=None)


def passes(lengths: list[int], components: int) -> list[list[int]]:
    """Lengths whose models together keep within ``PASS_BYTES`` (or a single one); at least one pass."""
    out, size = [[]], 0
    for d in lengths:
        size += 8 * d * (components + 4)
        if out[-1] and size > PASS_BYTES:
            out, size = [*out, []], 8 * d * (components + 4)
        out[-1].append(d)
    return out


def op11(vectors: DataFrame) -> DataFrame:
    """A row per vector and component; ``whitened`` is null for components without variance."""
    table, error = whiten(vectors)
    each = F.posexplode(F.arrays_zip("whitened", "explained"))
    return table.select("vec_id", "n", "deviation", each.alias("at", "c")).select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), "n", "deviation",
        F.nullif(F.col("c.whitened"), F.lit(float("nan"))).alias("whitened"),
        F.nullif(F.col("c.explained"), F.lit(float("nan"))).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"))

"""Embedding whitening: pivoted Cholesky of the centred scatter, then one-sided Jacobi on its factor.

A first pass sums the vectors exactly, a second one adds up the scatter of the centred vectors. Both reduce to one
row per dimension inside Spark. The scatter A is factored as A = L L' with diagonal pivots, and plane rotations from
the right make the columns of L orthogonal: their norms are the square roots of the eigenvalues of A and the columns,
normalised, its eigenvectors. No rotation touches A itself, so small eigenvalues keep their relative accuracy.

What reaches the driver is one d x d scatter per vector length d; it does not grow with the rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from priorframe.llm.common import columns_of, forget, short_batches

SCALE, OFFSET = 64, 1_000_000  # an entry c becomes the integer floor(SCALE * c) + OFFSET
LARGEST = 2.0**61  # integers saturate here, as a cast to long does further out
COMPONENTS = 32
MERGE = 64  # partial sums of one row of the scatter meet in so many tasks, then in one
SWEEPS = 60


def integers(column: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Rows and integer vectors by length, without vectors that are NULL, empty or hold NULL or non-finite entries."""
    if not len(column):
        return {}
    size = np.nan_to_num(np.asarray(pc.list_value_length(column).to_numpy(zero_copy_only=False), float)).astype(np.int64)
    flat = pc.list_flatten(column).to_numpy(zero_copy_only=False).astype(float)
    at, out = np.cumsum(size) - size, {}
    for dim in np.unique(size[size > 0]).tolist():
        rows = np.flatnonzero(size == dim)
        c = flat[at[rows][:, None] + np.arange(dim)]
        fine = np.isfinite(c).all(1)
        if fine.any():
            with np.errstate(over="ignore"):
                x = np.clip(np.floor(SCALE * c[fine]), -LARGEST, LARGEST).astype(np.int64) + OFFSET
            out[dim] = rows[fine], x
    return out


@dataclass
class Model:
    """The whitening of one vector length: ``directions`` holds unit eigenvectors as columns."""

    n: int
    sums: list[int]
    eigenvalues: np.ndarray
    directions: np.ndarray
    trace: float
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n, with the subtraction of the integer part done in integers."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([s % self.n / self.n for s in self.sums])
        return (x - whole).astype(float) - rest

    def project(self, x: np.ndarray, components: int | None = None) -> np.ndarray:
        """Whitened coordinates; components without variance have none."""
        k = components or len(self.eigenvalues)
        return self.centred(x) @ self.directions[:, :k] / np.sqrt(self.eigenvalues[:k])

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S)^2, exact; NULL where it does not fit into a long."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([s % self.n for s in self.sums], np.int64)
        apart = x - whole
        most = (int(np.abs(apart).max()) + 1) * self.n
        if most * most * len(self.sums) < 2**63:
            u = self.n * apart - rest
            return (u * u).sum(1).tolist()
        rows = [sum((self.n * a - r) ** 2 for a, r in zip(row, rest.tolist(), strict=True)) for row in apart.tolist()]
        return [v if v < 2**63 else None for v in rows]


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """L with a = L L', its rows in the order of ``a``; columns stop where the largest pivot left is rounding."""
    rest, n = np.array(a, float), len(a)
    left = np.diag(rest).copy()
    least = n * np.finfo(float).eps * max(float(left.max(initial=0.0)), 0.0)
    factor = np.zeros((n, n))
    for k in range(n):
        p = int(np.argmax(left))
        if not left[p] > least:
            return factor[:, :k]
        column = (rest[:, p] - factor[:, :k] @ factor[p, :k]) / np.sqrt(left[p])
        column[left == -np.inf] = 0.0  # above the diagonal of the permuted factor
        column[p] = np.sqrt(left[p])
        factor[:, k] = column
        left = left - column * column
        left[p] = -np.inf
    return factor


def rounds_of_pairs(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """All pairs below n in rounds of disjoint pairs (a round-robin tournament)."""
    ring, out = list(range(n + n % 2)), []
    for _ in range(len(ring) - 1):
        half = len(ring) // 2
        pairs = [(min(a, b), max(a, b)) for a, b in zip(ring[:half], ring[:half - 1 : -1], strict=True) if max(a, b) < n]
        out.append((np.array([a for a, _ in pairs], int), np.array([b for _, b in pairs], int)))
        ring = [ring[0], ring[-1], *ring[1:-1]]
    return out


def one_sided_jacobi(factor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared column norms, falling, and unit columns of ``factor`` after rotations have made them orthogonal."""
    c = np.array(factor, float)
    pairs = rounds_of_pairs(c.shape[1])
    close = np.finfo(float).eps * np.sqrt(max(1, len(c)))
    for _ in range(SWEEPS):
        worst = 0.0
        for i, j in pairs:
            x, y = c[:, i], c[:, j]
            xx, yy, xy = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            size = np.sqrt(xx * yy)
            turn = np.abs(xy) > close * size
            worst = max(worst, float((np.abs(xy[turn]) / size[turn]).max(initial=0.0)))
            if not turn.any():
                continue
            zeta = (yy - xx)[turn] / (2 * xy[turn])
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            cos = 1 / np.hypot(1.0, t)
            sin, x, y = cos * t, x[:, turn], y[:, turn]
            c[:, i[turn]], c[:, j[turn]] = cos * x - sin * y, sin * x + cos * y
        if worst <= close:
            break
    squares = (c * c).sum(0)
    order = np.argsort(-squares, kind="stable")
    squares, unit = squares[order], c[:, order] / np.sqrt(squares[order])
    if unit.size:
        unit = unit * np.where(unit[np.abs(unit).argmax(0), np.arange(unit.shape[1])] < 0, -1.0, 1.0)
    return squares, unit


def exact_sums(rows: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """Number of vectors and exact sum per dimension, by vector length; only (length, dimension) rows are collected."""
    parts = pa.schema([("dim", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.list_(pa.int64())))])

    def add(batches):
        forget()
        found: dict[int, list] = {}
        for batch in batches:
            for dim, (_, x) in integers(batch.column(0)).items():
                halves = np.stack([(x >> 32).sum(0), (x & 0xFFFFFFFF).sum(0)], 1)
                one = found.setdefault(dim, [0, np.zeros((dim, 2), np.int64)])
                one[0] += len(x)
                one[1] += halves
        if found:
            columns = [list(found), [n for n, _ in found.values()], [s.tolist() for _, s in found.values()]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, parts, strict=True)], schema=parts)

    total = rows.mapInArrow(add, "dim int, n bigint, sums array<array<bigint>>").select("dim", "n", F.posexplode("sums").alias("at", "s"))
    wide = lambda c: F.sum(c.cast("decimal(38,0)"))
    total = total.groupBy("dim", "at").agg(F.sum("n").alias("n"), wide(F.col("s")[0]).alias("high"), wide(F.col("s")[1]).alias("low"))
    out: dict[int, tuple[int, list[int]]] = {}
    for r in sorted(total.collect()):
        out.setdefault(r["dim"], (r["n"], []))[1].append((int(r["high"]) << 32) + int(r["low"]))
    return out


def second_moments(rows: DataFrame, of: Callable[[int, np.ndarray], np.ndarray]) -> dict[int, np.ndarray]:
    """Sum of z z' over all vectors by length, z being ``of`` (length, integer vectors).

    Each task adds up its own vectors; one row of the sum is a row of the table, so tables of any number of tasks are
    merged without a task that holds them all.
    """
    schema = "dim int, at int, part int, source int, row array<double>"
    fields = pa.schema([("dim", pa.int32()), ("at", pa.int32()), ("part", pa.int32()), ("source", pa.int32()), ("row", pa.list_(pa.float64()))])

    def add(batches):
        forget()
        source, found = TaskContext.get().partitionId(), {}
        for batch in batches:
            for dim, (_, x) in integers(batch.column(0)).items():
                z = of(dim, x)
                found[dim] = z.T @ z + found.get(dim, 0.0)
        for dim, m in found.items():
            k = len(m)
            columns = [[dim] * k, range(k), [source % MERGE] * k, [source] * k, m.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, fields, strict=True)], schema=fields)

    def merge(table: pa.Table) -> pa.Table:
        table = table.sort_by("source")  # the same order, and so the same rounding, whenever a task is run again
        row = np.array(table.column("row").to_pylist()).sum(0).tolist()
        one = {name: [table.column(name)[0].as_py()] for name in ("dim", "at", "part", "source")}
        return pa.table({**one, "row": [row]}, schema=fields)

    halved = rows.mapInArrow(add, schema).groupBy("dim", "at", "part").applyInArrow(merge, schema)
    out: dict[int, dict[int, list[float]]] = {}
    for r in halved.groupBy("dim", "at").applyInArrow(merge, schema).collect():
        out.setdefault(r["dim"], {})[r["at"]] = r["row"]
    return {dim: np.array([m[i] for i in range(len(m))]) for dim, m in out.items()}


def fit(vectors: DataFrame, components: int = COMPONENTS, vector_col: str = "embedding") -> dict[int, Model]:
    """A model per vector length, fitted on all vectors of that length; ``identity_error`` is measured on them."""
    rows = vector_rows(vectors, vector_col)
    models = {}
    sums = exact_sums(rows)
    blank = {dim: Model(n, s, np.zeros(0), np.zeros((dim, 0)), 0.0) for dim, (n, s) in sums.items()}
    for dim, scatter in second_moments(rows, lambda dim, x: blank[dim].centred(x)).items():
        squares, unit = one_sided_jacobi(pivoted_cholesky(scatter))
        n, s = sums[dim]
        models[dim] = Model(n, s, squares[:components] / n, unit[:, :components], float(np.trace(scatter)) / n)
    for dim, m in second_moments(rows, lambda dim, x: models[dim].project(x)).items():
        models[dim].identity_error = float(np.abs(m / models[dim].n - np.eye(len(m))).max(initial=0.0))
    return models


def vector_rows(vectors: DataFrame, vector_col: str, *others: str) -> DataFrame:
    """The vector as the first column, after it the named ones."""
    short_batches(vectors.sparkSession)
    rows = columns_of(vectors, [vector_col, *others]).toDF("v", *[f"c{i}" for i, _ in enumerate(others)])
    if rows.schema["v"].dataType.simpleString() not in ("array<float>", "array<double>"):
        rows = rows.withColumn("v", F.col("v").cast("array<double>"))
    return rows


def transform(vectors: DataFrame, models: dict[int, Model], id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, whitened array, deviation) of every vector that a model knows the length of."""
    rows = vector_rows(vectors, vector_col, id_col)
    kind = rows.schema["c0"].dataType.simpleString()

    def project(batches):
        forget()
        for batch in batches:
            for dim, (at, x) in integers(batch.column(0)).items():
                if dim in models:
                    ids, z = batch.column(1).take(pa.array(at)), models[dim].project(x)
                    ends = pa.array(np.arange(len(x) + 1) * z.shape[1], pa.int32())
                    arrays = [ids, pa.array([dim] * len(x), pa.int32()), pa.ListArray.from_arrays(ends, pa.array(z.ravel()))]
                    arrays.append(pa.array(models[dim].deviations(x), pa.int64()))
                    yield pa.RecordBatch.from_arrays(arrays, ["vec_id", "dim", "whitened", "deviation"])

    return rows.mapInArrow(project, f"vec_id {kind}, dim int, whitened array<double>, deviation bigint")


def whiten(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error), a row per vector and component.

    Vectors that are NULL, empty or hold NULL or non-finite entries are left out. Repeated rows, rows of one id and rows
    without an id each count and each get their rows. Vectors of different lengths are spaces of their own, each fitted
    on its own vectors. A component without variance cannot be scaled to one and has no rows, so one vector alone, or
    equal vectors, give none; components of equal variance may be any basis of their space. A deviation beyond a long is
    NULL. An empty table gives an empty result; other columns are ignored. The vectors hold no texts.
    """
    models = fit(vectors, components, vector_col)
    spark = vectors.sparkSession
    known = [(d, i + 1, m.n, float(e / m.trace), m.identity_error) for d, m in models.items() for i, e in enumerate(m.eigenvalues)]
    of = spark.createDataFrame(known, "dim int, component int, n bigint, explained double, identity_error double")
    rows = transform(vectors, models, id_col, vector_col)
    long = rows.select("vec_id", "dim", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    long = long.withColumn("component", F.col("at") + 1).join(F.broadcast(of), ["dim", "component"])  # a row per length and component
    return long.select("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")

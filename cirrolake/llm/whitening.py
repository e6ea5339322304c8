"""Whitening of embeddings: covariance on Spark, eigenvectors by mixed-precision refinement.

Entries are taken as integers, so sums and products of them are exact whatever the order of tasks: the covariance is
made from the entries less the rounded mean, in limbs that a float64 matrix product holds without rounding, and only
the finished n^2 * V is rounded. Its eigenvectors come from a float32 solver and are then corrected by the iteration of
Ogita and Aishima: four matrix products in higher precision, each of which doubles the number of right digits. Where
eigenvalues lie so close that the correction cannot tell them apart, the vectors of such a cluster are turned by a small
solver of their own on the shifted matrix.

Only sums over dimensions and pairs of dimensions come to the driver: their size does not depend on the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A vector entry c becomes floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 64, 1_000_000
MOST = 32
#: Limbs of so many bits, and rows of so many at once: products of two limbs, summed, stay below 2^53.
LIMB_BITS, ROWS = 20, 4096
#: Entries whose integer has more bits are no numbers of this scale; their rows count as broken.
MOST_BITS = 56

#: Sums travel in two parts, so that the largest entries have room: v = high * 2^LOW_BITS + low.
LOW_BITS = 60
MOMENT = "row int, cells array<struct<high: decimal(38,0), low: decimal(38,0)>>"


def usable(df: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, v): the vectors without nulls and non-finite entries, as doubles."""
    v = F.col(embedding).cast("array<double>")
    bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) >= float(2**MOST_BITS // SCALE))
    rows = df.select(F.col(vec_id).alias("vec_id"), v.alias("v"))
    return rows.where(F.col("v").isNotNull() & (F.size("v") > 0) & ~F.exists("v", bad))


def usual_length(rows: DataFrame) -> int:
    """The most frequent length of vectors, the longest of several; 0 without rows."""
    counts = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.max(F.struct("n", "d"))["d"]).first()[0] or 0


def integers(batch: pa.RecordBatch, d: int) -> np.ndarray:
    """The vectors of a batch, one a row, as scaled integers less the offset."""
    flat = batch.column(batch.schema.get_field_index("v")).flatten().to_numpy(zero_copy_only=False)
    return np.floor(flat.reshape(-1, d) * SCALE).astype(np.int64)


def parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, ROWS):
        yield batch.slice(at, ROWS)


def product(x: np.ndarray) -> np.ndarray:
    """x^T x of integers, exactly, as Python integers where 64 bits might not do."""
    if not len(x) or int(np.abs(x).max()) < 1 << LIMB_BITS:
        return (x.T.astype(np.float64) @ x.astype(np.float64)).astype(np.int64)
    limbs, rest = [], np.abs(x)
    while rest.any():
        limbs.append((np.sign(x) * (rest & ((1 << LIMB_BITS) - 1))).astype(np.float64))
        rest >>= LIMB_BITS
    total = np.zeros((x.shape[1],) * 2, object)
    for i, a in enumerate(limbs):
        for j, b in enumerate(limbs):
            total += (a.T @ b).astype(np.int64).astype(object) << LIMB_BITS * (i + j)
    return total


class Sum:
    """A sum of integer arrays that never overflows: 64 bits while they must do, Python integers beyond."""

    def __init__(self, shape: tuple[int, ...]):
        self.whole, self.part, self.added = np.zeros(shape, object), np.zeros(shape, np.int64), 0

    def add(self, values: np.ndarray) -> None:
        if values.dtype == object:
            self.whole += values
            return
        self.part += values
        self.added += 1
        if self.added == 1 << 9:
            self.flush()

    def flush(self) -> np.ndarray:
        self.whole += self.part.astype(object)
        self.part[:], self.added = 0, 0
        return self.whole


def summed(rows: DataFrame, d: int, moments: Callable[[np.ndarray], np.ndarray]) -> list[list[int]]:
    """Element by element the sums over all rows of what `moments` makes of each batch's integers, a matrix."""
    number = pa.decimal128(38, 0)
    cell = pa.struct([("high", number), ("low", number)])
    schema = pa.schema([("row", pa.int32()), ("cells", pa.list_(cell))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for part in parts(batch):
                found = moments(integers(part, d))
                total = total or Sum(found.shape)
                total.add(found)
        for at, line in enumerate([] if total is None else total.flush().tolist()):
            cells = [{"high": Decimal(v >> LOW_BITS), "low": Decimal(v & (1 << LOW_BITS) - 1)} for v in line]
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([cells], pa.list_(cell))], schema=schema)

    partial = rows.select("v").mapInArrow(run, MOMENT).select("row", F.posexplode("cells").alias("column", "cell"))
    sums = [F.sum(f"cell.{part}").cast("decimal(38,0)").alias(part) for part in ("high", "low")]
    added = partial.groupBy("row", "column").agg(*sums)
    lines = added.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("column", "high", "low"))).alias("cells")).orderBy("row")
    return [[(int(c["high"]) << LOW_BITS) + int(c["low"]) for c in r["cells"]] for r in lines.collect()]


def total_and_count(x: np.ndarray) -> np.ndarray:
    kind = np.int64 if not len(x) or int(np.abs(x).max()) < 1 << 2 * LIMB_BITS else object
    return np.concatenate([x.sum(0, dtype=kind), [len(x)]])[None, :]


def eigenvectors(matrix: np.ndarray, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors of a symmetric matrix, in extended precision.

    `matrix` is taken in np.longdouble. The start is float32's; each round computes how far the vectors are from
    orthonormal (R) and from diagonalising (S), and corrects them. Pairs closer than the error bound form clusters.
    """
    a = matrix.astype(np.longdouble)
    size = np.abs(a).max() if a.size else 0
    if not size:
        return np.zeros(len(a), np.longdouble), np.eye(len(a), dtype=np.longdouble)
    a = (a + a.T) / (2 * size)
    _, start = np.linalg.eigh(a.astype(np.float32))
    x, previous = start.astype(np.longdouble), np.inf
    norm = np.sqrt((a * a).sum())
    for _ in range(rounds):
        x = near_orthonormal(x)
        s = x.T @ (a @ x)
        values = np.diagonal(s).copy()
        off = s - np.diag(values)
        error = np.sqrt((off * off).sum())
        if error <= len(a) * np.finfo(np.longdouble).eps * norm or error >= previous / 2 and error < 1e-16 * norm:
            break
        previous = error
        x = x @ turned(s, values, 2 * error)
        x = corrected(a, x)
    x = near_orthonormal(x)
    values = (x * (a @ x)).sum(0)
    order = np.argsort(-values, kind="stable")
    return values[order] * size, x[:, order]


def near_orthonormal(x: np.ndarray) -> np.ndarray:
    """x with its departure from orthonormality taken out, by two steps of X + X R / 2."""
    for _ in range(2):
        x = x + x @ ((np.eye(x.shape[1], dtype=x.dtype) - x.T @ x) / 2)
    return x


def clusters(values: np.ndarray, width: np.longdouble) -> list[np.ndarray]:
    """Groups of two and more places whose values, in order, lie within `width` of the next one."""
    order = np.argsort(values, kind="stable")
    cuts = np.flatnonzero(np.diff(values[order]) > width) + 1
    return [g for g in np.split(order, cuts) if len(g) > 1]


def turned(s: np.ndarray, values: np.ndarray, width: np.longdouble) -> np.ndarray:
    """The rotation that solves each cluster by itself: eigenvectors of its part of S, shifted by its middle value."""
    turn = np.eye(len(s), dtype=s.dtype)
    for group in clusters(values, width):
        part = s[np.ix_(group, group)] - np.eye(len(group), dtype=s.dtype) * values[group].mean()
        scale = np.abs(part).max()
        if scale:
            _, w = np.linalg.eigh(((part + part.T) / (2 * scale)).astype(np.float64))
            turn[np.ix_(group, group)] = near_orthonormal(w.astype(s.dtype))
    return turn


def corrected(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """One step of the iteration: X + X E."""
    r = np.eye(x.shape[1], dtype=x.dtype) - x.T @ x
    s = x.T @ (a @ x)
    values = np.diagonal(s) / (1 - np.diagonal(r))
    off = s - np.diag(np.diagonal(s))
    norm = np.sqrt((a * a).sum())
    bound = 2 * (np.sqrt((off * off).sum()) + norm * np.sqrt((r * r).sum()))
    gaps, wanted = values[None, :] - values[:, None], off + values[None, :] * r
    # A pair whose coupling is far below its gap may be corrected however the bound over all pairs stands. Gaps that
    # rounding alone may have made are none: any basis of such a cluster will do.
    apart = (np.abs(gaps) > bound) | (np.abs(gaps) > 8 * np.maximum(np.abs(off), np.abs(wanted)))
    apart &= np.abs(gaps) > 16 * len(a) * np.finfo(a.dtype).eps * norm
    e = np.where(apart, wanted / np.where(apart, gaps, 1), r / 2)
    np.fill_diagonal(e, np.diagonal(r) / 2)
    return x + x @ e


@dataclass(frozen=True)
class Whitening:
    """What the fit list gives: its size, sums of integers less the offset, and components."""

    n: int
    sums: list[int]
    trace: float
    values: np.ndarray
    directions: np.ndarray  # a column for each component, divided by the root of its value; zero where that is none

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n as doubles: the whole part exactly, then the fraction."""
        whole = np.array([round_div(s, self.n) for s in self.sums], np.int64)
        rest = np.array([(s - int(w) * self.n) / self.n for s, w in zip(self.sums, whole)])
        return (x - whole).astype(np.float64) - rest

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.directions

    def deviations(self, x: np.ndarray) -> list[int]:
        """For each row the sum over dimensions of (n x - S)^2."""
        most = int(np.abs(x).max(initial=0)) * self.n + max(map(abs, self.sums), default=0)
        kind = np.int64 if most * most * max(len(self.sums), 1) < 1 << 63 else object
        away = x.astype(kind) * self.n - np.array(self.sums, kind)
        return [int(v) for v in (away * away).sum(1)]


def round_div(a: int, n: int) -> int:
    """The whole number nearest to a / n."""
    return (2 * a + n) // (2 * n)


def covariance(n: int, sums: list[int], squares: list[list[int]]) -> list[list[int]]:
    """n^2 times the covariance, exactly, from the sums and products of values less any whole number."""
    return [[n * q - a * b for b, q in zip(sums, line)] for a, line in zip(sums, squares)]


def fit(rows: DataFrame, d: int, most: int = MOST) -> Whitening | None:
    """The whitening of (vec_id, v) rows of length d; None without rows."""
    first = summed(rows, d, total_and_count)
    if not first:
        return None
    *sums, n = first[0]
    middle = np.array([round_div(s, n) for s in sums], np.int64)
    squares = summed(rows, d, lambda x: product(x - middle))
    exact = covariance(n, [s - int(m) * n for s, m in zip(sums, middle)], squares)
    v = np.array([[np.longdouble(c) for c in line] for line in exact]) / (np.longdouble(n) * n)
    values, vectors = eigenvectors(v)
    values, vectors = values[:most], vectors[:, :most]
    least = d * np.finfo(np.float64).eps * max(values.max(initial=0), 0)
    roots = np.sqrt(np.where(values > least, values, np.inf))
    trace = sum(exact[i][i] for i in range(d)) / (n * n)
    return Whitening(n, sums, trace, values.astype(np.float64), (vectors / roots).astype(np.float64))


def identity_error(rows: DataFrame, d: int, model: Whitening) -> float | None:
    """The largest entry of the whitened rows' covariance less the identity, over components that have a variance."""
    has = np.abs(model.directions).max(0) > 0
    if not has.any():
        return None
    k = int(has.sum())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            for part in parts(batch):
                w = model.whitened(integers(part, d))[:, has]
                total += np.vstack([w.T @ w, w.sum(0)])
        columns = [pa.array(range(k + 1), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["row", "sums"])

    partial = rows.select("v").mapInArrow(run, "row int, sums array<double>")
    cells = partial.select("row", F.posexplode("sums").alias("column", "value")).groupBy("row", "column").agg(F.sum("value"))
    found = np.zeros((k + 1, k))
    for row, column, value in cells.collect():
        found[row, column] = value
    # Rows are centred by the exact mean before they are multiplied; what rounding leaves of their mean goes here.
    mean = found[k] / model.n
    return float(np.abs(found[:k] / model.n - np.outer(mean, mean) - np.eye(k)).max())


RESULT = "vec_id bigint, deviation string, component array<double>"


def whitened(df: DataFrame, most: int = MOST, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) for each usable row and component.

    Vectors that are null, empty, or hold a null, a non-finite entry or one of 2^50 and more are left out, and so are
    those of another length than most vectors have. Rows that repeat, of one vec_id or not, all count; a null vec_id
    stays null. Components are numbered from 1 by falling eigenvalue, at most `most` and no more than dimensions. Where a
    component has no variance (the rest of the rank), `whitened` is null and `explained` 0. `deviation` is a
    decimal(38,0), null beyond it. Without usable rows the result is empty. Other columns of `df` do not travel.
    """
    spark = df.sparkSession
    rows = usable(df, vec_id, embedding)
    d = usual_length(rows)
    rows = rows.where(F.size("v") == d)
    model = fit(rows, d, most) if d else None
    schema = (
        "vec_id bigint, component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"
    )
    if model is None:
        return spark.createDataFrame([], schema)
    error = identity_error(rows, d, model)
    has = np.abs(model.directions).max(0) > 0
    explained = [float(max(v, 0) / model.trace) if h else 0.0 for v, h in zip(model.values, has)]
    out = pa.schema([("vec_id", pa.int64()), ("deviation", pa.string()), ("component", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch):
                x = integers(part, d)
                w = model.whitened(x)
                flat = pa.array(w.ravel(), mask=np.broadcast_to(~has, w.shape).ravel())
                lists = pa.ListArray.from_arrays(pa.array(range(0, w.size + 1, w.shape[1]), pa.int32()), flat)
                columns = [part.column(0), pa.array(map(str, model.deviations(x)), pa.string()), lists]
                yield pa.RecordBatch.from_arrays(columns, schema=out)

    found = rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), "v").mapInArrow(run, RESULT)
    shares = F.array(*[F.lit(e) for e in explained])
    exploded = found.select("vec_id", "deviation", F.posexplode("component").alias("at", "whitened"))
    return exploded.select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("bigint").alias("n"),
        F.col("deviation").try_cast("decimal(38,0)").alias("deviation"),
        "whitened",
        F.get(shares, F.col("at")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )

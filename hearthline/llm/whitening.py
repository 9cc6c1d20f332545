"""Embedding whitening: leading eigenvectors of the covariance by spectrum slicing.

Entries become whole numbers, so counts and sums over any number of vectors are exact.
Three passes of Spark tasks read the vectors: sums; products of the centred vectors; the
covariance of the whitened values, which says how far it is from the identity. A task
hands on one row of sums or one row per entry of a matrix, and Spark adds those up.

The eigenvectors of the one small matrix that is left come from spectrum slicing. The
symmetric factorisation LDL' of the covariance less a shift has as many positive pivots
as there are eigenvalues above the shift. Bisection by these counts isolates each leading
eigenvalue in an interval of its own; Rayleigh quotient iteration inside it converges
cubically; counts just above and below the result certify its number. Eigenvalues that
no count can tell apart (closer than rounding) form one cluster: their vectors are
found one by one, each orthogonal to the ones before.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.llm.common import bounded_batches

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 32
#: Scaled entries beyond are taken as this large, so that whole numbers stay within a long.
LARGEST = 1 << 61
#: Eigenvalues closer than this share of the largest one are one cluster.
CLUSTER = 1e-13

_EPS = float(np.finfo(float).eps)
_HALF = 32


# ---- one small symmetric matrix, on the driver --------------------------------------------------


def count_above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues of a symmetric matrix lie above ``shift``.

    Factorises ``matrix - shift`` as LDL' with pivots of one or two rows, the largest
    entry left deciding (Bunch and Parlett), and counts the positive ones.
    """
    a = matrix - shift * np.eye(len(matrix))
    bound = (1 + np.sqrt(17)) / 8
    above = 0
    while len(a):
        entries = np.abs(a)
        on = int(np.argmax(entries.diagonal()))
        r, s = divmod(int(np.argmax(entries)), len(a))
        if entries[r, s] == 0:
            return above
        if entries[on, on] >= bound * entries[r, s]:
            pivot = [on]
            above += a[on, on] > 0
        else:
            pivot = [r, s]
            above += 1  # such a block has one positive and one negative eigenvalue
        rest = np.delete(np.arange(len(a)), pivot)
        side = a[np.ix_(rest, pivot)]
        a = a[np.ix_(rest, rest)] - side @ np.linalg.solve(a[np.ix_(pivot, pivot)], side.T)
        a = (a + a.T) / 2
    return above


def _rayleigh(
    matrix: np.ndarray, low: float, high: float, found: list[np.ndarray], seed: int
) -> tuple[float, np.ndarray, bool]:
    """A Rayleigh quotient, its vector, and whether the iteration settled within the interval.

    Starts from a shift in the middle; directions already found are taken out each step.
    """
    scale = np.abs(matrix).sum(axis=0).max()
    basis = np.array(found).reshape(len(found), len(matrix))
    vector = np.random.default_rng(seed).standard_normal(len(matrix))
    shift, settled = (low + high) / 2, False
    for step in range(30):
        shifted = matrix - shift * np.eye(len(matrix))
        try:
            vector = np.linalg.solve(shifted, vector)
        except np.linalg.LinAlgError:  # the shift is an eigenvalue to the last bit
            vector = np.linalg.solve(shifted + 8 * _EPS * scale * np.eye(len(matrix)), vector)
        for _ in range(2):
            vector = vector / np.linalg.norm(vector)
            vector = vector - basis.T @ (basis @ vector)
        vector = vector / np.linalg.norm(vector)
        value = float(vector @ matrix @ vector)
        gone = np.linalg.norm(matrix @ vector - value * vector)
        if gone <= 4 * _EPS * scale * np.sqrt(len(matrix)):
            if settled:
                break
            settled = True  # one more step squares off what is left
        if step:  # the first steps only turn the vector towards the middle of the interval
            shift = value
    return value, vector, settled and low - CLUSTER * scale <= value <= high + CLUSTER * scale


def leading(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues, falling, and their unit vectors (rows).

    Raises ArithmeticError if counts do not confirm the number of an eigenvalue.
    """
    matrix = (matrix + matrix.T) / 2
    count = min(count, len(matrix))
    if not count:
        return np.zeros(0), np.zeros((0, len(matrix)))
    radius = np.abs(matrix).sum(axis=1) - np.abs(matrix.diagonal())
    top = float((matrix.diagonal() + radius).max())
    bottom = float((matrix.diagonal() - radius).min())
    scale = max(abs(top), abs(bottom))
    if scale < np.finfo(float).tiny / _EPS:  # nothing but zeros
        return np.zeros(count), np.eye(len(matrix))[:count]
    top, bottom = top + 1e-9 * scale, bottom - 1e-9 * scale
    counts = {top: 0, bottom: len(matrix)}

    def above(shift: float) -> int:
        if shift not in counts:
            counts[shift] = count_above(matrix, shift)
        return counts[shift]

    values, vectors = [], []
    while len(values) < count:
        number = len(values) + 1
        # the closest shifts known on either side of eigenvalue `number`
        high = min(s for s, n in counts.items() if n < number)
        low = max(s for s, n in counts.items() if n >= number)
        while counts[low] - counts[high] > 1 and high - low > CLUSTER * scale:
            middle = (low + high) / 2
            if above(middle) >= number:
                low = middle
            else:
                high = middle
        several = counts[low] - counts[high]
        if several > 1:  # a cluster, as wide as rounding
            for k in range(min(several, count - len(values))):
                value, vector, _ = _rayleigh(matrix, low, high, vectors, number + k)
                values.append(value)
                vectors.append(vector)
        else:
            while True:
                value, vector, settled = _rayleigh(matrix, low, high, vectors, number)
                if settled or high - low <= CLUSTER * scale:
                    break
                middle = (low + high) / 2
                if above(middle) >= number:
                    low = middle
                else:
                    high = middle
            values.append(value)
            vectors.append(vector)
        slack = 64 * CLUSTER * scale
        if above(values[-1] + slack) >= len(values) or above(values[-1] - slack) < len(values):
            raise ArithmeticError(f"counts do not confirm eigenvalue {len(values)}")
    order = np.argsort(-np.array(values), kind="stable")  # within a cluster
    return np.array(values)[order], np.array(vectors)[order]


# ---- the vectors, on Spark ----------------------------------------------------------------------


def whole(rows: list, dims: int) -> np.ndarray:
    """Vectors as whole numbers, one row each; shorter ones as if zeros followed."""
    full = np.zeros((len(rows), dims))
    for k, row in enumerate(rows):
        full[k, : len(row)] = row
    scaled = np.clip(np.floor(SCALE * full), -LARGEST, LARGEST)
    return scaled.astype(np.int64) + OFFSET


def usable(vectors: DataFrame, id_: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(vec_id, vector)`` of the rows whose vector holds neither nulls nor values that are not finite."""
    c = F.col(vector)
    bad = F.exists(c, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    return vectors.select(F.col(id_).alias("vec_id"), c.cast("array<double>").alias("vector")).filter(
        F.col("vector").isNotNull() & ~F.coalesce(bad, F.lit(False))
    )


@dataclass(frozen=True)
class Whitening:
    """A fitted whitening: count and sums of the fit list, and the components.

    ``values`` fall; ``vectors`` has a unit vector per row; ``trace`` is that of the
    whole covariance. Directions without variance are no components.
    """

    n: int
    sums: tuple[int, ...]
    trace: float
    values: np.ndarray
    vectors: np.ndarray

    @property
    def dims(self) -> int:
        return len(self.sums)

    @property
    def explained(self) -> list[float]:
        return [float(v / self.trace) for v in self.values]


def _spread(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """n * x - S, in long integers if all fit, else in Python's."""
    limit = 1 << 62
    small = n * int(np.abs(x).max(initial=0)) < limit and max(map(abs, sums), default=0) < limit
    kind = np.int64 if small else object
    return n * x.astype(kind) - np.array(sums, kind)


def _matrix_rows(total: np.ndarray) -> pd.DataFrame:
    i, j = np.triu_indices(len(total))
    return pd.DataFrame({"i": i.astype(np.int32), "j": j.astype(np.int32), "v": total[i, j]})


def _collected(entries: DataFrame, size: int) -> np.ndarray:
    """A symmetric matrix from summed entries: size * size / 2 numbers, whatever the data."""
    out = np.zeros((size, size))
    for r in entries.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["v"]
    return out


def _sums(rows: DataFrame, dims: int) -> tuple[int, list[int]]:
    """The number of vectors and the exact sum of every dimension."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, upper, lower = 0, np.zeros(dims, np.int64), np.zeros(dims, np.int64)
        for frame in frames:
            x = whole(frame["vector"].tolist(), dims)
            n += len(x)
            upper += (x >> _HALF).sum(axis=0)
            lower += (x & (1 << _HALF) - 1).sum(axis=0)
        yield pd.DataFrame(
            {"i": np.arange(-1, dims, dtype=np.int32), "upper": [n, *upper.tolist()], "lower": [0, *lower.tolist()]}
        )

    # halves of the numbers: their sums stay within a long up to 2 ** 31 vectors, and within a decimal beyond
    parts = rows.select("vector").mapInPandas(run, "i int, upper long, lower long")
    summed = parts.groupBy("i").agg(
        *[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("upper", "lower")]
    )
    found = {r["i"]: (int(r["upper"]), int(r["lower"])) for r in summed.collect()}
    n = found.get(-1, (0, 0))[0]
    return n, [(up << _HALF) + low for up, low in (found.get(i, (0, 0)) for i in range(dims))]


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening:
    """The whitening of ``rows(vector)``, as :func:`usable` gives them."""
    bounded_batches(rows.sparkSession)
    dims = rows.agg(F.max(F.size("vector"))).first()[0] or 0
    n, sums = _sums(rows, dims)
    sums = tuple(sums)

    def products(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((dims, dims))
        for frame in frames:
            centred = _spread(whole(frame["vector"].tolist(), dims), n, sums).astype(float) / n
            total += centred.T @ centred
        yield _matrix_rows(total)

    if not n or not dims:
        return Whitening(n, sums, 0.0, np.zeros(0), np.zeros((0, dims)))
    covariance = _collected(rows.select("vector").mapInPandas(products, "i int, j int, v double"), dims) / n
    trace = float(np.trace(covariance))
    if trace <= 0:
        return Whitening(n, sums, trace, np.zeros(0), np.zeros((0, dims)))
    values, vectors = leading(covariance, components)
    real = values > dims * 64 * _EPS * values[0]  # the rest is rounding: no variance there
    return Whitening(n, sums, trace, values[real], vectors[real])


def _projected(vectors: list, fitted: Whitening) -> tuple[np.ndarray, np.ndarray]:
    """n * x - S and the whitened values of a batch."""
    spread = _spread(whole(vectors, fitted.dims), fitted.n, fitted.sums)
    return spread, (spread.astype(float) / fitted.n) @ fitted.vectors.T / np.sqrt(fitted.values)


def identity_error(rows: DataFrame, fitted: Whitening) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity."""
    size = len(fitted.values)
    if not size:
        return 0.0

    def products(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((size + 1, size + 1))  # the last line adds up the values themselves
        for frame in frames:
            _, w = _projected(frame["vector"].tolist(), fitted)
            w = np.column_stack([w, np.ones(len(w))])
            total += w.T @ w
        yield _matrix_rows(total)

    total = _collected(rows.select("vector").mapInPandas(products, "i int, j int, v double"), size + 1) / fitted.n
    mean = total[:size, size]  # nearly zero already, as the vectors are centred
    return float(np.abs(total[:size, :size] - np.outer(mean, mean) - np.eye(size)).max())


def whiten(rows: DataFrame, fitted: Whitening) -> DataFrame:
    """``(vec_id, deviation, whitened)``: an array with a value per component."""
    bounded_batches(rows.sparkSession)

    @F.pandas_udf("deviation long, whitened array<double>")
    def run(batch: pd.Series) -> pd.DataFrame:
        spread, w = _projected(batch.tolist(), fitted)
        widest = int(np.abs(spread).max(initial=0))
        if widest * widest * max(fitted.dims, 1) >= 1 << 63:
            totals = [sum(int(v) ** 2 for v in row) for row in spread.tolist()]
            deviation = [t if t < 1 << 63 else None for t in totals]
        else:
            deviation = (spread.astype(np.int64) ** 2).sum(axis=1).tolist()
        return pd.DataFrame({"deviation": pd.array(deviation, "Int64"), "whitened": list(w)})

    return rows.select("vec_id", run("vector").alias("r")).select("vec_id", "r.deviation", "r.whitened")


def whitened(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)``.

    A row for each row of ``vectors(vec_id, embedding)`` that :func:`usable` keeps, repeated
    rows and null ids included, and each component. Vectors shorter than the longest count
    as if zeros followed. Components without variance are left out: a single vector, or an
    empty table, gives no rows. A deviation beyond a long is null. Other columns are not read.
    """
    rows = usable(vectors)
    fitted = fit(rows, components)
    error = identity_error(rows, fitted)
    shares = F.array(*map(F.lit, fitted.explained)) if len(fitted.values) else F.array().cast("array<double>")
    return (
        whiten(rows, fitted)
        .select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
        .select(
            "vec_id",
            (F.col("at") + 1).alias("component"),
            F.lit(fitted.n).cast("long").alias("n"),
            "deviation",
            "whitened",
            F.element_at(shares, F.col("at") + 1).alias("explained"),
            F.lit(error).cast("double").alias("identity_error"),
        )
    )

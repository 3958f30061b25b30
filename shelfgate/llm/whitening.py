"""Whitening of embeddings by the leading eigenvectors of their covariance, by spectrum slicing.

The sums that the covariance needs are integers, added up exactly on the
executors: tasks send one row per pair of dimensions, so what reaches the
driver is the covariance alone, whose size is fixed by the dimension. There
the spectrum is sliced: by Sylvester's law, as many pivots of the LDL'
factors of ``V - s I`` are negative as there are eigenvalues below ``s``, so
bisection on that count isolates each of the largest eigenvalues. Rayleigh
quotient iteration then converges cubically, and counts on both sides of the
result certify its number.
"""

from __future__ import annotations

from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
CHUNK = 4096
_EPS = np.finfo(np.float64).eps


# ---- the eigenvalues of a symmetric matrix

def count_below(matrix: np.ndarray, shift: float) -> int:
    """Eigenvalues of the symmetric ``matrix`` below ``shift``: the negative pivots of an LDL'
    factorization with complete pivoting in blocks of one or two."""
    a = matrix - shift * np.eye(len(matrix))
    growth = (1 + np.sqrt(17)) / 8
    below = 0
    while n := len(a):
        d = np.abs(np.diag(a))
        off = np.abs(np.tril(a, -1))
        r = int(d.argmax())
        i, j = divmod(int(off.argmax()), n)
        if d[r] >= growth * off[i, j]:
            if d[r] == 0:
                return below
            below += bool(a[r, r] < 0)
            keep = np.arange(n) != r
            col = a[keep, r]
            a = a[np.ix_(keep, keep)] - np.outer(col, col / a[r, r])
        else:  # a block of two has one negative eigenvalue
            below += 1
            keep = np.ones(n, bool)
            keep[[i, j]] = False
            cols = a[np.ix_(keep, [i, j])]
            block = a[np.ix_([i, j], [i, j])]
            a = a[np.ix_(keep, keep)] - cols @ np.linalg.solve(block, cols.T)
        a = (a + a.T) / 2
    return below


def _bisect(matrix: np.ndarray, k: int, low: float, high: float, done) -> tuple[float, float]:
    """An interval around the ``k``-th largest eigenvalue, halved by counts until ``done(low, high, inside)``."""
    n = len(matrix)
    below_low, below_high = count_below(matrix, low), count_below(matrix, high)
    while not done(low, high, below_high - below_low):
        mid = (low + high) / 2
        c = count_below(matrix, mid)
        if n - c >= k:  # k eigenvalues are at least mid
            low, below_low = mid, c
        else:
            high, below_high = mid, c
    return low, high


def _rayleigh(matrix: np.ndarray, start: np.ndarray, low: float, high: float, noise: float, apart):
    """(value, vector) by Rayleigh quotient iteration, or None if it does not settle in the interval.
    Until the quotient lies in the interval, the shift is its middle."""
    v, shift, eye = start, (low + high) / 2, np.eye(len(matrix))
    best = (np.inf, 0.0, v)
    for _ in range(12):
        try:
            w = np.linalg.solve(matrix - shift * eye, v)
        except np.linalg.LinAlgError:  # the shift is an eigenvalue to the last bit
            w = np.full(len(v), np.inf)
        if not np.abs(w).max() < 1e100:
            w = np.linalg.solve(matrix - (shift + noise / 8) * eye, v)
        v = apart(w)
        quotient = float(v @ matrix @ v)
        if not low - noise <= quotient <= high + noise:
            continue
        residual = float(np.linalg.norm(matrix @ v - quotient * v))
        if residual >= best[0] and best[0] <= noise:
            break
        best, shift = min(best, (residual, quotient, v), key=lambda x: x[0]), quotient
    return best[1:] if best[0] <= noise else None


def leading_eigenpairs(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues, falling, and their unit eigenvectors as columns.

    Eigenvalues closer to each other than rounding allows to tell share an
    interval; their vectors are made orthogonal, any basis being right.
    Raises ArithmeticError if the counts do not confirm a result.
    """
    n, k = len(matrix), min(k, len(matrix))
    norm = float(np.abs(matrix).sum(axis=1).max(initial=0.0))
    if norm == 0:
        return np.zeros(k), np.eye(n)[:, :k]
    scale = 2.0 ** np.floor(np.log2(norm))
    matrix, norm = matrix / scale, norm / scale
    noise = 8 * n * _EPS * norm
    rng = np.random.default_rng(0)
    values, vectors = np.zeros(k), np.zeros((n, k))
    for c in range(k):
        found = vectors[:, :c]

        def apart(v):
            for _ in range(2):
                v = v - found @ (found.T @ v)
            return v / np.linalg.norm(v)

        low, high = _bisect(matrix, c + 1, -norm - noise, norm + noise,
                            lambda a, b, inside: b - a <= noise or inside == 1 and b - a <= 1e-2 * abs(b))
        while (got := _rayleigh(matrix, apart(rng.standard_normal(n)), low, high, noise, apart)) is None:
            if high - low <= noise:
                raise ArithmeticError(f"eigenvalue {c + 1} does not settle")
            width = (high - low) / 16
            low, high = _bisect(matrix, c + 1, low, high, lambda a, b, inside: b - a <= max(width, noise))
        values[c], vectors[:, c] = got
        # numbering: at most c eigenvalues lie above the value, at least c + 1 not below it
        if not n - count_below(matrix, values[c] + 4 * noise) <= c < n - count_below(matrix, values[c] - 4 * noise):
            raise ArithmeticError(f"eigenvalue {c + 1} is not confirmed by the counts")
    return values * scale, vectors


# ---- exact sums

def quantized(flat: np.ndarray) -> np.ndarray:
    """floor(1024 c) + 100000 of finite doubles; int64, or Python integers where that is too small."""
    with np.errstate(over="ignore"):
        scaled = np.floor(flat * SCALE)
    if np.abs(scaled).max(initial=0) < 2.0 ** 50:
        return scaled.astype(np.int64) + OFFSET
    whole = [int(np.floor(c)) if abs(c) > 2.0 ** 60 else None for c in flat.ravel().tolist()]
    exact = [w * SCALE if w is not None else int(s) for w, s in zip(whole, scaled.ravel().tolist())]
    return np.array([e + OFFSET for e in exact], dtype=object).reshape(flat.shape)


def exact_gram(y: np.ndarray) -> np.ndarray:
    """y' y as exact integers."""
    most = int(np.abs(y).max(initial=0))
    if y.dtype == object or most * most * max(len(y), 1) >= 2 ** 63:
        y = y.astype(object)
        return y.T.dot(y)
    if most * most * max(len(y), 1) < 2 ** 53:  # doubles hold these exactly, and are multiplied faster
        f = y.astype(np.float64)
        return (f.T @ f).astype(np.int64)
    return y.T @ y


def _matrix(batch, dims: int) -> np.ndarray:
    col = batch.column("vector")
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(-1, dims)


def _sums(dims: int):
    def run(batches):
        gram = np.zeros((dims + 1, dims + 1), dtype=object)
        for batch in batches:
            for lo in range(0, batch.num_rows, CHUNK):
                x = quantized(_matrix(batch.slice(lo, CHUNK), dims)) - OFFSET
                gram += exact_gram(np.concatenate([np.ones((len(x), 1), x.dtype), x], axis=1)).astype(object)
        if gram[0, 0]:
            i, j = np.triu_indices(dims + 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)),
                 pa.array([str(v) for v in gram[i, j]], pa.string())], names=["i", "j", "v"])
    return run


def _total(parts):
    """Sums of integers written as text, by (i, j); of any size."""
    sums: dict[tuple[int, int], int] = {}
    for batch in parts:
        for i, j, v in zip(*(batch.column(c).to_pylist() for c in ("i", "j", "v"))):
            sums[i, j] = sums.get((i, j), 0) + int(v)
    yield pa.RecordBatch.from_arrays(
        [pa.array([k[0] for k in sums], pa.int32()), pa.array([k[1] for k in sums], pa.int32()),
         pa.array([str(v) for v in sums.values()], pa.string())], names=["i", "j", "v"])


def vectors(table: DataFrame, *, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """``id`` and ``vector`` (array of doubles) of the usable rows, and their dimension."""
    column = F.col(f"`{vector_col}`")
    finite = F.forall(column, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    src = (table.where(column.isNotNull()).where(finite)
           .select(F.col(f"`{id_col}`").alias("id"), column.cast("array<double>").alias("vector")))
    common = (src.where(F.size("vector") > 0).groupBy(F.size("vector").alias("d")).count()
              .orderBy(F.desc("count"), F.desc("d")).first())
    dims = common.d if common else 0
    return src.where(F.size("vector") == dims), dims


class Whitening:
    """The fit: ``n``, ``sums`` of the x-vectors, ``trace`` of their covariance, eigenvalues, eigenvectors.

    Lengths are in units of 2 ** ``unit``, which is 0 unless squares were too large for doubles."""

    def __init__(self, n: int, sums: list[int], covariance: np.ndarray, components: int, unit: int = 0):
        self.n, self.sums, self.dims, self.unit = n, sums, len(sums), unit
        self.covariance, self.trace = covariance, float(np.trace(covariance)) if len(sums) else 0.0
        values, vecs = leading_eigenpairs(covariance, components) if len(sums) else (np.zeros(0), np.zeros((0, 0)))
        # directions without spread cannot be scaled to one
        kept = values > 8 * self.dims * _EPS * max(self.trace, 0.0)
        self.values, self.vectors = values[kept], vecs[:, kept]

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exact."""
        s = np.array(self.sums, dtype=object)
        if x.dtype != object and self.n * int(np.abs(x).max(initial=0)) + max(map(abs, self.sums), default=0) < 2 ** 62:
            return self.n * x - s.astype(np.int64)
        return self.n * x.astype(object) - s

    def whiten(self, deviations: np.ndarray) -> np.ndarray:
        if self.unit:
            deviations = deviations.astype(object) / (self.n << self.unit)
        centred = deviations.astype(np.float64) / (1 if self.unit else self.n)
        return centred @ self.vectors / np.sqrt(self.values)


def fit(src: DataFrame, dims: int, components: int = COMPONENTS) -> Whitening:
    """Fit on every row of ``src`` (see :func:`vectors`).

    The sums run over x - 100000 as exact integers, so the covariance
    (n sum(y y') - sum(y) sum(y)') / n^2 is that of centred vectors without any rounding before it
    becomes doubles.
    """
    if not dims:
        return Whitening(0, [], np.zeros((0, 0)), 0)
    schema = "i int, j int, v string"
    partial = src.select("vector").mapInArrow(_sums(dims), schema)
    parts = int(src.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = partial.repartition(parts, "i", "j").mapInArrow(_total, schema).collect()  # (dims + 1)^2 / 2 rows
    g = {(r.i, r.j): int(r.v) for r in total}
    n = g[0, 0]
    s = [g[0, j + 1] for j in range(dims)]
    exact = {(i, j): n * g[i + 1, j + 1] - s[i] * s[j] for i in range(dims) for j in range(i, dims)}
    unit = max(0, max(v.bit_length() for v in exact.values()) - 2 * n.bit_length() - 900) // 2
    cov = np.zeros((dims, dims))
    for (i, j), v in exact.items():
        cov[i, j] = cov[j, i] = float(Fraction(v, n * n << 2 * unit))
    return Whitening(n, [v + n * OFFSET for v in s], cov, components, unit)


def _whitened(model: Whitening):
    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, CHUNK):
                part = batch.slice(lo, CHUNK)
                dev = model.deviations(quantized(_matrix(part, model.dims)))
                w = model.whiten(dev)
                most = int(np.abs(dev).max(initial=0))
                if dev.dtype == object or most * most * model.dims >= 2 ** 63:
                    dev = dev.astype(object)
                total = (dev * dev).sum(axis=1)
                deviation = pa.array([Decimal(int(v)) if v < 10 ** 38 else None for v in total], pa.decimal128(38, 0))
                offsets = np.arange(0, (len(w) + 1) * w.shape[1], w.shape[1], dtype=np.int32)[:len(w) + 1]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), deviation, pa.ListArray.from_arrays(offsets, np.ascontiguousarray(w).ravel())],
                    names=["id", "deviation", "whitened"])
    return run


def identity_error(rows: DataFrame, n: int, k: int) -> float:
    """Largest absolute entry of the covariance of ``whitened`` (centred already) minus the identity."""
    def run(batches):
        gram = np.zeros((k + 1, k + 1))
        for batch in batches:
            w = batch.column("whitened").flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
            one = np.concatenate([np.ones((len(w), 1)), w], axis=1)
            gram += one.T @ one
        i, j = np.triu_indices(k + 1)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(gram[i, j])],
                                         names=["i", "j", "v"])

    sums = rows.select("whitened").mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    g = np.zeros((k + 1, k + 1))
    for r in sums.collect():  # (k + 1)^2 / 2 rows
        g[r.i, r.j] = g[r.j, r.i] = r.v
    mean = g[0, 1:] / n
    return float(np.abs(g[1:, 1:] / n - np.outer(mean, mean) - np.eye(k)).max())


def whiten(table: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding",
           components: int = COMPONENTS) -> DataFrame:
    """``id_col``, ``component``, ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``:
    a row per usable row of ``table`` and component, as :func:`whiten_rows` gives them."""
    rows, model, error = whiten_rows(table, id_col=id_col, vector_col=vector_col, components=components)
    explained = F.array(*[F.lit(float(v) / model.trace) for v in model.values]) if len(model.values) else F.array()
    longest = F.lit(2 ** 63 - 1)
    out = rows.select("id", "deviation", F.posexplode("whitened").alias("c", "w"))
    return out.select(F.col("id").alias(id_col), (F.col("c") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"),
                      F.when(F.col("deviation") <= longest, F.col("deviation")).cast("long").alias("deviation"),
                      F.col("w").alias("whitened"),
                      F.element_at(explained.cast("array<double>"), F.col("c") + 1).alias("explained"),
                      F.lit(error).cast("double").alias("identity_error"))


def whiten_rows(table: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding",
                components: int = COMPONENTS) -> tuple[DataFrame, Whitening, float | None]:
    """(id, deviation, whitened) per usable row, the fit, and the identity error.

    Rows whose vector is null, empty, or holds null or non-finite entries are
    left out, and so are vectors whose length is not the commonest one (of
    equally common ones the longest). Ids, null or repeated, play no part:
    every row counts. Components without spread beyond rounding are left out,
    so a table of equal vectors, of one row or of none gives no rows. A
    deviation beyond 64 bits is null in :func:`whiten`. Other columns are
    ignored, whatever their names.
    """
    src, dims = vectors(table, id_col=id_col, vector_col=vector_col)
    model = fit(src, dims, components)
    ddl = f"id {table.schema[id_col].dataType.simpleString()}, deviation decimal(38,0), whitened array<double>"
    if not len(model.values):
        return table.sparkSession.createDataFrame([], ddl), model, None
    rows = materialize(src.mapInArrow(_whitened(model), ddl), "whitened")
    return rows, model, identity_error(rows, model.n, len(model.values))

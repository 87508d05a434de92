"""Embedding whitening with a FEAST eigensolver.

Vectors become whole numbers on a grid, so that their sums and their products
about a whole-number centre are exact whatever the order of addition; the
covariance follows from them with one rounding.

The leading components come from contour integration (FEAST): inertia counts
(signs of the pivots of a symmetric elimination of the shifted covariance)
cut the upper spectrum into intervals of few eigenvalues; around each interval
a quadrature over complex shifts z solves (zI - V) X = Y, one Spark task a
shift, and the weighted sum of the solutions projects Y onto the interval's
eigenvectors.  A Rayleigh-Ritz step extracts them, and the count of those found
must equal the interval's inertia, so that none is missed.

Only matrices of the vectors' width reach the driver, none that grows with the
rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Grid of the vectors: floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 1024, 100_000
#: Entries of this size on the grid or beyond raise: their products are not exact.
WIDEST = 1 << 40
#: Nodes of the quadrature on the upper half of the contour.
NODES = 8
#: Residual, against the largest eigenvalue, at which an interval is done: this
#: times the width, or ten times this.
RESIDUAL = 1e-15
SWEEPS = 20


def grid(column, width: int):
    """(rows that take part, their whole numbers as an array rows x width) of
    an Arrow column of lists of doubles."""
    import numpy as np

    offsets = np.asarray(column.offsets).astype(np.int64)
    flat = column.values
    c = np.where(np.asarray(flat.is_valid()), np.asarray(flat.fill_null(0)), np.nan)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(c))])
    fit = np.asarray(column.is_valid()) & (bad[offsets[1:]] == bad[offsets[:-1]]) & (np.diff(offsets) == width)
    rows = np.flatnonzero(fit)
    x = np.floor(SCALE * c[offsets[rows][:, None] + np.arange(width)])
    if np.abs(x).max(initial=0) >= WIDEST:
        raise ValueError(f"a vector has an entry of {WIDEST // SCALE} or more")
    return rows, x.astype(np.int64) + SHIFT


def _column(vectors: DataFrame, vector_col: str):
    return F.col(f"`{vector_col}`").cast("array<double>").alias("v")


def vector_width(vectors: DataFrame, vector_col: str) -> tuple[int, int] | None:
    """(width, rows) of the vectors that take part: the width most of them
    have, the larger of equally many; None if there are none."""
    v = vectors.select(_column(vectors, vector_col))
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    counts = v.where(F.col("v").isNotNull() & (F.size("v") > 0) & finite).groupBy(F.size("v").alias("width")).agg(F.count("*").alias("n"))
    top = counts.orderBy(F.desc("n"), F.desc("width")).limit(1).collect()
    return (top[0]["width"], top[0]["n"]) if top else None


def column_sums(vectors: DataFrame, vector_col: str, width: int) -> list[int]:
    """Exact sum of each dimension."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        total = [0] * width
        for batch in batches:
            _, x = grid(batch.column(0), width)
            total = [a + int(b) for a, b in zip(total, x.sum(axis=0))]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)), pa.array(total, pa.decimal128(38, 0))], names=["i", "s"])

    parts = vectors.select(_column(vectors, vector_col)).mapInArrow(run, "i int, s decimal(38,0)")
    out = [0] * width
    for r in parts.groupBy("i").agg(F.sum("s").alias("s")).collect():  # one row a dimension
        out[r["i"]] = int(r["s"])
    return out


def exact_products(y):
    """y^T y of whole numbers, exact: in doubles while all sums stay below
    2**53, otherwise in Python's integers."""
    import numpy as np

    top = int(np.abs(y).max(initial=0))
    if top * top * max(1, len(y)) < 1 << 53:
        f = y.astype(np.float64)
        return (f.T @ f).astype(np.int64).astype(object)
    o = y.astype(object)
    return o.T @ o


def product_sums(vectors: DataFrame, vector_col: str, centre: list[int]) -> list[list[int]]:
    """Exact sums of products of the entries about ``centre``."""
    width = len(centre)

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        total = np.zeros((width, width), object)
        for batch in batches:
            _, x = grid(batch.column(0), width)
            total = total + exact_products(x - np.array(centre, np.int64))
        i, j = np.triu_indices(width)
        columns = [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j].tolist(), pa.decimal128(38, 0))]
        yield pa.RecordBatch.from_arrays(columns, names=["i", "j", "s"])

    parts = vectors.select(_column(vectors, vector_col)).mapInArrow(run, "i int, j int, s decimal(38,0)")
    out = [[0] * width for _ in range(width)]
    for r in parts.groupBy("i", "j").agg(F.sum("s").alias("s")).collect():  # width squared rows
        out[r["i"]][r["j"]] = out[r["j"]][r["i"]] = int(r["s"])
    return out


def covariance(n: int, sums: list[int], centre: list[int], products: list[list[int]]):
    """The covariance matrix (divisor n), each entry rounded once."""
    import numpy as np

    d = [s - n * c for s, c in zip(sums, centre)]
    width = range(len(sums))
    return np.array([[float(Fraction(n * products[i][j] - d[i] * d[j], n * n)) for j in width] for i in width])


def inertia(v, shift: float) -> int:
    """Eigenvalues of the symmetric ``v`` above ``shift``: positive pivots of a
    symmetric elimination with 1x1 and 2x2 pivots."""
    import numpy as np

    a, above = v - shift * np.eye(len(v)), 0
    while len(a):
        diag = np.abs(np.diag(a))
        p = int(diag.argmax())
        off = np.abs(a - np.diag(np.diag(a)))
        r, s = np.unravel_index(int(off.argmax()), off.shape)
        if diag[p] >= 0.64 * off[r, s]:
            if diag[p] == 0:
                break  # what is left is zero
            rest = np.delete(np.arange(len(a)), p)
            above += a[p, p] > 0
            a = a[np.ix_(rest, rest)] - np.outer(a[rest, p], a[rest, p]) / a[p, p]
        else:
            pair = [r, s]
            rest = np.delete(np.arange(len(a)), pair)
            block = a[np.ix_(pair, pair)]
            above += int((np.linalg.eigvalsh(block) > 0).sum())
            b = a[np.ix_(rest, pair)]
            a = a[np.ix_(rest, rest)] - b @ np.linalg.solve(block, b.T)
            a = (a + a.T) / 2
    return int(above)


def intervals(v, k: int, most: int = 4) -> list[tuple[float, float, int]]:
    """[(low, high, eigenvalues)] that together hold the ``k`` largest ones
    above zero (more, if they cannot be told apart), each at most ``most``
    unless they lie closer than rounding."""
    import numpy as np

    low, high = float(np.diag(v).max()), float(np.abs(v).sum(axis=1).max())  # the largest eigenvalue lies between
    if not high > 0:
        return []
    while high - low > 1e-3 * high:
        middle = (low + high) / 2
        low, high = (low, middle) if inertia(v, middle) == 0 else (middle, high)
    high *= 1 + 1e-3
    zero = high * len(v) * 1e-14
    near = high * 1e-9

    def clear(a: float, b: float, want) -> tuple[float, int] | None:
        """A shift between a and b, not close to an eigenvalue, with a wanted count."""
        for _ in range(60):
            if b - a <= 4 * near:
                return None
            middle = (a * b) ** 0.5 if a > 0 and b > 4 * a else (a + b) / 2
            n = inertia(v, middle)
            if want(n) == 0 and inertia(v, middle - near) == n == inertia(v, middle + near):
                return middle, n
            if want(n) >= 0:
                b = middle
            else:
                a = middle
        return None

    k = min(k, inertia(v, zero))
    if not k:
        return []
    # want(n): 1 if the shift must go down (too few eigenvalues above it), -1 up
    edge = (
        clear(zero, high, lambda n: 1 if n < k else -1 if n > k else 0)
        or clear(zero, high, lambda n: 1 if n < k else -1 if n > 2 * k else 0)
        or (zero, inertia(v, zero))
    )

    def split(low: float, top: float, above_low: int, above_top: int) -> list:
        n = above_low - above_top
        if n <= most:
            return [(low, top, n)]
        half = above_top + n // 2
        cut = clear(low, top, lambda x: 1 if x < half else -1 if x > half else 0)
        if cut is None:
            return [(low, top, n)]
        return split(cut[0], top, cut[1], above_top) + split(low, cut[0], above_low, cut[1])

    return split(edge[0], high, edge[1], 0)


def contour(low: float, high: float, nodes: int = NODES) -> list[tuple[complex, complex]]:
    """(shift, weight) of Gauss-Legendre nodes on the upper half of the circle
    through ``low`` and ``high``; the lower half adds the conjugates."""
    import numpy as np

    at, weight = np.polynomial.legendre.leggauss(nodes)
    radius, middle = (high - low) / 2, (high + low) / 2
    turn = np.exp(1j * np.pi / 2 * (1 - at))
    return [(complex(middle + radius * t), complex(w * radius * t / 2)) for t, w in zip(turn, weight)]


def project(spark: SparkSession, v, blocks: list, jobs: list[tuple[int, complex, complex]]) -> list:
    """Sum of weight * (zI - V)^-1 Y over the shifts of each block, real part:
    one task solves one shifted system."""
    import numpy as np

    def solve(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for b, zr, zi, wr, wi in zip(*(c.to_pylist() for c in batch.columns)):
                x = np.linalg.solve(complex(zr, zi) * np.eye(len(v)) - v, blocks[b].astype(complex))
                q = (complex(wr, wi) * x).real
                yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([q.ravel().tolist()])], names=["block", "q"])

    rows = [(b, z.real, z.imag, w.real, w.imag) for b, z, w in jobs]
    shifts = spark.createDataFrame(rows, "block int, zr double, zi double, wr double, wi double").repartition(len(rows))
    out = [np.zeros_like(y) for y in blocks]
    for r in sorted(shifts.mapInArrow(solve, "block int, q array<double>").collect(), key=lambda r: (r["block"], r["q"])):
        out[r["block"]] += np.array(r["q"]).reshape(out[r["block"]].shape)
    return out


def leading_components(spark: SparkSession, v, k: int):
    """(eigenvalues falling, unit eigenvectors as columns) of the ``k`` largest
    eigenvalues of the covariance that are above zero."""
    import numpy as np

    parts = intervals(v, k)
    if not parts:
        return np.empty(0), np.empty((len(v), 0))
    scale, rng = max(high for _, high, _ in parts), np.random.RandomState(12)
    blocks = [rng.normal(size=(len(v), min(len(v), n + max(8, n)))) for _, _, n in parts]
    shifts = [contour(low, high) for low, high, _ in parts]
    done: dict[int, np.ndarray] = {}
    for sweep in range(SWEEPS):
        open_ = [b for b in range(len(parts)) if b not in done]
        if not open_:
            break
        jobs = [(i, z, w) for i, b in enumerate(open_) for z, w in shifts[b]]
        for b, q in zip(open_, project(spark, v, [blocks[b] for b in open_], jobs)):
            low, high, n = parts[b]
            q, _ = np.linalg.qr(q)
            ritz, turn = np.linalg.eigh(q.T @ v @ q)
            blocks[b] = y = q @ turn
            inside = (ritz > low) & (ritz < high)
            wrong = np.linalg.norm(v @ y - y * ritz, axis=0) / scale
            good = inside & (wrong <= RESIDUAL * max(10, len(v)))
            if good.sum() == n:  # as many as the inertia counts say
                done[b] = y[:, good]
            elif sweep % 5 == 4:  # another start, and wider
                more = min(len(v), 2 * y.shape[1])
                blocks[b] = np.concatenate([y, rng.normal(size=(len(v), more - y.shape[1]))], axis=1)
    if len(done) < len(parts):
        raise RuntimeError("the eigenvectors found are fewer than the inertia counts")
    # one last Rayleigh-Ritz step over all intervals makes the vectors orthogonal
    q, _ = np.linalg.qr(np.concatenate([done[b] for b in range(len(parts))], axis=1))
    ritz, turn = np.linalg.eigh(q.T @ v @ q)
    order = np.argsort(-ritz)[:k]
    return ritz[order], (q @ turn)[:, order]


class Whitening:
    """A fitted whitening: ``n``, ``sums``, ``values`` (eigenvalues), ``vectors``
    (unit columns) and ``trace``."""

    def __init__(self, spark: SparkSession, vectors: DataFrame, vector_col: str = "embedding", components: int = 8):
        import numpy as np

        self.vector_col, found = vector_col, vector_width(vectors, vector_col)
        self.width, self.n = found or (0, 0)
        self.sums = column_sums(vectors, vector_col, self.width) if found else []
        self.centre = [(2 * s + self.n) // (2 * self.n) for s in self.sums]
        if found:
            v = covariance(self.n, self.sums, self.centre, product_sums(vectors, vector_col, self.centre))
            self.trace = float(np.trace(v))
            self.values, self.vectors = leading_components(spark, v, components)
        else:
            self.trace, self.values, self.vectors = 0.0, np.empty(0), np.empty((0, 0))

    def _whitened(self, x):
        """x about the mean, projected and scaled: the whole-number part of the
        difference is exact."""
        import numpy as np

        rest = np.array([float(Fraction(s - self.n * c, self.n)) for s, c in zip(self.sums, self.centre)])
        return ((x - np.array(self.centre, np.int64)) - rest) @ self.vectors / np.sqrt(self.values)

    def _deviations(self, x) -> list[int]:
        """Sum over dimensions of (n x - S)^2, exact."""
        import numpy as np

        about = x - np.array(self.centre, np.int64)  # n x - S = n (x - c) - (S - n c)
        rest = [s - self.n * c for s, c in zip(self.sums, self.centre)]
        top = self.n * (int(np.abs(about).max(initial=0)) + 1)
        if top * top * self.width < 1 << 62:
            return ((self.n * about - np.array(rest, np.int64)) ** 2).sum(axis=1).tolist()
        return [sum((self.n * a - r) ** 2 for a, r in zip(row, rest)) for row in about.tolist()]

    def identity_error(self, vectors: DataFrame) -> float | None:
        """Largest absolute entry of the whitened vectors' covariance minus the
        identity, measured over all rows; None without components."""
        import numpy as np

        k = len(self.values)
        if not k:
            return None
        fit = self

        def run(batches: Iterator) -> Iterator:
            import pyarrow as pa

            z1, z2 = np.zeros(k), np.zeros((k, k))
            for batch in batches:
                z = fit._whitened(grid(batch.column(0), fit.width)[1])
                z1, z2 = z1 + z.sum(axis=0), z2 + z.T @ z
            both = np.concatenate([z1, z2.ravel()])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(both), dtype=np.int32)), pa.array(both)], names=["i", "s"])

        parts = vectors.select(_column(vectors, self.vector_col)).mapInArrow(run, "i int, s double")
        sums = np.zeros(k + k * k)
        for r in parts.groupBy("i").agg(F.sum("s").alias("s")).collect():
            sums[r["i"]] = r["s"]
        mean = sums[:k] / self.n
        return float(np.abs(sums[k:].reshape(k, k) / self.n - np.outer(mean, mean) - np.eye(k)).max())


def whiten(vectors: DataFrame, components: int = 8, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per vector and component: the id, component (from 1), n,
    deviation (decimal), whitened, explained and identity_error.

    Vectors that are null, empty, or hold null or non-finite entries take no
    part; of vectors of several widths those of the most frequent width do
    (the larger of equally many).  Components are those of eigenvalues above
    zero, so constant vectors, a single one or an empty table give no rows.
    A null id stays null, repeated rows count and are returned each on its own.
    Entries of 2**30 or more raise.  Other columns are not read.  The fit is
    over all vectors; a task holds one Arrow batch and a matrix of the width.
    """
    spark = vectors.sparkSession
    fit = Whitening(spark, vectors, vector_col, components)
    kind = vectors.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    k = len(fit.values)
    error = fit.identity_error(vectors)

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            rows, x = grid(batch.column(1), fit.width)
            if not k or not len(rows):
                continue
            z = fit._whitened(x)
            columns = [
                batch.column(0).take(pa.array(np.repeat(rows, k))),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
                pa.array(np.full(len(rows) * k, fit.n)),
                pa.array(fit._deviations(x), pa.decimal128(38, 0)).take(pa.array(np.repeat(np.arange(len(rows)), k))),
                pa.array(z.ravel()),
                pa.array(np.tile(fit.values / fit.trace, len(rows))),
                pa.array(np.full(len(rows) * k, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in schema.split(", ")])

    out = vectors.select(F.col(f"`{id_col}`").alias("id"), _column(vectors, vector_col)).mapInArrow(run, schema)
    return out.withColumnRenamed("id", id_col)

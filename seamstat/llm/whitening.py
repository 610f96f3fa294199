"""Embedding whitening by pivoted Cholesky and one-sided Jacobi.

One pass over the vectors gives their number, exact sums per dimension and the
scatter about the mean: a task centres each batch on the batch's own mean
before multiplying, and parts are joined by the mean difference of their exact
sums, so no large offset ever enters a product. The scatter (a square in the
number of dimensions, whatever the number of rows) is factored on the driver
by Cholesky with pivoting, and one-sided Jacobi rotations make the columns of
the triangular factor orthogonal: their squared norms are the eigenvalues and
the normalised columns the components. Every row is then projected where it
lies.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import for_workers, landed, read_table, without

SCALE = 1024
OFFSET = 100_000
COMPONENTS = 8
LARGEST = 1 << 40       # of a scaled component, without OFFSET
MERGED = 64             # partial moments joined by one task
ROWS = 8192             # vectors centred and multiplied at a time


def usable(vector: str):
    """Rows with a vector of non-null, finite components."""
    v = F.col(f"`{vector}`")
    return v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def scaled(column, scale: int = SCALE):
    """Rows of floor(scale * component) of an Arrow list column, exact in
    64-bit integers. Vectors of unlike lengths, and components whose scaled
    value reaches ``LARGEST``, raise an error."""
    import numpy as np

    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = np.diff(column.offsets.to_numpy())
    if len(sizes) and (sizes != sizes[0]).any():
        raise ValueError("vectors have different lengths")
    x = np.floor(flat * scale)
    if len(x) and np.abs(x).max() >= LARGEST:
        raise ValueError(f"a scaled component reaches {LARGEST}")
    return x.astype(np.int64).reshape(len(sizes), int(sizes[0]) if len(sizes) else 0)


@dataclass
class Moments:
    """Number, sums (exact integers, or floats) and scatter about the mean."""

    n: int = 0
    sums: list = field(default_factory=list)
    scatter: object = None

    def add(self, other: Moments) -> None:
        """Join the moments of other rows: the scatters, and the outer product
        of the difference of both means."""
        import numpy as np

        if not other.n:
            return
        if not self.n:
            self.n, self.sums, self.scatter = other.n, list(other.sums), other.scatter
            return
        if len(self.sums) != len(other.sums):
            raise ValueError("vectors have different lengths")
        # (other's mean - own mean) * n * other.n, without a rounded mean.
        gap = np.array([float(b * self.n - a * other.n) for a, b in zip(self.sums, other.sums, strict=True)])
        both = self.n + other.n
        self.scatter = self.scatter + other.scatter + np.outer(gap, gap) / (float(self.n) * other.n * both)
        self.n, self.sums = both, [a + b for a, b in zip(self.sums, other.sums, strict=True)]


def of_rows(rows) -> Moments:
    """Moments of the rows of an array of integers or floats."""
    import numpy as np

    out = Moments()
    for at in range(0, len(rows), ROWS):
        part = rows[at:at + ROWS]
        sums = part.sum(axis=0)
        centred = part - sums / len(part)
        out.add(Moments(len(part), [x.item() for x in sums], np.asarray(centred.T @ centred, np.float64)))
    return out


def _as_batch(bucket: int, m: Moments):
    """Sums travel as text, so that integers stay exact at any size."""
    import numpy as np
    import pyarrow as pa

    raw = b"" if m.scatter is None else np.ascontiguousarray(m.scatter, np.float64).tobytes()
    return pa.RecordBatch.from_arrays(
        [pa.array([bucket], pa.int64()), pa.array([m.n], pa.int64()),
         pa.array([[repr(s) for s in m.sums]], pa.list_(pa.string())), pa.array([raw], pa.binary())],
        ["bucket", "n", "sums", "scatter"])


def _joined(rows) -> Moments:
    """One ``Moments`` from (n, sums, scatter) rows."""
    import numpy as np

    out = Moments()
    for n, sums, raw in rows:
        d = len(sums)
        out.add(Moments(n, [float(s) if "." in s or "e" in s else int(s) for s in sums],
                        np.frombuffer(raw, np.float64).reshape(d, d)))
    return out


PARTIAL = "bucket long, n long, sums array<string>, scatter binary"


def moments(vectors: DataFrame, rows_of) -> Moments:
    """``Moments`` over all rows; ``rows_of`` turns an Arrow batch into an
    array of rows. Each task sends one partial result; these are joined in
    two steps of at most about ``MERGED`` a task, and as many reach the driver."""
    def per_task(batches):
        from pyspark import TaskContext

        m = Moments()
        for batch in batches:
            m.add(of_rows(rows_of(batch)))
        if m.n:
            yield _as_batch(TaskContext.get().partitionId(), m)

    def join(key, table):
        import pyarrow as pa

        m = _joined(zip(*(table.column(c).to_pylist() for c in ("n", "sums", "scatter")), strict=True))
        return pa.Table.from_batches([_as_batch(key[0].as_py(), m)])

    part = landed(vectors.mapInArrow(per_task, PARTIAL), "moments")
    for buckets in (MERGED * MERGED, MERGED):
        if part.count() > MERGED:
            part = landed(part.groupBy(F.pmod("bucket", F.lit(buckets)).alias("b")).applyInArrow(join, PARTIAL), "moments")
    return _joined((r["n"], r["sums"], r["scatter"]) for r in part.orderBy("bucket").collect())


def pivoted_cholesky(a, tolerance: float = 1e-13):
    """(factor, order): ``a[order][:, order] = factor @ factor.T`` with a lower
    trapezoidal factor of as many columns as ``a`` has rank. The largest
    remaining diagonal entry is the next pivot; it stops where that is below
    ``tolerance`` of the largest one (times the size)."""
    import numpy as np

    a = np.array(a, np.float64)
    d = len(a)
    order, factor = np.arange(d), np.zeros((d, d))
    diagonal = a.diagonal().copy()
    floor = tolerance * max(1, d) * (diagonal.max() if d else 0.0)
    for k in range(d):
        p = k + int(diagonal[k:].argmax())
        if not diagonal[p] > floor:
            return factor[:, :k], order
        for v in (order, diagonal):
            v[[k, p]] = v[[p, k]]
        factor[[k, p], :k] = factor[[p, k], :k]
        root = np.sqrt(diagonal[k])
        rest = slice(k + 1, d)
        factor[k, k] = root
        factor[rest, k] = (a[order[rest], order[k]] - factor[rest, :k] @ factor[k, :k]) / root
        diagonal[rest] -= factor[rest, k] ** 2
    return factor, order


def one_sided_jacobi(factor, sweeps: int = 40, tolerance: float = 1e-15):
    """Columns of ``factor`` rotated until all are orthogonal. The pairs of a
    sweep come in rounds of disjoint pairs, which are rotated together."""
    import numpy as np

    w = np.array(factor, np.float64).T.copy()       # a row is a column of the factor
    r = len(w)
    if r < 2:
        return w.T
    ring = np.arange(r + r % 2)
    for _ in range(sweeps):
        worst = 0.0
        for _ in range(len(ring) - 1):
            i, j = ring[:len(ring) // 2], ring[len(ring) // 2:][::-1]
            real = (i < r) & (j < r)
            i, j = i[real], j[real]
            x, y = w[i], w[j]
            xx, yy, xy = (x * x).sum(axis=1), (y * y).sum(axis=1), (x * y).sum(axis=1)
            size = np.sqrt(xx * yy)
            turn = np.abs(xy) > tolerance * size
            worst = max(worst, float((np.abs(xy) / np.where(size > 0, size, 1)).max()))
            if turn.any():
                i, j, x, y = i[turn], j[turn], x[turn], y[turn]
                z = (yy[turn] - xx[turn]) / (2 * xy[turn])
                t = np.where(z >= 0, 1.0, -1.0) / (np.abs(z) + np.sqrt(1 + z * z))
                c = 1 / np.sqrt(1 + t * t)
                s = c * t
                w[i], w[j] = c[:, None] * x - s[:, None] * y, s[:, None] * x + c[:, None] * y
            ring = np.concatenate([ring[:1], ring[-1:], ring[1:-1]])
        if worst <= tolerance * 10:
            break
    return w.T


@dataclass
class Whitener:
    """Fitted on all usable rows. ``components`` are columns by falling
    eigenvalue of the covariance (divisor n)."""

    n: int
    sums: list
    components: object
    eigenvalues: object
    trace: float
    scale: int = SCALE

    def centred(self, x):
        """(n * x - sums as exact integers, the same over n as doubles)."""
        import numpy as np

        reach = max(1, int(np.abs(x).max()) if x.size else 1) * self.n + max((abs(s) for s in self.sums), default=0)
        kind = np.int64 if reach < 1 << 62 else object
        exact = x.astype(kind) * self.n - np.array(self.sums, dtype=kind)
        return exact, np.asarray(exact, np.float64) / self.n

    def whiten(self, centred):
        import numpy as np

        return centred @ (self.components / np.sqrt(self.eigenvalues))


def fit(vectors: DataFrame, vector: str = "embedding", scale: int = SCALE, k: int = COMPONENTS) -> Whitener | None:
    """Whitener of the usable rows; None without one. At most ``k`` components,
    and no more than the covariance has rank: a direction in which the rows
    do not vary has no unit variance."""
    import numpy as np

    for_workers(vectors.sparkSession)
    m = moments(vectors.where(usable(vector)).select(F.col(f"`{vector}`").alias("v")),
                lambda batch: scaled(batch.column(0), scale))
    if not m.n:
        return None
    factor, order = pivoted_cholesky(m.scatter)
    turned = one_sided_jacobi(factor)
    norms = (turned * turned).sum(axis=0)
    first = np.argsort(-norms, kind="stable")[:k]
    components = np.zeros((len(order), len(first)))
    components[order] = turned[:, first] / np.sqrt(norms[first])
    trace = float(np.trace(m.scatter)) / m.n if m.sums else 0.0
    return Whitener(m.n, m.sums, components, norms[first] / m.n, trace, scale)


def identity_error(vectors: DataFrame, w: Whitener, vector: str = "embedding") -> float:
    """Largest absolute entry of the whitened rows' covariance less the
    identity, measured on all usable rows."""
    import numpy as np

    def rows(batch):
        return w.whiten(w.centred(scaled(batch.column(0), w.scale))[1])

    m = moments(vectors.where(usable(vector)).select(F.col(f"`{vector}`").alias("v")), rows)
    return float(np.abs(m.scatter / m.n - np.eye(len(m.sums))).max()) if m.sums else 0.0


def whiten(vectors: DataFrame, w: Whitener | None, vector: str = "embedding") -> DataFrame:
    """Usable rows with ``whitened`` (array of doubles, a component each) and
    ``deviation`` (exact sum of squares of n * x - sums, a decimal of 38
    digits; beyond those it is null).

    Rows whose vector is null or has a null or non-finite component are left
    out. Repeated rows, and rows with equal or null ids, are kept as they
    are. Vectors of unlike lengths raise an error. Input columns named like
    an output column are replaced. An empty table gives an empty result.
    """
    import decimal

    for_workers(vectors.sparkSession)
    own = without(vectors, "whitened", "deviation")
    columns, at = own.columns, own.columns.index(vector)
    schema = T.StructType([*own.schema.fields, T.StructField("whitened", T.ArrayType(T.DoubleType())),
                           T.StructField("deviation", T.DecimalType(38, 0))])

    def project(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for i in range(0, batch.num_rows if w is not None else 0, ROWS):
                part = batch.slice(i, ROWS)
                exact, centred = w.centred(scaled(part.column(at), w.scale))
                if exact.size and float(np.abs(centred).max()) * w.n >= 2 ** 31 / max(1, exact.shape[1]) ** 0.5:
                    exact = exact.astype(object)
                total = (exact * exact).sum(axis=1).tolist()
                total = [decimal.Decimal(t) if t < 10 ** 38 else None for t in total]
                y = w.whiten(centred)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(y) + 1) * y.shape[1], pa.int32()), pa.array(y.ravel()))
                yield pa.RecordBatch.from_arrays([*part.columns, lists, pa.array(total, pa.decimal128(38, 0))],
                                                 [*columns, "whitened", "deviation"])

    return own.where(usable(vector)).mapInArrow(project, schema)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per usable vector and component (no more components than the
    covariance has rank). A deviation beyond a long is null: squares of n
    outgrow 64 bits from some millions of vectors on."""
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    w = fit(vectors)
    out = whiten(vectors, w)
    error = identity_error(vectors, w) if w else 0.0
    parts = [float(e / w.trace) for e in w.eigenvalues] if w else []
    share = F.array(*[F.lit(p) for p in parts]) if parts else F.array().cast("array<double>")
    return (out.select("vec_id", F.expr("try_cast(deviation AS BIGINT)").alias("deviation"), F.posexplode("whitened"))
            .select("vec_id", (F.col("pos") + 1).alias("component"), F.lit(w.n if w else 0).cast("long").alias("n"),
                    "deviation", F.col("col").alias("whitened"),
                    F.get(share, F.col("pos")).alias("explained"), F.lit(error).alias("identity_error")))

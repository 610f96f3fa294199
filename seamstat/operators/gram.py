"""Cross moments of many columns in one pass, and all that follows from them.

``cross_moments`` reads the rows once: each task multiplies its own blocks
about their means (numpy on Arrow batches), partial results are joined pairwise
in few rows, and one square matrix in the number of columns reaches the driver,
whatever the number of rows. Standardisation and the ridge fits of every
target, feature subset and penalty are then small solves on that matrix; no
further pass over the rows is needed (MLO-06, MLO-07).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

JOINED = 64             # partial results joined by one task
BLOCK = 16_384          # rows multiplied at a time


@dataclass
class Moments:
    """Number of rows, means, and scatter about the means, by column."""

    columns: list[str]
    n: int
    mean: object
    scatter: object

    def at(self, cols: Sequence[str]) -> list[int]:
        place = {c: i for i, c in enumerate(self.columns)}
        return [place[c] for c in cols]

    def scale(self, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
        """Mean and population deviation; a zero deviation is read as 1."""
        out = {}
        for c, i in zip(cols, self.at(cols), strict=True):
            s = float((self.scatter[i, i] / self.n) ** 0.5) if self.n else 0.0
            out[c] = (float(self.mean[i]), s if s > 0 else 1.0)
        return out


def _join(parts):
    """Moments of all rows from (n, mean, scatter) of disjoint rows."""
    import numpy as np

    n, mean, scatter = 0, None, None
    for m, own, own_scatter in parts:
        if not m:
            continue
        if not n:
            n, mean, scatter = m, own.copy(), own_scatter.copy()
            continue
        gap, both = own - mean, n + m
        scatter += own_scatter + np.outer(gap, gap) * (n / both * m)
        mean += gap * (m / both)
        n = both
    return n, mean, scatter


PARTIAL = "part long, n long, mean binary, scatter binary"


def _partial(part: int, n, mean, scatter):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays(
        [pa.array([part], pa.int64()), pa.array([n], pa.int64()), pa.array([mean.tobytes()], pa.binary()),
         pa.array([scatter.tobytes()], pa.binary())], ["part", "n", "mean", "scatter"])


def _parts(rows, d: int):
    import numpy as np

    for n, mean, scatter in rows:
        yield n, np.frombuffer(mean).copy(), np.frombuffer(scatter).reshape(d, d).copy()


def cross_moments(df: DataFrame, cols: Sequence[str]) -> Moments:
    """One pass over ``cols`` (numeric, without nulls; see ``impute_zero``)."""
    import numpy as np

    cols = list(cols)
    d = len(cols)

    def per_task(batches):
        from pyspark import TaskContext

        def blocks():
            for batch in batches:
                for at in range(0, batch.num_rows, BLOCK):
                    part = batch.slice(at, BLOCK)
                    x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in part.columns]).astype(np.float64)
                    mean = x.mean(axis=0)
                    x -= mean
                    yield len(x), mean, x.T @ x

        n, mean, scatter = _join(blocks())
        if n:
            yield _partial(TaskContext.get().partitionId(), n, mean, scatter)

    def join(table):
        import pyarrow as pa

        rows = table.select(["n", "mean", "scatter"]).to_pylist()
        out = _join(_parts([(r["n"], r["mean"], r["scatter"]) for r in rows], d))
        return pa.Table.from_batches([_partial(0, *out)])

    part = df.select(*[F.col(f"`{c}`").cast("double") for c in cols]).mapInArrow(per_task, PARTIAL)
    part = part.groupBy(F.pmod("part", F.lit(JOINED)).alias("g")).applyInArrow(join, PARTIAL)
    n, mean, scatter = _join(_parts([(r["n"], r["mean"], r["scatter"]) for r in part.collect()], d))
    if not n:
        mean, scatter = np.zeros(d), np.zeros((d, d))
    return Moments(cols, n, mean, scatter)


@dataclass
class Ridge:
    """``intercept + sum(coefficient * (x - mean) / deviation)``."""

    features: list[str]
    scale: dict[str, tuple[float, float]]
    coefficients: list[float]
    intercept: float

    def predict(self) -> Column:
        """The prediction as one built-in expression over the raw columns."""
        out = F.lit(self.intercept)
        for c, w in zip(self.features, self.coefficients, strict=True):
            m, s = self.scale[c]
            out = out + F.lit(w) * ((F.col(f"`{c}`") - F.lit(m)) / F.lit(s))
        return out


def ridge(m: Moments, features: Sequence[str], target: str, alpha: float = 1.0) -> Ridge:
    """Ridge on population-standardised features with an unpenalised
    intercept: ``(Z'Z + alpha I) w = Z'(y - mean y)``, from the moments alone."""
    import numpy as np

    features = list(features)
    scale = m.scale(features)
    if not m.n or not features:
        return Ridge(features, scale, [0.0] * len(features), float(m.mean[m.at([target])[0]]) if m.n else 0.0)
    i, (t,) = m.at(features), m.at([target])
    dev = np.array([scale[c][1] for c in features])
    a = m.scatter[np.ix_(i, i)] / np.outer(dev, dev) + alpha * np.eye(len(i))
    w = np.linalg.solve(a, m.scatter[i, t] / dev)
    return Ridge(features, scale, [float(x) for x in w], float(m.mean[t]))


def ridge_all(m: Moments, features: Sequence[str], targets: Sequence[str], alpha: float = 1.0) -> dict[str, Ridge]:
    return {t: ridge(m, features, t, alpha) for t in targets}

"""Boosted trees of depth one from joint counts, exact in integers
(MLO-04, MLO-05, MLO-08).

A sum of depth-one trees changes a row's residual by amounts that depend on
one bin of one feature each. So the residual sum of every bin after any number
of rounds follows from the first round's sums and from how many rows two bins
share. ``joint_counts`` collects both in one pass (a matrix of bins by bins,
whatever the number of rows); every boosting round, and every setting of the
learning rate, number of rounds and least leaf size, then runs on that matrix
without touching the rows again. Folds are counted in the same pass, so a grid
search with cross-validation is one pass too.

Targets and leaf values are whole multiples of ``1 / UNIT``; sums are exact
integers, so a fit is the same for any order or split of the rows. The
objective is squared error with a second-order penalty: a leaf is
``rate * G / (n + penalty)`` and a split's gain
``GL^2/(nL + p) + GR^2/(nR + p) - G^2/(n + p)``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNIT = 1_000_000
PENALTY = 1.0
BINS = 256              # thresholds a feature at most; beyond, by quantiles
JOINED = 8              # groups of partial counts of a fold that are joined side by side


def _less_than(x: Column):
    return lambda v: v < x


@dataclass
class Bins:
    """Upper bounds of the bins of each feature; the last bin has none."""

    features: list[str]
    bounds: list[list[float]]

    @property
    def sizes(self) -> list[int]:
        return [len(b) + 1 for b in self.bounds]

    def codes(self) -> list[Column]:
        """Bin number of each feature: how many bounds lie below the value
        (null reads as 0, as training does)."""
        out = []
        for f, bounds in zip(self.features, self.bounds, strict=True):
            x = F.coalesce(F.col(f"`{f}`").cast("double"), F.lit(0.0))
            b = F.array(*[F.lit(v) for v in bounds]) if bounds else F.array().cast("array<double>")
            out.append(F.size(F.filter(b, _less_than(x))).alias(f"b_{len(out)}"))
        return out


def make_bins(df: DataFrame, features: Sequence[str], bins: int = BINS) -> Bins:
    """Every distinct value is a threshold while there are at most ``bins``
    of them, else approximate quantiles are; one aggregate for all features."""
    features = list(features)
    x = [F.coalesce(F.col(f"`{f}`").cast("double"), F.lit(0.0)) for f in features]
    if df.isEmpty():
        return Bins(features, [[] for _ in features])
    # A distinct count first, so that no set of values grows with the rows.
    few = df.agg(*[F.approx_count_distinct(c).alias(f"n{i}") for i, c in enumerate(x)]).first()
    aggs = [F.array_sort(F.collect_set(c)) if few[i] <= bins else
            F.array_sort(F.array_distinct(F.percentile_approx(c, [k / bins for k in range(1, bins)], 10_000)))
            for i, c in enumerate(x)]
    row = df.agg(*[a.alias(f"v{i}") for i, a in enumerate(aggs)]).first()
    bounds = []
    for i in range(len(features)):
        values = list(row[i] or [])
        bounds.append(values[:-1] if few[i] <= bins else values)
    return Bins(features, bounds)


@dataclass
class Counts:
    """Of a set of rows: bins by bins, rows in common; by target, the sums of
    every bin, the whole sum and the sum of squares; number of rows."""

    sizes: list[int]
    targets: list[str]
    joint: object
    sums: object
    n: int
    total: list[int]
    square: list[int]

    def __add__(self, other: Counts) -> Counts:
        def add(x, y):
            return [a + b for a, b in zip(x, y, strict=True)]
        return Counts(self.sizes, self.targets, self.joint + other.joint, self.sums + other.sums, self.n + other.n,
                      add(self.total, other.total), add(self.square, other.square))

    def of(self, features: Sequence[int]) -> Counts:
        """The same rows, some features (in this order)."""
        import numpy as np

        starts = np.concatenate([[0], np.cumsum(self.sizes)])
        at = np.concatenate([np.zeros(0, np.int64), *(np.arange(starts[f], starts[f + 1]) for f in features)]).astype(np.int64)
        return Counts([self.sizes[f] for f in features], self.targets, self.joint[np.ix_(at, at)], self.sums[:, at], self.n,
                      self.total, self.square)


def joint_counts(df: DataFrame, bins: Bins, targets: Sequence[str], folds: Column | None = None) -> dict[int, Counts]:
    """``Counts`` of every fold (one fold, 0, by default) in one pass, for all
    targets. The matrix is square in the number of bins; a target in units
    must fit 53 bits, a fold 2^31 rows."""
    import numpy as np

    targets, sizes = list(targets), bins.sizes
    starts = np.concatenate([[0], np.cumsum(sizes)])
    width, d, k = int(starts[-1]), len(sizes), len(targets)
    ys = [F.coalesce(F.rint(F.col(f"`{t}`").cast("double") * UNIT), F.lit(0.0)).cast("long").alias(f"y_{i}")
          for i, t in enumerate(targets)]
    rows = df.select(*bins.codes(), *ys, (folds if folds is not None else F.lit(0)).cast("int").alias("fold"))
    step = max(64, min(4096, (1 << 23) // max(1, width)))

    def count(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        found: dict[int, list] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                column = [c.to_numpy(zero_copy_only=False) for c in part.columns]
                code = [c.astype(np.int64) + starts[i] for i, c in enumerate(column[:d])]
                for f in np.unique(column[-1]).tolist():
                    own = np.flatnonzero(column[-1] == f)
                    hot = np.zeros((len(own), width), np.float32)
                    for c in code:
                        hot[np.arange(len(own)), c[own]] = 1
                    have = found.setdefault(f, [np.zeros((width, width), np.int32), np.zeros((k, width), np.int64), 0,
                                                [0] * k, [0] * k])
                    # Sums of at most 4096 ones are exact in 32-bit floats.
                    have[0] += (hot.T @ hot).astype(np.int32)
                    have[2] += len(own)
                    for t, y in enumerate(column[d:d + k]):
                        for c in code:
                            np.add.at(have[1][t], c[own], y[own])
                        values = y[own].tolist()
                        have[3][t] += sum(values)
                        have[4][t] += sum(v * v for v in values)
        for f, (joint, sums, n, total, square) in found.items():
            yield batch_of(TaskContext.get().partitionId(), f, Counts(sizes, targets, joint, sums, n, total, square))

    def batch_of(part, fold, c):
        import pyarrow as pa

        texts = pa.list_(pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int64()), pa.array([fold], pa.int32()),
             pa.array([pa.compress(np.ascontiguousarray(c.joint, np.int32).tobytes(), "zstd", asbytes=True)], pa.binary()),
             pa.array([c.sums.tobytes()], pa.binary()), pa.array([c.n], pa.int64()),
             pa.array([[str(v) for v in c.total]], texts), pa.array([[str(v) for v in c.square]], texts)],
            ["part", "fold", "joint", "sums", "n", "total", "square"])

    def read(r) -> Counts:
        import pyarrow as pa

        raw = pa.decompress(bytes(r["joint"]), 4 * width * width, "zstd", asbytes=True)
        return Counts(sizes, targets, np.frombuffer(raw, np.int32).reshape(width, width),
                      np.frombuffer(r["sums"], np.int64).reshape(k, width), r["n"],
                      [int(v) for v in r["total"]], [int(v) for v in r["square"]])

    def join(table):
        import pyarrow as pa

        out = None
        for i in range(table.num_rows):
            r = table.slice(i, 1).to_pylist()[0]
            out = read(r) if out is None else out + read(r)
        return pa.Table.from_batches([batch_of(0, r["fold"], out)])

    schema = ("part long, fold int, joint binary, sums binary, n long, total array<string>, square array<string>")
    part = rows.mapInArrow(count, schema).groupBy("fold", F.pmod("part", F.lit(JOINED)).alias("g")).applyInArrow(join, schema)
    return {r["fold"]: read(r) for r in part.groupBy("fold").applyInArrow(join, schema).collect()}


@dataclass
class Stumps:
    """``base + sum of the trees`` in units of ``1 / UNIT``. A tree is
    (feature number, bin up to which the left value holds, left, right)."""

    bins: Bins
    base: int
    trees: list[tuple[int, int, int, int]] = field(default_factory=list)
    gains: list[float] = field(default_factory=list)

    def importances(self) -> list[float]:
        """Average gain of each feature's splits, over the sum of these."""
        d = len(self.bins.features)
        total, count = [0.0] * d, [0] * d
        for (f, *_), g in zip(self.trees, self.gains, strict=True):
            total[f] += g
            count[f] += 1
        mean = [t / n if n else 0.0 for t, n in zip(total, count, strict=True)]
        whole = sum(mean)
        return [m / whole if whole else 0.0 for m in mean]

    def values(self) -> list[list[int]]:
        """The sum of all trees, by feature and bin."""
        out = [[0] * n for n in self.bins.sizes]
        for f, at, left, right in self.trees:
            for b in range(len(out[f])):
                out[f][b] += left if b <= at else right
        return out

    def predict(self, codes: Mapping[str, Column] | None = None) -> Column:
        """The prediction as one built-in expression: a table lookup a
        feature that some tree uses, however many trees there are. ``codes``
        are the features' bin numbers where they are columns already."""
        units, used = F.lit(self.base).cast("long"), {f for f, *_ in self.trees}
        own = self.bins.codes() if codes is None else [codes[f] for f in self.bins.features]
        for f, (code, v) in enumerate(zip(own, self.values(), strict=True)):
            if f in used:
                units = units + F.element_at(F.array(*[F.lit(x).cast("long") for x in v]), code + 1)
        return units.cast("double") / F.lit(float(UNIT))


def boost(c: Counts, bins: Bins, rounds: int = 200, rate: float = 0.05, least: int = 1, penalty: float = PENALTY,
          target: int = 0, seen=None) -> Stumps:
    """``rounds`` trees for a target (its number) on the counted rows. The best gain wins; ties go to
    the first feature, then to the lowest threshold; a round without a gain
    ends the fit. ``seen`` is called with the model after every round."""
    import numpy as np

    sizes = np.array(c.sizes)
    starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    feature = np.repeat(np.arange(len(sizes)), sizes)
    last = np.zeros(len(feature), bool)
    last[starts + sizes - 1] = True
    rows = c.joint.diagonal().astype(np.int64)

    def upto(v):
        whole = np.cumsum(v)
        return whole - np.concatenate([[0], whole])[starts][feature]

    left_n = upto(rows)
    right_n = c.n - left_n
    may = ~last & (left_n >= least) & (right_n >= least)
    base = c.total[target] // c.n if c.n else 0
    g = c.sums[target] - base * rows
    model = Stumps(bins, int(base))
    left_w, right_w, all_w = left_n + penalty, right_n + penalty, float(c.n) + penalty
    # Rows of each bin that lie in a feature's bins up to b: one matrix, made once.
    below = np.cumsum(c.joint.T, axis=0, dtype=np.int64)
    ahead = np.concatenate([np.zeros((1, len(rows)), np.int64), below])[starts]
    for _ in range(rounds if may.any() else 0):
        left = upto(g)
        whole = int(left[starts[0] + sizes[0] - 1])
        lf, rf = left.astype(np.float64), (whole - left).astype(np.float64)
        gain = lf * lf / left_w + rf * rf / right_w - float(whole) * float(whole) / all_w
        gain[~may] = -np.inf
        k = int(gain.argmax())
        if not gain[k] > 0:
            break
        wl = int(np.floor(rate * lf[k] / left_w[k]))
        wr = int(np.floor(rate * rf[k] / right_w[k]))
        in_left = below[k] - ahead[feature[k]]
        g = g - wl * in_left - wr * (rows - in_left)
        model.trees.append((int(feature[k]), int(k - starts[feature[k]]), wl, wr))
        model.gains.append(float(gain[k]))
        if seen is not None:
            seen(model)
    return model


def squared_error(c: Counts, model: Stumps, target: int = 0) -> float:
    """Sum of squared errors on counted rows, in target units squared."""
    import numpy as np

    v = np.array([x for own in model.values() for x in own], np.float64) / UNIT
    sums, total, base = c.sums[target] / UNIT, c.total[target] / UNIT, model.base / UNIT
    # Errors about the base, so that a large mean does not cancel.
    own = c.square[target] / UNIT ** 2 - 2 * base * total + base * base * c.n
    rows = c.joint.diagonal()
    return float(own - 2 * (v @ (sums - base * rows)) + v @ (c.joint @ v))


def grid_search(folds: Mapping[int, Counts], bins: Bins, rounds: Sequence[int], rates: Sequence[float],
                leasts: Sequence[int], penalty: float = PENALTY, target: int = 0) -> list[dict]:
    """Mean R^2 over the folds of every setting, from the counts alone. A fit
    of the most rounds is also the fit of every smaller number, so each (rate,
    least, fold) is fitted once and scored on the way."""
    marks, out = sorted(set(rounds)), {}
    for rate in rates:
        for least in leasts:
            for f in folds:
                rest = [folds[x] for x in folds if x != f]
                if not rest:
                    continue
                train = rest[0]
                for x in rest[1:]:
                    train = train + x
                held, scores = folds[f], {}

                def note(model, held=held, scores=scores):
                    if len(model.trees) in marks:
                        scores[len(model.trees)] = squared_error(held, model, target)

                model = boost(train, bins, marks[-1], rate, least, penalty, target, note)
                final = squared_error(held, model, target)
                spread = (held.square[target] - held.total[target] ** 2 / held.n) / UNIT ** 2
                for r in marks:
                    error = scores.get(r, final)
                    out.setdefault((r, rate, least), []).append(1 - error / spread if spread > 0 else None)
    return [{"n_estimators": r, "learning_rate": rate, "min_child_weight": least,
             "r2": sum(v) / len(v) if all(x is not None for x in v) else None}
            for (r, rate, least), v in out.items()]

"""Ridge from cross moments and depth-one boosting from joint counts."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from seamstat.operators import gram as G
from seamstat.operators import stumps as ST


@pytest.fixture(scope="module")
def table():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 3)) * [1, 100, 1e-3] + [1e6, -5, 0]
    y = x @ [0.5, -2.0, 900.0] + 4.0 + rng.normal(size=300)
    return x, np.column_stack([y, 3 * y + rng.normal(size=300)])


@pytest.fixture(scope="module")
def frame(spark, table):
    x, y = table
    rows = [(*map(float, a), *map(float, b)) for a, b in zip(x, y, strict=True)]
    return spark.createDataFrame(rows, "a double, b double, c double, y double, z double").repartition(5)


def test_moments_of_all_columns(frame, table):
    m = G.cross_moments(frame, ["a", "b", "c", "y", "z"])
    both = np.column_stack(table)
    centred = both - both.mean(axis=0)
    assert m.n == 300 and np.allclose(m.mean, both.mean(axis=0), rtol=1e-12)
    assert np.allclose(m.scatter, centred.T @ centred, rtol=1e-7, atol=1e-6)


def test_ridge_of_every_target_and_subset(frame, table):
    x, y = table
    m = G.cross_moments(frame, ["a", "b", "c", "y", "z"])
    for t, name in enumerate(("y", "z")):
        for cols in (["a", "b", "c"], ["c", "a"], ["b"]):
            for alpha in (1.0, 50.0):
                own = x[:, ["abc".index(c) for c in cols]]
                zs = (own - own.mean(axis=0)) / own.std(axis=0)
                yc = y[:, t] - y[:, t].mean()
                w = np.linalg.solve(zs.T @ zs + alpha * np.eye(len(cols)), zs.T @ yc)
                fit = G.ridge(m, cols, name, alpha)
                assert np.allclose(fit.coefficients, w, rtol=1e-6) and np.isclose(fit.intercept, y[:, t].mean())
    pred = G.ridge(m, ["a", "b", "c"], "y")
    got = sorted(r[0] for r in frame.select(pred.predict()).collect())
    zs = (x - x.mean(axis=0)) / x.std(axis=0)
    assert np.allclose(got, np.sort(zs @ np.array(pred.coefficients) + pred.intercept))


def test_moments_of_no_rows_and_constant_columns(spark):
    df = spark.createDataFrame([(1.0, 5.0, 2.0), (3.0, 5.0, 4.0)], "a double, b double, y double")
    m = G.cross_moments(df, ["a", "b", "y"])
    assert m.scale(["a", "b"]) == {"a": (2.0, 1.0), "b": (5.0, 1.0)}
    assert G.ridge(m, ["b"], "y").coefficients == [0.0]
    none = G.cross_moments(df.limit(0), ["a", "b", "y"])
    assert none.n == 0 and G.ridge(none, ["a"], "y").intercept == 0.0


def test_all_targets_take_one_pass(spark, frame):
    """The number of jobs does not follow the targets."""
    sc, jobs = spark.sparkContext, set()
    for targets in (["y"], ["y", "z", "b", "c"]):
        group = f"gram-{len(targets)}"
        sc.setJobGroup(group, "")
        m = G.cross_moments(frame, ["a", *targets])
        G.ridge_all(m, ["a"], targets)
        sc.setLocalProperty("spark.jobGroup.id", None)
        jobs.add(len(sc.statusTracker().getJobIdsForGroup(group)))
    assert len(jobs) == 1 and jobs.pop() <= 3


def plain_boost(x, y, rounds, rate, least=1, penalty=1.0):
    """Row by row: the best split of the residuals over all features and all
    distinct values, again and again. Integers throughout."""
    n, d = x.shape
    y = [int(v) for v in y]
    base = sum(y) // n
    p, trees, gains = [base] * n, [], []
    for _ in range(rounds):
        best = None
        for f in range(d):
            for v in sorted(set(x[:, f]))[:-1]:
                left = [i for i in range(n) if x[i, f] <= v]
                if not least <= len(left) <= n - least:
                    continue
                gl, g = sum(y[i] - p[i] for i in left), sum(y[i] - p[i] for i in range(n))
                wl, wr, wa = len(left) + penalty, n - len(left) + penalty, n + penalty
                lf, rf, af = float(gl), float(g - gl), float(g)
                gain = lf * lf / wl + rf * rf / wr - af * af / wa
                if gain > 0 and (best is None or gain > best[0]):
                    best = (gain, f, v, int(np.floor(rate * lf / wl)), int(np.floor(rate * rf / wr)))
        if best is None:
            break
        gain, f, v, wl, wr = best
        trees.append((f, v, wl, wr))
        gains.append(gain)
        p = [q + (wl if x[i, f] <= v else wr) for i, q in enumerate(p)]
    return base, trees, gains, p


@pytest.fixture(scope="module")
def small(spark):
    rng = np.random.default_rng(9)
    x = np.column_stack([rng.integers(0, 6, 60), rng.integers(0, 4, 60), rng.normal(size=60).round(1)]).astype(float)
    y = (x[:, 0] * 3 + (x[:, 1] > 1) * 5 + rng.normal(size=60)).round(2)
    rows = [(i, *map(float, a), float(b)) for i, (a, b) in enumerate(zip(x, y, strict=True))]
    return x, y, spark.createDataFrame(rows, "id int, a double, b double, c double, y double").repartition(4)


@pytest.mark.parametrize("rounds,rate,least", [(40, 0.1, 1), (25, 0.5, 7), (1, 1.0, 30), (5, 0.05, 31)])
def test_trees_equal_the_row_by_row_fit(small, rounds, rate, least):
    x, y, df = small
    bins = ST.make_bins(df, ["a", "b", "c"])
    assert [len(b) + 1 for b in bins.bounds] == [len(set(x[:, k])) for k in range(3)]
    model = ST.boost(ST.joint_counts(df, bins, ["y"])[0], bins, rounds, rate, least)
    base, trees, gains, p = plain_boost(x, np.rint(y * ST.UNIT), rounds, rate, least)
    assert model.base == base and model.gains == gains
    assert [(f, bins.bounds[f][k], wl, wr) for f, k, wl, wr in model.trees] == trees
    got = {r["id"]: r["p"] for r in df.select("id", model.predict().alias("p")).collect()}
    assert [got[i] for i in range(len(p))] == [v / ST.UNIT for v in p]


def test_grid_search_equals_fits_on_the_rows(small):
    x, y, df = small
    bins = ST.make_bins(df, ["a", "b", "c"])
    folds = ST.joint_counts(df, bins, ["y"], F.col("id") % 3)
    assert sorted(folds) == [0, 1, 2] and sum(c.n for c in folds.values()) == 60
    rows = ST.grid_search(folds, bins, [3, 12], [0.1, 0.3], [1, 5])
    assert len(rows) == 8
    units = np.rint(y * ST.UNIT)
    for r in rows:
        want = []
        for f in range(3):
            held = np.arange(60) % 3 == f
            base, trees, _, _ = plain_boost(x[~held], units[~held], r["n_estimators"], r["learning_rate"], r["min_child_weight"])
            p = np.full(held.sum(), float(base))
            for c, v, wl, wr in trees:
                p += np.where(x[held, c] <= v, wl, wr)
            e = units[held] - p
            want.append(1 - (e * e).sum() / ((units[held] - units[held].mean()) ** 2).sum())
        assert abs(r["r2"] - np.mean(want)) < 1e-9


def test_importances_and_unseen_values(spark, small):
    x, y, df = small
    bins = ST.make_bins(df, ["a", "b", "c"])
    model = ST.boost(ST.joint_counts(df, bins, ["y"])[0], bins, 30, 0.2)
    imp = model.importances()
    assert abs(sum(imp) - 1) < 1e-12 and imp[0] == max(imp)
    odd = spark.createDataFrame([(0, -9.0, None, 99.0), (1, 2.5, 1.0, None)], "id int, a double, b double, c double")
    assert all(r[0] is not None for r in odd.select(model.predict()).collect())


def test_many_values_become_quantiles(spark):
    df = spark.range(5000).select((F.col("id") * 7 % 5000).cast("double").alias("a"), F.lit(2.0).alias("b"),
                                  (F.col("id") * 7 % 5000 > 2500).cast("double").alias("y"))
    bins = ST.make_bins(df, ["a", "b"], bins=16)
    assert 10 <= len(bins.bounds[0]) <= 16 and bins.bounds[1] == []
    model = ST.boost(ST.joint_counts(df, bins, ["y"])[0], bins, 10, 0.5)
    assert model.trees and {f for f, *_ in model.trees} == {0}


def test_no_rows(spark):
    df = spark.createDataFrame([], "a double, y double")
    bins = ST.make_bins(df, ["a"])
    assert ST.joint_counts(df, bins, ["y"]) == {}

import numpy as np
from pyspark.sql import functions as F

from seamstat.operators import modeling as M


def test_ridge_matches_closed_form(spark):
    rng = np.random.default_rng(3)
    X = rng.normal(size=(200, 3))
    y = X @ np.array([1.5, -2.0, 0.5]) + 4.0 + rng.normal(scale=0.3, size=200)
    rows = [(i, 2000 + i % 5, *map(float, X[i]), float(y[i])) for i in range(200)]
    df = spark.createDataFrame(rows, "player_id bigint, season int, a double, b double, c double, y double")
    st = M.standardize_stats(df, ["a", "b", "c"])
    z = M.standardize(df, st, "__z")
    model = M.fit_ridge(z, ["a__z", "b__z", "c__z"], "y", alpha=1.0)
    Xs = (X - X.mean(0)) / X.std(0)
    Xc, yc = Xs - Xs.mean(0), y - y.mean()
    w = np.linalg.solve(Xc.T @ Xc + 1.0 * np.eye(3), Xc.T @ yc)
    assert np.allclose(model.coefficients.toArray(), w, atol=1e-6)
    assert abs(model.intercept - (y.mean() - Xs.mean(0) @ w)) < 1e-6


def test_standardize_zero_variance(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    st = M.standardize_stats(df, ["a", "b"])
    assert st["a"] == (2.0, 1.0) and st["b"] == (5.0, 1.0)


def test_blend_tie_takes_smaller_weight_b32(spark):
    df = spark.createDataFrame([(1.0, 1.0, 1.0), (2.0, 2.0, 2.0), (4.0, 4.0, 4.0)], "y double, a double, b double")
    r = M.best_blend(df, "y", "a", "b").first()
    assert r["best_weight"] == 0.0 and r["r2"] == 1.0


def test_blend_interior(spark):
    df = spark.createDataFrame([(float(v), float(v) - 1, float(v) + 1) for v in range(10)], "y double, a double, b double")
    assert M.best_blend(df, "y", "a", "b").first()["best_weight"] == 0.5


def test_year_pairs_b31(spark):
    from seamstat.operators.joins import year_pairs
    df = spark.createDataFrame([(1, 2019, 1.0), (1, 2020, 2.0), (1, 2022, 3.0)], "player_id bigint, season int, x double")
    rows = year_pairs(df, ["x"], "player_id").collect()
    assert [(r["season"], r["next_x"]) for r in rows] == [(2019, 2.0)]


def test_season_bounds_b30(spark):
    from seamstat.operators.aggs import season_bounds
    mk = lambda lo, hi: spark.createDataFrame([(s,) for s in range(lo, hi + 1)], "season int")
    r = season_bounds({"a": (mk(2015, 2025), F.col("season")), "b": (mk(2016, 2025), F.col("season")),
                       "c": (mk(2015, 2024), F.col("season"))}).first()
    assert (r["first_season"], r["latest_season"], r["projection_season"]) == (2016, 2024, 2025)


def test_impute_zero(spark):
    df = spark.createDataFrame([(None,), (float("inf"),), (float("nan"),), (2.0,)], "x double")
    assert [r["x"] for r in M.impute_zero(df, ["x"]).collect()] == [0.0, 0.0, 0.0, 2.0]


def test_scores(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 2.0), (3.0, 2.5)], "y double, p double")
    r = M.regression_scores(df, "y", "p").first()
    assert abs(r["mae"] - 1 / 3) < 1e-12 and abs(r["r2"] - (1 - 0.5 / 2.0)) < 1e-12

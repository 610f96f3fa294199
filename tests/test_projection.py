"""The projection flow of both roles on the feature matrices."""
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from seamstat.functions import codes as K
from seamstat.operators import ensemble as E
from seamstat.plans import testdata as T

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


@pytest.fixture(scope="module", params=["hitter", "pitcher"])
def run(request, spark):
    from seamstat.plans.projection_queries import _projection
    metrics, out, members, grid = _projection(spark, SF, request.param)
    return request.param, metrics.collect(), out, members, grid


def test_rows_teams_and_names(run, spark):
    role, _, out, _, _ = run
    import duckdb
    con = duckdb.connect()
    for t in ("supplier", "lineitem", "orders"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    from seamstat.plans.queries import ORACLE
    matrix = ORACLE["q_hitter_features" if role == "hitter" else "q_pitcher_features"]
    want = con.execute(f"""
        SELECT m.player_id, m.season + 1, 'H' || CAST(s.s_nationkey % 5 + 1 AS VARCHAR), s.s_name
        FROM ({matrix}) m JOIN supplier s ON s.s_suppkey = m.player_id
        WHERE m.season = (SELECT max(season) FROM ({matrix}))""").fetchall()
    rows = out.collect()
    assert sorted((r["player_id"], r["season"], r["team"], r["full_name"]) for r in rows) == sorted(want) and rows


def test_columns_are_rounded(run):
    role, _, out, members, _ = run
    targets, digits = (K.HITTER_TARGETS, K.HITTER_TARGET_DIGITS) if role == "hitter" else \
        (K.PITCHER_TARGETS, K.PITCHER_TARGET_DIGITS)
    assert [m.target for m in members] == [f"next_{t}" for t in targets]
    for r in out.collect():
        for t in targets:
            assert r[f"{t}_proj"] == round(r[f"{t}_proj"], digits[t])
        if role == "pitcher":
            den = r["bb_proj"] if r["bb_proj"] else 1
            assert r["k_bb_proj"] == np.round(r["k_proj"] / den, 2)


def test_whole_grid_and_all_rounds(run):
    _, metrics, _, members, grid = run
    assert len(grid) == 18 and {g["n_estimators"] for g in grid} == {200, 400}
    best = E.best_setting(grid)
    for m, r in zip(members, metrics, strict=True):
        assert 0 <= m.weight <= 1 and m.features and r["mae"] is not None
        assert len(m.trees.trees) == best["n_estimators"]


def test_scores_follow_from_the_members(run, spark):
    """Blend weight, R^2 and error recomputed from the members' own scores."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(120, 2)).round(2)
    y = (x[:, 0] * 2 + (x[:, 1] > 0) + rng.normal(size=120) * 0.1).round(3)
    df = spark.createDataFrame([(i, i % 5, *map(float, a), float(b)) for i, (a, b) in enumerate(zip(x, y))],
                               "player_id long, season int, a double, b double, next_y double").repartition(3)
    members, grid, best = E.fit(df, ["a", "b"], ["next_y"], grid={"n_estimators": [5, 20], "learning_rate": [0.1, 0.3],
                                                                 "min_child_weight": [1]})
    assert len(grid) == 4 and best["n_estimators"] == 20
    E.blend(members, df, df)
    m = members[0]
    rows = E.scored(df, members, ["player_id", "next_y"]).orderBy("player_id").collect()
    a, b = (np.array([r[c] for r in rows]) for c in ("ridge_0", "trees_0"))
    r2 = [1 - ((y - (1 - w) * a - w * b) ** 2).sum() / ((y - y.mean()) ** 2).sum() for w in np.arange(21) / 20]
    assert m.weight == np.argmax(np.round(r2, 12)) / 20 and abs(m.r2 - max(r2)) < 1e-9
    assert abs(m.mae - np.abs(y - (1 - m.weight) * a - m.weight * b).mean()) < 1e-9
    out = E.project(df, members, ["player_id"], {"y": 2}).orderBy("player_id").collect()
    assert [r["y_proj"] for r in out] == np.round((1 - m.weight) * a + m.weight * b, 2).tolist()
    assert F.col("a") is not None

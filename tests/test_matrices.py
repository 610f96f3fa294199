from pyspark.sql import functions as F

from seamstat.functions import codes as K
from seamstat.plans import testdata as T
from seamstat.plans.matrices import hitter_features, pitcher_features, swap_context, train_and_project

SF = "/root/testdata/sf0.001"


def test_matrices_one_row_per_player_season(spark):
    t = T.matrix_inputs(spark, SF)
    h = hitter_features(t, 1995, 2001)
    p = pitcher_features(t, 1995, 2001)
    for df in (h, p):
        assert df.groupBy("player_id", "season").count().where("count > 1").count() == 0
    assert h.where(F.col("pa") < K.MIN_PA).count() == 0
    assert p.where(F.col("ip") < K.MIN_IP).count() == 0
    for c in ("avg_regressed", "iso_3yr", "xwoba_platoon_gap", "barrel_trend", "age_speed_pos",
              "iso_park_adj", "team_runs", "milb_sb_rate"):
        assert c in h.columns
    for c in ("sv_hld", "era_regressed", "gb_fb_ratio_3yr", "platoon_ev_gap", "velo_trend",
              "age_velo", "fip_park_adj", "milb_k_bb"):
        assert c in p.columns


def test_train_project_and_context_swap(spark):
    t = T.matrix_inputs(spark, SF)
    feats = hitter_features(t, 1995, 2001)
    small = {"n_estimators": 3, "max_depth": 2, "learning_rate": 0.1}
    metrics, proj, fitted = train_and_project(
        feats, ["pa", "hr"], {"pa": 0, "hr": 0}, K.HITTER_ID_COLUMNS,
        grid={"n_estimators": [3], "max_depth": [2]}, select_params=small,
        ratios={"hr_per_pa": ("hr", "pa")}, names=T.player_bio(spark, SF),
        latest_rows=swap_context(feats.where(F.col("season") == 2001), T.rosters(spark, SF),
                                 T.park_factors(spark, SF), t["team_strength"]))
    assert {"player_id", "season", "team", "full_name", "pa_proj"} <= set(proj.columns)
    assert {r["season"] for r in proj.select("season").distinct().collect()} == {2002}
    assert proj.where("team is null or full_name is null").count() == 0
    m = {r["target"]: r for r in metrics.collect()}
    assert set(m) == {"next_pa", "next_hr"}
    assert all(0.0 <= r["blend_weight"] <= 1.0 for r in m.values())
    latest = feats.where(F.col("season") == 2001)
    assert proj.count() == latest.count()
    rows = proj.collect()
    assert all(float(r["pa_proj"]).is_integer() for r in rows)
    for r in rows:
        den = r["pa_proj"] if r["pa_proj"] != 0 else 1
        assert abs(r["hr_per_pa_proj"] - round(r["hr_proj"] / den, 2)) < 1e-9
    swapped = swap_context(latest, T.rosters(spark, SF), T.park_factors(spark, SF),
                           t["team_strength"])
    assert swapped.count() == latest.join(T.rosters(spark, SF), "player_id").count()
    assert "proj_team" in swapped.columns and "iso_park_adj" in swapped.columns


def test_blend_on_validation_keeps_test_untouched(spark):
    t = T.matrix_inputs(spark, SF)
    feats = hitter_features(t, 1995, 2001)
    small = {"n_estimators": 3, "max_depth": 2, "learning_rate": 0.1}
    metrics, proj, fitted = train_and_project(
        feats, ["hr"], {"hr": 0}, K.HITTER_ID_COLUMNS, grid={}, select_params=small,
        blend_on="validation", params=small)
    r = metrics.first()
    assert r["target"] == "next_hr" and 0.0 <= r["blend_weight"] <= 1.0 and r["mae"] is not None


def test_matrix_reads_pitches_twice(spark, monkeypatch):
    """Two passes over pitches: statistics once, splits and advanced once."""
    from seamstat.plans import matrices
    t = T.matrix_inputs(spark, SF)
    plans = []
    real = matrices.materialize

    def spy(df, name, path=None):
        plans.append((name, df._jdf.queryExecution().optimizedPlan().toString()))
        return real(df, name, path)

    monkeypatch.setattr(matrices, "materialize", spy)
    # Stored side inputs, so that only the pitch table is read from lineitem.
    stored = {k: (v if k in ("pitches", "games") else real(v, f"stored-{k}")) for k, v in t.items()}
    last = hitter_features(stored)._jdf.queryExecution().optimizedPlan().toString()
    scans = [p.count("l_discount") > 0 or "lineitem" in p for _, p in plans]
    pitch = [p.count("__half") > 0 for _, p in plans]
    assert [n for n, _ in plans] == ["batting_lines", "hitter_rows"] and all(scans)
    assert pitch == [True, False] and "l_orderkey" not in last
    for _, p in plans:
        assert len(__import__("re").findall(r"Relation \[l_orderkey", p)) == 1


def test_pitcher_projection(spark):
    t = T.matrix_inputs(spark, SF)
    small = {"n_estimators": 3, "max_depth": 2, "learning_rate": 0.1}
    metrics, proj, _ = train_and_project(
        pitcher_features(t), ["k", "bb", "era"], {"k": 0, "bb": 0, "era": 2}, K.HITTER_ID_COLUMNS + ["split_type"],
        grid={}, params=small, select_params=small, ratios={"k_bb": ("k", "bb")}, names=T.player_bio(spark, SF))
    assert metrics.count() == 3
    rows = proj.collect()
    assert rows and all(r["full_name"] and r["season"] == 2002 for r in rows)
    assert all(abs(r["k_bb_proj"] - round(r["k_proj"] / (r["bb_proj"] or 1), 2)) < 1e-9 for r in rows)

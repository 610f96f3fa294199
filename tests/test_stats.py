import datetime as dt
from decimal import Decimal

import pytest

from pyspark.sql import functions as F

from seamstat.operators import stats

PITCH_SCHEMA = ("game_pk bigint, batter bigint, pitcher bigint, events string, "
                "inning_topbot string, bb_type string")
GAME_SCHEMA = "game_pk bigint, game_date date, game_type string, home_team string, away_team string"


def _consts(spark, season=2022):
    return spark.createDataFrame(
        [(season, *[Decimal(x) for x in ("0.690", "0.720", "0.880", "1.250", "1.580", "2.030",
                                         "0.310", "1.180", "0.115", "3.100")])],
        "season int, wbb decimal(10,3), whbp decimal(10,3), w1b decimal(10,3), w2b decimal(10,3), "
        "w3b decimal(10,3), whr decimal(10,3), lg_woba decimal(10,3), woba_scale decimal(10,3), "
        "lg_r_pa decimal(10,3), cfip decimal(10,3)")


def _games(spark, rows):
    return spark.createDataFrame(rows, GAME_SCHEMA)


def test_slash_line_b1(spark):
    events = ["single", "home_run", "field_out", "field_out", "strikeout", "field_out",
              "field_out", "walk"]
    p = spark.createDataFrame([(1, 7, 9, e, "Top", None) for e in events], PITCH_SCHEMA)
    g = _games(spark, [(1, dt.date(2022, 5, 1), "R", "HOM", "AWY")])
    parks = spark.createDataFrame([(2022, "AWY", Decimal("100"))], "season int, team string, basic decimal(10,3)")
    out = stats.batting_stats(p, g, _consts(spark), parks)
    r = out.where(F.col("split_type") == "total").first()
    assert (r["avg"], r["obp"], r["slg"], r["ops"]) == (
        Decimal("0.286"), Decimal("0.375"), Decimal("0.714"), Decimal("1.089"))
    assert r["batter_team"] == "TOT" and r["wrc_plus"] is None and r["park_factor"] is None
    t = out.where(F.col("split_type") == "team").first()
    assert t["park_factor"] == Decimal("100") and t["wrc_plus"] is not None


def test_zero_at_bats_b2(spark):
    p = spark.createDataFrame([(1, 7, 9, "walk", "Top", None)], PITCH_SCHEMA)
    g = _games(spark, [(1, dt.date(2022, 5, 1), "R", "HOM", "AWY")])
    parks = spark.createDataFrame([], "season int, team string, basic decimal(10,3)")
    r = stats.batting_stats(p, g, _consts(spark), parks).where("split_type = 'total'").first()
    assert r["avg"] is None and r["slg"] is None and r["ops"] is None and r["obp"] == Decimal("1.000")


def test_traded_batter_rollup_b3(spark):
    rows = [(1, 7, 9, "single", "Top", None), (1, 7, 9, "field_out", "Top", None),
            (2, 7, 9, "home_run", "Bot", None), (2, 7, 9, "walk", "Bot", None)]
    p = spark.createDataFrame(rows, PITCH_SCHEMA)
    g = _games(spark, [(1, dt.date(2022, 5, 1), "R", "HOM", "AAA"),
                       (2, dt.date(2022, 8, 1), "R", "BBB", "XXX")])
    parks = spark.createDataFrame([(2022, "AAA", Decimal("110")), (2022, "BBB", Decimal("90"))],
                                  "season int, team string, basic decimal(10,3)")
    out = stats.batting_stats(p, g, _consts(spark), parks).orderBy("batter_team").collect()
    assert [r["batter_team"] for r in out] == ["AAA", "BBB", "TOT"]
    teams, tot = out[:2], out[2]
    for c in ["pa", "ab", "h", "hr", "bb"]:
        assert sum(r[c] for r in teams) == tot[c]
    assert tot["wrc_plus"] is None and tot["park_factor"] is None


def test_excluded_events_b4(spark):
    rows = [(1, 7, 9, e, "Top", None) for e in ("truncated_pa", "ejection", "game_advisory", None)]
    rows.append((2, 7, 9, "single", "Top", None))
    p = spark.createDataFrame(rows, PITCH_SCHEMA)
    g = _games(spark, [(1, dt.date(2022, 5, 1), "R", "H", "A"), (2, dt.date(2022, 10, 1), "S", "H", "A")])
    assert stats.plate_appearances(p, g).count() == 0


def _apportion(spark, official):
    df = spark.createDataFrame(
        [(1, 2022, "A", "team", 10, official), (1, 2022, "B", "team", 20, official),
         (1, 2022, "TOT", "total", 30, official)],
        "pitcher bigint, season int, pitcher_team string, split_type string, derived_outs bigint, official_outs bigint")
    return {r["pitcher_team"]: r["outs"] for r in stats.apportion_outs(df).collect()}


def test_apportion_up_b5(spark):
    assert _apportion(spark, 33) == {"A": 12, "B": 21, "TOT": 33}


def test_apportion_down_b6(spark):  # T2: negative remainder gives no +1
    assert _apportion(spark, 27) == {"A": 9, "B": 19, "TOT": 27}


def test_fip_b8(spark):
    df = spark.createDataFrame([(1, 2, 1, 6, 18, Decimal("3.10"))],
                               "hr bigint, bb bigint, hbp bigint, k bigint, outs bigint, cfip decimal(10,3)")
    assert stats.fip(df).first()["fip"] == Decimal("4.77")


def test_pitching_stats_end_to_end(spark):
    rows = [(1, 5, 8, e, "Top", bb) for e, bb in
            [("strikeout", None), ("field_out", "fly_ball"), ("home_run", "fly_ball"),
             ("walk", None), ("grounded_into_double_play", "ground_ball")]]
    p = spark.createDataFrame(rows, PITCH_SCHEMA)
    g = _games(spark, [(1, dt.date(2022, 5, 1), "R", "HOM", "AWY")])
    off = spark.createDataFrame([(8, 2022, 5, 1, 0, 0, 1, 1, 1)],
                                "player_id bigint, season int, outs bigint, wins bigint, losses bigint, "
                                "saves bigint, games_played bigint, games_started bigint, earned_runs bigint")
    out = {r["split_type"]: r for r in stats.pitching_stats(p, g, off, _consts(spark)).collect()}
    t, tot = out["team"], out["total"]
    assert t["pitcher_team"] == "HOM" and t["outs"] == 5 and t["era"] is None and t["wins"] is None
    assert tot["outs"] == 5 and tot["ip"] == Decimal("1.2") and tot["era"] == Decimal("5.40")
    assert tot["hr_fb"] == Decimal("0.500") and tot["k_pct"] == Decimal("20.0")


def test_counts_against_plain_counting(spark):
    rows = [(g, 7 + g % 2, 9, e, "Top" if g % 3 else "Bot", None)
            for g in range(1, 6) for e in ("single", "walk", "strikeout", "home_run")]
    p = spark.createDataFrame(rows, PITCH_SCHEMA)
    g = _games(spark, [(i, dt.date(2022, 5, i), "R", f"H{i % 2}", f"A{i % 3}") for i in range(1, 6)])
    want = {}
    for game, batter, _, event, half, _ in rows:
        team = f"A{game % 3}" if half == "Top" else f"H{game % 2}"
        for t in (team, "TOT"):
            k = want.setdefault((batter, t), [0, 0, 0])
            k[0] += 1
            k[1] += event in ("single", "home_run")
            k[2] += event == "walk"
    got = {(r["batter"], r["batter_team"]): [r["pa"], r["h"], r["bb"]]
           for r in stats.event_counts(p, g, "batter", stats.batting_counters()).collect()}
    assert got == want


def test_repeated_constants_raise(spark):
    p = spark.createDataFrame([(1, 7, 9, "single", "Top", None)], PITCH_SCHEMA)
    g = _games(spark, [(1, dt.date(2022, 5, 1), "R", "HOM", "AWY")])
    parks = spark.createDataFrame([(2022, "HOM", 100.0)], "season int, team string, basic double")
    twice = _consts(spark).unionByName(_consts(spark))
    with pytest.raises(Exception, match="constants: more than one row"):
        stats.batting_stats(p, g, twice, parks).collect()


def test_fielders_choice_is_an_out_t19(spark):
    rows = [(1, 5, 8, e, "Top", None) for e in ("fielders_choice", "field_error", "double_play")]
    p = spark.createDataFrame(rows, PITCH_SCHEMA)
    g = _games(spark, [(1, dt.date(2022, 5, 1), "R", "HOM", "AWY")])
    tot = stats.pitching_counts(p, g).where("split_type = 'total'").first()
    assert tot["derived_outs"] == 3 and tot["tbf"] == 3

from decimal import Decimal


from seamstat.plans import loads as L
from seamstat.sources import schemas as S


def _milb(spark, rows):
    return spark.createDataFrame(rows, S.MILB_BATTING)


def _row(pa, hr, rbi, age):
    vals = {f.name: None for f in S.MILB_BATTING.fields}
    vals.update(player_id=1, season=2024, level="AAA", team_name="X", pa=pa, hr=hr, rbi=rbi, age=age,
                avg=Decimal("0.250"))
    return tuple(vals[f.name] for f in S.MILB_BATTING.fields)


def test_milb_batting_partial_refresh_b25(spark):
    stored = _milb(spark, [_row(100, 5, 9, 22)])
    incoming = _milb(spark, [_row(150, 6, 20, 23)])
    r = L.load_milb_batting(stored, incoming).first()
    assert (r["pa"], r["hr"], r["rbi"], r["age"]) == (150, 6, 9, 22)


def test_rosters_replace_season_last_wins(spark):
    cols = "player_id int, season int, team string, team_name string, full_name string, position string, status string"
    stored = spark.createDataFrame([(1, 2025, "A", "a", "P1", "P", None), (1, 2026, "Z", "z", "P1", "P", None)], cols)
    incoming = spark.createDataFrame(
        [(1, 2026, "B", "b", "P1", "P", None, 1), (1, 2026, "C", "c", "P1", "P", None, 2),
         (2, 2026, "B", "b", "P2", "C", None, 1)], cols + ", entry_seq int")
    out = sorted((r["player_id"], r["season"], r["team"]) for r in L.load_rosters(stored, incoming).collect())
    assert out == [(1, 2025, "A"), (1, 2026, "C"), (2, 2026, "B")]


def test_games_insert_absent_and_pitch_reload(spark):
    g0 = spark.createDataFrame([(1, "R")], "game_pk bigint, game_type string")
    g1 = spark.createDataFrame([(1, "S"), (2, "R"), (2, "R")], "game_pk bigint, game_type string")
    assert sorted(L.load_games(g0, g1).collect()) == [(1, "R"), (2, "R")]
    p0 = spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], "game_pk bigint, n int, e string")
    p1 = spark.createDataFrame([(1, 1, "c")], "game_pk bigint, n int, e string")
    assert L.load_pitches(L.load_pitches(p0, p1), p1).collect() == [(1, 1, "c")]


def test_players_keep_stored_names(spark):
    s = spark.createDataFrame([(1, "Stored"), (2, None)], "player_id bigint, player_name string")
    i = spark.createDataFrame([(1, "New"), (2, "Resolved"), (3, "Fresh")], "player_id bigint, player_name string")
    got = {r["player_id"]: r["player_name"] for r in L.load_players(s, i).collect()}
    assert got == {1: "Stored", 2: "Resolved", 3: "Fresh"}

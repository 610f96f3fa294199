import json

from pyspark.sql import functions as F

from seamstat.operators import tables as TB

S = "player_id bigint, season int, hr bigint, rbi bigint"


def test_partial_upsert_b25(spark):
    t = spark.createDataFrame([(1, 2022, 5, 9)], S)
    i = spark.createDataFrame([(1, 2022, 6, 20), (2, 2022, 1, 1)], S)
    out = {r["player_id"]: r for r in TB.upsert(t, i, ["player_id", "season"], ["hr"]).collect()}
    assert (out[1]["hr"], out[1]["rbi"]) == (6, 9) and (out[2]["hr"], out[2]["rbi"]) == (1, 1)


def test_upsert_idempotent(spark):
    t = spark.createDataFrame([(1, 2022, 5, 9), (3, 2022, 0, 0)], S)
    i = spark.createDataFrame([(1, 2022, 6, 20), (2, 2022, 1, 1)], S)
    once = TB.upsert(t, i, ["player_id", "season"])
    twice = TB.upsert(once, i, ["player_id", "season"])
    assert sorted(once.collect()) == sorted(twice.collect())


def test_coalesce_upsert_b26(spark):
    t = spark.createDataFrame([(1, "A"), (2, None)], "player_id bigint, name string")
    i = spark.createDataFrame([(1, "B"), (2, "C")], "player_id bigint, name string")
    out = {r["player_id"]: r["name"] for r in TB.upsert_coalesce(t, i, ["player_id"], ["name"]).collect()}
    assert out == {1: "A", 2: "C"}


def test_reload_b27(spark):
    t = spark.createDataFrame([(10, 1, "x"), (11, 1, "y")], "game_pk bigint, n int, v string")
    inc = spark.createDataFrame([(10, 1, "x2"), (10, 2, "z")], "game_pk bigint, n int, v string")
    once = TB.replace_keys(t, inc, ["game_pk"])
    twice = TB.replace_keys(once, inc, ["game_pk"])
    assert sorted(once.collect()) == sorted(twice.collect())
    assert sorted(r["v"] for r in once.collect()) == ["x2", "y", "z"]


def test_insert_absent(spark):
    t = spark.createDataFrame([(1, 2022, 5, 9)], S)
    i = spark.createDataFrame([(1, 2022, 6, 20), (2, 2022, 1, 1)], S)
    out = {r["player_id"]: r["hr"] for r in TB.insert_absent(t, i, ["player_id", "season"]).collect()}
    assert out == {1: 5, 2: 1}


def test_align_to_schema(spark):
    df = spark.createDataFrame([(1, 2, 3)], "id int, a int, b int")
    assert TB.align_to_schema(df, ["id", "a", "b", "c"], ["id", "a", "c"]).columns == ["a"]


def test_quality_starts_b24(spark):
    from seamstat.operators.aggs import quality_starts
    from seamstat.sources import landed_json as LJ
    from seamstat.sources.schemas import GAME_LOG_PAYLOAD as STATS_PAYLOAD
    games = [(1, "6.0", 3), (1, "5.2", 0), (1, "7.0", 4), (0, "6.0", 0), (1, "6.1", None)]
    splits = [{"stat": {"gamesStarted": gs, "inningsPitched": ip,
                        **({} if er is None else {"earnedRuns": er})}} for gs, ip, er in games]
    doc = json.dumps({"stats": [{"splits": splits}]})
    df = spark.createDataFrame([(8, 2022, doc)], "player_id bigint, season int, payload string")
    log = LJ.flatten_game_log(LJ.parse(df, "payload", STATS_PAYLOAD))
    r = quality_starts(log, "player_id", "season", "games_started", "innings", "earned_runs").first()
    assert (r["games_started"], r["quality_starts"]) == (4, 1)


def test_milb_pitching_rates_b29(spark):
    from seamstat.sources.landed_json import milb_pitching_rates
    df = spark.createDataFrame([(2022, 10, 4, 1, 10.0)], "season int, so int, bb int, hr int, ip double")
    r = milb_pitching_rates(df).first()
    assert (r["k_9"], r["bb_9"], r["hr_9"], r["k_bb"], r["fip"]) == (9.0, 3.6, 0.9, 5.4, 3.6)


def test_flatten_bio_and_roster(spark):
    from seamstat.sources import landed_json as LJ
    from seamstat.sources.schemas import PEOPLE_PAYLOAD, ROSTER_PAYLOAD
    bio = json.dumps({"people": [{"id": 5, "fullName": "A B", "birthDate": "1990-02-03",
                                  "primaryPosition": {"abbreviation": "SS"}, "batSide": {"code": "L"}}]})
    df = LJ.parse(spark.createDataFrame([(bio,)], "payload string"), "payload", PEOPLE_PAYLOAD)
    r = df.select(*LJ.flatten_bio(F.col("doc"))).first()
    assert (r["player_id"], r["primary_position"], r["bat_side"], str(r["birth_date"])) == (5, "SS", "L", "1990-02-03")
    ros = json.dumps({"roster": [{"person": {"id": 1, "fullName": "X"}, "position": {"abbreviation": "P"}},
                                 {"person": {"id": 2, "fullName": "Y"}, "status": {"description": "Active"}}]})
    df = LJ.parse(spark.createDataFrame([(2026, "NYY", "New York", ros)],
                                        "season int, team string, team_name string, payload string"),
                  "payload", ROSTER_PAYLOAD)
    rows = sorted(LJ.flatten_rosters(df).collect())
    assert [(r["player_id"], r["position"], r["status"]) for r in rows] == [(1, "P", None), (2, None, "Active")]


def test_season_stats_first_split_only(spark):
    from seamstat.sources import landed_json as LJ
    from seamstat.sources.schemas import STATS_PAYLOAD
    doc = json.dumps({"stats": [{"splits": [{"stat": {"homeRuns": 7, "avg": ".250"}},
                                            {"stat": {"homeRuns": 3, "avg": ".---"}}]}]})
    df = LJ.parse(spark.createDataFrame([(doc,)], "payload string"), "payload", STATS_PAYLOAD)
    r = df.select(*LJ.flatten_season_stats(F.col("doc"), {"hr": "homeRuns", "avg": "avg"})).first()
    assert (r["hr"], r["avg"]) == (7, ".250")


def test_dq_reports(spark):
    from seamstat.operators import quality as Q
    df = spark.createDataFrame([(1, 1, None), (1, 1, 2.0), (2, 1, 3.0)], "a int, b int, x double")
    assert Q.duplicate_keys(df, ["a", "b"]).first()["n_rows"] == 2
    r = Q.match_rate(df, ["x"]).first()
    assert r["x_matched"] == 2 and abs(r["x_rate"] - 2 / 3) < 1e-12
    assert Q.check_row_count(df, df.limit(2)).first()["stable"] is False


def test_dynamic_partition_overwrite_replaces_only_touched(spark):
    import os
    import tempfile
    run = tempfile.mkdtemp(prefix="seamstat-part-")
    path = os.path.join(run, "t")
    base = spark.createDataFrame([(1, 2020, 1), (2, 2021, 1)], "player_id bigint, season int, v int")
    TB.write_table(base, path, partition_by=["season"])
    TB.write_table(spark.createDataFrame([(3, 2021, 9)], "player_id bigint, season int, v int"),
                   path, partition_by=["season"])
    got = sorted((r["player_id"], r["season"], r["v"]) for r in spark.read.parquet(path).collect())
    assert got == [(1, 2020, 1), (3, 2021, 9)]


def test_read_sprint_speed_csv(spark):
    import os
    import tempfile
    from seamstat.sources.landed_json import read_sprint_speed
    run = tempfile.mkdtemp(prefix="seamstat-csv-")
    for season, rows in ((2023, "player_id,sprint_speed,hp_to_1b,bolts,competitive_runs,extra\n5,28.1,4.20,3,40,x\n"),
                         (2024, "player_id,sprint_speed,hp_to_1b,bolts,competitive_runs,extra\n5,27.9,4.25,,38,y\n")):
        os.makedirs(os.path.join(run, str(season)))
        with open(os.path.join(run, str(season), "s.csv"), "w") as f:
            f.write(rows)
    df = read_sprint_speed(spark, {s: os.path.join(run, str(s)) for s in (2023, 2024)})
    got = sorted((r["season"], float(r["sprint_speed"]), r["bolts"]) for r in df.collect())
    assert got == [(2023, 28.1, 3), (2024, 27.9, None)] and len(df.columns) == 6


def test_season_partitioned_pitches_prune(spark):
    import datetime as dt
    import os
    import tempfile
    from seamstat.operators import stats
    run = tempfile.mkdtemp(prefix="seamstat-pp-")
    p = spark.createDataFrame([(1, 7, 9, "single", "Top", None), (2, 7, 9, "walk", "Top", None)],
                              "game_pk bigint, batter bigint, pitcher bigint, events string, inning_topbot string, bb_type string")
    g = spark.createDataFrame([(1, dt.date(2021, 5, 1), "R", "H", "A"), (2, dt.date(2022, 5, 1), "R", "H", "A")],
                              "game_pk bigint, game_date date, game_type string, home_team string, away_team string")
    path = os.path.join(run, "pitches")
    TB.write_pitches_by_season(p, g, path)
    stored = spark.read.parquet(path)
    out = stats.batting_counts(stored, g, first=2022, last=2022)
    plan = out._jdf.queryExecution().executedPlan().toString()
    import re
    assert re.search(r"PartitionFilters: \[[^\]]*season", plan)
    assert [r["bb"] for r in out.where("split_type = 'total'").collect()] == [1]


def test_roster_last_one_wins_t18(spark):
    rows = spark.createDataFrame([(7, 2026, "AAA", 1), (7, 2026, "BBB", 2), (8, 2026, "CCC", 1)],
                                 "player_id bigint, season int, team string, seq int")
    stored = spark.createDataFrame([], "player_id bigint, season int, team string, seq int")
    out = {r["player_id"]: r["team"] for r in
           TB.upsert(stored, rows, ["player_id", "season"], order="seq").collect()}
    assert out == {7: "BBB", 8: "CCC"}


def test_csv_columns_are_matched_by_name(spark, tmp_path):
    from seamstat.sources.readers import PITCHES, read_pitches
    (tmp_path / "a.csv").write_text("game_pk,batter,pitcher,zone,launch_speed\n1,10,20,3.0,99.5\n")
    (tmp_path / "b.csv").write_text("pitcher,zone,batter,game_pk,more\n21,2.5,11.0,2,x\n")
    (tmp_path / "c.csv").write_text("game_pk,batter,pitcher,zone,launch_speed\n3,x,,,-\n")
    df = read_pitches(spark, [str(tmp_path / f"{x}.csv") for x in "abc"], "csv")
    got = sorted((r["game_pk"], r["batter"], r["pitcher"], r["zone"], r["launch_speed"]) for r in df.collect())
    assert got == [(1, 10, 20, 3, 99.5), (2, 11, 21, None, None), (3, None, None, None, None)]
    assert df.schema.names == PITCHES.names and len(PITCHES) == 42


def test_upsert_order_nulls_and_ties(spark):
    schema = "k int, v int, o int"
    stored = spark.createDataFrame([(1, 10, 1), (2, 20, 1)], schema)
    new = spark.createDataFrame([(1, 11, None), (3, None, 5), (3, 31, 5), (3, 32, None), (4, 40, None), (4, 41, None)], schema)
    for _ in range(2):
        got = sorted(map(tuple, TB.upsert(stored, new.repartition(4), ["k"], order="o").collect()))
        assert got == [(1, 11, None), (2, 20, 1), (3, 31, 5), (4, 41, None)]
    none = TB.insert_absent(stored, new.repartition(3), ["k"])
    assert sorted(r["v"] for r in none.where("k = 4").collect()) == [41]


def test_repeated_official_lines_raise(spark):
    import pytest
    from seamstat.operators.joins import unique_by
    df = spark.createDataFrame([(1, 2, 3), (1, 2, 3)], "a int, b int, x int")
    with pytest.raises(Exception, match="lines: more than one row"):
        unique_by(df, ["a", "b"], "lines").collect()


def test_no_scratch_folder_off_local(spark, monkeypatch):
    import pytest
    from seamstat import session

    class Conf:
        def get(self, *_):
            return None

    class Cluster:
        conf = Conf()

        class sparkContext:
            master = "spark://host:7077"

            @staticmethod
            def getConf():
                return Conf()
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Cluster())

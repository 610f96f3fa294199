import os
import tempfile

from pyspark.sql import functions as F

from seamstat.operators import modeling as M
from seamstat.operators import projections as PR
from seamstat.sources import readers as R


def test_read_pitches_many_files_declared_schema(spark):
    run = tempfile.mkdtemp(prefix="seamstat-read-")
    a = spark.createDataFrame([(1, 10, 20, "single", 97.5)],
                              "game_pk bigint, pitcher bigint, batter bigint, events string, launch_speed double")
    b = spark.createDataFrame([(2, 11, 21, None, None)],
                              "game_pk bigint, pitcher bigint, batter bigint, events string, launch_speed double")
    a.write.parquet(os.path.join(run, "w1"))
    b.write.parquet(os.path.join(run, "w2"))
    df = R.read_pitches(spark, [os.path.join(run, "w1"), os.path.join(run, "w2")])
    assert len(df.columns) == 42 and df.count() == 2
    assert df.where(F.col("events").isNull()).count() == 1
    csv = os.path.join(run, "c")
    spark.createDataFrame([("3", "x", "99.1")], "game_pk string, batter string, launch_speed string") \
        .write.option("header", True).csv(csv)
    c = R.read_pitches(spark, csv, fmt="csv").first()
    assert c["game_pk"] == 3 and c["batter"] is None and c["launch_speed"] == 99.1


def test_projection_helpers(spark):
    df = spark.createDataFrame([(1, 2020, 0.3, 0.2)], "player_id bigint, season int, lg_avg double, x_prior double")
    out = PR.drop_matching(PR.drop_matching(df, prefix="lg_"), suffix="_prior")
    assert out.columns == ["player_id", "season"]
    assert PR.shift_key(df).first()["season"] == 2021
    assert PR.rename_template(df, ["lg_avg"], "{}_x").columns[2] == "lg_avg_x"


def test_leaderboard_and_ratio(spark):
    df = spark.createDataFrame([(1, 120.0, 10.0, 3.0), (2, 80.0, 12.0, 0.0), (3, 150.0, 9.0, 4.0)],
                               "player_id bigint, ip double, k double, bb double")
    top = [r["player_id"] for r in M.leaderboard(df, "k", 2, F.col("ip") >= 100).collect()]
    assert top == [1, 3]
    r = {x["player_id"]: x["k_bb"] for x in M.derive_ratio(df, "k", "bb", "k_bb").collect()}
    assert r == {1: 3.33, 2: 12.0, 3: 2.25}


def test_lookup(spark):
    from seamstat.operators.joins import lookup
    ids = spark.createDataFrame([(1,), (1,), (3,)], "player_id bigint")
    players = spark.createDataFrame([(1, "A"), (2, "B"), (3, None)], "player_id bigint, player_name string")
    assert sorted(lookup(ids, players).collect()) == [(1, "A"), (3, None)]


def test_rows_only_queries_run(spark):
    from seamstat.plans.queries import ORACLE, QUERIES
    sf = "/root/testdata/sf0.001"
    for name in sorted(set(QUERIES) - set(ORACLE)):
        if name.startswith("q_project"):    # tests/test_projection.py
            continue
        df = QUERIES[name](spark, sf)
        assert df.count() > 0, name
    assert len(QUERIES["q_hitter_features"](spark, sf).columns) >= 140


def test_flatten_milb_batting_src05(spark):
    import json

    from seamstat.sources import landed_json as LJ
    from seamstat.sources.schemas import STATS_PAYLOAD
    doc = json.dumps({"stats": [{"splits": [
        {"player": {"id": 5}, "team": {"name": "Bees"},
         "stat": {"plateAppearances": 120, "homeRuns": 4, "avg": ".281", "obp": ".---"}},
        {"player": {"id": 6}, "team": {"name": "Owls"}, "stat": {"plateAppearances": 40}}]}]})
    df = LJ.parse(spark.createDataFrame([(11, 2024, doc)], "sport_id int, season int, payload string"),
                  "payload", STATS_PAYLOAD)
    rows = {r["player_id"]: r for r in LJ.flatten_milb_batting(df).collect()}
    assert rows[5]["level"] == "AAA" and rows[5]["pa"] == 120 and rows[5]["hr"] == 4
    assert str(rows[5]["avg"]) == "0.281" and rows[5]["obp"] is None
    assert rows[6]["hr"] == 0 and rows[6]["team_name"] == "Owls"


def test_ratio_scores_and_compare_mlo11_mlo12(spark):
    preds = spark.createDataFrame([(1, 2025, 100.0, 0.0), (2, 2025, 50.0, 10.0)],
                                  "player_id bigint, season int, k double, bb double")
    acts = spark.createDataFrame([(1, 2025, 90.0, 0.0), (2, 2025, 60.0, 12.0)],
                                 "player_id bigint, season int, k double, bb double")
    j = preds.alias("p").join(acts.alias("a"), ["player_id", "season"]).select(
        F.col("p.k").alias("pk"), F.col("p.bb").alias("pbb"), F.col("a.k").alias("ak"),
        F.col("a.bb").alias("abb"))
    r = M.ratio_scores(j, "pk", "pbb", "ak", "abb").first()
    assert abs(r["mae"] - (10 + 0) / 2) < 1e-12
    names = spark.createDataFrame([(1, "A"), (2, "B")], "player_id bigint, full_name string")
    top = M.compare(preds, acts, names, ["player_id", "season"], ["k", "bb"], "k", k=1).collect()
    assert top[0]["full_name"] == "A" and top[0]["pred_k"] == 100.0 and top[0]["actual_k"] == 90.0

"""A hot key (one game with about a third of all events) under forced
sort-merge joins with AQE skew splitting: results stay exact."""
import datetime as dt

import pandas as pd
from pyspark.sql import functions as F

from seamstat.operators import stats

EVENTS = ["single", "walk", "strikeout", "home_run", "field_out", "double"]


def test_hot_game_counts_exact(spark):
    rows = []
    for g in range(1, 200):
        for i in range(5):
            rows.append((g, 100 + (g * 7 + i) % 40, EVENTS[(g + i) % 6], "Top" if i % 2 else "Bot"))
    hot = [(0, 100 + i % 40, EVENTS[i % 6], "Top" if i % 3 else "Bot") for i in range(500)]
    pdf = pd.DataFrame(rows + hot, columns=["game_pk", "batter", "events", "inning_topbot"])
    pitches = spark.createDataFrame(pdf).withColumn("pitcher", F.lit(1).cast("bigint")) \
        .withColumn("bb_type", F.lit(None).cast("string")).repartition(8)
    games = spark.createDataFrame([(g, dt.date(2022, 5, 1), "R", f"H{g % 3}", f"A{g % 5}") for g in range(200)],
                                  "game_pk bigint, game_date date, game_type string, home_team string, away_team string")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        got = {(r["batter"], r["batter_team"]): (r["pa"], r["hr"], r["bb"])
               for r in stats.batting_counts(pitches, games).collect()}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    g = pdf.merge(pd.DataFrame({"game_pk": range(200), "h": [f"H{x % 3}" for x in range(200)],
                                "a": [f"A{x % 5}" for x in range(200)]}), on="game_pk")
    g["team"] = g.a.where(g.inning_topbot == "Top", g.h)
    exp = {}
    for (b, t), grp in g.groupby(["batter", "team"]):
        exp[(b, t)] = (len(grp), int((grp.events == "home_run").sum()), int((grp.events == "walk").sum()))
    for b, grp in g.groupby("batter"):
        exp[(b, "TOT")] = (len(grp), int((grp.events == "home_run").sum()), int((grp.events == "walk").sum()))
    assert got == exp

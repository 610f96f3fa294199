"""Counters of plate appearances cross the join with games as one number, and
rows of an entity and season lie together before their wide groups are formed."""
import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from seamstat.operators import stats
from seamstat.operators.aggs import together

SF = "/root/testdata/sf0.001"
GAMES = "game_pk bigint, game_date date, game_type string, home_team string, away_team string"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark):
    from seamstat.plans import testdata as T
    return T.pitches(spark, SF), T.games(spark, SF)


def test_counters_cross_the_join_as_one_number(tables):
    plan = _plan(stats.batting_counts(*tables))
    pre = re.findall(r"HashAggregate\(keys=\[__g#[^\]]*\], functions=\[([^\]]*)\]", plan)
    assert pre and all(x in ("partial_count(1)", "count(1)") for x in pre)
    assert "REBALANCE_PARTITIONS_BY_COL" in plan


def test_counts_of_unknown_events_halves_and_entities(spark):
    rows = [(1, 7, "single", "Top", "fly_ball"), (1, 7, "single", "Top", None), (1, 7, "single", None, None),
            (1, None, "home_run", "Bot", "fly_ball"), (1, 7, None, "Top", None), (2, 7, "walk", "Bot", "popup"),
            (1, 7, "strikeout", "Top", "fly_ball")]
    p = spark.createDataFrame(rows, "game_pk bigint, batter bigint, events string, inning_topbot string, bb_type string") \
        .withColumn("pitcher", F.col("batter"))
    g = spark.createDataFrame([(1, dt.date(2022, 5, 1), "R", "H", "A"), (2, dt.date(2022, 6, 1), "R", "H", "A")], GAMES)
    got = {(r["batter"], r["batter_team"]): (r["pa"], r["h"], r["1b"], r["k"], r["bb"], r["hr"])
           for r in stats.batting_counts(p, g).collect()}
    assert got == {(7, "A"): (3, 2, 2, 1, 0, 0), (7, "H"): (2, 1, 1, 0, 1, 0), (7, "TOT"): (5, 3, 3, 1, 1, 0),
                   (None, "H"): (1, 1, 0, 0, 0, 1), (None, "TOT"): (1, 1, 0, 0, 0, 1)}
    pit = stats.pitching_counts(p, g).where("pitcher = 7 AND split_type = 'total'").first()
    assert (pit["tbf"], pit["fly_balls"], pit["derived_outs"]) == (5, 2, 1)


def test_together_keeps_rows_and_deals_a_large_key_out(spark):
    df = spark.range(4000, numPartitions=4).select(F.when(F.col("id") % 4 == 0, F.col("id")).alias("k"), "id")
    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "2048", "spark.sql.adaptive.rebalancePartitionsSmallPartitionFactor": "0.1"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        rows = together(df, ["k"]).withColumn("task", F.spark_partition_id()).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sorted(r["id"] for r in rows) == list(range(4000))
    assert len({r["task"] for r in rows if r["k"] is None}) > 1

"""Driver queries of the projection flow of both roles on the real feature
matrices: all features, all eight targets, the grid with all rounds, roster
and context swap, rounding and names. A learned number has no SQL; the rows,
teams, seasons and names have (``tests/test_projection.py``)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from seamstat.functions import codes as K
from seamstat.plans import testdata as T
from seamstat.plans.queries import register
from seamstat.session import checkpoint_table_path


def _projection(spark, sf_dir, role: str):
    from seamstat.operators.ensemble import train_and_project
    from seamstat.operators.joins import latest_snapshot
    from seamstat.plans import matrices as M
    t = T.matrix_inputs(spark, sf_dir)
    hitter = role == "hitter"
    features = M.materialize(M.hitter_features(t) if hitter else M.pitcher_features(t), f"{role}_matrix")
    adjust = {"iso_park_adj": "iso"} if hitter else {"era_park_adj": "era", "fip_park_adj": "fip"}
    strength = M.materialize(t["team_strength"], "team_strength")
    moved = M.swap_context(latest_snapshot(features, "season"), T.rosters(spark, sf_dir), t["parks"], strength, adjust=adjust)
    return train_and_project(
        features, K.HITTER_TARGETS if hitter else K.PITCHER_TARGETS,
        K.HITTER_TARGET_DIGITS if hitter else K.PITCHER_TARGET_DIGITS,
        K.HITTER_ID_COLUMNS if hitter else [*K.HITTER_ID_COLUMNS, "split_type"], moved,
        tune_target="hr" if hitter else "k", ratios={} if hitter else {"k_bb": ("k", "bb")},
        names=T.player_bio(spark, sf_dir))


@register("q_project_hitters")
def q_project_hitters(spark, sf_dir):
    """Next season's line of every hitter on a roster (MLO-01 .. MLO-13,
    DOM-30, JON-11, JON-12)."""
    return _projection(spark, sf_dir, "hitter")[1]


@register("q_project_pitchers")
def q_project_pitchers(spark, sf_dir):
    """Next season's line of every pitcher on a roster, with the ratio of the
    rounded strikeouts and walks (MLO-01 .. MLO-14, DOM-30)."""
    return _projection(spark, sf_dir, "pitcher")[1]


@register("q_load_rules", """
WITH milb AS (
  SELECT l_suppkey AS player_id, CAST(year(l_shipdate) AS INTEGER) AS season, l_returnflag AS level, l_linestatus AS team_name,
         count(*) AS n, count(*) FILTER (WHERE l_quantity > 40) AS hr FROM lineitem GROUP BY 1, 2, 3, 4),
odd AS (SELECT * FROM milb WHERE (player_id + season) % 2 = 1), third AS (SELECT * FROM milb WHERE player_id % 3 = 0)
SELECT 'milb_batting' AS rule, coalesce(t.player_id, o.player_id) AS player_id, coalesce(t.season, o.season) AS season,
       coalesce(t.level, o.level) || coalesce(t.team_name, o.team_name) AS name,
       CAST(CASE WHEN t.player_id IS NOT NULL THEN t.n + 100 ELSE o.n END AS BIGINT) AS refreshed,
       CAST(CASE WHEN o.player_id IS NOT NULL THEN o.hr ELSE t.hr + 100 END AS BIGINT) AS kept
FROM odd o FULL OUTER JOIN third t ON t.player_id = o.player_id AND t.season = o.season AND t.level = o.level AND t.team_name = o.team_name
UNION ALL
SELECT 'games', o_orderkey, CAST(year(o_orderdate) AS INTEGER),
       CASE WHEN o_orderkey % 2 = 0 OR o_orderkey % 3 <> 0 THEN o_orderstatus ELSE 'new' END, 0, 0
FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 = 0
UNION ALL
SELECT 'players', c_custkey, 0, CASE WHEN c_custkey % 4 <> 0 THEN c_name ELSE 'new ' || c_custkey END, 0, 0 FROM customer
UNION ALL
SELECT 'pitches', l_orderkey, 0, CAST(l_linenumber AS VARCHAR), CASE WHEN l_orderkey % 5 = 0 AND l_linenumber <= 3 THEN 1 ELSE 0 END, 0
FROM lineitem WHERE l_linenumber <= 3 OR l_orderkey NOT IN
  (SELECT l_orderkey FROM lineitem WHERE l_orderkey % 5 = 0 AND l_linenumber <= 3)
UNION ALL
SELECT 'sprint', player_id, season, '', CAST(sum(n) + CASE WHEN season >= 1997 THEN 1000 ELSE 0 END AS BIGINT), 0 FROM milb GROUP BY 2, 3
UNION ALL
SELECT 'quality', player_id, season, '', CAST(sum(n) + CASE WHEN player_id % 3 = 0 THEN 100 * count(*) ELSE 0 END AS BIGINT), 0
FROM milb GROUP BY 2, 3""")
def q_load_rules(spark, sf_dir):
    """The load rule of each stored table on stored rows and a delivery that
    overlaps them: a game's pitches are replaced, a known game and a known
    name stay, minor-league lines refresh some columns, a season's file
    replaces the season, quality starts are upserted (SNK-03 .. SNK-08)."""
    from seamstat.plans import loads as L
    from seamstat.sources import schemas as S
    run = uuid.uuid4().hex

    def stored(df, name):
        path = checkpoint_table_path(spark, f"load_rules/{run}-{name}")
        df.write.parquet(path)
        return spark.read.parquet(path)

    def out(df, rule, player, season, name, refreshed, kept):
        return df.select(F.lit(rule).alias("rule"), F.col(player).cast("bigint").alias("player_id"),
                         F.expr(season).cast("int").alias("season"), F.expr(name).alias("name"),
                         F.expr(refreshed).cast("bigint").alias("refreshed"), F.expr(kept).cast("bigint").alias("kept"))

    li, o = T.read(spark, sf_dir, "lineitem"), T.read(spark, sf_dir, "orders")
    milb = stored(li.groupBy(F.col("l_suppkey").alias("player_id"), F.year("l_shipdate").alias("season"),
                             F.col("l_returnflag").alias("level"), F.col("l_linestatus").alias("team_name")).agg(
        F.count(F.lit(1)).cast("int").alias("n"), F.count_if(F.col("l_quantity") > 40).cast("int").alias("hr")), "milb")
    filled = {f.name: F.lit(None).cast(f.dataType) for f in S.MILB_BATTING.fields}

    def batting(df, extra):
        own = {**filled, "player_id": F.col("player_id"), "season": F.col("season"), "level": F.col("level"),
               "team_name": F.col("team_name"), "pa": F.col("n") + extra, "doubles": F.col("hr") + extra}
        return df.select(*[v.cast(S.MILB_BATTING[k].dataType).alias(k) for k, v in own.items()])

    lines = L.load_milb_batting(stored(batting(milb.where("(player_id + season) % 2 = 1"), 0), "batting"),
                                batting(milb.where("player_id % 3 = 0"), 100))
    games = o.select(F.col("o_orderkey").alias("game_pk"), F.year("o_orderdate").alias("season"), F.col("o_orderstatus").alias("status"))
    known = L.load_games(stored(games.where("game_pk % 2 = 0"), "games"),
                         games.where("game_pk % 3 = 0").withColumn("status", F.lit("new")))
    people = T.read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("player_id"), F.col("c_name").alias("player_name"))
    names = L.load_players(
        stored(people.withColumn("player_name", F.when(F.col("player_id") % 4 != 0, F.col("player_name"))), "players"),
        people.withColumn("player_name", F.concat(F.lit("new "), F.col("player_id").cast("string"))))
    pitches = li.select(F.col("l_orderkey").alias("game_pk"), F.col("l_linenumber").alias("number"), F.lit(0).alias("fresh"))
    reloaded = L.load_pitches(stored(pitches, "pitches"),
                              pitches.where("game_pk % 5 = 0 AND number <= 3").withColumn("fresh", F.lit(1)))
    total = milb.groupBy("player_id", "season").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"))
    speeds = L.load_sprint_speed(stored(total.drop("k"), "speeds"),
                                 total.where("season >= 1997").select("player_id", "season", (F.col("n") + 1000).alias("n")))
    quality = L.load_quality_starts(
        stored(total.select("player_id", "season", "n"), "quality"),
        total.where("player_id % 3 = 0").select("player_id", "season", (F.col("n") + 100 * F.col("k")).alias("n")))
    parts = [out(lines, "milb_batting", "player_id", "season", "level || team_name", "pa", "doubles"),
             out(known, "games", "game_pk", "season", "status", "0", "0"),
             out(names, "players", "player_id", "0", "player_name", "0", "0"),
             out(reloaded, "pitches", "game_pk", "0", "CAST(number AS STRING)", "fresh", "0"),
             out(speeds, "sprint", "player_id", "season", "''", "n", "0"),
             out(quality, "quality", "player_id", "season", "''", "n", "0")]
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p)
    return both

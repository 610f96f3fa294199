"""Baseball-shaped tables derived from the driver's TPC-H-like tables.

The engine's operators take pitch events, games, official lines and season
dimensions. On ``/root/testdata`` these are derived, row for row, from
``lineitem`` and ``orders`` (so every query reads the whole tables and its
work grows with them):

* games   <- orders: game_pk = o_orderkey, game_date = date(o_orderdate),
  game_type 'R' except November/December ('P'), home team 'H' + first char
  of o_orderpriority, away team 'A' + o_orderstatus.
* pitches <- lineitem: game_pk = l_orderkey, batter = pitcher = l_suppkey,
  half-inning from l_linestatus, event code from l_quantity, description
  from l_discount, batted-ball type from l_tax, launch speed / angle from
  quantity and line number (null for some flags), hands from flags.
* official lines, constants, park factors: per-(supplier, ship year) and
  per-(season, team) aggregates, and a rule-built season table.

Each derivation exists twice: as DataFrame code for Spark and as DuckDB SQL
text (``DUCK_*``) used by the oracle queries; they must stay in step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# FIXED VALUES (test mapping): event code by (l_quantity - 1) % 30, pitch
# description by hundredths of l_discount, in natural order.
EVENT_CYCLE = [
    "single", "field_out", "strikeout", "walk", "double", "field_out",
    "force_out", "home_run", "strikeout", "grounded_into_double_play",
    "single", "hit_by_pitch", "sac_fly", "field_out", "single",
    "fielders_choice_out", "strikeout", "double", "field_error", "walk",
    "triple", "intent_walk", "sac_bunt", "fielders_choice",
    "strikeout_double_play", "double_play", "catcher_interf", "truncated_pa",
    "sac_fly_double_play", "triple_play"]
DESCRIPTION_CYCLE = [
    "ball", "called_strike", "swinging_strike", "foul", "hit_into_play",
    "swinging_strike_blocked", "foul_tip", "ball", "hit_into_play_no_out",
    "foul_bunt", "hit_into_play_score"]
PITCH_TYPES = ["FF", "SI", "SL", "CH", "CU", "FC"]
FIRST_SEASON, LAST_SEASON = 1995, 2001


def _sql_list(xs):
    return "[" + ", ".join(f"'{x}'" for x in xs) + "]"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ------------------------------------------------------------------ games --
def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("game_pk"),
        F.to_date("o_orderdate").alias("game_date"),
        F.when(F.month("o_orderdate") >= 11, F.lit("P")).otherwise(F.lit("R")).alias("game_type"),
        F.concat(F.lit("H"), F.substring("o_orderpriority", 1, 1)).alias("home_team"),
        F.concat(F.lit("A"), F.col("o_orderstatus")).alias("away_team"),
        F.col("o_custkey").alias("customer"))


DUCK_GAMES = """games_v AS (
  SELECT o_orderkey AS game_pk, CAST(o_orderdate AS DATE) AS game_date,
         CASE WHEN month(o_orderdate) >= 11 THEN 'P' ELSE 'R' END AS game_type,
         'H' || substr(o_orderpriority, 1, 1) AS home_team,
         'A' || o_orderstatus AS away_team, o_custkey AS customer
  FROM orders)"""


# ---------------------------------------------------------------- pitches --
def _idx(x):
    """Hundredths of a non-negative two-decimal value as an int
    (floor(x * 100 + 0.5), primitive arithmetic)."""
    return F.floor(x * 100 + 0.5).cast("int")


def pitches(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem")
    q = F.col("l_quantity")
    ev_idx = ((q.cast("int") - 1) % len(EVENT_CYCLE)) + 1
    tax = _idx(F.col("l_tax"))
    return li.select(
        F.col("l_orderkey").alias("game_pk"),
        F.col("l_suppkey").alias("batter"),
        F.col("l_suppkey").alias("pitcher"),
        F.col("l_linenumber").alias("at_bat_number"),
        F.when(F.col("l_linestatus") == "F", "Top").otherwise("Bot").alias("inning_topbot"),
        F.when(F.col("l_linenumber") == 7, F.lit(None).cast("string"))
         .otherwise(F.element_at(F.array(*[F.lit(e) for e in EVENT_CYCLE]), ev_idx))
         .alias("events"),
        F.element_at(F.array(*[F.lit(d) for d in DESCRIPTION_CYCLE]),
                     _idx(F.col("l_discount")) + 1).alias("description"),
        F.when(tax <= 2, "ground_ball").when(tax <= 4, "fly_ball")
         .when(tax <= 6, "line_drive").when(tax == 7, "popup").alias("bb_type"),
        F.when(F.col("l_returnflag") == "N", F.lit(None).cast("double"))
         .otherwise(q + 69.0).alias("launch_speed"),
        F.when(F.col("l_linenumber") == 6, F.lit(None).cast("double"))
         .otherwise((F.col("l_linenumber") * 9 - 12 + tax).cast("double")).alias("launch_angle"),
        (tax.cast("double") / 8.0).alias("estimated_woba_using_speedangle"),
        (q / 4.0 + 80.0).alias("release_speed"),
        F.when(F.col("l_linestatus") == "F", "R").otherwise("L").alias("p_throws"),
        F.when(F.col("l_returnflag") == "A", "L").when(F.col("l_returnflag") == "R", "R")
         .otherwise("S").alias("stand"),
        F.col("l_shipdate").alias("ship_ts"),
        F.element_at(F.array(*[F.lit(x) for x in PITCH_TYPES]),
                     (F.col("l_linenumber") % len(PITCH_TYPES) + 1).cast("int")).alias("pitch_type"),
        F.when(F.col("l_linenumber") <= 4, F.col("l_linenumber") * 2)
         .otherwise(F.col("l_linenumber") + 10).cast("int").alias("zone"),
        (tax.cast("double") / 16.0).alias("estimated_ba_using_speedangle"),
        (F.col("l_linenumber") / 8.0 + 6.0).alias("release_extension"))


DUCK_PITCHES = f"""pitches_v AS (
  SELECT l_orderkey AS game_pk, l_suppkey AS batter, l_suppkey AS pitcher,
         l_linenumber AS at_bat_number,
         CASE WHEN l_linestatus = 'F' THEN 'Top' ELSE 'Bot' END AS inning_topbot,
         CASE WHEN l_linenumber = 7 THEN NULL
              ELSE {_sql_list(EVENT_CYCLE)}[((CAST(l_quantity AS INTEGER) - 1) % {len(EVENT_CYCLE)}) + 1] END AS events,
         {_sql_list(DESCRIPTION_CYCLE)}[CAST(floor(l_discount * 100 + 0.5) AS INTEGER) + 1] AS description,
         CASE WHEN CAST(floor(l_tax * 100 + 0.5) AS INTEGER) <= 2 THEN 'ground_ball'
              WHEN CAST(floor(l_tax * 100 + 0.5) AS INTEGER) <= 4 THEN 'fly_ball'
              WHEN CAST(floor(l_tax * 100 + 0.5) AS INTEGER) <= 6 THEN 'line_drive'
              WHEN CAST(floor(l_tax * 100 + 0.5) AS INTEGER) = 7 THEN 'popup' END AS bb_type,
         CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_quantity + 69.0 END AS launch_speed,
         CASE WHEN l_linenumber = 6 THEN NULL
              ELSE CAST(l_linenumber * 9 - 12 + CAST(floor(l_tax * 100 + 0.5) AS INTEGER) AS DOUBLE) END AS launch_angle,
         CAST(CAST(floor(l_tax * 100 + 0.5) AS INTEGER) AS DOUBLE) / 8.0 AS estimated_woba_using_speedangle,
         l_quantity / 4.0 + 80.0 AS release_speed,
         CASE WHEN l_linestatus = 'F' THEN 'R' ELSE 'L' END AS p_throws,
         CASE WHEN l_returnflag = 'A' THEN 'L' WHEN l_returnflag = 'R' THEN 'R' ELSE 'S' END AS stand,
         l_shipdate AS ship_ts,
         {_sql_list(PITCH_TYPES)}[l_linenumber % {len(PITCH_TYPES)} + 1] AS pitch_type,
         CASE WHEN l_linenumber <= 4 THEN l_linenumber * 2 ELSE l_linenumber + 10 END AS zone,
         CAST(CAST(floor(l_tax * 100 + 0.5) AS INTEGER) AS DOUBLE) / 16.0 AS estimated_ba_using_speedangle,
         l_linenumber / 8.0 + 6.0 AS release_extension
  FROM lineitem)"""


# -------------------------------------------------------------- constants --
def constants_rows():
    """One row per season, built from a rule (3-decimal weights)."""
    rows = []
    for i, s in enumerate(range(FIRST_SEASON, LAST_SEASON + 1)):
        rows.append((s, 0.690 + 0.002 * i, 0.720 + 0.002 * i, 0.880 + 0.003 * i,
                     1.250 + 0.004 * i, 1.580 + 0.005 * i, 2.030 + 0.006 * i,
                     0.310 + 0.001 * i, 1.180 + 0.010 * i, 0.115 + 0.001 * i,
                     3.100 + 0.020 * i))
    return rows


CONST_COLS = ["season", "wbb", "whbp", "w1b", "w2b", "w3b", "whr", "lg_woba",
              "woba_scale", "lg_r_pa", "cfip"]


def constants(spark: SparkSession) -> DataFrame:
    schema = "season int, " + ", ".join(f"{c} decimal(10,3)" for c in CONST_COLS[1:])
    from decimal import Decimal
    rows = [(r[0], *[Decimal(f"{v:.3f}") for v in r[1:]]) for r in constants_rows()]
    return spark.createDataFrame(rows, schema)


def duck_constants() -> str:
    vals = ",\n    ".join(
        "(" + ", ".join([str(r[0])] + [f"CAST({v:.3f} AS DECIMAL(10,3))" for v in r[1:]]) + ")"
        for r in constants_rows())
    return f"constants_v AS (SELECT * FROM (VALUES\n    {vals}) AS t({', '.join(CONST_COLS)}))"


# ------------------------------------------------------------ park factors --
def park_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per (season, home team): 90 + games % 21 (home teams only)."""
    g = games(spark, sf_dir)
    return g.groupBy(F.year("game_date").alias("season"), F.col("home_team").alias("team")) \
        .agg((F.lit(90) + F.count(F.lit(1)) % 21).cast("decimal(10,3)").alias("basic"))


DUCK_PARKS = """parks_v AS (
  SELECT CAST(year(game_date) AS INTEGER) AS season, home_team AS team,
         CAST(90 + count(*) % 21 AS DECIMAL(10,3)) AS basic
  FROM games_v GROUP BY 1, 2)"""


# ----------------------------------------------------------- official lines --
def supplier_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One aggregate of lineitem per (supplier, ship year) from which the
    official lines, sprint speed and lineup position are projected: a query
    using several of them reuses one exchange instead of scanning again."""
    li = read(spark, sf_dir, "lineitem")
    ln, rf, ls, q = F.col("l_linenumber"), F.col("l_returnflag"), F.col("l_linestatus"), F.col("l_quantity")
    loaded = F.col("l_shipdate") < F.lit("2001-01-01").cast("timestamp_ntz")
    cnt = lambda cond: F.count_if(cond).cast("bigint")
    return li.groupBy(F.col("l_suppkey").alias("player_id"),
                      F.year("l_shipdate").alias("season")).agg(
        # pitching
        F.floor(F.sum("l_quantity") / 57).cast("bigint").alias("outs"),
        cnt((ln == 1) & (ls == "F")).alias("wins"),
        cnt((ln == 2) & (ls == "F")).alias("losses"),
        cnt((ln == 5) & (rf == "R")).alias("saves"),
        F.count(F.lit(1)).cast("bigint").alias("games_played"),
        cnt(ln == 1).alias("games_started"),
        cnt(F.col("l_discount") >= 0.06).alias("earned_runs"),
        cnt((ln == 3) & (rf == "A")).alias("holds"),
        cnt((ln == 4) & (rf == "A")).alias("blown_saves"),
        cnt(ln.isin(3, 4, 5) & (rf != "N")).alias("save_opps"),
        cnt(F.col("l_tax") >= 0.05).alias("inherited_runners"),
        cnt(F.col("l_tax") >= 0.07).alias("inherited_runners_scored"),
        cnt(F.col("l_discount") == 0.1).alias("wild_pitches"),
        cnt((ln == 1) & (q >= 48)).alias("complete_games"),
        cnt((ln == 1) & (q == 50)).alias("shutouts"),
        # batting, loaded for items shipped before 2001 only
        cnt(loaded).alias("plate_appearances"),
        cnt(loaded & (ln == 1) & (q >= 40)).alias("stolen_bases"),
        cnt(loaded & (ln == 2) & (q >= 45)).alias("caught_stealing"),
        cnt(loaded & (q >= 35)).alias("runs"),
        cnt(loaded & (q <= 12)).alias("rbi"),
        F.sum(F.when(loaded, (q / 10).cast("bigint"))).cast("bigint").alias("total_bases"),
        # speed and lineup
        (F.lit(25.0) + F.avg("l_discount") * 50).cast("decimal(5,2)").alias("sprint_speed"),
        (F.lit(4.5) - F.avg("l_tax") * 5).cast("decimal(5,2)").alias("hp_to_1b"),
        F.count_if(q == 50).cast("int").alias("bolts"),
        F.avg("l_linenumber").alias("avg_lineup_pos"))


_PITCHING_COLS = ["player_id", "season", "outs", "wins", "losses", "saves", "games_played",
                  "games_started", "earned_runs", "holds", "blown_saves", "save_opps",
                  "inherited_runners", "inherited_runners_scored", "wild_pitches",
                  "complete_games", "shutouts"]


def official_pitching(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per (supplier, ship year): official pitching line."""
    return supplier_year(spark, sf_dir).select(*_PITCHING_COLS)


DUCK_OFFICIAL_PITCHING = """official_v AS (
  SELECT l_suppkey AS player_id, CAST(year(l_shipdate) AS INTEGER) AS season,
         CAST(floor(sum(l_quantity) / 57) AS BIGINT) AS outs,
         count(*) FILTER (WHERE l_linenumber = 1 AND l_linestatus = 'F') AS wins,
         count(*) FILTER (WHERE l_linenumber = 2 AND l_linestatus = 'F') AS losses,
         count(*) FILTER (WHERE l_linenumber = 5 AND l_returnflag = 'R') AS saves,
         count(*) AS games_played,
         count(*) FILTER (WHERE l_linenumber = 1) AS games_started,
         count(*) FILTER (WHERE l_discount >= 0.06) AS earned_runs,
         count(*) FILTER (WHERE l_linenumber = 3 AND l_returnflag = 'A') AS holds,
         count(*) FILTER (WHERE l_linenumber = 4 AND l_returnflag = 'A') AS blown_saves,
         count(*) FILTER (WHERE l_linenumber IN (3, 4, 5) AND l_returnflag <> 'N') AS save_opps,
         count(*) FILTER (WHERE l_tax >= 0.05) AS inherited_runners,
         count(*) FILTER (WHERE l_tax >= 0.07) AS inherited_runners_scored,
         count(*) FILTER (WHERE l_discount = 0.1) AS wild_pitches,
         count(*) FILTER (WHERE l_linenumber = 1 AND l_quantity >= 48) AS complete_games,
         count(*) FILTER (WHERE l_linenumber = 1 AND l_quantity = 50) AS shutouts
  FROM lineitem GROUP BY 1, 2)"""


def official_batting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per (supplier, ship year): official batting extras, loaded for items
    shipped before 2001 only (the latest season is not loaded yet)."""
    return supplier_year(spark, sf_dir).where(F.col("plate_appearances") > 0).select(
        "player_id", "season", "plate_appearances", "stolen_bases", "caught_stealing", "runs",
        "rbi", "total_bases")


DUCK_OFFICIAL_BATTING = """official_b AS (
  SELECT l_suppkey AS player_id, CAST(year(l_shipdate) AS INTEGER) AS season,
         count(*) AS plate_appearances,
         count(*) FILTER (WHERE l_linenumber = 1 AND l_quantity >= 40) AS stolen_bases,
         count(*) FILTER (WHERE l_linenumber = 2 AND l_quantity >= 45) AS caught_stealing,
         count(*) FILTER (WHERE l_quantity >= 35) AS runs,
         count(*) FILTER (WHERE l_quantity <= 12) AS rbi,
         CAST(sum(CAST(trunc(l_quantity / 10) AS BIGINT)) AS BIGINT) AS total_bases
  FROM lineitem WHERE l_shipdate < TIMESTAMP '2001-01-01' GROUP BY 1, 2)"""


def duck_with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# --------------------------------------------------------------- people --
# FIXED VALUES (test mapping): primary position by nation key % 11.
POSITIONS = ["C", "1B", "2B", "3B", "SS", "LF", "CF", "RF", "DH", "OF", "P"]


def player_bio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """People records from ``supplier``: birth date and debut from keys,
    unknown for two nations."""
    s = read(spark, sf_dir, "supplier")
    nk, sk = F.col("s_nationkey"), F.col("s_suppkey")
    return s.select(
        sk.alias("player_id"), F.col("s_name").alias("full_name"),
        F.when(nk % 3 == 0, "L").when(nk % 3 == 1, "R").otherwise("S").alias("bat_side"),
        F.element_at(F.array(*[F.lit(x) for x in POSITIONS]), (nk % 11 + 1).cast("int"))
         .alias("primary_position"),
        F.when(nk == 0, F.lit(None).cast("date"))
         .otherwise(F.make_date((nk + 1962).cast("int"), (sk % 12 + 1).cast("int"),
                                (sk % 28 + 1).cast("int"))).alias("birth_date"),
        F.when(nk == 1, F.lit(None).cast("date"))
         .otherwise(F.make_date((sk % 10 + 1990).cast("int"), F.lit(4), F.lit(1)))
         .alias("mlb_debut_date"))


DUCK_BIO = f"""bio_v AS (
  SELECT s_suppkey AS player_id, s_name AS full_name,
         CASE WHEN s_nationkey % 3 = 0 THEN 'L' WHEN s_nationkey % 3 = 1 THEN 'R' ELSE 'S' END AS bat_side,
         {_sql_list(POSITIONS)}[s_nationkey % 11 + 1] AS primary_position,
         CASE WHEN s_nationkey = 0 THEN NULL
              ELSE make_date(CAST(s_nationkey + 1962 AS INTEGER), CAST(s_suppkey % 12 + 1 AS INTEGER),
                             CAST(s_suppkey % 28 + 1 AS INTEGER)) END AS birth_date,
         CASE WHEN s_nationkey = 1 THEN NULL
              ELSE make_date(CAST(s_suppkey % 10 + 1990 AS INTEGER), 4, 1) END AS mlb_debut_date
  FROM supplier)"""


# ---------------------------------------------------------- minor league --
def milb_batting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minor-league lines per (supplier, ship year, level, team): level from
    order priority, team from order status; an item stands for ten plate
    appearances."""
    li = read(spark, sf_dir, "lineitem")
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"])
    pr = F.substring("o_orderpriority", 1, 1)
    level = (F.when(pr == "1", "AAA").when(pr == "2", "AA").when(pr == "3", "High-A")
             .when(pr == "4", "Single-A").otherwise("Rookie"))
    q = F.col("l_quantity")
    cnt = lambda cond: (10 * F.count_if(cond)).cast("bigint")
    g = j.groupBy(F.col("l_suppkey").alias("player_id"), F.year("l_shipdate").alias("season"),
                  level.alias("level"), F.concat(F.lit("T"), F.col("o_orderstatus")).alias("team_name")) \
        .agg(cnt(F.lit(True)).alias("pa"), cnt(q >= 46).alias("hr"),
             cnt(q <= 5).alias("bb"), cnt((q > 5) & (q <= 15)).alias("so"),
             cnt(F.col("l_linenumber") == 1).alias("sb"), cnt(q >= 30).alias("hits"),
             cnt(q >= 40).alias("xbh"))
    ab = F.col("pa") - F.col("bb")
    from seamstat.functions.exprs import pg_round, ratio
    return g.withColumns({
        "avg": pg_round(ratio("hits", ab), 3).cast("double"),
        "obp": pg_round(ratio(F.col("hits") + F.col("bb"), "pa"), 3).cast("double"),
        "slg": pg_round(ratio(F.col("hits") + F.col("xbh") + 3 * F.col("hr"), ab), 3).cast("double"),
    }).withColumn("ops", F.col("obp") + F.col("slg"))


def _duck_milb() -> str:
    from seamstat.plans.oracle_sql import rdiv
    return f"""milb_raw AS (
  SELECT l_suppkey AS player_id, CAST(year(l_shipdate) AS INTEGER) AS season,
         CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'AAA' WHEN '2' THEN 'AA'
              WHEN '3' THEN 'High-A' WHEN '4' THEN 'Single-A' ELSE 'Rookie' END AS level,
         'T' || o_orderstatus AS team_name,
         10 * count(*) AS pa, 10 * count(*) FILTER (WHERE l_quantity >= 46) AS hr,
         10 * count(*) FILTER (WHERE l_quantity <= 5) AS bb,
         10 * count(*) FILTER (WHERE l_quantity > 5 AND l_quantity <= 15) AS so,
         10 * count(*) FILTER (WHERE l_linenumber = 1) AS sb,
         10 * count(*) FILTER (WHERE l_quantity >= 30) AS hits,
         10 * count(*) FILTER (WHERE l_quantity >= 40) AS xbh
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2, 3, 4),
milb_v AS (
  SELECT *, {rdiv('hits', 'pa - bb', 3)} AS avg, {rdiv('hits + bb', 'pa', 3)} AS obp,
         {rdiv('hits + xbh + 3 * hr', 'pa - bb', 3)} AS slg,
         {rdiv('hits + bb', 'pa', 3)} + {rdiv('hits + xbh + 3 * hr', 'pa - bb', 3)} AS ops
  FROM milb_raw)"""


DUCK_MILB = _duck_milb()


# ------------------------------------------- remaining matrix inputs (Spark) --
def sprint_speed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return supplier_year(spark, sf_dir).select(
        "player_id", "season", "sprint_speed", "hp_to_1b", "bolts",
        F.col("games_played").cast("int").alias("competitive_runs"))


def lineup_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    return supplier_year(spark, sf_dir).select(
        "player_id", "season", "avg_lineup_pos", F.col("games_played").cast("int").alias("games"))


def team_strength(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per (season, team): runs, OPS proxy and home runs of the team's
    plate appearances."""
    from seamstat.operators import stats
    pa = stats.plate_appearances(pitches(spark, sf_dir), games(spark, sf_dir), "batter")
    ev = F.col("events")
    return pa.groupBy("season", F.col("batter_team").alias("team")).agg(
        F.count_if(ev.isin("single", "double", "triple", "home_run")).cast("double").alias("team_runs"),
        (F.count_if(ev.isin("single", "double", "triple", "home_run", "walk")) /
         F.count(F.lit(1))).alias("team_ops"),
        F.count_if(ev == "home_run").cast("double").alias("team_hr"))


def milb_pitching(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minor-league pitching lines per (supplier, ship year, level, team)
    with per-nine rates and FIP; an item stands for three outs."""
    from seamstat.sources.landed_json import milb_pitching_rates
    li = read(spark, sf_dir, "lineitem")
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"])
    pr = F.substring("o_orderpriority", 1, 1)
    level = (F.when(pr == "1", "AAA").when(pr == "2", "AA").when(pr == "3", "High-A")
             .when(pr == "4", "Single-A").otherwise("Rookie"))
    q = F.col("l_quantity")
    g = j.groupBy(F.col("l_suppkey").alias("player_id"), F.year("l_shipdate").alias("season"),
                  level.alias("level"), F.concat(F.lit("T"), F.col("o_orderstatus")).alias("team_name")) \
        .agg(F.count(F.lit(1)).cast("double").alias("ip"), F.count_if(q >= 46).alias("hr"),
             F.count_if(q <= 5).alias("bb"), F.count_if((q > 5) & (q <= 20)).alias("so"),
             F.count_if(q >= 30).alias("hits"),
             F.count_if(F.col("l_tax") >= 0.06).alias("er"))
    from seamstat.functions.exprs import np_round
    g = g.withColumns({"era": np_round(F.col("er") * 9 / F.col("ip"), 2),
                       "whip": np_round((F.col("hits") + F.col("bb")) / F.col("ip"), 2)})
    return milb_pitching_rates(g, constants(spark).select("season", "cfip"))


def game_log_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One landed game-log document per line item (a pitching appearance)."""
    li = read(spark, sf_dir, "lineitem")
    q = F.col("l_quantity").cast("int")
    ip = F.concat((q / 6).cast("int").cast("string"), F.lit("."), (q % 3).cast("string"))
    er = F.when(F.col("l_returnflag") == "N", F.lit(None).cast("bigint")) \
        .otherwise((_idx(F.col("l_tax")) % 5).cast("bigint"))
    gs = F.when(F.col("l_linenumber") <= 2, 1).otherwise(0).cast("bigint")
    split = F.struct(F.struct(gs.alias("gamesStarted"), ip.alias("inningsPitched"),
                              er.alias("earnedRuns")).alias("stat"))
    doc = F.to_json(F.struct(F.array(F.struct(F.array(split).alias("splits"))).alias("stats")))
    return li.select(F.col("l_suppkey").alias("player_id"),
                     F.year("l_shipdate").cast("bigint").alias("season"), doc.alias("payload"))


def quality_starts_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    from seamstat.operators.aggs import quality_starts
    from seamstat.sources import landed_json as LJ
    from seamstat.sources.schemas import GAME_LOG_PAYLOAD
    log = LJ.flatten_game_log(LJ.parse(game_log_docs(spark, sf_dir), "payload", GAME_LOG_PAYLOAD))
    return quality_starts(log, "player_id", "season", "games_started", "innings", "earned_runs") \
        .withColumn("season", F.col("season").cast("int"))


def rosters(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read(spark, sf_dir, "supplier")
    return s.select(F.col("s_suppkey").alias("player_id"),
                    F.concat(F.lit("H"), (F.col("s_nationkey") % 5 + 1).cast("string")).alias("team"))


def matrix_inputs(spark: SparkSession, sf_dir: str) -> dict:
    """Every input of the feature matrices, derived from the driver tables
    (the advanced metrics are left to the matrices' single pitch pass)."""
    p, g = pitches(spark, sf_dir), games(spark, sf_dir)
    return {
        "pitches": p, "games": g, "constants": constants(spark),
        "parks": park_factors(spark, sf_dir),
        "official_batting": official_batting(spark, sf_dir),
        "official_pitching": official_pitching(spark, sf_dir),
        "player_bio": player_bio(spark, sf_dir), "sprint_speed": sprint_speed(spark, sf_dir),
        "lineup_position": lineup_position(spark, sf_dir),
        "team_strength": team_strength(spark, sf_dir),
        "milb_batting": milb_batting(spark, sf_dir), "milb_pitching": milb_pitching(spark, sf_dir),
        "quality_starts": quality_starts_table(spark, sf_dir),
    }

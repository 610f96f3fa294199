"""Driver queries: each reads the whole driver tables (through the
derivations in ``testdata``), runs engine operators, and has a DuckDB
oracle in ``ORACLE`` with the same column names and types."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seamstat.functions import codes as K
from seamstat.operators import stats
from seamstat.plans import testdata as T
from seamstat.plans.oracle_sql import rdiv, rint_div, round_dbl

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def _q(xs) -> str:
    return "(" + ", ".join(f"'{x}'" for x in xs) + ")"


def _dbl(df: DataFrame, cols) -> DataFrame:
    return df.withColumns({x: F.col(x).cast("double") for x in cols})


def _big(df: DataFrame, cols) -> DataFrame:
    return df.withColumns({x: F.col(x).cast("bigint") for x in cols})


# ------------------------------------------------------------ shared SQL --
def _duck_pa(role: str) -> str:
    team = ("CASE WHEN p.inning_topbot = 'Top' THEN g.away_team ELSE g.home_team END"
            if role == "batter" else
            "CASE WHEN p.inning_topbot = 'Top' THEN g.home_team ELSE g.away_team END")
    return f"""pa AS (
  SELECT p.{role}, CAST(year(g.game_date) AS BIGINT) AS season,
         {team} AS {role}_team, p.events, p.bb_type
  FROM pitches_v p JOIN games_v g ON g.game_pk = p.game_pk
  WHERE p.events IS NOT NULL AND p.events NOT IN {_q(K.NOT_A_PA)}
    AND g.game_type = 'R')"""


def _cnt(codes) -> str:
    return f"count(*) FILTER (WHERE events IN {_q(codes)})"


DUCK_BAT_COUNTS = f"""counts AS (
  SELECT batter, season,
         CASE WHEN grouping(batter_team) = 1 THEN 'TOT' ELSE batter_team END AS batter_team,
         CASE WHEN grouping(batter_team) = 1 THEN 'total' ELSE 'team' END AS split_type,
         count(*) AS pa,
         count(*) FILTER (WHERE events NOT IN {_q(K.NOT_AN_AT_BAT)}) AS ab,
         {_cnt(K.HIT)} AS h, {_cnt(K.SINGLE)} AS "1b", {_cnt(K.DOUBLE)} AS "2b",
         {_cnt(K.TRIPLE)} AS "3b", {_cnt(K.HOME_RUN)} AS hr, {_cnt(K.WALK)} AS bb,
         {_cnt(K.INTENT_WALK)} AS ibb, {_cnt(K.HIT_BY_PITCH)} AS hbp,
         {_cnt(K.STRIKEOUT)} AS k, {_cnt(K.SAC_FLY)} AS sf, {_cnt(K.SAC_BUNT)} AS sac,
         {_cnt(K.CATCHER_INTERF)} AS ci, {_cnt(K.GIDP)} AS gidp
  FROM pa GROUP BY GROUPING SETS ((batter, season, batter_team), (batter, season)))"""

COUNT_COLS = ["pa", "ab", "h", "1b", "2b", "3b", "hr", "bb", "ibb", "hbp", "k",
              "sf", "sac", "ci", "gidp"]
_CC = ", ".join(f'CAST("{c}" AS BIGINT) AS "{c}"' for c in COUNT_COLS)

# ------------------------------------------------------ counting rollup --
register_sql_counting = (T.duck_with(T.DUCK_GAMES, T.DUCK_PITCHES, _duck_pa("batter"),
                                     DUCK_BAT_COUNTS) +
                         f"SELECT batter, batter_team, split_type, season, {_CC} FROM counts")


@register("q_counting_rollup", register_sql_counting)
def q_counting_rollup(spark, sf_dir):
    """Filtered counts per batter-season-team plus total rows (DOM-01 core,
    AGG-01, AGG-03, FLT-01, JON-01, PRJ-06, SET-01)."""
    out = stats.batting_counts(T.pitches(spark, sf_dir), T.games(spark, sf_dir))
    return _big(out, ["season"]).select("batter", "batter_team", "split_type", "season",
                                        *COUNT_COLS)


# ------------------------------------------------------------ rate stats --
_TB = '("1b" + 2 * "2b" + 3 * "3b" + 4 * hr)'
_SLASH = (f"{rdiv('h', 'ab', 3)} AS avg, "
          f"{rdiv('h + bb + hbp', 'ab + bb + hbp + sf', 3)} AS obp, "
          f"{rdiv(_TB, 'ab', 3)} AS slg, "
          f"(CAST({rint_div('h + bb + hbp', 'ab + bb + hbp + sf', 3)} + "
          f"{rint_div(_TB, 'ab', 3)} AS DOUBLE) / 1000.0) AS ops")


@register("q_rate_stats", T.duck_with(T.DUCK_GAMES, T.DUCK_PITCHES, _duck_pa("batter"),
                                      DUCK_BAT_COUNTS) +
          f"SELECT batter, batter_team, split_type, season, {_CC}, {_SLASH} FROM counts")
def q_rate_stats(spark, sf_dir):
    """AVG / OBP / SLG / OPS with exact half-up decimal rounding (DOM-02,
    SCA-01, SCA-04)."""
    base = q_counting_rollup(spark, sf_dir)
    return _dbl(stats.slash_line(base), ["avg", "obp", "slg", "ops"])


# --------------------------------------------------------- batting stats --
def _duck_batting_final() -> str:
    W = {c: f"CAST(round(lc.{c} * 1000) AS BIGINT)" for c in T.CONST_COLS[1:]}
    n_int = (f"({W['wbb']} * (c.bb - c.ibb) + {W['whbp']} * c.hbp + {W['w1b']} * c.\"1b\" + "
             f"{W['w2b']} * c.\"2b\" + {W['w3b']} * c.\"3b\" + {W['whr']} * c.hr)")
    d = "(c.ab + c.bb - c.ibb + c.sf + c.hbp)"
    excess = f"({n_int} - {W['lg_woba']} * {d})"
    pf = "CAST(round(pf.basic) AS BIGINT)"
    wrc = rdiv(f"100 * 1000 * {excess} + {d} * {W['woba_scale']} * {W['lg_r_pa']} * (200 - {pf})",
               f"{d} * {W['woba_scale']} * {W['lg_r_pa']}", 0)
    slash = _SLASH.replace("h + bb", "c.h + c.bb")
    return f"""
SELECT c.batter, c.batter_team, c.split_type, c.season,
       {', '.join(f'CAST(c."{x}" AS BIGINT) AS "{x}"' for x in COUNT_COLS)},
       {rdiv('c.h', 'c.ab', 3)} AS avg,
       {rdiv('c.h + c.bb + c.hbp', 'c.ab + c.bb + c.hbp + c.sf', 3)} AS obp,
       {rdiv('(c."1b" + 2 * c."2b" + 3 * c."3b" + 4 * c.hr)', 'c.ab', 3)} AS slg,
       (CAST({rint_div('c.h + c.bb + c.hbp', 'c.ab + c.bb + c.hbp + c.sf', 3)} +
             {rint_div('(c."1b" + 2 * c."2b" + 3 * c."3b" + 4 * c.hr)', 'c.ab', 3)} AS DOUBLE) / 1000.0) AS ops,
       {rdiv(n_int, f'1000 * {d}', 3)} AS woba,
       {rdiv(f'{excess} * c.pa', f"{d} * {W['woba_scale']}", 1)} AS wraa,
       CASE WHEN c.split_type = 'team' THEN {wrc} END AS wrc_plus,
       CAST(CASE WHEN c.split_type = 'team' THEN pf.basic END AS DOUBLE) AS park_factor
FROM counts c
JOIN constants_v lc ON lc.season = c.season
LEFT JOIN parks_v pf ON pf.season = c.season AND pf.team = c.batter_team AND c.split_type = 'team'
""" if slash else ""


BAT_RATE_COLS = ["avg", "obp", "slg", "ops", "woba", "wraa", "wrc_plus", "park_factor"]


@register("q_batting_stats", T.duck_with(T.DUCK_GAMES, T.DUCK_PITCHES, T.duck_constants(),
                                         T.DUCK_PARKS, _duck_pa("batter"), DUCK_BAT_COUNTS) +
          _duck_batting_final())
def q_batting_stats(spark, sf_dir):
    """Full batting statistics (DOM-01..05, JON-02, JON-03): counts, slash
    line, wOBA, wRAA, park-adjusted wRC+ (team rows only)."""
    out = stats.batting_stats(T.pitches(spark, sf_dir), T.games(spark, sf_dir),
                              T.constants(spark), T.park_factors(spark, sf_dir))
    return _dbl(_big(out, ["season"]), BAT_RATE_COLS)


# --------------------------------------------------------------- pitching --
DUCK_PIT_COUNTS = f"""counts AS (
  SELECT pitcher, season,
         CASE WHEN grouping(pitcher_team) = 1 THEN 'TOT' ELSE pitcher_team END AS pitcher_team,
         CASE WHEN grouping(pitcher_team) = 1 THEN 'total' ELSE 'team' END AS split_type,
         count(*) AS tbf, {_cnt(K.HIT)} AS h, {_cnt(K.SINGLE)} AS "1b",
         {_cnt(K.DOUBLE)} AS "2b", {_cnt(K.TRIPLE)} AS "3b", {_cnt(K.HOME_RUN)} AS hr,
         {_cnt(K.WALK)} AS bb, {_cnt(K.INTENT_WALK)} AS ibb, {_cnt(K.HIT_BY_PITCH)} AS hbp,
         {_cnt(K.STRIKEOUT)} AS k, {_cnt(K.SAC_FLY)} AS sf, {_cnt(K.SAC_BUNT)} AS sac,
         count(*) FILTER (WHERE bb_type = 'fly_ball') AS fly_balls,
         {_cnt(K.ONE_OUT)} + 2 * {_cnt(K.TWO_OUTS)} + 3 * {_cnt(K.THREE_OUTS)} AS derived_outs
  FROM pa GROUP BY GROUPING SETS ((pitcher, season, pitcher_team), (pitcher, season))),
joined AS (
  SELECT c.*, m.outs AS official_outs, m.wins, m.losses, m.saves,
         m.games_played AS games, m.games_started, m.earned_runs
  FROM counts c JOIN official_v m ON m.player_id = c.pitcher AND m.season = c.season),
adj AS (
  SELECT *, official_outs - sum(derived_outs) OVER w AS diff, count(*) OVER w AS n_teams,
         row_number() OVER (PARTITION BY pitcher, season, split_type ORDER BY pitcher_team) AS rn
  FROM joined WINDOW w AS (PARTITION BY pitcher, season, split_type)),
lines AS (
  SELECT a.*, CAST(CASE WHEN split_type = 'team'
              THEN derived_outs + diff // n_teams + CASE WHEN rn <= diff % n_teams THEN 1 ELSE 0 END
              ELSE official_outs END AS BIGINT) AS outs
  FROM adj a)"""

PIT_COUNT_COLS = ["tbf", "h", "1b", "2b", "3b", "hr", "bb", "ibb", "hbp", "k", "sf", "sac"]
PIT_RATE_COLS = ["era", "k_pct", "bb_pct", "k_bb", "ba_against", "babip", "whip",
                 "k_9", "bb_9", "hr_9", "hr_fb", "fip"]
_OFFICIAL_COLS = ["wins", "losses", "saves", "games", "games_started"]


def _duck_pitching_select() -> str:
    cf = "CAST(round(lc.cfip * 1000) AS BIGINT)"
    core = "(13 * l.hr + 3 * (l.bb + l.hbp) - 2 * l.k)"
    off = ", ".join(f"CAST(CASE WHEN l.split_type = 'total' THEN l.{x} END AS BIGINT) AS {x}"
                    for x in _OFFICIAL_COLS)
    cnts = ", ".join(f'CAST(l."{x}" AS BIGINT) AS "{x}"' for x in PIT_COUNT_COLS)
    er = "CASE WHEN l.split_type = 'total' THEN l.earned_runs END"
    return f"""
SELECT l.pitcher, l.pitcher_team, l.split_type, l.season, {off},
       {cnts},
       (CAST(10 * (l.outs // 3) + l.outs % 3 AS DOUBLE) / 10.0) AS ip, l.outs,
       {rdiv(f'27 * ({er})', 'l.outs', 2)} AS era,
       {rdiv('100 * l.k', 'l.tbf', 1)} AS k_pct,
       {rdiv('100 * l.bb', 'l.tbf', 1)} AS bb_pct,
       {rdiv('l.k', 'l.bb', 2)} AS k_bb,
       {rdiv('l.h', 'l.tbf - l.bb - l.hbp - l.sf - l.sac', 3)} AS ba_against,
       {rdiv('l.h - l.hr', 'l.tbf - l.bb - l.hbp - l.sac - l.k - l.hr', 3)} AS babip,
       {rdiv('3 * (l.h + l.bb)', 'l.outs', 2)} AS whip,
       {rdiv('27 * l.k', 'l.outs', 2)} AS k_9,
       {rdiv('27 * l.bb', 'l.outs', 2)} AS bb_9,
       {rdiv('27 * l.hr', 'l.outs', 2)} AS hr_9,
       {rdiv('l.hr', 'l.fly_balls', 3)} AS hr_fb,
       {rdiv(f'3000 * {core} + {cf} * l.outs', '1000 * l.outs', 2)} AS fip
FROM lines l JOIN constants_v lc ON lc.season = l.season"""


_PIT_WITH = T.duck_with(T.DUCK_GAMES, T.DUCK_PITCHES, T.DUCK_OFFICIAL_PITCHING,
                        T.duck_constants(), _duck_pa("pitcher"), DUCK_PIT_COUNTS)


def _pitching(spark, sf_dir):
    out = stats.pitching_stats(T.pitches(spark, sf_dir), T.games(spark, sf_dir),
                               T.official_pitching(spark, sf_dir), T.constants(spark))
    return _dbl(_big(out, ["season"]), ["ip", *PIT_RATE_COLS])


@register("q_pitching_stats", _PIT_WITH + _duck_pitching_select())
def q_pitching_stats(spark, sf_dir):
    """Full pitching statistics, team and total rows (DOM-06..12, JON-04)."""
    return _pitching(spark, sf_dir)


@register("q_apportion", _PIT_WITH + """
SELECT pitcher, pitcher_team, season, CAST(derived_outs AS BIGINT) AS derived_outs,
       CAST(official_outs AS BIGINT) AS official_outs, outs
FROM lines WHERE split_type = 'team'""")
def q_apportion(spark, sf_dir):
    """Official outs apportioned to team rows (DOM-07, WIN-01..03, SCA-05);
    negative differences keep their truncating remainder."""
    counts = stats.pitching_counts(T.pitches(spark, sf_dir), T.games(spark, sf_dir))
    off = T.official_pitching(spark, sf_dir).select(
        F.col("player_id").alias("pitcher"), "season", F.col("outs").alias("official_outs"))
    df = stats.apportion_outs(counts.join(off, ["pitcher", "season"], "inner"))
    return _big(df.where(F.col("split_type") == "team"), ["season", "derived_outs", "official_outs"]) \
        .select("pitcher", "pitcher_team", "season", "derived_outs", "official_outs", "outs")


@register("q_innings_notation", _PIT_WITH + """,
full_lines AS (""" + _duck_pitching_select() + """)
SELECT pitcher, pitcher_team, split_type, season, outs, ip, era, whip, k_9, bb_9, hr_9, fip
FROM full_lines""")
def q_innings_notation(spark, sf_dir):
    """Innings notation and per-nine rates, FIP (DOM-08, DOM-09, DOM-12)."""
    return _pitching(spark, sf_dir).select(
        "pitcher", "pitcher_team", "split_type", "season", "outs", "ip", "era", "whip",
        "k_9", "bb_9", "hr_9", "fip")


@register("q_pitch_rates", _PIT_WITH + """,
full_lines AS (""" + _duck_pitching_select() + """)
SELECT pitcher, pitcher_team, split_type, season, tbf, k_pct, bb_pct, k_bb,
       ba_against, babip, hr_fb
FROM full_lines""")
def q_pitch_rates(spark, sf_dir):
    """K%, BB%, K/BB, BA against, BABIP, HR/FB (DOM-10, DOM-11)."""
    return _pitching(spark, sf_dir).select(
        "pitcher", "pitcher_team", "split_type", "season", "tbf", "k_pct", "bb_pct",
        "k_bb", "ba_against", "babip", "hr_fb")


# ----------------------------------------------------------------- splits --
from seamstat.functions.codes import BARREL_TIERS  # noqa: E402
from seamstat.operators import features as FT  # noqa: E402
from seamstat.operators import splits as SP  # noqa: E402

_SEASON_PITCHES = """sp AS (
  SELECT p.*, CAST(year(g.game_date) AS BIGINT) AS season, month(g.game_date) AS mon
  FROM pitches_v p JOIN games_v g ON g.game_pk = p.game_pk WHERE g.game_type = 'R')"""


def _duck_whiff(mask: str) -> str:
    return rdiv(f"count(*) FILTER (WHERE {mask} AND description IN {_q(K.WHIFF)})",
                f"count(*) FILTER (WHERE {mask} AND description IN {_q(K.SWING)})", 3)


def _duck_avg(mask: str, x: str, n: int) -> str:
    return round_dbl(f"avg({x}) FILTER (WHERE {mask})", n)


def _duck_barrel() -> str:
    conds = " OR ".join(f"(launch_speed >= {s} AND launch_angle BETWEEN {lo} AND {hi})"
                        for s, lo, hi in BARREL_TIERS)
    return f"(CASE WHEN {conds} THEN 1 ELSE 0 END)"


def _platoon_sql() -> str:
    parts = []
    for s in ("L", "R"):
        m = f"p_throws = '{s}'"
        parts += [f"CAST(nullif(count(*) FILTER (WHERE {m}), 0) AS BIGINT) AS pitches_vs_{s}",
                  f"{_duck_avg(m + ' AND launch_speed IS NOT NULL', 'launch_speed', 1)} AS ev_vs_{s}",
                  f"{_duck_avg(m + ' AND launch_speed IS NOT NULL', 'estimated_woba_using_speedangle', 3)} AS xwoba_vs_{s}",
                  f"{_duck_whiff(m)} AS whiff_vs_{s}"]
    return ",\n       ".join(parts)


def _half_sql() -> str:
    parts = []
    for h, m in (("h1", "NOT coalesce(mon >= 7, false)"), ("h2", "coalesce(mon >= 7, false)")):
        t = m + " AND launch_speed IS NOT NULL"
        parts += [f"{_duck_avg(t, 'launch_speed', 1)} AS ev_{h}",
                  f"{_duck_avg(t, 'estimated_woba_using_speedangle', 3)} AS xwoba_{h}",
                  f"{_duck_avg(t, _duck_barrel(), 3)} AS barrel_{h}",
                  f"{_duck_whiff(m)} AS whiff_{h}"]
    return ",\n       ".join(parts)


_PLATOON_COLS = [f"{a}_vs_{s}" for s in ("L", "R") for a in ("pitches", "ev", "xwoba", "whiff")]
_HALF_COLS = [f"{a}_{h}" for h in ("h1", "h2") for a in ("ev", "xwoba", "barrel", "whiff")]


@register("q_platoon_pivot", T.duck_with(T.DUCK_GAMES, T.DUCK_PITCHES, _SEASON_PITCHES) + f"""
SELECT player_id, season, {', '.join(_PLATOON_COLS)},
       xwoba_vs_L - xwoba_vs_R AS xwoba_platoon_gap, whiff_vs_L - whiff_vs_R AS whiff_platoon_gap
FROM (SELECT batter AS player_id, season,
       {_platoon_sql()}
      FROM sp GROUP BY batter, season) t""")
def q_platoon_pivot(spark, sf_dir):
    """Platoon splits pivoted to columns with L-R gaps (DOM-13, JON-07,
    AGG-05, AGG-06)."""
    f = SP.hitter_split_features(T.pitches(spark, sf_dir), T.games(spark, sf_dir))
    return _big(f, ["season"]).select("player_id", "season", *_PLATOON_COLS,
                                      "xwoba_platoon_gap", "whiff_platoon_gap")


@register("q_half_trend", T.duck_with(T.DUCK_GAMES, T.DUCK_PITCHES, _SEASON_PITCHES) + f"""
SELECT player_id, season, {', '.join(_HALF_COLS)},
       ev_h2 - ev_h1 AS ev_trend, xwoba_h2 - xwoba_h1 AS xwoba_trend,
       barrel_h2 - barrel_h1 AS barrel_trend, whiff_h2 - whiff_h1 AS whiff_trend
FROM (SELECT batter AS player_id, season,
       {_half_sql()}
      FROM sp GROUP BY batter, season) t""")
def q_half_trend(spark, sf_dir):
    """Half-season splits (month <= 6 vs >= 7) and H2-H1 trends (DOM-14,
    SCA-07, FLT-08 inside)."""
    f = SP.hitter_split_features(T.pitches(spark, sf_dir), T.games(spark, sf_dir))
    return _big(f, ["season"]).select("player_id", "season", *_HALF_COLS, "ev_trend",
                                      "xwoba_trend", "barrel_trend", "whiff_trend")


def _pitcher_split_sql() -> str:
    parts = []
    for s in ("L", "R"):
        m = f"stand = '{s}'"
        t = m + " AND launch_speed IS NOT NULL"
        parts += [f"CAST(nullif(count(*) FILTER (WHERE {m}), 0) AS BIGINT) AS vs{s}_pitches",
                  f"{_duck_avg(t, 'launch_speed', 1)} AS vs{s}_exit_velo",
                  f"{_duck_avg(t, 'estimated_woba_using_speedangle', 3)} AS vs{s}_xwoba",
                  f"{_duck_whiff(m)} AS vs{s}_whiff_rate"]
    for h, m in (("h1", "coalesce(mon <= 6, false)"), ("h2", "NOT coalesce(mon <= 6, false)")):
        t = m + " AND launch_speed IS NOT NULL"
        parts += [f"{_duck_avg(m, 'release_speed', 1)} AS velo_{h}",
                  f"{_duck_avg(t, 'launch_speed', 1)} AS ev_{h}",
                  f"{_duck_avg(t, 'estimated_woba_using_speedangle', 3)} AS xwoba_{h}",
                  f"{_duck_whiff(m)} AS whiff_{h}"]
    return ",\n       ".join(parts)


_PSPLIT_COLS = ([f"vs{s}_{a}" for s in ("L", "R") for a in ("pitches", "exit_velo", "xwoba", "whiff_rate")] +
                [f"{a}_{h}" for h in ("h1", "h2") for a in ("velo", "ev", "xwoba", "whiff")])


@register("q_pitcher_splits", T.duck_with(T.DUCK_GAMES, T.DUCK_PITCHES, _SEASON_PITCHES) + f"""
SELECT player_id, season, {', '.join(_PSPLIT_COLS)},
       vsR_xwoba - vsL_xwoba AS platoon_xwoba_gap, vsR_whiff_rate - vsL_whiff_rate AS platoon_whiff_gap,
       vsR_exit_velo - vsL_exit_velo AS platoon_ev_gap, velo_h2 - velo_h1 AS velo_trend,
       ev_h2 - ev_h1 AS ev_trend, xwoba_h2 - xwoba_h1 AS xwoba_trend, whiff_h2 - whiff_h1 AS whiff_trend
FROM (SELECT pitcher AS player_id, season,
       {_pitcher_split_sql()}
      FROM sp GROUP BY pitcher, season) t""")
def q_pitcher_splits(spark, sf_dir):
    """Pitcher platoon (batter side, R-L gaps) and half-season velocity /
    contact / whiff splits (DOM-13, DOM-14 for pitchers)."""
    f = SP.pitcher_split_features(T.pitches(spark, sf_dir), T.games(spark, sf_dir))
    return _big(f, ["season"]).select(
        "player_id", "season", *_PSPLIT_COLS, "platoon_xwoba_gap", "platoon_whiff_gap",
        "platoon_ev_gap", "velo_trend", "ev_trend", "xwoba_trend", "whiff_trend")


# ------------------------------------------------------- tiered indicator --
@register("q_tiered_indicator", T.duck_with(T.DUCK_GAMES, T.DUCK_PITCHES, _SEASON_PITCHES) + f"""
SELECT batter AS player_id, season,
       count(*) FILTER (WHERE launch_speed IS NOT NULL) AS tracked,
       CAST(sum({_duck_barrel()}) FILTER (WHERE launch_speed IS NOT NULL) AS BIGINT) AS barrels,
       {_duck_avg('launch_speed IS NOT NULL', _duck_barrel(), 3)} AS barrel_rate
FROM sp GROUP BY batter, season""")
def q_tiered_indicator(spark, sf_dir):
    """Barrel indicator over 13 speed x angle tiers and its rate over
    tracked balls (FLT-08, AGG-07); unknown angle counts as 0."""
    from seamstat.functions.exprs import is_barrel, pg_round_double
    from seamstat.operators.aggs import rate_when
    p = T.pitches(spark, sf_dir)
    g = stats.regular_games(T.games(spark, sf_dir)).select("game_pk", "game_date")
    df = p.join(g, "game_pk").withColumn("season", F.year("game_date").cast("bigint"))
    tracked = F.col("launch_speed").isNotNull()
    b = is_barrel(F.col("launch_speed"), F.col("launch_angle"))
    return df.groupBy(F.col("batter").alias("player_id"), "season").agg(
        F.count_if(tracked).cast("bigint").alias("tracked"),
        F.sum(F.when(tracked, b.cast("int"))).cast("bigint").alias("barrels"),
        pg_round_double(rate_when(b, tracked), 3).alias("barrel_rate"))


# ------------------------------------------------------ feature operators --
_BAT_WITH = (T.duck_with(T.DUCK_GAMES, T.DUCK_PITCHES, T.duck_constants(), T.DUCK_PARKS,
                         _duck_pa("batter"), DUCK_BAT_COUNTS) +
             ", bat_lines AS (" + _duck_batting_final() + ")")


def _bat_totals(spark, sf_dir, min_pa: int | None = K.MIN_PA):
    """Total batting rows per player-season (doubles), optionally qualified."""
    b = stats.batting_stats(T.pitches(spark, sf_dir), T.games(spark, sf_dir),
                            T.constants(spark), T.park_factors(spark, sf_dir))
    b = b.where(F.col("split_type") == "total")
    if min_pa is not None:
        b = b.where(F.col("pa") >= min_pa)
    b = b.withColumnRenamed("batter", "player_id").drop("batter_team", "split_type",
                                                        "park_factor", "wrc_plus")
    return _dbl(_big(b, ["season"]), ["avg", "obp", "slg", "ops", "woba", "wraa"])


_REG = K.HITTER_RELIABILITY


@register("q_regress_to_mean", _BAT_WITH + """,
bt AS (SELECT batter AS player_id, season, pa, avg, obp, slg, ops, woba,
              slg - avg AS iso, bb / pa AS bb_rate, k / pa AS k_rate
       FROM bat_lines WHERE split_type = 'total' AND pa >= 50),
lg AS (SELECT season, """ + ", ".join(f"avg({s}) AS lg_{s}" for s in _REG) + """
       FROM bt GROUP BY season)
SELECT bt.player_id, bt.season, bt.pa, """ + ",\n       ".join(
    f"round((bt.pa * bt.{s} + {float(k)} * lg.lg_{s}) / (bt.pa + {float(k)}), 6) AS {s}_regressed"
    for s, k in _REG.items()) + """
FROM bt JOIN lg ON lg.season = bt.season""")
def q_regress_to_mean(spark, sf_dir):
    """Shrink rates toward the season mean of qualified rows with a
    per-stat sample size (DOM-15, JON-13, AGG-08, FLT-05)."""
    b = _bat_totals(spark, sf_dir)
    b = b.withColumns({"iso": F.col("slg") - F.col("avg"),
                       "bb_rate": F.col("bb") / F.col("pa"),
                       "k_rate": F.col("k") / F.col("pa")})
    out = FT.regress_to_mean(b, "pa", _REG)
    return out.select("player_id", "season", "pa",
                      *[F.round(f"{s}_regressed", 6).alias(f"{s}_regressed") for s in _REG])


_CUST_SEASON = """cs AS (
  SELECT o_custkey AS player_id, CAST(year(o_orderdate) AS BIGINT) AS season,
         CAST(count(*) AS DOUBLE) AS lines, CAST(sum(l_quantity) AS DOUBLE) AS qty,
         CAST(nullif(count(*) FILTER (WHERE l_returnflag = 'R'), 0) AS DOUBLE) AS returns
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2)"""


def _cust_season(spark, sf_dir):
    o = T.read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    li = T.read(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_returnflag")
    j = o.join(li, o["o_orderkey"] == li["l_orderkey"])
    return j.groupBy(F.col("o_custkey").alias("player_id"),
                     F.year("o_orderdate").cast("bigint").alias("season")).agg(
        F.count(F.lit(1)).cast("double").alias("lines"),
        F.sum("l_quantity").cast("double").alias("qty"),
        F.nullif(F.count_if(F.col("l_returnflag") == "R"), F.lit(0)).cast("double").alias("returns"))


def _duck_roll(x: str) -> str:
    w = "OVER (PARTITION BY player_id ORDER BY season)"
    two = f"(lag({x}, 1) {w} * 1.0 + {x} * 2.0) / 3.0"
    three = f"(lag({x}, 2) {w} * 1.0 + lag({x}, 1) {w} * 2.0 + {x} * 3.0) / 6.0"
    rn = f"row_number() {w}"
    return (f"CASE WHEN {rn} = 1 THEN {x} ELSE {two} END AS {x}_2yr, "
            f"CASE WHEN {rn} = 1 THEN {x} WHEN {rn} = 2 THEN {two} ELSE {three} END AS {x}_3yr")


@register("q_rolling_wavg", T.duck_with(_CUST_SEASON) + f"""
SELECT player_id, season, lines, qty, returns,
       {_duck_roll('lines')}, {_duck_roll('qty')}, {_duck_roll('returns')}
FROM cs""")
def q_rolling_wavg(spark, sf_dir):
    """2- and 3-row linearly weighted rolling means per entity over seasons
    with gaps; a null in the frame gives null (DOM-16, WIN-04, WIN-05)."""
    return FT.rolling_features(_cust_season(spark, sf_dir), ["lines", "qty", "returns"]) \
        .select("player_id", "season", "lines", "qty", "returns",
                *[f"{x}_{n}yr" for x in ("lines", "qty", "returns") for n in (2, 3)])


_TEAM_ROWS = """tr AS (SELECT batter AS player_id, season, batter_team AS team, pa, h, hr
       FROM counts WHERE split_type = 'team'),
ts AS (SELECT season, team, CAST(sum(h) AS DOUBLE) AS team_runs, CAST(sum(hr) AS DOUBLE) AS team_hr
       FROM tr GROUP BY season, team)"""


# Team strength of a season from the batters' plate appearances.
_STRENGTH_SQL = f"""ts AS (
  SELECT season, batter_team AS team, CAST(count(*) FILTER (WHERE events IN {_q(K.HIT)}) AS DOUBLE) AS team_runs,
         count(*) FILTER (WHERE events IN ('single', 'double', 'triple', 'home_run', 'walk')) / CAST(count(*) AS DOUBLE) AS team_ops,
         CAST(count(*) FILTER (WHERE events = 'home_run') AS DOUBLE) AS team_hr
  FROM pa GROUP BY 1, 2)"""


def _team_rows(spark, sf_dir):
    c = stats.batting_counts(T.pitches(spark, sf_dir), T.games(spark, sf_dir)) \
        .where(F.col("split_type") == "team")
    return c.select(F.col("batter").alias("player_id"), F.col("season").cast("bigint").alias("season"),
                    F.col("batter_team").alias("team"), "pa", "h", "hr")


@register("q_weighted_context", _BAT_WITH + ", " + _TEAM_ROWS + """,
wpf AS (SELECT tr.player_id, tr.season,
               sum(CASE WHEN pf.basic IS NOT NULL THEN CAST(pf.basic AS DOUBLE) * tr.pa END) /
               sum(CASE WHEN pf.basic IS NOT NULL THEN CAST(tr.pa AS DOUBLE) END) AS pf_raw,
               sum(CASE WHEN pf.basic IS NOT NULL THEN CAST(tr.pa AS DOUBLE) END) AS pf_w,
               sum(ts.team_runs * tr.pa) / sum(CAST(tr.pa AS DOUBLE)) AS team_runs,
               sum(ts.team_hr * tr.pa) / sum(CAST(tr.pa AS DOUBLE)) AS team_hr
        FROM tr LEFT JOIN parks_v pf ON pf.season = tr.season AND pf.team = tr.team
                LEFT JOIN ts ON ts.season = tr.season AND ts.team = tr.team
        GROUP BY tr.player_id, tr.season)
SELECT w.player_id, w.season, CASE WHEN w.pf_w > 0 THEN w.pf_raw END AS park_factor,
       w.team_runs, w.team_hr, b.slg,
       b.slg * (100.0 / CASE WHEN (CASE WHEN w.pf_w > 0 THEN w.pf_raw END) = 0 THEN 100
                             ELSE (CASE WHEN w.pf_w > 0 THEN w.pf_raw END) END) AS slg_park_adj
FROM wpf w JOIN bat_lines b ON b.batter = w.player_id AND b.season = w.season AND b.split_type = 'total'""")
def q_weighted_context(spark, sf_dir):
    """Playing-time-weighted park factor and team strength over a player's
    teams, and a park-adjusted rate (DOM-21, AGG-09, DOM-22)."""
    from seamstat.plans.matrices import materialize
    lines = materialize(_big(stats.batting_stats(
        T.pitches(spark, sf_dir), T.games(spark, sf_dir), T.constants(spark), T.park_factors(spark, sf_dir)),
        ["season"]), "batting_lines")
    tr = lines.where("split_type = 'team'").select(F.col("batter").alias("player_id"), "season",
                                                   F.col("batter_team").alias("team"), "pa", "h", "hr")
    parks = T.park_factors(spark, sf_dir).select(F.col("season").cast("bigint").alias("season"), "team",
                                                 F.col("basic").cast("double").alias("park_factor"))
    strength = tr.groupBy("season", "team").agg(F.sum("h").cast("double").alias("team_runs"),
                                                F.sum("hr").cast("double").alias("team_hr"))
    context = FT.weighted_context(tr, parks.join(strength, ["season", "team"], "full_outer"),
                                  ["park_factor", "team_runs", "team_hr"], "pa")
    tot = lines.where("split_type = 'total'").select(F.col("batter").alias("player_id"), "season",
                                                     F.col("slg").cast("double").alias("slg"))
    out = context.join(tot, ["player_id", "season"])
    return FT.park_adjusted(out, {"slg_park_adj": "slg"}).select(
        "player_id", "season", "park_factor", "team_runs", "team_hr", "slg", "slg_park_adj")


@register("q_team_string", T.duck_with(T.DUCK_GAMES, T.DUCK_PITCHES, _duck_pa("batter"),
                                       DUCK_BAT_COUNTS) + """
SELECT batter AS player_id, season, string_agg(batter_team, '/' ORDER BY pa DESC, batter_team) AS team,
       count(*) AS n_teams
FROM counts WHERE split_type = 'team' GROUP BY batter, season""")
def q_team_string(spark, sf_dir):
    """Team codes ordered by playing time, descending, ties by name
    (AGG-10)."""
    tr = _team_rows(spark, sf_dir)
    return FT.team_string(tr, "team", "pa", count="n_teams")


# ------------------------------------------------------------ minor league --
def _milb_feats(spark, sf_dir):
    return _big(FT.milb_hitter_features(T.milb_batting(spark, sf_dir)), ["season"])


_DUCK_BEST = T.DUCK_MILB + f""",
best AS (
  SELECT * FROM (
    SELECT m.*, row_number() OVER (PARTITION BY player_id, season ORDER BY
             coalesce(CASE level WHEN 'AAA' THEN 1 WHEN 'AA' THEN 2 WHEN 'High-A' THEN 3
                                 WHEN 'Single-A' THEN 4 END, 99), pa DESC, team_name) AS rk
    FROM milb_v m WHERE pa >= {K.MILB_MIN_PA}) t WHERE rk = 1),
mf AS (
  SELECT player_id, CAST(season AS BIGINT) AS season,
         CAST(pa AS DOUBLE) AS milb_pa, avg AS milb_avg, obp AS milb_obp, slg AS milb_slg,
         ops AS milb_ops, slg - avg AS milb_iso, bb / CAST(pa AS DOUBLE) AS milb_bb_rate,
         so / CAST(pa AS DOUBLE) AS milb_k_rate, hr / CAST(pa AS DOUBLE) AS milb_hr_rate,
         sb / CAST(pa AS DOUBLE) AS milb_sb_rate
  FROM best)"""


@register("q_best_level", T.duck_with(_DUCK_BEST) + "SELECT * FROM mf")
def q_best_level(spark, sf_dir):
    """Highest minor-league level per player-season (AAA first, then more
    PA, then team name) and its rates (WIN-06, DOM-23, SCA-13, FLT-05)."""
    return _milb_feats(spark, sf_dir)


@register("q_prior_year_fill", _BAT_WITH + ", " + _DUCK_BEST + """,
base AS (SELECT batter AS player_id, season FROM bat_lines WHERE split_type = 'total')
SELECT b.player_id, b.season, """ + ", ".join(
    f"coalesce(s.{c}, p.{c}) AS {c}" for c in K.HITTER_MILB_FILL) + """
FROM base b
LEFT JOIN mf s ON s.player_id = b.player_id AND s.season = b.season
LEFT JOIN mf p ON p.player_id = b.player_id AND p.season + 1 = b.season""")
def q_prior_year_fill(spark, sf_dir):
    """Same-season minor-league values, else the prior season's, column by
    column (JON-09, PRJ-08, SCA-11, T11)."""
    base = _bat_totals(spark, sf_dir, None).select("player_id", "season")
    return FT.with_milb(base, _milb_feats(spark, sf_dir), K.HITTER_MILB_FILL) \
        .select("player_id", "season", *K.HITTER_MILB_FILL)


# -------------------------------------------------------------- year pairs --
@register("q_year_pairs", T.duck_with(_CUST_SEASON) + """,
latest AS (SELECT max(season) AS l FROM cs)
SELECT c.player_id, c.season, c.lines, c.qty, n.lines AS next_lines, n.qty AS next_qty,
       CASE WHEN c.season <= (SELECT l FROM latest) - 2 THEN 'train'
            WHEN c.season = (SELECT l FROM latest) - 1 THEN 'test' ELSE 'other' END AS split
FROM cs c JOIN cs n ON n.player_id = c.player_id AND n.season - 1 = c.season""")
def q_year_pairs(spark, sf_dir):
    """Season N rows with season N+1 outcomes (inner self-join), labelled
    train (<= latest-2) or test (latest-1) (JON-08, MLO-01, MLO-02)."""
    from seamstat.operators.modeling import season_split
    cs = _cust_season(spark, sf_dir)
    from seamstat.operators.joins import year_pairs
    pairs = year_pairs(cs, ["lines", "qty"], "player_id", "season")
    return season_split(pairs, cs).select("player_id", "season", "lines", "qty",
                                          "next_lines", "next_qty", "split")


# --------------------------------------------------------------- age curve --
@register("q_age_curve", _BAT_WITH + ", " + T.DUCK_BIO + ", " + T.DUCK_OFFICIAL_BATTING + """,
base AS (
  SELECT b.batter AS player_id, b.season, b."3b", b.pa, o.stolen_bases AS sb,
         bio.primary_position, bio.birth_date, bio.mlb_debut_date
  FROM bat_lines b LEFT JOIN bio_v bio ON bio.player_id = b.batter
  LEFT JOIN official_b o ON o.player_id = b.batter AND o.season = b.season
  WHERE b.split_type = 'total'),
a AS (
  SELECT *, CAST(CASE WHEN season - year(mlb_debut_date) < 0 THEN 0
                      ELSE season - year(mlb_debut_date) END AS BIGINT) AS years_experience,
         date_diff('day', birth_date, make_date(CAST(season AS INTEGER), 7, 1)) / 365.25 AS age,
         CAST(sb + "3b" AS DOUBLE) / CAST(pa AS DOUBLE) AS speed_proxy,
         coalesce(CASE primary_position """ + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in K.POSITION_GROUP.items()) + """ END, 'other') AS pos_group
  FROM base)
SELECT player_id, season, years_experience, age, age - 27.0 AS age_from_peak,
       (age - 27.0) * (age - 27.0) AS age_from_peak_sq,
       CAST(coalesce(age > 28, false) AS INTEGER) AS post_peak,
       (age - 27.0) * speed_proxy AS age_speed, pos_group,
       CAST(coalesce(primary_position = 'C', false) AS INTEGER) AS is_catcher,
       (age - 27.0) * CAST(coalesce(primary_position = 'C', false) AS INTEGER) AS age_catcher,
       CAST(pos_group = 'speed_pos' AS INTEGER) AS is_speed_pos,
       (age - 27.0) * CAST(pos_group = 'speed_pos' AS INTEGER) AS age_speed_pos
FROM a""")
def q_age_curve(spark, sf_dir):
    """Experience, age at July 1, aging-curve terms and position groups
    (DOM-19, DOM-20, SCA-08, SCA-09, SCA-10, SCA-14, JON-06)."""
    b = _bat_totals(spark, sf_dir, None).select("player_id", "season", "3b", "pa")
    ob = T.official_batting(spark, sf_dir).select(
        "player_id", F.col("season").cast("bigint").alias("season"), F.col("stolen_bases").alias("sb"))
    bio = T.player_bio(spark, sf_dir).select("player_id", "primary_position", "birth_date",
                                             "mlb_debut_date")
    df = b.join(bio, "player_id", "left").join(ob, ["player_id", "season"], "left")
    df = FT.experience(df).withColumn("years_experience", F.col("years_experience").cast("bigint"))
    df = df.withColumn("speed_proxy", (F.col("sb") + F.col("3b")).cast("double") / F.col("pa").cast("double"))
    df = FT.age_curve(df, "hitter")
    return df.select("player_id", "season", "years_experience", "age", "age_from_peak",
                     "age_from_peak_sq", "post_peak", "age_speed", "pos_group", "is_catcher",
                     "age_catcher", "is_speed_pos", "age_speed_pos")


# --------------------------------------------------------- quality starts --
_game_log_json = T.game_log_docs


@register("q_quality_events", """
WITH log AS (
  SELECT l_suppkey AS player_id, CAST(year(l_shipdate) AS BIGINT) AS season,
         CASE WHEN l_linenumber <= 2 THEN 1 ELSE 0 END AS gs,
         CAST(CAST(CAST(l_quantity AS INTEGER) // 6 AS VARCHAR) || '.' ||
              CAST(CAST(l_quantity AS INTEGER) % 3 AS VARCHAR) AS DOUBLE) AS ip,
         CASE WHEN l_returnflag = 'N' THEN NULL
              ELSE CAST(floor(l_tax * 100 + 0.5) AS INTEGER) % 5 END AS er
  FROM lineitem)
SELECT player_id, season, count(*) FILTER (WHERE gs >= 1) AS games_started,
       count(*) FILTER (WHERE gs >= 1 AND ip >= 6.0 AND coalesce(er, 99) <= 3) AS quality_starts
FROM log GROUP BY player_id, season""")
def q_quality_events(spark, sf_dir):
    """Landed game logs flattened, then starts and quality starts (6+
    innings, <= 3 earned, missing earned runs = 99) per entity-season
    (SRC-08, DOM-26, AGG-14)."""
    from seamstat.operators.aggs import quality_starts
    from seamstat.sources import landed_json as LJ
    from seamstat.sources.schemas import GAME_LOG_PAYLOAD
    docs = LJ.parse(_game_log_json(spark, sf_dir), "payload", GAME_LOG_PAYLOAD)
    log = LJ.flatten_game_log(docs)
    return quality_starts(log, "player_id", "season", "games_started", "innings", "earned_runs")


# -------------------------------------------------------------- keys / ids --
@register("q_missing_keys", T.duck_with(T.DUCK_GAMES, T.DUCK_PITCHES, _duck_pa("batter"),
                                        T.DUCK_OFFICIAL_BATTING) + """
SELECT DISTINCT batter AS player_id, season FROM pa
WHERE NOT EXISTS (SELECT 1 FROM official_b o WHERE o.player_id = pa.batter AND o.season = pa.season)""")
def q_missing_keys(spark, sf_dir):
    """Player-seasons seen in regular-season plate appearances but absent
    from the official lines (DOM-31, JON-10, SET-04, AGG-11)."""
    from seamstat.operators.joins import missing_keys
    pa = stats.plate_appearances(T.pitches(spark, sf_dir), T.games(spark, sf_dir), "batter") \
        .select(F.col("batter").alias("player_id"), F.col("season").cast("bigint").alias("season"))
    have = T.official_batting(spark, sf_dir).select(
        "player_id", F.col("season").cast("bigint").alias("season"))
    return missing_keys(pa, have, ["player_id", "season"])


@register("q_id_union", T.duck_with(T.DUCK_GAMES, T.DUCK_PITCHES) + """,
ids AS (SELECT customer AS player_id FROM games_v UNION SELECT batter FROM pitches_v),
stored AS (SELECT c_custkey AS player_id,
                  CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_name END AS player_name
           FROM customer),
people AS (SELECT s_suppkey AS player_id,
                  concat_ws(', ', split_part(s_name, '#', 1), split_part(s_name, '#', 2)) AS full_name
           FROM supplier)
SELECT i.player_id, coalesce(s.player_name, p.full_name) AS player_name
FROM ids i LEFT JOIN stored s ON s.player_id = i.player_id
           LEFT JOIN people p ON p.player_id = i.player_id""")
def q_id_union(spark, sf_dir):
    """Ids of both roles (set union), names resolved stored-first then from
    people records as 'last, first' (SET-03, DOM-32, SCA-16, JON-15)."""
    from seamstat.functions.exprs import full_name
    from seamstat.operators.joins import id_union
    ids = id_union((T.games(spark, sf_dir), "customer"), (T.pitches(spark, sf_dir), "batter"))
    cust = T.read(spark, sf_dir, "customer")
    stored = cust.select(F.col("c_custkey").alias("player_id"),
                         F.when(F.col("c_mktsegment") == "BUILDING", F.lit(None))
                         .otherwise(F.col("c_name")).alias("player_name"))
    sup = T.read(spark, sf_dir, "supplier")
    people = sup.select(F.col("s_suppkey").alias("player_id"),
                        full_name(F.split_part("s_name", F.lit("#"), F.lit(1)),
                                  F.split_part("s_name", F.lit("#"), F.lit(2))).alias("full_name"))
    from seamstat.operators.tables import upsert_coalesce
    names = upsert_coalesce(stored, people.withColumnRenamed("full_name", "player_name"),
                            ["player_id"], ["player_name"])
    return ids.join(names, "player_id", "left").select("player_id", "player_name")


@register("q_latest_snapshot", T.duck_with(_CUST_SEASON) + """,
roster AS (SELECT DISTINCT o_custkey AS player_id, 'H' || substr(o_orderpriority, 1, 1) AS team,
                  CAST(year(o_orderdate) AS BIGINT) AS season
           FROM orders WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders))
SELECT r.player_id, r.team, r.season, c.lines, c.qty
FROM roster r JOIN cs c ON c.player_id = r.player_id AND c.season = r.season""")
def q_latest_snapshot(spark, sf_dir):
    """Roster rows of the latest season (scalar subquery) joined to that
    season's features (SRC-13, JON-11, JON-14)."""
    from seamstat.operators.joins import latest_snapshot
    o = T.read(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("player_id"),
        F.concat(F.lit("H"), F.substring("o_orderpriority", 1, 1)).alias("team"),
        F.year("o_orderdate").cast("bigint").alias("season"))
    roster = latest_snapshot(o, "season").distinct()
    return roster.join(_cust_season(spark, sf_dir), ["player_id", "season"]) \
        .select("player_id", "team", "season", "lines", "qty")


@register("q_season_bounds", T.duck_with(T.DUCK_GAMES, T.DUCK_OFFICIAL_BATTING,
                                         T.DUCK_OFFICIAL_PITCHING, T.duck_constants(),
                                         T.DUCK_PARKS) + """,
b AS (SELECT min(season) lo, max(season) hi FROM official_b UNION ALL
      SELECT min(season), max(season) FROM official_v UNION ALL
      SELECT min(year(game_date)), max(year(game_date)) FROM games_v UNION ALL
      SELECT min(season), max(season) FROM constants_v UNION ALL
      SELECT min(season), max(season) FROM parks_v)
SELECT CAST(max(lo) AS BIGINT) AS first_season, CAST(min(hi) AS BIGINT) AS latest_season,
       CAST(min(hi) + 1 AS BIGINT) AS projection_season FROM b""")
def q_season_bounds(spark, sf_dir):
    """Seasons covered by every source: greatest of minima, least of
    maxima, next season to project (SRC-14, AGG-12)."""
    from seamstat.operators.aggs import season_bounds
    return season_bounds({
        "batting": (T.official_batting(spark, sf_dir), F.col("season")),
        "pitching": (T.official_pitching(spark, sf_dir), F.col("season")),
        "events": (T.games(spark, sf_dir), F.year("game_date")),
        "constants": (T.constants(spark), F.col("season")),
        "parks": (T.park_factors(spark, sf_dir), F.col("season")),
    })


# ------------------------------------------------------- table maintenance --
def _store(rows: DataFrame, keys, name: str, buckets: int = 8):
    """A stored table with these rows, in the shared folder."""
    import uuid

    from seamstat.operators.store import KeyedStore
    from seamstat.session import checkpoint_table_path
    path = checkpoint_table_path(rows.sparkSession, f"{name}/{uuid.uuid4().hex}")
    return KeyedStore(rows.sparkSession, path, keys, buckets).create(rows)


def _cust_agg(o):
    pr = F.col("o_orderpriority")
    return o.groupBy(F.col("o_custkey").alias("player_id"),
                     F.year("o_orderdate").cast("bigint").alias("season")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_orders"),
        F.count_if(pr == "1-URGENT").cast("bigint").alias("hr"),
        F.count_if(pr == "2-HIGH").cast("bigint").alias("rbi"))


def _stored_incoming(spark, sf_dir):
    """Stored table: customer-season lines from orders that are not pending;
    incoming reload: lines from orders that are not finished. Every order is
    in one of them, open ones in both."""
    o = T.read(spark, sf_dir, "orders")
    stored = _cust_agg(o.where(F.col("o_orderstatus") != "P"))
    incoming = _cust_agg(o.where(F.col("o_orderstatus") != "F"))
    return stored, incoming


_DUCK_SI = """WITH stored AS (
  SELECT o_custkey AS player_id, CAST(year(o_orderdate) AS BIGINT) AS season, count(*) AS n_orders,
         count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS hr,
         count(*) FILTER (WHERE o_orderpriority = '2-HIGH') AS rbi
  FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1, 2),
incoming AS (
  SELECT o_custkey AS player_id, CAST(year(o_orderdate) AS BIGINT) AS season, count(*) AS n_orders,
         count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS hr,
         count(*) FILTER (WHERE o_orderpriority = '2-HIGH') AS rbi
  FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1, 2)
"""
_SI_COLS = ["player_id", "season", "n_orders", "hr", "rbi"]


@register("q_replace_keys", _DUCK_SI + """
SELECT * FROM stored s WHERE NOT EXISTS (
  SELECT 1 FROM incoming i WHERE i.player_id = s.player_id AND i.season = s.season)
UNION ALL SELECT * FROM incoming""")
def q_replace_keys(spark, sf_dir):
    """Delete-by-key then insert: an idempotent reload (SNK-03, SNK-04)."""
    s, i = _stored_incoming(spark, sf_dir)
    return _store(s, ["player_id", "season"], "replace_keys").replace_keys(i).read().select(*_SI_COLS)


@register("q_insert_absent", _DUCK_SI + """
SELECT * FROM stored UNION ALL
SELECT * FROM incoming i WHERE NOT EXISTS (
  SELECT 1 FROM stored s WHERE i.player_id = s.player_id AND i.season = s.season)""")
def q_insert_absent(spark, sf_dir):
    """Insert only keys not stored yet (SNK-05, ON CONFLICT DO NOTHING)."""
    s, i = _stored_incoming(spark, sf_dir)
    return _store(s, ["player_id", "season"], "insert_absent").insert_absent(i).read().select(*_SI_COLS)


@register("q_upsert", _DUCK_SI + """
SELECT coalesce(i.player_id, s.player_id) AS player_id, coalesce(i.season, s.season) AS season,
       CASE WHEN i.player_id IS NOT NULL THEN i.n_orders ELSE s.n_orders END AS n_orders,
       CASE WHEN i.player_id IS NOT NULL THEN i.hr ELSE s.hr END AS hr,
       CASE WHEN i.player_id IS NOT NULL THEN i.rbi ELSE s.rbi END AS rbi
FROM stored s FULL OUTER JOIN incoming i ON i.player_id = s.player_id AND i.season = s.season""")
def q_upsert(spark, sf_dir):
    """Full upsert: incoming values win on conflict (SNK-06)."""
    s, i = _stored_incoming(spark, sf_dir)
    return _store(s, ["player_id", "season"], "upsert").upsert(i).read().select(*_SI_COLS)


@register("q_upsert_partial", _DUCK_SI + """
SELECT coalesce(i.player_id, s.player_id) AS player_id, coalesce(i.season, s.season) AS season,
       CASE WHEN i.player_id IS NOT NULL THEN i.n_orders ELSE s.n_orders END AS n_orders,
       CASE WHEN i.player_id IS NOT NULL THEN i.hr ELSE s.hr END AS hr,
       CASE WHEN s.player_id IS NOT NULL THEN s.rbi ELSE i.rbi END AS rbi
FROM stored s FULL OUTER JOIN incoming i ON i.player_id = s.player_id AND i.season = s.season""")
def q_upsert_partial(spark, sf_dir):
    """Upsert refreshing only listed columns; ``rbi`` keeps the stored
    value on conflict (SNK-07)."""
    s, i = _stored_incoming(spark, sf_dir)
    store = _store(s, ["player_id", "season"], "upsert_partial")
    return store.upsert(i, update_cols=["n_orders", "hr"]).read().select(*_SI_COLS)


@register("q_upsert_coalesce", _DUCK_SI + """,
sn AS (SELECT player_id, season, CASE WHEN n_orders > 1 THEN 'S' || CAST(player_id AS VARCHAR) END AS name FROM stored),
inn AS (SELECT player_id, season, 'I' || CAST(player_id AS VARCHAR) AS name FROM incoming)
SELECT coalesce(s.player_id, i.player_id) AS player_id, coalesce(s.season, i.season) AS season,
       coalesce(s.name, i.name) AS name
FROM sn s FULL OUTER JOIN inn i ON i.player_id = s.player_id AND i.season = s.season""")
def q_upsert_coalesce(spark, sf_dir):
    """Upsert keeping stored non-null values, ``COALESCE(existing, new)``
    (SNK-08)."""
    s, i = _stored_incoming(spark, sf_dir)
    sn = s.select("player_id", "season", F.when(F.col("n_orders") > 1, F.concat(
        F.lit("S"), F.col("player_id").cast("string"))).alias("name"))
    inn = i.select("player_id", "season", F.concat(F.lit("I"), F.col("player_id").cast("string")).alias("name"))
    store = _store(sn, ["player_id", "season"], "upsert_coalesce")
    return store.upsert_coalesce(inn, ["name"]).read().select("player_id", "season", "name")


# ------------------------------------------------------------------- JSON --
@register("q_json_flatten", """
SELECT event_id, user_id, event_type,
       TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
       TRY_CAST(CASE WHEN event_type = 'error' THEN '.---' ELSE CAST(value AS VARCHAR) END AS DOUBLE) AS value_num
FROM events""")
def q_json_flatten(spark, sf_dir):
    """JSON path access with a declared type and sentinel-safe numeric
    parsing (SCA-15, SCA-17)."""
    from seamstat.functions.exprs import safe_num
    from seamstat.sources.landed_json import json_field
    ev = T.read(spark, sf_dir, "events")
    text = F.when(F.col("event_type") == "error", F.lit(".---")).otherwise(F.col("value").cast("string"))
    return ev.select("event_id", "user_id", "event_type",
                     json_field("props", "$.k", to="bigint").alias("k"),
                     safe_num(text).alias("value_num"))


def _season_stats_json(spark, sf_dir):
    """A landed season-stats document per (user, day, event type): two
    splits, the first is the one loaded (nested struct -> JSON text)."""
    ev = T.read(spark, sf_dir, "events")
    g = ev.groupBy("user_id", F.to_date("ts").alias("day"), "event_type").agg(
        F.count(F.lit(1)).cast("bigint").alias("n"),
        F.sum(F.get_json_object("props", "$.k").cast("bigint")).alias("k_sum"))
    first = F.struct(F.struct(F.col("n").alias("gamesPlayed"), F.col("k_sum").alias("homeRuns"),
                              F.format_string("%.3f", F.col("n") / 10.0).alias("avg")).alias("stat"))
    second = F.struct(F.struct(F.lit(0).cast("bigint").alias("gamesPlayed"),
                               F.lit(0).cast("bigint").alias("homeRuns"),
                               F.lit(".---").alias("avg")).alias("stat"))
    doc = F.to_json(F.struct(F.array(F.struct(F.array(first, second).alias("splits"))).alias("stats")))
    return g.select("user_id", "day", "event_type", doc.alias("payload"))


@register("q_json_season_stats", """
SELECT user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_type, count(*) AS games,
       CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS home_runs,
       TRY_CAST(printf('%.3f', count(*) / 10.0) AS DOUBLE) AS avg
FROM events GROUP BY 1, 2, 3""")
def q_json_season_stats(spark, sf_dir):
    """Landed season-stat documents flattened from the first split only
    (SRC-02, SRC-03, T17)."""
    from seamstat.sources import landed_json as LJ
    from seamstat.sources.schemas import STATS_PAYLOAD
    docs = LJ.parse(_season_stats_json(spark, sf_dir), "payload", STATS_PAYLOAD)
    cols = LJ.flatten_season_stats(F.col("doc"), {"games": "gamesPlayed", "home_runs": "homeRuns",
                                                  "avg": "avg"})
    out = docs.select("user_id", F.col("day").cast("string").alias("day"), "event_type", *cols)
    return out.withColumn("avg", F.col("avg").try_cast("double"))


# ---------------------------------------------------------- data quality --
@register("q_dup_keys", """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def q_dup_keys(spark, sf_dir):
    """Keys occurring more than once, with multiplicity (DQ-02, AGG-13)."""
    from seamstat.operators.quality import duplicate_keys
    return duplicate_keys(T.read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("q_match_rate", _BAT_WITH + ", " + T.DUCK_OFFICIAL_BATTING + ", " + T.DUCK_BIO + """
SELECT count(*) AS n_rows, count(o.stolen_bases) AS stolen_bases_matched,
       count(bio.birth_date) AS birth_date_matched,
       count(o.stolen_bases) / CAST(count(*) AS DOUBLE) AS stolen_bases_rate,
       count(bio.birth_date) / CAST(count(*) AS DOUBLE) AS birth_date_rate
FROM bat_lines b
LEFT JOIN official_b o ON o.player_id = b.batter AND o.season = b.season
LEFT JOIN bio_v bio ON bio.player_id = b.batter
WHERE b.split_type = 'total'""")
def q_match_rate(spark, sf_dir):
    """Share of rows matched by each left join, one pass (DQ-03)."""
    return _checked_chain(spark, sf_dir)[1]


def _checked_chain(spark, sf_dir):
    """The left-join chain written once, its rows counted while it runs."""
    from seamstat.operators.quality import observed_chain
    from seamstat.plans.matrices import materialize

    def chain(base):
        ob = T.official_batting(spark, sf_dir).select(
            "player_id", F.col("season").cast("bigint").alias("season"), "stolen_bases")
        bio = T.player_bio(spark, sf_dir).select("player_id", "birth_date")
        return base.join(ob, ["player_id", "season"], "left").join(bio, "player_id", "left")

    base = _bat_totals(spark, sf_dir, None).select("player_id", "season")
    return observed_chain(base, chain, lambda df: materialize(df, "checked_chain"), ["stolen_bases", "birth_date"])


_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


@register("q_table_counts", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in _TABLES))
def q_table_counts(spark, sf_dir):
    """Row count of every table as rows, from the files' footers (SNK-11)."""
    from seamstat.sources.footers import footer_counts
    return footer_counts(spark, **{t: f"{sf_dir}/{t}.parquet" for t in _TABLES})


@register("q_split_span", T.duck_with(_CUST_SEASON) + """,
latest AS (SELECT max(season) AS l FROM cs),
pairs AS (
  SELECT c.player_id, c.season,
         CASE WHEN c.season <= (SELECT l FROM latest) - 2 THEN 'train'
              WHEN c.season = (SELECT l FROM latest) - 1 THEN 'test' ELSE 'other' END AS split
  FROM cs c JOIN cs n ON n.player_id = c.player_id AND n.season - 1 = c.season)
SELECT split, min(season) AS first_season, max(season) AS last_season, count(*) AS n_rows,
       count(DISTINCT player_id) AS n_entities
FROM pairs GROUP BY split""")
def q_split_span(spark, sf_dir):
    """Season span, rows and entities of the train and test pairs (DQ-04)."""
    from seamstat.operators.joins import year_pairs
    from seamstat.operators.modeling import season_split
    from seamstat.operators.quality import span_report
    cs = _cust_season(spark, sf_dir)
    pairs = season_split(year_pairs(cs, ["lines"], "player_id", "season"), cs,
                         latest=_latest_order_season(spark, sf_dir))
    return span_report(pairs, "season", "player_id", "split")


@register("q_row_count_check", _BAT_WITH + ", " + T.DUCK_OFFICIAL_BATTING + ", " + T.DUCK_BIO + """,
base AS (SELECT batter AS player_id, season FROM bat_lines WHERE split_type = 'total'),
joined AS (SELECT b.* FROM base b
           LEFT JOIN official_b o ON o.player_id = b.player_id AND o.season = b.season
           LEFT JOIN bio_v bio ON bio.player_id = b.player_id)
SELECT (SELECT count(*) FROM base) AS rows_before, (SELECT count(*) FROM joined) AS rows_after,
       (SELECT count(*) FROM base) = (SELECT count(*) FROM joined) AS stable""")
def q_row_count_check(spark, sf_dir):
    """Row count before and after the left-join chain (DQ-01)."""
    return _checked_chain(spark, sf_dir)[0]


# ------------------------------------------------------------------ top-k --
@register("q_topk", _BAT_WITH + """
SELECT batter AS player_id, season, pa, ops FROM bat_lines
WHERE split_type = 'total' AND pa >= 50
ORDER BY ops DESC, player_id, season LIMIT 20""")
def q_topk(spark, sf_dir):
    """Leaderboard: top 20 qualified player-seasons by OPS, ties by id and
    season (SRT-02, MLO-15)."""
    from seamstat.operators.modeling import leaderboard
    b = _bat_totals(spark, sf_dir).select("player_id", "season", "pa", "ops")
    return leaderboard(b, "ops", 20, tie=("player_id", "season"))


# -------------------------------------------------------------- modelling --
def _latest_order_season(spark, sf_dir):
    """Latest season as a scalar subquery over one column of ``orders``
    (a one-row partial aggregate; the pairs plan is not repeated)."""
    return T.read(spark, sf_dir, "orders").select(F.max(F.year("o_orderdate"))).scalar()


def _pairs(spark, sf_dir):
    from seamstat.operators.joins import year_pairs
    from seamstat.operators.modeling import season_split
    cs = _cust_season(spark, sf_dir)
    pairs = year_pairs(cs, ["lines", "qty"], "player_id", "season")
    return season_split(pairs, cs, latest=_latest_order_season(spark, sf_dir)), cs


@register("q_standardize", T.duck_with(_CUST_SEASON) + """,
latest AS (SELECT max(season) AS l FROM cs),
pairs AS (SELECT c.*, CASE WHEN c.season <= (SELECT l FROM latest) - 2 THEN 'train'
                           WHEN c.season = (SELECT l FROM latest) - 1 THEN 'test' ELSE 'other' END AS split
          FROM cs c JOIN cs n ON n.player_id = c.player_id AND n.season - 1 = c.season),
st AS (SELECT avg(lines) AS ml, stddev_pop(lines) AS sl, avg(qty) AS mq, stddev_pop(qty) AS sq
       FROM pairs WHERE split = 'train')
SELECT p.player_id, p.season, p.split,
       round((p.lines - st.ml) / CASE WHEN st.sl = 0 THEN 1 ELSE st.sl END, 6) AS lines_z,
       round((p.qty - st.mq) / CASE WHEN st.sq = 0 THEN 1 ELSE st.sq END, 6) AS qty_z
FROM pairs p, st""")
def q_standardize(spark, sf_dir):
    """Population-std standardisation fitted on the train split and applied
    to all pairs; zero deviation reads as 1 (MLO-06)."""
    from seamstat.operators.modeling import standardize, standardize_stats
    pairs, _ = _pairs(spark, sf_dir)
    st = standardize_stats(pairs.where(F.col("split") == "train"), ["lines", "qty"])
    z = standardize(pairs, st, "_z")
    return z.select("player_id", "season", "split", F.round("lines_z", 6).alias("lines_z"),
                    F.round("qty_z", 6).alias("qty_z"))


def _duck_blend(target: str) -> str:
    return f"""SELECT '{target}' AS target, w AS best_weight, round(r2, 6) AS r2 FROM (
  SELECT i / 20.0 AS w, i,
         1 - (see - 2 * (i / 20.0) * sed + (i / 20.0) * (i / 20.0) * sdd) / nullif(syy - sy * sy / n, 0.0) AS r2
  FROM (SELECT sum((y - a) * (y - a)) AS see, sum((y - a) * (b - a)) AS sed, sum((b - a) * (b - a)) AS sdd,
               sum(y) AS sy, sum(y * y) AS syy, count(*) AS n
        FROM (SELECT next_{target} AS y, {target} AS a,
                     (SELECT avg(next_{target}) FROM pairs WHERE split = 'train') AS b
              FROM pairs WHERE split = 'test')) s, range(0, 21) t(i)
  ORDER BY r2 DESC, i LIMIT 1)"""


@register("q_blend_search", T.duck_with(_CUST_SEASON) + """,
latest AS (SELECT max(season) AS l FROM cs),
pairs AS (SELECT c.*, n.lines AS next_lines, n.qty AS next_qty,
                 CASE WHEN c.season <= (SELECT l FROM latest) - 2 THEN 'train'
                      WHEN c.season = (SELECT l FROM latest) - 1 THEN 'test' ELSE 'other' END AS split
          FROM cs c JOIN cs n ON n.player_id = c.player_id AND n.season - 1 = c.season)
""" + _duck_blend("lines") + " UNION ALL " + _duck_blend("qty"))
def q_blend_search(spark, sf_dir):
    """Blend-weight search over 21 weights of two predictors (this season's
    value and the train mean of next season), first best R^2 on the test
    split (MLO-09, MLO-10). Targets are unpivoted to rows, so every target
    is searched in one pass over the pairs."""
    from seamstat.operators.modeling import best_blend
    pairs, _ = _pairs(spark, sf_dir)
    long = pairs.select("split", F.explode(F.array(*[
        F.struct(F.lit(t).alias("target"), F.col(f"next_{t}").alias("y"), F.col(t).alias("a"))
        for t in ("lines", "qty")])).alias("r")).select("split", "r.*")
    means = long.where(F.col("split") == "train").groupBy("target").agg(F.avg("y").alias("b"))
    test = long.where(F.col("split") == "test").join(F.broadcast(means), "target")
    return best_blend(test, "y", "a", "b", by=["target"]).select(
        "target", "best_weight", F.round("r2", 6).alias("r2"))


def _model_inputs(spark, sf_dir):
    """Training pairs written once to the shared checkpoint folder: every
    fit and metric below reads them back instead of recomputing the
    aggregation and self-join, and a lost executor does not either."""
    from seamstat.operators.modeling import impute_zero
    from seamstat.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    pairs, cs = _pairs(spark, sf_dir)
    feats = ["lines", "qty", "returns"]
    pairs = impute_zero(pairs, feats + ["next_lines", "next_qty"]).checkpoint(eager=True)
    return pairs, cs, feats


_FEATS = ["lines", "qty", "returns"]


def _duck_boost(select: str, rounds: int = 200, rate: float = 0.05, target: str = "lines") -> str:
    """Depth-one boosting round by round in SQL, in whole units of 10^-6:
    every distinct value of a feature is a threshold; sums of residuals below
    it and above give the gain. ``state`` has a row per pair and round."""
    longs = " UNION ALL ".join(f"SELECT id, {i} AS f, {f} AS v FROM x WHERE split = 'train'" for i, f in enumerate(_FEATS))
    value = "CASE best.f " + " ".join(f"WHEN {i} THEN x.{f}" for i, f in enumerate(_FEATS)) + " END"
    return T.duck_with(_CUST_SEASON).replace("WITH ", "WITH RECURSIVE ", 1) + f""",
latest AS (SELECT max(season) AS l FROM cs),
x AS (SELECT row_number() OVER (ORDER BY c.player_id, c.season) AS id, c.player_id, c.season,
             {", ".join(f"coalesce(c.{f}, 0.0) AS {f}" for f in _FEATS)},
             n.{target} AS next_{target}, CAST(round(n.{target} * 1000000) AS BIGINT) AS y,
             CASE WHEN c.season <= (SELECT l FROM latest) - 2 THEN 'train'
                  WHEN c.season = (SELECT l FROM latest) - 1 THEN 'test' ELSE 'other' END AS split
      FROM cs c JOIN cs n ON n.player_id = c.player_id AND n.season - 1 = c.season),
long AS ({longs}),
base AS (SELECT sum(y) // count(*) AS b FROM x WHERE split = 'train'),
state(k, id, y, p, f, gain) AS (
  SELECT 0, id, y, CAST(b AS BIGINT), -1, CAST(0 AS DOUBLE) FROM x, base
  UNION ALL
  SELECT s.k + 1, s.id, s.y, s.p + CASE WHEN {value} <= best.v THEN best.wl ELSE best.wr END, best.f, best.gain
  FROM state s JOIN x ON x.id = s.id, (
    SELECT f, v, gain, CAST(floor(CAST({rate} AS DOUBLE) * gl / wl) AS BIGINT) AS wl,
           CAST(floor(CAST({rate} AS DOUBLE) * gr / wr) AS BIGINT) AS wr
    FROM (
      SELECT f, v, gl, gr, wl, wr, gl * gl / wl + gr * gr / wr - ga * ga / wa AS gain
      FROM (
        SELECT f, v, n, nl, CAST(g AS DOUBLE) AS ga, CAST(gls AS DOUBLE) AS gl, CAST(g - gls AS DOUBLE) AS gr,
               CAST(n AS DOUBLE) + 1 AS wa, CAST(nl AS DOUBLE) + 1 AS wl, CAST(n - nl AS DOUBLE) + 1 AS wr
        FROM (
          SELECT f, v, sum(c) OVER (PARTITION BY f ORDER BY v) AS nl, sum(r) OVER (PARTITION BY f ORDER BY v) AS gls,
                 sum(c) OVER (PARTITION BY f) AS n, sum(r) OVER (PARTITION BY f) AS g
          FROM (SELECT l.f, l.v, count(*) AS c, sum(t.y - t.p) AS r FROM state t JOIN long l ON l.id = t.id
                GROUP BY l.f, l.v)))
      WHERE nl < n)
    WHERE gain > 0 ORDER BY gain DESC, f, v LIMIT 1) best
  WHERE s.k < {rounds})
{select}"""


def _boosted(spark, sf_dir, rounds: int = 200, rate: float = 0.05, target: str = "lines"):
    """Training pairs, and depth-one trees fitted on all of them."""
    from seamstat.operators.stumps import boost, joint_counts, make_bins
    pairs, _, feats = _model_inputs(spark, sf_dir)
    train = pairs.where(F.col("split") == "train")
    bins = make_bins(train, feats, bins=4096)
    counts = joint_counts(train, bins, [f"next_{target}"])
    return pairs, feats, boost(counts[0], bins, rounds, rate) if counts else None


@register("q_gbt_importance", _duck_boost(""",
splits AS (SELECT DISTINCT k, f, gain FROM state WHERE k > 0),
mean AS (SELECT f, avg(gain) AS g FROM splits GROUP BY f)
SELECT n.feature, round(coalesce(m.g, 0) / (SELECT sum(g) FROM mean), 6) AS importance,
       coalesce(m.g, 0) / (SELECT sum(g) FROM mean) >= 0.005 AS kept
FROM (VALUES (0, 'lines'), (1, 'qty'), (2, 'returns')) AS n(f, feature) LEFT JOIN mean m ON m.f = n.f"""))
def q_gbt_importance(spark, sf_dir):
    """Importances (mean gain, normalised) of 200 boosted depth-one trees on
    all distinct thresholds, and the kept set (MLO-04, MLO-08)."""
    _, feats, model = _boosted(spark, sf_dir)
    rows = list(zip(feats, model.importances()))
    return spark.createDataFrame(rows, "feature string, importance double").select(
        "feature", F.round("importance", 6).alias("importance"),
        (F.col("importance") >= K.IMPORTANCE_THRESHOLD).alias("kept"))


@register("q_gbt_predict", _duck_boost("""
SELECT x.player_id, x.season, x.next_qty, round(s.p / CAST(1000000 AS DOUBLE), 4) AS pred_gbt
FROM x JOIN state s ON s.id = x.id WHERE x.split = 'test' AND s.k = (SELECT max(k) FROM state)""", target="qty"))
def q_gbt_predict(spark, sf_dir):
    """Predictions of 200 boosted depth-one trees for the test split, scored
    by one built-in expression (MLO-08)."""
    pairs, _, model = _boosted(spark, sf_dir, target="qty")
    return pairs.where(F.col("split") == "test").select(
        "player_id", "season", "next_qty", F.round(model.predict(), 4).alias("pred_gbt"))


@register("q_gbt_grid")
def q_gbt_grid(spark, sf_dir):
    """Grid of rounds, learning rates and least leaf sizes under 3-fold
    cross-validation from one pass of counts: every prefix of a fit is scored
    on the way (MLO-05)."""
    from seamstat.operators.stumps import grid_search, joint_counts, make_bins
    pairs, _, feats = _model_inputs(spark, sf_dir)
    train = pairs.where(F.col("split") == "train")
    bins = make_bins(train, feats)
    folds = joint_counts(train, bins, ["next_lines"], F.pmod(F.col("player_id") + F.col("season"), F.lit(3)))
    grid = K.PARAM_GRID
    rows = grid_search(folds, bins, grid["n_estimators"], grid["learning_rate"], grid["min_child_weight"])
    best = max(range(len(rows)), key=lambda i: (rows[i]["r2"] or float("-inf"), -i)) if rows else -1
    return spark.createDataFrame(
        [(r["n_estimators"], r["learning_rate"], r["min_child_weight"], r["r2"], i == best) for i, r in enumerate(rows)],
        "n_estimators int, learning_rate double, min_child_weight int, r2 double, best boolean")


@register("q_project")
def q_project(spark, sf_dir):
    """Customer-season lines: selection, the grid with all rounds under
    3-fold cross-validation, ridge and boosted trees per target, blend on the
    test split, the latest season projected and rounded (MLO-04, -05, -08,
    -09, -13)."""
    from seamstat.operators import ensemble as E
    pairs, cs, feats = _model_inputs(spark, sf_dir)
    train, test = (pairs.where(F.col("split") == s) for s in ("train", "test"))
    members, _, _ = E.fit(train, feats, ["next_lines", "next_qty"])
    E.blend(members, test, test)
    from seamstat.operators.modeling import impute_zero
    latest = impute_zero(cs.where(F.col("season") == cs.select(F.max("season")).scalar()), feats)
    return E.project(latest, members, ["player_id", "season"], {"lines": 0, "qty": 0})


def _duck_ridge(predict: bool = False, target: str = "lines") -> str:
    feats = ["lines", "qty", "returns"]
    z = {f: f"((coalesce({f}, 0.0) - m_{f}) / s_{f})" for f in feats}
    sums = ", ".join([f"sum({z[a]} * {z[b]}) AS zz_{a}_{b}" for i, a in enumerate(feats)
                      for b in feats[i:]] +
                     [f"sum({z[a]} * (coalesce(next_{target}, 0.0) - my)) AS zy_{a}" for a in feats])
    moments = ", ".join([f"avg(coalesce({f}, 0.0)) AS m_{f}" for f in feats] +
                        [f"CASE WHEN stddev_pop(coalesce({f}, 0.0)) = 0 THEN 1.0 "
                         f"ELSE stddev_pop(coalesce({f}, 0.0)) END AS s_{f}" for f in feats] +
                        [f"avg(coalesce(next_{target}, 0.0)) AS my"])

    def a(i, j):
        x, y = sorted((i, j))
        return f"(zz_{feats[x]}_{feats[y]}{' + 1.0' if i == j else ''})"

    def det(cols):
        m = [[cols[c][r] for c in range(3)] for r in range(3)]
        return (f"({m[0][0]} * ({m[1][1]} * {m[2][2]} - {m[1][2]} * {m[2][1]}) - "
                f"{m[0][1]} * ({m[1][0]} * {m[2][2]} - {m[1][2]} * {m[2][0]}) + "
                f"{m[0][2]} * ({m[1][0]} * {m[2][1]} - {m[1][1]} * {m[2][0]}))")
    A = [[a(r, c) for r in range(3)] for c in range(3)]
    r = [f"zy_{f}" for f in feats]
    d = det(A)
    rows = []
    for i, f in enumerate(feats):
        cols = [r if c == i else A[c] for c in range(3)]
        rows.append(f"SELECT '{f}__z' AS feature, round({det(cols)} / {d}, 4) AS coefficient FROM s")
    rows.append("SELECT 'intercept' AS feature, round(my, 4) AS coefficient FROM s")
    base = (T.duck_with(_CUST_SEASON) + f""",
latest AS (SELECT max(season) AS l FROM cs),
pairs AS (SELECT c.*, n.{target} AS next_{target},
                 CASE WHEN c.season <= (SELECT l FROM latest) - 2 THEN 'train'
                      WHEN c.season = (SELECT l FROM latest) - 1 THEN 'test' ELSE 'other' END AS split
          FROM cs c JOIN cs n ON n.player_id = c.player_id AND n.season - 1 = c.season),
train AS (SELECT * FROM pairs WHERE split = 'train'),
mo AS (SELECT {moments} FROM train),
s AS (SELECT {sums}, any_value(my) AS my FROM train, mo)
""")
    if not predict:
        return base + "\nUNION ALL ".join(rows)
    coefs = ", ".join(f"{det([r if c == i else A[c] for c in range(3)])} / {d} AS c_{f}" for i, f in enumerate(feats))
    value = " + ".join(f"co.c_{f} * {z[f]}" for f in feats)
    return base + f""", co AS (SELECT {coefs}, my AS c0 FROM s)
SELECT player_id, season, coalesce(next_{target}, 0.0) AS next_{target}, round(co.c0 + {value}, 4) AS pred_ridge
FROM pairs, mo, co WHERE split = 'test'"""


@register("q_ridge", _duck_ridge(predict=True))
def q_ridge(spark, sf_dir):
    """Ridge (alpha 1) on standardised features, predictions for the test
    split, equal to the closed form's (MLO-03, MLO-06, MLO-07)."""
    from seamstat.operators.modeling import (_assemble, fit_ridge, standardize,
                                             standardize_stats)
    pairs, _, feats = _model_inputs(spark, sf_dir)
    train = pairs.where(F.col("split") == "train")
    st = standardize_stats(train, feats)
    z = [f + "__z" for f in feats]
    model = fit_ridge(standardize(train, st, "__z"), z, "next_lines", 1.0)
    test = _assemble(standardize(pairs.where(F.col("split") == "test"), st, "__z"), z)
    return model.transform(test).select("player_id", "season", "next_lines",
                                        F.round("pred_ridge", 4).alias("pred_ridge"))


@register("q_ridge_coefficients", _duck_ridge())
def q_ridge_coefficients(spark, sf_dir):
    """Ridge (alpha 1, unpenalised intercept) on population-standardised
    features; coefficients equal the closed form (Z'Z + I)^-1 Z'(y - mean y)
    (MLO-06, MLO-07)."""
    from seamstat.operators.modeling import fit_ridge, standardize, standardize_stats
    pairs, _, feats = _model_inputs(spark, sf_dir)
    train = pairs.where(F.col("split") == "train")
    st = standardize_stats(train, feats)
    z = [f + "__z" for f in feats]
    model = fit_ridge(standardize(train, st, "__z"), z, "next_lines", 1.0)
    coefs = [(n, float(v)) for n, v in zip(z, model.coefficients.toArray())]
    coefs.append(("intercept", float(model.intercept)))
    return spark.createDataFrame(coefs, "feature string, coefficient double") \
        .select("feature", F.round("coefficient", 4).alias("coefficient"))


def _duck_ridge_targets() -> str:
    one = [f"SELECT 'next_{t}' AS target, * FROM ({_duck_ridge(target=t)})" for t in ("lines", "qty", "returns")]
    return "\nUNION ALL ".join(one)


@register("q_ridge_targets", _duck_ridge_targets())
def q_ridge_targets(spark, sf_dir):
    """Ridge coefficients of three targets from one pass of cross moments,
    each equal to its closed form (MLO-06, MLO-07)."""
    from seamstat.operators.gram import cross_moments, ridge_all
    from seamstat.operators.joins import year_pairs
    from seamstat.operators.modeling import impute_zero, season_split
    cs, targets = _cust_season(spark, sf_dir), ["lines", "qty", "returns"]
    pairs = season_split(year_pairs(cs, targets, "player_id", "season"), cs, latest=_latest_order_season(spark, sf_dir))
    nexts = [f"next_{t}" for t in targets]
    train = impute_zero(pairs.where(F.col("split") == "train"), _FEATS + nexts)
    fits = ridge_all(cross_moments(train, _FEATS + nexts), _FEATS, nexts)
    rows = [(t, c, w) for t, r in fits.items() for c, w in [*zip([f + "__z" for f in _FEATS], r.coefficients),
                                                            ("intercept", r.intercept)]]
    return spark.createDataFrame(rows, "target string, feature string, coefficient double").select(
        "target", "feature", F.round("coefficient", 4).alias("coefficient"))


# -------------------------------------------------------------- streaming --
_DUCK_STREAM = T.duck_with(T.DUCK_GAMES, T.DUCK_PITCHES) + """,
p AS (SELECT p.game_pk, p.at_bat_number, p.batter, p.events, p.inning_topbot,
             CAST(year(g.game_date) AS INTEGER) AS season
      FROM pitches_v p JOIN games_v g ON g.game_pk = p.game_pk)
SELECT game_pk, at_bat_number, batter, events, season FROM p WHERE inning_topbot = 'Bot'
UNION ALL
SELECT game_pk, at_bat_number, batter, events, season FROM p
WHERE inning_topbot = 'Top' AND game_pk NOT IN (SELECT game_pk FROM p WHERE inning_topbot = 'Bot')"""


@register("q_stream_reload", _DUCK_STREAM)
def q_stream_reload(spark, sf_dir):
    """Two landed deliveries of pitch events (top halves, then bottom
    halves) loaded by the Structured Streaming reload: each delivery
    replaces the games it carries inside their season partitions
    (SNK-03, SNK-04, streaming). Returns the loaded table."""
    import os
    import uuid

    from seamstat.session import checkpoint_table_path
    from seamstat.streaming.incremental import start_reload
    run = checkpoint_table_path(spark, f"stream_reload/{uuid.uuid4().hex}")
    p = T.pitches(spark, sf_dir).join(T.games(spark, sf_dir).select("game_pk", "game_date"), "game_pk") \
        .select("game_pk", "at_bat_number", "batter", "events", "inning_topbot",
                F.year("game_date").alias("season"))
    landed, table, ckpt = (os.path.join(run, x) for x in ("landed", "table", "stream"))
    for i, half in enumerate(("Top", "Bot")):
        p.where(F.col("inning_topbot") == half).write.parquet(os.path.join(landed, f"delivery={i}"))
        q = start_reload(spark, os.path.join(landed, "delivery=*"), p.schema, table, ["game_pk"],
                         checkpoint_location=ckpt)
        q.awaitTermination()
    return spark.read.parquet(table).select("game_pk", "at_bat_number", "batter", "events", "season")


@register("q_weighted_event_index", _BAT_WITH + """
SELECT batter, batter_team, split_type, season, pa, woba, wraa, wrc_plus, park_factor
FROM bat_lines""")
def q_weighted_event_index(spark, sf_dir):
    """Weighted event index (wOBA) with unintentional walks, runs above
    average, and the park- and league-adjusted index on team rows
    (DOM-03, DOM-04, DOM-05, JON-02, JON-03)."""
    return q_batting_stats(spark, sf_dir).select(
        "batter", "batter_team", "split_type", "season", "pa", "woba", "wraa", "wrc_plus",
        "park_factor")


# ----------------------------------------------------------- landed files --
def _speed_rows(spark, sf_dir):
    """Per (supplier, ship year) sprint-speed lines as exact text."""
    li = T.read(spark, sf_dir, "lineitem")
    g = li.groupBy(F.col("l_suppkey").alias("player_id"), F.year("l_shipdate").alias("season")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("l_quantity") == 50).alias("bolts"))
    n = F.col("n")
    txt = lambda whole, frac: F.concat(whole.cast("string"), F.lit("."),
                                       F.lpad(frac.cast("string"), 2, "0"))
    return g.select("player_id", "season",
                    txt(25 + n % 5, n % 100).alias("sprint_speed"),
                    txt(F.lit(4), (n * 7) % 100).alias("hp_to_1b"),
                    F.when(F.col("bolts") > 0, F.col("bolts").cast("string")).alias("bolts"),
                    n.cast("string").alias("competitive_runs"))


@register("q_landed_csv", """
WITH g AS (SELECT l_suppkey AS player_id, CAST(year(l_shipdate) AS INTEGER) AS season, count(*) AS n,
                  count(*) FILTER (WHERE l_quantity = 50) AS bolts
           FROM lineitem GROUP BY 1, 2)
SELECT CAST(player_id AS INTEGER) AS player_id, season,
       CAST(CAST((25 + n % 5) || '.' || lpad(CAST(n % 100 AS VARCHAR), 2, '0') AS DECIMAL(5,2)) AS DOUBLE) AS sprint_speed,
       CAST(CAST('4.' || lpad(CAST((n * 7) % 100 AS VARCHAR), 2, '0') AS DECIMAL(5,2)) AS DOUBLE) AS hp_to_1b,
       CASE WHEN bolts > 0 THEN CAST(bolts AS INTEGER) END AS bolts,
       CAST(n AS INTEGER) AS competitive_runs
FROM g""")
def q_landed_csv(spark, sf_dir):
    """Season CSV files (one folder per season, extra columns, empty
    fields) read back with declared types and the season tagged from the
    file set (SRC-07, SCA-15)."""
    import os
    import uuid

    from seamstat.session import checkpoint_table_path
    from seamstat.sources.landed_json import read_sprint_speed_root
    run = checkpoint_table_path(spark, f"landed_csv/{uuid.uuid4().hex}")
    rows = _speed_rows(spark, sf_dir).withColumn("note", F.lit("x"))
    rows.write.partitionBy("season").option("header", True).csv(run)
    return read_sprint_speed_root(spark, run).select(
        "player_id", "season", F.col("sprint_speed").cast("double").alias("sprint_speed"),
        F.col("hp_to_1b").cast("double").alias("hp_to_1b"), "bolts", "competitive_runs")


def _people_docs(spark, sf_dir):
    """One landed people document per supplier (nested position / side)."""
    bio = T.player_bio(spark, sf_dir)
    person = F.struct(
        F.col("player_id").alias("id"), F.col("full_name").alias("fullName"),
        F.split_part("full_name", F.lit("#"), F.lit(1)).alias("lastName"),
        F.split_part("full_name", F.lit("#"), F.lit(2)).alias("firstName"),
        F.date_format("birth_date", "yyyy-MM-dd").alias("birthDate"),
        (F.col("player_id") % 20 + 20).alias("currentAge"),
        F.concat(F.lit("City "), (F.col("player_id") % 9).cast("string")).alias("birthCity"),
        F.when(F.col("player_id") % 4 != 0, F.concat(F.lit("S"), (F.col("player_id") % 50).cast("string"))).alias("birthStateProvince"),
        F.concat(F.lit("Land "), (F.col("player_id") % 6).cast("string")).alias("birthCountry"),
        F.concat((F.col("player_id") % 2 + 5).cast("string"), F.lit("' "), (F.col("player_id") % 12).cast("string"), F.lit('"')).alias("height"),
        (F.col("player_id") % 80 + 160).alias("weight"),
        F.when(F.col("player_id") % 3 == 0, F.col("player_id") % 20 + 1985).alias("draftYear"),
        (F.col("player_id") % 5 != 0).alias("active"),
        F.struct(F.col("primary_position").alias("abbreviation"),
                 F.when(F.col("primary_position") == "P", "Pitcher").otherwise("Fielder").alias("type")).alias("primaryPosition"),
        F.struct(F.col("bat_side").alias("code")).alias("batSide"),
        F.when(F.col("player_id") % 7 != 0, F.struct(F.when(F.col("player_id") % 2 == 0, "L").otherwise("R").alias("code"))).alias("pitchHand"),
        F.date_format("mlb_debut_date", "yyyy-MM-dd").alias("mlbDebutDate"))
    return bio.select(F.to_json(F.struct(F.array(person).alias("people"))).alias("payload"))


@register("q_landed_people", T.duck_with(T.DUCK_BIO) + """
SELECT player_id, full_name, split_part(full_name, '#', 2) AS first_name,
       split_part(full_name, '#', 1) AS last_name, CAST(birth_date AS VARCHAR) AS birth_date,
       CAST(player_id % 20 + 20 AS INTEGER) AS current_age, 'City ' || (player_id % 9) AS birth_city,
       CASE WHEN player_id % 4 <> 0 THEN 'S' || (player_id % 50) END AS birth_state, 'Land ' || (player_id % 6) AS birth_country,
       (player_id % 2 + 5) || ''' ' || (player_id % 12) || '"' AS height, CAST(player_id % 80 + 160 AS INTEGER) AS weight,
       primary_position, CASE WHEN primary_position = 'P' THEN 'Pitcher' ELSE 'Fielder' END AS position_type, bat_side,
       CASE WHEN player_id % 7 <> 0 THEN CASE WHEN player_id % 2 = 0 THEN 'L' ELSE 'R' END END AS pitch_hand,
       CASE WHEN player_id % 3 = 0 THEN CAST(player_id % 20 + 1985 AS INTEGER) END AS draft_year,
       CAST(mlb_debut_date AS VARCHAR) AS mlb_debut_date, player_id % 5 <> 0 AS active
FROM bio_v""")
def q_landed_people(spark, sf_dir):
    """People documents flattened, all 18 columns: nested position, bat side
    and pitch hand, dates parsed, missing fields null (SRC-04, SCA-17)."""
    from seamstat.sources import landed_json as LJ
    from seamstat.sources.schemas import PEOPLE_PAYLOAD
    docs = LJ.parse(_people_docs(spark, sf_dir), "payload", PEOPLE_PAYLOAD)
    out = docs.select(*LJ.flatten_bio(F.col("doc")))
    return out.withColumns({c: F.col(c).cast("string") for c in ("birth_date", "mlb_debut_date")})


@register("q_landed_rosters", """
SELECT CAST(c_custkey AS INTEGER) AS player_id, 2026 AS season,
       CASE WHEN c_mktsegment = 'BUILDING' THEN 'T' || CAST(c_nationkey AS VARCHAR)
            ELSE 'H' || CAST(c_nationkey % 5 + 1 AS VARCHAR) END AS team,
       c_name AS full_name
FROM customer""")
def q_landed_rosters(spark, sf_dir):
    """Roster documents flattened and loaded: the season is replaced and a
    player listed on two rosters keeps the entry loaded last (SRC-09,
    SNK-04, SNK-06, T18)."""
    from seamstat.plans.loads import load_rosters
    from seamstat.sources import landed_json as LJ
    from seamstat.sources.schemas import ACTIVE_40_MAN, ROSTER_PAYLOAD
    c = T.read(spark, sf_dir, "customer")
    first = c.select("c_custkey", "c_name",
                     F.concat(F.lit("H"), (F.col("c_nationkey") % 5 + 1).cast("string")).alias("team"),
                     F.lit(1).alias("load_seq"))
    second = c.where(F.col("c_mktsegment") == "BUILDING").select(
        "c_custkey", "c_name", F.concat(F.lit("T"), F.col("c_nationkey").cast("string")).alias("team"),
        F.lit(2).alias("load_seq"))
    entry = F.struct(F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("fullName")).alias("person"),
                     F.struct(F.lit("P").alias("abbreviation")).alias("position"),
                     F.struct(F.lit("Active").alias("description")).alias("status"))
    docs = first.unionByName(second).select(
        F.lit(2026).alias("season"), "team", F.col("team").alias("team_name"), "load_seq",
        F.to_json(F.struct(F.array(entry).alias("roster"))).alias("payload"))
    rows = LJ.flatten_rosters(LJ.parse(docs, "payload", ROSTER_PAYLOAD), keep=("load_seq",)) \
        .withColumn("entry_seq", F.struct("load_seq", "roster_pos")) \
        .drop("load_seq", "roster_pos")
    stored = spark.createDataFrame([], ACTIVE_40_MAN)
    return load_rosters(stored, rows).select("player_id", "season", "team", "full_name")


from seamstat.plans import (  # noqa: E402,F401  register theirs
    landed_queries, matrix_queries, projection_queries, report_queries, store_queries)

"""Driver queries of the two feature matrices and their DuckDB oracles.

The oracle states every column of a matrix in SQL, from the same derived
tables; doubles are rounded to ten decimals on both sides, dates are text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seamstat.functions import codes as K
from seamstat.plans import testdata as T
from seamstat.plans.oracle_sql import exact
from seamstat.plans.queries import (_BAT_WITH, _DUCK_BEST, _PIT_WITH, _SEASON_PITCHES, _duck_barrel,
                                    _duck_pa, _duck_pitching_select, _duck_roll, _half_sql,
                                    _pitcher_split_sql, _pitching, _platoon_sql, _q, register)

INTS = "tinyint smallint int bigint".split()


def rounded(df: DataFrame) -> DataFrame:
    """Doubles and decimals to ten decimals, whole numbers to bigint, dates to text."""
    out = []
    for name, kind in df.dtypes:
        x = F.col(f"`{name}`")
        if kind == "double" or kind.startswith("decimal"):
            x = F.round(x.cast("double"), 10)
        elif kind in INTS:
            x = x.cast("bigint")
        elif kind == "date":
            x = x.cast("string")
        out.append(x.alias(name))
    return df.select(*out)


def r6(x: str, name: str) -> str:
    return f'round(CAST({x} AS DOUBLE), 10) AS "{name}"'


def big(x: str, name: str) -> str:
    return f'CAST({x} AS BIGINT) AS "{name}"'


def nz(x: str) -> str:
    return f"(CASE WHEN {x} = 0 THEN NULL ELSE CAST({x} AS DOUBLE) END)"


def mean(mask: str, x: str) -> str:
    return f"avg(CASE WHEN {mask} THEN {x} END)"


def share(num: str, den: str) -> str:
    return f"CAST(count(*) FILTER (WHERE {num}) AS DOUBLE) / nullif(count(*) FILTER (WHERE {den}), 0)"


TRACKED = "launch_speed IS NOT NULL"
SWING, WHIFF = f"description IN {_q(K.SWING)}", f"description IN {_q(K.WHIFF)}"

BATTING_ADVANCED = {
    "avg_exit_velo": mean(TRACKED, "launch_speed"), "avg_launch_angle": mean(TRACKED, "launch_angle"),
    "xba": mean(TRACKED, "estimated_ba_using_speedangle"),
    "xwoba": mean(TRACKED, "estimated_woba_using_speedangle"),
    "barrel_rate": mean(TRACKED, _duck_barrel()),
    "hard_hit_rate": mean(TRACKED, "CASE WHEN launch_speed >= 95 THEN 1 ELSE 0 END"),
    "swing_rate": share(SWING, "true"), "whiff_rate": share(WHIFF, SWING),
    "chase_rate": share(f"{SWING} AND zone > 9", "zone > 9"),
    "zone_swing_rate": share(f"{SWING} AND zone <= 9", "zone <= 9"),
    "zone_contact_rate": share(f"{SWING} AND zone <= 9 AND NOT {WHIFF}", f"{SWING} AND zone <= 9")}

PITCHING_ADVANCED = {
    "fb_velo": mean(f"pitch_type IN {_q(K.FASTBALL_TYPES)}", "release_speed"),
    "ff_velo": mean("pitch_type = 'FF'", "release_speed"),
    "brk_velo": mean(f"pitch_type IN {_q(K.BREAKING_TYPES)}", "release_speed"),
    "offspeed_velo": mean(f"pitch_type IN {_q(K.OFFSPEED_TYPES)}", "release_speed"),
    "extension": "avg(release_extension)", "whiff_rate": share(WHIFF, SWING),
    "chase_rate": share(f"{SWING} AND zone > 9", "zone > 9"), "zone_rate": share("zone <= 9", "true"),
    "csw_rate": share(f"({WHIFF} OR description = 'called_strike')", "true"),
    "avg_ev_against": mean(TRACKED, "launch_speed"), "avg_la_against": mean(TRACKED, "launch_angle"),
    "xwoba_against": mean(TRACKED, "estimated_woba_using_speedangle"),
    "barrel_rate_against": mean(TRACKED, _duck_barrel()),
    "hard_hit_rate_against": mean(TRACKED, "CASE WHEN launch_speed >= 95 THEN 1 ELSE 0 END"),
    "gb_rate": share("bb_type = 'ground_ball'", "bb_type IS NOT NULL"),
    "fb_rate": share("bb_type = 'fly_ball'", "bb_type IS NOT NULL")}


def _spec(spec: dict) -> str:
    return ", ".join(f"{sql} AS {name}" for name, sql in spec.items())


# Team strength from batters' plate appearances (the pitcher query needs its own).
_STRENGTH = f"""bpa AS ({_duck_pa("batter").removeprefix("pa AS (")[:-1]}),
ts AS (SELECT season, batter_team AS team,
              CAST(count(*) FILTER (WHERE events IN {_q(K.HIT)}) AS DOUBLE) AS team_runs,
              count(*) FILTER (WHERE events IN ('single', 'double', 'triple', 'home_run', 'walk')) / CAST(count(*) AS DOUBLE) AS team_ops,
              CAST(count(*) FILTER (WHERE events = 'home_run') AS DOUBLE) AS team_hr
       FROM bpa GROUP BY 1, 2)"""


def _context(weight: str) -> str:
    def w(x):
        return (f"sum({x} * CAST(tr.{weight} AS DOUBLE)) / nullif(sum(CASE WHEN {x} IS NOT NULL "
                f"THEN CAST(tr.{weight} AS DOUBLE) END), 0)")
    return f"""ctx AS (SELECT tr.player_id, tr.season, {w('CAST(pf.basic AS DOUBLE)')} AS park_factor,
       {w('ts.team_runs')} AS team_runs, {w('ts.team_ops')} AS team_ops, {w('ts.team_hr')} AS team_hr
  FROM tr LEFT JOIN parks_v pf ON pf.season = tr.season AND pf.team = tr.team
          LEFT JOIN ts ON ts.season = tr.season AND ts.team = tr.team GROUP BY 1, 2),
tstr AS (SELECT player_id, season, string_agg(team, '/' ORDER BY {weight} DESC, team) AS team FROM tr GROUP BY 1, 2)"""


_SPEED = """speed AS (
  SELECT l_suppkey AS player_id, CAST(year(l_shipdate) AS INTEGER) AS season,
         CAST(25.0 + avg(l_discount) * 50 AS DECIMAL(5,2)) AS sprint_speed,
         CAST(4.5 - avg(l_tax) * 5 AS DECIMAL(5,2)) AS hp_to_1b,
         count(*) FILTER (WHERE l_quantity = 50) AS bolts, avg(l_linenumber) AS avg_lineup_pos, count(*) AS games
  FROM lineitem GROUP BY 1, 2)"""

_COUNTS = ["pa", "ab", "h", "1b", "2b", "3b", "hr", "bb", "ibb", "hbp", "k", "sf", "sac", "ci", "gidp"]
_HALF = ["ev", "xwoba", "barrel", "whiff"]


def _regressed(n: str, by: dict) -> str:
    return ", ".join(f"({n} * CAST({s} AS DOUBLE) + {float(k)} * avg(CAST({s} AS DOUBLE)) OVER (PARTITION BY season)) "
                     f"/ ({n} + {float(k)}) AS {s}_regressed" for s, k in by.items())


def hitter_oracle() -> str:
    groups = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in K.POSITION_GROUP.items())
    age = "date_diff('day', birth_date, make_date(CAST(m.season AS INTEGER), 7, 1)) / 365.25"
    pf = "CASE WHEN ctx.park_factor = 0 THEN 100 ELSE ctx.park_factor END"
    gaps = {"xwoba_platoon_gap": "xwoba_vs_L - xwoba_vs_R", "whiff_platoon_gap": "whiff_vs_L - whiff_vs_R",
            **{f"{x}_trend": f"{x}_h2 - {x}_h1" for x in _HALF}}
    rolled = [f"{x}_{n}yr" for x in K.HITTER_ROLLING for n in (2, 3)]
    rates = ["bb_rate", "k_rate", "iso", "sb_rate", "speed_proxy", "hr_per_batted_ball", "xwoba_minus_woba", "avg_minus_xba"]
    out = [big("m.player_id", "player_id"), big("m.season", "season"), "tstr.team AS team"]
    out += [big(f'm."{x}"', x) for x in _COUNTS + ["batted_balls", "sb", "cs", "r", "rbi", "tb"]]
    out += [r6(f"m.{x}", x) for x in ["avg", "obp", "slg", "ops", "woba", "wraa", *K.HITTER_ADVANCED, *rates]]
    out += [r6(f"m.{s}_regressed", f"{s}_regressed") for s in K.HITTER_RELIABILITY] + [r6(f"m.{x}", x) for x in rolled]
    out += [big(f"m.pitches_vs_{s}", f"pitches_vs_{s}") for s in "LR"]
    out += [r6(f"m.{a}_vs_{s}", f"{a}_vs_{s}") for s in "LR" for a in ("ev", "xwoba", "whiff")]
    out += [r6(f"m.{a}_{h}", f"{a}_{h}") for h in ("h1", "h2") for a in _HALF] + [r6(v, k) for k, v in gaps.items()]
    out += ["m.bat_side", "m.primary_position", "CAST(m.birth_date AS VARCHAR) AS birth_date",
            "CAST(m.mlb_debut_date AS VARCHAR) AS mlb_debut_date", big("m.years_experience", "years_experience"),
            r6("m.age", "age"), r6("m.age - 27.0", "age_from_peak"), r6("(m.age - 27.0) * (m.age - 27.0)", "age_from_peak_sq"),
            big("coalesce(m.age > 28, false)", "post_peak"), r6("(m.age - 27.0) * m.speed_proxy", "age_speed"), "m.pos_group",
            big("coalesce(m.primary_position = 'C', false)", "is_catcher"), big("m.pos_group = 'speed_pos'", "is_speed_pos"),
            r6("(m.age - 27.0) * CAST(coalesce(m.primary_position = 'C', false) AS INTEGER)", "age_catcher"),
            r6("(m.age - 27.0) * CAST(m.pos_group = 'speed_pos' AS INTEGER)", "age_speed_pos"),
            r6("ctx.park_factor", "park_factor"), r6(f"m.iso * (100.0 / {pf})", "iso_park_adj"),
            r6("speed.sprint_speed", "sprint_speed"), r6("speed.hp_to_1b", "hp_to_1b"), big("speed.bolts", "bolts"),
            big("speed.games", "competitive_runs"), r6("speed.avg_lineup_pos", "avg_lineup_pos"), big("speed.games", "lineup_games"),
            big("coalesce(speed.avg_lineup_pos <= 1.5, false)", "is_leadoff"),
            big("coalesce(speed.avg_lineup_pos BETWEEN 2.5 AND 5.0, false)", "is_heart"),
            big("coalesce(speed.avg_lineup_pos >= 7.0, false)", "is_bottom")]
    out += [r6(f"ctx.{x}", x) for x in K.TEAM_STRENGTH_COLUMNS]
    out += [r6(f"coalesce(s0.{x}, s1.{x})", x) for x in K.HITTER_MILB_FILL]
    return _BAT_WITH + f""",
{_STRENGTH}, {_SEASON_PITCHES}, {T.DUCK_BIO}, {T.DUCK_OFFICIAL_BATTING}, {_DUCK_BEST.removeprefix('WITH ')}, {_SPEED},
tr AS (SELECT batter AS player_id, season, batter_team AS team, pa FROM bat_lines WHERE split_type = 'team'),
{_context('pa')},
spl AS (SELECT batter AS player_id, season, {_spec(BATTING_ADVANCED)},
               count(*) FILTER (WHERE bb_type IS NOT NULL) AS batted_balls,
               {_platoon_sql()}, {_half_sql()} FROM sp GROUP BY 1, 2),
m0 AS (
  SELECT b.batter AS player_id, b.season, {', '.join(f'b."{x}"' for x in _COUNTS)}, b.avg, b.obp, b.slg, b.ops, b.woba, b.wraa,
         spl.* EXCLUDE (player_id, season), o.stolen_bases AS sb, o.caught_stealing AS cs, o.runs AS r, o.rbi,
         o.total_bases AS tb, bio.bat_side, bio.primary_position, bio.birth_date, bio.mlb_debut_date
  FROM bat_lines b LEFT JOIN spl ON spl.player_id = b.batter AND spl.season = b.season
  LEFT JOIN official_b o ON o.player_id = b.batter AND o.season = b.season AND o.plate_appearances >= {K.MIN_PA}
  LEFT JOIN bio_v bio ON bio.player_id = b.batter
  WHERE b.split_type = 'total' AND b.pa >= {K.MIN_PA}),
m1 AS (
  SELECT *, CAST(bb AS DOUBLE) / pa AS bb_rate, CAST(k AS DOUBLE) / pa AS k_rate, slg - avg AS iso,
         CAST(sb AS DOUBLE) / {nz('(sb + cs)')} AS sb_rate, CAST(sb + "3b" AS DOUBLE) / pa AS speed_proxy,
         CAST(hr AS DOUBLE) / {nz('batted_balls')} AS hr_per_batted_ball, xwoba - woba AS xwoba_minus_woba,
         avg - xba AS avg_minus_xba, greatest(season - year(mlb_debut_date), 0) + (0 * year(mlb_debut_date)) AS years_experience,
         {age.replace('m.season', 'season')} AS age,
         coalesce(CASE primary_position {groups} END, 'other') AS pos_group
  FROM m0),
m AS (SELECT *, {_regressed('pa', K.HITTER_RELIABILITY)}, {', '.join(_duck_roll(x) for x in K.HITTER_ROLLING)} FROM m1)
SELECT {', '.join(out)}
FROM m LEFT JOIN tstr ON tstr.player_id = m.player_id AND tstr.season = m.season
LEFT JOIN ctx ON ctx.player_id = m.player_id AND ctx.season = m.season
LEFT JOIN speed ON speed.player_id = m.player_id AND speed.season = m.season
LEFT JOIN mf s0 ON s0.player_id = m.player_id AND s0.season = m.season
LEFT JOIN mf s1 ON s1.player_id = m.player_id AND s1.season + 1 = m.season"""


_MILB_PITCHING = f"""mp0 AS (
  SELECT l_suppkey AS player_id, CAST(year(l_shipdate) AS INTEGER) AS season,
         CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'AAA' WHEN '2' THEN 'AA'
              WHEN '3' THEN 'High-A' WHEN '4' THEN 'Single-A' ELSE 'Rookie' END AS level, 'T' || o_orderstatus AS team_name,
         CAST(count(*) AS DOUBLE) AS ip, count(*) FILTER (WHERE l_quantity >= 46) AS hr, count(*) FILTER (WHERE l_quantity <= 5) AS bb,
         count(*) FILTER (WHERE l_quantity > 5 AND l_quantity <= 20) AS so, count(*) FILTER (WHERE l_quantity >= 30) AS hits,
         count(*) FILTER (WHERE l_tax >= 0.06) AS er
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2, 3, 4),
mp1 AS (
  SELECT *, row_number() OVER (PARTITION BY player_id, season ORDER BY coalesce(CASE level
           WHEN 'AAA' THEN 1 WHEN 'AA' THEN 2 WHEN 'High-A' THEN 3 WHEN 'Single-A' THEN 4 END, 99), ip DESC, team_name) AS rk
  FROM mp0 WHERE ip >= {K.MILB_MIN_IP}),
mpf AS (
  SELECT player_id, mp1.season, ip AS milb_ip, round_even(er * 9 / ip, 2) AS milb_era, round_even((hits + bb) / ip, 2) AS milb_whip,
         {exact('so * 9 / ip', 2)} AS milb_k_9, {exact('bb * 9 / ip', 2)} AS milb_bb_9, {exact('hr * 9 / ip', 2)} AS milb_hr_9,
         {exact('(13 * hr + 3 * bb - 2 * so) / ip + coalesce(CAST(c.cfip AS DOUBLE), 3.10)', 2)} AS milb_fip,
         {exact('so * 9 / ip', 2)} - {exact('bb * 9 / ip', 2)} AS milb_k_bb
  FROM mp1 LEFT JOIN constants_v c ON c.season = mp1.season WHERE rk = 1)"""

_QS = """qs AS (
  SELECT l_suppkey AS player_id, CAST(year(l_shipdate) AS BIGINT) AS season,
         count(*) FILTER (WHERE l_linenumber <= 2
           AND CAST(CAST(CAST(l_quantity AS INTEGER) // 6 AS VARCHAR) || '.' || CAST(CAST(l_quantity AS INTEGER) % 3 AS VARCHAR) AS DOUBLE) >= 6.0
           AND coalesce(CASE WHEN l_returnflag = 'N' THEN NULL ELSE CAST(floor(l_tax * 100 + 0.5) AS INTEGER) % 5 END, 99) <= 3) AS quality_starts
  FROM lineitem GROUP BY 1, 2)"""

_OFF = ["holds", "blown_saves", "save_opps", "inherited_runners", "inherited_runners_scored", "wild_pitches",
        "complete_games", "shutouts"]


def pitcher_oracle() -> str:
    counts = ["wins", "losses", "saves", "games", "games_started", "tbf", "outs", "h", "1b", "2b", "3b", "hr", "bb", "ibb",
              "hbp", "k", "sf", "sac", *_OFF, "quality_starts", "vsL_pitches", "vsR_pitches"]
    rates = ["ip", "era", "k_pct", "bb_pct", "k_bb", "ba_against", "babip", "whip", "k_9", "bb_9", "hr_9", "hr_fb", "fip",
             *K.PITCHER_ADVANCED, "sv_hld", "starter_pct", "ip_per_start", "fb_brk_velo_diff", "fb_offspeed_velo_diff",
             "gb_fb_ratio", "ir_scored_pct", "babip_minus_xwoba"]
    halves = ["velo", "ev", "xwoba", "whiff"]
    gaps = {f"platoon_{n}_gap": f"vsR_{c} - vsL_{c}" for n, c in (("xwoba", "xwoba"), ("whiff", "whiff_rate"), ("ev", "exit_velo"))}
    gaps |= {f"{x}_trend": f"{x}_h2 - {x}_h1" for x in halves}
    pf = "CASE WHEN ctx.park_factor = 0 THEN 100 ELSE ctx.park_factor END"
    out = [big("m.player_id", "player_id"), big("m.season", "season"), "'total' AS split_type", "tstr.team AS team"]
    out += [big(f'm."{x}"', x) for x in counts] + [r6(f"m.{x}", x) for x in rates]
    out += [r6(f"m.{s}_regressed", f"{s}_regressed") for s in K.PITCHER_RELIABILITY]
    out += [r6(f"m.{x}_{n}yr", f"{x}_{n}yr") for x in K.PITCHER_ROLLING for n in (2, 3)]
    out += [r6(f"m.vs{s}_{a}", f"vs{s}_{a}") for s in "LR" for a in ("exit_velo", "xwoba", "whiff_rate")]
    out += [r6(f"m.{a}_{h}", f"{a}_{h}") for h in ("h1", "h2") for a in halves] + [r6(v, k) for k, v in gaps.items()]
    out += ["m.bat_side", "m.primary_position", "CAST(m.birth_date AS VARCHAR) AS birth_date",
            "CAST(m.mlb_debut_date AS VARCHAR) AS mlb_debut_date", big("m.years_experience", "years_experience"),
            big("m.is_starter", "is_starter"), r6("m.age", "age"), r6("m.age - 28.0", "age_from_peak"),
            r6("(m.age - 28.0) * (m.age - 28.0)", "age_from_peak_sq"), big("coalesce(m.age > 29, false)", "post_peak"),
            r6("(m.age - 28.0) * m.is_starter", "age_starter"), r6("(m.age - 28.0) * (1 - m.is_starter)", "age_reliever"),
            r6("(m.age - 28.0) * m.fb_velo", "age_velo"), r6("ctx.park_factor", "park_factor"),
            r6(f"m.era * (100.0 / {pf})", "era_park_adj"), r6(f"m.fip * (100.0 / {pf})", "fip_park_adj")]
    out += [r6(f"ctx.{x}", x) for x in K.TEAM_STRENGTH_COLUMNS]
    out += [r6(f"coalesce(s0.{x}, s1.{x})", x) for x in K.PITCHER_MILB_FILL]
    return _PIT_WITH + f""",
full_lines AS ({_duck_pitching_select()}), {T.DUCK_PARKS},
{_STRENGTH}, {_SEASON_PITCHES}, {T.DUCK_BIO}, {_MILB_PITCHING}, {_QS},
tr AS (SELECT pitcher AS player_id, season, pitcher_team AS team, ip FROM full_lines WHERE split_type = 'team'),
{_context('ip')},
spl AS (SELECT pitcher AS player_id, season, {_spec(PITCHING_ADVANCED)}, {_pitcher_split_sql()} FROM sp GROUP BY 1, 2),
m0 AS (
  SELECT f.* EXCLUDE (pitcher, pitcher_team, split_type), f.pitcher AS player_id, {', '.join('o.' + x for x in _OFF)},
         spl.* EXCLUDE (player_id, season), qs.quality_starts, bio.bat_side, bio.primary_position, bio.birth_date, bio.mlb_debut_date
  FROM full_lines f LEFT JOIN official_v o ON o.player_id = f.pitcher AND o.season = f.season
  LEFT JOIN spl ON spl.player_id = f.pitcher AND spl.season = f.season
  LEFT JOIN qs ON qs.player_id = f.pitcher AND qs.season = f.season
  LEFT JOIN bio_v bio ON bio.player_id = f.pitcher
  WHERE f.split_type = 'total' AND f.ip >= {K.MIN_IP}),
m1 AS (
  SELECT *, coalesce(CAST(saves AS DOUBLE), 0.0) + coalesce(CAST(holds AS DOUBLE), 0.0) AS sv_hld,
         CAST(games_started AS DOUBLE) / {nz('games')} AS starter_pct,
         CAST(coalesce(CAST(games_started AS DOUBLE) / {nz('games')} >= 0.5, false) AS INTEGER) AS is_starter,
         ip / {nz('games_started')} AS ip_per_start, fb_velo - brk_velo AS fb_brk_velo_diff,
         fb_velo - offspeed_velo AS fb_offspeed_velo_diff, gb_rate / {nz('fb_rate')} AS gb_fb_ratio,
         CAST(inherited_runners_scored AS DOUBLE) / {nz('inherited_runners')} AS ir_scored_pct,
         babip - xwoba_against AS babip_minus_xwoba,
         greatest(season - year(mlb_debut_date), 0) + (0 * year(mlb_debut_date)) AS years_experience,
         date_diff('day', birth_date, make_date(CAST(season AS INTEGER), 7, 1)) / 365.25 AS age
  FROM m0),
m AS (SELECT *, {_regressed('ip', K.PITCHER_RELIABILITY)}, {', '.join(_duck_roll(x) for x in K.PITCHER_ROLLING)} FROM m1)
SELECT {', '.join(out)}
FROM m LEFT JOIN tstr ON tstr.player_id = m.player_id AND tstr.season = m.season
LEFT JOIN ctx ON ctx.player_id = m.player_id AND ctx.season = m.season
LEFT JOIN mpf s0 ON s0.player_id = m.player_id AND s0.season = m.season
LEFT JOIN mpf s1 ON s1.player_id = m.player_id AND s1.season + 1 = m.season"""


@register("q_hitter_features", hitter_oracle())
def q_hitter_features(spark, sf_dir):
    """Full hitter feature matrix, every column (DOM-28)."""
    from seamstat.plans.matrices import hitter_features
    return rounded(hitter_features(T.matrix_inputs(spark, sf_dir)))


@register("q_pitcher_features", pitcher_oracle())
def q_pitcher_features(spark, sf_dir):
    """Full pitcher feature matrix, every column (DOM-29)."""
    from seamstat.plans.matrices import pitcher_features
    return rounded(pitcher_features(T.matrix_inputs(spark, sf_dir)))


_ROLE_COLS = ["sv_hld", "starter_pct", "is_starter", "ip_per_start", "fb_brk_velo_diff",
              "fb_offspeed_velo_diff", "gb_fb_ratio", "ir_scored_pct", "babip_minus_xwoba",
              "avg_lineup_pos", "is_leadoff", "is_heart", "is_bottom"]


@register("q_role_flags", _PIT_WITH + ", full_lines AS (" + _duck_pitching_select() + "), " + _SEASON_PITCHES + f""",
adv AS (SELECT pitcher AS player_id, season, {_spec(PITCHING_ADVANCED)} FROM sp GROUP BY 1, 2),
lineup AS (SELECT l_suppkey AS player_id, CAST(year(l_shipdate) AS BIGINT) AS season, avg(l_linenumber) AS avg_lineup_pos
           FROM lineitem GROUP BY 1, 2),
base AS (
  SELECT f.pitcher AS player_id, f.season, f.saves, f.games, f.games_started, f.ip, f.babip,
         o.holds, o.inherited_runners, o.inherited_runners_scored,
         a.fb_velo, a.brk_velo, a.offspeed_velo, a.gb_rate, a.fb_rate, a.xwoba_against,
         l.avg_lineup_pos
  FROM full_lines f
  LEFT JOIN official_v o ON o.player_id = f.pitcher AND o.season = f.season
  LEFT JOIN adv a ON a.player_id = f.pitcher AND a.season = f.season
  LEFT JOIN lineup l ON l.player_id = f.pitcher AND l.season = f.season
  WHERE f.split_type = 'total'),
r AS (
  SELECT *, CAST(games_started AS DOUBLE) / CASE WHEN games = 0 THEN NULL ELSE CAST(games AS DOUBLE) END AS starter_pct
  FROM base)
SELECT player_id, season,
       coalesce(CAST(saves AS DOUBLE), 0.0) + coalesce(CAST(holds AS DOUBLE), 0.0) AS sv_hld,
       starter_pct, CAST(coalesce(starter_pct >= 0.5, false) AS INTEGER) AS is_starter,
       ip / CASE WHEN games_started = 0 THEN NULL ELSE CAST(games_started AS DOUBLE) END AS ip_per_start,
       fb_velo - brk_velo AS fb_brk_velo_diff, fb_velo - offspeed_velo AS fb_offspeed_velo_diff,
       gb_rate / CASE WHEN fb_rate = 0 THEN NULL ELSE fb_rate END AS gb_fb_ratio,
       inherited_runners_scored / CASE WHEN inherited_runners = 0 THEN NULL
                                       ELSE CAST(inherited_runners AS DOUBLE) END AS ir_scored_pct,
       babip - xwoba_against AS babip_minus_xwoba, avg_lineup_pos,
       CAST(coalesce(avg_lineup_pos <= 1.5, false) AS INTEGER) AS is_leadoff,
       CAST(coalesce(avg_lineup_pos >= 2.5 AND avg_lineup_pos <= 5.0, false) AS INTEGER) AS is_heart,
       CAST(coalesce(avg_lineup_pos >= 7.0, false) AS INTEGER) AS is_bottom
FROM r""")
def q_role_flags(spark, sf_dir):
    """Pitcher role features (saves+holds, starter share and flag, innings
    per start, velocity gaps, ground/fly ratio, inherited runners scored)
    and lineup-slot flags (DOM-18, DOM-25)."""
    from seamstat.operators import features as FT
    from seamstat.operators.advanced import pitching_advanced
    pit = _pitching(spark, sf_dir).where(F.col("split_type") == "total").select(
        F.col("pitcher").alias("player_id"), "season", "saves", "games", "games_started", "ip", "babip")
    off = T.official_pitching(spark, sf_dir).select("player_id", "season", "holds", "inherited_runners",
                                                    "inherited_runners_scored")
    keys = ["player_id", "season"]
    df = pit.join(off, keys, "left").join(pitching_advanced(T.pitches(spark, sf_dir), T.games(spark, sf_dir)), keys, "left") \
        .join(T.lineup_position(spark, sf_dir).select(*keys, "avg_lineup_pos"), keys, "left")
    return FT.lineup_flags(FT.pitcher_rates(df)).select(
        "player_id", F.col("season").cast("bigint").alias("season"), *_ROLE_COLS)

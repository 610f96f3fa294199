"""Season statistics from pitch-level events (DOM-01 .. DOM-12).

``batting_stats`` and ``pitching_stats`` return one row per entity, season
and team (``split_type='team'``) plus one total row per entity and season
(``split_type='total'``, team ``'TOT'``), computed from a single scan with
grouping sets. Rates are exact decimals rounded half away from zero; each
rate is written with a single final division so the rounding sees the exact
ratio.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from seamstat.functions import codes as K
from seamstat.functions.exprs import (c, innings_notation, int_div,
                                      int_mod, pg_round, safe_div)
from seamstat.operators.aggs import rollup_total, together
from seamstat.operators.joins import unique_by


@dataclass(frozen=True)
class PitchCols:
    """Column names of the pitch-level event table."""
    game_pk: str = "game_pk"
    batter: str = "batter"
    pitcher: str = "pitcher"
    events: str = "events"
    inning_topbot: str = "inning_topbot"
    bb_type: str = "bb_type"
    description: str = "description"
    launch_speed: str = "launch_speed"
    launch_angle: str = "launch_angle"
    xwoba: str = "estimated_woba_using_speedangle"
    release_speed: str = "release_speed"
    p_throws: str = "p_throws"
    stand: str = "stand"


@dataclass(frozen=True)
class GameCols:
    game_pk: str = "game_pk"
    game_date: str = "game_date"
    game_type: str = "game_type"
    home_team: str = "home_team"
    away_team: str = "away_team"


P, G = PitchCols(), GameCols()

D0 = DecimalType(20, 0)
CONST = DecimalType(10, 4)


def _d(x, t=D0) -> Column:
    return c(x).cast(t)


def season_range(games: DataFrame, first: int | None, last: int | None,
                 g: GameCols = G) -> DataFrame:
    """Season bound as a date range on the raw column, so Parquet row groups
    (and a partitioned layout) are pruned."""
    d = F.col(g.game_date)
    if first is not None:
        games = games.where(d >= F.make_date(F.lit(first), F.lit(1), F.lit(1)))
    if last is not None:
        games = games.where(d < F.make_date(F.lit(last + 1), F.lit(1), F.lit(1)))
    return games


def prune_seasons(pitches: DataFrame, first: int | None, last: int | None,
                  col: str = "season") -> DataFrame:
    """When the pitch table carries a season (partition) column, bound it
    too, so a season-partitioned layout is pruned at the scan."""
    if col not in pitches.columns:
        return pitches
    if first is not None:
        pitches = pitches.where(F.col(col) >= first)
    if last is not None:
        pitches = pitches.where(F.col(col) <= last)
    return pitches


def regular_games(games: DataFrame, game_type: str = "R", g: GameCols = G,
                  first: int | None = None, last: int | None = None) -> DataFrame:
    return season_range(games.where(F.col(g.game_type) == game_type), first, last, g)


def plate_appearances(pitches: DataFrame, games: DataFrame, role: str = "batter",
                      game_type: str = "R", p: PitchCols = P, g: GameCols = G,
                      first: int | None = None, last: int | None = None) -> DataFrame:
    """Plate-appearance-ending pitches of regular-season games with the
    entity's team (FLT-01, FLT-02, JON-01, PRJ-06).

    Output: ``<role>, season, <role>_team, events, bb_type``. The batting
    team is the away team in the top half-inning, else the home team; the
    fielding team is the reverse (an unknown half-inning takes the else
    branch).
    """
    entity = p.batter if role == "batter" else p.pitcher
    ev = F.col(p.events)
    pa = pitches.where(ev.isNotNull() & ~ev.isin(list(K.NOT_A_PA))) \
        .select(p.game_pk, entity, p.events, p.inning_topbot, p.bb_type)
    gm = regular_games(games, game_type, g, first, last) \
        .select(g.game_pk, g.game_date, g.home_team, g.away_team)
    top = F.col(p.inning_topbot) == "Top"
    if role == "batter":
        team = F.when(top, F.col(g.away_team)).otherwise(F.col(g.home_team))
    else:
        team = F.when(top, F.col(g.home_team)).otherwise(F.col(g.away_team))
    return pa.join(gm, p.game_pk if p.game_pk == g.game_pk else
                   pa[p.game_pk] == gm[g.game_pk], "inner").select(
        F.col(entity).alias(role), F.year(g.game_date).alias("season"),
        team.alias(f"{role}_team"), F.col(p.events).alias("events"),
        F.col(p.bb_type).alias("bb_type"))


def _ev(*codes: str) -> Column:
    return F.col("events").isin(list(codes))


def batting_counters() -> list[tuple[str, Column]]:
    """(name, condition) of every batting counter; ``pa`` counts all rows."""
    ev = F.col("events")
    return [
        ("pa", F.lit(True)),
        ("ab", ~ev.isin(list(K.NOT_AN_AT_BAT))),
        ("h", _ev(*K.HIT)), ("1b", _ev(*K.SINGLE)), ("2b", _ev(*K.DOUBLE)),
        ("3b", _ev(*K.TRIPLE)), ("hr", _ev(*K.HOME_RUN)), ("bb", _ev(*K.WALK)),
        ("ibb", _ev(*K.INTENT_WALK)), ("hbp", _ev(*K.HIT_BY_PITCH)),
        ("k", _ev(*K.STRIKEOUT)), ("sf", _ev(*K.SAC_FLY)), ("sac", _ev(*K.SAC_BUNT)),
        ("ci", _ev(*K.CATCHER_INTERF)), ("gidp", _ev(*K.GIDP)),
    ]


def pitching_counters() -> list[tuple[str, Column]]:
    """(name, condition) of every pitching counter; ``tbf`` counts all rows.
    Outs are ``out1 + 2 out2 + 3 out3``."""
    return [
        ("tbf", F.lit(True)), ("h", _ev(*K.HIT)), ("1b", _ev(*K.SINGLE)),
        ("2b", _ev(*K.DOUBLE)), ("3b", _ev(*K.TRIPLE)), ("hr", _ev(*K.HOME_RUN)),
        ("bb", _ev(*K.WALK)), ("ibb", _ev(*K.INTENT_WALK)), ("hbp", _ev(*K.HIT_BY_PITCH)),
        ("k", _ev(*K.STRIKEOUT)), ("sf", _ev(*K.SAC_FLY)), ("sac", _ev(*K.SAC_BUNT)),
        ("fly_balls", F.col("bb_type") == K.FLY_BALL),
        ("__out1", _ev(*K.ONE_OUT)), ("__out2", _ev(*K.TWO_OUTS)), ("__out3", _ev(*K.THREE_OUTS)),
    ]


def event_counts(pitches: DataFrame, games: DataFrame, role: str,
                 counters: list[tuple[str, Column]], game_type: str = "R",
                 p: PitchCols = P, g: GameCols = G, first: int | None = None,
                 last: int | None = None) -> DataFrame:
    """Counters per (entity, season, team) plus total rows, with the
    aggregation pushed below the join with games.

    Plate appearances are first counted per (game, entity, half-inning) and
    kind -- the set of counters one adds to, as bits -- so the join shuffles
    narrow rows, at most one per plate appearance, whatever the number of
    counters. Team and season are functions of the game; the counters are
    formed where the rows of an entity and season lie together, so no task
    holds wide groups of entities spread over all games. There is this one
    plan at every size; Spark alone chooses how to join.
    """
    if len(counters) > 30:
        raise ValueError("at most 30 counters")
    entity = p.batter if role == "batter" else p.pitcher
    ev = F.col(p.events)
    pa = prune_seasons(pitches, first, last).where(ev.isNotNull() & ~ev.isin(list(K.NOT_A_PA))).select(
        F.col(p.game_pk).alias("__g"), F.col(entity).alias(role),
        F.col(p.inning_topbot).alias("__half"), F.col(p.events).alias("events"),
        F.col(p.bb_type).alias("bb_type"))
    # Bit 0 is the top half-inning, bit i + 1 counter i.
    bits = [F.col("__half") == "Top", *(cond for _, cond in counters)]
    half = reduce(lambda x, y: x + y, (F.when(b, F.lit(1 << i)).otherwise(F.lit(0))
                                       for i, b in enumerate(bits)))
    names = [n for n, _ in counters]
    gm = regular_games(games, game_type, g, first, last).select(
        F.col(g.game_pk).alias("__g"), g.game_date, g.home_team, g.away_team)
    pre = pa.select("__g", role, half.alias("__half")).groupBy("__g", role, "__half") \
        .agg(F.count(F.lit(1)).alias("__n"))
    top = F.col("__half").bitwiseAND(F.lit(1)) != 0
    if role == "batter":
        team = F.when(top, F.col(g.away_team)).otherwise(F.col(g.home_team))
    else:
        team = F.when(top, F.col(g.home_team)).otherwise(F.col(g.away_team))
    j = pre.join(gm, "__g").select(role, F.year(g.game_date).alias("season"),
                                   team.alias(f"{role}_team"), "__half", "__n")
    has = lambda i: F.col("__half").bitwiseAND(F.lit(2 << i)) != 0
    return rollup_total(together(j, [role, "season"]), [role, "season"], f"{role}_team",
                        [F.sum(F.when(has(i), F.col("__n")).otherwise(F.lit(0))).cast("bigint").alias(n)
                         for i, n in enumerate(names)])


# ------------------------------------------------------------- batting --
def slash_line(df: DataFrame) -> DataFrame:
    """AVG, OBP, SLG (3 decimals) and OPS = round(obp + slg) of the already
    rounded parts (DOM-02)."""
    tb = F.col("1b") + 2 * F.col("2b") + 3 * F.col("3b") + 4 * F.col("hr")
    df = df.withColumns({
        "avg": pg_round(safe_div(_d("h"), _d("ab")), 3),
        "obp": pg_round(safe_div(_d(F.col("h") + F.col("bb") + F.col("hbp")),
                                 _d(F.col("ab") + F.col("bb") + F.col("hbp") + F.col("sf"))), 3),
        "slg": pg_round(safe_div(_d(tb), _d("ab")), 3),
    })
    return df.withColumn("ops", pg_round(F.col("obp") + F.col("slg"), 3))


def woba_parts(df: DataFrame) -> DataFrame:
    """Weighted-event numerator (unintentional walks) and denominator
    (DOM-03) from joined season constants."""
    w = lambda n: F.col(n).cast(CONST)
    num = (w("wbb") * _d(F.col("bb") - F.col("ibb")) + w("whbp") * _d("hbp") +
           w("w1b") * _d("1b") + w("w2b") * _d("2b") + w("w3b") * _d("3b") +
           w("whr") * _d("hr"))
    den = F.col("ab") + F.col("bb") - F.col("ibb") + F.col("sf") + F.col("hbp")
    return df.withColumns({"woba_num": num.cast(DecimalType(22, 4)),
                           "woba_denom": den.cast(DecimalType(12, 0))})


def woba_rates(df: DataFrame, park_col: str | None = "park_factor") -> DataFrame:
    """wOBA (3), wRAA (1) and park-adjusted wRC+ (0) (DOM-03..05).

    wRAA = ((wOBA - lg_wOBA) / scale) * PA and wRC+ = ((wOBA - lg)/scale +
    lgR + (lgR - pf/100 * lgR)) / lgR * 100 with the unrounded wOBA, each
    rewritten over one common denominator. Null on a zero denominator (also
    for a zero scale, where a SQL engine would raise).
    """
    n, d = F.col("woba_num"), F.col("woba_denom")
    lg, sc, lr = (F.col(x).cast(CONST) for x in ("lg_woba", "woba_scale", "lg_r_pa"))
    pa = F.col("pa").cast(DecimalType(12, 0))
    excess = n - lg * d                       # (wOBA - lg) * denom
    wraa = safe_div((excess * pa).cast(DecimalType(24, 4)),
                    (d * sc).cast(DecimalType(16, 4)))
    out = {"woba": pg_round(safe_div(n, d), 3), "wraa": pg_round(wraa, 1)}
    if park_col is not None:
        pf = F.col(park_col).cast(CONST)
        wnum = (F.lit(100).cast(DecimalType(3, 0)) * excess +
                d * sc * lr * (F.lit(200).cast(DecimalType(3, 0)) - pf))
        wden = d * sc * lr
        out["wrc_plus"] = pg_round(safe_div(wnum.cast(DecimalType(26, 12)),
                                            wden.cast(DecimalType(20, 8))), 0)
    return df.withColumns(out)


BATTING_COLUMNS = ["batter", "batter_team", "split_type", "season", "pa", "ab",
                   "h", "1b", "2b", "3b", "hr", "bb", "ibb", "hbp", "k", "sf",
                   "sac", "ci", "gidp", "avg", "obp", "slg", "ops", "woba",
                   "wraa", "wrc_plus", "park_factor"]


def batting_counts(pitches: DataFrame, games: DataFrame, first: int | None = None,
                   last: int | None = None, p: PitchCols = P, g: GameCols = G) -> DataFrame:
    """Team rows and total rows of the batting counters (AGG-01, AGG-03)."""
    return event_counts(pitches, games, "batter", batting_counters(), p=p, g=g,
                        first=first, last=last)


def batting_stats(pitches: DataFrame, games: DataFrame, constants: DataFrame,
                  parks: DataFrame, first: int | None = None,
                  last: int | None = None, p: PitchCols = P,
                  g: GameCols = G) -> DataFrame:
    """Batting lines per batter-season-team plus totals (DOM-01).

    ``constants``: season, wbb, whbp, w1b, w2b, w3b, whr, lg_woba,
    woba_scale, lg_r_pa (one row per season; inner join drops seasons
    without constants). ``parks``: season, team, basic (left join, team rows
    only).
    """
    counts = batting_counts(pitches, games, first, last, p, g)
    const = constants.select("season", "wbb", "whbp", "w1b", "w2b", "w3b", "whr",
                             "lg_woba", "woba_scale", "lg_r_pa")
    pf = parks.select(F.col("season").alias("__ps"), F.col("team").alias("__pt"),
                      F.col("basic").alias("__pf"))
    df = counts.join(unique_by(const, ["season"], "constants"), "season")
    df = df.join(pf, (df["season"] == pf["__ps"]) & (df["batter_team"] == pf["__pt"]) &
                 (df["split_type"] == "team"), "left")
    df = df.withColumn("park_factor", F.col("__pf"))
    df = woba_rates(woba_parts(slash_line(df)))
    df = df.withColumn("wrc_plus", F.when(F.col("split_type") == "team", F.col("wrc_plus")))
    return df.select(*BATTING_COLUMNS)


# ------------------------------------------------------------ pitching --
PITCHING_COLUMNS = ["pitcher", "pitcher_team", "split_type", "season", "wins",
                    "losses", "saves", "games", "games_started", "tbf", "ip",
                    "outs", "h", "1b", "2b", "3b", "hr", "bb", "ibb", "hbp", "k",
                    "sf", "sac", "era", "k_pct", "bb_pct", "k_bb", "ba_against",
                    "babip", "whip", "k_9", "bb_9", "hr_9", "hr_fb", "fip"]


def per_nine(df: DataFrame) -> DataFrame:
    """ERA, WHIP, K/9, BB/9, HR/9 over innings = outs / 3 (DOM-09).
    ``x * 9 / (outs / 3)`` is written ``27 x / outs``."""
    o = _d("outs")
    per9 = lambda x: pg_round(safe_div(_d(F.col(x) * 27), o), 2)
    return df.withColumns({
        "era": per9("earned_runs"),
        "whip": pg_round(safe_div(_d((F.col("h") + F.col("bb")) * 3), o), 2),
        "k_9": per9("k"), "bb_9": per9("bb"), "hr_9": per9("hr"),
    })


def k_bb_rates(df: DataFrame) -> DataFrame:
    """K% and BB% (x100, 1 decimal) and K/BB (2) (DOM-10)."""
    return df.withColumns({
        "k_pct": pg_round(safe_div(_d(F.col("k") * 100), _d("tbf")), 1),
        "bb_pct": pg_round(safe_div(_d(F.col("bb") * 100), _d("tbf")), 1),
        "k_bb": pg_round(safe_div(_d("k"), _d("bb")), 2),
    })


def contact_rates(df: DataFrame) -> DataFrame:
    """BA against, BABIP and HR per fly ball (DOM-11)."""
    col = F.col
    return df.withColumns({
        "ba_against": pg_round(safe_div(_d("h"), _d(col("tbf") - col("bb") - col("hbp") -
                                                      col("sf") - col("sac"))), 3),
        "babip": pg_round(safe_div(_d(col("h") - col("hr")),
                                   _d(col("tbf") - col("bb") - col("hbp") - col("sac") -
                                      col("k") - col("hr"))), 3),
        "hr_fb": pg_round(safe_div(_d("hr"), _d("fly_balls")), 3),
    })


def fip(df: DataFrame) -> DataFrame:
    """FIP = (13 HR + 3 (BB + HBP) - 2 K) / IP + season constant (DOM-12)."""
    col = F.col
    core = _d((13 * col("hr") + 3 * (col("bb") + col("hbp")) - 2 * col("k")) * 3)
    cf = col("cfip").cast(CONST)
    return df.withColumn("fip", pg_round(
        safe_div((core + cf * _d("outs")).cast(DecimalType(24, 4)), _d("outs")), 2))


def innings(df: DataFrame) -> DataFrame:
    """IP notation (x.1 / x.2 per extra out) (DOM-08)."""
    return df.withColumn("ip", innings_notation("outs"))


def pitching_counts(pitches: DataFrame, games: DataFrame, first: int | None = None,
                    last: int | None = None, p: PitchCols = P, g: GameCols = G) -> DataFrame:
    """Team and total rows of the pitching counters with derived outs
    (AGG-02, AGG-03)."""
    c = event_counts(pitches, games, "pitcher", pitching_counters(), p=p, g=g,
                     first=first, last=last)
    return c.withColumn("derived_outs", F.col("__out1") + 2 * F.col("__out2") + 3 * F.col("__out3")) \
        .drop("__out1", "__out2", "__out3")


def apportion_outs(counts: DataFrame) -> DataFrame:
    """Official outs spread over team rows (DOM-07). ``counts`` carries team
    and total rows with ``official_outs``; the window is per entity-season
    over team rows only (at most one row per team)."""
    from pyspark.sql import Window
    w = Window.partitionBy("pitcher", "season", "split_type")
    diff = F.col("official_outs") - F.sum("derived_outs").over(w)
    n = F.count(F.lit(1)).over(w)
    rn = F.row_number().over(w.orderBy("pitcher_team"))
    team_outs = (F.col("derived_outs") + int_div(diff, n) +
                 F.when(rn <= int_mod(diff, n), 1).otherwise(0))
    return counts.withColumn("outs", F.when(F.col("split_type") == "team", team_outs)
                             .otherwise(F.col("official_outs")).cast("bigint"))


def pitching_stats(pitches: DataFrame, games: DataFrame, official: DataFrame,
                   constants: DataFrame, first: int | None = None,
                   last: int | None = None, p: PitchCols = P,
                   g: GameCols = G) -> DataFrame:
    """Pitching lines per pitcher-season-team plus totals (DOM-06).

    ``official``: player_id, season, outs, wins, losses, saves, games_played,
    games_started, earned_runs. Inner join: entity-seasons without an
    official line are dropped. Team rows get apportioned outs and null
    official counts (so a null ERA).
    """
    counts = pitching_counts(pitches, games, first, last, p, g)
    off = official.select(F.col("player_id").alias("pitcher"), "season",
                          F.col("outs").alias("official_outs"), "wins", "losses",
                          "saves", F.col("games_played").alias("games"),
                          "games_started", "earned_runs")
    df = counts.join(unique_by(off, ["pitcher", "season"], "official lines"), ["pitcher", "season"])
    df = apportion_outs(df)
    team = F.col("split_type") == "team"
    df = df.withColumns({x: F.when(~team, F.col(x)).cast("bigint") for x in
                         ("wins", "losses", "saves", "games", "games_started", "earned_runs")})
    df = df.join(unique_by(constants.select("season", "cfip"), ["season"], "constants"), "season")
    df = fip(contact_rates(k_bb_rates(per_nine(innings(df)))))
    return df.select(*PITCHING_COLUMNS)

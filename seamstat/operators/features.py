"""Player-season feature operators (DOM-15 .. DOM-29).

Each function adds columns to a player-season frame keyed by
(``player_id``, ``season``). Arithmetic is double precision, as in a
float64 frame; unknown values are nulls (never NaN).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seamstat.functions import codes as K
from seamstat.functions.exprs import (age_years, c, clip_low, flag, map_lookup,
                                      park_adjust, safe_div)
from seamstat.operators.aggs import group_means, ordered_concat, weighted_avg
from seamstat.operators.joins import with_prior_year
from seamstat.operators.windows import first_per, rolling_wavg

KEYS = ["player_id", "season"]


def _dbl(x) -> Column:
    return c(x).cast("double")


def _nz(x) -> Column:
    """Denominator with 0 read as unknown (``replace(0, nan)``)."""
    x = _dbl(x)
    return F.when(x == 0, F.lit(None)).otherwise(x)


# ------------------------------------------------------------- derived --
def hitter_rates(df: DataFrame) -> DataFrame:
    """bb_rate, k_rate, iso, sb_rate, speed_proxy, hr_per_batted_ball,
    xwoba_minus_woba, avg_minus_xba (fractions, DOM-17)."""
    col = F.col
    return df.withColumns({
        "bb_rate": safe_div(_dbl("bb"), _dbl("pa")),
        "k_rate": safe_div(_dbl("k"), _dbl("pa")),
        "iso": _dbl("slg") - _dbl("avg"),
        "sb_rate": _dbl("sb") / _nz(col("sb") + col("cs")),
        "speed_proxy": safe_div(_dbl(col("sb") + col("3b")), _dbl("pa")),
        "hr_per_batted_ball": _dbl("hr") / _nz("batted_balls"),
        "xwoba_minus_woba": _dbl("xwoba") - _dbl("woba"),
        "avg_minus_xba": _dbl("avg") - _dbl("xba"),
    })


def pitcher_rates(df: DataFrame) -> DataFrame:
    """sv_hld, starter_pct, is_starter, ip_per_start, velocity gaps,
    gb_fb_ratio, ir_scored_pct, babip_minus_xwoba (DOM-18). ``ip_per_start``
    is null without starts."""
    col = F.col
    starter_pct = _dbl("games_started") / _nz("games")
    return df.withColumns({
        "sv_hld": F.coalesce(_dbl("saves"), F.lit(0.0)) + F.coalesce(_dbl("holds"), F.lit(0.0)),
        "starter_pct": starter_pct,
        "is_starter": flag(starter_pct >= 0.5),
        "ip_per_start": _dbl("ip") / _nz("games_started"),
        "fb_brk_velo_diff": _dbl("fb_velo") - _dbl("brk_velo"),
        "fb_offspeed_velo_diff": _dbl("fb_velo") - _dbl("offspeed_velo"),
        "gb_fb_ratio": _dbl("gb_rate") / _nz("fb_rate"),
        "ir_scored_pct": _dbl("inherited_runners_scored") / _nz("inherited_runners"),
        "babip_minus_xwoba": _dbl("babip") - _dbl(col("xwoba_against")),
    })


# --------------------------------------------------- regression to mean --
def regress_to_mean(df: DataFrame, n_col: str, k_by_stat: Mapping[str, int],
                    by: str = "season") -> DataFrame:
    """``(n x + k mean) / (n + k)`` per stat (DOM-15, JON-13, AGG-08).

    The mean is the unweighted, null-skipping mean over the rows of ``df``
    per ``by`` value, computed as a partial aggregate (one row per season)
    and joined back; no window gathers a whole season in one task.
    """
    stats = list(k_by_stat)
    means = group_means(df.select(by, *stats), [by], stats, prefix="__lg_")
    out = df.join(means, by, "left")
    n = _dbl(n_col)
    out = out.withColumns({
        f"{s}_regressed": (n * _dbl(s) + F.lit(float(k)) * F.col(f"__lg_{s}")) / (n + F.lit(float(k)))
        for s, k in k_by_stat.items()})
    return out.drop(*[f"__lg_{s}" for s in stats])


# ------------------------------------------------------------- rolling --
def rolling_features(df: DataFrame, cols: Sequence[str], entity: str = "player_id",
                     order: str = "season") -> DataFrame:
    """2- and 3-season weighted rolling means of each column (DOM-16)."""
    return rolling_wavg(df, cols, entity, order, (2, 3))


# ---------------------------------------------------------- bio / age --
def experience(df: DataFrame, season: str = "season",
               debut: str = "mlb_debut_date") -> DataFrame:
    """Years since debut, floored at 0; unknown debut stays null (DOM-19)."""
    return df.withColumn("years_experience",
                         clip_low(F.col(season) - F.year(F.col(debut)), 0))


def age_curve(df: DataFrame, role: str = "hitter") -> DataFrame:
    """Age at July 1 and aging-curve terms (DOM-20)."""
    hitter = role == "hitter"
    peak, post = ((K.HITTER_AGE_PEAK, K.HITTER_POST_PEAK) if hitter
                  else (K.PITCHER_AGE_PEAK, K.PITCHER_POST_PEAK))
    age = age_years(F.col("birth_date"), F.col("season"))
    df = df.withColumn("age", age)
    a = F.col("age") - F.lit(float(peak))
    df = df.withColumns({"age_from_peak": a})
    a = F.col("age_from_peak")
    out = {"age_from_peak_sq": a * a, "post_peak": flag(F.col("age") > post)}
    if hitter:
        df = df.withColumns(out).withColumns({
            "age_speed": a * _dbl("speed_proxy"),
            "pos_group": map_lookup("primary_position", K.POSITION_GROUP,
                                    K.POSITION_GROUP_DEFAULT)})
        return df.withColumns({
            "is_catcher": flag(F.col("primary_position") == "C"),
            "is_speed_pos": flag(F.col("pos_group") == "speed_pos"),
        }).withColumns({
            "age_catcher": a * F.col("is_catcher"),
            "age_speed_pos": a * F.col("is_speed_pos"),
        })
    out.update({"age_starter": a * F.col("is_starter"),
                "age_reliever": a * (1 - F.col("is_starter")),
                "age_velo": a * _dbl("fb_velo")})
    return df.withColumns(out)


def lineup_flags(df: DataFrame, col: str = "avg_lineup_pos") -> DataFrame:
    """Lead-off (<= 1.5), heart (2.5 - 5.0), bottom (>= 7.0); unknown -> 0
    (DOM-25)."""
    x = F.col(col)
    return df.withColumns({"is_leadoff": flag(x <= 1.5),
                           "is_heart": flag((x >= 2.5) & (x <= 5.0)),
                           "is_bottom": flag(x >= 7.0)})


# ------------------------------------------------------ team context --
def team_string(team_rows: DataFrame, team: str = "team", weight: str = "pa",
                keys: Sequence[str] = KEYS, count: str | None = None) -> DataFrame:
    """Display team string, teams by playing time descending then name
    (``B/A/C``), and with ``count`` their number (AGG-10)."""
    more = [F.count(F.lit(1)).cast("bigint").alias(count)] if count else []
    return team_rows.groupBy(*keys).agg(
        ordered_concat(team, f"{weight} DESC, {team}").alias("team"), *more)


def weighted_context(team_rows: DataFrame, dim: DataFrame, cols: Sequence[str],
                     weight: str, team: str = "team",
                     keys: Sequence[str] = KEYS) -> DataFrame:
    """Playing-time-weighted mean of team-season context (park factor,
    team strength) over the teams of a player-season (DOM-21, AGG-09).

    ``dim`` is keyed by (season, team); Spark broadcasts it when small
    and sort-merge joins it otherwise. The weighted mean is a partial
    aggregate.
    """
    j = team_rows.join(dim.select("season", team, *cols), ["season", team], "left")
    return j.groupBy(*keys).agg(*[weighted_avg(x, weight).alias(x) for x in cols])


def park_adjusted(df: DataFrame, cols: Mapping[str, str], pf: str = "park_factor") -> DataFrame:
    """``{out: in}``: in * 100 / park factor (zero factor = neutral) (DOM-22)."""
    return df.withColumns({o: park_adjust(_dbl(i), _dbl(pf)) for o, i in cols.items()})


# --------------------------------------------------------------- MiLB --
def best_level(milb: DataFrame, volume: str) -> DataFrame:
    """Highest level per player-season (AAA first); ties go to the larger
    volume, then team name (WIN-06, DOM-23)."""
    rank = map_lookup("level", K.LEVEL_RANK).cast("int")
    order = [F.coalesce(rank, F.lit(99)), -F.coalesce(_dbl(volume), F.lit(0.0)),
             F.coalesce(F.col("team_name"), F.lit(""))]
    return first_per(milb, KEYS, order)


def milb_hitter_features(milb: DataFrame) -> DataFrame:
    """Best-level minor-league batting rates per player-season."""
    m = best_level(milb.where(F.col("pa") >= K.MILB_MIN_PA), "pa")
    pa = _nz("pa")
    return m.select(*KEYS,
                    _dbl("pa").alias("milb_pa"), _dbl("avg").alias("milb_avg"),
                    _dbl("obp").alias("milb_obp"), _dbl("slg").alias("milb_slg"),
                    _dbl("ops").alias("milb_ops"),
                    (_dbl("slg") - _dbl("avg")).alias("milb_iso"),
                    (_dbl("bb") / pa).alias("milb_bb_rate"),
                    (_dbl("so") / pa).alias("milb_k_rate"),
                    (_dbl("hr") / pa).alias("milb_hr_rate"),
                    (_dbl("sb") / pa).alias("milb_sb_rate"))


def milb_pitcher_features(milb: DataFrame) -> DataFrame:
    """Best-level minor-league pitching rates; milb_k_bb = k_9 - bb_9."""
    m = best_level(milb.where(F.col("ip") >= K.MILB_MIN_IP), "ip")
    return m.select(*KEYS, *[_dbl(x).alias("milb_" + x) for x in
                             ("ip", "era", "whip", "k_9", "bb_9", "hr_9", "fip")]) \
        .withColumn("milb_k_bb", F.col("milb_k_9") - F.col("milb_bb_9"))


def with_milb(df: DataFrame, milb_feats: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Same-season minor-league values, else prior season, per column (T11)."""
    return with_prior_year(df, milb_feats, ["player_id"], "season", cols, 1)

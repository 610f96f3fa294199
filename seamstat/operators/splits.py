"""Platoon and half-season split features (DOM-13, DOM-14, JON-07).

Both come from ONE scan of pitches: the pitches' few columns are joined to
regular-season games, rows of an entity and season are laid together, and
their values are summed per (entity, season). Every split value is a
conditional aggregate of the values -- a pivot done inside the aggregation
(no per-side aggregation, no join per side). A side or half with no pitches
yields nulls, as a left join of the pivoted rows would. Averages and ratios
are formed only at the end from sums and counts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seamstat.functions import codes as K
from seamstat.functions.exprs import is_barrel, pg_round_double
from seamstat.operators.aggs import together
from seamstat.operators.stats import G, P, GameCols, PitchCols, prune_seasons, regular_games

# A value of a pitch: the mask where it counts, and what is summed there (None: 1).
Value = tuple[Column, Column | None]


def _season_pitches(pitches: DataFrame, games: DataFrame, entity: str,
                    p: PitchCols, g: GameCols, first, last, values: dict[str, Value]) -> DataFrame:
    """Values of each pitch, to be summed, with its game's season and month.

    The join and the exchange move narrow rows: the masks as bits of one
    number and the columns that the values are formed from. The values, of
    which there are many, are formed behind them.
    """
    if len(values) > 62:
        raise ValueError("at most 62 values")
    gm = regular_games(games, "R", g, first, last).select(F.col(g.game_pk).alias("__g"),
                                                          F.col(g.game_date).alias("__date"))
    masks = reduce(lambda x, y: x + y, (F.when(m, F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint")
                                        for i, (m, _) in enumerate(values.values())))
    rows = prune_seasons(pitches, first, last).withColumns(
        {"__g": F.col(p.game_pk), "__player": F.col(entity), "__masks": masks}).join(gm, "__g") \
        .withColumns({"__season": F.year("__date"), "__month": F.month("__date")})
    return together(rows, ["__player", "__season"]).select(
        F.col("__player").alias("player_id"), F.col("__season").alias("season"), "__month",
        *[(F.when(F.col("__masks").bitwiseAND(F.lit(1 << i)) != 0, x) if x is not None else
           F.shiftright("__masks", i).bitwiseAND(F.lit(1))).alias(k)
          for i, (k, (_, x)) in enumerate(values.items())])


def _sum(mask: Column, x: Column) -> Value:
    return mask, x


def _n(mask: Column, x: Column | None = None) -> Value:
    return (mask if x is None else mask & x.isNotNull()), None


def _tot(name: str, mask: Column | None = None) -> Column:
    v = F.col(name) if mask is None else F.when(mask, F.col(name))
    return F.sum(v)


def _avg_of(sum_name: str, n_name: str, mask: Column | None, digits: int) -> Column:
    return pg_round_double(_tot(sum_name, mask) / F.nullif(_tot(n_name, mask), F.lit(0)), digits)


def _whiff_of(w: str, sw: str, mask: Column | None) -> Column:
    num = _tot(w, mask).cast("decimal(20,0)")
    den = _tot(sw, mask).cast("decimal(20,0)")
    return pg_round_double(num / F.nullif(den, F.lit(0)), 3)


def _pitch_values(p: PitchCols, side_col: str, release: bool) -> dict[str, Value]:
    ls, xw, d = F.col(p.launch_speed), F.col(p.xwoba), F.col(p.description)
    tracked = ls.isNotNull()
    whiff, swing = d.isin(list(K.WHIFF)), d.isin(list(K.SWING))
    out: dict[str, Value] = {}
    for side in ("L", "R"):
        m = F.col(side_col) == side
        out.update({f"n_{side}": _n(m), f"ls_s_{side}": _sum(m & tracked, ls),
                    f"ls_n_{side}": _n(m & tracked, ls), f"xw_s_{side}": _sum(m & tracked, xw),
                    f"xw_n_{side}": _n(m & tracked, xw), f"wh_{side}": _n(m & whiff),
                    f"sw_{side}": _n(m & swing)})
    t = F.lit(True)
    out.update({"ls_s": _sum(tracked, ls), "ls_n": _n(tracked, ls), "xw_s": _sum(tracked, xw),
                "xw_n": _n(tracked, xw), "wh": _n(whiff), "sw": _n(swing)})
    if release:
        out.update({"rs_s": _sum(t, F.col(p.release_speed)), "rs_n": _n(t, F.col(p.release_speed))})
    else:
        b = is_barrel(ls, F.col(p.launch_angle)).cast("int")
        out.update({"br_s": _sum(tracked, b), "br_n": _n(tracked, b)})
    return out


def hitter_split_features(pitches: DataFrame, games: DataFrame,
                          first: int | None = None, last: int | None = None,
                          p: PitchCols = P, g: GameCols = G,
                          advanced: bool = False) -> DataFrame:
    """Per batter-season: vs-left / vs-right pitcher pitches, exit velocity,
    xwOBA and whiff rate with L-R gaps; first / second half exit velocity,
    xwOBA, barrel rate and whiff rate with H2-H1 trends. With
    ``advanced=True`` the season advanced metrics come from the same pass."""
    from seamstat.operators import advanced as A
    spec = A.batting_advanced_spec(p) if advanced else {}
    df = _season_pitches(pitches, games, p.batter, p, g, first, last,
                         {**_pitch_values(p, p.p_throws, release=False), **A.spec_values(spec)})
    aggs = A.spec_finals(spec)
    for side in ("L", "R"):
        aggs += [F.nullif(_tot(f"n_{side}"), F.lit(0)).cast("bigint").alias(f"pitches_vs_{side}"),
                 _avg_of(f"ls_s_{side}", f"ls_n_{side}", None, 1).alias(f"ev_vs_{side}"),
                 _avg_of(f"xw_s_{side}", f"xw_n_{side}", None, 3).alias(f"xwoba_vs_{side}"),
                 _whiff_of(f"wh_{side}", f"sw_{side}", None).alias(f"whiff_vs_{side}")]
    h2 = F.coalesce(F.col("__month") >= 7, F.lit(False))
    for half, m in (("h1", ~h2), ("h2", h2)):
        aggs += [_avg_of("ls_s", "ls_n", m, 1).alias(f"ev_{half}"),
                 _avg_of("xw_s", "xw_n", m, 3).alias(f"xwoba_{half}"),
                 _avg_of("br_s", "br_n", m, 3).alias(f"barrel_{half}"),
                 _whiff_of("wh", "sw", m).alias(f"whiff_{half}")]
    out = df.groupBy("player_id", "season").agg(*aggs)
    col = F.col
    return out.withColumns({
        "xwoba_platoon_gap": col("xwoba_vs_L") - col("xwoba_vs_R"),
        "whiff_platoon_gap": col("whiff_vs_L") - col("whiff_vs_R"),
        "ev_trend": col("ev_h2") - col("ev_h1"),
        "xwoba_trend": col("xwoba_h2") - col("xwoba_h1"),
        "barrel_trend": col("barrel_h2") - col("barrel_h1"),
        "whiff_trend": col("whiff_h2") - col("whiff_h1"),
    })


def pitcher_split_features(pitches: DataFrame, games: DataFrame,
                           first: int | None = None, last: int | None = None,
                           p: PitchCols = P, g: GameCols = G,
                           advanced: bool = False) -> DataFrame:
    """Per pitcher-season: vs-left / vs-right batter splits with R-L gaps;
    first / second half velocity, exit velocity, xwOBA and whiff rate with
    H2-H1 trends. With ``advanced=True`` the season advanced metrics come
    from the same pass."""
    from seamstat.operators import advanced as A
    spec = A.pitching_advanced_spec(p) if advanced else {}
    df = _season_pitches(pitches, games, p.pitcher, p, g, first, last,
                         {**_pitch_values(p, p.stand, release=True), **A.spec_values(spec)})
    aggs = A.spec_finals(spec)
    for side in ("L", "R"):
        aggs += [F.nullif(_tot(f"n_{side}"), F.lit(0)).cast("bigint").alias(f"vs{side}_pitches"),
                 _avg_of(f"ls_s_{side}", f"ls_n_{side}", None, 1).alias(f"vs{side}_exit_velo"),
                 _avg_of(f"xw_s_{side}", f"xw_n_{side}", None, 3).alias(f"vs{side}_xwoba"),
                 _whiff_of(f"wh_{side}", f"sw_{side}", None).alias(f"vs{side}_whiff_rate")]
    h1 = F.coalesce(F.col("__month") <= 6, F.lit(False))
    for half, m in (("h1", h1), ("h2", ~h1)):
        aggs += [_avg_of("rs_s", "rs_n", m, 1).alias(f"velo_{half}"),
                 _avg_of("ls_s", "ls_n", m, 1).alias(f"ev_{half}"),
                 _avg_of("xw_s", "xw_n", m, 3).alias(f"xwoba_{half}"),
                 _whiff_of("wh", "sw", m).alias(f"whiff_{half}")]
    out = df.groupBy("player_id", "season").agg(*aggs)
    col = F.col
    return out.withColumns({
        "platoon_xwoba_gap": col("vsR_xwoba") - col("vsL_xwoba"),
        "platoon_whiff_gap": col("vsR_whiff_rate") - col("vsL_whiff_rate"),
        "platoon_ev_gap": col("vsR_exit_velo") - col("vsL_exit_velo"),
        "velo_trend": col("velo_h2") - col("velo_h1"),
        "ev_trend": col("ev_h2") - col("ev_h1"),
        "xwoba_trend": col("xwoba_h2") - col("xwoba_h1"),
        "whiff_trend": col("whiff_h2") - col("whiff_h1"),
    })

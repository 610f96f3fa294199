"""Season aggregates of tracked pitches per batter and per pitcher (the
``batting_advanced`` / ``pitching_advanced`` inputs of the feature
matrices).

Every metric is decomposable -- a mean is a sum and a count, a rate is two
counts -- so the metrics are declared once as specs and computed from the
per-pitch values that the split features use (``splits``): one scan and one
join of pitches serve splits and advanced metrics together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seamstat.functions import codes as K
from seamstat.functions.exprs import is_barrel
from seamstat.operators.stats import G, P, GameCols, PitchCols

# A spec maps an output name to ("mean", mask, value) | ("ratio", num, den)
# | ("count", mask); masks and values are per-pitch expressions.


def _d(p: PitchCols):
    return F.col(p.description)


def batting_advanced_spec(p: PitchCols = P, zone: str = "zone",
                          xba: str = "estimated_ba_using_speedangle") -> dict:
    ls, la, d = F.col(p.launch_speed), F.col(p.launch_angle), _d(p)
    tracked = ls.isNotNull()
    swing, whiff = d.isin(list(K.SWING)), d.isin(list(K.WHIFF))
    inz, outz = F.col(zone) <= K.IN_ZONE_MAX, F.col(zone) > K.IN_ZONE_MAX
    t = F.lit(True)
    return {
        "avg_exit_velo": ("mean", tracked, ls),
        "avg_launch_angle": ("mean", tracked, la),
        "xba": ("mean", tracked, F.col(xba)),
        "xwoba": ("mean", tracked, F.col(p.xwoba)),
        "barrel_rate": ("mean", tracked, is_barrel(ls, la).cast("int")),
        "hard_hit_rate": ("mean", tracked, (ls >= K.HARD_HIT_SPEED).cast("int")),
        "swing_rate": ("ratio", swing, t),
        "whiff_rate": ("ratio", whiff, swing),
        "chase_rate": ("ratio", swing & outz, outz),
        "zone_swing_rate": ("ratio", swing & inz, inz),
        "zone_contact_rate": ("ratio", swing & inz & ~whiff, swing & inz),
        "batted_balls": ("count", F.col(p.bb_type).isNotNull()),
    }


def pitching_advanced_spec(p: PitchCols = P, zone: str = "zone", pitch_type: str = "pitch_type",
                           extension: str = "release_extension") -> dict:
    ls, la, d = F.col(p.launch_speed), F.col(p.launch_angle), _d(p)
    rs, pt, bbt = F.col(p.release_speed), F.col(pitch_type), F.col(p.bb_type)
    tracked = ls.isNotNull()
    swing, whiff = d.isin(list(K.SWING)), d.isin(list(K.WHIFF))
    outz = F.col(zone) > K.IN_ZONE_MAX
    t = F.lit(True)
    velo = lambda types: ("mean", pt.isin(list(types)), rs)
    return {
        "fb_velo": velo(K.FASTBALL_TYPES), "ff_velo": velo(K.FOUR_SEAM_TYPES),
        "brk_velo": velo(K.BREAKING_TYPES), "offspeed_velo": velo(K.OFFSPEED_TYPES),
        "extension": ("mean", t, F.col(extension)),
        "whiff_rate": ("ratio", whiff, swing),
        "chase_rate": ("ratio", swing & outz, outz),
        "zone_rate": ("ratio", F.col(zone) <= K.IN_ZONE_MAX, t),
        "csw_rate": ("ratio", whiff | d.isin(list(K.CALLED_STRIKE)), t),
        "avg_ev_against": ("mean", tracked, ls),
        "avg_la_against": ("mean", tracked, la),
        "xwoba_against": ("mean", tracked, F.col(p.xwoba)),
        "barrel_rate_against": ("mean", tracked, is_barrel(ls, la).cast("int")),
        "hard_hit_rate_against": ("mean", tracked, (ls >= K.HARD_HIT_SPEED).cast("int")),
        "gb_rate": ("ratio", bbt == K.GROUND_BALL, bbt.isNotNull()),
        "fb_rate": ("ratio", bbt == K.FLY_BALL, bbt.isNotNull()),
    }


def spec_values(spec: dict, prefix: str = "adv") -> dict[str, tuple[Column, Column | None]]:
    """Per-pitch values of a spec (mask, summed value or None for 1), whose
    sums are its sums and counts."""
    out: dict[str, tuple[Column, Column | None]] = {}
    for i, (name, s) in enumerate(spec.items()):
        key = f"__{prefix}{i}"
        if s[0] == "mean":
            out[key + "_s"] = s[1], s[2].cast("double")
            out[key + "_n"] = s[1] & s[2].isNotNull(), None
        elif s[0] == "ratio":
            out[key + "_s"] = s[1], None
            out[key + "_n"] = s[2], None
        else:
            out[key + "_s"] = s[1], None
    return out


def spec_finals(spec: dict, prefix: str = "adv") -> list[Column]:
    """Season values from the summed values."""
    out = []
    for i, (name, s) in enumerate(spec.items()):
        key = f"__{prefix}{i}"
        if s[0] == "count":
            out.append(F.sum(key + "_s").cast("bigint").alias(name))
        else:
            out.append((F.sum(key + "_s").cast("double") /
                        F.nullif(F.sum(key + "_n"), F.lit(0)).cast("double")).alias(name))
    return out


def _advanced(pitches, games, entity, spec, first, last, p, g):
    from seamstat.operators.splits import _season_pitches
    df = _season_pitches(pitches, games, entity, p, g, first, last, spec_values(spec))
    return df.groupBy("player_id", "season").agg(*spec_finals(spec))


def batting_advanced(pitches: DataFrame, games: DataFrame, first=None, last=None,
                     p: PitchCols = P, g: GameCols = G) -> DataFrame:
    return _advanced(pitches, games, p.batter, batting_advanced_spec(p), first, last, p, g)


def pitching_advanced(pitches: DataFrame, games: DataFrame, first=None, last=None,
                      p: PitchCols = P, g: GameCols = G) -> DataFrame:
    return _advanced(pitches, games, p.pitcher, pitching_advanced_spec(p), first, last, p, g)

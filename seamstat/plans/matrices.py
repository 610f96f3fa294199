"""Player-season feature matrices (DOM-28, DOM-29) and next-season
projections (DOM-30, MLO-*), composed from the engine's operators.

Inputs are DataFrames in a dict (any storage). The pitch table is read in two
passes: one for the statistics, whose team and total rows are written once and
feed the totals, the team string and every team context; one for splits and
advanced metrics together. The assembled rows are written once too, before the
season means, which join the rows to an aggregate of themselves, and so are the
pitchers' minor-league lines, which join twice (same and prior season). The written
tables are small (one row per player, season and team) and lie in the shared
checkpoint folder, so a lost executor does not recompute a pitch pass.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seamstat.functions import codes as K
from seamstat.operators import features as FT
from seamstat.operators import stats
from seamstat.operators.splits import hitter_split_features, pitcher_split_features

KEYS = ["player_id", "season"]


def _season_filter(df: DataFrame, first, last, col: str = "season") -> DataFrame:
    if first is not None:
        df = df.where(F.col(col) >= first)
    if last is not None:
        df = df.where(F.col(col) <= last)
    return df


def _to_double(df: DataFrame, cols) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in cols if c in df.columns})


def _team_context(t: Mapping[str, DataFrame], team_rows: DataFrame, weight: str) -> DataFrame:
    """Park factor and team strength of a player-season's teams, weighted by
    playing time, in one pass over the team rows."""
    parks = t["parks"].select("season", "team", F.col("basic").cast("double").alias("park_factor"))
    strength = t["team_strength"].select("season", "team", *K.TEAM_STRENGTH_COLUMNS)
    both = parks.join(strength, ["season", "team"], "full_outer")
    return FT.weighted_context(team_rows, both, ["park_factor", *K.TEAM_STRENGTH_COLUMNS], weight)


def hitter_features(t: Mapping[str, DataFrame], first: int | None = None,
                    last: int | None = None, min_pa: int = K.MIN_PA) -> DataFrame:
    """One row per qualified hitter-season with every hitter feature.

    ``t`` keys: pitches, games, constants, parks (season, team, basic),
    official_batting, player_bio, sprint_speed, lineup_position,
    team_strength, milb_batting, and optionally batting_advanced (else it
    is computed in the same pitch pass as the splits).
    """
    bat = stats.batting_stats(t["pitches"], t["games"], t["constants"], t["parks"], first, last)
    bat = _to_double(bat, ["avg", "obp", "slg", "ops", "woba", "wraa", "wrc_plus", "park_factor"])
    bat = materialize(bat, "batting_lines")
    trad = bat.where((F.col("split_type") == "total") & (F.col("pa") >= min_pa)) \
        .withColumnRenamed("batter", "player_id") \
        .drop("batter_team", "split_type", "park_factor", "wrc_plus")
    team_rows = bat.where(F.col("split_type") == "team").select(
        F.col("batter").alias("player_id"), "season", F.col("batter_team").alias("team"), "pa")
    ob = t["official_batting"]
    extras = _season_filter(ob.where(F.col("plate_appearances") >= min_pa), first, last).select(
        *KEYS, F.col("stolen_bases").alias("sb"), F.col("caught_stealing").alias("cs"),
        F.col("runs").alias("r"), "rbi", F.col("total_bases").alias("tb"))
    # Advanced metrics: a stored table, or computed in the split pass.
    adv = t.get("batting_advanced")
    splits = hitter_split_features(t["pitches"], t["games"], first, last, advanced=adv is None)
    df = trad.join(FT.team_string(team_rows), KEYS, "left").join(splits, KEYS, "left")
    if adv is not None:
        df = df.join(_season_filter(adv, first, last), KEYS, "left")
    df = df.join(extras, KEYS, "left")
    bio = t["player_bio"].select("player_id", "bat_side", "primary_position", "birth_date",
                                 "mlb_debut_date")
    df = FT.experience(df.join(bio, "player_id", "left"))
    df = materialize(FT.hitter_rates(df), "hitter_rows")
    df = FT.regress_to_mean(df, "pa", K.HITTER_RELIABILITY)
    df = FT.rolling_features(df, K.HITTER_ROLLING)
    df = FT.age_curve(df, "hitter")
    df = df.join(_team_context(t, team_rows, "pa"), KEYS, "left")
    df = FT.park_adjusted(df, {"iso_park_adj": "iso"})
    df = df.join(t["sprint_speed"].select(*KEYS, "sprint_speed", "hp_to_1b", "bolts",
                                          "competitive_runs"), KEYS, "left")
    df = df.join(t["lineup_position"].select(*KEYS, "avg_lineup_pos",
                                             F.col("games").alias("lineup_games")), KEYS, "left")
    df = FT.lineup_flags(df)
    milb = FT.milb_hitter_features(t["milb_batting"])
    return FT.with_milb(df, milb, K.HITTER_MILB_FILL)


def pitcher_features(t: Mapping[str, DataFrame], first: int | None = None,
                     last: int | None = None, min_ip: int = K.MIN_IP) -> DataFrame:
    """One row per qualified pitcher-season (IP notation >= min_ip, T1).

    ``t`` keys: pitches, games, constants, parks, official_pitching,
    quality_starts, player_bio, team_strength, milb_pitching, and
    optionally pitching_advanced (else computed with the splits).
    """
    pit = stats.pitching_stats(t["pitches"], t["games"], t["official_pitching"], t["constants"],
                               first, last)
    pit = _to_double(pit, ["ip", "era", "k_pct", "bb_pct", "k_bb", "ba_against", "babip", "whip",
                           "k_9", "bb_9", "hr_9", "hr_fb", "fip"])
    pit = materialize(pit, "pitching_lines")
    trad = pit.where((F.col("split_type") == "total") & (F.col("ip") >= min_ip)) \
        .withColumnRenamed("pitcher", "player_id").drop("pitcher_team")
    team_rows = pit.where(F.col("split_type") != "total").select(
        F.col("pitcher").alias("player_id"), "season", F.col("pitcher_team").alias("team"), "ip")
    off = _season_filter(t["official_pitching"], first, last).select(
        *KEYS, "holds", "blown_saves", "save_opps", "inherited_runners", "inherited_runners_scored",
        "wild_pitches", "complete_games", "shutouts")
    adv = t.get("pitching_advanced")
    splits = pitcher_split_features(t["pitches"], t["games"], first, last, advanced=adv is None)
    if adv is not None:
        splits = splits.join(_season_filter(adv, first, last), KEYS, "left")
    qs = _season_filter(t["quality_starts"], first, last).select(*KEYS, "quality_starts")
    bio = t["player_bio"].select("player_id", "bat_side", "primary_position", "birth_date",
                                 "mlb_debut_date")
    df = trad.join(off, KEYS, "left").join(FT.team_string(team_rows, weight="ip"), KEYS, "left") \
        .join(splits, KEYS, "left").join(qs, KEYS, "left").join(bio, "player_id", "left")
    df = materialize(FT.pitcher_rates(FT.experience(df)), "pitcher_rows")
    df = FT.regress_to_mean(df, "ip", K.PITCHER_RELIABILITY)
    df = FT.rolling_features(df, K.PITCHER_ROLLING)
    df = FT.age_curve(df, "pitcher")
    df = df.join(_team_context(t, team_rows, "ip"), KEYS, "left")
    df = FT.park_adjusted(df, {"era_park_adj": "era", "fip_park_adj": "fip"})
    milb = materialize(FT.milb_pitcher_features(t["milb_pitching"]), "milb_pitching_lines")
    return FT.with_milb(df, milb, K.PITCHER_MILB_FILL)


def materialize(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write a wide intermediate once to the shared checkpoint folder and
    read it back: later stages (model fits) start from a short lineage and
    a lost executor does not recompute the whole feature plan."""
    import uuid

    from seamstat.session import checkpoint_table_path
    spark = df.sparkSession
    path = path or checkpoint_table_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# ------------------------------------------------------------ projection --
def swap_context(latest: DataFrame, rosters: DataFrame, parks: DataFrame,
                 strength: DataFrame, context_season: int | None = None,
                 adjust: Mapping[str, str] | None = None) -> DataFrame:
    """Move latest-season rows to their roster team (inner join), replace
    park factor and team strength with that team's values of the context
    season, and redo park adjustments (DOM-30, JON-11, JON-12)."""
    adjust = dict(adjust or {"iso_park_adj": "iso"})
    if context_season is None:
        context_season = latest.select(F.max("season")).scalar()
    r = rosters.select("player_id", F.col("team").alias("proj_team"))
    pf = parks.where(F.col("season") == context_season).select(
        F.col("team").alias("proj_team"), F.col("basic").cast("double").alias("park_factor"))
    ts = strength.where(F.col("season") == context_season).select(
        F.col("team").alias("proj_team"), *K.TEAM_STRENGTH_COLUMNS)
    out = latest.drop("park_factor", *K.TEAM_STRENGTH_COLUMNS, *adjust.keys()) \
        .join(r, "player_id", "inner").join(pf, "proj_team", "left").join(ts, "proj_team", "left")
    return FT.park_adjusted(out, adjust)


def train_and_project(features: DataFrame, targets: list[str], digits: Mapping[str, int],
                      exclude: list[str], latest_rows: DataFrame | None = None,
                      grid: Mapping | None = None, tune_target: str | None = None,
                      select_params: Mapping | None = None,
                      latest_season: int | None = None, blend_on: str = "test",
                      params: Mapping | None = None, parallelism: int = 4,
                      ratios: Mapping[str, tuple[str, str]] | None = None,
                      names: DataFrame | None = None):
    """Year-over-year training, tuning, per-target ensembles and the
    projection of the latest season (MLO-01 .. MLO-14).

    ``blend_on="test"`` picks blend weights on the test season (as the
    published figures do, so their R^2 is optimistic); ``"validation"``
    holds out the last training season for the weights and fits on the
    seasons before it, leaving the test season untouched.

    ``ratios`` adds derived projections from the rounded ones, e.g.
    ``{"k_bb": ("k", "bb")}`` (a zero denominator reads as 1, 2 decimals).
    A projection row has the player, the season after the latest, the
    projected team if ``latest_rows`` went through ``swap_context``, and the
    full name from ``names`` (player_id, full_name).

    Returns (metrics DataFrame, projections DataFrame, fitted models).
    """
    from seamstat.operators.joins import year_pairs
    from seamstat.operators.modeling import (fit_targets, impute_zero, metrics_frame,
                                             numeric_features, project, season_split, tune)
    spark = features.sparkSession
    features = materialize(features, "features")
    pairs = season_split(year_pairs(features, targets, "player_id", "season"), features,
                         latest=latest_season)
    nexts = [f"next_{x}" for x in targets]
    cols = numeric_features(pairs, list(exclude) + nexts + ["split"])
    # Cut the lineage once: every fit and metric reads the written pairs.
    from seamstat.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    pairs = impute_zero(pairs, cols + nexts).checkpoint(eager=True)
    train = pairs.where(F.col("split") == "train")
    test = pairs.where(F.col("split") == "test")
    blend = test
    if blend_on == "validation":
        last_train = train.select(F.max("season")).scalar()
        blend = train.where(F.col("season") == last_train)
        train = train.where(F.col("season") < last_train)
    elif blend_on != "test":
        raise ValueError("blend_on is 'test' or 'validation'")
    # grid={} skips tuning and uses ``params`` (or the boosted-tree defaults)
    best = tune(train, cols, f"next_{tune_target or targets[0]}",
                dict(grid or K.PARAM_GRID)) if grid != {} else dict(params or {})
    fitted = fit_targets(train, blend, cols, [f"next_{x}" for x in targets], best, parallelism,
                         threshold=K.IMPORTANCE_THRESHOLD,
                         select_params=dict(select_params) if select_params else None,
                         evaluate=test)
    if latest_rows is None:
        top = latest_season if latest_season is not None else features.select(F.max("season")).scalar()
        latest_rows = features.where(F.col("season") == top)
    team = [x for x in ("proj_team",) if x in latest_rows.columns]
    proj = project(impute_zero(latest_rows, cols), fitted, ["player_id", "season", *team], dict(digits))
    proj = proj.withColumn("season", (F.col("season") + 1).cast("int")).withColumnsRenamed({x: "team" for x in team})
    if names is not None:
        proj = proj.join(names.select("player_id", "full_name"), "player_id", "left")
    from seamstat.operators.modeling import derive_ratio
    for name, (num, den) in (ratios or {}).items():
        proj = derive_ratio(proj, f"{num}_proj", f"{den}_proj", f"{name}_proj")
    return metrics_frame(spark, fitted), proj, fitted

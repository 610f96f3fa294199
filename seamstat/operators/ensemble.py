"""Projection ensembles from two passes over the training pairs (MLO-03 ..
MLO-14): one for cross moments (ridge of every target), one for joint counts
by fold (boosted depth-one trees of every target, their importances, and a
cross-validated grid). Everything between the passes and the scoring runs on
matrices whose size follows the number of features, so the full grid with all
rounds costs no further job. Scores are built-in expressions.

``modeling`` has the same flow with Spark ML's deeper trees.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seamstat.functions import codes as K
from seamstat.functions.exprs import np_round
from seamstat.operators import gram as G
from seamstat.operators import stumps as ST
from seamstat.operators.modeling import derive_ratio, impute_zero

BINS = 16               # thresholds a feature
FOLDS = 3
SELECT = {"n_estimators": 200, "learning_rate": 0.05, "min_child_weight": 1}


@dataclass
class Member:
    """The ensemble of one target."""

    target: str
    features: list[str]
    ridge: G.Ridge
    trees: ST.Stumps
    weight: float = 0.0
    r2: float | None = None
    mae: float | None = None


def best_setting(rows: Sequence[Mapping]) -> dict:
    """Setting with the highest mean R^2, the first one on ties; the first
    setting where no fold has a spread."""
    k = max(range(len(rows)), key=lambda i: (rows[i]["r2"] if rows[i]["r2"] is not None else float("-inf"), -i))
    return {c: rows[k][c] for c in ("n_estimators", "learning_rate", "min_child_weight")}


def fit(train: DataFrame, cols: Sequence[str], targets: Sequence[str], tune_target: str | None = None,
        grid: Mapping[str, Sequence] | None = None, keys: Sequence[str] = ("player_id", "season"),
        threshold: float = K.IMPORTANCE_THRESHOLD, alpha: float = 1.0, bins: int = BINS):
    """(members, grid rows, chosen setting). ``train`` has ``cols`` and
    ``targets`` without nulls. Blend weights are still to be found."""
    cols, targets = list(cols), list(targets)
    grid = dict(grid or {k: v for k, v in K.PARAM_GRID.items() if k != "max_depth"})
    cuts = ST.make_bins(train, cols, bins)
    folds = ST.joint_counts(train, cuts, targets, F.pmod(F.xxhash64(*keys), F.lit(FOLDS)))
    moments = G.cross_moments(train, [*cols, *targets])
    whole = None
    for c in folds.values():
        whole = c if whole is None else whole + c
    if whole is None:
        raise ValueError("no training pairs")
    rows = ST.grid_search(folds, cuts, grid["n_estimators"], grid["learning_rate"], grid["min_child_weight"],
                          target=targets.index(tune_target or targets[0]))
    best = best_setting(rows) if rows else {k: v[0] for k, v in grid.items()}
    members = []
    for i, t in enumerate(targets):
        first = ST.boost(whole, cuts, SELECT["n_estimators"], SELECT["learning_rate"], SELECT["min_child_weight"], target=i)
        kept = [k for k, v in enumerate(first.importances()) if v >= threshold] or list(range(len(cols)))
        own = ST.Bins([cols[k] for k in kept], [cuts.bounds[k] for k in kept])
        trees = ST.boost(whole.of(kept), own, best["n_estimators"], best["learning_rate"], best["min_child_weight"], target=i)
        members.append(Member(t, own.features, G.ridge(moments, own.features, t, alpha), trees))
    return members, rows, best


def scored(df: DataFrame, members: Sequence[Member], keep: Sequence[str | Column]) -> DataFrame:
    """``keep`` and, by member, ``ridge_<i>`` and ``trees_<i>``. Bin numbers of
    the features are computed once for all members."""
    bounds = {f: b for m in members for f, b in zip(m.trees.bins.features, m.trees.bins.bounds, strict=True)}
    every = ST.Bins(list(bounds), list(bounds.values()))
    names = {f: f"__bin_{i}" for i, f in enumerate(every.features)}
    coded = df.select("*", *[c.alias(names[f]) for f, c in zip(every.features, every.codes(), strict=True)])
    codes = {f: F.col(n) for f, n in names.items()}
    return coded.select(*keep, *[c for i, m in enumerate(members) for c in (
        m.ridge.predict().alias(f"ridge_{i}"), m.trees.predict(codes).alias(f"trees_{i}"))])


def blend(members: Sequence[Member], weigh: DataFrame, judge: DataFrame, steps: int = 20) -> None:
    """Best blend weight of every member on ``weigh``, then its R^2 and mean
    absolute error on ``judge``: a job each for all members."""
    from seamstat.operators.modeling import best_blend, regression_scores

    def rows(df):
        own = scored(df, members, [F.col(f"`{m.target}`").alias(f"y_{i}") for i, m in enumerate(members)])
        return own.select(F.explode(F.array(*[
            F.struct(F.lit(i).alias("member"), F.col(f"y_{i}").cast("double").alias("y"), F.col(f"ridge_{i}").alias("a"),
                     F.col(f"trees_{i}").alias("b")) for i in range(len(members))])).alias("r")).select("r.*")

    for r in best_blend(rows(weigh), "y", "a", "b", steps, by=["member"]).collect():
        members[r["member"]].weight = float(r["best_weight"])
    weights = F.array(*[F.lit(m.weight) for m in members])
    final = rows(judge).withColumn("w", F.element_at(weights, F.col("member") + 1)).withColumn(
        "p", (1 - F.col("w")) * F.col("a") + F.col("w") * F.col("b"))
    for r in regression_scores(final, "y", "p", ["member"]).collect():
        members[r["member"]].r2, members[r["member"]].mae = r["r2"], r["mae"]


def project(latest: DataFrame, members: Sequence[Member], id_cols: Sequence[str], digits: Mapping[str, int],
            prefix: str = "next_") -> DataFrame:
    """``id_cols`` and a rounded ``<target>_proj`` a member."""
    out = scored(latest, members, list(id_cols))
    cols = []
    for i, m in enumerate(members):
        name = m.target.removeprefix(prefix)
        p = (1 - m.weight) * F.col(f"ridge_{i}") + m.weight * F.col(f"trees_{i}")
        cols.append(np_round(p, digits.get(name, 0)).alias(f"{name}_proj"))
    return out.select(*id_cols, *cols)


def metrics_frame(spark, members: Sequence[Member]) -> DataFrame:
    return spark.createDataFrame(
        [(m.target, m.weight, m.r2, m.mae, len(m.features), len(m.trees.trees)) for m in members],
        "target string, blend_weight double, r2 double, mae double, n_features int, n_trees int")


def train_and_project(features: DataFrame, targets: Sequence[str], digits: Mapping[str, int], exclude: Sequence[str],
                      latest_rows: DataFrame | None = None, tune_target: str | None = None,
                      grid: Mapping[str, Sequence] | None = None, latest_season: int | None = None,
                      ratios: Mapping[str, tuple[str, str]] | None = None, names: DataFrame | None = None):
    """(metrics, projections, members, grid rows) of the whole flow: pairs,
    split, imputation, selection, tuning, fits, blend on the test season,
    scores, and the rounded projection of the latest rows with the team they
    were moved to (``proj_team``), derived ratios and names."""
    from seamstat.operators.joins import year_pairs
    from seamstat.operators.modeling import numeric_features, season_split
    from seamstat.plans.matrices import materialize
    features = materialize(features, "features")
    pairs = season_split(year_pairs(features, list(targets), "player_id", "season"), features, latest=latest_season)
    nexts = [f"next_{t}" for t in targets]
    cols = numeric_features(pairs, [*exclude, *nexts, "split"])
    pairs = materialize(impute_zero(pairs, [*cols, *nexts]).select("player_id", "season", "split", *cols, *nexts), "pairs")
    train, test = (pairs.where(F.col("split") == s) for s in ("train", "test"))
    members, rows, _ = fit(train, cols, nexts, f"next_{tune_target or targets[0]}", grid)
    blend(members, test, test)
    if latest_rows is None:
        top = latest_season if latest_season is not None else features.select(F.max("season")).scalar()
        latest_rows = features.where(F.col("season") == top)
    team = [c for c in ("proj_team",) if c in latest_rows.columns]
    out = project(impute_zero(latest_rows, cols), members, ["player_id", "season", *team], digits)
    out = out.withColumn("season", (F.col("season") + 1).cast("int")).withColumnsRenamed({c: "team" for c in team})
    if names is not None:
        out = out.join(names.select("player_id", "full_name"), "player_id", "left")
    for name, (num, den) in (ratios or {}).items():
        out = derive_ratio(out, f"{num}_proj", f"{den}_proj", f"{name}_proj")
    return metrics_frame(features.sparkSession, members), out, members, rows

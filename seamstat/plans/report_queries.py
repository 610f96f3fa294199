"""Driver queries of projection reports and scores: the deterministic part of
the projection flow, through the engine's own functions. A player-season's
"prediction" here is its rolling mean, so every row has an exact oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seamstat.plans import testdata as T
from seamstat.plans.queries import (_BAT_WITH, _CUST_SEASON, _STRENGTH_SQL, _bat_totals, _cust_season, _duck_roll,
                                    register)

# Predictions of a season: the two-season weighted mean up to the season before.
_PRED = T.duck_with(_CUST_SEASON) + f""",
roll AS (SELECT *, {_duck_roll('lines')}, {_duck_roll('qty')} FROM cs),
pred AS (SELECT n.player_id, n.season, r.lines_2yr AS p_lines, r.qty_2yr AS p_qty, n.lines, n.qty
         FROM cs n JOIN roll r ON r.player_id = n.player_id AND r.season + 1 = n.season)"""


def _predictions(spark, sf_dir) -> DataFrame:
    from seamstat.operators.windows import rolling_wavg
    cs = _cust_season(spark, sf_dir)
    before = rolling_wavg(cs, ["lines", "qty"], "player_id", "season", (2,)).select(
        "player_id", (F.col("season") + 1).alias("season"), F.col("lines_2yr").alias("p_lines"),
        F.col("qty_2yr").alias("p_qty"))
    return cs.select("player_id", "season", "lines", "qty").join(before, ["player_id", "season"])


@register("q_regression_scores", _PRED + """
SELECT season, round(avg(abs(qty - p_qty)), 6) AS mae,
       round(1 - sum((qty - p_qty) * (qty - p_qty)) / nullif(var_pop(qty) * count(qty), 0), 6) AS r2
FROM pred GROUP BY season""")
def q_regression_scores(spark, sf_dir):
    """MAE and R^2 a season (MLO-10)."""
    from seamstat.operators.modeling import regression_scores
    out = regression_scores(_predictions(spark, sf_dir), "qty", "p_qty", ["season"])
    return out.select("season", F.round("mae", 6).alias("mae"), F.round("r2", 6).alias("r2"))


@register("q_ratio_scores", _PRED + """,
r AS (SELECT qty / CASE WHEN lines = 0 THEN 1 ELSE lines END AS y, p_qty / CASE WHEN p_lines = 0 THEN 1 ELSE p_lines END AS p
      FROM pred)
SELECT round(avg(abs(y - p)), 6) AS mae, round(1 - sum((y - p) * (y - p)) / nullif(var_pop(y) * count(y), 0), 6) AS r2
FROM r""")
def q_ratio_scores(spark, sf_dir):
    """Scores of a ratio of two predictions (MLO-11)."""
    from seamstat.operators.modeling import ratio_scores
    out = ratio_scores(_predictions(spark, sf_dir), "p_qty", "p_lines", "qty", "lines")
    return out.select(F.round("mae", 6).alias("mae"), F.round("r2", 6).alias("r2"))


@register("q_pred_vs_actual", _PRED + """
SELECT p.player_id, p.season, round(p_qty, 6) AS pred_qty, round(p_lines, 6) AS pred_lines, qty AS actual_qty,
       lines AS actual_lines, c.c_name AS player_name
FROM pred p LEFT JOIN customer c ON c.c_custkey = p.player_id
ORDER BY p_qty DESC, p.player_id, p.season LIMIT 25""")
def q_pred_vs_actual(spark, sf_dir):
    """Prediction-against-actual report, top 25 by prediction (MLO-12)."""
    from seamstat.operators.modeling import compare
    p = _predictions(spark, sf_dir)
    names = T.read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("player_id"), F.col("c_name").alias("player_name"))
    preds = p.select("player_id", "season", F.col("p_qty").alias("qty"), F.col("p_lines").alias("lines"))
    out = compare(preds, p.select("player_id", "season", "qty", "lines"), names, ["player_id", "season"],
                  ["qty", "lines"], "qty", 25)
    return out.withColumns({c: F.round(c, 6) for c in ("pred_qty", "pred_lines")})


@register("q_rounded_ratio", _PRED + """
SELECT player_id, season, round_even(p_qty, 0) AS qty_proj, round_even(p_lines, 0) AS lines_proj,
       round_even(round_even(p_qty, 0) / CASE WHEN round_even(p_lines, 0) = 0 THEN 1 ELSE round_even(p_lines, 0) END, 2) AS ratio_proj
FROM pred""")
def q_rounded_ratio(spark, sf_dir):
    """Projections rounded half to even, and a ratio of the rounded values
    with a zero denominator read as 1 (MLO-13, MLO-14)."""
    from seamstat.functions.exprs import np_round
    from seamstat.operators.modeling import derive_ratio
    p = _predictions(spark, sf_dir).select("player_id", "season", np_round("p_qty", 0).alias("qty_proj"),
                                           np_round("p_lines", 0).alias("lines_proj"))
    return derive_ratio(p, "qty_proj", "lines_proj", "ratio_proj")


@register("q_context_swap", _BAT_WITH + ", " + _STRENGTH_SQL + """,
latest AS (SELECT max(season) AS l FROM bat_lines),
roster AS (SELECT s_suppkey AS player_id, 'H' || CAST(s_nationkey % 5 + 1 AS VARCHAR) AS team FROM supplier)
SELECT c.batter AS player_id, r.team AS proj_team, c.season, CAST(pf.basic AS DOUBLE) AS park_factor,
       ts.team_runs, round(ts.team_ops, 9) AS team_ops, ts.team_hr, c.slg,
       round(c.slg * (100.0 / CASE WHEN CAST(pf.basic AS DOUBLE) = 0 THEN 100 ELSE CAST(pf.basic AS DOUBLE) END), 9) AS slg_park_adj
FROM bat_lines c JOIN roster r ON r.player_id = c.batter
LEFT JOIN parks_v pf ON pf.team = r.team AND pf.season = c.season
LEFT JOIN ts ON ts.team = r.team AND ts.season = c.season
WHERE c.split_type = 'total' AND c.season = (SELECT l FROM latest)""")
def q_context_swap(spark, sf_dir):
    """Latest-season rows moved to their projected team: roster join, then
    that team's park factor and strength of the latest season, park
    adjustment redone (DOM-30, JON-11, JON-12)."""
    from seamstat.operators.joins import latest_snapshot
    from seamstat.plans.matrices import swap_context
    tot = _bat_totals(spark, sf_dir, None).select("player_id", "season", "slg")
    out = swap_context(latest_snapshot(tot, "season"), T.rosters(spark, sf_dir), T.park_factors(spark, sf_dir),
                       T.team_strength(spark, sf_dir), adjust={"slg_park_adj": "slg"})
    return out.select("player_id", "proj_team", "season", "park_factor", "team_runs",
                      F.round("team_ops", 9).alias("team_ops"), "team_hr", "slg",
                      F.round("slg_park_adj", 9).alias("slg_park_adj"))

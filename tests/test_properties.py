"""Property tests (hypothesis) on the engine's invariants."""
import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from seamstat.operators import stats
from seamstat.operators.aggs import weighted_avg

SET = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@SET
@given(derived=st.lists(st.integers(0, 60), min_size=1, max_size=4),
       diff=st.integers(0, 20))
def test_apportioned_outs_sum_to_official(spark, derived, diff):
    official = sum(derived) + diff
    rows = [(1, 2022, f"T{i}", "team", d, official) for i, d in enumerate(derived)]
    df = spark.createDataFrame(rows, "pitcher bigint, season int, pitcher_team string, split_type string, "
                                     "derived_outs bigint, official_outs bigint")
    assert stats.apportion_outs(df).agg(F.sum("outs")).first()[0] == official


@SET
@given(vals=st.lists(st.tuples(st.one_of(st.none(), st.floats(50, 150)), st.integers(1, 700)),
                     min_size=1, max_size=6))
def test_weighted_avg_matches_numpy_and_is_bounded(spark, vals):
    df = spark.createDataFrame([(1, x, w) for x, w in vals], "k int, x double, w bigint")
    got = df.groupBy("k").agg(weighted_avg("x", "w").alias("v")).first()["v"]
    known = [(x, w) for x, w in vals if x is not None]
    if not known:
        assert got is None
        return
    exp = np.average([x for x, _ in known], weights=[w for _, w in known])
    assert abs(got - exp) < 1e-9
    assert min(x for x, _ in known) - 1e-9 <= got <= max(x for x, _ in known) + 1e-9


@SET
@given(events=st.lists(st.tuples(st.sampled_from(["single", "walk", "strikeout", "home_run", "field_out"]),
                                 st.sampled_from(["AAA", "BBB", "CCC"])), min_size=1, max_size=12))
def test_team_rows_sum_to_total(spark, events):
    import datetime as dt
    pitches = spark.createDataFrame([(i, 7, 9, e, "Top", None) for i, (e, _) in enumerate(events)],
                                    "game_pk bigint, batter bigint, pitcher bigint, events string, "
                                    "inning_topbot string, bb_type string")
    games = spark.createDataFrame([(i, dt.date(2022, 5, 1), "R", "H", t) for i, (_, t) in enumerate(events)],
                                  "game_pk bigint, game_date date, game_type string, home_team string, away_team string")
    rows = stats.batting_counts(pitches, games).collect()
    tot = [r for r in rows if r["split_type"] == "total"][0]
    teams = [r for r in rows if r["split_type"] == "team"]
    for c in ("pa", "ab", "h", "hr", "bb", "k"):
        assert sum(r[c] for r in teams) == tot[c]
    assert tot["pa"] == len(events)


@SET
@given(xs=st.lists(st.floats(-1000, 1000, allow_nan=False), min_size=1, max_size=6),
       n=st.integers(0, 3))
def test_np_round_matches_numpy(spark, xs, n):
    from seamstat.functions.exprs import np_round
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r["r"] for r in df.select(np_round("x", n).alias("r")).collect()]
    assert got == [float(np.round(x, n)) for x in xs]

"""The split and metric pass moves few columns of a pitch, whatever the number
of metrics, and lines that join twice are computed once."""
import re

import pytest

from seamstat.operators.splits import hitter_split_features, pitcher_split_features

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark):
    from seamstat.plans import testdata as T
    return T.pitches(spark, SF), T.games(spark, SF)


@pytest.mark.parametrize("features", [hitter_split_features, pitcher_split_features])
def test_pitches_are_not_summed_per_game(tables, features):
    plan = _plan(features(*tables, advanced=True))
    assert "HashAggregate(keys=[__g" not in plan
    moved = re.findall(r"Exchange hashpartitioning\(__place#.*\n.*Project \[([^\]]*)\]", plan)
    assert moved and all(x.count(",") <= 12 for x in moved)


def test_minor_league_lines_are_read_once(spark):
    from seamstat.plans import testdata as T
    from seamstat.plans.matrices import pitcher_features
    plan = _plan(pitcher_features(T.matrix_inputs(spark, SF)))
    assert plan.count("milb_pitching_lines") >= 2

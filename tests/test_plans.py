"""Plan properties the scale design relies on (checked on the physical plan)."""
import re

import pytest

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def Q():
    from seamstat.plans.queries import QUERIES
    return QUERIES


def test_no_cartesian_or_nested_loop_joins(spark, Q):
    fitted = ("q_ridge", "q_gbt", "q_project", "q_stream_reload", "q_landed_csv")
    for name, fn in Q.items():
        if name.startswith(fitted):
            continue
        plan = _plan(fn(spark, SF))
        assert "CartesianProduct" not in plan, name
        assert "BroadcastNestedLoopJoin" not in plan, name


def test_counting_rollup_one_pass_and_pruned_scan(spark, Q):
    plan = _plan(Q["q_counting_rollup"](spark, SF))
    assert plan.count("Expand") == 1                      # one grouping-sets pass
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    lineitem = [s for s in scans if "l_orderkey" in s][0]
    assert "l_extendedprice" not in lineitem and "l_comment" not in lineitem


def test_pre_aggregation_below_the_join(spark):
    from seamstat.operators import stats
    from seamstat.plans import testdata as T
    df = stats.batting_counts(T.pitches(spark, SF), T.games(spark, SF))
    plan = _plan(df)
    # counters are combined per (game, batter, half-inning) before the join
    assert re.search(r"HashAggregate\(keys=\[__g#\d+L?, batter#\d+L?, __half#\d+\], "
                     r"functions=\[partial_count", plan)


def test_rolling_uses_one_window(spark, Q):
    plan = _plan(Q["q_rolling_wavg"](spark, SF))
    assert plan.count("Window [") == 1


def test_league_means_are_not_a_season_window(spark, Q):
    plan = _plan(Q["q_regress_to_mean"](spark, SF))
    assert "Window" not in plan


def test_best_level_is_an_aggregate_not_a_window(spark, Q):
    plan = _plan(Q["q_best_level"](spark, SF))
    assert "Window" not in plan and "min_by" in plan


def test_blend_search_does_not_copy_data_per_weight(spark, Q):
    plan = _plan(Q["q_blend_search"](spark, SF))
    # the 21 weights are generated from the one-row-per-target sums
    assert "CartesianProduct" not in plan
    assert re.search(r"Generate explode\([^\n]*\), \[target#\d+, see#", plan)

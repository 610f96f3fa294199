"""Headers in one pass, counts from footers, bucketed joins, observed checks,
and the language's rounding rule."""
import math
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seamstat.functions.exprs import py_round
from seamstat.sources import readers as R

SF = "/root/testdata/sf0.001"
SCHEMA = T.StructType([T.StructField("game_pk", T.LongType()), T.StructField("zone", T.IntegerType()),
                       T.StructField("events", T.StringType())])


def jobs_of(spark, fn):
    group = f"g{random.random()}"
    spark.sparkContext.setJobGroup(group, "")
    fn()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def land(folder, n):
    for i in range(n):
        header = ["game_pk,zone,events", "events,game_pk,zone", '"game_pk","events","more, or less"'][i % 3]
        line = [f"{i},3.0,out", f"out,{i},", f'{i},"a, b",x'][i % 3]
        (folder / f"f{i:03}.csv").write_text(("﻿" if i % 5 == 0 and i % 3 != 2 else "") + header + "\n" + line + "\n")


def test_files_of_many_headers_are_one_table(spark, tmp_path):
    land(tmp_path, 30)
    (tmp_path / "only_header.csv").write_text("game_pk,zone,events\n")
    rows = R.read_csv_by_name(spark, [str(tmp_path)], SCHEMA).collect()
    want = [(i, [3, None, None][i % 3], ["out", "out", "a, b"][i % 3]) for i in range(30)]
    assert sorted(map(tuple, rows)) == sorted(want)


def test_header_jobs_do_not_follow_the_files(spark, tmp_path):
    counts = []
    for n in (3, 60):
        folder = tmp_path / str(n)
        folder.mkdir()
        land(folder, n)
        paths = [str(folder / f) for f in sorted(os.listdir(folder))]
        counts.append(jobs_of(spark, lambda: R.read_csv_by_name(spark, paths, SCHEMA)))
    assert counts[1] <= counts[0] + 1 <= 8


def test_no_files(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    assert R.read_csv_by_name(spark, [str(tmp_path)], SCHEMA).collect() == []


@pytest.mark.parametrize("n", [0, 1, 2, 3, 5])
def test_python_rounding(spark, n):
    r = random.Random(n)
    xs = [0.0, -0.0, 2.675, 0.125, 0.285, 1.005, 2.5, 3.5, -2.5, 1e-320, 5e-324, 1e300, -1e300, 4503599627370496.5,
          9007199254740993.0, 0.5, 1.5, 0.15, 0.25, 0.35, 1e15 + 0.3, 123456789.125, 2.0 ** 52 / 10 ** n, (2.0 ** 53 - 1) / 10 ** n]
    xs += [k / 8 for k in range(-200, 200)] + [k / 1000 + 0.0005 for k in range(400)] + [k / 200 for k in range(2000)]
    xs += [r.uniform(-1, 1) * 10 ** r.randint(-6, 17) for _ in range(20_000)]
    xs += [math.nextafter((2 * k + 1) / 2 / 10 ** n, math.inf if r.random() < 0.5 else -math.inf) for k in range(4000)]
    xs += [r.randint(-10 ** 15, 10 ** 15) / 2 ** r.randint(0, 40) for _ in range(10_000)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x double").repartition(4)
    got = {q["i"]: q["y"] for q in df.select("i", py_round("x", n).alias("y")).collect()}
    bad = [(x, got[i], round(x, n)) for i, x in enumerate(xs) if got[i] != round(x, n)]
    assert not bad, bad[:5]
    odd = spark.createDataFrame([(float("nan"),), (float("inf"),), (float("-inf"),), (None,)], "x double")
    a, b, c, d = [q[0] for q in odd.select(py_round("x", n)).collect()]
    assert math.isnan(a) and (b, c, d) == (float("inf"), float("-inf"), None)


def test_counts_come_from_footers(spark):
    from seamstat.sources.footers import footer_bounds, footer_counts, footer_session
    if not os.path.isdir(SF):
        pytest.skip("driver test data not present")
    df = footer_counts(spark, orders=f"{SF}/orders.parquet", nation=f"{SF}/nation.parquet")
    plan = df._jdf.queryExecution().optimizedPlan().toString() + df._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)]" in plan.replace("PushedAggregation: [COUNT(*)", "PushedAggregation: [COUNT(*)")
    want = {t: spark.read.parquet(f"{SF}/{t}.parquet").count() for t in ("orders", "nation")}
    assert {r["table_name"]: r["n_rows"] for r in df.collect()} == want
    b = footer_bounds(footer_session(spark), f"{SF}/orders.parquet", ["o_orderkey"]).first()
    w = spark.read.parquet(f"{SF}/orders.parquet").agg(F.count(F.lit(1)), F.min("o_orderkey"), F.max("o_orderkey")).first()
    assert tuple(b) == tuple(w)
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")


def test_bucketed_tables_join_without_an_exchange(spark, tmp_path):
    from seamstat.plans.landed_queries import games_joined
    from seamstat.sources.bucketed import drop_bucketed, write_bucketed
    p = spark.range(500).select((F.col("id") % 40).alias("game_pk"), F.when(F.col("id") % 3 == 0, "x").alias("events"))
    g = spark.range(40).select(F.col("id").alias("game_pk"), F.lit("H").alias("home_team"), F.lit("2001-05-05").cast("date").alias("game_date"))
    a = write_bucketed(p, "bucketed_p", str(tmp_path / "p"), ["game_pk"], 4)
    b = write_bucketed(g, "bucketed_g", str(tmp_path / "g"), ["game_pk"], 4)
    df = games_joined(a, b)
    plan = df._jdf.queryExecution().executedPlan().toString()
    join = plan[plan.index("SortMergeJoin"):]
    assert "Exchange" not in join and plan.count("Exchange") == 1     # the last one, by team and season
    assert [tuple(r) for r in df.collect()] == [("H", 2001, 500, 167, 40)]
    assert [tuple(r) for r in games_joined(p, g).collect()] == [("H", 2001, 500, 167, 40)]
    drop_bucketed(spark, "bucketed_p")
    drop_bucketed(spark, "bucketed_g")


def test_checks_run_with_the_chain(spark, tmp_path):
    from seamstat.operators.quality import check_row_count, match_rate, observed_chain
    base = spark.range(10).withColumnRenamed("id", "k")
    side = spark.createDataFrame([(1, "a"), (2, None), (3, "c"), (3, "d")], "k long, v string")
    runs = []

    def write(df):
        runs.append(1)
        df.write.parquet(str(tmp_path / "out"))

    check, rates = observed_chain(base, lambda df: df.join(side, "k", "left"), write, ["v"])
    joined = base.join(side, "k", "left")
    assert check.collect() == check_row_count(base, joined).collect() and len(runs) == 1
    assert [tuple(r) for r in rates.collect()] == [tuple(r) for r in match_rate(joined, ["v"]).collect()]

"""Keyed stores: a delta reads and rewrites only the buckets of its keys."""
import os

import pytest
from pyspark.sql import functions as F

from seamstat.operators import store as S
from seamstat.operators import tables as TB

KEYS = ["player_id"]


def rows_of(df):
    return sorted(map(tuple, df.select("player_id", "a", "b").collect()), key=repr)


@pytest.fixture
def store(spark, tmp_path):
    rows = [(i, f"a{i}", i * 10 if i % 3 else None) for i in range(200)]
    return S.KeyedStore(spark, str(tmp_path / "t"), KEYS, 16).create(spark.createDataFrame(rows, "player_id long, a string, b long"))


def files(path):
    return {os.path.relpath(os.path.join(d, f), path): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def bucket_of(spark, key, n=16):
    return S.with_bucket(spark.createDataFrame([(key,)], "player_id long"), KEYS, n).first()["bucket"]


def scanned(df):
    """(partitions, files) that the scan of a plan has read."""
    plan = df._jdf.queryExecution().executedPlan()
    df.collect()
    leaf = plan.collectLeaves().apply(0)
    return tuple(int(leaf.metrics().apply(m).value()) for m in ("numPartitions", "numFiles"))


@pytest.mark.parametrize("rule", ["upsert", "upsert_partial", "upsert_coalesce", "insert_absent", "replace_keys"])
def test_changes_equal_the_table_operators(spark, store, rule):
    incoming = spark.createDataFrame([(3, "new3", None), (9, None, 7), (500, "x", 1), (501, None, None)],
                                     "player_id long, a string, b long")
    before = spark.createDataFrame(store.read().collect(), store.read().schema)
    want = {"upsert": lambda: TB.upsert(before, incoming, KEYS),
            "upsert_partial": lambda: TB.upsert(before, incoming, KEYS, ["b"]),
            "upsert_coalesce": lambda: TB.upsert_coalesce(before, incoming, KEYS, ["a", "b"]),
            "insert_absent": lambda: TB.insert_absent(before, incoming, KEYS),
            "replace_keys": lambda: TB.replace_keys(before, incoming, KEYS)}[rule]()
    got = {"upsert": lambda: store.upsert(incoming), "upsert_partial": lambda: store.upsert(incoming, ["b"]),
           "upsert_coalesce": lambda: store.upsert_coalesce(incoming, ["a", "b"]),
           "insert_absent": lambda: store.insert_absent(incoming), "replace_keys": lambda: store.replace_keys(incoming)}[rule]()
    assert rows_of(got.read()) == rows_of(want)


def test_only_touched_buckets_are_written(spark, store):
    incoming = spark.createDataFrame([(3, "n", 1), (1003, "m", 2)], "player_id long, a string, b long")
    before = files(store.path)
    store.upsert(incoming)
    after = files(store.path)
    mine = {f"bucket={bucket_of(spark, k)}" for k in (3, 1003)}

    def others(names):
        return {p: t for p, t in names.items() if p.split(os.sep)[0] not in mine}

    assert others(after) == others(before) and len(others(after)) >= 10
    assert not set(before) - set(others(before)) & set(after)
    here = spark.read.parquet(*[os.path.join(store.path, m) for m in mine])
    assert {r["a"] for r in here.where("player_id in (3, 1003)").collect()} == {"n", "m"}


def test_only_touched_buckets_are_read(spark, store):
    """What a change reads of the stored table: its plan has literals for the
    partitions, and its scan opens their files alone."""
    incoming = spark.createDataFrame([(3, "n", 1)], "player_id long, a string, b long")
    seen, stored_files = [], len(files(store.path))

    def rule(target, delta):
        seen.append((target._jdf.queryExecution().executedPlan().toString(), scanned(target)))
        return TB.upsert(target, delta, KEYS)

    store.change(incoming, rule)
    plan, (partitions, n) = seen[0]
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "bucket#" in filters and str(bucket_of(spark, 3)) in filters
    assert partitions == 1 and n < stored_files / 8


def test_predicate_of_two_partition_columns(spark):
    df = spark.createDataFrame([(2020, 1, "a"), (2020, 2, "b"), (2021, 1, "c"), (None, 3, "d"), (2022, 3, "e"), (2023, 3, "f")],
                               "season int, bucket int, v string")
    for pick in (["a"], ["a", "c"], ["d"], ["b", "d", "e", "f"], ["e", "f"], []):
        got = df.where(S.touched(df.where(F.col("v").isin(pick)), ["season", "bucket"])).collect()
        assert sorted(r["v"] for r in got) == pick


def test_a_run_applied_again_publishes_what_it_staged(spark, store):
    incoming = spark.createDataFrame([(3, "n", 1)], "player_id long, a string, b long")
    store.upsert(incoming, run="r1")
    want = rows_of(store.read())
    # The table is lost half way through the publishing.
    bucket = bucket_of(spark, 3)
    spark.createDataFrame([], "player_id long, a string, b long").write.mode("overwrite").parquet(f"{store.path}/bucket={bucket}")
    store.upsert(incoming, run="r1")
    assert rows_of(store.read()) == want


def test_empty_deltas_and_stores(spark, store, tmp_path):
    want = rows_of(store.read())
    store.upsert(spark.createDataFrame([], "player_id long, a string, b long"))
    assert rows_of(store.read()) == want
    null = spark.createDataFrame([(None, "z", 1)], "player_id long, a string, b long")
    store.insert_absent(null)
    assert len(rows_of(store.read())) == len(want) + 1


def test_reload_reads_only_touched_partitions(spark, tmp_path, monkeypatch):
    from seamstat.streaming import incremental as I
    table, stage = str(tmp_path / "t"), str(tmp_path / "s")
    first = spark.range(400).select(F.col("id").alias("g"), (F.col("id") % 4 + 2000).cast("int").alias("season"),
                                    F.lit(1).alias("v"))
    I.apply_batch(first, table, ["g"], staging=stage, batch_id=0, buckets=8)
    before, seen = files(table), []
    real = I.replace_keys
    monkeypatch.setattr(I, "replace_keys", lambda t, i, k: seen.append(t) or real(t, i, k))
    second = spark.createDataFrame([(5, 2001, 9)], "g long, season int, v int")
    I.apply_batch(second, table, ["g"], staging=stage, batch_id=1, buckets=8)
    own = f"season=2001/bucket={S.with_bucket(second, ['g'], 8).first()['bucket']}"
    after = files(table)
    assert {p: t for p, t in after.items() if not p.startswith(own)} == {p: t for p, t in before.items() if not p.startswith(own)}
    got = {r["g"]: r["v"] for r in spark.read.parquet(os.path.join(table, own)).collect()}
    assert got[5] == 9 and set(got.values()) == {1, 9} and len(seen) == 1
    assert len(before) >= 30


def test_the_scan_of_a_reload_is_pruned(spark, tmp_path):
    table = str(tmp_path / "t")
    rows = spark.range(400).select(F.col("id").alias("g"), (F.col("id") % 4 + 2000).cast("int").alias("season"))
    S.with_bucket(rows, ["g"], 8).write.partitionBy("season", "bucket").parquet(table)
    delta = S.with_bucket(spark.createDataFrame([(5, 2001), (9, 2001), (6, 2002)], "g long, season int"), ["g"], 8)
    df = spark.read.parquet(table).where(S.touched(delta, ["season", "bucket"]))
    touched = delta.select("season", "bucket").distinct().count()
    assert scanned(df)[0] == touched < 4

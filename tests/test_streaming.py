import os
import tempfile

from pyspark.sql import functions as F

from seamstat.streaming.incremental import apply_batch, start_reload

SF = "/root/testdata/sf0.001"


def test_incremental_reload_is_idempotent(spark):
    run = tempfile.mkdtemp(prefix="seamstat-stream-")
    li = spark.read.parquet(f"{SF}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", "l_quantity", F.year("l_shipdate").alias("season"))
    first = li.where(F.col("l_linenumber") <= 3)
    second = li.where(F.col("l_linenumber") >= 3).withColumn("l_quantity", F.col("l_quantity") + 100)
    src = os.path.join(run, "landed")
    first.write.parquet(os.path.join(src, "b1"))
    table = os.path.join(run, "table")
    q = start_reload(spark, os.path.join(src, "b1"), first.schema, table, ["l_orderkey"],
                     checkpoint_location=os.path.join(run, "ckpt1"))
    q.awaitTermination()
    got1 = spark.read.parquet(table)
    assert got1.count() == first.count()
    # Second delivery replaces whole orders it carries; replaying it changes nothing.
    apply_batch(second, table, ["l_orderkey"])
    after = sorted(spark.read.parquet(table).select("l_orderkey", "l_linenumber", "l_quantity").collect())
    apply_batch(second, table, ["l_orderkey"])
    again = sorted(spark.read.parquet(table).select("l_orderkey", "l_linenumber", "l_quantity").collect())
    assert after == again
    keys2 = {r["l_orderkey"] for r in second.select("l_orderkey").distinct().collect()}
    exp = first.join(second.select("l_orderkey").distinct(), "l_orderkey", "left_anti") \
        .unionByName(second).select("l_orderkey", "l_linenumber", "l_quantity")
    assert after == sorted(exp.collect())
    assert all(r["l_quantity"] > 100 for r in after if r["l_orderkey"] in keys2)


def _rows(spark, path):
    return sorted(map(tuple, spark.read.parquet(path).select("g", "season", "v").collect()))


def test_replay_after_a_failed_publish_keeps_stored_rows(spark):
    from seamstat.streaming import incremental as I
    run = tempfile.mkdtemp(prefix="seamstat-replay-")
    table, stage = os.path.join(run, "t"), os.path.join(run, "s")
    first = spark.createDataFrame([(1, 2020, 1), (2, 2020, 1), (3, 2021, 1)], "g long, season int, v int")
    second = spark.createDataFrame([(2, 2020, 5), (2, 2020, 5), (4, 2020, 5)], "g long, season int, v int")
    apply_batch(first, table, ["g"], staging=stage, batch_id=0, buckets=2)
    apply_batch(second, table, ["g"], row_key=["g"], staging=stage, batch_id=1, buckets=2)
    want = [(1, 2020, 1), (2, 2020, 5), (3, 2021, 1), (4, 2020, 5)]
    assert _rows(spark, table) == want
    # The table is lost half way through a commit: the replay publishes the staged rows.
    lost = I.with_bucket(second, ["g"], 2).first()["bucket"]
    spark.createDataFrame([], "g long, v int").write.mode("overwrite").parquet(
        os.path.join(table, f"season=2020/bucket={lost}"))
    apply_batch(second, table, ["g"], row_key=["g"], staging=stage, batch_id=1, buckets=2)
    assert _rows(spark, table) == want


def test_untouched_buckets_keep_their_files(spark):
    run = tempfile.mkdtemp(prefix="seamstat-bucket-")
    table = os.path.join(run, "t")
    rows = spark.range(200).select(F.col("id").alias("g"), F.lit(2020).alias("season"), F.lit(1).alias("v"))
    apply_batch(rows, table, ["g"], staging=os.path.join(run, "s"), batch_id=0)

    def files():
        return {f for d, _, names in os.walk(table) for n in names if n.endswith(".parquet")
                for f in [os.path.join(d, n)]}
    before = files()
    apply_batch(rows.where("g = 7").withColumn("v", F.lit(2)), table, ["g"], staging=os.path.join(run, "s"), batch_id=1)
    kept = before & files()
    assert len(before) - len(kept) == 1 and spark.read.parquet(table).count() == 200


def test_unreadable_table_is_not_an_empty_one(spark):
    import pytest
    run = tempfile.mkdtemp(prefix="seamstat-broken-")
    table = os.path.join(run, "t")
    rows = spark.createDataFrame([(1, 2020, 1)], "g long, season int, v int")
    apply_batch(rows, table, ["g"], staging=os.path.join(run, "s"), batch_id=0, buckets=1)
    part = os.path.join(table, "season=2020", "bucket=0")
    bad = [f for f in os.listdir(part) if f.endswith(".parquet")][0]
    with open(os.path.join(part, bad), "wb") as f:
        f.write(b"not parquet")
    os.remove(os.path.join(part, f".{bad}.crc"))
    with pytest.raises(Exception):
        apply_batch(rows, table, ["g"], staging=os.path.join(run, "s"), batch_id=1, buckets=1)
    assert open(os.path.join(part, bad), "rb").read() == b"not parquet"

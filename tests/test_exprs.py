from decimal import Decimal

from pyspark.sql import functions as F

from seamstat.functions import exprs as E


def one(df, col):
    return [r[col] for r in df.collect()]


def test_innings_notation(spark):  # B7
    df = spark.createDataFrame([(0,), (1,), (152,), (153,)], "outs bigint")
    assert one(df.select(E.innings_notation("outs").alias("ip")), "ip") == [
        Decimal("0.0"), Decimal("0.1"), Decimal("50.2"), Decimal("51.0")]


def test_rounding_rules(spark):  # B23, T3, T4
    df = spark.createDataFrame([(0.285, 2.5)], "a double, b double")
    r = df.select(E.np_round("a", 2).alias("np2"), E.np_round("b", 0).alias("np0"),
                  E.pg_round(F.col("a").cast("decimal(10,3)"), 2).alias("pg2"),
                  E.pg_round(F.col("b").cast("decimal(10,1)"), 0).alias("pg0"),
                  E.pg_round_double("a", 2).alias("pgd")).first()
    assert r["np2"] == 0.28 and r["np0"] == 2.0
    assert r["pg2"] == Decimal("0.29") and r["pg0"] == Decimal("3")
    assert r["pgd"] == 0.29


def test_int_div_mod_truncate(spark):  # SCA-05
    r = spark.range(1).select(E.int_div(F.lit(-7), F.lit(2)).alias("d"),
                              E.int_mod(F.lit(-7), F.lit(2)).alias("m")).first()
    assert (r["d"], r["m"]) == (-3, -1)


def test_safe_num_sentinel(spark):  # B28
    df = spark.createDataFrame([(".---",), (None,), ("6.2",)], "x string")
    assert one(df.select(E.safe_num("x").alias("v")), "v") == [None, None, 6.2]


def test_clip_keeps_null(spark):  # SCA-10, B22
    df = spark.createDataFrame([(2021, 2023), (2021, None)], "season int, debut int")
    assert one(df.select(E.clip_low(F.col("season") - F.col("debut"), 0).alias("x")), "x") == [0, None]


def test_park_adjust(spark):  # B14
    df = spark.createDataFrame([(0.2, 125.0), (0.2, 0.0), (0.2, None)], "iso double, pf double")
    got = one(df.select(E.park_adjust("iso", "pf").alias("x")), "x")
    assert abs(got[0] - 0.16) < 1e-12 and abs(got[1] - 0.2) < 1e-12 and got[2] is None


def test_barrel_tiers(spark):  # B15, T12
    rows = [(98.0, 26.0), (98.0, 25.0), (99.0, 31.0), (100.0, 33.0), (110.0, 14.0),
            (110.0, 13.0), (97.0, 28.0), (105.0, None), (None, 28.0)]
    df = spark.createDataFrame(rows, "ls double, la double")
    b = one(df.select(E.is_barrel("ls", "la").cast("int").alias("b")), "b")
    assert b[:8] == [1, 0, 1, 1, 1, 0, 0, 0]
    from seamstat.operators.aggs import rate_when
    rate = df.agg(rate_when(E.is_barrel("ls", "la"), F.col("ls").isNotNull()).alias("r")).first()["r"]
    assert rate == 4 / 8


def test_flag_null_is_zero(spark):  # T7
    df = spark.createDataFrame([(None,), (30.0,)], "age double")
    assert one(df.select(E.flag(F.col("age") > 28).alias("f")), "f") == [0, 1]


def test_age_years(spark):  # B20, B21
    import datetime as dt
    df = spark.createDataFrame([(dt.date(1995, 7, 1), 2022), (None, 2022)], "b date, season int")
    got = one(df.select(E.age_years("b", "season").alias("a")), "a")
    assert abs(got[0] - 9862 / 365.25) < 1e-12 and got[1] is None


def test_map_lookup_default(spark):
    from seamstat.functions import codes as K
    df = spark.createDataFrame([("C",), ("SS",), ("P",), (None,)], "pos string")
    got = one(df.select(E.map_lookup("pos", K.POSITION_GROUP, "other").alias("g")), "g")
    assert got == ["catcher", "speed_pos", "other", "other"]


def test_sized_conf_100tb():
    from seamstat.session import sized_conf
    c = sized_conf(100 * 1024 ** 4, 1000, 8)
    assert int(c["spark.sql.shuffle.partitions"]) == 102400
    assert int(c["spark.sql.files.maxPartitionBytes"]) == 512 * 1024 ** 2
    small = sized_conf(10 * 1024 ** 2, 1, 4)
    assert int(small["spark.sql.shuffle.partitions"]) == 8

"""Whole numbers of landed text, and the setting for wide projections."""
import inspect

from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType

from seamstat.plans import landed_queries
from seamstat.session import small_methods
from seamstat.sources.readers import from_text

KEY = "spark.sql.codegen.hugeMethodLimit"


def test_whole_numbers_of_text(spark):
    want = {"3": 3, "3.0": 3, "3.5": None, "-4.000": -4, " 12 ": 12, "1e3": 1000, "+5": 5, ".": None, "x": None,
            "x.y": None, "": None, "99999999999": None, "7.": 7}
    df = spark.createDataFrame([(k,) for k in want] + [(None,)], "t string")
    got = {r["t"]: (r["i"], r["l"]) for r in df.select("t", from_text(F.col("t"), IntegerType()).alias("i"),
                                                       from_text(F.col("t"), LongType()).alias("l")).collect()}
    assert got.pop(None) == (None, None)
    assert {k: v[0] for k, v in got.items()} == want
    assert got["99999999999"][1] == 99999999999 and got["3.0"][1] == 3


def test_a_text_with_a_point_is_not_cast_to_a_whole_number_first(spark):
    df = spark.createDataFrame([("3.0",)], "t string").select(from_text(F.col("t"), LongType()).alias("l"))
    assert "Contains(" in df._jdf.queryExecution().analyzed().toString() or \
        "contains(" in df._jdf.queryExecution().analyzed().toString().lower()


def test_wide_projections_are_written_by_short_methods(spark):
    old = spark.conf.get(KEY)
    try:
        with small_methods(spark):
            assert spark.conf.get(KEY) == "8000"
            raise KeyError
    except KeyError:
        pass
    assert spark.conf.get(KEY) == old
    assert "small_methods(spark)" in inspect.getsource(landed_queries.q_landed_pitches_csv)

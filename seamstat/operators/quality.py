"""Data-quality checks (DQ-*), each returned as a small report DataFrame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def check_row_count(before: DataFrame, after: DataFrame) -> DataFrame:
    """Row counts before and after a join chain and whether they agree."""
    b = before.agg(F.count(F.lit(1)).cast("bigint").alias("n")).withColumn("w", F.lit(0))
    a = after.agg(F.count(F.lit(1)).cast("bigint").alias("n")).withColumn("w", F.lit(1))
    both = b.unionByName(a).agg(
        F.max(F.when(F.col("w") == 0, F.col("n"))).alias("rows_before"),
        F.max(F.when(F.col("w") == 1, F.col("n"))).alias("rows_after"))
    return both.withColumn("stable", F.col("rows_before") == F.col("rows_after"))


def observed(df: DataFrame, name: str, cols: Sequence[str] = ()):
    """``df`` that counts its rows, and the non-null values of ``cols``, while
    some job reads it, and the observation that holds the counts afterwards.
    The counts belong to the first action that runs the returned rows."""
    from pyspark.sql import Observation
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("n_rows"),
                      *[F.count(F.col(f"`{c}`")).alias(f"{c}_matched") for c in cols]), seen


def observed_chain(base: DataFrame, chain, write, cols: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Row-count check and match rates of a join chain without a second pass
    (DQ-01, DQ-03): rows are counted on their way in and on their way out of
    ``chain`` (rows -> rows) while ``write`` (rows -> anything) runs it once.
    Returns the two reports, as ``check_row_count`` and ``match_rate`` do."""
    rows, before = observed(base, "before")
    out, after = observed(chain(rows), "after", cols)
    write(out)
    spark = base.sparkSession
    n0, n1 = before.get["n_rows"], after.get["n_rows"]
    check = spark.createDataFrame([(n0, n1, n0 == n1)], "rows_before bigint, rows_after bigint, stable boolean")
    matched = [after.get[f"{c}_matched"] for c in cols]
    rates = spark.createDataFrame(
        [(n1, *matched, *[m / n1 if n1 else None for m in matched])],
        ", ".join(["n_rows bigint", *[f"{c}_matched bigint" for c in cols], *[f"{c}_rate double" for c in cols]]))
    return check, rates


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their multiplicity."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).cast("bigint").alias("n_rows")) \
        .where(F.col("n_rows") > 1)


def match_rate(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Share of rows with a non-null value per column, in one pass."""
    aggs = [F.count(F.lit(1)).cast("bigint").alias("n_rows")]
    for x in cols:
        aggs += [F.count(x).cast("bigint").alias(f"{x}_matched")]
    out = df.agg(*aggs)
    return out.withColumns({f"{x}_rate": F.col(f"{x}_matched") / F.col("n_rows") for x in cols})


def span_report(df: DataFrame, season: str, entity: str,
                by: str | None = None) -> DataFrame:
    """Season span, rows and distinct entities (optionally per split)."""
    aggs = [F.min(season).alias("first_season"), F.max(season).alias("last_season"),
            F.count(F.lit(1)).cast("bigint").alias("n_rows"),
            F.countDistinct(entity).cast("bigint").alias("n_entities")]
    return (df.groupBy(by) if by else df).agg(*aggs)

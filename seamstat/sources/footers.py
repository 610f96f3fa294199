"""Bounds and row counts from Parquet footers (SRC-14, AGG-12, SNK-11).

Minimum, maximum and count of whole files are in their footers. A session of
its own reads the files through the data source that pushes such aggregates
down, so that no data page is read; other sessions keep their settings. Sums
of parts come from the footers of all files in a distributed scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def footer_session(spark: SparkSession) -> SparkSession:
    """A session of the same application that answers min, max and count of
    Parquet files from their footers."""
    own = spark.newSession()
    kept = [s for s in own.conf.get("spark.sql.sources.useV1SourceList").split(",") if s and s != "parquet"]
    own.conf.set("spark.sql.sources.useV1SourceList", ",".join(kept))
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own


def footer_bounds(footers: SparkSession, path: str, cols: Sequence[str]) -> DataFrame:
    """One row: ``n_rows`` and ``min_``/``max_`` of each column (numbers and
    dates; a column whose type has no order in footers is scanned)."""
    df = footers.read.parquet(path)
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for c in cols:
        aggs += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    return df.agg(*aggs)


def footer_counts(spark: SparkSession, **paths: str) -> DataFrame:
    """(table_name, n_rows) of stored tables."""
    footers, out = footer_session(spark), None
    for name, path in paths.items():
        one = footer_bounds(footers, path, []).select(F.lit(name).alias("table_name"), F.col("n_rows").cast("bigint").alias("n_rows"))
        out = one if out is None else out.unionByName(one)
    return out

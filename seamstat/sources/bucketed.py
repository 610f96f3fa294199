"""Tables bucketed and sorted by their join key, in the session's catalog.

Two tables bucketed alike join without an exchange and an aggregate by the
bucket key needs none either (JON-01, JON-04): the shuffle is paid once, when
the table is written. The bucket numbers live in the catalog, so such a table
is read by its name; its files lie where ``path`` says.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

BUCKETS = 64


def write_bucketed(df: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """Write ``df`` as table ``table`` (any earlier one of that name is
    replaced), one file a bucket, sorted by ``keys``; returns the table."""
    spark = df.sparkSession
    (df.repartition(buckets, *keys).write.mode("overwrite").format("parquet").option("path", path)
     .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table))
    return spark.table(table)


def drop_bucketed(spark: SparkSession, table: str) -> None:
    """Forget a table; its files stay."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")

"""Stored tables that are changed partition by partition (SNK-03 .. SNK-08).

A keyed store is a Parquet table partitioned by a bucket of its key. A delta
reads and rewrites only the buckets of its keys: their numbers are taken from
the staged delta first and go into the read of the table as literals, so the
file index prunes every other folder before the scan starts. The join of the
stored rows with the delta shuffles those buckets alone.

A change is applied in two steps, so it survives a failure at any point. The
new contents of the touched partitions are staged and closed by a marker; then
they replace the partitions. A repeated run of the same change finds the
marker and publishes the staged contents again without reading the table.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seamstat.operators import tables as TB
from seamstat.session import ensure_checkpoint_dir

BUCKETS = 64


def stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None if there is none. Any other failure is
    raised: a table that cannot be read is not an empty one."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def with_bucket(df: DataFrame, key: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    return df.withColumn("bucket", F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int"))


def touched(df: DataFrame, parts: Sequence[str]) -> Column:
    """Predicate of literals that holds in the partitions of ``df``'s rows
    (null is a partition too). At most one row a partition of the table
    reaches the driver."""
    rows = sorted((tuple(r) for r in df.select(*parts).distinct().collect()), key=repr)

    def among(values, rest):
        if not rest:
            return F.lit(True)
        col, out = F.col(rest[0]), F.lit(False)
        by_first: dict = {}
        for v in values:
            by_first.setdefault(v[0], []).append(v[1:])
        same = {}
        for first, tails in by_first.items():
            same.setdefault(tuple(tails), []).append(first)
        for tails, firsts in same.items():
            known = [x for x in firsts if x is not None]
            here = col.isin(known) if known else F.lit(False)
            if None in firsts:
                here = here | col.isNull()
            out = out | (here & among(list(tails), rest[1:]))
        return out

    return among(rows, list(parts)) if rows else F.lit(False)


def change_partitions(spark: SparkSession, path: str, delta: DataFrame, parts: Sequence[str],
                      rule: Callable[[DataFrame | None, DataFrame], DataFrame], staging: str, run: str) -> None:
    """Apply ``delta`` to the table at ``path``: ``rule`` gets the stored rows
    of the touched partitions (None without a table) and the delta, both with
    the partition columns, and returns the new rows of those partitions.

    The same ``run`` applied again publishes what it staged. A delta without
    rows changes nothing, but creates an absent table's folder.
    """
    arrived, rows, done = (os.path.join(staging, f"{run}-{x}") for x in ("arrived", "rows", "done"))
    if stored(spark, done) is None:
        current = stored(spark, path)
        if current is None:
            new = rule(None, delta)
        else:
            delta.write.mode("overwrite").parquet(arrived)
            delta = spark.read.schema(delta.schema).parquet(arrived)
            new = rule(current.where(touched(delta, parts)), delta)
        new.write.mode("overwrite").parquet(rows)
        spark.range(1).write.mode("overwrite").parquet(done)
    (spark.read.parquet(rows).repartitionByRange(*parts)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path))


@dataclass
class KeyedStore:
    """A table at ``path`` with one row per ``keys``, in ``buckets`` folders.
    The number of buckets belongs to the stored layout: a store is always
    opened with the number it was created with."""

    spark: SparkSession
    path: str
    keys: Sequence[str]
    buckets: int = BUCKETS

    def create(self, df: DataFrame) -> KeyedStore:
        (with_bucket(df, self.keys, self.buckets).repartitionByRange("bucket", *self.keys)
         .write.mode("error").partitionBy("bucket").parquet(self.path))
        return self

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.path).drop("bucket")

    def change(self, incoming: DataFrame, rule: Callable[[DataFrame, DataFrame], DataFrame],
               run: str | None = None) -> KeyedStore:
        """Apply ``rule(stored, incoming)`` (as in ``operators.tables``) to the
        buckets that the incoming keys fall into."""
        def contents(target, delta):
            new = rule(target.drop("bucket"), delta.drop("bucket"))
            return with_bucket(new, self.keys, self.buckets)

        staging = os.path.join(ensure_checkpoint_dir(self.spark), "staged", os.path.basename(self.path.rstrip("/")))
        change_partitions(self.spark, self.path, with_bucket(incoming, self.keys, self.buckets), ["bucket"], contents,
                          staging, run or uuid.uuid4().hex)
        return self

    def upsert(self, incoming: DataFrame, update_cols: Sequence[str] | None = None, order: str | None = None,
               run: str | None = None) -> KeyedStore:
        return self.change(incoming, lambda t, i: TB.upsert(t, i, self.keys, update_cols, order), run)

    def upsert_coalesce(self, incoming: DataFrame, cols: Sequence[str], run: str | None = None) -> KeyedStore:
        return self.change(incoming, lambda t, i: TB.upsert_coalesce(t, i, self.keys, cols), run)

    def insert_absent(self, incoming: DataFrame, run: str | None = None) -> KeyedStore:
        return self.change(incoming, lambda t, i: TB.insert_absent(t, i, self.keys), run)

    def replace_keys(self, incoming: DataFrame, run: str | None = None) -> KeyedStore:
        return self.change(incoming, lambda t, i: TB.replace_keys(t, i, self.keys), run)

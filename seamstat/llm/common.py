"""Shared helpers of the training-data operators."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seamstat.session import ensure_checkpoint_dir

# FIXED VALUE: a word is a run of anything but space and the ASCII controls 9-13.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def for_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it (a
    cluster installs it there, or ships it with --py-files)."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if PACKAGE_ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([PACKAGE_ROOT, *paths])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words of a text (null text: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def free_name(columns, base: str) -> str:
    """A column name that starts with ``base`` and is not taken by ``columns``
    (names compare without case, as Spark resolves them)."""
    taken = {c.lower() for c in columns}
    name = base
    while name.lower() in taken:
        name += "_"
    return name


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop input columns that clash with an operator's own output columns."""
    own = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in own])


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir`` (all executors see it)."""
    return os.path.join(ensure_checkpoint_dir(spark), "llm", f"{label}-{uuid.uuid4().hex}")


def landed(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends at
    files that any executor can read again, so a lost executor costs only
    its running tasks."""
    spark = df.sparkSession
    path = shared_path(spark, label)
    df.write.mode("error").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def crc_mod(id_col: Column, mod: int) -> Column:
    """crc32 of the id as text modulo ``mod`` (null id: null)."""
    return F.crc32(id_col.cast("string").cast("binary")) % F.lit(mod)


def hash60(text: Column) -> Column:
    """First 60 bits of the md5 of a string, as a non-negative long (the same
    in every SQL engine)."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")

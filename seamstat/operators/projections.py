"""Projection helpers (PRJ-02, PRJ-04, PRJ-07, PRJ-08)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rename_template(df: DataFrame, cols: Iterable[str], template: str) -> DataFrame:
    """Rename by a template such as ``'{}_prior'`` or ``'vsL_{}'``."""
    return df.withColumnsRenamed({c: template.format(c) for c in cols})


def drop_matching(df: DataFrame, prefix: str | None = None, suffix: str | None = None) -> DataFrame:
    """Drop columns by prefix (``lg_``) or suffix (``_prior``)."""
    return df.drop(*[c for c in df.columns
                     if (prefix and c.startswith(prefix)) or (suffix and c.endswith(suffix))])


def with_literal(df: DataFrame, name: str, value, dtype: str | None = None) -> DataFrame:
    v = F.lit(value)
    return df.withColumn(name, v.cast(dtype) if dtype else v)


def shift_key(df: DataFrame, col: str = "season", n: int = 1) -> DataFrame:
    return df.withColumn(col, F.col(col) + n)

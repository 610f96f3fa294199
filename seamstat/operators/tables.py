"""Table maintenance (SNK-*): idempotent reloads and upserts expressed as
joins and unions on DataFrames, written as whole Parquet tables.

``target`` is the current table and ``incoming`` the new rows; each
operator returns the new table contents. ``write_table`` persists it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, mode: str = "overwrite",
                partition_by: Sequence[str] | None = None) -> None:
    """Write Parquet; with ``partition_by`` and dynamic partition overwrite,
    only the partitions present in ``df`` are replaced (SNK-04)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    w.parquet(path)


def write_pitches_by_season(pitches: DataFrame, games: DataFrame, path: str,
                            game_pk: str = "game_pk", game_date: str = "game_date") -> None:
    """Store pitch events partitioned by season (taken from the game), so
    season-bounded reads prune whole directories. Rows are ranged by season
    and game, so a task holds one season (or a few small ones) and the number
    of files follows the data, not tasks times seasons."""
    g = games.select(game_pk, F.year(game_date).alias("season"))
    (pitches.join(g, game_pk, "inner")
     .repartitionByRange("season", game_pk).sortWithinPartitions("season", game_pk)
     .write.mode("overwrite").partitionBy("season").parquet(path))


def append(target: DataFrame, incoming: DataFrame) -> DataFrame:
    return target.unionByName(incoming, allowMissingColumns=True)


def replace_keys(target: DataFrame, incoming: DataFrame, key: Sequence[str]) -> DataFrame:
    """Delete every target row whose key appears in ``incoming``, then insert
    ``incoming`` (reloading a game twice gives the same table)."""
    keys = incoming.select(*key).distinct()
    return target.join(keys, list(key), "left_anti").unionByName(incoming)


def replace_partitions(target: DataFrame, incoming: DataFrame, col: str) -> DataFrame:
    """Same as ``replace_keys`` on one partition column (e.g. season)."""
    return replace_keys(target, incoming, [col])


def _dedup_last(incoming: DataFrame, keys: Sequence[str], order: str | None) -> DataFrame:
    """One incoming row per key; the last by ``order`` wins. A null order is
    the lowest; ties, and rows without an order, go to the greatest row by
    the other columns in turn, so the choice is the same on every run."""
    cols = [x for x in incoming.columns if x not in keys]
    if not cols:
        return incoming.distinct()
    rank = [F.col(order).isNotNull(), F.col(order)] if order else []
    picked = incoming.groupBy(*keys).agg(
        F.max_by(F.struct(*[F.col(x) for x in cols]),
                 F.struct(*[x.alias(f"r{i}") for i, x in enumerate(rank + [
                     y for x in cols for y in (F.col(x).isNotNull(), F.col(x))])])).alias("__r"))
    return picked.select(*keys, *[F.col("__r")[x].alias(x) for x in cols])


def insert_absent(target: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``INSERT ... ON CONFLICT DO NOTHING``: existing keys keep their row."""
    new = _dedup_last(incoming, keys, None).join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(new)


def upsert(target: DataFrame, incoming: DataFrame, keys: Sequence[str],
           update_cols: Sequence[str] | None = None,
           order: str | None = None) -> DataFrame:
    """``ON CONFLICT DO UPDATE``: new keys are inserted; on a matching key
    only ``update_cols`` (default: all non-key columns) take the incoming
    value, the others keep the stored one. With several incoming rows per
    key the last by ``order`` wins."""
    cols = [x for x in target.columns if x not in keys]
    update_cols = list(update_cols) if update_cols is not None else cols
    inc = _dedup_last(incoming, keys, order)
    t = target.select(*keys, *[F.col(x).alias("__t_" + x) for x in cols],
                      F.lit(True).alias("__in_t"))
    i = inc.select(*keys, *[F.col(x).alias("__i_" + x) for x in cols if x in inc.columns],
                   F.lit(True).alias("__in_i"))
    j = t.join(i, list(keys), "full_outer")
    out = []
    for x in cols:
        tv, has_i = F.col("__t_" + x), ("__i_" + x) in i.columns
        iv = F.col("__i_" + x) if has_i else F.lit(None)
        if x in update_cols and has_i:
            v = F.when(F.col("__in_i").isNotNull(), iv).otherwise(tv)
        else:
            v = F.when(F.col("__in_t").isNotNull(), tv).otherwise(iv)
        out.append(v.alias(x))
    return j.select(*keys, *out)


def upsert_coalesce(target: DataFrame, incoming: DataFrame, keys: Sequence[str],
                    cols: Sequence[str]) -> DataFrame:
    """Upsert keeping a stored non-null value: ``COALESCE(existing, new)``."""
    inc = _dedup_last(incoming, keys, None)
    t = target.select(*keys, *[F.col(x).alias("__t_" + x) for x in cols])
    i = inc.select(*keys, *[F.col(x).alias("__i_" + x) for x in cols])
    return t.join(i, list(keys), "full_outer").select(
        *keys, *[F.coalesce(F.col("__t_" + x), F.col("__i_" + x)).alias(x) for x in cols])


def align_to_schema(df: DataFrame, wanted: Sequence[str],
                    target_columns: Sequence[str], skip: Sequence[str] = ("id",)) -> DataFrame:
    """Keep wanted columns that exist both in the source and in the target
    (a generated id column is skipped)."""
    have, tgt = set(df.columns), set(target_columns)
    return df.select(*[x for x in wanted if x in have and x in tgt and x not in skip])


def table_counts(**tables: DataFrame) -> DataFrame:
    """Row count of each table as (table_name, n_rows) rows; every count is
    a partial aggregate, nothing but the counts reaches the driver."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).cast("bigint").alias("n_rows")) \
            .select(F.lit(name).alias("table_name"), "n_rows")
        out = one if out is None else out.unionByName(one)
    return out

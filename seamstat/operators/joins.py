"""Join operators (JON-*). All joins are equi-joins.

Broadcast policy: no join here carries a broadcast hint. Spark broadcasts a
side only below ``spark.sql.autoBroadcastJoinThreshold`` (estimated) or
``spark.sql.adaptive.autoBroadcastJoinThreshold`` (measured at run time) and
otherwise runs a sort-merge join; AQE splits skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unique_by(side: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """``side`` checked to have one row per key: a repeated key raises while
    the join runs instead of multiplying rows (a partial aggregate)."""
    cols = [x for x in side.columns if x not in keys]
    one = side.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"),
                                  F.any_value(F.struct(*cols)).alias("__r"))
    ok = F.when(F.col("__n") == 1, F.col("__r")).otherwise(
        F.raise_error(F.lit(f"{name}: more than one row for a key")).cast(one.schema["__r"].dataType))
    return one.select(*keys, ok.alias("__r")).select(*keys, *[F.col("__r")[x].alias(x) for x in cols])


def year_pairs(features: DataFrame, targets: Sequence[str], entity: str,
               season: str = "season", lead: int = 1,
               prefix: str = "next_") -> DataFrame:
    """Season N row paired with season N+lead outcomes of the same entity
    (inner), a self equi-join on (entity, season)."""
    future = features.select(
        entity, (F.col(season) - lead).alias(season),
        *[F.col(t).alias(prefix + t) for t in targets])
    return features.join(future, [entity, season], "inner")


def with_prior_year(df: DataFrame, side: DataFrame, keys: Sequence[str],
                    season: str, cols: Sequence[str], shift: int = 1) -> DataFrame:
    """Attach ``cols`` from the same season, falling back per column to the
    season ``shift`` years earlier (a row can mix years)."""
    same = side.select(*keys, season, *cols)
    prior = side.select(*keys, (F.col(season) + shift).alias(season),
                        *[F.col(x).alias(x + "_prior") for x in cols])
    out = df.join(same, [*keys, season], "left").join(prior, [*keys, season], "left")
    return out.withColumns({x: F.coalesce(F.col(x), F.col(x + "_prior")) for x in cols}) \
        .drop(*[x + "_prior" for x in cols])


def missing_keys(need: DataFrame, have: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys of ``need`` absent from ``have`` (anti-join)."""
    return need.select(*keys).distinct().join(have.select(*keys), list(keys), "left_anti")


def id_union(*parts: tuple[DataFrame, str], name: str = "player_id") -> DataFrame:
    """Set union of id columns from several tables."""
    frames = [df.select(F.col(col).alias(name)) for df, col in parts]
    out = frames[0]
    for f in frames[1:]:
        out = out.union(f)
    return out.distinct()


def id_minus(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    return a.join(b.select(*keys), list(keys), "left_anti")


def latest_snapshot(df: DataFrame, col: str) -> DataFrame:
    """Rows whose ``col`` equals the table's maximum (scalar subquery)."""
    return df.where(F.col(col) == df.select(F.max(col)).scalar())


def lookup(ids: DataFrame, table: DataFrame, key: str = "player_id",
           value: str = "player_name") -> DataFrame:
    """Stored values for a set of ids (``= ANY(:ids)``), as a semi-join on
    the distinct ids."""
    return table.join(ids.select(key).distinct(), key, "left_semi").select(key, value)

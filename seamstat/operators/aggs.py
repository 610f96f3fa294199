"""Aggregations (AGG-*). All are algebraic built-ins, so Spark aggregates
partially on the map side before the shuffle; a hot key costs one partial row
per task, never a whole group in one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seamstat.functions.exprs import c, count_when


def rate_when(indicator: Column, over: Column) -> Column:
    """Mean of a 0/1 indicator over the rows where ``over`` holds."""
    return F.avg(F.when(over, indicator.cast("int")))


def weighted_avg(x, w) -> Column:
    """Weighted mean over rows with a known value; null when no known value
    carries a positive total weight."""
    x, w = c(x), c(w).cast("double")
    num = F.sum(F.when(x.isNotNull(), x.cast("double") * w))
    den = F.sum(F.when(x.isNotNull(), w))
    return F.when(den > 0, num / den)


def ordered_concat(value: str, order_sql: str, sep: str = "/") -> Column:
    """Ordered string aggregation (``listagg ... WITHIN GROUP (ORDER BY ...)``),
    e.g. team codes by playing time, descending."""
    return F.expr(f"listagg({value}, '{sep}') WITHIN GROUP (ORDER BY {order_sql})")


def filtered_counts(spec: Sequence[tuple[str, Column]]) -> list[Column]:
    """Named ``COUNT(*) FILTER (WHERE ...)`` counters."""
    return [count_when(cond).alias(name) for name, cond in spec]


def together(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of a key side by side, in partitions of about the advisory size,
    before an aggregate whose groups are wide and many: each task then holds
    its own groups instead of a part of nearly all, so its partial aggregate
    reduces, and its memory follows the size of a partition. A large key is
    dealt over several partitions."""
    place = "__place"
    return df.withColumn(place, F.pmod(F.xxhash64(*keys), F.lit(65536)).cast("int")) \
        .hint("rebalance", F.col(place)).drop(place)


def rollup_total(df: DataFrame, keys: Sequence[str], team: str,
                 aggs: Sequence[Column], total_label: str = "TOT",
                 split_col: str = "split_type") -> DataFrame:
    """Per-team rows plus one total row per ``keys`` group, in one pass.

    ``GROUPING SETS ((keys, team), (keys))``: a single scan and a single
    shuffle; the total row's team is ``total_label`` and ``split_col`` is
    ``'team'`` or ``'total'``.
    """
    gid = "__gid"
    grouped = df.groupingSets([[*keys, team], [*keys]], *keys, team) \
        .agg(*aggs, F.grouping_id().alias(gid))
    is_total = F.col(gid) != 0
    return (grouped
            .withColumn(team, F.when(is_total, F.lit(total_label)).otherwise(F.col(team)))
            .withColumn(split_col, F.when(is_total, F.lit("total")).otherwise(F.lit("team")))
            .drop(gid))


def group_means(df: DataFrame, by: Sequence[str], cols: Sequence[str],
                prefix: str = "lg_") -> DataFrame:
    """Unweighted, null-skipping mean per group (league means per season)."""
    return df.groupBy(*by).agg(*[F.avg(x).alias(prefix + x) for x in cols])


def season_bounds(spans: Mapping[str, tuple[DataFrame, Column]]) -> DataFrame:
    """First and latest season covered by every table, and the next season.

    ``spans`` maps a table name to (table, season expression). Each table is
    reduced to (min, max) by a partial aggregate; the union is a handful of
    rows.
    """
    parts = [df.agg(F.min(expr).cast("bigint").alias("lo"),
                    F.max(expr).cast("bigint").alias("hi"))
             .withColumn("source", F.lit(name))
             for name, (df, expr) in spans.items()]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.agg(F.max("lo").alias("first_season"), F.min("hi").alias("latest_season")) \
        .withColumn("projection_season", F.col("latest_season") + 1)


def distinct_keys(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols).distinct()


def quality_starts(log: DataFrame, entity: str, season: str, started: str,
                   innings: str, earned: str, min_ip: float = 6.0,
                   max_er: int = 3, missing_er: int = 99) -> DataFrame:
    """Starts and quality starts per entity-season from a per-game log.

    A start is ``started >= 1``; a quality start also has innings >= 6.0 and
    earned runs <= 3, where a missing earned-run count reads as 99.
    """
    gs = F.coalesce(c(started), F.lit(0)) >= 1
    ip = F.coalesce(c(innings).cast("double"), F.lit(0.0))
    er = F.coalesce(c(earned), F.lit(missing_er))
    return log.groupBy(entity, season).agg(
        count_when(gs).alias("games_started"),
        count_when(gs & (ip >= min_ip) & (er <= max_er)).alias("quality_starts"))

"""Window operators (WIN-*).

Every window here is partitioned by an entity (player) or entity-season, so a
partition holds at most one row per season or per team of that player. None
is partitioned by a global key such as season alone: league-level statistics
are partial aggregates joined back (see ``features.regress_to_mean``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def rolling_wavg_columns(cols: Sequence[str], entity: str, order: str,
                         n: int, suffix: str | None = None) -> dict[str, Column]:
    """Linearly weighted rolling mean over the last ``n`` rows (weights
    1..k, newest heaviest), at least one row. A null anywhere in the frame
    gives null, as with a weighted average of the raw frame.

    Returns ``{name: expr}`` for one ``withColumns`` call, so all columns
    share one Window node (one sort per partition).
    """
    if n not in (2, 3):
        raise ValueError("rolling window of 2 or 3 rows")
    w = Window.partitionBy(entity).orderBy(order)
    rn = F.row_number().over(w)
    suffix = suffix or f"_{n}yr"
    out = {}
    for col in cols:
        x = F.col(col).cast("double")
        l1 = F.lag(x, 1).over(w)
        two = (l1 * 1.0 + x * 2.0) / 3.0
        if n == 2:
            expr = F.when(rn == 1, x).otherwise(two)
        else:
            l2 = F.lag(x, 2).over(w)
            three = (l2 * 1.0 + l1 * 2.0 + x * 3.0) / 6.0
            expr = F.when(rn == 1, x).when(rn == 2, two).otherwise(three)
        out[col + suffix] = expr
    return out


def rolling_wavg(df: DataFrame, cols: Sequence[str], entity: str, order: str,
                 windows: Sequence[int] = (2, 3)) -> DataFrame:
    exprs: dict[str, Column] = {}
    for n in windows:
        exprs.update(rolling_wavg_columns(cols, entity, order, n))
    return df.withColumns(exprs)


def first_per(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
              cols: Sequence[str] | None = None) -> DataFrame:
    """Keep the first row of each key group under an ascending ``order``.

    Done as a ``min_by`` aggregate over a struct (partial aggregation on the
    map side), so a very large group never has to sit in one task. Negate a
    numeric order expression for descending order; nulls in an order
    expression should be coalesced by the caller.
    """
    cols = [x for x in (cols or df.columns) if x not in keys]
    picked = df.groupBy(*keys).agg(
        F.min_by(F.struct(*[F.col(x) for x in cols]),
                 F.struct(*order)).alias("__row"))
    return picked.select(*keys, *[F.col("__row")[x].alias(x) for x in cols])

"""Scalar expressions (built-in Catalyst functions only, no Python UDF).

Numeric parity notes:
* ``pg_round`` rounds half away from zero on the *decimal* value. A double is
  first cast to decimal, which Spark does through its shortest printed form,
  the same way a SQL ``numeric`` cast of a float does (0.285 -> 0.29).
* ``np_round`` is the array-library rule: ``rint(x * 10^n) / 10^n``, half to
  even on the binary value (0.285 -> 0.28).
* ``py_round`` is the language's own rule: the nearest decimal to the exact
  binary value, half to even.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from seamstat.functions.codes import BARREL_TIERS


DEC_COUNT = DecimalType(20, 0)
DEC_VALUE = DecimalType(38, 18)


def c(x) -> Column:
    """Column from a name, a Column, or a Python literal."""
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(x)


# ---------------------------------------------------------------- numbers --
def to_count_decimal(x) -> Column:
    """Integer count as ``decimal(20,0)`` so ratios come out ``decimal(38,18)``."""
    return c(x).cast(DEC_COUNT)


def to_decimal(x, scale: int = 18) -> Column:
    return c(x).cast(DecimalType(38, scale))


def safe_div(num, den) -> Column:
    """``num / NULLIF(den, 0)``: null instead of a divide-by-zero error."""
    return c(num) / F.nullif(c(den), F.lit(0))


def ratio(num, den) -> Column:
    """Exact decimal ratio of two counts, null on a zero denominator."""
    return safe_div(to_count_decimal(num), to_count_decimal(den))


def pg_round(x, n: int = 0) -> Column:
    """Round half away from zero on the decimal value (SQL ``numeric``)."""
    return F.round(c(x), n)


def pg_round_double(x, n: int = 0) -> Column:
    """Round a double as a SQL engine rounds ``x::numeric`` and keep double."""
    return F.round(to_decimal(x, 12), n).cast("double")


def np_round(x, n: int = 0) -> Column:
    """Half-to-even rounding on the binary value (array-library ``round``)."""
    scale = float(10 ** n)
    return F.rint(c(x).cast("double") * F.lit(scale)) / F.lit(scale)


def py_round(x, n: int = 0) -> Column:
    """Correctly rounded decimal rounding of a double, half to even on its
    exact binary value (2.675 -> 2.67, as its value is below the tie; 0.125 ->
    0.12). ``x * 10^n`` is a rounded product; its error, found exactly by
    splitting both factors into halves of 26 bits, decides the side of a tie.
    From 2^52 on the product has no fraction, and the error alone decides;
    beyond 2^53 a double has no digit to lose. NaN and infinities stay."""
    scale = float(10 ** n)
    x = c(x).cast("double")
    a = F.abs(x)
    p = a * F.lit(scale)

    def halves(v):
        t = v * F.lit(134217729.0)      # 2^27 + 1
        high = t - (t - v)
        return high, v - high

    ah, al = halves(a)
    big = scale * 134217729.0
    sh = big - (big - scale)
    sl = scale - sh
    error = ((ah * F.lit(sh) - p) + ah * F.lit(sl) + al * F.lit(sh)) + al * F.lit(sl)
    whole = F.floor(p).cast("double")
    side = (p - whole - F.lit(0.5)) + error
    odd = whole % F.lit(2.0) != F.lit(0.0)
    units = (F.when(side > 0, whole + 1).when(side < 0, whole).otherwise(F.when(odd, whole + 1).otherwise(whole)))
    # No fraction left: a tie below the product belongs to the even neighbour.
    units = F.when((p >= F.lit(2.0 ** 52)) & (error == F.lit(-0.5)) & odd, whole - 1).otherwise(units)
    r = F.when(p < F.lit(2.0 ** 53), units / F.lit(scale)).otherwise(a)
    return F.when(F.signum(x) < 0, -r).otherwise(F.when(x == 0, x).otherwise(r))


def int_div(a, b) -> Column:
    """Integer division truncating toward zero (``-7 div 2 = -3``)."""
    a, b = c(a), F.nullif(c(b), F.lit(0))
    return ((a - a % b) / b).cast("bigint")


def int_mod(a, b) -> Column:
    """Remainder with the sign of the dividend (``-7 % 2 = -1``)."""
    return c(a) % F.nullif(c(b), F.lit(0))


def clip_low(x, lo=0) -> Column:
    """Floor at ``lo``; null stays null (``greatest`` would not keep it)."""
    x = c(x)
    return F.when(x < F.lit(lo), F.lit(lo)).otherwise(x)


def inf_to_null(x) -> Column:
    x = c(x)
    return F.when(x.isin(float("inf"), float("-inf")), F.lit(None)).otherwise(x)


def nan_to_null(x) -> Column:
    x = c(x)
    return F.when(F.isnan(x), F.lit(None)).otherwise(x)


def fill(x, default) -> Column:
    return F.coalesce(c(x), c(default))


def flag(cond: Column) -> Column:
    """Indicator 0/1 from a condition; an unknown (null) condition is 0."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def safe_num(x, to: str = "double") -> Column:
    """Parse numeric text; sentinels such as ``.---`` become null."""
    return c(x).try_cast(to)


def full_name(last, first) -> Column:
    return F.concat_ws(", ", c(last), c(first))


def map_lookup(x, mapping: Mapping, default=None) -> Column:
    """Literal map lookup with a default for missing keys."""
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    looked = F.create_map(*pairs)[c(x)]
    return looked if default is None else F.coalesce(looked, F.lit(default))


def isin(x, values: Iterable) -> Column:
    return c(x).isin(list(values))


def count_when(cond: Column) -> Column:
    """``COUNT(*) FILTER (WHERE cond)`` as a bigint (0 when none)."""
    return F.count_if(cond).cast("bigint")


# ------------------------------------------------------------ dates/ages --
def season_of(d) -> Column:
    return F.year(c(d))


def month_of(d) -> Column:
    return F.month(c(d))


def midseason(season) -> Column:
    """July 1st of the season."""
    return F.make_date(c(season), F.lit(7), F.lit(1))


def age_years(birth, season) -> Column:
    """Age in years at midseason: whole days / 365.25."""
    return F.datediff(midseason(season), c(birth)) / F.lit(365.25)


# --------------------------------------------------------------- domain --
def innings_notation(outs) -> Column:
    """Baseball notation: whole innings plus .1 per extra out (152 -> 50.2)."""
    o = c(outs)
    return (int_div(o, 3).cast(DEC_COUNT) +
            int_mod(o, 3).cast(DEC_COUNT) * F.lit(0.1).cast(DecimalType(2, 1))
            ).cast(DecimalType(21, 1))


def innings_numeric(outs) -> Column:
    """Innings as a number: outs / 3."""
    return to_count_decimal(outs) / F.lit(3).cast(DEC_COUNT)


def is_barrel(speed, angle) -> Column:
    """Barrel indicator over the tiered speed x angle boxes; an unknown angle
    counts as no barrel."""
    s, a = c(speed), c(angle)
    conds = [(s >= F.lit(lo_speed)) & a.between(lo, hi)
             for lo_speed, lo, hi in BARREL_TIERS]
    out = conds[0]
    for cond in conds[1:]:
        out = out | cond
    return F.coalesce(out, F.lit(False))


def park_adjust(x, park_factor) -> Column:
    """``x * (100 / pf)`` with a zero factor read as neutral (100)."""
    pf = c(park_factor)
    return c(x) * (F.lit(100.0) / F.when(pf == 0, F.lit(100)).otherwise(pf))


def weighted_rate(num, den) -> Column:
    return safe_div(c(num).cast("double"), c(den).cast("double"))

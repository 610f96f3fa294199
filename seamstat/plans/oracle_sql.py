"""Helpers for writing the DuckDB oracle SQL of the driver queries.

Rounded rates are computed in exact integer arithmetic (half away from
zero), then divided once into a double, so both engines produce the same
nearest double of the same decimal.
"""


def rint_div(p: str, q: str, n: int) -> str:
    """Integer k = round_half_away(p / q * 10^n) for integer-valued p, q;
    NULL when q = 0."""
    P = f"CAST(({p}) AS HUGEINT)"
    Q = f"CAST(({q}) AS HUGEINT)"
    return (f"(CASE WHEN {Q} = 0 THEN NULL ELSE sign({P}) * sign({Q}) * "
            f"((2 * {10 ** n} * abs({P}) + abs({Q})) // (2 * abs({Q}))) END)")


def rdiv(p: str, q: str, n: int) -> str:
    """round(p / q, n) as DOUBLE, exact half-away-from-zero rounding."""
    return f"(CAST({rint_div(p, q, n)} AS DOUBLE) / {10 ** n}.0)"


def round_dbl(x: str, n: int) -> str:
    """Round a double the way a SQL ``numeric`` cast does (decimal first)."""
    return f"CAST(round(CAST(({x}) AS DECIMAL(38,12)), {n}) AS DOUBLE)"


def exact(x: str, n: int) -> str:
    """Round a double on its exact binary value, half to even: printing with
    ``n`` decimals is correctly rounded."""
    return f"CAST(printf('%.{n}f', CAST({x} AS DOUBLE)) AS DOUBLE)"

"""Scalar helpers shared by every model: `Column -> Column`, all JVM-side.

Each helper keeps the warehouse semantics the models were written for
(NULL on division by zero, NULL-propagating LEAST, whitespace trim).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import SURROGATE_KEY_NULL

# Fixed value: characters stripped by `trim_ws` (space, tab, LF, VT, FF, CR).
WHITESPACE = " \t\n\x0b\x0c\r"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_divide(a, b) -> Column:
    """NULL when the divisor is 0 or NULL (never raises under ANSI mode)."""
    return F.try_divide(col(a), col(b))


def nullif_zero(c) -> Column:
    return F.nullif(col(c), F.lit(0))


def least_nn(c, cap: float) -> Column:
    """LEAST(x, cap) that stays NULL when x is NULL (Spark's least skips NULLs)."""
    c = col(c)
    return F.when(c.isNotNull(), F.least(c, F.lit(float(cap))))


def trim_ws(c) -> Column:
    """Strip all ASCII whitespace at both ends; Spark's trim removes spaces only."""
    return F.btrim(col(c), F.lit(WHITESPACE))


def flag_normalise(c) -> Column:
    """coalesce(trim(cast(flag as string)), '')."""
    return F.coalesce(trim_ws(col(c).cast("string")), F.lit(""))


def surrogate_key(*cols) -> Column:
    """md5 over '-'-joined string forms, NULL replaced by the macro's placeholder."""
    parts = [F.coalesce(col(c).cast("string"), F.lit(SURROGATE_KEY_NULL)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def flag_when(cond: Column) -> Column:
    """CASE WHEN cond THEN true ELSE false END: false (never NULL) on NULL input."""
    return F.coalesce(cond, F.lit(False))


def in_period(year, start: int, end: int) -> Column:
    return flag_when(col(year).between(start, end))


def present(c) -> Column:
    return col(c).isNotNull()


def present_count(*cols) -> Column:
    total = None
    for c in cols:
        term = F.when(col(c).isNotNull(), F.lit(1)).otherwise(F.lit(0))
        total = term if total is None else total + term
    return total


def mean_of_present(*cols, digits: int = 2) -> Column:
    """round(sum of coalesce(x,0) / nullif(count of non-null x, 0), digits)."""
    total = None
    for c in cols:
        term = F.coalesce(col(c), F.lit(0))
        total = term if total is None else total + term
    return F.round(safe_divide(total, nullif_zero(present_count(*cols))), digits)


def map_values(c, mapping: dict, default=None) -> Column:
    """CASE c WHEN k THEN v ... [ELSE default] END, as a chained `when`."""
    c = col(c)
    expr = None
    for k, v in mapping.items():
        expr = F.when(c == F.lit(k), F.lit(v)) if expr is None else expr.when(c == F.lit(k), F.lit(v))
    if default is not None:
        expr = expr.otherwise(F.lit(default))
    return expr

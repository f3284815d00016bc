"""Aggregate expressions that are exact and overflow-safe at any row count.

``exact_sum`` splits every bigint into a high and a low part so both partial sums
stay far inside 64 bits even when one group holds a third of a 100 TB table;
the parts are recombined once per group in decimal(38,0). Means are one
division of that exact sum, so Spark and the SQL oracle agree bit for bit,
independent of partitioning and summation order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SHIFT = 20
_SPLIT = 1 << _SHIFT


def exact_sum(x: Column) -> Column:
    """Exact SUM of a bigint column as decimal(38,0) (null when no values)."""
    x = x.cast("long")
    hi = F.shiftright(x, _SHIFT)  # arithmetic shift: floor(x / 2^20)
    lo = x.bitwiseAND(F.lit(_SPLIT - 1))  # 0 <= lo < 2^20, x = hi * 2^20 + lo
    return F.sum(hi).cast("decimal(38,0)") * F.lit(_SPLIT) + F.sum(lo).cast("decimal(38,0)")


def exact_mean(x: Column, scale: int = 1, count: Column | None = None) -> Column:
    """sum(x) / (n * scale) as double, n = count(x) unless ``count`` is given."""
    n = F.count(x) if count is None else count
    den = n * F.lit(scale)
    return F.when(n > 0, exact_sum(x).cast("double") / den.cast("double"))


def count_if(cond: Column) -> Column:
    """COUNT(CASE WHEN cond THEN 1 END)."""
    return F.count(F.when(cond, F.lit(1)))


def percent(n: Column, m: Column) -> Column:
    """round(n * 100 / m, 2) computed exactly with half-up rounding; null if m = 0.

    Integer arithmetic keeps the result identical across engines and equal to an
    exact NUMERIC computation: floor((n * 20000 + m) / (2 m)) / 100.
    """
    num = n.cast("long") * F.lit(20000) + m.cast("long")
    den = m.cast("long") * F.lit(2)
    whole = (num - num % den).cast("decimal(38,0)")  # exact multiple of den
    q = (whole / den.cast("decimal(38,0)")).cast("long")
    return F.when(m != 0, q / F.lit(100.0))

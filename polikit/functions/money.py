"""Exact, order-independent rounding of sums, averages and ratios.

Money is ``Decimal`` so sums are exact whatever the partitioning. Averages and
ratios are rounded half away from zero on the exact rational ``num / den``
(integer arithmetic on decimal(38,0)), then cast to double. Any engine that does
the same integer arithmetic gets the same double, bit for bit.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def ratio_half_up(num: str, den: str, digits: int, num_scale: int = 0, den_scale: int = 0) -> Column:
    """round((num / den), digits) half away from zero, as double; null if den is 0 or null.

    ``num`` and ``den`` are SQL texts of exact numbers with at most ``num_scale`` /
    ``den_scale`` decimals (integers when 0)."""
    return F.expr(ratio_half_up_sql(num, den, digits, num_scale, den_scale))


def ratio_half_up_sql(num: str, den: str, digits: int, num_scale: int = 0, den_scale: int = 0) -> str:
    """SQL text of ``ratio_half_up`` (``div`` on decimals is exact integral division)."""
    a = (f"(CAST(CAST(({num}) * {10 ** num_scale} AS DECIMAL(38,0)) * "
         f"CAST({10 ** (den_scale + digits)} AS DECIMAL(38,0)) AS DECIMAL(38,0)))")
    b = (f"(CAST(CAST(({den}) * {10 ** den_scale} AS DECIMAL(38,0)) * "
         f"CAST({10 ** num_scale} AS DECIMAL(38,0)) AS DECIMAL(38,0)))")
    q = f"((2 * abs({a}) + abs({b})) div (2 * abs({b})))"
    return (f"CASE WHEN {b} <> 0 THEN CAST(CASE WHEN ({a} < 0) <> ({b} < 0) THEN -{q} ELSE {q} END AS DOUBLE)"
            f" / CAST({10 ** digits} AS DOUBLE) END")

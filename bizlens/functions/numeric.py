"""Numeric result conventions shared by every job.

Fractional results are rounded half away from zero on an exact decimal and
then returned as DOUBLE; integer results as BIGINT. Money is summed as
DECIMAL(18,2), never as double, so totals do not depend on summation order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded(c: Column, scale: int) -> Column:
    return F.round(c.cast("decimal(38,12)"), scale).cast("double")


def money(c: str | Column) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return col.cast("decimal(18,2)")


def div(num: Column, den: Column) -> Column:
    """Exact decimal quotient with at least 16 fractional digits.

    Operands are cast to DECIMAL(24,4) / DECIMAL(20,2) so that Spark's
    precision rules keep scale 16 (a DECIMAL(38,6) operand would leave only 6
    digits, and a later ``round`` could then round an already rounded value).
    Division by zero gives NULL (``try_divide``), as SQL ``NULLIF`` would.
    """
    return F.try_divide(num.cast("decimal(24,4)"), den.cast("decimal(20,2)"))

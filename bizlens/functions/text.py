"""String cleaning: null spellings, unit suffixes, delimited id lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_markers(c: str | Column, markers: Sequence[str] = ("null", "")) -> Column:
    """Text spellings of 'no value' become a real NULL (NULL stays NULL)."""
    col = _col(c)
    return F.when(col.isin(*markers), F.lit(None).cast("string")).otherwise(col)


def strip_units(c: str | Column, suffixes: Sequence[str]) -> Column:
    """First matching suffix wins; its *characters* are trimmed from both ends.

    This is SQL ``TRIM(chars FROM s)`` semantics (a character set, not a
    substring), so ``'23.4 km'`` keeps a trailing blank, which the later
    numeric cast accepts.
    """
    col = _col(c)
    expr = None
    for sfx in suffixes:
        branch = F.btrim(col, F.lit(sfx))
        expr = F.when(col.endswith(sfx), branch) if expr is None else expr.when(col.endswith(sfx), branch)
    return col if expr is None else expr.otherwise(col)


def id_list(c: str | Column) -> Column:
    """``'1, 5'`` -> ``array<int>(1, 5)``; NULL stays NULL; duplicates kept."""
    col = _col(c)
    return F.transform(F.split(col, ","), lambda x: F.trim(x).cast("int"))

"""First / last rows per key, ranks and top-k -- shaped so that a hot key
never has to be sorted inside one task.

* ``rows_at_extreme`` replaces ``RANK() ... = 1`` and ``rank_by_value``
  replaces ``RANK() OVER (PARTITION BY k ORDER BY v)``: the extreme, or the
  ranks of the distinct values, come from a partial aggregate and join back to
  the rows; Spark can split a hot key in that join. No row is ever copied.
* ``keep_rank_one`` and ``rank_globally`` do the same without a key, where a
  plain window sorts everything in one task.
* ``top_k`` is a global ``ORDER BY ... LIMIT`` with a deterministic
  tie-break (TakeOrderedAndProject: per-partition top-k, then a merge).
* ``in_order`` sorts a result with explicit NULL placement.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bizlens.operators.scan import range_slices, scan


def _attach(df: DataFrame, found: DataFrame, keys: Sequence[str], carry: str) -> DataFrame:
    """Joins ``carry`` of ``found`` (one row per ``keys``) to ``df``; NULL keys match."""
    right = found.select(*[F.col(k).alias(f"_{i}") for i, k in enumerate(keys)], carry)
    cond = None
    for i, k in enumerate(keys):
        same = df[k].eqNullSafe(F.col(f"_{i}"))
        cond = same if cond is None else cond & same
    return df.join(right, cond).select(*df.columns, carry)


def rows_at_extreme(df: DataFrame, keys: Sequence[str], value: str, how: str = "min") -> DataFrame:
    """All rows whose ``value`` equals the per-key min (or max): RANK = 1 with ties."""
    extreme = df.groupBy(*keys).agg((F.min if how == "min" else F.max)(value).alias("_x"))
    return _attach(df, extreme, keys, "_x").filter(F.col(value) == F.col("_x")).drop("_x")


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[str], carry: Sequence[str] = ()) -> DataFrame:
    """One row per key: the smallest (order..., carry...) tuple.

    ``ROW_NUMBER() ... = 1`` with the tie-break made explicit; computed as a
    ``min(struct)`` aggregate, so the map side pre-aggregates every key.
    """
    fields = [*order, *carry]
    m = F.min(F.struct(*[F.col(c) for c in fields])).alias("_m")
    return df.groupBy(*keys).agg(m).select(*keys, *[F.col(f"_m.{c}").alias(c) for c in fields])


def ranks_of_values(df: DataFrame, keys: Sequence[str], value: str, out: str = "rank",
                    descending: bool = False) -> DataFrame:
    """(keys, value, rank): the SQL rank of every distinct value of a key, from
    the counts per value (a window over distinct values only)."""
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy(F.col(value).desc() if descending else F.col(value).asc()).rowsBetween(
        Window.unboundedPreceding, -1)
    return counts.select(*keys, value, (F.coalesce(F.sum("_n").over(before), F.lit(0)) + 1).alias(out))


def rank_by_value(df: DataFrame, keys: Sequence[str], value: str, out: str = "rank",
                  descending: bool = False) -> DataFrame:
    """``RANK() OVER (PARTITION BY keys ORDER BY value)`` attached to every row."""
    return _attach(df, ranks_of_values(df, keys, value, out, descending), [*keys, value], out)


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)


def keep_rank_one(df: DataFrame, value: str) -> DataFrame:
    """Global ``RANK() OVER (ORDER BY value DESC) = 1``, ties kept: the rows that equal the largest value, which
    is one aggregate (a row per task) and not a sort of everything in one task."""
    return df.filter(F.col(value).eqNullSafe(df.agg(F.max(value)).scalar()))


def global_ranks(df: DataFrame, value: str, out: str = "rank", descending: bool = False, dense: bool = False) -> DataFrame:
    """(value, out): ``RANK()`` or ``DENSE_RANK() OVER (ORDER BY value)`` of every distinct value.

    Rows are counted per value first, so ties are one row and cannot lie on both sides of a border; the values
    are dealt by range into stored slices, ranked inside each, and moved on by the counts of the slices before.
    """
    counts = df.groupBy(value).agg(F.count(F.lit(1)).alias("_n"))
    slices = range_slices(counts, [], [value], "_slice")
    upto = scan(slices, [], "_slice", [value], sums={"_rows": "_n", "_values": F.lit(1)})
    if descending:  # what comes after going up comes before going down
        total = slices.agg(F.sum("_n").alias("n"), F.count(F.lit(1)).alias("v"))
        rows, values = total.select("n").scalar(), total.select("v").scalar()
        rank = values - F.col("_values") + 1 if dense else rows - F.col("_rows") + 1
    else:
        rank = F.col("_values") if dense else F.col("_rows") - F.col("_n") + 1
    return upto.select(value, rank.cast("bigint").alias(out))


def rank_globally(df: DataFrame, value: str, out: str = "rank", descending: bool = False, dense: bool = False) -> DataFrame:
    """:func:`global_ranks` attached to every row."""
    return _attach(df, global_ranks(df, value, out, descending, dense), [value], out)


def in_order(df: DataFrame, *keys: str) -> DataFrame:
    """The result sorted by columns, ``-name`` for descending: NULLs last going
    up and first going down, whatever the engine's default."""
    return df.orderBy(*[F.col(k[1:]).desc_nulls_first() if k.startswith("-") else F.col(k).asc_nulls_last()
                        for k in keys])

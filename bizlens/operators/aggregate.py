"""Aggregation helpers: conditional sums, ordered string aggregation and a
discrete percentile computed from a value histogram."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bizlens.operators.scan import range_slices


def sum_if(cond: Column, value: Column | int = 1, otherwise: Column | int | None = 0) -> Column:
    """``SUM(CASE WHEN cond THEN value ELSE otherwise END)``; ``otherwise=None``
    reproduces a CASE without ELSE (NULL when nothing matches)."""
    v = value if isinstance(value, Column) else F.lit(value)
    e = F.when(cond, v)
    if otherwise is not None:
        e = e.otherwise(otherwise if isinstance(otherwise, Column) else F.lit(otherwise))
    return F.sum(e)


def ordered_join(value: Column, order: Column, sep: str = ", ") -> Column:
    """``STRING_AGG(value, sep ORDER BY order)``: NULL values skipped, NULL if none.

    Collects (order, value) pairs of the group. Where a group may be large,
    group by (group, slice) first, the slices running along the order, and join
    the slices' texts in the order of the slices: ``ordered_join(text, slice)``.
    """
    pairs = F.collect_list(F.when(value.isNotNull(), F.struct(order.alias("o"), value.alias("v"))))
    joined = F.array_join(F.transform(F.sort_array(pairs), lambda s: s["v"]), sep)
    return F.when(F.size(pairs) > 0, joined)


def percentile_disc(df: DataFrame, group_cols: Sequence[str], value: str, weight: str | None,
                    fractions: dict[str, float]) -> DataFrame:
    """``PERCENTILE_DISC(p) WITHIN GROUP (ORDER BY value)`` for several p at once.

    The result for p is the first value whose cumulative count reaches
    ``ceil(p * N)`` (p = 0 gives the smallest value). NULL values are skipped.

    Rows are first counted per (group, value). The counts are dealt by range of
    (group, value) into stored slices; the slices' totals, a row per group and
    slice, say in which slice each wanted value lies; only those slices are added
    up row by row. A group of any number of values is in no task as a whole.
    """
    w_col = F.col(weight) if weight else F.lit(1)
    hist = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*group_cols, value)
        .agg(F.sum(w_col).cast("bigint").alias("_n"))
    )
    hist = range_slices(hist, group_cols, [value], "_slice")
    per_slice = hist.groupBy(*group_cols, "_slice").agg(F.sum("_n").alias("_in"))
    group = Window.partitionBy(*group_cols)
    before = group.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    placed = per_slice.select(*group_cols, "_slice", "_in", F.coalesce(F.sum("_in").over(before), F.lit(0)).alias("_before"),
                              F.sum("_in").over(group).cast("decimal(38,0)").alias("_total"))

    def target(p: float) -> Column:  # how many rows the value and those before it must have, within the slice
        return F.greatest(F.ceil(F.col("_total") * F.lit(p).cast("decimal(10,6)")), F.lit(1)).cast("bigint") - F.col("_before")

    wanted = placed.select(*group_cols, "_slice", "_in", F.explode(F.array(
        *[F.struct(F.lit(name).alias("name"), target(p).alias("need")) for name, p in fractions.items()])).alias("_w"))
    wanted = wanted.filter((F.col("_w.need") > 0) & (F.col("_w.need") <= F.col("_in"))).groupBy(*group_cols, "_slice").agg(
        F.map_from_entries(F.collect_list("_w")).alias("_need"))  # an entry per fraction at most
    right = wanted.toDF(*[f"_g{k}" for k in range(len(group_cols))], "_s", "_need")
    same = hist["_slice"] == right["_s"]
    for k, c in enumerate(group_cols):
        same = same & hist[c].eqNullSafe(right[f"_g{k}"])
    upto = Window.partitionBy(*group_cols, "_slice").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    rows = hist.join(right, same).select(*group_cols, value, "_need", F.sum("_n").over(upto).alias("_cum"))
    reached = [F.min(F.when(F.col("_cum") >= F.col("_need")[name], F.col(value))).alias(name) for name in fractions]
    return rows.groupBy(*group_cols).agg(*reached)

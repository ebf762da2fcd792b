"""Running sums, neighbours and moving frames per key, with no key in one task.

A plain window sorts all rows of a key in one task. Here a key's rows are cut
into slices along the order, and every window runs inside (key, slice):

1. Per slice, one row of what the slices after it need: its sums, its last row,
   its last known values (a partial aggregate, so nothing hot moves).
2. Those rows, one per slice, are scanned per key: what came before each slice.
3. The outcome goes to its slice as a row in front of the slice's own (and, for
   a look ahead, one behind), so the windows inside find there what they would
   have found in the rows before. The extra rows go at the end.

A slice is any column that never falls along the order: a month for dates
(:func:`month_of`), a block of consecutive positions (:func:`block_of`), or, for
any other order, ranges of equal size (:func:`range_slices`). ``order`` must tell
rows of a key apart; rows that tie are to be aggregated first. Keys, slices and
orders may be NULL (first, as Spark sorts them); NULL keys are one key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def month_of(date: str) -> Column:
    return F.trunc(date, "month")


def block_of(position: str | Column, size: int) -> Column:
    return F.floor((F.col(position) if isinstance(position, str) else position) / F.lit(size)).cast("bigint")


def range_slices(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "slice",
                 slices: int | None = None) -> DataFrame:
    """``df`` as a stored table with the column ``out``: about as many slices of equal size as shuffle
    partitions. It is written before it is read, since the bounds come from a sample."""
    n = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return settled(df.repartitionByRange(n, *keys, *order).withColumn(out, F.spark_partition_id()), "slices")


def settled(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a written table. :func:`scan` reads its rows twice, for the edges and for the windows; between one
    scan and the next they are written, else each would be worked out twice as often as the one before."""
    from bizlens.session import table_path

    path = table_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _at_end(value: Column, order: Sequence[str], first: bool) -> Column:
    """The value of the first or last row of a group, as an aggregate; NULL orders come first."""
    if len(order) > 1:
        at = F.struct(*[F.col(c) for c in order])
        return F.min_by(value, at) if first else F.max_by(value, at)
    at = F.col(order[0])  # min_by and max_by leave rows aside whose order is NULL; there is one at most
    unplaced = F.max(F.when(at.isNull(), value))
    if first:
        return F.when(F.count(at) < F.count(F.lit(1)), unplaced).otherwise(F.min_by(value, at))
    return F.when(F.count(at) == 0, unplaced).otherwise(F.max_by(value, at))


def _last_known(value: Column, order: Sequence[str]) -> Column:
    at = F.struct(*[F.col(c) for c in order])
    if len(order) > 1:
        return F.max_by(value, F.when(value.isNotNull(), at))
    at = F.col(order[0])
    return F.coalesce(F.max_by(value, F.when(value.isNotNull(), at)), F.max(F.when(at.isNull(), value)))


def scan(df: DataFrame, keys: Sequence[str], slice_: str, order: Sequence[str], *,
         sums: Mapping[str, str | Column] = {}, lags: Mapping[str, str | Column] = {},
         leads: Mapping[str, str | Column] = {}, lasts: Mapping[str, str | Column] = {},
         firsts: Mapping[str, str | Column] = {}) -> DataFrame:
    """``df`` and, by the name of the new column: running ``sums`` up to the row, the value of the row before
    (``lags``) or after (``leads``), the last value so far that is not NULL (``lasts``) and the value of the
    key's first row (``firsts``)."""
    col = {name: c if isinstance(c, Column) else F.col(c)
           for group in (sums, lags, leads, lasts, firsts) for name, c in group.items()}
    rows = df.select("*", *[c.alias(f"_scan_{name}") for name, c in col.items()])

    edge = {}  # what a slice tells the others
    for name in col:
        v = F.col(f"_scan_{name}")
        if name in sums:
            edge[name] = F.sum(v)
        elif name in lasts:
            edge[name] = _last_known(v, order)
        else:
            edge[name] = _at_end(v, order, first=name not in lags)
    edges = rows.groupBy(*keys, slice_).agg(*[c.alias(f"_scan_{n}") for n, c in edge.items()])

    along = Window.partitionBy(*keys).orderBy(slice_)
    so_far = along.rowsBetween(Window.unboundedPreceding, -1)
    types = {n: rows.select(F.sum(f"_scan_{n}") if n in sums else F.col(f"_scan_{n}")).schema[0].dataType for n in col}
    found = {}  # what the slices before it, or for leads the one after it, tell a slice
    for name in col:
        v = F.col(f"_scan_{name}")
        found[name] = (F.sum(v).over(so_far) if name in sums else F.lag(v).over(along) if name in lags
                       else F.last(v, ignorenulls=True).over(so_far) if name in lasts
                       else F.first(v).over(so_far) if name in firsts else F.lead(v).over(along))
    told = edges.select(*keys, slice_, F.row_number().over(along).alias("_slice_nth"),
                        *[c.cast(types[n]).alias(f"_scan_{n}") for n, c in found.items()])
    sides = [(F.col("_slice_nth") > 1, -1, [n for n in col if n not in leads])]
    if leads:
        sides.append((F.lit(True), 1, list(leads)))
    all_rows = rows.select("*", F.lit(0).alias("_slice_side"))
    for some, side, names in sides:
        extra = told.filter(some).select(*keys, slice_, *[f"_scan_{n}" for n in names], F.lit(side).alias("_slice_side"))
        all_rows = all_rows.unionByName(extra, allowMissingColumns=True)

    inside = Window.partitionBy(*keys, slice_).orderBy("_slice_side", *order)
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    out = []
    for name in col:
        v = F.col(f"_scan_{name}")
        new = (F.sum(v).over(upto).cast(types[name]) if name in sums else F.lag(v).over(inside) if name in lags
               else F.lead(v).over(inside) if name in leads
               else F.last(v, ignorenulls=True).over(upto) if name in lasts else F.first(v).over(upto))
        out.append(new.alias(name))
    kept = [c for c in df.columns if c not in col]
    return all_rows.select(*kept, *out, "_slice_side").filter("_slice_side = 0").drop("_slice_side")


def moving(df: DataFrame, keys: Sequence[str], slice_: str, order: Sequence[str], before: int,
           aggregates: Mapping[str, Column]) -> DataFrame:
    """``df`` and the ``aggregates`` (functions of its columns, such as ``F.avg("x")``) over each row and the
    ``before`` rows in front of it. Every slice also receives the last ``before`` rows of those before it."""
    row = F.struct(*[F.col(c) for c in df.columns])
    from_end = F.row_number().over(Window.partitionBy(*keys, slice_).orderBy(*[F.col(c).desc_nulls_last() for c in order]))
    tail = df.select(*keys, slice_, from_end.alias("_back"), row.alias("_row")).filter(F.col("_back") <= before)
    tails = tail.groupBy(*keys, slice_).agg(
        F.sort_array(F.collect_list(F.struct((-F.col("_back")).alias("at"), F.col("_row").alias("row")))).alias("_tail"))
    along = Window.partitionBy(*keys).orderBy(slice_).rowsBetween(-before, -1)  # a slice has a row at least
    earlier = tails.select(F.col(slice_).alias("_to"), F.flatten(F.collect_list("_tail").over(along)).alias("_rows"))
    latest = F.slice("_rows", F.greatest(F.size("_rows") - before, F.lit(0)) + 1, before)
    halo = earlier.select("_to", F.explode(latest).alias("_e")).select(
        *[F.col("_to" if c == slice_ else f"_e.row.{c}").alias(c) for c in df.columns], F.lit(True).alias("_halo"))
    both = df.withColumn("_halo", F.lit(False)).unionByName(halo)
    # rows from earlier slices come first in the order as well
    frame = Window.partitionBy(*keys, slice_).orderBy(F.col("_halo").desc(), *order).rowsBetween(-before, 0)
    return both.select(*df.columns, *[a.over(frame).alias(n) for n, a in aggregates.items()], "_halo").filter(
        "NOT _halo").drop("_halo")

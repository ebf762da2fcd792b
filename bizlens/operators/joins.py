"""Join shapes Spark has no single operator for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A block of level l is 2**(BITS * l) microseconds long; 15 levels reach from year 1 to 9999.
BITS, LEVELS = 4, 15


def _micros(column: Column, kind: T.DataType) -> Column:
    """Microseconds since year 1 of a date, a zone-less or a zoned timestamp, whatever the session's zone."""
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column) + F.lit(719_162 * 86_400_000_000)
    days = F.datediff(column.cast("date"), F.lit("0001-01-01").cast("date")).cast("bigint")
    if isinstance(kind, T.DateType):
        return days * 86_400_000_000
    second = (F.extract(F.lit("SECOND"), column) * 1_000_000).cast("bigint")
    return days * 86_400_000_000 + (F.hour(column) * 60 + F.minute(column)).cast("bigint") * 60_000_000 + second


def _blocks(first: Column, last: Column) -> Column:
    """[(level, block)]: the largest blocks that make up the microseconds ``first`` to ``last``, at most 30 a level."""
    inside = []  # the whole blocks of each level: from (inclusive), to (exclusive)
    for level in range(LEVELS + 1):
        size = 1 << (BITS * level)
        inside.append((F.shiftright(first + (size - 1), BITS * level), F.shiftright(last + 1, BITS * level)))
    parts = []
    for level in range(LEVELS):
        (a, b), (up_a, up_b) = inside[level], inside[level + 1]
        some = up_a < up_b  # what blocks of the next level cover is left out
        for x, y in ((a, F.when(some, up_a * (1 << BITS)).otherwise(b)), (up_b * (1 << BITS), F.when(some, b))):
            blocks = F.transform(F.sequence(x, y - 1), lambda k: F.struct(F.lit(level).alias("level"), k.alias("block")))
            parts.append(F.when(x < y, blocks).otherwise(F.array().cast("array<struct<level:int,block:bigint>>")))
    return F.concat(*parts)


def point_in_interval_join(facts: DataFrame, ts: str, intervals: DataFrame, start: str, end: str,
                           how: str = "left") -> DataFrame:
    """``facts JOIN intervals ON facts.ts BETWEEN start AND end``, ``how`` inner or left.

    An interval is cut into the few largest aligned blocks of time that make it
    up: a second or a century, it has at most 30 blocks of each length. A point
    lies in one block of each length, so distinct points probe one key for every
    length that occurs, and each match is found in exactly one way: an equi-join
    that Spark broadcasts or shuffles as the sizes are, and whose keys are as
    fine as the intervals. The matches then join the facts on the point itself.
    A fact matching several intervals is repeated once per interval.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how: {how}")
    first, last = (_micros(F.col(c), intervals.schema[c].dataType) for c in (start, end))
    pieces = intervals.select(F.struct(*intervals.columns).alias("_interval"), first.alias("_a"), last.alias("_b"))
    pieces = pieces.filter("_a <= _b").select("_interval", F.explode(_blocks(F.col("_a"), F.col("_b"))).alias("_p")).select(
        "_interval", F.col("_p.level").alias("_level"), F.col("_p.block").alias("_block"))
    levels = pieces.select(F.sort_array(F.collect_set("_level"))).scalar()  # 15 at most
    points = facts.select(F.col(ts).alias("_point")).filter("_point IS NOT NULL").distinct().withColumn(
        "_at", _micros(F.col("_point"), facts.schema[ts].dataType))
    shift = F.expr(f"transform(_levels, l -> struct(l as level, shiftright(_at, {BITS} * l) as block))")
    probes = points.withColumn("_levels", levels).select("_point", F.explode(shift).alias("_p"))
    matches = probes.join(pieces, (F.col("_p.level") == F.col("_level")) & (F.col("_p.block") == F.col("_block"))).select(
        "_point", "_interval")
    joined = facts.join(matches, facts[ts] == F.col("_point"), how)
    return joined.select(*[facts[c] for c in facts.columns], *[F.col(f"_interval.{c}").alias(c) for c in intervals.columns])


def not_in(df: DataFrame, column: str, values: DataFrame, value: str | None = None, by: Sequence[str] = ()) -> DataFrame:
    """The rows of ``df`` for which ``column NOT IN (SELECT value FROM values)`` is true, in SQL's three-valued
    logic; with ``by``, among the ``values`` that have the same ``by`` columns (NULL matches NULL).

    Nothing is NOT IN a list that holds a NULL; everything, a NULL too, is NOT IN an empty list; else a row stays
    if its value is not NULL and not in the list. The list's size and NULLs are counted (a row, or one per ``by``),
    and the rest is a shuffled anti-join: the list may be of any size.
    """
    value = value or column
    listed = values.select(*[F.col(c).alias(f"_by{k}") for k, c in enumerate(by)], F.col(value).alias("_listed"))
    same = F.lit(True)
    for k, c in enumerate(by):
        same = same & df[c].eqNullSafe(F.col(f"_by{k}"))
    counted = listed.groupBy(*[f"_by{k}" for k in range(len(by))]).agg(
        F.count(F.lit(1)).alias("_size"), F.count("_listed").alias("_known"))
    known = listed.filter("_listed IS NOT NULL").distinct()
    rest = df.join(known, same & (df[column] == F.col("_listed")), "left_anti")
    if by:
        rest = rest.join(counted, same, "left")
        size, nulls = F.coalesce("_size", F.lit(0)), F.col("_size") - F.col("_known")
    else:
        size, nulls = counted.select("_size").scalar(), counted.select(F.col("_size") - F.col("_known")).scalar()
    return rest.filter((size == 0) | ((nulls == 0) & F.col(column).isNotNull())).select(*df.columns)

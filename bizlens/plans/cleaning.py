"""Cleaning steps: dirty text -> typed columns, as new DataFrames (no in-place
UPDATE / ALTER). All projections; Catalyst collapses them into one Project."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bizlens.functions.dates import parse_short_date, week_of_month
from bizlens.functions.numeric import div, rounded
from bizlens.functions.text import null_markers, strip_units
from bizlens.sources import dimensions as dims


def inspect_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct spellings of one column (NULL included)."""
    return df.select(column).distinct()


def clean_orders(orders_raw: DataFrame, list_cols=("exclusions", "extras")) -> DataFrame:
    """Both null spellings ('null', '') of the list columns become NULL."""
    return orders_raw.withColumns({c: null_markers(c) for c in list_cols})


def clean_deliveries(deliveries_raw: DataFrame, distance_scale: int = 2, carry: Sequence[str] = ()) -> DataFrame:
    """Strip unit suffixes, null spellings -> NULL, then cast to typed columns.

    ``carry`` names further columns to keep. Casts use ``try_cast`` so a value that still does not parse becomes NULL
    instead of failing the job (ANSI casts raise on bad text).
    """
    d = deliveries_raw
    distance = null_markers(strip_units("distance", ["km"]), ["null"])
    duration = null_markers(strip_units("duration", ["minutes", "mins", "minute"]), ["null"])
    return d.select(
        "order_id",
        "runner_id",
        # zone-less text -> TIMESTAMP_NTZ directly (parsing in the session zone
        # would move wall-clock times that fall into a daylight-saving gap)
        F.trim(null_markers("pickup_time", ["null"])).try_cast("timestamp_ntz").alias("pickup_time"),
        F.trim(distance).try_cast(f"decimal(10,{distance_scale})").alias("distance"),
        F.trim(duration).try_cast("int").alias("duration"),
        null_markers("cancellation").alias("cancellation"),
        *carry,
    )


def store_weekly_sales(weekly_raw: DataFrame, name: str = "clean_weekly_sales", again: bool = True) -> DataFrame:
    """``CREATE TABLE clean_weekly_sales AS``: the other period jobs read the stored table, which is
    written anew when the files it was made from have changed (or ``again``)."""
    from bizlens.sources import sinks

    return sinks.stored(clean_weekly_sales(weekly_raw), name, again)


def clean_weekly_sales(weekly_raw: DataFrame, date_format: str = "d/M/yy",
                       week_number: str = "month") -> DataFrame:
    """Typed weekly sales with calendar fields, decoded segment and average.

    ``week_number='month'`` keeps the week-of-month reading (days 1-7 -> 1);
    ``'year'`` numbers weeks from the 1st of January instead.
    """
    seg = F.when(F.col("segment").isNull() | (F.col("segment") == "null"), F.lit(dims.UNKNOWN)).otherwise(
        F.col("segment"))
    base = weekly_raw.select(
        parse_short_date("week_date", date_format).alias("dates_week"),
        "region", "platform", seg.alias("segment"), "customer_type", "transactions", "sales",
    )
    last = F.right(F.col("segment"), F.lit(1))
    first = F.left(F.col("segment"), F.lit(1))
    age = None
    for k, v in dims.AGE_BANDS.items():
        age = F.when(last == k, v) if age is None else age.when(last == k, v)
    demo = None
    for k, v in dims.DEMOGRAPHICS.items():
        demo = F.when(first == k, v) if demo is None else demo.when(first == k, v)
    wk = week_of_month("dates_week") if week_number == "month" else (
        ((F.dayofyear("dates_week") - 1) / 7).cast("int") + 1)
    return base.select(
        "*",
        wk.alias("week_number"),
        F.weekofyear("dates_week").alias("tot_week_number"),
        F.month("dates_week").alias("month_number"),
        F.year("dates_week").alias("calendar_year"),
        age.otherwise(F.col("segment")).alias("age_band"),
        demo.otherwise(F.col("segment")).alias("demographic"),
        rounded(div(F.col("sales"), F.col("transactions")), 2).alias("avg_transaction"),
    )

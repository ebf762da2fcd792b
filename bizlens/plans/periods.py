"""Retail weekly sales: exploration, shares and before / after comparisons.

Input: the cleaned weekly table of :func:`bizlens.plans.cleaning.clean_weekly_sales`.
Every comparison is one filtered aggregate with two conditional sums (the
"join of two grouped sides" of the question becomes a single pass).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bizlens.functions.dates import day_name, month_name
from bizlens.functions.numeric import div, rounded
from bizlens.operators.aggregate import sum_if
from bizlens.operators.joins import not_in
from bizlens.operators.ranking import in_order, rank_globally


def _share(part: str, total: str) -> Column:
    """round(part / total, 2) * 100 -- whole percents, as written."""
    return (F.round(div(F.col(part), F.col(total)).cast("decimal(38,12)"), 2) * 100).cast("double")


def _pct_change(after: str, before: str) -> Column:
    return rounded((div(F.col(after), F.col(before)) - 1) * 100, 2)


def weekday_used(clean: DataFrame) -> DataFrame:
    return clean.select(day_name("dates_week").alias("wkday"))


def missing_weeks(clean: DataFrame, step_days: int = 7, by: Sequence[str] = ()) -> DataFrame:
    """Weekly dates between the first and last observed week that have no rows;
    with ``by``, those without rows of each combination of the columns.

    The series of each combination is exploded from the first and last week;
    the weeks ``NOT IN`` the observed ones stay, so a combination with a row that
    has no date has no missing week, as written (NULL combinations match).
    """
    seen = clean.select(*by, "dates_week").distinct()
    step = F.expr(f"INTERVAL {step_days} DAYS")
    if by:
        bounds = clean.select(F.struct(F.min("dates_week").alias("a"), F.max("dates_week").alias("b"))).scalar()
        series = seen.select(*by).distinct().select(*by, F.explode(F.sequence(bounds["a"], bounds["b"], step)).alias("dates_week"))
    else:
        bounds = seen.agg(F.min("dates_week").alias("_a"), F.max("dates_week").alias("_b"))
        series = bounds.select(F.explode(F.sequence("_a", "_b", step)).alias("dates_week"))
    return in_order(not_in(series, "dates_week", seen, by=by), "dates_week", *by)


def transactions_by_year(clean: DataFrame) -> DataFrame:
    return clean.groupBy(F.year("dates_week").alias("years")).agg(
        F.sum("transactions").cast("bigint").alias("total_transactions"))


def transactions_by_region_month(clean: DataFrame, metric: str = "transactions") -> DataFrame:
    out = "total_transactions" if metric == "transactions" else "total_sales"
    return clean.groupBy(F.month("dates_week").alias("monthly"), "region").agg(
        F.sum(metric).cast("bigint").alias(out))


def platform_share_by_month(clean: DataFrame) -> DataFrame:
    p = F.col("platform")
    agg = clean.groupBy(month_name("dates_week", "lower").alias("months")).agg(
        sum_if(p == "Retail", F.col("sales"), None).alias("_r"),
        sum_if(p == "Shopify", F.col("sales"), None).alias("_s"),
        F.sum("sales").alias("_t"))
    return agg.select("months", _share("_r", "_t").alias("retail_percent"), _share("_s", "_t").alias("shopify_percent"))


def demographic_share_by_year(clean: DataFrame) -> DataFrame:
    d = F.col("demographic")
    agg = clean.groupBy(F.year("dates_week").alias("years")).agg(
        sum_if(d == "Couples", F.col("sales"), None).alias("_c"),
        sum_if(d == "Families", F.col("sales"), None).alias("_f"),
        sum_if(d == "Unknown", F.col("sales"), None).alias("_u"),
        F.sum("sales").alias("_t"))
    return agg.select("years", _share("_c", "_t").alias("couples_percent"),
                      _share("_f", "_t").alias("families_percent"), _share("_u", "_t").alias("unknown_percent"))


def segment_rank(clean: DataFrame, platform: str | None = None) -> DataFrame:
    """Sales per (age band, demographic) and their rank (``cumulative_sales``
    is a rank, as written)."""
    src = clean if platform is None else clean.filter(F.col("platform") == platform)
    agg = src.groupBy("age_band", "demographic").agg(F.sum("sales").cast("bigint").alias("total_sales"))
    return rank_globally(agg, "total_sales", "cumulative_sales", descending=True)


def avg_txn_correct_vs_naive(clean: DataFrame) -> DataFrame:
    return clean.groupBy("calendar_year", "platform").agg(
        rounded(div(F.sum("sales"), F.sum("transactions")), 1).alias("correct_avg"),
        rounded(div(F.sum(F.col("avg_transaction").cast("decimal(20,2)")), F.count("avg_transaction")), 1).alias("incorrect_avg"))


def before_after(clean: DataFrame, pivot: str, weeks: int) -> DataFrame:
    """Sales in the ``weeks`` weeks before vs from the pivot week on.

    Week offset = round((date - pivot) / 7) + 1, so the pivot's own week is
    the first "after" week.
    """
    off = (F.round(F.datediff("dates_week", F.lit(pivot).cast("date")).cast("decimal(12,1)") / 7, 0) + 1).cast("int")
    s = clean.select(off.alias("_w"), "sales").filter(F.col("_w").isin(list(range(1 - weeks, weeks + 1))))
    agg = s.agg(sum_if(F.col("_w").between(1 - weeks, 0), F.col("sales"), None).cast("bigint").alias("previous_dates"),
                sum_if(F.col("_w").between(1, weeks), F.col("sales"), None).cast("bigint").alias("after_dates"))
    return agg.select("previous_dates", "after_dates",
                      (F.col("after_dates") - F.col("previous_dates")).alias("change_effect"),
                      _pct_change("after_dates", "previous_dates").alias("percent_change"))


def compare_periods(clean: DataFrame, dim: str, pivot: str, weeks: int = 12, year: int | None = None) -> DataFrame:
    """Per value of ``dim``: sales of the ``weeks`` ISO weeks before the
    pivot's week vs the ``weeks`` weeks from it on; keys present in both
    periods only. ``year`` restricts to one calendar year."""
    base = dt.date.fromisoformat(pivot).isocalendar()[1]
    wk = F.col("tot_week_number")
    # IN over the week numbers rather than BETWEEN: Catalyst pushes this filter
    # down to the fact rows, and IN evaluates the (parsed) week once per row.
    src = clean.filter(wk.isin(list(range(base - weeks, base + weeks))))
    if year is not None:
        src = src.filter(F.col("calendar_year") == year)
    agg = src.groupBy(dim).agg(
        sum_if(wk.between(base - weeks, base - 1), F.col("sales"), None).cast("bigint").alias("total_sales_before"),
        sum_if(wk.between(base, base + weeks - 1), F.col("sales"), None).cast("bigint").alias("total_sales_after"))
    both = agg.filter(F.col("total_sales_before").isNotNull() & F.col("total_sales_after").isNotNull())
    return both.select(dim, "total_sales_before", "total_sales_after",
                       (F.col("total_sales_after") - F.col("total_sales_before")).alias("change_effect"),
                       _pct_change("total_sales_after", "total_sales_before").alias("percent_change"))

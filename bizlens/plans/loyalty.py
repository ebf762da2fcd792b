"""Restaurant loyalty: spend, visits, first / favourite items, points, ranks.

Inputs: ``sales(customer_id, order_date, product_id)``, ``members(customer_id,
join_date)`` and ``menu(product_id, product_name, price)``. Sales that carry the
name and price already (``bindings.v_sales`` does) need no menu.

What is asked per customer comes from aggregates; where the answer is per sale,
the aggregate joins back to the sales, so that Spark can split a hot customer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bizlens.operators.ranking import first_by, ranks_of_values, rows_at_extreme, top_k


def _named(sales: DataFrame, menu: DataFrame | None, how: str = "inner") -> DataFrame:
    return sales if menu is None else sales.join(menu, "product_id", how)


def spend_per_customer(sales: DataFrame, menu: DataFrame | None = None) -> DataFrame:
    return _named(sales, menu).groupBy("customer_id").agg(F.sum("price").cast("bigint").alias("total_sales"))


def visit_days(sales: DataFrame) -> DataFrame:
    return sales.groupBy("customer_id").agg(F.countDistinct("order_date").alias("days_visited"))


def first_item(sales: DataFrame, menu: DataFrame | None = None) -> DataFrame:
    """First purchase per customer; ties on the date broken by product_id."""
    first = first_by(_named(sales, menu), ["customer_id"], ["order_date", "product_id"], ["product_name"])
    return first.select("customer_id", "order_date", "product_name")


def top_item(sales: DataFrame, menu: DataFrame | None = None, n: int = 1) -> DataFrame:
    counts = _named(sales, menu).groupBy("product_name").agg(F.count("product_id").alias("purchases"))
    return top_k(counts, [F.col("purchases").desc(), F.col("product_name").asc()], n)


def favourite_item(sales: DataFrame, menu: DataFrame | None = None) -> DataFrame:
    """Most bought product(s) per customer, ties kept (DENSE_RANK = 1); the
    window runs over one row per (customer, product)."""
    counts = _named(sales, menu).groupBy("customer_id", "product_name").agg(F.count("product_id").alias("product_count"))
    rank = F.dense_rank().over(Window.partitionBy("customer_id").orderBy(F.col("product_count").desc()))
    return counts.withColumn("_r", rank).filter("_r = 1").drop("_r")


def _member_rows(sales: DataFrame, members: DataFrame, on_or_after: bool) -> DataFrame:
    """Sales of members, on/after or before their join date."""
    cond = F.col("order_date") >= F.col("join_date") if on_or_after else F.col("order_date") < F.col("join_date")
    return sales.join(members, "customer_id").filter(cond)


def first_item_as_member(sales: DataFrame, members: DataFrame, menu: DataFrame | None = None) -> DataFrame:
    rows = _member_rows(_named(sales, menu), members, True).select("customer_id", "order_date", "product_name")
    return rows_at_extreme(rows, ["customer_id"], "order_date", "min").select("customer_id", "product_name")


def last_item_before_member(sales: DataFrame, members: DataFrame, menu: DataFrame | None = None) -> DataFrame:
    rows = _member_rows(_named(sales, menu), members, False).select("customer_id", "order_date", "product_name")
    return rows_at_extreme(rows, ["customer_id"], "order_date", "max").select("customer_id", "product_name")


def spend_before_member(sales: DataFrame, members: DataFrame, menu: DataFrame | None = None) -> DataFrame:
    return _member_rows(_named(sales, menu), members, False).groupBy("customer_id").agg(
        F.count("product_name").alias("total_items"), F.sum("price").cast("bigint").alias("amount_spent"))


def _points(price: Column, product_id: Column, bonus_ids: Sequence[int], factor: int, base: int = 10) -> Column:
    return F.when(product_id.isin(*bonus_ids), price * (base * factor)).otherwise(price * base)


def points_by_item(sales: DataFrame, menu: DataFrame | None = None, bonus_ids: Sequence[int] = (1,), factor: int = 2,
                   by_item: bool = True) -> DataFrame:
    """Points per customer and product (as asked per customer when ``by_item=False``)."""
    points = _points(F.col("price"), F.col("product_id"), bonus_ids, factor)
    keys = ["customer_id", "product_id"] if by_item else ["customer_id"]
    return _named(sales, menu).groupBy(*keys).agg(F.sum(points).cast("bigint").alias("total_points"))


def points_with_welcome_week(sales: DataFrame, members: DataFrame, menu: DataFrame | None, date_from: str,
                             date_to: str, bonus_ids: Sequence[int] = (1,), welcome_days: int = 6) -> DataFrame:
    """Double points on everything from the join date to join date + ``welcome_days``;
    only sales from ``date_from`` to ``date_to`` count."""
    in_range = F.col("order_date").between(F.lit(date_from).cast("date"), F.lit(date_to).cast("date"))
    rows = _named(sales.filter(in_range), menu).join(members, "customer_id")
    in_week = F.col("order_date").between(F.col("join_date"), F.date_add("join_date", welcome_days))
    points = F.when(in_week, F.col("price") * 20).otherwise(_points(F.col("price"), F.col("product_id"), bonus_ids, 2))
    return rows.groupBy("customer_id").agg(F.sum(points).cast("bigint").alias("total_points"))


def _member_flag() -> Column:
    return F.when(F.col("order_date") >= F.col("join_date"), "Y").otherwise("N").alias("member")


def sales_with_member_flag(sales: DataFrame, members: DataFrame, menu: DataFrame | None = None) -> DataFrame:
    """Every sale with product, price and member flag (one row per sale)."""
    rows = _named(sales, menu, "left").join(members, "customer_id", "left")
    return rows.select("customer_id", "order_date", "product_name", "price", _member_flag())


def member_order_rank(sales: DataFrame, members: DataFrame, menu: DataFrame | None = None,
                      keep_non_members: bool = False) -> DataFrame:
    """Rank of each member-period purchase by date; NULL outside membership.

    The rank is worked out per (customer, flag, date), from the counts of the
    dates, and joined back to the sales. ``keep_non_members`` switches the
    member join to a left join.
    """
    how = "left" if keep_non_members else "inner"
    rows = _named(sales, menu).join(members, "customer_id", how).select(
        "customer_id", "order_date", "product_name", "price", _member_flag())
    ranks = ranks_of_values(rows.filter("member = 'Y'"), ["customer_id"], "order_date", "ranking")
    return rows.join(ranks.withColumn("member", F.lit("Y")), ["customer_id", "member", "order_date"], "left").select(
        "customer_id", "order_date", "product_name", "price", "member", F.col("ranking").cast("bigint").alias("ranking"))

"""Registry: every job bound to the testdata views, one entry per name.

``QUERIES[name](spark, sf_dir)`` returns the job's DataFrame over the whole
testdata tables in ``sf_dir``; ``oracle_sql()[name]`` is the DuckDB SQL of the
same question.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bizlens.operators.ranking import in_order
from bizlens.plans import cleaning, funnel, journeys, ledger, lists, loyalty, orders, periods
from bizlens.sources import bindings as b

Query = Callable[[SparkSession, str], DataFrame]

# The job's period: sales from the first day to the last count, earlier and later ones don't.
POINTS_FROM, POINTS_TO = "1996-01-01", "1999-06-30"


# The order of the results of jobs that have one ("-": descending). Jobs that limit, or whose order is a
# column that isn't shown, sort themselves; those with a row per fact are sorted by ``python -m bizlens run --sort``.
ORDER: dict[str, tuple[str, ...]] = {
    "spend_per_customer": ("customer_id",), "visit_days": ("customer_id",), "spend_before_member": ("customer_id",),
    "points_by_item": ("customer_id", "product_id"), "points_with_welcome_week": ("customer_id",),
    "delivered_by_type": ("pizza_name",), "type_pivot_by_customer": ("customer_id",),
    "changes_by_customer": ("customer_id",), "orders_by_hour": ("hour_day",),
    "orders_by_weekday": ("-day_of_the_week",), "signups_by_week": ("week",), "avg_pickup_minutes": ("runner_id",),
    "prep_time_by_size": ("pizza_order_count",), "avg_distance": ("customer_id",), "success_rate": ("runner_id",),
    "ingredient_totals": ("-total_ingredients",), "nodes_per_region": ("region_name",),
    "customers_per_region": ("region_name",), "transactions_by_region_month": ("region", "monthly"),
    "demographic_share_by_year": ("years",), "avg_txn_correct_vs_naive": ("calendar_year", "platform"),
    "events_by_type": ("-number_of_event",),
}
ROW_ORDER: dict[str, tuple[str, ...]] = {
    "sales_with_member_flag": ("customer_id", "order_date", "product_name"),
    "member_order_rank": ("customer_id", "order_date", "product_name"),
    "speed_by_delivery": ("runner_id", "order_id", "distance_in_km", "duration_in_minutes"),
    "order_item_label": ("order_id", "line_number"), "order_ingredient_list": ("order_id", "line_number"),
    "monthly_net": ("customer_id",), "running_month_balance": ("customer_id", "month_"),
}


def _loyalty() -> dict[str, Query]:
    def S(sp, d):
        return b.v_sales(sp, d)

    def B(sp, d):
        return b.v_members(sp, d)

    return {
        "spend_per_customer": lambda sp, d: loyalty.spend_per_customer(S(sp, d)),
        "visit_days": lambda sp, d: loyalty.visit_days(S(sp, d)),
        "first_item": lambda sp, d: loyalty.first_item(S(sp, d)),
        "top_item": lambda sp, d: loyalty.top_item(S(sp, d)),
        "favourite_item": lambda sp, d: loyalty.favourite_item(S(sp, d)),
        "first_item_as_member": lambda sp, d: loyalty.first_item_as_member(S(sp, d), B(sp, d)),
        "last_item_before_member": lambda sp, d: loyalty.last_item_before_member(S(sp, d), B(sp, d)),
        "spend_before_member": lambda sp, d: loyalty.spend_before_member(S(sp, d), B(sp, d)),
        "points_by_item": lambda sp, d: loyalty.points_by_item(S(sp, d)),
        "points_with_welcome_week": lambda sp, d: loyalty.points_with_welcome_week(
            S(sp, d), B(sp, d), None, POINTS_FROM, POINTS_TO),
        "sales_with_member_flag": lambda sp, d: loyalty.sales_with_member_flag(S(sp, d), B(sp, d)),
        "member_order_rank": lambda sp, d: loyalty.member_order_rank(S(sp, d), B(sp, d)),
    }


PRICES = {1: 12, 2: 10}
PIZZA_COLUMNS = {1: "carnivore", 2: "garden"}


def _orders() -> dict[str, Query]:
    from bizlens.sources import dimensions as dims

    def O(sp, d):
        return cleaning.clean_orders(b.v_orders_raw(sp, d))

    def L(sp, d):  # the lines alone, for jobs that need no column of their order
        return cleaning.clean_orders(b.v_order_lines(sp, d))

    def D(sp, d):
        return cleaning.clean_deliveries(b.v_deliveries_raw(sp, d))

    def N(sp, d):
        return b.v_pizza_names(sp, d)

    def R(sp, d):
        return b.v_pizza_recipes(sp, d)

    def T(sp, d):
        return b.v_toppings(sp, d)

    def clean_deliveries(sp, d):
        return D(sp, d).withColumn("distance", F.col("distance").cast("double"))

    def X(sp, d):  # deliveries with the customer and time of their order
        return cleaning.clean_deliveries(b.v_deliveries_raw(sp, d), carry=["customer_id", "order_time"])

    return {
        "inspect_values": lambda sp, d: cleaning.inspect_values(b.v_order_lines(sp, d), "exclusions"),
        "clean_orders": O,
        "clean_deliveries": clean_deliveries,
        "items_ordered": lambda sp, d: orders.items_ordered(L(sp, d)),
        "unique_orders": lambda sp, d: orders.unique_orders(L(sp, d)),
        "successful_by_runner": lambda sp, d: orders.successful_by_runner(D(sp, d)),
        "delivered_by_type": lambda sp, d: orders.delivered_by_type(L(sp, d), D(sp, d), N(sp, d)),
        "type_pivot_by_customer": lambda sp, d: orders.type_pivot_by_customer(O(sp, d), PIZZA_COLUMNS),
        "largest_delivery": lambda sp, d: orders.largest_delivery(O(sp, d), D(sp, d)),
        "changes_by_customer": lambda sp, d: orders.changes_by_customer(O(sp, d), D(sp, d)),
        "both_changes": lambda sp, d: orders.both_changes(L(sp, d), D(sp, d)),
        "orders_by_hour": lambda sp, d: orders.orders_by_hour(O(sp, d)),
        "orders_by_weekday": lambda sp, d: orders.orders_by_weekday(O(sp, d)),
        "signups_by_week": lambda sp, d: orders.signups_by_week(b.v_runners(sp, d)),
        "avg_pickup_minutes": lambda sp, d: orders.avg_pickup_minutes(O(sp, d), D(sp, d)),
        "prep_time_by_size": lambda sp, d: orders.prep_time_by_size(O(sp, d), D(sp, d)),
        "avg_distance": lambda sp, d: orders.avg_distance(O(sp, d), D(sp, d)),
        "delivery_spread": lambda sp, d: orders.delivery_spread(L(sp, d), D(sp, d)),
        "speed_by_delivery": lambda sp, d: orders.speed_by_delivery(D(sp, d)),
        "success_rate": lambda sp, d: orders.success_rate(D(sp, d)),
        "standard_ingredients": lambda sp, d: lists.standard_ingredients(R(sp, d), N(sp, d), T(sp, d), L(sp, d)),
        "top_extra": lambda sp, d: lists.top_extra(L(sp, d), T(sp, d)),
        "top_exclusion": lambda sp, d: lists.top_exclusion(L(sp, d), T(sp, d)),
        "order_item_label": lambda sp, d: lists.order_item_label(L(sp, d), N(sp, d), T(sp, d)),
        "order_ingredient_list": lambda sp, d: lists.order_ingredient_list(L(sp, d), N(sp, d), R(sp, d), T(sp, d)),
        "ingredient_totals": lambda sp, d: lists.ingredient_totals(L(sp, d), D(sp, d), R(sp, d), T(sp, d)),
        "revenue": lambda sp, d: orders.revenue(L(sp, d), D(sp, d), PRICES),
        "revenue_with_extras": lambda sp, d: orders.revenue_with_extras(L(sp, d), D(sp, d), PRICES, 1),
        "ratings_table": lambda sp, d: orders.ratings_table(X(sp, d)),
        "delivery_report": lambda sp, d: orders.delivery_report(L(sp, d), X(sp, d)),
        "net_profit": lambda sp, d: orders.net_profit(L(sp, d), D(sp, d), PRICES, "0.30"),
        "extend_menu": lambda sp, d: lists.extend_menu(N(sp, d), R(sp, d), L(sp, d), *dims.NEW_PIZZA),
    }


def _ledger() -> dict[str, Query]:
    def N(sp, d):
        return b.v_customer_nodes(sp, d)

    def R(sp, d):
        return b.v_regions(sp, d)

    def T(sp, d):
        return b.v_customer_transactions(sp, d)

    return {
        "customer_journey": lambda sp, d: journeys.customer_journey(b.v_subscriptions(sp, d), b.v_plans(sp, d)),
        "unique_nodes": lambda sp, d: ledger.unique_nodes(N(sp, d)),
        "nodes_per_region": lambda sp, d: ledger.nodes_per_region(N(sp, d), R(sp, d)),
        "customers_per_region": lambda sp, d: ledger.customers_per_region(N(sp, d), R(sp, d)),
        "avg_reallocation_days": lambda sp, d: ledger.avg_reallocation_days(N(sp, d)),
        "reallocation_percentiles": lambda sp, d: ledger.reallocation_percentiles(N(sp, d), R(sp, d)),
        "txn_summary": lambda sp, d: ledger.txn_summary(T(sp, d)),
        "avg_deposits": lambda sp, d: ledger.avg_deposits(T(sp, d)),
        "active_customers_by_month": lambda sp, d: ledger.active_customers_by_month(T(sp, d)),
        "monthly_net": lambda sp, d: ledger.monthly_net(T(sp, d)),
        "running_month_balance": lambda sp, d: ledger.running_month_balance(T(sp, d)),
        "month_calendar_balance": lambda sp, d: ledger.month_calendar_balance(T(sp, d)),
        "growth_share": lambda sp, d: ledger.growth_share(T(sp, d)),
        "data_allocation": lambda sp, d: ledger.data_allocation(T(sp, d)),
        "running_balance": lambda sp, d: ledger.running_balance(T(sp, d)),
        "balance_statistics": lambda sp, d: ledger.balance_statistics(T(sp, d)),
        "allocation_by_month_end": lambda sp, d: ledger.allocation_by_month_end(T(sp, d)),
        "allocation_in_real_time": lambda sp, d: ledger.allocation_in_real_time(T(sp, d)),
    }


PIVOT = "1998-06-15"
PIVOT_YEAR = 1998


def _periods() -> dict[str, Query]:
    def C(sp, d):
        return cleaning.store_weekly_sales(b.v_weekly_sales_raw(sp, d), again=False)

    out: dict[str, Query] = {
        "clean_weekly_sales": lambda sp, d: cleaning.store_weekly_sales(b.v_weekly_sales_raw(sp, d)),
        "weekday_used": lambda sp, d: periods.weekday_used(C(sp, d)),
        "missing_weeks": lambda sp, d: periods.missing_weeks(
            C(sp, d), by=("region", "platform", "segment", "customer_type")),
        "transactions_by_year": lambda sp, d: periods.transactions_by_year(C(sp, d)),
        "transactions_by_region_month": lambda sp, d: periods.transactions_by_region_month(C(sp, d)),
        "platform_share_by_month": lambda sp, d: periods.platform_share_by_month(C(sp, d)),
        "demographic_share_by_year": lambda sp, d: periods.demographic_share_by_year(C(sp, d)),
        "segment_rank": lambda sp, d: periods.segment_rank(C(sp, d)),
        "avg_txn_correct_vs_naive": lambda sp, d: periods.avg_txn_correct_vs_naive(C(sp, d)),
        "before_after_4w": lambda sp, d: periods.before_after(C(sp, d), PIVOT, 4),
        "before_after_12w": lambda sp, d: periods.before_after(C(sp, d), PIVOT, 12),
        "before_after_by_year": lambda sp, d: periods.compare_periods(C(sp, d), "calendar_year", PIVOT, 12),
    }
    for dim in ("region", "platform", "age_band", "demographic", "customer_type"):
        out[f"before_after_by_{dim}"] = (
            lambda sp, d, _dim=dim: periods.compare_periods(C(sp, d), _dim, PIVOT, 12, PIVOT_YEAR))
    return out


def _funnel() -> dict[str, Query]:
    def E(sp, d):
        return b.v_events(sp, d, with_sequence=False)

    def U(sp, d):
        return b.v_users(sp, d)

    def T(sp, d):
        return b.v_event_identifier(sp, d)

    def P(sp, d):
        return b.v_page_hierarchy(sp, d)

    def F_(sp, d):
        return funnel.product_funnel(E(sp, d), T(sp, d), P(sp, d))

    return {
        "user_count": lambda sp, d: funnel.user_count(U(sp, d)),
        "avg_cookies": lambda sp, d: funnel.avg_cookies(U(sp, d)),
        "visits_by_month": lambda sp, d: funnel.visits_by_month(U(sp, d), E(sp, d)),
        "events_by_type": lambda sp, d: funnel.events_by_type(E(sp, d), T(sp, d)),
        "purchase_visit_pct": lambda sp, d: funnel.purchase_visit_pct(E(sp, d), T(sp, d)),
        "checkout_no_purchase_pct": lambda sp, d: funnel.checkout_no_purchase_pct(E(sp, d), T(sp, d), P(sp, d)),
        "top_pages": lambda sp, d: funnel.top_pages(E(sp, d), T(sp, d), P(sp, d)),
        "category_views_adds": lambda sp, d: funnel.category_views_adds(E(sp, d), T(sp, d), P(sp, d)),
        "top_purchased_products": lambda sp, d: funnel.top_purchased_products(E(sp, d), T(sp, d), P(sp, d)),
        "product_funnel": lambda sp, d: funnel.store_product_funnel(E(sp, d), T(sp, d), P(sp, d)),
        "category_funnel": lambda sp, d: funnel.category_funnel(E(sp, d), T(sp, d), P(sp, d)),
        "funnel_leaders": lambda sp, d: funnel.funnel_leaders(F_(sp, d)),
        "most_abandoned": lambda sp, d: funnel.most_abandoned(F_(sp, d)),
        "best_view_to_purchase": lambda sp, d: funnel.best_view_to_purchase(F_(sp, d)),
        "avg_view_to_cart": lambda sp, d: funnel.avg_view_to_cart(F_(sp, d)),
        "avg_cart_to_purchase": lambda sp, d: funnel.avg_cart_to_purchase(F_(sp, d)),
        # the binding numbers events per visit by (event_time, event_id): order by those directly
        "visit_campaigns": lambda sp, d: funnel.store_visit_campaigns(
            E(sp, d), U(sp, d), T(sp, d), P(sp, d), b.v_campaign_identifier(sp, d),
            order_by=("event_time", "event_id")),
    }


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    for part in (_loyalty, _orders, _ledger, _periods, _funnel):
        out.update(part())
    for name, keys in ORDER.items():
        out[name] = lambda sp, d, _job=out[name], _keys=keys: in_order(_job(sp, d), *_keys)
    return out


def sorted_rows(name: str, df: DataFrame) -> DataFrame:
    """The result of a job with a row per fact, in its order."""
    return in_order(df, *ROW_ORDER[name]) if name in ROW_ORDER else df


def oracle_sql() -> dict[str, str]:
    from bizlens.oracle import loyalty as o1
    from bizlens.oracle import ledger as o4
    from bizlens.oracle import orders as o2
    from bizlens.oracle import funnel as o6
    from bizlens.oracle import periods as o5

    out: dict[str, str] = {}
    for mod in (o1, o2, o4, o5, o6):
        out.update(mod.SQL)
    return out

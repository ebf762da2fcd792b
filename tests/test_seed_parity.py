"""Parity with the reference's own questions on its published seed rows.

Expected values are the hand-worked answers of FIXTURES.md section 2.
"""

import datetime as dt

import pytest

from bizlens.plans import cleaning, journeys, lists, loyalty, orders
from bizlens.sources.dimensions import literal_table
from tests.conftest import rows

D, T = dt.date, dt.datetime

# ---------------------------------------------------------------------------
# The published seed rows of case studies 1-3, in their order.
# ---------------------------------------------------------------------------
SALES = [("A", "2021-01-01", 1), ("A", "2021-01-01", 2), ("A", "2021-01-07", 2), ("A", "2021-01-10", 3),
         ("A", "2021-01-11", 3), ("A", "2021-01-11", 3), ("B", "2021-01-01", 2), ("B", "2021-01-02", 2),
         ("B", "2021-01-04", 1), ("B", "2021-01-11", 1), ("B", "2021-01-16", 3), ("B", "2021-02-01", 3),
         ("C", "2021-01-01", 3), ("C", "2021-01-01", 3), ("C", "2021-01-07", 3)]
MENU = [(1, "sushi", 10), (2, "curry", 15), (3, "ramen", 12)]
MEMBERS = [("A", "2021-01-07"), ("B", "2021-01-09")]

RUNNERS = [(1, "2021-01-01"), (2, "2021-01-03"), (3, "2021-01-08"), (4, "2021-01-15")]
CUSTOMER_ORDERS = [
    (1, 101, 1, "", "", "2020-01-01 18:05:02"), (2, 101, 1, "", "", "2020-01-01 19:00:52"),
    (3, 102, 1, "", "", "2020-01-02 23:51:23"), (3, 102, 2, "", None, "2020-01-02 23:51:23"),
    (4, 103, 1, "4", "", "2020-01-04 13:23:46"), (4, 103, 1, "4", "", "2020-01-04 13:23:46"),
    (4, 103, 2, "4", "", "2020-01-04 13:23:46"), (5, 104, 1, "null", "1", "2020-01-08 21:00:29"),
    (6, 101, 2, "null", "null", "2020-01-08 21:03:13"), (7, 105, 2, "null", "1", "2020-01-08 21:20:29"),
    (8, 102, 1, "null", "null", "2020-01-09 23:54:33"), (9, 103, 1, "4", "1, 5", "2020-01-10 11:22:59"),
    (10, 104, 1, "null", "null", "2020-01-11 18:34:49"), (10, 104, 1, "2, 6", "1, 4", "2020-01-11 18:34:49")]
RUNNER_ORDERS = [
    (1, 1, "2020-01-01 18:15:34", "20km", "32 minutes", ""), (2, 1, "2020-01-01 19:10:54", "20km", "27 minutes", ""),
    (3, 1, "2020-01-03 00:12:37", "13.4km", "20 mins", None), (4, 2, "2020-01-04 13:53:03", "23.4", "40", None),
    (5, 3, "2020-01-08 21:10:57", "10", "15", None), (6, 3, "null", "null", "null", "Restaurant Cancellation"),
    (7, 2, "2020-01-08 21:30:45", "25km", "25mins", "null"), (8, 2, "2020-01-10 00:15:02", "23.4 km", "15 minute", "null"),
    (9, 2, "null", "null", "null", "Customer Cancellation"), (10, 1, "2020-01-11 18:50:20", "10km", "10minutes", "null")]
PIZZA_NAMES = [(1, "Meatlovers"), (2, "Vegetarian")]
PIZZA_RECIPES = [(1, "1, 2, 3, 4, 5, 6, 8, 10"), (2, "4, 6, 7, 9, 11, 12")]
TOPPINGS = [(1, "Bacon"), (2, "BBQ Sauce"), (3, "Beef"), (4, "Cheese"), (5, "Chicken"), (6, "Mushrooms"),
            (7, "Onions"), (8, "Pepperoni"), (9, "Peppers"), (10, "Salami"), (11, "Tomatoes"), (12, "Tomato Sauce")]

SUBSCRIPTIONS = [(1, 0, "2020-08-01"), (1, 1, "2020-08-08"), (2, 0, "2020-09-20"), (2, 3, "2020-09-27"),
                 (11, 0, "2020-11-19"), (11, 4, "2020-11-26"), (13, 0, "2020-12-15"), (13, 1, "2020-12-22"),
                 (13, 2, "2021-03-29"), (15, 0, "2020-03-17"), (15, 2, "2020-03-24"), (15, 4, "2020-04-29")]


@pytest.fixture(scope="module")
def loyalty_seed(spark):
    sales = literal_table(spark, SALES, [("customer_id", "STRING"), ("order_date", "DATE"), ("product_id", "INT")])
    menu = literal_table(spark, MENU, [("product_id", "INT"), ("product_name", "STRING"), ("price", "INT")])
    members = literal_table(spark, MEMBERS, [("customer_id", "STRING"), ("join_date", "DATE")])
    return sales, menu, members


def test_case1(loyalty_seed):
    s, m, b = loyalty_seed
    assert rows(loyalty.spend_per_customer(s, m)) == [("A", 76), ("B", 74), ("C", 36)]
    assert rows(loyalty.visit_days(s)) == [("A", 4), ("B", 6), ("C", 2)]
    assert rows(loyalty.first_item(s, m), "customer_id", "product_name") == [("A", "sushi"), ("B", "curry"),
                                                                            ("C", "ramen")]
    assert rows(loyalty.top_item(s, m)) == [("ramen", 8)]
    assert rows(loyalty.favourite_item(s, m)) == [("A", "ramen", 3), ("B", "curry", 2), ("B", "ramen", 2),
                                                  ("B", "sushi", 2), ("C", "ramen", 3)]
    assert rows(loyalty.first_item_as_member(s, b, m)) == [("A", "curry"), ("B", "sushi")]
    assert rows(loyalty.last_item_before_member(s, b, m)) == [("A", "curry"), ("A", "sushi"), ("B", "sushi")]
    assert rows(loyalty.spend_before_member(s, b, m)) == [("A", 2, 25), ("B", 3, 40)]
    assert rows(loyalty.points_by_item(s, m)) == [("A", 1, 200), ("A", 2, 300), ("A", 3, 360), ("B", 1, 400),
                                                  ("B", 2, 300), ("B", 3, 240), ("C", 3, 360)]
    assert rows(loyalty.points_with_welcome_week(s, b, m, "2021-01-01", "2021-01-31")) == [("A", 1370),
                                                                                           ("B", 820)]


@pytest.fixture(scope="module")
def pizza(spark):
    raw = literal_table(spark, [(o, i + 1, 0, 0, c, p, x, e, t) for i, (o, c, p, x, e, t) in enumerate(CUSTOMER_ORDERS)],
                        [("order_id", "BIGINT"), ("line_number", "INT"), ("part_key", "BIGINT"),
                         ("supp_key", "BIGINT"), ("customer_id", "BIGINT"), ("pizza_id", "INT"),
                         ("exclusions", "STRING"), ("extras", "STRING"), ("order_time", "TIMESTAMP_NTZ")])
    draw = literal_table(spark, RUNNER_ORDERS, [("order_id", "BIGINT"), ("runner_id", "INT"),
                                                ("pickup_time", "STRING"), ("distance", "STRING"),
                                                ("duration", "STRING"), ("cancellation", "STRING")])
    names = literal_table(spark, PIZZA_NAMES, [("pizza_id", "INT"), ("pizza_name", "STRING")])
    recipes = literal_table(spark, PIZZA_RECIPES, [("pizza_id", "INT"), ("toppings", "STRING")])
    tops = literal_table(spark, TOPPINGS, [("topping_id", "INT"), ("topping_name", "STRING")])
    runners = literal_table(spark, RUNNERS, [("runner_id", "INT"), ("registration_date", "DATE")])
    return cleaning.clean_orders(raw), cleaning.clean_deliveries(draw), names, recipes, tops, runners


def test_case2_metrics(pizza):
    o, d, names, _, _, runners = pizza
    assert rows(orders.items_ordered(o)) == [(14,)]
    assert rows(orders.unique_orders(o)) == [(10,)]
    assert rows(orders.successful_by_runner(d)) == [(1, 4), (2, 3), (3, 1)]
    assert rows(orders.delivered_by_type(o, d, names)) == [("Meatlovers", 9), ("Vegetarian", 3)]
    assert rows(orders.largest_delivery(o, d)) == [(4, 3)]
    assert rows(orders.both_changes(o, d)) == [(1,)]
    assert rows(orders.signups_by_week(runners)) == [(D(2021, 1, 1), 2), (D(2021, 1, 8), 1), (D(2021, 1, 15), 1)]
    assert rows(orders.avg_pickup_minutes(o, d)) == [(1, 15), (2, 23), (3, 10)]
    assert rows(orders.delivery_spread(o, d)) == [(30,)]
    assert rows(orders.success_rate(d), "runner_id", "success_pct") == [(1, 100), (2, 75), (3, 50)]
    prices = {1: 12, 2: 10}
    assert rows(orders.revenue(o, d, prices)) == [(138,)]
    assert rows(orders.revenue_with_extras(o, d, prices, 1)) == [(142,)]
    assert rows(orders.net_profit(o, d, prices)) == [(pytest.approx(94.44),)]


def test_case2_lists(pizza):
    o, d, names, recipes, tops, _ = pizza
    assert rows(lists.top_extra(o, tops)) == [("Bacon", 4)]
    assert rows(lists.top_exclusion(o, tops)) == [("Cheese", 4)]
    labels = {(r.order_id, r.line_number): r.pizza_with_toppings
              for r in lists.order_item_label(o, names, tops).collect()}
    assert labels[(1, 1)] == "Meatlovers "
    assert labels[(5, 8)] == "Meatlovers  - Extra Bacon"
    assert labels[(10, 14)] == "Meatlovers - Exclude BBQ Sauce, Mushrooms - Extra Bacon, Cheese"
    ing = {r.order_id: r.ingredient_list for r in lists.order_ingredient_list(o, names, recipes, tops).collect()}
    assert ing[5] == "Meatlovers: 2xBacon, BBQ Sauce, Beef, Cheese, Chicken, Mushrooms, Pepperoni, Salami"
    assert ing[7] == "Vegetarian: Bacon, Cheese, Mushrooms, Onions, Peppers, Tomato Sauce, Tomatoes"
    totals = sorted(rows(lists.ingredient_totals(o, d, recipes, tops)), key=lambda t: -(t[1] or 0))
    assert totals[:3] == [("Bacon", 12), ("Mushrooms", 11), ("Cheese", 10)]


def test_case3_journeys(spark):
    from bizlens.sources.dimensions import plans

    subs = literal_table(spark, SUBSCRIPTIONS, [("customer_id", "INT"), ("plan_id", "INT"), ("start_date", "DATE")])
    got = {(r.customer_id, r.step): (r.plan_name, r.next_plan, r.transition)
           for r in journeys.customer_journey(subs, plans(spark)).collect()}
    assert got[(1, 1)] == ("trial", "basic monthly", "downgraded")
    assert got[(2, 1)] == ("trial", "pro annual", "upgraded")
    assert got[(11, 1)] == ("trial", "churn", "cancelled")
    assert got[(13, 1)][2] == "downgraded" and got[(13, 2)] == ("basic monthly", "pro monthly", "upgraded")
    assert got[(15, 1)][2] == "continued" and got[(15, 2)][2] == "cancelled"

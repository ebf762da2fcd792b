"""Dirty orders / deliveries: cleaning, labels, ingredient lists, money."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from bizlens.plans import cleaning, lists, orders
from bizlens.sources.dimensions import literal_table
from tests.conftest import rows

T = dt.datetime

TOPPINGS = ["Anchovy", "Basil", "Brisket", "Cheddar", "Chorizo", "Garlic", "Jalapeno", "Olives", "Peppers", "Pineapple",
            "Spinach", "Tomato"]


class dims:
    """A small menu, its recipes and toppings."""

    @staticmethod
    def pizza_names(spark):
        return literal_table(spark, [(1, "Carnivore"), (2, "Garden")], [("pizza_id", "INT"), ("pizza_name", "STRING")])

    @staticmethod
    def pizza_recipes(spark):
        return literal_table(spark, [(1, "1, 3, 4, 5, 7, 8, 10, 11"), (2, "2, 4, 6, 9, 11, 12")],
                             [("pizza_id", "INT"), ("toppings", "STRING")])

    @staticmethod
    def toppings(spark, more=()):
        return literal_table(spark, [*enumerate(TOPPINGS, 1), *more], [("topping_id", "INT"), ("topping_name", "STRING")])


@pytest.fixture(scope="module")
def data(spark):
    raw = spark.createDataFrame([
        (1, 1, 0, 0, 101, 1, "", "", T(2020, 1, 1, 18, 5, 2)),
        (2, 1, 0, 0, 101, 1, "null", "1, 5", T(2020, 1, 1, 19, 0, 0)),
        (3, 1, 0, 0, 102, 2, "4", "null", T(2020, 1, 2, 10, 0, 0)),
        (3, 2, 0, 0, 102, 1, "2, 6", "1, 4", T(2020, 1, 2, 10, 0, 0)),
        (4, 1, 0, 0, 103, 2, None, "1", T(2020, 1, 3, 12, 0, 0)),
    ], "order_id long, line_number int, part_key long, supp_key long, customer_id long, pizza_id int, "
       "exclusions string, extras string, order_time timestamp_ntz")
    draw = spark.createDataFrame([
        (1, 1, "2020-01-01 18:15:34", "20km", "32 minutes", ""),
        (2, 1, "2020-01-01 19:10:54", "23.4 km", "27 mins", None),
        (3, 2, "null", "null", "null", "Restaurant Cancellation"),
        (4, 2, "2020-01-03 12:20:00", "10", "15", "null"),
    ], "order_id long, runner_id int, pickup_time string, distance string, duration string, cancellation string")
    return cleaning.clean_orders(raw), cleaning.clean_deliveries(draw)


def test_cleaning(data):
    o, d = data
    assert rows(o, "order_id", "line_number", "exclusions", "extras") == [
        (1, 1, None, None), (2, 1, None, "1, 5"), (3, 1, "4", None), (3, 2, "2, 6", "1, 4"), (4, 1, None, "1")]
    assert rows(d, "order_id", "distance", "duration", "cancellation") == [
        (1, Decimal("20.00"), 32, None), (2, Decimal("23.40"), 27, None),
        (3, None, None, "Restaurant Cancellation"), (4, Decimal("10.00"), 15, None)]
    assert rows(d.filter("order_id = 1"), "pickup_time") == [(T(2020, 1, 1, 18, 15, 34),)]


def test_rates_and_money(data, spark):
    o, d = data
    assert rows(orders.success_rate(d)) == [(1, 2, 2, 100), (2, 2, 1, 50)]
    prices = {1: 12, 2: 10}
    assert rows(orders.revenue(o, d, prices)) == [(34,)]
    assert rows(orders.revenue_with_extras(o, d, prices, 1)) == [(37,)]
    # 34 - 0.3 * (20 + 23.4 + 10)
    assert rows(orders.net_profit(o, d, prices)) == [(pytest.approx(17.98),)]
    assert rows(orders.delivery_spread(o, d)) == [(17,)]
    assert rows(orders.largest_delivery(o, d)) == [(1, 1)]


def test_times(data):
    o, d = data
    # runner 1: order 1 10m32s, order 2 10m54s -> mean 10m43s -> 10; runner 2: order 4 20m (order 3 NULL)
    assert rows(orders.avg_pickup_minutes(o, d)) == [(1, 10), (2, 20)]


def test_labels(data, spark):
    o, _ = data
    names, toppings = dims.pizza_names(spark), dims.toppings(spark)
    got = dict(((r.order_id, r.line_number), r.pizza_with_toppings)
               for r in lists.order_item_label(o, names, toppings).collect())
    assert got[(1, 1)] == "Carnivore "
    assert got[(2, 1)] == "Carnivore  - Extra Anchovy, Chorizo"
    assert got[(3, 1)] == "Garden - Exclude Cheddar"
    assert got[(3, 2)] == "Carnivore - Exclude Basil, Garlic - Extra Anchovy, Cheddar"
    assert got[(4, 1)] == "Garden  - Extra Anchovy"


def test_ingredient_list(data, spark):
    o, _ = data
    got = dict(((r.order_id, r.line_number), r.ingredient_list) for r in lists.order_ingredient_list(
        o, dims.pizza_names(spark), dims.pizza_recipes(spark), dims.toppings(spark)).collect())
    assert got[(2, 1)] == "Carnivore: 2xAnchovy, 2xChorizo, Brisket, Cheddar, Jalapeno, Olives, Pineapple, Spinach"
    assert got[(3, 1)] == "Garden: Basil, Garlic, Peppers, Spinach, Tomato"
    assert got[(3, 2)] == "Carnivore: 2xAnchovy, 2xCheddar, Brisket, Chorizo, Jalapeno, Olives, Pineapple, Spinach"
    assert got[(4, 1)] == "Garden: Anchovy, Basil, Cheddar, Garlic, Peppers, Spinach, Tomato"


def test_ingredient_totals(data, spark):
    o, d = data
    got = dict(rows(lists.ingredient_totals(o, d, dims.pizza_recipes(spark), dims.toppings(spark))))
    assert got == {"Anchovy": 4, "Basil": 1, "Brisket": 2, "Cheddar": 3, "Chorizo": 3, "Garlic": 1,
                   "Jalapeno": 2, "Olives": 2, "Peppers": 1, "Pineapple": 2, "Spinach": 3, "Tomato": 1}


def test_top_lists(data, spark):
    o, _ = data
    assert rows(lists.top_extra(o, dims.toppings(spark))) == [("Anchovy", 3)]
    assert rows(lists.top_exclusion(o, dims.toppings(spark))) == [
        ("Basil", 1), ("Cheddar", 1), ("Garlic", 1)]


def test_dense_ids(spark):
    from pyspark.sql import functions as F

    from bizlens.operators.ids import with_dense_id

    df = spark.range(0, 5000).select(((F.col("id") * 7919) % 5003).alias("k"))
    got = [(r.k, r.id) for r in with_dense_id(df, ["k"]).orderBy("k").collect()]
    assert [i for _, i in got] == list(range(1, 5001))


def test_ingredient_totals_nothing_delivered(data, spark):
    o, d = data
    none = d.filter("order_id < 0")
    assert lists.ingredient_totals(o, none, dims.pizza_recipes(spark), dims.toppings(spark)).count() == 0


def test_unnamed_topping(data, spark):
    """A topping without a name shows up nowhere; an id of no topping is skipped."""
    o, _ = data
    some = dims.toppings(spark).withColumn("topping_name", F.when(F.col("topping_id") != 5, F.col("topping_name")))
    got = {(r.order_id, r.line_number): r.pizza_with_toppings
           for r in lists.order_item_label(o, dims.pizza_names(spark), some.filter("topping_id <> 4")).collect()}
    assert len(got) == 5
    assert got[(2, 1)] == "Carnivore  - Extra Anchovy" and got[(3, 1)] == "Garden "

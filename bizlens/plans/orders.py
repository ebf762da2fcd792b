"""Orders and deliveries: counts, rates, times and money.

Inputs (cleaned): ``orders`` -- one row per ordered item (order_id,
line_number, part_key, supp_key, customer_id, pizza_id, exclusions, extras,
order_time); ``deliveries`` -- one row per order (order_id, runner_id,
pickup_time, distance decimal, duration int, cancellation).

Item rows are far more numerous than orders, so per-order questions first
reduce items to one row per order (count of items) and only then meet the
delivery row: the join input shrinks from items to orders, and weighting by
the item count keeps the item-grain averages exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bizlens.functions.dates import day_name, seconds_between, week_label
from bizlens.functions.numeric import div, rounded
from bizlens.operators.aggregate import sum_if
from bizlens.operators.ranking import top_k
from bizlens.session import table_path
from bizlens.sources import sinks


def _delivered(deliveries: DataFrame) -> DataFrame:
    return deliveries.filter(F.col("cancellation").isNull())


def _items_per_order(orders: DataFrame, *carry: str) -> DataFrame:
    return orders.groupBy("order_id", *carry).agg(F.count("pizza_id").alias("_items"))


def items_ordered(orders: DataFrame) -> DataFrame:
    return orders.agg(F.count("order_id").alias("pizza_orders"))


def unique_orders(orders: DataFrame) -> DataFrame:
    return orders.agg(F.countDistinct("order_id").alias("customer_orders"))


def successful_by_runner(deliveries: DataFrame) -> DataFrame:
    return _delivered(deliveries).groupBy("runner_id").agg(F.count("order_id").alias("successful_orders"))


def delivered_by_type(orders: DataFrame, deliveries: DataFrame, names: DataFrame) -> DataFrame:
    ok = orders.join(_delivered(deliveries).select("order_id"), "order_id", "left_semi")
    counts = ok.groupBy("pizza_id").agg(F.count("pizza_id").alias("delivered"))
    return counts.join(names, "pizza_id").groupBy("pizza_name").agg(
        F.sum("delivered").cast("bigint").alias("delivered"))


def type_pivot_by_customer(orders: DataFrame, columns: dict[int, str]) -> DataFrame:
    return orders.groupBy("customer_id").agg(
        *[sum_if(F.col("pizza_id") == pid).cast("bigint").alias(name) for pid, name in columns.items()]
    )


def largest_delivery(orders: DataFrame, deliveries: DataFrame) -> DataFrame:
    ok = orders.join(_delivered(deliveries).select("order_id"), "order_id", "left_semi")
    per_order = ok.groupBy("order_id", "customer_id").agg(F.count("pizza_id").alias("pizza_delivered"))
    return top_k(per_order, [F.col("pizza_delivered").desc(), F.col("order_id").asc()], 1).select(
        "order_id", "pizza_delivered")


def changes_by_customer(orders: DataFrame, deliveries: DataFrame) -> DataFrame:
    ok = orders.join(_delivered(deliveries).select("order_id"), "order_id", "left_semi")
    changed = F.col("exclusions").isNotNull() | F.col("extras").isNotNull()
    plain = F.col("exclusions").isNull() & F.col("extras").isNull()
    return ok.groupBy("customer_id").agg(
        sum_if(changed).cast("bigint").alias("changes"), sum_if(plain).cast("bigint").alias("no_changes"))


def both_changes(orders: DataFrame, deliveries: DataFrame) -> DataFrame:
    ok = orders.join(_delivered(deliveries).select("order_id"), "order_id", "left_semi")
    both = F.col("exclusions").isNotNull() & F.col("extras").isNotNull()
    return ok.agg(sum_if(both).cast("bigint").alias("all_changes"))


def orders_by_hour(orders: DataFrame) -> DataFrame:
    return orders.groupBy(F.hour("order_time").alias("hour_day")).agg(
        F.count("order_id").alias("total_pizza_ordered"))


def orders_by_weekday(orders: DataFrame) -> DataFrame:
    return orders.groupBy(day_name("order_time", "upper").alias("day_of_the_week")).agg(
        F.count("order_id").alias("total_pizza_ordered"))


def signups_by_week(runners: DataFrame, offset_days: int = 4, anchor: str | None = None) -> DataFrame:
    """Runners per signup week. Default labels weeks as Monday + ``offset_days``;
    with ``anchor`` weeks are 7-day periods starting at the anchor date."""
    if anchor is None:
        wk = week_label("registration_date", offset_days)
    else:
        a = F.lit(anchor).cast("date")
        wk = F.date_add(a, (F.floor(F.datediff("registration_date", a) / 7) * 7).cast("int"))
    return runners.groupBy(wk.alias("week")).agg(F.count("runner_id").alias("runners"))


def _seconds_between(start: str, end: str) -> Column:
    return seconds_between(start, end)


def _minute_field(total_seconds: Column, n: Column, field: bool = True) -> Column:
    """Minute field of the average interval: floor(avg / 60) mod 60, exact;
    ``field=False`` gives whole minutes of the average instead."""
    minutes = F.floor(div(total_seconds, n * 60))
    return (minutes % 60 if field else minutes).cast("bigint")


def avg_pickup_minutes(orders: DataFrame, deliveries: DataFrame, grain: str = "item",
                       minute_field: bool = True) -> DataFrame:
    """Minute field of the mean order-to-pickup time per runner.

    ``grain='item'`` weights each order by its item count (the join is at
    item grain); ``'order'`` weights orders equally.
    """
    per_order = _items_per_order(orders, "order_time")
    j = per_order.join(deliveries.select("order_id", "runner_id", "pickup_time"), "order_id")
    w = F.col("_items") if grain == "item" else F.lit(1)
    secs = _seconds_between("order_time", "pickup_time")
    agg = j.groupBy("runner_id").agg(
        F.sum(secs * w).alias("_s"), F.sum(F.when(secs.isNotNull(), w)).alias("_n"))
    return agg.select("runner_id", _minute_field(F.col("_s"), F.col("_n"), minute_field)
                      .alias("average_arrival_minutes"))


def prep_time_by_size(orders: DataFrame, deliveries: DataFrame, minute_field: bool = True) -> DataFrame:
    """Minute field of the mean order-to-pickup time per order size.

    Orders without a pickup are skipped by the aggregates themselves (SUM and
    COUNT ignore NULL); sizes with no pickup at all are dropped afterwards, on
    the aggregated count -- a filter on the pickup column would be pushed
    into the cleaning expressions and evaluate them again.
    """
    per_order = orders.groupBy("order_id", "order_time").agg(F.count("pizza_id").alias("pizza_order_count"))
    j = per_order.join(deliveries.select("order_id", "pickup_time"), "order_id")
    secs = _seconds_between("order_time", "pickup_time")
    agg = j.groupBy("pizza_order_count").agg(F.sum(secs).alias("_s"), F.count(secs).alias("_n"))
    return agg.filter(F.col("_n") > 0).select(
        "pizza_order_count", _minute_field(F.col("_s"), F.col("_n"), minute_field).alias("average_time"))


def avg_distance(orders: DataFrame, deliveries: DataFrame, grain: str = "item") -> DataFrame:
    per_order = _items_per_order(orders, "customer_id")
    j = per_order.join(deliveries.select("order_id", "distance"), "order_id")
    w = F.col("_items") if grain == "item" else F.lit(1)
    agg = j.groupBy("customer_id").agg(
        F.sum(F.col("distance") * w).alias("_s"), F.sum(F.when(F.col("distance").isNotNull(), w)).alias("_n"))
    return agg.select("customer_id", rounded(div(F.col("_s"), F.col("_n")), 2).alias("distance_travelled"))


def delivery_spread(orders: DataFrame, deliveries: DataFrame) -> DataFrame:
    """Longest minus shortest duration (MAX / MIN skip NULL durations)."""
    d = deliveries.select("order_id", "duration").join(orders.select("order_id"), "order_id", "left_semi")
    return d.agg((F.max("duration") - F.min("duration")).cast("bigint").alias("delivery_difference"))


def speed_by_delivery(deliveries: DataFrame) -> DataFrame:
    """Average speed per (runner, order, distance, duration) for deliveries
    with both distance and duration. A NULL distance or duration makes the
    speed NULL, so such groups are dropped on the aggregated value instead of
    filtering the (text-cleaned) inputs."""
    speed = F.col("distance") * 60 / F.col("duration")
    return deliveries.groupBy("runner_id", "order_id", "distance", "duration").agg(
        rounded(F.avg(speed), 2).alias("average_speed_kmh")
    ).filter(F.col("average_speed_kmh").isNotNull()).select(
        "runner_id", "order_id",
        F.col("distance").cast("double").alias("distance_in_km"),
        F.col("duration").alias("duration_in_minutes"),
        "average_speed_kmh",
    )


def success_rate(deliveries: DataFrame) -> DataFrame:
    """100 * taken / sent with integer division, as written."""
    return deliveries.groupBy("runner_id").agg(
        F.count("order_id").alias("total_order_sent"),
        F.count("pickup_time").alias("order_taken"),
        (F.count("pickup_time") * 100).alias("_t"),
    ).select("runner_id", "total_order_sent", "order_taken",
             F.expr("_t div total_order_sent").alias("success_pct"))


def _price(pizza_id: Column, prices: dict[int, int]) -> Column:
    e = None
    for pid, p in prices.items():
        e = F.when(pizza_id == pid, p) if e is None else e.when(pizza_id == pid, p)
    return e


def revenue(orders: DataFrame, deliveries: DataFrame, prices: dict[int, int]) -> DataFrame:
    ok = orders.join(_delivered(deliveries).select("order_id"), "order_id", "left_semi")
    return ok.agg(F.sum(_price(F.col("pizza_id"), prices)).cast("bigint").alias("total_dollar_gains"))


def revenue_with_extras(orders: DataFrame, deliveries: DataFrame, prices: dict[int, int], fee: int = 1,
                        by_count: bool = False) -> DataFrame:
    """Price plus an extras fee. As written the fee is taken from the *text
    length* of the list (1 char -> +fee, longer -> +2*fee); ``by_count=True``
    charges ``fee`` per listed extra instead."""
    ok = orders.join(_delivered(deliveries).select("order_id"), "order_id", "left_semi")
    price = _price(F.col("pizza_id"), prices)
    if by_count:
        charge = F.when(F.col("extras").isNull(), price).otherwise(
            price + fee * F.size(F.split(F.col("extras"), ",")))
    else:
        charge = (F.when(F.col("extras").isNull(), price)
                  .when(F.length("extras") == 1, price + fee).otherwise(price + 2 * fee))
    return ok.agg(F.sum(charge).cast("bigint").alias("price_extra_charges"))


RATING_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("order_id", T.LongType()),
    T.StructField("customer_id", T.LongType()), T.StructField("runner_id", T.IntegerType()),
    T.StructField("rating", T.IntegerType()), T.StructField("rating_time", T.TimestampNTZType()),
])


def _rating() -> Column:
    return ((F.col("order_id") * 7 + F.col("runner_id")) % 5 + 1).cast("int")


def rating_rows(deliveries: DataFrame) -> DataFrame:
    """One rating (1-5) per successful delivery (with its customer_id), not numbered yet."""
    return _delivered(deliveries).select(
        "order_id", "customer_id", "runner_id",
        _rating().alias("rating"),
        F.timestamp_add("MINUTE", F.col("duration") + 5 + F.col("order_id") % 30, F.col("pickup_time"))
        .alias("rating_time"),
    )


def ratings_table(deliveries: DataFrame, name: str = "runner_rating") -> DataFrame:
    """Create the ratings table with a declared schema, insert the ratings in two parts (the lower half of the
    order numbers, then the upper), read back: the ids 1..n go on from the first insert to the second."""
    spark = deliveries.sparkSession
    middle = deliveries.agg(F.avg("order_id").cast("bigint")).first()[0]
    table = sinks.NumberedTable(spark, table_path(spark, name), RATING_SCHEMA)
    for half in (F.col("order_id") <= middle, F.col("order_id") > middle):
        table.insert(rating_rows(deliveries.filter(half)), ["order_id"])
    stored = table.read()
    stored.createOrReplaceTempView(name)
    return stored


def delivery_report(lines: DataFrame, deliveries: DataFrame) -> DataFrame:
    """``deliveries`` with the customer_id and order_time of their order, which are rated by
    :func:`rating_rows`; the lines are counted per order before they meet them."""
    per_order = lines.groupBy("order_id").agg(F.count("order_id").alias("pizzas"))
    rated = _delivered(deliveries).withColumn("rating", _rating())
    j = per_order.join(rated, "order_id")
    return j.select(
        "customer_id", "order_id", "runner_id", "rating", "order_time", "pickup_time",
        _seconds_between("order_time", "pickup_time").cast("bigint").alias("wait_seconds"),
        "duration",
        rounded(F.col("distance") * 60 / F.col("duration"), 1).alias("average_speed"),
        F.col("pizzas").cast("bigint").alias("pizzas"),
    )


def net_profit(orders: DataFrame, deliveries: DataFrame, prices: dict[int, int],
               per_km: str = "0.30") -> DataFrame:
    """Revenue of delivered items minus ``per_km`` times delivered distance.

    Both totals come from one aggregate over the union of the two inputs, so
    no one-row tables need joining.
    """
    ok = orders.join(_delivered(deliveries).select("order_id"), "order_id", "left_semi")
    income = ok.select(_price(F.col("pizza_id"), prices).cast("decimal(18,2)").alias("amount"),
                       F.lit(0).alias("is_cost"))
    cost = _delivered(deliveries).select(F.col("distance").cast("decimal(18,2)").alias("amount"),
                                         F.lit(1).alias("is_cost"))
    both = income.unionByName(cost)
    total = (F.sum(F.when(F.col("is_cost") == 0, F.col("amount")))
             - F.sum(F.when(F.col("is_cost") == 1, F.col("amount"))) * F.lit(per_km).cast("decimal(6,2)"))
    return both.agg(total.cast("double").alias("net_profit_in_dollars"))

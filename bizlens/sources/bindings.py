"""Canonical views: the case-study tables derived from the driver's testdata.

Each ``v_*`` function reads whole parquet tables (Spark prunes columns and
pushes filters into the scan) and derives the case-study schema with
deterministic expressions. The oracle SQL in :mod:`bizlens.oracle.views`
spells the same definitions for DuckDB.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bizlens.functions.dates import short_date_text, week_start
from bizlens.sources import dimensions as dims
from bizlens.sources.schemas import TABLES


# nation (25 rows) and region (5 rows) have a fixed size at every scale factor,
# so they are always safe to broadcast; joining them by shuffle would put all
# rows on at most 25 / 5 partitions.
FIXED_SIZE = {"nation", "region"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one source table with its declared schema (see :mod:`bizlens.sources.schemas`)."""
    reader = spark.read
    if name in TABLES:
        reader = reader.schema(TABLES[name])
    df = reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return F.broadcast(df) if name in FIXED_SIZE else df


def _case(key: Column, mapping: list[tuple[int, object]]) -> Column:
    expr = None
    for k, v in mapping:
        val = F.lit(v).cast("string") if v is None else F.lit(v)
        expr = F.when(key == k, val) if expr is None else expr.when(key == k, val)
    return expr


# --------------------------------------------------------------------------
# Case 1 -- loyalty
# --------------------------------------------------------------------------

def v_menu(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One product per distinct part type; id = rank of the name; price 100*id.

    The types are one aggregate of the part table, a set per task, and their ids
    the places in the sorted set.
    """
    product_id = F.col("pos") + 1
    return _numbered_names(table(spark, sf_dir, "part"), "p_type").select(
        product_id.cast("int").alias("product_id"), F.col("col").alias("product_name"),
        (product_id * 100).cast("int").alias("price"))


def _numbered_names(df: DataFrame, column: str) -> DataFrame:
    """(pos, col): the sorted distinct names of a column with few, from 0 on; a NULL is one, the first."""
    return df.agg(_sorted_names(column).alias("names")).select(F.posexplode("names"))


def _sorted_names(column: str) -> Column:
    names = F.sort_array(F.collect_set(column))
    some = F.max(F.col(column).isNull().cast("int")) == 1
    return F.when(some, F.concat(F.array(F.lit(None).cast("string")), names)).otherwise(names)


def v_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per lineitem, with the product's name and price from the menu.

    A part's product id is the place of its type among the sorted types (one
    small array, a scalar subquery): a join on the type would put all parts in
    as many tasks as there are types.
    """
    part = table(spark, sf_dir, "part").filter(F.col("p_type").isNotNull())
    product_id = F.array_position(part.select(F.sort_array(F.collect_set("p_type"))).scalar(), F.col("p_type"))
    part_product = part.select("p_partkey", product_id.cast("int").alias("product_id"),
                               F.col("p_type").alias("product_name"), (product_id * 100).cast("int").alias("price"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return (
        table(spark, sf_dir, "lineitem")
        .select("l_orderkey", "l_partkey")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(part_product, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").cast("date").alias("order_date"),
            "product_id", "product_name", "price",
        )
    )


def v_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .filter(F.col("o_orderpriority") == "1-URGENT")
        .groupBy(F.col("o_custkey").alias("customer_id"))
        .agg(F.min(F.col("o_orderdate").cast("date")).alias("join_date"))
    )


# --------------------------------------------------------------------------
# Case 2 -- orders and deliveries (dirty text on purpose)
# --------------------------------------------------------------------------

# Largest part size whose brand is in its type's recipe.
RECIPE_SIZE = 5


def _dirty_list(which: Column, one: Column, other: Column) -> Column:
    """By ``which``: a spelling of the empty list ('null', '' or NULL), or a
    list of one or two ids."""
    return (F.when(which == 0, "null").when(which.isin(1, 6), "").when(which == 2, F.lit(None).cast("string"))
            .when(which == 3, one).otherwise(F.concat(one, F.lit(", "), other)))


def v_order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per lineitem: a pizza line of an order, list columns still dirty;
    the ids in the lists come from the line's keys."""
    part, supp = F.col("l_partkey"), F.col("l_suppkey")

    def topping(key: Column) -> Column:
        return (key % 9 + 1).cast("string")

    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_number"),
        part.alias("part_key"),
        supp.alias("supp_key"),
        (part % 2 + 1).cast("int").alias("pizza_id"),
        _dirty_list(supp % 5, topping(part), topping(part + 4)).alias("exclusions"),
        _dirty_list(part % 7, topping(supp), topping(supp + 2)).alias("extras"),
    )


def v_orders_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order lines with the customer and time of their order."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return (
        v_order_lines(spark, sf_dir)
        .join(orders, F.col("order_id") == F.col("o_orderkey"))
        .select(
            "order_id", "line_number", "part_key", "supp_key", F.col("o_custkey").alias("customer_id"),
            "pizza_id", "exclusions", "extras",
            F.timestamp_add("MINUTE", F.col("o_orderkey") % 1440, F.col("o_orderdate")).alias("order_time"),
        )
    )


def v_order_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """order_id -> customer_id, one row per order (read from orders directly)."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id")
    )


def v_deliveries_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One delivery per order; pickup / distance / duration as dirty text. The customer and time of the
    order come along for jobs that need them: they lie in the same row."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    k = F.col("o_orderkey")
    cancelled = (k % 9) == 0
    order_time = F.timestamp_add("MINUTE", k % 1440, F.col("o_orderdate"))
    pickup = F.timestamp_add("SECOND", (10 + k % 30) * 60 + k % 60, order_time)
    distance = ((k % 250) + 10).cast("decimal(6,1)") / 10
    dist_txt = F.concat(distance.cast("decimal(5,1)").cast("string"),
                        _case(k % 4, [(0, "km"), (1, " km"), (2, ""), (3, "km")]))
    dur_txt = F.concat((10 + k % 31).cast("string"),
                       _case(k % 5, [(0, " minutes"), (1, " mins"), (2, "mins"), (3, " minute"), (4, "")]))
    null_txt = F.lit("null")
    return o.select(
        k.alias("order_id"),
        (F.col("o_custkey") % 8 + 1).cast("int").alias("runner_id"),
        F.when(cancelled, null_txt).otherwise(pickup.cast("string")).alias("pickup_time"),
        F.when(cancelled, null_txt).otherwise(dist_txt).alias("distance"),
        F.when(cancelled, null_txt).otherwise(dur_txt).alias("duration"),
        F.when(cancelled, F.when(k % 2 == 0, F.lit("Called off by the kitchen")).otherwise(F.lit("Called off by the guest")))
        .otherwise(_case(k % 3, [(0, None), (1, ""), (2, "null")]))
        .alias("cancellation"),
        F.col("o_custkey").alias("customer_id"), order_time.alias("order_time"),
    )


def v_runners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One runner per supplier; registration spread over three weeks of 2021."""
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("runner_id"),
        F.date_add(F.lit("2021-01-01").cast("date"), (F.col("s_suppkey") % 21).cast("int")).alias("registration_date"),
    )


def v_pizza_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One product per part type, numbered by name (order lines use the first two)."""
    return v_menu(spark, sf_dir).select(F.col("product_id").alias("pizza_id"), F.col("product_name").alias("pizza_name"))


def v_toppings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One topping per brand, numbered by name."""
    return _numbered_names(table(spark, sf_dir, "part"), "p_brand").select(
        (F.col("pos") + 1).cast("int").alias("topping_id"), F.col("col").alias("topping_name"))


def v_pizza_recipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A product's recipe: the toppings (brands) that its type has in small parts.

    The ids are places in the sorted names, two small arrays: a join on 25 brands or 150 types would put
    all parts in as many tasks.
    """
    part = table(spark, sf_dir, "part")
    types, brands = (part.agg(_sorted_names(c)).scalar() for c in ("p_type", "p_brand"))
    small = part.filter((F.col("p_size") <= RECIPE_SIZE) & F.col("p_type").isNotNull() & F.col("p_brand").isNotNull())
    recipes = small.groupBy("p_type").agg(F.collect_set("p_brand").alias("brands")).select(
        F.array_position(types, F.col("p_type")).cast("int").alias("pizza_id"), "brands", brands.alias("names"))
    ids = F.sort_array(F.transform("brands", lambda b: F.array_position("names", b)))
    return recipes.select("pizza_id", F.array_join(ids.cast("array<string>"), ", ").alias("toppings"))


# --------------------------------------------------------------------------
# Case 3 -- subscriptions
# --------------------------------------------------------------------------

def v_plans(spark: SparkSession, sf_dir: str | None = None) -> DataFrame:
    return dims.plans(spark)


def v_subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_custkey").alias("customer_id"),
        (F.substring("o_orderpriority", 1, 1).cast("int") - 1).alias("plan_id"),
        F.col("o_orderdate").cast("date").alias("start_date"),
    ).distinct()


# --------------------------------------------------------------------------
# Case 4 -- bank
# --------------------------------------------------------------------------

def v_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("region_id"), F.col("r_name").alias("region_name")
    )


def v_customer_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    return (
        table(spark, sf_dir, "orders")
        .select("o_custkey", "o_orderpriority", "o_orderdate")
        .join(cust, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("o_custkey").alias("customer_id"),
            F.col("n_regionkey").alias("region_id"),
            F.substring("o_orderpriority", 1, 1).cast("int").alias("node_id"),
            F.col("o_orderdate").cast("date").alias("start_date"),
        )
    )


def v_customer_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("txn_date"),
        F.when(F.col("o_orderstatus") == "O", "deposit")
        .when(F.col("o_orderstatus") == "F", "purchase")
        .when(F.col("o_orderstatus") == "P", "withdrawal")
        .alias("txn_type"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("txn_amount"),
    )


# --------------------------------------------------------------------------
# Case 5 -- retail weekly sales (dirty week text and segment)
# --------------------------------------------------------------------------

_SEGMENTS = [("AUTOMOBILE", "C1"), ("BUILDING", "C2"), ("FURNITURE", "F3"), ("HOUSEHOLD", "F4"), ("MACHINERY", "null")]


def v_weekly_sales_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly sales rows: one per (week, region, platform, segment, customer type)."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_extendedprice", "l_shipdate")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    seg = None
    for k, v in _SEGMENTS:
        seg = F.when(F.col("c_mktsegment") == k, v) if seg is None else seg.when(F.col("c_mktsegment") == k, v)
    # The order-side attributes are assembled first (orders-sized joins), so the
    # lineitem-sized side is shuffled once, on the order key.
    order_attrs = (
        o.join(c, F.col("o_custkey") == F.col("c_custkey"))
        .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    joined = (
        li.join(order_attrs, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            week_start("l_shipdate").alias("week_start"),
            F.col("r_name").alias("region"),
            F.when(F.col("o_orderstatus") == "O", "Shopify").otherwise("Retail").alias("platform"),
            seg.alias("segment"),
            F.col("o_orderpriority").alias("customer_type"),
            F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"),
        )
    )
    return (
        joined.groupBy("week_start", "region", "platform", "segment", "customer_type")
        .agg(F.count(F.lit(1)).alias("transactions"), F.round(F.sum("amount"), 0).cast("bigint").alias("sales"))
        .select(
            short_date_text("week_start").alias("week_date"),
            "region", "platform", "segment", "customer_type", "transactions", "sales",
        )
    )


# --------------------------------------------------------------------------
# Case 6 -- clickstream
# --------------------------------------------------------------------------

_EVENT_CODES = [("view", 1), ("click", 2), ("purchase", 3), ("signup", 4), ("error", 5)]


def v_events(spark: SparkSession, sf_dir: str, with_sequence: bool = True) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "props")
    code = None
    for name, c in _EVENT_CODES:
        code = F.when(F.col("event_type") == name, c) if code is None else code.when(F.col("event_type") == name, c)
    out = e.select(
        "event_id",
        F.concat(F.col("user_id").cast("string"), F.lit("-"), F.col("ts").cast("date").cast("string")).alias("visit_id"),
        (F.col("user_id") * 10 + F.dayofmonth("ts") % 3).cast("string").alias("cookie_id"),
        (F.get_json_object("props", "$.k").cast("int") % 13 + 1).alias("page_id"),
        code.cast("int").alias("event_type"),
        F.col("ts").alias("event_time"),
    )
    if with_sequence:
        w = Window.partitionBy("visit_id").orderBy("event_time", "event_id")
        out = out.withColumn("sequence_number", F.row_number().over(w))
    return out


def v_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("user_id", "ts")
    return e.select(
        "user_id", (F.col("user_id") * 10 + F.dayofmonth("ts") % 3).cast("string").alias("cookie_id")
    ).distinct()


def v_event_identifier(spark: SparkSession, sf_dir: str | None = None) -> DataFrame:
    return dims.event_types(spark)


def v_page_hierarchy(spark: SparkSession, sf_dir: str | None = None) -> DataFrame:
    return dims.pages(spark)


def v_campaign_identifier(spark: SparkSession, sf_dir: str | None = None) -> DataFrame:
    return dims.campaigns(spark)

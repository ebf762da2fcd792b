"""Clickstream: traffic, product funnel and campaign attribution.

Inputs: ``events(visit_id, cookie_id, page_id, event_type, sequence_number,
event_time)``, ``users(user_id, cookie_id)``, ``event_types(event_type,
event_name)``, ``pages(page_id, page_name, product_category, product_id)``,
``campaigns(campaign_name, start_date, end_date)``.

Event codes: 1 page view, 2 cart add, 3 purchase, 4 ad impression, 5 ad click.
Dimensions are literal, bounded tables and are broadcast; facts are reduced
(counted per page / per visit) before any name is attached.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bizlens.functions.dates import month_name
from bizlens.functions.numeric import div, rounded
from bizlens.operators.aggregate import ordered_join, sum_if
from bizlens.operators.joins import point_in_interval_join
from bizlens.operators.scan import block_of
from bizlens.operators.ranking import in_order, top_k

VIEW, CART_ADD, PURCHASE, IMPRESSION, CLICK = 1, 2, 3, 4, 5


def _typed(events: DataFrame, event_types: DataFrame) -> DataFrame:
    """Events whose type is known (inner join with the broadcast type table)."""
    return events.join(event_types, "event_type")


def user_count(users: DataFrame) -> DataFrame:
    return users.agg(F.countDistinct("user_id").alias("number_of_users"))


def avg_cookies(users: DataFrame) -> DataFrame:
    per = users.groupBy("user_id").agg(F.count("cookie_id").alias("_n"))
    return per.agg(rounded(div(F.sum("_n"), F.count("_n")), 2).alias("avg_cookies"))


def visits_by_month(users: DataFrame, events: DataFrame) -> DataFrame:
    """Distinct visits per month name. Only events of known cookies count; as
    the count is distinct, a semi join is enough (no row multiplication)."""
    e = events.join(users.select("cookie_id"), "cookie_id", "left_semi")
    months = e.groupBy(month_name("event_time", "upper").alias("month")).agg(
        F.countDistinct("visit_id").alias("number_of_visits"), F.min("event_time").alias("_first"))
    return in_order(months, "_first").drop("_first")  # the months as they came


def events_by_type(events: DataFrame, event_types: DataFrame) -> DataFrame:
    counts = events.groupBy("event_type").agg(F.count("event_type").alias("_n"))
    return counts.join(event_types, "event_type").groupBy("event_name").agg(
        F.sum("_n").cast("bigint").alias("number_of_event"))


def purchase_visit_pct(events: DataFrame, event_types: DataFrame) -> DataFrame:
    """Share of all visits with a purchase.

    Both distinct counts come from one aggregate per visit (partial
    aggregation map-side, one shuffle on visit_id) followed by a global count
    over visits -- rather than two DISTINCT aggregates, which would expand and
    shuffle every event twice.
    """
    e = events.filter(F.col("visit_id").isNotNull()).join(event_types, "event_type", "left")
    per_visit = e.groupBy("visit_id").agg(F.max(F.col("event_name") == "Purchase").alias("_bought"))
    agg = per_visit.agg(F.count(F.when(F.col("_bought"), 1)).alias("_p"), F.count(F.lit(1)).alias("_v"))
    return agg.select(rounded(div(F.col("_p") * 100, F.col("_v")), 2).alias("purchase_percent"))


def checkout_no_purchase_pct(events: DataFrame, event_types: DataFrame, pages: DataFrame,
                             checkout_page: str = "Checkout", restricted: bool = False) -> DataFrame:
    """100 - 100 * purchase visits / checkout page views (as written: the
    denominator counts view *events*, the numerator distinct visits).

    ``restricted=True`` answers the question literally: among distinct visits
    that viewed the checkout page, the share without a purchase event (one
    aggregate per visit, then one global aggregate).
    """
    e = _typed(events, event_types).join(pages.select("page_id", "page_name"), "page_id", "left")
    if restricted:
        per_visit = e.groupBy("visit_id").agg(
            F.max((F.col("event_name") == "Page View") & (F.col("page_name") == checkout_page)).alias("_c"),
            F.max(F.col("event_name") == "Purchase").alias("_p"))
        seen = per_visit.filter(F.col("_c"))
        agg = seen.agg(F.count(F.lit(1)).alias("_n"), F.count(F.when(~F.coalesce(F.col("_p"), F.lit(False)), 1))
                       .alias("_np"))
        return agg.select(rounded(div(F.col("_np") * 100, F.col("_n")), 2)
                          .alias("not_purchase_event"))
    checkout_views = F.count(F.when((F.col("event_name") == "Page View") & (F.col("page_name") == checkout_page),
                                    F.col("visit_id")))
    # per visit first (one shuffle on visit_id), then global totals
    per_visit = e.groupBy("visit_id").agg(checkout_views.alias("_c"),
                                          F.max(F.col("event_name") == "Purchase").alias("_b"))
    agg = per_visit.agg(F.sum("_c").alias("_c"),
                        F.count(F.when(F.col("_b") & F.col("visit_id").isNotNull(), 1)).alias("_p"))
    return agg.select(rounded(100 - div(F.col("_p") * 100, F.col("_c")), 2)
                      .alias("not_purchase_event"))


def top_pages(events: DataFrame, event_types: DataFrame, pages: DataFrame, n: int = 3) -> DataFrame:
    views = _typed(events.filter(F.col("event_type") == VIEW), event_types)
    counts = views.groupBy("page_id").agg(F.count("page_id").alias("_n"))
    named = counts.join(pages, "page_id").groupBy("page_name").agg(
        F.sum("_n").cast("bigint").alias("number_of_views"))
    return top_k(named, [F.col("number_of_views").desc(), F.col("page_name").asc()], n)


def category_views_adds(events: DataFrame, event_types: DataFrame, pages: DataFrame) -> DataFrame:
    e = _typed(events, event_types)
    counts = e.groupBy("page_id").agg(sum_if(F.col("event_type") == VIEW).alias("_v"),
                                      sum_if(F.col("event_type") == CART_ADD).alias("_a"))
    named = counts.join(pages, "page_id").filter(F.col("product_category") != "null")
    return named.groupBy("product_category").agg(F.sum("_v").cast("bigint").alias("number_of_views"),
                                                 F.sum("_a").cast("bigint").alias("cart_adds"))


def purchase_visits(events: DataFrame, event_types: DataFrame) -> DataFrame:
    """Distinct visits having a purchase event (one row per visit)."""
    return (_typed(events.filter(F.col("event_type") == PURCHASE), event_types)
            .select("visit_id").distinct().withColumn("_bought", F.lit(True)))


def top_purchased_products(events: DataFrame, event_types: DataFrame, pages: DataFrame, n: int = 3) -> DataFrame:
    """Cart adds of product pages inside visits that purchased, top ``n``."""
    adds = _typed(events.filter(F.col("event_type") == CART_ADD), event_types)
    bought = adds.join(purchase_visits(events, event_types).select("visit_id"), "visit_id", "left_semi")
    counts = bought.groupBy("page_id").agg(F.count(F.lit(1)).alias("_n"))
    prod = pages.filter(F.col("product_id").isNotNull())
    named = counts.join(prod, "page_id").groupBy("page_name", "product_category").agg(
        F.sum("_n").cast("bigint").alias("number_of_purchases"))
    return top_k(named, [F.col("number_of_purchases").desc(), F.col("page_name").asc()], n)


def _funnel(events: DataFrame, event_types: DataFrame, pages: DataFrame, keys: list[str],
            keep_all: bool = False) -> DataFrame:
    """Views, cart adds, abandoned and purchased adds per ``keys``.

    Every cart add is flagged with whether its visit purchased (a left join
    with the distinct purchase visits), then one aggregate takes all four
    counts. Keys missing from either the abandoned or the purchased side are
    dropped, like the inner join of the three per-side aggregates.
    """
    prod = pages.filter(F.col("product_id").isNotNull() & F.col("product_category").isNotNull())
    e = _typed(events.filter(F.col("event_type").isin(VIEW, CART_ADD)), event_types).join(prod, "page_id")
    flagged = e.join(purchase_visits(events, event_types), "visit_id", "left")
    add = F.col("event_type") == CART_ADD
    bought = F.col("_bought").isNotNull()
    agg = flagged.groupBy(*keys).agg(
        sum_if(F.col("event_type") == VIEW).cast("bigint").alias("number_of_views"),
        sum_if(add).cast("bigint").alias("added_to_cart"),
        sum_if(add & ~bought).cast("bigint").alias("abandoned"),
        sum_if(add & bought).cast("bigint").alias("purchased"),
    )
    return agg if keep_all else agg.filter((F.col("abandoned") > 0) & (F.col("purchased") > 0))


def product_funnel(events: DataFrame, event_types: DataFrame, pages: DataFrame, keep_all: bool = False) -> DataFrame:
    """Per product; ``keep_all=True`` keeps products lacking abandoned or
    purchased adds (with 0) instead of dropping them."""
    f = _funnel(events, event_types, pages, ["product_id", "page_name"], keep_all)
    return f.select(F.col("page_name").alias("product_name"), "number_of_views", "added_to_cart", "abandoned",
                    "purchased")


def category_funnel(events: DataFrame, event_types: DataFrame, pages: DataFrame,
                    keep_all: bool = False) -> DataFrame:
    f = _funnel(events, event_types, pages, ["product_category"], keep_all)
    return f.select("product_category", "number_of_views", "added_to_cart", "abandoned", "purchased")


def store_visit_campaigns(*inputs: DataFrame, name: str = "campaign_analysis", **options) -> DataFrame:
    """``SELECT ... INTO campaign_analysis``: :func:`visit_campaigns`, materialised and read back."""
    from bizlens.sources import sinks

    return sinks.materialise(visit_campaigns(*inputs, **options), name)


def store_product_funnel(events: DataFrame, event_types: DataFrame, pages: DataFrame,
                         name: str = "agg_products") -> DataFrame:
    """``SELECT ... INTO agg_products``: materialise and read back."""
    from bizlens.sources import sinks

    return sinks.materialise(product_funnel(events, event_types, pages), name)


# Questions over the (small, one row per product) funnel table. Global windows
# are fine here: their input is the aggregated table, not the events.

def funnel_leaders(funnel: DataFrame) -> DataFrame:
    """The first product by views, by cart adds and by purchases (ties: by name): one aggregate of three rows."""
    counts = ["number_of_views", "added_to_cart", "purchased"]
    leaders = [F.min(F.struct((-F.col(c)).alias("o"), F.col("product_name"), *[F.col(x).alias(f"c_{x}") for x in counts]))
               for c in counts]
    rows = funnel.agg(F.array(*[F.struct(*[x["product_name"].alias("product_name")], *[x[f"c_{c}"].alias(c) for c in counts])
                                for x in leaders]).alias("l"))
    return rows.select(F.explode(F.array_distinct("l")).alias("l")).select("l.*").filter("product_name IS NOT NULL")


def most_abandoned(funnel: DataFrame) -> DataFrame:
    agg = funnel.groupBy("product_name").agg(F.max("abandoned").alias("most_abandoned"))
    return top_k(agg, [F.col("most_abandoned").desc(), F.col("product_name").asc()], 1)


def best_view_to_purchase(funnel: DataFrame) -> DataFrame:
    r = funnel.select("product_name", rounded(div(F.col("purchased") * 100, F.col("number_of_views")), 2).alias("purchase_per_view"))
    return top_k(r, [F.col("purchase_per_view").desc(), F.col("product_name").asc()], 1)


def _conversion(funnel: DataFrame, num: str, den: str, out: str, ratio_of_sums: bool) -> DataFrame:
    """Mean of per-product ratios (as written) or, with ``ratio_of_sums``,
    the ratio of the totals."""
    if ratio_of_sums:
        value = div(F.sum(num) * 100, F.sum(den))
    else:
        value = F.avg(div(F.col(num) * 100, F.col(den)))
    return funnel.agg(rounded(value, 2).alias(out))


def avg_view_to_cart(funnel: DataFrame, ratio_of_sums: bool = False) -> DataFrame:
    return _conversion(funnel, "added_to_cart", "number_of_views", "avg_cart_per_view", ratio_of_sums)


def avg_cart_to_purchase(funnel: DataFrame, ratio_of_sums: bool = False) -> DataFrame:
    return _conversion(funnel, "purchased", "added_to_cart", "avg_purchase_per_cart", ratio_of_sums)


def visit_campaigns(events: DataFrame, users: DataFrame, event_types: DataFrame, pages: DataFrame,
                    campaigns: DataFrame, name_chars: int | None = 1, by_visit_start: bool = False,
                    purchase_flag: bool = False, order_by: tuple[str, ...] = ("sequence_number",)) -> DataFrame:
    """One row per (user, visit, campaign) with event counts and the cart-add
    page names in sequence order.

    As written, the campaign is matched per *event* time (a visit crossing a
    campaign boundary splits into two rows), ``purchase`` counts purchase
    events and ``name_chars=1`` keeps the one-character cast of the names.
    Options: ``by_visit_start=True`` matches each visit once, on its start
    time; ``purchase_flag=True`` makes ``purchase`` a 1/0 flag;
    ``name_chars=None`` keeps full names.

    A visit is put together from its hours: counts, first time and the cart adds'
    text of each hour, then those of the visit, so that a robot's visit with
    millions of adds is many small lists.

    ``order_by`` names the columns that order a visit's cart adds. When the
    sequence number is itself defined as the (time, id) order inside a visit,
    passing those columns gives the same lists without materialising the
    per-visit numbering (one shuffle and sort of all events fewer).
    """
    e = (events.join(users, "cookie_id")
         .join(event_types, "event_type")
         .join(pages.select("page_id", "page_name"), "page_id"))
    camp = campaigns.select("campaign_name", "start_date", "end_date")
    keys = ["user_id", "visit_id"]
    if not by_visit_start:
        e = point_in_interval_join(e, "event_time", camp, "start_date", "end_date", "left")
        keys.append("campaign_name")
    t = F.col("event_type")
    cart_name = F.when(t == CART_ADD, F.col("page_name"))
    if name_chars is not None:
        cart_name = F.substring(cart_name, 1, name_chars)
    purchase = F.max(F.when(t == PURCHASE, 1).otherwise(0)) if purchase_flag else sum_if(t == PURCHASE)
    # the slices run along the first column of the order
    along = F.col(order_by[0])
    slice_ = F.date_trunc("hour", along) if order_by[0] == "event_time" else block_of(along, 1024)
    hours = e.withColumn("_slice", slice_).groupBy(*keys, "_slice").agg(
        F.min("event_time").alias("visit_start_time"),
        sum_if(t == VIEW).cast("bigint").alias("page_views"),
        sum_if(t == CART_ADD).cast("bigint").alias("cart_adds"),
        purchase.cast("bigint").alias("purchase"),
        sum_if(t == IMPRESSION).cast("bigint").alias("impression"),
        sum_if(t == CLICK).cast("bigint").alias("click"),
        ordered_join(cart_name, F.struct(*[F.col(c) for c in order_by])).alias("cart_products"),
    )
    whole = (F.max if purchase_flag else F.sum)("purchase")
    out = hours.groupBy(*keys).agg(
        F.min("visit_start_time").alias("visit_start_time"), whole.alias("purchase"),
        *[F.sum(c).alias(c) for c in ("page_views", "cart_adds", "impression", "click")],
        ordered_join(F.col("cart_products"), F.col("_slice")).alias("cart_products"))
    if by_visit_start:
        out = point_in_interval_join(out, "visit_start_time", camp, "start_date", "end_date", "left")
    return out.select("user_id", "visit_id", "visit_start_time", "page_views", "cart_adds", "purchase",
                      "campaign_name", "impression", "click", "cart_products")

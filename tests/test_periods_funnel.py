"""Retail periods and clickstream funnel on small hand-made inputs."""

import datetime as dt

import pytest

from bizlens.plans import cleaning, funnel, periods
from bizlens.sources import dimensions as dims
from tests.conftest import rows

D, T = dt.date, dt.datetime


@pytest.fixture(scope="module")
def weekly(spark):
    raw = spark.createDataFrame([
        ("25/5/98", "ASIA", "Retail", "C1", "New", 10, 1000),
        ("1/6/98", "ASIA", "Retail", "F3", "New", 10, 1200),
        ("15/6/98", "ASIA", "Shopify", "null", "Old", 5, 900),
        ("22/6/98", "EUROPE", "Retail", None, "Old", 4, 800),
        ("6/7/98", "EUROPE", "Retail", "C2", "New", 3, 333),
    ], "week_date string, region string, platform string, segment string, customer_type string, "
       "transactions int, sales long")
    return cleaning.clean_weekly_sales(raw)


def test_clean_weekly(weekly):
    got = rows(weekly, "dates_week", "week_number", "tot_week_number", "age_band", "demographic", "avg_transaction")
    assert got == [
        (D(1998, 5, 25), 4, 22, "Young Adults", "Couples", 100.0),
        (D(1998, 6, 1), 1, 23, "Retirees", "Families", 120.0),
        (D(1998, 6, 15), 3, 25, "Unknown", "Unknown", 180.0),
        (D(1998, 6, 22), 4, 26, "Unknown", "Unknown", 200.0),
        (D(1998, 7, 6), 1, 28, "Middle Aged", "Couples", 111.0),
    ]


def test_missing_weeks(weekly):
    assert rows(periods.missing_weeks(weekly)) == [(D(1998, 6, 8),), (D(1998, 6, 29),)]


def test_before_after(weekly):
    # pivot week is the first "after" week
    assert rows(periods.before_after(weekly, "1998-06-15", 4)) == [(2200, 2033, -167, -7.59)]
    got = rows(periods.compare_periods(weekly, "region", "1998-06-15", 4))
    # ASIA has rows on both sides, EUROPE only after -> dropped (inner semantics)
    assert got == [("ASIA", 2200, 900, -1300, -59.09)]


def test_shares(weekly):
    got = rows(periods.platform_share_by_month(weekly))
    assert got == [("july", 100.0, None), ("june", 69.0, 31.0), ("may", 100.0, None)]


@pytest.fixture(scope="module")
def clicks(spark):
    ev = spark.createDataFrame([
        # visit v1 of user 1 (cookie c1): views + adds, purchase, crosses the noon campaign boundary
        ("v1", "c1", 3, 1, 1, T(2024, 1, 20, 11, 0)),
        ("v1", "c1", 3, 2, 2, T(2024, 1, 20, 11, 5)),
        ("v1", "c1", 6, 2, 3, T(2024, 1, 20, 11, 6)),
        ("v1", "c1", 12, 1, 4, T(2024, 1, 20, 12, 30)),
        ("v1", "c1", 13, 3, 5, T(2024, 1, 20, 12, 31)),
        # visit v2 of user 2: adds product 3 and 4 without purchase
        ("v2", "c2", 3, 2, 1, T(2024, 1, 5, 9, 0)),
        ("v2", "c2", 4, 2, 2, T(2024, 1, 5, 9, 1)),
        ("v2", "c2", 6, 2, 3, T(2024, 1, 5, 9, 2)),
        ("v2", "c2", 1, 4, 4, T(2024, 1, 5, 9, 3)),
    ], "visit_id string, cookie_id string, page_id int, event_type int, sequence_number int, "
       "event_time timestamp_ntz")
    users = spark.createDataFrame([(1, "c1"), (2, "c2")], "user_id long, cookie_id string")
    return ev, users


def test_funnel(clicks, spark):
    ev, _ = clicks
    f = funnel.product_funnel(ev, dims.event_types(spark), dims.pages(spark))
    # Green Tea (page 3): 1 view, 2 adds (1 abandoned, 1 purchased); Espresso (page 6): 2 adds, 1/1;
    # Black Tea (page 4) has no purchased add -> dropped
    assert rows(f) == [("Espresso", 0, 2, 1, 1), ("Green Tea", 1, 2, 1, 1)]


def test_visit_campaigns_split(clicks, spark):
    ev, users = clicks
    got = rows(funnel.visit_campaigns(ev, users, dims.event_types(spark), dims.pages(spark), dims.campaigns(spark)),
               "visit_id", "campaign_name", "page_views", "cart_adds", "purchase", "impression", "cart_products")
    assert got == sorted([
        ("v1", "Midwinter Tasting", 1, 2, 0, 0, "G, E"),
        ("v1", "Cocoa Week", 1, 0, 1, 0, None),
        ("v2", "New Year Brew", 0, 3, 0, 1, "G, B, E"),
    ], key=lambda t: tuple(map(str, t)))


def test_funnel_options(clicks, spark):
    ev, users = clicks
    types, pages = dims.event_types(spark), dims.pages(spark)
    all_products = funnel.product_funnel(ev, types, pages, keep_all=True)
    assert ("Black Tea", 0, 1, 1, 0) in rows(all_products)
    f = funnel.product_funnel(ev, types, pages)
    # Espresso 0 views -> division by zero gives NULL ratio and is skipped by AVG; ratio of sums: 4 adds / 1 view
    assert rows(funnel.avg_cart_to_purchase(f)) == [(50.0,)]
    assert rows(funnel.avg_view_to_cart(f, ratio_of_sums=True)) == [(400.0,)]
    once = rows(funnel.visit_campaigns(ev, users, types, pages, dims.campaigns(spark), by_visit_start=True,
                                       purchase_flag=True), "visit_id", "campaign_name", "purchase", "cart_adds")
    assert once == [("v1", "Midwinter Tasting", 1, 2), ("v2", "New Year Brew", 0, 3)]
    # restricted: v1 viewed checkout (page 12) and purchased -> 0% without purchase
    assert rows(funnel.checkout_no_purchase_pct(ev, types, pages, restricted=True)) == [(0.0,)]

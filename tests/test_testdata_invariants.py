"""Invariants of the registered jobs on the driver's smallest testdata."""

import pytest

import __spark_entry__ as E
from bizlens.sources import sinks

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def q():
    return E.queries()


def test_funnel_adds_split(spark, q):
    for name in ("product_funnel", "category_funnel"):
        for r in q[name](spark, SF).collect():
            assert r.abandoned + r.purchased == r.added_to_cart


def test_shares_sum_to_100(spark, q):
    for r in q["demographic_share_by_year"](spark, SF).collect():
        assert abs(sum(v or 0 for v in (r.couples_percent, r.families_percent, r.unknown_percent)) - 100) <= 2
    for r in q["platform_share_by_month"](spark, SF).collect():
        assert abs(sum(v or 0 for v in (r.retail_percent, r.shopify_percent)) - 100) <= 1


def test_running_balance_ends_at_total(spark, q):
    from pyspark.sql import functions as F

    from bizlens.sources import bindings as b

    bal = q["running_month_balance"](spark, SF)
    last = bal.groupBy("customer_id").agg(F.max_by("balance", "month_").alias("last"))
    t = b.v_customer_transactions(spark, SF)
    total = t.groupBy("customer_id").agg(F.sum(F.when(F.col("txn_type") == "deposit", F.col("txn_amount"))
                                               .otherwise(-F.col("txn_amount"))).cast("double").alias("tot"))
    bad = last.join(total, "customer_id").filter(F.abs(F.col("last") - F.col("tot")) > 1e-6).count()
    assert bad == 0


def test_ratings_ids_dense(spark, q):
    ids = sorted(r.id for r in q["ratings_table"](spark, SF).select("id").collect())
    assert ids == list(range(1, len(ids) + 1))


def test_registered_views_answer_sql(spark):
    names = sinks.register_views(spark, SF)
    assert "v_sales" in names and "clean_orders" in names
    got = spark.sql("SELECT COUNT(*) AS n FROM clean_orders WHERE exclusions = 'null'").collect()[0].n
    assert got == 0

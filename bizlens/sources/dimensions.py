"""Literal dimension tables.

Small fixed lookups are built as SQL ``VALUES`` -- a local relation whose size
is known when the plan is built (so broadcasting them is always safe) and
which needs no Python worker to scan.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

# ---------------------------------------------------------------------------
# Fixed values. The label texts below are part of the questions' definitions
# and must be reproduced exactly.
# ---------------------------------------------------------------------------

# Event codes of the clickstream: 1 page view, 2 cart add, 3 purchase,
# 4 ad impression, 5 ad click.
EVENT_TYPES = [
    (1, "Page View"),
    (2, "Add to Cart"),
    (3, "Purchase"),
    (4, "Ad Impression"),
    (5, "Ad Click"),
]

# Segment decoding of the retail cleaning step.
AGE_BANDS = {"1": "Young Adults", "2": "Middle Aged", "3": "Retirees", "4": "Retirees"}
DEMOGRAPHICS = {"C": "Couples", "F": "Families"}
UNKNOWN = "Unknown"

# Subscription plans: id, name, monthly price (churn has no price).
PLANS = [
    (0, "trial", "0.00"),
    (1, "basic monthly", "9.90"),
    (2, "pro monthly", "19.90"),
    (3, "pro annual", "199.00"),
    (4, "churn", None),
]

# ---------------------------------------------------------------------------
# Our own wording for the testdata bindings (not taken from the reference).
# ---------------------------------------------------------------------------

# Web shop pages: 1 home, 2 listing, 3-11 nine products in three
# categories, 12 checkout, 13 confirmation.
PAGES = [
    (1, "Home Page", None, None),
    (2, "All Products", None, None),
    (3, "Green Tea", "Tea", 1),
    (4, "Black Tea", "Tea", 2),
    (5, "Herbal Tea", "Tea", 3),
    (6, "Espresso", "Coffee", 4),
    (7, "Filter Roast", "Coffee", 5),
    (8, "Cold Brew", "Coffee", 6),
    (9, "Dark Cocoa", "Cocoa", 7),
    (10, "Milk Cocoa", "Cocoa", 8),
    (11, "White Cocoa", "Cocoa", 9),
    (12, "Checkout", None, None),
    (13, "Confirmation", None, None),
]

# Three campaigns inside January 2024; one boundary falls at noon so that a
# visit on that day is split between two campaigns.
CAMPAIGNS = [
    ("New Year Brew", dt.datetime(2024, 1, 1, 0, 0, 0), dt.datetime(2024, 1, 9, 23, 59, 59)),
    ("Midwinter Tasting", dt.datetime(2024, 1, 10, 0, 0, 0), dt.datetime(2024, 1, 20, 12, 0, 0)),
    ("Cocoa Week", dt.datetime(2024, 1, 20, 12, 0, 1), dt.datetime(2024, 1, 27, 23, 59, 59)),
]

# The product that extend_menu adds; its id is beyond those of the part types.
NEW_PIZZA = (1000, "Everything")


def _lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, dt.datetime):
        return "'" + v.strftime("%Y-%m-%d %H:%M:%S") + "'"
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(v)


def literal_table(spark: SparkSession, rows: list[tuple], columns: list[tuple[str, str]]) -> DataFrame:
    """``SELECT CAST(...) ... FROM VALUES (...)`` for a fixed list of rows."""
    values = ", ".join("(" + ", ".join(_lit(v) for v in r) + ")" for r in rows)
    raw = [f"c{i}" for i in range(len(columns))]
    sel = ", ".join(f"CAST({r} AS {t}) AS {n}" for r, (n, t) in zip(raw, columns))
    return spark.sql(f"SELECT {sel} FROM VALUES {values} AS t({', '.join(raw)})")


def event_types(spark: SparkSession) -> DataFrame:
    return literal_table(spark, EVENT_TYPES, [("event_type", "INT"), ("event_name", "STRING")])


def plans(spark: SparkSession) -> DataFrame:
    return literal_table(spark, PLANS, [("plan_id", "INT"), ("plan_name", "STRING"), ("price", "DECIMAL(5,2)")])


def pages(spark: SparkSession) -> DataFrame:
    return literal_table(spark, PAGES, [("page_id", "INT"), ("page_name", "STRING"),
                                        ("product_category", "STRING"), ("product_id", "INT")])


def campaigns(spark: SparkSession) -> DataFrame:
    return literal_table(spark, CAMPAIGNS, [("campaign_name", "STRING"), ("start_date", "TIMESTAMP_NTZ"),
                                            ("end_date", "TIMESTAMP_NTZ")])

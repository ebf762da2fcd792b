"""Subscription journeys: each customer's plan history with the next plan,
the time to it, and the kind of change."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bizlens.operators.scan import month_of, scan

TRIAL, BASIC, PRO_MONTHLY, PRO_ANNUAL, CHURN = 0, 1, 2, 3, 4


def customer_journey(subscriptions: DataFrame, plans: DataFrame) -> DataFrame:
    """One row per (customer, plan start): step number, next plan, days until
    it and the transition (continued / downgraded / upgraded / cancelled).

    After a trial: basic -> downgraded, pro monthly -> continued, pro annual
    -> upgraded, churn -> cancelled; later moves compare plan ids.

    Works on distinct (customer, start, plan) rows, in slices of a month.
    """
    names = plans.select("plan_id", "plan_name")
    subs = subscriptions.select("customer_id", "plan_id", "start_date").distinct()
    steps = scan(subs.withColumn("_month", month_of("start_date")), ["customer_id"], "_month", ["start_date", "plan_id"],
                 sums={"step": F.lit(1)}, leads={"_next": "plan_id", "_next_start": "start_date"})
    cur, nxt = F.col("plan_id"), F.col("_next")
    after_trial = (F.when(nxt == BASIC, "downgraded").when(nxt == PRO_MONTHLY, "continued")
                   .when(nxt == PRO_ANNUAL, "upgraded").otherwise("continued"))
    transition = (
        F.when(nxt.isNull(), F.lit(None).cast("string"))
        .when(nxt == CHURN, "cancelled")
        .when(cur == TRIAL, after_trial)
        .when(nxt > cur, "upgraded")
        .when(nxt < cur, "downgraded")
        .otherwise("continued")
    )
    next_names = plans.select(F.col("plan_id").alias("_next"), F.col("plan_name").alias("next_plan"))
    return (
        steps.join(names, "plan_id")
        .join(next_names, "_next", "left")
        .select(
            "customer_id", F.col("step").cast("bigint").alias("step"), "plan_name", "start_date", "next_plan",
            F.datediff("_next_start", "start_date").alias("elapsed_days"), transition.alias("transition"),
        )
    )

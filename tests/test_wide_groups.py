"""Ranks, percentiles, ordered text, range joins and NOT IN where one group, value or interval is large."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from bizlens import catalog
from bizlens.operators.aggregate import percentile_disc
from bizlens.operators.joins import not_in, point_in_interval_join
from bizlens.operators.ranking import keep_rank_one, rank_globally
from bizlens.plans import funnel
from tests.conftest import rows

SF = "/root/testdata/sf0.001"


# --- ranks -------------------------------------------------------------------

@pytest.mark.parametrize("descending", [False, True])
def test_global_ranks_with_ties(spark, descending):
    rnd = random.Random(4)
    values = [rnd.choice([None, 7, 7, 7, rnd.randrange(60)]) for _ in range(500)]
    df = spark.createDataFrame(list(enumerate(values)), "id int, v int").repartition(5)
    w = Window.orderBy(F.col("v").desc() if descending else F.col("v"))
    want = df.select("id", "v", F.rank().over(w).cast("long").alias("r"), F.dense_rank().over(w).cast("long").alias("d"))
    got = rank_globally(rank_globally(df, "v", "r", descending), "v", "d", descending, dense=True)
    assert rows(got, "id", "v", "r", "d") == rows(want)
    assert rank_globally(df.filter("id < 0"), "v").count() == 0
    top = sorted(i for i, v in enumerate(values) if v == max(x for x in values if x is not None))
    assert [r[0] for r in rows(keep_rank_one(df, "v"), "id")] == sorted(top, key=str)


def single_partition_reads(spark, name):
    """What stands below each exchange to one partition: an aggregate's rows are one per task and group."""
    plan = catalog.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString().split("\n")
    return [plan[i + 1].lstrip(" :+-*()0123456789") for i, line in enumerate(plan) if "Exchange SinglePartition" in line]


@pytest.mark.parametrize("name", ["segment_rank", "top_extra", "top_exclusion", "funnel_leaders"])
def test_no_rank_sorts_all_rows_in_one_task(spark, name):
    for op in single_partition_reads(spark, name):
        one_per_task = "partial_" in op and ("keys=[]" in op or "key=[]" in op)
        assert one_per_task or "(keys=[_slice#" in op, op


# --- percentiles -------------------------------------------------------------

def test_percentile_of_a_million_values(spark):
    """One group with a million distinct values beside small ones, a NULL group, weights and NULL values."""
    n = 1_000_000
    big = spark.range(n).select(F.lit("big").alias("g"), (F.col("id") * 3).alias("v"), F.lit(1).alias("w"))
    rnd = random.Random(2)
    small = [(rnd.choice(["a", "b", None]), rnd.choice([None, rnd.randrange(9)]), rnd.randint(1, 5)) for _ in range(200)]
    df = big.unionByName(spark.createDataFrame(small, "g string, v long, w int"))
    fractions = {"p0": 0.0, "p50": 0.5, "p80": 0.8, "p100": 1.0}
    got = {r.g: tuple(r[f] for f in fractions) for r in percentile_disc(df, ["g"], "v", "w", fractions).collect()}
    assert got["big"] == tuple(3 * (max(1, math.ceil(p * n)) - 1) for p in fractions.values())
    for g in ("a", "b", None):
        values = sorted(v for k, v, w in small if k == g and v is not None for _ in range(w))
        assert got[g] == tuple(values[max(1, math.ceil(round(p * len(values), 9))) - 1] for p in fractions.values())
    assert percentile_disc(df.filter("g = 'none'"), ["g"], "v", None, fractions).count() == 0


# --- ordered text ------------------------------------------------------------

def visit_inputs(spark, adds):
    start = F.lit("2020-01-01 00:00:00").cast("timestamp_ntz")
    robot = spark.range(adds).select(
        F.lit("r").alias("visit_id"), F.lit("c1").alias("cookie_id"), (F.col("id") % 3 + 1).cast("int").alias("page_id"),
        F.lit(funnel.CART_ADD).alias("event_type"), F.timestamp_add("MILLISECOND", F.col("id") * 80, start).alias("event_time"),
        F.col("id").alias("event_id"))
    people = spark.createDataFrame([("p", "c2", 1, funnel.CART_ADD, dt.datetime(2020, 1, 1, 23, 59), 5),
                                    ("p", "c2", 2, funnel.CART_ADD, dt.datetime(2020, 1, 1, 0, 1), 9),
                                    ("p", "c2", 3, funnel.VIEW, dt.datetime(2020, 1, 1, 0, 0), 7)],
                                   "visit_id string, cookie_id string, page_id int, event_type int, event_time timestamp_ntz, event_id long")
    users = spark.createDataFrame([("c1", 1), ("c2", 2)], "cookie_id string, user_id int")
    types = spark.createDataFrame([(k, f"t{k}") for k in range(1, 6)], "event_type int, event_name string")
    pages = spark.createDataFrame([(1, "Apple"), (2, "Bread"), (3, "Corn")], "page_id int, page_name string")
    camp = spark.createDataFrame([("day", dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 2))],
                                 "campaign_name string, start_date timestamp_ntz, end_date timestamp_ntz")
    return robot.unionByName(people), users, types, pages, camp


def test_a_visit_of_a_million_adds(spark):
    n = 1_000_000
    out = funnel.visit_campaigns(*visit_inputs(spark, n), order_by=("event_time", "event_id"))
    got = {r.visit_id: r for r in out.collect()}
    assert got["r"].cart_adds == n and got["r"].cart_products == ", ".join("ABC"[k % 3] for k in range(n))
    assert (got["p"].cart_products, got["p"].page_views, got["p"].visit_start_time) == ("B, A", 1, dt.datetime(2020, 1, 1))
    hours = [line for line in out._jdf.queryExecution().executedPlan().toString().split("\n")
             if "collect_list" in line and "event_time" in line and "keys=[" in line]
    assert hours and all("_slice" in line.split("functions=")[0] for line in hours)


# --- intervals ---------------------------------------------------------------

def random_intervals(rnd, n):
    out = []
    for k in range(n):
        a = dt.datetime(2020, 1, 1) + dt.timedelta(microseconds=rnd.randrange(10 ** 13))
        length = rnd.choice([0, 1, 10 ** 6, 86_400 * 10 ** 6, 400 * 86_400 * 10 ** 6])  # an instant to more than a year
        out.append((f"i{k}", a, a + dt.timedelta(microseconds=rnd.randrange(length + 1))))
    return out + [("ever", dt.datetime(1, 1, 1), dt.datetime(9999, 12, 31, 23, 59, 59, 999999)), ("none", dt.datetime(2021, 1, 1), None),
                  ("back", dt.datetime(2021, 1, 2), dt.datetime(2021, 1, 1)), ("i0", *out[0][1:])]


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_intervals_of_any_length(spark, threshold):
    rnd = random.Random(8)
    intervals = random_intervals(rnd, 60)
    edges = [t for _, a, b in intervals[:60] for t in (a, b)]  # those in the middle of the calendar
    times = [rnd.choice(edges) + dt.timedelta(microseconds=rnd.choice([-1, 0, 1])) if rnd.random() < 0.6 else
             dt.datetime(2020, 1, 1) + dt.timedelta(microseconds=rnd.randrange(10 ** 13)) for _ in range(300)]
    times += [None, times[0], times[0], dt.datetime(1, 1, 1), dt.datetime(9999, 12, 31, 23, 59, 59, 999999)]
    facts = spark.createDataFrame(list(enumerate(times)), "id int, ts timestamp_ntz")
    iv = spark.createDataFrame(intervals, "name string, s timestamp_ntz, e timestamp_ntz")
    want = []
    for k, t in enumerate(times):
        found = [n for n, a, b in intervals if t is not None and b is not None and a <= t <= b]
        want += [(k, n) for n in found or [None]]
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        left = point_in_interval_join(facts, "ts", iv, "s", "e")
        assert left.columns == ["id", "ts", "name", "s", "e"]
        assert rows(left, "id", "name") == sorted(want, key=lambda t: tuple(map(str, t)))
        inner = point_in_interval_join(facts, "ts", iv, "s", "e", "inner")
        assert rows(inner, "id", "name") == sorted([w for w in want if w[1]], key=lambda t: tuple(map(str, t)))
        assert point_in_interval_join(facts, "ts", iv.filter("name = '-'"), "s", "e").count() == len(times)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_intervals_of_dates_and_zoned_times(spark, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        facts = spark.sql("SELECT id, timestamp'2024-03-09 22:00:00' + make_interval(0, 0, 0, 0, id) AS ts, "
                          "date'2024-03-09' + CAST(id AS INT) AS d FROM range(12)")
        iv = spark.sql("SELECT timestamp'2024-03-10 01:30:00' AS s, timestamp'2024-03-10 05:00:00' AS e, "
                       "date'2024-03-10' AS a, date'2024-03-12' AS b")
        assert rows(point_in_interval_join(facts, "ts", iv, "s", "e", "inner"), "id") == rows(
            facts.join(iv, F.col("ts").between(F.col("s"), F.col("e"))), "id")
        assert rows(point_in_interval_join(facts, "d", iv, "a", "b", "inner"), "id") == [(1,), (2,), (3,)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


# --- NOT IN ------------------------------------------------------------------

@pytest.mark.parametrize("listed", [[], [1, 2], [1, None], [None], [5, 5, 9]])
def test_not_in_is_that_of_sql(spark, listed):
    df = spark.createDataFrame([(1,), (2,), (None,), (3,), (3,)], "v int")
    values = spark.createDataFrame([(x,) for x in listed], "x int")
    df.createOrReplaceTempView("not_in_rows")
    values.createOrReplaceTempView("not_in_list")
    want = spark.sql("SELECT v FROM not_in_rows WHERE v NOT IN (SELECT x FROM not_in_list)")
    got = not_in(df, "v", values, "x")
    assert rows(got) == rows(want)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan and "isnull" not in plan.split("BroadcastHashJoin")[-1][:60]


def test_not_in_by_group(spark):
    df = spark.createDataFrame([(g, v) for g in ("a", "b", None, "d") for v in (1, 2, None)], "g string, v int")
    values = spark.createDataFrame([("a", 1), ("b", None), ("b", 2), (None, 2)], "g string, v int")
    want = [("a", 2), (None, 1), ("d", 1), ("d", 2), ("d", None)]
    assert rows(not_in(df, "v", values, by=["g"])) == sorted(want, key=lambda t: tuple(map(str, t)))

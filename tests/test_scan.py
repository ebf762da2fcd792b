"""Sliced scans against plain windows, with a hot key."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from bizlens.operators.scan import block_of, moving, month_of, range_slices, scan
from bizlens.plans import ledger



def data(spark, seed, n=900):
    """A third of the rows on one key; NULL keys, values and orders."""
    rnd, rows = random.Random(seed), set()
    for _ in range(n):
        k = rnd.choice([1, 1, 1, None, 2, 3, 4, rnd.randrange(5, 40)])
        rows.add((k, rnd.choice(["a", None]), rnd.choice([None, *range(60)]), rnd.randrange(40)))
    rows = [(*r, rnd.choice([None, rnd.randrange(-50, 50)]), rnd.choice([None, None, f"v{rnd.randrange(9)}"])) for r in rows]
    return spark.createDataFrame(rows, "k int, g string, t int, u int, x int, name string").repartition(4)


def plain(df, before):
    w = Window.partitionBy("k", "g").orderBy("t", "u")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    return df.select(
        "k", "g", "t", "u", F.sum("x").over(upto).alias("total"), F.row_number().over(w).cast("long").alias("nth"),
        F.lag("x").over(w).alias("prev"), F.lead("name").over(w).alias("next"), F.lag("t").over(w).alias("before"),
        F.last("name", True).over(upto).alias("known"), F.first("x").over(upto).alias("first"),
        F.sum("x").over(w.rowsBetween(-before, 0)).alias("near"), F.count("name").over(w.rowsBetween(-before, 0)).alias("names"))


def sliced(df, slice_, before):
    out = scan(df.withColumn("s", slice_), ["k", "g"], "s", ["t", "u"], sums={"total": "x", "nth": F.lit(1)},
               lags={"prev": "x", "before": "t"}, leads={"next": "name"}, lasts={"known": "name"}, firsts={"first": "x"})
    out = moving(out, ["k", "g"], "s", ["t", "u"], before, {"near": F.sum("x"), "names": F.count("name")})
    return out.drop("x", "name", "s")


def same(a, b):
    cols = sorted(b.columns)
    assert sorted(a.columns) == cols
    rows = [sorted(map(tuple, d.select(cols).collect()), key=str) for d in (a, b)]
    assert rows[0] == rows[1] and rows[0]


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("size,before", [(1, 3), (7, 10), (1000, 2)])
def test_scan_equals_windows(spark, seed, size, before):
    df = data(spark, seed)
    same(sliced(df, block_of("t", size), before), plain(df, before))


def test_ranges_of_equal_size(spark):
    """Any order is cut into stored ranges; a third of the rows on one key are not in one slice."""
    df = data(spark, 7, 3000)
    cut = range_slices(df, ["k", "g"], ["t", "u"], "s", slices=12)
    assert sorted(cut.columns) == sorted([*df.columns, "s"]) and cut.count() == df.count()
    sizes = [r["count"] for r in cut.groupBy("s").count().collect()]
    assert max(sizes) < df.count() / 4
    out = scan(cut, ["k", "g"], "s", ["t", "u"], sums={"total": "x"}, lags={"prev": "x"})
    same(out.select("k", "g", "t", "u", "total", "prev"), plain(df, 1).select("k", "g", "t", "u", "total", "prev"))


def test_single_order_column_and_empty(spark):
    df = spark.createDataFrame([(1, None, 5, "a"), (1, 3, None, None), (1, 9, 2, None), (2, None, None, "z")],
                               "k int, t int, x int, name string")
    w = Window.partitionBy("k").orderBy("t")
    for size in (1, 4, 100):
        got = scan(df.withColumn("s", block_of("t", size)), ["k"], "s", ["t"], sums={"total": "x"}, lags={"prev": "x"},
                   leads={"next": "t"}, lasts={"known": "name"}, firsts={"first": "x"}).drop("s")
        upto = w.rowsBetween(Window.unboundedPreceding, 0)
        want = df.select("*", F.sum("x").over(upto).alias("total"), F.lag("x").over(w).alias("prev"), F.lead("t").over(w).alias("next"),
                         F.last("name", True).over(upto).alias("known"), F.first("x").over(upto).alias("first"))
        same(got, want)
    none = df.filter("k > 5").withColumn("s", block_of("t", 4))
    assert scan(none, ["k"], "s", ["t"], sums={"total": "x"}).count() == 0
    assert moving(none, ["k"], "s", ["t"], 3, {"near": F.sum("x")}).count() == 0


def windows_of(df):
    """The partition keys of the windows in a plan that rows of any number reach."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.split("\n") if "windowspecdefinition" in line]


def hot_transactions(spark):
    """A third of all rows on one customer, twenty a day for years."""
    rows = spark.range(40_000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 500).alias("customer_id"),
        F.date_add(F.lit("2015-01-01").cast("date"), (F.col("id") * 7919 % 2000).cast("int")).alias("txn_date"),
        F.element_at(F.array(*map(F.lit, ("deposit", "purchase", "withdrawal"))), (F.col("id") % 3 + 1).cast("int")).alias("txn_type"),
        (F.col("id") * 31 % 997).cast("decimal(18,2)").alias("txn_amount"))
    return rows


def test_a_hot_customer_is_cut_by_month(spark):
    txn = hot_transactions(spark)
    days = txn.select("customer_id", "txn_date").distinct()
    slices = days.groupBy("customer_id", month_of("txn_date").alias("m")).count()
    assert days.filter("customer_id = 1").count() > 1500 and slices.agg(F.max("count")).first()[0] <= 31
    for job in (ledger.running_balance, ledger.data_allocation, ledger.balance_statistics):
        for line in windows_of(job(txn)):
            if "scan_" in line and "sum(" in line:
                assert "month" in line or "block" in line or "slice" in line, line


def test_running_balance_of_a_hot_customer(spark):
    txn = hot_transactions(spark)
    signed = F.when(F.col("txn_type") == "deposit", F.col("txn_amount")).otherwise(-F.col("txn_amount"))
    w = Window.partitionBy("customer_id").orderBy("txn_date")
    want = txn.select("customer_id", "txn_date", "txn_type", F.col("txn_amount").cast("double").alias("txn_amount"),
                      F.sum(signed).over(w).cast("double").alias("balance"))
    same(ledger.running_balance(txn), want)

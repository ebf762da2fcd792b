"""Randomised checks of the skew-safe operators against direct definitions,
with one hot key holding about a third of the rows."""

import math
import random

import pandas as pd
import pytest

from bizlens.operators.aggregate import percentile_disc
from bizlens.operators.ranking import first_by, rank_by_value, rows_at_extreme


def _data(seed: int, n: int = 600):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        key = "hot" if rnd.random() < 0.33 else f"k{rnd.randint(0, 40)}"
        out.append((key, rnd.randint(0, 25), rnd.choice("abc")))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_rank_by_value_is_sql_rank(spark, seed):
    rows = _data(seed)
    df = spark.createDataFrame(rows, "k string, v int, p string")
    got = sorted(tuple(r) for r in rank_by_value(df, ["k"], "v", "r").collect())
    pdf = pd.DataFrame(rows, columns=["k", "v", "p"])
    pdf["r"] = pdf.groupby("k")["v"].rank(method="min").astype(int)
    assert got == sorted(map(tuple, pdf.itertuples(index=False)))


@pytest.mark.parametrize("seed", [4, 5])
def test_rows_at_extreme_and_first_by(spark, seed):
    rows = _data(seed)
    df = spark.createDataFrame(rows, "k string, v int, p string")
    pdf = pd.DataFrame(rows, columns=["k", "v", "p"])
    for how in ("min", "max"):
        ext = pdf.groupby("k")["v"].transform(how)
        want = sorted(map(tuple, pdf[pdf.v == ext].itertuples(index=False)))
        assert sorted(tuple(r) for r in rows_at_extreme(df, ["k"], "v", how).collect()) == want
    first = pdf.sort_values(["v", "p"]).groupby("k").head(1)
    assert sorted(tuple(r) for r in first_by(df, ["k"], ["v", "p"]).collect()) == sorted(
        map(tuple, first.itertuples(index=False)))


@pytest.mark.parametrize("seed", [6, 7])
def test_percentile_disc_with_weights(spark, seed):
    rnd = random.Random(seed)
    rows = [(rnd.choice(["hot", "hot", "a", "b"]), rnd.randint(0, 30), rnd.randint(1, 4)) for _ in range(300)]
    df = spark.createDataFrame(rows, "g string, v int, w long")
    fr = {"p50": 0.5, "p80": 0.8, "p95": 0.95}
    got = {r.g: (r.p50, r.p80, r.p95) for r in percentile_disc(df, ["g"], "v", "w", fr).collect()}
    for g in {r[0] for r in rows}:
        values = sorted(v for gg, v, w in rows if gg == g for _ in range(w))
        want = tuple(values[max(math.ceil(p * len(values)), 1) - 1] for p in fr.values())
        assert got[g] == want


def test_member_jobs_with_hot_customer(spark):
    """Member jobs (counted sales, weighted ranks, re-expansion) against pandas."""
    import datetime as dt

    from bizlens.plans import loyalty

    rnd = random.Random(11)
    base = dt.date(2021, 1, 1)
    sales = [("hot" if rnd.random() < 0.34 else f"c{rnd.randint(0, 20)}",
              base + dt.timedelta(days=rnd.randint(0, 30)), rnd.randint(1, 3)) for _ in range(900)]
    members = [("hot", base + dt.timedelta(days=10))] + [(f"c{i}", base + dt.timedelta(days=i)) for i in range(0, 20, 2)]
    menu = [(1, "a", 10), (2, "b", 15), (3, "c", 12)]
    s = spark.createDataFrame(sales, "customer_id string, order_date date, product_id int")
    b = spark.createDataFrame(members, "customer_id string, join_date date")
    m = spark.createDataFrame(menu, "product_id int, product_name string, price int")

    ps = pd.DataFrame(sales, columns=["customer_id", "order_date", "product_id"])
    pj = ps.merge(pd.DataFrame(menu, columns=["product_id", "product_name", "price"]), on="product_id").merge(
        pd.DataFrame(members, columns=["customer_id", "join_date"]), on="customer_id")
    pj["member"] = ["Y" if o >= j else "N" for o, j in zip(pj.order_date, pj.join_date)]
    pj["r"] = pj.groupby(["customer_id", "member"])["order_date"].rank(method="min").astype(int)
    want = sorted((c, o, n, p, mb, r if mb == "Y" else None)
                  for c, o, n, p, mb, r in pj[["customer_id", "order_date", "product_name", "price", "member",
                                               "r"]].itertuples(index=False))
    got = sorted(tuple(x) for x in loyalty.member_order_rank(s, b, m).collect())
    assert got == want

    after = pj[pj.order_date >= pj.join_date]
    first = after[after.order_date == after.groupby("customer_id")["order_date"].transform("min")]
    assert sorted(tuple(x) for x in loyalty.first_item_as_member(s, b, m).collect()) == sorted(
        zip(first.customer_id, first.product_name))
    assert loyalty.sales_with_member_flag(s, b, m).count() == len(sales)

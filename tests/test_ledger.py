"""Ledger jobs against brute-force pandas computations on a random fixture."""

import datetime as dt
import math
import random
from decimal import Decimal

import pandas as pd
import pytest

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bizlens.functions.numeric import rounded
from bizlens.plans import ledger
from bizlens.plans.ledger import _signed
from tests.conftest import rows


def data_allocation_expanded(txn: DataFrame, window_rows: int = 31, min_rows: int = 30,
                             per_day: bool = False) -> DataFrame:
    """Monthly data need when each customer gets the mean balance of the last
    ``window_rows`` ledger rows; no allocation before row ``min_rows`` and
    negative means clamp to 0. Then the max per customer-month and the sum
    per month.

    The ledger has one row per calendar day from a customer's first to last
    transaction day, except that a day with k transactions has k rows; all
    rows of a day carry the day's closing balance.

    Plan: transactions are reduced to one row per (customer, day) -- count and
    net amount -- and the running balance and next transaction day come from
    a window over those days. The calendar is then generated in place
    (``array_repeat`` for the k rows of a transaction day, ``sequence`` for the
    empty days up to the next one) *after* the last shuffle, so no calendar
    row is ever shuffled or joined; the moving mean reuses the same
    partitioning (customer) and only sorts.
    """
    signed = txn.select("customer_id", F.col("txn_date").alias("day"), _signed(txn).alias("amt"))
    days = signed.groupBy("customer_id", "day").agg(F.count(F.lit(1)).alias("_k"), F.sum("amt").alias("_net"))
    w = Window.partitionBy("customer_id").orderBy("day")
    if per_day:
        days = days.withColumn("_k", F.lit(1).cast("long"))
    days = days.select(
        "customer_id", "day", "_k",
        F.sum("_net").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("balance"),
        F.lead("day").over(w).alias("_next"),
    )
    gap = F.when(F.datediff("_next", "day") > 1, F.sequence(F.date_add("day", 1), F.date_sub("_next", 1)))
    rows = F.concat(F.array_repeat(F.col("day"), F.col("_k").cast("int")),
                    F.coalesce(gap, F.array().cast("array<date>")))
    ledger = days.select("customer_id", F.col("balance").cast("double").alias("balance"),
                         F.explode(rows).alias("day"))
    framed = w.rowsBetween(-(window_rows - 1), 0)
    scored = ledger.select(
        "customer_id", "day",
        F.avg("balance").over(framed).alias("_avg"),
        F.row_number().over(w).alias("_row"),
    )
    storage = (F.when(F.col("_row") < min_rows, F.lit(None).cast("double"))
               .when(F.col("_avg") < 0, F.lit(0.0)).otherwise(F.col("_avg")))
    per_month = scored.groupBy("customer_id", F.trunc("day", "month").alias("month")).agg(
        F.max(storage).alias("_alloc"))
    return per_month.groupBy("month").agg(rounded(F.sum("_alloc"), 1).alias("total_allocation"))


@pytest.fixture(scope="module")
def txn_rows():
    rnd = random.Random(7)
    out = []
    for c in range(1, 41):
        start = dt.date(2020, 1, 1) + dt.timedelta(days=rnd.randint(0, 40))
        for _ in range(rnd.randint(1, 25)):
            day = start + dt.timedelta(days=rnd.randint(0, 120))
            kind = rnd.choice(["deposit", "deposit", "purchase", "withdrawal"])
            out.append((c, day, kind, Decimal(rnd.randint(1, 900))))
    # a hot customer with many same-day transactions
    for _ in range(60):
        out.append((99, dt.date(2020, 3, 1) + dt.timedelta(days=rnd.randint(0, 3)), "deposit", Decimal(5)))
    return out


@pytest.fixture(scope="module")
def txn(spark, txn_rows):
    return spark.createDataFrame(txn_rows, "customer_id int, txn_date date, txn_type string, txn_amount decimal(18,2)")


def brute_allocation(txn_rows):
    df = pd.DataFrame(txn_rows, columns=["c", "d", "t", "a"])
    df["s"] = [float(a) if t == "deposit" else -float(a) for t, a in zip(df.t, df.a)]
    totals: dict = {}
    for c, g in df.groupby("c"):
        ledger_rows = []
        day, last = g.d.min(), g.d.max()
        bal = 0.0
        while day <= last:
            todays = g[g.d == day]
            bal += todays.s.sum()
            ledger_rows += [(day, bal)] * max(len(todays), 1)
            day += dt.timedelta(days=1)
        per_month: dict = {}
        for i, (d, _) in enumerate(ledger_rows):
            win = [b for _, b in ledger_rows[max(0, i - 30): i + 1]]
            avg = sum(win) / len(win)
            store = None if i + 1 < 30 else max(avg, 0.0)
            key = d.replace(day=1)
            cur = per_month.get(key)
            if store is not None:
                per_month[key] = store if cur is None else max(cur, store)
            else:
                per_month.setdefault(key, None)
        for k, v in per_month.items():
            cur = totals.get(k)
            if v is not None:
                totals[k] = v if cur is None else cur + v
            else:
                totals.setdefault(k, None)
    return {k: (None if v is None else round(v + 0.0, 1)) for k, v in totals.items()}


def test_data_allocation_matches_brute_force(txn, txn_rows):
    got = dict(rows(ledger.data_allocation(txn)))
    want = brute_allocation(txn_rows)
    assert set(got) == set(want)
    for k in want:
        if want[k] is None:
            assert got[k] is None
        else:
            assert got[k] == pytest.approx(want[k], abs=0.051)


def test_running_balance_invariant(txn, txn_rows):
    """The running balance at each customer's last month equals the signed total."""
    got = ledger.running_month_balance(txn).toPandas()
    last = got.sort_values("month_").groupby("customer_id").tail(1).set_index("customer_id")["balance"]
    df = pd.DataFrame(txn_rows, columns=["c", "d", "t", "a"])
    df["s"] = [float(a) if t == "deposit" else -float(a) for t, a in zip(df.t, df.a)]
    want = df.groupby("c").s.sum()
    for c, v in want.items():
        assert last[c] == pytest.approx(v)


def test_reallocation_stats(spark):
    rnd = random.Random(3)
    data = []
    for c in range(1, 30):
        region = c % 3
        for _ in range(rnd.randint(1, 12)):
            data.append((c, region, rnd.randint(1, 5), dt.date(2020, 1, 1) + dt.timedelta(days=rnd.randint(0, 60))))
    nodes = spark.createDataFrame(data, "customer_id int, region_id int, node_id int, start_date date")
    regions = spark.createDataFrame([(0, "R0"), (1, "R1"), (2, "R2")], "region_id int, region_name string")
    gaps: dict = {0: [], 1: [], 2: []}
    all_gaps = []
    for c in {r[0] for r in data}:
        ds = sorted(r[3] for r in data if r[0] == c)
        g = [(b - a).days for a, b in zip(ds, ds[1:])]
        gaps[c % 3] += g
        all_gaps += g
    avg = rows(ledger.avg_reallocation_days(nodes))[0][0]
    assert avg == pytest.approx(round(sum(all_gaps) / len(all_gaps) + 1e-12, 1))
    got = {r.region_name: r for r in ledger.reallocation_percentiles(nodes, regions).collect()}
    for reg, g in gaps.items():
        s = sorted(g)
        for name, p in (("median", 0.5), ("percentile_80", 0.8), ("percentile_95", 0.95)):
            want = s[max(math.ceil(p * len(s)), 1) - 1]
            assert getattr(got[f"R{reg}"], name) == want


def test_run_length_equals_expanded(txn):
    a = dict(rows(ledger.data_allocation(txn)))
    b = dict(rows(data_allocation_expanded(txn)))
    assert set(a) == set(b)
    for k in a:
        assert (a[k] is None and b[k] is None) or a[k] == pytest.approx(b[k], abs=1e-6)


def test_options(txn, spark):
    from bizlens.plans import orders  # noqa: F401

    day = dict(rows(ledger.data_allocation(txn, window_rows=30, per_day=True)))
    day_ref = dict(rows(data_allocation_expanded(txn, window_rows=30, per_day=True)))
    assert set(day) == set(day_ref)
    for k in day:
        assert (day[k] is None and day_ref[k] is None) or day[k] == pytest.approx(day_ref[k], abs=1e-6)
    months = ledger.running_month_balance(txn, with_year=True)
    assert dict(months.dtypes)["month_"] == "date"
    assert ledger.growth_share(txn, with_year=True).count() == 1


def brute_options(txn_rows):
    """Per option the monthly totals, from every customer's balance on every day; and the balance statistics."""
    import collections
    import datetime as dt

    moves = collections.defaultdict(lambda: collections.defaultdict(float))
    count = collections.defaultdict(collections.Counter)
    for c, d, kind, amount in txn_rows:
        moves[c][d] += amount if kind == "deposit" else -amount
        count[c][d] += 1
    ends, real, stats = collections.Counter(), collections.Counter(), {}
    for c, days in moves.items():
        balance, seen, per_month, closing = 0.0, [], collections.defaultdict(list), 0.0
        day, last = min(days).replace(day=1), max(days)
        carried = None
        while day <= last:
            if day.day == 1:
                ends[day] += max(carried or 0.0, 0.0)
                per_month[day].append(carried or 0.0)
            if day in days:
                balance += days[day]
                carried = balance
                seen += [balance] * count[c][day]
            per_month[day.replace(day=1)].append(carried or 0.0)
            day += dt.timedelta(1)
        for m, values in per_month.items():
            real[m] += max(0.0, *values)
        stats[c] = (min(seen), sum(seen) / len(seen), max(seen))
    return ends, real, stats


def test_allocation_options(spark, txn, txn_rows):
    ends, real, stats = brute_options([(c, d, k, float(a)) for c, d, k, a in txn_rows])
    assert dict(rows(ledger.allocation_by_month_end(txn))) == {m: pytest.approx(v, abs=0.051) for m, v in ends.items()}
    assert dict(rows(ledger.allocation_in_real_time(txn))) == {m: pytest.approx(v, abs=0.051) for m, v in real.items()}
    got = {r[0]: r[1:] for r in rows(ledger.balance_statistics(txn))}
    assert got.keys() == stats.keys()
    assert all(got[c] == tuple(pytest.approx(v, abs=0.006) for v in stats[c]) for c in got)
    none = txn.filter("customer_id < 0")
    for job in (ledger.allocation_by_month_end, ledger.allocation_in_real_time, ledger.balance_statistics, ledger.running_balance):
        assert job(none).count() == 0

"""Bank: node allocations and a transaction ledger.

Inputs: ``nodes(customer_id, region_id, node_id, start_date)``,
``regions(region_id, region_name)``,
``txn(customer_id, txn_date, txn_type, txn_amount decimal)``.

Month names carry no year (months of different years merge), as asked.
Running balances and looks at the day before or after run in slices of a month
(:mod:`bizlens.operators.scan`), so a customer may have any number of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bizlens.functions.dates import month_name
from bizlens.functions.numeric import div, rounded
from bizlens.operators.ranking import in_order
from bizlens.operators.aggregate import percentile_disc, sum_if
from bizlens.operators.scan import block_of, month_of, scan, settled


def unique_nodes(nodes: DataFrame) -> DataFrame:
    return nodes.agg(F.countDistinct("node_id").alias("nodes"))


def _per_region(nodes: DataFrame, regions: DataFrame, column: str, out: str, distinct: bool) -> DataFrame:
    agg = F.countDistinct(column) if distinct else F.count(column)
    if distinct:
        counts = nodes.join(regions, "region_id").groupBy("region_name").agg(agg.alias(out))
        return counts
    counts = nodes.groupBy("region_id").agg(agg.alias("_n"))
    return counts.join(regions, "region_id").groupBy("region_name").agg(F.sum("_n").cast("bigint").alias(out))


def nodes_per_region(nodes: DataFrame, regions: DataFrame, distinct: bool = False) -> DataFrame:
    return _per_region(nodes, regions, "node_id", "nodes_per_region", distinct)


def customers_per_region(nodes: DataFrame, regions: DataFrame, distinct: bool = False) -> DataFrame:
    return _per_region(nodes, regions, "customer_id", "nodes_per_customer", distinct)


def avg_reallocation_days(nodes: DataFrame) -> DataFrame:
    """Mean gap between consecutive start dates per customer.

    The gaps of one customer telescope: they sum to (last - first) and there
    are (n - 1) of them, so the mean needs only a per-customer min / max /
    count -- no window, and a hot customer is pre-aggregated map-side.
    """
    per = nodes.groupBy("customer_id").agg(
        F.datediff(F.max("start_date"), F.min("start_date")).alias("_span"), F.count("start_date").alias("_n"))
    return per.agg(rounded(div(F.sum("_span"), F.sum(F.col("_n") - 1)), 1)
                   .alias("average_reallocation_days"))


def _gap_histogram(nodes: DataFrame) -> DataFrame:
    """(region_id, gap) -> weight: the multiset of consecutive start-date gaps.

    Rows are first counted per (customer, start_date, region); a lag over
    those distinct days gives one gap per day, and the other (count - 1) rows
    of the same day contribute gap 0.
    """
    days = nodes.groupBy("customer_id", "start_date", "region_id").agg(F.count(F.lit(1)).alias("_c"))
    days = scan(days.withColumn("_month", month_of("start_date")), ["customer_id"], "_month",
                ["start_date", "region_id"], lags={"_before": "start_date"})
    gaps = days.select("region_id", "_c", F.datediff("start_date", "_before").alias("gap"))
    # one pass: each day yields (gap to the previous day, 1) and (0, count - 1)
    parts = F.filter(F.array(F.struct(F.col("gap").alias("gap"), F.lit(1).cast("bigint").alias("w")),
                             F.struct(F.lit(0).alias("gap"), (F.col("_c") - 1).alias("w"))),
                     lambda p: p["gap"].isNotNull() & (p["w"] > 0))
    return gaps.select("region_id", F.explode(parts).alias("p")).select("region_id", "p.gap", "p.w")


def reallocation_percentiles(nodes: DataFrame, regions: DataFrame,
                             fractions=(("median", 0.5), ("percentile_80", 0.8), ("percentile_95", 0.95))
                             ) -> DataFrame:
    hist = _gap_histogram(nodes)
    pct = percentile_disc(hist, ["region_id"], "gap", "w", dict(fractions))
    return pct.join(regions, "region_id").select(
        "region_name", *[F.col(n).cast("double").alias(n) for n, _ in fractions])


def txn_summary(txn: DataFrame) -> DataFrame:
    return txn.groupBy(F.col("txn_type").alias("transaction_type")).agg(
        F.count(F.lit(1)).alias("no_of_transactions"),
        F.concat(F.lit("$"), F.sum("txn_amount").cast("string")).alias("total_amount"))


def avg_deposits(txn: DataFrame) -> DataFrame:
    per = txn.filter(F.col("txn_type") == "deposit").groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("txn_amount").alias("_s"))
    return per.agg(rounded(div(F.sum("_n"), F.count("_n")), 1).alias("average_deposit_count"),
                   rounded(F.avg("_s"), 1).alias("average_total_deposit"))


def _month_keys(date_col: str = "txn_date", with_year: bool = False) -> list[Column]:
    """(month_, month_name). As asked, months carry no year, so the same month
    of different years merges; ``with_year=True`` keys by calendar month
    (first day of the month, and 'January 2020' style names)."""
    if with_year:
        return [F.trunc(date_col, "month").alias("month_"), F.date_format(F.to_date(date_col), "MMMM yyyy").alias("month_name")]
    return [F.month(date_col).alias("month_"), month_name(date_col).alias("month_name")]


def active_customers_by_month(txn: DataFrame, min_deposits: int = 2, with_year: bool = False) -> DataFrame:
    t = F.col("txn_type")
    per = txn.groupBy("customer_id", *_month_keys(with_year=with_year)).agg(
        sum_if(t == "deposit").alias("d"), sum_if(t == "purchase").alias("p"), sum_if(t == "withdrawal").alias("w"))
    ok = per.filter((F.col("d") >= min_deposits) & ((F.col("p") >= 1) | (F.col("w") >= 1)))
    months = ok.groupBy("month_", "month_name").agg(F.count("customer_id").alias("customer_count"))
    return in_order(months, "month_").select("month_name", "customer_count")


def monthly_net(txn: DataFrame, with_year: bool = False) -> DataFrame:
    t, a = F.col("txn_type"), F.col("txn_amount")
    per = txn.groupBy("customer_id", *_month_keys(with_year=with_year)).agg(
        sum_if(t == "deposit", a).alias("d"), sum_if(t == "purchase", a).alias("p"),
        sum_if(t == "withdrawal", a).alias("w"))
    return per.select("customer_id", "month_name",
                      (F.col("d") - (F.col("p") + F.col("w"))).cast("double").alias("closing_balance"))


def _signed(txn: DataFrame) -> Column:
    return F.when(F.col("txn_type") == "deposit", F.col("txn_amount")).otherwise(-F.col("txn_amount"))


def _monthly_running(txn: DataFrame, with_year: bool = False) -> DataFrame:
    per = txn.groupBy("customer_id", *_month_keys(with_year=with_year)).agg(F.sum(_signed(txn)).alias("txn_amount"))
    w = Window.partitionBy("customer_id").orderBy("month_").rowsBetween(Window.unboundedPreceding, 0)
    return per.withColumn("balance", F.sum("txn_amount").over(w))


def running_month_balance(txn: DataFrame, with_year: bool = False) -> DataFrame:
    """Net amount per customer-month and the running balance over months.
    The window input is one row per customer-month (at most 12 as asked)."""
    r = _monthly_running(txn, with_year)
    return r.select("customer_id", "month_", "month_name", F.col("txn_amount").cast("double").alias("txn_amount"),
                    F.col("balance").cast("double").alias("balance"))


def month_calendar_balance(txn: DataFrame) -> DataFrame:
    """One row per customer and calendar month from the first to the last one with
    a transaction: the month's net amount (NULL if none), the balance carried
    on, and the number of months with transactions so far.

    The calendar is made per customer and left-joined with the months that
    have transactions on (customer, month).
    """
    month = F.trunc("txn_date", "month")
    net = txn.groupBy("customer_id", month.alias("month")).agg(F.sum(_signed(txn)).alias("txn_amount"))
    span = net.groupBy("customer_id").agg(F.min("month").alias("_a"), F.max("month").alias("_b"))
    calendar = span.select("customer_id", F.explode(F.sequence("_a", "_b", F.expr("INTERVAL 1 MONTH"))).alias("month"))
    so_far = Window.partitionBy("customer_id").orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    return calendar.join(net, ["customer_id", "month"], "left").select(
        "customer_id", "month", F.col("txn_amount").cast("double").alias("txn_amount"),
        F.sum("txn_amount").over(so_far).cast("double").alias("balance"),
        F.count("txn_amount").over(so_far).alias("active_months"))


def growth_share(txn: DataFrame, threshold: float = 5.0, with_year: bool = False, as_label: bool = False) -> DataFrame:
    """Share (%) of customers whose last monthly balance grew by more than
    ``threshold`` percent over the previous month (no previous month counts as
    no growth; a previous balance of 0 gives balance x 100). ``as_label`` gives
    the text with a percent sign."""
    r = _monthly_running(txn, with_year)
    w = Window.partitionBy("customer_id").orderBy("month_")
    prev = F.lag("balance").over(w)
    r = r.withColumn("_prev", prev)
    growth = (
        F.when(F.col("_prev").isNull(), F.lit(None))
        .when(F.col("_prev") == 0, F.col("balance") * 100)
        .otherwise(F.round((div(F.col("balance") - F.col("_prev"), F.abs(F.col("_prev"))) * 100)
                           .cast("decimal(38,12)"), 1))
    )
    r = r.withColumn("_g", growth)
    last = r.groupBy("customer_id").agg(F.max_by("_g", "month_").alias("_g"))
    grew = F.sum(F.when(F.col("_g") > threshold, 1).otherwise(0))
    share = rounded(div(grew * 100, F.count(F.lit(1))), 2)
    return last.agg((F.concat(share.cast("string"), F.lit("%")) if as_label else share).alias("growth_percentage"))


def _balances(txn: DataFrame) -> DataFrame:
    """(customer_id, month, day, k, balance, next_day, earlier): per customer and day with transactions their
    number, the balance after them, the next such day, and the balance before them (NULL: none)."""
    days = txn.groupBy("customer_id", month_of("txn_date").alias("month"), F.col("txn_date").alias("day")).agg(
        F.count(F.lit(1)).alias("k"), F.sum(_signed(txn)).alias("net"))
    days = scan(days, ["customer_id"], "month", ["day"], sums={"balance": "net", "nth": F.lit(1)}, leads={"next_day": "day"})
    return days.withColumn("earlier", F.when(F.col("nth") > 1, F.col("balance") - F.col("net"))).drop("nth", "net")


def running_balance(txn: DataFrame) -> DataFrame:
    """Every transaction with its customer's balance after it; the transactions of a day have no order among
    them and share the balance after the day."""
    days = _balances(txn).select("customer_id", F.col("day").alias("txn_date"), "balance")
    return txn.join(days, ["customer_id", "txn_date"]).select(
        "customer_id", "txn_date", "txn_type", F.col("txn_amount").cast("double").alias("txn_amount"),
        F.col("balance").cast("double").alias("balance"))


def balance_statistics(txn: DataFrame) -> DataFrame:
    """Least, mean and largest balance after a transaction, per customer."""
    mean = F.sum(F.col("k") * F.col("balance")) / F.sum("k")
    per = _balances(txn).groupBy("customer_id").agg(
        F.min("balance").cast("double").alias("minimum_balance"), rounded(mean, 2).alias("average_balance"),
        F.max("balance").cast("double").alias("maximum_balance"))
    return in_order(per, "customer_id")


def _total_by_month(spans: DataFrame) -> DataFrame:
    """(month, total_allocation) of ``spans`` (first, until, amount): each amount counts in the months from
    ``first`` to the one before ``until``. A span costs two rows whatever its length: the amount comes in one
    month and goes in another, and the months' sums are added up along the calendar."""
    moves = F.explode(F.array(F.struct(F.col("first").alias("month"), F.col("amount").alias("by")),
                              F.struct(F.col("until").alias("month"), (-F.col("amount")).alias("by"))))
    moved = spans.select(moves.alias("m")).groupBy("m.month").agg(F.sum("m.by").alias("by"))
    # from here on a row per month
    ends = moved.agg(F.min("month").alias("a"), F.add_months(F.max("month"), -1).alias("b"))
    calendar = ends.select(F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 MONTH"))).alias("month"))
    so_far = Window.orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    total = calendar.join(moved, "month", "left").select("month", F.sum("by").over(so_far).alias("total"))
    return in_order(total.select("month", rounded(F.coalesce("total", F.lit(0)), 1).alias("total_allocation")), "month")


def _next_month(date: str) -> Column:
    return F.add_months(F.trunc(date, "month"), 1)


def _month_ends(days: DataFrame) -> DataFrame:
    """Of ``_balances``, the last day of each month with transactions."""
    return days.filter(F.col("next_day").isNull() | (F.trunc("next_day", "month") > F.col("month")))


def _in_account(balance: Column | str) -> Column:
    return F.greatest(F.col(balance) if isinstance(balance, str) else balance, F.lit(0))


def allocation_by_month_end(txn: DataFrame) -> DataFrame:
    """Monthly data need when each customer gets the balance at the end of the previous month (none if there is
    no such month, or the balance is negative), summed per month. A customer counts from the first to the last
    month with transactions; the balance of a month without any is that of the last one with some."""
    held = _month_ends(_balances(txn)).select(
        _next_month("day").alias("first"), F.coalesce(_next_month("next_day"), _next_month("day")).alias("until"),
        _in_account("balance").alias("amount"))
    start = txn.agg(F.trunc(F.min("txn_date"), "month").alias("first")).filter("first IS NOT NULL").select(
        "first", F.add_months("first", 1).alias("until"), F.lit(0).alias("amount"))  # the calendar's first month
    return _total_by_month(held.unionByName(start))


def allocation_in_real_time(txn: DataFrame) -> DataFrame:
    """Monthly data need when each customer's allocation follows the balance: the largest balance that the
    customer has during the month (the one carried into it included, negative ones as 0), summed per month,
    from the customer's first to the last month with transactions."""
    days = _balances(txn)
    peaks = days.groupBy("customer_id", "month").agg(
        _in_account(F.max(F.greatest("balance", "earlier"))).alias("amount"))
    busy = peaks.select(F.col("month").alias("first"), F.add_months("month", 1).alias("until"), "amount")
    quiet = _month_ends(days).filter("next_day IS NOT NULL").select(  # the months between two with transactions
        _next_month("day").alias("first"), F.trunc("next_day", "month").alias("until"), _in_account("balance").alias("amount"))
    return _total_by_month(busy.unionByName(quiet))


#: Ledger positions that one task places at a time.
POSITIONS = 4096


def _ledger_runs(txn: DataFrame, per_day: bool) -> DataFrame:
    """The ledger as runs of rows with one balance: customer_id, month, day, k (rows of the day itself),
    s and p (first and last position), b (balance), c (sum of all balances before the run)."""
    rows_per_day = F.min(F.lit(1)).cast("long") if per_day else F.count(F.lit(1))
    days = txn.groupBy("customer_id", month_of("txn_date").alias("month"), F.col("txn_date").alias("day")).agg(
        rows_per_day.alias("k"), F.sum(_signed(txn)).alias("net"))
    runs = scan(days, ["customer_id"], "month", ["day"], sums={"b": "net", "ks": "k", "nth": F.lit(1)},
                leads={"next": "day"}, firsts={"first": "day"})
    # positions before a day: the rows of the days with transactions, and one for each day without
    s = F.col("ks") - F.col("k") + F.datediff("day", "first") - (F.col("nth") - 1) + 1
    idle = F.coalesce(F.datediff("next", "day") - 1, F.lit(0))
    runs = runs.select("customer_id", "month", "day", "k", F.col("b").cast("decimal(30,2)").alias("b"), s.alias("s"),
                       (s + F.col("k") + idle - 1).alias("p"))
    runs = settled(runs, "ledger_runs")
    area = ((F.col("p") - F.col("s") + 1) * F.col("b")).cast("decimal(38,2)")
    runs = scan(runs, ["customer_id"], "month", ["day"], sums={"upto": area})
    return settled(runs.withColumn("c", (F.col("upto") - area).cast("decimal(38,2)")).drop("upto"), "ledger_sums")


def data_allocation(txn: DataFrame, window_rows: int = 31, min_rows: int = 30, per_day: bool = False) -> DataFrame:
    """Monthly data need when each customer gets the mean balance of the last
    ``window_rows`` ledger rows; no allocation before row ``min_rows``,
    negative means clamp to 0; then the max per customer-month and the sum
    per month.

    The ledger has one row per calendar day from a customer's first to last
    transaction day, except that a day with k transactions has k rows; all
    rows of a day carry the day's closing balance.

    Computed without materialising that ledger. It is a sequence of runs: a
    transaction day and the empty days after it, all at one balance, so C(t), the
    sum of the balances up to position t, is linear from the end of a run to the end
    of the next, and the moving sum is C(t) - C(t - w). The mean is monotone between
    positions where t or t - w ends a run, or t is w; so is the clamp at 0. A
    month's maximum therefore lies at a run's first or last position in the month,
    at w, or w positions after the end of a run. Each of these knows one of C(t) and
    C(t - w) from its own run; the other is that of the run it falls in, found by
    carrying the runs forward over the positions. All of it runs in slices (months,
    blocks of positions): no task has the whole of a customer.
    """
    w = window_rows
    s, p, b, c, lo, hi = (F.col(x) for x in ("s", "p", "b", "c", "lo", "hi"))
    runs = _ledger_runs(txn, per_day)
    last = F.date_add("day", (p - s + 1 - F.col("k")).cast("int"))

    def position(date: Column) -> Column:  # the first position of a date after the run's day
        return s + F.col("k") - 1 + F.datediff(date, "day")

    months = F.sequence("month", F.trunc(last, "month"), F.expr("INTERVAL 1 MONTH"))
    first = F.when(F.col("m") <= F.col("day"), s).otherwise(position(F.col("m")))
    spans = runs.select("*", F.explode(months).alias("m")).select(
        "*", F.greatest(first, F.lit(min_rows).cast("bigint")).alias("lo"),
        F.when(F.last_day("m") >= last, p).otherwise(position(F.last_day("m"))).alias("hi"))

    def sum_to(t: Column) -> Column:  # C at a position of the run
        return (c + (t - s + 1) * b).cast("decimal(38,2)")

    nothing = F.lit(None).cast("decimal(38,2)")
    run = ("s", "p", "b", "c", "k", "day")

    def event(at: Column, kind: str, known: Column = nothing) -> Column:
        # in the order of positions a run comes before what is looked up at its first one
        return F.struct((at * 2 + F.lit(0 if kind == "run" else 1)).cast("bigint").alias("turn"), F.lit(kind).alias("kind"),
                        F.col("m").alias("month"), known.alias("known"),
                        *[F.when(F.lit(kind == "run"), F.col(x)).alias(x) for x in run])

    def here(t: Column) -> Column:  # a position of the run in this month: C(t - w) is to be found
        return F.when((t >= lo) & (t <= hi), event(t - w, "here", sum_to(t)))

    starts = F.col("m") == F.col("month")
    events = F.array(F.when(starts, event(s, "run")), F.when(starts, event(p + w, "ahead", sum_to(p))),
                     F.coalesce(here(lo), event(F.lit(0), "here")), F.when(hi > lo, here(hi)),
                     F.when((lo < w) & (hi > w), here(F.lit(w).cast("bigint"))))
    found = spans.select("customer_id", F.explode(events).alias("e")).filter("e IS NOT NULL").select("customer_id", "e.*")
    found = found.withColumn("block", block_of(F.greatest("turn", F.lit(0)), 2 * POSITIONS))
    found = scan(found, ["customer_id"], "block", ["turn"], lasts={f"of_{x}": x for x in run}).filter("kind <> 'run'")

    at, of = F.floor(F.col("turn") / 2).cast("bigint"), {x: F.col(f"of_{x}") for x in run}
    reached = F.when(at > 0, (of["c"] + (at - of["s"] + 1) * of["b"]).cast("decimal(38,2)")).otherwise(0)
    mean = F.when(F.col("kind") == "here", (F.col("known") - reached).cast("double") / F.least(at + w, F.lit(w)))
    mean = mean.when((at <= of["p"]) & (at >= min_rows), (reached - F.col("known")).cast("double") / w)
    date = F.date_add(of["day"], F.greatest(at - of["s"] - of["k"] + 1, F.lit(0)).cast("int"))
    values = found.select(
        "customer_id", "kind", F.when(F.col("kind") == "here", F.col("month")).otherwise(F.trunc(date, "month")).alias("month"),
        mean.alias("mean")).filter("kind = 'here' OR mean IS NOT NULL")
    # summed as decimals: the sum of doubles would depend on their order
    best = F.max(F.when(F.col("mean").isNotNull(), F.greatest("mean", F.lit(0.0)).cast("decimal(30,6)")))
    per_month = values.groupBy("customer_id", "month").agg(best.alias("_alloc"))
    return in_order(per_month.groupBy("month").agg(rounded(F.sum("_alloc"), 1).alias("total_allocation")), "month")

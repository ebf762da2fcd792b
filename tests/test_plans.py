"""Plan shape and registry checks over every registered job (sf0.001)."""

import pytest

import __spark_entry__ as E
from bizlens import catalog

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_registry_complete():
    q, s = catalog.queries(), catalog.oracle_sql()
    assert len(q) == 96
    assert set(q) == set(s)
    assert set(q) <= set(E.queries()) and set(s) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_no_cross_product(spark, name):
    df = catalog.queries()[name](spark, SF)
    plan = _plan(df)
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan, plan


def test_scan_pruning(spark):
    plan = E.queries()["spend_per_customer"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    # lineitem is read with only the two columns the job needs
    assert "struct<l_orderkey:bigint,l_partkey:bigint>" in plan


LINE_JOBS = ["items_ordered", "unique_orders", "inspect_values", "standard_ingredients", "top_extra", "top_exclusion",
             "order_item_label", "order_ingredient_list", "extend_menu"]
DELIVERED_LINE_JOBS = ["revenue", "both_changes", "delivered_by_type", "ingredient_totals"]


@pytest.mark.parametrize("name", LINE_JOBS + DELIVERED_LINE_JOBS)
def test_line_jobs_leave_orders_alone(spark, name):
    """Jobs that need only columns of the order lines don't read orders; the delivered ones read it once."""
    plan = catalog.queries()[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("o_orderkey#") == 0 if name in LINE_JOBS else "o_orderkey" in plan
    scans = [line for line in plan.split("\n") if "Relation" in line and "o_orderkey" in line]
    assert len(scans) == (0 if name in LINE_JOBS else 1)


@pytest.mark.parametrize("name", ["spend_per_customer", "favourite_item", "sales_with_member_flag", "delivery_report",
                                  "standard_ingredients", "order_item_label", "ingredient_totals"])
def test_no_job_while_the_plan_is_built(spark, name):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup(f"build-{name}", "plan only")
    catalog.queries()[name](spark, SF)
    assert list(tracker.getJobIdsForGroup(f"build-{name}")) == []


def test_result_order(spark):
    rows = [r.hour_day for r in catalog.queries()["orders_by_hour"](spark, SF).collect()]
    assert rows == sorted(rows) and len(rows) > 1
    totals = [r.total_ingredients for r in catalog.queries()["ingredient_totals"](spark, SF).collect()]
    known = [t for t in totals if t is not None]
    assert totals == [None] * (len(totals) - len(known)) + sorted(known, reverse=True)  # descending: NULLs first
    df = spark.createDataFrame([(2,), (None,), (1,)], "v int")
    from bizlens.operators.ranking import in_order

    assert [r.v for r in in_order(df, "v").collect()] == [1, 2, None]
    assert [r.v for r in in_order(df, "-v").collect()] == [None, 2, 1]


def _at(value, descending):
    """Sort key of a column: NULLs last going up, first going down."""
    if descending:
        return (0, 0) if value is None else (1, -value if not isinstance(value, str) else tuple(-ord(c) for c in value) + (1,))
    return (1, 0) if value is None else (0, value)


@pytest.mark.parametrize("name", sorted(catalog.ORDER))
def test_every_ordered_result_is_in_order(spark, name):
    keys = catalog.ORDER[name]
    rows = catalog.queries()[name](spark, SF).collect()
    got = [tuple(_at(r[k.lstrip("-")], k.startswith("-")) for k in keys) for r in rows]
    assert got == sorted(got) and rows


@pytest.mark.parametrize("name,keys", [
    ("data_allocation", ["month"]), ("allocation_by_month_end", ["month"]), ("allocation_in_real_time", ["month"]),
    ("balance_statistics", ["customer_id"]), ("missing_weeks", ["dates_week", "region", "platform", "segment", "customer_type"]),
    ("top_pages", ["-number_of_views", "page_name"])])
def test_jobs_that_sort_themselves_are_in_order(spark, name, keys):
    rows = catalog.queries()[name](spark, SF).collect()
    got = [tuple(_at(r[k.lstrip("-")], k.startswith("-")) for k in keys) for r in rows]
    assert got == sorted(got) and rows


def test_order_by_a_column_that_is_not_shown(spark):
    months = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October",
              "November", "December"]
    got = [months.index(r.month_name) for r in catalog.queries()["active_customers_by_month"](spark, SF).collect()]
    assert got == sorted(got) and len(got) > 1


def test_items_are_not_shuffled_for_their_labels(spark):
    plan = _plan(catalog.queries()["order_item_label"](spark, SF)).split("Subquery")[0]
    assert "hashpartitioning" not in plan and "Join" not in plan, plan


@pytest.mark.parametrize("name", ["delivery_report", "ingredient_totals"])
def test_orders_are_read_once(spark, name):
    plan = catalog.queries()[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert len([line for line in plan.split("\n") if "Relation" in line and "o_orderkey" in line]) == 1


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["product_name", "number_of_views", "added_to_cart", "abandoned", "purchased"]
    assert df.count() >= 0


_PASS_THROUGH = ("Project", "Filter", "Sort ", "Sort[", "WholeStageCodegen", "ColumnarToRow", "InputAdapter",
                 "AQEShuffleRead", "ShuffleQueryStage", "WindowGroupLimit")
_BOUNDED = ("HashAggregate", "ObjectHashAggregate", "SortAggregate", "LocalTableScan")


def _single_partition_inputs(plan: str) -> list[str]:
    """For each ``Exchange SinglePartition``, the first operator below it that is
    not a projection / filter / sort."""
    lines = plan.split("\n")
    found = []
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" not in line:
            continue
        for below in lines[i + 1:]:
            op = below.lstrip(" :+-*()0123456789")
            if not op.startswith(_PASS_THROUGH):
                found.append(op[:60])
                break
    return found


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_single_partition_only_over_reduced_data(spark, name):
    """Every single-partition step (global aggregate, unpartitioned window,
    global rank) reads rows that were already aggregated -- never raw facts."""
    plan = _plan(catalog.queries()[name](spark, SF))
    for op in _single_partition_inputs(plan):
        assert op.startswith(_BOUNDED), (name, op)

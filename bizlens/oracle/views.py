"""The canonical views of :mod:`bizlens.sources.bindings`, spelled in DuckDB SQL.

Every oracle query inlines the views it reads as CTEs, so it runs against the
bare testdata tables (region nation customer supplier part orders lineitem
events ...).
"""

from __future__ import annotations

from bizlens.sources import dimensions as dims


def _q(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return str(v)


def _values(rows, cols, types) -> str:
    body = ", ".join("(" + ", ".join(_q(v) for v in r) + ")" for r in rows)
    casts = ", ".join(f"CAST({c} AS {t}) AS {c}" for c, t in zip(cols, types))
    return f"SELECT {casts} FROM (VALUES {body}) AS t({', '.join(cols)})"


_CAMPAIGN_ROWS = [(n, s.strftime("%Y-%m-%d %H:%M:%S"), e.strftime("%Y-%m-%d %H:%M:%S")) for n, s, e in dims.CAMPAIGNS]

VIEWS: dict[str, str] = {
    "v_menu": """
        SELECT CAST(rn AS INTEGER) AS product_id, p_type AS product_name, CAST(rn * 100 AS INTEGER) AS price
        FROM (SELECT p_type, row_number() OVER (ORDER BY p_type) AS rn FROM (SELECT DISTINCT p_type FROM part) d) m""",
    "v_sales": """
        SELECT o.o_custkey AS customer_id, CAST(o.o_orderdate AS DATE) AS order_date, m.product_id, m.product_name, m.price
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
        JOIN part p ON l.l_partkey = p.p_partkey JOIN v_menu m ON p.p_type = m.product_name""",
    "v_members": """
        SELECT o_custkey AS customer_id, MIN(CAST(o_orderdate AS DATE)) AS join_date
        FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY o_custkey""",
    "v_order_lines": """
        SELECT l_orderkey AS order_id, l_linenumber AS line_number, l_partkey AS part_key, l_suppkey AS supp_key,
               CAST(l_partkey % 2 + 1 AS INTEGER) AS pizza_id,
               CASE l_suppkey % 5 WHEN 0 THEN 'null' WHEN 1 THEN '' WHEN 2 THEN NULL
                    WHEN 3 THEN format('{}', l_partkey % 9 + 1)
                    ELSE format('{}, {}', l_partkey % 9 + 1, (l_partkey + 4) % 9 + 1) END AS exclusions,
               CASE l_partkey % 7 WHEN 0 THEN 'null' WHEN 1 THEN '' WHEN 6 THEN '' WHEN 2 THEN NULL
                    WHEN 3 THEN format('{}', l_suppkey % 9 + 1)
                    ELSE format('{}, {}', l_suppkey % 9 + 1, (l_suppkey + 2) % 9 + 1) END AS extras
        FROM lineitem""",
    "v_orders_raw": """
        SELECT v.order_id, v.line_number, v.part_key, v.supp_key, o.o_custkey AS customer_id, v.pizza_id,
               v.exclusions, v.extras, o.o_orderdate + to_minutes(o.o_orderkey % 1440) AS order_time
        FROM v_order_lines v JOIN orders o ON v.order_id = o.o_orderkey""",
    "v_order_customers": "SELECT o_orderkey AS order_id, o_custkey AS customer_id FROM orders",
    "v_deliveries_raw": """
        SELECT o_orderkey AS order_id, CAST(o_custkey % 8 + 1 AS INTEGER) AS runner_id,
               CASE WHEN o_orderkey % 9 = 0 THEN 'null'
                    ELSE strftime(o_orderdate + to_minutes(o_orderkey % 1440)
                                  + to_seconds((10 + o_orderkey % 30) * 60 + o_orderkey % 60), '%Y-%m-%d %H:%M:%S')
               END AS pickup_time,
               CASE WHEN o_orderkey % 9 = 0 THEN 'null'
                    ELSE CAST(CAST((o_orderkey % 250 + 10) / 10.0 AS DECIMAL(5,1)) AS VARCHAR)
                         || CASE o_orderkey % 4 WHEN 0 THEN 'km' WHEN 1 THEN ' km' WHEN 2 THEN '' WHEN 3 THEN 'km' END
               END AS distance,
               CASE WHEN o_orderkey % 9 = 0 THEN 'null'
                    ELSE CAST(10 + o_orderkey % 31 AS VARCHAR)
                         || CASE o_orderkey % 5 WHEN 0 THEN ' minutes' WHEN 1 THEN ' mins' WHEN 2 THEN 'mins'
                                                WHEN 3 THEN ' minute' WHEN 4 THEN '' END
               END AS duration,
               CASE WHEN o_orderkey % 9 = 0 THEN
                         CASE WHEN o_orderkey % 2 = 0 THEN 'Called off by the kitchen' ELSE 'Called off by the guest' END
                    ELSE CASE o_orderkey % 3 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'null' END
               END AS cancellation
        FROM orders""",
    "v_runners": """
        SELECT s_suppkey AS runner_id, CAST(DATE '2021-01-01' + CAST(s_suppkey % 21 AS INTEGER) AS DATE) AS registration_date
        FROM supplier""",
    "v_pizza_names": "SELECT product_id AS pizza_id, product_name AS pizza_name FROM v_menu",
    "v_toppings": """
        SELECT CAST(rank() OVER (ORDER BY b) AS INTEGER) AS topping_id, b AS topping_name
        FROM (SELECT DISTINCT p_brand AS b FROM part) brands""",
    "v_pizza_recipes": """
        SELECT pizza_id, array_to_string(list_sort(list(DISTINCT topping_id)), ', ') AS toppings
        FROM part JOIN v_pizza_names ON p_type = pizza_name JOIN v_toppings ON p_brand = topping_name
        WHERE p_size <= 5 GROUP BY pizza_id""",
    "v_plans": _values(dims.PLANS, ["plan_id", "plan_name", "price"], ["INTEGER", "VARCHAR", "DECIMAL(5,2)"]),
    "v_subscriptions": """
        SELECT DISTINCT o_custkey AS customer_id, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) - 1 AS plan_id,
               CAST(o_orderdate AS DATE) AS start_date
        FROM orders""",
    "v_regions": "SELECT r_regionkey AS region_id, r_name AS region_name FROM region",
    "v_customer_nodes": """
        SELECT o.o_custkey AS customer_id, n.n_regionkey AS region_id,
               CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER) AS node_id, CAST(o.o_orderdate AS DATE) AS start_date
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "v_customer_transactions": """
        SELECT o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS txn_date,
               CASE o_orderstatus WHEN 'O' THEN 'deposit' WHEN 'F' THEN 'purchase' WHEN 'P' THEN 'withdrawal' END AS txn_type,
               CAST(o_totalprice AS DECIMAL(18,2)) AS txn_amount
        FROM orders""",
    "v_weekly_sales_raw": """
        SELECT strftime(week_start, '%-d/%-m/%y') AS week_date, region, platform, segment, customer_type,
               COUNT(*) AS transactions, CAST(ROUND(SUM(amount), 0) AS BIGINT) AS sales
        FROM (
            SELECT CAST(date_trunc('week', l.l_shipdate) AS DATE) AS week_start, r.r_name AS region,
                   CASE WHEN o.o_orderstatus = 'O' THEN 'Shopify' ELSE 'Retail' END AS platform,
                   CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN 'C1' WHEN 'BUILDING' THEN 'C2' WHEN 'FURNITURE' THEN 'F3'
                        WHEN 'HOUSEHOLD' THEN 'F4' WHEN 'MACHINERY' THEN 'null' END AS segment,
                   o.o_orderpriority AS customer_type, CAST(l.l_extendedprice AS DECIMAL(18,2)) AS amount
            FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
            JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
            JOIN region r ON n.n_regionkey = r.r_regionkey
        ) j
        GROUP BY week_start, region, platform, segment, customer_type""",
    "v_events": """
        SELECT event_id, visit_id, cookie_id, page_id, event_type, event_time,
               row_number() OVER (PARTITION BY visit_id ORDER BY event_time, event_id) AS sequence_number
        FROM (
            SELECT event_id, CAST(user_id AS VARCHAR) || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS visit_id,
                   CAST(user_id * 10 + dayofmonth(ts) % 3 AS VARCHAR) AS cookie_id,
                   CAST(json_extract_string(props, '$.k') AS INTEGER) % 13 + 1 AS page_id,
                   CAST(CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 3
                        WHEN 'signup' THEN 4 WHEN 'error' THEN 5 END AS INTEGER) AS event_type,
                   ts AS event_time
            FROM events
        ) e""",
    "v_users": "SELECT DISTINCT user_id, CAST(user_id * 10 + dayofmonth(ts) % 3 AS VARCHAR) AS cookie_id FROM events",
    "v_event_identifier": _values(dims.EVENT_TYPES, ["event_type", "event_name"], ["INTEGER", "VARCHAR"]),
    "v_page_hierarchy": _values(dims.PAGES, ["page_id", "page_name", "product_category", "product_id"],
                                ["INTEGER", "VARCHAR", "VARCHAR", "INTEGER"]),
    "v_campaign_identifier": _values(_CAMPAIGN_ROWS, ["campaign_name", "start_date", "end_date"],
                                     ["VARCHAR", "TIMESTAMP", "TIMESTAMP"]),
}

DEPS: dict[str, list[str]] = {
    "v_sales": ["v_menu"], "v_orders_raw": ["v_order_lines"], "v_pizza_names": ["v_menu"],
    "v_pizza_recipes": ["v_pizza_names", "v_toppings"],
}


def with_views(body: str, views: list[str], ctes: list[tuple[str, str]] = ()) -> str:
    """``WITH <views and their deps>, <ctes> <body>``."""
    order: list[str] = []

    def add(v: str) -> None:
        for d in DEPS.get(v, []):
            add(d)
        if v not in order:
            order.append(v)

    for v in views:
        add(v)
    parts = [f"{v} AS ({VIEWS[v]})" for v in order] + [f"{n} AS ({s})" for n, s in ctes]
    if not parts:
        return body
    return "WITH " + ",\n".join(parts) + "\n" + body

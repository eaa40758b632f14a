"""The registered queries in SQL, for checking results against another engine.

Every statement is a list of common table expressions over the given tables, and a final
SELECT. Dates and times are shown as text and REAL values as DOUBLE, as the queries do.
"""

from __future__ import annotations

FIRST_RUN = "2002-01-01 12:00:00"
SECOND_RUN = "2002-02-01 12:00:00"

_SOURCES = """
craftsmen AS (
  SELECT s_suppkey AS craftsman_id, s_name AS craftsman_name, n_name AS craftsman_address,
         DATE '1950-01-01' + CAST(s_suppkey % 15000 AS INTEGER) AS craftsman_birthday,
         lower(replace(s_name, '#', '.')) || '@example.org' AS craftsman_email,
         r_name AS region
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
),
products AS (
  SELECT p_partkey AS product_id, p_name AS product_name,
         p_brand || ' ' || p_type || ' ' || p_size || ' #' || p_partkey AS product_description,
         p_type AS product_type, CAST(round(p_retailprice * 100) AS INTEGER) AS product_price,
         p_size AS size
  FROM part
),
customers AS (
  SELECT c_custkey AS customer_id, c_name AS customer_name, n_name AS customer_address,
         DATE '1950-01-01' + CAST(c_custkey % 15000 AS INTEGER) AS customer_birthday,
         lower(replace(c_name, '#', '.')) || '@example.org' AS customer_email,
         r_name AS region, c_mktsegment AS segment
  FROM customer JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
),
order_keys AS (
  SELECT l_partkey AS product_id, l_suppkey AS craftsman_id, o_custkey AS customer_id,
         CAST(o_orderdate AS DATE) AS order_created_date, min(l_orderkey) AS first_order,
         max(CASE WHEN o_orderstatus = 'F' THEN 3
                  WHEN o_orderstatus = 'P' AND l_linestatus = 'F' THEN 2
                  WHEN o_orderstatus = 'P' AND l_linestatus = 'O' THEN 1
                  WHEN o_orderstatus = 'O' AND l_linestatus = 'O' THEN 0 END) AS status_rank,
         max(CASE WHEN l_linestatus = 'O' AND o_orderstatus <> 'F' THEN NULL
                  ELSE CAST(l_shipdate AS DATE) END) AS order_completion_date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  GROUP BY 1, 2, 3, 4
),
all_orders AS (
  SELECT (first_order * 64 + (product_id * 31 + craftsman_id) % 64) * 16384
           + row_number() OVER (PARTITION BY first_order, (product_id * 31 + craftsman_id) % 64
                                ORDER BY product_id, craftsman_id) AS order_id,
         customer_id AS order_customer_id, product_id AS order_product_id,
         craftsman_id AS order_craftsman_id, order_created_date, order_completion_date,
         CASE status_rank WHEN 3 THEN 'done' WHEN 2 THEN 'delivery'
                          WHEN 1 THEN 'in progress' WHEN 0 THEN 'created' END AS order_status
  FROM order_keys
),
first_orders AS (
  SELECT o.* REPLACE (
           CASE WHEN order_completion_date >= DATE '2001-10-15' THEN NULL
                ELSE order_completion_date END AS order_completion_date,
           CASE WHEN order_completion_date >= DATE '2001-10-15' THEN 'in progress'
                ELSE order_status END AS order_status)
  FROM all_orders o JOIN customers c ON order_customer_id = customer_id
  WHERE region <> 'ASIA' AND order_created_date < DATE '2001-06-01'
),
second_orders AS (
  SELECT o.* FROM all_orders o JOIN customers c ON order_customer_id = customer_id
  WHERE region = 'ASIA' OR order_created_date >= DATE '2001-06-01'
     OR order_completion_date >= DATE '2001-10-15'
),
first_customers AS (
  SELECT * REPLACE (
    CASE WHEN segment = 'BUILDING' THEN 'former ' ELSE '' END || customer_address
      AS customer_address)
  FROM customers WHERE region <> 'ASIA'
),
second_customers AS (
  SELECT * FROM customers WHERE region = 'ASIA' OR segment = 'BUILDING'
),
sold_craftsmen AS (
  SELECT * FROM craftsmen
  WHERE craftsman_id IN (SELECT order_craftsman_id FROM all_orders)
),
sold_products AS (
  SELECT * FROM products WHERE product_id IN (SELECT order_product_id FROM all_orders)
),
earlier_craftsmen AS (
  SELECT * REPLACE ('former ' || craftsman_address AS craftsman_address)
  FROM craftsmen WHERE region <> 'ASIA'
),
earlier_products AS (
  SELECT * REPLACE ('former ' || product_type AS product_type)
  FROM products WHERE product_type <> 'PROMO'
),
stamped_orders AS (
  SELECT *, CAST(order_created_date AS TIMESTAMP) + INTERVAL 12 HOUR AS order_load_dttm
  FROM all_orders
),
stamped_craftsmen AS (
  SELECT *, TIMESTAMP '1999-01-01 00:00:00' AS craftsman_load_dttm FROM craftsmen
),
stamped_customers AS (
  SELECT *, CASE WHEN segment = 'BUILDING' THEN TIMESTAMP '2002-02-01 12:00:00' END
              AS customers_load_dttm
  FROM customers
),
stamped_products AS (
  SELECT *, CASE WHEN product_type = 'PROMO' AND size = 50
                 THEN TIMESTAMP '2002-01-01 12:00:00' END AS products_load_dttm
  FROM products
),
star AS (
  SELECT customer_id, customer_name, customer_address, customer_birthday, customer_email,
         order_id, product_id, product_name, product_price, product_type,
         order_completion_date, order_created_date, order_status,
         strftime(order_created_date, '%Y-%m') AS report_month, craftsman_name,
         order_load_dttm, craftsman_load_dttm, customers_load_dttm, products_load_dttm
  FROM stamped_orders
  JOIN stamped_craftsmen ON order_craftsman_id = craftsman_id
  JOIN stamped_customers ON order_customer_id = customer_id
  JOIN stamped_products ON order_product_id = product_id
),
delta AS (
  SELECT * FROM star
  WHERE order_load_dttm > DATE '2001-06-15' OR craftsman_load_dttm > DATE '2001-06-15'
     OR customers_load_dttm > DATE '2001-06-15' OR products_load_dttm > DATE '2001-06-15'
),
affected AS (SELECT DISTINCT customer_id FROM delta),
known AS (
  SELECT DISTINCT order_customer_id AS customer_id FROM first_orders
),
first_star AS (
  SELECT order_customer_id AS customer_id, customer_name, customer_address,
         customer_birthday, customer_email, product_name, product_price, craftsman_name,
         order_created_date, order_completion_date, order_status,
         strftime(order_created_date, '%Y-%m') AS report_month
  FROM first_orders
  JOIN first_customers ON order_customer_id = customer_id
  JOIN craftsmen ON order_craftsman_id = craftsman_id
  JOIN products ON order_product_id = product_id
)"""

_REPORT_COLUMNS = [
    "customer_id",
    "customer_name",
    "customer_address",
    "customer_birthday",
    "customer_email",
    "customer_paid",
    "customer_earned",
    "customer_order_count",
    "customer_avg_price_per_month",
    "median_completion_time_per_month",
    "customer_most_popular_product_per_month",
    "customer_most_popular_craftsman",
    "number_of_orders_created_per_month",
    "number_of_orders_in_progress_per_month",
    "number_of_orders_in_delivery_per_month",
    "number_of_orders_done_per_month",
    "number_of_orders_not_done_per_month",
    "report_month",
]


def _report(name: str, star: str) -> str:
    """The report over a joined star, as a common table expression and its helpers."""
    return f"""
{name}_measures AS (
  SELECT customer_id, customer_name, customer_address, customer_birthday, customer_email,
         report_month,
         CAST(CAST(sum(product_price) - sum(product_price) * 0.1 AS REAL) AS DOUBLE)
           AS customer_paid,
         CAST(CAST(sum(product_price) * 0.1 AS REAL) AS DOUBLE) AS customer_earned,
         CAST(count(*) AS INTEGER) AS customer_order_count,
         CAST(CAST(avg(product_price) AS REAL) AS DOUBLE) AS customer_avg_price_per_month,
         CAST(CAST(percentile_cont(0.5) WITHIN GROUP (
           ORDER BY abs(date_diff('day', order_created_date, order_completion_date))
         ) AS INTEGER) AS DOUBLE) AS median_completion_time_per_month,
         CAST(count(*) FILTER (order_status = 'created') AS INTEGER)
           AS number_of_orders_created_per_month,
         CAST(count(*) FILTER (order_status = 'in progress') AS INTEGER)
           AS number_of_orders_in_progress_per_month,
         CAST(count(*) FILTER (order_status = 'delivery') AS INTEGER)
           AS number_of_orders_in_delivery_per_month,
         CAST(count(*) FILTER (order_status = 'done') AS INTEGER)
           AS number_of_orders_done_per_month,
         CAST(count(*) FILTER (order_status <> 'done') AS INTEGER)
           AS number_of_orders_not_done_per_month
  FROM {star}
  GROUP BY ALL
),
{name}_products AS (
  SELECT customer_id, report_month, product_name AS customer_most_popular_product_per_month
  FROM {star} GROUP BY customer_id, report_month, product_name
  QUALIFY row_number() OVER (
    PARTITION BY customer_id, report_month ORDER BY count(*) DESC, product_name) = 1
),
{name}_craftsmen AS (
  SELECT customer_id, report_month, craftsman_name AS customer_most_popular_craftsman
  FROM {star} GROUP BY customer_id, report_month, craftsman_name
  QUALIFY row_number() OVER (
    PARTITION BY customer_id, report_month ORDER BY count(*) DESC, craftsman_name) = 1
),
{name} AS (
  SELECT CAST(customer_id AS INTEGER) AS customer_id, report_month,
         * EXCLUDE (customer_id, report_month)
  FROM {name}_measures
  LEFT JOIN {name}_products USING (customer_id, report_month)
  LEFT JOIN {name}_craftsmen USING (customer_id, report_month)
)"""


def _with(select: str, *reports: str) -> str:
    return f"WITH {','.join([_SOURCES, *reports])}\n{select}"


def _day(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d') AS {column}"


def _time(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S') AS {column}"


def _report_select(name: str) -> str:
    columns = [_day(c) if c == "customer_birthday" else c for c in _REPORT_COLUMNS]
    return f"SELECT {', '.join(columns)} FROM {name}"


def _measure_select(*names: str) -> str:
    return _with(
        f"SELECT customer_id, report_month, {', '.join(names)} FROM mart",
        _report("mart", "star"),
    )


_CRAFTSMAN = f"""craftsman_id, craftsman_name, craftsman_address,
  {_day("craftsman_birthday")}, craftsman_email"""
_PRODUCT = "product_id, product_name, product_description, product_type, product_price"
_CUSTOMER = f"""customer_id, customer_name, customer_address,
  {_day("customer_birthday")}, customer_email"""
_ORDER = f"""order_id, order_customer_id, order_product_id, order_craftsman_id,
  {_day("order_created_date")}, {_day("order_completion_date")}, order_status"""
_NO_STAMP = "CAST(NULL AS VARCHAR) AS load_dttm"


def _merged(target: str, source: str, columns: list[str], key: list[str], update: list[str]) -> str:
    """Every target row, overwritten where a source row has its natural key, and every
    source row without one."""
    days = {"craftsman_birthday", "customer_birthday", "order_created_date",
            "order_completion_date"}

    def shown(value: str, name: str) -> str:
        return f"strftime({value}, '%Y-%m-%d') AS {name}" if name in days else f"{value} AS {name}"

    def value(name: str) -> str:
        if name in update:
            return f"CASE WHEN s.hit THEN s.{name} ELSE t.{name} END"
        return f"coalesce(t.{name}, s.{name})"

    shown_columns = ", ".join(shown(value(name), name) for name in columns)
    match = " AND ".join(f"t.{name} = s.{name}" for name in key)
    return f"""SELECT {shown_columns},
  CASE WHEN s.hit THEN '{SECOND_RUN}' ELSE '{FIRST_RUN}' END AS load_dttm
FROM {target} t FULL OUTER JOIN (SELECT DISTINCT *, true AS hit FROM {source}) s ON {match}"""


def statements() -> dict[str, str]:
    mart = _report("mart", "star")
    first_mart = _report("first_mart", "first_star")
    full_report = _with(_report_select("mart"), mart)
    stamps = [
        "order_load_dttm", "craftsman_load_dttm", "customers_load_dttm", "products_load_dttm",
    ]
    star_columns = f"""{_CUSTOMER}, order_id, product_id, product_name, product_price,
  product_type, {_day("order_completion_date")}, {_day("order_created_date")}, order_status,
  report_month, craftsman_name, {", ".join(_time(c) for c in stamps)}"""
    update_columns = ", ".join(
        f"strftime(coalesce(n.{c}, o.{c}), '%Y-%m-%d') AS {c}"
        if c == "customer_birthday"
        else f"CASE WHEN n.customer_id IS NULL THEN o.{c} ELSE n.{c} END AS {c}"
        for c in _REPORT_COLUMNS
    )
    return {
        "distinct_craftsman": _with(f"SELECT DISTINCT {_CRAFTSMAN} FROM sold_craftsmen"),
        "distinct_product": _with(f"SELECT DISTINCT {_PRODUCT} FROM sold_products"),
        "distinct_customer": _with(f"SELECT DISTINCT {_CUSTOMER} FROM customers"),
        "distinct_order": _with(f"SELECT DISTINCT {_ORDER} FROM all_orders"),
        "new_customer_files": _with(f"SELECT {_CUSTOMER} FROM second_customers"),
        "load_craftsman": _with(
            f"SELECT DISTINCT {_CRAFTSMAN}, {_NO_STAMP} FROM sold_craftsmen"
        ),
        "load_product": _with(f"SELECT DISTINCT {_PRODUCT}, {_NO_STAMP} FROM sold_products"),
        "load_customer": _with(f"SELECT DISTINCT {_CUSTOMER}, {_NO_STAMP} FROM customers"),
        "load_order": _with(f"SELECT DISTINCT {_ORDER}, {_NO_STAMP} FROM all_orders"),
        "star_join": _with(f"SELECT {star_columns} FROM star"),
        "orphan_orders": _with(
            """SELECT order_id, order_customer_id, order_product_id, order_craftsman_id,
  c.craftsman_id IS NULL AS no_craftsman, u.customer_id IS NULL AS no_customer,
  p.product_id IS NULL AS no_product
FROM all_orders
LEFT JOIN earlier_craftsmen c ON order_craftsman_id = c.craftsman_id
LEFT JOIN first_customers u ON order_customer_id = u.customer_id
LEFT JOIN earlier_products p ON order_product_id = p.product_id
WHERE c.craftsman_id IS NULL OR u.customer_id IS NULL OR p.product_id IS NULL"""
        ),
        "monthly_agg": _measure_select(
            "customer_paid",
            "customer_earned",
            "customer_order_count",
            "customer_avg_price_per_month",
        ),
        "status_counts": _measure_select(*[c for c in _REPORT_COLUMNS if c.startswith("number")]),
        "median_days": _measure_select("median_completion_time_per_month"),
        "top_product": _with(
            """SELECT customer_id, customer_most_popular_product_per_month, report_month
FROM mart_products""",
            mart,
        ),
        "top_craftsman": _with(
            """SELECT customer_id, customer_most_popular_craftsman, report_month
FROM mart_craftsmen""",
            mart,
        ),
        "mart_full": full_report,
        "mart_full_onepass": full_report,
        "conform_mart": _with(
            _report_select("mart").replace("SELECT", "SELECT CAST(NULL AS DOUBLE) AS id,", 1),
            mart,
        ),
        "mart_ids": _with(
            _report_select("mart").replace(
                "SELECT",
                "SELECT CAST(row_number() OVER (ORDER BY customer_id, report_month) AS INTEGER)"
                " AS id,",
                1,
            ),
            mart,
        ),
        "check_pk": """SELECT l_orderkey, l_linenumber, count(*) AS row_count
FROM lineitem GROUP BY ALL HAVING count(*) > 1""",
        "check_not_null": _with(
            " UNION ALL ".join(
                f"SELECT '{c}' AS column_name, count(*) AS null_count FROM all_orders"
                f" WHERE {c} IS NULL HAVING count(*) > 0"
                for c in (
                    "order_id", "order_customer_id", "order_product_id", "order_craftsman_id",
                    "order_created_date", "order_completion_date", "order_status",
                )
            )
            + " UNION ALL SELECT 'load_dttm', count(*) FROM all_orders HAVING count(*) > 0"
        ),
        "check_merge_cardinality": _with(
            """SELECT s.craftsman_name, s.craftsman_email,
  count(DISTINCT order_created_date) AS source_rows
FROM all_orders JOIN sold_craftsmen s ON order_craftsman_id = s.craftsman_id
JOIN earlier_craftsmen t USING (craftsman_name, craftsman_email)
GROUP BY ALL HAVING count(DISTINCT order_created_date) > 1"""
        ),
        "latest_craftsman": _with(
            f"""SELECT {_CRAFTSMAN},
  strftime(CAST(max(order_created_date) AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS load_dttm
FROM all_orders JOIN craftsmen ON order_craftsman_id = craftsman_id
GROUP BY craftsman_id, craftsman_name, craftsman_address, craftsmen.craftsman_birthday,
  craftsman_email"""
        ),
        "merge_craftsman": _with(
            _merged(
                "earlier_craftsmen",
                "sold_craftsmen",
                ["craftsman_id", "craftsman_name", "craftsman_address", "craftsman_birthday",
                 "craftsman_email"],
                ["craftsman_name", "craftsman_email"],
                ["craftsman_id", "craftsman_address", "craftsman_birthday"],
            )
        ),
        "merge_product": _with(
            _merged(
                "earlier_products",
                "sold_products",
                ["product_id", "product_name", "product_description", "product_type",
                 "product_price"],
                ["product_name", "product_description", "product_price"],
                ["product_id", "product_type"],
            )
        ),
        "merge_customer": _with(
            _merged(
                "first_customers",
                "second_customers",
                ["customer_id", "customer_name", "customer_address", "customer_birthday",
                 "customer_email"],
                ["customer_name", "customer_email"],
                ["customer_id", "customer_address", "customer_birthday"],
            )
        ),
        "merge_order": _with(
            _merged(
                "first_orders",
                "second_orders",
                ["order_id", "order_customer_id", "order_product_id", "order_craftsman_id",
                 "order_created_date", "order_completion_date", "order_status"],
                ["order_product_id", "order_craftsman_id", "order_customer_id",
                 "order_created_date"],
                ["order_id", "order_completion_date", "order_status"],
            )
        ),
        "merge_touch_changed": _with(
            f"""SELECT s.customer_id, s.customer_name, s.customer_address,
  strftime(s.customer_birthday, '%Y-%m-%d') AS customer_birthday, s.customer_email,
  CASE WHEN t.customer_id = s.customer_id AND t.customer_address = s.customer_address
        AND t.customer_birthday = s.customer_birthday
       THEN '{FIRST_RUN}' ELSE '{SECOND_RUN}' END AS load_dttm
FROM customers s LEFT JOIN first_customers t USING (customer_name, customer_email)"""
        ),
        "hwm_read": """SELECT
  strftime(coalesce(max(CAST(o_orderdate AS DATE)), DATE '1900-01-01'), '%Y-%m-%d') AS load_dttm
FROM orders""",
        "hwm_next": _with(
            f"""SELECT strftime(CAST(greatest(
  coalesce(max(craftsman_load_dttm), TIMESTAMP '{FIRST_RUN}'),
  coalesce(max(customers_load_dttm), TIMESTAMP '{FIRST_RUN}'),
  coalesce(max(products_load_dttm), TIMESTAMP '{FIRST_RUN}')) AS DATE), '%Y-%m-%d') AS load_dttm
FROM delta"""
        ),
        "delta": _with(f"SELECT {star_columns} FROM delta"),
        "delta_flagged": _with(
            f"""SELECT {star_columns.replace("customer_id", "d.customer_id", 1)},
  CAST(k.customer_id AS DOUBLE) AS exist_customer_id
FROM delta d LEFT JOIN (SELECT customer_id FROM known) k ON d.customer_id = k.customer_id"""
        ),
        "new_customers": _with(
            "SELECT customer_id FROM affected WHERE customer_id NOT IN (FROM known)"
        ),
        "affected_customers": _with("SELECT customer_id FROM affected"),
        "affected_months": _with("SELECT DISTINCT customer_id, report_month FROM delta"),
        "affected_history": _with(
            f"""SELECT {_ORDER}, strftime(order_load_dttm, '%Y-%m-%d %H:%M:%S') AS load_dttm
FROM stamped_orders WHERE order_customer_id IN (FROM affected)"""
        ),
        "mart_insert_rows": _with(
            _report_select("mart")
            + " WHERE customer_id IN (FROM affected) AND customer_id NOT IN (FROM known)",
            mart,
        ),
        "mart_update": _with(
            f"""SELECT {update_columns}
FROM first_mart o LEFT JOIN mart n USING (customer_id, report_month)""",
            mart,
            first_mart,
        ),
        "mart_incremental": full_report,
        "mart_incremental_exact": full_report,
    }

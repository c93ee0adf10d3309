"""The same results as the Spark queries, in SQL for DuckDB."""

from datetime import timedelta

_RAW = """
raw AS (
  SELECT cast(l_orderkey AS varchar) AS transaction_id,
    strftime(o_orderdate, '%Y-%m-%d') AS transaction_date,
    cast(o_custkey AS varchar) AS customer_id,
    ' ' || c_mktsegment AS customer_fname,
    c_name || ' ' AS cusomter_lname,
    ' ' || lower(c_name) || '@x.com99 ' AS cusomter_email,
    cast(l_suppkey AS varchar) AS sales_agent_id,
    cast(s_nationkey AS varchar) AS branch_id,
    cast(l_partkey AS varchar) AS product_id,
    p_name AS product_name,
    p_type AS product_category,
    CASE WHEN round(l_discount * 100) >= 9 THEN 'True' END AS offer_1,
    CASE WHEN round(l_discount * 100) >= 7 THEN 'True' END AS offer_2,
    CASE WHEN round(l_discount * 100) >= 5 THEN 'True' END AS offer_3,
    CASE WHEN round(l_discount * 100) >= 3 THEN 'True' END AS offer_4,
    CASE WHEN round(l_discount * 100) >= 1 THEN 'True' END AS offer_5,
    cast(cast(l_quantity AS integer) AS varchar) AS units,
    cast(p_retailprice AS varchar) AS unit_price,
    CASE l_returnflag WHEN 'N' THEN 'yes' WHEN 'A' THEN 'no' ELSE 'maybe' END AS is_online,
    o_orderpriority AS payment_method,
    CASE WHEN l_returnflag = 'N' THEN
      c_name || '/ ' || n_name || '/' || r_name
      || CASE WHEN c_custkey % 7 <> 0 THEN '/' || cast(c_custkey AS varchar) ELSE '' END
    END AS shipping_address
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey
)"""

_OFFERS = ", ".join(
    f"coalesce(cast(offer_{n} AS boolean), false) AS offer_{n}" for n in range(1, 6)
)
_PARTS = ", ".join(
    f"trim(string_split(shipping_address, '/')[{n}]) AS {name}"
    for n, name in enumerate(("address", "city", "state", "postal_code"), start=1)
)
_DISCOUNT = (
    "CASE WHEN offer_1 THEN 5 WHEN offer_2 THEN 10 WHEN offer_3 THEN 15"
    " WHEN offer_4 THEN 20 WHEN offer_5 THEN 25 ELSE 0 END"
)

_CLEAN = f"""{_RAW},
clean AS (
  SELECT DISTINCT transaction_id, transaction_date, customer_id,
    trim(customer_fname) AS customer_fname, trim(cusomter_lname) AS customer_lname,
    trim(regexp_replace(trim(cusomter_email), '(\\.com).*', '.com')) AS customer_email,
    sales_agent_id, branch_id, product_id, trim(product_name) AS product_name,
    trim(product_category) AS product_category, {_OFFERS},
    units, unit_price, is_online, payment_method,
    trim(shipping_address) AS shipping_address, {_PARTS}
  FROM raw
)"""

_FACT = f"""{_CLEAN},
fact AS (
  SELECT *, units * unit_price * (1 - discount_percentage / 100) AS total_paid_price
  FROM (
    SELECT transaction_id, customer_id, sales_agent_id, branch_id, product_id,
      cast(units AS integer) AS units, cast(unit_price AS double) AS unit_price,
      cast({_DISCOUNT} AS double) AS discount_percentage,
      CASE is_online WHEN 'yes' THEN true WHEN 'no' THEN false END AS is_online,
      transaction_date
    FROM clean
  )
)"""
_FACT_COLUMNS = (
    "transaction_id, customer_id, sales_agent_id, branch_id, product_id, units, unit_price,"
    " discount_percentage, total_paid_price, is_online, transaction_date"
)


def _first_row(source, key, fields, order=()):
    """One row per key: the smallest by order, then by the fields, nulls last."""
    names = [field.split(" AS ")[-1] for field in fields]
    ranking = ", ".join(f"{name} NULLS LAST" for name in (*order, *names))
    columns = ", ".join(dict.fromkeys([key, *_ORDER_COLUMNS[: len(order)], *fields]))
    return f"""
  SELECT {', '.join([key, *names])} FROM (
    SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {ranking}) AS place
    FROM (SELECT {columns} FROM {source})
  ) WHERE place = 1"""


_ORDER_COLUMNS = ("transaction_date", "transaction_id")
_SALE_ORDER = ("transaction_date", "try_cast(transaction_id AS bigint)", "transaction_id")
_CUSTOMER_FIELDS = (
    "customer_fname AS first_name",
    "customer_lname AS last_name",
    "customer_email AS email",
    "address",
    "city",
    "state",
    "postal_code",
)
_PRODUCT_FIELDS = ("product_name", "product_category")


def _customers(source="clean"):
    return _first_row(source, "customer_id", _CUSTOMER_FIELDS, _SALE_ORDER)


def _products(source="clean"):
    return _first_row(source, "product_id", _PRODUCT_FIELDS, _SALE_ORDER)


def _first_then_new(key, dimension, split_column, split_value):
    """Rows of the first batch, then those of the second whose key is new."""
    early = dimension(f"(SELECT * FROM clean WHERE {split_column} < '{split_value}')")
    late = dimension(f"(SELECT * FROM clean WHERE {split_column} >= '{split_value}')")
    return f"""WITH {_CLEAN}, early AS ({early}), late AS ({late})
SELECT * FROM early
UNION ALL
SELECT * FROM late WHERE {key} NOT IN (SELECT {key} FROM early)"""


_STAR = f"""
star AS (
  SELECT *, cents * units * cast(100 - discount_percentage AS bigint) AS paid_units
  FROM (SELECT cast(l_orderkey AS varchar) AS transaction_id,
    cast(o_custkey AS varchar) AS customer_id,
    cast(l_suppkey AS varchar) AS sales_agent_id,
    cast(l_partkey AS varchar) AS product_id,
    cast(l_quantity AS integer) AS units,
    cast(CASE WHEN d >= 9 THEN 5 WHEN d >= 7 THEN 10 WHEN d >= 5 THEN 15
      WHEN d >= 3 THEN 20 WHEN d >= 1 THEN 25 ELSE 0 END AS double) AS discount_percentage,
    CASE l_returnflag WHEN 'N' THEN true WHEN 'A' THEN false END AS is_online,
    cast(round(p_retailprice * 100) AS bigint) AS cents,
    cast(o_orderdate AS date) AS day, p_name, p_type, s_name, n_name, c_mktsegment, c_name
  FROM (SELECT *, round(l_discount * 100) AS d FROM lineitem)
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey)
)"""

_EVENTS = """
flat AS (
  SELECT event_type AS "eventType", cast(user_id AS varchar) AS "customerId",
    cast(k AS varchar) AS "productId", date_trunc('second', ts) AS "timestamp",
    CASE WHEN event_type = 'view' THEN
      ['Electronics', 'Clothing', 'Home & Kitchen', 'Books'][k % 4 + 1] END AS category,
    CASE WHEN event_type = 'view' THEN
      ['Advertisement', 'Search', 'Direct'][k % 3 + 1] END AS source,
    CASE WHEN event_type = 'purchase' THEN k % 5 + 1 END AS quantity,
    CASE WHEN event_type = 'purchase' THEN value END AS "totalAmount",
    CASE WHEN event_type = 'purchase' THEN
      ['Credit Card', 'Debit Card', 'PayPal'][k % 3 + 1] END AS "paymentMethod",
    cast(NULL AS varchar) AS "recommendedProductId", cast(NULL AS varchar) AS algorithm,
    cast(ts AS date) AS event_date, cast(hour(ts) AS integer) AS event_hour
  FROM (SELECT *, cast(json_extract_string(props, '$.k') AS integer) AS k FROM events)
)"""

_GOOD_EVENTS = f"""WITH {_EVENTS}
SELECT * FROM flat WHERE "eventType" NOT IN ('error', 'signup')"""

_REJECTS = f"""WITH {_EVENTS}
SELECT '{{"eventType":"' || "eventType" || '","customerId":"' || "customerId" || '"'
  || CASE WHEN "eventType" = 'error' THEN ''
     ELSE ',"productId":"' || "productId" || '","timestamp":"some day","metadata":{{}}}}' END
    AS raw_value,
  CASE "eventType" WHEN 'error' THEN 'unreadable' ELSE 'no event time' END AS reject_reason
FROM flat WHERE "eventType" IN ('error', 'signup')"""

_PAID = "cast(sum(paid_units) AS bigint)"
_CENTS = f"cast(({_PAID} + 50) // 100 AS bigint) / 100.0"
_AMOUNT = 'cast(sum(cast(round("totalAmount" * 100) AS bigint)) AS bigint) / 100.0'


def _purchases(key, total):
    return f"""WITH {_EVENTS}
SELECT {key}, {_AMOUNT} AS {total} FROM flat WHERE "eventType" = 'purchase' GROUP BY {key}"""


_FACT_SQL = f"WITH {_FACT} SELECT {_FACT_COLUMNS} FROM fact"
_AGENTS = (
    "SELECT cast(s_suppkey AS varchar) AS sales_person_id, s_name AS name FROM supplier"
)
_BRANCHES = (
    "SELECT cast(n_nationkey AS varchar) AS branch_id, cast(n_regionkey AS varchar) AS class,"
    " n_name AS location FROM nation"
)
_DAILY = """
SELECT s_name AS sales_agent_name, p_name AS product_name,
  cast(sum(units) AS bigint) AS total_sold_units
FROM star WHERE day = DATE '{day}' GROUP BY s_name, p_name"""


def _with_files(compacted):
    """Good events with the files of their hour: landed as two, where it has two events or more."""
    return f"""WITH {_EVENTS}, good AS (
  SELECT * FROM flat WHERE "eventType" NOT IN ('error', 'signup')
)
SELECT *, CASE WHEN {compacted} THEN 1
  ELSE least(2, count(*) OVER (PARTITION BY event_date, event_hour)) END AS files
FROM good"""


def _late_events(compaction):
    """All events, purchases 400 days late; closed hours are one file."""
    late = "\"eventType\" = 'purchase'"
    return f"""WITH {_EVENTS}, moved AS (
  SELECT * REPLACE (
    CASE WHEN {late} THEN "timestamp" - INTERVAL 400 DAY ELSE "timestamp" END AS "timestamp",
    CASE WHEN {late} THEN cast(event_date - INTERVAL 400 DAY AS date) ELSE event_date END AS event_date
  ) FROM flat
)
SELECT *, CASE WHEN event_date + to_hours(event_hour) < TIMESTAMP '{compaction:%Y-%m-%d %H:00:00}'
  THEN cast(1 AS bigint) END AS files FROM moved"""


def build(report_day: str, customer_split: str, product_split: str, compaction) -> dict[str, str]:
    """SQL per query name, for the given report day, batch borders and time of a compaction."""
    closed = compaction - timedelta(hours=1)
    daily = f"WITH {_STAR}" + _DAILY.format(day=report_day)
    raw_trimmed = ", ".join(
        f"trim({name}) AS {name}"
        for name in (
            "transaction_id transaction_date customer_id customer_fname cusomter_lname"
            " cusomter_email sales_agent_id branch_id product_id product_name product_category"
            " offer_1 offer_2 offer_3 offer_4 offer_5 units unit_price is_online payment_method"
            " shipping_address"
        ).split()
    )
    return {
        "csv_sales_scan": f"WITH {_RAW} SELECT * FROM raw",
        "incremental_landing": f"WITH {_RAW} SELECT * FROM raw",
        "csv_sales_scan_mixed_headers": f"WITH {_RAW} SELECT * FROM raw",
        "union_batches": f"""WITH {_RAW}
SELECT transaction_id, product_id, sales_agent_id, units FROM raw
UNION ALL SELECT transaction_id, product_id, sales_agent_id, units FROM raw""",
        "dedup_rows": f"WITH {_CLEAN} SELECT * FROM clean",
        "trim_all": f"WITH {_RAW} SELECT {raw_trimmed} FROM raw",
        "clean_email": f"""WITH {_RAW} SELECT transaction_id, customer_id,
  regexp_replace(trim(cusomter_email), '(\\.com).*', '.com') AS customer_email FROM raw""",
        "split_address": f"WITH {_RAW} SELECT transaction_id, product_id, {_PARTS} FROM raw",
        "yes_no_flag": f"""WITH {_RAW} SELECT transaction_id, product_id,
  CASE is_online WHEN 'yes' THEN true WHEN 'no' THEN false END AS is_online FROM raw""",
        "discount_rule": f"""WITH {_RAW} SELECT transaction_id, product_id,
  cast({_DISCOUNT} AS integer) AS discount_percentage
FROM (SELECT transaction_id, product_id, {_OFFERS} FROM raw)""",
        "total_paid_price": f"""WITH {_FACT}
SELECT transaction_id, product_id, units, unit_price,
  cast(discount_percentage AS integer) AS discount_percentage, total_paid_price FROM fact""",
        "fact_projection": _FACT_SQL,
        "fact_load": _FACT_SQL,
        "fact_load_rerun": _FACT_SQL,
        "dim_customer": f"WITH {_CLEAN} {_customers()}",
        "dim_product": f"WITH {_CLEAN} {_products()}",
        "dim_sales_agent": _AGENTS,
        "dim_branch": _BRANCHES,
        "dim_customer_incremental": _first_then_new(
            "customer_id", _customers, "transaction_date", customer_split
        ),
        "dim_product_incremental": _first_then_new(
            "product_id", _products, "transaction_date", product_split
        ),
        "dim_agent_incremental": """
SELECT cast(s_suppkey AS varchar) AS sales_person_id,
  CASE WHEN s_acctbal < 5000 THEN s_name ELSE upper(s_name) END AS name FROM supplier""",
        "dim_branch_incremental": """
SELECT cast(n_nationkey AS varchar) AS branch_id, cast(n_regionkey AS varchar) AS class,
  CASE WHEN n_regionkey < 2 THEN n_name ELSE lower(n_name) END AS location FROM nation""",
        "table_sample": f"""WITH {_FACT} SELECT {_FACT_COLUMNS} FROM fact
ORDER BY transaction_id, product_id, sales_agent_id, units, discount_percentage,
  is_online NULLS FIRST LIMIT 20""",
        "most_selling_products": f"""WITH {_STAR}
SELECT product_id, p_name AS product_name, cast(sum(units) AS bigint) AS total_units_sold
FROM star GROUP BY product_id, p_name""",
        "lowest_online_cities": f"""WITH {_STAR}
SELECT n_name AS city,
  {_PAID} / 10000.0 AS total_online_sales
FROM star WHERE is_online GROUP BY n_name""",
        "loaded_lowest_online_cities": f"""WITH {_FACT}, customers AS ({_customers()})
SELECT city, cast(sum(cast(round(unit_price * 100) AS bigint) * units
  * cast(100 - discount_percentage AS bigint)) AS bigint) / 10000.0 AS total_online_sales
FROM fact JOIN customers USING (customer_id) WHERE is_online GROUP BY city""",
        "most_redeemed_offers": f"""WITH {_STAR}
SELECT discount_percentage, count(*) AS number_of_sales FROM star GROUP BY 1""",
        "top_offers_per_product": f"""WITH {_STAR}
SELECT product_id, p_name AS product_name, discount_percentage, count(*) AS purchase_count
FROM star WHERE discount_percentage <> 0 GROUP BY 1, 2, 3""",
        "daily_sales_dump": daily,
        "daily_sales_csv": daily,
        "customer_purchase_behavior": f"""WITH {_STAR}
SELECT c_mktsegment || ' ' || c_name AS "Customer_Name",
  count(DISTINCT transaction_id) AS total_transactions, {_CENTS} AS total_spent
FROM star GROUP BY c_mktsegment, c_name""",
        "sales_by_category": f"""WITH {_STAR}
SELECT p_type AS product_category, cast(sum(units) AS bigint) AS total_units_sold,
  {_CENTS} AS total_revenue FROM star GROUP BY p_type""",
        "products_by_revenue": f"""WITH {_STAR}
SELECT p_name AS product_name, cast(sum(units) AS bigint) AS total_units_sold,
  {_CENTS} AS total_revenue FROM star GROUP BY p_name""",
        "units_by_product_name": f"""WITH {_CLEAN}
SELECT product_name, cast(sum(cast(units AS integer)) AS bigint) AS total_units_sold
FROM clean GROUP BY product_name""",
        "parse_event_json": f"WITH {_EVENTS} SELECT * FROM flat",
        "event_time_parts": f"""WITH {_EVENTS}
SELECT "customerId", "timestamp", event_date, event_hour FROM flat""",
        "quarantine_events": _REJECTS,
        "stream_land_rejects": _REJECTS,
        "stream_land_events": _GOOD_EVENTS,
        "compact_partition": _with_files(
            f"event_date = DATE '{closed:%Y-%m-%d}' AND event_hour = {closed.hour}"
        ),
        "compact_range": _with_files(f"\"timestamp\" < TIMESTAMP '{compaction}'"),
        "landed_popular_categories": f"""WITH {_EVENTS}
SELECT category, count(*) AS total_events FROM flat
WHERE "eventType" NOT IN ('error', 'signup') GROUP BY category""",
        "repair_partitions": _GOOD_EVENTS,
        "late_events_in_table": _late_events(compaction),
        "sales_by_payment_method": _purchases('"paymentMethod"', "total_sales"),
        "popular_categories": f"""WITH {_EVENTS}
SELECT category, count(*) AS total_events FROM flat GROUP BY category""",
        "revenue_by_customer": _purchases('"customerId"', "total_revenue"),
        "hourly_sales": _purchases("event_hour", "total_sales"),
    }

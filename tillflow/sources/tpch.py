"""TPC-H-like tables in the shapes this library works on.

Two kinds of adapter. The raw ones give what a shop would drop: text columns, with
padding, junk and gaps. The star ones give stored tables; `sales_fact` joins only
the tables its asked-for columns need, as a stored fact would read only those columns.
"""

from datetime import date, datetime, time, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow import fixed_values as V
from tillflow import schemas as S
from tillflow.functions.flags import discount_percentage, yes_no_flag
from tillflow.functions.money import total_paid_price
from tillflow.functions.text import split_address
from tillflow.sources.workspace import file_system

# Words the apps send.
_CATEGORIES = ("Electronics", "Clothing", "Home & Kitchen", "Books")
_SOURCES = ("Advertisement", "Search", "Direct")
_PAYMENTS = ("Credit Card", "Debit Card", "PayPal")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def input_bytes(spark: SparkSession, folder: str) -> int:
    """Bytes of the tables that grow with the shop."""
    total = 0
    for name in ("customer", "supplier", "part", "orders", "lineitem", "events"):
        system, place = file_system(spark, f"{folder}/{name}.parquet")
        if system.exists(place):
            total += system.getContentSummary(place).getLength()
    return total


def _offers() -> dict[str, Column]:
    """Overlapping offer conditions, so that their precedence matters."""
    # From 9, 7, 5, 3 and 1 percent on, with a border between two percents.
    return {
        f"offer_{number}": F.col("l_discount") > (10.5 - 2 * number) / 100 for number in range(1, 6)
    }


def _online_word() -> Column:
    flag = F.col("l_returnflag")
    return F.when(flag == "N", "yes").when(flag == "A", "no").otherwise("maybe")


def _date_text() -> Column:
    return F.date_format("o_orderdate", "yyyy-MM-dd")


def _email() -> Column:
    return F.concat(F.lit(" "), F.lower("c_name"), F.lit("@x.com99 "))


def _address() -> Column:
    postal = F.when(F.col("c_custkey") % 7 != 0, F.col("c_custkey").cast("string"))
    return F.concat_ws("/", "c_name", F.concat(F.lit(" "), "n_name"), "r_name", postal)


def raw_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Sales lines as a raw drop holds them.

    The texts of an order and its customer join last, to lines that hold what else they need: the
    lines, the largest table, are shuffled while they are narrow, and come out order by order.
    """
    places = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    customers = table(spark, folder, "customer").join(
        places, F.col("c_nationkey") == F.col("n_nationkey")
    )
    orders = table(spark, folder, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))
    lines = (
        table(spark, folder, "lineitem")
        .join(table(spark, folder, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
        # Orders grow with the lines; a merge join does not depend on their size.
        .join(orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
    )
    columns = {
        "transaction_id": F.col("l_orderkey"),
        "transaction_date": _date_text(),
        "customer_id": F.col("o_custkey"),
        "customer_fname": F.concat(F.lit(" "), "c_mktsegment"),
        "cusomter_lname": F.concat("c_name", F.lit(" ")),
        "cusomter_email": _email(),
        "sales_agent_id": F.col("l_suppkey"),
        "branch_id": F.col("s_nationkey"),
        "product_id": F.col("l_partkey"),
        "product_name": F.col("p_name"),
        "product_category": F.col("p_type"),
        **{name: F.when(is_set, "True") for name, is_set in _offers().items()},
        "units": F.col("l_quantity").cast("int"),
        "unit_price": F.col("p_retailprice"),
        "is_online": _online_word(),
        "payment_method": F.col("o_orderpriority"),
        "shipping_address": F.when(_online_word() == V.ONLINE_WORD, _address()),
    }
    return lines.select([columns[name].cast("string").alias(name) for name in V.SALES_COLUMNS])


def raw_agents(spark: SparkSession, folder: str) -> DataFrame:
    """Sales agents as a raw drop holds them."""
    return table(spark, folder, "supplier").select(
        F.col("s_suppkey").cast("string").alias("sales_person_id"),
        F.concat(F.lit(" "), "s_name").alias("name"),
    )


def raw_branches(spark: SparkSession, folder: str) -> DataFrame:
    """Branches as a raw drop holds them."""
    return table(spark, folder, "nation").select(
        F.col("n_nationkey").cast("string").alias("branch_id"),
        F.col("n_regionkey").cast("string").alias("class"),
        F.concat("n_name", F.lit(" ")).alias("location"),
    )


def sales_fact(
    spark: SparkSession, folder: str, *wanted: str, day: date | None = None
) -> DataFrame:
    """The fact with the wanted columns, of all days or of one.

    A stored fact is partitioned by day; here the day is pushed into the scan of the orders.
    """
    columns = {
        "transaction_id": F.col("l_orderkey").cast("string"),
        "customer_id": F.col("o_custkey").cast("string"),
        "sales_agent_id": F.col("l_suppkey").cast("string"),
        "product_id": F.col("l_partkey").cast("string"),
        "units": F.col("l_quantity").cast("int"),
        "unit_price": F.col("p_retailprice"),
        "discount_percentage": discount_percentage(_offers()).cast("double"),
        "total_paid_price": total_paid_price(
            F.col("l_quantity").cast("int"), F.col("p_retailprice"), discount_percentage(_offers())
        ),
        "is_online": yes_no_flag(_online_word()),
        S.FACT_PARTITION: _date_text(),
    }
    lines = table(spark, folder, "lineitem")
    if {"customer_id", S.FACT_PARTITION} & set(wanted):
        orders = table(spark, folder, "orders")
        if day is not None:
            start = datetime.combine(day, time())
            first, next_first = (
                F.lit(border.isoformat()).cast("timestamp_ntz")
                for border in (start, start + timedelta(days=1))
            )
            orders = orders.where(
                (F.col("o_orderdate") >= first) & (F.col("o_orderdate") < next_first)
            )
        lines = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    if {"unit_price", "total_paid_price"} & set(wanted):
        parts = table(spark, folder, "part")
        lines = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    return lines.select([columns[name].alias(name) for name in wanted])


def stored_customers(spark: SparkSession, folder: str) -> DataFrame:
    """The customer dimension."""
    places = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return (
        table(spark, folder, "customer")
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_custkey").cast("string").alias("customer_id"),
            F.col("c_mktsegment").alias("first_name"),
            F.col("c_name").alias("last_name"),
            *[part.alias(name) for name, part in split_address(_address()).items()],
        )
    )


def stored_products(spark: SparkSession, folder: str) -> DataFrame:
    """The product dimension."""
    return table(spark, folder, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("product_category"),
    )


def stored_agents(spark: SparkSession, folder: str) -> DataFrame:
    """The sales agent dimension."""
    return table(spark, folder, "supplier").select(
        F.col("s_suppkey").cast("string").alias("sales_person_id"), F.col("s_name").alias("name")
    )


def _one_of(words, number: Column) -> Column:
    return F.get(F.array(*[F.lit(word) for word in words]), (number % len(words)).cast("int"))


def _event_columns() -> dict[str, Column]:
    number = F.col("number")
    kind = F.col("event_type")
    return {
        "eventType": kind,
        "customerId": F.col("user_id").cast("string"),
        "productId": number.cast("string"),
        "category": F.when(kind == "view", _one_of(_CATEGORIES, number)),
        "source": F.when(kind == "view", _one_of(_SOURCES, number)),
        "quantity": F.when(kind == V.PURCHASE_EVENT, number % 5 + 1),
        "totalAmount": F.when(kind == V.PURCHASE_EVENT, F.col("value")),
        "paymentMethod": F.when(kind == V.PURCHASE_EVENT, _one_of(_PAYMENTS, number)),
        "recommendedProductId": F.lit(None).cast("string"),
        "algorithm": F.lit(None).cast("string"),
    }


def _numbered_events(spark: SparkSession, folder: str) -> DataFrame:
    number = F.get_json_object("props", "$.k").cast("int")
    return table(spark, folder, "events").withColumn("number", number)


def stored_events(spark: SparkSession, folder: str) -> DataFrame:
    """The flat event table."""
    time = F.date_trunc("second", F.col("ts").cast("timestamp"))
    columns = {**_event_columns(), "timestamp": time}
    return (
        _numbered_events(spark, folder)
        .select([columns[name].alias(name) for name in S.EVENT_COLUMNS])
        .withColumns({"event_date": F.to_date("timestamp"), "event_hour": F.hour("timestamp")})
    )


def event_records(spark: SparkSession, folder: str, junk: bool = False) -> DataFrame:
    """Events as JSON text in a `value` column, with their time for ordering.

    With `junk`, error events are cut in the middle and signups carry no readable time.
    """
    columns = _event_columns()
    time = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    if junk:
        time = F.when(F.col("event_type") == "signup", "some day").otherwise(time)
    body = F.struct(
        columns["eventType"].alias("eventType"),
        columns["customerId"].alias("customerId"),
        columns["productId"].alias("productId"),
        time.alias("timestamp"),
        F.struct(columns["category"].alias("category"), columns["source"].alias("source")).alias(
            "metadata"
        ),
        *[
            columns[name].alias(name)
            for name in ("quantity", "totalAmount", "paymentMethod", "algorithm")
        ],
    )
    value = F.to_json(body)
    if junk:
        value = F.when(
            F.col("event_type") == "error", F.substring_index(value, ",", 2)
        ).otherwise(value)
    return _numbered_events(spark, folder).select(value.alias("value"), "ts")

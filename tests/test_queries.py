"""Business queries against plain Python on small frames, and their plans."""

from collections import Counter, defaultdict
from datetime import date

import pytest
from pyspark.sql import functions as F

from tillflow import schemas as S
from tillflow.plans import app_events, b2b, batch_report, marketing

FACT_SCHEMA = (
    ", ".join(f"{name} {type_}" for name, type_ in S.FACT_COLUMNS.items())
    + ", transaction_date string"
)
PRODUCTS = [("p1", "Kettle", "Kitchen"), ("p2", "Lamp", "Light"), ("p3", "Lamp", "Kitchen")]
CUSTOMERS = [
    ("c1", "Ann", "Lee", "Cairo"),
    ("c2", "Ann", "Lee", None),
    ("c3", "Bob", None, "Giza"),
]
AGENTS = [("a1", "Zoe"), ("a2", "Yan"), ("a3", "Zoe")]


def line(txn, customer, agent, product, units, price, discount, online, day="2022-01-16"):
    paid = units * price * (1 - discount / 100) if units is not None else None
    return (txn, customer, agent, "b", product, units, price, float(discount), paid, online, day)


LINES = [
    line("t1", "c1", "a1", "p1", 2, 10.05, 0, True),
    line("t1", "c1", "a1", "p2", 1, 3.0, 5, True),
    line("t2", "c2", "a2", "p1", 4, 10.05, 25, True),
    line("t1", "c2", "a3", "p1", 1, 10.05, 0, False),
    line("t3", "c3", "a3", "p3", 7, 0.35, 10, None),
    line("t4", "c3", None, "p3", 1, 0.35, 10, True, "2022-01-17"),
    line("t5", None, "a1", "p1", 1, 10.05, 0, True),
    line("t6", "c1", "a1", None, 1, 10.05, 15, False),
    line("t7", "c1", "a1", "p9", None, 10.05, 0, False),
]


@pytest.fixture(scope="module")
def star(spark):
    return {
        "fact": spark.createDataFrame(LINES, FACT_SCHEMA),
        "products": spark.createDataFrame(
            PRODUCTS, "product_id string, product_name string, product_category string"
        ),
        "customers": spark.createDataFrame(
            CUSTOMERS, "customer_id string, first_name string, last_name string, city string"
        ),
        "agents": spark.createDataFrame(AGENTS, "sales_person_id string, name string"),
    }


def rows(df):
    return [tuple(row) for row in df.collect()]


def test_most_selling_products(star):
    assert rows(marketing.most_selling_products(star["fact"], star["products"])) == [
        ("p1", "Kettle", 8),
        ("p3", "Lamp", 8),
        ("p2", "Lamp", 1),
    ]


def test_a_repeated_product_counts_for_each_of_its_rows(spark, star):
    again = [("p2", "Lamp", "Other"), ("p2", "Torch", "Light")]
    products = star["products"].union(spark.createDataFrame(again, star["products"].schema))
    got = rows(marketing.most_selling_products(star["fact"], products))
    assert ("p2", "Lamp", 2) in got and ("p2", "Torch", 1) in got


def test_lowest_online_cities(star):
    assert rows(marketing.lowest_online_cities(star["fact"], star["customers"])) == [
        ("Giza", 0.315),
        ("Cairo", 22.95),
        (None, 30.15),
    ]


def test_most_redeemed_offers(star):
    expected = Counter(row[7] for row in LINES)
    assert rows(marketing.most_redeemed_offers(star["fact"])) == sorted(
        expected.items(), key=lambda pair: (-pair[1], pair[0])
    )


def test_top_offers_per_product(star):
    assert rows(marketing.top_offers_per_product(star["fact"], star["products"])) == [
        ("p3", "Lamp", 10.0, 2),
        ("p1", "Kettle", 25.0, 1),
        ("p2", "Lamp", 5.0, 1),
    ]


def test_customers_of_one_name_share_a_transaction(star):
    # t1 belongs to both Ann Lees and counts once; a missing last name gives no name.
    assert rows(batch_report.customer_purchase_behavior(star["fact"], star["customers"])) == [
        ("Ann Lee", 4, 71.69),
        (None, 2, 2.52),
    ]


def test_sales_by_category(star):
    assert rows(batch_report.sales_by_category(star["fact"], star["products"])) == [
        ("Kitchen", 16, 72.87),
        ("Light", 1, 2.85),
    ]


def test_products_by_revenue(star):
    assert rows(batch_report.products_by_revenue(star["fact"], star["products"])) == [
        ("Lamp", 9, 5.37),
        ("Kettle", 8, 70.35),
    ]


def test_units_by_product_name(star):
    sales = star["fact"].join(star["products"], "product_id")
    assert rows(batch_report.units_by_product_name(sales)) == [("Lamp", 9), ("Kettle", 8)]


def test_daily_dump_groups_by_name_and_puts_missing_sums_last(spark, star):
    fact = star["fact"].union(
        spark.createDataFrame([line("t8", "c1", "a2", "p2", None, 3.0, 0, True)], FACT_SCHEMA)
    )
    dump = b2b.daily_sales_dump(fact, star["agents"], star["products"], date(2022, 1, 16))
    assert rows(dump) == [
        ("Zoe", "Lamp", 8),
        ("Yan", "Kettle", 4),
        ("Zoe", "Kettle", 4),
        ("Yan", "Lamp", None),
    ]


def test_report_date():
    assert b2b.report_date(date(2024, 7, 9)) == date(2022, 1, 16)
    assert b2b.report_date(date(2024, 7, 9), days_back=1) == date(2024, 7, 8)


@pytest.fixture(scope="module")
def app(spark):
    data = [
        ("purchase", "u1", None, 10.1, "PayPal", date(2024, 1, 1), 5),
        ("purchase", "u1", None, 0.2, "Credit Card", date(2024, 1, 2), 5),
        ("purchase", "u2", None, 50.0, "PayPal", date(2024, 1, 3), 23),
        ("addToCart", "u2", None, None, None, date(2024, 1, 1), 0),
        ("productView", "u3", "Books", None, None, date(2024, 1, 1), 0),
    ]
    return spark.createDataFrame(
        data,
        "eventType string, customerId string, category string, totalAmount double,"
        " paymentMethod string, event_date date, event_hour int",
    )


def test_event_queries(app):
    assert rows(app_events.sales_by_payment_method(app)) == [("PayPal", 60.1), ("Credit Card", 0.2)]
    assert rows(app_events.popular_categories(app)) == [(None, 4), ("Books", 1)]
    assert rows(app_events.revenue_by_customer(app)) == [("u2", 50.0), ("u1", 10.3)]
    assert rows(app_events.hourly_sales(app)) == [(5, 10.3), (23, 50.0)]


def test_event_queries_take_a_date_range(app):
    start, end = date(2024, 1, 2), date(2024, 1, 3)
    assert rows(app_events.revenue_by_customer(app, start, end)) == [("u1", 0.2)]
    assert rows(app_events.popular_categories(app, end=start)) == [(None, 2), ("Books", 1)]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def conf(spark):
    """Settings for one test."""
    before = {}

    def change(**settings):
        for name, value in settings.items():
            key = "spark.sql." + name.replace("__", ".")
            before[key] = spark.conf.get(key, None)
            spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def big_fact(spark, n=60_000):
    """Lines of which one customer and one product hold a third."""
    hot = F.col("id") % 3 == 0
    return spark.range(n).select(
        F.concat(F.lit("t"), F.col("id") % 20_000).alias("transaction_id"),
        F.when(hot, "c1").otherwise(F.concat(F.lit("c"), F.col("id") % 2_000)).alias("customer_id"),
        F.when(hot, "p1").otherwise(F.concat(F.lit("p"), F.col("id") % 500)).alias("product_id"),
        (F.col("id") % 7).cast("int").alias("units"),
        ((F.col("id") % 997) / 4).alias("total_paid_price"),
    )


def test_a_hot_customer_is_split_where_it_is_joined(spark, conf):
    conf(
        autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="1KB",
        adaptive__skewJoin__skewedPartitionFactor="2.0",
        adaptive__advisoryPartitionSizeInBytes="16KB",
        adaptive__coalescePartitions__enabled="false",
    )
    customers = spark.range(2_000).select(
        F.concat(F.lit("c"), "id").alias("customer_id"),
        F.lit("N").alias("first_name"),
        (F.col("id") % 100).cast("string").alias("last_name"),
    )
    fact = big_fact(spark).repartition(8)
    report = batch_report.customer_purchase_behavior(fact, customers)
    got = {row[0]: tuple(row[1:]) for row in report.collect()}
    assert "skew=true" in plan_of(report)

    transactions, spent = defaultdict(set), defaultdict(float)
    for row in big_fact(spark).collect():
        name = f"N {int(row.customer_id[1:]) % 100}"
        transactions[name].add(row.transaction_id)
        spent[name] += row.total_paid_price
    assert got == {name: (len(transactions[name]), spent[name]) for name in spent}


def test_product_sums_meet_the_join_as_one_row_per_product(spark, conf):
    conf(autoBroadcastJoinThreshold="-1")
    products = spark.range(500).select(
        F.concat(F.lit("p"), "id").alias("product_id"),
        F.lit("x").alias("product_name"),
        F.lit("y").alias("product_category"),
    )
    df = marketing.most_selling_products(big_fact(spark), products)
    plan = plan_of(df)
    # One partial sum above the join, one below it.
    assert plan.rindex("partial_sum(units") > plan.index("SortMergeJoin")
    # The sum, the dimension and the final sort shuffle; the join and the second sum do not.
    assert plan.count("Exchange") == 3

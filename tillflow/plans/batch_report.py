"""Figures shown at the end of a batch load."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.functions.money import partial_sums, to_cents, total_of_sums


def customer_purchase_behavior(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Transactions and money per customer name, biggest spender first.

    Customers of one name form one group, so a transaction they share counts once:
    lines are summed per customer and transaction, not per customer. A customer
    with a large part of all transactions is split by the skew join of the
    adaptive planner.
    """
    return (
        fact.groupBy("customer_id", "transaction_id")
        .agg(*partial_sums(F.col("total_paid_price")))
        .join(customers.select("customer_id", "first_name", "last_name"), "customer_id")
        .groupBy("first_name", "last_name")
        .agg(
            F.countDistinct("transaction_id").alias("total_transactions"),
            total_of_sums(to_cents).alias("total_spent"),
        )
        .select(
            F.concat("first_name", F.lit(" "), "last_name").alias("Customer_Name"),
            "total_transactions",
            "total_spent",
        )
        .orderBy(F.desc("total_spent"), "Customer_Name", "total_transactions")
    )


def _units_and_revenue(fact: DataFrame, products: DataFrame, name: str) -> DataFrame:
    return (
        fact.groupBy("product_id")
        .agg(
            F.sum("units").alias("units"),
            *partial_sums(F.col("total_paid_price")),
        )
        .join(products.select("product_id", name), "product_id")
        .groupBy(name)
        .agg(
            F.sum("units").alias("total_units_sold"),
            total_of_sums(to_cents).alias("total_revenue"),
        )
    )


def sales_by_category(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Units and revenue per product category, highest revenue first."""
    return _units_and_revenue(fact, products, "product_category").orderBy(
        F.desc("total_revenue"), "product_category"
    )


def products_by_revenue(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Units and revenue per product name, most units first."""
    return _units_and_revenue(fact, products, "product_name").orderBy(
        F.desc("total_units_sold"), "product_name"
    )


def units_by_product_name(sales: DataFrame) -> DataFrame:
    """Units per product name straight from priced sales lines, most first."""
    return (
        sales.groupBy("product_name")
        .agg(F.sum("units").alias("total_units_sold"))
        .orderBy(F.desc("total_units_sold"), "product_name")
    )

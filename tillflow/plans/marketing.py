"""Questions of the marketing team."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.functions.money import partial_sums, total_of_sums


def most_selling_products(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Units sold per product, best first."""
    return (
        fact.groupBy("product_id")
        .agg(F.sum("units").alias("units"))
        .join(products, "product_id")
        .groupBy("product_id", "product_name")
        .agg(F.sum("units").alias("total_units_sold"))
        .orderBy(F.desc("total_units_sold"), "product_id", "product_name")
    )


def lowest_online_cities(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Online sales per city, weakest first; customers without a city form a group."""
    return (
        fact.where("is_online")
        .groupBy("customer_id")
        .agg(*partial_sums(F.col("total_paid_price")))
        .join(customers, "customer_id")
        .groupBy("city")
        .agg(total_of_sums().alias("total_online_sales"))
        .orderBy("total_online_sales", "city")
    )


def most_redeemed_offers(fact: DataFrame) -> DataFrame:
    """Sales lines per discount, most first; 0 stands for no offer."""
    return (
        fact.groupBy("discount_percentage")
        .agg(F.count("*").alias("number_of_sales"))
        .orderBy(F.desc("number_of_sales"), "discount_percentage")
    )


def top_offers_per_product(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Sales lines per product and offer, most first."""
    return (
        fact.where(F.col("discount_percentage") != 0)
        .groupBy("product_id", "discount_percentage")
        .agg(F.count("*").alias("lines"))
        .join(products, "product_id")
        .groupBy("product_id", "product_name", "discount_percentage")
        .agg(F.sum("lines").alias("purchase_count"))
        .orderBy(F.desc("purchase_count"), "product_id", "product_name", "discount_percentage")
    )

"""Daily report of the B2B team."""

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow import fixed_values as V
from tillflow import schemas as S


def report_date(today: date, days_back: int = V.REPORT_DAYS_BACK) -> date:
    """Day a report run on `today` looks at."""
    return today - timedelta(days=days_back)


def daily_report_order():
    """Most units first, missing sums last."""
    return (
        F.desc_nulls_last("total_sold_units"),
        F.asc("sales_agent_name"),
        F.asc("product_name"),
    )


def daily_sales_dump(
    fact: DataFrame, agents: DataFrame, products: DataFrame, day: date
) -> DataFrame:
    """Units per agent name and product name on one day, most first.

    The day is compared with the partition column itself, so only its folder is read.
    """
    return (
        fact.where(F.col(S.FACT_PARTITION) == day.isoformat())
        .groupBy("sales_agent_id", "product_id")
        .agg(F.sum("units").alias("units"))
        .join(agents, F.col("sales_agent_id") == F.col("sales_person_id"))
        .join(products, "product_id")
        .groupBy(F.col("name").alias("sales_agent_name"), "product_name")
        .agg(F.sum("units").alias("total_sold_units"))
        .orderBy(*daily_report_order())
    )

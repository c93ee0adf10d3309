"""Questions about app events.

All take an optional date range [start, end); it prunes the date partitions of
the event table.
"""

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow import fixed_values as V
from tillflow.functions.money import amount_sum


def _between(events: DataFrame, start: date | None, end: date | None) -> DataFrame:
    if start is not None:
        events = events.where(F.col("event_date") >= F.lit(start))
    if end is not None:
        events = events.where(F.col("event_date") < F.lit(end))
    return events


def _purchase_sums(events: DataFrame, key: str, total: str, start, end) -> DataFrame:
    return (
        _between(events, start, end)
        .where(F.col("eventType") == V.PURCHASE_EVENT)
        .groupBy(key)
        .agg(amount_sum(F.col("totalAmount")).alias(total))
    )


def sales_by_payment_method(events: DataFrame, start=None, end=None) -> DataFrame:
    """Purchase amount per payment method, highest first."""
    sums = _purchase_sums(events, "paymentMethod", "total_sales", start, end)
    return sums.orderBy(F.desc("total_sales"), "paymentMethod")


def popular_categories(events: DataFrame, start=None, end=None) -> DataFrame:
    """Events per category, most first; events without a category form a group."""
    return (
        _between(events, start, end)
        .groupBy("category")
        .agg(F.count("*").alias("total_events"))
        .orderBy(F.desc("total_events"), "category")
    )


def revenue_by_customer(events: DataFrame, start=None, end=None) -> DataFrame:
    """Purchase amount per customer, highest first."""
    sums = _purchase_sums(events, "customerId", "total_revenue", start, end)
    return sums.orderBy(F.desc("total_revenue"), "customerId")


def hourly_sales(events: DataFrame, start=None, end=None) -> DataFrame:
    """Purchase amount per hour of the day, over all dates."""
    return _purchase_sums(events, "event_hour", "total_sales", start, end).orderBy("event_hour")

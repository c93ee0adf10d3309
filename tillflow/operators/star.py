"""Fact and dimension frames of the star schema."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow import fixed_values as V
from tillflow import schemas as S
from tillflow.functions.flags import discount_percentage, yes_no_flag
from tillflow.functions.money import total_paid_price
from tillflow.functions.text import finite_double


def with_paid_price(sales: DataFrame) -> DataFrame:
    """Clean sales lines with typed units and price, discount and paid price."""
    return (
        sales.withColumns(
            {
                "units": F.col("units").try_cast("int"),
                "unit_price": finite_double(F.col("unit_price")),
                "discount_percentage": discount_percentage(
                    {name: F.col(name) for name in V.OFFER_DISCOUNTS}
                ),
            }
        )
    ).withColumn(
        "total_paid_price",
        total_paid_price(F.col("units"), F.col("unit_price"), F.col("discount_percentage")),
    )


def fact_projection(sales: DataFrame, *further: str) -> DataFrame:
    """Clean sales lines as rows of the fact table; `transaction_date` is `yyyy-MM-dd` or null.

    further: columns to keep besides.
    """
    priced = with_paid_price(sales).withColumns(
        {
            "is_online": yes_no_flag(F.col("is_online")),
            S.FACT_PARTITION: F.col(S.FACT_PARTITION).try_cast("date").cast("string"),
        }
    )
    return priced.select(
        [F.col(name).cast(type_name).alias(name) for name, type_name in S.FACT_COLUMNS.items()]
        + [F.col(S.FACT_PARTITION), *further]
    )


def fact_of_lines(lines: DataFrame) -> DataFrame:
    """Rows of the fact table from clean lines with copies, each line once; a date lies in few tasks.

    Only the fact's columns are shuffled, with a digest of the whole line that tells lines apart. They
    are dealt out in ranges of date and sale, for which the lines are read once more: small dates share
    a task, a hot one is in as many as its size asks for.
    """
    # Nulls are left out of the text, so they differ from empty texts.
    digest = F.unhex(F.md5(F.to_json(F.struct("*")))).alias("line")
    dealt = fact_projection(lines.select("*", digest), "line").repartitionByRange(
        S.FACT_PARTITION, "transaction_id", "line"
    )
    return dealt.dropDuplicates().drop("line")


def one_row_per_key(df: DataFrame, key: str, fields, order=()) -> DataFrame:
    """First row per non-null key by `order`, then by the fields themselves; nulls come last.

    All fields come from the same row. The minimum of a struct is combined before
    the shuffle, so a key with a third of all rows sends one row per task.
    """
    columns = [
        column
        for name in (*order, *fields)
        for column in (F.col(name).isNull().alias(f"no_{name}"), F.col(name))
    ]
    ranked = F.struct(*columns)
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.min(ranked).alias("first_row"))
        .select(key, *[F.col("first_row")[name].alias(name) for name in fields])
    )


def without_key(df: DataFrame, key: str) -> DataFrame:
    """Rows that cannot enter a dimension because their key is missing."""
    return df.where(F.col(key).isNull())


# Sales with a readable date first; ids that are numbers in the order of numbers.
_SALE_ORDER = ("sale_day", "sale_number", "transaction_id")


def _with_sale_day(sales: DataFrame) -> DataFrame:
    return sales.withColumns(
        {
            "sale_day": F.col("transaction_date").try_cast("date"),
            "sale_number": F.col("transaction_id").try_cast("bigint"),
        }
    )


def customer_dim(sales: DataFrame) -> DataFrame:
    """One row per customer, taken from the first sale."""
    key, *fields = S.DIMENSION_COLUMNS[V.CUSTOMER_TABLE]
    named = _with_sale_day(sales).withColumnsRenamed(
        {
            "customer_fname": "first_name",
            "customer_lname": "last_name",
            "customer_email": "email",
        }
    )
    return one_row_per_key(named, key, fields, _SALE_ORDER)


def product_dim(sales: DataFrame) -> DataFrame:
    """One row per product, taken from the first sale."""
    key, *fields = S.DIMENSION_COLUMNS[V.PRODUCT_TABLE]
    return one_row_per_key(_with_sale_day(sales), key, fields, _SALE_ORDER)


def sales_agent_dim(agents: DataFrame) -> DataFrame:
    """One row per sales agent."""
    key, *fields = S.DIMENSION_COLUMNS[V.AGENT_TABLE]
    return one_row_per_key(agents, key, fields)


def branch_dim(branches: DataFrame) -> DataFrame:
    """One row per branch."""
    key, *fields = S.DIMENSION_COLUMNS[V.BRANCH_TABLE]
    return one_row_per_key(branches, key, fields)


def new_rows(dimension: DataFrame, existing: DataFrame, key: str, few: bool = False) -> DataFrame:
    """Dimension rows whose key is not in the table yet; rows once inserted never change.

    few: the rows are known to be so few that their keys can be broadcast. Then the table is not
    shuffled: a scan of its key column leaves those keys of the dimension that it knows, each once.
    """
    known = existing.select(key)
    if few:
        given = F.broadcast(dimension.select(key))
        known = F.broadcast(known.join(given, key, "left_semi").distinct())
    return dimension.join(known, key, "left_anti")

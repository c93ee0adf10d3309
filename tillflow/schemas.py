"""Schemas of raw files, warehouse tables and app events.

Names and types of the tables and of the events are fixed values: producers and
stored tables use them already.
"""

from pyspark.sql import types as T

from tillflow import fixed_values as V

RAW_COLUMNS = {
    V.SALES_KIND: V.SALES_COLUMNS,
    V.AGENTS_KIND: V.AGENT_COLUMNS,
    V.BRANCHES_KIND: V.BRANCH_COLUMNS,
}


def raw_schema(columns) -> T.StructType:
    """All-string schema: raw text is parsed by the cleaning step, never inferred per file."""
    return T.StructType([T.StructField(name, T.StringType()) for name in columns])


# How the text of a raw column is to be understood; columns not named are plain text.
SALES_TEXT_TYPES = {
    "transaction_id": "bigint",
    "transaction_date": "date",
    "customer_id": "bigint",
    "sales_agent_id": "bigint",
    "branch_id": "bigint",
    "product_id": "bigint",
    "units": "int",
    "unit_price": "double",
}
AGENT_TEXT_TYPES = {"sales_person_id": "bigint"}
BRANCH_TEXT_TYPES = {"branch_id": "bigint"}

FACT_COLUMNS = {
    "transaction_id": "string",
    "customer_id": "string",
    "sales_agent_id": "string",
    "branch_id": "string",
    "product_id": "string",
    "units": "int",
    "unit_price": "double",
    "discount_percentage": "double",
    "total_paid_price": "double",
    "is_online": "boolean",
}
FACT_PARTITION = "transaction_date"

DIMENSION_COLUMNS = {
    V.CUSTOMER_TABLE: ("customer_id", "first_name", "last_name", "email") + V.ADDRESS_PARTS,
    V.PRODUCT_TABLE: ("product_id", "product_name", "product_category"),
    V.AGENT_TABLE: V.AGENT_COLUMNS,
    V.BRANCH_TABLE: V.BRANCH_COLUMNS,
}

EVENT_JSON = T.StructType(
    [
        T.StructField("eventType", T.StringType()),
        T.StructField("customerId", T.StringType()),
        T.StructField("productId", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField(
            "metadata",
            T.StructType(
                [
                    T.StructField("category", T.StringType()),
                    T.StructField("source", T.StringType()),
                ]
            ),
        ),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("totalAmount", T.DoubleType()),
        T.StructField("paymentMethod", T.StringType()),
        T.StructField("recommendedProductId", T.StringType()),
        T.StructField("algorithm", T.StringType()),
    ]
)

EVENT_COLUMNS = {
    "eventType": "string",
    "customerId": "string",
    "productId": "string",
    "timestamp": "timestamp",
    "category": "string",
    "source": "string",
    "quantity": "int",
    "totalAmount": "double",
    "paymentMethod": "string",
    "recommendedProductId": "string",
    "algorithm": "string",
}
EVENT_PARTITIONS = {"event_date": "date", "event_hour": "int"}
# Which micro-batch a landed row came from; makes a replayed batch recognisable.
EVENT_EPOCH = "landed_epoch"

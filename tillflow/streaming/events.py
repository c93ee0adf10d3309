"""App events: from records with a JSON `value` to flat, typed rows."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow import schemas as S

REJECT_REASON = "reject_reason"
# A file source drops files a week older than the newest one it saw, unless told otherwise.
ANY_AGE = "36500d"
RAW_VALUE = "raw_value"
_UNREADABLE = "_unreadable"


def event_source(spark: SparkSession, source_format: str, options: dict, path=None) -> DataFrame:
    """Stream of records with a `value` column.

    For `kafka` the options name servers, topic and security; reading starts at
    the earliest offset unless they say otherwise, so give `maxOffsetsPerTrigger`
    where the topic is long, or the first micro-batch is all of it. The `text` source
    reads one event per line from the files of a folder, of any age.
    """
    reader = spark.readStream.format(source_format)
    if source_format == "kafka":
        reader = reader.option("startingOffsets", "earliest")
    else:
        reader = reader.option("maxFileAge", ANY_AGE)
    return reader.options(**options).load(path)


def parse_events(records: DataFrame) -> DataFrame:
    """Decoded and flattened events of a batch or a stream, one row per record.

    Adds `event_date` and `event_hour` of the event's own time. Nothing raises and
    nothing is dropped: a record that is no JSON object of the event schema, has no
    readable time or no finite amount carries a `reject_reason`, others null there.
    """
    schema = T.StructType([*S.EVENT_JSON.fields, T.StructField(_UNREADABLE, T.StringType())])
    options = {
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": _UNREADABLE,
        "allowNonNumericNumbers": "false",
    }
    value = F.col("value").cast("string")
    # As a generated row, so that filters on several fields decode a record once, not
    # once per field.
    decoded = records.select(
        value.alias(RAW_VALUE), F.inline(F.array(F.from_json(value, schema, options)))
    )
    flat = decoded.select(
        RAW_VALUE,
        _UNREADABLE,
        "eventType",
        "customerId",
        "productId",
        F.col("timestamp").alias("time_text"),
        F.try_to_timestamp("timestamp").alias("timestamp"),
        "metadata.category",
        "metadata.source",
        "quantity",
        "totalAmount",
        "paymentMethod",
        "recommendedProductId",
        "algorithm",
    )
    # A time of day alone would be read as today, hence the second look at the text.
    has_time = F.col("timestamp").isNotNull() & F.col("time_text").try_cast("date").isNotNull()
    has_amount = F.col("totalAmount").isNull() | (F.abs("totalAmount") < F.lit(float("inf")))
    return flat.select(
        *S.EVENT_COLUMNS,
        F.to_date("timestamp").alias("event_date"),
        F.hour("timestamp").alias("event_hour"),
        F.when(F.col(RAW_VALUE).isNull() | F.col(_UNREADABLE).isNotNull(), "unreadable")
        .when(~has_time, "no event time")
        .when(~has_amount, "no finite amount")
        .alias(REJECT_REASON),
        RAW_VALUE,
    )


def good_events(parsed: DataFrame) -> DataFrame:
    """Events fit for the event table."""
    return parsed.where(F.col(REJECT_REASON).isNull()).select(*S.EVENT_COLUMNS, *S.EVENT_PARTITIONS)


def quarantine_events(parsed: DataFrame) -> DataFrame:
    """Records set aside, as they came, with the reason."""
    return parsed.where(F.col(REJECT_REASON).isNotNull()).select(RAW_VALUE, REJECT_REASON)

"""Session settings the library counts on."""

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# All but the time zone are Spark's defaults; plans rely on them.
SETTINGS = {
    # Event times carry no zone.
    "spark.sql.session.timeZone": "UTC",
    # Bad text becomes null by try_* functions, everything else raises.
    "spark.sql.ansi.enabled": "true",
    # Splits skewed joins and rebalanced writes, merges small shuffle partitions,
    # and turns a join into a broadcast once a side is known to be small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}
SHUFFLE_BYTES = 128 * 1024 * 1024
# Sales lines take some ten times their shuffled bytes as rows of text in sorts and hash tables,
# and all shuffles of a plan some four times the bytes of the tables they come from.
TASK_BYTES = 16 * 1024 * 1024
_SHUFFLED_PER_INPUT = 4
_ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_SPLIT = "spark.sql.files.maxPartitionBytes"


def partitions_for(input_bytes: int, least: int = 200) -> int:
    """Shuffle partitions to start from: the adaptive planner merges them, but adds none."""
    return max(least, -(-input_bytes // SHUFFLE_BYTES))


def build_session(
    name: str, settings: dict[str, str] | None = None, input_bytes: int | None = None
) -> SparkSession:
    """Session with the library's settings; `settings` adds to them or overrides them.

    `input_bytes`, the size of what the session's jobs read, sets the number of shuffle
    partitions to start from, unless `settings` name it.
    """
    merged = {**SETTINGS, **(settings or {})}
    if input_bytes is not None:
        merged.setdefault("spark.sql.shuffle.partitions", str(partitions_for(input_bytes)))
    builder = SparkSession.builder.appName(name)
    for key, value in merged.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def size_tasks(spark: SparkSession, input_bytes: int) -> None:
    """Let the tasks of the session's next plans take `TASK_BYTES` of shuffled rows each, or less.

    The shuffle partitions to start from grow with the input and are merged up to that size at run
    time, so that the memory of one task does not grow with the input.
    """
    before = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        spark.conf.get(_ADVISORY, None) or "64m"
    )
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = -(-input_bytes * _SHUFFLED_PER_INPUT // TASK_BYTES)
    spark.conf.set(_ADVISORY, str(min(before, TASK_BYTES)))
    spark.conf.set(_INITIAL, str(max(least, wanted)))


@contextmanager
def small_splits(spark: SparkSession) -> Iterator[None]:
    """Let the tasks of plans that run inside read `TASK_BYTES` of packed files each, or less.

    For rows of text that a shuffle holds in memory: they take some ten times that.
    """
    java = spark._jvm.org.apache.spark.network.util.JavaUtils
    before = spark.conf.get(_SPLIT)
    spark.conf.set(_SPLIT, str(min(java.byteStringAsBytes(before), TASK_BYTES)))
    try:
        yield
    finally:
        spark.conf.set(_SPLIT, before)

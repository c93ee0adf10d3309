"""Query names, wired to library functions on the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import entry_oracle
from tillflow import fixed_values as V
from tillflow import jobs
from tillflow import schemas as S
from tillflow.functions.flags import discount_percentage, offer_flag, yes_no_flag
from tillflow.functions.text import clean_email, split_address, trim_all
from tillflow.operators import cleaning, maintenance, star
from tillflow.plans import app_events, b2b, batch_report, marketing
from tillflow.session import size_tasks
from tillflow.sources import drops, reports, tables, tpch
from tillflow.sources.workspace import fresh_folder, stored
from tillflow.streaming import event_table, events, landing, raw_files

try:
    import corpus_pipeline
    from tillflow.llm import queries as llm
except ModuleNotFoundError as missing:
    # The part on text, or a package that it alone needs, may be missing; ours may not.
    if missing.name.startswith("tillflow") and missing.name != "tillflow.llm":
        raise
    corpus_pipeline = llm = None

REPORT_DAY = date(1997, 2, 1)
# Borders between a first and a second batch; about half the keys are new in the second.
CUSTOMER_SPLIT = "1995-06-01"
PRODUCT_SPLIT = "1995-02-15"
_DROP_HOUR = datetime(2022, 1, 16, 5)
COMPACTION_TIME = datetime(2024, 1, 15, 13)


def _clean(spark, folder):
    return cleaning.clean_sales(tpch.raw_sales(spark, folder))


def _lines(spark, folder):
    """Clean lines with their copies, which change no dimension."""
    return cleaning.with_address_parts(cleaning.clean_lines(tpch.raw_sales(spark, folder)))


def _fact(spark, folder):
    return star.fact_projection(_clean(spark, folder))


# Cleaning -----------------------------------------------------------------


# Files of a drop are packed; readers unpack them by their names.
_DROP_OPTIONS = {
    "header": True,
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "compression": "gzip",
}


def _write_drop(raw: DataFrame, folder: str, kind: str, number: int = 1) -> None:
    raw.write.options(**_DROP_OPTIONS).csv(f"{folder}/{kind}_{number}.csv")


def _write_sales_drops(spark, folder, base):
    """Raw sales as drops of two groups, in one pass: `group=1/<kind>_file=1.csv` and `group=2/...`.

    Each group drops a file with a header alone besides, so that one without sales has a file, too.
    """
    raw = tpch.raw_sales(spark, folder)
    for group in (1, 2):
        _write_drop(spark.createDataFrame([], raw.schema), f"{base}/group={group}", V.SALES_KIND, 0)
    group = F.when(F.col("is_online") == V.ONLINE_WORD, 1).otherwise(2)
    grouped = raw.withColumns({"group": group, f"{V.SALES_KIND}_file": F.lit("1.csv")})
    writer = grouped.write.mode("append").options(**_DROP_OPTIONS)
    writer.partitionBy("group", f"{V.SALES_KIND}_file").csv(base)


def csv_sales_scan(spark, folder):
    hour = drops.hour_folder(fresh_folder(spark, "drops"), _DROP_HOUR)
    _write_sales_drops(spark, folder, hour)
    return drops.scan_drop(spark, hour, V.SALES_KIND)


def csv_sales_scan_mixed_headers(spark, folder):
    """A group whose files hold the columns in another order, among others."""
    hour = drops.hour_folder(fresh_folder(spark, "drops"), _DROP_HOUR)
    raw = tpch.raw_sales(spark, folder)
    online = F.col("is_online") == V.ONLINE_WORD
    others = raw.where(~online).select(F.lit("none").alias("phone"), *reversed(raw.columns))
    _write_drop(raw.where(online), f"{hour}/group1", V.SALES_KIND, 1)
    _write_drop(others, f"{hour}/group1", V.SALES_KIND, 2)
    return drops.scan_drop(spark, hour, V.SALES_KIND)


def union_batches(spark, folder):
    raw = tpch.raw_sales(spark, folder)
    return cleaning.union_batches(raw, raw).select(
        "transaction_id", "product_id", "sales_agent_id", "units"
    )


def dedup_rows(spark, folder):
    raw = tpch.raw_sales(spark, folder)
    return cleaning.clean_sales(cleaning.union_batches(raw, raw))


def trimmed(spark, folder):
    return trim_all(tpch.raw_sales(spark, folder))


def cleaned_email(spark, folder):
    email = clean_email(F.col("cusomter_email")).alias("customer_email")
    return tpch.raw_sales(spark, folder).select("transaction_id", "customer_id", email)


def address_parts(spark, folder):
    parts = split_address(F.col("shipping_address"))
    return tpch.raw_sales(spark, folder).select(
        "transaction_id", "product_id", *[part.alias(name) for name, part in parts.items()]
    )


def online_flag(spark, folder):
    return tpch.raw_sales(spark, folder).select(
        "transaction_id", "product_id", yes_no_flag(F.col("is_online")).alias("is_online")
    )


def discounts(spark, folder):
    offers = {name: offer_flag(F.col(name)) for name in V.OFFER_DISCOUNTS}
    return tpch.raw_sales(spark, folder).select(
        "transaction_id", "product_id", discount_percentage(offers).alias("discount_percentage")
    )


def paid_prices(spark, folder):
    return star.with_paid_price(_clean(spark, folder)).select(
        "transaction_id",
        "product_id",
        "units",
        "unit_price",
        "discount_percentage",
        "total_paid_price",
    )


# Star schema and loading ----------------------------------------------------


def dim_sales_agent(spark, folder):
    return star.sales_agent_dim(cleaning.clean_agents(tpch.raw_agents(spark, folder)))


def dim_branch(spark, folder):
    return star.branch_dim(cleaning.clean_branches(tpch.raw_branches(spark, folder)))


def _fresh_database(spark):
    location = fresh_folder(spark, "warehouse")
    database = "retail_" + location.rsplit("-", 1)[1]
    tables.create_database(spark, database, location)
    return database


def fact_load(spark, folder):
    table = tables.create_fact_table(spark, _fresh_database(spark))
    tables.append_fact(_fact(spark, folder), table)
    return spark.table(table)


def fact_load_rerun(spark, folder):
    """Load an hour of which an earlier run got a day that the rerun has not; it replaces all."""
    table = tables.create_fact_table(spark, _fresh_database(spark), by_load_hour=True)
    # Both runs read one stored fact, so its joins and its shuffle are not made twice.
    with stored(_fact(spark, folder), "fact") as fact:
        one_day = fact.where(F.col(S.FACT_PARTITION) == REPORT_DAY.isoformat())
        stray = one_day.withColumn(S.FACT_PARTITION, F.lit("2030-01-01"))
        tables.replace_fact_hour(one_day.union(stray), table, "2022-01-16-05")
        tables.replace_fact_hour(fact, table, "2022-01-16-05")
    return spark.table(table).drop(tables.LOAD_HOUR)


def _incremental(spark, name, first, second):
    table = tables.create_dimension_table(spark, _fresh_database(spark), name)
    tables.append_dimension(first, table)
    tables.append_dimension(second, table)
    return spark.table(table)


def dim_customer_incremental(spark, folder):
    sales = _lines(spark, folder)
    day = F.col("transaction_date")
    return _incremental(
        spark,
        V.CUSTOMER_TABLE,
        star.customer_dim(sales.where(day < CUSTOMER_SPLIT)),
        star.customer_dim(sales.where(day >= CUSTOMER_SPLIT)),
    )


def dim_product_incremental(spark, folder):
    sales = _lines(spark, folder)
    day = F.col("transaction_date")
    return _incremental(
        spark,
        V.PRODUCT_TABLE,
        star.product_dim(sales.where(day < PRODUCT_SPLIT)),
        star.product_dim(sales.where(day >= PRODUCT_SPLIT)),
    )


def dim_agent_incremental(spark, folder):
    """Agents known already keep their name when a later drop spells it differently."""
    suppliers = tpch.table(spark, folder, "supplier")
    known = suppliers.where("s_acctbal < 5000").select(
        F.col("s_suppkey").cast("string").alias("sales_person_id"), F.col("s_name").alias("name")
    )
    later = dim_sales_agent(spark, folder).withColumn("name", F.upper("name"))
    return _incremental(spark, V.AGENT_TABLE, star.sales_agent_dim(known), later)


def dim_branch_incremental(spark, folder):
    """Branches known already keep their place when a later drop spells it differently."""
    branches = dim_branch(spark, folder)
    later = branches.withColumn("location", F.lower("location"))
    return _incremental(spark, V.BRANCH_TABLE, branches.where("int(class) < 2"), later)


def sample(spark, folder):
    return tables.table_sample(
        _fact(spark, folder),
        20,
        "transaction_id",
        "product_id",
        "sales_agent_id",
        "units",
        "discount_percentage",
        "is_online",
    )


# Business queries -----------------------------------------------------------


def most_selling_products(spark, folder):
    return marketing.most_selling_products(
        tpch.sales_fact(spark, folder, "product_id", "units"), tpch.stored_products(spark, folder)
    )


def lowest_online_cities(spark, folder):
    fact = tpch.sales_fact(spark, folder, "customer_id", "is_online", "total_paid_price")
    return marketing.lowest_online_cities(fact, tpch.stored_customers(spark, folder))


def most_redeemed_offers(spark, folder):
    return marketing.most_redeemed_offers(tpch.sales_fact(spark, folder, "discount_percentage"))


def top_offers_per_product(spark, folder):
    fact = tpch.sales_fact(spark, folder, "product_id", "discount_percentage")
    return marketing.top_offers_per_product(fact, tpch.stored_products(spark, folder))


def daily_sales_dump(spark, folder):
    columns = ("sales_agent_id", "product_id", "units", S.FACT_PARTITION)
    return b2b.daily_sales_dump(
        tpch.sales_fact(spark, folder, *columns, day=REPORT_DAY),
        tpch.stored_agents(spark, folder),
        tpch.stored_products(spark, folder),
        REPORT_DAY,
    )


def daily_sales_csv(spark, folder):
    path = fresh_folder(spark, "report")
    reports.write_csv_report(daily_sales_dump(spark, folder), path, *b2b.daily_report_order())
    return (
        spark.read.schema("sales_agent_name string, product_name string, total_sold_units bigint")
        .option("header", True)
        .csv(path)
    )


def customer_purchase_behavior(spark, folder):
    fact = tpch.sales_fact(spark, folder, "customer_id", "transaction_id", "total_paid_price")
    return batch_report.customer_purchase_behavior(fact, tpch.stored_customers(spark, folder))


def _sales_with_products(query):
    def run(spark, folder):
        fact = tpch.sales_fact(spark, folder, "product_id", "units", "total_paid_price")
        return query(fact, tpch.stored_products(spark, folder))

    return run


def units_by_product_name(spark, folder):
    return batch_report.units_by_product_name(star.with_paid_price(_clean(spark, folder)))


def loaded_lowest_online_cities(spark, folder):
    """CSV drops loaded by the hourly job, then the question put to the tables it filled."""
    base, database = fresh_folder(spark, "drops"), _fresh_database(spark)
    hour = drops.hour_folder(base, _DROP_HOUR)
    _write_sales_drops(spark, folder, hour)
    _write_drop(tpch.raw_agents(spark, folder), f"{hour}/group1", V.AGENTS_KIND)
    _write_drop(tpch.raw_branches(spark, folder), f"{hour}/group1", V.BRANCHES_KIND)
    jobs.load_hour(spark, base, _DROP_HOUR, database)
    return marketing.lowest_online_cities(
        spark.table(f"{database}.{V.FACT_TABLE}"), spark.table(f"{database}.{V.CUSTOMER_TABLE}")
    )


# App events -------------------------------------------------------------------


def _parsed_events(spark, folder, junk=False):
    return events.parse_events(tpch.event_records(spark, folder, junk))


def parse_event_json(spark, folder):
    return events.good_events(_parsed_events(spark, folder))


def event_time_parts(spark, folder):
    return parse_event_json(spark, folder).select(
        "customerId", "timestamp", "event_date", "event_hour"
    )


def quarantine_events(spark, folder):
    return events.quarantine_events(_parsed_events(spark, folder, junk=True))


def _write_counted(parsed: DataFrame, path: str) -> None:
    """Each record once, with its hour, whether it is good, and how often it came."""
    counted = parsed.groupBy(
        *landing.PARTITIONS, F.col(events.REJECT_REASON).isNull().alias("good"), events.RAW_VALUE
    ).agg(F.count("*").alias("copies"))
    counted.write.parquet(path)


def _in_halves(counted: DataFrame) -> DataFrame:
    """Records as `value` with a `half`; both have some of each hour with two good events or more.

    No hour is sorted or numbered in one task, nor are the records without an hour: a hash deals
    them out, and the records of an hour with the least and the greatest hash go one to each half.
    """
    mark = F.xxhash64(events.RAW_VALUE)
    ends = (
        counted.where("good")
        .groupBy(landing.PARTITIONS)
        .agg(F.min(mark).alias("least"), F.max(mark).alias("greatest"))
    )
    copy = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    # One row of four numbers per hour, for the records of that hour.
    records = counted.join(F.broadcast(ends), landing.PARTITIONS, "left").withColumn("copy", copy)
    turn = F.when(mark == F.col("least"), 0).when(mark == F.col("greatest"), 1).otherwise(mark)
    half = F.pmod(F.pmod(turn, F.lit(2)) + F.col("copy"), F.lit(2))
    return records.select(F.col(events.RAW_VALUE).alias("value"), half.alias("half"))


def _landed_events(spark, folder):
    """Events, some of them junk, streamed in two runs from text files; folder of what landed.

    Each run has about half of the good events of every hour, so that an hour with two or more
    events is landed as two files.
    """
    base = fresh_folder(spark, "events")
    parsed = events.parse_events(tpch.event_records(spark, folder, junk=True))
    _write_counted(parsed, f"{base}/counted")
    halves = _in_halves(spark.read.parquet(f"{base}/counted"))
    for half in (1, 0):
        lines = halves.where(F.col("half") == half).select("value")
        lines.write.mode("append").text(f"{base}/incoming")
        source = events.event_source(spark, "text", {}, path=f"{base}/incoming")
        landing.land_events(
            source, f"{base}/table", f"{base}/rejects", f"{base}/checkpoint", availableNow=True
        ).awaitTermination()
    return base


def _with_files(spark, path):
    """Landed rows, each with the number of files its hour has."""
    files = maintenance.files_per_hour(spark, path).select(*landing.PARTITIONS, "files")
    return _landed_rows(landing.read_events(spark, path)).join(files, landing.PARTITIONS)


def _landed_rows(rows):
    return rows.drop(S.EVENT_EPOCH)


def stream_land_events(spark, folder):
    return _landed_rows(landing.read_events(spark, f"{_landed_events(spark, folder)}/table"))


def stream_land_rejects(spark, folder):
    """The records that landing sets aside."""
    return spark.read.parquet(f"{_landed_events(spark, folder)}/rejects").drop(S.EVENT_EPOCH)


def compact_partition(spark, folder):
    """Compact the hour before the given time, then read the whole table."""
    path = f"{_landed_events(spark, folder)}/table"
    day, hour = maintenance.closed_hour(COMPACTION_TIME)
    maintenance.compact_partition(spark, path, day, hour)
    return _with_files(spark, path)


def compact_range(spark, folder):
    path = f"{_landed_events(spark, folder)}/table"
    maintenance.compact_range(
        spark, path, date(2024, 1, 1), date(2025, 1, 1), closed_before=COMPACTION_TIME
    )
    return _with_files(spark, path)


def repair_partitions(spark, folder):
    table = f"{_fresh_database(spark)}.app_events"
    maintenance.create_event_table(spark, table, f"{_landed_events(spark, folder)}/table")
    return _landed_rows(maintenance.repair_partitions(spark, table))


def landed_popular_categories(spark, folder):
    """JSON records landed, their hours registered by name, then the question put to the table."""
    path = f"{_landed_events(spark, folder)}/table"
    table = f"{_fresh_database(spark)}.app_events"
    maintenance.create_event_table(spark, table, path)
    maintenance.register_hours(spark, table, landing.read_events(spark, path))
    return app_events.popular_categories(spark.table(table))


def late_events_in_table(spark, folder):
    """Events landed in a table, purchases 400 days late, then looked after; with files per hour.

    Two micro-batches bring the other events, so there is something to compact.
    """
    base = fresh_folder(spark, "events")
    table = f"{_fresh_database(spark)}.app_events"
    maintenance.create_event_table(spark, table, f"{base}/table")
    records = tpch.event_records(spark, folder)
    purchase = F.get_json_object("value", "$.eventType") == "purchase"
    long_ago = F.date_format(F.col("ts") - F.expr("INTERVAL 400 DAYS"), "yyyy-MM-dd'T'HH:mm:ss")
    late = F.regexp_replace(
        "value", F.lit('"timestamp":"[^"]*"'), F.concat(F.lit('"timestamp":"'), long_ago, F.lit('"'))
    )
    even = F.crc32(F.encode("value", "UTF-8")) % 2 == 0
    others = records.where(~purchase).select("value")
    for lines in (others.where(even), others.where(~even), records.where(purchase).select(late)):
        lines.toDF("value").write.mode("append").text(f"{base}/incoming")
        source = events.event_source(spark, "text", {}, path=f"{base}/incoming")
        event_table.land_events(
            source, table, f"{base}/rejects", f"{base}/checkpoint", availableNow=True
        ).awaitTermination()
    jobs.upkeep_event_table(spark, table, COMPACTION_TIME)
    rows = spark.table(table)
    files = rows.select(*landing.PARTITIONS, "_metadata.file_path").distinct()
    per_hour = files.groupBy(landing.PARTITIONS).agg(F.count("*").alias("files"))
    # An hour that is still open keeps what the batches left, of which there may be one or two.
    closed = F.to_timestamp("event_date") + F.make_interval(hours="event_hour") < COMPACTION_TIME
    per_hour = per_hour.withColumn("files", F.when(closed, F.col("files")))
    return _landed_rows(rows).join(per_hour, landing.PARTITIONS)


def incremental_landing(spark, folder):
    """Land the drops of two groups, some files at a time, then run again with nothing new."""
    base = fresh_folder(spark, "landing")
    _write_sales_drops(spark, folder, f"{base}/drops")
    for _ in range(2):
        raw_files.land_raw_files(
            spark,
            f"{base}/drops",
            V.SALES_KIND,
            f"{base}/zone",
            f"{base}/checkpoint",
            max_files=8,
            availableNow=True,
        ).awaitTermination()
    return raw_files.read_raw_zone(spark, f"{base}/zone", V.SALES_KIND).select(
        list(V.SALES_COLUMNS)
    )


def _on_events(query):
    return lambda spark, folder: query(tpch.stored_events(spark, folder))


_QUERIES = {
    "csv_sales_scan": csv_sales_scan,
    "csv_sales_scan_mixed_headers": csv_sales_scan_mixed_headers,
    "union_batches": union_batches,
    "dedup_rows": dedup_rows,
    "trim_all": trimmed,
    "clean_email": cleaned_email,
    "split_address": address_parts,
    "yes_no_flag": online_flag,
    "discount_rule": discounts,
    "total_paid_price": paid_prices,
    "fact_projection": _fact,
    "dim_customer": lambda spark, folder: star.customer_dim(_lines(spark, folder)),
    "dim_product": lambda spark, folder: star.product_dim(_lines(spark, folder)),
    "dim_sales_agent": dim_sales_agent,
    "dim_branch": dim_branch,
    "dim_customer_incremental": dim_customer_incremental,
    "dim_product_incremental": dim_product_incremental,
    "dim_agent_incremental": dim_agent_incremental,
    "dim_branch_incremental": dim_branch_incremental,
    "fact_load": fact_load,
    "fact_load_rerun": fact_load_rerun,
    "table_sample": sample,
    "most_selling_products": most_selling_products,
    "lowest_online_cities": lowest_online_cities,
    "loaded_lowest_online_cities": loaded_lowest_online_cities,
    "most_redeemed_offers": most_redeemed_offers,
    "top_offers_per_product": top_offers_per_product,
    "daily_sales_dump": daily_sales_dump,
    "daily_sales_csv": daily_sales_csv,
    "customer_purchase_behavior": customer_purchase_behavior,
    "sales_by_category": _sales_with_products(batch_report.sales_by_category),
    "products_by_revenue": _sales_with_products(batch_report.products_by_revenue),
    "units_by_product_name": units_by_product_name,
    "incremental_landing": incremental_landing,
    "parse_event_json": parse_event_json,
    "event_time_parts": event_time_parts,
    "quarantine_events": quarantine_events,
    "stream_land_events": stream_land_events,
    "stream_land_rejects": stream_land_rejects,
    "landed_popular_categories": landed_popular_categories,
    "compact_partition": compact_partition,
    "compact_range": compact_range,
    "repair_partitions": repair_partitions,
    "late_events_in_table": late_events_in_table,
    "sales_by_payment_method": _on_events(app_events.sales_by_payment_method),
    "popular_categories": _on_events(app_events.popular_categories),
    "revenue_by_customer": _on_events(app_events.revenue_by_customer),
    "hourly_sales": _on_events(app_events.hourly_sales),
}


_SQL = entry_oracle.build(
    REPORT_DAY.isoformat(), CUSTOMER_SPLIT, PRODUCT_SPLIT, COMPACTION_TIME
)

_SHOP = frozenset(_QUERIES)
if llm is not None:
    _QUERIES |= llm.QUERIES
    _QUERIES["pipeline"] = corpus_pipeline.run
    _SQL |= llm.ORACLE_SQL
    if corpus_pipeline.ORACLE_SQL:
        _SQL["pipeline"] = corpus_pipeline.ORACLE_SQL


_SETTINGS = {
    # Event times carry no zone; both sides of a comparison read them as UTC.
    "spark.sql.session.timeZone": "UTC",
}


def _configure(spark: SparkSession) -> None:
    for key, value in _SETTINGS.items():
        spark.conf.set(key, value)


def _configured(query, of_the_shop):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        _configure(spark)
        if of_the_shop:
            size_tasks(spark, tpch.input_bytes(spark, folder))
        return query(spark, folder)

    return run


def entry(spark: SparkSession) -> DataFrame:
    """Best-selling products of a cleaned batch, from raw text to the ranked list."""
    _configure(spark)
    sales = _clean(spark, "/root/testdata/sf0.001")
    return marketing.most_selling_products(star.fact_projection(sales), star.product_dim(sales))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One entry per operator or business query; each takes (spark, folder of the tables)."""
    return {name: _configured(query, name in _SHOP) for name, query in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    """The same result as each query, in SQL for DuckDB."""
    return dict(_SQL)

"""Cleaning, dimensions and the fact on hand-made drops."""

import pytest
from pyspark.sql import functions as F

from tillflow import fixed_values as V
from tillflow import schemas as S
from tillflow.operators import cleaning, star

SALE = {
    "transaction_id": "1",
    "transaction_date": "2022-01-16",
    "customer_id": "10",
    "customer_fname": "Ann",
    "cusomter_lname": "Lee",
    "cusomter_email": "ann@x.com",
    "sales_agent_id": "5",
    "branch_id": "3",
    "product_id": "100",
    "product_name": "Kettle",
    "product_category": "Kitchen",
    "offer_1": None,
    "offer_2": None,
    "offer_3": None,
    "offer_4": None,
    "offer_5": None,
    "units": "2",
    "unit_price": "10.5",
    "is_online": "yes",
    "payment_method": "Cash",
    "shipping_address": "1 Main St/Cairo/C/123",
}


def raw_sales(spark, *changes):
    rows = [tuple({**SALE, **change}[name] for name in V.SALES_COLUMNS) for change in changes]
    return spark.createDataFrame(rows, S.raw_schema(V.SALES_COLUMNS))


def fact_rows(raw):
    return star.fact_projection(cleaning.clean_sales(raw)).collect()


def test_clean_sales_renames_trims_and_splits(spark):
    row = cleaning.clean_sales(
        raw_sales(spark, {"customer_fname": " Ann ", "cusomter_email": " ann@x.com77 "})
    ).first()
    assert row.customer_fname == "Ann"
    assert row.customer_lname == "Lee"
    assert row.customer_email == "ann@x.com"
    assert (row.address, row.city, row.state, row.postal_code) == ("1 Main St", "Cairo", "C", "123")
    assert row.offer_1 is False


def test_rows_equal_after_trimming_and_parsing_are_one(spark):
    raw = raw_sales(
        spark,
        {},
        {"product_name": " Kettle "},
        {"offer_1": "false"},
        {"transaction_date": "2022-1-16"},
        {"unit_price": "10.50"},
    )
    assert cleaning.clean_sales(raw).count() == 1


def test_rows_that_differ_in_junk_stay_apart(spark):
    raw = raw_sales(spark, {"unit_price": "abc"}, {"unit_price": "xyz"})
    assert [row.unit_price for row in fact_rows(raw)] == [None, None]


def test_union_keeps_duplicates_and_matches_names(spark):
    raw = raw_sales(spark, {})
    turned = raw.select(list(reversed(raw.columns)))
    united = cleaning.union_batches(raw, turned, raw)
    assert united.count() == 3
    assert united.distinct().count() == 1


def test_fact_types_and_values(spark):
    fact = star.fact_projection(
        cleaning.clean_sales(raw_sales(spark, {"offer_2": "1", "offer_4": "True"}))
    )
    assert [(f.name, f.dataType.simpleString()) for f in fact.schema] == [
        *S.FACT_COLUMNS.items(),
        (S.FACT_PARTITION, "string"),
    ]
    row = fact.first()
    assert (row.units, row.unit_price, row.discount_percentage) == (2, 10.5, 10.0)
    assert row.total_paid_price == pytest.approx(18.9)
    assert row.is_online is True
    assert row.transaction_date == "2022-01-16"


@pytest.mark.parametrize(
    "change, column",
    [
        ({"units": "many"}, "units"),
        ({"units": "many"}, "total_paid_price"),
        ({"unit_price": "NaN"}, "unit_price"),
        ({"is_online": "maybe"}, "is_online"),
        ({"transaction_date": "yesterday"}, "transaction_date"),
    ],
)
def test_unreadable_values_become_null(spark, change, column):
    (row,) = fact_rows(raw_sales(spark, change))
    assert row[column] is None


def test_customer_comes_whole_from_the_first_sale(spark):
    sales = cleaning.clean_sales(
        raw_sales(
            spark,
            {"transaction_id": "3", "transaction_date": "2022-01-17", "customer_fname": "Late"},
            {"transaction_id": "2", "customer_fname": "Second"},
            {"transaction_id": "1", "customer_fname": "First", "shipping_address": None},
            {"customer_id": "11", "customer_fname": "Other"},
        )
    )
    customers = {row.customer_id: row for row in star.customer_dim(sales).collect()}
    assert set(customers) == {"10", "11"}
    assert customers["10"].first_name == "First"
    assert customers["10"].city is None


def test_one_row_per_product_whatever_its_names(spark):
    sales = cleaning.clean_sales(
        raw_sales(
            spark,
            {"product_name": "Kettle"},
            {"product_name": "Boiler"},
            {"transaction_date": "2022-01-15", "product_name": "Tea Kettle"},
        )
    )
    assert [tuple(row) for row in star.product_dim(sales).collect()] == [
        ("100", "Tea Kettle", "Kitchen")
    ]


def test_missing_keys_stay_out_of_dimensions_and_can_be_listed(spark):
    sales = cleaning.clean_sales(raw_sales(spark, {"customer_id": None}, {}))
    assert [row.customer_id for row in star.customer_dim(sales).collect()] == ["10"]
    assert star.without_key(sales, "customer_id").count() == 1


def test_agents_and_branches_are_trimmed(spark):
    agents = spark.createDataFrame(
        [("05", " Bob "), ("5", "Bob"), (None, "Nobody")], S.raw_schema(V.AGENT_COLUMNS)
    )
    dim = star.sales_agent_dim(cleaning.clean_agents(agents))
    assert [tuple(row) for row in dim.collect()] == [("5", "Bob")]
    branches = spark.createDataFrame(
        [("1", " A", "Giza"), ("1", "A", "Giza"), (None, "B", "x")], S.raw_schema(V.BRANCH_COLUMNS)
    )
    dim = star.branch_dim(cleaning.clean_branches(branches))
    assert [tuple(row) for row in dim.collect()] == [("1", "A", "Giza")]


def test_new_rows_leave_known_keys_alone(spark):
    dimension = spark.createDataFrame([("1", "new"), ("2", "new")], "k string, v string")
    existing = spark.createDataFrame([("1", "old"), ("3", "old")], "k string, v string")
    assert [tuple(row) for row in star.new_rows(dimension, existing, "k").collect()] == [
        ("2", "new")
    ]


def test_dimensions_need_no_deduplication(spark):
    plan = star.product_dim(cleaning.clean_sales(raw_sales(spark, {})))
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 1


def test_a_hot_customer_is_combined_before_the_shuffle(spark):
    sales = cleaning.clean_sales(raw_sales(spark, {})).withColumn(
        "n", F.explode(F.sequence(F.lit(1), F.lit(10)))
    )
    plan = star.customer_dim(sales)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_min") == 1


def test_the_first_sale_is_dated_and_counted_as_a_number(spark):
    sales = cleaning.clean_sales(
        raw_sales(
            spark,
            {"transaction_id": "10", "product_name": "Tenth"},
            {"transaction_id": "9", "product_name": "Ninth"},
            {"transaction_id": "1", "transaction_date": "someday", "product_name": "Junk"},
        )
    )
    assert [row.product_name for row in star.product_dim(sales).collect()] == ["Ninth"]


def test_a_name_goes_before_no_name(spark):
    agents = spark.createDataFrame(
        [("1", None), ("1", "Bob")], "sales_person_id string, name string"
    )
    assert [tuple(row) for row in star.sales_agent_dim(agents).collect()] == [("1", "Bob")]


def test_lines_of_one_sale_are_dealt_out_together_and_equal_ones_are_one(spark):
    raw = raw_sales(spark, {}, {"product_id": "0100"}, {"product_id": "101"}, {"product_id": None})
    clean = cleaning.clean_sales(cleaning.union_batches(raw, raw))
    plan = clean._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert "hashpartitioning(transaction_id" in plan and "REPARTITION_BY_COL" in plan
    assert sorted(row.product_id or "" for row in clean.collect()) == ["", "100", "101"]


def test_copies_of_lines_change_no_dimension_and_need_no_shuffle_of_lines(spark):
    raw = raw_sales(spark, {}, {}, {"customer_id": "11", "customer_fname": "Bo"})
    lines = cleaning.with_address_parts(cleaning.clean_lines(raw))
    for dimension in (star.customer_dim, star.product_dim):
        plan = dimension(lines)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1
        assert dimension(lines).exceptAll(dimension(cleaning.clean_sales(raw))).isEmpty()
        assert dimension(lines).count() == dimension(cleaning.clean_sales(raw)).count()

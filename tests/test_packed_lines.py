"""Lines are de-duplicated with most of their columns packed into one text."""

from tillflow import fixed_values as V
from tillflow import schemas as S
from tillflow.operators import cleaning

ODD = [None, "", "a", "\x01", "\x02", "\x02n", "\x02e", "\x02s", "a\x01b", "\x02\x01", "\x01\x02", "null"]


def _raw(spark, rows):
    return spark.createDataFrame(
        [tuple(row.get(name) for name in V.SALES_COLUMNS) for row in rows],
        S.raw_schema(V.SALES_COLUMNS),
    )


def test_packed_lines_come_out_as_they_went_in(spark):
    rows = [
        {"transaction_id": key, "customer_fname": x, "shipping_address": y, "offer_1": z}
        for key in ("1", None)
        for x in ODD
        for y in ODD
        for z in ("True", "0", None)
    ]
    rows += [{"transaction_id": "1", name: x} for name in V.SALES_COLUMNS[1:] for x in ODD]
    raw = _raw(spark, [*rows, *rows[::7]])
    lines = cleaning.clean_lines(raw)
    clean = cleaning.clean_sales(raw)
    expected = cleaning.with_address_parts(lines.dropDuplicates())
    assert clean.schema.simpleString() == expected.schema.simpleString()
    assert clean.exceptAll(expected).isEmpty() and expected.exceptAll(clean).isEmpty()
    assert clean.count() > 400


def test_few_columns_are_shuffled(spark):
    clean = cleaning.clean_sales(_raw(spark, [{"transaction_id": "1"}]))
    plan = clean._jdf.queryExecution().executedPlan()
    plain = ["transaction_id", "transaction_date", "customer_id"]
    plain += ["product_id", "product_name", "product_category"]
    (keys,) = {
        line.split("keys=[")[1].split("]")[0]
        for line in plan.toString().split("\n")
        if "HashAggregate" in line
    }
    assert sorted(k.split("#")[0].strip() for k in keys.split(",")) == sorted([*plain, "others"])

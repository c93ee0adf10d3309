"""Column expressions on hand-made values."""

from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillflow import fixed_values as V
from tillflow.functions.flags import discount_percentage, offer_flag, yes_no_flag
from tillflow.functions.money import (
    amount_sum,
    exact_sum,
    partial_sums,
    to_cents,
    total_of_sums,
    total_paid_price,
)
from tillflow.functions.text import (
    canonical,
    clean_email,
    finite_double,
    split_address,
    trim_all,
)


def apply(spark, values, expression):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [row[1] for row in rows.select("i", expression(F.col("v"))).orderBy("i").collect()]


def test_email_is_cut_behind_the_first_com(spark):
    values = [" a@b.com123 ", "x@y.community.com", "q@z.org", None]
    assert apply(spark, values, clean_email) == ["a@b.com", "x@y.com", "q@z.org", None]


def test_short_and_missing_addresses_leave_parts_null(spark):
    values = ["1 Main St/ Cairo /C/123", "1 Main St/Giza", None, ""]
    parts = split_address(F.col("v"))
    assert list(parts) == list(V.ADDRESS_PARTS)
    assert apply(spark, values, lambda _: parts["address"]) == ["1 Main St", "1 Main St", None, ""]
    assert apply(spark, values, lambda _: parts["city"]) == ["Cairo", "Giza", None, None]
    assert apply(spark, values, lambda _: parts["state"]) == ["C", None, None, None]
    assert apply(spark, values, lambda _: parts["postal_code"]) == ["123", None, None, None]


def test_yes_no_flag_knows_two_words(spark):
    assert apply(spark, ["yes", "no", "maybe", None], yes_no_flag) == [True, False, None, None]


def test_offer_flag_reads_any_spelling_and_never_raises(spark):
    values = ["1", "true", "True", "yes", "0", "false", "", "2", "1.0", "abc", None]
    assert apply(spark, values, offer_flag) == [True] * 4 + [False] * 7


@pytest.mark.parametrize(
    "offers, percent",
    [
        ((), 0),
        ((1,), 5),
        ((2,), 10),
        ((3,), 15),
        ((4,), 20),
        ((5,), 25),
        ((5, 2), 10),
        ((1, 2, 3, 4, 5), 5),
    ],
)
def test_first_offer_wins(spark, offers, percent):
    flags = {f"offer_{n}": F.lit(n in offers) for n in range(1, 6)}
    assert spark.range(1).select(discount_percentage(flags)).first()[0] == percent


def test_paid_price(spark):
    price = total_paid_price(F.lit(3), F.lit(10.0), F.lit(25))
    assert spark.range(1).select(price).first()[0] == 22.5


def test_trim_all(spark):
    df = spark.createDataFrame([(" a ", None, "b c ")], "x string, y string, z string")
    assert tuple(trim_all(df).first()) == ("a", None, "b c")


def test_canonical_spelling_keeps_what_it_cannot_read(spark):
    ids = apply(spark, ["007", "7", "A7", None], lambda v: canonical(v, "bigint"))
    assert ids == ["7", "7", "A7", None]
    texts = ["2022-1-16", "2022-01-16", "2022-01-16 10:00:00", "2022-01-16T10:00:00", "junk"]
    days = apply(spark, texts, lambda v: canonical(v, "date"))
    assert days == ["2022-01-16", "2022-01-16", *texts[2:]]


def test_numbers_that_are_none_become_null(spark):
    values = ["1.5", "junk", "NaN", "Infinity", "-Infinity", "", None]
    assert apply(spark, values, finite_double) == [1.5] + [None] * 6


@settings(max_examples=20, deadline=None)
@given(st.lists(st.integers(-(10**9), 10**9), min_size=1, max_size=40))
def test_exact_sum_equals_the_decimal_sum(spark, ten_thousandths):
    values = [n / 10_000 for n in ten_thousandths]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    assert df.agg(exact_sum(F.col("v"))).first()[0] == Decimal(sum(ten_thousandths)) / 10_000


def test_exact_sum_ignores_nulls_and_is_null_without_values(spark):
    df = spark.createDataFrame([(1, 0.1), (1, None), (1, 0.2), (2, None)], "k int, v double")
    sums = dict(df.groupBy("k").agg(exact_sum(F.col("v"))).collect())
    assert sums == {1: Decimal("0.3"), 2: None}


def test_exact_sum_holds_more_than_a_long_of_millionths(spark):
    total = spark.range(1000).agg(exact_sum(F.lit(1e12))).first()[0]
    assert total == Decimal(10) ** 15


def test_half_cents_round_up(spark):
    df = spark.createDataFrame([(1.005,), (1.0,)], "v double")
    assert df.agg(to_cents(exact_sum(F.col("v")))).first()[0] == 2.01


@pytest.mark.parametrize(
    "values", [[1e19], [1e300, 5.0], [9e18, 9e18, 0.5], [-1e19, 2.5], [1.25, None], [None]]
)
def test_sums_neither_fail_nor_saturate(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    given = [v for v in values if v is not None]
    expected = sum(given) if given else None
    assert df.agg(amount_sum(F.col("v"))).first()[0] == expected
    groups = df.groupBy("v").agg(*partial_sums(F.col("v")))
    assert groups.agg(total_of_sums()).first()[0] == expected

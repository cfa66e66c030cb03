from __future__ import annotations

from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gradeline.functions import (
    clean_numeric,
    clean_text,
    duration_parts,
    duration_total,
    month_num,
    null_outside,
    to_decimal,
    to_double,
    to_int,
)

# input, stripped, int, decimal
NUMBERS = [
    ("23", "23", 23, "23.0000"),
    ("23_", "23", 23, "23.0000"),
    (" 45 ", "45", 45, "45.0000"),
    ("-500", "-500", -500, "-500.0000"),
    ("", "", None, None),
    ("_", "", None, None),
    ("1,234.56 USD", "1234.56", None, "1234.5600"),
    ("23.0", "23.0", None, "23.0000"),
    ("23.9", "23.9", None, "23.9000"),
    ("2147483647", "2147483647", 2147483647, "2147483647.0000"),
    ("2147483648", "2147483648", None, "2147483648.0000"),
    ("-2147483648", "-2147483648", -2147483648, "-2147483648.0000"),
    ("__-333333333333333333333333333__", "-333333333333333333333333333", None, None),
    ("1.5E10", "1.510", None, "1.5100"),
    ("1-2", "1-2", None, None),
    ("-", "-", None, None),
    ("--5", "--5", None, None),
    (".", ".", None, None),
    ("1.2.3", "1.2.3", None, None),
    ("252.9247932365056", "252.9247932365056", None, "252.9248"),
    ("2.00005", "2.00005", None, "2.0001"),
    ("99999999999999.99995", "99999999999999.99995", None, None),
    ("99999999999999.99994", "99999999999999.99994", None, "99999999999999.9999"),
    ("123456789012345", "123456789012345", None, None),
    ("00000000000000000042", "00000000000000000042", 42, "42.0000"),
    ("12.", "12.", None, "12.0000"),
    (".5", ".5", None, "0.5000"),
    ("-.5", "-.5", None, "-0.5000"),
    ("+7", "7", 7, "7.0000"),
    ("٣", "", None, None),
    ("7\n", "7", 7, "7.0000"),
    (None, None, None, None),
]


def test_numbers(evaluate):
    inputs = [row[0] for row in NUMBERS]
    assert evaluate(clean_numeric, inputs) == [row[1] for row in NUMBERS]
    assert evaluate(to_int, inputs) == [row[2] for row in NUMBERS]
    assert evaluate(to_decimal, inputs) == [row[3] and Decimal(row[3]) for row in NUMBERS]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_no_number_raises_in_either_mode(spark, evaluate, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        assert evaluate(to_int, [row[0] for row in NUMBERS]) == [row[2] for row in NUMBERS]
        assert evaluate(lambda c: duration_parts(c)[0], ["NA", "", "5 Years"]) == [None, None, 5]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="0123456789.-_ eE+\t", max_size=22), min_size=200, max_size=200))
def test_guarded_casts_equal_plain_casts(evaluate, values):
    plain_int = evaluate(lambda c: clean_numeric(c).try_cast("int"), values)
    assert evaluate(to_int, values) == plain_int
    plain_decimal = evaluate(lambda c: clean_numeric(c).try_cast("decimal(18,4)"), values)
    assert evaluate(to_decimal, values) == plain_decimal
    plain_double = evaluate(lambda c: clean_numeric(c).try_cast("double"), values)
    assert evaluate(to_double, values) == plain_double


TEXTS = [
    ("NA", None),
    ("NM", None),
    ("_", None),
    ("_______", None),
    ("!@9#%8", None),
    ("", None),
    ("   ", None),
    (None, None),
    ("___", " "),
    ("_Foo_", " Foo "),
    ("na", "Na"),
    ("High_spent_Small_value_payments", "High Spent Small Value Payments"),
    ("McDonald's", "Mcdonald's"),
    ("Credit-Builder", "Credit-builder"),
    (
        "Auto Loan, Credit-Builder Loan, and Home Equity Loan",
        "Auto Loan, Credit-builder Loan, And Home Equity Loan",
    ),
    ("\tx", "\tx"),
]


def test_text(evaluate):
    assert evaluate(clean_text, [t[0] for t in TEXTS]) == [t[1] for t in TEXTS]


def test_cleaning_clean_text_changes_nothing(evaluate):
    inner = [t[0] for t in TEXTS if t[1] and t[1] == t[1].strip()]
    once = evaluate(clean_text, inner)
    assert evaluate(clean_text, once) == once


def test_duration(evaluate):
    cases = [
        ("22 Years and 1 Months", 22, 1, 265),
        ("0 Years and 3 Months", 0, 3, 3),
        ("5 Years", 5, None, 60),
        ("7 Months", None, 7, 7),
        ("1 Year", None, None, 0),
        ("5 years", None, None, 0),
        ("99999999999 Years", None, None, 0),
        ("NA", None, None, 0),
        ("", None, None, 0),
        (None, None, None, 0),
    ]
    inputs = [c[0] for c in cases]
    assert evaluate(lambda c: duration_parts(c)[0], inputs) == [c[1] for c in cases]
    assert evaluate(lambda c: duration_parts(c)[1], inputs) == [c[2] for c in cases]
    assert evaluate(lambda c: duration_total(*duration_parts(c)), inputs) == [c[3] for c in cases]


def test_month_num(evaluate):
    assert evaluate(month_num, ["January", "MAY", "december", "Smarch", "", None]) == [1, 5, 12, None, None, None]


def test_range_is_closed(evaluate):
    ranged = evaluate(lambda c: null_outside(c.cast("int"), 14, 100), ["13", "14", "100", "101", None])
    assert ranged == [None, 14, 100, None, None]

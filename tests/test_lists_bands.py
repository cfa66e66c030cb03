from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from gradeline.functions import age_group, contains_flag, flag_name, income_group, parse_list
from gradeline.operators.lists import (
    distinct_elements,
    element_frequency,
    multi_hot,
    unknown_elements,
)

LISTS = [
    (
        "Auto Loan, Not Specified, Student Loan, Home Equity Loan, Payday Loan, Payday Loan, And Credit-builder Loan",
        ["Auto Loan", "Not Specified", "Student Loan", "Home Equity Loan", "Payday Loan", "Credit-builder Loan"],
        1,
    ),
    ("And Payday Loan", ["Payday Loan"], 1),
    ("Android Loan", ["Android Loan"], 0),
    ("A,,B", ["A", "", "B"], 0),
    (",", [""], 0),
    ("", [""], 0),
    (None, None, 0),
]


def test_parse_list_and_flag(evaluate):
    inputs = [row[0] for row in LISTS]
    assert evaluate(parse_list, inputs) == [row[1] for row in LISTS]
    assert evaluate(lambda c: contains_flag(parse_list(c), "Payday Loan"), inputs) == [row[2] for row in LISTS]


def test_flag_name():
    assert flag_name("Credit-builder Loan") == "FLAG_CREDIT_BUILDER_LOAN"


def _loans(spark):
    rows = [(1, ["A", "B"]), (2, ["A", " "]), (3, None), (4, []), (5, ["C", None, "A"])]
    return spark.createDataFrame(rows, "id int, loans array<string>")


def test_element_statistics(spark):
    df = _loans(spark)
    frequency = element_frequency(df, "loans", "loan").collect()
    assert frequency[0].asDict() == {"loan": "A", "total_occurrences": 3}
    assert {r["loan"]: r["total_occurrences"] for r in frequency} == {"A": 3, "B": 1, "C": 1}
    assert [r["loan"] for r in distinct_elements(df, "loans", "loan").collect()] == ["A", "B", "C"]


def test_unknown_elements(spark):
    unknown = unknown_elements(_loans(spark), "loans", ["A", "B"], "loan").collect()
    assert {r["loan"]: r["n"] for r in unknown} == {" ": 1, "C": 1, None: 1}


def test_multi_hot_equals_membership(spark):
    df = multi_hot(_loans(spark), "loans", ["A", "B"])
    for row in df.collect():
        assert row["FLAG_A"] == int("A" in (row["loans"] or []))
        assert row["FLAG_B"] == int("B" in (row["loans"] or []))


def test_age_bands(evaluate):
    ages = ["13", "14", "17", "18", "25", "26", "35", "36", "50", "51", "60", "61", None]
    labels = [
        "Não informado", "14-17", "14-17", "18-25", "18-25", "26-35", "26-35", "36-50", "36-50",
        "51-60", "51-60", "61+", "Não informado",
    ]
    assert evaluate(lambda c: age_group(c.cast("int")), ages) == labels


def test_income_bands(spark):
    cases = {
        "-1": "Até 30 mil", "29999.9999": "Até 30 mil", "30000": "30 a 60 mil",
        "60000": "60 a 100 mil", "99999.9999": "60 a 100 mil", "100000": "100 mil ou mais",
    }
    rows = [(Decimal(v), label) for v, label in cases.items()] + [(None, "Não informado")]
    df = spark.createDataFrame(rows, "v decimal(18,4), want string")
    for row in df.select(income_group(F.col("v")).alias("got"), "want").collect():
        assert row["got"] == row["want"]

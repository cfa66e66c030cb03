"""A dirty credit table derived from ``orders``: one row per order, all text.

The same statement runs in Spark and, with the quoting of names changed, in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Each column reproduces one kind of dirt found in raw credit files.
CREDIT_RAW_SQL = r"""
WITH o AS (
  SELECT o_orderkey AS k, o_custkey AS c,
         CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) AS p
  FROM {orders})
SELECT CAST(k AS STRING) AS `ID`,
  CASE WHEN k % 97 = 0 THEN NULL ELSE concat('CUS_', CAST(c AS STRING)) END AS `Customer_ID`,
  CASE k % 14 WHEN 0 THEN 'January' WHEN 1 THEN 'february' WHEN 2 THEN 'MARCH' WHEN 3 THEN ' April '
    WHEN 4 THEN 'May' WHEN 5 THEN 'June' WHEN 6 THEN 'July' WHEN 7 THEN 'August' WHEN 8 THEN 'September'
    WHEN 9 THEN 'October' WHEN 10 THEN 'November' WHEN 11 THEN 'December' WHEN 12 THEN 'NA' ELSE 'Smarch' END AS `Month`,
  CASE k % 4 WHEN 0 THEN ' ann mcLEAN ' WHEN 1 THEN 'bob_ray' WHEN 2 THEN '' ELSE concat('name ', CAST(c AS STRING)) END AS `Name`,
  CASE k % 9 WHEN 0 THEN '-500' WHEN 1 THEN concat(CAST(14 + c % 60 AS STRING), '_') WHEN 2 THEN '8698'
    WHEN 3 THEN '23.0' WHEN 4 THEN '_' ELSE CAST(10 + c % 95 AS STRING) END AS `Age`,
  CASE WHEN k % 19 = 0 THEN '#F%$D@*&8' ELSE concat('000-', CAST(c AS STRING)) END AS `SSN`,
  CASE k % 3 WHEN 0 THEN '_______' WHEN 1 THEN 'Media_Manager' ELSE 'engineer' END AS `Occupation`,
  CASE k % 13 WHEN 0 THEN NULL WHEN 1 THEN concat(p, '_') WHEN 2 THEN concat('-', p) ELSE p END AS `Annual_Income`,
  CASE WHEN k % 6 = 0 THEN NULL ELSE concat(CAST(c AS STRING), '.33335') END AS `Monthly_Inhand_Salary`,
  CAST(k % 25 AS STRING) AS `Num_Bank_Accounts`,
  CAST(k % 75 AS STRING) AS `Num_Credit_Card`,
  CAST(k % 40 AS STRING) AS `Interest_Rate`,
  CASE k % 11 WHEN 0 THEN '-100' WHEN 1 THEN '1150_' ELSE CAST(k % 9 AS STRING) END AS `Num_of_Loan`,
  CASE k % 8 WHEN 0 THEN NULL
    WHEN 1 THEN 'Auto Loan, Not Specified, Student Loan, Home Equity Loan, Payday Loan, Payday Loan, And Credit-builder Loan'
    WHEN 2 THEN 'Credit-Builder Loan' WHEN 3 THEN 'Personal Loan, and Mortgage Loan'
    WHEN 4 THEN 'Debt Consolidation Loan,, And Auto Loan' WHEN 5 THEN 'Boat Loan'
    WHEN 6 THEN 'Student Loan' ELSE '_' END AS `Type_of_Loan`,
  CAST(k % 68 - 5 AS STRING) AS `Delay_from_due_date`,
  CASE k % 12 WHEN 0 THEN '' WHEN 1 THEN '3083_' WHEN 2 THEN '99999999999' ELSE CAST(k % 27 AS STRING) END AS `Num_of_Delayed_Payment`,
  CASE WHEN k % 10 = 0 THEN '_' ELSE concat(CAST(k % 30 AS STRING), '.27') END AS `Changed_Credit_Limit`,
  concat(CAST(k % 17 AS STRING), '.0') AS `Num_Credit_Inquiries`,
  CASE k % 6 WHEN 0 THEN '_' WHEN 1 THEN 'Good' WHEN 2 THEN 'Bad' WHEN 3 THEN 'Standard' WHEN 4 THEN '_______' ELSE 'NM' END AS `Credit_Mix`,
  CASE WHEN k % 15 = 0 THEN concat(p, '_') ELSE p END AS `Outstanding_Debt`,
  concat(CAST(20 + k % 30 AS STRING), '.822619632') AS `Credit_Utilization_Ratio`,
  CASE k % 7 WHEN 0 THEN 'NA' WHEN 1 THEN NULL WHEN 2 THEN '7 Months'
    ELSE concat(CAST(c % 33 AS STRING), ' Years and ', CAST(k % 12 AS STRING), ' Months') END AS `Credit_History_Age`,
  CASE k % 3 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' ELSE 'NM' END AS `Payment_of_Min_Amount`,
  concat(CAST(k % 500 AS STRING), '.57494921') AS `Total_EMI_per_month`,
  CASE WHEN k % 16 = 0 THEN '__10000__' ELSE concat(CAST(c % 900 AS STRING), '.415') END AS `Amount_invested_monthly`,
  CASE k % 5 WHEN 0 THEN '!@9#%8' WHEN 1 THEN 'High_spent_Small_value_payments'
    WHEN 2 THEN 'Low_spent_Large_value_payments' WHEN 3 THEN '___' ELSE '_low__spent' END AS `Payment-Behaviour`,
  CASE k % 17 WHEN 0 THEN '__-333333333333333333333333333__' ELSE concat(CAST(c AS STRING), '.9247932365056') END AS `Monthly_Balance`,
  CASE k % 10 WHEN 0 THEN NULL WHEN 1 THEN 'poor' WHEN 2 THEN 'Excellent' WHEN 3 THEN 'Good' WHEN 4 THEN 'Good'
    WHEN 5 THEN 'Poor' ELSE 'Standard' END AS `Credit_Score`
FROM o
"""


def read_source(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def credit_raw(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None) -> DataFrame:
    """The dirty table over all orders, or over the given ones.

    The orders are one file with one row group, which one task would read; as many small files,
    which the raw rows of a large load are, they are dealt by key before the wide rows are made.
    """
    if orders is None:
        orders = read_source(spark, sf_dir, "orders")
    narrow = orders.select("o_orderkey", "o_custkey", "o_totalprice")
    narrow = narrow.repartition(spark.sparkContext.defaultParallelism, "o_orderkey")
    return spark.sql(CREDIT_RAW_SQL, orders=narrow)


def credit_raw_duckdb(orders: str = "orders") -> str:
    """The same statement for DuckDB, over the named table or view."""
    return CREDIT_RAW_SQL.replace("`", '"').format(orders=orders)

"""Fixed values of the consumer-credit dataset: columns, ranges, rules, published schema."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gradeline.functions import flag_name
from gradeline.operators.cleaning import CleaningSpec

# Where the rows come from, their key, and the columns the checks need.
SOURCE_SYSTEM = "kaggle"
EXPECTED_FILES = ("train.csv", "test.csv")
BUSINESS_KEY = ("CUSTOMER_ID", "MONTH")
REQUIRED_COLUMNS = ("CUSTOMER_ID", "AGE", "ANNUAL_INCOME", "CREDIT_SCORE")

# The typed columns and their closed ranges.
CREDIT_SPEC = CleaningSpec(
    integers=(
        "AGE", "NUM_BANK_ACCOUNTS", "NUM_CREDIT_CARD", "INTEREST_RATE", "NUM_OF_LOAN",
        "DELAY_FROM_DUE_DATE", "NUM_OF_DELAYED_PAYMENT",
    ),
    decimals=(
        "ANNUAL_INCOME", "MONTHLY_INHAND_SALARY", "CHANGED_CREDIT_LIMIT", "OUTSTANDING_DEBT",
        "CREDIT_UTILIZATION_RATIO", "TOTAL_EMI_PER_MONTH", "AMOUNT_INVESTED_MONTHLY",
        "NUM_CREDIT_INQUIRIES", "MONTHLY_BALANCE",
    ),
    texts=(
        "MONTH", "NAME", "OCCUPATION", "TYPE_OF_LOAN", "CREDIT_MIX", "PAYMENT_OF_MIN_AMOUNT",
        "PAYMENT_BEHAVIOUR", "CREDIT_SCORE",
    ),
    ranges={
        "AGE": (14, 100),
        "NUM_BANK_ACCOUNTS": (0, 20),
        "NUM_CREDIT_CARD": (0, 60),
        "NUM_OF_LOAN": (0, 60),
    },
)

# Accepted scores, and the loan types that get a flag.
CREDIT_SCORES = ("Poor", "Standard", "Good")
KNOWN_LOAN_TYPES = (
    "Auto Loan", "Credit-builder Loan", "Debt Consolidation Loan", "Home Equity Loan",
    "Mortgage Loan", "Not Specified", "Payday Loan", "Personal Loan", "Student Loan",
)
LOAN_FLAGS = tuple(flag_name(loan_type) for loan_type in KNOWN_LOAN_TYPES)

# The published columns, in order.
GOLD_COLUMNS = (
    "ID", "CUSTOMER_ID", "MONTH_NUM", "MONTH", "NAME", "AGE", "AGE_GROUP", "SSN",
    "OCCUPATION", "CREDIT_SCORE", "ANNUAL_INCOME", "INCOME_GROUP",
    "MONTHLY_INHAND_SALARY", "NUM_BANK_ACCOUNTS", "NUM_CREDIT_CARD", "INTEREST_RATE",
    "CHANGED_CREDIT_LIMIT", "NUM_CREDIT_INQUIRIES", "CREDIT_MIX", "OUTSTANDING_DEBT",
    "CREDIT_UTILIZATION_RATIO", "CREDIT_HISTORY_TOTAL_MONTHS", "PAYMENT_OF_MIN_AMOUNT",
    "TOTAL_EMI_PER_MONTH", "AMOUNT_INVESTED_MONTHLY", "DELAY_FROM_DUE_DATE",
    "NUM_OF_DELAYED_PAYMENT", "NUM_OF_LOAN", "LOAN_TYPES",
    "FLAG_AUTO_LOAN", "FLAG_CREDIT_BUILDER_LOAN", "FLAG_DEBT_CONSOLIDATION_LOAN",
    "FLAG_HOME_EQUITY_LOAN", "FLAG_MORTGAGE_LOAN", "FLAG_PAYDAY_LOAN",
    "FLAG_PERSONAL_LOAN", "FLAG_STUDENT_LOAN", "FLAG_NOT_SPECIFIED",
    "_INGESTION_TIMESTAMP",
)


# The distinct counts among the metrics, by name.
DISTINCT_METRICS = {"distinct_customers": "CUSTOMER_ID"}


def metric_conditions() -> dict[str, Column]:
    """What the table metrics count, by name. A NULL score is not invalid."""
    return {
        "null_customer_id": F.col("CUSTOMER_ID").isNull(),
        "invalid_or_null_age": F.col("AGE").isNull(),
        "invalid_or_null_income": F.col("ANNUAL_INCOME").isNull(),
        "invalid_credit_score": ~F.col("CREDIT_SCORE").isin(*CREDIT_SCORES),
    }


def credit_rules() -> dict[str, Column]:
    """The row rules, by the name of the column that holds the outcome."""
    return {
        "dq_customer_id_valid": F.col("CUSTOMER_ID").isNotNull(),
        "dq_age_valid": F.col("AGE").between(*CREDIT_SPEC.ranges["AGE"]),
        "dq_income_valid": F.col("ANNUAL_INCOME") >= 0,
        "dq_credit_score_valid": F.col("CREDIT_SCORE").isin(*CREDIT_SCORES),
    }

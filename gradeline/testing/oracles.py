"""The registered queries as DuckDB SQL over the given tables, written independently."""

from __future__ import annotations

import re

from gradeline.testing.fixtures import CREDIT_RAW_SQL, credit_raw_duckdb

# Raw column names as delivered, by kind.
INTS = (
    "Age", "Num_Bank_Accounts", "Num_Credit_Card", "Interest_Rate", "Num_of_Loan",
    "Delay_from_due_date", "Num_of_Delayed_Payment",
)
DECIMALS = (
    "Annual_Income", "Monthly_Inhand_Salary", "Changed_Credit_Limit", "Outstanding_Debt",
    "Credit_Utilization_Ratio", "Total_EMI_per_month", "Amount_invested_monthly",
    "Num_Credit_Inquiries", "Monthly_Balance",
)
TEXTS = (
    "Month", "Name", "Occupation", "Type_of_Loan", "Credit_Mix", "Payment_of_Min_Amount",
    "Payment-Behaviour", "Credit_Score",
)
PLAIN = ("ID", "Customer_ID", "SSN", "Credit_History_Age")
RANGES = {"AGE": (14, 100), "NUM_BANK_ACCOUNTS": (0, 20), "NUM_CREDIT_CARD": (0, 60), "NUM_OF_LOAN": (0, 60)}
SENTINELS = "('', '_', '_______', 'NA', 'NM', '!@9#%8')"
LOANS = (
    "Auto Loan", "Credit-builder Loan", "Debt Consolidation Loan", "Home Equity Loan",
    "Mortgage Loan", "Not Specified", "Payday Loan", "Personal Loan", "Student Loan",
)
DERIVED = (
    "CREDIT_HISTORY_YEARS", "CREDIT_HISTORY_MONTHS_PART", "CREDIT_HISTORY_TOTAL_MONTHS", "MONTH_NUM",
    "LOAN_TYPES",
)
GOLD = """ID, CUSTOMER_ID, MONTH_NUM, MONTH, NAME, AGE, AGE_GROUP, SSN, OCCUPATION, CREDIT_SCORE,
    ANNUAL_INCOME, INCOME_GROUP, MONTHLY_INHAND_SALARY, NUM_BANK_ACCOUNTS, NUM_CREDIT_CARD,
    INTEREST_RATE, CHANGED_CREDIT_LIMIT, NUM_CREDIT_INQUIRIES, CREDIT_MIX, OUTSTANDING_DEBT,
    CREDIT_UTILIZATION_RATIO, CREDIT_HISTORY_TOTAL_MONTHS, PAYMENT_OF_MIN_AMOUNT,
    TOTAL_EMI_PER_MONTH, AMOUNT_INVESTED_MONTHLY, DELAY_FROM_DUE_DATE, NUM_OF_DELAYED_PAYMENT,
    NUM_OF_LOAN, array_to_string(LOAN_TYPES, '|') AS LOAN_TYPES"""


def norm(name: str) -> str:
    return name.upper().replace("-", "_").replace(" ", "_")


def strip(c: str) -> str:
    return f"regexp_replace({c}, '[^0-9.\\-]', '', 'g')"


def as_int(c: str) -> str:
    return f"CASE WHEN regexp_full_match({strip(c)}, '-?[0-9]+') THEN TRY_CAST({strip(c)} AS INTEGER) END"


def as_decimal(c: str) -> str:
    return f"TRY_CAST({strip(c)} AS DECIMAL(18,4))"


def as_text(c: str) -> str:
    words = f"string_split(regexp_replace(trim({c}), '_+', ' ', 'g'), ' ')"
    return (
        f"CASE WHEN trim({c}) NOT IN {SENTINELS} THEN array_to_string(list_transform({words}, "
        "lambda w: upper(w[1:1]) || lower(w[2:])), ' ') END"
    )


def part(unit: str) -> str:
    return f"TRY_CAST(nullif(regexp_extract(CREDIT_HISTORY_AGE, '([0-9]+)\\s+{unit}', 1), '') AS INTEGER)"


MONTHS = (
    "january", "february", "march", "april", "may", "june", "july", "august", "september",
    "october", "november", "december",
)
MONTH_NUM = "CASE lower(MONTH) " + " ".join(f"WHEN '{m}' THEN {i}" for i, m in enumerate(MONTHS, 1)) + " END"
LOAN_LIST = """list_filter(
      list_transform(string_split(TYPE_OF_LOAN, ','), lambda x: regexp_replace(trim(x), '^and\\s+', '', 'i')),
      lambda y, i: list_position(
        list_transform(string_split(TYPE_OF_LOAN, ','), lambda x: regexp_replace(trim(x), '^and\\s+', '', 'i')), y) = i)"""
AGE_GROUP = """CASE WHEN AGE BETWEEN 14 AND 17 THEN '14-17' WHEN AGE BETWEEN 18 AND 25 THEN '18-25'
    WHEN AGE BETWEEN 26 AND 35 THEN '26-35' WHEN AGE BETWEEN 36 AND 50 THEN '36-50'
    WHEN AGE BETWEEN 51 AND 60 THEN '51-60' WHEN AGE > 60 THEN '61+' ELSE 'Não informado' END"""
INCOME_GROUP = """CASE WHEN ANNUAL_INCOME < 30000 THEN 'Até 30 mil' WHEN ANNUAL_INCOME < 60000 THEN '30 a 60 mil'
    WHEN ANNUAL_INCOME < 100000 THEN '60 a 100 mil' WHEN ANNUAL_INCOME >= 100000 THEN '100 mil ou mais'
    ELSE 'Não informado' END"""
FLAGS = {loan: "FLAG_" + norm(loan) for loan in LOANS}


def flag(loan: str) -> str:
    return f"CASE WHEN list_contains(LOAN_TYPES, '{loan}') THEN 1 ELSE 0 END"


# The columns of the raw rows in their order.
RAW_ORDER = tuple(re.findall(r"AS `([^`]+)`", CREDIT_RAW_SQL))


def stages(last: str, orders: str = "orders", new_id: str | None = None) -> str:
    """WITH clause holding the stages up to ``last``: raw, clean, ranged, silver, checked, valid, gold.

    ``new_id`` is what rows without an id get as theirs.
    """
    renamed = ", ".join(f'"{c}" AS {norm(c)}' for c in (*PLAIN, *INTS, *DECIMALS, *TEXTS))
    cleaned = ", ".join(
        [norm(c) for c in PLAIN]
        + [f"{as_int(norm(c))} AS {norm(c)}" for c in INTS]
        + [f"{as_decimal(norm(c))} AS {norm(c)}" for c in DECIMALS]
        + [f"{as_text(norm(c))} AS {norm(c)}" for c in TEXTS]
    )
    limited = ", ".join(f"CASE WHEN {c} BETWEEN {lo} AND {hi} THEN {c} END AS {c}" for c, (lo, hi) in RANGES.items())
    flags = ", ".join(f"{flag(loan)} AS {name}" for loan, name in FLAGS.items())
    ctes = {
        "raw": f"SELECT {renamed} FROM ({credit_raw_duckdb(orders)})" if new_id is None
        else f"SELECT * REPLACE (coalesce(CUSTOMER_ID, '{new_id}') AS CUSTOMER_ID) FROM (SELECT {renamed} FROM ({credit_raw_duckdb(orders)}))",
        "clean": f"SELECT {cleaned} FROM raw",
        "ranged": f"SELECT * REPLACE ({limited}) FROM clean",
        "silver": f"""SELECT *, {part('Years')} AS CREDIT_HISTORY_YEARS, {part('Months')} AS CREDIT_HISTORY_MONTHS_PART,
            coalesce({part('Years')}, 0) * 12 + coalesce({part('Months')}, 0) AS CREDIT_HISTORY_TOTAL_MONTHS,
            {MONTH_NUM} AS MONTH_NUM, {LOAN_LIST} AS LOAN_TYPES FROM ranged""",
        "checked": """SELECT *, id_ok AND age_ok AND income_ok AND score_ok AS is_ok FROM (
            SELECT *, CUSTOMER_ID IS NOT NULL AS id_ok, AGE BETWEEN 14 AND 100 AS age_ok,
                ANNUAL_INCOME >= 0 AS income_ok, CREDIT_SCORE IN ('Poor', 'Standard', 'Good') AS score_ok FROM silver)""",
        "valid": "SELECT * FROM checked WHERE is_ok",
        "gold": f"SELECT *, {flags}, {AGE_GROUP} AS AGE_GROUP, {INCOME_GROUP} AS INCOME_GROUP FROM valid",
    }
    names = list(ctes)
    wanted = names[: names.index(last) + 1]
    return "WITH " + ",\n".join(f"{name} AS ({ctes[name]})" for name in wanted) + "\n"


def per_column(columns, condition: str, count: str, table: str) -> str:
    """One row per column counting the rows where the condition on ``{c}`` holds."""
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(sum(CASE WHEN {condition.format(c=c)} THEN 1 ELSE 0 END) AS BIGINT) AS {count} FROM {table}"
        for c in columns
    )


def load_sql(statuses: str) -> str:
    """Silver over the orders of these statuses, one row for each full key."""
    inner = stages("silver", f"(SELECT * FROM orders WHERE o_orderstatus IN {statuses})")
    return (
        f"SELECT * FROM ({inner} SELECT * REPLACE (array_to_string(LOAN_TYPES, '|') AS LOAN_TYPES), row_number() OVER ("
        "PARTITION BY CUSTOMER_ID, MONTH ORDER BY CAST(ID AS BIGINT)) AS r FROM silver) "
        "WHERE r = 1 OR CUSTOMER_ID IS NULL OR MONTH IS NULL"
    )


def changes_sql() -> str:
    """Source rows against the one stored row of their key, value by value."""
    return f"""WITH t AS ({load_sql("('F', 'P')")}), s AS ({load_sql("('O', 'P')")})
        SELECT s.ID, s.CUSTOMER_ID, s.MONTH, CASE WHEN t.ID IS NULL THEN 'inserted'
            WHEN EXISTS (SELECT x FROM (SELECT s.* EXCLUDE (r)) x INTERSECT SELECT y FROM (SELECT t.* EXCLUDE (r)) y) THEN 'unchanged'
            ELSE 'updated' END AS change
        FROM s LEFT JOIN t ON s.CUSTOMER_ID = t.CUSTOMER_ID AND s.MONTH = t.MONTH"""


def upsert_sql() -> str:
    return f"""WITH t AS ({load_sql("('F', 'P')")}), s AS ({load_sql("('O')")})
        SELECT * EXCLUDE (r) FROM t WHERE NOT EXISTS (
            SELECT 1 FROM s WHERE s.CUSTOMER_ID = t.CUSTOMER_ID AND s.MONTH = t.MONTH)
        UNION ALL SELECT * EXCLUDE (r) FROM s"""


def oracle_queries() -> dict[str, str]:
    raw, clean, silver, checked, valid, gold = (
        stages(s) for s in ("raw", "clean", "silver", "checked", "valid", "gold")
    )
    all_raw = [norm(c) for c in (*PLAIN, *INTS, *DECIMALS, *TEXTS)]
    typed = [norm(c) for c in (*INTS, *DECIMALS, *TEXTS)]
    plain_derived = ", ".join([*all_raw, *DERIVED[:-1]])
    overflow = f"abs(TRY_CAST({strip('{c}')} AS DOUBLE)) > 2147483647 AND TRY_CAST({strip('{c}')} AS DOUBLE) <> -2147483648"
    malformed = " UNION ALL ".join(
        [per_column([norm(c)], "{c} IS NOT NULL AND (" + as_int(norm(c)).replace("{", "{{").replace("}", "}}") + ") IS NULL", "malformed", "raw") for c in INTS]
        + [per_column([norm(c)], "{c} IS NOT NULL AND (" + as_decimal(norm(c)) + ") IS NULL", "malformed", "raw") for c in DECIMALS]
    )
    rule_columns = """id_ok AS dq_customer_id_valid, age_ok AS dq_age_valid, income_ok AS dq_income_valid,
        score_ok AS dq_credit_score_valid, is_ok AS dq_is_valid"""
    outcome = "CASE WHEN is_ok THEN 'valid' WHEN NOT is_ok THEN 'rejected' ELSE 'unknown' END"
    shown = "ID, CUSTOMER_ID, AGE, ANNUAL_INCOME, CREDIT_SCORE"
    loan_rows = "SELECT unnest(LOAN_TYPES) AS loan_type FROM valid"
    gold_columns = GOLD + ", " + ", ".join(FLAGS.values())
    as_csv = "SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang, source, CAST(n_chars AS VARCHAR) AS n_chars FROM documents"
    shown_silver = f"SELECT {plain_derived}, array_to_string(LOAN_TYPES, '|') AS LOAN_TYPES, 'train.csv' AS _SOURCE_FILE, 'kaggle' AS _SOURCE_SYSTEM"
    types = ", ".join(f"({i}, '{c}', 'string')" for i, c in enumerate(norm(c) for c in RAW_ORDER))
    sentinel_rows = " UNION ALL ".join(
        f"SELECT '{norm(c)}' AS column_name, trim({norm(c)}) AS sentinel, count(*) AS n FROM raw WHERE trim({norm(c)}) IN {SENTINELS} GROUP BY 2" for c in TEXTS)
    rules = {"dq_customer_id_valid": "id_ok", "dq_age_valid": "age_ok", "dq_income_valid": "income_ok", "dq_credit_score_valid": "score_ok"}

    def named(test: str) -> str:
        return "concat_ws(',', " + ", ".join(f"CASE WHEN {test.format(c=c)} THEN '{name}' END" for name, c in rules.items()) + ")"

    heavy = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {c} AS value, count(*) AS n FROM raw GROUP BY {c}" for c in all_raw)
    silver_columns = [*all_raw, *DERIVED[:-1]]
    numeric = {norm(c) for c in (*INTS, *DECIMALS)} | set(DERIVED[:-1])
    return {
        "raw_audit": raw + f"""SELECT * FROM (
            SELECT 'null' AS rule, column_name, CAST(NULL AS VARCHAR) AS value, n FROM ({per_column(all_raw, "{c} IS NULL", "n", "raw")})
            UNION ALL SELECT 'malformed', column_name, NULL, malformed FROM ({malformed})
            UNION ALL SELECT 'overflow', column_name, NULL, overflow_count FROM ({per_column([norm(c) for c in INTS], overflow, "overflow_count", "raw")})
            UNION ALL SELECT 'sentinel', column_name, sentinel, n FROM ({sentinel_rows})) WHERE n > 0""",
        "rule_combinations": checked + f"SELECT {named('NOT {c}')} AS failed_rules, {named('{c} IS NULL')} AS unknown_rules, count(*) AS n FROM checked GROUP BY 1, 2",
        "heavy_raw_values": raw + f"SELECT column_name, value, n FROM ({heavy}) WHERE n >= greatest(1, ceil(0.02 * (SELECT count(*) FROM raw)))",
        "merged_load_summary": silver + " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count, TRUE AS distinct_near, {c in numeric} AND count({c}) > 0 AS has_quantiles FROM silver"
            for c in silver_columns),
        "arrival_ledger": """WITH f AS (SELECT o_orderstatus || '.csv' AS source_file, count(*) AS n, count(*) FILTER (o_totalprice < 100000) AS fewer FROM orders GROUP BY 1)
            SELECT 1 AS load, source_file, 'new' AS status, n AS row_count FROM f WHERE source_file IN ('F.csv', 'P.csv')
            UNION ALL SELECT load, file, 'missing', 0 FROM (VALUES (1, 'O.csv'), (1, 'Z.csv'), (2, 'Z.csv')) v(load, file)
            UNION ALL SELECT 2, source_file, CASE source_file WHEN 'F.csv' THEN 'repeated' WHEN 'O.csv' THEN 'late' ELSE 'changed' END,
                CASE source_file WHEN 'P.csv' THEN fewer ELSE n END FROM f""",
        "csv_bronze_roundtrip": as_csv,
        "csv_split_read": as_csv,
        "table_scan": "SELECT * FROM orders",
        "full_refresh_idempotent": silver + shown_silver + " FROM silver",
        "fixed_schema_sink": silver + shown_silver + ", TRUE AS refused FROM silver",
        "sql_point_lookup": gold + "SELECT g.ID, g.CUSTOMER_ID, g.MONTH, raw.AGE AS RAW_AGE FROM gold g JOIN raw ON g.ID = raw.ID WHERE g.CUSTOMER_ID = 'CUS_1'",
        "source_completeness": raw + "SELECT f AS missing_file FROM (VALUES ('train.csv'), ('test.csv')) e(f) WHERE f NOT IN (SELECT 'train.csv' FROM raw)",
        "audit_columns": raw + "SELECT ID, 'train.csv' AS source_file, 'kaggle' AS source_system, TRUE AS has_timestamp FROM raw",
        "normalize_columns": raw + f"SELECT {', '.join(all_raw)} FROM raw",
        "gold_customer": gold + f"SELECT {gold_columns} FROM gold",
        "silver_clean": stages("ranged") + f"SELECT ID, {', '.join(typed)} FROM ranged",
        "silver_clean_optional_columns": stages("ranged") + f"SELECT ID, {', '.join(c for c in typed if c not in ('CREDIT_SCORE', 'MONTHLY_BALANCE'))} FROM ranged",
        "int_overflow_rows": raw + f"SELECT ID, {strip('NUM_OF_DELAYED_PAYMENT')} AS cleaned_value, TRY_CAST({strip('NUM_OF_DELAYED_PAYMENT')} AS DOUBLE) AS numeric_value FROM raw WHERE {overflow.format(c='NUM_OF_DELAYED_PAYMENT')}",
        "int_overflow_counts": raw + per_column([norm(c) for c in INTS], overflow, "overflow_count", "raw"),
        "point_lookup": silver + "SELECT ID, CUSTOMER_ID, MONTH FROM silver WHERE CUSTOMER_ID = 'CUS_1'",
        "bronze_point_lookup": raw + "SELECT ID, CUSTOMER_ID, MONTH FROM raw WHERE CUSTOMER_ID = 'CUS_1'",
        "null_counts": silver + per_column([*all_raw, *DERIVED], "{c} IS NULL", "null_count", "silver"),
        "in_list_predicate": silver + "SELECT ID, CREDIT_SCORE IN ('Poor', 'Standard', 'Good') AS is_in, CREDIT_SCORE NOT IN ('Poor', 'Standard', 'Good') AS is_not_in FROM silver",
        "range_null_out": stages("ranged") + f"SELECT ID, {', '.join(RANGES)} FROM ranged",
        "income_group": silver + f"SELECT {INCOME_GROUP} AS INCOME_GROUP, count(*) AS n FROM silver GROUP BY 1",
        "age_group": silver + f"SELECT {AGE_GROUP} AS AGE_GROUP, count(*) AS n FROM silver GROUP BY 1",
        "dq_flags": checked + f"SELECT ID, {rule_columns} FROM checked",
        "valid_rows": checked + f"SELECT {shown} FROM checked WHERE is_ok",
        "rejected_rows": checked + f"SELECT {shown} FROM checked WHERE NOT is_ok",
        "rejected_rows_with_unknown": checked + f"SELECT {shown} FROM checked WHERE is_ok IS DISTINCT FROM TRUE",
        "dq_partition_counts": checked + f"""SELECT 'drop' AS on_unknown, {outcome} AS dq_status, count(*) AS n FROM checked GROUP BY 2
            UNION ALL SELECT 'reject', CASE WHEN is_ok THEN 'valid' ELSE 'rejected' END, count(*) FROM checked GROUP BY 2""",
        "clean_numeric": raw + f"""SELECT ID, {strip('AMOUNT_INVESTED_MONTHLY')} AS stripped FROM raw
            UNION ALL SELECT concat('part-', p_partkey), {strip('p_brand')} FROM part""",
        "clean_int": clean + f"SELECT ID, {', '.join(norm(c) for c in INTS)} FROM clean",
        "clean_decimal": clean + f"SELECT ID, {', '.join(norm(c) for c in DECIMALS)} FROM clean",
        "clean_text": clean + f"SELECT ID, {', '.join(norm(c) for c in TEXTS)} FROM clean",
        "duration_parts": silver + "SELECT ID, CREDIT_HISTORY_YEARS AS years, CREDIT_HISTORY_MONTHS_PART AS months FROM silver",
        "duration_total_months": silver + "SELECT ID, CREDIT_HISTORY_TOTAL_MONTHS AS total_months FROM silver",
        "month_num": silver + "SELECT ID, MONTH_NUM AS month_num FROM silver",
        "list_parse": silver + "SELECT ID, array_to_string(LOAN_TYPES, '|') AS loan_types FROM silver",
        "loan_flags": silver + "SELECT ID, " + ", ".join(f"{flag(loan)} AS {name}" for loan, name in FLAGS.items()) + " FROM silver",
        "loan_type_frequency": valid + f"SELECT loan_type, count(*) AS total_occurrences FROM ({loan_rows}) WHERE trim(loan_type) <> '' GROUP BY loan_type",
        "distinct_loan_types": valid + f"SELECT DISTINCT loan_type FROM ({loan_rows}) WHERE trim(loan_type) <> ''",
        "quality_metrics": silver + """SELECT count(*) AS total_rows, count(DISTINCT CUSTOMER_ID) AS distinct_customers,
            count(*) FILTER (CUSTOMER_ID IS NULL) AS null_customer_id, count(*) FILTER (AGE IS NULL) AS invalid_or_null_age,
            count(*) FILTER (ANNUAL_INCOME IS NULL) AS invalid_or_null_income,
            count(*) FILTER (CREDIT_SCORE NOT IN ('Poor', 'Standard', 'Good')) AS invalid_credit_score FROM silver""",
        "value_profile": silver + "SELECT PAYMENT_BEHAVIOUR, count(*) AS n FROM silver GROUP BY 1",
        "bronze_value_profile": raw + "SELECT INTEREST_RATE, count(*) AS n FROM raw GROUP BY 1",
        "load_profile": raw + f"SELECT count(*) AS row_count, position, column_name, type FROM raw, (VALUES {types}) t(position, column_name, type) GROUP BY ALL",
        "critical_rows": silver + "SELECT count(*) AS critical_error_count FROM silver WHERE CUSTOMER_ID IS NULL",
        "empty_table_check": silver + """SELECT 'silver' AS input, count(*) = 0 AS is_empty FROM silver
            UNION ALL SELECT 'out_of_range', count(*) = 0 FROM silver WHERE NUM_OF_LOAN > 60""",
        "malformed_counts": raw + malformed,
        "sentinel_counts": raw + "SELECT * FROM (" + " UNION ALL ".join(
            f"SELECT '{norm(c)}' AS column_name, trim({norm(c)}) AS sentinel, count(*) AS n FROM raw WHERE trim({norm(c)}) IN {SENTINELS} GROUP BY 2" for c in TEXTS) + ")",
        "unknown_loan_types": silver + "SELECT loan_type, count(*) AS n FROM (SELECT unnest(LOAN_TYPES) AS loan_type FROM silver) WHERE loan_type NOT IN ("
            + ", ".join(f"'{loan}'" for loan in LOANS) + ") GROUP BY 1",
        "duplicate_keys": silver + "SELECT CUSTOMER_ID, MONTH, count(*) AS n FROM silver GROUP BY 1, 2 HAVING count(*) > 1",
        "upsert_by_key": upsert_sql(),
        "upsert_into_table": upsert_sql(),
        "upsert_shuffled": upsert_sql(),
        "upsert_changes": changes_sql(),
        "limit_rows": silver + "SELECT least(count(*), 5) AS n, TRUE AS all_known FROM silver",
        "gate_stops_publishing": checked + f"SELECT {outcome} AS dq_status, count(*) AS n, TRUE AS refused, FALSE AS published FROM checked GROUP BY 1",
        "silver_customers": silver + shown_silver + " FROM silver",
        "end_to_end_run": stages("gold", new_id="CUS_NEW") + f"SELECT {gold_columns} FROM gold",
    }

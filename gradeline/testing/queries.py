"""One query per operator, each over the whole of the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeline.functions import (
    age_group,
    clean_numeric,
    duration_parts,
    duration_total,
    income_group,
    month_num,
    parse_list,
)
from gradeline.operators.audits import audit, audit_conditions, outcome_histogram
from gradeline.operators.cleaning import clean_columns, clean_silver, null_out_of_range
from gradeline.operators.columns import normalize_columns
from gradeline.operators.lists import (
    distinct_elements,
    element_frequency,
    multi_hot,
    unknown_elements,
)
from gradeline.operators.quality import (
    OVERALL_FLAG,
    CriticalDataError,
    critical_count,
    duplicate_keys,
    emptiness,
    int_overflow_counts,
    int_overflow_rows,
    load_profile,
    malformed_counts,
    null_profile,
    partition_counts,
    quality_metrics,
    sentinel_counts,
    split,
    value_profile,
)
from gradeline.operators.summaries import distinct_counts, heavy_values, load_summary, merged_summary
from gradeline.operators.upsert import classify_changes, latest_per_key, upsert, upsert_table
from gradeline.plans.credit import (
    BUSINESS_KEY,
    CREDIT_SCORES,
    CREDIT_SPEC,
    DISTINCT_METRICS,
    EXPECTED_FILES,
    KNOWN_LOAN_TYPES,
    LOAN_FLAGS,
    credit_rules,
    metric_conditions,
)
from gradeline.plans.layers import build_bronze, build_checked, build_gold, build_silver
from gradeline.plans.run import CreditRun
from gradeline.session import configure_session
from gradeline.sources import (
    SchemaMismatchError,
    arrival_status,
    digest_files,
    missing_sources,
    publish_table,
    read_raw_csv,
    read_raw_csv_split,
    read_table,
    register_views,
    scratch_dir,
    write_table,
)
from gradeline.sources.arrivals import LEDGER
from gradeline.testing.fixtures import credit_raw, read_source

Query = Callable[[SparkSession, str], DataFrame]

# Fixed value: the customer looked up by the point queries.
CUSTOMER = "CUS_1"
# Fixed value: the customer that rows without an id are given to.
NEW_CUSTOMER = "CUS_NEW"
HEAVY_SHARE = 0.02
CHECKED_SAMPLE = ("ID", "CUSTOMER_ID", "AGE", "ANNUAL_INCOME", "CREDIT_SCORE")


def _scratch(spark: SparkSession) -> tuple[str, str]:
    """A fresh name, and a fresh folder for it in the shared scratch space."""
    name = f"gradeline_{uuid.uuid4().hex}"
    return name, f"{scratch_dir(spark)}/{name}"


def _scratch_database(spark: SparkSession) -> str:
    name, folder = _scratch(spark)
    spark.sql(f"CREATE DATABASE {name} LOCATION '{folder}'")
    return name


# --- layers ----------------------------------------------------------------


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_columns(credit_raw(spark, sf_dir))


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_bronze(credit_raw(spark, sf_dir), "train.csv")


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_silver(bronze(spark, sf_dir))


def checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_checked(silver(spark, sf_dir))


def valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split(checked(spark, sf_dir))[0]


def _shown(df: DataFrame) -> DataFrame:
    """Without the load time, which differs per run, and with lists as text."""
    return df.drop("_INGESTION_TIMESTAMP").withColumn("LOAN_TYPES", F.array_join("LOAN_TYPES", "|"))


# --- sources and sinks -----------------------------------------------------


def _documents_as_csv(spark: SparkSession, sf_dir: str) -> str:
    _, folder = _scratch(spark)
    docs = read_source(spark, sf_dir, "documents")
    (
        docs.write.option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(folder)
    )
    return folder


def csv_bronze_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_raw_csv(spark, _documents_as_csv(spark, sf_dir))


def csv_split_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_raw_csv_split(spark, _documents_as_csv(spark, sf_dir))


def table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, folder = _scratch(spark)
    write_table(read_source(spark, sf_dir, "orders"), name, evolve_schema=True, path=folder)
    return read_table(spark, name)


def full_refresh_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written first without a column, then twice with the whole schema."""
    name, folder = _scratch(spark)
    df = silver(spark, sf_dir)
    publish_table(df.drop("CREDIT_SCORE"), name, evolve_schema=True, path=folder)
    for _ in range(2):
        publish_table(df, name, evolve_schema=True)
    return _shown(read_table(spark, name))


def fixed_schema_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, folder = _scratch(spark)
    df = silver(spark, sf_dir)
    publish_table(df, name, evolve_schema=False, path=folder)
    try:
        publish_table(df.withColumn("AGE", F.col("AGE").cast("string")), name, evolve_schema=False)
        refused = False
    except SchemaMismatchError:
        refused = True
    return _shown(read_table(spark, name)).withColumn("refused", F.lit(refused))


def sql_point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL over a stored Gold table, joined with a session view of the raw rows."""
    name, folder = _scratch(spark)
    write_table(build_gold(valid(spark, sf_dir)), name, evolve_schema=False, path=folder)
    register_views({"gradeline_raw": raw(spark, sf_dir)})
    return spark.sql(
        f"SELECT g.ID, g.CUSTOMER_ID, g.MONTH, r.AGE AS RAW_AGE FROM {name} g JOIN gradeline_raw r ON g.ID = r.ID "
        f"WHERE g.CUSTOMER_ID = '{CUSTOMER}'"
    )


def source_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return missing_sources(normalize_columns(bronze(spark, sf_dir)), EXPECTED_FILES)


# --- projections and filters -----------------------------------------------


def audit_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze(spark, sf_dir).select(
        "ID",
        F.col("_source_file").alias("source_file"),
        F.col("_source_system").alias("source_system"),
        F.col("_ingestion_timestamp").isNotNull().alias("has_timestamp"),
    )


def silver_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_silver(raw(spark, sf_dir), CREDIT_SPEC).select("ID", *CREDIT_SPEC.cleaners())


def silver_clean_optional_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    absent = ("CREDIT_SCORE", "MONTHLY_BALANCE")
    df = clean_silver(raw(spark, sf_dir).drop(*absent), CREDIT_SPEC)
    return df.select("ID", *[c for c in CREDIT_SPEC.cleaners() if c not in absent])


def point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver(spark, sf_dir).filter(f"CUSTOMER_ID == '{CUSTOMER}'").select("ID", "CUSTOMER_ID", "MONTH")


def bronze_point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir).filter(F.col("CUSTOMER_ID") == CUSTOMER).select("ID", "CUSTOMER_ID", "MONTH")


def in_list_predicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = F.col("CREDIT_SCORE").isin(*CREDIT_SCORES)
    return silver(spark, sf_dir).select("ID", known.alias("is_in"), (~known).alias("is_not_in"))


def range_null_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = clean_columns(raw(spark, sf_dir), CREDIT_SPEC)
    return null_out_of_range(cleaned, CREDIT_SPEC.ranges).select("ID", *CREDIT_SPEC.ranges)


def limit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows a limit gives, and whether all are rows of the table: the same each time."""
    ids = silver(spark, sf_dir).select("ID")
    known = ids.distinct().withColumn("known", F.lit(True))
    return ids.limit(5).join(known, "ID", "left").agg(
        F.count("*").alias("n"), F.coalesce(F.bool_and(F.coalesce("known", F.lit(False))), F.lit(True)).alias("all_known")
    )


# --- cleaning --------------------------------------------------------------


def clean_numeric_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = raw(spark, sf_dir).select("ID", clean_numeric(F.col("AMOUNT_INVESTED_MONTHLY")).alias("stripped"))
    brands = read_source(spark, sf_dir, "part").select(
        F.concat(F.lit("part-"), "p_partkey").alias("ID"),
        clean_numeric(F.col("p_brand")).alias("stripped"),
    )
    return rows.unionByName(brands)


def _cleaned(columns: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        names = getattr(CREDIT_SPEC, columns)
        return clean_columns(raw(spark, sf_dir), CREDIT_SPEC).select("ID", *names)

    return query


def duration_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    years, months = duration_parts(F.col("CREDIT_HISTORY_AGE"))
    return raw(spark, sf_dir).select("ID", years.alias("years"), months.alias("months"))


def duration_total_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = duration_total(*duration_parts(F.col("CREDIT_HISTORY_AGE")))
    return raw(spark, sf_dir).select("ID", total.alias("total_months"))


def month_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = clean_columns(raw(spark, sf_dir), CREDIT_SPEC)
    return cleaned.select("ID", month_num(F.col("MONTH")).alias("month_num"))


# --- lists and bands -------------------------------------------------------


def list_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = clean_columns(raw(spark, sf_dir), CREDIT_SPEC)
    parsed = parse_list(F.col("TYPE_OF_LOAN"))
    return cleaned.select("ID", F.array_join(parsed, "|").alias("loan_types"))


def loan_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_hot(silver(spark, sf_dir), "LOAN_TYPES", KNOWN_LOAN_TYPES).select("ID", *LOAN_FLAGS)


def loan_type_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return element_frequency(valid(spark, sf_dir), "LOAN_TYPES", "loan_type")


def distinct_loan_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_elements(valid(spark, sf_dir), "LOAN_TYPES", "loan_type")


def unknown_loan_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unknown_elements(silver(spark, sf_dir), "LOAN_TYPES", KNOWN_LOAN_TYPES, "loan_type")


def age_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    group = age_group(F.col("AGE")).alias("AGE_GROUP")
    return silver(spark, sf_dir).groupBy(group).agg(F.count("*").alias("n"))


def income_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    group = income_group(F.col("ANNUAL_INCOME")).alias("INCOME_GROUP")
    return silver(spark, sf_dir).groupBy(group).agg(F.count("*").alias("n"))


# --- quality ---------------------------------------------------------------


def dq_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checked(spark, sf_dir).select("ID", *credit_rules(), OVERALL_FLAG)


def valid_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return valid(spark, sf_dir).select(*CHECKED_SAMPLE)


def rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split(checked(spark, sf_dir))[1].select(*CHECKED_SAMPLE)


def rejected_rows_with_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split(checked(spark, sf_dir), on_unknown="reject")[1].select(*CHECKED_SAMPLE)


def dq_partition_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = partition_counts(checked(spark, sf_dir))
    modes = counts.withColumn("on_unknown", F.explode(F.array(F.lit("drop"), F.lit("reject"))))
    merged = F.when(
        (F.col("on_unknown") == "reject") & (F.col("dq_status") == "unknown"), "rejected"
    ).otherwise(F.col("dq_status"))
    return modes.groupBy("on_unknown", merged.alias("dq_status")).agg(F.sum("n").alias("n"))


def quality_metrics_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_metrics(silver(spark, sf_dir), metric_conditions(), DISTINCT_METRICS)


def null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = silver(spark, sf_dir)
    return null_profile(df, [c for c in df.columns if not c.startswith("_")])


def critical_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return critical_count(silver(spark, sf_dir))


def empty_table_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = silver(spark, sf_dir)
    return emptiness(df, "silver").unionByName(
        emptiness(df.filter(F.col("NUM_OF_LOAN") > 60), "out_of_range")
    )


def overflow_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return int_overflow_rows(raw(spark, sf_dir), "NUM_OF_DELAYED_PAYMENT", keep=["ID"])


def overflow_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return int_overflow_counts(raw(spark, sf_dir), CREDIT_SPEC.integers)


def malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return malformed_counts(raw(spark, sf_dir), CREDIT_SPEC)


def sentinels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentinel_counts(raw(spark, sf_dir), CREDIT_SPEC.texts)


def duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_keys(silver(spark, sf_dir), BUSINESS_KEY)


def payment_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return value_profile(silver(spark, sf_dir), "PAYMENT_BEHAVIOUR")


def bronze_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return value_profile(raw(spark, sf_dir), "INTEREST_RATE")


def load_profile_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_profile(raw(spark, sf_dir))


def raw_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = raw(spark, sf_dir)
    return audit(df, audit_conditions(df, CREDIT_SPEC))


def rule_combinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outcome_histogram(silver(spark, sf_dir), credit_rules())


def heavy_raw_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return heavy_values(raw(spark, sf_dir), HEAVY_SHARE)


def merged_load_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summaries of one load per order status, merged, and whether the estimates are near the exact values."""
    orders = read_source(spark, sf_dir, "orders")
    loads = [build_silver(credit_raw(spark, sf_dir, orders.filter(F.col("o_orderstatus") == s))) for s in ("F", "O", "P")]
    columns = [c for c in loads[0].columns if c != "LOAN_TYPES"]
    parts = [load_summary(df, str(i), columns) for i, df in enumerate(loads)]
    merged = merged_summary(reduce(DataFrame.unionByName, parts), (0.5,))
    whole = silver(spark, sf_dir)
    exact = F.coalesce("n", F.lit(0))
    near = F.abs(F.col("distinct_estimate") - exact) <= F.greatest(F.lit(2), exact * 0.04)
    return merged.join(distinct_counts(whole, columns), "column_name", "left").select(
        "column_name", "row_count", "null_count", near.alias("distinct_near"), F.col("quantiles").isNotNull().alias("has_quantiles")
    )


def arrival_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of files by order status against a ledger: two files come again, one of them with fewer rows."""
    orders = read_source(spark, sf_dir, "orders")

    def load(*statuses: str) -> DataFrame:
        part = orders.filter(F.col("o_orderstatus").isin(*statuses))
        named = part.select("*", F.concat(F.col("o_orderstatus"), F.lit(".csv")).alias("_SOURCE_FILE"))
        return digest_files(named)

    expected = ["F.csv", "O.csv", "Z.csv"]
    first = arrival_status(load("F", "P"), spark.createDataFrame([], LEDGER), expected)
    fewer = orders.filter("o_orderstatus = 'P' AND o_totalprice < 100000").withColumn("_SOURCE_FILE", F.lit("P.csv"))
    second = load("F", "O").unionByName(digest_files(fewer))
    entries = arrival_status(second, first, expected)
    numbered = first.withColumn("load", F.lit(1)).unionByName(entries.withColumn("load", F.lit(2)))
    return numbered.select("load", "source_file", "status", "row_count")


# --- composites ------------------------------------------------------------


def silver_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(silver(spark, sf_dir))


def gold_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(build_gold(valid(spark, sf_dir)))


def _two_loads(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, Column]:
    """Closed and pending orders as the stored rows, open ones as their update.

    The third value orders the rows of one key: the lowest ``ID`` wins.
    """
    orders = read_source(spark, sf_dir, "orders")
    lowest_id = -F.col("ID").cast("long")

    def load(statuses: list[str]) -> DataFrame:
        part = orders.filter(F.col("o_orderstatus").isin(*statuses))
        return build_silver(credit_raw(spark, sf_dir, part))

    stored = latest_per_key(load(["F", "P"]), BUSINESS_KEY, lowest_id)
    return stored, load(["O"]), lowest_id


def _listed(df: DataFrame) -> DataFrame:
    return df.withColumn("LOAN_TYPES", F.array_join("LOAN_TYPES", "|"))


def _upsert(method: str | None) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        stored, update, lowest_id = _two_loads(spark, sf_dir)
        return _listed(upsert(stored, update, BUSINESS_KEY, order_by=lowest_id, method=method))

    return query


def upsert_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What open and pending orders would change in the stored ones, of which the pending are."""
    stored, _, lowest_id = _two_loads(spark, sf_dir)
    orders = read_source(spark, sf_dir, "orders").filter(F.col("o_orderstatus").isin("O", "P"))
    update = latest_per_key(build_silver(credit_raw(spark, sf_dir, orders)), BUSINESS_KEY, lowest_id)
    return classify_changes(stored, update, BUSINESS_KEY).select("ID", "CUSTOMER_ID", "MONTH", "change")


def upsert_into_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = _scratch_database(spark)
    stored, update, lowest_id = _two_loads(spark, sf_dir)
    name = f"{database}.silver_customers"
    write_table(stored, name, evolve_schema=False, partition_by=["MONTH"])
    upsert_table(update, name, BUSINESS_KEY, order_by=lowest_id)
    return _listed(read_table(spark, name).select(*stored.columns))


def end_to_end_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole run over all rows, those without an id given one."""
    name = _scratch_database(spark)
    train = credit_raw(spark, sf_dir).withColumn("Customer_ID", F.coalesce("Customer_ID", F.lit(NEW_CUSTOMER)))
    CreditRun(spark, name).run({"train.csv": train, "test.csv": train.drop("Credit_Score")})
    return _shown(read_table(spark, f"{name}.gold_customer_credit"))


def gate_stops_publishing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run over all rows as they are: refused for the missing ids, the rows stored per outcome."""
    name = _scratch_database(spark)
    try:
        CreditRun(spark, name).run({"train.csv": credit_raw(spark, sf_dir)})
        refused = False
    except CriticalDataError:
        refused = True
    published = spark.catalog.tableExists(f"{name}.gold_customer_credit")
    stored = read_table(spark, f"{name}.checked_customers").groupBy("dq_status").agg(F.count("*").alias("n"))
    return stored.select("dq_status", "n", F.lit(refused).alias("refused"), F.lit(published).alias("published"))


REGISTER: dict[str, Query] = {
    "csv_bronze_roundtrip": csv_bronze_roundtrip,
    "csv_split_read": csv_split_read,
    "table_scan": table_scan,
    "full_refresh_idempotent": full_refresh_idempotent,
    "fixed_schema_sink": fixed_schema_sink,
    "sql_point_lookup": sql_point_lookup,
    "source_completeness": source_completeness,
    "audit_columns": audit_columns,
    "normalize_columns": raw,
    "gold_customer": gold_customer,
    "silver_clean": silver_clean,
    "silver_clean_optional_columns": silver_clean_optional_columns,
    "int_overflow_rows": overflow_rows,
    "int_overflow_counts": overflow_counts,
    "point_lookup": point_lookup,
    "bronze_point_lookup": bronze_point_lookup,
    "null_counts": null_counts,
    "in_list_predicate": in_list_predicate,
    "range_null_out": range_null_out,
    "income_group": income_bands,
    "age_group": age_bands,
    "dq_flags": dq_flags,
    "valid_rows": valid_rows,
    "rejected_rows": rejected_rows,
    "rejected_rows_with_unknown": rejected_rows_with_unknown,
    "dq_partition_counts": dq_partition_counts,
    "clean_numeric": clean_numeric_strings,
    "clean_int": _cleaned("integers"),
    "clean_decimal": _cleaned("decimals"),
    "clean_text": _cleaned("texts"),
    "duration_parts": duration_columns,
    "duration_total_months": duration_total_months,
    "month_num": month_numbers,
    "list_parse": list_parse,
    "loan_flags": loan_flags,
    "loan_type_frequency": loan_type_frequency,
    "distinct_loan_types": distinct_loan_types,
    "quality_metrics": quality_metrics_row,
    "value_profile": payment_profile,
    "bronze_value_profile": bronze_profile,
    "load_profile": load_profile_row,
    "limit_rows": limit_rows,
    "critical_rows": critical_rows,
    "empty_table_check": empty_table_check,
    "malformed_counts": malformed,
    "sentinel_counts": sentinels,
    "unknown_loan_types": unknown_loan_types,
    "duplicate_keys": duplicates,
    "upsert_by_key": _upsert(None),
    "upsert_shuffled": _upsert("shuffled"),
    "upsert_into_table": upsert_into_table,
    "upsert_changes": upsert_changes,
    "raw_audit": raw_audit,
    "rule_combinations": rule_combinations,
    "heavy_raw_values": heavy_raw_values,
    "merged_load_summary": merged_load_summary,
    "arrival_ledger": arrival_ledger,
    "silver_customers": silver_customers,
    "end_to_end_run": end_to_end_run,
    "gate_stops_publishing": gate_stops_publishing,
}


def configured(query: Query) -> Query:
    """The query with the session settings applied first."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(configure_session(spark), sf_dir)

    return run

"""All audits of a raw table in one pass, and the combinations of row-rule outcomes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeline.functions import TEXT_SENTINELS
from gradeline.operators.cleaning import CleaningSpec
from gradeline.operators.columns import present
from gradeline.operators.quality import overflows

Audit = tuple[str, str, str | None, Column]


def audit_conditions(df: DataFrame, spec: CleaningSpec, sentinels: Sequence[str] = TEXT_SENTINELS) -> list[Audit]:
    """Rule, column, value and condition of every audit that the columns of the table allow.

    ``null``: no value. ``malformed``: a value that cleans to NULL in a numeric column.
    ``overflow``: a number outside the int range in an integer column. ``sentinel``: a text that
    stands for no value, for each such text.
    """
    cleaners = spec.cleaners()
    audits: list[Audit] = [("null", c, None, F.col(c).isNull()) for c in df.columns]
    for c in present(df, [*spec.integers, *spec.decimals]):
        audits.append(("malformed", c, None, F.col(c).isNotNull() & cleaners[c](F.col(c)).isNull()))
    audits += [("overflow", c, None, overflows(F.col(c))) for c in present(df, spec.integers)]
    audits += [("sentinel", c, s, F.trim(c) == s) for c in present(df, spec.texts) for s in sentinels]
    return audits


def audit(df: DataFrame, audits: Sequence[Audit]) -> DataFrame:
    """``rule, column_name, value, n`` of the audits that any row meets, from one scan.

    All counts are columns of one aggregate, combined in each task, so the shuffle is a row per
    task whatever the data. Nothing is found in an empty table.
    """
    counted = df.agg(*[F.count_if(condition).alias(f"n{i}") for i, (*_, condition) in enumerate(audits)])
    rows = [
        F.struct(F.lit(rule).alias("rule"), F.lit(column).alias("column_name"), F.lit(value).cast("string").alias("value"), F.col(f"n{i}").alias("n"))
        for i, (rule, column, value, _) in enumerate(audits)
    ]
    return counted.select(F.inline(F.array(*rows))).filter(F.col("n") > 0)


def outcome_masks(df: DataFrame, rules: Mapping[str, Column], failed: str = "failed", unknown: str = "unknown") -> DataFrame:
    """With two longs: a bit for each rule that fails, and one for each that is NULL, in rule order.

    A rule that holds has neither bit. There may be 63 rules.
    """
    if len(rules) > 63:
        raise ValueError("a mask holds 63 rules")

    def mask(hits: Sequence[Column]) -> Column:
        bits = [F.when(hit, F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, hit in enumerate(hits)]
        return reduce(add, bits, F.lit(0).cast("long"))

    return df.withColumns({failed: mask([~r for r in rules.values()]), unknown: mask([r.isNull() for r in rules.values()])})


def rule_names(mask: Column, rules: Mapping[str, Column]) -> Column:
    """The names of a mask's rules, joined by commas."""
    named = [F.when(mask.bitwiseAND(F.lit(1 << i)) != 0, F.lit(name)) for i, name in enumerate(rules)]
    return F.concat_ws(",", *named)


def outcome_histogram(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """``failed_rules, unknown_rules, n``: the rows of every combination of outcomes that occurs.

    One pass; each task sends a row per combination, of which there are at most three to the power
    of the rules and in practice a handful. All counts of single rules, of pairs, and of the valid,
    rejected and unknown rows are sums of it.
    """
    counted = outcome_masks(df, rules).groupBy("failed", "unknown").agg(F.count("*").alias("n"))
    return counted.select(rule_names(F.col("failed"), rules).alias("failed_rules"), rule_names(F.col("unknown"), rules).alias("unknown_rules"), "n")

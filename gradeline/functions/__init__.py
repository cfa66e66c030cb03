"""Column expressions: Column in, Column out, no actions."""

from gradeline.functions.bands import age_group, band, income_group
from gradeline.functions.lists import contains_flag, parse_list
from gradeline.functions.names import flag_name, normalize_name
from gradeline.functions.scalars import (
    TEXT_SENTINELS,
    capture_int,
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

__all__ = [
    "TEXT_SENTINELS",
    "age_group",
    "band",
    "capture_int",
    "clean_numeric",
    "clean_text",
    "contains_flag",
    "duration_parts",
    "duration_total",
    "flag_name",
    "income_group",
    "month_num",
    "normalize_name",
    "null_outside",
    "parse_list",
    "to_decimal",
    "to_double",
    "to_int",
]

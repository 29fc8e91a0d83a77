"""Column expressions built from Spark's own functions."""

from tidemark.functions.columns import (
    attribute_hash,
    blank_to_null,
    cents,
    format_timestamp,
    iso_timestamp,
    money,
    parse_flag,
    seconds_between,
)

__all__ = [
    "attribute_hash",
    "blank_to_null",
    "cents",
    "format_timestamp",
    "iso_timestamp",
    "money",
    "parse_flag",
    "seconds_between",
]

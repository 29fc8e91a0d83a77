"""Projection operators."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import blank_to_null


def normalize_columns(df: DataFrame) -> DataFrame:
    """Lower-case, stripped column names with underscores for inner spaces."""
    return df.toDF(*(name.lower().strip().replace(" ", "_") for name in df.columns))


def safe_trim(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Apply ``blank_to_null`` to the listed columns that exist."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: blank_to_null(c) for c in present}) if present else df


def fill_unknown(df: DataFrame, columns: Iterable[str], value: str = "Unknown") -> DataFrame:
    """Replace NULL in the listed columns by a named member."""
    wanted = {c: F.coalesce(F.col(c), F.lit(value)) for c in columns}
    return df.withColumns(wanted) if wanted else df


def add_date_alias(df: DataFrame, aliases: Mapping[str, str]) -> DataFrame:
    """Add date-only copies ``{alias: timestamp column}``.

    Aliases that exist already, or whose source is missing, are left alone.
    """
    missing = {
        alias: F.col(source).cast("date")
        for alias, source in aliases.items()
        if alias not in df.columns and source in df.columns
    }
    return df.withColumns(missing) if missing else df

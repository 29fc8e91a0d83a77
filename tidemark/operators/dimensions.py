"""Static (type 0) dimensions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.keys import assign_keys, max_key


def distinct_values(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Distinct non-null values of several columns in one scan and one shuffle.

    ``columns`` maps a dimension name to its source column; the result has the
    columns ``dimension`` and ``value``. Duplicates are removed on the map side
    before anything moves.
    """
    pairs = [
        F.struct(F.lit(name).alias("dimension"), F.col(source).cast("string").alias("value"))
        for name, source in columns.items()
    ]
    return (
        df.select(F.explode(F.array(*pairs)).alias("pair"))
        .select("pair.dimension", "pair.value")
        .where(F.isnotnull("value"))
        .distinct()
    )


def new_values(source: DataFrame, existing: DataFrame, value_col: str) -> DataFrame:
    """Distinct non-null source values that the dimension does not hold yet."""
    fresh = source.select(value_col).where(F.isnotnull(value_col)).distinct()
    return fresh.join(existing.select(value_col), value_col, "left_anti")


def build_static_dimension(
    source: DataFrame,
    value_col: str,
    key_col: str,
    existing: DataFrame | None = None,
) -> DataFrame:
    """Dimension of the distinct values; known values keep their keys.

    New values are numbered after the greatest key in use, in value order.
    """
    if existing is None:
        fresh = source.select(value_col).where(F.isnotnull(value_col)).distinct()
        return assign_keys(fresh, key_col, [value_col])
    known = existing.select(key_col, value_col)
    added = assign_keys(
        new_values(source, known, value_col), key_col, [value_col], max_key(known, key_col)
    )
    return known.unionByName(added)


def build_static_dimensions(
    values: DataFrame, names: Mapping[str, tuple[str, str]]
) -> dict[str, DataFrame]:
    """First load of several dimensions from one ``distinct_values`` frame.

    ``names`` maps a dimension to its ``(key column, value column)``. All members
    are numbered together, ordered by dimension and value; subtracting the number
    before a dimension's first member restarts every dimension at 1.
    """
    numbered = assign_keys(values, "_number", ["dimension", "value"])
    first = {
        row["dimension"]: row["first"]
        for row in numbered.groupBy("dimension").agg(F.min("_number").alias("first")).collect()
    }
    return {
        name: numbered.where(F.col("dimension") == name).select(
            (F.col("_number") - F.lit(first.get(name, 1) - 1)).cast("bigint").alias(key_col),
            F.col("value").alias(value_col),
        )
        for name, (key_col, value_col) in names.items()
    }

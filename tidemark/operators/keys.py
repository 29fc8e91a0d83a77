"""Surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.staging import stage

# monotonically_increasing_id keeps the row's place within its partition here.
_LOCAL_BITS = (1 << 33) - 1


def max_key(df: DataFrame, key: str) -> int:
    """Greatest surrogate key in a table, 0 when it has none."""
    return df.agg(F.max(key)).first()[0] or 0


def place_by_range(df: DataFrame, order: Sequence[str], label: str) -> DataFrame:
    """Written copy of ``df`` in global ``order``: ``_part`` then ``_place`` within it.

    Rows are spread by range of ``order``, so a single hot leading value still
    spreads over many partitions as long as the full ``order`` identifies a row.
    """
    by = [F.col(c).asc_nulls_first() for c in order]
    return stage(
        df.repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .withColumns(
            {
                "_part": F.spark_partition_id(),
                "_place": F.monotonically_increasing_id().bitwiseAND(_LOCAL_BITS),
            }
        ),
        label,
    )


def with_row_id(df: DataFrame, label: str) -> DataFrame:
    """Written copy of ``df`` with ``_row``, a number that identifies each row and stays."""
    return stage(df.withColumn("_row", F.monotonically_increasing_id()), label)


def number_rows(rows: DataFrame, key: str, order: Sequence[str], start_at: int = 0) -> DataFrame:
    """Rows ``_row, <key>``: the place of every row in ``order``, from ``start_at + 1`` on.

    Takes the order columns and ``_row`` along and nothing else.
    """
    return assign_keys(rows.select("_row", *order), key, order, start_at).select("_row", key)


def assign_keys(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    start_at: int = 0,
) -> DataFrame:
    """Add a dense BIGINT key ``start_at + 1, start_at + 2, …`` in ``order``.

    ``order`` has to identify a row. The numbering equals ``row_number()`` over the
    whole table but needs no single task. The rows move a single time, by range, and are written once, in
    order. Each range partition numbers its own rows, and a table of partition sizes, one row each, turns
    local numbers into global ones.
    """
    placed = place_by_range(df, order, f"rows-{key}")
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_size"))
    before = sizes.select("_part", (F.sum("_size").over(Window.orderBy("_part")) - F.col("_size")).alias("_before"))
    before = stage(before, f"offsets-{key}")
    number = F.col("_place") + F.col("_before") + start_at + 1
    return placed.join(before, "_part").select(number.alias(key), *df.columns)

"""Dimension lookup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach_dimension_key(
    df: DataFrame,
    source_col: str,
    dimension: DataFrame,
    value_col: str,
    key_col: str,
    output_col: str | None = None,
) -> DataFrame:
    """Add the key of the dimension member equal to ``source_col``.

    NULL and unknown values get a NULL key. There is no broadcast hint: dimensions
    are read from written tables, so Spark knows their size and broadcasts the two
    columns used here when they fit under ``spark.sql.autoBroadcastJoinThreshold``.
    A dimension that has outgrown it is joined by shuffle, where adaptive execution
    splits hot values.
    """
    probe = f"_value_of_{output_col or key_col}"
    member = dimension.select(
        F.col(value_col).alias(probe),
        F.col(key_col).alias(output_col or key_col),
    )
    return df.join(member, F.col(source_col) == F.col(probe), "left").drop(probe)


def attach_dimension(
    df: DataFrame, dim: DataFrame, key: str, hot: Sequence[object] = (), parts: int = 64
) -> DataFrame:
    """Left join of a dimension that is unique in ``key``, its other columns behind those of ``df``.

    Where the dimension is too large to broadcast, rows meet it by key: those without a key, and those of
    the ``hot`` keys the caller names, would fill one task each. They are spread over ``parts`` places by a hash
    of the row instead, with a copy of the dimension row at each place for a hot key. NULL matches nothing,
    wherever it is.
    """
    named = F.col(key).isin(*hot) if hot else F.lit(False)
    place = F.pmod(F.xxhash64(*df.columns), F.lit(parts))
    placed = df.withColumn("_place", F.when(F.isnull(key) | named, place).otherwise(0))
    # Always 0. A literal would be folded into the join condition, and rows dealt by key alone again.
    only = F.pmod(F.xxhash64(key), F.lit(1))
    copies = F.when(named, F.sequence(F.lit(0), F.lit(parts - 1))).otherwise(F.array(F.lit(0))).cast("array<long>")
    right = dim.withColumn("_place", F.explode(copies) if hot else only)
    joined = placed.join(right, [key, "_place"], "left")
    return joined.select(*df.columns, *(c for c in dim.columns if c != key))

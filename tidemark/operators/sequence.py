"""Next row within a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.keys import place_by_range
from tidemark.operators.staging import stage


def next_in_group(
    df: DataFrame, group: str, order: Sequence[str], value: str, output: str
) -> DataFrame:
    """Add ``value`` of the next row of the same group, NULL on the last one.

    ``order`` has to identify a row within its group. Rows are spread by range of group and order, so a
    group may be of any size: each task looks at its own neighbours, and the last row of a
    partition gets the first row of the next one, from a table with one row per partition.
    """
    placed = place_by_range(df, [group, *order], f"next-{group}")
    pair = F.struct(F.col(group).alias("g"), F.col(value).alias("v"))
    inside = Window.partitionBy("_part").orderBy("_place")
    following = placed.where("_place = 0").select(
        "_part", F.lead(pair).over(Window.orderBy("_part")).alias("_after")
    )
    following = stage(following, f"following-{group}")
    reached = placed.withColumn("_next", F.lead(pair).over(inside)).join(following, "_part", "left")
    following_row = F.coalesce("_next", "_after")
    return reached.withColumn(
        output, F.when(following_row["g"].eqNullSafe(F.col(group)), following_row["v"])
    ).select(*df.columns, output)

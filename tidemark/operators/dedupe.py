"""Keep the latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedupe_latest(
    df: DataFrame,
    keys: Sequence[str],
    priority: Sequence[str] = ("ingestion_timestamp",),
) -> DataFrame:
    """One row per key: the greatest by ``priority``, NULL counting as oldest.

    Remaining ties are broken by all other columns, so the winner does not depend
    on how the rows were partitioned. Spark limits every group to one row before
    the shuffle as well (``WindowGroupLimit``), so a key that owns a large share of
    the rows reaches the final task as one row per map task.
    """
    first = [c for c in priority if c in df.columns]
    rest = [c for c in df.columns if c not in first and c not in keys]
    order = ", ".join(f"`{c}` DESC NULLS LAST" for c in (*first, *rest))
    if not order:
        return df.dropDuplicates(list(keys))
    group = ", ".join(f"`{k}`" for k in keys)
    place = F.expr(f"row_number() OVER (PARTITION BY {group} ORDER BY {order})")
    return df.withColumn("_place", place).where("_place = 1").drop("_place")

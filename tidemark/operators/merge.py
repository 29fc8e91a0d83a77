"""Keyed upserts that need no table format.

They follow SQL ``MERGE``: keys match by ordinary equality, so a NULL in a key
never matches.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.keys import max_key, number_rows, with_row_id
from tidemark.operators.staging import stage


def require_unique_matches(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> None:
    """Raise when two source rows would update the same target row."""
    keys = list(keys)
    repeated = source.groupBy(*keys).count().where("count > 1").select(*keys)
    clash = repeated.join(target.select(*keys), keys, "left_semi").take(1)
    if clash:
        raise ValueError(f"several source rows match one target row, e.g. {clash[0].asDict()}")


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    check_unique: bool = True,
    retract: DataFrame | None = None,
    sent: DataFrame | None = None,
) -> DataFrame:
    """Update matched rows, insert the others, keep the rest of the target.

    Columns may differ: new source columns are added, and a column the source lacks
    keeps the target's value on matched rows. ``retract`` names what was taken anew as a whole: rows of the
    target that equal one of its rows in all of its columns, and whose key the source lacks, go. ``sent`` may
    have the source's keys, where they are cheaper to read.
    """
    keys = list(keys)
    if check_unique:
        require_unique_matches(target, source, keys)
    replaced = set(target.columns) <= set(source.columns)
    if retract is not None and not replaced:
        target = target.join(retracted(target, source, keys, retract), keys, "left_anti")

    if replaced:
        # A small source is broadcast for the anti join: the target does not move.
        kept = target
        if retract is not None and sorted(retract.columns) == sorted(keys):
            # Rows of these keys are replaced or go.
            kept = kept.join(retract, keys, "left_anti")
        kept = kept.join((source if sent is None else sent).select(*keys), keys, "left_anti")
        if retract is not None and sorted(retract.columns) != sorted(keys):
            # The source lacks the keys of what is left, so whatever is in the scope goes.
            kept = _outside(kept, retract, keys)
        merged = kept.unionByName(source, allowMissingColumns=True)
    else:
        held = target.select(*keys, F.struct(*target.columns).alias("_held"))
        sent = source.select(*keys, F.struct(*source.columns).alias("_sent"))
        both = held.join(sent, keys, "full_outer")
        columns = []
        for c in _union_columns(target, source):
            if c in keys:
                columns.append(F.col(c))
            elif c not in source.columns:
                columns.append(F.col(f"_held.{c}").alias(c))
            elif c not in target.columns:
                columns.append(F.col(f"_sent.{c}").alias(c))
            else:
                sent_value, held_value = F.col(f"_sent.{c}"), F.col(f"_held.{c}")
                columns.append(
                    F.when(F.isnotnull("_sent"), sent_value).otherwise(held_value).alias(c)
                )
        merged = both.select(*columns)
    return merged.select(*_union_columns(target, source))


def retracted(target: DataFrame, source: DataFrame, keys: Sequence[str], scope: DataFrame) -> DataFrame:
    """Keys of target rows within ``scope`` that the source does not bring again.

    Scope and source hold what a delivery touched; the target is reduced to the scope first.
    """
    keys = list(keys)
    within = target.join(scope.distinct(), list(scope.columns), "left_semi").select(*keys)
    return within.join(source.select(*keys), keys, "left_anti").distinct()


def _outside(target: DataFrame, scope: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows that equal no row of ``scope`` in its columns, or lack a part of their key."""
    taken = scope.select(*(F.col(c).alias(f"_scope_{c}") for c in scope.columns))
    same = [F.col(c) == F.col(f"_scope_{c}") for c in scope.columns]
    return target.join(taken, reduce(Column.__and__, same + [F.isnotnull(k) for k in keys]), "left_anti")


def _union_columns(target: DataFrame, source: DataFrame) -> list[str]:
    return [*target.columns, *(c for c in source.columns if c not in target.columns)]


def resolve_surrogates(
    incoming: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    surrogate: str,
    check_unique: bool = False,
) -> DataFrame:
    """Give incoming rows the target's surrogate keys, and new ones after its maximum.

    Both tables are matched on their key columns alone: the target's are reduced to the incoming ones,
    and new keys are numbered in key order. Incoming rows are written once and move once, to meet
    their number. ``check_unique`` raises when two of them match one target row.
    """
    return resolve_and_keys(incoming, target, keys, surrogate, check_unique)[0]


def resolve_and_keys(
    incoming: DataFrame, target: DataFrame, keys: Sequence[str], surrogate: str, check_unique: bool = False
) -> tuple[DataFrame, DataFrame]:
    """``resolve_surrogates``, and the keys of the rows, which need not meet the numbers."""
    keys = list(keys)
    rows = incoming.drop(surrogate)
    staged = with_row_id(rows, f"incoming-{surrogate}")
    if check_unique:
        require_unique_matches(target, staged, keys)
    sent = staged.select("_row", *keys)
    known = (
        target.select(*keys, F.col(surrogate).alias("_known"))
        .join(sent.select(*keys), keys, "left_semi")
        .groupBy(*keys)
        .agg(F.min("_known").alias("_known"))
    )
    resolved = stage(sent.join(known, keys, "left"), f"resolved-{surrogate}")
    old = resolved.where(F.isnotnull("_known")).select("_row", F.col("_known").alias(surrogate))
    new = number_rows(
        resolved.where(F.isnull("_known")), surrogate, keys, max_key(target, surrogate)
    )
    return staged.join(old.unionByName(new), "_row").select(surrogate, *rows.columns), sent.select(*keys)


def merge_preserving_keys(
    target: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    surrogate: str,
    retract: DataFrame | None = None,
    check_unique: bool = True,
) -> DataFrame:
    """``merge_upsert`` in which known business keys keep their surrogate key."""
    resolved, sent = resolve_and_keys(incoming, target, keys, surrogate, check_unique)
    return merge_upsert(target, resolved, keys, check_unique=False, retract=retract, sent=sent)

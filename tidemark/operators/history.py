"""Slowly changing dimensions, type 2."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import format_timestamp
from tidemark.operators.dedupe import dedupe_latest
from tidemark.operators.keys import assign_keys, max_key
from tidemark.operators.staging import stage

HISTORY_COLUMNS = ("effective_from", "effective_to", "is_current")


def current_rows(dimension: DataFrame) -> DataFrame:
    """The version of every natural key that is in force."""
    return dimension.where("is_current")


def _stamp(process_ts: str) -> Column:
    return format_timestamp(F.lit(process_ts).cast("timestamp_ntz"))


def _opened(df: DataFrame, process_ts: str) -> DataFrame:
    return df.withColumns(
        {
            "effective_from": _stamp(process_ts),
            "effective_to": F.lit(None).cast("string"),
            "is_current": F.lit(True),
        }
    )


def detect_changes(
    source: DataFrame, current: DataFrame, natural_key: str, attributes: Sequence[str]
) -> DataFrame:
    """Compare a snapshot with the current versions in one full outer join.

    Result: the natural key, ``change`` (new, changed, unchanged, vanished) and the
    two sides as structs ``incoming`` and ``held``. Attributes are compared
    null-safely and field by field, so no text can be mistaken for another.
    """
    incoming = source.select(natural_key, F.struct(*attributes).alias("incoming"))
    held = current.select(natural_key, F.struct(*current.columns).alias("held"))
    held_attributes = F.struct(*[F.col(f"held.{a}").alias(a) for a in attributes])
    return incoming.join(held, natural_key, "full_outer").withColumn(
        "change",
        F.when(F.isnull("held"), "new")
        .when(F.isnull("incoming"), "vanished")
        .when(F.col("incoming").eqNullSafe(held_attributes), "unchanged")
        .otherwise("changed"),
    )


def build_scd2_dimension(
    source: DataFrame,
    natural_key: str,
    surrogate_key: str,
    attributes: Sequence[str],
    process_ts: str,
    existing: DataFrame | None = None,
    later: DataFrame | None = None,
) -> DataFrame:
    """Apply a snapshot to a history table.

    New keys open a version, changed keys close the current one and open the next,
    unchanged keys and keys missing from the snapshot stay as they are. New versions
    are numbered after the greatest surrogate key in use, in natural-key order.

    A snapshot whose stamp is not the newest is put in its place: it splits the version in force then.
    ``later`` (natural key, ``seen``: stamp text) tells which keys the snapshots after it held; a
    version ends where its key was next seen as something else. Applied in any order,
    snapshots end in the same versions. The same stamp again corrects what it said before; keys it lacks stay.
    """
    columns = [surrogate_key, natural_key, *attributes, *HISTORY_COLUMNS]
    snapshot = dedupe_latest(source.select(natural_key, *attributes), [natural_key], attributes)

    if existing is None:
        keyed = assign_keys(snapshot, surrogate_key, [natural_key])
        return _opened(keyed, process_ts).select(*columns)

    change = history_change(source, natural_key, surrogate_key, attributes, process_ts, existing, later)
    kept = existing.select(*columns).join(change.gone, surrogate_key, "left_anti")
    return kept.select(*columns).unionByName(change.rows)


@dataclass(frozen=True)
class HistoryChange:
    """What a snapshot does to a history: numbers of versions that go, and the versions that come.

    A version that is closed goes, and comes back with its end under the same number.
    """

    gone: DataFrame
    rows: DataFrame


def history_change(
    source: DataFrame,
    natural_key: str,
    surrogate_key: str,
    attributes: Sequence[str],
    process_ts: str,
    existing: DataFrame,
    later: DataFrame | None = None,
) -> HistoryChange:
    """The part of :func:`build_scd2_dimension` that is not as it was; its size follows the changes."""
    columns = [surrogate_key, natural_key, *attributes, *HISTORY_COLUMNS]
    snapshot = dedupe_latest(source.select(natural_key, *attributes), [natural_key], attributes)
    existing = existing.select(*columns)
    newest = existing.agg((F.max("effective_from") >= _stamp(process_ts)).alias("late")).first()["late"]
    if newest or later is not None:
        return _inserted(snapshot, natural_key, surrogate_key, attributes, process_ts, existing, later)
    held = current_rows(existing).select(natural_key, F.struct(*columns).alias("held"))
    known = F.struct(*(F.col(f"held.{a}").alias(a) for a in attributes))
    moved = stage(
        snapshot.select(natural_key, F.struct(*attributes).alias("is"))
        .join(held, natural_key, "left")
        .where(F.isnull("held") | ~F.col("is").eqNullSafe(known)),
        f"moved-{surrogate_key}",
    )
    closed = moved.where(F.isnotnull("held")).select("held.*").withColumns(
        {"effective_to": _stamp(process_ts), "is_current": F.lit(False)}
    )
    versions = moved.select(natural_key, *(F.col(f"is.{a}").alias(a) for a in attributes))
    opened = _opened(
        assign_keys(versions, surrogate_key, [natural_key], max_key(existing, surrogate_key)), process_ts
    )
    return HistoryChange(closed.select(surrogate_key), closed.select(*columns).unionByName(opened.select(*columns)))


def _inserted(
    snapshot: DataFrame,
    natural_key: str,
    surrogate_key: str,
    attributes: Sequence[str],
    process_ts: str,
    existing: DataFrame,
    later: DataFrame | None,
) -> HistoryChange:
    """What changes when a snapshot is put between the versions of a history.

    Versions of the keys concerned are turned back into observations (what was seen, and when), the snapshot
    joins them, and so does the next sighting of each key; equal neighbours are one version again. Keys that
    the snapshot sees as history has them are not touched.
    """
    columns = existing.columns
    at = _stamp(process_ts)

    def in_force(stamp: Column) -> Column:
        return (F.col("effective_from") <= stamp) & (F.isnull("effective_to") | (F.col("effective_to") > stamp))

    held = existing.where(in_force(at)).select(natural_key, F.struct(*attributes).alias("held"))
    seen = snapshot.select(natural_key, F.struct(*attributes).alias("is"))
    moved = seen.join(held, natural_key, "left").where(F.isnull("held") | ~F.col("held").eqNullSafe(F.col("is")))
    moved = stage(moved.select(natural_key, "is"), f"moved-{surrogate_key}")

    versions = existing.join(moved.select(natural_key), natural_key, "left_semi")
    known = versions.select(natural_key, F.col("effective_from").alias("seen"), F.struct(*attributes).alias("is"), surrogate_key)
    here = known.where(F.col("seen") == at).select(natural_key, surrogate_key)
    # Under its own stamp the snapshot takes the place, and the number, of what was there.
    observed = known.where(F.col("seen") != at).unionByName(
        moved.withColumn("seen", at).join(here, natural_key, "left")
    )
    if later is not None:
        following = later.where(F.col("seen") > at).join(moved.select(natural_key), natural_key, "left_semi")
        following = following.groupBy(natural_key).agg(F.min("seen").alias("seen"))
        # What the key was then: the version in force. One that begins there is known already.
        confirmed = versions.join(following, natural_key).where(
            in_force(F.col("seen")) & (F.col("effective_from") != F.col("seen"))
        )
        observed = observed.unionByName(
            confirmed.select(
                natural_key, "seen", F.struct(*attributes).alias("is"), F.lit(None).cast("long").alias(surrogate_key)
            )
        )
    by_time = Window.partitionBy(natural_key).orderBy("seen")
    first = F.row_number().over(by_time) == 1
    marked = observed.withColumn("begins", first | ~F.lag("is").over(by_time).eqNullSafe(F.col("is")))
    runs = (
        marked.withColumn("run", F.sum(F.col("begins").cast("int")).over(by_time))
        .groupBy(natural_key, "run")
        .agg(
            F.min("seen").alias("effective_from"),
            F.any_value("is").alias("is"),
            # A number in use stays in use: the oldest one of the run.
            F.min_by(surrogate_key, F.when(F.isnotnull(surrogate_key), F.col("seen"))).alias(surrogate_key),
        )
    )
    ends = F.lead("effective_from").over(Window.partitionBy(natural_key).orderBy("effective_from"))
    rebuilt = stage(
        runs.withColumns({"effective_to": ends, "is_current": ends.isNull()}).select(
            surrogate_key, natural_key, *(F.col(f"is.{a}").alias(a) for a in attributes), *HISTORY_COLUMNS
        ),
        f"rebuilt-{surrogate_key}",
    )
    numbered = assign_keys(
        rebuilt.where(F.isnull(surrogate_key)).drop(surrogate_key),
        surrogate_key,
        [natural_key, "effective_from"],
        max_key(existing, surrogate_key),
    )
    return HistoryChange(
        versions.select(surrogate_key),
        rebuilt.where(F.isnotnull(surrogate_key)).select(*columns).unionByName(numbered.select(*columns)),
    )

"""Incremental loading by a batch high-water mark.

Silver rows carry the ``processed_date`` of the run that wrote them. A Gold run
picks up what is newer than the stored mark. Fact builders here widen the delta to
every business object it touches, so that an incremental load ends in the same
rows as a full one.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.columns import add_date_alias
from tidemark.operators.merge import merge_upsert
from tidemark.operators.rules import valid_rows
from tidemark.operators.staging import stage
from tidemark.plans import facts
from tidemark.sources.datasets import dataset

# --- fixed values: the high-water mark table ----------------------------------
PIPELINE_NAME = "gold_star_schema"
WATERMARK_SCHEMA = "pipeline_name string, last_process_date date, updated_at timestamp"
# ----------------------------------------------------------------------------


def read_on(silver: DataFrame, process_date: str | None = None) -> DataFrame:
    """Silver rows of one processing date, or all of them."""
    if process_date is None or "processed_date" not in silver.columns:
        return silver
    return silver.where(F.col("processed_date") == F.lit(process_date).cast("date"))


def newer_than(watermark: str | None) -> Column:
    """Newer than the mark; without a mark, everything is."""
    if watermark is None:
        return F.lit(True)
    return F.col("processed_date") > F.lit(watermark).cast("date")


def read_since(silver: DataFrame, watermark: str | None) -> DataFrame:
    """Silver rows newer than the mark; a table without processing dates has none."""
    if "processed_date" not in silver.columns:
        return silver.limit(0)
    return silver.where(newer_than(watermark))


def with_date(silver: DataFrame, name: str) -> DataFrame:
    """Add the date alias of a data set's event time."""
    spec = dataset(name)
    return add_date_alias(silver, {spec.date_alias: spec.event_time}) if spec.date_alias else silver


def usable(silver: DataFrame, name: str) -> DataFrame:
    """Valid rows with their date alias: the input of the fact builders."""
    return valid_rows(with_date(silver, name))


# --- high-water mark ----------------------------------------------------------


def latest_process_date(tables: Iterable[DataFrame]) -> DataFrame:
    """Newest ``processed_date`` over several Silver tables, in one job."""
    newest = [
        t.agg(F.max("processed_date").alias("latest"))
        for t in tables
        if "processed_date" in t.columns
    ]
    return reduce(DataFrame.unionByName, newest).agg(F.max("latest").alias("latest_process_date"))


def read_watermark(table: DataFrame, pipeline: str = PIPELINE_NAME) -> DataFrame:
    """The mark of one pipeline as a one-row frame, NULL when there is none."""
    return table.where(F.col("pipeline_name") == pipeline).agg(
        F.max("last_process_date").alias("last_process_date")
    )


def upsert_watermark(table: DataFrame, marks: DataFrame) -> DataFrame:
    """Replace the marks of the named pipelines."""
    return merge_upsert(table, marks, ["pipeline_name"])


@dataclass(frozen=True)
class BuildState:
    """What a Gold table needs: a full load, an increment, or nothing.

    ``since`` is the oldest mark of its sources, ``marks`` has the mark of each.
    """

    full: bool = False
    skip: bool = False
    since: str | None = None
    marks: Mapping[str, str | None] = field(default_factory=dict)


def resolve_build_state(has_data: bool, latest: str | None, watermark: str | None) -> BuildState:
    """Decide from the table's state, the newest Silver date and the stored mark."""
    if not has_data:
        return BuildState(full=True)
    if latest is None:
        return BuildState(skip=True)
    if watermark is None:
        return BuildState(full=True)
    if latest <= watermark:
        return BuildState(skip=True)
    return BuildState(since=watermark)


def resolve_by_source(
    has_data: bool, latest: Mapping[str, str | None], marks: Mapping[str, str | None]
) -> BuildState:
    """``resolve_build_state`` for a table with several sources, each with a mark of its own.

    A source is new beyond its own mark only, so one that comes a run late is not hidden by the others. One
    without a mark has not been used yet: all of it is new, once the table has any mark at all.
    """
    if not has_data:
        return BuildState(full=True)
    if not any(latest.values()):
        return BuildState(skip=True)
    if not any(marks.values()):
        return BuildState(full=True)
    if not any(day and day > (marks[name] or "") for name, day in latest.items()):
        return BuildState(skip=True)
    return BuildState(since=min(filter(None, marks.values())), marks=dict(marks))


# --- facts from what changed --------------------------------------------------
#
# These take all Silver rows of a data set, invalid ones included, with their date alias: a correction
# that makes a row invalid touches its object as well. ``marks`` has the mark of every data set they read.

Marks = Mapping[str, str | None]


@dataclass(frozen=True)
class Delta:
    """Fact rows taken anew, and the ``scope`` they cover.

    The scope holds values of fact columns. Stored rows that match it and do not come again have lost
    their ground - the object is invalid now, or has moved - and are deleted.
    """

    rows: DataFrame
    scope: DataFrame


def _ids(key: str, *frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.union, [f.select(key) for f in frames]).distinct()


# Silver columns that a fact and its dimensions take, snapshots aside: key, what is passed on, what tells valid and new rows.
_CHECK = ("validation_errors", "processed_date")
_MEMBERS = ("country", "source", "device")
READS: Mapping[str, Mapping[str, tuple[str, ...]]] = {
    "fact_order": {
        "orders": (
            "order_id",
            "customer_id",
            "order_time",
            "payment_method",
            "discount_pct",
            "subtotal_usd",
            "computed_total",
            *_MEMBERS,
            *_CHECK,
        ),
        "order_items": ("order_id", "product_id", "quantity", *_CHECK),
        "sessions": ("session_id", *_MEMBERS),
    },
    "fact_order_item": {
        "orders": ("order_id", "customer_id", "order_time", *_CHECK),
        "order_items": ("order_id", "product_id", "quantity", "unit_price_usd", "computed_line_total", *_CHECK),
    },
    "fact_web_event": {
        "events": ("event_id", "session_id", "timestamp", "event_type", "product_id", *_CHECK),
        "sessions": ("session_id", "customer_id", *_CHECK),
    },
    "fact_review": {
        "reviews": ("review_id", "order_id", "product_id", "rating", "review_text", "review_time", *_CHECK),
    },
    "fact_session": {"sessions": ("session_id", "customer_id", "start_time", *_MEMBERS, *_CHECK)},
}


def fact_order_since(
    orders: DataFrame, order_items: DataFrame, dims: facts.Dims, marks: Marks
) -> Delta:
    """Orders that are new or changed, or whose items are."""
    # Orders, items and scope read them.
    touched = stage(
        _ids("order_id", read_since(orders, marks["orders"]), read_since(order_items, marks["order_items"])),
        "touched-orders",
    )
    rows = facts.fact_order(
        valid_rows(orders).join(touched, "order_id", "left_semi"),
        valid_rows(order_items).join(touched, "order_id", "left_semi"),
        dims,
    )
    return Delta(rows, touched)


# What item facts take from Silver, and what tells valid rows.
ITEM_COLUMNS = (
    "order_id",
    "product_id",
    "quantity",
    "unit_price_usd",
    "computed_line_total",
    "validation_errors",
)


def fact_order_item_since(
    orders: DataFrame, order_items: DataFrame, dims: facts.Dims, marks: Marks
) -> Delta:
    """Items that are new or changed, or whose order is."""
    changed = _ids("order_id", read_since(orders, marks["orders"]))
    newer = F.coalesce(newer_than(marks["order_items"]), F.lit(False))
    # New items need not meet the orders, and of the others only those of changed orders go on. Rows and scope read them.
    items = order_items.select(*ITEM_COLUMNS, newer.alias("_newer"))
    touched = stage(
        items.where("_newer").unionByName(items.where("not _newer").join(changed, "order_id", "left_semi")).drop("_newer"),
        "touched-items",
    )
    rows = facts.fact_order_item(valid_rows(orders), valid_rows(touched), dims)
    return Delta(rows, touched.select("order_id", "product_id"))


def fact_web_event_since(
    events: DataFrame, sessions: DataFrame, dims: facts.Dims, marks: Marks, held: DataFrame
) -> Delta:
    """All events of sessions that changed, got events, or lost some.

    A new event also ends the dwell time of the event before it, so the sessions are
    taken whole. The stored fact ``held`` tells which session an event was in before.
    """
    arrived = read_since(events, marks["events"])
    left = held.join(arrived.select("event_id"), "event_id", "left_semi")
    # Events, which are spread by range and so read twice, and scope read them.
    touched = stage(
        _ids("session_id", arrived, read_since(sessions, marks["sessions"]), left), "touched-sessions"
    )
    rows = facts.fact_web_event(
        valid_rows(events).join(touched, "session_id", "left_semi"), valid_rows(sessions), dims
    )
    return Delta(rows, touched)


def fact_review_since(reviews: DataFrame, dims: facts.Dims, marks: Marks) -> Delta:
    """New or changed reviews."""
    arrived = read_since(reviews, marks["reviews"])
    return Delta(facts.fact_review(valid_rows(arrived), dims), arrived.select("review_id"))


def fact_session_since(sessions: DataFrame, dims: facts.Dims, marks: Marks) -> Delta:
    """New or changed sessions."""
    arrived = read_since(sessions, marks["sessions"])
    return Delta(facts.fact_session(valid_rows(arrived), dims), arrived.select("session_id"))

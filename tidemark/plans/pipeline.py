"""The whole flow over stored tables: Bronze, Silver, Gold, high-water mark."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import date
from functools import reduce
from threading import Lock

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import format_timestamp
from tidemark.operators.history import build_scd2_dimension, history_change
from tidemark.operators.merge import merge_upsert, resolve_and_keys
from tidemark.operators.staging import stage, staging_run, staging_step
from tidemark.plans import bronze, dims, facts, incremental, silver
from tidemark.plans.incremental import PIPELINE_NAME, WATERMARK_SCHEMA, BuildState
from tidemark.sources.datasets import DATASETS, dataset
from tidemark.sources.files import SCAN_COLUMNS, check_date, scan_csv, unreadable_values
from tidemark.sources.tables import Lakehouse

WATERMARK = "pipeline_watermark"
STATIC = tuple(dims.STATIC_DIMENSIONS)
DIMENSIONS = ("dim_date", *STATIC, "dim_customer", "dim_product")
GOLD_TABLES = (*DIMENSIONS, *facts.FACTS)
# A mark per data set, and the snapshots that histories have taken up.
SOURCE_MARKS = "source_watermarks"
HISTORY_RUNS = "history_runs"
HISTORIES = {"dim_customer": "customers", "dim_product": "products"}

# Data sets that every Gold table is built from.
SOURCES: dict[str, tuple[str, ...]] = {
    "dim_date": tuple(DATASETS),
    **{name: (spec[0],) for name, spec in dims.STATIC_DIMENSIONS.items()},
    **{name: (source,) for name, source in HISTORIES.items()},
    "fact_order": ("orders", "order_items"),
    "fact_order_item": ("orders", "order_items"),
    "fact_web_event": ("events", "sessions"),
    "fact_review": ("reviews",),
    "fact_session": ("sessions",),
    "fact_customer_funnel": ("events", "sessions", "orders", "order_items", "customers", "products"),
}

# Facts that have a day are stored by day: a merge then rewrites few partitions.
FACT_PARTITION = "date_key"


def ingest_to_bronze(
    lake: Lakehouse,
    ingest_date: str,
    name: str,
    source: DataFrame,
    ingested_at: Column | None = None,
) -> None:
    """Store one delivery of a data set as the Bronze partition of its date."""
    check_date(ingest_date)
    dataset(name)
    rows = bronze.to_bronze(source, name, ingest_date, ingested_at)
    lake.replace_partition(rows, "bronze", name, "ingest_date", ingest_date)


def ingest_csv(
    lake: Lakehouse,
    ingest_date: str,
    folder: str,
    file_name: str,
    name: str | None = None,
    most_unreadable: float | None = None,
    by_position: bool = False,
) -> int:
    """``ingest_to_bronze`` from a CSV file named after its data set; returns the number of unreadable records.

    Values that do not fit their type are NULL in Bronze, and kept as written in the quarantine table
    ``<name>_unreadable`` (file, row, column, value), by ingest date; a file delivered again replaces its
    entries. If the share of such records exceeds ``most_unreadable``, nothing is stored and the error names the
    first ones.
    """
    check_date(ingest_date)
    name = name or file_name.removesuffix(".csv")
    # Parsed once; the checks and the write read the typed copy.
    scan = stage(scan_csv(lake.spark, folder, file_name, name, by_position), f"scan-{name}")
    rows, bad = scan.agg(F.count("*"), F.count(F.when(F.size("unreadable") > 0, 1))).first()
    odd = unreadable_values(scan)
    if most_unreadable is not None and bad > most_unreadable * rows:
        first = "; ".join(
            f"row {r['row']}, {r['column'] or 'record'}: {r['value']!r}"
            for r in odd.orderBy("source_file", "row", "column").limit(3).collect()
        )
        raise ValueError(f"{bad} of {rows} records of {file_name} cannot be read, more than {most_unreadable:.2%}: {first}")
    quarantine = f"{name}_unreadable"
    if bad or lake.location("bronze", quarantine):
        lake.replace_partition(odd, "bronze", quarantine, "ingest_date", ingest_date)
    ingest_to_bronze(lake, ingest_date, name, scan.drop(*SCAN_COLUMNS))
    return bad


def read_bronze(lake: Lakehouse, name: str, ingest_date: str | None = None) -> DataFrame:
    """A Bronze table, or one ingest date of it (partition pruning)."""
    df = lake.read("bronze", name)
    if ingest_date is None:
        return df
    return df.where(F.col("ingest_date") == F.lit(ingest_date).cast("date"))


def clean_silver(lake: Lakehouse, process_date: str, name: str) -> None:
    """Clean one Bronze delivery into its Silver table.

    Snapshots replace the table; one that was never delivered is refused, since it would
    empty the table, and one older than the table's leaves it as it is (histories read it from
    Bronze). Others are upserted into a table partitioned by processing date, so
    that an incremental read prunes to the new partitions. Cleaning a day again replaces
    that day's rows, and an older day changes no row that a newer one wrote.
    """
    spec = dataset(name)
    if spec.snapshot and process_date not in (lake.partition_values("bronze", name, "ingest_date") or ()):
        raise RuntimeError(f"no delivery of {name} on {process_date}")
    rows = silver.to_silver(
        read_bronze(lake, name, check_date(process_date)), name, process_date
    )
    if spec.snapshot:
        held = latest_silver_dates(lake, [name])[name]
        if held is None or held <= process_date:
            lake.overwrite(rows, "silver", name)
    else:
        lake.merge(
            rows,
            "silver",
            name,
            spec.keys,
            partition_by="processed_date",
            check_unique=False,
            one_partition=True,
            ordered_value=process_date,
        )


# --- Gold -----------------------------------------------------------------------


def stored_watermark(lake: Lakehouse) -> str | None:
    table = lake.read_optional("gold", WATERMARK)
    if table is None:
        return None
    mark = incremental.read_watermark(table, PIPELINE_NAME).first()[0]
    return None if mark is None else mark.isoformat()


def latest_silver_dates(lake: Lakehouse, names: Iterable[str] = DATASETS) -> dict[str, str | None]:
    """Newest processing date of each data set's Silver table.

    Tables partitioned by it answer from their folder names; only snapshots are read.
    """
    dates: dict[str, str | None] = {}
    unlisted: dict[str, DataFrame] = {}
    for name in names:
        dates[name] = None
        listed = lake.partition_values("silver", name, "processed_date")
        if listed is not None:
            dates[name] = max(listed)
        elif (table := lake.read_optional("silver", name)) is not None and "processed_date" in table.columns:
            unlisted[name] = table
    if unlisted:
        each = [t.select(F.lit(n).alias("name"), F.col("processed_date").alias("day")) for n, t in unlisted.items()]
        for row in reduce(DataFrame.unionByName, each).groupBy("name").agg(F.max("day").alias("day")).collect():
            dates[row["name"]] = None if row["day"] is None else row["day"].isoformat()
    return dates


def latest_silver_date(lake: Lakehouse) -> str | None:
    """Newest processing date over the Silver tables."""
    return max(filter(None, latest_silver_dates(lake).values()), default=None)


def stored_marks(lake: Lakehouse) -> dict[str, str | None]:
    """The mark of every data set; a lake from before there were any has the common one for all."""
    table = lake.read_optional("gold", SOURCE_MARKS)
    if table is None:
        return dict.fromkeys(DATASETS, stored_watermark(lake))
    held = {r["data_set"]: r["last_process_date"].isoformat() for r in table.collect()}
    return {name: held.get(name) for name in DATASETS}


def update_watermark(lake: Lakehouse, latest: Mapping[str, str | None] | None = None) -> None:
    """Advance the marks to ``latest`` by data set, by default the newest Silver dates.

    A run passes the dates it has read up to: Silver written meanwhile is left to the next.
    The common mark is the newest one.
    """
    latest = latest or latest_silver_dates(lake)
    days = {name: day for name, day in latest.items() if day}
    if not days:
        return
    mark = lake.spark.range(1).select(
        F.lit(PIPELINE_NAME).alias("pipeline_name"),
        F.lit(max(days.values())).cast("date").alias("last_process_date"),
        F.current_timestamp().alias("updated_at"),
    )
    held = lake.read_optional("gold", WATERMARK)
    if held is None:
        held = lake.spark.createDataFrame([], WATERMARK_SCHEMA)
    rows = [(name, date.fromisoformat(day)) for name, day in days.items()]
    marks = lake.spark.createDataFrame(rows, "data_set string, last_process_date date")
    known = lake.read_optional("gold", SOURCE_MARKS)
    if known is not None:
        marks = merge_upsert(known, marks, ["data_set"])
    lake.overwrite(marks, "gold", SOURCE_MARKS)
    lake.overwrite(incremental.upsert_watermark(held, mark), "gold", WATERMARK)


Marks = tuple[dict[str, str | None], dict[str, str | None]]


def read_marks(lake: Lakehouse) -> Marks:
    """Newest Silver dates and stored marks, by data set."""
    return latest_silver_dates(lake), stored_marks(lake)


def build_state(lake: Lakehouse, table: str, marks: Marks | None = None) -> BuildState:
    """What ``table`` needs; ``marks`` spares reading them once more."""
    if not lake.has_rows("gold", table):
        return BuildState(full=True)
    latest, held = marks or read_marks(lake)
    names = SOURCES[table]
    return incremental.resolve_by_source(True, {n: latest[n] for n in names}, {n: held[n] for n in names})


def _history_runs(lake: Lakehouse, table: str) -> dict[str, str]:
    """Stamps of the snapshots that a history has taken up, by their date."""
    runs = lake.read_optional("gold", HISTORY_RUNS)
    if runs is None:
        return {}
    return {r["process_date"]: r["process_ts"] for r in runs.where(F.col("table_name") == table).collect()}


def _is_late(lake: Lakehouse, table: str, process_date: str) -> bool:
    """Whether a snapshot lies in Bronze that a history with newer ones has not taken up."""
    if table not in HISTORIES:
        return False
    delivered = lake.partition_values("bronze", HISTORIES[table], "ingest_date") or ()
    runs = _history_runs(lake, table)
    return process_date in delivered and process_date not in runs and max(runs, default="") > process_date


def _history(lake: Lakehouse, table: str, process_date: str, process_ts: str) -> None:
    """Bring a dimension with history up to one more snapshot, which may be older than others."""
    existing = lake.read_optional("gold", table)
    name = HISTORIES[table]
    natural, surrogate, attributes = dims.HISTORIES[table]
    rows, later = lake.read("silver", name), None
    after = {day: ts for day, ts in _history_runs(lake, table).items() if day > process_date}
    if existing is not None and after:
        rows = silver.to_silver(read_bronze(lake, name, process_date), name, process_date)
        # Which keys the newer snapshots held: keys and dates only.
        delivered = lake.read("bronze", name).where(F.col("ingest_date").isin(*map(date.fromisoformat, after)))
        stamps = F.create_map(*(F.lit(x) for day, ts in after.items() for x in (day, ts)))
        stamp = format_timestamp(stamps[F.col("ingest_date").cast("string")].cast("timestamp_ntz"))
        later = delivered.select(natural, stamp.alias("seen"))
    if table == "dim_customer":
        source = dims.customer_attributes(rows, process_date)
    else:
        source = dims.product_attributes(rows, lake.read("gold", "dim_category"))
    if existing is None:
        first = build_scd2_dimension(source, natural, surrogate, attributes, process_ts)
        lake.write_history(first, "gold", table, natural)
    else:
        change = history_change(source, natural, surrogate, attributes, process_ts, existing, later)
        lake.update_history(change.gone, change.rows, "gold", table, natural, surrogate)


_REGISTRY = Lock()


def _keep_run(lake: Lakehouse, table: str, process_date: str, process_ts: str) -> None:
    run = lake.spark.createDataFrame(
        [(table, process_date, process_ts)], "table_name string, process_date string, process_ts string"
    )
    # Histories are built side by side and share the table.
    with _REGISTRY:
        lake.merge(run, "gold", HISTORY_RUNS, ["table_name", "process_date"])


def _dimension(lake: Lakehouse, table: str) -> DataFrame:
    existing = lake.read_optional("gold", table)
    if table == "dim_date":
        return dims.dim_date(lake.spark)
    return dims.static_dimension(
        table, lake.read("silver", dims.STATIC_DIMENSIONS[table][0]), existing
    )


FULL: dict[str, Callable] = {
    "fact_order": lambda s, d: facts.fact_order(s("orders"), s("order_items"), d),
    "fact_order_item": lambda s, d: facts.fact_order_item(s("orders"), s("order_items"), d),
    "fact_web_event": lambda s, d: facts.fact_web_event(s("events"), s("sessions"), d),
    "fact_review": lambda s, d: facts.fact_review(s("reviews"), d),
    "fact_session": lambda s, d: facts.fact_session(s("sessions"), d),
    "fact_customer_funnel": lambda s, d: facts.fact_customer_funnel(
        s("events"), s("sessions"), s("orders"), lambda ids: s("order_items", ids), d
    ),
}
# Silver with dates, dimensions, mark, stored fact.
SINCE: dict[str, Callable[..., incremental.Delta]] = {
    "fact_order": lambda s, d, w, _: incremental.fact_order_since(s("orders"), s("order_items"), d, w),
    "fact_order_item": lambda s, d, w, _: incremental.fact_order_item_since(
        s("orders"), s("order_items"), d, w
    ),
    "fact_web_event": lambda s, d, w, held: incremental.fact_web_event_since(
        s("events"), s("sessions"), d, w, held
    ),
    "fact_review": lambda s, d, w, _: incremental.fact_review_since(s("reviews"), d, w),
    "fact_session": lambda s, d, w, _: incremental.fact_session_since(s("sessions"), d, w),
}


def _fact(lake: Lakehouse, table: str, state: BuildState, by_day: bool) -> None:
    fact = facts.FACTS[table]
    tables = {name: lake.read("gold", name) for name in fact.dimensions}

    def usable(name: str, within: DataFrame | None = None) -> DataFrame:
        # Stored rows are unique already, and what they are joined to picks those within.
        return incremental.usable(lake.read("silver", name), name)

    def dated(name: str) -> DataFrame:
        return incremental.with_date(lake.read("silver", name), name)

    stored = (*fact.columns, *fact.extra)
    partition = FACT_PARTITION if by_day and FACT_PARTITION in fact.columns else None
    if state.since is None or not fact.incremental:
        rows = facts.numbered_first(table, FULL[table], usable, tables)
        lake.overwrite(rows, "gold", table, partition)
        return
    held = lake.read("gold", table)
    delta = SINCE[table](dated, tables, state.marks, held)
    scope = stage(delta.scope, f"scope-{table}")
    if scope.isEmpty():
        return
    rows, sent = resolve_and_keys(delta.rows, held, fact.keys, fact.surrogate)
    lake.merge(
        rows.select(*stored), "gold", table, fact.keys, partition, check_unique=False, retract=scope, sent=sent
    )


def build_gold(
    lake: Lakehouse,
    process_date: str,
    process_ts: str,
    table: str,
    by_day: bool = True,
    marks: Marks | None = None,
) -> BuildState:
    """Build or refresh one Gold table; the result says what was done.

    ``by_day`` partitions the larger facts by date key. Turn it off for small shops,
    where a folder per day costs more than a full rewrite.
    """
    check_date(process_date)
    if table not in GOLD_TABLES:
        raise ValueError(f"unknown Gold table {table!r}; known: {', '.join(sorted(GOLD_TABLES))}")
    state = build_state(lake, table, marks)
    if state.skip and _is_late(lake, table, process_date):
        state = BuildState(since=process_date)
    if state.skip:
        return state
    if table in HISTORIES:
        _history(lake, table, process_date, process_ts)
        _keep_run(lake, table, process_date, process_ts)
    elif table in DIMENSIONS:
        lake.overwrite(_dimension(lake, table), "gold", table)
    else:
        _fact(lake, table, state, by_day)
    return state


def _each(lake: Lakehouse, step: Callable[[str], object], names: Iterable[str], at_once: int) -> None:
    """Run independent steps, several Spark jobs at a time; the first error is raised.

    What a step has staged goes when it ends, not with the run: its result is a stored table.
    """

    def whole(name: str) -> None:
        with staging_step(lake.spark):
            step(name)

    with ThreadPoolExecutor(at_once) as pool:
        list(pool.map(whole, names))


def run_pipeline(
    lake: Lakehouse,
    process_date: str,
    process_ts: str,
    source: Callable[[str], DataFrame],
    ingested_at: Column | None = None,
    by_day: bool = True,
    at_once: int = 4,
    names: Iterable[str] = DATASETS,
) -> None:
    """One run over the data sets that have arrived, by default all: ``source`` gives each by name."""

    def ingest(name: str) -> None:
        ingest_to_bronze(lake, process_date, name, source(name), ingested_at)

    _run(lake, process_date, process_ts, ingest, by_day, at_once, names)


def _run(
    lake: Lakehouse,
    process_date: str,
    process_ts: str,
    ingest: Callable[[str], object],
    by_day: bool = True,
    at_once: int = 4,
    names: Iterable[str] = DATASETS,
) -> None:
    """Ingest and clean the named data sets, and build everything that has its sources.

    Tables of one group do not depend on each other and are built side by side. The
    mark advances last, so a run that fails is simply repeated.
    """

    def refine(name: str) -> None:
        clean_silver(lake, process_date, name)

    def build(table: str) -> None:
        build_gold(lake, process_date, process_ts, table, by_day, marks)

    with staging_run(lake.spark):
        _each(lake, ingest, names, at_once)
        _each(lake, refine, names, at_once)
        marks = read_marks(lake)
        for group in (("dim_date", *STATIC), ("dim_customer", "dim_product"), tuple(facts.FACTS)):
            _each(lake, build, group, at_once)
        update_watermark(lake, marks[0])


def run_csv_pipeline(
    lake: Lakehouse,
    process_date: str,
    process_ts: str,
    folder: str,
    by_day: bool = True,
    most_unreadable: float | None = None,
) -> None:
    """``run_pipeline`` over a folder of CSV files; see :func:`ingest_csv` for ``most_unreadable``."""

    def ingest(name: str) -> None:
        ingest_csv(lake, process_date, folder, f"{name}.csv", most_unreadable=most_unreadable)

    _run(lake, process_date, process_ts, ingest, by_day)


def row_counts(lake: Lakehouse) -> DataFrame:
    """Rows per stored table of all layers."""
    tables = [
        *(("bronze", n) for n in DATASETS),
        *(("silver", n) for n in DATASETS),
        *(("gold", n) for n in GOLD_TABLES),
    ]
    counts = [
        lake.read(layer, name)
        .agg(F.count("*").alias("row_count"))
        .select(F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "row_count")
        for layer, name in tables
    ]
    result = counts[0]
    for frame in counts[1:]:
        result = result.unionByName(frame)
    return result

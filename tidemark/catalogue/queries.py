"""One query per operator: ``(spark, folder) -> DataFrame`` over the sample tables.

Wall-clock columns and file paths are left out of the results.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import (
    attribute_hash,
    blank_to_null,
    format_timestamp,
    iso_timestamp,
    money,
    parse_flag,
)
from tidemark.operators.columns import normalize_columns, safe_trim
from tidemark.operators.dedupe import dedupe_latest
from tidemark.operators.dimensions import distinct_values, new_values
from tidemark.operators.history import build_scd2_dimension, current_rows, detect_changes
from tidemark.operators.keys import assign_keys
from tidemark.operators.lookup import attach_dimension_key
from tidemark.operators.merge import merge_preserving_keys, merge_upsert
from tidemark.operators.rules import valid_rows, violation_counts
from tidemark.operators.staging import stage, staging_path, staging_run
from tidemark.plans import dims, facts, incremental, pipeline, serving
from tidemark.plans.bronze import add_quality_flags, add_record_id, valid_records
from tidemark.plans.samples import FIRST_DATE, FIRST_TS, LAST_DATE, LAST_TS, MIDDLE_TS, Shop
from tidemark.sources.datasets import DATASETS
from tidemark.sources.files import scan_csv, unreadable_values
from tidemark.sources.samples import Samples
from tidemark.sources.tables import Lakehouse

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str, function: Query) -> None:
    QUERIES[name] = function


def query(name: str) -> Callable[[Query], Query]:
    def keep(function: Query) -> Query:
        register(name, function)
        return function

    return keep


def _union(frames) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# --- Bronze -----------------------------------------------------------------------


def _bronze(name: str) -> Query:
    return lambda spark, folder: Shop(spark, folder).bronze(name).drop(
        "ingestion_timestamp", "source_file"
    )


for _name in DATASETS:
    register(f"bronze_{_name}", _bronze(_name))


@query("normalize_columns")
def normalize_columns_query(spark, folder):
    """Customers whose headers were typed by hand."""
    source = Shop(spark, folder).source("customers")
    typed = source.toDF(*(f" {c.replace('_', ' ').title()} " for c in source.columns))
    return normalize_columns(typed)


@query("bronze_record_id")
def bronze_record_id(spark, folder):
    shop = Shop(spark, folder)
    return _union(
        add_record_id(shop.source(name), name).select(
            F.lit(name).alias("dataset"), "record_id", "record_id_source"
        )
        for name in DATASETS
    )


def _damaged(shop: Shop) -> list[tuple[str, DataFrame]]:
    """Sources with missing ids: error events lose theirs, returned items both parts."""
    events = shop.source("events").withColumn(
        "event_id", F.when(F.col("event_type") != "error", F.col("event_id"))
    )
    sold = F.col("quantity") > 0
    items = shop.source("order_items").withColumns(
        {k: F.when(sold, F.col(k)) for k in ("order_id", "product_id")}
    )
    return [("events", events), ("order_items", items)]


@query("bronze_quality_flags")
def bronze_quality_flags(spark, folder):
    return _union(
        add_quality_flags(add_record_id(frame, name))
        .groupBy("error", "is_valid_record_id")
        .agg(F.count("*").alias("records"))
        .select(F.lit(name).alias("dataset"), "error", "is_valid_record_id", "records")
        for name, frame in _damaged(Shop(spark, folder))
    )


@query("bronze_valid_only")
def bronze_valid_only(spark, folder):
    return _union(
        valid_records(add_quality_flags(add_record_id(frame, name))).select(
            F.lit(name).alias("dataset"), "record_id"
        )
        for name, frame in _damaged(Shop(spark, folder))
    )


@query("bronze_unreadable")
def bronze_unreadable(spark, folder):
    """Orders from a CSV file whose ids and amounts are partly no numbers, columns in reverse."""
    source = Shop(spark, folder).source("orders")
    n = F.col("order_id")
    spoilt = {
        "customer_id": F.when(n % 7 == 0, F.concat("customer_id", F.lit(".0"))).otherwise(F.col("customer_id").cast("string")),
        "subtotal_usd": F.when(n % 11 == 0, F.concat(F.lit("USD "), n)).otherwise(F.col("subtotal_usd").cast("string")),
        "discount_pct": F.when(n % 13 == 0, F.lit("n/a")).otherwise(F.col("discount_pct").cast("string")),
    }
    path = staging_path(spark, "delivery")
    delivery = source.withColumns(spoilt).select(*reversed(source.columns))
    # Text is written as it is, blanks included.
    kept = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    delivery.write.csv(f"{path}/orders.csv", header=True, **kept)
    scan = stage(scan_csv(spark, path, "orders.csv"), "scan")
    return unreadable_values(scan, "order_id", "payment_method").drop("source_file", "row")


@query("bronze_partition_replace")
def bronze_partition_replace(spark, folder):
    """Two ingest dates, the second one delivered twice."""
    lake = Lakehouse(spark, staging_path(spark, "replace"))
    first, second = Shop(spark, folder, 1), Shop(spark, folder, 2)
    pipeline.ingest_to_bronze(lake, FIRST_DATE, "orders", first.source("orders"))
    pipeline.ingest_to_bronze(lake, LAST_DATE, "orders", first.source("orders"))
    pipeline.ingest_to_bronze(lake, LAST_DATE, "orders", second.source("orders"))
    return lake.read("bronze", "orders").select("order_id", "subtotal_usd", "ingest_date")


# --- Silver -----------------------------------------------------------------------


def _silver(name: str) -> Query:
    return lambda spark, folder: Shop(spark, folder).silver(name).drop("processed_at")


for _name in DATASETS:
    register(f"silver_{_name}", _silver(_name))


@query("silver_valid_orders")
def silver_valid_orders(spark, folder):
    return valid_rows(Shop(spark, folder).silver("orders")).drop("processed_at")


@query("silver_slice_by_date")
def silver_slice_by_date(spark, folder):
    orders = Shop(spark, folder, 2).silver("orders")
    return incremental.read_on(orders, FIRST_DATE).drop("processed_at")


@query("safe_trim")
def safe_trim_query(spark, folder):
    source = Shop(spark, folder).source("orders")
    return safe_trim(source, ["payment_method", "country", "device", "source", "not_there"])


@query("parse_opt_in")
def parse_opt_in(spark, folder):
    return Shop(spark, folder).source("customers").select(
        "customer_id", parse_flag(blank_to_null("marketing_opt_in")).alias("opt_in")
    )


@query("dedupe_latest")
def dedupe_latest_query(spark, folder):
    """The last event of every session."""
    return dedupe_latest(Shop(spark, folder).source("events"), ["session_id"], ["timestamp", "event_id"])


@query("rule_violation_counts")
def rule_violation_counts(spark, folder):
    shop = Shop(spark, folder)
    return _union(violation_counts(shop.silver(n), n) for n in DATASETS)


@query("validation_status_counts")
def validation_status_counts(spark, folder):
    shop = Shop(spark, folder)
    return _union(
        shop.silver(n)
        .groupBy("status")
        .agg(F.count("*").alias("records"))
        .select(F.lit(n).alias("dataset"), "status", "records")
        for n in DATASETS
    )


@query("events_with_customer")
def events_with_customer(spark, folder):
    shop = Shop(spark, folder)
    return facts.events_with_customer(shop.usable("events"), shop.usable("sessions")).select(
        "event_id", "session_id", "customer_id", "event_type", "timestamp", "event_date"
    )


# --- keyed writes -----------------------------------------------------------------


@query("merge_upsert_orders")
def merge_upsert_orders(spark, folder):
    return Shop(spark, folder, 2).silver("orders").drop("processed_at")


@query("merge_preserve_surrogate")
def merge_preserve_surrogate(spark, folder):
    columns = ["order_id", "customer_id", "subtotal_usd"]
    held = Shop(spark, folder, 1).silver_batch("orders").select(*columns)
    sent = Shop(spark, folder, 2).silver_batch("orders").select(*columns)
    target = assign_keys(held, "order_key", ["order_id"])
    return merge_preserving_keys(target, sent, ["order_id"], "order_key")


@query("merge_schema_evolution")
def merge_schema_evolution(spark, folder):
    """The delivery lacks ``country`` and brings ``device``."""
    held = Shop(spark, folder, 1).silver_batch("orders")
    sent = Shop(spark, folder, 2).silver_batch("orders")
    return merge_upsert(
        held.select("order_id", "country", "subtotal_usd"),
        sent.select("order_id", "subtotal_usd", "device"),
        ["order_id"],
    )


@query("surrogate_keys_dense")
def surrogate_keys_dense(spark, folder):
    pairs = Shop(spark, folder).source("order_items").select("order_id", "product_id").distinct()
    return assign_keys(pairs, "item_key", ["order_id", "product_id"])


@query("distinct_dimension_values")
def distinct_dimension_values(spark, folder):
    sessions = Shop(spark, folder).silver("sessions")
    return distinct_values(sessions, {c: c for c in ("country", "source", "device")})


@query("static_dim_new_values")
def static_dim_new_values(spark, folder):
    """Devices of orders that no session has used."""
    shop = Shop(spark, folder)
    ordered = shop.silver("orders").select(F.col("device").alias("device_name"))
    return new_values(ordered, shop.dims(["dim_device"])["dim_device"], "device_name")


@query("attach_dimension_key")
def attach_dimension_key_query(spark, folder):
    shop = Shop(spark, folder)
    orders = shop.silver("orders").select("order_id", "device")
    device = shop.dims(["dim_device"])["dim_device"]
    return attach_dimension_key(orders, "device", device, "device_name", "device_key")


@query("attribute_hash")
def attribute_hash_query(spark, folder):
    return Shop(spark, folder).silver("customers").select(
        "customer_id", attribute_hash(["name", "email", "country", "age"]).alias("hash")
    )


@query("format_timestamp")
def format_timestamp_query(spark, folder):
    return Shop(spark, folder).silver("events").select(
        "event_id", format_timestamp("timestamp").alias("shown")
    )


@query("scalar_functions_mix")
def scalar_functions_mix(spark, folder):
    """Functions the layers use, side by side over the orders."""
    orders = Shop(spark, folder).source("orders")
    placed = iso_timestamp("order_time")
    return orders.select(
        "order_id",
        F.trim("payment_method").alias("trimmed"),
        F.lower("payment_method").alias("lowered"),
        F.concat_ws("-", "country", "payment_method", "source").alias("joined"),
        F.col("payment_method").rlike("^ [1-3]-").alias("urgent_first"),
        F.sha2("order_time", 256).alias("digest"),
        placed.cast("date").alias("order_date"),
        F.year(placed).alias("order_year"),
        F.quarter(placed).alias("order_quarter"),
        F.month(placed).alias("order_month"),
        F.dayofmonth(placed).alias("order_day"),
        F.dayofweek(placed).alias("order_weekday"),
        F.abs(money("total_usd") - money("subtotal_usd")).cast("double").alias("gap"),
        F.round(money("subtotal_usd") * F.lit(0.1).cast("decimal(2,1)"), 2)
        .cast("double")
        .alias("tenth"),
        F.coalesce("payment_method", F.lit("none")).alias("payment"),
        F.col("device").isin("mobile", "tablet").alias("handheld"),
        F.when(F.col("discount_pct") > 20, "high").otherwise("low").alias("discount"),
        F.col("discount_pct").try_cast("int").alias("whole_discount"),
    )


# --- dimensions -------------------------------------------------------------------


@query("dim_date")
def dim_date(spark, folder):
    """The calendar with the number of valid orders on every day."""
    per_day = (
        Shop(spark, folder)
        .usable("orders")
        .groupBy(F.col("order_date").alias("full_date"))
        .agg(F.count("*").alias("orders"))
    )
    return (
        dims.dim_date(spark)
        .join(per_day, "full_date", "left")
        .withColumn("orders", F.coalesce("orders", F.lit(0)))
    )


def _dimension(name: str, delivery: int | None = None) -> Query:
    return lambda spark, folder: Shop(spark, folder, delivery).dims([name])[name]


for _name in dims.STATIC_DIMENSIONS:
    register(_name, _dimension(_name))
for _name in ("dim_customer", "dim_product"):
    register(f"{_name}_initial", _dimension(_name))
    register(f"{_name}_scd2", _dimension(_name, 2))

_ORDER_ATTRIBUTES = ["payment_method", "subtotal_usd", "country"]


def _order_history(spark, folder, second: bool) -> DataFrame:
    """Orders under history tracking, after one or two deliveries."""
    args = ("order_id", "order_version_key", _ORDER_ATTRIBUTES)
    first = build_scd2_dimension(
        Shop(spark, folder, 1).silver_batch("orders"), *args, process_ts=FIRST_TS
    )
    if not second:
        return first
    batch = Shop(spark, folder, 2).silver_batch("orders")
    return build_scd2_dimension(batch, *args, process_ts=LAST_TS, existing=first)


@query("scd2_first_load")
def scd2_first_load(spark, folder):
    return _order_history(spark, folder, second=False)


@query("scd2_second_run")
def scd2_second_run(spark, folder):
    return _order_history(spark, folder, second=True)


@query("scd2_current")
def scd2_current(spark, folder):
    return current_rows(_order_history(spark, folder, second=True))


@query("scd2_late_snapshots")
def scd2_late_snapshots(spark, folder):
    """Three snapshots that arrive last, first, middle."""
    args = ("order_id", "order_version_key", _ORDER_ATTRIBUTES)
    arrived: list[DataFrame] = []
    history = None
    for delivery, stamp in ((2, LAST_TS), (1, FIRST_TS), (3, MIDDLE_TS)):
        snapshot = stage(Shop(spark, folder, delivery).silver_batch("orders"), "snapshot")
        later = _union(arrived) if arrived else None
        history = stage(build_scd2_dimension(snapshot, *args, stamp, history, later), "history")
        arrived.append(snapshot.select("order_id", F.lit(stamp).alias("seen")))
    return history.drop("order_version_key")


@query("scd2_change_detect")
def scd2_change_detect(spark, folder):
    shop = Shop(spark, folder, 2)
    held = current_rows(shop.previous.dims(["dim_customer"])["dim_customer"])
    sent = dims.customer_attributes(shop.silver("customers"), LAST_DATE)
    return detect_changes(sent, held, "customer_id", dims.CUSTOMER_ATTRIBUTES).select(
        "customer_id", "change"
    )


# --- facts ------------------------------------------------------------------------


@query("order_costs")
def order_costs(spark, folder):
    shop = Shop(spark, folder)
    costs = facts.order_costs(shop.usable("order_items"), shop.dims(["dim_product"]))
    whole = F.col("order_cost_usd").cast("double") + F.col("inexact_cost_usd")
    return costs.select("order_id", whole.alias("order_cost_usd"))


def _fact(name: str) -> Query:
    return lambda spark, folder: facts.contract(name, Shop(spark, folder).fact(name))


for _name in facts.FACTS:
    register(_name, _fact(_name))


@query("event_duration")
def event_duration(spark, folder):
    events = Shop(spark, folder).usable("events")
    return facts.event_duration(events.select("event_id", "session_id", "timestamp"))


def _visits(shop: Shop) -> DataFrame:
    return facts.events_with_customer(shop.usable("events"), shop.usable("sessions"))


@query("session_order_map")
def session_order_map(spark, folder):
    shop = Shop(spark, folder)
    return facts.session_order_map(_visits(shop), shop.usable("orders"))


def _first_touch(column: str) -> Query:
    return lambda spark, folder: (
        facts.first_touches(_visits(Shop(spark, folder)))
        .where(F.isnotnull(column))
        .select("customer_id", "product_id", column)
    )


register("funnel_first_view", _first_touch("first_view_date"))
register("funnel_first_cart", _first_touch("first_add_to_cart_date"))


def _purchases(shop: Shop) -> DataFrame:
    return facts.first_purchases(_visits(shop), shop.usable("orders"), lambda ids: shop.usable("order_items", ids))


@query("funnel_purchase_dates")
def funnel_purchase_dates(spark, folder):
    return _purchases(Shop(spark, folder))


@query("funnel_base_keys")
def funnel_base_keys(spark, folder):
    shop = Shop(spark, folder)
    return facts.funnel_pairs(facts.first_touches(_visits(shop)), _purchases(shop))


# --- incremental loads ------------------------------------------------------------


@query("incremental_read_since")
def incremental_read_since(spark, folder):
    events = Shop(spark, folder, 2).silver("events")
    return incremental.read_since(events, FIRST_DATE).drop("processed_at")


@query("latest_process_date")
def latest_process_date(spark, folder):
    return incremental.latest_process_date(Shop(spark, folder, 2).silver_days_tables().values())


def _marks(shop: Shop) -> DataFrame:
    """A mark per data set, from its Silver rows."""
    return _union(
        table.groupBy(F.lit(name).alias("pipeline_name")).agg(
            F.max("processed_date").alias("last_process_date")
        )
        for name, table in shop.silver_days_tables().items()
    )


def _watermarks(spark, folder) -> DataFrame:
    """Marks of the first delivery, then those of the second for what it brought."""
    shop = Shop(spark, folder, 2)
    sent = _union(
        shop.days_batch(name)
        .groupBy(F.lit(name).alias("pipeline_name"))
        .agg(F.max("processed_date").alias("last_process_date"))
        for name in ("orders", "events")
    )
    gold = incremental.latest_process_date(shop.silver_days_tables().values()).select(
        F.lit(incremental.PIPELINE_NAME).alias("pipeline_name"),
        F.col("latest_process_date").alias("last_process_date"),
    )
    return incremental.upsert_watermark(_marks(shop.previous), sent.unionByName(gold))


@query("watermark_upsert")
def watermark_upsert(spark, folder):
    return _watermarks(spark, folder)


@query("watermark_read")
def watermark_read(spark, folder):
    return incremental.read_watermark(_watermarks(spark, folder))


def _incremental(name: str, delivery: int) -> Query:
    def run(spark, folder):
        fact = facts.FACTS[name]
        shop = Shop(spark, folder, delivery, stored=True, reads=incremental.READS[name])
        held = shop.previous.fact(name)
        if fact.counterpart:
            # Its numbers are joined to rows that nobody has written yet; the others are read as they were numbered.
            held = stage(held, f"held-{name}")
        delta = shop.fact_delta(name, held)
        merged = merge_preserving_keys(
            # Silver holds each key once, and so does what is built from it.
            held, delta.rows, fact.keys, fact.surrogate, delta.scope, check_unique=False
        )
        return facts.contract(name, merged)

    return run


for _name, _spec in facts.FACTS.items():
    if _spec.incremental:
        register(f"{_name}_incremental", _incremental(_name, 2))
        # Corrections that invalidate rows, make others valid again, and move events between sessions.
        register(f"{_name}_retraction", _incremental(_name, 3))


# --- serving ----------------------------------------------------------------------


@query("serve_daily_revenue")
def serve_daily_revenue(spark, folder):
    shop = Shop(spark, folder)
    calendar = shop.dims(["dim_date"])["dim_date"]
    # Margins need the products, days the calendar; nobody reads the other keys.
    return serving.daily_revenue(shop.fact_rows("fact_order", ("dim_date", "dim_product")), calendar)


@query("serve_funnel")
def serve_funnel(spark, folder):
    return serving.funnel_by_first_view(Shop(spark, folder).fact_rows("fact_customer_funnel"))


@query("pipeline_row_counts")
def pipeline_row_counts(spark, folder):
    """Two runs of the whole pipeline over stored tables."""
    lake = Lakehouse(spark, staging_path(spark, "pipeline"))
    samples = Samples(spark, folder)
    with staging_run(spark):
        # Either delivery takes orders and items from it.
        samples.keep("orders")
        for delivery in (1, 2):
            shop = Shop(spark, folder, delivery, samples=samples)
            pipeline.run_pipeline(
                lake, shop.process_date, shop.process_ts, shop.source, by_day=False
            )
    return pipeline.row_counts(lake)

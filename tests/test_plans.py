"""Physical plans: what is pushed down, broadcast, limited before the shuffle."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.operators import keys
from tidemark.operators.dedupe import dedupe_latest
from tidemark.operators.dimensions import build_static_dimension
from tidemark.operators.lookup import attach_dimension_key
from tidemark.operators.merge import merge_preserving_keys, merge_upsert
from tidemark.operators.staging import stage
from tidemark.plans import bronze, dims, facts, incremental, pipeline, samples, silver
from tidemark.plans.samples import Shop
from tidemark.sources.datasets import dataset
from tidemark.sources.tables import Lakehouse


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def shop(spark, sample):
    return Shop(spark, sample, stored=True)


@pytest.mark.parametrize("name", facts.FACTS)
def test_fact_plans_stay_in_the_jvm_and_spread(shop, name):
    text = plan(shop.fact_rows(name))
    assert "Python" not in text and "ArrowEval" not in text
    assert "SinglePartition" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_dimension_lookups_are_broadcast_while_small(shop):
    text = plan(shop.fact_rows("fact_session"))
    assert text.count("BroadcastHashJoin") == 5


def test_outgrown_dimensions_are_joined_by_shuffle(spark, shop):
    sessions = shop.usable("sessions")
    device = shop.dims(["dim_device"])["dim_device"]
    small = attach_dimension_key(sessions, "device", device, "device_name", "device_key")
    expected = sorted(small.select("session_id", "device_key").collect())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10")
    try:
        large = attach_dimension_key(sessions, "device", device, "device_name", "device_key")
        assert "SortMergeJoin" in plan(large) and "BroadcastHashJoin" not in plan(large)
        assert sorted(large.select("session_id", "device_key").collect()) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_calendar_is_always_broadcast(spark):
    days = spark.sql("select date_add(date'2024-01-31', cast(id as int)) as d from range(2)")
    keyed = attach_dimension_key(days, "d", dims.dim_date(spark), "full_date", "date_key")
    assert "BroadcastHashJoin" in plan(keyed)
    assert {r["date_key"] for r in keyed.collect()} == {20240131, 20240201}


def test_dedupe_limits_groups_before_the_shuffle(spark):
    text = plan(dedupe_latest(spark.range(9).selectExpr("id % 2 as k", "id"), ["k"], ["id"]))
    before_shuffle = text[text.index("Exchange") :]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_small_upserts_do_not_move_the_target(spark):
    target = stage(spark.range(1000).withColumn("v", F.lit("a")))
    source = stage(spark.range(5).withColumn("v", F.lit("b")))
    text = plan(merge_upsert(target, source, ["id"], check_unique=False))
    assert "BroadcastHashJoin" in text and "LeftAnti" in text and "hashpartitioning" not in text


def test_scopes_and_numbers_are_met_once(spark):
    target = stage(spark.range(1000).selectExpr("id as sk", "id", "id % 9 as g"))
    source = stage(spark.range(5).selectExpr("id", "id % 2 as g"))
    text = plan(merge_preserving_keys(target, source, ["id"], "sk", stage(spark.range(2).selectExpr("id as g"))))
    # The target meets keys and scope; incoming rows meet their numbers once, where they are returned.
    assert text.count("LeftAnti") == 2 and "LeftSemi" not in text and text.count("_row") and text.count("Inner") == 2


def test_touched_sessions_are_written(spark, sample):
    shop = Shop(spark, sample, 2, stored=True, reads=incremental.READS["fact_web_event"])
    held = stage(shop.previous.fact("fact_web_event"))
    scope = plan(shop.fact_delta("fact_web_event", held).scope)
    assert scope.count("FileScan") == 1 and "Join" not in scope


def test_filters_reach_the_stored_tables(spark, sample, tmp_path):
    lake = Lakehouse(spark, str(tmp_path / "lake"))
    shop = Shop(spark, sample, 1)
    for name in ("orders", "sessions"):
        pipeline.ingest_to_bronze(lake, shop.process_date, name, shop.source(name))
        pipeline.clean_silver(lake, shop.process_date, name)
    text = plan(pipeline.read_bronze(lake, "orders", "2024-01-15").select("order_id"))
    assert "PartitionFilters: [isnotnull(ingest_date" in text
    assert "ReadSchema: struct<order_id:bigint>" in text
    text = plan(incremental.read_since(lake.read("silver", "orders"), "2024-01-14").select("order_id"))
    assert "PartitionFilters: [isnotnull(processed_date" in text
    text = plan(incremental.usable(lake.read("silver", "orders"), "orders").select("order_id"))
    assert "PushedFilters: [IsNull(validation_errors)]" in text


def test_calendar(spark):
    calendar = dims.dim_date(spark)
    assert calendar.count() == 36890
    found = calendar.where("date_key in (19500101, 20240229, 20501231)").orderBy("date_key").collect()
    assert [(str(r["full_date"]), *tuple(r)[2:]) for r in found] == [
        ("1950-01-01", 1950, 1, 1, 1, 1),
        ("2024-02-29", 2024, 1, 2, 29, 5),
        ("2050-12-31", 2050, 4, 12, 31, 7),
    ]
    assert calendar.select("date_key").distinct().count() == 36890


def test_dates_outside_the_calendar_have_no_key(spark):
    days = spark.sql("select explode(array(date'1949-12-31', date'2051-01-01', null)) as d")
    keyed = attach_dimension_key(days, "d", dims.dim_date(spark), "full_date", "date_key")
    assert [r["date_key"] for r in keyed.collect()] == [None] * 3


def test_dimension_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "v string")
    assert build_static_dimension(empty, "v", "k").collect() == []


@pytest.mark.parametrize("delivery", [1, 2, 3])
def test_marks_read_keys_and_days_of_silver(spark, sample, delivery):
    shop = Shop(spark, sample, delivery)
    for name in ("order_items", "events", "customers"):
        days = shop.silver_days(name)
        assert days.columns == [*dataset(name).keys, "processed_date"]
        assert sorted(days.collect()) == sorted(shop.silver(name).select(*days.columns).collect())


def test_numbering_writes_rows_once(spark, monkeypatch):
    labels = []
    monkeypatch.setattr(keys, "stage", lambda df, label: labels.append(label) or stage(df, label))
    numbered = keys.assign_keys(spark.range(9).selectExpr("9 - id as a", "id as b"), "k", ["a"])
    assert sorted(numbered.collect()) == [(i + 1, i + 1, 8 - i) for i in range(9)]
    assert labels == ["rows-k", "offsets-k"]


def test_silver_items_move_without_what_follows_from_them(spark, sample):
    text = plan(Shop(spark, sample).silver("order_items"))
    limits = [line for line in text.splitlines() if "Window" in line]
    assert limits and not any("record_id" in line or "computed_line_total" in line for line in limits)


def test_item_increments_take_touched_items_once(spark, sample, monkeypatch):
    staged = []
    monkeypatch.setattr(incremental, "stage", lambda df, label: staged.append(stage(df, label)) or staged[-1])
    shop = Shop(spark, sample, 2, stored=True)
    delta = shop.fact_delta("fact_order_item", None)
    assert [tuple(t.columns) for t in staged] == [incremental.ITEM_COLUMNS]
    touched = set(staged[0].select("order_id", "product_id").collect())
    assert touched == set(delta.scope.collect()) and 0 < len(touched)
    assert set(delta.rows.select("order_id", "product_id").collect()) <= touched


@pytest.mark.parametrize("name", ["orders", "sessions"])
def test_silver_rows_move_without_codes_and_amounts(spark, sample, name):
    text = plan(Shop(spark, sample).silver(name))
    limits = [line for line in text.splitlines() if "Window" in line]
    assert limits and not any("validation_" in line or "computed_" in line for line in limits)


@pytest.mark.parametrize("name", ["customers", "orders", "sessions"])
def test_rows_that_differ_in_gaps_rank_as_by_their_warnings(spark, sample, name):
    spec = dataset(name)
    shop = Shop(spark, sample)
    some = shop.source(name).orderBy(*spec.keys).limit(8)
    copies = some
    for c in spec.unknown:
        copies = copies.drop(c).crossJoin(spark.createDataFrame([("Unknown",), ("  ",), (None,)], f"{c} string"))
    # Every key lacks other gaps, so that every pair of them meets somewhere.
    dealt = copies.where(F.pmod(F.xxhash64(*spec.keys, *spec.unknown), F.lit(3)) > 0).select(*some.columns)
    rows = bronze.valid_records(bronze.to_bronze(dealt, name, "2024-01-31")).drop(*bronze.RECORD_COLUMNS)
    checked = silver._checked(silver._typed(rows, name), name, "2024-01-31")
    best = dedupe_latest(checked, spec.keys, spec.priority)
    found = silver.to_silver(bronze.to_bronze(dealt, name, "2024-01-31"), name, "2024-01-31")
    shown = [c for c in best.columns if c not in bronze.BRONZE_METADATA]
    assert sorted(found.select(*shown).collect(), key=str) == sorted(best.select(*shown).collect(), key=str)
    assert found.columns[: len(shown)] == shown


def test_orders_are_numbered_by_their_keys_alone(spark, sample, monkeypatch):
    spread = {}
    monkeypatch.setattr(keys, "stage", lambda df, label: spread.setdefault(label, df.columns) and stage(df, label))
    shop = Shop(spark, sample, 1, stored=True, reads=incremental.READS["fact_order"])
    fact = shop.fact("fact_order")
    assert spread["rows-order_key"] == ["order_id", "_part", "_place"]
    assert sorted(fact.collect()) == sorted(facts.numbered("fact_order", shop.fact_rows("fact_order")).collect())


def test_increments_write_the_columns_they_read(spark, sample, monkeypatch):
    written = {}
    monkeypatch.setattr(samples, "stage", lambda df, label: written.setdefault(label, df.columns) and stage(df, label))
    Shop(spark, sample, 3, stored=True, reads=incremental.READS["fact_order"]).silver("order_items")
    assert written["silver-order_items"] == ["order_id", "product_id", "quantity", "validation_errors", "processed_date"]


def test_only_items_of_bought_orders_are_deduplicated(spark, sample, monkeypatch):
    ranked = []
    monkeypatch.setattr(silver, "dedupe_latest", lambda df, *args: ranked.append(df) or dedupe_latest(df, *args))
    monkeypatch.setattr(facts, "stage", lambda df, label: staged.setdefault(label, stage(df, label)))
    staged = {}
    Shop(spark, sample).fact_rows("fact_customer_funnel")
    items = [df for df in ranked if {"order_id", "product_id"} <= set(df.columns)]
    bought = set(staged["bought-orders"].select("order_id").collect())
    assert len(items) == 1 and 0 < len(bought) < Shop(spark, sample).source("orders").count() / 2
    assert set(items[0].select("order_id").collect()) <= bought


def test_kept_sources_are_derived_once(spark, sample):
    kept, plain = samples.Samples(spark, sample), samples.Samples(spark, sample)
    kept.keep("orders")
    files = kept.source("orders", 2).inputFiles()
    assert files and all("/source-orders-" in f for f in files)
    for name in ("orders", "order_items"):
        assert sorted(map(str, kept.source(name, 2).collect())) == sorted(map(str, plain.source(name, 2).collect()))


def test_fact_upserts_take_keys_from_written_rows(spark, sample, tmp_path, monkeypatch):
    """The numbers meet the incoming rows once, not once more for the keys that stored rows give way to."""
    sent, merged = {}, Lakehouse.merge

    def merge(self, df, layer, table, *args, **options):
        sent[table] = options.get("sent")
        merged(self, df, layer, table, *args, **options)

    monkeypatch.setattr(Lakehouse, "merge", merge)
    lake = Lakehouse(spark, str(tmp_path / "lake"))
    for delivery in (1, 2):
        shop = Shop(spark, sample, delivery)
        for name in ("reviews", "products"):
            pipeline.ingest_to_bronze(lake, shop.process_date, name, shop.source(name))
            pipeline.clean_silver(lake, shop.process_date, name)
        for table in ("dim_category", "dim_product", "fact_review"):
            pipeline.build_gold(lake, shop.process_date, shop.process_ts, table)
        pipeline.update_watermark(lake)
    assert sent["fact_review"].columns == ["review_id"] and "Join" not in plan(sent["fact_review"])
    assert lake.read("gold", "fact_review").count() == shop.fact_rows("fact_review").count()

"""The whole flow over stored tables: two deliveries by CSV file, repeated runs."""

from __future__ import annotations

import pytest
from compare import connect, differences

from tidemark.catalogue.oracle import statements
from tidemark.plans import facts, pipeline
from tidemark.plans.samples import LAST_DATE, LAST_TS, Shop
from tidemark.sources.datasets import DATASETS
from tidemark.sources.tables import Lakehouse


@pytest.fixture(scope="module")
def lake(spark, sample, tmp_path_factory):
    """A lakehouse after two deliveries."""
    root = tmp_path_factory.mktemp("lake")
    lake = Lakehouse(spark, str(root / "tables"))
    for delivery in (1, 2):
        shop = Shop(spark, sample, delivery)
        folder = root / f"delivery{delivery}"
        folder.mkdir()
        for name in DATASETS:
            # Escaping as the CSV reader expects it; texts hold quotes and line breaks.
            frame = shop.source(name).toPandas()
            # Whole numbers with NULLs are floats in pandas; the file has to say 3, not 3.0.
            whole = [f.name for f in DATASETS[name].struct if f.dataType.typeName() in ("integer", "long")]
            frame = frame.astype({c: "Int64" for c in whole})
            if name == "reviews":
                frame["review_text"] = frame["review_text"].str.replace(r'[\r\n"\\]', " ", regex=True)
            frame.to_csv(folder / f"{name}.csv", index=False)
        pipeline.run_csv_pipeline(
            lake, shop.process_date, shop.process_ts, str(folder), by_day=False
        )
    return lake, str(root / "delivery2")


@pytest.fixture(scope="module")
def con(sample):
    return connect(sample)


def _stored(lake):
    tables = {name: lake.read("gold", name) for name in pipeline.GOLD_TABLES}
    return {name: sorted(map(str, t.collect())) for name, t in tables.items() if name != "dim_date"}


@pytest.mark.parametrize(
    "table, query",
    [
        ("fact_order", "fact_order_incremental"),
        ("fact_order_item", "fact_order_item_incremental"),
        ("fact_web_event", "fact_web_event_incremental"),
        ("fact_session", "fact_session_incremental"),
        ("dim_customer", "dim_customer_scd2"),
        ("dim_product", "dim_product_scd2"),
    ],
)
def test_stored_tables_equal_sql(lake, con, table, query):
    stored = lake[0].read("gold", table)
    if table in facts.FACTS:
        stored = facts.contract(table, stored)
    assert differences(stored, con, statements()[query]) == []


def test_row_counts(lake, con):
    assert differences(pipeline.row_counts(lake[0]), con, statements()["pipeline_row_counts"]) == []


def test_increment_equals_full_rebuild(spark, sample, lake):
    """Apart from keys of dimension versions and costs, which full loads take anew."""
    business = {
        "fact_order": ["order_id", "date_key", "country_key", "source_key", "device_key"]
        + ["order_time", "payment_method_key", "discount_pct", "gross_revenue_usd"],
        "fact_order_item": ["order_id", "product_id", "date_key", "quantity", "gross_revenue_usd"],
        "fact_web_event": ["event_id", "session_id", "date_key", "event_type", "duration"],
        "fact_review": ["review_id", "order_id", "rating", "review_date"],
        "fact_session": ["session_id", "start_time", "date_key", "device_key", "source_key", "country_key"],
    }
    shop = Shop(spark, sample, 2, stored=True)
    for name, columns in business.items():
        full = sorted(map(str, shop.fact_rows(name).select(*columns).collect()))
        assert sorted(map(str, lake[0].read("gold", name).select(*columns).collect())) == full, name


def test_surrogates_are_unique(lake):
    for name, fact in facts.FACTS.items():
        table = lake[0].read("gold", name)
        assert table.select(fact.surrogate).distinct().count() == table.count()


def test_running_again_changes_nothing(lake):
    tables, folder = lake
    before = _stored(tables)
    assert pipeline.stored_watermark(tables) == LAST_DATE
    assert pipeline.build_gold(tables, LAST_DATE, LAST_TS, "fact_order").skip
    pipeline.run_csv_pipeline(tables, LAST_DATE, "2024-02-01 00:00:00", folder)
    assert _stored(tables) == before


def test_unreadable_records_are_kept_or_refused(spark, tmp_path):
    lake = Lakehouse(spark, str(tmp_path / "lake"))
    header = "review_id,order_id,product_id,rating,review_text,review_time\n"
    good = "".join(f"{i},1,1,5,fine,2024-01-01T00:00:00\n" for i in range(1, 10))
    (tmp_path / "reviews.csv").write_text(header + good + "10,1,1,3.0,fine,2024-01-01T00:00:00\n")
    for share in (0.0, 0.05):
        with pytest.raises(ValueError, match="1 of 10 records.*row 10, rating: '3.0'"):
            pipeline.ingest_csv(lake, "2024-01-15", str(tmp_path), "reviews.csv", most_unreadable=share)
    assert lake.read_optional("bronze", "reviews") is None
    assert pipeline.ingest_csv(lake, "2024-01-15", str(tmp_path), "reviews.csv", most_unreadable=0.1) == 1
    held = lake.read("bronze", "reviews_unreadable").select("row", "column", "value").collect()
    assert [tuple(r) for r in held] == [(10, "rating", "3.0")]
    assert lake.read("bronze", "reviews").where("rating is null").count() == 1
    # Delivered again without the fault.
    (tmp_path / "reviews.csv").write_text(header + good)
    assert pipeline.ingest_csv(lake, "2024-01-15", str(tmp_path), "reviews.csv") == 0
    assert lake.read("bronze", "reviews_unreadable").count() == 0


def test_a_run_that_failed_before_the_mark_is_repeated(spark, sample, tmp_path):
    """Facts stored by day; the second load of the same delivery is an upsert."""
    lake = Lakehouse(spark, str(tmp_path / "lake"))
    args = dict(process_date="2024-01-15", process_ts="2024-01-15 00:00:00")
    shop = Shop(spark, sample, 1)
    for name in ("sessions", "customers"):
        pipeline.ingest_to_bronze(lake, shop.process_date, name, shop.source(name))
        pipeline.clean_silver(lake, shop.process_date, name)
    needed = ("dim_date", "dim_country", "dim_source", "dim_device", "dim_customer", "fact_session")
    for table in needed:
        assert pipeline.build_gold(lake, table=table, **args).full
    pipeline.update_watermark(lake)
    shop = Shop(spark, sample, 2)
    for name in ("sessions", "customers"):
        pipeline.ingest_to_bronze(lake, shop.process_date, name, shop.source(name))
        pipeline.clean_silver(lake, shop.process_date, name)
    args = dict(process_date=LAST_DATE, process_ts=LAST_TS)
    seen = []
    for _ in range(2):
        for table in needed:
            assert pipeline.build_gold(lake, table=table, **args).since == "2024-01-15"
        seen.append(sorted(map(str, lake.read("gold", "fact_session").collect())))
        customers = lake.read("gold", "dim_customer")
        assert customers.where("is_current").select("customer_id").distinct().count() == (
            customers.where("is_current").count()
        )
    assert seen[0] == seen[1]
    assert "date_key=20240120" in str(lake.read("gold", "fact_session").inputFiles())


def test_late_data_sets_and_snapshots_are_taken_up(spark, sample, tmp_path):
    """Reviews come a run late; a customer snapshot comes after its successor."""
    lake = Lakehouse(spark, str(tmp_path / "lake"))
    first, second = Shop(spark, sample, 1), Shop(spark, sample, 2)

    def run(shop, day, names):
        for name in names:
            pipeline.ingest_to_bronze(lake, day, name, shop.source(name))
            pipeline.clean_silver(lake, day, name)

    def build(day, tables):
        return {t: pipeline.build_gold(lake, day, f"{day} 00:00:00", t) for t in tables}

    run(first, "2024-01-15", ["customers", "products", "reviews"])
    assert all(s.full for s in build("2024-01-15", ["dim_category", "dim_product", "dim_customer", "fact_review"]).values())
    pipeline.update_watermark(lake)
    # The next day brings the products alone, the common mark goes on.
    run(second, "2024-01-31", ["products"])
    states = build("2024-01-31", ["dim_category", "dim_product", "dim_customer", "fact_review"])
    assert states["fact_review"].skip and states["dim_customer"].skip and states["dim_product"].since == "2024-01-15"
    pipeline.update_watermark(lake)
    assert pipeline.stored_watermark(lake) == "2024-01-31"
    before = lake.read("gold", "fact_review").count()
    # The reviews of that day, one run late.
    run(second, "2024-01-31", ["reviews"])
    assert build("2024-01-31", ["fact_review"])["fact_review"].since == "2024-01-15"
    assert lake.read("gold", "fact_review").count() > before
    pipeline.update_watermark(lake)
    assert build("2024-01-31", ["fact_review"])["fact_review"].skip

    # Customers of the 31st, then those of the 20th.
    run(second, "2024-01-31", ["customers"])
    build("2024-01-31", ["dim_customer"])
    pipeline.update_watermark(lake)
    run(first, "2024-01-20", ["customers"])
    assert lake.read("silver", "customers").select("processed_date").distinct().count() == 1
    want = sorted(map(str, lake.read("gold", "dim_customer").drop("customer_key").collect()))
    assert build("2024-01-20", ["dim_customer"])["dim_customer"].since == "2024-01-20"
    # They say what those of the 15th said.
    assert sorted(map(str, lake.read("gold", "dim_customer").drop("customer_key").collect())) == want
    assert build("2024-01-20", ["dim_customer"])["dim_customer"].skip
    # Those of the 25th differ: versions that end on the 31st.
    run(second, "2024-01-25", ["customers"])
    build("2024-01-25", ["dim_customer"])
    history = lake.read("gold", "dim_customer").where("name is not null")
    assert history.where("effective_from = '2024-01-31 00:00:00'").isEmpty()
    changed = history.where("effective_from = '2024-01-25 00:00:00'")
    assert not changed.isEmpty() and changed.where("is_current").count() == changed.count()

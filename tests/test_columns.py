from __future__ import annotations

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from tidemark.functions import (
    attribute_hash,
    blank_to_null,
    format_timestamp,
    iso_timestamp,
    cents,
    money,
    parse_flag,
    seconds_between,
)
from tidemark.operators.columns import add_date_alias, fill_unknown, normalize_columns, safe_trim
from tidemark.plans.bronze import add_quality_flags, add_record_id, to_bronze, valid_records
from tidemark.sources.datasets import DATASETS, dataset
from tidemark.operators.staging import stage
from tidemark.sources.files import check_date, check_file_name, read_csv, scan_csv, unreadable_values


def _texts(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x string").coalesce(1)


def _column(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_blank_to_null(spark):
    df = _texts(spark, [" a b ", "", "   ", None, "\t"])
    assert _column(df, blank_to_null("x")) == ["a b", None, None, None, "\t"]


def test_parse_flag(spark):
    df = _texts(spark, ["TRUE", "1", "Yes", "false", "0", "NO", "y", "", None])
    assert _column(df, parse_flag("x")) == [True] * 3 + [False] * 3 + [None] * 3


def test_iso_timestamp_is_strict_and_zone_free(spark):
    df = _texts(spark, ["2024-03-10T02:30:00", "2024-3-10T02:30:00", "2024-03-10T25:00:00", None])
    # 02:30 does not exist in the session zone of the tests on that day.
    assert _column(df, iso_timestamp("x")) == [dt.datetime(2024, 3, 10, 2, 30), None, None, None]
    assert _column(df, format_timestamp(iso_timestamp("x")))[0] == "2024-03-10 02:30:00"


def test_seconds_between_ignores_daylight_saving(spark):
    df = spark.sql("select timestamp_ntz'2024-03-10T01:30:00' a, timestamp_ntz'2024-03-10T03:30:01' b")
    assert df.select(seconds_between("a", "b")).first()[0] == 7201
    assert df.select(seconds_between("b", "a")).first()[0] == -7201


def test_money_is_exact_or_null(spark):
    df = spark.createDataFrame([(1.005,), (2e14,), (0.00004,), (1e20,), (1e-9,), (None,)], "x double").coalesce(1)
    assert [v and float(v) for v in _column(df, money("x"))] == [1.005, 2e14, 0.00004, None, None, None]


def test_no_amount_is_lost(spark):
    df = spark.createDataFrame([(2e14, 1.0), (1e20, 2.0), (0.00004, None)], "x double, y double").coalesce(1)
    got = _column(df, cents(money("x") - money("y"), F.col("x") - F.col("y")))
    assert got == [199999999999999.0, 1e20, None]


def test_attribute_hash(spark):
    df = spark.createDataFrame([("a", None, 3)], "x string, y string, z int")
    expected = hashlib.sha256(b"a||__NULL__||3").hexdigest()
    assert _column(df, attribute_hash(["x", "y", "z"])) == [expected]


def test_normalize_columns(spark):
    df = spark.createDataFrame([(1, 2)], "` Order ID ` int, PRICE int")
    assert normalize_columns(df).columns == ["order_id", "price"]


def test_trim_fill_and_alias_skip_absent_columns(spark):
    df = _texts(spark, [" "])
    assert safe_trim(df, ["x", "y"]).first()[0] is None
    assert fill_unknown(safe_trim(df, ["x"]), ["x"]).first()[0] == "Unknown"
    assert safe_trim(df, ["y"]) is df
    assert add_date_alias(df, {"d": "missing"}).columns == ["x"]
    aliased = add_date_alias(df, {"d": "x", "x": "x"})
    assert aliased.columns == ["x", "d"]


def test_record_ids(spark):
    items = spark.createDataFrame(
        [(1, 2), (1, None), (None, None)], "order_id bigint, product_id bigint"
    ).coalesce(1)
    flagged = add_quality_flags(add_record_id(items, "order_items"))
    assert [tuple(r)[2:] for r in flagged.collect()] == [
        ("1_2", "order_id_product_id", None, True),
        ("1", "order_id_product_id", None, True),
        ("", "order_id_product_id", "EMPTY RECORD ID", False),
    ]
    assert valid_records(flagged).count() == 2
    missing = add_quality_flags(add_record_id(items.drop("product_id"), "order_items")).first()
    assert (missing["record_id"], missing["record_id_source"]) == (None, "NOT FOUND")
    assert missing["error"] == "NULL RECORD ID"
    assert add_record_id(items, "elsewhere").first()["record_id_source"] == "NOT FOUND"


def test_bronze_columns_on_empty_input(spark):
    empty = spark.createDataFrame([], DATASETS["orders"].struct)
    bronze = to_bronze(empty, "orders", "2024-01-31")
    assert bronze.columns[-7:] == [
        "record_id",
        "record_id_source",
        "error",
        "is_valid_record_id",
        "ingest_date",
        "ingestion_timestamp",
        "source_file",
    ]
    assert bronze.count() == 0


def test_csv(spark, tmp_path):
    # By position, whatever the header says; a bad number becomes NULL.
    (tmp_path / "reviews.csv").write_text(
        "Rating,Product ID,order_id,review_id,text,time\n"
        '1,2,3,5,"fine, thanks",2024-01-01T00:00:00\n'
        "x,2,2.5,,,\n"
    )
    rows = read_csv(spark, str(tmp_path), "reviews.csv", by_position=True).coalesce(1).collect()
    assert tuple(rows[0])[:6] == (1, 2, 3, 5, "fine, thanks", "2024-01-01T00:00:00")
    assert tuple(rows[1])[:6] == (None, 2, None, None, None, None)
    assert rows[0]["source_file"].endswith("/reviews.csv")
    with pytest.raises(ValueError, match="has columns rating, product_id"):
        read_csv(spark, str(tmp_path), "reviews.csv")
    with pytest.raises(FileNotFoundError):
        read_csv(spark, str(tmp_path), "orders.csv")
    with pytest.raises(ValueError, match="unknown data set"):
        read_csv(spark, str(tmp_path), "reviews.csv", "nothing")


def test_columns_bind_by_name(spark, tmp_path):
    (tmp_path / "reviews.csv").write_text("Rating, Product ID ,order_id,review_id,review_time,review_text\n5,2,3,4,then,text\n")
    row = read_csv(spark, str(tmp_path), "reviews.csv").first()
    assert tuple(row)[:6] == (4, 3, 2, 5, "text", "then")


def test_unreadable_values_are_reported(spark, tmp_path):
    header = "order_id,product_id,unit_price_usd,quantity,line_total_usd\n"
    good = "".join(f"{i},1,2.5, 3 ,7.5\n" for i in range(5000))
    (tmp_path / "order_items.csv").write_text(header + good + "7,8,x,3.0,\n" + good + "1,2,3\n9,9,1,1,1,1\n,,,,\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")  # several splits
    spark.conf.set("spark.sql.files.openCostInBytes", "1000")
    try:
        scan = stage(scan_csv(spark, str(tmp_path), "order_items.csv"), "scan")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert scan.select("split").distinct().count() > 3
    assert scan.where("quantity = 3").count() == 10_000
    found = unreadable_values(scan, "order_id").drop("source_file").collect()
    assert sorted(map(tuple, found), key=str) == sorted(
        [(5001, 7, "quantity", "3.0"), (5001, 7, "unit_price_usd", "x"), (10002, 1, None, "1,2,3"), (10003, 9, None, "9,9,1,1,1,1")],
        key=str,
    )


@pytest.mark.parametrize("text", ["2024-1-1", "20240101", "2024-02-30", "", None])
def test_dates_are_checked(text):
    with pytest.raises(ValueError):
        check_date(text)


@pytest.mark.parametrize("name", ["", "a.txt", "../a.csv", "b/a.csv", "b\\a.csv", "."])
def test_file_names_are_checked(name):
    with pytest.raises(ValueError):
        check_file_name(name)


def test_datasets():
    assert check_date("2024-01-31") == "2024-01-31"
    assert check_file_name("a.csv") == "a.csv"
    assert len(DATASETS) == 7
    assert all(f.nullable for d in DATASETS.values() for f in d.struct)
    with pytest.raises(ValueError, match="unknown data set"):
        dataset("nothing")

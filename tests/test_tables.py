"""Stored tables, the high-water mark and the build decision."""

from __future__ import annotations

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from tidemark.operators import staging
from tidemark.operators.history import build_scd2_dimension, history_change
from tidemark.operators.staging import stage
from tidemark.plans import incremental, pipeline
from tidemark.plans.incremental import BuildState, resolve_build_state
from tidemark.sources import tables
from tidemark.sources.tables import Lakehouse


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def lake(spark, tmp_path):
    return Lakehouse(spark, str(tmp_path / "lake"))


def _frame(spark, data, schema="k int, v string, p int"):
    return spark.createDataFrame(data, schema)


def test_a_table_can_be_rewritten_from_itself(spark, lake):
    assert lake.read_optional("gold", "t") is None
    with pytest.raises(RuntimeError, match="gold.t does not exist"):
        lake.read("gold", "t")
    assert not lake.has_rows("gold", "t")
    lake.overwrite(_frame(spark, [(1, "a", 1)]), "gold", "t")
    table = lake.read("gold", "t")
    lake.overwrite(table.withColumn("w", F.lit(2)), "gold", "t")
    assert rows(lake.read("gold", "t")) == [(1, "a", 1, 2)]
    lake.overwrite(table.limit(0), "gold", "t")
    assert not lake.has_rows("gold", "t")


def test_superseded_versions_go(spark, lake):
    path = lake.folder("gold", "t")
    for n in range(1, 7):
        lake.overwrite(_frame(spark, [(n, "a", 1)]), "gold", "t")
        if n == 3:
            os.makedirs(f"{path}/v4")  # a write that died
    held = sorted(x for x in os.listdir(path) if x.startswith("v"))
    assert held == ["v5", "v6", "v7"] and rows(lake.read("gold", "t")) == [(6, "a", 1)]


def test_an_unfinished_version_is_not_read(spark, lake):
    lake.overwrite(_frame(spark, [(1, "a", 1)]), "gold", "t")
    os.makedirs(lake.folder("gold", "t") + "/v2")
    assert lake.location("gold", "t").endswith("/v1")
    lake.overwrite(_frame(spark, [(2, "b", 1)]), "gold", "t")
    assert lake.location("gold", "t").endswith("/v3")
    with pytest.raises(ValueError, match="unknown layer"):
        lake.folder("lead", "t")


def test_replacing_a_partition_is_idempotent(spark, lake):
    first = _frame(spark, [(1, "a"), (2, "b")], "k int, v string")
    second = _frame(spark, [(3, "c")], "k int, v string")
    lake.replace_partition(first, "bronze", "t", "d", "2024-01-01")
    for _ in range(2):
        lake.replace_partition(second, "bronze", "t", "d", "2024-01-02")
    lake.replace_partition(first.where("k = 1"), "bronze", "t", "d", "2024-01-01")
    one, two = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    assert rows(lake.read("bronze", "t")) == [(1, "a", one), (3, "c", two)]
    lake.replace_partition(first.limit(0), "bronze", "t", "d", "2024-01-01")
    assert rows(lake.read("bronze", "t")) == [(3, "c", two)]


@pytest.mark.parametrize("partition_by", [None, "p"])
def test_merge(spark, lake, partition_by):
    lake.merge(
        _frame(spark, [(1, "a", 10), (2, "b", 10), (3, "c", 20), (4, "d", None)]),
        "gold",
        "t",
        ["k"],
        partition_by,
    )
    # 1 moves, 3 was alone in its partition and moves, 4 leaves the NULL partition, 5 is new
    sent = _frame(spark, [(1, "A", 30), (3, "C", 10), (4, "D", 30), (5, "E", None)])
    expected = [(1, "A", 30), (2, "b", 10), (3, "C", 10), (4, "D", 30), (5, "E", None)]
    for _ in range(2):
        lake.merge(sent, "gold", "t", ["k"], partition_by)
        assert rows(lake.read("gold", "t").select("k", "v", "p")) == expected


def test_merge_leaves_other_partitions_untouched(spark, lake):
    lake.merge(_frame(spark, [(1, "a", 10), (2, "b", 20)]), "gold", "t", ["k"], "p")
    folder = lake.location("gold", "t")
    before = os.listdir(f"{folder}/p=20")
    lake.merge(_frame(spark, [(1, "A", 10), (3, "c", 10)]), "gold", "t", ["k"], "p")
    assert os.listdir(f"{folder}/p=20") == before
    assert rows(lake.read("gold", "t").select("k", "v", "p")) == [(1, "A", 10), (2, "b", 20), (3, "c", 10)]


def test_merge_of_new_partitions_only(spark, lake):
    lake.merge(_frame(spark, [(1, "a", 10)]), "gold", "t", ["k"], "p", one_partition=True)
    lake.merge(_frame(spark, [(2, "b", 20)]), "gold", "t", ["k"], "p")
    lake.merge(_frame(spark, [(3, "c", 30), (4, "d", 40)]), "gold", "t", ["k"], "p")
    expected = [(1, "a", 10), (2, "b", 20), (3, "c", 30), (4, "d", 40)]
    assert rows(lake.read("gold", "t").select("k", "v", "p")) == expected
    lake.merge(_frame(spark, [], "k int, v string, p int"), "gold", "t", ["k"], "p")
    assert rows(lake.read("gold", "t").select("k", "v", "p")) == expected


@pytest.mark.parametrize("partition_by", [None, "p"])
def test_merge_retracts_within_its_scope(spark, lake, partition_by):
    lake.overwrite(_frame(spark, [(1, "a", 1), (2, "a", 2), (3, "b", 2), (4, "c", 3), (5, None, 3)]), "gold", "t", partition_by)
    again = _frame(spark, [(2, "x", 3), (6, "b", 1)])
    scope = _frame(spark, [("a",), ("b",), ("b",), ("unknown",), (None,)], "v string")
    for _ in range(2):
        lake.merge(again, "gold", "t", ["k"], partition_by, retract=scope)
        # 1 and 3 are within the scope and do not come again; NULL equals nothing.
        want = [(2, "x", 3), (4, "c", 3), (5, None, 3), (6, "b", 1)]
        assert rows(lake.read("gold", "t").select("k", "v", "p")) == want
    lake.merge(again.limit(0), "gold", "t", ["k"], partition_by, retract=_frame(spark, [("b",)], "v string"))
    assert rows(lake.read("gold", "t").select("k")) == [(2,), (4,), (5,)]


def test_ambiguous_merge_changes_nothing(spark, lake):
    lake.merge(_frame(spark, [(1, "a", 10)]), "gold", "t", ["k"], "p")
    for partition_by in (None, "p"):
        with pytest.raises(ValueError, match="several source rows"):
            lake.merge(_frame(spark, [(1, "x", 10), (1, "y", 10)]), "gold", "t", ["k"], partition_by)
    assert rows(lake.read("gold", "t").select("k", "v")) == [(1, "a")]


def test_gold_tables_appear_in_the_catalog(spark, tmp_path):
    lake = Lakehouse(spark, str(tmp_path / "lake"), database="shop_test")
    lake.overwrite(_frame(spark, [(1, "a", 1)]), "gold", "plain")
    lake.overwrite(_frame(spark, [(1, "a", 1), (2, "b", 2)]), "gold", "parts", "p")
    lake.overwrite(_frame(spark, [(1, "a", 1)]), "silver", "hidden")
    assert spark.table("shop_test.plain").count() == 1
    assert spark.table("shop_test.parts").where("p = 2").count() == 1
    assert not spark.catalog.tableExists("shop_test.hidden")
    lake.overwrite(_frame(spark, [(1, "a", 1), (2, "b", 1)]), "gold", "plain")
    lake.merge(_frame(spark, [(3, "c", 3)]), "gold", "parts", ["k"], "p")
    assert spark.table("shop_test.plain").count() == 2
    assert spark.table("shop_test.parts").count() == 3
    spark.sql("DROP DATABASE shop_test CASCADE")
    assert lake.read("gold", "parts").count() == 3


def test_staging_folder_comes_from_the_session(spark):
    assert staging.staging_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


class _Session:
    """A session without a checkpoint folder."""

    def __init__(self, master):
        self.master, self.folder, self.sparkContext, self.conf = master, None, self, self

    def get(self, key, default):
        return default

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_only_a_local_master_may_stage_in_a_temporary_folder():
    local = _Session("local[2]")
    assert staging.staging_root(local) == staging.staging_root(local)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        staging.staging_root(_Session("yarn"))


def test_tables_of_a_run_are_deleted_at_its_end(spark):
    with staging.staging_run(spark):
        with staging.staging_run(spark):
            inside = staging.stage(spark.range(3))
        path = inside.inputFiles()[0].removeprefix("file://")
        assert inside.count() == 3 and os.path.exists(path)
    assert not os.path.exists(path)
    assert spark.conf.get(staging.RUN, None) is None


def test_a_run_frees_the_disk_of_finished_steps(spark, tmp_path):
    """Staged tables go with their step, shuffle files with their query."""
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        blocks = disk.getAllBlocks().mkString(" ").split()
        return {b for b in blocks if b.startswith("shuffle_")}

    setting, before = spark.conf.get(staging.CLEANUP), shuffled()
    with staging.staging_run(spark):
        with staging.staging_step(spark):
            with staging.staging_step(spark):
                inside = staging.stage(spark.range(100).repartition(3, "id"))
            (file,) = {os.path.dirname(f.removeprefix("file://")) for f in inside.inputFiles()}
            assert inside.count() == 100
        assert not os.path.exists(os.path.dirname(file))
        spark.range(100).repartition(3, "id").write.parquet(str(tmp_path / "t"))
        for _ in range(50):
            if not shuffled() - before:
                break
            time.sleep(0.1)
        assert not shuffled() - before
        assert os.path.exists(staging.stage(spark.range(1)).inputFiles()[0].removeprefix("file://"))
    assert spark.conf.get(staging.CLEANUP) == setting


def test_partition_values_come_from_the_listing(spark, lake):
    assert lake.partition_values("silver", "t", "p") is None
    lake.overwrite(_frame(spark, [(1, "a", 10), (2, "b", 20)]), "silver", "t", "p")
    assert sorted(lake.partition_values("silver", "t", "p")) == ["10", "20"]
    assert lake.partition_values("silver", "t", "v") is None


# --- high-water mark --------------------------------------------------------------


@pytest.mark.parametrize(
    "has_data, latest, mark, expected",
    [
        (False, None, None, BuildState(full=True)),
        (False, "2024-01-02", "2024-01-02", BuildState(full=True)),
        (True, None, "2024-01-01", BuildState(skip=True)),
        (True, "2024-01-02", None, BuildState(full=True)),
        (True, "2024-01-02", "2024-01-02", BuildState(skip=True)),
        (True, "2024-01-01", "2024-01-02", BuildState(skip=True)),
        (True, "2024-01-03", "2024-01-02", BuildState(since="2024-01-02")),
    ],
)
def test_build_decision(has_data, latest, mark, expected):
    assert resolve_build_state(has_data, latest, mark) == expected


def test_reads_by_processing_date(spark):
    df = spark.sql(
        "select id, date_add(date'2024-01-01', cast(id as int)) as processed_date from range(4)"
    )
    assert [r[0] for r in incremental.read_since(df, "2024-01-02").orderBy("id").collect()] == [2, 3]
    assert [r[0] for r in incremental.read_on(df, "2024-01-02").collect()] == [1]
    assert incremental.read_on(df).count() == 4
    assert incremental.read_since(df.drop("processed_date"), "2024-01-02").count() == 0
    latest = incremental.latest_process_date([df, df.limit(0), df.drop("processed_date")])
    assert latest.first()[0] == dt.date(2024, 1, 4)


def test_watermark_advances(spark, lake):
    assert pipeline.stored_watermark(lake) is None
    assert pipeline.latest_silver_date(lake) is None
    pipeline.update_watermark(lake)
    assert pipeline.stored_watermark(lake) is None
    for day in ("2024-01-15", "2024-01-31"):
        silver = spark.sql(f"select 1 as order_id, date'{day}' as processed_date")
        lake.overwrite(silver, "silver", "orders")
        pipeline.update_watermark(lake)
        assert pipeline.stored_watermark(lake) == day
    assert lake.read("gold", pipeline.WATERMARK).count() == 1


def test_names_are_checked(lake):
    with pytest.raises(ValueError, match="unknown Gold table"):
        pipeline.build_gold(lake, "2024-01-31", "2024-01-31 00:00:00", "fact_nothing")
    with pytest.raises(ValueError, match="not a date"):
        pipeline.build_gold(lake, "31.01.2024", "2024-01-31 00:00:00", "dim_date")
    with pytest.raises(ValueError, match="unknown data set"):
        pipeline.clean_silver(lake, "2024-01-31", "nothing")
    with pytest.raises(RuntimeError, match="silver.customers does not exist"):
        pipeline.build_gold(lake, "2024-01-31", "2024-01-31 00:00:00", "dim_customer")


def test_empty_partitioned_tables_keep_their_schema(spark, lake):
    empty = spark.sql("select 1 as id, date'2024-01-01' as day").limit(0)
    lake.overwrite(empty, "silver", "t", "day")
    assert lake.read("silver", "t").columns == ["id", "day"] and not lake.has_rows("silver", "t")
    lake.replace_partition(empty.drop("day"), "bronze", "t", "day", "2024-01-01")
    assert not lake.has_rows("bronze", "t")
    lake.replace_partition(spark.sql("select 7 as id"), "bronze", "t", "day", "2024-01-01")
    lake.replace_partition(empty.drop("day"), "bronze", "t", "day", "2024-01-01")
    assert lake.read("bronze", "t").count() == 0


def test_new_columns_survive_later_merges(spark, lake):
    old, new = "select {} as id, 1 as v, 10 as p", "select {} as id, 2 as v, 10 as p, 'x' as w"
    lake.merge(spark.sql(old.format(1)), "silver", "t", ["id"], "p")
    lake.merge(spark.sql(new.format(2)), "silver", "t", ["id"], "p")
    lake.merge(spark.sql(old.format(3)), "silver", "t", ["id"], "p")
    rows = {r.id: (r.v, r.w) for r in lake.read("silver", "t").collect()}
    assert rows == {1: (1, None), 2: (2, "x"), 3: (1, None)}


def test_replays_change_nothing(spark, lake):
    """Rows with NULL keys are not doubled, and an old day does not undo a newer one."""

    def deliver(day, *rows):
        df = spark.createDataFrame(rows, "id int, part int, v string")
        df = df.selectExpr("*", f"date'{day}' as processed_date")
        lake.merge(
            df, "silver", "t", ["id", "part"], "processed_date", False, True, ordered_value=day
        )

    first = [(1, 1, "a"), (2, None, "b"), (3, 1, "c")]
    deliver("2024-01-01", *first)
    deliver("2024-01-02", (1, 1, "new"), (2, None, "b2"))
    before = sorted(map(str, lake.read("silver", "t").collect()))
    assert len(before) == 4
    deliver("2024-01-01", *first)
    deliver("2024-01-02", (1, 1, "new"), (2, None, "b2"))
    assert sorted(map(str, lake.read("silver", "t").collect())) == before


def test_ordered_merges_write_rows_that_stay_once(spark, lake, monkeypatch):
    """They are not staged on the way; partitions that lose their last row go, others are left as they are."""
    labels = []
    monkeypatch.setattr(tables, "stage", lambda df, label: labels.append(label) or stage(df, label))

    def deliver(day, data, schema="k int, v string"):
        df = spark.createDataFrame(data, schema).selectExpr("k", "v", f"date'{day}' as d", *(["w"] if "w" in schema else []))
        lake.merge(df, "silver", "t", ["k"], "d", False, True, ordered_value=day)

    deliver("2024-01-01", [(1, "a"), (2, "b"), (None, "n")])
    deliver("2024-01-02", [(3, "c")])
    deliver("2024-01-03", [(4, "d"), (5, "e")])
    deliver("2024-01-04", [(6, "f")])
    folder = lake.location("silver", "t")
    untouched = os.listdir(f"{folder}/d=2024-01-04")
    for _ in range(2):
        deliver("2024-01-05", [(1, "A", 7), (3, "C", 8), (4, "D", 9)], "k int, v string, w int")
    assert rows(lake.read("silver", "t").selectExpr("k", "v", "day(d)", "w")) == [
        (1, "A", 5, 7), (2, "b", 1, None), (3, "C", 5, 8), (4, "D", 5, 9), (5, "e", 3, None), (6, "f", 4, None), (None, "n", 1, None)
    ]
    assert not os.path.exists(f"{folder}/d=2024-01-02") and os.listdir(f"{folder}/d=2024-01-04") == untouched
    # A source that lacks a column leaves it as it is.
    deliver("2024-01-06", [(1, "a6"), (2, "b6")])
    assert rows(lake.read("silver", "t").where("k < 3").selectExpr("k", "v", "day(d)", "w")) == [(1, "a6", 6, 7), (2, "b6", 6, None)]
    assert labels.count("merge-partitions") == 1 and set(labels) == {"merge-incoming", "merge-partitions"}


def test_a_delivery_is_computed_once(spark, lake, monkeypatch):
    first = spark.sql("select 1 as k")
    lake.replace_partition(first, "bronze", "t", "d", "2024-01-01")
    lake.replace_partition(first, "bronze", "t", "d", "2024-01-02")
    monkeypatch.setattr(type(first), "isEmpty", lambda self: pytest.fail("the delivery was computed to see whether it has rows"))
    lake.replace_partition(spark.sql("select 2 as k"), "bronze", "t", "d", "2024-01-02")
    lake.replace_partition(first.limit(0), "bronze", "t", "d", "2024-01-01")
    assert rows(lake.read("bronze", "t")) == [(2, dt.date(2024, 1, 2))]


def test_a_missing_snapshot_is_refused(spark, lake):
    lake.replace_partition(spark.sql("select 1 as customer_id"), "bronze", "customers", "ingest_date", "2024-01-01")
    with pytest.raises(RuntimeError, match="no delivery of customers"):
        pipeline.clean_silver(lake, "2024-01-02", "customers")


def test_histories_are_written_by_change(spark, lake, monkeypatch):
    monkeypatch.setattr(tables, "BUCKET_ROWS", 10)
    args = ("id", "sk", ["a"])
    stamps = [f"2024-0{n}-01 00:00:00" for n in range(1, 6)]

    def snapshot(**changed):
        data = [(i, changed.get(f"k{i}", "same")) for i in range(100)]
        return spark.createDataFrame(data, "id int, a string")

    def files():
        return set(lake.read("gold", "h").inputFiles())

    want = build_scd2_dimension(snapshot(), *args, stamps[0])
    lake.write_history(want, "gold", "h", "id")
    assert len(lake.partition_values("gold", "h", tables.SLICE)) == 10
    steps = [(stamps[1], {"k7": "new"}), (stamps[2], {"k7": "new"}), (stamps[4], {"k7": "newer", "k8": "new"})]
    for stamp, changed in [*steps, (stamps[3], {"k9": "late"}), (stamps[3], {"k9": "late"})]:
        later = [(i, stamps[4]) for i in range(100)] if stamp == stamps[3] else []
        seen = spark.createDataFrame(later, "id int, seen string") if later else None
        held, before = lake.read("gold", "h"), files()
        change = history_change(snapshot(**changed), *args, stamp, held, seen)
        lake.update_history(change.gone, change.rows, "gold", "h", "id", "sk")
        written = files() - before
        # A run writes its closed slice and the buckets of the keys that changed.
        assert len(written) <= 2 * max(1, len(changed)) + (3 if later else 0)
        if stamp == stamps[2]:
            assert not written
        want = stage(build_scd2_dimension(snapshot(**changed), *args, stamp, want, seen), "want")
        assert rows(lake.read("gold", "h").select(want.columns)) == rows(want)
    assert lake.read("gold", "h").columns == want.columns

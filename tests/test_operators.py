"""Keyed operators: deduplication, keys, merges, history, dimensions, lead."""

from __future__ import annotations

import datetime as dt
import itertools
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators.dedupe import dedupe_latest
from tidemark.operators.dimensions import (
    build_static_dimension,
    build_static_dimensions,
    distinct_values,
    new_values,
)
from tidemark.operators.history import build_scd2_dimension, current_rows, detect_changes
from tidemark.operators.keys import assign_keys, max_key
from tidemark.operators.lookup import attach_dimension, attach_dimension_key
from tidemark.operators.merge import merge_preserving_keys, merge_upsert
from tidemark.operators.sequence import next_in_group
from tidemark.operators.staging import stage
from tidemark.plans.facts import event_duration

few = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# --- deduplication ----------------------------------------------------------------


def test_latest_row_wins_and_ties_are_settled(spark):
    df = spark.createDataFrame(
        [(1, 5, "a"), (1, 7, "b"), (1, None, "z"), (2, 3, "x"), (2, 3, "y"), (3, None, "n")],
        "k int, t int, v string",
    )
    expected = [(1, 7, "b"), (2, 3, "y"), (3, None, "n")]
    for parts in (1, 3, 6):
        assert rows(dedupe_latest(df.repartition(parts), ["k"], ["t"])) == expected


def test_null_key_parts_form_their_own_group(spark):
    df = spark.createDataFrame([(1, None, 1), (1, None, 2), (1, 1, 3)], "a int, b int, t int")
    assert rows(dedupe_latest(df, ["a", "b"], ["t"])) == [(1, 1, 3), (1, None, 2)]


def test_dedupe_on_keys_alone_and_on_nothing(spark):
    df = spark.createDataFrame([(1,), (1,)], "k int")
    assert dedupe_latest(df, ["k"], ["absent"]).count() == 1
    assert dedupe_latest(df.limit(0), ["k"]).count() == 0


@few
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 3), st.integers(0, 3)), min_size=1))
def test_dedupe_keeps_one_maximum_per_key(spark, data):
    df = spark.createDataFrame(data, "k int, t int, v int")
    expected = sorted({k: max(r for r in data if r[0] == k) for k, _, _ in data}.values(), key=str)
    assert rows(dedupe_latest(df, ["k"], ["t"])) == expected


# --- surrogate keys ---------------------------------------------------------------


def test_keys_are_dense_and_ordered_over_many_partitions(spark):
    ids = list(range(0, 5000, 3))
    random.Random(1).shuffle(ids)
    df = spark.createDataFrame([(i, i % 7) for i in ids], "id int, v int").repartition(9)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        keyed = assign_keys(df, "k", ["id"], start_at=10)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert keyed.columns == ["k", "id", "v"]
    got = sorted((r["id"], r["k"]) for r in keyed.collect())
    assert got == [(i, n + 11) for n, i in enumerate(sorted(ids))]
    assert max_key(keyed, "k") == 10 + len(ids)


def test_keys_of_nothing(spark):
    df = spark.createDataFrame([], "id int")
    assert assign_keys(df, "k", ["id"]).collect() == []
    assert max_key(assign_keys(df, "k", ["id"]), "k") == 0


def test_keys_when_one_leading_value_dominates(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") < 2500, 1).otherwise(F.col("id")).alias("a"), F.col("id").alias("b")
    )
    keyed = assign_keys(df, "k", ["a", "b"])
    assert keyed.where("k <> b + 1").count() == 0


# --- merges -----------------------------------------------------------------------


def _table(spark, data, schema="k int, v string"):
    return spark.createDataFrame(data, schema)


def test_upsert_follows_merge_semantics(spark):
    target = _table(spark, [(1, "a"), (2, "b"), (None, "n")])
    source = _table(spark, [(2, "B"), (3, "C"), (None, "N")])
    merged = merge_upsert(target, source, ["k"])
    assert rows(merged) == rows(
        _table(spark, [(1, "a"), (2, "B"), (3, "C"), (None, "n"), (None, "N")])
    )


def test_upsert_twice_is_upsert_once(spark):
    target = _table(spark, [(1, "a"), (2, "b")])
    source = _table(spark, [(2, "B"), (3, "C")])
    once = merge_upsert(target, source, ["k"])
    assert rows(merge_upsert(once, source, ["k"])) == rows(once)
    assert rows(merge_upsert(target, source.limit(0), ["k"])) == rows(target)
    assert rows(merge_upsert(target.limit(0), source, ["k"])) == rows(source)


def test_ambiguous_matches_are_refused(spark):
    target = _table(spark, [(1, "a")])
    with pytest.raises(ValueError, match="several source rows"):
        merge_upsert(target, _table(spark, [(1, "x"), (1, "y")]), ["k"])
    # Repeated keys that match nothing are plain inserts.
    assert merge_upsert(target, _table(spark, [(2, "x"), (2, "y")]), ["k"]).count() == 3


def test_columns_may_come_and_go(spark):
    target = _table(spark, [(1, "a", 1.0), (2, "b", 2.0), (None, "n", 0.0)], "k int, v string, old double")
    wider = _table(spark, [(2, "B", 9.0, "new"), (3, None, 8.0, "new")], "k int, v string, old double, more string")
    assert merge_upsert(target, wider, ["k"]).columns == ["k", "v", "old", "more"]
    assert (1, "a", 1.0, None) in rows(merge_upsert(target, wider, ["k"]))
    narrower = _table(spark, [(2, None), (3, "C"), (None, "N")])
    assert rows(merge_upsert(target, narrower, ["k"])) == sorted(
        [(1, "a", 1.0), (2, None, 2.0), (3, "C", None), (None, "n", 0.0), (None, "N", None)], key=str
    )


def test_known_business_keys_keep_their_surrogates(spark):
    target = _table(spark, [(5, 1, "a"), (9, 2, "b")], "sk bigint, k int, v string")
    sent = _table(spark, [(4, "D"), (2, "B"), (3, "C")])
    merged = merge_preserving_keys(target, sent, ["k"], "sk")
    assert rows(merged) == [(10, 3, "C"), (11, 4, "D"), (5, 1, "a"), (9, 2, "B")]
    again = merge_preserving_keys(merged, sent, ["k"], "sk")
    assert rows(again) == rows(merged)


def test_upsert_retracts_a_scope_beside_the_key(spark):
    target = _table(spark, [(7, 1, "a"), (8, 2, "b"), (9, 3, "b"), (6, 4, None), (5, None, "b")], "sk bigint, k int, v string")
    sent = _table(spark, [(2, "b"), (5, "b"), (1, "c")])
    # Scopes may repeat themselves; NULLs in scope or key match nothing.
    scope = _table(spark, [("b",), ("b",), ("c",), (None,)], "v string")
    merged = merge_preserving_keys(target, sent, ["k"], "sk", scope)
    assert rows(merged) == [(10, 5, "b"), (5, None, "b"), (6, 4, None), (7, 1, "c"), (8, 2, "b")]
    assert rows(merge_preserving_keys(target, sent.limit(0), ["k"], "sk", scope)) == [
        (5, None, "b"), (6, 4, None), (7, 1, "a")
    ]


@few
@given(
    st.dictionaries(st.integers(0, 9), st.text("ab", max_size=2)),
    st.dictionaries(st.integers(0, 9), st.text("ab", max_size=2)),
)
def test_upsert_equals_dict_update(spark, held, sent):
    merged = merge_upsert(_table(spark, list(held.items())), _table(spark, list(sent.items())), ["k"])
    assert rows(merged) == sorted({**held, **sent}.items(), key=str)


# --- history ----------------------------------------------------------------------

FIRST, SECOND, THIRD = "2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00"


def _apply(spark, snapshot, stamp, existing=None, schema="id int, a string, b string"):
    frame = spark.createDataFrame(snapshot, schema)
    return build_scd2_dimension(frame, "id", "sk", ["a", "b"], stamp, existing)


def test_history_over_three_snapshots(spark):
    one = _apply(spark, [(1, "x", None), (2, "y", "q"), (3, "z", "r")], FIRST)
    assert rows(one) == [
        (1, 1, "x", None, FIRST, None, True),
        (2, 2, "y", "q", FIRST, None, True),
        (3, 3, "z", "r", FIRST, None, True),
    ]
    # 1 unchanged (NULL equals NULL), 2 changed, 3 missing, 4 new
    two = _apply(spark, [(1, "x", None), (2, "y", None), (4, "w", "s")], SECOND, one)
    assert rows(two) == [
        (1, 1, "x", None, FIRST, None, True),
        (2, 2, "y", "q", FIRST, SECOND, False),
        (3, 3, "z", "r", FIRST, None, True),
        (4, 2, "y", None, SECOND, None, True),
        (5, 4, "w", "s", SECOND, None, True),
    ]
    # 2 goes back to what it was: a third version, the history stays
    three = _apply(spark, [(2, "y", "q")], THIRD, two)
    assert (6, 2, "y", "q", THIRD, None, True) in rows(three)
    assert (4, 2, "y", None, SECOND, THIRD, False) in rows(three)
    assert (2, 2, "y", "q", FIRST, SECOND, False) in rows(three)
    assert three.count() == 6
    same = _apply(spark, [(2, "y", "q")], "2024-04-01 00:00:00", three)
    assert rows(same) == rows(three)


def _history(spark, order, snapshots, stamps):
    """Snapshots applied in some order; surrogates left out."""
    table = None
    for n, i in enumerate(order):
        frame = spark.createDataFrame(snapshots[i], "id int, a string, b string")
        seen = [(r[0], stamps[j]) for j in order[:n] for r in snapshots[j]]
        later = spark.createDataFrame(seen, "id int, seen string") if seen else None
        table = stage(build_scd2_dimension(frame, "id", "sk", ["a", "b"], stamps[i], table, later), "history")
    keys = [r["sk"] for r in table.collect()]
    assert len(set(keys)) == len(keys)
    return rows(table.drop("sk"))


def test_snapshots_in_any_order_end_in_one_history(spark):
    stamps = [FIRST, SECOND, THIRD]
    snapshots = [
        [(1, "x", None), (2, "y", "q"), (3, "z", "r"), (5, "s", "s"), (7, "a", "a")],
        [(1, "w", None), (2, "y", "q"), (4, "n", "n"), (6, "t", None), (7, "b", "b")],
        [(1, "x", None), (2, "y", "p"), (3, "z", "r"), (4, "n", "n"), (5, "v", "s"), (6, "t", "t"), (7, "b", "b")],
    ]
    want = None
    for i in range(3):
        frame = spark.createDataFrame(snapshots[i], "id int, a string, b string")
        want = build_scd2_dimension(frame, "id", "sk", ["a", "b"], stamps[i], want)
    want = rows(want.drop("sk"))
    assert (1, "x", None, THIRD, None, True) in want and len(want) == 13
    for order in itertools.permutations(range(3)):
        assert _history(spark, order, snapshots, stamps) == want, order


def test_a_repeated_stamp_corrects_and_repeats(spark):
    one = _apply(spark, [(1, "x", None), (2, "y", "q")], FIRST)
    two = stage(_apply(spark, [(1, "w", None), (2, "y", "q"), (3, "z", "z")], SECOND, one), "two")
    again = _apply(spark, [(1, "w", None), (2, "y", "q"), (3, "z", "z")], SECOND, two)
    assert rows(again) == rows(two)
    # 1 corrected, 2 changed after all, 3 as it was.
    fixed = stage(_apply(spark, [(1, "u", None), (2, "y", "p"), (3, "z", "z")], SECOND, two), "fixed")
    assert rows(fixed) == [
        (1, 1, "x", None, FIRST, SECOND, False),
        (2, 2, "y", "q", FIRST, SECOND, False),
        (3, 1, "u", None, SECOND, None, True),
        (4, 3, "z", "z", SECOND, None, True),
        (5, 2, "y", "p", SECOND, None, True),
    ]
    # Back to what it was: the version of the stamp goes.
    undone = _apply(spark, [(1, "x", None), (2, "y", "q")], SECOND, fixed)
    assert rows(undone) == [
        (1, 1, "x", None, FIRST, None, True),
        (2, 2, "y", "q", FIRST, None, True),
        (4, 3, "z", "z", SECOND, None, True),
    ]


def test_texts_that_concatenate_alike_differ(spark):
    one = _apply(spark, [(1, "a||", "b")], FIRST)
    two = _apply(spark, [(1, "a", "||b")], SECOND, one)
    assert two.count() == 2
    one = _apply(spark, [(1, "__NULL__", "b")], FIRST)
    assert _apply(spark, [(1, None, "b")], SECOND, one).count() == 2


def test_change_detection(spark):
    one = _apply(spark, [(1, "x", None), (2, "y", "q"), (3, "z", "r")], FIRST)
    sent = spark.createDataFrame([(1, "x", None), (2, "y", "Q"), (4, "w", "s")], "id int, a string, b string")
    found = detect_changes(sent, current_rows(one), "id", ["a", "b"])
    assert {r["id"]: r["change"] for r in found.collect()} == {
        1: "unchanged",
        2: "changed",
        3: "vanished",
        4: "new",
    }


def test_empty_snapshots(spark):
    empty = _apply(spark, [], FIRST)
    assert empty.count() == 0
    one = _apply(spark, [(1, "x", "y")], SECOND, empty)
    assert rows(one) == [(1, 1, "x", "y", SECOND, None, True)]
    assert rows(_apply(spark, [], THIRD, one)) == rows(one)


snapshots = st.lists(
    st.dictionaries(st.integers(0, 4), st.sampled_from([None, "p", "q"])), min_size=2, max_size=3
)


@settings(few, max_examples=5)
@given(snapshots)
def test_history_invariants(spark, history):
    table = None
    for n, snapshot in enumerate(history):
        data = [(k, v, "c") for k, v in snapshot.items()]
        table = _apply(spark, data, f"2024-0{n + 1}-01 00:00:00", table)
    found = [r.asDict() for r in table.collect()]
    assert sorted(r["sk"] for r in found) == list(range(1, len(found) + 1))
    latest = {}
    for snapshot in history:
        latest.update(snapshot)
    current = [r for r in found if r["is_current"]]
    assert {r["id"]: r["a"] for r in current} == latest
    assert len(current) == len(latest)
    for key in latest:
        spans = sorted((r["effective_from"], r["effective_to"]) for r in found if r["id"] == key)
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:])) or len(spans) == 1
        assert spans[-1][1] is None


# --- dimensions -------------------------------------------------------------------


def test_static_dimension_grows_without_renumbering(spark):
    first = build_static_dimension(_table(spark, [("b",), ("a",), (None,), ("b",)], "v string"), "v", "k")
    assert rows(first) == [(1, "a"), (2, "b")]
    more = _table(spark, [("c",), ("0",), ("a",)], "v string")
    assert rows(new_values(more, first, "v")) == [("0",), ("c",)]
    second = build_static_dimension(more, "v", "k", first)
    assert rows(second) == [(1, "a"), (2, "b"), (3, "0"), (4, "c")]
    assert rows(build_static_dimension(more, "v", "k", second)) == rows(second)


def test_several_dimensions_from_one_scan(spark):
    df = _table(spark, [("b", "x"), ("a", None), ("b", "y")], "p string, q string")
    values = distinct_values(df, {"dim_p": "p", "dim_q": "q"})
    built = build_static_dimensions(values, {"dim_p": ("pk", "pv"), "dim_q": ("qk", "qv"), "dim_r": ("rk", "rv")})
    assert rows(built["dim_p"]) == [(1, "a"), (2, "b")]
    assert rows(built["dim_q"]) == [(1, "x"), (2, "y")]
    assert rows(built["dim_r"]) == []


def test_lookup_of_null_and_unknown_values(spark):
    df = _table(spark, [(1, "a"), (2, None), (3, "zz")], "id int, v string")
    dim = _table(spark, [(7, "a"), (8, "b")], "k bigint, name string")
    assert rows(attach_dimension_key(df, "v", dim, "name", "k", "v_key")) == [
        (1, "a", 7),
        (2, None, None),
        (3, "zz", None),
    ]


# --- next row within a group ------------------------------------------------------


def _events(spark, n=600, seed=3):
    """One session owns most events; many share a second."""
    pick = random.Random(seed)
    start = dt.datetime(2024, 1, 1)
    data = []
    for event_id in range(1, n + 1):
        session = 1 if pick.random() < 0.6 else pick.randint(2, 40)
        data.append((event_id, session, start + dt.timedelta(seconds=pick.randint(0, 400))))
    return data, spark.createDataFrame(data, "event_id int, session_id int, timestamp timestamp_ntz")


def _brute_force(data):
    expected = {}
    ordered = sorted(data, key=lambda r: (r[1], r[2], r[0]))
    for here, after in zip(ordered, [*ordered[1:], None]):
        same = after is not None and after[1] == here[1]
        expected[here[0]] = (after[2] - here[2]).total_seconds() if same else 0.0
    return expected


def test_dwell_time_with_hot_sessions(spark):
    data, df = _events(spark)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        timed = event_duration(df.repartition(5)).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert {r["event_id"]: r["duration"] for r in timed} == _brute_force(data)


def test_next_row_with_null_groups_and_no_rows(spark):
    df = _table(spark, [(None, 1), (None, 3), (1, 2)], "g int, o int")
    assert rows(next_in_group(df, "g", ["o"], "o", "n")) == [
        (1, 2, None),
        (None, 1, 3),
        (None, 3, None),
    ]
    assert next_in_group(df.limit(0), "g", ["o"], "o", "n").count() == 0


# --- dimensions by key ------------------------------------------------------------


def test_rows_without_a_key_and_hot_keys_are_spread(spark):
    data = [(i, None if i % 2 else 1 if i % 4 else 2 + i % 40) for i in range(4000)]
    df = _table(spark, data, "id int, k int")
    dim = _table(spark, [(k, f"n{k}") for k in range(30)], "k int, name string")
    want = rows(_table(spark, [(i, k, f"n{k}" if k is not None and k < 30 else None) for i, k in data], "id int, k int, name string"))
    assert rows(attach_dimension(df, dim, "k")) == want
    settings_ = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    held = {k: spark.conf.get(k) for k in settings_}
    for k, v in settings_.items():
        spark.conf.set(k, v)
    try:
        for hot, most in (((), 1000 + 400), ((1,), 600)):
            joined = attach_dimension(df, dim, "k", hot)
            assert rows(joined) == want
            # By key alone one task would hold 2000 rows without a key, and one 1000 of the hot key.
            assert max(r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()) < most
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    assert attach_dimension(df.limit(0), dim, "k").count() == 0

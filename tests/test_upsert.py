import os

import pytest

from lakeops.sources import upsert as up
from lakeops.sources.tables import read_table
from tests.helpers import rows

SCHEMA = "k long, part string, v string"
KEYS, PARTS = ["k", "part"], ["part"]


def merge(spark, path, data, keys=KEYS, parts=PARTS, schema=SCHEMA, **kw):
    return up.upsert(spark, spark.createDataFrame(data, schema), path, keys, parts, **kw)


def table(spark, path):
    return rows(read_table(spark, path), "k", "part", "v")


def test_create_update_insert(spark, path):
    t = path + "/t"
    assert merge(spark, t, [(1, "a", "old"), (2, "a", "keep"), (3, "b", "far")]) == up.UpsertResult(0, 3)
    assert merge(spark, t, [(1, "a", "new"), (4, "a", "add"), (5, "c", "add")]) == up.UpsertResult(1, 2)
    want = [(1, "a", "new"), (2, "a", "keep"), (3, "b", "far"), (4, "a", "add"), (5, "c", "add")]
    assert table(spark, t) == want


def test_twice_is_once(spark, path):
    t = path + "/t"
    merge(spark, t, [(1, "a", "x")])
    source = [(1, "a", "y"), (2, "b", "z")]
    merge(spark, t, source)
    once = table(spark, t)
    assert merge(spark, t, source) == up.UpsertResult(2, 0)
    assert table(spark, t) == once


def test_untouched_partitions_are_not_rewritten(spark, path):
    t = path + "/t"
    merge(spark, t, [(1, "a", "x"), (2, "b", "y")])
    before = sorted(os.listdir(t + "/part=b"))
    merge(spark, t, [(1, "a", "z")])
    assert sorted(os.listdir(t + "/part=b")) == before


def test_matched_row_moves_and_its_old_partition_goes(spark, path):
    t = path + "/t"
    merge(spark, t, [(1, "a", "x"), (2, "b", "y"), (3, "b", "z")], keys=["k"])
    merge(spark, t, [(1, "c", "moved"), (2, "c", "moved")], keys=["k"])
    assert table(spark, t) == [(1, "c", "moved"), (2, "c", "moved"), (3, "b", "z")]
    assert not os.path.exists(t + "/part=a")


def test_partition_values_that_need_escaping(spark, path):
    t = path + "/t"
    merge(spark, t, [(1, "x/y=z %", "x"), (2, None, "n")], keys=["k"])
    merge(spark, t, [(1, "plain", "x"), (2, "plain", "n")], keys=["k"])
    assert table(spark, t) == [(1, "plain", "x"), (2, "plain", "n")]
    assert [d for d in os.listdir(t) if d.startswith("part=")] == ["part=plain"]


def test_copies_in_the_table_become_one(spark, path):
    t = path + "/t"
    spark.createDataFrame([(1, "a", "x"), (1, "a", "y")], SCHEMA).write.partitionBy("part").parquet(t)
    assert merge(spark, t, [(1, "a", "new")]) == up.UpsertResult(1, 0)
    assert table(spark, t) == [(1, "a", "new")]


def test_repeating_heals_a_run_that_died_between_two_swaps(spark, path):
    t = path + "/t"
    left = [(1, "a", "old"), (1, "b", "new"), (2, "a", "x"), (3, "b", "y")]
    spark.createDataFrame(left, SCHEMA).write.partitionBy("part").parquet(t)
    for _ in range(2):
        merge(spark, t, [(1, "b", "new")], keys=["k"])
        assert table(spark, t) == [(1, "b", "new"), (2, "a", "x"), (3, "b", "y")]


def test_empty_first_build_creates_no_table(spark, path):
    t = path + "/t"
    assert merge(spark, t, []) == up.UpsertResult(0, 0)
    assert not os.path.exists(t)
    assert merge(spark, t, [(1, "a", "x")]) == up.UpsertResult(0, 1)


def test_scratch_is_removed(spark, path):
    from lakeops.session import scratch_root

    before = set(os.listdir(scratch_root(spark)))
    merge(spark, path + "/t", [(1, "a", "x")])
    merge(spark, path + "/t", [(1, "b", "x")], keys=["k"])
    with pytest.raises(ValueError):
        merge(spark, path + "/t", [(None, "b", "x")], keys=["k"])
    assert set(os.listdir(scratch_root(spark))) == before


def test_two_rows_for_a_key_are_refused(spark, path):
    with pytest.raises(ValueError, match="more than one row"):
        merge(spark, path + "/t", [(1, "a", "x"), (1, "a", "y")])


def test_null_keys(spark, path):
    t = path + "/t"
    with pytest.raises(ValueError, match="null merge keys"):
        merge(spark, t, [(None, "a", "x")])
    for n in (1, 2):
        merge(spark, t, [(None, "a", "x")], null_keys="insert")
        assert len(table(spark, t)) == n  # a null matches nothing, not even itself


def test_many_partitions(spark, path):
    t = path + "/t"
    merge(spark, t, [(i, f"p{i}", "x") for i in range(6)])
    merge(spark, t, [(i, f"p{i}", "y") for i in range(4)])
    assert table(spark, t) == [(i, f"p{i}", "y" if i < 4 else "x") for i in range(6)]


def test_two_partition_columns(spark, path):
    t = path + "/t"
    schema = "k long, part string, sub string, v string"
    keys, parts = ["k", "part", "sub"], ["part", "sub"]
    merge(spark, t, [(1, "a", "m", "x"), (2, "a", "n", "x")], keys, parts, schema)
    merge(spark, t, [(1, "a", "m", "y"), (3, "b", "m", "y")], keys, parts, schema)
    assert table(spark, t) == [(1, "a", "y"), (2, "a", "x"), (3, "b", "y")]


def test_empty_source_changes_nothing(spark, path):
    t = path + "/t"
    merge(spark, t, [(1, "a", "x")])
    assert merge(spark, t, []) == up.UpsertResult(0, 0)
    assert table(spark, t) == [(1, "a", "x")]

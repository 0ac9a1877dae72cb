"""Versioned tables: what readers see, repeated runs, writers in each other's way."""

import pytest
from pyspark.sql import functions as F

from claimtide.session import scratch_path
from claimtide.sources.versions import Conflict, VersionedTables


@pytest.fixture
def store(spark):
    return VersionedTables(spark, scratch_path(spark, "tables"), fan=3)


def ids(table):
    return sorted(r[0] for r in table.collect())


def test_tables_are_published_together(spark, store):
    assert store.version() == 0 and store.table("a") is None
    assert store.commit("first", replace={"a": spark.range(3)}, append={"b": spark.range(2)}) == 1
    assert store.commit("second", replace={"a": spark.range(5)}, append={"b": spark.range(2, 4)}) == 2
    assert ids(store.table("a")) == [0, 1, 2, 3, 4] and ids(store.table("b")) == [0, 1, 2, 3]
    assert ids(store.table("a", 1)) == [0, 1, 2] and ids(store.table("b", 1)) == [0, 1]


def test_a_run_counts_once(spark, store):
    store.commit("monday", append={"a": spark.range(3)})
    assert store.commit("monday", append={"a": spark.range(3)}) == 1
    assert store.version() == 1 and store.table("a").count() == 3


def test_one_of_two_writers_fails(spark, store):
    store.commit(append={"a": spark.range(1)})
    other = VersionedTables(spark, store.path)
    entry = other.latest()
    store.commit(append={"a": spark.range(1, 2)})
    with pytest.raises(Conflict):
        other._publish({"number": entry["number"] + 1, "run": None, "tables": {}})
    with pytest.raises(Conflict):
        other.commit(append={"a": spark.range(9, 10)}, base=entry["number"])
    assert ids(store.table("a")) == [0, 1]


def test_a_commit_that_breaks_is_not_seen(spark, store):
    store.commit("one", replace={"a": spark.range(3)})
    broken = spark.range(3).select(F.raise_error(F.lit("no")).cast("long").alias("id"))
    with pytest.raises(Exception, match="no"):
        store.commit("two", replace={"a": spark.range(7), "b": broken})
    assert store.version() == 1 and ids(store.table("a")) == [0, 1, 2]
    assert store.commit("two", replace={"a": spark.range(7)}) == 2


def test_parts_fold_and_old_versions_go(spark, store):
    for i in range(10):
        store.commit(append={"a": spark.createDataFrame([(i % 4, i)], "k int, v int")}, folds={"a": lambda d: d.groupBy("k").agg(F.max("v").alias("v"))})
    assert [p["level"] for p in store.latest()["tables"]["a"]] == [2, 0]
    assert sorted(map(tuple, store.table("a").collect())) == [(0, 8), (1, 5), (1, 9), (2, 6), (3, 7)]
    store.expire(keep=2)
    assert store.version() == 10 and store.table("a").count() == 5
    assert store.table("a", 9).count() == 4
    files, folder = store._files(f"{store.path}/data")
    assert len(files.listStatus(folder)) == 2

"""Streams over several landed batches: late rows, repeated keys, same end as batch."""

import os

import pytest
from pyspark.sql import functions as F

from claimtide.plans import load_all
from claimtide.plans.catalog import QUERIES
from claimtide.session import scratch_path
from claimtide.streaming import streams

SCHEMA = "id int, k string, ts timestamp, v int"


def land(spark, path, batch):
    spark.createDataFrame(batch, "id int, k string, ts string, v int").withColumn(
        "ts", F.col("ts").cast("timestamp")
    ).coalesce(1).write.mode("append").parquet(path)


@pytest.fixture
def path(spark):
    return scratch_path(spark, "landed")


def stream(spark, path):
    return streams.file_stream(spark, path, SCHEMA, files_per_batch=1)


def test_late_rows_are_dropped_past_the_watermark(spark, path):
    target = scratch_path(spark, "days")
    land(spark, path, [(1, "a", "2024-01-01 10:00:00", 1), (2, "a", "2024-01-03 10:00:00", 1)])
    streams.run_available(streams.day_counts(stream(spark, path), "ts", ["k"], "1 hour"), target)
    land(spark, path, [(3, "a", "2024-01-01 11:00:00", 1), (4, "a", "2024-01-05 00:00:00", 1)])
    streams.run_available(streams.day_counts(stream(spark, path), "ts", ["k"], "1 hour"), target)
    got = sorted((str(r["day"])[:10], r["count"]) for r in spark.read.parquet(target).collect())
    assert got == [("2024-01-01", 1), ("2024-01-03", 1)]


@pytest.mark.parametrize("files", [1, 3])
def test_table_of_one_file_or_many_arrives_whole(spark, path, files):
    """A table may be one file or a folder of part files."""
    rows = [(i, [1.0, float(i)], i % 2) for i in range(6)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(files).write.parquet(f"{path}/made")
    spark.createDataFrame([(0, "a")], "id int, k string").write.parquet(f"{path}/other.parquet")
    here = path.removeprefix("file:")
    parts = [f for f in os.listdir(f"{here}/made") if f.endswith(".parquet")]
    os.rename(f"{here}/made" if files > 1 else f"{here}/made/{parts[0]}", f"{here}/embeddings.parquet")
    load_all()
    got = QUERIES["X7_label_arrivals"](spark, path)
    assert sorted(r["message_id"] for r in got.collect()) == [0, 1, 2, 3, 4, 5]


def test_upsert_over_batches_equals_one_batch(spark, path):
    log = streams.UpsertLog(scratch_path(spark, "log"), "k", ["ts", "id"], ["v"], links="v")
    for batch in (
        [(1, "a", "2024-01-01 10:00:00", 1), (2, "b", "2024-01-01 11:00:00", 2)],
        [(3, "a", "2024-01-02 10:00:00", 3), (4, "a", "2024-01-01 09:00:00", 4)],
    ):
        land(spark, path, batch)
        streams.upsert_stream(stream(spark, path), log)
    expected = [("a", 3, 3), ("b", 2, 1)]
    assert sorted(tuple(r) for r in log.current(spark).select("k", "v", "writes").collect()) == expected
    compacted = log.compact(spark, scratch_path(spark, "compact"))
    assert sorted(tuple(r) for r in compacted.current(spark).select("k", "v", "writes").collect()) == expected
    assert compacted.current_links(spark).count() == 4
    # a repeated batch replaces itself
    log.write(spark.read.parquet(path).where("id = 2"), 0)
    assert log.current(spark).where("k = 'b'").first()["writes"] == 1


def test_repeated_keys_are_dropped_across_batches(spark, path):
    target = scratch_path(spark, "unique")
    for _ in range(2):
        land(spark, path, [(1, "a", "2024-01-01 10:00:00", 1)])
        unique = streams.unique_by(stream(spark, path), ["id"], "ts", "1 hour")
        streams.run_available(unique, target)
    assert spark.read.parquet(target).count() == 1


def test_high_water_marks_go_on(spark, path):
    marks = streams.HighWaterMarks(scratch_path(spark, "marks"), "k", "id", "ts", "1 hour", idle_days=2)
    batches = [
        [(5, "a", "2024-01-01 10:00:00", 1), (1, "b", "2024-01-01 10:00:00", 1), (2, None, "2024-01-01 10:00:00", 1)],
        [(9, "a", "2024-01-02 10:00:00", 1), (7, "a", "2024-01-02 11:00:00", 1)],
        [(8, "a", "2024-01-06 10:00:00", 1)],
        [(6, "a", "2024-01-06 11:00:00", 1)],
    ]
    for batch in batches:  # each run starts the stream again
        land(spark, path, batch)
        marks.run(stream(spark, path))
    assert sorted(map(tuple, marks.current(spark).collect())) == [("a", 9), ("b", 1)]
    # b has been quiet for two days: its mark is kept outside the state
    assert [tuple(r) for r in marks.in_state(spark).collect()] == [("a", 9)]
    land(spark, path, [(3, "b", "2024-01-06 12:00:00", 1)])
    marks.run(stream(spark, path))
    assert sorted(map(tuple, marks.current(spark).collect())) == [("a", 9), ("b", 3)]


def test_parts_stay_few_over_many_batches(spark):
    log = streams.UpsertLog(scratch_path(spark, "log"), "k", ["id"], ["v"], links="v", fan=4)
    for i in range(50):
        batch = spark.createDataFrame([(i, f"k{i % 7}", i % 5), (i, "hot", i)], "id int, k string, v int").coalesce(1)
        log.write(batch, i)
        log.write(batch, i)
    store = log.tables(spark)
    assert store.version() == 50
    assert all(len(parts) <= 9 for parts in store.latest()["tables"].values())
    files, folder = store._files(f"{log.path}/data")
    assert len(files.listStatus(folder)) <= 2 * (9 + 4)
    files, folder = store._files(f"{log.path}/log")
    assert len([e for e in files.listStatus(folder) if e.getPath().getName().isdigit()]) == 4
    rows = {r.k: (r.v, r.writes) for r in log.current(spark).collect()}
    assert rows["hot"] == (49, 50) and rows["k0"] == (49 % 5, 8)
    assert log.current_links(spark).where("k = 'hot'").count() == 50

"""Streams over the landed event files, run to the end of what has landed."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import scratch_path
from ..streaming import streams
from .catalog import Tables, query
from .queries_functions import PAIRS_SQL, vector_tables

DELAY = "1 hour"


def arrivals(spark, folder, table: str = "events"):
    """A table's files as a stream, be it one file or a folder of them."""
    schema = getattr(Tables(spark, folder), table).schema
    # a pattern, since a stream takes a plain path for a folder and would refuse a file
    return streams.file_stream(spark, f"{folder}/{table}.parque[t]", schema)


def events(spark, folder):
    return arrivals(spark, folder).withColumn("ts", F.col("ts").cast("timestamp"))


def finished(spark, stream):
    return spark.read.parquet(streams.run_available(stream))


@query("X1_incremental_ingest", "SELECT event_id, user_id, event_type FROM events")
def incremental_ingest(spark, folder):
    return finished(spark, arrivals(spark, folder).select("event_id", "user_id", "event_type"))


@query("X2_unique_by", "SELECT event_id, event_type FROM events")
def unique_by(spark, folder):
    """Every event arrives twice."""
    twice = events(spark, folder).unionByName(events(spark, folder)).select("event_id", "event_type", "ts")
    return finished(spark, streams.unique_by(twice, ["event_id"], "ts", DELAY).drop("ts"))


@query(
    "X3_upsert",
    """
    SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type, arg_max(value, (ts, event_id)) AS value, count(*) AS writes
    FROM events GROUP BY 1
    """,
)
def upsert(spark, folder):
    log = streams.UpsertLog(
        scratch_path(spark, "upsert"), "user_id", ["ts", "event_id"], ["event_type", "value"], links="event_type"
    )
    streams.upsert_stream(events(spark, folder), log)
    return log.current(spark).drop("ts", "event_id")


@query(
    "X4_day_counts",
    f"""
    SELECT strftime(ts, '%Y-%m-%d') AS day, user_id, count(*) AS count FROM events
    WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL {DELAY} FROM events) GROUP BY 1, 2
    """,
)
def day_counts(spark, folder):
    out = finished(spark, streams.day_counts(events(spark, folder), "ts", ["user_id"], DELAY))
    return out.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query(
    "X5_sliding_activity",
    f"""
    WITH w AS (SELECT date_trunc('hour', ts) - to_hours(i::INT) AS start, count(*) AS count FROM events, range(12) r(i) GROUP BY 1)
    SELECT strftime(start, '%Y-%m-%d %H') AS start, strftime(start + INTERVAL 12 HOUR, '%Y-%m-%d %H') AS "end", count FROM w
    WHERE start + INTERVAL 12 HOUR <= (SELECT max(ts) - INTERVAL {DELAY} FROM events)
    """,
)
def sliding_activity(spark, folder):
    out = finished(spark, streams.sliding_activity(events(spark, folder), "ts", DELAY))
    return out.withColumns({c: F.date_format(c, "yyyy-MM-dd HH") for c in ("start", "end")})


@query(
    "X6_sessions",
    f"""
    WITH e AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh
               FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
    s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS n FROM e),
    g AS (SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 6 HOUR AS stop, count(*) AS count FROM s GROUP BY user_id, n)
    SELECT user_id, strftime(start, '%Y-%m-%d %H:%M') AS start, strftime(stop, '%Y-%m-%d %H:%M') AS "end", count FROM g
    WHERE stop <= (SELECT max(ts) - INTERVAL {DELAY} FROM events)
    """,
)
def sessions(spark, folder):
    out = finished(spark, streams.sessions(events(spark, folder), "ts", ["user_id"], "6 hours", DELAY))
    return out.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm") for c in ("start", "end")})


@query(
    "X7_label_arrivals",
    f"""
    WITH {PAIRS_SQL} SELECT message_id, fact_id, round(score, 6) AS score, CASE WHEN score > 0.1 THEN 'on-topic' ELSE 'off-topic' END AS topic_relation
    FROM scored
    """,
)
def label_arrivals(spark, folder):
    claims = vector_tables(Tables(spark, folder))[1]
    stream = arrivals(spark, folder, "embeddings").select(
        F.col("vec_id").alias("message_id"), F.col("label").cast("bigint").alias("fact_id"), F.col("embedding").alias("vector")
    )
    out = finished(spark, streams.label_arrivals(stream, claims, "topic_relation", 0.1))
    return out.withColumn("score", F.round("score", 6))


@query("X8_high_water_marks", "SELECT user_id, max(event_id) AS mark FROM events GROUP BY 1")
def high_water_marks(spark, folder):
    marks = streams.HighWaterMarks(scratch_path(spark, "marks"), "user_id", "event_id", "ts", DELAY, idle_days=1)
    marks.run(events(spark, folder))
    return marks.current(spark)


@query(
    "X9_near_claim",
    """
    SELECT m.event_id AS message_id, c.event_id AS claim_id FROM events m JOIN events c ON m.user_id = c.user_id
      AND c.event_type = 'error' AND m.ts > c.ts - INTERVAL 1 DAY AND m.ts < c.ts + INTERVAL 1 DAY
    """,
)
def near_claim(spark, folder):
    messages = events(spark, folder).select(
        F.col("event_id").alias("message_id"), F.col("user_id").alias("fact_id"), F.col("ts").alias("date")
    )
    claims = events(spark, folder).where(F.col("event_type") == "error").select(
        F.col("event_id").alias("claim_id"), F.col("user_id").alias("fact_id"), F.col("ts").alias("claim_date")
    )
    joined = streams.near_claim_stream(messages, claims, 1, DELAY)
    return finished(spark, joined.select("message_id", "claim_id"))

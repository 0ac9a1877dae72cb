"""Registry of checked queries and the tables they read."""

from __future__ import annotations

import textwrap
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under `name`, with the SQL that must give the same rows."""

    def keep(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = textwrap.dedent(sql).strip()
        return fn

    return keep


class Tables:
    """Attribute access to the Parquet tables of a folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @property
    def dated(self) -> DataFrame:
        """events as dated messages of claims."""
        return self.events.select(
            F.col("event_id").alias("message_id"),
            F.col("user_id").alias("fact_id"),
            F.col("ts").alias("date"),
            F.col("event_type").alias("feature"),
            "value",
        )

    @property
    def checked(self) -> DataFrame:
        """Dated messages with the fact-check time: the claim's first 'error' event."""
        dated = self.dated
        checks = dated.where(F.col("feature") == "error").groupBy("fact_id").agg(F.min("date").alias("checked_at"))
        return dated.join(checks, "fact_id", "left")

    @property
    def claims(self) -> DataFrame:
        """orders as dated claims with a verdict and a reviewer."""
        return self.orders.select(
            F.col("o_orderkey").alias("fact_id"),
            F.col("o_orderdate").cast("timestamp").alias("date"),
            F.col("o_orderstatus").alias("calification"),
            F.col("o_orderpriority").alias("reviewer"),
            F.col("o_custkey").alias("custkey"),
            F.col("o_totalprice").alias("price"),
        )


# Shared pieces of the SQL side.
CHECKED_SQL = """
    checked AS (
      SELECT e.event_id AS message_id, e.user_id AS fact_id, e.ts AS date, e.event_type AS feature, e.value,
             c.checked_at
      FROM events e LEFT JOIN (
        SELECT user_id, min(ts) AS checked_at FROM events WHERE event_type = 'error' GROUP BY 1
      ) c USING (user_id)
    )"""
OFFSET_SQL = """
    offsets AS (
      SELECT *,
        coalesce(date_diff('day', checked_at::DATE, date::DATE), 0) AS day_offset,
        coalesce(floor((epoch_us(date) - epoch_us(checked_at)) / 3600000000.0), 0)::BIGINT AS hour_offset
      FROM checked
    )"""

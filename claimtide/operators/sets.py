"""Set operations on ids and result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_total(table: DataFrame, label: str, sums: list[str], name: str = "Total") -> DataFrame:
    total = table.agg(*[F.sum(c).alias(c) for c in sums]).withColumn(label, F.lit(name))
    return table.select(label, *sums).unionByName(total)


def any_ids(a: DataFrame, b: DataFrame, key: str = "fact_id") -> DataFrame:
    return a.select(key).union(b.select(key)).distinct()


def shared_ids(a: DataFrame, b: DataFrame, key: str = "fact_id") -> DataFrame:
    return a.select(key).intersect(b.select(key))


def new_ids(a: DataFrame, earlier: DataFrame, key: str = "fact_id") -> DataFrame:
    return a.select(key).subtract(earlier.select(key))


def union_feeds(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b, allowMissingColumns=True)


def with_zero_rows(counts: DataFrame, key: str, side: str, sides: list[str], n: str = "n") -> DataFrame:
    """Every key has a row for each side, 0 where it had none."""
    wanted = counts.select(key).distinct().withColumn(side, F.explode(F.array(*[F.lit(s) for s in sides])))
    return wanted.join(counts, [key, side], "left").withColumn(n, F.coalesce(n, F.lit(0)))

"""Keyed writes, samples and caps; all of them combine before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def last_per_key(rows: DataFrame, key: str, order: list[str], payload: list[str]) -> DataFrame:
    """Last writer wins, with the number of writes."""
    last = F.max_by(F.struct(*payload), F.struct(*order)).alias("_p")
    return rows.groupBy(key).agg(last, F.count("*").alias("writes")).select(key, "_p.*", "writes")


def first_per_key(rows: DataFrame, key: str, order: list[str], payload: list[str]) -> DataFrame:
    """First writer wins; later inserts of the key are ignored."""
    first = F.min_by(F.struct(*payload), F.struct(*order)).alias("_p")
    return rows.groupBy(key).agg(first).select(key, "_p.*")


def pushed_links(rows: DataFrame, key: str, fact: str = "fact_id") -> DataFrame:
    """Claims pushed to each key, long form, with how often."""
    return rows.groupBy(key, fact).agg(F.count("*").alias("pushes"))


def hash_order(seed: int, *ids) -> Column:
    """Repeatable pseudo-random order of rows."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(i).cast("string") for i in ids]))


def cap_per_key(df: DataFrame, keys: list, order: list, n: int, position: str = "position") -> DataFrame:
    """First n rows per keys. Spark cuts each task's groups to n rows first."""
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn(position, F.row_number().over(w)).where(F.col(position) <= n)


def sample_per_key(df: DataFrame, keys: list, ids: list[str], n: int, seed: int = 0) -> DataFrame:
    """n random rows per keys."""
    hashed = df.withColumn("_h", hash_order(seed, *ids))
    return cap_per_key(hashed, keys, ["_h", *ids], n).drop("_h")


def sample(df: DataFrame, ids: list[str], n: int | None, seed: int = 0) -> DataFrame:
    """n random rows overall; all rows when n is not set."""
    if not n:
        return df
    return df.withColumn("_h", hash_order(seed, *ids)).orderBy("_h", *ids).limit(n).drop("_h")


def top(df: DataFrame, order: list, n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)

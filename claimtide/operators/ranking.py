"""Ranks and exact percentiles without a global sort in one task.

Rows are first folded to (keys, value, rows). Values are partitioned by range,
in as many ranges as their number asks for; running totals are taken inside each range and the
totals of earlier ranges added. No task sees more than one range of one key,
and equal values are a single row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..session import stored


#: Rows of (keys, value) that one range should hold.
RANGE_ROWS = 1_000_000


def running_totals(counts: DataFrame, keys: list[str], value: str, n: str = "n") -> DataFrame:
    """Adds `_before` (rows with a smaller value in the same keys) and `_total`.

    `counts` has one row per (keys, value); other columns ride along. It is
    stored first, so the raw rows are read once, and again with the number of
    each row's range, so that both readers see the same ranges.
    """
    counts = stored(counts, "counts")
    parts = max(1, -(-counts.count() // RANGE_ROWS))
    ranged = stored(counts.repartitionByRange(parts, value).withColumn("_range", F.spark_partition_id()), "ranges")
    inner = W.partitionBy(*keys, "_range").orderBy(value).rowsBetween(W.unboundedPreceding, -1)
    inside = ranged.withColumn("_inside", F.coalesce(F.sum(n).over(inner), F.lit(0)))
    # one row per key and range, a millionth of the rows at most
    per_range = ranged.groupBy(*keys, "_range").agg(F.sum(n).alias("_n"))
    by_key = W.partitionBy(*keys) if keys else W.partitionBy(F.lit(0))
    earlier = by_key.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = per_range.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.col("_range").alias("_r"),
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_earlier"),
        F.sum("_n").over(by_key).alias("_total"),
    )
    condition = F.col("_range") == F.col("_r")
    for i, k in enumerate(keys):
        condition = condition & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    joined = inside.join(offsets, condition)
    return joined.withColumn("_before", F.col("_inside") + F.col("_earlier")).drop(
        "_inside", "_earlier", "_range", "_r", *[f"_k{i}" for i in range(len(keys))]
    )


def value_ranks(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, value, _rows, _before, _total) of the non-null values."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_rows"))
    return running_totals(counts, keys, value, "_rows")


def percentile_columns(value: str, probs: dict[str, float]) -> list[Column]:
    """Linear-interpolation percentiles as aggregates over ranked values."""
    out = []
    for name, p in probs.items():
        at = F.lit(p) * (F.col("_total") - 1)
        low, high = F.floor(at), F.ceil(at)
        v = F.col(value).cast("double")
        end = F.col("_before") + F.col("_rows")
        at_low = F.max(F.when((F.col("_before") <= low) & (low < end), v))
        at_high = F.max(F.when((F.col("_before") <= high) & (high < end), v))
        part = F.max(at - low)
        out.append((at_low + (at_high - at_low) * part).alias(name))
    return out


def exact_percentiles(df: DataFrame, keys: list[str], value: str, probs: dict[str, float]) -> DataFrame:
    ranked = value_ranks(df, keys, value)
    return ranked.groupBy(*keys).agg(*percentile_columns(value, probs))


def describe(df: DataFrame, value: str, keys: list[str] | None = None) -> DataFrame:
    """count, mean, std, min, 25%, 50%, 75%, max of a column, per keys if given."""
    keys = keys or []
    v = F.col(value).cast("double")
    basic = df.where(F.col(value).isNotNull()).groupBy(*keys).agg(
        F.count(value).alias("count"),
        F.avg(v).alias("mean"),
        F.stddev_samp(v).alias("std"),
        F.min(v).alias("min"),
        F.max(v).alias("max"),
    )
    quartiles = exact_percentiles(df, keys, value, {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    if not keys:
        keys = ["_one"]
        basic, quartiles = basic.withColumn("_one", F.lit(1)), quartiles.withColumn("_one", F.lit(1))
    right = quartiles.withColumnsRenamed({k: f"{k}__q" for k in keys})
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"{k}__q"))
    joined = basic.join(right, condition).drop(*[f"{k}__q" for k in keys], "_one")
    return joined.select(
        *[k for k in keys if k != "_one"], "count", "mean", "std", "min", "q25", "q50", "q75", "max"
    )

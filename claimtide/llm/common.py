"""Helpers shared by the operators of this subpackage.

Operators keep the whole input row in one struct column `row` while they work,
so input columns of any name never clash with theirs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, as a class body, and as characters.
SPACE = r"\x20\x09-\x0D"
SPACE_CHARS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def packed(df: DataFrame, **columns: Column) -> DataFrame:
    """The whole input row as struct `row`, and the named columns of it."""
    return df.select(F.struct(*[df[f"`{c}`"] for c in df.columns]).alias("row"), *[c.alias(n) for n, c in columns.items()])


def joined(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Equi-join in which null keys meet null keys; the keys come from the left."""
    other = right.select(*[F.col(c).alias(f"_{c}" if c in keys else c) for c in right.columns])
    on = reduce(lambda a, b: a & b, [left[k].eqNullSafe(other[f"_{k}"]) for k in keys])
    return left.join(other, on, how).drop(*[f"_{k}" for k in keys])


def words(text: Column) -> Column:
    """Words between ASCII white space, as an array; none for null."""
    trimmed = F.btrim(text, F.lit(SPACE_CHARS))
    return F.when(trimmed != "", F.split(trimmed, f"[{SPACE}]+")).otherwise(F.array().cast("array<string>"))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def let(value: Column, body) -> Column:
    """`body` of a value that is worked out once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]

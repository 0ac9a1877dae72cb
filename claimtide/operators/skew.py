"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a key that one task may get.
PIECE_ROWS = 250_000
#: Most keys that may be cut, which bounds the table of them that is broadcast.
MOST_KEYS = 100_000


def hot_keys(counts: DataFrame, key: str | list[str], n: str = "n", rows: int = PIECE_ROWS) -> DataFrame:
    """Keys of more than `rows` rows, with the number of pieces to cut them in.

    A piece has about `rows` rows however large the table is; only above
    `rows` * MOST_KEYS rows in all do pieces grow, so at most MOST_KEYS keys
    can pass.
    """
    most = F.greatest(F.lit(rows), counts.agg(F.sum(n)).scalar() / MOST_KEYS)
    keys = [key] if isinstance(key, str) else key
    return counts.where(F.col(n) > most).select(*keys, F.ceil(F.col(n) / most).cast("int").alias("_pieces"))


def salted_join(
    left: DataFrame, right: DataFrame, key: str | list[str], spread: list[str], hot: DataFrame, how: str = "inner"
) -> DataFrame:
    """Equi-join whose hot left keys are cut in pieces by a hash of `spread`.

    Right rows of a hot key are copied once per piece; every left row still
    meets each right row exactly once. The salt is a pure function of the row,
    so a retried task produces the same partitions.
    """
    keys = [key] if isinstance(key, str) else key
    hot = F.broadcast(hot)
    salted_left = left.join(hot, keys, "left").withColumn(
        "_salt", F.coalesce(F.pmod(F.xxhash64(*spread), F.col("_pieces")), F.lit(0).cast("bigint"))
    )
    copies = F.sequence(F.lit(0).cast("bigint"), (F.coalesce("_pieces", F.lit(1)) - 1).cast("bigint"))
    salted_right = right.join(hot, keys, "left").withColumn("_salt", F.explode(copies))
    joined = salted_left.drop("_pieces").join(salted_right.drop("_pieces"), [*keys, "_salt"], how)
    return joined.drop("_salt")

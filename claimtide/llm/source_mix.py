"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

Sources get blocks by highest quotients of their targets, shards of a source by
highest quotients of their own blocks. In a shard, documents stand in a seeded
order and are cut in equal blocks; a seeded run of them fills the quota.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..session import stored
from .common import joined, words

SHARD_DOCUMENTS = 4096
MAX_SHARDS = 4096
MAX_BLOCK = 1024
BLOCKS_OF_SMALLEST = 400


def targets(sizes: list[int], weights: list[int], most: int = 3) -> list[Fraction]:
    """Shares of the total by weight; a share above `most` times its size stops there and the rest is shared anew."""
    total, open_ = sum(sizes), set(range(len(sizes)))
    out = [Fraction(0)] * len(sizes)
    while open_:
        left = total - sum(out[i] for i in range(len(sizes)) if i not in open_)
        weight = sum(weights[i] for i in open_)
        for i in open_:
            out[i] = Fraction(left) * weights[i] / weight
        above = {i for i in open_ if out[i] > most * sizes[i]}
        if not above:
            break
        for i in above:
            out[i] = Fraction(most * sizes[i])
        open_ -= above
    return out


def sainte_lague(votes: np.ndarray, seats: int, most: np.ndarray) -> np.ndarray:
    """Seats by highest quotients votes / (2 * seats + 1), none above `most`; ties go to the earlier one."""
    votes, most = np.asarray(votes, float), np.asarray(most, np.int64)
    seats = min(int(seats), int(most[votes > 0].sum()))

    def given(divisor: float) -> np.ndarray:
        return np.minimum(np.floor(votes / divisor + 0.5).astype(np.int64), most)

    if seats <= 0:
        return np.zeros(len(votes), np.int64)
    low, high = votes[votes > 0].min() / (4.0 * seats + 4), votes.max() * 4
    for _ in range(100):
        middle = (low * high) ** 0.5
        if given(middle).sum() > seats:
            low = middle
        else:
            high = middle
    out = given(high * (1 + 1e-9))  # without the seats that tie at the border, which the queue deals in order
    queue = [(-votes[i] / (2 * out[i] + 1), i) for i in range(len(votes)) if votes[i] > 0 and out[i] < most[i]]
    heapq.heapify(queue)
    for _ in range(seats - int(out.sum())):
        _, i = heapq.heappop(queue)
        out[i] += 1
        if out[i] < most[i]:
            heapq.heappush(queue, (-votes[i] / (2 * out[i] + 1), i))
    return out


def source_plan(totals: DataFrame, weights: tuple[int, ...], most: int) -> tuple[DataFrame, int]:
    """One row per source: its target, shards and quota; and the tokens of a block. `totals` has a row per source."""
    rows = sorted(totals.collect(), key=lambda r: (r["source"] is None, r["source"] or ""))
    sizes = [r["size"] for r in rows]
    goals = targets(sizes, [weights[i % len(weights)] for i in range(len(rows))], most)
    smallest = min((g for g in goals if g > 0), default=Fraction(1))
    block = max(1, min(MAX_BLOCK, int(smallest / BLOCKS_OF_SMALLEST)))
    quotas = sainte_lague(
        np.array([float(g) for g in goals]), round(sum(goals) / block), np.array([most * -(-s // block) for s in sizes])
    ) if rows else []
    made = [
        (r["source"], i, r["size"], float(goals[i]), int(min(MAX_SHARDS, -(-r["n"] // SHARD_DOCUMENTS))), int(quotas[i]))
        for i, r in enumerate(rows)
    ]
    schema = "source string, rank int, source_size long, target double, shards int, quota long"
    return totals.sparkSession.createDataFrame(made, schema), block


def shard_plan(shards: DataFrame, block: int, most: int) -> DataFrame:
    """(rank, shard, shard_size, blocks, rounds, extra): whole rounds of a shard, and blocks of one more round.

    `shards` has (rank, quota, shard, shard_size), MAX_SHARDS rows of a source at most.
    """

    def apportioned(batch: pd.DataFrame) -> pd.DataFrame:
        batch = batch.sort_values("shard", ignore_index=True)
        sizes = batch["shard_size"].to_numpy()
        blocks = np.where(sizes > 0, np.maximum(1, np.round(sizes / block)), 0).astype(np.int64)
        quota, all_blocks = int(batch["quota"].iloc[0]), int(blocks.sum())
        rounds = min(most, quota // all_blocks) if all_blocks else 0
        extra = sainte_lague(blocks, min(quota - rounds * all_blocks, all_blocks) if rounds < most else 0, blocks)
        return pd.DataFrame(
            {"rank": batch["rank"], "shard": batch["shard"], "shard_size": sizes, "blocks": blocks, "rounds": np.int64(rounds), "extra": extra}
        )

    schema = "rank int, shard int, shard_size long, blocks long, rounds long, extra long"
    return shards.groupBy("rank").applyInPandas(apportioned, schema)


def source_mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = (1, 2, 3),
    most: int = 3,
    seed: int = 20240229,
    carry: list[str] | None = None,
) -> DataFrame:
    """Per row: struct `row` of the `carry` columns (default all), `size`, `source_size`, `target`, `rounds`, `parts`, `taken`.

    The mix takes a row `rounds` times as a whole, and once more the words of
    its `parts`, an array of (first word, end); `taken` counts all these words.

    Null text: size 0, nothing taken. Null source: a source of its own, last.
    Null id: a row like any other. Repeated rows are taken each for itself; as
    they tie in the seeded order, which of them has which share is open, their
    shares together are not. Sources without words get the target 0. Empty
    table: no rows. The driver sees one row of totals per source.
    """
    wanted = docs.columns if carry is None else carry
    sized = stored(
        docs.select(
            F.struct(*[docs[f"`{c}`"] for c in wanted]).alias("row"),
            F.col(source).cast("string").alias("source"),
            F.size(words(F.col(text))).cast("long").alias("size"),
            F.xxhash64(F.lit(seed), F.col(doc_id), F.col(text)).alias("lot"),
        ),
        "mix-sizes",
    )
    totals = sized.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n"))
    plan, block = source_plan(totals, weights, most)
    dealt = joined(sized, plan, ["source"], "inner").withColumn(
        "shard", F.pmod(F.xxhash64("lot", F.lit(seed)), F.col("shards")).cast("int")
    )
    shards = shard_plan(
        dealt.groupBy("rank", "shard").agg(F.first("quota").alias("quota"), F.sum("size").alias("shard_size")), block, most
    )
    order = Window.partitionBy("rank", "shard").orderBy("lot", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("start", F.coalesce(F.sum("size").over(order), F.lit(0).cast("long"))).join(shards, ["rank", "shard"])

    def edge(number):
        return F.floor(number * F.col("shard_size") / F.col("blocks")).cast("long")

    offset = F.pmod(F.xxhash64(F.lit(seed), "rank", "shard"), F.col("blocks"))
    first, past = F.col("offset"), F.col("offset") + F.col("extra")
    runs = (
        placed.withColumn("offset", F.when(F.col("blocks") > 0, offset).otherwise(F.lit(0).cast("long")))
        .withColumn("from", F.when(F.col("blocks") > 0, edge(first)))
        .withColumn("to", F.when(F.col("blocks") > 0, edge(F.least(past, F.col("blocks")))))
        .withColumn("wrapped", F.when(F.col("blocks") > 0, edge(F.greatest(past - F.col("blocks"), F.lit(0)))))
    )

    def part(low, high):
        return F.struct(
            F.least(F.greatest(low - F.col("start"), F.lit(0)), F.col("size")).alias("from"),
            F.least(F.greatest(high - F.col("start"), F.lit(0)), F.col("size")).alias("to"),
        )

    both = F.array(part(F.lit(0), F.col("wrapped")), part(F.col("from"), F.col("to")))
    parts = F.filter(both, lambda x: x["to"] > x["from"])
    return runs.select("row", "size", "source_size", "target", "rounds", parts.alias("parts")).withColumn(
        "taken",
        F.col("rounds") * F.col("size")
        + F.aggregate("parts", F.lit(0).cast("long"), lambda total, x: total + (x["to"] - x["from"])),
    )

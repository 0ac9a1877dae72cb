"""Hard negatives by a vertical scan of vectors (BOND: branch and bound on decomposed data).

Every task turns its rows into blocks of columns, one per dimension. An anchor
reads the columns in the order of its own largest components. After a few of
them, what the others can still add, least and most by the column's smallest and
largest value, tells which rows can't reach the wanted scores any more; the rest
is read on. Positives come first, then the rows of other labels whose score
lies in the window below a positive's.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import scratch_path, stored

#: Rows of a block, and columns read between two prunings.
BLOCK = 8_192
STEP = 8
#: Most anchors of one pass over the table, and most components of them; their vectors go to every task.
GROUP = 4_096
GROUP_COMPONENTS = 1 << 22
#: Squared length that a vector must stay below, so that every score fits a long.
LONGEST = 2.0**62
LEAST = np.iinfo(np.int64).min


def usable(vectors: DataFrame, vec_id: str, vector: str, label: Column, scale: int) -> DataFrame:
    """(vec_id, label, q): one row an id, components as floor(scale * x)."""
    parts = vectors.select(
        vectors[f"`{vec_id}`"].cast("long").alias("vec_id"), label.cast("long").alias("label"), vectors[f"`{vector}`"].cast("array<double>").alias("x")
    )
    finite = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = parts.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite, F.lit(False)))
    scaled = whole.select("vec_id", "label", F.transform("x", lambda x: F.floor(x * scale)).alias("q"))
    square = F.aggregate("q", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    return scaled.where(square < LONGEST).groupBy("vec_id").agg(F.min(F.struct("label", "q")).alias("v")).select("vec_id", "v.label", "v.q")


def padded(lists: pa.Array, width: int) -> np.ndarray:
    """Rows of `width` numbers; shorter lists end in zeros."""
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy()
    if (sizes == width).all():
        return flat.reshape(len(lists), width)
    out = np.zeros((len(lists), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


class Block:
    """Columns of some rows, ids ascending, and the smallest and largest value of each."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.labels, self.columns = ids[order], labels[order], np.ascontiguousarray(rows[order].T)
        self.low, self.high = self.columns.min(axis=1), self.columns.max(axis=1)

    def plan(self, anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Columns by descending size of the anchor's component; least and most that those from each place on add."""
        order = np.argsort(-np.abs(anchor), kind="stable")
        a, b = anchor[order] * self.low[order], anchor[order] * self.high[order]
        rest = lambda x: np.concatenate([np.cumsum(x[::-1])[::-1], [0]])
        return order, rest(np.minimum(a, b)), rest(np.maximum(a, b))

    def scan(self, anchor: np.ndarray, alive: np.ndarray, prune) -> tuple[np.ndarray, np.ndarray]:
        """Rows that `prune(least, most)` never ruled out, and their scores."""
        order, least, most = self.plan(anchor)
        scores = np.zeros(len(alive), np.int64)
        for at in range(0, len(order), STEP):
            keep = prune(scores + least[at], scores + most[at])
            if not keep.all():
                alive, scores = alive[keep], scores[keep]
            if not len(alive):
                break
            own = order[at : at + STEP]
            columns = self.columns[own] if len(alive) == len(self.ids) else self.columns[np.ix_(own, alive)]
            scores = scores + anchor[own] @ columns
        return alive, scores


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest scores, ties by smaller id."""
    if len(scores) > k:
        near = scores >= np.partition(scores, -k)[-k]
        scores, ids = scores[near], ids[near]
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


def kth(values: np.ndarray, k: int) -> int:
    return int(np.partition(values, -k)[-k]) if len(values) >= k else LEAST


class Positives:
    """The k best rows of an anchor's own label."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids = k, np.empty(0, np.int64), np.empty(0, np.int64)

    def take(self, block: Block, anchor_id: int, label: int, anchor: np.ndarray) -> None:
        floor = kth(self.scores, self.k)

        def prune(least: np.ndarray, most: np.ndarray) -> np.ndarray:
            nonlocal floor
            floor = max(floor, kth(least, self.k))
            return most >= floor

        alive, scores = block.scan(anchor, np.flatnonzero((block.labels == label) & (block.ids != anchor_id)), prune)
        self.scores, self.ids = best(np.concatenate([self.scores, scores]), np.concatenate([self.ids, block.ids[alive]]), self.k)

    def rows(self) -> Iterator[tuple[int, int, int]]:
        return ((0, int(i), int(s)) for s, i in zip(self.scores, self.ids))


class Negatives:
    """The k best rows of other labels in each of some windows of scores."""

    def __init__(self, k: int, windows: list[tuple[int, int]]):
        self.k, self.windows = k, windows
        self.found = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in windows]

    def take(self, block: Block, anchor_id: int, label: int, anchor: np.ndarray) -> None:
        floors = [max(low, kth(found[0], self.k)) for (low, _), found in zip(self.windows, self.found)]

        def prune(least: np.ndarray, most: np.ndarray) -> np.ndarray:
            keep = np.zeros(len(least), bool)
            for i, (low, high) in enumerate(self.windows):
                floors[i] = max(floors[i], kth(least[(least >= low) & (most <= high)], self.k))
                keep |= (most >= floors[i]) & (least <= high)
            return keep

        alive, scores = block.scan(anchor, np.flatnonzero(block.labels != label), prune)
        for i, (low, high) in enumerate(self.windows):
            inside = (scores >= low) & (scores <= high)
            known, ids = self.found[i]
            self.found[i] = best(np.concatenate([known, scores[inside]]), np.concatenate([ids, block.ids[alive][inside]]), self.k)

    def rows(self) -> Iterator[tuple[int, int, int]]:
        return ((slot, int(i), int(s)) for slot, (scores, ids) in enumerate(self.found) for s, i in zip(scores, ids))


def blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[Block]:
    held, count = [], 0
    for batch in batches:
        for low in range(0, batch.num_rows, BLOCK):
            part = batch.slice(low, BLOCK)
            if count + part.num_rows > BLOCK:
                yield Block(*map(np.concatenate, zip(*held)))
                held, count = [], 0
            held.append((part.column(0).to_numpy(), part.column(1).to_numpy(), padded(part.column(2), width)))
            count += part.num_rows
    if count:
        yield Block(*map(np.concatenate, zip(*held)))


def scanned(vectors: DataFrame, width: int, anchors: tuple[np.ndarray, np.ndarray, np.ndarray], wanted) -> DataFrame:
    """(anchor_id, slot, vec_id, score): what `wanted(anchor's place)` keeps in each task."""
    shared = vectors.sparkSession.sparkContext.broadcast(anchors)
    schema = pa.schema([("anchor_id", pa.int64()), ("slot", pa.int32()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, rows = shared.value
        kept = [wanted(i) for i in range(len(ids))]
        for block in blocks(batches, width):
            for keeper, anchor_id, label, row in zip(kept, ids, labels, rows):
                keeper.take(block, anchor_id, label, row)
        for low in range(0, len(kept), 256):
            found = [(int(ids[i]), *row) for i in range(low, min(low + 256, len(kept))) for row in kept[i].rows()]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), schema)], schema=schema)

    return vectors.select("vec_id", "label", "q").mapInArrow(run, "anchor_id long, slot int, vec_id long, score long")


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best of each (anchor, slot), with their rank."""
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: Column | str = "label",
    every: int = 100,
    k: int = 5,
    percent: int = 80,
    scale: int = 256,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows whose id is divisible by `every`; scores are inner
    products of floor(`scale` * component). An anchor's positives are its k best
    other rows of the same label; for each, the k best rows of another label
    with `percent`/100 of the positive's score at least and that score at most.

    The table is read twice for each group of some GROUP anchors, whose vectors
    go to every task. Each task keeps k rows per anchor, or per anchor and
    positive; Spark ranks those.

    No part take rows with a null id or label, with a null vector or a null or
    non-finite component, and vectors so long (2**31 and more) that scores would
    not fit a long. Rows with one id count once, as that of the smallest label
    and then vector; repeated rows thus too. Ties: smaller id first. Shorter
    vectors count as ending in zeros; an empty one scores 0. A negative score of
    a positive has an empty window: no rows. No positive, no negative or an
    empty table: no rows.
    """
    spark = vectors.sparkSession
    own = vectors[f"`{label}`"] if isinstance(label, str) else label
    rows = stored(usable(vectors, vec_id, vector, own, scale), "vectors")
    width, count = rows.agg(F.max(F.size("q")), F.count(F.when(F.col("vec_id") % every == 0, 1))).first()
    groups = -(-count // max(1, min(GROUP, GROUP_COMPONENTS // max(width or 0, 1))))
    asked = rows.where(F.col("vec_id") % every == 0)
    path = scratch_path(spark, "negatives")
    out = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    for group in range(groups):
        drawn = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(groups)) == group).collect()
        if not drawn:
            continue
        ids, labels = (np.array([r[c] for r in drawn], np.int64) for c in ("vec_id", "label"))
        matrix = padded(pa.array([r["q"] for r in drawn], pa.list_(pa.int64())), width)
        anchors = (ids, labels, matrix)
        found = ranked(scanned(rows, width, anchors, lambda _: Positives(k)), k)
        positives: dict[int, list[tuple[int, int]]] = {int(i): [] for i in ids}
        # k rows an anchor of this group
        for r in found.orderBy("anchor_id", "rank").select("anchor_id", "vec_id", "score").collect():
            positives[r["anchor_id"]].append((r["vec_id"], r["score"]))
        windows = [[(-(-percent * s // 100), s) for _, s in positives[int(i)]] for i in ids]
        pairs = [(a, slot, p, s) for a, ps in positives.items() for slot, (p, s) in enumerate(ps)]
        slots = spark.createDataFrame(pairs, "anchor_id long, slot int, positive_id long, positive_score long")
        below = ranked(scanned(rows, width, anchors, lambda i, windows=windows: Negatives(k, windows[i])), k)
        named = below.join(F.broadcast(slots), ["anchor_id", "slot"])
        named.select(
            "anchor_id", "positive_id", F.col("rank").cast("int"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
        ).write.mode("append").parquet(path)
    return spark.read.schema(out).parquet(path) if groups else spark.createDataFrame([], out)

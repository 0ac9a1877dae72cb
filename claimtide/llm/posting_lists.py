"""Approximate nearest neighbours by balanced posting lists.

Centroids come from a bounded sample, halved again and again, so lists are
balanced. They form a small graph in every task's memory, which beam search
walks. A vector near a border goes to several lists. A query looks into the
lists whose centroids are not much farther than the nearest one, all of them;
how much farther is measured on a trial of vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import stored

#: Most vectors that centroids are made of, and most centroids; both bound what the driver holds and broadcasts.
SAMPLE = 16_384
MAX_LISTS = 2_048
LIST_SIZE = 256
#: Links of a centroid in the graph, and width of the beam.
LINKS = 24
BEAM = 128
#: A vector goes to at most so many lists, within this ratio of its nearest centroid's distance.
COPIES = 4
BORDER = 1.05
#: A query looks into all lists within a ratio of the nearest one's distance. The ratio is the one that finds this share of
#: the neighbours of so many queries among the vectors of a trial, where neighbours lie farther than in the whole table.
SHARE = 0.98
TRIAL = 4_096
TRIAL_QUERIES = 512
#: Vectors and queries of one task's group.
PIECE_VECTORS = 4_096
PIECE_QUERIES = 1_024
SEED = 20240306
SLACK = 1e-9


def halved(vectors: np.ndarray, lists: int, rng: np.random.Generator) -> np.ndarray:
    """Means of `lists` groups of equal size, by halving along the line between two far members."""
    groups, done = [np.arange(len(vectors))], []
    while groups and len(groups) + len(done) < lists:
        groups.sort(key=len)
        group = groups.pop()
        if len(group) < 2:
            done.append(group)
            continue
        own = vectors[group]
        first = own[((own - own[rng.integers(len(own))]) ** 2).sum(axis=1).argmax()]
        second = own[((own - first) ** 2).sum(axis=1).argmax()]
        order = np.argsort(own @ (second - first), kind="stable")
        groups += [group[order[: len(order) // 2]], group[order[len(order) // 2 :]]]
    means = np.array([vectors[g].mean(axis=0) for g in groups + done])
    return means / np.maximum(np.linalg.norm(means, axis=1, keepdims=True), 1e-12)


def linked(centroids: np.ndarray, links: int) -> np.ndarray:
    """Each centroid's nearest others, and two by chance, which keep the graph in one piece."""
    n = len(centroids)
    links = min(links, n)
    near = np.argsort(-(centroids @ centroids.T), axis=1, kind="stable")[:, :links]
    ring = np.stack([(np.arange(n) + 1) % n, (np.arange(n) * 7 + n // 2) % n], axis=1)
    return np.concatenate([near, ring], axis=1)


class Graph:
    """Centroids, searched by a beam that starts from a few spread ones."""

    def __init__(self, centroids: np.ndarray, links: np.ndarray):
        self.centroids, self.links = centroids, links

    def nearest(self, vectors: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and squared distances of the centroids found, nearest first, one row a vector; unit vectors."""
        n, rows = len(self.centroids), np.arange(len(vectors))[:, None]
        beam = min(beam, n)
        starts = np.unique(np.linspace(0, n - 1, min(n, 16)).astype(int))
        at = np.broadcast_to(starts, (len(vectors), len(starts))).copy()
        far = 2 - 2 * vectors @ self.centroids[starts].T
        seen = np.zeros((len(vectors), n), bool)
        seen[:, starts] = True
        open_ = np.ones(at.shape, bool)
        while open_.any():
            best = np.where(open_, far, np.inf).argmin(axis=1)[:, None]
            active = open_[rows, best]
            open_[rows, best] = False
            fresh = self.links[at[rows, best][:, 0]]
            new = ~seen[rows, fresh] & active
            seen[rows, fresh] = True
            distance = np.where(new, 2 - 2 * np.einsum("rld,rd->rl", self.centroids[fresh], vectors), np.inf)
            at, far = np.concatenate([at, fresh], axis=1), np.concatenate([far, distance], axis=1)
            open_ = np.concatenate([open_, new], axis=1)
            order = np.argsort(far, axis=1, kind="stable")[:, :beam]
            at, far, open_ = at[rows, order], far[rows, order], open_[rows, order] & np.isfinite(far[rows, order])
            # nothing is gained behind a full beam
            open_ &= far <= far[:, -1:]
        return at, far


    def homes(self, vectors: np.ndarray) -> list[list[int]]:
        """Lists that hold each vector: the nearest centroid's, and others beyond a near border."""
        at, far = self.nearest(vectors, 32)
        lists = []
        near = np.sqrt(np.maximum(far, 0))
        for row, distance in zip(at, near):
            chosen = [int(row[0])]
            for c, d in zip(row[1:], distance[1:]):
                if d > BORDER * distance[0] or len(chosen) == COPIES:
                    break
                if all(np.linalg.norm(self.centroids[c] - self.centroids[o]) > d for o in chosen):
                    chosen.append(int(c))
            lists.append(chosen)
        return lists

    def within(self, vectors: np.ndarray, ratio: float) -> list[list[int]]:
        """Lists within `ratio` of the nearest one's distance; where the beam ends before the ratio, all centroids are compared."""
        at, far = self.nearest(vectors, BEAM)
        near = np.sqrt(np.maximum(far, 0))
        found = [row[distance <= ratio * distance[0] + SLACK].tolist() for row, distance in zip(at, near)]
        for i in np.flatnonzero(near[:, -1] <= ratio * near[:, 0] + SLACK):
            distance = np.sqrt(np.maximum(2 - 2 * self.centroids @ vectors[i], 0))
            found[i] = np.flatnonzero(distance <= ratio * distance.min() + SLACK).tolist()
        return found


def reach(graph: Graph, trial: np.ndarray, k: int) -> float:
    """Ratio of distances within which SHARE of the k nearest in the trial are held by a list."""
    ratios = []
    for i, query in enumerate(trial[:TRIAL_QUERIES]):
        score = trial @ query
        score[i] = -np.inf
        best = np.argsort(-score, kind="stable")[: min(k, len(trial) - 1)]
        distance = np.sqrt(np.maximum(2 - 2 * graph.centroids @ query, 0))
        ratios += [distance[lists].min() / max(distance.min(), SLACK) for lists in graph.homes(trial[best])] if len(best) else []
    return float(np.quantile(ratios, SHARE, method="higher")) if ratios else 1.0


def near_one(vectors: np.ndarray) -> np.ndarray:
    """Each row times a power of two that brings its largest component to 0.5 or more and below 1.

    Products of very long or very short vectors would leave the range of
    doubles; a power of two changes no digit, so cosines stay as they are.
    """
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1, keepdims=True))[1])


def units(batch_column: pa.Array) -> np.ndarray:
    flat = batch_column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    vectors = near_one(flat.reshape(len(batch_column), -1))
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def usable(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, vector) of the vectors that take part: not null, finite, not zero."""
    clean = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector")).where("vec_id IS NOT NULL")
    limit = F.lit(float("inf"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < limit))
    return clean.where(F.coalesce(finite & F.exists("vector", lambda x: x != 0), F.lit(False)))


def placed(vectors: DataFrame, graph: Graph, ratio: float, every: int) -> DataFrame:
    """(vec_id, vector, lists, probes): lists that hold the vector, and those its query looks into."""
    shared = vectors.sparkSession.sparkContext.broadcast(graph)
    schema = pa.schema([("vec_id", pa.int64()), ("vector", pa.list_(pa.float64())), ("lists", pa.list_(pa.int32())), ("probes", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph = shared.value
        for whole in batches:
            for low in range(0, whole.num_rows, 1024):
                batch = whole.slice(low, 1024)
                own = units(batch.column(1))
                ids = batch.column(0).to_numpy()
                asks = ids % every == 0
                lists = graph.homes(own)
                probes = [[] for _ in ids]
                if asks.any():
                    for i, found in zip(np.flatnonzero(asks), graph.within(own[asks], ratio)):
                        probes[i] = found
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(lists, pa.list_(pa.int32())), pa.array(probes, pa.list_(pa.int32()))], schema=schema
                )

    return vectors.mapInArrow(run, "vec_id long, vector array<double>, lists array<int>, probes array<int>")


def searched(k: int):
    """Function over one piece of a list: its vectors and the queries that look into it."""
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        ids, asked = left.column("vec_id").to_numpy(), right.column("query_id").to_numpy()
        vectors, queries = (
            near_one(t.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(t.num_rows, -1))
            for t, name in ((left, "vector"), (right, "query"))
        )
        lengths = np.sqrt((vectors * vectors).sum(axis=1))
        # rows of one id stand together, and an id counts once
        by_id = np.argsort(ids, kind="stable")
        ids, vectors, lengths = ids[by_id], vectors[by_id], lengths[by_id]
        starts = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for query, own in zip(asked, queries):
            rough = vectors @ own / (lengths * np.sqrt((own * own).sum()))
            rough[ids == query] = -np.inf
            best = np.maximum.reduceat(rough, starts)
            last = np.partition(best, -k)[-k] if len(best) > k else -np.inf
            at = np.flatnonzero((rough >= last - SLACK) & (rough > -np.inf))
            # the same sum for the same vector, whatever stands beside it
            exact = (vectors[at] * own).sum(axis=1) / (lengths[at] * np.sqrt((own * own).sum()))
            order = np.lexsort((ids[at], -exact))
            order = order[np.sort(np.unique(ids[at][order], return_index=True)[1])][:k]
            found.append((np.full(len(order), query), ids[at][order], exact[order]))
        return pa.table([np.concatenate(x) for x in zip(*found)], schema=schema)

    return run


def nearest(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", k: int = 5, every: int = 50) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each vector whose id is divisible by `every`, by cosine.

    Vectors of any finite length, however short or long, are compared alike.
    Vectors that are null, zero or hold null or non-finite numbers take no part,
    nor do those without an id or with another length than most of the sample.
    Ties go to the smaller id. Rows with one id: the query never finds its own
    id; among candidates an id counts once, with its best score. No other
    vector: no rows for that query. Empty table: no rows. Lists longer than a
    piece, as of one vector many times over, are dealt to several tasks.
    """
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    clean = usable(vectors, vec_id, vector)
    drawn = clean.orderBy(F.xxhash64("vec_id", F.lit(SEED)), "vec_id").limit(SAMPLE + TRIAL).select("vector").collect()
    if not drawn:
        return spark.createDataFrame([], schema)
    lengths = [len(r["vector"]) for r in drawn]
    length = max(sorted(set(lengths)), key=lengths.count)
    sample = near_one(np.array([r["vector"] for r in drawn if len(r["vector"]) == length]))
    sample /= np.linalg.norm(sample, axis=1, keepdims=True)
    # vectors that made no centroid, if there are enough
    sample, rest = sample[:SAMPLE], sample[SAMPLE:]
    trial = rest if len(rest) >= TRIAL_QUERIES else sample[-TRIAL:]
    clean = clean.where(F.size("vector") == length)
    lists = int(min(MAX_LISTS, max(1, len(sample) // 8), -(-clean.count() // LIST_SIZE)))
    centroids = halved(sample, lists, np.random.default_rng(SEED))
    graph = Graph(centroids, linked(centroids, LINKS))
    at = stored(placed(clean, graph, reach(graph, trial, k), every), "placed")

    held = at.select("vec_id", "vector", F.explode("lists").alias("list"))
    asked = at.select(F.col("vec_id").alias("query_id"), F.col("vector").alias("query"), F.explode("probes").alias("wanted"))
    sizes = held.groupBy("list").agg(F.ceil(F.count("*") / PIECE_VECTORS).cast("int").alias("pieces"))
    crowds = asked.groupBy(F.col("wanted").alias("list")).agg(F.ceil(F.count("*") / PIECE_QUERIES).cast("int").alias("shares"))
    deal = stored(sizes.join(crowds, "list"), "pieces")  # a row per list, MAX_LISTS at most
    part = F.pmod(F.xxhash64("vec_id"), F.col("pieces")).cast("int").alias("piece")
    left = held.join(deal, "list").select("list", part, F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), "vec_id", "vector")
    share = F.pmod(F.xxhash64("query_id"), F.col("shares")).cast("int").alias("turn")
    slices = F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("slice")
    right = asked.join(deal.withColumnRenamed("list", "wanted"), "wanted").select("wanted", slices, share, "query_id", "query")
    held_by, asked_by = left.groupBy("list", "piece", "share"), right.groupBy("wanted", "slice", "turn")
    found = held_by.cogroup(asked_by).applyInArrow(searched(k), "query_id long, vec_id long, score double")
    single = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return single.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

"""MinHash near-dedup with an LSH forest.

Every tree of the forest is a sorted order of a part of the signatures.
Documents whose signatures share the first values of an order form a region of
it. Candidates are the neighbours in an order, which share the longest prefixes
and so lie deeper where a region is crowded, and the hub of each region, the
member whose prefixes most documents share over all orders. Candidates are
confirmed on whole shingle sets: first one pair per document, then those between
components that are still apart. Small regions have all their pairs compared.
Larger ones whose members are not of one component by then are searched exactly:
two sets that are similar enough share one of their rarest shingles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .common import joined
from .components import components
from .shingles import mixed, rolling, word_hashes

SHINGLE = 5
TREES = 20
PREFIX = 4
DEEPER = 4
NEIGHBOURS = 4
#: Signature estimates lie within 0.03 of the truth (one standard deviation), so 0.17 below the threshold loses nothing.
ESTIMATE_SLACK = 0.17
#: Places of the table that tells common shingles from rare ones, and shingles it is filled from; both bound what the driver holds.
RARITY_BITS = 22
RARITY_SHINGLES = 1 << 22
BLOCK = 4096
BATCH_BYTES = 16 << 20

_random = np.random.default_rng(20240301)
FACTORS = _random.integers(0, 1 << 31, TREES * (PREFIX + DEEPER), dtype=np.uint32)[:, None] * np.uint32(2) + np.uint32(1)
TERMS = _random.integers(0, 1 << 32, TREES * (PREFIX + DEEPER), dtype=np.uint32)[:, None]


def shingle_set(text: str | None, length: int = SHINGLE) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; of fewer words, one of the whole sequence."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(rolling(word_hashes(words), min(length, len(words))) + np.uint64(min(length, len(words))))


def signature(shingles: np.ndarray) -> np.ndarray:
    """Smallest value of the set under each hash function."""
    small = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(len(FACTORS), 0xFFFFFFFF, np.uint32)
    for i in range(0, len(small), BLOCK):
        np.minimum(out, (small[i : i + BLOCK] * FACTORS + TERMS).min(axis=1), out=out)
    return out


def folded(values: np.ndarray, bits: int) -> np.ndarray:
    """Each row of values as one 64-bit number: hashed if bits is 64, else the top bits of each in order."""
    out = np.zeros(len(values), np.uint64)
    for column in values.T.astype(np.uint64):
        out = mixed(out * np.uint64(31) + column) if bits == 64 else (out << np.uint64(bits)) | (column >> np.uint64(32 - bits))
    return out


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, copy, prefixes, deeper, sketch) of rows of (doc_id, text); `copy` tells sets apart."""
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("n_shingles", pa.int64()),
            ("copy", pa.binary()),
            ("prefixes", pa.list_(pa.int64())),
            ("deeper", pa.list_(pa.int64())),
            ("sketch", pa.binary()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                shingles = shingle_set(text.as_py())
                if not len(shingles):
                    rows.append((doc_id, 0, None, None, None, None))
                    continue
                values = signature(shingles)
                trees = values.reshape(TREES, PREFIX + DEEPER)
                low = (values & np.uint32(15)).astype(np.uint8)
                rows.append(
                    (
                        doc_id,
                        len(shingles),
                        xxhash.xxh3_128_digest(shingles.tobytes()),
                        folded(trees[:, :PREFIX], 64).view(np.int64),
                        folded(trees[:, PREFIX:], 16).view(np.int64),
                        (low[::2] << 4 | low[1::2]).tobytes(),
                    )
                )
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(v, type=f.type) for v, f in zip(zip(*rows), schema)], schema=schema)

    return docs.mapInArrow(
        run, "doc_id long, n_shingles long, copy binary, prefixes array<long>, deeper array<long>, sketch binary"
    )


def within(small: DataFrame) -> DataFrame:
    """(a, b) of all members of each region; for regions of few members."""
    members = small.groupBy("tree", "prefix").agg(F.sort_array(F.collect_set("rep")).alias("r"))

    def later(x: F.Column, i: F.Column) -> F.Column:
        return F.transform(F.slice("r", i + 2, F.size("r")), lambda y: F.struct(x.alias("a"), y.alias("b")))

    return members.select(F.inline(F.flatten(F.transform("r", later))))


def neighbours(crowded: DataFrame, width: int) -> DataFrame:
    """(a, b) of members of a region at most `width` places apart in the sorted order.

    Pairs over the border of two tasks are not made.
    """
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [np.empty(0, np.int64)] * 3
        for batch in batches:
            now = [np.concatenate([k, batch.column(i).to_numpy(zero_copy_only=False)]) for i, k in enumerate(kept)]
            fresh = len(kept[0])
            first, second = [], []
            for step in range(1, width + 1):
                at = np.arange(max(step, fresh), len(now[0]))
                at = at[(now[0][at] == now[0][at - step]) & (now[1][at] == now[1][at - step])]
                first.append(now[2][at])
                second.append(now[2][at - step])
            x, y = np.concatenate(first), np.concatenate(second)
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], schema=schema)
            kept = [c[-width:] for c in now]

    ordered = crowded.repartitionByRange("tree", "prefix", "deep", "rep").sortWithinPartitions("tree", "prefix", "deep", "rep")
    return ordered.select("tree", "prefix", "rep").mapInArrow(run, "a long, b long").where("a <> b")


def plausible(pairs: DataFrame, reps: DataFrame, least: float) -> DataFrame:
    """Pairs that the sizes allow and the sketches do not rule out."""
    light = reps.select("rep", "n", "sketch")
    both = pairs.join(light.select(F.col("rep").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("s_a")), "a")
    both = both.join(light.select(F.col("rep").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("s_b")), "b")
    both = both.where(F.least("n_a", "n_b") >= F.greatest("n_a", "n_b") * F.lit(least - 1e-9))
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (
                np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for i in (2, 3)
            )
            differ = x ^ y
            same = ((differ >> 4) == 0).sum(axis=1) + ((differ & 15) == 0).sum(axis=1)
            estimate = (same / (2 * x.shape[1]) - 1 / 16) * 16 / 15
            at = pa.array(np.flatnonzero(estimate >= least - ESTIMATE_SLACK))
            yield pa.RecordBatch.from_arrays([batch.column(i).take(at) for i in (0, 1)], schema=schema)

    return both.select("a", "b", "s_a", "s_b").mapInArrow(run, "a long, b long")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sets meet the similarity, compared as wholes."""
    both = pairs.join(sets.select(F.col("rep").alias("a"), F.col("shingles").alias("s_a")), "a")
    both = both.join(sets.select(F.col("rep").alias("b"), F.col("shingles").alias("s_b")), "b")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for i in range(batch.num_rows):
                x, y = (np.frombuffer(batch.column(k)[i].as_buffer(), "<u8") for k in (2, 3))
                shared = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * shared >= percent * (len(x) + len(y) - shared):
                    keep.append(i)
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(i).take(at) for i in (0, 1)], schema=schema)

    return both.select("a", "b", "s_a", "s_b").mapInArrow(run, "a long, b long")


def shingle_sets(docs: DataFrame) -> DataFrame:
    """(rep, shingles) of rows of (doc_id, text), the set as sorted little-endian 64-bit numbers."""
    schema = pa.schema([("rep", pa.int64()), ("shingles", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sets, size = [], [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids.append(doc_id)
                sets.append(shingle_set(text.as_py()).astype("<u8").tobytes())
                size += len(sets[-1])
                if size >= BATCH_BYTES:
                    yield pa.RecordBatch.from_pydict({"rep": ids, "shingles": sets}, schema=schema)
                    ids, sets, size = [], [], 0
            if ids:
                yield pa.RecordBatch.from_pydict({"rep": ids, "shingles": sets}, schema=schema)

    return docs.mapInArrow(run, "rep long, shingles binary")


def between(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """Pairs whose ends lie in different components so far."""
    at = found.select(F.col("node").alias("a"), F.col("component").alias("c_a"))
    to = found.select(F.col("node").alias("b"), F.col("component").alias("c_b"))
    both = pairs.join(at, "a", "left").join(to, "b", "left")
    return both.where(F.coalesce("c_a", "a") != F.coalesce("c_b", "b")).select("a", "b")


def open_members(crowded: DataFrame, found: DataFrame) -> DataFrame:
    """(rep, component) of members of regions that neighbours don't cover and that hold several components."""
    at = crowded.where(F.col("n") > NEIGHBOURS + 1).select("tree", "prefix", "rep")
    at = at.join(found.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    apart = at.groupBy("tree", "prefix").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    return at.join(apart.select("tree", "prefix"), ["tree", "prefix"], "left_semi").select("rep", "component").distinct()


def places(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - RARITY_BITS)).astype(np.int64)


def commonness(sets: DataFrame, total: int) -> np.ndarray:
    """How often, up to 255, shingles stand at each place of the table, in so many sets that it doesn't fill up."""
    every = -(-max(total, 1) // RARITY_SHINGLES)
    schema = pa.schema([("place", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = [np.frombuffer(x.as_buffer(), "<u8") for x in batch.column(0)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in np.unique(places(np.concatenate(found)), return_counts=True)], schema=schema)

    drawn = sets.where(F.pmod(F.xxhash64("rep"), F.lit(every)) == 0).select("shingles")
    often = drawn.mapInArrow(run, "place long, n long").groupBy("place").agg(F.least(F.sum("n"), F.lit(255)).alias("n")).where("n > 1").toArrow()
    table = np.zeros(1 << RARITY_BITS, np.uint8)
    table[often.column("place").to_numpy()] = often.column("n").to_numpy()
    return table


def rarest(sets: DataFrame, common: np.ndarray, percent: int) -> DataFrame:
    """(shingle, rep, component, n, at, short): the rarest shingles of each set, by one order for all sets.

    A set of n shares `percent` of the union with a set of m >= n only if one of
    its n - 2np/(100+p) + 1 rarest is among the other's m - mp/100 + 1 rarest.
    `short` marks the former, `at` is the place in the set's order.
    """
    shared = sets.sparkSession.sparkContext.broadcast(common)
    names = ["shingle", "rep", "component", "n", "at", "short"]
    schema = pa.schema([*((n, pa.int64()) for n in names[:-1]), ("short", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, size = [], 0
            for rep, component, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                own = np.frombuffer(x.as_buffer(), "<u8")
                n = len(own)
                long = n + (-n * percent) // 100 + 1
                short = n + (-2 * n * percent) // (100 + percent) + 1
                # the sets are sorted, so equal counts stay in the order of the hashes
                order = np.argsort(shared.value[places(own)], kind="stable")[:long]
                at = np.arange(len(order))
                parts.append((own[order].view(np.int64), np.full(len(at), rep), np.full(len(at), component), np.full(len(at), n), at, at < short))
                size += len(at)
                if size >= 1 << 18:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts)], schema=schema)
                    parts, size = [], 0
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts)], schema=schema)

    columns = "shingle long, rep long, component long, n long, at long, short boolean"
    return sets.select("rep", "component", "shingles").mapInArrow(run, columns)


def sharing(postings: DataFrame, percent: int) -> DataFrame:
    """(a, b) of all sets of different components that can be similar enough, by a prefix-filter join.

    Of the holders of a shingle, those of its largest component are not met
    among themselves, so a group found before costs no pairs.
    """
    held = postings.groupBy("shingle", "component").agg(F.count("*").alias("k"))
    mixed = held.groupBy("shingle").agg(F.count("*").alias("components"), F.max(F.struct("k", "component")).alias("most")).where("components > 1")
    rows = stored(postings.join(mixed.select("shingle", F.col("most.component").alias("main")), "shingle"), "shared-shingles")
    x = rows.where("component <> main").select("shingle", *[F.col(c).alias(f"{c}_x") for c in ("rep", "component", "n", "at", "short")])
    y = rows.select("shingle", "main", *[F.col(c).alias(f"{c}_y") for c in ("rep", "component", "n", "at", "short")])
    least = f"{percent} * (n_x + n_y)"
    smaller = "CASE WHEN n_x < n_y OR (n_x = n_y AND rep_x < rep_y) THEN short_x ELSE short_y END"
    rest = f"{100 + percent} * least(n_x - at_x, n_y - at_y) >= {least}"
    once = "component_x <> component_y AND (component_y = main OR rep_x < rep_y)"
    met = x.join(y, "shingle").where(f"{once} AND {smaller} AND 100 * least(n_x, n_y) >= {percent} * greatest(n_x, n_y) AND {rest}")
    return met.select(F.least("rep_x", "rep_y").alias("a"), F.greatest("rep_x", "rep_y").alias("b")).distinct()


def near_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = 85) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Documents are linked if their sets of 5-word shingles share at least
    `percent` of their union; `component_id` is the smallest id reachable.
    Every link is exact. A pair at the threshold shares no region of any order
    with a probability of (1 - 0.85**4) ** 20, 4e-7 (at 80 percent, 3e-5); one
    that shares a region is found, however many members the region has.

    Null or empty text: no shingles, linked with nothing. Rows with one id are
    one document. Null ids: linked through equal sets only; they get the
    component of the smallest id with that set and are not kept, or none and
    are kept. Equal sets are one class and compared once. Empty table: no rows.
    """
    least = percent / 100
    base = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    measured = stored(signatures(base), "signatures")
    reps = stored(
        measured.where("n_shingles > 0 AND doc_id IS NOT NULL")
        .groupBy("copy")
        .agg(F.min("doc_id").alias("rep"), *[F.first(c).alias(c) for c in ("prefixes", "deeper", "sketch")], F.first("n_shingles").alias("n")),
        "classes",
    )
    trees = reps.select("rep", F.posexplode(F.arrays_zip("prefixes", "deeper")).alias("tree", "x"))
    trees = trees.select("tree", F.col("x.prefixes").alias("prefix"), F.col("x.deeper").alias("deep"), "rep")
    regions = stored(trees.groupBy("tree", "prefix").agg(F.count("*").alias("n")).where("n > 1"), "regions")
    crowded = stored(trees.join(regions, ["tree", "prefix"]), "crowded")
    score = crowded.groupBy("rep").agg(F.sum("n").alias("score"))
    hubs = stored(
        crowded.join(score, "rep").groupBy("tree", "prefix").agg(F.max(F.struct("score", (-F.col("rep")).alias("least"))).alias("hub")), "hubs"
    )
    stars = (
        crowded.join(hubs.select("tree", "prefix", (-F.col("hub.least")).alias("hub")), ["tree", "prefix"])
        .where("rep <> hub")
        .groupBy("rep", "hub")
        .agg(F.count("*").alias("shared"))
    )
    stars = stored(stars, "stars")
    # small regions have all their pairs; large ones those of neighbours, and the exact search below for what these miss
    small = F.col("n") <= NEIGHBOURS + 1
    near = within(crowded.where(small)).union(neighbours(crowded.where(~small), NEIGHBOURS))
    pairs = stars.select(F.least("rep", "hub").alias("a"), F.greatest("rep", "hub").alias("b")).union(near).distinct()
    pairs = stored(plausible(pairs, reps, least), "pairs")
    best = stars.groupBy("rep").agg(F.max(F.struct("shared", (-F.col("hub")).alias("hub"))).alias("best"))
    best = best.select("rep", (-F.col("best.hub")).alias("hub")).select(F.least("rep", "hub").alias("a"), F.greatest("rep", "hub").alias("b"))
    ends = stored(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "ends")
    sets = stored(shingle_sets(base.join(ends, "doc_id", "left_semi")), "sets")
    first = stored(confirmed(best.distinct().join(pairs, ["a", "b"], "left_semi"), sets, percent), "links")
    so_far = components(first)
    second = stored(confirmed(between(pairs, so_far), sets, percent), "links")
    links = first.union(second)
    found = stored(components(links), "components")
    members = stored(open_members(crowded, found).join(reps.select("rep", "n"), "rep"), "open-members")
    total = members.agg(F.sum("n")).first()[0]
    if total:
        whole = stored(shingle_sets(base.join(members.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")), "sets")
        postings = rarest(whole.join(members, "rep"), commonness(whole, total), percent)
        rest = plausible(sharing(stored(postings, "rarest"), percent), reps, least)
        found = components(links.union(stored(confirmed(rest, whole, percent), "links")))
    classes = reps.select("copy", "rep").join(found.withColumnRenamed("node", "rep"), "rep", "left")
    classes = stored(classes.select("copy", F.coalesce("component", "rep").alias("component_id")), "members")
    out = measured.select("doc_id", "n_shingles", "copy").join(classes, "copy", "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept")
    )


def without_near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = 85) -> DataFrame:
    """The rows of the documents that are kept, with all their columns."""
    kept = near_dedup(docs, doc_id, text, percent).where("kept").select(F.col("doc_id").alias("_kept")).distinct()
    return docs.join(kept, docs[f"`{doc_id}`"].eqNullSafe(kept["_kept"]), "left_semi")

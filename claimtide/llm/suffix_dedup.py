"""Suffix-array dedup: strings of 400 bytes that start in two places, found by merging Burrows-Wheeler transforms.

Sieve: strings of 400 bytes that are equal have the same anchor, the smallest
hash of the 150-byte runs in them. Spark counts anchors; only places under an
anchor that occurs twice go on, as pieces: the windows of a text that follow
each other under one anchor. Equal pieces fold to one with a count.

Merge: pieces under one anchor meet in one task, a bounded number of shards at a
time. Each shard is sorted to a suffix array once and kept as its transform and
the step from each row to the row of the character before it. The interleave of
all shards starts as one block of the rows behind each window. One refinement
puts the rows in the order of the characters before them, keeping the order they
have, and cuts blocks where characters or earlier blocks differ; rows of a block
then have one more character in common. A row alone in its block has met its
longest common prefix and leaves. Blocks left after 400 refinements are the
repeated strings. No suffix is sorted again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .common import joined
from .shingles import rolling

WINDOW = 400
#: Bytes of a run that anchors are hashes of; 251 runs start in a window.
RUN = 150
SPAN = WINDOW - RUN + 1
#: Most windows of a piece, and windows of a text looked at together.
PIECE = 400
CHUNK = 1 << 20
#: Bytes of a shard, and of pieces that are merged together, as far as whole anchors go in.
SHARD = 1 << 18
MERGED = 1 << 20
#: Different pieces under one anchor that one task merges; more are decided by counts of hashes.
CROWD = 16_384
#: Bytes between two prunings of the blocks, a multiple of four as WINDOW is.
PRUNED = 8
ROWS = 1 << 16
RANDOM = np.random.Generator(np.random.PCG64(20260101))
BYTES = RANDOM.integers(1, 1 << 64, 256, dtype=np.uint64)
OTHER_BYTES = RANDOM.integers(1, 1 << 64, 256, dtype=np.uint64)
SPANS = "array<struct<first:long,end:long>>"
STARTS = "array<struct<first:int,end:int>>"


def sliding(values: np.ndarray, span: int, pick) -> np.ndarray:
    """`pick` (minimum or maximum) over every `span` values."""
    done = 1
    while done * 2 <= span:
        values = pick(values[:-done], values[done:])
        done *= 2
    rest = span - done
    return pick(values[: len(values) - rest], values[rest:]) if rest else values


def chunks(data: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Bytes of CHUNK windows at a time, and the place of the first."""
    for low in range(0, len(data) - WINDOW + 1, CHUNK):
        yield low, data[low : low + CHUNK + WINDOW - 1]


def text_anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Anchors of all windows, ascending, and 2 for those that stand in two places, else 1 (2 also at the seams of chunks)."""
    found = []
    for _, part in chunks(data):
        runs = rolling(BYTES[part], RUN)
        least = np.zeros(len(runs) + SPAN - 1, np.uint64)
        least[SPAN - 1 : len(runs)] = sliding(runs, SPAN, np.minimum)
        # a run is the anchor of a window if it is as small as the largest anchor of the windows over it
        found.append(runs[sliding(least, SPAN, np.maximum) == runs])
    if not found:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    values, counts = np.unique(np.concatenate(found), return_counts=True)
    return values, np.minimum(counts, 2)


def measured(docs: DataFrame) -> DataFrame:
    """(key, origin, anchors) of rows of (key, origin, text)."""
    pair = pa.struct([("anchor", pa.int64()), ("places", pa.int64())])
    schema = pa.schema([("key", pa.binary()), ("origin", pa.int64()), ("anchors", pa.list_(pair))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, parts = [0], []
            for text in batch.column(2):
                values, places = text_anchors(np.frombuffer(text.as_buffer(), np.uint8))
                parts.append((values.view(np.int64), places))
                sizes.append(len(values))
            if parts:
                flat = pa.StructArray.from_arrays([pa.array(np.concatenate(x)) for x in zip(*parts)], fields=list(pair))
                lists = pa.ListArray.from_arrays(pa.array(np.cumsum(sizes), pa.int32()), flat)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], schema=schema)

    return docs.mapInArrow(run, "key binary, origin long, anchors array<struct<anchor:long,places:long>>")


def pieces(marked: DataFrame) -> DataFrame:
    """(anchor, digest, key, first, windows, many) of rows of (key, many, shared, text): runs of windows under a shared anchor."""
    schema = pa.schema(
        [("anchor", pa.int64()), ("digest", pa.binary()), ("key", pa.binary()), ("first", pa.int64()), ("windows", pa.int64()), ("many", pa.bool_())]
    )

    def of_text(key: bytes, many: bool, shared: np.ndarray, text: bytes) -> Iterator[tuple]:
        data = np.frombuffer(text, np.uint8)
        for low, part in chunks(data):
            least = sliding(rolling(BYTES[part], RUN), SPAN, np.minimum)
            at = np.flatnonzero(np.isin(least, shared))
            if not len(at):
                continue
            values = least[at]
            cuts = np.flatnonzero((np.diff(at) != 1) | (values[1:] != values[:-1])) + 1
            for begin, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(at)]):
                anchor = int(values[begin].view(np.int64))
                for i in range(begin, end, PIECE):
                    first, windows = low + int(at[i]), min(PIECE, end - i)
                    yield anchor, xxhash.xxh3_128_digest(text[first : first + windows + WINDOW - 1]), key, first, windows, many

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            for i in range(batch.num_rows):
                shared = batch.column(2)[i].values.to_numpy().view(np.uint64)
                for row in of_text(batch.column(0)[i].as_py(), batch.column(1)[i].as_py(), shared, batch.column(3)[i].as_py()):
                    rows.append(row)
                    if len(rows) == ROWS:
                        yield table_of(rows, schema)
                        rows = []
        if rows:
            yield table_of(rows, schema)

    return marked.select("key", "many", "shared", F.col("text").cast("binary").alias("text")).mapInArrow(
        run, "anchor long, digest binary, key binary, first long, windows long, many boolean"
    )


def table_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def sorted_keys(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys in order and the places they come from, equal ones as they stood; by one sort of plain numbers.

    Key and place share 63 bits.
    """
    bits = np.int64(len(keys).bit_length())
    packed = np.sort(keys << bits | np.arange(len(keys)))
    return packed >> bits, packed & ((np.int64(1) << bits) - 1)


def suffix_order(codes: np.ndarray, ends: np.ndarray, longest: int) -> np.ndarray:
    """Suffix array of texts that each end in a 0 of their own, earlier ones smaller; `ends` has the place of that 0.

    The numbers of all suffixes' places must fit in 21 bits.
    """
    n = len(codes)
    key, alive = np.zeros(n, np.int64), np.ones(n, bool)
    near = np.concatenate([codes, np.zeros(4, np.int64)])
    for i in range(4):
        own = near[i : i + n]
        key = key << 9 | np.where(alive, own, 0)
        alive &= own != 0
    reach, places = 4, np.arange(n)
    while True:
        ordered, order = sorted_keys(key)
        new = np.diff(ordered) != 0
        # what is equal to its end goes by that end
        if reach > longest or new.all():
            return order
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(new)])
        ahead = np.minimum(places + reach, n - 1)
        key = rank * (n + 2) + np.where(places + reach <= ends, rank[ahead] + 1, 0)
        reach *= 2


class Shard:
    """Transform of some pieces, four bytes at a time.

    `letters`: the four bytes before each row of the suffix array, the farthest
    one first; `back`: the row that starts with them.
    """

    def __init__(self, texts: list[bytes]):
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        ends = np.cumsum(sizes + 1) - 1
        codes = np.zeros(int(ends[-1]) + 1, np.int64)
        real = np.ones(len(codes), bool)
        real[ends] = False
        codes[real] = np.frombuffer(b"".join(texts), np.uint8).astype(np.int64) + 1
        order = suffix_order(codes, np.repeat(ends, sizes + 1), int(sizes.max()))
        before = codes[order - 1].astype(np.uint16)
        self.back = np.empty(len(order), np.int64)
        self.back[np.argsort(before, kind="stable")] = np.arange(len(order))
        self.letters = (before.astype(np.int64) - 1) & 0xFF
        for bits in (8, 16):
            self.letters |= self.letters[self.back] << bits
            self.back = self.back[self.back]
        row = np.empty(len(order), np.int32)
        row[order] = np.arange(len(order), dtype=np.int32)
        firsts = ends - sizes
        #: For each window, the row of the suffix behind it.
        self.rows = np.concatenate([row[f + WINDOW : f + s + 1] for f, s in zip(firsts, sizes)])


def merge(shards: list[Shard], weights: np.ndarray) -> np.ndarray:
    """Windows found again, as places in the joint list of all shards' windows.

    `weights`, per window: 2 where its piece occurs more than once. Those are
    found already and only stand in for their equals. A refinement takes four
    bytes: the sort by them keeps the order of rows that have the same four.
    """
    offsets = np.cumsum([0, *(len(s.back) for s in shards)])
    # row and letters in one number, so each refinement looks them up once
    before = np.concatenate([(s.back + o) << 32 | s.letters for s, o in zip(shards, offsets)])
    rows = np.concatenate([s.rows + o for s, o in zip(shards, offsets)])
    which = np.argsort(rows).astype(np.int32)
    rows, block = rows[which], np.zeros(len(rows), np.int32)
    for step in range(4, WINDOW + 1, 4):
        found = before[rows]
        letters, order = sorted_keys(found & 0xFFFFFFFF)
        block, which, rows = block[order], which[order], found[order] >> 32
        new = np.ones(len(rows), bool)
        new[1:] = (letters[1:] != letters[:-1]) | (block[1:] != block[:-1])
        if step % PRUNED and step < WINDOW:
            block = np.cumsum(new, dtype=np.int32)
            continue
        starts = np.flatnonzero(new)
        own = weights[which]
        open_ = (np.add.reduceat(own, starts, dtype=np.int64) > 1) & (np.minimum.reduceat(own, starts) == 1)
        sizes = np.diff(np.append(starts, len(rows)))
        keep = np.repeat(open_, sizes)
        rows, which = rows[keep], which[keep]
        block = np.repeat(np.arange(open_.sum(), dtype=np.int32), sizes[open_])
        if not len(rows):
            break
    return which[weights[which] == 1]


def ranges(sorted_starts: np.ndarray) -> list[dict[str, int]]:
    cuts = np.flatnonzero(np.diff(sorted_starts) > 1)
    firsts, lasts = sorted_starts[np.concatenate([[0], cuts + 1])], sorted_starts[np.concatenate([cuts, [len(sorted_starts) - 1]])]
    return [{"first": int(a), "end": int(b) + 1} for a, b in zip(firsts, lasts)]


FOUND = pa.schema([("anchor", pa.int64()), ("digest", pa.binary()), ("starts", pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())])))])


def merged(rows: list[tuple[int, bytes, bool, bytes]]) -> list[tuple]:
    """(anchor, digest, starts) of pieces that occur once and have windows found again, of (anchor, digest, again, text)."""
    shards, own, size = [], [], 0
    for row in rows:
        own.append(row[3])
        size += len(row[3])
        if size >= SHARD:
            shards.append(Shard(own))
            own, size = [], 0
    if own:
        shards.append(Shard(own))
    windows = np.array([len(r[3]) - WINDOW + 1 for r in rows])
    piece = np.repeat(np.arange(len(rows)), windows)
    weights = np.repeat(np.array([2 if r[2] else 1 for r in rows], np.int8), windows)
    found = np.sort(merge(shards, weights))
    places = found - (np.cumsum(windows) - windows)[piece[found]]
    at, firsts = np.unique(piece[found], return_index=True)
    return [(rows[i][0], rows[i][1], ranges(x)) for i, x in zip(at, np.split(places, firsts[1:]))]


def found_by_merge(compared: DataFrame) -> DataFrame:
    """(anchor, digest, starts) of rows of (anchor, digest, again, text), whole anchors to a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for anchor, digest, again, text in zip(*(c.to_pylist() for c in batch.columns)):
                if size >= MERGED and anchor != held[-1][0]:
                    if found := merged(held):
                        yield table_of(found, FOUND)
                    held, size = [], 0
                held.append((anchor, digest, again, text))
                size += len(text)
        if held and (found := merged(held)):
            yield table_of(found, FOUND)

    return compared.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, f"anchor long, digest binary, starts {STARTS}")


def found_by_hash(crowded: DataFrame) -> DataFrame:
    """The same for anchors with too many pieces for one task: windows counted by 128 bits of hash."""
    schema = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("anchor", pa.int64()), ("digest", pa.binary()), ("again", pa.bool_()), ("at", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for anchor, digest, again, text in zip(*(c.to_pylist() for c in batch.columns)):
                data = np.frombuffer(text, np.uint8)
                hashes = [pa.array(rolling(t[data], WINDOW).view(np.int64)) for t in (BYTES, OTHER_BYTES)]
                n = len(hashes[0])
                same = [pa.array([x] * n, f.type) for x, f in zip((anchor, digest, again), list(schema)[2:])]
                yield pa.RecordBatch.from_arrays([*hashes, *same, pa.array(np.arange(n, dtype=np.int32))], schema=schema)

    def joint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts = [ranges(np.sort(x.values.to_numpy())) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(starts, FOUND.field(2).type)], schema=FOUND)

    windows = stored(crowded.mapInArrow(run, "h1 long, h2 long, anchor long, digest binary, again boolean, at int"), "windows")
    weight = F.when(F.col("again"), 2).otherwise(1)
    repeated = stored(windows.groupBy("h1", "h2").agg(F.sum(weight).alias("places")).where("places > 1").select("h1", "h2"), "repeated-windows")
    starts = windows.where("NOT again").join(repeated, ["h1", "h2"]).groupBy("anchor", "digest").agg(F.collect_set("at").alias("at"))
    return starts.mapInArrow(joint, f"anchor long, digest binary, starts {STARTS}")


def texts_of(marked: DataFrame, wanted: DataFrame) -> DataFrame:
    """(anchor, digest, again, text) of rows of (anchor, digest, again, key, first, windows), cut from the texts of the keys."""
    schema = pa.schema([("anchor", pa.int64()), ("digest", pa.binary()), ("again", pa.bool_()), ("text", pa.binary())])
    lists = wanted.groupBy("key").agg(F.collect_list(F.struct("anchor", "digest", "again", "first", "windows")).alias("cuts"))
    source = marked.select("key", F.col("text").cast("binary").alias("text")).join(lists, "key").select("cuts", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cuts, text in zip(batch.column(0), batch.column(1)):
                whole = text.as_py()
                rows = [(c["anchor"], c["digest"], c["again"], whole[c["first"] : c["first"] + c["windows"] + WINDOW - 1]) for c in cuts.as_py()]
                for low in range(0, len(rows), 4096):
                    yield table_of(rows[low : low + 4096], schema)

    return source.mapInArrow(run, "anchor long, digest binary, again boolean, text binary")


def covered(found: list[tuple[int, list[dict[str, int]]]]) -> list[tuple[int, int]]:
    """Maximal runs of bytes that windows cover, as (first, end), of (place of the piece, its ranges of windows)."""
    out: list[tuple[int, int]] = []
    for first, end in sorted((at + r["first"], at + r["end"] - 1 + WINDOW) for at, starts in found for r in starts):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((first, end))
    return out


def without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    parts, last = [], 0
    for first, end in spans:
        parts.append(text[last:first])
        last = end
    return b"".join([*parts, text[last:]])


def cut(found: DataFrame) -> DataFrame:
    """(key, spans, sha256 of the rest) of rows of (key, text, pieces)."""
    span = pa.struct([("first", pa.int64()), ("end", pa.int64())])
    schema = pa.schema([("key", pa.binary()), ("spans", pa.list_(span)), ("rest_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, text, own in zip(*batch.columns):
                spans = covered([(p["first"], p["starts"]) for p in own.as_py()])
                digest = hashlib.sha256(without(text.as_py(), spans)).hexdigest()
                rows.append((key.as_py(), [{"first": a, "end": b} for a, b in spans], digest))
            if rows:
                yield table_of(rows, schema)

    return found.select("key", F.col("text").cast("binary").alias("text"), "pieces").mapInArrow(run, f"key binary, spans {SPANS}, rest_sha256 string")


def remove_spans(docs: DataFrame, spans: str = "spans", text: str = "text") -> DataFrame:
    """Struct `row` of all columns of each row, and `kept`: the bytes of its text outside its spans."""
    source = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), docs[f"`{text}`"].cast("binary").alias("t"), docs[f"`{spans}`"].alias("s"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [without(t or b"", [(x["first"], x["end"]) for x in s or []]) for t, s in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.binary())], names=["row", "kept"])

    kinds = source.select("row", F.lit(b"").alias("kept")).schema
    return source.mapInArrow(run, kinds)


def suffix_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, `spans` of bytes to remove, `kept_sha256` of the rest.

    A byte goes if a string of 400 bytes over it also starts anywhere else, in
    this text or another; strings do not cross texts. `remove_spans` applies the
    spans; what it leaves may cut a character in two.

    Null or empty text: no bytes. Null ids, ids with several texts, repeated
    rows: each row counts as a text of its own, so equal texts of 400 bytes and
    more go as a whole. Long texts are looked at in parts that overlap. Ties:
    none, all places of a string go. Empty table: no rows.
    """
    value = F.coalesce(docs[f"`{text}`"], F.lit(""))
    base = docs.select(docs[f"`{doc_id}`"].cast("long").alias("doc_id"), F.unhex(F.sha2(value, 256)).alias("key"), value.alias("text"))
    sized = base.select("doc_id", "key", F.octet_length("text").cast("long").alias("n_bytes"))
    long_enough = sized.where(f"n_bytes >= {WINDOW}").groupBy("key").agg(F.count("*").alias("copies"), F.min("doc_id").alias("origin"))
    texts = stored(long_enough.select("key", "origin", (F.col("copies") > 1).alias("many")), "texts")

    # each text once: that of its smallest id; rows that agree in both only add suspects
    each = stored(measured(base.where(F.octet_length("text") >= WINDOW).select("key", F.col("doc_id").alias("origin"), "text")), "anchors")
    own = joined(texts, each, ["key", "origin"], "inner").select("key", "origin", "many", F.explode("anchors").alias("a"))
    own = own.select("key", "origin", "many", "a.anchor", F.when(F.col("many"), 2).otherwise(F.col("a.places")).alias("places"))
    shared = stored(own.groupBy("anchor").agg(F.sum("places").alias("places")).where("places > 1").select("anchor"), "shared")
    marks = own.join(shared, "anchor").groupBy("key", "origin", "many").agg(F.collect_set("anchor").alias("shared"))
    named = base.select("key", F.col("doc_id").alias("origin"), "text")
    marked = stored(joined(marks, named, ["key", "origin"], "inner").select("key", "many", "shared", "text"), "marked")

    found = stored(pieces(marked), "pieces")
    copies = F.sum(F.when(F.col("many"), 2).otherwise(1))
    single = found.groupBy("anchor", "digest").agg(copies.alias("copies"), F.min(F.struct("key", "first")).alias("at"), F.min("windows").alias("windows"))
    single = stored(single.select("anchor", "digest", (F.col("copies") > 1).alias("again"), "at.key", "at.first", "windows"), "single")
    # a piece that occurs once and has no other under its anchor holds that anchor twice
    groups = single.groupBy("anchor").agg(F.count("*").alias("different"), F.min(F.col("again").cast("int")).alias("least"))
    groups = stored(groups.where("least = 0").select("anchor", (F.col("different") > CROWD).alias("crowd")), "groups")
    compared = single.join(groups, "anchor")
    small = found_by_merge(texts_of(marked, compared.where("NOT crowd")))
    large = found_by_hash(texts_of(marked, compared.where("crowd")))
    whole = F.array(F.struct(F.lit(0).alias("first"), F.col("windows").cast("int").alias("end"))).cast(STARTS)
    again = single.where("again").select("anchor", "digest", whole.alias("starts"))
    hits = stored(again.unionByName(small).unionByName(large), "hits")

    mine = found.where("NOT many").join(hits, ["anchor", "digest"]).groupBy("key").agg(F.collect_list(F.struct("first", "starts")).alias("pieces"))
    rest = stored(cut(marked.where("NOT many").join(mine, "key")), "rest")
    result = rest.select("key", F.lit(False).alias("all"), "spans", "rest_sha256")
    gone = texts.where("many").select("key", F.lit(True).alias("all"), F.lit(None).cast(SPANS).alias("spans"), F.lit(hashlib.sha256().hexdigest()).alias("rest_sha256"))
    result = stored(result.unionByName(gone), "result")
    everything = F.array(F.struct(F.lit(0).cast("long").alias("first"), F.col("n_bytes").alias("end")))
    spans = F.when(F.col("all"), everything).otherwise(F.coalesce("spans", F.array().cast(SPANS)))
    out = sized.join(result, "key", "left").select("doc_id", "n_bytes", spans.alias("spans"), F.coalesce("rest_sha256", F.lower(F.hex("key"))).alias("kept_sha256"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, x: total + x["end"] - x["first"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), "spans", "kept_sha256")

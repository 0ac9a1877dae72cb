"""Line dedup: two Bloom filters sieve the lines, only suspected repeats are shuffled and confirmed.

Partitions set the bits of line keys seen once and seen twice; slices of the
filters merge by (once | once, twice | twice | once & once). The filter of keys
seen twice, of a bounded size, goes to all executors. A filter too small for the
data lets more lines through to the exact step; it never loses a repeat.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stored
from .common import SPACE_CHARS, joined, packed

HASHES = 3
SLICE_BITS = 1 << 20
FLUSH_KEYS = 1 << 20
BITS_PER_DOCUMENT = 128
#: 32 MB a filter at most, however large the input.
MAX_BITS = 1 << 28
BATCH_BYTES = 16 << 20
STRIPPED = SPACE_CHARS.encode()


def line_key(line: bytes, least: int) -> bytes | None:
    """128-bit key of a line without outer white space and A-Z lower-cased; None if it has fewer code points than `least`."""
    line = line.strip(STRIPPED).lower()
    if len(line) < least or (len(line) < 4 * least and len(line.decode()) < least):
        return None
    return xxhash.xxh3_128_digest(line)


def document_keys(text: str | None, least: int) -> set[bytes]:
    keys = {line_key(line, least) for line in (text or "").encode().split(b"\n")}
    keys.discard(None)
    return keys


def bit_places(keys: list[bytes], bits: int) -> np.ndarray:
    """Places of each key's bits, one row a key."""
    halves = np.frombuffer(b"".join(keys), dtype="<u8").reshape(-1, 2)
    steps = np.arange(HASHES, dtype=np.uint64)
    return (halves[:, :1] + steps * (halves[:, 1:] | np.uint64(1))) % np.uint64(bits)


def sieve(docs: DataFrame, bits: int, least: int) -> DataFrame:
    """(slice, twice): bits of keys that two or more documents may hold."""

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[bytes] = []
        for batch in batches:
            for text in batch.column(0):
                keys.extend(document_keys(text.as_py(), least))
                if len(keys) >= FLUSH_KEYS:
                    yield from flushed(keys)
                    keys = []
        if keys:
            yield from flushed(keys)

    def flushed(keys: list[bytes]) -> Iterator[pa.RecordBatch]:
        keys.sort()
        again = {a for a, b in zip(keys, keys[1:]) if a == b}
        once = np.unique(bit_places(keys, bits))
        twice = np.unique(bit_places(list(again), bits)) if again else np.empty(0, np.uint64)
        for number in np.unique(once // SLICE_BITS).tolist():
            low, high = number * SLICE_BITS, (number + 1) * SLICE_BITS
            parts = [(x[np.searchsorted(x, low) : np.searchsorted(x, high)] - low).astype("<u4").tobytes() for x in (once, twice)]
            yield pa.RecordBatch.from_pydict({"slice": [number], "once": [parts[0]], "twice": [parts[1]]}, schema=sparse)

    sparse = pa.schema([("slice", pa.int64()), ("once", pa.binary()), ("twice", pa.binary())])
    dense = pa.schema([("slice", pa.int64()), ("twice", pa.binary())])

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, once, twice = None, None, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["slice"] != now:
                    if now is not None and twice.any():
                        yield pa.RecordBatch.from_pydict({"slice": [now], "twice": [np.packbits(twice).tobytes()]}, schema=dense)
                    now, once, twice = row["slice"], np.zeros(SLICE_BITS, bool), np.zeros(SLICE_BITS, bool)
                places = np.frombuffer(row["once"], "<u4")
                twice[places[once[places]]] = True
                once[places] = True
                twice[np.frombuffer(row["twice"], "<u4")] = True
        if now is not None and twice.any():
            yield pa.RecordBatch.from_pydict({"slice": [now], "twice": [np.packbits(twice).tobytes()]}, schema=dense)

    parts = docs.mapInArrow(seen, "slice long, once binary, twice binary")
    dealt = parts.repartition(max(1, bits // SLICE_BITS), "slice").sortWithinPartitions("slice")
    return dealt.mapInArrow(merged, "slice long, twice binary")


def suspects(docs: DataFrame, twice: bytes, bits: int, least: int) -> DataFrame:
    """(doc_id, key) of keys whose bits all stand in the filter of keys seen twice."""
    filtered = docs.sparkSession.sparkContext.broadcast(twice)
    schema = pa.schema([("doc_id", pa.int64()), ("key", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = np.frombuffer(filtered.value, np.uint8)
        for batch in batches:
            ids, keys = [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = document_keys(text.as_py(), least)
                ids.extend([doc_id] * len(own))
                keys.extend(own)
            if not keys:
                continue
            places = bit_places(keys, bits)
            there = ((bitmap[places >> np.uint64(3)] >> (7 - (places & np.uint64(7))).astype(np.uint8)) & 1).all(axis=1)
            at = np.flatnonzero(there).tolist()
            yield pa.RecordBatch.from_pydict({"doc_id": [ids[i] for i in at], "key": [keys[i] for i in at]}, schema=schema)

    return docs.mapInArrow(run, "doc_id long, key binary")


def without_lines(df: DataFrame, least: int) -> DataFrame:
    """Adds n_lines, n_dropped and kept_text to rows of (row, text, dropped keys)."""
    added = [T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType()), T.StructField("kept_text", T.StringType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            schema = pa.schema([batch.schema.field(0), ("n_lines", pa.int64()), ("n_dropped", pa.int64()), ("kept_text", pa.string())])
            start, rows, size = 0, [], 0
            for i in range(batch.num_rows):
                text, dropped = batch.column(1)[i].as_py() or "", batch.column(2)[i].as_py()
                lines = text.split("\n")
                keep = lines
                if dropped:
                    gone = set(dropped)
                    keep = [line for line in lines if line_key(line.encode(), least) not in gone]
                rows.append((len(lines), len(lines) - len(keep), "\n".join(keep)))
                size += len(text)
                if size >= BATCH_BYTES or i == batch.num_rows - 1:
                    arrays = [pa.array(v, type=f.type) for v, f in zip(zip(*rows), list(schema)[1:])]
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, i + 1 - start), *arrays], schema=schema)
                    start, rows, size = i + 1, [], 0

    return df.select("row", "text", "dropped").mapInArrow(run, T.StructType([df.schema["row"], *added]))


def line_dedup(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    least: int = 20,
    documents: int = 3,
    bits: int | None = None,
    carry: list[str] | None = None,
) -> DataFrame:
    """Per row: struct `row` of the `carry` columns (default all), `n_lines`, `n_dropped`, `kept_text`.

    A line whose key has at least `least` code points and stands in at least
    `documents` documents stays only in the largest id that holds it.

    Null or empty text: one empty line. Null ids are one document together,
    smaller than any id. Rows with the same id are one document in the counts;
    each row comes out, and all agree on which keys go. A key that several rows
    of the largest id hold stays in all of them. Empty table: no rows.
    """
    wanted = docs.columns if carry is None else carry
    base = docs.select(
        F.struct(*[docs[f"`{c}`"] for c in wanted]).alias("row"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text")
    )
    if bits is None:
        bits = min(MAX_BITS, max(SLICE_BITS, docs.count() * BITS_PER_DOCUMENT // SLICE_BITS * SLICE_BITS))
    twice = bytearray(bits // 8)
    for part in sieve(base.select("text"), bits, least).collect():
        start = part["slice"] * SLICE_BITS // 8
        twice[start : start + SLICE_BITS // 8] = part["twice"]
    found = stored(suspects(base.select("doc_id", "text"), bytes(twice), bits, least).distinct(), "line-suspects")
    repeated = found.groupBy("key").agg(F.count("*").alias("n"), F.max("doc_id").alias("holder")).where(F.col("n") >= documents)
    repeated = stored(repeated, "repeated-lines")  # else the join would run where the counts are, in which Spark can't split a key
    dropped = (
        found.join(repeated, "key")
        .where(F.col("doc_id").isNull() | (F.col("doc_id") < F.col("holder")))
        .groupBy("doc_id")
        .agg(F.collect_set("key").alias("dropped"))
    )
    return without_lines(joined(base, dropped, ["doc_id"], "left"), least)

"""Substring dedup: Rabin-Karp hashes of every window of words, counted in Spark.

A window can only repeat if its anchor does: the smallest hash of the shorter
runs in it, which equal windows share. Anchors, about one per sixteen words, are
counted first; hashes of windows under anchors that two documents share are
then counted, and windows found again merge into maximal intervals.
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
from .shingles import rolling, word_hashes

WINDOW = 50
#: 20 words, so 31 runs start in a window, and two spans of 16 cover them.
RUN = 20
ROWS = 1 << 16


def window_anchors(hashes: np.ndarray) -> np.ndarray:
    """Smallest run hash of each window."""
    least = rolling(hashes, RUN)
    span = 1
    while span * 2 <= WINDOW - RUN + 1:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    rest = WINDOW - RUN + 1 - span
    return np.minimum(least[: len(least) - rest], least[rest:])


def spelled(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def measured_words(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, copy, key, anchors, sha256) of rows of (doc_id, text); `copy` and `key` tell word sequences apart."""
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("n_words", pa.int64()),
            ("copy", pa.binary()),
            ("key", pa.int64()),
            ("anchors", pa.list_(pa.int64())),
            ("sha256", pa.string()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = (text.as_py() or "").encode().split()
                joint = b" ".join(words)
                copy = xxhash.xxh3_128_digest(joint)
                anchors = np.empty(0, np.int64)
                if len(words) >= WINDOW:
                    anchors = np.unique(window_anchors(word_hashes(words))).view(np.int64)
                rows.append(
                    (doc_id, len(words), copy, int.from_bytes(copy[:8], "little", signed=True), anchors, hashlib.sha256(joint).hexdigest())
                )
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(v, type=f.type) for v, f in zip(zip(*rows), schema)], schema=schema)

    return docs.mapInArrow(run, "doc_id long, n_words long, copy binary, key long, anchors array<long>, sha256 string")


def marked_texts(found: DataFrame) -> DataFrame:
    """Rows whose text is the one that `key` stands for; rows with one id may have several texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for i in range(batch.num_rows):
                copy = xxhash.xxh3_128_digest(b" ".join((batch.column(2)[i].as_py() or "").encode().split()))
                if int.from_bytes(copy[:8], "little", signed=True) == batch.column(1)[i].as_py():
                    keep.append(i)
            yield batch.take(pa.array(keep, pa.int64()))

    return found.mapInArrow(run, found.schema)


def remove_spans(docs: DataFrame, spans: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, kept_text) of rows with their spans removed: words joined by one space. Ids must be unique and not null."""
    cuts = spans.select(F.col("doc_id").alias("_id"), "spans")
    found = docs.join(cuts, docs[f"`{doc_id}`"] == cuts["_id"]).select(F.col("_id").alias("doc_id"), F.col(text).alias("text"), "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("kept_text", pa.string())])
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), []
            for i in range(batch.num_rows):
                words, keep, last = (batch.column(1)[i].as_py() or "").encode().split(), [], 0
                for span in batch.column(2)[i].as_py():
                    keep += words[last : span["first"]]
                    last = span["end"]
                texts.append(b" ".join(keep + words[last:]).decode())
            yield pa.RecordBatch.from_pydict({"doc_id": ids, "kept_text": texts}, schema=schema)

    return found.mapInArrow(run, "doc_id long, kept_text string")


def windows(marked: DataFrame) -> DataFrame:
    """(hash, doc_id, key, at) of the windows under the shared anchors, of rows of (doc_id, key, text, shared)."""
    schema = pa.schema([("hash", pa.int64()), ("doc_id", pa.int64()), ("key", pa.int64()), ("at", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                doc_id, key = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                hashes = word_hashes(batch.column(2)[i].as_py().encode().split())
                shared = batch.column(3)[i].values.to_numpy().view(np.uint64)
                at = np.flatnonzero(np.isin(window_anchors(hashes), shared))
                values = rolling(hashes, WINDOW)[at].view(np.int64)
                for low in range(0, len(at), ROWS):
                    n = len(at[low : low + ROWS])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(values[low : low + ROWS]),
                            pa.array(np.full(n, doc_id, np.int64)),
                            pa.array(np.full(n, key, np.int64)),
                            pa.array(at[low : low + ROWS].astype(np.int32)),
                        ],
                        schema=schema,
                    )

    return marked.select("doc_id", "key", "text", "shared").mapInArrow(run, "hash long, doc_id long, key long, at int")


def intervals(starts: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of words that windows at these starts cover, as (first word, end)."""
    if not len(starts):
        return []
    starts = np.sort(starts)
    breaks = np.flatnonzero(np.diff(starts) > WINDOW)
    firsts = starts[np.concatenate([[0], breaks + 1])]
    lasts = starts[np.concatenate([breaks, [len(starts) - 1]])]
    return [(int(a), int(b) + WINDOW) for a, b in zip(firsts, lasts)]


SPANS = "array<struct<first:long,end:long>>"


def cut(found: DataFrame) -> DataFrame:
    """(doc_id, key, spans, n_removed, sha256) of rows of (doc_id, key, text, starts)."""
    span = pa.struct([("first", pa.int64()), ("end", pa.int64())])
    schema = pa.schema(
        [("doc_id", pa.int64()), ("key", pa.int64()), ("spans", pa.list_(span)), ("n_removed", pa.int64()), ("sha256", pa.string())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i in range(batch.num_rows):
                words = batch.column(2)[i].as_py().encode().split()
                spans = intervals(batch.column(3)[i].values.to_numpy())
                keep, last = [], 0
                for first, end in spans:
                    keep += words[last:first]
                    last = end
                keep += words[last:]
                spans_out = [{"first": a, "end": b} for a, b in spans]
                rows.append((batch.column(0)[i].as_py(), batch.column(1)[i].as_py(), spans_out, len(words) - len(keep), spelled(keep)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(v, type=f.type) for v, f in zip(zip(*rows), schema)], schema=schema)

    return found.select("doc_id", "key", "text", "starts").mapInArrow(run, f"doc_id long, key long, spans {SPANS}, n_removed long, sha256 string")


def substring_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, `spans` of words to remove, `kept_sha256` of the rest.

    A word goes if a window of 50 words that covers it also starts in a
    document with a smaller id. `remove_spans` applies the spans.

    Null or empty text: no words. Null ids take no part: nothing is removed from
    them or because of them. Rows with one id never remove each other's words.
    A text that wholly repeats one of a smaller id goes as a whole and is not
    compared further. Empty table: no rows.
    """
    base = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    words = stored(measured_words(base), "words")
    long_enough = words.where(f"n_words >= {WINDOW} AND doc_id IS NOT NULL")
    firsts = stored(long_enough.groupBy("copy").agg(F.min("doc_id").alias("origin")), "origins")
    # of equal texts only the one with the smallest id goes on
    anchors = firsts.withColumnRenamed("origin", "doc_id").join(long_enough.select("copy", "doc_id", "key", "anchors"), ["copy", "doc_id"])
    anchors = anchors.select("doc_id", "key", F.explode("anchors").alias("anchor"))
    shared = anchors.groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high").select("anchor")
    shared = stored(shared, "anchors")
    marks = anchors.join(shared, "anchor").groupBy("doc_id", "key").agg(F.collect_set("anchor").alias("shared"))
    marked = stored(marked_texts(base.join(marks, "doc_id").select("doc_id", "key", "text", "shared")), "marked-texts")
    seen = stored(windows(marked), "windows")
    repeated = seen.groupBy("hash").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high")
    repeated = stored(repeated.select("hash", "low"), "repeated-windows")
    starts = seen.join(repeated, "hash").where("doc_id > low").groupBy("doc_id", "key").agg(F.collect_set("at").alias("starts"))
    removed = cut(marked.select("doc_id", "key", "text").join(starts, ["doc_id", "key"])).distinct()
    out = words.select("doc_id", "n_words", "copy", "key", "sha256").join(firsts, "copy", "left")
    out = joined(out, removed.withColumnRenamed("sha256", "left_sha256"), ["doc_id", "key"], "left")
    again = F.col("doc_id") > F.col("origin")
    whole = F.array(F.struct(F.lit(0).cast("long").alias("first"), F.col("n_words").alias("end")))
    return out.select(
        "doc_id",
        "n_words",
        F.when(again, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(again, whole).otherwise(F.coalesce("spans", F.array().cast(SPANS))).alias("spans"),
        F.when(again, F.lit(spelled([]))).otherwise(F.coalesce("left_sha256", "sha256")).alias("kept_sha256"),
    )

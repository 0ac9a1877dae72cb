"""Fill-in-the-middle: texts cut in prefix, middle and suffix, and put in another order.

Cuts come from a hash of the id, made by Spark. Texts go through
`pyarrow.compute` a batch at a time: they are split into lists of units, the
lists flattened with the number of their text beside each unit, units counted
within their text, filtered by the piece they belong to, put in lists again and
joined. No text is handled by itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import let

#: A unit: white space and the word behind it, or white space at the end of a text.
UNIT = rb"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
#: A byte that UTF-8 never has.
BREAK = b"\xff"
#: Markers of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKERS = "<[PSM]>"
#: In percent: texts that are cut, and those of them with the suffix first.
CUT = 50
SUFFIX_FIRST = 80
SEED = 42
#: Bytes of text handled at once; a longer text by itself.
PORTION = 4 << 20
BINARY = pa.large_binary()


def draws(doc_id: Column, seed: int) -> list[Column]:
    """Four numbers of 32 bits from the SHA-256 of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def units(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """All units, the number of each one's text, and its place in that text, from 0."""
    lists = pc.split_pattern(pc.replace_substring_regex(texts, pattern=UNIT, replacement=BREAK + rb"\0"), pattern=BREAK)
    flat, parents = pc.list_flatten(lists), pc.list_parent_indices(lists).to_numpy()
    lengths = pc.list_value_length(lists).to_numpy()
    places = np.arange(len(parents)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    # what stands before the first unit is empty
    real = places > 0
    return flat.filter(pa.array(real)), parents[real], places[real] - 1


def rejoined(flat: pa.Array, parents: np.ndarray, chosen: np.ndarray, texts: int) -> pa.Array:
    """Per text, its chosen units as one value."""
    offsets = np.zeros(texts + 1, np.int32)
    np.cumsum(np.bincount(parents[chosen], minlength=texts), out=offsets[1:])
    lists = pa.ListArray.from_arrays(pa.array(offsets), flat.filter(pa.array(chosen)))
    return pc.binary_join(lists, pa.scalar(b"", BINARY))


def code_points(values: pa.Array) -> pa.Array:
    return pc.utf8_length(values.view(pa.large_string())).cast(pa.int64())


def arranged(texts: pa.Array, numbers: list[np.ndarray], cut: int, suffix_first: int) -> list[pa.Array]:
    """n, form, prefix_chars, middle_chars, output of texts."""
    h1, h2, h3, h4 = numbers
    flat, parents, places = units(texts)
    n = np.bincount(parents, minlength=len(texts))
    low, high = np.minimum(h1 % (n + 1), h2 % (n + 1)), np.maximum(h1 % (n + 1), h2 % (n + 1))
    first, last = places < low[parents], places >= high[parents]
    prefix, middle, suffix = (rejoined(flat, parents, x, len(texts)) for x in (first, ~first & ~last, last))
    marked = pc.match_substring_regex(texts, pattern=MARKERS).to_numpy(zero_copy_only=False)
    plain = pa.array((n == 0) | marked | (h3 % 100 >= cut))
    spm = pa.array(h4 % 100 < suffix_first)
    p, s, m, end = (pa.scalar(x.encode(), BINARY) for x in (PREFIX, SUFFIX, MIDDLE, ""))
    moved = pc.if_else(
        spm,
        pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, end),
        pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, end),
    )
    nothing = pa.scalar(None, pa.int64())
    return [
        pa.array(n, pa.int64()),
        pc.if_else(plain, "plain", pc.if_else(spm, "spm", "psm")),
        pc.if_else(plain, nothing, code_points(prefix)),
        pc.if_else(plain, nothing, code_points(middle)),
        pc.if_else(plain, texts, moved).view(pa.large_string()),
    ]


def portions(batch: pa.RecordBatch, sizes: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Slices of at most PORTION bytes of text, or of one row."""
    start = 0
    ends = np.cumsum(sizes)
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + PORTION, side="right")))
        yield batch.slice(start, end - start)
        start = end


def fill_in_middle(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    carry: list[str] | None = None,
    seed: int = SEED,
    cut: int = CUT,
    suffix_first: int = SUFFIX_FIRST,
) -> DataFrame:
    """Per row: struct `row` of the `carry` columns (default all), n, form, prefix_chars, middle_chars, output.

    `cut` percent of the ids have their text cut before two units drawn by the
    hash; `suffix_first` percent of those become spm, suffix prefix middle, the
    others psm, prefix suffix middle. All else is plain, output as it came.

    Null text: as an empty one, plain, output empty. Text with a marker of its
    own: plain, so every output can be taken back. Null id: drawn as an empty
    one. Repeated rows, columns of any name: each row by itself, its columns
    kept. Long texts: whole, one at a time. Equal draws: an empty middle. Empty
    table: no rows.
    """
    wanted = docs.columns if carry is None else carry
    row = F.struct(*[docs[f"`{c}`"] for c in wanted]).alias("row")
    numbers = [h.alias(f"h{i}") for i, h in enumerate(draws(docs[f"`{doc_id}`"], seed))]
    source = docs.select(row, F.coalesce(docs[f"`{text}`"], F.lit("")).alias("text"), *numbers)
    made = [("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in portions(whole, pc.binary_length(whole.column(1)).to_numpy()):
                texts = batch.column(1).cast(pa.binary()).cast(BINARY)
                columns = arranged(texts, [c.to_numpy() for c in batch.columns[2:]], cut, suffix_first)
                values = [c.cast(kind) for c, (_, kind) in zip(columns, made)]
                schema = pa.schema([batch.schema.field(0), *[pa.field(name, kind) for name, kind in made]])
                yield pa.RecordBatch.from_arrays([batch.column(0), *values], schema=schema)

    kinds = {"n": T.LongType(), "form": T.StringType(), "prefix_chars": T.LongType(), "middle_chars": T.LongType(), "output": T.StringType()}
    return source.mapInArrow(run, T.StructType([source.schema["row"], *[T.StructField(k, v) for k, v in kinds.items()]]))


def restored(form: Column, output: Column) -> Column:
    """The text that an output was made of; output as it is where the form is plain."""
    parts = F.split(output, MARKERS, -1)

    def joint(*places: int) -> Column:
        return let(parts, lambda x: F.concat(*[F.get(x, F.lit(i)) for i in places]))

    return F.when(form == "spm", joint(2, 3, 1)).when(form == "psm", joint(1, 3, 2)).otherwise(output)

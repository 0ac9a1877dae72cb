"""Quality rules: text statistics, and lines that too many documents of a host share.

Lines are normalised and hashed; a line above the limits of its host is taken
out; a document that loses too much of its words is depleted and rejected.
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .common import SPACE, SPACE_CHARS, joined, let, packed, words

REPEAT_WINDOW = 8


def line_key(line: Column) -> Column:
    """Hash of a line without outer white space and case."""
    return F.xxhash64(F.lower(F.btrim(line, F.lit(SPACE_CHARS))))


def window_hashes(found: Column) -> Column:
    """Hash of each run of REPEAT_WINDOW words, by joining neighbours three times over."""

    def doubled(items: Column, step: int) -> Column:
        return let(
            items,
            lambda x: F.zip_with(x, F.slice(x, step + 1, F.greatest(F.size(x), F.lit(1))), lambda a, b: F.xxhash64(a, b)),
        )

    runs = doubled(doubled(doubled(found, 1), 2), 4)
    return F.slice(runs, 1, F.greatest(F.size(found) - (REPEAT_WINDOW - 1), F.lit(0)))


def repeated_words(windows: Column) -> Column:
    """Words in windows whose hash stands twice or more in the array of all windows."""

    def covered(ordered: Column) -> Column:
        def twice(x, i):
            return F.coalesce(F.get(ordered, i - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(
                F.get(ordered, i + 1)["h"] == x["h"], F.lit(False)
            )

        starts = F.array_sort(F.transform(F.filter(ordered, twice), lambda x: x["i"]))
        return let(
            starts,
            lambda s: F.aggregate(
                F.transform(s, lambda p, j: F.least(F.coalesce(p - F.get(s, j - 1), F.lit(REPEAT_WINDOW)), F.lit(REPEAT_WINDOW))),
                F.lit(0).cast("long"),
                lambda total, n: total + n,
            ),
        )

    ordered = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")).otherwise(let(ordered, covered))


def statistics(df: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words to the `keep` columns.

    A null text counts as an empty one.
    """
    keep = keep or []
    split = df.select(*keep, F.col(text).alias("_t"), words(F.col(text)).alias("_w"))
    counted = split.select(
        *keep,
        F.size("_w").cast("long").alias("n_words"),
        F.char_length(F.array_join("_w", "")).alias("_chars"),
        F.regexp_count("_t", F.lit(r"[#*$%&|<>]")).alias("_symbols"),
        worded_lines(F.col("_t")).alias("_l"),
        window_hashes(F.col("_w")).alias("_h"),
    )
    zero = F.lit(0)
    return counted.select(
        *keep,
        "n_words",
        F.coalesce("_chars", zero).cast("long").alias("word_chars"),
        F.coalesce("_symbols", zero).cast("long").alias("n_symbols"),
        F.coalesce(F.size("_l") - F.size(F.array_distinct("_l")), zero).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("_h")).alias("n_repeat_words"),
    )


def has_word(line: Column) -> Column:
    return F.btrim(line, F.lit(SPACE_CHARS)) != ""


def worded_lines(text: Column) -> Column:
    """Lines of a text that hold a word."""
    return F.filter(F.split(text, "\n"), has_word)


def frequent_lines(docs: DataFrame, host: str, text: str, min_documents: int, max_share: float, always: int | None = None) -> DataFrame:
    """(host, key) of lines in at least `min_documents` texts and more than `max_share` of a host's texts, or in `always` texts.

    Documents are told apart by their text, so an exact copy adds nothing.
    """
    texts = docs.select(
        F.col(host).alias("host"),
        F.xxhash64(text).alias("copy"),
        F.array_distinct(F.transform(worded_lines(F.col(text)), line_key)).alias("keys"),
    )
    counts = (
        texts.select("host", "copy", F.explode("keys").alias("key"))
        .groupBy("host", "key")
        .agg(F.countDistinct("copy").alias("n"))
        .where(F.col("n") >= min_documents)
    )
    totals = texts.groupBy("host").agg(F.countDistinct("copy").alias("documents"))
    above = joined(counts, totals, ["host"], "inner")
    limit = F.col("n") > F.col("documents") * F.lit(max_share)
    return above.where(limit if always is None else limit | (F.col("n") >= always)).select("host", "key")


def without_lines(text: Column, at: Column) -> Column:
    """The text without its lines at these places, from 0: the runs of lines between them, joined, so each line is copied once."""

    def runs(lines: Column, gone: Column) -> Column:
        def run(k: Column) -> Column:
            first = F.coalesce(F.get(gone, k - 1) + 1, F.lit(0))
            return F.slice(lines, first + 1, F.coalesce(F.get(gone, k), F.size(lines)) - first)

        return F.flatten(F.transform(F.sequence(F.lit(0), F.size(gone)), run))

    return F.array_join(let(F.split(text, "\n"), lambda lines: let(F.sort_array(at), lambda gone: runs(lines, gone))), "\n")


def quality_rules(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    host: str = "source",
    min_documents: int = 20,
    max_share: float = 0.1,
    min_left: float = 0.5,
    min_words: int = 20,
    max_repeat: int = 30,
    always: int | None = None,
) -> DataFrame:
    """One row per input row: struct `row`, the statistics, `base_failed`, `n_removed_lines`, `n_left`, `clean_text`, `kept`.

    `clean_text` is the text without the lines above the limits. With `always`,
    a line in so many texts goes however large its host is. A document is
    depleted if fewer than `min_left` of its words stay.

    Null text: no words, so `base_failed`; `clean_text` is null. Null host: a
    host of its own. Null id: a row like any other. Repeated rows come out as
    often as they go in, count as one text, and agree. Empty table: no rows.
    Ties do not occur: every limit is a comparison of counts.
    """
    frequent = stored(frequent_lines(docs, host, text, min_documents, max_share, always), "frequent-lines")
    base = packed(docs, doc_id=F.col(doc_id), text=F.col(text), host=F.col(host), copy=F.xxhash64(text))
    lines = base.select("doc_id", "host", "copy", F.posexplode(F.split("text", "\n")).alias("at", "line"))
    lines = lines.where(has_word(F.col("line"))).withColumn("key", line_key(F.col("line")))
    hit = joined(lines, frequent, ["host", "key"], "inner")
    removed = hit.groupBy("doc_id", "host", "copy").agg(
        F.collect_set(F.struct("at", F.size(words(F.col("line"))).alias("n"))).alias("gone")
    )
    removed = stored(removed, "removed-lines")  # its size then tells whether the texts have to move
    measured = statistics(base, keep=["row", "doc_id", "host", "copy"])
    marked = joined(measured, removed, ["doc_id", "host", "copy"], "left")
    lost = F.aggregate("gone", F.lit(0).cast("long"), lambda total, x: total + x["n"])
    own = F.col("row")[text]
    clean = F.when(F.col("gone").isNull(), own).otherwise(without_lines(own, F.transform("gone", lambda x: x["at"])))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat * F.col("n_words"))
    return marked.select(
        "row",
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        F.coalesce(F.array_size("gone"), F.lit(0)).cast("long").alias("n_removed_lines"),
        (F.col("n_words") - F.coalesce(lost, F.lit(0))).alias("n_left"),
        clean.alias("clean_text"),
    ).withColumn("kept", ~F.col("base_failed") & (F.col("n_left") >= F.col("n_words") * F.lit(min_left)))

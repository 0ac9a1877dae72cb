"""Counts, cross tables, class reports and pair counts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import text, times
from . import ranking

#: Words whose pairs a task counts together, bytes of lines cut into words at once, and rows of a batch of counts.
PAIRED_WORDS = 1 << 22
PAIRED_BYTES = 1 << 25
PAIRED_ROWS = 1 << 16
METRICS = ["retweet_count", "reply_count", "like_count", "quote_count", "impression_count"]


def opened(df: DataFrame, *columns: str) -> DataFrame:
    """Array columns exploded (empty ones to null), others as they are."""
    for c in columns:
        if df.schema[c].dataType.typeName() == "array":
            df = df.withColumn(c, F.explode_outer(c))
    return df


def count_by(df: DataFrame, *keys) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("count"))


def means(df: DataFrame, metrics: list[str] | None = None) -> DataFrame:
    return df.agg(*[F.avg(m).alias(m) for m in metrics or METRICS])


def time_span(df: DataFrame, column: str = "date") -> DataFrame:
    spans = df.agg(F.min(column).alias("first"), F.max(column).alias("last"))
    return spans.withColumn("days", F.datediff("last", "first"))


def table_sizes(tables: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in tables.items():
        size = df.agg(F.count("*").alias("count")).select(F.lit(name).alias("name"), "count")
        out = size if out is None else out.unionByName(size)
    return out


def per_day(df: DataFrame, *keys: str, date: str = "date") -> DataFrame:
    opened_keys = opened(df, *keys)
    return opened_keys.groupBy(times.day_text(date).alias("day"), *keys).agg(F.count("*").alias("count"))


def share(counts: DataFrame, n: str = "count") -> Column:
    """Fraction of the grand total, which is a scalar subquery."""
    return F.try_divide(F.col(n), counts.agg(F.sum(n)).scalar())


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Count and percentage (one decimal) of each value, nulls left out."""
    counts = opened(df, column).where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("Counts"))
    return counts.withColumn("Percentages", F.round(share(counts, "Counts") * 100, 1)).orderBy(
        F.desc("Counts"), column
    )


def crosstab_counts(df: DataFrame, f1: str, f2: str) -> DataFrame:
    """Long cross table with both margins."""
    counts = opened(df, f1, f2).where(F.col(f1).isNotNull() & F.col(f2).isNotNull())
    counts = counts.groupBy(f1, f2).agg(F.count("*").alias("count"))
    rows = counts.groupBy(f1).agg(F.sum("count").alias("row_total"))
    columns = counts.groupBy(f2).agg(F.sum("count").alias("column_total"))
    return counts.join(rows, f1).join(columns, f2)


def crosstab(
    df: DataFrame, f1: str, f2: str, values: list, reorder_first: bool = True, reorder_second: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Wide counts of the named values of f2 and their row-normalised twin.

    Rows go up by total, columns down by total; one row of column totals goes
    to the driver. `crosstab_counts` has all values of any number.
    """
    long = opened(df, f1, f2).where(F.col(f1).isNotNull() & F.col(f2).isNotNull())
    long = long.groupBy(f1, f2).agg(F.count("*").alias("count"))
    names = sorted(values)
    if reorder_second:
        totals = long.agg(*[F.sum(F.when(F.col(f2) == v, F.col("count"))).alias(str(i)) for i, v in enumerate(names)]).first()
        names = [v for _, v in sorted(zip(totals, names), key=lambda x: -(x[0] or 0))]
    wide = long.groupBy(f1).pivot(f2, names).agg(F.sum("count")).fillna(0)
    columns = [str(n) for n in names]
    total = sum((F.col(f"`{c}`") for c in columns), F.lit(0))
    wide = wide.withColumn("_total", total)
    wide = wide.orderBy("_total", f1) if reorder_first else wide.orderBy(f1)
    norm = wide.select(f1, *[(F.col(f"`{c}`") / F.col("_total")).alias(c) for c in columns])
    return wide.drop("_total"), norm


def per_claim_feature(messages: DataFrame, feature: str, key: str = "fact_id") -> DataFrame:
    """Messages per (claim, feature value)."""
    return (
        opened(messages, feature)
        .where(F.col(feature).isNotNull() & F.col(key).isNotNull())
        .groupBy(key, feature)
        .agg(F.count("*").alias("n"))
    )


def lump_rare(df: DataFrame, column: str, k: int, other: str = "Others") -> DataFrame:
    """Values with at most k rows become one value; these are unique, so the planner splits hot ones."""
    counts = df.groupBy(column).agg(F.count("*").alias("_size"))
    rare = counts.where(F.col("_size") <= k).select(column, F.lit(True).alias("_rare"))
    joined = df.join(rare, column, "left")
    return joined.withColumn(column, F.when(F.col("_rare"), F.lit(other)).otherwise(F.col(column))).drop("_rare")


def describe_by(df: DataFrame, feature: str, value: str = "n") -> DataFrame:
    """Summary of a value per feature, larger means first."""
    return ranking.describe(df, value, [feature]).orderBy(F.desc("mean"), feature)


def metric_sums(df: DataFrame, keys: list[str], metrics: list[str] | None = None) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in metrics or METRICS])


def metric_means(df: DataFrame, keys: list[str], metrics: list[str] | None = None) -> DataFrame:
    """Means per keys; groups with a missing key or mean are dropped."""
    return df.groupBy(*keys).agg(*[F.avg(m).alias(m) for m in metrics or METRICS]).dropna()


def distinct_count(df: DataFrame, column: str, approximate: bool = False) -> DataFrame:
    """Distinct values, null counted as one when present."""
    if approximate:
        return df.agg(F.approx_count_distinct(column).alias("count"))
    return df.select(column).distinct().agg(F.count("*").alias("count"))


def subset_overview(sources: dict[str, DataFrame], flags: dict[str, str]) -> DataFrame:
    """Rows per source and subset; null where a source lacks the flag."""
    out = None
    for name, df in sources.items():
        counted = [F.count("*").alias("All")]
        for title, flag in flags.items():
            missing = F.lit(None).cast("bigint")
            counted.append((F.count_if(flag) if flag in df.columns else missing).alias(title))
        row = df.agg(*counted).select(F.lit(name).alias("source"), "All", *flags)
        out = row if out is None else out.unionByName(row)
    return out


def label_table(counts: DataFrame, label: str, columns: list[str]) -> DataFrame:
    """Counts with shares as text and a total row."""
    totals = counts.agg(*[F.sum(c).alias(c) for c in columns]).withColumn(label, F.lit("Total"))
    both = counts.select(label, *columns).unionByName(totals.select(label, *columns))
    shares = [F.format_string("%.2f%%", share(counts, c) * 100).alias(f"pct_{c}") for c in columns]
    return both.select(label, *columns, *shares)


def cooccurrence(sentences: DataFrame, sentence: str = "sentence", window: int = 2, minimum: int = 10) -> DataFrame:
    """Unordered word pairs within the next `window` words, above a minimum count.

    Tasks count the pairs of some PAIRED_WORDS words at a time as numbers, so a
    pair is spelt out once for all its places there; only these counts are
    shuffled, and Spark sums them.
    """
    bare = sentences.select(text.bare_words(sentence).alias("bare")).where(F.col("bare").isNotNull())
    schema = pa.schema([("pair", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[pa.Array, np.ndarray]] = []
        size = 0
        for batch in batches:
            for words, line in _words_of_lines(batch.column(0)):
                held.append((words, line + (held[-1][1][-1] + 1 if held else 0)))
                size += len(words)
                if size >= PAIRED_WORDS:
                    yield from _pair_counts(held, window, schema)
                    held, size = [], 0
        if held:
            yield from _pair_counts(held, window, schema)

    # words hold no blank, so two of them joined by one are a single key; tasks have
    # summed what they can, so pairs are dealt before Spark sums
    counted = bare.mapInArrow(run, "pair string, n long").repartition("pair")
    counts = counted.groupBy("pair").agg(F.sum("n").alias("counts"))
    both = F.split("pair", " ")
    return counts.where(F.col("counts") > minimum).select(both[0].alias("w1"), both[1].alias("w2"), "counts")


def _words_of_lines(lines: pa.Array) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Words of lines of bare text, and the number of the line each is in, some PAIRED_BYTES at a time."""
    sizes = pc.binary_length(lines).to_numpy(zero_copy_only=False).astype(np.int64)
    part = np.cumsum(sizes) // PAIRED_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(lines)]
    for low, high in zip(cuts, cuts[1:]):
        split = pc.split_pattern(lines.slice(low, high - low), " ")
        words, line = pc.list_flatten(split), pc.list_parent_indices(split).to_numpy()
        real = pc.binary_length(words).to_numpy() > 0
        if real.any():
            yield words.filter(pa.array(real)), line[real]


def _pair_counts(held: list[tuple[pa.Array, np.ndarray]], window: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Pairs of words of one line at most `window` places apart, the smaller word first, with their counts."""
    coded = pa.concat_arrays([words for words, _ in held]).dictionary_encode()
    line = np.concatenate([numbers for _, numbers in held])
    # the order of bytes, as Spark's least and greatest go by
    order = pc.array_sort_indices(coded.dictionary.cast(pa.binary()))
    rank = np.empty(len(order), np.int64)
    rank[order.to_numpy()] = np.arange(len(order))
    words, code = coded.dictionary.take(order), rank[coded.indices.to_numpy()]
    keys = []
    for k in range(1, window + 1):
        a, b = code[:-k], code[k:]
        keys.append((np.minimum(a, b) * len(words) + np.maximum(a, b))[line[:-k] == line[k:]])
    pairs, counts = np.unique(np.concatenate(keys), return_counts=True)
    for i in range(0, len(pairs), PAIRED_ROWS):
        first, second = (words.take(pa.array(x)) for x in np.divmod(pairs[i : i + PAIRED_ROWS], len(words)))
        joint = pc.binary_join_element_wise(first, second, " ")
        yield pa.RecordBatch.from_arrays([joint, pa.array(counts[i : i + PAIRED_ROWS])], schema=schema)


def rare_pairs(pairs: DataFrame, counts: DataFrame, threshold: int = 30, strict: bool = False) -> DataFrame:
    """Keyword pairs (fact_id, a, b) that do not co-occur too often.

    `strict` keeps every pair.
    """
    if strict:
        return pairs
    frequent = counts.where(F.col("counts") > threshold).select("w1", "w2")
    keyed = pairs.withColumns(
        {
            "w1": F.least(F.lower("a"), F.lower("b")),
            "w2": F.greatest(F.lower("a"), F.lower("b")),
        }
    )
    return keyed.join(frequent, ["w1", "w2"], "left_anti").select(*pairs.columns)


def confusion(pairs: DataFrame, gold: str = "gold", predicted: str = "predicted", keys: tuple = ()) -> DataFrame:
    return pairs.groupBy(*keys, F.col(gold).alias("gold"), F.col(predicted).alias("predicted")).agg(
        F.count("*").alias("n")
    )


def confusion_matrix(cells: DataFrame, labels: list[str], keys: tuple = ()) -> DataFrame:
    """One row per gold label, one column per predicted label."""
    return cells.groupBy(*keys, "gold").pivot("predicted", labels).agg(F.sum("n")).fillna(0)


def class_report(cells: DataFrame, keys: tuple = ()) -> DataFrame:
    """Precision, recall, F1 and support per class, plus macro, weighted and accuracy rows.

    Works on confusion cells, so its input has at most labels² rows per key.
    """
    keys = list(keys)
    as_gold = cells.select(
        *keys, F.col("gold").alias("label"), F.col("n").alias("support"), F.lit(0).alias("guessed"),
        F.when(F.col("gold") == F.col("predicted"), F.col("n")).otherwise(0).alias("hit"),
    )
    as_guess = cells.select(
        *keys, F.col("predicted").alias("label"), F.lit(0).alias("support"), F.col("n").alias("guessed"),
        F.lit(0).alias("hit"),
    )
    sums = as_gold.unionByName(as_guess).groupBy(*keys, "label").agg(
        *[F.sum(c).cast("double").alias(c) for c in ("support", "guessed", "hit")]
    )
    precision = F.when(F.col("guessed") > 0, F.col("hit") / F.col("guessed")).otherwise(0.0)
    recall = F.when(F.col("support") > 0, F.col("hit") / F.col("support")).otherwise(0.0)
    classes = sums.withColumns({"precision": precision, "recall": recall})
    both = F.col("precision") + F.col("recall")
    classes = classes.withColumn(
        "f1", F.when(both > 0, 2 * F.col("precision") * F.col("recall") / both).otherwise(0.0)
    )
    scores = ["precision", "recall", "f1"]

    def summary(name: str, columns: list[Column]) -> DataFrame:
        rows = classes.groupBy(*keys).agg(*columns, F.sum("support").alias("support"))
        return rows.withColumn("label", F.lit(name))

    macro = summary("macro avg", [F.avg(s).alias(s) for s in scores])
    weighted = summary(
        "weighted avg", [(F.sum(F.col(s) * F.col("support")) / F.sum("support")).alias(s) for s in scores]
    )
    accuracy = summary("accuracy", [(F.sum("hit") / F.sum("support")).alias(s) for s in scores])
    out = classes
    for part in (macro, weighted, accuracy):
        out = out.unionByName(part, allowMissingColumns=True)
    return out.select(*keys, "label", *scores, F.col("support").cast("bigint").alias("support"))


def label_counts(annotated: DataFrame, keys: tuple = ()) -> DataFrame:
    """Annotated rows per label; rows without a label are skipped."""
    return annotated.where(F.col("label").isNotNull()).groupBy(*keys, "label").agg(F.count("*").alias("n"))


def mean_of_totals(counts: DataFrame, key: str = "fact_id", n: str = "count") -> DataFrame:
    totals = counts.groupBy(key).agg(F.sum(n).alias("t"))
    return totals.agg(F.avg("t").alias("mean"))


class RunSummary:
    """Claims done, messages found and the dates they cover, counted by the jobs that write them.

    Pass what is written through `of_claims` and `of_hits`; `row` is known once
    both have been written, and costs no pass of its own.
    """

    def __init__(self):
        self.claims, self.hits = Observation(), Observation()

    def of_claims(self, claims: DataFrame) -> DataFrame:
        return claims.observe(self.claims, F.count(F.lit(1)).alias("claims"))

    def of_hits(self, hits: DataFrame, date: str = "date") -> DataFrame:
        at = F.unix_micros(F.col(date).cast("timestamp"))
        return hits.observe(self.hits, F.count(F.lit(1)).alias("messages"), F.min(at).alias("first"), F.max(at).alias("last"))

    def row(self, spark: SparkSession) -> DataFrame:
        """One row: claims, messages, first, last."""
        known = self.claims.get | self.hits.get
        one = spark.createDataFrame([tuple(known[c] for c in ("claims", "messages", "first", "last"))], "claims long, messages long, first long, last long")
        return one.withColumns({c: F.timestamp_micros(c) for c in ("first", "last")})


def run_summary(hits: DataFrame) -> DataFrame:
    """Claims done, messages found and days covered by a search run."""
    claims = hits.select("fact_id").distinct().agg(F.count("*")).scalar()
    found = hits.agg(F.count("*").alias("messages"), F.min("date").alias("first"), F.max("date").alias("last"))
    return found.select(claims.alias("claims"), "messages", "first", "last")

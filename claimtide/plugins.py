"""Points where a trained model or own statistic plugs in."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows a tagger's worker gives out at once.
TAGS_AT_ONCE = 20_000


def vectors_by(
    texts: DataFrame, id_: str, text: str, load: Callable[[], Callable[[pd.Series], pd.Series]]
) -> DataFrame:
    """(id, vector) from a text encoder that is loaded once per worker task.

    Equal texts are encoded once; ids get the vector back by joining the text.
    """

    @F.pandas_udf("array<float>")
    def encode(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()
        for part in parts:
            yield model(part)

    keyed = texts.select(id_, text, F.xxhash64(text).alias("_h"))
    vectors = keyed.select("_h", text).distinct().withColumn("vector", encode(text))
    return keyed.join(vectors, ["_h", text]).select(id_, "vector")


def _tagged(ids: pd.Series, texts: pd.Series, tagger: Callable, columns: list[str]) -> Iterator[pd.DataFrame]:
    found = ((key, tag, word) for key, value in zip(ids, texts) for tag, word in tagger(value))
    while rows := list(islice(found, TAGS_AT_ONCE)):
        yield pd.DataFrame(rows, columns=columns)


def tags_by(
    texts: DataFrame, id_: str, text: str, load: Callable[[], Callable[[str], list[tuple[str, str]]]]
) -> DataFrame:
    """(id, tag, word) from a tagger loaded once per task, batch by batch.

    What is found goes out every TAGS_AT_ONCE rows, so a worker holds one batch
    of texts and the tags of few of them, however many a batch has.
    """
    kind = texts.schema[id_].dataType.simpleString()

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tagger = load()
        for part in parts:
            yield from _tagged(part[id_], part[text], tagger, [id_, "tag", "word"])

    return texts.select(id_, text).mapInPandas(run, f"{id_} {kind}, tag string, word string")


def per_claim(series: DataFrame, key: str, step: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Own statistic per claim over an aggregated series.

    Give it one row per claim and time step: a group is then bounded by the
    calendar, not by the number of messages of a busy claim.
    """
    return series.groupBy(key).applyInPandas(step, schema)


def register_day_windows(spark, name: str = "day_windows") -> None:
    """Table function in SQL: the one-day windows from so many days before a moment's day to so many after.

    Spark puts its query in place of the call. Null moment: no windows.
    """
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(moment TIMESTAMP, before INT, after INT)
        RETURNS TABLE (day_start TIMESTAMP, day_end TIMESTAMP)
        RETURN SELECT day, day + INTERVAL '1' DAY FROM (
          SELECT explode(transform(sequence(0, before + after), i -> date_trunc('DAY', moment) + make_dt_interval(i - before))) AS day
        ) WHERE day IS NOT NULL
    """)

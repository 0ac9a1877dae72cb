"""Writers. Data leaves through Spark's own writers, in parallel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import times


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_range_dump(
    claims: DataFrame,
    message_links: DataFrame,
    messages: DataFrame,
    news: DataFrame,
    features: DataFrame,
    start,
    end,
    path: str,
) -> dict[str, str]:
    """Four extracts that agree: claims of a date range and what hangs on them."""
    chosen = claims.where(F.col("date").between(start, end))
    ids = chosen.select("fact_id").distinct()
    kept = message_links.join(ids, "fact_id", "left_semi").select("message_id").distinct()
    extracts = {
        "claims": chosen,
        "messages": messages.join(kept, "message_id", "left_semi"),
        "news": news.where("keywords_in_title").join(ids, "fact_id", "left_semi"),
        "features": features.join(ids, "fact_id", "left_semi"),
    }
    paths = {}
    for name, df in extracts.items():
        paths[name] = f"{path}/{name}"
        write_json(df, paths[name])
    return paths


def annotation_tasks(pairs: DataFrame) -> DataFrame:
    """`_id` and text template of each pair; a title makes it a news pair.

    Input: message_id, fact_id, claim, review, text, title, content.
    """
    from ..functions.text import first_sentence

    news = F.concat(
        F.lit("***CLAIM***:\n "), "claim", F.lit(" \n ***FACT-CHECK***: "), "review",
        F.lit(" \n\n ***TITLE***: \n "), "title",
        F.lit(" \n ***FIRS LINE OF ARTICLE***: \n "), first_sentence("content"),
    )
    message = F.concat(
        F.lit("***CLAIM***:\n "), "claim", F.lit(" \n ***FACT-CHECK***: \n "), "review",
        F.lit(" \n\n ***TWEET***: \n "), "text",
    )
    return pairs.select(
        F.concat_ws("_", F.col("message_id").cast("string"), F.col("fact_id").cast("string")).alias("_id"),
        F.when(F.col("title").isNotNull(), news).otherwise(message).alias("text"),
    )


def parse_annotation(tasks: DataFrame) -> DataFrame:
    """Back from template to columns; inverse of `annotation_tasks`."""
    body = F.substring("text", 15, 1 << 30)
    claim = F.split(body, r"\n \*\*\*FACT-CHECK\*\*\*: ")
    rest = F.get(claim, F.lit(1))
    is_message = rest.contains(" \n\n ***TWEET***: \n ")
    as_message = F.split(rest, r" \n\n \*\*\*TWEET\*\*\*: \n ")
    as_news = F.split(rest, r" \n\n \*\*\*TITLE\*\*\*: \n ")
    title = F.split(F.get(as_news, F.lit(1)), r" \n \*\*\*FIRS LINE OF ARTICLE\*\*\*: \n ")[0]
    ids = F.split("_id", "_")
    return tasks.select(
        ids[0].alias("id_tweet"),
        ids[1].alias("id_claim"),
        claim[0].alias("claim"),
        F.when(is_message, as_message[0]).otherwise(as_news[0]).alias("fact-check"),
        F.when(is_message, F.get(as_message, F.lit(1))).otherwise(title).alias("text"),
        *[c for c in tasks.columns if c not in ("_id", "text")],
    )


def write_annotation_tasks(pairs: DataFrame, path: str) -> None:
    annotation_tasks(pairs).select(F.to_json(F.struct("_id", "text")).alias("value")).write.mode(
        "overwrite"
    ).text(path)


def write_tables(tables: dict[str, DataFrame], path: str) -> dict[str, str]:
    """Result tables as CSV, one folder each."""
    paths = {}
    for name, df in tables.items():
        paths[name] = f"{path}/{name}"
        df.write.mode("overwrite").option("header", True).csv(paths[name])
    return paths


def names_without_match(publications: DataFrame, matches: DataFrame) -> DataFrame:
    """Distinct names of publications that no match refers to; a merge by hint, as neither side is bounded."""
    return publications.join(matches.hint("merge"), "ref", "left_anti").select("name").distinct()


def write_match_result(publications: DataFrame, matches: DataFrame, path: str) -> tuple[str, str]:
    """Matched (ref, id) as CSV and the names without a match as text."""
    matched, unmatched = f"{path}/matched", f"{path}/unmatched"
    matches.select("ref", "id").write.mode("overwrite").csv(matched)
    names_without_match(publications, matches).write.mode("overwrite").text(unmatched)
    return matched, unmatched


def day_counts(df: DataFrame, *keys: str) -> DataFrame:
    """Counts per day and keys, as stored for plotting."""
    return df.groupBy(times.day_text("date").alias("date"), *keys).agg(F.count("*").alias("count"))

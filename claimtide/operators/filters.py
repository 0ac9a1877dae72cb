"""Row filters and projections over claims, features and messages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import labels, times

# Where each feed keeps a claim's fields.
REPOSITORY_FIELDS = {
    "claim": "content",
    "review": "text",
    "url": "link",
    "reviewer": "organization.name",
    "date": "date",
    "calification": "organizationCalification.calification.name",
    "categories": "categories",
}
REVIEW_FIELDS = {
    "claim": "text",
    "review": "claimReview.title",
    "lang": "claimReview.languageCode",
    "url": "claimReview.url",
    "reviewer": "claimReview.publisher.name",
    "date": "date",
    "calification": "claimReview.textualRating",
    "categories": "claimReview.textualRating",
}
# Language by reviewer; DETECT asks the text.
DETECT = "?"
REVIEWER_LANGUAGES = {
    "Maldita.es": "es",
    "EFE Verifica": "es",
    "Newtral": "es",
    "Polígrafo": "pt",
    "Verificat": DETECT,
}
KEPT_LANGUAGES = ["es", "ca", "pt"]
FALSE_VERDICTS = ["Falso"]


def map_fields(feed: DataFrame, fields: dict[str, str]) -> DataFrame:
    return feed.select(*[F.col(path).alias(name) for name, path in fields.items()])


def unify_claims(feeds: list[tuple[DataFrame, dict[str, str]]]) -> DataFrame:
    """Feeds with different layouts as one table; missing fields become null."""
    mapped = [map_fields(df, fields) for df, fields in feeds]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), mapped)


def pluck(structs, key: str) -> Column:
    """That field of each element having it."""
    structs = F.col(structs) if isinstance(structs, str) else structs
    return F.filter(F.transform(structs, lambda s: s[key]), lambda v: v.isNotNull())


def rename_and_drop(df: DataFrame, names: dict[str, str], drop: tuple[str, ...] = ()) -> DataFrame:
    return df.drop(*drop).withColumnsRenamed(names)


def recode(df: DataFrame, values: dict[str, dict[str, str]]) -> DataFrame:
    """Replace mapped values in scalar or array columns; others stay."""

    def changed(name: str, mapping: dict[str, str]) -> Column:
        table = labels.literal_map(mapping)
        if df.schema[name].dataType.typeName() == "array":
            return F.transform(name, lambda v: F.coalesce(table[v], v))
        return F.coalesce(table[F.col(name)], F.col(name))

    return df.withColumns({name: changed(name, mapping) for name, mapping in values.items()})


def fill_none(df: DataFrame, *columns: str) -> DataFrame:
    return df.fillna("None", subset=list(columns))


def pending_search(
    features: DataFrame, marker: str, now, days_after: int = 7, verdicts: list[str] | None = None
) -> DataFrame:
    """Claims not searched yet whose window has fully passed."""
    limit = times.add_days(F.lit(now).cast("timestamp"), -(days_after + 1))
    return features.where(
        F.col(marker).isNull()
        & F.col("keywords").isNotNull()
        & (F.col("date") < limit)
        & F.col("calification").isin(verdicts or FALSE_VERDICTS)
    )


def pending_search_of_day(features: DataFrame, marker: str, day, verdicts: list[str] | None = None) -> DataFrame:
    return features.where(
        F.col(marker).isNull()
        & F.col("keywords").isNotNull()
        & (F.col("date") == F.lit(day).cast("timestamp"))
        & F.col("calification").isin(verdicts or FALSE_VERDICTS)
    )


def pending_classification(features: DataFrame, marker: str, since, verdicts: list[str] | None = None) -> DataFrame:
    return features.where(
        (F.col("date") >= F.lit(since).cast("timestamp"))
        & F.col(marker).isNull()
        & F.col("calification").isin(verdicts or FALSE_VERDICTS)
    )


def pending_refilter(features: DataFrame, searched: str, filtered: str) -> DataFrame:
    return features.where(F.col(searched).isNotNull() & F.col("keywords").isNotNull() & F.col(filtered).isNull())


def in_range(df: DataFrame, column: str, start, end) -> DataFrame:
    """Inclusive at both ends."""
    return df.where(F.col(column).between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")))


def assign_language(
    df: DataFrame,
    reviewer: str,
    detected: str,
    languages: dict[str, str] | None = None,
    kept: list[str] | None = None,
) -> DataFrame:
    """Language fixed by reviewer, or the detected one; other languages go."""
    fixed = labels.literal_map(languages or REVIEWER_LANGUAGES)[F.col(reviewer)]
    lang = F.when(fixed == DETECT, F.col(detected)).otherwise(fixed)
    return df.withColumn("assigned_lang", lang).where(F.col("assigned_lang").isin(kept or KEPT_LANGUAGES))


def non_empty(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.length(column) > 0)


def short_texts(df: DataFrame, column: str, limit: int = 500) -> DataFrame:
    return df.where(F.length(column) < limit)


def eligible_for_sampling(
    claims: DataFrame, start, end, excluded: list[str], verdicts: list[str] | None = None
) -> DataFrame:
    return in_range(claims, "date", start, end).where(
        F.col("calification").isin(verdicts or FALSE_VERDICTS)
        & F.col("claim").isNotNull()
        & F.col("review").isNotNull()
        & (F.col("reviewer").isNull() | ~F.col("reviewer").isin(excluded))
    )


def exclude_publishers(claims: DataFrame, column: str, excluded: list[str]) -> DataFrame:
    return claims.where(F.col(column).isNull() | ~F.col(column).isin(excluded))


def titled_hits(news: DataFrame) -> DataFrame:
    """News with a claim keyword in the title."""
    return news.where(F.col("keywords_in_title"))


def active_media(registry: DataFrame, country: str = "ES") -> DataFrame:
    return registry.where(
        (F.length("name") > 0) & (F.col("active") == "true") & (F.col("country") == country)
    )


def without_type(df: DataFrame, column: str = "type", unwanted: str = "Manipulated content") -> DataFrame:
    return df.where(F.col(column).isNull() | (F.col(column) != unwanted))


def keep_subset(df: DataFrame, name: str) -> DataFrame:
    """Rows of a named subset: all, eval, topic, on_topic, claim, on_claim."""
    flags = {
        "eval": "experience_subset",
        "topic": "topic_relation_subset",
        "on_topic": "on_topic_subset",
        "claim": "claim_relation_subset",
        "on_claim": "on_claim_subset",
    }
    return df if name == "all" else df.where(F.col(flags[name]))


def _flagged(df: DataFrame, ids: DataFrame, key: str, flag: str) -> DataFrame:
    marked = ids.distinct().withColumn(flag, F.lit(True))
    return df.join(marked, key, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def subset_flags(
    claims: DataFrame, links: DataFrame, news: DataFrame, verdict: str, reviewers: list[str]
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Membership columns on claims, message-claim links and news.

    `links` is the long form (message_id, fact_id, labels). A message is in the
    experiment when any of its claims is; a claim is on topic when any on-topic
    message or news item names it.
    """
    in_eval = (F.col("calification") == verdict) & F.col("reviewer").isin(reviewers)
    claims = claims.withColumn("experience_subset", F.coalesce(in_eval, F.lit(False)))
    eval_ids = claims.where("experience_subset").select("fact_id")
    eval_messages = links.join(eval_ids.distinct(), "fact_id", "left_semi").select("message_id")
    links = _flagged(links, eval_messages, "message_id", "experience_subset")
    news = _flagged(news, eval_ids, "fact_id", "experience_subset")

    inside = F.col("experience_subset")
    topic = {
        "topic_relation_subset": inside & F.col("topic_relation").isNotNull(),
        "on_topic_subset": inside & F.col("topic_relation").eqNullSafe("on-topic"),
    }
    of_claim = {
        "claim_relation_subset": inside & F.col("claim_relation").isNotNull(),
        "on_claim_subset": inside & F.col("claim_relation").eqNullSafe("on-claim"),
    }
    links, news = links.withColumns(topic | of_claim), news.withColumns(topic)
    marks = links.select("fact_id", *topic, *of_claim).unionByName(
        news.select("fact_id", *topic, *[F.lit(False).alias(c) for c in of_claim])
    )
    per_fact = marks.groupBy("fact_id").agg(*[F.bool_or(c).alias(c) for c in [*topic, *of_claim]])
    claims = claims.join(per_fact, "fact_id", "left")
    needs_eval = ["topic_relation_subset", "claim_relation_subset", "on_claim_subset"]
    claims = claims.withColumns({c: F.coalesce(F.col(c) & inside, F.lit(False)) for c in needs_eval})
    return claims.withColumn("on_topic_subset", F.coalesce("on_topic_subset", F.lit(False))), links, news

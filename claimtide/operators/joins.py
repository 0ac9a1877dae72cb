"""Joins between claims, messages, news and media."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text, times
from ..session import stored
from .skew import hot_keys, salted_join


def unprocessed(claims: DataFrame, features: DataFrame) -> DataFrame:
    """Claims without a features row."""
    return claims.join(features.select("fact_id").distinct(), "fact_id", "left_anti")


def message_links(messages: DataFrame, message_id: str = "tweet_id", claims: str = "fact_id") -> DataFrame:
    """One row per message and claim out of the claim list of each message."""
    others = [c for c in messages.columns if c not in (message_id, claims)]
    return messages.select(
        F.col(message_id).alias("message_id"), F.explode(claims).alias("fact_id"), *others
    )


def messages_of_claims(messages: DataFrame, claims: DataFrame, message_id: str = "tweet_id") -> DataFrame:
    return message_links(messages, message_id).join(claims, "fact_id")


def attach_claim_attributes(messages: DataFrame, claims: DataFrame, attributes: list[str]) -> DataFrame:
    """Left join on fact_id; equal column names get a _fact_check suffix.

    `claims` has one row per fact_id, so a hot claim is only a large left
    partition, which adaptive execution splits.
    """
    clash = {a: f"{a}_fact_check" for a in attributes if a in messages.columns}
    right = claims.select("fact_id", *attributes).withColumnsRenamed(clash)
    return messages.join(right, "fact_id", "left")


def restrict_to_claims(df: DataFrame, ids: DataFrame) -> DataFrame:
    return df.join(ids.select("fact_id").distinct(), "fact_id", "left_semi")


def messages_near_claim(
    messages: DataFrame,
    claims: DataFrame,
    days: int = 15,
    message_id: str = "message_id",
    links: DataFrame | None = None,
) -> DataFrame:
    """Message and claim pairs less than `days` apart, bounds excluded.

    With `links` (message, fact_id) only linked or found pairs are looked at,
    so the result is no longer than they are. Without, every claim meets every
    message of its window: claims are copied to the calendar days they reach and joined on the day,
    so no all-against-all comparison is planned. Busy days are cut in pieces.
    `messages`: (message_id, date, ...); `claims`: (fact_id, claim_date, ...).
    """
    checked = F.col("claim_date").cast("timestamp")
    if links is not None:
        pairs = links.join(messages, message_id).join(claims, "fact_id")
        at = F.col("date").cast("timestamp")
        return pairs.where((at > times.add_days(checked, -days)) & (at < times.add_days(checked, days)))
    # instants as numbers on each side, so the join compares plain longs
    moment = F.unix_micros(F.col("date").cast("timestamp"))
    m = messages.withColumns({"_day": F.to_date("date"), "_at": moment})
    counts = stored(m.groupBy("_day").agg(F.count("*").alias("n")), "days")
    first, last = times.add_days(checked, -days), times.add_days(checked, days)
    c = claims.withColumns({"_from": F.unix_micros(first), "_to": F.unix_micros(last)})
    c = c.withColumn("_day", F.explode(F.sequence(F.to_date(first), F.to_date(last))))
    joined = salted_join(m, c, "_day", [message_id], hot_keys(counts, "_day"))
    near = (F.col("_at") > F.col("_from")) & (F.col("_at") < F.col("_to"))
    return joined.where(near).drop("_day", "_at", "_from", "_to")


def match_media(registry: DataFrame, publications: DataFrame) -> DataFrame:
    """Registered outlet of each publication by equal spelling.

    `registry`: (id, name, url, row_no); a spelling used twice belongs to the
    later row. `publications`: (name, ref); of several matching spellings the
    last rule wins. Both choices are maxima, so they combine before a shuffle.

    A name is spelt out and looked up once, however many publications bear it.
    The joins are merges by hint: a name is many spellings, which the size
    Spark expects from the files leaves out, and none of them must be broadcast.
    """
    keys = registry.select("id", "row_no", F.explode(text.registry_keys("name", "url")).alias("key"))
    owner = keys.groupBy("key").agg(F.max_by("id", "row_no").alias("id"))
    names = publications.select("name").distinct()
    variants = names.select("name", F.posexplode(text.publication_variants("name")).alias("rule", "key"))
    found = variants.join(owner.hint("merge"), "key").groupBy("name").agg(F.max_by("id", "rule").alias("id"), F.max("rule").alias("rule"))
    hits = publications.select("ref", "name").join(found.hint("merge"), "name")
    return hits.groupBy("ref").agg(
        F.max_by("name", "rule").alias("name"), F.max_by("id", "rule").alias("id"), F.max("rule").alias("rule")
    )


def refilter_by_title(news: DataFrame, features: DataFrame, title: str = "Title") -> DataFrame:
    """Flag news whose title has one of the claim's keywords as a token."""
    kept = features.select("fact_id", "keywords")
    joined = news.join(kept, "fact_id", "left")
    overlap = F.arrays_overlap(text.title_tokens(title), "keywords")
    return joined.withColumn("keywords_in_title", F.coalesce(overlap, F.lit(False))).drop("keywords")


def without_ids(df: DataFrame, ids: DataFrame, on: str) -> DataFrame:
    return df.join(ids.select(on).distinct(), on, "left_anti")


def two_source_counts(a: DataFrame, b: DataFrame, key: str, name_a: str, name_b: str) -> DataFrame:
    """Counts per key of two sources, 0 where one has none."""
    left = a.groupBy(key).agg(F.count("*").alias(name_a))
    right = b.groupBy(key).agg(F.count("*").alias(name_b))
    joined = left.join(right, key, "full")
    return joined.select(key, *[F.coalesce(c, F.lit(0)).alias(c) for c in (name_a, name_b)])


def side_by_side(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.join(b, key)


def before_after(messages: DataFrame, offset: str, key: str = "fact_id", form: str = "hour") -> DataFrame:
    """Messages before and after the fact-check per claim, zeros included."""
    early = F.col(offset) < 0 if form == "hour" else F.col(offset) <= 0
    return messages.groupBy(key).agg(F.count_if(early).alias("before"), F.count_if(~early).alias("after"))


def paired(counts: DataFrame) -> DataFrame:
    """Claims seen on both sides."""
    return counts.where((F.col("before") > 0) & (F.col("after") > 0))


def with_group_size(df: DataFrame, key: str, name: str = "counts") -> DataFrame:
    """Row count of the key on each row; keys are unique on the right, so the planner splits hot ones."""
    return df.join(df.groupBy(key).agg(F.count("*").alias(name)), key, "left")


def apply_corrections(base: DataFrame, updates: DataFrame, key: str, flag: str) -> DataFrame:
    """Set a flag on existing keys named in `updates`; never adds rows."""
    marked = updates.where(flag).select(key).distinct().withColumn("_fix", F.lit(True))
    joined = base.join(marked, key, "left")
    return joined.withColumn(flag, F.coalesce("_fix", flag)).drop("_fix")


def append_pages(posts: DataFrame, pages: DataFrame, key: str = "post_id") -> DataFrame:
    """First-page and later-page comments of known posts, in long form.

    `posts` holds the comments of page 1 (page, ...); later pages of unknown
    posts are ignored. Long rows keep a busy post spread over tasks.
    """
    known = posts.select(key).distinct()
    return posts.unionByName(pages.join(known, key, "left_semi"), allowMissingColumns=True)

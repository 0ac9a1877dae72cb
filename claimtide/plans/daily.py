"""The daily run: new claims, searches that are due, title check, labels, and marks that say what is done.

The pieces are plans over tables; `DailyRun` puts them together on stored tables
and publishes what a day has changed in one step. Searches and the run store
tables while they work, so calling them starts jobs.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..operators import aggregates, entities, filters, joins, keyed, keywords, scoring, search
from ..session import stored
from ..sources.versions import VersionedTables


def features_of_new_claims(claims: DataFrame, features: DataFrame, gazetteer: DataFrame, tags: DataFrame) -> DataFrame:
    """Entity maps and keywords of claims without a features row.

    `tags`: (fact_id, pos_claim, pos_review) maps from a tagger.
    """
    fresh = joins.unprocessed(claims, features)
    tagged = entities.entity_table(fresh, gazetteer).join(tags, "fact_id", "left")
    return keywords.select_keywords(tagged)


def hits_of_features(
    features: DataFrame, messages: DataFrame, tokens: Column, days: tuple[int, int] | None = None
) -> DataFrame:
    """Messages of claims by keywords of one or more words; claims of few keywords need all."""
    lowered = features.withColumn("keywords", F.transform("keywords", lambda k: F.lower(k)))
    return search.claim_search(lowered, messages, tokens, F.array_join(tokens, " "), short="all", days=days)


def labelled_hits(
    hits: DataFrame, claim_vectors: DataFrame, review_vectors: DataFrame, message_vectors: DataFrame
) -> DataFrame:
    """Topic, claim and finer label per (claim, message)."""
    scored = scoring.score_pairs(hits, claim_vectors, message_vectors)
    scored = scoring.classify(scored, "topic_relation")
    scored = scoring.classify(scored, "claim_relation")
    finer = scoring.classify_finer(scored, claim_vectors, review_vectors, message_vectors)
    return scored.join(
        finer.select("fact_id", "message_id", "claim_finer_relation"), ["fact_id", "message_id"], "left"
    )


def simple_keywords(claims: DataFrame, letters: int = 5) -> DataFrame:
    """Sorted distinct words over `letters` letters of the whole claim text."""
    words = text.longer_than(F.transform(text.corpus_tokens("claim"), text.clean_word), letters)
    return claims.withColumn("keywords", F.sort_array(F.array_distinct(words)))


def claims_per_language(claims: DataFrame, messages: DataFrame) -> DataFrame:
    """Messages found per claim and language, most first."""
    features = simple_keywords(claims)
    words = search.token_table(messages, text.corpus_tokens("text"))
    hits = search.keyword_search(features, words)
    named = hits.join(messages.select("message_id", "lang"), "message_id")
    return aggregates.count_by(named, "fact_id", "lang").orderBy(F.desc("count"), "fact_id", "lang")


@dataclass(frozen=True)
class Settings:
    """How far and how much a day searches; the defaults are the fixed values of the daily configuration."""

    days_before: int = 7
    days_after: int = 7
    messages_per_day: int = 1000
    news_keywords: int = 6
    news_per_day: int = 10
    verdicts: tuple[str, ...] = ("Falso",)
    topic_threshold: float | None = None
    claim_threshold: float | None = None
    news_threshold: float | None = None


#: When a claim was searched, checked and labelled; null until then.
MARKS = ("messages_searched_at", "news_searched_at", "news_filtered_at", "messages_labelled_at", "news_labelled_at")


class DailyRun:
    """One day's work over stored tables: features, message_pairs, news_pairs, message_labels, news_labels, runs.

    `features` has one row per claim: its columns, `keywords` and MARKS. The other
    tables are appended to; `runs` has what each day found. All of a day is published by one version under the
    day's name: a day that broke off left nothing, and one that is started again
    changes nothing. Since marks and hits come with the same version, no claim is
    searched twice.
    """

    def __init__(self, tables: VersionedTables, settings: Settings = Settings()):
        self.tables, self.settings = tables, settings

    def _marked(self, features: DataFrame, done: DataFrame, mark: str, now) -> DataFrame:
        return scoring.mark_done(features, done, mark, now)

    def features(self, claims: DataFrame, describe: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """Known claims as they are, and described new ones without marks."""
        known = self.tables.table("features")
        fresh = claims if known is None else joins.unprocessed(claims, known)
        described = describe(fresh).select(*claims.columns, "keywords", *[F.lit(None).cast("timestamp").alias(m) for m in MARKS])
        return described if known is None else known.unionByName(described)

    def message_hits(self, due: DataFrame, messages: DataFrame, tokens: Column) -> DataFrame:
        """(fact_id, message_id, date) of messages with three keywords of a claim, so many a day; few keywords: all of them."""
        s = self.settings
        days = (s.days_before, s.days_after)
        asked = due.select("fact_id", "keywords", F.col("date").alias("claim_date"))
        words = search.token_table(search.within_reach(messages, asked, days), tokens)
        hits = search.keyword_search(asked, words, short="all", days=days)
        dated = hits.select("fact_id", "message_id").join(messages.select("message_id", "date"), "message_id")
        capped = keyed.cap_per_key(dated.withColumn("_day", F.to_date("date")), ["fact_id", "_day"], ["message_id"], s.messages_per_day)
        return capped.select("fact_id", "message_id", "date")

    def news_hits(self, due: DataFrame, news: DataFrame, tokens: Column) -> DataFrame:
        """(fact_id, news_id, date, query_output) of news with three of a claim's first keywords, so many a day.

        `query_output` is the number found on that day. The day of the last window
        is left out, as windows start at the claim's own time.
        """
        s = self.settings
        days = (s.days_before, s.days_after - 1)
        asked = due.select("fact_id", "keywords", F.col("date").alias("claim_date"))
        words = search.token_table(search.within_reach(news, asked, days).withColumnRenamed("news_id", "message_id"), tokens)
        hits = search.keyword_search(asked, words, limit=s.news_keywords, drop_query_words=False, days=days)
        found = hits.select("fact_id", F.col("message_id").alias("news_id")).join(news.select("news_id", "date"), "news_id")
        found = stored(found.withColumn("_day", F.to_date("date")), "found-news")
        totals = found.groupBy("fact_id", "_day").agg(F.count("*").alias("query_output"))
        capped = keyed.cap_per_key(found, ["fact_id", "_day"], ["news_id"], s.news_per_day)
        return capped.join(totals, ["fact_id", "_day"]).select("fact_id", "news_id", "date", "query_output")

    def run(
        self,
        day: str,
        now,
        since,
        claims: DataFrame,
        messages: DataFrame,
        news: DataFrame,
        describe: Callable[[DataFrame], DataFrame],
        vectors: dict[str, DataFrame],
        message_tokens: Column | None = None,
        news_tokens: Column | None = None,
    ) -> int:
        """Do what is due at `now` and publish it as `day`; the number of the version.

        `claims`: (fact_id, date, calification, ...); `messages`: (message_id,
        date, text); `news`: (news_id, date, Title). `describe` adds keywords to
        new claims. `vectors`: claims and reviews by fact_id, messages by
        message_id, news by news_id. Claims from `since` on get labels.
        """
        if self.tables.has_run(day):
            return self.tables.version()
        s, base, verdicts = self.settings, self.tables.version(), list(self.settings.verdicts)
        message_tokens = text.corpus_tokens("text") if message_tokens is None else message_tokens
        news_tokens = text.corpus_tokens("Title") if news_tokens is None else news_tokens
        features = stored(self.features(claims, describe), "features")

        summary = aggregates.RunSummary()
        due = stored(summary.of_claims(filters.pending_search(features, "messages_searched_at", now, s.days_after, verdicts)), "due")
        message_pairs = stored(summary.of_hits(self.message_hits(due, messages, message_tokens)), "message-pairs")
        features = self._marked(features, due, "messages_searched_at", now)
        due = filters.pending_search(features, "news_searched_at", now, s.days_after, verdicts)
        found = self.news_hits(due, news, news_tokens)
        features = stored(self._marked(features, due, "news_searched_at", now), "features")

        # news of claims searched by now, their titles not checked yet: those just found
        due = filters.pending_refilter(features, "news_searched_at", "news_filtered_at")
        titled = found.join(news.select("news_id", "Title"), "news_id")
        news_pairs = stored(joins.refilter_by_title(titled, due).drop("Title"), "news-pairs")
        features = self._marked(features, due, "news_filtered_at", now)

        # a claim is labelled once its search is done, whenever that was
        due = filters.pending_classification(features, "messages_labelled_at", since, verdicts).where("messages_searched_at IS NOT NULL")
        pairs = self._of_claims("message_pairs", message_pairs, due).select("fact_id", "message_id")
        scored = scoring.score_pairs(pairs, vectors["claims"], vectors["messages"])
        scored = scoring.classify(scored, "topic_relation", threshold=s.topic_threshold)
        scored = stored(scoring.classify(scored, "claim_relation", threshold=s.claim_threshold), "scored")
        finer = scoring.classify_finer(scored, vectors["claims"], vectors["reviews"], vectors["messages"])
        finer = finer.select("fact_id", "message_id", "claim_finer_relation")
        message_labels = scored.join(finer, ["fact_id", "message_id"], "left")
        features = self._marked(features, due, "messages_labelled_at", now)

        due = filters.pending_classification(features, "news_labelled_at", since, verdicts).where("news_searched_at IS NOT NULL")
        pairs = self._of_claims("news_pairs", news_pairs, due).select("fact_id", F.col("news_id").alias("message_id"))
        scored = scoring.score_pairs(pairs, vectors["claims"], vectors["news"].withColumnRenamed("news_id", "message_id"))
        news_labels = scoring.classify(scored, "topic_relation", "news", s.news_threshold).withColumnRenamed("message_id", "news_id")
        features = self._marked(features, due, "news_labelled_at", now)

        runs = summary.row(features.sparkSession).withColumn("day", F.lit(day))
        appended = {"runs": runs, "message_pairs": message_pairs, "news_pairs": news_pairs, "message_labels": message_labels, "news_labels": news_labels}
        return self.tables.commit(day, replace={"features": features}, append=appended, base=base)

    def _of_claims(self, name: str, fresh: DataFrame, due: DataFrame) -> DataFrame:
        """This day's and earlier pairs of the claims that are due."""
        earlier = self.tables.table(name)
        rows = fresh if earlier is None else earlier.unionByName(fresh)
        return joins.restrict_to_claims(rows, due.select("fact_id"))

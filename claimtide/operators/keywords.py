"""Keyword choice from tagged words; rows stay independent, nothing shuffles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text

NO_WORDS = "array<string>"


def _words(tags, tag: str) -> Column:
    return F.coalesce(F.col(tags)[tag], F.array().cast(NO_WORDS))


def _all_words(tags) -> Column:
    return F.coalesce(F.flatten(F.map_values(tags)), F.array().cast(NO_WORDS))


def select_keywords(features: DataFrame, maximum: int = 5, name: str = "keywords") -> DataFrame:
    """Entities of claim and review, topped up by tagged words.

    While fewer than `maximum`, three rounds add the i-th noun, adjective and
    verb of the claim, then three rounds those of the review; every round ends
    by cleaning the words. Sorted, so the order of tags does not matter.
    """
    start = F.array_distinct(F.concat(_all_words("ner_claim"), _all_words("ner_review")))
    rounds = F.array(
        *[
            F.array_compact(F.array(*[F.get(_words(tags, t), F.lit(i)) for t in ("NOUN", "ADJ", "VERB")]))
            for tags in ("pos_claim", "pos_review")
            for i in range(3)
        ]
    )

    def top_up(words: Column, more: Column) -> Column:
        cleaned = text.longer_than(text.letters_only(F.concat(words, more)), 2)
        return F.when(F.size(words) < maximum, cleaned).otherwise(words)

    # a fold, so that the expression does not double with every round
    chosen = F.aggregate(rounds, start, top_up)
    return features.withColumn(name, F.sort_array(F.array_distinct(text.longer_than(chosen, 1))))


def select_keywords_first_words(features: DataFrame, maximum: int = 5, name: str = "keywords") -> DataFrame:
    """First word of each entity tag, then nouns, adjectives and verbs until three."""

    def first_words(tags: str) -> Column:
        values = F.coalesce(F.map_values(tags), F.array().cast("array<array<string>>"))
        return F.array_compact(F.transform(values, lambda v: F.get(v, F.lit(0))))

    start = F.concat(first_words("ner_review"), first_words("ner_claim"))
    more = F.array(
        *[
            text.letters_only(F.concat(_words("pos_review", tag), _words("pos_claim", tag)))
            for tag in ("NOUN", "ADJ", "VERB")
        ]
    )
    chosen = F.aggregate(more, start, lambda k, m: F.when(F.size(k) < 3, F.concat(k, m)).otherwise(k))
    return features.withColumn(name, F.slice(F.sort_array(F.array_distinct(chosen)), 1, maximum))


def keyword_pairs(features: DataFrame, keywords: str = "keywords") -> DataFrame:
    """(fact_id, a, b) for each two keywords, a before b."""
    # outer, since the plain form adds filters that would choose the keywords once more
    first = features.select("fact_id", F.col(keywords).alias("k"), F.explode_outer(keywords).alias("a"))
    return first.select("fact_id", "a", F.explode_outer("k").alias("b")).where(F.col("a") < F.col("b"))

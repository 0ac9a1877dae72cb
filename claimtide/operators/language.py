"""Language by vote of several detectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONFIDENCE = 0.75
UNDEFINED = "undefined"

# Frequent function words and marking letters per language.
FUNCTION_WORDS = {
    "en": ["the", "of", "and", "to", "in", "is", "that", "for", "it", "with", "was", "on"],
    "es": ["el", "los", "las", "y", "del", "que", "por", "con", "una", "para", "no", "es"],
    "fr": ["le", "les", "et", "des", "du", "une", "pour", "dans", "que", "est", "avec", "par"],
    "de": ["der", "die", "und", "das", "den", "von", "mit", "ist", "nicht", "ein", "zu", "für"],
    "ca": ["els", "les", "i", "amb", "per", "una", "dels", "és", "però", "aquest"],
    "pt": ["os", "um", "uma", "não", "em", "do", "da", "com", "para", "são"],
}
MARKING_LETTERS = {
    "es": "ñ¿¡óíáú",
    "fr": "êèçàœ",
    "de": "äöüß",
    "ca": "·ŀ",
    "pt": "ãõ",
}


def _best(scores: dict[str, Column]) -> Column:
    """Highest share of the summed scores as (lang, confidence); first language on ties."""
    total = sum(scores.values(), F.lit(0))
    best = F.greatest(*scores.values())
    lang = F.coalesce(*[F.when(s == best, F.lit(name)) for name, s in scores.items()])
    known = total > 0
    return F.struct(
        F.when(known, lang).alias("lang"), F.when(known, best / total).cast("double").alias("confidence")
    )


def _hits(tokens: Column, words: list[str]) -> Column:
    return F.size(F.filter(tokens, lambda t: t.isin(words)))


def default_votes(texts: DataFrame, id_: str, text: str, tokens: Column, languages: list[str]) -> DataFrame:
    """(id, votes): the votes of three small detectors as an array in each row.

    They stand in for trained detectors, whose votes can be given as such an
    array, or as a table of (id, position, detector, lang, confidence).
    """
    lowered = F.lower(text)
    marks = {lang: MARKING_LETTERS[lang] for lang in languages if lang in MARKING_LETTERS}
    asked = sorted({w for lang in languages for w in FUNCTION_WORDS[lang]})
    # one pass keeps the function words of any language; the rest counts on those
    t = texts.select(id_, lowered.alias("_l"), F.filter(tokens, lambda w: w.isin(asked)).alias("_t"))
    t = t.withColumn("_d", F.array_distinct("_t"))
    counted = t.select(
        id_,
        *[_hits(F.col("_t"), FUNCTION_WORDS[lang]).alias(f"_w_{lang}") for lang in languages],
        *[_hits(F.col("_d"), FUNCTION_WORDS[lang]).alias(f"_k_{lang}") for lang in languages],
        *[(F.length("_l") - F.length(F.translate("_l", ls, ""))).alias(f"_m_{lang}") for lang, ls in marks.items()],
    )
    by_word = _best({lang: F.col(f"_w_{lang}") for lang in languages})
    by_kind = _best({lang: F.col(f"_k_{lang}") for lang in languages})
    by_letter = _best({lang: F.col(f"_m_{lang}") for lang in marks})
    votes = F.array(
        *[
            F.struct(F.lit(i).alias("position"), F.lit(n).alias("detector"), v["lang"].alias("lang"), v["confidence"].alias("confidence"))
            for i, (n, v) in enumerate([("words", by_word), ("kinds", by_kind), ("letters", by_letter)])
        ]
    )
    return counted.select(id_, votes.alias("votes"))


def row_language(votes: str | Column, confidence: float = CONFIDENCE) -> Column:
    """The language that `vote_language` finds, from the votes of one row, in detector order."""
    votes = F.col(votes) if isinstance(votes, str) else votes
    sure = F.filter(votes, lambda v: (v["confidence"] >= confidence) & v["lang"].isNotNull())

    def winners(langs: Column) -> Column:
        counted = F.transform(
            F.array_distinct(langs), lambda x: F.struct(x.alias("lang"), F.size(F.filter(langs, lambda y: y == x)).alias("n"))
        )
        return F.transform(F.array(counted), top)[0]

    def top(counted: Column) -> Column:
        most = F.array_max(F.transform(counted, lambda e: e["n"]))
        return F.transform(F.filter(counted, lambda e: e["n"] == most), lambda e: e["lang"])

    joined = F.array_join(F.transform(F.array(F.transform(sure, lambda v: v["lang"])), winners)[0], "_")
    return F.when(joined == "", UNDEFINED).otherwise(joined)


def vote_language(votes: DataFrame, id_: str, confidence: float = CONFIDENCE) -> DataFrame:
    """Majority language per text.

    Votes below the confidence do not count; languages with equal votes are
    joined by '_' in detector order; without a vote the text is undefined.
    """
    sure = F.when(F.col("confidence") >= confidence, F.col("lang"))
    counts = votes.groupBy(id_, sure.alias("lang")).agg(
        F.count("*").alias("n"), F.min("position").alias("position")
    )
    # a text has at most as many entries as there are detectors
    ranked = counts.groupBy(id_).agg(
        F.max(F.when(F.col("lang").isNotNull(), F.col("n"))).alias("top"),
        F.sort_array(F.collect_list(F.struct("position", "lang", "n"))).alias("entries"),
    )
    winners = F.filter("entries", lambda e: e["lang"].isNotNull() & (e["n"] == F.col("top")))
    joined = F.array_join(F.transform(winners, lambda e: e["lang"]), "_")
    return ranked.select(id_, F.when(F.col("top").isNull(), UNDEFINED).otherwise(joined).alias("pref_lang"))

"""Keyword search of messages for claims, as an exact token join.

A claim asks for at least `need` of its keywords in a message. A message that
has `need` of n keywords must have one of the n - need + 1 rarest, so only
those are joined to find candidates; frequent words are looked at only while
checking candidates, by (message, word). Words that are still hot on the
candidate join are cut in pieces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..session import stored
from .skew import hot_keys, salted_join

QUERY_WORDS = ["and", "or"]


def combinations_of(words, size: int) -> Column:
    """All `size`-word combinations (2 or 3), in word order."""
    words = F.col(words) if isinstance(words, str) else words

    def rest(i: Column) -> Column:
        return F.slice(words, i + 2, F.greatest(F.size(words) - i - 1, F.lit(0)))

    def nested(depth: int, chosen: list[Column], tail: Column, seen: Column) -> Column:
        if depth == 1:
            return F.transform(tail, lambda w: F.array(*chosen, w))
        return F.flatten(
            F.transform(
                tail,
                lambda w, i: nested(depth - 1, [*chosen, w], rest(seen + i), seen + i + 1),
            )
        )

    return nested(size, [], words, F.lit(0))


def query_keywords(words, limit: int | None = None, drop_query_words: bool = True) -> Column:
    """Keywords as sent to a search: without 'and'/'or', first `limit` only."""
    words = F.col(words) if isinstance(words, str) else words
    if drop_query_words:
        words = F.filter(words, lambda w: ~w.isin(QUERY_WORDS))
    return F.slice(words, 1, limit) if limit else words


def keyword_groups(words, pairs=None, strategy: str = "triples", short: str = "none") -> Column:
    """AND-groups of a claim: array of keyword arrays, joined by OR.

    'triples' takes every three keywords; with fewer it gives nothing, or all
    of them as one group with short='all'. 'pairs' takes the stored pairs;
    'restrictive' joins each pair with the one before it.
    """
    none = F.array().cast("array<array<string>>")
    if strategy == "pairs":
        return F.coalesce(pairs, none)
    if strategy == "restrictive":
        return F.transform(
            F.coalesce(pairs, none), lambda p, i: F.when(i == 0, p).otherwise(F.concat(p, F.get(pairs, i - 1)))
        )
    words = F.col(words) if isinstance(words, str) else words
    enough = F.size(words) >= 3
    otherwise = F.when(F.size(words) > 0, F.array(words)).otherwise(none) if short == "all" else none
    return F.when(enough, combinations_of(words, 3)).otherwise(otherwise)


def within_budget(groups: Column, budget: int | None) -> Column:
    """Groups kept before the query text would pass its budget.

    A group costs its text with a blank between all characters, as the limit
    is counted; the first group always stays and the first overflow ends.
    """
    if budget is None:
        return groups
    group_type = "array<string>"
    start = F.struct(
        F.array().cast(f"array<{group_type}>").alias("kept"), F.lit(0).alias("used"), F.lit(False).alias("full")
    )

    def step(state: Column, group: Column) -> Column:
        size = F.length(F.array_join(group, " ")) + 2
        first = F.size(state["kept"]) == 0
        fits = first | (~state["full"] & (state["used"] < F.lit(budget) - (size * 2 - 1)))
        grown = state["used"] + size + F.when(first, 0).otherwise(4)
        return F.struct(
            F.when(fits, F.concat(state["kept"], F.array(group))).otherwise(state["kept"]).alias("kept"),
            F.when(fits, grown).otherwise(state["used"]).alias("used"),
            (~fits).alias("full"),
        )

    return F.aggregate(groups, start, step, lambda s: s["kept"])


def query_text(groups: Column, joint: str = " ") -> Column:
    """Search text of the groups: '(a b c) OR (a b d)' or '(a AND b) OR ...'."""
    return F.array_join(
        F.transform(groups, lambda g: F.concat(F.lit("("), F.array_join(g, joint), F.lit(")"))), " OR "
    )


def restrictive_text(pairs: Column) -> Column:
    """'(c AND d) AND (a AND b)' for each pair after the first."""

    def one(p: Column) -> Column:
        return F.concat(F.lit("("), p[0], F.lit(" AND "), p[1], F.lit(")"))

    return F.array_join(
        F.transform(
            pairs,
            lambda p, i: F.when(i == 0, one(p)).otherwise(F.concat(one(p), F.lit(" AND "), one(F.get(pairs, i - 1)))),
        ),
        " OR ",
    )


def token_table(messages: DataFrame, tokens: Column, message_id: str = "message_id") -> DataFrame:
    """(message_id, date, word), each word once per message."""
    if "date" not in messages.columns:
        messages = messages.withColumn("date", F.lit(None).cast("timestamp"))
    cut = messages.select(message_id, "date", F.array_distinct(tokens).alias("words"))
    # outer, since the plain form adds a filter that would cut the words once more
    return cut.select(message_id, "date", F.explode_outer("words").alias("word")).where(F.col("word").isNotNull())


def days_around(claim_date: str, days: tuple[int, int]) -> Column:
    """The whole days a claim's window reaches."""
    before, after = days
    day = F.to_date(claim_date)
    return F.sequence(F.date_add(day, -before), F.date_add(day, after))


def within_reach(messages: DataFrame, claims: DataFrame, days: tuple[int, int]) -> DataFrame:
    """Messages of days that some claim (claim_date) reaches; others need not be cut into words.

    Different days are as few as the calendar has, so they may be broadcast.
    """
    # outer, since the plain form adds a filter that would make the days once more
    reached = claims.select(F.explode_outer(days_around("claim_date", days)).alias("_day")).where(F.col("_day").isNotNull())
    dated = messages.withColumn("_day", F.to_date("date"))
    return dated.join(F.broadcast(reached.distinct()), "_day", "left_semi").drop("_day")


def match_units(units: DataFrame, words: DataFrame, days: tuple[int, int] | None = None) -> DataFrame:
    """Messages holding at least `need` distinct keywords of a unit.

    With `days` = (before, after) only messages of the claim's day and so many
    whole days around it count.

    `units`: (fact_id, unit, keywords, need[, claim_date]); `words`: the token
    table. Result: (fact_id, unit, message_id, matched).
    """
    units = stored(units.withColumn("keywords", F.array_distinct("keywords")), "units")
    units = units.where((F.col("need") > 0) & (F.size("keywords") >= F.col("need")))
    asked = units.select("fact_id", "unit", "need", F.size("keywords").alias("n"), F.explode("keywords").alias("word"))
    # messages are read and cut into words once; only asked words are kept
    known = stored(words.join(asked.select("word").distinct(), "word", "left_semi"), "words")
    frequency = known.groupBy("word").agg(F.count("*").alias("n"))
    # a unit's window holds its own few keywords
    rarest = W.partitionBy("fact_id", "unit").orderBy(F.coalesce("f", F.lit(0)), "word")
    probes = (
        asked.join(frequency.withColumnRenamed("n", "f"), "word", "left")
        .withColumn("rarity", F.row_number().over(rarest))
        .where(F.col("rarity") <= F.col("n") - F.col("need") + 1)
        .where(F.col("f").isNotNull())
        .select("fact_id", "unit", "word")
    )
    carried = ["fact_id", "unit", "need", "keywords"] + (["claim_date"] if days else [])
    probes = probes.join(units.select(*carried), ["fact_id", "unit"])
    if days:
        # word and day together: a busy word only meets claims whose window it is in
        probes = probes.withColumn("_day", F.explode(days_around("claim_date", days)))
        dated = known.withColumn("_day", F.to_date("date"))
        busy = dated.groupBy("word", "_day").agg(F.count("*").alias("n"))
        hits = salted_join(dated, probes, ["word", "_day"], ["message_id"], hot_keys(busy, ["word", "_day"]))
    else:
        hits = salted_join(known, probes, "word", ["message_id"], hot_keys(frequency, "word"))
    # the asked words of each message, at most its own distinct words; hits meet
    # them by message, and repeated finds of a pair fall out in the same place
    hits = stored(hits.select("message_id", "fact_id", "unit", "need", "keywords"), "hits")
    found = known.join(hits.select("message_id").distinct(), "message_id", "left_semi")
    have = found.groupBy("message_id").agg(F.collect_list("word").alias("_have"))
    checked = hits.join(have, "message_id")
    matched = F.size(F.array_intersect("keywords", "_have"))
    checked = checked.select("fact_id", "unit", "message_id", "need", matched.cast("bigint").alias("matched"))
    kept = checked.where(F.col("matched") >= F.col("need")).drop("need")
    return kept.dropDuplicates(["message_id", "fact_id", "unit"])


def keyword_search(
    features: DataFrame,
    words: DataFrame,
    need: int = 3,
    limit: int | None = None,
    drop_query_words: bool = True,
    short: str = "none",
    days: tuple[int, int] | None = None,
) -> DataFrame:
    """Messages with at least `need` distinct keywords of a claim.

    Equal to the OR over all `need`-word AND-groups. Claims with fewer
    keywords find nothing, or need all of them with short='all'.
    """
    chosen = F.array_distinct(query_keywords("keywords", limit, drop_query_words))
    units = features.withColumn("keywords", chosen).withColumn("unit", F.lit(0))
    enough = F.size("keywords") >= need
    all_of = F.size("keywords") if short == "all" else F.lit(0)
    units = units.withColumn("need", F.when(enough, F.lit(need)).otherwise(all_of))
    columns = ["fact_id", "unit", "keywords", "need"] + (["claim_date"] if days else [])
    return match_units(units.select(*columns), words, days).drop("unit")


def group_search(groups: DataFrame, words: DataFrame, days: tuple[int, int] | None = None) -> DataFrame:
    """Messages matching any explicit AND-group (fact_id, groups[, claim_date])."""
    extra = ["claim_date"] if days else []
    units = groups.select("fact_id", *extra, F.posexplode("groups").alias("unit", "keywords"))
    units = units.withColumn("need", F.size(F.array_distinct("keywords")))
    hits = match_units(units, words, days)
    return hits.select("fact_id", "message_id").distinct()


def phrase_search(hits: DataFrame, features: DataFrame, messages: DataFrame, text: Column, need: int = 3) -> DataFrame:
    """Keep hits whose text has `need` keywords as whole phrases.

    For multi-word keywords: search on their words first, then check here.
    `text` is the normalised message with single blanks between words. A
    column `need` of the features goes before the argument.
    """
    asked = F.col("need") if "need" in features.columns else F.lit(need)
    padded = messages.select("message_id", F.concat(F.lit(" "), text, F.lit(" ")).alias("_text"))
    joined = hits.select("fact_id", "message_id").join(features.select("fact_id", "keywords", asked.alias("need")), "fact_id")
    joined = joined.join(padded, "message_id")
    present = F.filter("keywords", lambda k: F.contains(F.col("_text"), F.concat(F.lit(" "), k, F.lit(" "))))
    return joined.withColumn("matched", F.size(present)).where(F.col("matched") >= F.col("need")).select(
        "fact_id", "message_id", "matched"
    )


def runs_of(words, length: int) -> Column:
    """All runs of `length` consecutive words, joined by one blank."""
    words = F.col(words) if isinstance(words, str) else words
    if length == 1:
        return words
    starts = F.slice(words, 1, F.greatest(F.size(words) - (length - 1), F.lit(0)))
    return F.transform(starts, lambda w, i: F.concat_ws(" ", w, *[F.get(words, i + k) for k in range(1, length)]))


def phrase_table(messages: DataFrame, text: Column, asked: DataFrame) -> DataFrame:
    """(message_id, date, word, copies): asked phrases that stand in a message, each once.

    `asked`: (word), phrases of words joined by one blank; `text` has one blank
    between words, so a phrase stands where it is a run of words. message_id is
    a struct of the id and a hash of the text, since rows of one id may differ;
    `copies` is the number of equal rows.
    """
    if "date" not in messages.columns:
        messages = messages.withColumn("date", F.lit(None).cast("timestamp"))
    # one number per length of a phrase
    lengths = sorted(r[0] for r in asked.select(F.size(F.split("word", " "))).distinct().collect())
    cut = messages.select("message_id", "date", text.alias("_text")).where(F.col("message_id").isNotNull())
    cut = cut.select("message_id", "date", F.xxhash64("_text").alias("hash"), F.split("_text", " ").alias("_words"))
    runs = F.array_distinct(F.concat(F.array().cast("array<string>"), *[runs_of("_words", n) for n in lengths]))
    key = F.struct("message_id", "hash").alias("message_id")
    # outer, since the plain form adds a filter that would cut the words once more
    unfolded = cut.select(key, "date", F.explode_outer(runs).alias("word")).where(F.col("word").isNotNull())
    return unfolded.join(asked, "word", "left_semi").groupBy("message_id", "date", "word").agg(F.count("*").alias("copies"))


def claim_search(
    features: DataFrame,
    messages: DataFrame,
    tokens: Column,
    text: Column,
    need: int = 3,
    short: str = "none",
    days: tuple[int, int] | None = None,
) -> DataFrame:
    """Search with keywords of one or more words.

    Asked phrases are looked for in each message as runs of its words, so a text
    is cut once and only what stands in it goes on; phrases then are searched
    like words, by the rarest of each claim. Claims with fewer phrases find
    nothing, or need all with short='all'. `features`: (fact_id, keywords
    [, claim_date]); `text` is made of `tokens` joined by one blank. Equal rows
    of a claim or a message come out as often as they went in.
    """
    dates = ["claim_date"] if days else []
    n = F.size("keywords")
    wanted = F.when(n >= need, F.lit(need)).otherwise(n if short == "all" else F.lit(0))
    claims = features.withColumn("keywords", F.array_distinct("keywords"))
    claims = claims.select("fact_id", *dates, "keywords", wanted.alias("need")).where((F.col("need") > 0) & F.col("fact_id").isNotNull())
    claims = claims.groupBy("fact_id", *dates, "keywords", "need").agg(F.count("*").alias("copies"))
    claims = stored(claims.withColumn("unit", F.monotonically_increasing_id()), "claims")
    asked = claims.select(F.explode("keywords").alias("word")).where(F.col("word").isNotNull()).distinct()
    found = stored(phrase_table(messages, text, stored(asked, "phrases")), "found")
    hits = match_units(claims.drop("copies"), found.drop("copies"), days)
    rows = found.groupBy("message_id", "word").agg(F.sum("copies").alias("n")).groupBy("message_id").agg(F.max("n").alias("n"))
    hits = hits.join(claims.select("fact_id", "unit", "copies"), ["fact_id", "unit"]).join(rows, "message_id")
    each = F.explode(F.array_repeat(F.col("message_id.message_id"), (F.col("copies") * F.col("n")).cast("int"))).alias("message_id")
    return hits.select("fact_id", each, F.col("matched").cast("int").alias("matched"))

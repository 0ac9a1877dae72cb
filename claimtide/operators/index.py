"""Stored inverted index of messages: words with the words after them, added to per day, asked for phrases.

A phrase of two words stands where the first is followed by the second, and a
longer one where such pairs go on from place to place, so no text is read again
for a search and only pairs that are asked for meet by message. Words fall into
buckets by a hash; a search reads the buckets of its own words only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shuffles_released, stored
from ..sources.versions import VersionedTables
from .search import match_units

BUCKETS = 64
# words of a file in one dictionary each, as most stand in it more than once
PACKED = {"compression": "zstd", "parquet.dictionary.page.size": str(16 << 20)}


class PhraseIndex:
    """Postings (word, next, day, message_id, place) and frequencies (word, day, n) under a folder.

    Both come with one version per `add`. What is taken in is written by the
    tasks that cut the messages, each a file in the order of the buckets, so
    postings are not shuffled. Folded parts have a folder of files sorted by word
    per bucket; a word of very many messages is spread over several files, since
    rows are dealt by ranges of (bucket, word, message).
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS, fan: int = 8):
        self.spark, self.buckets = spark, buckets
        options = {"postings": PACKED, "frequencies": PACKED}
        self.tables = VersionedTables(spark, path, fan, partitions={"postings": ["bucket"]}, options=options)

    def _bucket(self, word: str = "word") -> Column:
        return F.pmod(F.xxhash64(word), F.lit(self.buckets)).cast("int").alias("bucket")

    def _dealt(self, postings: DataFrame) -> DataFrame:
        return postings.repartitionByRange("bucket", "word", "message_id").sortWithinPartitions("bucket", "word", "next", "day", "message_id")

    def _in_place(self, postings: DataFrame) -> DataFrame:
        """Each task's own rows by bucket, equal pairs of words together; one number is sorted much faster than words."""
        digits = [F.shiftrightunsigned(F.xxhash64(c), 40) for c in ("word", "next")]
        order = F.shiftleft(self._bucket().cast("bigint"), 48) + F.shiftleft(digits[0], 24) + digits[1]
        ordered = postings.select(self._bucket(), "*", order.alias("_order")).sortWithinPartitions("_order")
        return ordered.drop("_order")

    def add(self, run: str, messages: DataFrame, tokens: Column, message_id: str = "message_id", date: str = "date") -> int:
        """Take in messages, once per `run`; the number of the version that holds them.

        A message must come with one run only. Null texts have no words; messages
        without a date are found by searches without a window.
        """
        if self.tables.has_run(run):
            return self.tables.version()
        with shuffles_released(self.spark):
            ids = messages.groupBy(F.col(message_id).alias("_again")).agg(F.count("*").alias("n")).where("n > 1").select("_again")
            again = stored(ids, "again")
            same = F.col(message_id).eqNullSafe(F.col("_again"))
            row = [F.col(message_id).alias("message_id"), F.to_date(date).alias("day")]

            # a message of one row is cut where it is read
            cut = messages.join(again, same, "left_anti").select(*row, tokens.alias("word"))
            # outer, since the plain form adds a filter that would cut the words once more
            follow = F.posexplode_outer(F.arrays_zip("word", F.slice("word", 2, F.size("word")).alias("next"))).alias("place", "pair")
            postings = cut.select("message_id", "day", follow).select("message_id", "day", "place", "pair.word", "pair.next").where(F.col("word").isNotNull())
            words = cut.select("day", F.explode_outer(F.array_distinct("word")).alias("word")).where(F.col("word").isNotNull())
            if not again.isEmpty():
                # a message of several rows may have more than one word in a place
                cut = messages.join(again, same, "left_semi").select(*row, F.posexplode_outer(tokens).alias("place", "word"))
                held = stored(cut.where(F.col("word").isNotNull()).distinct(), "held")
                after = held.select("message_id", (F.col("place") - 1).alias("place"), F.col("word").alias("next")).distinct()
                postings = postings.unionByName(held.join(after, ["message_id", "place"], "left"))
                words = words.unionByName(held.select("message_id", "day", "word").distinct().drop("message_id"))
            frequencies = words.groupBy("word", "day").agg(F.count("*").alias("n"))
            folds = {"postings": self._dealt, "frequencies": lambda parts: parts.groupBy("word", "day").agg(F.sum("n").alias("n"))}
            return self.tables.commit(run, append={"postings": self._in_place(postings), "frequencies": frequencies}, folds=folds)

    def postings_of(self, words: DataFrame) -> DataFrame:
        """Postings of the words asked, or of the words with those after them (word, next); whole buckets of other words are not read."""
        asked = stored(words.distinct().select(self._bucket(), "*"), "asked")
        # at most one number per bucket
        wanted = sorted(r["bucket"] for r in asked.select("bucket").distinct().collect())
        postings = self.tables.table("postings").where(F.col("bucket").isin(wanted)).drop("bucket")
        return postings.join(asked.drop("bucket"), words.columns, "left_semi")

    def search(self, features: DataFrame, need: int = 3, short: str = "none", days: tuple[int, int] | None = None) -> DataFrame:
        """(fact_id, message_id, matched): messages with at least `need` phrases of a claim.

        `features`: (fact_id, keywords[, claim_date]), a claim's phrases as words
        joined by one blank. Claims with fewer phrases find nothing, or need all
        with short='all'. With `days` = (before, after), only messages of so many
        whole days around the claim's.

        A phrase grows word by word: the places of its first two words, then those
        of the next pair one place on. What is whole then is searched like a word.
        """
        if self.tables.table("postings") is None:
            empty = features.select("fact_id").limit(0)
            return empty.select("fact_id", F.lit(None).cast("long").alias("message_id"), F.lit(0).cast("long").alias("matched"))
        with shuffles_released(self.spark):
            dates = ["claim_date"] if days else []
            phrases = F.filter(F.array_distinct("keywords"), lambda k: k.isNotNull() & (F.btrim(k) != ""))
            claims = features.select("fact_id", *dates, phrases.alias("k"))
            n = F.size("k")
            wanted = F.when(n >= need, F.lit(need)).otherwise(n if short == "all" else F.lit(0))
            claims = claims.withColumn("need", wanted).where("need > 0")
            # equal claims are one
            claims = stored(claims.withColumnRenamed("k", "keywords").distinct().withColumn("unit", F.monotonically_increasing_id()), "claims")
            asked = claims.select(F.explode("keywords").alias("phrase")).distinct().select("phrase", F.split("phrase", " ").alias("words"))
            found = stored(self._places_of(stored(asked, "phrases")), "found")
            hits = match_units(claims, found, days)
            return hits.groupBy("fact_id", "message_id").agg(F.max("matched").alias("matched"))

    def _places_of(self, asked: DataFrame) -> DataFrame:
        """(word, message_id, date): messages in which all words of an asked phrase (phrase, words) follow each other."""
        # one number per length of a phrase
        sizes = [r[0] for r in asked.select(F.size("words")).distinct().collect()]
        starts = F.sequence(F.lit(0), F.size("words") - 2)
        pairs = F.transform(starts, lambda i: F.struct(F.get("words", i).alias("word"), F.get("words", i + 1).alias("next")))
        placed = self.postings_of(asked.where(F.size("words") > 1).select(F.inline(pairs)))
        placed = stored(placed, "places")
        out = self.postings_of(asked.where(F.size("words") == 1).select(F.get("words", F.lit(0)).alias("word")))
        out = out.select("word", "message_id", F.col("day").alias("date")).distinct()
        for size in range(2, max(sizes, default=1) + 1):
            if size == 2:
                runs = placed.select("message_id", "day", "place", F.concat_ws(" ", "word", "next").alias("run"), F.col("next").alias("word"))
            else:
                # runs that some phrase goes on from, and the pairs it goes on with
                longer = asked.where(F.size("words") >= size)
                begun = longer.select(F.array_join(F.slice("words", 1, size - 1), " ").alias("run")).distinct()
                pairs = longer.select(F.get("words", F.lit(size - 2)).alias("word"), F.get("words", F.lit(size - 1)).alias("next")).distinct()
                begun = runs.join(begun, "run", "left_semi")
                after = placed.join(pairs, ["word", "next"], "left_semi")
                after = after.select("message_id", "word", (F.col("place") - (size - 2)).alias("place"), "next")
                # a message of several days has a place's pair once for each
                grown = (begun.distinct() if size > 3 else begun).join(after, ["message_id", "place", "word"])
                grown = grown.select("message_id", "day", "place", F.concat_ws(" ", "run", "next").alias("run"), F.col("next").alias("word"))
                begun = longer.select(F.array_join(F.slice("words", 1, size), " ").alias("run")).distinct()
                runs = stored(grown.join(begun, "run", "left_semi"), "runs")
            done = runs.join(asked.where(F.size("words") == size).select(F.col("phrase").alias("run")), "run", "left_semi")
            out = out.unionByName(done.select(F.col("run").alias("word"), "message_id", F.col("day").alias("date")).distinct())
        return out

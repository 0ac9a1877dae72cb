"""The daily run: a claim is searched once, a day that breaks off leaves nothing, labels come after the search."""

import pytest
from pyspark.sql import functions as F

from claimtide.plans import daily
from claimtide.session import scratch_path
from claimtide.sources.versions import VersionedTables

CLAIMS = [
    (1, "2024-01-02", "Falso", "the purple elephant dances tonight"),
    (2, "2024-01-20", "Falso", "the purple elephant dances tonight"),
    (3, "2024-01-02", "Verdadero", "the purple elephant dances tonight"),
    (4, "2024-01-02", "Falso", "nothing"),
]
MESSAGES = [
    (10, "2024-01-03", "a purple elephant dances tonight, they say"),
    (11, "2024-01-03", "purple elephant dances"),
    (12, "2024-01-03", "purple elephant dances tonight again"),
    (13, "2024-01-19", "purple elephant tonight"),
    (14, "2024-01-30", "purple elephant tonight, too late for both"),
    (15, "2024-01-09", "purple elephant dances on the last day"),
]


class Day:
    def __init__(self, spark):
        stamp = F.col("date").cast("timestamp").alias("date")
        self.claims = spark.createDataFrame(CLAIMS, "fact_id long, date string, calification string, claim string").withColumn("date", stamp)
        self.messages = spark.createDataFrame(MESSAGES, "message_id long, date string, text string").withColumn("date", stamp)
        self.news = self.messages.select(F.col("message_id").alias("news_id"), "date", F.initcap("text").alias("Title"))
        v = lambda df, i: df.select(i, F.array(F.lit(1.0), (F.col(i) % 2).cast("double")).alias("vector"))
        self.vectors = {
            "claims": v(self.claims, "fact_id"), "reviews": v(self.claims, "fact_id"), "messages": v(self.messages, "message_id"), "news": v(self.news, "news_id"),
        }
        self.tables = VersionedTables(spark, scratch_path(spark, "daily"))
        self.work = daily.DailyRun(self.tables, daily.Settings(messages_per_day=2))

    def run(self, day, now, describe=daily.simple_keywords, since="2024-01-01"):
        return self.work.run(day, now, since, self.claims, self.messages, self.news, describe, self.vectors)

    def pairs(self, name, id_):
        table = self.tables.table(name)
        return sorted(map(tuple, table.select("fact_id", id_).collect()))


@pytest.fixture
def day(spark):
    return Day(spark)


def test_days(spark, day):
    assert day.run("monday", "2024-01-15 06:00:00") == 1
    # two messages of a day at most, by id; the day before the window and true claims are left out
    assert day.pairs("message_pairs", "message_id") == [(1, 10), (1, 11), (1, 15)]
    # windows of news start at the claim's own time, so their last day is the one before
    assert day.pairs("news_pairs", "news_id") == [(1, 10), (1, 11), (1, 12)]
    assert {r.fact_id: r.messages_searched_at is not None for r in day.tables.table("features").collect()} == {1: True, 2: False, 3: False, 4: True}
    assert day.run("monday", "2024-01-15 06:00:00") == 1
    assert day.run("tuesday", "2024-02-01 06:00:00") == 2
    assert day.pairs("message_pairs", "message_id") == [(1, 10), (1, 11), (1, 15), (2, 13)]
    assert day.pairs("message_labels", "message_id") == day.pairs("message_pairs", "message_id")
    assert day.pairs("news_labels", "news_id") == day.pairs("news_pairs", "news_id")
    labels = {(r.fact_id, r.message_id): (r.topic_relation, r.claim_finer_relation) for r in day.tables.table("message_labels").collect()}
    assert labels[1, 11] == ("on-topic", "not-disseminates") and labels[1, 10] == ("off-topic", None)
    marks = {r.fact_id: str(r.news_filtered_at)[:10] for r in day.tables.table("features").collect()}
    assert marks == {1: "2024-01-15", 2: "2024-02-01", 3: "None", 4: "2024-01-15"}


def test_a_day_that_breaks_off_leaves_nothing(spark, day):
    def broken(claims):
        return daily.simple_keywords(claims).withColumn("keywords", F.when(F.col("fact_id") == 2, F.raise_error(F.lit("tagger"))).otherwise(F.col("keywords")))

    with pytest.raises(Exception, match="tagger"):
        day.run("monday", "2024-01-15", broken)
    assert day.tables.version() == 0
    assert day.run("monday", "2024-01-15") == 1


def test_labels_wait_for_their_date(spark, day):
    day.run("monday", "2024-01-15", since="2024-01-10")
    assert day.pairs("message_labels", "message_id") == []
    day.run("tuesday", "2024-01-16", since="2024-01-01")
    assert day.pairs("message_labels", "message_id") == [(1, 10), (1, 11), (1, 15)]
    assert day.pairs("message_pairs", "message_id") == [(1, 10), (1, 11), (1, 15)]

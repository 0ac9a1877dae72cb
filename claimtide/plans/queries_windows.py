"""Windows, caps, samples and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text, times
from ..operators import aggregates, filters, keyed, ranking, sets, statistics
from . import sampling
from .catalog import CHECKED_SQL, OFFSET_SQL, Tables, query
from .queries_aggregates import DAY, rounded
from .queries_functions import PAIRS_SQL, vector_tables
from .queries_joins import BEFORE_AFTER_SQL, with_offsets
from .queries_rows import TOKENS_SQL, UNIFIED_SQL, feeds


@query(
    "W1_first_per_day",
    f"""
    SELECT event_id, {DAY} AS day, position FROM (
      SELECT *, row_number() OVER (PARTITION BY ts::DATE ORDER BY ts, event_id)::INT AS position FROM events) WHERE position <= 2
    """,
)
def first_per_day(spark, folder):
    df = Tables(spark, folder).events.withColumn("day", times.day_text("ts"))
    return keyed.cap_per_key(df, ["day"], ["ts", "event_id"], 2).select("event_id", "day", "position")


@query(
    "W2_sample_per_claim",
    """
    SELECT event_id, user_id, position FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY md5('7:' || event_id), event_id)::INT AS position FROM events)
    WHERE position <= 20
    """,
)
def sample_per_claim(spark, folder):
    df = Tables(spark, folder).events.select("event_id", "user_id")
    return keyed.sample_per_key(df, ["user_id"], ["event_id"], 20, 7)


@query(
    "E2_sampled_messages",
    """
    WITH c AS (
      SELECT o_orderkey AS fact_id, o_custkey AS review, row_number() OVER (PARTITION BY o_orderdate::DATE ORDER BY o_orderdate, o_orderkey) AS place
      FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1999-12-31' AND o_orderstatus = 'F' AND o_orderpriority <> '5-LOW'),
    m AS (SELECT event_id AS message_id, unnest(list_distinct([user_id, event_id])) AS fact_id FROM events),
    r AS (SELECT fact_id, review, message_id,
        row_number() OVER (PARTITION BY fact_id ORDER BY md5('7:' || message_id), message_id)::INT AS position
      FROM m JOIN c USING (fact_id) WHERE place <= 2)
    SELECT * FROM r WHERE position <= 3
    """,
)
def sampled_messages(spark, folder):
    """Eligible orders as claims; each event names its user and itself as claims."""
    t = Tables(spark, folder)
    claims = t.claims.withColumns({"claim": F.col("price"), "review": F.col("custkey")})
    messages = t.events.select(
        F.col("event_id").alias("tweet_id"), F.array_distinct(F.array("user_id", "event_id")).alias("fact_id")
    )
    picked = sampling.sampled_messages(claims, messages, "1997-01-01", "1999-12-31", ["5-LOW"], ["F"], 2, 3, 7)
    return picked.select("fact_id", "review", "message_id", "position")


HOURLY_SQL = "hourly AS (SELECT date_trunc('hour', ts) AS hour, count(*) AS count FROM events GROUP BY 1)"


def hourly(t: Tables):
    """Events per hour: a series as long as the calendar, not the data."""
    return t.events.groupBy(F.date_trunc("hour", "ts").alias("hour")).agg(F.count("*").alias("count"))


def shown_hour(df):
    return df.withColumn("hour", F.date_format("hour", "yyyy-MM-dd HH"))


@query(
    "W3_rolling",
    f"""
    WITH {HOURLY_SQL}
    SELECT strftime(hour, '%Y-%m-%d %H') AS hour, count, round(CASE WHEN count(*) OVER w >= 12 THEN avg(count) OVER w END, 6) AS rolling_mean,
      round(CASE WHEN count(*) OVER w >= 12 THEN stddev_samp(count) OVER w END, 6) AS rolling_std
    FROM hourly WINDOW w AS (ORDER BY hour ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)
    """,
)
def rolling(spark, folder):
    out = statistics.rolling(hourly(Tables(spark, folder)), "hour", "count", [])
    return rounded(shown_hour(out), "rolling_mean", "rolling_std")


@query(
    "W4_first_difference",
    f"""
    WITH {CHECKED_SQL}, {OFFSET_SQL}, c AS (SELECT fact_id, day_offset, count(*) AS count FROM offsets GROUP BY 1, 2),
    d AS (SELECT *, count - lag(count) OVER (PARTITION BY fact_id ORDER BY day_offset) AS diff FROM c)
    SELECT fact_id, day_offset, count, diff FROM d WHERE diff IS NOT NULL
    """,
)
def first_difference(spark, folder):
    series = aggregates.count_by(with_offsets(Tables(spark, folder)), "fact_id", "day_offset")
    return statistics.differenced(series, "day_offset", "count", ["fact_id"])


@query(
    "W5_token_neighbours",
    rf"""
    WITH t AS (SELECT item_id, {TOKENS_SQL.format('text')} AS t FROM benchmark),
    f AS (SELECT item_id, unnest(t) AS token, unnest(range(len(t))) AS i FROM t)
    SELECT item_id, i::INT AS i, token, lead(token, 1) OVER w AS next_1, lead(token, 2) OVER w AS next_2
    FROM f WINDOW w AS (PARTITION BY item_id ORDER BY i)
    """,
)
def token_neighbours(spark, folder):
    """Neighbours by shifted arrays: no shuffle."""
    t = Tables(spark, folder).benchmark.select("item_id", text.corpus_tokens("text").alias("t"))
    shifted = [F.slice("t", k + 1, F.greatest(F.size("t") - k, F.lit(0))).alias(f"n{k}") for k in (1, 2)]
    zipped = t.select("item_id", "t", *shifted).select("item_id", F.posexplode(F.arrays_zip("t", "n1", "n2")).alias("i", "z"))
    return zipped.select(
        "item_id", "i", F.col("z.t").alias("token"), F.col("z.n1").alias("next_1"), F.col("z.n2").alias("next_2")
    )


@query(
    "W7_last_writer",
    """
    SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type, arg_max(value, (ts, event_id)) AS value, count(*) AS writes
    FROM events GROUP BY 1
    """,
)
def last_writer(spark, folder):
    return keyed.last_per_key(Tables(spark, folder).events, "user_id", ["ts", "event_id"], ["event_type", "value"])


@query("W7_pushed_links", "SELECT user_id, event_type AS fact_id, count(*) AS pushes FROM events GROUP BY 1, 2")
def pushed_links(spark, folder):
    df = Tables(spark, folder).events.withColumnRenamed("event_type", "fact_id")
    return keyed.pushed_links(df, "user_id")


@query(
    "W8_first_writer",
    """
    SELECT user_id, arg_min(event_type, (ts, event_id)) AS event_type, arg_min(value, (ts, event_id)) AS value FROM events GROUP BY 1
    """,
)
def first_writer(spark, folder):
    return keyed.first_per_key(Tables(spark, folder).events, "user_id", ["ts", "event_id"], ["event_type", "value"])


@query(
    "W9_autocorrelation",
    f"""
    WITH {HOURLY_SQL}, c AS (SELECT row_number() OVER (ORDER BY hour) AS i, count - (SELECT avg(count) FROM hourly) AS c FROM hourly)
    SELECT lag::INT AS lag, round(sum(a.c * b.c) / (SELECT sum(c * c) FROM c), 6) AS acf
    FROM range(1, 21) l(lag), c a, c b WHERE b.i = a.i - lag GROUP BY 1
    """,
)
def autocorrelation(spark, folder):
    return rounded(statistics.autocorrelation(hourly(Tables(spark, folder)), "hour", "count"), "acf")


@query(
    "W10_share_of_total",
    "SELECT user_id, count(*) AS count, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM events GROUP BY 1",
)
def share_of_total(spark, folder):
    counts = aggregates.count_by(Tables(spark, folder).events, "user_id")
    return counts.withColumn("share", F.round(aggregates.share(counts), 6))


@query(
    "W11_margin_order",
    f"""
    WITH c AS (SELECT user_id, event_type, count(*) AS count FROM events GROUP BY 1, 2),
    m AS (SELECT *, sum(count) OVER (PARTITION BY user_id) AS row_total, sum(count) OVER (PARTITION BY event_type) AS column_total FROM c),
    t AS (SELECT user_id, count(*) AS n FROM events GROUP BY 1),
    r AS (SELECT user_id, rank() OVER (ORDER BY n) AS row_rank, sum(n) OVER (ORDER BY n) AS cumulative FROM t)
    SELECT user_id, event_type, count, row_total::BIGINT AS row_total, column_total::BIGINT AS column_total, row_rank::BIGINT AS row_rank,
      cumulative::BIGINT AS cumulative FROM m JOIN r USING (user_id)
    """,
)
def margin_order(spark, folder):
    """Row rank and running total by margin, from equal totals folded together."""
    long = aggregates.crosstab_counts(Tables(spark, folder).events, "user_id", "event_type")
    totals = long.select("user_id", "row_total").distinct()
    sizes = totals.groupBy("row_total").agg(F.count("*").alias("keys"), F.sum("row_total").alias("rows"))
    by_keys = ranking.running_totals(sizes.select("row_total", "keys"), [], "row_total", "keys")
    by_rows = ranking.running_totals(sizes.select("row_total", "rows"), [], "row_total", "rows")
    placed = by_keys.select("row_total", (F.col("_before") + 1).alias("row_rank")).join(
        by_rows.select("row_total", (F.col("_before") + F.col("rows")).alias("cumulative")), "row_total"
    )
    return long.join(placed, "row_total").select(
        "user_id", "event_type", "count", "row_total", "column_total", "row_rank", "cumulative"
    )


@query(
    "K1_nearest_and_farthest",
    f"""
    WITH {PAIRS_SQL}, d AS (SELECT message_id, fact_id, round(1 - score, 6) AS distance FROM scored),
    r AS (SELECT *, row_number() OVER (PARTITION BY fact_id ORDER BY distance, message_id)::INT AS near,
      row_number() OVER (PARTITION BY fact_id ORDER BY distance DESC, message_id DESC)::INT AS far FROM d)
    SELECT fact_id, message_id, distance, near AS rank, 'related' AS side FROM r WHERE near <= 5
    UNION ALL SELECT fact_id, message_id, distance, far, 'not related' FROM r WHERE far <= 5
    """,
)
def nearest_and_farthest(spark, folder):
    from ..operators import scoring

    pairs, claims, _, messages = vector_tables(Tables(spark, folder))
    scored = scoring.score_pairs(pairs, claims, messages)
    scored = scored.select("fact_id", "message_id", F.round(1 - F.col("score"), 6).alias("distance"))
    return scoring.nearest_and_farthest(scored, "fact_id", "distance", "message_id")


@query(
    "K2_top_newspapers",
    "SELECT user_id, count(*) AS count FROM events GROUP BY 1 ORDER BY count DESC, user_id LIMIT 50",
)
def top_newspapers(spark, folder):
    return keyed.top(aggregates.count_by(Tables(spark, folder).events, "user_id"), [F.desc("count"), "user_id"], 50)


@query(
    "K3_cap_per_claim_day",
    """
    SELECT event_id FROM (
      SELECT event_id, row_number() OVER (PARTITION BY user_id, ts::DATE ORDER BY ts, event_id) AS n FROM events) WHERE n <= 2
    """,
)
def cap_per_claim_day(spark, folder):
    df = Tables(spark, folder).events.withColumn("day", F.to_date("ts"))
    return keyed.cap_per_key(df, ["user_id", "day"], ["ts", "event_id"], 2).select("event_id")


@query(
    "K4_keyword_cap",
    f"""
    SELECT doc_id, array_to_string(list_sort(list_distinct({TOKENS_SQL.format('text')}))[1:6], ' ') AS keywords FROM documents
    """,
)
def keyword_cap(spark, folder):
    words = F.slice(F.sort_array(F.array_distinct(text.corpus_tokens("text"))), 1, 6)
    return Tables(spark, folder).documents.select("doc_id", F.array_join(words, " ").alias("keywords"))


@query("K5_sample", "SELECT doc_id FROM documents ORDER BY md5('1995:' || doc_id), doc_id LIMIT 20")
def sample(spark, folder):
    return keyed.sample(Tables(spark, folder).documents.select("doc_id"), ["doc_id"], 20, 1995)


@query(
    "K6_optional_cap",
    """
    (SELECT 'capped' AS run, o_orderkey AS fact_id FROM orders ORDER BY md5('3:' || o_orderkey), o_orderkey LIMIT 100)
    UNION ALL SELECT 'off', o_orderkey FROM orders
    """,
)
def optional_cap(spark, folder):
    claims = Tables(spark, folder).claims.select("fact_id")
    capped = keyed.sample(claims, ["fact_id"], 100, 3).select(F.lit("capped").alias("run"), "fact_id")
    return capped.unionByName(keyed.sample(claims, ["fact_id"], None).select(F.lit("off").alias("run"), "fact_id"))


@query(
    "K7_order_by_mean",
    """
    SELECT event_type, round(avg(value), 6) AS mean, rank() OVER (ORDER BY avg(value) DESC)::INT AS place FROM events GROUP BY 1
    """,
)
def order_by_mean(spark, folder):
    from pyspark.sql import Window as W

    means = Tables(spark, folder).events.groupBy("event_type").agg(F.avg("value").alias("mean"))
    # one row per event type
    ranked = means.withColumn("place", F.rank().over(W.partitionBy(F.lit(0)).orderBy(F.desc("mean"))))
    return rounded(ranked, "mean").orderBy(F.desc("mean"))


@query(
    "U1_with_total",
    """
    WITH c AS (SELECT event_type AS label, count(*) AS n FROM events GROUP BY 1)
    SELECT * FROM c UNION ALL SELECT 'Total', sum(n)::BIGINT FROM c
    """,
)
def with_total(spark, folder):
    counts = Tables(spark, folder).events.groupBy(F.col("event_type").alias("label")).agg(F.count("*").alias("n"))
    return sets.with_total(counts, "label", ["n"])


def side(t: Tables, before: bool):
    offset = F.col("hour_offset")
    return with_offsets(t).where(offset < 0 if before else offset >= 0)


@query("U2_any_ids", f"WITH {BEFORE_AFTER_SQL} SELECT fact_id FROM sides WHERE before > 0 OR after > 0")
def any_ids(spark, folder):
    t = Tables(spark, folder)
    return sets.any_ids(side(t, True), side(t, False))


@query("U3_shared_ids", f"WITH {BEFORE_AFTER_SQL} SELECT fact_id FROM sides WHERE before > 0 AND after > 0")
def shared_ids(spark, folder):
    t = Tables(spark, folder)
    return sets.shared_ids(side(t, True), side(t, False))


@query("U4_new_ids", "SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels")
def new_ids(spark, folder):
    t = Tables(spark, folder)
    return sets.new_ids(t.documents, t.labels, "doc_id")


@query("U5_union_feeds", UNIFIED_SQL)
def union_feeds(spark, folder):
    from .queries_rows import REPOSITORY, REVIEW

    repository, review = feeds(Tables(spark, folder))
    return sets.union_feeds(filters.map_fields(repository, REPOSITORY), filters.map_fields(review, REVIEW))


@query(
    "U6_zero_rows",
    f"""
    WITH {BEFORE_AFTER_SQL}, k AS (SELECT fact_id FROM sides WHERE before > 0 OR after > 0)
    SELECT fact_id, 'Before/fact-check' AS impact, before AS n FROM sides JOIN k USING (fact_id)
    UNION ALL SELECT fact_id, 'After', after FROM sides JOIN k USING (fact_id)
    """,
)
def zero_rows(spark, folder):
    df = with_offsets(Tables(spark, folder)).withColumn("impact", times.impact("hour_offset"))
    counts = df.groupBy("fact_id", "impact").agg(F.count("*").alias("n"))
    return sets.with_zero_rows(counts, "fact_id", "impact", ["Before/fact-check", "After"])

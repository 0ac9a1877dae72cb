"""Readers and writers: tables are landed in each format, then read back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from ..functions import times
from ..operators import aggregates, threads
from ..session import scratch_path, stored
from ..sources import readers, sinks
from .catalog import Tables, query
from .queries_functions import (
    ANNOTATION_SQL,
    PUBLICATIONS_SQL,
    VARIANTS_SQL,
    annotated,
    publications,
)
from .queries_joins import FEATURE_WORDS_SQL, REGISTRY_SQL, TITLE_SQL, benchmark_features, media_registry, title_news

SECOND = "yyyy-MM-dd'T'HH:mm:ss"
SHOWN = "yyyy-MM-dd HH:mm:ss"


def named(name: str):
    return F.struct(F.col(name).alias("name"))


@query(
    "S1_read_claims_repository",
    """
    SELECT o_orderkey::VARCHAR AS link, o_orderpriority AS reviewer, o_orderstatus AS verdict, o_orderpriority AS first_category,
      strftime(o_orderdate - INTERVAL 2 HOUR, '%Y-%m-%d %H:%M:%S') AS date FROM orders
    """,
)
def read_claims_repository(spark, folder):
    path = scratch_path(spark, "claims")
    Tables(spark, folder).orders.select(
        F.col("o_orderkey").cast("string").alias("link"),
        F.concat(F.date_format("o_orderdate", SECOND), F.lit("+02:00")).alias("createdAt"),
        F.array(named("o_orderpriority"), named("o_orderstatus")).alias("categories"),
        named("o_orderpriority").alias("organization"),
        F.struct(named("o_orderstatus").alias("calification")).alias("organizationCalification"),
    ).write.json(path)
    read = readers.read_claims_repository(spark, path)
    return read.select(
        "link",
        F.col("organization.name").alias("reviewer"),
        F.col("organizationCalification.calification.name").alias("verdict"),
        F.get("categories", F.lit(0))["name"].alias("first_category"),
        F.date_format(F.to_utc_timestamp("date", F.current_timezone()), SHOWN).alias("date"),
    )


def day_after(number: str, shown: str):
    """Days of 2022 in turn, as text."""
    days = (F.col(number) % 365).cast("int")
    return F.date_format(F.date_add(F.lit("2022-01-01").cast("date"), days), shown)


@query(
    "S2_read_claims_review",
    """
    SELECT c_name AS text, c_custkey::VARCHAR AS url, c_mktsegment AS publisher,
      strftime(DATE '2022-01-01' + (c_custkey % 365)::INT, '%Y-%m-%d') || ' 07:00:00' AS date FROM customer
    """,
)
def read_claims_review(spark, folder):
    path = scratch_path(spark, "reviews")
    review = F.struct(
        F.struct(F.col("c_mktsegment").alias("name")).alias("publisher"),
        F.col("c_custkey").cast("string").alias("url"),
        F.concat(day_after("c_custkey", "yyyy-MM-dd"), F.lit("T07:00:00Z")).alias("reviewDate"),
    )
    Tables(spark, folder).customer.select(F.col("c_name").alias("text"), F.array(review).alias("claimReview")).write.json(path)
    read = readers.read_claims_review(spark, path)
    return read.select(
        "text",
        F.col("claimReview.url").alias("url"),
        F.col("claimReview.publisher.name").alias("publisher"),
        F.date_format(F.to_utc_timestamp("date", F.current_timezone()), SHOWN).alias("date"),
    )


@query(
    "S3_read_messages",
    """
    SELECT event_id::VARCHAR AS tweet_id, event_type AS text, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS date,
      user_id::VARCHAR AS fact_id, floor(value)::BIGINT AS like_count FROM events
    """,
)
def read_messages(spark, folder):
    path = scratch_path(spark, "messages")
    payload = F.struct(
        F.col("event_id").cast("string").alias("id"),
        F.col("event_type").alias("text"),
        F.concat(F.date_format("ts", SECOND), F.lit(".000Z")).alias("created_at"),
        F.struct(F.floor("value").alias("like_count")).alias("public_metrics"),
    )
    Tables(spark, folder).events.select(F.col("user_id").cast("string").alias("fact_id"), payload.alias("tweet")).write.json(path)
    read = readers.read_messages(spark, path)
    return read.select(
        "tweet_id", "text", F.date_format("date", SHOWN).alias("date"), "fact_id",
        F.col("tweet.public_metrics.like_count").alias("like_count"),
    )


@query(
    "S4_read_news",
    """
    WITH a AS (SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey AS id, * FROM lineitem)
    SELECT id AS "IdDocument", l_returnflag AS "Newspaper", strftime(l_shipdate, '%Y-%m-%d') AS date, l_orderkey::VARCHAR AS fact_id,
      l_suppkey AS query_output FROM a
    UNION ALL SELECT id || '-b', l_linestatus, strftime(l_shipdate + INTERVAL 1 DAY, '%Y-%m-%d'), l_orderkey::VARCHAR, l_suppkey FROM a
    """,
)
def read_news(spark, folder):
    """One response of two articles per line item."""
    path = scratch_path(spark, "news")
    key = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey")

    def article(id_, newspaper: str, shift: int):
        date = F.date_format(F.date_add("l_shipdate", shift), "dd/MM/yyyy")
        return F.struct(id_.alias("IdDocument"), F.col(newspaper).alias("Newspaper"), date.alias("Date"))

    Tables(spark, folder).lineitem.select(
        F.col("l_orderkey").cast("string").alias("fact_id"),
        F.col("l_suppkey").alias("total"),
        F.array(article(key, "l_returnflag", 0), article(F.concat(key, F.lit("-b")), "l_linestatus", 1)).alias("news"),
    ).write.json(path)
    read = readers.read_news(spark, path)
    return read.select("IdDocument", "Newspaper", times.day_text("date").alias("date"), "fact_id", "query_output")


@query(
    "S5_read_press_xml",
    r"""
    SELECT doc_id::VARCHAR AS _id, strftime(DATE '2022-01-01' + (doc_id % 365)::INT, '%Y-%m-%d') AS date, source AS newspaper, lang AS headline,
      md5(regexp_replace(text, '\s+', ' ', 'g')) AS content_md5 FROM documents
    """,
)
def read_press_xml(spark, folder):
    path = scratch_path(spark, "press")
    Tables(spark, folder).documents.select(
        F.struct(
            F.col("doc_id").cast("string").alias("IdDocument"),
            day_after("doc_id", "yyyy/MM/dd").alias("DREDATE"),
            F.col("source").alias("Newspaper"),
            F.col("lang").alias("Title"),
        ).alias("head"),
        F.struct(F.regexp_replace("text", r"\s+", " ").alias("DRECONTENT")).alias("body"),
    ).write.format("xml").option("rootTag", "articulos").option("rowTag", "articulo").save(path)
    read = readers.read_press_xml(spark, path)
    return read.select(
        "_id", times.day_text("date").alias("date"), "newspaper", "headline", F.md5("content").alias("content_md5")
    )


@query(
    "S6_read_wire_xml",
    """
    SELECT event_id::VARCHAR AS _id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS date, event_type AS headline,
      props AS content FROM events
    """,
)
def read_wire_xml(spark, folder):
    path = scratch_path(spark, "wire")
    Tables(spark, folder).events.select(
        F.struct(
            F.date_format("ts", "dd/MM/yyyy HH:mm:ss").alias("DateLabel"),
            F.struct(F.col("event_id").cast("string").alias("NewsItemId")).alias("NewsIdentifier"),
        ).alias("Identification"),
        F.struct(
            F.struct(F.col("event_type").alias("HeadLine")).alias("NewsLines"),
            F.struct(F.col("props").alias("DataContent")).alias("ContentItem"),
        ).alias("NewsComponent"),
    ).write.format("xml").option("rootTag", "NewsML").option("rowTag", "NewsItem").save(path)
    read = readers.read_wire_xml(spark, path)
    return read.withColumn("date", F.date_format("date", SHOWN))


@query("S7_read_channels", "SELECT url, regexp_extract(url, '/([a-z]{2})/', 1) AS language FROM pages")
def read_channels(spark, folder):
    path = scratch_path(spark, "channels")
    language = F.regexp_extract("url", "/([a-z]{2})/", 1)
    Tables(spark, folder).pages.select("url", language.alias("language")).write.option("emptyValue", "").csv(path)
    return readers.read_channels(spark, path).fillna("")


@query(
    "S8_read_chat_messages",
    """
    SELECT turn AS "messageId", conv_id AS "channelId", strftime(TIMESTAMP '2024-01-01' + to_seconds(conv_id * 60 + turn), '%Y-%m-%d %H:%M:%S') AS date,
      CASE WHEN turn > 0 THEN turn - 1 END AS reply_to, md5(text) AS message_md5, CASE WHEN role = 'user' THEN 7 ELSE 0 END::BIGINT AS views,
      role AS sender, CASE WHEN role = 'assistant' THEN 'page' || turn END AS crawled
    FROM conversations WHERE length(text) > 0
    """,
)
def read_chat_messages(spark, folder):
    path = scratch_path(spark, "chat")
    epoch = F.lit(1704067200).cast("bigint") + F.col("conv_id") * 60 + F.col("turn")
    page = F.struct(F.concat(F.lit("page"), "turn").alias("url"), F.lit("[]").alias("blocks"))
    media = F.struct(F.struct(page.alias("cachedPage")).alias("webpage"))
    Tables(spark, folder).conversations.select(
        F.col("turn").alias("id"),
        F.col("conv_id").alias("channelId"),
        epoch.alias("date"),
        F.when(F.col("turn") > 0, F.struct((F.col("turn") - 1).alias("replyToMsgId"))).alias("replyTo"),
        F.col("text").alias("message"),
        F.to_json(F.struct(F.col("role").alias("userId"))).alias("fromId"),
        F.when(F.col("role") == "user", 7).alias("views"),
        F.when(F.col("role") == "assistant", media).alias("media"),
    ).write.json(path)
    read = readers.read_chat_messages(spark, path)
    return read.select(
        "messageId",
        "channelId",
        F.date_format(F.to_utc_timestamp("date", F.current_timezone()), SHOWN).alias("date"),
        F.col("replyTo.reply_to_msg_id").alias("reply_to"),
        F.md5("message").alias("message_md5"),
        "views",
        F.col("sender")["userId"].alias("sender"),
        F.col("instantCrawled.url").alias("crawled"),
    )


def list_pages(t: Tables):
    """Stored list pages, one per event."""
    e = t.events.withColumn("stamp", F.unix_timestamp(F.date_trunc("second", "ts")).cast("string"))
    post = F.concat(
        F.lit('<div class="news-summary"><div class="news-body" data-link-id="'), "event_id",
        F.lit('"><div class="news-shakeit"><div class="votes"> <a href="#">'), "user_id",
        F.lit('</a></div><div class="clics"><span> '), F.floor("value"), F.lit(" clics</span></div></div>"),
        F.when(F.col("event_type") == "error", F.lit('<div class="warn warn-n">!</div>')).otherwise(F.lit("")),
        F.lit('<div class="news-submitted"><span class="ts visible" data-ts="'), "stamp",
        F.lit('"></span><span class="showmytitle" title="https://news.example/?a='), "event_id", F.lit('&amp;b=1">site</span></div>'),
        F.when(F.col("event_id") % 2 == 0, F.concat(
            F.lit('<a href="#" title="miniatura"> <img alt="" src="/img/'), "event_id", F.lit('.jpg"></a>'),
        )).otherwise(F.lit("")),
        F.lit('<div class="news-details news-details-main"><span class="sub-name"><a class="subname" href="/x">'), "event_type",
        F.lit(' &amp; co</a></span><span class="positive-vote-number">'), F.col("event_id") % 9,
        F.lit('</span><a class="comments" href="/story/'), "event_id", F.lit('" data-comments-number="'), F.col("event_id") % 5,
        F.lit('">comments</a></div></div></div>'),
    )
    html = F.concat(F.lit("<html><body><nav>menu</nav>"), post, F.lit("</body></html>"))
    return e.select(F.concat_ws("/", "user_id", "event_id").alias("page_id"), html.alias("html"))


@query(
    "S9_extract_posts",
    """
    SELECT user_id || '/' || event_id AS page_id, event_id::VARCHAR AS post_id, user_id AS votes, floor(value)::BIGINT AS clicks,
      event_type || ' & co' AS category, strftime(date_trunc('second', ts) + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS created_local,
      event_type = 'error' AS controversy, event_id % 9 AS positive_votes, event_id % 5 AS number_comments,
      '/story/' || event_id AS url, 'https://news.example/?a=' || event_id || '&b=1' AS article_url,
      CASE WHEN event_id % 2 = 0 THEN '/img/' || event_id || '.jpg' END AS image_url FROM events
    """,
)
def extract_posts(spark, folder):
    posts = readers.extract_posts(list_pages(Tables(spark, folder)))
    return posts.withColumn("created_local", F.date_format("created_local", SHOWN)).drop("created_epoch", "negative_votes")


@query(
    "S10_read_corpus",
    r"SELECT md5(s) AS sentence_md5, count(*) AS n FROM (SELECT unnest(string_split(text, e'\n')) AS s FROM documents) GROUP BY 1",
)
def read_corpus(spark, folder):
    path = scratch_path(spark, "corpus")
    Tables(spark, folder).documents.select(F.explode(F.split("text", "\n")).alias("value")).write.text(path)
    return readers.read_corpus(spark, path).groupBy(F.md5("sentence").alias("sentence_md5")).agg(F.count("*").alias("n"))


@query(
    "S11_read_media_registry",
    """
    SELECT p_partkey::VARCHAR AS id, p_name AS name, CASE WHEN p_size > 20 THEN 'true' ELSE 'false' END AS active,
      'https://' || replace(p_name, ' ', '') AS url, p_type AS country FROM part
    """,
)
def read_media_registry(spark, folder):
    path = scratch_path(spark, "registry")
    filler = [F.lit("x").alias(f"column {i}") for i in range(4, 16)]
    Tables(spark, folder).part.select(
        F.col("p_partkey").alias("Id of outlet"),
        F.col("p_name").alias("Name, full"),
        (F.col("p_size") > 20).alias("Active?"),
        F.concat(F.lit("https://"), F.replace("p_name", F.lit(" "), F.lit(""))).alias("Url"),
        *filler,
        F.col("p_type").alias("Country"),
    ).write.option("header", True).csv(path)
    return readers.read_media_registry(spark, path)


EXTENDED = T.StructType.fromJson(
    {
        "type": "struct",
        "fields": [
            {"name": n, "type": t, "nullable": True, "metadata": {}}
            for n, t in (
                ("_id", {"type": "struct", "fields": [{"name": "$oid", "type": "string", "nullable": True, "metadata": {}}]}),
                ("date", {"type": "struct", "fields": [{"name": "$date", "type": "string", "nullable": True, "metadata": {}}]}),
                (
                    "fact_id",
                    {
                        "type": "array",
                        "containsNull": True,
                        "elementType": {
                            "type": "struct",
                            "fields": [{"name": "$oid", "type": "string", "nullable": True, "metadata": {}}],
                        },
                    },
                ),
                (
                    "tweet",
                    {
                        "type": "struct",
                        "fields": [{"name": "like_count", "type": "long", "nullable": True, "metadata": {}}],
                    },
                ),
            )
        ],
    }
)


@query(
    "S12_read_extended_json",
    """
    SELECT event_id::VARCHAR AS _id, strftime(ts, '%Y-%m-%d') AS date, user_id || '+' || event_type AS fact_id,
      floor(value)::BIGINT AS "tweet.like_count" FROM events
    """,
)
def read_extended_json(spark, folder):
    path = scratch_path(spark, "dump")

    def oid(c):
        return F.struct(c.cast("string").alias("$oid"))

    Tables(spark, folder).events.select(
        oid(F.col("event_id")).alias("_id"),
        F.struct(times.day_text("ts").alias("$date")).alias("date"),
        F.array(oid(F.col("user_id")), oid(F.col("event_type"))).alias("fact_id"),
        F.struct(F.floor("value").alias("like_count")).alias("tweet"),
    ).write.json(path)
    read = readers.read_extended_json(spark, path, EXTENDED, multiline=False)
    return read.withColumn("fact_id", F.array_join("fact_id", "+"))


@query(
    "S13_write_json",
    "SELECT strftime(ts, '%Y-%m-%d') AS date, event_type AS feature, count(*) AS count FROM events GROUP BY 1, 2",
)
def write_json(spark, folder):
    path = scratch_path(spark, "counts")
    sinks.write_json(sinks.day_counts(Tables(spark, folder).dated, "feature"), path)
    return spark.read.schema("date string, feature string, count bigint").json(path)


@query(
    "S14_write_range_dump",
    f"""
    WITH {FEATURE_WORDS_SQL}, {TITLE_SQL}, c AS (SELECT doc_id AS fact_id FROM documents WHERE n_chars BETWEEN 1000 AND 2000),
    n AS (SELECT news_id, news_id % (SELECT count(*) FROM benchmark) AS fact_id, keywords_in_title FROM refiltered)
    SELECT 'claims' AS name, fact_id AS id FROM c
    UNION ALL SELECT DISTINCT 'messages', turn FROM conversations JOIN c ON fact_id = conv_id
    UNION ALL SELECT 'news', news_id FROM n WHERE keywords_in_title AND fact_id IN (FROM c)
    UNION ALL SELECT 'features', item_id FROM benchmark WHERE item_id IN (FROM c)
    """,
)
def write_range_dump(spark, folder):
    """Documents as claims whose size stands for a date, conversations as links."""
    from ..operators import joins

    t = Tables(spark, folder)
    claims = t.documents.select(F.col("doc_id").alias("fact_id"), F.col("n_chars").alias("date"))
    links = t.conversations.select(F.col("turn").alias("message_id"), F.col("conv_id").alias("fact_id"))
    messages = t.conversations.select(F.col("turn").alias("message_id")).distinct()
    news = joins.refilter_by_title(title_news(t), benchmark_features(t)).drop("Title")
    paths = sinks.write_range_dump(
        claims, links, messages, news, benchmark_features(t), 1000, 2000, scratch_path(spark, "range")
    )
    ids = {"claims": "fact_id", "messages": "message_id", "news": "news_id", "features": "fact_id"}
    out = None
    for name, key in ids.items():
        part = spark.read.schema(f"{key} bigint").json(paths[name]).select(F.lit(name).alias("name"), F.col(key).alias("id"))
        out = part if out is None else out.unionByName(part)
    return out


@query("S15_write_annotation_tasks", rf"WITH {ANNOTATION_SQL} SELECT _id, md5(text) AS text_md5 FROM tasks")
def write_annotation_tasks(spark, folder):
    path = scratch_path(spark, "tasks")
    sinks.write_annotation_tasks(annotated(Tables(spark, folder)), path)
    return readers.read_gold(spark, path).select("_id", F.md5("text").alias("text_md5"))


@query(
    "S16_write_tables",
    """
    SELECT 'types' AS name, event_type AS key, count(*) AS "Counts" FROM events GROUP BY 2
    UNION ALL SELECT 'users', user_id::VARCHAR, count(*) FROM events GROUP BY 2
    """,
)
def write_tables(spark, folder):
    events = Tables(spark, folder).events
    tables = {n: aggregates.value_counts(events, c) for n, c in (("types", "event_type"), ("users", "user_id"))}
    paths = sinks.write_tables(tables, scratch_path(spark, "tables"))
    parts = [
        spark.read.option("header", True).schema("key string, Counts bigint, Percentages double").csv(p).select(
            F.lit(n).alias("name"), "key", "Counts"
        )
        for n, p in paths.items()
    ]
    return parts[0].unionByName(parts[1])


@query(
    "S17_write_match_result",
    f"""
    WITH {PUBLICATIONS_SQL}, {REGISTRY_SQL}, v AS (SELECT ref, name, {VARIANTS_SQL} AS keys FROM publications),
    u AS (SELECT ref, unnest(keys) AS key FROM v), m AS (SELECT DISTINCT ref FROM u JOIN owner USING (key))
    SELECT 'matched' AS side, ref AS value FROM m
    UNION ALL SELECT DISTINCT 'unmatched', name FROM publications WHERE ref NOT IN (FROM m)
    """,
)
def write_match_result(spark, folder):
    from ..operators import joins
    from ..session import stored

    t = Tables(spark, folder)
    names = publications(t)
    matches = stored(joins.match_media(media_registry(t), names), "matches")
    matched, unmatched = sinks.write_match_result(names, matches, scratch_path(spark, "match"))
    rows = spark.read.schema("ref string, id string").csv(matched)
    return rows.select(F.lit("matched").alias("side"), F.col("ref").alias("value")).unionByName(
        spark.read.text(unmatched).select(F.lit("unmatched").alias("side"), "value")
    )


@query(
    "S18_rows_past_mark",
    """
    WITH m AS (SELECT conv_id, max(turn) AS mark FROM conversations WHERE role <> 'assistant' GROUP BY 1)
    SELECT conv_id, turn FROM conversations LEFT JOIN m USING (conv_id) WHERE mark IS NULL OR turn > mark
    """,
)
def rows_past_mark(spark, folder):
    rows = Tables(spark, folder).conversations
    state = rows.where(F.col("role") != "assistant")
    return readers.rows_past_mark(rows.select("conv_id", "turn"), state, "conv_id", "turn")


@query(
    "S19_read_gold",
    """
    SELECT doc_id || '_' || quality AS _id, CASE WHEN toxic = 1 THEN NULL WHEN quality = 1 THEN 'Es otro tema' ELSE 'Tweet ilegible' END AS label
    FROM labels
    """,
)
def read_gold(spark, folder):
    path = scratch_path(spark, "gold")
    label = F.when(F.col("quality") == 1, "Es otro tema").otherwise("Tweet ilegible")
    empty = F.array().cast("array<string>")
    Tables(spark, folder).labels.select(
        F.concat_ws("_", "doc_id", "quality").alias("_id"),
        F.when(F.col("toxic") == 1, empty).otherwise(F.array(label)).alias("accept"),
    ).write.json(path)
    return readers.read_gold(spark, path).select("_id", "label")


#: Depth of the comments of a page, over and over.
DEPTHS = [0, 1, 2, 2, 1, 0, 1, 1]
COMMENTS_SQL = f"""
    t AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS n FROM conversations),
    d AS (SELECT *, {DEPTHS}[n % {len(DEPTHS)} + 1] AS depth FROM t),
    comments AS (
      SELECT c.*, (SELECT max(p.n) FROM d p WHERE p.conv_id = c.conv_id AND p.n < c.n AND p.depth = c.depth - 1) AS above FROM d c
    )"""


def thread_pages(t: Tables):
    """Stored thread pages, one per conversation: its turns as nested comments."""
    by_turn = W.partitionBy("conv_id").orderBy("turn")
    depths = F.array(*map(F.lit, DEPTHS))
    turns = t.conversations.withColumn("n", F.row_number().over(by_turn) - 1)
    turns = turns.withColumn("depth", F.get(depths, F.col("n") % len(DEPTHS)))
    turns = turns.withColumns({"last": F.lag("depth").over(by_turn), "next": F.lead("depth").over(by_turn)})
    safe = F.replace(F.replace("text", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    closed = F.lit("</div>")
    comment = F.concat(
        F.when(F.col("n") == 0, F.lit("")).when(F.col("depth") > F.col("last"), F.lit('<div class="threader-childs">'))
        .otherwise(F.repeat(closed, 1 + 2 * (F.col("last") - F.col("depth")))),
        F.lit('\n<div class="threader zero">\n<div class="comment'), F.when(F.col("n") % 3 == 1, F.lit(" negative")).otherwise(F.lit("")),
        F.when(F.col("n") % 5 == 4, F.lit(" phantom")).otherwise(F.lit("")), F.lit('" data-id="comment-'), "conv_id", F.lit("x"), "n",
        F.lit('"><div class="comment-body"><div class="comment-header"><a class="comment-order" href="#">#'), F.col("n") + 1,
        F.lit('</a> <a class="username" href="/u">'), "role", F.lit('</a><span data-ts="'), F.lit(1_660_000_000) + F.col("conv_id") * 100 + F.col("n"),
        F.lit('" class="comment-date">x</span></div><div class="comment-text" id="c">'),
        F.when(F.col("depth") > 0, F.concat(F.lit('<a class="tooltip" href="#">#'), "n", F.lit("</a> "))).otherwise(F.lit("")), safe,
        F.lit('</div></div><div class="comment-footer"><span title="Votos"> '), F.col("n") * 2, F.lit('</span><span title="Karma">K '),
        F.col("n") * 7, F.lit("</span></div></div>"),
        F.when(F.col("next").isNull(), F.repeat(closed, 1 + 2 * F.col("depth"))).otherwise(F.lit("")),
    )
    ordered = F.array_sort(F.collect_list(F.struct("n", comment.alias("c"))))
    html = F.concat(F.lit('<html><body><div class="top"><div id="comments">'), F.array_join(F.transform(ordered, lambda x: x["c"]), ""), F.lit("</div></div></body></html>"))
    return turns.groupBy(F.col("conv_id").alias("page_id")).agg(html.alias("html"))


@query(
    "M9_comments_of_pages",
    f"""
    WITH {COMMENTS_SQL}
    SELECT conv_id AS page_id, conv_id || 'x' || n AS comment_id, conv_id || 'x' || above AS parent_id,
      row_number() OVER (PARTITION BY conv_id, above ORDER BY n) AS position, (n + 1)::INT AS internal_id, role AS author,
      1660000000 + conv_id * 100 + n AS created_epoch, CASE WHEN depth > 0 THEN n::VARCHAR ELSE '' END AS replies_to,
      md5(trim(text, e' \n\t')) AS text_md5, (n * 2)::INT AS votes, (n * 7)::INT AS karma, n % 3 = 1 AS negative, n % 5 = 4 AS hidden FROM comments
    """,
)
def comments_of_pages(spark, folder):
    found = readers.extract_comments(thread_pages(Tables(spark, folder)))
    found = found.withColumns({"replies_to": F.array_join(F.col("replies_to").cast("array<string>"), ","), "text_md5": F.md5("text")})
    return found.drop("at", "created_local", "text")


@query(
    "M9_comment_tree_of_pages",
    f"""
    WITH RECURSIVE {COMMENTS_SQL},
    tree AS (
      SELECT conv_id, n, above, n AS root, 0 AS deep FROM comments WHERE above IS NULL
      UNION ALL SELECT c.conv_id, c.n, c.above, root, deep + 1 FROM comments c JOIN tree USING (conv_id) WHERE c.above = tree.n
    ),
    r AS (SELECT conv_id, above AS n, count(*) AS replies FROM comments WHERE above IS NOT NULL GROUP BY ALL)
    SELECT conv_id || 'x' || n AS id, conv_id || 'x' || above AS parent, conv_id || 'x' || root AS root, deep AS depth,
      coalesce(replies, 0) AS replies FROM tree LEFT JOIN r USING (conv_id, n)
    """,
)
def comment_tree_of_pages(spark, folder):
    found = stored(readers.extract_comments(thread_pages(Tables(spark, folder))), "comments")
    return threads.thread_table(found, "comment_id", "parent_id")


"""Readers of landed files. Each declares its schema and stays lazy."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .. import schemas
from ..functions import text, times


def read_claims_repository(spark: SparkSession, path) -> DataFrame:
    raw = spark.read.schema(schemas.CLAIMS_REPOSITORY).json(path)
    return raw.withColumn("date", times.parse_iso_offset("createdAt"))


def read_claims_review(spark: SparkSession, path) -> DataFrame:
    """The review list holds one element; it is lifted to a struct."""
    raw = spark.read.schema(schemas.CLAIMS_REVIEW).json(path)
    lifted = raw.withColumn("claimReview", F.get("claimReview", F.lit(0)))
    return lifted.withColumn("date", times.parse_iso_offset("claimReview.reviewDate"))


def read_messages(spark: SparkSession, path) -> DataFrame:
    raw = spark.read.schema(schemas.MESSAGES).json(path)
    return raw.select(
        F.col("tweet.id").alias("tweet_id"),
        F.col("tweet.text").alias("text"),
        times.parse_cut_fraction("tweet.created_at").alias("date"),
        "fact_id",
        "tweet",
    )


def read_news(spark: SparkSession, path, multiline: bool = False) -> DataFrame:
    """One row per article of each search response, with the total hits kept."""
    raw = spark.read.schema(schemas.NEWS_RESPONSE).option("multiLine", multiline).json(path)
    article = raw.select("fact_id", F.col("total").alias("query_output"), F.explode("news").alias("n"))
    # the day-first text gives way to the parsed date, as names ignore case
    dated = article.withColumn("date", times.parse_day_first("n.Date"))
    return dated.select(F.col("n").dropFields("Date").alias("n"), "fact_id", "date", "query_output").select(
        "n.*", "fact_id", "date", "query_output"
    )


def read_press_xml(spark: SparkSession, path) -> DataFrame:
    raw = spark.read.format("xml").option("rowTag", "articulo").schema(schemas.PRESS_ARTICLE).load(path)
    return raw.select(
        F.col("head.IdDocument").alias("_id"),
        times.parse_year_first("head.DREDATE").alias("date"),
        F.col("head.Title").alias("headline"),
        F.col("body.DRECONTENT").alias("content"),
        F.col("head.Newspaper").alias("newspaper"),
        F.col("head.Subtitle").alias("subtitle"),
        F.col("head.Author").alias("author"),
        F.col("head.Page").alias("url"),
    )


def read_wire_xml(spark: SparkSession, path) -> DataFrame:
    raw = spark.read.format("xml").option("rowTag", "NewsItem").schema(schemas.WIRE_ITEM).load(path)
    return raw.select(
        F.col("Identification.NewsIdentifier.NewsItemId").alias("_id"),
        times.parse_day_first_time("Identification.DateLabel").alias("date"),
        F.col("NewsComponent.NewsLines.HeadLine").alias("headline"),
        F.col("NewsComponent.ContentItem.DataContent").alias("content"),
    )


def read_channels(spark: SparkSession, path) -> DataFrame:
    return spark.read.schema(schemas.CHANNELS).csv(path)


def read_chat_messages(spark: SparkSession, path) -> DataFrame:
    """Chat payloads: epoch seconds to UTC, missing views to 0, empty messages dropped."""
    raw = spark.read.schema(schemas.CHAT_MESSAGES).json(path)
    page = F.col("media.webpage.cachedPage")
    shaped = raw.select(
        F.col("id").alias("messageId"),
        "channelId",
        times.from_epoch("date").alias("date"),
        F.struct(
            F.col("replyTo.replyToMsgId").alias("reply_to_msg_id"),
            F.col("replyTo.replyToTopId").alias("reply_to_top_id"),
        ).alias("replyTo"),
        "message",
        "mentioned",
        "post",
        F.from_json("fromId", "map<string,string>").alias("sender"),
        F.coalesce("views", F.lit(0)).alias("views"),
        F.when(page.isNotNull(), F.struct(page["url"].alias("url"), page["blocks"].alias("blocks"))).alias(
            "instantCrawled"
        ),
    )
    return shaped.where(F.length("message") > 0)


def read_corpus(spark: SparkSession, paths) -> DataFrame:
    """One sentence per line."""
    return spark.read.text(paths).select(F.col("value").alias("sentence"))


def read_media_registry(spark: SparkSession, path) -> DataFrame:
    """Registry columns are known by position: 0 id, 1 name, 2 active, 3 url, 16 country."""
    raw = spark.read.option("header", True).option("multiLine", False).csv(path)
    at = raw.columns
    return raw.select(
        *[F.col(f"`{at[i]}`").alias(n) for i, n in ((0, "id"), (1, "name"), (2, "active"), (3, "url"), (16, "country"))]
    )


def read_publications(spark: SparkSession, path) -> DataFrame:
    return spark.read.schema(schemas.PUBLICATIONS).csv(path)


def flatten(df: DataFrame, separator: str = ".", only: str | None = None) -> DataFrame:
    """Nested structs to dotted columns, in one projection.

    With `only`, just that column is opened and its fields take it as prefix.
    """

    def leaves(path: list[str], kind: T.DataType):
        if isinstance(kind, T.StructType):
            for field in kind.fields:
                yield from leaves([*path, field.name], field.dataType)
        else:
            yield path

    joint = "_" if only else separator
    picked = []
    for field in df.schema.fields:
        if only and field.name != only:
            picked.append(F.col(f"`{field.name}`"))
            continue
        for path in leaves([field.name], field.dataType):
            quoted = ".".join(f"`{p}`" for p in path)
            picked.append(F.col(quoted).alias(joint.join(path)))
    return df.select(*picked)


def read_extended_json(spark: SparkSession, path, schema, multiline: bool = True) -> DataFrame:
    """Database dump with `$oid` / `$date` wrappers, flattened to plain names."""
    raw = spark.read.schema(schema).option("multiLine", multiline).json(path)
    flat = flatten(raw)
    names = {c: c.removesuffix(".$oid").removesuffix(".$date") for c in flat.columns}
    flat = flat.withColumnsRenamed({k: v for k, v in names.items() if k != v})
    unwrapped = []
    for field in flat.schema.fields:
        c = F.col(f"`{field.name}`")
        element = getattr(field.dataType, "elementType", None)
        if isinstance(element, T.StructType) and element.fieldNames() == ["$oid"]:
            c = F.transform(c, lambda x: x["$oid"])
        unwrapped.append(c.alias(field.name))
    return flat.select(*unwrapped)


def read_gold(spark: SparkSession, path) -> DataFrame:
    """Annotated pairs; the first accepted label counts, unannotated rows keep null."""
    raw = spark.read.schema(schemas.GOLD).json(path)
    return raw.withColumn("label", F.get("accept", F.lit(0)))


def rows_past_mark(df: DataFrame, state: DataFrame, channel: str, row_id: str) -> DataFrame:
    """Rows above the stored high-water mark of their channel.

    `state` holds earlier rows or marks (channel, id); its marks come from a
    partial maximum, so a busy channel adds one row per task to the shuffle.
    """
    marks = state.groupBy(channel).agg(F.max(row_id).alias("_mark"))
    joined = df.join(marks, channel, "left")
    return joined.where(F.col("_mark").isNull() | (F.col(row_id) > F.col("_mark"))).drop("_mark")


def extract_posts(pages: DataFrame, html: str = "html") -> DataFrame:
    """Post rows out of stored list pages, one page per input row."""
    block = F.explode(F.slice(F.split(html, r'(?=<div[^>]*class="[^"]*\bnews-summary\b)', -1), 2, 1 << 30))
    blocks = pages.select("page_id", block.alias("b"))

    def inside(marker: str) -> F.Column:
        body = F.regexp_extract("b", rf'(?s)class="[^"]*\b{marker}\b[^"]*"[^>]*>(.*?)</(?:a|span|div)>', 1)
        return F.btrim(text.strip_html(body), F.lit(" \n\t"))

    def attribute(name: str) -> F.Column:
        value = F.regexp_extract("b", rf'\s{name}="([^"]*)"', 1)
        return F.when(value != "", F.btrim(value))

    def of_tag(tag: str, name: str) -> F.Column:
        value = F.regexp_extract(F.regexp_extract("b", tag, 0), rf'\s{name}="([^"]*)"[^>]*>$', 1)
        return F.when(value != "", F.btrim(text.strip_html(value)))

    stamp = attribute("data-ts")
    return blocks.select(
        "page_id",
        attribute("data-link-id").alias("post_id"),
        text.parse_count(F.regexp_extract("b", r'(?s)class="votes"[^>]*>\s*<a[^>]*>([^<]*)<', 1)).alias("votes"),
        text.parse_count(inside("clics"), "clics").alias("clicks"),
        inside("subname").alias("category"),
        F.when(stamp.isNotNull(), stamp.try_cast("bigint")).alias("created_epoch"),
        times.from_epoch(stamp.try_cast("bigint"), "Europe/Madrid").alias("created_local"),
        F.col("b").rlike(r'<div[^>]*class="[^"]*\bwarn\b').alias("controversy"),
        text.parse_count(inside("positive-vote-number")).alias("positive_votes"),
        text.parse_count(inside("negative-vote-number")).alias("negative_votes"),
        text.parse_count(attribute("data-comments-number")).alias("number_comments"),
        of_tag(r'<a\s[^>]*class="[^"]*\bcomments\b[^>]*>', "href").alias("url"),
        of_tag(r'<a\s[^>]*title="miniatura"[^>]*>\s*<img\s[^>]*>', "src").alias("image_url"),
        of_tag(r'<span\s[^>]*class="[^"]*\bshowmytitle\b[^>]*>', "title").alias("article_url"),
    )


# Fixed values of a stored comment page: classes, titles and prefixes of its markup.
THREAD, COMMENT = "threader", "comment"
BODY, ORDER, AUTHOR, STAMP, MENTION = "comment-text", "comment-order", "username", "comment-date", "tooltip"
VOTES, KARMA = "Votos", "Karma"
NEGATIVE, HIDDEN = "negative", "phantom"
#: A comment stands so many `div` deeper than the comment it answers.
NESTED = 2


def _classed(tag: str, name: str) -> str:
    """Pattern of an opening tag with a class of that whole name."""
    return rf'<{tag}\b[^>]*\bclass="(?:[^"]*\s)?{name}(?:\s[^"]*)?"[^>]*>'


def extract_comments(pages: DataFrame, html: str = "html") -> DataFrame:
    """Comments of stored thread pages with the one they answer, in the order of the page.

    Result: page_id, comment_id, parent_id (null at the top), at (place on the
    page), position (place among the answers to one comment), internal_id,
    author, created_epoch, created_local, replies_to, text, votes, karma,
    negative, hidden.

    A page is cut where comments open. The depth of `div` there, summed over the
    page, tells which comment is answered: the last one NESTED levels higher
    whose thread has not been closed since. Comments without an id are left out,
    their answers stand at the top; comments outside a thread are left out.
    Null pages and pages without comments give no rows.
    """
    opening = _classed("div", COMMENT)
    cut = F.split(html, f"(?={opening})", -1)
    thread = rf"{_classed('div', THREAD)}\s*$"
    part = F.transform(cut, lambda b, i: F.struct(i.alias("at"), b.alias("b"), F.get(cut, i - 1).rlike(thread).alias("threaded")))
    parts = pages.select("page_id", part.alias("p"))
    blocks = parts.select("page_id", F.explode("p").alias("p")).select("page_id", "p.*")

    # net depth of a block, and the lowest depth in it
    ends = F.regexp_extract_all("b", F.lit(r"(?i)<(/?)div\b"), F.lit(1))
    start = F.struct(F.lit(0).alias("net"), F.lit(0).alias("low"))

    def moved(state: F.Column, slash: F.Column) -> F.Column:
        net = state["net"] + F.when(slash == "/", -1).otherwise(1)
        return F.struct(net.alias("net"), F.least(state["low"], net).alias("low"))

    measured = blocks.withColumn("d", F.aggregate(ends, start, moved))
    earlier = Window.partitionBy("page_id").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    placed = measured.withColumn("base", F.coalesce(F.sum("d.net").over(earlier), F.lit(0)))
    found = placed.where(F.col("at") > 0).withColumns({"level": F.col("base") + 1, "low": F.col("base") + F.col("d.low")})

    first = F.regexp_extract("b", rf"^{opening}", 0)
    identity = F.regexp_extract(first, r'\bdata-id="(?:comment-)?([^"]*)"', 1)
    named = found.withColumn("comment_id", F.when(identity != "", identity))

    # three kinds of events on the level of an answer: it opens; one it can belong to has opened, or was closed
    def event(kind: int, level: F.Column) -> F.Column:
        return F.struct(F.lit(kind).alias("kind"), level.alias("level"))

    highest = F.col("level") + NESTED
    levels = F.when(F.col("low") < F.col("level") - 1, F.sequence(F.col("low") + NESTED + 2, highest)).otherwise(F.array().cast("array<int>"))
    own = F.array(event(0, F.col("level").cast("int")), event(1, highest.cast("int")))
    events = F.concat(own, F.transform(levels.cast("array<int>"), lambda x: event(2, x)))
    kept = F.when(F.col("e.kind") == 0, F.col("b")).alias("b")
    spread = named.select("page_id", "at", "comment_id", "b", "threaded", F.explode(events).alias("e"))
    spread = spread.select("page_id", "at", "comment_id", kept, "threaded", "e.*")
    so_far = Window.partitionBy("page_id", "level").orderBy("at", "kind")
    id_above = F.when(F.col("kind") > 0, F.struct(F.when(F.col("kind") == 1, F.col("comment_id")).alias("id")))
    rows = spread.withColumn("above", F.last(id_above, ignorenulls=True).over(so_far)).where("kind = 0 AND threaded AND comment_id IS NOT NULL")
    rows = rows.withColumn("parent_id", F.col("above.id"))

    inner = F.regexp_extract("b", rf"(?s){_classed('div', BODY)}(.*?)</div>", 1)
    mention = rf"(?s){_classed('a', MENTION)}(.*?)</a>"

    def inside(pattern: str) -> F.Column:
        value = F.btrim(text.strip_html(F.regexp_extract("b", pattern, 1)), F.lit(" \n\t"))
        return F.when(value != "", value)

    stamp = F.regexp_extract(F.regexp_extract("b", _classed("span", STAMP), 0), r'\bdata-ts="(\d+)"', 1).try_cast("bigint")
    numbers = F.transform(F.regexp_extract_all(inner, F.lit(mention), F.lit(1)), lambda m: F.replace(m, F.lit("#"), F.lit("")).try_cast("int"))
    siblings = Window.partitionBy("page_id", "parent_id").orderBy("at")
    return rows.select(
        "page_id",
        "comment_id",
        "parent_id",
        "at",
        F.row_number().over(siblings).alias("position"),
        F.replace(inside(rf"(?s){_classed('a', ORDER)}(.*?)</a>"), F.lit("#"), F.lit("")).try_cast("int").alias("internal_id"),
        inside(rf"(?s){_classed('a', AUTHOR)}(.*?)</a>").alias("author"),
        stamp.alias("created_epoch"),
        times.from_epoch(stamp, "Europe/Madrid").alias("created_local"),
        numbers.alias("replies_to"),
        F.btrim(text.strip_html(F.regexp_replace(inner, mention, "")), F.lit(" \n\t")).alias("text"),
        inside(rf'(?s)<span[^>]*\btitle="{VOTES}"[^>]*>(.*?)</span>').try_cast("int").alias("votes"),
        F.replace(inside(rf'(?s)<span[^>]*\btitle="{KARMA}"[^>]*>(.*?)</span>'), F.lit("K "), F.lit("")).try_cast("int").alias("karma"),
        F.contains(first, F.lit(NEGATIVE)).alias("negative"),
        F.contains(first, F.lit(HIDDEN)).alias("hidden"),
    )

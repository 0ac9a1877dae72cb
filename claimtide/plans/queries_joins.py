"""Joins and keyword search."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text, times
from ..operators import aggregates, index, joins, keywords, search
from ..plans import daily
from ..session import scratch_path
from ..sources import sinks
from .catalog import CHECKED_SQL, OFFSET_SQL, Tables, query
from .queries_functions import PUBLICATIONS_SQL, ROUNDS_SQL, TAGGED_SQL, VARIANTS_SQL, annotated, publications, tagged
from .queries_rows import TOKENS_SQL


@query(
    "J1_unprocessed",
    "SELECT o_orderkey AS fact_id FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'A')",
)
def unprocessed(spark, folder):
    t = Tables(spark, folder)
    done = t.lineitem.where(F.col("l_returnflag") == "A").select(F.col("l_orderkey").alias("fact_id"))
    return joins.unprocessed(t.claims, done).select("fact_id")


def listed_messages(t: Tables):
    """Documents whose claim list is their words, of which some name a claim."""
    return t.documents.select(
        F.col("doc_id").alias("tweet_id"), "lang", F.array_distinct(text.corpus_tokens("text")).alias("fact_id")
    )


LISTED_SQL = rf"""
    links AS (SELECT doc_id AS message_id, lang, unnest(list_distinct({TOKENS_SQL.format("text")})) AS fact_id FROM documents),
    claims AS (SELECT DISTINCT unnest({TOKENS_SQL.format('text')}) AS fact_id FROM benchmark)
"""


def word_claims(t: Tables):
    return t.benchmark.select(F.explode(text.corpus_tokens("text")).alias("fact_id")).distinct()


@query("J2_messages_of_claims", f"WITH {LISTED_SQL} SELECT message_id, fact_id, lang FROM links JOIN claims USING (fact_id)")
def messages_of_claims(spark, folder):
    t = Tables(spark, folder)
    return joins.messages_of_claims(listed_messages(t), word_claims(t))


@query(
    "J3_attach_claim_attributes",
    """
    SELECT l_orderkey AS fact_id, l_linenumber, l_partkey, strftime(l_shipdate, '%Y-%m-%d') AS date,
      strftime(o_orderdate, '%Y-%m-%d') AS date_fact_check, o_orderpriority AS reviewer
    FROM lineitem LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'F') ON l_orderkey = o_orderkey
    """,
)
def attach(spark, folder):
    t = Tables(spark, folder)
    claims = t.claims.where(F.col("calification") == "F").withColumn("date", times.day_text("date"))
    messages = t.lineitem.select(
        F.col("l_orderkey").alias("fact_id"), "l_linenumber", "l_partkey", times.day_text("l_shipdate").alias("date")
    )
    return joins.attach_claim_attributes(messages, claims, ["date", "reviewer"])


@query(
    "J4_restrict_to_claims",
    """
    SELECT l_orderkey AS fact_id, l_linenumber, l_partkey FROM lineitem
    WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderdate BETWEEN '1998-03-08' AND '1998-04-08')
    """,
)
def restrict(spark, folder):
    t = Tables(spark, folder)
    ids = t.claims.where(F.col("date").between("1998-03-08", "1998-04-08"))
    rows = t.lineitem.select(F.col("l_orderkey").alias("fact_id"), "l_linenumber", "l_partkey")
    return joins.restrict_to_claims(rows, ids)


@query(
    "J5_messages_near_claim",
    """
    WITH c AS (SELECT user_id, min(ts) AS claim_date FROM events WHERE event_type = 'error' GROUP BY 1)
    SELECT e.event_id AS message_id, c.user_id AS fact_id
    FROM events e JOIN c USING (user_id) WHERE e.ts > c.claim_date - INTERVAL 2 DAY AND e.ts < c.claim_date + INTERVAL 2 DAY
    """,
)
def near_claim(spark, folder):
    dated = Tables(spark, folder).dated
    claims = dated.where(F.col("feature") == "error").groupBy("fact_id").agg(F.min("date").alias("claim_date"))
    links = dated.select("message_id", "fact_id")
    near = joins.messages_near_claim(dated.select("message_id", "date"), claims, 2, links=links)
    return near.select("message_id", "fact_id")


def benchmark_features(t: Tables):
    claims = t.benchmark.select(F.col("item_id").alias("fact_id"), F.col("text").alias("claim"))
    return daily.simple_keywords(claims)


def document_messages(t: Tables):
    return t.documents.select(F.col("doc_id").alias("message_id"), "text", "lang", "source")


FEATURE_WORDS_SQL = f"""
    kw AS (SELECT item_id AS fact_id, text AS claim, list_sort(list_distinct(list_filter({TOKENS_SQL.format('text')},
             lambda x: length(x) > 5))) AS keywords FROM benchmark),
    words AS (SELECT doc_id AS message_id, unnest(list_distinct({TOKENS_SQL.format('text')})) AS word FROM documents)
"""


@query(
    "J6_keyword_search",
    f"""
    WITH {FEATURE_WORDS_SQL}, k AS (SELECT fact_id, unnest(list_filter(keywords, lambda x: x NOT IN ('and', 'or'))) AS word FROM kw)
    SELECT fact_id, message_id, count(*) AS matched FROM k JOIN words USING (word) GROUP BY 1, 2 HAVING count(*) >= 3
    """,
)
def keyword_search(spark, folder):
    t = Tables(spark, folder)
    words = search.token_table(document_messages(t), text.corpus_tokens("text"))
    return search.keyword_search(benchmark_features(t), words)


@query(
    "J6_keyword_search_pairs",
    f"""
    WITH {FEATURE_WORDS_SQL}, k AS (SELECT fact_id, unnest(list_filter(keywords, lambda x: x NOT IN ('and', 'or'))) AS word FROM kw)
    SELECT fact_id, message_id, count(*) AS matched FROM k JOIN words USING (word) GROUP BY 1, 2 HAVING count(*) >= 2
    """,
)
def keyword_search_pairs(spark, folder):
    t = Tables(spark, folder)
    words = search.token_table(document_messages(t), text.corpus_tokens("text"))
    return search.keyword_search(benchmark_features(t), words, need=2)


@query(
    "J6_group_search_restrictive",
    f"""
    WITH {FEATURE_WORDS_SQL}, g AS (
      SELECT fact_id, CASE WHEN i = 0 THEN keywords[1:2] ELSE keywords[2 * i - 1:2 * i + 2] END AS g
      FROM (SELECT fact_id, keywords, unnest(range((len(keywords) + 1) // 2)) AS i FROM kw)),
    w AS (SELECT fact_id, g, unnest(g) AS word FROM g)
    SELECT DISTINCT fact_id, message_id FROM (
      SELECT fact_id, g, message_id FROM w JOIN words USING (word) GROUP BY 1, 2, 3 HAVING count(*) = len(g))
    """,
)
def group_search(spark, folder):
    """Pairs (1,2), (3,4) and so on; each later one joined with the one before."""
    t = Tables(spark, folder)
    words = search.token_table(document_messages(t), text.corpus_tokens("text"))
    firsts = F.filter(F.transform("keywords", lambda _, i: i + 1), lambda i: i % 2 == 1)
    pairs = F.transform(firsts, lambda i: F.slice("keywords", i, 2))
    features = benchmark_features(t).withColumn("pairs", pairs)
    groups = features.withColumn("groups", search.keyword_groups("keywords", F.col("pairs"), "restrictive"))
    return search.group_search(groups, words)


@query(
    "J6_keyword_search_in_window",
    rf"""
    WITH {FEATURE_WORDS_SQL}, a AS (SELECT fact_id, list_filter(keywords, lambda x: x NOT IN ('and', 'or')) AS asked FROM kw),
    k AS (SELECT fact_id, len(asked) AS n, unnest(asked) AS word FROM a)
    SELECT fact_id, message_id, count(*) AS matched FROM k JOIN words USING (word)
      JOIN events c ON c.event_id = fact_id JOIN events m ON m.event_id = message_id
    WHERE m.ts::DATE BETWEEN c.ts::DATE - 7 AND c.ts::DATE + 7
    GROUP BY 1, 2 HAVING count(*) >= least(3, any_value(n))
    """,
)
def keyword_search_in_window(spark, folder):
    """Claims and documents take the dates of the events with their ids."""
    t = Tables(spark, folder)

    def dated(df, id_: str, name: str):
        return df.join(t.events.select(F.col("event_id").alias(id_), F.col("ts").alias(name)), id_, "left")

    messages = dated(document_messages(t), "message_id", "date")
    words = search.token_table(messages, text.corpus_tokens("text"))
    return search.keyword_search(dated(benchmark_features(t), "fact_id", "claim_date"), words, short="all", days=(7, 7))


# Phrases of two and three words in turn, over the whole claim.
PHRASES_SQL = rf"""
    kw AS (SELECT item_id AS fact_id, {TOKENS_SQL.format('text')} AS t FROM benchmark),
    f AS (SELECT fact_id, list_distinct(list_concat(
        list_transform(range(1, len(t), 5), lambda i: t[i] || ' ' || t[i + 1]),
        list_transform(range(1, len(t) - 3, 5), lambda i: t[i + 2] || ' ' || t[i + 3] || ' ' || t[i + 4]))) AS keywords FROM kw),
    m AS (SELECT doc_id AS message_id, ' ' || array_to_string({TOKENS_SQL.format('text')}, ' ') || ' ' AS text FROM documents),
    s AS (SELECT fact_id, message_id, len(list_filter(keywords, lambda k: contains(text, ' ' || k || ' '))) AS matched FROM f, m)
"""


def claim_phrases(t: Tables):
    tokens = t.benchmark.select(F.col("item_id").alias("fact_id"), text.corpus_tokens("text").alias("t"))

    def every_fifth(first: int, words: int):
        starts = F.filter(F.transform("t", lambda _, i: i + 1), lambda i: (i % 5 == 1) & (i + first + words - 2 <= F.size("t")))
        return F.transform(starts, lambda i: F.array_join(F.slice("t", i + first - 1, words), " "))

    return tokens.select("fact_id", F.concat(every_fifth(1, 2), every_fifth(3, 3)).alias("keywords"))


@query("J6_phrase_search", f"WITH {PHRASES_SQL} SELECT * FROM s WHERE matched >= 2")
def phrase_search(spark, folder):
    t = Tables(spark, folder)
    normal = F.array_join(text.corpus_tokens("text"), " ")
    found = search.claim_search(claim_phrases(t), document_messages(t), text.corpus_tokens("text"), normal, need=2)
    return found.withColumn("matched", F.col("matched").cast("bigint"))


@query(
    "J6_phrase_index",
    f"""
    WITH {PHRASES_SQL}, d AS (SELECT fact_id, message_id, matched FROM s
      WHERE (DATE '2024-01-01' + (message_id % 37)::INT) BETWEEN DATE '2024-01-01' + (fact_id % 31)::INT - 7 AND DATE '2024-01-01' + (fact_id % 31)::INT + 7)
    SELECT 'two' AS search, * FROM s WHERE matched >= 2 UNION ALL SELECT 'three' AS search, * FROM s WHERE matched >= 3
    UNION ALL SELECT 'window' AS search, * FROM d WHERE matched >= 2
    """,
)
def phrase_index(spark, folder):
    """An index of two days' messages, each taken in twice, asked three times."""
    t = Tables(spark, folder)
    first = F.lit("2024-01-01").cast("date")
    messages = document_messages(t).withColumn("date", F.date_add(first, (F.col("message_id") % 37).cast("int")))
    built = index.PhraseIndex(spark, scratch_path(spark, "index"))
    for run in ("even", "odd", "odd"):
        built.add(run, messages.where(F.col("message_id") % 2 == int(run == "odd")), text.corpus_tokens("text"))
    claims = claim_phrases(t).withColumn("claim_date", F.date_add(first, (F.col("fact_id") % 31).cast("int")))
    found = {"two": built.search(claims, 2), "three": built.search(claims, 3), "window": built.search(claims, 2, days=(7, 7))}
    out = [rows.withColumn("search", F.lit(name)) for name, rows in found.items()]
    return out[0].unionByName(out[1]).unionByName(out[2])


REGISTRY_SQL = """
    registry AS (SELECT p_partkey AS id, p_partkey AS row_no, p_name || ' ' || p_type AS name,
      'https://www.' || replace(p_name, ' ', '') || '.es/' AS url FROM part WHERE p_size > 10),
    keys AS (SELECT id, row_no, unnest([lower(name), replace(regexp_replace(url, '^https?://[w.]{0,4}', ''), '/', ''),
        split_part(replace(regexp_replace(url, '^https?://[w.]{0,4}', ''), '/', ''), '.', 1), strip_accents(lower(name)),
        replace(strip_accents(lower(name)), ' ', '')]) AS key FROM registry),
    owner AS (SELECT key, arg_max(id, row_no) AS id FROM keys GROUP BY 1)
"""


def media_registry(t: Tables):
    return t.part.where(F.col("p_size") > 10).select(
        F.col("p_partkey").alias("id"),
        F.col("p_partkey").alias("row_no"),
        F.concat_ws(" ", "p_name", "p_type").alias("name"),
        F.concat(F.lit("https://www."), F.replace("p_name", F.lit(" "), F.lit("")), F.lit(".es/")).alias("url"),
    )


@query(
    "J7_match_media",
    f"""
    WITH {PUBLICATIONS_SQL}, {REGISTRY_SQL},
    v AS (SELECT ref, name, {VARIANTS_SQL} AS keys FROM publications),
    u AS (SELECT ref, name, unnest(keys) AS key, unnest(range(len(keys))) AS rule FROM v)
    SELECT ref, arg_max(name, rule) AS name, arg_max(id, rule) AS id, max(rule)::INT AS rule FROM u JOIN owner USING (key) GROUP BY 1
    """,
)
def match_media(spark, folder):
    t = Tables(spark, folder)
    return joins.match_media(media_registry(t), publications(t))


def title_news(t: Tables):
    """Documents as news of the claims in turn."""
    claims = t.benchmark.agg(F.count("*")).scalar()
    return t.documents.select(
        F.col("doc_id").alias("news_id"), (F.col("doc_id") % claims).alias("fact_id"), F.col("text").alias("Title")
    )


TITLE_SQL = rf"""
    refiltered AS (
      SELECT doc_id AS news_id, coalesce(len(list_intersect(
        regexp_extract_all(text, '[\p{{L}}\p{{N}}]+(?:[-''.][\p{{L}}\p{{N}}]+)*'), keywords)) > 0, false) AS keywords_in_title
      FROM documents LEFT JOIN kw ON fact_id = doc_id % (SELECT count(*) FROM benchmark))
"""


@query("J8_refilter_by_title", f"WITH {FEATURE_WORDS_SQL}, {TITLE_SQL} SELECT news_id, keywords_in_title FROM refiltered")
def refilter(spark, folder):
    t = Tables(spark, folder)
    return joins.refilter_by_title(title_news(t), benchmark_features(t)).select("news_id", "keywords_in_title")


@query("P17_titled_hits", f"WITH {FEATURE_WORDS_SQL}, {TITLE_SQL} SELECT news_id FROM refiltered WHERE keywords_in_title")
def titled_hits(spark, folder):
    from ..operators import filters

    t = Tables(spark, folder)
    return filters.titled_hits(joins.refilter_by_title(title_news(t), benchmark_features(t))).select("news_id")


@query(
    "J9_annotation_pairs",
    f"""
    WITH {FEATURE_WORDS_SQL}, k AS (SELECT fact_id, unnest(list_filter(keywords, lambda x: x NOT IN ('and', 'or'))) AS word FROM kw),
    hits AS (SELECT fact_id, message_id FROM k JOIN words USING (word) GROUP BY 1, 2 HAVING count(*) >= 2),
    r AS (SELECT *, row_number() OVER (PARTITION BY fact_id ORDER BY md5('2023:' || message_id), message_id) AS n FROM hits)
    SELECT message_id || '_' || fact_id AS _id, md5(e'***CLAIM***:\\n ' || claim || e' \\n ***FACT-CHECK***: \\n ' || lang
      || e' \\n\\n ***TWEET***: \\n ' || text) AS text_md5
    FROM r JOIN kw USING (fact_id) JOIN documents ON doc_id = message_id WHERE n <= 20
    """,
)
def annotation_pairs(spark, folder):
    from ..operators import keyed

    t = Tables(spark, folder)
    messages = document_messages(t)
    features = benchmark_features(t)
    words = search.token_table(messages, text.corpus_tokens("text"))
    hits = search.keyword_search(features, words, need=2)
    picked = keyed.sample_per_key(hits.select("fact_id", "message_id"), ["fact_id"], ["message_id"], 20, 2023)
    pairs = picked.join(features.select("fact_id", "claim"), "fact_id").join(messages, "message_id")
    pairs = pairs.withColumns({"review": F.col("lang"), "title": F.lit(None), "content": F.lit(None)})
    return sinks.annotation_tasks(pairs).select("_id", F.md5("text").alias("text_md5"))


@query("J10_without_annotated", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def without_annotated(spark, folder):
    t = Tables(spark, folder)
    return joins.without_ids(t.documents, t.labels, "doc_id").select("doc_id")


@query(
    "J11_topic_tables_side_by_side",
    """
    SELECT source, labelled, toxic FROM
      (SELECT source, count(*) AS labelled FROM documents JOIN labels USING (doc_id) GROUP BY 1)
      JOIN (SELECT source, count(*) AS toxic FROM documents JOIN labels USING (doc_id) WHERE toxic = 1 GROUP BY 1) USING (source)
    """,
)
def side_by_side(spark, folder):
    t = Tables(spark, folder)
    labelled = t.documents.join(t.labels.withColumnRenamed("toxic", "is_toxic"), "doc_id")
    a = labelled.groupBy("source").agg(F.count("*").alias("labelled"))
    b = labelled.where(F.col("is_toxic") == 1).groupBy("source").agg(F.count("*").alias("toxic"))
    return joins.side_by_side(a, b, "source")


@query(
    "J12_two_source_counts",
    """
    SELECT coalesce(a.k, b.k) AS fact_id, coalesce(a.n, 0) AS count_messages, coalesce(b.n, 0) AS count_articles FROM
      (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) a FULL JOIN
      (SELECT user_id AS k, count(*) AS n FROM events GROUP BY 1) b ON a.k = b.k
    """,
)
def two_source_counts(spark, folder):
    t = Tables(spark, folder)
    orders = t.orders.where(F.col("o_orderstatus") == "F").select(F.col("o_custkey").alias("fact_id"))
    return joins.two_source_counts(orders, t.dated, "fact_id", "count_messages", "count_articles")


BEFORE_AFTER_SQL = f"""
    {CHECKED_SQL}, {OFFSET_SQL},
    sides AS (SELECT fact_id, count(*) FILTER (WHERE hour_offset < 0) AS before, count(*) FILTER (WHERE hour_offset >= 0) AS after
              FROM offsets GROUP BY 1)
"""


def with_offsets(t: Tables):
    return t.checked.withColumns(
        {
            "hour_offset": times.hour_offset("date", "checked_at"),
            "day_offset": times.day_offset("date", "checked_at").cast("bigint"),
        }
    )


@query("J13_before_after", f"WITH {BEFORE_AFTER_SQL} SELECT * FROM sides")
def before_after(spark, folder):
    return joins.before_after(with_offsets(Tables(spark, folder)), "hour_offset")


@query("J14_paired_claims", f"WITH {BEFORE_AFTER_SQL} SELECT * FROM sides WHERE before > 0 AND after > 0")
def paired(spark, folder):
    return joins.paired(joins.before_after(with_offsets(Tables(spark, folder)), "hour_offset"))


@query(
    "J15_gold_and_predicted",
    """
    SELECT doc_id::VARCHAR AS message_id, CASE WHEN quality = 1 THEN 'on-topic' ELSE 'off-topic' END AS gold,
      CASE WHEN n_chars > 1000 THEN 'on-topic' ELSE 'off-topic' END AS predicted
    FROM labels JOIN documents USING (doc_id)
    """,
)
def gold_and_predicted(spark, folder):
    from ..functions import labels as lb
    from ..operators import scoring

    gold, predicted = gold_tables(Tables(spark, folder))
    return scoring.gold_and_predicted(gold, predicted, "topic_relation", lb.TOPIC_OF_LABEL)


def gold_tables(t: Tables):
    """labels as annotations; documents over 1000 characters predicted on topic and on claim."""
    from .queries_functions import spanish_labels

    labelled = spanish_labels(t).withColumn(
        "label", F.when(F.col("quality") == 1, F.col("label")).otherwise("Es otro tema")
    )
    gold = labelled.select(F.concat("doc_id", F.lit("_claim")).alias("_id"), "label")
    long_text = F.col("n_chars") > 1000
    predicted = t.documents.select(
        F.col("doc_id").alias("message_id"),
        F.when(long_text, "on-topic").otherwise("off-topic").alias("topic_relation"),
        F.when(long_text, "on-claim").otherwise("off-claim").alias("claim_relation"),
        F.when(F.col("lang") == "en", F.when(long_text, "disseminates").otherwise("not-disseminates")).alias(
            "claim_finer_relation"
        ),
    )
    return gold, predicted


def chat(t: Tables):
    """conversations as chat: each turn answers the first turn of its conversation."""
    return t.conversations.select(
        F.col("conv_id").alias("channel"),
        F.col("turn").alias("message_id"),
        F.when(F.col("turn") > 0, F.lit(0).cast("bigint")).alias("reply_to"),
        "role",
        "text",
    )


@query(
    "J16_replies_of_message",
    """
    SELECT conv_id AS channel, 0::BIGINT AS top_id, turn AS message_id, role FROM conversations
    WHERE turn > 0 AND conv_id IN (SELECT conv_id FROM conversations WHERE turn = 0)
    """,
)
def replies(spark, folder):
    from ..operators import threads

    return threads.replies_of(chat(Tables(spark, folder))).drop("text")


LINES_SQL = r"lines AS (SELECT doc_id, unnest(string_split(text, e'\n')) AS sentence FROM documents)"
COOC_SQL = rf"""
    {LINES_SQL},
    toks AS (SELECT row_number() OVER () AS id, {TOKENS_SQL.format('sentence')} AS t FROM lines),
    flat AS (SELECT id, unnest(t) AS a, unnest(range(len(t))) AS i FROM toks),
    near AS (SELECT least(x.a, y.a) AS w1, greatest(x.a, y.a) AS w2 FROM flat x JOIN flat y ON x.id = y.id AND y.i IN (x.i + 1, x.i + 2)),
    cooc AS (SELECT w1, w2, count(*) AS counts FROM near GROUP BY 1, 2 HAVING count(*) > 10)
"""


def sentences(t: Tables):
    # outer, since the plain form adds a filter that would cut the text once more
    return t.documents.select(F.explode_outer(F.split("text", "\n")).alias("sentence")).where(F.col("sentence").isNotNull())


@query("A22_cooccurrence", f"WITH {COOC_SQL} SELECT w1, w2, counts FROM cooc")
def cooccurrence(spark, folder):
    return aggregates.cooccurrence(sentences(Tables(spark, folder)))


@query(
    "J17_rare_pairs",
    rf"""
    WITH {COOC_SQL},
    {TAGGED_SQL}, k0 AS (SELECT *, list_distinct(list_concat(ner_claim, ner_review)) AS k FROM tagged), {ROUNDS_SQL},
    k AS (SELECT fact_id, unnest(list_filter(k, lambda x: length(x) > 1)) AS w FROM k6),
    p AS (SELECT x.fact_id, x.w AS a, y.w AS b FROM k x JOIN k y ON x.fact_id = y.fact_id AND x.w < y.w)
    SELECT fact_id, a, b FROM p WHERE NOT EXISTS (SELECT 1 FROM cooc
      WHERE w1 = least(lower(a), lower(b)) AND w2 = greatest(lower(a), lower(b)) AND counts > 30)
    """,
)
def rare_pairs(spark, folder):
    t = Tables(spark, folder)
    features = keywords.select_keywords(tagged(t))
    return aggregates.rare_pairs(keywords.keyword_pairs(features), aggregates.cooccurrence(sentences(t)))


@query(
    "J18_with_group_size",
    "SELECT event_id AS message_id, user_id AS fact_id, count(*) OVER (PARTITION BY user_id) AS counts FROM events",
)
def with_group_size(spark, folder):
    dated = Tables(spark, folder).dated.select("message_id", "fact_id")
    return joins.with_group_size(dated, "fact_id")


@query(
    "J19_apply_corrections",
    """
    SELECT event_id, event_type = 'view' OR user_id IN (SELECT user_id FROM events WHERE value > 60) AS controversy FROM events
    """,
)
def corrections(spark, folder):
    events = Tables(spark, folder).events
    base = events.select("event_id", "user_id", (F.col("event_type") == "view").alias("controversy"))
    updates = events.select("user_id", (F.col("value") > 60).alias("controversy"))
    return joins.apply_corrections(base, updates, "user_id", "controversy").select("event_id", "controversy")


@query(
    "J20_append_pages",
    """
    SELECT conv_id AS post_id, turn AS id, CASE WHEN turn < 3 THEN 1 ELSE 2 END AS page FROM conversations
    WHERE turn < 3 OR conv_id IN (SELECT conv_id FROM conversations WHERE turn < 3)
    """,
)
def append_pages(spark, folder):
    rows = Tables(spark, folder).conversations.select(F.col("conv_id").alias("post_id"), F.col("turn").alias("id"))
    first = rows.where(F.col("id") < 3).withColumn("page", F.lit(1))
    later = rows.where(F.col("id") >= 3).withColumn("page", F.lit(2))
    return joins.append_pages(first, later)


@query(
    "flagship_claims_per_language",
    f"""
    WITH {FEATURE_WORDS_SQL}, k AS (SELECT fact_id, unnest(list_filter(keywords, lambda x: x NOT IN ('and', 'or'))) AS word FROM kw),
    hits AS (SELECT fact_id, message_id FROM k JOIN words USING (word) GROUP BY 1, 2 HAVING count(*) >= 3)
    SELECT fact_id, lang, count(*) AS count FROM hits JOIN documents ON doc_id = message_id GROUP BY 1, 2
    """,
)
def claims_per_language(spark, folder):
    t = Tables(spark, folder)
    claims = t.benchmark.select(F.col("item_id").alias("fact_id"), F.col("text").alias("claim"))
    return daily.claims_per_language(claims, document_messages(t))

"""Filters and projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text, times
from ..operators import filters, language
from ..sources import readers
from .catalog import Tables, query

LANGUAGES = ["en", "es", "fr", "de"]


def feeds(t: Tables):
    """orders as the repository feed and customers as the review feed, nested."""
    repository = t.orders.select(
        F.col("o_orderkey").cast("string").alias("link"),
        F.concat(F.lit("order "), F.col("o_orderkey")).alias("content"),
        F.struct(F.col("o_orderpriority").alias("name")).alias("organization"),
        F.struct(F.struct(F.col("o_orderstatus").alias("name")).alias("calification")).alias(
            "organizationCalification"
        ),
        F.col("o_orderdate").alias("date"),
    )
    review = t.customer.select(
        F.col("c_name").alias("text"),
        F.struct(
            F.col("c_custkey").cast("string").alias("url"),
            F.struct(F.col("c_mktsegment").alias("name")).alias("publisher"),
            F.lit("en").alias("languageCode"),
        ).alias("claimReview"),
    )
    return repository, review


REPOSITORY = {
    "claim": "content",
    "url": "link",
    "reviewer": "organization.name",
    "calification": "organizationCalification.calification.name",
}
REVIEW = {
    "claim": "text",
    "url": "claimReview.url",
    "reviewer": "claimReview.publisher.name",
    "lang": "claimReview.languageCode",
}

UNIFIED_SQL = """
    SELECT 'order ' || o_orderkey AS claim, o_orderkey::VARCHAR AS url, o_orderpriority AS reviewer,
           o_orderstatus AS calification, NULL::VARCHAR AS lang FROM orders
    UNION ALL
    SELECT c_name, c_custkey::VARCHAR, c_mktsegment, NULL, 'en' FROM customer
"""


@query("P1_unify_claims", UNIFIED_SQL)
def unify(spark, folder):
    repository, review = feeds(Tables(spark, folder))
    return filters.unify_claims([(repository, REPOSITORY), (review, REVIEW)])


@query(
    "P2_pluck",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, concat_ws(',', CASE WHEN l_returnflag <> 'N' THEN l_returnflag END,
      CASE WHEN l_linestatus <> 'O' THEN l_linestatus END, l_linenumber::VARCHAR) AS names FROM lineitem
    """,
)
def pluck(spark, folder):
    """Three elements per row; 'N' and 'O' elements lack the key."""
    flags = [
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")),
        F.when(F.col("l_linestatus") != "O", F.col("l_linestatus")),
        F.col("l_linenumber").cast("string"),
    ]
    elements = F.array(*[F.struct(f.alias("name")) for f in flags])
    df = Tables(spark, folder).lineitem.withColumn("formats", elements)
    return df.select("l_orderkey", "l_linenumber", "l_partkey", F.array_join(filters.pluck("formats", "name"), ",").alias("names"))


@query(
    "P3_flatten",
    """
    SELECT 'order ' || o_orderkey AS content, o_orderkey::VARCHAR AS link, o_orderpriority AS "organization.name",
           o_orderstatus AS "organizationCalification.calification.name", strftime(o_orderdate, '%Y-%m-%d') AS date
    FROM orders
    """,
)
def flatten(spark, folder):
    repository, _ = feeds(Tables(spark, folder))
    return readers.flatten(repository.withColumn("date", times.day_text("date")))


@query(
    "P3_flatten_one_column",
    """
    SELECT c_name AS text, c_custkey::VARCHAR AS "claimReview_url", c_mktsegment AS "claimReview_publisher_name",
           'en' AS "claimReview_languageCode" FROM customer
    """,
)
def flatten_one(spark, folder):
    _, review = feeds(Tables(spark, folder))
    return readers.flatten(review, only="claimReview")


@query("P4_rename_drop", "SELECT o_orderkey AS fact_id, o_orderstatus AS qualification, o_totalprice FROM orders")
def rename(spark, folder):
    return filters.rename_and_drop(
        Tables(spark, folder).orders,
        {"o_orderkey": "fact_id", "o_orderstatus": "qualification"},
        ("o_custkey", "o_orderdate", "o_orderpriority"),
    )


@query(
    "P5_recode",
    """
    SELECT event_id, CASE event_type WHEN 'click' THEN 'Alerts' WHEN 'view' THEN 'Health' ELSE event_type END AS event_type,
           CASE event_type WHEN 'click' THEN 'Alerts' WHEN 'view' THEN 'Health' ELSE event_type END || '+'
             || CASE user_id::VARCHAR WHEN '8' THEN 'eight' ELSE user_id::VARCHAR END AS tags
    FROM events
    """,
)
def recode(spark, folder):
    df = Tables(spark, folder).events.select(
        "event_id", "event_type", F.array("event_type", F.col("user_id").cast("string")).alias("tags")
    )
    mapping = {"click": "Alerts", "view": "Health"}
    out = filters.recode(df, {"event_type": mapping, "tags": mapping | {"8": "eight"}})
    return out.withColumn("tags", F.array_join("tags", "+"))


@query(
    "P6_fill_none",
    """
    SELECT o_orderkey, coalesce(CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END, 'None') AS type FROM orders
    """,
)
def fill_none(spark, folder):
    df = Tables(spark, folder).orders
    typed = df.select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("type"))
    return filters.fill_none(typed, "type")


def feature_rows(t: Tables):
    """Orders with markers: priority 1 was searched, priority 5 lacks keywords."""
    p = F.col("reviewer")
    return t.claims.select(
        "fact_id",
        "date",
        "calification",
        F.when(p == "1-URGENT", F.col("date")).alias("searched_at"),
        F.when(p == "2-HIGH", F.col("date")).alias("filtered_at"),
        F.when(p != "5-LOW", F.array(p)).alias("keywords"),
    )


FEATURES_SQL = """
    features AS (
      SELECT o_orderkey AS fact_id, o_orderdate AS date, o_orderstatus AS calification,
        CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderdate END AS searched_at,
        CASE WHEN o_orderpriority = '2-HIGH' THEN o_orderdate END AS filtered_at,
        CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS keywords
      FROM orders)
"""


@query(
    "P7_pending_search",
    f"""
    WITH {FEATURES_SQL} SELECT fact_id, strftime(date, '%Y-%m-%d') AS day FROM features
    WHERE searched_at IS NULL AND keywords IS NOT NULL AND calification = 'F'
      AND date < TIMESTAMP '1998-06-01' - INTERVAL 8 DAY
    """,
)
def pending_search(spark, folder):
    rows = feature_rows(Tables(spark, folder))
    out = filters.pending_search(rows, "searched_at", "1998-06-01", 7, ["F"])
    return out.select("fact_id", times.day_text("date").alias("day"))


@query(
    "P8_pending_search_of_day",
    f"""
    WITH {FEATURES_SQL} SELECT fact_id FROM features
    WHERE searched_at IS NULL AND keywords IS NOT NULL AND calification = 'F' AND date = TIMESTAMP '1998-06-01'
    """,
)
def pending_day(spark, folder):
    rows = feature_rows(Tables(spark, folder))
    return filters.pending_search_of_day(rows, "searched_at", "1998-06-01", ["F"]).select("fact_id")


@query(
    "P9_pending_classification",
    f"""
    WITH {FEATURES_SQL} SELECT fact_id FROM features
    WHERE filtered_at IS NULL AND calification = 'F' AND date >= TIMESTAMP '2000-03-01'
    """,
)
def pending_classification(spark, folder):
    rows = feature_rows(Tables(spark, folder))
    return filters.pending_classification(rows, "filtered_at", "2000-03-01", ["F"]).select("fact_id")


@query(
    "P10_pending_refilter",
    f"""
    WITH {FEATURES_SQL} SELECT fact_id FROM features
    WHERE searched_at IS NOT NULL AND keywords IS NOT NULL AND filtered_at IS NULL
    """,
)
def pending_refilter(spark, folder):
    rows = feature_rows(Tables(spark, folder))
    return filters.pending_refilter(rows, "searched_at", "filtered_at").select("fact_id")


@query(
    "P11_date_range",
    """
    SELECT event_id FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-12 12:00:00'
    """,
)
def date_range(spark, folder):
    df = Tables(spark, folder).events
    return filters.in_range(df, "ts", "2024-01-05", "2024-01-12 12:00:00").select("event_id")


def detected(t: Tables):
    """Documents with the voted language."""
    votes = language.default_votes(t.documents, "doc_id", F.col("text"), text.corpus_tokens("text"), LANGUAGES)
    return votes.select("doc_id", language.row_language("votes").alias("pref_lang"))


def _stop_sql(column: str, words: dict) -> str:
    return ",\n".join(
        f"len(list_filter({column}, lambda x: x IN ({', '.join(repr(w) for w in ws)}))) AS {lang}"
        for lang, ws in words.items()
    )


def _best_sql(position: int, source: str, languages: list[str], order: list[str]) -> str:
    total = " + ".join(languages)
    best = f"greatest({', '.join(languages)})"
    case = " ".join(f"WHEN {lang} = {best} THEN '{lang}'" for lang in order)
    return (
        f"SELECT doc_id, {position} AS position, CASE WHEN {total} > 0 THEN CASE {case} END END AS lang,"
        f" CASE WHEN {total} > 0 THEN {best}::DOUBLE / ({total}) END AS confidence FROM {source}"
    )


_WORDS = {lang: language.FUNCTION_WORDS[lang] for lang in LANGUAGES}
_LETTERS = {lang: language.MARKING_LETTERS[lang] for lang in LANGUAGES if lang in language.MARKING_LETTERS}
TOKENS_SQL = r"list_filter(string_split_regex(lower(regexp_replace({0}, '[!-/:-@\[-`{{-~]', '', 'g')), '\s+'), lambda x: x <> '')"
DETECTED_SQL = f"""
    toks AS (SELECT doc_id, lower(text) AS low, {TOKENS_SQL.format('text')} AS t FROM documents),
    by_word AS (SELECT doc_id, {_stop_sql('t', _WORDS)} FROM toks),
    by_kind AS (SELECT doc_id, {_stop_sql('list_distinct(t)', _WORDS)} FROM toks),
    by_letter AS (SELECT doc_id, {', '.join(
        f"length(low) - length(translate(low, '{ls}', '')) AS {lang}" for lang, ls in _LETTERS.items())} FROM toks),
    votes AS (
      {_best_sql(0, 'by_word', LANGUAGES, LANGUAGES)} UNION ALL
      {_best_sql(1, 'by_kind', LANGUAGES, LANGUAGES)} UNION ALL
      {_best_sql(2, 'by_letter', list(_LETTERS), list(_LETTERS))}),
    counted AS (
      SELECT doc_id, CASE WHEN confidence >= 0.75 THEN lang END AS lang, count(*) AS n, min(position) AS position
      FROM votes GROUP BY 1, 2),
    best AS (
      SELECT *, max(CASE WHEN lang IS NOT NULL THEN n END) OVER (PARTITION BY doc_id) AS best_n FROM counted),
    detected AS (
      SELECT doc_id, coalesce(string_agg(lang, '_' ORDER BY position) FILTER (WHERE lang IS NOT NULL AND n = best_n),
             'undefined') AS pref_lang FROM best GROUP BY 1)
"""


@query("A30_vote_language", f"WITH {DETECTED_SQL} SELECT doc_id, pref_lang FROM detected")
def vote_language(spark, folder):
    return detected(Tables(spark, folder))




@query(
    "P12_assign_language",
    f"""
    WITH {DETECTED_SQL}, assigned AS (
      SELECT doc_id, CASE WHEN source IN ('src1', 'src2', 'src4') THEN 'es' WHEN source IN ('src3', 'src5') THEN 'de'
                          WHEN source IN ('src6', 'src7', 'src8', 'src9') THEN pref_lang END AS assigned_lang
      FROM documents JOIN detected USING (doc_id))
    SELECT * FROM assigned WHERE assigned_lang IN ('es', 'de', 'fr')
    """,
)
def assign_language(spark, folder):
    t = Tables(spark, folder)
    fixed = {s: "es" for s in ("src1", "src2", "src4")} | {s: "de" for s in ("src3", "src5")}
    asked = {s: filters.DETECT for s in ("src6", "src7", "src8", "src9")}
    df = t.documents.select("doc_id", "source").join(detected(t), "doc_id")
    out = filters.assign_language(df, "source", "pref_lang", fixed | asked, ["es", "de", "fr"])
    return out.select("doc_id", "assigned_lang")


@query(
    "P13_non_empty",
    "SELECT conv_id, turn FROM conversations WHERE length(text) > 0",
)
def non_empty(spark, folder):
    return filters.non_empty(Tables(spark, folder).conversations, "text").select("conv_id", "turn")


@query("P14_short_texts", "SELECT doc_id, n_chars FROM documents WHERE length(text) < 500")
def short_texts(spark, folder):
    return filters.short_texts(Tables(spark, folder).documents, "text").select("doc_id", "n_chars")


@query(
    "P15_eligible_for_sampling",
    """
    SELECT o_orderkey AS fact_id FROM orders
    WHERE o_orderdate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1999-12-31' AND o_orderstatus = 'F'
      AND o_totalprice > 100000 AND o_orderpriority <> '5-LOW'
    """,
)
def eligible(spark, folder):
    claims = Tables(spark, folder).claims.withColumns(
        {"claim": F.when(F.col("price") > 100000, F.col("price")), "review": F.col("custkey")}
    )
    return filters.eligible_for_sampling(claims, "1997-01-01", "1999-12-31", ["5-LOW"], ["F"]).select("fact_id")


@query("P16_exclude_publishers", "SELECT o_orderkey AS fact_id FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH')")
def exclude(spark, folder):
    claims = Tables(spark, folder).claims
    return filters.exclude_publishers(claims, "reviewer", ["1-URGENT", "2-HIGH"]).select("fact_id")


@query(
    "P18_active_media",
    "SELECT p_partkey AS id, p_name AS name FROM part WHERE p_size > 20 AND p_type = 'SMALL'",
)
def active_media(spark, folder):
    df = Tables(spark, folder).part.select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        (F.col("p_size") > 20).cast("string").alias("active"),
        F.col("p_type").alias("country"),
    )
    return filters.active_media(df, "SMALL").select("id", "name")


def labelled_links(t: Tables):
    """Labelled documents as messages; the source number is the claim."""
    docs = t.documents.select("doc_id", F.col("source").alias("fact_id"))
    return docs.join(t.labels, "doc_id", "left").select(
        F.col("doc_id").alias("message_id"),
        "fact_id",
        F.when(F.col("quality") == 1, "on-topic").when(F.col("quality") == 0, "off-topic").alias("topic_relation"),
        F.when(F.col("toxic") == 1, "on-claim").when(F.col("toxic") == 0, "off-claim").alias("claim_relation"),
    )


def flagged(t: Tables):
    """Sources as claims of four reviewers; 'src1*' are false."""
    claims = t.documents.select(F.col("source").alias("fact_id")).distinct()
    claims = claims.withColumns(
        {
            "calification": F.when(F.col("fact_id").startswith("src1"), "Falso").otherwise("Engañoso"),
            "reviewer": F.when(F.col("fact_id").endswith("0"), "other").otherwise("kept"),
        }
    )
    links = labelled_links(t)
    news = t.labels.select(
        F.concat(F.lit("src"), F.col("doc_id") % 20).alias("fact_id"),
        F.when(F.col("quality") == 1, "on-topic").otherwise("off-topic").alias("topic_relation"),
    )
    return filters.subset_flags(claims, links, news, "Falso", ["kept"])


FLAGS_SQL = """
    claims0 AS (SELECT DISTINCT source AS fact_id, source LIKE 'src1%' AND source NOT LIKE '%0' AS exp FROM documents),
    links AS (
      SELECT doc_id AS message_id, source AS fact_id, exp,
        exp AND quality IS NOT NULL AS topic, exp AND quality IS NOT DISTINCT FROM 1 AS on_topic,
        exp AND toxic IS NOT NULL AS claim, exp AND toxic IS NOT DISTINCT FROM 1 AS on_claim
      FROM documents LEFT JOIN labels USING (doc_id) JOIN claims0 ON fact_id = source),
    news AS (
      SELECT 'src' || (doc_id % 20) AS fact_id, coalesce(exp, false) AS exp, coalesce(exp, false) AS topic,
        coalesce(exp, false) AND quality = 1 AS on_topic
      FROM labels LEFT JOIN claims0 c ON c.fact_id = 'src' || (doc_id % 20)),
    marks AS (
      SELECT fact_id, bool_or(topic) AS topic, bool_or(on_topic) AS on_topic, bool_or(claim) AS claim,
        bool_or(on_claim) AS on_claim
      FROM (SELECT fact_id, topic, on_topic, claim, on_claim FROM links
            UNION ALL SELECT fact_id, topic, on_topic, false, false FROM news) GROUP BY 1),
    claims AS (
      SELECT fact_id, exp, coalesce(topic AND exp, false) AS topic, coalesce(on_topic, false) AS on_topic,
        coalesce(claim AND exp, false) AS claim, coalesce(on_claim AND exp, false) AS on_claim
      FROM claims0 LEFT JOIN marks USING (fact_id))
"""


@query(
    "P19_subset_flags_claims",
    f"""
    WITH {FLAGS_SQL} SELECT fact_id, exp AS experience_subset, topic AS topic_relation_subset,
      on_topic AS on_topic_subset, claim AS claim_relation_subset, on_claim AS on_claim_subset FROM claims
    """,
)
def flags_claims(spark, folder):
    return flagged(Tables(spark, folder))[0].drop("calification", "reviewer")


@query(
    "P19_subset_flags_messages",
    f"""
    WITH {FLAGS_SQL} SELECT message_id, fact_id, exp AS experience_subset, topic AS topic_relation_subset,
      on_topic AS on_topic_subset, claim AS claim_relation_subset, on_claim AS on_claim_subset FROM links
    """,
)
def flags_messages(spark, folder):
    return flagged(Tables(spark, folder))[1].drop("topic_relation", "claim_relation")


@query(
    "P20_without_type",
    "SELECT event_id FROM events WHERE event_type <> 'error'",
)
def without_type(spark, folder):
    return filters.without_type(Tables(spark, folder).events, "event_type", "error").select("event_id")


@query(
    "P21_keep_subset",
    f"""
    WITH {FLAGS_SQL} SELECT 'on_topic' AS subset, message_id FROM links WHERE on_topic
    UNION ALL SELECT 'on_claim', message_id FROM links WHERE on_claim
    UNION ALL SELECT 'all', message_id FROM links
    """,
)
def keep_subset(spark, folder):
    links = flagged(Tables(spark, folder))[1]
    parts = [
        filters.keep_subset(links, name).select(F.lit(name).alias("subset"), "message_id")
        for name in ("on_topic", "on_claim", "all")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])

"""Column functions on whole tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..functions import labels, payloads, text, times, vectors
from ..operators import keywords, search
from ..sources import sinks
from . import daily
from .catalog import CHECKED_SQL, OFFSET_SQL, Tables, query
from .queries_rows import TOKENS_SQL

PAGE_TEXT_SQL = r"""
    replace(replace(replace(replace(regexp_replace(regexp_replace(html,
      '(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->|<![^>]*>', '', 'g'),
      '(?s)<[^>]+>', '', 'g'), '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&amp;', '&')
"""


@query(
    "F1_strip_html",
    rf"""
    SELECT page_id, md5({PAGE_TEXT_SQL}) AS text_md5, length({PAGE_TEXT_SQL}) AS size FROM pages
    """,
)
def strip_html(spark, folder):
    out = Tables(spark, folder).pages.select("page_id", text.strip_html("html").alias("t"))
    return out.select("page_id", F.md5("t").alias("text_md5"), F.length("t").cast("bigint").alias("size"))


def linked(t: Tables):
    """Documents, with the address of the page of the same number in the middle where there is one."""
    pages = t.pages.select(F.col("page_id").alias("doc_id"), "url")
    docs = t.documents.join(pages, "doc_id", "left")
    added = F.coalesce(F.concat(F.lit(" "), "url", F.lit(" end "), "url"), F.lit(""))
    return docs.select("doc_id", F.concat("text", added).alias("text"))


@query(
    "F2_extract_urls",
    r"""
    WITH linked AS (SELECT doc_id, text || coalesce(' ' || url || ' end ' || url, '') AS text
                    FROM documents LEFT JOIN pages ON page_id = doc_id)
    SELECT doc_id, md5(regexp_replace(text, 'https?://[!$-_a-z]+', '', 'g')) AS rest_md5,
           array_to_string(regexp_extract_all(text, 'https?://[!$-_a-z]+'), ' ') AS urls
    FROM linked
    """,
)
def extract_urls(spark, folder):
    df = linked(Tables(spark, folder))
    return df.select(
        "doc_id", F.md5(text.drop_urls("text")).alias("rest_md5"), F.array_join(text.find_urls("text"), " ").alias("urls")
    )


CLEAN_SQL = r"regexp_replace(lower(trim(regexp_replace({0}, '[^ \nA-Za-z0-9À-ÖØ-öø-ÿЀ-ӿ/]+', '', 'g'), e' \n')), '[!-/:-@\[-`{{-~]', '', 'g')"


@query(
    "F3_clean_word",
    rf"""
    WITH w AS (SELECT DISTINCT unnest(string_split_regex(text, '\s+')) AS word FROM documents)
    SELECT word, {CLEAN_SQL.format('word')} AS cleaned FROM w
    """,
)
def clean_word(spark, folder):
    words = Tables(spark, folder).documents.select(F.explode(F.split("text", r"\s+")).alias("word")).distinct()
    return words.select("word", text.clean_word("word").alias("cleaned"))


@query(
    "F4_letters_only",
    r"""
    SELECT item_id, array_to_string(list_sort(list_distinct(list_filter(
      list_transform(string_split_regex(text, '\s+'), lambda x: regexp_replace(x, '[^\p{L} ]', '', 'g')),
      lambda x: x <> ''))), ' ') AS words FROM benchmark
    """,
)
def letters_only(spark, folder):
    words = text.letters_only(F.split("text", r"\s+"))
    df = Tables(spark, folder).benchmark
    return df.select("item_id", F.array_join(F.sort_array(words), " ").alias("words"))


@query(
    "F5_drop_short",
    rf"""
    SELECT doc_id, len(list_filter(t, lambda x: length(x) > 1)) AS over_one, len(list_filter(t, lambda x: length(x) > 2)) AS over_two
    FROM (SELECT doc_id, {TOKENS_SQL.format('text')} AS t FROM documents)
    """,
)
def drop_short(spark, folder):
    df = Tables(spark, folder).documents.select("doc_id", text.corpus_tokens("text").alias("t"))
    return df.select(
        "doc_id", *[F.size(text.longer_than("t", n)).cast("bigint").alias(c) for n, c in ((1, "over_one"), (2, "over_two"))]
    )


@query("F6_fold_accents", "SELECT doc_id, md5(strip_accents(lower(text))) AS folded_md5 FROM documents")
def fold_accents(spark, folder):
    return Tables(spark, folder).documents.select("doc_id", F.md5(text.fold_accents("text")).alias("folded_md5"))


@query(
    "F7_host_name",
    r"""
    WITH h AS (SELECT page_id, replace(substr(url, length(regexp_extract(url, 'https?://[w.]{0,4}')) + 1), '/', '') AS host,
               url FROM pages)
    SELECT page_id, host, split_part(host, '.', 1) AS name, replace(strip_accents(lower(url)), ' ', '') AS squeezed FROM h
    """,
)
def host_name(spark, folder):
    host = text.host_name("url")
    return Tables(spark, folder).pages.select(
        "page_id", host.alias("host"), text.before_first_dot(host).alias("name"), text.squeeze_name("url").alias("squeezed")
    )


VARIANTS_SQL = r"""
    list_concat([lower(name)],
      list_transform(string_split(name, '/'), lambda x: lower(x)),
      list_transform(string_split(name, ' - '), lambda x: lower(x)),
      list_transform(string_split(name, '  '), lambda x: lower(x)),
      list_transform(string_split(name, '. Ed. '), lambda x: lower(x)),
      list_transform(string_split(name, ' de '), lambda x: lower(x)),
      list_transform(string_split(name, ' en '), lambda x: lower(x)),
      list_transform(string_split(name, ' Ed. '), lambda x: lower(x)),
      [strip_accents(lower(name)), replace(strip_accents(lower(name)), ' ', '')],
      CASE WHEN length(name) > 3 THEN
        [lower(array_to_string(string_split(name, ' ')[:-2], '')), lower(array_to_string(string_split(name, ' ')[:-2], ' '))]
        ELSE [] END,
      [split_part(name, '.', 1)])
"""
PUBLICATIONS_SQL = """
    publications AS (SELECT 'R' || p_partkey AS ref,
      p_name || CASE p_partkey % 6 WHEN 0 THEN ' Ed. ' || p_brand WHEN 1 THEN ' - ' || p_type WHEN 2 THEN '/' || p_brand
                WHEN 3 THEN ' de ' || p_type WHEN 4 THEN '. Ed. ' || p_brand ELSE ' Digital' END AS name FROM part)
"""


def publications(t: Tables):
    """Part names dressed as publication names."""
    kind = F.col("p_partkey") % 6
    tail = (
        F.when(kind == 0, F.concat(F.lit(" Ed. "), "p_brand"))
        .when(kind == 1, F.concat(F.lit(" - "), "p_type"))
        .when(kind == 2, F.concat(F.lit("/"), "p_brand"))
        .when(kind == 3, F.concat(F.lit(" de "), "p_type"))
        .when(kind == 4, F.concat(F.lit(". Ed. "), "p_brand"))
        .otherwise(" Digital")
    )
    return t.part.select(F.concat(F.lit("R"), "p_partkey").alias("ref"), F.concat("p_name", tail).alias("name"))


@query(
    "F8_name_variants",
    f"""
    WITH {PUBLICATIONS_SQL}, v AS (SELECT ref, {VARIANTS_SQL} AS keys FROM publications)
    SELECT ref, unnest(keys) AS key, unnest(range(len(keys))) AS rule FROM v
    """,
)
def name_variants(spark, folder):
    df = publications(Tables(spark, folder))
    out = df.select("ref", F.posexplode(text.publication_variants("name")).alias("rule", "key"))
    return out.withColumn("rule", F.col("rule").cast("bigint"))


@query(
    "F9_title_tokens",
    r"""
    SELECT doc_id, md5(array_to_string(regexp_extract_all(text, '[\p{L}\p{N}]+(?:[-''.][\p{L}\p{N}]+)*'), ' ')) AS tokens_md5
    FROM documents
    """,
)
def title_tokens(spark, folder):
    df = Tables(spark, folder).documents
    return df.select("doc_id", F.md5(F.array_join(text.title_tokens("text"), " ")).alias("tokens_md5"))


# Sorted words over three letters of each benchmark text.
LONG_WORDS_SQL = rf"list_sort(list_distinct(list_filter({TOKENS_SQL.format('text')}, lambda x: length(x) > 7)))"


def long_words(t: Tables):
    words = F.sort_array(F.array_distinct(text.longer_than(text.corpus_tokens("text"), 7)))
    return t.documents.select("doc_id", words.alias("k"))


@query(
    "F10_query_text",
    f"""
    WITH k AS (SELECT doc_id, {LONG_WORDS_SQL}[1:6] AS k FROM documents),
    w AS (SELECT doc_id, unnest(k) AS w, unnest(range(len(k))) AS i FROM k),
    g AS (SELECT a.doc_id, '(' || a.w || ' AND ' || b.w || ' AND ' || c.w || ')' AS g, a.i AS i, b.i AS j, c.i AS l
          FROM w a JOIN w b ON a.doc_id = b.doc_id AND a.i < b.i JOIN w c ON a.doc_id = c.doc_id AND b.i < c.i)
    SELECT k.doc_id, coalesce(md5(string_agg(g, ' OR ' ORDER BY i, j, l)), md5('')) AS query_md5, count(g) AS groups
    FROM k LEFT JOIN g USING (doc_id) GROUP BY 1
    """,
)
def query_text(spark, folder):
    df = long_words(Tables(spark, folder)).withColumn("k", search.query_keywords("k", 6))
    df = df.withColumn("g", search.keyword_groups("k"))
    return df.select(
        "doc_id", F.md5(search.query_text(F.col("g"), " AND ")).alias("query_md5"), F.size("g").cast("bigint").alias("groups")
    )


@query(
    "F10_restrictive_text",
    f"""
    WITH k AS (SELECT doc_id, {LONG_WORDS_SQL} AS k FROM documents),
    p AS (SELECT doc_id, list_transform(range(1, len(k) // 2 + 1),
      lambda j: '(' || k[2 * j - 1] || ' AND ' || k[2 * j] || ')') AS p FROM k)
    SELECT doc_id, coalesce(array_to_string(list_transform(range(1, len(p) + 1),
      lambda j: CASE WHEN j = 1 THEN p[j] ELSE p[j] || ' AND ' || p[j - 1] END), ' OR '), '') AS query FROM p
    """,
)
def restrictive_text(spark, folder):
    df = long_words(Tables(spark, folder))
    pairs = F.filter(F.transform("k", lambda _, i: F.slice("k", 2 * i + 1, F.lit(2))), lambda p: F.size(p) == 2)
    # a column of its own, else every pair would be looked up in pairs made anew
    return df.select("doc_id", pairs.alias("pairs")).select("doc_id", search.restrictive_text(F.col("pairs")).alias("query"))


# Sorted words over five letters of each claim, all of them.
CLAIM_WORDS_SQL = rf"SELECT item_id AS fact_id, list_sort(list_distinct(list_filter({TOKENS_SQL.format('text')}, lambda x: length(x) > 5))) AS k FROM benchmark"


def claim_words(t: Tables):
    return daily.simple_keywords(t.benchmark.select(F.col("item_id").alias("fact_id"), F.col("text").alias("claim")))


@query(
    "F11_query_budget",
    f"""
    WITH RECURSIVE k AS ({CLAIM_WORDS_SQL}),
    w AS (SELECT fact_id, unnest(k) AS w, unnest(range(len(k))) AS i FROM k),
    g AS (SELECT a.fact_id, length(a.w) + length(b.w) + length(c.w) + 4 AS size,
            row_number() OVER (PARTITION BY a.fact_id ORDER BY a.i, b.i, c.i) AS r
          FROM w a JOIN w b ON a.fact_id = b.fact_id AND a.i < b.i JOIN w c ON a.fact_id = c.fact_id AND b.i < c.i),
    f AS (
      SELECT fact_id, 1 AS r, size AS used FROM g WHERE r = 1
      UNION ALL
      SELECT g.fact_id, g.r, (f.used + 4 + g.size)::BIGINT FROM f JOIN g ON g.fact_id = f.fact_id AND g.r = f.r + 1
      WHERE f.used < 1024 - (2 * g.size - 1))
    SELECT fact_id, coalesce(max(r), 0)::BIGINT AS kept, coalesce(max(used), 0)::BIGINT AS length FROM k LEFT JOIN f USING (fact_id) GROUP BY 1
    """,
)
def query_budget(spark, folder):
    df = claim_words(Tables(spark, folder)).withColumn("g", search.within_budget(search.keyword_groups("keywords"), 1024))
    return df.select(
        "fact_id",
        F.size("g").cast("bigint").alias("kept"),
        F.length(search.query_text(F.col("g"))).cast("bigint").alias("length"),
    )


def annotated(t: Tables):
    """Documents as annotated pairs: odd ids are news with title and body."""
    odd = F.col("doc_id") % 2 == 1
    lines = F.split("text", "\n")
    return t.documents.select(
        F.col("doc_id").alias("message_id"),
        F.col("n_chars").alias("fact_id"),
        F.col("source").alias("claim"),
        F.col("lang").alias("review"),
        F.when(~odd, F.col("text")).alias("text"),
        F.when(odd, lines[0]).alias("title"),
        F.when(odd, F.col("text")).alias("content"),
    )


ANNOTATION_SQL = r"""
    tasks AS (SELECT doc_id, doc_id || '_' || n_chars AS _id, source, lang, n_chars, text AS body, CASE WHEN doc_id % 2 = 1 THEN
        e'***CLAIM***:\n ' || source || e' \n ***FACT-CHECK***: ' || lang || e' \n\n ***TITLE***: \n ' || split_part(text, e'\n', 1)
        || e' \n ***FIRS LINE OF ARTICLE***: \n ' || split_part(text, '. ', 1)
      ELSE e'***CLAIM***:\n ' || source || e' \n ***FACT-CHECK***: \n ' || lang || e' \n\n ***TWEET***: \n ' || text END AS text
      FROM documents)
"""


@query("F12_annotation_text", rf"WITH {ANNOTATION_SQL} SELECT _id, md5(text) AS text_md5 FROM tasks")
def annotation_text(spark, folder):
    tasks = sinks.annotation_tasks(annotated(Tables(spark, folder)))
    return tasks.select("_id", F.md5("text").alias("text_md5"))


@query(
    "F13_parse_annotation",
    r"""
    SELECT doc_id::VARCHAR AS id_tweet, n_chars::VARCHAR AS id_claim, source || ' ' AS claim,
      CASE WHEN doc_id % 2 = 1 THEN lang ELSE e'\n ' || lang END AS "fact-check",
      md5(CASE WHEN doc_id % 2 = 1 THEN split_part(text, e'\n', 1) ELSE text END) AS text_md5
    FROM documents
    """,
)
def parse_annotation(spark, folder):
    tasks = sinks.parse_annotation(sinks.annotation_tasks(annotated(Tables(spark, folder))))
    return tasks.withColumn("text_md5", F.md5("text")).drop("text")


LABEL_CASE_SQL = """
    CASE WHEN quality = 1 AND toxic = 1 THEN 'Difunde la claim falsa' WHEN quality = 1 THEN 'Es sobre la claim pero no la apoya'
         WHEN toxic = 1 THEN 'Es otro tema' ELSE 'Tweet ilegible' END
"""


def spanish_labels(t: Tables):
    good, toxic = F.col("quality") == 1, F.col("toxic") == 1
    label = (
        F.when(good & toxic, "Difunde la claim falsa")
        .when(good, "Es sobre la claim pero no la apoya")
        .when(toxic, "Es otro tema")
        .otherwise("Tweet ilegible")
    )
    return t.labels.withColumn("label", label)


@query(
    "F14_translate_labels",
    f"""
    WITH l AS (SELECT *, {LABEL_CASE_SQL} AS label FROM labels)
    SELECT doc_id,
      CASE label WHEN 'Difunde la claim falsa' THEN 'The text disseminates the false claim'
        WHEN 'Es sobre la claim pero no la apoya' THEN 'The text is about the claim, but it does not support it'
        WHEN 'Es otro tema' THEN 'The text is on another topic' ELSE 'The text is not readable' END AS label_eng,
      CASE WHEN quality = 1 THEN 'on-topic' ELSE 'off-topic' END AS topic,
      CASE WHEN quality = 1 AND toxic = 1 THEN 'disseminates' WHEN quality = 1 THEN 'not-disseminates' END AS finer
    FROM l
    """,
)
def translate_labels(spark, folder):
    return spanish_labels(Tables(spark, folder)).select(
        "doc_id",
        labels.translate_label("label", labels.ANNOTATION_LABELS).alias("label_eng"),
        labels.translate_label("label", labels.TOPIC_OF_LABEL).alias("topic"),
        labels.translate_label("label", labels.FINER_OF_LABEL).alias("finer"),
    )


@query(
    "F15_timestamps",
    """
    SELECT event_id, strftime(date_trunc('second', ts) - INTERVAL 2 HOUR, '%Y-%m-%d %H:%M:%S') AS iso_offset,
      strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS cut_fraction, strftime(ts, '%Y-%m-%d') AS day_first,
      strftime(ts, '%Y-%m-%d') AS year_first, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS day_first_time,
      strftime(date_trunc('second', ts) + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS madrid
    FROM events
    """,
)
def timestamps(spark, folder):
    ts = F.col("ts")
    second = F.date_format(F.date_trunc("second", ts), "yyyy-MM-dd'T'HH:mm:ss")
    shown = "yyyy-MM-dd HH:mm:ss"
    offset = times.parse_iso_offset(F.concat(second, F.lit("+02:00")))
    epoch = F.unix_timestamp(F.to_timestamp(second))
    return Tables(spark, folder).events.select(
        "event_id",
        F.date_format(F.to_utc_timestamp(offset, F.current_timezone()), shown).alias("iso_offset"),
        F.date_format(times.parse_cut_fraction(F.concat(second, F.lit(".123Z"))), shown).alias("cut_fraction"),
        times.day_text(times.parse_day_first(F.date_format(ts, "dd/MM/yyyy"))).alias("day_first"),
        times.day_text(times.parse_year_first(F.date_format(ts, "yyyy/MM/dd"))).alias("year_first"),
        F.date_format(times.parse_day_first_time(F.date_format(ts, "dd/MM/yyyy HH:mm:ss")), shown).alias("day_first_time"),
        F.date_format(times.from_epoch(epoch, "Europe/Madrid"), shown).alias("madrid"),
    )


@query(
    "F16_day_windows",
    """
    SELECT o_orderkey, strftime(o_orderdate + to_days(i::INT), '%Y-%m-%d') AS day FROM orders, range(-7, 8) t(i)
    """,
)
def day_windows(spark, folder):
    claims = Tables(spark, folder).orders.select("o_orderkey", F.inline(times.day_windows("o_orderdate")))
    return claims.select("o_orderkey", times.day_text("start").alias("day"))


@query(
    "F16_day_windows_from_claim_time",
    """
    SELECT event_id, strftime(ts + to_days(i::INT), '%Y-%m-%d %H:%M') AS start, strftime(ts + to_days(i::INT + 1), '%Y-%m-%d %H:%M') AS "end"
    FROM events, range(-2, 2) t(i)
    """,
)
def day_windows_from_time(spark, folder):
    windows = F.inline(times.day_windows("ts", 2, 2, from_midnight=False))
    df = Tables(spark, folder).events.select("event_id", windows)
    return df.select("event_id", *[F.date_format(c, "yyyy-MM-dd HH:mm").alias(c) for c in ("start", "end")])


@query(
    "F17_offsets",
    f"WITH {CHECKED_SQL}, {OFFSET_SQL} SELECT message_id, day_offset, hour_offset FROM offsets",
)
def offsets(spark, folder):
    return Tables(spark, folder).checked.select(
        "message_id",
        times.day_offset("date", "checked_at").cast("bigint").alias("day_offset"),
        times.hour_offset("date", "checked_at").alias("hour_offset"),
    )


@query(
    "F18_impact",
    f"""
    WITH {CHECKED_SQL}, {OFFSET_SQL}
    SELECT message_id, CASE WHEN hour_offset < 0 THEN 'Before/fact-check' ELSE 'After' END AS by_hour,
      CASE WHEN day_offset <= 0 THEN 'Before/fact-check' ELSE 'After' END AS by_day FROM offsets
    """,
)
def impact(spark, folder):
    return Tables(spark, folder).checked.select(
        "message_id",
        times.impact(times.hour_offset("date", "checked_at")).alias("by_hour"),
        times.impact(times.day_offset("date", "checked_at"), "day").alias("by_day"),
    )


@query(
    "F19_keyword_triples",
    f"""
    WITH k AS ({CLAIM_WORDS_SQL}), w AS (SELECT fact_id, unnest(k) AS w FROM k)
    SELECT a.fact_id, a.w || ' ' || b.w || ' ' || c.w AS triple
    FROM w a JOIN w b ON a.fact_id = b.fact_id AND a.w < b.w JOIN w c ON a.fact_id = c.fact_id AND b.w < c.w
    """,
)
def keyword_triples(spark, folder):
    triples = claim_words(Tables(spark, folder)).select("fact_id", F.explode(search.combinations_of("keywords", 3)).alias("g"))
    return triples.select("fact_id", F.array_join("g", " ").alias("triple"))


@query(
    "F19_keyword_pairs",
    f"""
    WITH k AS ({CLAIM_WORDS_SQL}), w AS (SELECT fact_id, unnest(k) AS w FROM k)
    SELECT a.fact_id, a.w AS a, b.w AS b FROM w a JOIN w b ON a.fact_id = b.fact_id AND a.w < b.w
    """,
)
def keyword_pairs(spark, folder):
    return keywords.keyword_pairs(claim_words(Tables(spark, folder)))


def tagged(t: Tables):
    """Documents with tags by word form: a stand-in for a trained tagger.

    The first line is the claim, the rest the review; runs of two capitalised
    words are entities, and endings decide noun, adjective and verb.
    """
    # each step works a text or its words out once for all that use them
    claim = F.substring_index("text", "\n", 1)
    sides = t.documents.select(F.col("doc_id").alias("fact_id"), "text", claim.alias("claim"))
    sides = sides.select("fact_id", "claim", F.substr("text", F.length("claim") + 1).alias("review"))
    sides = sides.select("*", *[text.corpus_tokens(c).alias(f"{c}_words") for c in ("claim", "review")])
    forms = {"NOUN": ("tion",), "ADJ": ("ble",), "VERB": ("ing", "ed")}

    def entities(c):
        runs = F.filter(text.capitalised_runs(c), lambda w: F.contains(w, F.lit(" ")))
        return F.create_map(F.lit("ENT"), runs)

    def tags(words):
        def ending(ends):
            return F.filter(words, lambda w: reduce(lambda a, b: a | b, [F.endswith(w, F.lit(e)) for e in ends]))

        return F.create_map(*[x for tag, ends in forms.items() for x in (F.lit(tag), ending(ends))])

    return sides.select(
        "fact_id",
        entities("claim").alias("ner_claim"),
        entities("review").alias("ner_review"),
        tags("claim_words").alias("pos_claim"),
        tags("review_words").alias("pos_review"),
    )


def _tags_sql(side: str) -> str:
    tokens = TOKENS_SQL.format(side)
    forms = {"noun": "tion$", "adj": "ble$", "verb": "(ing|ed)$"}
    tags = ", ".join(f"list_filter({tokens}, lambda x: regexp_matches(x, '{p}')) AS {n}_{side}" for n, p in forms.items())
    runs = rf"regexp_extract_all({side}, '\p{{Lu}}\p{{L}}+(?: \p{{Lu}}\p{{L}}+)*')"
    return f"list_filter({runs}, lambda x: contains(x, ' ')) AS ner_{side}, {tags}"


TAGGED_SQL = f"""
    sides AS (SELECT doc_id AS fact_id, split_part(text, e'\\n', 1) AS claim,
                substr(text, length(split_part(text, e'\\n', 1)) + 1) AS review
              FROM documents),
    tagged AS (SELECT fact_id, {_tags_sql('claim')}, {_tags_sql('review')} FROM sides)
"""


def _round_sql(i: int, side: str, n: int) -> str:
    added = f"list_concat(k, [noun_{side}[{n}], adj_{side}[{n}], verb_{side}[{n}]])"
    clean = (
        rf"list_distinct(list_filter(list_transform(list_filter({added}, lambda x: x IS NOT NULL), "
        r"lambda x: regexp_replace(x, '[^\p{L} ]', '', 'g')), lambda x: length(x) > 2))"
    )
    return f"k{i} AS (SELECT * REPLACE (CASE WHEN len(k) < 5 THEN {clean} ELSE k END AS k) FROM k{i - 1})"


ROUNDS_SQL = ",\n".join(_round_sql(i + 1, side, n) for i, (side, n) in enumerate(
    [(s, n) for s in ("claim", "review") for n in (1, 2, 3)]))


@query(
    "F20_select_keywords",
    f"""
    WITH {TAGGED_SQL},
    k0 AS (SELECT *, list_distinct(list_concat(ner_claim, ner_review)) AS k FROM tagged), {ROUNDS_SQL}
    SELECT fact_id, array_to_string(list_sort(list_filter(k, lambda x: length(x) > 1)), '|') AS keywords FROM k6
    """,
)
def select_keywords(spark, folder):
    out = keywords.select_keywords(tagged(Tables(spark, folder)))
    return out.select("fact_id", F.array_join("keywords", "|").alias("keywords"))


def _more_sql(i: int, tag: str) -> str:
    words = (
        rf"list_distinct(list_filter(list_transform(list_concat({tag}_review, {tag}_claim), "
        r"lambda x: regexp_replace(x, '[^\p{L} ]', '', 'g')), lambda x: x <> ''))"
    )
    return f"k{i} AS (SELECT * REPLACE (CASE WHEN len(k) < 3 THEN list_concat(k, {words}) ELSE k END AS k) FROM k{i - 1})"


@query(
    "F21_select_keywords_first_words",
    f"""
    WITH {TAGGED_SQL},
    k0 AS (SELECT *, list_filter([ner_review[1], ner_claim[1]], lambda x: x IS NOT NULL) AS k FROM tagged),
    {_more_sql(1, 'noun')}, {_more_sql(2, 'adj')}, {_more_sql(3, 'verb')}
    SELECT fact_id, array_to_string(list_sort(list_distinct(k))[1:5], '|') AS keywords FROM k3
    """,
)
def select_keywords_first_words(spark, folder):
    out = keywords.select_keywords_first_words(tagged(Tables(spark, folder)))
    return out.select("fact_id", F.array_join("keywords", "|").alias("keywords"))


@query(
    "F22_parse_counts",
    """
    SELECT event_id, try_cast(trim(replace(value::INT || ' clics', 'clics', '')) AS BIGINT) AS clicks,
      try_cast(trim(replace('K ' || user_id, 'K ', '')) AS BIGINT) AS karma, try_cast(event_type AS BIGINT) AS none
    FROM (SELECT * REPLACE (floor(value) AS value) FROM events)
    """,
)
def parse_counts(spark, folder):
    clicks = F.concat(F.floor("value").cast("string"), F.lit(" clics"))
    karma = F.concat(F.lit("K "), F.col("user_id").cast("string"))
    return Tables(spark, folder).events.select(
        "event_id",
        text.parse_count(clicks, "clics").alias("clicks"),
        text.parse_count(karma, "K ").alias("karma"),
        text.parse_count("event_type").alias("none"),
    )


# Claim vector of a label: its first vector; the review vector is its last.
PAIRS_SQL = """
    ends AS (SELECT label AS fact_id, min(vec_id) AS first_id, max(vec_id) AS last_id FROM embeddings GROUP BY 1),
    pairs AS (
      SELECT e.vec_id AS message_id, ends.fact_id, e.embedding::DOUBLE[] AS m, c.embedding::DOUBLE[] AS c, r.embedding::DOUBLE[] AS r
      FROM embeddings e JOIN ends ON ends.fact_id = e.label JOIN embeddings c ON c.vec_id = first_id
      JOIN embeddings r ON r.vec_id = last_id),
    scored AS (SELECT *, list_cosine_similarity(c, m) AS score, list_cosine_similarity(r, m) AS review_score FROM pairs)
"""


def vector_tables(t: Tables):
    """(pairs, claim vectors, review vectors, message vectors) out of embeddings."""
    e = t.embeddings.select(
        F.col("vec_id").alias("message_id"), F.col("label").cast("bigint").alias("fact_id"), F.col("embedding").alias("vector")
    )
    ends = e.groupBy("fact_id").agg(
        F.min_by("vector", "message_id").alias("first"), F.max_by("vector", "message_id").alias("last")
    )
    return (
        e.select("message_id", "fact_id"),
        ends.select("fact_id", F.col("first").alias("vector")),
        ends.select("fact_id", F.col("last").alias("vector")),
        e.select("message_id", "vector"),
    )


@query(
    "F23_label_above_threshold",
    f"""
    WITH {PAIRS_SQL} SELECT message_id, CASE WHEN round(score, 6) > 0.1 THEN 'on-topic' ELSE 'off-topic' END AS label FROM scored
    """,
)
def label_above(spark, folder):
    from ..operators import scoring

    pairs, claims, _, messages = vector_tables(Tables(spark, folder))
    scored = scoring.score_pairs(pairs, claims, messages)
    label = labels.label_above(F.round("score", 6), 0.1, "topic_relation")
    return scored.select("message_id", label.alias("label"))


@query(
    "F24_label_greater",
    f"""
    WITH {PAIRS_SQL} SELECT message_id,
      CASE WHEN round(score, 6) > round(review_score, 6) THEN 'disseminates' ELSE 'not-disseminates' END AS live,
      CASE WHEN round(score, 6) >= round(review_score, 6) THEN 'disseminates' ELSE 'not-disseminates' END AS evaluated
    FROM scored
    """,
)
def label_greater(spark, folder):
    from ..operators import scoring

    pairs, claims, reviews, messages = vector_tables(Tables(spark, folder))
    scored = scoring.score_pairs(pairs, claims, messages, "c")
    scored = scoring.score_pairs(scored, reviews, messages, "r")
    c, r = F.round("c", 6), F.round("r", 6)
    return scored.select(
        "message_id", labels.label_greater(c, r).alias("live"), labels.label_greater(c, r, True).alias("evaluated")
    )


@query(
    "F25_cosine",
    """
    SELECT vec_id, round(list_cosine_similarity(embedding::DOUBLE[], list_reverse(embedding)::DOUBLE[]), 6) AS similarity,
      round(sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])), 6) AS norm FROM embeddings
    """,
)
def cosine(spark, folder):
    e = Tables(spark, folder).embeddings
    return e.select(
        "vec_id",
        F.round(vectors.cosine(F.col("embedding"), F.reverse("embedding")), 6).alias("similarity"),
        F.round(vectors.norm("embedding"), 6).alias("norm"),
    )


@query(
    "F26_percentages",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, round(l_discount * 100, 1) AS pct, format('{:.2f}%', l_tax * 100) AS shown FROM lineitem
    """,
)
def percentages(spark, folder):
    return Tables(spark, folder).lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.round(F.col("l_discount") * 100, 1).alias("pct"),
        F.format_string("%.2f%%", F.col("l_tax") * 100).alias("shown"),
    )


@query(
    "F27_payload_fields",
    "SELECT event_id, (props->>'$.k')::BIGINT AS k, props->>'$.missing' AS missing FROM events",
)
def payload_fields(spark, folder):
    payload = F.from_json("props", "k bigint, missing string")
    return Tables(spark, folder).events.select("event_id", payload["k"].alias("k"), payload["missing"].alias("missing"))


@query(
    "F27_payload_variants",
    """
    WITH p AS (SELECT event_id, CASE event_id % 5 WHEN 0 THEN props WHEN 1 THEN '{"k": {"deep": ' || user_id || '}}' WHEN 2 THEN '{"k": "n' || user_id || '"}'
      WHEN 3 THEN '[' || user_id || ', 7]' ELSE 'no json' END AS payload FROM events)
    SELECT event_id, CASE WHEN event_id % 5 = 0 THEN (payload->>'$.k')::BIGINT END AS k, CASE WHEN event_id % 5 = 1 THEN (payload->>'$.k.deep')::BIGINT END AS deep,
      CASE WHEN event_id % 5 = 2 THEN payload->>'$.k' WHEN event_id % 5 = 0 THEN payload->>'$.k' END AS k_text,
      CASE WHEN event_id % 5 = 3 THEN (payload->>'$[0]')::BIGINT END AS first, event_id % 5 <> 4 AS known FROM p
    """,
)
def payload_variants(spark, folder):
    """Payloads that are an object, a nested one, one with text, a list, and no JSON at all, each parsed once."""
    kind = F.col("event_id") % 5
    text_of = F.col("user_id").cast("string")
    payload = (
        F.when(kind == 0, F.col("props"))
        .when(kind == 1, F.concat(F.lit('{"k": {"deep": '), text_of, F.lit("}}")))
        .when(kind == 2, F.concat(F.lit('{"k": "n'), text_of, F.lit('"}')))
        .when(kind == 3, F.concat(F.lit("["), text_of, F.lit(", 7]")))
        .otherwise("no json")
    )
    rows = Tables(spark, folder).events.select("event_id", payloads.parsed(payload).alias("v"))
    scalar = payloads.shape("v").rlike("k: (BIGINT|STRING)")
    return rows.select(
        "event_id",
        payloads.field("v", "$.k", "bigint").alias("k"),
        payloads.field("v", "$.k.deep", "bigint").alias("deep"),
        F.when(scalar, payloads.field("v", "$.k")).alias("k_text"),
        payloads.field("v", "$[0]", "bigint").alias("first"),
        F.col("v").isNotNull().alias("known"),
    )

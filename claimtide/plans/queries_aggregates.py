"""Aggregations, reports and tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text, times
from ..operators import aggregates, entities, filters, joins, ranking, statistics
from ..session import stored
from .catalog import CHECKED_SQL, OFFSET_SQL, Tables, query
from .queries_functions import TAGGED_SQL, tagged
from .queries_joins import BEFORE_AFTER_SQL, with_offsets
from .queries_rows import FLAGS_SQL, flagged


def rounded(df, *columns: str, digits: int = 6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query(
    "A1_count_by_field",
    """
    SELECT event_type, CASE WHEN user_id > 75 THEN user_id END AS checker, count(*) AS count FROM events GROUP BY 1, 2
    """,
)
def count_by(spark, folder):
    df = Tables(spark, folder).events
    return aggregates.count_by(df, "event_type", F.when(F.col("user_id") > 75, F.col("user_id")).alias("checker"))


@query("A1_count_by_struct", "SELECT event_type, user_id, count(*) AS count FROM events GROUP BY 1, 2")
def count_by_struct(spark, folder):
    df = Tables(spark, folder).events.select(F.struct("event_type", "user_id").alias("organization"))
    return aggregates.count_by(df, "organization").select("organization.*", "count")


@query(
    "A2_means",
    """
    SELECT round(avg(l_quantity), 6) AS l_quantity, round(avg(l_extendedprice), 4) AS l_extendedprice,
      round(avg(l_discount), 6) AS l_discount, round(avg(l_tax), 6) AS l_tax FROM lineitem
    """,
)
def means(spark, folder):
    metrics = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    out = aggregates.means(Tables(spark, folder).lineitem, metrics)
    out = rounded(out, "l_quantity", "l_discount", "l_tax")
    return rounded(out, "l_extendedprice", digits=4)


@query(
    "A3_time_span",
    """
    SELECT strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last,
      date_diff('day', min(ts)::DATE, max(ts)::DATE)::INT AS days FROM events
    """,
)
def time_span(spark, folder):
    out = aggregates.time_span(Tables(spark, folder).dated)
    return out.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("first", "last")})


@query(
    "A4_table_sizes",
    " UNION ALL ".join(
        f"SELECT '{t}' AS name, count(*) AS count FROM {t}" for t in ("orders", "customer", "events", "documents")
    ),
)
def table_sizes(spark, folder):
    t = Tables(spark, folder)
    return aggregates.table_sizes({n: getattr(t, n) for n in ("orders", "customer", "events", "documents")})


DAY = "strftime(ts, '%Y-%m-%d')"


@query("A5_per_day_checker", f"SELECT {DAY} AS day, event_type AS feature, count(*) AS count FROM events GROUP BY 1, 2")
def per_day_checker(spark, folder):
    return aggregates.per_day(Tables(spark, folder).dated, "feature")


def listed(t: Tables):
    """Messages naming two claims: their user and their payload's number."""
    k = F.from_json("props", "k bigint")["k"]
    return t.events.select(
        F.col("ts").alias("date"), "event_id", "event_type", "value", F.array_distinct(F.array("user_id", k)).alias("fact_id")
    )


LISTED_SQL = """
    listed AS (SELECT ts, event_id, event_type, value, unnest(list_distinct([user_id, (props->>'$.k')::BIGINT])) AS fact_id FROM events)
"""


@query("A6_per_day_claim", f"WITH {LISTED_SQL} SELECT {DAY} AS day, fact_id, count(*) AS count FROM listed GROUP BY 1, 2")
def per_day_claim(spark, folder):
    return aggregates.per_day(listed(Tables(spark, folder)), "fact_id")


@query(
    "A7_per_day_claim_newspaper",
    f"SELECT {DAY} AS day, user_id AS fact_id, event_type AS feature, count(*) AS count FROM events GROUP BY 1, 2, 3",
)
def per_day_claim_newspaper(spark, folder):
    return aggregates.per_day(Tables(spark, folder).dated, "fact_id", "feature")


@query(
    "A8_value_counts",
    f"""
    WITH {LISTED_SQL} SELECT fact_id, count(*) AS "Counts", round(count(*) / sum(count(*)) OVER () * 100, 1) AS "Percentages"
    FROM listed GROUP BY 1
    """,
)
def value_counts(spark, folder):
    return aggregates.value_counts(listed(Tables(spark, folder)), "fact_id")


KINDS = ["click", "error", "purchase", "signup", "view"]
KIND_COUNTS = ", ".join(f"count(*) FILTER (WHERE event_type = '{k}') AS {k}" for k in KINDS)


@query("A9_crosstab", f"WITH {LISTED_SQL} SELECT fact_id, {KIND_COUNTS} FROM listed GROUP BY 1")
def crosstab(spark, folder):
    return aggregates.crosstab(listed(Tables(spark, folder)), "fact_id", "event_type", KINDS)[0]


@query(
    "A9_crosstab_normalised",
    f"""
    WITH {LISTED_SQL}, c AS (SELECT fact_id, {KIND_COUNTS}, count(*) AS n FROM listed GROUP BY 1)
    SELECT fact_id, {', '.join(f'round({k} / n, 6) AS {k}' for k in KINDS)} FROM c
    """,
)
def crosstab_normalised(spark, folder):
    return rounded(aggregates.crosstab(listed(Tables(spark, folder)), "fact_id", "event_type", KINDS)[1], *KINDS)


@query("A10_day_crosstab", f"SELECT {DAY} AS day, {KIND_COUNTS} FROM events GROUP BY 1")
def day_crosstab(spark, folder):
    df = Tables(spark, folder).dated.withColumn("day", times.day_text("date"))
    return aggregates.crosstab(df, "day", "feature", KINDS, reorder_first=False)[0]


def describe_sql(value: str, source: str, by: str = "", digits: int = 4) -> str:
    quartiles = ", ".join(f"round(quantile_cont({value}, {q}), {digits}) AS q{int(q * 100)}" for q in (0.25, 0.5, 0.75))
    key = f"{by}, " if by else ""
    return f"""
      SELECT {key}count({value}) AS count, round(avg({value}), {digits}) AS mean, round(stddev_samp({value}), {digits}) AS std,
        min({value})::DOUBLE AS min, {quartiles}, max({value})::DOUBLE AS max FROM {source} {f'GROUP BY {by}' if by else ''}
    """


def described(df, digits: int = 4):
    return rounded(df, "mean", "std", "q25", "q50", "q75", digits=digits)


@query("A11_describe", describe_sql("l_extendedprice", "lineitem", digits=3))
def describe(spark, folder):
    return described(ranking.describe(Tables(spark, folder).lineitem, "l_extendedprice"), 3)


@query("A11_describe_by_key", describe_sql("l_quantity", "lineitem", "l_returnflag"))
def describe_by_key(spark, folder):
    return described(ranking.describe(Tables(spark, folder).lineitem, "l_quantity", ["l_returnflag"]))


@query(
    "A12_per_claim_feature",
    f"""
    WITH {LISTED_SQL} SELECT l.fact_id, event_type AS feature, count(*) AS n FROM listed l GROUP BY 1, 2
    """,
)
def per_claim_feature(spark, folder):
    df = aggregates.opened(listed(Tables(spark, folder)), "fact_id")
    df = df.withColumn("feature", F.array("event_type"))
    return aggregates.per_claim_feature(df, "feature")


SIZES_SQL = "SELECT source, count(*) AS n FROM documents GROUP BY 1"


@query(
    "A13_lump_rare",
    """
    SELECT p_partkey, CASE WHEN count(*) OVER (PARTITION BY p_name) <= 30 THEN 'Others' ELSE p_name END AS p_name FROM part
    """,
)
def lump_rare(spark, folder):
    df = Tables(spark, folder).part.select("p_partkey", "p_name")
    return aggregates.lump_rare(df, "p_name", 30)


@query(
    "A14_describe_per_feature",
    f"""
    WITH c AS (SELECT user_id, event_type AS feature, count(*) AS n FROM events GROUP BY 1, 2) {describe_sql('n', 'c', 'feature')}
    """,
)
def describe_per_feature(spark, folder):
    counts = aggregates.per_claim_feature(Tables(spark, folder).dated, "feature")
    return described(aggregates.describe_by(counts, "feature"))


@query(
    "A15_engagement_sum_per_day_offset",
    f"""
    WITH {CHECKED_SQL}, {OFFSET_SQL} SELECT fact_id, day_offset, feature, round(sum(value), 4) AS value FROM offsets GROUP BY 1, 2, 3
    """,
)
def engagement_sum(spark, folder):
    df = with_offsets(Tables(spark, folder))
    return rounded(aggregates.metric_sums(df, ["fact_id", "day_offset", "feature"], ["value"]), "value", digits=4)


@query(
    "A16_engagement_mean_per_hour_offset",
    f"""
    WITH {CHECKED_SQL}, {OFFSET_SQL},
    m AS (SELECT fact_id, hour_offset, avg(CASE WHEN feature <> 'click' THEN value END) AS value FROM offsets GROUP BY 1, 2)
    SELECT fact_id, hour_offset, round(value, 6) AS value FROM m WHERE value IS NOT NULL
    """,
)
def engagement_mean(spark, folder):
    df = with_offsets(Tables(spark, folder))
    df = df.withColumn("value", F.when(F.col("feature") != "click", F.col("value")))
    return rounded(aggregates.metric_means(df, ["fact_id", "hour_offset"], ["value"]), "value")


@query(
    "A17_messages_per_offset",
    f"WITH {CHECKED_SQL}, {OFFSET_SQL} SELECT fact_id, hour_offset, feature, count(*) AS count FROM offsets GROUP BY 1, 2, 3",
)
def messages_per_offset(spark, folder):
    return aggregates.count_by(with_offsets(Tables(spark, folder)), "fact_id", "hour_offset", "feature")


@query(
    "A18_before_after_by_day",
    f"""
    WITH {CHECKED_SQL}, {OFFSET_SQL} SELECT fact_id, count(*) FILTER (WHERE day_offset <= 0) AS before,
      count(*) FILTER (WHERE day_offset > 0) AS after FROM offsets GROUP BY 1
    """,
)
def before_after_by_day(spark, folder):
    return joins.before_after(with_offsets(Tables(spark, folder)), "day_offset", form="day")


@query("A19_distinct_count", "SELECT count(DISTINCT user_id) AS count FROM events")
def distinct_count(spark, folder):
    return aggregates.distinct_count(Tables(spark, folder).events, "user_id")


@query(
    "A20_subset_overview",
    f"""
    WITH {FLAGS_SQL}
    SELECT 'Claims' AS source, count(*) AS "All", count_if(exp)::BIGINT AS "Experience", count_if(on_topic)::BIGINT AS "On Topic",
      count_if(on_claim)::BIGINT AS "On claim", count(*) - count_if(exp)::BIGINT AS "Difference" FROM claims
    UNION ALL SELECT 'News', count(*), count_if(exp)::BIGINT, count_if(on_topic)::BIGINT, NULL, count(*) - count_if(exp)::BIGINT FROM news
    UNION ALL SELECT 'Messages', count(*), count_if(exp)::BIGINT, count_if(on_topic)::BIGINT, count_if(on_claim)::BIGINT,
      count(*) - count_if(exp)::BIGINT FROM links
    """,
)
def subset_overview(spark, folder):
    claims, links, news = flagged(Tables(spark, folder))
    flags = {"Experience": "experience_subset", "On Topic": "on_topic_subset", "On claim": "on_claim_subset"}
    out = aggregates.subset_overview({"Claims": claims, "News": news, "Messages": links}, flags)
    return out.withColumn("Difference", F.col("All") - F.col("Experience"))


@query(
    "A21_label_table",
    """
    WITH c AS (SELECT quality::VARCHAR AS label, count(*) AS documents, sum(toxic)::BIGINT AS toxic FROM labels GROUP BY 1),
    u AS (SELECT * FROM c UNION ALL SELECT 'Total', sum(documents)::BIGINT, sum(toxic)::BIGINT FROM c)
    SELECT label, documents, toxic, format('{:.2f}%', documents / (SELECT sum(documents) FROM c) * 100) AS pct_documents,
      format('{:.2f}%', toxic / (SELECT sum(toxic) FROM c) * 100) AS pct_toxic FROM u
    """,
)
def label_table(spark, folder):
    counts = Tables(spark, folder).labels.groupBy(F.col("quality").cast("string").alias("label")).agg(
        F.count("*").alias("documents"), F.sum("toxic").alias("toxic")
    )
    return aggregates.label_table(counts, "label", ["documents", "toxic"])


def guesses(t: Tables):
    """Quality as gold against a guess from the document's size."""
    joined = t.labels.join(t.documents, "doc_id")
    return joined.select(
        F.col("lang").alias("model"),
        F.when(F.col("quality") == 1, "good").otherwise("bad").alias("gold"),
        F.when(F.col("n_chars") > 1500, "good").when(F.col("n_chars") > 300, "bad").otherwise("unsure").alias("predicted"),
    )


GUESSES_SQL = """
    guesses AS (SELECT lang AS model, CASE WHEN quality = 1 THEN 'good' ELSE 'bad' END AS gold,
      CASE WHEN n_chars > 1500 THEN 'good' WHEN n_chars > 300 THEN 'bad' ELSE 'unsure' END AS predicted
      FROM labels JOIN documents USING (doc_id))
"""


@query(
    "A23_confusion_matrix",
    f"""
    WITH {GUESSES_SQL} SELECT gold, count(*) FILTER (WHERE predicted = 'bad') AS bad, count(*) FILTER (WHERE predicted = 'good') AS good,
      count(*) FILTER (WHERE predicted = 'unsure') AS unsure FROM guesses GROUP BY 1
    """,
)
def confusion_matrix(spark, folder):
    cells = aggregates.confusion(guesses(Tables(spark, folder)))
    return aggregates.confusion_matrix(cells, ["bad", "good", "unsure"])


def report_sql(source: str, key: str = "") -> str:
    k = f"{key}, " if key else ""
    same = f"x.{key} = a.{key} AND " if key else ""
    by = f"GROUP BY {key}" if key else ""
    return f"""
    names AS (SELECT DISTINCT {k}unnest([gold, predicted]) AS label FROM {source}),
    per AS (SELECT {'a.' + key + ', ' if key else ''}a.label,
      (SELECT count(*) FROM {source} x WHERE {same}x.gold = a.label) AS support,
      (SELECT count(*) FROM {source} x WHERE {same}x.predicted = a.label) AS guessed,
      (SELECT count(*) FROM {source} x WHERE {same}x.gold = a.label AND x.predicted = a.label) AS hit FROM names a),
    pr AS (SELECT *, CASE WHEN guessed > 0 THEN hit / guessed ELSE 0 END AS precision,
      CASE WHEN support > 0 THEN hit / support ELSE 0 END AS recall FROM per),
    f AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1 FROM pr),
    report AS (
      SELECT {k}label, precision, recall, f1, support FROM f
      UNION ALL SELECT {k}'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM f {by}
      UNION ALL SELECT {k}'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
        sum(f1 * support) / sum(support), sum(support) FROM f {by}
      UNION ALL SELECT {k}'accuracy', sum(hit) / sum(support), sum(hit) / sum(support), sum(hit) / sum(support), sum(support) FROM f {by})
    SELECT {k}label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support::BIGINT AS support
    FROM report
    """


@query("A24_class_report", f"WITH {GUESSES_SQL}, {report_sql('guesses')}")
def class_report(spark, folder):
    cells = aggregates.confusion(guesses(Tables(spark, folder)))
    return rounded(aggregates.class_report(cells), "precision", "recall", "f1")


@query(
    "A25_label_counts",
    """
    SELECT source, CASE WHEN toxic = 1 THEN 'toxic' ELSE 'clean' END AS label, count(*) AS n
    FROM documents JOIN labels USING (doc_id) GROUP BY 1, 2
    """,
)
def label_counts(spark, folder):
    t = Tables(spark, folder)
    joined = t.documents.join(t.labels, "doc_id", "left")
    label = F.when(F.col("toxic") == 1, "toxic").when(F.col("toxic") == 0, "clean")
    return aggregates.label_counts(joined.withColumn("label", label), ("source",))


@query(
    "A29_mean_of_totals",
    f"""
    WITH d AS (SELECT {DAY} AS day, user_id, count(*) AS n FROM events GROUP BY 1, 2),
    t AS (SELECT user_id, sum(n) AS s FROM d GROUP BY 1) SELECT round(avg(s), 6) AS mean FROM t
    """,
)
def mean_of_totals(spark, folder):
    counts = aggregates.per_day(Tables(spark, folder).dated, "fact_id")
    return rounded(aggregates.mean_of_totals(counts), "mean")


GAZETTEER_SQL = rf"""
    gaz AS (SELECT DISTINCT lower(unnest(regexp_extract_all(text, '\p{{Lu}}\p{{L}}+(?: \p{{Lu}}\p{{L}}+)*'))) AS word FROM benchmark),
    spans AS (SELECT DISTINCT doc_id, lower(unnest(regexp_extract_all(text, '\p{{Lu}}\p{{L}}+(?: \p{{Lu}}\p{{L}}+)*'))) AS word
              FROM documents WHERE length(text) < 500),
    tagged_spans AS (SELECT doc_id, CASE WHEN gaz.word IS NULL THEN 'ENT' ELSE 'CLAIM' END AS tag, spans.word
                     FROM spans LEFT JOIN gaz USING (word))
"""


def spans(t: Tables):
    runs = t.benchmark.select(F.explode(text.capitalised_runs("text")).alias("span"))
    gazetteer = runs.select(text.clean_word("span").alias("word")).distinct().withColumn("tag", F.lit("CLAIM"))
    return entities.tagged_spans(t.documents, "doc_id", "text", gazetteer)


@query("M8_tagged_spans", f"WITH {GAZETTEER_SQL} SELECT doc_id, tag, word FROM tagged_spans")
def tagged_spans(spark, folder):
    return spans(Tables(spark, folder))


@query(
    "A31_words_per_tag",
    f"WITH {GAZETTEER_SQL} SELECT doc_id, tag, string_agg(word, '|' ORDER BY word) AS words FROM tagged_spans GROUP BY 1, 2",
)
def words_per_tag(spark, folder):
    tags = entities.words_per_tag(spans(Tables(spark, folder)), "doc_id")
    opened = tags.select("doc_id", F.explode("tags").alias("tag", "words"))
    return opened.withColumn("words", F.array_join("words", "|"))


def pieces(t: Tables):
    """Words of short documents as tagged subword pieces, for the merge operators.

    A word is cut after three letters; its length decides its tag.
    """
    short = filters.short_texts(t.documents, "text").select(F.col("doc_id").alias("text_id"), text.corpus_tokens("text").alias("t"))
    words = short.select("text_id", F.posexplode("t").alias("n", "w"))
    kinds = F.array(*[F.lit(k) for k in ("B-PER", "I-PER", "E-PER", "O", "S-LOC", "I-LOC", "B-ORG")])
    tag = F.get(kinds, F.length("w") % 7)
    parts = F.array(F.substring("w", 1, 3), F.substr("w", F.lit(4)))
    cut = words.select("text_id", "n", tag.alias("tag"), F.posexplode(parts).alias("part", "word")).where(F.col("word") != "")
    start = F.col("n") * 10 + F.col("part") * 3
    return cut.select(
        "text_id",
        (F.col("n") * 2 + F.col("part")).alias("pos"),
        (F.col("part") == 0).alias("word_start"),
        "word",
        "tag",
        F.length("word").cast("double").alias("score"),
        start.alias("start"),
        (start + F.length("word")).alias("end"),
    )


PIECES_SQL = r"""
    short AS (SELECT doc_id AS text_id, TOKENS AS t FROM documents WHERE length(text) < 500),
    w AS (SELECT text_id, unnest(t) AS w, unnest(range(len(t))) AS n FROM short),
    words AS (SELECT text_id, n, w, ['B-PER', 'I-PER', 'E-PER', 'O', 'S-LOC', 'I-LOC', 'B-ORG'][length(w) % 7 + 1] AS tag,
      CASE WHEN length(w) > 3 THEN length(w) / 2 ELSE length(w) END AS score, n * 10 AS start,
      n * 10 + length(w) AS stop FROM w)
"""


def _pieces_sql() -> str:
    from .queries_rows import TOKENS_SQL

    return PIECES_SQL.replace("TOKENS", TOKENS_SQL.format("text"))


# Type of a word cut in two pieces of the same tag.
TWICE_SQL = """
    typed AS (SELECT *, CASE WHEN tag = 'O' THEN 'O' ELSE
      CASE WHEN length(w) > 3 AND tag[1] = 'O' THEN 'O' ELSE tag[1] END || tag[2:] END AS merged FROM words)
"""


@query(
    "W6_merge_pieces",
    f"""
    WITH {_pieces_sql()}, {TWICE_SQL} SELECT text_id, n + 1 AS pos, w AS word, merged AS tag, round(score, 6) AS score, start, stop AS "end"
    FROM typed
    """,
)
def merge_pieces(spark, folder):
    out = entities.merge_pieces(pieces(Tables(spark, folder)))
    return rounded(out, "score").withColumns({c: F.col(c).cast("bigint") for c in ("pos", "start", "end")})


@query(
    "A32_merge_spans",
    f"""
    WITH RECURSIVE {_pieces_sql()}, {TWICE_SQL},
    x AS (SELECT text_id, n, w, merged AS tag, merged[1] AS k, score, start, stop, merged <> 'O' AS typed FROM typed),
    walk AS (
      SELECT text_id, n, k = 'B' AS inside, k IN ('S', 'I', 'E') AS closes FROM x WHERE n = 0
      UNION ALL
      SELECT x.text_id, x.n, CASE WHEN inside THEN k = 'I' ELSE k = 'B' END,
        CASE WHEN inside THEN k <> 'I' ELSE k IN ('S', 'I', 'E') END
      FROM walk JOIN x ON x.text_id = walk.text_id AND x.n = walk.n + 1),
    g AS (SELECT x.*, coalesce(sum(closes::INT) OVER (PARTITION BY text_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
            AS entity_no, sum(closes::INT) OVER (PARTITION BY text_id) AS total
          FROM x JOIN walk USING (text_id, n)),
    tagn AS (SELECT text_id, entity_no, tag[3:] AS e, count(*) AS c FROM g WHERE typed AND entity_no < total GROUP BY 1, 2, 3),
    best AS (SELECT text_id, entity_no, arg_min(e, (-c, e)) AS entity FROM tagn GROUP BY 1, 2)
    SELECT text_id, entity_no::BIGINT AS entity_no, string_agg(w, '' ORDER BY n) AS word, any_value(entity) AS entity,
      round(avg(score), 6) AS score, min(start)::BIGINT AS start, max(stop)::BIGINT AS "end"
    FROM g JOIN best USING (text_id, entity_no) WHERE typed AND entity_no < total GROUP BY 1, 2
    """,
)
def merge_spans(spark, folder):
    out = entities.merge_spans(entities.merge_pieces(pieces(Tables(spark, folder))))
    return rounded(out, "score").withColumns({c: F.col(c).cast("bigint") for c in ("entity_no", "start", "end")})


@query(
    "A33_iqr_outliers",
    """
    WITH q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events)
    SELECT event_id, value FROM events, q WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)
    """,
)
def iqr_outliers(spark, folder):
    return statistics.iqr_outliers(Tables(spark, folder).events, "value").select("event_id", "value")


@query(
    "A34_wilcoxon",
    f"""
    WITH {BEFORE_AFTER_SQL},
    d AS (SELECT abs(after - before) AS size, after > before AS up FROM sides WHERE before > 0 AND after > 0 AND after <> before),
    r AS (SELECT *, rank() OVER (ORDER BY size) + (count(*) OVER (PARTITION BY size) - 1) / 2 AS rk,
            count(*) OVER (PARTITION BY size) AS t FROM d),
    s AS (SELECT count(*) AS n, sum(CASE WHEN up THEN rk ELSE 0 END) AS r_plus, sum(CASE WHEN up THEN 0 ELSE rk END) AS r_minus,
            sum(t * t - 1.0) AS ties FROM r),
    z AS (SELECT *, least(r_plus, r_minus) AS statistic,
            (least(r_plus, r_minus) - n * (n + 1) / 4) / sqrt((n * (n + 1) * (2.0 * n + 1) - ties / 2) / 24) AS z FROM s),
    tail AS (SELECT (sum(exp(-power(abs(z) + (i + 0.5) * 0.0005, 2) / 2)) * 0.0005 * sqrt(2 / pi())) AS p FROM z, range(40000) t(i))
    SELECT n, r_plus, r_minus, statistic, round(z, 6) AS z, round(p, 6) AS p FROM z, tail
    """,
)
def wilcoxon(spark, folder):
    pairs = joins.paired(joins.before_after(with_offsets(Tables(spark, folder)), "hour_offset"))
    return rounded(statistics.wilcoxon_signed_rank(pairs), "z", "p")


@query(
    "A35_normality_test",
    """
    WITH m AS (SELECT count(*)::DOUBLE AS n, avg(value) AS mu FROM events),
    c AS (SELECT any_value(n) AS n, avg(power(value - mu, 2)) AS m2, avg(power(value - mu, 3)) AS m3, avg(power(value - mu, 4)) AS m4 FROM events, m),
    k AS (SELECT n, m3 / power(m2, 1.5) AS g1, m4 / (m2 * m2) AS b2 FROM c),
    s AS (SELECT *, g1 * sqrt((n + 1) * (n + 3) / (6 * (n - 2))) AS y,
      sqrt(2 * (3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9)) - 1)) - 1 AS w2,
      (b2 - 3 * (n - 1) / (n + 1)) / sqrt(24 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))) AS x,
      6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3))) AS rb FROM k),
    t AS (SELECT *, 6 + 8 / rb * (2 / rb + sqrt(1 + 4 / (rb * rb))) AS a, y / sqrt(2 / (w2 - 1)) AS u FROM s),
    z AS (SELECT *, 1 / sqrt(0.5 * ln(w2)) * ln(u + sqrt(u * u + 1)) AS z1,
      (1 - 2 / (9 * a) - sign(1 + x * sqrt(2 / (a - 4))) * power((1 - 2 / a) / abs(1 + x * sqrt(2 / (a - 4))), 1 / 3.0)) / sqrt(2 / (9 * a)) AS z2 FROM t)
    SELECT n::BIGINT AS n, round(g1, 6) AS skew, round(b2 - 3, 6) AS excess, round(z1 * z1 + z2 * z2, 3) AS k2, round(exp(-(z1 * z1 + z2 * z2) / 2), 6) AS p FROM z
    """,
)
def normality(spark, folder):
    out = statistics.normality_test(Tables(spark, folder).events, "value")
    return rounded(rounded(out, "skew", "excess", "p"), "k2", digits=3)


@query("A36_distribution_box", describe_sql("value", "events"))
def distribution_box(spark, folder):
    return described(statistics.distribution_profile(Tables(spark, folder).events, "value")[0])


@query(
    "A36_distribution_histogram",
    """
    WITH e AS (SELECT min(value) AS lo, max(value) AS hi FROM events)
    SELECT least(floor((value - lo) / (hi - lo) * 20), 19)::INT AS bin, count(*) AS n, min(value) AS smallest, max(value) AS largest
    FROM events, e GROUP BY 1
    """,
)
def distribution_histogram(spark, folder):
    return statistics.distribution_profile(Tables(spark, folder).events, "value")[1]


@query(
    "A37_keywords_per_claim",
    f"WITH {TAGGED_SQL}, n AS (SELECT len(list_distinct(noun_review)) AS nbr_keywords FROM tagged) {describe_sql('nbr_keywords', 'n')}",
)
def keywords_per_claim(spark, folder):
    words = F.array_distinct(F.col("pos_review")["NOUN"])
    counts = tagged(Tables(spark, folder)).select(F.size(words).alias("nbr_keywords"))
    return described(ranking.describe(counts, "nbr_keywords"))


@query(
    "A38_run_summary",
    """
    SELECT count(DISTINCT user_id) AS claims, count(*) AS messages, strftime(min(ts), '%Y-%m-%d %H:%M') AS first,
      strftime(max(ts), '%Y-%m-%d %H:%M') AS last FROM events
    """,
)
def run_summary(spark, folder):
    """Counted while the hits and their claims are written."""
    hits, summary = Tables(spark, folder).dated, aggregates.RunSummary()
    stored(summary.of_hits(hits), "hits")
    stored(summary.of_claims(hits.select("fact_id").distinct()), "claims")
    out = summary.row(spark)
    return out.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm") for c in ("first", "last")})


def _solved(rows: str, size: int) -> str:
    """One step of the fit over `rows` (step, n, y, x0.., eta, mu): coefficients and the diagonal of the inverse, by elimination."""
    width = 2 * size + 1
    cell = lambda i, j: f"m{i}_{j}"
    first = [f"sum(w * x{i} * x{j}) AS {cell(i, j)}" for i in range(size) for j in range(size)]
    first += [f"{float(i == j)} AS {cell(i, size + j)}" for i in range(size) for j in range(size)]
    first += [f"sum(w * x{i} * z) AS {cell(i, 2 * size)}" for i in range(size)]
    sql = f"SELECT step, {', '.join(first)} FROM (SELECT *, n * mu / (1 + mu) AS w, eta + (y - mu) / mu AS z FROM ({rows})) GROUP BY step"
    for k in range(size):
        pivot = [f"{cell(k, j)} / {cell(k, k)} AS {cell(k, j)}" for j in range(width)]
        others = [
            f"{cell(i, j)} - {cell(i, k)} * {cell(k, j)} / {cell(k, k)} AS {cell(i, j)}" for i in range(size) if i != k for j in range(width)
        ]
        sql = f"SELECT step, {', '.join(pivot + others)} FROM ({sql})"
    out = [f"{cell(i, 2 * size)} AS b{i}, {cell(i, size + i)} AS v{i}" for i in range(size)]
    return f"SELECT step + 1 AS step, {', '.join(out)} FROM ({sql})"


FIT_TERMS = ["impact", "diff_time", "claim_relation"]
FIT_SQL = f"""
    WITH RECURSIVE {CHECKED_SQL}, {OFFSET_SQL},
    d AS (
      SELECT y, 1.0 AS x0, x1, x2, x3, count(*)::DOUBLE AS n FROM (
        SELECT (count(*) OVER (PARTITION BY fact_id))::DOUBLE AS y, (hour_offset >= 0)::INT::DOUBLE AS x1, hour_offset::DOUBLE AS x2,
          (feature = 'click')::INT::DOUBLE AS x3 FROM offsets) GROUP BY ALL),
    fit AS (
      {_solved("SELECT 0 AS step, d.*, ln((y + m) / 2) AS eta, (y + m) / 2 AS mu FROM d, (SELECT sum(y * n) / sum(n) AS m FROM d)", 4)}
      UNION ALL
      {_solved("SELECT step, d.*, b0 + b1 * x1 + b2 * x2 + b3 * x3 AS eta, exp(b0 + b1 * x1 + b2 * x2 + b3 * x3) AS mu FROM d, fit WHERE step < 30", 4)}
    )
    SELECT ['intercept', 'impact', 'diff_time', 'claim_relation'][i + 1] AS term, round(b, 6) AS coefficient, round(sqrt(v), 6) AS std_error,
      round(b / sqrt(v), 6) AS z
    FROM (SELECT unnest([b0, b1, b2, b3]) AS b, unnest([v0, v1, v2, v3]) AS v, unnest(range(4)) AS i FROM fit WHERE step = 30)
"""


@query("A39_negative_binomial_fit", FIT_SQL)
def negative_binomial_fit(spark, folder):
    """Messages per claim on side, offset and kind."""
    df = with_offsets(Tables(spark, folder))
    df = joins.with_group_size(df, "fact_id")
    df = df.withColumns(
        {
            "impact": (F.col("hour_offset") >= 0).cast("int"),
            "diff_time": F.col("hour_offset"),
            "claim_relation": (F.col("feature") == "click").cast("int"),
        }
    )
    fit = statistics.negative_binomial_fit(df, "counts", FIT_TERMS)
    return rounded(fit, "coefficient", "std_error", "z")


@query("A40_claims_per_message", f"WITH {LISTED_SQL} SELECT event_id, count(*) AS nbr_facts FROM listed GROUP BY 1")
def claims_per_message(spark, folder):
    return listed(Tables(spark, folder)).select("event_id", F.size("fact_id").cast("bigint").alias("nbr_facts"))

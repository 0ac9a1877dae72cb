"""Scoring, classification, evaluation, threads and plug-ins."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from .. import plugins
from ..functions import labels as lb
from ..functions import text, times
from ..operators import aggregates, entities, scoring, search, threads
from ..session import scratch_path, stored
from ..sources.versions import VersionedTables
from . import daily
from .catalog import CHECKED_SQL, OFFSET_SQL, Tables, query
from .queries_aggregates import GAZETTEER_SQL, report_sql, rounded
from .queries_functions import PAIRS_SQL, vector_tables
from .queries_joins import (
    FEATURE_WORDS_SQL,
    benchmark_features,
    document_messages,
    gold_tables,
    with_offsets,
)
from .queries_rows import TOKENS_SQL


@query("M1_score_pairs", f"WITH {PAIRS_SQL} SELECT message_id, fact_id, round(score, 6) AS score FROM scored")
def score_pairs(spark, folder):
    pairs, claims, _, messages = vector_tables(Tables(spark, folder))
    return rounded(scoring.score_pairs(pairs, claims, messages), "score")


def _vectors_sql(name: str, source: str, id_: str) -> str:
    return f"""
    {name}_w AS (SELECT {id_} AS id, unnest({TOKENS_SQL.format('text')}) AS word FROM {source}),
    {name}_c AS (SELECT id, ('0x' || md5(word)[1:4])::BIGINT % 64 AS slot, count(*) AS tf FROM {name}_w GROUP BY 1, 2),
    {name}_d AS (SELECT slot, count(*) AS df FROM {name}_c GROUP BY 1),
    {name} AS (SELECT id, slot, tf * ln(((SELECT count(*) FROM {source}) + 1) / (df + 1)) AS w FROM {name}_c JOIN {name}_d USING (slot))
    """


def text_vectors(df, id_: str):
    slot = F.conv(F.substring(F.md5("word"), 1, 4), 16, 10).cast("bigint")
    return scoring.hashed_vectors(df, id_, text.corpus_tokens("text"), 64, slot)


@query(
    "M1_score_search_hits",
    f"""
    WITH {FEATURE_WORDS_SQL}, k AS (SELECT fact_id, unnest(list_filter(keywords, lambda x: x NOT IN ('and', 'or'))) AS word FROM kw),
    hits AS (SELECT fact_id, message_id FROM k JOIN words USING (word) GROUP BY 1, 2 HAVING count(*) >= 3),
    {_vectors_sql('cv', 'benchmark', 'item_id')}, {_vectors_sql('mv', 'documents', 'doc_id')},
    cn AS (SELECT id, sqrt(sum(w * w)) AS n FROM cv GROUP BY 1), mn AS (SELECT id, sqrt(sum(w * w)) AS n FROM mv GROUP BY 1),
    dots AS (SELECT fact_id, message_id, sum(cv.w * mv.w) AS d FROM hits JOIN cv ON cv.id = fact_id
             JOIN mv ON mv.id = message_id AND mv.slot = cv.slot GROUP BY 1, 2)
    SELECT fact_id, message_id, round(coalesce(d, 0) / (cn.n * mn.n), 5) AS score
    FROM hits LEFT JOIN dots USING (fact_id, message_id) JOIN cn ON cn.id = fact_id JOIN mn ON mn.id = message_id
    """,
)
def score_search_hits(spark, folder):
    t = Tables(spark, folder)
    messages = document_messages(t)
    words = search.token_table(messages, text.corpus_tokens("text"))
    hits = search.keyword_search(benchmark_features(t), words).select("fact_id", "message_id")
    claims = text_vectors(t.benchmark.select(F.col("item_id").alias("fact_id"), "text"), "fact_id")
    scored = scoring.score_pairs(hits, claims, text_vectors(messages, "message_id"))
    return rounded(scored, "score", digits=5)


@query(
    "M2_classify",
    f"""
    WITH {PAIRS_SQL} SELECT message_id, fact_id, CASE WHEN round(score, 6) > 0.29 THEN 'on-topic' ELSE 'off-topic' END AS topic_relation,
      CASE WHEN round(score, 6) > 0.05 THEN 'on-claim' ELSE 'off-claim' END AS claim_relation FROM scored
    """,
)
def classify(spark, folder):
    return classified(Tables(spark, folder)).select("message_id", "fact_id", "topic_relation", "claim_relation")


def classified(t: Tables):
    pairs, claims, _, messages = vector_tables(t)
    scored = rounded(scoring.score_pairs(pairs, claims, messages), "score")
    labelled = scoring.classify(scored, "topic_relation", "news")
    return scoring.classify(labelled, "claim_relation", threshold=0.05)


@query(
    "M2_last_label",
    """
    WITH l AS (SELECT event_id, user_id, ['a', 'b'][(user_id % 2) + 1] AS label FROM events)
    SELECT floor(value)::BIGINT AS message_id, arg_max(label, user_id) AS topic_relation FROM l JOIN events USING (event_id, user_id) GROUP BY 1
    """,
)
def last_label(spark, folder):
    labelled = Tables(spark, folder).events.select(
        F.floor("value").alias("message_id"),
        F.col("user_id").alias("fact_id"),
        F.when(F.col("user_id") % 2 == 0, "a").otherwise("b").alias("topic_relation"),
    )
    return scoring.last_label(labelled, "topic_relation")


@query(
    "M2_mark_done",
    """
    SELECT o_orderkey AS fact_id, CASE WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45) THEN '2024-02-01'
      WHEN o_orderstatus = 'P' THEN strftime(o_orderdate, '%Y-%m-%d') END AS done_on FROM orders
    """,
)
def mark_done(spark, folder):
    t = Tables(spark, folder)
    features = t.claims.withColumn("done_at", F.when(F.col("calification") == "P", F.col("date")))
    labelled = t.lineitem.where(F.col("l_quantity") > 45).select(F.col("l_orderkey").alias("fact_id"))
    marked = scoring.mark_done(features, labelled, "done_at", "2024-02-01")
    return marked.select("fact_id", times.day_text("done_at").alias("done_on"))


@query(
    "M3_classify_finer",
    f"""
    WITH {PAIRS_SQL} SELECT message_id, fact_id,
      CASE WHEN round(score, 9) > round(review_score, 9) THEN 'disseminates' ELSE 'not-disseminates' END AS claim_finer_relation
    FROM scored WHERE round(score, 6) > 0.05
    """,
)
def classify_finer(spark, folder):
    t = Tables(spark, folder)
    _, claims, reviews, messages = vector_tables(t)
    finer = scoring.classify_finer(classified(t).drop("score"), claims, reviews, messages)
    return finer.select("message_id", "fact_id", "claim_finer_relation")


@query(
    "M4_related_messages",
    """
    WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v, ts FROM embeddings JOIN events ON event_id = vec_id),
    c AS (SELECT label AS fact_id, arg_min(v, vec_id) AS v, arg_min(ts, vec_id) AS claim_date FROM e GROUP BY 1),
    d AS (SELECT fact_id, vec_id AS message_id, round(1 - list_cosine_similarity(c.v, e.v), 6) AS distance
          FROM e JOIN c ON e.label = c.fact_id AND e.ts > claim_date - INTERVAL 1 DAY AND e.ts < claim_date + INTERVAL 1 DAY),
    r AS (SELECT *, row_number() OVER (PARTITION BY fact_id ORDER BY distance, message_id)::INT AS near,
      row_number() OVER (PARTITION BY fact_id ORDER BY distance DESC, message_id DESC)::INT AS far FROM d)
    SELECT fact_id, message_id, distance, near AS rank, 'related' AS side FROM r WHERE near <= 5
    UNION ALL SELECT fact_id, message_id, distance, far, 'not related' FROM r WHERE far <= 5
    """,
)
def related_messages(spark, folder):
    t = Tables(spark, folder)
    e = t.embeddings.join(t.events, F.col("event_id") == F.col("vec_id")).select(
        F.col("vec_id").alias("message_id"),
        F.col("label").cast("bigint").alias("fact_id"),
        F.col("ts").alias("date"),
        F.col("embedding").alias("vector"),
    )
    first = F.min_by(F.struct("date", "vector"), "message_id").alias("first")
    claims = e.groupBy("fact_id").agg(first).select(
        "fact_id", F.col("first.date").alias("claim_date"), F.col("first.vector").alias("vector")
    )
    out = scoring.related_messages(
        claims.select("fact_id", "claim_date"),
        e.select("message_id", "date"),
        claims,
        e.select("message_id", "vector"),
        1,
        links=e.select("message_id", "fact_id"),
    )
    return rounded(out, "distance").select("fact_id", "message_id", "distance", "rank", "side")


EVALUATED_SQL = """
    g AS (SELECT doc_id, CASE WHEN quality = 1 AND toxic = 1 THEN 'disseminates' WHEN quality = 1 THEN 'not-disseminates' END AS finer,
            CASE WHEN quality = 1 THEN 'on-topic' ELSE 'off-topic' END AS topic, n_chars > 1000 AS long, lang
          FROM labels JOIN documents USING (doc_id)),
    pairs AS (
      SELECT 'topic' AS task, topic AS gold, CASE WHEN long THEN 'on-topic' ELSE 'off-topic' END AS predicted FROM g
      UNION ALL SELECT 'claim', replace(topic, 'topic', 'claim'), CASE WHEN long THEN 'on-claim' ELSE 'off-claim' END FROM g
      UNION ALL SELECT 'finer', finer, CASE WHEN long THEN 'disseminates' ELSE 'not-disseminates' END FROM g
        WHERE finer IS NOT NULL AND lang = 'en')
"""
TASKS = {
    "topic": ("topic_relation", lb.TOPIC_OF_LABEL),
    "claim": ("claim_relation", lb.CLAIM_OF_LABEL),
    "finer": ("claim_finer_relation", lb.FINER_OF_LABEL),
}


@query("M5_evaluate", f"WITH {EVALUATED_SQL}, {report_sql('pairs', 'task')}")
def evaluate(spark, folder):
    gold, predicted = gold_tables(Tables(spark, folder))
    out = None
    for name, (task, mapping) in TASKS.items():
        report = scoring.evaluate(gold, predicted, task, mapping)[1].withColumn("task", F.lit(name))
        out = report if out is None else out.unionByName(report)
    return rounded(out, "precision", "recall", "f1")


@query("M5_evaluate_cells", f"WITH {EVALUATED_SQL} SELECT task, gold, predicted, count(*) AS n FROM pairs GROUP BY 1, 2, 3")
def evaluate_cells(spark, folder):
    gold, predicted = gold_tables(Tables(spark, folder))
    out = None
    for name, (task, mapping) in TASKS.items():
        cells = scoring.evaluate(gold, predicted, task, mapping)[0].withColumn("task", F.lit(name))
        out = cells if out is None else out.unionByName(cells)
    return out


def model_scores(t: Tables):
    """Two similarity models per source: share of long text and inverse size."""
    joined = t.labels.join(t.documents, "doc_id")
    n = F.col("n_chars")
    models = F.array(
        F.struct(F.lit("size").alias("model"), F.round(n / (n + 1000), 6).alias("score")),
        F.struct(F.lit("inverse").alias("model"), F.round(F.lit(100.0) / (n + 100), 6).alias("score")),
    )
    return joined.select(
        F.col("lang").alias("source"),
        F.col("quality").alias("target"),
        (F.col("quality") + 0.5 * F.col("toxic")).cast("double").alias("ordinal"),
        F.inline(models),
    )


SCORES_SQL = """
    base AS (SELECT lang AS source, quality AS target, (quality + 0.5 * toxic)::DOUBLE AS ordinal, n_chars::DOUBLE AS n
             FROM labels JOIN documents USING (doc_id)),
    scores AS (SELECT 'size' AS model, source, target, ordinal, round(n / (n + 1000), 6) AS score FROM base
               UNION ALL SELECT 'inverse', source, target, ordinal, round(100 / (n + 100), 6) FROM base)
"""
TUNED_SQL = """
    m AS (SELECT model, source, avg(score) FILTER (WHERE target = 1) AS hi, avg(score) FILTER (WHERE target = 0) AS lo FROM scores GROUP BY 1, 2),
    c AS (SELECT model, source, i, CASE i WHEN 0 THEN lo WHEN 1 THEN hi ELSE lo + (hi - lo) / 5 * (i - 1) END AS t
          FROM m, range(6) r(i) WHERE i < 2 OR hi >= lo),
    q AS (SELECT c.model, c.source, i, t,
      count(*) FILTER (WHERE score > t AND target = 1) AS tp, count(*) FILTER (WHERE score > t AND target = 0) AS fp,
      count(*) FILTER (WHERE score <= t AND target = 0) AS tn, count(*) FILTER (WHERE score <= t AND target = 1) AS fn
      FROM c JOIN scores s ON s.model = c.model AND s.source = c.source GROUP BY 1, 2, 3, 4),
    p AS (SELECT *, (CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END + CASE WHEN tn + fn > 0 THEN tn / (tn + fn) ELSE 0 END)
            / ((tp + fp + fn > 0)::INT + (tn + fn + fp > 0)::INT) AS quality FROM q),
    tuned AS (SELECT model, source, CASE WHEN any_value(hi) IS NOT NULL AND any_value(lo) IS NOT NULL THEN arg_max(t, (quality, -i)) END AS threshold,
      CASE WHEN any_value(hi) IS NOT NULL AND any_value(lo) IS NOT NULL THEN max(quality) END AS quality
      FROM p JOIN m USING (model, source) GROUP BY 1, 2)
"""


@query("A26_mean_scores", f"WITH {SCORES_SQL} SELECT model, ordinal AS label, round(avg(score), 6) AS mean_score, count(*) AS n FROM scores GROUP BY 1, 2")
def mean_scores(spark, folder):
    scores = model_scores(Tables(spark, folder)).withColumnRenamed("ordinal", "label")
    return rounded(scoring.mean_scores(scores, "label", ("model",)), "mean_score")


@query("A27_score_correlation", f"WITH {SCORES_SQL} SELECT model, round(CASE WHEN stddev_pop(ordinal) > 0 THEN corr(score, ordinal) END, 6) AS correlation FROM scores GROUP BY 1")
def score_correlation(spark, folder):
    return rounded(scoring.score_correlation(model_scores(Tables(spark, folder)), keys=("model",)), "correlation")


@query(
    "A28_tune_threshold",
    f"WITH {SCORES_SQL}, {TUNED_SQL} SELECT model, source, round(threshold, 6) AS threshold, round(quality, 6) AS quality FROM tuned",
)
def tune_threshold(spark, folder):
    return rounded(scoring.tune_threshold(model_scores(Tables(spark, folder)), ("model", "source")), "threshold", "quality")


@query(
    "M6_compare_models",
    f"""
    WITH {SCORES_SQL}, {TUNED_SQL}, r AS (SELECT model, source, CASE WHEN stddev_pop(ordinal) > 0 THEN corr(score, ordinal) END AS correlation FROM scores GROUP BY 1, 2)
    SELECT model, source, round(threshold, 6) AS threshold, round(quality, 6) AS quality, round(correlation, 6) AS correlation
    FROM tuned JOIN r USING (model, source)
    """,
)
def compare_models(spark, folder):
    return rounded(scoring.compare_models(model_scores(Tables(spark, folder))), "threshold", "quality", "correlation")


@query(
    "M7_compare_three_way",
    f"""
    WITH three AS (SELECT lang AS model, CASE WHEN quality = 1 AND toxic = 1 THEN 'entailment' WHEN quality = 1 THEN 'contradiction' ELSE 'neutral' END AS gold,
      CASE WHEN n_chars > 2500 THEN 'entailment' WHEN n_chars > 1000 THEN 'contradiction' ELSE 'neutral' END AS predicted
      FROM labels JOIN documents USING (doc_id)),
    {report_sql('three', 'model')}
    """,
)
def compare_three_way(spark, folder):
    t = Tables(spark, folder)
    good, toxic, n = F.col("quality") == 1, F.col("toxic") == 1, F.col("n_chars")
    predictions = t.labels.join(t.documents, "doc_id").select(
        F.col("lang").alias("model"),
        F.when(good & toxic, "entailment").when(good, "contradiction").otherwise("neutral").alias("gold"),
        F.when(n > 2500, "entailment").when(n > 1000, "contradiction").otherwise("neutral").alias("predicted"),
    )
    return rounded(scoring.compare_three_way(predictions), "precision", "recall", "f1")


@query(
    "M8_entity_table",
    f"""
    WITH {GAZETTEER_SQL}
    SELECT doc_id AS fact_id, coalesce(string_agg(word, '|' ORDER BY word) FILTER (WHERE tag = 'ENT'), '') AS entities,
      coalesce(string_agg(word, '|' ORDER BY word) FILTER (WHERE tag = 'CLAIM'), '') AS known
    FROM documents LEFT JOIN tagged_spans USING (doc_id) GROUP BY 1
    """,
)
def entity_table(spark, folder):
    t = Tables(spark, folder)
    runs = t.benchmark.select(F.explode(text.capitalised_runs("text")).alias("span"))
    gazetteer = runs.select(text.clean_word("span").alias("word")).distinct().withColumn("tag", F.lit("CLAIM"))
    claims = t.documents.select(
        F.col("doc_id").alias("fact_id"), F.col("text").alias("claim"), F.lit(None).cast("string").alias("review")
    )
    table = entities.entity_table(claims, gazetteer)

    def words(tag: str):
        return F.coalesce(F.array_join(F.col("ner_claim")[tag], "|"), F.lit(""))

    return table.select("fact_id", words("ENT").alias("entities"), words("CLAIM").alias("known"))


def reply_tree(t: Tables):
    """Conversations as comment trees: turn n answers turn n // 2."""
    node = F.concat_ws("-", "conv_id", "turn")
    parent = F.when(F.col("turn") > 0, F.concat_ws("-", F.col("conv_id"), F.floor(F.col("turn") / 2)))
    return t.conversations.select(node.alias("id"), F.when(F.col("turn") > 0, parent).alias("parent_id"))


@query(
    "M9_thread_table",
    """
    WITH RECURSIVE n AS (SELECT conv_id || '-' || turn AS id, CASE WHEN turn > 0 THEN conv_id || '-' || (turn // 2) END AS parent FROM conversations),
    tree AS (
      SELECT id, parent, id AS root, 0 AS depth FROM n WHERE parent IS NULL
      UNION ALL SELECT n.id, n.parent, root, depth + 1 FROM n JOIN tree ON n.parent = tree.id),
    r AS (SELECT parent AS id, count(*) AS replies FROM n WHERE parent IS NOT NULL GROUP BY 1)
    SELECT tree.id, parent, root, depth, coalesce(replies, 0) AS replies FROM tree LEFT JOIN r USING (id)
    """,
)
def thread_table(spark, folder):
    return threads.thread_table(reply_tree(Tables(spark, folder)))


@query(
    "M9_reply_counts",
    """
    SELECT conv_id AS channel, 0::BIGINT AS top_id, count(*) AS replies, max(turn) AS last_reply FROM conversations
    WHERE turn > 0 AND conv_id IN (SELECT conv_id FROM conversations WHERE turn = 0) GROUP BY 1
    """,
)
def reply_counts(spark, folder):
    from .queries_joins import chat

    return threads.reply_counts(threads.replies_of(chat(Tables(spark, folder))))


def _letter_encoder():
    """Counts of five letters: a tiny stand-in for a sentence encoder."""

    def encode(part: pd.Series) -> pd.Series:
        return part.map(lambda s: [float(s.count(c)) for c in "aeiou"])

    return encode


@query(
    "G1_vectors_by_plugin",
    "SELECT doc_id, "
    + ", ".join(f"(length(text) - length(replace(text, '{c}', '')))::DOUBLE AS {c}" for c in "aeiou")
    + " FROM documents",
)
def vectors_by_plugin(spark, folder):
    out = plugins.vectors_by(Tables(spark, folder).documents, "doc_id", "text", _letter_encoder)
    return out.select("doc_id", *[F.col("vector")[i].cast("double").alias(c) for i, c in enumerate("aeiou")])


def _ending_tagger():
    """Words by ending: a tiny stand-in for a trained tagger."""
    endings = {"tion": "NOUN", "ble": "ADJ", "ing": "VERB"}

    def tag(value: str) -> list[tuple[str, str]]:
        return [(t, w) for w in value.split() for e, t in endings.items() if w.endswith(e)]

    return tag


@query(
    "G2_tags_by_plugin",
    r"""
    WITH w AS (SELECT doc_id, unnest(string_split_regex(text, '\s+')) AS word FROM documents)
    SELECT doc_id, word, CASE WHEN word LIKE '%tion' THEN 'NOUN' WHEN word LIKE '%ble' THEN 'ADJ' ELSE 'VERB' END AS tag FROM w
    WHERE word LIKE '%tion' OR word LIKE '%ble' OR word LIKE '%ing'
    """,
)
def tags_by_plugin(spark, folder):
    return plugins.tags_by(Tables(spark, folder).documents, "doc_id", "text", _ending_tagger)


def _peak(part: pd.DataFrame) -> pd.DataFrame:
    top = part.sort_values(["count", "day_offset"], ascending=[False, True]).iloc[0]
    return pd.DataFrame([{"fact_id": top["fact_id"], "peak_day": top["day_offset"], "peak": top["count"]}])


@query(
    "G3_per_claim_plugin",
    f"""
    WITH {CHECKED_SQL}, {OFFSET_SQL}, c AS (SELECT fact_id, day_offset, count(*) AS n FROM offsets GROUP BY 1, 2)
    SELECT fact_id, arg_max(day_offset, (n, -day_offset)) AS peak_day, max(n) AS peak FROM c GROUP BY 1
    """,
)
def per_claim_plugin(spark, folder):
    series = aggregates.count_by(with_offsets(Tables(spark, folder)), "fact_id", "day_offset")
    return plugins.per_claim(series, "fact_id", _peak, "fact_id bigint, peak_day bigint, peak bigint")


@query(
    "G4_day_windows_function",
    """
    SELECT user_id AS fact_id, strftime(min(ts)::DATE + to_days(i::INT), '%Y-%m-%d') AS day FROM events, range(-2, 3) t(i) GROUP BY user_id, i
    """,
)
def day_windows_function(spark, folder):
    plugins.register_day_windows(spark)
    claims = Tables(spark, folder).dated.groupBy("fact_id").agg(F.min("date").cast("timestamp").alias("date"))
    rows = spark.sql(
        "SELECT c.fact_id, w.day_start FROM {claims} c, LATERAL day_windows(c.date, 2, 2) w", claims=claims
    )
    return rows.select("fact_id", times.day_text("day_start").alias("day"))


DAYS = {"2024-01-20": "2024-01-03", "2024-02-01": "2024-01-15"}  # each day, and from when on its claims get labels
DAILY = daily.Settings(messages_per_day=3, news_per_day=2, topic_threshold=0.2, claim_threshold=0.35, news_threshold=0.25)
_FIRST, _SECOND = DAYS
DAILY_SQL = f"""
    {FEATURE_WORDS_SQL},
    c AS (
      SELECT kw.*, DATE '2024-01-01' + (fact_id % 31)::INT AS day, fact_id % 5 = 0 AS fine,
        CASE WHEN fact_id % 5 = 0 THEN NULL WHEN day < DATE '{_FIRST}' - 8 AND fact_id % 2 = 0 THEN '{_FIRST}'
          WHEN day < DATE '{_SECOND}' - 8 THEN '{_SECOND}' END AS searched_on,
        CASE searched_on WHEN '{_FIRST}' THEN CASE WHEN day >= DATE '{DAYS[_FIRST]}' THEN '{_FIRST}' WHEN day >= DATE '{DAYS[_SECOND]}' THEN '{_SECOND}' END
          WHEN '{_SECOND}' THEN CASE WHEN day >= DATE '{DAYS[_SECOND]}' THEN '{_SECOND}' END END AS labelled_on
      FROM kw
    ),
    m AS (SELECT doc_id AS id, DATE '2024-01-01' + (doc_id % 37)::INT AS mday FROM documents),
    k AS (SELECT fact_id, day, len(a) AS n, unnest(a) AS word FROM (
      SELECT *, list_filter(keywords, lambda x: x NOT IN ('and', 'or')) AS a FROM c WHERE searched_on IS NOT NULL)),
    hits AS (
      SELECT * FROM (SELECT fact_id, id AS message_id, mday FROM k JOIN words USING (word) JOIN m ON id = message_id
        WHERE mday BETWEEN day - 7 AND day + 7 GROUP BY 1, 2, 3 HAVING count(DISTINCT word) >= least(3, any_value(n)))
      QUALIFY row_number() OVER (PARTITION BY fact_id, mday ORDER BY message_id) <= {DAILY.messages_per_day}
    ),
    kn AS (SELECT fact_id, day, unnest(keywords[1:{DAILY.news_keywords}]) AS word FROM c WHERE searched_on IS NOT NULL AND len(keywords) >= 3),
    found AS (
      SELECT fact_id, id AS news_id, mday FROM kn JOIN words USING (word) JOIN m ON id = message_id
      WHERE mday BETWEEN day - 7 AND day + 6 GROUP BY 1, 2, 3 HAVING count(DISTINCT word) >= 3
    ),
    news AS (
      SELECT *, count(*) OVER (PARTITION BY fact_id, mday) AS query_output FROM found
      QUALIFY row_number() OVER (PARTITION BY fact_id, mday ORDER BY news_id) <= {DAILY.news_per_day}
    ),
    {_vectors_sql('cv', 'benchmark', 'item_id')}, {_vectors_sql('mv', 'documents', 'doc_id')},
    cn AS (SELECT id, sqrt(sum(w * w)) AS n FROM cv GROUP BY 1), mn AS (SELECT id, sqrt(sum(w * w)) AS n FROM mv GROUP BY 1),
    pairs AS (SELECT fact_id, message_id AS id FROM hits UNION SELECT fact_id, news_id FROM news),
    scores AS (
      SELECT fact_id, p.id, coalesce(sum(cv.w * mv.w), 0) / any_value(cn.n * mn.n) AS score FROM pairs p JOIN cn ON cn.id = fact_id
      JOIN mn ON mn.id = p.id JOIN mv ON mv.id = p.id LEFT JOIN cv ON cv.id = fact_id AND cv.slot = mv.slot GROUP BY 1, 2
    ),
    reviews AS (
      SELECT fact_id, p.id, coalesce(sum(rv.w * mv.w), 0) / any_value(rn.n * mn.n) AS review FROM pairs p JOIN mn rn ON rn.id = fact_id
      JOIN mn ON mn.id = p.id JOIN mv ON mv.id = p.id LEFT JOIN mv rv ON rv.id = fact_id AND rv.slot = mv.slot GROUP BY 1, 2
    )"""


def daily_tables(spark, folder) -> VersionedTables:
    """Two days, each started twice, the second once more under another name."""
    t = Tables(spark, folder)
    first = F.lit("2024-01-01").cast("date")
    # texts of claims only, so that the others are not shuffled
    reviews = t.documents.select(F.col("doc_id").alias("fact_id"), F.col("text").alias("review"))
    reviews = reviews.join(t.benchmark.select(F.col("item_id").alias("fact_id")), "fact_id", "left_semi")
    claims = t.benchmark.select(
        F.col("item_id").alias("fact_id"),
        F.col("text").alias("claim"),
        F.date_add(first, (F.col("item_id") % 31).cast("int")).cast("timestamp").alias("date"),
        F.when(F.col("item_id") % 5 == 0, "Verdadero").otherwise("Falso").alias("calification"),
    ).join(reviews, "fact_id", "left")
    day = F.date_add(first, (F.col("doc_id") % 37).cast("int")).cast("timestamp").alias("date")
    messages = t.documents.select(F.col("doc_id").alias("message_id"), day, "text")
    news = t.documents.select(F.col("doc_id").alias("news_id"), day, F.col("text").alias("Title"))
    own = stored(text_vectors(messages, "message_id"), "vectors")
    vectors = {
        "claims": stored(text_vectors(t.benchmark.select(F.col("item_id").alias("fact_id"), "text"), "fact_id"), "vectors"),
        "reviews": own.withColumnRenamed("message_id", "fact_id"),
        "messages": own,
        "news": own.withColumnRenamed("message_id", "news_id"),
    }
    tables = VersionedTables(spark, scratch_path(spark, "daily"))
    work = daily.DailyRun(tables, DAILY)
    arrived = {_FIRST: claims.where(F.col("fact_id") % 2 == 0), _SECOND: claims}
    for name in (_FIRST, _FIRST, _SECOND, _SECOND, f"{_SECOND} again"):
        now = name[:10]
        work.run(name, now, DAYS[now], arrived[now], messages, news, daily.simple_keywords, vectors)
    return tables


@query(
    "daily_run",
    f"""
    WITH {DAILY_SQL}
    SELECT c.fact_id, searched_on, searched_on AS filtered_on, CASE WHEN message_id IS NOT NULL THEN labelled_on END AS labelled_on, message_id,
      CASE WHEN labelled_on IS NOT NULL THEN round(score, 5) END AS score,
      CASE WHEN labelled_on IS NOT NULL THEN CASE WHEN score > 0.2 THEN 'on-topic' WHEN score IS NOT NULL THEN 'off-topic' END END AS topic_relation,
      CASE WHEN labelled_on IS NOT NULL THEN CASE WHEN score > 0.35 THEN 'on-claim' WHEN score IS NOT NULL THEN 'off-claim' END END AS claim_relation,
      CASE WHEN labelled_on IS NOT NULL AND score > 0.35 THEN CASE WHEN round(score, 9) > round(review, 9) THEN 'disseminates' ELSE 'not-disseminates' END
        END AS claim_finer_relation
    FROM c LEFT JOIN hits USING (fact_id) LEFT JOIN scores ON scores.fact_id = c.fact_id AND scores.id = message_id
      LEFT JOIN reviews r ON r.fact_id = c.fact_id AND r.id = message_id
    """,
)
def daily_run(spark, folder):
    """Every claim with its marks, and its messages with their labels."""
    tables = daily_tables(spark, folder)
    labels = tables.table("message_labels")
    pairs = tables.table("message_pairs").select("fact_id", "message_id").join(labels, ["fact_id", "message_id"], "left")
    rows = tables.table("features").join(pairs, "fact_id", "left")
    marks = {"searched_on": "messages_searched_at", "filtered_on": "news_filtered_at", "labelled_on": "messages_labelled_at"}
    dated = rows.select("fact_id", *[times.day_text(m).alias(n) for n, m in marks.items()], *pairs.columns[1:])
    # a claim without messages is marked too
    dated = dated.withColumn("labelled_on", F.when(F.col("message_id").isNotNull(), F.col("labelled_on")))
    return rounded(dated, "score", digits=5)


@query(
    "daily_run_news",
    f"""
    WITH {DAILY_SQL}
    SELECT news.fact_id, news_id, query_output, searched_on,
      coalesce(len(list_intersect(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}]+(?:[-''.][\\p{{L}}\\p{{N}}]+)*'), keywords)) > 0, false) AS keywords_in_title,
      CASE WHEN labelled_on IS NOT NULL THEN round(score, 5) END AS score,
      CASE WHEN labelled_on IS NOT NULL THEN CASE WHEN score > 0.25 THEN 'on-topic' ELSE 'off-topic' END END AS topic_relation
    FROM news JOIN c USING (fact_id) JOIN documents ON doc_id = news_id LEFT JOIN scores ON scores.fact_id = news.fact_id AND id = news_id
    """,
)
def daily_run_news(spark, folder):
    tables = daily_tables(spark, folder)
    marks = tables.table("features").select("fact_id", times.day_text("news_searched_at").alias("searched_on"))
    rows = tables.table("news_pairs").join(tables.table("news_labels"), ["fact_id", "news_id"], "left").join(marks, "fact_id")
    return rounded(rows.drop("date"), "score", digits=5)

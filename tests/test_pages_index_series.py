"""Comments of odd pages, the phrase index against plain search, series in pieces, table function, totals, payloads."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimtide import plugins
from claimtide.functions import payloads, text
from claimtide.operators import aggregates, search, statistics
from claimtide.operators.index import PhraseIndex
from claimtide.session import scratch_path, stored
from claimtide.sources import readers


def comment(number, body="text", more="", answers="", cls="comment"):
    identity = f'data-id="comment-{number}"' if number is not None else ""
    inner = f'<div class="comment-body"><div class="comment-header"><a class="comment-order">#{number}</a></div><div class="comment-text">{body}</div></div>'
    childs = f'<div class="threader-childs">{answers}</div>' if answers else ""
    return f'<div class="threader"> <div class="{cls}" {identity}{more}>{inner}</div>{childs}</div>'


def tree(spark, html):
    pages = spark.createDataFrame([(1, html)], "page_id int, html string")
    rows = readers.extract_comments(pages).orderBy("at").collect()
    return [(r.comment_id, r.parent_id, r.position) for r in rows]


def test_parents_of_comments(spark):
    deep = comment(1, answers=comment(2, answers=comment(3) + comment(4)) + comment(5))
    assert tree(spark, f"<html><div><div>{deep}{comment(6)}</div></div></html>") == [
        ("1", None, 1), ("2", "1", 1), ("3", "2", 1), ("4", "2", 2), ("5", "1", 2), ("6", None, 2),
    ]
    # a list that ends and another one, deeper in the page, whose comments answer nothing
    two = f"<div>{comment(1)}</div><div><div><div>{comment(2)}</div></div></div>"
    assert tree(spark, two) == [("1", None, 1), ("2", None, 2)]
    # the answer stands as deep as one to the first comment would, but that one's thread is closed
    closed = f"<div>{comment(1)}<div><div>{comment(2)}</div></div></div>"
    assert tree(spark, closed) == [("1", None, 1), ("2", None, 2)]
    # without an id: left out, its answers stand at the top
    assert tree(spark, comment(None, answers=comment(2, answers=comment(3)))) == [("2", None, 1), ("3", "2", 1)]
    # not in a thread
    assert tree(spark, '<div class="x"><div class="comment" data-id="comment-1"></div></div>') == []


def test_fields_of_comments(spark):
    body = 'see <a class="tooltip" href="#">#12</a> and <a class="tooltip">#3</a> &lt;b&gt; <b>bold</b>\n'
    html = comment(7, body, cls="comment negative phantom")
    html = html.replace("</div></div></div>", '</div></div><div class="comment-footer"><span title="Votos"> 5 </span><span title="Karma">K 42</span></div></div>', 1)
    pages = spark.createDataFrame([(1, html), (2, None), (3, ""), (4, "<p>no comments</p>")], "page_id int, html string")
    (row,) = readers.extract_comments(pages).collect()
    assert (row.page_id, row.internal_id, row.votes, row.karma, row.negative, row.hidden) == (1, 7, 5, 42, True, True)
    assert row.replies_to == [12, 3] and row.text == "see  and  <b> bold" and row.author is None and row.created_epoch is None


WORDS = ["red", "green", "blue", "sky", "sea", "the", "a"]


def test_phrase_index_equals_plain_search(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choice(WORDS) for _ in range(rng.randrange(0, 40))) for _ in range(120)] + [None, "", "red"]
    days = [f"2024-01-{1 + i % 20:02d}" for i in range(len(texts))]
    messages = spark.createDataFrame([(i, d, t) for i, (t, d) in enumerate(zip(texts, days))], "message_id long, date string, text string")
    messages = messages.withColumn("date", F.col("date").cast("date"))
    claims = [
        (1, ["red green", "the sky", "sea"], "2024-01-05"), (2, ["blue blue", "a"], "2024-01-10"), (3, ["none of these", "red"], "2024-01-10"),
        (4, ["the the the"], "2024-01-01"), (5, [], "2024-01-01"), (6, ["sky sea", "sky sea", "red red green"], "2024-01-15"), (7, ["absent"], "2024-01-01"),
    ]
    features = spark.createDataFrame(claims, "fact_id long, keywords array<string>, claim_date string").withColumn("claim_date", F.col("claim_date").cast("date"))
    tokens = text.corpus_tokens("text")
    index = PhraseIndex(spark, scratch_path(spark, "index"), buckets=5, fan=2)
    assert index.search(features, 1).count() == 0
    for part in range(4):
        index.add(f"part {part}", messages.where(F.col("message_id") % 4 == part), tokens)
        index.add(f"part {part}", messages.where(F.col("message_id") % 4 == part), tokens)
    for need, short, window in [(1, "none", None), (2, "none", None), (2, "all", None), (2, "all", (3, 2)), (3, "none", (30, 30))]:
        plain = search.claim_search(features, messages, tokens, F.array_join(tokens, " "), need, short, window)
        got = sorted(map(tuple, index.search(features, need, short, window).select("fact_id", "message_id", "matched").collect()))
        assert got == sorted(map(tuple, plain.select("fact_id", "message_id", "matched").collect()))
    assert index.search(features, 2).count() > 20


def test_series_in_pieces(spark):
    rng = np.random.default_rng(1)
    rows = [(k, int(t), float(v)) for k in ("a", "b") for t, v in enumerate(rng.normal(size=57))] + [(None, 3, 1.0), (None, 9, 2.5)]
    series = spark.createDataFrame(rows, "k string, t int, v double")
    for piece in (11, 13, 1000):
        got = {(r.k, r.t): (r.rolling_mean, r.rolling_std) for r in statistics.rolling(series, "t", "v", ["k"], 12, piece).collect()}
        for k in ("a", "b"):
            v = [x for key, _, x in rows if key == k]
            for t in range(57):
                mean, std = got[k, t]
                assert (mean is None) == (t < 11)
                if mean is not None:
                    assert mean == pytest.approx(np.mean(v[t - 11 : t + 1])) and std == pytest.approx(np.std(v[t - 11 : t + 1], ddof=1))
        assert got[None, 9] == (None, None)
        diffs = {(r.k, r.t): r["diff"] for r in statistics.differenced(series, "t", "v", ["k"], 2 if piece == 11 else piece).collect()}
        assert len(diffs) == 56 * 2 + 1 and diffs[None, 9] == 1.5 and diffs["a", 5] == pytest.approx(rows[5][2] - rows[4][2])
        one = series.where("k = 'a'")
        acf = [r.acf for r in statistics.autocorrelation(one, "t", "v", 10, piece).orderBy("lag").collect()]
        c = np.array([x for key, _, x in rows if key == "a"])
        c = c - c.mean()
        assert acf == pytest.approx([(c[k:] * c[:-k]).sum() / (c * c).sum() for k in range(1, 11)])


def test_day_windows(spark):
    plugins.register_day_windows(spark)
    rows = spark.sql("SELECT * FROM VALUES (1, TIMESTAMP'2024-03-01 13:00:00'), (2, NULL) AS c(id, at), LATERAL day_windows(at, 1, 1) ORDER BY id, day_start")
    assert [(r.id, str(r.day_start)[:10], str(r.day_end)[:10]) for r in rows.collect()] == [
        (1, "2024-02-29", "2024-03-01"), (1, "2024-03-01", "2024-03-02"), (1, "2024-03-02", "2024-03-03"),
    ]
    assert "Python" not in rows._jdf.queryExecution().toString()


def test_run_summary_is_counted_while_writing(spark):
    hits = spark.createDataFrame([(1, "2024-01-01 10:00:00"), (1, "2024-01-03 12:00:00")], "fact_id int, date string").withColumn("date", F.col("date").cast("timestamp"))
    summary = aggregates.RunSummary()
    stored(summary.of_claims(hits.select("fact_id").distinct()))
    stored(summary.of_hits(hits))
    row = summary.row(spark).first()
    assert (row.claims, row.messages, str(row["first"]), str(row["last"])) == (1, 2, "2024-01-01 10:00:00", "2024-01-03 12:00:00")
    empty = aggregates.RunSummary()
    stored(empty.of_claims(hits.where("false")))
    stored(empty.of_hits(hits.where("false")))
    assert tuple(empty.row(spark).first()) == (0, 0, None, None)


def test_payloads(spark):
    texts = ['{"a": 1, "b": {"c": [1, 2.5]}}', '{"a": "x"}', "[3]", "no", None, "7"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", payloads.parsed("t").alias("v"))
    got = rows.select("i", payloads.field("v", "$.a", "int"), payloads.field("v", "$.b.c[1]", "double"), payloads.field("v", "$[0]", "int"), F.col("v").isNotNull())
    assert [tuple(r)[1:] for r in got.orderBy("i").collect()] == [
        (1, 2.5, None, True), (None, None, None, True), (None, None, 3, True), (None, None, None, False), (None, None, None, False), (None, None, None, True),
    ]

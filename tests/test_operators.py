"""Operators on hand-made rows and against brute force."""

import itertools
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from claimtide import plugins
from claimtide.operators import (
    aggregates,
    entities,
    filters,
    index,
    joins,
    keyed,
    keywords,
    language,
    ranking,
    scoring,
    search,
    sets,
    skew,
    statistics,
    threads,
)
from claimtide.session import scratch_path, shuffles_released, stored
from claimtide.sources import sinks


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def search_by_hand(claims, messages, need):
    out = []
    for f, words in claims:
        for m, text in messages:
            hit = len(set(words) & set(text))
            if len(set(words)) >= need and hit >= need:
                out.append((f, m, hit))
    return sorted(out)


def test_keyword_search_equals_counting_and_groups(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(30)]
    # w0 is in almost every message: a hot word
    messages = [(i, ["w0"] * (i % 10 != 0) + rng.sample(vocabulary, 6)) for i in range(200)]
    claims = [(i, ["w0"] * (i % 2) + rng.sample(vocabulary, n)) for i, n in enumerate([0, 2, 3, 4, 5, 6, 6, 5])]
    features = spark.createDataFrame(claims, "fact_id int, keywords array<string>")
    words = search.token_table(spark.createDataFrame(messages, "message_id int, t array<string>"), F.col("t"))
    for need in (2, 3):
        got = rows(search.keyword_search(features, words, need), "fact_id", "message_id", "matched")
        assert got == search_by_hand(claims, messages, need)
    groups = features.withColumn("groups", search.combinations_of(F.array_distinct("keywords"), 3))
    explicit = rows(search.group_search(groups, words), "fact_id", "message_id")
    assert explicit == [(f, m) for f, m, _ in search_by_hand(claims, messages, 3)]


def test_short_claims_need_all_keywords(spark):
    features = spark.createDataFrame([(1, ["a", "b"]), (2, ["or", "a"])], "fact_id int, keywords array<string>")
    words = spark.createDataFrame([(1, None, "a"), (1, None, "b"), (2, None, "a")], "message_id int, date timestamp, word string")
    assert rows(search.keyword_search(features, words), "fact_id") == []
    assert rows(search.keyword_search(features, words, short="all"), "fact_id", "message_id") == [(1, 1), (2, 1), (2, 2)]


def test_phrases(spark):
    features = spark.createDataFrame([(1, ["la palma", "lava", "isla"])], "fact_id int, keywords array<string>")
    messages = spark.createDataFrame(
        [(1, "la palma con lava en la isla"), (2, "palma la lava isla"), (3, "la palma y lava")], "message_id int, text string"
    )
    found = search.claim_search(features, messages, F.split("text", " "), F.col("text"), need=3)
    assert rows(found, "message_id") == [(1,)]


def test_messages_near_claim_bounds(spark):
    messages = spark.sql(
        "SELECT * FROM VALUES (1, timestamp'2024-01-10 12:00:00'), (2, timestamp'2024-01-12 11:59:59'),"
        " (3, timestamp'2024-01-12 12:00:00'), (4, timestamp'2024-01-08 12:00:00') AS t(message_id, date)"
    )
    claims = spark.sql("SELECT 7 AS fact_id, timestamp'2024-01-10 12:00:00' AS claim_date")
    near = joins.messages_near_claim(messages, claims, 2)
    assert rows(near, "message_id") == [(1,), (2,)]
    links = spark.sql("SELECT * FROM VALUES (2, 7), (3, 7), (1, 8) AS t(message_id, fact_id)")
    assert rows(joins.messages_near_claim(messages, claims, 2, links=links), "message_id") == [(2,)]


def test_window_keeps_message_date_range(spark):
    features = spark.sql("SELECT 1 AS fact_id, array('a') AS keywords, timestamp'2024-01-10 18:00:00' AS claim_date")
    words = spark.sql(
        "SELECT * FROM VALUES (1, timestamp'2024-01-09 00:00:00', 'a'), (2, timestamp'2024-01-11 23:59:59', 'a'),"
        " (3, timestamp'2024-01-12 00:00:00', 'a'), (4, timestamp'2024-01-08 23:59:59', 'a') AS t(message_id, date, word)"
    )
    found = search.keyword_search(features, words, need=1, days=(1, 1))
    assert rows(found, "message_id") == [(1,), (2,)]


@pytest.mark.parametrize("hot", [False, True])
def test_percentiles_match_numpy(spark, hot):
    rng = random.Random(2)
    values = [7.0] * 400 * hot + [round(rng.expovariate(0.1), 1) for _ in range(700)]
    data = [("a", v) for v in values] + [("b", 1.0), ("b", None), (None, 4.0), (None, 6.0)]
    df = spark.createDataFrame(data, "k string, v double")
    got = {r["k"]: r for r in ranking.describe(df, "v", ["k"]).collect()}
    assert [got["a"][c] for c in ("q25", "q50", "q75")] == pytest.approx(list(np.percentile(values, [25, 50, 75])))
    assert got["a"]["std"] == pytest.approx(np.std(values, ddof=1)) and got["a"]["count"] == len(values)
    assert got["b"]["q50"] == 1.0 and got[None]["q50"] == 5.0


def wilcoxon_by_hand(pairs):
    d = [b - a for a, b in pairs if a != b]
    size = sorted(abs(x) for x in d)
    rank = {s: np.mean([i + 1 for i, y in enumerate(size) if y == s]) for s in set(size)}
    plus = sum(rank[abs(x)] for x in d if x > 0)
    minus = sum(rank[abs(x)] for x in d if x < 0)
    n, ties = len(d), sum(size.count(s) ** 3 - size.count(s) for s in set(size))
    z = (min(plus, minus) - n * (n + 1) / 4) / math.sqrt((n * (n + 1) * (2 * n + 1) - ties / 2) / 24)
    return min(plus, minus), math.erfc(abs(z) / math.sqrt(2))


def test_wilcoxon_with_ties_and_zeros(spark):
    rng = random.Random(9)
    pairs = [(rng.randint(1, 9), rng.randint(1, 12)) for _ in range(80)] + [(3, 3)] * 5
    df = spark.createDataFrame(pairs, "before int, after int")
    row = statistics.wilcoxon_signed_rank(df).first()
    assert (row["statistic"], row["p"]) == pytest.approx(wilcoxon_by_hand(pairs))


def test_normality_of_too_few_rows_is_null(spark):
    row = statistics.normality_test(spark.createDataFrame([(1.0,), (2.0,)], "v double"), "v").first()
    assert row["k2"] is None


def test_outliers(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 5, 6, 7, 100]], "v double")
    assert rows(statistics.iqr_outliers(df, "v"), "v") == [(100.0,)]
    assert statistics.iqr_outliers(df, "v", inside=True).count() == 7


def test_negative_binomial_fit(spark):
    rng = np.random.default_rng(4)
    x = rng.integers(0, 2, 400)
    h = rng.integers(-5, 6, 400)
    y = rng.poisson(np.exp(1 + 0.5 * x - 0.1 * h))
    df = spark.createDataFrame([(int(a), int(b), int(c)) for a, b, c in zip(y, x, h)], "y int, x int, h int")
    got = [r["coefficient"] for r in statistics.negative_binomial_fit(df, "y", ["x", "h"]).collect()]
    design = np.column_stack([np.ones(400), x, h])
    mu = design @ np.array(got)
    mu = np.exp(mu)
    score = design.T @ ((y - mu) / (1 + mu))
    assert np.abs(score).max() < 1e-6


def class_cells(spark, matrix, labels):
    data = [(labels[i], labels[j], matrix[i][j]) for i, j in itertools.product(range(2), range(2))]
    return spark.createDataFrame(data, "gold string, predicted string, n bigint")


@pytest.mark.parametrize(
    "matrix, accuracy, macro_f1",
    [([[203, 78], [18, 179]], 0.7992, 0.80), ([[282, 18], [27, 18]], 0.8696, 0.69)],
)
def test_class_report_of_known_matrices(spark, matrix, accuracy, macro_f1):
    report = {r["label"]: r for r in aggregates.class_report(class_cells(spark, matrix, ["off", "on"])).collect()}
    assert round(report["accuracy"]["precision"], 4) == accuracy
    assert round(report["macro avg"]["f1"], 2) == macro_f1
    assert report["on"]["support"] == sum(matrix[1])


def test_threshold_ties_and_bounds(spark):
    data = [("m", s, t) for s, t in [(0.1, 0), (0.2, 0), (0.6, 1), (0.8, 1), (0.4, 0)]]
    df = spark.createDataFrame(data, "model string, score double, target int")
    row = scoring.tune_threshold(df).first()
    low, high = np.mean([0.1, 0.2, 0.4]), 0.7
    candidates = [low, high] + [low + (high - low) / 5 * i for i in range(1, 5)]

    def quality(t):
        parts = []
        for c in (0, 1):
            guessed = [y for _, s, y in data if (s > t) == bool(c)]
            parts.append(sum(y == c for y in guessed) / len(guessed) if guessed else 0)
        return sum(parts) / 2

    best = max(candidates, key=quality)
    assert row["threshold"] == pytest.approx(best) and row["quality"] == pytest.approx(quality(best))


def test_score_equal_to_threshold_is_negative(spark):
    df = spark.createDataFrame([(1, 0.85), (2, 0.86), (3, None)], "message_id int, score double")
    out = scoring.classify(df, "claim_relation")
    assert rows(out.fillna("-"), "message_id", "claim_relation") == [(1, "off-claim"), (2, "on-claim"), (3, "-")]


def test_missing_claim_gives_null_label(spark):
    pairs = spark.createDataFrame([(1, 1), (1, 2)], "message_id int, fact_id int")
    claim = spark.createDataFrame([(1, [1.0, 0.0])], "fact_id int, vector array<double>")
    message = spark.createDataFrame([(1, [1.0, 0.0])], "message_id int, vector array<double>")
    scored = scoring.classify(scoring.score_pairs(pairs, claim, message), "topic_relation")
    got = {r["fact_id"]: r["topic_relation"] for r in scored.collect()}
    assert got == {1: "on-topic", 2: None}


def test_finer_label_of_equal_similarity(spark):
    pairs = spark.sql("SELECT 1 AS message_id, 1 AS fact_id, 'on-claim' AS claim_relation")
    side = spark.createDataFrame([(1, [1.0, 1.0])], "fact_id int, vector array<double>")
    message = spark.createDataFrame([(1, [1.0, 0.0])], "message_id int, vector array<double>")
    out = scoring.classify_finer(pairs, side, side, message)
    assert out.first()["claim_finer_relation"] == "not-disseminates"


def votes_table(spark, votes):
    data = [(i, p, lang, conf) for i, vs in votes.items() for p, (lang, conf) in enumerate(vs)]
    return spark.createDataFrame(data, "id int, position int, lang string, confidence double")


def test_language_votes(spark):
    votes = {
        1: [("es", 0.9), ("ca", 0.9), ("pt", 0.9)],
        2: [("ca", 0.9), ("es", 0.8), ("es", 0.8)],
        3: [("es", 0.5), ("es", 0.75), ("ca", 0.9)],
        4: [("es", 0.1), (None, None), ("ca", 0.2)],
    }
    got = dict(rows(language.vote_language(votes_table(spark, votes), "id"), "id", "pref_lang"))
    assert got == {1: "es_ca_pt", 2: "es", 3: "es_ca", 4: "undefined"}
    arrays = votes_table(spark, votes).groupBy("id").agg(
        F.sort_array(F.collect_list(F.struct("position", "lang", "confidence"))).alias("votes")
    )
    assert dict(rows(arrays.select("id", language.row_language("votes").alias("l")), "id", "l")) == got


def test_keywords_are_order_free_and_topped_up(spark):
    kind = "map<string,array<string>>"
    schema = f"ner_claim {kind}, ner_review {kind}, pos_claim {kind}, pos_review {kind}"
    tags = {"NOUN": ["vacuna2", "sol"], "ADJ": ["falso"], "VERB": ["es", "dijo", "ir"]}
    data = [
        ({"PER": ["ana"], "LOC": ["madrid"]}, {}, tags, {"NOUN": ["luna"]}),
        ({"LOC": ["madrid"], "PER": ["ana"]}, None, tags, {"NOUN": ["luna"]}),
        ({"A": list("abcde")}, {"B": ["f1", "g-2"]}, tags, tags),
        (None, None, {"ADJ": ["x"]}, None),
    ]
    got = [r[0] for r in keywords.select_keywords(spark.createDataFrame(data, schema)).select("keywords").collect()]
    assert got[0] == got[1] == ["ana", "dijo", "falso", "madrid", "sol", "vacuna"]
    assert got[2] == ["f1", "g-2"]  # enough already: not cleaned, only one-letter words go
    assert got[3] == []


def test_first_word_strategy(spark):
    kind = "map<string,array<string>>"
    schema = f"ner_claim {kind}, ner_review {kind}, pos_claim {kind}, pos_review {kind}"
    data = [({"PER": ["ana", "eva"]}, {"LOC": ["madrid"]}, {"NOUN": ["sol", "7"]}, {"VERB": ["dijo"]})]
    df = keywords.select_keywords_first_words(spark.createDataFrame(data, schema))
    assert df.first()["keywords"] == ["ana", "madrid", "sol"]


def tagged(spark, tags):
    data = [(1, i, f"w{i}", t, 1.0, i * 3, i * 3 + 2) for i, t in enumerate(tags)]
    return spark.createDataFrame(data, "text_id int, pos int, word string, tag string, score double, start int, end int")


@pytest.mark.parametrize(
    "tags, expected",
    [
        (["B-PER", "I-PER", "E-PER"], [("w0w1w2", "PER")]),
        (["S-LOC", "O", "S-ORG"], [("w0", "LOC"), ("w2", "ORG")]),
        (["I-PER", "O"], [("w0", "PER")]),
        (["E-PER"], [("w0", "PER")]),
        (["B-PER", "O", "S-LOC"], [("w0", "PER"), ("w2", "LOC")]),
        (["B-PER", "B-PER", "I-PER"], [("w0w1", "PER"), ("w2", "PER")]),
        (["B-PER", "I-PER"], []),
        (["B-PER", "S-LOC", "B-LOC", "I-PER", "E-PER"], [("w0w1", "LOC"), ("w2w3w4", "PER")]),
    ],
)
def test_merge_spans(spark, tags, expected):
    merged = entities.merge_spans(tagged(spark, tags)).orderBy("entity_no")
    assert [(r["word"], r["entity"]) for r in merged.collect()] == expected


def test_merge_pieces_types(spark):
    data = [
        (1, 0, True, "Ma", "B-LOC", 1.0, 0, 2),
        (1, 1, False, "drid", "E-LOC", 0.5, 2, 6),
        (1, 2, True, "es", "O", 1.0, 7, 9),
        (1, 3, True, "X", "E-PER", 1.0, 10, 11),
        (1, 4, False, "y", "I-PER", 1.0, 11, 12),
        (1, 5, True, "last", "S-PER", 1.0, 13, 17),
    ]
    schema = "text_id int, pos int, word_start boolean, word string, tag string, score double, start int, end int"
    words = entities.merge_pieces(spark.createDataFrame(data, schema)).orderBy("pos")
    assert [(r["word"], r["tag"], r["score"]) for r in words.collect()] == [
        ("Madrid", "S-LOC", 0.75),
        ("es", "O", 1.0),
        ("Xy", "I-PER", 1.0),
        ("last", "S-PER", 1.0),
    ]


def test_threads_three_deep_with_orphan(spark):
    data = [("a", None), ("b", "a"), ("c", "b"), ("d", "c"), ("e", "a"), ("x", "gone"), ("y", "x"), ("r", None)]
    table = threads.thread_table(spark.createDataFrame(data, "id string, parent_id string"))
    assert rows(table, "id", "root", "depth", "replies") == [
        ("a", "a", 0, 2),
        ("b", "a", 1, 1),
        ("c", "a", 2, 1),
        ("d", "a", 3, 0),
        ("e", "a", 1, 0),
        ("r", "r", 0, 0),
    ]


def test_threads_deep_chain_and_cycle(spark):
    data = [("0", None)] + [(str(i), str(i - 1)) for i in range(1, 40)] + [("p", "q"), ("q", "p")]
    table = threads.thread_table(spark.createDataFrame(data, "id string, parent_id string"))
    assert sorted(r["depth"] for r in table.collect()) == list(range(40))


def test_media_match_last_rule_wins(spark):
    registry = spark.createDataFrame(
        [(1, 1, "El Sol", "https://www.elsol.es/"), (2, 2, "Madrid", "http://madrid.com"), (3, 3, "El Sol", "http://otro.es")],
        "id int, row_no int, name string, url string",
    )
    names = spark.createDataFrame([("El Sol. Ed. Madrid", "R1"), ("Región", "R2"), ("elsol.es", "R3")], "name string, ref string")
    # R1: both "El Sol" and the later part "Madrid" are known; R3: "elsol" is tried after "elsol.es"
    assert rows(joins.match_media(registry, names), "ref", "id") == [("R1", 2), ("R3", 3)]


def held_rows(monkeypatch):
    """Rows of each table named 'hits' that a search stores."""
    seen = []

    def counted(df, label="table"):
        kept = stored(df, label)
        if label == "hits":
            seen.append(kept.count())
        return kept

    for module in (search, index):
        monkeypatch.setattr(module, "stored", counted)
    return seen


def phrase_case(spark):
    """Claims whose words stand in all messages, and whose phrases stand in one."""
    claims = spark.createDataFrame([(i, ["a b", "c d e", "a b"]) for i in range(6)], "fact_id int, keywords array<string>")
    texts = ["b a e d c"] * 9 + ["a b x c d e"]
    return claims, spark.createDataFrame([(i, t, "2024-01-01") for i, t in enumerate(texts)], "message_id int, text string, date string")


def test_phrase_search_meets_only_messages_with_phrases(spark, monkeypatch):
    claims, messages = phrase_case(spark)
    seen = held_rows(monkeypatch)
    found = search.claim_search(claims, messages, F.split("text", " "), F.col("text"), need=2)
    assert rows(found, "fact_id", "message_id", "matched") == [(i, 9, 2) for i in range(6)]
    # a claim's one probe at most, in the one message with a phrase
    assert seen and max(seen) <= 6


def test_phrase_search_keeps_equal_rows_and_rows_of_one_id(spark):
    claims = spark.createDataFrame([(1, ["a b"]), (1, ["a b"])], "fact_id int, keywords array<string>")
    messages = spark.createDataFrame([(7, "a b"), (7, "a b"), (7, "b a"), (7, "x a b"), (None, "a b"), (8, None)], "message_id int, text string")
    found = search.claim_search(claims, messages, F.split("text", " "), F.col("text"), need=1)
    assert rows(found, "fact_id", "message_id", "matched") == [(1, 7, 1)] * 6


def test_phrase_index_meets_only_messages_with_phrases(spark, monkeypatch):
    claims, messages = phrase_case(spark)
    built = index.PhraseIndex(spark, scratch_path(spark, "index"))
    built.add("one", messages, F.split("text", " "))
    seen = held_rows(monkeypatch)
    found = built.search(claims, 2)
    assert rows(found, "fact_id", "message_id", "matched") == [(i, 9, 2) for i in range(6)]
    assert seen and max(seen) <= 6


def test_phrase_index_writes_postings_where_messages_are_cut(spark, monkeypatch):
    """Neither the postings of an `add` nor, for a search, all places of the words asked for go through a shuffle."""
    claims, messages = phrase_case(spark)
    built = index.PhraseIndex(spark, scratch_path(spark, "index"))
    plans, commit = [], built.tables.commit

    def planned(run, append, folds):
        plans.append(append["postings"]._jdf.queryExecution().executedPlan().toString())
        return commit(run, append=append, folds=folds)

    monkeypatch.setattr(built.tables, "commit", planned)
    built.add("one", messages, F.split("text", " "))
    # the ids of several rows are looked up by a broadcast of none
    assert len(plans) == 1 and "Exchange hashpartitioning" not in plans[0] and "Exchange rangepartitioning" not in plans[0]
    seen = []

    def counted(df, label="table"):
        kept = stored(df, label)
        if label == "places":
            seen.append(kept.count())
        return kept

    monkeypatch.setattr(index, "stored", counted)
    assert rows(built.search(claims, 2), "fact_id", "message_id", "matched") == [(i, 9, 2) for i in range(6)]
    # "a b", "c d" and "d e" in the one message with them, not the fifty places of their words
    assert seen == [3]


def test_phrase_index_of_messages_of_several_rows(spark):
    """Rows of an id are one message: places may hold more than one word, and equal rows count once."""
    messages = spark.createDataFrame(
        [(1, "2024-01-01", "a x"), (1, "2024-01-02", "y b c d"), (1, "2024-01-02", "y b c d"), (2, "2024-01-01", "a b"), (3, None, "b"), (None, "2024-01-01", "a b")],
        "message_id int, date string, text string",
    )
    claims = [(1, ["a b"]), (2, ["a b c d"]), (3, ["b"]), (4, ["x c", "b a"]), (5, ["b a", "d a"])]
    claims = spark.createDataFrame([(i, k, "2024-01-01") for i, k in claims], "fact_id int, keywords array<string>, claim_date string")
    built = index.PhraseIndex(spark, scratch_path(spark, "index"))
    built.add("one", messages, F.split("text", " "))
    counts = {(r["word"], str(r["day"])): r["n"] for r in built.tables.table("frequencies").collect()}
    assert counts["a", "2024-01-01"] == 3 and counts["y", "2024-01-02"] == 1 and counts["b", "None"] == 1
    asked = {(r["fact_id"], r["message_id"]) for r in built.search(claims, 1).collect()}
    assert asked == {(1, 1), (1, 2), (2, 1), (3, 1), (3, 2), (3, 3), (4, 1)}
    # a phrase has the day of its first word
    near = {(r["fact_id"], r["message_id"]) for r in built.search(claims, 1, days=(0, 0)).collect()}
    assert near == {(1, 1), (1, 2), (2, 1), (3, 2), (4, 1)}


def test_stored_tables_give_back_their_shuffles(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    with pytest.raises(ValueError), shuffles_released(spark):
        assert spark.conf.get(name) == "true"
        raise ValueError
    assert spark.conf.get(name) == before


def test_tags_leave_in_pieces():
    """A worker never holds the tags of all texts of a batch."""
    texts = pd.Series(["x " * 15_000] * 4)
    parts = list(plugins._tagged(pd.Series(range(4)), texts, lambda t: [("T", w) for w in t.split()], ["id", "tag", "word"]))
    assert sum(len(p) for p in parts) == 60_000 and max(len(p) for p in parts) <= plugins.TAGS_AT_ONCE


def test_pairs_of_restrictive_text_are_made_once(spark):
    from claimtide.plans import load_all
    from claimtide.plans.catalog import QUERIES

    load_all()
    folder = scratch_path(spark, "texts")
    spark.createDataFrame([(1, "abcdefgh1 abcdefgh2 abcdefgh3 abcdefgh4 abcdefgh5")], "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    df = QUERIES["F10_restrictive_text"](spark, folder)
    assert rows(df, "query") == [("(abcdefgh1 AND abcdefgh2) OR (abcdefgh3 AND abcdefgh4) AND (abcdefgh1 AND abcdefgh2)",)]
    assert df._jdf.queryExecution().optimizedPlan().toString().count("slice(") == 1


def test_media_are_matched_without_broadcast(spark):
    """Sizes of either side, as Spark expects them from small files, say nothing of how many spellings there are."""
    registry = spark.createDataFrame(
        [(1, "El Sol", "https://www.elsol.es/", 1), (2, "Madrid", "https://madrid.es/", 2)], "id int, name string, url string, row_no int"
    )
    names = spark.createDataFrame(
        [("El Sol/Ed", "R1"), ("El Sol/Ed", "R2"), ("El Sol/Ed", "R2"), ("Otro", "R3"), (None, "R4"), ("Otro", None), ("Madrid - x", None)],
        "name string, ref string",
    )
    found = joins.match_media(registry, names)
    got = {tuple(r) for r in found.select("ref", "name", "id").collect()}
    assert found.count() == 3 and got == {("R1", "El Sol/Ed", 1), ("R2", "El Sol/Ed", 1), (None, "Madrid - x", 2)}
    without = sinks.names_without_match(names, found)
    assert without.count() == 3 and {r["name"] for r in without.collect()} == {"Otro", None, "Madrid - x"}
    for df in (found, without):
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()


def test_refilter_is_case_sensitive(spark):
    news = spark.createDataFrame([(1, "Lava en La Palma"), (1, "LAVA"), (2, "Lava")], "fact_id int, Title string")
    features = spark.createDataFrame([(1, ["Lava", "sol"])], "fact_id int, keywords array<string>")
    got = sorted((r["Title"], r["keywords_in_title"]) for r in joins.refilter_by_title(news, features).collect())
    assert got == [("LAVA", False), ("Lava", False), ("Lava en La Palma", True)]


def test_pairs_on_one_side_get_zero(spark):
    df = spark.createDataFrame([(1, -3), (1, -1), (2, 0), (3, -1), (3, 2)], "fact_id int, h bigint")
    sides = joins.before_after(df, "h")
    assert rows(sides, "fact_id", "before", "after") == [(1, 2, 0), (2, 0, 1), (3, 1, 1)]
    assert rows(joins.paired(sides), "fact_id") == [(3,)]
    long = spark.createDataFrame([(1, "a", 2)], "fact_id int, side string, n bigint")
    assert rows(sets.with_zero_rows(long, "fact_id", "side", ["a", "b"]), "side", "n") == [("a", 2), ("b", 0)]


def test_first_and_last_writer(spark):
    df = spark.createDataFrame([("t", 1, "x", 5), ("t", 2, "y", 6), ("u", 1, "z", 5)], "k string, at int, v string, fact_id int")
    assert rows(keyed.last_per_key(df, "k", ["at"], ["v"]), "k", "v", "writes") == [("t", "y", 2), ("u", "z", 1)]
    assert rows(keyed.first_per_key(df, "k", ["at"], ["v"]), "k", "v") == [("t", "x"), ("u", "z")]
    assert rows(keyed.pushed_links(df, "k"), "k", "fact_id") == [("t", 5), ("t", 6), ("u", 5)]


def test_caps_are_cut_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), "id")
    plan = keyed.cap_per_key(df, ["k"], ["id"], 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_within_reach_leaves_far_days_out(spark):
    claims = spark.createDataFrame([("2024-01-10 23:00:00",), ("2024-02-10 01:00:00",), (None,)], "claim_date string").withColumn("claim_date", F.col("claim_date").cast("timestamp"))
    days = ["2024-01-08", "2024-01-09", "2024-01-11", "2024-01-12", "2024-02-09", "2024-02-11", None]
    messages = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "message_id int, date string").withColumn("date", F.col("date").cast("timestamp"))
    kept = search.within_reach(messages.unionByName(messages), claims, (1, 1))
    assert kept.columns == ["message_id", "date"]
    assert sorted(r.message_id for r in kept.collect()) == [1, 1, 2, 2, 4, 4, 5, 5]


def test_cooccurrence_by_hand(spark):
    sentences = ["a b c a", "b a", "", "x", "a, b!"]
    counts = {}
    for s in sentences:
        t = [w.strip(",!") for w in s.split()]
        for i in range(len(t)):
            for other in t[i + 1 : i + 3]:
                pair = tuple(sorted((t[i], other)))
                counts[pair] = counts.get(pair, 0) + 1
    df = spark.createDataFrame([(s,) for s in sentences], "sentence string")
    assert rows(aggregates.cooccurrence(df, minimum=1), "w1", "w2", "counts") == sorted(
        (a, b, n) for (a, b), n in counts.items() if n > 1
    )


def test_cooccurrence_in_pieces(spark, monkeypatch):
    """Words beyond ASCII, empty and null lines, and counts summed over pieces of a task."""
    monkeypatch.setattr(aggregates, "PAIRED_WORDS", 5)
    monkeypatch.setattr(aggregates, "PAIRED_BYTES", 16)
    monkeypatch.setattr(aggregates, "PAIRED_ROWS", 2)
    words = ["é", "z", "Ωμέγα", "a", "\uffee", "\U0001f600"]
    rng = random.Random(3)
    lines = [" ".join(rng.choices(words, k=rng.randrange(9))) for _ in range(60)] + [None, "", " ", "- !"]
    counts = {}
    for s in lines:
        t = (s or "").lower().translate({ord(c): None for c in "-!"}).split()
        for i in range(len(t)):
            for other in t[i + 1 : i + 4]:
                pair = tuple(sorted((t[i], other), key=str.encode))
                counts[pair] = counts.get(pair, 0) + 1
    df = spark.createDataFrame([(s,) for s in lines], "sentence string").repartition(3)
    got = {(r.w1, r.w2): r.counts for r in aggregates.cooccurrence(df, window=3, minimum=4).collect()}
    assert got == {p: n for p, n in counts.items() if n > 4}
    assert aggregates.cooccurrence(df.limit(0)).count() == 0


def test_cooccurrence_counts_before_spark(spark):
    """A pair is one row for all its places in a task, not one row each."""
    df = spark.createDataFrame([("so it goes",)] * 50, "sentence string").coalesce(1)
    plan = aggregates.cooccurrence(df)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Generate" not in plan


def test_keyword_pairs_choose_keywords_once(spark):
    features = spark.range(3).select(F.col("id").alias("fact_id"), F.expr("array_remove(split('b a ' || id, ' '), '2')").alias("keywords"))
    pairs = keywords.keyword_pairs(features)
    assert rows(pairs, "fact_id", "a", "b") == [(0, "0", "a"), (0, "0", "b"), (0, "a", "b"), (1, "1", "a"), (1, "1", "b"), (1, "a", "b"), (2, "a", "b")]
    assert pairs._jdf.queryExecution().executedPlan().toString().count("array_remove") == 1
    none = spark.createDataFrame([(1, None), (2, []), (3, ["a", None])], "fact_id int, keywords array<string>")
    assert keywords.keyword_pairs(none).count() == 0


def test_rare_pairs_strict_keeps_all(spark):
    pairs = spark.createDataFrame([(1, "Sol", "agua")], "fact_id int, a string, b string")
    counts = spark.createDataFrame([("agua", "sol", 31)], "w1 string, w2 string, counts bigint")
    assert aggregates.rare_pairs(pairs, counts).count() == 0
    assert aggregates.rare_pairs(pairs, counts, 31).count() == 1
    assert aggregates.rare_pairs(pairs, counts, strict=True).count() == 1


def test_crosstab_orders_by_margins(spark):
    df = spark.createDataFrame([("r1", "x"), ("r1", "y"), ("r1", "y"), ("r2", "y")], "a string, b string")
    wide, norm = aggregates.crosstab(df, "a", "b", ["x", "y"])
    assert wide.columns == ["a", "y", "x"]
    assert [tuple(r) for r in wide.collect()] == [("r2", 1, 0), ("r1", 2, 1)]
    assert [round(r["y"], 3) for r in norm.collect()] == [1.0, 0.667]


def test_crosstab_counts_have_any_number_of_values(spark):
    df = spark.range(3000).select((F.col("id") % 2).alias("a"), F.col("id").cast("string").alias("b"))
    assert aggregates.crosstab_counts(df, "a", "b").where("count = 1 AND row_total = 1500 AND column_total = 1").count() == 3000


def test_keys_are_cut_in_pieces_of_so_many_rows(spark):
    """A key of 0.3 % of the rows is cut as well, and no row or pair is lost."""
    df = spark.range(20_000).select("id", F.when(F.col("id") < 60, -1).otherwise(F.col("id")).alias("k"))
    counts = df.groupBy("k").agg(F.count("*").alias("n"))
    hot = skew.hot_keys(counts, "k", rows=20)
    assert rows(hot, "k", "_pieces") == [(-1, 3)]
    right = spark.createDataFrame([(-1, "x"), (-1, "y"), (70, "z")], "k long, v string")
    joined = skew.salted_join(df, right, "k", ["id"], hot)
    assert rows(joined.groupBy("v").agg(F.countDistinct("id").alias("n"), F.count("*").alias("m")), "v", "n", "m") == [
        ("x", 60, 60), ("y", 60, 60), ("z", 1, 1),
    ]


def test_ranks_over_several_ranges(spark, monkeypatch):
    monkeypatch.setattr(ranking, "RANGE_ROWS", 50)
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), (F.col("id") % 401).alias("v"))
    got = ranking.exact_percentiles(df, ["k"], "v", {"p": 0.37}).toPandas().set_index("k")["p"]
    want = df.toPandas().groupby("k")["v"].quantile(0.37)
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want.index)


def test_phrases_are_probed_by_their_rarest_word(spark):
    features = spark.createDataFrame(
        [(1, ["new york", "fire", "mayor"]), (2, ["new york", "mayor"]), (3, ["the", "mayor of the"])], "fact_id int, keywords array<string>"
    )
    texts = [(1, "the mayor of new york saw a fire"), (2, "york new mayor fire"), (3, "the mayor of the town")]
    messages = spark.createDataFrame(texts, "message_id int, text string")
    find = search.claim_search(features, messages, F.split("text", " "), F.col("text"), short="all")
    assert rows(find, "fact_id", "message_id") == [(1, 1), (2, 1), (3, 3)]
    assert rows(search.claim_search(features, messages, F.split("text", " "), F.col("text")), "fact_id", "message_id") == [(1, 1)]


def test_message_of_two_claims_is_in_the_experiment(spark):
    claims = spark.createDataFrame([(1, "Falso", "a"), (2, "Otro", "a")], "fact_id int, calification string, reviewer string")
    links = spark.createDataFrame(
        [(9, 1, "on-topic", "off-claim"), (9, 2, "on-topic", "off-claim"), (8, 2, "on-topic", None)],
        "message_id int, fact_id int, topic_relation string, claim_relation string",
    )
    news = spark.createDataFrame([], "fact_id int, topic_relation string")
    out, flagged, _ = filters.subset_flags(claims, links, news, "Falso", ["a"])
    assert rows(flagged, "message_id", "on_topic_subset") == [(8, False), (9, True), (9, True)]
    assert rows(out, "fact_id", "topic_relation_subset", "on_topic_subset", "on_claim_subset") == [
        (1, True, True, False),
        (2, False, True, False),
    ]


def test_unify_repository_and_review(spark):
    repository = spark.sql(
        "SELECT 'c' AS content, 't' AS text, 'u' AS link, named_struct('name', 'o') AS organization, current_date() AS date,"
        " named_struct('calification', named_struct('name', 'Falso')) AS organizationCalification, 'k' AS categories"
    )
    review = spark.sql(
        "SELECT 't' AS text, current_date() AS date, named_struct('title', 'r', 'languageCode', 'pt', 'url', 'u', 'publisher',"
        " named_struct('name', 'p'), 'textualRating', 'Falso') AS claimReview"
    )
    both = filters.unify_claims([(repository, filters.REPOSITORY_FIELDS), (review, filters.REVIEW_FIELDS)])
    assert both.count() == 2 and "lang" in both.columns
    assert rows(both.fillna("-"), "claim", "review", "lang") == [("c", "t", "-"), ("t", "r", "pt")]


def test_annotation_text_and_back(spark):
    pairs = spark.createDataFrame(
        [("m", "f", "claim", "check", "text", None, None), ("n", "f", "claim", "check", None, "title", "One. Two. Three")],
        "message_id string, fact_id string, claim string, review string, text string, title string, content string",
    )
    tasks = sinks.annotation_tasks(pairs)
    assert tasks.collect()[1]["text"].endswith("\n One")
    back = sinks.parse_annotation(tasks)
    assert rows(back, "id_tweet", "id_claim", "text") == [("m", "f", "text"), ("n", "f", "title")]


def test_lump_rare(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None)], "id int, c string")
    got = {r["id"]: r["c"] for r in aggregates.lump_rare(df, "c", 1).collect()}
    assert got[1] == got[2] == "a" and got[3] == "Others"


def test_vectors_of_equal_text_are_equal(spark):
    df = spark.createDataFrame([(1, "sol y agua"), (2, "sol y agua"), (3, "otra cosa")], "id int, t string")
    vectors = {r["id"]: r["vector"] for r in scoring.hashed_vectors(df, "id", F.split("t", " "), 16).collect()}
    assert vectors[1] == vectors[2] != vectors[3] and len(vectors[1]) == 16


def test_vectors_by_hand(spark):
    """Rows of one id count as one text, null ids too; texts are cut once, so vectors need no second look at them."""
    texts = [(1, "sol y agua"), (1, "sol"), (None, "y"), (None, "sal"), (3, None), (4, ""), (5, "agua agua")]
    df = spark.createDataFrame(texts, "id int, t string")
    slot = F.length("word")
    counts = {}
    for i, t in texts:
        for w in (t.split(" ") if t is not None else []):
            counts.setdefault(i, {}).setdefault(len(w) % 4, []).append(w)
    found = scoring.hashed_vectors(df, "id", F.split("t", " "), 4, slot)
    got = {r["id"]: r["vector"] for r in found.collect()}
    assert set(got) == set(counts) == {1, None, 4, 5}
    for i, own in counts.items():
        df_of = {s: sum(s in c for c in counts.values()) for s in own}
        assert got[i] == pytest.approx([len(own[s]) * math.log((len(texts) + 1) / (df_of[s] + 1)) if s in own else 0.0 for s in range(4)])
    assert "split(" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert scoring.hashed_vectors(df.limit(0), "id", F.split("t", " "), 4).count() == 0


def test_model_without_both_classes_has_no_threshold(spark):
    data = [("one", 0.1, 1, 1.0), ("one", 0.4, 1, 1.0), ("two", 0.1, 0, 0.0), ("two", 0.9, 1, 1.0)]
    df = spark.createDataFrame(data, "model string, score double, target int, ordinal double")
    tuned = {r["model"]: r for r in scoring.tune_threshold(df).collect()}
    assert tuned["one"]["threshold"] is None and tuned["two"]["quality"] == 1.0
    tied = {r["model"]: r["correlation"] for r in scoring.score_correlation(df, keys=("model",)).collect()}
    assert tied["one"] is None and tied["two"] == pytest.approx(1.0)

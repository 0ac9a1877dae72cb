"""Text functions on hand-made rows."""

import pytest
from pyspark.sql import functions as F

from claimtide.functions import text, times
from claimtide.operators import search


def one(spark, column, value, kind="string"):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    return df.select(column.alias("r")).first()[0]


@pytest.mark.parametrize(
    "value, expected",
    [
        ("<div>El <b>agua</b></div>", "El agua"),
        ("a<script>x<y</script>b<!-- c -->", "ab"),
        ("Espa&ntilde;a &#8364; &#x41; &amp; &unknown;", "España € A & &unknown;"),
        (None, None),
    ],
)
def test_strip_html(spark, value, expected):
    assert one(spark, text.strip_html("v"), value) == expected


@pytest.mark.parametrize(
    "value, expected",
    [("¡Región!", "región"), ("AC/DC\n", "acdc"), ("  ñandú ", "ñandú"), ("Москва", "москва"), ("«»", "")],
)
def test_clean_word(spark, value, expected):
    assert one(spark, text.clean_word("v"), value) == expected


def test_urls(spark):
    value = "mira https://a.es/x?y=1 y http://b.pt"
    assert one(spark, text.find_urls("v"), value) == ["https://a.es/x?y=1", "http://b.pt"]
    assert one(spark, text.drop_urls("v"), value) == "mira  y "


@pytest.mark.parametrize("value, expected", [("Región Ñ", "region n"), ("ÀÉÎÕÜ ç", "aeiou c")])
def test_fold_accents(spark, value, expected):
    assert one(spark, text.fold_accents("v"), value) == expected


def test_letters_only_and_lengths(spark):
    words = ["covid-19", "19", "a", "a", "dos palabras"]
    assert one(spark, text.letters_only("v"), words, "array<string>") == ["covid", "a", "dos palabras"]
    assert one(spark, text.longer_than("v", 2), words, "array<string>") == ["covid-19", "dos palabras"]


def test_host_name(spark):
    assert one(spark, text.host_name("v"), "https://www.elpais.com/") == "elpais.com"
    assert one(spark, text.host_name("v"), "elpais.com/") == "elpais.com"


def test_publication_variants(spark):
    variants = one(spark, text.publication_variants("v"), "El Sol. Ed. Madrid")
    assert "el sol" in variants and "madrid" in variants and "elsol.ed.madrid" in variants
    assert variants[-1] == "El Sol"


def test_counts(spark):
    assert one(spark, text.parse_count("v", "clics"), " 120 clics") == 120
    assert one(spark, text.parse_count("v", "K "), "K -7") == -7
    assert one(spark, text.parse_count("v"), "many") is None


def test_tokens(spark):
    assert one(spark, text.corpus_tokens("v"), "¡Hola, Mundo!  co-op x") == ["¡hola", "mundo", "coop", "x"]
    assert one(spark, text.title_tokens("v"), "El co-op, ¿sí? U.S.") == ["El", "co-op", "sí", "U.S"]


def combos(words, size):
    from itertools import combinations

    return [list(c) for c in combinations(words, size)]


@pytest.mark.parametrize("n", [0, 2, 3, 6])
def test_keyword_groups(spark, n):
    words = list("abcdef")[:n]
    assert one(spark, search.combinations_of("v", 3), words, "array<string>") == combos(words, 3)
    assert one(spark, search.combinations_of("v", 2), words, "array<string>") == combos(words, 2)
    assert one(spark, search.keyword_groups("v"), words, "array<string>") == combos(words, 3)
    all_of = one(spark, search.keyword_groups("v", short="all"), words, "array<string>")
    assert all_of == (combos(words, 3) if n >= 3 else [words] if n else [])


def test_query_words_dropped(spark):
    words = ["and", "agua", "or", "sol"]
    assert one(spark, search.query_keywords("v"), words, "array<string>") == ["agua", "sol"]
    assert one(spark, search.query_keywords("v", 1, False), words, "array<string>") == ["and"]


def budget_by_hand(groups, budget):
    query, kept = "", []
    for g in groups:
        part = "(" + " ".join(g) + ")"
        if kept and len(query) >= budget - len(" ".join(part)):
            break
        query += (" OR " if kept else "") + part
        kept.append(g)
    return kept


@pytest.mark.parametrize("budget", [10, 60, 200, 1024])
def test_query_budget(spark, budget):
    words = ["uno", "segundo", "tercero", "cuatro", "quinto", "sexto"]
    groups = combos(words, 3)
    got = one(spark, search.within_budget(search.combinations_of("v", 3), budget), words, "array<string>")
    assert got == budget_by_hand(groups, budget)


def test_restrictive(spark):
    pairs = [["a", "b"], ["c", "d"], ["e", "f"]]
    assert one(spark, search.restrictive_text(F.col("v")), pairs, "array<array<string>>") == (
        "(a AND b) OR (c AND d) AND (a AND b) OR (e AND f) AND (c AND d)"
    )


def test_hour_offset_rounds_down(spark):
    df = spark.sql("SELECT timestamp'2024-01-02 10:00:00' AS c, timestamp'2024-01-02 08:30:00' AS m")
    assert df.select(times.hour_offset("m", "c")).first()[0] == -2
    assert df.select(times.day_offset("m", "c")).first()[0] == 0
    assert df.select(times.hour_offset("m", F.lit(None).cast("timestamp"))).first()[0] == 0


def test_day_windows(spark):
    df = spark.sql("SELECT timestamp'2024-01-10 15:00:00' AS d")
    windows = df.select(times.day_windows("d")).first()[0]
    assert len(windows) == 15 and str(windows[0]["start"]) == "2024-01-03 00:00:00"
    assert str(windows[-1]["end"]) == "2024-01-18 00:00:00"
    windows = df.select(times.day_windows("d", from_midnight=False)).first()[0]
    assert len(windows) == 14 and str(windows[0]["start"]) == "2024-01-03 15:00:00"


def test_posts_of_one_page(spark):
    from claimtide.sources import readers

    def post(i, warn):
        return (
            f'<div class="news-summary"><div class="news-body" data-link-id="{i}"><div class="votes"><a href="#">1{i}</a></div>'
            f'<div class="clics"><span> 2{i} clics</span></div>{warn}<span class="ts visible" data-ts="1704067200"></span>'
            f'<span class="showmytitle" title="https://n.es/?a={i}&amp;b=2">n</span><a title="miniatura" href="#"><img src="/i{i}.jpg"></a>'
            f'<a href="/s{i}" class="comments">c</a><a class="subname" href="/x">cultura &amp; ocio</a></div></div>'
        )

    html = "<nav>x</nav>" + post(1, "") + post(2, '<div class="warn">!</div>')
    df = spark.createDataFrame([(7, html), (8, "<p>none</p>")], "page_id int, html string")
    got = readers.extract_posts(df).orderBy("post_id").collect()
    assert [(r["post_id"], r["votes"], r["clicks"], r["category"], r["controversy"]) for r in got] == [
        ("1", 11, 21, "cultura & ocio", False),
        ("2", 12, 22, "cultura & ocio", True),
    ]
    assert str(got[0]["created_local"]) == "2024-01-01 01:00:00" and got[0]["number_comments"] is None
    assert (got[1]["url"], got[1]["image_url"], got[1]["article_url"]) == ("/s2", "/i2.jpg", "https://n.es/?a=2&b=2")

"""Fill-in-middle, hard negatives and suffix dedup: odd rows, and small tables against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from claimtide.llm import byte_pairs, fill_middle, hard_negatives, license_rules, near_dedup, posting_lists, quality_rules, suffix_dedup

SCHEMA = "doc_id long, text string, row int, form string, n long, key string, spans string, anchor long"
LONG = " ".join(f"word{i}" for i in range(60_000))
TEXTS = [
    (1, "one two  three\n"), (2, None), (3, ""), (4, " \t\n "), (5, "has <P> in it already, so it stays as it is"), (None, "a text without an id"),
    (6, LONG), (7, "né ü \x85 ok\x00 end"), (8, "one two  three\n"), (8, "one two  three\n"), (9, "<" * 30 + " <S" + ">"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, 1, "f", 2, "k", "s", 3) for i, t in [*TEXTS, *((i, f"some {i} words to be cut é {i}") for i in range(20, 120))]]
    return spark.createDataFrame(rows, SCHEMA)


def expected(doc_id, text, seed=42):
    text = text or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    low, high = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 50:
        return len(units), "plain", None, None, text
    if h[3] % 100 < 80:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_fill_in_middle(docs):
    made = fill_middle.fill_in_middle(docs).withColumn("back", fill_middle.restored(F.col("form"), F.col("output")))
    rows = made.collect()
    assert len(rows) == docs.count() and made.select("row.*").columns == docs.columns
    for r in rows:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == expected(r.row.doc_id, r.row.text)
        assert r.back == (r.row.text or "")
    assert {r.form for r in rows} == {"plain", "psm", "spm"}
    assert fill_middle.fill_in_middle(docs.limit(0)).count() == 0


def test_fill_in_middle_in_portions(docs, monkeypatch):
    monkeypatch.setattr(fill_middle, "PORTION", 50)
    sizes = np.array([10, 60, 0, 0, 45, 6, 120])
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"x": list(range(7))})
    assert [p.column(0).to_pylist() for p in fill_middle.portions(batch, sizes)] == [[0], [1], [2, 3, 4], [5], [6]]


VECTORS = "vec_id long, embedding array<float>, label int, anchor_id string, score int, q int, v int"


def mined(rows, every, k, percent=80):
    """By comparing all; rows of (id, vector, label) that take part, one an id."""
    own = {i: ([int(np.floor(np.float64(x) * 256)) for x in v], label) for i, v, label in rows}
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = set()
    for a, (va, la) in own.items():
        if a % every:
            continue
        scores = sorted((-dot(va, v), i, label) for i, (v, label) in own.items() if i != a)
        for s, p, _ in [x for x in scores if x[2] == la][:k]:
            near = [x for x in scores if x[2] != la and percent * -s <= 100 * -x[0] <= 100 * -s]
            out |= {(a, p, rank, i, -s, -t) for rank, (t, i, _) in enumerate(near[:k], 1)}
    return out


def test_hard_negatives_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK", 64)
    monkeypatch.setattr(hard_negatives, "GROUP", 9)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 24))
    rows = [(i, [float(x) for x in (centres[i % 6] + 0.3 * rng.normal(size=24)).astype(np.float32)], int(rng.integers(0, 5))) for i in range(400)]
    rows += [(1000 + i, rows[7][1], 3) for i in range(12)]  # ties
    odd = [
        (None, [1.0] * 24, 1), (2001, None, 1), (2002, [1.0] * 23 + [None], 1), (2003, [float("nan")] * 24, 1), (2004, [float("inf")] * 24, 2),
        (2005, [1.0] * 24, None), (2010, [3e38] * 24, 1),
    ]
    short = [(3000, [1.0, 2.0], 1), (3010, [], 2)]
    table = spark.createDataFrame([(*r, "a", 1, 2, 3) for r in [*rows, *odd, *short, *rows[:30]]], VECTORS)
    got = hard_negatives.hard_negatives(table, every=10, k=4)
    want = mined([*rows, *((i, v + [0.0] * (24 - len(v)), x) for i, v, x in short)], 10, 4)
    assert len(want) > 100 and {tuple(r) for r in got.collect()} == want and got.count() == len(want)


def test_hard_negatives_of_nothing(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert hard_negatives.hard_negatives(empty).count() == 0
    one = spark.createDataFrame([(100, [1.0], 1, "a", 1, 2, 3)], VECTORS)
    assert hard_negatives.hard_negatives(one).count() == 0
    # scores below zero and of zero: only the latter has a window
    rows = [(100, [1.0, 0.0], 1), (1, [-1.0, 0.0], 1), (2, [0.0, 1.0], 1), (3, [0.0, 2.0], 2), (4, [-2.0, 0.0], 2)]
    table = spark.createDataFrame([(*r, "a", 1, 2, 3) for r in rows], VECTORS)
    assert [tuple(r) for r in hard_negatives.hard_negatives(table).collect()] == [(100, 2, 1, 3, 0, 0)]


def removed(texts, window=400):
    """Per text: spans of bytes to remove, by counting every string."""
    data = [(t or "").encode() for t in texts]
    counts = Counter(d[i : i + window] for d in data for i in range(len(d) - window + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, bool)
        for i in range(len(d) - window + 1):
            if counts[d[i : i + window]] > 1:
                gone[i : i + window] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(int)])))
        spans = list(zip(edges[::2].tolist(), edges[1::2].tolist()))
        out.append((len(d), sum(b - a for a, b in spans), spans, hashlib.sha256(bytes(x for x, g in zip(d, gone) if not g)).hexdigest()))
    return out


def corpus(seed=5):
    rng = random.Random(seed)
    prose = lambda n: "".join(rng.choice("abcdefgh é\n") for _ in range(n))
    shared, template = prose(700), prose(900)
    texts = [prose(rng.randrange(0, 1500)) for _ in range(20)]
    texts += [prose(rng.randrange(300)) + shared[rng.randrange(300) :] + prose(rng.randrange(300)) for _ in range(15)]
    for i in range(25):  # near copies: one character of a template differs
        at = rng.randrange(900)
        texts.append(template[:at] + rng.choice("XYZ") + template[at + 1 :])
    texts += [template, template, template + "!", "ab" * 600, "ab" * 250, "x" * 399, "x" * 399, "x" * 400, None, "", " ", prose(500) + "é" * 450]
    texts += ["y" * 401, shared + prose(30) + shared, "z" * (400 + 255), "w" * (400 + 511)]  # 256 and 512 equal windows
    return texts


def compared(docs, texts):
    got = suffix_dedup.suffix_dedup(docs).orderBy("doc_id").collect()
    return [(r.n_bytes, r.n_removed, [tuple(s) for s in r.spans], r.kept_sha256) for r in got], removed(texts)


def table_of(spark, texts):
    return spark.createDataFrame([(i, t, 1, "f", 2, "k", "s", 3) for i, t in enumerate(texts)], SCHEMA)


def test_suffix_dedup_by_brute_force(spark, monkeypatch):
    texts = corpus()
    got, want = compared(table_of(spark, texts), texts)
    assert got == want
    assert sum(w[1] > 0 for w in want) > 30 and max(len(w[2]) for w in want) > 1


@pytest.mark.parametrize("name, value", [("CROWD", 2), ("MERGED", 2000), ("PIECE", 11)])
def test_suffix_dedup_in_other_portions(spark, monkeypatch, name, value):
    monkeypatch.setattr(suffix_dedup, name, value)
    texts = corpus(6)
    got, want = compared(table_of(spark, texts), texts)
    assert got == want


def test_anchors_of_a_text_in_parts(monkeypatch):
    data = np.frombuffer("".join(corpus()[i] for i in range(40)).encode(), np.uint8)
    whole, places = suffix_dedup.text_anchors(data)
    monkeypatch.setattr(suffix_dedup, "CHUNK", 1000)
    parts, least = suffix_dedup.text_anchors(data)
    assert set(whole) == set(parts) and dict(zip(whole, places)).items() <= {(a, n) for a, p in zip(parts, least) for n in range(1, p + 1)}


def test_suffix_dedup_of_odd_rows(spark):
    long = "".join(random.Random(1).choice("abcdefgh ") for _ in range(1000))
    rows = [(1, long), (1, long), (None, long[:500]), (None, "short"), (2, long[600:] + "end"), (2, "other"), (3, None)]
    docs = spark.createDataFrame([(i, t, 1, "f", 2, "k", "s", 3) for i, t in rows], SCHEMA)
    got = suffix_dedup.suffix_dedup(docs).collect()
    want = removed([t for _, t in rows])
    assert sorted((r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == sorted(
        (i or 0, w[0], w[1], len(w[2]), w[3]) for (i, _), w in zip(rows, want)
    )
    assert suffix_dedup.suffix_dedup(docs.limit(0)).count() == 0
    left = suffix_dedup.remove_spans(docs.limit(0).select("doc_id", "text").join(suffix_dedup.suffix_dedup(docs.limit(0)), "doc_id"))
    assert left.count() == 0


def test_remove_spans(spark):
    docs = spark.createDataFrame([(1, "abcdé", [(1, 3)], "r"), (2, None, None, "r"), (3, "xy", [], "r")], "id int, text string, spans array<struct<first:long,end:long>>, row string")
    assert {r.row.id: bytes(r.kept) for r in suffix_dedup.remove_spans(docs).collect()} == {1: "adé".encode(), 2: b"", 3: b"xy"}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.binary(min_size=400, max_size=460), st.booleans()), min_size=1, max_size=6), st.data())
def test_merged_windows(pieces, data):
    suffix_dedup.SHARD = 700
    cut = data.draw(st.integers(0, 60))
    pieces += [(p[0][:400] + pieces[0][0][cut:], False) for p in pieces[:2]]
    counts = Counter()
    for text, again in pieces:
        for i in range(len(text) - 399):
            counts[text[i : i + 400]] += 2 if again else 1
    want = {(i, at) for i, (t, again) in enumerate(pieces) for at in range(len(t) - 399) if not again and counts[t[at : at + 400]] > 1}
    found = suffix_dedup.merged([(0, bytes([i]), again, t) for i, (t, again) in enumerate(pieces)])
    assert {(d[0], at) for _, d, starts in found for r in starts for at in range(r["first"], r["end"])} == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=40).map(lambda b: bytes(x % 3 for x in b)), min_size=1, max_size=6))
def test_suffix_order_and_steps_back(texts):
    sizes = np.array([len(t) for t in texts])
    ends = np.cumsum(sizes + 1) - 1
    joint = [x for i, t in enumerate(texts) for x in [*(c + 1000 for c in t), i]]  # ends of their own, earlier ones smaller
    codes = np.array([c - 999 if c >= 1000 else 0 for c in joint], np.int64)
    order = suffix_dedup.suffix_order(codes, np.repeat(ends, sizes + 1), int(sizes.max()))
    assert order.tolist() == sorted(range(len(joint)), key=lambda i: joint[i:])


RANKS = byte_pairs.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
OWN = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
SYLLABLES = ["tion", "the", "an", "er", "ouche", "é", "ing", "s", "xx", " ", "ß", "able", "1", "_", "th"]


@pytest.mark.parametrize("asked, cache", [(0, 1 << 16), (0, 50), (2, 200), (8, 1 << 16), (1 << 30, 1 << 16)])
def test_moves_searches_and_forgetting_agree_with_the_merges(monkeypatch, asked, cache):
    """Moves determinised at once, after some pieces or never; caches that forget all the time."""
    monkeypatch.setattr(byte_pairs, "ASKED", asked)
    monkeypatch.setattr(byte_pairs, "CACHE", cache)
    encoder = byte_pairs.Encoder(RANKS, public_tokenizers.PATTERN)
    rng = random.Random(asked + cache)
    for _ in range(60):
        text = "".join(rng.choice(SYLLABLES) for _ in range(rng.randrange(120)))
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == OWN.encode_ordinary(text)
    long = "".join(rng.choice(SYLLABLES[:8]) for _ in range(3000))  # one piece
    assert np.frombuffer(encoder.encode(long), "<u4").tolist() == OWN.encode_ordinary(long)


def test_chunks_of_long_texts_are_cut_where_pieces_end():
    rng = random.Random(9)
    encoder = byte_pairs.Encoder(RANKS, public_tokenizers.PATTERN)
    text = "".join(rng.choice([*SYLLABLES, "\n", "  ", "\t", "'s", ". "]) for _ in range(4000))
    whole = OWN.encode_ordinary(text)
    for size in (1, 7, 100, 5000):
        parts = list(byte_pairs.chunks(text, size))
        assert "".join(parts) == text
        assert [i for part in parts for i in np.frombuffer(encoder.encode(part), "<u4").tolist()] == whole


def test_lines_of_long_texts_go(spark):
    docs = spark.createDataFrame([(1, "a\nb\n\nc\n"), (2, "x"), (3, "\n".join(str(i) for i in range(20_000)))], "id int, t string")
    at = F.when(F.col("id") == 1, F.array(F.lit(4), F.lit(1))).when(F.col("id") == 2, F.array(F.lit(0)))
    at = at.otherwise(F.filter(F.sequence(F.lit(0), F.lit(19_999)), lambda i: i % 2 == 1))
    left = {r.id: r.left for r in docs.select("id", quality_rules.without_lines(F.col("t"), at).alias("left")).collect()}
    assert left == {1: "a\n\nc", 2: "", 3: "\n".join(str(i) for i in range(0, 20_000, 2))}


def scanned(text):
    """Base places and words of a text, by comparing words."""
    lower = (text or "").translate({ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    phrases = {"mit": "under the mit license", "apache-2": "apache license version 2", "cc-by-nc": "cc by nc"}
    found = [(i, label) for label, p in phrases.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
    places = [i for i, _ in found]
    return len(w), len(found), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in found}))


def test_license_scan_by_brute_force(spark):
    rng = random.Random(4)
    bits = ["under", "the", "MIT", "License", "apache", "version", "2", "cc", "by", "nc", "é", "Expat", "licence", "gpl", "-", "under the MIT License", "CC-BY-NC", "\n", "Apache License, Version 2.0"]
    texts = ["", None, "x" * 3000, "under the mit license " * 3000] + [" ".join(rng.choice(bits) for _ in range(rng.randrange(1, 80))) for _ in range(150)]
    rows = [(i, t, 1) for i, t in enumerate(texts)]
    rows += [(None, texts[-1], 1), (9, texts[-2], 1), (9, texts[-2], 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, id int")
    out = license_rules.license_scan(docs).collect()
    got = sorted((str(r.doc_id), r.n_words, r.n_base, str(r.first_word), str(r.last_word), r.base_labels) for r in out)
    assert got == sorted((str(i), *(str(x) if at in (2, 3) else x for at, x in enumerate(scanned(t)))) for i, t, _ in rows)
    for r in out:
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
        assert (r.score > 0) == (r.labels != "")


def test_nearest_of_very_short_and_very_long_vectors(spark):
    rng = np.random.default_rng(2)
    scales = [1e-300, 1e-200, 1.0, 1e150, 1e200, 1e300]
    vectors = {i: rng.normal(size=6) * scales[i % 6] for i in range(120)}
    vectors[200], vectors[201] = np.array([1.0, 1.0, 0, 0, 0, 0]), np.array([1e200, 2e200, 0, 0, 0, 0])
    rows = [(i, [float(x) for x in v]) for i, v in vectors.items()]
    got = posting_lists.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), every=10).collect()
    unit = {i: (v / abs(v).max()) / np.linalg.norm(v / abs(v).max()) for i, v in vectors.items()}
    queries = [i for i in vectors if i % 10 == 0]
    found = 0
    for q in queries:
        exact = sorted((i for i in vectors if i != q), key=lambda i: (-(unit[i] @ unit[q]), i))[:5]
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in mine] == [1, 2, 3, 4, 5]
        assert all(abs(r.score - unit[q] @ unit[r.vec_id]) < 1e-12 for r in mine)
        found += len({r.vec_id for r in mine} & set(exact))
    assert found >= 0.9 * 5 * len(queries)


def test_small_regions_have_all_their_pairs_over_many_partitions(spark):
    sizes = {region: 2 + region % 4 for region in range(400)}
    rows = [(region % 20, region, 7, region * 10 + i) for region, n in sizes.items() for i in range(n)]
    crowded = spark.createDataFrame(rows, "tree int, prefix long, deep long, rep long").repartition(97)
    want = {(r * 10 + i, r * 10 + j) for r, n in sizes.items() for i in range(n) for j in range(i + 1, n)}
    got = [tuple(r) for r in near_dedup.within(crowded).collect()]
    assert set(got) == want and len(got) == len(want)
    assert near_dedup.within(crowded.limit(0)).count() == 0


def test_near_copies_in_small_groups_by_brute_force(spark):
    """Groups of three to five documents whose links lie around the threshold."""
    rng = random.Random(12)
    rows, sets = [], {}
    for group in range(60):
        base = [f"g{group}w{i}" for i in range(200)]
        for _ in range(rng.randrange(3, 6)):
            words = list(base)
            at = rng.randrange(150)
            words[at : at + rng.randrange(1, 40)] = [f"x{rng.random()}"]
            rows.append((len(rows), " ".join(words)))
            sets[len(rows) - 1] = {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in sets:
        for j in range(i):
            k = len(sets[i] & sets[j])
            if 100 * k >= 85 * (len(sets[i]) + len(sets[j]) - k):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    out = near_dedup.near_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(23)).collect()
    assert {r.doc_id: r.component_id for r in out} == {i: root(i) for i in sets}
    assert len({root(i) for i in sets}) < len(sets)

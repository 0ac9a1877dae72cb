"""Each stage of the pipeline on odd rows, against brute force on that stage's own input."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from claimtide.llm import byte_pairs, source_mix

STAGES = dict(corpus_pipeline.STAGES)
SPACE = "[\x20\x09-\x0d]"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, key int, _text string, shard int, size string"
COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


def words(text):
    return [w for w in re.split(f"{SPACE}+", text or "") if w]


def odd_rows():
    rng = random.Random(8)
    prose = lambda n: " ".join(f"w{rng.randrange(400)}" for _ in range(n))
    texts = [prose(rng.randrange(1, 90)) for _ in range(40)]
    texts += [f"Menu of this very site\n{prose(60)}\nshared line of many a document\n{prose(10)}" for _ in range(30)]
    base = [f"b{i}" for i in range(120)]
    for _ in range(6):  # near copies
        at = rng.randrange(100)
        texts.append(" ".join([*base[:at], f"x{at}", *base[at + 1 :]]))
    texts += [None, "", " \n\t", "a b " * 40, prose(4000), "né <b> \x85 " + prose(30), texts[50], texts[50]]
    rows = [(i, t, "en", ["a", "b", None][i % 3] if i < 40 else "a", len(t or ""), "r", i, "t", 3, "s") for i, t in enumerate(texts)]
    rows += [(None, texts[55], "en", "a", 1, "r", 1, "t", 3, "s"), (45, texts[45], "en", "a", 1, "r", 45, "t", 3, "s"), (45, texts[46], "en", "a", 1, "r", 45, "t", 3, "s")]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


def given(rows):
    return sorted((tuple(r) for r in rows), key=str)


def line_key(line):
    return lower(re.sub(f"^{SPACE}+|{SPACE}+$", "", line))


@pytest.mark.parametrize("name", list(STAGES)[:-1])
def test_columns_stay_and_nothing_gives_nothing(spark, docs, name):
    out = STAGES[name](spark, docs, "")
    assert out.columns == COLUMNS
    assert {(r.row, r._text, r.shard, r.size, r.lang) for r in out.collect()} == {("r", "t", 3, "s", "en")}
    assert all(r.n_chars == len(r.text) for r in out.collect() if name in ("line dedup", "source mix"))
    assert STAGES[name](spark, docs.limit(0), "").count() == 0


def test_quality_rules(spark, docs):
    rows = odd_rows()
    per_host, texts = defaultdict(set), defaultdict(set)
    for r in rows:
        texts[r[3]].add(r[1] or "")
        for line in {line_key(x) for x in (r[1] or "").split("\n") if words(x)}:
            per_host[r[3], line].add(r[1])
    gone = {k for k, v in per_host.items() if len(v) >= 1000 or (len(v) >= 20 and len(v) > 0.1 * len(texts[k[0]]))}
    want = []
    for r in rows:
        w = words(r[1])
        windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        repeated = {p for i in range(len(w) - 7) if windows[tuple(w[i : i + 8])] > 1 for p in range(i, i + 8)}
        lines = (r[1] or "").split("\n")
        left = [x for x in lines if not words(x) or (r[3], line_key(x)) not in gone]
        n_left = sum(len(words(x)) for x in left)
        if len(w) >= 20 and 100 * len(repeated) <= 30 * len(w) and n_left >= 0.5 * len(w):
            want.append((r[0], "\n".join(left)))
    got = [(r.doc_id, r.text) for r in STAGES["quality rules"](spark, docs, "").collect()]
    assert given(got) == given(want) and gone and len(want) < len(rows)


def test_line_dedup(spark, docs):
    rows = odd_rows()
    holders = defaultdict(set)
    for r in rows:
        for line in (r[1] or "").split("\n"):
            if len(line_key(line)) >= 20:
                holders[line_key(line)].add(-1 if r[0] is None else r[0])
    repeated = {k: max(v) for k, v in holders.items() if len(v) >= 3}
    want = []
    for r in rows:
        own = -1 if r[0] is None else r[0]
        want.append((r[0], "\n".join(x for x in (r[1] or "").split("\n") if repeated.get(line_key(x), own) == own)))
    assert repeated
    assert given((r.doc_id, r.text) for r in STAGES["line dedup"](spark, docs, "").collect()) == given(want)


def test_near_copies(spark, docs):
    sets = defaultdict(set)
    for r in odd_rows():
        w = words(lower(r[1] or ""))
        if r[0] is not None and w:
            sets[r[0], r[1]] = {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))}
    parent = {i: i for i in {r[0] for r in odd_rows()} - {None}}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    keys = sorted(sets)
    for x in keys:
        for y in keys:
            both = len(sets[x] & sets[y])
            if x < y and 100 * both >= 80 * (len(sets[x]) + len(sets[y]) - both):
                a, b = sorted((root(x[0]), root(y[0])))
                parent[b] = a
    left = Counter(r.doc_id for r in STAGES["near copies"](spark, docs, "").collect())
    want = Counter(r[0] for r in odd_rows() if r[0] is not None and root(r[0]) == r[0])
    assert left == want and len(want) < len(parent)


def test_source_mix(spark, docs):
    rows = odd_rows()
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(words(r[1]))
    goals = dict(zip(["a", "b", None], source_mix.targets([sizes[s] for s in ("a", "b", None)], [1, 2, 3], 3)))
    taken = defaultdict(Counter)
    for r in STAGES["source mix"](spark, docs, "").collect():
        taken[r.source].update(words(r.text))
    for s, goal in goals.items():
        assert abs(sum(taken[s].values()) - goal) <= 0.05 * goal + 200
        # every word comes from the source, and none more than three times as often as there
        there = Counter(w for r in rows if r[3] == s for w in words(r[1]))
        assert all(n <= 3 * there[w] for w, n in taken[s].items())
    mixed = source_mix.source_mix(docs, carry=["doc_id"]).collect()
    assert all(0 <= r.taken <= 3 * r.size for r in mixed)
    for r in mixed:  # what a row gives is what its rounds and parts say
        assert r.taken == r.rounds * r.size + sum(p["to"] - p["from"] for p in r.parts)
        assert all(0 <= p["from"] < p["to"] <= r.size for p in r.parts)
    assert sum(r.taken for r in mixed) == sum(sum(c.values()) for c in taken.values())


def test_byte_pairs(spark, docs):
    ranks = byte_pairs.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for r in odd_rows():
        ids = own.encode_ordinary(r[1] or "")
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        want.append((r[0], len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((r[1] or "").encode()).hexdigest()))
    assert given(STAGES["byte pairs"](spark, docs, "").collect()) == given(want)

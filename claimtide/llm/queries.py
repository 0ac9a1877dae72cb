"""Queries of the operators of this subpackage, over whole tables, and their SQL."""

from __future__ import annotations

import textwrap
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .byte_pairs import round_trip
from .common import table
from .fill_middle import fill_in_middle, restored
from .hard_negatives import hard_negatives
from .line_dedup import line_dedup
from .near_dedup import near_dedup
from .license_rules import license_scan
from .posting_lists import nearest
from .quality_classifier import quality_scores
from .quality_rules import quality_rules
from .source_mix import source_mix
from .substring_dedup import substring_dedup
from .suffix_dedup import suffix_dedup
from .warc import warc_round_trip

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = textwrap.dedent(sql).strip()
        return fn

    return keep


@query(
    "op1_quality_rules",
    r"""
    WITH docs AS (
      SELECT doc_id, source, md5(text) AS copy, text,
        list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w,
        list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS l
      FROM (SELECT doc_id, source, coalesce(text, '') AS text FROM documents)
    ),
    lines AS (
      SELECT doc_id, source, copy, line,
        lower(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')) AS key
      FROM (SELECT doc_id, source, copy, unnest(l) AS line FROM docs)
    ),
    totals AS (SELECT source, count(DISTINCT copy) AS documents FROM docs GROUP BY source),
    frequent AS (
      SELECT c.source, c.key FROM (
        SELECT source, key, count(DISTINCT copy) AS n FROM lines GROUP BY ALL HAVING count(DISTINCT copy) >= 20
      ) c JOIN totals t ON c.source IS NOT DISTINCT FROM t.source
      WHERE c.n > t.documents * 0.1
    ),
    lost AS (
      SELECT doc_id, count(*) AS n_removed_lines,
        sum(len(list_filter(string_split_regex(line, '[\x20\x09-\x0D]+'), lambda w: w <> ''))) AS words
      FROM lines x JOIN frequent f ON x.source IS NOT DISTINCT FROM f.source AND x.key = f.key GROUP BY doc_id
    ),
    windows AS (
      SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS s
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM docs)
    ),
    repeats AS (
      SELECT doc_id, count(DISTINCT p) AS n FROM (
        SELECT doc_id, unnest(range(i, i + 8)) AS p
        FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, s) AS k FROM windows) WHERE k > 1
      ) GROUP BY doc_id
    ),
    measured AS (
      SELECT doc_id, len(w) AS n_words,
        length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
        len(l) - len(list_distinct(l)) AS n_dup_lines,
        coalesce(r.n, 0) AS n_repeat_words,
        len(w) < 20 OR 100 * coalesce(r.n, 0) > 30 * len(w) AS base_failed,
        coalesce(n_removed_lines, 0) AS n_removed_lines,
        (len(w) - coalesce(x.words, 0))::BIGINT AS n_left
      FROM docs LEFT JOIN repeats r USING (doc_id) LEFT JOIN lost x USING (doc_id)
    )
    SELECT *, NOT base_failed AND n_left >= n_words * 0.5 AS kept FROM measured
    """,
)
def op1_quality_rules(spark, folder):
    return quality_rules(table(spark, folder, "documents")).drop("row", "clean_text")


def byte_pair_digests(docs: DataFrame) -> DataFrame:
    """Encode, decode, and digest both; `docs` needs doc_id and text."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coded = round_trip(docs, path, public_tokenizers.PATTERN, carry=["doc_id"])
    return coded.select(
        "row.doc_id",
        "n_tokens",
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op2_byte_pairs")
def op2_byte_pairs(spark, folder):
    return byte_pair_digests(table(spark, folder, "documents"))


@query(
    "op6_line_dedup",
    r"""
    WITH lines AS (
      SELECT doc_id, i, line, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
      FROM (
        SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
      )
    ),
    repeated AS (
      SELECT key, max(doc_id) AS holder FROM lines WHERE length(key) >= 20
      GROUP BY key HAVING count(DISTINCT doc_id) >= 3
    )
    SELECT doc_id, count(*) AS n_lines, count(r.key) AS n_dropped,
      sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (r.key IS NULL), '')) AS kept_sha256
    FROM lines x LEFT JOIN repeated r ON x.key = r.key AND x.doc_id <> r.holder
    GROUP BY doc_id
    """,
)
def op6_line_dedup(spark, folder):
    kept = line_dedup(table(spark, folder, "documents"), carry=["doc_id"])
    return kept.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


@query(
    "op8_warc",
    """
    WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
    d AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha256(payload) AS payload_digest FROM p),
    f AS (SELECT payload_digest, min(page_id) AS first FROM d WHERE payload_bytes >= 100 GROUP BY 1)
    SELECT page_id, payload_bytes, payload_digest,
      CASE WHEN coalesce(first, page_id) = page_id THEN 'response' ELSE 'revisit' END AS record_type,
      CASE WHEN first <> page_id THEN first END AS refers_to
    FROM d LEFT JOIN f USING (payload_digest)
    """,
)
def op8_warc(spark, folder):
    return warc_round_trip(table(spark, folder, "pages"), scratch_path(spark, "archives"), every_row=True).drop("url")


@query("op9_source_mix")
def op9_source_mix(spark, folder):
    mixed = source_mix(table(spark, folder, "documents"), carry=["doc_id"])
    return mixed.select("row.doc_id", "size", "source_size", "target", "taken")


@query(
    "op7_near_dedup",
    r"""
    WITH RECURSIVE w AS (
      SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
      FROM documents
    ),
    s AS (
      SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) AS i FROM w)
    ),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    links AS (
      SELECT a, b FROM (
        SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL
      ) JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
      WHERE 100 * k >= 85 * (na.n + nb.n - k)
    ),
    reach(doc_id, other) AS (
      SELECT doc_id, doc_id FROM w
      UNION
      SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other
    )
    SELECT r.doc_id, coalesce(max(n.n), 0) AS n_shingles, min(other) AS component_id, r.doc_id = min(other) AS kept
    FROM reach r LEFT JOIN n USING (doc_id) GROUP BY r.doc_id
    """,
)
def op7_near_dedup(spark, folder):
    return near_dedup(table(spark, folder, "documents"))


@query(
    "op4_substring_dedup",
    r"""
    WITH d AS (
      SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
    ),
    windows AS (
      SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS s
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d)
    ),
    again AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS first FROM windows) WHERE first < doc_id),
    gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM again),
    words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
    kept AS (
      SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
    )
    SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
    FROM d LEFT JOIN kept USING (doc_id)
    """,
)
def op4_substring_dedup(spark, folder):
    return substring_dedup(table(spark, folder, "documents")).drop("spans")


@query("op3_posting_lists")
def op3_posting_lists(spark, folder):
    return nearest(table(spark, folder, "embeddings"))


@query("op5_license_rules")
def op5_license_rules(spark, folder):
    return license_scan(table(spark, folder, "documents"))


@query("op10_quality_classifier")
def op10_quality_classifier(spark, folder):
    return quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query(
    "op11_fill_in_middle",
    r"""
    WITH d AS (
      SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
        regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
      FROM documents
    ),
    cuts AS (
      SELECT *, len(u) AS n,
        least(('0x' || h[1:8])::BIGINT % (len(u) + 1), ('0x' || h[9:16])::BIGINT % (len(u) + 1)) AS low,
        greatest(('0x' || h[1:8])::BIGINT % (len(u) + 1), ('0x' || h[9:16])::BIGINT % (len(u) + 1)) AS high,
        CASE WHEN text = '' OR regexp_matches(text, '<[PSM]>') OR ('0x' || h[17:24])::BIGINT % 100 >= 50 THEN 'plain'
          WHEN ('0x' || h[25:32])::BIGINT % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
      FROM d
    ),
    pieces AS (
      SELECT *, array_to_string(u[1:low], '') AS p, array_to_string(u[low + 1:high], '') AS m, array_to_string(u[high + 1:], '') AS s FROM cuts
    )
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
      CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
      sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
      sha256(text) AS restored_sha256
    FROM pieces
    """,
)
def op11_fill_in_middle(spark, folder):
    made = fill_in_middle(table(spark, folder, "documents"), carry=["doc_id"])
    back = restored(F.col("form"), F.col("output"))
    digests = F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256")
    return made.select("row.doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


@query(
    "op12_hard_negatives",
    """
    WITH v AS (
      SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q
      FROM embeddings
      WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ),
    scores AS (
      SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
        list_sum(list_transform(list_zip(a.q, b.q), lambda x: x[1] * x[2]))::BIGINT AS score
      FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
    ),
    positives AS (
      SELECT * FROM scores WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
    )
    SELECT p.anchor_id, p.other AS positive_id,
      row_number() OVER (PARTITION BY p.anchor_id, p.other ORDER BY n.score DESC, n.other) AS rank,
      n.other AS negative_id, p.score AS positive_score, n.score AS negative_score
    FROM positives p JOIN scores n ON p.anchor_id = n.anchor_id AND NOT n.same
      AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
    QUALIFY rank <= 5
    """,
)
def op12_hard_negatives(spark, folder):
    vectors = table(spark, folder, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors, label=label)


@query(
    "op13_suffix_dedup",
    """
    WITH d AS (SELECT doc_id, row_number() OVER () AS r, encode(coalesce(text, '')) AS b FROM documents),
    w AS (SELECT r, i, md5_number(b[i:i + 399]) AS s FROM (SELECT r, b, unnest(range(1, octet_length(b) - 398)) AS i FROM d)),
    again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY s) AS n FROM w) WHERE n > 1),
    edges AS (SELECT r, i, i - lag(i) OVER (PARTITION BY r ORDER BY i) AS step FROM again),
    spans AS (
      SELECT r, g, min(i) AS first, max(i) + 399 AS stop
      FROM (SELECT r, i, sum(CASE WHEN step <= 400 THEN 0 ELSE 1 END) OVER (PARTITION BY r ORDER BY i) AS g FROM edges) GROUP BY r, g
    ),
    lists AS (SELECT r, list(first ORDER BY first) AS f, list(stop ORDER BY first) AS e, sum(stop - first + 1)::BIGINT AS gone, count(*) AS n FROM spans GROUP BY r)
    SELECT doc_id, octet_length(b) AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(n, 0) AS n_spans,
      sha256(unhex(CASE WHEN f IS NULL THEN hex(b) ELSE array_to_string(list_transform(range(1, len(f) + 2),
        lambda k: hex(b[coalesce(e[k - 1], 0) + 1:coalesce(f[k] - 1, octet_length(b))])), '') END)) AS kept_sha256
    FROM d LEFT JOIN lists USING (r)
    """,
)
def op13_suffix_dedup(spark, folder):
    return suffix_dedup(table(spark, folder, "documents")).drop("spans")

"""License scans: ordered signature rules behind a keyword prefilter.

A text is brought to words with one space between. A rule runs only where its
keyword stands; a detection inside a longer one of the same or a better priority
is suppressed. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import ascii_lower, joined, packed

#: A word of the text as it is, before lower-casing.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
APART = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"

# Phrases that always count, and their labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

# Hand-written: label, keyword, how the license is named in lower-case words. The keyword is a whole word of every such name.
FAMILIES = [
    ("mit", "mit", "mit"), ("mit", "expat", "expat"), ("mit-0", "mit", "mit (?:no attribution|0)"), ("x11", "x11", "x11"),
    ("apache-1.1", "apache", "apache(?: software)?(?: licen[cs]e)?(?: version)? 1 1"),
    ("apache-2", "apache", "(?:apache(?: software)?(?: licen[cs]e)?(?: version| v) ?2(?: 0)?|apache(?: software)?(?: licen[cs]e)? 2(?: 0)?|apache(?: software licen[cs]e| software| licen[cs]e)2(?: 0)?)"), ("apache-2", "apache2", "apache2(?: 0)?"),
    ("gpl-2", "gnu", "gnu general public licen[cs]e(?: version| v)? ?2"), ("gpl-2", "gpl", "(?:gpl(?: version| v) ?2|gpl 2)"), ("gpl-2", "gpl2", "gpl2"),
    ("gpl-3", "gnu", "gnu general public licen[cs]e(?: version| v)? ?3"), ("gpl-3", "gpl", "(?:gpl(?: version| v) ?3|gpl 3)"), ("gpl-3", "gpl3", "gpl3"),
    ("gpl", "gnu", "gnu general public"), ("gpl", "gpl", "(?:gnu )?gpl"),
    ("lgpl-2.1", "lesser", "gnu lesser general public licen[cs]e(?: version| v)? ?2 1"), ("lgpl-2.1", "lgpl", "(?:lgpl(?: version| v) ?2 1|lgpl 2 1)"), ("lgpl-2.1", "lgpl2", "lgpl2 1"),
    ("lgpl-3", "lesser", "gnu lesser general public licen[cs]e(?: version| v)? ?3"), ("lgpl-3", "lgpl", "(?:lgpl(?: version| v) ?3|lgpl 3)"), ("lgpl-3", "lgpl3", "lgpl3"),
    ("lgpl", "lesser", "gnu lesser general public"), ("lgpl", "library", "gnu library general public"),
    ("agpl-3", "affero", "gnu affero general public(?: licen[cs]e)?(?: version| v)? ?3"), ("agpl-3", "agpl", "(?:agpl(?: version| v) ?3|agpl 3)"), ("agpl-3", "agpl3", "agpl3"),
    ("agpl", "affero", "gnu affero general public"), ("gfdl", "gnu", "gnu free documentation"),
    ("bsd-2", "bsd", "(?:bsd 2 clause|2 clause bsd|simplified bsd)"), ("bsd-2", "freebsd", "freebsd"),
    ("bsd-3", "bsd", "(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd)"),
    ("bsd-4", "bsd", "(?:bsd 4 clause|4 clause bsd|original bsd)"), ("bsd", "bsd", "(?:bsd style|bsd)"), ("0bsd", "0bsd", "0bsd"),
    ("mpl-1.1", "mozilla", "mozilla public licen[cs]e(?: version| v)? ?1 1"), ("mpl-2", "mozilla", "mozilla public licen[cs]e(?: version| v)? ?2(?: 0)?"),
    ("mpl", "mozilla", "mozilla public"), ("mpl-2", "mpl", "(?:mpl(?: version| v) ?2(?: 0)?|mpl 2(?: 0)?)"), ("mpl-2", "mpl2", "mpl2(?: 0)?"),
    ("epl-1", "eclipse", "eclipse public licen[cs]e(?: version| v)? ?1(?: 0)?"), ("epl-2", "eclipse", "eclipse public licen[cs]e(?: version| v)? ?2(?: 0)?"),
    ("epl", "eclipse", "eclipse public"), ("cddl", "cddl", "cddl(?: 1 [01])?"), ("cddl", "distribution", "common development and distribution"),
    ("cpl", "common", "common public"), ("isc", "isc", "isc"), ("zlib", "zlib", "(?:zlib libpng|zlib)"), ("bsl-1", "boost", "boost software"),
    ("unlicense", "unlicense", "the unlicense"), ("wtfpl", "wtfpl", "wtfpl"), ("artistic-2", "artistic", "artistic(?: licen[cs]e)? 2(?: 0)?"),
    ("artistic", "artistic", "artistic"), ("psf", "python", "python software foundation"), ("php", "php", "php"), ("ruby", "ruby", "ruby"),
    ("openssl", "openssl", "openssl"), ("ofl-1.1", "sil", "sil open font(?: licen[cs]e)?(?: version| v)? ?1 1"), ("ofl", "font", "open font"),
    ("eupl", "european", "european union public"), ("ms-pl", "microsoft", "microsoft public"), ("ms-rl", "microsoft", "microsoft reciprocal"),
    ("osl", "open", "open software"), ("afl", "academic", "academic free"), ("ncsa", "ncsa", "(?:university of illinois )?ncsa open source"),
    ("postgresql", "postgresql", "postgresql"), ("w3c", "w3c", "w3c software"), ("cecill", "cecill", "cecill(?: [abc])?"),
    ("odbl", "odbl", "odbl"), ("odbl", "database", "open database"), ("pddl", "domain", "public domain dedication and"),
    ("cc0", "cc0", "cc0(?: 1 0)?"), ("cc0", "zero", "creative commons zero"),
    ("cc-by", "cc", "cc by(?: [1-4] [05])?"), ("cc-by", "attribution", "creative commons attribution(?: [1-4] [05])?"),
    ("cc-by-sa", "cc", "cc by sa(?: [1-4] [05])?"), ("cc-by-sa", "sharealike", "(?:creative commons )?attribution sharealike(?: [1-4] [05])?"),
    ("cc-by-nd", "cc", "cc by nd(?: [1-4] [05])?"), ("cc-by-nc", "cc", "cc by nc(?: [1-4] [05])?"),
    ("cc-by-nc", "noncommercial", "(?:creative commons )?attribution noncommercial(?: [1-4] [05])?"),
    ("cc-by-nc-sa", "cc", "cc by nc sa(?: [1-4] [05])?"), ("cc-by-nc-nd", "cc", "cc by nc nd(?: [1-4] [05])?"),
    ("all-rights-reserved", "reserved", "all rights reserved"), ("proprietary", "proprietary", "(?:proprietary and confidential|proprietary)"),
]
OFFERED = "(?:licen[cs]ed|released|distributed|published|available|provided|covered|redistributed)(?: to you)? (?:under|by|with)"
# Hand-written: priority, strength, and the words around a license's name.
FORMS = [
    (1, 1.0, "spdx license identifier NAME"),
    (2, 0.95, OFFERED + " (?:the )?(?:terms (?:and conditions )?of (?:the )?)?NAME(?: (?:public )?licen[cs]e)?"),
    (3, 0.85, "(?:see|under|by|of|using|accept|subject to) (?:the )?(?:terms of (?:the )?)?NAME (?:public )?licen[cs]e"),
    (4, 0.7, "NAME (?:public )?licen[cs]e"),
]
# Names that stand for a license without the words around them.
ALONE = {"all-rights-reserved", "cc0", "cc-by", "cc-by-sa", "cc-by-nd", "cc-by-nc", "cc-by-nc-sa", "cc-by-nc-nd", "gpl-2", "gpl-3", "lgpl-3", "agpl-3", "unlicense"}
PRIORITIES = 5
# Every phrase and every rule has one of these in its text, before lower-casing: forms 1, 3 and 4 and the phrases their own
# word, form 2 its verb and preposition, names that stand alone their keyword.
PREFILTER = rf"(?i)licen[cs]|spdx|cc{APART}+by|{OFFERED.replace(' ', APART + '+')}|(?<!{WORD[:-1]})(?:{'|'.join(sorted({k for n, k, _ in FAMILIES if n in ALONE}))})(?!{WORD[:-1]})"


def rules() -> list[tuple[int, int, float, str, str, str, bool]]:
    """(id, priority, strength, keyword, pattern, label, base) in the order of their standing."""
    made = [(0, 1.0, phrase.split()[-1] if "cc" not in phrase else "cc", phrase, label, True) for phrase, label in BASE.items()]
    for priority, strength, form in FORMS:
        made += [(priority, strength, keyword, form.replace("NAME", name), label, False) for label, keyword, name in FAMILIES]
    made += [(PRIORITIES, 0.5, keyword, name, label, False) for label, keyword, name in FAMILIES if label in ALONE]
    return [(i, p, s, k, f"(?<= )(?:{pattern})(?= )", label, base) for i, (p, s, k, pattern, label, base) in enumerate(made)]


def rule_table() -> Column:
    """The rules as one constant array."""
    return F.array(
        *[
            F.struct(
                F.lit(i).alias("id"), F.lit(p).alias("priority"), F.lit(s).alias("strength"), F.lit(f" {k} ").alias("keyword"),
                F.lit(pattern).alias("pattern"), F.lit(label).alias("label"), F.lit(base).alias("base"),
            )
            for i, p, s, k, pattern, label, base in rules()
        ]
    )


def detections(texts: DataFrame) -> DataFrame:
    """One row per detection in rows of (doc_id, copy, text): its rule, first character and end, and first word."""
    likely = texts.where(F.col("text").rlike(PREFILTER))
    spaced = F.concat(F.lit(" "), F.regexp_replace(ascii_lower(F.col("text")), f"{APART}+", " "), F.lit(" "))
    plain = likely.select("doc_id", "copy", F.regexp_replace(spaced, " +", " ").alias("plain"))
    tried = plain.select(
        "doc_id", "copy", "plain", F.explode(F.filter(rule_table(), lambda r: F.contains(F.col("plain"), r["keyword"]))).alias("rule")
    )
    matched = tried.where(F.expr("plain RLIKE rule.pattern")).select(
        "doc_id",
        "copy",
        "rule",
        "plain",
        F.expr("regexp_extract_all(plain, rule.pattern, 0)").alias("found"),
        F.expr("split(plain, rule.pattern)").alias("around"),
    )

    # lengths and blanks of each match and of what stands before it; where a match starts is a running sum of them
    def step(before, match):
        return F.struct(
            F.char_length(before).alias("gap"),
            F.char_length(match).alias("length"),
            F.regexp_count(before, F.lit(" ")).alias("gap_blanks"),
            F.regexp_count(match, F.lit(" ")).alias("blanks"),
        )

    steps = F.zip_with(F.slice("around", 1, F.size("found")), "found", step)
    each = matched.select("doc_id", "copy", "rule", F.posexplode(steps).alias("at", "s"))
    # repeated rows stand at the same places, so their sums count each place that many times
    by_rule = Window.partitionBy("doc_id", "copy", "rule.id").orderBy("at")
    rows = F.sum((F.col("at") == 0).cast("long")).over(by_rule)
    chars = F.sum((F.col("s.gap") + F.col("s.length")).cast("long")).over(by_rule)
    blanks = F.sum((F.col("s.gap_blanks") + F.col("s.blanks")).cast("long")).over(by_rule)
    placed = each.select("doc_id", "copy", "rule.*", "s", rows.alias("_rows"), chars.alias("_chars"), blanks.alias("_blanks"))
    ends, last = F.expr("_chars div _rows"), F.expr("_blanks div _rows")
    return placed.select(
        "doc_id",
        "copy",
        "id",
        "priority",
        "strength",
        "label",
        "base",
        (ends - F.col("s.length")).alias("start"),
        ends.alias("end"),
        (last - F.col("s.blanks") - 1).alias("word"),
    )


def license_scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    The score is the strength of the strongest detection that stands, 0 without.

    Null or empty text: no words, no labels, score 0. Equal intervals: the
    better priority stands, then the earlier rule. Repeated rows and null ids:
    each row gets the result of its own text. Empty table: no rows.
    """
    base = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("copy"), F.col(text).alias("text"))
    found = detections(base.select("doc_id", "copy", "text")).distinct()
    order = Window.partitionBy("doc_id", "copy").orderBy("start", F.desc("end"), "priority", "id")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    reach = [F.max(F.when(~F.col("base") & (F.col("priority") <= p), F.col("end"))).over(before) for p in range(1, PRIORITIES + 1)]
    covered = F.coalesce(F.get(F.array(*reach), F.col("priority") - 1) >= F.col("end"), F.lit(False))
    judged = found.withColumn("stands", F.col("base") | ~F.when(F.col("base"), F.lit(False)).otherwise(covered))
    per_document = judged.groupBy("doc_id", "copy").agg(
        F.sum(F.col("base").cast("long")).alias("n_base"),
        F.min(F.when(F.col("base"), F.col("word"))).alias("first_word"),
        F.max(F.when(F.col("base"), F.col("word"))).alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("base"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("stands"), F.col("label")))), ",").alias("labels"),
        F.max(F.when(F.col("stands"), F.col("strength"))).alias("score"),
    )
    counted = base.select("doc_id", "copy", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("n_words"))
    return joined(counted, per_document, ["doc_id", "copy"], "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )

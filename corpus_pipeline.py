"""From raw documents to token ids: five stages, each written and read again before the next.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of documents. The byte-pair stage can't be written in SQL, so
there is no ORACLE_SQL; tests hold the stages against brute force.

For all stages: further columns of any name ride along unchanged, except that
`n_chars`, where there is one, follows the text. Texts of any length are taken
whole. An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimtide.llm.common import words
from claimtide.llm.line_dedup import line_dedup
from claimtide.llm.near_dedup import without_near_copies
from claimtide.llm.quality_rules import quality_rules
from claimtide.llm.queries import byte_pair_digests
from claimtide.llm.source_mix import source_mix
from claimtide.session import stored

ORACLE_SQL = None
#: A line in so many texts of a host goes, whatever share of the host they are.
ALWAYS = 1_000


def with_text(rows: DataFrame, text) -> DataFrame:
    """The columns of `row` with another text; n_chars follows it."""
    replaced = rows.select(F.col("row"), text.alias("_text"))
    columns = [
        F.col("_text").alias(c) if c == "text" else F.char_length("_text").cast("long").alias(c) if c == "n_chars" else F.col(f"row.`{c}`")
        for c in rows.schema["row"].dataType.names
    ]
    return replaced.select(*columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; lines above the limits of their host, or in ALWAYS of its texts, go from the others.

    Null or empty texts have under 20 words and are rejected. A null source is a
    host of its own. Repeated rows count as one text, and all stay or all go.
    Null ids: rows like any other. Ties do not occur: limits are counts.
    """
    return with_text(quality_rules(docs, always=ALWAYS).where("kept"), F.col("clean_text"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that three documents share go from all but the one with the largest id; every document stays.

    Null text: becomes an empty one. Null ids: one document together, smaller
    than any id. Rows of one id are one document in the counts and agree on the
    lines that go. Ties: the largest id holds a line, so there are none.
    """
    return with_text(line_dedup(docs), F.col("kept_text"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similarity 0.8 or more stays, that with the smallest id.

    Null or empty texts are similar to nothing and stay. Rows of one id are one
    document: all of them stay or go. A row without an id goes if its text has
    the shingles of one with an id, else it stays. Ties: the smallest id stays.
    """
    return without_near_copies(docs, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; the words of a part are joined by one space.

    Null or empty texts and texts without words are never taken. A null source is
    the last source. Null ids: rows like any other. Repeated rows are taken each
    for itself; which of them has which share of the seeded order is open, as
    they tie, and what they have together is not.
    """
    mixed = source_mix(docs)
    found = words(F.col("row.text"))
    parts = F.transform("parts", lambda x: F.array_join(F.slice(found, (x["from"] + 1).cast("int"), (x["to"] - x["from"]).cast("int")), " "))
    texts = F.concat(F.array_repeat(F.col("row.text"), F.col("rounds").cast("int")), F.when(F.size("parts") > 0, parts).otherwise(F.array().cast("array<string>")))
    copies = mixed.where("taken > 0").select("row", F.explode(texts).alias("text"))
    return with_text(copies, F.col("text"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and of the bytes decoded from them.

    Null or empty text: no tokens. Null ids and repeated rows: each row by
    itself. No ties.
    """
    return byte_pair_digests(docs)


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("near copies", near_copies),
    ("source mix", mix),
    ("byte pairs", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

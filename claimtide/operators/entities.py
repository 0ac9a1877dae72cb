"""Entities: merging of tagged pieces, tables of words per tag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import text as tx
from .filters import short_texts

# Type of a word so far, type of its next piece, new type.
# Pieces after type O and the first piece of a word set their own type.
WORD_TYPES = {
    "BB": "B", "BI": "B", "BO": "B", "BE": "S", "BS": "B",
    "IB": "I", "II": "I", "IO": "I", "IE": "S", "IS": "S",
    "EB": "E", "EI": "I", "EO": "E", "EE": "E", "ES": "E",
    "SB": "B", "SI": "I", "SO": "S", "SE": "S", "SS": "S",
}


def merge_pieces(pieces: DataFrame, id_: str = "text_id") -> DataFrame:
    """Words out of subword pieces (id, pos, word_start, word, tag, score, start, end).

    A piece with word_start opens a new word; the end of the text closes the
    last one.
    """
    numbered = pieces.withColumn(
        "word_no", F.sum(F.col("word_start").cast("int")).over(W.partitionBy(id_).orderBy("pos"))
    )
    # one word's pieces at a time
    words = numbered.groupBy(id_, "word_no").agg(
        F.sort_array(F.collect_list(F.struct("pos", "word", "tag"))).alias("p"),
        F.mode(F.when(F.col("tag") != "O", F.substring("tag", 2, 1000)), deterministic=True).alias("kind"),
        F.avg("score").alias("score"),
        F.min("start").alias("start"),
        F.max("end").alias("end"),
    )
    table = F.create_map(*[F.lit(x) for pair in WORD_TYPES.items() for x in pair])

    def next_type(state: Column, piece: Column) -> Column:
        kind = F.substring(piece["tag"], 1, 1)
        now = F.when(state["now"] == "O", kind).otherwise(table[F.concat(state["now"], kind)])
        return F.struct(
            now.alias("now"), F.when(piece["tag"] != "O", now).otherwise(state["shown"]).alias("shown")
        )

    start = F.struct(F.lit("O").alias("now"), F.lit("O").alias("shown"))
    shown = F.aggregate("p", start, next_type, lambda s: s["shown"])
    return words.select(
        id_,
        F.col("word_no").alias("pos"),
        F.array_join(F.transform("p", lambda x: x["word"]), "").alias("word"),
        F.when(F.col("kind").isNull(), F.lit("O")).otherwise(F.concat(shown, F.col("kind"))).alias("tag"),
        "score",
        "start",
        "end",
    )


def merge_spans(words: DataFrame, id_: str = "text_id") -> DataFrame:
    """Entities out of tagged words (id, pos, word, tag, score, start, end).

    An entity opens at B, grows over I and closes at E; S stands alone; a word
    that breaks the order closes what is open. An entity left open at the end
    is dropped. Texts are short, so a window holds one text.
    """
    kind = F.substring("tag", 1, 1)
    by_text = W.partitionBy(id_).orderBy("pos")
    earlier = by_text.rowsBetween(W.unboundedPreceding, -1)
    df = words.withColumn("_k", kind)
    df = df.withColumn("_segment", F.coalesce(F.sum(F.col("_k").isin("O", "S", "E").cast("int")).over(earlier), F.lit(0)))
    opened = W.partitionBy(id_, "_segment").orderBy("pos").rowsBetween(W.unboundedPreceding, -1)
    inside = F.coalesce(F.sum((F.col("_k") == "B").cast("int")).over(opened), F.lit(0)) % 2 == 1
    df = df.withColumn("_inside", inside)
    closes = F.when(F.col("_inside"), F.col("_k") != "I").otherwise(F.col("_k").isin("S", "I", "E"))
    df = df.withColumn("_closes", closes.cast("int"))
    df = df.withColumn("entity_no", F.coalesce(F.sum("_closes").over(earlier), F.lit(0)))
    df = df.withColumn("_total", F.sum("_closes").over(W.partitionBy(id_)))
    df = df.where((F.col("tag") != "O") & (F.col("entity_no") < F.col("_total")))
    merged = df.groupBy(id_, "entity_no").agg(
        F.array_join(
            F.transform(F.sort_array(F.collect_list(F.struct("pos", "word"))), lambda x: x["word"]), ""
        ).alias("word"),
        F.mode(F.substring("tag", 3, 1000), deterministic=True).alias("entity"),
        F.avg("score").alias("score"),
        F.min("start").alias("start"),
        F.max("end").alias("end"),
    )
    return merged


def tagged_spans(texts: DataFrame, id_: str, text: str, gazetteer: DataFrame, other: str = "ENT") -> DataFrame:
    """Distinct (id, tag, word) of capitalised runs in texts under 500 characters.

    The tag comes from a gazetteer (word, tag) with unique words; other runs
    get a common tag. A trained tagger's table of the same shape fits as well.
    """
    spans = short_texts(texts, text).select(id_, F.explode(tx.capitalised_runs(text)).alias("span"))
    words = spans.select(id_, tx.clean_word("span").alias("word")).where(F.col("word") != "").distinct()
    joined = words.join(gazetteer.select("word", "tag"), "word", "left")
    return joined.select(id_, F.coalesce("tag", F.lit(other)).alias("tag"), "word")


def words_per_tag(spans: DataFrame, id_: str) -> DataFrame:
    """Map of tag to sorted distinct words per text."""
    # texts are under 500 characters, which bounds both collections
    per_tag = spans.groupBy(id_, "tag").agg(F.sort_array(F.collect_set("word")).alias("words"))
    return per_tag.groupBy(id_).agg(F.map_from_entries(F.collect_list(F.struct("tag", "words"))).alias("tags"))


def entity_table(claims: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Claims (fact_id, claim, review) cleaned of links and tags, with entity maps."""
    cleaned = claims.withColumns({c: tx.strip_html(c) for c in ("claim", "review")})
    cleaned = cleaned.withColumns({f"urls_{c}": tx.find_urls(c) for c in ("claim", "review")})
    cleaned = cleaned.withColumns({c: tx.drop_urls(c) for c in ("claim", "review")})
    for part in ("claim", "review"):
        spans = tagged_spans(cleaned, "fact_id", part, gazetteer)
        tags = words_per_tag(spans, "fact_id").withColumnRenamed("tags", f"ner_{part}")
        cleaned = cleaned.join(tags, "fact_id", "left")
    return cleaned

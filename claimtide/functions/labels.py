"""Label vocabularies and threshold rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Annotation labels and what each task makes of them.
ANNOTATION_LABELS = {
    "Difunde la claim falsa": "The text disseminates the false claim",
    "Es sobre la claim pero no la apoya": "The text is about the claim, but it does not support it",
    "Es sobre el tema pero no sobre la misma claim": "The text is on topic but not about this precise claim",
    "Es otro tema": "The text is on another topic",
    "Tweet ilegible": "The text is not readable",
}
TOPIC_OF_LABEL = {
    "Difunde la claim falsa": "on-topic",
    "Es sobre la claim pero no la apoya": "on-topic",
    "Es sobre el tema pero no sobre la misma claim": "on-topic",
    "Es otro tema": "off-topic",
    "Tweet ilegible": "off-topic",
}
CLAIM_OF_LABEL = {
    "Difunde la claim falsa": "on-claim",
    "Es sobre la claim pero no la apoya": "on-claim",
    "Es sobre el tema pero no sobre la misma claim": "off-claim",
    "Es otro tema": "off-claim",
    "Tweet ilegible": "off-claim",
}
FINER_OF_LABEL = {
    "Difunde la claim falsa": "disseminates",
    "Es sobre la claim pero no la apoya": "not-disseminates",
}
ORDINAL_OF_LABEL = {
    "The text disseminates the false claim": 0.0,
    "The text is about the claim, but it does not support it": 0.25,
    "The text is on topic but not about this precise claim": 0.5,
    "The text is on another topic": 0.75,
    "The text is not readable": 1.0,
}
TASK_LABELS = {
    "topic_relation": ("on-topic", "off-topic"),
    "claim_relation": ("on-claim", "off-claim"),
    "claim_finer_relation": ("disseminates", "not-disseminates"),
}
THRESHOLDS = {
    ("news", "topic_relation"): 0.29,
    ("messages", "topic_relation"): 0.82,
    ("messages", "claim_relation"): 0.85,
}


def literal_map(values: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def translate_label(c, values: dict) -> Column:
    """Mapped value, null where the vocabulary has none."""
    c = F.col(c) if isinstance(c, str) else c
    return literal_map(values)[c]


def label_above(score: Column, threshold, task: str) -> Column:
    """Positive label only strictly above the threshold; null score, null label."""
    positive, negative = TASK_LABELS[task]
    threshold = threshold if isinstance(threshold, Column) else F.lit(threshold)
    return F.when(score > threshold, positive).when(score.isNotNull(), negative)


def label_greater(claim_score: Column, review_score: Column, ties_positive: bool = False) -> Column:
    positive, negative = TASK_LABELS["claim_finer_relation"]
    wins = claim_score >= review_score if ties_positive else claim_score > review_score
    known = claim_score.isNotNull() & review_score.isNotNull()
    return F.when(known & wins, positive).when(known, negative)

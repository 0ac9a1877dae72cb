"""Sampling of claims and of their messages for annotation."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions import times
from ..operators import filters, joins, keyed


def sampled_messages(
    claims: DataFrame,
    messages: DataFrame,
    start,
    end,
    excluded: list[str],
    verdicts: list[str] | None = None,
    claims_per_day: int = 2,
    messages_per_claim: int = 20,
    seed: int = 0,
) -> DataFrame:
    """Random messages of the first eligible claims of each day.

    `messages`: (tweet_id, fact_id as a list of claims, ...). Both limits are
    cut on the map side, so a busy day or claim does not pile up in one task.
    """
    eligible = filters.eligible_for_sampling(claims, start, end, excluded, verdicts)
    daily = eligible.withColumn("_day", times.day_text("date"))
    first = keyed.cap_per_key(daily, ["_day"], ["date", "fact_id"], claims_per_day, "_place")
    linked = joins.messages_of_claims(messages, first.select("fact_id", "claim", "review"))
    return keyed.sample_per_key(linked, ["fact_id"], ["message_id"], messages_per_claim, seed)

"""Similarity of claims and messages, labels, and their evaluation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import labels as lb
from ..functions import vectors as vx
from ..session import stored
from . import aggregates, joins


def hashed_vectors(
    texts: DataFrame, id_: str, tokens: Column, size: int = 256, hashed: Column | None = None
) -> DataFrame:
    """(id, vector) by hashed word counts weighted by inverse document frequency.

    Default producer of vectors; others plug in as a table of the same shape.
    A word's slot comes from `hashed` over a column named `word`. Texts are cut
    into words once: the counts of each text are stored, and both frequencies
    and vectors come from them.
    """
    slot = F.pmod(F.xxhash64("word") if hashed is None else hashed, F.lit(size)).cast("int")
    # outer, since the plain form adds a filter that would cut the words once more
    words = texts.select(id_, F.explode_outer(tokens).alias("word")).where(F.col("word").isNotNull())
    counts = words.groupBy(id_, slot.alias("slot")).agg(F.count("*").alias("tf"))
    # one text's slots, at most `size` of them
    rows = stored(counts.groupBy(id_).agg(F.map_from_entries(F.collect_list(F.struct("slot", "tf"))).alias("tf")), "counts")
    total = texts.agg(F.count("*")).scalar()
    frequency = rows.select(F.explode(F.map_keys("tf")).alias("slot")).groupBy("slot").agg(F.count("*").alias("df"))
    weight = F.log((total + 1) / (F.col("df") + 1))
    # one row of at most `size` slots
    weights = frequency.agg(F.map_from_entries(F.collect_list(F.struct("slot", weight))).alias("idf"))
    slots = F.sequence(F.lit(0), F.lit(size - 1))
    filled = F.transform(slots, lambda i: F.coalesce(F.col("tf")[i] * F.col("idf")[i], F.lit(0.0)))
    return rows.crossJoin(F.broadcast(weights)).select(id_, filled.alias("vector"))


def score_pairs(
    pairs: DataFrame, claim_vectors: DataFrame, message_vectors: DataFrame, name: str = "score"
) -> DataFrame:
    """Cosine of each (fact_id, message_id) pair; null when a text is missing.

    Norms are taken once per text, before the vectors meet the pairs.
    """
    c = claim_vectors.select("fact_id", F.col("vector").alias("_c"), vx.norm("vector").alias("_cn"))
    m = message_vectors.select("message_id", F.col("vector").alias("_m"), vx.norm("vector").alias("_mn"))
    joined = pairs.join(c, "fact_id", "left").join(m, "message_id", "left")
    score = vx.cosine(F.col("_c"), F.col("_m"), F.col("_cn"), F.col("_mn"))
    return joined.withColumn(name, score).drop("_c", "_cn", "_m", "_mn")


def classify(scored: DataFrame, task: str, source: str = "messages", threshold: float | None = None) -> DataFrame:
    """Label per pair by the task's threshold."""
    limit = lb.THRESHOLDS[(source, task)] if threshold is None else threshold
    return scored.withColumn(task, lb.label_above(F.col("score"), limit, task))


def classify_finer(
    pairs: DataFrame, claim_vectors: DataFrame, review_vectors: DataFrame, message_vectors: DataFrame
) -> DataFrame:
    """On-claim pairs only: nearer to the claim disseminates, else not."""
    on_claim = pairs.where(F.col("claim_relation") == "on-claim")
    scored = score_pairs(on_claim, claim_vectors, message_vectors, "claim_score")
    scored = score_pairs(scored, review_vectors, message_vectors, "review_score")
    return scored.withColumn(
        "claim_finer_relation", lb.label_greater(F.col("claim_score"), F.col("review_score"))
    )


def last_label(labelled: DataFrame, task: str, order: str = "fact_id") -> DataFrame:
    """One label per message: that of its last claim."""
    return labelled.groupBy("message_id").agg(F.max_by(task, order).alias(task))


def mark_done(features: DataFrame, labelled: DataFrame, marker: str, now) -> DataFrame:
    """Set the marker of claims that were classified."""
    done = labelled.select("fact_id").distinct().withColumn("_done", F.lit(True))
    joined = features.join(done, "fact_id", "left")
    stamp = F.when(F.col("_done"), F.lit(now).cast("timestamp")).otherwise(F.col(marker))
    return joined.withColumn(marker, stamp).drop("_done")


def nearest_and_farthest(scored: DataFrame, key: str, distance: str, message_id: str, k: int = 5) -> DataFrame:
    """k nearest and k farthest messages per claim.

    Each rank filter is cut to k rows per claim on the map side first.
    """
    near = W.partitionBy(key).orderBy(distance, message_id)
    far = W.partitionBy(key).orderBy(F.desc(distance), F.desc(message_id))
    out = None
    for side, w in (("related", near), ("not related", far)):
        top = scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
        top = top.withColumn("side", F.lit(side))
        out = top if out is None else out.unionByName(top)
    return out


def related_messages(
    claims: DataFrame,
    messages: DataFrame,
    claim_vectors: DataFrame,
    message_vectors: DataFrame,
    days: int = 15,
    k: int = 5,
    links: DataFrame | None = None,
) -> DataFrame:
    """Nearest and farthest messages inside the date window of each claim, of its linked ones if `links` are given."""
    pairs = joins.messages_near_claim(messages, claims, days, links=links).select("fact_id", "message_id")
    scored = score_pairs(pairs, claim_vectors, message_vectors)
    scored = scored.withColumn("distance", 1 - F.col("score")).where(F.col("distance").isNotNull())
    return nearest_and_farthest(scored, "fact_id", "distance", "message_id", k)


def gold_and_predicted(gold: DataFrame, predicted: DataFrame, task: str, mapping: dict[str, str]) -> DataFrame:
    """Pairs of mapped gold label and stored label, by message id.

    `gold`: (_id = message_claim, label); rows whose label has no mapping and
    messages without a stored label are left out.
    """
    g = gold.select(
        F.split("_id", "_")[0].alias("message_id"), lb.translate_label("label", mapping).alias("gold")
    ).where(F.col("gold").isNotNull())
    p = predicted.select(F.col("message_id").cast("string").alias("message_id"), F.col(task).alias("predicted"))
    return g.join(p.where(F.col("predicted").isNotNull()), "message_id")


def evaluate(gold: DataFrame, predicted: DataFrame, task: str, mapping: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Confusion cells and class report of one task."""
    cells = aggregates.confusion(gold_and_predicted(gold, predicted, task, mapping))
    return cells, aggregates.class_report(cells)


def mean_scores(scores: DataFrame, label: str = "label", keys: tuple = ()) -> DataFrame:
    return scores.groupBy(*keys, label).agg(F.avg("score").alias("mean_score"), F.count("*").alias("n"))


def score_correlation(scores: DataFrame, ordinal: str = "ordinal", keys: tuple = ()) -> DataFrame:
    """Pearson correlation; null when either side is constant."""
    spread_of = F.stddev_pop("score") * F.stddev_pop(ordinal)
    return scores.groupBy(*keys).agg(F.try_divide(F.covar_pop("score", ordinal), spread_of).alias("correlation"))


def tune_threshold(
    scores: DataFrame, keys: tuple = ("model",), trials: int = 5, metric: str = "macro_precision"
) -> DataFrame:
    """Best threshold between the class means, per model.

    Candidates: lower mean, upper mean, then the steps between them; the first
    best one wins. A model that lacks a class has no threshold. All candidates are counted in one pass over the scores
    (score, target in 0/1), then compared on one row per model.
    """
    keys = list(keys)
    means = scores.groupBy(*keys).agg(
        F.avg(F.when(F.col("target") == 1, F.col("score"))).alias("upper"),
        F.avg(F.when(F.col("target") == 0, F.col("score"))).alias("lower"),
    )
    bit = (F.col("upper") - F.col("lower")) / trials
    steps = [F.when(F.col("upper") >= F.col("lower"), F.col("lower") + bit * i) for i in range(1, trials)]
    both = F.col("upper").isNotNull() & F.col("lower").isNotNull()
    candidates = means.select(*keys, F.when(both, F.array("lower", "upper", *steps)).alias("t"))
    joined = scores.join(stored(candidates, "candidates"), keys)
    sums = []
    for i in range(trials + 1):
        above = F.col("score") > F.col("t")[i]
        sums += [
            F.count_if(above & (F.col("target") == 1)).alias(f"tp{i}"),
            F.count_if(above & (F.col("target") == 0)).alias(f"fp{i}"),
            F.count_if(~above & (F.col("target") == 0)).alias(f"tn{i}"),
            F.count_if(~above & (F.col("target") == 1)).alias(f"fn{i}"),
        ]
    counted = joined.groupBy(*keys).agg(F.first("t").alias("t"), *sums)

    def rate(hit: Column, miss: Column) -> Column:
        return F.when(hit + miss > 0, hit / (hit + miss)).otherwise(0.0)

    def quality(i: int) -> Column:
        tp, fp, tn, fn = (F.col(f"{c}{i}") for c in ("tp", "fp", "tn", "fn"))
        if metric == "accuracy":
            return (tp + tn) / F.nullif(tp + fp + tn + fn, F.lit(0))
        has_one, has_zero = tp + fp + fn > 0, tn + fn + fp > 0
        classes = has_one.cast("int") + has_zero.cast("int")
        rates = F.when(has_one, rate(tp, fp)).otherwise(0.0) + F.when(has_zero, rate(tn, fn)).otherwise(0.0)
        return rates / F.nullif(classes, F.lit(0))

    options = F.array(
        *[
            F.struct(quality(i).alias("q"), F.lit(-i).alias("order"), F.col("t")[i].alias("threshold"))
            for i in range(trials + 1)
        ]
    )
    best = F.array_max(F.filter(options, lambda o: o["threshold"].isNotNull()))
    picked = counted.select(*keys, best.alias("b"))
    good = F.col("b.q") > 0
    return picked.select(
        *keys,
        F.when(good, F.col("b.threshold")).when(~good, 0.0).alias("threshold"),
        F.when(good, F.col("b.q")).when(~good, 0.0).alias("quality"),
    )


def compare_models(scores: DataFrame, keys: tuple = ("model", "source")) -> DataFrame:
    """Correlation, threshold and quality of several score columns at once.

    Input: keys, score, target, ordinal.
    """
    best = tune_threshold(scores, keys)
    return best.join(score_correlation(scores, "ordinal", keys), list(keys))


def compare_three_way(predictions: DataFrame, keys: tuple = ("model",)) -> DataFrame:
    """Class report of entail / contradict / neutral predictions per model."""
    return aggregates.class_report(aggregates.confusion(predictions, keys=keys), keys)

"""Quality classifier: a sparse ensemble of rules.

Paths of small trees over text statistics become conjunctive rules, a lasso
logistic fit keeps few of them, and these compile into one column expression.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .common import joined
from .quality_rules import statistics

#: Most labelled rows that the fit sees, chosen by a hash of their id.
TRAINING_ROWS = 20_000
TREES, DEPTH = 20, 3
LASSO = 0.002
SEED = 20240305

Rule = tuple[tuple[str, str, float], ...]


def features(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """Statistics of each text beside the `keep` columns; none of them looks at anything else."""
    counts = docs.select(
        *keep,
        F.col(text),
        F.coalesce(F.char_length(text), F.lit(0)).alias("_n"),
        F.coalesce(F.regexp_count(text, F.lit(r"\p{Lu}")), F.lit(0)).alias("_upper"),
        F.coalesce(F.regexp_count(text, F.lit(r"[!?]")), F.lit(0)).alias("_marks"),
        F.coalesce(F.regexp_count(text, F.lit(r"[.,;:]")), F.lit(0)).alias("_stops"),
        F.coalesce(F.regexp_count(text, F.lit(r"[0-9]")), F.lit(0)).alias("_digits"),
        F.coalesce(F.regexp_count(text, F.lit(r"\n")) + 1, F.lit(1)).alias("_lines"),
    )
    own = ["_n", "_upper", "_marks", "_stops", "_digits", "_lines"]
    full = statistics(counts, text, [*keep, *own])
    many = F.greatest(F.col("n_words"), F.lit(1))
    chars = F.greatest(F.col("_n"), F.lit(1))
    return full.select(
        *keep,
        F.log1p(F.col("n_words").cast("double")).alias("f_words"),
        (F.col("word_chars") / many).alias("f_word_length"),
        (F.col("n_symbols") / many).alias("f_symbols"),
        (F.col("n_dup_lines") / F.col("_lines")).alias("f_dup_lines"),
        (F.col("n_repeat_words") / many).alias("f_repeats"),
        (F.col("_upper") / chars).alias("f_upper"),
        (F.col("_marks") / many).alias("f_marks"),
        (F.col("_stops") / many).alias("f_stops"),
        (F.col("_digits") / chars).alias("f_digits"),
        (many / F.col("_lines")).alias("f_line_words"),
    )


NAMES = ["f_words", "f_word_length", "f_symbols", "f_dup_lines", "f_repeats", "f_upper", "f_marks", "f_stops", "f_digits", "f_line_words"]


def paths(described: str) -> list[Rule]:
    """Every path from a root to a node, as conditions in a fixed order, from the printed form of a forest."""
    found: dict[Rule, None] = {}
    path: list[tuple[str, str, float]] = []
    for line in described.splitlines():
        if line.lstrip().startswith("Tree "):
            path = []
        part = re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line)
        if part:
            level = max(0, len(part[1]) - 4)  # a root stands at four blanks, each level one further
            path = [*path[:level], (NAMES[int(part[2])], part[3], float(part[4]))]
            found[tuple(sorted(set(path)))] = None
    return list(found)


def condition(rule: Rule) -> Column:
    parts = [F.col(name) <= F.lit(at) if sign == "<=" else F.col(name) > F.lit(at) for name, sign, at in rule]
    return reduce(lambda a, b: a & b, parts)


class RuleEnsemble:
    """Weighted rules; `score` is a column over the columns of `features`."""

    def __init__(self, intercept: float, weights: dict[Rule, float]):
        self.intercept, self.weights = intercept, weights

    def score(self) -> Column:
        total = F.lit(float(self.intercept))
        for rule, weight in self.weights.items():
            total = total + F.when(condition(rule), F.lit(float(weight))).otherwise(F.lit(0.0))
        return 1.0 / (1.0 + F.exp(-total))


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that the fit must not see."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, most: int = TRAINING_ROWS) -> DataFrame:
    """Features and label of at most `most` labelled rows that are not held out.

    Rows without a label or id are left out; of several labels of an id the largest counts.
    """
    marked = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id").agg(F.max("quality").cast("double").alias("label"))
    chosen = marked.where(~held_out()).orderBy(F.xxhash64("doc_id", F.lit(SEED)), "doc_id").limit(most)
    texts = docs.select("doc_id", "text").join(chosen, "doc_id")
    return features(texts, ["doc_id", "label"])


def fit(rows: DataFrame) -> RuleEnsemble:
    """Trees, their rules, and the lasso fit; without two classes only their share, without rows one half."""
    rows = stored(rows.select("label", *NAMES), "training-rows")
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return RuleEnsemble(0.0 if not counts else (4.0 if 1.0 in counts else -4.0), {})
    total = sum(counts.values())
    weighted = rows.withColumn("weight", F.when(F.col("label") == 1, total / (2 * counts[1.0])).otherwise(total / (2 * counts[0.0])))
    vectors = VectorAssembler(inputCols=NAMES, outputCol="features").transform(weighted)
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, weightCol="weight", featureSubsetStrategy="onethird")
    found = paths(forest.fit(vectors).toDebugString)
    if not found:
        return RuleEnsemble(0.0, {})
    fired = weighted.select("label", *[condition(r).cast("double").alias(f"r{i}") for i, r in enumerate(found)])
    fired = VectorAssembler(inputCols=[f"r{i}" for i in range(len(found))], outputCol="features").transform(fired).select("label", "features")
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=LASSO, standardization=False, maxIter=100)
    model = lasso.fit(stored(fired, "fired-rules"))
    weights = {r: w for r, w in zip(found, model.coefficients.toArray().tolist()) if w != 0.0}
    return RuleEnsemble(model.intercept, weights)


def quality_scores(docs: DataFrame, labels: DataFrame, most: int = TRAINING_ROWS) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted.

    Null or empty text: scored by its statistics, all of no words. Null id: not
    held out, and never trained on. Repeated rows: each scored, all alike.
    Labels that are null, not 0 or 1, or of unknown ids are not used. Empty
    table: no rows. `docs` needs doc_id and text, `labels` doc_id and quality.
    """
    model = fit(training_rows(docs, labels, most))
    scored = features(docs, ["doc_id"]).select("doc_id", held_out().alias("held_out"), model.score().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))

"""Tests and fits on per-claim measures."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from ..session import stored
from . import ranking


@F.pandas_udf(T.DoubleType())
def _two_sided(z: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for part in z:
        yield part.map(lambda v: math.erfc(abs(v) / math.sqrt(2)))


def iqr_fences(df: DataFrame, value: str, factor: float = 1.5) -> DataFrame:
    """One row: quartiles and both fences."""
    q = ranking.exact_percentiles(df, [], value, {"q1": 0.25, "q3": 0.75})
    width = (F.col("q3") - F.col("q1")) * factor
    return q.withColumns({"low": F.col("q1") - width, "high": F.col("q3") + width})


def iqr_outliers(df: DataFrame, value: str, factor: float = 1.5, inside: bool = False) -> DataFrame:
    """Rows outside the fences, or the others with `inside`."""
    fences = iqr_fences(df, value, factor)
    low, high = fences.select("low").scalar(), fences.select("high").scalar()
    out = (F.col(value) < low) | (F.col(value) > high)
    return df.where(~out if inside else out)


def wilcoxon_signed_rank(pairs: DataFrame, a: str = "before", b: str = "after") -> DataFrame:
    """Signed-rank statistic with its normal approximation.

    Zero differences are dropped and ties share the average rank. Pairs are
    folded to one row per distinct absolute difference before ranking.
    """
    d = F.col(b) - F.col(a)
    folded = (
        pairs.where(d != 0)
        .groupBy(F.abs(d).cast("double").alias("size"))
        .agg(F.count("*").alias("n"), F.count_if(d > 0).alias("positive"))
    )
    ranked = ranking.running_totals(folded, [], "size")
    rank = F.col("_before") + (F.col("n") + 1) / 2
    n = F.col("n").cast("double")
    sums = ranked.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.sum(F.col("positive") * rank).alias("r_plus"),
        F.sum((F.col("n") - F.col("positive")) * rank).alias("r_minus"),
        F.sum(n * n * n - n).alias("ties"),
    )
    m = F.col("n").cast("double")
    spread = F.sqrt((m * (m + 1) * (2 * m + 1) - F.col("ties") / 2) / 24)
    scored = sums.withColumn("statistic", F.least("r_plus", "r_minus")).withColumn(
        "z", F.when(spread > 0, (F.col("statistic") - m * (m + 1) / 4) / spread)
    )
    return scored.select("n", "r_plus", "r_minus", "statistic", "z", _two_sided("z").alias("p"))


def normality_test(df: DataFrame, value: str) -> DataFrame:
    """Omnibus test from skewness and kurtosis; p from chi-square with 2 degrees."""
    v = F.col(value).cast("double")
    m = df.agg(
        F.count(v).cast("double").alias("n"), F.skewness(v).alias("skew"), F.kurtosis(v).alias("excess")
    )
    # too few rows have no test: null instead of a division by zero
    n = F.when(F.col("n") >= 8, F.col("n"))
    # skewness part
    y = F.col("skew") * F.sqrt((n + 1) * (n + 3) / (6 * (n - 2)))
    beta2 = 3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9))
    w2 = F.sqrt(2 * (beta2 - 1)) - 1
    delta = 1 / F.sqrt(0.5 * F.log(w2))
    scaled = y / F.sqrt(2 / (w2 - 1))
    m = m.withColumn("z_skew", delta * F.log(scaled + F.sqrt(scaled * scaled + 1)))
    # kurtosis part
    expected = 3 * (n - 1) / (n + 1)
    variance = 24 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))
    x = (F.col("excess") + 3 - expected) / F.sqrt(variance)
    root_beta = (
        6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * F.sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    )
    a = 6 + 8 / root_beta * (2 / root_beta + F.sqrt(1 + 4 / (root_beta * root_beta)))
    ratio = (1 - 2 / a) / F.abs(1 + x * F.sqrt(2 / (a - 4)))
    signed = F.signum(1 + x * F.sqrt(2 / (a - 4)))
    z_kurt = (1 - 2 / (9 * a) - signed * F.pow(ratio, F.lit(1 / 3))) / F.sqrt(2 / (9 * a))
    m = m.withColumn("z_kurt", z_kurt)
    k2 = F.col("z_skew") * F.col("z_skew") + F.col("z_kurt") * F.col("z_kurt")
    return m.select(
        F.col("n").cast("bigint").alias("n"), "skew", "excess", k2.alias("k2"), F.exp(-k2 / 2).alias("p")
    )


def distribution_profile(df: DataFrame, value: str, bins: int = 20) -> tuple[DataFrame, DataFrame]:
    """Box-plot numbers and equal-width histogram of a value."""
    box = ranking.describe(df, value)
    v = F.col(value).cast("double")
    edges = df.agg(F.min(v).alias("lo"), F.max(v).alias("hi"))
    lo, hi = edges.select("lo").scalar(), edges.select("hi").scalar()
    slot = F.least(F.floor((v - lo) / F.nullif(hi - lo, F.lit(0.0)) * bins), F.lit(bins - 1))
    histogram = (
        df.where(F.col(value).isNotNull())
        .groupBy(F.coalesce(slot, F.lit(0)).cast("int").alias("bin"))
        .agg(F.count("*").alias("n"), F.min(v).alias("smallest"), F.max(v).alias("largest"))
    )
    return box, histogram


#: Steps of a series that one task looks at, besides those it borrows from the steps before.
PIECE_STEPS = 1 << 20


def in_pieces(series: DataFrame, order: str, keys: list[str], halo: int, size: int | None = None) -> tuple[DataFrame, list[str]]:
    """A per-step series cut in pieces of so many steps, each with the last `halo` steps of the one before.

    Steps are numbered without a sort in one task (`ranking.running_totals`).
    Adds `_step`, `_piece` and `_borrowed`; windows by the returned columns then
    see all steps they need, whatever the length of a key's series. Steps with a
    null `order` are left out, as they have no place in the series.
    """
    size = max(size or PIECE_STEPS, halo, 1)
    numbered = ranking.running_totals(series.where(F.col(order).isNotNull()).withColumn("_n", F.lit(1)), keys, order, "_n")
    numbered = numbered.withColumn("_step", F.col("_before")).drop("_n", "_before", "_total")
    own = F.floor(F.col("_step") / size)
    lent = F.when(F.col("_step") % size >= size - halo, F.array(own, own + 1)).otherwise(F.array(own))
    return numbered.select("*", F.posexplode(lent).alias("_at", "_piece")).withColumn("_borrowed", F.col("_at") > 0).drop("_at"), [*keys, "_piece"]


def _own_steps(pieces: DataFrame) -> DataFrame:
    return pieces.where(~F.col("_borrowed")).drop("_step", "_piece", "_borrowed")


def rolling(series: DataFrame, order: str, value: str, keys: list[str], size: int = 12, piece: int | None = None) -> DataFrame:
    """Mean and std of the last `size` rows, null until that many exist.

    `series` is one row per time step and key.
    """
    pieces, by = in_pieces(series, order, keys, size - 1, piece)
    w = W.partitionBy(*by).orderBy("_step").rowsBetween(1 - size, 0)
    full = F.count(value).over(w) >= size
    out = pieces.withColumns(
        {
            "rolling_mean": F.when(full, F.avg(value).over(w)),
            "rolling_std": F.when(full, F.stddev_samp(value).over(w)),
        }
    )
    return _own_steps(out)


def differenced(series: DataFrame, order: str, value: str, keys: list[str], piece: int | None = None) -> DataFrame:
    """First difference of a per-step series; the first step is dropped."""
    pieces, by = in_pieces(series, order, keys, 1, piece)
    w = W.partitionBy(*by).orderBy("_step")
    return _own_steps(pieces.withColumn("diff", F.col(value) - F.lag(value).over(w))).where(F.col("diff").isNotNull())


def autocorrelation(series: DataFrame, order: str, value: str, lags: int = 20, piece: int | None = None) -> DataFrame:
    """Autocorrelation at lags 1..n of one per-step series."""
    pieces, by = in_pieces(series, order, [], lags, piece)
    w = W.partitionBy(*by).orderBy("_step")
    mean = series.agg(F.avg(value)).scalar()
    centred = pieces.select(*by, "_step", "_borrowed", (F.col(value) - mean).alias("c"))
    lagged = centred.select("_borrowed", "c", *[F.lag("c", k).over(w).alias(f"l{k}") for k in range(1, lags + 1)]).where(~F.col("_borrowed"))
    sums = lagged.agg(
        F.sum(F.col("c") * F.col("c")).alias("v"),
        *[F.sum(F.col("c") * F.col(f"l{k}")).alias(f"s{k}") for k in range(1, lags + 1)],
    )
    pairs = F.array(
        *[F.struct(F.lit(k).alias("lag"), F.try_divide(f"s{k}", "v").alias("acf")) for k in range(1, lags + 1)]
    )
    return sums.select(F.inline(pairs))


def negative_binomial_fit(
    df: DataFrame, response: str, terms: list[str], dispersion: float = 1.0, steps: int = 50, tolerance: float = 1e-9
) -> DataFrame:
    """Log-link negative-binomial regression by reweighted least squares.

    Equal design rows are folded to one weighted row and written once; each
    step is one aggregate over them. Only the (p+1)² sums reach the driver.
    """
    y, xs = F.col(response).cast("double"), [F.col(t).cast("double") for t in terms]
    rows = df.select(y.alias("y"), *[x.alias(f"x{i + 1}") for i, x in enumerate(xs)]).dropna()
    names = [f"x{i}" for i in range(len(terms) + 1)]
    rows = stored(rows.groupBy("y", *names[1:]).agg(F.count("*").alias("n"))).withColumn("x0", F.lit(1.0))
    mean = rows.agg(F.sum(F.col("y") * F.col("n")) / F.sum("n")).first()[0]
    beta = None
    for _ in range(steps):
        if beta is None:
            mu = (F.col("y") + F.lit(mean)) / 2
            eta = F.log(mu)
        else:
            eta = sum((F.lit(float(b)) * F.col(c) for b, c in zip(beta, names)), F.lit(0.0))
            mu = F.exp(eta)
        step = rows.withColumn("eta", eta).withColumn("mu", mu)
        weight = F.col("n") * F.col("mu") / (1 + dispersion * F.col("mu"))
        target = F.col("eta") + (F.col("y") - F.col("mu")) / F.col("mu")
        step = step.withColumns({"w": weight, "z": target})
        sums = step.agg(
            *[F.sum(F.col("w") * F.col(a) * F.col(b)) for i, a in enumerate(names) for b in names[i:]],
            *[F.sum(F.col("w") * F.col(a) * F.col("z")) for a in names],
        ).first()
        size = len(names)
        normal = np.zeros((size, size))
        normal[np.triu_indices(size)] = sums[: size * (size + 1) // 2]
        normal = normal + np.triu(normal, 1).T
        inverse = np.linalg.pinv(normal)
        updated = inverse @ np.array(sums[size * (size + 1) // 2 :])
        done = beta is not None and np.max(np.abs(updated - beta)) < tolerance
        beta = updated
        if done:
            break
    errors = np.sqrt(np.diag(inverse))
    result = [
        (t, float(b), float(e), float(b / e) if e > 0 else None)
        for t, b, e in zip(["intercept", *terms], beta, errors)
    ]
    return df.sparkSession.createDataFrame(result, "term string, coefficient double, std_error double, z double")

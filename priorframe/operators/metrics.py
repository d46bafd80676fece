"""Rank metrics and their uncertainty, grouped, with no one-partition sort."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from priorframe.functions.keys import MIX, mixed
from priorframe.operators.ordering import running_totals
from priorframe.operators.ranked import ranked_auc

# Cumulative Poisson(1) probabilities for 0 to 6.
POISSON = (0.367879441, 0.735758882, 0.919698603, 0.981011843, 0.996340153, 0.999405815, 0.999916759)


def rank_auc(
    df: DataFrame,
    by: Sequence[str],
    score: str,
    label: str,
    weight: str | None = None,
    out: str = "auc",
) -> DataFrame:
    """ROC AUC per group with tied scores averaged; NULL when a class is missing.

    Rows shrink to (group, score) class weights, which are sorted by ranges; see ``ranked``.
    """
    by = list(by)
    w = F.col(weight) if weight else F.lit(1)
    y = F.col(label)
    scored = df.where(F.col(score).isNotNull() & y.isNotNull())
    levels = scored.groupBy(*by, score).agg(
        F.sum((w * y).cast("double")).alias("_pos"),
        F.sum((w * (1 - y)).cast("double")).alias("_neg"),
    )
    return auc_of_levels(levels, by, score, out)


def auc_of_levels(levels: DataFrame, by: Sequence[str], score: str, out: str = "auc") -> DataFrame:
    """AUC from rows (group, score) with class weights ``_pos`` and ``_neg``."""
    return ranked_auc(levels, by, score, out)


def average_precision(df: DataFrame, by: Sequence[str], score: str, label: str) -> DataFrame:
    """Sum over score levels, best first, of precision times the step in recall."""
    by = list(by)
    levels = (
        df.where(F.col(score).isNotNull())
        .groupBy(*by, (-F.col(score)).alias("_order"))
        .agg(F.sum(label).alias("_pos"), F.count(F.lit(1)).alias("_n"))
    )
    ranked = running_totals(levels, by, "_order", {"_tp": "_pos", "_seen": "_n"})
    precision = (F.col("_tp") + F.col("_pos")) / (F.col("_seen") + F.col("_n"))
    return ranked.groupBy(*by).agg(
        F.try_divide(F.sum(precision * F.col("_pos")), F.sum("_pos")).alias("average_precision")
    )


def brier(score: str, label: str) -> Column:
    return F.avg(F.pow(F.col(score) - F.col(label), 2))


def poisson_weight(cluster: Column, resample: Column) -> Column:
    """A Poisson(1) count from a hash of (cluster, resample): a bootstrap without draws."""
    u = mixed(cluster, resample) / F.lit(2.0**32)
    out = None
    for k, p in enumerate(POISSON):
        out = F.when(u < p, k) if out is None else out.when(u < p, k)
    return out.otherwise(len(POISSON)).cast("bigint")


def poisson_weights(clusters: np.ndarray, resamples: int) -> np.ndarray:
    """The weights of ``poisson_weight`` in resamples 1 to ``resamples``, and before them 1 for the data itself."""
    word = np.uint64(2**32 - 1)
    r = np.arange(1, resamples + 1, dtype=np.uint64)
    h = (((clusters % 2**31).astype(np.uint64) * np.uint64(MIX[0]))[:, None] + r * np.uint64(MIX[2])) & word
    h = ((h ^ (h >> np.uint64(15))) * np.uint64(MIX[1])) & word
    u = (h ^ (h >> np.uint64(13))) / 2.0**32
    drawn = np.searchsorted(POISSON, u.ravel(), "right").reshape(u.shape)
    return np.concatenate([np.ones((len(clusters), 1)), drawn], 1)


def bootstrap_auc(
    df: DataFrame, cluster: str, sides: dict[str, str], label: str, resamples: int
) -> DataFrame:
    """AUC of every side in every resample; clusters get one weight per resample.

    Resample 0 is the data itself, every weight 1. Scores are sorted by ranges once, and all resamples are added up side
    by side inside a range; only totals of ranges are shuffled by resample, never rows.
    """
    scores = F.array(
        *[F.struct(F.lit(n).alias("side"), F.col(c).cast("double").alias("score")) for n, c in sides.items()]
    )
    cells = (
        df.where(F.col(label).isNotNull()).select(F.col(cluster).alias("_cluster"), label, F.explode(scores).alias("_s"))
        .groupBy("_s.side", "_s.score", "_cluster")
        .agg(F.sum(label).alias("_pos"), F.sum(1 - F.col(label)).alias("_neg"))
    )
    weigh = partial(poisson_weights, resamples=resamples)
    return ranked_auc(cells, ["side"], "score", cluster="_cluster", weigh=weigh, weighting="resample")


def _interval(draws: DataFrame, value: str) -> DataFrame:
    """Resample 0 as observed, and the 95% bounds of the other resamples, one row."""
    again = F.when(F.col("resample") > 0, F.col(value))
    return draws.agg(
        F.max(F.when(F.col("resample") == 0, F.col(value))).alias("observed"),
        F.percentile(again, F.lit(0.025)).alias("low"),
        F.percentile(again, F.lit(0.975)).alias("high"),
        F.count(again).alias("resamples"),
    )


def paired_interval(
    df: DataFrame, cluster: str, left: str, right: str, label: str, resamples: int
) -> DataFrame:
    """Observed AUC(left) - AUC(right), its 95% interval and direction, one row."""
    draws = bootstrap_auc(df, cluster, {"a": left, "b": right}, label, resamples)
    side = lambda s: F.max(F.when(F.col("side") == s, F.col("auc")))
    diffs = draws.groupBy("resample").agg((side("a") - side("b")).alias("d"))
    return _interval(diffs, "d").withColumn(
        "direction",
        F.when(F.col("low") > 0, "positive").when(F.col("high") < 0, "negative").otherwise("inconclusive"),
    )


def interval_claim(interval: DataFrame, left: str, right: str) -> DataFrame:
    """A paired interval as one sentence, rendered from the measured numbers."""
    return interval.select(
        F.lit("interval").alias("kind"),
        F.format_string(
            f"AUC difference ({left} minus {right}): %+.6f; 95%% interval [%+.6f, %+.6f] (%d resamples). Direction: %s.",
            "observed", "low", "high", "resamples", "direction",
        ).alias("claim"),
    )


def one_sample_interval(df: DataFrame, cluster: str, score: str, label: str, resamples: int) -> DataFrame:
    """Observed AUC with its 95% bootstrap interval, one row."""
    return _interval(bootstrap_auc(df, cluster, {"a": score}, label, resamples), "auc")


def linear_percentile(df: DataFrame, by: Sequence[str], value: str, q: float, out: str) -> DataFrame:
    """Percentile with linear interpolation between the two neighbouring order statistics."""
    from priorframe.operators.ordering import value_at_index

    position = (F.col("total") - 1) * F.lit(q)
    ends = value_at_index(
        df.where(F.col(value).isNotNull()), by, value, {"_lo": F.floor(position), "_hi": F.ceil(position)}
    )
    part = position - F.floor(position)
    return ends.select(*by, (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * part).alias(out))


# Primes below 2^31, so that a multiplier shares no factor with a table of fewer rows.
STRIDES = (2147483647, 2147483629, 2147483587, 2147483579, 2147483563, 2147483549)


def moved_place(place: Column, size: Column, seed: int) -> Column:
    """A seeded bijection on 0 to ``size`` - 1: (stride * place + shift) mod size, the stride without a factor of size."""
    first, second = (STRIDES[(seed + k) % len(STRIDES)] for k in (0, 1))
    stride = F.when(size % first == 0, second).otherwise(first)
    wide = place.cast("decimal(18,0)") * stride.cast("decimal(10,0)") + F.lit(seed * 7919)
    return (wide % size.cast("decimal(18,0)")).cast("bigint")


def permuted_within(df: DataFrame, split: str, row_id: str, columns: Sequence[str], seed: int) -> DataFrame:
    """Each listed column moved to other rows of the same split, whole and once.

    Rows are placed by id once for all columns; a column comes from the place that a seeded bijection gives.
    """
    from priorframe.operators.ordering import running_totals

    ones = df.withColumn("_one", F.lit(1).cast("bigint"))
    placed = running_totals(ones, [split], row_id, {"_at": "_one"}, {"_size": "_one"})
    out = placed
    for i, c in enumerate(columns):
        moved = placed.select(F.col(split).alias("_split"), F.col("_at").alias("_place"), F.col(c).alias("_new"))
        out = out.withColumn("_from", moved_place(F.col("_at"), F.col("_size"), seed + i))
        on = F.col(split).eqNullSafe(F.col("_split")) & (F.col("_from") == F.col("_place"))
        out = out.join(moved, on).withColumn(c, F.col("_new")).drop("_split", "_place", "_new", "_from")
    return out.select(*df.columns)

"""Joins of records to parents, calendars, memberships and other sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from priorframe.operators.history import day_number, trailing


def matched_reason(steps: Sequence[tuple[str, Column]]) -> Column:
    """First join step whose key found no parent; ``matched`` when all did."""
    out = None
    for reason, missing in steps:
        out = F.when(missing, reason) if out is None else out.when(missing, reason)
    return out.otherwise("matched")


def map_dimension(
    df: DataFrame, dimension: DataFrame, key: str, dim_key: str, value: str, unmapped: str
) -> DataFrame:
    """Left lookup with a named level for unmapped keys.

    No broadcast hint: the planner, and adaptive execution with measured sizes,
    broadcast the dimension while it stays under the session threshold.
    """
    dim = dimension.select(F.col(dim_key).alias("_k"), F.col(value).alias(value))
    return (
        df.join(dim, F.col(key) == F.col("_k"), "left")
        .drop("_k")
        .withColumn(value, F.coalesce(F.col(value), F.lit(unmapped)))
    )


def drop_joined_members(
    df: DataFrame, members: DataFrame, key: str, time: str, start: str
) -> DataFrame:
    """Drop rows whose entity joined at or before T or at an unknown time.

    Memberships shrink to the earliest start per entity, so the range condition is
    a filter after a one-to-one equi join.
    """
    earliest = members.groupBy(F.col(key)).agg(
        F.min(start).alias("_start"), F.count(F.when(F.col(start).isNull(), 1)).alias("_open")
    )
    return (
        df.join(earliest, key, "left")
        .where(
            F.col("_open").isNull()
            | ((F.col("_open") == 0) & (F.col("_start") > F.col(time)))
        )
        .drop("_start", "_open")
    )


def events_within(
    probes: DataFrame,
    facts: DataFrame,
    keys: Sequence[str],
    probe_time: str,
    fact_time: str,
    days: int,
    out: str,
) -> DataFrame:
    """Facts of the entity in (T, T+days], counted on the day grain."""
    keys = list(keys)
    daily = facts.groupBy(*keys, day_number(fact_time).alias("_day")).agg(
        F.count(F.lit(1)).alias(out)
    )
    instants = probes.select(*keys, day_number(probe_time).alias("_day")).distinct()
    both = daily.withColumn("_probe", F.lit(False)).unionByName(
        instants.withColumn("_probe", F.lit(True)), allowMissingColumns=True
    )
    ahead = both.select(
        *keys,
        "_day",
        "_probe",
        F.coalesce(F.sum(out).over(trailing(keys, "_day", 1, days)), F.lit(0)).alias(out),
    ).where("_probe")
    return (
        probes.withColumn("_day", day_number(probe_time))
        .join(ahead.drop("_probe"), [*keys, "_day"], "left")
        .drop("_day")
    )


def unique_donors(facts: DataFrame, keys: Sequence[str], order: str, values: Sequence[str]):
    """One donor row per (keys, order) with its count; a duplicate's values become NULL."""
    grouped = facts.groupBy(*keys, order).agg(
        F.count(F.lit(1)).alias("donors"), *[F.max(v).alias(v) for v in values]
    )
    one = F.col("donors") == 1
    return grouped.select(*keys, order, "donors", *[F.when(one, F.col(v)).alias(v) for v in values])


def inventory_status(expected: DataFrame, actual: DataFrame, key: str, compare: Sequence[str]):
    """Full outer match of two inventories to present, missing, differing, unexpected."""
    e = expected.select(F.col(key), F.struct(*compare).alias("_e"))
    a = actual.select(F.col(key), F.struct(*compare).alias("_a"))
    return e.join(a, key, "full_outer").select(
        key,
        F.when(F.col("_a").isNull(), "missing")
        .when(F.col("_e").isNull(), "unexpected")
        .when(F.col("_e").eqNullSafe(F.col("_a")), "present")
        .otherwise("differing")
        .alias("status"),
    )


def alignment(rows: DataFrame, scores: DataFrame, key: str, label: str) -> DataFrame:
    """Must every accepted row be scored exactly once with the same label? Counts of each failure."""
    r = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_r"), F.max(label).alias("_ry"))
    s = scores.groupBy(key).agg(
        F.count(F.lit(1)).alias("_s"), F.min(label).alias("_sl"), F.max(label).alias("_sh")
    )
    j = r.join(s, key, "full_outer")
    both = F.col("_r").isNotNull() & F.col("_s").isNotNull()
    differ = both & ((F.col("_sl") != F.col("_ry")) | (F.col("_sh") != F.col("_ry")))
    return j.agg(
        F.count(F.when(F.col("_r").isNotNull(), 1)).alias("accepted"),
        F.count(F.when(F.col("_s").isNull(), 1)).alias("unscored"),
        F.count(F.when(F.col("_r").isNull(), 1)).alias("unexpected"),
        F.count(F.when(F.col("_s") > 1, 1)).alias("repeated"),
        F.count(F.when(differ, 1)).alias("label_differs"),
    )


def shared_keys(scored: DataFrame, development: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of the scored rows that also occur in development rows."""
    return scored.select(*keys).distinct().join(
        development.select(*keys).distinct(), list(keys), "left_semi"
    )

"""Temporal and entity-disjoint splits with counted exclusions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from priorframe.operators.ordering import value_ranks


def half_open(time: Column, windows: Sequence[tuple[str, str | None, str | None]]) -> Column:
    """Name of the [start, end) window that holds the instant, else ``outside``."""
    out = None
    for name, start, end in windows:
        hit = F.lit(True)
        if start:
            hit = hit & (time >= F.lit(start).cast("date"))
        if end:
            hit = hit & (time < F.lit(end).cast("date"))
        hit = hit & time.isNotNull()
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise("outside")


def straddlers(df: DataFrame, entity: Sequence[str], split: str = "split") -> DataFrame:
    """Entities that occur in more than one window, with how many."""
    return (
        df.groupBy(*entity)
        .agg(F.min(split).alias("_lo"), F.max(split).alias("_hi"), F.count(F.lit(1)).alias("rows"))
        .where(F.col("_lo") != F.col("_hi"))
        .select(*entity, "rows")
    )


def drop_straddlers(df: DataFrame, entity: Sequence[str], split: str = "split") -> DataFrame:
    return df.join(straddlers(df, entity, split).drop("rows"), list(entity), "left_anti")


def entity_disjoint(df: DataFrame, entity: str, every: int = 3) -> DataFrame:
    """Every k-th entity in sorted order is held out; the rest, rows without an entity too, are development."""
    ranks = value_ranks(df.where(F.col(entity).isNotNull()), [], entity).select(entity, "dense_rank")
    held = F.pmod(F.col("dense_rank") - 1, F.lit(every)) == every - 1
    return df.join(ranks, entity, "left").withColumn(
        "group", F.when(held, "held_out").otherwise("development")
    ).drop("dense_rank")


def excluded_period(
    time: Column, windows, excluded: Sequence[tuple[str, str, str]]
) -> Column:
    """Half-open split, where a named shock period comes before every split."""
    out = None
    for name, start, end in excluded:
        hit = (time >= F.lit(start).cast("date")) & (time < F.lit(end).cast("date"))
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise(half_open(time, windows))


def first_crossing(
    df: DataFrame, entity: Sequence[str], period: str, measure: Column, minimum: float
) -> DataFrame:
    """First period in which an entity's measure reaches a minimum."""
    return (
        df.where(measure >= minimum)
        .groupBy(*entity)
        .agg(F.min(period).alias("entry"))
    )


def isolation(df: DataFrame, columns: Sequence[str], split: str = "split") -> DataFrame:
    """Per key column: values seen in more than one split, all columns in one job."""
    long = df.select(
        split,
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("key"), F.col(c).cast("string").alias("value"))
                    for c in columns
                ]
            )
        ).alias("_kv"),
    ).select(split, "_kv.key", "_kv.value")
    return (
        long.groupBy("key", "value")
        .agg((F.min(split) != F.max(split)).cast("bigint").alias("_shared"))
        .groupBy("key")
        .agg(F.count(F.lit(1)).alias("n_values"), F.sum("_shared").alias("n_shared"))
    )

"""Catalogue reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def class_rank(c: Column, order: Sequence[str]) -> Column:
    """Position of a class in its declared order; an undeclared class comes last."""
    at = F.array_position(F.array(*[F.lit(x) for x in order]), c)
    return F.when(F.coalesce(at, F.lit(0)) > 0, at - 1).otherwise(len(order)).cast("bigint")


def ranked_queue(df: DataFrame, cls: str, order: Sequence[str], buildable: Column, row_id: str):
    """Candidates by class order, buildable first, then id; blocked classes come last."""
    return df.withColumns({"rank": class_rank(F.col(cls), order), "buildable": buildable}).orderBy(
        "rank", F.col("buildable").desc(), row_id
    )


def queue_summary(queue: DataFrame, cls: str, blocked: Column) -> DataFrame:
    return queue.groupBy(cls, "rank").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(F.col("buildable"), 1)).alias("n_buildable"),
        F.count(F.when(blocked, 1)).alias("n_blocked"),
    )

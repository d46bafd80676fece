"""Row-level cleaning, population rules and reproducible samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from priorframe.operators.ordering import row_positions


def bucket_label(c: Column, bands: Sequence[tuple[float, str]], above: str) -> Column:
    """Label of the first band whose upper bound (inclusive) holds the value."""
    out = None
    for upper, label in bands:
        hit = c <= F.lit(upper)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return F.when(c.isNotNull(), out.otherwise(above))


def sentinel_fill(df: DataFrame, values: dict[str, float]) -> DataFrame:
    """Declared out-of-range value per column; the last projection before a sink."""
    return df.select(
        *[
            F.coalesce(F.col(c), F.lit(values[c])).alias(c) if c in values else F.col(c)
            for c in df.columns
        ]
    )


def exclusion_reason(rules: Sequence[tuple[str, Column]], kept: str = "kept") -> Column:
    """First matching exclusion rule in declared order."""
    out = None
    for reason, hit in rules:
        hit = F.coalesce(hit, F.lit(False))
        out = F.when(hit, reason) if out is None else out.when(hit, reason)
    return out.otherwise(kept)


def exclusion_ledger(df: DataFrame, rules, by: Sequence[str]) -> DataFrame:
    return (
        df.withColumn("reason", exclusion_reason(rules))
        .groupBy(*by, "reason")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def populated_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Non-blank values per column, long form, from one aggregate."""
    one = df.agg(
        *[F.count(F.when(F.trim(F.col(c).cast("string")) != "", 1)).alias(c) for c in columns]
    )
    return one.unpivot([], list(columns), "column", "populated")


def presence_gate(df: DataFrame, optional: Sequence[str], minimum: int) -> DataFrame:
    """Drop optional columns with fewer than ``minimum`` populated values.

    The column list of a plan must be known when it is built, so this runs one
    aggregate that returns a single row.
    """
    row = df.agg(
        *[F.count(F.when(F.trim(F.col(c).cast("string")) != "", 1)).alias(c) for c in optional]
    ).first()
    return df.drop(*[c for c in optional if row[c] < minimum])


def multi_hot(df: DataFrame, tokens: Column, vocabulary: Sequence[str], prefix: str) -> DataFrame:
    """0/1 column per vocabulary entry, their number, and tokens outside the vocabulary."""
    known = F.array(*[F.lit(v) for v in vocabulary])
    return df.withColumns(
        {
            **{
                f"{prefix}{v.lower()}": F.array_contains(tokens, v).cast("bigint")
                for v in vocabulary
            },
            f"{prefix}count": F.size(F.array_intersect(tokens, known)).cast("bigint"),
            f"{prefix}unknown": F.size(F.array_except(tokens, known)).cast("bigint"),
        }
    )


def token_count_features(
    items: DataFrame, keys: Sequence[str], code: str, quantity: Column, party: str
) -> DataFrame:
    """Per case: distinct codes, dominant two-character segment, quantity, parties.

    The dominant segment (ties to the smaller text) comes from segment counts, so a
    large case never builds a list of its items.
    """
    segment = F.substring(F.col(code), 1, 2)
    per_segment = items.groupBy(*keys, segment.alias("_segment")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    dominant = per_segment.groupBy(*keys).agg(
        F.min_by("_segment", F.struct(-F.col("_n"), F.col("_segment"))).alias("segment")
    )
    totals = items.groupBy(*keys).agg(
        F.countDistinct(code).alias("codes"),
        F.sum(quantity).alias("quantity"),
        F.countDistinct(party).alias("parties"),
    )
    return totals.join(dominant, list(keys))


def seeded_sample(df: DataFrame, key: str, seed: int, n: int) -> DataFrame:
    """n rows in the order of a seeded hash of the key; top-n per task, then merged."""
    return df.orderBy(F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string"))), key).limit(n)


def stride_sample(df: DataFrame, order: str, k: int) -> DataFrame:
    """Every k-th row of the table ordered by a unique column, from the first."""
    numbered = row_positions(df, [], order, "_rn")
    return numbered.where(F.pmod(F.col("_rn") - 1, F.lit(k)) == 0).drop("_rn")

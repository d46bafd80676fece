"""Ranks and running totals over a whole table, without a one-partition window.

Rows are cut into contiguous value ranges first. The cut points come from a
hash-chosen sample of the values, so they are a function of the data alone and
are the same on every recomputation. Each range is one window partition; the
totals of the earlier ranges are added from a small per-range table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANGES = 1024
PIECES = 128  # below 200, so that Spark writes a file a piece and sorts nothing on the way
_STEP = 32


def in_pieces(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows dealt by ``columns`` over ``PIECES`` pieces, whatever the settings of the session.

    Adaptive execution does not merge pieces whose number is given, so an aggregate or a join on these columns holds
    the rows of one piece and not those of 64 MB of packed shuffle data.
    """
    return df.repartition(PIECES, *columns)


def _cut_points(df: DataFrame, part: Sequence[str], order: str, carried: Sequence[str]) -> DataFrame:
    """At most RANGES sorted sample values per part, one row per part.

    The carried columns only break hash ties. Reading them, and skipping NULLs inside the
    aggregate, keeps this branch's input identical to the main branch's, so that both
    read one shuffle of the input instead of computing it twice.
    """
    value = F.col(order)
    rank = F.struct(F.xxhash64(value, F.lit(7)).alias("h"), *carried)
    sample = df.groupBy(*part, F.pmod(F.xxhash64(value), F.lit(RANGES)).alias("_slot")).agg(
        F.min_by(value, F.when(value.isNotNull(), rank)).alias("_cut")
    )
    return (
        sample.groupBy(*part)
        .agg(F.array_sort(F.collect_list("_cut")).alias("_cuts"))
        .withColumn("_coarse", F.expr(f"filter(_cuts, (c, i) -> i % {_STEP} = 0)"))
    )


def _range_of(value: Column, cuts: Column, coarse: Column) -> Column:
    """Number of cut points at or below the value, found in two short scans."""
    block = F.size(F.filter(coarse, lambda c: c <= value))
    start = F.greatest(block - 1, F.lit(0)) * _STEP
    inside = F.size(F.filter(F.slice(cuts, start + 1, F.lit(_STEP)), lambda c: c <= value))
    return F.coalesce(F.when(value.isNull(), F.lit(-1)).otherwise(start + inside), F.lit(0))


def with_ranges(df: DataFrame, part: Sequence[str], order: str, carried: Sequence[str]) -> DataFrame:
    """Add ``_range``: a monotone range number of ``order`` inside each part."""
    cuts = _cut_points(df, part, order, carried)
    if part:
        # No hint: at most RANGES values per part, which adaptive execution broadcasts
        # once it has measured them.
        joined = df.join(cuts, list(part), "left")
        return joined.withColumn(
            "_range", _range_of(F.col(order), F.col("_cuts"), F.col("_coarse"))
        ).drop("_cuts", "_coarse")
    packed = cuts.select(F.struct("_cuts", "_coarse").alias("p")).scalar()
    return (
        df.withColumn("_p", packed)
        .withColumn("_range", _range_of(F.col(order), F.col("_p._cuts"), F.col("_p._coarse")))
        .drop("_p")
    )


def running_totals(
    df: DataFrame, part: Sequence[str], order: str, sums: dict[str, str], totals: dict[str, str] | None = None
) -> DataFrame:
    """Exclusive running sum of each column over strictly smaller ``order`` values.

    ``df`` must hold one row per (part, order); ``sums`` maps a new column name to
    the column it totals, and ``totals`` a new name to a column whose whole-part sum is
    wanted as well. A NULL part is a part of its own.
    """
    if part:
        # As one struct, so that joins meet NULL parts as well.
        rest = [c for c in df.columns if c not in part]
        packed = df.select(F.struct(*part).alias("_part"), *rest)
        out = _running_totals(packed, ["_part"], order, sums, totals)
        return out.select("_part.*", *[c for c in out.columns if c != "_part"])
    return _running_totals(df, [], order, sums, totals)


def _running_totals(
    df: DataFrame, part: list[str], order: str, sums: dict[str, str], totals: dict[str, str] | None
) -> DataFrame:
    totals = totals or {}
    carried = sorted({*sums.values(), *totals.values()})
    tagged = with_ranges(df, part, order, carried)
    per_range = tagged.groupBy(*part, "_range").agg(
        *[F.sum(c).alias(f"_t_{c}") for c in carried]
    )
    # At most RANGES + 1 rows per part.
    whole = Window.partitionBy(*part) if part else Window.partitionBy(F.lit(0))
    before = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_range.select(
        *part,
        "_range",
        *[F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_o_{n}") for n, c in sums.items()],
        *[F.sum(f"_t_{c}").over(whole).alias(n) for n, c in totals.items()],
    )
    inside = (
        Window.partitionBy(*part, "_range")
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    joined = tagged.join(offsets, [*part, "_range"])
    for name, source in sums.items():
        joined = joined.withColumn(
            name,
            F.col(f"_o_{name}") + F.coalesce(F.sum(source).over(inside), F.lit(0)),
        )
    return joined.drop("_range", *[f"_o_{name}" for name in sums])


def row_positions(df: DataFrame, part: Sequence[str], order: str, out: str) -> DataFrame:
    """1-based row number by a unique ``order`` column inside each part."""
    ones = df.withColumn("_one", F.lit(1).cast("bigint"))
    return (
        running_totals(ones, part, order, {out: "_one"})
        .withColumn(out, F.col(out) + 1)
        .drop("_one")
    )


def value_ranks(df: DataFrame, part: Sequence[str], value: str) -> DataFrame:
    """Per distinct value: rows ``n``, rows below, dense rank from 1, rows ``total`` of the part."""
    part = list(part)
    counted = (
        df.groupBy(*part, value)
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("_one", F.lit(1).cast("bigint"))
    )
    ranked = running_totals(
        counted, part, value, {"n_below": "n", "values_below": "_one"}, {"total": "n"}
    )
    return ranked.withColumn("dense_rank", F.col("values_below") + 1).drop("_one", "values_below")


def value_at_index(
    df: DataFrame,
    part: Sequence[str],
    value: str,
    indexes: dict[str, Column],
) -> DataFrame:
    """The value at given 0-based sorted positions, one row per part.

    ``indexes`` maps an output name to an expression over ``total`` (rows in the part).
    """
    ranked = value_ranks(df, part, value)
    picks = []
    for name, index in indexes.items():
        hit = (F.col("n_below") <= index) & (index < F.col("n_below") + F.col("n"))
        picks.append(F.max(F.when(hit, F.col(value))).alias(name))
    return ranked.groupBy(*part).agg(*picks, F.max("total").alias("total"))

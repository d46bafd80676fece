"""As-of history: what was known about an entity strictly before an instant.

Facts are first aggregated to one row per (entity, day). An entity then holds at
most one row per calendar day, however many source rows it has, so a per-entity
window stays bounded by the calendar and same-day rows share one prior state.
"""

from __future__ import annotations

from functools import reduce
from operator import and_
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from priorframe.operators.ordering import with_ranges


def day_number(col: str | Column) -> Column:
    return F.unix_date(F.col(col).cast("date") if isinstance(col, str) else col.cast("date"))


def month_number(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return (F.year(c) * 12 + F.month(c) - 1).cast("bigint")


def before(keys: Sequence[str], order: str):
    """All strictly earlier order values of the same keys."""
    return Window.partitionBy(*keys).orderBy(order).rangeBetween(Window.unboundedPreceding, -1)


def trailing(keys: Sequence[str], order: str, start: int, end: int = 0):
    """Calendar frame [t+start, t+end] of the same keys."""
    return Window.partitionBy(*keys).orderBy(order).rangeBetween(start, end)


def at_offset(value: str | Column, keys: Sequence[str], order: str, offset: int) -> Column:
    """The value exactly ``offset`` units away, NULL across a gap.

    The frame [t+k, t+k] holds one row of a (keys, order) panel or none, so every
    lag and lead of a panel shares one shuffle and one sort.
    """
    c = F.col(value) if isinstance(value, str) else value
    return F.max(c).over(trailing(keys, order, offset, offset))


def unique_at_offset(
    value: str, count: str, keys: Sequence[str], order: str, offset: int
) -> Column:
    """As ``at_offset`` over a panel that carries its donor count: two donors give NULL."""
    return at_offset(F.when(F.col(count) == 1, F.col(value)), keys, order, offset)


_OVER = {
    "sum": lambda c, w: F.sum(c).over(w),
    "min": lambda c, w: F.min(c).over(w),
    "max": lambda c, w: F.max(c).over(w),
    "last": lambda c, w: F.last(c, ignorenulls=True).over(w),
}
_DAILY = {
    "sum": lambda e, o: F.sum(e),
    "min": lambda e, o: F.min(e),
    "max": lambda e, o: F.max(e),
    "last": lambda e, o: F.max_by(e, o),
}


def as_of(
    probes: DataFrame,
    facts: DataFrame,
    keys: Sequence[str],
    probe_time: str,
    fact_time: str,
    aggs: dict[str, tuple[str, Column]],
    tie: str | None = None,
) -> DataFrame:
    """Add aggregates of the facts dated strictly before each probe's day.

    ``aggs`` maps a name to (sum|min|max|last, expression); ``tie`` orders facts of
    one day for ``last``. Probe rows are matched back on (keys, day), which spreads
    a busy entity over its days.
    """
    keys = list(keys)
    order = F.col(tie) if tie else F.lit(0)
    daily = (
        facts.where(F.col(fact_time).isNotNull())
        .groupBy(*keys, day_number(fact_time).alias("_day"))
        .agg(*[_DAILY[kind](expr, order).alias(name) for name, (kind, expr) in aggs.items()])
        .withColumn("_probe", F.lit(False))
    )
    instants = (
        probes.select(*keys, day_number(probe_time).alias("_day"))
        .distinct()
        .withColumn("_probe", F.lit(True))
    )
    both = daily.unionByName(instants, allowMissingColumns=True)
    w = before(keys, "_day")
    known = both.select(
        *keys,
        "_day",
        "_probe",
        *[_OVER[kind](F.col(name), w).alias(name) for name, (kind, _) in aggs.items()],
    ).where("_probe")
    return (
        probes.withColumn("_day", day_number(probe_time))
        .join(known.drop("_probe"), [*keys, "_day"], "left")
        .drop("_day")
    )


def strict_prior(
    rows: DataFrame,
    keys: Sequence[str],
    time: str,
    aggs: dict[str, tuple[str, Column]],
    tie: str | None = None,
) -> DataFrame:
    """``as_of`` where the rows are their own facts; no union is needed."""
    keys = list(keys)
    order = F.col(tie) if tie else F.lit(0)
    daily = rows.groupBy(*keys, day_number(time).alias("_day")).agg(
        *[_DAILY[kind](expr, order).alias(name) for name, (kind, expr) in aggs.items()]
    )
    w = before(keys, "_day")
    known = daily.select(
        *keys,
        "_day",
        *[_OVER[kind](F.col(name), w).alias(name) for name, (kind, _) in aggs.items()],
    )
    return (
        rows.withColumn("_day", day_number(time))
        .join(known, [*keys, "_day"], "left")
        .drop("_day")
    )


def days_since_last(rows: DataFrame, keys: Sequence[str], time: str, out: str, none: int):
    """Days since the entity's previous distinct day, ``none`` when there is none."""
    days = rows.select(*keys, day_number(time).alias("_day")).distinct()
    w = Window.partitionBy(*keys).orderBy("_day")
    gaps = days.withColumn(
        out, F.coalesce(F.col("_day") - F.lag("_day").over(w), F.lit(none)).cast("bigint")
    )
    return rows.withColumn("_day", day_number(time)).join(gaps, [*keys, "_day"], "left").drop("_day")


def next_event(rows: DataFrame, keys: Sequence[str], time: str, order: str, take: Sequence[str]):
    """Each row beside the entity's next row by (day, ``order``), columns prefixed ``next_``.

    Rows are cut into value ranges of ``order``, so that a hot day of an entity is many sorts. Inside a (keys, day,
    range) the next row comes from a window; the last row takes the first row of the entity's next (day, range),
    found on that grain. Rows without a key or a day stay, without a next row and without a window.
    """
    keys = list(keys)
    packed = F.struct(*[F.col(c) for c in take])
    base = rows.withColumn("_day", day_number(time)).withColumn("_self", packed)
    known = reduce(and_, [F.col(c).isNotNull() for c in [*keys, "_day"]])
    grain = [*keys, "_day", "_range"]
    ranged = with_ranges(base.where(known), [], order, [*keys, "_day"])
    firsts = ranged.groupBy(*grain).agg(F.min_by("_self", F.col(order)).alias("_first"))
    by_day = Window.partitionBy(*keys).orderBy("_day", "_range")
    firsts = firsts.select(*grain, F.lead("_first").over(by_day).alias("_then"))
    inside = Window.partitionBy(*grain).orderBy(order)
    out = ranged.join(firsts, grain, "left").withColumn("_next", F.coalesce(F.lead("_self").over(inside), F.col("_then")))
    out = out.drop("_range", "_then").unionByName(base.where(~known), allowMissingColumns=True)
    for c in take:
        out = out.withColumn(f"next_{c}", F.col(f"_next.{c}"))
    return out.select(*rows.columns, *[f"next_{c}" for c in take])


def ever_before_set(
    rows: DataFrame, keys: Sequence[str], time: str, item: str
) -> DataFrame:
    """Per (entity, day): distinct items of the previous day and distinct items ever before.

    The all-time count is a running sum of first occurrences, so no set grows with
    history. The previous day's items stay a count and a sorted list of distinct codes,
    which the code vocabulary bounds.
    """
    keys = list(keys)
    daily_items = rows.select(*keys, day_number(time).alias("_day"), item).distinct()
    firsts = daily_items.groupBy(*keys, item).agg(F.min("_day").alias("_day"))
    new_per_day = firsts.groupBy(*keys, "_day").agg(F.count(F.lit(1)).alias("_new"))
    per_day = daily_items.groupBy(*keys, "_day").agg(
        F.count(F.lit(1)).alias("_items"),
        F.array_join(F.array_sort(F.collect_list(item)), ",").alias("_list"),
    )
    w = Window.partitionBy(*keys).orderBy("_day")
    prior = before(keys, "_day")
    return (
        per_day.join(new_per_day, [*keys, "_day"], "left")
        .select(
            *keys,
            F.date_from_unix_date("_day").alias("day"),
            F.coalesce(F.lag("_items").over(w), F.lit(0)).cast("bigint").alias("last_items"),
            F.coalesce(F.lag("_list").over(w), F.lit("")).alias("last_list"),
            F.coalesce(F.sum("_new").over(prior), F.lit(0)).cast("bigint").alias("ever_items"),
        )
    )


def measured_start(df: DataFrame, year: str, sign: Column, limit: float, least_rows: int) -> DataFrame:
    """First year from which the share of ``sign`` stays below the limit in every later year.

    A year with fewer than ``least_rows`` rows cannot be the start. The ordered frame is
    over one row per year.
    """
    yearly = df.groupBy(year).agg(
        F.count(F.lit(1)).alias("_n"), F.avg(sign.cast("double")).alias("_share")
    )
    later = (
        Window.partitionBy(F.lit(0))
        .orderBy(F.desc(year))
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        yearly.withColumn("_worst", F.max("_share").over(later))
        .where((F.col("_worst") < limit) & (F.col("_n") >= least_rows))
        .agg(F.min(year).alias("panel_start"))
    )


def smoothed_rate(count: Column, positives: Column, default: Column) -> Column:
    """No closed row: the default; under three: pulled to one half; else the plain rate."""
    n = F.coalesce(count, F.lit(0))
    p = F.coalesce(positives, F.lit(0))
    return (
        F.when(n == 0, default)
        .when(n < 3, (p + 0.5) / (n + 1))
        .otherwise(F.try_divide(p, n))
    )

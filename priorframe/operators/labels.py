"""Label construction: every unobserved outcome keeps a name of its own."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from priorframe.operators.history import at_offset, day_number
from priorframe.operators.ordering import value_at_index


def flag(c: Column) -> Column:
    return c.cast("bigint")


def threshold_next(value: str, keys: Sequence[str], order: str, limit: float, step: int = 1):
    """1 iff the value exactly one step later exceeds the limit; NULL when unobserved."""
    return flag(at_offset(value, keys, order, step) > limit)


def direction_next(value: str, keys: Sequence[str], order: str, step: int = 1) -> Column:
    """1 iff the next value is lower; a tie is 0."""
    return flag(at_offset(value, keys, order, step) < F.col(value))


def event_within(
    df: DataFrame, keys: Sequence[str], time: str, horizon: int, label: str = "label"
) -> DataFrame:
    """1 iff the entity has a later day within the horizon; the censored tail is marked.

    The cut is the last instant of the whole source less the horizon.
    """
    days = df.select(*keys, day_number(time).alias("_day")).distinct()
    w = Window.partitionBy(*keys).orderBy("_day")
    nxt = days.withColumn("_gap", F.lead("_day").over(w) - F.col("_day"))
    last = df.agg(F.max(day_number(time))).scalar()
    out = df.withColumn("_day", day_number(time)).join(nxt, [*keys, "_day"], "left")
    seen = F.coalesce(F.col("_gap") <= horizon, F.lit(False))
    return (
        out.withColumn("censored", F.col("_day") > last - horizon)
        .withColumn(label, F.when(~F.col("censored"), flag(seen)))
        .drop("_day", "_gap")
    )


def duration_label(opened: Column, closed: Column, is_open: Column, days: int) -> dict[str, Column]:
    """Closed within the days; open and negative durations are named exclusions."""
    gap = F.datediff(closed, opened)
    reason = F.when(is_open, "open").when(gap < 0, "negative").otherwise("labelled")
    return {"reason": reason, "label": F.when(reason == "labelled", flag(gap <= days))}


def future_sum_multiple(
    panel: DataFrame, keys: Sequence[str], order: str, value: str, host: Sequence[str], multiple: int
) -> DataFrame:
    """1 iff the next two periods sum to at least ``multiple`` times the current one.

    Observed only when the host reported both periods; a silent entity then counts 0.
    """
    hosts = panel.groupBy(*host, order).agg(F.count(F.lit(1)).alias("_rows"))
    w = lambda k: F.count("_rows").over(
        Window.partitionBy(*host).orderBy(order).rangeBetween(k, k)
    )
    hosts = hosts.select(*host, order, ((w(1) > 0) & (w(2) > 0)).alias("observed"))
    future = F.coalesce(at_offset(value, keys, order, 1), F.lit(0)) + F.coalesce(
        at_offset(value, keys, order, 2), F.lit(0)
    )
    out = panel.withColumn("_future", future).join(hosts, [*host, order])
    return out.withColumn(
        "label", F.when(F.col("observed"), flag(F.col("_future") >= multiple * F.col(value)))
    ).drop("_future")


def terminal_state(
    events: DataFrame, keys: Sequence[str], time: str, state: str,
    positive: Sequence[str], negative: Sequence[str], horizon: int,
) -> DataFrame:
    """The last terminal day inside the horizon decides; mixed, pending and late are buckets.

    Events shrink to counts per (entity, day) before the horizon is measured.
    """
    daily = events.groupBy(*keys, day_number(time).alias("_day")).agg(
        F.count(F.when(F.col(state).isin(*positive), 1)).alias("_p"),
        F.count(F.when(F.col(state).isin(*negative), 1)).alias("_n"),
    )
    start = F.min("_day").over(Window.partitionBy(*keys))
    daily = daily.withColumn("_in", F.col("_day") <= start + horizon)
    terminal = (F.col("_p") + F.col("_n")) > 0
    last = F.max_by(F.struct("_p", "_n"), F.when(terminal & F.col("_in"), F.col("_day")))
    late = F.count(F.when(terminal & ~F.col("_in"), 1))
    return daily.groupBy(*keys).agg(last.alias("_l"), late.alias("_late")).select(
        *keys,
        F.when(F.col("_l").isNull() & (F.col("_late") > 0), "late")
        .when(F.col("_l").isNull(), "pending")
        .when((F.col("_l._p") > 0) & (F.col("_l._n") > 0), "mixed")
        .when(F.col("_l._p") > 0, "positive")
        .otherwise("negative")
        .alias("outcome"),
    )


def vocabulary_label(c: Column, patterns: Sequence[tuple[str, str]], other: str) -> Column:
    """Class of a status text by the first matching pattern."""
    out = None
    for pattern, name in patterns:
        out = F.when(c.rlike(pattern), name) if out is None else out.when(c.rlike(pattern), name)
    return out.otherwise(other)


def rate_threshold(df: DataFrame, value: str, target: float, snap: int) -> DataFrame:
    """One row: the largest multiple of ``snap`` that at least ``target`` of these rows exceed.

    With n rows, the ceil(target * n)-th largest value must lie above the threshold, so the
    search is one order statistic instead of repeated counts. Zero when no multiple does.
    """
    index = F.col("total") - F.ceil(F.col("total") * F.lit(target))
    cut = value_at_index(df, [], value, {"at": F.greatest(index, F.lit(0))})
    below = (F.ceil(F.col("at") / snap) - 1) * snap
    return cut.select(F.greatest(below, F.lit(0)).cast("bigint").alias("threshold"))

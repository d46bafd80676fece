"""Structured Streaming forms of the weekly, per-entity and revision operators.

Each stream reads files, keeps its state behind a watermark and writes to a table and
checkpoint in a shared folder. Streams that keep per-entity state read closed-period
tables, so an entity has one row per period however many events it had. Event time
is held as a UTC instant: run sessions with ``spark.sql.session.timeZone=UTC``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from priorframe.operators.aggregates import latest_by

MONDAY = "4 days"  # the epoch was a Thursday


def read_stream(spark: SparkSession, path: str) -> DataFrame:
    """Stream the Parquet file or files of a path with the schema they have now.

    The file source takes a folder or a glob, so the path is written as a glob that
    matches itself only; it may then also be one file.
    """
    path = path.rstrip("/")
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).parquet(f"{path[:-1]}[{path[-1]}]")


def run_to_table(df: DataFrame, folder: str, mode: str = "append") -> DataFrame:
    """Run a stream over what is there now and read back its table."""
    q = (
        df.writeStream.format("parquet")
        .outputMode(mode)
        .option("path", f"{folder}/table")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/table")


def closed_periods(
    events: DataFrame, keys: Sequence[str], time: str, period: str, delay: str,
    aggs: Sequence[Column], start: str = "0 days",
) -> DataFrame:
    """Tumbling windows per key, emitted once the watermark has passed their end."""
    timed = events.withColumn("_time", F.col(time).cast("timestamp")).withWatermark("_time", delay)
    w = F.window("_time", period, period, start)
    return (
        timed.groupBy(w.alias("_w"), *keys)
        .agg(*aggs)
        .withColumn("start", F.col("_w.start"))
        .drop("_w")
    )


LAGS = (1, 2, 3)
WEEKS_KEPT = 52
DAYS_KEPT = 366


def _transition_state(
    key: tuple, frames: Iterator[pd.DataFrame], state: GroupState, keep: int | None = None
) -> Iterator[pd.DataFrame]:
    weeks, values, floor = state.get if state.exists else ([], [], None)
    held, late, fresh = dict(zip(weeks, values)), [], []
    arrived = pd.concat(list(frames)).sort_values("week", kind="stable")
    for week, value in zip(arrived["week"].tolist(), arrived["value"].tolist()):
        if week in held:
            continue
        if floor is not None and week < floor:
            late.append((*key, week, value, None, None, None, None, -1))
            continue
        held[week] = value
        fresh.append(week)
    # What a new week completes or changes: its own transition, that of the week before, and those that it is a lag of.
    rows = []
    for week in sorted({w + k for w in fresh for k in (-1, 0, *LAGS)}):
        if week in held and week + 1 in held:
            lags = [held.get(week - k) for k in LAGS]
            rows.append((*key, week, held[week], held[week + 1], *lags, sum(x is not None for x in lags)))
    if keep is not None and held:
        floor = max(held) - keep if floor is None else max(floor, max(held) - keep)
        held = {w: v for w, v in held.items() if w >= floor - 1 - max(LAGS)}
    state.update((sorted(held), [held[w] for w in sorted(held)], floor))
    columns = ["key", "week", "value", "next_value", "lag1", "lag2", "lag3", "revision"]
    yield pd.DataFrame([*rows, *late], columns=columns).astype({c: "Int64" for c in columns[1:]})


def weekly_transitions(weekly: DataFrame, key: str, week: str, value: str, keep: int | None = WEEKS_KEPT) -> DataFrame:
    """A row for week W once W and W+1 are there, in whatever order weeks arrive.

    ``weekly`` is a stream with integer week numbers; a week already seen is ignored. A late week gives its own
    transitions, and those that it is a lag of come again with a higher ``revision`` (the number of lags known);
    ``newest_revision`` of the table is the same for every order of arrival. The state of a key holds its weeks down to
    ``keep`` before its newest and their lags (all, if ``keep`` is None); a week below that is a row of revision -1
    without next value.
    """
    kind = weekly.schema[key].dataType.simpleString()
    return (
        weekly.select(key, F.col(week).cast("bigint").alias("week"), F.col(value).cast("bigint").alias("value"))
        .groupBy(key)
        .applyInPandasWithState(
            lambda g, it, st: _transition_state(g, (f[["week", "value"]] for f in it), st, keep),
            f"key {kind}, week bigint, value bigint, next_value bigint, lag1 bigint, lag2 bigint, lag3 bigint, revision bigint",
            "weeks array<bigint>, vals array<bigint>, floor bigint",
            "append",
            GroupStateTimeout.NoTimeout,
        )
        .withColumnRenamed("key", key)
    )


def newest_revision(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last row of every key of a stream that revises its rows, without the revision; rows that came too late are left out."""
    columns = [c for c in rows.columns if c not in (*keys, "revision")]
    return latest_by(rows.where("revision >= 0"), keys, F.col("revision"), columns)


def _history_state(
    key: tuple, frames: Iterator[pd.DataFrame], state: GroupState, keep: int | None = None
) -> Iterator[pd.DataFrame]:
    days, counts, seen, revisions, n, last, base = state.get if state.exists else ([], [], [], [], 0, -1, [])
    held = {d: [k, set(s), r] for d, k, s, r in zip(days, counts, seen, revisions)}
    rows, first = [], None
    for day, k, kinds in pd.concat(list(frames)).sort_values("day", kind="stable").itertuples(index=False):
        if last >= 0 and day <= last:
            rows.append((*key, day, None, None, None, -1))
            continue
        entry = held.setdefault(day, [0, set(), -1])
        entry[0] += k
        entry[1].update(kinds)
        first = day if first is None else min(first, day)
    # Every day from the first new one on has a new history.
    before, at, known = n, last, set(base)
    for day in sorted(held):
        k, kinds, revision = held[day]
        if first is not None and day >= first:
            held[day][2] = revision + 1
            rows.append((*key, day, before, day - at if at >= 0 else -1, len(known), revision + 1))
        before, at = before + k, day
        known |= kinds
    if keep is not None and held:
        base, newest = set(base), max(held)
        for day in sorted(d for d in held if d < newest - keep):
            k, kinds, _ = held.pop(day)
            n, last = n + k, day
            base |= kinds
    order = sorted(held)
    state.update((
        [int(d) for d in order], [int(held[d][0]) for d in order], [sorted(held[d][1]) for d in order],
        [int(held[d][2]) for d in order], int(n), int(last), sorted(base),
    ))
    columns = ["key", "day", "n_prior", "days_since", "kinds_prior", "revision"]
    yield pd.DataFrame(rows, columns=columns).astype({c: "Int64" for c in columns[1:]})


def entity_history(daily: DataFrame, key: str, day: str, count: str, kinds: str, keep: int | None = DAYS_KEPT) -> DataFrame:
    """Count, last day and distinct kinds before each day per entity, in whatever order days arrive.

    One input row is one entity-day; a further row of a day adds to it. A late day comes with the history before it,
    and all later days of the entity come again with a higher ``revision``, so ``newest_revision`` of the table is the
    same for every order of arrival. The state of an entity holds its days down to ``keep`` before the newest and one
    sum of all before (all days, if ``keep`` is None), so a late day emits at most the days held; a day not after the
    last summed one is a row of revision -1 without history.
    """
    kind = daily.schema[key].dataType.simpleString()
    return (
        daily.select(key, F.col(day).cast("bigint").alias("day"), F.col(count).cast("bigint").alias("k"), F.col(kinds).alias("kinds"))
        .groupBy(key)
        .applyInPandasWithState(
            lambda g, it, st: _history_state(g, (f[["day", "k", "kinds"]] for f in it), st, keep),
            f"key {kind}, day bigint, n_prior bigint, days_since bigint, kinds_prior bigint, revision bigint",
            "days array<bigint>, counts array<bigint>, seen array<array<string>>, revisions array<bigint>, n bigint, last bigint, base array<string>",
            "append",
            GroupStateTimeout.NoTimeout,
        )
        .withColumnRenamed("key", key)
    )


def stateful_dedupe(events: DataFrame, keys: Sequence[str], time: str, delay: str) -> DataFrame:
    """First arrival of each key; keys leave the state once the watermark passes them."""
    timed = events.withColumn("_time", F.col(time).cast("timestamp")).withWatermark("_time", delay)
    return timed.dropDuplicatesWithinWatermark(list(keys)).drop("_time")


FAN = 8


def live_runs(batches: int, fan: int = FAN) -> list[tuple[int, int]]:
    """(level, first batch) of the runs that hold the first ``batches`` batches; a run of level k holds fan^k of them."""
    runs, first, level = [], 0, 0
    while fan ** (level + 1) <= batches:
        level += 1
    for k in range(level, -1, -1):
        while batches - first >= fan**k:
            runs.append((k, first))
            first += fan**k
    return runs


def revision_log(
    stream: DataFrame,
    keys: Sequence[str],
    revision: Callable[[], Column],
    columns: Sequence[str],
    folder: str,
    fan: int = FAN,
) -> DataFrame:
    """Keep the newest revision per key of a stream of revised rows.

    Each batch is reduced to one row per key and written as a run of level 0. Whenever ``fan`` runs of a level are
    full, they are merged to one run of the next, so the table is the newest row over a number of runs that grows
    with the logarithm of the batches. Which runs those are follows from the number of batches alone, and no run that
    a merge read is changed: a retried batch or merge writes the same run again.
    """
    spark = stream.sparkSession
    run = lambda level, first: f"{folder}/log/level={level}/first={first}"

    def write(batch: DataFrame, batch_id: int) -> None:
        latest_by(batch, keys, revision(), columns).write.mode("overwrite").parquet(run(0, batch_id))
        done, level = batch_id + 1, 1
        while done % fan**level == 0:
            full = [run(level - 1, done - fan**level + i * fan ** (level - 1)) for i in range(fan)]
            merged = latest_by(spark.read.parquet(*full), keys, revision(), columns)
            merged.write.mode("overwrite").parquet(run(level, done - fan**level))
            level += 1
        # Two places in turn, so that one is whole while the other is written.
        spark.range(1).select(F.lit(done).alias("done")).write.mode("overwrite").parquet(f"{folder}/head/place={batch_id % 2}")

    q = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    done = spark.read.parquet(f"{folder}/head").agg(F.max("done")).first()[0]
    log = spark.read.parquet(*[run(*r) for r in live_runs(done, fan)])
    return latest_by(log, keys, revision(), columns)


def committed_scores(
    stream: DataFrame, row_id: str, time: str, score: Callable[[DataFrame], DataFrame], folder: str
) -> DataFrame:
    """One committed prediction per row, offered batch by batch and inside a batch in order of (time, row).

    ``score`` keeps the columns it gets. Scores are partitioned by ``day`` of the time ('none' without one), and a
    batch reads earlier scores of its own days only, to leave out rows that have one. ``late`` marks rows before the
    newest time that an earlier batch committed: a forecaster that learns in time order has passed them. A row has one
    time; repeated rows of a batch are scored once. A retried batch replaces its own partitions.
    """
    spark = stream.sparkSession
    out, clock = f"{folder}/scores", f"{folder}/clock"
    kinds = {f.name: f.dataType.simpleString() for f in stream.schema}
    day = F.coalesce(F.date_format(time, "yyyy-MM-dd"), F.lit("none"))

    def write(batch: DataFrame, batch_id: int) -> None:
        fresh = batch.dropDuplicates([row_id]).withColumn("day", day)
        newest = None
        if batch_id > 0:
            earlier = F.col("batch") < batch_id
            newest = spark.read.schema(f"newest {kinds[time]}, batch bigint").parquet(clock).where(earlier).agg(F.max("newest")).first()[0]
            done = spark.read.schema(f"`{row_id}` {kinds[row_id]}, day string, batch bigint").parquet(out).where(earlier)
            days = fresh.select("day").distinct()
            fresh = fresh.join(done.join(days, "day", "left_semi").select("day", row_id), ["day", row_id], "left_anti")
        late = F.coalesce(F.col(time) < F.lit(newest).cast(kinds[time]), F.lit(False))
        ordered = fresh.withColumn("late", late).repartitionByRange(time, row_id).sortWithinPartitions(time, row_id)
        scored = score(ordered).withColumn("batch", F.lit(batch_id).cast("bigint"))
        scored.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "batch").parquet(out)
        batch.agg(F.max(time).alias("newest")).write.mode("overwrite").parquet(f"{clock}/batch={batch_id}")

    q = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    like = score(spark.createDataFrame([], stream.schema).withColumn("day", day).withColumn("late", F.lit(False)))
    return spark.read.schema(f"{_fields(like)}, batch bigint").parquet(out)


def _fields(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def live_outcomes(panel: DataFrame, outcomes: DataFrame, key: str, time: str, horizon: str) -> DataFrame:
    """Left outer interval join of period rows and their outcome one horizon later.

    A row without an outcome is emitted only when the watermark says that none can come,
    so live rows are withheld rather than called unobserved. Both sides are one row per
    (key, period), so no group forms pairs.
    """
    left = panel.select(
        key, F.col(time).alias("l_time"), (F.col(time) + F.expr(f"INTERVAL {horizon}")).alias("due")
    ).withWatermark("l_time", "0 seconds")
    right = outcomes.select(F.col(key).alias("_key"), F.col(time).alias("r_time")).withWatermark(
        "r_time", "0 seconds"
    )
    on = (
        (F.col(key) == F.col("_key"))
        & (F.col("due") == F.col("r_time"))
        & (F.col("r_time") >= F.col("l_time"))
        & (F.col("r_time") <= F.col("l_time") + F.expr(f"INTERVAL {horizon}"))
    )
    return left.join(right, on, "leftOuter").select(key, "l_time", F.col("r_time").isNotNull().alias("observed"))

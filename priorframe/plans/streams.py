"""L: streaming operators over the events and orders files."""

from pyspark.sql import functions as F

from priorframe.operators.predictors import user_predictor
from priorframe.plans.base import cents
from priorframe.plans.registry import query
from priorframe.session import scratch_dir
from priorframe.streaming import streams as ops

DAY = 86400


def n_all():
    return F.count(F.lit(1))


def events(spark, sf):
    return ops.read_stream(spark, f"{sf}/events.parquet")


def epoch_day(c):
    return F.floor(F.unix_timestamp(c) / DAY)


def weekly_table(spark, sf, keys, folder):
    closed = ops.closed_periods(
        events(spark, sf), keys, "ts", "7 days", "1 day",
        [n_all().alias("n"), F.sum(cents("value")).alias("c")], ops.MONDAY,
    )
    return ops.run_to_table(closed, folder)


def daily_table(spark, sf, folder):
    closed = ops.closed_periods(
        events(spark, sf), ["user_id"], "ts", "1 day", "1 hour",
        [n_all().alias("n"), F.sum(cents("value")).alias("c"), F.array_sort(F.collect_set("event_type")).alias("kinds")],
    )
    return ops.run_to_table(closed, folder)


WEEKS = """wk AS (SELECT user_id, event_type, date_trunc('week', ts) AS start, CAST(round(value * 100) AS BIGINT) AS v, (SELECT max(ts) FROM events) AS last FROM events),
cw AS (SELECT * FROM wk WHERE start + INTERVAL 7 DAY <= last - INTERVAL 1 DAY)"""
DAYS = """dy AS (SELECT user_id, event_type, CAST(ts AS DATE) AS day, CAST(round(value * 100) AS BIGINT) AS v FROM events
  WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR)"""


@query("l1_weekly_transition_stream", f"""
WITH {WEEKS}, g AS (SELECT user_id, date_diff('day', DATE '1969-12-29', CAST(start AS DATE)) // 7 AS week, CAST(sum(v) AS BIGINT) AS c FROM cw GROUP BY ALL)
SELECT a.user_id, a.week, a.c AS value, b.c AS next_value, l1.c AS lag1, l2.c AS lag2, l3.c AS lag3 FROM g a JOIN g b ON b.user_id = a.user_id AND b.week = a.week + 1
LEFT JOIN g l1 ON l1.user_id = a.user_id AND l1.week = a.week - 1 LEFT JOIN g l2 ON l2.user_id = a.user_id AND l2.week = a.week - 2 LEFT JOIN g l3 ON l3.user_id = a.user_id AND l3.week = a.week - 3""")
def weekly_transition(spark, sf):
    folder = scratch_dir(spark, "weekly-transition")
    weekly_table(spark, sf, ["user_id"], f"{folder}/weeks")
    weekly = ops.read_stream(spark, f"{folder}/weeks/table")
    # Monday 1969-12-29 starts week 0.
    numbered = weekly.withColumn("week", F.floor((epoch_day("start") + 3) / 7))
    rows = ops.run_to_table(ops.weekly_transitions(numbered, "user_id", "week", "c"), f"{folder}/transitions")
    return ops.newest_revision(rows, ["user_id", "week"])


@query("l2_tumbling_week_agg", f"""
WITH {WEEKS} SELECT event_type, strftime(start, '%Y-%m-%d') AS week, count(*) AS n, CAST(sum(v) AS BIGINT) AS c FROM cw GROUP BY ALL""")
def tumbling_week(spark, sf):
    t = weekly_table(spark, sf, ["event_type"], scratch_dir(spark, "tumbling-week"))
    return t.select("event_type", F.date_format("start", "yyyy-MM-dd").alias("week"), "n", "c")


@query("l3_ordered_state_history", f"""
WITH {DAYS}, g AS (SELECT user_id, day, count(*) AS n FROM dy GROUP BY ALL)
SELECT a.user_id, date_diff('day', DATE '1970-01-01', a.day) AS day, CAST(coalesce(sum(b.n), 0) AS BIGINT) AS n_prior, coalesce(date_diff('day', max(b.day), a.day), -1) AS days_since,
  (SELECT count(DISTINCT event_type) FROM dy WHERE dy.user_id = a.user_id AND dy.day < a.day) AS kinds_prior
FROM g a LEFT JOIN g b ON b.user_id = a.user_id AND b.day < a.day GROUP BY a.user_id, a.day""")
def ordered_state(spark, sf):
    folder = scratch_dir(spark, "ordered-state")
    daily_table(spark, sf, f"{folder}/days")
    daily = ops.read_stream(spark, f"{folder}/days/table").withColumn("day", epoch_day("start"))
    rows = ops.run_to_table(ops.entity_history(daily, "user_id", "day", "n", "kinds"), f"{folder}/history")
    return ops.newest_revision(rows, ["user_id", "day"])


@query("l4_chronological_scoring", """
SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, false AS late, round(1 / (1 + exp((100 - value) / 50)), 6) AS score FROM events""")
def chronological(spark, sf):
    def predict(frame):
        import numpy as np

        return 1 / (1 + np.exp((100 - frame["value"]) / 50))

    stream = events(spark, sf).select("event_id", "ts", "value")
    folder = scratch_dir(spark, "chronological-scoring")
    out = ops.committed_scores(stream, "event_id", "ts", lambda b: user_predictor(b, predict, ["value"]), folder)
    return out.select("event_id", "day", "late", F.round("score", 6).alias("score"))


@query("l5_stateful_dedupe", """
SELECT DISTINCT user_id, event_type, strftime(ts, '%Y-%m-%d') AS day FROM events""")
def dedupe(spark, sf):
    e = events(spark, sf).select("user_id", "event_type", "ts", F.date_format("ts", "yyyy-MM-dd").alias("day"))
    kept = ops.stateful_dedupe(e, ["user_id", "event_type", "day"], "ts", "1 day").drop("ts")
    return ops.run_to_table(kept, scratch_dir(spark, "stateful-dedupe"))


@query("l6_late_revision_merge", """
SELECT o_custkey, year(o_orderdate) AS year, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS o_orderstatus FROM orders GROUP BY ALL""")
def late_revision(spark, sf):
    o = ops.read_stream(spark, f"{sf}/orders.parquet").withColumn("year", F.year("o_orderdate").cast("bigint"))
    merged = ops.revision_log(
        o, ["o_custkey", "year"], lambda: F.struct("o_orderdate", "o_orderkey"),
        ["o_orderdate", "o_orderkey", "o_orderstatus"], scratch_dir(spark, "late-revision"),
    )
    return merged.drop("o_orderdate")


@query("l7_right_censor_tail", """
SELECT event_type, strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events
WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 7 DAY GROUP BY ALL""")
def right_censor(spark, sf):
    final = ops.closed_periods(events(spark, sf), ["event_type"], "ts", "1 day", "7 days", [n_all().alias("n")])
    t = ops.run_to_table(final, scratch_dir(spark, "right-censor"))
    return t.select("event_type", F.date_format("start", "yyyy-MM-dd").alias("day"), "n")


@query("l8_live_period_rows", f"""
WITH {DAYS}, g AS (SELECT DISTINCT user_id, day FROM dy), m AS (SELECT max(day) AS last FROM g)
SELECT strftime(a.day, '%Y-%m-%d') AS day, CASE WHEN b.day IS NOT NULL THEN 'labelled' WHEN a.day + 1 <= last THEN 'unobserved' ELSE 'live' END AS status, count(*) AS n
FROM g a CROSS JOIN m LEFT JOIN g b ON b.user_id = a.user_id AND b.day = a.day + 1 GROUP BY ALL""")
def live_period(spark, sf):
    folder = scratch_dir(spark, "live-period")
    days = daily_table(spark, sf, f"{folder}/days").select("user_id", "start")
    panel = ops.read_stream(spark, f"{folder}/days/table").select("user_id", "start")
    outcomes = ops.read_stream(spark, f"{folder}/days/table").select("user_id", "start")
    done = ops.run_to_table(ops.live_outcomes(panel, outcomes, "user_id", "start", "1 day"), f"{folder}/outcomes")
    status = F.when(F.col("observed").isNull(), "live").when(F.col("observed"), "labelled").otherwise("unobserved")
    rows = days.join(done.withColumnRenamed("l_time", "start"), ["user_id", "start"], "left")
    return rows.groupBy(F.date_format("start", "yyyy-MM-dd").alias("day"), status.alias("status")).agg(n_all().alias("n"))

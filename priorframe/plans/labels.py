"""F: label construction, and the flagship question."""

from pyspark.sql import functions as F

from priorframe.functions.numbers import guarded_ratio
from priorframe.operators import history
from priorframe.operators import labels as ops
from priorframe.operators.aggregates import rate_table
from priorframe.operators.metrics import rank_auc
from priorframe.plans import base
from priorframe.plans.base import DAILY, MONTHLY, ORDERS, auc_sql, cents
from priorframe.plans.history import TRAILING_P95, trailing_p95
from priorframe.plans.joins import ITEM_TOTALS, order_and_items
from priorframe.plans.registry import query
from priorframe.sources.sinks import written_once
from priorframe.sources.tables import table

USER = ["user_id"]


@query("f1_threshold_next_period", f"""
WITH {DAILY} SELECT a.user_id, a.d, CAST(b.c > 20000 AS BIGINT) AS label FROM p a LEFT JOIN p b ON b.user_id = a.user_id AND b.d = a.d + 1""")
def threshold_next(spark, sf):
    return base.daily(spark, sf).select("user_id", "d", ops.threshold_next("c", USER, "d", 20000).alias("label"))


@query("f2_direction_change", f"""
WITH {MONTHLY} SELECT a.nation, a.m, CAST(b.c < a.c AS BIGINT) AS label FROM mo a LEFT JOIN mo b ON b.nation = a.nation AND b.m = a.m + 1""")
def direction(spark, sf):
    return base.monthly(spark, sf).select("nation", "m", ops.direction_next("c", ["nation"], "m").alias("label"))


@query("f3_ratio_at_least", f"""
WITH {ORDERS}, {ITEM_TOTALS} SELECT o_orderkey, CAST(item_cents * 2 >= cents AS BIGINT) AS label FROM o JOIN it ON o_orderkey = l_orderkey""")
def ratio_at_least(spark, sf):
    return order_and_items(spark, sf).select(
        "o_orderkey", ops.flag(F.col("item_cents") * 2 >= F.col("cents")).alias("label")
    )


REORDER = """lab AS (SELECT o.*, day > (SELECT max(day) FROM o) - 90 AS censored,
  CASE WHEN day <= (SELECT max(day) FROM o) - 90 THEN CAST(coalesce(nx - day <= 90, false) AS BIGINT) END AS again
  FROM o JOIN (SELECT o_custkey, day, lead(day) OVER (PARTITION BY o_custkey ORDER BY day) AS nx
               FROM (SELECT DISTINCT o_custkey, day FROM o)) USING (o_custkey, day))"""


@query("f4_event_within_horizon", f"""WITH {ORDERS}, {REORDER} SELECT o_orderkey, censored, again AS label FROM lab""")
def within_horizon(spark, sf):
    o = base.orders(spark, sf).select("o_orderkey", "o_custkey", "day")
    return ops.event_within(o, ["o_custkey"], "day", 90).select("o_orderkey", "censored", "label")


@query("f5_duration_within", """
WITH t AS (SELECT year(o_orderdate) AS year, date_diff('day', o_orderdate, l_shipdate) - CASE WHEN l_linenumber = 5 THEN 60 ELSE 0 END AS gap, l_returnflag = 'N' AS open
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT year, CASE WHEN open THEN 'open' WHEN gap < 0 THEN 'negative' ELSE 'labelled' END AS reason, count(*) AS n,
  count(*) FILTER (NOT open AND gap >= 0 AND gap <= 30) AS positives FROM t GROUP BY ALL""")
def duration_within(spark, sf):
    l = table(spark, sf, "lineitem").select("l_orderkey", "l_shipdate", "l_linenumber", "l_returnflag")
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    closed = F.date_sub(F.col("l_shipdate").cast("date"), F.when(F.col("l_linenumber") == 5, 60).otherwise(0))
    got = ops.duration_label(F.col("o_orderdate").cast("date"), closed, F.col("l_returnflag") == "N", 30)
    t = l.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.year("o_orderdate").cast("bigint").alias("year"), *[c.alias(n) for n, c in got.items()]
    )
    return t.groupBy("year", "reason").agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("label") == 1, 1)).alias("positives")
    )


CORRIDOR = """y AS (SELECT c_nationkey AS host, o_custkey AS origin, year(o_orderdate) AS year, count(*) AS c
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)"""


def corridor(spark, sf):
    """Yearly orders per (host nation, customer)."""
    o = table(spark, sf, "orders").select("o_custkey", F.year("o_orderdate").cast("bigint").alias("year"))
    c = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("host"))
    return o.join(c, F.col("o_custkey") == F.col("c_custkey")).groupBy(
        "host", F.col("o_custkey").alias("origin"), "year"
    ).agg(F.count(F.lit(1)).alias("c"))


@query("f6_future_sum_multiple", f"""
WITH {CORRIDOR}, h AS (SELECT DISTINCT host, year FROM y)
SELECT a.host, a.origin, a.year, h1.year IS NOT NULL AND h2.year IS NOT NULL AS observed,
  CASE WHEN h1.year IS NOT NULL AND h2.year IS NOT NULL THEN CAST(coalesce(b.c, 0) + coalesce(d.c, 0) >= 2 * a.c AS BIGINT) END AS label
FROM y a LEFT JOIN y b ON b.host = a.host AND b.origin = a.origin AND b.year = a.year + 1
LEFT JOIN y d ON d.host = a.host AND d.origin = a.origin AND d.year = a.year + 2
LEFT JOIN h h1 ON h1.host = a.host AND h1.year = a.year + 1 LEFT JOIN h h2 ON h2.host = a.host AND h2.year = a.year + 2""")
def future_sum(spark, sf):
    out = ops.future_sum_multiple(corridor(spark, sf), ["host", "origin"], "year", "c", ["host"], 2)
    return out.select("host", "origin", "year", "observed", "label")


@query("f7_terminal_state_reduce", """
WITH g AS (SELECT user_id, CAST(ts AS DATE) AS day, count(*) FILTER (event_type = 'purchase' AND value > 60) AS p, count(*) FILTER (event_type = 'error' AND value > 90) AS n FROM events GROUP BY ALL),
s AS (SELECT *, day <= min(day) OVER (PARTITION BY user_id) + 10 AS inside FROM g),
l AS (SELECT user_id, arg_max((p, n), day) FILTER (inside AND p + n > 0) AS l, count(*) FILTER (NOT inside AND p + n > 0) AS late FROM s GROUP BY ALL)
SELECT user_id, CASE WHEN l IS NULL AND late > 0 THEN 'late' WHEN l IS NULL THEN 'pending' WHEN l[1] > 0 AND l[2] > 0 THEN 'mixed'
  WHEN l[1] > 0 THEN 'positive' ELSE 'negative' END AS outcome FROM l""")
def terminal(spark, sf):
    t, v = F.col("event_type"), F.col("value")
    state = F.when((t == "purchase") & (v > 60), "won").when((t == "error") & (v > 90), "lost").otherwise("open")
    e = table(spark, sf, "events").select("user_id", "ts", state.alias("state"))
    return ops.terminal_state(e, USER, "ts", "state", ["won"], ["lost"], 10)


@query("f8_status_vocabulary_label", """
SELECT CASE WHEN o_orderpriority SIMILAR TO '.*(URGENT|HIGH).*' THEN 'positive' WHEN o_orderpriority SIMILAR TO '.*LOW.*' THEN 'negative'
  WHEN o_orderpriority LIKE '%MEDIUM%' THEN 'merged' ELSE 'nonterminal' END AS outcome, count(*) AS n FROM orders GROUP BY ALL""")
def vocabulary(spark, sf):
    kinds = [("URGENT|HIGH", "positive"), ("LOW", "negative"), ("MEDIUM", "merged")]
    outcome = ops.vocabulary_label(F.col("o_orderpriority"), kinds, "nonterminal")
    return table(spark, sf, "orders").groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


@query("f9_quantile_relative_label", f"""WITH {DAILY}, {TRAILING_P95} SELECT user_id, d, CAST(c > p95 AS BIGINT) AS label FROM tp""")
def quantile_relative(spark, sf):
    return trailing_p95(base.daily(spark, sf)).select("user_id", "d", ops.flag(F.col("c") > F.col("p95")).alias("label"))


@query("f10_publisher_flag_label", f"""
WITH {DAILY}, fl AS (SELECT DISTINCT user_id, date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS d FROM events WHERE event_type = 'error')
SELECT p.user_id, p.d, CAST(fl.d IS NOT NULL AS BIGINT) AS label FROM p LEFT JOIN fl ON fl.user_id = p.user_id AND fl.d = p.d + 1""")
def publisher_flag(spark, sf):
    e = table(spark, sf, "events").where("event_type = 'error'")
    flags = e.select("user_id", (history.day_number("ts") - 1).alias("d"), F.lit(1).alias("hit")).distinct()
    return base.daily(spark, sf).join(flags, ["user_id", "d"], "left").select(
        "user_id", "d", ops.flag(F.col("hit").isNotNull()).alias("label")
    )


@query("f11_child_exists_label", """
SELECT o_orderkey, CAST(EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 45) AS BIGINT) AS label FROM orders""")
def child_exists(spark, sf):
    big = table(spark, sf, "lineitem").where("l_quantity > 45").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    o = table(spark, sf, "orders").select("o_orderkey")
    return o.join(big.withColumn("hit", F.lit(True)), "o_orderkey", "left").select(
        "o_orderkey", ops.flag(F.col("hit").isNotNull()).alias("label")
    )


@query("f12_rate_targeted_threshold", f"""
WITH {ORDERS}, r AS (SELECT cents, row_number() OVER (ORDER BY cents) - 1 AS i, count(*) OVER () AS total FROM o WHERE split = 'train'),
t AS (SELECT (CAST(ceil(max(cents) FILTER (i = total - ceil(total * 0.2::DOUBLE)) / 6000e0) AS BIGINT) - 1) * 6000 AS threshold FROM r)
SELECT split, any_value(threshold) AS threshold, count(*) AS n, count(*) FILTER (cents > threshold) AS positives FROM o, t GROUP BY ALL""")
def rate_targeted(spark, sf):
    o = base.orders(spark, sf)
    cut = ops.rate_threshold(o.where("split = 'train'").select("cents"), "cents", 0.2, 6000).scalar()
    return o.withColumn("threshold", cut).groupBy("split").agg(
        F.max("threshold").alias("threshold"), F.count(F.lit(1)).alias("n"),
        F.count(F.when(F.col("cents") > F.col("threshold"), 1)).alias("positives"),
    )


def reorder_panel(spark, sf):
    """Orders with strictly prior history and whether the customer orders again in 90 days."""
    o = base.orders(spark, sf).select("o_orderkey", "o_custkey", "day", "split", "o_orderpriority", "cents", "label")
    known = history.strict_prior(
        o, ["o_custkey"], "day",
        {"n_prior": ("sum", F.lit(1).cast("bigint")), "f_prior": ("sum", F.col("label"))},
    )
    since = history.days_since_last(known, ["o_custkey"], "day", "days_since", -1)
    return ops.event_within(since, ["o_custkey"], "day", 90, "again")


def flagship(spark, sf):
    """AUC of each shipped column, and of a train-only prior, for the reorder label."""
    panel = written_once(reorder_panel(spark, sf), "reorder-panel")
    prior = rate_table(panel.where("split = 'train'"), ["o_orderpriority"], "again")
    scored = panel.where("NOT censored").join(
        prior.select("o_orderpriority", F.col("rate").alias("prior")), "o_orderpriority", "left"
    )
    columns = {
        "n_prior": F.coalesce("n_prior", F.lit(0)), "days_since": F.col("days_since"),
        "prior_fail_rate": guarded_ratio(F.col("f_prior"), F.col("n_prior"), -1.0),
        "cents": F.col("cents"), "priority_prior": F.col("prior"),
    }
    long = scored.select(
        "split", "again",
        F.explode(F.array(*[
            F.struct(F.lit(n).alias("column"), c.cast("double").alias("score")) for n, c in columns.items()
        ])).alias("s"),
    ).select("split", "again", "s.column", "s.score")
    auc = rank_auc(long, ["split", "column"], "score", "again")
    worst = F.greatest("auc", 1 - F.col("auc"))
    return auc.withColumn("blocked", F.coalesce(worst > 0.95, F.lit(False)))


query("entry_reorder_leak_check", f"""
WITH {ORDERS}, {REORDER}, g AS (SELECT o_custkey, day, count(*) AS n, CAST(sum(label) AS BIGINT) AS f FROM o GROUP BY ALL),
h AS (SELECT o_custkey, day, coalesce(sum(n) OVER w, 0) AS n_prior, sum(f) OVER w AS f_prior, coalesce(day - lag(day) OVER (PARTITION BY o_custkey ORDER BY day), -1) AS days_since
  FROM g WINDOW w AS (PARTITION BY o_custkey ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
pr AS (SELECT o_orderpriority, CAST(sum(again) AS DOUBLE) / count(again) AS prior FROM lab WHERE split = 'train' GROUP BY ALL),
x AS (SELECT split, again, unnest(['n_prior', 'days_since', 'prior_fail_rate', 'cents', 'priority_prior']) AS "column",
  unnest([CAST(n_prior AS DOUBLE), CAST(days_since AS DOUBLE), CASE WHEN n_prior > 0 THEN CAST(f_prior AS DOUBLE) / n_prior ELSE -1e0 END, CAST(cents AS DOUBLE), prior]) AS score
  FROM lab JOIN h USING (o_custkey, day) LEFT JOIN pr USING (o_orderpriority) WHERE NOT censored),
a AS ({auc_sql("x", 'split, "column"', "score", "again")}) SELECT *, coalesce(greatest(auc, 1 - auc) > 0.95, false) AS blocked FROM a""")(flagship)

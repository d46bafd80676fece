"""K: reference predictors."""

from pyspark.sql import functions as F

from priorframe.operators import predictors as ops
from priorframe.operators.history import at_offset, month_number
from priorframe.operators.metrics import rank_auc
from priorframe.plans import base
from priorframe.plans.base import DAILY, LABELLED, ORDERS, auc_sql
from priorframe.plans.gate import EVENT_SPLITS  # noqa: F401
from priorframe.plans.probes import SPLIT_DAILY, TOKENS, split_daily
from priorframe.plans.registry import query
from priorframe.sources.tables import table


@query("k1_constant_prior", f"""
WITH {LABELLED} SELECT doc_id, (SELECT avg(CAST(y AS DOUBLE)) FROM ld WHERE split = 'train') AS score FROM ld WHERE split <> 'train'""")
def constant_prior(spark, sf):
    d = base.labelled_documents(spark, sf).select("doc_id", "split", "y")
    return d.withColumn("score", ops.train_rate(d, "y")).where("split <> 'train'").select("doc_id", "score")


def with_month(o):
    return o.withColumn("month", F.month("day").cast("bigint"))


@query("k2_calendar_identity_prior", f"""
WITH {ORDERS}, t AS (SELECT o_custkey, month(day) AS month, avg(CAST(label AS DOUBLE)) AS cell FROM o WHERE split = 'train' GROUP BY ALL)
SELECT o_orderkey, coalesce(cell, (SELECT avg(CAST(label AS DOUBLE)) FROM o WHERE split = 'train')) AS score FROM o LEFT JOIN t ON t.o_custkey = o.o_custkey AND t.month = month(o.day) WHERE split <> 'train'""")
def calendar_identity(spark, sf):
    o = with_month(base.orders(spark, sf).select("o_orderkey", "o_custkey", "day", "split", "label"))
    return ops.keyed_prior(o, ["o_custkey", "month"], "label").where("split <> 'train'").select("o_orderkey", "score")


@query("k3_fallback_rate_chain", f"""
WITH {ORDERS}, tr AS (SELECT *, month(day) AS month FROM o WHERE split = 'train'), c AS (SELECT o_custkey, month, avg(CAST(label AS DOUBLE)) AS r FROM tr GROUP BY ALL),
m0 AS (SELECT o_custkey, avg(CAST(label AS DOUBLE)) AS r FROM tr GROUP BY ALL), m1 AS (SELECT o_orderpriority, avg(CAST(label AS DOUBLE)) AS r FROM tr GROUP BY ALL)
SELECT o_orderkey, CASE WHEN c.r IS NOT NULL THEN 'cell' WHEN m0.r IS NOT NULL OR m1.r IS NOT NULL THEN 'marginal' ELSE 'global' END AS level,
  round(coalesce(c.r, (coalesce(m0.r, 0) + coalesce(m1.r, 0)) / nullif(CAST(m0.r IS NOT NULL AS INTEGER) + CAST(m1.r IS NOT NULL AS INTEGER), 0), (SELECT avg(CAST(label AS DOUBLE)) FROM tr)), 9) AS score
FROM o LEFT JOIN c ON c.o_custkey = o.o_custkey AND c.month = month(o.day) LEFT JOIN m0 ON m0.o_custkey = o.o_custkey LEFT JOIN m1 ON m1.o_orderpriority = o.o_orderpriority WHERE split <> 'train'""")
def fallback(spark, sf):
    o = with_month(base.orders(spark, sf).select("o_orderkey", "o_custkey", "o_orderpriority", "day", "split", "label"))
    out = ops.fallback_chain(o, ["o_custkey", "month"], [["o_custkey"], ["o_orderpriority"]], "label")
    return out.where("split <> 'train'").select("o_orderkey", "level", F.round("score", 9).alias("score"))


LAGGED = """lg AS (SELECT sd.user_id, sd.d, sd.split, sd.c, b.c AS lag1, CAST(sd.c > 20000 AS BIGINT) AS y FROM sd LEFT JOIN sd b ON b.user_id = sd.user_id AND b.d = sd.d - 1)"""


def lagged(spark, sf):
    return split_daily(spark, sf).select(
        "user_id", "d", "split", "c", at_offset("c", ["user_id"], "d", -1).alias("lag1"),
        (F.col("c") > 20000).cast("bigint").alias("y"),
    )


@query("k4_persistence_minmax", f"""
WITH {DAILY}, {SPLIT_DAILY}, {LAGGED}, t AS (SELECT min(lag1) AS lo, max(lag1) AS hi, avg(CAST(y AS DOUBLE)) AS prior FROM lg WHERE split = 'train')
SELECT user_id, d, round(CASE WHEN lag1 IS NOT NULL AND hi > lo THEN 1 - greatest(0, least(1, (lag1 - lo) / CAST(hi - lo AS DOUBLE))) ELSE prior END, 9) AS score FROM lg, t WHERE split <> 'train'""")
def persistence(spark, sf):
    out = ops.persistence_minmax(lagged(spark, sf), "lag1", "y", direction=-1)
    return out.where("split <> 'train'").select("user_id", "d", F.round("score", 9).alias("score"))


@query("k5_shipped_value_persistence", f"""
WITH {DAILY}, {SPLIT_DAILY}, {LAGGED}, s AS (SELECT split, lag1 AS score, y FROM lg), a AS ({auc_sql("s", "split")}) SELECT * FROM a""")
def shipped_value(spark, sf):
    return rank_auc(lagged(spark, sf), ["split"], "lag1", "y")


@query("k6_token_prior", f"""
WITH {LABELLED}, {TOKENS}, r AS (SELECT token, avg(CAST(y AS DOUBLE)) AS r FROM tk WHERE split = 'train' GROUP BY ALL HAVING count(*) >= 5),
m AS (SELECT doc_id, avg(r) AS mean, count(*) AS known FROM tk JOIN r USING (token) GROUP BY ALL)
SELECT doc_id, coalesce(known, 0) AS known_tokens, round(coalesce(mean, (SELECT avg(CAST(y AS DOUBLE)) FROM ld WHERE split = 'train')), 6) AS score FROM ld LEFT JOIN m USING (doc_id) WHERE split <> 'train'""")
def token_prior(spark, sf):
    d = base.labelled_documents(spark, sf).select("doc_id", "split", "y", "text")
    out = ops.token_prior(d, "doc_id", "text", "y")
    return out.select("doc_id", "known_tokens", F.round("score", 6).alias("score"))


@query("k7_trailing_rate_prior", f"""
WITH {ORDERS}, g AS (SELECT o_orderpriority, CAST(year * 12 + month(day) - 1 AS BIGINT) AS m, count(*) AS n, CAST(sum(label) AS BIGINT) AS p FROM o GROUP BY ALL)
SELECT o_orderpriority, m, CAST(sum(p) OVER w AS DOUBLE) / CAST(sum(n) OVER w AS BIGINT) AS score FROM g WINDOW w AS (PARTITION BY o_orderpriority ORDER BY m RANGE BETWEEN 12 PRECEDING AND 1 PRECEDING)""")
def trailing_rate(spark, sf):
    o = base.orders(spark, sf).withColumn("m", month_number("day"))
    return ops.trailing_rate(o, ["o_orderpriority"], "m", "label")


@query("k8_per_column_rate_report", f"""
WITH {LABELLED}, c AS (SELECT split, y, unnest(['lang', 'source']) AS field, unnest([lang, source]) AS value FROM ld), r AS (SELECT field, value, avg(CAST(y AS DOUBLE)) AS r FROM c WHERE split = 'train' GROUP BY ALL),
s AS (SELECT c.field, c.split, y, coalesce(r, (SELECT avg(CAST(y AS DOUBLE)) FROM ld WHERE split = 'train')) AS score FROM c LEFT JOIN r USING (field, value) WHERE split <> 'train'), a AS ({auc_sql("s", "field, split")}) SELECT * FROM a""")
def column_report(spark, sf):
    d = base.labelled_documents(spark, sf).select("doc_id", "split", "y", "lang", "source")
    return rank_auc(ops.column_rate_scores(d, ["lang", "source"], "doc_id", "y"), ["field", "split"], "score", "y")


@query("k9_smoothed_as_of_rate", f"""
WITH {ORDERS}, g AS (SELECT a.o_orderkey, count(b.o_orderkey) AS n, CAST(coalesce(sum(b.label), 0) AS BIGINT) AS p FROM o a LEFT JOIN o b ON b.o_custkey = a.o_custkey AND b.day + 60 < a.day AND b.o_orderstatus <> 'P' GROUP BY ALL)
SELECT o_orderkey, CASE WHEN n = 0 THEN 0.5::DOUBLE WHEN n < 3 THEN (p + 0.5::DOUBLE) / (n + 1) ELSE CAST(p AS DOUBLE) / n END AS score FROM g""")
def smoothed(spark, sf):
    closed = F.when(F.col("o_orderstatus") != "P", F.date_add("day", 60))
    o = base.orders(spark, sf).select("o_orderkey", "o_custkey", "day", "label", closed.alias("closed"))
    return ops.smoothed_as_of(o, ["o_custkey"], "day", "closed", "label", F.lit(0.5)).select("o_orderkey", "score")


def model_rows(spark, sf):
    from priorframe.functions.text import words

    d = base.labelled_documents(spark, sf)
    return d.select(
        "doc_id", "split", F.col("y").cast("double").alias("y"), F.col("n_chars").cast("double").alias("n_chars"),
        F.size(words(F.col("text"))).cast("double").alias("n_words"), "lang", "source",
    )


@query("k10_boosted_tree_reference")
def boosted(spark, sf):
    out = ops.boosted_trees(model_rows(spark, sf), ["n_chars", "n_words"], ["lang", "source"], "y")
    return rank_auc(out, ["split"], "score", "y")


@query("k11_logistic_reference")
def logistic(spark, sf):
    out = ops.logistic(model_rows(spark, sf), ["n_chars", "n_words"], ["lang", "source"], "y")
    return rank_auc(out, ["split"], "score", "y")


@query("k12_recent_window_prior", f"""
WITH {ORDERS}, y AS (SELECT year, sum(label) AS p, count(*) AS n FROM o WHERE split = 'train' GROUP BY ALL ORDER BY year DESC LIMIT 3), s AS (SELECT CAST(sum(p) AS DOUBLE) / sum(n) AS prior FROM y)
SELECT split, any_value(prior) AS prior, round(avg(pow(prior - label, 2)), 9) AS brier FROM o, s GROUP BY ALL""")
def recent_window(spark, sf):
    o = base.orders(spark, sf)
    scored = o.withColumn("prior", ops.recent_window_prior(o, "year", "label"))
    return scored.groupBy("split").agg(
        F.max("prior").alias("prior"), F.round(F.avg(F.pow(F.col("prior") - F.col("label"), 2)), 9).alias("brier")
    )

"""G: splits."""

from pyspark.sql import functions as F

from priorframe.operators import splits as ops
from priorframe.plans import base
from priorframe.plans.base import ORDERS, SPLITS
from priorframe.plans.registry import query
from priorframe.sources.tables import table


def n_all():
    return F.count(F.lit(1)).alias("n")


@query("g1_temporal_half_open", """
SELECT CASE WHEN l_shipdate >= DATE '1995-06-01' AND l_shipdate < DATE '1998-01-01' THEN 'train' WHEN l_shipdate >= DATE '1998-01-01' AND l_shipdate < DATE '1999-01-01' THEN 'eval'
  WHEN l_shipdate >= DATE '1999-01-01' AND l_shipdate < DATE '2000-01-01' THEN 'holdout' ELSE 'outside' END AS split, count(*) AS n FROM lineitem GROUP BY ALL""")
def temporal(spark, sf):
    windows = [("train", "1995-06-01", "1998-01-01"), ("eval", "1998-01-01", "1999-01-01"), ("holdout", "1999-01-01", "2000-01-01")]
    split = ops.half_open(F.col("l_shipdate").cast("date"), windows)
    return table(spark, sf, "lineitem").groupBy(split.alias("split")).agg(n_all())


@query("g2_entity_straddle_drop", f"""
WITH {ORDERS}, b AS (SELECT o_custkey FROM o GROUP BY ALL HAVING count(DISTINCT split) > 1)
SELECT split, count(*) AS n FROM o WHERE o_custkey NOT IN (SELECT o_custkey FROM b) GROUP BY ALL
UNION ALL SELECT 'dropped', count(*) FROM o WHERE o_custkey IN (SELECT o_custkey FROM b)""")
def straddle(spark, sf):
    o = base.orders(spark, sf).select("o_custkey", "split")
    kept = ops.drop_straddlers(o, ["o_custkey"]).groupBy("split").agg(n_all())
    gone = ops.straddlers(o, ["o_custkey"]).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n"))
    return kept.unionByName(gone.select(F.lit("dropped").alias("split"), "n"))


@query("g3_entity_disjoint_split", """
WITH r AS (SELECT o_custkey, dense_rank() OVER (ORDER BY o_custkey) AS k FROM (SELECT DISTINCT o_custkey FROM orders))
SELECT CASE WHEN (k - 1) % 3 = 2 THEN 'held_out' ELSE 'development' END AS "group", count(*) AS n, count(DISTINCT o_custkey) AS entities
FROM orders JOIN r USING (o_custkey) GROUP BY ALL""")
def disjoint(spark, sf):
    o = ops.entity_disjoint(table(spark, sf, "orders").select("o_custkey"), "o_custkey")
    return o.groupBy("group").agg(n_all(), F.countDistinct("o_custkey").alias("entities"))


@query("g4_one_row_per_entity", f"""
WITH {ORDERS}, y AS (SELECT o_custkey, year, CAST(sum(cents) AS BIGINT) AS total FROM o GROUP BY ALL),
e AS (SELECT o_custkey, min(year) AS year FROM y WHERE total >= 60000000 GROUP BY ALL)
SELECT o_custkey, year, total, CASE WHEN year < 1997 THEN 'train' WHEN year < 1999 THEN 'eval' ELSE 'holdout' END AS split FROM y JOIN e USING (o_custkey, year)""")
def one_row(spark, sf):
    y = base.orders(spark, sf).groupBy("o_custkey", "year").agg(F.sum("cents").alias("total"))
    entry = ops.first_crossing(y, ["o_custkey"], "year", F.col("total"), 60000000)
    split = F.when(F.col("year") < 1997, "train").when(F.col("year") < 1999, "eval").otherwise("holdout")
    return y.join(entry.withColumnRenamed("entry", "year"), ["o_custkey", "year"]).withColumn("split", split)


@query("g5_excluded_period", f"""
WITH {ORDERS} SELECT CASE WHEN day >= DATE '1998-09-01' AND day < DATE '1999-03-01' THEN 'shock' ELSE split END AS split, count(*) AS n FROM o GROUP BY ALL""")
def excluded(spark, sf):
    split = ops.excluded_period(F.col("day"), SPLITS, [("shock", "1998-09-01", "1999-03-01")])
    return base.orders(spark, sf).groupBy(split.alias("split")).agg(n_all())


@query("g6_case_level_split", """
WITH c AS (SELECT l_orderkey, min(l_shipdate) AS first, count(*) AS items FROM lineitem GROUP BY ALL)
SELECT CASE WHEN first < DATE '1999-01-01' THEN 'train' WHEN first < DATE '2000-01-01' THEN 'eval' ELSE 'holdout' END AS split,
  count(*) AS cases, CAST(sum(items) AS BIGINT) AS items FROM c GROUP BY ALL""")
def case_level(spark, sf):
    c = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.min("l_shipdate").cast("date").alias("first"), F.count(F.lit(1)).alias("items")
    )
    return c.groupBy(ops.half_open(F.col("first"), SPLITS).alias("split")).agg(
        F.count(F.lit(1)).alias("cases"), F.sum("items").alias("items")
    )


@query("g7_vintage_instant_split", f"""
WITH {ORDERS} SELECT year, CASE year WHEN 1997 THEN 'train' WHEN 1998 THEN 'eval' WHEN 1999 THEN 'holdout' ELSE 'outside' END AS split,
  count(DISTINCT o_custkey) AS entities FROM o GROUP BY ALL""")
def vintage(spark, sf):
    y = F.col("year")
    split = F.when(y == 1997, "train").when(y == 1998, "eval").when(y == 1999, "holdout").otherwise("outside")
    return base.orders(spark, sf).groupBy("year", split.alias("split")).agg(F.countDistinct("o_custkey").alias("entities"))


@query("g8_isolation_check", f"""
WITH {ORDERS} SELECT 'o_custkey' AS key, count(*) AS n_values, count(*) FILTER (k > 1) AS n_shared FROM (SELECT o_custkey, count(DISTINCT split) AS k FROM o GROUP BY ALL)
UNION ALL SELECT 'o_orderkey', count(*), count(*) FILTER (k > 1) FROM (SELECT o_orderkey, count(DISTINCT split) AS k FROM o GROUP BY ALL)""")
def isolation(spark, sf):
    return ops.isolation(base.orders(spark, sf).select("split", "o_custkey", "o_orderkey"), ["o_custkey", "o_orderkey"])

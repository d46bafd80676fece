"""C: joins."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from priorframe.operators import history, joins
from priorframe.plans import base
from priorframe.plans.base import DAILY, ORDERS, cents
from priorframe.plans.registry import query
from priorframe.sources.tables import table


@query("c1_child_parent_equi_join", """
SELECT year(l_shipdate) AS year, CASE WHEN o_orderkey IS NULL THEN 'no_order' WHEN c_custkey IS NULL THEN 'no_customer'
         ELSE 'matched' END AS reason, count(*) AS n
FROM lineitem LEFT JOIN orders ON CASE WHEN l_linenumber % 7 = 0 THEN -l_orderkey ELSE l_orderkey END = o_orderkey
LEFT JOIN customer ON CASE WHEN o_orderkey % 11 = 0 THEN -o_custkey ELSE o_custkey END = c_custkey GROUP BY ALL""")
def child_parent(spark, sf):
    # Some child keys are negated, so that they match no parent; both parents are read whole.
    missing = lambda key, cond: F.when(cond, -F.col(key)).otherwise(F.col(key)).alias(key)
    l = table(spark, sf, "lineitem").select(missing("l_orderkey", F.col("l_linenumber") % 7 == 0), F.year("l_shipdate").cast("bigint").alias("year"))
    o = table(spark, sf, "orders").select("o_orderkey", missing("o_custkey", F.col("o_orderkey") % 11 == 0))
    c = table(spark, sf, "customer").select("c_custkey")
    j = l.join(o, F.col("l_orderkey") == F.col("o_orderkey"), "left").join(
        c, F.col("o_custkey") == F.col("c_custkey"), "left"
    )
    reason = joins.matched_reason(
        [("no_order", F.col("o_orderkey").isNull()), ("no_customer", F.col("c_custkey").isNull())]
    )
    return j.groupBy("year", reason.alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query("c2_dimension_broadcast", """
SELECT year(o_orderdate) AS year, coalesce(r_name, 'unmapped') AS r_name, count(*) AS n
FROM orders JOIN customer ON o_custkey = c_custkey
LEFT JOIN (SELECT n_nationkey, r_name FROM nation JOIN region ON n_regionkey = r_regionkey)
  ON CASE WHEN c_custkey % 9 = 0 THEN -1 ELSE c_nationkey END = n_nationkey GROUP BY ALL""")
def dimension(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", F.year("o_orderdate").cast("bigint").alias("year"))
    # Some customers get an unknown nation; the dimension is read whole.
    nation = F.when(F.col("c_custkey") % 9 == 0, -1).otherwise(F.col("c_nationkey")).alias("c_nationkey")
    c = table(spark, sf, "customer").select("c_custkey", nation)
    n = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    j = joins.map_dimension(
        o.join(c, F.col("o_custkey") == F.col("c_custkey")), n, "c_nationkey", "n_nationkey", "r_name", "unmapped"
    )
    return j.groupBy("year", "r_name").agg(F.count(F.lit(1)).alias("n"))


@query("c3_anti_join_unobserved", """
SELECT c_nationkey, count(*) AS unobserved FROM customer
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderdate >= DATE '2001-01-01') GROUP BY ALL""")
def unobserved(spark, sf):
    recent = table(spark, sf, "orders").where("o_orderdate >= timestamp_ntz'2001-01-01'").select("o_custkey")
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return (
        c.join(recent, F.col("c_custkey") == F.col("o_custkey"), "left_anti")
        .groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("unobserved"))
    )


@query("c4_dated_membership_filter", f"""
WITH {ORDERS}, f AS (SELECT o_custkey, min(day) AS first FROM o GROUP BY ALL),
m AS (SELECT o_custkey, CASE WHEN o_custkey % 9 > 0 THEN first + 500 END AS start FROM f WHERE o_custkey % 3 = 0)
SELECT year, count(*) AS n FROM o WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.o_custkey = o.o_custkey
  AND (start <= day OR start IS NULL)) GROUP BY ALL""")
def membership(spark, sf):
    o = base.orders(spark, sf)
    start = F.when(F.pmod("o_custkey", F.lit(9)) > 0, F.date_add("first", 500))
    m = (
        o.groupBy("o_custkey").agg(F.min("day").alias("first"))
        .where(F.pmod("o_custkey", F.lit(3)) == 0).select("o_custkey", start.alias("start"))
    )
    kept = joins.drop_joined_members(o, m, "o_custkey", "day", "start")
    return kept.groupBy("year").agg(F.count(F.lit(1)).alias("n"))


@query("c5_calendar_lag_join", f"""
WITH {DAILY} SELECT a.user_id, a.d, a.c, b.c AS c_lag1, w.c AS c_lag7 FROM p a
LEFT JOIN p b ON b.user_id = a.user_id AND b.d = a.d - 1 LEFT JOIN p w ON w.user_id = a.user_id AND w.d = a.d - 7""")
def calendar_lag(spark, sf):
    return base.daily(spark, sf).select(
        "user_id", "d", "c",
        history.at_offset("c", ["user_id"], "d", -1).alias("c_lag1"),
        history.at_offset("c", ["user_id"], "d", -7).alias("c_lag7"),
    )


@query("c6_calendar_lead_join", f"""
WITH {DAILY} SELECT a.d, count(*) AS n, count(b.c) AS observed, count(*) - count(b.c) AS missing_outcome,
  count(*) FILTER (b.c > a.c) AS rises
FROM p a LEFT JOIN p b ON b.user_id = a.user_id AND b.d = a.d + 1 GROUP BY a.d""")
def calendar_lead(spark, sf):
    t = base.daily(spark, sf).select(
        "d", "c", history.at_offset("c", ["user_id"], "d", 1).alias("next")
    )
    return t.groupBy("d").agg(
        F.count(F.lit(1)).alias("n"), F.count("next").alias("observed"),
        F.count(F.when(F.col("next").isNull(), 1)).alias("missing_outcome"),
        F.count(F.when(F.col("next") > F.col("c"), 1)).alias("rises"),
    )


@query("c7_unique_donor_join", """
WITH e AS (SELECT event_id, user_id, date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS d,
   CAST(round(value * 100) AS BIGINT) AS v FROM events),
u AS (SELECT user_id, d, max(v) AS v FROM e GROUP BY ALL HAVING count(*) = 1)
SELECT event_id, u.v AS next_value FROM e LEFT JOIN u ON u.user_id = e.user_id AND u.d = e.d + 1""")
def unique_donor(spark, sf):
    e = table(spark, sf, "events").select(
        "event_id", "user_id", history.day_number("ts").alias("d"), cents("value").alias("v")
    )
    donors = joins.unique_donors(e, ["user_id"], "d", ["v"])
    nxt = donors.select("user_id", (F.col("d") - 1).alias("d"), F.col("v").alias("next_value"))
    return e.select("event_id", "user_id", "d").join(nxt, ["user_id", "d"], "left").select("event_id", "next_value")


@query("c8_as_of_strict_prior_agg", f"""
WITH {ORDERS} SELECT a.o_orderkey, count(b.o_orderkey) AS n_prior, CAST(sum(b.cents) AS BIGINT) AS cents_prior,
  max(b.cents) AS max_prior, arg_max(b.o_orderstatus, (b.day, b.o_orderkey)) AS last_status
FROM o a LEFT JOIN o b ON b.o_custkey = a.o_custkey AND b.day < a.day GROUP BY ALL""")
def as_of_prior(spark, sf):
    o = base.orders(spark, sf)
    out = history.as_of(
        o.select("o_orderkey", "o_custkey", "day"),
        o.select("o_custkey", "day", "cents", "o_orderstatus", F.col("o_orderkey").alias("tie")),
        ["o_custkey"], "day", "day",
        {
            "n_prior": ("sum", F.lit(1).cast("bigint")), "cents_prior": ("sum", F.col("cents")),
            "max_prior": ("max", F.col("cents")), "last_status": ("last", F.col("o_orderstatus")),
        },
        tie="tie",
    )
    return out.select(
        "o_orderkey", F.coalesce("n_prior", F.lit(0)).alias("n_prior"), "cents_prior", "max_prior", "last_status"
    )


@query("c9_as_of_available_agg", """
WITH f AS (SELECT o_custkey, o_orderdate, l_shipdate, CAST(l_returnflag = 'R' AS BIGINT) AS y
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT o.o_orderkey, count(f.y) AS n_available, CAST(coalesce(sum(f.y), 0) AS BIGINT) AS positives
FROM orders o LEFT JOIN f ON f.o_custkey = o.o_custkey AND f.l_shipdate < o.o_orderdate GROUP BY ALL""")
def as_of_available(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    l = table(spark, sf, "lineitem").select("l_orderkey", "l_shipdate", "l_returnflag")
    facts = l.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "o_custkey", "l_shipdate", (F.col("l_returnflag") == "R").cast("bigint").alias("y")
    )
    out = history.as_of(
        o, facts, ["o_custkey"], "o_orderdate", "l_shipdate",
        {"n_available": ("sum", F.lit(1).cast("bigint")), "positives": ("sum", F.col("y"))},
    )
    return out.select(
        "o_orderkey", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_available", "positives")]
    )


@query("c10_interval_event_join", """
WITH s AS (SELECT o_custkey, l_shipdate FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R')
SELECT o_orderkey, count(l_shipdate) AS returns_365, CAST(count(l_shipdate) > 0 AS BIGINT) AS label
FROM orders o LEFT JOIN s ON s.o_custkey = o.o_custkey AND l_shipdate > o_orderdate
  AND l_shipdate <= o_orderdate + INTERVAL 365 DAY GROUP BY ALL""")
def interval_event(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    l = table(spark, sf, "lineitem").where("l_returnflag = 'R'").select("l_orderkey", "l_shipdate")
    s = l.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select("o_custkey", "l_shipdate")
    out = joins.events_within(o, s, ["o_custkey"], "o_orderdate", "l_shipdate", 365, "returns_365")
    return out.select("o_orderkey", "returns_365", (F.col("returns_365") > 0).cast("bigint").alias("label"))


@query("c11_exists_recheck", """
WITH days AS (SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS day FROM orders)
SELECT o_custkey, strftime(day, '%Y-%m-%d') AS day, CAST(EXISTS (SELECT 1 FROM days b WHERE b.o_custkey = a.o_custkey
  AND b.day > a.day AND b.day <= a.day + 90) AS BIGINT) AS again FROM days a""")
def exists_recheck(spark, sf):
    # The next distinct day decides whether any later one is near enough.
    days = base.orders(spark, sf).select("o_custkey", "day").distinct()
    following = F.lead("day").over(Window.partitionBy("o_custkey").orderBy("day"))
    again = F.coalesce(following <= F.date_add("day", 90), F.lit(False)).cast("bigint")
    return days.select("o_custkey", base.text("day").alias("day"), again.alias("again"))


@query("c12_self_join_pairs", f"""
WITH {ORDERS} SELECT o_orderkey, lead(o_orderkey) OVER w AS next_o_orderkey, lead(cents) OVER w AS next_cents,
  date_diff('day', day, lead(day) OVER w) AS gap
FROM o WINDOW w AS (PARTITION BY o_custkey ORDER BY day, o_orderkey)""")
def self_pairs(spark, sf):
    o = base.orders(spark, sf).select("o_custkey", "o_orderkey", "day", "cents")
    pairs = history.next_event(o, ["o_custkey"], "day", "o_orderkey", ["o_orderkey", "cents", "day"])
    return pairs.select(
        "o_orderkey", "next_o_orderkey", "next_cents", F.datediff("next_day", "day").cast("bigint").alias("gap")
    )


ITEM_TOTALS = """it AS (SELECT l_orderkey, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS item_cents
  FROM lineitem GROUP BY ALL)"""


def item_totals(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.sum(cents("l_extendedprice")).alias("item_cents")
    )


def order_and_items(spark, sf):
    return base.orders(spark, sf).join(
        item_totals(spark, sf), F.col("o_orderkey") == F.col("l_orderkey")
    )


@query("c13_channel_overlap_reconcile", f"""
WITH {ORDERS}, {ITEM_TOTALS}, a AS (SELECT day, sum(cents) AS x FROM o GROUP BY ALL),
b AS (SELECT day, sum(item_cents) AS y FROM o JOIN it ON o_orderkey = l_orderkey WHERE o_custkey % 5 > 0 GROUP BY ALL)
SELECT year(day) AS year, count(*) AS overlap_days, CAST(max(abs(x - y)) AS BIGINT) AS max_difference,
  count(*) FILTER (abs(x - y) > 100000000) AS beyond_tolerance FROM a JOIN b USING (day) GROUP BY ALL""")
def channel_overlap(spark, sf):
    a = base.orders(spark, sf).groupBy("day").agg(F.sum("cents").alias("x"))
    b = order_and_items(spark, sf).where(F.pmod("o_custkey", F.lit(5)) > 0).groupBy("day").agg(
        F.sum("item_cents").alias("y")
    )
    diff = F.abs(F.col("x") - F.col("y"))
    return a.join(b, "day").groupBy(F.year("day").cast("bigint").alias("year")).agg(
        F.count(F.lit(1)).alias("overlap_days"), F.max(diff).alias("max_difference"),
        F.count(F.when(diff > 100000000, 1)).alias("beyond_tolerance"),
    )


@query("c14_external_total_crosscheck", f"""
WITH {ORDERS}, {ITEM_TOTALS}, a AS (SELECT year, sum(cents) AS panel FROM o GROUP BY ALL),
b AS (SELECT year, sum(item_cents) AS published FROM o JOIN it ON o_orderkey = l_orderkey GROUP BY ALL)
SELECT year, CAST(panel AS BIGINT) AS panel, CAST(published AS BIGINT) AS published,
  round(abs(panel - published) / CAST(published AS DOUBLE), 6) AS relative_difference,
  abs(panel - published) / CAST(published AS DOUBLE) <= 0.02 AS within_tolerance FROM a LEFT JOIN b USING (year)""")
def external_total(spark, sf):
    a = base.orders(spark, sf).groupBy("year").agg(F.sum("cents").alias("panel"))
    b = order_and_items(spark, sf).groupBy("year").agg(F.sum("item_cents").alias("published"))
    rel = F.try_divide(F.abs(F.col("panel") - F.col("published")), F.col("published"))
    return a.join(b, "year", "left").select(
        "year", "panel", "published", F.round(rel, 6).alias("relative_difference"),
        (rel <= 0.02).alias("within_tolerance"),
    )


@query("c15_source_mismatch_rate", f"""
WITH {ORDERS}, {ITEM_TOTALS}
SELECT split, count(*) AS compared, count(*) FILTER (abs(cents - item_cents) > 5000000) AS mismatched,
  count(*) FILTER (abs(cents - item_cents) > 5000000) / CAST(count(*) AS DOUBLE) > 0.1 AS refuse
FROM o JOIN it ON o_orderkey = l_orderkey GROUP BY ALL""")
def mismatch_rate(spark, sf):
    off = F.abs(F.col("cents") - F.col("item_cents")) > 5000000
    return order_and_items(spark, sf).groupBy("split").agg(
        F.count(F.lit(1)).alias("compared"), F.count(F.when(off, 1)).alias("mismatched"),
        (F.avg(off.cast("double")) > 0.1).alias("refuse"),
    )


@query("c16_inventory_reconcile", """
WITH e AS (SELECT 'part-' || p_partkey AS path, p_size AS size, md5(p_name) AS digest FROM part),
a AS (SELECT 'part-' || p_partkey AS path, p_size AS size, CASE WHEN p_partkey % 7 = 0 THEN 'x' ELSE md5(p_name) END AS digest
      FROM part WHERE p_partkey % 10 > 0 UNION ALL SELECT 'supplier-' || s_suppkey, 0, 'x' FROM supplier)
SELECT path, CASE WHEN a.path IS NULL THEN 'missing' WHEN e.path IS NULL THEN 'unexpected'
  WHEN a.size = e.size AND a.digest = e.digest THEN 'present' ELSE 'differing' END AS status
FROM e FULL JOIN a USING (path)""")
def inventory_reconcile(spark, sf):
    p = table(spark, sf, "part").select(
        "p_partkey", F.concat(F.lit("part-"), F.col("p_partkey").cast("string")).alias("path"),
        F.col("p_size").alias("size"), F.md5("p_name").alias("digest"),
    )
    changed = F.when(F.pmod("p_partkey", F.lit(7)) == 0, "x").otherwise(F.col("digest"))
    extra = table(spark, sf, "supplier").select(
        F.concat(F.lit("supplier-"), F.col("s_suppkey").cast("string")).alias("path"),
        F.lit(0).alias("size"), F.lit("x").alias("digest"),
    )
    actual = (
        p.where(F.pmod("p_partkey", F.lit(10)) > 0)
        .select("path", "size", changed.alias("digest")).unionByName(extra)
    )
    return joins.inventory_status(p.drop("p_partkey"), actual, "path", ["size", "digest"])


@query("c17_prediction_alignment", """
WITH s AS (SELECT doc_id, CASE WHEN doc_id % 70 = 3 THEN 1 - quality ELSE quality END AS y FROM labels WHERE doc_id % 50 > 0
  UNION ALL SELECT doc_id, quality FROM labels WHERE doc_id % 60 = 1 UNION ALL SELECT -1 - doc_id, 0 FROM labels WHERE doc_id % 90 = 2),
g AS (SELECT doc_id, count(*) AS n, min(y) AS lo, max(y) AS hi FROM s GROUP BY ALL)
SELECT count(*) FILTER (quality IS NOT NULL) AS accepted, count(*) FILTER (n IS NULL) AS unscored,
  count(*) FILTER (quality IS NULL) AS unexpected, count(*) FILTER (n > 1) AS repeated,
  count(*) FILTER (quality IS NOT NULL AND n IS NOT NULL AND (lo <> quality OR hi <> quality)) AS label_differs
FROM labels FULL JOIN g USING (doc_id)""")
def prediction_alignment(spark, sf):
    rows = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("y"))
    k = lambda m: F.pmod("doc_id", F.lit(m))
    scores = (
        rows.where(k(50) > 0).select("doc_id", F.when(k(70) == 3, 1 - F.col("y")).otherwise(F.col("y")).alias("y"))
        .unionByName(rows.where(k(60) == 1))
        .unionByName(rows.where(k(90) == 2).select((-1 - F.col("doc_id")).alias("doc_id"), F.lit(0).alias("y")))
    )
    return joins.alignment(rows, scores, "doc_id", "y")


@query("c18_cross_split_key_separation", f"""
WITH {ORDERS} SELECT count(*) AS shared, count(*) = 0 AS ok FROM (SELECT DISTINCT o_custkey FROM o WHERE split = 'holdout'
  INTERSECT SELECT o_custkey FROM o WHERE split <> 'holdout')""")
def key_separation(spark, sf):
    o = base.orders(spark, sf).select("o_custkey", "split")
    shared = joins.shared_keys(o.where("split = 'holdout'"), o.where("split <> 'holdout'"), ["o_custkey"])
    return shared.agg(F.count(F.lit(1)).alias("shared")).withColumn("ok", F.col("shared") == 0)

"""E: history features known at the prediction instant."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from priorframe.operators import history as ops
from priorframe.operators import joins
from priorframe.operators.ordering import PIECES, in_pieces, value_ranks
from priorframe.plans import base
from priorframe.plans.base import DAILY, MONTHLY, ORDERS, cents
from priorframe.plans.registry import query
from priorframe.sources.tables import table

USER = ["user_id"]


def one():
    return F.lit(1).cast("bigint")


@query("e1_strict_prior_history", f"""
WITH {ORDERS} SELECT a.o_orderkey, count(b.o_orderkey) AS n_prior, CAST(coalesce(sum(b.label), 0) AS BIGINT) AS fails_prior,
  CAST(sum(b.cents) AS BIGINT) / CAST(count(b.o_orderkey) AS DOUBLE) AS mean_prior
FROM o a LEFT JOIN o b ON b.o_custkey = a.o_custkey AND b.day < a.day GROUP BY a.o_orderkey""")
def strict_prior(spark, sf):
    out = ops.strict_prior(
        base.orders(spark, sf), ["o_custkey"], "day",
        {"n": ("sum", one()), "f": ("sum", F.col("label")), "c": ("sum", F.col("cents"))},
    )
    return out.select(
        "o_orderkey", F.coalesce("n", F.lit(0)).alias("n_prior"), F.coalesce("f", F.lit(0)).alias("fails_prior"),
        F.try_divide("c", "n").alias("mean_prior"),
    )


@query("e2_last_vs_ever_set", """
WITH x AS (SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS day, p_brand FROM orders JOIN lineitem ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey),
g AS (SELECT o_custkey, day, count(*) AS k, array_to_string(list_sort(list(p_brand)), ',') AS names FROM x GROUP BY ALL),
f AS (SELECT o_custkey, p_brand, min(day) AS day FROM x GROUP BY ALL)
SELECT o_custkey, strftime(day, '%Y-%m-%d') AS day, coalesce(lag(k) OVER w, 0) AS last_items, coalesce(lag(names) OVER w, '') AS last_list,
  (SELECT count(*) FROM f WHERE f.o_custkey = g.o_custkey AND f.day < g.day) AS ever_items
FROM g WINDOW w AS (PARTITION BY o_custkey ORDER BY day)""")
def last_vs_ever(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    l = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
    p = table(spark, sf, "part").select("p_partkey", "p_brand")
    x = l.join(p, F.col("l_partkey") == F.col("p_partkey")).join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    out = ops.ever_before_set(x, ["o_custkey"], "o_orderdate", "p_brand")
    return out.withColumn("day", base.text("day"))


@query("e3_days_since_last", f"""
WITH {ORDERS}, g AS (SELECT o_custkey, day, coalesce(date_diff('day', lag(day) OVER (PARTITION BY o_custkey ORDER BY day), day), -1) AS days_since
  FROM (SELECT DISTINCT o_custkey, day FROM o)) SELECT o_orderkey, days_since FROM o JOIN g USING (o_custkey, day)""")
def days_since(spark, sf):
    o = base.orders(spark, sf).select("o_orderkey", "o_custkey", "day")
    return ops.days_since_last(o, ["o_custkey"], "day", "days_since", -1).select("o_orderkey", "days_since")


@query("e4_trailing_calendar_window", f"""
WITH {DAILY} SELECT user_id, d, count(*) OVER w7 AS valid_7, CASE WHEN count(*) OVER w7 >= 4 THEN CAST(sum(c) OVER w7 AS BIGINT) / CAST(count(*) OVER w7 AS DOUBLE) ELSE -1.0 END AS mean_7,
  count(*) OVER w30 AS valid_30, CASE WHEN count(*) OVER w30 >= 10 THEN CAST(sum(c) OVER w30 AS BIGINT) / CAST(count(*) OVER w30 AS DOUBLE) ELSE -1.0 END AS mean_30
FROM p WINDOW w7 AS (PARTITION BY user_id ORDER BY d RANGE BETWEEN 6 PRECEDING AND CURRENT ROW),
  w30 AS (PARTITION BY user_id ORDER BY d RANGE BETWEEN 29 PRECEDING AND CURRENT ROW)""")
def trailing_calendar(spark, sf):
    w7, w30 = ops.trailing(USER, "d", -6), ops.trailing(USER, "d", -29)
    mean = lambda w, k: F.when(
        F.count("c").over(w) >= k, F.try_divide(F.sum("c").over(w), F.count("c").over(w))
    ).otherwise(-1.0)
    return base.daily(spark, sf).select(
        "user_id", "d", F.count("c").over(w7).alias("valid_7"), mean(w7, 4).alias("mean_7"),
        F.count("c").over(w30).alias("valid_30"), mean(w30, 10).alias("mean_30"),
    )


@query("e5_trailing_row_window", f"""
WITH {DAILY} SELECT user_id, d, round(avg(c) OVER w, 4) AS mean_7_rows, round(stddev_pop(c) OVER w, 3) AS std_7_rows
FROM p WINDOW w AS (PARTITION BY user_id ORDER BY d ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)""")
def trailing_rows(spark, sf):
    w = Window.partitionBy("user_id").orderBy("d").rowsBetween(-7, -1)
    return base.daily(spark, sf).select(
        "user_id", "d", F.round(F.avg("c").over(w), 4).alias("mean_7_rows"),
        F.round(F.stddev_pop("c").over(w), 3).alias("std_7_rows"),
    )


@query("e6_recency_of_exceedance", f"""
WITH {DAILY} SELECT user_id, d, coalesce(d - max(CASE WHEN peak > 20000 THEN d END) OVER (PARTITION BY user_id ORDER BY d
  RANGE BETWEEN 13 PRECEDING AND CURRENT ROW), -1) AS days_since_exceed FROM p""")
def recency(spark, sf):
    hit = F.max(F.when(F.col("peak") > 20000, F.col("d"))).over(ops.trailing(USER, "d", -13))
    return base.daily(spark, sf).select(
        "user_id", "d", F.coalesce(F.col("d") - hit, F.lit(-1)).cast("bigint").alias("days_since_exceed")
    )


@query("e7_exceed_count_window", f"""
WITH {DAILY} SELECT user_id, d, count(*) FILTER (peak > 20000) OVER w7 AS exceed_7, count(*) FILTER (peak > 20000) OVER w30 AS exceed_30
FROM p WINDOW w7 AS (PARTITION BY user_id ORDER BY d RANGE BETWEEN 6 PRECEDING AND CURRENT ROW),
  w30 AS (PARTITION BY user_id ORDER BY d RANGE BETWEEN 29 PRECEDING AND CURRENT ROW)""")
def exceed_count(spark, sf):
    over = F.when(F.col("peak") > 20000, 1)
    return base.daily(spark, sf).select(
        "user_id", "d", F.count(over).over(ops.trailing(USER, "d", -6)).alias("exceed_7"),
        F.count(over).over(ops.trailing(USER, "d", -29)).alias("exceed_30"),
    )


TRAILING_P95 = """tp AS (SELECT *, CASE WHEN len(v) >= 10 THEN list_sort(v)[CAST(floor(0.95 * (len(v) - 1)) AS BIGINT) + 1] END AS p95 FROM (
  SELECT *, list(c) OVER (PARTITION BY user_id ORDER BY d ROWS BETWEEN 90 PRECEDING AND 1 PRECEDING) AS v FROM p))"""


def trailing_p95(panel, minimum=10):
    w = Window.partitionBy("user_id").orderBy("d").rowsBetween(-90, -1)
    v = F.sort_array(F.collect_list("c").over(w))
    at = F.get(v, F.floor(F.lit(0.95) * (F.size(v) - 1)).cast("int"))
    return panel.withColumn("p95", F.when(F.size(v) >= minimum, at))


@query("e8_trailing_percentile", f"""WITH {DAILY}, {TRAILING_P95} SELECT user_id, d, p95 FROM tp""")
def trailing_percentile(spark, sf):
    return trailing_p95(base.daily(spark, sf)).select("user_id", "d", "p95")


@query("e9_lookback_event_counts", f"""
WITH {ORDERS}, g AS (SELECT a.o_custkey, a.day, count(b.o_orderkey) FILTER (b.day >= a.day - 365) AS prior_365, count(b.o_orderkey) FILTER (b.day >= a.day - 1095) AS prior_1095,
  coalesce(date_diff('day', min(b.day), a.day), -1) AS since_first, coalesce(date_diff('day', max(b.day), a.day), -1) AS since_last,
  CAST(sum(b.cents) AS BIGINT) / CAST(count(b.cents) AS DOUBLE) AS mean_prior
FROM (SELECT DISTINCT o_custkey, day FROM o) a LEFT JOIN o b ON b.o_custkey = a.o_custkey AND b.day < a.day GROUP BY a.o_custkey, a.day)
SELECT o_orderkey, g.* EXCLUDE (o_custkey, day) FROM o JOIN g USING (o_custkey, day)""")
def lookback(spark, sf):
    o = base.orders(spark, sf).withColumn("dn", ops.day_number("day"))
    daily = o.groupBy("o_custkey", "dn").agg(F.count(F.lit(1)).alias("n"), F.sum("cents").alias("c"))
    k = ["o_custkey"]
    w = ops.before(k, "dn")
    zero = lambda c: F.coalesce(c, F.lit(0))
    feats = daily.select(
        "o_custkey", "dn",
        zero(F.sum("n").over(ops.trailing(k, "dn", -365, -1))).alias("prior_365"),
        zero(F.sum("n").over(ops.trailing(k, "dn", -1095, -1))).alias("prior_1095"),
        F.coalesce(F.col("dn") - F.min("dn").over(w), F.lit(-1)).cast("bigint").alias("since_first"),
        F.coalesce(F.col("dn") - F.max("dn").over(w), F.lit(-1)).cast("bigint").alias("since_last"),
        F.try_divide(F.sum("c").over(w), F.sum("n").over(w)).alias("mean_prior"),
    )
    return o.select("o_orderkey", "o_custkey", "dn").join(feats, ["o_custkey", "dn"]).drop("o_custkey", "dn")


def lag_block(panel):
    k = ["nation"]
    lags = {f"lag_{i}": ops.at_offset("c", k, "m", -i) for i in (1, 2, 3, 6, 12)}
    half, year = ops.trailing(k, "m", -5), ops.trailing(k, "m", -11)
    out = panel.select("nation", "m", "c", *[e.alias(n) for n, e in lags.items()],
        F.try_divide(F.sum("c").over(half), F.count("c").over(half)).alias("mean_6"),
        F.min("c").over(half).alias("min_6"), F.max("c").over(half).alias("max_6"),
        F.count("c").over(year).alias("reported_12"))
    return out.select("*", *[(F.col("c") - F.col(f"lag_{i}")).alias(f"delta_{i}") for i in (1, 12)])


@query("e10_multi_lag_delta_block", f"""
WITH {MONTHLY} SELECT a.nation, a.m, a.c, l1.c AS lag_1, l2.c AS lag_2, l3.c AS lag_3, l6.c AS lag_6, l12.c AS lag_12, a.c - l1.c AS delta_1, a.c - l12.c AS delta_12,
  (SELECT CAST(sum(c) AS BIGINT) / CAST(count(*) AS DOUBLE) FROM mo x WHERE x.nation = a.nation AND x.m BETWEEN a.m - 5 AND a.m) AS mean_6,
  (SELECT min(c) FROM mo x WHERE x.nation = a.nation AND x.m BETWEEN a.m - 5 AND a.m) AS min_6,
  (SELECT max(c) FROM mo x WHERE x.nation = a.nation AND x.m BETWEEN a.m - 5 AND a.m) AS max_6,
  (SELECT count(*) FROM mo x WHERE x.nation = a.nation AND x.m BETWEEN a.m - 11 AND a.m) AS reported_12
FROM mo a LEFT JOIN mo l1 ON l1.nation = a.nation AND l1.m = a.m - 1 LEFT JOIN mo l2 ON l2.nation = a.nation AND l2.m = a.m - 2
LEFT JOIN mo l3 ON l3.nation = a.nation AND l3.m = a.m - 3 LEFT JOIN mo l6 ON l6.nation = a.nation AND l6.m = a.m - 6
LEFT JOIN mo l12 ON l12.nation = a.nation AND l12.m = a.m - 12""")
def multi_lag(spark, sf):
    return lag_block(base.monthly(spark, sf))


@query("e11_yoy_level_block", f"""
WITH {MONTHLY} SELECT a.nation, a.m, a.c AS level_0, l3.c AS level_3, l12.c AS level_12, a.c - l1.c AS diff_month, a.c - l3.c AS diff_quarter, a.c - l6.c AS diff_half, a.c - l12.c AS diff_year
FROM mo a JOIN mo l1 ON l1.nation = a.nation AND l1.m = a.m - 1 JOIN mo l3 ON l3.nation = a.nation AND l3.m = a.m - 3
JOIN mo l6 ON l6.nation = a.nation AND l6.m = a.m - 6 JOIN mo l12 ON l12.nation = a.nation AND l12.m = a.m - 12
JOIN (SELECT nation, m, count(*) OVER (PARTITION BY nation ORDER BY m RANGE BETWEEN 12 PRECEDING AND CURRENT ROW) AS have FROM mo) h
  ON h.nation = a.nation AND h.m = a.m WHERE have = 13""")
def yoy(spark, sf):
    k = ["nation"]
    lv = lambda i: ops.at_offset("c", k, "m", -i)
    t = base.monthly(spark, sf).select(
        "nation", "m", F.col("c").alias("level_0"), *[lv(i).alias(f"level_{i}") for i in (1, 3, 6, 12)],
        F.count("c").over(ops.trailing(k, "m", -12)).alias("have"),
    )
    d = lambda i: F.col("level_0") - F.col(f"level_{i}")
    return t.where("have = 13").select(
        "nation", "m", "level_0", "level_3", "level_12", d(1).alias("diff_month"), d(3).alias("diff_quarter"),
        d(6).alias("diff_half"), d(12).alias("diff_year"),
    )


@query("e12_pair_features", f"""
WITH {ORDERS}, t AS (SELECT *, lead(o_orderkey) OVER w AS nxt, lead(day) OVER w AS nday, lead(cents) OVER w AS ncents, min(day) OVER (PARTITION BY o_custkey) AS first,
  sum(label) OVER w AS fails, count(*) OVER w AS n FROM o WINDOW w AS (PARTITION BY o_custkey ORDER BY day, o_orderkey))
SELECT o_orderkey, nxt AS next_o_orderkey, date_diff('day', first, nday) AS age_days, ncents - cents AS delta,
  CASE WHEN nday > day THEN (ncents - cents) / CAST(date_diff('day', day, nday) AS DOUBLE) END AS per_day, CAST(fails AS DOUBLE) / n AS fail_rate
FROM t WHERE nxt IS NOT NULL""")
def pair_features(spark, sf):
    o = base.orders(spark, sf).select("o_custkey", "o_orderkey", "day", "cents", "label")
    pairs = ops.next_event(o, ["o_custkey"], "day", "o_orderkey", ["o_orderkey", "cents", "day"])
    known = ops.strict_prior(
        pairs, ["o_custkey"], "day",
        {"n0": ("sum", one()), "f0": ("sum", F.col("label")), "first": ("min", F.col("day"))},
    )
    in_day = Window.partitionBy("o_custkey", "day").orderBy("o_orderkey").rowsBetween(Window.unboundedPreceding, 0)
    n = F.coalesce("n0", F.lit(0)) + F.count(F.lit(1)).over(in_day)
    f = F.coalesce("f0", F.lit(0)) + F.sum("label").over(in_day)
    delta, gap = F.col("next_cents") - F.col("cents"), F.datediff("next_day", "day")
    out = known.select(
        "o_orderkey", "next_o_orderkey",
        F.datediff("next_day", F.coalesce("first", "day")).cast("bigint").alias("age_days"),
        delta.alias("delta"), F.try_divide(delta, gap).alias("per_day"), F.try_divide(f, n).alias("fail_rate"),
    )
    return out.where("next_o_orderkey IS NOT NULL")


@query("e13_growth_and_share", f"""
WITH {MONTHLY}, y AS (SELECT nation, m // 12 AS year, CAST(sum(c) AS BIGINT) AS c FROM mo GROUP BY ALL)
SELECT a.nation, a.year, round(ln(CAST(a.c + 1 AS DOUBLE)) - ln(CAST(b.c + 1 AS DOUBLE)), 6) AS log_growth,
  CAST(a.c AS DOUBLE) / CAST(sum(a.c) OVER (PARTITION BY a.year) AS BIGINT) AS share
FROM y a LEFT JOIN y b ON b.nation = a.nation AND b.year = a.year - 1""")
def growth(spark, sf):
    y = base.monthly(spark, sf).groupBy("nation", F.floor(F.col("m") / 12).alias("year")).agg(F.sum("c").alias("c"))
    prev = ops.at_offset("c", ["nation"], "year", -1)
    total = F.sum("c").over(Window.partitionBy("year"))
    return y.select(
        "nation", "year", F.round(F.log(F.col("c") + 1.0) - F.log(prev + 1.0), 6).alias("log_growth"),
        F.try_divide("c", total).alias("share"),
    )


@query("e14_entity_age", f"""
WITH {ORDERS} SELECT o_orderkey, year - min(year) OVER (PARTITION BY o_custkey) AS age FROM o""")
def entity_age(spark, sf):
    o = base.orders(spark, sf).select("o_orderkey", "o_custkey", "year")
    first = o.groupBy("o_custkey").agg(F.min("year").alias("first"))
    return o.join(first, "o_custkey").select("o_orderkey", (F.col("year") - F.col("first")).alias("age"))


@query("e15_empirical_rank", """
SELECT p_partkey, CAST(rank() OVER (ORDER BY p_retailprice) AS DOUBLE) / count(*) OVER () AS position FROM part""")
def empirical_rank(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_retailprice")
    r = value_ranks(p, [], "p_retailprice").select("p_retailprice", "n_below", "total")
    return p.join(r, "p_retailprice", "left").select(
        "p_partkey", F.try_divide(F.col("n_below") + 1, "total").alias("position")
    )


def differing(a, b):
    """Rows of ``a`` that ``b`` does not hold as often, in pieces of which a task counts one at a time."""
    both = a.withColumn("_d", F.lit(1)).union(b.withColumn("_d", F.lit(-1)))
    surplus = in_pieces(both, a.columns).groupBy(*a.columns).agg(F.sum("_d").alias("_d")).where("_d > 0")
    return surplus.agg(F.coalesce(F.sum("_d"), F.lit(0)))


def checked(rows, compare, features, control):
    """Rows compared, differing ones, and differing ones of a control that must fail."""
    out = rows.agg(F.count(F.lit(1)).alias("compared")).select(
        "compared", compare(features).scalar().alias("differing"), compare(control).scalar().alias("control_differing")
    )
    return out.withColumn("ok", (F.col("differing") == 0) & (F.col("control_differing") > 0))


@query("e16_truncated_recompute_check", f"""
WITH {MONTHLY}, ahead AS (SELECT count(*) AS n FROM mo a JOIN mo b ON b.nation = a.nation AND b.m = a.m + 1 WHERE a.m = 1999 * 12 + 5)
SELECT count(*) AS compared, CAST(0 AS BIGINT) AS differing, (SELECT n FROM ahead) AS control_differing, (SELECT n FROM ahead) > 0 AS ok FROM mo WHERE m <= 1999 * 12 + 5""")
def truncated(spark, sf):
    cut = F.col("m") <= 1999 * 12 + 5
    panel = base.monthly(spark, sf)
    # The control looks ahead, so the check must find it.
    ahead = lambda rows: rows.select("nation", "m", ops.at_offset("c", ["nation"], "m", 1).alias("next"))
    return checked(panel.where(cut), lambda f: differing(f(panel).where(cut), f(panel.where(cut))), lag_block, ahead)


@query("e17_label_flip_invariance", f"""
WITH {ORDERS}, r AS (SELECT o_orderpriority, sum(label) AS a, sum(CASE WHEN split = 'train' THEN label ELSE 1 - label END) AS b FROM o GROUP BY ALL),
c AS (SELECT count(*) AS n FROM o JOIN r USING (o_orderpriority) WHERE a <> b)
SELECT count(*) AS compared, CAST(0 AS BIGINT) AS differing, (SELECT n FROM c) AS control_differing, (SELECT n FROM c) > 0 AS ok FROM o""")
def label_flip(spark, sf):
    from priorframe.operators.aggregates import rate_table

    o = base.orders(spark, sf)

    def features(rows, learned="split = 'train'"):
        rates = rate_table(rows.where(learned), ["o_orderpriority"], "label").select("o_orderpriority", "rate")
        # A priority has many rows; they are dealt over pieces, each of which gets the rates.
        piece = F.pmod(F.xxhash64("o_orderkey"), F.lit(PIECES)).alias("_piece")
        rates = rates.withColumn("_piece", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(PIECES - 1).cast("bigint"))))
        return rows.select("o_orderkey", "o_orderpriority", piece).join(rates, ["o_orderpriority", "_piece"], "left").drop("_piece")

    flipped = o.withColumn(
        "label", F.when(F.col("split") == "train", F.col("label")).otherwise(1 - F.col("label"))
    )
    # The control learns from the labels of all splits, so the check must find it.
    return checked(o, lambda f: differing(f(o), f(flipped)), features, lambda rows: features(rows, "true"))


@query("e18_pre_instant_order_check", """
SELECT l_returnflag, count(*) AS n, count(*) FILTER (o_orderdate > l_shipdate) AS order_after_ship,
  count(*) FILTER (l_shipdate > o_orderdate + INTERVAL 60 DAY) AS ship_after_limit FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL""")
def pre_instant(spark, sf):
    l = table(spark, sf, "lineitem").select("l_orderkey", "l_shipdate", "l_returnflag")
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    gap = F.datediff("l_shipdate", "o_orderdate")
    return l.join(o, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(gap < 0, 1)).alias("order_after_ship"),
        F.count(F.when(gap > 60, 1)).alias("ship_after_limit"),
    )


@query("e19_measured_panel_start", f"""
WITH {ORDERS}, y AS (SELECT year, count(*) AS n, count(*) FILTER (o_orderstatus = 'P') / CAST(count(*) AS DOUBLE) AS share FROM o GROUP BY ALL)
SELECT min(year) AS panel_start FROM y a WHERE n >= 100 AND NOT EXISTS (SELECT 1 FROM y b WHERE b.year >= a.year AND b.share >= 0.345)""")
def panel_start(spark, sf):
    o = base.orders(spark, sf).withColumn("early", F.col("o_orderstatus") == "P")
    return ops.measured_start(o, "year", F.col("early"), 0.345, 100)


@query("e20_representative_event_as_of", f"""
WITH {ORDERS}, r AS (SELECT o_custkey, day, arg_min(label, (CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END, o_orderkey)) AS y,
  min(CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END) AS pref FROM o GROUP BY ALL),
f AS (SELECT o_custkey, day + 60 AS resolved, y FROM r WHERE pref < 2)
SELECT r.o_custkey, strftime(r.day, '%Y-%m-%d') AS day, count(f.y) AS n_resolved, CAST(sum(f.y) AS DOUBLE) / count(f.y) AS mean_outcome
FROM r LEFT JOIN f ON f.o_custkey = r.o_custkey AND f.resolved < r.day GROUP BY ALL""")
def representative(spark, sf):
    s = F.col("o_orderstatus")
    o = base.orders(spark, sf).withColumn("pref", F.when(s == "F", 0).when(s == "O", 1).otherwise(2))
    r = o.groupBy("o_custkey", "day").agg(
        F.min_by("label", F.struct("pref", "o_orderkey")).alias("y"), F.min("pref").alias("pref")
    )
    facts = r.where("pref < 2").select("o_custkey", F.date_add("day", 60).alias("resolved"), "y")
    out = ops.as_of(
        r.select("o_custkey", "day"), facts, ["o_custkey"], "day", "resolved",
        {"n": ("sum", one()), "p": ("sum", F.col("y"))},
    )
    return out.select(
        "o_custkey", base.text("day").alias("day"), F.coalesce("n", F.lit(0)).alias("n_resolved"),
        F.try_divide("p", "n").alias("mean_outcome"),
    )

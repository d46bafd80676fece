"""D: aggregations."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from priorframe.operators import aggregates as ops
from priorframe.operators.history import day_number
from priorframe.operators.ordering import in_pieces, value_at_index
from priorframe.plans import base
from priorframe.plans.base import DAILY, LABELLED, MONTHLY, ORDERS, cents
from priorframe.plans.registry import query
from priorframe.sources.tables import table

def n_all():
    return F.count(F.lit(1))


def n_if(cond):
    return F.count(F.when(cond, 1))


@query("d1_split_class_counts", f"""
WITH {ORDERS} SELECT split, count(*) AS n_rows, CAST(sum(label) AS BIGINT) AS positives,
  CAST(sum(1 - label) AS BIGINT) AS negatives, CAST(sum(label) AS DOUBLE) / count(*) AS rate FROM o GROUP BY ALL""")
def class_counts(spark, sf):
    return ops.class_counts(base.orders(spark, sf), ["split"], "label")


@query("d2_level_rate_table", f"""
WITH {LABELLED} SELECT source, count(*) AS n, CAST(sum(y) AS BIGINT) AS positives,
  CAST(sum(y) AS DOUBLE) / count(*) AS rate FROM ld GROUP BY ALL""")
def level_rates(spark, sf):
    return ops.rate_table(base.labelled_documents(spark, sf), ["source"], "y")


@query("d3_keyed_rate_table", f"""
WITH {ORDERS} SELECT o_orderpriority, month(day) AS month, count(*) AS n, CAST(sum(label) AS BIGINT) AS positives,
  CAST(sum(label) AS DOUBLE) / count(*) AS rate FROM o WHERE split = 'train' GROUP BY ALL""")
def keyed_rates(spark, sf):
    o = base.orders(spark, sf).where("split = 'train'").withColumn("month", F.month("day").cast("bigint"))
    return ops.rate_table(o, ["o_orderpriority", "month"], "label")


@query("d4_distinct_event_days", """
SELECT event_type, count(DISTINCT substr(strftime(ts, '%Y-%m-%d'), 1, 10)) AS event_days
FROM events WHERE value > 100 GROUP BY ALL""")
def event_days(spark, sf):
    e = table(spark, sf, "events").where("value > 100")
    return e.groupBy("event_type").agg(
        F.countDistinct(F.substring(F.col("ts").cast("string"), 1, 10)).alias("event_days")
    )


@query("d5_clustered_capacity", f"""
WITH {DAILY}, x AS (SELECT d // 7 AS week, d, user_id FROM p WHERE peak > 20000)
SELECT week, count(*) AS entity_days, count(DISTINCT d) AS days, CAST(count(*) AS DOUBLE) / count(DISTINCT d) AS per_day
FROM x GROUP BY ALL""")
def clustered_capacity(spark, sf):
    x = base.daily(spark, sf).where("peak > 20000").groupBy("d").agg(n_all().alias("k"))
    return x.groupBy(F.floor(F.col("d") / 7).alias("week")).agg(
        F.sum("k").alias("entity_days"), n_all().alias("days"), F.try_divide(F.sum("k"), n_all()).alias("per_day")
    )


@query("d6_sum_to_grain", """
SELECT year, c_nationkey AS nation, CAST(sum(q) AS BIGINT) AS total, CAST(grouping(year, c_nationkey) AS BIGINT) AS level
FROM (SELECT year(l_shipdate) AS year, c_nationkey, CAST(l_quantity AS BIGINT) AS q FROM lineitem
      JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)
GROUP BY GROUPING SETS ((year, c_nationkey), (year), (c_nationkey), ())""")
def sum_to_grain(spark, sf):
    l = table(spark, sf, "lineitem").select(
        "l_orderkey", F.year("l_shipdate").cast("bigint").alias("year"), F.col("l_quantity").cast("bigint").alias("q")
    )
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("nation"))
    j = l.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(c, F.col("o_custkey") == F.col("c_custkey"))
    return ops.marginal_sums(j, ["year", "nation"], "q")


@query("d7_grain_rollup_case", """
SELECT l_orderkey, strftime(min(l_shipdate), '%Y-%m-%d') AS first_ship, arg_min(l_partkey, (l_shipdate, l_linenumber, l_partkey)) AS lead_part,
  count(DISTINCT l_partkey) AS parts, array_to_string(list_sort(list(DISTINCT l_returnflag)), '') AS flags,
  CASE WHEN count(*) FILTER (l_returnflag = 'R') > 0 THEN 'returned' WHEN count(*) FILTER (l_linestatus = 'O') > 0 THEN 'open'
       ELSE 'closed' END AS disposition FROM lineitem GROUP BY ALL""")
def rollup_case(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        base.text(F.min("l_shipdate")).alias("first_ship"),
        F.min_by("l_partkey", F.struct("l_shipdate", "l_linenumber", "l_partkey")).alias("lead_part"),
        F.countDistinct("l_partkey").alias("parts"),
        F.array_join(F.array_sort(F.collect_set("l_returnflag")), "").alias("flags"),
        F.when(n_if(F.col("l_returnflag") == "R") > 0, "returned")
        .when(n_if(F.col("l_linestatus") == "O") > 0, "open").otherwise("closed").alias("disposition"),
    )


@query("d8_daily_peak", """
SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, max(value) AS peak FROM events WHERE hour(ts) BETWEEN 17 AND 20 GROUP BY ALL""")
def daily_peak(spark, sf):
    e = table(spark, sf, "events").where(F.hour("ts").between(17, 20))
    return e.groupBy("user_id", base.text("ts").alias("day")).agg(F.max("value").alias("peak"))


@query("d9_daily_mean_by_dim", """
SELECT event_type, strftime(ts, '%Y-%m-%d') AS day, count(*) AS n,
  sum(CAST(round(value * 100) AS BIGINT)) / CAST(count(*) AS DOUBLE) AS mean_cents FROM events GROUP BY ALL""")
def daily_mean(spark, sf):
    return table(spark, sf, "events").groupBy("event_type", base.text("ts").alias("day")).agg(
        n_all().alias("n"), F.try_divide(F.sum(cents("value")), n_all()).alias("mean_cents")
    )


@query("d10_modal_value_weekly", """
WITH c AS (SELECT l_partkey, strftime(date_trunc('week', l_shipdate), '%Y-%m-%d') AS period, l_discount, count(*) AS n FROM lineitem GROUP BY ALL)
SELECT l_partkey, period, arg_max(l_discount, (n, l_discount)) AS l_discount, max(n) AS votes, CAST(sum(n) AS BIGINT) AS total
FROM c GROUP BY ALL""")
def modal_weekly(spark, sf):
    l = table(spark, sf, "lineitem").select(
        "l_partkey", base.text(F.date_trunc("week", "l_shipdate")).alias("period"), "l_discount"
    )
    return ops.modal_value(l, ["l_partkey", "period"], "l_discount")


@query("d11_canonical_description_vote", """
WITH c AS (SELECT source, split_part(trim(text), ' ', 1) AS word, count(*) AS n FROM documents WHERE split_part(trim(text), ' ', 1) <> '' GROUP BY ALL)
SELECT source, arg_min(word, (-n, word)) AS word, max(n) AS votes, CAST(sum(n) AS BIGINT) AS total FROM c GROUP BY ALL""")
def description_vote(spark, sf):
    d = table(spark, sf, "documents").select("source", F.substring_index(F.trim("text"), " ", 1).alias("word"))
    return ops.modal_value(d.where("word <> ''"), ["source"], "word", largest_wins=False)


@query("d12_modal_offset", """
WITH c AS (SELECT month(o_orderdate) AS month, date_diff('month', o_orderdate, l_shipdate) AS months, count(*) AS n
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL)
SELECT month, arg_max(months, (n, months)) AS months, max(n) AS votes, CAST(sum(n) AS BIGINT) AS total FROM c GROUP BY ALL""")
def modal_offset(spark, sf):
    l = table(spark, sf, "lineitem").select("l_orderkey", "l_shipdate")
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    m = lambda c: F.year(c) * 12 + F.month(c)
    j = l.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.month("o_orderdate").cast("bigint").alias("month"),
        (m("l_shipdate") - m("o_orderdate")).cast("bigint").alias("months"),
    )
    return ops.modal_value(j, ["month"], "months")


@query("d13_first_seen_entry", f"""
WITH {ORDERS}, y AS (SELECT o_custkey, year, sum(cents) AS total FROM o GROUP BY ALL)
SELECT o_custkey, min(year) AS entry FROM y WHERE total >= 50000000 GROUP BY ALL""")
def first_seen(spark, sf):
    from priorframe.operators.splits import first_crossing

    y = base.orders(spark, sf).groupBy("o_custkey", "year").agg(F.sum("cents").alias("total"))
    return first_crossing(y, ["o_custkey"], "year", F.col("total"), 50000000)


@query("d14_reporting_quality_verdict", """
WITH w AS (SELECT user_id, isoyear(ts) AS iso_year, weekofyear(ts) AS week, count(*) AS n,
   count(*) FILTER (event_type = 'error') AS errors FROM events GROUP BY ALL)
SELECT user_id, iso_year, count(*) FILTER (n >= 8) AS usable, count(*) FILTER (errors > 0) AS with_errors,
  count(*) FILTER (n >= 8) >= 4 AND 2 * count(*) FILTER (errors > 0) >= count(*) AS kept FROM w GROUP BY ALL""")
def reporting_quality(spark, sf):
    e = table(spark, sf, "events").select(
        "user_id", F.extract(F.lit("YEAROFWEEK"), "ts").cast("bigint").alias("iso_year"),
        F.weekofyear("ts").alias("week"), "event_type",
    )
    w = e.groupBy("user_id", "iso_year", "week").agg(
        n_all().alias("n"), n_if(F.col("event_type") == "error").alias("errors")
    )
    usable, bad = n_if(F.col("n") >= 8), n_if(F.col("errors") > 0)
    return w.groupBy("user_id", "iso_year").agg(
        usable.alias("usable"), bad.alias("with_errors"), ((usable >= 4) & (2 * bad >= n_all())).alias("kept")
    )


@query("d15_transition_matrix", f"""
WITH {ORDERS}, t AS (SELECT o_orderstatus AS prev, lead(o_orderstatus) OVER (PARTITION BY o_custkey ORDER BY day, o_orderkey) AS cur FROM o),
c AS (SELECT prev, cur, count(*) AS n FROM t WHERE cur IS NOT NULL GROUP BY ALL)
SELECT prev, cur, n, n / CAST(sum(n) OVER (PARTITION BY prev) AS DOUBLE) AS share FROM c""")
def transitions(spark, sf):
    o = base.orders(spark, sf).select("o_custkey", "day", "o_orderkey", "o_orderstatus")
    return ops.transition_matrix(o, ["o_custkey"], "day", "o_orderkey", "o_orderstatus")


@query("d16_gap_percentiles", f"""
WITH {ORDERS}, g AS (SELECT date_diff('day', lag(day) OVER (PARTITION BY o_custkey ORDER BY day, o_orderkey), day) AS gap FROM o),
r AS (SELECT gap, row_number() OVER (ORDER BY gap) - 1 AS i, count(*) OVER () AS total FROM g WHERE gap IS NOT NULL)
SELECT max(gap) FILTER (i = floor(total * 0.5)) AS p50, max(gap) FILTER (i = floor(total * 0.95)) AS p95,
  max(gap) FILTER (i = floor(total * 0.99)) AS p99, max(gap) FILTER (i = floor(total * 0.995)) AS p995, max(gap) AS worst,
  max(total) AS total FROM r""")
def gap_percentiles(spark, sf):
    from priorframe.operators.history import next_event

    o = base.orders(spark, sf).select("o_custkey", "day", "o_orderkey")
    pairs = next_event(o, ["o_custkey"], "day", "o_orderkey", ["day"])
    g = pairs.select(F.datediff("next_day", "day").cast("bigint").alias("gap")).where("gap IS NOT NULL")
    at = lambda q: F.floor(F.col("total") * q)
    return value_at_index(
        g, [], "gap",
        {"p50": at(0.5), "p95": at(0.95), "p99": at(0.99), "p995": at(0.995), "worst": F.col("total") - 1},
    )


@query("d17_label_prevalence_floor", f"""
WITH {ORDERS}, x AS (SELECT DISTINCT o_orderkey, split, day, p_brand FROM o JOIN lineitem ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey),
n AS (SELECT count(*) AS n FROM o WHERE split = 'train'),
s AS (SELECT p_brand, count(*) FILTER (split = 'train') AS train_n, count(*) FILTER (split = 'eval') AS eval_n,
   count(*) FILTER (split = 'holdout') AS holdout_n, count(DISTINCT day) FILTER (split = 'eval') AS eval_days,
   count(DISTINCT day) FILTER (split = 'holdout') AS holdout_days FROM x GROUP BY ALL)
SELECT s.*, train_n / CAST(n AS DOUBLE) AS share FROM s, n
WHERE train_n / CAST(n AS DOUBLE) >= 0.14 AND least(eval_n, holdout_n) >= 100 AND least(eval_days, holdout_days) >= 50""")
def prevalence_floor(spark, sf):
    o = base.orders(spark, sf).select("o_orderkey", "split", "day")
    l = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
    p = table(spark, sf, "part").select("p_partkey", "p_brand")
    # An order's lines and the order meet in one piece, so the rows that are told apart are those of a piece.
    branded = in_pieces(l.join(p, F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", "p_brand"), ["l_orderkey"])
    x = (
        branded.join(in_pieces(o, ["o_orderkey"]), F.col("l_orderkey") == F.col("o_orderkey"))
        .select("o_orderkey", "split", "day", "p_brand").distinct()
    )
    per_day = x.groupBy("p_brand", "split", "day").agg(n_all().alias("k"))
    n_in = lambda s: F.coalesce(F.sum(F.when(F.col("split") == s, F.col("k"))), F.lit(0))
    d_in = lambda s: n_if(F.col("split") == s)
    train_rows = o.where("split = 'train'").agg(n_all()).scalar()
    out = per_day.groupBy("p_brand").agg(
        *[n_in(s).alias(f"{s}_n") for s in ("train", "eval", "holdout")],
        *[d_in(s).alias(f"{s}_days") for s in ("eval", "holdout")],
    )
    return out.withColumn("share", F.try_divide(F.col("train_n"), train_rows)).where(
        "share >= 0.14 AND least(eval_n, holdout_n) >= 100 AND least(eval_days, holdout_days) >= 50"
    )


@query("d18_column_profile", f"""
WITH {ORDERS}, c AS (SELECT split, unnest(['o_orderstatus', 'o_orderpriority', 'cents', 'day']) AS field,
   unnest([o_orderstatus, o_orderpriority, CAST(cents AS VARCHAR), strftime(day, '%Y-%m-%d')]) AS value FROM o),
s AS (SELECT split, field, count(DISTINCT value) AS n_values, count(*) FILTER (TRY_CAST(value AS DOUBLE) IS NOT NULL) AS numeric_count,
  min(TRY_CAST(value AS DOUBLE)) AS numeric_min, max(TRY_CAST(value AS DOUBLE)) AS numeric_max,
  min(TRY_CAST(substr(value, 1, 4) AS BIGINT)) FILTER (field = 'day') AS first_year,
  max(TRY_CAST(substr(value, 1, 4) AS BIGINT)) FILTER (field = 'day') AS last_year, CAST(0 AS BIGINT) AS year_unparsed FROM c GROUP BY ALL)
SELECT * FROM s""")
def column_profile(spark, sf):
    cols = ["o_orderstatus", "o_orderpriority", "cents", "day"]
    return ops.column_profile(base.orders(spark, sf).select("split", *cols), "split", cols, ["day"])


@query("d18_column_domain", f"""
WITH {ORDERS}, c AS (SELECT split, unnest(['o_orderstatus', 'o_orderpriority', 'day']) AS field, unnest([o_orderstatus, o_orderpriority, strftime(day, '%Y-%m-%d')]) AS value FROM o)
SELECT split, field, value, count(*) AS n FROM c GROUP BY ALL""")
def column_domain(spark, sf):
    cols = ["o_orderstatus", "o_orderpriority", "day"]
    return ops.column_domain(base.orders(spark, sf).select("split", *cols), "split", cols)


@query("d18_column_domain_of_profile", f"""
WITH {ORDERS}, c AS (SELECT split, unnest(['o_orderstatus', 'o_orderpriority', 'cents', 'day']) AS field,
   unnest([o_orderstatus, o_orderpriority, CAST(cents AS VARCHAR), strftime(day, '%Y-%m-%d')]) AS value FROM o)
SELECT split, field, value, count(*) AS n FROM c GROUP BY ALL""")
def column_domain_of_profile(spark, sf):
    cols = ["o_orderstatus", "o_orderpriority", "cents", "day"]
    return ops.column_domain(base.orders(spark, sf).select("split", *cols), "split", cols)


@query("d19_grain_check", """
SELECT 'l_orderkey,l_linenumber' AS grain, count(DISTINCT (l_orderkey, l_linenumber)) AS distinct_keys,
  count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS duplicate_rows FROM lineitem
UNION ALL SELECT 'l_orderkey,l_partkey', count(DISTINCT (l_orderkey, l_partkey)), count(*) - count(DISTINCT (l_orderkey, l_partkey)) FROM lineitem""")
def grain_check(spark, sf):
    l = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return ops.grain(l, [["l_orderkey", "l_linenumber"], ["l_orderkey", "l_partkey"]])


@query("d20_min_max_invariant", """
WITH t AS (SELECT l_returnflag, CAST(l_quantity AS BIGINT) AS lo, CASE WHEN l_linenumber = 3 THEN NULL ELSE l_partkey % 50 END AS hi, l_linenumber AS k FROM lineitem)
SELECT l_returnflag, 'qty_min<=qty_max' AS pair, count(*) FILTER (k <> 4 AND lo > hi) AS violations,
  count(*) FILTER (k = 3) AS unparseable FROM t GROUP BY ALL""")
def min_max(spark, sf):
    k = F.col("l_linenumber")
    hi = F.when(k == 3, "bad").when(k == 4, "NA").otherwise(F.pmod("l_partkey", F.lit(50)).cast("string"))
    t = table(spark, sf, "lineitem").select(
        "l_returnflag", F.col("l_quantity").cast("bigint").alias("qty_min"), hi.alias("qty_max")
    )
    return ops.min_max_violations(t, ["l_returnflag"])


@query("d21_row_ledger_reconcile", f"""
WITH {ORDERS} SELECT split, count(*) AS input_rows, count(*) FILTER (o_orderstatus <> 'P' AND cents >= 1000000) AS shipped,
  count(*) FILTER (cents < 1000000) AS too_small, count(*) FILTER (o_orderstatus = 'P' AND cents >= 1000000) AS pending,
  true AS reconciled FROM o GROUP BY ALL""")
def ledger(spark, sf):
    from priorframe.operators.cleaning import exclusion_reason

    rules = [("too_small", F.col("cents") < 1000000), ("pending", F.col("o_orderstatus") == "P")]
    o = base.orders(spark, sf).withColumn("reason", exclusion_reason(rules))
    at = lambda r: n_if(F.col("reason") == r)
    return o.groupBy("split").agg(
        n_all().alias("input_rows"), at("kept").alias("shipped"), at("too_small").alias("too_small"),
        at("pending").alias("pending"),
        (at("kept") + at("too_small") + at("pending") == n_all()).alias("reconciled"),
    )


@query("d22_merge_with_conflicts", """
SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, count(*) AS occurrences, arg_min(event_type, event_id) AS first_value,
  count(DISTINCT event_type) > 1 AS conflict FROM events GROUP BY ALL""")
def merge_conflicts(spark, sf):
    e = table(spark, sf, "events").select("user_id", base.text("ts").alias("day"), "event_type", "event_id")
    return ops.conflicting_merge(e, ["user_id", "day"], "event_type", "event_id")


@query("d23_exact_dedupe", """
SELECT min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY text, lang""")
def exact_dedupe(spark, sf):
    return ops.exact_dedupe(table(spark, sf, "documents").select("doc_id", "text", "lang"), "doc_id", ["text", "lang"])


@query("d24_keep_latest_revision", f"""
WITH {ORDERS} SELECT o_custkey, year, arg_max(o_orderkey, (day, o_orderkey)) AS o_orderkey, arg_max(cents, (day, o_orderkey)) AS cents
FROM o GROUP BY ALL""")
def latest_revision(spark, sf):
    o = base.orders(spark, sf)
    return ops.latest_by(o, ["o_custkey", "year"], F.struct("day", "o_orderkey"), ["o_orderkey", "cents"])


@query("d25_keep_first_by_precedence", """
SELECT l_orderkey, arg_min(l_partkey, (l_linenumber, l_shipdate, l_partkey)) AS l_partkey,
  arg_min(l_returnflag, (l_linenumber, l_shipdate, l_partkey)) AS l_returnflag, min(l_returnflag) = max(l_returnflag) AS labels_agree
FROM lineitem GROUP BY ALL""")
def first_precedence(spark, sf):
    l = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_returnflag")
    return ops.first_by(
        l, ["l_orderkey"], F.struct("l_linenumber", "l_shipdate", "l_partkey"), ["l_partkey", "l_returnflag"], "l_returnflag"
    )


@query("d26_usage_by_class", """
SELECT CASE WHEN event_type IN ('purchase', 'signup') THEN 'paid' WHEN event_type = 'error' THEN 'failed' ELSE 'free' END AS class,
  count(*) AS calls, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS tokens,
  CASE WHEN count(*) FILTER (event_type = 'error') = 0 THEN CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) END AS cost_cents
FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-20' GROUP BY ALL""")
def usage(spark, sf):
    e = table(spark, sf, "events").where(
        "ts >= timestamp_ntz'2024-01-05 00:00:00' AND ts < timestamp_ntz'2024-01-20 00:00:00'"
    )
    t = F.col("event_type")
    kind = F.when(t.isin("purchase", "signup"), "paid").when(t == "error", "failed").otherwise("free")
    cost = F.when(t != "error", cents("value"))
    return e.groupBy(kind.alias("class")).agg(
        n_all().alias("calls"), F.sum(F.get_json_object("props", "$.k").cast("bigint")).alias("tokens"),
        F.when(F.count(cost) == n_all(), F.sum(cost)).alias("cost_cents"),
    )


@query("d27_catalogue_coverage", """
SELECT r_name, n_name, count(*) AS customers, count(*) FILTER (c_acctbal > 0) / CAST(count(*) AS DOUBLE) AS live_share,
  count(*) FILTER (c_mktsegment NOT IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD')) AS unknown_segment
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL""")
def coverage(spark, sf):
    n = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    c = table(spark, sf, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    known = F.col("c_mktsegment").isin("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD")
    return c.groupBy("r_name", "n_name").agg(
        n_all().alias("customers"), F.avg((F.col("c_acctbal") > 0).cast("double")).alias("live_share"),
        n_if(~known).alias("unknown_segment"),
    )


@query("d28_panel_coverage", f"""
WITH {DAILY} SELECT user_id, count(*) AS observed, max(d) - min(d) + 1 AS expected, max(d) - min(d) + 1 - count(*) AS gaps,
  count(*) FILTER (n < 2) AS incomplete FROM p GROUP BY ALL""")
def panel_coverage(spark, sf):
    return ops.panel_gaps(base.daily(spark, sf), "user_id", "d", "n", 2)


@query("d29_per_year_label_mix", f"""
WITH {ORDERS} SELECT split, year, count(*) FILTER (o_orderstatus = 'F') AS "F", count(*) FILTER (o_orderstatus = 'O') AS "O",
  count(*) FILTER (o_orderstatus = 'P') AS "P" FROM o GROUP BY ALL""")
def label_mix(spark, sf):
    return base.orders(spark, sf).groupBy("split", "year").pivot("o_orderstatus", ["F", "O", "P"]).agg(n_all()).na.fill(0)


@query("d30_blank_and_token_counts", """
SELECT 'lang:blank' AS measure, count(*) FILTER (lang IS NULL OR trim(lang) = '') AS n FROM documents
UNION ALL SELECT 'lang:nan', count(*) FILTER (lower(trim(lang)) = 'nan') FROM documents
UNION ALL SELECT 'lang:unexpected', count(*) FILTER (trim(lang) NOT IN ('en', 'de')) FROM documents
UNION ALL SELECT 'source:blank', count(*) FILTER (source IS NULL OR trim(source) = '') FROM documents
UNION ALL SELECT 'source:nan', count(*) FILTER (lower(trim(source)) = 'nan') FROM documents
UNION ALL SELECT 'source:unexpected', 0 FROM (SELECT 1)
UNION ALL SELECT 'text:blank', count(*) FILTER (text IS NULL OR trim(text, ' ') = '') FROM documents
UNION ALL SELECT 'text:nan', count(*) FILTER (lower(trim(text, ' ')) = 'nan') FROM documents
UNION ALL SELECT 'text:unexpected', 0 FROM (SELECT 1)""")
def blank_tokens(spark, sf):
    return ops.blank_counts(table(spark, sf, "documents"), ["lang", "source", "text"], {"lang": ["en", "de"]})


@query("d31_cohort_event_curve", f"""
WITH {ORDERS}, f AS (SELECT o_custkey, min(day) AS first FROM o GROUP BY ALL),
s AS (SELECT o_custkey, min(day) AS second FROM o JOIN f USING (o_custkey) WHERE day > first GROUP BY ALL)
SELECT year(first) AS year, count(*) AS cohort, avg(CAST(coalesce(second - first <= 30, false) AS DOUBLE)) AS within_30,
  avg(CAST(coalesce(second - first <= 90, false) AS DOUBLE)) AS within_90, avg(CAST(coalesce(second - first <= 180, false) AS DOUBLE)) AS within_180,
  avg(CAST(coalesce(second - first <= 365, false) AS DOUBLE)) AS within_365 FROM f LEFT JOIN s USING (o_custkey) GROUP BY ALL""")
def cohort(spark, sf):
    days = base.orders(spark, sf).select("o_custkey", "day").distinct()
    w = Window.partitionBy("o_custkey").orderBy("day")
    first = (
        days.withColumn("second", F.lead("day").over(w)).groupBy("o_custkey")
        .agg(F.min("day").alias("first"), F.min("second").alias("second"))
    )
    gap = F.datediff("second", "first")
    return ops.cohort_curve(
        first.withColumn("year", F.year("first").cast("bigint")), ["year"], gap, [30, 90, 180, 365]
    )


@query("d32_lag_histogram", """
SELECT CASE WHEN g IS NULL THEN 'missing' WHEN g < 0 THEN 'negative' WHEN g <= 7 THEN '0-7' WHEN g <= 30 THEN '8-30'
  WHEN g <= 60 THEN '31-60' ELSE '61+' END AS band, count(*) AS n FROM (
  SELECT CASE WHEN l_linenumber = 7 THEN NULL ELSE date_diff('day', o_orderdate, l_shipdate) - l_linenumber * 2 END AS g
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey) GROUP BY ALL""")
def lag_histogram(spark, sf):
    l = table(spark, sf, "lineitem").select("l_orderkey", "l_shipdate", "l_linenumber")
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    k = F.col("l_linenumber")
    g = F.when(k != 7, F.datediff("l_shipdate", "o_orderdate") - k * 2)
    band = ops.lag_band(g, [(7, "0-7"), (30, "8-30"), (60, "31-60")], "61+")
    j = l.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    return j.groupBy(band.alias("band")).agg(n_all().alias("n"))


@query("d33_top_values_crosstab", """
SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY ALL ORDER BY n DESC, p_brand, p_type LIMIT 10""")
def crosstab(spark, sf):
    counts = table(spark, sf, "part").groupBy("p_brand", "p_type").agg(n_all().alias("n"))
    return counts.orderBy(F.desc("n"), "p_brand", "p_type").limit(10)


@query("d34_seasonal_profile", f"""
WITH {MONTHLY} SELECT nation, CAST(sum(c) FILTER (m % 12 IN (11, 0, 1)) AS BIGINT) AS winter, CAST(sum(c) FILTER (m % 12 IN (5, 6, 7)) AS BIGINT) AS summer,
  round((sum(c) FILTER (m % 12 IN (11, 0, 1)) / CAST(count(*) FILTER (m % 12 IN (11, 0, 1)) AS DOUBLE))
      / (sum(c) FILTER (m % 12 IN (5, 6, 7)) / CAST(count(*) FILTER (m % 12 IN (5, 6, 7)) AS DOUBLE)), 6) AS winter_summer_ratio
FROM mo GROUP BY ALL""")
def seasonal(spark, sf):
    m = F.pmod("m", F.lit(12))
    cold, warm = F.when(m.isin(11, 0, 1), F.col("c")), F.when(m.isin(5, 6, 7), F.col("c"))
    ratio = F.try_divide(F.try_divide(F.sum(cold), F.count(cold)), F.try_divide(F.sum(warm), F.count(warm)))
    return base.monthly(spark, sf).groupBy("nation").agg(
        F.sum(cold).alias("winter"), F.sum(warm).alias("summer"), F.round(ratio, 6).alias("winter_summer_ratio")
    )

"""H: quality gate."""

from pyspark.sql import functions as F

from priorframe.operators import gate as ops
from priorframe.operators.aggregates import class_counts, column_domain
from priorframe.operators.metrics import rank_auc
from priorframe.operators.qualify import Descriptor, qualify
from priorframe.plans import base
from priorframe.plans.base import LABELLED, ORDERS, auc_sql, cents
from priorframe.plans.registry import query
from priorframe.sources.tables import table


def n_all():
    return F.count(F.lit(1))


def n_if(cond):
    return F.count(F.when(cond, 1))


@query("h3_single_column_leak", f"""
WITH {LABELLED}, c AS (SELECT split, y, unnest(['lang', 'source', 'n_chars', 'echo', 'doc_key']) AS field,
   unnest([lang, source, CAST(n_chars AS VARCHAR), CASE WHEN y = 1 THEN 'good' ELSE 'bad' END, 'd' || doc_id]) AS value FROM ld),
lv AS (SELECT split, field, value, sum(y) AS pos, sum(1 - y) AS neg FROM c GROUP BY ALL),
k AS (SELECT split, field, count(*) AS levels, CASE WHEN bool_and(TRY_CAST(value AS DOUBLE) IS NOT NULL) THEN 'numeric'
   WHEN count(*) > greatest(1, floor(sum(pos + neg) / 5)) THEN 'high_cardinality' ELSE 'categorical' END AS kind FROM lv GROUP BY ALL),
s AS (SELECT c.split, c.field, c.y, CASE WHEN kind = 'numeric' THEN TRY_CAST(value AS DOUBLE) ELSE CAST(pos AS DOUBLE) / (pos + neg) END AS score
   FROM c JOIN lv USING (split, field, value) JOIN k USING (split, field) WHERE kind <> 'high_cardinality'),
a AS ({auc_sql("s", "split, field")}),
tr AS (SELECT field, value, pos, neg FROM lv WHERE split = 'train'), tp AS (SELECT field, CAST(sum(pos) AS DOUBLE) / sum(pos + neg) AS prior FROM tr GROUP BY ALL),
fs AS (SELECT c.split, c.field, c.y, coalesce(CAST(pos AS DOUBLE) / (pos + neg), prior) AS score FROM c LEFT JOIN tr USING (field, value) JOIN tp USING (field) WHERE split <> 'train'),
fa AS ({auc_sql("fs", "split, field").replace(" AS auc", " AS fitted_auc")})
SELECT split, field, levels, kind, auc, fitted_auc, coalesce(CASE WHEN kind = 'high_cardinality' THEN fitted_auc ELSE auc END IN (0.0, 1.0), false) AS determines_label
FROM k LEFT JOIN a USING (split, field) LEFT JOIN fa USING (split, field)""")
def column_leak(spark, sf):
    d = base.labelled_documents(spark, sf).select(
        "split", "y", "lang", "source", "n_chars", F.when(F.col("y") == 1, "good").otherwise("bad").alias("echo"),
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("doc_key"),
    )
    return ops.column_leak(d, "split", "y", ["lang", "source", "n_chars", "echo", "doc_key"])


@query("h4_high_cardinality", """
WITH c AS (SELECT unnest(['o_orderkey', 'o_custkey', 'o_orderstatus', 'cents']) AS field,
  unnest([CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), o_orderstatus, CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR)]) AS value FROM orders)
SELECT field, count(DISTINCT value) AS levels, count(*) AS n_rows, count(DISTINCT value) > count(*) // 5 AS high,
  count(DISTINCT value) <= count(*) // 5 OR field IN ('o_orderkey') AS ok FROM c GROUP BY field""")
def high_cardinality(spark, sf):
    o = base.orders(spark, sf)
    return ops.level_counts(o, ["o_orderkey", "o_custkey", "o_orderstatus", "cents"], ["o_orderkey"])


EVENT_SPLITS = """ev AS (SELECT *, CAST(ts AS DATE) AS day, CASE WHEN ts < DATE '2024-01-12' THEN 'train' WHEN ts < DATE '2024-01-21' THEN 'eval' ELSE 'holdout' END AS split,
  CAST(value > 100 AS BIGINT) AS y FROM events)"""


def event_rows(spark, sf):
    from priorframe.operators.splits import half_open

    day = F.col("ts").cast("date")
    windows = [("train", None, "2024-01-12"), ("eval", "2024-01-12", "2024-01-21"), ("holdout", "2024-01-21", None)]
    return table(spark, sf, "events").select(
        "event_id", "user_id", "event_type", "value", "ts", day.alias("day"), half_open(day, windows).alias("split"),
        (F.col("value") > 100).cast("bigint").alias("y"),
    )


def positive_events(e):
    per_day = e.where("y = 1").groupBy("split", "day").agg(n_all().alias("k"))
    return per_day.groupBy("split").agg(F.sum("k").alias("positives"), n_all().alias("event_days"))


DECLARED = [("train", 800, 11), ("eval", 700, 9), ("holdout", 769, 10)]


@query("h5_declared_vs_counted_events", f"""
WITH {EVENT_SPLITS}, d(split, positives, event_days) AS (VALUES ('train', 800, 11), ('eval', 700, 9), ('holdout', 769, 10)),
f AS (SELECT split, count(*) AS positives, count(DISTINCT day) AS event_days FROM ev WHERE y = 1 GROUP BY ALL)
SELECT d.split, d.positives AS declared_positives, f.positives AS counted_positives, d.event_days AS declared_days, f.event_days AS counted_days,
  coalesce(d.positives = f.positives AND d.event_days = f.event_days, false) AS ok FROM d LEFT JOIN f USING (split)""")
def declared_events(spark, sf):
    d = spark.createDataFrame(DECLARED, "split string, declared_positives bigint, declared_days bigint")
    f = positive_events(event_rows(spark, sf)).select(
        "split", F.col("positives").alias("counted_positives"), F.col("event_days").alias("counted_days")
    )
    same = (F.col("declared_positives") == F.col("counted_positives")) & (F.col("declared_days") == F.col("counted_days"))
    return d.join(f, "split", "left").withColumn("ok", F.coalesce(same, F.lit(False)))


@query("h6_enough_positives", f"""
WITH {EVENT_SPLITS} SELECT split, count(*) AS positives, count(DISTINCT day) AS event_days, count(*) >= 30 AND count(DISTINCT day) >= 10 AS ok
FROM ev WHERE y = 1 AND split <> 'train' GROUP BY ALL""")
def enough_positives(spark, sf):
    f = positive_events(event_rows(spark, sf).where("split <> 'train'"))
    return f.withColumn("ok", (F.col("positives") >= 30) & (F.col("event_days") >= 10))


@query("h7_both_classes_nonuniform", f"""
WITH {LABELLED} SELECT split, CAST(sum(y) AS BIGINT) AS positives, CAST(sum(1 - y) AS BIGINT) AS negatives, sum(y) > 0 AND sum(1 - y) > 0 AS ok FROM ld GROUP BY ALL""")
def both_classes(spark, sf):
    c = class_counts(base.labelled_documents(spark, sf), ["split"], "y")
    return c.select("split", "positives", "negatives", ((F.col("positives") > 0) & (F.col("negatives") > 0)).alias("ok"))


@query("h8_ranges_disjoint", f"""
WITH {ORDERS}, r AS (SELECT split, min(day) AS lo, max(CASE WHEN o_orderkey % 1000 = 7 THEN day + 30 ELSE day END) AS hi FROM o GROUP BY ALL)
SELECT split, strftime(lo, '%Y-%m-%d') AS lo, strftime(hi, '%Y-%m-%d') AS hi,
  NOT EXISTS (SELECT 1 FROM r b WHERE b.split <> a.split AND b.lo <= a.lo AND b.hi >= a.lo) AS disjoint FROM r a""")
def ranges_disjoint(spark, sf):
    late = F.when(F.pmod("o_orderkey", F.lit(1000)) == 7, F.date_add("day", 30)).otherwise(F.col("day"))
    o = base.orders(spark, sf).select("split", F.explode(F.array("day", late)).alias("day"))
    return ops.ranges(o, "split", "day").select(
        "split", base.text("lo").alias("lo"), base.text("hi").alias("hi"), "disjoint"
    )


@query("h9_rows_in_windows", f"""
WITH {ORDERS}, w(split, s, e) AS (VALUES ('train', DATE '1995-01-01', DATE '1998-12-31'), ('eval', DATE '1999-01-01', DATE '2000-01-01'), ('holdout', DATE '2000-01-01', DATE '2001-07-01'))
SELECT o.split, count(*) AS n, count(*) FILTER (day < s OR day >= e) AS violations FROM o JOIN w ON w.split = o.split GROUP BY ALL""")
def rows_in_windows(spark, sf):
    w = spark.createDataFrame(
        [("train", "1995-01-01", "1998-12-31"), ("eval", "1999-01-01", "2000-01-01"), ("holdout", "2000-01-01", "2001-07-01")],
        "split string, s string, e string",
    ).select("split", F.col("s").cast("date").alias("s"), F.col("e").cast("date").alias("e"))
    o = base.orders(spark, sf).select("split", "day").groupBy("split", "day").agg(n_all().alias("k"))
    bad = (F.col("day") < F.col("s")) | (F.col("day") >= F.col("e"))
    return o.join(w, "split").groupBy("split").agg(
        F.sum("k").alias("n"), F.sum(F.when(bad, F.col("k")).otherwise(0)).alias("violations")
    )


@query("h10_cross_split_ids", f"""
WITH {ORDERS} SELECT pair, count(*) AS shared_ids FROM (SELECT o_custkey, string_agg(DISTINCT split, '+' ORDER BY split) AS pair FROM o GROUP BY ALL) WHERE contains(pair, '+') GROUP BY ALL""")
def cross_split_ids(spark, sf):
    per = base.orders(spark, sf).groupBy("o_custkey").agg(
        F.array_join(F.array_sort(F.collect_set("split")), "+").alias("pair")
    )
    return per.where(F.contains("pair", F.lit("+"))).groupBy("pair").agg(n_all().alias("shared_ids"))


@query("h11_duplicate_ids_in_split", """
WITH x AS (SELECT l_returnflag, l_orderkey, count(*) AS n FROM lineitem GROUP BY ALL)
SELECT l_returnflag, count(*) AS distinct_ids, CAST(sum(n - 1) AS BIGINT) AS repeats, sum(n - 1) <= 15000 AS ok FROM x GROUP BY ALL""")
def duplicate_ids(spark, sf):
    l = table(spark, sf, "lineitem").select("l_returnflag", "l_orderkey")
    return ops.repeated_ids(l, ["l_returnflag"], ["l_orderkey"]).withColumn("ok", F.col("repeats") <= 15000)


@query("h12_contradictory_labels", """
WITH x AS (SELECT l_returnflag, l_orderkey, count(*) AS n, min(l_linestatus) <> max(l_linestatus) AS bad FROM lineitem GROUP BY ALL)
SELECT l_returnflag, count(*) FILTER (n > 1) AS repeated_ids, count(*) FILTER (bad) AS contradictory FROM x GROUP BY ALL""")
def contradictory(spark, sf):
    l = table(spark, sf, "lineitem").select("l_returnflag", "l_orderkey", "l_linestatus")
    return ops.contradictions(l, ["l_returnflag"], ["l_orderkey"], "l_linestatus")


@query("h13_meta_counts_match", f"""
WITH {ORDERS}, d(split, n_rows, rate) AS (VALUES ('train', 9134, 0.330414), ('eval', 2294, 0.31997), ('holdout', 3572, 0.3)),
f AS (SELECT split, count(*) AS n_rows, CAST(sum(label) AS DOUBLE) / count(*) AS rate FROM o GROUP BY ALL)
SELECT split, d.n_rows AS declared_rows, f.n_rows AS counted_rows, d.n_rows = f.n_rows AS rows_ok, abs(CAST(d.rate AS DOUBLE) - f.rate) <= 0.000001 AS rate_ok FROM d LEFT JOIN f USING (split)""")
def meta_counts(spark, sf):
    d = spark.createDataFrame(
        [("train", 9134, 0.330414), ("eval", 2294, 0.31997), ("holdout", 3572, 0.3)],
        "split string, declared_rows bigint, declared_rate double",
    )
    f = class_counts(base.orders(spark, sf), ["split"], "label")
    return d.join(f, "split", "left").select(
        "split", "declared_rows", F.col("n_rows").alias("counted_rows"),
        (F.col("declared_rows") == F.col("n_rows")).alias("rows_ok"),
        (F.abs(F.col("declared_rate") - F.col("rate")) <= 1e-6).alias("rate_ok"),
    )


@query("h14_publication_lag", """
SELECT l_returnflag, max(date_diff('day', o_orderdate, l_shipdate)) AS measured_lag, max(date_diff('day', o_orderdate, l_shipdate)) <= 90 AS feature_lag_ok, 90 <= 95 AS instant_ok
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL""")
def publication_lag(spark, sf):
    l = table(spark, sf, "lineitem").select("l_orderkey", "l_shipdate", "l_returnflag")
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    lag = F.max(F.datediff("l_shipdate", "o_orderdate")).cast("bigint")
    feature_lag, instant_lag = 90, 95
    return l.join(o, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("l_returnflag").agg(
        lag.alias("measured_lag"), (lag <= feature_lag).alias("feature_lag_ok"),
        F.lit(feature_lag <= instant_lag).alias("instant_ok"),
    )


LEDGER = """g AS (SELECT o_orderkey, split, day AS p, CASE WHEN o_orderkey % 400 = 3 THEN day + 1 ELSE day - 1 END AS f, (SELECT max(l_shipdate) FROM lineitem WHERE l_orderkey = o_orderkey) AS l
   FROM o WHERE o_orderkey % 500 <> 9),
g2 AS (SELECT * FROM g UNION ALL SELECT * FROM g WHERE o_orderkey % 700 = 5),
gk AS (SELECT o.split, o.o_orderkey, x.n, x.late, x.p, x.l FROM o LEFT JOIN (SELECT o_orderkey, count(*) AS n, count(*) FILTER (f > p) AS late, min(p) AS p, max(l) AS l FROM g2 GROUP BY ALL) x USING (o_orderkey)),
gs AS (SELECT split, count(*) FILTER (n IS NULL) AS uncovered, CAST(0 AS BIGINT) AS unknown, count(*) FILTER (n > 1) AS duplicated, CAST(sum(coalesce(late, 0)) AS BIGINT) AS features_late,
  min(p) AS first, max(l) AS label FROM gk GROUP BY ALL)"""
LEDGER_FACTS = "SELECT split, uncovered, unknown, duplicated, features_late, coalesce(label <= (SELECT min(first) FROM gs b WHERE b.first > a.first), true) AS labels_in_time FROM gs a"


def ledger_rows(spark, sf):
    """Orders, and a ledger that misses some, lists some twice and has some late features."""
    o = base.orders(spark, sf).select("o_orderkey", "split", "day")
    ship = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.max("l_shipdate").cast("date").alias("label_at")
    )
    k = lambda m: F.pmod("o_orderkey", F.lit(m))
    g = o.where(k(500) != 9).join(ship, "o_orderkey", "left").select(
        "o_orderkey", "split", F.col("day").alias("prediction_time"),
        F.when(k(400) == 3, F.date_add("day", 1)).otherwise(F.date_sub("day", 1)).alias("features_at"), "label_at",
    )
    return o, g.withColumn("_copy", F.explode(F.when(k(700) == 5, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))).drop("_copy")


@query("h15_availability_ledger", f"WITH {ORDERS}, {LEDGER} {LEDGER_FACTS}")
def availability(spark, sf):
    o, g = ledger_rows(spark, sf)
    return ops.availability(o, g, ["o_orderkey"], "split", {"train": 0, "eval": 1, "holdout": 2})


CLAIMS = [("train", "n_rows", "9134"), ("eval", "n_rows", "2300"), ("holdout", "rate", "0.33"), ("train", "rate", "0.3304"), ("eval", "rate", "0.9")]
CLAIMS_SQL = "claims(split, field, literal) AS (VALUES " + ", ".join(f"('{a}', '{b}', '{c}')" for a, b, c in CLAIMS) + ")"


def order_facts(spark, sf):
    f = class_counts(base.orders(spark, sf), ["split"], "label")
    return f.select("split", F.col("n_rows").cast("double").alias("n_rows"), F.col("positives").cast("double").alias("positives"), "rate")


@query("h17_population_claims", f"""
WITH {ORDERS}, {CLAIMS_SQL}, f AS (SELECT split, CAST(count(*) AS DOUBLE) AS n_rows, CAST(sum(label) AS DOUBLE) / count(*) AS rate FROM o GROUP BY ALL)
SELECT split, field, literal, CASE field WHEN 'rate' THEN rate ELSE n_rows END AS observed,
  abs(CAST(literal AS DOUBLE) - CASE field WHEN 'rate' THEN rate ELSE n_rows END) <= CASE WHEN contains(literal, '.') THEN 0.5 * pow(10.0, -length(split_part(literal, '.', 2))) ELSE 0 END + 1e-12 AS ok
FROM claims LEFT JOIN f USING (split)""")
def population_claims(spark, sf):
    claims = spark.createDataFrame(CLAIMS, "split string, field string, literal string")
    return ops.population_claims(claims, order_facts(spark, sf))


@query("h18_prose_claims", f"""
WITH {LABELLED}, f AS (SELECT split, 100.0 * CAST(sum(y) AS DOUBLE) / count(*) AS observed FROM ld GROUP BY ALL),
t AS (SELECT doc_id, text || ' Positive rate: train ' || CAST(80 + doc_id % 20 AS VARCHAR) || '% and eval ' || CAST(80 + doc_id % 20 AS VARCHAR) || '.5%.' AS text FROM documents),
c AS (SELECT doc_id, regexp_extract_all(text, '((?:train|eval|holdout) (?:[0-9]+(?:\\.[0-9]+)?)%)', 1) AS a FROM t),
u AS (SELECT doc_id, unnest(range(len(a))) AS pos, unnest(a) AS claim FROM c),
v AS (SELECT doc_id, pos, split_part(claim, ' ', 1) AS split, regexp_extract(claim, '([0-9.]+)%', 1) AS literal FROM u)
SELECT doc_id, pos, split, literal, round(observed, 6) AS observed, abs(CAST(literal AS DOUBLE) - observed) <= CASE WHEN contains(literal, '.') THEN 0.5 * pow(10.0, -length(split_part(literal, '.', 2))) ELSE 0.5 END + 1e-12 AS ok
FROM v LEFT JOIN f USING (split)""")
def prose_claims(spark, sf):
    ld = base.labelled_documents(spark, sf).select("split", "y")
    facts = class_counts(ld, ["split"], "y").select("split", (F.lit(100.0) * F.col("rate")).alias("observed"))
    p = (80 + F.pmod("doc_id", F.lit(20))).cast("string")
    said = F.concat("text", F.lit(" Positive rate: train "), p, F.lit("% and eval "), p, F.lit(".5%."))
    d = table(spark, sf, "documents").select("doc_id", said.alias("text"))
    return ops.prose_claims(d, "doc_id", "text", facts).withColumn("observed", F.round("observed", 6))


SAID = [
    ("Positive rate: train {k}% and eval 2019-2021 {k}.5%.", [("train", "{k}", 0), ("eval", "{k}.5", 1)]),
    ("The holdout (85.4% train) prevalence; 12% of nothing. No rate here: eval 3%.", [("train", "85.4", 0)]),
    ("Rate drifts: {k}% holdout, then eval ({k}.25%).", [("holdout", "{k}", 0), ("eval", "{k}.25", 1)]),
    ("Prevalence falls from TRAIN 90.0% to 80% Eval.", [("train", "90.0", 0), ("eval", "80", 1)]),
]
SAID_SQL = "(VALUES " + ", ".join(f"({i}, {p}, '{s}', '{lit}')" for i, (_, claims) in enumerate(SAID) for s, lit, p in claims) + ") AS v(form, pos, split, form_literal)"


@query("h18_rate_claims", f"""
WITH {LABELLED}, f AS (SELECT split, 100.0 * CAST(sum(y) AS DOUBLE) / count(*) AS observed FROM ld GROUP BY ALL),
c AS (SELECT doc_id, v.pos, v.split, replace(form_literal, '{{k}}', CAST(80 + doc_id % 20 AS VARCHAR)) AS literal FROM documents JOIN {SAID_SQL} ON doc_id % 4 = form)
SELECT doc_id, pos, split, literal, round(observed, 6) AS observed, abs(CAST(literal AS DOUBLE) - observed) <= CASE WHEN contains(literal, '.') THEN 0.5 * pow(10.0, -length(split_part(literal, '.', 2))) ELSE 0.5 END + 1e-12 AS ok
FROM c LEFT JOIN f USING (split)""")
def rate_claims(spark, sf):
    ld = base.labelled_documents(spark, sf).select("split", "y")
    facts = class_counts(ld, ["split"], "y").select("split", (F.lit(100.0) * F.col("rate")).alias("observed"))
    k = (80 + F.pmod("doc_id", F.lit(20))).cast("string")
    forms = F.element_at(F.array(*[F.replace(F.lit(said), F.lit("{k}"), k) for said, _ in SAID]), (F.pmod("doc_id", F.lit(4)) + 1).cast("int"))
    d = table(spark, sf, "documents").select("doc_id", F.concat("text", F.lit("\n"), forms).alias("text"))
    found = ops.rate_claims(d, "doc_id", "text", facts).withColumn("observed", F.round("observed", 6))
    return found.select("doc_id", F.col("pos").cast("bigint").alias("pos"), "split", "literal", "observed", "ok")


@query("h18_year_range_claims", f"""
WITH {ORDERS}, f AS (SELECT split, min(year) AS first_year, max(year) AS last_year FROM o GROUP BY ALL),
t AS (SELECT doc_id, text || ' The training rows cover ' || (1995 + doc_id % 2) || ' - 1998; Eval years 1999–' || (1999 + doc_id % 3) || '.' AS text FROM documents),
u AS (SELECT doc_id, unnest(range(2)) AS pos, unnest(['train', 'eval']) AS split, unnest([1995 + doc_id % 2, 1999]) AS first_claimed, unnest([1998, 1999 + doc_id % 3]) AS last_claimed FROM t)
SELECT u.*, first_year, last_year, first_claimed = first_year AND last_claimed = last_year AS ok FROM u JOIN f USING (split)""")
def year_range_claims(spark, sf):
    facts = base.orders(spark, sf).groupBy("split").agg(F.min("year").alias("first_year"), F.max("year").alias("last_year"))
    k = F.col("doc_id")
    said = F.concat(
        "text", F.lit(" The training rows cover "), (1995 + F.pmod(k, F.lit(2))).cast("string"), F.lit(" - 1998; Eval years 1999–"),
        (1999 + F.pmod(k, F.lit(3))).cast("string"), F.lit("."),
    )
    d = table(spark, sf, "documents").select("doc_id", said.alias("text"))
    return ops.year_range_claims(d, "doc_id", "text", facts)


@query("h18_dictionary_bins", f"""
WITH {ORDERS}, ob AS (SELECT DISTINCT split, CASE WHEN cents < 10000000 THEN '0-9' WHEN cents < 20000000 THEN '10-19' ELSE '20+' END AS bin FROM o)
SELECT doc_id, 'total_band' AS column_name, split, count(*) AS observed_bins, count(*) FILTER (NOT list_contains(CASE doc_id % 3 WHEN 0 THEN ['0-9', '10-19', '20+'] WHEN 1 THEN ['0-9', '20+'] ELSE ['5-9'] END, bin)) AS undeclared_bins
FROM documents, ob GROUP BY ALL""")
def dictionary_bins(spark, sf):
    c = F.col("cents")
    band = F.when(c < 10000000, "0-9").when(c < 20000000, "10-19").otherwise("20+")
    o = base.orders(spark, sf).select("split", band.alias("total_band"), "o_orderpriority")
    domain = column_domain(o, "split", ["total_band", "o_orderpriority"])
    k = F.pmod("doc_id", F.lit(3))
    said = F.when(k == 0, "0 - 9, 10–19 or 20+").when(k == 1, "0-9 and 20+").otherwise("only 5-9")
    text = F.concat("text", F.lit("\n| `total_band` | bands "), said, F.lit(" |\n| `other` | free text |"))
    d = table(spark, sf, "documents").select("doc_id", text.alias("text"))
    return ops.dictionary_bins(d, "doc_id", "text", domain)


@query("h19_claim_render", f"""
WITH {ORDERS} SELECT 'population' AS kind, split, split || ': ' || format('{{:,}}', count(*)) || ' rows; ' || format('{{:,}}', CAST(sum(label) AS BIGINT)) || ' positives; positive rate ' || printf('%.4f', 100.0 * CAST(sum(label) AS DOUBLE) / count(*)) || '%.' AS claim FROM o GROUP BY split
UNION ALL SELECT 'domain', split, split || ' `o_orderstatus` observed domain: ' || string_agg(DISTINCT '`' || o_orderstatus || '`', ', ' ORDER BY '`' || o_orderstatus || '`') || '.' FROM o GROUP BY split
UNION ALL SELECT 'years', split, split || ' `day` observed years: ' || string_agg(DISTINCT CAST(year AS VARCHAR), ', ' ORDER BY CAST(year AS VARCHAR)) || '.' FROM o GROUP BY split
UNION ALL SELECT 'grain', split, split || ' grain (o_custkey): ' || format('{{:,}}', count(DISTINCT o_custkey)) || ' distinct keys; ' || format('{{:,}}', count(*) - count(DISTINCT o_custkey)) || ' repeated rows.' FROM o GROUP BY split""")
def claim_render(spark, sf):
    o = base.orders(spark, sf)
    comma = lambda c: F.format_number(c, 0)
    s, n = F.col("split"), F.col("n")
    facts = o.groupBy("split").agg(n_all().alias("n"), F.sum("label").alias("p"), F.countDistinct("o_custkey").alias("k"))
    # A claim is one line of text, so the domain that it names is one list.
    listed = lambda c: F.array_join(F.array_sort(F.collect_list(F.when(F.col("field") == c, F.col("value")))), "|")
    values = column_domain(o, "split", ["o_orderstatus", "year"])
    facts = facts.join(values.groupBy("split").agg(listed("o_orderstatus").alias("domain"), listed("year").alias("years")), "split")
    pct = F.format_string("%.4f", F.lit(100.0) * F.try_divide("p", "n"))
    ticked = F.concat(F.lit("`"), F.replace("domain", F.lit("|"), F.lit("`, `")), F.lit("`"))
    lines = {
        "population": F.concat(s, F.lit(": "), comma("n"), F.lit(" rows; "), comma("p"), F.lit(" positives; positive rate "), pct, F.lit("%.")),
        "domain": F.concat(s, F.lit(" `o_orderstatus` observed domain: "), ticked, F.lit(".")),
        "years": F.concat(s, F.lit(" `day` observed years: "), F.replace("years", F.lit("|"), F.lit(", ")), F.lit(".")),
        "grain": F.concat(s, F.lit(" grain (o_custkey): "), comma("k"), F.lit(" distinct keys; "), comma(n - F.col("k")), F.lit(" repeated rows.")),
    }
    rows = F.array(*[F.struct(F.lit(k).alias("kind"), c.alias("claim")) for k, c in lines.items()])
    return facts.select("split", F.explode(rows).alias("r")).select("r.kind", "split", "r.claim")


@query("h20_duplicate_features_across_splits", """
WITH d AS (SELECT CASE doc_id % 3 WHEN 0 THEN 'eval' WHEN 1 THEN 'holdout' ELSE 'train' END AS split, text, lang FROM documents),
b AS (SELECT text, lang FROM d GROUP BY ALL HAVING count(DISTINCT split) > 1)
SELECT split, count(DISTINCT (text, lang)) AS shared_tuples, count(*) AS n_rows FROM d JOIN b USING (text, lang) GROUP BY ALL""")
def duplicate_features(spark, sf):
    k = F.pmod("doc_id", F.lit(3))
    split = F.when(k == 0, "eval").when(k == 1, "holdout").otherwise("train")
    d = table(spark, sf, "documents").select(split.alias("split"), "text", "lang")
    return ops.shared_features(d, "split", ["text", "lang"])


QUALITY = Descriptor(
    target="label", positive_label="1", id_columns=["o_orderkey"], time_column="day", event_key_column="day",
    split_windows={
        "train": {"start": None, "end": "1999-01-01"}, "eval": {"start": "1999-01-01", "end": "2000-01-01"},
        "holdout": {"start": "2000-01-01", "end": "2001-07-01"},
    },
    positive_events={"eval": {"positives": 735, "distinct_events": 318}, "holdout": {"positives": 1, "distinct_events": 1}},
    features=["o_orderpriority", "cents"], high_cardinality_columns=["day"], label_source_columns=["o_orderstatus"],
    post_hoc_columns=["l_shipdate"], expected_duplicate_ids=0, id_columns_are_entity_keys=True,
    splits={"train": "public/train", "eval": "public/eval", "holdout": "public/holdout"},
    declared={
        "task": {"prediction_time": "the day of the order"}, "features_documented_at": "prediction_time",
        "timing": {
            "prediction_instant": {"kind": "publication", "citation": "release notes", "days_after_period_end": 40},
            "features": {"source_kind": "statistical_release", "published_days_after_period_end": 33},
            "row_selection": {"latest_period_used": "M+1", "fields": ["day"]},
            "observations": [{"period_end": "1999-01-31", "published": "1999-03-07"}, {"period_end": "1999-02-28", "published": "soon"}],
        },
        "evaluation_contract": {
            "use": "historical_forecasting", "access": "common_cutoff_batch", "vintage": {"kind": "as_of", "evidence": "dated files"},
            "selection": {"kind": "outcome_conditioned", "evidence": "only closed orders"}, "limitations": ["made up"],
            "feature_evidence": {
                c: {"source": "orders", "availability": "at the order", "status": "verified"} for c in ("o_orderkey", "o_orderpriority", "day")
            } | {"cents": {"source": "orders", "availability": "at the order", "status": "assumed"}, "o_custkey": {"source": "orders"}},
            "cross_row_audit": {
                "rationale": "customers order again", "auxiliary_files_review": "none",
                "probes": [{"entity": ["o_custkey"], "time": "day", "offset_days": 30, "operation": "gt", "left": "cents", "threshold": 15000000}],
            },
            "availability_ledger": "ledger",
        },
        "measurements": [{"column": "cents", "unit": "cent", "frame": "order"}, {"column": "day", "unit": "day"}], "external_threshold": "15000000",
        "unit_validation": {"checks": 12, "mismatches": 0, "source": "orders", "evidence_sha256": "0" * 63},
        "meta": {"target": "label", "positive_label": 1, "id_columns": ["o_orderkey"], "rows": {}, "positive_rate": {},
                 "columns": ["o_orderkey", "o_custkey", "o_orderpriority", "cents", "label"]},
    },
)
ROW_CLAIMS = [("train", "n_rows", "9134"), ("eval", "rate", "0.3"), ("holdout", "positives", "12")]

# What the declaration above amounts to, check by check.
SAID_ROWS = [
    ("leakage.declared_columns", "o_custkey"), ("leakage.answer_source_absent", ""), ("timing.no_post_hoc_feature", ""), ("runner.layout", "holdout is not private/"),
    ("splits.time_column_declared", ""), ("splits.machine_readable_windows", ""), ("splits.positive_events_declared", ""), ("splits.event_key_column_declared", ""),
    ("timing.prediction_time_declared", ""), ("timing.label_source_is_not_a_feature", ""), ("timing.every_feature_documented", ""), ("timing.instant_declared", ""),
    ("timing.publication_lag_measured", "every observation usable"), ("timing.features_available_at_instant", "published by the instant"),
    ("timing.instant_accounts_for_publication_lag", ""), ("timing.selection_uses_only_available_data", "latest period"),
    ("contract.declared", ""), ("contract.scope", ""), ("contract.vintage_and_selection", ""), ("contract.every_input_has_availability_evidence", "o_custkey"),
    ("contract.cross_row_review", ""), ("contract.historical_evidence", "o_custkey; cents; selection"), ("units.measured_columns_declare_unit_and_frame", "day"),
    ("units.validation_receipt", "receipt"), ("runner.meta_json_keys", ""), ("runner.meta_matches_files", "header"), ("runner.id_columns_are_not_features", ""),
    ("leakage.every_column_could_be_scored", ""),
]
SAID_ROWS_SQL = "(VALUES " + ", ".join(f"('{c}', {str(not d).lower()}, '{d}')" for c, d in SAID_ROWS) + ")"


def per_split(bad: str, splits=("train", "eval", "holdout"), source: str = "s") -> str:
    """(ok, detail) of a check that fails for the splits where ``bad`` holds, in the order of the splits."""
    order = "CASE split " + " ".join(f"WHEN '{x}' THEN {i}" for i, x in enumerate(splits)) + " END"
    where = f"split IN ({', '.join(repr(x) for x in splits)})"
    return f"count(*) FILTER (({bad}) AND {where}) = 0, coalesce(string_agg(split, '; ' ORDER BY {order}) FILTER (({bad}) AND {where}), '') FROM {source}"


@query("h21_gate_report", f"""
WITH {ORDERS}, {LEDGER}, s0 AS (SELECT split, count(*) AS n, sum(label) AS p, min(day) AS lo, max(day) AS hi, count(DISTINCT day) FILTER (label = 1) AS e FROM o GROUP BY ALL),
s AS (SELECT split, coalesce(n, 0) AS n, coalesce(p, 0) AS p, lo, hi, coalesce(e, 0) AS e FROM (VALUES ('train'), ('eval'), ('holdout')) v(split) LEFT JOIN s0 USING (split)),
i AS (SELECT count(*) FILTER (k > 1) AS shared, sum(n - k) AS repeats, count(*) FILTER (bad) AS bad FROM (SELECT o_orderkey, count(DISTINCT split) AS k, count(*) AS n, min(label) <> max(label) AS bad FROM o GROUP BY ALL)),
cells AS (SELECT split, label AS y, unnest(['o_orderkey', 'o_custkey', 'o_orderpriority', 'cents', 'day']) AS field,
  unnest([CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), o_orderpriority, CAST(cents AS VARCHAR), strftime(day, '%Y-%m-%d')]) AS value FROM o),
lv AS (SELECT split, field, value, sum(y) AS pos, sum(1 - y) AS neg FROM cells GROUP BY ALL),
k AS (SELECT split, field, CASE WHEN bool_and(TRY_CAST(value AS DOUBLE) IS NOT NULL) THEN 'numeric' WHEN count(*) > greatest(1, floor(sum(pos + neg) / 5)) THEN 'high' ELSE 'level' END AS kind FROM lv GROUP BY ALL),
sc AS (SELECT c.split, c.field, c.y, CASE WHEN kind = 'numeric' THEN TRY_CAST(value AS DOUBLE) ELSE CAST(pos AS DOUBLE) / (pos + neg) END AS score FROM cells c JOIN lv USING (split, field, value) JOIN k USING (split, field) WHERE kind <> 'high'),
a AS ({auc_sql("sc", "split, field")}),
mt AS (SELECT count(*) AS n, bool_or(s.lo <= z.hi AND z.lo <= s.hi) AS bad, 'train/eval' AS pair, 0 AS nth FROM s JOIN s z ON s.split = 'train' AND z.split = 'eval'
  UNION ALL SELECT count(*), bool_or(s.lo <= z.hi AND z.lo <= s.hi), 'train/holdout', 1 FROM s JOIN s z ON s.split = 'train' AND z.split = 'holdout'
  UNION ALL SELECT count(*), bool_or(s.lo <= z.hi AND z.lo <= s.hi), 'eval/holdout', 2 FROM s JOIN s z ON s.split = 'eval' AND z.split = 'holdout'),
pr AS (SELECT split, count(*) AS covered, count(*) FILTER (v <> label) AS mismatches FROM (SELECT o_custkey, day, any_value(split) AS split, any_value(label) AS label FROM o GROUP BY ALL HAVING count(*) = 1)
  JOIN (SELECT o_custkey, CAST(day - INTERVAL 30 DAY AS DATE) AS day, max(CAST(cents > 15000000 AS INT)) AS v FROM o GROUP BY ALL HAVING min(cents > 15000000) = max(cents > 15000000)) USING (o_custkey, day) GROUP BY ALL),
rf AS (SELECT split, 100.0 * CAST(sum(label) AS DOUBLE) / count(*) AS observed FROM o GROUP BY ALL),
rc AS (SELECT DISTINCT v.split, replace(form_literal, '{{k}}', CAST(80 + doc_id % 20 AS VARCHAR)) AS literal FROM documents JOIN {SAID_SQL} ON doc_id % 4 = form),
rb AS (SELECT * FROM rc JOIN rf USING (split) WHERE NOT abs(CAST(literal AS DOUBLE) - observed) <= CASE WHEN contains(literal, '.') THEN 0.5 * pow(10.0, -length(split_part(literal, '.', 2))) ELSE 0.5 END + 1e-12),
dt AS (SELECT count(*) AS n FROM (SELECT o_orderpriority, cents FROM o GROUP BY ALL HAVING count(DISTINCT split) > 1)),
lg AS (SELECT concat_ws('; ', CASE WHEN max(uncovered) > 0 THEN 'uncovered' END, CASE WHEN max(duplicated) > 0 THEN 'duplicated' END, CASE WHEN max(features_late) > 0 THEN 'late features' END,
    CASE WHEN NOT bool_and(labels_in_time) THEN 'labels too late' END, 'several instants') AS detail FROM ({LEDGER_FACTS})),
r AS (SELECT * FROM {SAID_ROWS_SQL} AS v("check", ok, detail)
  UNION ALL SELECT 'leakage.no_single_column_determines_the_target', count(*) FILTER (auc IN (0, 1)) = 0, coalesce(string_agg(field || '@' || split, '; ' ORDER BY field || '@' || split) FILTER (auc IN (0, 1)), '') FROM a
  UNION ALL SELECT 'leakage.high_cardinality_declared', count(*) = 0, coalesce(string_agg(field || '@' || split, '; ' ORDER BY field || '@' || split), '') FROM k WHERE kind = 'high' AND field NOT IN ('o_orderkey', 'day')
  UNION ALL SELECT 'splits.non_empty', {per_split("n = 0")}
  UNION ALL SELECT 'splits.actual_ranges_computed', {per_split("lo IS NULL")}
  UNION ALL SELECT 'splits.eval_and_holdout_have_both_classes', {per_split("p = 0 OR p = n", ("eval", "holdout"))}
  UNION ALL SELECT 'splits.positive_events_match_rows', {per_split("p <> CASE split WHEN 'eval' THEN 735 ELSE 1 END", ("eval", "holdout"))}
  UNION ALL SELECT 'splits.distinct_events_match_rows', {per_split("e <> CASE split WHEN 'eval' THEN 318 ELSE 1 END", ("eval", "holdout"))}
  UNION ALL SELECT 'splits.enough_clustered_positives', {per_split("e < 20 OR CASE split WHEN 'eval' THEN 735 ELSE 1 END < 30", ("eval", "holdout"))}
  UNION ALL SELECT 'splits.rates_not_uniform', count(*) FILTER (p > 0 AND p < n) > 0, CASE WHEN count(*) FILTER (p > 0 AND p < n) > 0 THEN '' ELSE 'every split is all positive or all negative' END FROM s
  UNION ALL SELECT 'splits.actual_ranges_disjoint', count(*) FILTER (bad) = 0, coalesce(string_agg(pair, '; ' ORDER BY nth) FILTER (bad), '') FROM mt
  UNION ALL SELECT 'splits.rows_within_declared_windows', {per_split("CASE split WHEN 'train' THEN hi >= DATE '1999-01-01' WHEN 'eval' THEN lo < DATE '1999-01-01' OR hi >= DATE '2000-01-01' ELSE lo < DATE '2000-01-01' OR hi >= DATE '2001-07-01' END")}
  UNION ALL SELECT 'splits.no_cross_split_entities', shared = 0, CASE WHEN shared = 0 THEN '' ELSE shared || ' identifiers span splits' END FROM i
  UNION ALL SELECT 'splits.duplicate_entities_within_splits', repeats = 0, CASE WHEN repeats = 0 THEN '' ELSE CAST(repeats AS BIGINT) || ' repeated rows' END FROM i
  UNION ALL SELECT 'splits.repeated_identifiers_carry_one_label', bad = 0, CASE WHEN bad = 0 THEN '' ELSE bad || ' contradictory identifiers' END FROM i
  UNION ALL SELECT 'duplicates.no_feature_tuple_in_two_splits', n = 0, CASE WHEN n = 0 THEN '' ELSE n || ' feature tuples are in more than one split' END FROM dt
  UNION ALL SELECT 'contract.cross_row_probe_0', count(*) = 0, CASE WHEN count(*) = 0 THEN '' WHEN count(*) FILTER (mismatches = 0 AND split <> 'train') > 0 THEN 'exact' ELSE 'exposed' END FROM pr
  UNION ALL SELECT 'contract.label_availability', detail = '', detail FROM lg
  UNION ALL SELECT 'claims.train_n_rows_9134', n = 9134, CASE WHEN n = 9134 THEN '' ELSE 'rows say ' || CAST(CAST(n AS DOUBLE) AS VARCHAR) END FROM s WHERE split = 'train'
  UNION ALL SELECT 'claims.eval_rate_0.3', abs(0.3 - CAST(p AS DOUBLE) / n) <= 0.05 + 1e-12, CASE WHEN abs(0.3 - CAST(p AS DOUBLE) / n) <= 0.05 + 1e-12 THEN '' ELSE 'rows say ' || round(CAST(p AS DOUBLE) / n, 6) END FROM s WHERE split = 'eval'
  UNION ALL SELECT 'claims.holdout_positives_12', p = 12, CASE WHEN p = 12 THEN '' ELSE 'rows say ' || CAST(CAST(p AS DOUBLE) AS VARCHAR) END FROM s WHERE split = 'holdout'
  UNION ALL SELECT 'claims.prose_matches_rows', count(*) = 0, coalesce(string_agg(split || ' ' || literal || '%', '; ' ORDER BY split, literal), '') FROM rb)
SELECT * FROM r UNION ALL SELECT 'overall', bool_and(ok), count(*) FILTER (NOT ok) || ' failed' FROM r""")
def gate_report(spark, sf):
    o = base.orders(spark, sf).select("o_orderkey", "o_custkey", "o_orderpriority", "cents", "day", "label", "split")
    _, ledger = ledger_rows(spark, sf)
    k = (80 + F.pmod("doc_id", F.lit(20))).cast("string")
    forms = F.element_at(F.array(*[F.replace(F.lit(said), F.lit("{k}"), k) for said, _ in SAID]), (F.pmod("doc_id", F.lit(4)) + 1).cast("int"))
    texts = table(spark, sf, "documents").select(F.col("doc_id").alias("key"), F.concat("text", F.lit("\n"), forms).alias("text"))
    return qualify(o, QUALITY, ledger=ledger, claims=ROW_CLAIMS, texts=texts).select("check", "ok", "detail")


SPARSE = """y AS (SELECT c_nationkey * 100 + day(o_orderdate) AS host, o_custkey AS origin, year(o_orderdate) AS year, count(*) AS c
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)"""


@query("h22_exposure_measure", f"""
WITH {SPARSE}, b AS (SELECT host, origin, min(year) AS t0 FROM y GROUP BY ALL), a AS (SELECT b.*, c AS c0 FROM b JOIN y ON y.host = b.host AND y.origin = b.origin AND y.year = t0),
t AS (SELECT host, year, CAST(sum(c) AS BIGINT) AS total FROM y GROUP BY ALL), k AS (SELECT DISTINCT host, t0 FROM b),
z AS (SELECT a.*, t.year AS oy, coalesce(y.c, 0) AS v, t.total FROM a JOIN t ON t.host = a.host AND t.year IN (t0 + 1, t0 + 2)
  LEFT JOIN y ON y.host = a.host AND y.origin = a.origin AND y.year = t.year)
SELECT t0 AS year, count(*) AS exposed, count(*) FILTER (v >= 2 * c0) AS label_determining FROM z
WHERE v = total AND EXISTS (SELECT 1 FROM k WHERE k.host = z.host AND k.t0 IN (oy, oy + 1)) GROUP BY ALL""")
def exposure(spark, sf):
    # A host is a nation on one day of the month, so that a host-year has few origins.
    o = table(spark, sf, "orders").select(
        "o_custkey", F.dayofmonth("o_orderdate").alias("day"), F.year("o_orderdate").cast("bigint").alias("year")
    )
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    host = (F.col("c_nationkey") * 100 + F.col("day")).alias("host")
    y = o.join(c, F.col("o_custkey") == F.col("c_custkey")).groupBy(host, F.col("o_custkey").alias("origin"), "year").agg(n_all().alias("c"))
    built = y.groupBy("host", "origin").agg(F.min("year").alias("t0"), F.min_by("c", "year").alias("c0"))
    donors = built.select("host", F.explode(F.array(F.col("t0"), F.col("t0") - 1)).alias("oy")).distinct()
    totals = y.groupBy("host", F.col("year").alias("oy")).agg(F.sum("c").alias("total"))
    operands = built.select("host", "origin", "t0", "c0", F.explode(F.array(F.col("t0") + 1, F.col("t0") + 2)).alias("oy"))
    z = (
        operands.join(totals, ["host", "oy"])
        .join(y.withColumnRenamed("year", "oy"), ["host", "origin", "oy"], "left")
        .join(donors, ["host", "oy"], "left_semi")
    )
    v = F.coalesce("c", F.lit(0))
    return z.where(v == F.col("total")).groupBy(F.col("t0").alias("year")).agg(
        n_all().alias("exposed"), n_if(v >= 2 * F.col("c0")).alias("label_determining")
    )


BOUNDS = [("ECONOMY", 1, 45), ("SMALL", 5, 50), ("LARGE", 1, 50), ("MEDIUM", 1, 30)]
BOUNDS_SQL = "b(p_type, lo, hi) AS (VALUES " + ", ".join(f"('{a}', {lo}, {hi})" for a, lo, hi in BOUNDS) + ")"


@query("h23_interval_consistency", f"""
WITH {BOUNDS_SQL} SELECT p_type, count(*) AS n, count(*) FILTER (lo IS NULL) AS unknown_class, count(*) FILTER (p_size < lo OR p_size > hi) AS outside FROM part LEFT JOIN b USING (p_type) GROUP BY ALL""")
def interval_consistency(spark, sf):
    b = spark.createDataFrame(BOUNDS, "p_type string, lo int, hi int")
    return table(spark, sf, "part").join(b, "p_type", "left").groupBy("p_type").agg(
        n_all().alias("n"), n_if(F.col("lo").isNull()).alias("unknown_class"),
        n_if((F.col("p_size") < F.col("lo")) | (F.col("p_size") > F.col("hi"))).alias("outside"),
    )


ANCHORS = [(1995, 2285), (1996, 2260), (1997, 2290), (2005, 1)]
ANCHORS_SQL = "a(year, anchor) AS (VALUES " + ", ".join(f"({y}, {n})" for y, n in ANCHORS) + ")"


@query("h24_anchor_counts", f"""
WITH {ORDERS}, {ANCHORS_SQL} SELECT a.year, a.anchor, coalesce(n, 0) AS counted, coalesce(n, 0) = a.anchor AS ok FROM a LEFT JOIN (SELECT year, count(*) AS n FROM o GROUP BY ALL) f USING (year)""")
def anchors(spark, sf):
    a = spark.createDataFrame(ANCHORS, "year bigint, anchor bigint")
    f = base.orders(spark, sf).groupBy("year").agg(n_all().alias("n"))
    counted = F.coalesce("n", F.lit(0))
    return a.join(f, "year", "left").select("year", "anchor", counted.alias("counted"), (counted == F.col("anchor")).alias("ok"))


@query("h25_export_cap_check", f"""
WITH {ORDERS}, x AS (SELECT unnest(range(1994, 2003)) AS year) SELECT x.year, count(o.year) AS n, count(o.year) > 0 AND count(o.year) < 2280 AS ok FROM x LEFT JOIN o USING (year) GROUP BY ALL""")
def export_cap(spark, sf):
    years = spark.range(1994, 2003).select(F.col("id").alias("year"))
    f = base.orders(spark, sf).groupBy("year").agg(n_all().alias("n"))
    n = F.coalesce("n", F.lit(0))
    return years.join(f, "year", "left").select("year", n.alias("n"), ((n > 0) & (n < 2280)).alias("ok"))


@query("h26_partition_check", f"""
WITH {ORDERS} SELECT split, count(*) AS n, strftime(min(day), '%Y-%m-%d') AS lo, strftime(max(day), '%Y-%m-%d') AS hi, count(*) = count(DISTINCT o_orderkey) AS unique_rows,
 CASE split WHEN 'train' THEN max(day) < DATE '1999-01-01' WHEN 'eval' THEN min(day) >= DATE '1999-01-01' AND max(day) < DATE '2000-01-01' ELSE min(day) >= DATE '2000-01-01' END AS inside FROM o GROUP BY split""")
def partition_check(spark, sf):
    lo, hi, s = F.min("day"), F.max("day"), F.col("split")
    d = lambda x: F.lit(x).cast("date")
    return base.orders(spark, sf).groupBy("split").agg(
        n_all().alias("n"), base.text(lo).alias("lo"), base.text(hi).alias("hi"),
        (n_all() == F.countDistinct("o_orderkey")).alias("unique_rows"),
        F.when(s == "train", hi < d("1999-01-01"))
        .when(s == "eval", (lo >= d("1999-01-01")) & (hi < d("2000-01-01")))
        .otherwise(lo >= d("2000-01-01")).alias("inside"),
    )


@query("h27_threshold_agreement", """
WITH x AS (SELECT user_id, CAST(ts AS DATE) AS d, max(value) AS fine, max(value) FILTER (minute(ts) < 30) AS coarse FROM events GROUP BY ALL)
SELECT user_id, count(*) FILTER (fine > 100 AND coarse > 100) AS both_over, count(*) FILTER (fine > 100 AND coarse <= 100) AS only_fine,
  count(*) FILTER (fine <= 100 AND coarse <= 100) AS both_under, count(*) FILTER (coarse IS NULL) AS coarse_missing FROM x GROUP BY ALL""")
def threshold_agreement(spark, sf):
    x = table(spark, sf, "events").groupBy("user_id", F.col("ts").cast("date").alias("d")).agg(
        F.max("value").alias("fine"), F.max(F.when(F.minute("ts") < 30, F.col("value"))).alias("coarse")
    )
    f, c = F.col("fine") > 100, F.col("coarse") > 100
    return x.groupBy("user_id").agg(
        n_if(f & c).alias("both_over"), n_if(f & ~c).alias("only_fine"), n_if(~f & ~c).alias("both_under"),
        n_if(F.col("coarse").isNull()).alias("coarse_missing"),
    )


@query("h28_screen_and_headroom_verdict", f"""
WITH {LABELLED}, t AS (SELECT lang AS task, count(*) AS n FROM ld GROUP BY ALL),
r AS (SELECT lang, source, CAST(sum(y) AS DOUBLE) / count(*) AS rate FROM ld GROUP BY ALL),
s1 AS (SELECT lang AS task, n_chars AS score, y FROM ld), s2 AS (SELECT ld.lang AS task, rate AS score, y FROM ld JOIN r USING (lang, source)),
a1 AS ({auc_sql("s1", "task")}), a2 AS ({auc_sql("s2", "task")})
SELECT task, n, a1.auc AS baseline, a2.auc AS best, CASE WHEN n < 40 THEN 'screened_out' WHEN greatest(a1.auc, a2.auc) > 0.95 THEN 'reject_leak' WHEN a1.auc IS NULL THEN 'not_runnable'
  WHEN a1.auc < 0.60 THEN 'reject_noise' WHEN a1.auc > 0.85 THEN 'reject_saturated' WHEN a2.auc - a1.auc >= 0.03 THEN 'qualify' ELSE 'insufficient_headroom' END AS verdict
FROM t JOIN a1 USING (task) JOIN a2 USING (task)""")
def headroom_verdict(spark, sf):
    d = base.labelled_documents(spark, sf).select(F.col("lang").alias("task"), "source", "n_chars", "y")
    rate = d.groupBy("task", "source").agg(F.try_divide(F.sum("y"), n_all()).alias("rate"))
    a1 = rank_auc(d, ["task"], "n_chars", "y", out="baseline")
    a2 = rank_auc(d.join(rate, ["task", "source"]), ["task"], "rate", "y", out="best")
    t = d.groupBy("task").agg(n_all().alias("n")).join(a1, "task").join(a2, "task")
    leak = F.greatest("baseline", "best")
    return t.withColumn("verdict", ops.verdict(F.col("n"), F.lit(3), leak, F.col("baseline"), F.col("best"), 40))

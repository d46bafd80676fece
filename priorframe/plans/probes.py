"""I: label-recovery probes."""

from pyspark.sql import functions as F

from priorframe.functions.numbers import rounded_count
from priorframe.operators import history
from priorframe.operators import probes as ops
from priorframe.operators.expressions import Evaluator
from priorframe.plans import base
from priorframe.plans.base import DAILY, LABELLED, ORDERS, SPLIT_DOCUMENTS, auc_sql, cents
from priorframe.plans.labels import CORRIDOR, corridor
from priorframe.plans.registry import query
from priorframe.session import scratch_dir
from priorframe.sources.sinks import written_once
from priorframe.sources.tables import table

USER = ["user_id"]
LIMIT = 20000


def n_all():
    return F.count(F.lit(1))


def n_if(cond):
    return F.count(F.when(cond, 1))


def features(spark, sf):
    """Label-free panel of all documents; no label table is read."""
    d = base.split_documents(spark, sf).select("doc_id", "split", "lang", "source", "n_chars", "text")
    return ops.require_label_free(d, "y")


BARE = """cells AS (SELECT doc_id, split, unnest(['n_chars', 'source', 'lang', 'tag']) AS field,
  unnest([CAST(n_chars AS VARCHAR), source, lang, CASE WHEN doc_id % 4 = 0 THEN 'NA' ELSE CAST(-doc_id AS VARCHAR) END]) AS value FROM sd)"""
CELLS = """cells AS (SELECT doc_id, split, y, unnest(['n_chars', 'source', 'lang', 'tag']) AS field,
  unnest([CAST(n_chars AS VARCHAR), source, lang, CASE WHEN doc_id % 4 = 0 THEN 'NA' ELSE CAST(-doc_id AS VARCHAR) END]) AS value FROM ld)"""


def cell_panel(spark, sf):
    tag = F.when(F.pmod("doc_id", F.lit(4)) == 0, "NA").otherwise((-F.col("doc_id")).cast("string"))
    return features(spark, sf).withColumn("tag", tag)


COLUMNS = ["n_chars", "source", "lang", "tag"]


@query("i1_numeric_probe", f"""
WITH {SPLIT_DOCUMENTS}, {BARE} SELECT doc_id, 'numeric:' || field AS probe, TRY_CAST(value AS DOUBLE) AS score FROM cells
UNION ALL SELECT doc_id, 'absolute:' || field, abs(TRY_CAST(value AS DOUBLE)) FROM cells""")
def numeric_probe(spark, sf):
    p = ops.cell_probes(cell_panel(spark, sf), ["doc_id"], COLUMNS)
    return p.where("probe LIKE 'numeric:%' OR probe LIKE 'absolute:%'")


@query("i2_lexical_probe", f"""
WITH {SPLIT_DOCUMENTS}, {BARE} SELECT doc_id, 'lexical:' || field AS probe, CAST(dense_rank() OVER (PARTITION BY field ORDER BY value) - 1 AS DOUBLE) AS score FROM cells""")
def lexical_probe(spark, sf):
    return ops.lexical_probe(cell_panel(spark, sf), ["doc_id"], COLUMNS)


@query("i3_length_missing_probe", f"""
WITH {SPLIT_DOCUMENTS}, {BARE} SELECT doc_id, 'length:' || field AS probe, CAST(length(value) AS DOUBLE) AS score FROM cells
UNION ALL SELECT doc_id, 'missing:' || field, CAST(value IN ('', '-1', 'NA', 'N/A', 'nan') AS DOUBLE) FROM cells""")
def length_probe(spark, sf):
    p = ops.cell_probes(cell_panel(spark, sf), ["doc_id"], COLUMNS)
    return p.where("probe LIKE 'length:%' OR probe LIKE 'missing:%'")


@query("i4_row_order_probe", f"""
WITH {SPLIT_DOCUMENTS} SELECT split, doc_id, 'row_order' AS probe, CAST(row_number() OVER (PARTITION BY split ORDER BY doc_id) - 1 AS DOUBLE) AS score FROM sd""")
def row_order(spark, sf):
    return ops.row_order_probe(features(spark, sf), "split", "doc_id")


TOKENS = r"""w AS (SELECT doc_id, split, y, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS w FROM ld),
tk AS (SELECT DISTINCT doc_id, split, y, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS token FROM w)"""


@query("i5_token_probe", f"""
WITH {SPLIT_DOCUMENTS}, {TOKENS.replace("y, ", "").replace("FROM ld", "FROM sd")}, top AS (SELECT token FROM tk GROUP BY token HAVING count(*) >= 10),
n AS (SELECT split, count(*) AS n_rows FROM sd GROUP BY ALL), h AS (SELECT token, split, count(*) AS hits FROM tk JOIN top USING (token) GROUP BY ALL)
SELECT 'token:' || token AS probe, split, n_rows, coalesce(hits, 0) AS hits FROM top CROSS JOIN n LEFT JOIN h USING (token, split)""")
def token_probe(spark, sf):
    return ops.token_hits(features(spark, sf), "split", "text")


TYPED = """tp AS (SELECT user_id, event_type, date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS d, count(*) AS n,
  CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS c FROM events GROUP BY ALL),
k AS (SELECT 'user_id' AS key_set, CAST(user_id AS VARCHAR) AS key, d, n, c FROM tp UNION ALL SELECT 'event_type', event_type, d, n, c FROM tp
  UNION ALL SELECT 'user_id+event_type', user_id || '|' || event_type, d, n, c FROM tp),
g AS (SELECT key_set, key, d, count(*) AS n_rows, max(n) AS n, max(c) AS c FROM k GROUP BY ALL), u AS (SELECT * FROM g WHERE n_rows = 1)"""
KEY_SETS = [["user_id"], ["event_type"], ["user_id", "event_type"]]


def typed_daily(spark, sf):
    return table(spark, sf, "events").groupBy("user_id", "event_type", history.day_number("ts").alias("d")).agg(
        n_all().alias("n"), F.sum(cents("value")).alias("c")
    )


@query("i6_exploratory_successor_join", f"""
WITH {TYPED}, o AS (SELECT unnest([1, 2, 7, 30, 365, 366]) AS "offset"),
z AS (SELECT g.key_set, "offset", g.n_rows, u.n, u.c FROM g CROSS JOIN o LEFT JOIN u ON u.key_set = g.key_set AND u.key = g.key AND u.d = g.d + "offset")
SELECT key_set, "offset", 'n' AS operand, CAST(sum(n_rows) AS BIGINT) AS n_rows, CAST(coalesce(sum(n_rows) FILTER (n IS NOT NULL), 0) AS BIGINT) AS covered, CAST(coalesce(sum(n_rows * n), 0) AS BIGINT) AS total FROM z GROUP BY ALL
UNION ALL SELECT key_set, "offset", 'c', CAST(sum(n_rows) AS BIGINT), CAST(coalesce(sum(n_rows) FILTER (c IS NOT NULL), 0) AS BIGINT), CAST(coalesce(sum(n_rows * c), 0) AS BIGINT) FROM z GROUP BY ALL""")
def exploratory(spark, sf):
    long = ops.exploratory_successors(typed_daily(spark, sf), "d", KEY_SETS, ["n", "c"])
    k = F.col("n_rows")
    return long.groupBy("key_set", F.col("offset").cast("bigint").alias("offset"), "operand").agg(
        F.sum(k).alias("n_rows"), F.sum(F.when(F.col("present"), k).otherwise(0)).alias("covered"),
        F.coalesce(F.sum(k * F.col("value")).cast("bigint"), F.lit(0)).alias("total"),
    )


@query("i7_quasi_successor_missing", f"""
WITH {TYPED}, o AS (SELECT unnest([7, 14]) AS "offset")
SELECT a.key_set, "offset", count(*) AS own_unique, count(b.d) AS future_present, count(*) - count(b.d) AS future_absent
FROM u a CROSS JOIN o LEFT JOIN u b ON b.key_set = a.key_set AND b.key = a.key AND b.d = a.d + "offset" GROUP BY ALL""")
def quasi(spark, sf):
    long = ops.exploratory_successors(typed_daily(spark, sf), "d", KEY_SETS, ["n"], (7, 14)).where("n_rows = 1")
    return long.groupBy("key_set", F.col("offset").cast("bigint").alias("offset")).agg(
        n_all().alias("own_unique"), n_if(F.col("present")).alias("future_present"),
        n_if(~F.col("present")).alias("future_absent"),
    )


BANDED = """bd AS (SELECT doc_id, split, y, lang, source, CAST(n_chars // 500 AS VARCHAR) AS band FROM ld),
ks AS (SELECT doc_id, split, y, unnest(['lang', 'source', 'band', 'lang+source', 'lang+band', 'source+band']) AS probe,
  unnest([lang, source, band, lang || '|' || source, lang || '|' || band, source || '|' || band]) AS key FROM bd),
tr AS (SELECT probe, key, count(*) AS n, sum(y) AS p FROM ks WHERE split = 'train' GROUP BY ALL)"""


def banded(spark, sf):
    return base.labelled_documents(spark, sf).select(
        "doc_id", "split", "y", "lang", "source", F.floor(F.col("n_chars") / 500).alias("band")
    )


@query("i8_train_lookup", f"""
WITH {LABELLED}, {BANDED} SELECT doc_id, probe, CAST(p AS DOUBLE) / n AS score FROM ks LEFT JOIN tr USING (probe, key) WHERE split <> 'train'""")
def lookup(spark, sf):
    return ops.train_lookup(banded(spark, sf), "split", "doc_id", "y", ["lang", "source", "band"]).select("doc_id", "probe", "score")


@query("i9_unanimous_lookup", f"""
WITH {LABELLED}, {BANDED} SELECT probe, split, count(*) AS n_rows, count(*) FILTER (n >= 2 AND p IN (0, n)) AS covered, count(*) FILTER (n >= 2 AND p = n) AS positive
FROM ks LEFT JOIN tr USING (probe, key) WHERE split <> 'train' GROUP BY ALL""")
def unanimous(spark, sf):
    t, n = ops.lookup_cube(banded(spark, sf), "split", "y", ["lang", "source", "band"]), F.col("n_rows")
    some = lambda c: F.coalesce(F.sum(F.when(c, n)), F.lit(0))
    return t.groupBy("probe", "split").agg(
        F.sum(n).alias("n_rows"), some(F.col("unanimous")).alias("covered"), some(F.col("unanimous") & (F.col("rate") == 1)).alias("positive")
    )


SPLIT_DAILY = """sd AS (SELECT *, CASE WHEN d < 19733 THEN 'train' WHEN d < 19742 THEN 'eval' ELSE 'holdout' END AS split FROM p)"""


def split_daily(spark, sf):
    split = F.when(F.col("d") < 19733, "train").when(F.col("d") < 19742, "eval").otherwise("holdout")
    return base.daily(spark, sf).withColumn("split", split)


@query("i10_donor_scope", f"""
WITH {DAILY}, {SPLIT_DAILY} SELECT scope, a.split, count(*) AS n_rows, count(b.c) AS covered, CAST(coalesce(sum(b.c), 0) AS BIGINT) AS total
FROM (SELECT sd.*, unnest(['self', 'all']) AS scope FROM sd WHERE split <> 'train') a LEFT JOIN sd b ON b.user_id = a.user_id AND b.d = a.d + 1 AND (scope = 'all' OR b.split = a.split) GROUP BY ALL""")
def donor_scope(spark, sf):
    p = split_daily(spark, sf).select("user_id", "d", "c", "split")
    rows = ops.scoped_rows(p.drop("c"), "split")
    donors = ops.scoped_donors(p, "split")
    j = ops.donor_at(rows, donors, ["pool", "user_id"], "d", 1, ["c"])
    return j.groupBy("scope", "split").agg(
        n_all().alias("n_rows"), F.count("donor_c").alias("covered"), F.coalesce(F.sum("donor_c"), F.lit(0)).alias("total")
    )


def fr(expr, k, fn="max"):
    """One-day frame k days away, in SQL."""
    at = f"{abs(k)} {'FOLLOWING' if k > 0 else 'PRECEDING'}"
    return f"{fn}({expr}) OVER (PARTITION BY user_id ORDER BY d RANGE BETWEEN {at} AND {at})"


def back(expr, n, fn):
    return f"{fn}({expr}) OVER (PARTITION BY user_id ORDER BY d RANGE BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


STATION = f"""st AS (SELECT user_id, d, CAST(c AS DOUBLE) AS value, {fr("CAST(c AS DOUBLE)", -1)} AS lag1, {fr("CAST(c AS DOUBLE)", -2)} AS lag2, {fr("CAST(c AS DOUBLE)", -3)} AS lag3,
  coalesce(d - {back(f"CASE WHEN c > {LIMIT} THEN d END", 90, "max")}, -1) AS days_since, {back(f"CASE WHEN c > {LIMIT} THEN 1 END", 30, "count")} AS count_30,
  round({back("c", 7, "avg")}, 4) AS mean_7, {back("c", 7, "count")} AS valid_7, round({back("c", 30, "avg")}, 4) AS mean_30, {back("c", 30, "count")} AS valid_30 FROM p)"""


def _recipes_sql():
    out = {}
    for k, c in ((1, "value"), (2, "lag1"), (3, "lag2"), (4, "lag3")):
        out[f"future_{k}_{c}"] = f"CASE WHEN {fr(c, k)} >= 0 THEN CAST({fr(c, k)} > {LIMIT} AS DOUBLE) END"
    for k in (1, 2, 3, 7):
        v = fr("days_since", k)
        out[f"reverse_last_{k}"] = f"CASE WHEN {v} = {k - 1} THEN 1e0 WHEN {v} > {k - 1} OR {v} = -1 THEN 0e0 END"
    dl = f"({fr('count_30', 1)} - count_30)"
    out["count_delta"] = f"CASE {dl} WHEN 1 THEN 1e0 WHEN -1 THEN 0e0 END"
    og = fr("value", -29)
    an = f"({dl} + CASE WHEN {og} > {LIMIT} THEN 1 ELSE 0 END)"
    out["count_delta_outgoing"] = f"CASE WHEN {og} >= 0 AND {an} IN (0, 1) THEN CAST({an} AS DOUBLE) END"
    for w in (7, 30):
        nm, nn, gone = fr(f"mean_{w}", 1), fr(f"valid_{w}", 1), fr("value", 1 - w)
        en = f"({nm} * {nn} - mean_{w} * valid_{w} + {gone})"
        er = f"(({nn} + valid_{w} + 1) * 0.000051::DOUBLE)"
        out[f"mean_rebuild_{w}"] = f"CASE WHEN {nm} >= 0 AND {gone} >= 0 AND {en} - {er} > {LIMIT} THEN 1e0 WHEN {nm} >= 0 AND {gone} >= 0 AND {en} + {er} <= {LIMIT} THEN 0e0 END"
    return out


RECIPES_SQL = _recipes_sql()
TRUTH = f"CAST({fr('value', 1)} > {LIMIT} AS DOUBLE)"


def station(spark, sf):
    feats = ops.station_features(base.daily(spark, sf), USER, "d", "c", LIMIT)
    return ops.station_recipes(feats, USER, "d", LIMIT)


def station_query(name, recipes):
    cols = ", ".join(f"{RECIPES_SQL[r]} AS {r}" for r in recipes)

    @query(name, f"WITH {DAILY}, {STATION} SELECT user_id, d, {cols} FROM st")
    def run(spark, sf):
        return station(spark, sf).select("user_id", "d", *recipes)

    return run


successor_threshold = station_query("i11_successor_threshold_recipe", ["future_1_value", "future_2_lag1", "future_3_lag2", "future_4_lag3"])
recency_reverse = station_query("i12_recency_reverse_recipe", [f"reverse_last_{k}" for k in (1, 2, 3, 7)])
count_delta = station_query("i13_rolling_count_delta_recipe", ["count_delta", "count_delta_outgoing"])
mean_rebuild = station_query("i14_rolling_mean_reconstruct", ["mean_rebuild_7", "mean_rebuild_30"])


@query("i15_corridor_successor_recipe", f"""
WITH {CORRIDOR}, s AS (SELECT a.host, a.origin, a.year, a.c AS apps, b.c AS apps_d1, CAST(a.c >= 2 * b.c AS BIGINT) AS surged FROM y a LEFT JOIN y b ON b.host = a.host AND b.origin = a.origin AND b.year = a.year - 1)
SELECT a.host, a.origin, a.year, CAST(n.surged AS DOUBLE) AS successor_flag,
  CAST(coalesce(n.apps, m.apps_d1) >= 2 * a.apps AS DOUBLE) AS successor_count,
  CASE WHEN n.year IS NULL AND a.year < (SELECT max(year) FROM s) THEN 0e0 ELSE CAST(n.surged AS DOUBLE) END AS successor_missing_zero
FROM s a LEFT JOIN s n ON n.host = a.host AND n.origin = a.origin AND n.year = a.year + 1 LEFT JOIN s m ON m.host = a.host AND m.origin = a.origin AND m.year = a.year + 2""")
def corridor_recipe(spark, sf):
    prev = history.at_offset("c", ["host", "origin"], "year", -1)
    p = corridor(spark, sf).select(
        "host", "origin", "year", F.col("c").alias("apps"), prev.alias("apps_d1"),
        (F.col("c") >= 2 * prev).cast("bigint").alias("surged"),
    )
    return ops.corridor_recipes(p, ["host", "origin"], "year").drop("apps", "apps_d1", "surged")


SITE = """sp AS (SELECT a.o_orderkey, a.o_custkey, a.day, count(b.o_orderkey) AS prior, count(b.o_orderkey) FILTER (b.o_orderstatus <> 'P') AS resolved,
   count(b.o_orderkey) FILTER (b.o_orderstatus = 'P') AS active, count(b.o_orderkey) FILTER (b.o_orderstatus = 'F') AS pos
  FROM o a LEFT JOIN o b ON b.o_custkey = a.o_custkey AND b.day < a.day GROUP BY ALL)"""


def site_panel(spark, sf):
    s = F.col("o_orderstatus")
    out = history.strict_prior(
        base.orders(spark, sf), ["o_custkey"], "day",
        {
            "prior": ("sum", F.lit(1).cast("bigint")), "resolved": ("sum", (s != "P").cast("bigint")),
            "active": ("sum", (s == "P").cast("bigint")), "pos": ("sum", (s == "F").cast("bigint")),
        },
    ).fillna(0, ["prior", "resolved", "active", "pos"])
    return out.select(
        "o_orderkey", "o_custkey", "day", "prior", "resolved", "active", F.round(F.try_divide("pos", "resolved"), 4).alias("rate")
    )


@query("i16_cumulative_rate_difference", f"""
WITH {ORDERS}, {SITE}, v AS (SELECT a.o_orderkey, min(b.pos - a.pos) AS lo, max(b.pos - a.pos) AS hi FROM sp a JOIN sp b
  ON b.o_custkey = a.o_custkey AND b.prior = a.prior + 1 AND b.resolved = a.resolved + 1 AND b.day > a.day WHERE a.active = 0 GROUP BY ALL)
SELECT o_orderkey, CASE WHEN lo = hi AND lo IN (0, 1) THEN CAST(lo AS DOUBLE) END AS score FROM sp LEFT JOIN v USING (o_orderkey)""")
def cumulative_rate(spark, sf):
    p = site_panel(spark, sf)
    return ops.cumulative_difference(p, "o_custkey", "day", "prior", "resolved", "rate", "active", "o_orderkey")


@query("i17_rounded_count", f"""
WITH {ORDERS}, s AS (SELECT o_custkey, count(*) AS n, CAST(sum(label) AS BIGINT) AS p FROM o GROUP BY ALL),
r AS (SELECT *, CAST(round(CAST(p AS DOUBLE) / n, 2) AS DECIMAL(4, 2)) AS rate2, CAST(round(CAST(p AS DOUBLE) / n, 1) AS DECIMAL(4, 1)) AS rate1 FROM s)
SELECT o_custkey, CASE WHEN greatest(ceil(n * (rate2 - 0.005)), 0) = least(floor(n * (rate2 + 0.005)), n) THEN CAST(greatest(ceil(n * (rate2 - 0.005)), 0) AS BIGINT) END AS k2,
  CASE WHEN greatest(ceil(n * (rate1 - 0.05)), 0) = least(floor(n * (rate1 + 0.05)), n) THEN CAST(greatest(ceil(n * (rate1 - 0.05)), 0) AS BIGINT) END AS k1 FROM r""")
def rounded(spark, sf):
    s = base.orders(spark, sf).groupBy("o_custkey").agg(n_all().alias("n"), F.sum("label").alias("p"))
    rate = F.try_divide("p", "n")
    return s.select(
        "o_custkey", rounded_count(F.col("n"), F.round(rate, 2), 2).alias("k2"), rounded_count(F.col("n"), F.round(rate, 1), 1).alias("k1")
    )


GROUPS = """yg AS (SELECT o_custkey, year, count(*) AS n, CAST(sum(label) AS BIGINT) AS p, arg_max(label, o_orderkey) AS last, max(o_orderkey) AS last_key, min(o_orderkey) AS first_key FROM o GROUP BY ALL),
gh AS (SELECT *, coalesce(sum(n) OVER w, 0) AS prior, coalesce(sum(p) OVER w, 0) AS pos, lag(last) OVER v AS last_prior, year - lag(year) OVER v AS since FROM yg
  WINDOW w AS (PARTITION BY o_custkey ORDER BY year ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), v AS (PARTITION BY o_custkey ORDER BY year)),
gn AS (SELECT *, lead(year) OVER v AS n_year, lead(prior) OVER v AS n_prior, lead(pos) OVER v AS n_pos, lead(last_prior) OVER v AS n_last, lead(since) OVER v AS n_since FROM gh WINDOW v AS (PARTITION BY o_custkey ORDER BY year)),
gr AS (SELECT o_orderkey, CASE WHEN o_orderkey = last_key AND n_year - n_since = o.year AND n_last IN (0, 1) THEN CAST(n_last AS DOUBLE) END AS reverse,
  CASE WHEN n_prior - prior > 0 THEN CASE WHEN n_prior - prior = n AND (n_pos - pos = 0 OR n_pos - pos = n_prior - prior) THEN CAST(n_pos - pos AS DOUBLE) / (n_prior - prior)
    WHEN n_prior - prior = 1 AND n_pos - pos IN (0, 1) THEN CAST(n_pos - pos AS DOUBLE) END END AS counted FROM o JOIN gn USING (o_custkey, year))"""


@query("i18_group_history_recipe", f"""
WITH {ORDERS}, {GROUPS} SELECT o_orderkey, reverse AS last_prior_reverse, counted AS history_count_difference, coalesce(counted, reverse) AS combined_reverse FROM gr""")
def group_history(spark, sf):
    from pyspark.sql import Window

    o = base.orders(spark, sf).select("o_custkey", "year", "o_orderkey", "label")
    y = o.groupBy("o_custkey", "year").agg(
        n_all().alias("n"), F.sum("label").alias("p"), F.max_by("label", "o_orderkey").alias("last")
    )
    w = history.before(["o_custkey"], "year")
    v = Window.partitionBy("o_custkey").orderBy("year")
    prior = F.coalesce(F.sum("n").over(w), F.lit(0))
    y = y.select(
        "o_custkey", "year", prior.alias("prior"), F.round(F.try_divide(F.sum("p").over(w), prior), 6).alias("rate"),
        F.lag("last").over(v).alias("last"), (F.col("year") - F.lag("year").over(v)).alias("since"),
    )
    panel = o.drop("label").join(y, ["o_custkey", "year"])
    return ops.group_history(panel, "o_custkey", "year", "o_orderkey", "prior", "rate", "last", "since")


UNION_SQL = "list_distinct([x for x in [" + ", ".join(RECIPES_SQL) + "] if x IS NOT NULL])"


@query("i19_recipe_union", f"""
WITH {DAILY}, {STATION}, rc AS (SELECT user_id, d, {TRUTH} AS truth, {", ".join(f"{s} AS {r}" for r, s in RECIPES_SQL.items())} FROM st),
v AS (SELECT user_id, d, truth, {UNION_SQL} AS votes FROM rc)
SELECT user_id, d, CASE WHEN len(votes) = 1 THEN votes[1] END AS score, len(votes) > 1 AS conflict FROM v""")
def union(spark, sf):
    value, conflict = ops.recipe_union(ops.STATION_RECIPES)
    return station(spark, sf).select("user_id", "d", value.alias("score"), conflict.alias("conflict"))


@query("i20_declared_probe", f"""
WITH {ORDERS}, g AS (SELECT o_custkey, day, count(*) AS k, max(o_orderkey) AS o_orderkey, arg_max(label, o_orderkey) AS last FROM o GROUP BY ALL),
l AS (SELECT *, day - lag(day) OVER v AS gap, lag(last) OVER v AS last_prior FROM g WINDOW v AS (PARTITION BY o_custkey ORDER BY day))
SELECT a.o_orderkey, CAST(b.last_prior AS DOUBLE) AS score FROM l a JOIN l b ON b.o_custkey = a.o_custkey AND b.day - CAST(b.gap AS INTEGER) = a.day WHERE a.k = 1""")
def declared(spark, sf):
    o = base.orders(spark, sf).select("o_custkey", "day", "o_orderkey", "label")
    p = history.strict_prior(
        o, ["o_custkey"], "day", {"last_prior": ("last", F.col("label"))}, tie="o_orderkey"
    )
    p = history.days_since_last(p, ["o_custkey"], "day", "gap", -1).drop("label")
    spec = {"entity": ["o_custkey"], "time": "day", "lag_column": "gap", "operation": "copy", "left": "last_prior"}
    return ops.declared_probe(p, p, spec, "o_orderkey")


def col(name):
    return {"op": "column", "name": name}


def const(v):
    return {"op": "constant", "value": v}


def call(op, *args):
    return {"op": op, "args": list(args)}


PROGRAMS = {
    "next_over": call("gt", {"op": "join", "keys": ["user_id"], "time": "day", "unit": "days", "offset": const(1), "value": col("c")}, const(LIMIT)),
    "user_sum": {"op": "group", "keys": ["user_id"], "aggregate": "sum", "value": col("c")},
    "only_n": {"op": "group", "keys": ["day"], "aggregate": "unique", "value": col("n")},
    "first_half": call("if", call("lt", call("number", {"op": "slice", "value": col("day"), "start": 8, "stop": 10}), const(16)), const(1), call("not", call("missing", col("day")))),
    "remainder": call("mod", call("sub", col("c"), const(10000)), const(7)),
    "recovered": call("rounded_count", col("n"), const(0.5), const(2)),
    "mixed_types": call("eq", col("day"), col("n")),
    "guarded": call("and", call("contains", col("day"), const("-0")), call("coalesce", const(None), call("le", col("n"), const(2)))),
}


@query("i21_attack_expression", f"""
WITH {DAILY}, x AS (SELECT *, DATE '1970-01-01' + CAST(d AS INTEGER) AS dd FROM p), u AS (SELECT d, CASE WHEN min(n) = max(n) THEN max(n) END AS un FROM p GROUP BY ALL)
SELECT x.user_id, strftime(dd, '%Y-%m-%d') AS day, CAST({fr("c", 1)} > {LIMIT} AS DOUBLE) AS next_over, CAST(sum(c) OVER (PARTITION BY user_id) AS DOUBLE) AS user_sum,
  CAST(un AS DOUBLE) AS only_n, 1e0 AS first_half, CAST((((c - 10000) % 7) + 7) % 7 AS DOUBLE) AS remainder,
  CASE WHEN ceil(n * 0.495) = floor(n * 0.505) THEN CAST(ceil(n * 0.495) AS DOUBLE) END AS recovered, 0e0 AS mixed_types,
  CAST(contains(strftime(dd, '%Y-%m-%d'), '-0') AND n <= 2 AS DOUBLE) AS guarded
FROM x JOIN u ON u.d = x.d""".replace("ORDER BY d RANGE", "ORDER BY x.d RANGE"))
def attack(spark, sf):
    panel = base.daily(spark, sf).select(
        "user_id", F.date_format(F.date_from_unix_date("d"), "yyyy-MM-dd").alias("day"), "n", "c"
    )
    run = Evaluator(panel, target="exceeds")
    for name, tree in PROGRAMS.items():
        run.add(name, tree)
    return run.result().drop("n", "c")


SCORES = f"""sc AS (SELECT doc_id, split, y, 'numeric:' || field AS probe, TRY_CAST(value AS DOUBLE) AS score FROM cells UNION ALL SELECT doc_id, split, y, 'absolute:' || field, abs(TRY_CAST(value AS DOUBLE)) FROM cells
  UNION ALL SELECT doc_id, split, y, 'length:' || field, CAST(length(value) AS DOUBLE) FROM cells UNION ALL SELECT doc_id, split, y, 'missing:' || field, CAST(value IN ('', '-1', 'NA', 'N/A', 'nan') AS DOUBLE) FROM cells),
ev AS (SELECT * FROM sc WHERE split <> 'train'), fu AS (SELECT * REPLACE (coalesce(score, 0.5) AS score) FROM ev),
ac AS ({auc_sql("ev", "probe, split")}), af AS ({auc_sql("fu", "probe, split")}),
nt AS (SELECT probe, split, count(*) AS n_rows, count(score) AS covered, CASE WHEN count(score) > 0 AND count(score) = count(*) FILTER (score IN (0, 1)) THEN count(*) FILTER (score <> y) END AS errors FROM ev GROUP BY ALL)"""


@query("i22_probe_scoring", f"""
WITH {LABELLED}, {CELLS}, {SCORES} SELECT nt.*, ac.auc AS auc_covered, af.auc AS auc_full,
  greatest(ac.auc, 1 - ac.auc) > 0.95 AS flagged FROM nt LEFT JOIN ac USING (probe, split) LEFT JOIN af USING (probe, split)""")
def probe_scoring(spark, sf):
    panel = cell_panel(spark, sf).where("split <> 'train'")
    scores = ops.cell_probes(panel, ["doc_id", "split"], COLUMNS)
    labels = base.labelled_documents(spark, sf).select("doc_id", "y")
    out = ops.score_probes(scores, labels, ["probe", "split"], "doc_id", "y")
    return out.withColumn("flagged", F.greatest("auc_covered", 1 - F.col("auc_covered")) > 0.95)


EXACT = list(RECIPES_SQL)
EXACT_SCORES = f"""rc AS (SELECT user_id, d, {TRUTH} AS truth, {", ".join(f"{q} AS {r}" for r, q in RECIPES_SQL.items())} FROM st),
lg AS (SELECT d, CASE WHEN d < 19733 THEN 'train' WHEN d < 19742 THEN 'eval' ELSE 'holdout' END AS split, truth, unnest({EXACT}) AS probe, unnest([{", ".join(EXACT)}]) AS score FROM rc WHERE truth IS NOT NULL)"""


@query("i22_exact_recipe_findings", f"""
WITH {DAILY}, {STATION}, {EXACT_SCORES}
SELECT probe, split, count(*) AS n_rows, count(score) AS covered, 'failure' AS finding FROM lg WHERE split <> 'train' GROUP BY ALL HAVING count(score) > 0 AND count(*) FILTER (score <> truth) = 0""")
def exact_findings(spark, sf):
    panel = station(spark, sf)
    truth = (history.at_offset("value", USER, "d", 1) > LIMIT).cast("bigint")
    split = F.when(F.col("d") < 19733, "train").when(F.col("d") < 19742, "eval").otherwise("holdout")
    rows = panel.select(
        F.struct("user_id", "d").alias("row_id"), split.alias("split"), truth.alias("y"),
        F.explode(F.array(*[F.struct(F.lit(r).alias("probe"), F.col(r).alias("score")) for r in EXACT])).alias("s"),
    )
    known = rows.where("split <> 'train' AND y IS NOT NULL")
    scores = known.select("row_id", "split", "s.probe", "s.score").withColumn("kind", F.lit("exact"))
    kept = ops.informative(scores, ["probe", "split"])
    labels = panel.select(F.struct("user_id", "d").alias("row_id"), truth.alias("y")).where("y IS NOT NULL")
    results = ops.score_probes(kept, labels, ["probe", "split", "kind"], "row_id", "y")
    return ops.findings(results).select("probe", "split", "n_rows", "covered", "finding")


@query("i23_freeze_then_score", f"""
WITH {LABELLED}, {CELLS}, {SCORES} SELECT nt.probe, nt.split, covered, ac.auc AS auc_covered, true AS sealed FROM nt LEFT JOIN ac USING (probe, split)""")
def freeze_then_score(spark, sf):
    from priorframe.sources.sinks import freeze_scores, sealed_scores

    panel = cell_panel(spark, sf).where("split <> 'train'")
    scores = ops.cell_probes(panel, ["doc_id", "split"], COLUMNS)
    path = scratch_dir(spark, "frozen-scores")
    seal = freeze_scores(scores, path, ["probe", "split"], target="y")
    frozen, intact = sealed_scores(spark, path, ["probe", "split"], seal)
    labels = base.labelled_documents(spark, sf).select("doc_id", "y")
    out = ops.score_probes(frozen, labels, ["probe", "split"], "doc_id", "y")
    return out.join(intact, ["probe", "split"]).select("probe", "split", "covered", "auc_covered", "sealed")


# A panel of (user, kind, day) with the label whether the next day's sum is high; one recipe reads that very day.
HIGH = 25000
BATTERY_PANEL = f"""bp AS (SELECT t.*, printf('%06d:%06d:%s', d, site_id, sector) AS row_key, CASE WHEN d < 19733 THEN 'train' WHEN d < 19742 THEN 'eval' ELSE 'holdout' END AS split
  FROM (SELECT user_id % 40 AS site_id, event_type AS sector, date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS d, count(*) AS prior_count, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS last_sum FROM events GROUP BY ALL) t),
bl AS (SELECT a.*, CAST(b.last_sum > {HIGH} AS BIGINT) AS y, CAST(b.last_sum > {HIGH} AS DOUBLE) AS told FROM bp a JOIN bp b ON b.site_id = a.site_id AND b.sector = a.sector AND b.d = a.d + 1)"""


def battery_panel(spark, sf):
    """The panel without labels, and its labels."""
    p = table(spark, sf, "events").groupBy(
        F.pmod("user_id", F.lit(40)).alias("site_id"), F.col("event_type").alias("sector"), history.day_number("ts").alias("d")
    ).agg(n_all().alias("prior_count"), F.sum(cents("value")).alias("last_sum"))
    split = F.when(F.col("d") < 19733, "train").when(F.col("d") < 19742, "eval").otherwise("holdout")
    p = p.select("*", F.format_string("%06d:%06d:%s", "d", "site_id", "sector").alias("row_key"), split.alias("split"))
    later = history.at_offset("last_sum", ["site_id", "sector"], "d", 1)
    rows = p.select("row_key", (later > HIGH).cast("bigint").alias("y")).where("y IS NOT NULL")
    return p, rows


def told(panel):
    """The next day's sum, read from the row that ships it."""
    later = history.at_offset("last_sum", ["site_id", "sector"], "d", 1)
    return panel.select("row_key", (later > HIGH).cast("double").alias("score"))


def battery_of(panel):
    from priorframe.operators.battery import Battery

    key_sets, operands = ops.successor_candidates(panel.drop("row_key"), "d")
    columns = ["site_id", "sector", "prior_count", "last_sum"]
    return Battery(panel, "y", "row_key", columns, "d", key_sets, operands, recipes={"told": ("exact", told)})


def _battery_sql():
    cols = ["site_id", "sector", "prior_count", "last_sum"]
    text = {c: f"CAST({c} AS VARCHAR)" for c in cols}
    q, out = "x.*", []
    row = lambda probe, kind, scope, score, keeps, source="sb x": out.append(f"SELECT '{probe}' AS probe, '{kind}' AS kind, '{scope}' AS scope, x.split, x.y, {keeps} AS keeps, {score} AS score FROM {source}")
    for c in cols:
        row(f"numeric:{c}", "statistical", "", f"TRY_CAST(x.{c} AS DOUBLE)", "false")
        row(f"absolute:{c}", "statistical", "", f"abs(TRY_CAST(x.{c} AS DOUBLE))", "false")
        row(f"length:{c}", "statistical", "", f"CAST(length(CAST(x.{c} AS VARCHAR)) AS DOUBLE)", "false")
        row(f"missing:{c}", "statistical", "", f"CAST(CAST(x.{c} AS VARCHAR) IN ('', '-1', 'NA', 'N/A', 'nan') AS DOUBLE)", "false")
        rank = f"(SELECT value, CAST(row_number() OVER (ORDER BY value) - 1 AS DOUBLE) AS score FROM (SELECT DISTINCT {text[c]} AS value FROM bp)) r"
        row(f"lexical:{c}", "statistical", "", "r.score", "false", f"sb x JOIN {rank} ON r.value = CAST(x.{c} AS VARCHAR)")
    row("row_order", "statistical", "", "ro.score", "false", "sb x JOIN (SELECT row_key, CAST(row_number() OVER (PARTITION BY split ORDER BY row_key) - 1 AS DOUBLE) AS score FROM bp) ro USING (row_key)")
    row("told", "exact", "", "x.told", "true")
    for s in [(c,) for c in cols] + [(a, b) for i, a in enumerate(cols) for b in cols[i + 1 :]]:
        name, on = "+".join(s), " AND ".join(f"t.{c} = x.{c}" for c in s)
        source = f"sb x LEFT JOIN (SELECT {', '.join(s)}, count(*) AS n, coalesce(sum(y), 0) AS yes FROM bp LEFT JOIN (SELECT row_key, y FROM bl) USING (row_key) WHERE split = 'train' GROUP BY ALL) t ON {on}"
        row(f"lookup:{name}", "supervised", "", "CAST(t.yes AS DOUBLE) / t.n", "false", source)
        row(f"lookup_unanimous:{name}", "supervised", "", "CASE WHEN t.n >= 2 AND t.yes IN (0, t.n) THEN CAST(t.yes AS DOUBLE) / t.n END", "true", source)
    for keys in (["sector"], ["site_id"], ["sector", "site_id"]):
        name, on = "+".join(keys), " AND ".join(f"g.{c} = x.{c}" for c in keys)
        for scope in ("self", "all"):
            pool = ", split" if scope == "self" else ""
            grouped = f"(SELECT {', '.join(keys)}, d{pool}, max(prior_count) AS prior_count, max(last_sum) AS last_sum FROM bp GROUP BY ALL HAVING count(*) = 1)"
            same = " AND g.split = x.split" if scope == "self" else ""
            for offset in (1, 2, 7, 30, 365, 366):
                for v in ("last_sum", "prior_count"):
                    row(f"{scope}:explore:{name}:{offset}:{v}", "heuristic", scope, f"CAST(g.{v} AS DOUBLE)", "false", f"sb x LEFT JOIN {grouped} g ON {on}{same} AND g.d = x.d + {offset}")
            for offset in (365, 366):
                own = on.replace("g.", "h.") + same.replace("g.", "h.")
                row(f"{scope}:quasi_successor:{name}:{offset}", "heuristic", scope, "CASE WHEN g.d IS NOT NULL AND h.d IS NOT NULL THEN 0e0 END", "true",
                    f"sb x LEFT JOIN {grouped} g ON {on}{same} AND g.d = x.d + {offset} LEFT JOIN {grouped} h ON {own} AND h.d = x.d")
    return " UNION ALL ".join(out)


BATTERY_SQL = f"""
WITH {BATTERY_PANEL}, sb AS (SELECT * FROM bl WHERE split <> 'train'), v AS ({_battery_sql()}), vf AS (SELECT * REPLACE (coalesce(score, 0.5) AS score) FROM v),
ac AS ({auc_sql("v", "probe, split")}), af AS ({auc_sql("vf", "probe, split")}),
nt AS (SELECT probe, any_value(kind) AS kind, any_value(scope) AS scope, split, count(*) AS n_rows, count(score) AS covered, count(DISTINCT score) AS levels, any_value(keeps) AS keeps,
  CASE WHEN count(score) > 0 AND count(score) = count(*) FILTER (score IN (0, 1)) THEN count(*) FILTER (score <> y) END AS errors FROM v GROUP BY probe, split),
rp AS (SELECT nt.probe, kind, scope, nt.split, n_rows, covered, errors, ac.auc AS auc_covered, af.auc AS auc_full, true AS sealed,
  CASE WHEN covered = 0 OR (levels <= 1 AND NOT keeps) THEN 'skipped' WHEN kind = 'exact' AND errors = 0 THEN 'failure' WHEN kind <> 'exact' AND greatest(ac.auc, 1 - ac.auc) > 0.95 THEN 'flag' END AS finding
  FROM nt LEFT JOIN ac ON ac.probe = nt.probe AND ac.split = nt.split LEFT JOIN af ON af.probe = nt.probe AND af.split = nt.split)"""


@query("i22_battery_report", f"{BATTERY_SQL} SELECT * FROM rp")
def battery_report(spark, sf):
    panel, labels = battery_panel(spark, sf)
    panel = written_once(panel, "battery-panel")
    run, path = battery_of(panel), scratch_dir(spark, "battery")
    train = panel.where("split = 'train'").select("row_key").join(labels, "row_key")
    _, seal = run.freeze(train, path)
    return run.report(path, seal, labels)


@query("i6_successor_scopes", f"""{BATTERY_SQL} SELECT scope, split, probe, n_rows, covered, auc_covered FROM rp WHERE kind = 'heuristic' AND scope <> ''""")
def successor_scopes(spark, sf):
    from priorframe.operators import battery
    from priorframe.operators.ranked import ranked_auc

    panel, labels = battery_panel(spark, sf)
    panel = written_once(panel, "battery-panel")
    run = battery_of(panel)
    scores = battery.successors(panel, "d", run.key_sets, run.operands, run.offsets, run.quasi)
    keys = F.filter(run.keys(), lambda k: F.startswith(k["family"], F.lit("successor:")))
    long = panel.join(labels, "row_key").where("split <> 'train'").select("split", "y", F.explode(keys).alias("_k")).select("split", "y", "_k.*")
    classes = long.groupBy("family", "split", "key").agg(F.sum("y").alias("_pos"), F.sum(1 - F.col("y")).alias("_neg"))
    values = scores.join(classes, ["family", "split", "key"]).select("family", "split", "_pos", "_neg", F.posexplode("scores").alias("at", "score"))
    levels = written_once(values.groupBy("family", "split", "at", "score").agg(F.sum("_pos").alias("_pos"), F.sum("_neg").alias("_neg")), "scope-scores")
    n = F.col("_pos") + F.col("_neg")
    totals = levels.groupBy("family", "split", "at").agg(F.sum(n).alias("n_rows"), F.coalesce(F.sum(F.when(F.col("score").isNotNull(), n)), F.lit(0)).alias("covered"))
    aucs = ranked_auc(levels, ["family", "split", "at"], "score", "auc_covered")
    named = run.named(spark).where("scope <> ''")
    return totals.join(aucs, ["family", "split", "at"], "left").join(named, ["family", "at"]).select("scope", "split", "probe", "n_rows", "covered", "auc_covered")


@query("i9_lookup_levels", f"""
WITH {LABELLED}, {BANDED} SELECT probe, split, CAST(p AS DOUBLE) / n AS rate, coalesce(n >= 2 AND p IN (0, n), false) AS unanimous, count(*) AS n_rows FROM ks LEFT JOIN tr USING (probe, key) WHERE split <> 'train' GROUP BY ALL""")
def lookup_levels(spark, sf):
    return ops.lookup_cube(banded(spark, sf), "split", "y", ["lang", "source", "band"])


MARKED = r"""mk AS (SELECT doc_id, CASE WHEN doc_id % 6 = 0 THEN text || chr(10) || 'row doc-' || doc_id || ' seen 1999-0' || (1 + doc_id % 9) || '-15' || chr(10) || chr(10) || 'label = 1' || chr(10) || 'tail' ELSE text END AS text FROM documents)"""


def marked(spark, sf):
    k = F.col("doc_id")
    tail = F.concat(
        F.lit("\nrow doc-"), k.cast("string"), F.lit(" seen 1999-0"), (1 + F.pmod(k, F.lit(9))).cast("string"),
        F.lit("-15\n\nlabel = 1\ntail"),
    )
    text = F.when(F.pmod(k, F.lit(6)) == 0, F.concat("text", tail)).otherwise(F.col("text"))
    return table(spark, sf, "documents").select("doc_id", text.alias("text"))


@query("i24_dated_outcome_text", rf"""
WITH {MARKED}, l AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM mk), x AS (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS line FROM l),
c AS (SELECT doc_id, line, lines[line] AS t, array_to_string(lines[greatest(line - 2, 1):least(line + 3, len(lines))], ' ') AS context FROM x),
h AS (SELECT * FROM c WHERE regexp_matches(context, '(?i)\b(label|target|outcome|expected_verdict)\s*[=:]?\s*[`"'']?[01]\b|(->|→)\s*[01]\b')),
tk AS (SELECT doc_id, line, unnest(regexp_extract_all(t, '([\p{{L}}\p{{N}}_:./-]+)', 1)) AS id FROM h),
dt AS (SELECT doc_id, line, unnest(regexp_extract_all(t, '\b((?:19|20)\d{{2}}-\d{{2}}-\d{{2}})\b', 1)) AS day FROM h)
SELECT doc_id, line, EXISTS (SELECT 1 FROM dt WHERE dt.doc_id = h.doc_id AND dt.line = h.line AND day >= '1999-03-01' AND day < '1999-06-01') AS scored_date,
  EXISTS (SELECT 1 FROM tk JOIN labels lb ON 'doc-' || lb.doc_id = tk.id WHERE tk.doc_id = h.doc_id AND tk.line = h.line) AS scored_id FROM h""")
def dated_outcome(spark, sf):
    found = ops.dated_outcomes(marked(spark, sf), "doc_id", "text", [("1999-03-01", "1999-06-01")])
    ids = table(spark, sf, "labels").select(F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("id"))
    return ops.scored_id_lines(found, ids, "doc_id")


# Fixed value: forms of an identifier in a text.
IDENTIFIER = r"\b(\d{1,4}-[A-Za-z0-9-]{5,}|[A-Z]{2,8}\d{3,}|\d{4}-\d{2}-\d{2})\b"


@query("i25_pattern_scan", rf"""
WITH {MARKED}, t AS (SELECT doc_id, text || CASE WHEN doc_id % 8 = 1 THEN ' @@SALT_' || doc_id || '@@ and @@Name@@' ELSE '' END AS text FROM mk),
r AS (SELECT doc_id, 'placeholder' AS rule, len(list_distinct(regexp_extract_all(text, '(@@[A-Za-z][A-Za-z0-9_]*@@)', 1))) AS matches FROM t
  UNION ALL SELECT doc_id, 'identifier', len(list_distinct(regexp_extract_all(text, '\b(\d{{1,4}}-[A-Za-z0-9-]{{5,}}|[A-Z]{{2,8}}\d{{3,}}|\d{{4}}-\d{{2}}-\d{{2}})\b', 1))) FROM t)
SELECT doc_id, rule, matches FROM r WHERE matches > 0""")
def pattern_scan(spark, sf):
    k = F.col("doc_id")
    extra = F.when(F.pmod(k, F.lit(8)) == 1, F.concat(F.lit(" @@SALT_"), k.cast("string"), F.lit("@@ and @@Name@@"))).otherwise("")
    d = marked(spark, sf).select("doc_id", F.concat("text", extra).alias("text"))
    return ops.pattern_scan(d, "doc_id", "text", {"placeholder": ops.PLACEHOLDER, "identifier": IDENTIFIER})

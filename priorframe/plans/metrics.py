"""J: metrics and uncertainty."""

from pyspark.sql import functions as F

from priorframe.operators import metrics as ops
from priorframe.operators.predictors import keyed_prior
from priorframe.plans import base
from priorframe.plans.base import LABELLED, ORDERS, auc_sql
from priorframe.plans.registry import query

RATED = """sr AS (SELECT source, CAST(sum(y) AS DOUBLE) / count(*) AS rate FROM ld WHERE split = 'train' GROUP BY ALL),
pr AS (SELECT avg(CAST(y AS DOUBLE)) AS prior FROM ld WHERE split = 'train'),
lr AS (SELECT ld.doc_id, ld.split, ld.lang, ld.source, ld.y, ld.n_chars, toxic + 1 AS wt, coalesce(rate, prior) AS score
  FROM ld JOIN labels USING (doc_id) LEFT JOIN sr USING (source) CROSS JOIN pr)"""


def rated(spark, sf):
    from priorframe.sources.tables import table

    d = base.labelled_documents(spark, sf).drop("text")
    w = table(spark, sf, "labels").select("doc_id", (F.col("toxic") + 1).alias("wt"))
    return keyed_prior(d, ["source"], "y").join(w, "doc_id")


@query("j1_rank_auc", f"""WITH {LABELLED}, {RATED}, a AS ({auc_sql("lr", "split", "n_chars")}) SELECT * FROM a""")
def rank_auc(spark, sf):
    return ops.rank_auc(rated(spark, sf), ["split"], "n_chars", "y")


@query("j2_weighted_auc", f"""
WITH {LABELLED}, {RATED}, g AS (SELECT split, score, sum(wt * y) AS pos, sum(wt * (1 - y)) AS neg FROM lr GROUP BY ALL),
b AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY split ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g)
SELECT split, CAST(sum(pos * (2 * below + neg)) AS DOUBLE) / 2 / (sum(pos) * sum(neg)) AS auc FROM b GROUP BY ALL""")
def weighted_auc(spark, sf):
    return ops.rank_auc(rated(spark, sf), ["split"], "score", "y", weight="wt")


@query("j3_average_precision", f"""
WITH {LABELLED}, {RATED}, g AS (SELECT split, score, sum(y) AS pos, count(*) AS n FROM lr GROUP BY ALL),
c AS (SELECT *, sum(pos) OVER w AS tp, sum(n) OVER w AS seen FROM g WINDOW w AS (PARTITION BY split ORDER BY score DESC))
SELECT split, round(sum(CAST(tp AS DOUBLE) / seen * pos) / sum(pos), 9) AS average_precision FROM c GROUP BY ALL""")
def average_precision(spark, sf):
    out = ops.average_precision(rated(spark, sf), ["split"], "score", "y")
    return out.withColumn("average_precision", F.round("average_precision", 9))


@query("j4_brier", f"""
WITH {LABELLED}, {RATED} SELECT split, round(avg(pow(score - y, 2)), 9) AS brier FROM lr GROUP BY ALL""")
def brier(spark, sf):
    return rated(spark, sf).groupBy("split").agg(F.round(ops.brier("score", "y"), 9).alias("brier"))


@query("j5_accuracy_majority", f"""
WITH {LABELLED}, {RATED}, m AS (SELECT CAST(avg(y) >= 0.5 AS BIGINT) AS major FROM ld WHERE split = 'train')
SELECT split, count(*) FILTER ((score >= 0.85) = (y = 1)) / CAST(count(*) AS DOUBLE) AS accuracy, count(*) FILTER (y = major) / CAST(count(*) AS DOUBLE) AS majority_accuracy FROM lr, m GROUP BY ALL""")
def accuracy(spark, sf):
    d = rated(spark, sf)
    major = d.where("split = 'train'").agg((F.avg("y") >= 0.5).cast("bigint")).scalar()
    share = lambda c: F.avg(c.cast("double"))
    return d.withColumn("major", major).groupBy("split").agg(
        share((F.col("score") >= 0.85) == (F.col("y") == 1)).alias("accuracy"),
        share(F.col("y") == F.col("major")).alias("majority_accuracy"),
    )


ORDER_PRIOR = """rt AS (SELECT o_orderpriority, CAST(sum(label) AS DOUBLE) / count(*) AS score FROM o WHERE split = 'train' GROUP BY ALL),
os AS (SELECT o.*, score FROM o JOIN rt USING (o_orderpriority))"""


@query("j6_binned_by_year", f"""
WITH {ORDERS}, {ORDER_PRIOR}, a AS ({auc_sql("os", "year", "score", "label")})
SELECT year, count(*) AS n_rows, CAST(sum(label) AS DOUBLE) / count(*) AS rate, any_value(auc) AS auc, round(avg(pow(score - label, 2)), 9) AS brier FROM os JOIN a USING (year) GROUP BY ALL""")
def by_year(spark, sf):
    o = keyed_prior(base.orders(spark, sf), ["o_orderpriority"], "label")
    auc = ops.rank_auc(o, ["year"], "score", "label")
    return o.groupBy("year").agg(
        F.count(F.lit(1)).alias("n_rows"), F.avg(F.col("label").cast("double")).alias("rate"),
        F.round(ops.brier("score", "label"), 9).alias("brier"),
    ).join(auc, "year")


def weight_sql(cluster, r):
    h1 = f"((({cluster}) % 2147483648) * 1640531527 + {r} * 374761393) % 4294967296"
    h2 = f"(xor({h1}, ({h1}) >> 15) * 668265263) % 4294967296"
    u = f"xor({h2}, ({h2}) >> 13) / 4294967296e0"
    steps = [0.367879441, 0.735758882, 0.919698603, 0.981011843, 0.996340153, 0.999405815, 0.999916759]
    return "CASE " + " ".join(f"WHEN {u} < {p}::DOUBLE THEN {k}" for k, p in enumerate(steps)) + f" ELSE {len(steps)} END"


def draws_sql(cluster, sides, resamples):
    parts = " UNION ALL ".join(f"SELECT {cluster} AS cl, y, '{n}' AS side, CAST({c} AS DOUBLE) AS score FROM lr" for n, c in sides.items())
    return f"""cells AS ({parts}), dr AS (SELECT r, side, score, y, CAST({weight_sql("cl", "r")} AS BIGINT) AS w FROM cells, (SELECT unnest(range(1, {resamples + 1})) AS r)),
g AS (SELECT r, side, score, sum(w * y) AS pos, sum(w * (1 - y)) AS neg FROM dr WHERE w > 0 GROUP BY ALL),
b AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY r, side ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g),
au AS (SELECT r, side, CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN CAST(sum(pos * (2 * below + neg)) AS DOUBLE) / 2 / (sum(pos) * sum(neg)) END AS auc FROM b GROUP BY ALL)"""


def paired_sql(cluster, resamples):
    return f"""
WITH {LABELLED}, {RATED}, {draws_sql(cluster, {"a": "n_chars", "b": "score"}, resamples)},
d AS (SELECT r, max(auc) FILTER (side = 'a') - max(auc) FILTER (side = 'b') AS d FROM au GROUP BY ALL),
q AS (SELECT quantile_cont(d, 0.025) AS low, quantile_cont(d, 0.975) AS high, count(d) AS resamples FROM d),
oa AS ({auc_sql("lr", "", "n_chars")}), ob AS ({auc_sql("lr", "", "score")})
SELECT round(oa.auc - ob.auc, 9) AS observed, round(low, 9) AS low, round(high, 9) AS high, resamples, CASE WHEN low > 0 THEN 'positive' WHEN high < 0 THEN 'negative' ELSE 'inconclusive' END AS direction FROM q, oa, ob"""


def rounded(df, *columns):
    return df.withColumns({c: F.round(c, 9) for c in columns})


@query("j7_paired_cluster_bootstrap", paired_sql("doc_id % 40", 200))
def cluster_bootstrap(spark, sf):
    d = rated(spark, sf).withColumn("cluster", F.pmod("doc_id", F.lit(40)))
    return rounded(ops.paired_interval(d, "cluster", "n_chars", "score", "y", 200), "observed", "low", "high")


@query("h19_interval_claim", f"""
SELECT 'interval' AS kind, printf('AUC difference (n_chars minus score): %+.6f; 95%% interval [%+.6f, %+.6f] (%d resamples). Direction: %s.', observed, low, high, resamples, direction) AS claim
FROM ({paired_sql("doc_id % 40", 100)})""")
def interval_claim(spark, sf):
    d = rated(spark, sf).withColumn("cluster", F.pmod("doc_id", F.lit(40)))
    interval = rounded(ops.paired_interval(d, "cluster", "n_chars", "score", "y", 100), "observed", "low", "high")
    return ops.interval_claim(interval, "n_chars", "score")


@query("j8_paired_row_bootstrap", paired_sql("doc_id", 100))
def row_bootstrap(spark, sf):
    return rounded(ops.paired_interval(rated(spark, sf), "doc_id", "n_chars", "score", "y", 100), "observed", "low", "high")


@query("j9_one_sample_bootstrap", f"""
WITH {LABELLED}, {RATED}, {draws_sql("doc_id % 40", {"a": "n_chars"}, 200)}, oa AS ({auc_sql("lr", "", "n_chars")})
SELECT round(any_value(oa.auc), 9) AS observed, round(quantile_cont(au.auc, 0.025), 9) AS low, round(quantile_cont(au.auc, 0.975), 9) AS high, count(au.auc) AS resamples FROM au, oa""")
def one_sample(spark, sf):
    d = rated(spark, sf).withColumn("cluster", F.pmod("doc_id", F.lit(40)))
    return rounded(ops.one_sample_interval(d, "cluster", "n_chars", "y", 200), "observed", "low", "high")


@query("j10_linear_percentile", f"""
WITH {ORDERS} SELECT split, round(quantile_cont(cents, 0.9), 4) AS p90 FROM o GROUP BY ALL""")
def percentile(spark, sf):
    out = ops.linear_percentile(base.orders(spark, sf), ["split"], "cents", 0.9, "p90")
    return out.withColumn("p90", F.round("p90", 4))


@query("j11_eval_holdout_gap", f"""
WITH {LABELLED}, {RATED}, a AS ({auc_sql("lr", "split", "n_chars")}), {draws_sql("doc_id", {"a": "n_chars"}, 5)}
SELECT (SELECT auc FROM a WHERE split = 'eval') AS eval_auc, (SELECT auc FROM a WHERE split = 'holdout') AS holdout_auc,
  round((SELECT auc FROM a WHERE split = 'eval') - (SELECT auc FROM a WHERE split = 'holdout'), 9) AS gap, (SELECT round(stddev_samp(auc), 9) FROM au) AS seed_sd""")
def gap(spark, sf):
    d = rated(spark, sf)
    auc = ops.rank_auc(d, ["split"], "n_chars", "y")
    at = lambda s: F.max(F.when(F.col("split") == s, F.col("auc")))
    draws = ops.bootstrap_auc(d, "doc_id", {"a": "n_chars"}, "y", 5).where("resample > 0")
    sd = draws.agg(F.round(F.stddev_samp("auc"), 9)).scalar()
    return auc.agg(
        at("eval").alias("eval_auc"), at("holdout").alias("holdout_auc"), F.round(at("eval") - at("holdout"), 9).alias("gap")
    ).withColumn("seed_sd", sd)


@query("j12_information_set_perturbation", f"""
WITH {LABELLED}, m AS (SELECT split, n_chars, row_number() OVER (PARTITION BY split ORDER BY doc_id) - 1 AS place, count(*) OVER (PARTITION BY split) AS size FROM ld)
SELECT a.split, count(*) AS compared, CAST(0 AS BIGINT) AS changed, count(*) FILTER (a.n_chars <> b.n_chars) AS control_changed,
  CAST(sum(a.n_chars) AS BIGINT) AS n_chars_before, CAST(sum(b.n_chars) AS BIGINT) AS n_chars_after
FROM m a JOIN m b ON b.split = a.split AND b.place = (CAST(a.place AS HUGEINT) * {ops.STRIDES[5]} + 5 * 7919) % a.size GROUP BY a.split""")
def perturbation(spark, sf):
    d = base.labelled_documents(spark, sf).select("doc_id", "split", "source", "y", "n_chars", "lang")
    moved = ops.permuted_within(d, "split", "doc_id", ["n_chars", "lang"], 5)
    score = lambda x: keyed_prior(x, ["source"], "y").select("doc_id", "split", "score")
    # The control reads a permuted column, so its scores must change.
    control = lambda x: x.select("doc_id", "split", F.col("n_chars").alias("score"))
    changes = lambda f, n: f(d).exceptAll(f(moved)).groupBy("split").agg(F.count(F.lit(1)).alias(n))
    size = lambda x, n: x.groupBy("split").agg(F.count(F.lit(1)).alias("compared"), F.sum("n_chars").alias(n))
    return (
        size(d, "n_chars_before").join(size(moved, "n_chars_after").drop("compared"), "split")
        .join(changes(score, "changed"), "split", "left").join(changes(control, "control_changed"), "split", "left")
        .fillna(0, ["changed", "control_changed"])
    )


@query("j13_key_coverage", f"""
WITH {LABELLED}, k AS (SELECT DISTINCT lang, source FROM ld WHERE split = 'train')
SELECT split, count(*) AS scored, count(k.lang) AS with_train_key, 1 - count(k.lang) / CAST(count(*) AS DOUBLE) AS fallback_share
FROM ld LEFT JOIN k ON k.lang = ld.lang AND k.source = ld.source WHERE split <> 'train' GROUP BY ALL""")
def key_coverage(spark, sf):
    d = base.labelled_documents(spark, sf).select("split", "lang", "source")
    k = d.where("split = 'train'").select("lang", "source", F.lit(True).alias("hit")).distinct()
    return d.where("split <> 'train'").join(k, ["lang", "source"], "left").groupBy("split").agg(
        F.count(F.lit(1)).alias("scored"), F.count("hit").alias("with_train_key"),
        (1 - F.try_divide(F.count("hit"), F.count(F.lit(1)))).alias("fallback_share"),
    )

"""M: catalogue reports and the user-function surface."""

from pyspark.sql import functions as F

from priorframe.functions.text import excerpt_match
from priorframe.operators import reports as ops
from priorframe.operators.history import at_offset
from priorframe.operators.predictors import user_predictor
from priorframe.operators.probes import run_recipes
from priorframe.plans import base
from priorframe.plans.base import DAILY, LABELLED
from priorframe.plans.probes import SPLIT_DAILY, split_daily
from priorframe.plans.registry import query
from priorframe.sources.tables import table


@query("m1_licence_ranked_queue", """
WITH q AS (SELECT s_suppkey, n_name, CASE s_nationkey % 5 WHEN 0 THEN 'open' WHEN 1 THEN 'attribution' WHEN 2 THEN 'share_alike' WHEN 3 THEN 'restricted' ELSE 'unknown' END AS licence, s_acctbal > 0 AS buildable FROM supplier JOIN nation ON s_nationkey = n_nationkey),
r AS (SELECT *, CASE licence WHEN 'open' THEN 0 WHEN 'attribution' THEN 1 WHEN 'share_alike' THEN 2 WHEN 'restricted' THEN 3 ELSE 4 END AS rank FROM q)
SELECT licence, rank, count(*) AS n, count(*) FILTER (buildable) AS n_buildable, count(*) FILTER (rank >= 3) AS n_blocked, arg_min(s_suppkey, (NOT buildable, s_suppkey)) AS next_id FROM r GROUP BY ALL""")
def ranked_queue(spark, sf):
    k = F.pmod("s_nationkey", F.lit(5))
    licence = F.when(k == 0, "open").when(k == 1, "attribution").when(k == 2, "share_alike").when(k == 3, "restricted").otherwise("unknown")
    s = table(spark, sf, "supplier").withColumn("licence", licence)
    queue = ops.ranked_queue(s, "licence", ["open", "attribution", "share_alike", "restricted"], F.col("s_acctbal") > 0, "s_suppkey")
    nxt = queue.groupBy("licence").agg(F.min_by("s_suppkey", F.struct(~F.col("buildable"), "s_suppkey")).alias("next_id"))
    return ops.queue_summary(queue, "licence", F.col("rank") >= 3).join(nxt, "licence")


NORMAL = r"regexp_replace(trim(regexp_replace({}, '[ \t\r\n]+', ' ', 'g'), ' '), '\s+([,;:.!?])', '\1', 'g')"


@query("m2_excerpt_match", rf"""
WITH n AS (SELECT count(*) AS n FROM benchmark), b AS (SELECT row_number() OVER (ORDER BY item_id) - 1 AS k, text AS passage FROM benchmark),
x AS (SELECT doc_id, d.text, CASE doc_id % 3 WHEN 0 THEN substr(d.text, 5, 40) || ' ... ' || substr(d.text, 60, 30) WHEN 1 THEN substr(d.text, 60, 30) || ' ... ' || substr(d.text, 5, 40) ELSE passage END AS excerpt
  FROM documents d, n JOIN b ON b.k = d.doc_id % n.n),
y AS (SELECT doc_id, {NORMAL.format("text")} AS t, {NORMAL.format("excerpt")} AS e FROM x),
z AS (SELECT *, list_filter(list_transform(regexp_split_to_array(e, '\.{{3}}|…'), lambda s: trim(s, ' ')), lambda s: length(s) > 0) AS sp FROM y),
w AS (SELECT *, strpos(t, sp[1]) AS p1 FROM z)
SELECT doc_id, CASE WHEN length(e) > 0 AND contains(t, e) THEN 'contiguous'
  WHEN len(sp) = 2 AND p1 > 0 AND strpos(substr(t, p1 + length(sp[1])), sp[2]) > 0 THEN 'ordered-spans' END AS match FROM w""")
def excerpts(spark, sf):
    from priorframe.operators.ordering import row_positions

    d = table(spark, sf, "documents").select("doc_id", "text")
    passages = row_positions(table(spark, sf, "benchmark"), [], "item_id", "_at").select(
        (F.col("_at") - 1).alias("k"), F.col("text").alias("passage")
    )
    n = table(spark, sf, "benchmark").agg(F.count(F.lit(1))).scalar()
    cut = lambda a, b: F.substring("text", a, b)
    k = F.pmod("doc_id", F.lit(3))
    excerpt = (
        F.when(k == 0, F.concat(cut(5, 40), F.lit(" ... "), cut(60, 30)))
        .when(k == 1, F.concat(cut(60, 30), F.lit(" ... "), cut(5, 40))).otherwise(F.col("passage"))
    )
    return d.withColumn("k", F.pmod(F.col("doc_id"), n)).join(passages, "k").select(
        "doc_id", excerpt_match(F.col("text"), excerpt).alias("match")
    )


@query("m4_user_predictor", """
SELECT doc_id, round(1 / (1 + exp((1000 - n_chars) / 500e0)), 6) AS score FROM documents""")
def predictor(spark, sf):
    def predict(frame):
        import numpy as np

        return 1 / (1 + np.exp((1000 - frame["n_chars"]) / 500.0))

    d = table(spark, sf, "documents").select("doc_id", "n_chars")
    return user_predictor(d, predict, ["n_chars"]).select("doc_id", F.round("score", 6).alias("score"))


@query("m5_user_recipes", f"""
WITH {DAILY}, {SPLIT_DAILY}, x AS (SELECT a.*, b.c AS nxt FROM sd a LEFT JOIN sd b ON b.user_id = a.user_id AND b.d = a.d + 1), r AS (
  SELECT 'next_value_over' AS probe, 'exact' AS kind, split, CAST(nxt > 20000 AS DOUBLE) AS score FROM x UNION ALL SELECT 'own_count', 'statistical', split, CAST(n AS DOUBLE) FROM x)
SELECT probe, kind, split, count(*) AS n_rows, count(score) AS covered, sum(score) AS total FROM r GROUP BY ALL""")
def recipes(spark, sf):
    panel = split_daily(spark, sf).withColumn("row_id", F.struct("user_id", "d"))

    def next_value_over(p):
        return p.withColumn("score", (at_offset("c", ["user_id"], "d", 1) > 20000).cast("double"))

    def own_count(p):
        return p.withColumn("score", F.col("n"))

    long = run_recipes(panel, {"next_value_over": ("exact", next_value_over), "own_count": ("statistical", own_count)})
    return long.groupBy("probe", "kind", "split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("score").alias("covered"), F.sum("score").alias("total")
    )

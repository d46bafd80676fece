"""Shared frames of the registered queries, and the same frames as SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from priorframe.functions.text import word_tokens
from priorframe.operators.splits import half_open
from priorframe.sources.tables import table

SPLITS = [("train", None, "1999-01-01"), ("eval", "1999-01-01", "2000-01-01"),
          ("holdout", "2000-01-01", None)]


def cents(c: str | Column) -> Column:
    """Two-decimal money as whole cents, so that sums are exact in any order."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c * 100).cast("bigint")


def text(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.date_format(c, "yyyy-MM-dd")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    day = F.col("o_orderdate").cast("date")
    return o.select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        "o_orderpriority",
        cents("o_totalprice").alias("cents"),
        day.alias("day"),
        F.year(day).cast("bigint").alias("year"),
        half_open(day, SPLITS).alias("split"),
        (F.col("o_orderstatus") == "F").cast("bigint").alias("label"),
    )


ORDERS = """o AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority,
         CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
         CAST(o_orderdate AS DATE) AS day, year(o_orderdate) AS year,
         CASE WHEN o_orderdate < DATE '1999-01-01' THEN 'train'
              WHEN o_orderdate < DATE '2000-01-01' THEN 'eval' ELSE 'holdout' END AS split,
         CAST(o_orderstatus = 'F' AS BIGINT) AS label
  FROM orders)"""


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User-day panel of the events, gaps left absent."""
    e = table(spark, sf_dir, "events")
    return e.groupBy("user_id", F.unix_date(F.col("ts").cast("date")).alias("d")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(cents("value")).alias("c"),
        F.max(cents("value")).alias("peak"),
    )


DAILY = """p AS (
  SELECT user_id, date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS d, count(*) AS n,
         CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS c,
         max(CAST(round(value * 100) AS BIGINT)) AS peak
  FROM events GROUP BY ALL)"""


def monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per nation and month."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    month = (F.year("o_orderdate") * 12 + F.month("o_orderdate") - 1).cast("bigint")
    return (
        o.join(c, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(F.col("c_nationkey").alias("nation"), month.alias("m"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(cents("o_totalprice")).alias("c"))
    )


MONTHLY = """mo AS (
  SELECT c_nationkey AS nation, CAST(year(o_orderdate) * 12 + month(o_orderdate) - 1 AS BIGINT) AS m,
         count(*) AS n, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS c
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)"""


def _document_split():
    return (
        F.when(F.pmod("doc_id", F.lit(3)) == 0, "eval")
        .when(F.pmod("doc_id", F.lit(3)) == 1, "holdout")
        .otherwise("train")
    )


def split_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; thirds by id are train, eval and holdout."""
    return table(spark, sf_dir, "documents").withColumn("split", _document_split())


SPLIT_DOCUMENTS = """sd AS (
  SELECT *, CASE doc_id % 3 WHEN 0 THEN 'eval' WHEN 1 THEN 'holdout' ELSE 'train' END AS split FROM documents)"""


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a quality label; thirds by id are train, eval and holdout."""
    y = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("bigint").alias("y"))
    return split_documents(spark, sf_dir).join(y, "doc_id")


LABELLED = """ld AS (
  SELECT d.*, CAST(quality AS BIGINT) AS y,
         CASE d.doc_id % 3 WHEN 0 THEN 'eval' WHEN 1 THEN 'holdout' ELSE 'train' END AS split
  FROM documents d JOIN labels USING (doc_id))"""


def document_tokens(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "split", "y", F.explode(word_tokens(F.col("text"))).alias("token"))


# AUC in SQL over a relation s(grp..., score, y) with ties averaged, as a window free self sum.
def auc_sql(source: str, group: str, score: str = "score", y: str = "y") -> str:
    by = f"{group}, " if group else ""
    part = f"PARTITION BY {group}" if group else ""
    sel = f"{group}, " if group else ""
    return f"""
  SELECT {sel}CASE WHEN sum(pos) > 0 AND sum(neg) > 0
      THEN CAST(sum(pos * (2 * below + neg)) AS DOUBLE) / 2 / (sum(pos) * sum(neg)) END AS auc
  FROM (SELECT *, coalesce(sum(neg) OVER ({part} ORDER BY score
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
        FROM (SELECT {by}{score} AS score, sum({y}) AS pos, sum(1 - {y}) AS neg
              FROM {source} WHERE {score} IS NOT NULL GROUP BY ALL))
  {"GROUP BY " + group if group else ""}"""

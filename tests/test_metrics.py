"""Rank metrics against brute force, and interval symmetry."""

import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from priorframe.functions.numbers import decimal_comma_number, lenient_number, rounded_count
from priorframe.operators import metrics


def brute_auc(rows):
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    if not pos or not neg:
        return None
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(-5, 5), st.integers(0, 1)), min_size=1, max_size=60))
def test_auc_is_the_pair_statistic(spark, rows):
    df = spark.createDataFrame(rows, "s bigint, y bigint")
    got = metrics.rank_auc(df, [], "s", "y").first()["auc"]
    want = brute_auc(rows)
    assert (got is None) == (want is None)
    assert want is None or math.isclose(got, want, abs_tol=1e-12)


def test_auc_edges(spark):
    rows = [("one", 1.0, 1), ("flat", 1.0, 1), ("flat", 1.0, 0), ("best", 0.0, 0), ("best", 1.0, 1), ("null", None, 1)]
    got = {r["g"]: r["auc"] for r in metrics.rank_auc(spark.createDataFrame(rows, "g string, s double, y int"), ["g"], "s", "y").collect()}
    assert got == {"one": None, "flat": 0.5, "best": 1.0}


def test_weights_equal_repeats(spark):
    rows = [(1, 0, 2), (2, 1, 1), (2, 0, 3), (3, 1, 2), (0, 1, 1)]
    df = spark.createDataFrame(rows, "s bigint, y bigint, w bigint")
    repeated = [(s, y) for s, y, w in rows for _ in range(w)]
    assert math.isclose(metrics.rank_auc(df, [], "s", "y", "w").first()["auc"], brute_auc(repeated))


def panel(spark):
    rows = [(i % 23, float(i % 7), float(i * 37 % 11), int(i % 7 + (i * 13 % 5) > 5)) for i in range(400)]
    return spark.createDataFrame(rows, "c bigint, a double, b double, y bigint")


def test_paired_interval_mirrors(spark):
    ab = metrics.paired_interval(panel(spark), "c", "a", "b", "y", 60).first()
    ba = metrics.paired_interval(panel(spark), "c", "b", "a", "y", 60).first()
    assert ab["observed"] == pytest.approx(-ba["observed"])
    assert ab["low"] == pytest.approx(-ba["high"]) and ab["high"] == pytest.approx(-ba["low"])
    assert ab["low"] <= ab["observed"] <= ab["high"] and ab["direction"] == "positive"


def test_poisson_weights_have_mean_and_variance_one(spark):
    df = spark.range(20000).select(metrics.poisson_weight(F.col("id"), F.lit(3)).alias("w"))
    r = df.agg(F.avg("w").alias("m"), F.variance("w").alias("v")).first()
    assert abs(r["m"] - 1) < 0.03 and abs(r["v"] - 1) < 0.06


def test_permutation_keeps_each_split_whole(spark):
    df = spark.createDataFrame([(i, "ab"[i % 2], i * 10) for i in range(200)], "id bigint, split string, v bigint")
    got = metrics.permuted_within(df, "split", "id", ["v"], 9)
    rows = got.collect()
    for s in "ab":
        assert sorted(r["v"] for r in rows if r["split"] == s) == sorted(r["v"] for r in df.collect() if r["split"] == s)
    assert sum(r["v"] == r["id"] * 10 for r in rows) < 20


def test_linear_percentile(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 4, 8]], "v double")
    assert metrics.linear_percentile(df, [], "v", 0.5, "p").first()["p"] == 3.0


def test_numbers(spark):
    df = spark.createDataFrame([(" 4 ",), ("",), ("nan",), ("inf",), ("x",)], "s string")
    got = [r[0] for r in df.select(lenient_number(F.col("s"))).collect()]
    assert got == [4.0, None, None, None, None]
    c = spark.createDataFrame([("1.234,56",), ("",), ("sem",), (None,)], "s string").select(decimal_comma_number(F.col("s")).alias("v"))
    assert [tuple(r["v"]) for r in c.collect()] == [(1234.56, False, False), (None, True, False), (None, False, True), (None, True, False)]


def test_rounded_count_is_unique_or_missing(spark):
    rows = [("10", "0.3000", 3), ("3", "0.3333", 1), ("20000", "0.3333", None), ("0", "", 0), ("4", "1.2", None), ("2.5", "0.4", None)]
    df = spark.createDataFrame(rows, "n string, r string, want bigint")
    assert all(r["got"] == r["want"] for r in df.withColumn("got", rounded_count(F.col("n"), F.col("r"))).collect())

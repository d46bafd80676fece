"""AUC over sorted ranges: many ranges, ties across them, NULL groups, weightings side by side."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from priorframe.operators import metrics, ranked


def brute(rows):
    """Pairs of (score, weight) of both classes to an AUC."""
    pos, neg = [(s, w) for s, y, w in rows if y], [(s, w) for s, y, w in rows if not y]
    a, b = sum(w for _, w in pos), sum(w for _, w in neg)
    if not a or not b:
        return None
    return sum(w * v * ((s > t) + 0.5 * (s == t)) for s, w in pos for t, v in neg) / (a * b)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(2)
    out = []
    for i in range(2400):
        g = [None, "a", "b", "hot"][int(rng.integers(0, 4))]
        s = 5.0 if g == "hot" and rng.random() < 0.7 else float(rng.integers(0, 40)) if g != "a" else float(rng.normal())
        out.append((g, s if rng.random() > 0.02 else None, int(rng.integers(0, 2)), int(rng.integers(0, 300))))
    return [*out, ("one class", 1.0, 1, 3), ("nan", float("nan"), 1, 4), ("nan", float("nan"), 0, 5), ("nan", 1.0, 0, 5)]


@pytest.fixture(params=["1", "7", "64"])
def ranges(request, spark):
    """So many ranges, none of them merged."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", request.param)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield int(request.param)
    for k, v in old.items():
        spark.conf.set(k, v)


def test_any_number_of_ranges(spark, rows, ranges, monkeypatch):
    monkeypatch.setattr(ranked, "CELLS", 500)
    df = spark.createDataFrame(rows, "g string, s double, y int, c bigint").repartition(5)
    cells = df.select("g", "s", "c", F.col("y").alias("_pos"), (1 - F.col("y")).alias("_neg"))
    got = {r.g: r.auc for r in ranked.ranked_auc(cells, ["g"], "s", cluster="c").collect()}
    assert set(got) == {None, "a", "b", "hot", "one class", "nan"}
    for g in (None, "a", "b", "hot", "one class"):
        want = brute([(s, y, 1) for h, s, y, _ in rows if h == g and s is not None])
        assert got[g] == want if want is None else abs(got[g] - want) < 1e-12
    assert got["nan"] == 0.75  # NaN is one score, above all others


def test_resamples_side_by_side(spark, rows, ranges):
    df = spark.createDataFrame([(s, y, c) for g, s, y, c in rows if g in ("b", "hot")], "s double, y int, c bigint")
    got = {(r.side, r.resample): r.auc for r in metrics.bootstrap_auc(df, "c", {"up": "s"}, "y", 8).collect()}
    drawn = {r.c: r.w for r in df.select("c").distinct().select("c", F.array(*[metrics.poisson_weight(F.col("c"), F.lit(k).cast("bigint")) for k in range(1, 9)]).alias("w")).collect()}
    for k in range(9):
        want = brute([(s, y, drawn[c][k - 1] if k else 1) for g, s, y, c in rows if g in ("b", "hot") and s is not None])
        assert abs(got["up", k] - want) < 1e-12


def test_only_totals_are_shuffled_by_resample(spark, rows):
    """No exchange holds rows times resamples."""
    df = spark.createDataFrame(rows * 10, "g string, s double, y int, c bigint")
    out = metrics.bootstrap_auc(df, "c", {"a": "s"}, "y", 50)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Generate" in plan.split("MapInArrow")[0] and plan.split("== Initial")[0].count("Exchange") <= 5
    assert ranked.ranked_auc(df.limit(0).select("g", "s", F.col("y").alias("_pos"), F.col("y").alias("_neg")), ["g"], "s").collect() == []

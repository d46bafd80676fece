"""Columns of many levels are tested, in the gate and in trees."""

import dataclasses

from pyspark.sql import functions as F

from priorframe.operators import gate, predictors
from priorframe.operators.qualify import qualify
from tests.test_gate import declared, panel  # noqa: F401


def leaky(spark):
    """Three rows a level and split: too many levels for rates of the split itself."""
    rows = spark.range(900).select(
        F.element_at(F.array(F.lit("train"), F.lit("eval"), F.lit("holdout")), (F.col("id") % 3 + 1).cast("int")).alias("split"),
        (F.floor(F.col("id") / 9) % 2).alias("y"),
        F.concat(F.lit("k"), F.floor(F.col("id") / 9).cast("string")).alias("told"),
        F.concat(F.lit("u"), F.col("id").cast("string")).alias("own"),
    )
    return rows


def test_a_column_of_many_levels_is_scored(spark):
    found = {(r.split, r.field): r for r in gate.column_leak(leaky(spark), "split", "y", ["told", "own"]).collect()}
    assert {r.kind for r in found.values()} == {"high_cardinality"} and {r.auc for r in found.values()} == {None}
    assert {k for k, r in found.items() if r.determines_label} == {("eval", "told"), ("holdout", "told")}
    fitted = {(r.split, r.field): r for r in gate.fitted_leak(leaky(spark), "split", "y", ["told", "own"]).collect()}
    assert {k: (r.seen, r.fitted_auc) for k, r in fitted.items()} == {
        ("eval", "told"): (300, 1.0), ("holdout", "told"): (300, 1.0), ("eval", "own"): (0, 0.5), ("holdout", "own"): (0, 0.5),
    }


def test_the_ratio_is_a_parameter(spark):
    kinds = gate.column_leak(leaky(spark), "split", "y", ["told"], category_rows=3)
    assert {(r.kind, r.auc) for r in kinds.collect()} == {("categorical", 1.0)}
    assert [r.high for r in gate.level_counts(leaky(spark), ["told"], [], category_rows=3).collect()] == [False]


def test_the_gate_fails_on_it(panel, declared):  # noqa: F811
    told = panel.withColumn("told", F.concat("dear", F.lit("x"), F.pmod(F.xxhash64("key"), F.lit(29)).cast("string")))
    d = dataclasses.replace(declared, high_cardinality_columns=["placed", "told", "o_orderpriority"])
    report = qualify(told, d, category_rows=200).collect()  # told has many levels for every split
    assert {r.check for r in report if not r.ok} == {"leakage.no_single_column_determines_the_target", "overall"}
    assert {r.check for r in qualify(panel, d, category_rows=200).collect() if not r.ok} == set()


def test_trees_take_any_number_of_levels(spark):
    rows = spark.range(6000).select(
        F.when(F.col("id") % 4 == 3, "eval").otherwise("train").alias("split"), (F.floor(F.col("id") / 4) % 2).alias("y"),
        F.concat(F.lit("k"), F.floor(F.col("id") / 4).cast("string")).alias("c"), F.lit(1.0).alias("x"),
    )
    out = predictors.boosted_trees(rows, ["x"], ["c"], "y", trees=5, depth=5)
    assert out.columns == [*rows.columns, "score"]
    ranked, digits = predictors._ranked_levels(rows, ["c"], "split")
    assert [ranked.schema[d].metadata["ml_attr"]["num_vals"] for d in digits] == [1002, 2]
    right = out.where("split = 'eval'").agg(F.avg(((F.col("score") > 0.5) == (F.col("y") == 1)).cast("int"))).first()[0]
    assert right > 0.9

"""The whole gate on a panel of orders: one injected defect a case fails its own checks and no other."""

import dataclasses
import json

import pytest
from pyspark.sql import functions as F

from priorframe.operators.qualify import Descriptor, qualify
from priorframe.plans.base import orders

CUTS = {"train": (None, "1999-01-01"), "eval": ("1999-01-01", "2000-01-01"), "holdout": ("2000-01-01", None)}


@pytest.fixture(scope="module")
def panel(spark, sf):
    """Orders with a size label that no shipped column decides."""
    o = orders(spark, sf).withColumn("dear", (F.pmod(F.xxhash64("o_orderkey"), F.lit(3)) == 0).cast("int"))
    day = F.date_format("day", "yyyy-MM-dd")
    return o.select("split", F.col("o_orderkey").cast("string").alias("key"), day.alias("placed"), "o_orderpriority", "dear").cache()


@pytest.fixture(scope="module")
def declared(panel):
    facts = {r["split"]: r for r in panel.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.sum("dear").alias("p"), F.countDistinct(F.when(F.col("dear") == 1, F.col("placed"))).alias("e"),
    ).collect()}
    return Descriptor(
        target="dear", positive_label="1", id_columns=["key"], time_column="placed", event_key_column="placed",
        split_windows={s: {"start": a, "end": b} for s, (a, b) in CUTS.items()},
        positive_events={s: {"positives": facts[s]["p"], "distinct_events": facts[s]["e"]} for s in ("eval", "holdout")},
        features=["o_orderpriority"], high_cardinality_columns=["placed"], label_source_columns=["score"], post_hoc_columns=["shipped"],
        expected_duplicate_ids=0, splits={"train": "public/train", "eval": "public/eval", "holdout": "private/holdout"},
        rows={s: r["n"] for s, r in facts.items()}, positive_rate={s: r["p"] / r["n"] for s, r in facts.items()},
    )


def failing(df, descriptor):
    found = {r["check"]: r["ok"] for r in qualify(df, descriptor).collect()}
    bad = {c for c, ok in found.items() if not ok}
    assert ("overall" in bad) == bool(bad)
    return bad - {"overall"}


def test_a_sound_panel_passes(panel, declared):
    assert failing(panel, declared) == set()


def test_a_column_that_holds_the_answer(panel, declared):
    told = panel.withColumn("score", F.when(F.col("dear") == 1, F.lit(70)).otherwise(20))
    assert failing(told, declared) == {"leakage.answer_source_absent", "leakage.no_single_column_determines_the_target"}


def test_descriptor_against_layout_and_features(panel, declared):
    moved = dataclasses.replace(declared, splits=declared.splits | {"holdout": "public/holdout"})
    assert failing(panel, moved) == {"runner.layout"}
    late = dataclasses.replace(declared, features=["o_orderpriority", "shipped"])
    assert failing(panel, late) == {"timing.no_post_hoc_feature"}
    silent = dataclasses.replace(declared, high_cardinality_columns=[])
    assert failing(panel, silent) == {"leakage.high_cardinality_declared"}


def test_rows_outside_their_window(panel, declared):
    early = panel.withColumn("placed", F.when((F.col("split") == "eval") & F.col("key").endswith("7"), F.lit("1998-03-04")).otherwise(F.col("placed")))
    assert {"splits.actual_ranges_disjoint", "splits.rows_within_declared_windows"} <= failing(early, declared)


def test_one_class_in_eval(panel, declared):
    n = declared.rows["eval"]
    days = panel.where("split = 'eval'").select("placed").distinct().count()
    flat = panel.withColumn("dear", F.when(F.col("split") == "eval", F.lit(1)).otherwise(F.col("dear")))
    d = dataclasses.replace(
        declared, positive_events=declared.positive_events | {"eval": {"positives": n, "distinct_events": days}},
        positive_rate=declared.positive_rate | {"eval": 1.0},
    )
    assert failing(flat, d) == {"splits.eval_and_holdout_have_both_classes"}


def test_a_key_in_two_splits(panel, declared):
    low = panel.groupBy("split").agg(F.min("key").alias("k")).collect()
    of = {r["split"]: r["k"] for r in low}
    shared = panel.withColumn("key", F.when(F.col("key") == of["eval"], F.lit(of["train"])).otherwise(F.col("key")))
    assert failing(shared, declared) == {"splits.no_cross_split_entities"}


@pytest.mark.parametrize("entity_keys", [True, False])
def test_a_key_with_two_labels(panel, declared, entity_keys):
    a, b = (panel.where(f"split = 'eval' and dear = {y}").agg(F.min("key")).first()[0] for y in (0, 1))
    twice = panel.withColumn("key", F.when(F.col("key") == a, F.lit(b)).otherwise(F.col("key")))
    d = dataclasses.replace(declared, expected_duplicate_ids=1, id_columns_are_entity_keys=entity_keys)
    assert failing(twice, d) == ({"splits.repeated_identifiers_carry_one_label"} if entity_keys else set())
    d = dataclasses.replace(declared, expected_duplicate_ids=None)
    assert failing(twice, d) == {"splits.duplicate_entities_within_splits"}


def test_counts_that_do_not_match(panel, declared):
    d = dataclasses.replace(declared, rows=declared.rows | {"holdout": declared.rows["holdout"] + 3})
    assert failing(panel, d) == {"runner.meta_counts_match_files"}


def test_a_split_without_rows(panel, declared):
    assert "splits.non_empty" in failing(panel.where("split <> 'holdout'"), declared)


def test_a_descriptor_is_read_from_json(declared, tmp_path):
    file = tmp_path / "quality.json"
    file.write_text(json.dumps({**dataclasses.asdict(declared), "positive_label": 1, "note": "ignored"}))
    assert Descriptor.read(str(file)) == declared

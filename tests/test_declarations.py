"""Declared sections of a descriptor: each fault fails its own check."""

import copy
import dataclasses

import pytest
from pyspark.sql import functions as F

from priorframe.operators import declarations, gate
from priorframe.operators.qualify import qualify
from tests.test_gate import declared, panel  # noqa: F401

COLUMNS = ["key", "placed", "o_orderpriority"]
SOUND = {
    "task": {"prediction_time": "at the order"}, "features_documented_at": "prediction_time",
    "timing": {
        "prediction_instant": {"kind": "publication", "citation": "notes", "days_after_period_end": 40},
        "features": {"source_kind": "statistical_release", "published_days_after_period_end": 35},
        "row_selection": {"latest_period_used": "M"}, "observations": [{"period_end": "2024-01-31", "published": "2024-03-06"}],
    },
    "evaluation_contract": {
        "use": "retrospective_research", "access": "isolated_rows", "training_label_timing": "unverified", "limitations": ["synthetic"],
        "vintage": {"kind": "current_snapshot", "evidence": "files"}, "selection": {"kind": "prediction_time", "evidence": "rule"},
        "feature_evidence": {c: {"source": "orders", "availability": "order", "status": "assumed"} for c in COLUMNS},
        "cross_row_audit": {"probes": [], "rationale": "independent rows", "auxiliary_files_review": "none"},
    },
    "measurements": [{"column": "dear", "unit": "flag", "frame": "order"}],
    "meta": {"target": "dear", "positive_label": 1, "id_columns": ["key"], "rows": {}, "positive_rate": {}, "columns": ["key", "placed", "o_orderpriority", "dear"]},
}


def failed(said):
    found = declarations.timing_findings(said, ["o_orderpriority"], ["score"]) + declarations.contract_findings(said, COLUMNS) + declarations.unit_findings(said)
    return {name for name, problems in found if problems}


def changed(path, value):
    said = copy.deepcopy(SOUND)
    at = said
    for key in path[:-1]:
        at = at[key]
    if value is KeyError:
        del at[path[-1]]
    else:
        at[path[-1]] = value
    return said


@pytest.mark.parametrize(
    "path, value, want",
    [
        (["task", "prediction_time"], "  ", {"timing.prediction_time_declared"}),
        (["features_documented_at"], "later", {"timing.every_feature_documented"}),
        (["timing", "prediction_instant", "citation"], "", {"timing.instant_declared"}),
        (["timing", "observations"], [], {"timing.publication_lag_measured"}),
        (["timing", "observations"], [{"period_end": "2024-01-31", "published": "2024-01-02"}], {"timing.publication_lag_measured"}),
        (["timing", "features", "published_days_after_period_end"], 34, {"timing.features_available_at_instant"}),
        (["timing", "features", "published_days_after_period_end"], 41, {"timing.features_available_at_instant"}),
        (["timing", "prediction_instant", "kind"], "period_end", {"timing.instant_accounts_for_publication_lag"}),
        (["timing", "row_selection", "latest_period_used"], "M+1", {"timing.selection_uses_only_available_data"}),
        (["evaluation_contract"], KeyError, {"contract.declared"}),
        (["evaluation_contract", "use"], "trading", {"contract.scope", "contract.label_availability"}),
        (["evaluation_contract", "limitations"], [], {"contract.vintage_and_selection"}),
        (["evaluation_contract", "feature_evidence", "placed", "status"], "hoped", {"contract.every_input_has_availability_evidence"}),
        (["evaluation_contract", "cross_row_audit", "rationale"], "", {"contract.cross_row_review"}),
        (["evaluation_contract", "use"], "historical_forecasting", {"contract.historical_evidence", "contract.label_availability"}),
        (["measurements"], [{"column": "dear", "unit": "flag"}], {"units.measured_columns_declare_unit_and_frame"}),
        (["external_threshold"], "50", {"units.validation_receipt"}),
    ],
)
def test_one_fault(path, value, want):
    assert failed(SOUND) == set()
    assert failed(changed(path, value)) == want


def test_an_administrative_event_needs_no_lag():
    said = changed(["timing"], {"prediction_instant": {"kind": "event", "citation": "notes"}, "features": {"source_kind": "administrative_record"},
                                "row_selection": {"fields": ["placed"], "rule": "all orders"}})
    assert failed(said) == set()
    names = {n for n, _ in declarations.timing_findings(said, [], [])}
    assert {"timing.event_feature_availability_unverified", "timing.event_selection_declared"} <= names


def test_whole_report(panel, declared):  # noqa: F811
    full = dataclasses.replace(declared, declared=SOUND, features=["o_orderpriority"])
    bad = {r.check for r in qualify(panel, full).collect() if not r.ok}
    assert bad == {"duplicates.no_feature_tuple_in_two_splits", "overall"}  # one feature of five values
    bare = panel.withColumn("empty", F.lit(" "))
    bad = {r.check: r.detail for r in qualify(bare, full).collect() if not r.ok}
    assert bad["leakage.every_column_could_be_scored"] == "empty@eval; empty@holdout; empty@train" and bad["leakage.declared_columns"] == "empty"
    twice = panel.select("*", F.col("o_orderpriority"))
    bad = {r.check: r.detail for r in qualify(twice, dataclasses.replace(full, features=[])).collect() if not r.ok}
    assert bad["leakage.every_column_could_be_scored"].startswith("o_orderpriority twice")


def test_forms_of_a_rate_claim(spark):
    text = "Prevalence: train 2019-2021 1.87% eval 1.9%. holdout (2.0% train) rate. The positive rate fell; Escape rate 3% holdout\nNo words here: train 9%"
    facts = spark.createDataFrame([("train", 1.872), ("eval", 1.96), ("holdout", 3.4)], "split string, observed double")
    got = gate.rate_claims(spark.createDataFrame([(1, text)], "k int, t string"), "k", "t", facts).collect()
    assert {(r.split, r.literal, r.ok) for r in got} == {("train", "1.87", True), ("eval", "1.9", False), ("holdout", "3", True)}

"""Checks of what a dataset declares: contract, timing, units, splits and runner files, without reading a row."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import date

Finding = tuple[str, list[str]]  # check name and its problems; none means that it holds

# The words that a declaration may use, and the keys that a runner reads.
USES = ("retrospective_research", "historical_forecasting")
ACCESS = ("isolated_rows", "chronological", "common_cutoff_batch")
VINTAGES = ("as_of", "current_snapshot", "mixed")
SELECTIONS = ("prediction_time", "outcome_conditioned")
EVIDENCE = ("verified", "assumed", "unverified")
RUNNER_KEYS = ("target", "positive_label", "id_columns", "columns", "rows", "positive_rate")
SPLITS = ("train", "eval", "holdout")


def section(said: object, *path: str) -> dict:
    """A nested object, empty where it is missing or of another kind."""
    for key in path:
        said = said.get(key) if isinstance(said, dict) else None
    return said if isinstance(said, dict) else {}


def listed(said: dict, key: str) -> list:
    return said[key] if isinstance(said.get(key), list) else []


def wrong(**rules: bool) -> list[str]:
    """Names of the rules that do not hold."""
    return [name.replace("_", " ") for name, holds in rules.items() if not holds]


def contract_findings(said: dict, shipped: Sequence[str]) -> list[Finding]:
    """Intended use, access, vintage, selection and evidence for every shipped column."""
    contract = section(said, "evaluation_contract")
    found: list[Finding] = [("contract.declared", wrong(evaluation_contract=bool(contract)))]
    if not contract:
        return found
    vintage, selection, audit, evidence = (section(contract, k) for k in ("vintage", "selection", "cross_row_audit", "feature_evidence"))
    backed = [c for c in shipped if all(section(evidence, c).get(k) for k in ("source", "availability")) and evidence[c].get("status") in EVIDENCE]
    bare = sorted(set(shipped) - set(backed))
    found += [
        ("contract.scope", wrong(use=contract.get("use") in USES, access=contract.get("access") in ACCESS)),
        (
            "contract.vintage_and_selection",
            wrong(
                vintage=vintage.get("kind") in VINTAGES and bool(vintage.get("evidence")),
                selection=selection.get("kind") in SELECTIONS and bool(selection.get("evidence")),
                limitations=bool(contract.get("limitations")),
            ),
        ),
        ("contract.every_input_has_availability_evidence", bare),
        (
            "contract.cross_row_review",
            wrong(
                probes=isinstance(audit.get("probes", []), list), rationale=bool(audit.get("rationale")),
                auxiliary_files_review=bool(audit.get("auxiliary_files_review")),
            ),
        ),
    ]
    if contract.get("use") == "historical_forecasting":
        unverified = [c for c in shipped if section(evidence, c).get("status") != "verified"]
        found.append(
            (
                "contract.historical_evidence",
                unverified + wrong(vintage=vintage.get("kind") == "as_of", selection=selection.get("kind") == "prediction_time"),
            )
        )
    if not contract.get("availability_ledger"):
        honest = contract.get("use") == "retrospective_research" and contract.get("training_label_timing") == "unverified"
        found.append(("contract.label_availability", wrong(no_ledger_and_not_declared_unverified=honest)))
    return found


def _day(value: object) -> date | None:
    try:
        return date.fromisoformat(str(value))
    except ValueError:
        return None


def _days(value: object) -> int | None:
    return value if isinstance(value, int) and not isinstance(value, bool) and value >= 0 else None


def timing_findings(said: dict, features: Sequence[str], label_sources: Sequence[str]) -> list[Finding]:
    """Prediction instant, observed publication lags, and a row selection that does not reach ahead."""
    instant, source, selection = (section(said, "timing", k) for k in ("prediction_instant", "features", "row_selection"))
    observed = [o for o in listed(section(said, "timing"), "observations")]
    spans = [(_day(section(o).get("period_end")), _day(section(o).get("published"))) for o in observed]
    lags = [(b - a).days for a, b in spans if a and b and b >= a]
    feature_lag, instant_lag = source.get("published_days_after_period_end"), instant.get("days_after_period_end")
    contract = section(said, "evaluation_contract")
    # An administrative record of an event has no period to lag behind, if its research use says so openly.
    open_event = (
        source.get("source_kind") == "administrative_record" and instant.get("period") is None
        and contract.get("use") == "retrospective_research" and contract.get("training_label_timing") == "unverified"
        and section(contract, "vintage").get("kind") in ("current_snapshot", "mixed") and bool(contract.get("limitations"))
    )
    unmeasured = open_event and feature_lag is None and instant_lag is None and not observed
    a, b = _days(feature_lag), _days(instant_lag)
    in_time = a is not None and b is not None and max([a, *lags]) <= a <= b
    latest = str(selection.get("latest_period_used") or "")
    rule = open_event and not latest and bool(selection.get("fields")) and bool(selection.get("rule"))
    return [
        ("timing.prediction_time_declared", wrong(prediction_time=bool(str(section(said, "task").get("prediction_time") or "").strip()))),
        ("timing.label_source_is_not_a_feature", sorted(set(features) & set(label_sources))),
        ("timing.every_feature_documented", wrong(features_documented_at=said.get("features_documented_at") == "prediction_time")),
        ("timing.instant_declared", wrong(kind=bool(instant.get("kind")), citation=bool(instant.get("citation")))),
        (
            "timing.publication_lag_measured",
            wrong(
                every_observation_usable=len(lags) == len(observed),
                one_observation_of_a_release=bool(observed) or source.get("source_kind") != "statistical_release",
            ),
        ),
        (
            "timing.event_feature_availability_unverified" if unmeasured else "timing.features_available_at_instant",
            wrong(published_by_the_instant=unmeasured or in_time),
        ),
        (
            "timing.instant_accounts_for_publication_lag",
            wrong(publication_instant=not (isinstance(feature_lag, int) and feature_lag > 0) or instant.get("kind") == "publication"),
        ),
        (
            "timing.event_selection_declared" if rule else "timing.selection_uses_only_available_data",
            wrong(latest_period=rule or (bool(latest) and "+" not in latest)),
        ),
    ]


def unit_findings(said: dict) -> list[Finding]:
    measured = listed(said, "measurements")
    bare = [str(m.get("column")) for m in measured if not (m.get("unit") and m.get("frame"))]
    receipt = section(said, "unit_validation")
    checks = receipt.get("checks")
    valid = (
        type(checks) is int and checks > 0 and receipt.get("mismatches") == 0 and bool(receipt.get("source"))
        and re.fullmatch(r"[0-9a-f]{64}", str(receipt.get("evidence_sha256"))) is not None
    )
    return [
        ("units.measured_columns_declare_unit_and_frame", bare if measured else ["no measurements declared"]),
        ("units.validation_receipt", wrong(receipt=valid or not said.get("external_threshold"))),
    ]


def split_findings(d) -> list[Finding]:
    windows = [s for s in SPLITS if not isinstance(d.split_windows.get(s), dict)]
    events = [s for s in ("eval", "holdout") if not all(section(d.positive_events, s).get(k) for k in ("positives", "distinct_events"))]
    return [
        ("splits.time_column_declared", wrong(time_column=bool(d.time_column))),
        ("splits.machine_readable_windows", windows),
        ("splits.positive_events_declared", events),
        ("splits.event_key_column_declared", wrong(event_key_column=bool(d.event_key_column))),
    ]


def runner_findings(d, header: Sequence[str]) -> list[Finding]:
    """``meta`` holds what the runner's own file says."""
    meta = section(d.declared, "meta")
    missing = [k for k in RUNNER_KEYS if k not in meta]
    found: list[Finding] = [("runner.meta_json_keys", missing)]
    if not missing:
        ids = meta["id_columns"]
        agrees = wrong(
            positive_label=str(meta["positive_label"]) == d.positive_label, target=meta["target"] == d.target, id_columns=set(ids) <= set(meta["columns"]),
            target_in_files=meta["target"] in header, header=sorted(meta["columns"]) == sorted(header),
        )
        found += [("runner.meta_matches_files", agrees), ("runner.id_columns_are_not_features", sorted(set(ids) & set(d.features)))]
    return found

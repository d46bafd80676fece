"""The whole quality gate of one dataset as a report of check rows."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field, fields
from functools import reduce
from operator import or_
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from priorframe.operators import declarations, gate, probes
from priorframe.operators.metrics import auc_of_levels
from priorframe.operators.ordering import in_pieces
from priorframe.sources.sinks import written_once

SPLITS = ("train", "eval", "holdout")
SCORED = ("eval", "holdout")
MIN_POSITIVES = 30
MIN_EVENTS = 20
SHORT = 64  # characters of a value that are grouped as they are; a longer one by its digest
DIGEST = "sha256:"
NUMBER_START = r"(?i)^[-+.0-9in][-+.0-9a-z]*$"  # what a number can look like; a cheap test before the cast

# Cells that stand for a whole row in the level table.
ROW, IDENTIFIER, EVENT, FEATURES = "#row", "#id", "#event", "#features"


@dataclass(frozen=True)
class Descriptor:
    """What a dataset declares about itself; the gate measures it against the rows.

    ``declared`` holds the other sections (task, timing, evaluation_contract, measurements, meta, ...). Where it is
    None they were not asked for, and only the rows, the header and the fields above are judged.
    """

    target: str
    positive_label: str
    id_columns: list[str]
    time_column: str
    event_key_column: str
    split_windows: dict[str, dict[str, str | None]]
    positive_events: dict[str, dict[str, int]]
    features: list[str] = field(default_factory=list)
    high_cardinality_columns: list[str] = field(default_factory=list)
    label_source_columns: list[str] = field(default_factory=list)
    post_hoc_columns: list[str] = field(default_factory=list)
    expected_duplicate_ids: int | None = None
    id_columns_are_entity_keys: bool = False
    splits: dict[str, str] = field(default_factory=dict)
    rows: dict[str, int] = field(default_factory=dict)
    positive_rate: dict[str, float] = field(default_factory=dict)
    declared: dict | None = None

    @classmethod
    def read(cls, *paths: str) -> Descriptor:
        """Merge JSON documents; keys without a field of their own go to ``declared``."""
        merged: dict = {}
        for p in paths:
            merged |= json.loads(Path(p).read_text())
        known = {f.name for f in fields(cls)}
        merged["positive_label"] = str(merged.get("positive_label"))
        rest = {k: v for k, v in merged.items() if k not in known}
        return cls(**({"declared": rest} | {k: v for k, v in merged.items() if k in known}))


def cell_levels(panel: DataFrame, y: Column, columns: Sequence[str], whole: dict[str, Column]) -> DataFrame:
    """(field, key, number, n_SPLIT, p_SPLIT): rows and positives of every distinct cell, by split.

    ``whole`` adds cells of the whole row. All grains of the gate are cells of this one frame, so the panel is read
    once, dealt once and shuffled again as counts; a value longer than ``SHORT`` counts by its digest.
    """
    value = {c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in columns} | whole
    cells = F.array(*[F.struct(F.lit(c).alias("field"), v.alias("value")) for c, v in value.items()])
    # Most cells differ, so a task that counts them holds nearly all cells of its rows: it gets one piece of the rows.
    rows = in_pieces(panel.withColumn("_y", F.coalesce(y, F.lit(0))), [F.xxhash64(*[F.col(f"`{c}`") for c in panel.columns])])
    long = rows.select("split", "_y", F.explode(cells).alias("_c")).select("split", "_y", "_c.*")
    v, long_value = F.col("value"), F.length("value") > SHORT
    # A long value counts by its digest, beside the number that it may be; numbers of short ones are read a level.
    digest, far = F.concat(F.lit(DIGEST), F.sha2(v, 256)), F.when(long_value, F.trim(v).try_cast("double"))
    long = long.select("split", "_y", "field", F.when(long_value, digest).otherwise(v).alias("key"), far.alias("far"))
    here = lambda s: F.col("split") == s
    counts = [F.count(F.when(here(s), 1)).alias(f"n_{s}") for s in SPLITS] + [F.sum(F.when(here(s), F.col("_y")).otherwise(0)).alias(f"p_{s}") for s in SPLITS]
    levels = long.groupBy("field", "key", "far").agg(*counts)
    near = F.when(F.trim("key").rlike(NUMBER_START) & ~F.startswith("field", F.lit("#")), F.trim("key").try_cast("double"))
    return levels.withColumn("number", F.coalesce("far", near)).drop("far")


def level_facts(levels: DataFrame, time_column: str | None, category_rows: int) -> DataFrame:
    """One row per field: what its levels say about every split, and about all splits together."""
    key = F.col("key")
    month = F.when(F.length(F.trim(key)) == 7, F.concat(F.trim(key), F.lit("-01"))).otherwise(key)
    is_time = F.col("field") == time_column if time_column else F.lit(False)
    time, written = F.when(is_time, month.try_cast("timestamp_ntz")), F.trim(key) != ""

    def of(s: str) -> Column:
        n, p = F.col(f"n_{s}"), F.col(f"p_{s}")
        mine = n > 0
        count, number = F.count(F.when(mine, 1)), F.bool_and(F.when(mine, F.col("number").isNotNull()))
        total = F.sum(n)
        high = count > F.greatest(F.lit(1), F.floor(total / category_rows))
        return F.struct(
            F.lit(s).alias("split"), total.alias("rows"), F.sum(p).alias("positives"), count.alias("levels"),
            F.when(number, "numeric").when(high, "high_cardinality").otherwise("categorical").alias("kind"),
            F.sum(F.when(written, n).otherwise(0)).alias("filled"), F.count(F.when((p > 0) & written, 1)).alias("positive_levels"),
            F.min(F.when(mine, time)).alias("lo"), F.max(F.when(mine, time)).alias("hi"),
            F.sum(F.when(is_time & written & time.isNull(), n).otherwise(0)).alias("unparsed"),
        ).alias(s)

    held = reduce(lambda a, b: a + b, [(F.col(f"n_{s}") > 0).cast("bigint") for s in SPLITS])
    again = reduce(lambda a, b: a + b, [F.greatest(F.col(f"n_{s}") - 1, F.lit(0)) for s in SPLITS])
    mixed = reduce(or_, [(F.col(f"p_{s}") > 0) & (F.col(f"p_{s}") < F.col(f"n_{s}")) for s in SPLITS])
    return levels.groupBy("field").agg(
        *[of(s) for s in SPLITS], F.count(F.when(held > 1, 1)).alias("shared"), F.sum(again).alias("repeats"), F.count(F.when(mixed, 1)).alias("mixed")
    )


def level_aucs(levels: DataFrame, facts: DataFrame, fit_on: str = "train") -> DataFrame:
    """(field, auc_SPLIT, fitted_SPLIT): how well a column ranks the label, by itself and by the level rates of train.

    A numeric column ranks by its number, another by the positive rate of its level in the split; a column of many
    levels only has the fitted figure, since its own rates would repeat the label.
    """
    own = levels.where(~F.startswith("field", F.lit("#")))
    joined = own.join(facts.select("field", *[F.col(f"{s}.kind").alias(f"kind_{s}") for s in SPLITS], F.col(fit_on).alias("_fit")), "field")
    rate = lambda s: F.try_divide(F.col(f"p_{s}"), F.col(f"n_{s}"))
    prior = F.try_divide("_fit.positives", "_fit.rows")
    scores = []
    for s in SPLITS:
        kind, counts = F.col(f"kind_{s}"), [F.col(f"p_{s}").cast("double").alias("_pos"), (F.col(f"n_{s}") - F.col(f"p_{s}")).cast("double").alias("_neg")]
        own_score = F.when(kind == "numeric", F.col("number")).when(kind == "categorical", rate(s))
        scores.append(F.struct(F.lit(f"auc_{s}").alias("figure"), F.when(F.col(f"n_{s}") > 0, own_score).alias("score"), *counts))
        if s != fit_on:
            fitted = F.coalesce(rate(fit_on), prior)
            scores.append(F.struct(F.lit(f"fitted_{s}").alias("figure"), F.when(F.col(f"n_{s}") > 0, fitted).alias("score"), *counts))
    long = joined.select("field", F.explode(F.array(*scores)).alias("_s")).select("field", "_s.*").where("score is not null")
    merged = long.groupBy("figure", "field", "score").agg(F.sum("_pos").alias("_pos"), F.sum("_neg").alias("_neg"))
    auc = auc_of_levels(merged, ["figure", "field"], "score")
    figures = [f"auc_{s}" for s in SPLITS] + [f"fitted_{s}" for s in SPLITS if s != fit_on]
    return auc.groupBy("field").agg(*[F.max(F.when(F.col("figure") == f, F.col("auc"))).alias(f) for f in figures])


def names(conditions: dict[str, Column]) -> Column:
    """The names whose condition holds, in the order given."""
    return F.concat_ws("; ", *[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in conditions.items()])


class Report:
    """Check rows as columns over one row of measurements."""

    def __init__(self):
        self.rows: list[Column] = []
        self.declared: list[declarations.Finding] = []

    def add(self, name: str, ok: Column, detail: Column, evidence: Column | None = None) -> None:
        ok = F.coalesce(ok, F.lit(False))
        self.rows.append(
            F.struct(
                F.lit(name).alias("check"), ok.alias("ok"), F.when(ok, F.lit("")).otherwise(F.coalesce(detail, F.lit(""))).alias("detail"),
                F.coalesce(evidence if evidence is not None else F.lit("[]"), F.lit("[]")).alias("evidence"),
            )
        )

    def none_of(self, name: str, bad: dict[str, Column], evidence: Column | None = None) -> None:
        """Holds where none of the named conditions does; a condition that is not known counts as bad."""
        bad = {n: F.coalesce(c, F.lit(True)) for n, c in bad.items()}
        self.add(name, ~reduce(or_, bad.values()), names(bad), evidence)

    def said(self, findings: Sequence[declarations.Finding]) -> None:
        self.declared += findings

    def over(self, measured: DataFrame) -> DataFrame:
        """(check, ok, detail, evidence), and an overall row that holds only when every check does."""
        failed = F.size(F.filter("_r", lambda r: ~r["ok"]))
        overall = F.struct(
            F.lit("overall").alias("check"), (failed == 0).alias("ok"), F.concat(failed.cast("string"), F.lit(" failed")).alias("detail"), F.lit("[]").alias("evidence")
        )
        quoted = lambda t: "'" + t.replace("\\", "\\\\").replace("'", "\\'") + "'"
        row = "named_struct('check', {}, 'ok', {}, 'detail', {}, 'evidence', '[]')"
        said = [row.format(quoted(name), str(not problems).lower(), quoted("; ".join(problems))) for name, problems in self.declared]
        return measured.select(F.concat(F.expr(f"array({', '.join(said)})"), F.array(*self.rows)).alias("_r")).select(F.explode(F.concat("_r", F.array(overall))).alias("_r")).select("_r.*")


def listed_rows(df: DataFrame) -> Column:
    """The rows of a small frame of measurements (splits, claims that fail) as one array, for a scalar subquery."""
    return df.agg(F.array_sort(F.collect_list(F.struct(*df.columns)))).scalar()


def qualify(
    panel: DataFrame, d: Descriptor, category_rows: int = gate.CATEGORY_ROWS, *, ledger: DataFrame | None = None,
    claims: Sequence[tuple[str, str, str]] = (), texts: DataFrame | None = None, battery: DataFrame | None = None,
) -> DataFrame:
    """(check, ok, detail, evidence) rows and an overall row for a panel with a ``split`` column.

    All counts come from one frame of distinct cells (``cell_levels``), which is written once: classes and time ranges
    per split, positive event days, identifiers, feature tuples and levels of every column are cells of it. They shrink
    to one row of measurements, over which all checks are expressions.

    A time that is written but does not parse, or a split without any time, fails the range checks; blank times of a
    split that has others are not judged.

    ``ledger`` (split, ids, prediction_time, features_at, label_at) is the availability ledger, ``claims`` are
    (split, n_rows | positives | rate, literal), ``texts`` (key, text) are shipped texts, ``battery`` is the result of
    ``battery.report``; each adds its checks.
    """
    header = [c for c in panel.columns if c != "split"]
    twice = sorted({c for c in header if header.count(c) > 1})
    if twice:
        # Columns of one name cannot be told apart, so none of them is scored.
        panel = panel.toDF(*[c if panel.columns.count(c) == 1 else f"{c}#{i}" for i, c in enumerate(panel.columns)])
    shipped = [c for c in header if c != d.target]
    scored_columns = [c for c in panel.columns if c not in ("split", d.target) and c.split("#")[0] not in twice]
    y = (F.col(d.target).cast("string") == d.positive_label).cast("bigint")
    text = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    wide = lambda cs: text(cs[0]) if len(cs) == 1 else F.to_json(F.struct(*[text(c).alias(c) for c in cs]))
    features = [c for c in d.features if c in panel.columns]
    whole = {ROW: F.lit(""), IDENTIFIER: wide(d.id_columns)}
    if d.event_key_column in panel.columns:
        whole[EVENT] = F.when(y == 1, F.substring(text(d.event_key_column), 1, 10)).otherwise(F.lit(""))
    if d.declared is not None and features:
        whole[FEATURES] = F.sha2(F.to_json(F.struct(*[text(c).alias(c) for c in features])), 256)

    levels = written_once(cell_levels(panel, y, scored_columns, whole), "gate-levels")
    facts = level_facts(levels, d.time_column, category_rows)
    aucs = level_aucs(levels, facts)
    figures = [c for c in aucs.columns if c != "field"]
    # One aggregate makes the one row that all checks read.
    one = lambda name: F.max(F.when(F.col("field") == name, F.struct(*SPLITS, "shared", "repeats", "mixed")))
    columns = F.when(~F.startswith("field", F.lit("#")), F.struct("field", *SPLITS, *figures))
    row = facts.join(aucs, "field", "left").agg(
        F.array_sort(F.collect_list(columns)).alias("f"), one(ROW).alias("row"), one(IDENTIFIER).alias("id"), one(EVENT).alias("event"),
        one(d.time_column).alias("time"), one(FEATURES).alias("tuple"),
    )
    extra = {}
    if ledger is not None:
        extra["ledger"] = listed_rows(ledger_facts(panel, ledger, d))
    if texts is not None:
        extra["prose"] = listed_rows(failed_prose(texts, split_facts(facts)))
    if battery is not None:
        extra["battery"] = listed_rows(battery.where("finding = 'failure'").select("probe", "scope", "split", "covered"))
    contract = declarations.section(d.declared, "evaluation_contract")
    crossing = declarations.listed(declarations.section(contract, "cross_row_audit"), "probes")
    for k, spec in enumerate(crossing):
        extra[f"crossing_{k}"] = listed_rows(crossing_facts(panel, y, spec))
    measured = row.select("*", *[v.alias(k) for k, v in extra.items()])

    r = Report()
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    n = {s: zero(f"row.{s}.rows") for s in SPLITS}
    p = {s: zero(f"row.{s}.positives") for s in SPLITS}
    events = {s: zero(f"event.{s}.positive_levels") for s in SPLITS}
    lo, hi = {s: F.col(f"time.{s}.lo") for s in SPLITS}, {s: F.col(f"time.{s}.hi") for s in SPLITS}
    counts = F.to_json(F.array(*[F.struct(F.lit(s).alias("split"), n[s].alias("n"), p[s].alias("p")) for s in SPLITS]))
    ranges = F.to_json(F.array(*[F.struct(F.lit(s).alias("split"), lo[s].cast("string").alias("lo"), hi[s].cast("string").alias("hi")) for s in SPLITS]))
    said_events = {s: declarations.section(d.positive_events, s) for s in SCORED}

    # The check names of a report.
    forbidden = {*d.label_source_columns} | ({*d.post_hoc_columns} if d.declared is not None else set())
    r.said([("leakage.answer_source_absent", sorted(forbidden & set(shipped))), ("timing.no_post_hoc_feature", sorted(set(d.post_hoc_columns) & set(d.features)))])
    places = {"train": "public/", "eval": "public/", "holdout": "private/"}
    r.said([("runner.layout", [f"{s} is not {at}" for s, at in places.items() if d.splits and not d.splits.get(s, "").startswith(at)])])

    def at_splits(bad) -> Column:
        """FIELD@SPLIT of every column and split where ``bad`` (column, split) holds."""
        return F.array_sort(F.flatten(F.transform("f", lambda x: F.array_compact(F.array(*[
            F.when(F.coalesce(bad(x, s), F.lit(False)), F.concat(x["field"], F.lit(f"@{s}"))) for s in SPLITS
        ])))))

    def told(x: Column, s: str) -> Column:
        fitted = x[f"fitted_{s}"] if s != "train" else F.lit(None).cast("double")
        return F.when(x[s]["kind"] == "high_cardinality", fitted).otherwise(x[f"auc_{s}"]).isin(0.0, 1.0)

    shown = F.to_json(F.transform("f", lambda x: F.struct(x["field"].alias("field"), *[x[f].alias(f) for f in figures], *[x[s]["kind"].alias(f"kind_{s}") for s in SPLITS])))
    free = [*d.id_columns, *d.high_cardinality_columns]
    offenders, many = at_splits(told), at_splits(lambda x, s: (x[s]["rows"] > 0) & (x[s]["kind"] == "high_cardinality") & ~x["field"].isin(*free))
    r.add("leakage.no_single_column_determines_the_target", F.size(offenders) == 0, F.array_join(offenders, "; "), shown)
    r.add("leakage.high_cardinality_declared", F.size(many) == 0, F.array_join(many, "; "))
    r.none_of("splits.non_empty", {s: n[s] == 0 for s in SPLITS}, counts)
    r.none_of("splits.eval_and_holdout_have_both_classes", {s: (p[s] == 0) | (p[s] == n[s]) for s in SCORED}, counts)
    r.none_of("splits.positive_events_match_rows", {s: p[s] != F.lit(e.get("positives")) for s, e in said_events.items()}, counts)
    found = F.to_json(F.struct(*[v.alias(s) for s, v in events.items()]))
    r.none_of("splits.distinct_events_match_rows", {s: events[s] != F.lit(e.get("distinct_events")) for s, e in said_events.items()}, found)
    thin = {s: (events[s] < MIN_EVENTS) | (F.lit(e.get("positives")) < MIN_POSITIVES) for s, e in said_events.items()}
    r.none_of("splits.enough_clustered_positives", thin, found)
    r.add("splits.rates_not_uniform", reduce(or_, [(p[s] > 0) & (p[s] < n[s]) for s in SPLITS]), F.lit("every split is all positive or all negative"), counts)
    # A range is known where the split has a time, and every time that is written parses.
    lost = {s: (n[s] > 0) & (lo[s].isNull() | (zero(f"time.{s}.unparsed") > 0)) for s in SPLITS}
    meets = {f"{a}/{b}": F.coalesce((lo[a] <= hi[b]) & (lo[b] <= hi[a]), F.lit(False)) for i, a in enumerate(SPLITS) for b in SPLITS[i + 1 :]}
    r.none_of("splits.actual_ranges_disjoint", lost | meets, ranges)
    outside = {}
    for s in SPLITS:
        window = {k: F.lit(v).cast("timestamp_ntz") for k, v in declarations.section(d.split_windows, s).items() if v is not None}
        early = [lo[s] < window["start"]] if "start" in window else []
        late = [hi[s] >= window["end"]] if "end" in window else []
        outside[s] = (n[s] > 0) & reduce(or_, [lost[s], *[F.coalesce(c, F.lit(True)) for c in early + late]])
    r.none_of("splits.rows_within_declared_windows", outside, ranges)
    shared, repeats, mixed = zero("id.shared"), zero("id.repeats"), zero("id.mixed")
    number = lambda c, what: F.concat(c.cast("string"), F.lit(what))
    r.add("splits.no_cross_split_entities", shared == 0, number(shared, " identifiers span splits"))
    r.add("splits.duplicate_entities_within_splits", repeats <= (d.expected_duplicate_ids or 0), number(repeats, " repeated rows"))
    r.add("splits.repeated_identifiers_carry_one_label", F.lit(not d.id_columns_are_entity_keys) | (mixed == 0), number(mixed, " contradictory identifiers"))
    if d.rows:
        off = {
            s: (n[s] != F.lit(d.rows.get(s))) | (F.abs(F.coalesce(F.try_divide(p[s], n[s]), F.lit(0.0)) - d.positive_rate[s]) > 1e-6 if d.positive_rate.get(s) is not None else F.lit(False))
            for s in SPLITS
        }
        r.none_of("runner.meta_counts_match_files", off, counts)

    if d.declared is not None:
        known = {*d.features, *declarations.listed(d.declared, "carry_columns"), *free, d.target}
        r.said([("leakage.declared_columns", sorted(set(header) - known))])
        blank = at_splits(lambda x, s: (x[s]["rows"] > 0) & (x[s]["filled"] == 0))
        r.add("leakage.every_column_could_be_scored", (F.size(blank) == 0) & F.lit(not twice), F.array_join(F.concat(F.array(*[F.lit(f"{c} twice") for c in twice]).cast("array<string>"), blank), "; "))
        r.none_of("splits.actual_ranges_computed", {s: lost[s] | (n[s] == 0) for s in SPLITS}, ranges)
        if features:
            r.add("duplicates.no_feature_tuple_in_two_splits", zero("tuple.shared") == 0, number(zero("tuple.shared"), " feature tuples are in more than one split"))
        r.said(declarations.split_findings(d))
        r.said(declarations.timing_findings(d.declared, d.features, d.label_source_columns))
        r.said(declarations.contract_findings(d.declared, shipped))
        r.said(declarations.unit_findings(d.declared))
        r.said(declarations.runner_findings(d, header))
    for k in range(len(crossing)):
        met = F.col(f"crossing_{k}")
        exact = F.exists(met, lambda x: x["split"].isin(*SCORED) & (x["covered"] >= 1) & (x["mismatches"] == 0))
        exposed = F.exists(met, lambda x: x["covered"] > 0)
        fine = ~exact & (~exposed | F.lit(contract.get("access") in ("isolated_rows", "chronological")))
        r.add(f"contract.cross_row_probe_{k}", fine, F.when(exact, "exact").otherwise("exposed"), F.to_json(met))
    if ledger is not None:
        flaws = {"uncovered": "uncovered", "unknown": "unknown", "duplicated": "duplicated", "late features": "features_late"}
        some = lambda c: F.exists("ledger", lambda x: x[c] > 0)
        bad = {name: some(c) for name, c in flaws.items()}
        bad["labels too late"] = F.exists("ledger", lambda x: ~x["labels_in_time"])
        if contract.get("access") == "common_cutoff_batch":
            bad["several instants"] = F.exists("ledger", lambda x: x["instants"])
        bad["a split is missing"] = F.size("ledger") < len(SPLITS)
        r.none_of("contract.label_availability", bad, F.to_json("ledger"))
    for s, what, literal in claims:
        value = {"n_rows": n[s], "positives": p[s], "rate": F.try_divide(p[s], n[s])}[what].cast("double")
        near = F.abs(F.lit(literal).cast("double") - value) <= gate.claim_tolerance(F.lit(literal)) + 1e-12
        r.add(f"claims.{s}_{what}_{literal}", near, F.concat(F.lit("rows say "), F.round(value, 6).cast("string")))
    if texts is not None:
        r.add("claims.prose_matches_rows", F.size("prose") == 0, F.array_join(F.transform("prose", lambda x: F.concat(x["split"], F.lit(" "), x["literal"], F.lit("%"))), "; "), F.to_json("prose"))
    if battery is not None:
        r.add("battery.exact_recovery", F.size("battery") == 0, F.array_join(F.array_distinct(F.transform("battery", lambda x: x["probe"])), "; "), F.to_json("battery"))
    return r.over(measured)


def split_facts(facts: DataFrame) -> DataFrame:
    """(split, observed): positive percentage of every split."""
    row = facts.where(F.col("field") == ROW).select(F.explode(F.array(*SPLITS)).alias("s"))
    return row.select("s.split", (F.lit(100.0) * F.try_divide("s.positives", "s.rows")).alias("observed"))


def failed_prose(texts: DataFrame, facts: DataFrame) -> DataFrame:
    """(split, literal, texts): percent claims of the texts that the rows do not bear out, each once."""
    found = gate.rate_claims(texts, "key", "text", facts).where("not ok")
    return found.groupBy("split", "literal").agg(F.countDistinct("key").alias("texts"))


def ledger_facts(panel: DataFrame, ledger: DataFrame, d: Descriptor) -> DataFrame:
    """What ``gate.availability`` says of every split, and whether it has several prediction instants."""
    found = gate.availability(panel, ledger, d.id_columns, "split", {s: k for k, s in enumerate(SPLITS)})
    instants = ledger.groupBy("split").agg((F.min("prediction_time") != F.max("prediction_time")).alias("instants"))
    return found.join(instants, "split", "left")


def crossing_facts(panel: DataFrame, y: Column, spec: dict) -> DataFrame:
    """(split, covered, mismatches) of a declared cross-row probe, all rows being donors.

    Only an entity-day of one row is answered, so its split and label stand in for a row number.
    """
    rows = panel.withColumn("_row", F.struct("split", F.coalesce(y, F.lit(0)).alias("y")))
    score = probes.declared_probe(rows, rows, spec, "_row").select("_row.*", "score")
    return score.groupBy("split").agg(F.count(F.lit(1)).alias("covered"), F.count(F.when(F.col("score") != F.col("y"), 1)).alias("mismatches"))

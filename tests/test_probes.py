"""Probe algebra, refusals and the expression evaluator."""

import pytest
from pyspark.sql import functions as F

from priorframe.operators import probes
from priorframe.operators.expressions import Evaluator
from priorframe.sources import sinks
from tests.conftest import values


def col(n):
    return {"op": "column", "name": n}


def const(v):
    return {"op": "constant", "value": v}


def call(op, *a):
    return {"op": op, "args": list(a)}


def run(spark, rows, schema, tree, donors=None):
    return Evaluator(spark.createDataFrame(rows, schema), "y", donors).add("out", tree).result()


def test_label_never_enters(spark):
    df = spark.createDataFrame([(1, 0)], "a int, y int")
    with pytest.raises(ValueError):
        probes.require_label_free(df, "y")
    with pytest.raises(ValueError):
        Evaluator(df, "y")
    with pytest.raises(ValueError):
        sinks.freeze_scores(df, "unused", ["a"], target="y")


@pytest.mark.parametrize(
    "tree, want",
    [
        (call("div", const(1), const(0)), None), (call("mod", const(-7), const(3)), 2.0),
        (call("and", const(0), const(None)), None), (call("and", const(1), const(2)), None),
        (call("eq", const("1"), const(1)), 0.0), (call("eq", const(1), const(1.0)), 1.0),
        (call("missing", const("")), 1.0), (call("missing", const(None)), 1.0), (call("missing", const(0)), 0.0),
        (call("if", const(0), const(1), const(5)), 5.0), (call("if", const(2), const(1), const(5)), None),
        (call("coalesce", const(None), const("z")), "z"), (call("contains", const("abc"), const("bc")), 1.0),
        (call("contains", const(1), const("bc")), None), (call("length", const("abc")), 3.0), (call("length", const(3)), None),
        ({"op": "slice", "value": const("abcdef"), "start": 1, "stop": -2}, "bcd"),
        ({"op": "slice", "value": const("ab"), "start": -5, "stop": 9}, "ab"),
        (call("rounded_count", const(3), const(0.3333), const(4)), 1.0),
        (call("rounded_count", const(3), const(0.3333), const(4.5)), None),
        (call("date", const("2024-01")), 19723.0), (call("date", const("nope")), None), (call("lt", const("a"), const("b")), None),
    ],
)
def test_scalar_rules(spark, tree, want):
    assert run(spark, [(1,)], "a int", tree).first()["out"] == want


def test_join_is_unique_only_and_months_must_exist(spark):
    rows = [("a", "2024-01-30", 1), ("a", "2024-01-31", 2), ("a", "2024-02-29", 3), ("b", "2024-01-30", 4),
            ("b", "2024-01-31", 5), ("b", "2024-01-31", 6), ("", "2024-01-30", 7), ("", "2024-01-31", 8)]
    tree = {"op": "join", "keys": ["e"], "time": "d", "offset": const(1), "unit": "days", "value": col("v")}
    got = run(spark, rows, "e string, d string, v int", tree)
    assert {r["v"]: r["out"] for r in got.collect()} == {1: 2.0, 2: None, 3: None, 4: None, 5: None, 6: None, 7: None, 8: None}
    months = {**tree, "unit": "months"}
    got = {r["v"]: r["out"] for r in run(spark, rows, "e string, d string, v int", months).collect()}
    assert got[1] is None and got[2] is None  # no 30 or 31 February


def test_group_rules(spark):
    rows = [("a", "1"), ("a", "2"), ("b", "3"), ("b", "x"), ("c", "4"), ("c", "4")]
    tree = lambda how: {"op": "group", "keys": ["e"], "aggregate": how, "value": call("number", col("v"))}
    at = lambda how: dict(values(run(spark, rows, "e string, v string", tree(how)).distinct(), "e", "out"))
    assert {k: v for k, v in at("sum").items()} == {"a": 3.0, "b": None, "c": 8.0}
    assert at("unique") == {"a": None, "b": None, "c": 4.0}


def test_donor_scope(spark):
    rows = [("a", "2024-01-01", "eval", 1), ("a", "2024-01-02", "holdout", 2)]
    tree = {"op": "join", "keys": ["e"], "time": "d", "offset": const(1), "unit": "days", "value": col("v")}
    schema = "e string, d string, split string, v int"
    assert dict(values(run(spark, rows, schema, tree), "v", "out"))[1] == 2.0
    assert dict(values(run(spark, rows, schema, tree, F.col("split") == "eval"), "v", "out"))[1] is None


def test_station_identities_recover_the_next_day(spark):
    import random

    rng = random.Random(5)
    rows = [("s", d, float(rng.randrange(0, 200))) for d in range(80) if d % 13]
    df = spark.createDataFrame(rows, "s string, d int, v double")
    feats = probes.station_features(df, ["s"], "d", "v", 90.0)
    value, conflict = probes.recipe_union(probes.STATION_RECIPES)
    got = probes.station_recipes(feats, ["s"], "d", 90.0).select("d", value.alias("p"), conflict.alias("c"))
    truth = {d: float(v > 90) for _, d, v in rows}
    answers = [(r["d"], r["p"]) for r in got.collect() if r["p"] is not None and r["d"] + 1 in truth]
    assert len(answers) > 60 and all(truth[d + 1] == p for d, p in answers)
    assert not any(r["c"] for r in got.collect())


def test_declared_probe_needs_one_row_and_agreeing_donors(spark):
    rows = [("a", "2024-01-01", 1, 0.0), ("a", "2024-01-03", 2, 1.0), ("b", "2024-01-01", 3, 0.0), ("b", "2024-01-01", 4, 0.0),
            ("b", "2024-01-03", 5, 1.0), ("c", "2024-01-01", 6, 0.0), ("c", "2024-01-03", 7, 1.0), ("c", "2024-01-03", 8, 0.0)]
    df = spark.createDataFrame(rows, "e string, t string, id bigint, x double")
    spec = {"entity": ["e"], "time": "t", "offset_days": 2, "operation": "copy", "left": "x"}
    assert values(probes.declared_probe(df, df, spec, "id"), "id", "score") == [(1, 1.0)]
    with pytest.raises(ValueError):
        probes.declared_probe(df, df, {**spec, "offset_days": 0}, "id")
    with pytest.raises(ValueError):
        probes.declared_probe(df, df, {**spec, "operation": "peek"}, "id")


def test_uncovered_rows_score_one_half_in_the_full_auc(spark):
    s = spark.createDataFrame([("p", 1, 1.0), ("p", 2, None), ("p", 3, 0.0)], "probe string, id int, score double")
    y = spark.createDataFrame([(1, 1), (2, 1), (3, 0)], "id int, y int")
    r = probes.score_probes(s, y, ["probe"], "id", "y").first()
    assert (r["n_rows"], r["covered"], r["errors"], r["auc_covered"], r["auc_full"]) == (3, 2, 0, 1.0, 1.0)


def test_frozen_scores_show_tampering(spark, tmp_path):
    s = spark.createDataFrame([("p", 1, 1.0), ("p", 2, 0.5), ("q", 1, 0.0)], "probe string, id int, score double")
    seal = sinks.freeze_scores(s, str(tmp_path / "f"), ["probe"], target="y")
    _, ok = sinks.sealed_scores(spark, str(tmp_path / "f"), ["probe"], seal)
    assert values(ok, "probe", "sealed") == [("p", True), ("q", True)]
    s.where("probe = 'p'").limit(1).write.mode("append").parquet(str(tmp_path / "f" / "scores"))
    _, ok = sinks.sealed_scores(spark, str(tmp_path / "f"), ["probe"], seal)
    assert values(ok, "probe", "sealed") == [("p", False), ("q", True)]


def test_dated_outcome_context(spark):
    text = "x\nid-12345 on 2024-05-01\n\noutcome = 1\nend\nfar\nid-99999"
    df = spark.createDataFrame([(1, text), (2, "no result here 2024-05-01")], "k int, t string")
    found = probes.dated_outcomes(df, "k", "t", [("2024-01-01", "2025-01-01")])
    got = probes.scored_id_lines(found, spark.createDataFrame([("id-12345",)], "id string"), "k")
    assert values(got, "line", "scored_id", "scored_date") == [
        (1, False, False), (2, True, True), (3, False, False), (4, False, False), (5, False, False), (6, False, False),
    ]


def test_candidates_are_chosen_without_labels(spark):
    rows = [(f"s{i % 4}", i, f"c{i % 3}", float(i), "short", "a longer text value") for i in range(40)]
    df = spark.createDataFrame(rows, "site string, row_id bigint, country string, prior_rate double, note string, story string")
    keys, operands = probes.successor_candidates(df, "day")
    assert keys == [["country"], ["row_id"], ["site"], ["country", "row_id"], ["country", "site"], ["row_id", "site"]]
    assert operands == ["country", "prior_rate"]
    assert probes.text_columns(df, ["note", "story", "prior_rate"]) == ["note", "story"]


def test_uninformative_vectors_are_dropped_and_findings_split(spark):
    rows = [("flat", "statistical", 1, 0.5), ("flat", "statistical", 2, 0.5), ("none", "exact", 1, None), ("one", "exact", 1, 1.0), ("vary", "statistical", 1, 0.1), ("vary", "statistical", 2, 0.9)]
    df = spark.createDataFrame(rows, "probe string, kind string, id int, score double").withColumn("split", F.lit("eval"))
    assert values(probes.informative(df, ["probe", "split"]).select("probe").distinct(), "probe") == [("one",), ("vary",)]
    y = spark.createDataFrame([(1, 1), (2, 0)], "id int, y int")
    found = probes.findings(probes.score_probes(df, y, ["probe", "kind", "split"], "id", "y"))
    assert values(found, "probe", "finding") == [("one", "failure"), ("vary", "flag")]


def test_rate_threshold_is_the_largest_multiple_still_exceeded(spark):
    from priorframe.operators.labels import rate_threshold

    data = [7, 61, 120, 121, 180, 181, 300, 300, 305, 999]
    df = spark.createDataFrame([(v,) for v in data], "v bigint")
    for target in (0.1, 0.25, 0.5, 0.9):
        best = max(t for t in range(0, 1200, 60) if sum(v > t for v in data) >= target * len(data))
        assert rate_threshold(df, "v", target, 60).first()["threshold"] == best

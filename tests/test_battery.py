"""The leak battery: nothing scored is read before the seal, and findings follow the kinds of probes."""

import pytest
from pyspark.sql import functions as F

from priorframe.operators import probes
from priorframe.operators.battery import Battery
from priorframe.operators.history import at_offset
from priorframe.sources.sinks import sealed_scores


@pytest.fixture(scope="module")
def panel(spark):
    """Three islands, a row a day, split by time; the label says whether the next day's value is above 50."""
    rows = [(f"{d:03d}{i}", i, d, (d * 37 + k * 11) % 100, "train" if d < 60 else "eval" if d < 90 else "holdout") for d in range(120) for k, i in enumerate("NSW")]
    return spark.createDataFrame(rows, "row_key string, island string, d int, last_value int, split string").cache()


@pytest.fixture(scope="module")
def labels(panel):
    later = at_offset("last_value", ["island"], "d", 1)
    return panel.select("row_key", "split", (later > 50).cast("bigint").alias("y")).where("y is not null").cache()


def recipe(offset):
    def run(panel):
        later = at_offset("last_value", ["island"], "d", offset)
        return panel.select("row_key", (later > 50).cast("double").alias("score"))

    return run


def battery(panel):
    recipes = {"next": ("exact", recipe(1)), "wrong": ("exact", recipe(2))}
    return Battery(panel, "y", "row_key", ["island", "last_value"], "d", [["island"]], ["last_value"], offsets=(1, 7), quasi=(1,), recipes=recipes)


@pytest.fixture(scope="module")
def report(panel, labels, tmp_path_factory):
    run, path = battery(panel), str(tmp_path_factory.mktemp("battery") / "frozen")
    _, seal = run.freeze(labels.where("split = 'train'"), path)
    return {(r.probe, r.split): r for r in run.report(path, seal, labels.drop("split")).collect()}


def test_findings(report):
    assert all(r.sealed for r in report.values())
    for split in ("eval", "holdout"):
        assert report["next", split].finding == "failure" and report["next", split].errors == 0
        assert report["wrong", split].finding is None and report["wrong", split].errors > 0
        assert report["numeric:island", split].finding == "skipped" and report["numeric:island", split].covered == 0
        assert report["missing:island", split].finding == "skipped"  # constant
        assert report["length:last_value", split].finding is None
    flags = {p for (p, _), r in report.items() if r.finding == "flag"}
    assert "all:explore:island:1:last_value" in flags and "lookup:last_value" in flags


def test_pools(report):
    """The last day of eval has its successor in holdout: only the pool of all rows reaches it."""
    own, every = report["self:explore:island:1:last_value", "eval"], report["all:explore:island:1:last_value", "eval"]
    assert (own.n_rows, own.covered, every.covered) == (90, 87, 90)
    quasi = report["self:quasi_successor:island:1", "eval"]
    assert quasi.covered == 87 and quasi.finding is None  # constant, but its coverage counts


def test_scored_labels_change_no_vector(panel, labels, tmp_path):
    seals = []
    for k, given in enumerate((labels, labels.withColumn("y", F.when(F.col("split") != "train", 1 - F.col("y")).otherwise(F.col("y"))))):
        _, seal = battery(panel).freeze(given.where("split = 'train'"), str(tmp_path / f"f{k}"))
        seals.append(sorted(map(str, seal.collect())))
    assert seals[0] == seals[1]
    _, other = battery(panel).freeze(labels.where("split = 'train'").withColumn("y", 1 - F.col("y")), str(tmp_path / "f2"))
    assert sorted(map(str, other.collect())) != seals[0]  # train lookups do read train labels


def test_a_changed_vector_breaks_the_seal(spark, panel, labels, tmp_path):
    path = str(tmp_path / "f")
    frozen, seal = battery(panel).freeze(labels.where("split = 'train'"), path)
    frozen.where("family = 'row' and split = 'eval'").limit(1).write.mode("append").parquet(f"{path}/scores")
    _, intact = sealed_scores(spark, path, ["family", "split"], seal)
    assert {(r.family, r.split) for r in intact.collect() if not r.sealed} == {("row", "eval")}


def test_a_target_is_refused(panel):
    with pytest.raises(ValueError):
        battery(panel.withColumn("y", F.lit(1)))


def test_lookup_cube_equals_row_lookups(panel, labels):
    rows = panel.join(labels.select("row_key", "y"), "row_key")
    cube = probes.lookup_cube(rows, "split", "y", ["island", "last_value"])
    looked = probes.train_lookup(rows, "split", "row_key", "y", ["island", "last_value"])
    want = looked.groupBy("probe", "split", F.col("score").alias("rate"), F.col("unanimous").isNotNull().alias("unanimous")).agg(F.count(F.lit(1)).alias("n_rows"))
    assert sorted(map(str, cube.select(want.columns).collect())) == sorted(map(str, want.collect()))

"""What one task holds or reads is bounded, whatever the size of the table."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from priorframe.operators.ordering import PIECES
from priorframe.operators.qualify import ROW, cell_levels
from priorframe.plans import QUERIES
from priorframe.plans.history import differing
from priorframe.sources import sinks


@pytest.mark.parametrize("name", ["a5_nested_json_flatten", "a6_xml_activity_scan"])
def test_nested_text_is_written_in_compressed_files_of_bounded_records(spark, sf, monkeypatch, name):
    monkeypatch.setattr(sinks, "FILE_RECORDS", 500)
    out = QUERIES[name](spark, sf)
    n = spark.read.parquet(f"{sf}/lineitem.parquet").count()
    files = [Path(f.removeprefix("file://")) for f in out.inputFiles()]
    assert out.count() == n
    assert len(files) >= n / 500 and all(f.suffix == ".gz" for f in files)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_flip_check_deals_rows_of_one_priority_over_pieces(spark, sf):
    p = plan(QUERIES["e17_label_flip_invariance"](spark, sf))
    assert not re.search(r"hashpartitioning\(o_orderpriority#\d+, \d+\), ENSURE_REQUIREMENTS, .*\n.*\bo_orderkey", p)
    assert "_piece" in p and f", {PIECES}), REPARTITION_BY_NUM" in p


def test_differing_counts_surplus_rows_with_repeats_and_nulls(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None), (3, "z")], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (2, None), (4, "z")], "k int, v string")
    assert differing(a, b).first()[0] == a.exceptAll(b).count() == 2
    assert differing(b, a).first()[0] == 1 and differing(a, a).first()[0] == 0


def test_brands_of_orders_are_told_apart_in_pieces(spark, sf):
    p = plan(QUERIES["d17_label_prevalence_floor"](spark, sf))
    assert re.search(rf"hashpartitioning\(l_orderkey#\d+L?, {PIECES}\), REPARTITION_BY_NUM", p)


def test_cells_are_counted_in_pieces_of_the_rows(spark):
    panel = spark.createDataFrame([(f"{k}", k % 2, "train" if k % 3 else "eval") for k in range(60)], "id string, y int, split string")
    levels = cell_levels(panel, F.col("y"), ["id"], {ROW: F.lit("")})
    assert f", {PIECES}), REPARTITION_BY_NUM" in plan(levels)
    row = levels.where(F.col("field") == ROW).first()
    assert (row["n_train"], row["n_eval"], row["p_train"]) == (40, 20, 20) and levels.count() == 61

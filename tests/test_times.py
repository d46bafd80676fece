"""Times that do not parse fail the range checks of the gate."""

import pytest
from pyspark.sql import functions as F

from tests.test_gate import declared, failing, panel  # noqa: F401

RANGES = {"splits.actual_ranges_disjoint", "splits.rows_within_declared_windows"}


@pytest.mark.parametrize("split", ["train", "eval", "holdout"])
def test_one_time_that_does_not_parse(panel, declared, split):  # noqa: F811
    one = panel.where((F.col("split") == split) & (F.col("dear") == 0)).agg(F.min("key")).first()[0]
    bad = panel.withColumn("placed", F.when(F.col("key") == one, F.lit("1999-13-45")).otherwise(F.col("placed")))
    assert failing(bad, declared) == RANGES


def test_blank_times(panel, declared):  # noqa: F811
    negative = (F.col("split") == "eval") & (F.col("dear") == 0)
    some = panel.withColumn("placed", F.when(negative, F.lit(" ")).otherwise(F.col("placed")))
    assert failing(some, declared) == set()
    none = panel.withColumn("placed", F.when(F.col("split") == "eval", F.lit(None)).otherwise(F.col("placed")))
    assert RANGES <= failing(none, declared)

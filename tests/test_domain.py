"""The domain lists every column of the profile."""

from priorframe.plans import QUERIES


def test_every_profiled_column_has_its_domain(spark, sf):
    listed = QUERIES["d18_column_domain_of_profile"](spark, sf).groupBy("split", "field").count().collect()
    profile = QUERIES["d18_column_profile"](spark, sf).collect()
    assert {(r["split"], r["field"]): r["count"] for r in listed} == {(r.split, r.field): r.n_values for r in profile}
    assert max(r.n_values for r in profile if r.field == "cents") > 128
